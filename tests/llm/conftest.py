import pytest


@pytest.fixture
def text_rows(spark):
    """Documents from (doc_id, text) pairs, with columns that clash and that don't matter."""

    def make(rows, schema="doc_id long, text string"):
        extra = ", score string, n_tokens string, secrets string, detections string, label string"
        width = len(schema.split(","))
        return spark.createDataFrame([tuple(r) + ("x",) * 5 for r in rows] if rows else [], schema + extra).select(
            *[c.strip().split(" ")[0] for c in (schema + extra).split(",")][: width + 5]
        )

    return make
