"""The factorization machine: what it learns, and accuracy on held-out rows."""

import zlib

import numpy as np
import pytest

from warcloom.llm import toxicity
from warcloom.llm.common import table

SF_DIR = "/root/testdata/sf0.01"


def test_interactions_are_learned():
    """A pair of terms decides; each of them alone is as frequent in both classes."""
    rng = np.random.default_rng(0)
    places, labels = [], []
    for _ in range(3_000):
        a, b = rng.random(2) < 0.5
        places.append(np.array([k for k, on in ((0, a), (1, b), (2, rng.random() < 0.5)) if on], dtype=np.int32))
        labels.append(float(a == b))
    model = toxicity.train(np.array(labels), places, np.arange(3), epochs=60)
    right = [(toxicity.sigmoid(model.logit(p)) >= 0.5) == bool(x) for p, x in zip(places, labels)]
    assert np.mean(right) > 0.95


def test_logit_equals_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    model = toxicity.Model(np.arange(9), rng.normal(size=9), rng.normal(size=(9, 4)), 0.3)
    places = np.array([1, 4, 8])
    pairs = sum(model.factors[a] @ model.factors[b] for a in places for b in places if a < b)
    assert model.logit(places) == pytest.approx(0.3 + model.weights[places].sum() + pairs)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels), drop_text=True)
    rows = {r.doc_id: r for r in scored.withColumn("out", toxicity.held_out("doc_id")).collect()}
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows.values())
    told = [(rows[r.doc_id].score >= toxicity.THRESHOLD, bool(r.toxic)) for r in labels.collect() if rows[r.doc_id].out]
    assert not any(p and not t for p, t in told)
    assert sum(p and t for p, t in told) >= 0.6 * sum(t for _, t in told)


def test_odd_rows(spark, text_rows):
    texts = ["you moron " + "w " * k for k in range(20)] + ["fine words " * (k + 1) for k in range(60)]
    docs = text_rows([*enumerate(texts), (None, "you moron"), (200, None), (201, ""), (202, "moron " * 50_000), (202, "moron " * 50_000)])
    labels = spark.createDataFrame([(k, int(k < 20)) for k in range(80)] + [(3, 0), (None, 1), (5, None)], "doc_id long, toxic int")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = scored.collect()
    assert len(rows) == 85 and all(0 <= r.score <= 1 for r in rows) and isinstance(rows[0].score, float)
    by_id = {r.doc_id: r.score for r in rows}
    assert by_id[202] > 0.3 and by_id[None] > 0.3 and by_id[200] == by_id[201] < 0.3
    again = toxicity.fit(docs, labels)
    assert [r.score for r in toxicity.score(docs, again).collect()] == [r.score for r in rows]


def test_without_labels(spark, text_rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = text_rows([(1, "a"), (2, None)])
    assert all(r.score < 0.3 for r in toxicity.score(docs, toxicity.fit(docs, none)).collect())
    assert toxicity.score(text_rows([]), toxicity.fit(docs, none)).count() == 0


def test_the_sample_is_bounded(spark):
    labels = table(spark, SF_DIR, "labels")
    chosen = toxicity.sample(labels, 50).collect()
    assert len(chosen) == 50 and not any(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in chosen)
