"""The stages against plain versions of them, and the registered queries with their SQL."""

import os
import subprocess
import sys

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from verify import compare, database
from warcloom.llm import common
from warcloom.llm.oracle import ORACLE
from warcloom.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(spark, database(SF_DIR), name, SF_DIR) == ""


def test_stages(spark):
    from tests.llm.test_pairs import brute_components, brute_overlaps

    docs = common.table(spark, SF_DIR, "documents")
    rows = [(r.doc_id, r.text) for r in corpus_pipeline.without_toxic(spark, docs, SF_DIR).collect()]
    # Nine toxic labels to learn from in this table; see test_toxicity.py for a larger one.
    clean = {r.doc_id for r in common.table(spark, SF_DIR, "labels").collect() if r.toxic == 0}
    assert len(clean & {d for d, _ in rows}) >= 0.9 * len(clean)
    keep = {d for d, _, c in brute_components(rows, 5, 80) if d == c}
    rows = [r for r in rows if r[0] in keep]
    items = [(r.item_id, r.text) for r in common.table(spark, SF_DIR, "benchmark").collect()]
    bad = {o[0] for o in brute_overlaps(rows, items)}
    rows = [r for r in rows if r[0] not in bad]
    got = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in rows)
    assert all(r.round_trip for r in got)


def test_stages_keep_columns_and_odd_rows(spark):
    odd = [(1, None, "en", "s", 0), (None, "text without id", None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (3, "token=abcdefgh12 é", "en", "s", 18)]
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in odd], "doc_id long, text string, lang string, source string, n_chars long, score double, secrets string")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, docs, SF_DIR)
        assert left.schema.names == docs.schema.names
        ids = sorted(str(r.doc_id) for r in left.collect())
        assert ids in (["1", "2", "2", "3", "None"], ["1", "2", "3", "None"])
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0
    changed = {r.doc_id: r for r in corpus_pipeline.without_secrets(spark, docs, SF_DIR).collect()}
    assert (changed[3].text, changed[3].n_chars, changed[3].secrets) == ("[secret] é", 10, "x") and changed[1].text is None


def test_shared_folder_is_asked_for(spark, monkeypatch):
    class Elsewhere:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(Elsewhere())


def test_the_rest_works_without_this_package(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for name in ("warcloom", "workload", "__spark_entry__.py", "verify.py"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        subprocess.run(["cp", "-r", f"{root}/{name}", str(tmp_path / name)], check=True)
    subprocess.run(["rm", "-r", str(tmp_path / "warcloom" / "llm")], check=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and len(q) >= 46 and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
