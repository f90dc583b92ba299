from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SF_DIR
from tests.llm import brute
from throngcast.llm import pii, queries

COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """What each stage returns, written and read back as a cluster does it."""
    folder, docs, out = tmp_path_factory.mktemp("steps"), spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns(steps):
    assert all(df.columns == COLUMNS for name, df in steps.items() if name != "packing")


def test_quality_drops_junk_and_keeps_clean(spark, steps):
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = ids(steps["quality"])
    clean = {i for i, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0}
    assert len(clean & kept) >= 0.97 * len(clean)


def test_one_of_each_group_stays(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps["quality"].collect()]
    classes = brute.near_classes(rows, corpus_pipeline.SIMILARITY)
    assert ids(steps["near_duplicates"]) == {i for i, (_, c) in classes.items() if i == c}


def test_contaminated_documents_go(spark, steps):
    items = [r["text"].lower() for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    before = {r["doc_id"]: r["text"].lower() for r in steps["near_duplicates"].collect()}
    gone = set(before) - ids(steps["decontamination"])
    assert {i for i, t in before.items() if any(x in t for x in items)} <= gone
    words = [set(x.split()) for x in items]
    assert all(any(len(w & set(before[i].split())) >= 0.7 * len(w) for w in words) for i in gone)


def test_personal_data_is_masked(steps):
    before = {r["doc_id"]: r["text"] for r in steps["decontamination"].collect()}
    after = steps["personal_data"].collect()
    assert len(after) == len(before)
    for r in after:
        assert r["text"] == pii.mask_text(before[r["doc_id"]]) and r["n_chars"] == len(r["text"])


def test_every_document_is_packed(steps):
    assert ids(steps["packing"]) == ids(steps["personal_data"])


def test_odd_documents_pass_all_stages(spark, odd_documents, no_documents):
    for docs in (odd_documents, no_documents):
        docs = docs.select(*COLUMNS, "block", "key", "rank")
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF_DIR)
        docs.collect()


def test_repeated_ids_leave_one_row(spark, documents):
    text = " ".join(f"w{k}" for k in range(30))
    left = corpus_pipeline.near_duplicates(spark, documents((1, text, "en"), (1, text, "en"), (2, text, "en"), (3, "a b", "en")), SF_DIR)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3]


def test_all_queries_are_registered():
    names = set(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in names} == set(range(1, 11))
    assert names | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, SF_DIR).count() > 0


def test_nothing_else_needs_the_subpackage():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None\n"
        "class Gone:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith(('throngcast.llm', 'corpus_pipeline')):\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "del sys.modules['corpus_pipeline']; sys.meta_path.insert(0, Gone())\n"
        "import __spark_entry__ as e; assert e.queries() and not any(k.startswith('op1') for k in e.queries())"
    )
    root = Path(entry.__file__).parent
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def test_scans_read_what_they_need(spark):
    df = queries.QUERIES["op9_pii"](spark, SF_DIR)
    assert "html" not in df._jdf.queryExecution().executedPlan().toString() and df.where(F.col("doc_id").isNull()).count() == 0


def test_one_row_of_a_repeated_id_stays_the_same(documents):
    rows = [(1, "a text", "en"), (1, "another text", "de"), (1, None, None), (2, "alone", "en"), (None, "x", None), (None, "x", None)]
    found = set()
    for order in (rows, rows[::-1]):
        for parts in (1, 3):
            kept = corpus_pipeline._one_row_per_id(documents(*order).repartition(parts)).select("doc_id", "text").collect()
            found.add(tuple(sorted(map(tuple, kept), key=str)))
    assert len(found) == 1 and [r[0] for r in found.pop()].count(1) == 1
