import random

import pytest

import __spark_entry__
import corpus_pipeline
from segstream.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Planted cases: a toxic text, junk, exact and near copies, a clean rest."""
    rng = random.Random(1)
    plain = lambda n: " ".join(f"w{rng.randrange(5000)}" for _ in range(n))
    rows = [(i, plain(rng.randrange(40, 200))) for i in range(60)]
    rows += [(100 + i, plain(20) + " grubbo " + plain(9) + " snerk vlort " + plain(5)) for i in range(40)]
    rows += [(200, "short"), (201, "same eight words again and again and so " * 20), (202, None), (203, "")]
    near = plain(150)
    rows += [(300, near), (301, near), (302, near + " more"), (303, "new " + near)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(100 <= i < 140)) for i, _ in rows if i < 140]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, ids = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, corpus).collect(), stage(spark, docs, corpus).schema)
        ids.append({r["doc_id"] for r in docs.collect()})
        assert name == "packing" or docs.columns == columns
    clean = set(range(60))
    assert ids[0] == clean | {200, 201, 202, 203, 300, 301, 302, 303}
    assert ids[1] == clean | {300, 301, 302, 303}
    assert ids[2] == ids[3] == clean | {300}


def test_run_and_entry(spark, corpus):
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, corpus).collect()} == set(range(60)) | {300}
    names = __spark_entry__.queries()
    assert {*QUERIES, "pipeline"} <= set(names) and set(ORACLE) <= set(__spark_entry__.oracle_sql())
    assert [q.split("_")[0] for q in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_empty_table(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, corpus)
        assert docs.count() == 0
