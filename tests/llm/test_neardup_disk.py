import os

from segstream.llm import neardup
from segstream.session import shared_root


def test_tables_of_the_rounds_are_deleted(spark):
    """Behind the result stay what it reads (shingle sets, roots) and the members
    and classes, however many rounds the components took."""
    rows = [(i, " ".join(f"{'abc'[i % 3]}{j}" for j in range(i // 3, 60 + i // 3))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)

    def names():
        root = shared_root(spark).removeprefix("file:")
        return [n for _, folders, _ in os.walk(root) for n in folders if n.startswith(("llm-", "rdd-"))]

    before = names()
    out = neardup.near_duplicates(df, k=3, percent=85)
    found = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert found == {i: i % 3 for i in range(40)}
    new = sorted(set(names()) - set(before))
    assert [n.split("-")[1] for n in new if n.startswith("llm-")] == ["roots", "shingles"]
    assert len(new) <= 6
