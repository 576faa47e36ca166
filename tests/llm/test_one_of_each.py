from segstream.llm import neardup


def plain(name, n=60):
    return " ".join(f"{name}{i}" for i in range(n))


def test_one_id_on_unrelated_texts_keeps_each_component(spark):
    """Two texts share an id, each with a near copy under a larger one."""
    rows = [(1, plain("a")), (2, plain("a") + " tail"), (1, plain("b")), (3, plain("b") + " tail"), (1, plain("b")), (4, plain("c"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(tuple(r) for r in neardup.one_of_each(df).collect()) == [(1, plain("a")), (1, plain("b")), (4, plain("c"))]


def test_rows_without_id_or_shingle(spark):
    rows = [(None, plain("a")), (None, plain("a") + " tail"), (5, None), (5, ""), (5, ""), (5, plain("b"))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [tuple(r) for r in neardup.one_of_each(df).collect()]
    assert len([r for r in got if r[0] is None]) == 1
    assert sorted((r[1] or "-")[:2] for r in got if r[0] == 5) == ["-", "-", "b0"]
