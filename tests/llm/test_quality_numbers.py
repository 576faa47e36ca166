from segstream.llm import quality


def test_numeric_lines_are_told_apart_and_blank_lines_stay(spark):
    """30 texts of a host, each with a numeric line of its own, one that all
    hold, and a paragraph break."""
    body = lambda i: " ".join(f"{a}{b}" for a in "abcdefgh"[: 3 + i % 5] for b in "klmnopqrs") + " " + chr(97 + i % 26) * (1 + i // 26)
    rows = [(i, f"{body(i)}\n\n{1000 + i} {i}\n1998", "h") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in quality.filter_documents(df).collect()}
    want = {i: t if i == 0 else t.removesuffix("\n1998") for i, t, _ in rows}
    assert got == want
