import re


def test_every_query_has_an_oracle():
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    # the training-data operators, where present, have SQL only where it can express them
    own = {name for name in q if not re.fullmatch(r"op\d+_[a-z0-9_]+|pipeline", name)}
    assert own <= set(o) <= set(q)
    assert len(own) >= 50
    assert all(re.fullmatch(r"[a-z][a-z0-9_]*", name) for name in q)


def test_entry_runs(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["payload", "segment_id", "offset"]
    assert df.count() > 0
