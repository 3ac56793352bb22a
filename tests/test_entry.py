import __spark_entry__ as E


def test_queries_have_names_and_sql_belongs_to_them():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) > 30 and set(s) <= set(q)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "content_hash" in df.columns
