import __spark_entry__ as entry


def test_registry_and_small_run(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries)
    assert len([k for k in queries if k.startswith("q")]) >= 40
    assert entry.entry(spark).count() > 0
