import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "date"


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_only_training_data_queries_lack_an_oracle():
    missing = set(E.queries()) - set(E.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in missing)
