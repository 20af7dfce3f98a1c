import __spark_entry__
from frameyard.plans import catalog


def test_contract(spark):
    queries, sql = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(sql) <= set(queries) and set(catalog.QUERIES) <= set(queries) and len(catalog.QUERIES) > 80
    assert __spark_entry__.entry(spark).count() > 0
