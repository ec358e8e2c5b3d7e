"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E


def test_entry_returns_rows_with_a_stable_schema(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == ("struct<sales_month:string,completed_orders:bigint,units_sold:bigint,"
                                        "gross_revenue:double,revenue_per_order:double>")
    assert df.count() > 0


def test_queries_and_oracles_line_up():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(isinstance(sql, str) and sql.strip() for sql in o.values())
    assert all(callable(f) for f in q.values())
