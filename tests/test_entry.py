"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as entry_module
from forecourt.plans.margin import MARGIN_COLUMNS


def test_entry_returns_the_margin_base(spark):
    df = entry_module.entry(spark)
    assert df.columns == MARGIN_COLUMNS and len(df.columns) == 44
    assert df.count() >= 0


def test_queries_and_oracles_align():
    q, sql = entry_module.queries(), entry_module.oracle_sql()
    assert set(sql) <= set(q) and len(q) >= 50
    assert all(callable(fn) for fn in q.values())
    extra = {k for k in q if k == "pipeline" or k[:2] == "op" and k[2].isdigit()}
    assert set(q) - extra == set(sql) - extra
