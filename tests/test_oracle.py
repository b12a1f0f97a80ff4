"""Every registered query against its DuckDB oracle (the driver's gate), at sf0.001."""

import os
import sys

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))


def test_queries_match_oracle(spark):
    import check_oracle

    from vaultmart.oracle import oracle_queries
    from vaultmart.plans.registry import QUERIES

    stated = [n for n in QUERIES if n in oracle_queries()]
    assert stated
    res = check_oracle.check(spark, SF_SMALL, stated, verbose=False)
    bad = {n: r for n, r in res.items() if not r.get("ok")}
    assert not bad, bad


def test_every_core_query_has_an_oracle():
    from vaultmart.oracle import oracle_queries
    from vaultmart.plans.registry import QUERIES

    assert not set(QUERIES) - set(oracle_queries())


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["suburb", "state", "sale_month", "transaction_count", "avg_sale_price",
                          "median_sale_price", "avg_days_on_market"]
