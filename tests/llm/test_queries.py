"""Every registered query has SQL that it equals, or is named here beside the brute force it is held against."""

import os
import sys

from conftest import ROOT, SF_SMALL

from vaultmart.llm.oracle import ORACLE_SQL
from vaultmart.llm.queries import QUERIES

sys.path.insert(0, os.path.join(ROOT, "tools"))

BRUTE_FORCE = {
    "op1_token_counts": "test_token_counts.py", "op2_license_scan": "test_license_scan.py", "op4_byte_bpe": "test_bpe.py",
    "op6_language_model": "test_language_model.py", "op7_token_file": "test_token_file.py", "op8_simhash": "test_simhash.py",
    "op9_sharding": "test_sharding.py", "op10_decontamination": "test_decontaminate.py"}


def test_queries_without_sql_have_a_brute_force():
    assert set(QUERIES) - set(ORACLE_SQL) == set(BRUTE_FORCE) and set(ORACLE_SQL) <= set(QUERIES)
    here = os.path.dirname(os.path.abspath(__file__))
    assert all(os.path.exists(os.path.join(here, file)) for file in BRUTE_FORCE.values())


def test_queries_equal_their_sql(spark):
    import check_oracle

    results = check_oracle.check(spark, SF_SMALL, sorted(ORACLE_SQL), verbose=False)
    assert len(results) == len(ORACLE_SQL) and all(r["ok"] for r in results.values()), results
