from pyspark.sql import functions as F

from vaultmart.operators import quality
from vaultmart.sources import files, fixtures, jdbc

from conftest import SF_MID


def test_all_declared_tests_pass_on_the_vault(run):
    res = run.quality(3).collect()
    assert len(res) == 56
    assert [r for r in res if r.violations != 0] == []


def test_red_cases(spark):
    lineitem = fixtures.read_table(spark, SF_MID, "lineitem")
    orders = fixtures.read_table(spark, SF_MID, "orders")
    assert quality.unique_violations(lineitem, ["l_orderkey", "l_linenumber"]).count() == 11785
    assert quality.relationship_violations(orders, "o_orderkey", lineitem, "l_orderkey").count() == 257
    raw = fixtures.property_raw(spark, SF_MID, 2)
    assert quality.not_null_violations(raw, "agent_id").count() == 300
    res = quality.run_tests([quality.Test("bronze", "raw", "agent_id", "not_null")], {"raw": raw})
    assert res.first().violations == 300


def test_csv_round_trip_keeps_leading_zeros(spark, run):
    raw = fixtures.property_raw(spark, run.sf_dir, 2)
    path = f"{run.root}/test_csv"
    files.write_property_csv(raw, path)
    back = files.read_property_csv(spark, path)
    assert back.schema == raw.schema
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    assert back.where(F.col("postcode").startswith("00")).count() > 0


def test_csv_to_bronze_counts_in_one_pass(spark, run):
    raw = fixtures.property_raw(spark, run.sf_dir, 1).drop("_loaded_at")
    path = f"{run.root}/test_csv_in"
    files.write_property_csv(raw, path)
    n = files.load_csv_to_bronze(spark, path, f"{run.root}/test_bronze", "2024-01-01 00:00:00")
    assert n == raw.count()


def test_jdbc_round_trip_partitioned(spark, run):
    owners = fixtures.with_loaded_at(fixtures.crm_owners(spark, run.sf_dir, 1), 1)
    url = jdbc.embedded_url(run.root + "/jdbc-test")
    jdbc.write_table(owners, url, "OWNERS")
    jdbc.write_table(owners, url, "OWNERS")          # second load truncates, no duplicates
    back = jdbc.read_table(spark, url, "OWNERS", "registration_date", "2010-01-01",
                           "2019-12-31", 4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == owners.count()
    assert back.exceptAll(owners).count() == 0


def test_ingest_from_csv_and_jdbc_sources(spark, run):
    """Raw CSV feed plus CRM tables over JDBC into bronze, then one vault batch."""
    from vaultmart.plans.pipeline import Pipeline

    csv_path = f"{run.root}/ext/feed"
    raw = fixtures.property_raw(spark, run.sf_dir, 1).drop("_loaded_at")
    files.write_property_csv(raw, csv_path)
    url = jdbc.embedded_url(run.root + "/ext-crm")
    jdbc.write_table(fixtures.crm_owners(spark, run.sf_dir, 1), url, "OWNERS")
    jdbc.write_table(fixtures.crm_agents(spark, run.sf_dir, 1), url, "AGENTS")
    p = Pipeline(spark, run.sf_dir, root=f"{run.root}/ext/run")
    p.ingest_sources(1, csv_path, url, owners_table="OWNERS", agents_table="AGENTS",
                     loaded_at="2024-01-01 00:00:00")
    assert p.load_counts[("property_raw", 1)] == raw.count()
    p.stage(1)
    p.load_vault(1)
    for table in ["hub_transaction", "hub_owner", "hub_agent", "lnk_transaction_agent"]:
        assert p.hub(table, 1).count() == run.hub(table, 1).count(), table
    ours = p.satellite("sat_owner_details", 1).drop("load_end_date")
    theirs = run.satellite("sat_owner_details", 1).drop("load_end_date")
    assert ours.exceptAll(theirs).count() == 0


def test_command_line_runs_a_day_and_gates_on_quality(spark, run, capsys):
    from vaultmart.__main__ import main

    rc = main(["--sf-dir", run.sf_dir, "--root", f"{run.root}/cli", "--batches", "1", "--quality"])
    out = capsys.readouterr().out
    assert rc == 0 and '"hub_transaction@1"' in out and "FAIL" not in out
