"""Gaps, broken batches, replays, streams on used runs, retention, schema checks."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from vaultmart.functions.hashing import as_text, hashdiff
from vaultmart.functions.numeric import pct_change_rounded
from vaultmart.operators import vault
from vaultmart.plans import registry
from vaultmart.plans.pipeline import HUBS, SATELLITES, Pipeline
from vaultmart.sources import fixtures
from vaultmart.sources import store as store_module
from vaultmart.sources.store import LayerStore, bucket_count
from vaultmart.streaming import micro_batch_loader

SF_SMALL = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def two(spark):
    p = Pipeline(spark, SF_SMALL, buckets=8, prefix="safety_")
    p.run(batches=(1, 2), marts_for=())
    return p


def test_order_rules(spark, two, monkeypatch):
    with pytest.raises(ValueError, match="replay"):
        two.run_batch(1, with_marts=False)
    before = {t: rows(two.satellite(t, 2)) for t in SATELLITES}

    def broken(self, *a, **k):
        raise OSError("lost while inserting")
    monkeypatch.setattr(LayerStore, "_insert", broken)
    with pytest.raises(OSError):
        two.run_batch(3, with_marts=False)
    monkeypatch.undo()
    with pytest.raises(RuntimeError, match="not finished"):
        two.run_batch(4, with_marts=False, feed=3)
    assert two.store.marked("finished") == [1, 2] and two.store.marked("started") == [1, 2, 3]
    # a later application on the same run sees the same, and runs the broken batch under its number
    again = Pipeline(spark, SF_SMALL, root=two.root)
    assert {t: rows(again.satellite(t, 2)) for t in SATELLITES} == before
    again.run_batch(3, with_marts=False)
    assert again.store.marked("finished") == [1, 2, 3]
    # replay: batch 2 again, batch 3 from its bronze
    want = {t: rows(again.satellite(t, 3)) for t in SATELLITES} | {t: rows(again.hub(t, 3)) for t in HUBS}
    again.run_batch(2, with_marts=False, replay=True)
    assert {t: rows(again.satellite(t, 3)) for t in SATELLITES} | {t: rows(again.hub(t, 3)) for t in HUBS} == want
    # retention: reads as of the last two of five batches, and what an older base would need is released
    monkeypatch.setattr(store_module, "COMPACT_SHARE", -1.0)  # every batch writes all open rows
    again.keep_open = 2
    for b in (4, 5):
        again.run_batch(b, with_marts=False, feed=3)
    for t in SATELLITES:
        assert [again.store.has_open(t, b) for b in (1, 2, 3, 4, 5)] == [False, False, False, True, True]
        assert rows(again.satellite(t, 5)) == rows(again.satellite(t, 4)) == want[t]
    with pytest.raises(ValueError, match="keep_open"):
        again.run_batch(2, with_marts=False, replay=True)


def test_new_stream_goes_on_after_the_batches_there(spark):
    p = Pipeline(spark, SF_SMALL)
    p.run_batch(1, with_marts=False)

    def crm(batch):
        return {"src_crm_owners": fixtures.with_loaded_at(fixtures.crm_owners(spark, SF_SMALL, batch), batch),
                "src_crm_agents": fixtures.with_loaded_at(fixtures.crm_agents(spark, SF_SMALL, batch), batch)}
    load = micro_batch_loader(p, crm, lambda b: fixtures.BATCH_LOADED_AT[b], stream="drops", with_marts=False)
    raw = fixtures.property_raw(spark, SF_SMALL, 2).drop("_loaded_at")
    load(raw, 0)
    load(raw, 0)  # delivered again after a restart
    assert p.store.marked("finished") == [1, 2]
    assert p.hub("hub_transaction", 2).count() == 1500


def test_touched_and_untouched_rows_are_separate_and_unshuffled(spark, two):
    last = two.store.marked("finished")[-1]
    staged, open_rows = two.staged("stg_owners", last), two.store.read_open("sat_owner_details", last - 1)
    out = vault.load_satellite(staged, "owner_hk", SATELLITES["sat_owner_details"][2], open_rows, None,
                               materialize=two._materializer("plan_test", last))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        write = two.store._by_bucket(out.untouched, "owner_hk")
        plan = write._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "REPARTITION" not in plan


def test_columns_must_match_the_table(two):
    hub = two.hub("hub_owner", 1)
    swapped = hub.withColumnRenamed("owner_id", "id")
    fq = two.store.name("gold", "hub_owner")
    with pytest.raises(ValueError, match="do not match"):
        two.store._insert(swapped, fq, 9, [])
    with pytest.raises(ValueError, match="do not match"):
        two.store._insert(hub.withColumn("owner_id", F.lit(1)), fq, 9, [])
    assert 9 not in two.store.batches("gold", "hub_owner")


@pytest.mark.parametrize("size,want", [(0, 1), (1 << 30, 1), (1 << 40, 1024), (100 << 40, 1 << 17)])
def test_bucket_count(size, want):
    assert bucket_count(size) == want


def test_bucket_count_follows_the_given_inputs(spark):
    p = Pipeline(spark, "/nowhere", bucket_bytes=2000, prefix="fits_")  # no orders table: counts come from what was written
    feed = Pipeline(spark, SF_SMALL, prefix=None)
    p.run_batch(1, with_marts=False, inputs=feed.bronze_inputs(1))
    n = {k: p.store.buckets(k) for k in ("transaction_hk", "property_hk", "agent_hk")}
    assert n["transaction_hk"] >= 8 and n["agent_hk"] <= n["property_hk"] < n["transaction_hk"]


def test_queries_can_be_called_twice(spark, run, monkeypatch):
    key = (spark.sparkContext.applicationId, SF_SMALL, "full")
    monkeypatch.setitem(registry._RUNS, key, run)
    for name in ("csv_round_trip", "jdbc_round_trip", "dash_median_price_by_suburb"):
        first = registry.QUERIES[name](spark, SF_SMALL)
        second = registry.QUERIES[name](spark, SF_SMALL)
        assert rows(first) == rows(second)


def test_negative_base_and_null_safe_hashdiff(spark):
    one = spark.range(1).select(
        pct_change_rounded(F.lit("100.00").cast("decimal(14,2)"), F.lit("-3.00").cast("decimal(14,2)")).cast("string").alias("p"),
        hashdiff(F.lit("a"), F.lit(None).cast("string")).alias("x"), hashdiff(F.lit(None).cast("string"), F.lit("a")).alias("y"),
        hashdiff(as_text(F.lit("a")), F.lit(None).cast("string"), null_safe=True).alias("u"),
        hashdiff(F.lit(None).cast("string"), F.lit("a"), null_safe=True).alias("v")).first()
    assert one.p == "-3433.33" and one.x == one.y and one.u != one.v


def test_jdbc_settings(monkeypatch):
    from vaultmart.sources import jdbc
    monkeypatch.setenv("VAULTMART_JDBC_URL", "jdbc:derby:memory:x")
    monkeypatch.setenv("VAULTMART_JDBC_USER", "me")
    assert jdbc.settings_from_env() == ("jdbc:derby:memory:x", {"user": "me", "driver": jdbc.DERBY_DRIVER})
