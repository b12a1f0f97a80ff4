import datetime as dt
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from vaultmart.operators import vault

D1, D2, D3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
LATE = dt.datetime(2023, 12, 31)


def _expected_versions(p: int):
    """FIXTURES.md section 4, as (load_date, load_end_date, suburb suffix)."""
    if p % 20 == 0:
        return [(D1, D2, ""), (D2, D3, "-updated"), (D3, None, "")]
    if p % 100 == 30:
        return [(LATE, D2, "-late"), (D1, D2, ""), (D2, None, "-updated")]
    if p % 100 == 50:
        return [(D1, D2, ""), (D2, None, "-replaced")]
    if p % 10 == 0:
        return [(D1, D2, ""), (D2, None, "-updated")]
    if p % 10 == 1:
        return [(D2, None, "")]
    return [(D1, None, "")]


def _property_history(run, batch):
    hub = run.hub("hub_property", batch).select("property_hk", "property_id")
    sat = run.satellite("sat_property_details", batch).join(hub, "property_hk")
    brand = run.spark.read.parquet(f"{run.sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("property_id"), "p_brand")
    rows = sat.join(brand, "property_id").select(
        "property_id", "load_date", "load_end_date", "suburb", "p_brand").collect()
    got = defaultdict(list)
    for r in rows:
        assert r.suburb.startswith(r.p_brand)
        got[int(r.property_id)].append((r.load_date, r.load_end_date, r.suburb[len(r.p_brand):]))
    return {k: sorted(v) for k, v in got.items()}


def test_property_versions_per_key_class(run):
    got = _property_history(run, 3)
    assert len(got) == 200
    for p, versions in got.items():
        assert versions == sorted(_expected_versions(p)), (p, versions)


def test_resending_batch_three_changes_nothing(run):
    for table in ["sat_property_details", "sat_owner_details", "sat_agent_details",
                  "sat_transaction_details"]:
        b3 = Counter(tuple(r) for r in run.satellite(table, 3).collect())
        b4 = Counter(tuple(r) for r in run.satellite(table, 4).collect())
        assert b3 == b4, table
    for table in ["hub_property", "hub_transaction", "lnk_transaction_agent"]:
        assert run.hub(table, 4).count() == run.hub(table, 3).count()


def test_one_open_version_per_key(run):
    for table, hk in [("sat_property_details", "property_hk"), ("sat_owner_details", "owner_hk"),
                      ("sat_agent_details", "agent_hk")]:
        cur = run.current(table, 3)
        assert cur.count() == cur.select(hk).distinct().count()
        assert cur.where(F.col("load_end_date").isNotNull()).count() == 0


def test_owner_and_agent_changes(run):
    owners = run.satellite("sat_owner_details", 3).join(
        run.hub("hub_owner", 3).select("owner_hk", "owner_id"), "owner_hk")
    per_owner = Counter(int(r.owner_id) for r in owners.select("owner_id").collect())
    assert all(n == (2 if k % 20 == 0 else 1) for k, n in per_owner.items())
    agents = run.satellite("sat_agent_details", 3).join(
        run.hub("hub_agent", 3).select("agent_hk", "agent_id"), "agent_hk")
    per_agent = Counter(int(r.agent_id) for r in agents.select("agent_id").collect())
    # agents 0 mod 5 turn platinum in batch 2; those already platinum do not change
    assert all(n == (2 if k % 5 == 0 and k % 4 != 3 else 1) for k, n in per_agent.items())
    # batch 3 repeats batch 2 for the CRM tables: nothing new
    assert run.satellite("sat_owner_details", 3).count() == run.satellite("sat_owner_details", 2).count()


def test_insert_only_satellite_and_links_ignore_later_changes(run):
    hub = run.hub("hub_transaction", 3).select("transaction_hk", "transaction_id")
    sat = run.satellite("sat_transaction_details", 3).join(hub, "transaction_hk")
    orders = run.spark.read.parquet(f"{run.sf_dir}/orders.parquet")
    cmp = sat.join(orders, sat.transaction_id == orders.o_orderkey.cast("string"))
    assert cmp.where(F.col("sale_price") != F.col("o_totalprice").cast("decimal(14,2)")).count() == 0
    assert sat.count() == orders.count()
    first_seen = Counter((r.load_date, int(r.transaction_id) % 10 == 9)
                         for r in sat.select("load_date", "transaction_id").collect())
    assert set(first_seen) == {(D1, False), (D2, True)}


def test_loaders_dedupe_within_a_batch(spark):
    staged = spark.createDataFrame(
        [("h1", "a", D2, "src"), ("h1", "a", D1, "src"), ("h2", "b", D1, "src")],
        "k string, id string, load_date timestamp_ntz, record_source string")
    hub = vault.load_hub(staged, "k", "id")
    assert sorted((r.k, r.load_date) for r in hub.collect()) == [("h1", D1), ("h2", D1)]
    target = spark.createDataFrame([("h2",)], "k string")
    assert [r.k for r in vault.load_hub(staged, "k", "id", target).collect()] == ["h1"]


def test_satellite_rules_on_small_frames(spark):
    schema = "k string, a string, hashdiff string, load_date timestamp_ntz, record_source string"
    first = spark.createDataFrame([("k1", "x", "hx", D1, "s"), ("k2", "y", "hy", D1, "s")], schema)
    b1 = vault.load_satellite(first, "k", ["a"], None, None, materialize=lambda d: d.checkpoint())
    assert b1.closed.count() == 0 and b1.open.count() == 2
    # k1 changes, k2 is unchanged, k3 is new; k1 also gets a late row
    second = spark.createDataFrame([("k1", "z", "hz", D2, "s"), ("k2", "y", "hy", D2, "s"),
                                    ("k3", "w", "hw", D2, "s")], schema)
    b2 = vault.load_satellite(second, "k", ["a"], b1.open, None,
                              materialize=lambda d: d.checkpoint())
    assert b2.n_changed == 2
    opened = {r.k: (r.a, r.load_date) for r in b2.open.collect()}
    assert opened == {"k1": ("z", D2), "k2": ("y", D1), "k3": ("w", D2)}
    closed = [(r.k, r.a, r.load_date, r.load_end_date) for r in b2.closed.collect()]
    assert closed == [("k1", "x", D1, D2)]
    late = spark.createDataFrame([("k1", "q", "hq", LATE, "s")], schema)
    b3 = vault.load_satellite(late, "k", ["a"], b2.open, b2.closed,
                              materialize=lambda d: d.checkpoint())
    closed3 = sorted((r.a, r.load_date, r.load_end_date) for r in b3.closed.collect())
    assert closed3 == [("q", LATE, D2)] and not b3.closed_is_full
    # the same late row again replaces its own closed copy (full closed rewrite)
    b4 = vault.load_satellite(late, "k", ["a"], b3.open, b2.closed.unionByName(b3.closed),
                              materialize=lambda d: d.checkpoint())
    assert b4.closed_is_full
    assert sorted((r.a, r.load_date, r.load_end_date) for r in b4.closed.collect()) == [
        ("q", LATE, D2), ("x", D1, D2)]


def test_as_of_prefers_latest_load_on_overlap(run):
    sat = run.satellite("sat_property_details", 3)
    hub = run.hub("hub_property", 3).select("property_hk", "property_id")
    at = vault.as_of(sat, "property_hk", "2024-01-01 12:00:00").join(hub, "property_hk")
    rows = {int(r.property_id): (r.load_date, r.suburb) for r in at.collect()}
    assert all(p % 10 != 1 for p in rows)
    assert rows[30][0] == D1 and not rows[30][1].endswith("-late")


def test_rerunning_a_batch_is_idempotent(run):
    """The last batch loaded again under its own number replaces only its partitions."""
    tables = ["sat_property_details", "sat_owner_details", "sat_transaction_details"]
    before = {t: Counter(tuple(r) for r in run.satellite(t, 4).collect()) for t in tables}
    hubs = {t: run.hub(t, 4).count() for t in ["hub_property", "lnk_transaction_property"]}
    run.run_batch(4, with_marts=False, feed=3)
    for t in tables:
        assert Counter(tuple(r) for r in run.satellite(t, 4).collect()) == before[t], t
    for t, n in hubs.items():
        assert run.hub(t, 4).count() == n


def test_a_later_application_continues_the_run(spark, run):
    """Batches 1-2 in one 'application', batch 3 in the next (catalog entries gone)."""
    from vaultmart.plans.pipeline import Pipeline

    first = Pipeline(spark, run.sf_dir, root=f"{run.root}/resume")
    first.run(batches=(1, 2), marts_for=())
    for (name,) in spark.sql(f"SHOW TABLES IN {first.store.db}").select("tableName").collect():
        spark.sql(f"DROP TABLE {first.store.db}.{name}")      # external: files stay
    second = Pipeline(spark, run.sf_dir, root=first.root)
    assert second.store.batches("gold", "hub_transaction") == [1, 2]
    second.run_batch(3, with_marts=False)
    for t in ["sat_property_details", "sat_owner_details", "sat_transaction_details"]:
        a = Counter(tuple(r) for r in second.satellite(t, 3).collect())
        b = Counter(tuple(r) for r in run.satellite(t, 3).collect())
        assert a == b, t
    assert second.hub("hub_property", 3).count() == run.hub("hub_property", 3).count()


def test_load_report_counts_new_keys_and_duplicates(run):
    orders = run.spark.read.parquet(f"{run.sf_dir}/orders.parquet")
    late_keys = orders.where(F.col("o_orderkey") % 10 == 9).count()
    rep = run.load_report[("hub_transaction", 2)]
    assert rep["written"] == late_keys and rep["duplicates"] == 0
    assert rep["staged"] == orders.count()
    assert run.load_report[("lnk_transaction_agent", 1)]["written"] == orders.count() - late_keys
    assert run.load_report[("sat_property_details", 1)]["changed"] == run.hub("hub_property", 1).count()
