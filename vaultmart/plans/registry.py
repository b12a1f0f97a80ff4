"""Named queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Vault, mart and quality queries share one pipeline run per session and
input folder (batches 1-3, written under the shared folder); the first query
that needs it pays for it.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.operators import quality, vault
from vaultmart.plans import dashboards, staging
from vaultmart.plans.pipeline import Pipeline
from vaultmart.plans.quality_delta import carry, quality_delta
from vaultmart.sources import fixtures

FIRST, LAST = 1, 3
AS_OF_INSTANT = "2024-01-01 12:00:00"
ONE_KEY = "30"  # a property with a late version

_RUNS: dict[tuple[str, str, str], Pipeline] = {}
_LOCK = threading.Lock()


def _run(spark: SparkSession, sf_dir: str, kind: str, load: Callable[[Pipeline], None]) -> Pipeline:
    """A finished run, shared by the queries of this session and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), kind)
    with _LOCK:
        run = _RUNS.get(key)
        if run is None:
            run = Pipeline(spark, sf_dir, prefix=f"{kind}_{hashlib.md5(key[1].encode()).hexdigest()[:8]}_")
            load(run)
            _RUNS[key] = run
    return run


def pipeline(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Batches 1-3."""
    return _run(spark, sf_dir, "full", lambda p: p.run())


def first_load(spark: SparkSession, sf_dir: str) -> Pipeline:
    """An empty vault's first batch, fed with every order (the feed of batch 2)."""
    return _run(spark, sf_dir, "first", lambda p: p.run_batch(1, with_marts=False, feed=2))


def gap(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Batch 1, then batch 3: number 2 never came."""
    return _run(spark, sf_dir, "gap", lambda p: p.run(batches=(1, 3), marts_for=()))


def replayed(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Batches 1-3, then batch 2 again: batch 3 is loaded again on top of it."""
    def load(p):
        p.run(marts_for=())
        p.run_batch(2, with_marts=False, replay=True)
    return _run(spark, sf_dir, "replay", load)


def resumed(spark: SparkSession, sf_dir: str) -> Pipeline:
    """Batches 1-3, then batch 2 again, broken off in its sixth insert; the next application on the run brings it to its end."""
    def load(p):
        p.run(marts_for=())
        insert, left = p.store._insert, iter(range(5))

        def breaks_off(*args, **options):
            if next(left, None) is None:
                raise OSError("broken off")
            insert(*args, **options)
        p.store._insert = breaks_off
        try:
            p.run_batch(2, with_marts=False, replay=True)
        except OSError:
            Pipeline(spark, sf_dir, root=p.root, prefix=p.prefix).resume_replay()
        p.store._insert = insert
    return _run(spark, sf_dir, "resumed", load)


def rebucketed(spark: SparkSession, sf_dir: str) -> Pipeline:
    """A run begun with a fiftieth of the sales; batch 2 brings all, into tables whose buckets part."""
    def load(p):
        p.store._bucket_bytes = 1 << 17  # of these small tables
        first = p.bronze_inputs(1)
        p.run_batch(1, with_marts=False, inputs=first | {"property_raw": first["property_raw"].where("cast(transaction_id as long) % 50 = 1")})
        p.run_batch(2, with_marts=False)
    return _run(spark, sf_dir, "rebucketed", load)


PIT_GRID = ["2024-01-01 12:00:00", "2024-01-02 12:00:00", "2024-01-03 12:00:00"]


def _as_of_indexed(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    index = p.point_in_time("sat_property_details", LAST, PIT_GRID)
    return vault.as_of_indexed(p.store.read_as_of("sat_property_details", LAST, PIT_GRID[1]), index, "property_hk", PIT_GRID[1])


def _jdbc_text_key(spark, sf_dir):
    """Owners reloaded in one transaction over older rows, then read in tasks split on their text id."""
    from vaultmart.sources import jdbc
    url, table = jdbc.embedded_url(pipeline(spark, sf_dir).root), f"SRC_CRM_OWNERS_{uuid.uuid4().hex[:12].upper()}"
    for batch in (2, 1):
        jdbc.reload_table(fixtures.with_loaded_at(fixtures.crm_owners(spark, sf_dir, batch), batch), url, table)
    return jdbc.read_split(spark, url, table, "owner_id", 4)


def _ingest_counts(spark, sf_dir):
    """Rows of every bronze table per batch, as the ingest saw them pass (S6), and whether the vault's rows carry one
    load instant per batch (S5)."""
    p = pipeline(spark, sf_dir)
    seen = [(t, b, n) for (t, b), n in sorted(p.load_counts.items())]
    stamps = [p.bronze(t, b).agg(F.countDistinct("_loaded_at").alias("load_instants")).select(
        F.lit(t).alias("table_name"), F.lit(b).cast("int").alias("batch"), "load_instants") for t, b, _ in seen]
    counts = spark.createDataFrame(seen, "table_name string, batch int, row_count long")
    return counts.join(reduce(DataFrame.unionByName, stamps), ["table_name", "batch"])


def _raw(spark, sf_dir, batch):
    return fixtures.property_raw(spark, sf_dir, batch)


def _gold(table: str, batch: int, source=pipeline) -> Callable[[SparkSession, str], DataFrame]:
    def q(spark, sf_dir):
        p = source(spark, sf_dir)
        return p.satellite(table, batch) if table.startswith("sat_") else p.hub(table, batch)
    return q


def _mart(table: str):
    return lambda spark, sf_dir: pipeline(spark, sf_dir).mart(table, LAST)


def _dash(fn, table: str):
    return lambda spark, sf_dir: fn(pipeline(spark, sf_dir).mart(table, LAST))


def _csv_round_trip(spark, sf_dir):
    from vaultmart.sources import files
    p = pipeline(spark, sf_dir)
    path = f"{p.root}/csv/property_raw-{uuid.uuid4().hex}"  # a frame of an earlier call still reads its own
    files.write_property_csv(_raw(spark, sf_dir, 2), path, compression="gzip")
    return files.read_property_csv(spark, path)


def _jdbc_round_trip(spark, sf_dir):
    from vaultmart.sources import jdbc
    p = pipeline(spark, sf_dir)
    owners = fixtures.with_loaded_at(fixtures.crm_owners(spark, sf_dir, 1), 1)
    url = jdbc.embedded_url(p.root)
    table = f"SRC_CRM_OWNERS_{uuid.uuid4().hex[:12].upper()}"
    jdbc.write_table(owners, url, table)
    return jdbc.read_table(spark, url, table, partition_column="registration_date",
                           lower="2010-01-01", upper="2019-12-31", partitions=4)


def _median_by_suburb(spark, sf_dir):
    p = pipeline(spark, sf_dir)
    return dashboards.median_price_by_suburb(
        p.mart("mart_property_sales", LAST), p._materializer_seq(f"median_suburb_{uuid.uuid4().hex}", LAST))


def _mart_sql_read(spark, sf_dir):
    """The view that the load itself has moved on to its last batch."""
    return spark.sql(f"SELECT * FROM `{pipeline(spark, sf_dir).prefix}mart`.mart_property_sales")


def _dq_delta(spark, sf_dir):
    """Each batch's violating values from those the batch before left, then the results after the last."""
    p = pipeline(spark, sf_dir)
    for batch in range(FIRST, LAST):
        carry(p, batch)
    return quality_delta(p, LAST)


def _dq_red(spark, sf_dir):
    """The runner over tables known to be bad: every kind of test must count violations."""
    t = quality.Test
    tests = [t("red", "lineitem", "l_orderkey", "unique"), t("red", "lineitem", "l_partkey", "unique"),
             t("red", "orders", "o_orderkey", "unique"), t("red", "property_raw", "agent_id", "not_null"),
             t("red", "property_raw", "transaction_id", "not_null"),
             t("red", "orders", "o_orderkey", "relationships", "lineitem", "l_orderkey"),
             t("red", "lineitem", "l_orderkey", "relationships", "orders", "o_orderkey")]
    tables = {n: fixtures.read_table(spark, sf_dir, n) for n in ("lineitem", "orders")}
    return quality.run_tests(tests, {**tables, "property_raw": _raw(spark, sf_dir, 2)},
                             {"lineitem": "l_orderkey"})


def _stg_properties_latest(spark, sf_dir):
    """Sales of one property that carry three load times, one of them null, with other attributes each."""
    c = F.col("transaction_id").cast("long") % 3
    raw = _raw(spark, sf_dir, 2).withColumns({
        "suburb": F.concat("suburb", F.element_at(F.array(*map(F.lit, ("-a", "-b", "-c"))), (c + 1).cast("int"))),
        "_loaded_at": F.when(c == 0, fixtures._ts(fixtures.BATCH_LOADED_AT[1]))
                       .when(c == 1, fixtures._ts(fixtures.BATCH_LOADED_AT[3]))})
    return staging.stg_properties(raw)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # bronze and silver (batch 2: every order, with its changes)
    "bronze_property_raw": lambda s, d: _raw(s, d, 2),
    "stg_transactions": lambda s, d: staging.stg_transactions(_raw(s, d, 2)),
    "stg_properties": lambda s, d: staging.stg_properties(_raw(s, d, 2)),
    "stg_properties_latest": _stg_properties_latest,
    "stg_owners": lambda s, d: staging.stg_owners(
        fixtures.with_loaded_at(fixtures.crm_owners(s, d, 2), 2)),
    "stg_agents": lambda s, d: staging.stg_agents(
        fixtures.with_loaded_at(fixtures.crm_agents(s, d, 2), 2)),
    # gold, first load
    **{t: _gold(t, FIRST, first_load) for t in [
        "hub_property", "hub_owner", "hub_agent", "hub_transaction",
        "lnk_transaction_property", "lnk_transaction_buyer", "lnk_transaction_seller",
        "lnk_transaction_agent", "sat_property_details", "sat_owner_details",
        "sat_agent_details", "sat_transaction_details"]},
    # gold after three batches
    **{f"{t}_incremental": _gold(t, LAST) for t in [
        "hub_property", "hub_owner", "hub_agent", "hub_transaction", "lnk_transaction_property",
        "lnk_transaction_buyer", "lnk_transaction_seller", "lnk_transaction_agent"]},
    "sat_property_gap": _gold("sat_property_details", LAST, gap),
    "hub_transaction_replay": _gold("hub_transaction", LAST, replayed),
    "sat_property_replay": _gold("sat_property_details", LAST, replayed),
    "sat_transaction_insert_only": _gold("sat_transaction_details", LAST),
    "sat_property_scd2": _gold("sat_property_details", LAST),
    "sat_owner_scd2": _gold("sat_owner_details", LAST),
    "sat_agent_scd2": _gold("sat_agent_details", LAST),
    "sat_property_current": lambda s, d: pipeline(s, d).current("sat_property_details", LAST),
    "hub_transaction_replay_resumed": _gold("hub_transaction", LAST, resumed),
    "hub_transaction_rebucketed": _gold("hub_transaction", 2, rebucketed),
    "sat_property_rebucketed": _gold("sat_property_details", 2, rebucketed),
    "sat_property_as_of": lambda s, d: pipeline(s, d).as_of("sat_property_details", LAST, AS_OF_INSTANT),
    "sat_property_as_of_indexed": _as_of_indexed,
    "sat_property_history": lambda s, d: vault.history(
        pipeline(s, d).satellite("sat_property_details", LAST), "property_hk"),
    "sat_property_one_key": lambda s, d: vault.key_history(
        pipeline(s, d).satellite("sat_property_details", LAST), "property_hk", ONE_KEY),
    "sat_property_one_key_latest": lambda s, d: vault.latest_version(
        pipeline(s, d).satellite("sat_property_details", LAST), "property_hk", ONE_KEY),
    # marts
    "mart_sql_read": _mart_sql_read,
    "mart_property_sales": _mart("mart_property_sales"),
    "mart_agent_performance": _mart("mart_agent_performance"),
    "mart_suburb_trends": _mart("mart_suburb_trends"),
    "mart_owner_portfolio": _mart("mart_owner_portfolio"),
    # quality
    "dq_results": lambda s, d: pipeline(s, d).quality(LAST),
    "dq_results_delta": _dq_delta,
    "dq_unique_violations": lambda s, d: quality.unique_violations(
        fixtures.read_table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]),
    "dq_orphans": lambda s, d: quality.relationship_violations(
        fixtures.read_table(s, d, "orders"), "o_orderkey",
        fixtures.read_table(s, d, "lineitem"), "l_orderkey"),
    "dq_null_agents": lambda s, d: quality.not_null_violations(_raw(s, d, 2), "agent_id")
        .select("transaction_id", "agent_id"),
    "dq_results_red": _dq_red,
    # dashboards
    "dash_sales_volume": _dash(dashboards.sales_volume, "mart_property_sales"),
    "dash_median_price_by_suburb": _median_by_suburb,
    "dash_sale_types": _dash(dashboards.sale_types, "mart_property_sales"),
    "dash_top_agents": _dash(dashboards.top_agents, "mart_agent_performance"),
    "dash_agent_days_on_market": _dash(dashboards.agent_days_on_market, "mart_agent_performance"),
    "dash_agent_price_vs_listing": _dash(dashboards.agent_price_vs_listing, "mart_agent_performance"),
    "dash_median_trend": _dash(dashboards.median_trend, "mart_suburb_trends"),
    "dash_heatmap": _dash(dashboards.heatmap, "mart_suburb_trends"),
    "dash_investor_split": _dash(dashboards.investor_split, "mart_owner_portfolio"),
    "dash_net_properties": _dash(dashboards.net_properties, "mart_owner_portfolio"),
    "dash_multi_property": _dash(dashboards.multi_property, "mart_owner_portfolio"),
    "layer_row_counts": lambda s, d: dashboards.row_counts(pipeline(s, d).layer_tables(LAST)),
    # connectors
    "csv_round_trip": _csv_round_trip,
    "jdbc_round_trip": _jdbc_round_trip,
    "jdbc_text_key_read": _jdbc_text_key,
    "ingest_counts": _ingest_counts,
}

