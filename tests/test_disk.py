"""What a run leaves on disk: no shuffle files of its writes, no work files, no column that others determine, zstd."""

from __future__ import annotations

import os
from collections import Counter
from glob import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from vaultmart.functions.hashing import as_text, hash_key, hashdiff
from vaultmart.plans import marts, registry, staging
from vaultmart.plans.pipeline import BRONZE_OF, HUBS, LINKS, SATELLITES, Pipeline
from vaultmart.session import FREE_SHUFFLES, shuffles_freed

SF_SMALL = "/root/testdata/sf0.001"


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def inputs(spark, feed):
    """The bronze inputs of a batch with few rows: every 20th sale."""
    made = Pipeline(spark, SF_SMALL, prefix=None).bronze_inputs(feed)
    return made | {"property_raw": made["property_raw"].where("cast(transaction_id as long) % 20 < 2")}


@pytest.fixture(scope="module")
def two(spark):
    p = Pipeline(spark, SF_SMALL, buckets=2, prefix="disk_")
    p.run_batch(1, with_marts=False, inputs=inputs(spark, 1))
    p.run_batch(2, inputs=inputs(spark, 2))
    return p


def parquet_files(p, *parts):
    top = p.root.removeprefix("file:")
    return [f for part in parts for f in glob(f"{top}/{part}/**/*.parquet", recursive=True)]


def shuffle_files(spark):
    kept = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(kept.apply(i).getName()) for i in range(kept.size()) if kept.apply(i).getName().startswith("shuffle_")}


def test_silver_stores_no_column_that_others_determine(spark, two):
    for name, source in BRONZE_OF.items():
        for batch in (1, 2):
            whole = getattr(staging, name)(two.bronze(source, batch))
            assert two.staged(name, batch).schema.names == whole.schema.names
            assert two.staged(name, batch).dtypes == whole.dtypes and rows(two.staged(name, batch)) == rows(whole)
        held = {c for f in parquet_files(two, f"silver/{name}") for c in pq.read_schema(f).names}
        assert held == set(whole.columns) - set(staging.DERIVED[name])
        assert rows(spark.table(f"disk_silver.{name}").select(*whole.columns)) == rows(whole)
        assert spark.table(f"disk_silver.{name}").columns == whole.columns


def test_hashes_as_sql_are_those_of_the_functions(spark):
    odd = spark.createDataFrame(
        [("t1", "p1", None, "o2", None, None, None, 7, None), ("t2", None, "o1", "", "a", "1.50", "2024-02-29", None, "auction")],
        "transaction_id string, property_id string, buyer_id string, seller_id string, agent_id string, sale_price string, "
        "sale_date string, days_on_market int, sale_type string").withColumns({"settlement_date": F.lit(None).cast("string"), "_loaded_at": F.lit(None)})
    staged = staging.stg_transactions(odd)
    want = staged.select(*[hash_key(f"{c}_id") for c in ("property", "buyer", "seller", "agent")],
                         hashdiff(as_text("sale_price"), as_text("sale_date"), as_text("settlement_date"), as_text("days_on_market"), F.col("sale_type")))
    assert rows(staged.select(*staging.DERIVED["stg_transactions"])) == rows(want)
    owner = spark.createDataFrame([("o", None, "e", None, "", "s", None, True)], "owner_id string, full_name string, email string, phone string, "
                                  "suburb string, state string, registration_date string, investor_flag boolean").withColumn("_loaded_at", F.lit(None))
    staged = staging.stg_owners(owner)
    want = hashdiff(*[as_text(c, True) for c in ("full_name", "email", "phone", "suburb", "state")], as_text("registration_date"), as_text("investor_flag"))
    assert rows(staged.select("hashdiff")) == rows(staged.select(want))


def test_tables_are_compressed_with_zstd(two):
    found = parquet_files(two, "bronze", "silver", "gold/hub_transaction", "gold/lnk_transaction_buyer", "gold/sat_property_details/b2", "mart")
    codecs = [pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in found if pq.ParquetFile(f).metadata.num_row_groups]
    assert len(codecs) > 10 and set(codecs) == {"ZSTD"}


def test_a_write_frees_its_shuffle_files_and_work_files(spark, two):
    work = f"{two.root.removeprefix('file:')}/work"
    assert not [d for d, _, names in os.walk(work) if names]
    before, setting = shuffle_files(spark), spark.conf.get(FREE_SHUFFLES)
    grouped = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    two.store.write_files(grouped, f"{two.root}/trial")
    two.store.write_bucketed(two.staged("stg_owners", 2).repartition(3, "owner_id"), "silver", "stg_owners", "owner_hk", 9)
    assert shuffle_files(spark) <= before and spark.conf.get(FREE_SHUFFLES) == setting
    assert spark.read.parquet(f"{two.root}/trial").count() == 100
    with shuffles_freed(spark), pytest.raises(OSError):
        with shuffles_freed(spark):  # writes overlap, and one fails
            raise OSError
    assert spark.conf.get(FREE_SHUFFLES) == setting
    with shuffles_freed(spark):
        with shuffles_freed(spark):
            pass
        assert spark.conf.get(FREE_SHUFFLES) == "true"
    assert spark.conf.get(FREE_SHUFFLES) == setting


def test_a_run_whose_tables_hold_the_derived_columns_goes_on(spark, two):
    old = Pipeline(spark, SF_SMALL, buckets=2, prefix=None)
    old.store._derived = {}  # as before
    old.run_batch(1, with_marts=False, inputs=inputs(spark, 1))
    now = Pipeline(spark, SF_SMALL, root=old.root, prefix=None)
    now.run_batch(2, inputs=inputs(spark, 2))
    for name in BRONZE_OF:
        assert now.staged(name, 2).dtypes == two.staged(name, 2).dtypes and rows(now.staged(name, 2)) == rows(two.staged(name, 2))
    for t in [*HUBS, *LINKS, *SATELLITES, "sat_transaction_details"]:
        assert rows(now.satellite(t, 2) if t in SATELLITES else now.hub(t, 2)) == rows(two.satellite(t, 2) if t in SATELLITES else two.hub(t, 2))
    assert rows(now.mart("mart_property_sales", 2)) == rows(two.mart("mart_property_sales", 2))


def exchanged(df):
    """The columns of every exchange in the plan of ``df``."""
    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            return walk(node.initialPlan())
        mine = [{node.output().apply(i).name() for i in range(node.output().size())}] if node.getClass().getSimpleName() == "ShuffleExchangeExec" else []
        return mine + [x for i in range(node.children().size()) for x in walk(node.children().apply(i))]
    return walk(df._jdf.queryExecution().executedPlan())


def test_a_staged_sale_is_shuffled_without_its_hashes(two, monkeypatch):
    written = []
    monkeypatch.setattr(two.store, "_insert", lambda df, *_: written.append(df))
    two._stage_one("stg_transactions", 2)
    [held] = exchanged(written[0])
    assert "transaction_id" in held and not [c for c in held if c.endswith("_hk") or c == "hashdiff"]
    files = {f.rsplit("/", 1)[1].split("_")[-1] for f in parquet_files(two, "silver/stg_transactions/b2/batch=2")}
    assert len(files) == len(parquet_files(two, "silver/stg_transactions/b2/batch=2")) == 2  # still one file a bucket


def test_a_sale_is_shuffled_before_its_property_is_joined(spark, two):
    """Exchanges that hold a sale's own columns carry no property column (the widest of the star join)."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = [o for o in exchanged(marts.mart_property_sales(two.vault_view(2))) if "transaction_id" in o]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(sales) == 2 and not any("address" in o for o in sales), sales


def test_csv_round_trip_is_compressed(spark, monkeypatch, two):
    monkeypatch.setattr(registry, "pipeline", lambda s, d: two)
    again = registry.QUERIES["csv_round_trip"](spark, SF_SMALL)
    assert all(f.endswith(".csv.gz") for f in again.inputFiles())
    assert rows(again) == rows(registry.QUERIES["bronze_property_raw"](spark, SF_SMALL))
