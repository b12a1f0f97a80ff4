"""One batch, layer by layer: bronze -> silver -> gold -> mart (-> quality).

Every layer is written to the run's folder before the next reads it, so
each stage re-reads Parquet instead of re-running the plan before it (a lost
executor re-runs one stage, not the whole day's lineage).  Vault loads of
one batch only depend on staging, so they run as concurrent Spark jobs.
"""

from __future__ import annotations

import itertools
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultmart.functions.hashing import hash_key_sql
from vaultmart.operators import quality, vault
from vaultmart.plans import marts, staging
from vaultmart.session import new_run_dir
from vaultmart.sources import fixtures
from vaultmart.sources.journal import Listed
from vaultmart.sources.published import APPENDED, BATCH, FILES, VERSIONS, Published
from vaultmart.sources.store import TASK_BYTES, TASK_ROWS, LayerStore

# Which staged entity feeds which vault table, with its keys
# and attribute columns in table order.
HUBS = {
    "hub_property": ("stg_properties", "property_hk", "property_id"),
    "hub_owner": ("stg_owners", "owner_hk", "owner_id"),
    "hub_agent": ("stg_agents", "agent_hk", "agent_id"),
    "hub_transaction": ("stg_transactions", "transaction_hk", "transaction_id"),
}
LINKS = {
    "lnk_transaction_property": ("property_hk", "property_hk"),
    "lnk_transaction_buyer": ("buyer_hk", "owner_hk"),
    "lnk_transaction_seller": ("seller_hk", "owner_hk"),
    "lnk_transaction_agent": ("agent_hk", "agent_hk"),
}
SATELLITES = {
    "sat_property_details": ("stg_properties", "property_hk",
                             ["address", "suburb", "postcode", "state", "bedrooms", "bathrooms",
                              "land_size_sqm", "property_type", "year_built", "listing_price"]),
    "sat_owner_details": ("stg_owners", "owner_hk",
                          ["full_name", "email", "phone", "suburb", "state",
                           "registration_date", "investor_flag"]),
    "sat_agent_details": ("stg_agents", "agent_hk",
                          ["full_name", "email", "agency_name", "license_no", "region",
                           "accreditation_tier", "active_from"]),
}
INSERT_ONLY_SATELLITES = {
    "sat_transaction_details": ("stg_transactions", "transaction_hk",
                                ["sale_price", "sale_date", "settlement_date",
                                 "days_on_market", "sale_type"]),
}
BRONZE_TABLES = ["property_raw", "src_crm_owners", "src_crm_agents"]
STAGING_TABLES = ["stg_transactions", "stg_properties", "stg_owners", "stg_agents"]
# The hash key each staged entity is bucketed by.
STAGING_KEYS = {"stg_transactions": "transaction_hk", "stg_properties": "property_hk",
                "stg_owners": "owner_hk", "stg_agents": "agent_hk"}
MART_TABLES = ["mart_property_sales", "mart_agent_performance", "mart_suburb_trends",
               "mart_owner_portfolio"]


# The bronze table each staged entity comes from.
BRONZE_OF = {"stg_transactions": "property_raw", "stg_properties": "property_raw",
             "stg_owners": "src_crm_owners", "stg_agents": "src_crm_agents"}
# The hash key every bucketed table is keyed by, and what a view shows of each table.
KEYS = {**{("silver", t): k for t, k in STAGING_KEYS.items()},
        **{("gold", t): hk for t, (_, hk, _) in {**HUBS, **SATELLITES, **INSERT_ONLY_SATELLITES}.items()},
        **{("gold", t): "transaction_hk" for t in LINKS},
        **{("gold", t.replace("sat_", "pit_")): hk for t, (_, hk, _) in SATELLITES.items()}}
VIEWS = [*(("bronze", t, FILES) for t in BRONZE_TABLES), *(("silver", t, BATCH) for t in STAGING_TABLES),
         *(("gold", t, APPENDED) for t in [*HUBS, *LINKS, *INSERT_ONLY_SATELLITES]),
         *(("gold", t, VERSIONS) for t in SATELLITES), *(("mart", t, FILES) for t in MART_TABLES)]


@dataclass
class Pipeline:
    """The tables of one run, stored under ``root`` in the shared folder."""

    spark: SparkSession
    sf_dir: str
    root: str | None = None
    threads: int = 8
    buckets: int | None = None  # a fixed count; by default counts follow the data
    bucket_bytes: int = TASK_BYTES
    bucket_rows: int = TASK_ROWS
    keep_open: int | None = 3  # the last batches as of which satellites can be read; None: all
    prefix: str | None = ""  # of the databases whose views show the last batch; None: no views
    load_counts: dict = field(default_factory=dict)
    load_report: dict = field(default_factory=dict)
    load_seconds: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.root is None:
            self.root = new_run_dir(self.spark, "run")
        self.store = LayerStore(self.spark, self.root, KEYS, self.buckets, self.bucket_bytes, self.bucket_rows,
                                {("silver", t): columns for t, columns in staging.DERIVED.items()})
        for layer, table in KEYS:  # tables of an earlier application on the same run folder
            self.store.attach(layer, table, satellite=table in SATELLITES)
        self.published = None if self.prefix is None else Published(self.store, self.prefix, VIEWS)
        if self.published and self.published.shown() != (0, 0):
            self.published.show(*self.published.shown())
        self._sizes = None

    # -- helpers -----------------------------------------------------------------
    @property
    def sizes(self) -> fixtures.FeedSizes:
        if self._sizes is None:
            self._sizes = fixtures.feed_sizes(self.spark, self.sf_dir)
        return self._sizes

    def _materializer(self, name: str, batch: int):
        def write_and_read(df: DataFrame) -> DataFrame:
            path = f"{self.root}/work/{name}/batch={batch}"
            self.store.write_files(df, path)
            return self.spark.read.parquet(path)
        return write_and_read

    def _drop_work(self, name: str) -> None:
        """Remove what a step wrote for itself, once nothing reads it any more."""
        self.store._delete(f"{self.root}/work/{name}")

    def _materializer_seq(self, name: str, batch: int):
        """A materializer that writes each call to its own folder."""
        calls = itertools.count()
        return lambda df: self._materializer(f"{name}/{next(calls)}", batch)(df)

    def _parallel(self, jobs):
        with ThreadPoolExecutor(max_workers=self.threads) as pool:
            for f in [pool.submit(j) for j in jobs]:
                f.result()

    # -- bronze ------------------------------------------------------------------
    def bronze_inputs(self, feed: int) -> dict[str, DataFrame]:
        """The derived source tables of fixture batch ``feed`` (FIXTURES.md)."""
        return {
            "property_raw": fixtures.property_raw(self.spark, self.sf_dir, feed, self.sizes),
            "src_crm_owners": fixtures.with_loaded_at(
                fixtures.crm_owners(self.spark, self.sf_dir, feed), feed),
            "src_crm_agents": fixtures.with_loaded_at(
                fixtures.crm_agents(self.spark, self.sf_dir, feed), feed),
        }

    def ingest(self, batch: int, feed: int | None = None,
               inputs: dict[str, DataFrame] | None = None) -> None:
        """Write the batch's bronze tables, counting rows in the same pass.

        ``inputs`` gives the source tables directly (e.g. a micro-batch);
        otherwise fixture batch ``feed`` (default: ``batch``) is derived.
        """
        sources = inputs if inputs is not None else self.bronze_inputs(feed or batch)

        def job(name, df):
            def run():
                obs = Observation(f"{name}_{batch}_{uuid.uuid4().hex[:8]}")
                self.store.write_version(df.observe(obs, F.count(F.lit(1)).alias("rows")),
                                         "bronze", name, batch)
                self.load_counts[(name, batch)] = obs.get["rows"]
            return run
        self._parallel([job(n, df) for n, df in sources.items()])

    def ingest_sources(self, batch: int, csv_path: str, jdbc_url: str,
                       jdbc_properties: dict | None = None, loaded_at: str | None = None,
                       owners_table: str = "src_crm.owners",
                       agents_table: str = "src_crm.agents",
                       jdbc_options: dict[str, dict] | None = None) -> None:
        """Bronze from external sources (S7): the raw CSV feed, then the two CRM
        tables over JDBC, each with the batch's audit instant.

        ``jdbc_options`` gives per table (``src_crm_owners``, ``src_crm_agents``) the
        range to split its read on: ``partition_column``, ``lower``, ``upper``,
        ``partitions``, ``fetch_size``; without it a table is one task."""
        from vaultmart.sources import files, jdbc

        # a fixed instant makes a rerun exact; by default the time of the load
        stamp = (F.lit(loaded_at).cast("timestamp_ntz") if loaded_at else F.localtimestamp())
        raw = files.read_property_csv(self.spark, csv_path, with_loaded_at=False)
        options = jdbc_options or {}
        crm = {n: jdbc.read_table(self.spark, jdbc_url, t, properties=jdbc_properties, **options.get(n, {}))
               for n, t in (("src_crm_owners", owners_table), ("src_crm_agents", agents_table))}
        self.ingest(batch, inputs={
            "property_raw": raw.withColumn("_loaded_at", stamp),
            **{n: df.withColumn("_loaded_at", stamp) for n, df in crm.items()}})

    def bronze(self, name: str, batch: int) -> DataFrame:
        return self.store.read_version("bronze", name, batch)

    # -- silver ------------------------------------------------------------------
    def _stage_one(self, name: str, batch: int) -> None:
        plan = {
            "stg_transactions": lambda: staging.stg_transactions(self.bronze("property_raw", batch)),
            "stg_properties": lambda: staging.stg_properties(self.bronze("property_raw", batch)),
            "stg_owners": lambda: staging.stg_owners(self.bronze("src_crm_owners", batch)),
            "stg_agents": lambda: staging.stg_agents(self.bronze("src_crm_agents", batch)),
        }[name]()
        self.store.fit(STAGING_KEYS[name], *self._grain_size(name, batch, len(plan.columns)))
        self.store.write_bucketed(plan, "silver", name, STAGING_KEYS[name], batch, hash_key_sql(staging.BUSINESS_KEYS[name]))

    def _grain_size(self, name: str, batch: int, columns: int) -> tuple[float, float]:
        """About the bytes and rows of a batch of one staged entity: the bronze table's, the bytes by its share of
        columns and, where many bronze rows make one row, both by distinct ids (one column is read)."""
        source = self.store.path("bronze", BRONZE_OF[name], f"batch={batch}")
        bronze = self.bronze(BRONZE_OF[name], batch)
        size = self.store.folder_bytes(source) * min(1.0, columns / len(bronze.columns))
        if name != "stg_properties":
            return size, bronze.count()
        n = bronze.agg(F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("property_id").alias("ids")).first()
        return size * n["ids"] / max(1, n["rows"]), n["ids"]

    def stage(self, batch: int) -> None:
        self._parallel([(lambda n=n: self._stage_one(n, batch)) for n in STAGING_TABLES])

    def staged(self, name: str, batch: int) -> DataFrame:
        return self.store.read_batch("silver", name, batch)

    # -- gold --------------------------------------------------------------------
    def _load_hub(self, table: str, batch: int) -> None:
        stg, hk, bk = HUBS[table]
        target = self.store.read_appended("gold", table, batch - 1)
        report = vault.LoadReport()
        rows = vault.load_hub(self.staged(stg, batch), hk, bk, target, report)
        self.store.write_bucketed(rows, "gold", table, hk, batch)
        self.load_report[(table, batch)] = report.values()

    def _load_link(self, table: str, batch: int) -> None:
        src, other = LINKS[table]
        target = self.store.read_appended("gold", table, batch - 1)
        report = vault.LoadReport()
        rows = vault.load_link(self.staged("stg_transactions", batch), "transaction_hk",
                               src, other, target, report)
        self.store.write_bucketed(rows, "gold", table, "transaction_hk", batch)
        self.load_report[(table, batch)] = report.values()

    def _load_insert_only(self, table: str, batch: int) -> None:
        stg, hk, attrs = INSERT_ONLY_SATELLITES[table]
        target = self.store.read_appended("gold", table, batch - 1)
        report = vault.LoadReport()
        rows = vault.load_insert_only_satellite(self.staged(stg, batch), hk, attrs, target, report)
        self.store.write_bucketed(rows, "gold", table, hk, batch)
        self.load_report[(table, batch)] = report.values()

    def _load_satellite(self, table: str, batch: int) -> None:
        stg, hk, attrs = SATELLITES[table]
        out = vault.load_satellite(
            self.staged(stg, batch), hk, attrs,
            open_prev=self.store.read_open(table, batch - 1),
            closed_prev=self.store.read_closed(table, batch - 1),
            materialize=self._materializer(f"{table}_changes", batch),
            force_full_closed=self.store.has_base(table, batch))
        self.store.write_satellite(out, table, hk, batch)
        self._drop_work(f"{table}_changes")
        self.load_report[(table, batch)] = {"changed": out.n_changed,
                                            "closed_rewrite": out.closed_is_full}

    def load_vault(self, batch: int) -> None:
        self._parallel([job for _, job in self._load_jobs(batch).values()])

    def hub(self, table: str, batch: int) -> DataFrame:
        return self.store.read_appended("gold", table, batch)

    link = hub

    def satellite(self, table: str, batch: int) -> DataFrame:
        """Whole history (open and closed rows) of a satellite as of ``batch``."""
        if table in INSERT_ONLY_SATELLITES:
            return self.store.read_appended("gold", table, batch)
        return self.store.read_satellite(table, batch)

    def current(self, table: str, batch: int) -> DataFrame:
        if table in INSERT_ONLY_SATELLITES:
            return vault.current(self.store.read_appended("gold", table, batch))
        return self.store.read_open(table, batch)

    def as_of(self, table: str, batch: int, instant: str) -> DataFrame:
        """The versions of a type-2 satellite valid at ``instant``; closed partitions that ended by then are not read."""
        return vault.as_of(self.store.read_as_of(table, batch, instant), SATELLITES[table][1], instant)

    def point_in_time(self, table: str, batch: int, grid: list[str]) -> DataFrame:
        """Write and return the point-in-time index of a type-2 satellite at the instants of ``grid``, bucketed like it."""
        hk = SATELLITES[table][1]
        index = vault.point_in_time(self.store.read_as_of(table, batch, min(grid)), hk, grid)
        self.store.write_bucketed(index, "gold", table.replace("sat_", "pit_"), hk, batch)
        return self.store.read_batch("gold", table.replace("sat_", "pit_"), batch)

    def vault_view(self, batch: int) -> marts.VaultView:
        return marts.VaultView(
            **{t: self.hub(t, batch) for t in HUBS},
            **{t: self.link(t, batch) for t in LINKS},
            **{t: self.current(t, batch) for t in [*SATELLITES, *INSERT_ONLY_SATELLITES]},
        )

    # -- mart --------------------------------------------------------------------
    def build_marts(self, batch: int) -> None:
        view = self.vault_view(batch)
        # one after the other: each shuffles rows of every sale, and frees them at its end
        self.store.write_version(marts.mart_property_sales(view), "mart", "mart_property_sales", batch)
        self.store.write_version(marts.mart_owner_portfolio(view), "mart", "mart_owner_portfolio", batch)
        sales = self.mart("mart_property_sales", batch)
        self._parallel([
            lambda: self.store.write_version(marts.mart_agent_performance(sales), "mart",
                                             "mart_agent_performance", batch),
            lambda: self.store.write_version(
                marts.mart_suburb_trends(sales, self._materializer_seq("suburb_month", batch)),
                "mart", "mart_suburb_trends", batch),
        ])
        self._drop_work("suburb_month")

    def mart(self, table: str, batch: int) -> DataFrame:
        return self.store.read_version("mart", table, batch)

    # -- quality -------------------------------------------------------------------
    def quality_tables(self, batch: int) -> dict[str, DataFrame]:
        tables = {n: self.staged(n, batch) for n in STAGING_TABLES}
        tables.update({t: self.hub(t, batch) for t in HUBS})
        tables.update({t: self.link(t, batch) for t in LINKS})
        tables.update({t: self.satellite(t, batch) for t in [*SATELLITES, *INSERT_ONLY_SATELLITES]})
        tables.update({t: self.mart(t, batch) for t in MART_TABLES})
        return tables

    def quality(self, batch: int) -> DataFrame:
        keys = {**STAGING_KEYS, **{t: hk for t, (_, hk, _) in {**HUBS, **SATELLITES, **INSERT_ONLY_SATELLITES}.items()},
                **dict.fromkeys(LINKS, "transaction_hk")}
        return quality.run_tests(quality.DECLARED_TESTS, self.quality_tables(batch), keys)

    def layer_tables(self, batch: int) -> dict[tuple[str, str], DataFrame]:
        out = {("bronze", n): self.bronze(n, batch) for n in BRONZE_TABLES}
        out.update({("silver", n): self.staged(n, batch) for n in STAGING_TABLES})
        out.update({("gold", t): self.hub(t, batch) for t in HUBS})
        out.update({("gold", t): self.link(t, batch) for t in LINKS})
        out.update({("gold", t): self.satellite(t, batch)
                    for t in [*SATELLITES, *INSERT_ONLY_SATELLITES]})
        out.update({("mart", t): self.mart(t, batch) for t in MART_TABLES})
        return out

    # -- whole run -------------------------------------------------------------------
    def _load_jobs(self, batch: int) -> dict[str, tuple[str, object]]:
        """Vault loads of a batch with the staged entity each one reads."""
        jobs = {t: (HUBS[t][0], lambda t=t: self._load_hub(t, batch)) for t in HUBS}
        jobs.update({t: ("stg_transactions", lambda t=t: self._load_link(t, batch)) for t in LINKS})
        jobs.update({t: (INSERT_ONLY_SATELLITES[t][0], lambda t=t: self._load_insert_only(t, batch))
                     for t in INSERT_ONLY_SATELLITES})
        jobs.update({t: (SATELLITES[t][0], lambda t=t: self._load_satellite(t, batch))
                     for t in SATELLITES})
        return jobs

    def run_batch(self, batch: int, with_marts: bool = True, feed: int | None = None,
                  inputs: dict[str, DataFrame] | None = None, replay: bool = False,
                  stream: str | None = None, epoch: int | None = None) -> None:
        """Load one batch; ``feed``/``inputs`` as in :meth:`ingest`.

        Batch numbers may have gaps, but history only grows at its end:

        * an earlier batch that was started and not finished must be run again first;
        * a batch before others already loaded is refused, because they were
          loaded on top of what it is about to change, unless ``replay`` is given:
          then it and all later ones are dropped from silver and gold, it is loaded anew, and the
          later ones are loaded again from their bronze tables;
        * the last batch can be run again under its own number.
        """
        if self.store.intent():
            raise RuntimeError(f"a replay from batch {self.store.intent()[0].batch} was broken off: call resume_replay() first")
        started, finished = self.store.marked("started"), self.store.marked("finished")
        broken = [b for b in started if b < batch and b not in finished]
        if broken:
            raise RuntimeError(f"batch {broken[0]} was started but not finished: run it again before batch {batch}")
        later = [b for b in started if b > batch]
        if later and not replay:
            raise ValueError(f"batches {later} were loaded after batch {batch}: pass replay=True to load them again")
        sources = inputs if inputs is not None else self.bronze_inputs(feed or batch)
        if not later:
            self._hide(batch)
            self._load(batch, with_marts, sources, stream, epoch)
            return
        if not all(self.store.has_open(t, batch - 1) for t in SATELLITES):
            raise ValueError(f"the open rows before batch {batch} are not stored any more (keep_open)")
        # the new bronze stands aside, complete, before anything is given up
        self._parallel([lambda n=n, df=df: self.store.write_files(df, self._aside(n)) for n, df in sources.items()])
        if batch in started and stream is None:
            stream, epoch = self.store.origin(batch)
        self.store.intend([Listed(batch, stream, epoch, True, with_marts),
                           *(Listed(b, *self.store.origin(b), b in finished, with_marts) for b in later)])
        self.resume_replay()

    def _aside(self, table: str) -> str:
        return f"{self.root}/_replay_bronze/{table}"

    def resume_replay(self) -> bool:
        """Bring a replay to its end, also one that another application began; False if there is none.

        Every step bears being broken off and run again.  A batch that had itself been broken off before the replay is
        marked as started again, so it has to be run before any later one."""
        listed = self.store.intent()
        if not listed:
            return False
        first = listed[0].batch

        def take_bronze():
            for table in BRONZE_TABLES:
                self.store._move(self._aside(table), self.store.path("bronze", table, f"batch={first}"))

        def drop():
            self._hide(first)
            self.store.drop_from(first)
        self.store.replay_step("bronze", take_bronze)
        self.store.replay_step("dropped", drop)
        for x in listed:
            if x.whole and x.batch not in self.store.marked("finished"):
                self._load(x.batch, x.with_marts, None, x.stream, x.epoch)
            elif not x.whole:
                self.store.mark("started", x.batch, x.stream, x.epoch)
        self.store.end_replay()
        return True

    def _load(self, batch: int, with_marts: bool, sources: dict[str, DataFrame] | None,
              stream: str | None, epoch: int | None) -> None:
        """One batch through all layers; without ``sources`` from its bronze tables.

        Layers keep their order per entity, but an entity does not wait for
        the others: the CRM entities are staged and loaded while the wide
        feed is still being written.
        """
        self.store.mark("started", batch, stream, epoch)
        self.store._delete(f"{self.root}/_quality/batch={batch}")  # the delta tests' state of rows now written again
        loads = self._load_jobs(batch)
        with ThreadPoolExecutor(max_workers=len(BRONZE_TABLES) + len(BRONZE_OF) + len(loads)) as pool:
            bronze = {n: pool.submit(self._timed, f"bronze.{n}", batch, lambda n=n, df=df: self.ingest(batch, None, {n: df}))
                      for n, df in (sources or {}).items()}

            def stage_one(name):
                if sources is not None:
                    bronze[BRONZE_OF[name]].result()
                self._timed(f"silver.{name}", batch, lambda: self._stage_one(name, batch))

            staged = {n: pool.submit(stage_one, n) for n in BRONZE_OF}

            def load_one(table):
                stg, job = loads[table]
                staged[stg].result()
                self._timed(f"gold.{table}", batch, job)

            for f in [pool.submit(load_one, t) for t in loads]:
                f.result()
        if with_marts:
            self._timed("marts", batch, lambda: self.build_marts(batch))
        self.store.mark("finished", batch, stream, epoch)
        if self.published:
            marts = batch if with_marts else self.published.shown()[1]
            self._timed("publish", batch, lambda: self.published.show(batch, marts))
        self.store.drop_outgrown()
        if self.keep_open:
            for table in SATELLITES:
                self.store.drop_superseded(table, self.keep_open)

    def _hide(self, batch: int) -> None:
        """Show the batch before ``batch`` while it is written again."""
        if self.published:
            shown, marts = self.published.shown()
            before = [b for b in self.store.marked("finished") if b < batch]
            if shown >= batch or marts >= batch:
                kept = [b for b in before if self.store._exists(self.store.path("mart", MART_TABLES[-1], f"batch={b}/_SUCCESS"))]
                self.published.show(min(shown, (before or [0])[-1]), min(marts, (kept or [0])[-1]))

    def publish(self, batch: int) -> None:
        """Show an earlier batch (its marts if they were built) through the run's views."""
        has_marts = self.store._exists(self.store.path("mart", MART_TABLES[-1], f"batch={batch}/_SUCCESS"))
        self.published.show(batch, batch if has_marts else self.published.shown()[1])

    def _timed(self, name: str, batch: int, job) -> None:
        t0 = time.time()
        job()
        self.load_seconds[(name, batch)] = round(time.time() - t0, 3)

    def run(self, batches=(1, 2, 3), marts_for=(3,)) -> "Pipeline":
        for b in batches:
            if b not in self.store.marked("finished"):
                self.run_batch(b, with_marts=b in marts_for)
        return self
