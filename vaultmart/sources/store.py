"""Layer tables of one pipeline run, stored under a folder in the shared directory.

* bronze and mart tables are plain Parquet, one directory per batch
  (``<layer>/<table>/batch=<n>``), each the whole table as of that batch;
* silver and gold tables are catalog tables in a per-run database,
  ``PARTITIONED BY (batch)`` and ``CLUSTERED BY (<hash key>) INTO <n>
  BUCKETS``.  Every table of one grain shares the key and the bucket count,
  so the daily anti joins, change detection, close-out windows and the
  mart's transaction-grain joins read both sides already partitioned: only
  the incoming batch is shuffled, never the accumulated history;
* bucket counts are powers of two and grow with the grain (:meth:`LayerStore.fit`): bucket b of n
  parts into b and b + n of 2n, so a split copies each bucket in place, without a shuffle;
* satellites are further partitioned by ``is_current``.  ``(batch=n, is_current=false)`` holds the rows
  closed by batch ``n``.  ``(batch=n, is_current=true)`` holds the open rows of the keys that batch ``n``
  changed; rows of other keys stay where they are, so a batch with 1 % changes writes about 1 %.
  The open rows as of ``n`` are, per key, those of the last batch that changed it, from the base on:
  the last batch that wrote all open rows (``_open/batch=<n>``), because the changes since
  the base before had come to COMPACT_SHARE of it.  In the rare
  case a batch replaces a closed row that has the same ``(hk, load_date)``,
  that batch's closed partition holds the whole closed part and a marker
  ``_base/batch=<n>`` says earlier closed partitions are superseded.  ``_ends/batch=<n>`` keeps the
  latest end date of a closed partition, so that reads as of an instant skip those that ended before it.

Tables are compressed with zstd: an MD5 key in hex holds 16 bytes, which snappy stores as 32.  Columns that others of
the same row determine (``derived``, by SQL expressions) are not stored: reads and views compute them.

Every write first drops the batch's own partitions (catalog entry and
files; the tables are external), then ``INSERT INTO ... PARTITION (batch=<n>)``.
A batch only replaces its own partitions while it reads earlier ones.
"""

from __future__ import annotations

import hashlib
import math
import threading
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultmart.operators.vault import observed_value
from vaultmart.session import shuffles_freed
from vaultmart.sources.journal import Journal

BUCKET_TARGET_BYTES = 1 << 30   # per bucket, unless the caller says less
TASK_BYTES, TASK_ROWS = 64 << 20, 1 << 19  # of a batch's own rows of a grain, per bucket: stored bytes and rows
HISTORY_SHARE = 8               # times as many bytes of the grain's largest table
MOST_BUCKETS = 1 << 16          # Spark's own limit is 100,000 (spark.sql.sources.bucketing.maxBuckets)
CODEC = "zstd"
COMPACT_SHARE = 0.25            # changes since the base, by bytes, from which on all open rows are written again


def bucket_count(grain_bytes: float, bucket_bytes: int = BUCKET_TARGET_BYTES) -> int:
    """About ``bucket_bytes`` of a grain (or as many rows) per bucket, a power of two; one for small grains."""
    return 1 << max(0, math.ceil(math.log2(max(1, grain_bytes / bucket_bytes))))


class LayerStore(Journal):
    """Read and write the layer tables of one pipeline run.

    ``keys`` names the hash key of every bucketed table, by ``(layer, table)``; ``derived`` the last columns of some, with the
    SQL that makes them of the others.  Tables are external: their
    files stay under the run folder, and a later Spark application (the next day's job) re-attaches them
    with :meth:`attach`, so the run survives the session that started it.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[tuple[str, str], str], buckets: int | None = None,
                 bucket_bytes: int = TASK_BYTES, bucket_rows: int = TASK_ROWS,
                 derived: dict[tuple[str, str], dict[str, str]] | None = None):
        super().__init__(spark, root)
        self.keys, self._derived = keys, derived or {}
        self._fixed, self._bucket_bytes, self._bucket_rows, self._counts = buckets, bucket_bytes, bucket_rows, {}
        self.db = "vaultmart_" + hashlib.md5(self.root.encode()).hexdigest()[:12]
        self._lock, self._tables = threading.RLock(), threading.Lock()
        self._locations: dict[str, str] = {}
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.db} LOCATION '{self.root}/catalog'")

    # -- bucket counts --------------------------------------------------------------
    def buckets(self, key: str) -> int:
        """The bucket count of the tables keyed by ``key``; until one is recorded, the caller's or one."""
        with self._lock:
            if key not in self._counts:
                known = self._numbers(f"{self.root}/_buckets/{key}", "n")
                if not known:
                    return self._fixed or 1
                self._counts[key] = known[-1]
            return self._counts[key]

    def _set_buckets(self, key: str, n: int) -> int:
        """One finished record decides; the largest holds, because counts only grow."""
        self._record([(n,)], "buckets int", f"_buckets/{key}/n={n}")
        self._counts[key] = n
        return n

    def fit(self, key: str, batch_bytes: float, batch_rows: float = 0) -> int:
        """The bucket count for a batch that brings ``batch_bytes`` of a grain in ``batch_rows`` rows.  One task writes a
        bucket, and hash keys do not compress as their source does, so rows bound it too.  If the grain has outgrown its
        count, every table of it is first copied into more buckets; the record of the new count then switches them all."""
        with self._lock:
            known = self._numbers(f"{self.root}/_buckets/{key}", "n")
            if self._fixed:
                return self.buckets(key) if known else self._set_buckets(key, self._fixed)
            mine = [t for t, k in self.keys.items() if k == key]
            held = max((self.folder_bytes(self._table_path(*t, known[-1])) for t in mine), default=0) if known else 0
            wanted = max(bucket_count(b, self._bucket_bytes) for b in (batch_bytes, (held + batch_bytes) / HISTORY_SHARE))
            wanted = min(MOST_BUCKETS, max(wanted, bucket_count(batch_rows, self._bucket_rows)))
            if not known:
                return self._set_buckets(key, wanted)
            if wanted > known[-1]:
                for layer, table in mine:
                    self._split(layer, table, key, known[-1], wanted)
                self._set_buckets(key, wanted)
            return self.buckets(key)

    def _split(self, layer: str, table: str, key: str, n: int, more: int) -> None:
        old, new = (f"{self.db}.{layer}_{table}_b{k}" for k in (n, more))
        if not self.spark.catalog.tableExists(old):
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {new}")  # of a split that was broken off
        self._delete(self._table_path(layer, table, more))
        parts = [f.name for f in self.spark.catalog.listColumns(old) if f.isPartition]
        schema = self.spark.table(old).schema
        types = {f.name: f.dataType.simpleString() for f in schema.fields}
        self._create(new, [f for f in schema.fields if f.name not in parts], layer, table, key, tuple((p, types[p]) for p in parts), more)
        # bucket by bucket: the scan is partitioned this way already, so there is no exchange
        rows = self.spark.table(old).repartition(n, key)
        view = f"vaultmart_split_{uuid.uuid4().hex}"
        rows.createOrReplaceTempView(view)
        try:
            cols = ", ".join(f"`{f.name}`" for f in schema.fields if f.name not in parts)
            names = ", ".join(f"`{p}`" for p in parts)
            with shuffles_freed(self.spark):
                self.spark.sql(f"INSERT INTO {new} PARTITION ({names}) SELECT {cols}, {names} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def drop_outgrown(self) -> None:
        """Remove tables of bucket counts that were given up, once no view names them."""
        for (layer, table), key in self.keys.items():
            for n in self._numbers(f"{self.root}/_buckets/{key}", "n"):
                if n < self.buckets(key) and self._exists(self._table_path(layer, table, n)):
                    self.spark.sql(f"DROP TABLE IF EXISTS {self.db}.{layer}_{table}_b{n}")
                    self._delete(self._table_path(layer, table, n))

    # -- batch state -------------------------------------------------------------
    def drop_from(self, batch: int) -> None:
        """Forget ``batch`` and every later one: marks first, then their silver and gold partitions."""
        self.forget_from(batch)
        for layer, table in self.keys:
            for kind in ("_base", "_open", "_ends"):
                for b in self._numbers(self.path(layer, table, kind)):
                    if b >= batch:
                        self._delete(self.path(layer, table, f"{kind}/batch={b}"))
            for b in self.batches(layer, table):
                if b >= batch:
                    self._drop_batch(self.name(layer, table), b)

    def _drop_batch(self, fq: str, batch: int) -> None:
        self.spark.sql(f"ALTER TABLE {fq} DROP IF EXISTS PARTITION (batch={batch})")
        # the catalog may keep the files of a dropped partition: remove our own
        self._delete(f"{self._location(fq)}/batch={batch}")

    # -- paths and names -------------------------------------------------------
    def path(self, layer: str, table: str, part: str | None = None) -> str:
        base = f"{self.root}/{layer}/{table}"
        return f"{base}/{part}" if part else base

    def _table_path(self, layer: str, table: str, n: int) -> str:
        return self.path(layer, table, f"b{n}")

    def name(self, layer: str, table: str) -> str:
        """The catalog name of a bucketed table, at its grain's bucket count."""
        return f"{self.db}.{layer}_{table}_b{self.buckets(self.keys[layer, table])}"

    def batches(self, layer: str, table: str) -> list[int]:
        """Batches present in a catalog table (metadata only)."""
        fq = self.name(layer, table)
        if not self.spark.catalog.tableExists(fq):
            return []
        rows = self.spark.sql(f"SHOW PARTITIONS {fq}").collect()
        return sorted({int(p.split("/")[0].split("=", 1)[1]) for (p,) in rows})

    # -- plain per-batch tables (bronze, mart) ----------------------------------
    def write_files(self, df: DataFrame, path: str) -> None:
        """Replace a folder of plain Parquet."""
        with shuffles_freed(self.spark):
            df.write.mode("overwrite").parquet(path, compression=CODEC)

    def write_version(self, df: DataFrame, layer: str, table: str, batch: int) -> None:
        self.write_files(df, self.path(layer, table, f"batch={batch}"))

    def read_version(self, layer: str, table: str, batch: int) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, table, f"batch={batch}"))

    # -- bucketed catalog tables (silver, gold) ---------------------------------
    def _create(self, fq: str, fields, layer: str, table: str, key: str,
                partitions: tuple[tuple[str, str], ...], n: int) -> None:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        parts = ", ".join(f"`{n}` {t}" for n, t in partitions)
        names = ", ".join(f"`{n}`" for n, _ in partitions)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {fq} ({cols}, {parts}) USING parquet OPTIONS (compression '{CODEC}') "
            f"PARTITIONED BY ({names}) CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
            f"INTO {n} BUCKETS LOCATION '{self._table_path(layer, table, n)}'")

    def _ensure_table(self, df: DataFrame, layer: str, table: str, key: str,
                      partitions: tuple[tuple[str, str], ...]) -> str:
        fq, n = self.name(layer, table), self.buckets(key)
        with self._tables:
            if key not in self._counts:
                self._set_buckets(key, n)
            if not self.spark.catalog.tableExists(fq):
                self._create(fq, df.schema.fields, layer, table, key, partitions, n)
        return fq

    def attach(self, layer: str, table: str, satellite: bool = False) -> None:
        """Register a table written by an earlier application, with its partitions."""
        key = self.keys[layer, table]
        known = self._numbers(f"{self.root}/_buckets/{key}", "n")
        if not known:
            return
        fq, path = self.name(layer, table), self._table_path(layer, table, known[-1])
        with self._tables:
            if self.spark.catalog.tableExists(fq) or not self._exists(path):
                return
            partitions = (("batch", "int"), ("is_current", "boolean")) if satellite \
                else (("batch", "int"),)
            names = {n for n, _ in partitions}
            fields = [f for f in self.spark.read.parquet(path).schema.fields if f.name not in names]
            self._create(fq, fields, layer, table, key, partitions, known[-1])
            self.spark.sql(f"ALTER TABLE {fq} RECOVER PARTITIONS")

    def _location(self, fq: str) -> str:
        if fq not in self._locations:
            rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {fq}").collect()
            self._locations[fq] = next(r.data_type for r in rows if r.col_name == "Location")
        return self._locations[fq]

    def _insert(self, df: DataFrame, fq: str, batch: int, extra_cols: list[str], drop: bool = True) -> None:
        schema = self.spark.table(fq).schema
        want = {f.name: f.dataType for f in schema.fields if f.name != "batch"}
        have = {f.name: f.dataType for f in df.schema.fields}
        if have != want:
            differ = sorted(set(map(str, have.items())) ^ set(map(str, want.items())))
            raise ValueError(f"{fq}: the columns to write do not match the table: {differ}")
        view = f"vaultmart_batch_{uuid.uuid4().hex}"
        df.createOrReplaceTempView(view)
        try:
            # by name: in the table's column order, dynamic partitions last
            cols = ", ".join(f"`{c}`" for c in [*[c for c in want if c not in extra_cols], *extra_cols])
            spec = ", ".join([f"batch={batch}", *extra_cols])
            if drop:
                self._drop_batch(fq, batch)
            with shuffles_freed(self.spark):
                self.spark.sql(f"INSERT INTO {fq} PARTITION ({spec}) SELECT {cols} FROM {view}")
        finally:
            self.spark.catalog.dropTempView(view)

    def _by_bucket(self, df: DataFrame, key: str) -> DataFrame:
        """One task per bucket, so a batch writes one file per bucket.

        Without it every input task writes a file for every bucket (tasks x
        buckets files).  Spark's hash partitioning equals the bucket hash, and
        the planner drops this exchange when the input is already partitioned
        that way (a bucketed read, or a join or window on the key).
        """
        return df.repartition(self.buckets(key), key)

    def write_bucketed(self, df: DataFrame, layer: str, table: str, key: str, batch: int, key_sql: str | None = None) -> None:
        """Replace partition ``batch`` of a table bucketed by ``key``.  If ``key_sql`` makes the key of the other columns,
        the shuffle deals rows by it and leaves the key itself, which does not compress, to be made after."""
        fq = self._ensure_table(df.drop(*self._derived.get((layer, table), ())), layer, table, key, (("batch", "int"),))
        df = df.drop(*self.missing(layer, table))
        if key_sql is None:
            rows = self._by_bucket(df, key)
        else:
            rows = df.drop(key).repartition(self.buckets(key), F.expr(key_sql)).withColumn(key, F.expr(key_sql))
        self._insert(rows, fq, batch, [])

    def missing(self, layer: str, table: str) -> dict[str, str]:
        """The derived columns that the table does not hold (one begun by older code holds them), with their SQL."""
        derived = self._derived.get((layer, table), {})
        held = self.spark.table(self.name(layer, table)).columns if derived else []
        return {c: sql for c, sql in derived.items() if c not in held}

    def read_batch(self, layer: str, table: str, batch: int) -> DataFrame:
        """One batch of a bucketed table (e.g. a staged entity)."""
        rows = self.spark.table(self.name(layer, table)).where(F.col("batch") == batch).drop("batch")
        return rows.select("*", *[F.expr(sql).alias(c) for c, sql in self.missing(layer, table).items()])

    def read_appended(self, layer: str, table: str, batch: int) -> DataFrame | None:
        """All rows appended up to and including ``batch``; None before the first load."""
        if not any(b <= batch for b in self.batches(layer, table)):
            return None
        return (self.spark.table(self.name(layer, table))
                .where(F.col("batch") <= batch).drop("batch"))

    # -- satellites ---------------------------------------------------------------
    def open_base(self, table: str, batch: int) -> int | None:
        """The last batch up to ``batch`` that wrote all open rows, if they are still stored."""
        found = [b for b in self._numbers(self.path("gold", table, "_open")) if b <= batch]
        return found[-1] if found else None

    def has_open(self, table: str, batch: int) -> bool:
        """Whether the open rows as of ``batch`` are stored, if there were any."""
        return self.open_base(table, batch) is not None or not any(b <= batch for b in self.marked("finished"))

    def _start(self, table: str, batch: int) -> int | None:
        base = self.open_base(table, batch)
        if base is None and not self.has_open(table, batch):
            raise ValueError(f"the open rows of {table} as of batch {batch} are not stored any more")
        return base

    def _live(self, table: str, batch: int, closed: list[int]) -> DataFrame | None:
        """Open rows as of ``batch`` and the rows of the partitions ``closed``: one scan, partitioned by the bucket key.

        Of the open rows, per key those of the last batch that changed it: a join with the keys changed since the
        base, both sides on the bucket key, so without an exchange."""
        base = self._start(table, batch)
        if base is None:
            return None
        rows = self.spark.table(self.name("gold", table))
        names = [c for c in rows.columns if c not in ("batch", "is_current")]
        live = F.col("is_current") & F.col("batch").between(base, batch)
        rows = rows.where(live | (~F.col("is_current") & F.col("batch").isin(closed)) if closed else live)
        later = [b for b in self.batches("gold", table) if base < b <= batch]
        if later:
            key = self.keys["gold", table]
            changed = (self.spark.table(self.name("gold", table)).where(F.col("is_current") & F.col("batch").isin(later))
                       .groupBy(key).agg(F.max("batch").alias("_last")))
            rows = rows.join(changed, key, "left").where(
                ~F.col("is_current") | (F.coalesce("_last", F.lit(base)) == F.col("batch")))
        return rows.select(*names)

    def read_open(self, table: str, batch: int) -> DataFrame | None:
        """The open rows as of ``batch``; None before the first load."""
        return self._live(table, batch, [])

    def closed_start(self, table: str, batch: int) -> int:
        """First batch whose closed partition is still live as of ``batch``."""
        bases = [b for b in self._numbers(self.path("gold", table, "_base")) if b <= batch]
        return bases[-1] if bases else 1

    def _closed(self, table: str, batch: int, after: str | None = None) -> list[int]:
        """Closed partitions that count as of ``batch``: the latest full rewrite, then later ones.  With the instant
        ``after``, those that ended by then are left out."""
        live = [b for b in self.batches("gold", table) if self.closed_start(table, batch) <= b <= batch]
        return live if after is None else [b for b in live if (end := self._end_of(table, b)) is None or end > after]

    def read_closed(self, table: str, batch: int) -> DataFrame | None:
        live = self._closed(table, batch)
        if not live:
            return None
        return (self.spark.table(self.name("gold", table))
                .where(F.col("batch").isin(live) & ~F.col("is_current"))
                .drop("batch", "is_current"))

    def _end_of(self, table: str, batch: int) -> str | None:
        """The latest end date in a closed partition ("" if it is empty), None if not recorded."""
        path = self.path("gold", table, f"_ends/batch={batch}")
        return self.spark.read.parquet(path).first()["upto"] if self._exists(f"{path}/_SUCCESS") else None

    def read_satellite(self, table: str, batch: int) -> DataFrame | None:
        """Whole history of a satellite as of ``batch`` (open and closed rows)."""
        return self._live(table, batch, self._closed(table, batch))

    def read_as_of(self, table: str, batch: int, instant: str) -> DataFrame | None:
        """The versions as of ``batch`` among which are all that hold at ``instant`` (``YYYY-MM-DD hh:mm:ss``): closed
        partitions that ended by then are not read."""
        return self._live(table, batch, self._closed(table, batch, instant))

    def has_base(self, table: str, batch: int) -> bool:
        return batch in self._numbers(self.path("gold", table, "_base"))

    def write_satellite(self, out, table: str, key: str, batch: int) -> None:
        """A batch's rows, split by ``is_current``: the changed keys in one pass (their close-out window runs once).  Other
        open rows are written only when the changes have come to COMPACT_SHARE of the base; then bucket by
        bucket, never shuffled."""
        for kind in ("_open", "_ends"):
            self._delete(self.path("gold", table, f"{kind}/batch={batch}"))
        base = self.open_base(table, batch - 1)
        ends = [Observation(), Observation()]
        upto = F.max("load_end_date").cast("string").alias("upto")
        touched = out.touched.observe(ends[0], upto).withColumn("is_current", F.col("load_end_date").isNull())
        fq = self._ensure_table(out.touched, "gold", table, key,
                                (("batch", "int"), ("is_current", "boolean")))
        self._insert(self._by_bucket(touched, key), fq, batch, ["is_current"])
        if out.kept_closed is not None:
            kept = out.kept_closed.observe(ends[1], upto).withColumn("is_current", F.lit(False))
            self._insert(self._by_bucket(kept, key), fq, batch, ["is_current"], drop=False)
            self.spark.range(0).write.mode("overwrite").parquet(
                self.path("gold", table, f"_base/batch={batch}"))
        found = [observed_value(e, "upto") for e in ends[:1 + (out.kept_closed is not None)]]
        self._record([(max(filter(None, found), default=""),)], "upto string", f"gold/{table}/_ends/batch={batch}")
        if out.untouched is None or self._outgrown(table, base, batch):
            if out.untouched is not None:
                rest = out.untouched.withColumn("is_current", F.lit(True))
                self._insert(self._by_bucket(rest, key), fq, batch, ["is_current"], drop=False)
            self.spark.range(0).write.mode("overwrite").parquet(self.path("gold", table, f"_open/batch={batch}"))

    def _outgrown(self, table: str, base: int, batch: int) -> bool:
        """Whether the open rows written since the base come to COMPACT_SHARE of it."""
        place = self._location(self.name("gold", table))
        size = lambda b: self.folder_bytes(f"{place}/batch={b}/is_current=true")
        since = sum(size(b) for b in self.batches("gold", table) if base < b <= batch)
        return since > COMPACT_SHARE * size(base)

    def drop_superseded(self, table: str, keep: int) -> None:
        """Release the open rows that no read as of one of the last ``keep`` batches needs."""
        fq, batches = self.name("gold", table), self.batches("gold", table)
        base = self.open_base(table, batches[-keep]) if len(batches) >= keep else None
        for b in batches if base is not None else []:
            if b < base:
                self._delete(self.path("gold", table, f"_open/batch={b}"))
                self.spark.sql(f"ALTER TABLE {fq} DROP IF EXISTS PARTITION (batch={b}, is_current=true)")
                self._delete(f"{self._location(fq)}/batch={b}/is_current=true")
