"""Data Vault 2.0 loaders over DataFrames.

Every loader takes the staged batch and what the target already holds, and
returns what to write; the caller stores it (``sources.store``).  Keys are
md5 hash keys, so hash partitioning on them is uniform.

* hubs and links append keys they have not seen (``left_anti``, never the
  null-aware ``NOT IN`` plan); the first-seen ``load_date`` stays;
* the insert-only satellite does the same by hash key;
* type-2 satellites capture rows that are new or differ from the latest
  open version, replace rows with the same ``(hk, load_date)`` and close
  every open version that has a later open version of the same key at that
  version's ``load_date``.  Only keys present in the batch are touched: the
  open rows of other keys pass through a broadcastable anti join, so a daily
  batch costs O(open rows) scanned and O(batch) shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from vaultmart.functions.hashing import hash_key
from vaultmart.operators.keys import first_per_key

LOAD_DATE = "load_date"
LOAD_END_DATE = "load_end_date"
RECORD_SOURCE = "record_source"
HASHDIFF = "hashdiff"
_PREV_LOAD_DATE = "_prev_load_date"


def _null_end() -> F.Column:
    return F.lit(None).cast("timestamp_ntz").alias(LOAD_END_DATE)


def observed(obs: Observation, name: str) -> int:
    """An observed count."""
    return int(observed_value(obs, name) or 0)


def observed_value(obs: Observation, name: str):
    """An observed value.  A branch that the optimizer proves empty is cut from the plan with its
    observation, which then has no row at all: it saw none (None)."""
    try:
        return obs.get[name]
    except Py4JJavaError as e:
        if "assertion failed" not in str(e.java_exception):
            raise
        return None


@dataclass
class LoadReport:
    """Row counts of one load, observed in the pass that writes it.

    ``staged`` rows in, ``unique`` after the in-batch deduplication (their
    difference is the duplicates dropped), ``written`` rows appended.
    """

    staged: Observation = field(default_factory=Observation)
    unique: Observation = field(default_factory=Observation)
    written: Observation = field(default_factory=Observation)

    def values(self) -> dict[str, int]:
        """Read after the write has run (blocks until then)."""
        out = {k: observed(getattr(self, k), "rows") for k in ("staged", "unique", "written")}
        out["duplicates"] = out["staged"] - out["unique"]
        return out


def _counted(df: DataFrame, obs: Observation | None) -> DataFrame:
    return df if obs is None else df.observe(obs, F.count(F.lit(1)).alias("rows"))


def load_hub(staged: DataFrame, hk: str, business_key: str,
             target: DataFrame | None = None, report: LoadReport | None = None) -> DataFrame:
    """Hub rows to append: one per hash key not yet in ``target`` (V3)."""
    src = _counted(staged.select(hk, business_key, LOAD_DATE, RECORD_SOURCE),
                   report and report.staged)
    src = first_per_key(src, [hk], [F.col(LOAD_DATE).asc_nulls_last(),
                                    F.col(business_key).asc(), F.col(RECORD_SOURCE).asc()])
    src = _counted(src, report and report.unique)
    if target is not None:
        src = src.join(target.select(hk), hk, "left_anti")
    return _counted(src, report and report.written)


def load_link(staged: DataFrame, driving_hk: str, other_source: str, other_hk: str,
              target: DataFrame | None = None, report: LoadReport | None = None) -> DataFrame:
    """Link rows to append, keyed by the driving (transaction) key (V4).

    A later change of the other key is ignored: the first pairing stays.
    """
    src = _counted(staged.select(driving_hk, F.col(other_source).alias(other_hk), LOAD_DATE,
                                 RECORD_SOURCE), report and report.staged)
    src = first_per_key(src, [driving_hk], [F.col(LOAD_DATE).asc_nulls_last(),
                                            F.col(other_hk).asc_nulls_last()])
    src = _counted(src, report and report.unique)
    if target is not None:
        src = src.join(target.select(driving_hk), driving_hk, "left_anti")
    return _counted(src, report and report.written)


def satellite_columns(hk: str, attrs: Sequence[str]) -> list[str]:
    return [hk, *attrs, HASHDIFF, LOAD_DATE, LOAD_END_DATE, RECORD_SOURCE]


def load_insert_only_satellite(staged: DataFrame, hk: str, attrs: Sequence[str],
                               target: DataFrame | None = None,
                               report: LoadReport | None = None) -> DataFrame:
    """Insert-only satellite (V8): by key only; hashdiff kept, never compared."""
    src = _counted(staged.select(hk, *attrs, HASHDIFF, LOAD_DATE, _null_end(), RECORD_SOURCE),
                   report and report.staged)
    src = first_per_key(src, [hk], [F.col(LOAD_DATE).asc_nulls_last(), F.col(HASHDIFF).asc()])
    src = _counted(src, report and report.unique)
    if target is not None:
        src = src.join(target.select(hk), hk, "left_anti")
    return _counted(src, report and report.written)


def changed_rows(staged: DataFrame, hk: str, open_rows: DataFrame | None) -> DataFrame:
    """Staged rows that are new or differ from the latest open version (V5).

    Adds ``_prev_load_date``: the load date of that latest open version.  Only
    open rows of keys in the batch are looked at (semi join first).
    """
    if open_rows is None:
        return staged.withColumn(_PREV_LOAD_DATE, F.lit(None).cast("timestamp_ntz"))
    in_batch = open_rows.select(hk, HASHDIFF, LOAD_DATE).join(staged.select(hk), hk, "left_semi")
    latest = first_per_key(in_batch, [hk], [F.col(LOAD_DATE).desc_nulls_first(),
                                           F.col(HASHDIFF).asc()])
    latest = latest.select(hk, F.col(HASHDIFF).alias("_prev_hashdiff"),
                           F.col(LOAD_DATE).alias(_PREV_LOAD_DATE))
    joined = staged.join(latest, hk, "left")
    return (joined.where(F.col("_prev_hashdiff").isNull()
                         | (F.col(HASHDIFF) != F.col("_prev_hashdiff")))
            .drop("_prev_hashdiff"))


@dataclass
class SatelliteBatch:
    """What a satellite load writes.

    ``touched``: the open versions of the batch's changed keys and the new ones, closed out
    (``load_end_date`` set or null); ``untouched``: all other open rows (None on first load);
    ``kept_closed``: the earlier closed rows, only when the batch replaces some of them."""

    touched: DataFrame
    untouched: DataFrame | None
    kept_closed: DataFrame | None
    changed: DataFrame
    n_changed: int = 0

    @property
    def closed_is_full(self) -> bool:
        """Whether ``closed`` is the whole closed part, not just what the batch adds to it."""
        return self.kept_closed is not None

    @property
    def open(self) -> DataFrame:
        """All open rows after the batch."""
        rows = self.touched.where(F.col(LOAD_END_DATE).isNull())
        return rows if self.untouched is None else self.untouched.unionByName(rows)

    @property
    def closed(self) -> DataFrame:
        rows = self.touched.where(F.col(LOAD_END_DATE).isNotNull())
        return rows if self.kept_closed is None else self.kept_closed.unionByName(rows)


def close_versions(rows: DataFrame, hk: str) -> DataFrame:
    """SCD2 close-out (V6) over open rows unique per ``(hk, load_date)``.

    A row with a later row of the same key gets ``load_end_date`` = the
    nearest later ``load_date``; the latest stays open.
    """
    w = Window.partitionBy(hk).orderBy(F.col(LOAD_DATE).asc())
    return rows.withColumn(LOAD_END_DATE, F.lead(LOAD_DATE).over(w))


def load_satellite(staged: DataFrame, hk: str, attrs: Sequence[str],
                   open_prev: DataFrame | None, closed_prev: DataFrame | None,
                   materialize: Callable[[DataFrame], DataFrame] | None = None,
                   force_full_closed: bool = False) -> SatelliteBatch:
    """One batch into a type-2 satellite (V5 + S14/V7 + V6).

    ``materialize`` cuts the lineage of the change set (it is read several
    times) and must run an action; by default a reliable ``checkpoint()`` in
    the shared folder.  While it runs, the change set is also counted, and so
    are the changes older than the open version they were compared with:
    only those can replace a closed row (normally there are none, and the
    closed history is then not read at all).  ``force_full_closed`` rewrites
    the closed part regardless (a rerun of a batch that did so before).
    """
    cols = satellite_columns(hk, attrs)
    src = staged.select(hk, *attrs, HASHDIFF, LOAD_DATE, RECORD_SOURCE)
    changed = changed_rows(src, hk, open_prev)
    # one row per (hk, load_date): deterministic
    changed = first_per_key(changed, [hk, LOAD_DATE], [F.col(HASHDIFF).asc()])
    older = F.col(_PREV_LOAD_DATE).isNotNull() & (F.col(LOAD_DATE) < F.col(_PREV_LOAD_DATE))
    stats = Observation()
    changed = changed.observe(stats, F.count(F.lit(1)).alias("changed"),
                              F.count_if(older).alias("older"))
    changed = (materialize or (lambda d: d.checkpoint()))(changed)
    n_older = observed(stats, "older")

    fresh = changed.select(*[c for c in cols if c != LOAD_END_DATE]).withColumn(
        LOAD_END_DATE, F.lit(None).cast("timestamp_ntz")).select(*cols)
    if open_prev is None:
        touched, untouched = fresh, None
    else:
        keys = changed.select(hk).distinct()
        replaced = changed.select(hk, LOAD_DATE)
        touched = (open_prev.join(keys, hk, "left_semi")
                   .join(replaced, [hk, LOAD_DATE], "left_anti")
                   .select(*cols).unionByName(fresh))
        untouched = open_prev.join(keys, hk, "left_anti").select(*cols)
    touched = close_versions(touched, hk).select(*cols)

    kept_closed = None
    if closed_prev is not None and (n_older > 0 or force_full_closed):
        suspects = changed.where(older).select(hk, LOAD_DATE)
        if force_full_closed or not closed_prev.join(suspects, [hk, LOAD_DATE], "left_semi").isEmpty():
            kept_closed = closed_prev.join(suspects, [hk, LOAD_DATE], "left_anti").select(*cols)
    return SatelliteBatch(touched=touched, untouched=untouched, kept_closed=kept_closed,
                          changed=changed.drop(_PREV_LOAD_DATE), n_changed=observed(stats, "changed"))


def current(satellite: DataFrame) -> DataFrame:
    """Current versions (V9): ``load_end_date is null``."""
    return satellite.where(F.col(LOAD_END_DATE).isNull())


def as_of(satellite: DataFrame, hk: str, instant: str) -> DataFrame:
    """Version valid at ``instant`` per key (V10); on overlap the latest load wins."""
    t = F.lit(instant).cast("timestamp_ntz")
    valid = satellite.where((F.col(LOAD_DATE) <= t)
                            & (F.col(LOAD_END_DATE).isNull() | (t < F.col(LOAD_END_DATE))))
    return first_per_key(valid, [hk], [F.col(LOAD_DATE).desc_nulls_last(), F.col(HASHDIFF).asc()])


def point_in_time(satellite: DataFrame, hk: str, grid: Sequence[str]) -> DataFrame:
    """Index ``(hk, instant, load_date)``: per key the load date of the version valid at each instant of ``grid``.

    Every version is spread over the instants it holds at, and the latest load is a grouped maximum: a
    satellite partitioned by its key is neither shuffled nor ranked."""
    instants = F.array(*[F.lit(t).cast("timestamp_ntz") for t in grid])
    holds = F.filter(instants, lambda t: (F.col(LOAD_DATE) <= t) & (F.col(LOAD_END_DATE).isNull() | (t < F.col(LOAD_END_DATE))))
    return (satellite.select(hk, LOAD_DATE, F.explode(holds).alias("instant"))
            .groupBy(hk, "instant").agg(F.max(LOAD_DATE).alias(LOAD_DATE)))


def as_of_indexed(satellite: DataFrame, index: DataFrame, hk: str, instant: str) -> DataFrame:
    """As :func:`as_of` for an instant of the index's grid: its versions by a join on ``(hk, load_date)``.

    Of an open and a closed version with the same load date the valid one counts."""
    t = F.lit(instant).cast("timestamp_ntz")
    valid = satellite.where((F.col(LOAD_DATE) <= t) & (F.col(LOAD_END_DATE).isNull() | (t < F.col(LOAD_END_DATE))))
    return valid.join(index.where(F.col("instant") == t).select(hk, LOAD_DATE), [hk, LOAD_DATE], "left_semi")


def history(satellite: DataFrame, hk: str) -> DataFrame:
    """Version history with a 1-based ``version`` number per key."""
    w = Window.partitionBy(hk).orderBy(F.col(LOAD_DATE).asc_nulls_last(), F.col(HASHDIFF).asc())
    return satellite.withColumn("version", F.row_number().over(w))


def key_history(satellite: DataFrame, hk: str, business_key: str) -> DataFrame:
    """The versions of one business key, oldest first."""
    return (satellite.where(F.col(hk) == hash_key(F.lit(business_key)))
            .orderBy(F.col(LOAD_DATE).asc_nulls_last(), F.col(HASHDIFF).asc()))


def latest_version(satellite: DataFrame, hk: str, business_key: str) -> DataFrame:
    """The newest version of one business key (``order by load_date desc limit 1``)."""
    return (satellite.where(F.col(hk) == hash_key(F.lit(business_key)))
            .orderBy(F.col(LOAD_DATE).desc_nulls_first(), F.col(HASHDIFF).asc()).limit(1))
