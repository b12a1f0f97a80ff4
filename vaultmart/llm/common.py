"""Helpers the operators share: the word rule, shared-folder tables and the document table."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.session import new_run_dir

# A word is a run of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = b" \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def words(column):
    """Array column of the words of a text; an empty array for null, empty or blank texts."""
    return F.array_remove(F.split(F.coalesce(column, F.lit("")), SPACE), "")


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that `write_table` writes inside go at the end, but those written with `keep`."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCRATCH.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)


def write_table(df: DataFrame, label: str, codec: str = "snappy", keep: bool = False) -> DataFrame:
    """Write `df` to a fresh folder under the cluster's shared folder and read it back.

    Cuts lineage: a lost executor later costs a file read, not the work behind the table.  The
    shuffle files behind it are not needed any more and go at once, instead of when the driver
    happens to collect garbage.
    """
    spark = df.sparkSession
    path = new_run_dir(spark, label)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def free_name(taken, base: str) -> str:
    """`base`, or `base` with underscores in front until no column of `taken` has that name."""
    lower = {c.lower() for c in taken}
    while base.lower() in lower:
        base = "_" + base
    return base


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Documents are large rows: hand at most `rows` of them to Python at a time in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


class RecentCache:
    """A bounded cache of two generations: what is not asked for during a whole one goes."""

    def __init__(self, limit: int) -> None:
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys) -> list:
        """The distinct `keys` that must be made and put into `young`; the others are there afterwards."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = set(keys).difference(young)
        known = list(filter(old.__contains__, new))
        young.update(zip(known, map(old.__getitem__, known)))
        new.difference_update(known)
        return list(new)
