"""CSV source and sink for the wide raw feed (S1, S8) and bronze ingest.

The reader always takes the explicit schema (no inference pass, postcodes
keep their leading zeros) and fails fast on a malformed row; the row count
is observed during the write instead of a second scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vaultmart.schemas import PROPERTY_RAW, PROPERTY_RAW_CSV
from vaultmart.session import shuffles_freed


def write_property_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """The raw feed as CSV with a header row (one directory of part files), plain unless a codec is given (``gzip``)."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("header", True).csv(path, compression=compression)


def read_property_csv(spark: SparkSession, path: str, with_loaded_at: bool = True) -> DataFrame:
    """Read the raw feed with the explicit schema."""
    schema = PROPERTY_RAW if with_loaded_at else PROPERTY_RAW_CSV
    return (spark.read.schema(schema).option("header", True).option("mode", "FAILFAST")
            .csv(path))


def load_csv_to_bronze(spark: SparkSession, csv_path: str, bronze_path: str,
                       loaded_at: str | None = None) -> int:
    """CSV -> bronze Parquet with the load audit column; returns the row count.

    ``loaded_at`` fixes the audit time so a rerun is exact; by default the
    current timestamp (zone-free).
    """
    df = read_property_csv(spark, csv_path, with_loaded_at=False)
    stamp = (F.lit(loaded_at).cast("timestamp_ntz") if loaded_at
             else F.localtimestamp())
    obs = Observation("bronze_load")
    (df.withColumn("_loaded_at", stamp)
       .observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite").parquet(bronze_path))
    return obs.get["rows"]
