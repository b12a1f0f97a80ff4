"""``foreachBatch`` adapter: each micro-batch of raw CSV drops is one vault batch.

CRM tables are read in full for every batch (they are snapshots).  A micro-batch
takes the number after the run's last batch, and the run keeps which stream and
epoch it was: a micro-batch that Spark delivers again after a restart is skipped if it was
finished, or run again under its own number if it was broken off.  A new
stream (another name) on a used run goes on after the batches there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vaultmart.plans.pipeline import Pipeline
from vaultmart.schemas import PROPERTY_RAW_CSV


def feed_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Raw feed CSV drops as a stream, with the explicit schema."""
    return (spark.readStream.schema(PROPERTY_RAW_CSV).option("header", True)
            .option("mode", "FAILFAST").option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(drop_dir))


def micro_batch_loader(run: Pipeline, crm: Callable[[int], dict[str, DataFrame]],
                       loaded_at: Callable[[int], str], stream: str = "feed", with_marts: bool = True):
    """A ``foreachBatch`` function loading each micro-batch into ``run``.

    ``crm(batch)`` returns the owners and agents snapshots for the batch,
    ``loaded_at(batch)`` its audit instant (a literal, so reruns are exact);
    ``stream`` names the query: one name per checkpoint folder.
    """
    def load(df: DataFrame, epoch_id: int) -> None:
        run.resume_replay()  # of an application before this one
        batch = run.store.batch_of_epoch(stream, epoch_id)
        if batch is None:
            batch = max(run.store.marked("started"), default=0) + 1
        elif batch in run.store.marked("finished"):
            return
        raw = df.withColumn("_loaded_at", F.lit(loaded_at(batch)).cast("timestamp_ntz"))
        run.run_batch(batch, with_marts=with_marts, inputs={"property_raw": raw, **crm(batch)},
                      stream=stream, epoch=epoch_id)
    return load
