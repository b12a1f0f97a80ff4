"""The state of a run, kept in its folder: which batches were started and finished, and a replay's intent.

Nothing about a batch lives in process memory only, so the next application, or the next stream,
knows which batches hold, which were broken off, and what a broken replay still owes.

* ``_started/batch=<n>`` is written before a batch touches any table, ``_finished/batch=<n>`` after its
  last write; both carry the stream and epoch of a micro-batch.
* ``_replay/intent`` lists the batches a replay gives up, with their streams, epochs and state, and is written
  before the first of them is dropped.  ``_replay/<step>`` says that a step is done.  The intent goes when
  every listed batch holds again (or, if it had been broken off before, is marked as started again).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Listed:
    """A batch of a replay's intent."""

    batch: int
    stream: str | None
    epoch: int | None
    whole: bool
    with_marts: bool


class Journal:
    """Batch marks and the replay intent of the run under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    # -- files -------------------------------------------------------------------
    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(conf), hpath

    def _exists(self, path: str) -> bool:
        fs, hpath = self._fs(path)
        return bool(fs.exists(hpath))

    def _delete(self, path: str) -> None:
        fs, hpath = self._fs(path)
        if fs.exists(hpath):
            fs.delete(hpath, True)

    def _move(self, source: str, target: str) -> None:
        """Replace ``target`` by ``source``; nothing to do once it was moved."""
        fs, hpath = self._fs(source)
        if fs.exists(hpath):
            self._delete(target)
            goal = self._fs(target)[1]
            fs.mkdirs(goal.getParent())
            fs.rename(hpath, goal)

    def folder_bytes(self, path: str) -> int:
        fs, hpath = self._fs(path)
        return fs.getContentSummary(hpath).getLength() if fs.exists(hpath) else 0

    def _numbers(self, path: str, name: str = "batch") -> list[int]:
        """The ``n`` of finished writes ``<path>/<name>=<n>``, ascending."""
        fs, hpath = self._fs(path)
        if not fs.exists(hpath):
            return []
        jvm = self.spark.sparkContext._jvm
        found = []
        for status in fs.listStatus(hpath):
            key, _, value = status.getPath().getName().partition("=")
            if key == name and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append(int(value))
        return sorted(found)

    def _record(self, rows: list[tuple], schema: str, path: str) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{path}")

    # -- batches -------------------------------------------------------------------
    def mark(self, state: str, batch: int, stream: str | None = None, epoch: int | None = None) -> None:
        self._record([(stream, epoch)], "stream string, epoch long", f"_{state}/batch={batch}")

    def marked(self, state: str) -> list[int]:
        """Batches ``started`` or ``finished``, ascending."""
        return self._numbers(f"{self.root}/_{state}")

    def origin(self, batch: int) -> tuple[str | None, int | None]:
        """The stream and epoch a started batch came from."""
        return tuple(self.spark.read.parquet(f"{self.root}/_started/batch={batch}").first())

    def batch_of_epoch(self, stream: str, epoch: int) -> int | None:
        """The batch that a stream's micro-batch was given, if any."""
        found = [b for b in self.marked("started") if self.origin(b) == (stream, epoch)]
        return found[-1] if found else None

    def forget_from(self, batch: int) -> None:
        """Remove the marks of ``batch`` and every later one, finished marks first."""
        for state in ("finished", "started"):
            for b in self.marked(state):
                if b >= batch:
                    self._delete(f"{self.root}/_{state}/batch={b}")

    # -- replay ----------------------------------------------------------------------
    def intend(self, listed: list[Listed]) -> None:
        """Write the intent: from here on the replay has to be brought to its end."""
        self._delete(f"{self.root}/_replay")
        self._record([(x.batch, x.stream, x.epoch, x.whole, x.with_marts) for x in listed],
                     "batch int, stream string, epoch long, whole boolean, with_marts boolean", "_replay/intent")

    def intent(self) -> list[Listed]:
        """The batches of a replay that has not come to its end, in order; empty if there is none."""
        path = f"{self.root}/_replay/intent"
        if not self._exists(f"{path}/_SUCCESS"):
            return []
        return sorted((Listed(*r) for r in self.spark.read.parquet(path).collect()), key=lambda x: x.batch)

    def replay_step(self, step: str, work) -> None:
        """Run ``work`` unless this replay has done the step; it must bear being run twice."""
        path = f"_replay/{step}"
        if not self._exists(f"{self.root}/{path}/_SUCCESS"):
            work()
            self._record([(step,)], "step string", path)

    def end_replay(self) -> None:
        self._delete(f"{self.root}/_replay/intent/_SUCCESS")  # one file decides
        self._delete(f"{self.root}/_replay")
