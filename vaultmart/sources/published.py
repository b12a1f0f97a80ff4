"""Named layers: views ``<prefix>bronze|silver|gold|mart.<table>`` that show the run as of one batch.

Every view takes the batch it shows from one view, ``<prefix>run.published``: replacing that
view is the one catalog change that moves all layers together, so a reader during a load sees the old batch or the new
one, never parts.  Before a batch that is shown is written again, the pointer goes back to the batch before it.
The run folder keeps where the pointer stands, so a later application shows the same.

Views also hide what readers need not know: superseded versions, batch columns, the bucket count.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from vaultmart.sources.store import LayerStore

# What a view shows of its table: one folder or partition, all up to the batch, or a satellite's live versions.
FILES, BATCH, APPENDED, VERSIONS = "files", "batch", "appended", "versions"


class Published:
    """The views of a run; ``tables`` are (layer, table, kind)."""

    def __init__(self, store: LayerStore, prefix: str, tables: list[tuple[str, str, str]]) -> None:
        self.store, self.spark, self.prefix, self.tables = store, store.spark, prefix, tables
        self.pointer = f"`{prefix}run`.published"
        self._made: dict[str, str] = {}
        for db in ["run", *dict.fromkeys(layer for layer, _, _ in tables)]:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{prefix}{db}` LOCATION '{store.root}/catalog/{db}'")

    def shown(self) -> tuple[int, int]:
        """(batch, batch of the marts) that the run last showed; zeros before any."""
        path = f"{self.store.root}/_published"
        last = self.store._numbers(path, "move")
        return tuple(self.spark.read.parquet(f"{path}/move={last[-1]}").first()) if last else (0, 0)

    def show(self, batch: int, marts: int) -> None:
        """Show the layers as of ``batch``, and the marts of batch ``marts``; 0 shows no rows."""
        if not self._made:
            self._point(*self.shown())  # what readers see stays the same while views are made
        with ThreadPoolExecutor(max_workers=8) as pool:
            list(pool.map(self._make, self.tables))
        self._point(batch, marts)
        moves = self.store._numbers(f"{self.store.root}/_published", "move")
        self.store._record([(batch, marts)], "batch int, marts int", f"_published/move={(moves or [0])[-1] + 1}")
        for old in moves:
            self.store._delete(f"{self.store.root}/_published/move={old}")

    def _point(self, batch: int, marts: int) -> None:
        rows = []
        for layer, table, kind in self.tables:
            at = marts if layer == "mart" else batch
            base = self.store.open_base(table, at) if kind == VERSIONS else None
            closed = self.store.closed_start(table, at) if kind == VERSIONS else None
            rows.append(f"('{layer}.{table}', {at}, {'NULL' if base is None else base}, {'NULL' if closed is None else closed})")
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.pointer} AS SELECT name, CAST(batch AS INT) batch, CAST(base AS INT) base, "
                       f"CAST(closed AS INT) closed FROM VALUES {', '.join(rows)} AS t(name, batch, base, closed)")

    def _make(self, entry: tuple[str, str, str]) -> None:
        """Make the view of one table, anew if it names other files than before; none while the table is not there."""
        layer, table, kind = entry
        if kind == FILES:
            source = f"parquet.`{self.store.path(layer, table)}`"
            if not self.store._exists(self.store.path(layer, table)):
                return
        else:
            source = self.store.name(layer, table)
            if not self.spark.catalog.tableExists(source):
                return
        if self._made.get(f"{layer}.{table}") == source:
            return
        derived = {} if kind == FILES else self.store.missing(layer, table)
        cols = ", ".join([*(f"`{f.name}`" for f in self.spark.sql(f"SELECT * FROM {source}").schema.fields
                            if f.name not in ("batch", "is_current")), *(f"{sql} AS `{c}`" for c, sql in derived.items())])
        at = lambda c: f"(SELECT {c} FROM {self.pointer} WHERE name = '{layer}.{table}')"
        rows = source
        if kind == VERSIONS:
            key = self.store.keys[layer, table]
            where = (f"(is_current AND batch BETWEEN {at('base')} AND {at('batch')}) OR "
                     f"(NOT is_current AND batch BETWEEN {at('closed')} AND {at('batch')})")
            rows = (f"(SELECT *, max(CASE WHEN is_current THEN batch END) OVER (PARTITION BY `{key}`) AS _last "
                    f"FROM {source} WHERE {where})")
            where = "NOT is_current OR batch = _last"
        else:
            where = f"batch {'<=' if kind == APPENDED else '='} {at('batch')}"
        self.spark.sql(f"CREATE OR REPLACE VIEW `{self.prefix}{layer}`.`{table}` AS SELECT {cols} FROM {rows} WHERE {where}")
        self._made[f"{layer}.{table}"] = source
