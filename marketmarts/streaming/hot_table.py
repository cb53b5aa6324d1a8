"""Hot table: the newest record of every key, kept in a keyed stored table.

Each micro-batch is reduced to one record per key (partial aggregation first)
and merged into the buckets it touches.  The larger ``order_cols`` win,
whichever batch brings them, so a late record never replaces a newer one and a
batch that is run again changes nothing.  The stream itself keeps no state.

With ``retention`` records older than that, counted back from the newest event
time of the batch, leave the buckets that are rewritten, and ``recent`` never
shows them; ``expire`` rewrites the buckets that hold any.  The table is thus
bounded by the keys seen within the retention and what has not been touched
since.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge
from ..plans.stored import StoredTable
from .postings_stream import latest_per_key, recent as _recent


class HotTable:
    def __init__(self, table: StoredTable, order_cols: Sequence[str], ts_col: str = "event_time", retention: str | None = None):
        self.table, self.order_cols, self.ts_col, self.retention = table, list(order_cols), ts_col, retention

    def _stale(self, newest, col: str):
        return F.col(col) < F.lit(newest) - F.expr(f"INTERVAL {self.retention}")

    def merge(self, batch: DataFrame) -> dict[str, int]:
        """Merge one micro-batch; returns new and updated keys and the number of buckets rewritten."""
        names = self.table.schema.names
        key = self.table.key[0]
        rows = self.table.typed(latest_per_key(batch, key, self.order_cols, [c for c in names if c != key]))
        rows = rows.persist()  # read three times; a lost part is computed again from the micro-batch
        try:
            newest = rows.agg(F.max(self.ts_col)).first()[0]
            drop = None if self.retention is None or newest is None else self._stale(newest, f"r.{self.ts_col}")
            return merge.upsert_latest(self.table, rows, self.order_cols, drop)
        finally:
            rows.unpersist()

    def writer(self) -> Callable[[DataFrame, int], None]:
        """Function for ``foreachBatch``; a batch that is run again leaves the table as it was."""
        return lambda batch, batch_id: self.merge(batch) and None

    def read(self) -> DataFrame:
        return self.table.read()

    def recent(self, within: str = "1 hour") -> DataFrame:
        """Records newer than the newest one less ``within``."""
        return _recent(self.read(), self.ts_col, within)

    def expire(self) -> int:
        """Rewrite the buckets that hold records past the retention; returns how many were."""
        if self.retention is None:
            return 0
        all_rows = self.read()
        newest = all_rows.agg(F.max(self.ts_col)).first()[0]
        if newest is None:
            return 0
        old = all_rows.filter(self._stale(newest, self.ts_col))
        touched = self.table.touched(old)
        if touched:
            left = self.table.slice(touched).filter(~self._stale(newest, self.ts_col))
            kept = self.table.touched(left)
            self.table.replace(left)
            self.table.clear(sorted(set(touched) - set(kept)))
        return len(touched)
