"""Merging one batch's staging rows with what is stored.

Running two batches one after the other gives the same tables as one run
over both, and running a batch again changes nothing.

``merge_*`` work on frames.  ``upsert_*`` work on stored keyed tables
(``plans.stored.StoredTable``): the batch is shuffled to the table's buckets,
only buckets that hold one of its keys are read (without an Exchange) and
rewritten, and the raw table is only appended to.  Each returns row counts
observed during its write.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import observed
from .staging import LARGE, ORDERS, RAW_KEY


def _same(left: DataFrame, right: DataFrame, key: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in key])


def merge_raw(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored fetches stay, new ones are added; repeated arrivals only raise ``n_fetches`` where it is kept."""
    key = [k for k in RAW_KEY if k in stored.columns]
    old = stored.select(*key)
    new = batch.join(old.hint(LARGE), _same(batch, old, key), "left_anti")
    kept = stored
    if "n_fetches" in stored.columns:
        more = batch.select(*key, F.col("n_fetches").alias("_more"))
        kept = stored.join(more.hint(LARGE), _same(stored, more, key), "left").select(
            *[stored[c] for c in stored.columns if c != "n_fetches"],
            (stored["n_fetches"] + F.coalesce(more["_more"], F.lit(0))).alias("n_fetches"))
    return kept.select(*stored.columns).unionByName(new.select(*stored.columns))


def merge_companies(stored: DataFrame, batch: DataFrame, order: str = "ingest") -> DataFrame:
    """Attributes and first_seen_at of a stored company stay; last_seen_at follows the batch.

    ``order="ingest"`` takes the batch's time as the last one processed,
    ``order="event_time"`` the later of the two.
    """
    return _chosen(stored, batch, ["name_canonical"], _company(order)).select(*stored.columns)


def merge_postings(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """A posting of the batch replaces the stored one (see ``staging.postings`` for hints of older fetches)."""
    return _chosen(stored, batch, ["posting_id"], F.coalesce("b", "s")).select(*stored.columns)


def new_companies(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """Companies of the batch that the stored dimension lacks."""
    return batch.join(stored.select("name_canonical"), "name_canonical", "left_anti")


def _company(order: str) -> Column:
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    seen, before = F.col("b.last_seen_at"), F.col("s.last_seen_at")
    last = F.coalesce(seen, before) if order == "ingest" else F.greatest(seen, before)
    return (F.when(F.col("s").isNull(), F.col("b")).when(F.col("b").isNull(), F.col("s"))
            .otherwise(F.col("s").withField("last_seen_at", last)))


def _paired(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """key, s, b: the stored row and the batch's row of every key, NULL where there is none."""
    whole = F.struct(*[F.col(c) for c in stored.columns])
    return stored.select(*key, whole.alias("s")).join(batch.select(*key, whole.alias("b")).hint(LARGE), key, "full")


def _chosen(stored: DataFrame, batch: DataFrame, key: list[str], row: Column) -> DataFrame:
    return _paired(stored, batch, key).select(row.alias("r")).select("r.*")


def upsert_raw(table, batch: DataFrame) -> dict[str, int]:
    """New fetches are appended; nothing stored is rewritten.

    The table is keyed by (source, source_post_id), so fetches of one posting
    share a bucket; which of them are stored already is the join's remaining
    condition.
    """
    old = table.slice(table.touched(batch)).select(*[F.col(k).alias(f"_{k}") for k in RAW_KEY])
    seen = Observation("raw")
    new = batch.join(old.hint(LARGE), _same_fetch(), "left_anti").observe(seen, F.count(F.lit(1)).alias("new"))
    table.append(new)
    return observed(seen, "new")


def _same_fetch() -> Column:
    """A fetch and another one, whose key columns begin with ``_``, are the same."""
    posting = (F.col("source") == F.col("_source")) & (F.col("source_post_id") == F.col("_source_post_id"))
    # stated as two bounds it stays a condition and does not ask for another partitioning of the stored side
    time, never = F.coalesce("fetched_at", F.lit("0001-01-01").cast("timestamp_ntz")), F.lit("0001-01-01").cast("timestamp_ntz")
    old_time = F.coalesce("_fetched_at", never)
    text, old_text = F.coalesce("fetched_at_text", F.lit("")), F.coalesce("_fetched_at_text", F.lit(""))
    return posting & (time <= old_time) & (time >= old_time) & (text <= old_text) & (text >= old_text)


def upsert_raw_counted(table, batch: DataFrame) -> dict[str, int]:
    """As ``merge_raw``, on a stored raw table that also keeps ``n_fetches``.

    New fetches come in and repeated ones raise the count of the stored row,
    whose first arrival stays; the buckets that hold a posting of the batch
    are rewritten.  Counting is not repeatable: a batch is given once.
    """
    touched = table.touched(batch)
    if not touched:
        return {"new": 0, "updated": 0, "buckets": 0}
    stored = table.slice(touched)
    keys = [F.col(k).alias(f"_{k}") for k in RAW_KEY]
    seen_new, seen_old = Observation("raw_new"), Observation("raw_old")
    new = batch.join(stored.select(*keys).hint(LARGE), _same_fetch(), "left_anti").observe(seen_new, F.count(F.lit(1)).alias("new"))
    # a position that stands twice gives a fetch two rows, each with the count of both: one of them counts
    more = batch.groupBy(*keys).agg(F.max("n_fetches").alias("_more"))
    again = stored.join(more.hint(LARGE), _same_fetch(), "left").observe(
        seen_old, F.count("_more").alias("updated"))
    kept = again.withColumn("n_fetches", F.col("n_fetches") + F.coalesce("_more", F.lit(0)))
    names = table.schema.names
    table.replace(kept.select(*names).unionByName(new.select(*names)))
    return observed(seen_new, "new") | observed(seen_old, "updated") | {"buckets": len(touched)}


def upsert(table, batch: DataFrame, row: Column, drop: Column | None = None, **counts: Column) -> dict[str, int]:
    """Rewrite the touched buckets with ``row``, chosen from ``s`` (stored) and ``b`` (batch) for every key.

    Rows for which ``drop`` holds (a condition on the chosen ``r``) go.
    ``counts`` are conditions on s and b whose rows are counted besides
    ``new`` and ``updated``.
    """
    touched = table.touched(batch)
    if not touched:
        return {"new": 0, "updated": 0, "buckets": 0, **dict.fromkeys(counts, 0)}
    seen = Observation("upsert")
    is_new, is_old = F.col("s").isNull(), F.col("s").isNotNull()
    pairs = _paired(table.slice(touched), batch.select(*table.schema.names), table.key).observe(
        seen, F.count_if(is_new).alias("new"), F.count_if(is_old & F.col("b").isNotNull()).alias("updated"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in counts.items()])
    rows = pairs.select(row.alias("r"))
    if drop is not None:
        rows = rows.filter(~F.coalesce(drop, F.lit(False)))
    table.replace(rows.select("r.*"))
    return observed(seen, "new", "updated", *counts) | {"buckets": len(touched)}


def upsert_companies(table, batch: DataFrame, order: str = "ingest") -> dict[str, int]:
    """As ``merge_companies``, on a stored table."""
    return upsert(table, batch, _company(order))


def upsert_postings(table, batch: DataFrame) -> dict[str, int]:
    """As ``merge_postings``, on a stored table; counts postings with skills that go and that come."""
    some = lambda side: F.size(F.col(f"{side}.skills_canonical")) > 0
    return upsert(table, batch, F.coalesce("b", "s"), skilled_out=F.col("b").isNotNull() & some("s"), skilled_in=some("b"))


def upsert_latest(table, batch: DataFrame, order_cols: list[str], drop: Column | None = None) -> dict[str, int]:
    """The row of the largest ``order_cols`` per key stays, whichever batch brings it; one batch row per key."""
    order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in order_cols])
    newer = F.col("s").isNull() | (F.col("b").isNotNull() & (order("b") >= order("s")))
    return upsert(table, batch, F.when(newer, F.col("b")).otherwise(F.col("s")), drop)
