"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Sources are ordered by code point (null last) and weigh 3, 1, 2, repeating.
They share ``budget`` times all words; a target stops at ``most`` times its
source's size and the excess is shared again by weight (water filling).

The words of a source lie in shards; within a shard the documents stand in
seeded order and their words form one stream that is cut into equal blocks of
B words (its last block may be shorter).  B is the same for all sources:
``block_words``, or a ``few``-th of the smallest target if that is less.
Blocks are seats: the mix has one seat per B words of all targets, sources win
seats by the highest quotients target / (2 s + 1), and the shards of a source
win its seats by blocks / (2 s + 1).  A source keeps at most ``most`` seats per
block; its upper quota is never more than that.

A shard with q seats and b blocks takes every block q div b times and q mod b
more blocks, spread evenly over the shard from a seeded start.  How many of the
first k blocks are taken is then a formula, and so is how many words of any
stretch: no table of blocks is made, however many there are, and no document
is taken more than ``most`` times its size.

Everything is DataFrame code.  Only (id, source, size) leaves the text scan.
Windows run over the list of sources, over the shards of a source and inside
one shard (bounded by ``shard_words`` words); a hot source is only more
shards.

Nulls and ties: a null text has size 0 and takes 0; a null source is a source
of its own, the last one; null ids and repeated rows are rows of their own in
the order of (seeded hash, id, size), and rows equal in all of these are
interchangeable; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketmarts.llm.common import stored

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
MOST = 2.0
BLOCK_WORDS = 256
FEW = 16  # blocks of the smallest target at least
SHARD_WORDS = 1_000_000
SEED = 17


def word_count(text):
    """Number of [^\\x20\\x09-\\x0D]+ in a text; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, budget: float = BUDGET, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """(source, size) -> (source, position, source_size, weight, target); one row per source.

    Water filling in closed form: in ascending order of cap / weight a source
    is capped if its cap is at most its share of what the capped ones before
    it have left.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("position", (F.row_number().over(order) - 1).cast("int"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("position") % len(weights) + 1)
    per = per.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "position")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("all_words", F.sum("source_size").over(everything) * F.lit(float(budget)))
           .withColumn("left_over", F.col("all_words") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("rest_weight", F.sum("weight").over(after))
           .withColumn("level", F.col("left_over") / F.col("rest_weight"))
           .withColumn("capped", F.col("cap") <= F.col("weight") * F.col("level")))
    # the first source that is not capped fixes the level of all after it
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "position", "level"))).over(everything)
    return (per.withColumn("fill_level", level["level"])
            .select("source", "position", "source_size", "weight",
                    F.least("cap", F.coalesce(F.col("weight") * F.col("fill_level"), F.col("cap"))).alias("target")))


def apportion(parties: DataFrame, seats: str, votes: str, within: list[str], order: list[str], out: str) -> DataFrame:
    """Sainte-Lague: ``seats`` (same for all rows of a ``within`` group) to the highest quotients votes / (2 s + 1).

    With V votes, S parties and M seats, every quotient of at least V / (2M - S)
    wins and none below V / (2M + S) does, so only the at most 2 S quotients
    between them are ranked.  Equal quotients go to the first party in
    ``order``.  Parties without votes get no seat.
    """
    group = Window.partitionBy(*within)
    at = lambda bound: F.floor((F.col(votes) / bound + 1) / 2).cast("bigint")
    base = (parties.withColumn("_v", F.sum(votes).over(group).cast("double"))
            .withColumn("_s", F.sum(F.when(F.col(votes) > 0, 1).otherwise(0)).over(group))
            .withColumn("_sure", F.when(2 * F.col(seats) > F.col("_s"),
                                        at(F.col("_v") / (2 * F.col(seats) - F.col("_s")) * (1 + 1e-9)))
                        .otherwise(F.lit(0).cast("bigint")))
            .withColumn("_sure", F.when(F.col(votes) > 0, F.col("_sure")).otherwise(0))
            .withColumn("_able", F.when((F.col(votes) > 0) & (F.col(seats) > 0),
                                        at(F.col("_v") / (2 * F.col(seats) + F.col("_s")) * (1 - 1e-9))).otherwise(0))
            .withColumn("_open", F.col(seats) - F.sum("_sure").over(group)))
    tries = base.withColumn("_seat", F.explode_outer(
        F.when(F.col("_able") > F.col("_sure"), F.sequence(F.col("_sure"), F.col("_able") - 1))))
    by_quotient = Window.partitionBy(*within).orderBy(
        F.col("_seat").isNull(), F.desc(F.col(votes) / (2 * F.col("_seat") + 1)), *order)
    won = tries.withColumn("_won", F.col("_seat").isNotNull() & (F.row_number().over(by_quotient) <= F.col("_open")))
    return (won.groupBy(*parties.columns, "_sure").agg(F.sum(F.col("_won").cast("bigint")).alias("_more"))
            .withColumn(out, F.col("_sure") + F.col("_more")).drop("_sure", "_more"))


def placed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED,
                budget: float = BUDGET, most: float = MOST, weights=WEIGHTS, few: int = FEW) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): rows with their words [begin, end) in a shard's stream and that shard's quota.

    Columns of a shard: ``width`` (words of a block), ``words``, ``blocks``,
    ``quota`` and ``start`` (0 .. blocks - 1, seeded).
    """
    rows = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
                              word_count(F.col(text_col)).alias("size")), "mix-sizes")
    least = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy())
    width = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.coalesce(least, F.lit(block_words)) / few)))
    sources = stored(
        targets(rows, budget, most, weights)
        .withColumn("n_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint"))
        .withColumn("width", width.cast("bigint")), "mix-sources")

    sharded = (rows.join(sources.select("source", "position", "n_shards", "width"), rows.source.eqNullSafe(sources.source))
               .select("id", "size", "position", "width", "n_shards", F.xxhash64(F.lit(seed), "id", "size").alias("_h"))
               .withColumn("shard", F.pmod(F.xxhash64("_h"), F.col("n_shards"))))
    shards = stored(sharded.groupBy("position", "shard", "width").agg(F.sum("size").alias("words")).filter("words > 0")
                    .withColumn("blocks", F.expr("(words + width - 1) div width")), "mix-shards")
    seats = (sources.join(shards.groupBy("position").agg(F.sum("blocks").alias("source_blocks")), "position")
             .withColumn("all", F.lit(0))
             .withColumn("seats", F.round(F.sum("target").over(Window.partitionBy("all")) / F.col("width")).cast("bigint")))
    won = apportion(seats.select("all", "position", "target", "source_blocks", "seats"), "seats", "target", ["all"], ["position"], "won")
    most_blocks = F.floor(F.col("source_blocks") * F.lit(float(most))).cast("bigint")
    won = won.select("position", F.least("won", most_blocks).alias("won"))
    quotas = apportion(shards.join(won, "position"), "won", "blocks", ["position"], ["shard"], "quota")
    quotas = stored(quotas.select("position", "shard", "words", "blocks", "quota", F.pmod(
        F.xxhash64(F.lit(seed), "position", "shard"), F.col("blocks")).alias("start")), "mix-quotas")

    stream = Window.partitionBy("position", "shard").orderBy("_h", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (sharded.withColumn("end", F.sum("size").over(stream)).withColumn("begin", F.col("end") - F.col("size"))
              .drop("_h", "n_shards").join(quotas, ["position", "shard"], "left"))
    return placed, sources


def _extra_blocks(k: str) -> str:
    """SQL: how many of a shard's first ``k`` blocks are taken once more than quota div blocks times."""
    return f"((({k}) * (quota % blocks) + start) div blocks)"


def _extra_words(w: str) -> str:
    """SQL: how many of a shard's first ``w`` words lie in such blocks."""
    k = f"(({w}) div width)"
    return (f"({_extra_blocks(k)} * width + ({_extra_blocks(k + ' + 1')} - {_extra_blocks(k)}) * (({w}) - {k} * width))")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """Per input row: id, size, source_size, target (its source's) and taken (words the mix takes, repeats counted)."""
    placed, sources = placed_rows(docs, id_col, text_col, source_col, **how)
    taken = f"coalesce(size * (quota div blocks) + {_extra_words('end')} - {_extra_words('begin')}, 0)"
    return placed.join(sources.select("position", "source_size", "target"), "position").select(
        F.col("id").alias(id_col), "size", "source_size", "target", F.expr(taken).alias("taken"))


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                **how) -> DataFrame:
    """The mix itself: ``docs`` with each row's text cut to its taken words, once per pass of the mix.

    A block taken twice gives its words to two rows of the document.  A text
    taken whole stays as it is; of others the taken words remain, each with
    the white space after it.  Rows of which nothing is taken go.
    """
    placed, _ = placed_rows(docs, id_col, text_col, source_col, **how)
    runs = f"""filter(transform(filter(sequence(begin div width, (end - 1) div width),
        k -> {_extra_blocks('k + 1')} > {_extra_blocks('k')}),
        k -> struct(cast(greatest(k * width, begin) - begin as int) as lo, cast(least((k + 1) * width, end) - begin as int) as hi)),
        r -> r.hi > r.lo)"""
    nth = Window.partitionBy("id", "size").orderBy("position", "shard", "begin")
    passes = (placed.filter("size > 0 and quota > 0").withColumn("_row", F.row_number().over(nth))
              .select(F.col("id").alias("_id"), F.col("size").alias("_words"), "_row", F.expr("quota div blocks").alias("_whole"),
                      F.expr(runs).alias("_runs"))
              .filter("_whole > 0 or size(_runs) > 0"))
    same = Window.partitionBy(id_col, "_size").orderBy(F.col(source_col).isNull(), F.col(source_col))
    numbered = (docs.withColumn("_size", word_count(F.col(text_col))).filter("_size > 0")
                .withColumn("_nth", F.row_number().over(same)))
    both = numbered.join(passes, F.col(id_col).eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_words"))
                         & (F.col("_nth") == F.col("_row")))
    # one row for each whole pass, and one of the blocks that are taken once more
    copies = F.expr("concat(array_repeat(cast(null as array<struct<lo: int, hi: int>>), cast(_whole as int)), "
                    "if(size(_runs) > 0, array(_runs), array()))")
    each = both.withColumn("_pass", F.explode(copies))
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.transform(F.array(words), lambda ws: F.array_join(F.transform(
        "_pass", lambda r: F.array_join(F.slice(ws, r["lo"] + 1, r["hi"] - r["lo"]), "")), ""))[0]
    kept = F.aggregate("_pass", F.lit(0).cast("bigint"), lambda n, r: n + (r["hi"] - r["lo"]))
    text = F.when(F.col("_pass").isNull() | (kept == F.col("_size")), F.col(text_col)).otherwise(cut)
    return each.withColumn(text_col, text).select(*docs.columns)
