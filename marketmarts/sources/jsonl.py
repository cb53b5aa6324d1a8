"""Line-JSON landing files: scan (blank/bad lines skipped) and write.

Files are discovered by Spark (recursive lookup, ``*.jsonl`` filter) and
split like any text source; nothing is read on the driver.  Ingest order
(``seq``) is the struct (file path, position in file), so the staging
"last row wins" rules are deterministic and do not depend on how splits
are packed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import RAW_POSTING
from ..session import observed, path_exists
from .conform import conform_feed


def scan_lines(spark: SparkSession, paths: str | Sequence[str], glob: str = "*.jsonl", first: str | None = None) -> DataFrame:
    """(file_path, seq, line) for every non-blank, trimmed line, in one pass over the text.

    ``seq`` = STRUCT<file_path, pos> and orders like (file, position): ``first``
    (one file that goes before all others), then files by the parts of their
    paths.  ``pos`` is the split's byte offset plus the row index within the
    task.  A task reads at most one split size of bytes and every line has at
    least one byte, so the rows of different splits of a file get disjoint,
    ordered ranges.  Nothing is shuffled and the text is read once.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    wanted = [paths] if isinstance(paths, str) else list(paths)
    raw = reader.text(wanted if first is None else [first, *wanted])
    path = F.col("_metadata.file_path")
    # path separators sort before all other characters, as when paths are compared part by part
    leads = F.lit(False) if first is None else F.col("_metadata.file_path").endswith(first.removeprefix("file:"))
    order = F.concat(F.when(leads, "0").otherwise("1"), F.translate(path, "/", "\x01"))
    pos = F.col("_metadata.file_block_start") + F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1))
    lines = raw.select(
        path.alias("file_path"),
        F.struct(order.alias("file_path"), pos.alias("pos")).alias("seq"),
        F.regexp_replace("value", r"^\s+|\s+$", "").alias("line"),
    )
    return lines.filter(F.col("line") != "")


def _parsed(schema: T.StructType) -> Column:
    """One permissive parse of ``line``: STRUCT<line ARRAY<fields as text>, _bad>.

    The line stands as the only element of an array, so that text after its
    JSON value is an error too.  Every field is read as text: a number, a NaN
    or a nested value never makes its line a bad one, and a key that occurs
    twice has its last value.
    """
    fields = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    return F.from_json(F.concat(F.lit('{"line":['), "line", F.lit("]}")), f"line ARRAY<STRUCT<{fields}>>, _bad STRING", {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "allowSingleQuotes": "false"})


def _is_object(parsed: Column) -> Column:
    lines = parsed["line"]
    return F.coalesce(parsed["_bad"].isNull() & (F.size(lines) == 1) & F.get(lines, F.lit(0)).isNotNull(), F.lit(False))


def parse_postings(lines: DataFrame, schema=RAW_POSTING) -> DataFrame:
    """Keep lines that are JSON objects and map them to the posting feed shape.

    Other lines are skipped silently (as the pipeline does); their count is
    available with :func:`bad_line_count`.  Values are cast when conformed:
    one that does not fit its type is NULL, and its line stays.
    """
    parsed = lines.select("seq", "file_path", _parsed(schema).alias("p"))
    rows = parsed.filter(_is_object(F.col("p"))).select("seq", "file_path", F.get("p.line", F.lit(0)).alias("r")).select(
        "seq", "file_path", "r.*")
    nested = {f.name: F.from_json(f.name, _texts(f.dataType)) for f in schema.fields
              if isinstance(f.dataType, (T.StructType, T.ArrayType))}
    return conform_feed(rows.withColumns(nested), keep=("seq", "file_path"))


def _texts(kind: T.DataType) -> T.DataType:
    """``kind`` with every value read as text."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _texts(f.dataType)) for f in kind.fields])
    return T.ArrayType(_texts(kind.elementType)) if isinstance(kind, T.ArrayType) else T.StringType()


def bad_line_count(lines: DataFrame) -> DataFrame:
    """Number of non-blank lines that are not JSON objects (a run metric)."""
    return lines.select(_parsed(T.StructType([RAW_POSTING["posting_id"]])).alias("p")).agg(
        F.count_if(~_is_object(F.col("p"))).alias("bad_lines"))


def read_postings_jsonl(spark: SparkSession, paths, glob: str = "*.jsonl", legacy: str | None = None) -> DataFrame:
    """S1 + S2: every posting line under ``paths`` in ingest order; the ``legacy`` file, if there is one, comes first.

    Raises ``FileNotFoundError`` when no landing file matches (the file
    listing is the planner's own metadata; no data is read for the check).
    """
    lines = scan_lines(spark, paths, glob, legacy if legacy and path_exists(spark, legacy) else None)
    if not lines.inputFiles():
        raise FileNotFoundError(f"no {glob} files under {paths}")
    return parse_postings(lines)


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = "source") -> int:
    """Write line-JSON (one folder per value of ``partition_by``, which the lines do not repeat) and return the number of rows written.

    The row count is collected with an ``Observation`` during the write, so
    the data is not scanned twice.
    """
    obs = Observation("jsonl_rows")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("compression", "none")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.json(path)
    return observed(obs, "rows")["rows"]
