"""Staging: required fields, raw dedup, company dimension, latest posting.

All "first/last row per key" steps first find *positions*: hash aggregates over
fixed-width values (``seq``, times) that combine before their shuffle, so a hot
key (say the company ``unknown`` holding a third of all rows) reaches the
shuffle as one row per map task.  The rows at those positions are then fetched
by an equi-join on ``seq``, which is unique and so has no hot key.  Wide rows
are shuffled once at most, and never sorted by a text key.

A ``seq`` that is a (file, position) struct works the same way; only its
minimum and maximum are sort-based, over rows of key and position.

Both sides of these joins grow with the feed.  The planner judges a written
layer by its compressed files, of which 10 MB may hold millions of rows, and
would send them through the driver as a broadcast; ``LARGE`` keeps such joins
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import classify, skills
from ..functions.fixed_values import COMPANY_UNKNOWN, DEFAULT_CURRENCY, DEFAULT_SOURCE
from ..functions.text import blank_to_null

ORDERS = ("ingest", "event_time")

#: Join hint: neither side is broadcast, whatever the planner takes its size for.
LARGE = "merge"


def required_fields(feed: DataFrame) -> DataFrame:
    """Drop rows with a NULL/empty posting_id or without a fetched_at (one that cannot be read counts as given)."""
    given = F.col("fetched_at").isNotNull()
    if "fetched_at_text" in feed.columns:
        given = given | F.coalesce(F.col("fetched_at_text") != "", F.lit(False))
    return feed.filter(F.col("posting_id").isNotNull() & (F.col("posting_id") != "") & given)


def with_defaults(df: DataFrame) -> DataFrame:
    """Default values applied when a raw posting omits a field."""
    return df.withColumns({
        "source": F.coalesce(F.col("source"), F.lit(DEFAULT_SOURCE)),
        "role_raw": F.coalesce(F.col("role_raw"), F.lit("")),
        "salary_currency": F.coalesce(F.col("salary_currency"), F.lit(DEFAULT_CURRENCY)),
        "is_remote": F.coalesce(F.col("is_remote"), F.lit(False)),
        "salary_disclosed": F.coalesce(F.col("salary_disclosed"), F.lit(False)),
    })


def company_name_raw(df: DataFrame) -> DataFrame:
    """Adds name_raw ('unknown' when absent) and name_canonical."""
    name_raw = F.coalesce(blank_to_null(F.col("company.name")), F.lit(COMPANY_UNKNOWN))
    return df.withColumns({"name_raw": name_raw, "name_canonical": classify.canonical_company(name_raw)})


def company_key(name_canonical) -> F.Column:
    """Surrogate company key: a stable 64-bit hash of the canonical name."""
    return F.xxhash64(name_canonical)


RAW_KEY = ["source", "source_post_id", "fetched_at", "fetched_at_text"]


def raw_postings(valid: DataFrame) -> DataFrame:
    """Raw table: one row per (source, source_post_id, fetched_at); first arrival wins.

    ``payload`` is the JSON text of the whole raw posting; ``raw_id`` is
    the ingest position of the kept row (a hash of it when the position is
    a (file, offset) struct) and ``n_fetches`` how many arrived.  Times that
    cannot be read are told apart by their text.
    """
    text = F.col("fetched_at_text") if "fetched_at_text" in valid.columns else F.lit(None).cast("string")
    keys = valid.select(F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"), F.col("posting_id").alias("source_post_id"),
                        "fetched_at", text.alias("fetched_at_text"), F.col("seq").alias("_first"))
    first = keys.groupBy(*RAW_KEY).agg(F.min("_first").alias("_first"), F.count(F.lit(1)).alias("n_fetches"))
    whole = F.to_json(F.struct(*[F.col(c) for c in valid.columns if c != "seq"]))
    rows = first.join(valid.select("seq", whole.alias("payload")).hint(LARGE), F.col("_first") == F.col("seq"))
    raw_id = F.col("seq") if _numeric(valid) else F.xxhash64("seq")
    return rows.select(*RAW_KEY, raw_id.alias("raw_id"), "payload", "n_fetches")


def _numeric(df: DataFrame) -> bool:
    return isinstance(df.schema["seq"].dataType, T.NumericType)


def companies(valid: DataFrame, order: str = "ingest") -> DataFrame:
    """Company dimension: attributes fixed by the first row, last_seen_at by the last.

    ``order="ingest"`` takes the last row processed (the coded behaviour);
    ``order="event_time"`` takes the latest fetched_at instead.
    """
    if order not in ORDERS:
        raise ValueError(f"order must be one of {ORDERS}")
    names = company_name_raw(valid.select("company", "fetched_at", "seq"))
    last = F.max_by("fetched_at", "seq") if order == "ingest" else F.max("fetched_at")
    seen = names.groupBy("name_canonical").agg(F.min("seq").alias("_first"), last.alias("last_seen_at"))
    attributes = company_name_raw(valid.select("company", F.col("fetched_at").alias("first_seen_at"), "seq")).drop("name_canonical")
    rows = seen.join(attributes.hint(LARGE), F.col("_first") == F.col("seq"))
    return rows.select(
        company_key(F.col("name_canonical")).alias("company_id"),
        "name_canonical",
        "name_raw",
        F.col("company.headcount_band").alias("headcount_band"),
        F.col("company.headcount_est").alias("headcount_est"),
        F.col("company.industry").alias("industry"),
        "first_seen_at",
        "last_seen_at",
    )


_POSTING_FIELDS = (
    "source", "fetched_at", "role_raw", "city", "is_remote", "experience_years_min",
    "experience_years_max", "education_min", "salary_monthly_low", "salary_monthly_high",
    "salary_currency", "salary_disclosed", "description_excerpt", "description", "name_raw", "name_canonical",
)


def _micros() -> F.Column:
    """fetched_at in microseconds; a time that cannot be read is older than all others."""
    return F.coalesce(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', fetched_at)"), F.lit(-(10**17)))


def _newest_fetch(numeric: bool) -> F.Column:
    """Aggregate: ``seq`` of the newest fetch; of its copies the first to arrive (as in the raw table)."""
    if not numeric:
        return F.min_by("seq", F.struct(-_micros(), "seq"))
    # time and position as one number of fixed width
    span = F.lit("10000000000000000000").cast("decimal(20,0)")
    return F.max_by("seq", _micros().cast("decimal(18,0)") * span - F.col("seq").cast("decimal(19,0)"))


def positions(valid: DataFrame) -> DataFrame:
    """(posting_id, last_seq, hint_seq, hints_at): where the last row and the newest fetch's hints of a posting stand.

    Hints come from the newest raw fetch of (source, posting_id), where
    source is the one of the last row.
    """
    rows = valid.select("posting_id", F.coalesce("source", F.lit(DEFAULT_SOURCE)).alias("source"), "fetched_at", "seq")
    per_source = rows.groupBy("posting_id", "source").agg(
        F.max("seq").alias("last_seq"), _newest_fetch(_numeric(valid)).alias("hint_seq"), F.max("fetched_at").alias("hints_at"))
    return per_source.groupBy("posting_id").agg(
        F.max_by("hint_seq", "last_seq").alias("hint_seq"), F.max_by("hints_at", "last_seq").alias("hints_at"),
        F.max("last_seq").alias("last_seq"))


def latest_postings(valid: DataFrame) -> DataFrame:
    """Last row per posting_id (by ``seq``) plus the hints of its newest fetch."""
    valid = valid if "description" in valid.columns else valid.withColumn("description", F.lit(None).cast("string"))
    at = positions(valid)
    last = valid.join(at.drop("posting_id").hint(LARGE), F.col("seq") == F.col("last_seq"))
    # most postings have their hints in their last row; the others fetch them
    # (with hints_at, so that both uses of the positions read the same columns and share their exchanges)
    elsewhere = (at.filter(F.col("hint_seq") != F.col("last_seq"))
                 .select(F.col("last_seq").alias("_last"), "hint_seq", F.col("hints_at").alias("_at"))
                 .join(valid.select(F.col("seq").alias("_seq"), F.col("skills_raw").alias("_hints")).hint(LARGE),
                       F.col("hint_seq") == F.col("_seq"))
                 .select("_last", "_hints", "_at"))
    both = last.join(elsewhere.hint(LARGE), F.col("last_seq") == F.col("_last"), "left")
    own = F.col("hint_seq") == F.col("last_seq")
    both = both.withColumn("hints", F.when(own, F.col("skills_raw")).otherwise(F.col("_hints"))).withColumn(
        "hints_at", F.when(own, F.col("hints_at")).otherwise(F.col("_at")))
    rows = company_name_raw(with_defaults(both))
    return rows.select("posting_id", *_POSTING_FIELDS, "hints", "hints_at")


def hints_of_older_fetches(latest: DataFrame, stored_raw: DataFrame) -> DataFrame:
    """Take the hints of a stored fetch where it is at least as new as the batch's newest one."""
    stored = stored_raw.groupBy("source", "source_post_id").agg(
        F.max_by("payload", "fetched_at").alias("_payload"), F.max("fetched_at").alias("_at"))
    joined = latest.join(stored.withColumnRenamed("source_post_id", "posting_id").hint(LARGE), ["source", "posting_id"], "left")
    older = F.from_json("_payload", "skills_raw ARRAY<STRING>").getField("skills_raw")
    return joined.withColumn("hints", F.when(F.col("_at") >= F.col("hints_at"), older).otherwise(F.col("hints"))).drop(
        "_payload", "_at")


def postings(valid: DataFrame, match: str = "substring", stored_raw: DataFrame | None = None) -> DataFrame:
    """Staged postings: latest row per posting, classified, with skills and company key.

    With ``stored_raw`` (the raw table of earlier batches) hints come from the
    newest fetch of all batches.
    """
    latest = latest_postings(valid)
    if stored_raw is not None:
        latest = hints_of_older_fetches(latest, stored_raw)
    whole = F.coalesce("description", "description_excerpt")  # the excerpt is its beginning
    p = skills.with_haystack(latest, skills.extraction_text(F.col("role_raw"), whole))
    # the role struct is its own column so its rules run once for both fields
    p = p.withColumn("_role", classify.role(F.col("role_raw")))
    return p.select(
        "posting_id",
        "source",
        "fetched_at",
        "role_raw",
        F.col("_role.role_canonical").alias("role_canonical"),
        F.col("_role.role_family").alias("role_family"),
        classify.seniority(F.col("role_raw"), F.col("experience_years_min")).alias("seniority"),
        company_key(F.col("name_canonical")).alias("company_id"),
        F.col("name_canonical").alias("company_canonical"),
        "city",
        "is_remote",
        "experience_years_min",
        "experience_years_max",
        "education_min",
        "salary_monthly_low",
        "salary_monthly_high",
        "salary_currency",
        "salary_disclosed",
        skills.extract(F.col("_hay"), F.col("hints"), match).alias("skills_canonical"),
        "description_excerpt",
    )


def with_company(postings_df: DataFrame, companies_df: DataFrame) -> DataFrame:
    """postings LEFT JOIN companies USING (company_id): adds the first-seen band and industry.

    Never a broadcast: the company dimension grows with the data, and its
    files do not tell its size in memory.  AQE splits skewed company
    partitions.
    """
    c = companies_df.select("company_id", "headcount_band", "industry").hint(LARGE)
    return postings_df.join(c, "company_id", "left")


def stage(feed: DataFrame, match: str = "substring", order: str = "ingest"):
    """(raw_postings, companies, postings) for one batch of raw postings."""
    valid = required_fields(feed)
    return raw_postings(valid), companies(valid, order), postings(valid, match)
