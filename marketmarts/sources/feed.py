"""Posting feed derived from the driver's tables.

The driver ships TPC-H-like tables, not job postings, so every staging,
mart and report query reads a posting-shaped projection of
``orders JOIN customer``: one raw posting per order, with values assigned
by rules on the order key (every order becomes a posting; nothing is
filtered out here).  ``seq`` is the ingest order and every tenth order is
a re-fetch of an earlier posting from the same source.

The join is left to the planner: with AQE it broadcasts ``customer`` only
when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
and otherwise runs a sort-merge join, so nothing unbounded is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import load, spread
from .conform import conform_feed

# FIXED VALUES of the derived feed (titles, skill hints, descriptions).
FEED_TITLES = [
    "Data Engineer", "Senior Data Engineer", "Lead Cloud Data Engineer",
    "AI Engineer", "Machine Learning Engineer", "Sr. ML Engineer",
    "Data Analyst", "Business Intelligence Analyst", "Analytics Engineer",
    "Data Scientist", "MLOps Engineer", "Junior Data Scientist",
    "HTML Engineer", "Product Manager",
]
FEED_SKILL_HINTS = [
    "Python|SQL|Airflow", "pyspark|Kafka|k8s", "scikit-learn| dbt |excel",
    "go|golang|vector db", "", "A/B testing|feast|PyTorch",
]
FEED_DESCRIPTIONS = [
    "Scalable storage on trusted hardware.",
    "Heavy javascript stack; Go services, RAG pipelines",
    "Build ETL into Snowflake / BigQuery with Terraform",
    "scikit-learn and a/b testing",
    None,
]
FEED_COMPANY_SUFFIXES = ["", " Co., Ltd.", " Inc.", " Corp"]
FEED_CITIES = ["Taipei", "Hsinchu", "Remote", None]
FEED_SOURCES = ["104", "yourator", "sample"]


def _pick(key, values):
    """values[key % len(values)] as a CASE expression."""
    expr = None
    n = len(values)
    for i, v in enumerate(values):
        cond = (key % n) == i
        lit = F.lit(v).cast("string")
        expr = F.when(cond, lit) if expr is None else expr.when(cond, lit)
    return expr


def feed_columns(orders: DataFrame, customer: DataFrame) -> DataFrame:
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    c = customer.select("c_custkey", "c_mktsegment", "c_nationkey")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    k = F.col("o_orderkey")
    disclosed = F.col("o_orderstatus") != "P"
    low = F.floor(F.lit(40000) + F.col("o_totalprice") / 5).cast("int")
    return j.select(
        k.alias("seq"),
        _pick(k, FEED_SOURCES).alias("source"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("P-"), F.when(k % 10 == 9, k - 3).otherwise(k).cast("string")))
        .alias("posting_id"),
        F.when(k % 103 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("fetched_at"),
        _pick(k, FEED_TITLES).alias("role_raw"),
        F.when(k % 11 == 0, F.lit(None).cast("int")).otherwise((k % 9).cast("int")).alias("experience_years_min"),
        F.concat(F.lit("Firm "), F.col("o_custkey").cast("string"), _pick(k, FEED_COMPANY_SUFFIXES)).alias(
            "company_name"
        ),
        F.when(k % 5 == 0, F.lit(None).cast("string")).otherwise(F.lower("c_mktsegment")).alias("headcount_band"),
        _pick(F.col("c_nationkey"), FEED_CITIES).alias("city"),
        disclosed.alias("salary_disclosed"),
        F.when(disclosed, low).alias("salary_monthly_low"),
        F.when(disclosed & (k % 97 != 0), low + (k % 7).cast("int") * 3001).alias("salary_monthly_high"),
        _pick(k, FEED_SKILL_HINTS).alias("skills_delim"),
        _pick(k, FEED_DESCRIPTIONS).alias("description_excerpt"),
    )


def posting_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings (POSTING_FEED shape + ``seq``) derived from orders/customer."""
    flat = feed_columns(spread(load(spark, sf_dir, "orders")), load(spark, sf_dir, "customer"))
    shaped = flat.select(
        "seq",
        "posting_id",
        "source",
        "fetched_at",
        "role_raw",
        F.struct(
            F.col("company_name").alias("name"),
            F.col("headcount_band").alias("headcount_band"),
            F.lit(None).cast("int").alias("headcount_est"),
            F.lit(None).cast("string").alias("industry"),
        ).alias("company"),
        "city",
        "experience_years_min",
        "salary_monthly_low",
        "salary_monthly_high",
        "salary_disclosed",
        F.split("skills_delim", r"\|").alias("skills_raw"),
        "description_excerpt",
    )
    return conform_feed(shaped)


# --------------------------------------------------------------------------
# Board pages and landing lines derived from the feed (one page per posting).
# --------------------------------------------------------------------------

def board_a_pages(feed: DataFrame) -> DataFrame:
    """(fetched_at, payload): board A page JSON, one job per feed row.

    NULL fields are left out of the JSON (Spark's default), so a missing
    company name (every 13th order) makes a job the mapper must drop.
    """
    k = F.col("seq")
    job = F.struct(
        F.col("role_raw").alias("jobName"),
        F.when(k % 13 != 0, F.col("company.name")).alias("custName"),
        F.when(k % 7 != 0, k.cast("string")).alias("jobNo"),
        F.concat(F.lit("J"), k.cast("string")).alias("jobId"),
        F.col("salary_monthly_low").cast("string").alias("salaryLow"),
        F.col("salary_monthly_high").cast("string").alias("salaryHigh"),
        F.col("city").alias("jobAddrNoDesc"),
        F.concat(F.lit("Addr "), (k % 50).cast("string")).alias("jobAddress"),
        F.repeat(F.coalesce(F.col("description_excerpt"), F.lit("")), 30).alias("description"),
        F.struct(F.concat(F.lit("/job/"), k.cast("string")).alias("job")).alias("link"),
    )
    page = F.struct(F.struct(F.array(job).alias("list")).alias("data"))
    return feed.select("fetched_at", F.to_json(page).alias("payload"))


def board_b_pages(feed: DataFrame) -> DataFrame:
    """(fetched_at, payload): board B page JSON, one job per feed row.

    Salaries alternate between monthly figures and annual figures in 10k
    units (every 23rd is 0, i.e. undisclosed); every 17th job lacks a
    company name.
    """
    k = F.col("seq")

    def pay(c):
        return (
            F.when(k % 23 == 0, F.lit(0))
            .when(k % 2 == 0, F.col(c))
            .otherwise(F.floor(F.col(c) / 5000).cast("int"))
        )

    job = F.struct(
        k.alias("id"),
        F.col("role_raw").alias("name"),
        F.struct(
            F.when(k % 17 != 0, F.col("company.name")).alias("name"),
            F.col("company.headcount_band").alias("size"),
            F.concat(F.lit("Industry "), (k % 5).cast("string")).alias("industry"),
            F.concat(F.lit("firm-"), (k % 200).cast("string")).alias("slug"),
        ).alias("company"),
        pay("salary_monthly_low").alias("salary_min"),
        pay("salary_monthly_high").alias("salary_max"),
        F.col("city").alias("city"),
        (F.col("city") == "Remote").alias("remote_friendly"),
        F.transform(F.col("skills_raw"), lambda s: F.struct(s.alias("name"))).alias("tags"),
        F.col("description_excerpt").alias("description"),
    )
    return feed.select("fetched_at", F.to_json(F.struct(F.array(job).alias("jobs"))).alias("payload"))


def landing_lines(feed: DataFrame) -> DataFrame:
    """Line-JSON text of every feed row, plus odd lines after some orders (added lines; no row is left out).

    Bad ones: broken JSON, a list, a number, text after the object.  Good
    ones: a key that stands twice, NaN as a salary, a time that cannot be
    read, a salary as text and a company that is no object.
    """
    k, n = F.col("seq"), F.col("seq").cast("string")
    cols = [c for c in feed.columns if c != "seq"]
    record = F.to_json(F.struct(*[F.col(c) for c in cols]))

    def extra(every: int, line: str) -> Column:
        return F.when(k % every == 0, F.regexp_replace(F.lit(line), "#", n))

    lines = F.array(
        record, extra(37, "{bad"), extra(41, "   "), extra(67, "[1, 2]"), extra(71, "#"), extra(73, '{"posting_id": "T-#"} x'),
        extra(43, '{"posting_id": "A-#", "source": "sample", "fetched_at": "2024-01-01T00:00:00", "posting_id": "B-#"}'),
        extra(47, '{"posting_id": "N-#", "source": "sample", "fetched_at": "2024-01-02T00:00:00", "salary_monthly_low": NaN}'),
        extra(61, '{"posting_id": "U-#", "source": "sample", "fetched_at": "garbled"}'),
        extra(59, '{"posting_id": #, "source": "sample", "fetched_at": "2024-01-03", "salary_monthly_high": "70000", "company": "none"}'))
    return feed.select(F.explode(F.array_compact(lines)).alias("value"))
