"""Board payload mappers: page JSON text -> raw posting rows.

Each page is one row of text; ``from_json`` + ``explode`` unroll the job
list and a single projection maps fields.  Invalid page JSON parses to
NULL and yields no rows (the fetcher treated it as an empty page).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    BOARD_A_ID_PREFIX,
    BOARD_A_SOURCE,
    BOARD_A_URL_PREFIX,
    BOARD_B_ID_PREFIX,
    BOARD_B_SOURCE,
    DEFAULT_CURRENCY,
    DESCRIPTION_MAX_CHARS,
)
from ..functions.salary import annual_to_monthly
from ..functions.text import blank_to_null

# Jobs are read as maps so a key that is present with a NULL value can be told
# apart from a missing key (the mappers need the keys, not the values).
# Board A's values stay variants: an undisclosed salary is the number 0, while
# the text "0" counts as given.  Nested objects arrive as their JSON text.
_BOARD_A_PAGE = "STRUCT<data: STRUCT<list: ARRAY<MAP<STRING, VARIANT>>>>"
_BOARD_B_PAGE = "STRUCT<jobs: ARRAY<MAP<STRING, STRING>>>"


def _excerpt(c: Column) -> Column:
    return F.substring(F.coalesce(c, F.lit("")), 1, DESCRIPTION_MAX_CHARS)


def _own_id(*parts: Column) -> Column:
    """An id for a job that its board gives none: unrelated jobs must not share one."""
    return F.substring(F.sha2(F.to_json(F.array(*[F.coalesce(p, F.lit("")) for p in parts])), 256), 1, 16)


def map_board_a(pages: DataFrame, payload: str = "payload", fetched_at: str = "fetched_at") -> DataFrame:
    """Board A pages -> raw postings. Jobs without a title or company key are dropped."""
    jobs = pages.select(
        F.col(fetched_at).alias("fetched_at"),
        F.explode(F.from_json(F.col(payload), _BOARD_A_PAGE).getField("data").getField("list")).alias("j"),
    )
    number_zero = F.expr(
        "schema_of_variant(v['salaryLow']) <> 'STRING' AND try_variant_get(v['salaryLow'], '$', 'double') = 0")
    jobs = jobs.withColumnRenamed("j", "v").select(
        "fetched_at", F.transform_values("v", lambda k, x: F.try_variant_get(x, "$", "string")).alias("j"),
        F.coalesce(number_zero, F.lit(False)).alias("low_is_zero"))
    j = F.col("j")
    low, high = j["salaryLow"], j["salaryHigh"]
    high_int = F.expr("try_cast(j['salaryHigh'] AS INT)")
    disclosed = ~F.col("low_is_zero") & (
        F.coalesce(blank_to_null(low).isNotNull(), F.lit(False))
        & F.coalesce(blank_to_null(high).isNotNull(), F.lit(False))
        & F.coalesce(high_int > 0, F.lit(False))
    )
    kept = jobs.filter(F.map_contains_key(j, "jobName") & F.map_contains_key(j, "custName"))
    return kept.select(
        F.concat(F.lit(BOARD_A_ID_PREFIX), F.coalesce(
            blank_to_null(j["jobNo"]), blank_to_null(j["jobId"]), _own_id(j["jobName"], j["custName"], j["link"], j["description"]),
        )).alias("posting_id"),
        F.lit(BOARD_A_SOURCE).alias("source"),
        "fetched_at",
        j["jobName"].alias("role_raw"),
        F.struct(
            j["custName"].alias("name"),
            F.lit(None).cast("string").alias("headcount_band"),
            F.lit(None).cast("int").alias("headcount_est"),
            F.lit(None).cast("string").alias("industry"),
        ).alias("company"),
        F.coalesce(blank_to_null(j["jobAddrNoDesc"]), blank_to_null(j["jobAddress"])).alias("city"),
        F.when(disclosed, F.expr("try_cast(j['salaryLow'] AS INT)")).alias("salary_monthly_low"),
        F.when(disclosed, high_int).alias("salary_monthly_high"),
        F.lit(DEFAULT_CURRENCY).alias("salary_currency"),
        disclosed.alias("salary_disclosed"),
        _excerpt(j["description"]).alias("description_excerpt"),
        F.coalesce(j["description"], F.lit("")).alias("description"),
        F.concat(
            F.lit(BOARD_A_URL_PREFIX),
            F.coalesce(F.get_json_object(j["link"], "$.job"), F.lit("")),
        ).alias("url"),
    )


def map_board_b(pages: DataFrame, payload: str = "payload", fetched_at: str = "fetched_at") -> DataFrame:
    """Board B pages -> raw postings. Jobs without a name or company name key are dropped; ids may be any text."""
    jobs = pages.select(
        F.col(fetched_at).alias("fetched_at"),
        F.explode(F.from_json(F.col(payload), _BOARD_B_PAGE).getField("jobs")).alias("j"),
    )
    j, company = F.col("j"), F.col("company")
    jobs = jobs.withColumn("company", F.from_json(j["company"], "MAP<STRING, STRING>"))
    lo, hi = j["salary_min"].try_cast("double"), j["salary_max"].try_cast("double")
    disclosed = F.coalesce(lo, F.lit(0.0)) != 0
    disclosed = disclosed & (F.coalesce(hi, F.lit(0.0)) != 0)
    kept = jobs.filter(F.map_contains_key(j, "name") & company.isNotNull() & F.map_contains_key(company, "name"))
    tag_names = F.transform(F.from_json(j["tags"], "ARRAY<STRUCT<name: STRING>>"), lambda t: t["name"])
    tags = F.filter(tag_names, lambda n: n.isNotNull() & (n != ""))
    id_text = F.coalesce(j["id"], _own_id(j["name"], j["company"], j["path"], j["description"]))
    slug_text = F.coalesce(company["slug"], F.lit("None"))
    return kept.select(
        F.concat(F.lit(BOARD_B_ID_PREFIX), id_text).alias("posting_id"),
        F.lit(BOARD_B_SOURCE).alias("source"),
        "fetched_at",
        j["name"].alias("role_raw"),
        F.struct(
            company["name"].alias("name"),
            company["size"].alias("headcount_band"),
            F.lit(None).cast("int").alias("headcount_est"),
            company["industry"].alias("industry"),
        ).alias("company"),
        j["city"].alias("city"),
        F.coalesce(j["remote_friendly"].try_cast("boolean"), F.lit(False)).alias("is_remote"),
        F.when(disclosed, annual_to_monthly(lo)).alias("salary_monthly_low"),
        F.when(disclosed, annual_to_monthly(hi)).alias("salary_monthly_high"),
        F.lit(DEFAULT_CURRENCY).alias("salary_currency"),
        disclosed.alias("salary_disclosed"),
        _excerpt(j["description"]).alias("description_excerpt"),
        F.coalesce(j["description"], F.lit("")).alias("description"),
        F.coalesce(tags, F.array().cast("array<string>")).alias("skills_raw"),
        F.concat(
            F.lit("https://www.yourator.co/companies/"), slug_text, F.lit("/jobs/"), id_text
        ).alias("url"),
    )
