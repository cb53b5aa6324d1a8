"""Explicit schemas: raw posting lines, board payloads, stream records, tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, B = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType()
TS = T.TimestampNTZType()  # naive UTC instants, as stamped by the boards


def _f(name, typ, nullable=True):
    return T.StructField(name, typ, nullable)


COMPANY = T.StructType([_f("name", S), _f("headcount_band", S), _f("headcount_est", I), _f("industry", S)])

# One raw posting as landed in JSONL (fetched_at still text).
RAW_POSTING = T.StructType(
    [
        _f("posting_id", S),
        _f("source", S),
        _f("fetched_at", S),
        _f("role_raw", S),
        _f("role_key", S),
        _f("company", COMPANY),
        _f("city", S),
        _f("is_remote", B),
        _f("experience_years_min", I),
        _f("experience_years_max", I),
        _f("education_min", S),
        _f("salary_monthly_low", I),
        _f("salary_monthly_high", I),
        _f("salary_currency", S),
        _f("salary_disclosed", B),
        _f("skills_raw", T.ArrayType(S)),
        _f("description_excerpt", S),
        _f("description", S),  # whole text, where the source gives it
        _f("url", S),
    ]
)

# Same shape after parsing fetched_at; the input of staging.  A time that
# cannot be read is NULL and its text is kept beside it.
POSTING_FEED = T.StructType(
    [f if f.name != "fetched_at" else _f("fetched_at", TS) for f in RAW_POSTING.fields] + [_f("fetched_at_text", S)]
)

# Normalised posting event on the stream.
STREAM_RECORD = T.StructType(
    [
        _f("posting_id", S, False),
        _f("source", S, False),
        _f("fetched_at", S, False),
        _f("role_canonical", S, False),
        _f("role_family", S, False),
        _f("seniority", S),
        _f("city", S),
        _f("is_remote", B),
        _f("salary_monthly_low", I),
        _f("salary_monthly_high", I),
        _f("salary_disclosed", B),
    ]
)

# Warehouse tables: column -> (type, required).  Used by the sinks to cast
# on write and by the NOT NULL / key checks.
TABLE_RULES: dict[str, dict] = {
    "raw_postings": {
        "columns": {
            "raw_id": (L, True),
            "source": (S, True),
            "source_post_id": (S, True),
            "fetched_at": (TS, False),
            "fetched_at_text": (S, False),
            "payload": (S, True),
        },
        "key": ["source", "source_post_id", "fetched_at", "fetched_at_text"],
    },
    "companies": {
        "columns": {
            "company_id": (L, True),
            "name_canonical": (S, True),
            "name_raw": (S, True),
            "headcount_band": (S, False),
            "headcount_est": (I, False),
            "industry": (S, False),
            "first_seen_at": (TS, False),
            "last_seen_at": (TS, False),
        },
        "key": ["company_id"],
        "unique": [["name_canonical"]],
    },
    "postings": {
        "columns": {
            "posting_id": (S, True),
            "source": (S, True),
            "fetched_at": (TS, False),
            "role_raw": (S, True),
            "role_canonical": (S, True),
            "role_family": (S, True),
            "seniority": (S, True),
            "company_id": (L, False),
            "city": (S, False),
            "is_remote": (B, True),
            "experience_years_min": (I, False),
            "experience_years_max": (I, False),
            "education_min": (S, False),
            "salary_monthly_low": (I, False),
            "salary_monthly_high": (I, False),
            "salary_currency": (S, True),
            "salary_disclosed": (B, True),
            "skills_canonical": (T.ArrayType(S), False),
            "description_excerpt": (S, False),
        },
        "key": ["posting_id"],
    },
    "salary_by_role": {
        "columns": {
            "snapshot_date": (T.DateType(), True),
            "role_canonical": (S, True),
            "seniority": (S, True),
            "headcount_band": (S, True),
            "city": (S, True),
            "n_postings": (I, True),
            "n_disclosed": (I, True),
            "p25_monthly": (I, False),
            "p50_monthly": (I, False),
            "p75_monthly": (I, False),
            "p90_monthly": (I, False),
        },
        "key": ["snapshot_date", "role_canonical", "seniority", "headcount_band", "city"],
    },
    "skill_demand": {
        "columns": {
            "snapshot_date": (T.DateType(), True),
            "role_family": (S, True),
            "skill": (S, True),
            "n_postings": (I, True),
            "share_of_postings": (T.DecimalType(5, 4), True),
        },
        "key": ["snapshot_date", "role_family", "skill"],
    },
    "company_activity": {
        "columns": {
            "snapshot_date": (T.DateType(), True),
            "company_id": (L, True),
            "n_postings": (I, True),
            "n_data_ai": (I, True),
            "median_monthly": (I, False),
        },
        "key": ["snapshot_date", "company_id"],
    },
}

# Times that may be stored unread (NULL, their text beside them); the NOT NULL check still counts them.
CHECKED_TIMES = {
    "raw_postings": ["fetched_at"],
    "companies": ["first_seen_at", "last_seen_at"],
    "postings": ["fetched_at"],
}

FOREIGN_KEYS = [
    ("postings", "company_id", "companies", "company_id"),
    ("company_activity", "company_id", "companies", "company_id"),
]


def checked_columns(name: str) -> list[str]:
    """Columns of a table whose NULLs the check counts: the required ones and the times."""
    times = CHECKED_TIMES.get(name, [])
    return [c for c, (_, required) in TABLE_RULES[name]["columns"].items() if required or c in times]


def table_schema(name: str) -> T.StructType:
    cols = TABLE_RULES[name]["columns"]
    return T.StructType([T.StructField(c, t, not req) for c, (t, req) in cols.items()])
