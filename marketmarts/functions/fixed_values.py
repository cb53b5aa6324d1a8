"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the behaviour we
match (rule order matters: the first matching pattern wins).  Nothing here is
logic; the column expressions that use these tables live next door.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: role title rules, in order (pattern on the lower-cased title,
# role_canonical, role_family).  First hit wins, else ("other", "other").
# --------------------------------------------------------------------------
ROLE_RULES: list[tuple[str, str, str]] = [
    (r"(senior|sr\.?|lead|staff|principal).{0,12}data\s+engineer", "senior_data_engineer", "data_engineering"),
    (r"data\s+engineer", "data_engineer", "data_engineering"),
    (r"analytics\s+engineer", "analytics_engineer", "data_engineering"),
    (r"mlops?\s+engineer|machine\s+learning\s+ops", "mlops_engineer", "ml_engineering"),
    (r"(machine\s+learning|ml)\s+engineer", "ml_engineer", "ml_engineering"),
    (r"\bai\s+engineer\b|generative\s+ai\s+engineer", "ai_engineer", "ai_engineering"),
    (r"data\s+scientist", "data_scientist", "data_science"),
    (r"data\s+analyst|business\s+intelligence\s+analyst", "data_analyst", "analytics"),
]
ROLE_FALLBACK = ("other", "other")

# --------------------------------------------------------------------------
# FIXED VALUES: seniority hints, in order (pattern on the lower-cased title,
# seniority).  When none hits, experience years decide:
# null -> mid, >= 7 principal, >= 4 senior, >= 2 mid, else junior.
# --------------------------------------------------------------------------
SENIORITY_RULES: list[tuple[str, str]] = [
    (r"\b(intern|實習)\b", "intern"),
    (r"\b(junior|jr\.?|associate|新鮮人|entry|graduate)\b", "junior"),
    (r"\b(staff|principal|architect|lead)\b", "principal"),
    (r"\b(senior|sr\.?|資深)\b", "senior"),
    (r"\b(manager|director|head\s+of)\b", "manager"),
]
SENIORITY_BY_YEARS: list[tuple[int, str]] = [(7, "principal"), (4, "senior"), (2, "mid")]
SENIORITY_YEARS_NULL = "mid"
SENIORITY_YEARS_BELOW = "junior"

# --------------------------------------------------------------------------
# FIXED VALUES: company name conforming.  Overrides are looked up on the
# trimmed lower-cased name; otherwise legal suffixes are removed anywhere in
# the name (case-insensitive) and " ,." is stripped from both ends.
# --------------------------------------------------------------------------
COMPANY_OVERRIDES: dict[str, str] = {
    "tsmc": "Taiwan Semiconductor Manufacturing",
    "台積電": "Taiwan Semiconductor Manufacturing",
}
COMPANY_LEGAL_SUFFIX = r"\b(co\.?,?\s*ltd\.?|ltd\.?|inc\.?|corp\.?|corporation|company)\b"
COMPANY_STRIP_CHARS = " ,."
COMPANY_UNKNOWN = "unknown"

# --------------------------------------------------------------------------
# FIXED VALUES: skill taxonomy, canonical skill -> surface variants
# (48 skills, 82 surfaces; surfaces are matched lower-case).
# --------------------------------------------------------------------------
SKILL_TAXONOMY: dict[str, list[str]] = {
    "python": ["python", "py3"],
    "sql": ["sql", "ansi sql", "postgresql", "mysql"],
    "scala": ["scala"],
    "java": ["java"],
    "go": [" go ", "golang"],
    "rust": ["rust"],
    "airflow": ["airflow", "apache airflow"],
    "dagster": ["dagster"],
    "prefect": ["prefect"],
    "dbt": ["dbt"],
    "spark": ["spark", "pyspark", "apache spark"],
    "kafka": ["kafka", "apache kafka", "confluent"],
    "flink": ["flink", "apache flink"],
    "kinesis": ["kinesis"],
    "snowflake": ["snowflake"],
    "bigquery": ["bigquery", "bq"],
    "redshift": ["redshift"],
    "databricks": ["databricks"],
    "elastic": ["elastic", "elasticsearch", "opensearch"],
    "trino": ["trino", "presto"],
    "iceberg": ["iceberg", "apache iceberg"],
    "delta_lake": ["delta lake", "deltalake"],
    "aws": ["aws", "amazon web services"],
    "gcp": ["gcp", "google cloud"],
    "azure": ["azure"],
    "kubernetes": ["kubernetes", "k8s"],
    "terraform": ["terraform"],
    "docker": ["docker"],
    "argo": ["argo workflows", "argo"],
    "pytorch": ["pytorch"],
    "tensorflow": ["tensorflow"],
    "scikit-learn": ["scikit-learn", "sklearn"],
    "mlflow": ["mlflow"],
    "llm": ["llm", "large language model"],
    "rag": ["rag", "retrieval augmented generation"],
    "langchain": ["langchain"],
    "vector_db": ["vector db", "vector database", "pinecone", "weaviate", "qdrant"],
    "feature_store": ["feature store", "feast"],
    "tableau": ["tableau"],
    "powerbi": ["powerbi", "power bi"],
    "looker": ["looker"],
    "metabase": ["metabase"],
    "superset": ["superset"],
    "english": ["english"],
    "data_modeling": ["data modeling", "data modelling"],
    "etl": ["etl"],
    "data_warehouse": ["data warehouse", "dw"],
    "experimentation": ["experimentation", "a/b testing", "ab testing"],
}

# --------------------------------------------------------------------------
# FIXED VALUES: marts.
# --------------------------------------------------------------------------
MIN_DISCLOSED_PER_CELL = 5
SALARY_QUANTILES = (0.25, 0.50, 0.75, 0.90)
DATA_AI_FAMILIES = ("data_engineering", "ml_engineering", "ai_engineering", "data_science", "analytics")
DEFAULT_CURRENCY = "TWD"
DEFAULT_SOURCE = "unknown"
UNKNOWN_DIMENSION = "unknown"
TOP_SKILLS_PER_FAMILY = 8

# --------------------------------------------------------------------------
# FIXED VALUES: board payload mapping.
# --------------------------------------------------------------------------
BOARD_A_SOURCE = "104"
BOARD_A_ID_PREFIX = "104-"
BOARD_A_URL_PREFIX = "https://www.104.com.tw"
BOARD_B_SOURCE = "yourator"
BOARD_B_ID_PREFIX = "yourator-"
BOARD_B_URL_FORMAT = "https://www.yourator.co/companies/{slug}/jobs/{id}"
DESCRIPTION_MAX_CHARS = 600
ANNUAL_MONTHLY_THRESHOLD = 25_000  # above: already monthly
ANNUAL_UNIT = 10_000  # annual figures are in units of 10k TWD
MONTHS_PER_YEAR = 12

# --------------------------------------------------------------------------
# FIXED VALUES: display labels (key shown as is when missing).
# --------------------------------------------------------------------------
ROLE_LABELS: dict[str, str] = {
    "data_engineer": "Data Engineer",
    "senior_data_engineer": "Senior Data Engineer",
    "ai_engineer": "AI Engineer",
    "ml_engineer": "Machine Learning Engineer",
    "data_analyst": "Data Analyst",
    "analytics_engineer": "Analytics Engineer",
    "data_scientist": "Data Scientist",
    "mlops_engineer": "MLOps Engineer",
    "other": "Other / Uncategorized",
}
FAMILY_LABELS: dict[str, str] = {
    "data_engineering": "Data Engineering",
    "ml_engineering": "ML Engineering",
    "ai_engineering": "AI Engineering",
    "data_science": "Data Science",
    "analytics": "Analytics",
    "other": "Other",
}

# --------------------------------------------------------------------------
# FIXED VALUES: stream.
# --------------------------------------------------------------------------
STREAM_WINDOW = "1 hour"
STREAM_WATERMARK = "2 hours"

# --------------------------------------------------------------------------
# FIXED VALUES: read API bounds (inclusive) and defaults.
# --------------------------------------------------------------------------
READ_SALARY_LIMIT = 500
READ_SKILLS_TOP_N = (25, 1, 100)
READ_COMPANIES_LIMIT = (50, 1, 200)
READ_POSTINGS_LIMIT = (50, 1, 500)
SEARCH_LIMIT = 200
SKILLS_TOP_N_SLIDER = (20, 5, 40)
COMPANY_TOP = 30
