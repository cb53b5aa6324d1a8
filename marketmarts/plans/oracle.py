"""Independent DuckDB SQL for every driver query (the correctness oracle).

Built as common table expressions over the driver's views; the rule
tables (titles, taxonomy, suffixes) are shared with the Spark code because
they are the specification, but every step runs in a different engine with
its own regex, window and aggregate implementations.
"""

from __future__ import annotations

from ..functions.fixed_values import (
    COMPANY_LEGAL_SUFFIX,
    COMPANY_OVERRIDES,
    DATA_AI_FAMILIES,
    FAMILY_LABELS,
    MIN_DISCLOSED_PER_CELL,
    ROLE_LABELS,
    ROLE_RULES,
    SALARY_QUANTILES,
    SENIORITY_RULES,
    SKILL_TAXONOMY,
)
from ..functions.text import word_haystack_py

SNAPSHOT = "2026-01-01"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dbl(x: float) -> str:
    return f"CAST({q(repr(float(x)))} AS DOUBLE)"


# Posting feed over orders JOIN customer (same rules as sources.feed).
FEED = r"""
SELECT o.o_orderkey AS seq,
  CASE WHEN o.o_orderkey % 3 = 0 THEN '104' WHEN o.o_orderkey % 3 = 1 THEN 'yourator' ELSE 'sample' END AS source,
  CASE WHEN o.o_orderkey % 101 = 0 THEN NULL
       ELSE 'P-' || CAST(CASE WHEN o.o_orderkey % 10 = 9 THEN o.o_orderkey - 3 ELSE o.o_orderkey END AS VARCHAR) END AS posting_id,
  CASE WHEN o.o_orderkey % 103 = 0 THEN NULL ELSE o.o_orderdate END AS fetched_at,
  CASE o.o_orderkey % 14
    WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'Senior Data Engineer' WHEN 2 THEN 'Lead Cloud Data Engineer'
    WHEN 3 THEN 'AI Engineer' WHEN 4 THEN 'Machine Learning Engineer' WHEN 5 THEN 'Sr. ML Engineer'
    WHEN 6 THEN 'Data Analyst' WHEN 7 THEN 'Business Intelligence Analyst' WHEN 8 THEN 'Analytics Engineer'
    WHEN 9 THEN 'Data Scientist' WHEN 10 THEN 'MLOps Engineer' WHEN 11 THEN 'Junior Data Scientist'
    WHEN 12 THEN 'HTML Engineer' ELSE 'Product Manager' END AS role_raw,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o.o_orderkey % 9 AS INT) END AS experience_years_min,
  'Firm ' || CAST(o.o_custkey AS VARCHAR) ||
    CASE o.o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN ' Co., Ltd.' WHEN 2 THEN ' Inc.' ELSE ' Corp' END AS company_name,
  CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE lower(c.c_mktsegment) END AS headcount_band,
  CASE c.c_nationkey % 4 WHEN 0 THEN 'Taipei' WHEN 1 THEN 'Hsinchu' WHEN 2 THEN 'Remote' ELSE NULL END AS city,
  o.o_orderstatus <> 'P' AS salary_disclosed,
  CASE WHEN o.o_orderstatus <> 'P' THEN CAST(floor(40000 + o.o_totalprice / 5) AS INT) END AS salary_monthly_low,
  CASE WHEN o.o_orderstatus <> 'P' AND o.o_orderkey % 97 <> 0
       THEN CAST(floor(40000 + o.o_totalprice / 5) AS INT) + CAST(o.o_orderkey % 7 AS INT) * 3001 END AS salary_monthly_high,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'Python|SQL|Airflow' WHEN 1 THEN 'pyspark|Kafka|k8s'
    WHEN 2 THEN 'scikit-learn| dbt |excel' WHEN 3 THEN 'go|golang|vector db' WHEN 4 THEN ''
    ELSE 'A/B testing|feast|PyTorch' END AS skills_delim,
  CASE o.o_orderkey % 5 WHEN 0 THEN 'Scalable storage on trusted hardware.'
    WHEN 1 THEN 'Heavy javascript stack; Go services, RAG pipelines'
    WHEN 2 THEN 'Build ETL into Snowflake / BigQuery with Terraform'
    WHEN 3 THEN 'scikit-learn and a/b testing' ELSE NULL END AS description_excerpt
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
"""


def role_case(col: str, field: str) -> str:
    idx = 1 if field == "role_canonical" else 2
    parts = [f"WHEN regexp_matches(lower({col}), {q(r[0])}) THEN {q(r[idx])}" for r in ROLE_RULES]
    return "CASE " + " ".join(parts) + " ELSE 'other' END"


def seniority_case(title: str, years: str) -> str:
    parts = [f"WHEN regexp_matches(lower({title}), {q(p)}) THEN {q(level)}" for p, level in SENIORITY_RULES]
    parts += [
        f"WHEN {years} IS NULL THEN 'mid'",
        f"WHEN {years} >= 7 THEN 'principal'",
        f"WHEN {years} >= 4 THEN 'senior'",
        f"WHEN {years} >= 2 THEN 'mid'",
    ]
    return "CASE " + " ".join(parts) + " ELSE 'junior' END"


def company_case(col: str) -> str:
    overrides = " ".join(f"WHEN lower(trim({col})) = {q(k)} THEN {q(v)}" for k, v in COMPANY_OVERRIDES.items())
    cleaned = f"trim(regexp_replace({col}, {q('(?i)' + COMPANY_LEGAL_SUFFIX)}, '', 'g'), ' ,.')"
    return (
        f"CASE WHEN {col} IS NULL OR {col} = '' THEN 'unknown' {overrides} "
        f"ELSE coalesce(nullif({cleaned}, ''), trim({col})) END"
    )


def taxonomy_values(match: str = "substring") -> str:
    rows = []
    for canonical, surfaces in SKILL_TAXONOMY.items():
        for s in surfaces:
            pat = s.lower() if match == "substring" else word_haystack_py(s)
            rows.append(f"({q(canonical)}, {q(s.lower())}, {q(pat)})")
    return "(VALUES " + ", ".join(rows) + ") AS tax(skill, surface, pattern)"


# Java's (?U)\W: everything but letters, marks, decimal digits, letter numbers,
# connector punctuation and the two join controls.
NON_WORD = r"[^\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{200C}\x{200D}]+"


def haystack(text_sql: str) -> str:
    return f"regexp_replace(' ' || lower(coalesce({text_sql}, '')) || ' ', {q(NON_WORD)}, ' ', 'g')"


def staging_ctes(match: str = "substring") -> str:
    """fx, valid, last_row, hints, companies, postings (+ skills) as CTEs."""
    return f"""
fx AS ({FEED}),
valid AS (SELECT * FROM fx WHERE posting_id IS NOT NULL AND posting_id <> '' AND fetched_at IS NOT NULL),
named AS (
  SELECT *, coalesce(nullif(company_name, ''), 'unknown') AS name_raw,
         {company_case("coalesce(nullif(company_name, ''), 'unknown')")} AS name_canonical
  FROM valid),
companies AS (
  SELECT f.name_canonical, f.name_raw, f.headcount_band, CAST(NULL AS INT) AS headcount_est,
         CAST(NULL AS VARCHAR) AS industry, f.fetched_at AS first_seen_at, l.fetched_at AS last_seen_at
  FROM (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY name_canonical ORDER BY seq) = 1) f
  JOIN (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY name_canonical ORDER BY seq DESC) = 1) l
    USING (name_canonical)),
last_row AS (SELECT * FROM named QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY seq DESC) = 1),
hints AS (
  SELECT source, posting_id, skills_delim AS hints_delim FROM valid
  QUALIFY row_number() OVER (PARTITION BY source, posting_id ORDER BY fetched_at DESC, seq ASC) = 1),
staged AS (
  SELECT l.*, h.hints_delim,
         {role_case("l.role_raw", "role_canonical")} AS role_canonical,
         {role_case("l.role_raw", "role_family")} AS role_family,
         {seniority_case("l.role_raw", "l.experience_years_min")} AS seniority,
         {haystack("coalesce(l.role_raw, '') || ' ' || coalesce(l.description_excerpt, '')")} AS hay
  FROM last_row l LEFT JOIN hints h ON h.source = l.source AND h.posting_id = l.posting_id),
skill_hits AS (
  SELECT s.posting_id, tax.skill FROM staged s JOIN {taxonomy_values(match)} ON contains(s.hay, tax.pattern)
  UNION
  SELECT s.posting_id, tax.skill
  FROM (SELECT posting_id, lower(trim(unnest(string_split(hints_delim, '|')))) AS hint FROM staged) s
  JOIN {taxonomy_values(match)} ON tax.surface = s.hint),
skill_lists AS (
  SELECT posting_id, string_agg(skill, '|' ORDER BY skill) AS skills FROM (SELECT DISTINCT * FROM skill_hits)
  GROUP BY posting_id),
postings AS (
  SELECT s.posting_id, s.source, s.fetched_at, s.role_raw, s.role_canonical, s.role_family, s.seniority,
         s.name_canonical AS company_canonical, s.city, false AS is_remote, s.experience_years_min,
         CAST(NULL AS INT) AS experience_years_max, CAST(NULL AS VARCHAR) AS education_min,
         s.salary_monthly_low, s.salary_monthly_high, 'TWD' AS salary_currency, s.salary_disclosed,
         coalesce(k.skills, '') AS skills, s.description_excerpt
  FROM staged s LEFT JOIN skill_lists k USING (posting_id)),
enriched AS (
  SELECT p.*, c.headcount_band, c.industry FROM postings p LEFT JOIN companies c ON c.name_canonical = p.company_canonical)
"""


def percentile_ctes(name: str, source: str, keys: list[str], value: str, quantiles) -> str:
    """CTE ``name`` with keys + n_values + q_<i> per group (numpy 'linear' steps)."""
    k = ", ".join(keys)
    part = f"PARTITION BY {k}" if keys else ""
    sel = []
    for i, qq in enumerate(quantiles):
        idx = f"((CAST(n AS DOUBLE) - CAST(1.0 AS DOUBLE)) * {dbl(qq)})"
        sel.append(
            f"max(CASE WHEN r = floor({idx}) THEN v END) AS lo{i}, "
            f"max(CASE WHEN r = ceil({idx}) THEN v END) AS hi{i}, "
            f"max({idx} - floor({idx})) AS g{i}"
        )
    outs = []
    for i in range(len(quantiles)):
        outs.append(
            f"CASE WHEN g{i} >= 0.5 THEN hi{i} - (hi{i} - lo{i}) * (CAST(1.0 AS DOUBLE) - g{i}) "
            f"ELSE lo{i} + (hi{i} - lo{i}) * g{i} END AS q{i}"
        )
    grp = f"GROUP BY {k}" if keys else ""
    key_sel = (k + ", ") if keys else ""
    return f"""
{name}_r AS (
  SELECT {key_sel}CAST({value} AS DOUBLE) AS v, row_number() OVER ({part} ORDER BY {value}) - 1 AS r,
         count(*) OVER ({part}) AS n
  FROM {source} WHERE {value} IS NOT NULL),
{name}_g AS (SELECT {key_sel}max(n) AS n_values, {", ".join(sel)} FROM {name}_r {grp}),
{name} AS (SELECT {key_sel}n_values, {", ".join(outs)} FROM {name}_g)
"""


def _salary_cells_ctes() -> str:
    keys = ["role_canonical", "seniority", "headcount_band", "city"]
    return f"""
cell_base AS (
  SELECT role_canonical, seniority, coalesce(headcount_band, 'unknown') AS headcount_band,
         coalesce(city, 'unknown') AS city,
         CASE WHEN salary_disclosed THEN (CAST(salary_monthly_low AS DOUBLE) + CAST(salary_monthly_high AS DOUBLE)) / 2 END AS mid
  FROM enriched),
cell_counts AS (
  SELECT role_canonical, seniority, headcount_band, city, count(*) AS n_postings, count(mid) AS n_disclosed
  FROM cell_base GROUP BY ALL),
{percentile_ctes("cell_pct", "cell_base", keys, "mid", SALARY_QUANTILES)},
salary_cells AS (
  SELECT DATE '{SNAPSHOT}' AS snapshot_date, c.role_canonical, c.seniority, c.headcount_band, c.city,
         CAST(c.n_postings AS INT) AS n_postings, CAST(c.n_disclosed AS INT) AS n_disclosed,
         {", ".join(f"CASE WHEN c.n_disclosed >= {MIN_DISCLOSED_PER_CELL} THEN CAST(trunc(p.q{i}) AS INT) END AS {n}" for i, n in enumerate(["p25_monthly", "p50_monthly", "p75_monthly", "p90_monthly"]))}
  FROM cell_counts c LEFT JOIN cell_pct p USING (role_canonical, seniority, headcount_band, city))
"""


def with_staging(body: str, *extra_ctes: str, match: str = "substring") -> str:
    ctes = [staging_ctes(match)] + [c for c in extra_ctes if c]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _in(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def _label_case(mapping: dict[str, str], col: str) -> str:
    parts = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"coalesce(CASE {col} {parts} END, {col})"


SKILL_DEMAND = f"""
fam_tot AS (SELECT role_family, count(*) AS n_total FROM postings GROUP BY role_family),
fam_skill AS (
  SELECT s.role_family, h.skill, count(*) AS n
  FROM (SELECT DISTINCT * FROM skill_hits) h JOIN staged s USING (posting_id) GROUP BY s.role_family, h.skill),
skill_demand AS (
  SELECT DATE '{SNAPSHOT}' AS snapshot_date, f.role_family, f.skill, CAST(f.n AS INT) AS n_postings,
         round_even(CAST(f.n AS DOUBLE) / CAST(t.n_total AS DOUBLE) * 10000, 0) / 10000 AS share_of_postings
  FROM fam_skill f JOIN fam_tot t USING (role_family))
"""

ACTIVITY = f"""
act_base AS (
  SELECT company_canonical,
         CASE WHEN role_family IN {_in(DATA_AI_FAMILIES)} THEN 1 ELSE 0 END AS is_data_ai,
         (CAST(salary_monthly_low AS DOUBLE) + CAST(salary_monthly_high AS DOUBLE)) / 2 AS mid
  FROM postings),
{percentile_ctes("act_med", "act_base", ["company_canonical"], "mid", [0.5])},
activity AS (
  SELECT DATE '{SNAPSHOT}' AS snapshot_date, a.company_canonical AS name_canonical,
         CAST(count(*) AS INT) AS n_postings, CAST(sum(a.is_data_ai) AS INT) AS n_data_ai,
         CAST(round_even(max(m.q0), 0) AS INT) AS median_monthly
  FROM act_base a LEFT JOIN act_med m USING (company_canonical) GROUP BY a.company_canonical),
activity_named AS (
  SELECT a.snapshot_date, a.name_canonical, c.headcount_band, c.industry, a.n_postings, a.n_data_ai, a.median_monthly
  FROM activity a LEFT JOIN companies c USING (name_canonical))
"""

RAW = """
raw AS (
  SELECT source, posting_id AS source_post_id, fetched_at, CAST(NULL AS VARCHAR) AS fetched_at_text, min(seq) AS raw_id, count(*) AS n_fetches,
         arg_min(skills_delim, seq) AS hints
  FROM valid GROUP BY source, posting_id, fetched_at)
"""


def _week(col: str) -> str:
    return f"CAST(date_trunc('week', {col}) + INTERVAL 6 DAY AS DATE)"


def _pct_outputs(quantiles_names) -> str:
    return ", ".join(f"p.q{i} AS {n}" for i, n in enumerate(quantiles_names))


# Checked columns per table (required ones and times), as (table, column, oracle CTE, oracle expression).
def _not_null_rows():
    from ..schemas import TABLE_RULES, checked_columns
    cte = {"raw_postings": "raw", "companies": "companies", "postings": "postings",
           "salary_by_role": "salary_cells", "skill_demand": "skill_demand", "company_activity": "activity"}
    alias = {
        ("raw_postings", "payload"): "hints",
        ("companies", "company_id"): "name_canonical",
        ("postings", "company_id"): "company_canonical",
        ("company_activity", "company_id"): "name_canonical",
    }
    rows = []
    for t in TABLE_RULES:
        for c in checked_columns(t):
            rows.append((t, c, cte[t], alias.get((t, c), c)))
    return rows


def _keys_rows():
    cte = {"raw_postings": "raw", "companies": "companies", "postings": "postings",
           "salary_by_role": "salary_cells", "skill_demand": "skill_demand", "company_activity": "activity"}
    from ..schemas import TABLE_RULES
    rename = {("companies", "company_id"): "name_canonical", ("company_activity", "company_id"): "name_canonical"}
    rows = []
    for t, rule in TABLE_RULES.items():
        for key in [rule["key"]] + rule.get("unique", []):
            cols = [rename.get((t, k), k) for k in key]
            rows.append((t, ",".join(key), cte[t], cols))
    return rows


def oracle_sql() -> dict[str, str]:
    o: dict[str, str] = {}
    cells = _salary_cells_ctes()
    o["required_fields"] = with_staging("SELECT seq, posting_id, source, fetched_at FROM valid")
    o["postings_staged"] = with_staging("SELECT * FROM postings")
    o["companies_dim"] = with_staging(
        "SELECT name_canonical, name_raw, headcount_band, headcount_est, industry, first_seen_at, last_seen_at FROM companies"
    )
    o["raw_dedup"] = with_staging("SELECT source, source_post_id, fetched_at, raw_id, n_fetches, hints FROM raw", RAW)
    # two batches merged equal one run over both
    o["raw_merge"], o["companies_merge"], o["postings_merge"] = o["raw_dedup"], o["companies_dim"], o["postings_staged"]
    o["latest_hints"] = with_staging(
        "SELECT l.posting_id, l.source, h.hints_delim AS hints FROM last_row l LEFT JOIN hints h USING (source, posting_id)"
    )
    o["midpoint"] = (
        f"WITH fx AS ({FEED}) SELECT seq, (CAST(salary_monthly_low AS DOUBLE) + CAST(salary_monthly_high AS DOUBLE)) / 2 AS midpoint FROM fx"
    )
    o["role_classify"] = (
        f"WITH fx AS ({FEED}) SELECT seq, role_raw, {role_case('role_raw', 'role_canonical')} AS role_canonical, "
        f"{role_case('role_raw', 'role_family')} AS role_family FROM fx"
    )
    o["seniority_classify"] = (
        f"WITH fx AS ({FEED}) SELECT seq, role_raw, experience_years_min, "
        f"{seniority_case('role_raw', 'experience_years_min')} AS seniority FROM fx"
    )
    o["company_canonical"] = (
        f"WITH fx AS ({FEED}) SELECT seq, company_name, {company_case('company_name')} AS name_canonical FROM fx"
    )
    o["classify_names"] = "WITH n AS (SELECT 'customer' AS table_name, c_custkey AS key, c_name AS name FROM customer " \
        "UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier UNION ALL SELECT 'part', p_partkey, p_name FROM part) " \
        f"""SELECT table_name, key, {role_case("name", "role_canonical")} AS role_canonical, {role_case("name", "role_family")} AS role_family,
  {seniority_case("name", "CAST(NULL AS INT)")} AS seniority, {company_case("name")} AS name_canonical FROM n"""
    o["classify_turns"] = f"""WITH d AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {haystack("text")} AS hay FROM conversations)
SELECT conv_id, turn, role, {role_case("text", "role_canonical")} AS role_canonical,
  {seniority_case("text", "CAST(NULL AS INT)")} AS seniority,
  coalesce((SELECT string_agg(DISTINCT skill, '|' ORDER BY skill) FROM {taxonomy_values()} WHERE contains(d.hay, tax.pattern)), '') AS skills FROM d"""
    o["skills_from_hints"] = f"""WITH fx AS ({FEED}),
h AS (SELECT DISTINCT s.seq, tax.skill
      FROM (SELECT seq, lower(trim(unnest(string_split(skills_delim, '|')))) AS hint FROM fx) s
      JOIN {taxonomy_values()} ON tax.surface = s.hint),
agg AS (SELECT seq, string_agg(skill, '|' ORDER BY skill) AS skills FROM h GROUP BY seq)
SELECT f.seq, coalesce(a.skills, '') AS skills FROM fx f LEFT JOIN agg a USING (seq)"""
    o["skills_from_text"] = f"""WITH fx AS ({FEED}),
hay AS (SELECT seq, {haystack("coalesce(role_raw, '') || ' ' || coalesce(description_excerpt, '')")} AS hay FROM fx),
h AS (SELECT DISTINCT hay.seq, tax.skill FROM hay JOIN {taxonomy_values()} ON contains(hay.hay, tax.pattern)),
agg AS (SELECT seq, string_agg(skill, '|' ORDER BY skill) AS skills FROM h GROUP BY seq)
SELECT f.seq, coalesce(a.skills, '') AS skills FROM fx f LEFT JOIN agg a USING (seq)"""
    o["skills_extract"] = with_staging("SELECT posting_id, skills FROM postings")
    o["skills_extract_token"] = with_staging("SELECT posting_id, skills FROM postings", match="token")
    o["skills_theta_join"] = f"""WITH d AS (SELECT doc_id, {haystack("text")} AS hay FROM documents)
SELECT d.doc_id, tax.skill, tax.surface FROM d JOIN {taxonomy_values()} ON contains(d.hay, tax.pattern)"""
    o["skills_join"] = o["skills_theta_join"]
    o["salary_cells_approx"] = with_staging(
        f"""SELECT DATE '{SNAPSHOT}' AS snapshot_date, role_canonical, seniority, headcount_band, city,
  CAST(max(n_postings) AS INT) AS n_postings, CAST(max(n_disclosed) AS INT) AS n_disclosed,
  {", ".join(f"max(CASE WHEN n_disclosed >= {MIN_DISCLOSED_PER_CELL} AND r = greatest(1, ceil({dbl(x)} * n)) THEN mid END) AS {name}"
             for x, name in zip(SALARY_QUANTILES, ["p25_monthly", "p50_monthly", "p75_monthly", "p90_monthly"]))}
FROM (SELECT *, count(*) OVER c AS n_postings, count_if(salary_disclosed) OVER c AS n_disclosed, count(mid) OVER c AS n,
        row_number() OVER (PARTITION BY role_canonical, seniority, headcount_band, city ORDER BY mid NULLS LAST) AS r
      FROM (SELECT *, CASE WHEN salary_disclosed THEN (CAST(salary_monthly_low AS DOUBLE) + salary_monthly_high) / 2 END AS mid FROM enriched)
      WINDOW c AS (PARTITION BY role_canonical, seniority, headcount_band, city))
GROUP BY role_canonical, seniority, headcount_band, city""")
    o["postings_with_company"] = with_staging(
        "SELECT posting_id, company_canonical, headcount_band, industry, role_canonical, fetched_at FROM enriched"
    )
    o["salary_cells_exact"] = with_staging("SELECT * FROM salary_cells", cells)
    keys = ["role_canonical", "seniority", "headcount_band", "city"]
    on = " AND ".join(f"c.{k} IS NOT DISTINCT FROM d.{k}" for k in keys)
    o["cells_null_safe_join"] = with_staging(
        f"SELECT c.*, coalesce(d.n_disclosed, 0) AS n_disclosed FROM cnt c LEFT JOIN dis d ON {on}",
        f"""cnt AS (SELECT {", ".join(keys)}, count(*) AS n_postings FROM enriched GROUP BY {", ".join(keys)}),
dis AS (SELECT {", ".join(keys)}, count(*) AS n_disclosed FROM enriched
        WHERE salary_disclosed AND salary_monthly_low IS NOT NULL AND salary_monthly_high IS NOT NULL
        GROUP BY {", ".join(keys)})""",
    )
    o["skill_demand"] = with_staging("SELECT * FROM skill_demand", SKILL_DEMAND)
    o["company_activity"] = with_staging(
        "SELECT snapshot_date, name_canonical, n_postings, n_data_ai, median_monthly FROM activity", ACTIVITY
    )
    o["weekly_volume"] = with_staging(
        f"SELECT {_week('fetched_at')} AS week_ending, role_family, count(*) AS n FROM postings "
        f"WHERE fetched_at IS NOT NULL GROUP BY ALL"
    )
    fam_cols = ", ".join(
        f"CAST(sum(CASE WHEN role_family = {q(f)} THEN n ELSE 0 END) AS BIGINT) AS {f}" for f in FAMILY_LABELS
    )
    fam_sum = " + ".join(f"sum(CASE WHEN role_family = {q(f)} THEN n ELSE 0 END)" for f in FAMILY_LABELS)
    o["weekly_pivot"] = with_staging(
        f"SELECT week_ending, {fam_cols}, CAST(sum(n) - ({fam_sum}) AS BIGINT) AS unlisted FROM wk GROUP BY week_ending",
        f"wk AS (SELECT {_week('fetched_at')} AS week_ending, role_family, count(*) AS n FROM postings "
        f"WHERE fetched_at IS NOT NULL GROUP BY ALL)",
    )
    o["disclosure_rate"] = with_staging(
        "SELECT role_family, avg(CAST(salary_disclosed AS INT)) AS disclosed_share, count(*) AS n FROM postings GROUP BY role_family"
    )
    o["top_skills_family"] = with_staging(
        "SELECT role_family, skill, n, CAST(rank AS INT) AS rank FROM ("
        "SELECT role_family, skill, n, row_number() OVER (PARTITION BY role_family ORDER BY n DESC, skill) AS rank "
        "FROM fam_skill) WHERE rank <= 8",
        SKILL_DEMAND,
    )
    o["salary_kpis"] = with_staging(
        """SELECT t.role_canonical, t.total_postings, t.total_disclosed,
  CASE WHEN t.total_postings > 0 THEN CAST(t.total_disclosed AS DOUBLE) / CAST(t.total_postings AS DOUBLE) ELSE 0.0 END AS disclosure_rate,
  CAST(trunc(m50.q0) AS INT) AS median_p50, CAST(trunc(m75.q0) AS INT) AS median_p75
FROM (SELECT role_canonical, CAST(sum(n_postings) AS BIGINT) AS total_postings,
             CAST(sum(n_disclosed) AS BIGINT) AS total_disclosed FROM salary_cells GROUP BY role_canonical) t
LEFT JOIN k50 m50 USING (role_canonical) LEFT JOIN k75 m75 USING (role_canonical)""",
        cells,
        percentile_ctes("k50", "salary_cells", ["role_canonical"], "p50_monthly", [0.5]),
        percentile_ctes("k75", "salary_cells", ["role_canonical"], "p75_monthly", [0.5]),
    )
    bk = ["role_canonical", "headcount_band", "seniority"]
    o["salary_box"] = with_staging(
        f"""SELECT {", ".join("b." + k for k in bk)}, b.n_values AS n_cells, e.min_p50, b.q0 AS q1_p50,
  b.q1 AS median_p50, b.q2 AS q3_p50, e.max_p50
FROM box b JOIN (SELECT {", ".join(bk)}, min(p50_monthly) AS min_p50, max(p50_monthly) AS max_p50
                 FROM salary_cells WHERE p50_monthly IS NOT NULL GROUP BY ALL) e USING ({", ".join(bk)})""",
        cells,
        percentile_ctes("box", "salary_cells", bk, "p50_monthly", [0.25, 0.5, 0.75]),
    )
    o["filter_values"] = with_staging(
        """SELECT DISTINCT 'role_canonical' AS dimension, role_canonical AS value FROM salary_cells
UNION SELECT DISTINCT 'seniority', seniority FROM salary_cells
UNION SELECT DISTINCT 'headcount_band', headcount_band FROM salary_cells
UNION SELECT DISTINCT 'role_family', role_family FROM skill_demand""",
        cells,
        SKILL_DEMAND,
    )
    o["labels_lookup"] = with_staging(
        f"SELECT role_canonical, {_label_case(ROLE_LABELS, 'role_canonical')} AS role_label, role_family, "
        f"{_label_case(FAMILY_LABELS, 'role_family')} AS family_label, count(*) AS n_postings "
        f"FROM postings GROUP BY role_canonical, role_family"
    )
    o["read_salary"] = with_staging(
        "SELECT * FROM salary_cells WHERE role_canonical = 'data_engineer' AND city = 'Taipei' "
        "ORDER BY snapshot_date DESC, seniority, headcount_band, city LIMIT 500",
        cells,
    )
    o["salary_filtered"] = with_staging(
        "SELECT * FROM salary_cells WHERE role_canonical = 'senior_data_engineer' "
        "AND seniority IN ('senior', 'principal', 'mid') AND headcount_band IN ('machinery', 'building', 'unknown')",
        cells,
    )
    o["read_skills"] = with_staging(
        "SELECT * FROM skill_demand ORDER BY n_postings DESC, role_family, skill LIMIT 25", SKILL_DEMAND
    )
    o["skills_top_n"] = with_staging(
        "SELECT * FROM skill_demand WHERE role_family = 'data_engineering' ORDER BY n_postings DESC, skill LIMIT 20",
        SKILL_DEMAND,
    )
    o["read_company_activity"] = with_staging(
        "SELECT * FROM activity_named ORDER BY n_data_ai DESC, name_canonical LIMIT 50", ACTIVITY
    )
    o["company_top30"] = with_staging(
        "SELECT * FROM activity_named ORDER BY n_data_ai DESC, name_canonical LIMIT 30", ACTIVITY
    )
    o["company_activity_labelled"] = with_staging("SELECT * FROM activity_named", ACTIVITY)
    o["read_postings"] = with_staging(
        "SELECT * FROM postings WHERE role_canonical = 'data_engineer' ORDER BY fetched_at DESC, posting_id LIMIT 500"
    )
    o["posting_search"] = with_staging(
        "SELECT posting_id, fetched_at, role_raw, company_canonical, industry, city, salary_monthly_low, "
        "salary_monthly_high, salary_disclosed, skills FROM enriched "
        "WHERE regexp_matches(role_raw, '(?i)engineer') AND contains(skills, 'py') "
        "ORDER BY fetched_at DESC, posting_id LIMIT 200"
    )
    nn = " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, {q(c)} AS column_name, count_if({e} IS NULL) AS n_nulls FROM {cte}"
        for t, c, cte, e in _not_null_rows()
    )
    o["check_not_null"] = with_staging(nn, RAW, cells, SKILL_DEMAND, ACTIVITY)
    kq = " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, {q(kn)} AS key_name, sum(n) AS n_rows, count(*) AS n_keys, "
        f"count_if(n > 1) AS n_duplicate_keys FROM (SELECT count(*) AS n FROM {cte} GROUP BY {', '.join(cols)})"
        for t, kn, cte, cols in _keys_rows()
    )
    o["check_keys"] = with_staging(
        f"SELECT table_name, key_name, CAST(n_rows AS BIGINT) AS n_rows, n_keys, n_duplicate_keys FROM ({kq})",
        RAW, cells, SKILL_DEMAND, ACTIVITY,
    )
    o["fk_orphans"] = with_staging(
        """SELECT 'postings' AS child_table, 'companies' AS parent_table,
  count_if(company_canonical IS NOT NULL AND company_canonical NOT IN (SELECT name_canonical FROM companies)) AS n_orphans FROM postings
UNION ALL SELECT 'company_activity', 'companies',
  count_if(name_canonical NOT IN (SELECT name_canonical FROM companies)) FROM activity""",
        ACTIVITY,
    )
    o["stage_counts"] = with_staging(
        """SELECT 'feed_rows' AS stage, count(*) AS n FROM fx
UNION ALL SELECT 'valid_rows', count(*) FROM valid
UNION ALL SELECT 'raw_postings', count(*) FROM raw
UNION ALL SELECT 'postings', count(*) FROM postings
UNION ALL SELECT 'postings_with_skills', count_if(skills <> '') FROM postings
UNION ALL SELECT 'postings_without_skills', count_if(skills = '') FROM postings
UNION ALL SELECT 'companies', count(*) FROM companies
UNION ALL SELECT 'salary_by_role', count(*) FROM salary_cells
UNION ALL SELECT 'skill_demand', count(*) FROM skill_demand
UNION ALL SELECT 'company_activity', count(*) FROM activity
UNION ALL SELECT 'day1_raw_new', count_if(raw_id <= m) FROM raw, half
UNION ALL SELECT 'day1_raw_skipped', 0
UNION ALL SELECT 'day1_companies_new', count(DISTINCT name_canonical) FROM named, half WHERE seq <= m
UNION ALL SELECT 'day1_companies_updated', 0
UNION ALL SELECT 'day1_postings_new', count(DISTINCT posting_id) FROM valid, half WHERE seq <= m
UNION ALL SELECT 'day1_postings_updated', 0
UNION ALL SELECT 'day2_raw_new', count_if(raw_id > m) FROM raw, half
UNION ALL SELECT 'day2_raw_skipped', count(*) FROM (SELECT min(seq) AS a, max(seq) AS b FROM valid GROUP BY source, posting_id, fetched_at), half
  WHERE a <= m AND b > m
UNION ALL SELECT 'day2_companies_new', count(*) FROM (SELECT min(seq) AS a FROM named GROUP BY name_canonical), half WHERE a > m
UNION ALL SELECT 'day2_companies_updated', count(*) FROM (SELECT min(seq) AS a, max(seq) AS b FROM named GROUP BY name_canonical), half
  WHERE a <= m AND b > m
UNION ALL SELECT 'day2_postings_new', count(*) FROM (SELECT min(seq) AS a FROM valid GROUP BY posting_id), half WHERE a > m
UNION ALL SELECT 'day2_postings_updated', count(*) FROM (SELECT min(seq) AS a, max(seq) AS b FROM valid GROUP BY posting_id), half
  WHERE a <= m AND b > m""",
        RAW, cells, SKILL_DEMAND, ACTIVITY, "half AS (SELECT max(o_orderkey) / 2 AS m FROM orders)",
    )
    o.update(_source_and_stream_oracles())
    return o


def _a2m(v: str) -> str:
    return (
        f"CASE WHEN {v} IS NULL OR {v} = 0 THEN NULL WHEN {v} > 25000 THEN {v} "
        f"ELSE CAST(trunc(CAST({v} AS DOUBLE) * 10000 / 12) AS INT) END"
    )


BOARD_A = f"""
board_a_in AS (
  SELECT *, CASE WHEN seq % 13 <> 0 THEN company_name END AS cust_name,
         CASE WHEN seq % 7 <> 0 THEN CAST(seq AS VARCHAR) END AS job_no, 'J' || CAST(seq AS VARCHAR) AS job_id,
         CAST(salary_monthly_low AS VARCHAR) AS lo_s, CAST(salary_monthly_high AS VARCHAR) AS hi_s
  FROM fx),
board_a AS (
  SELECT '104-' || coalesce(nullif(job_no, ''), nullif(job_id, ''), '') AS posting_id, '104' AS source, fetched_at,
         role_raw, cust_name AS company_name, CAST(NULL AS VARCHAR) AS headcount_band, CAST(NULL AS VARCHAR) AS industry,
         coalesce(nullif(city, ''), 'Addr ' || CAST(seq % 50 AS VARCHAR)) AS city, CAST(NULL AS BOOLEAN) AS is_remote,
         CASE WHEN d THEN CAST(lo_s AS INT) END AS salary_monthly_low,
         CASE WHEN d THEN CAST(hi_s AS INT) END AS salary_monthly_high, 'TWD' AS salary_currency, d AS salary_disclosed,
         substring(repeat(coalesce(description_excerpt, ''), 30), 1, 600) AS description_excerpt,
         repeat(coalesce(description_excerpt, ''), 30) AS description, '' AS skills,
         'https://www.104.com.tw/job/' || CAST(seq AS VARCHAR) AS url
  FROM (SELECT *, coalesce(lo_s <> '' AND hi_s <> '' AND TRY_CAST(hi_s AS INT) > 0, false) AS d FROM board_a_in)
  WHERE cust_name IS NOT NULL)
"""

BOARD_B = f"""
board_b_in AS (
  SELECT *, CASE WHEN seq % 17 <> 0 THEN company_name END AS cname,
         CASE WHEN seq % 23 = 0 THEN 0 WHEN seq % 2 = 0 THEN salary_monthly_low
              ELSE CAST(salary_monthly_low // 5000 AS INT) END AS smin,
         CASE WHEN seq % 23 = 0 THEN 0 WHEN seq % 2 = 0 THEN salary_monthly_high
              ELSE CAST(salary_monthly_high // 5000 AS INT) END AS smax
  FROM fx),
board_b AS (
  SELECT 'yourator-' || CAST(seq AS VARCHAR) AS posting_id, 'yourator' AS source, fetched_at, role_raw,
         cname AS company_name, headcount_band, 'Industry ' || CAST(seq % 5 AS VARCHAR) AS industry, city,
         coalesce(city = 'Remote', false) AS is_remote,
         CASE WHEN d THEN {_a2m("smin")} END AS salary_monthly_low,
         CASE WHEN d THEN {_a2m("smax")} END AS salary_monthly_high, 'TWD' AS salary_currency, d AS salary_disclosed,
         substring(coalesce(description_excerpt, ''), 1, 600) AS description_excerpt,
         coalesce(description_excerpt, '') AS description,
         array_to_string(list_filter(string_split(skills_delim, '|'), lambda x: x <> ''), '|') AS skills,
         'https://www.yourator.co/companies/firm-' || CAST(seq % 200 AS VARCHAR) || '/jobs/' || CAST(seq AS VARCHAR) AS url
  FROM (SELECT *, coalesce(smin, 0) <> 0 AND coalesce(smax, 0) <> 0 AS d FROM board_b_in)
  WHERE cname IS NOT NULL)
"""

UNION_COLS = "posting_id, source, fetched_at, role_raw, company_name, salary_monthly_low, salary_monthly_high, salary_disclosed"

UNION = f"""
u AS (SELECT {UNION_COLS} FROM fx UNION ALL SELECT {UNION_COLS} FROM board_a UNION ALL SELECT {UNION_COLS} FROM board_b)
"""

EVENTS = """
ev AS (SELECT event_id, CAST(user_id AS VARCHAR) AS posting_id, event_type AS role_family, value, ts AS event_time
       FROM events)
"""


def _source_and_stream_oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    fx = f"WITH fx AS ({FEED}),"
    o["board_a_map"] = f"{fx} {BOARD_A} SELECT * FROM board_a"
    o["board_b_map"] = f"{fx} {BOARD_B} SELECT * FROM board_b"
    o["annual_to_monthly"] = f"""SELECT seq, value, {_a2m("value")} AS monthly FROM (
  SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 0
                                 ELSE CAST(floor(o_totalprice / 10) AS INT) END AS value FROM orders)"""
    o["source_union"] = f"{fx} {BOARD_A}, {BOARD_B}, {UNION} SELECT * FROM u"
    o["rows_per_source"] = f"""{fx} {BOARD_A}, {BOARD_B}, {UNION}
SELECT s.source, coalesce(c.n, 0) AS n_rows
FROM (VALUES ('104'), ('yourator'), ('sample'), ('unknown')) AS s(source)
LEFT JOIN (SELECT source, count(*) AS n FROM u GROUP BY source) c USING (source)"""
    odd = lambda every, i, t, high="NULL", text="NULL": (
        f"SELECT {i}, 'sample', {t}, {text}, NULL, NULL, NULL, NULL, {high}, NULL, '', NULL FROM fx WHERE seq % {every} = 0")
    o["raw_scan_valid"] = f"""WITH fx AS ({FEED})
SELECT posting_id, source, fetched_at, CAST(NULL AS VARCHAR) AS fetched_at_text, role_raw, company_name, experience_years_min,
       salary_monthly_low, salary_monthly_high, salary_disclosed, skills_delim AS skills, description_excerpt FROM fx
UNION ALL {odd(43, "'B-' || seq", "TIMESTAMP '2024-01-01'")}
UNION ALL {odd(47, "'N-' || seq", "TIMESTAMP '2024-01-02'")}
UNION ALL {odd(61, "'U-' || seq", "NULL", text="'garbled'")}
UNION ALL {odd(59, "CAST(seq AS VARCHAR)", "TIMESTAMP '2024-01-03'", high="70000")}"""
    o["bad_lines"] = f"""WITH fx AS ({FEED})
SELECT count_if(seq % 37 = 0) + count_if(seq % 67 = 0) + count_if(seq % 71 = 0) + count_if(seq % 73 = 0) AS bad_lines FROM fx"""
    o["landing_files"] = f"""WITH fx AS ({FEED})
SELECT posting_id, source, source AS board, fetched_at, role_raw, company_name, city, salary_monthly_high FROM fx"""
    o["postings_scan"] = with_staging(
        "SELECT posting_id, role_canonical, seniority, fetched_at, salary_monthly_low, skills FROM postings "
        "WHERE role_family = 'data_engineering'"
    )
    slices = " UNION ALL ".join(
        f"SELECT {q(t)} AS table_name, d AS snapshot_date, (SELECT count(*) FROM {cte}) AS n_rows "
        f"FROM (VALUES (DATE '2025-12-31'), (DATE '{SNAPSHOT}')) AS v(d)"
        for t, cte in (("salary_by_role", "salary_cells"), ("skill_demand", "skill_demand"),
                       ("company_activity", "activity"))
    )
    o["mart_rewrite"] = with_staging(slices, _salary_cells_ctes(), SKILL_DEMAND, ACTIVITY)
    o["stream_hourly"] = """SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, role_family, n FROM (
  SELECT date_trunc('hour', ts) AS window_start, event_type AS role_family, count(*) AS n FROM events GROUP BY 1, 2)
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR"""
    o["stream_arrivals"] = o["stream_hourly"]
    o["stream_hot_upsert"] = f"""WITH {EVENTS}
SELECT posting_id, event_id, role_family, value, event_time FROM ev
QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY event_time DESC, event_id DESC) = 1"""
    o["stream_decode"] = with_staging(
        "SELECT posting_id, source, role_canonical, role_family, seniority, city, is_remote, salary_monthly_low, "
        "salary_monthly_high, salary_disclosed, fetched_at FROM postings"
    )
    o["recent_postings"] = f"""WITH {EVENTS}
SELECT event_id, posting_id, role_family, event_time FROM ev
QUALIFY row_number() OVER (PARTITION BY posting_id ORDER BY event_time DESC, event_id DESC) = 1
  AND event_time > (SELECT max(event_time) FROM ev) - INTERVAL 1 HOUR"""
    return o
