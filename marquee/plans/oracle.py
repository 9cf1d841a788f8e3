"""DuckDB SQL of every registered query, written independently of the DataFrame code.

The driver tables are pre-registered as views. ``cat`` re-derives the
catalogue, ``cleaned`` applies the cleaning rules. Java's ``\\s`` is
``[ \\t\\n\\x0B\\f\\r]``; RE2 (DuckDB) lacks ``\\x0B`` in ``\\s``, so the class is spelled out.
"""

from __future__ import annotations

from marquee.sources.tpch_catalogue import ORACLE_CTE

WS = r" \t\n\x0B\f\r"

CLEAN_CTE = ORACLE_CTE + rf""",
clean0 AS (
  SELECT id,
         CASE WHEN lower(trim(status)) IN ('f', 'o') THEN trim(status) ELSE 'Others' END AS status,
         regexp_replace(genres, '[^a-zA-Z{WS},]', '', 'g') AS genres,
         release_date, runtime,
         CAST(year(release_date) AS VARCHAR) AS year,
         lpad(CAST(month(release_date) AS VARCHAR), 2, '0') AS month,
         budget, revenue, vote_count, vote_average, title,
         trim(lower(regexp_replace(production_companies, '[^a-zA-Z{WS},.]', '', 'g'))) AS production_companies
  FROM cat
  WHERE release_date IS NOT NULL AND revenue IS NOT NULL AND budget IS NOT NULL
),
clean1 AS (
  SELECT id, status, coalesce(genres, 'NA') AS genres, release_date, runtime, year, month, budget, revenue,
         vote_count, vote_average, coalesce(title, '') AS title,
         coalesce(production_companies, 'NA') AS production_companies
  FROM clean0
),
cleaned AS (
  SELECT * FROM clean1
  WHERE NOT coalesce(runtime > 300 OR runtime < 0, false)
    AND NOT coalesce(vote_average > 40 OR vote_average < 0, false)
    AND NOT coalesce(budget < 0 OR revenue < 0, false)
)"""

GENRE_LIST = "('economy', 'small', 'medium', 'promo', 'standard', 'na')"
DENY_LIST = "('economy', 'small', 'medium', 'promo', 'standard', 'large', 'na', '')"
NAME_PATTERN = r"^[a-zA-Z]+(\.[a-zA-Z]+)*$"

GENRE_CTE = CLEAN_CTE + f""",
genre_rows AS (
  SELECT c.id, c.year, c.month, c.budget, c.revenue, c.vote_count, c.release_date, trim(t.tok) AS genres
  FROM cleaned c CROSS JOIN unnest(string_split(lower(c.genres), ', ')) AS t(tok)
  WHERE trim(t.tok) IN {GENRE_LIST}
)"""

COMPANY_CTE = CLEAN_CTE + f""",
company_tokens AS (
  SELECT c.id, c.year, c.release_date, trim(lower(t.tok)) AS pc
  FROM cleaned c CROSS JOIN unnest(string_split(c.production_companies, ', ')) AS t(tok)
),
company_rows AS (
  SELECT * FROM company_tokens
  WHERE pc IS NOT NULL AND pc NOT IN {DENY_LIST} AND length(pc) > 5 AND regexp_matches(pc, '{NAME_PATTERN}')
)"""

CORR = """CASE WHEN isnan(corr(CAST(budget AS DOUBLE), CAST(revenue AS DOUBLE))) THEN NULL
            ELSE round(corr(CAST(budget AS DOUBLE), CAST(revenue AS DOUBLE)), 6) END"""

METRICS = f"""count(id) AS total_movies,
       CAST(sum(budget) AS DOUBLE) AS total_budget,
       CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       {CORR} AS budget_revenue_correlation"""

OUTLIER_FLAGS = """coalesce(runtime > 300 OR runtime < 0, false) AS r,
       coalesce(vote_average > 40 OR vote_average < 0, false) AS v,
       coalesce(budget < 0 OR revenue < 0, false) AS m"""


def w(cte: str, body: str) -> str:
    return f"WITH {cte}\n{body}"


def _nulls(cols: list[str], src: str) -> str:
    inner = ", ".join(f'count(*) FILTER (WHERE "{c}" IS NULL) AS "{c}"' for c in cols)
    on = ", ".join(f'"{c}"' for c in cols)
    return f"UNPIVOT (SELECT {inner} FROM {src}) ON {on} INTO NAME column_name VALUE nulls"


def _distinct(cols: list[str], src: str) -> str:
    inner = ", ".join(
        f'count(DISTINCT "{c}") + coalesce(max(CASE WHEN "{c}" IS NULL THEN 1 ELSE 0 END), 0) AS "{c}"' for c in cols
    )
    on = ", ".join(f'"{c}"' for c in cols)
    return (
        f"UNPIVOT (SELECT count(*) AS rows, {inner} FROM {src}) ON {on} "
        "INTO NAME column_name VALUE distinct_values"
    )


def _growth(src: str, value: str) -> str:
    prior = f"coalesce(sum({value}) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    return (
        f"SELECT year, {value}, CAST({prior} AS BIGINT) AS prev_yr_pc_count, "
        f"CAST({value} + {prior} AS BIGINT) AS pc_yoy_growth_count FROM ({src})"
    )


def _debuts(src: str, entity: str, as_: str, where: str = "") -> str:
    """Distinct entities per year among the rows of each entity's first year, in the rank form."""
    return f"""SELECT year, count(DISTINCT e) AS {as_} FROM (
  SELECT {entity} AS e, year, dense_rank() OVER (PARTITION BY {entity} ORDER BY year) AS place FROM {src} {where})
WHERE place = 1 AND e IS NOT NULL GROUP BY year"""


def _cumulative(measure: str, yearly: str, cumulative: str) -> str:
    return w(CLEAN_CTE, f"""SELECT year, CAST(sum({measure}) AS DOUBLE) AS {yearly},
       CAST(sum(sum({measure})) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE)
         AS {cumulative}
FROM cleaned GROUP BY year""")


RAW_COLS = ["id", "title", "vote_average", "vote_count", "status", "release_date", "revenue", "runtime", "budget",
            "genres", "production_companies"]
CLEAN_TYPES = [("id", "bigint"), ("status", "string"), ("genres", "string"), ("release_date", "date"),
               ("runtime", "int"), ("year", "string"), ("month", "string"), ("budget", "decimal(18,2)"),
               ("revenue", "decimal(18,2)"), ("vote_count", "int"), ("vote_average", "double"), ("title", "string"),
               ("production_companies", "string")]
DISTINCT_COLS = ["status", "genres", "production_companies", "release_date"]
RAW_TYPES = [("id", "bigint"), ("title", "string"), ("vote_average", "double"), ("vote_count", "int"),
             ("status", "string"), ("release_date", "date"), ("revenue", "decimal(18,2)"), ("runtime", "int"),
             ("budget", "decimal(18,2)"), ("genres", "string"), ("production_companies", "string")]
REPORT_DISTINCT = ["status", "genres", "production_companies", "release_date"]


def _report(stage: str, src: str, types: list[tuple[str, str]]) -> str:
    vals = ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(types))
    nulls = _nulls([c for c, _ in types], src)
    dist = _distinct(REPORT_DISTINCT, src)
    return f"""SELECT '{stage}' AS stage, n.column_name, CAST(t.position AS BIGINT) AS position, t.data_type, n.nulls,
       CAST(d.distinct_values AS DOUBLE) AS distinct_values, r.rows
FROM ({nulls}) n
JOIN (VALUES {vals}) AS t(column_name, data_type, position) USING (column_name)
LEFT JOIN ({dist}) d USING (column_name)
CROSS JOIN (SELECT count(*) AS rows FROM {src}) r"""

SQL: dict[str, str] = {}

# ---- B: parsing
SQL["typed_projection"] = w(ORACLE_CTE, """SELECT id, status, CAST(release_date AS VARCHAR) AS release_date,
       CAST(year(release_date) AS BIGINT) AS year, CAST(month(release_date) AS BIGINT) AS month,
       CAST(year(release_date) AS VARCHAR) AS year_text, lpad(CAST(month(release_date) AS VARCHAR), 2, '0') AS month_text,
       CAST(runtime AS DOUBLE) AS runtime, CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue,
       CAST(vote_count AS DOUBLE) AS vote_count, vote_average, title
FROM cat""")

SQL["malformed_values"] = w(ORACLE_CTE, """UNPIVOT (
  SELECT count(*) FILTER (WHERE TRY_CAST(CAST(id AS VARCHAR) AS BIGINT) IS NULL) AS id,
         count(*) FILTER (WHERE TRY_CAST(CAST(release_date AS VARCHAR) AS DATE) IS NULL) AS release_date,
         count(*) FILTER (WHERE TRY_CAST(CAST(runtime AS VARCHAR) AS INTEGER) IS NULL) AS runtime,
         count(*) FILTER (WHERE TRY_CAST(title AS INTEGER) IS NULL) AS title,
         count(*) FILTER (WHERE TRY_CAST(status AS DATE) IS NULL) AS status,
         count(*) FILTER (WHERE TRY_CAST(genres AS DOUBLE) IS NULL) AS genres
  FROM cat
) ON id, release_date, runtime, title, status, genres INTO NAME column_name VALUE nulls""")

SQL["numeric_text"] = """SELECT event_id, CAST(trunc(value) AS BIGINT) AS as_int, CAST(trunc(value) AS BIGINT) AS as_bigint
FROM events"""

# ---- C: filters, nulls
SQL["drop_incomplete"] = w(ORACLE_CTE, """SELECT id, status, CAST(release_date AS VARCHAR) AS release_date,
       CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue
FROM cat WHERE release_date IS NOT NULL AND revenue IS NOT NULL AND budget IS NOT NULL""")

SQL["fill_defaults"] = w(ORACLE_CTE, """SELECT id, coalesce(genres, 'NA') AS genres, coalesce(title, '') AS title,
       coalesce(production_companies, 'NA') AS production_companies
FROM cat""")

SQL["status_normalised"] = w(ORACLE_CTE, """SELECT CASE WHEN lower(trim(status)) IN ('f', 'o') THEN trim(status)
            ELSE 'Others' END AS status, count(*) AS titles
FROM cat GROUP BY 1""")

SQL["strip_text"] = f"""SELECT doc_id, length(g) AS genre_text_length, md5(g) AS genre_text_md5,
       length(c) AS company_text_length, md5(c) AS company_text_md5
FROM (SELECT doc_id, regexp_replace(text, '[^a-zA-Z{WS},]', '', 'g') AS g,
             regexp_replace(text, '[^a-zA-Z{WS},.]', '', 'g') AS c
      FROM documents)"""

# ---- outliers
SQL["outlier_by_row"] = w(CLEAN_CTE, "SELECT id, year, month FROM cleaned")

SQL["outlier_by_key"] = w(CLEAN_CTE, f""", flagged AS (SELECT *, {OUTLIER_FLAGS} FROM clean1)
SELECT id, year, month FROM flagged f
WHERE NOT (r OR v OR m)
  AND NOT EXISTS (SELECT 1 FROM flagged b WHERE b.id = f.id AND (b.r OR b.v OR b.m))""".replace(
    "WITH ", "WITH ", 1)).replace(")\n, flagged", "),\nflagged")

SQL["outlier_by_title"] = w(CLEAN_CTE, """SELECT id, title FROM cleaned
WHERE title NOT IN (SELECT title FROM clean1 WHERE id NOT IN (SELECT id FROM cleaned))""")

SQL["outlier_counts"] = w(CLEAN_CTE, f"""SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE r) AS runtime_outliers,
       count(*) FILTER (WHERE NOT r AND v) AS vote_average_outliers,
       count(*) FILTER (WHERE NOT r AND NOT v AND m) AS money_outliers,
       count(*) FILTER (WHERE NOT r AND NOT v AND NOT m) AS rows_kept
FROM (SELECT {OUTLIER_FLAGS} FROM clean1)""")

SQL["zero_measures"] = """SELECT l_returnflag, count(*) AS rows,
       count(*) FILTER (WHERE l_discount = 0 AND l_tax = 0) AS both_zero
FROM lineitem GROUP BY l_returnflag"""

SQL["genre_zero_measures"] = w(GENRE_CTE, """SELECT count(*) AS rows,
       count(*) FILTER (WHERE budget = 0 AND revenue = 0) AS both_zero
FROM genre_rows""")

# ---- I/O
SQL["incremental_new_rows"] = w(ORACLE_CTE, """SELECT id, status, CAST(release_date AS VARCHAR) AS release_date
FROM cat WHERE id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = cat.id)""")

SQL["ingest_roundtrip"] = w(CLEAN_CTE, """SELECT month, count(*) AS titles, CAST(sum(revenue) AS DOUBLE) AS total_revenue
FROM cleaned GROUP BY month""")

SQL["ingest_counts"] = """WITH c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE turn % 3 = 2) AS bad, count(DISTINCT conv_id) FILTER (WHERE turn % 3 <> 2) AS keys,
         max(conv_id) FILTER (WHERE turn % 3 <> 2) AS top FROM conversations)
SELECT r AS run, n AS rows_read, bad AS rejected_null_key, n - bad - keys AS duplicate_in_batch,
       CASE r WHEN 0 THEN 0 ELSE keys END AS already_in_sink, CASE r WHEN 0 THEN keys ELSE 0 END AS new_rows, top AS max_id
FROM c, range(2) t(r)"""

SQL["ingest_stream"] = "SELECT event_id, event_type, value FROM events"

SQL["csv_stream"] = """WITH c AS (
  SELECT conv_id * 100000 + turn AS key, turn, turn % 3 AS part, turn % 3 = 2 AND conv_id % 5 = 0 AS bad, length(coalesce(text, '')) AS chars
  FROM conversations),
good AS (SELECT key, any_value(turn) AS turn, any_value(chars) AS chars FROM c WHERE NOT bad GROUP BY key),
sink AS (SELECT count(*) AS sink_rows, CAST(sum(chars) AS BIGINT) AS sink_chars, CAST(sum(turn) AS BIGINT) AS sink_turns FROM good),
loads AS (
  SELECT part AS run, count(*) AS rows_read, count(*) FILTER (WHERE bad) AS rejected_null_key, count(DISTINCT key) FILTER (WHERE NOT bad) AS keys,
         max(key) FILTER (WHERE NOT bad) AS max_id FROM c GROUP BY part
  UNION ALL
  SELECT 3, count(*), count(*) FILTER (WHERE bad), count(DISTINCT key) FILTER (WHERE NOT bad), max(key) FILTER (WHERE NOT bad) FROM c)
SELECT run, rows_read, rejected_null_key, rows_read - rejected_null_key - keys AS duplicate_in_batch,
       CASE run WHEN 3 THEN keys ELSE 0 END AS already_in_sink, CASE run WHEN 3 THEN 0 ELSE keys END AS new_rows, max_id,
       sink_rows, sink_chars, sink_turns, (SELECT 2 * count(*) FROM c WHERE bad) AS reject_lines
FROM loads, sink"""

SQL["ingest_state"] = """WITH e AS (
  SELECT event_id, event_id % 3 AS r, user_id % 7 = 0 AS twice FROM events),
l AS (
  SELECT '1' AS load_id, count(*) AS rows_read, 0 AS rejected_null_key, 0 AS duplicate_in_batch, 0 AS already_in_sink, count(*) AS new_rows,
         max(event_id) AS max_id FROM e WHERE r = 0
  UNION ALL SELECT '2', count(*), 0, 0, count(*) FILTER (WHERE r = 0), count(*) FILTER (WHERE r = 2), max(event_id) FROM e WHERE r <> 1
  UNION ALL SELECT '3', count(*) + count(*) FILTER (WHERE twice), 0, count(*) FILTER (WHERE twice), count(*) FILTER (WHERE r <> 1),
         count(*) FILTER (WHERE r = 1), max(event_id) FROM e)
SELECT l.*, (SELECT count(*) FROM events) AS sink_rows FROM l"""

SQL["incremental_clean"] = w(CLEAN_CTE, """SELECT month, count(*) AS titles, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(length(genres)) AS BIGINT) AS genre_chars, month IN ('02', '11') AS rewritten
FROM cleaned WHERE id % 3 <> 0 OR month IN ('02', '11') GROUP BY month""")

SQL["bucketed_ingest"] = w(ORACLE_CTE, """SELECT r AS run,
       CASE r WHEN 0 THEN count(*) FILTER (WHERE id % 4 <> 0) ELSE count(*) + count(*) FILTER (WHERE id % 5 = 0) END AS rows_read,
       0 AS rejected_null_key, CASE r WHEN 0 THEN 0 ELSE count(*) FILTER (WHERE id % 5 = 0) END AS duplicate_in_batch,
       CASE r WHEN 0 THEN 0 ELSE count(*) FILTER (WHERE id % 4 <> 0) END AS already_in_sink,
       CASE r WHEN 0 THEN count(*) FILTER (WHERE id % 4 <> 0) ELSE count(*) FILTER (WHERE id % 4 = 0) END AS new_rows,
       CASE r WHEN 0 THEN max(id) FILTER (WHERE id % 4 <> 0) ELSE max(id) END AS max_id, CAST(sum(budget) AS DOUBLE) AS sink_budget
FROM cat, range(2) t(r) GROUP BY r""")

SQL["csv_roundtrip"] = """SELECT doc_id, length(text) AS text_length, md5(text) AS text_md5, lang, source
FROM documents"""

SQL["external_table"] = w(CLEAN_CTE, """SELECT month, count(*) AS titles, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       CAST(sum(budget) AS DOUBLE) AS total_budget
FROM cleaned GROUP BY month""")

# ---- profile
_types = ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(CLEAN_TYPES))
SQL["schema_profile"] = w(CLEAN_CTE, f"""SELECT n.column_name, t.data_type, n.nulls, CAST(t.position AS BIGINT) AS position
FROM ({_nulls([c for c, _ in CLEAN_TYPES], "cleaned")}) n
JOIN (VALUES {_types}) AS t(column_name, data_type, position) USING (column_name)""")

SQL["null_profile"] = w(ORACLE_CTE, _nulls(RAW_COLS, "cat"))
SQL["distinct_profile"] = w(ORACLE_CTE, _distinct(DISTINCT_COLS, "cat"))
SQL["distinct_profile_clean"] = w(CLEAN_CTE, _distinct(DISTINCT_COLS, "cleaned"))
SQL["key_max"] = w(ORACLE_CTE, "SELECT count(*) AS rows, max(TRY_CAST(CAST(id AS VARCHAR) AS BIGINT)) AS max_id FROM cat")

# ---- genres
SQL["genre_year"] = w(GENRE_CTE, f"SELECT year, genres, {METRICS} FROM genre_rows GROUP BY year, genres")
SQL["genre_month"] = w(GENRE_CTE, f"SELECT month, genres, {METRICS} FROM genre_rows GROUP BY month, genres")
SQL["genre_total"] = w(GENRE_CTE, f"SELECT genres, {METRICS} FROM genre_rows GROUP BY genres")
SQL["genre_grouping_sets"] = w(GENRE_CTE, f"""SELECT GROUPING_ID(year, genres, month) AS grain, year, month, genres, {METRICS}
FROM genre_rows GROUP BY GROUPING SETS ((year, genres), (month, genres), (genres))""")
SQL["genre_view"] = w(GENRE_CTE, f"""SELECT CAST(year(release_date) AS BIGINT) AS release_year,
       CAST(month(release_date) AS BIGINT) AS release_month, genres AS genre, count(*) AS movie_count,
       CAST(sum(budget) AS DOUBLE) AS total_budget_by_genre, CAST(sum(revenue) AS DOUBLE) AS total_revenue_by_genre,
       CAST(sum(vote_count) AS BIGINT) AS total_votes_by_genre, {CORR} AS budget_revenue_correlation
FROM genre_rows GROUP BY 1, 2, 3""")
SQL["table_views"] = SQL["genre_view"]
SQL["genre_top5"] = w(GENRE_CTE, f"""SELECT year, genres, {METRICS} FROM genre_rows GROUP BY year, genres
ORDER BY total_movies DESC, year, genres LIMIT 5""")
SQL["genre_month_top5"] = w(GENRE_CTE, f"""SELECT month, genres, {METRICS} FROM genre_rows GROUP BY month, genres
ORDER BY total_movies DESC, month, genres LIMIT 5""")
SQL["genre_sample"] = w(GENRE_CTE, """SELECT id, genres, year, CAST(budget AS DOUBLE) AS budget, CAST(revenue AS DOUBLE) AS revenue
FROM genre_rows WHERE genres = 'promo' ORDER BY id LIMIT 5""")
SQL["budget_by_year_genre"] = w(GENRE_CTE, """SELECT year, genres, CAST(sum(budget) AS DOUBLE) AS total_budget
FROM genre_rows GROUP BY year, genres""")
SQL["releases_per_year"] = w(CLEAN_CTE, "SELECT year, count(*) AS releases FROM cleaned GROUP BY year")

# ---- words of free text
WORD_CTE = f"""texts AS (SELECT 'documents' AS src, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations),
words AS (
  SELECT src, trim(t.tok) AS pc
  FROM texts CROSS JOIN unnest(string_split(lower(translate(text, chr(10) || chr(9) || chr(13), '   ')), ' ')) AS t(tok)
  WHERE trim(t.tok) NOT IN ('license', 'version', 'public', '') AND length(trim(t.tok)) > 5
    AND regexp_matches(trim(t.tok), '{NAME_PATTERN}'))"""
SQL["word_filter"] = w(WORD_CTE, "SELECT src, count(*) AS words, CAST(sum(length(pc)) AS BIGINT) AS letters FROM words GROUP BY src")
SQL["word_frequency"] = w(WORD_CTE, "SELECT pc, count(*) AS count FROM words GROUP BY pc HAVING count(*) > 5")
SQL["word_groups"] = w(WORD_CTE, """SELECT count(*) AS groups, count(*) FILTER (WHERE count > 5) AS groups_over_5
FROM (SELECT pc, count(*) AS count FROM words GROUP BY pc)""")

# ---- companies
SQL["company_filter"] = w(COMPANY_CTE, "SELECT id, pc FROM company_rows")
SQL["company_frequency"] = w(COMPANY_CTE, "SELECT pc, count(*) AS count FROM company_rows GROUP BY pc")
SQL["company_frequent_count"] = w(COMPANY_CTE, """SELECT count(*) AS groups, count(*) FILTER (WHERE count > 5) AS groups_over_5
FROM (SELECT pc, count(*) AS count FROM company_rows GROUP BY pc)""")
SQL["company_debut"] = w(COMPANY_CTE, _debuts("company_rows", "pc", "debuts"))
SQL["company_growth"] = w(COMPANY_CTE, _growth(_debuts("company_rows", "pc", "pc_distinct"), "pc_distinct"))
SQL["company_string_growth"] = w(CLEAN_CTE, _growth(
    _debuts("cleaned", "lower(production_companies)", "pc_count_by_year", "WHERE lower(production_companies) <> 'na'"), "pc_count_by_year"))
SQL["title_growth"] = w(CLEAN_CTE, _growth(
    _debuts("cleaned", "lower(title)", "pc_count_by_year", "WHERE lower(title) <> 'na'"), "pc_count_by_year"))
_CUMULATIVE_VIEW = """SELECT CAST(year AS BIGINT) AS release_year, pc_distinct_count,
       CAST(sum(pc_distinct_count) OVER (ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS pc_cumm_count
FROM ({})"""
SQL["company_cumulative_view"] = w(COMPANY_CTE, _CUMULATIVE_VIEW.format(_debuts("company_rows", "pc", "pc_distinct_count")))
SQL["title_cumulative_view"] = w(CLEAN_CTE, _CUMULATIVE_VIEW.format(_debuts("cleaned", "title", "pc_distinct_count")))
SQL["companies_per_year"] = w(CLEAN_CTE, _growth(
    "SELECT year, count(DISTINCT production_companies) AS prod_companies_count FROM cleaned GROUP BY year",
    "prod_companies_count"))
SQL["cumulative_budget"] = _cumulative("budget", "yearly_budget", "yoy_budget")
SQL["cumulative_revenue"] = _cumulative("revenue", "yearly_revenue", "yoy_revenue")

# ---- top-k, views, whole rule set
SQL["longest_values"] = """SELECT doc_id, length(text) AS length FROM documents
ORDER BY length DESC, doc_id LIMIT 10"""
SQL["longest_genres"] = w(CLEAN_CTE, """SELECT id, genres, length(genres) AS genres_len FROM cleaned
ORDER BY genres_len DESC, id LIMIT 10""")
SQL["longest_companies"] = w(CLEAN_CTE, """SELECT id, production_companies, length(production_companies) AS pc_len
FROM cleaned ORDER BY pc_len DESC, id LIMIT 10""")
SQL["release_view"] = w(CLEAN_CTE, """SELECT id, CAST(revenue AS DOUBLE) AS revenue, CAST(release_date AS VARCHAR) AS release_date,
       year AS release_year, month AS release_month, CAST(budget AS DOUBLE) AS budget, status, vote_average,
       CAST(vote_count AS BIGINT) AS vote_count
FROM cleaned WHERE release_date IS NOT NULL""")
SQL["cleaned_catalogue"] = w(CLEAN_CTE, """SELECT id, status, genres, CAST(release_date AS VARCHAR) AS release_date,
       CAST(runtime AS BIGINT) AS runtime, year, month, CAST(budget AS DOUBLE) AS budget,
       CAST(revenue AS DOUBLE) AS revenue, CAST(vote_count AS BIGINT) AS vote_count, vote_average, title,
       production_companies
FROM cleaned""")

SQL["quality_report"] = w(CLEAN_CTE, _report("raw", "cat", RAW_TYPES) + "\nUNION ALL\n" + _report("cleaned", "clean1", CLEAN_TYPES)
                          + "\nUNION ALL\n" + _report("kept", "cleaned", CLEAN_TYPES))

SQL["company_string_debut"] = w(CLEAN_CTE, _debuts("cleaned", "lower(production_companies)", "pc_count_by_year"))

# ---- zones that grow load by load: the plain form over all rows
SQL["debut_state"] = SQL["company_growth"]
SQL["title_debut_state"] = SQL["title_growth"]
SQL["genre_state"] = SQL["genre_year"]
SQL["sketch_profile"] = w(ORACLE_CTE, " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) AS rows, count(*) FILTER (WHERE {c} IS NULL) AS nulls,
       count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS exact_values, true AS within_error FROM cat""" for c in DISTINCT_COLS))
SQL["partition_refresh"] = w(CLEAN_CTE, """SELECT month, count(*) AS titles, CAST(sum(revenue) AS DOUBLE) AS total_revenue,
       CASE WHEN month IN ('04', '07', '12') THEN count(*) ELSE -1 END AS catalogue_rows
FROM cleaned WHERE month IN ('04', '07', '12') OR id % 2 = 0 GROUP BY month""")
SQL["event_cumulative"] = """SELECT event_id, count(*) OVER o AS events_so_far, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER o AS BIGINT) AS cents_so_far
FROM events WINDOW o AS (ORDER BY ts NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING)"""
SQL["daily_cumulative"] = w(CLEAN_CTE, """SELECT CAST(release_date AS VARCHAR) AS release_date, CAST(r AS DOUBLE) AS daily_revenue,
       CAST(sum(r) OVER (ORDER BY release_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS DOUBLE) AS earlier_revenue
FROM (SELECT release_date, sum(revenue) AS r FROM cleaned GROUP BY release_date)""")
