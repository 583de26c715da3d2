"""The same queries as SQL for another engine, over the same tables.

The SQL uses the complete keyword lists and recovers rollup counts from percentages, so it
checks the reduced lists and the stored counts instead of repeating them.
"""

from __future__ import annotations

from harness.adapters import FETCHED, HEADLINES, TRICKY
from harness.registry import DOCUMENT_KEYWORDS, DOCUMENT_RULE
from newsrisk.functions.dates import INDONESIAN_MONTHS
from newsrisk.functions.lexicon import COMPONENTS, COMPOSITES, RELEVANCE, RISK_RULES

ORACLE: dict[str, str] = {}


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _any(column: str, words) -> str:
    return "(" + " OR ".join(f"{column} ILIKE '%{w}%'" for w in words) + ")"


def _rule(column: str, rule) -> str:
    clauses = []
    for c in rule.clauses:
        parts = [_any(column, c.triggers)]
        if c.requires:
            parts.append(_any(column, c.requires))
        if c.excludes:
            parts.append("NOT " + _any(column, c.excludes))
        clauses.append("(" + " AND ".join(parts) + ")")
    return f"CASE WHEN {' OR '.join(clauses)} THEN 1 ELSE 0 END"


def _relevance(column: str) -> str:
    words = " OR ".join(f"regexp_matches({column}, '\\b{w}\\b')" for w in RELEVANCE.actor_words)
    return (
        f"CASE WHEN ({_any(column, RELEVANCE.actors)} OR {words}) "
        f"AND {_any(column, RELEVANCE.domestic)} THEN 1 ELSE 0 END"
    )


def _flags(column: str) -> str:
    return ", ".join(f"{_rule(column, r)} AS is_{r.name}" for r in RISK_RULES)


_HEADLINES = "[" + ", ".join(_text(h) for h in HEADLINES) + "]"


def _headline(key: str) -> str:
    return f"list_extract({_HEADLINES}, CAST({key} % {len(HEADLINES)} + 1 AS BIGINT))"


RAW = f"""raw_news AS (
  SELECT {_headline('o_orderkey')} AS title,
         'https://news.example/' || o_custkey || '/' || (o_orderkey % 5) AS link,
         o_orderpriority AS category, '' AS date_text, o_orderstatus AS source,
         o_orderkey AS ingest_seq, CAST(o_orderdate AS DATE) AS published_date
  FROM orders)"""

EVENTS = f"""event_articles AS (
  SELECT {_headline('event_id')} AS title,
         'https://news.example/' || event_type || '/' || user_id AS link,
         event_type AS category, strftime(ts, '%Y-%m-%d') AS date_text,
         'events' AS source, event_id AS ingest_seq, CAST(ts AS DATE) AS published_date
  FROM events)"""

_DEDUP = "ROW_NUMBER() OVER (PARTITION BY link ORDER BY published_date DESC, ingest_seq DESC)"


def _staging(bronze: str, name: str = "stg") -> str:
    return f"""{name} AS (
  SELECT *, {_relevance('title_cleaned')} AS is_relevant
  FROM (SELECT title, lower(title) AS title_cleaned, link, category, date_text, source,
               published_date, ingest_seq
        FROM (SELECT *, {_DEDUP} AS rn FROM {bronze}) WHERE rn = 1))"""


def _pct(parts, total: str = "total_articles") -> str:
    counts = " + ".join(f"count_{p}" for p in parts)
    return f"ROUND(({counts}) * 100.0 / NULLIF({total}, 0), 4)"


_INDICES = ", ".join(
    [f"{_pct([c])} AS idx_{c}" for c in COMPONENTS]
    + [f"{_pct(parts)} AS {name}" for name, parts in COMPOSITES.items()]
)
_COUNTS = ", ".join(f"count_{c}" for c in COMPONENTS)


def _counts(staged: str) -> str:
    sums = ", ".join(
        f"CAST(SUM(CASE WHEN is_relevant = 1 THEN {_rule('title_cleaned', r)} ELSE 0 END) "
        f"AS BIGINT) AS count_{r.name}"
        for r in RISK_RULES
    )
    return (
        f"SELECT published_date, COUNT(*) FILTER (WHERE is_relevant = 1) AS total_articles, "
        f"{sums} FROM {staged} GROUP BY 1"
    )


def _daily(staged: str = "stg", name: str = "daily") -> str:
    return (
        f"{name} AS (SELECT published_date, total_articles, {_COUNTS}, {_INDICES} "
        f"FROM ({_counts(staged)}))"
    )


def _rollup(period: str) -> str:
    recovered = ", ".join(
        f"SUM(ROUND(idx_{c} * total_articles / 100.0)) AS count_{c}" for c in COMPONENTS
    )
    return f"""SELECT {period}_start, first_day_in_{period}, last_day_in_{period},
      days_with_data, total_articles, {_INDICES}
    FROM (SELECT CAST(date_trunc('{period}', published_date) AS DATE) AS {period}_start,
                 MIN(published_date) AS first_day_in_{period},
                 MAX(published_date) AS last_day_in_{period},
                 COUNT(DISTINCT published_date) AS days_with_data,
                 CAST(SUM(total_articles) AS BIGINT) AS total_articles, {recovered}
          FROM daily GROUP BY 1)"""


_STG = f"{RAW}, {_staging('raw_news')}"
_STG_DAILY = f"{_STG}, {_daily()}"
_RAW_COLUMNS = "title, link, category, date_text, source, ingest_seq, published_date"

ORACLE["staging_clean"] = (
    f"WITH {RAW} SELECT title, lower(title) AS title_cleaned, link, category, date_text, "
    "source, published_date, ingest_seq FROM raw_news"
)
ORACLE["staging_dedup"] = (
    f"WITH {RAW} SELECT title, link, category, source, ingest_seq, published_date "
    f"FROM (SELECT *, {_DEDUP} AS rn FROM raw_news) WHERE rn = 1"
)
ORACLE["dedup_last_wins"] = f"""WITH {EVENTS} SELECT {_RAW_COLUMNS} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY link ORDER BY ingest_seq DESC) AS rn
  FROM event_articles) WHERE rn = 1"""
ORACLE["dedup_stats"] = f"""WITH {EVENTS}
  SELECT COUNT(*) AS articles, COUNT(DISTINCT link) AS unique_articles,
         COUNT(*) - COUNT(DISTINCT link) AS duplicates_removed FROM event_articles"""
ORACLE["staging"] = f"WITH {_STG} SELECT * FROM stg"
ORACLE["relevance_flag"] = (
    f"WITH {RAW} SELECT ingest_seq, {_relevance('lower(title)')} AS is_relevant FROM raw_news"
)
ORACLE["risk_flags"] = f"WITH {RAW} SELECT ingest_seq, {_flags('lower(title)')} FROM raw_news"

ORACLE["keyword_match"] = f"""SELECT doc_id, lang,
  CASE WHEN {_any('lower(text)', DOCUMENT_KEYWORDS)} THEN 1 ELSE 0 END AS is_match
  FROM documents"""
ORACLE["word_match"] = """SELECT doc_id,
  CASE WHEN regexp_matches(lower(text), '\\bas\\b') THEN 1 ELSE 0 END AS has_as,
  CASE WHEN regexp_matches(lower(text), '\\bthe\\b') THEN 1 ELSE 0 END AS has_the
  FROM documents"""
ORACLE["keyword_filter"] = f"""SELECT lang, COUNT(*) AS documents FROM documents
  WHERE {_any('text', DOCUMENT_KEYWORDS)} GROUP BY lang"""
ORACLE["document_rule"] = f"""SELECT doc_id, {_relevance('t')} AS is_relevant,
  {_rule('t', DOCUMENT_RULE)} AS is_mixed, {_flags('t')}
  FROM (SELECT doc_id, lower(concat_ws(' ', text, {_headline('doc_id')})) AS t FROM documents)"""

ORACLE["daily_counts"] = f"WITH {_STG} {_counts('stg')}"
ORACLE["daily_mart"] = f"WITH {_STG_DAILY} SELECT * FROM daily"
ORACLE["weekly_mart"] = f"WITH {_STG_DAILY} {_rollup('week')} ORDER BY week_start"
ORACLE["monthly_mart"] = f"WITH {_STG_DAILY} {_rollup('month')} ORDER BY month_start"
ORACLE["weekly_from_percentages"] = ORACLE["weekly_mart"]
ORACLE["recovered_counts"] = f"""WITH {_STG_DAILY} SELECT published_date, {', '.join(
    f'CAST(ROUND(idx_{c} * total_articles / 100.0) AS BIGINT) AS count_{c}'
    for c in COMPONENTS)} FROM daily"""
ORACLE["audit_mart"] = f"""WITH {_STG} SELECT published_date, source, category, link, title,
  title_cleaned, {_flags('title_cleaned')} FROM stg WHERE is_relevant = 1
  ORDER BY published_date DESC, link"""

_NUMBERS = f"total_articles, {', '.join(f'idx_{c}' for c in COMPONENTS)}, total_index, CAST(NULL AS VARCHAR) AS link"
_FLAG_NUMBERS = ", ".join(f"CAST(is_{r.name} AS DOUBLE)" for r in RISK_RULES)


def _marts(staged: str, daily: str) -> str:
    return f"""SELECT 'daily' AS mart, CAST(published_date AS VARCHAR) AS key, {_NUMBERS} FROM {daily}
  UNION ALL SELECT 'weekly', CAST(week_start AS VARCHAR), {_NUMBERS} FROM ({_rollup('week')})
  UNION ALL SELECT 'monthly', CAST(month_start AS VARCHAR), {_NUMBERS} FROM ({_rollup('month')})
  UNION ALL SELECT 'audit', CAST(published_date AS VARCHAR), CAST(1 AS BIGINT), {_FLAG_NUMBERS},
    CAST(NULL AS DOUBLE), link FROM (SELECT *, {_flags('title_cleaned')} FROM {staged} WHERE is_relevant = 1)"""


ORACLE["mart_build"] = f"WITH {_STG_DAILY} {_marts('stg', 'daily')}"
ORACLE["mart_build_incremental"] = f"""WITH {RAW}, grown AS (
    SELECT * REPLACE (CASE WHEN published_date >= DATE '1998-01-01' THEN 'new/' || link ELSE link END AS link)
    FROM raw_news),
  {_staging('grown')}, {_daily()} {_marts('stg', 'daily')}"""
ORACLE["staging_view"] = f"""WITH {_STG} SELECT category, COUNT(*) AS articles,
  CAST(SUM(is_relevant) AS BIGINT) AS relevant FROM stg GROUP BY category"""

_HISTORY = "SELECT * FROM raw_news WHERE published_date < DATE '2001-01-01'"
_NOT_LATE = "SELECT * FROM raw_news WHERE source <> 'P'"


def _incremental(first_load: str) -> str:
    return f"""WITH {RAW}, loaded AS ({first_load}),
  {_staging('loaded', 'stg_old')}, {_daily('stg_old', 'old')},
  {_staging('raw_news')}, {_daily()},
  fresh AS (SELECT * FROM daily WHERE published_date >= (SELECT MAX(published_date) FROM old))
  SELECT * FROM fresh UNION ALL
  SELECT * FROM old WHERE published_date NOT IN (SELECT published_date FROM fresh)"""


ORACLE["incremental_daily"] = _incremental(_HISTORY)
ORACLE["incremental_late"] = _incremental(_NOT_LATE)
ORACLE["incremental_affected"] = ORACLE["daily_mart"]
ORACLE["mart_watermark"] = f"""WITH {_STG_DAILY}
  SELECT COALESCE(MAX(published_date), DATE '1970-01-01') AS watermark FROM daily"""

_EXPORT = f"""{_STG_DAILY},
  earlier AS ({_HISTORY} AND source <> 'P'),
  {_staging('earlier', 'stg_earlier')}, {_daily('stg_earlier', 'target')}"""
_MEASURES = [f"idx_{c}" for c in COMPONENTS] + list(COMPOSITES)
_ZEROED = ", ".join(f"COALESCE(d.{m}, 0) AS {m}" for m in _MEASURES)
_DCOUNTS = ", ".join(f"d.count_{c}" for c in COMPONENTS)
ORACLE["export_upsert"] = f"""WITH {_EXPORT}
  SELECT strftime(d.published_date, '%Y-%m-%d') AS published_date, d.total_articles,
    {_DCOUNTS}, {_ZEROED},
    CASE WHEN t.published_date IS NULL THEN 'append'
         WHEN t.total_articles <> d.total_articles THEN 'update' ELSE 'skip' END AS action
  FROM daily d LEFT JOIN target t USING (published_date) ORDER BY d.published_date"""
_PLAIN = ", ".join(f"t.{m}" for m in _MEASURES)
_TCOUNTS = ", ".join(f"t.count_{c}" for c in COMPONENTS)
ORACLE["export_snapshot"] = f"""WITH {_EXPORT}
  SELECT strftime(d.published_date, '%Y-%m-%d') AS published_date, d.total_articles,
    {_DCOUNTS}, {_ZEROED}
  FROM daily d LEFT JOIN target t USING (published_date)
  WHERE t.published_date IS NULL OR t.total_articles <> d.total_articles
  UNION ALL
  SELECT strftime(t.published_date, '%Y-%m-%d'), t.total_articles, {_TCOUNTS}, {_PLAIN}
  FROM target t LEFT JOIN daily d USING (published_date)
  WHERE d.published_date IS NULL OR t.total_articles = d.total_articles"""
ORACLE["export_rows_addressed"] = f"""WITH {_EXPORT},
  first AS (SELECT published_date, total_articles, date_diff('day', DATE '1992-01-01', published_date) * 2 AS sheet_row FROM target),
  sheet AS (SELECT * FROM first UNION ALL SELECT published_date, 7, sheet_row + 1 FROM first WHERE sheet_row % 3 = 0),
  last AS (SELECT published_date, arg_max(total_articles, sheet_row) AS total_articles, CAST(max(sheet_row) AS BIGINT) AS target_row
           FROM sheet GROUP BY 1)
  SELECT strftime(d.published_date, '%Y-%m-%d') AS published_date, d.total_articles, t.target_row,
    CASE WHEN t.published_date IS NULL THEN 'append'
         WHEN t.total_articles <> d.total_articles THEN 'update' ELSE 'skip' END AS action
  FROM daily d LEFT JOIN last t USING (published_date)"""
ORACLE["stringify_dates"] = f"""WITH {_STG_DAILY}, weekly AS ({_rollup('week')})
  SELECT * REPLACE (strftime(week_start, '%Y-%m-%d') AS week_start,
    strftime(first_day_in_week, '%Y-%m-%d') AS first_day_in_week,
    strftime(last_day_in_week, '%Y-%m-%d') AS last_day_in_week) FROM weekly"""
ORACLE["exported_rows"] = f"""WITH {_STG_DAILY}
  SELECT strftime(d.published_date, '%Y-%m-%d') AS published_date, d.total_articles,
    {_DCOUNTS}, {_ZEROED} FROM daily d ORDER BY 1"""

ORACLE["ingest_anti_join"] = """
  SELECT o_orderkey AS ingest_seq, CAST(o_orderdate AS DATE) AS published_date,
         'https://news.example/' || (o_custkey % 50) AS link
  FROM orders o WHERE NOT EXISTS (
    SELECT 1 FROM lineitem l WHERE CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE)
      AND l.l_suppkey % 50 = o.o_custkey % 50)"""
_FIELDS = "title, link, category, date_text, source, published_date"
ORACLE["ingest_articles"] = f"WITH {EVENTS} SELECT {_FIELDS} FROM event_articles"
ORACLE["stream_ingest"] = ORACLE["ingest_articles"]
ORACLE["landing_overwrite"] = f"""WITH {EVENTS}, kept AS (
    SELECT * FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY link ORDER BY ingest_seq DESC) AS rn
      FROM event_articles) WHERE rn = 1)
  SELECT {_FIELDS} FROM kept
  UNION ALL SELECT {_FIELDS} FROM event_articles
  WHERE published_date NOT IN (SELECT published_date FROM kept)"""
ORACLE["landing_round_trip"] = f"""WITH {EVENTS} SELECT 'all' AS scope, {_FIELDS} FROM event_articles
  UNION ALL SELECT 'day', {_FIELDS} FROM event_articles
  WHERE published_date = (SELECT MIN(published_date) FROM event_articles)"""
ORACLE["array_files"] = f"""WITH {EVENTS}, tricky AS (
    SELECT CASE WHEN ingest_seq % 5 = 0 THEN title || '{TRICKY}' ELSE title END AS title,
           link, category, date_text, source, ingest_seq, published_date FROM event_articles)
  SELECT {_FIELDS},
         CAST(ROW_NUMBER() OVER (PARTITION BY published_date ORDER BY ingest_seq) AS BIGINT) AS place
  FROM tricky"""
ORACLE["stamp_files"] = f"""WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS link, o_orderkey % 3 AS k,
    strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
  SELECT link, CASE WHEN k = 2 THEN DATE '{FETCHED}' - 1 ELSE CAST(d AS DATE) END AS published_date,
    CASE k WHEN 0 THEN d || '|/in/scrape_' || d || '.json'
           WHEN 1 THEN 'part-0.json|/in/published_date=' || d || '/part-0.json'
           ELSE 'part-0.json|/in/part-0.json' END AS load_key FROM f"""
ORACLE["bronze_catalog"] = f"WITH {EVENTS} SELECT {_RAW_COLUMNS} FROM event_articles"
ORACLE["bronze_append"] = f"""WITH {EVENTS} SELECT title, link, CAST(NULL AS VARCHAR) AS category,
  date_text, source, ingest_seq, published_date FROM event_articles"""

_SOURCES = """sources AS (
  SELECT c_name AS title, 'https://customer.example/' || c_custkey AS link,
         c_mktsegment AS category, 'kemarin' AS date_text, 'customer' AS source FROM customer
  UNION ALL
  SELECT s_name, 'https://supplier.example/' || s_suppkey, CAST(s_nationkey AS VARCHAR),
         'kemarin', 'supplier' FROM supplier
  UNION ALL
  SELECT p_name, 'https://part.example/' || p_partkey, p_brand, 'kemarin', 'part' FROM part)"""
ORACLE["union_sources"] = f"WITH {_SOURCES} SELECT * FROM sources"
ORACLE["scrape_stats"] = f"""WITH {_SOURCES}
  SELECT source, category, 2 AS level, COUNT(*) AS articles FROM sources GROUP BY 1, 2
  UNION ALL SELECT source, NULL, 1, COUNT(*) FROM sources GROUP BY 1
  UNION ALL SELECT NULL, NULL, 0, COUNT(*) FROM sources"""

_MONTH_LIST = "[" + ", ".join(_text(m.title()) for m in INDONESIAN_MONTHS) + "]"
ORACLE["parse_relative_date"] = f"""SELECT o_orderkey,
  CASE o_orderpriority
    WHEN '1-URGENT' THEN DATE '{FETCHED}'
    WHEN '2-HIGH' THEN DATE '{FETCHED}' - 1
    WHEN '3-MEDIUM' THEN CAST(o_orderdate AS DATE)
    WHEN '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE)
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) END
  END AS parsed FROM orders"""
ORACLE["parse_long_date"] = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) END AS parsed FROM orders"
)
ORACLE["parse_iso_date"] = """SELECT event_id,
  CASE WHEN event_type <> 'purchase' THEN CAST(ts AS DATE) END AS parsed FROM events"""


def _titled(expression: str) -> str:
    return (
        "array_to_string(list_transform(regexp_extract_all("
        f"{expression}, '[a-zA-Z]+|[^a-zA-Z]+'), "
        "lambda w: upper(w[1:1]) || lower(w[2:])), '')"
    )


ORACLE["slug_title"] = f"""SELECT p_partkey, {_titled('lower(p_name)')} AS title FROM part"""
_SLUG = (
    "replace(replace(regexp_replace(regexp_extract(regexp_replace("
    "split_part(url, '?', 1), '/+$', ''), '[^/]*$'), '-[0-9]+$', ''), '.html', ''), '-', ' ')"
)
ORACLE["page_slugs"] = f"SELECT page_id, {_titled(_SLUG)} AS title FROM pages"

_LISTING = f"""page AS (
  SELECT c_custkey AS page_id, c_custkey AS k, c_name AS name, c_mktsegment AS category,
         CAST(DATE '{FETCHED}' - CAST(c_custkey % 700 AS INTEGER) AS DATE) AS day
  FROM customer),
texts AS (
  SELECT *, day - 1 AS target, {', '.join(
      f"day(day - {n}) || ' ' || list_extract({_MONTH_LIST}, month(day - {n})) || ' ' "
      f"|| year(day - {n}) AS d{n}" for n in range(3))}
  FROM page),
items AS (
  SELECT page_id, 0 AS pos, name || ' & 1' AS title, 'https://news.example/' || k || '/1' AS link,
    category, '9 menit lalu' AS date_text, 'post_rows' AS source, day AS article_date,
    'other_date' AS reason FROM texts
  UNION ALL SELECT page_id, 1, name || ' & 2', 'https://news.example/' || k || '/2', category,
    'Kemarin 15:37', 'post_rows', day - 1, NULL FROM texts
  UNION ALL SELECT page_id, 2, name || ' & 3', 'https://news.example/' || k || '/3', category,
    d1, 'post_rows', day - 1, NULL FROM texts
  UNION ALL SELECT page_id, 3, name || ' & 4', 'https://news.example/' || k || '/4', category,
    'entah kapan', 'post_rows', NULL, 'bad_date' FROM texts
  UNION ALL SELECT page_id, 4, NULL, '', category, NULL, 'post_rows', NULL, 'missing_title'
    FROM texts
  UNION ALL SELECT page_id, 0, name || ' 1', 'https://news.example/' || k, category,
    strftime(target, '%Y-%m-%d'), 'media_list', target, NULL FROM texts
  UNION ALL SELECT page_id, 1, name || ' 2', '', category, strftime(target, '%Y-%m-%d'),
    'media_list', target, 'missing_link' FROM texts WHERE page_id % 2 = 0
  UNION ALL SELECT page_id, 0, name, 'https://news.example/' || k || '/a', category, d0,
    'linked_cards', NULL, NULL FROM texts
  UNION ALL SELECT page_id, 1, name, 'https://news.example/' || k || '/b', category,
    'Date not available', 'linked_cards', NULL, NULL FROM texts
  UNION ALL SELECT page_id, 2, name, NULL, category, 'Date not available', 'linked_cards',
    NULL, 'missing_link' FROM texts
  UNION ALL SELECT page_id, 0, name || ' 1', 'https://news.example/' || k || '/1', category,
    'Sabtu, ' || d0 || ' 10:37 WIB', 'dated_index', day, 'other_date' FROM texts
  UNION ALL SELECT page_id, 1, name || ' 2', 'https://news.example/' || k || '/2', category,
    'Sabtu, ' || d1 || ' 10:37 WIB', 'dated_index', day - 1, NULL FROM texts
  UNION ALL SELECT page_id, 2, name || ' 3', NULL, category,
    'Sabtu, ' || d1 || ' 10:37 WIB', 'dated_index', day - 1, 'missing_link' FROM texts
  UNION ALL SELECT page_id, 3, name || ' 4', 'https://news.example/' || k || '/4', category,
    'Sabtu, ' || d2 || ' 10:37 WIB', 'dated_index', day - 2, 'after_cut' FROM texts
  UNION ALL SELECT page_id, 4, name || ' 5', 'https://news.example/' || k || '/5', category,
    'Sabtu, ' || d1 || ' 10:37 WIB', 'dated_index', day - 1, 'after_cut' FROM texts)"""
ORACLE["extract_listing"] = f"""WITH {_LISTING}
  SELECT page_id, pos, title, link, category, date_text, source, article_date
  FROM items WHERE reason IS NULL"""
ORACLE["extract_rejects"] = f"""WITH {_LISTING} SELECT source, page_id, pos, reason FROM items
  WHERE reason IN ('missing_title', 'missing_date', 'bad_date', 'missing_link')"""
ORACLE["extract_pages"] = f"""WITH {_LISTING}
  SELECT source, page_id, source = 'media_list' AND page_id % 2 = 0 AS has_more,
    MIN(article_date) AS oldest_date, COUNT(article_date) > 0 AS found_any,
    source = 'dated_index' AS stopped
  FROM items GROUP BY source, page_id"""
ORACLE["page_stats"] = f"""WITH {_LISTING}
  SELECT source, page_id, COUNT(*) AS items, MIN(article_date) AS oldest_date
  FROM items GROUP BY source, page_id"""
ORACLE["extract_navigation"] = """
  SELECT page_id, CAST(unnest(range(len(titles))) AS INTEGER) AS pos,
         unnest(titles) AS title, unnest(links) AS link
  FROM (SELECT page_id,
          regexp_extract_all(nav, '<li><a href="[^"]*">([^<]*)</a>', 1) AS titles,
          regexp_extract_all(nav, '<li><a href="([^"]*)">', 1) AS links
        FROM (SELECT page_id, regexp_extract(html, '<nav>.*?</nav>', 0, 's') AS nav
              FROM pages))"""
ORACLE["extract_sitemap"] = """
  WITH o AS (SELECT o_orderkey AS k, o_orderpriority AS category,
                    strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders)
  SELECT k AS doc_id, 'Harga Emas Naik 2026' AS title,
    'https://news.example/politik/harga-emas-naik-2026-' || k || '?ref=' || k AS link,
    category, d AS date_text FROM o
  UNION ALL
  SELECT k, 'Judul ' || k || ' & lain', 'https://news.example/' || k, category, d FROM o"""
ORACLE["sitemap_files"] = """
  WITH o AS (SELECT CAST(o_orderkey AS VARCHAR) AS k, strftime(o_orderdate, '%Y-%m-%d') AS d,
                    strftime(CAST(o_orderdate AS DATE) - 1, '%Y-%m-%d') AS old FROM orders)
  SELECT 'https://news.example/politik/harga-emas-naik-2026-' || k || '?ref=' || k AS loc, d AS day,
         CAST(NULL AS VARCHAR) AS news_title, CAST(NULL AS VARCHAR) AS reason FROM o
  UNION ALL SELECT 'https://news.example/' || k, d, 'Judul ' || k || ' & lain', NULL FROM o
  UNION ALL SELECT 'https://news.example/lama-' || k, old, NULL, NULL FROM o
  UNION ALL SELECT NULL, d, NULL, 'missing_link' FROM o"""
ORACLE["sitemap_rejects"] = """WITH o AS (SELECT o_orderkey AS k FROM orders),
  whole AS (SELECT k FROM o WHERE k % 5 <> 0)
  SELECT k AS doc_id, 'article' AS outcome, 'https://n.example/a?x=1&y=' || k AS link FROM whole
  UNION ALL SELECT k, 'article', 'https://n.example/b/' || k FROM whole
  UNION ALL SELECT k, unnest(['missing_link', 'bad_date', 'unreadable_entry']), NULL FROM whole
  UNION ALL SELECT k, 'unreadable_document', NULL FROM o WHERE k % 5 = 0"""
ORACLE["prefix_cut"] = """
  SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS article_date
  FROM (SELECT *, MAX(CASE WHEN o_orderdate < DATE '1996-01-01' THEN 1 ELSE 0 END)
          OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS stopped FROM orders)
  WHERE stopped = 0"""

ORACLE["dq_checks"] = f"""WITH {_STG_DAILY}, c AS (
  SELECT 'unique' AS "check", 'published_date' AS "column", (SELECT COUNT(*) FROM (
      SELECT published_date FROM daily WHERE published_date IS NOT NULL
      GROUP BY 1 HAVING COUNT(*) > 1)) AS failing_rows
  UNION ALL SELECT 'not_null', 'published_date', COUNT(*) FROM daily WHERE published_date IS NULL
  UNION ALL SELECT 'not_null', 'total_articles', COUNT(*) FROM daily WHERE total_articles IS NULL
  UNION ALL SELECT 'not_null', 'total_index', COUNT(*) FROM daily WHERE total_index IS NULL
  UNION ALL SELECT 'accepted_range', 'total_articles', COUNT(*) FROM daily
    WHERE total_articles < 1
  UNION ALL SELECT 'accepted_range', 'total_index', COUNT(*) FROM daily WHERE total_index < 0)
  SELECT *, failing_rows = 0 AS passed FROM c"""
_REQUIRED = " ".join(
    f"UNION ALL SELECT 'required', '{c}', COUNT(*) FROM raw_news "
    f"WHERE {c} IS NULL OR trim({c}) = ''"
    for c in ("title", "link", "category", "date_text", "source")
)
ORACLE["dq_articles"] = f"""WITH {RAW}, c AS (
  SELECT 'not_empty' AS "check", '*' AS "column",
         CAST(CASE WHEN COUNT(*) = 0 THEN 1 ELSE 0 END AS BIGINT) AS failing_rows FROM raw_news
  {_REQUIRED}
  UNION ALL SELECT 'accepted_values', 'source', COUNT(*) FROM raw_news
    WHERE source IS NULL OR source NOT IN ('F', 'O')
  UNION ALL SELECT 'absolute_link', 'link', COUNT(*) FROM raw_news
    WHERE link IS NULL OR NOT regexp_matches(link, '^https?://'))
  SELECT *, failing_rows = 0 AS passed FROM c"""
