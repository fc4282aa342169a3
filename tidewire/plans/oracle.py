"""The registered queries as SQL text for DuckDB, written independently of the DataFrame code."""

from __future__ import annotations

from ..functions.words import BASE_STOPWORDS, NEWS_STOPWORDS, stopwords
from .bindings import PAGE_SIZE

ORACLE: dict[str, str] = {}


def _words(stop: list[str]) -> str:
    return ", ".join("'" + word.replace("'", "''") + "'" for word in stop)


STOP = _words(stopwords())
NEWS_STOP = _words(stopwords(BASE_STOPWORDS, NEWS_STOPWORDS))

INCIDENTS = """
incidents AS (
  SELECT o_orderkey AS eventid,
         CAST(year(o_orderdate) AS INTEGER) AS iyear,
         CAST(month(o_orderdate) AS INTEGER) AS imonth,
         CAST(day(o_orderdate) AS INTEGER) AS iday,
         CASE WHEN o_orderkey % 29 <> 0 THEN n_name END AS country_txt,
         CASE WHEN o_orderkey % 19 <> 0 THEN r_name END AS region_txt,
         concat('P', c_nationkey) AS provstate,
         c_name AS city,
         CASE WHEN o_orderkey % 50 <> 0 THEN round(((o_orderkey * 7919) % 18001) / 1e2 - 90, 2) END AS latitude,
         CASE WHEN o_orderkey % 50 <> 0 THEN round(((o_orderkey * 104729) % 36001) / 1e2 - 180, 2) END AS longitude,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_orderpriority END AS attacktype1_txt,
         CASE WHEN o_orderkey % 23 <> 0 THEN c_mktsegment END AS targtype1_txt,
         o_orderstatus AS weaptype1_txt,
         CASE WHEN o_custkey % 37 = 0 THEN NULL WHEN o_custkey % 10 = 0 THEN 'Unknown'
              WHEN o_custkey % 7 = 0 THEN 'O''Neil' ELSE concat('G', o_custkey % 200) END AS gname,
         CASE WHEN o_orderkey % 11 <> 0 THEN CAST(floor(o_totalprice / 50000) AS INTEGER) END AS nkill,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(floor(o_totalprice / 20000) AS INTEGER) END AS nwound,
         CAST(o_orderkey % 2 AS INTEGER) AS success,
         CAST(o_orderkey % 3 = 0 AS INTEGER) AS suicide,
         CAST(o_orderkey % 5 = 0 AS INTEGER) AS multiple,
         CAST(o_orderkey % 7 = 0 AS INTEGER) AS individual,
         d.text AS summary
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN documents d ON d.doc_id = o_orderkey
),
clean AS (
  SELECT * EXCLUDE (multiple, individual) FROM incidents WHERE latitude IS NOT NULL AND longitude IS NOT NULL
)"""

# Whole numbers that went through text with a fraction of one half round away from zero.
RAW = (
    INCIDENTS
    + """,
raw AS (
  SELECT CAST(eventid AS VARCHAR) AS eventid,
         CAST(iyear AS VARCHAR) || CASE WHEN eventid % 6 = 0 THEN 'e0' ELSE '' END AS iyear,
         CAST(imonth AS VARCHAR) AS imonth, CAST(iday AS VARCHAR) AS iday,
         country_txt, region_txt, provstate, city,
         latitude, longitude, attacktype1_txt, targtype1_txt, weaptype1_txt, gname,
         CAST(nkill AS VARCHAR) || '.0' AS nkill,
         CAST(nwound AS VARCHAR) || CASE WHEN eventid % 4 = 0 THEN '.5' ELSE '' END AS nwound,
         CAST(success AS VARCHAR) AS success, CAST(suicide AS VARCHAR) AS suicide,
         CAST(multiple AS VARCHAR) AS multiple, CAST(individual AS VARCHAR) AS individual, summary
  FROM incidents
)"""
)

ARTICLES = """
articles_in AS (
  SELECT doc_id AS off,
         CASE WHEN doc_id % 41 <> 0 THEN text END AS title,
         CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 5 = 1 THEN ''
              WHEN doc_id % 7 = 0 THEN 'http://news.example/front'
              ELSE concat('http://news.example/', doc_id // 4) END AS url,
         CASE WHEN doc_id % 29 <> 0
              THEN TIMESTAMP '2025-01-01 00:00:00' + n_chars * INTERVAL '1' MINUTE END AS published_at,
         CASE WHEN doc_id % 23 <> 0 THEN CASE WHEN doc_id % 7 = 3 THEN source || ' wire' ELSE source END END
           AS source_name,
         CASE WHEN doc_id % 3 <> 0 THEN concat('author ', lang) END AS author,
         concat(lang, ' ', n_chars) AS description,
         text AS content
  FROM documents
)"""

_ISO = "strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')"


def _message(source: str) -> str:
    """The JSON text of an article."""
    fields = {"title": "title", "url": "url", "publishedAt": _ISO, "source": None, "author": "author",
              "description": "description", "content": "content"}
    quoted = {name: source if sql is None else f"coalesce(CAST(to_json({sql}) AS VARCHAR), 'null')"
              for name, sql in fields.items()}
    return "'{' || " + " || ',' || ".join(f"""'"{name}":' || {sql}""" for name, sql in quoted.items()) + " || '}'"


_SOURCE = """'{"name":' || coalesce(CAST(to_json(source_name) AS VARCHAR), 'null') || '}'"""

# Messages that survive decoding: damaged JSON and damaged times are gone, a plain-text source has no name.
ACCEPTED = (
    ARTICLES
    + f""",
accepted AS (
  SELECT * REPLACE (CASE WHEN off % 13 <> 0 THEN source_name END AS source_name),
         CASE WHEN off % 13 <> 0 THEN {_message(_SOURCE)}
              ELSE {_message("""'"a plain string"'""")} END AS raw_json
  FROM articles_in WHERE off % 17 <> 0 AND off % 19 <> 0
)"""
)

FIELDS = "off, title, url, published_at, source_name, author, description, content"
MIDDLE = "(SELECT (max(off) + 1) // 2 FROM articles_in)"


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


def _incidents(name: str, select: str) -> None:
    ORACLE[name] = _with(INCIDENTS, select)


def _articles(name: str, select: str) -> None:
    ORACLE[name] = _with(ARTICLES, select)


def _deduped(name: str, batch: str, stored: str) -> str:
    """CTEs that hold the rows of ``batch`` to store, given the rows already in ``stored``."""
    return f"""
{name}_url AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY off) AS rn FROM {batch} WHERE coalesce(url, '') <> ''
  ) AS ranked
  WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM {stored} s WHERE s.url = ranked.url)
),
{name}_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY title, published_at ORDER BY off) AS rn
  FROM (SELECT * FROM {name}_url UNION ALL SELECT * FROM {batch} WHERE coalesce(url, '') = '')
),
{name} AS (
  SELECT * EXCLUDE (rn) FROM {name}_ranked r
  WHERE coalesce(url, '') <> '' OR title IS NULL OR published_at IS NULL
     OR (rn = 1 AND NOT EXISTS (
           SELECT 1 FROM {stored} s WHERE s.title = r.title AND s.published_at = r.published_at))
)"""


# Sources, sinks, cleaning

ORACLE["csv_roundtrip_load"] = _with(
    RAW,
    """SELECT * REPLACE (CAST(latitude AS VARCHAR) AS latitude, CAST(longitude AS VARCHAR) AS longitude) FROM raw""",
)
ORACLE["clean_incidents"] = _with(
    RAW,
    """
SELECT CAST(eventid AS BIGINT) AS eventid, CAST(iyear AS INTEGER) AS iyear, CAST(imonth AS INTEGER) AS imonth,
       CAST(iday AS INTEGER) AS iday, country_txt, region_txt, provstate, city, latitude, longitude,
       attacktype1_txt, targtype1_txt, weaptype1_txt, gname, CAST(nkill AS INTEGER) AS nkill,
       CAST(nwound AS INTEGER) AS nwound, CAST(success AS INTEGER) AS success, CAST(suicide AS INTEGER) AS suicide,
       summary
FROM raw WHERE latitude IS NOT NULL AND longitude IS NOT NULL""",
)
_incidents(
    "load_clean_report",
    """SELECT 'raw' AS stage, count(*) AS rows FROM incidents UNION ALL SELECT 'clean', count(*) FROM clean""",
)
_articles("articles_scan", f"SELECT {FIELDS}, {_message(_SOURCE)} AS raw_json FROM articles_in")
_articles("articles_count", "SELECT count(*) AS articles FROM articles_in")
_articles(
    "decode_articles",
    f"""SELECT a.off, d.off IS NOT NULL AS decoded, d.title, d.url, d.publishedAt, d.author, d.description, d.content
        FROM articles_in a LEFT JOIN (
          SELECT *, CASE WHEN off % 19 = 0 THEN 'notadate' ELSE {_ISO} END AS publishedAt
          FROM articles_in WHERE off % 17 <> 0) d ON a.off = d.off""",
)
ORACLE["extract_article_fields"] = _with(ACCEPTED, f"SELECT {FIELDS}, raw_json FROM accepted")
_articles(
    "quarantine_bad_articles",
    """SELECT off, CASE WHEN off % 17 = 0 THEN 'invalid json' ELSE 'bad timestamp' END AS reject_reason
       FROM articles_in WHERE off % 17 = 0 OR off % 19 = 0""",
)
_articles(
    "response_pages_explode",
    f"""SELECT off // {PAGE_SIZE} AS page, title, url, published_at, source_name FROM articles_in
        WHERE (off // {PAGE_SIZE}) % 7 <> 3 AND (off // {PAGE_SIZE}) % 11 <> 5""",
)
_articles(
    "response_pages_rejected",
    f"""SELECT DISTINCT off // {PAGE_SIZE} AS page, 'error' AS status, 'rate limited' AS message FROM articles_in
        WHERE (off // {PAGE_SIZE}) % 7 = 3""",
)
_articles(
    "article_messages",
    """SELECT off, url AS key, title, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_text, source_name,
              author IS NULL AS null_author_kept FROM articles_in""",
)
_articles(
    "article_dedupe_key",
    """SELECT off, CASE WHEN coalesce(url, '') <> '' THEN url
              ELSE coalesce(title, 'None') || '|'
                   || coalesce(strftime(published_at, '%Y-%m-%dT%H:%M:%SZ'), 'None') END AS dedupe_key
       FROM articles_in""",
)

# De-duplication and streaming

_articles(
    "anti_join_url",
    f"""SELECT {FIELDS} FROM articles_in a WHERE off >= {MIDDLE} AND coalesce(url, '') <> ''
        AND NOT EXISTS (SELECT 1 FROM articles_in s WHERE s.off < {MIDDLE} AND s.url = a.url)""",
)
_articles(
    "anti_join_title_time",
    f"""SELECT {FIELDS} FROM articles_in a WHERE off >= {MIDDLE} AND coalesce(url, '') = ''
        AND NOT EXISTS (SELECT 1 FROM articles_in s
                        WHERE s.off < {MIDDLE} AND s.title = a.title AND s.published_at = a.published_at)""",
)
_NOTHING = "nothing AS (SELECT * FROM articles_in WHERE false)"
ORACLE["dedupe_articles"] = _with(
    f"{ARTICLES}, {_NOTHING}, {_deduped('kept', 'articles_in', 'nothing')}", f"SELECT {FIELDS} FROM kept"
)
ORACLE["dedupe_articles_incremental"] = _with(
    f"""{ARTICLES}, {_NOTHING},
    older AS (SELECT * FROM articles_in WHERE off < {MIDDLE}),
    newer AS (SELECT * FROM articles_in WHERE off >= {MIDDLE}),
    {_deduped('stored', 'older', 'nothing')}, {_deduped('kept', 'newer', 'stored')}""",
    f"SELECT {FIELDS} FROM kept",
)
_STORED = f"{ACCEPTED}, {_NOTHING}, {_deduped('kept', 'accepted', 'nothing')}"
_STORED_COLUMNS = "title, url, published_at, source_name, author, description, content, raw_json"
for _name in ("stream_ingest_articles", "stream_compacted_articles", "stream_ingest_after_crash",
              "stream_first_articles"):
    ORACLE[_name] = _with(_STORED, f"SELECT {_STORED_COLUMNS} FROM kept")
# What has no key is read again and stored again.
ORACLE["stream_ingest_new_checkpoint"] = _with(
    _STORED,
    f"""SELECT {_STORED_COLUMNS} FROM kept UNION ALL SELECT {_STORED_COLUMNS} FROM accepted
        WHERE off < {MIDDLE} AND coalesce(url, '') = '' AND (title IS NULL OR published_at IS NULL)""",
)
_COUNTS = """count(*) AS arrived, count(*) FILTER (WHERE NOT ok) AS rejected, count(*) FILTER (WHERE held) AS stored,
  count(*) FILTER (WHERE ok AND NOT held) AS duplicates
FROM (SELECT off, off % 17 <> 0 AND off % 19 <> 0 AS ok, off IN (SELECT off FROM kept) AS held FROM articles_in)"""
ORACLE["stream_batch_counts"] = _with(
    _STORED, f"SELECT CAST(off >= {MIDDLE} AS BIGINT) AS batch_id, {_COUNTS} GROUP BY 1"
)
ORACLE["stream_reported_counts"] = _with(_STORED, f"SELECT {_COUNTS}")
ORACLE["stream_ingest_small_batches"] = _with(
    ACCEPTED, "SELECT url, count(DISTINCT url) AS copies FROM accepted WHERE coalesce(url, '') <> '' GROUP BY url"
)
ORACLE["stream_recent_articles"] = _with(
    ACCEPTED, "SELECT DISTINCT url FROM accepted WHERE coalesce(url, '') <> '' AND published_at IS NOT NULL"
)
ORACLE["quarantined_stream_messages"] = ORACLE["quarantine_bad_articles"]

# Sinks

_incidents(
    "sink_raw_and_clean",
    """SELECT iyear, count(*) AS rows, CAST(sum(eventid) AS BIGINT) AS ids,
              CAST(sum(length(summary)) AS BIGINT) AS summary_chars,
              (SELECT count(*) FROM incidents) AS raw_rows, (SELECT count(*) FROM clean) AS clean_rows
       FROM clean GROUP BY iyear""",
)
_incidents(
    "sink_exported_views",
    "SELECT region_txt AS region, count(*) AS count, 'broken' AS failed FROM clean GROUP BY region_txt",
)

# Filters and projections

_FILTERED = """WHERE iyear BETWEEN 1996 AND 1999 AND region_txt = 'ASIA' AND attacktype1_txt = '2-HIGH'"""
_SHOWN = "iyear, country_txt, region_txt, city, latitude, longitude, attacktype1_txt, targtype1_txt, gname, nkill, nwound"
_incidents("filtered_incidents", f"SELECT {_SHOWN}, summary FROM clean {_FILTERED}")
_incidents("filtered_incidents_quote", f"SELECT {_SHOWN}, summary FROM clean WHERE gname = 'O''Neil'")
_incidents(
    "null_filled_incidents",
    """SELECT eventid, iyear, CAST(iyear AS VARCHAR) AS iyear_str, coalesce(nkill, 1) AS nkill_size,
              coalesce(nkill, 0) AS nkill, coalesce(nwound, 0) AS nwound FROM clean""",
)
_incidents(
    "locations_limit",
    """SELECT latitude, longitude FROM clean ORDER BY md5(CAST(eventid AS VARCHAR) || '|0'), eventid LIMIT 1000""",
)
_incidents(
    "nonnull_texts_limit",
    """SELECT eventid, summary FROM clean WHERE summary IS NOT NULL
       ORDER BY md5(CAST(eventid AS VARCHAR) || '|0'), eventid LIMIT 150""",
)
_incidents("year_bounds", "SELECT min(iyear) AS min_year, max(iyear) AS max_year FROM clean")
for _name, _col, _where in [
    ("region", "region_txt", ""),
    ("country_in_region", "country_txt", "WHERE region_txt = 'ASIA'"),
    ("attack", "attacktype1_txt", ""),
    ("group", "gname", ""),
]:
    _incidents(
        f"filter_options_{_name}",
        f"""SELECT 0 AS ordinal, 'All' AS option UNION ALL
            SELECT DISTINCT 1 AS ordinal, {_col} AS option FROM clean {_where}""",
    )

# Aggregations

_incidents("incidents_per_year", "SELECT iyear, count(*) AS count FROM clean GROUP BY iyear ORDER BY iyear")
_incidents(
    "fatalities_per_year",
    "SELECT iyear, CAST(sum(coalesce(nkill, 0)) AS BIGINT) AS fatalities FROM clean GROUP BY iyear ORDER BY iyear",
)
for _name, _col, _as, _where in [
    ("attack_type_counts", "attacktype1_txt", "attack", ""),
    ("attack_type_counts_nonnull", "attacktype1_txt", "attack", "WHERE attacktype1_txt IS NOT NULL"),
    ("region_counts", "region_txt", "region", ""),
    ("region_counts_nonnull", "region_txt", "region", "WHERE region_txt IS NOT NULL"),
    ("country_counts", "country_txt", "country", "WHERE country_txt IS NOT NULL"),
]:
    _incidents(
        _name, f"SELECT {_col} AS {_as}, count(*) AS count FROM clean {_where} GROUP BY {_col} ORDER BY count DESC"
    )
_incidents(
    "attack_target_counts",
    """SELECT attacktype1_txt AS attack, targtype1_txt AS target, count(*) AS count FROM clean GROUP BY 1, 2""",
)
# The market segments of the test tables.
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_incidents(
    "attack_target_matrix",
    "SELECT attacktype1_txt, "
    + ", ".join(f"count(*) FILTER (WHERE targtype1_txt = '{s}') AS \"{s}\"" for s in _SEGMENTS)
    + " FROM clean WHERE attacktype1_txt IS NOT NULL AND targtype1_txt IS NOT NULL GROUP BY 1",
)
_incidents(
    "attack_target_matrix_all",
    "SELECT attacktype1_txt, count(*) FILTER (WHERE targtype1_txt IS NULL) AS \"(none)\", "
    + ", ".join(f"count(*) FILTER (WHERE targtype1_txt = '{s}') AS \"{s}\"" for s in _SEGMENTS)
    + " FROM clean GROUP BY 1",
)
_TREND = """SELECT iyear, attacktype1_txt AS attack, count(*) AS incidents,
                   CAST(sum(coalesce(nkill, 0)) AS BIGINT) AS fatalities"""
_incidents(
    "attack_year_trend",
    f"SELECT *, CAST(fatalities AS DOUBLE) * 0.5e0 AS bubble_size FROM ({_TREND} FROM clean GROUP BY 1, 2)",
)
_incidents("attack_year_trend_nonnull", f"{_TREND} FROM clean WHERE attacktype1_txt IS NOT NULL GROUP BY 1, 2")
_KPIS = """SELECT count(*) AS total_incidents, CAST(coalesce(sum(nkill), 0) AS BIGINT) AS total_fatalities,
                  CAST(coalesce(sum(nwound), 0) AS BIGINT) AS total_injuries FROM clean"""
_incidents("kpi_totals", f"{_KPIS} {_FILTERED}")
_incidents("kpi_totals_empty", f"{_KPIS} WHERE gname = 'no such group'")
_incidents(
    "top_countries",
    """SELECT country_txt AS country, count(*) AS count FROM clean GROUP BY 1
       ORDER BY count DESC, country NULLS LAST LIMIT 15""",
)
_incidents(
    "deadliest_groups",
    """SELECT gname AS group_name, CAST(sum(coalesce(nkill, 0)) AS BIGINT) AS kills FROM clean
       WHERE gname <> 'Unknown' GROUP BY 1 ORDER BY kills DESC, group_name LIMIT 15""",
)
_incidents(
    "sample_subset",
    """SELECT * FROM clean ORDER BY md5(CAST(eventid AS VARCHAR) || '|42'), eventid LIMIT 1000""",
)
_articles(
    "latest_articles",
    "SELECT title, published_at FROM articles_in ORDER BY published_at DESC NULLS LAST, off LIMIT 10",
)
_articles(
    "top_sources",
    """SELECT source_name, count(*) AS count FROM articles_in WHERE source_name IS NOT NULL
       GROUP BY 1 ORDER BY count DESC, source_name LIMIT 20""",
)

# Frames

_incidents(
    "cumulative_frames",
    """SELECT c.* REPLACE (coalesce(nkill, 0) AS nkill, coalesce(nwound, 0) AS nwound),
              coalesce(nkill, 1) AS nkill_size, CAST(f.iyear AS VARCHAR) AS iyear_str
       FROM clean c JOIN (SELECT DISTINCT iyear FROM clean) f ON c.iyear <= f.iyear""",
)
_incidents(
    "cumulative_year_counts",
    """SELECT c.iyear, c.count, CAST(c.iyear AS VARCHAR) AS iyear_str, CAST(f.iyear AS VARCHAR) AS frame_year
       FROM (SELECT iyear, count(*) AS count FROM clean GROUP BY 1) c
       JOIN (SELECT DISTINCT iyear FROM clean) f ON c.iyear <= f.iyear""",
)

# Text

TOKENS = (
    ARTICLES
    + f""",
exploded AS (
  SELECT off, source_name,
         trim(unnest(regexp_split_to_array(
           regexp_replace(lower(title), '[^\\p{{L}}\\p{{N}}_\\s'']', ' ', 'g'), '\\s+')), '''') AS token
  FROM articles_in WHERE title IS NOT NULL
),
tokens AS (
  SELECT * FROM exploded
  WHERE length(token) > 2 AND regexp_full_match(token, '\\p{{L}}+') AND token NOT IN ({NEWS_STOP})
)"""
)


def _keywords(n_sources: int) -> str:
    return (
        TOKENS
        + f""",
top_sources AS (
  SELECT source_name FROM articles_in WHERE source_name IS NOT NULL
  GROUP BY 1 ORDER BY count(*) DESC, source_name LIMIT {n_sources}
),
kept AS (SELECT * FROM tokens WHERE source_name IN (SELECT source_name FROM top_sources)),
ranked AS (
  SELECT token, row_number() OVER (ORDER BY count(*) DESC, token) AS kw_rank FROM kept GROUP BY token
  ORDER BY count(*) DESC, token LIMIT 15
)"""
    )


ORACLE["title_tokens"] = _with(TOKENS, "SELECT off, source_name, token FROM tokens")
ORACLE["top_keywords"] = _with(
    TOKENS, "SELECT token, count(*) AS count FROM tokens GROUP BY 1 ORDER BY count DESC, token LIMIT 15"
)
ORACLE["keyword_source_long"] = _with(
    _keywords(5),
    "SELECT token, source_name, count(*) AS count FROM kept JOIN ranked USING (token) GROUP BY 1, 2",
)
ORACLE["keyword_source_matrix"] = _with(
    _keywords(20),
    "SELECT token, CAST(kw_rank AS INTEGER) AS kw_rank, "
    + ", ".join(f"count(*) FILTER (WHERE source_name = 'src{i}') AS src{i}" for i in range(20))
    + " FROM kept JOIN ranked USING (token) GROUP BY token, kw_rank",
)


def _folded(name: str, source: str, n: str = "count(*)") -> str:
    """CTE: words of ``source`` folded over letter case and simple plurals, as (key, term, n)."""
    return f"""
{name}_spelled AS MATERIALIZED (SELECT word, lower(word) AS low, {n} AS n FROM {source} GROUP BY 1, 2),
{name}_merged AS MATERIALIZED (
  SELECT w.low, CASE WHEN s.low IS NOT NULL THEN s.low ELSE w.low END AS key,
         CASE WHEN s.low IS NOT NULL THEN substr(w.word, 1, length(w.word) - 1) ELSE w.word END AS form, w.n
  FROM {name}_spelled w
  LEFT JOIN (SELECT DISTINCT low FROM {name}_spelled) s
    ON w.low LIKE '%s' AND w.low NOT LIKE '%ss' AND s.low = substr(w.low, 1, length(w.low) - 1)
),
{name}_forms AS (SELECT key, form, sum(n) AS n FROM {name}_merged GROUP BY 1, 2),
{name} AS MATERIALIZED (
  SELECT key, first(form ORDER BY n DESC, form) AS term, CAST(sum(n) AS BIGINT) AS n FROM {name}_forms GROUP BY 1
)"""


_PATTERN = r"[\p{L}\p{N}_][\p{L}\p{N}_'']*"
_CUT = "CASE WHEN lower(w) LIKE '%''s' THEN substr(w, 1, length(w) - 2) ELSE w END"
_WEIGHTED = """SELECT term, n AS count, round(CAST(n AS DOUBLE) / max(n) OVER (), 9) AS weight
               FROM (SELECT * FROM {terms} ORDER BY n DESC, term LIMIT 200)"""

ORACLE["title_word_freq"] = _with(
    f"""{ARTICLES},
raw_words AS (SELECT unnest(regexp_extract_all(title, '{_PATTERN}')) AS w FROM articles_in),
words AS (SELECT {_CUT} AS word FROM raw_words),
counted AS (SELECT word FROM words WHERE NOT regexp_full_match(word, '\\p{{Nd}}+') AND lower(word) NOT IN ({NEWS_STOP})),
{_folded('folded', 'counted')}""",
    _WEIGHTED.format(terms="folded"),
)

COLLOCATIONS = f"""{INCIDENTS},
texts AS (
  SELECT list_filter(
           list_transform(regexp_extract_all(summary, '{_PATTERN}'), lambda w: {_CUT}),
           lambda w: NOT regexp_full_match(w, '\\p{{Nd}}+')) AS t
  FROM clean WHERE summary IS NOT NULL
),
seq AS MATERIALIZED (
  SELECT w, following, count(*) AS n
  FROM (SELECT unnest(t) AS w, unnest(list_append(t[2:], NULL)) AS following FROM texts WHERE len(t) > 0)
  GROUP BY 1, 2
),
unigram AS MATERIALIZED (SELECT w AS word, sum(n) AS n FROM seq WHERE lower(w) NOT IN ({STOP}) GROUP BY 1),
bigram AS (
  SELECT w || ' ' || following AS word, n FROM seq
  WHERE lower(w) NOT IN ({STOP}) AND lower(following) NOT IN ({STOP})
),
{_folded('uni', 'unigram', 'sum(n)')},
{_folded('bi', 'bigram', 'sum(n)')},
lookup AS MATERIALIZED (
  SELECT l.low, u.term, u.n FROM (SELECT DISTINCT low, key FROM uni_merged) l JOIN uni u ON u.key = l.key
),
counts AS (
  SELECT bi.term AS bigram, x.term AS word1, y.term AS word2, CAST(bi.n AS BIGINT) AS n12, CAST(bi.n AS DOUBLE) AS c12,
         CAST(x.n AS DOUBLE) AS c1, CAST(y.n AS DOUBLE) AS c2,
         (SELECT CAST(sum(n) AS DOUBLE) FROM unigram) AS total
  FROM bi
  JOIN lookup x ON x.low = lower(split_part(bi.term, ' ', 1))
  JOIN lookup y ON y.low = lower(split_part(bi.term, ' ', 2))
),
ps AS (
  SELECT *, c2 / total AS p, c12 / c1 AS p1, (c2 - c12) / nullif(total - c1, 0e0) AS p2 FROM counts
),
scores AS (
  SELECT *, CASE WHEN total <= c1 OR total <= c2 THEN 0e0 ELSE -2e0 * (
      (c12 * ln(greatest(p, 1e-10)) + (c1 - c12) * ln(greatest(1e0 - p, 1e-10)))
    + ((c2 - c12) * ln(greatest(p, 1e-10)) + ((total - c1) - (c2 - c12)) * ln(greatest(1e0 - p, 1e-10)))
    - (c12 * ln(greatest(p1, 1e-10)) + (c1 - c12) * ln(greatest(1e0 - p1, 1e-10)))
    - ((c2 - c12) * ln(greatest(p2, 1e-10)) + ((total - c1) - (c2 - c12)) * ln(greatest(1e0 - p2, 1e-10)))
    ) END AS score
  FROM ps
),
strong AS (SELECT * FROM scores WHERE score > 30)"""
ORACLE["summary_collocations"] = _with(
    COLLOCATIONS,
    """SELECT bigram, word1, word2, n12 AS c12, CAST(c1 AS BIGINT) AS c1, CAST(c2 AS BIGINT) AS c2,
              round(score, 6) AS score FROM strong""",
)
_WORD_TERMS = """,
used AS (
  SELECT term, sum(n12) AS n FROM
    (SELECT word1 AS term, n12 FROM strong UNION ALL SELECT word2, n12 FROM strong) GROUP BY 1
),
terms AS (
  SELECT uni.term, CAST(uni.n - coalesce(used.n, 0) AS BIGINT) AS n FROM uni LEFT JOIN used ON uni.term = used.term
  WHERE uni.n - coalesce(used.n, 0) > 0
  UNION ALL SELECT bigram, n12 FROM strong
)"""
ORACLE["summary_word_freq"] = _with(COLLOCATIONS + _WORD_TERMS, _WEIGHTED.format(terms="terms"))

# Density


def _bins(points: str, bins: int) -> str:
    return f"""
extent AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {points}),
celled AS (
  SELECT x, y,
         CAST(CASE WHEN x1 > x0 THEN least(floor((x - x0) / ((x1 - x0) / {bins}e0)), {bins - 1}) ELSE 0 END AS INTEGER) AS cx,
         CAST(CASE WHEN y1 > y0 THEN least(floor((y - y0) / ((y1 - y0) / {bins}e0)), {bins - 1}) ELSE 0 END AS INTEGER) AS cy
  FROM {points}, extent
),
cells AS (SELECT cx, cy, count(*) AS weight, avg(x) AS mean_x, avg(y) AS mean_y FROM celled GROUP BY 1, 2)"""


def _kde(points: str, weighted: str, gridsize: int = 64, cut: int = 3) -> str:
    last = f"{gridsize - 1}e0"
    return f"""
stats AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1,
         var_samp(x) * pow(count(*), -2e0 / 6e0) AS hx, var_samp(y) * pow(count(*), -2e0 / 6e0) AS hy,
         covar_samp(x, y) * pow(count(*), -2e0 / 6e0) AS hxy
  FROM {points}
),
setup AS (
  SELECT *, hx * hy - hxy * hxy AS det, x0 - {cut} * sqrt(hx) AS gx0, x1 + {cut} * sqrt(hx) AS gx1,
         y0 - {cut} * sqrt(hy) AS gy0, y1 + {cut} * sqrt(hy) AS gy1 FROM stats
),
grid AS (
  SELECT CAST(i.i AS INTEGER) AS ix, CAST(j.j AS INTEGER) AS iy, gx0 + i.i * ((gx1 - gx0) / {last}) AS gx,
         gy0 + j.j * ((gy1 - gy0) / {last}) AS gy, n, hx, hy, hxy, det
  FROM range({gridsize}) i(i), range({gridsize}) j(j), setup
),
density AS (
  SELECT ix, iy, gx AS x, gy AS y,
         sum(w * exp(-0.5e0 * (hy * (gx - px) * (gx - px) - 2e0 * hxy * (gx - px) * (gy - py)
                               + hx * (gy - py) * (gy - py)) / det)) / any_value(n * 2e0 * pi() * sqrt(det)) AS density
  FROM grid, (SELECT {weighted}) AS pts
  GROUP BY ix, iy, gx, gy
)"""


LOCATIONS = f"{INCIDENTS}, points AS (SELECT longitude AS x, latitude AS y FROM clean)"
VECTORS = "points AS (SELECT CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)"
EXACT = _kde("points", "x AS px, y AS py, 1e0 AS w FROM points")
ORACLE["geo_bins"] = _with(
    f"{LOCATIONS}, {_bins('points', 128)}",
    "SELECT cx, cy, weight, round(mean_x, 8) AS mean_x, round(mean_y, 8) AS mean_y FROM cells",
)
ORACLE["kde_density"] = _with(
    f"{LOCATIONS}, {_bins('points', 128)}, "
    + _kde("points", "mean_x AS px, mean_y AS py, CAST(weight AS DOUBLE) AS w FROM cells"),
    "SELECT ix, iy, round(x, 6) AS x, round(y, 6) AS y, round(density, 12) AS density FROM density",
)
ORACLE["kde_density_exact"] = _with(
    f"{VECTORS}, {EXACT}",
    "SELECT ix, iy, round(x, 9) AS x, round(y, 9) AS y, round(density, 8) AS density FROM density",
)
ORACLE["kde_levels"] = _with(
    f"""{LOCATIONS}, {_bins('points', 128)},
    {_kde("points", "mean_x AS px, mean_y AS py, CAST(weight AS DOUBLE) AS w FROM cells")},
shares AS (SELECT CAST(i AS INTEGER) AS level, 0.05e0 + i * (1e0 - 0.05e0) / 9e0 AS share FROM range(10) r(i)),
running AS (
  SELECT density, sum(density) OVER (ORDER BY density DESC, ix, iy ROWS UNBOUNDED PRECEDING)
                  / sum(density) OVER () AS mass FROM density
)""",
    """SELECT level, round(share, 6) AS share,
              round(coalesce(max(density) FILTER (WHERE mass >= 1e0 - share), min(density)), 11) AS density
       FROM shares, running GROUP BY level, share""",
)

# Jobs


def _view(view: str, keys: list[str], value: str, source: str) -> str:
    key = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
    return f"SELECT '{view}' AS view, {key} AS key, CAST({value} AS BIGINT) AS value FROM {source}"


def _cells(row: str, rows: str, source: str, cols: list[tuple[str, str]], col: str = "targtype1_txt") -> str:
    """The cells of a matrix: every row with every column."""
    listed = ", ".join(f"('{name}', '{value}')" for name, value in cols)
    return f"""SELECT '{source}' AS view, coalesce(r.{row}, '-') || '|' || c.name AS key,
        (SELECT count(*) FROM {rows} x WHERE x.{row} IS NOT DISTINCT FROM r.{row}
           AND coalesce(x.{col}, '(none)') = c.value) AS value
        FROM (SELECT DISTINCT {row} FROM {rows}) r, (VALUES {listed}) c(name, value)"""


_UNION = "\nUNION ALL\n"
_PAIRS = [(s, s) for s in _SEGMENTS]


def _word_terms(top: int = 200) -> str:
    return f"(SELECT * FROM terms ORDER BY n DESC, term LIMIT {top})"


ORACLE["job_incidents"] = _with(
    COLLOCATIONS + _WORD_TERMS,
    _UNION.join([
        "SELECT 'job' AS view, 'raw_rows' AS key, count(*) AS value FROM incidents",
        "SELECT 'job' AS view, 'clean_rows' AS key, count(*) AS value FROM clean",
        _view("incidents_per_year", ["iyear"], "count(*)", "clean GROUP BY iyear"),
        _view("fatalities_per_year", ["iyear"], "sum(coalesce(nkill, 0))", "clean GROUP BY iyear"),
        _view("attack_types", ["attacktype1_txt"], "count(*)", "clean GROUP BY attacktype1_txt"),
        _view("regions", ["region_txt"], "count(*)", "clean GROUP BY region_txt"),
        _view("top_countries", ["country_txt"], "n", """(SELECT country_txt, count(*) AS n FROM clean GROUP BY 1
            ORDER BY n DESC, country_txt NULLS LAST LIMIT 15)"""),
        _view("deadliest_groups", ["gname"], "n", """(SELECT gname, sum(coalesce(nkill, 0)) AS n FROM clean
            WHERE gname <> 'Unknown' GROUP BY 1 ORDER BY n DESC, gname LIMIT 15)"""),
        _view("attack_targets", ["attacktype1_txt", "targtype1_txt"], "count(*)",
              "clean GROUP BY attacktype1_txt, targtype1_txt"),
        _view("attack_trend", ["iyear", "attacktype1_txt"], "count(*)", "clean GROUP BY iyear, attacktype1_txt"),
        _cells("attacktype1_txt", "clean", "attack_target_matrix", [*_PAIRS, ("(none)", "(none)")]),
        _view("summary_words", ["term"], "n", _word_terms()),
    ]),
)
ORACLE["job_news"] = _with(
    f"""{_keywords(20)},
raw_words AS (SELECT unnest(regexp_extract_all(title, '{_PATTERN}')) AS w FROM articles_in),
words AS (SELECT {_CUT} AS word FROM raw_words),
counted AS (SELECT word FROM words WHERE NOT regexp_full_match(word, '\\p{{Nd}}+') AND lower(word) NOT IN ({NEWS_STOP})),
{_folded('folded', 'counted')}""",
    _UNION.join([
        _view("title_words", ["term"], "n", "(SELECT * FROM folded ORDER BY n DESC, term LIMIT 200)"),
        _view("top_sources", ["source_name"], "n", """(SELECT source_name, count(*) AS n FROM articles_in
            WHERE source_name IS NOT NULL GROUP BY 1 ORDER BY n DESC, source_name LIMIT 20)"""),
        """SELECT 'keyword_source_matrix' AS view, r.token || '|' || s.source_name AS key,
             (SELECT count(*) FROM kept k WHERE k.token = r.token AND k.source_name = s.source_name) AS value
           FROM ranked r, (SELECT DISTINCT source_name FROM kept JOIN ranked USING (token)) s""",
    ]),
)
# The same rows as the job: a sample of the selection takes the place of the clean table.
_EXPLORED = COLLOCATIONS.replace("clean AS (", "every AS (", 1).replace(
    "texts AS (",
    """clean AS (
  SELECT * FROM every WHERE iyear BETWEEN 1995 AND 1997 AND region_txt = 'ASIA'
  ORDER BY md5(CAST(eventid AS VARCHAR) || '|42'), eventid LIMIT 200
),
texts AS (""",
    1,
)
ORACLE["job_explore"] = _with(
    _EXPLORED + _WORD_TERMS + """,
years AS (SELECT DISTINCT iyear FROM clean),
known AS (SELECT * FROM clean WHERE attacktype1_txt IS NOT NULL AND targtype1_txt IS NOT NULL)""",
    _UNION.join([
        "SELECT 'kpis' AS view, 'n' AS key, count(*) AS value FROM clean",
        _view("year_frames", ["f.iyear", "c.iyear"], "count(*)",
              "clean c JOIN years f ON c.iyear <= f.iyear GROUP BY f.iyear, c.iyear"),
        _view("map_frames", ["f.iyear"], "count(*)", "clean c JOIN years f ON c.iyear <= f.iyear GROUP BY f.iyear"),
        _view("attack_types", ["attacktype1_txt"], "count(*)",
              "clean WHERE attacktype1_txt IS NOT NULL GROUP BY attacktype1_txt"),
        _view("regions", ["region_txt"], "count(*)", "clean GROUP BY region_txt"),
        _view("countries", ["country_txt"], "count(*)", "clean WHERE country_txt IS NOT NULL GROUP BY country_txt"),
        _view("attack_trend", ["iyear", "attacktype1_txt"], "count(*)",
              "clean WHERE attacktype1_txt IS NOT NULL GROUP BY iyear, attacktype1_txt"),
        _view("attack_targets", ["attacktype1_txt", "targtype1_txt"], "count(*)",
              "known GROUP BY attacktype1_txt, targtype1_txt"),
        _cells("attacktype1_txt", "known", "attack_target_matrix", _PAIRS),
        _view("summary_words", ["term"], "n", _word_terms()),
    ]),
)

# Spans, splits, patterns, corpora

ORACLE["csv_split_load"] = _with(
    RAW,
    """SELECT * REPLACE (CAST(latitude AS VARCHAR) AS latitude, CAST(longitude AS VARCHAR) AS longitude,
                         city || chr(10) || '"city"' || chr(10) || chr(10) || eventid AS city) FROM raw""",
)
_incidents(
    "frame_spans",
    """SELECT c.*, CAST(y0 + ((c.iyear - y0 + 1) // 2) * 2 AS INTEGER) AS first_frame,
              CASE WHEN c.iyear IS NOT NULL THEN CAST(y0 + ((y1 - y0 + 1) // 2) * 2 AS INTEGER) END AS last_frame
       FROM clean c, (SELECT min(iyear) AS y0, max(iyear) AS y1 FROM clean)""",
)
ORACLE["title_word_sets"] = _with(
    TOKENS
    + """,
held AS MATERIALIZED (SELECT DISTINCT off, token FROM tokens),
least AS (SELECT 0.1e0 * count(DISTINCT off) - 1e-9 AS least FROM held),
often AS MATERIALIZED (
  SELECT off, token FROM held WHERE token IN
    (SELECT token FROM held GROUP BY 1 HAVING count(*) >= (SELECT least FROM least))
),
sets AS (
  SELECT a.token AS words, 1 AS size, count(*) AS n FROM often a GROUP BY 1
  UNION ALL
  SELECT a.token || ' ' || b.token, 2, count(*) FROM often a JOIN often b ON a.off = b.off AND a.token < b.token
  GROUP BY a.token, b.token
  UNION ALL
  SELECT a.token || ' ' || b.token || ' ' || c.token, 3, count(*) FROM often a
  JOIN often b ON a.off = b.off AND a.token < b.token JOIN often c ON a.off = c.off AND b.token < c.token
  GROUP BY a.token, b.token, c.token
)""",
    "SELECT words, size, n FROM sets WHERE n >= (SELECT least FROM least)",
)
ORACLE["title_tfidf"] = _with(
    TOKENS
    + """,
counts AS MATERIALIZED (SELECT off, token, count(*) AS tf FROM tokens GROUP BY 1, 2),
known AS (
  SELECT token, ln((1e0 + (SELECT count(DISTINCT off) FROM counts)) / (1e0 + count(*))) + 1e0 AS idf
  FROM counts GROUP BY 1 ORDER BY count(*) DESC, token LIMIT 20000
),
weighted AS MATERIALIZED (SELECT off, token, tf * idf AS w FROM counts JOIN known USING (token)),
sizes AS (SELECT off, sqrt(sum(w * w)) AS size FROM weighted GROUP BY 1)""",
    "SELECT off, token, CAST(round_even(w / size * 1048576e0, 0) AS BIGINT) AS weight FROM weighted JOIN sizes USING (off)",
)
ORACLE["keyword_shift"] = _with(
    TOKENS
    + f""",{INCIDENTS},
past AS (
  SELECT trim(unnest(regexp_split_to_array(
           regexp_replace(lower(summary), '[^\\p{{L}}\\p{{N}}_\\s'']', ' ', 'g'), '\\s+')), '''') AS token
  FROM clean WHERE summary IS NOT NULL
),
x AS (
  SELECT token, count(*) AS n FROM past
  WHERE length(token) > 2 AND regexp_full_match(token, '\\p{{L}}+') AND token NOT IN ({NEWS_STOP}) GROUP BY 1
),
y AS (SELECT token, count(*) AS n FROM tokens GROUP BY 1),
counts AS (
  SELECT coalesce(x.token, y.token) AS token, coalesce(x.n, 0) AS n_first, coalesce(y.n, 0) AS n_second
  FROM x FULL JOIN y ON x.token = y.token
),
sums AS (
  SELECT *, CAST(sum(n_first) OVER () AS DOUBLE) AS f, CAST(sum(n_second) OVER () AS DOUBLE) AS s FROM counts
),
priors AS (SELECT *, 1e3 * (n_first + n_second) / (f + s) AS p FROM sums),
scored AS (
  SELECT *, ln(((n_first + p) / (f + 1e3 - (n_first + p))) / ((n_second + p) / (s + 1e3 - (n_second + p)))) AS lo,
         1 / (n_first + p) + 1 / (n_second + p) AS v
  FROM priors
)""",
    """SELECT token, n_first, n_second, round(n_first / nullif(f, 0e0), 9) AS share_first,
              round(n_second / nullif(s, 0e0), 9) AS share_second, round(lo, 9) AS log_odds, round(v, 9) AS variance,
              round(lo / sqrt(v), 9) AS z FROM scored""",
)
