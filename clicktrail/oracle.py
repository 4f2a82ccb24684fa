"""The catalog's queries as DuckDB SQL over the same tables.

Written independently of the DataFrame code: plain windows, joins and pair
expansions where the engine uses mergeable aggregates.
"""

from __future__ import annotations

from clicktrail.catalog import CUSTOM, LENIENT, TYPED
from clicktrail.rules import HIT_COLUMNS, Rules

R = Rules()
WS = r"chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)"

EVENT_HITS = r"""
e AS (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events),
hits AS (
  SELECT CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) AS hit_time_gmt,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time,
    'Mozilla/5.0 (agent ' || (k % 5) || ')' AS user_agent,
    '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip,
    CASE WHEN event_type = 'purchase' AND k % 3 = 0 THEN '2, 1' WHEN event_type = 'purchase' THEN '1'
      WHEN event_type = 'view' THEN '2' WHEN event_type = 'signup' THEN '11'
      WHEN event_type = 'error' THEN '12' ELSE '' END AS event_list,
    'Aarhus' AS geo_city, 'MJ' AS geo_region, 'DK' AS geo_country,
    event_type AS pagename,
    'http://shop.example/p/' || k AS page_url,
    CASE WHEN event_type = 'purchase' THEN 'Outdoor;Model ' || k || ';1;'
        || CASE WHEN k % 10 = 9 THEN 'N/A' ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END || ';'
        || CASE WHEN k % 4 = 0 THEN ',Repair;Patch;1;;' ELSE '' END
        || CASE WHEN k % 6 = 0 THEN ',Repair;Rope;2; 18.75 ;event1;evar1' ELSE '' END
      WHEN event_type = 'view' THEN 'Outdoor;Model ' || k || ';1;;' ELSE '' END AS product_list,
    CASE WHEN event_type = 'click' AND k < 16 THEN
      CASE WHEN k = 15 THEN 'http://www.msn.com/results?q=%20&p=Compass'
        WHEN k % 8 = 0 THEN 'http://www.google.com/search?lang=da&q=Oak+Desk+' || k || '&start=0'
        WHEN k % 8 = 1 THEN 'http://WWW.BING.COM/search?q=Tent%20' || k || '&count=20'
        WHEN k % 8 = 2 THEN 'http://search.yahoo.com/search?p=rain+jacket&page=2'
        WHEN k % 8 = 3 THEN 'http://search.aol.com/aol/search?query=wool%20scarf'
        WHEN k % 8 = 4 THEN 'http://www.google.com/'
        WHEN k % 8 = 5 THEN 'http://duckduckgo.com/?q=kayak'
        WHEN k % 8 = 6 THEN 'http://www.google.co.uk/search?q=lamp'
        ELSE 'http://www.ask.com/web?q=&q=Lantern' END
      ELSE 'http://shop.example/p/' || k END AS referrer,
    event_id, 0 AS copy
  FROM e)"""

DIRTY = (
    EVENT_HITS
    + r""",
dirty AS (
  SELECT CASE WHEN event_id % 83 = 0 THEN 'abc' WHEN event_id % 79 = 0 THEN chr(9) ELSE hit_time_gmt END AS hit_time_gmt,
    date_time, CASE WHEN event_id % 10 < 6 THEN '' ELSE user_agent END AS user_agent,
    CASE WHEN event_id % 89 = 0 THEN '  ' ELSE ip END AS ip,
    event_list, geo_city, geo_region, geo_country,
    CASE WHEN c.copy = 1 THEN 'again' ELSE pagename END AS pagename,
    page_url, product_list, CASE WHEN event_id % 89 <= 1 THEN '' ELSE referrer END AS referrer,
    event_id, c.copy AS copy
  FROM hits h JOIN (VALUES (0), (1)) c(copy) ON c.copy = 0 OR h.event_id % 97 = 0)"""
)


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _host(url: str) -> str:
    return rf"lower(regexp_extract({url}, '^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]+)', 1))"


def _domain(url: str) -> str:
    return f"array_to_string(list_slice(string_split({_host(url)}, '.'), -2, -1), '.')"


def _raw_param(url: str, name: str) -> str:
    return rf"nullif(regexp_extract({url}, '^[^?#]*\?(?:[^#]*?&)??{name}=([^&#]+)', 1), '')"


def _decoded(raw: str) -> str:
    return f"trim(url_decode(replace({raw}, '+', ' ')), {WS})"


def _keyword(url: str, rules: Rules = R, skip: bool = False) -> str:
    if skip:
        values = [f"nullif({_decoded(_raw_param(url, p))}, '')" for p in rules.keyword_params]
        keyword = f"coalesce({', '.join(values)})" if len(values) > 1 else values[0]
    else:
        values = [_raw_param(url, p) for p in rules.keyword_params]
        keyword = _decoded(f"coalesce({', '.join(values)})" if len(values) > 1 else values[0])
    return f"lower({keyword})" if rules.keyword_normalize_case else keyword


def _has(event_list: str, event_id: str) -> str:
    return f"list_contains(list_transform(string_split({event_list}, ','), lambda x: trim(x)), '{event_id}')"


def _revenue(product_list: str, index: int = 3) -> str:
    price = f"coalesce(try_cast(trim(split_part(p, ';', {index + 1})) AS DECIMAL(20,6)), 0)"
    return f"list_sum(list_transform(string_split({product_list}, ','), lambda p: {price}))"


def _activity(source: str = "hits", rules: Rules = R, skip: bool = False, name: str = "act") -> str:
    """CTE with one row per touch or purchase; ``revenue`` is NULL unless it counts."""
    counted = f"{_has('event_list', rules.purchase_event_id)} AND trim(product_list) NOT IN ('', 'nan', 'None')"
    return f""",
{name}_p AS (
  SELECT event_id, copy, trim(ip) AS session, TRY_CAST(hit_time_gmt AS BIGINT) AS ts,
    {_domain('referrer')} AS d, {_keyword('referrer', rules, skip)} AS w,
    {_has('event_list', rules.purchase_event_id)} AS is_purchase,
    CASE WHEN {counted} THEN CAST({_revenue('product_list', rules.revenue_col_index)} AS DECIMAL(38,6)) END AS r
  FROM {source}),
{name}_t AS (
  SELECT event_id, copy, session, ts, is_purchase,
    CASE WHEN w IS NOT NULL AND d IN ({_quoted(rules.search_engine_domains)}) THEN d END AS domain,
    CASE WHEN d IN ({_quoted(rules.search_engine_domains)}) THEN w END AS keyword,
    CASE WHEN r > {rules.min_revenue_threshold} THEN r END AS revenue, r AS any_revenue
  FROM {name}_p WHERE session <> ''),
{name} AS (SELECT * FROM {name}_t WHERE domain IS NOT NULL OR is_purchase)"""


def _first(name: str = "act") -> str:
    return f""",
firsts AS (
  SELECT session, domain, keyword, ts AS first_ts FROM {name} WHERE domain IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY session ORDER BY ts NULLS LAST, event_id, copy) = 1)"""


BASE = "WITH " + EVENT_HITS
ACT = BASE + _activity()
FIRST = ACT + _first()
DIRT = "WITH " + DIRTY

# exact half-up quotient of two integers, scaled
_RATIO = "CAST(CASE WHEN {d} > 0 THEN (2 * {n} + {d}) // (2 * {d}) ELSE 0 END AS DOUBLE) / 100"

_KEYWORD_REVENUE = """SELECT domain, keyword, CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue
FROM ({credit}) GROUP BY domain, keyword HAVING round(sum(revenue), 2) > 0"""

FIRST_CREDIT = "SELECT f.domain, f.keyword, a.revenue FROM act a JOIN firsts f USING (session) WHERE a.revenue IS NOT NULL"
# the last touch at or before the purchase's second
LAST_CREDIT = """SELECT t.domain, t.keyword, p.revenue
  FROM act p JOIN act t USING (session)
  WHERE p.revenue IS NOT NULL AND t.domain IS NOT NULL AND t.ts <= p.ts
  QUALIFY row_number() OVER (PARTITION BY p.event_id, p.copy ORDER BY t.ts DESC, t.event_id DESC, t.copy DESC) = 1"""
# exact: shares are rounded half up at 11 decimals
LINEAR_CREDIT = """SELECT domain, keyword,
    CAST((CAST(total * 1000000 AS HUGEINT) * c * 100000 * 2 + n) // (2 * n) AS DECIMAL(38,0)) AS units
  FROM (SELECT session, domain, keyword, count(*) AS c FROM act WHERE domain IS NOT NULL GROUP BY ALL)
  JOIN (SELECT session, count(domain) AS n, sum(revenue) AS total FROM act GROUP BY session) USING (session)
  WHERE total IS NOT NULL"""
LINEAR = f"""SELECT domain, keyword, CAST((CAST(sum(units) AS HUGEINT) + 500000000) // 1000000000 AS DOUBLE) / 100 AS revenue
FROM ({LINEAR_CREDIT}) GROUP BY domain, keyword HAVING revenue > 0"""
DECAY_CREDIT = f"""SELECT domain, keyword, CAST(revenue AS DOUBLE) * w / sum(w) OVER (PARTITION BY event_id, copy) AS revenue
  FROM (SELECT p.event_id, p.copy, p.revenue, t.domain, t.keyword,
      pow(2.0, CAST(t.ts - p.ts AS DOUBLE) / {R.half_life_seconds}) AS w
    FROM act p JOIN act t USING (session)
    WHERE p.revenue IS NOT NULL AND t.domain IS NOT NULL AND t.ts <= p.ts)"""

KEY = f"trim(hit_time_gmt, {WS}) AS k1, trim(ip) AS k2, trim(page_url) AS k3"
BLANK = {c: f"trim({c}, {WS}) = ''" for c in HIT_COLUMNS}
NULL_CRITICAL = " OR ".join(BLANK[c] for c in R.critical_columns)
BAD_TIME = f"(NOT {BLANK['hit_time_gmt']} AND TRY_CAST(hit_time_gmt AS BIGINT) IS NULL)"
BAD_DATE = f"(NOT {BLANK['date_time']} AND TRY_CAST(date_time AS TIMESTAMP) IS NULL)"
COLS = ", ".join(HIT_COLUMNS)


def _null_rejects(columns: str = COLS) -> str:
    return " UNION ALL ".join(
        f"SELECT event_id, copy, {columns}, 'null_critical_column: {c}' AS _error_reason FROM dirty WHERE {BLANK[c]}"
        for c in R.critical_columns
    )


def _type_rejects(columns: str = COLS) -> str:
    return (
        f"SELECT event_id, copy, {columns}, 'type_error: hit_time_gmt' AS _error_reason FROM dirty WHERE {BAD_TIME}"
        f" UNION ALL SELECT event_id, copy, {columns}, 'type_error: date_time' AS _error_reason FROM dirty WHERE {BAD_DATE}"
    )


def _dup_rejects(where: str = "true", columns: str = COLS) -> str:
    return f"""SELECT event_id, copy, {columns},
      'duplicate_row: key=(''' || k1 || ''', ''' || k2 || ''', ''' || k3 || ''')' AS _error_reason
    FROM (SELECT *, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY event_id, copy) AS rn
      FROM (SELECT *, {KEY} FROM dirty WHERE {where}))
    WHERE rn > 1"""


def _deduped(where: str, name: str = "clean") -> str:
    return f""",
{name} AS (SELECT * EXCLUDE (k1, k2, k3, rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY k1, k2, k3 ORDER BY event_id, copy) AS rn
  FROM (SELECT *, {KEY} FROM dirty WHERE {where})) WHERE rn = 1)"""


def _mask(c: str) -> str:
    return f"substr(sha256(trim({c}, {WS})), 1, 16) || '...'"


def _masked_columns(columns=HIT_COLUMNS) -> str:
    return ", ".join(f"CASE WHEN {c} = '' THEN {c} ELSE {_mask(c)} END AS {c}" if c in R.pii_columns else c for c in columns)


def _report(rules: Rules, credit: str = FIRST_CREDIT) -> str:
    d, k, r = rules.output_columns
    low = rules.min_revenue_threshold
    return f"""SELECT domain AS "{d}", keyword AS "{k}", CAST(round(sum(revenue), 2) AS DOUBLE) AS "{r}"
FROM ({credit}) GROUP BY domain, keyword HAVING round(sum(revenue), 2) > {low}"""


SEM = f"""SELECT domain AS search_engine_domain, keyword AS search_keyword, clicks AS total_clicks,
  us AS unique_sessions, cs AS converting_sessions, cents / 100.0::DOUBLE AS total_revenue,
  {_RATIO.format(n='cs * 10000', d='us')} AS conversion_rate,
  {_RATIO.format(n='cents', d='clicks')} AS revenue_per_click,
  {_RATIO.format(n='cents', d='cs')} AS avg_order_value,
  '{{run_date}}' AS run_date, 'run-1' AS run_id
FROM (
  SELECT domain, keyword, clicks, coalesce(us, 0) AS us, coalesce(cs, 0) AS cs,
    CAST(round(coalesce(rev, 0), 2) * 100 AS BIGINT) AS cents
  FROM (SELECT domain, keyword, count(*) AS clicks FROM sem WHERE domain IS NOT NULL GROUP BY ALL) c
  LEFT JOIN (
    SELECT domain, keyword, count(*) AS us, count(bought) AS cs, sum(rev) AS rev
    FROM firsts LEFT JOIN (
      SELECT session, true AS bought, sum(any_revenue) AS rev FROM sem WHERE is_purchase GROUP BY session) USING (session)
    GROUP BY domain, keyword) s USING (domain, keyword))"""
SEM_BASE = BASE + _activity(skip=True, name="sem") + _first("sem")


OBJECTS = """WITH d0 AS (
  SELECT CASE WHEN page_id % 6 = 0 THEN 'raw/' WHEN page_id % 6 = 1 THEN 'raw/Sprint/' WHEN page_id % 6 = 2 THEN 'raw/phase/'
      ELSE 'raw/phase' || (page_id % 7) || '/' END
    || CASE WHEN page_id % 4 = 0 THEN 'hits_walk_' || page_id || '.tab'
      WHEN page_id % 4 = 1 THEN 'hits_20240131_' || page_id || '.tab'
      ELSE 'hits_' || page_id || '_20240131_' || lpad(CAST(page_id % 86400 AS VARCHAR), 6, '0') || '.TAB' END AS path, url
  FROM pages),
d AS (SELECT path, path AS key, url, regexp_extract(path, '[^/]*$') AS file_name,
  CASE WHEN regexp_matches('/' || path || '/', '/phase[0-9]+/') THEN regexp_extract('/' || path || '/', '/(phase[0-9]+)/', 1)
    WHEN lower(path) LIKE '%phase1%' OR lower(path) LIKE '%crawl%' THEN 'phase1'
    WHEN lower(path) LIKE '%phase2%' OR lower(path) LIKE '%walk%' THEN 'phase2'
    WHEN lower(path) LIKE '%phase3%' OR lower(path) LIKE '%jog%' THEN 'phase3'
    WHEN lower(path) LIKE '%phase4%' OR lower(path) LIKE '%run%' THEN 'phase4'
    WHEN lower(path) LIKE '%phase5%' OR lower(path) LIKE '%sprint%' THEN 'phase5'
    ELSE 'other' END AS phase FROM d0),
registry AS (SELECT DISTINCT phase, file_name FROM d WHERE url LIKE 'https%')"""
CONTRACT = "regexp_matches(file_name, '_[0-9]{8}_[0-9]{6}[.]')"

_MIN = f"NOT ({NULL_CRITICAL})"
RUN = DIRT + _deduped(_MIN) + _activity("clean") + _first()


def oracle_sql() -> dict[str, str]:
    sql = {
        "url_host": f"SELECT page_id, {_host('url')} AS host FROM pages",
        "registrable_domain": f"SELECT page_id, {_domain('url')} AS domain FROM pages",
        "url_param": f"""SELECT page_id, {_decoded(_raw_param('url', 'ref'))} AS ref,
          {_decoded('coalesce(' + _raw_param('url', 'utm_source') + ', ' + _raw_param('url', 'page') + ')')} AS source_or_page
          FROM pages""",
        "search_touch": BASE
        + f""", t AS (SELECT event_id, {_domain('referrer')} AS d, {_keyword('referrer')} AS w,
            {_keyword('referrer', skip=True)} AS s FROM hits)
          SELECT event_id, CASE WHEN w IS NOT NULL AND d IN ({_quoted(R.search_engine_domains)}) THEN d END AS domain,
            CASE WHEN d IN ({_quoted(R.search_engine_domains)}) THEN w END AS keyword,
            CASE WHEN d IN ({_quoted(R.search_engine_domains)}) THEN s END AS keyword_skip FROM t""",
        "has_purchase": BASE
        + f" SELECT event_id, {_has('event_list', '1')} AS is_purchase, {_has('event_list', '11')} AS is_checkout FROM hits",
        "product_revenue": BASE + f" SELECT event_id, CAST({_revenue('product_list')} AS DOUBLE) AS revenue FROM hits",
        "product_rows": BASE
        + """ SELECT event_id, CAST(i - 1 AS INTEGER) AS position, split_part(p, ';', 1) AS category,
            split_part(p, ';', 2) AS name, split_part(p, ';', 3) AS quantity, split_part(p, ';', 4) AS revenue,
            split_part(p, ';', 5) AS events, split_part(p, ';', 6) AS evars
          FROM (SELECT event_id, unnest(string_split(product_list, ',')) AS p,
            unnest(range(1, len(string_split(product_list, ',')) + 1)) AS i FROM hits)""",
        "mask_pii": DIRT
        + f""" SELECT event_id, copy, {_mask('ip')} AS ip,
            CASE WHEN user_agent = '' THEN 'EMPTY' ELSE {_mask('user_agent')} END AS user_agent FROM dirty""",
        "revenue_text": "SELECT event_id, CAST(CAST(value * 1000 AS DECIMAL(18,2)) AS VARCHAR) AS revenue FROM events",
        "crlf_normalize": BASE + " SELECT event_id, pagename || page_url AS line FROM hits",
        "read_hit_files": BASE + " SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in HIT_COLUMNS) + " FROM hits",
        "keyword_report_from_files": FIRST + " " + _report(R),
        "phase_label": OBJECTS + " SELECT path, phase FROM d",
        "filename_contract": OBJECTS + f" SELECT path, {CONTRACT} AS ok, lower(file_name) LIKE '%.tab' AS is_hit_file FROM d",
        "dup_delivery": OBJECTS + " SELECT key, phase, file_name FROM d JOIN registry USING (phase, file_name)",
        "intake_manifest": OBJECTS
        + f""" SELECT d.key, d.phase, d.file_name,
            CASE WHEN NOT {CONTRACT.replace('file_name', 'd.file_name')} THEN 'missing_timestamp_in_filename'
              WHEN r.phase IS NOT NULL OR row_number() OVER (PARTITION BY d.phase, d.file_name ORDER BY d.key) > 1
              THEN 'duplicate' END AS reason
          FROM d LEFT JOIN registry r ON d.phase = r.phase AND d.file_name = r.file_name""",
        "stream_intake": FIRST + " " + _KEYWORD_REVENUE.format(credit=FIRST_CREDIT),
        "intake_report_files": FIRST + " " + _KEYWORD_REVENUE.format(credit=FIRST_CREDIT),
        "intake_quality_reports": BASE + " SELECT true AS all_passed, count(*) AS rows_in, (SELECT count(*) - count(DISTINCT (hit_time_gmt, ip, page_url)) FROM hits) AS error_count FROM hits",
        "two_runs_one_day": FIRST
        + f""" SELECT domain AS "{R.output_columns[0]}", keyword AS "{R.output_columns[1]}",
            CAST(CAST(round(sum(revenue), 2) AS DECIMAL(38,2)) AS VARCHAR) AS "{R.output_columns[2]}", half
          FROM (SELECT f.domain, f.keyword, a.revenue, CAST(string_split(session, '.')[-1] AS BIGINT) % 2 AS half
            FROM act a JOIN firsts f USING (session) WHERE a.revenue IS NOT NULL)
          GROUP BY domain, keyword, half HAVING round(sum(revenue), 2) > 0""",
        "archived_inputs": BASE
        + """ SELECT 'half' || (CAST(string_split(trim(ip), '.')[-1] AS BIGINT) % 2) || '/hits.tab' AS archived, count(*) AS row_count,
            CAST(sum(TRY_CAST(hit_time_gmt AS BIGINT)) AS BIGINT) AS time_sum, CAST(sum(length(nullif(page_url, ''))) AS BIGINT) AS url_chars
          FROM hits WHERE TRY_CAST(string_split(trim(ip), '.')[-1] AS BIGINT) IS NOT NULL GROUP BY ALL""",
        "intake_registry": """SELECT DISTINCT 'phase' || (user_id % 3) AS phase,
            'hits_' || (user_id % 500) || '_' || strftime(ts, '%Y%m%d') || '_000000.tab' AS file_name
          FROM events WHERE user_id % 10 NOT IN (3, 9)""",
        "malformed_bytes": BASE
        + """ SELECT event_id, 'caf' || chr(65533) || ' ' || event_id || ' ' || chr(65533) AS as_utf8,
            'caf' || chr(233) || ' ' || event_id || ' ' || chr(252) AS as_latin1 FROM hits""",
        "dedup_hits_from_files": DIRT + _deduped("true") + " SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in HIT_COLUMNS) + " FROM clean",
        "dq_dup_rejects_from_files": DIRT
        + " SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in HIT_COLUMNS) + f", _error_reason FROM ({_dup_rejects()})",
        "dq_schema": DIRT
        + " SELECT 'schema_error: missing columns [''geo_city'', ''referrer'']' AS reason, count(*) AS row_count FROM dirty",
        "dq_null_counts": DIRT
        + " "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(*) FILTER ({BLANK[c]}) AS blanks, count(*) AS total FROM dirty"
            for c in HIT_COLUMNS
        ),
        "dq_null_rates": DIRT
        + " SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER ({BLANK[c]}) AS blanks, count(*) AS total,
              CAST((count(*) FILTER ({BLANK[c]}) * 20000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS blank_pct
              FROM dirty"""
            for c in HIT_COLUMNS
            if c not in R.critical_columns
        )
        + ") WHERE blank_pct > 50",
        "dq_null_rejects": DIRT + " " + _null_rejects(),
        "dq_type_rejects": DIRT + " " + _type_rejects(),
        "dq_dup_rejects": DIRT + " " + _dup_rejects(),
        "dq_errors": DIRT
        + f""" SELECT event_id, copy, {_masked_columns()}, _error_reason FROM (
            {_null_rejects()} UNION ALL {_type_rejects()} UNION ALL
            {_dup_rejects(f'{_MIN} AND NOT {BAD_TIME} AND NOT {BAD_DATE}')})""",
        "dq_summary": DIRT
        + f""", s AS (SELECT count(*) AS rows_in, count(*) FILTER ({NULL_CRITICAL}) AS bad,
            sum({' + '.join(f"({BLANK[c]})::INT" for c in R.critical_columns)})::BIGINT AS reasons FROM dirty),
          k AS (SELECT count(*) AS after FROM (SELECT DISTINCT k1, k2, k3 FROM (SELECT {KEY} FROM dirty WHERE {_MIN})))
          SELECT rows_in, after AS rows_out, bad AS critical_failures, rows_in - bad AS rows_before, after AS rows_after,
            rows_in - bad - after AS duplicate_count, reasons + rows_in - bad - after AS error_count, bad = 0 AS overall_passed
          FROM s, k""",
        "dedup_hits": DIRT + _deduped("true") + f" SELECT event_id, copy, {COLS} FROM clean",
        "dedup_any": DIRT + _deduped("true") + " SELECT hit_time_gmt, trim(ip) AS ip, page_url FROM clean",
        "dedup_count": DIRT
        + f""" SELECT count(*) AS rows_before, count(DISTINCT (k1, k2, k3)) AS rows_after,
            count(*) - count(DISTINCT (k1, k2, k3)) AS duplicate_count FROM (SELECT {KEY} FROM dirty)""",
        "search_hits": ACT + " SELECT session, ts, domain, keyword, event_id FROM act WHERE domain IS NOT NULL",
        "purchase_rows": ACT
        + " SELECT session, ts, CAST(revenue AS DOUBLE) AS revenue, event_id FROM act WHERE revenue IS NOT NULL",
        "first_touch": FIRST + " SELECT session, domain, keyword FROM firsts",
        "attribute_revenue": FIRST
        + """ SELECT session, a.ts, CAST(revenue AS DOUBLE) AS revenue, f.domain, f.keyword, event_id
          FROM act a JOIN firsts f USING (session) WHERE revenue IS NOT NULL""",
        "attribute_revenue_prior_only": FIRST
        + """ SELECT session, a.ts, CAST(revenue AS DOUBLE) AS revenue, f.domain, f.keyword, event_id
          FROM act a JOIN firsts f USING (session) WHERE revenue IS NOT NULL AND first_ts <= a.ts""",
        "unattributed_purchases": FIRST
        + """ SELECT session, ts, CAST(revenue AS DOUBLE) AS revenue, event_id FROM act
          WHERE revenue IS NOT NULL AND session NOT IN (SELECT session FROM firsts)""",
        "invoice_reconcile": FIRST
        + EVENT_HITS.replace("FROM events", "FROM (SELECT * REPLACE ('click' AS event_type) FROM events WHERE event_type IN ('click', 'error'))")
        .replace("e AS (", ", e2 AS (")
        .replace("hits AS (", "hits2 AS (")
        .replace("FROM e)", "FROM e2)")
        + _activity("hits2", name="bill")
        + """, b AS (SELECT CASE WHEN domain = 'aol.com' THEN 'aol.de' ELSE domain END AS domain, keyword, count(*) AS billed
            FROM bill WHERE domain IS NOT NULL GROUP BY ALL),
          r AS (SELECT c.domain, c.keyword, clicks, coalesce(sessions, 0) AS sessions FROM
            (SELECT domain, keyword, count(*) AS clicks FROM act WHERE domain IS NOT NULL GROUP BY ALL) c LEFT JOIN
            (SELECT domain, keyword, count(*) AS sessions FROM firsts GROUP BY ALL) s USING (domain, keyword))
          SELECT domain, keyword, coalesce(billed, 0) AS billed_clicks, coalesce(clicks, 0) AS recorded_clicks,
            coalesce(sessions, 0) AS recorded_sessions, coalesce(billed, 0) - coalesce(sessions, 0) AS discrepancy
          FROM b FULL JOIN r USING (domain, keyword)""",
        "keyword_revenue": FIRST + " " + _KEYWORD_REVENUE.format(credit=FIRST_CREDIT),
        "last_touch": ACT + " " + _KEYWORD_REVENUE.format(credit=LAST_CREDIT),
        "linear_touch": ACT + " " + LINEAR,
        "time_decay": ACT + " " + _KEYWORD_REVENUE.format(credit=DECAY_CREDIT),
        "model_compare": FIRST
        + f""" SELECT domain, keyword, coalesce(sum(revenue) FILTER (m = 1), 0) AS first_touch,
            coalesce(sum(revenue) FILTER (m = 2), 0) AS last_touch, coalesce(sum(revenue) FILTER (m = 3), 0) AS linear,
            coalesce(sum(revenue) FILTER (m = 4), 0) AS time_decay
          FROM (SELECT 1 AS m, * FROM ({_KEYWORD_REVENUE.format(credit=FIRST_CREDIT)})
            UNION ALL SELECT 2, * FROM ({_KEYWORD_REVENUE.format(credit=LAST_CREDIT)})
            UNION ALL SELECT 3, * FROM ({LINEAR})
            UNION ALL SELECT 4, * FROM ({_KEYWORD_REVENUE.format(credit=DECAY_CREDIT)})) GROUP BY domain, keyword""",
        "keyword_revenue_named": FIRST + " " + _report(R.but(output_columns=("engine", "term", "income"))),
        "keyword_clicks": ACT
        + " SELECT domain, keyword, count(*) AS clicks FROM act WHERE domain IS NOT NULL GROUP BY domain, keyword",
        "keyword_sessions": FIRST + " SELECT domain, keyword, count(*) AS sessions FROM firsts GROUP BY domain, keyword",
        "keyword_conversions": FIRST
        + """ SELECT domain, keyword, count(*) AS converting_sessions FROM firsts
          WHERE session IN (SELECT session FROM act WHERE is_purchase) GROUP BY domain, keyword""",
        "run_totals": FIRST
        + """ SELECT (SELECT count(*) FROM firsts) AS search_sessions, count(domain) AS touches,
            count(revenue) AS purchases, count(revenue) FILTER (session IN (SELECT session FROM firsts)) AS attributed_purchases,
            CAST(round(sum(revenue), 2) AS DOUBLE) AS revenue,
            CAST(round(sum(revenue) FILTER (session IN (SELECT session FROM firsts)), 2) AS DOUBLE) AS attributed_revenue
          FROM act""",
        "shared_session_keys": DIRT
        + """ SELECT trim(ip) AS session, count(DISTINCT user_agent) AS user_agents FROM dirty WHERE trim(ip) <> ''
          GROUP BY trim(ip) HAVING count(DISTINCT user_agent) > 1""",
        "keyword_report": FIRST + " " + _report(R),
        "keyword_report_custom_rules": BASE + _activity(rules=CUSTOM) + _first() + " " + _report(CUSTOM),
        "sem_insights": SEM_BASE + " " + SEM.replace("{run_date}", "2024-02-01 12:00:00 UTC"),
        "sem_report_file": SEM_BASE + " " + SEM.replace("{run_date}", "2024-02-01 12:00:00 UTC"),
        "report_file": RUN
        + f""" SELECT domain AS "{R.output_columns[0]}", keyword AS "{R.output_columns[1]}",
            CAST(CAST(round(sum(revenue), 2) AS DECIMAL(38,2)) AS VARCHAR) AS "{R.output_columns[2]}"
          FROM ({FIRST_CREDIT}) GROUP BY domain, keyword HAVING round(sum(revenue), 2) > 0""",
        "error_files": DIRT
        + f""" SELECT _error_reason AS reason, nullif(ip, '') AS ip, count(*) AS row_count FROM (
            SELECT {_masked_columns(('ip',))}, _error_reason FROM ({_null_rejects()} UNION ALL {_dup_rejects(_MIN)}))
          GROUP BY ALL""",
        "quality_report_file": DIRT
        + f""", s AS (SELECT count(*) AS n, count(*) FILTER ({NULL_CRITICAL}) AS bad,
            sum({' + '.join(f"({BLANK[c]})::INT" for c in R.critical_columns)})::BIGINT AS reasons FROM dirty),
          k AS (SELECT count(*) AS after FROM (SELECT DISTINCT k1, k2, k3 FROM (SELECT {KEY} FROM dirty WHERE {_MIN})))
          SELECT bad = 0 AS overall_passed, n AS rows_in, after AS rows_out, reasons + n - bad - after AS error_count, c.*
          FROM s, k, LATERAL (
            SELECT 'schema_validation' AS check_name, true AS passed, NULL::BIGINT AS critical_failures,
              NULL::BIGINT AS duplicate_count, NULL::BIGINT AS rows_before, NULL::BIGINT AS rows_after
            UNION ALL SELECT 'null_validation', bad = 0, bad, NULL, NULL, NULL
            UNION ALL SELECT 'duplicate_check', true, NULL, n - bad - after, n - bad, after) c""",
        "lineage_file": RUN
        + f""" SELECT 'run-0001' AS run_id, 'raw/phase2/hits_20240131_000000.tab' AS input_file,
            (SELECT count(*) FROM dirty) AS input_rows,
            (SELECT count(*) FROM ({_KEYWORD_REVENUE.format(credit=FIRST_CREDIT)})) AS output_rows,
            'pyspark' AS engine_used, (SELECT count(*) FROM dirty WHERE {NULL_CRITICAL}) = 0 AS dq_passed,
            'first_touch' AS attribution_model, 'SUCCESS' AS status""",
        "partitioned_parquet": FIRST
        + f""" SELECT *, 'phase2' AS phase, '2024' AS "year", '02' AS "month", '01' AS "day"
          FROM ({_KEYWORD_REVENUE.format(credit=FIRST_CREDIT)})""",
    }
    assert LENIENT.critical_columns == TYPED.critical_columns == R.critical_columns
    return sql
