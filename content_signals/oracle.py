"""Check SQL: what each query of ``catalog.py`` must give, written for DuckDB.

The SQL repeats the derivations of ``tables.py`` and works from the definitions
of the operators, not from their Spark code.
"""

from __future__ import annotations

from content_signals.constants import (
    DEFAULT_FORMAT,
    DEFAULT_HINT,
    DEFAULT_ROLE,
    DEFAULT_RULES,
    LEGACY_BASE_PROMPT,
    LEGACY_FORMAT,
    LEGACY_GOALS,
    LEGACY_LEVELS,
    PAYLOAD_CONSTRAINTS,
    PAYLOAD_GOAL,
    READY_COLUMNS,
    STOPWORDS,
    WHITESPACE,
)
from content_signals.tables import (
    AS_OF,
    KEYWORDS,
    LINKS,
    MANUAL_SCORES,
    NICHES,
    SAMPLE_TEMPLATE,
    STRATEGIES,
    URL_STEMS,
)

SQL: dict[str, str] = {}


def _q(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _strip(col: str) -> str:
    return f"trim({col}, {_q(WHITESPACE)})"


def _pick(key: str, values: list[str | None]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_q(v)}" for i, v in enumerate(values))
    return f"(CASE {key} % {len(values)} {whens} END)"


def _in(values: list[str]) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


# --- the tables of tables.py -----------------------------------------------

_SRC = f"""
lab AS (
  SELECT doc_id, max(toxic) AS toxic, max(quality) AS quality FROM labels GROUP BY doc_id
), stamped AS (
  SELECT d.*, lab.toxic, lab.quality,
         TIMESTAMP '2024-01-01' + to_hours(CAST(d.doc_id % 20000 AS INTEGER)) AS ts
  FROM documents d LEFT JOIN lab ON d.doc_id = lab.doc_id
), src AS (
  SELECT doc_id AS ord,
    {_pick("doc_id", URL_STEMS)} || CAST(doc_id // 8 AS VARCHAR) AS source_url,
    {_pick("doc_id", NICHES)} AS niche,
    lang,
    CASE WHEN toxic = 1 THEN 'AVOID' WHEN quality = 1 THEN 'FREE_REPOST'
         WHEN quality = 0 THEN ' inspire_only ' ELSE '' END AS rights,
    {_pick("doc_id", STRATEGIES)} AS usage_strategy,
    CASE WHEN doc_id % 9 = 0 THEN ' Instagram ' ELSE '' END AS origin_platform,
    {_pick("doc_id", MANUAL_SCORES)} AS manual_score,
    CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS title,
    text AS notes,
    CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN 'unknown'
         WHEN doc_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
         WHEN doc_id % 3 = 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
         ELSE strftime(ts, '%Y/%m/%d') END AS published_at,
    CASE WHEN doc_id % 11 = 0 OR doc_id % 13 = 0 THEN NULL
         WHEN doc_id % 3 = 2 THEN date_trunc('day', ts) ELSE ts END AS published_ts
  FROM stamped
)"""

_NORM = f"""{_SRC}, norm AS (
  SELECT * REPLACE (
      upper(coalesce(nullif({_strip("niche")}, ''), 'MOTIVATION')) AS niche,
      upper(coalesce(nullif({_strip("lang")}, ''), 'FR')) AS lang,
      upper(coalesce(nullif({_strip("rights")}, ''), 'REWRITE_REQUIRED')) AS rights,
      lower(coalesce(nullif({_strip("usage_strategy")}, ''), 'viral')) AS usage_strategy,
      {_strip("origin_platform")} AS origin_platform,
      {_strip("coalesce(notes, '')")} AS notes),
    {_strip("source_url")} AS content_url,
    'Source from ' || {_strip("source_url")} AS raw_text
  FROM src
)"""

_PLATFORM = """CASE WHEN origin_platform <> '' THEN upper(origin_platform)
  WHEN contains(lower(content_url), 'youtube') OR contains(lower(content_url), 'youtu.be')
    THEN 'YOUTUBE'
  WHEN contains(lower(content_url), 'tiktok') THEN 'TIKTOK'
  WHEN contains(lower(content_url), 'facebook') OR contains(lower(content_url), 'fb.watch')
    THEN 'FACEBOOK'
  ELSE 'OTHER' END"""

_NUMBER = f"""CASE WHEN regexp_full_match({_strip("manual_score")},
    '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')
  THEN CAST(trunc(TRY_CAST({_strip("manual_score")} AS DOUBLE)) AS BIGINT) END"""


def _blend(auto: str, manual: str) -> str:
    mix = (
        f"CAST({auto} AS DOUBLE) * CAST(0.6 AS DOUBLE)"
        f" + CAST({manual} AS DOUBLE) * CAST(0.4 AS DOUBLE)"
    )
    return f"CAST(trunc(greatest(0.0::DOUBLE, least(100.0::DOUBLE, {mix}))) AS INTEGER)"


_SCORED = f"""{_NORM}, named AS (
  SELECT * REPLACE (
      {_PLATFORM} AS origin_platform,
      CASE WHEN rights IN ('FREE_REPOST', 'REWRITE_REQUIRED', 'INSPIRE_ONLY', 'AVOID')
           THEN rights ELSE 'REWRITE_REQUIRED' END AS rights,
      CASE WHEN usage_strategy IN ('viral', 'education', 'inspiration')
           THEN usage_strategy ELSE 'viral' END AS usage_strategy)
  FROM norm
), auto AS (
  SELECT *, CAST(greatest(0, least(100,
      30 + CASE WHEN niche IN ('MOTIVATION', 'BUSINESS') THEN 25 ELSE 0 END
         + CASE WHEN lang = 'FR' THEN 20 ELSE 0 END
         + CASE rights WHEN 'FREE_REPOST' THEN 20 WHEN 'REWRITE_REQUIRED' THEN 10
                       WHEN 'INSPIRE_ONLY' THEN 5 ELSE -30 END)) AS INTEGER) AS priority_score
  FROM named
), manual AS (
  SELECT *, 'PENDING' AS reviewer_decision, '' AS reviewer_notes,
    coalesce({_NUMBER}, CAST(priority_score AS BIGINT)) AS manual_priority_score
  FROM auto
), scored AS (
  SELECT *, {_blend("priority_score", "manual_priority_score")} AS blended_priority_score,
    CASE WHEN rights = 'AVOID' THEN 'FILTERED' ELSE 'READY_TO_GENERATE' END AS status
  FROM manual
)"""

_GOALS = SAMPLE_TEMPLATE["content_goals"]
_LEVELS = SAMPLE_TEMPLATE["transformation_levels"]
_BASE = SAMPLE_TEMPLATE["base_prompt"]


def _goal(part: str) -> str:
    return (
        f"CASE usage_strategy WHEN 'education' THEN {_q(_GOALS['education'][part])}"
        f" ELSE {_q(_GOALS['viral'][part])} END"
    )


# the sample set has no level for AVOID, so that falls back on the rewrite level
_LEVEL = (
    f"CASE rights WHEN 'FREE_REPOST' THEN {_q(_LEVELS['repost'])}"
    f" WHEN 'INSPIRE_ONLY' THEN {_q(_LEVELS['inspire'])} ELSE {_q(_LEVELS['rewrite'])} END"
)


def _prompt(role: str, rules: str, objective: str, tone: str, level: str, form: str,
            hint: str | None) -> str:
    lines = [
        f"'ROLE: ' || {role}",
        f"'RULES: ' || {rules}",
        f"'OBJECTIVE: ' || {objective}",
        f"'TONE: ' || {tone}",
        f"'TRANSFORMATION: ' || {level}",
        "'NICHE: ' || niche",
        "'LANGUAGE: ' || lang",
        "'SOURCE: ' || content_url",
        "'PRIORITY_SCORE: ' || CAST(blended_priority_score AS VARCHAR)",
        "'EDITOR_NOTES: ' || coalesce(nullif(notes, ''), 'None')",
        f"'FORMAT: ' || {form}",
    ]
    if hint:
        lines.append(_q("AI_ENHANCEMENT_HINT: " + hint))
    text = " || chr(10) || ".join(f"({line})" for line in lines)
    return f"CASE WHEN rights = 'AVOID' THEN '' ELSE {text} END"


_SAMPLE_PROMPT = _prompt(
    _q(_BASE["role"]),
    _q("; ".join(_BASE["rules"])),
    f"({_goal('objective')})",
    f"({_goal('tone')})",
    f"({_LEVEL})",
    _q(_BASE["format"]),
    DEFAULT_HINT,
)

_TITLE_CASE = (
    r"array_to_string(list_transform(regexp_extract_all(lower(niche), '\p{L}+|\P{L}+'),"
    " lambda w: upper(w[1]) || w[2:]), '')"
)
_CAPTION = f"{_TITLE_CASE} || ' | ' || lang || ' | Source: ' || content_url"
_PAYLOAD = f"""'{{"input_prompt": ' || CAST(to_json(final_prompt) AS VARCHAR)
  || ', "goal": "{PAYLOAD_GOAL}", "constraints": ["{'", "'.join(PAYLOAD_CONSTRAINTS)}"], "metadata": '
  || '{{"niche": ' || CAST(to_json(niche) AS VARCHAR)
  || ', "lang": ' || CAST(to_json(lang) AS VARCHAR)
  || ', "usage_strategy": ' || CAST(to_json(usage_strategy) AS VARCHAR)
  || ', "blended_priority_score": ' || CAST(blended_priority_score AS VARCHAR) || '}}}}'"""

# One row per URL, the first; rendered, rated and flagged.
_READY = f"""{_SCORED}, firsts AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY ord) = 1
), prompted AS (
  SELECT *, {_SAMPLE_PROMPT} AS final_prompt FROM firsts
), faults AS (
  SELECT *, length(final_prompt) < 180 AS f1, NOT contains(final_prompt, 'ROLE:') AS f2,
    NOT contains(final_prompt, 'OBJECTIVE:') AS f3, NOT contains(final_prompt, 'SOURCE:') AS f4
  FROM prompted
), rated AS (
  SELECT *,
    CASE WHEN f1 OR f2 OR f3 OR f4 THEN concat_ws('|',
      CASE WHEN f1 THEN 'prompt_too_short' END, CASE WHEN f2 THEN 'missing_role' END,
      CASE WHEN f3 THEN 'missing_objective' END, CASE WHEN f4 THEN 'missing_source' END)
      ELSE 'OK' END AS prompt_quality_flags,
    CAST(100 - CASE WHEN f1 THEN 25 ELSE 0 END - CASE WHEN f2 THEN 20 ELSE 0 END
      - CASE WHEN f3 THEN 20 ELSE 0 END - CASE WHEN f4 THEN 20 ELSE 0 END AS INTEGER)
      AS prompt_quality_score,
    length(final_prompt) > 0 AS prompt_generated,
    length(final_prompt) > 0 AND status <> 'FILTERED' AS content_ready
  FROM faults
), ready AS (
  SELECT *, 'default' AS prompt_template, false AS processed,
    'master_sources.csv' AS source_file,
    '[' || niche || '] Hook idea from ' || content_url AS title_seed,
    {_CAPTION} AS caption_seed,
    CASE WHEN content_ready THEN 'READY_FOR_AI' ELSE 'SKIPPED' END AS ai_status,
    {_PAYLOAD} AS ai_enhancement_payload
  FROM rated
)"""

_READY_LIST = ", ".join(READY_COLUMNS)
_PROMPT_LIST = f"{_READY_LIST}, final_prompt, prompt_quality_flags, raw_text, ai_enhancement_payload"

_LINK = f"""
link AS (
  SELECT doc_id AS ord, source AS title,
    replace({_pick("doc_id", LINKS)}, '{{k}}', CAST(doc_id // 20 AS VARCHAR)) AS source_url
  FROM documents
)"""


def _video_id(col: str) -> str:
    """Video id of a link column."""
    url = f"(CASE WHEN starts_with({col}, '/') THEN 'https://www.youtube.com' || {col} ELSE {col} END)"
    path = f"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
    query = f"regexp_extract({url}, '^[^?#]*\\?([^#]*)', 1)"
    value = f"regexp_extract({query}, '(?:^|&)v=([^&]+)', 1)"
    short = f"regexp_extract({url}, '(?:youtu\\.be/|/shorts/)([A-Za-z0-9_-]{{6,}})', 1)"
    return (
        f"(CASE WHEN {path} = '/watch' THEN nullif(url_decode(replace({value}, '+', ' ')), '')"
        f" ELSE nullif({short}, '') END)"
    )


def _watch_url(col: str) -> str:
    return (
        "('https://www.youtube.com/watch?v=' || CASE WHEN starts_with("
        f"{col}, 'http') OR starts_with({col}, '/') THEN {_video_id(col)}"
        f" ELSE nullif({col}, '') END)"
    )


_VIDEO = """
vid AS (
  SELECT event_id AS ord, event_type AS query,
    CASE WHEN event_id % 17 = 0 THEN '' ELSE 'v' || CAST(event_id // 2 AS VARCHAR) END AS id,
    'youtube' AS platform,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE 'Clip ' || CAST(event_id AS VARCHAR) END AS title,
    'channel ' || CAST(user_id AS VARCHAR) AS channel,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS published_at,
    CASE WHEN event_id % 19 = 0 THEN 0 ELSE CAST(floor(value * 100) AS BIGINT) END AS views,
    props AS description,
    coalesce(json_extract_string(props, '$.k'), '') AS categoryId,
    CASE WHEN event_id % 2 = 0 THEN event_type || ',' || CAST(user_id AS VARCHAR) ELSE '' END AS tags,
    user_id AS likeCount,
    CASE WHEN event_id % 7 <> 0 THEN event_id % 100 ELSE 0 END AS commentCount
  FROM events
), spec AS (
  SELECT event_type AS query, CASE WHEN event_type = 'purchase' THEN 'HIGH' ELSE 'MEDIUM' END
      AS priority, count(*) // 2 AS max_results, CAST(length(event_type) * 2500 AS BIGINT) AS min_views,
    min(event_id) AS ord
  FROM events GROUP BY event_type
)"""
_VIDEO_FIELDS = (
    "vid.ord AS event_id, platform, id, title, channel, views, published_at, description,"
    " categoryId, likeCount, commentCount, tags"
)


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


# --- sources ---------------------------------------------------------------

SQL["read_sources"] = _with(
    _SRC,
    """SELECT source_url, nullif(niche, '') AS niche, lang, nullif(rights, '') AS rights,
  nullif(usage_strategy, '') AS usage_strategy, nullif(origin_platform, '') AS origin_platform,
  nullif(manual_score, '') AS manual_score, nullif(title, '') AS title, nullif(notes, '') AS notes,
  published_at FROM src""",
)
SQL["add_defaults"] = _with(
    _SRC,
    """SELECT ord AS doc_id, origin_platform, 'default' AS prompt_template, false AS processed,
  '' AS notes, 'master_sources.csv' AS source_file FROM src""",
)
SQL["read_sources_dir"] = _with(
    _SRC,
    """SELECT source_url, nullif(title, '') AS title, nullif(niche, '') AS niche,
  CASE WHEN title = '' THEN lang END AS lang,
  CASE WHEN title = '' THEN nullif(rights, '') END AS rights, true AS from_part FROM src""",
)
SQL["read_query_specs"] = """
SELECT 'topic ' || CAST(doc_id AS VARCHAR) AS query,
  CASE doc_id % 4 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS priority,
  CAST(CASE doc_id % 5 WHEN 2 THEN -1 WHEN 3 THEN 15 ELSE 30 END AS BIGINT) AS max_results,
  CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id END AS min_views
FROM documents WHERE lang <> 'de'"""
SQL["video_items_from_json"] = _with(
    _VIDEO,
    """SELECT query, 'https://www.youtube.com/watch?v=' || id AS source_url, title, published_at,
  channel, id FROM vid WHERE id <> ''""",
)
_MIXED = f"""{_VIDEO}, mixed AS (
  SELECT vid.*, CASE ord % 4 WHEN 0 THEN 'query' WHEN 1 THEN 'channel' WHEN 2 THEN 'playlist' END AS kind
  FROM vid WHERE id <> ''
)"""
SQL["mixed_video_items"] = _with(
    _MIXED,
    """SELECT kind, CASE WHEN kind IS NOT NULL THEN query END AS source,
  'https://www.youtube.com/watch?v=' || id AS source_url, title, published_at, channel, id FROM mixed""",
)
SQL["run_landed_collection"] = _with(
    f"""{_MIXED}, early AS (
  SELECT *, CASE kind WHEN 'query' THEN 0 WHEN 'channel' THEN 1 ELSE 2 END AS place
  FROM mixed WHERE kind IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY kind, query ORDER BY ord // 200, ord) <= 10
), unique_item AS (
  SELECT * FROM early QUALIFY row_number() OVER (PARTITION BY id ORDER BY place, query, ord // 200, ord) = 1
)""",
    """SELECT 'https://www.youtube.com/watch?v=' || id AS source_url, '' AS niche, '' AS lang, '' AS rights,
  '' AS usage_strategy, 'YOUTUBE' AS origin_platform, title FROM unique_item""",
)
SQL["ingest_link_drops"] = """
SELECT url AS source_url, 'MOTIVATION' AS niche, false AS processed FROM pages"""

# --- dedup, padding, limits ------------------------------------------------

SQL["dedup_sources"] = _with(
    _SRC,
    """SELECT ord AS doc_id, source_url, title FROM src
QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY ord) = 1""",
)
SQL["dedup_by_watch_url"] = _with(
    f"""{_SRC}, resolved AS (SELECT ord, title, {_watch_url("source_url")} AS url FROM src)""",
    """SELECT ord AS doc_id, url AS source_url, title FROM resolved WHERE url IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1""",
)
SQL["dedup_video_ids"] = _with(
    _VIDEO,
    """SELECT ord AS event_id, id, query, title, views FROM vid WHERE id <> ''
QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1""",
)
SQL["pad_to_minimum"] = """
WITH found AS (
  SELECT DISTINCT 'https://www.youtube.com/watch?v=' ||
    regexp_extract('https://youtu.be/lang-' || lang, 'youtu\\.be/([A-Za-z0-9_-]{6,})', 1) AS source_url
  FROM documents
), seeds AS (
  SELECT 'https://www.youtube.com/watch?v=demo_seed_' || CAST(i AS VARCHAR) AS source_url
  FROM range(1, 11) r(i) WHERE i <= 10 - (SELECT count(*) FROM found)
)
SELECT source_url, '' AS niche, '' AS lang, '' AS rights, '' AS usage_strategy,
  'YOUTUBE' AS origin_platform FROM (SELECT * FROM found UNION ALL SELECT * FROM seeds)"""
_PLACED = f"""{_VIDEO}, placed AS (
  SELECT vid.*, max_results, row_number() OVER (PARTITION BY vid.query ORDER BY vid.ord) AS place
  FROM vid JOIN spec ON vid.query = spec.query WHERE id <> ''
)"""
SQL["top_n_per_query"] = _with(
    _PLACED, "SELECT ord AS event_id, query, id FROM placed WHERE place <= max_results"
)
SQL["first_pages_per_query"] = _with(
    f"""{_VIDEO}, paged AS (
  SELECT vid.*, ord // 50 AS page, min(ord // 50) OVER (PARTITION BY query) AS first_page FROM vid
), early AS (
  SELECT paged.*, max_results,
    row_number() OVER (PARTITION BY paged.query ORDER BY paged.ord) AS place
  FROM paged JOIN spec ON paged.query = spec.query WHERE page < first_page + 3 AND id <> ''
)""",
    "SELECT ord AS event_id, query, id FROM early WHERE place <= max_results",
)
SQL["concat_collections"] = _with(
    _VIDEO,
    """SELECT query AS source, id, 0 AS kind, ord AS event_id FROM vid
UNION ALL SELECT channel, id, 1, ord FROM vid WHERE views >= 5000
UNION ALL SELECT 'list-' || categoryId, id, 2, ord FROM vid""",
)

# --- projections, filters --------------------------------------------------

SQL["resolve_content_url"] = _with(
    _LINK, f"SELECT ord AS doc_id, {_strip('coalesce(source_url, chr(32))')} AS content_url FROM link"
)
SQL["min_views_filter"] = _with(
    _VIDEO,
    """SELECT vid.ord AS event_id, vid.query, id, views FROM vid JOIN spec ON vid.query = spec.query
WHERE views >= min_views""",
)
SQL["valid_items_filter"] = _with(
    _VIDEO, "SELECT ord AS event_id, platform, id FROM vid WHERE id <> ''"
)
SQL["quality_filter"] = _with(
    _VIDEO, "SELECT ord AS event_id, id, title, views * 2 AS views FROM vid WHERE title <> ''"
)
SQL["ready_projection"] = _with(_READY, f"SELECT {_READY_LIST} FROM ready")
SQL["prompts_projection"] = _with(_READY, f"SELECT {_PROMPT_LIST} FROM ready")
SQL["master_projection"] = _with(
    f"{_LINK}, resolved AS (SELECT ord, title, {_watch_url('source_url')} AS url FROM link)",
    """SELECT url AS source_url, 'STORY' AS niche, 'EN' AS lang, '' AS rights,
  '' AS usage_strategy, 'YOUTUBE' AS origin_platform, ord AS doc_id, title
FROM resolved WHERE url IS NOT NULL""",
)
SQL["duration_views_filter"] = _with(
    f"""{_VIDEO}, timed AS (
  SELECT *, CASE WHEN ord % 10 = 0 THEN 3600 ELSE 0 END
    + CASE WHEN ord % 4 <> 0 THEN 60 * (ord % 40) ELSE 0 END + ord % 60 AS duration_sec
  FROM vid
)""",
    """SELECT ord AS event_id, id, views, duration_sec, ((views + 5) // 10) / 100.0::DOUBLE AS score
FROM timed WHERE views >= 1000 AND duration_sec BETWEEN 60 AND 1800""",
)

# --- text, URL and JSON columns --------------------------------------------

SQL["normalize_text"] = _with(
    _NORM,
    "SELECT ord AS doc_id, niche, lang, rights, usage_strategy, origin_platform, notes FROM norm",
)
SQL["derive_raw_text"] = _with(_NORM, "SELECT ord AS doc_id, content_url, raw_text FROM norm")
SQL["derive_raw_text_draft"] = _with(
    _SRC, "SELECT ord AS doc_id, 'Source: ' || origin_platform AS raw_text FROM src"
)
SQL["infer_platform"] = _with(
    _NORM, f"SELECT ord AS doc_id, content_url, {_PLATFORM} AS origin_platform FROM norm"
)
SQL["normalize_rights"] = _with(
    _SRC,
    """SELECT ord AS doc_id, CASE upper(trim(rights)) WHEN 'AVOID' THEN 'AVOID'
  WHEN 'FREE_REPOST' THEN 'FREE_REPOST' WHEN 'INSPIRE_ONLY' THEN 'INSPIRE_ONLY'
  ELSE 'REWRITE_REQUIRED' END AS rights FROM src""",
)
SQL["normalize_strategy"] = _with(
    _SRC,
    """SELECT ord AS doc_id, CASE WHEN lower(usage_strategy) IN ('education', 'inspiration')
  THEN lower(usage_strategy) ELSE 'viral' END AS usage_strategy FROM src""",
)
SQL["infer_niche"] = f"""
WITH told AS (
  SELECT doc_id, {_pick("doc_id", ["", " ", "story "] + [""] * 4)} AS niche,
    lower(text || ' ' || {_pick("doc_id", KEYWORDS)}) AS raw FROM documents
)
SELECT doc_id, CASE WHEN trim(niche) <> '' THEN upper(trim(niche))
  WHEN regexp_matches(raw, 'business|money|entrepreneur') THEN 'BUSINESS'
  WHEN regexp_matches(raw, 'health|fitness|wellness') THEN 'HEALTH'
  WHEN regexp_matches(raw, 'story|emotion|histoire') THEN 'STORY'
  WHEN regexp_matches(raw, 'education|learn|tutorial') THEN 'EDUCATION'
  ELSE 'MOTIVATION' END AS niche FROM told"""
SQL["extract_video_id"] = _with(
    _LINK, f"SELECT ord AS doc_id, source_url, {_video_id('source_url')} AS video_id FROM link"
)
SQL["canonical_watch_url"] = _with(
    _LINK, f"SELECT ord AS doc_id, source_url, {_watch_url('source_url')} AS watch_url FROM link"
)
# Anchors of the test pages: <a href="...">text</a>, no markup within, no title.
_ANCHORS = """
anchor AS (
  SELECT page_id, unnest(regexp_extract_all(html, '<a href="[^"]*">[^<]*')) AS a,
    unnest(range(len(regexp_extract_all(html, '<a href="[^"]*">[^<]*')))) AS i FROM pages
), hit AS (
  SELECT page_id, i, regexp_extract(a, 'href="([^"]*)"', 1) AS href,
    trim(regexp_extract(a, '>([^<]*)$', 1)) AS title FROM anchor
), page_link AS (
  SELECT * FROM hit WHERE contains(href, '/')
  QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY i) = 1
)"""
_POS = "CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos"
SQL["extract_page_links"] = _with(
    _ANCHORS, f"SELECT page_id, {_POS}, href AS source_url, title FROM page_link"
)
_WATCH_HIT = """watch_hit AS (
  SELECT page_id, i, title,
    nullif(regexp_extract(substr(href, 2), '^([^#&]*)', 1), '') AS v
  FROM hit WHERE starts_with(href, '/')
), watch_link AS (
  SELECT page_id, i, title, 'https://www.youtube.com/watch?v=' || url_decode(replace(v, '+', ' '))
    AS source_url
  FROM watch_hit WHERE v IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY page_id, url_decode(replace(v, '+', ' ')) ORDER BY i) = 1
), watch_placed AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS place FROM watch_link
)"""
SQL["extract_watch_links"] = _with(
    f"{_ANCHORS}, {_WATCH_HIT}",
    """SELECT page_id, CAST(place - 1 AS INTEGER) AS pos, source_url, title FROM watch_placed""",
)
SQL["extract_raw_watch_links"] = _with(
    f"""{_ANCHORS}, raw_link AS (
  SELECT page_id, i, regexp_extract(href, '^/([A-Za-z0-9_-]{{6,}})', 1) AS v FROM hit
), raw_first AS (
  SELECT * FROM raw_link WHERE v <> ''
  QUALIFY row_number() OVER (PARTITION BY page_id, v ORDER BY i) = 1
), raw_placed AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY i) AS place FROM raw_first
)""",
    """SELECT page_id, CAST(place - 1 AS INTEGER) AS pos,
  'https://www.youtube.com/watch?v=' || v AS source_url, '' AS title
FROM raw_placed WHERE place <= 50""",
)
# Percent-encoding of UTF-8 text with a plus for a blank; only - _ . ~ stay besides letters, digits.
SQL["search_urls"] = """
SELECT doc_id, 'https://www.youtube.com/results?search_query=' ||
  replace(url_encode(text), '%20', '+') AS search_url FROM documents"""
SQL["source_ids"] = """
SELECT page_id,
  CASE WHEN page_id % 4 = 0 THEN 'UC_' || CAST(page_id AS VARCHAR)
       WHEN page_id % 4 = 1 THEN 'UC-' || CAST(page_id AS VARCHAR)
       ELSE nullif(regexp_extract(url, '/channel/([A-Za-z0-9_-]+)', 1), '') END AS channel_id,
  CASE WHEN page_id % 2 = 1 THEN 'PL' || CAST(page_id AS VARCHAR)
       WHEN contains(url, '?') AND NOT contains(url, '#') THEN 'PL ' || CAST(page_id AS VARCHAR) || '!'
       ELSE url || '&list=PL+' || CAST(page_id AS VARCHAR) || '%21' END AS playlist_id,
  CASE WHEN page_id % 3 = 0 THEN url ELSE rtrim(url, '/') END || '/videos' AS videos_url
FROM pages"""
SQL["normalize_videos"] = _with(_VIDEO, f"SELECT {_VIDEO_FIELDS} FROM vid")
SQL["attribute_query"] = _with(
    _VIDEO,
    f"""SELECT {_VIDEO_FIELDS}, vid.query, priority AS query_priority
FROM vid JOIN spec ON vid.query = spec.query WHERE views >= min_views""",
)
SQL["seed_fields"] = _with(
    _NORM,
    f"""SELECT ord AS doc_id, '[' || niche || '] Hook idea from ' || content_url AS title_seed,
  {_CAPTION} AS caption_seed, raw_text FROM norm""",
)
SQL["ai_payload"] = _with(_READY, "SELECT ord AS doc_id, ai_enhancement_payload FROM ready")
SQL["ai_status"] = _with(
    _READY, "SELECT ord AS doc_id, prompt_generated, content_ready, ai_status FROM ready"
)

# --- scores ----------------------------------------------------------------

SQL["priority_score"] = _with(_SCORED, "SELECT ord AS doc_id, priority_score FROM scored")
SQL["manual_score"] = _with(
    _SCORED,
    """SELECT ord AS doc_id, manual_score, reviewer_decision, reviewer_notes,
  manual_priority_score FROM scored""",
)
SQL["blended_score"] = _with(
    _SCORED,
    f"""SELECT ord AS doc_id, blended_priority_score,
  {_blend("(ord % 101)", "((ord // 101 + ord * 7) % 101)")} AS swept FROM scored""",
)
SQL["status"] = _with(_SCORED, "SELECT ord AS doc_id, rights, status FROM scored")
SQL["legacy_score"] = _with(
    _NORM,
    """SELECT ord AS doc_id, CAST(CASE WHEN niche IN ('MOTIVATION', 'BUSINESS') THEN 3 ELSE 0 END
  + CASE WHEN lang = 'FR' THEN 2 ELSE 0 END AS INTEGER) AS legacy_score FROM norm""",
)

# --- prompts ---------------------------------------------------------------

_SETS = f"""
sets AS (
  SELECT ord, 'set-' || CAST(ord AS VARCHAR) AS template, title AS objective, lang AS tone,
    source_url AS rewrite,
    CASE WHEN ord % 3 <> 0 THEN 'Editor of ' || lang ELSE {_q(DEFAULT_ROLE)} END AS role,
    CASE WHEN ord % 2 = 0 THEN 'Be short; ' || notes ELSE {_q("; ".join(DEFAULT_RULES))} END AS rules,
    CASE WHEN ord % 5 <> 0 THEN 'Plain text' ELSE {_q(DEFAULT_FORMAT)} END AS form
  FROM src
)"""
SQL["template_dims"] = _with(
    f"{_SRC}, {_SETS}",
    """SELECT template, 'base' AS dim, role AS key, rules AS first, form AS second FROM sets
UNION ALL SELECT template, 'goal', 'viral', objective, tone FROM sets
UNION ALL SELECT template, 'goal', 'goal-' || tone, objective, tone FROM sets
UNION ALL SELECT template, 'level', 'rewrite', rewrite, '' FROM sets""",
)
SQL["template_lookup"] = _with(
    _SCORED,
    f"""SELECT ord AS doc_id, {_goal("objective")} AS objective, {_goal("tone")} AS tone,
  {_LEVEL} AS transformation FROM scored""",
)
SQL["render_prompt"] = _with(
    _SCORED, f"SELECT ord AS doc_id, {_SAMPLE_PROMPT} AS final_prompt FROM scored"
)
SQL["render_prompt_by_template"] = _with(
    f"""{_SCORED}, {_SETS}, chosen AS (
  SELECT scored.*, s.role, s.rules, s.form, s.objective, s.tone, s.rewrite
  FROM scored LEFT JOIN sets s
    ON s.template = CASE WHEN scored.ord % 4 <> 0 THEN 'set-' || CAST(scored.ord // 2 AS VARCHAR) END
)""",
    "SELECT ord AS doc_id, "
    + _prompt(
        f"coalesce(role, {_q(_BASE['role'])})",
        f"coalesce(rules, {_q('; '.join(_BASE['rules']))})",
        f"(CASE WHEN role IS NULL THEN {_goal('objective')} ELSE objective END)",
        f"(CASE WHEN role IS NULL THEN {_goal('tone')} ELSE tone END)",
        f"(CASE WHEN role IS NULL THEN {_LEVEL} ELSE rewrite END)",
        f"coalesce(form, {_q(_BASE['format'])})",
        None,
    )
    + " AS final_prompt FROM chosen",
)
SQL["prompt_quality"] = _with(
    _READY, "SELECT ord AS doc_id, prompt_quality_flags, prompt_quality_score FROM ready"
)
SQL["ready_flags"] = _with(
    _READY, "SELECT ord AS doc_id, status, prompt_generated, content_ready FROM ready"
)
_LEGACY_TEXT = " || chr(10) || chr(10) || ".join(
    f"('{head}:' || chr(10) || {body})"
    for head, body in (
        ("ROLE", _q(LEGACY_BASE_PROMPT)),
        (
            "OBJECTIVE",
            f"CASE lower(usage_strategy) WHEN 'education' THEN {_q(LEGACY_GOALS['education'])}"
            f" ELSE {_q(LEGACY_GOALS['viral'])} END",
        ),
        # of the five test rights the second and third name a level, the others are rewritten
        (
            "TRANSFORMATION RULE",
            f"CASE ord % 5 WHEN 1 THEN {_q(LEGACY_LEVELS['summary'])} WHEN 2 THEN {_q(LEGACY_LEVELS['none'])}"
            f" ELSE {_q(LEGACY_LEVELS['rewrite'])} END",
        ),
        ("NICHE", "niche"),
        ("SOURCE URL", "source_url"),
        ("LANGUAGE", "lang"),
        ("FORMAT", _q(LEGACY_FORMAT)),
    )
)
SQL["render_prompt_legacy"] = _with(
    _SRC,
    f"""SELECT ord AS doc_id, {_LEGACY_TEXT} AS final_prompt, true AS prompt_generated,
  true AS content_ready FROM src""",
)
_DRAFT_TEXT = " || chr(10) || ".join(
    f"('{label}: ' || {value})"
    for label, value in (
        ("ROLE", _q(_BASE["role"])),
        ("RULES", _q("; ".join(_BASE["rules"]))),
        ("OBJECTIVE", _goal("objective").replace("usage_strategy", "lower(usage_strategy)")),
        ("TONE", _goal("tone").replace("usage_strategy", "lower(usage_strategy)")),
        ("SOURCE", "source_url"),
        ("LANGUAGE", "lang"),
        ("FORMAT", _q(_BASE["format"])),
    )
)
SQL["render_prompt_draft"] = _with(
    _SRC, f"SELECT ord AS doc_id, {_DRAFT_TEXT} AS final_prompt FROM src"
)

# --- trends ----------------------------------------------------------------

_AGE = f"""{_SRC}, aged AS (
  SELECT *, (epoch_us(TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}') - epoch_us(published_ts))
    / 1000000.0::DOUBLE / 86400.0::DOUBLE AS age FROM src
), recent AS (
  SELECT *, CASE WHEN age IS NULL THEN 0.5::DOUBLE ELSE
    greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - age / (SELECT greatest(max(age), 1.0::DOUBLE) FROM aged)))
    END AS recency_score FROM aged
)"""


def _keyword_ctes(source: str, text: str) -> str:
    return f"""tokens AS (
  SELECT *, list_filter(regexp_extract_all(lower({text}), '[a-z0-9]+'),
    lambda w: length(w) > 2 AND w NOT IN {_in(STOPWORDS)}) AS kw FROM {source}
), token_n AS (
  SELECT token, count(*) AS n FROM (SELECT unnest(kw) AS token FROM tokens) GROUP BY token
), best AS (
  SELECT w.ord, max(token_n.n) AS n FROM (SELECT ord, unnest(kw) AS token FROM tokens) w
  JOIN token_n ON w.token = token_n.token GROUP BY w.ord
), frequent AS (
  SELECT tokens.ord, coalesce(CAST(best.n AS DOUBLE) / (SELECT max(n) FROM token_n), 0.5::DOUBLE)
    AS frequency_score FROM tokens LEFT JOIN best ON tokens.ord = best.ord
)"""


_KEYWORDS = f"""{_AGE}, {_keyword_ctes(
    "recent", "title || ' ' || notes || ' ' || source_url || ' ' || niche")}, themed AS (
  SELECT *, coalesce(kw[1], upper(coalesce(nullif(niche, ''), 'UNKNOWN'))) AS theme FROM tokens
), theme_n AS (
  SELECT theme, count(*) AS n FROM themed GROUP BY theme
), multi AS (
  SELECT themed.*, CAST(theme_n.n AS DOUBLE) / (SELECT max(n) FROM theme_n) AS multi_source_score
  FROM themed JOIN theme_n ON themed.theme = theme_n.theme
), weighed AS (
  SELECT multi.*, frequency_score, greatest(0.0::DOUBLE, least(1.0::DOUBLE,
    (recency_score * 0.4::DOUBLE + frequency_score * 0.3::DOUBLE
      + multi_source_score * 0.3::DOUBLE) / (0.4::DOUBLE + 0.3::DOUBLE + 0.3::DOUBLE)))
    AS trend_score
  FROM multi JOIN frequent ON multi.ord = frequent.ord
), leveled AS (
  SELECT *, CASE WHEN trend_score >= 0.65::DOUBLE THEN 'HIGH'
    WHEN trend_score >= 0.40::DOUBLE THEN 'MEDIUM' ELSE 'LOW' END AS priority_level FROM weighed
)"""
SQL["recency_score"] = _with(_AGE, "SELECT ord AS doc_id, recency_score FROM recent")
SQL["extract_keywords"] = _with(
    _KEYWORDS, "SELECT ord AS doc_id, array_to_string(kw, ' ') AS keywords FROM tokens"
)
SQL["token_counts"] = _with(_KEYWORDS, "SELECT token, n FROM token_n")
SQL["frequency_score"] = _with(_KEYWORDS, "SELECT ord AS doc_id, frequency_score FROM frequent")
SQL["frequency_score_text_only"] = _with(
    f"{_SRC}, {_keyword_ctes('src', 'notes')}",
    "SELECT ord AS doc_id, frequency_score FROM frequent",
)
SQL["multi_source_score"] = _with(_KEYWORDS, "SELECT ord AS doc_id, multi_source_score FROM multi")
SQL["trend_score"] = _with(_KEYWORDS, "SELECT ord AS doc_id, trend_score FROM weighed")
SQL["priority_level"] = _with(_KEYWORDS, "SELECT ord AS doc_id, priority_level FROM leveled")
SQL["priority_counts"] = _with(
    _KEYWORDS, "SELECT priority_level, count(*) AS n FROM leveled GROUP BY priority_level"
)
SQL["run_trend_scoring"] = _with(
    _KEYWORDS,
    """SELECT ord AS doc_id, recency_score, frequency_score, multi_source_score, trend_score,
  priority_level FROM leveled""",
)

# --- run statistics, requests ----------------------------------------------

SQL["query_stats"] = _with(
    _VIDEO,
    """SELECT spec.query, priority, max_results, min_views,
  count(DISTINCT nullif(id, '')) AS ids, count(*) FILTER (id <> '') AS valid_items,
  count(*) FILTER (id <> '' AND views >= min_views) AS min_views_filtered_items
FROM spec LEFT JOIN vid ON vid.query = spec.query
GROUP BY spec.query, priority, max_results, min_views""",
)
_BATCH = f"""{_VIDEO}, first_seen AS (
  SELECT query, id, min(ord) AS ord FROM vid WHERE id <> '' GROUP BY query, id
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY ord) - 1 AS place FROM first_seen
), batched AS (
  SELECT query, place // 50 AS batch, string_agg(id, ',' ORDER BY place) AS ids,
    CAST(count(*) AS INTEGER) AS n_ids FROM numbered GROUP BY query, place // 50
), quota AS (
  SELECT s.query, search_calls, video_calls,
    search_calls * 100 + n_ids AS quota_units
  FROM (SELECT event_type AS query, count(DISTINCT event_id // 50) AS search_calls
        FROM events GROUP BY event_type) s
  JOIN (SELECT query, count(*) AS video_calls, CAST(sum(n_ids) AS BIGINT) AS n_ids
        FROM batched GROUP BY query) b ON s.query = b.query
)"""
SQL["id_batches"] = _with(_BATCH, "SELECT query, batch, ids, n_ids FROM batched")
SQL["quota_estimate"] = _with(_BATCH, "SELECT * FROM quota")
_UNIQUE = """once AS (
  SELECT * FROM vid WHERE id <> '' QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1
)"""
SQL["run_summary"] = _with(
    f"{_BATCH}, {_UNIQUE}",
    """SELECT 'global_ids_collected' AS metric, (SELECT count(*) FROM once) AS value
UNION ALL SELECT 'rows_after_dedup', (SELECT count(*) FROM once)
UNION ALL SELECT 'rows_after_quality_filter', (SELECT count(*) FROM once WHERE title <> '')
UNION ALL SELECT 'api_search_calls', (SELECT CAST(sum(search_calls) AS BIGINT) FROM quota)
UNION ALL SELECT 'api_videos_calls', (SELECT CAST(sum(video_calls) AS BIGINT) FROM quota)
UNION ALL SELECT 'quota_units_estimated', (SELECT CAST(sum(quota_units) AS BIGINT) FROM quota)""",
)
SQL["pending_fetches"] = """
SELECT user_id, event_type FROM events GROUP BY user_id, event_type
HAVING epoch_us((SELECT max(ts) FROM events)) - epoch_us(max(ts)) > 7 * 86400 * 1000000::BIGINT"""

# --- order, checks, sinks --------------------------------------------------

_RANKED = "ORDER BY blended_priority_score DESC, priority_score DESC, ord"
SQL["rank_for_review"] = _with(
    _READY,
    f"""SELECT ord AS doc_id, blended_priority_score, priority_score,
  row_number() OVER ({_RANKED}) AS rank FROM ready""",
)
SQL["top_n_for_review"] = _with(
    _READY,
    f"SELECT ord AS doc_id, blended_priority_score, priority_score FROM ready {_RANKED} LIMIT 5",
)
SQL["check_columns"] = _with(
    _READY,
    """SELECT 'ready columns' AS "check", true AS ok, '' AS detail
UNION ALL SELECT 'prompts columns', true, ''
UNION ALL SELECT 'master columns', true, ''
UNION ALL SELECT 'ready rows', count(*) = (SELECT count(DISTINCT source_url) FROM src),
  CAST(count(*) AS VARCHAR) FROM ready
UNION ALL SELECT 'prompts rows', count(*) = (SELECT count(DISTINCT source_url) FROM src),
  CAST(count(*) AS VARCHAR) FROM ready
UNION ALL SELECT 'prompts filled', count(*) = 0, CAST(count(*) AS VARCHAR) FROM ready
  WHERE status <> 'FILTERED' AND final_prompt = ''""",
)
SQL["check_row_count"] = _with(
    _SRC,
    """SELECT 'ready rows' AS "check", count(DISTINCT source_url) = 10 AS ok,
  CAST(count(DISTINCT source_url) AS VARCHAR) AS detail FROM src""",
)
# a changed role is one entry gone and one entry new
SQL["check_template_parity"] = """
SELECT 'same' AS "check", true AS ok, '0' AS detail
UNION ALL SELECT 'template parity', count(*) = 0, CAST(2 * count(*) AS VARCHAR)
  FROM documents WHERE doc_id % 10 = 7"""
SQL["check_prompts_nonempty"] = _with(
    _READY,
    """SELECT 'prompts filled' AS "check", count(*) = 0 AS ok, CAST(count(*) AS VARCHAR) AS detail
FROM ready WHERE status <> 'FILTERED' AND final_prompt = ''""",
)
_CSV_CELLS = ", ".join(
    f"CASE WHEN {c} THEN 'True' ELSE 'False' END AS {c}"
    if c in ("processed", "prompt_generated", "content_ready")
    else f"nullif(CAST({c} AS VARCHAR), '') AS {c}"
    for c in READY_COLUMNS
)
SQL["write_csv"] = _with(_READY, f"SELECT {_CSV_CELLS} FROM ready")
SQL["write_master"] = _with(
    f"{_LINK}, resolved AS (SELECT DISTINCT {_watch_url('source_url')} AS url FROM link)",
    """SELECT url AS source_url, 'STORY' AS niche, CAST(NULL AS VARCHAR) AS lang,
  CAST(NULL AS VARCHAR) AS rights, CAST(NULL AS VARCHAR) AS usage_strategy,
  'YOUTUBE' AS origin_platform FROM resolved WHERE url IS NOT NULL""",
)
SQL["write_telemetry"] = SQL["query_stats"].replace(
    "AS min_views_filtered_items",
    "AS min_views_filtered_items, (SELECT count(*) FROM vid) AS \"rows\"",
)


def _named(order: str) -> str:
    return _with(
        f"{_READY}, placed AS (SELECT *, row_number() OVER ({order}) AS place FROM ready)",
        """SELECT 'prompt_' || CASE WHEN place < 1000 THEN lpad(CAST(place AS VARCHAR), 3, '0')
  ELSE CAST(place AS VARCHAR) END AS prompt_name, niche, final_prompt AS text
FROM placed WHERE final_prompt <> ''""",
    )


SQL["export_prompt_text"] = _named(_RANKED)
SQL["export_prompt_text_unranked"] = _named("ORDER BY ord")

# --- whole jobs ------------------------------------------------------------

SQL["ready_and_prompts"] = _with(
    _READY, f"SELECT {_PROMPT_LIST} FROM ready"
)
# Half of a query's hits are taken; a video's details are those of its first event.
_COLLECTED = f"""{_PLACED}, taken AS (
  SELECT query, id, min(ord) AS ord FROM placed WHERE place <= max_results AND id <> ''
  GROUP BY query, id
), detail AS (
  SELECT * FROM vid QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1
), item AS (
  SELECT taken.query, taken.id, taken.ord, spec.ord AS query_ord, priority, min_views,
    title, channel, views
  FROM taken JOIN detail ON taken.id = detail.id JOIN spec ON taken.query = spec.query
), passed AS (
  SELECT * FROM item WHERE views >= min_views
), once AS (
  SELECT * FROM passed QUALIFY row_number() OVER (PARTITION BY id ORDER BY query_ord, ord) = 1
)"""
SQL["run_video_collection"] = _with(
    _COLLECTED,
    "SELECT id, query, priority AS query_priority, title, channel, views FROM once WHERE title <> ''",
)
SQL["video_collection_summary"] = _with(
    f"""{_COLLECTED}, calls AS (
  SELECT (count(*) + 49) // 50 AS n FROM taken GROUP BY query
), reached AS (
  SELECT query, count(*) AS n, max(ord // 50) AS last_page FROM placed
  WHERE place <= max_results GROUP BY query
), asked AS (
  SELECT DISTINCT vid.query, vid.ord // 50 AS page FROM vid JOIN spec ON vid.query = spec.query
  LEFT JOIN reached ON vid.query = reached.query
  WHERE max_results > 0 AND (coalesce(n, 0) < max_results OR vid.ord // 50 <= last_page)
), kept AS (SELECT * FROM once WHERE title <> '')""",
    """SELECT 'queries' AS metric, (SELECT count(*) FROM spec) AS value
UNION ALL SELECT 'global_ids_collected', (SELECT count(DISTINCT id) FROM taken)
UNION ALL SELECT 'rows_after_dedup', (SELECT count(*) FROM once)
UNION ALL SELECT 'rows_after_quality_filter', (SELECT count(*) FROM kept)
UNION ALL SELECT 'rows_final', (SELECT count(*) FROM kept)
UNION ALL SELECT 'api_search_calls', (SELECT count(*) FROM asked)
UNION ALL SELECT 'api_videos_calls', (SELECT CAST(sum(n) AS BIGINT) FROM calls)
UNION ALL SELECT 'cache_hits', 0
UNION ALL SELECT 'quota_units_estimated',
  (SELECT count(*) FROM asked) * 100 + (SELECT count(*) FROM taken)""",
)
SQL["video_collection_stats"] = _with(
    _COLLECTED,
    """SELECT spec.query, spec.priority, max_results, spec.min_views, count(DISTINCT id) AS ids,
  count(id) AS valid_items, count(*) FILTER (views >= spec.min_views) AS min_views_filtered_items
FROM spec LEFT JOIN item ON item.query = spec.query
GROUP BY spec.query, spec.priority, max_results, spec.min_views""",
)
SQL["run_link_collection"] = _with(
    f"""{_ANCHORS}, {_WATCH_HIT}, unique_link AS (
  SELECT source_url, title FROM watch_link
  QUALIFY row_number() OVER (PARTITION BY source_url ORDER BY page_id, i) = 1
)""",
    """SELECT source_url, '' AS niche, '' AS lang, '' AS rights, '' AS usage_strategy,
  'YOUTUBE' AS origin_platform, title FROM unique_link""",
)
SQL["trend_validation"] = _with(
    f"""{_READY}, stored AS (
  SELECT *, coalesce({_watch_url("source_url")}, source_url) AS url FROM ready
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY ord) = 1
), shared AS (
  SELECT ord, CASE WHEN ord % 5 = 0 THEN source_url || '_unknown' ELSE source_url END AS source_url
  FROM src
), keyed AS (
  SELECT *, coalesce({_watch_url("source_url")}, source_url) AS url FROM shared
)""",
    """SELECT keyed.ord AS doc_id, keyed.source_url,
  CAST(CASE WHEN stored.url IS NULL THEN 1 ELSE least(5, 1 + blended_priority_score // 20) END
    AS INTEGER) AS trend_score,
  CASE WHEN stored.url IS NULL THEN 'link not found' ELSE
    'blended score ' || CAST(blended_priority_score AS VARCHAR) || ', status ' || status END
    AS trend_reason,
  coalesce(final_prompt, '') AS improvement_prompt
FROM keyed LEFT JOIN stored ON keyed.url = stored.url""",
)
SQL["run_account"] = f"""
SELECT '{AS_OF:%Y-%m-%dT%H:%M:%S}+00:00' AS started_at, '{AS_OF:%Y-%m-%d}T00:30:00+00:00' AS finished_at,
  (SELECT count(DISTINCT event_type) FROM events) AS query_count, metric, value
FROM ({SQL["video_collection_summary"]})"""
SQL["ready_table"] = SQL["write_csv"]
