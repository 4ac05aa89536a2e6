"""The suite's queries again as DuckDB SQL, written independently of the operators."""

from __future__ import annotations

from captide.suite.inputs import (
    KNOWN_UNTIL,
    LAPSED_BEFORE,
    MEMBERS_UNTIL,
    PLAYLIST,
    RUN_TS,
    SNAPSHOT_FROM,
)

MAX_NGRAM = 12

# White space and line ends of Unicode text.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
BREAK = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"
CLOCK = r"\p{Nd}{2}:\p{Nd}{2}:\p{Nd}{2}\."

STAMP = "'%Y-%m-%d %H:%M:%S.%f'"
RUN = f"'{RUN_TS}.000000'"

META = ["title", "channel_name", "channel_id", "upload_date", "duration", "view_count"]


def stamp(expression: str) -> str:
    return f"strftime({expression}, {STAMP})"


def squeezed(expression: str) -> str:
    return f"trim(regexp_replace({expression}, '{SPACE}+', ' ', 'g'))"


def collapsed(source: str, prefix: str = "c") -> str:
    """CTEs that collapse repeated phrases of ``source(id, text)`` into ``{prefix}_out(id, text)``.

    Repeats of n words are runs of equal words n apart; the chosen ones are walked
    from one to the next.
    """
    p = prefix
    leads = ", ".join(f"lead(w, {n}) OVER o = w AS e{n}" for n in range(1, MAX_NGRAM + 1))
    pairs = " UNION ALL ".join(
        f"SELECT id, i, {n} AS n FROM {p}_eq WHERE e{n}" for n in range(1, MAX_NGRAM + 1)
    )
    return f"""
{p}_words AS MATERIALIZED (
  SELECT id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT id, string_split({squeezed("text")}, ' ') AS ws FROM {source})),
{p}_eq AS (SELECT id, i, {leads} FROM {p}_words WINDOW o AS (PARTITION BY id ORDER BY i)),
{p}_pairs AS ({pairs}),
{p}_islands AS (
  SELECT *, i - row_number() OVER (PARTITION BY id, n ORDER BY i) AS island FROM {p}_pairs),
{p}_runs AS (
  SELECT id, i, n, max(i) OVER (PARTITION BY id, n, island) - i + 1 AS run FROM {p}_islands),
{p}_best AS MATERIALIZED (
  SELECT id, i, max(n) AS n, arg_max(n * (run // n + 1), n) AS covered
  FROM {p}_runs WHERE run >= n GROUP BY id, i),
{p}_next AS MATERIALIZED (
  SELECT a.id, a.i, b.i AS following
  FROM (SELECT id, i, i + covered AS after FROM {p}_best) a
  ASOF JOIN {p}_best b ON a.id = b.id AND a.after <= b.i),
{p}_walk AS (
  SELECT id, min(i) AS i FROM {p}_best GROUP BY id
  UNION ALL
  SELECT x.id, x.following FROM {p}_walk v JOIN {p}_next x ON x.id = v.id AND x.i = v.i),
{p}_gone AS (
  SELECT b.id, unnest(range(b.i + b.n, b.i + b.covered)) AS i
  FROM {p}_walk v JOIN {p}_best b ON b.id = v.id AND b.i = v.i),
{p}_out AS (
  SELECT id, string_agg(w, ' ' ORDER BY i) AS text
  FROM {p}_words ANTI JOIN {p}_gone USING (id, i) GROUP BY id)"""


def stripped(source: str, prefix: str = "m") -> str:
    """CTEs that strip caption markup of ``source(id, text)``, line by line."""
    p = prefix
    line = "line"
    for pattern in (
        rf"{CLOCK}\p{{Nd}}{{3}}{SPACE}*-->{SPACE}*{CLOCK}\p{{Nd}}{{3}}.*",
        rf"<{CLOCK}\p{{Nd}}+>",
        "</?c>",
    ):
        line = f"regexp_replace({line}, '{pattern}', '', 'g')"
    return f"""
{p}_lines AS (
  SELECT id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
  FROM (SELECT id, regexp_split_to_array(text, '{BREAK}') AS ls FROM {source})),
{p}_kept AS (SELECT id, i, {squeezed(line)} AS line FROM {p}_lines),
{p}_out AS (
  SELECT id, coalesce(string_agg(line, ' ' ORDER BY i) FILTER (
    line <> '' AND NOT starts_with(line, 'WEBVTT') AND NOT starts_with(line, 'Kind:')
    AND NOT starts_with(line, 'Language:')), '') AS text
  FROM {p}_kept GROUP BY id)"""


def decoded(expression: str) -> str:
    """The entities that occur in the pages, ampersand last so that nothing decodes twice."""
    for entity, char in (("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·")):
        expression = f"replace({expression}, '{entity}', '{char}')"
    return f"replace(regexp_replace({expression}, '&amp;?', '&', 'g'), '>>', chr(10) || '>> ')"


CUE = (
    "'00:00:' || right('0' || (i - 1), 2) || '.000 --> 00:00:' || right('0' || (i - 1), 2) || "
    "'.500 align:start position:0%' || chr(10) || '<00:00:01.120><c> ' || l || '</c>' || chr(10) || l"
)
CAPTIONS = f"""
captions AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, lang,
    'WEBVTT' || chr(10) || 'Kind: captions' || chr(10) || 'Language: ' || lang || chr(10) || chr(10) ||
    array_to_string(list_transform(string_split(text, chr(10)), lambda l, i: {CUE}), chr(10)) AS text
  FROM documents)"""
BRONZE = f"{CAPTIONS}, bronze AS (SELECT id AS video_id, text AS raw_vtt, lang FROM captions)"
PAGES = "src AS (SELECT page_id AS id, html AS text FROM pages)"

SILVER = f"""
silver AS (
  SELECT CAST(doc_id AS VARCHAR) AS video_id, text AS full_text, lang AS source_language,
    '{MEMBERS_UNTIL} 00:00:00.000000' AS transformed_at
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"""

MEMBERS = f"""
members AS (
  SELECT event_type AS playlist_id, CAST(user_id AS VARCHAR) AS video_id,
    min(ts) AS first_seen_at, max(ts) AS last_seen_at,
    CASE WHEN max(ts) < TIMESTAMP '{LAPSED_BEFORE}' THEN max(ts) END AS removed_at
  FROM events WHERE ts < TIMESTAMP '{MEMBERS_UNTIL}' GROUP BY ALL)"""

VIDEOS = f"""
videos AS (
  SELECT video_id, 'Video ' || video_id AS title, 'by ' || kind AS channel_name,
    kind AS channel_id, CAST(signed_up AS DATE) AS upload_date,
    CAST(floor(value) AS INTEGER) AS duration, event_id AS view_count,
    CASE kind WHEN 'error' THEN 'unavailable' WHEN 'view' THEN 'no_subtitles' ELSE 'ok' END
      AS fetch_status,
    signed_up AS ingested_at
  FROM (
    SELECT CAST(user_id AS VARCHAR) AS video_id,
      arg_max(event_type, (ts, event_id)) AS kind, arg_max(value, (ts, event_id)) AS value,
      arg_max(event_id, (ts, event_id)) AS event_id, min(ts) FILTER (event_type = 'signup') AS signed_up
    FROM events WHERE ts < TIMESTAMP '{MEMBERS_UNTIL}' GROUP BY user_id)
  WHERE signed_up < TIMESTAMP '{KNOWN_UNTIL}')"""


def snapshot(since: str = SNAPSHOT_FROM, name: str = "snap") -> str:
    return f"""
{name} AS (
  SELECT DISTINCT CAST(user_id AS VARCHAR) AS video_id FROM events
  WHERE event_type = '{PLAYLIST}' AND ts >= TIMESTAMP '{since}')"""


def labels(since: str = SNAPSHOT_FROM, suffix: str = "") -> str:
    snap = f"snap{suffix}"
    return f"""{snapshot(since, snap)},
labelled{suffix} AS (
  SELECT video_id, CASE
      WHEN video_id IN (SELECT video_id FROM {snap}) THEN CASE
        WHEN video_id NOT IN (SELECT video_id FROM videos) THEN 'new'
        WHEN video_id IN (SELECT video_id FROM videos WHERE fetch_status = 'no_subtitles')
        THEN 'retry' ELSE 'touch' END
      WHEN video_id IN (SELECT video_id FROM members
        WHERE playlist_id = '{PLAYLIST}' AND removed_at IS NULL) THEN 'tombstone'
      ELSE 'inactive' END AS label
  FROM (SELECT video_id FROM {snap} UNION
        SELECT video_id FROM members WHERE playlist_id = '{PLAYLIST}'))"""


DIFF = f"{MEMBERS}, {VIDEOS}, {labels()}"

FETCHES = """
fetches AS (
  SELECT CAST(user_id AS VARCHAR) AS video_id, event_id AS seq,
    CASE WHEN event_type IN ('error', 'view', 'signup') THEN 1 ELSE 0 END AS returncode,
    CASE event_type WHEN 'view' THEN ' There are No Subtitles for ' || user_id
      WHEN 'error' THEN chr(9) || 'HTTP Error ' || (400 + CAST(props->>'$.k' AS INTEGER))
      WHEN 'signup' THEN 'boom' ELSE '' END AS stderr
  FROM events)"""

CLASSIFIED = """CASE WHEN returncode = 0 THEN 'ok'
  WHEN regexp_matches(lower(stderr), 'too many requests|429|rate limit') THEN 'rate_limited'
  WHEN regexp_matches(lower(stderr),
    'no subtitles|no automatic captions|subtitles not available') THEN 'no_subtitles'
  ELSE 'unavailable' END"""

INFOS = """
infos AS (
  SELECT CAST(c_custkey AS VARCHAR) AS video_id, c_acctbal >= 0 AS has_info,
    CASE WHEN c_acctbal >= 0 THEN c_name END AS title,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN c_mktsegment
      ELSE 'up ' || c_mktsegment END AS channel_name,
    CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 5000 THEN CAST(c_nationkey AS VARCHAR)
      ELSE 'UP' END AS channel_id,
    CASE WHEN c_acctbal >= 0 AND c_nationkey > 0
      THEN DATE '2019-12-31' + CAST(c_nationkey AS INTEGER) END AS upload_date,
    CASE WHEN c_acctbal >= 0 THEN CAST(c_nationkey * 10 AS INTEGER) END AS duration,
    CASE WHEN c_acctbal >= 0 THEN c_custkey * 1000000 END AS view_count
  FROM customer)"""


NAMES = """
names AS (
  SELECT CAST(doc_id AS VARCHAR) AS video_id, CAST(doc_id AS VARCHAR) AS file,
    CASE WHEN source = 'src1' THEN 'en' ELSE lang END AS source_language FROM documents
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), NULL, 'fi' FROM customer
  WHERE c_mktsegment = 'MACHINERY' AND c_custkey NOT IN (SELECT doc_id FROM documents WHERE source <> 'src1')),
-- a name that only contains the id gives way to one the fetcher names
own AS (
  SELECT * FROM names n WHERE file IS NULL OR NOT EXISTS (
    SELECT 1 FROM names m WHERE m.video_id = n.video_id AND m.file IS NULL))"""


def outcomes(*wanted: str) -> str:
    """CTEs from the differences to ``outcomes`` of the ids with the given labels."""
    listed = ", ".join(f"'{w}'" for w in wanted)
    info = ", ".join(f"i.{c}" for c in META)
    return f"""{DIFF}, {FETCHES}, {INFOS}, {NAMES},
last_fetch AS (
  SELECT video_id, arg_max(returncode, seq) AS returncode, arg_max(stderr, seq) AS stderr
  FROM fetches GROUP BY video_id),
outcomes AS (
  SELECT l.video_id, f.returncode, f.stderr, d.id IS NOT NULL AS has_caption,
    i.video_id IS NOT NULL AS has_info, {info},
    CASE WHEN d.id IS NOT NULL THEN 'ok' WHEN returncode <> 0 THEN {CLASSIFIED}
      ELSE 'no_subtitles' END AS fetch_status
  FROM labelled l LEFT JOIN last_fetch f USING (video_id)
  LEFT JOIN (SELECT video_id AS id FROM own) d ON d.id = l.video_id
  LEFT JOIN (FROM infos WHERE has_info) i ON i.video_id = l.video_id
  WHERE l.label IN ({listed}) AND (f.video_id IS NOT NULL OR d.id IS NOT NULL)),
recorded AS (FROM outcomes WHERE fetch_status <> 'rate_limited')"""


CUSTOMER_VIDEOS = f"""
stored AS (
  SELECT CAST(c_custkey AS VARCHAR) AS video_id, c_name AS title, c_mktsegment AS channel_name,
    CAST(c_nationkey AS VARCHAR) AS channel_id, DATE '2020-01-01' AS upload_date,
    c_nationkey AS duration, c_custkey AS view_count, 'no_subtitles' AS fetch_status,
    TIMESTAMP '{MEMBERS_UNTIL}' AS ingested_at
  FROM customer WHERE c_acctbal > 0)"""

ORDER_OUTCOMES = """
incoming AS (
  SELECT CAST(o_custkey AS VARCHAR) AS video_id,
    CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'O' THEN 'unavailable' ELSE 'rate_limited' END
      AS fetch_status,
    o_orderpriority = '1-URGENT' AS has_info, 'Order ' || o_orderkey AS title,
    nullif(o_orderpriority, '1-URGENT') AS channel_name, o_orderstatus AS channel_id,
    CAST(o_orderdate AS DATE) AS upload_date, CAST(floor(o_totalprice) AS INTEGER) AS duration,
    o_orderkey AS view_count, o_orderkey AS seq
  FROM orders),
last_status AS (
  FROM incoming QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seq DESC) = 1),
last_info AS (
  FROM incoming WHERE has_info
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seq DESC) = 1)"""


def meta_from(info: str, target: str) -> str:
    return ", ".join(
        f"CASE WHEN {info}.video_id IS NOT NULL THEN {info}.{c} ELSE {target}.{c} END AS {c}"
        for c in META
    )


def seen_now(source: str) -> str:
    """Membership after recording ``source(playlist_id, video_id)`` as seen at run time."""
    return f"""
SELECT coalesce(m.playlist_id, s.playlist_id) AS playlist_id,
  coalesce(m.video_id, s.video_id) AS video_id,
  coalesce({stamp("m.first_seen_at")}, {RUN}) AS first_seen_at,
  CASE WHEN s.video_id IS NOT NULL THEN {RUN} ELSE {stamp("m.last_seen_at")} END AS last_seen_at,
  CASE WHEN s.video_id IS NULL THEN {stamp("m.removed_at")} END AS removed_at
FROM members m FULL JOIN (SELECT DISTINCT playlist_id, video_id FROM {source}) s
  ON m.playlist_id = s.playlist_id AND m.video_id = s.video_id"""


DAILY = """
daily AS (
  SELECT DISTINCT event_type AS playlist_id, CAST(user_id AS VARCHAR) AS video_id, date_trunc('day', ts) AS moment
  FROM events),
days AS (
  SELECT *, row_number() OVER d AS number, lead(moment) OVER d AS next_at
  FROM (SELECT DISTINCT playlist_id, moment FROM daily) WINDOW d AS (PARTITION BY playlist_id ORDER BY moment)),
spells AS (
  SELECT playlist_id, video_id, min(moment) AS first_seen_at, max(moment) AS last_seen_at,
    arg_max(coalesce(next_at, TIMESTAMP '9999-01-01'), number) AS later, nullif(later, TIMESTAMP '9999-01-01') AS removed_at
  FROM (SELECT *, number - row_number() OVER (PARTITION BY playlist_id, video_id ORDER BY number) AS island
    FROM daily JOIN days USING (playlist_id, moment))
  GROUP BY playlist_id, video_id, island)"""


GONE = f"""{snapshot()},
gone AS (
  SELECT video_id FROM members WHERE playlist_id = '{PLAYLIST}' AND removed_at IS NULL
    AND video_id NOT IN (SELECT video_id FROM snap))"""

PATTERNS = {
    "webvtt_header": "WEBVTT",
    "timestamp_arrow": r"\d{2}:\d{2}:\d{2}\.\d{3}\s*-->",
    "caption_tag": "</?c>",
    "inline_timestamp": r"<\d{2}:\d{2}:\d{2}\.\d+>",
    "vtt_kind_header": "Kind:",
}
HITS = ", ".join(
    f"count(*) FILTER (regexp_matches(full_text, '{p}')) AS {n}" for n, p in PATTERNS.items()
)
AUDIT = f"""count(*) AS silver_count,
  count(*) FILTER (full_text IS NULL OR trim(full_text) = '') AS empty_silver, {HITS}"""

AUDITED = f"""{VIDEOS},
audited AS (SELECT CASE WHEN length(url) < 30 THEN ' ' ELSE html END AS full_text FROM pages),
counts AS (
  SELECT (SELECT count(*) FROM documents) AS bronze_count,
    (SELECT count(*) FROM videos WHERE fetch_status = 'ok') AS ok_videos_count,
    (SELECT count(*) FROM audited) AS silver_count,
    * FROM (SELECT {AUDIT.split(",", 1)[1]} FROM audited))"""

REPORT_ERRORS = ", ".join(
    [
        *[
            f"CASE WHEN {t}_count <> ok_videos_count THEN '{t} count (' || {t}_count || "
            "') != ok videos (' || ok_videos_count || ')' END"
            for t in ("silver", "bronze")
        ],
        "CASE WHEN empty_silver > 0 THEN empty_silver || ' silver row(s) have empty full_text' END",
        *[f"CASE WHEN {n} > 0 THEN {n} || ' silver row(s) contain {n}' END" for n in PATTERNS],
    ]
)

TRANSCRIBED = f"""{BRONZE}, {stripped("captions", "m")},
decoded AS (SELECT id, {decoded("text")} AS text FROM m_out), {collapsed("decoded", "c")}"""

WORDS = "CASE WHEN {t} = '' THEN 0 ELSE length({t}) - length(replace({t}, ' ', '')) + 1 END"


def _tags() -> str:
    return f"WITH {CAPTIONS}, {stripped('captions')} SELECT id AS video_id, text AS plain FROM m_out"


ORACLES: dict[str, str] = {
    "collapse_phrases": f"""
WITH RECURSIVE src AS (SELECT doc_id AS id, text FROM documents), {collapsed("src")}
SELECT id AS doc_id, text AS full_text FROM c_out""",
    "phrase_stats_by_lang": f"""
WITH RECURSIVE src AS (SELECT doc_id AS id, text FROM documents), {collapsed("src")}
SELECT lang, count(*) AS n_docs, count(*) FILTER (b <> a) AS n_changed,
  CAST(sum({WORDS.format(t="b")}) AS BIGINT) AS words_before,
  CAST(sum({WORDS.format(t="a")}) AS BIGINT) AS words_after
FROM (SELECT lang, {squeezed("d.text")} AS b, c_out.text AS a
      FROM documents d JOIN c_out ON c_out.id = d.doc_id) GROUP BY lang""",
    "strip_markup": _tags(),
    "clean_captions": f"""
WITH {CAPTIONS}, {stripped("captions")}
SELECT id AS video_id, {decoded("text")} AS prose FROM m_out""",
    "clean_pages": f"""
WITH {PAGES}, {stripped("src")} SELECT id AS page_id, {decoded("text")} AS prose FROM m_out""",
    "page_transcripts": f"""
WITH RECURSIVE {PAGES}, {stripped("src")},
decoded AS (SELECT id, {decoded("text")} AS text FROM m_out), {collapsed("decoded")}
SELECT id AS page_id, text AS full_text FROM c_out""",
    "classify_failures": f"WITH {FETCHES} SELECT seq, {CLASSIFIED} AS fetch_status FROM fetches",
    "error_details": f"""
WITH {FETCHES}
SELECT seq, left(trim(' ' || chr(9) || repeat(stderr || ' again ', 20), ' ' || chr(9)), 120) AS detail
FROM fetches""",
    "playlist_ids": """
SELECT page_id, CASE WHEN contains(u, 'list=')
  THEN split_part(split_part(u, 'list=', 2), '&', 1) ELSE u END AS playlist_id
FROM (SELECT page_id, replace(url, 'page=', 'list=') AS u FROM pages)""",
    "upload_dates": """
SELECT event_id, raw, CASE
  WHEN length(raw) = 8 THEN CAST(try_strptime(raw, '%Y%m%d') AS DATE)
  -- seven digits: one for the month unless only two can be
  WHEN length(raw) = 7 AND regexp_matches(raw, '^\\d{4}1[0-2][1-9]$')
    THEN CAST(try_strptime(left(raw, 6) || '0' || right(raw, 1), '%Y%m%d') AS DATE)
  WHEN length(raw) = 7 THEN CAST(try_strptime(left(raw, 4) || '0' || right(raw, 3), '%Y%m%d') AS DATE)
  END AS upload_date
FROM (SELECT event_id, CASE event_type
    WHEN 'error' THEN replace(d, '202401', '202402') WHEN 'view' THEN replace(d, '20240', '2024')
    WHEN 'signup' THEN 'x' || d ELSE d END AS raw
  FROM (SELECT *, strftime(ts, '%Y%m%d') AS d FROM events))""",
    "metadata_fallback": """
SELECT c_custkey, CASE WHEN c_acctbal >= 0 AND c_acctbal < 5000 THEN c_name
  ELSE c_mktsegment END AS channel_name FROM customer""",
    "metadata_files": f"WITH {INFOS} FROM infos",
    "snapshot_lines": """
SELECT props->>'$.k' AS video_id, count(*) AS n_lines FROM events
WHERE event_type NOT IN ('error', 'view', 'signup') GROUP BY 1""",
    "caption_names": """
SELECT CAST(doc_id AS VARCHAR) AS video_id,
  CASE WHEN source = 'src0' THEN 'en' ELSE lang || '-' || source END AS source_language
FROM documents""",
    "first_captions": """
SELECT source AS video_id, lang || '-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS source_language,
  text AS raw_vtt
FROM documents
QUALIFY row_number() OVER (PARTITION BY source ORDER BY lang, lpad(CAST(doc_id AS VARCHAR), 12, '0')) = 1""",
    "pending_transcripts": f"""
WITH {BRONZE}, {SILVER} SELECT video_id, length(raw_vtt) AS n_chars FROM bronze b
WHERE NOT EXISTS (SELECT 1 FROM silver s WHERE s.video_id = b.video_id)""",
    "scoped_transcripts": f"""
WITH {BRONZE}, {snapshot()} SELECT video_id, length(raw_vtt) AS n_chars FROM bronze b
WHERE EXISTS (SELECT 1 FROM snap s WHERE s.video_id = b.video_id)""",
    "forced_transcripts": f"WITH {BRONZE} SELECT video_id, length(raw_vtt) AS n_chars FROM bronze",
    "snapshot_labels": f"WITH {DIFF} FROM labelled",
    "diff_counts": f"""
WITH {DIFF} SELECT count(*) FILTER (label IN ('new', 'retry', 'touch')) AS snapshot,
  count(*) FILTER (label = 'new') AS new, count(*) FILTER (label = 'tombstone') AS tombstone,
  count(*) FILTER (label = 'retry') AS retry_no_subtitles,
  count(*) FILTER (label = 'touch') AS touch FROM labelled""",
    "tombstone_check": f"""
WITH {DIFF}, {labels(MEMBERS_UNTIL, "2")},
n AS (SELECT '{SNAPSHOT_FROM}' AS since, count(*) FILTER (label = 'tombstone') AS candidates
      FROM labelled UNION ALL
      SELECT '{MEMBERS_UNTIL}', count(*) FILTER (label = 'tombstone') FROM labelled2)
SELECT *, candidates > 20 AS tripped FROM n""",
    "new_ids": f"WITH {VIDEOS}, {snapshot()} FROM snap EXCEPT SELECT video_id FROM videos",
    "linked_ids": f"WITH {VIDEOS}, {snapshot()} FROM snap INTERSECT SELECT video_id FROM videos",
    "tombstone_ids": f"WITH {MEMBERS}, {GONE} FROM gone",
    "retry_ids": f"""
WITH {VIDEOS}, {snapshot()} SELECT video_id FROM videos
WHERE fetch_status = 'no_subtitles' AND video_id IN (FROM snap)""",
    "touch_ids": f"""
WITH {VIDEOS}, {snapshot()} SELECT video_id FROM videos
WHERE fetch_status <> 'no_subtitles' AND video_id IN (FROM snap)""",
    "scheduled_ids": f"""
WITH {VIDEOS}, {snapshot()} FROM snap
EXCEPT SELECT video_id FROM videos WHERE fetch_status <> 'no_subtitles'""",
    "active_members": f"""
WITH {MEMBERS} SELECT video_id FROM members
WHERE playlist_id = '{PLAYLIST}' AND removed_at IS NULL""",
    "resolved_outcomes": f"WITH {outcomes('new', 'retry')} FROM outcomes",
    "recorded_outcomes": f"""
WITH {outcomes("new", "retry", "touch")} SELECT video_id, fetch_status FROM recorded""",
    "outcome_tally": f"""
WITH {FETCHES}, s AS (SELECT {CLASSIFIED} AS s FROM fetches)
SELECT count(*) FILTER (s = 'ok') AS ok, count(*) FILTER (s = 'no_subtitles') AS no_subtitles,
  count(*) FILTER (s = 'unavailable') AS unavailable,
  count(*) FILTER (s = 'rate_limited') AS rate_limited FROM s""",
    "captioned_ids": f"WITH {outcomes('new', 'retry')} SELECT video_id FROM outcomes WHERE has_caption",
    "upsert_videos": f"""
WITH {CUSTOMER_VIDEOS}, {ORDER_OUTCOMES}
SELECT coalesce(t.video_id, s.video_id) AS video_id, {meta_from("i", "t")},
  coalesce(s.fetch_status, t.fetch_status) AS fetch_status,
  coalesce({stamp("t.ingested_at")}, {RUN}) AS ingested_at
FROM stored t FULL JOIN last_status s ON s.video_id = t.video_id
LEFT JOIN last_info i ON i.video_id = s.video_id""",
    "update_metadata": f"""
WITH {CUSTOMER_VIDEOS}, {ORDER_OUTCOMES}
SELECT t.video_id, {meta_from("i", "t")}, t.fetch_status, {stamp("t.ingested_at")} AS ingested_at
FROM stored t LEFT JOIN last_info i ON i.video_id = t.video_id""",
    "insert_transcripts": f"""
WITH {CUSTOMER_VIDEOS}, {ORDER_OUTCOMES}
SELECT video_id, title, fetch_status FROM stored UNION ALL
SELECT video_id, arg_min(title, seq), arg_min(fetch_status, seq) FROM incoming
WHERE video_id NOT IN (SELECT video_id FROM stored) GROUP BY video_id""",
    "upsert_membership": f"""
WITH {MEMBERS}, late AS (
  SELECT event_type AS playlist_id, CAST(user_id AS VARCHAR) AS video_id FROM events
  WHERE ts >= TIMESTAMP '{SNAPSHOT_FROM}') {seen_now("late")}""",
    "touch_membership": f"""
WITH {MEMBERS}, {snapshot()},
s AS (SELECT '{PLAYLIST}' AS playlist_id, video_id FROM snap) {seen_now("s")}""",
    "tombstone_members": f"""
WITH {MEMBERS}, {GONE}
SELECT playlist_id, video_id, {stamp("first_seen_at")} AS first_seen_at,
  {stamp("last_seen_at")} AS last_seen_at,
  CASE WHEN playlist_id = '{PLAYLIST}' AND video_id IN (FROM gone) THEN {RUN}
    ELSE {stamp("removed_at")} END AS removed_at
FROM members""",
    "count_removed": f"WITH {MEMBERS}, {GONE} SELECT count(*) AS tombstoned FROM gone",
    "replace_silver": f"""
WITH {SILVER}
SELECT * FROM silver WHERE video_id NOT IN (
  SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'fr')
UNION ALL SELECT CAST(doc_id AS VARCHAR), lower(text), lang, {RUN} FROM documents WHERE lang = 'fr'""",
    "membership_spells": f"""
WITH {DAILY} SELECT playlist_id, video_id, {stamp("first_seen_at")} AS first_seen_at,
  {stamp("last_seen_at")} AS last_seen_at, {stamp("removed_at")} AS removed_at FROM spells""",
    "backfill_membership": f"""
WITH {DAILY} SELECT playlist_id, video_id, {stamp("min(moment)")} AS first_seen_at,
  {stamp("max(moment)")} AS last_seen_at,
  {stamp("(SELECT min(moment) FROM days WHERE days.playlist_id = l.playlist_id AND days.moment > max(l.moment))")} AS removed_at
FROM daily l GROUP BY playlist_id, video_id""",
    "resumed_membership": f"""
WITH {MEMBERS}, daily AS (
  SELECT DISTINCT event_type AS playlist_id, CAST(user_id AS VARCHAR) AS video_id, date_trunc('day', ts) AS moment
  FROM events WHERE ts >= TIMESTAMP '{MEMBERS_UNTIL}' AND event_type IN ('click', 'view', 'error')),
days AS (SELECT DISTINCT playlist_id, moment FROM daily),
later AS (SELECT playlist_id, video_id, min(moment) AS f, max(moment) AS t FROM daily GROUP BY ALL),
joined AS (
  SELECT coalesce(m.playlist_id, l.playlist_id) AS playlist_id, coalesce(m.video_id, l.video_id) AS video_id,
    m.first_seen_at, m.last_seen_at, m.removed_at, f, t
  FROM members m FULL JOIN later l ON l.playlist_id = m.playlist_id AND l.video_id = m.video_id)
SELECT playlist_id, video_id, {stamp("coalesce(first_seen_at, f)")} AS first_seen_at,
  {stamp("coalesce(t, last_seen_at)")} AS last_seen_at,
  {stamp("""CASE WHEN t IS NOT NULL
      THEN (SELECT min(moment) FROM days d WHERE d.playlist_id = j.playlist_id AND d.moment > j.t)
    WHEN removed_at IS NULL THEN (SELECT min(moment) FROM days d WHERE d.playlist_id = j.playlist_id)
    ELSE removed_at END""")} AS removed_at
FROM joined j""",
    "browse_far": """
SELECT CAST(o_orderkey AS VARCHAR) AS video_id,
  CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(date_trunc('year', o_orderdate) AS DATE) END AS upload_date,
  o_orderstatus AS title
FROM orders ORDER BY upload_date DESC NULLS LAST, video_id LIMIT 10 OFFSET 7000""",
    "browse_after": f"""
WITH {CUSTOMER_VIDEOS} SELECT * REPLACE ({stamp("ingested_at")} AS ingested_at) FROM stored
WHERE video_id > '5' ORDER BY video_id LIMIT 20""",
    "rejected_lines": f"""
WITH i AS (
  SELECT CASE WHEN c_acctbal < 0 THEN 2 ELSE 20 END AS least,
    length(CASE WHEN c_acctbal < 0 THEN '{{}}' ELSE to_json({{'title': c_name,
      'channel': CASE WHEN c_acctbal < 5000 THEN c_mktsegment ELSE '' END,
      'uploader': 'up ' || c_mktsegment,
      'uploader_id': 'UP', 'upload_date': '202001' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0'),
      'duration': c_nationkey * 10, 'view_count': c_custkey * 1000000}}) END)
    + CASE WHEN c_acctbal >= 0 AND c_acctbal < 5000
      THEN length(',"channel_id":"' || c_nationkey || '"') ELSE 0 END AS n FROM customer)
SELECT 'snapshot' AS source, CASE event_type WHEN 'error' THEN 'malformed' WHEN 'view' THEN 'blank'
  WHEN 'signup' THEN 'no id' ELSE 'read' END AS reason, count(*) AS n FROM events GROUP BY ALL
UNION ALL
SELECT 'infos', CASE WHEN n % 7 = 0 AND n > 20 THEN 'malformed' ELSE 'read' END, count(*) FROM i GROUP BY ALL""",
    "snapshot_completeness": f"""
WITH {FETCHES}, k AS (
  SELECT 'all' AS kind, returncode FROM fetches
  UNION ALL SELECT 'good', returncode FROM fetches WHERE returncode = 0)
SELECT kind, count(*) AS listings, count(*) FILTER (returncode <> 0) AS unfinished,
  count(*) FILTER (returncode <> 0) = 0 AS complete FROM k GROUP BY kind
UNION ALL SELECT 'none', 0, 0, false""",
    "validation_ok": f"""
WITH counts AS (
  SELECT count(*) AS bronze_count, count(*) AS silver_count, count(*) AS ok_videos_count,
    CAST(0 AS BIGINT) AS empty_silver, {", ".join(f"CAST(0 AS BIGINT) AS {n}" for n in PATTERNS)}
  FROM documents)
SELECT *, '' AS errors, 'ok' AS status FROM counts""",
    "rewritten_silver": """
SELECT CAST(doc_id AS VARCHAR) AS video_id, lang AS source_language FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) OR lower(text) <> text""",
    "ingest_summary": f"""
WITH {outcomes("new")}
SELECT (SELECT count(*) FROM snap) AS total,
  (SELECT count(*) FROM labelled WHERE label = 'new') AS new,
  (SELECT count(*) FROM labelled WHERE label IN ('retry', 'touch')) AS existing,
  (SELECT count(*) FROM labelled WHERE label IN ('retry', 'touch')) AS linked,
  count(*) FILTER (fetch_status = 'ok') AS ok,
  count(*) FILTER (fetch_status = 'no_subtitles') AS no_subtitles,
  count(*) FILTER (fetch_status = 'unavailable') AS unavailable,
  count(*) FILTER (fetch_status = 'rate_limited') AS rate_limited,
  CASE WHEN (SELECT count(*) FROM labelled WHERE label = 'new') = 0
    THEN 'nothing_to_fetch' ELSE 'complete' END AS status
FROM outcomes""",
    "refresh_summary": f"""
WITH {outcomes("new", "retry")}
SELECT (SELECT count(*) FROM labelled WHERE label = 'new') AS added,
  (SELECT count(*) FROM labelled WHERE label = 'tombstone') AS tombstoned,
  count(*) FILTER (has_caption) AS newly_captioned, 'complete' AS status
FROM outcomes""",
    "metadata_summary": f"""
WITH {CUSTOMER_VIDEOS}, {INFOS}, ids AS (
  SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS video_id FROM orders),
f AS (SELECT video_id IN (SELECT video_id FROM stored) AS known,
        video_id IN (SELECT video_id FROM infos WHERE has_info) AS found FROM ids)
SELECT count(*) FILTER (known AND found) AS updated, count(*) FILTER (NOT known) AS skipped,
  count(*) FILTER (known AND NOT found) AS failed FROM f""",
    "transform_summary": """
SELECT count(*) AS processed,
  CASE WHEN count(*) = 0 THEN 'nothing_to_process' ELSE 'complete' END AS status
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "count_parity": f"""
WITH {AUDITED} SELECT bronze_count, silver_count, ok_videos_count,
  silver_count = ok_videos_count AS silver_matches,
  bronze_count = ok_videos_count AS bronze_matches FROM counts""",
    "validation_report": f"""
WITH {AUDITED}, e AS (SELECT *, array_to_string(list_filter([{REPORT_ERRORS}],
  lambda x: x IS NOT NULL), '; ') AS errors FROM counts)
SELECT *, CASE WHEN errors = '' THEN 'ok' ELSE 'failed' END AS status FROM e""",
    "artifact_audit": f"""
WITH {CAPTIONS}, s AS (SELECT text AS full_text FROM captions) SELECT {AUDIT} FROM s""",
    "cleaned_artifact_audit": f"""
WITH RECURSIVE {TRANSCRIBED}, s AS (SELECT text AS full_text FROM c_out) SELECT {AUDIT} FROM s""",
    "constraint_audit": """
WITH t AS (
  SELECT CAST(o_custkey AS VARCHAR) AS video_id, o_orderdate AS ingested_at,
    CASE o_orderstatus WHEN 'F' THEN 'ok' WHEN 'P' THEN NULL ELSE o_orderstatus END AS fetch_status
  FROM orders)
SELECT 'not_null_video_id' AS "constraint", count(*) FILTER (video_id IS NULL) AS violations FROM t
UNION ALL SELECT 'not_null_fetch_status', count(*) FILTER (fetch_status IS NULL) FROM t
UNION ALL SELECT 'not_null_ingested_at', count(*) FILTER (ingested_at IS NULL) FROM t
UNION ALL SELECT 'valid_fetch_status', count(*) FILTER (
  fetch_status NOT IN ('ok', 'no_subtitles', 'unavailable', 'rate_limited')) FROM t
UNION ALL SELECT 'unique_key', count(*) FROM (
  SELECT video_id FROM t GROUP BY video_id HAVING count(*) > 1)""",
    "partition_fingerprints": """
WITH m AS (SELECT CAST(o_custkey % 16 AS INTEGER) AS part,
  CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 12) AS BIGINT) AS mark FROM orders)
SELECT part, count(*) AS n, bit_xor(mark) AS folded, CAST(sum(mark) AS VARCHAR) AS total FROM m GROUP BY part""",
    "changed_partitions": """
WITH n AS (SELECT CAST(o_custkey % 16 AS INTEGER) AS part, count(*) AS n FROM orders GROUP BY 1)
SELECT part, n AS keys_before, CASE part WHEN 3 THEN 2 * n WHEN 5 THEN n ELSE 0 END AS keys_now
FROM n WHERE part IN (3, 5, 7)""",
    "ingest_videos": f"""
WITH {outcomes("new")}
SELECT video_id, {", ".join(META)}, fetch_status, {stamp("ingested_at")} AS ingested_at FROM videos
UNION ALL SELECT video_id, {", ".join(META)}, fetch_status, {RUN} FROM recorded""",
    "ingest_membership": f"""
WITH {outcomes("new")}, s AS (SELECT '{PLAYLIST}' AS playlist_id, video_id FROM (
  SELECT video_id FROM recorded UNION
  SELECT video_id FROM labelled WHERE label IN ('retry', 'touch'))) {seen_now("s")}""",
    "chosen_captions": f"""
WITH {NAMES} FROM own WHERE video_id IN (SELECT CAST(user_id AS VARCHAR) FROM events)""",
    "ingest_bronze": f"""
WITH {NAMES}, {BRONZE}, {SILVER}
SELECT o.video_id, o.source_language, coalesce(b.raw_vtt, '') AS raw_vtt, {RUN} AS fetched_at
FROM own o LEFT JOIN bronze b ON b.video_id = o.file
WHERE o.video_id IN (SELECT CAST(user_id AS VARCHAR) FROM events)
  AND o.video_id NOT IN (SELECT video_id FROM silver)""",
    "refresh_videos": f"""
WITH {outcomes("new", "retry")},
touched AS (FROM infos WHERE has_info AND video_id IN (
  SELECT video_id FROM labelled WHERE label = 'touch')),
updates AS (SELECT video_id, {", ".join(META)} FROM recorded WHERE has_info
  UNION ALL SELECT video_id, {", ".join(META)} FROM touched)
SELECT coalesce(v.video_id, r.video_id) AS video_id, {meta_from("u", "v")},
  coalesce(r.fetch_status, v.fetch_status) AS fetch_status,
  coalesce({stamp("v.ingested_at")}, {RUN}) AS ingested_at
FROM videos v FULL JOIN recorded r ON r.video_id = v.video_id
LEFT JOIN updates u ON u.video_id = coalesce(v.video_id, r.video_id)""",
    "refresh_membership": f"""
WITH {outcomes("new", "retry")}, s AS (SELECT '{PLAYLIST}' AS playlist_id, video_id FROM (
  SELECT video_id FROM recorded UNION SELECT video_id FROM labelled WHERE label = 'touch')),
seen AS ({seen_now("s")})
SELECT playlist_id, video_id, first_seen_at, last_seen_at,
  CASE WHEN playlist_id = '{PLAYLIST}' AND video_id IN (
    SELECT video_id FROM labelled WHERE label = 'tombstone') THEN {RUN}
    ELSE removed_at END AS removed_at
FROM seen""",
    "transform_captions": f"""
WITH RECURSIVE {TRANSCRIBED}
SELECT id AS video_id, c_out.text AS full_text, lang AS source_language, {RUN} AS transformed_at
FROM c_out JOIN captions USING (id)""",
    "refresh_silver": f"""
WITH RECURSIVE {TRANSCRIBED}, {SILVER}
FROM silver UNION ALL
SELECT id, c_out.text, lang, {RUN} FROM c_out JOIN captions USING (id)
WHERE id NOT IN (SELECT video_id FROM silver)""",
    "gold_documents": f"""
WITH {SILVER}, {CUSTOMER_VIDEOS}
SELECT s.video_id, concat_ws(chr(10) || chr(10), '# ' || coalesce(title, s.video_id),
  concat_ws(chr(10), '- Channel: ' || channel_name, '- Uploaded: ' || CAST(upload_date AS VARCHAR),
    '- Duration (s): ' || duration, '- Views: ' || view_count, '- Language: ' || source_language),
  full_text) AS document
FROM silver s LEFT JOIN stored v ON v.video_id = s.video_id""",
    "browse_videos": f"""
WITH {VIDEOS} SELECT * REPLACE ({stamp("ingested_at")} AS ingested_at) FROM videos
WHERE channel_name = 'by click' AND upload_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-03'
ORDER BY upload_date DESC NULLS LAST, video_id LIMIT 5 OFFSET 10""",
    "transcript_detail": f"WITH {SILVER} FROM silver WHERE video_id = '0'",
    "sql_access": f"""
WITH {VIDEOS}, {MEMBERS}
SELECT v.channel_name, m.playlist_id, count(*) AS n_members,
  count(*) FILTER (m.removed_at IS NULL) AS n_active,
  count(*) FILTER (m.video_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)) AS n_bronze,
  count(*) FILTER (m.video_id IN (SELECT CAST(d.doc_id AS VARCHAR) FROM documents d
    JOIN labels USING (doc_id))) AS n_silver
FROM members m JOIN videos v ON v.video_id = m.video_id
GROUP BY v.channel_name, m.playlist_id""",
}
