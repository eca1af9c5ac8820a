"""The registered queries as plain SQL over the benchmark tables, for comparison."""

from __future__ import annotations

from ..functions import fixed as v
from .posts import DISCORD_EVENTS, GREETING, MIXED, REPEATED, SPACED_GREETING


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def strings(items) -> str:
    return "(" + ", ".join(q(i) for i in items) + ")"


# --- expressions ----------------------------------------------------------------------------------

def sub(text: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"


def collapse(text: str) -> str:
    return f"trim({sub(text, f'[{v.WS}]+', ' ')})"


# Address, emoji and topic patterns are spelt here anew, not taken from the library.
_LABEL = r"[a-zA-Z0-9\x{A1}-\x{FFFF}]+(?:-[a-zA-Z0-9\x{A1}-\x{FFFF}]+)*"
_ADDRESS = (
    r"(^|[^\p{L}\p{N}_/.])(?:(?i:https?|ftp)://|(?i:www)[0-9]{0,3}\.)(?:[^\s\p{Z}/@]+@)?"
    rf"(?:[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}|{_LABEL}(?:\.{_LABEL})*\.[a-zA-Z\x{{A1}}-\x{{FFFF}}]{{2,}}|(?i:localhost))"
    r"(?::[0-9]{2,5})?(?:/[^)\]}\s\p{Z}]*)?"
)
_PICTURE = (
    r"[\x{A9}\x{AE}\x{203C}\x{2049}\x{2122}\x{2139}\x{2194}-\x{21AA}\x{231A}-\x{23FF}\x{2600}-\x{27BF}"
    r"\x{1F000}-\x{1FAFF}][\x{FE0F}\x{200D}]*"
)


def no_urls(text: str) -> str:
    return sub(text, _ADDRESS, "\\1")


def no_emoji(text: str) -> str:
    return sub(text, _PICTURE)


def repaired(text: str) -> str:
    """The repairs that these texts call for, one by one."""
    for broken, whole in (("Ã©", "é"), ("ÐŸ", "П"), ("Ñ€", "р"), ("&amp;", "&"), ("ﬁ", "fi"), ("ＡＢ１", "AB1")):
        text = f"replace({text}, {q(broken)}, {q(whole)})"
    return f"nfc_normalize(translate({text}, {q('‘’“”')}, {q(chr(39) * 2 + chr(34) * 2)}))"


def cleaned(text: str) -> str:
    return collapse(no_emoji(no_urls(repaired(text))))


def words(text: str) -> str:
    return collapse(sub(f"lower({text})", f"[^{v.WORD}{v.WS}]"))


def low(text: str) -> str:
    w = words(text)
    return f"({text} IS NULL OR {w} = '' OR {w} IN {strings(v.LOW_VALUE_PHRASES)})"


def links(text: str) -> str:
    found = f"regexp_extract_all({text}, {q(v.LINK_PATTERN)})"
    whole = f"CASE WHEN starts_with(u, 'www.') THEN 'https://' || u ELSE u END"
    trimmed = f"list_transform({found}, lambda u: rtrim({whole}, {q(v.LINK_TAIL_CHARS)}))"
    return (f"list_filter({trimmed}, lambda u: contains(u, '.') "
            f"AND length(u) >= {v.LINK_MIN_LENGTH})")


def joined(items: str) -> str:
    return f"coalesce(array_to_string({items}, ' '), '')"


def stamp(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S.%f')"


# --- shared tables --------------------------------------------------------------------------------

_EVENT = "e.user_id, json_extract_string(e.props, '$.k') AS k"
POSTS = f"""
posts AS (
  SELECT e.event_id::VARCHAR AS id, {_EVENT}, e.ts, d.source AS channel_id,
    'telegram' AS platform, e.event_type AS kind,
    CASE e.event_type
      WHEN 'click' THEN d.text || ' see https://' || d.source || '.example.com/p/' || e.user_id ||
        '). and www.foo.com,'
      WHEN 'purchase' THEN d.text || ' 🎉🏽 soon▯ '
      ELSE d.text END AS text
  FROM events e JOIN documents d ON d.doc_id = e.event_id
  UNION ALL
  SELECT c.conv_id || '.' || c.turn, {_EVENT}, e.ts + to_minutes(c.turn), 'chat_' || c.role,
    'discord', e.event_type, c.text
  FROM events e JOIN conversations c ON c.conv_id = e.event_id
  UNION ALL
  SELECT e.event_id::VARCHAR, {_EVENT}, e.ts, 'feed_' || e.event_type,
    CASE WHEN e.event_type IN {strings(DISCORD_EVENTS)} THEN 'discord' ELSE 'telegram' END,
    e.event_type,
    CASE e.event_type
      WHEN 'signup' THEN {q(GREETING)}
      WHEN 'view' THEN {q(SPACED_GREETING)}
      WHEN 'click' THEN 'https://feed.example.com/p/' || e.user_id || ' www.foo.com/x'
      WHEN 'error' THEN 'Exploit report: vulnerability in a bridge ' || e.props
      ELSE CASE WHEN e.event_type = 'purchase' AND e.user_id % 30 = 3
        THEN 'long https://' || repeat('u', 300) || '@host.example.com/p/' || e.user_id || ' and http://' ||
          repeat('x.', 140) || 'com/' || e.event_id || ') end'
        WHEN e.event_type = 'purchase' AND e.user_id % 30 = 6 THEN {q(MIXED)} || e.event_id
        WHEN e.event_type = 'purchase' AND e.user_id % 3 = 0
        THEN 'Order no. ' || e.event_id || ' of the token sale is filled' ELSE {q(REPEATED)} END END
  FROM events e)"""

def collected_from(source: str) -> str:
    return f"""
flagged AS (SELECT *, {low('text')} AS low_value FROM {source}),
collected AS (
  SELECT id,
    CASE WHEN NOT low_value THEN {cleaned('text')} END AS text,
    ts AS timestamp,
    CASE WHEN platform = 'discord' THEN 'user' || user_id || '#' || user_id
      WHEN kind <> 'view' THEN user_id::VARCHAR ELSE 'admin#' || user_id END AS author,
    channel_id, platform,
    CASE WHEN platform = 'discord' THEN ['https://cdn.example.com/' || k]
      WHEN NOT low_value THEN list_concat(['https://t.example.com/' || k], {links('text')}) END
      AS links,
    low_value
  FROM flagged)"""


COLLECTED = f"{POSTS}, {collected_from('posts')}"

# What of the landed posts can be read and has a time and a text.
SOUND = """
sound AS (SELECT * FROM posts WHERE user_id % 40 <> 5 AND CASE platform WHEN 'discord'
  THEN user_id % 40 NOT IN (1, 2) ELSE user_id % 40 NOT IN (3, 4) AND text <> '' END)"""
IN_WINDOW = "ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS"

ORDER = "timestamp DESC NULLS LAST, platform, channel_id, id"


def latest(source: str, keys: str = "text") -> str:
    return f"""SELECT * EXCLUDE (_rank) FROM (SELECT *, row_number() OVER (PARTITION BY {keys}
    ORDER BY timestamp DESC NULLS FIRST, platform, channel_id, id) AS _rank FROM {source})
    WHERE _rank = 1"""


MESSAGES = f"""{COLLECTED},
kept AS (SELECT * EXCLUDE (low_value) FROM collected WHERE NOT low_value),
messages AS ({latest('kept')})"""

BATCHED = f"""{MESSAGES},
numbered AS (SELECT *, row_number() OVER (ORDER BY {ORDER}) - 1 AS n FROM messages),
batched AS (SELECT id, text, platform, channel_id, links,
  n // {v.DAILY_BATCH_SIZE} AS batch_id, n % {v.DAILY_BATCH_SIZE} AS pos FROM numbered)"""

_ITEMS = "string_agg({item}, ',' ORDER BY pos)"
# Replies derived from the batches: by batch number good at once, junk, one item short, a bare
# object or text behind the list; every other broken batch is answered well at the third attempt.
RESPONSES = f"""{BATCHED},
answers AS (SELECT batch_id, count(*) AS n,
    string_agg('{{"id":"' || id || '","platform":"' || platform || '","keep":' ||
      CASE WHEN length(text) % 3 = 0 THEN '"false"' WHEN length(text) % 3 = 1 THEN '"true"'
        ELSE 'true' END || ',"score":"0.' || (70 + length(text) % 30) || '","tags":["news"]}}',
      ',' ORDER BY pos) AS items,
    string_agg('{{"id":"' || id || '"}}', ',' ORDER BY pos) FILTER (pos > 0) AS short_items,
    string_agg('{{"id":"' || id || '","platform":"' || platform || '","keep":"true","score":"0.8","tags":[1,"x"]}}',
      ',' ORDER BY pos DESC) AS reversed,
    string_agg(CASE WHEN pos = 0 THEN '5' ELSE '{{"id":"' || id || '","platform":"' || platform ||
      '","keep":"true","score":0.9,"tags":"news"}}' END, ',' ORDER BY pos) AS odd_items
  FROM batched GROUP BY batch_id),
responses AS (
  SELECT batch_id, 1 AS attempt, CASE batch_id % 7 WHEN 0 THEN 'sorry, no' WHEN 1 THEN
      '[' || coalesce(short_items, '') || ']' WHEN 2 THEN '{{"labels": [' || items || ']}}'
      WHEN 3 THEN '[' || items || '] done' WHEN 5 THEN '[' || reversed || ']'
      WHEN 6 THEN '[' || odd_items || ']' ELSE ' [' || items || '] ' END AS body FROM answers
  UNION ALL
  SELECT batch_id, 3, CASE WHEN batch_id % 2 = 0 THEN '[' || items || ']' END FROM answers
    WHERE batch_id % 7 < 4),
judged AS (SELECT r.*, a.n,
    CASE WHEN json_valid(body) AND json_type(body) = 'ARRAY' THEN json_array_length(body)
      ELSE -1 END AS got FROM responses r JOIN answers a USING (batch_id)),
accepted AS (SELECT batch_id, attempt, body FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY attempt) AS _rank FROM judged
    WHERE got = n) WHERE _rank = 1),
said AS (SELECT a.batch_id, b.pos AS place, b.id AS own_id, b.platform AS own_platform,
    a.body->('$[' || b.pos || ']') AS item FROM accepted a JOIN batched b USING (batch_id)),
named AS (SELECT *, json_extract_string(item, '$.id') AS id, json_extract_string(item, '$.platform') AS platform
  FROM said),
only_one AS (SELECT batch_id, id, platform, min(pos) AS pos FROM batched
  GROUP BY batch_id, id, platform HAVING count(*) = 1),
aimed AS (SELECT n.*, n.id = own_id AND n.platform = own_platform AS in_place,
    CASE WHEN n.id = own_id AND n.platform = own_platform THEN place ELSE o.pos END AS pos
  FROM named n LEFT JOIN only_one o ON o.batch_id = n.batch_id AND o.id = n.id AND o.platform = n.platform),
chosen AS (SELECT * FROM aimed WHERE pos IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY batch_id, pos ORDER BY coalesce(in_place, false) DESC, place) = 1),
labelled AS (
  SELECT c.batch_id, c.pos, b.id, b.platform, b.channel_id,
    CASE WHEN json_type(item->'$.keep') = 'VARCHAR' THEN json_extract_string(item, '$.keep') END
      AS keep,
    CASE WHEN json_type(item->'$.score') = 'VARCHAR' THEN json_extract_string(item, '$.score') END AS score,
    CASE WHEN json_type(item->'$.tags') = 'ARRAY' THEN array_to_string(item->>'$.tags[*]', ' ') ELSE '' END AS tags
  FROM chosen c JOIN batched b ON b.batch_id = c.batch_id AND b.pos = c.pos
  UNION ALL
  SELECT b.batch_id, b.pos, b.id, b.platform, b.channel_id, 'false', '0.0', ''
  FROM batched b ANTI JOIN accepted a USING (batch_id))"""


_EDGE = r"([^\p{L}\p{N}_]|$)"
_TOPIC_WORDS = {
    "news": r"announc|listing|partnership|hack|audit",
    "governance": rf"dao{_EDGE}|proposal|voting{_EDGE}|upgrade",
    "product": rf"dapp|nft|token launch|staking{_EDGE}|bridge",
    "feedback": r"complaint|bug report|suggestion",
    "scam": rf"phishing{_EDGE}|fake site|rug pull|impersonat",
    "education": r"gas fee|zk-proof|explain|tutorial",
    "security": rf"exploit|vulnerabilit|wallet safety{_EDGE}",
}


def rubric_tags(where: str) -> str:
    flags = ", ".join(
        rf"CASE WHEN regexp_matches(lower({where}), {q(rf'(^|[^\p{{L}}\p{{N}}_])({words})')}) THEN {q(topic)} END"
        for topic, words in _TOPIC_WORDS.items()
    )
    return f"list_filter([{flags}], lambda t: t IS NOT NULL)"


def rubric_score(tags: str) -> str:
    return (f"CASE WHEN len({tags}) = 0 THEN 0.00::DECIMAL(3,2) ELSE "
            f"least(0.98, 0.60 + 0.10 * len({tags}))::DECIMAL(3,2) END")


RUBRIC = f"""{MESSAGES},
tagged AS (SELECT *, {rubric_tags("concat_ws(' ', text, array_to_string(links, ' '))")} AS tags
  FROM messages),
scored AS (SELECT *, {rubric_score('tags')} AS score FROM tagged)"""

_CANONICAL = f"""id, text, {stamp('timestamp')} AS timestamp, author, channel_id, platform,
  {joined('links')} AS links"""

_STATS = f"""{COLLECTED},
counts AS (SELECT channel_id, platform, count(*) AS in_window,
    count(*) FILTER (NOT low_value) AS no_greeting,
    count(DISTINCT text) FILTER (NOT low_value) AS distinct_text
  FROM collected GROUP BY ALL),
stats AS (SELECT channel_id, platform,
    CASE WHEN platform = 'discord' THEN in_window ELSE no_greeting END AS pulled,
    CASE WHEN platform = 'discord' THEN no_greeting ELSE distinct_text END AS kept,
    in_window, distinct_text FROM counts)"""

# Load errors derived from the posts: channels whose smallest user falls in one of five classes.
ERRORS = """
errors AS (SELECT channel_id, platform,
    CASE min(user_id) % 5 WHEN 0 THEN 401 WHEN 1 THEN 403 WHEN 2 THEN 404 WHEN 3 THEN 500 END
      AS http_status,
    'upstream said: ' || repeat(channel_id || ' is away; ', 20) AS error
  FROM posts GROUP BY channel_id, platform)"""

_HTTP = f"""CASE {' '.join(f"WHEN http_status = {c} THEN {q(t)}"
                            for c, t in v.ALERT_HTTP_STATUS.items())}
  ELSE '⚠️ HTTP ' || http_status || ': ' || substr(error, 1, {v.ALERT_BODY_CHARS}) END"""
_ERROR_TEXT = f"CASE WHEN http_status IS NOT NULL THEN {_HTTP} ELSE error END"
_FATAL = "(http_status IS NULL OR http_status IN (401, 403, 404))"

_DIGEST_LABELS = """
doc_labels AS (SELECT doc_id::VARCHAR AS id, 'telegram' AS platform, source AS channel_id,
    CASE WHEN toxic = 1 THEN 0.75 ELSE 0.95 END::DECIMAL(3,2) AS score,
    CASE WHEN toxic = 1 THEN 'scam' ELSE 'news' END AS tags
  FROM labels JOIN documents USING (doc_id) WHERE quality = 1)"""


_OFFSET_TIME = ("CASE WHEN timestamp = date_trunc('second', timestamp) "
                "THEN strftime(timestamp, '%Y-%m-%d %H:%M:%S+00:00') "
                "ELSE strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f+00:00') END")


def _digest(source: str, extra: str = "") -> str:
    return f"""SELECT {_CANONICAL}, coalesce(l.score::VARCHAR, '') AS score,
    coalesce(l.tags, '') AS tags{extra}
  FROM {source} m LEFT JOIN doc_labels l USING (id, platform, channel_id)"""


def oracle_sql() -> dict[str, str]:
    sql = {}
    known = """registry AS (SELECT source AS channel_id, 'telegram' AS platform FROM documents
      UNION SELECT 'chat_' || role, 'discord' FROM conversations)"""
    sql["sources_check"] = """WITH faulty AS (SELECT DISTINCT source AS channel_id,
        CASE lang WHEN 'en' THEN 'telegram' WHEN 'fr' THEN 'discord' ELSE lang END AS platform
        FROM documents),
      registry AS (SELECT ascii(platform)::BIGINT AS id, * FROM faulty)
      SELECT 'channel_id repeated' AS rule, channel_id AS value, count(*) AS n FROM registry
        GROUP BY channel_id HAVING count(*) > 1
      UNION ALL SELECT 'id repeated', id::VARCHAR, count(*) FROM registry
        GROUP BY id HAVING count(*) > 1
      UNION ALL SELECT 'platform unknown', platform, count(*) FROM registry
        WHERE platform NOT IN ('telegram', 'discord') GROUP BY platform"""
    sql["channels_by_platform"] = f"WITH {known} SELECT platform, channel_id FROM registry"
    sql["registered_messages"] = f"""WITH {POSTS}, {known}
      SELECT p.id, p.channel_id, p.platform FROM posts p SEMI JOIN registry USING
      (channel_id, platform)"""
    sql["lookback_24h"] = f"""WITH {POSTS}
      SELECT id, channel_id, platform, {stamp('ts')} AS timestamp FROM posts
      WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS"""
    sql["low_value_drop"] = f"""WITH {POSTS}
      SELECT id, channel_id, platform, length(text) AS n_chars FROM posts WHERE NOT {low('text')}"""
    sql["normalized_words"] = f"""WITH {POSTS} SELECT id, channel_id, {words('text')} AS words FROM posts"""
    sql["clean_text"] = f"WITH {POSTS} SELECT id, channel_id, {cleaned('text')} AS text FROM posts"
    sql["strip_urls"] = f"WITH {POSTS} SELECT id, channel_id, {no_urls('text')} AS text FROM posts"
    sql["strip_emoji"] = f"WITH {POSTS} SELECT id, channel_id, {no_emoji('text')} AS text FROM posts"
    sql["collapse_whitespace"] = f"WITH {POSTS} SELECT id, channel_id, {collapse('text')} AS text FROM posts"
    sql["repair_unicode"] = f"WITH {POSTS} SELECT id, channel_id, {repaired('text')} AS text FROM posts"
    sql["clean_conversations"] = f"""SELECT conv_id, turn, {cleaned('text')} AS text,
      {low('text')} AS low_value FROM conversations"""
    sql["links_from_text"] = f"""WITH {POSTS}, found AS (SELECT id, channel_id, {links('text')} AS l FROM posts)
      SELECT id, channel_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS pos FROM found"""
    sql["links_from_pages"] = f"""WITH found AS (SELECT page_id, {links('html')} AS l FROM pages)
      SELECT page_id, unnest(l) AS link, generate_subscripts(l, 1) - 1 AS pos FROM found"""
    for platform in v.PLATFORMS:
        sql[f"{platform}_messages"] = f"""WITH {COLLECTED} SELECT id, coalesce(text, '') AS text,
          {stamp('timestamp')} AS timestamp, author, channel_id, platform,
          {joined('links')} AS links, low_value FROM collected WHERE platform = '{platform}'"""
    sql["union_platforms"] = f"""WITH {MESSAGES}
      SELECT id, channel_id, platform, length(text) AS n_chars FROM kept"""
    sql["dedup_latest"] = f"WITH {MESSAGES} SELECT {_CANONICAL} FROM messages"
    sql["dedup_keep_empty"] = f"""WITH {MESSAGES},
      apart AS ({latest('kept', "text, CASE WHEN text = '' THEN to_json(links) END")})
      SELECT {_CANONICAL} FROM apart"""
    sql["dedup_channel"] = f"""WITH {MESSAGES},
      apart AS ({latest('kept', 'text, platform, channel_id')}) SELECT {_CANONICAL} FROM apart"""
    sql["ranked_newest_first"] = f"""WITH {MESSAGES}
      SELECT id, channel_id, platform, row_number() OVER (ORDER BY {ORDER}) - 1 AS position
      FROM messages"""
    sql["channel_stats"] = f"WITH {_STATS} SELECT * FROM stats"
    sql["run_totals"] = f"""WITH {_STATS} SELECT coalesce(platform, 'all') AS platform,
      coalesce(channel_id, 'all') AS channel_id, sum(pulled)::BIGINT AS pulled,
      sum(kept)::BIGINT AS kept FROM stats GROUP BY ROLLUP (platform, channel_id)"""
    sql["combined_count"] = f"WITH {MESSAGES} SELECT count(*) AS combined FROM messages"
    sql["run_stats"] = f"""WITH {_STATS}, {ERRORS},
      failed AS (SELECT channel_id, platform, {_ERROR_TEXT} AS error FROM errors WHERE {_FATAL})
      SELECT channel_id, platform, pulled, kept, 'unknown' AS success, '' AS error FROM stats
      ANTI JOIN failed USING (channel_id, platform)
      UNION ALL SELECT channel_id, platform, 0, 0, 'false', error FROM failed"""
    sql["run_alerts"] = f"""WITH {COLLECTED}, {ERRORS}, alerts AS (
      SELECT 'http_status' AS kind, channel_id, platform, {_HTTP} AS text FROM errors
        WHERE http_status IS NOT NULL
      UNION ALL
      SELECT 'source_error', channel_id, platform, CASE platform
        WHEN 'discord' THEN '❌ Discord ' || channel_id || ' error: ' || {_ERROR_TEXT}
        ELSE '❌ Telegram ' || channel_id || ' error: ' || {_ERROR_TEXT} END
      FROM errors WHERE {_FATAL}
      UNION ALL
      SELECT 'no_messages', '', '', {q(v.ALERT_NO_MESSAGES)} FROM (SELECT count(*) AS n FROM collected
        WHERE NOT low_value AND timestamp >= TIMESTAMP '2024-02-03 00:00:00') WHERE n = 0
      UNION ALL
      SELECT 'nothing_to_label', '', '', {q(v.ALERT_NOTHING_TO_LABEL)} FROM (SELECT count(*) AS n FROM collected
        WHERE NOT low_value AND channel_id IN ('feed_signup', 'feed_view')) WHERE n = 0)
      SELECT kind, channel_id, platform, {q(v.ALERT_PREFIX)} || text AS message FROM alerts"""
    sql["parsed_times"] = f"""WITH told AS (SELECT event_id, CASE
      WHEN user_id % 20 IN (0, 1, 2, 3, 7) THEN NULL
      WHEN user_id % 20 = 4 THEN date_trunc('second', ts) - INTERVAL 1 HOUR
      WHEN user_id % 20 IN (5, 6) THEN date_trunc('day', ts)
      WHEN event_type = 'click' THEN ts - INTERVAL 2 HOURS WHEN event_type = 'error'
      THEN date_trunc('second', ts) WHEN event_type = 'view' THEN NULL ELSE ts END AS t FROM events)
      SELECT event_id, {stamp('t')} AS parsed FROM told"""
    sql["landed_messages"] = f"""WITH {COLLECTED} SELECT id, coalesce(text, '') AS text,
      {stamp('timestamp')} AS timestamp, author, channel_id, platform,
      {joined('links')} AS links, low_value FROM collected"""
    line = "CASE WHEN position > 0 THEN ',' || chr(10) ELSE '' END || '{' || chr(10) || " + \
        " || ',' || chr(10) || ".join(
            f"'  \"{c}\" : ' || to_json({e})::VARCHAR" for c, e in (
                ("id", "id"), ("channel_id", "channel_id"), ("platform", "platform"),
                ("text", "text"), ("timestamp", _OFFSET_TIME))) + " || chr(10) || '}'"
    sql["records_json"] = f"""WITH {MESSAGES}, ranked AS (
        SELECT *, row_number() OVER (ORDER BY {ORDER}) - 1 AS position FROM messages)
      SELECT position + 1 AS seq, {line} AS line FROM ranked
      UNION ALL SELECT 0, '[' UNION ALL SELECT 9223372036854775807, ']'"""
    sql["label_input"] = f"""WITH {MESSAGES} SELECT id, text, platform, channel_id,
      {joined('links')} AS links FROM messages"""
    sql["label_batches"] = f"WITH {BATCHED} SELECT id, channel_id, platform, batch_id, pos FROM batched"
    sql["label_requests"] = f"""WITH {BATCHED} SELECT batch_id, count(*) AS n,
      '[' || string_agg(to_json({{'id': id, 'text': text, 'platform': platform, 'links': links}})
        ::VARCHAR, ',' ORDER BY pos) || ']' AS request FROM batched GROUP BY batch_id"""
    sql["label_validate"] = f"WITH {RESPONSES} SELECT batch_id, attempt, body FROM accepted"
    sql["label_fallback"] = f"""WITH {RESPONSES} SELECT batch_id, pos, id, platform, channel_id,
      coalesce(keep, '') AS keep, coalesce(score, '') AS score, tags FROM labelled"""
    sql["label_kept"] = f"""WITH {RESPONSES} SELECT id, platform, channel_id,
      coalesce(score::DECIMAL(3,2)::VARCHAR, '') AS score, tags FROM labelled WHERE keep = 'true'"""
    sql["digest_from_replies"] = f"""WITH {RESPONSES},
      good AS (SELECT id, platform, channel_id, score::DECIMAL(3,2)::VARCHAR AS score, tags
        FROM labelled WHERE keep = 'true')
      SELECT {_CANONICAL}, coalesce(l.score, '') AS score, coalesce(l.tags, '') AS tags
      FROM messages m LEFT JOIN good l USING (id, platform, channel_id)"""
    sql["topic_rubric"] = f"""WITH {RUBRIC} SELECT id, platform, channel_id,
      {joined('tags')} AS tags, score::VARCHAR AS score,
      CASE WHEN score >= 0.70 THEN 'true' ELSE 'false' END AS keep FROM scored"""
    sql["digest_by_rubric"] = f"""WITH {RUBRIC} SELECT {_CANONICAL},
      CASE WHEN score >= 0.70 THEN score::VARCHAR ELSE '' END AS score,
      CASE WHEN score >= 0.70 THEN {joined('tags')} ELSE '' END AS tags FROM scored"""
    sql["tag_check"] = f"""WITH {RUBRIC}, used AS (SELECT id, channel_id,
      unnest(list_append(tags, platform)) AS tag FROM scored)
      SELECT id, channel_id, tag FROM used WHERE tag NOT IN {strings(v.TOPICS)}"""
    sql["label_with_fn"] = f"""WITH {MESSAGES} SELECT id, platform, channel_id,
      ('0.' || (70 + length(text) % 30))::DECIMAL(3,2)::VARCHAR AS score,
      CASE WHEN len(links) > 1 THEN 'news product' ELSE 'news' END AS tags
      FROM messages WHERE length(text) % 3 > 0"""
    sql["digest"] = f"WITH {MESSAGES}, {_DIGEST_LABELS} {_digest('messages')}"
    daily = latest("dated", "text, run_date")
    sql["digest_by_day"] = f"""WITH {MESSAGES}, {_DIGEST_LABELS},
      dated AS (SELECT *, timestamp::DATE AS run_date FROM kept),
      daily AS ({daily}) {_digest('daily', ", run_date::VARCHAR AS run_date")}"""
    sql["digest_24h"] = f"""WITH {COLLECTED}, {_DIGEST_LABELS},
      kept AS (SELECT * EXCLUDE (low_value) FROM collected WHERE NOT low_value
        AND timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS),
      messages AS ({latest('kept')}) {_digest('messages')}"""
    sql["digest_written"] = sql["digest_by_day"]
    sql["run_log"] = f"""WITH {_STATS} SELECT channel_id, platform, pulled, kept,
      true AS success, '' AS error, run_id, '2024-01-31' AS run_date
      FROM stats, (VALUES ('first'), ('second')) AS r(run_id)"""
    sql["digest_rerun"] = f"SELECT * FROM ({sql['digest_by_day']}) WHERE run_date <> '2024-01-30'"
    sql["incremental_digest"] = sql["dedup_latest"]
    day = f"""{COLLECTED}, kept AS (SELECT * EXCLUDE (low_value) FROM collected WHERE NOT low_value
        AND timestamp >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOURS),
      messages AS ({latest('kept')})"""
    sql["incremental_landed"] = f"WITH {day} SELECT {_CANONICAL} FROM messages"
    sql["landed_24h"] = f"""WITH {POSTS}, {SOUND}, recent AS (SELECT * FROM sound WHERE {IN_WINDOW}),
      {collected_from('recent')} SELECT id, coalesce(text, '') AS text, {stamp('timestamp')} AS timestamp, author,
      channel_id, platform, {joined('links')} AS links, low_value FROM collected"""
    sql["landing_account"] = f"""WITH {POSTS} SELECT platform,
      CASE WHEN platform = 'discord' AND user_id % 40 IN (1, 2) THEN '' ELSE ts::DATE::VARCHAR END AS landed,
      count(*) AS n_rows, count(*) FILTER (user_id % 40 = 5) AS n_unreadable, 0::BIGINT AS n_empty
      FROM posts GROUP BY ALL"""
    sql["observed_count"] = sql["combined_count"]
    sql["label_input_defaults"] = f"""WITH {MESSAGES} SELECT id, text, platform, channel_id, 0::INT AS links
      FROM messages WHERE length(text) % 3 <> 0"""
    sql["distinct_links"] = f"""WITH {POSTS}, found AS (SELECT id, channel_id,
        list_concat(['https://t.example.com/' || k], {links('text')}) AS l FROM posts WHERE platform = 'telegram'),
      each_link AS (SELECT id, channel_id, unnest(l) AS link, generate_subscripts(l, 1) AS place FROM found),
      firsts AS (SELECT id, channel_id, link, min(place) AS place FROM each_link GROUP BY ALL)
      SELECT id, channel_id, link, row_number() OVER (PARTITION BY id, channel_id ORDER BY place) - 1 AS pos FROM firsts"""
    sql["digest_archive"] = f"SELECT * EXCLUDE (run_date) FROM ({sql['digest_by_day']})"
    sql["whole_run"] = f"""WITH {POSTS}, {known}, {ERRORS}, {SOUND},
      recent AS (SELECT * FROM sound SEMI JOIN registry USING (channel_id, platform) WHERE {IN_WINDOW}),
      {collected_from('recent')},
      kept AS (SELECT * EXCLUDE (low_value) FROM collected WHERE NOT low_value),
      messages AS ({latest('kept')}),
      tagged AS (SELECT *, {rubric_tags("concat_ws(' ', text, array_to_string(links, ' '))")} AS tags FROM messages),
      scored AS (SELECT *, {rubric_score('tags')} AS score FROM tagged),
      known_errors AS (SELECT * FROM errors SEMI JOIN registry USING (channel_id, platform)),
      failed AS (SELECT channel_id, platform, {_ERROR_TEXT} AS error FROM known_errors WHERE {_FATAL}),
      counts AS (SELECT channel_id, platform, count(*) AS in_window, count(*) FILTER (NOT low_value) AS no_greeting,
        count(DISTINCT text) FILTER (NOT low_value) AS distinct_text FROM collected GROUP BY ALL)
      SELECT 'digest' AS part, channel_id, platform, id AS key, concat_ws('|', {stamp('timestamp')}, author,
        {joined('links')}, CASE WHEN score >= 0.70 THEN score::VARCHAR ELSE '' END,
        CASE WHEN score >= 0.70 THEN {joined('tags')} ELSE '' END, text) AS value FROM scored
      UNION ALL
      SELECT 'log', channel_id, platform, '2024-01-31 00:00:00',
        coalesce(CASE platform WHEN 'discord' THEN in_window ELSE no_greeting END, 0) || '|' ||
        coalesce(CASE platform WHEN 'discord' THEN no_greeting ELSE distinct_text END, 0) || '||'
      FROM (SELECT * FROM registry ANTI JOIN failed USING (channel_id, platform)) LEFT JOIN counts USING (channel_id, platform)
      UNION ALL
      SELECT 'log', channel_id, platform, '2024-01-31 00:00:00', '0|0|false|' || error FROM failed
      UNION ALL
      SELECT 'alert', channel_id, platform, 'http_status', {q(v.ALERT_PREFIX)} || {_HTTP} FROM known_errors
        WHERE http_status IS NOT NULL
      UNION ALL
      SELECT 'alert', channel_id, platform, 'source_error', {q(v.ALERT_PREFIX)} || CASE platform
        WHEN 'discord' THEN '❌ Discord ' ELSE '❌ Telegram ' END || channel_id || ' error: ' || error FROM failed
      UNION ALL
      SELECT 'alert', '', '', 'no_messages', {q(v.ALERT_PREFIX + v.ALERT_NO_MESSAGES)}
        FROM (SELECT count(*) AS n FROM kept) WHERE n = 0
      UNION ALL
      SELECT 'alert', '', '', 'nothing_to_label', {q(v.ALERT_PREFIX + v.ALERT_NOTHING_TO_LABEL)}
        FROM (SELECT count(*) AS n FROM kept) WHERE n = 0
      UNION ALL
      SELECT 'count', '', '', 'combined', count(*)::VARCHAR FROM messages
      UNION ALL
      SELECT 'count', '', '', 'unreadable', count(*)::VARCHAR FROM posts
        WHERE user_id % 40 = 5 AND ts >= TIMESTAMP '2024-01-29 00:00:00'"""
    return sql
