"""The queries' results as SQL for DuckDB.

For the board made from the given tables, the SQL starts from the documents'
lines and the rules the pages were made by; it parses no HTML. Only the queries
on the table ``pages`` read HTML here too, with RE2 patterns of their own.
"""

from __future__ import annotations

from boardpulse.config import ALLOWED_HOSTS, CATEGORY_PATTERN, FOOTER_LINES, SITE_ORIGIN, VIEWS_PREFIX, VOTES_PREFIX
from boardpulse.functions.text import WHITE_SPACE

_, WWW, BARE = ALLOWED_HOSTS
NL = "chr(10)"


def strip(text: str) -> str:
    return f"trim({text}, '{WHITE_SPACE}')"


def board(number: str) -> str:
    return f"CASE WHEN {number} % 7 = 3 THEN 5861 WHEN {number} % 11 = 5 THEN 1234 ELSE 5558 END"


# Text lines of each document with the post that line links to.
LINES = f"""
lines AS (
  SELECT doc_id AS page_id, lang, string_split(text, {NL}) AS all_lines,
         unnest(string_split(text, {NL})) AS line,
         unnest(range(len(string_split(text, {NL})))) AS i
  FROM documents
),
links AS (
  SELECT page_id, lang, line, i, page_id + i AS post, {board('page_id')} AS board,
         {board('(page_id + i)')} AS post_board
  FROM lines
)"""

URL = f"""CASE post % 8
    WHEN 0 THEN '{SITE_ORIGIN}/board/free/' || post_board || '/' || post || '?p=1&q=2'
    WHEN 1 THEN 'https://{WWW}/board/free/' || post_board || '/' || post
    WHEN 2 THEN 'https://{BARE}/board/free/' || post_board || '/' || post || '#c'
    WHEN 3 THEN '{SITE_ORIGIN}/board/free/' || post_board || '/' || post
    WHEN 4 THEN 'http://other.example.com/board/free/' || post_board || '/' || post
    WHEN 5 THEN '{SITE_ORIGIN}/board/prevnext.php?idx=' || post
    WHEN 6 THEN '{SITE_ORIGIN}/staff/board/free/' || post_board || '/' || post
    ELSE '{SITE_ORIGIN}/board/free/' || post_board || '/list?post=' || post END"""

HREF = f"""CASE post % 8
    WHEN 0 THEN '/board/free/' || post_board || '/' || post || '?p=1&q=2'
    WHEN 1 THEN 'https://{WWW}/board/free/' || post_board || '/' || post
    WHEN 2 THEN '//{BARE}/board/free/' || post_board || '/' || post || '#c'
    WHEN 3 THEN '../board/./free/' || post_board || '/' || post
    WHEN 4 THEN 'http://other.example.com/board/free/' || post_board || '/' || post
    WHEN 5 THEN '/board/prevnext.php?idx=' || post
    WHEN 6 THEN '/staff/board/free/' || post_board || '/' || post
    ELSE '/board/free/' || post_board || '/list?post=' || post END"""

# Anchors of the list pages: the pinned one first, then one per line.
ANCHORS = f"""{LINES},
anchors AS (
  SELECT board, page_id, 0 AS place, CAST(0 AS BIGINT) AS post, 5558 AS post_board,
         CASE WHEN board = 5558 THEN 'notice' END AS title_raw
  FROM links WHERE i = 0
  UNION ALL
  SELECT board, page_id, i + 1, post, post_board,
         CASE WHEN board = 1234 THEN NULL
              WHEN board = 5861 AND i % 4 <> 1 THEN NULL
              WHEN i % 4 = 3 THEN '[' || lang || ']' || {strip('line')}
              WHEN i % 5 = 0 THEN {strip("'[' || lang || '] ' || line")}
              ELSE {strip('line')} END
  FROM links
)"""

CATEGORY = f"^{CATEGORY_PATTERN}\\s*(.+)$"


def category(raw: str) -> str:
    return f"nullif(regexp_extract({raw}, '{CATEGORY}', 1), '')"


def title(raw: str) -> str:
    rest = f"regexp_extract({raw}, '{CATEGORY}', 2)"
    return strip(f"CASE WHEN {category(raw)} IS NULL THEN {raw} ELSE {rest} END")


REFS = f"""{ANCHORS},
refs AS (
  SELECT CAST(board AS INTEGER) AS board_id, post AS post_id, {URL} AS url,
         {title('title_raw')} AS title, {category('title_raw')} AS category, page_id,
         CAST(row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS INTEGER) AS pos
  FROM anchors
  WHERE post_board = board AND post % 8 < 5 AND title_raw <> ''
)"""

# Visible lines of the post pages.
PAGE_LINES = f"""
docs AS (
  SELECT doc_id AS post, {board('doc_id')} AS post_board, event_id, user_id, n_chars, ts,
         list_filter([{strip('x')} FOR x IN string_split(text, {NL})], lambda x: x <> '') AS body
  FROM (SELECT event_id AS doc_id, event_id, user_id, coalesce(n_chars, 0) AS n_chars, ts, coalesce(text, event_type) AS text
        FROM events LEFT JOIN documents ON doc_id = event_id)
),
page_lines AS (
  SELECT post, {URL} AS url, CASE post % 4
    WHEN 0 THEN ['post', 'user' || user_id, '조회: ' || n_chars, strftime(ts, '%Y-%m-%d %H:%M')]
                || body || ['추천: 3', '목록', 'below']
    WHEN 1 THEN ['post', 'user' || user_id, '조회: ' || n_chars, strftime(ts, '%Y-%m-%d %H:%M:%S')]
                || body || ['추천: 3', '목록', 'below']
    WHEN 2 THEN ['post', 'a very long name of user ' || user_id, '조회: ' || n_chars,
                 strftime(ts, '%Y-%m-%d %H:%M')]
                || body || ['short', '조회: ' || n_chars, '목록', 'below']
    ELSE ['post', '조회: ' || n_chars, strftime(ts, '%Y-%m-%d %H:%M'), '추천: 3'] || body
    END AS lines
  FROM docs
)"""


def parsed(seconds: str) -> str:
    date = f"(?:^|[^\\p{{L}}\\p{{N}}_])(20\\d{{2}}-\\d{{2}}-\\d{{2}}\\s+\\d{{2}}:\\d{{2}}{seconds})(?:$|[^\\p{{L}}\\p{{N}}_])"
    stops = ", ".join(f"coalesce(list_position(rest, '{w}'), len(rest) + 1)" for w in FOOTER_LINES)
    return f"""{PAGE_LINES},
dated AS (
  SELECT *, list_filter([regexp_extract(x, '{date}', 1) FOR x IN lines[1:120]], lambda x: x <> '')[1] AS created_at,
         list_filter([CASE WHEN starts_with(lines[k], '{VIEWS_PREFIX}') AND length(lines[k - 1]) <= 20
                           THEN lines[k - 1] END
                      FOR k IN range(2, least(len(lines), 120) + 1)], lambda x: x IS NOT NULL)[1] AS author
  FROM page_lines
),
bodies AS (
  SELECT *, lines[coalesce(list_position(lines, created_at), 0) + 1:] AS rest FROM dated
),
parsed AS (
  SELECT post, url, created_at, author, array_to_string(list_filter(
           rest[1:least({stops}) - 1],
           lambda x: NOT starts_with(x, '{VIEWS_PREFIX}') AND NOT starts_with(x, '{VOTES_PREFIX}')),
         {NL}) AS content
  FROM bodies
)"""


PARSED = parsed("")

BOARD_POSTS = f"""{REFS}, {PARSED},
posts AS (
  SELECT board_id, post_id, r.url, title, category, author, created_at, content, page_id, pos
  FROM refs r JOIN parsed p ON r.post_id = p.post
  WHERE post_id % 8 <> 4
)"""

# Documents as posts.
DOC_POSTS = f"""
doc_posts AS (
  SELECT CAST(5558 AS INTEGER) AS board_id, doc_id AS post_id, '{SITE_ORIGIN}/board/free/5558/' || doc_id AS url,
         string_split(text, {NL})[1] AS title, source AS author,
         array_to_string(string_split(text, {NL})[2:], {NL}) AS content, doc_id AS page_id
  FROM documents
)"""


def model_text(both: bool) -> str:
    head, rest = strip("coalesce(title, '')"), strip("coalesce(content, '')")
    if not both:
        return head
    return f"concat_ws(chr(10) || chr(10), nullif({head}, ''), nullif({rest}, ''))"


# Weights of hashed tokens per label, from the labelled documents.
BLANKS = "[\\x09-\\x0D ]+"


def buckets(every_text: str) -> str:
    """CTEs with the bucket of each token of some texts: the CRC-32 of its bytes, counted out byte by byte."""
    step = "xor({x} // 2, ({x} % 2) * 3988292384)"
    return f"""
crc_steps AS (
  SELECT i, i AS x, 0 AS k FROM (SELECT unnest(generate_series(0, 255)) AS i)
  UNION ALL SELECT i, {step.format(x='x')}, k + 1 FROM crc_steps WHERE k < 8
),
crc_bytes AS (SELECT i, x FROM crc_steps WHERE k = 8),
every_token AS (SELECT DISTINCT unnest({tokens('text')}) AS token FROM ({every_text})),
crc_sums AS (
  SELECT token, hex(token) AS bytes, 0 AS k, CAST(4294967295 AS BIGINT) AS c FROM every_token
  UNION ALL
  SELECT token, bytes, k + 1, xor(x, c // 256) FROM crc_sums JOIN crc_bytes
    ON i = xor(c % 256, CAST('0x' || substr(bytes, 2 * k + 1, 2) AS BIGINT))
  WHERE 2 * k < length(bytes)
),
token_buckets AS (SELECT token, xor(c, 4294967295) % 4096 AS bucket FROM crc_sums WHERE 2 * k = length(bytes))"""


def tokens(text: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({text}), '{BLANKS}'), lambda t: t <> '')"


def weights(every_text: str) -> str:
    """CTEs with the weights, and with the buckets of the tokens of the documents and some texts."""
    return f"""{buckets(f'SELECT text FROM documents UNION ALL {every_text}')},
labelled AS (
  SELECT CASE WHEN quality = 0 THEN 'neg' WHEN toxic = 1 THEN 'neu' ELSE 'pos' END AS label,
         unnest({tokens('text')}) AS token
  FROM documents JOIN labels USING (doc_id)
),
token_counts AS (SELECT label, bucket, count(*) AS n FROM labelled JOIN token_buckets USING (token) GROUP BY ALL),
shares AS (
  SELECT l.label, b.range AS bucket, coalesce(n, 0) + 1.0::DOUBLE AS n
  FROM range(4096) b CROSS JOIN (SELECT unnest(['neg', 'neu', 'pos']) AS label) l
  LEFT JOIN token_counts c ON c.label = l.label AND c.bucket = b.range
),
logs AS (SELECT label, bucket, ln(n / sum(n) OVER (PARTITION BY label)) AS w FROM shares),
weights AS (
  SELECT bucket, label, CAST(round((w - avg(w) OVER (PARTITION BY bucket)) * 1000000) AS BIGINT) AS w FROM logs
),
wide AS (
  SELECT bucket, sum(w) FILTER (WHERE label = 'neg') AS wa, sum(w) FILTER (WHERE label = 'neu') AS wb,
         sum(w) FILTER (WHERE label = 'pos') AS wc
  FROM weights GROUP BY bucket
)"""


def scored(source: str, text: str, floor: float = 0.0) -> str:
    """CTEs that add probabilities, score and label to ``source``."""
    return f"""{weights(f'SELECT {text} FROM {source}')},
numbered AS (SELECT *, row_number() OVER () AS row_no FROM {source}),
token_sums AS (
  SELECT row_no, count(*) AS size, sum(wa) AS sa, sum(wb) AS sb, sum(wc) AS sc
  FROM (SELECT row_no, unnest({tokens(text)}) AS token FROM numbered) t
  JOIN token_buckets USING (token) JOIN wide USING (bucket) GROUP BY row_no
),
outputs AS (
  SELECT *, {strip(f"coalesce({text}, '')")} = '' AS blank,
         coalesce(CAST(sa AS DOUBLE) / (size * 1000000) * 20, 0) AS a,
         coalesce(CAST(sb AS DOUBLE) / (size * 1000000) * 20, 0) AS b,
         coalesce(CAST(sc AS DOUBLE) / (size * 1000000) * 20, 0) AS c
  FROM numbered LEFT JOIN token_sums USING (row_no)
),
{judged(floor)}"""


def judged(floor: float = 0.0) -> str:
    """CTEs that make probabilities, score and label of ``outputs`` (a, b, c, blank)."""
    return f"""probs AS (
  SELECT *, CASE WHEN blank THEN 0 ELSE exp(a) / (exp(a) + exp(b) + exp(c)) END AS neg,
         CASE WHEN blank THEN 1 ELSE exp(b) / (exp(a) + exp(b) + exp(c)) END AS neu,
         CASE WHEN blank THEN 0 ELSE exp(c) / (exp(a) + exp(b) + exp(c)) END AS pos_p
  FROM outputs
),
scored AS (
  SELECT *, CASE WHEN blank OR greatest(neg, neu, pos_p) < {floor} THEN 'neu'
                 WHEN c >= greatest(a, b) THEN 'pos' WHEN a >= greatest(b, c) THEN 'neg'
                 ELSE 'neu' END AS sentiment_label,
         round(pos_p - neg, 6) AS sentiment_score, round(neg, 6) AS prob_neg,
         round(neu, 6) AS prob_neu, round(pos_p, 6) AS prob_pos
  FROM probs
)"""


# What a caller's model sees and says of a text.
LETTERS = f"""
letter_texts AS (
  SELECT *, {strip("model_text")} = '' AS blank,
         regexp_extract(model_text, '^(?:[\\x09-\\x0D ]*[^\\x09-\\x0D ]+){{0,40}}') AS seen
  FROM doc_texts
),
outputs AS (
  SELECT *, length(seen) % 5 AS a, (length(seen) - length(replace(seen, 'e', ''))) % 5 AS b,
         (length(seen) - length(replace(seen, ' ', ''))) % 4 AS c
  FROM letter_texts
)"""

SCORES = "sentiment_label, sentiment_score, prob_neg, prob_neu, prob_pos"
VERSION = "'token-weights-1' AS model_version"
BOTH = "'title+content' AS text_used"
CRAWLED = "'2026-02-01T00:00:00.000000+00:00' AS crawled_at"

TEXTS = """
texts AS (
  SELECT 'doc' AS kind, doc_id AS id, CAST(0 AS BIGINT) AS part, text FROM documents
  UNION ALL
  SELECT 'turn', conv_id, turn, text FROM conversations
  UNION ALL SELECT DISTINCT 'blank', conv_id, CAST(0 AS BIGINT), '  ' || chr(10) FROM conversations
)"""

DOC_SCORED = f"""{DOC_POSTS},
doc_texts AS (SELECT *, {model_text(True)} AS model_text FROM doc_posts),
{scored('doc_texts', 'model_text')}"""

BOARD_SCORED = f"""{BOARD_POSTS},
post_texts AS (SELECT *, {model_text(True)} AS model_text FROM posts),
{scored('post_texts', 'model_text')}"""

BOARD_ANALYZED = f"""WITH RECURSIVE {BOARD_SCORED}
SELECT board_id, post_id, url, title, nullif(content, '') AS content, author, created_at, {CRAWLED},
       {SCORES}, {VERSION}, {BOTH}, page_id, pos
FROM scored"""

PAYLOAD_REST = f"board_id, post_id, title, url, {SCORES}, {BOTH}, {VERSION}"
PAYLOAD = f"'5558:' || post_id AS doc_id, {PAYLOAD_REST}"

REASONS = f"""WITH {REFS}
SELECT 'reject' AS kind, url AS what, post_id AS id,
       CASE WHEN post_id % 8 = 4 THEN 'host_not_allowed' ELSE 'page_missing' END AS reason
FROM refs WHERE post_id % 8 = 4 OR post_id NOT IN (SELECT event_id FROM events)
UNION ALL
SELECT DISTINCT 'quarantine', CAST(board AS VARCHAR), page_id, NULL FROM links
WHERE page_id NOT IN (SELECT page_id FROM refs)"""

# Anchors of the table "pages": the source is cut before each anchor, after
# comments, scripts and styles are gone. Their links are simple.
PAGE_HREFS = """
cut AS (
  SELECT page_id, string_split(regexp_replace(regexp_replace(html,
           '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '', 'g'),
           '(?i)<a(\\s)', chr(1) || '<a\\1', 'g'), chr(1))[2:] AS pieces
  FROM pages
),
page_hrefs AS (
  SELECT page_id, unnest(range(len(hrefs))) AS pos, unnest(hrefs) AS href
  FROM (SELECT page_id, list_filter([regexp_extract(x, '(?is)^<a\\s[^>]*?href="([^"]*)"', 1) FOR x IN pieces],
                                    lambda x: x <> '') AS hrefs FROM cut)
)"""

ALL_LINKS = f"""{LINES}, {PAGE_HREFS},
all_links AS (
  SELECT page_id, i, {HREF} AS href, {URL} AS url FROM links
  UNION ALL
  SELECT page_id, pos, href, '{SITE_ORIGIN}' || href FROM page_hrefs
),
paths AS (
  SELECT page_id, i, url, string_split(string_split(regexp_replace(url, '^https?://[^/]*', ''), '?')[1], '#')[1] AS path
  FROM all_links
)"""

ENTITIES = (("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "))


def decoded(text: str) -> str:
    """The references that occur in ``pages``; the ampersand comes last."""
    for name, char in (*ENTITIES, ("&amp;", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return text


VISIBLE = f"""
bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html,
           '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', {NL}, 'g'),
           '<[/!?A-Za-z_:][^>]*>?', {NL}, 'g') AS text
  FROM pages
),
shown AS (
  SELECT page_id, list_filter([{strip('x')} FOR x IN string_split({decoded('text')}, {NL})],
                              lambda x: x <> '') AS lines
  FROM bare
)"""

ORACLE_SQL: dict[str, str] = {
    "page_links": f"WITH {PAGE_HREFS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM page_hrefs",
    "resolved_links": f"WITH {ALL_LINKS} SELECT page_id, CAST(i AS INTEGER) AS i, href, url FROM all_links",
    "allowed_links": f"""WITH {ALL_LINKS}
SELECT page_id, CAST(i AS INTEGER) AS i, path, regexp_extract(url, '^https?://([^/]*)', 1) AS authority,
       path IN ('/board/prevnext.php', '/powerbbs/prevnext.php', '/webzine/prevnext.php')
         OR starts_with(path, '/staff/') AS disallowed,
       regexp_extract(url, '^https?://([^/]*)', 1) IN ('{"', '".join(ALLOWED_HOSTS)}') AS host_allowed
FROM paths""",
    "post_ids": f"""WITH {ALL_LINKS}
SELECT page_id, CAST(i AS INTEGER) AS i,
       TRY_CAST(nullif(regexp_extract(path, '/board/[^/]+/' || ({board('page_id')}) || '/([0-9]+)', 1), '') AS BIGINT) AS post_id
FROM paths""",
    "list_titles": f"""WITH {ANCHORS}
SELECT CAST(board AS INTEGER) AS board_id, page_id, CAST(place AS INTEGER) AS pos, title_raw FROM anchors""",
    "split_category": f"""WITH raw AS (
  SELECT doc_id, i, CASE WHEN doc_id % 2 = 0 THEN '[' || source || ']' ELSE '[' || lang || ']  ' END || line AS title_raw
  FROM (SELECT doc_id, source, lang, unnest(string_split(text, {NL})) AS line,
               unnest(range(len(string_split(text, {NL})))) AS i FROM documents))
SELECT doc_id, CAST(i AS INTEGER) AS i, {category('title_raw')} AS category, {title('title_raw')} AS title FROM raw""",
    "board_refs": f"WITH {REFS} SELECT * FROM refs",
    "refs_capped": f"WITH {REFS} SELECT * FROM refs WHERE pos < 30",
    "list_quarantine": f"""WITH {REFS}
SELECT DISTINCT CAST(board AS INTEGER) AS board_id, page_id, true AS is_list
FROM links WHERE page_id NOT IN (SELECT page_id FROM refs)""",
    "latest_snapshots": f"WITH {PAGE_LINES} SELECT url, false AS is_old FROM page_lines",
    "store_lookup": f"""WITH {REFS}, {PAGE_LINES}
SELECT url, unnest(['2026-01-01', '2026-02-01']) AS day FROM page_lines WHERE url IN (SELECT url FROM refs)""",
    "visible_lines": f"""WITH {VISIBLE}
SELECT page_id, CAST(unnest(range(len(lines))) AS INTEGER) AS pos, unnest(lines) AS line FROM shown""",
    "post_fields": f"WITH {PARSED} SELECT url, created_at, author, content FROM parsed",
    "post_fields_seconds": f"WITH {parsed('(?::[0-9]{2})?')} SELECT url, created_at, author, content FROM parsed",
    "ref_rejects": f"""WITH {REFS}
SELECT url, post_id, CASE WHEN post_id % 8 = 4 THEN 'host_not_allowed' ELSE 'page_missing' END AS reason
FROM refs WHERE post_id % 8 = 4 OR post_id NOT IN (SELECT event_id FROM events)""",
    "board_posts": f"WITH {BOARD_POSTS} SELECT * FROM posts",
    "board_posts_hot": f"WITH {BOARD_POSTS} SELECT * FROM posts",
    "model_text_title": f"WITH {DOC_POSTS} SELECT post_id, {model_text(False)} AS model_text FROM doc_posts",
    "model_text_content": f"WITH {DOC_POSTS} SELECT post_id, {model_text(True)} AS model_text FROM doc_posts",
    "sentiment_scores": f"WITH RECURSIVE {TEXTS}, {scored('texts', 'text')} SELECT kind, id, part, {SCORES} FROM scored",
    "sentiment_neutral_floor": f"WITH RECURSIVE {TEXTS}, {scored('texts', 'text', 0.6)} SELECT kind, id, part, {SCORES} FROM scored",
    "batch_scoring": f"WITH RECURSIVE {DOC_SCORED} SELECT post_id, {SCORES} FROM scored",
    "model_batches": f"""WITH {DOC_POSTS}, doc_texts AS (SELECT *, {model_text(True)} AS model_text FROM doc_posts),
{LETTERS}, {judged()}
SELECT post_id, {SCORES} FROM scored""",
    "analyzed_posts": f"""WITH RECURSIVE {DOC_SCORED}
SELECT board_id, post_id, url, title, nullif(content, '') AS content, author,
       CAST(NULL AS VARCHAR) AS created_at, {CRAWLED}, {SCORES}, {VERSION}, {BOTH}
FROM scored""",
    "kafka_payload": f"WITH RECURSIVE {DOC_SCORED} SELECT '5558:' || post_id AS key, {PAYLOAD} FROM scored",
    "post_sample": f"""WITH {DOC_POSTS}
SELECT board_id, post_id, url, CAST(NULL AS VARCHAR) AS category, title, author,
       CAST(NULL AS VARCHAR) AS created_at,
       CASE WHEN length(content) > 120 THEN substring(content, 1, 120) || '…' ELSE content END AS content_preview
FROM doc_posts ORDER BY page_id LIMIT 5""",
    "analyzed_sample": f"""WITH RECURSIVE {DOC_SCORED}
SELECT '5558:' || post_id AS doc_id, title, {SCORES}, {BOTH}, {VERSION}, url
FROM scored ORDER BY page_id LIMIT 10""",
    "payload_sample": f"WITH RECURSIVE {DOC_SCORED} SELECT {PAYLOAD} FROM scored ORDER BY page_id LIMIT 3",
    "latest_per_document": f"""WITH RECURSIVE {DOC_SCORED}
SELECT '5558:' || post_id AS doc_id,
       {CRAWLED}, page_id + 1 AS page_id, 'neu' AS sentiment_label
FROM scored""",
    "collect_posts_job": f"WITH {BOARD_POSTS} SELECT * FROM posts",
    "score_board_job": BOARD_ANALYZED,
    "run_counters": f"""WITH {BOARD_POSTS}
SELECT 'refs' AS stage, count(*) AS rows FROM refs
UNION ALL SELECT unnest(['posts', 'analyzed', 'sent']), count(*) FROM posts""",
    "sent_messages": f"WITH RECURSIVE {BOARD_SCORED} SELECT board_id || ':' || post_id AS key, board_id || ':' || post_id AS doc_id, {PAYLOAD_REST} FROM scored",
    "collect_posts_reasons": REASONS,
    "score_board_reasons": REASONS,
    "once_stream": BOARD_ANALYZED,
}
