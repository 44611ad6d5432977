"""DuckDB SQL for the rows of the queries that SQL can express."""

from __future__ import annotations

from boardpulse.llm.oracle_stores import CODES, MANIFEST, SECRETS

_WORDS = """list_filter(regexp_split_to_array(
    translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""

ORACLE_SQL: dict[str, str] = {
    "op3_decontam": f"""
        WITH d AS (SELECT doc_id, {_WORDS.format(t="text")} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS.format(t="text")} AS w FROM benchmark),
        b2 AS (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0),
        grams AS (
            SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
            FROM (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM b2)),
        lengths AS (SELECT DISTINCT n FROM grams),
        tried AS (
            SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
            FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
                  FROM d CROSS JOIN lengths WHERE len(w) >= n)),
        met AS (SELECT doc_id, i, n, item_id FROM tried JOIN grams USING (n, g)),
        hit AS (
            SELECT doc_id, count(DISTINCT k) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM met) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM met) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        t AS (
            SELECT *, length(text)
                + len(regexp_extract_all(text, '\\|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|<s>|</s>|\[ROLE=|\[/ROLE\]'))
                + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 ELSE 8 END AS chars,
                lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS prior
            FROM c),
        g AS (
            SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars,
                string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS shown,
                coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS learnt,
                bool_and(CASE WHEN prior IS NULL THEN role IN ('system', 'user')
                              WHEN role = 'user' THEN prior IN ('system', 'assistant')
                              ELSE role = 'assistant' AND prior = 'user' END) AND max_by(role, turn) <> 'system' AS valid
            FROM t GROUP BY conv_id)
        SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(shown) AS turns_sha256,
               CAST(length(learnt) AS BIGINT) AS loss_chars, sha256(learnt) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars, valid
        FROM g""",
    "op11_secrets": SECRETS,
    "op12_dual_lloyd": CODES,
    "op13_merkle": MANIFEST,
}
