"""DuckDB SQL for the queries over secrets, vector codes and the manifest.

The rounds and levels of an operator are written out one after the other: eight
levels of a tree are enough for sixteen million rows of a language.
"""

from __future__ import annotations


def _rule(place: int, kind: str, pattern: str, kept: str = "true", lead: str = "0") -> str:
    """Matches of one kind with the gaps before them; a pattern may begin with a group for what must stand before it."""
    p = pattern.replace("'", "''")
    return f"""SELECT r, {place} AS place, '{kind}' AS kind, n, m[n] AS hit, g[n] AS gap, {lead} AS lead, {kept} AS kept FROM (
        SELECT r, regexp_extract_all(t, '{p}') AS m, regexp_split_to_array(t, '{p}') AS g, regexp_extract_all(t, '{p}', 1) AS one,
               unnest(generate_series(1, len(regexp_extract_all(t, '{p}')))) AS n
        FROM d WHERE regexp_matches(t, '{p}'))"""


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_ASSIGN = f"""(?:{'|'.join(map(_any_case, ('password', 'passwd', 'secret', 'token', 'api_?key')))})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
    hits AS (
        {_rule(0, "assign", _ASSIGN, "length(one[n]) >= 8")}
        UNION ALL {_rule(1, "access", "(AKIA[A-Z0-9]{12,})")}
        UNION ALL {_rule(2, "hex", "([0-9a-f]{32,})")}
        UNION ALL {_rule(3, "private_key", r"(-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?)")}
        UNION ALL {_rule(4, "web_token", r"(^|[^\w-])eyJ[\w-]{5,}\.[\w-]{8,}\.[\w-]{8,}", lead="length(one[n])")}
        UNION ALL {_rule(5, "host_token", "(^|[^A-Za-z0-9])gh[pousr]_[A-Za-z0-9]{36,}", lead="length(one[n])")}
        UNION ALL {_rule(6, "upper_hex", "(^|[^0-9A-F])[0-9A-F]{40,}", "regexp_matches(substr(m[n], length(one[n]) + 1), '[0-9]')", "length(one[n])")}),
    ends AS (
        SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY r, place ORDER BY n) AS stop FROM hits),
    spans AS (
        SELECT r, place, kind, stop - length(hit) + lead AS start, kind || ':' || CAST(stop - length(hit) + lead AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span
        FROM ends WHERE kept),
    found AS (
        SELECT r, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
               count(*) FILTER (WHERE place = 2) AS n_hex,
               string_agg(span, ',' ORDER BY start, place) FILTER (WHERE place < 3) AS base,
               string_agg(span, ',' ORDER BY start, place) AS spans
        FROM spans GROUP BY r)
    SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access,
           CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN found USING (r)"""


def _nearest(name: str, books: str) -> str:
    """For each part 64 times its least squared distance, plus the lowest entry of that distance."""
    return f"""{name} AS (
        SELECT r, p, min(far * 64 + e) AS best FROM (
            SELECT r, p, e, sum((x - y) * (x - y)) AS far FROM comps JOIN {books} USING (p, c) GROUP BY r, p, e)
        GROUP BY r, p)"""


def _means(name: str, old: str, nearest: str) -> str:
    return f"""{name} AS (
        SELECT p, e, c, coalesce(m, y) AS y FROM {old} LEFT JOIN (
            SELECT p, best % 64 AS e, c, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m
            FROM comps JOIN {nearest} USING (r, p) GROUP BY p, best % 64, c) USING (p, e, c))"""


CODES = f"""
    WITH kept AS (
        SELECT row_number() OVER () AS r, vec_id, label, embedding AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    spread AS (SELECT r, len(v) // 16 AS w, unnest(generate_series(0, len(v) - 1)) AS i, unnest(v) AS x FROM kept),
    comps AS (SELECT r, i // w AS p, i % w AS c, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM spread),
    first AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < 64),
    books0 AS (SELECT p, e, c, x AS y FROM comps JOIN first USING (r)),
    {_nearest("near0", "books0")}, {_means("books1", "books0", "near0")},
    {_nearest("near1", "books1")}, {_means("books2", "books1", "near1")},
    {_nearest("near2", "books2")},
    coded AS (
        SELECT r, string_agg(printf('%02x', CAST(best % 64 AS INTEGER)), '' ORDER BY p) AS code,
               CAST(sum(best // 64) AS BIGINT) AS error FROM near2 GROUP BY r),
    whole AS (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY p, e, c)) AS codebooks_sha256 FROM books2)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM kept JOIN coded USING (r) CROSS JOIN whole"""

_LEVELS, _TOP_LEVELS = 8, 3


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def _level(tree: str, k: int) -> str:
    """Nodes (tree, i, d, n) of the level above, and for each of this one what its run has to the left and right."""
    run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
    return f"""{tree}{k + 1} AS (
        SELECT tree, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE max(d) END AS d, (n + 7) // 8 AS n
        FROM {tree}{k} GROUP BY tree, i // 8, n),
    {tree}{k}_near AS (
        SELECT tree, i, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
               coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {tree}{k})"""


_STEPS = [("t", k) for k in range(_LEVELS)] + [("u", k) for k in range(_TOP_LEVELS)]


def _folds() -> str:
    """Each leaf with the proof so far and the digest folded so far, one level after the other."""
    out = ["f0 AS (SELECT tree, i, doc_id, leaf, shown AS cur, '' AS proof FROM leaves)"]
    for step, (tree, k) in enumerate(_STEPS):
        key, at = ("f.tree", f"f.i // {8**k}") if tree == "t" else ("0", f"f.tree // {8**k}")
        out.append(
            f"""f{step + 1} AS (
        SELECT f.tree, f.i, doc_id, leaf, proof || l || r AS proof, CASE WHEN n > 1 THEN sha256(l || cur || r) ELSE cur END AS cur
        FROM f{step} f JOIN {tree}{k}_near x ON x.tree = {key} AND x.i = {at})"""
        )
    return ",\n    ".join(out)


_BIT = "xor({x} // 2, ({x} % 2) * 3988292384)"
MANIFEST = f"""
    WITH RECURSIVE bits AS (
        SELECT i, i AS x, 0 AS k FROM (SELECT unnest(generate_series(0, 255)) AS i)
        UNION ALL SELECT i, {_BIT.format(x="x")}, k + 1 FROM bits WHERE k < 8),
    bytes AS (SELECT i, x FROM bits WHERE k = 8),
    sums AS (
        SELECT doc_id, CAST(doc_id AS VARCHAR) AS s, 1 AS k, CAST(4294967295 AS BIGINT) AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
        UNION ALL SELECT doc_id, s, k + 1, xor(x, c // 256) FROM sums JOIN bytes ON i = xor(c % 256, CAST(ord(substr(s, k, 1)) AS BIGINT)) WHERE k <= length(s)),
    crcs AS (SELECT doc_id, xor(c, 4294967295) AS crc FROM sums WHERE k = length(s) + 1),
    named AS (
        SELECT d.*, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, {_leaf("text")} AS leaf,
               translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents d),
    leaves AS (
        SELECT tree, doc_id, leaf, CASE WHEN crc % 3 = 0 THEN {_leaf("low")} ELSE leaf END AS shown,
               row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n
        FROM named LEFT JOIN crcs USING (doc_id)),
    t0 AS (SELECT tree, i, leaf AS d, n FROM leaves),
    {", ".join(_level("t", k) for k in range(_LEVELS))},
    u0 AS (SELECT 0 AS tree, tree AS i, d, count(*) OVER () AS n FROM t{_LEVELS}),
    {", ".join(_level("u", k) for k in range(_TOP_LEVELS))},
    {_folds()}
    SELECT f.doc_id, f.leaf, s.d AS subroot, o.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = o.d AS verified
    FROM f{len(_STEPS)} f JOIN t{_LEVELS} s ON s.tree = f.tree CROSS JOIN u{_TOP_LEVELS} o"""
