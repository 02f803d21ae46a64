"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_OP2 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[][] WHEN len(ws) = 1 THEN [ws] ELSE list_transform(range(1, len(ws)), lambda i: ws[i:i + 1]) END) AS g FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), grams AS (SELECT g, row_number() OVER () AS gid FROM (SELECT g FROM s GROUP BY g HAVING count(*) > 1)
), t AS (SELECT doc_id, gid FROM s JOIN grams USING (g)
), e AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.gid = b.gid AND a.doc_id < b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))
), r AS (
  SELECT doc_id AS id, doc_id AS c FROM documents
  UNION SELECT x.id, y.c FROM (SELECT a AS id, b AS o FROM e UNION SELECT b, a FROM e) x JOIN r y ON y.id = x.o
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id, d.doc_id = m.c AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON m.id = d.doc_id
"""

_OP4 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

_OP8 = r"""
WITH w AS (SELECT doc_id, text, coalesce('=' || source, 'null') AS host, md5(coalesce(text, '')) AS th, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), win AS (SELECT doc_id, unnest(range(1, len(ws) - 6)) AS i, ws FROM w
), rep AS (
  SELECT doc_id, count(*) AS n FROM (
    SELECT DISTINCT doc_id, unnest(range(i, i + 8)) FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 7]) AS c FROM win) WHERE c > 1) GROUP BY doc_id
), ln AS (SELECT doc_id, host, th, unnest(split(coalesce(text, ''), chr(10))) AS raw FROM w
), dup AS (SELECT doc_id, count(*) - count(DISTINCT raw) AS n FROM ln WHERE regexp_matches(raw, '[^\x20\x09-\x0D]') GROUP BY doc_id
), norm AS (SELECT doc_id, host, th, trim(translate(translate(raw, chr(9) || chr(11) || chr(12) || chr(13), '    '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS x FROM ln
), hashed AS (SELECT doc_id, host, th, md5(x) AS h, length(x) AS n FROM norm WHERE x <> ''
), freq AS (
  SELECT host, h FROM hashed JOIN (SELECT host, count(DISTINCT th) AS a FROM w GROUP BY host) USING (host)
  GROUP BY host, h, a HAVING count(DISTINCT th) >= 10 AND count(DISTINCT th) * 100 >= a
), chars AS (SELECT doc_id, sum(n)::BIGINT AS line_chars, coalesce(sum(n) FILTER (WHERE f.h IS NOT NULL), 0)::BIGINT AS frequent_chars FROM hashed x LEFT JOIN freq f ON f.host = x.host AND f.h = x.h GROUP BY doc_id
), m AS (
  SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
    coalesce(frequent_chars, 0) AS frequent_chars, coalesce(line_chars, 0) AS line_chars
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN chars USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed, frequent_chars, line_chars,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (line_chars - frequent_chars) >= 30 * line_chars AS kept FROM m
"""


def _crc32(text: str) -> str:
    """Bit by bit, as the dialect has no function for it."""
    return f"(4294967295 - list_reduce(list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT), lambda a, x: list_reduce(range(8), lambda b, i: xor(b >> 1, CASE WHEN b & 1 = 1 THEN 3988292384 ELSE 0 END), xor(a, x)), 4294967295::BIGINT))"


_OP11 = f"""
WITH t AS (SELECT conv_id, {{'r': coalesce(role, ''), 'x': coalesce(text, '')}} AS m, turn FROM conversations WHERE conv_id IS NOT NULL
), l AS (SELECT conv_id, list(m ORDER BY turn NULLS FIRST, md5(strlen(m.r)::VARCHAR || ':' || m.r || m.x)) AS s FROM t GROUP BY conv_id
), ids AS (SELECT conv_id AS c, {_crc32("conv_id::VARCHAR")} % 9 AS h, s FROM l
), n AS (SELECT c, list_concat(coalesce(b.s[1:h], []), ids.s[h + 1:]) AS s FROM ids LEFT JOIN l b ON b.conv_id = c - c % 5
), pre AS (SELECT c, d, len(s) AS n, md5(to_json(s[1:d])::VARCHAR) AS k, CASE WHEN d = 0 THEN 0 ELSE strlen(s[d].x) END AS bytes FROM (SELECT *, unnest(range(len(s) + 1)) AS d FROM n)
), node AS (SELECT k, d, min(c) AS c, count(*) AS n_convs, any_value(bytes) AS bytes FROM pre GROUP BY k, d
), up AS (SELECT DISTINCT a.k, b.k AS parent FROM pre a JOIN pre b ON a.c = b.c AND a.d = b.d + 1
), kids AS (SELECT parent AS k, count(*) AS n_children FROM up GROUP BY parent
), sums AS (
  SELECT a.k, sum(CASE WHEN kids.k IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((node.n_convs - 1) * node.bytes)::BIGINT AS saved_tokens
  FROM node JOIN pre a ON a.c = node.c AND a.d <= node.d LEFT JOIN kids ON kids.k = node.k GROUP BY a.k
), ends AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS h FROM pre WHERE d = n GROUP BY k)
SELECT node.c AS conv_id, node.d AS depth, p.c AS parent_conv_id, node.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, coalesce(h, sha256('')) AS ends_sha256
FROM node LEFT JOIN up ON up.k = node.k LEFT JOIN node p ON p.k = up.parent LEFT JOIN kids ON kids.k = node.k JOIN sums ON sums.k = node.k LEFT JOIN ends ON ends.k = node.k
"""


def _tree(name: str, levels: int) -> str:
    """Levels of the trees of name0 (g, i, d), what stands beside their nodes, and their roots."""
    out = []
    for k in range(levels):
        at, run = f"{name}{k}", "PARTITION BY g, i // 8 ORDER BY i ROWS BETWEEN"
        out += [
            f"{at}s AS (SELECT g, i, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {at} WHERE g IN (SELECT g FROM {at} GROUP BY g HAVING count(*) > 1))",
            f"{name}{k + 1} AS (SELECT g, i // 8 AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM {at} WHERE g IN (SELECT g FROM {at} GROUP BY g HAVING count(*) > 1) GROUP BY g, i // 8)",
        ]
    tops = " UNION ALL ".join(f"SELECT g, any_value(d) AS d FROM {name}{k} GROUP BY g HAVING count(*) = 1" for k in range(levels + 1))
    return ", ".join([*out, f"{name}top AS ({tops})"])


def _fold(name: str, levels: int, source: str, out: str, place: str) -> str:
    """source (g, the place, f, p) with the digest f carried up and the siblings added to p."""
    steps = []
    for k in range(levels):
        before = source if not k else f"{out}{k}"
        steps.append(f"{out}{k + 1} AS (SELECT b.* EXCLUDE (f, p), CASE WHEN s.l IS NULL THEN b.f ELSE sha256(s.l || b.f || s.r) END AS f, b.p || coalesce(s.l || s.r, '') AS p FROM {before} b LEFT JOIN {name}{k}s s ON s.g = b.g AND s.i = b.{place} // {8**k})")
    return ", ".join(steps)


def _field(column: str) -> str:
    return f"coalesce(strlen({column}) || ':' || {column}, '-')"


#: For up to 8 ** 7 documents of a language and 8 ** 3 languages.
_OP13 = f"""
WITH raw AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {" || ".join(_field(f"{c}::VARCHAR") for c in ("doc_id", "source", "lang", "n_chars"))} AS head, text, {_crc32("doc_id::VARCHAR")} % 3 = 0 AS hit FROM documents
), x AS (
  SELECT doc_id, g, sha256(head || {_field("text")}) AS leaf,
    sha256(head || CASE WHEN hit THEN {_field("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_field("text")} END) AS f FROM raw
), y AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, f) - 1 AS i FROM x
), a0 AS (SELECT g, i, leaf AS d FROM y), {_tree("a", 7)}
, langs AS (SELECT g AS lang, '' AS g, row_number() OVER (ORDER BY g) - 1 AS j, d FROM atop
), b0 AS (SELECT g, j AS i, d FROM langs), {_tree("b", 3)}
, p0 AS (SELECT *, '' AS p FROM y), {_fold("a", 7, "p0", "q", "i")}
, r0 AS (SELECT q7.* EXCLUDE (g), '' AS g, j, langs.d AS subroot FROM q7 JOIN langs ON langs.lang = q7.g), {_fold("b", 3, "r0", "z", "j")}
SELECT doc_id, leaf, subroot, btop.d AS root, sha256(p) AS proof_sha256, f AS folded_root, f = btop.d AS verified FROM z3 CROSS JOIN btop
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_minhash_near_dedup": _OP2, "op4_exact_top_k": _OP4, "op8_quality_rules": _OP8, "op11_prefix_trie": _OP11, "op13_merkle_manifest": _OP13}
