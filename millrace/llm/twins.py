"""SQL twins of the queries, for DuckDB over the same tables."""

from __future__ import annotations

from millrace.llm.quality import ENDS, NOTICES
from millrace.llm.text import GAP, LOWER, UPPER

_WORDS = "list_filter(string_split_regex({0}, '" + GAP + "'), lambda w: w <> '')"

EXACT = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM d WINDOW same AS (PARTITION BY t)
"""

QUALITY = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
starts AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS found
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)
),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM starts, range(3) AS r(k) WHERE found > 1 GROUP BY doc_id
),
given AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS x, unnest(range(len(string_split(t, chr(10))))) AS i FROM d
),
broken AS (
  SELECT doc_id, i, x, NOT coalesce(
      length(lag(x) OVER lines_of) >= 40
      AND NOT regexp_matches(lag(x) OVER lines_of, '[{ENDS}]["''”’»)\]]{{0,3}}[ \t\r]{{0,2}}$')
      AND regexp_matches(x, '^[\p{{Ll}}\p{{Lo}}]'), false) AS new_line
  FROM given WINDOW lines_of AS (PARTITION BY doc_id ORDER BY i)
),
joined AS (
  SELECT doc_id, string_agg(x, chr(10) ORDER BY i) AS x
  FROM (SELECT doc_id, i, x, sum(new_line::INT) OVER (PARTITION BY doc_id ORDER BY i) AS line FROM broken)
  GROUP BY doc_id, line
),
lines AS (
  SELECT doc_id, x, greatest(len(wx), 1) AS n, wx FROM (SELECT doc_id, x, {_WORDS.format("x")} AS wx FROM joined) WHERE len(wx) > 0
),
judged AS (
  SELECT doc_id, x,
    (NOT regexp_matches(right(trim(x, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 4), '[{ENDS}]["''”’»)\]]*$')
      AND (n < 8 OR NOT regexp_matches(x, '[{ENDS}]["''”’»)\]]*\s')))
    OR len(regexp_extract_all(x, '[#*$%&<>]{{2,}}')) > n * 0.1
    OR len(regexp_extract_all(x, '!!')) > n * 0.2
    OR len(list_filter(wx, lambda w: w IN ('|', '»', '›', '•', '·'))) >= n * 0.15
    OR (n <= 25 AND regexp_matches(lower(x), '{NOTICES}')) AS bad
  FROM lines
),
copies AS (
  SELECT doc_id, count(*) - count(DISTINCT x) AS dup FROM given WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id
),
per_doc AS (
  SELECT doc_id, sum(length(x)) AS chars,
         coalesce(sum(length(x)) FILTER (NOT bad), 0) AS kept_chars, count(*) FILTER (bad) AS removed
  FROM judged GROUP BY doc_id
),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         length(regexp_replace(t, '{GAP}', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(dup, 0)::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(kept_chars, 0)::BIGINT AS kept_chars,
         coalesce(removed, 0)::BIGINT AS n_lines_removed,
         coalesce(chars, 0) AS chars
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN per_doc USING (doc_id) LEFT JOIN copies USING (doc_id)
)
SELECT * EXCLUDE (chars), n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND kept_chars >= chars * 0.5 AS kept
FROM base
"""

CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(13 + length(regexp_replace(role, '(\\|' || chr(10) || '|### |</turn>)', '\\\1', 'g'))
              + length(regexp_replace(text, '(\\|### |</turn>)', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
r AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM r
"""

MIXING = f"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
         CASE WHEN n_chars >= 500 THEN 2.0 ELSE 1.0 END::DOUBLE AS wish,
         (('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS draw
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(size * wish) AS wished, coalesce(sum(size) FILTER (wish = 2), 0)::BIGINT AS long_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS n FROM d GROUP BY source
),
w AS (SELECT *, [3.0, 1.0, 2.0][(n - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w WINDOW o AS (ORDER BY cap / weight, n)
),
t AS (SELECT source, n, source_size, wished, long_size, least(weight * max(level) OVER (), cap) AS target FROM l),
-- long documents reach two copies first; what they can't take goes to the short ones
q AS (
  SELECT *, CASE WHEN wished > 0 THEN target / wished END AS first_rate,
         CASE WHEN 2 * target / nullif(wished, 0) >= 2 AND long_size > 0 AND source_size > long_size
              THEN greatest(target / wished, (target - 2.0::DOUBLE * long_size) / (source_size - long_size)::DOUBLE)
              ELSE target / nullif(wished, 0) END AS rate FROM t
),
e AS (
  SELECT doc_id, size, source_size, target, n, draw, coalesce(least(rate * wish, 2.0::DOUBLE), 0) AS expected
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
),
o AS (
  SELECT *, expected - floor(expected) AS chance, expected > floor(expected) AND size > 0 AS line,
         sum(floor(expected) * size) OVER (PARTITION BY n) AS given FROM e
),
r AS (
  SELECT *, CASE WHEN line THEN sum(size) OVER (PARTITION BY n, line ORDER BY draw / (1 - draw) / (chance / (1 - chance)), doc_id, size) END AS upto FROM o
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       (size * (floor(expected) + coalesce(line AND upto - size / 2 <= target - given, FALSE)::INT))::BIGINT AS taken
FROM r
"""


def _levels(name: str, n: int) -> str:
    """Tables {name}0 .. {name}n of nodes (tree, i, node), and {name}s0 .. with what stands left and right of each in its run."""
    out = []
    for k in range(n):
        out.append(f"""{name}c{k} AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {name}{k}),
{name}s{k} AS (
  SELECT tree, i, CASE WHEN n > 1 THEN coalesce(string_agg(node, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
         CASE WHEN n > 1 THEN coalesce(string_agg(node, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r
  FROM {name}c{k} WINDOW run AS (PARTITION BY tree, i // 8 ORDER BY i)
),
{name}{k + 1} AS (
  SELECT tree, i // 8 AS i, CASE WHEN max(n) > 1 THEN sha256(string_agg(node, '' ORDER BY i)) ELSE max(node) END AS node
  FROM {name}c{k} GROUP BY tree, i // 8
)""")
    return ",\n".join(out)


def _folds(name: str, tree: str, i: str, n: int, node: str) -> tuple[str, str, str]:
    """Joins with the siblings of each level, their proof, and the fold of ``node``."""
    joins = " ".join(f"JOIN {name}s{k} AS {name}x{k} ON {name}x{k}.tree = {tree} AND {name}x{k}.i = {i} // {8**k}" for k in range(n))
    proof = " || ".join(f"coalesce({name}x{k}.l || {name}x{k}.r, '')" for k in range(n))
    for k in range(n):
        node = f"list_transform([{node}], lambda x: CASE WHEN {name}x{k}.l IS NULL THEN x ELSE sha256({name}x{k}.l || x || {name}x{k}.r) END)[1]"
    return joins, proof, node


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_DEPTH, _TOP = 7, 2
_PATHS = _folds("a", "d.tree", "d.i", _DEPTH, "given")
_TOPS = _folds("b", "''", "t.i", _TOP, "f.folded")

MERKLE = f"""
WITH read AS (
  SELECT *, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree, {_leaf("text")} AS leaf,
         xor(list_reduce(list_prepend(4294967295, [ascii(x) FOR x IN string_split(doc_id::VARCHAR, '')]),
             lambda c, b: list_reduce([xor(c, b), 1, 1, 1, 1, 1, 1, 1, 1], lambda a, x: xor(a >> 1, 3988292384 * (a & 1)))), 4294967295) AS crc
  FROM documents
),
d AS (
  SELECT doc_id, tree, leaf, CASE WHEN crc % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE leaf END AS given,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM read
),
a0 AS (SELECT tree, i, leaf AS node FROM d),
{_levels("a", _DEPTH)},
t AS (SELECT tree, node, row_number() OVER (ORDER BY tree) - 1 AS i FROM a{_DEPTH}),
b0 AS (SELECT '' AS tree, i, node FROM t),
{_levels("b", _TOP)},
f AS (SELECT d.doc_id, d.tree, d.leaf, {_PATHS[1]} AS proof, {_PATHS[2]} AS folded FROM d {_PATHS[0]})
SELECT doc_id, leaf, t.node AS subroot, b{_TOP}.node AS root, sha256(proof || {_TOPS[1]}) AS proof_sha256,
       {_TOPS[2]} AS folded_root, {_TOPS[2]} = b{_TOP}.node AS verified
FROM f JOIN t USING (tree) CROSS JOIN b{_TOP} {_TOPS[0]}
"""

NEGATIVES = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
p AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS s
  FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
),
best AS (SELECT a, b, s FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
ranked AS (
  SELECT best.a, best.b, best.s, p.b AS nb, p.s AS ns, row_number() OVER (PARTITION BY best.a, best.b ORDER BY p.s DESC, p.b) AS n
  FROM best JOIN p ON p.a = best.a AND NOT p.same AND 100 * p.s BETWEEN 30 * best.s AND 90 * best.s
)
SELECT a AS anchor_id, b AS positive_id, n::INT AS rank, nb AS negative_id, s AS positive_score, ns AS negative_score FROM ranked WHERE n <= 10
"""
