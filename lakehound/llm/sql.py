"""DuckDB SQL of the operators that SQL can express; plain formulations over the whole tables."""

URL_FILTER = r"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block'))
SELECT u.page_id, u.host, u.path,
  (SELECT arg_max(rhost || rpath, length(rhost || rpath)) FROM rules
   WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)) AS rule,
  coalesce((SELECT arg_max(verdict, length(rhost || rpath)) FROM rules
   WHERE (u.host = rhost OR ends_with(u.host, '.' || rhost)) AND starts_with(u.path, rpath)), 'allow') AS verdict
FROM u
"""

QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
raw AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
lines AS (SELECT rid, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw FROM raw),
full_lines AS (SELECT rid, line, len(lw) AS n,
  translate(array_to_string(lw, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM lines WHERE len(lw) > 0),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM full_lines GROUP BY rid),
five AS (SELECT rid, i, array_to_string(ws[i:i + 4], ' ') AS g FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 4)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM five) WHERE c > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM twice, range(5) r(k) GROUP BY rid),
base AS (SELECT d.rid, d.doc_id, len(ws) AS n_words,
  coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN covered USING (rid)),
common AS (SELECT source, norm FROM full_lines JOIN d USING (rid) GROUP BY source, norm HAVING count(DISTINCT coalesce(doc_id::VARCHAR, '-')) > 20),
gone AS (SELECT f.rid, sum(n) AS n_boilerplate_words FROM full_lines f JOIN d USING (rid)
  JOIN common c ON c.source IS NOT DISTINCT FROM d.source AND c.norm = f.norm GROUP BY f.rid),
j AS (SELECT base.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  coalesce(n_boilerplate_words, 0)::BIGINT AS n_boilerplate_words FROM base LEFT JOIN gone USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_words - n_boilerplate_words >= 10
    AND 100 * (n_words - n_boilerplate_words) >= 40 * n_words AS kept, n_boilerplate_words FROM j
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
often AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.doc_id, k.i, k.line, o.key IS NOT NULL AND o.keeper <> k.doc_id AS gone FROM k LEFT JOIN often o USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT u, v FROM pairs JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * c >= 85 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON l.u = r.other)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


def _merkle(levels: int = 13) -> str:
    """Levels one by one: enough for 3 ** levels rows a source; a tree of one node left stays as it is."""
    h = "sha256(concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), " \
        "coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-'), coalesce(strlen({0}) || ':' || {0}, '-')))"
    bit = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda v, z: xor(v >> 1, (v & 1) * 3988292384))"
    crc = f"list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: {bit})"
    out = [f"""WITH d AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {h.format("text")} AS leaf,
  CASE WHEN {crc} & 1 = 1 THEN {h.format("replace(text, chr(10), '')")} END AS changed FROM documents),
w0 AS MATERIALIZED (SELECT doc_id, tree, leaf, coalesce(changed, leaf) AS f, '' AS proof,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
a0 AS MATERIALIZED (SELECT tree, i, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM w0)"""]

    def climb(a: str, k: int) -> str:
        return f"""{a}{k + 1} AS MATERIALIZED (SELECT tree, i // 3 AS i, (n + 2) // 3 AS n,
  CASE WHEN n = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h FROM {a}{k} GROUP BY tree, i // 3, n),
{a}s{k} AS MATERIALIZED (SELECT tree, i, n, coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(h, '') OVER (PARTITION BY tree, i // 3 ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after FROM {a}{k})"""

    def walk(w: str, a: str, k: int) -> str:
        kept = "w.doc_id, w.leaf, w.tree" + (", w.subroot" if a == "b" else "")
        on = "x.tree = w.tree AND x.i = w.i" if a == "a" else "x.i = w.i"
        return f"""{w}{k + 1} AS MATERIALIZED (SELECT {kept}, w.i // 3 AS i, CASE WHEN n = 1 THEN f ELSE sha256(concat(before, f, after)) END AS f,
  CASE WHEN n = 1 THEN proof ELSE concat(proof, before, after) END AS proof FROM {w}{k} w JOIN {a}s{k} x ON {on})"""

    for k in range(levels):
        out += [climb("a", k), walk("w", "a", k)]
    out += [f"""b0 AS MATERIALIZED (SELECT 0 AS tree, tree AS source, row_number() OVER (ORDER BY tree) - 1 AS i, h, count(*) OVER () AS n FROM a{levels}),
v0 AS MATERIALIZED (SELECT w.doc_id, w.leaf, w.tree, b.h AS subroot, b.i, w.f, w.proof FROM w{levels} w JOIN b0 b ON b.source = w.tree)"""]
    for k in range(levels):
        out += [climb("b", k), walk("v", "b", k)]
    return ",\n".join(out) + f"""
SELECT v.doc_id, v.leaf, v.subroot, r.h AS root, sha256(v.proof) AS proof_sha256, v.f AS folded_root, v.f = r.h AS verified
FROM v{levels} v CROSS JOIN b{levels} r
"""


MERKLE = _merkle()
