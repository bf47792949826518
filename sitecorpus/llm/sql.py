"""DuckDB SQL for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

NGRAM_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words] ELSE list_distinct(
         list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) END AS grams FROM w),
sets AS (SELECT doc_id, grams, len(grams) AS n FROM s),
heads AS (SELECT min(doc_id) AS id, any_value(n) AS n, list_sort(grams) AS g, list(doc_id) AS members
          FROM sets WHERE n > 0 GROUP BY list_sort(grams)),
e AS (SELECT id, n, unnest(g) AS gram FROM heads),
pairs AS (SELECT a.id AS a, b.id AS b FROM e a JOIN e b USING (gram) WHERE a.id < b.id
          AND 10 * a.n >= 9 * b.n AND 10 * b.n >= 9 * a.n
          GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(id, r) AS (SELECT id, id FROM heads UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r),
roots AS (SELECT id, min(r) AS root FROM reach GROUP BY id),
counts AS (SELECT links.a AS id, sum(len(o.members)) AS c FROM links JOIN heads o ON o.id = links.b GROUP BY links.a),
placed AS (SELECT unnest(members) AS doc_id, root, len(members) - 1 + coalesce(c, 0) AS n_links
           FROM heads JOIN roots USING (id) LEFT JOIN counts USING (id))
SELECT sets.doc_id, sets.n::BIGINT AS n_shingles, coalesce(placed.root, sets.doc_id) AS component_id,
       coalesce(placed.n_links, 0)::BIGINT AS n_links
FROM sets LEFT JOIN placed USING (doc_id)
"""

SUBSTRING_DEDUP = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS words FROM documents),
win AS (SELECT doc_id, unnest(range(1, len(words) - 33)) AS i, words FROM w WHERE len(words) >= 35),
h AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS win FROM win),
rep AS (SELECT win FROM h GROUP BY win HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM h JOIN rep USING (win)),
pos AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n
         FROM pos ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

_ASSIGN = (r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|"""
           r"""[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""")


def _kind(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return rf"""
{kind}_m AS (SELECT doc_id, regexp_split_to_array(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}') AS hits,
             regexp_extract_all(t, '{pattern}', {group}) AS part FROM d WHERE regexp_matches(t, '{pattern}')),
{kind}_p AS (SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, gaps, hits, part FROM {kind}_m),
{kind}_s AS (SELECT doc_id, '{kind}' AS kind, {rank} AS rank,
             list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1],
             lambda x: length(x))), 0) AS s, length(hits[i]) AS n FROM {kind}_p WHERE length(part[i]) >= {least})"""


SECRET_SCANS = "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)," + ",".join((
    _kind("assign", 0, _ASSIGN, 1, 12), _kind("access", 1, "AKIA[A-Z0-9]+", 0, 18), _kind("hex", 2, "[0-9a-f]+", 0, 16))) + """,
u AS (SELECT * FROM assign_s UNION ALL SELECT * FROM access_s UNION ALL SELECT * FROM hex_s),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k,
      count(*) FILTER (kind = 'hex') AS h,
      string_agg(kind || ':' || s::BIGINT || ':' || (s + n)::BIGINT, ',' ORDER BY s, rank) AS spans FROM u GROUP BY doc_id)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(k, 0) AS n_access, coalesce(h, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""

SOURCE_MIXING = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w FROM d GROUP BY source),
edge AS (SELECT a.source, 3.0 * a.n / a.w AS r, sum(least(3.0 * b.n, 3.0 * a.n / a.w * b.w)) AS given
         FROM s a, s b GROUP BY a.source, a.n, a.w),
held AS (SELECT coalesce(max(r), -1) AS r FROM edge WHERE given <= (SELECT sum(n) FROM s)),
level AS (SELECT (SELECT sum(n) FROM s) - coalesce(sum(3.0 * n) FILTER (3.0 * n / w <= r), 0) AS remains,
                 sum(w) FILTER (3.0 * n / w > r) AS weight FROM s, held),
t AS (SELECT source, n, least(3.0 * n, coalesce(remains / weight * w, 3.0 * n))::DOUBLE AS target FROM s, level),
r AS (SELECT *, CASE WHEN n > 0 THEN least(target / n, 3.0) ELSE 0 END AS rate FROM t)
SELECT d.doc_id, d.size, r.n AS source_size, r.target, d.size * (floor(rate)::BIGINT + CASE WHEN
       ('0x' || substr(md5('20:' || d.doc_id), 1, 13))::BIGINT / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
"""


def _crc32(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit (polynomial 0xEDB88320)."""
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda z: ord(z)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}), 4294967295)"


def _field(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


def _tree(name: str, levels: int) -> str:
    """Levels of the trees of ``name``0 (grp, idx, n, h), and each node's siblings to the left and right."""
    out = []
    for k in range(levels):
        out.append(f"""
{name}{k + 1} AS (SELECT grp, idx // 16 AS idx, max((n + 15) // 16) AS n, sha256(string_agg(h, '' ORDER BY idx)) AS h
        FROM {name}{k} WHERE n > 1 GROUP BY grp, idx // 16)""")
    for k in range(levels):
        out.append(f"""
{name}p{k} AS (SELECT a.grp, a.idx, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
        coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
        FROM {name}{k} a JOIN {name}{k} b ON a.grp = b.grp AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY a.grp, a.idx)""")
    return ",".join(out)


def _climb(start: str, name: str, levels: int, grp: str, at: str) -> str:
    """Fold ``start`` (with proof, fold) up the trees of ``name``."""
    out, before = [], start
    for k in range(levels):
        out.append(f"""
{name}f{k} AS (SELECT f.* EXCLUDE (proof, fold), proof || coalesce(p.l || p.r, '') AS proof,
        CASE WHEN p.idx IS NULL THEN fold ELSE sha256(p.l || fold || p.r) END AS fold
        FROM {before} f LEFT JOIN {name}p{k} p ON p.grp = f.{grp} AND p.idx = f.{at} // {16 ** k})""")
        before = f"{name}f{k}"
    return ",".join(out)


_LEAF = "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {text})"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
MERKLE_MANIFEST = f"""
WITH d AS (SELECT doc_id, coalesce('1' || source, '0') AS grp, {_LEAF.format(text=_field("text"))} AS leaf,
     {_LEAF.format(text=_field(_LOWER))} AS low, coalesce({_crc32("doc_id::VARCHAR")} % 5 = 0, false) AS hit FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM d),
s0 AS (SELECT grp, pos AS idx, n, leaf AS h FROM o),{_tree("s", 6)},
sub AS (SELECT grp, h FROM ({" UNION ALL ".join(f"SELECT grp, h FROM s{k} WHERE n = 1" for k in range(7))}) x),
t0 AS (SELECT 'all' AS grp, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n, h, grp AS sg FROM sub),{_tree("t", 4)},
top AS ({" UNION ALL ".join(f"SELECT h AS root FROM t{k} WHERE n = 1" for k in range(5))}),
start AS (SELECT o.doc_id, o.grp, o.pos, o.leaf, sub.h AS subroot, t0.grp AS tg, t0.idx AS tat, '' AS proof,
          CASE WHEN hit THEN low ELSE leaf END AS fold FROM o JOIN sub ON o.grp = sub.grp JOIN t0 ON t0.sg = o.grp),{
_climb("start", "s", 6, "grp", "pos")},{_climb("sf5", "t", 4, "tg", "tat")}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = root AS verified FROM tf3, top
"""
