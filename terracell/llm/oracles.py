"""SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

SPACE = r"[\x20\x09-\x0D]"


def quality_sql(min_words: int, repeat_words: int, ngram_chars: dict[int, float], line_chars: float, symbols: float) -> str:
    """The quality report: windows of n words as text, told apart by document, covered words by a moving maximum."""

    def gram(n: int) -> str:
        return " || ' ' || ".join(["word", *(f"lead(word, {k}) OVER x" for k in range(1, n))])

    lengths = sorted(ngram_chars)
    grams = ", ".join(f"{gram(n)} AS g{n}" for n in sorted({3, *lengths}))
    later = ", ".join(f"CASE WHEN g{n} IS NOT NULL AND row_number() OVER (PARTITION BY rid, g{n} ORDER BY i) > 1 THEN 1 ELSE 0 END AS t{n}" for n in lengths)
    covered = ", ".join(f"max(t{n}) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}" for n in lengths)
    sums = ", ".join(f"cast(sum(chars * c{n}) AS bigint) AS dup_chars_{n}" for n in lengths)
    chars = ", ".join(f"coalesce(m.dup_chars_{n}, 0) AS dup_chars_{n}" for n in lengths)
    kept = " AND ".join(f"100 * dup_chars_{n} <= {most} * word_chars" for n, most in ngram_chars.items())
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM (
  SELECT rid, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words FROM d) q),
g AS (SELECT rid, i, length(word) AS chars, {grams} FROM w WINDOW x AS (PARTITION BY rid ORDER BY i)),
t AS (SELECT rid, i, chars, CASE WHEN g3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, g3) > 1 THEN 1 ELSE 0 END AS t3r, {later} FROM g),
c AS (SELECT rid, chars, max(t3r) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3r, {covered} FROM t),
m AS (SELECT rid, count(*) AS n_words, cast(sum(c3r) AS bigint) AS n_repeat_words, {sums} FROM c GROUP BY rid),
l AS (SELECT rid, line, row_number() OVER (PARTITION BY rid, line) AS k FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d) q
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
s AS (SELECT rid, cast(sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) AS bigint) AS n_dup_lines,
  cast(sum(CASE WHEN k > 1 THEN length(regexp_replace(line, '{SPACE}+', '', 'g')) ELSE 0 END) AS bigint) AS dup_line_chars FROM l GROUP BY rid),
a AS (SELECT d.doc_id, coalesce(m.n_words, 0) AS n_words, length(regexp_replace(d.text, '{SPACE}+', '', 'g')) AS word_chars,
  length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(s.n_dup_lines, 0) AS n_dup_lines,
  coalesce(m.n_repeat_words, 0) AS n_repeat_words, coalesce(s.dup_line_chars, 0) AS dup_line_chars, {chars}
  FROM d LEFT JOIN m ON m.rid = d.rid LEFT JOIN s ON s.rid = d.rid),
b AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > {repeat_words} * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND 100 * n_symbols <= {symbols} * n_words AND 100 * dup_line_chars <= {line_chars} * word_chars AND {kept} AS kept FROM b"""


def removal_sql(length: int) -> str:
    """Exact substrings: every window as text, the first place of each, and the bytes that later ones cover. Ids are unique."""
    return f"""WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, i, substring(x, cast(2 * i + 1 AS bigint), {2 * length}) AS s FROM (
  SELECT doc_id, x, unnest(range(0, greatest(n - {length - 1}, 0))) AS i FROM d) q),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM p) q WHERE k > 1),
runs AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {length} THEN 0 ELSE 1 END AS fresh FROM late) q),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {length} AS b FROM runs GROUP BY doc_id, run),
gaps AS (SELECT s.doc_id, s.a, s.b, coalesce(lag(s.b) OVER (PARTITION BY s.doc_id ORDER BY s.a), 0) AS from_, lead(s.a) OVER (PARTITION BY s.doc_id ORDER BY s.a) AS next_a FROM spans s),
kept AS (SELECT g.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
  string_agg(substring(d.x, cast(2 * from_ + 1 AS bigint), cast(2 * (a - from_) AS bigint))
    || CASE WHEN next_a IS NULL THEN substring(d.x, cast(2 * b + 1 AS bigint)) ELSE '' END, '' ORDER BY a) AS x
  FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, d.n AS n_bytes, cast(coalesce(k.n_removed, 0) AS bigint) AS n_removed, cast(coalesce(k.n_spans, 0) AS bigint) AS n_spans,
  sha256(unhex(coalesce(k.x, d.x))) AS kept_sha256 FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""


def spans_sql(several: int, words: int, lone: int) -> str:
    """Sentence spans: shortest runs by sums of words, compared as text. Ids are unique, white space is ASCII."""
    return f"""WITH s AS (SELECT doc_id, unnest(pieces) AS piece, unnest(range(0, len(pieces))) AS j FROM (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\\n]+[.!?\\n]*|[.!?\\n]+') AS pieces FROM documents) q),
c AS (SELECT doc_id, j, piece, trim(regexp_replace(lower(piece), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS clean FROM s),
n AS (SELECT *, len(string_split(clean, ' ')) AS n FROM c WHERE clean <> ''),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY j) AS r, sum(n) OVER (PARTITION BY doc_id ORDER BY j) AS upto FROM n),
pairs AS (
  SELECT a.doc_id, a.r AS ra, min(b.r) AS rb FROM r a JOIN r b ON b.doc_id = a.doc_id AND b.r BETWEEN a.r + {several - 1} AND a.r + {several + words}
    WHERE b.upto - a.upto + a.n >= {words} GROUP BY a.doc_id, a.r
  UNION SELECT a.doc_id, max(b.r), a.r FROM r a JOIN r b ON b.doc_id = a.doc_id AND b.r BETWEEN a.r - {several + words} AND a.r - {several - 1}
    WHERE a.upto - b.upto + b.n >= {words} GROUP BY a.doc_id, a.r
  UNION SELECT doc_id, r, r FROM r WHERE n >= {lone}),
content AS (SELECT p.doc_id, min(r.j) AS ja, max(r.j) AS jb, string_agg(r.clean, ' ' ORDER BY r.r) AS content
  FROM pairs p JOIN r ON r.doc_id = p.doc_id AND r.r BETWEEN p.ra AND p.rb GROUP BY p.doc_id, p.ra, p.rb),
late AS (SELECT doc_id, ja, jb FROM (SELECT *, row_number() OVER (PARTITION BY content ORDER BY doc_id, ja) AS k FROM content) q WHERE k > 1),
hit AS (SELECT DISTINCT c.doc_id, c.j FROM c JOIN late l ON l.doc_id = c.doc_id AND c.j BETWEEN l.ja AND l.jb),
w AS (SELECT c.*, h.j IS NOT NULL AS inside, max(CASE WHEN clean <> '' THEN c.j END) OVER (PARTITION BY c.doc_id ORDER BY c.j) AS holder
  FROM c LEFT JOIN hit h ON h.doc_id = c.doc_id AND h.j = c.j),
g AS (SELECT w.doc_id, w.j, w.piece, w.inside OR (w.clean = '' AND h.j IS NOT NULL) AS gone FROM w LEFT JOIN hit h ON h.doc_id = w.doc_id AND h.j = w.holder),
e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS begins FROM g),
t AS (SELECT doc_id, count(*) AS n_sentences, sum(CASE WHEN gone THEN 1 ELSE 0 END) AS n_removed, sum(CASE WHEN begins THEN 1 ELSE 0 END) AS n_spans,
  string_agg(CASE WHEN gone THEN '' ELSE piece END, '' ORDER BY j) AS text FROM e GROUP BY doc_id)
SELECT d.doc_id, coalesce(t.n_sentences, 0) AS n_sentences, cast(coalesce(t.n_removed, 0) AS bigint) AS n_removed,
  cast(coalesce(t.n_spans, 0) AS bigint) AS n_spans, coalesce(t.text, '') AS text FROM documents d LEFT JOIN t ON t.doc_id = d.doc_id"""


def negatives_sql(every: int, positives: int, negatives: int, low: int, high: int, scale: int) -> str:
    """Hard negatives: all anchors against all rows, ranked by windows. Vectors have one length."""
    return f"""WITH q AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, cast(list_dot_product(a.v, b.v) AS bigint) AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id WHERE a.vec_id % {every} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS k FROM s WHERE label = own) x WHERE k <= {positives}),
n AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS k
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND {low} * p.positive_score <= {high} * s.score AND s.score <= p.positive_score)
SELECT anchor_id, positive_id, cast(k AS integer) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= {negatives}"""


def manifest_sql(every: int) -> str:
    """Merkle manifest: both trees by recursion over their levels, proofs and folds over the siblings. Ids are unique."""

    def told(x: str) -> str:
        return f"coalesce(strlen(cast({x} AS varchar)) || ':' || cast({x} AS varchar), '-')"

    def tree(name: str, start: str) -> str:
        return f"""{name}(grp, level, pos, n, h) AS (
  {start}
  UNION ALL SELECT grp, level + 1, pos // 2, any_value((n + 1) // 2), sha256(string_agg(h, '' ORDER BY pos)) FROM {name} WHERE n > 1 GROUP BY grp, level, pos // 2)"""

    head, tail = (" || ".join(told(x) for x in names) for names in (("doc_id", "source", "lang"), ("text",)))
    return f"""WITH RECURSIVE crc(doc_id, i, c) AS (
  SELECT doc_id, 0, cast(4294967295 AS bigint) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL SELECT doc_id, i + 1, CASE WHEN i % 9 = 0
      THEN xor(c, cast(unicode(substring(cast(doc_id AS varchar), i // 9 + 1, 1)) AS bigint))
      WHEN c & 1 = 1 THEN xor(c >> 1, cast(3988292384 AS bigint)) ELSE c >> 1 END
    FROM crc WHERE i < 9 * length(cast(doc_id AS varchar))),
hit AS (SELECT doc_id, xor(c, cast(4294967295 AS bigint)) % {every} = 0 AS tampered FROM crc WHERE i = 9 * length(cast(doc_id AS varchar))),
leaf AS (SELECT d.doc_id, d.lang, sha256({head.replace("doc_id", "d.doc_id")} || {told("n_chars")} || {tail}) AS leaf,
  sha256({head.replace("doc_id", "d.doc_id")} || {told("n_chars + CASE WHEN tampered THEN 1 ELSE 0 END")} || {tail}) AS version,
  row_number() OVER (PARTITION BY lang ORDER BY d.doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
  FROM documents d JOIN hit ON hit.doc_id = d.doc_id),
{tree("low", "SELECT lang, 0, pos, n, leaf FROM leaf")},
sub AS (SELECT grp AS lang, h AS subroot, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS g, count(*) OVER () AS n FROM low WHERE n = 1),
{tree("high", "SELECT 0, 0, g, n, subroot FROM sub")},
steps AS (
  SELECT f.doc_id, low.level, t.level IS NOT NULL AS has, t.h, t.pos < low.pos AS before FROM leaf f JOIN low ON low.grp IS NOT DISTINCT FROM f.lang AND low.pos = f.pos >> low.level AND low.n > 1
    LEFT JOIN low t ON t.grp IS NOT DISTINCT FROM low.grp AND t.level = low.level AND t.pos = xor(low.pos, 1)
  UNION ALL
  SELECT f.doc_id, 1000 + high.level, t.level IS NOT NULL, t.h, t.pos < high.pos FROM leaf f JOIN sub ON sub.lang IS NOT DISTINCT FROM f.lang JOIN high ON high.pos = sub.g >> high.level AND high.n > 1
    LEFT JOIN high t ON t.level = high.level AND t.pos = xor(high.pos, 1)),
way AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY level) AS k FROM steps),
fold(doc_id, k, h) AS (
  SELECT doc_id, 0, version FROM leaf
  UNION ALL SELECT f.doc_id, f.k + 1, sha256(CASE WHEN NOT w.has THEN f.h WHEN w.before THEN w.h || f.h ELSE f.h || w.h END)
    FROM fold f JOIN way w ON w.doc_id = f.doc_id AND w.k = f.k + 1),
proofs AS (SELECT doc_id, sha256(coalesce(string_agg(h, '' ORDER BY k), '')) AS proof FROM way GROUP BY doc_id),
ends AS (SELECT doc_id, arg_max(h, k) AS folded FROM fold GROUP BY doc_id),
top AS (SELECT h AS root FROM high WHERE n = 1)
SELECT f.doc_id, f.leaf, sub.subroot, top.root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded AS folded_root, e.folded = top.root AS verified
FROM leaf f JOIN sub ON sub.lang IS NOT DISTINCT FROM f.lang JOIN ends e ON e.doc_id = f.doc_id CROSS JOIN top LEFT JOIN proofs p ON p.doc_id = f.doc_id"""


def duplicates_sql() -> str:
    """Exact duplicates: windows over the normalised texts. Ids are unique."""
    return """WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size, sha256(text) AS text_sha256 FROM n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g"""
