"""Queries of the operators that audit a corpus: manifest, divergence of sources, license scans; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm import divergence, licenses, manifest
from lexmill.llm.registry import query, table

_LOWER = f"translate({{}}, '{licenses.UPPER}', '{licenses.LOWER}')"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


_HEAD = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_SIBLINGS = """SELECT t.lang, t.level, t.i, coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i < t.i), '') AS l,
    coalesce(string_agg(s.digest, '' ORDER BY s.i) FILTER (s.i > t.i), '') AS r
  FROM {tree} t JOIN {tree} s ON s.lang IS NOT DISTINCT FROM t.lang AND s.level = t.level AND s.i // 8 = t.i // 8
  WHERE t.n > 1 GROUP BY ALL"""
# CRC-32 bit by bit: 3988292384 is its reflected polynomial, and -1 stands for a shift.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x:
  CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""
_OP11_SQL = f"""WITH RECURSIVE
leaf AS (SELECT doc_id, lang, sha256({_HEAD} || {_field('text')}) AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN sha256({_HEAD} || {_field(_LOWER.format('text'))}) END AS changed,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM documents),
tree(lang, level, i, n, digest) AS (SELECT lang, 0, i, n, leaf FROM leaf
  UNION ALL SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM tree WHERE n > 1
  GROUP BY lang, level, i // 8, n),
sub AS (SELECT lang, digest, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tree WHERE n = 1),
top(lang, level, i, n, digest) AS (SELECT 0, 0, i, n, digest FROM sub
  UNION ALL SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1
  GROUP BY lang, level, i // 8, n),
low AS ({_SIBLINGS.format(tree='tree')}),
high AS ({_SIBLINGS.format(tree='top')}),
path AS (SELECT doc_id, low.level AS k, l, r FROM leaf JOIN low ON low.lang IS NOT DISTINCT FROM leaf.lang
    AND low.i = CAST(leaf.i AS BIGINT) // CAST(power(8, low.level) AS BIGINT)
  UNION ALL SELECT doc_id, 1000 + high.level, l, r FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang
    JOIN high ON high.i = sub.i // CAST(power(8, high.level) AS BIGINT)),
steps AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS k, l, r FROM path),
fold(doc_id, k, got) AS (SELECT doc_id, 0, coalesce(changed, leaf) FROM leaf
  UNION ALL SELECT f.doc_id, f.k + 1, sha256(s.l || f.got || s.r) FROM fold f JOIN steps s ON s.doc_id = f.doc_id AND s.k = f.k),
done AS (SELECT doc_id, arg_max(got, k) AS folded_root FROM fold GROUP BY 1),
proof AS (SELECT doc_id, sha256(string_agg(l || r, '' ORDER BY k)) AS proof_sha256 FROM steps GROUP BY 1),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT leaf.doc_id, leaf.leaf, sub.digest AS subroot, root.root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
  folded_root = root.root AS verified
FROM leaf JOIN sub ON sub.lang IS NOT DISTINCT FROM leaf.lang CROSS JOIN root JOIN done USING (doc_id) LEFT JOIN proof USING (doc_id)"""

_OP12_SQL = rf"""WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
grp AS (SELECT DISTINCT lang, source FROM docs),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM words GROUP BY 1, 2 HAVING count(DISTINCT d) >= {divergence.LEAST}),
cnt AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY 1, 2, 3),
every AS (SELECT grp.lang, grp.source, kept.term, coalesce(cnt.n, 0) AS n, kept.n AS lang_n FROM grp JOIN kept USING (lang)
  LEFT JOIN cnt ON cnt.lang = grp.lang AND cnt.source = grp.source AND cnt.term = kept.term),
sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total,
  count(*) OVER (PARTITION BY lang, source) AS v FROM every),
p AS (SELECT lang, source, term, n, CAST(1 + {divergence.SCALE}::HUGEINT * (n + 5) // (total::HUGEINT + 5 * v) AS BIGINT) AS p,
  CAST(1 + {divergence.SCALE}::HUGEINT * (lang_n + 5) // (lang_total::HUGEINT + 5 * v) AS BIGINT) AS q FROM sums),
apart AS (SELECT x.lang, x.source, y.source AS item, CAST(sum(abs(x.p - y.p)) AS BIGINT) AS value FROM p x JOIN p y
  ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3),
pairs AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(apart.value, 0) AS value FROM grp x JOIN grp y
  ON x.lang = y.lang AND x.source <> y.source LEFT JOIN apart ON apart.lang = x.lang AND apart.source = x.source AND apart.item = y.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {divergence.TOP}"""


def _values() -> str:
    said = lambda v: "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    rows = licenses.template_rows([*licenses.PHRASES, *licenses.NOTICES])
    return ", ".join("(" + ", ".join(said(v) for v in r) + ")" for r in rows)


_RUN = f"CASE WHEN phrase THEN 2 ELSE {licenses.RUN} END"
_OP13_SQL = rf"""WITH docs AS (SELECT row_number() OVER () AS uid, doc_id,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
templates(tid, label, phrase, base, length, tpos, t0, t1, t2, t3) AS (VALUES {_values()}),
grams AS (SELECT uid, pos, w[pos + 1] AS w0, w[pos + 2] AS w1, w[pos + 3] AS w2, w[pos + 4] AS w3
  FROM (SELECT uid, w, unnest(range(len(w))) AS pos FROM docs)),
votes AS (SELECT uid, tid, label, phrase, base, length, pos, tpos, pos - tpos AS diagonal FROM grams JOIN templates ON w0 = t0 AND w1 = t1
  AND (t2 IS NULL OR (w2 = t2 AND w3 = t3))),
marked AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= {licenses.DRIFT} THEN 0 ELSE 1 END AS new
  FROM (SELECT DISTINCT uid, tid, diagonal FROM votes) WINDOW w AS (PARTITION BY uid, tid ORDER BY diagonal)),
islands AS (SELECT *, sum(new) OVER (PARTITION BY uid, tid ORDER BY diagonal) AS island FROM marked),
cells AS (SELECT uid, tid, label, phrase, base, length, 'line' AS kind, diagonal AS spot, pos, tpos FROM votes
  UNION ALL SELECT v.uid, v.tid, label, phrase, base, length, 'island', island, pos, tpos FROM votes v JOIN islands USING (uid, tid, diagonal)
  WHERE NOT phrase),
covered AS (SELECT uid, tid, label, phrase, base, length, kind, spot, count(DISTINCT place) AS n, min(pos) AS first, max(pos) + any_value({_RUN}) AS last
  FROM (SELECT *, unnest(range(tpos, tpos + {_RUN})) AS place FROM cells) GROUP BY 1, 2, 3, 4, 5, 6, 7, 8),
spans AS (SELECT *, n / length AS share, CASE WHEN phrase THEN n = length
  ELSE n / length >= {licenses.SHARE} AND last - first <= {licenses.STRETCH} * length END AS good FROM covered),
per AS (SELECT uid, count(*) FILTER (base AND good) AS n_base, min(first) FILTER (base AND good) AS first_word,
    max(first) FILTER (base AND good) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND good) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels, max(share) AS score FROM spans GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score FROM docs LEFT JOIN per USING (uid)"""


@query("op11_merkle_manifest", _OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, d: str) -> DataFrame:
    return manifest.audit(table(spark, d, "documents"))


@query("op12_source_divergence", _OP12_SQL)
def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.divergences(table(spark, d, "documents"))


@query("op13_license_scan", _OP13_SQL)
def op13_license_scan(spark: SparkSession, d: str) -> DataFrame:
    return licenses.scan(table(spark, d, "documents"))
