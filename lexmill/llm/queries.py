"""The training-data operators on the given tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm import audit_queries  # noqa: F401 - registers its queries
from lexmill.llm import chat, fingerprint, mixing, near_text, near_vectors, packing, pii, suffix_dedup, toxicity, url_filter
from lexmill.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401 - read by the entry

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


_REACHED = """reach(id, least) AS (SELECT id, id FROM rows UNION SELECT e.b, r.least FROM reach r JOIN links e ON e.a = r.id),
  least AS (SELECT id, min(least) AS least FROM reach GROUP BY 1), n AS (SELECT a AS id, count(*) AS n FROM links GROUP BY 1)"""
_OP1_SQL = f"""WITH RECURSIVE rows AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings),
  fine AS (SELECT * FROM rows WHERE label IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
  links AS (SELECT x.id AS a, y.id AS b FROM fine x JOIN fine y ON x.label = y.label AND len(x.v) = len(y.v) AND x.id <> y.id
    WHERE list_cosine_similarity(x.v, y.v) >= 0.98), {_REACHED}
SELECT rows.id AS vec_id, coalesce(n.n, 0) AS n_links, least.least AS component_id, least.least = rows.id AS kept
FROM rows JOIN least USING (id) LEFT JOIN n USING (id)"""
_OP5_SQL = rf"""WITH RECURSIVE rows AS (SELECT doc_id AS id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'),
    lambda x: x <> '') AS w FROM documents),
  shingles AS (SELECT DISTINCT id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i
    FROM rows WHERE len(w) > 0)),
  sizes AS (SELECT id, count(*) AS n FROM shingles GROUP BY 1),
  common AS (SELECT x.id AS a, y.id AS b, count(*) AS shared FROM shingles x JOIN shingles y USING (s) WHERE x.id <> y.id GROUP BY 1, 2),
  links AS (SELECT a, b FROM common JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b WHERE shared / (x.n + y.n - shared) >= 0.8), {_REACHED}
SELECT rows.id AS doc_id, coalesce(n.n, 0) AS n_links, least.least AS component_id, least.least = rows.id AS kept
FROM rows JOIN least USING (id) LEFT JOIN n USING (id)"""


@query("op1_embedding_near_dedup", _OP1_SQL)
def op1_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, d, "embeddings"))


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(table(spark, d, "documents"), tokenizer_path())


@query("op3_source_mixing")
def op3_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix(table(spark, d, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


_OP4_SQL = """
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunk_numbers AS (SELECT k, doc_id, h, unnest(range(0, (length(h) // 2 + 950) // 1000)) AS c FROM docs),
chunks AS (SELECT k, doc_id, c, substr(h, 2000 * c + 1, 2098) AS h FROM chunk_numbers),
starts AS (SELECT k, doc_id, c, h, unnest(range(0, length(h) // 2 - 49)) AS p FROM chunks),
strings AS (SELECT k, doc_id, 1000 * c + p AS p, substr(h, 2 * p + 1, 100) AS w FROM starts),
least_ids AS (SELECT w, min(doc_id) AS least_id FROM strings GROUP BY w),
later AS (
  SELECT k, p, p - lag(p) OVER (PARTITION BY k ORDER BY p) AS step FROM strings JOIN least_ids USING (w) WHERE least_id < doc_id),
runs AS (SELECT k, p, count(*) FILTER (step IS NULL OR step > 50) OVER (PARTITION BY k ORDER BY p) AS run FROM later),
spans AS (SELECT k, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY k, run),
edges AS (
  SELECT k, 0 AS pos, -1 AS a, 0 AS b FROM docs UNION ALL SELECT k, a + 1, a, b FROM spans
  UNION ALL SELECT k, length(h) // 2 + 1, length(h) // 2, length(h) // 2 FROM docs),
kept AS (SELECT k, b AS a, lead(a) OVER (PARTITION BY k ORDER BY pos) AS b FROM edges),
rest AS (SELECT k, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS h FROM kept JOIN docs USING (k) WHERE b IS NOT NULL GROUP BY k)
SELECT d.doc_id, length(d.h) // 2 AS n_bytes, (length(d.h) - length(r.h)) // 2 AS n_removed, coalesce(s.n, 0) AS n_spans,
  sha256(unhex(r.h)) AS kept_sha256
FROM docs d JOIN rest r ON r.k = d.k LEFT JOIN (SELECT k, count(*) AS n FROM spans GROUP BY k) s ON s.k = d.k"""


@query("op4_suffix_array_dedup", _OP4_SQL)
def op4_suffix_array_dedup(spark: SparkSession, d: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, d, "documents"))


@query("op5_ngram_jaccard", _OP5_SQL)
def op5_ngram_jaccard(spark: SparkSession, d: str) -> DataFrame:
    return near_text.near_duplicates(table(spark, d, "documents"))


@query("op6_contextual_pii")
def op6_contextual_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.personal_data(table(spark, d, "documents"))


_OP7_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, coalesce(text, '')) AS k FROM documents),
pairs AS (
  SELECT a.doc_id, a.k, a.t, b.k AS after, left(a.t, length(a.t) - length(a.t) // 2) || left(b.t, length(a.t) // 2) AS edited
  FROM docs a JOIN docs b ON b.k = a.k % (SELECT count(*) FROM docs) + 1),
texts AS (SELECT k, 0 AS e, encode(t) AS d FROM pairs UNION ALL SELECT k, 1, encode(edited) FROM pairs),
bytes AS (
  SELECT k, e, list_transform(regexp_extract_all(hex(d), '..'), lambda h: CAST('0x' || h AS UBIGINT)) AS b FROM texts),
triplets AS (
  SELECT k, e, unnest(list_transform(range(1, len(b) - 1), lambda i:
    (b[i] * {fingerprint.PRIMES[0]} + b[i + 1] * {fingerprint.PRIMES[1]} + b[i + 2] * {fingerprint.PRIMES[2]}) % 4294967296)) AS x
  FROM bytes),
counted AS (
  SELECT k, e, (CAST(xor(x, x >> 15) AS HUGEINT) * {fingerprint.PRIMES[0]}) % 4294967296 // 16777216 AS bucket, count(*) AS n
  FROM triplets GROUP BY ALL),
filled AS (
  SELECT t.k, t.e, list(coalesce(n, 0) ORDER BY r.range) AS n FROM texts t JOIN range({fingerprint.BUCKETS}) r ON true
  LEFT JOIN counted c ON c.k = t.k AND c.e = t.e AND c.bucket = r.range GROUP BY t.k, t.e),
quartiles AS (
  SELECT k, e, n, list_sort(n)[{fingerprint.BUCKETS // 4}] AS q1, list_sort(n)[{fingerprint.BUCKETS // 2}] AS q2,
    list_sort(n)[{3 * fingerprint.BUCKETS // 4}] AS q3 FROM filled),
coded AS (
  SELECT q.k, q.e, list_transform(n, lambda v: CAST(v > q1 AS INT) + CAST(v > q2 AS INT) + CAST(v > q3 AS INT)) AS codes,
    least(15, 16 * q1 // greatest(1, q3)) AS h1, least(15, 16 * q2 // greatest(1, q3)) AS h2,
    least(255, CAST(round(ln(1 + len(b)) * 10) AS INT)) AS size FROM quartiles q JOIN bytes b ON b.k = q.k AND b.e = q.e),
marks AS (
  SELECT *, format('{{:02x}}{{:x}}{{:x}}', size, h1, h2) || list_aggregate(list_transform(range(1, {fingerprint.BUCKETS}, 2),
    lambda i: format('{{:x}}', codes[i] * 4 + codes[i + 1])), 'string_agg', '') AS mark FROM coded),
compared AS (
  SELECT p.doc_id, p.k, length(p.t) AS n_chars, sha256(p.edited) AS edited_sha256, a.mark AS fingerprint, b.mark AS edited_fingerprint,
    unnest(['near_edited', 'near_next']) AS part, a AS own, unnest([b, c]) AS other
  FROM pairs p JOIN marks a ON a.k = p.k AND a.e = 0 JOIN marks b ON b.k = p.k AND b.e = 1 JOIN marks c ON c.k = p.after AND c.e = 0),
likened AS (
  SELECT *, greatest(0, 1 - (
    list_sum(list_transform(range(1, {fingerprint.BUCKETS + 1}), lambda i: [0, 1, 2, 6][abs(own.codes[i] - other.codes[i]) + 1]))
    + least({fingerprint.LENGTH_MOST}, {fingerprint.LENGTH_COST} * greatest(0, abs(own.size - other.size) - 1))
    + {fingerprint.QUARTILE_COST} * (least(abs(own.h1 - other.h1), 16 - abs(own.h1 - other.h1)) + least(abs(own.h2 - other.h2), 16 - abs(own.h2 - other.h2)))
    ) / CAST({fingerprint.CEILING} AS DOUBLE)) AS likeness FROM compared)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, CAST(max(likeness) FILTER (part = 'near_edited') AS DOUBLE) AS near_edited,
  CAST(max(likeness) FILTER (part = 'near_next') AS DOUBLE) AS near_next
FROM likened GROUP BY k, doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint"""


@query("op7_document_fingerprints", _OP7_SQL)
def op7_document_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return fingerprint.against_next(table(spark, d, "documents"))


_ESCAPED = "coalesce(text, '')"
for _plain, _code in chat.CODES:
    _ESCAPED = f"replace({_ESCAPED}, '{_plain}', '{_code}')"
_ROLE = "role"
for _plain, _code in [*chat.CODES, ("\n", chat.LINE)]:
    _ROLE = f"replace({_ROLE}, '{_plain}', '{_code}')"


@query("op8_chat_formatting", f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, 'user') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(8 + length({_ROLE}) + length({_ESCAPED}) + CASE WHEN role = 'assistant' THEN 0 ELSE 13 END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id""")
def op8_chat_formatting(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.sql("SELECT -7L AS conv_id, t AS turn, element_at(array('user', 'assistant'), cast(t + 1 as int)) AS role, "
                    "'</s>[INST] ok [/INST]' AS text FROM range(2) AS r(t)")
    formatted = chat.format_turns(chat.table_turns(rows.unionByName(own))).drop("turns")
    back = formatted.withColumns({"turns": chat.read_back(F.col("formatted")),
                                  "learned": chat.under_mask(F.col("formatted"), F.col("loss_mask"))})
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


@query("op9_toxicity_chain")
def op9_toxicity_chain(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op10_url_filter")
def op10_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, d, "pages"), RULES)
