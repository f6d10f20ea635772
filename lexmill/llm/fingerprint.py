"""Document fingerprints: quartile bucket digests.

Each triplet of neighbouring UTF-8 bytes is hashed to one of BUCKETS counters. The digest writes, in hexadecimal, the length on
a logarithmic scale (two digits), the first and second quartile against the third in sixteenths (one digit each), and for
each bucket the quartile its count falls in (two bits). Two digests differ by the steps between bucket quartiles, counted 1,
2 and 6, plus bounded terms for length and quartiles; likeness is 1 at no difference and 0 from CEILING on, which
unrelated texts pass.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import partitions, scratch

BUCKETS = 256
STEP_COST = np.array([0, 1, 2, 6])  # of 0 to 3 quartiles apart
LENGTH_COST, LENGTH_MOST, QUARTILE_COST = 2, 24, 2
CEILING = 1.35 * BUCKETS
PRIMES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)  # odd multipliers of the triplet hash
AT_ONCE = 1 << 20


def counts(data: bytes) -> np.ndarray:
    """Hashed triplets per bucket, in slices of AT_ONCE bytes."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(data) - 2), AT_ONCE):
        b = np.frombuffer(data, np.uint8, min(AT_ONCE + 2, len(data) - at), at).astype(np.uint32)
        x = b[:-2] * PRIMES[0] + b[1:-1] * PRIMES[1] + b[2:] * PRIMES[2]
        x ^= x >> np.uint32(15)
        x *= PRIMES[0]
        total += np.bincount(x >> np.uint32(24), minlength=BUCKETS)
    return total


def digest(data: bytes) -> str:
    """Fingerprint of one text. Texts below three bytes have no triplets: all buckets are in the lowest quartile."""
    n = counts(data)
    q1, q2, q3 = np.sort(n)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    codes = ((n > q1).astype(np.uint8) + (n > q2) + (n > q3)).reshape(-1, 4)
    body = (codes[:, 0] << 6 | codes[:, 1] << 4 | codes[:, 2] << 2 | codes[:, 3]).astype(np.uint8)
    length = min(255, round(np.log1p(len(data)) * 10))
    head = [min(15, int(16 * q / max(1, q3))) for q in (q1, q2)]
    return f"{length:02x}{head[0]:x}{head[1]:x}{body.tobytes().hex()}"


def _codes(mark: str) -> np.ndarray:
    body = np.frombuffer(bytes.fromhex(mark[4:]), np.uint8)
    return np.stack([body >> 6, body >> 4 & 3, body >> 2 & 3, body & 3], 1).ravel().astype(np.int8)


def likeness(a: str, b: str) -> float:
    """1 for equal fingerprints, down to 0."""
    if a == b:
        return 1.0
    steps = STEP_COST[np.abs(_codes(a) - _codes(b))].sum()
    length = min(LENGTH_MOST, LENGTH_COST * max(0, abs(int(a[:2], 16) - int(b[:2], 16)) - 1))
    quartiles = QUARTILE_COST * sum(min(abs(int(a[i], 16) - int(b[i], 16)), 16 - abs(int(a[i], 16) - int(b[i], 16))) for i in (2, 3))
    return float(max(0.0, 1 - (steps + length + quartiles) / CEILING))


def fingerprints(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_chars, fingerprint) per row; null text is the empty text. No shuffle."""
    kind = {k.name: k.dataType.simpleString() for k in docs.schema}[key]

    def work(batches):
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                                              pa.array([digest(t.encode("utf-8", "surrogatepass")) for t in texts], pa.string())],
                                             names=[key, "n_chars", "fingerprint"])

    return docs.select(key, "text").mapInArrow(work, f"{key} {kind}, n_chars long, fingerprint string")


def edited(text: str, following: str) -> str:
    """`text` with its last floor(n / 2) code points replaced by the first as many (or all) of `following`."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _row(key, text: str, mark: str, following: str, next_mark: str) -> tuple:
    data = edited(text, following).encode("utf-8", "surrogatepass")
    own = digest(data)
    return key, len(text), hashlib.sha256(data).hexdigest(), mark, own, likeness(mark, own), likeness(mark, next_mark)


_SCHEMA = [("n_chars", "long"), ("edited_sha256", "string"), ("fingerprint", "string"), ("edited_fingerprint", "string"),
           ("near_edited", "double"), ("near_next", "double")]
_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}


def against_next(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of `docs` (key, text).

    The next document is that of the next smaller key; the last one's is the first (a sole document's is itself). Null text is
    empty; rows of one key go by text; a null key comes last; an empty table gives no rows. Other columns are not read.

    One range shuffle carries the texts; a task walks its sorted rows and knows each row's next, but for its last row. For
    that it hands out its first and last text, a few rows per task, which meet by the task's number in a join.
    """
    spark = docs.sparkSession
    kind = {k.name: k.dataType.simpleString() for k in docs.schema}[key]
    order = [F.col(key).desc_nulls_last(), F.coalesce("text", F.lit(""))]
    rows = docs.select(key, F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange(partitions(spark), F.col(key).desc_nulls_last()).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id())
    names = ["part", "edge", key, *[n for n, _ in _SCHEMA], "text"]

    def work(batches):
        before, at, key_type = None, -1, None

        def table(out: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.string(), key_type, *[_TYPES[t] for _, t in _SCHEMA], pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        def edge(side, doc) -> tuple:
            return at, side, doc[0], len(doc[1]), None, doc[2], None, None, None, doc[1]

        for batch in batches:
            out, key_type = [], batch.schema.field(0).type
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                doc = batch.column(0)[i].as_py(), text, digest(text.encode("utf-8", "surrogatepass"))
                if before is None:
                    at = batch.column(2)[i].as_py()
                    out.append(edge("first", doc))
                else:
                    out.append((at, "inner", *_row(*before, doc[1], doc[2]), None))
                before = doc
            if out:
                yield table(out)
        if before is not None:
            yield table([edge("last", before)])

    schema = f"part int, edge string, {key} {kind}, " + ", ".join(f"{n} {t}" for n, t in _SCHEMA) + ", text string"
    done = scratch(rows.mapInArrow(work, schema), "digests")
    edges = done.where("edge <> 'inner'")
    following = edges.where("edge = 'first'").select("part").withColumn("one", F.lit(0))  # a row per task
    w = Window.partitionBy("one").orderBy("part")
    following = following.select(F.lead("part").over(w).alias("after"), "part", F.first("part").over(w).alias("wrap"))
    following = following.select("part", F.coalesce("after", "wrap").alias("after"))
    heads = edges.where("edge = 'first'").select(F.col("part").alias("after"), F.col("text").alias("_text"), F.col("fingerprint").alias("_mark"))
    tails = edges.where("edge = 'last'").select("part", key, "text", "fingerprint").join(following, "part").join(heads, "after")

    def close(batches):
        for batch in batches:
            out = [_row(*r) for r in zip(*[c.to_pylist() for c in batch.columns], strict=True)]
            if out:
                types = [batch.schema.field(0).type, *[_TYPES[t] for _, t in _SCHEMA]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                                                 names=[key, *[n for n, _ in _SCHEMA]])

    ends = tails.select(key, "text", "fingerprint", "_text", "_mark").mapInArrow(
        close, f"{key} {kind}, " + ", ".join(f"{n} {t}" for n, t in _SCHEMA))
    return done.where("edge = 'inner'").select(ends.columns).unionByName(ends)

