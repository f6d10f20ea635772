"""N-gram Jaccard join: documents whose sets of SHINGLE words agree by THRESHOLD or more, with Bayesian candidate pruning.

Words are runs between the white space of code points 9 to 13 and 32, as they stand. A document's shingles are hashed to 64
bits; texts below SHINGLE words have one shingle of all their words, texts without words none, and those link with nothing.
1. Equal sets become one class; from here on a class is one row, with its number of documents.
2. MinHash bands give buckets; buckets of the same classes count once.
3. In each bucket the pairs' MinHash values are compared STEP at a time, and a pair is dropped as soon as the posterior
   probability that its similarity reaches THRESHOLD (uniform prior) falls below TOLERANCE. Survivors join into clusters.
4. Within a cluster the pairs that pass the same pruning are verified by their whole sets; links are counted and joined.
Texts and signatures are written bucketed by chunks of rows as they lie, so that later steps read those they need where they are:
neither is shuffled as a whole. Pairs stay inside tasks: large buckets and clusters are cut into blocks whose pairs are tasks of their own, and a task returns
a row per class that has a link, never a row per pair.
"""

from __future__ import annotations

import functools
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import block_pairs, bucketed, chunk_of, components, partitions, scratch, stars, whole_groups

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 25, 5  # a pair at THRESHOLD misses all bands with probability (1 - 0.8 ** 5) ** 25 = 5e-5
HASHES = BANDS * ROWS
STEP, TOLERANCE = 25, 1e-5
BLOCK, VERIFY_BLOCK, COLUMNS = 512, 128, 8192
CACHED_WORDS = 500_000
CHUNK = 1000
_seeds = np.random.default_rng(20)
A, B = (_seeds.integers(0, 1 << 32, HASHES, dtype=np.uint32) for _ in range(2))
A |= np.uint32(1)
POWERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(SHINGLE)], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: str, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    parts = text.encode("utf-8", "surrogatepass").split()
    h = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    if not len(h):
        return h
    if len(h) < SHINGLE:
        h = np.r_[h, np.zeros(SHINGLE - len(h), np.uint64)]
    n = len(h) - SHINGLE + 1
    x = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        x += h[i:i + n] * POWERS[i]
    return np.unique(_mix(x))


def min_hashes(values: np.ndarray) -> np.ndarray:
    x = (values >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 4096):
        np.minimum(out, (A[:, None] * x[None, at:at + 4096] + B[:, None]).min(1), out=out)
    return out


@functools.cache
def least_matches(n: int) -> int:
    """Fewest matches in n MinHash values with which P(similarity >= THRESHOLD) is TOLERANCE at least."""
    below = 0.0
    for m in range(n + 1):  # the posterior is Beta(m + 1, n - m + 1); its tail is a binomial sum
        below += comb(n + 1, m) * THRESHOLD ** m * (1 - THRESHOLD) ** (n + 1 - m)
        if below >= TOLERANCE:
            return m
    return n


def likely(a: np.ndarray, b: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Indexes (i, j) of the pairs of two blocks of signatures that survive the pruning; `within`: a is b, and i < j."""
    first = np.zeros((len(a), len(b)), np.int32)
    for k in range(STEP):
        first += a[:, k, None] == b[None, :, k]
    keep = first >= least_matches(STEP)
    i, j = np.nonzero(np.triu(keep, 1) if within else keep)
    matches = first[i, j]
    for at in range(STEP, HASHES, STEP):
        for part in range(0, len(i), 200_000):
            s = slice(part, part + 200_000)
            matches[s] += (a[i[s], at:at + STEP] == b[j[s], at:at + STEP]).sum(1, dtype=np.int32)
        keep = matches >= least_matches(at + STEP)
        i, j, matches = i[keep], j[keep], matches[keep]
    return i, j


def _overlaps(a: list[np.ndarray], b: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of a[i] and b[j]."""
    if len(i) <= 16:
        return np.array([len(np.intersect1d(a[x], b[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.int64)
    use_a, use_b = np.unique(i), np.unique(j)
    sets = [a[x] for x in use_a] + [b[y] for y in use_b]
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, which = column[order], which[order]
    total = np.zeros((len(use_a), len(use_b)), np.float32)
    for at in range(0, int(column[-1]) + 1, COLUMNS):
        lo, hi = np.searchsorted(column, [at, at + COLUMNS])
        held = np.zeros((len(sets), COLUMNS), np.float32)
        held[which[lo:hi], column[lo:hi] - at] = 1
        total += held[:len(use_a)] @ held[len(use_a):].T
    return total[np.searchsorted(use_a, i), np.searchsorted(use_b, j)].astype(np.int64)


def _sign(texts: pa.Array, words: dict) -> tuple[list[np.ndarray], list]:
    sets = [shingles(t.as_py() or "", words) for t in texts]
    return sets, [min_hashes(s).tobytes() if len(s) else None for s in sets]


def _signed(docs: DataFrame, kept: list[str]) -> DataFrame:
    """`kept` columns with the signature and the digest of the shingle set, null for texts without words."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(kept).schema)

    def work(batches):
        words = _Hashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                sets, sign = _sign(part.column(0), words)
                digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(sign, pa.binary()), pa.array(digest, pa.binary())],
                                                 names=[*kept, "signature", "digest"])

    return docs.select("text", *kept).mapInArrow(work, f"{fields}, signature binary, digest binary")


def _members(texts: DataFrame, members: DataFrame) -> DataFrame:
    """(cluster, size, uid, n, signature, shingles) of the members (chunk, uid, cluster, size, n): each chunk reads its own texts again."""
    def work(a, b):
        at = pc.index_in(b.column("uid"), a.column("uid").combine_chunks())
        sets, sign = _sign(a.column("text").take(at), _Hashes())
        return pa.table([*[b.column(c) for c in ("cluster", "size", "uid", "n")], pa.array(sign, pa.binary()),
                         pa.array([s.tobytes() for s in sets], pa.binary())], names=["cluster", "size", "uid", "n", "signature", "shingles"])

    return texts.select("chunk", "uid", "text").groupBy("chunk").cogroup(members.groupBy("chunk")).applyInArrow(
        work, "cluster long, size long, uid long, n long, signature binary, shingles binary")


def _chunk() -> Column:
    return chunk_of("uid", CHUNK).alias("chunk")


def _bands(signed: DataFrame, heads: DataFrame) -> DataFrame:
    """(bucket, uid): the band buckets of each class, from the signature of its head."""
    mixed = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) for i in range(ROWS)], np.uint64)

    def work(a, b):
        mine = a.filter(pc.is_in(a.column("uid"), b.column("uid").combine_chunks()))
        sign = np.frombuffer(b"".join(mine.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        keys = _mix((sign.astype(np.uint64) * mixed).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * POWERS[0])
        return pa.table({"bucket": pa.array(keys.ravel().view(np.int64)), "uid": pa.array(np.repeat(mine.column("uid").to_numpy(), BANDS))})

    return signed.select("chunk", "uid", "signature").groupBy("chunk").cogroup(heads.select(_chunk(), "uid").groupBy("chunk")).applyInArrow(
        work, "bucket long, uid long")


def _buckets(signed: DataFrame, heads: DataFrame) -> DataFrame:
    """(bucket, size, uid, signature) of the buckets that two classes or more share, one bucket per set of classes."""
    rows = scratch(_bands(signed, heads), "bands")
    buckets = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("uid")).alias("x"),
                                         F.bit_xor(F.xxhash64("uid", F.lit(1))).alias("y")).where("size > 1")
    chosen = scratch(buckets.groupBy("size", "x", "y").agg(F.min("bucket").alias("bucket")).select("bucket", "size"), "buckets")
    asked = rows.join(chosen, "bucket").withColumn("chunk", _chunk())

    def work(a, b):
        at = pc.index_in(b.column("uid"), a.column("uid").combine_chunks())
        return pa.table([b.column("bucket"), b.column("size"), b.column("uid"), a.column("signature").take(at)],
                        names=["bucket", "size", "uid", "signature"])

    return signed.select("chunk", "uid", "signature").groupBy("chunk").cogroup(asked.groupBy("chunk")).applyInArrow(
        work, "bucket long, size long, uid long, signature binary")


def _spread(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), group, "b1", "b2").sortWithinPartitions(group, "b1", "b2")


def _candidate_links(signed: DataFrame, heads: DataFrame) -> DataFrame:
    """(a, b): each class that survives the pruning with another in some bucket, and the least class it is connected with there."""
    rows = _spread(block_pairs(_buckets(signed, heads), "bucket", "size", "uid", BLOCK), "bucket")

    def work(batches):
        for table, bounds in whole_groups(batches, ["bucket", "b1", "b2"]):
            sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            uid, own = (table.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "own"))
            one = table.column("b1").to_numpy() == table.column("b2").to_numpy()
            left, right = [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                a = np.arange(lo, hi) if one[lo] else lo + np.flatnonzero(own[lo:hi])
                b = a if one[lo] else lo + np.flatnonzero(~own[lo:hi])
                i, j = likely(sign[a], sign[b], bool(one[lo]))
                if len(i):
                    x, y = least_reached(uid[a[i]], uid[b[j]])
                    left.append(x), right.append(y)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])

    return rows.mapInArrow(work, "a long, b long")


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the links a - b and the least node each is connected with."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    linked = np.zeros((len(nodes), len(nodes)), bool)
    i, j = at[:len(a)], at[len(a):]
    linked[i, j] = linked[j, i] = True
    return nodes, nodes[stars(linked)]


def _verified(members: DataFrame) -> DataFrame:
    """(a, links, b) per class with a link: documents linked with, within one pair of blocks, and the least class reached there."""
    rows = _spread(block_pairs(members, "cluster", "size", "uid", VERIFY_BLOCK), "cluster")

    def work(batches):
        for table, bounds in whole_groups(batches, ["cluster", "b1", "b2"]):
            uid, own, n = (table.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "own", "n"))
            one = table.column("b1").to_numpy() == table.column("b2").to_numpy()
            sign = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
            out = [], [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                sets = [np.frombuffer(s.as_buffer(), np.uint64) for s in table.column("shingles").slice(lo, hi - lo)]
                a = np.arange(hi - lo) if one[lo] else np.flatnonzero(own[lo:hi])
                b = a if one[lo] else np.flatnonzero(~own[lo:hi])
                i, j = likely(sign[lo + a], sign[lo + b], bool(one[lo]))
                if not len(i):
                    continue
                i, j = a[i], b[j]
                size = np.array([len(s) for s in sets])
                same = _overlaps(sets, sets, i, j)
                fit = same / (size[i] + size[j] - same) >= THRESHOLD
                i, j = lo + i[fit], lo + j[fit]
                if len(i):
                    nodes, least = least_reached(uid[i], uid[j])
                    links = np.zeros(len(nodes), np.int64)
                    np.add.at(links, np.searchsorted(nodes, uid[i]), n[j])
                    np.add.at(links, np.searchsorted(nodes, uid[j]), n[i])
                    for column, values in zip(out, (nodes, links, least), strict=True):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "links", "b"])

    return rows.mapInArrow(work, "a long, links long, b long")


def _labelled(docs: DataFrame, key: str) -> DataFrame:
    """`docs` (text, key, uid, chunk), bucketed, to (uid, key, n_links, kept, component_id)."""
    signed = bucketed(_signed(docs, ["chunk", "uid", key]), "chunk", "signed")
    classes = signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("uid").alias("uid"), F.count("*").alias("n"), F.min_by("uid", F.struct(F.col(key).isNull(), key, "uid")).alias("head"))
    classes = scratch(classes, "classes")
    heads = classes.select("uid", "n")
    clusters = scratch(components(_candidate_links(signed, heads)).withColumnsRenamed({"id": "uid", "component": "cluster"}), "clusters")
    sizes = scratch(clusters.groupBy("cluster").agg(F.count("*").alias("size")), "sizes")
    members = clusters.join(sizes, "cluster").join(heads, "uid").select(_chunk(), "uid", "cluster", "size", "n")
    found = scratch(_verified(_members(docs, members)), "found")
    links = found.groupBy("a").agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b")).withColumnRenamed("id", "a")
    each = classes.join(links.withColumnRenamed("a", "uid"), "uid", "left").join(joined.withColumnRenamed("a", "uid"), "uid", "left")
    each = each.select("digest", "head", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                       F.coalesce("component", "uid").alias("component"))
    keys = each.join(signed.select(F.col("uid").alias("head"), F.col(key).alias("_key")), "head")
    first = scratch(keys.groupBy("component").agg(F.min_by(F.struct("head", "_key"), F.struct(
        F.col("_key").isNull(), "_key", "head")).alias("first")), "first")
    each = scratch(keys.join(first, "component").select("digest", "n_links", "first"), "each")
    out = signed.select("uid", key, "digest").join(each, "digest", "left")
    head = F.when(F.col("first").isNull(), F.col("uid")).otherwise(F.col("first.head"))
    return out.select("uid", key, F.coalesce("n_links", F.lit(0)).alias("n_links"), (F.col("uid") == head).alias("kept"),
                      F.when(F.col("first").isNull(), F.col(key)).otherwise(F.col("first._key")).alias("component_id"))


def near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_links, component_id, kept) per row of `docs` (key, text).

    `n_links` counts the other documents linked directly; `component_id` is the smallest key reachable over links, the own one
    included; `kept` marks one row per component, that of this key. Null and empty texts and texts of white space alone have no
    shingles: they link with nothing and stay. Repeated rows link with each other like any copies; null keys are larger than others. An
    empty table gives no rows; other columns are not read.
    """
    return _labelled(_chunked(docs.select("text", key)), key).select(key, "n_links", "component_id", "kept")


def _chunked(docs: DataFrame) -> DataFrame:
    rows = docs.withColumn("uid", F.monotonically_increasing_id())
    return bucketed(rows.withColumn("chunk", chunk_of("uid", CHUNK)), "chunk", "texts")


def without_near_duplicates(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of `docs` without all but one of each component, with all their columns, whatever these are called. Null and empty texts stay; of
    ties the smallest key stays, of rows with one key any single one; an empty table gives no rows."""
    plain = [f"_c{i}" for i in range(len(docs.columns))]
    own = dict(zip(docs.columns, plain, strict=True))
    rows = _chunked(docs.select(*[F.col(c).alias(p) for c, p in own.items()]))
    marks = _labelled(rows.withColumnsRenamed({own["text"]: "text", own[key]: "key"}).select("chunk", "uid", "text", "key"), "key")
    gone = marks.where("NOT kept").select(chunk_of("uid", CHUNK).alias("chunk"), "uid")

    def keep(a, b):
        return a.filter(pc.invert(pc.is_in(a.column("uid"), b.column("uid").combine_chunks()))).select(plain)

    fields = ", ".join(f"{own[f.name]} {f.dataType.simpleString()}" for f in docs.schema)
    out = rows.groupBy("chunk").cogroup(gone.groupBy("chunk")).applyInArrow(keep, fields)
    return out.withColumnsRenamed({p: c for c, p in own.items()})
