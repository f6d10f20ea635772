"""Embedding near-dedup by a pivot-permutation index.

Pivots are reference vectors, spread by farthest-first choice over a bounded sample (SAMPLE vectors, the smallest hashes), and
no two of them are nearer than twice the angle of a link: a group of near copies holds one at most, for the order of pivots inside a
group would be noise. Every vector is described by its nearest pivots in order of distance, as seen from the sample's mean: embeddings of one
model often share a direction, and what they share tells no two apart. Vectors at a small angle see the pivots in nearly the same
order, so candidates are pairs that share some of them. How many are nearest and shared is the first of RULES that all but MISSED of
trial pairs meet, made from sampled vectors and copies turned by the angle of a link. Candidates are retrieved through inverted pivot
lists: two sets of `nearest` with `shared` in common share one within their first nearest - shared + 1 pivots by number, so only
those postings are kept, and a pair is looked at in the list of its first common pivot alone. Every candidate is verified by cosine of the vectors themselves in double precision.

Lists are cut into blocks whose pairs are tasks of their own, and a task returns a row per vector that has a link there: a list
of any length, or a group of copies of any size, is spread out, and no row per pair is written.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import block_pairs, components, partitions, scratch, whole_groups
from lexmill.llm.near_text import least_reached

THRESHOLD = 0.98
SAMPLE, MOST_PIVOTS = 4096, 4096
RULES = [(10, 4), (16, 6), (16, 5), (16, 4), (16, 3), (16, 2), (16, 1)]  # (nearest, shared), the fewest postings and candidates first
TRIALS, MISSED = 1024, 0.005
BLOCK = 1024


class Index(NamedTuple):
    """What is fitted on the sample for one dimension: its mean, the pivots seen from there, and one of RULES."""

    mean: np.ndarray
    pivots: np.ndarray
    nearest: int
    shared: int


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def n_pivots(n: int) -> int:
    """Twice the square root of the rows: lists stay short as the corpus grows. At most MOST_PIVOTS."""
    return max(16, min(MOST_PIVOTS, 2 * math.isqrt(n)))


def spread_out(sample: np.ndarray, n: int, apart: float) -> np.ndarray:
    """Up to n rows of `sample`, each the farthest from those before it, as long as that one's cosine with them is `apart` at most."""
    chosen, nearest = [0], sample @ sample[0]
    while len(chosen) < min(n, len(sample)):
        i = int(nearest.argmin())
        if nearest[i] > apart:
            break
        chosen.append(i)
        nearest = np.maximum(nearest, sample @ sample[i])
    return sample[chosen]


def seen_from(mean: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Directions of unit vectors x from `mean`; one that lies there has none, so all pivots are equally far."""
    y = x - mean
    length = np.sqrt((y * y).sum(1, keepdims=True))
    return y / np.where(length > 0, length, 1)


def nearest_pivots(x: np.ndarray, mean: np.ndarray, reference: np.ndarray, n: int) -> np.ndarray:
    """Numbers of the n nearest pivots (or all) of unit vectors x, nearest first, of equally near ones the smaller number."""
    return np.argsort(-(seen_from(mean, x) @ reference.T), axis=1, kind="stable")[:, :n]


def turned(x: np.ndarray, cosine: float) -> np.ndarray:
    """Unit vectors at that cosine with those of x, in seeded directions; in one dimension x itself."""
    z = np.random.default_rng(11).normal(size=x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    length = np.sqrt((z * z).sum(1, keepdims=True))
    side = np.where(length > 1e-9, z / np.where(length > 1e-9, length, 1), 0)
    return unit(cosine * x + math.sqrt(1 - cosine * cosine) * side)


def fit(sample: np.ndarray, n: int, threshold: float) -> Index:
    """Index of up to n pivots over the unit vectors of `sample`."""
    mean = sample.mean(0)
    chosen = seen_from(mean, spread_out(sample, n, 2 * threshold * threshold - 1))
    trial = sample[:TRIALS]
    a, b = (nearest_pivots(x, mean, chosen, RULES[-1][0]) for x in (trial, turned(trial, threshold)))
    for nearest, shared in RULES:
        nearest, shared = min(nearest, len(chosen)), min(shared, len(chosen))
        common = (a[:, :nearest, None] == b[:, None, :nearest]).sum((1, 2))
        if (common < shared).mean() <= MISSED:
            break
    return Index(mean, chosen, nearest, shared)


def indexes(classes: DataFrame, n: int, threshold: float) -> dict[int, Index]:
    """Index by dimension. The sample, SAMPLE vectors at most, is all that reaches the driver."""
    rows = classes.select("embedding").orderBy(F.xxhash64("uid", F.lit(3)), "uid").limit(SAMPLE).collect()
    sized: dict[int, list] = {}
    for r in rows:
        sized.setdefault(len(r.embedding), []).append(r.embedding)
    return {k: fit(unit(np.array(v)), n, threshold) for k, v in sized.items()}


def _postings(classes: DataFrame, fitted: dict[int, Index]) -> DataFrame:
    """(list, pivot, uid, n, nearest, embedding): one row per kept posting. Dimensions that the sample lacks have one list."""
    kind = classes.schema["embedding"].dataType.simpleString()

    def work(batches):
        for batch in batches:
            group, vectors = batch.column(0).to_pylist(), batch.column(3)
            size = vectors.value_lengths().to_numpy(zero_copy_only=False)
            row, pivot, nearest = [], [], []
            for k in np.unique(size):
                at = np.flatnonzero(size == k)
                if k not in fitted:
                    row.extend(at), pivot.extend([-1] * len(at)), nearest.extend([[-1]] * len(at))
                    continue
                x = unit(np.array(vectors.take(pa.array(at)).flatten()).reshape(-1, k))
                order = nearest_pivots(x, fitted[k].mean, fitted[k].pivots, fitted[k].nearest)
                kept = np.sort(order, 1)[:, :order.shape[1] - fitted[k].shared + 1]
                row.extend(np.repeat(at, kept.shape[1])), pivot.extend(kept.ravel())
                nearest.extend(order.repeat(kept.shape[1], 0).tolist())
            row = np.array(row, np.int64)
            names = [f"{group[r]}:{size[r]}:{p}" for r, p in zip(row, pivot, strict=True)]
            taken = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(pivot, pa.int64()), batch.column(1).take(taken), batch.column(2).take(taken),
                 pa.array(nearest, pa.list_(pa.int64())), vectors.take(taken)],
                names=["list", "pivot", "uid", "n", "nearest", "embedding"])

    return classes.select("label", "uid", "n", "embedding").mapInArrow(
        work, f"list string, pivot long, uid long, n long, nearest array<long>, embedding {kind}")


def _links(postings: DataFrame, sizes: DataFrame, threshold: float, shared: dict[int, int]) -> DataFrame:
    """(a, links, b): per class with a link in a pair of blocks, the vectors it is linked with and the least class reached."""
    rows = block_pairs(postings.join(sizes, "list"), "list", "size", "uid", BLOCK)
    rows = rows.repartition(partitions(rows.sparkSession), "list", "b1", "b2").sortWithinPartitions("list", "b1", "b2")

    def work(batches):
        for table, bounds in whole_groups(batches, ["list", "b1", "b2"]):
            uid, n, own, pivot = (table.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "n", "own", "pivot"))
            one = table.column("b1").to_numpy() == table.column("b2").to_numpy()
            vectors, nearest = (table.column(c).combine_chunks() for c in ("embedding", "nearest"))
            out = [], [], []
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                if hi - lo < 2:
                    continue
                x = unit(np.array(vectors.slice(lo, hi - lo).flatten()).reshape(hi - lo, -1))
                seen = np.array(nearest.slice(lo, hi - lo).flatten()).reshape(hi - lo, -1)
                held = np.zeros((hi - lo, seen.max() + 2), np.float32)
                held[np.arange(hi - lo)[:, None], seen + 1] = 1
                a = np.arange(hi - lo) if one[lo] else np.flatnonzero(own[lo:hi])
                b = a if one[lo] else np.flatnonzero(~own[lo:hi])
                before = pivot[lo] + 1
                candidate = held[a] @ held[b].T >= shared.get(x.shape[1], 1)  # shared-pivot counts
                candidate &= held[a][:, :before] @ held[b][:, :before].T == 0  # this list's pivot is the first in common
                linked = candidate & (x[a] @ x[b].T >= threshold)
                i, j = np.nonzero(np.triu(linked, 1) if one[lo] else linked)
                if len(i):
                    i, j = lo + a[i], lo + b[j]
                    nodes, least = least_reached(uid[i], uid[j])
                    links = np.zeros(len(nodes), np.int64)
                    np.add.at(links, np.searchsorted(nodes, uid[i]), n[j])
                    np.add.at(links, np.searchsorted(nodes, uid[j]), n[i])
                    for column, values in zip(out, (nodes, links, least), strict=True):
                        column.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "links", "b"])

    return rows.mapInArrow(work, "a long, links long, b long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, n_links, component_id, kept) per row of `vectors` (key, embedding, label).

    Vectors are compared only with those of the same label and dimension. A null label, and a vector that is null, empty, zero or holds
    a null or a non-finite component, links with nothing: n_links 0, its own component, kept. Rows with equal vectors and labels are one class
    through the search and link with each other; `n_links` counts rows. `component_id` is the smallest key reachable; null keys
    are larger than others. An empty table gives no rows; other columns are not read.
    """
    fine = F.col("label").isNotNull() & F.coalesce(F.forall("embedding", lambda v: F.coalesce(
        ~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))) & F.exists("embedding", lambda v: v != 0), F.lit(False))
    rows = vectors.select(key, "embedding", "label").withColumns({"uid": F.monotonically_increasing_id(), "fine": fine})
    rows = scratch(rows.withColumn("digest", F.when(F.col("fine"), F.sha2(F.concat_ws(
        ":", F.col("label").cast("string"), F.concat_ws(",", F.transform("embedding", lambda v: v.cast("double").cast("string")))), 256))), "rows")
    classes = rows.where("fine").groupBy("digest").agg(F.min("uid").alias("uid"), F.count("*").alias("n"), F.min(key).alias("first"))
    classes = scratch(classes, "classes")
    whole = scratch(classes.select("uid", "n").join(rows.select("uid", "label", "embedding"), "uid"), "vectors")
    total = whole.count()
    fitted = indexes(whole, n_pivots(total), threshold)
    postings = scratch(_postings(whole, fitted), "postings")
    sizes = scratch(postings.groupBy("list").agg(F.count("*").alias("size")).where("size > 1"), "lists")
    found = scratch(_links(postings, sizes, threshold, {k: f.shared for k, f in fitted.items()}), "found")
    links = found.groupBy(F.col("a").alias("uid")).agg(F.sum("links").alias("links"))
    joined = components(found.select("a", "b")).withColumnRenamed("id", "uid")
    each = classes.join(links, "uid", "left").join(joined, "uid", "left").withColumn("component", F.coalesce("component", "uid"))
    first = scratch(each.groupBy("component").agg(F.min("first").alias("component_id")), "first")
    each = each.join(first, "component").select(
        "digest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    out = rows.select(key, "digest").join(scratch(each, "each"), "digest", "left")
    component = F.when(F.col("n_links").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(key, F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      component.eqNullSafe(F.col(key)).alias("kept"))
