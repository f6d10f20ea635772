"""Exact substring dedup by a logarithmic family of suffix arrays.

A byte goes if a string of SPAN bytes that covers it also starts in a document with a smaller key. Suffixes are sampled by minimizers: of
each SPAN bytes' strings of MARK bytes, those with the least hash; so two equal spans have the same sampled suffixes, and about
one byte in 14 has one. (Whole suffix arrays would take eight bytes and more for each byte of text.) A suffix goes by the hash
of its first MARK bytes, its mark; arrays are sorted by it.

1. Texts go into a table bucketed by chunk (CHUNK rows as they come), so later passes find a chunk's texts and notes without a shuffle.
2. Batches, in order of the key, get their suffix array: sorted marks with chunks, cut by ranges of the mark's hash into slots that
   are files of a bucketed table. A batch is merge-scanned against itself and each existing level, slot by slot; marks found
   on both sides are noted for their chunks. Then levels of equal size merge, so there are at most log2(batches) + 1.
3. Chunks send the surroundings of their noted suffixes to the mark's slot: all spans that contain the mark are compared there, and
   the smallest document of each is known. Chunks send each distinct surrounding once, with its smallest document; the others in
   the chunk need no answer. So a passage that any number of documents share costs a row per chunk.
4. The answers return to the chunks, which cut the texts.

Spans are told apart by 128 bits of hash, marks by 56 (an accident there costs work, not results).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.common import bucketed, chunk_of, drop_scratch, partitions, scratch

SPAN, MARK = 50, 24
SIDE = SPAN - MARK  # bytes around a mark that spans with it can reach
AROUND = SPAN + SIDE
CHUNK, BATCHES = 1000, 4
BLOCK = 1024  # surroundings hashed at a time
FIRST, SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
NO_KEY = (1 << 63) - 1
MARK_BITS = np.uint64(8)  # dropped of 64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolled(b: np.ndarray, n: int, base: np.uint64) -> np.ndarray:
    """Polynomial hash of every n neighbours along the last axis, doubling the width."""
    width, power = b.shape[-1] - n + 1, pow(int(base), 1, 1 << 64)
    out, done, x, size = None, 0, b.astype(np.uint64) + np.uint64(1), 1
    while True:
        if n & size:
            part = x[..., n - done - size:n - done - size + width]
            out = part if out is None else out + part * np.uint64(pow(power, done, 1 << 64))
            done += size
        if done == n:
            return out
        x = x[..., :-size] * np.uint64(pow(power, size, 1 << 64)) + x[..., size:]
        size *= 2


def _slid(x: np.ndarray, n: int, best) -> np.ndarray:
    """`best` (minimum or maximum) of every n neighbours."""
    width, size = len(x) - n + 1, 1
    while size * 2 <= n:
        x = best(x[:-size], x[size:])
        size *= 2
    return best(x[:width], x[n - size:n - size + width])


def suffixes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(positions, marks) of the sampled suffixes."""
    if len(data) < SPAN:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    x = _mix(_rolled(np.frombuffer(data, np.uint8), MARK, FIRST))
    least = _slid(x, SIDE + 1, np.minimum)  # of each span
    edge = np.zeros(SIDE, np.uint64)
    best = _slid(np.concatenate([edge, least, edge]), SIDE + 1, np.maximum)  # of the spans that hold a mark
    at = np.flatnonzero(best == x)
    return at, x[at] >> MARK_BITS


def _surroundings(data: bytes, at: np.ndarray) -> np.ndarray:
    """Rows of AROUND bytes about each position, then the number of bytes there are to the left and to the right of its mark."""
    b = np.frombuffer(bytes(SIDE) + data + bytes(SIDE), np.uint8)
    left, right = np.minimum(at, SIDE), np.minimum(len(data) - at - MARK, SIDE)
    rows = b[at[:, None] + np.arange(AROUND)]
    return np.concatenate([rows, left[:, None].astype(np.uint8), right[:, None].astype(np.uint8)], 1)


def _texts(docs: DataFrame, key: str) -> DataFrame:
    """(chunk, id, batch, text) bucketed by chunk; `id` is the key, the largest number for null."""
    # Batches are even shares of the keys by quantiles; where they are cut does not change results.
    cuts = docs.select(F.col(key).cast("long").alias("k")).stat.approxQuantile("k", [i / BATCHES for i in range(1, BATCHES)], 0.01)
    batch = sum((F.coalesce(F.col("id") > int(c), F.lit(True)).cast("int") for c in cuts), F.lit(0))
    row = F.monotonically_increasing_id()
    rows = docs.select(F.col(key).alias("key"), F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("id"), row.alias("_row"))
    rows = rows.select(chunk_of("_row", CHUNK).alias("chunk"), "key", "id", batch.alias("batch"), "text")
    return bucketed(rows, "chunk", "texts")


def _slots(marks: np.ndarray, n: int) -> np.ndarray:
    return (_mix(marks) % np.uint64(n)).astype(np.int64)


def _by_slot(marks: np.ndarray, n: int):
    """(slot, indexes) of each slot that has marks; indexes are in the order of the marks."""
    slot = _slots(marks, n)
    order = np.lexsort((marks, slot))
    edges = np.flatnonzero(np.diff(slot[order], prepend=-1))
    for lo, hi in zip(edges, [*edges[1:], len(order)], strict=False):  # no edges: nothing
        yield int(slot[order[lo]]), order[lo:hi]


def _array(texts: DataFrame, n: int) -> DataFrame:
    """The batch's suffix array: a row per slot with sorted marks and the chunk of each, bucketed by slot."""
    def marks(batches):
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            slots, chunks, blobs = [], [], []
            for c in np.unique(chunk):
                found, many = [], []
                for i in np.flatnonzero(chunk == c):
                    m = np.unique(suffixes(batch.column(1)[int(i)].as_py().encode("utf-8", "surrogatepass"))[1])
                    found.append(m)
                if not found:
                    continue
                m, count = np.unique(np.concatenate(found), return_counts=True)
                many = (count > 1).astype(np.uint64)  # in two of the chunk's documents or more
                for slot, at in _by_slot(m, n):
                    slots.append(slot), chunks.append(int(c)), blobs.append((m[at] << np.uint64(1) | many[at]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(slots, pa.int64()), pa.array(chunks, pa.int64()), pa.array(blobs, pa.binary())],
                                             names=["slot", "chunk", "marks"])

    def gather(table):
        blobs = [np.frombuffer(b, np.uint64) for b in table.column("marks").to_pylist()]
        m = np.concatenate(blobs)
        chunk = np.repeat(table.column("chunk").to_numpy(), [len(b) for b in blobs])
        return _level_row(table.column("slot")[0].as_py(), m, chunk)

    rows = texts.select("chunk", "text").mapInArrow(marks, "slot long, chunk long, marks binary")
    return bucketed(rows.groupBy("slot").applyInArrow(gather, LEVEL), "slot", "level")


LEVEL = "slot long, marks binary, chunks binary"
NOTE = "chunk long, marks binary"


def _level_row(slot: int, m: np.ndarray, chunk: np.ndarray) -> pa.Table:
    order = np.argsort(m, kind="stable")
    return pa.table({"slot": pa.array([slot], pa.int64()), "marks": pa.array([m[order].tobytes()], pa.binary()),
                     "chunks": pa.array([chunk[order].astype(np.int64).tobytes()], pa.binary())})


def _level(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Marks (with their flag in the last bit) and chunks of a slot's rows."""
    if not table.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return (np.concatenate([np.frombuffer(b, np.uint64) for b in table.column("marks").to_pylist()]),
            np.concatenate([np.frombuffer(b, np.int64) for b in table.column("chunks").to_pylist()]))


def _notes(marks: np.ndarray, chunk: np.ndarray) -> pa.Table:
    order = np.argsort(chunk, kind="stable")
    marks, chunk = marks[order], chunk[order]
    edges = np.flatnonzero(np.diff(chunk, prepend=-1 if len(chunk) and chunk[0] != -1 else -2))
    blobs = [marks[lo:hi].tobytes() for lo, hi in zip(edges, [*edges[1:], len(chunk)], strict=False)]
    return pa.table({"chunk": pa.array(chunk[edges], pa.int64()), "marks": pa.array(blobs, pa.binary())})


def _within(level: DataFrame) -> DataFrame:
    """Notes of the marks that a batch has more than once."""
    def scan(table):
        m, chunk = _level(table)
        mark, flag = m >> np.uint64(1), (m & np.uint64(1)) > 0
        _, start, which, count = np.unique(mark, return_index=True, return_inverse=True, return_counts=True)
        keep = (count[which] > 1) | (np.bincount(which, flag, len(count))[which] > 0) if len(mark) else flag
        return _notes(mark[keep], chunk[keep])

    return level.groupBy("slot").applyInArrow(scan, NOTE)


def _between(new: DataFrame, old: DataFrame) -> DataFrame:
    """Merge-scan of two levels: notes of the marks that both have, for both sides' chunks."""
    def scan(a, b):
        (m, x), (k, y) = _level(a), _level(b)
        m, k = m >> np.uint64(1), k >> np.uint64(1)
        both = np.intersect1d(m, k)
        here, there = np.isin(m, both), np.isin(k, both)
        return _notes(np.concatenate([m[here], k[there]]), np.concatenate([x[here], y[there]]))

    return new.groupBy("slot").cogroup(old.groupBy("slot")).applyInArrow(scan, NOTE)


def _merged(a: DataFrame, b: DataFrame) -> DataFrame:
    def merge(x, y):
        (m, c), (k, d) = _level(x), _level(y)
        slot = (x if x.num_rows else y).column("slot")[0].as_py()
        return _level_row(slot, np.concatenate([m, k]), np.concatenate([c, d]))

    rows = a.groupBy("slot").cogroup(b.groupBy("slot")).applyInArrow(merge, LEVEL)
    return bucketed(rows, "slot", "level")


class SuffixIndex:
    """Levels of suffix arrays, the largest first: (batches, table). `add` returns the notes of a batch: which marks of which chunks, its
    own and those of earlier batches, now occur twice."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels = spark, []
        self.slots = 4 * partitions(spark)

    def add(self, texts: DataFrame, last: bool = False) -> list[DataFrame]:
        new = _array(texts, self.slots)
        notes = [scratch(_within(new), "notes")] + [scratch(_between(new, old), "notes") for _, old in self.levels]
        self.levels.append((1, new))
        while not last and len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, b), (_, a) = self.levels.pop(), self.levels.pop()
            self.levels.append((2 * n, _merged(a, b)))
            drop_scratch(self.spark, a), drop_scratch(self.spark, b)
        return notes

    def drop(self) -> None:
        """Deletes the levels, where no later batch will come."""
        for _, level in self.levels:
            drop_scratch(self.spark, level)
        self.levels = []


def _order(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, new): an order in which equal pairs lie together, and where a pair begins. One sort does unless two pairs share just x."""
    order = np.argsort(x)
    apart, other = x[order][1:] != x[order][:-1], y[order][1:] != y[order][:-1]
    if (other & ~apart).any():
        order = np.lexsort((y, x))
        apart, other = x[order][1:] != x[order][:-1], y[order][1:] != y[order][:-1]
    new = np.ones(len(x), bool)
    new[1:] = apart | other
    return order, new


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index of each distinct row, and each row's number among them, by 128 bits of hash over words of eight bytes."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    words = padded.view(np.uint64)
    x, y = np.zeros(n, np.uint64), np.full(n, SECOND, np.uint64)
    for k in range(words.shape[1]):
        word = words[:, k]
        x, y = _mix((x ^ word) * FIRST + SECOND), _mix((y + word) * SECOND ^ (y >> np.uint64(32)))
    order, new = _order(x, y)
    number = np.empty(n, np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _noted(texts: pa.Table, notes: pa.Table):
    """The chunk's noted suffixes: per document (data, id, positions, surrounding numbers), the distinct surroundings with their
    marks, and the smallest id of each. The same in every pass."""
    blobs = [b for b in notes.column("marks").to_pylist() if b]
    wanted = np.unique(np.concatenate([np.frombuffer(b, np.uint64) for b in blobs])) if blobs else np.zeros(0, np.uint64)
    ids = texts.column("id").to_numpy()
    docs, around, marks = [], [], []
    for i in range(texts.num_rows):
        data = texts.column("text")[i].as_py().encode("utf-8", "surrogatepass")
        at, m = suffixes(data) if len(wanted) else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
        if len(at):
            keep = wanted[np.minimum(np.searchsorted(wanted, m), len(wanted) - 1)] == m
            at, m = at[keep], m[keep]
        docs.append((data, at))
        if len(at):
            around.append(_surroundings(data, at)), marks.append(m)
    if not around:
        return [(d, a, np.zeros(0, np.int64)) for d, a in docs], ids, np.zeros((0, AROUND + 2), np.uint8), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows, marks = np.ascontiguousarray(np.concatenate(around)), np.concatenate(marks)
    owner = np.repeat(np.arange(len(docs)), [len(a) for _, a in docs])
    first, number = _distinct(rows)
    least = np.full(len(first), NO_KEY, np.int64)
    np.minimum.at(least, number, ids[owner])
    ends = np.cumsum([0, *[len(a) for _, a in docs]])
    return [(d, a, number[ends[i]:ends[i + 1]]) for i, (d, a) in enumerate(docs)], ids, rows[first], marks[first], least


def _ask(texts: DataFrame, notes: DataFrame, n: int) -> DataFrame:
    """(slot, chunk, marks, numbers, ids, around): the distinct surroundings of each chunk, by the slot of their mark."""
    def ask(a, b):
        _, _, around, marks, least = _noted(a, b)
        out = [], [], [], [], []
        chunk = (a if a.num_rows else b).column("chunk")[0].as_py()
        for slot, at in _by_slot(marks, n) if len(marks) else []:
            for column, value in zip(out, (slot, chunk, at.astype(np.uint32).tobytes(), least[at].tobytes(), around[at].tobytes()), strict=True):
                column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()), strict=True)],
                        names=["slot", "chunk", "numbers", "ids", "around"])

    return texts.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(
        ask, "slot long, chunk long, numbers binary, ids binary, around binary")


def _masks(rows: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each surrounding and its document's id, which of its spans start in a document with a smaller id, as bits.

    Equal surroundings, which chunks send each for itself, are taken once, with their smallest id: whoever has a larger one finds all the
    spans in that document. So spans are told apart for distinct surroundings only."""
    first, number = _distinct(rows)  # one row per distinct surrounding; any of them will do
    least_id = np.full(len(first), NO_KEY, np.int64)
    np.minimum.at(least_id, number, ids)
    own = rows[first]
    left, right = own[:, -2].astype(int)[:, None], own[:, -1].astype(int)[:, None]
    offset = np.arange(SIDE + 1)
    there = (offset >= SIDE - left) & (offset <= right)  # spans inside the document
    row, at = np.nonzero(there)
    x, y = (np.concatenate([_rolled(own[b:b + BLOCK, :AROUND], SPAN, base)[there[b:b + BLOCK]] for b in range(0, len(own), BLOCK)] or [
        np.zeros(0, np.uint64)]) for base in (FIRST, SECOND))  # in blocks that stay in a core's cache
    order, new = _order(x, y)
    row, at = row[order], at[order]
    starts = np.flatnonzero(new)
    least = np.minimum.reduceat(least_id[row], starts)[np.cumsum(new) - 1] if len(starts) else least_id[row]
    hit = least < least_id[row]
    some = np.zeros(len(own), np.uint32)
    np.bitwise_or.at(some, row[hit], np.uint32(1) << at[hit].astype(np.uint32))
    every = there.astype(np.uint32) @ (np.uint32(1) << offset.astype(np.uint32))
    return np.where(ids > least_id[number], every[number], some[number]).astype(np.uint32)


def _answer(asked: DataFrame) -> DataFrame:
    """(chunk, numbers, masks): which of the spans about each surrounding start in a document with a smaller id."""
    def answer(table):
        numbers = [np.frombuffer(b, np.uint32) for b in table.column("numbers").to_pylist()]
        ids = np.concatenate([np.frombuffer(b, np.int64) for b in table.column("ids").to_pylist()])
        rows = np.frombuffer(b"".join(table.column("around").to_pylist()), np.uint8).reshape(-1, AROUND + 2)
        masks = _masks(rows, ids)
        ends = np.cumsum([0, *map(len, numbers)])
        some = [masks[ends[i]:ends[i + 1]] for i in range(len(numbers))]
        return pa.table({"chunk": table.column("chunk"), "numbers": pa.array([k[s > 0].tobytes() for k, s in zip(numbers, some, strict=True)], pa.binary()),
                         "masks": pa.array([s[s > 0].tobytes() for s in some], pa.binary())})

    return asked.groupBy("slot").applyInArrow(answer, "chunk long, numbers binary, masks binary")


def _cut(texts: DataFrame, notes: DataFrame, key_type: str, with_text: bool) -> DataFrame:
    """The digest columns, or the texts that are left, from texts and notes (marks, or answers by number and mask)."""
    bits = np.arange(SIDE + 1)

    def cut(a, b):
        own = [i for i, m in enumerate(b.column("masks").to_pylist()) if m is None] if b.num_rows else []
        docs, ids, around, _, least = _noted(a, b.take(pa.array(own, pa.int64())))
        mask = np.zeros(len(around), np.uint32)
        for numbers, masks in zip(b.column("numbers").to_pylist(), b.column("masks").to_pylist(), strict=True):
            if masks:
                mask[np.frombuffer(numbers, np.uint32)] |= np.frombuffer(masks, np.uint32)
        left, right = (around[:, -2].astype(int), around[:, -1].astype(int)) if len(around) else (np.zeros(0, int),) * 2
        every = ((bits >= SIDE - left[:, None]) & (bits <= right[:, None])).astype(np.uint32) @ (np.uint32(1) << bits.astype(np.uint32)).astype(np.uint32)
        out = [], [], [], [], []
        for (data, at, number), doc in zip(docs, ids, strict=True):
            own_mask = np.where(least[number] < doc, every[number], mask[number]) if len(number) else np.zeros(0, np.uint32)
            row, bit = np.nonzero(own_mask[:, None] >> bits.astype(np.uint32) & np.uint32(1)) if len(number) else (np.zeros(0, int),) * 2
            gone = np.zeros(len(data) + 1, np.int64)
            start = at[row] - SIDE + bit
            np.add.at(gone, start, 1), np.add.at(gone, start + SPAN, -1)
            gone = np.cumsum(gone)[:-1] > 0
            kept = data if not gone.any() else np.frombuffer(data, np.uint8)[~gone].tobytes()
            runs = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
            last = kept if with_text else hashlib.sha256(kept).hexdigest()
            for column, value in zip(out, (len(data), int(gone.sum()), runs, last), strict=False):
                column.append(value)
        return pa.table([a.column("key"), *[pa.array(c, pa.int64()) for c in out[:3]], pa.array(out[3], pa.binary() if with_text else pa.string())],
                        names=["key", "n_bytes", "n_removed", "n_spans", "kept" if with_text else "kept_sha256"])

    return texts.groupBy("chunk").cogroup(notes.groupBy("chunk")).applyInArrow(
        cut, f"key {key_type}, n_bytes long, n_removed long, n_spans long, " + ("kept binary" if with_text else "kept_sha256 string"))


def without_repeats(docs: DataFrame, key: str = "doc_id", with_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256, or the bytes `kept` with `with_text`) per row of `docs` (key, text).

    Texts are taken as UTF-8 bytes, null as empty; matches never cross documents, and all are judged on the input. Rows with one key
    are no smaller than each other, so they remove nothing from each other; null keys are larger than all others. Texts below SPAN bytes
    lose nothing. An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    key_type = docs.schema[key].dataType.simpleString()
    texts = _texts(docs, key)
    index, notes = SuffixIndex(spark), []
    for i in range(BATCHES):
        notes += index.add(texts.where(F.col("batch") == i), last=i == BATCHES - 1)
    index.drop()
    marks = notes[0]
    for more in notes[1:]:
        marks = marks.unionByName(more)
    asked = _ask(texts.select("chunk", "id", "text"), marks, index.slots)
    answers = scratch(_answer(asked), "answers")
    none = F.lit(None).cast("binary")
    both = marks.select("chunk", "marks", none.alias("numbers"), none.alias("masks")).unionByName(
        answers.select("chunk", none.alias("marks"), "numbers", "masks"))
    return _cut(texts, both, key_type, with_text).withColumnRenamed("key", key)
