"""Best-fit packing of token sequences in bulk-synchronous steps.

Documents become token ids in Arrow batches; those longer than a sequence are cut, the rest of the division first. Pieces
of one length are interchangeable, so documents and gaps are sorted as runs: a run is a length (or a gap) and how many
have it, at most `size` runs of documents whatever the corpus. Each step takes the longest documents left, sweeps the
gaps upward from their successor (the smallest gap that holds them), gives each gap one document in rank order until
one side is used up, updates the gaps and repeats; what finds no gap opens sequences. The sweeps work on the runs alone;
the pieces, ranked within their length by bucket counts and offsets, look up their run by (length, rank) where they lie.
"""

from __future__ import annotations

import bisect
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import partitions, scratch
from lexmill.llm.tokens import Ids

SIZE, END = 1024, 2
CHARS_AT_ONCE = 2_000_000


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: `size` each, but the first may be shorter."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of each row of `docs` (key, text); null text is empty: one end token."""
    kind = {k.name: k.dataType.simpleString() for k in docs.schema}[key]

    def work(batches):
        ids = Ids(tokenizer)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at = 0
            while at < batch.num_rows:
                upto, chars, part = at, 0, []
                while upto < batch.num_rows and chars < CHARS_AT_ONCE:
                    part.append(texts[upto].as_py() or "")
                    chars += len(part[-1]) + 1
                    upto += 1
                which, n, start, length, crc, own = [], [], [], [], [], []
                for i, doc in enumerate(ids.batch(part)):
                    doc = np.append(doc, np.uint32(end)).astype("<u4")
                    for k, (s, m) in enumerate(cut(len(doc), size)):
                        which.append(at + i), n.append(k), start.append(s), length.append(m)
                        crc.append(zlib.crc32(doc[s:s + m].tobytes()))
                        if with_ids:
                            own.append(doc[s:s + m])
                columns = [keys.take(pa.array(which, pa.int64())), pa.array(n, pa.int32()), pa.array(start, pa.int64()),
                           pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                names = [key, "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(own, pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
                at = upto

    schema = f"{key} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids
    return docs.select(key, "text").mapInArrow(work, schema)


def best_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, how many, first sequence, offset) that place `counts` (length -> pieces)."""
    plan, gaps, sequences = [], {}, 0  # gap -> runs (first sequence, how many)
    order: list[int] = []  # gaps that have runs, sorted

    def leave(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                bisect.insort(order, gap)
            gaps.setdefault(gap, []).append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left and order and order[-1] >= length:
            matched = []
            while left and (i := bisect.bisect_left(order, length)) < len(order):  # the successor of the length
                gap = order[i]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[i]
                use = min(n, left)
                plan.append((length, rank, use, first, size - gap))
                rank, left = rank + use, left - use
                matched.append((gap - length, first, use))
                if n > use:
                    leave(gap, first + use, n - use)
            for run in matched:  # each gap took one document; what is left of it takes part in the next sweep
                leave(*run)
        fit = size // length
        for n, each in ((left // fit, fit), (1, left % fit)):
            if n and each:
                for k in range(each):
                    plan.append((length, rank, n, sequences, k * length))
                    rank += n
                leave(size - each * length, sequences, n)
                sequences += n
    return plan


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds `rank` from 0 within `group`, in buckets: a group of any size is ranked by many tasks."""
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(partitions(rows.sparkSession))).cast("int"))
    counts = rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    return rows.withColumn("rank", own - 1).join(offsets, [group, "_bucket"]).withColumn(
        "rank", F.col("rank") + F.col("_before")).drop("_bucket", "_before")


def place(rows: DataFrame, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """Adds sequence_id and offset to `rows` (length, rank, ...) by the runs of `plan`."""
    runs = np.array(sorted(plan), np.int64).reshape(-1, 5)
    span = 1 << 44
    starts = runs[:, 0] * span + runs[:, 1]
    names = rows.columns

    def work(batches):
        for batch in batches:
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            i = np.searchsorted(starts, length * span + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(runs[i, 3] + rank - runs[i, 1]), pa.array(runs[i, 4])],
                                             names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(work, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, tokenizer: str, key: str = "doc_id", size: int = SIZE, end: int = END, with_ids: bool = False) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset[, ids]): every token of every document is in one place.

    Null and empty texts are one end token. Repeated rows, and rows that share a key, are packed each for itself. An empty
    table gives no rows. Only `key` and `text` are read, so other columns cannot clash.
    """
    rows = scratch(pieces(docs, tokenizer, key, size, end, with_ids), "pieces")
    counts = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `size` rows
    placed = place(ranked(rows, "length", [key, "piece", "start", "ids_crc32"]), best_fit(counts, size))
    return placed.drop("rank")
