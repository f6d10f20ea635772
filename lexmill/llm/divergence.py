"""How far the sources of a language differ in their words, exactly.

1. In each task Arrow kernels lower-case texts, split them, number the words and count them per document, then per (language, source, term).
   Tasks give partial counts, and hold no more than HELD of them.
2. Spark merges these. A language keeps the terms in at least LEAST of its documents. Each group gives each kept term the probability
   p = 1 + floor(SCALE * (count + 5) / (N + 5 * V)).
3. Terms: p above the language's, the largest differences of each group. Pairs of sources: the sum of differences over all kept terms.
   Kept terms are dealt into shards by hash, sources of a language into blocks of SOURCES; a cell is one shard of two blocks, a columnar matrix
   of terms by sources. Terms that neither block has in the cell all differ alike, so they are counted, not listed.

Arithmetic is on integers: decimals of 38 digits for p, longs for sums of differences (below 2 * SCALE plus twice the terms).

Rules: NULL text, language or source count as ''. Empty texts and texts without terms leave their group in place. Texts of any length are split whole.
Rows count as often as they come. Ties of value go by the item's UTF-8 bytes. An empty table gives no rows. Other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import few, partitions, scratch

LEAST, TOP, SCALE, ADDED = 30, 50, 1_000_000_000, 5
BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"  # ASCII but for letters
HELD = 400_000  # partial counts a task holds before it gives them on
PIECE = 4 << 20  # bytes of text that the kernels take at once; a longer text is taken alone
SOURCES, TERMS = 64, 4096  # sources of a block; terms of a matrix at a time
COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.Table]:
    """`batch` in runs of rows of about PIECE bytes."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + PIECE, side="right")))
        yield pa.Table.from_batches([batch.slice(start, end - start)])
        start = end


def _partial(rows: pa.Table) -> pa.Table:
    """Counts of one piece: a row per (lang, source, term), and one per (lang, source) with a NULL term."""
    words = pc.split_pattern_regex(pc.ascii_lower(rows.column("text").combine_chunks()), pattern=BETWEEN)
    flat = pc.list_flatten(words)
    real = pc.not_equal(flat, "")
    coded = pc.dictionary_encode(pc.filter(flat, real))
    per_doc = pa.table({"doc": pc.filter(pc.list_parent_indices(words), real), "code": coded.indices})
    per_doc = per_doc.group_by(["doc", "code"]).aggregate([([], "count_all")])
    docs = per_doc.column("doc")
    counted = pa.table({"lang": rows.column("lang").take(docs), "source": rows.column("source").take(docs), "code": per_doc.column("code"),
                        "n": per_doc.column("count_all")})
    counted = counted.group_by(["lang", "source", "code"]).aggregate([("n", "sum"), ("n", "count")])
    groups = rows.group_by(["lang", "source"]).aggregate([])
    none = pa.table({"lang": groups["lang"], "source": groups["source"], "term": pa.nulls(groups.num_rows, pa.string()),
                     "n": np.zeros(groups.num_rows, np.int64), "docs": np.zeros(groups.num_rows, np.int64)}).cast(COUNTS)
    found = pa.table({"lang": counted["lang"], "source": counted["source"], "term": coded.dictionary.take(counted["code"].combine_chunks()),
                      "n": counted["n_sum"], "docs": counted["n_count"]}).cast(COUNTS)
    return pa.concat_tables([found, none])


def _merged(parts: list[pa.Table]) -> pa.Table:
    merged = pa.concat_tables(parts).group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return merged.rename_columns(COUNTS.names).cast(COUNTS)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        for piece in _pieces(batch):
            held.append(_partial(piece))
            n += held[-1].num_rows
            if n > HELD:
                held = [_merged(held)]
                n = held[0].num_rows
                if n > HELD // 2:
                    yield from held[0].to_batches(max_chunksize=10_000)
                    held, n = [], 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=10_000)


def term_counts(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs), and a row with a NULL term for each (lang, source)."""
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                         for c, name in ((lang, "lang"), (source, "source"), (text, "text"))])
    partial = rows.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    return scratch(partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")


def probability(count: str, total: str, terms: str) -> Column:
    """p in units of 1 / SCALE; NULL where nothing is kept."""
    dec = "decimal(38,0)"
    return F.when(F.col(terms) > 0, F.expr(
        f"1 + (cast(cast({SCALE} as decimal(10,0)) * cast({count} + {ADDED} as decimal(20,0)) as {dec}) div "
        f"cast({total} + {ADDED} * {terms} as {dec}))"))


def weighed(counts: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(entries, groups). entries: (lang, source, term, p, q), a row per kept term that a group has; q is the language's. groups:
    (lang, source, v, zero): the number of kept terms and the p of those that the group has not."""
    kept = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = scratch(kept.where(F.col("docs") >= least).drop("docs"), "kept")
    found = scratch(counts.where("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "total"), "found")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    sizes = found.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    groups = counts.where("term is null").select("lang", "source").join(sizes, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("group_n", "v", "lang_n")], F.lit(0).alias("none"))
    groups = scratch(groups.withColumn("zero", F.coalesce(probability("none", "group_n", "v"), F.lit(0))), "groups")
    entries = found.join(few(groups), ["lang", "source"]).select(
        "lang", "source", "term", probability("n", "group_n", "v").alias("p"), probability("total", "lang_n", "v").alias("q"))
    return scratch(entries, "entries"), groups.select("lang", "source", "v", "zero")


def top_terms(entries: DataFrame, top: int = TOP) -> DataFrame:
    """The terms that a group has most above its language."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = entries.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    return more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _cell(key: tuple, entries: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of differences of the sources of two blocks, over one shard's terms."""
    salt, b1, b2 = (k.as_py() for k in key[1:])
    names = groups.column("source").to_pylist()
    zero, v = groups.column("zero").to_numpy(), groups.column("v").to_numpy()
    number = {s: i for i, s in enumerate(names)}
    block = groups.column("block").to_numpy()
    rows, others = np.flatnonzero(block == b1), np.flatnonzero(block == b2)
    sums = np.zeros((len(names), len(names)), np.int64)
    coded = pc.dictionary_encode(entries.column("term").combine_chunks())
    n_terms = len(coded.dictionary)
    code, p = coded.indices.to_numpy(), entries.column("p").to_numpy()
    sources = pc.dictionary_encode(entries.column("source").combine_chunks())
    at = np.array([number[s] for s in sources.dictionary.to_pylist()], np.int64)[sources.indices.to_numpy()]
    order = np.argsort(code, kind="stable")
    code, p, at = code[order], p[order], at[order]
    for start in range(0, n_terms, TERMS):
        first, end = np.searchsorted(code, [start, start + TERMS])
        matrix = np.repeat(zero[:, None], min(TERMS, n_terms - start), axis=1)
        matrix[at[first:end], code[first:end] - start] = p[first:end]
        for i in rows:
            sums[i, others] += np.abs(matrix[others] - matrix[i]).sum(axis=1)
    i, j = np.repeat(rows, len(others)), np.tile(others, len(rows))
    if b1 == b2:
        i, j = i[i < j], j[i < j]
    apart = np.abs(zero[i] - zero[j])
    # Of all kept terms, those that are not in this cell; each cell but the first takes its own ones off.
    value = sums[i, j] + apart * ((v[i] if salt == 0 else 0) - n_terms)
    take = np.array(names, object)
    return pa.table({"lang": pa.array([key[0].as_py()] * len(i), pa.string()), "a": pa.array(take[i], pa.string()),
                     "b": pa.array(take[j], pa.string()), "value": pa.array(value, pa.int64())})


def pair_differences(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank) for each ordered pair of a language's sources."""
    shards = partitions(entries.sparkSession)
    blocks = groups.groupBy("lang").agg(F.ceil(F.count("*") / SOURCES).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("source"), "blocks").cast("int")
    sized = few(scratch(groups.join(blocks, "lang").withColumn("block", block), "groups"))
    salts = F.ceil(F.lit(shards) / F.col("blocks")).cast("int")
    each = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.struct(
        F.least("block", y).alias("b1"), F.greatest("block", y).alias("b2"))))
    left = entries.join(sized, ["lang", "source"]).withColumns({"_pair": each, "salt": F.pmod(F.xxhash64("term", F.lit(3)), salts).cast("int")})
    left = left.select("lang", "salt", F.col("_pair.b1").alias("b1"), F.col("_pair.b2").alias("b2"), "source", "term", "p")
    right = sized.withColumn("_pair", each).withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    right = right.select("lang", "salt", F.col("_pair.b1").alias("b1"), F.col("_pair.b2").alias("b2"), "source", "zero", "v", "block")
    keys = ["lang", "salt", "b1", "b2"]
    sums = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_cell, "lang string, a string, b string, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.withColumn("_x", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                   F.struct(F.col("b").alias("source"), F.col("a").alias("item")))))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return (both.select("lang", "_x.source", F.lit("pair").alias("part"), "_x.item", "value")
            .withColumn("rank", F.row_number().over(order)))


def divergences(docs: DataFrame, **columns) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources and the terms that mark a source."""
    entries, groups = weighed(term_counts(docs, **columns))
    return pair_differences(entries, groups).unionByName(top_terms(entries))
