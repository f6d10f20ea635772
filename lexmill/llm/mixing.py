"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks of words.

Sources get targets by weight, none above `most` times its size (the excess goes to the others by weight). Documents of a
source are dealt to shards of about SHARD words by a seeded hash, a source filling as few shards as its size needs. In each
shard the seats, BLOCK words each, go to the sources by their highest quotients target / (2 k + 1). A source's documents
are laid end to end in seeded order and cut into equal blocks; its quota is that many blocks in a row from a seeded start, going
round as often as needed. So a source misses its target by rounding alone, about a block per shard, and no document is taken more than `most` times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.llm.common import aside, numbered, scratch

BLOCK = 32
SHARD = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: list[int], share: float, most: int) -> DataFrame:
    """(source, source_size, weight, target) of `sizes` (source, size); sources in code point order, null last, weigh
    `weights` in turn. Targets are the water level: level * weight, at most `most` times the size. The level is found by sharing out
    what the full sources leave until no source is above; only sums reach the driver."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(per_source, [F.col("source").asc_nulls_last()], "_rank")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = scratch(ranked.select("source", "source_size", weight.cast("double").alias("weight")), "sources")
    total = share * (ranked.agg(F.sum("source_size")).head()[0] or 0)
    level, cap = 0.0, F.col("source_size") * float(most)
    while True:
        full = cap <= F.col("weight") * level
        taken, left = ranked.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).head()
        new = (total - taken) / left if left else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    return ranked.withColumn("target", F.least(cap, F.col("weight") * level))


def apportion(votes: DataFrame, block: int) -> DataFrame:
    """Adds `seats` to `votes` (shard, votes in words, most: seats at most): round(sum of votes / block) seats per shard go to
    the highest quotients votes / (2 k + 1). A source gets at least what it would with the largest divisor the shard can have and
    at most that with the smallest, so only the seats between are drawn up and ranked: about two per source."""
    shard = Window.partitionBy("shard")
    house = F.round(F.col("_all") / block)
    v = votes.withColumns({"_all": F.sum("votes").over(shard), "_n": F.count("*").over(shard)})
    v = v.withColumn("_house", house)
    low = F.floor(F.col("votes") * F.greatest(F.lit(0.0), F.col("_house") - F.col("_n") / 2) / F.col("_all") - 0.5)
    high = F.ceil(F.col("votes") * (F.col("_house") + F.col("_n") / 2) / F.col("_all") + 0.5)
    v = v.withColumn("_low", F.coalesce(F.least(F.greatest(low, F.lit(0)), "most"), F.lit(0)).cast("long"))
    v = v.withColumn("_high", F.coalesce(F.least(F.greatest(high, "_low"), "most"), F.lit(0)).cast("long"))
    open_seats = F.col("_house") - F.sum("_low").over(shard)
    seat = v.withColumn("_open", open_seats).withColumn(
        "_k", F.explode_outer(F.when(F.col("_high") > F.col("_low"), F.sequence("_low", F.col("_high") - 1))))
    quotient = F.col("votes") / (2 * F.col("_k") + 1)
    order = Window.partitionBy("shard").orderBy(quotient.desc_nulls_last(), F.col("source").asc_nulls_last(), "_k")
    won = (F.row_number().over(order) <= F.col("_open")) & F.col("_k").isNotNull()
    return seat.withColumn("_won", won.cast("long")).groupBy("shard", "source").agg(
        (F.first("_low") + F.sum("_won")).alias("seats"))


def mix(docs: DataFrame, key: str = "doc_id", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
        seed: int = 17, block: int = BLOCK, shard_words: int = SHARD, also: tuple[str, ...] = ()) -> DataFrame:
    """(key, source, size, source_size, target, taken, epochs, first, length, second) per row of `docs` (key, text, source).

    `taken` words are `epochs` whole rounds of the document, `length` words from word `first` on (0-based) and, where the range of
    blocks goes round to the document's start, `second` words from word 0. Null text has size 0 and takes nothing; null
    is a source of its own, last in order; equal rows are taken each for itself; an empty table gives no rows. Equal inputs and
    seeds give equal results, as nothing depends on where rows lie. Columns named in `also` go along; others are not read.
    """
    sizes = scratch(docs.select(key, "source", n_words(F.col("text")).alias("size"), *also), "sizes")
    goal = scratch(targets(sizes, list(weights), share, most), "targets")
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("int")
    own = F.pmod(F.xxhash64(key, F.lit(seed)), F.col("shards"))
    place = sizes.join(goal.withColumn("shards", shards), sizes["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    total = goal.agg(F.sum("source_size")).head()[0] or 0
    n = max(1, -(-total // shard_words))
    place = place.withColumn("shard", F.pmod(F.xxhash64("source", F.lit(seed)) + own, F.lit(n)))
    stream = Window.partitionBy("shard", "source")
    order = stream.orderBy(F.xxhash64(key, F.lit(seed + 1)), key, "size").rowsBetween(Window.unboundedPreceding, 0)
    place = place.withColumns({"_end": F.sum("size").over(order), "_words": F.sum("size").over(stream)})
    place = scratch(place.drop("shards"), "placed")
    blocks = F.ceil(F.col("_words") / block)  # of _words / blocks words each, so none is shorter
    votes = place.groupBy("shard", "source").agg(F.first("_words").alias("_words"), F.first("target").alias("target"),
                                                 F.first("source_size").alias("source_size"))
    votes = votes.select("shard", "source", (blocks * most).cast("long").alias("most"), F.coalesce(
        F.col("target") / F.nullif("source_size", F.lit(0)) * blocks * block, F.lit(0.0)).alias("votes"))
    seats = scratch(apportion(votes, block), "quotas").withColumnsRenamed({"shard": "_shard", "source": "_source"})
    taken = place.join(seats, (F.col("shard") == F.col("_shard")) & F.col("source").eqNullSafe(F.col("_source")))
    taken = taken.withColumns({"_blocks": blocks.cast("long"), "_start": F.col("_end") - F.col("size")})
    rounds = F.when(F.col("_blocks") > 0, F.floor(F.col("seats") / F.col("_blocks"))).otherwise(0).cast("long")
    taken = taken.withColumn("epochs", rounds)
    from_block = F.coalesce(F.pmod(F.xxhash64("shard", "source", F.lit(seed + 2)), F.nullif("_blocks", F.lit(0).cast("long"))), F.lit(0))
    part = F.col("seats") - F.col("epochs") * F.col("_blocks")
    edge = lambda b: F.coalesce(F.floor(b * F.col("_words") / F.nullif("_blocks", F.lit(0).cast("long"))), F.lit(0))
    taken = taken.withColumns({"_from": edge(from_block), "_to": edge(from_block + part)})
    none = F.lit(0).cast("long")
    first = F.least("size", F.greatest(none, F.col("_from") - F.col("_start")))
    length = F.greatest(none, F.least(F.col("_end"), "_to") - F.greatest("_start", "_from"))
    wrapped = F.col("_to") - F.col("_words")
    second = F.greatest(none, F.least(F.col("_end"), wrapped) - F.col("_start"))
    taken = taken.withColumns({"first": first, "length": length, "second": second})
    whole = F.col("epochs") * F.col("size")
    return taken.select(*also, key, "source", "size", "source_size", "target",
                        (whole + F.col("length") + F.col("second")).alias("taken"), "epochs", "first", "length", "second")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` as the mix takes them: each whole round is a copy, a part is a row with those words and the white
    space before them. Rows keep all their columns, whatever these are called; `n_chars`, if there is one, is that of the new text.
    Documents of which nothing is taken go, as do those without words (null and empty texts). A row is told by (doc_id, source, size, hash of the
    text); rows equal in these are interchangeable, and each is taken for itself. An empty table gives no rows."""
    plain, back = aside(docs, ["doc_id", "source", "text", "n_chars"])
    plain = plain.withColumn("_hash", F.xxhash64("text"))
    match = ["doc_id", "source", "_size", "_hash", "_copy"]
    same = Window.partitionBy(*match[:-1])
    rows = plain.withColumn("_size", n_words(F.col("text"))).withColumn("_copy", F.row_number().over(same.orderBy("_hash")))
    taken = mix(plain, also=("_hash",), **options).where("taken > 0").withColumnRenamed("size", "_size")
    taken = taken.withColumn("_copy", F.row_number().over(same.orderBy(F.col("taken").desc())))
    taken = taken.select(*[F.col(c).alias(f"m{c}") for c in match], "epochs", "first", "length", "second")
    joined = rows.join(taken, [F.col(c).eqNullSafe(F.col(f"m{c}")) for c in match])
    words = F.split("text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")  # each word with the white space before it
    part = lambda at, n: F.when(n >= F.col("_size"), F.col("text")).otherwise(
        F.concat_ws("", F.slice(words, (at + 1).cast("int"), n.cast("int"))))
    copies = F.when(F.col("epochs") > 0, F.array_repeat("text", F.col("epochs").cast("int"))).otherwise(F.array().cast("array<string>"))
    texts = F.concat(copies, *[F.when(n > 0, F.array(part(at, n))).otherwise(F.array().cast("array<string>")) for at, n in (
        (F.col("first"), F.col("length")), (F.lit(0), F.col("second")))])
    out = joined.withColumn("_text", F.explode(texts)).withColumn("text", F.col("_text"))
    return back(out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out)
