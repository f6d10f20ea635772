"""Shared steps of the country plans.

Each page kind is reduced to its few fields by a narrow job over its own HTML; only those fields are shuffled. Raw
pages are never shuffled or joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.html import computed, nearest, with_tree
from lexmill.functions.text import dense_length
from lexmill.functions.urls import clean_url
from lexmill.operators.enrich import cached_texts
from lexmill.sources.text_cache import TextCache


def pages_of(pages: DataFrame, country: str, kind: str) -> DataFrame:
    return pages.where((F.col("country") == country) & (F.col("kind") == kind)).select("url", "html")


def parsed(pages: DataFrame) -> DataFrame:
    """Pages with their tree and line count; the HTML itself is dropped."""
    newlines = F.length("html") - F.length(F.replace(F.col("html"), F.lit("\n"), F.lit("")))
    return with_tree(pages.withColumns({"page_lines": newlines, "page_hash": F.xxhash64("html")}))


def staged(df: DataFrame, steps: list[dict[str, Column]]) -> DataFrame:
    """Columns added step by step, each computed once however many later ones use it."""
    for step in steps:
        df = computed(df, step)
    return df


def lookup_steps(name: str, anchors: Column, targets: dict[str, tuple[Column, bool]], build) -> list[dict[str, Column]]:
    """Steps that make the array column `name` from `anchors`, elements that each need others near them.

    `targets` names arrays of elements and whether the nearest later (else earlier) one is wanted. They are found once per page and
    walked together with the anchors, so a long page costs in proportion. `build(anchor, position, get)` makes an item, `get(target)` being
    that anchor's element."""
    own = f"_{name}"
    places = {k: f"{own}_{k}_at" for k in targets}
    number = lambda e: e.idx

    def item(a: Column, i: Column) -> Column:
        return build(a, i, lambda k: F.get(F.col(f"{own}_{k}"), F.get(F.col(places[k]), i)))

    some = F.size(own) > 0  # a page without anchors is not searched for the rest
    return [{own: anchors}, {f"{own}_{k}": F.when(some, found) for k, (found, _) in targets.items()},
            {places[k]: nearest(F.col(own), number, F.col(f"{own}_{k}"), number, later) for k, (_, later) in targets.items()},
            {name: F.transform(F.col(own), item)}]


def one_per_url(fields: DataFrame) -> DataFrame:
    """One row of fields per URL, combined before the shuffle: copies of a page cost nothing."""
    columns = [c for c in fields.columns if c not in ("url", "page_hash")]
    row = F.min_by(F.struct(*columns), "page_hash").alias("row")
    return fields.groupBy("url").agg(row).select("url", "row.*")


def url_key(url: Column) -> Column:
    """What stands for a URL in joins: never NULL, so equal keys need no test for NULL and rows stay where they were grouped by it."""
    return F.coalesce(F.concat(F.lit("="), url), F.lit(""))


def keyed_by_url(fields: DataFrame) -> DataFrame:
    """As `one_per_url`, led by `url_key`, by which the rows lie."""
    columns = [c for c in fields.columns if c != "page_hash"]
    row = F.min_by(F.struct(*columns), "page_hash").alias("row")
    return fields.groupBy(url_key(F.col("url")).alias("url_key")).agg(row).select("url_key", "row.*")


def attach_texts(df: DataFrame, key: str, doc_texts: DataFrame | TextCache, single: dict[str, Column],
                 many: dict[str, Column] | None = None, sizes: dict[str, Column] | None = None,
                 parts: dict[str, tuple[Column, dict[str, Column]]] | None = None) -> DataFrame:
    """Cached texts for several URL columns of a table in one join and one grouping.

    `single` maps a new column to a URL, `many` to an array of URLs (giving an array of texts in the same order), `sizes` to an
    array of URLs of which only the texts' lengths without white space are wanted, summed: those are measured on the cache, and the
    texts stay there. `parts` has a URL by name, with new columns that are read from its `extracted_text`: they leave the cache, the text does
    not. NULL where no text is found. Every row sends one request per URL; `key` is unique. The rows themselves wait where they lie, and what was
    found comes to them: rows that lie by a `key` that is never NULL are not shuffled.
    """
    many, sizes, parts = many or {}, sizes or {}, parts or {}

    def request(role: str, pos: Column, url: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), pos.cast("int").alias("pos"), clean_url(url).alias("clean_url"))

    alone = [request(name, F.lit(0), url) for name, url in [*single.items(), *((n, u) for n, (u, _) in parts.items())]]
    asked = [F.array(*alone)] if alone else []
    for name, urls in {**many, **sizes}.items():
        items = F.transform(urls, lambda u, i: request(name, i, u))
        asked.append(F.coalesce(items, F.filter(F.array(request(name, F.lit(0), F.lit(""))), lambda _: F.lit(False))))
    rows = df.select(F.col(key), F.inline(F.concat(*asked)))
    spread = F.when(F.col("clean_url").isNull() | (F.col("clean_url") == ""), F.concat(F.lit("#none "), F.col(key)))
    role = F.col("role")
    # Only a list has places for what is not found, so only its requests go on without a URL and without an answer.
    listed = role.isin(*many) if many else F.lit(False)
    keyed = rows.where(listed | spread.isNull()).withColumn("clean_url", F.coalesce(spread, "clean_url"))
    found = _requests(keyed, role.isin(*sizes) if sizes else F.lit(False), cached_texts(doc_texts))
    found = found.where(listed | F.col("extracted_text").isNotNull() | F.col("size").isNotNull())
    leaving = {}
    for name, (_, columns) in parts.items():
        leaving |= {c: F.when((role == name) & F.col("extracted_text").isNotNull(), value) for c, value in columns.items()}
    # What is read from a text is fixed here, below the grouping's shuffle, and a text goes on only where it is asked for.
    wanted = F.when(role.isin(*single, *many), F.col("extracted_text")) if single or many else F.lit(None).cast("string")
    found = computed(found, leaving).withColumn("extracted_text", wanted)
    aggs = [F.max(F.when(role == n, F.col("extracted_text"))).alias(n) for n in single]
    for name in many:
        item = F.when(role == name, F.struct("pos", F.col("extracted_text").alias("t")))
        aggs.append(F.transform(F.array_sort(F.collect_list(item)), lambda x: x.t).alias(name))
    aggs += [F.sum(F.when(role == n, F.col("size"))).alias(n) for n in sizes]
    read = [c for _, columns in parts.values() for c in columns]
    aggs += [F.max(c).alias(c) for c in read]
    answers = found.groupBy(key).agg(*aggs).withColumnRenamed(key, "_asked_by")
    same = F.col(key).eqNullSafe(F.col("_asked_by")) if df.schema[key].nullable else F.col(key) == F.col("_asked_by")
    together = df.join(answers, same, "left")
    # A row without any request has no answer: its lists are empty all the same.
    lists = [F.coalesce(F.col(n), F.array().cast("array<string>")).alias(n) for n in many]
    return together.select(*df.columns, *single, *lists, *sizes, *read)


def _requests(keyed: DataFrame, sized: Column, cache: DataFrame) -> DataFrame:
    """Requests with the text, or, for those of sizes, with its size, measured once per document."""
    measured = cache.select("clean_url", F.lit(None).cast("string").alias("extracted_text"), dense_length("extracted_text").alias("size"))
    whole = cache.withColumn("size", F.lit(None).cast("bigint"))
    return keyed.where(~sized).join(whole, "clean_url", "left").unionByName(keyed.where(sized).join(measured, "clean_url", "left"))
