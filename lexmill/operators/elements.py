"""Pages as an element table, for analyses over all elements rather than single fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.html import Tree, attr, with_tree

T = Tree()


def elements(pages: DataFrame, key: str, html: str = "html") -> DataFrame:
    """One row per element: key, pos, idx, tag, markup, parent, end, stop. Narrow: no shuffle."""
    return with_tree(pages.select(key, html), html).select(key, F.inline("tree.els"))


def matches(trees: DataFrame, key: str, **query) -> DataFrame:
    """Elements meeting a query with their text and sole string; `trees` holds a tree column."""
    found = F.transform(T.find_all(**query), lambda e: F.struct(
        e["idx"].alias("idx"), T.text(e).alias("text"), T.string(e).alias("string")))
    return trees.select(key, F.inline(found))


def paired(trees: DataFrame, key: str, query: dict, other) -> DataFrame:
    """(key, idx, other_idx): each element meeting a query with the element `other(e)` finds from it."""
    rows = F.transform(T.find_all(**query), lambda e: F.struct(e["idx"].alias("idx"), other(e)["idx"].alias("other_idx")))
    return trees.select(key, F.inline(rows))


def nearest(els: DataFrame, key: str, condition: Column, name: str, later: bool) -> DataFrame:
    """Adds the idx of the nearest later or earlier element meeting a condition, for every element of a table.

    One window per page. Later elements are read in descending order with a frame that grows from its start, which
    takes linear time; a frame running to the end of the page would be computed anew for every row.
    """
    order = F.desc("idx") if later else F.asc("idx")
    before = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return els.withColumn(name, F.last(F.when(condition, F.col("idx")), ignorenulls=True).over(before))


def table_cells(trees: DataFrame, key: str, cells: dict[str, int], row_attr: str | None = None) -> DataFrame:
    """Table rows as columns: the texts of the named cells of every `tr`."""
    def row(tr: Column) -> Column:
        texts = T.texts_of(T.find_all(tr, name="td"))
        out = [F.get(texts, i).alias(n) for n, i in cells.items()]
        return F.struct(*out, *([attr(tr, row_attr).alias("row_attr")] if row_attr else []))

    return trees.select(key, F.inline(F.transform(T.find_all(name="tr"), row)))
