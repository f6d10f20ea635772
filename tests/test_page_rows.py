"""What a page's row holds while it waits for the Arrow UDF, and the look-ups that need none."""

import bisect

from pyspark.sql import functions as F

from lexmill.functions.html import Tree, nearest, with_tree
from lexmill.plans import france, germany, portugal

T = Tree()


def test_pages_wait_as_strings(spark):
    """One Arrow UDF per page, behind rows without the page's tree or tokens."""
    pages = spark.createDataFrame([("u", "<p>a</p>")], "url string, html string")
    for fields in (portugal.main_fields, germany.main_fields, france.one_page_fields):
        plan = fields(pages)._jdf.queryExecution().optimizedPlan()
        assert plan.toString().count("ArrowEvalPython") == 1
        while "ArrowEvalPython" not in plan.nodeName():
            assert plan.children().size() == 1
            plan = plan.children().head()
        waiting = plan.children().head().schema()
        assert {f.dataType().simpleString() for f in (waiting.apply(i) for i in range(waiting.size()))} <= {"string", "int", "bigint"}


def test_nearest(spark):
    rows = [([], [1]), ([3], []), ([5, 7, 9], [1, 5, 6, 9, 12]), (list(range(0, 90, 4)), list(range(0, 70, 3))), (None, [1]), ([1], None)]
    df = spark.createDataFrame(list(enumerate(rows)), "k int, r struct<a:array<int>,t:array<int>>").select("k", "r.*")
    own = lambda x: x
    got = df.select("k", *[nearest(F.col("a"), own, F.col("t"), own, later).alias(n) for n, later in (("later", True), ("earlier", False))])
    for r in got.collect():
        a, t = rows[r["k"]]
        t = t or []
        after = None if a is None else [i if (i := bisect.bisect_right(t, x)) < len(t) else None for x in a]
        before = None if a is None else [i if (i := bisect.bisect_left(t, x) - 1) >= 0 else None for x in a]
        assert (r["later"], r["earlier"]) == (after, before)


def test_separators_in_a_page_are_dropped(spark):
    df = spark.createDataFrame([("\x01x<p\x02>a\x03\x01</p>\n\x01<b>c\nd</b>",)], "html string")
    row = with_tree(df).select(F.transform(T.els, T.text).alias("texts"), T.texts.alias("all"), "tree_lines").first()
    assert (row["texts"], row["all"], row["tree_lines"]) == (["a", "c\nd"], ["x", "a", "\n", "c\nd", ""], [0, 0, 1, 1, 0])
