"""What a run moves and keeps on disk: records lie by their URL, pages stay where they are, shuffle files go with the step that made them."""

import re

from pyspark.sql import functions as F

from lexmill import schema
from lexmill.plans import collect
from lexmill.plans.common import attach_texts, keyed_by_url
from lexmill.session import materialise


def moved(df) -> list[str]:
    """Columns that go into each shuffle of a plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]", text)


def with_settings(spark, settings, work):
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return work()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_rows_stay_while_texts_come_to_them(spark):
    texts = spark.createDataFrame([("c", f"u{i}", 1, f"text {i}", 1) for i in range(3)], schema.DOC_TEXTS)
    fields = spark.createDataFrame([("a", 1, "x", "u0", ["u1", None, "none", "u2"]), (None, 2, "y", "u1", None), ("b", 3, "z", None, []), ("", 4, "w", "u2", ["u0"])],
                                   "url string, page_hash long, heavy string, link string, links array<string>")
    full = attach_texts(keyed_by_url(fields), "url_key", texts, {"text": F.col("link")}, {"texts": F.col("links")}, {"size": F.col("links")})
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    shuffles = with_settings(spark, plain, lambda: moved(full))
    assert shuffles and not [x for x in shuffles if re.search(r"\b(own|heavy|row)#", x)], shuffles
    assert {r["url"]: (r["heavy"], r["text"], r["texts"], r["size"]) for r in full.collect()} == {
        "a": ("x", "text 0", ["text 1", None, None, "text 2"], 10), None: ("y", "text 1", [], None), "b": ("z", None, [], None), "": ("w", "text 2", ["text 0"], 5)}


def test_a_key_that_may_be_null_gets_its_texts(spark):
    texts = spark.createDataFrame([("c", "u", 1, "text", 1)], schema.DOC_TEXTS)
    rows = spark.createDataFrame([(None, "u"), ("k", "u"), ("l", "v")], "key string, link string")
    assert {r["key"]: r["text"] for r in attach_texts(rows, "key", texts, {"text": F.col("link")}).collect()} == {None: "text", "k": "text", "l": None}


def test_seen_pages_are_not_shuffled(spark):
    pages = spark.createDataFrame([("PORTUGAL", f"u{i}", "main", "<p>") for i in range(3000)] + [("PORTUGAL", None, "main", "<p>"), ("PORTUGAL", "u1", "law", "<p>")],
                                  "country string, url string, kind string, html string")
    stored = materialise(spark.range(2999).selectExpr("'PORTUGAL' AS country", "'u' || id AS bill_page_url"), "records")
    new = with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "4096", "spark.sql.adaptive.enabled": "false"}, lambda: (
        out := collect.new_pages(pages, stored), moved(out))[::1])
    assert not [x for x in new[1] if "html#" in x], new[1]
    assert sorted((r["url"] or "", r["kind"]) for r in new[0].collect()) == [("", "main"), ("u1", "law"), ("u2999", "main")]


def test_a_written_step_leaves_no_shuffle_files(spark):
    shuffles = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    before, key = shuffles(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    counts = materialise(spark.range(1000).groupBy(F.col("id") % 7).count())
    assert shuffles() <= before
    assert spark.conf.get(key, None) == was
    assert counts.agg(F.sum("count")).head()[0] == 1000
