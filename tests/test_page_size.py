"""Work of a task on pages and files, which must not grow with the tables, and the pass that reads a page."""

import pytest
from pyspark.sql import functions as F

from lexmill.functions.html import _Codes, read_page, with_tree
from lexmill.operators.enrich import with_text
from queries import all_queries, inputs, upkeep
from queries.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_more_rows_make_more_page_tasks(spark, monkeypatch):
    monkeypatch.setattr(inputs, "PAGES_PER_TASK", 50, raising=False)
    pages = inputs.page_rows(spark, SMALL, "orders", ["o_orderkey"])
    assert pages.count() == 1500
    assert pages.rdd.getNumPartitions() >= 30


def test_more_rows_make_more_amendment_files(spark, monkeypatch):
    monkeypatch.setattr(upkeep, "ROWS_PER_SHARE", 1000, raising=False)
    all_queries.load()
    rows = QUERIES["S4_amendment_headers"](spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert len([f for f in rows.inputFiles() if f.endswith(".csv")]) > 20
    assert sorted(r[0] for r in rows.select("number").collect()) == sorted(
        r[0] for r in lines.select(F.expr("l_orderkey || '-' || l_linenumber")).collect())


def test_read_page():
    texts, els, lines = read_page("a<!-- <p>\n--><P title='>'>b\n<br/>c</p><script>x</b></script >d</i>", _Codes())
    assert texts == ["a", "", "b\n", "c", "", "d", ""]
    assert list(zip(*els)) == [(2, 0, "p", "<P title='>'>", -1, 4, 2), (3, 1, "br", "<br/>", 0, 3, 2), (5, 2, "script", "<script>x</b></script >", -1, 5, 3)]
    assert lines == [0, 1, 1, 0, 0, 0, 0]


def test_page_is_read_without_lambdas_over_its_tokens(spark):
    plan = with_tree(spark.createDataFrame([("<p>a</p>",)], "html string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_references_are_read_without_lambdas(spark):
    page = "<p title='&quot;a&#34;&amp;quot;'>&eacute&#0065;&#%s;&#%s65;</p>&notit;" % ("9" * 6000, "0" * 5000)
    df = with_tree(spark.createDataFrame([(page,)], "html string"))
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()
    tree = df.first()["tree"]
    assert tree["texts"] == ["", "éA\ufffdA", "¬it;"]
    assert [e["markup"] for e in tree["els"]] == ["<p title='\x03a\x03&quot;'>"]


@pytest.mark.parametrize("hex_page,texts", [(None, None), ("", [""]), ("3C703EFF3C2F703E", ["", "\ufffd", ""])])
def test_pages_of_any_bytes(spark, hex_page, texts):
    df = spark.createDataFrame([(hex_page,), ("3C623E782679",)], "h string").selectExpr("h", "cast(unhex(h) as string) AS html")
    got = {r["h"]: r["texts"] for r in with_tree(df).select("h", "tree.texts").collect()}
    assert got == {hex_page: texts, "3C623E782679": ["", "x&y"]}


def test_rows_without_a_url_are_dealt_out(spark):
    """Their shuffle's partitions before they meet the texts; the texts found stay the same."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        texts = spark.createDataFrame([("c", f"u{i}#p", 1, f"text {i}", 1) for i in range(3)],
                                      "collection string, url string, size long, extracted_text string, text_size long")
        rows = spark.range(300).selectExpr("id", "case when id < 4 then 'u' || id || '#q' end AS link")
        full = with_text(rows, "link", texts)
        assert len({r[0] for r in full.where("link is null").select(F.spark_partition_id()).collect()}) > 1
        assert {r["id"]: r["extracted_text"] for r in full.collect()} == {i: f"text {i}" if i < 3 else None for i in range(300)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
