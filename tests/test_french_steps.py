"""What the French run does once: dossiers are parsed once, debates are measured where they lie."""

import re

from pyspark.sql import functions as F

from lexmill import schema
from lexmill.plans import collect, france
from queries import france as pages_of_france
from queries.inputs import members

SMALL = "/root/testdata/sf0.001"


def parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython")


def test_main_pages_are_parsed_once(spark):
    """Main pages are read ahead and written; one-page dossiers and bill texts are named twice (one shuffle each), the other kinds once."""
    texts = spark.createDataFrame([], schema.DOC_TEXTS)
    assert parses(france.records(pages_of_france.pages(spark, SMALL), texts, members(spark, SMALL))) <= 8


def test_no_debate_text_is_shuffled(spark):
    one = spark.createDataFrame([("u", [("d1", "s", "LOWER"), ("d2", "s", None), ("d3", None, "UPPER"), ("gone", "t", "LOWER")]), ("v", [("d2", None, None)]), ("w", [])],
                                "url string, debates array<struct<debate_url:string,name:string,house:string>>")
    one = one.withColumn("legislative_stages", F.expr("array(named_struct('name', 's', 'house', 'LOWER', 'debate_size', 7L), named_struct('name', 't', 'house', 'LOWER', 'debate_size', 8L))"))
    pages = spark.createDataFrame([("FRANCE", f"d{i}", "debate", f"<div id='englobe'>{'x ' * i}</div>") for i in (1, 2, 3)], "country string, url string, kind string, html string")
    sized = france.with_debates(one, pages)
    got = {r["url"]: ([s["debate_size"] for s in r["legislative_stages"]], r["plenary_size"]) for r in sized.collect()}
    assert got == {"u": ([1, None], 6), "v": ([7, 8], 2), "w": ([7, 8], None)}
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(sized._jdf.queryExecution(), "formatted")
    assert not [x for x in re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan) if "debate_text" in x]
    assert parses(sized) == 1


def test_dossiers_without_a_url_get_no_record(spark):
    pages = spark.createDataFrame([("FRANCE", u, "main", "<p class='deputy-healine-sub-title'>Projet de loi</p>") for u in ("a", "b", "b", None)],
                                  "country string, url string, kind string, html string")
    rows = pages_of_france.amendment_rows(spark, SMALL).where("false")
    run = collect.french(pages, spark.createDataFrame([], schema.DOC_TEXTS), members(spark, SMALL), rows)
    assert sorted(r["bill_page_url"] for r in run.collect()) == ["a", "b"]
    assert sorted(r["record_id"] for r in run.collect()) == ["FR00001", "FR00002"]
