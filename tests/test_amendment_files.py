"""Amendment files of growing tables, and page tables of which one kind is read."""

import pytest
from pyspark.sql import functions as F

from queries import all_queries, france, portugal, records
from queries.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_more_rows_make_more_files(spark, monkeypatch):
    monkeypatch.setattr(records, "ROWS_PER_SHARE", 1000, raising=False)
    all_queries.load()
    rows = QUERIES["S4_amendment_files"](spark, SMALL)
    lines = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    assert len([f for f in rows.inputFiles() if f.endswith(".csv")]) > 20
    assert sorted(r[0] for r in rows.select("number").collect()) == sorted(r[0] for r in lines.select(F.expr("l_orderkey || '-' || l_linenumber")).collect())


@pytest.mark.parametrize("country,kind,other", [(france, "votes", "carrousel-auteurs"), (portugal, "law", "contentBox")])
def test_one_kind_of_page_is_composed_alone(spark, country, kind, other):
    plan = country.pages(spark, SMALL).where(F.col("kind") == kind)._jdf.queryExecution().optimizedPlan().toString()
    assert other not in plan


def test_orders_without_a_key_have_no_french_pages(spark, tmp_path):
    spark.read.parquet(f"{SMALL}/orders.parquet").limit(3).withColumn("o_orderkey", F.lit(None).cast("bigint")).write.parquet(f"{tmp_path}/orders.parquet")
    assert france.pages(spark, str(tmp_path)).count() == 0
