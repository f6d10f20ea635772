"""Keyed operators, citations and enrichment against brute force on small tables."""

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from lexmill.operators import citations, enrich, keyed


def test_keep_first_with_hot_key(spark):
    df = spark.range(3000).selectExpr("id", "case when id % 3 = 0 then 'hot' else '' || id % 100 end AS k")
    got = {(r["id"], r["k"]) for r in keyed.keep_first(df, "k", "id").collect()}
    first = {}
    for i in range(3000):
        first.setdefault("hot" if i % 3 == 0 else str(i % 100), i)
    assert got == {(i, k) for k, i in first.items()}


def test_keep_first_keeps_one_null_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, k string")
    assert {r["id"] for r in keyed.keep_first(df, "k", "id").collect()} == {1, 3}


def test_patch_sets_null_and_leaves_others(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, s string")
    changes = spark.createDataFrame([("a", None)], "id string, n int")
    assert {tuple(r) for r in keyed.patch(df, changes, "id", ["n"]).collect()} == {("a", None, "x"), ("b", 2, "y")}


def test_number_rows(spark):
    urls = [f"u{i}" for i in range(500)]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    order = sorted(urls, key=lambda u: (hashlib.md5(u.encode()).hexdigest(), u))
    got = {r["url"]: r["record_id"] for r in keyed.assign_record_ids(df, "url", "DE", 99_900).collect()}
    assert got == {u: f"DE{99_901 + i:05d}" for i, u in enumerate(order)}


def test_unseen_twice_is_empty(spark):
    pages = spark.range(10).selectExpr("'u' || id AS url")
    assert keyed.unseen(pages, pages, "url").count() == 0


RECORDS = "record_id string, law_id string, date_passing string, modified_laws array<string>"


def records(spark):
    return spark.createDataFrame([
        ("R1", "L1", "2020.05.01", ["L2", "L9"]), ("R2", "L2", "unbekannt", ["L1"]), ("R3", "L2", None, ["L1", "L2"]),
        ("R4", None, "2019-1-5", ["L1"]), ("R5", "L5", "2001-01-01", None), ("R6", "L6", "2001-01-01", [])], RECORDS)


def test_citation_rollup(spark):
    got = {r["law_id"]: (r["affecting_laws_count"], r["affecting_laws_first_date"])
           for r in citations.citation_rollup(records(spark)).collect()}
    assert got == {"L1": (3, "2019-01-05"), "L2": (2, "2020-05-01"), "L9": (1, "2020-05-01")}
    owners = {r["record_id"] for r in citations.owned_rollup(records(spark)).collect()}
    assert owners == {"R1", "R2"}


def test_citation_tables(spark):
    got = {tuple(r) for r in citations.modified_laws_table(records(spark)).collect()}
    assert got == {("R1", "L2", "R2"), ("R1", "L9", None), ("R2", "L1", "R1"), ("R3", "L1", "R1"), ("R3", "L2", "R2"),
                   ("R4", "L1", "R1")}
    got = {tuple(r) for r in citations.affecting_laws_table(records(spark)).collect()}
    assert got == {("R2", "L1", "R1"), ("R1", "L2", "R2"), ("R1", "L2", "R3"), ("R2", "L2", "R3"), ("R1", None, "R4")}


def test_affiliations(spark):
    members = spark.createDataFrame([
        ("UPPER", "1", "A", "U"), ("UPPER", "2", "A", "V"), ("UPPER", "1", "B", None), ("LOWER", "1", "B", "L"),
        ("LOWER", "1", "A", "X")], "house string, page_id string, parsed_name string, parsed_affiliation string")
    names = spark.createDataFrame([("A",), ("B",), ("C",)], "n string")
    got = {r["n"]: r["affiliation"] for r in enrich.affiliations(names, "n", members).collect()}
    assert got == {"A": "U", "B": "L", "C": None}


def test_distinct_by_name(spark):
    df = spark.sql("select array(named_struct('n', 'a', 'r', 1), named_struct('n', null, 'r', 2), named_struct('n', 'a', 'r', 3), "
                   "named_struct('n', null, 'r', 4)) AS xs")
    got = df.select(enrich.distinct_by_name(F.col("xs"), "n").alias("x")).first()["x"]
    assert [r["r"] for r in got] == [1, 2]


def test_mentions(spark):
    texts = ["Projeto de Lei n.º 12 / XIV | 1, PROPOSTA DE LEI 12/XIV/1 e Projeto de Lei 7/XV/2", "nada"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = Counter({r["bill_id"]: r["count"] for r in enrich.mentions(df, "t").collect()})
    assert got == {"12/XIV/1": 2, "7/XV/2": 1}


def test_modified_law_ids(spark):
    def cells(url, page, rows):
        return [(url, page, 1, r, c, t) for r, row in enumerate(rows) for c, t in enumerate(row)]
    data = cells("d", 2, [["a", "b", "c", "FNA"], ["", "", "", "1-2"], ["", "", "", ""], ["", "", "", "1-2"]])
    data += cells("d", 3, [["a", "b", "c", "GESTA"], ["", "", "", "9-9"]])
    data += cells("d", 4, [["a", "b", "c", "FNA", "x"], ["", "", "", "8-8", ""]])
    df = spark.createDataFrame(data, "url string, page int, table_no int, `row` int, col int, text string")
    assert [tuple(r) for r in enrich.modified_law_ids(df).collect()] == [("d", "1-2")]
