"""Id ranges, buckets, citation state, late pages, stored texts, amendment headers, exports and counts, at their edges."""

from __future__ import annotations

import os
import threading
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lexmill import schema
from lexmill.operators import citation_state, citations, enrich, keyed
from lexmill.operators.idrange import IdRanges, high_water
from lexmill.plans import collect, portugal
from lexmill.plans.metrics import Counts, absent
from lexmill.session import materialise, new_path
from lexmill.sources import sinks, tables
from lexmill.sources.buckets import Buckets
from lexmill.sources.text_cache import TextCache
from lexmill.streaming import halves
from lexmill.streaming.intake import intake


# --- ids ----------------------------------------------------------------------------------------------------------

def test_high_water_survives_deletes_and_odd_ids(spark):
    ids = spark.createDataFrame([("PT00002",), ("PT00003",), ("DE00009",), (None,), ("PTx",), ("PT123456",)], "record_id string")
    assert high_water(ids, "PT") == 123456 and high_water(ids.limit(0), "PT") == 0 and high_water(ids.drop("record_id"), "PT") == 0


def test_ranges_are_kept_for_a_batch_and_never_given_twice(spark):
    folder = new_path(spark, "ids")
    ids = IdRanges(spark, folder)
    assert [ids.reserve("PT", "a", 10), ids.reserve("PT", "b", 5), ids.reserve("PT", "a", 10), ids.reserve("DE", "a", 3)] == [1, 11, 1, 1]
    again = IdRanges(spark, folder)
    assert again.reserve("PT", "c", 1) == 16
    assert again.reserve("PT", "d", 1, used=99) == 100
    assert again.reserve("PT", "a", 10, used=10) == 101  # its first numbers are in use by now
    assert again.reserve("PT", "e", 0) == again.reserve("PT", "f", 1) == 111


def test_concurrent_batches_get_apart(spark):
    folder, got = new_path(spark, "ids"), {}

    def take(name):
        got[name] = IdRanges(spark, folder).reserve("PT", name, 7)

    threads = [threading.Thread(target=take, args=(str(i),)) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got.values()) == [1 + 7 * i for i in range(6)]


def test_a_place_is_taken_once_by_rename_too(spark):
    ids = IdRanges(spark, new_path(spark, "ids"))
    uri = type("Uri", (), {"getScheme": lambda self: "other"})()
    real = ids.fs

    class Other:  # a file system that is not the local one, on local files
        def __getattr__(self, name):
            return (lambda: uri) if name == "getUri" else getattr(real, name)

    ids.fs = Other()
    for name, value in (("x", 1), ("y", 2)):
        ids._write(name, {"v": value})
    assert ids._put_in_place("x", "place") and not ids._put_in_place("y", "place")
    assert ids._read("place") == {"v": 1}


def test_intake_reserves_ids_after_a_delete(spark):
    pages, stored, state = (new_path(spark, n) for n in ("pages", "records", "state"))
    fields = "bill_page_url string, record_id string"

    def extract(batch, last):
        return keyed.assign_record_ids(batch.select("url"), "url", "PT", last).select(F.col("url").alias("bill_page_url"), "record_id")

    def deliver(*urls):
        spark.createDataFrame([("PORTUGAL", u, "main", "x") for u in urls], schema.PAGES).write.mode("append").parquet(pages)
        intake(spark, pages, stored, state, extract, fields).awaitTermination()
        return {r.bill_page_url: r.record_id for r in spark.read.schema(fields).parquet(stored).collect()}

    first = deliver("a", "b", "c")
    assert sorted(first.values()) == ["PT00001", "PT00002", "PT00003"]
    left = materialise(spark.read.schema(fields).parquet(stored).where("record_id = 'PT00001'"), "left")
    left.write.mode("overwrite").parquet(stored)
    assert set(deliver("d").values()) == {"PT00001", "PT00004"}


# --- buckets ------------------------------------------------------------------------------------------------------

COLUMNS = {"id": "string", "n": "int", "s": "string"}


def files(folder):
    return {p: os.path.getmtime(os.path.join(p, f)) for p, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.endswith(".parquet")}


def test_a_patch_rewrites_the_buckets_it_touches(spark):
    rows = spark.range(1000).selectExpr("'r' || id AS id", "cast(id as int) AS n", "'s' AS s")
    folder = new_path(spark, "buckets")
    stored = Buckets(spark, folder, "id", COLUMNS, 32).create(rows)
    before = files(folder)
    changes = spark.createDataFrame([("r5", None), ("r7", 70)], "id string, n int")
    later = spark.createDataFrame([("r7", 71, "x")], "id string, n int, s string")
    due = stored.patch("one", [(changes, ["n"]), (later, ["n", "s"])], spark.createDataFrame([("r9",)], "id string"),
                       spark.createDataFrame([("new", 1, None)], "id string, n int, s string"))
    after = files(folder)
    assert 1 <= len(due) <= 4 and sum(before.get(p) != t for p, t in after.items()) == len(due)
    got = {r.id: (r.n, r.s) for r in stored.read().collect()}
    want = {f"r{i}": (i, "s") for i in range(1000)} | {"r5": (None, "s"), "r7": (71, "x"), "new": (1, None)}
    del want["r9"]
    assert got == want
    assert stored.patch("one", [(changes, ["n"])]) == [] and stored.read().count() == 1000


def test_a_bucket_may_become_empty_and_fill_again(spark):
    stored = Buckets(spark, new_path(spark, "buckets"), "id", COLUMNS, 4).create(spark.createDataFrame([("a", 1, "x")], "id string, n int, s string"))
    none = (spark.createDataFrame([], "id string, n int"), ["n"])
    stored.patch("gone", [none], deleted=spark.createDataFrame([("a",), ("b",)], "id string"))
    assert stored.read().count() == 0
    stored.patch("back", [none], new=spark.createDataFrame([("a", 2, "y")], "id string, n int, s string"))
    assert [tuple(r) for r in stored.read().collect()] == [("a", 2, "y")]


def test_a_batch_that_failed_halfway_goes_on_where_it_stopped(spark):
    stored = Buckets(spark, new_path(spark, "buckets"), "id", {"id": "string", "n": "int"}, 8).create(
        spark.range(40).selectExpr("'k' || id AS id", "1 AS n"))
    keys = spark.range(40).selectExpr("'k' || id AS id")
    add = lambda rows: rows.withColumn("n", F.col("n") + 1)
    some = keys.where("id < 'k2'")
    half = stored.change(some, "batch", add)
    rest = stored.change(keys, "batch", add)
    assert not set(half) & set(rest)
    assert {r.n for r in stored.read().collect()} == {2}


def test_fused_patches_equal_patches_in_turn(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)], "id string, n int, s string")
    one = spark.createDataFrame([("a", None), ("b", 5)], "id string, n int")
    two = spark.createDataFrame([("b", 6, "z"), ("c", 7, "w")], "id string, n int, s string")
    turn = keyed.patch(keyed.patch(df, one, "id", ["n"]), two, "id", ["n", "s"])
    fused = keyed.patch_all(df, [(one, ["n"]), (two, ["n", "s"])], "id")
    assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, turn.collect()), key=str)
    added = keyed.patch_all(df, [(one.withColumnRenamed("n", "m"), ["m"])], "id")
    assert {r.id: r.m for r in added.collect()} == {"a": None, "b": 5, "c": None}


# --- citation state -----------------------------------------------------------------------------------------------

RECORDS = "record_id string, law_id string, date_passing string, modified_laws array<string>"


def test_state_follows_deletes_new_dates_and_ties(spark):
    def make(rows):
        return spark.createDataFrame([(k, *v) for k, v in rows.items()], RECORDS)

    now = {f"R{i}": (f"L{i % 5}" if i % 3 else None, [None, "bad", "2020-01-02", "1999.5.1"][i % 4], ["HOT", f"L{i % 7}"] if i % 6 else None) for i in range(60)}
    now["R61"] = ("L1", "1980-01-01", ["HOT", "HOT", None])
    stored = citation_state.store(make(now), new_path(spark, "state"), 4)
    steps = [({"R61": None}, "delete the earliest"), ({"R3": ("L9", "1970-01-01", ["HOT"]), "R4": (None, None, [])}, "date anew"),
             ({"R70": ("L0", "2001-01-01", ["HOT", "L70"])}, "add"), ({"R3": None, "R70": None}, "delete again")]
    for change, name in steps:
        before = {k: now[k] for k in change if k in now}
        for k, v in change.items():
            if v is None:
                del now[k]
            else:
                now[k] = v
        after = {k: v for k, v in change.items() if v is not None}
        for _ in range(2):
            citation_state.advance(stored, make(before), make(after), name)
        full = make(now)
        for kept, whole in ((citation_state.rollup, citations.citation_rollup), (citation_state.owned_rollup, citations.owned_rollup)):
            want = [tuple(r) for r in whole(full).where("law_id is not null").collect()]
            assert Counter(map(tuple, kept(stored.read()).collect())) == Counter(want), name
    assert stored.read().where("law_id = 'L70'").count() == 0


# --- late pages ---------------------------------------------------------------------------------------------------

def test_outcomes_of_halves():
    law = ("law", "1/2020", "u")
    assert halves.outcome("", (None, None), [("bill", None, None)]) == ("bill", (None, None), False)
    assert halves.outcome("bill", (None, None), [law]) == ("done", ("1/2020", "u"), True)
    assert halves.outcome("", (None, None), [("law", "2/2020", None), law]) == ("law", ("1/2020", "u"), False)
    assert halves.outcome("law", ("1/2020", "u"), [("law", "0/2020", "v"), ("bill", None, None)]) == ("done", ("1/2020", "u"), True)
    assert halves.outcome("done", (None, None), [law, ("bill", None, None)])[2] is False
    assert halves.outcome("", (None, None), [("done", None, None)]) == ("done", (None, None), False)


HEAD = '<span class="Titulo-Cinzento">Projeto de Lei 1/XV/1</span>'
LAW = '<div class="Titulo-Cinzento"><span>Lei n.º 5/2020</span></div><p><span>Ver texto</span><a href="l.pdf">[formato PDF]</a></p>'


def page(url, kind):
    return ("PORTUGAL", url, kind, HEAD if kind == "main" else LAW)


def test_late_law_pages_meet_stored_bills_once(spark):
    pages, state, seen = new_path(spark, "pages"), new_path(spark, "state"), []
    stored = spark.createDataFrame([("old", None), ("whole", "9/2019")], "bill_page_url string, law_id string")

    def deliver(*rows):
        spark.createDataFrame(list(rows), schema.PAGES).write.mode("append").parquet(pages)
        halves.late_laws(spark, pages, state, lambda df, n: seen.extend(tuple(r) for r in df.collect()), stored=stored).awaitTermination()

    deliver(page("a", "main"), page("b", "law"), page("old", "law"))
    assert seen == [("old", "complete", "5/2020", "l.pdf")]
    deliver(page("a", "law"), page("a", "law"), page("whole", "law"), page("c", "main"))
    deliver(page("b", "main"), page("a", "main"), page("a", "law"), page("old", "law"))
    assert Counter(seen) == Counter((u, "complete", "5/2020", "l.pdf") for u in ("old", "a", "b"))


def test_a_half_that_waits_too_long_expires(spark):
    pages, state, seen = new_path(spark, "pages"), new_path(spark, "state"), []
    for rows in ([page("a", "main")], [page("z", "main")], [page("a", "law")]):
        spark.createDataFrame(rows, schema.PAGES).write.mode("append").parquet(pages)
        halves.late_laws(spark, pages, state, lambda df, n: seen.extend((r.url, r.outcome) for r in df.collect()), patience_ms=1).awaitTermination()
    assert ("a", "expired") in seen and ("a", "complete") not in seen


def test_a_batch_run_takes_late_law_pages(spark):
    texts = spark.createDataFrame([("law", "l.pdf", 1, "alteração à Lei n.º 7/1999", 1)], schema.DOC_TEXTS)
    topics = spark.createDataFrame([], "law_id string, topic_no int, topic string")
    none = spark.createDataFrame([], "text string")
    make = lambda rows: spark.createDataFrame(rows, schema.PAGES)
    first = materialise(collect.portuguese(make([page("a", "main"), page("b", "main")]), texts, topics, none), "records")
    assert {r.bill_status for r in first.collect()} == {"ONGOING"}
    both = collect.portuguese(make([page("a", "main"), page("b", "main"), page("a", "law")]), texts, topics, none, first).collect()
    got = {r.bill_page_url: r for r in both}
    ids = {r.bill_page_url: r.record_id for r in first.collect()}
    assert {u: r.record_id for u, r in got.items()} == ids
    assert (got["a"].bill_status, got["a"].law_id, got["a"].modified_laws) == ("PASS", "5/2020", ["7/1999"]) and got["b"].law_id is None


# --- stored texts -------------------------------------------------------------------------------------------------

def texts(spark):
    return spark.createDataFrame([("c", "u1#x", 1, "one", 3), ("c", "u1", 1, "first", 5), ("c", "u2", 1, "", 0), ("c", None, 1, "lost", 4)], schema.DOC_TEXTS)


def test_stored_texts_are_those_of_the_table_and_stay_where_they_are(spark):
    asked = spark.createDataFrame([(1, "u1#y"), (2, "u2"), (3, "u3"), (4, None), (5, "u1")], "id int, url string")
    cache = TextCache.write(texts(spark), 4)
    found = {}
    for name, source in (("table", texts(spark)), ("cache", cache), ("opened", TextCache.open(spark, cache.path, 4))):
        found[name] = sorted((tuple(r) for r in enrich.with_text(asked, "url", source, derived={"n": F.length("extracted_text")}).select(
            "id", "extracted_text", "n").collect()), key=str)
    assert found["table"] == found["cache"] == found["opened"] == [(1, "first", 5), (2, None, None), (3, None, None), (4, None, None), (5, "first", 5)]
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = enrich.with_text(asked, "url", cache)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    lines = plan.splitlines()
    scan = next(i for i, x in enumerate(lines) if "text_cache" in x)
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-|"))
    above = []
    for x in reversed(lines[:scan]):
        d = len(x) - len(x.lstrip(" :+-|"))
        if d < depth:
            above.append(x)
            depth = d
    assert any("SortMergeJoin" in x for x in above) and not any("Exchange" in x for x in above)
    cache.close()


# --- amendment files ----------------------------------------------------------------------------------------------

def test_files_are_read_by_their_own_headers(spark):
    folder = new_path(spark, "files")
    local = folder.removeprefix("file:")
    os.makedirs(local)
    names = schema.AMENDMENT_FILE_COLUMNS
    bodies = {"a b+c.csv": ";".join(names) + "\n" + ";".join(f"a{i}" for i in range(7)) + "\n",
              "b.csv": "﻿" + ";".join(["Extra", *reversed(names)]) + "\nx;" + ";".join(f"b{i}" for i in reversed(range(7))) + "\n",
              "c.csv": f"{names[3]};{names[0]}\n\"two\nlines; and \"\"quotes\"\"\";c0\n", "d.csv": ";".join(names) + "\n", "e.csv": ""}
    for name, body in bodies.items():
        with open(f"{local}/{name}", "w", encoding="utf-8") as f:
            f.write(body)
    forms = ["file:///{}/a%20b+c.csv", "file:{}/b.csv", "{}/c.csv", "file:///{}/d.csv", "{}/e.csv"]
    manifest = spark.createDataFrame([(f.format(local.lstrip("/") if ":///" in f else local), i, f"t{i}") for f, i in zip(forms, "abcde", strict=True)],
                                     "file_path string, amendment_file_id string, bill_title string")
    rows = {r.amendment_file_id: r for r in tables.read_amendment_files(spark, folder, manifest).collect()}
    assert sorted(rows) == ["a", "b", "c"] and [rows["a"][n] for n in names] == [f"a{i}" for i in range(7)]
    assert [rows["b"][n] for n in names] == [f"b{i}" for i in range(7)]
    assert rows["c"][names[3]] == "two\nlines; and \"quotes\"" and rows["c"][names[0]] == "c0" and rows["c"][names[1]] is None


def test_a_file_with_too_many_columns_is_an_error(spark):
    folder = new_path(spark, "files")
    os.makedirs(folder.removeprefix("file:"))
    with open(f"{folder.removeprefix('file:')}/w.csv", "w") as f:
        f.write(";".join(f"n{i}" for i in range(tables.WIDEST + 1)) + "\n" + ";".join("x" * (tables.WIDEST + 1)) + "\n")
    manifest = spark.createDataFrame([(f"{folder.removeprefix('file:')}/w.csv", "w", "t")], "file_path string, amendment_file_id string, bill_title string")
    with pytest.raises(Exception, match="columns"):
        tables.read_amendment_files(spark, folder, manifest).collect()


# --- exports and counts -------------------------------------------------------------------------------------------

def test_export_scans_records_once_and_replaces_a_day_whole(spark):
    folder = new_path(spark, "export")
    make = lambda n: spark.range(n).selectExpr("'R' || id AS record_id", "'L' || id AS law_id", "array('L' || (id + 1)) AS modified_laws",
                                               "'line' || chr(10) || id AS bill_text").repartition(3)
    for n in (50, 20):
        paths = sinks.export(make(n), folder, "X", "day")
    read = {t: sinks.read_table(spark, p, schema.EXPORT_COLUMNS[t]) for t, p in paths.items()}
    assert {t: df.count() for t, df in read.items()} == defaultdict(int) | {
        t: 20 if t in ("bill_main_table", "bill_text", "modified_laws") else 19 if t == "affecting_laws" else 0 for t in schema.EXPORT_COLUMNS}
    assert {r.bill_text for r in read["bill_text"].collect()} == {f"line\n{i}" for i in range(20)}
    days = os.listdir(f"{folder.removeprefix('file:')}/X")
    assert [x for x in days if not x.endswith(".crc")] == ["day"]
    broken = make(5).withColumn("bill_text", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        sinks.export(broken, folder, "X", "day")
    assert sinks.read_table(spark, paths["bill_text"], schema.EXPORT_COLUMNS["bill_text"]).count() == 20


def test_counts_come_from_the_job_itself(spark):
    counts = Counts()
    df = counts.observed("step", spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, b string"), absent("a", "b"))
    df.write.format("noop").mode("overwrite").save()
    assert {(r.step, r.cause): r.n for r in counts.rows(spark).collect()} == {("step", "rows"): 3, ("step", "no_a"): 1, ("step", "no_b"): 2}
    assert portugal.COUNTED
