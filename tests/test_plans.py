"""Country plans on mini pages, the export and the streaming intake."""

import time

import pytest
from pyspark.sql import functions as F

from lexmill import schema
from lexmill.operators.keyed import assign_record_ids
from lexmill.plans import collect, france, germany, portugal
from lexmill.schema import EXPORT_COLUMNS
from lexmill.session import materialise, new_path
from lexmill.sources import sinks, tables
from lexmill.streaming.intake import intake

HEAD = '<span class="Titulo-Cinzento">Projeto de Lei 1/XV/1</span>'


def portuguese(spark, html):
    df = spark.createDataFrame([("u", html)], "url string, html string")
    return portugal.main_fields(df).first()


@pytest.mark.parametrize("body,status", [
    ("<span>Lei (Publicação DR)</span>", "PASS"), ("\n" * 20 + "<b>Rejeitado</b>", "REJECT"),
    ("<b>Rejeitado</b>" + "\n" * 20, "ONGOING"), ("<span>Iniciativa Caducada</span>", "EXPIRED"), ("", "ONGOING")])
def test_portuguese_status(spark, body, status):
    assert portuguese(spark, HEAD + body)["bill_status"] == status


def test_portuguese_rejection_votes(spark):
    row = portuguese(spark, HEAD + "\n" * 20 + "<b>Rejeitado</b><p>A Favor: BE Contra: PS,  CH</p>")
    assert (row["final_vote_for"], row["final_vote_against"], row["final_vote_abst"]) == ("BE", "PS,  CH", None)


def test_german_committees_are_distinct(spark):
    step = "<li><div><div><span>12.05.2022</span></div><div><h4>Ausschüsse:</h4><ul>{}</ul></div></div></li>"
    items = ["<li>Rechtsausschuss (federführend)</li><li>Finanzausschuss</li>", "<li>Rechtsausschuss (federführend)</li>"]
    html = '<div id="content-vorgangsablauf">' + "".join(step.format(i) for i in items) + "</div>"
    row = germany.main_fields(spark.createDataFrame([("u", html)], "url string, html string")).first()
    assert [c["committee_name"] for c in row["committees"]] == ["Rechtsausschuss (federführend)", "Finanzausschuss"]
    assert [c["committee_role"] for c in row["committees"]] == ["Lead", None]
    assert {c["committee_date"] for c in row["committees"]} == {"2022.05.12"}
    assert (row["committee_count"], row["committee_hearing_count"]) == (2, 2)


def test_german_page_without_blocks(spark):
    row = germany.main_fields(spark.createDataFrame([("u", "<h1>G</h1>")], "url string, html string")).first()
    assert (row["bill_title"], row["bill_status"], row["legislative_stages"], row["committees"]) == ("G", "ONGOING", None, [])


def test_french_type_filter(spark):
    rows = [(str(i), f'<p class="deputy-healine-sub-title">{t}</p><h1>T</h1>') for i, t in enumerate(
        ("Projet de loi", "Proposition de loi", "Résolution"))] + [("3", "<h1>x</h1>")]
    got = france.main_fields(spark.createDataFrame(rows, "url string, html string")).collect()
    assert {r["url"]: r["origin_type"] for r in got} == {"0": "GOVERNMENT", "1": "INDIVIDUAL_MP"}


def test_copies_of_a_page_give_one_record(spark):
    pages = spark.createDataFrame([("PORTUGAL", "u", "main", HEAD)] * 50, schema.PAGES)
    texts = spark.createDataFrame([], schema.DOC_TEXTS)
    assert portugal.records(pages, texts).count() == 1


def sample_records(spark):
    rows = [("R1", "X", ["L2"], "L1", "a \"q\"\nb, c ", [("A", None)]), ("R2", "X", [], "L2", "", []), ("R3", "X", None, None, None, None)]
    df = spark.createDataFrame(rows, f"record_id string, country string, modified_laws array<string>, law_id string, "
                                     f"bill_text string, originators array<{schema.ORIGINATOR}>")
    kinds = {k: v for k, v in schema.RECORD_FIELDS.items() if k not in df.columns}
    return df.withColumns({k: F.lit(None).cast(v) for k, v in kinds.items()})


def test_export_round_trip(spark):
    paths = sinks.export(sample_records(spark), new_path(spark, "export"), "X", "2024-01-01")
    assert list(paths) == list(EXPORT_COLUMNS)
    back = {t: sinks.read_table(spark, p, EXPORT_COLUMNS[t]) for t, p in paths.items()}
    assert {tuple(r) for r in back["bill_text"].collect()} == {("R1", "a \"q\"\nb, c "), ("R2", None)}  # empty reads back as NULL
    assert [tuple(r) for r in back["originators"].collect()] == [("R1", "A", None)]
    assert [tuple(r) for r in back["modified_laws"].collect()] == [("R1", "L2", "R2")]
    assert back["bill_main_table"].count() == 3
    assert back["affecting_laws"].collect()[0].asDict() == {
        "record_id": "R2", "affecting_law_id": "L1", "affecting_record_id": "R1"}


def test_readers_use_fixed_schemas(spark):
    path = new_path(spark, "pages")
    spark.createDataFrame([("FRANCE", "u", "main", "x"), ("GERMANY", "v", "main", "y")], schema.PAGES).write.parquet(path)
    assert [r["url"] for r in tables.read_pages(spark, path, "GERMANY").collect()] == ["v"]
    assert materialise(tables.read_pages(spark, path)).count() == 2


def test_streaming_intake_is_resumable(spark):
    pages, stored, state = (new_path(spark, n) for n in ("pages", "records", "state"))
    fields = "bill_page_url string, bill_status string, record_id string"

    def extract(batch, stored_rows):
        status = portugal.main_fields(batch).select("url", "bill_status")
        return assign_record_ids(status, "url", "PT", stored=stored_rows).select(F.col("url").alias("bill_page_url"), "bill_status", "record_id")

    def run(rows):
        spark.createDataFrame([("PORTUGAL", u, "main", HEAD) for u in rows], schema.PAGES).write.mode("append").parquet(pages)
        query = intake(spark, pages, stored, state, extract, fields)
        query.awaitTermination(60)
        return sorted((r["bill_page_url"], r["record_id"]) for r in spark.read.schema(fields).parquet(stored).collect())

    first = run(["a", "b", "a"])
    assert [u for u, _ in first] == ["a", "b"] and sorted(i for _, i in first) == ["PT00001", "PT00002"]
    assert run(["b", "c"]) == [*first, ("c", "PT00003")]


def test_a_run_resumes_and_continues_ids(spark):
    def run(urls, stored):
        rows = [("PORTUGAL", u, "main", HEAD) for u in urls] + [("PORTUGAL", urls[0], "main", HEAD), ("GERMANY", "x", "main", HEAD)]
        nothing = spark.createDataFrame([], "law_id string, topic_no int, topic string")
        out = collect.portuguese(spark.createDataFrame(rows, schema.PAGES), spark.createDataFrame([], schema.DOC_TEXTS), nothing,
                                 spark.createDataFrame([], "text string"), stored)
        return collect.materialise(out, "snapshot")

    first = run(["a", "b"], None)
    assert first.columns == list(schema.RECORD_FIELDS)
    second = run(["b", "c"], first)
    ids = {r["bill_page_url"]: r["record_id"] for r in second.collect()}
    assert {u: i for u, i in ids.items() if u != "c"} == {r["bill_page_url"]: r["record_id"] for r in first.collect()}
    assert sorted(ids) == ["a", "b", "c"] and ids["c"] == "PT00003"


def test_laws_of_a_table_document_reach_their_records(spark):
    records = spark.createDataFrame([("R1", "u", None, None), ("R2", "u", ["x"], 1), ("R3", None, None, None), ("R4", "v", None, None)],
                                    "record_id string, modified_laws_pdf_url string, modified_laws array<string>, modified_laws_count int")
    cells = [("u", 1, 1, 0, c, "FNA" if c == 3 else "h") for c in range(4)] + [("u", 1, 1, 1, 3, "2"), ("u", 1, 1, 2, 3, "1"), ("u", 1, 1, 3, 3, "2")]
    out = collect.with_modified_laws(records, spark.createDataFrame(cells, schema.TABLE_CELLS)).collect()
    assert {r["record_id"]: (r["modified_laws"], r["modified_laws_count"]) for r in out} == {
        "R1": (["1", "2"], 2), "R2": (["x"], 1), "R3": (None, None), "R4": (None, None)}


def test_label_dates_stop_at_any_tag_whose_name_holds_the_letters(spark):
    page = "<label>Verkündung:</label><small>01.02.2003</small><span>04.05.2006</span>"
    rows = spark.createDataFrame([("u", page)], "url string, html string")
    assert germany.main_fields(rows).select("date_passing").head()[0] == "2003.02.01"


@pytest.mark.parametrize("n", [4000, 16000])
def test_long_pages_are_read_in_proportion(spark, n):
    html = "".join(f"<h3>Dépôt\nAssemblée nationale {i}</h3><a title='Accéder au compte-rendu' href='/d/{i}'>c</a>" for i in range(n // 2))
    rows = spark.createDataFrame([("u", html)], "url string, html string")
    france.one_page_fields(rows.limit(0)).count()
    start = time.time()
    found = france.one_page_fields(rows).select("debates", "stages_count").head()
    took = time.time() - start
    assert found["stages_count"] == n // 2 and [d["debate_url"][-len(str(i)) - 1:] for i, d in enumerate(found["debates"])] == [
        f"/{i}" for i in range(n // 2)]
    assert took < 4 + n / 1000  # the page was quadratic: four times the elements took ten times as long
    print(n, took)
