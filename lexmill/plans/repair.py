"""Repair jobs: derive a column again for the rows that need it and write a new snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.html import attr
from lexmill.functions.labels import ONGOING, repair_house_de
from lexmill.functions.text import dense_length
from lexmill.functions.urls import clean_url, strip_search_params
from lexmill.operators.enrich import merge_amendment_pages, with_amendment_stage_numbers, with_text
from lexmill.operators.keyed import keep_first, patch, patch_where
from lexmill.plans import germany
from lexmill.plans.common import one_per_url, parsed, staged


def _due(records: DataFrame, condition) -> DataFrame:
    return records.where(condition).select("record_id", F.col("bill_page_url").alias("url"))


def _from_pages(records: DataFrame, condition, pages: DataFrame, columns: dict, steps: list | None = None) -> DataFrame:
    """Patch from the records' own pages; pages without a due record are dropped before they are parsed."""
    due = _due(records, condition)
    wanted = pages.select("url", "html").join(due.select("url"), "url", "left_semi")
    fields = one_per_url(staged(germany.with_block_elements(parsed(wanted)), steps or []).select(
        "url", "page_hash", *[c.alias(n) for n, c in columns.items()]))
    return due.join(fields, "url")


def impact_texts(records: DataFrame, doc_texts: DataFrame) -> DataFrame:
    due = records.where(F.col("bill_text_url").isNotNull()).select("record_id", "bill_text_url", "date_introduction")
    cols = germany.impact_columns(F.col("full"))
    found = with_text(due, "bill_text_url", doc_texts, "full").select(
        "record_id", F.col("date_introduction").alias("ia_date"), F.col("bill_text_url").alias("ia_text_url"),
        F.lit(None).cast("string").alias("ia_text"), F.lit(None).cast("bigint").alias("ia_size"),
        *[c.alias(n) for n, c in cols.items()])
    changes = found.where(F.col("ia_text1").isNotNull() | F.col("ia_text2").isNotNull())
    return patch(records, changes, "record_id", [c for c in changes.columns if c != "record_id"])


def impact_text_urls(records: DataFrame) -> DataFrame:
    due = (F.col("bill_text_url").isNotNull() & F.col("ia_text1").isNotNull() & F.col("ia_text_url").isNull())
    return patch_where(records, due, {"ia_text_url": F.col("bill_text_url")})


def impact_dates(records: DataFrame) -> DataFrame:
    due = (F.col("ia_text1").isNotNull() | F.col("ia_text2").isNotNull()) & F.col("ia_date").isNull()
    return patch_where(records, due, {"ia_date": F.col("date_introduction")})


def law_text_urls(records: DataFrame, pages: DataFrame, pattern: str = "https://www.bgbl.de/xaver/bgbl") -> DataFrame:
    link = attr(germany.after_label("Verkündung:", "a"), "href")
    changes = _from_pages(records, F.col("law_text_url").rlike(pattern), pages, {"law_text_url": link})
    return patch(records, changes.where(F.col("law_text_url").isNotNull()), "record_id", ["law_text_url"])


def bill_texts(records: DataFrame, doc_texts: DataFrame) -> DataFrame:
    due = records.where(F.col("bill_text_url").isNotNull()).select("record_id", "bill_text_url")
    cols = germany.bill_text_columns(F.col("full"))
    changes = with_text(due, "bill_text_url", doc_texts, "full").select(
        "record_id", *[c.alias(n) for n, c in cols.items()])
    return patch(records, changes, "record_id", ["bill_text", "bill_size"])


def bill_sizes(records: DataFrame) -> DataFrame:
    return patch_where(records, F.col("bill_text").isNotNull(), {"bill_size": dense_length("bill_text")})


def committee_hearings(records: DataFrame, pages: DataFrame) -> DataFrame:
    changes = _from_pages(records, F.col("committee_hearing_count").isNull(), pages,
                          {"committee_hearing_count": germany.committee_hearings()})
    return patch(records, changes, "record_id", ["committee_hearing_count"])


def committee_counts(records: DataFrame) -> DataFrame:
    names = F.size(F.array_distinct(F.transform("committees", lambda c: c["committee_name"])))
    return patch_where(records, F.col("committee_count") > 1, {"committee_count": names})


def stage_numbers(records: DataFrame) -> DataFrame:
    return records.withColumn("legislative_stages", F.transform(
        "legislative_stages", lambda s, i: s.withField("number", (i + 1).cast("int"))))


def amendment_stage_numbers(records: DataFrame) -> DataFrame:
    return records.withColumn("amendments", with_amendment_stage_numbers(
        F.col("amendments"), F.col("legislative_stages")))


def bill_status(records: DataFrame, pages: DataFrame) -> DataFrame:
    changes = _from_pages(records, F.col("bill_status") == ONGOING, pages, {"bill_status": germany.bill_status()})
    return patch(records, changes, "record_id", ["bill_status"])


def stages(records: DataFrame, pages: DataFrame, more_than: int = 10) -> DataFrame:
    changes = _from_pages(records, F.col("stages_count") > more_than, pages, {
        "legislative_stages": F.col("legislative_stages")}, germany.stage_steps())
    counted = changes.withColumn("stages_count", F.when(
        F.col("legislative_stages").isNotNull(), F.size("legislative_stages")))
    return patch(records, counted, "record_id", ["legislative_stages", "stages_count"])


def amendments(records: DataFrame, pages: DataFrame) -> DataFrame:
    changes = _from_pages(records, F.col("amendment_count") > 1, pages, {"amendments": germany.edge_case_amendments()})
    counted = changes.where(F.col("amendments").isNotNull()).withColumn("amendment_count", F.size("amendments"))
    return patch(records, counted, "record_id", ["amendments", "amendment_count"])


def clean_document_urls(docs: DataFrame, order: str) -> DataFrame:
    """Cached documents under their cleaned URL, repeated ones dropped."""
    return keep_first(docs.withColumn("url", clean_url("url")), "url", order)


def clean_links(links: DataFrame, url: str, order: str) -> DataFrame:
    """Links without search parameters, repeated ones dropped."""
    return keep_first(links.withColumn(url, strip_search_params(url)), url, order)


def amendment_houses(records: DataFrame) -> DataFrame:
    return records.withColumn("amendments", F.transform("amendments", lambda a: a.withField(
        "amendment_plenary", repair_house_de(a["amendment_plenary"]))))


def amendment_affiliations(records: DataFrame, amendment_pages: DataFrame) -> DataFrame:
    fields = germany.amendment_page_fields(amendment_pages).select("amendment_page_link", "amendment_originator_aff")
    return merge_amendment_pages(records, fields, ["amendment_originator_aff"])
