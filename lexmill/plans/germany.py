"""German bill pages to record fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.dates import GERMAN_DATE, german_dates_in, rearrange
from lexmill.functions.html import Tree, attr
from lexmill.functions.labels import (DE_PRINTED_MATTER, GERMAN_SKIPPED_STAGES, GOVERNMENT, INDIVIDUAL_MP, ONGOING,
                                      PASSED, REJECTED, government_party_de, has, house_de, is_original_de, origin_de,
                                      originator, outcome_de, status_de)
from lexmill.functions.sections import amendment_block, bill_section, impact_sections
from lexmill.functions.text import dense_length, first_match, let, once, strip
from lexmill.functions.urls import clean_url
from lexmill.operators.enrich import cached_texts, with_amendment_stage_numbers, with_text
from lexmill.operators.keyed import regroup
from lexmill.plans.common import attach_texts, keyed_by_url, lookup_steps, one_per_url, pages_of, parsed, staged
from lexmill.plans.metrics import Counts, absent, observed
from lexmill.schema import AMENDMENT

T = Tree(known=("label", "span", "div"))


def label(text: str) -> Column:
    return T.find(name="label", string=text)


def after_label(text: str, tag: str) -> Column:
    return T.next(label(text), name=tag)


def label_dates(text: str) -> Column:
    """Every date in the next element whose tag name holds one of the three, in record form."""
    return german_dates_in(T.text(T.next(label(text), name_re="a|span|div")))


def _committee_steps() -> list[dict[str, Column]]:
    """Committees under every committee heading with the date of the enclosing step, equal ones once."""
    def under(h: Column, _: Column, get) -> Column:
        day = rearrange(first_match(T.text(T.parent(h, 3)), GERMAN_DATE))
        found = F.transform(T.texts_of(T.find_all(get("list"), name="li")), lambda n: F.struct(
            strip(n).alias("committee_name"), F.when(has(n, "(federführend)"), "Lead").alias("committee_role"),
            day.alias("committee_date")))
        return F.coalesce(found, F.array(), nothing)
    nothing = F.lit(None).cast("array<struct<committee_name:string,committee_role:string,committee_date:string>>")
    heads = T.find_all(name="h4", string="Ausschüsse:")
    return [*lookup_steps("committee_lists", heads, {"list": (T.find_all(name="ul"), True)}, under),
            {"committees": F.array_distinct(F.flatten(F.col("committee_lists")))}]


def committee_hearings() -> Column:
    return F.size(T.find_all(name="h4", string="Ausschüsse:"))


def stage_steps() -> list[dict[str, Column]]:
    """Readings in the procedure block (`block_el`), numbered in page order."""
    def reading(h: Column) -> Column:
        def named(t: Column) -> Column:
            skipped = F.lit(False)
            for word in GERMAN_SKIPPED_STAGES:
                skipped = skipped | has(t, word)
            return (has(t, "Durchgang") | has(t, "Beratung")) & ~skipped
        return let(T.text(h), named)

    heads = F.filter(T.find_all(F.col("block_el"), name="h3"), reading)
    near = {"date": (T.find_all(name="span", string_re=GERMAN_DATE), False),
            "house": (T.find_all(name="span", string_re="^BT$|^BR$"), False), "link": (T.find_all(name="a"), True)}
    return lookup_steps("legislative_stages", heads, near, lambda h, i, get: F.struct(
        (i + 1).cast("int").alias("number"), strip(T.text(h)).alias("name"), rearrange(T.text(get("date"))).alias("date"),
        house_de(T.text(get("house"))).alias("house"), F.lit(None).cast("bigint").alias("debate_size"),
        attr(get("link"), "href").alias("debate_url")))


def _blank_amendment() -> Column:
    return F.from_json(F.lit("{}"), AMENDMENT)


def edge_case_amendment() -> Column:
    """The one amendment of pages that carry it inside the procedure block; needs `block_el` and `change_el`."""
    block, change = F.col("block_el"), F.col("change_el")
    own = T.parent(change)
    link = T.find(own, name="a")
    number = first_match(T.text(link), DE_PRINTED_MATTER)
    who = T.next(change, name="span", string_re="Urheber")
    affiliation = strip(F.replace(T.text(T.parent(who)), F.lit("Urheber:"), F.lit("")))
    marks = T.find_all(own, name="strong", string_re="Änderungsantrag")
    names = F.transform(marks, lambda m: strip(F.replace(T.text(T.parent(m)), F.lit("Änderungsantrag:"), F.lit(""))))
    second = T.parent(T.find(block, name="h3", string_re="2. Beratung"))
    decisions = T.find_all(T.next(T.find(second, name="h4", string="Beschluss:"), name="ul"), name="li")
    matching = let(number, lambda n: F.filter(T.texts_of(decisions), lambda t: F.contains(t, n)))
    one = let(matching, lambda m: F.when(F.size(m) == 1, F.get(m, 0)))
    outcome = let(one, lambda t: F.when(has(t, "Ablehnung"), REJECTED).when(has(t, "Annahme"), PASSED))
    return (_blank_amendment().withField("amendment_stage_number", F.lit(1))
            .withField("amendment_stage_name", F.lit("1. Beratung"))
            .withField("amendment_originator_aff", affiliation)
            .withField("amendment_date", rearrange(T.text(T.previous(change, name="span", string_re=GERMAN_DATE))))
            .withField("amendment_plenary", house_de(T.text(T.previous(change, name="span", string_re="BT|BR"))))
            .withField("amendment_text_url", attr(link, "href"))
            .withField("amendment_id", number)
            .withField("amendment_originator",
                       let(names, lambda ns: F.when(F.size(ns) > 0, F.array(F.array_join(ns, "; ")))))
            .withField("amendment_outcome", outcome))


def edge_case_amendments() -> Column:
    return F.when(F.col("change_el").isNotNull(), F.array(edge_case_amendment()))


def _listed_steps() -> list[dict[str, Column]]:
    near = {"link": (T.find_all(name="a"), True), "stage": (T.find_all(name="h3"), False),
            "house": (T.find_all(name="div", string_re="^Bundestag$|^Bundesrat$"), False),
            "date": (T.find_all(name="span", string_re=GERMAN_DATE), False)}
    rows = lookup_steps("listed_all", T.find_all(F.col("block_el"), name="div", string_re="Antrag:"), near, lambda m, _, get: (
        _blank_amendment().withField("amendment_page_link", attr(get("link"), "href"))
        .withField("amendment_stage_name", strip(T.text(get("stage"))))
        .withField("amendment_plenary", house_de(T.text(get("house"))))
        .withField("amendment_date", rearrange(T.text(get("date"))))))
    return [*rows, {"listed": F.when(F.size("listed_all") > 0, F.col("listed_all"))}]


def with_block_elements(df: DataFrame) -> DataFrame:
    """Adds the strings of the tags most looked for, the procedure block and the change request inside it."""
    return staged(df, [*T.string_steps(), {"block_el": T.find(name="div", id="content-vorgangsablauf")},
                       {"change_el": T.find(F.col("block_el"), name="h3", string_re="Änderungsantrag")}])


def bill_status() -> Column:
    return F.coalesce(F.when(label("Beratungsstand:").isNull(), ONGOING),
                      status_de(strip(T.text(after_label("Beratungsstand:", "span")))))


def _leading_committee() -> Column:
    head = T.find(F.col("block_el"), name="h4", string="Ausschüsse:")
    leads = F.filter(T.texts_of(T.find_all(T.next(head, name="ul"), name="li")), lambda t: has(t, "(federführend)"))
    return let(leads, lambda ls: F.when(
        F.size(ls) == 1, F.replace(F.get(ls, 0), F.lit(" (federführend)"), F.lit(""))))


def _names(tag_parent: Column, tag: str, strip_them: bool) -> Column:
    texts = T.texts_of(T.find_all(tag_parent, name=tag))
    return F.array_join(F.transform(texts, strip) if strip_them else texts, " - ")


@once
def _main_steps() -> list[dict[str, Column]]:
    elements = {
        "bill_status": bill_status(),
        "origin_text": T.text(T.parent(T.find(name="span", string_re="Urheber:"))),
        "introduced": label_dates("Wichtige Drucksachen"),
        "announced": label_dates("Verkündung:"),
        "first_doc": attr(after_label("Wichtige Drucksachen", "a"), "href"),
        "last_doc": T.text(T.last(after_label("Wichtige Drucksachen", "ul"), name="li")),
        "initiators": F.transform(T.texts_of(T.find_all(after_label("Initiative:", "ul"), name="li")), strip),
        "plenary_el": after_label("Plenum", "ul"),
        "edge": edge_case_amendments(),
    }
    amendments = F.coalesce(F.col("edge"), with_amendment_stage_numbers(F.col("listed"), F.col("legislative_stages")))
    return [*stage_steps(), *_committee_steps(), *_listed_steps(), elements, {"origin_type": origin_de("origin_text"), "amendments": amendments}]


@once
def _main_columns() -> list[Column]:
    government = F.array(originator(F.lit("Bundesregierung"), government_party_de("origin_text")))
    own = F.transform("initiators", lambda n: originator(n, n))
    names = F.array_distinct(F.transform("committees", lambda c: c["committee_name"]))
    printed = F.when(F.col("bill_status") == PASSED, first_match("last_doc", DE_PRINTED_MATTER))
    plenary = F.transform(T.find_all(F.col("plenary_el"), name="a"), lambda a: attr(a, "href"))
    return [
        *map(F.col, ("bill_status", "origin_type", "committees", "legislative_stages", "amendments")),
        T.text(T.find(name="h1")).alias("bill_title"), T.text(after_label("ID:", "span")).alias("bill_id"),
        F.get("introduced", F.lit(0)).alias("date_introduction"),
        F.try_element_at("announced", F.lit(-1)).alias("date_passing"),
        F.get(label_dates("Inkrafttreten:"), 0).alias("date_entering_into_force"),
        _names(after_label("Sachgebiete:", "div"), "li", True).alias("bill_type"),
        F.when(F.col("origin_type") == INDIVIDUAL_MP, own)
        .when(F.col("origin_type") == GOVERNMENT, government).alias("originators"),
        F.when(F.endswith("first_doc", F.lit(".pdf")), F.col("first_doc")).alias("bill_text_url"),
        F.size(names).alias("committee_count"), committee_hearings().alias("committee_hearing_count"),
        _names(after_label("Schlagwörter:", "div"), "div", False).alias("policy_area"),
        F.when(F.col("legislative_stages").isNotNull(), F.size("legislative_stages")).alias("stages_count"),
        attr(after_label("Archivsignatur:", "a"), "href").alias("modified_laws_pdf_url"),
        _leading_committee().alias("leading_committee_name"),
        F.lit(True).alias("ia_dummy"), F.get("introduced", F.lit(0)).alias("ia_date"),
        F.when(F.col("amendments").isNotNull(), F.size("amendments")).alias("amendment_count"),
        printed.alias("final_version_printed_matter_id"),
        attr(after_label("Verkündung:", "a"), "href").alias("law_text_url"),
        plenary.alias("plenary_links"),
    ]


def main_fields(pages: DataFrame) -> DataFrame:
    """Fields of the bill page. `pages(url, html)`; narrow."""
    return staged(with_block_elements(parsed(pages)), _main_steps()).select("url", "page_hash", *_main_columns())


def unused_dates(pages: DataFrame) -> DataFrame:
    """Committee and introduction date by heading, kept as variants of the label dates."""
    block = T.find(name="div", id="content-vorgangsablauf")
    committee = T.previous(T.find(name="h3", string="Empfehlungen der Ausschüsse"), name="span", string_re=GERMAN_DATE)
    intro = T.previous(T.next(block, name="h3", string_re="Gesetzentwurf"), name="span", string_re=GERMAN_DATE)
    return staged(parsed(pages), T.string_steps()).select("url", rearrange(T.text(committee)).alias("date_committee"),
                                                          rearrange(T.text(intro)).alias("ia_date"))


def amendment_page_fields(pages: DataFrame) -> DataFrame:
    """Fields of amendment pages, one row per `amendment_page_link`."""
    listed = T.texts_of(T.find_all(T.next(T.find(name="h3", string_re="Antrag"), name="ul"), name="li"))
    names = F.transform(F.filter("items", lambda t: ~has(t, "und andere")),
                        lambda t: strip(F.replace(t, F.lit("Antrag:"), F.lit(""))))
    fields = staged(parsed(pages), [*T.string_steps(), {"items": listed}]).select(
        "url", "page_hash", T.text(after_label("ID:", "span")).alias("amendment_id"),
        outcome_de(T.text(after_label("Beratungsstand:", "span"))).alias("amendment_outcome"),
        attr(after_label("Wichtige Drucksachen", "a"), "href").alias("amendment_text_url"),
        F.when(F.col("items").isNotNull(), F.array(F.array_join(names, "; "))).alias("amendment_originator"),
        T.text(after_label("Initiative:", "span")).alias("amendment_originator_aff"))
    return one_per_url(fields).withColumnRenamed("url", "amendment_page_link")


AMENDMENT_PAGE_FIELDS = ["amendment_id", "amendment_outcome", "amendment_text_url", "amendment_originator",
                         "amendment_originator_aff"]


def bill_text_columns(full_text: Column) -> dict[str, Column]:
    section = bill_section(full_text)
    return {"bill_text": section, "bill_size": dense_length(section)}


def impact_columns(full_text: Column) -> dict[str, Column]:
    first, second = impact_sections(full_text)
    return {"ia_text1": first, "ia_size1": dense_length(first), "ia_text2": second, "ia_size2": dense_length(second)}


def law_columns(law_text: Column) -> dict[str, Column]:
    return {"law_text": strip(law_text), "law_size": dense_length(law_text), "original_law": is_original_de(law_text)}


def amendment_texts(amendments: DataFrame, doc_texts: DataFrame) -> DataFrame:
    """Texts and sizes of amendment rows that have a URL and no text yet."""
    due = F.col("amendment_text_url").isNotNull() & F.col("amendment_text").isNull()
    block = amendment_block("extracted_text")
    full = with_text(amendments, "amendment_text_url", doc_texts, "_full", {"_block": block, "_size": dense_length(block)})
    size = F.coalesce("_size", F.lit(0).cast("bigint"))
    return full.withColumns({
        "amendment_text_size": F.when(due, size).otherwise(F.col("amendment_text_size")),
        "amendment_text": F.when(due, F.col("_block")).otherwise(F.col("amendment_text"))}).drop(
        "_full", "_block", "_size")


def with_stage_debate_sizes(records_: DataFrame, doc_texts: DataFrame, key: str = "record_id") -> DataFrame:
    """Sizes of the debates of stages that have a URL and no size yet.

    Only the size of a cached text travels through the join, never the text.
    """
    sizes = cached_texts(doc_texts).select("clean_url", dense_length("extracted_text").alias("_size"))
    rows = records_.select(key, F.posexplode("legislative_stages").alias("pos", "s"))
    due = F.col("s.debate_url").isNotNull() & (F.coalesce(F.col("s.debate_size"), F.lit(0)) == 0)
    asked = rows.withColumn("clean_url", F.when(due, clean_url(F.col("s.debate_url"))))
    joined = asked.join(sizes, "clean_url", "left")
    item = F.col("s").withField("debate_size", F.when(due, F.coalesce("_size", F.lit(0).cast("bigint")))
                                .otherwise(F.col("s.debate_size")))
    filled = regroup(joined, key, "pos", item, "_stages")
    return (records_.join(filled, key, "left")
            .withColumn("legislative_stages", F.coalesce("_stages", "legislative_stages")).drop("_stages"))


COUNTED = ["bill_id", "bill_title", "origin_type", "date_introduction", "bill_text_url"]  # fields whose absence a run counts


def records(pages: DataFrame, doc_texts: DataFrame, counts: Counts | None = None) -> DataFrame:
    """One record per bill page, with sections of the cached document texts; the whole texts stay in the cache."""
    main = keyed_by_url(observed(counts, "pages", main_fields(pages_of(pages, "GERMANY", "main")), absent(*COUNTED)))
    text = F.col("extracted_text")
    bill = {**impact_columns(text), **bill_text_columns(text)}
    full = attach_texts(main, "url_key", doc_texts, {}, sizes={"plenary_length": F.col("plenary_links")},
                        parts={"bill": (F.col("bill_text_url"), bill), "law": (F.col("law_text_url"), law_columns(text))})
    size, none = F.coalesce("plenary_length", F.lit(0).cast("bigint")), F.lit(0).cast("bigint")
    has_bill = F.col("bill_text_url").isNotNull()
    # A size of a text that is not there is 0, as of a section that is not.
    sizes = {c: F.when(has_bill, F.coalesce(c, none)) for c in ("bill_size", "ia_size1", "ia_size2")}
    step = full.withColumns({**sizes, "plenary_size": F.when(F.col("plenary_links").isNotNull(), size),
                             "bill_page_url": F.col("url"), "country": F.lit("GERMANY")})
    some = F.col("ia_text1").isNotNull() | F.col("ia_text2").isNotNull()
    return step.withColumns({
        "ia_text_url": F.when(some, F.col("bill_page_url")),
        "ia_size1": F.when(some, F.col("ia_size1")), "ia_size2": F.when(some, F.col("ia_size2")),
    }).drop("url", "url_key", "plenary_links", "plenary_length")
