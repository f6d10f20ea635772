"""French bill pages to record fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.dates import (FRENCH_PUBLICATION, FRENCH_SUBMISSION, french_date, french_date_in, impact_date,
                                     iso)
from lexmill.functions.html import Tree, attr
from lexmill.functions.labels import (FR_LAW_ID, FR_MODIFIED_LAWS, FRENCH_BILL_TYPES, INDIVIDUAL_MP, ONGOING, PASSED,
                                      REJECTED, WITHDRAWN, bill_id_fr, committee_fr, has, heading_parts, house_fr,
                                      law_id_fr, modified_laws, origin_fr, outcome_fr_page, stage_name_fr)
from lexmill.functions.text import (clean_name, clean_text, dense_length, filled_lines, first_int, first_match, let,
                                    once, split_page_names, strip)
from lexmill.functions.urls import FRENCH_HOST, absolute_url
from lexmill.functions.votes import vote_counts_fr
from lexmill.operators.enrich import affiliations, cached_texts, distinct_by_name
from lexmill.operators.keyed import patch, regroup
from lexmill.plans.common import attach_texts, lookup_steps, one_per_url, pages_of, parsed, staged
from lexmill.plans.metrics import Counts, absent, observed
from lexmill.session import materialise

T = Tree()
HTTP = ("http",)


def text_block() -> Column:
    """Text of the first of four containers a page may have."""
    box = F.coalesce(T.find(name="iframe", id="docOpaqueIFrame"), T.find(name="div", cls="SYCERON"),
                     T.find(name="div", id="wysiwyg"), T.find(name="div", id="englobe"))
    return T.text(box)


def _originator_names() -> Column:
    block = T.find(name="div", cls="carrousel-auteurs-rapporteurs")
    authors = F.transform(T.find_all(block, name="p", cls="nom-personne"),
                          lambda p: clean_name(T.string(T.find(p, name="a"))))
    signers = split_page_names(T.text(T.find(name="div", id="cosignataires-liste")))
    nobody = F.array().cast("array<string>")
    return F.concat(F.coalesce(authors, nobody), F.coalesce(signers, nobody))


@once
def _main_elements() -> dict[str, Column]:
    return {
        "prom_el": T.find(name="div", id_re=r"\d\d-PROM"),
        "depot_el": T.find(name="div", id_re="DEPOT$"),
        "impact_el": T.find(name="h4", string_re="Etude d'impact"),
        "fast": T.find(name="strong", string_re="Le Gouvernement a engagé la procédure accélérée").isNotNull(),
        "origin_type": origin_fr(strip("type_text")),
        "names": _originator_names(),
    }


@once
def _main_columns() -> list[Column]:
    left = T.find_all(F.col("depot_el"), name="div", cls="cartouche-rapporteur-left")
    bill_link = let(left, lambda d: attr(F.when(F.size(d) == 1, T.find(F.get(d, 0), name="a")), "href"))
    published = T.text_in(F.col("prom_el"), FRENCH_PUBLICATION)
    return [
        F.col("origin_type"),
        F.col("prom_el").isNotNull().alias("promulgated"),
        T.text(T.find(name="h1")).alias("bill_title"),
        bill_id_fr("url", T.text(F.col("depot_el"))).alias("depot_id"),
        F.when((F.col("origin_type") == INDIVIDUAL_MP) & (F.size("names") > 0), F.col("names")).alias("names"),
        law_id_fr(T.text_in(F.col("prom_el"), FR_LAW_ID)).alias("law_id"),
        iso(french_date(published)).alias("date_entering_into_force"),
        let(bill_link, lambda u: absolute_url(u)).alias("bill_text_url"),
        attr(T.find(F.col("prom_el"), name="a"), "href").alias("law_text_url"),
        F.when(F.col("fast"), "EXCEPTIONAL").otherwise("REGULAR").alias("procedure_type_standard"),
        F.when(F.col("fast"), "Accelerée").otherwise("Ordinaire").alias("procedure_type_national"),
        F.col("impact_el").isNotNull().alias("ia_dummy"),
        attr(T.find(T.parent(F.col("impact_el")), name="a"), "href").alias("ia_link"),
    ]


def main_fields(pages: DataFrame) -> DataFrame:
    """Fields of the main page, for the two bill types that are kept; other pages leave after their type is read."""
    typed = staged(parsed(pages), [{"type_text": T.text(T.find(name="p", cls="deputy-healine-sub-title"))}])
    kept = typed.where(strip("type_text").isin(*FRENCH_BILL_TYPES))
    return staged(kept, [_main_elements()]).select("url", "page_hash", *_main_columns())


def _stage_steps() -> list[dict[str, Column]]:
    def one(h: Column, _: Column, get) -> Column:
        parts = F.transform(F.filter(F.split(T.text(h), "\n"), lambda p: p != ""), strip)
        return let(parts, lambda p: F.struct(
            F.lit(None).cast("int").alias("number"), F.get(p, 0).alias("name"),
            iso(french_date_in(T.text(get("date")))).alias("date"),
            house_fr(F.get(p, 1)).alias("house"), F.lit(None).cast("bigint").alias("debate_size"),
            F.lit(None).cast("string").alias("debate_url")))
    return lookup_steps("legislative_stages", T.find_all(name="h3"), {"date": (T.find_all(name="div"), True)}, one)


def last_stage_date(stages: Column, part: str) -> Column:
    """Date of the last dated stage whose name contains a word."""
    hits = F.filter(stages, lambda s: has(s["name"], part) & s["date"].isNotNull())
    return F.try_element_at(hits, F.lit(-1))["date"]


def _hearings() -> Column:
    heads = T.find_all(name="h6", string_re="Agenda et comptes-rendus des réunions")
    meetings = F.transform(heads, lambda h: T.find_all(T.sibling(h, name="div"), name="div", cls="reunion"))
    total = F.aggregate(meetings, F.lit(0), lambda a, m: a + F.when(m.isNull(), 0).otherwise(F.size(m)))
    return F.when(F.col("has_hearings"), total)


def _debate_steps() -> list[dict[str, Column]]:
    def one(a: Column, _: Column, get) -> Column:
        url = let(attr(a, "href"), lambda u: absolute_url(u, FRENCH_HOST, HTTP))
        return let(filled_lines(T.text(get("head"))), lambda ls: F.struct(
            url.alias("debate_url"), stage_name_fr(F.get(ls, 0)).alias("name"), house_fr(F.get(ls, 1)).alias("house")))
    links = T.find_all(name="a", title="Accéder au compte-rendu")
    return lookup_steps("debates", links, {"head": (T.find_all(name="h3"), False)}, one)


@once
def _one_page_steps() -> list[dict[str, Column]]:
    committees = distinct_by_name(
        F.transform(T.find_all(name="span", cls="commission"), lambda s: committee_fr(T.text(s))), "committee_name")
    elements = {
        "links": T.find_all(name="a", cls="link-examen-amendement"),
        "committees": let(committees, lambda cs: F.when(F.size(cs) > 0, cs)),
        "has_hearings": T.find(name="h6", string_re="Agenda et comptes-rendus des réunions").isNotNull(),
    }
    stages, some = F.col("legislative_stages"), F.size("links") > 0
    numbers = F.transform("links", lambda a: first_int(T.text(a)))
    fields = {
        "stages_count": F.size(stages),
        "date_introduction": last_stage_date(stages, "Dépôt"),
        "date_passing": last_stage_date(stages, "Promulgation"),
        "rejected": T.find(name="h4", string_re="Texte rejeté").isNotNull(),
        "withdrawn": T.find(name="h2", string_re="Retrait").isNotNull(),
        "committee_count": F.when(F.col("committees").isNotNull(), F.size("committees")),
        "committee_hearing_count": _hearings(),
        "amendment_count": F.when(some, F.aggregate(
            numbers, F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0)))),
        "amendment_links": F.when(some, F.transform("links", lambda a: attr(a, "href"))),
    }
    return [*_stage_steps(), *_debate_steps(), elements, fields]


def one_page_fields(pages: DataFrame) -> DataFrame:
    """Fields of the dossier shown as one page."""
    return staged(parsed(pages), _one_page_steps()).select(
        "url", "page_hash", "legislative_stages", "committees", "debates", *_one_page_steps()[-1])


def law_fields(pages: DataFrame) -> DataFrame:
    """Law text, its footers and what the text says it modifies."""
    texts = staged(parsed(pages), [{
        "law_text": T.text(T.find(name="ul", id="liste-sommaire")),
        "feet": T.texts_of(T.find_all(name="div", cls="summary-annexe"))}])
    step = texts.select("url", "page_hash", "law_text", F.when(F.size("feet") > 0, F.array_join("feet", "")).alias(
        "law_text_footer"))
    return modified_law_fields(step).withColumn(
        "law_size", F.when(F.col("law_text").isNotNull(), dense_length("law_text")))


def modified_law_fields(df: DataFrame) -> DataFrame:
    laws = modified_laws(F.nullif("law_text", F.lit("")), FR_MODIFIED_LAWS)
    return staged(df, [{"modified_laws": laws}]).withColumns({
        "original_law": F.when(F.col("modified_laws").isNotNull(), F.size("modified_laws") == 0),
        "modified_laws_count": F.when(F.size("modified_laws") > 0, F.size("modified_laws")),
        "modified_laws": F.when(F.size("modified_laws") > 0, F.col("modified_laws")),
    })


def vote_fields(pages: DataFrame) -> DataFrame:
    whole = staged(parsed(pages), [{"t": F.array_join(T.texts, "")}])
    return whole.select(
        "url", "page_hash", *[c.cast("string").alias(n) for n, c in vote_counts_fr("t").items()])


LAW_COLUMNS = ["law_text", "law_text_footer", "law_size", "modified_laws", "modified_laws_count", "original_law"]
VOTE_COLUMNS = ["final_vote_for", "final_vote_against", "final_vote_abst"]


def late_pages(records_: DataFrame, pages: DataFrame) -> list[tuple[DataFrame, list[str]]]:
    """What law and vote pages that were stored after their dossier bring to records without them, as two patches."""
    def late(fields: DataFrame, lacking: str, columns: list[str]) -> tuple[DataFrame, list[str]]:
        due = records_.where(lacking).select("record_id", F.col("bill_page_url").alias("url"))
        return due.join(one_per_url(fields), "url").select("record_id", *columns), columns

    return [late(law_fields(pages_of(pages, "FRANCE", "law")), "law_text is null", LAW_COLUMNS),
            late(vote_fields(pages_of(pages, "FRANCE", "votes")), " and ".join(f"{c} is null" for c in VOTE_COLUMNS), VOTE_COLUMNS)]


def bill_text_fields(pages: DataFrame) -> DataFrame:
    """Text of the page a bill text link leads to, or the link to its PDF."""
    link = F.coalesce(T.find(name="a", string_re="Version PDF"), T.find(name="a", href_re=".pdf"))
    step = staged(parsed(pages), [{
        "block": F.nullif(text_block(), F.lit("")),
        "pdf": F.concat(F.lit(FRENCH_HOST), attr(link, "href")),
        "published": T.find(name="em", string_re="Document non encore publié").isNull()}])
    return step.select("url", "page_hash", F.when(F.col("published"), clean_text("block")).alias("page_text"),
                       F.when(F.col("published") & F.col("block").isNull(), F.col("pdf")).alias("pdf_url"))


def bill_texts(main: DataFrame, pages: DataFrame, doc_texts: DataFrame) -> DataFrame:
    """(url, bill_text_url, bill_text, bill_size): the page's text block, else the text of its PDF."""
    linked = one_per_url(bill_text_fields(pages_of(pages, "FRANCE", "bill"))).withColumnRenamed("url", "bill_text_url")
    joined = main.select("url", "bill_text_url").join(linked, "bill_text_url", "left")
    full = attach_texts(joined, "url", doc_texts, {"pdf_text": F.col("pdf_url")})
    text = F.coalesce("page_text", "pdf_text")
    return full.select("url", F.when(F.col("page_text").isNull() & F.col("pdf_text").isNotNull(), F.col("pdf_url"))
                       .otherwise(F.col("bill_text_url")).alias("bill_text_url"), text.alias("bill_text"),
                       F.when(text.isNotNull(), dense_length(text)).alias("bill_size"))


def impact_assessments(main: DataFrame, pages: DataFrame, doc_texts: DataFrame) -> DataFrame:
    """(url, ia_text_url, ia_text, ia_size, ia_date); an HTML link is tried as PDF first, as far as one is cached."""
    link = F.col("ia_link")
    pdf = F.when(F.endswith(link, F.lit(".pdf")), link).when(
        F.endswith(link, F.lit(".html")), F.regexp_replace(link, r"\.html", ".pdf"))
    asked = main.where(link.isNotNull()).select("url", "ia_link", absolute_url(pdf, FRENCH_HOST, HTTP).alias("pdf_url"))
    html = one_per_url(parsed(pages_of(pages, "FRANCE", "ia")).select(
        "url", "page_hash", clean_text(T.text(T.find(name="div", id="wysiwyg"))).alias("page_text")))
    known = cached_texts(doc_texts).select(F.col("clean_url").alias("pdf_url"), "extracted_text",
                                           F.lit(True).alias("cached"))
    full = (asked.join(known, "pdf_url", "left")
            .join(html.withColumnRenamed("url", "ia_link"), "ia_link", "left"))
    as_pdf = F.col("cached") | F.endswith(link, F.lit(".pdf"))
    picked = full.select("url", F.when(as_pdf, F.col("pdf_url")).otherwise(link).alias("ia_text_url"),
                         F.when(as_pdf, F.col("extracted_text")).otherwise(F.col("page_text")).alias("ia_text"), as_pdf)
    return picked.select("url", "ia_text_url", "ia_text",
                         F.when(F.col("ia_text").isNotNull(), dense_length("ia_text")).alias("ia_size"),
                         impact_date("ia_text").alias("ia_date"))


def debate_rows(one_page: DataFrame, pages: DataFrame) -> DataFrame:
    """(record_id, name, house, debate_size): debates a dossier links to, with the size of the stored debate page, measured where the page lies."""
    sizes = one_per_url(parsed(pages_of(pages, "FRANCE", "debate")).select(
        "url", "page_hash", dense_length(text_block()).alias("debate_size"))).withColumnRenamed("url", "debate_url")
    links = one_page.select(F.col("url").alias("record_id"), F.inline("debates"))
    return links.join(sizes, "debate_url")


def with_debates(one_page: DataFrame, pages: DataFrame) -> DataFrame:
    """One-page fields with debate sizes on the stages and in total.

    Sizes are summed per (dossier, stage, house) first; what reaches the dossier is one small list and the total, in one join.
    """
    by_stage = debate_rows(one_page, pages).groupBy("record_id", "name", "house").agg(F.sum("debate_size").alias("debate_size"))
    named = F.when(F.col("name").isNotNull() & F.col("house").isNotNull(), F.struct("name", "house", "debate_size"))
    per_url = by_stage.groupBy(F.col("record_id").alias("url")).agg(F.collect_list(named).alias("sizes"), F.sum("debate_size").alias("plenary_size"))
    stages = F.col("legislative_stages")

    def sized(s: Column, i: Column) -> Column:
        same = lambda o: (o["name"] == s["name"]) & (o["house"] == s["house"])
        first = ~F.exists(F.slice(stages, F.lit(1), i), same)
        size = F.get(F.filter(F.col("sizes"), same), 0)["debate_size"]
        return s.withField("debate_size", F.when(first, size))

    joined = one_page.join(per_url, "url", "left")
    return joined.withColumn("legislative_stages", F.when(F.size("sizes") > 0, F.transform(stages, sized)).otherwise(stages)).drop("sizes", "debates")


def originators(main: DataFrame, members: DataFrame) -> DataFrame:
    rows = main.select("url", F.posexplode("names").alias("pos", "originator_name"))
    item = F.struct(F.col("originator_name"), F.col("affiliation").alias("originator_affiliation"))
    return regroup(affiliations(rows, "originator_name", members), "url", "pos", item, "originators")


def status() -> Column:
    return (F.when(F.col("promulgated"), PASSED).when(F.col("rejected"), REJECTED)
            .when(F.col("withdrawn"), WITHDRAWN).otherwise(ONGOING))


COUNTED = ["bill_title", "origin_type", "date_introduction"]  # fields whose absence a run counts


def dossiers(pages: DataFrame, counts: Counts | None = None) -> DataFrame:
    """Fields of the main pages, one row per dossier: each becomes a record."""
    return one_per_url(observed(counts, "pages", main_fields(pages_of(pages, "FRANCE", "main")), absent(*COUNTED)))


def records(pages: DataFrame, doc_texts: DataFrame, members: DataFrame, counts: Counts | None = None, main: DataFrame | None = None) -> DataFrame:
    """One record per dossier from its main, one-page, law and votes pages. `main` are the `dossiers`, which may have record ids; they are written
    here where they are not given, as they are read four times."""
    main = materialise(dossiers(pages, counts), "dossiers") if main is None else main
    one_page = one_per_url(one_page_fields(pages_of(pages, "FRANCE", "one_page")))
    law = one_per_url(law_fields(pages_of(pages, "FRANCE", "law")))
    votes = one_per_url(vote_fields(pages_of(pages, "FRANCE", "votes")))
    joined = (main.drop("bill_text_url").join(with_debates(one_page, pages), "url", "left").join(law, "url", "left")
              .join(votes, "url", "left").join(bill_texts(main, pages, doc_texts), "url", "left")
              .join(impact_assessments(main, pages, doc_texts), "url", "left")
              .join(originators(main, members), "url", "left"))
    return joined.withColumn("bill_status", status()).withColumns({
        "bill_id": F.when(F.col("bill_status") == ONGOING, F.col("depot_id")),
        "bill_page_url": F.col("url"), "country": F.lit("FRANCE"),
    }).drop("url", "names", "promulgated", "rejected", "withdrawn", "depot_id", "ia_link")


def members(pages: DataFrame, house: str) -> DataFrame:
    """Name and affiliation from member pages `(page_id, html)`; only assembly members lose their courtesy title."""
    tree = parsed(pages)
    name = T.text(T.find(name="h1"))
    if house == "LOWER":
        name = clean_name(name)
        span = T.find(name="span", string_re="Rattachement au titre du financement de la vie politique")
        affiliation = strip(T.text(T.sibling(span, name="span")))
    else:
        info = T.text(T.sibling(T.find(name="h2", string_re="Informations"), name="ul"))
        affiliation = first_match(info, r"Parti politique \(rattachement financier\) : (.+)", 1)
    return tree.select(F.lit(house).alias("house"), F.col("page_id").cast("string").alias("page_id"),
                       name.alias("parsed_name"), affiliation.alias("parsed_affiliation"))


def listed_amendments(pages: DataFrame) -> DataFrame:
    """Rows of amendment list pages, all pages of a list: number, outcome, date and link to the details."""
    body = T.find(name="tbody", id="tbody-amendements-list")

    def row(tr: Column) -> Column:
        return let(T.texts_of(T.find_all(tr, name="td")), lambda cells: F.struct(
            strip(F.get(cells, 1)).alias("amendment_id"),
            iso(french_date(strip(F.get(cells, 7)))).alias("amendment_date"),
            outcome_fr_page(strip(F.get(cells, 5))).alias("amendment_outcome"),
            attr(tr, "data-href").alias("amendment_text_url")))

    rows = F.transform(T.find_all(body, name="tr"), row)
    return parsed(pages).select("url", F.inline(rows))


def amendment_details(pages: DataFrame) -> DataFrame:
    """Fields of amendment pages, one row per URL."""
    plain = F.get(F.filter(T.els, lambda e: (e.tag == "div") & attr(e, "class").isNull()), 0)

    def labelled(label: str) -> Column:
        return T.text(T.next(T.find(F.col("plain"), name="b", string_re=label), name="span"))

    bodies = T.find_all(name="div", cls="amendement-section-body")
    people = T.find_all(T.find(name="div", cls="acteur-list-embed"), name="li")
    step = staged(parsed(pages), [{"plain": plain, "body": F.get(bodies, 1)}])
    fields = step.select(
        "url", "page_hash", labelled("Stade de lecture").alias("amendment_stage_name"),
        labelled("Examiné par").alias("amendment_committee_name"),
        F.transform(people, lambda li: strip(T.text(li))).alias("amendment_originator"),
        strip(T.text(T.parent(F.col("body")))).alias("amendment_text"))
    sized = fields.withColumn("amendment_text_size",
                              F.when(F.col("amendment_text").isNotNull(), dense_length("amendment_text")))
    return one_per_url(sized)


def page_amendments(list_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Listed amendments with the details of their own pages where those are stored."""
    details = amendment_details(detail_pages).withColumnRenamed("url", "details_url")
    listed = listed_amendments(list_pages).withColumn(
        "details_url", F.concat(F.lit(FRENCH_HOST), F.col("amendment_text_url")))
    return listed.join(details, "details_url", "left").drop("details_url")


def law_types(pages: DataFrame) -> DataFrame:
    """(legislature, law_type, title) from index pages `(legislature, html)`."""
    heads = T.texts_of(T.find_all(name="p", attrs={"align": "justify"}))
    parts = F.filter(F.transform(heads, heading_parts), lambda p: p.isNotNull())
    return parsed(pages).select("legislature", F.inline(parts))


def submission_dates(elements: Column) -> Column:
    """Earliest submission date among elements, ISO."""
    dates = F.transform(elements, lambda e: french_date(T.text_in(e, FRENCH_SUBMISSION)))
    return iso(F.array_min(dates))


def with_repaired_links(records_: DataFrame, one_page: DataFrame) -> DataFrame:
    """Amendment links of records with amendments, read again from their dossier page."""
    links = one_page.select(F.col("url").alias("bill_page_url"), "amendment_links")
    due = records_.where("amendment_count > 0").select("record_id", "bill_page_url").join(links, "bill_page_url")
    return patch(records_, due, "record_id", ["amendment_links"])
