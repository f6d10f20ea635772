"""Portuguese bill pages to record fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.dates import entry_into_force, iso, portuguese_iso
from lexmill.functions.html import Tree, attr, nearest
from lexmill.functions.labels import (EXPIRED, ONGOING, PASSED, PT_LAW_MENTION, PT_MODIFIED_LAWS, REJECTED,
                                      bill_id_pt, law_id_pt, modified_laws, origin_pt, originator_pt, party, title_pt)
from lexmill.functions.text import dense_length, let, once, strip
from lexmill.functions.urls import PORTUGUESE_HOST
from lexmill.functions.votes import PT_VOTE_MENTION, vote_parties
from lexmill.operators.enrich import with_text
from lexmill.plans.common import attach_texts, keyed_by_url, lookup_steps, one_per_url, pages_of, parsed, staged, url_key
from lexmill.plans.metrics import Counts, absent, observed
from lexmill.schema import AMENDMENT

# Labels of the pages.
PDF = "[formato PDF]"
PUBLISHED = "Lei (Publicação DR)"
IMPACT_TITLE = "Avaliação Prévia de Impacto de Género"

T = Tree(known=("span", "a", "b"))
PLAIN = Tree()  # for pages with few look-ups


def stage_date(stages: Column, test) -> Column:
    return F.get(F.filter(stages, test), 0)["date"]


def _named(name: str):
    return lambda s: s["name"] == name


def _containing(part: str):
    return lambda s: F.contains(s["name"], F.lit(part))


def _stage_steps() -> list[dict[str, Column]]:
    spans = T.find_all(name="span", string_re=r"^\d\d\d\d-\d\d-\d\d$")
    return lookup_steps("legislative_stages", spans, {"name": (T.find_all(name="span"), True)}, lambda s, i, get: F.struct(
        F.lit(None).cast("int").alias("number"), T.text(get("name")).alias("name"),
        iso(portuguese_iso(T.string(s))).alias("date"), F.lit(None).cast("string").alias("house"),
        F.lit(None).cast("bigint").alias("debate_size"), F.lit(None).cast("string").alias("debate_url")))


def _hearing_steps() -> list[dict[str, Column]]:
    """Mentions of hearings whose nearest heading before asks for opinions."""
    places = nearest(F.col("_mentions"), lambda p: p + 1, F.col("_headings"), lambda e: e.pos, False)
    asked = F.filter(F.col("_mentions"), lambda p, i: strip(T.text(F.get(F.col("_headings"), F.get(
        F.col("_heading_at"), i)))) == "Pedidos parecer a")
    return [{"_mentions": T.text_nodes("Audição|Audiência"), "_headings": T.find_all(name="div", cls="Titulo-Cinzento")},
            {"_heading_at": places},
            {"committee_hearing_count_external": F.when(F.size("_mentions") > 0, F.size(asked))}]


def _amendment_steps() -> list[dict[str, Column]]:
    """Amendments named on the page. All share the vote in committee, which is looked up once from the page start."""
    empty = F.from_json(F.lit("{}"), AMENDMENT)

    def one(label: Column, _: Column, get) -> Column:
        origin = let(party(T.text(get("origin"))), lambda o: F.when(o.isNotNull(), F.array(o)))
        return (empty.withField("amendment_originator", origin)
                .withField("amendment_text_url", attr(get("link"), "href"))
                .withField("amendment_outcome", F.when(F.col("special_passed").isNotNull(), F.lit("APPROVED")))
                .withField("amendment_vote_for", F.col("special_votes.vote_for"))
                .withField("amendment_vote_against", F.col("special_votes.vote_against"))
                .withField("amendment_vote_abst", F.col("special_votes.vote_abst")))

    labels = T.find_all(name="span", string="Admissão Proposta de Alteração")
    return lookup_steps("named_amendments", labels, {"origin": (T.find_all(name="span"), True),
                                                     "link": (T.find_all(name="a", href_re=r"\.pdf"), True)}, one)


@once
def _main_steps() -> list[dict[str, Column]]:
    """Elements of the page, what is read around them, and the fields, each step using the one before."""
    elements = {
        "head_text": T.text(T.find(name="span", cls="Titulo-Cinzento")),
        "title_el": T.parent(T.find(name="span", title="Detalhe do documento")),
        "report_el": T.find(name="div", string_re="(?iu)Parecer da Comissão"),
        "impact_el": T.find(name="span", string_re="A. I. G.|A.I.G."),
        "published_el": T.find(name="span", string=PUBLISHED),
        "final_el": T.find(name="span", string="Votação final global"),
        "special_el": T.find(name="span", string="Votação na especialidade"),
        "rejected_el": T.last(name="b", string="Rejeitado"),
        "expired_el": T.find(name="span", string="Iniciativa Caducada"),
    }
    special_div = T.next(F.col("special_el"), name="span", string_re="alteração")
    stages = F.col("legislative_stages")
    late = T.line(F.col("rejected_el")) > F.col("page_lines") * 0.65
    around = {
        "bill_id": bill_id_pt("head_text"),
        "impact_link": T.sibling(F.col("impact_el"), name="a", string=PDF),
        "final_votes": vote_parties(T.text(T.parent(T.holder(T.next_text(F.col("final_el"), PT_VOTE_MENTION)), 2))),
        "rejection_votes": F.when(F.col("published_el").isNull() & late, vote_parties(T.text(
            T.holder(T.next_text(F.col("rejected_el"), PT_VOTE_MENTION))))),
        "special_passed": T.next(F.col("special_el"), name="b", string="Aprovado"),
        "special_votes": vote_parties(T.text(T.holder(T.next_text(special_div, "Favor")))),
        "date_passing": stage_date(stages, _named(PUBLISHED)),
    }
    votes = F.coalesce(F.col("rejection_votes"), F.col("final_votes"))
    rejected = late & F.col("date_passing").isNull()
    committees = T.find_all(name="span", string_re="(?iu)^comissão de|^comissao de")
    names = F.array_sort(F.array_distinct(T.texts_of(committees)))
    fields = {
        "origin_type": origin_pt(strip(F.replace(F.col("head_text"), F.col("bill_id"), F.lit("")))),
        "bill_title": title_pt(T.text(F.col("title_el"))),
        "originators": F.transform(T.find_all(name="a", title="Detalhe do autor"), lambda a: originator_pt(T.text(a))),
        "committees": F.transform(names, lambda n: F.struct(
            n.alias("committee_name"), F.lit(None).cast("string").alias("committee_role"),
            F.lit(None).cast("string").alias("committee_date"))),
        "committee_count": F.size(names),
        "report_url": attr(T.next(F.col("report_el"), name="a", href_re=r"\.pdf"), "href"),
        "bill_text_url": attr(T.find(name="a", string=PDF), "href"),
        "stages_count": F.size(stages),
        "date_introduction": stage_date(stages, _named("Entrada")),
        "date_committee": F.coalesce(stage_date(stages, _containing("comissão distribuição")),
                                     stage_date(stages, _containing("comissão"))),
        "amendments": F.when(F.size("named_amendments") > 0, F.col("named_amendments")),
        "final_vote_for": votes.vote_for, "final_vote_against": votes.vote_against, "final_vote_abst": votes.vote_abst,
        "ia_dummy": F.col("impact_link").isNotNull(),
        "ia_text_url": attr(F.col("impact_link"), "href"),
        "ia_title": F.when(F.col("impact_link").isNotNull(), IMPACT_TITLE),
        "bill_status": F.when(F.col("published_el").isNotNull(), PASSED).when(rejected, REJECTED)
        .when(F.col("expired_el").isNotNull(), EXPIRED).otherwise(ONGOING),
        "law_page_url": F.concat(F.lit(PORTUGUESE_HOST), attr(
            T.next(F.col("published_el"), name="a", href_re="DetalheDiplomaAprovado.aspx"), "href")),
    }
    return [*T.string_steps(), *_stage_steps(), elements, around, *_hearing_steps(), *_amendment_steps(), fields]


def main_fields(pages: DataFrame) -> DataFrame:
    """Fields of the bill page alone. `pages(url, html)`; narrow."""
    return staged(parsed(pages), _main_steps()).select("url", "page_hash", *MAIN_FIELDS)


MAIN_FIELDS = ["bill_id", "origin_type", "bill_title", "originators", "committees", "committee_count", "report_url",
               "bill_text_url", "legislative_stages", "stages_count", "date_introduction", "date_committee",
               "date_passing", "committee_hearing_count_external", "amendments", "final_vote_for",
               "final_vote_against", "final_vote_abst", "ia_dummy", "ia_text_url", "ia_title", "bill_status",
               "law_page_url"]


def law_fields(pages: DataFrame) -> DataFrame:
    """Law id and text URL of law pages."""
    heading = PLAIN.find(name="div", cls="Titulo-Cinzento")
    link = PLAIN.sibling(PLAIN.find(name="span", string_re="Ver texto"), name="a", string=PDF)
    return parsed(pages).select("url", "page_hash", law_id_pt(PLAIN.text(PLAIN.find(heading, name="span"))).alias("law_id"),
                                attr(link, "href").alias("law_text_url"))


def law_variables(df: DataFrame) -> DataFrame:
    """What follows from the law text: sizes, modified laws, entry into force."""
    laws = modified_laws("law_text", PT_MODIFIED_LAWS)
    published = F.to_date("date_passing")
    has_law = F.col("has_law")
    return df.withColumns({
        "modified_laws": F.when(F.size(laws) > 0, laws),
        "law_size": F.when(F.col("law_text_url").isNotNull(), dense_length("law_text")),
    }).withColumns({
        "modified_laws_count": F.when(F.col("modified_laws").isNotNull(), F.size("modified_laws")),
        "original_law": F.when(has_law, F.col("modified_laws").isNull()),
        "date_entering_into_force": F.when(has_law, entry_into_force("law_text", published)),
        "bill_status": F.when(has_law, PASSED).otherwise(F.col("bill_status")),
    })


COUNTED = ["bill_id", "bill_title", "origin_type", "date_introduction", "bill_text_url"]  # fields whose absence a run counts


def bill_urls(pages: DataFrame) -> DataFrame:
    """(url) of the bill pages, each once: one per record."""
    return pages_of(pages, "PORTUGAL", "main").select("url").where("url is not null").distinct()


def records(pages: DataFrame, doc_texts: DataFrame, counts: Counts | None = None, ids: DataFrame | None = None) -> DataFrame:
    """One record per bill page, with texts from the cache and the law page stored for its URL (kind `law`).

    `ids(url, record_id)`, one row per URL: only records of these URLs, with their ids. A record lies by its URL from its page on; law page, id and
    texts come to it."""
    main = keyed_by_url(observed(counts, "pages", main_fields(pages_of(pages, "PORTUGAL", "main")), absent(*COUNTED)))
    law = keyed_by_url(law_fields(pages_of(pages, "PORTUGAL", "law"))).where("url_key <> ''").drop("url").withColumn("has_law", F.lit(True))
    both = main.join(law, "url_key", "left").withColumn("has_law", F.coalesce("has_law", F.lit(False)))
    if ids is not None:
        both = both.join(ids.select(url_key(F.col("url")).alias("url_key"), "record_id"), "url_key")
    full = attach_texts(both, "url_key", doc_texts, {
        "bill_text": F.col("bill_text_url"), "ia_text": F.col("ia_text_url"),
        "law_text": F.col("law_text_url")},
        {"amendment_texts": F.transform("amendments", lambda a: a["amendment_text_url"])},
        {"committees_depth": F.array("report_url")})
    amendments = let(F.col("amendment_texts"), lambda texts: F.transform("amendments", lambda a, i: a.withField(
        "amendment_text", F.get(texts, i)).withField(
        "amendment_text_size", F.when(F.get(texts, i).isNotNull(), dense_length(F.get(texts, i))))))
    return law_variables(full).withColumns({
        "amendments": amendments,
        "amendment_count": F.when(F.size("amendments") > 0, F.size("amendments")),
        "bill_size": F.when(F.col("bill_text_url").isNotNull(), dense_length("bill_text")),
        "ia_size": F.when(F.col("ia_text_url").isNotNull(), dense_length("ia_text")),
        "bill_page_url": F.col("url"), "country": F.lit("PORTUGAL"),
    }).drop("url", "url_key", "amendment_texts", "report_url", "law_page_url", "has_law")


LAW_COLUMNS = ["law_id", "law_text_url", "law_text", "law_size", "modified_laws", "modified_laws_count", "original_law",
               "date_entering_into_force", "bill_status"]


def with_law(records_: DataFrame, laws: DataFrame, doc_texts: DataFrame) -> DataFrame:
    """(record_id, LAW_COLUMNS): what law pages bring to stored records that have no law yet. `laws(url, law_id, law_text_url)`, one per URL; a
    page may come long after its bill's."""
    due = records_.where("law_id is null").select("record_id", F.col("bill_page_url").alias("url"), "date_passing", "bill_status")
    found = due.join(laws, "url").withColumn("has_law", F.lit(True))
    return law_variables(with_text(found, "law_text_url", doc_texts, "law_text")).select("record_id", *LAW_COLUMNS)


def late_laws(records_: DataFrame, pages: DataFrame, doc_texts: DataFrame) -> DataFrame:
    return with_law(records_, one_per_url(law_fields(pages_of(pages, "PORTUGAL", "law"))), doc_texts)


def topic_laws(pages: DataFrame) -> DataFrame:
    """(law_id, topic_no, topic) from topic pages `(topic_no, topic, html)`."""
    links = PLAIN.find_all(name="a", string_re=PT_LAW_MENTION)
    tree = parsed(pages.withColumn("url", F.col("topic")))
    return tree.select(F.explode(F.transform(links, lambda a: law_id_pt(PLAIN.text(a)))).alias("law_id"),
                       "topic_no", "topic")


