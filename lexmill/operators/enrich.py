"""Enrichment of records from other tables: affiliations, amendments, votes, topics, hearings, debates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.html import computed
from lexmill.functions.labels import PT_BILL_ID, bill_id_fr_file, names_plenary, outcome_fr_file
from lexmill.functions.text import (all_matches, dense_length, let, normalise_separators, reverse_words,
                                    split_names)
from lexmill.functions.urls import clean_url, part_after
from lexmill.functions.votes import vote_counts_de
from lexmill.operators.keyed import patch, pick_one, regroup
from lexmill.sources.text_cache import TextCache, one_per_clean_url

# --- texts by URL -------------------------------------------------------------------------------------------------

def cached_texts(doc_texts: DataFrame | TextCache) -> DataFrame:
    """Text cache as a lookup: one row per cleaned URL, the smallest url first; empty texts count as missing. A stored cache is that already,
    and its texts are not shuffled."""
    return doc_texts.texts() if isinstance(doc_texts, TextCache) else one_per_clean_url(doc_texts)


def with_text(df: DataFrame, url: str, doc_texts: DataFrame | TextCache, name: str = "extracted_text",
              derived: dict[str, Column] | None = None) -> DataFrame:
    """Adds the cached text of a URL column, NULL where there is none. Rows without a URL are dealt out by a hash of their own, not to one task.

    Columns derived from the text alone are computed on the cache, once per document and not once per reference.
    """
    texts = computed(cached_texts(doc_texts), derived or {}).withColumnRenamed("extracted_text", name)
    spread = F.concat(F.lit("#none "), F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("string"))  # no cleaned URL holds a #
    return df.withColumn("clean_url", F.coalesce(clean_url(url), spread)).join(texts, "clean_url", "left").drop("clean_url")


# --- people -------------------------------------------------------------------------------------------------------

def members_lookup(members: DataFrame, house: str) -> DataFrame:
    """Name to affiliation, one row per name: the smallest page id."""
    return pick_one(members.where(F.col("house") == house), "parsed_name", "page_id", ["parsed_affiliation"])


def affiliations(names: DataFrame, name: str, members: DataFrame) -> DataFrame:
    """Adds `affiliation` to a table of names: the senator's, else the assembly member's.

    The lookups carry no broadcast hint: whether they are small enough is decided from their size.
    """
    upper = members_lookup(members, "UPPER").select(F.col("parsed_name").alias(name),
                                                    F.col("parsed_affiliation").alias("_upper"))
    lower = members_lookup(members, "LOWER").select(F.col("parsed_name").alias(name),
                                                    F.col("parsed_affiliation").alias("_lower"))
    return (names.join(upper, name, "left").join(lower, name, "left")
            .withColumn("affiliation", F.coalesce("_upper", "_lower")).drop("_upper", "_lower"))


def with_originator_affiliations(records: DataFrame, members: DataFrame) -> DataFrame:
    """Records with the affiliation of each originator filled in."""
    rows = records.select("record_id", F.posexplode("originators").alias("pos", "o")).select(
        "record_id", "pos", F.col("o.originator_name").alias("originator_name"))
    item = F.struct(F.col("originator_name"), F.col("affiliation").alias("originator_affiliation"))
    filled = regroup(affiliations(rows, "originator_name", members), "record_id", "pos", item, "originators")
    return patch(records, filled, "record_id", ["originators"])


# --- amendments ---------------------------------------------------------------------------------------------------

def _pending(bills: DataFrame) -> DataFrame:
    return bills.where(F.col("amendments").isNull() | (F.size("amendments") == 0))


def matched_amendment_rows(bills: DataFrame, rows: DataFrame) -> DataFrame:
    """Amendment rows whose title is that of a bill still without amendments.

    Rows stay keyed by title. Pairing them with every bill of an equal title would square a frequent title; a bill's
    amendments are the rows of its title.
    """
    titles = _pending(bills).select("bill_title").where(F.col("bill_title").isNotNull())
    return rows.join(titles, "bill_title", "left_semi")


def with_amendment_counts(bills: DataFrame, rows: DataFrame) -> DataFrame:
    """Bills without amendments get the number of rows of their title, counted before the join."""
    counts = rows.groupBy("bill_title").agg(F.count(F.lit(1)).cast("int").alias("_found"))
    hit = F.col("amendments").isNull() | (F.size("amendments") == 0)
    return (bills.join(counts, "bill_title", "left")
            .withColumn("amendment_count", F.when(hit & F.col("_found").isNotNull(), F.col("_found"))
                        .otherwise(F.col("amendment_count"))).drop("_found").select(bills.columns))


def amendment_from_row() -> dict[str, Column]:
    """Fields of an amendment from a file row; authors are stored last name first, co-signers are not."""
    author = reverse_words(F.col("Auteur"))
    return {
        "amendment_id": F.col("Numéro de l'amendement"),
        "amendment_stage_name": F.col("Etape du texte"),
        "bill_id": bill_id_fr_file("Titre complet"),
        "amendment_originator": F.concat(F.array(author), F.coalesce(split_names("Cosignataire(s)"), F.array())),
        "first_author": author,
        "amendment_outcome": outcome_fr_file("Sort de l'amendement"),
    }


def file_amendments(bills: DataFrame, rows: DataFrame, members: DataFrame, doc_texts: DataFrame,
                    links: DataFrame) -> DataFrame:
    """Amendments of the bills lacking them, from file rows: one row each, keyed by bill title.

    `links` maps the amendment URL to what its page names: committee and URL of the text.
    """
    fields = amendment_from_row()
    base = matched_amendment_rows(bills, rows).select(
        "bill_title", F.col("URL Amendement").alias("amendment_page_link"),
        *[c.alias(name) for name, c in fields.items()])
    an = members_lookup(members, "LOWER").select(F.col("parsed_name").alias("first_author"),
                                                 F.col("parsed_affiliation").alias("amendment_originator_aff"))
    pages = pick_one(links, "amendment_page_link", "amendment_text_url",
                     ["amendment_committee_name", "amendment_text_url"])
    full = with_text(base.join(an, "first_author", "left").join(pages, "amendment_page_link", "left"),
                     "amendment_text_url", doc_texts, "amendment_text", {
                         "_size": dense_length("extracted_text"), "amendment_plenary": names_plenary("extracted_text")})
    size = F.when(F.col("amendment_text_url").isNotNull(), F.coalesce("_size", F.lit(0).cast("bigint")))
    return full.withColumn("amendment_text_size", size).drop("first_author", "_size")


def merge_amendment_pages(records: DataFrame, pages: DataFrame, fields: list[str]) -> DataFrame:
    """New fields from an amendment's own page replace the old ones; without a stored page the row stays.

    `pages` has one row per `amendment_page_link`.
    """
    rows = records.select("record_id", F.posexplode("amendments").alias("pos", "a"))
    marked = pages.select(F.col("amendment_page_link").alias("_link"), F.lit(True).alias("_hit"),
                          *[F.col(f).alias(f"_{f}") for f in fields])
    joined = rows.join(marked, F.col("a.amendment_page_link") == F.col("_link"), "left")
    item = F.col("a")
    for f in fields:
        item = item.withField(f, F.when(F.col("_hit"), F.col(f"_{f}")).otherwise(F.col(f"a.{f}")))
    merged = regroup(joined, "record_id", "pos", item, "amendments")
    return patch(records, merged, "record_id", ["amendments"])


def stage_number_of(stages: Column, name: Column) -> Column:
    """Number of the first stage of that name within the same record."""
    return F.get(F.filter(stages, lambda s: s["name"] == name), 0)["number"]


def with_amendment_stage_numbers(amendments: Column, stages: Column) -> Column:
    """Array of amendments with stage numbers; an amendment without a matching stage keeps its own."""
    return let(stages, lambda ss: F.transform(amendments, lambda a: a.withField(
        "amendment_stage_number",
        F.coalesce(stage_number_of(ss, a["amendment_stage_name"]), a["amendment_stage_number"]))))


# --- votes, topics, hearings --------------------------------------------------------------------------------------

VOTE_FIELDS = ["final_vote_for", "final_vote_against", "final_vote_abst", "final_votes_pdf_url"]


def votes_by_bill(vote_texts: DataFrame) -> DataFrame:
    """One vote per printed-matter id, from the greatest URL among the texts that hold a readable result."""
    parsed = computed(vote_texts, {"vote": vote_counts_de("extracted_text")})
    read = parsed.select(F.col("url").alias("final_votes_pdf_url"), "vote.final_version_printed_matter_id", "vote.counts.*")
    good = read.where("final_version_printed_matter_id is not null and final_vote_for is not null")
    row = F.max_by(F.struct(*VOTE_FIELDS), "final_votes_pdf_url").alias("row")
    return good.groupBy("final_version_printed_matter_id").agg(row).select("final_version_printed_matter_id", "row.*")


def _owner(records: DataFrame, key: str) -> DataFrame:
    return records.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("record_id").alias("record_id"))


def with_votes(records: DataFrame, vote_texts: DataFrame) -> DataFrame:
    key = "final_version_printed_matter_id"
    votes = votes_by_bill(vote_texts).join(_owner(records, key), key)
    as_text = [F.col(c).cast("string").alias(c) for c in VOTE_FIELDS]
    return patch(records, votes.select("record_id", *as_text), "record_id", VOTE_FIELDS)


def topic_changes(records: DataFrame, topics: DataFrame) -> tuple[DataFrame, list[str]]:
    """`topics(law_id, topic_no, topic)`: the last topic naming a law becomes the type of its bill; as a patch."""
    last = topics.groupBy("law_id").agg(F.max_by("topic", "topic_no").alias("bill_type"))
    return last.join(_owner(records, "law_id"), "law_id").select("record_id", "bill_type"), ["bill_type"]


def with_topics(records: DataFrame, topics: DataFrame) -> DataFrame:
    changes, columns = topic_changes(records, topics)
    return patch(records, changes, "record_id", columns)


def mentions(texts: DataFrame, column: str) -> DataFrame:
    """Occurrences of bill ids in meeting texts, (bill_id, count); every mention counts."""
    t = normalise_separators(column)
    kinds = [all_matches(t, rf"(?iu)(?:Proposta|Projeto) de Lei ({PT_BILL_ID})", 1)]
    found = texts.select(F.explode(F.concat(*kinds)).alias("bill_id"))
    return found.groupBy("bill_id").agg(F.count(F.lit(1)).alias("count"))


def hearing_changes(records: DataFrame, meeting_texts: DataFrame, column: str) -> tuple[DataFrame, list[str]]:
    owned = mentions(meeting_texts, column).join(_owner(records, "bill_id"), "bill_id")
    return owned.select("record_id", F.col("count").cast("int").alias("committee_hearing_count")), ["committee_hearing_count"]


def with_hearing_counts(records: DataFrame, meeting_texts: DataFrame, column: str) -> DataFrame:
    changes, columns = hearing_changes(records, meeting_texts, column)
    return patch(records, changes, "record_id", columns)


def by_url_suffix(links: DataFrame, documents: DataFrame, delimiter: str = "Fich=") -> DataFrame:
    """Links to stored documents sharing the part after the delimiter: an equi-join on the derived part."""
    stored = documents.withColumn("part", part_after("stored_url", delimiter)).where("part <> ''")
    one = pick_one(stored, "part", "stored_url", ["stored_url"])
    return links.withColumn("part", part_after("link_url", delimiter)).join(one, "part", "left").drop("part")


# --- debates ------------------------------------------------------------------------------------------------------

def stage_debate_sizes(debates: DataFrame, text: str) -> DataFrame:
    """Size per (record, stage name, house), summed before any join."""
    return debates.groupBy("record_id", "name", "house").agg(F.sum(dense_length(text)).alias("debate_size"))


def record_debate_sizes(debates: DataFrame, text: str) -> DataFrame:
    """Size per record; 0, not NULL, where debates exist without text."""
    return debates.groupBy("record_id").agg(F.sum(dense_length(text)).alias("plenary_size"))


def sized_stages(stages: DataFrame, debates: DataFrame, text: str) -> DataFrame:
    """Stage rows with the debates of their (record, name, house); of equal stages the first takes them."""
    keys = ["record_id", "name", "house"]
    firsts = stages.groupBy(*keys).agg(F.min("number").alias("number"))
    sizes = stage_debate_sizes(debates, text).join(firsts, keys).select(
        "record_id", "number", F.col("debate_size").alias("_size"))
    return (stages.join(sizes, ["record_id", "number"], "left")
            .withColumn("debate_size", F.coalesce("_size", "debate_size")).drop("_size").select(stages.columns))


# --- lists --------------------------------------------------------------------------------------------------------

def distinct_by_name(items: Column, name: str) -> Column:
    """First item of each name, in order."""
    def firsts(xs: Column) -> Column:
        names = F.array_distinct(F.transform(xs, lambda x: x[name]))
        return F.transform(names, lambda n: F.get(F.filter(xs, lambda x: x[name].eqNullSafe(n)), 0))

    return let(items, firsts)


def modified_law_ids(cells: DataFrame) -> DataFrame:
    """Distinct law ids per document from four-column tables headed FNA in the last column.

    `table_cells(url, page, table_no, row, col, text)`; only the last column of a proper table is joined, and the
    per-table facts are aggregated first.
    """
    table = ["url", "page", "table_no"]
    facts = cells.groupBy(*table).agg(
        F.max("col").alias("last"),
        F.max((F.col("row") == 0) & (F.col("col") == 3) & (F.col("text") == "FNA")).alias("headed"))
    proper = facts.where("last = 3 and headed").select(*table)
    ids = cells.where("col = 3 and row > 0 and text <> ''").join(proper, table, "left_semi")
    return ids.select("url", F.col("text").alias("law_id")).distinct()
