"""From stored pages to numbered, enriched records and their tables: one run per country.

A run reads the bill pages whose URL has no record yet, extracts records, numbers them after the stored ones and takes them through
the country's enrichments. It returns the country's whole snapshot, stored and new, as citations and lookups may touch either.
Records are written to the shared folder where they are numbered: extraction runs once, and ids never change again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.html import Tree, attr
from lexmill.functions.text import strip
from lexmill.functions.urls import absolute_url
from lexmill.operators import enrich
from lexmill.operators.citations import citation_changes, with_citation_rollup
from lexmill.operators.flatten import project
from lexmill.operators.idrange import IdRanges, high_water
from lexmill.operators.keyed import assign_record_ids, patch, patch_all, regroup, unseen
from lexmill.plans import france, germany, portugal, repair
from lexmill.plans.common import one_per_url, pages_of, parsed
from lexmill.plans.metrics import Counts, absent, observed
from lexmill.schema import AMENDMENT, RECORD_FIELDS
from lexmill.session import materialise

T = Tree()
PREFIXES = {"PORTUGAL": "PT", "FRANCE": "FR", "GERMANY": "DE"}
AMENDMENT_FIELDS = [f.split(":")[0] for f in AMENDMENT.removeprefix("struct<").replace("array<string>", "a").removesuffix(">").split(",")]


def _stored(pages: DataFrame, stored: DataFrame | None, country: str) -> DataFrame:
    """The country's records so far."""
    if stored is None:
        # A condition that never holds lets the optimizer leave out what only stored records need.
        return pages.sparkSession.range(1).where("false").select(*[F.lit(None).cast(t).alias(n) for n, t in RECORD_FIELDS.items()])
    return stored.where(F.col("country") == country).select(*RECORD_FIELDS)


def new_pages(pages: DataFrame, stored: DataFrame) -> DataFrame:
    """All pages but the bill pages that have a record. URLs alone meet those stored; pages meet the new URLs, and stay where they lie if these
    are few."""
    main, has_url = F.col("kind") == "main", F.col("url").isNotNull()
    known = stored.select(F.col("bill_page_url").alias("url"))
    if stored.isEmpty():
        return pages
    fresh = materialise(unseen(pages.where(main & has_url).select("url").distinct(), known, "url"), "urls")
    return pages.where(main & has_url).join(fresh, "url", "left_semi").select(*pages.columns).unionByName(pages.where(~main | ~has_url))


def numbered(found: DataFrame, stored: DataFrame, country: str, ids: IdRanges | None = None, batch: str = "", counts: Counts | None = None) -> DataFrame:
    """New records in the fixed columns, with ids above those stored for the country, unless `found` has ids. With `ids` their range is reserved for
    `batch`, so that ids of deleted records don't come back and batches at the same time don't meet."""
    if "record_id" in found.columns:
        return materialise(project(found, list(RECORD_FIELDS), RECORD_FIELDS).select([F.col(c).cast(t).alias(c) for c, t in RECORD_FIELDS.items()]), "records")
    plain = project(found, [c for c in RECORD_FIELDS if c != "record_id"], RECORD_FIELDS)
    plain = plain.select([F.col(c).cast(RECORD_FIELDS[c]).alias(c) for c in plain.columns])
    last = high_water(stored, PREFIXES[country])
    if ids is not None or counts is not None:  # what is counted is run once
        plain = materialise(observed(counts, "records", plain, absent("bill_id", "bill_text", "law_id")), "records")
    if ids is not None:
        last = ids.reserve(PREFIXES[country], batch, plain.count(), last) - 1
    return materialise(assign_record_ids(plain, "bill_page_url", PREFIXES[country], last).select(*RECORD_FIELDS), "records")


def with_modified_laws(records: DataFrame, cells: DataFrame) -> DataFrame:
    """Law ids of a record's table document, where it names one and no laws are known; in order, with their number."""
    laws = enrich.modified_law_ids(cells).groupBy("url").agg(F.array_sort(F.collect_set("law_id")).alias("modified_laws"))
    due = records.where("modified_laws_pdf_url is not null and modified_laws is null")
    found = due.select("record_id", F.col("modified_laws_pdf_url").alias("url")).join(laws, "url")
    return patch(records, found.select("record_id", "modified_laws", F.size("modified_laws").alias("modified_laws_count")),
                 "record_id", ["modified_laws", "modified_laws_count"])


def _amendment() -> F.Column:
    return F.struct(*AMENDMENT_FIELDS).cast(AMENDMENT)


def with_amendment_texts(records: DataFrame, doc_texts: DataFrame) -> DataFrame:
    rows = records.select("record_id", F.posexplode("amendments").alias("pos", "a")).select("record_id", "pos", "a.*")
    done = germany.amendment_texts(rows, doc_texts)
    return patch(records, regroup(done, "record_id", "pos", _amendment(), "amendments"), "record_id", ["amendments"])


def with_page_amendments(records: DataFrame, list_pages: DataFrame, detail_pages: DataFrame) -> DataFrame:
    """Amendments listed on the pages that a dossier links to, for records that count some and hold none."""
    due = records.where("amendments is null and amendment_count > 0")
    links = due.select("record_id", F.posexplode("amendment_links").alias("link_no", "link")).select(
        "record_id", "link_no", absolute_url(F.col("link"), france.FRENCH_HOST).alias("url"))
    rows = project(france.page_amendments(list_pages, detail_pages), ["url", *AMENDMENT_FIELDS])
    found = links.join(rows, "url").withColumn("place", F.struct("link_no", "amendment_id", "amendment_text_url"))
    return patch(records, regroup(found, "record_id", "place", _amendment(), "amendments"), "record_id", ["amendments"])


def amendment_page_links(pages: DataFrame) -> DataFrame:
    """(amendment_page_link, amendment_committee_name, amendment_text_url) that an amendment's own page names."""
    committee = strip(T.text(T.next(T.find(name="b", string_re="Examiné par"), name="a")))
    link = attr(T.parent(T.find(name="span", string="Version PDF")), "href")
    fields = parsed(pages).select("url", "page_hash", committee.alias("amendment_committee_name"),
                                  F.concat(F.lit(france.FRENCH_HOST), link).alias("amendment_text_url"))
    return one_per_url(fields).withColumnRenamed("url", "amendment_page_link")


def with_file_amendments(records: DataFrame, rows: DataFrame, members: DataFrame, doc_texts: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of amendment files on the bill of their title that lacks amendments; of several such bills the smallest id takes them.

    A title's rows meet on one record, as the record holds them; bills of equal titles are not paired with every row."""
    pending = records.where("bill_title is not null and (amendments is null or size(amendments) = 0)")
    owner = pending.groupBy("bill_title").agg(F.min("record_id").alias("record_id"))
    found = project(enrich.file_amendments(pending, rows, members, doc_texts, links), ["bill_title", *AMENDMENT_FIELDS]).join(owner, "bill_title")
    found = found.withColumn("place", F.struct("amendment_id", "amendment_page_link", "amendment_originator", "amendment_outcome"))
    packed = regroup(found, "record_id", "place", _amendment(), "amendments")
    return patch(records, packed.withColumn("amendment_count", F.size("amendments")), "record_id", ["amendments", "amendment_count"])


def portuguese(pages: DataFrame, doc_texts: DataFrame, topics: DataFrame, meetings: DataFrame, stored: DataFrame | None = None,
               ids: IdRanges | None = None, batch: str = "", counts: Counts | None = None) -> DataFrame:
    """Extraction with refilled amendments, law pages that come after their bill's, citations, topics as bill types, mentions in meetings.

    `topics(law_id, topic_no, topic)`, `meetings(text)`. The last three don't read what each other writes: they are one patch."""
    stored = _stored(pages, stored, "PORTUGAL")
    new, known = new_pages(pages, stored), None
    if ids is None and counts is None:  # the URLs alone are numbered, ahead of their records; else records are written before, as they are counted
        known = assign_record_ids(portugal.bill_urls(new), "url", PREFIXES["PORTUGAL"], high_water(stored, PREFIXES["PORTUGAL"]))
    found = numbered(portugal.records(new, doc_texts, counts, known), stored, "PORTUGAL", ids, batch, counts)
    late = portugal.late_laws(stored, pages, doc_texts)
    records = patch(stored.unionByName(found), late, "record_id", portugal.LAW_COLUMNS)
    changes = [citation_changes(records), enrich.topic_changes(records, topics), enrich.hearing_changes(records, meetings, "text")]
    return patch_all(records, changes, "record_id").select(*records.columns)


def french(pages: DataFrame, doc_texts: DataFrame, members: DataFrame, amendment_rows: DataFrame, stored: DataFrame | None = None,
           ids: IdRanges | None = None, batch: str = "", counts: Counts | None = None) -> DataFrame:
    """Extraction, law and vote pages that come after their dossier, amendments from list pages (kinds `amendments`, `amendment`), then from files (pages of kind `amendment_page`),
    citations."""
    stored = _stored(pages, stored, "FRANCE")
    new = new_pages(pages, stored)
    main = materialise(france.dossiers(new, counts), "dossiers")
    if ids is None and counts is None:  # dossiers are numbered ahead of their records, which are then made once; else records are counted before
        known = assign_record_ids(main.select("url").where("url is not null"), "url", PREFIXES["FRANCE"], high_water(stored, PREFIXES["FRANCE"]))
        main = main.join(known, "url")
    found = numbered(france.records(new, doc_texts, members, main=main), stored, "FRANCE", ids, batch, counts)
    stored = patch_all(stored, france.late_pages(stored, pages), "record_id").select(*stored.columns)
    records = with_page_amendments(stored.unionByName(found), pages_of(pages, "FRANCE", "amendments"), pages_of(pages, "FRANCE", "amendment"))
    links = amendment_page_links(pages_of(pages, "FRANCE", "amendment_page"))
    return with_citation_rollup(with_file_amendments(materialise(records, "records"), amendment_rows, members, doc_texts, links))


def german(pages: DataFrame, doc_texts: DataFrame, cells: DataFrame, vote_texts: DataFrame, stored: DataFrame | None = None,
           ids: IdRanges | None = None, batch: str = "", counts: Counts | None = None) -> DataFrame:
    """Extraction, laws from table documents, citations, amendment pages (kind `amendment`) with texts and houses, votes, debate
    sizes of stages."""
    stored = _stored(pages, stored, "GERMANY")
    found = numbered(germany.records(new_pages(pages, stored), doc_texts, counts), stored, "GERMANY", ids, batch, counts)
    records = with_citation_rollup(with_modified_laws(stored.unionByName(found), cells))
    own_pages = germany.amendment_page_fields(pages_of(pages, "GERMANY", "amendment"))
    records = enrich.merge_amendment_pages(records, own_pages, germany.AMENDMENT_PAGE_FIELDS)
    records = materialise(repair.amendment_houses(with_amendment_texts(records, doc_texts)), "records")
    return germany.with_stage_debate_sizes(enrich.with_votes(records, vote_texts), doc_texts)
