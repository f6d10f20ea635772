"""Sources, sinks, projections, filters, joins, aggregations, windows, limits and sets on records."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions.dates import iso, parse_any
from lexmill.functions.html import computed
from lexmill.functions.labels import is_status
from lexmill.functions.text import all_matches, head_lines
from lexmill.operators import citations, enrich, flatten, keyed
from lexmill.schema import EXPORT_COLUMNS, RECORD_FIELDS
from lexmill.session import new_path
from lexmill.sources import sinks, tables
from queries.inputs import (AMENDMENT_ROWS, DEBATES, DOC_TEXTS, MEMBERS, RECORDS, TITLED, amendment_rows, debates,
                            doc_texts, joined, members, page_rows, records, titled_bills, with_sql)
from queries.registry import query, table

REC = with_sql(RECORDS)


def sql_list(expr: str, item: str = "x", sep: str = ";") -> str:
    return f"array_to_string(list_transform({expr}, lambda x: coalesce({item}, '-')), '{sep}')"


def sql_dense(expr: str) -> str:
    from queries.inputs import SPACE
    return f"coalesce(length(regexp_replace({expr}, '[{SPACE}]', '', 'g')), 0)"


# --- sources and sinks --------------------------------------------------------------------------------------------

@query("S1_scan_pages", "SELECT page_id, url, length(html) AS n FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", "url", F.length("html").cast("long").alias("n"))


@query("S2_scan_records", REC + "SELECT record_id, bill_title FROM records WHERE bill_status = 'PASS'")
def _(spark, d):
    return records(spark, d).where("bill_status = 'PASS'").select("record_id", "bill_title")


@query("S3_scan_documents", with_sql(DOC_TEXTS) + "SELECT url, size FROM doc_texts WHERE collection = 'src1'")
def _(spark, d):
    path = new_path(spark, "doc_texts")
    doc_texts(spark, d).write.parquet(path)
    return tables.read_doc_texts(spark, path, "src1").select("url", "size")


ROWS_PER_SHARE = 500_000  # of all files' rows; a file is read by one task


@query("S4_amendment_files", with_sql(AMENDMENT_ROWS) + """
    SELECT amendment_file_id, 'https://files.example.org/' || amendment_file_id AS amendment_file_url,
      'Title of ' || amendment_file_id AS bill_title, "Numéro de l'amendement" AS number, "Etape du texte" AS stage,
      "Auteur" AS author, nullif("Cosignataire(s)", '') AS signers, "Sort de l'amendement" AS outcome
    FROM amendment_rows""")
def _(spark, d):
    path = new_path(spark, "amendment_files")
    rows = amendment_rows(spark, d).drop("bill_title")
    # The more rows there are, the more files an id has.
    shares = max(1, -(-rows.count() // ROWS_PER_SHARE))
    share = F.pmod(F.xxhash64("Numéro de l'amendement"), F.lit(shares))
    (rows.repartition(max(spark.sparkContext.defaultParallelism, shares), "amendment_file_id", share).write.partitionBy("amendment_file_id")
     .options(**sinks.WRITE_OPTIONS, sep=";").csv(path))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    file_id = F.regexp_extract("path", "amendment_file_id=([^/]+)/", 1)
    manifest = files.select(F.col("path").alias("file_path"), file_id.alias("amendment_file_id")).withColumns({
        "amendment_file_url": F.concat(F.lit("https://files.example.org/"), "amendment_file_id"),
        "bill_title": F.concat(F.lit("Title of "), "amendment_file_id")})
    return tables.read_amendment_files(spark, f"{path}/*", manifest).select(
        "amendment_file_id", "amendment_file_url", "bill_title", F.col("Numéro de l'amendement").alias("number"),
        F.col("Etape du texte").alias("stage"), F.col("Auteur").alias("author"),
        F.col("Cosignataire(s)").alias("signers"), F.col("Sort de l'amendement").alias("outcome"))


@query("S5_text_cache", with_sql(RECORDS, DOC_TEXTS) + """
    , cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t FROM doc_texts)
    SELECT record_id, md5(t) AS text_md5 FROM records LEFT JOIN cache ON u = split_part(bill_text_url, '#', 1)""")
def _(spark, d):
    found = enrich.with_text(records(spark, d).select("record_id", "bill_text_url"), "bill_text_url",
                             doc_texts(spark, d).withColumn("extracted_text", F.col("extracted_text")))
    return found.select("record_id", F.md5("extracted_text").alias("text_md5"))


@query("S6_append", REC + "SELECT record_id, country, law_id FROM records UNION ALL "
       "SELECT record_id || 'b', country, law_id FROM records WHERE bill_status = 'PASS'")
def _(spark, d):
    path = new_path(spark, "records")
    rows = records(spark, d).select("record_id", "country", "law_id")
    sinks.append_records(rows, path)
    passed = records(spark, d).where("bill_status = 'PASS'")
    sinks.append_records(passed.select(F.concat("record_id", F.lit("b")).alias("record_id"), "country", "law_id"), path)
    return spark.read.schema("record_id string, law_id string, country string").parquet(path).select(
        "record_id", "country", "law_id")


@query("S7_patch", REC + """SELECT r.record_id, r.bill_id,
      CASE WHEN p.c_custkey IS NOT NULL THEN nullif(p.c_mktsegment, 'BUILDING') ELSE r.bill_type END AS bill_type
    FROM records r LEFT JOIN customer p ON r.record_id = 'R' || p.c_custkey""")
def _(spark, d):
    changes = table(spark, d, "customer").selectExpr(
        "'R' || c_custkey AS record_id", "nullif(c_mktsegment, 'BUILDING') AS bill_type")
    return keyed.patch(records(spark, d).select("record_id", "bill_id", "bill_type"), changes, "record_id",
                       ["bill_type"])


@query("S8_delete_duplicates", "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5 FROM documents GROUP BY text")
def _(spark, d):
    texts = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"), F.md5("text").alias("text_md5"))
    return keyed.keep_first(texts, "digest", "doc_id").drop("digest")


def _exported(name: str, sql: str, text_source: bool = False):
    columns = EXPORT_COLUMNS[name]

    def run(spark, d):
        path = new_path(spark, name)
        source = _documents_as_records(spark, d) if text_source else records(spark, d)
        sinks.write_table(flatten.export_table(source, name), path)
        return sinks.read_table(spark, path, columns)

    letters = dict(zip(EXPORT_COLUMNS, "abcdefghij"))
    order = ["originators", "committees", "modified_laws", "affecting_laws", "legislative_stages", "amendments",
             "bill_main_table", "bill_text", "law_text", "impact_assessments"]
    query(f"S9{letters[order[order.index(name)]]}_{name}", sql)(run)


def _documents_as_records(spark, d):
    return table(spark, d, "documents").selectExpr(
        "'D' || doc_id AS record_id", "text AS bill_text",
        "text AS law_text", "text AS ia_text", "n_chars AS ia_size",
        "'https://ia.example.org/' || doc_id AS ia_text_url")


def _unnested(array: str, fields: list[str]) -> str:
    cols = ", ".join(f"CAST(u.{f} AS VARCHAR) AS {f}" for f in fields)
    return REC + f"SELECT record_id, {cols} FROM (SELECT record_id, unnest({array}) AS u FROM records)"


_exported("originators", _unnested("originators", EXPORT_COLUMNS["originators"][1:]))
_exported("committees", _unnested("committees", EXPORT_COLUMNS["committees"][1:]))
_exported("legislative_stages", _unnested("legislative_stages", EXPORT_COLUMNS["legislative_stages"][1:]))
_exported("amendments", _unnested("amendments", EXPORT_COLUMNS["amendments"][1:]).replace(
    "CAST(u.amendment_originator AS VARCHAR)", "array_to_string(u.amendment_originator, '; ')"))

EDGES = with_sql(RECORDS) + """, edges AS (SELECT record_id, date_passing, unnest(modified_laws) AS law_id FROM records),
  owners AS (SELECT law_id, min(record_id) AS owner FROM records WHERE law_id IS NOT NULL GROUP BY law_id),
  dated AS (SELECT law_id, CAST(coalesce(try_strptime(date_passing, '%Y.%m.%d'), try_strptime(date_passing, '%Y-%m-%d'))
    AS DATE) AS d FROM edges),
  rollup_ AS (SELECT law_id, count(*) AS affecting_laws_count, strftime(min(d), '%Y-%m-%d') AS affecting_laws_first_date
    FROM dated GROUP BY law_id)
"""
_exported("modified_laws", EDGES + """SELECT record_id, e.law_id AS modified_law_id, owner AS modified_record_id
  FROM edges e LEFT JOIN owners o ON e.law_id = o.law_id""")
_exported("affecting_laws", EDGES + """SELECT owner AS record_id, r.law_id AS affecting_law_id,
  e.record_id AS affecting_record_id FROM edges e JOIN owners o ON e.law_id = o.law_id
  JOIN records r ON r.record_id = e.record_id""")
_MAIN = [c for c in EXPORT_COLUMNS["bill_main_table"]]
_exported("bill_main_table", REC + "SELECT " + ", ".join(
    f"CAST({c if f' AS {c}' in RECORDS else 'NULL'} AS VARCHAR) AS {c}" for c in _MAIN) + " FROM records")
_exported("bill_text", "SELECT 'D' || doc_id AS record_id, text AS bill_text FROM documents", True)
_exported("law_text", "SELECT 'D' || doc_id AS record_id, text AS law_text FROM documents", True)
_exported("impact_assessments", """SELECT 'D' || doc_id AS record_id, CAST(NULL AS VARCHAR) AS ia_title,
  'https://ia.example.org/' || doc_id AS ia_text_url, text AS ia_text, CAST(n_chars AS VARCHAR) AS ia_size,
  CAST(NULL AS VARCHAR) AS ia_size1, CAST(NULL AS VARCHAR) AS ia_size2, CAST(NULL AS VARCHAR) AS ia_text1,
  CAST(NULL AS VARCHAR) AS ia_text2, CAST(NULL AS VARCHAR) AS ia_date FROM documents""", True)


# --- projections and filters --------------------------------------------------------------------------------------

@query("P1_explode_structs", REC + """SELECT record_id, u.committee_name AS committee_name,
    u.committee_role AS committee_role FROM (SELECT record_id, unnest(committees) AS u FROM records)""")
def _(spark, d):
    return flatten.unnest(records(spark, d), "committees", ["record_id", "committee_name", "committee_role"])


@query("P2_explode_scalars", REC + "SELECT record_id, unnest(modified_laws) AS law FROM records")
def _(spark, d):
    return records(spark, d).select("record_id", F.explode("modified_laws").alias("law"))


@query("P3_fixed_columns", REC + """SELECT record_id, CAST(NULL AS VARCHAR) AS law_text, CAST(NULL AS BIGINT) AS ia_size,
    stages_count FROM records""")
def _(spark, d):
    return flatten.project(records(spark, d), ["record_id", "law_text", "ia_size", "stages_count"], RECORD_FIELDS)


@query("F1_bill_types", "SELECT p_partkey, trim(p_type) AS p_type FROM part WHERE trim(p_type) IN ('ECONOMY', 'SMALL')")
def _(spark, d):
    return table(spark, d, "part").where(F.trim("p_type").isin("ECONOMY", "SMALL")).select(
        "p_partkey", F.trim("p_type").alias("p_type"))


@query("F2_work_list", REC + "SELECT record_id FROM records WHERE law_id IS NOT NULL AND bill_type IS NULL")
def _(spark, d):
    return keyed.work_list(records(spark, d), "law_id", "bill_type").select("record_id")


@query("F3_null_and_empty", REC + """SELECT record_id, modified_laws IS NULL AS none, coalesce(len(modified_laws) > 0, false)
    AS filled FROM records WHERE committee_hearing_count IS NOT NULL""")
def _(spark, d):
    return records(spark, d).where(F.col("committee_hearing_count").isNotNull()).select(
        "record_id", F.col("modified_laws").isNull().alias("none"),
        F.coalesce(F.size("modified_laws") > 0, F.lit(False)).alias("filled"))


@query("F4_threshold", REC + "SELECT record_id, stages_count FROM records WHERE stages_count > 3")
def _(spark, d):
    return records(spark, d).where("stages_count > 3").select("record_id", "stages_count")


@query("F5_and_or", REC + """SELECT record_id FROM records
    WHERE (ia_text1 IS NOT NULL OR ia_text2 IS NOT NULL) AND ia_date IS NULL""")
def _(spark, d):
    some = F.col("ia_text1").isNotNull() | F.col("ia_text2").isNotNull()
    return records(spark, d).where(some & F.col("ia_date").isNull()).select("record_id")


@query("F6_url_predicates", """SELECT page_id, regexp_matches(url, 'page=\\d+') AS paged, contains(url, '/fr/') AS french,
    starts_with(url, 'https') AS secure, ends_with(url, '#top') AS anchored FROM pages WHERE starts_with(url, 'http')""")
def _(spark, d):
    url = F.col("url")
    return table(spark, d, "pages").where(url.startswith("http")).select(
        "page_id", url.rlike(r"page=\d+").alias("paged"), url.contains("/fr/").alias("french"),
        url.startswith("https").alias("secure"), url.endswith("#top").alias("anchored"))


@query("F7_exact_value", REC + "SELECT record_id FROM records WHERE bill_status = 'ONGOING'")
def _(spark, d):
    df = records(spark, d)
    return df.where(is_status("bill_status") & (F.col("bill_status") == "ONGOING")).select("record_id")


@query("F8_array_filter", REC + f"""SELECT record_id, {sql_list(
    "list_filter(legislative_stages, lambda s: s.debate_url IS NOT NULL AND s.debate_size IS NULL)", "x.debate_url")}
    AS urls FROM records""")
def _(spark, d):
    due = F.filter("legislative_stages", lambda s: s["debate_url"].isNotNull() & s["debate_size"].isNull())
    return records(spark, d).select("record_id", joined(F.transform(due, lambda s: s["debate_url"])).alias("urls"))


@query("F9_skip_set", """SELECT page_id FROM pages WHERE NOT regexp_matches(url, '/de/|/es/')
    AND split_part(url, '/', 3) NOT LIKE 'm.%'""")
def _(spark, d):
    return table(spark, d, "pages").where(~F.col("url").rlike("/de/|/es/") & ~F.split("url", "/")[2].startswith(
        "m.")).select("page_id")


# --- joins --------------------------------------------------------------------------------------------------------

@query("J1_unseen", """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def _(spark, d):
    stored = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return keyed.unseen(table(spark, d, "orders"), stored, "o_orderkey").select("o_orderkey")


LOOKUPS = with_sql(RECORDS, MEMBERS) + """,
  upper_ AS (SELECT parsed_name AS n, arg_min(coalesce(parsed_affiliation, ''), page_id) AS a FROM members
    WHERE house = 'UPPER' GROUP BY 1),
  lower_ AS (SELECT parsed_name AS n, arg_min(parsed_affiliation, page_id) AS a FROM members
    WHERE house = 'LOWER' GROUP BY 1)
"""


@query("J2_originator_affiliation", LOOKUPS + """, o AS (SELECT record_id, unnest(originators) AS u,
    generate_subscripts(originators, 1) AS pos FROM records),
  f AS (SELECT record_id, pos, u.originator_name || '=' || coalesce(nullif(upper_.a, ''), lower_.a, '-') AS t FROM o
    LEFT JOIN upper_ ON upper_.n = u.originator_name LEFT JOIN lower_ ON lower_.n = u.originator_name)
  SELECT record_id, string_agg(t, ';' ORDER BY pos) AS originators FROM f GROUP BY record_id""")
def _(spark, d):
    full = enrich.with_originator_affiliations(records(spark, d).select("record_id", "originators"), members(spark, d))
    text = joined(F.transform("originators", lambda o: F.concat(
        o["originator_name"], F.lit("="), F.coalesce(o["originator_affiliation"], F.lit("-")))))
    return full.where(F.size("originators") > 0).select("record_id", text.alias("originators"))


@query("J3_modified_law_record", EDGES + """SELECT record_id, e.law_id AS modified_law_id, owner AS modified_record_id
  FROM edges e LEFT JOIN owners o ON e.law_id = o.law_id""")
def _(spark, d):
    return citations.modified_laws_table(records(spark, d))


@query("J4_affecting_law_id", EDGES + """SELECT owner AS record_id, r.law_id AS affecting_law_id,
  e.record_id AS affecting_record_id FROM edges e JOIN owners o ON e.law_id = o.law_id
  JOIN records r ON r.record_id = e.record_id""")
def _(spark, d):
    return citations.affecting_laws_table(records(spark, d))


@query("J5_amendments_of_bill", with_sql(TITLED, AMENDMENT_ROWS) + """, counts AS
    (SELECT bill_title, count(*) AS n FROM amendment_rows GROUP BY 1)
  SELECT record_id, CAST(CASE WHEN (amendments IS NULL OR len(amendments) = 0) AND n IS NOT NULL THEN n
    ELSE amendment_count END AS INTEGER) AS amendment_count FROM titled LEFT JOIN counts USING (bill_title)""")
def _(spark, d):
    return enrich.with_amendment_counts(titled_bills(spark, d), amendment_rows(spark, d)).select(
        "record_id", "amendment_count")


@query("J5_matched_rows", with_sql(TITLED, AMENDMENT_ROWS) + """SELECT bill_title, "Numéro de l'amendement" AS number
  FROM amendment_rows WHERE bill_title IN (SELECT bill_title FROM titled WHERE amendments IS NULL OR len(amendments) = 0)
  """)
def _(spark, d):
    return enrich.matched_amendment_rows(titled_bills(spark, d), amendment_rows(spark, d)).select(
        "bill_title", F.col("Numéro de l'amendement").alias("number"))


@query("J6_first_author_affiliation", with_sql(AMENDMENT_ROWS, MEMBERS) + """,
  lower_ AS (SELECT parsed_name AS n, arg_min(parsed_affiliation, page_id) AS a FROM members
    WHERE house = 'LOWER' GROUP BY 1)
  SELECT "Numéro de l'amendement" AS number, n AS name, a AS affiliation FROM (SELECT *,
    split_part("Auteur", ' ', 2) || ' ' || split_part("Auteur", ' ', 1) AS name FROM amendment_rows)
  JOIN lower_ ON n = name""")
def _(spark, d):
    rows = amendment_rows(spark, d).select(
        F.col("Numéro de l'amendement").alias("number"),
        enrich.amendment_from_row()["first_author"].alias("name"))
    lookup = enrich.members_lookup(members(spark, d), "LOWER").selectExpr(
        "parsed_name AS name", "parsed_affiliation AS affiliation")
    return rows.join(lookup, "name").select("number", "name", "affiliation")


AMENDMENT_PAGES = """am_pages AS (SELECT 'https://am.example.org/' || p_partkey AS link, 'ID' || p_partkey AS amendment_id,
  CASE WHEN p_size % 2 = 0 THEN 'PASS' END AS amendment_outcome FROM part)"""


@query("J7_amendment_pages", with_sql(RECORDS, AMENDMENT_PAGES) + """, a AS (SELECT record_id, unnest(amendments) AS u,
    generate_subscripts(amendments, 1) AS pos FROM records),
  m AS (SELECT record_id, pos, CASE WHEN link IS NULL THEN u.amendment_id || '=-'
    ELSE p.amendment_id || '=' || coalesce(p.amendment_outcome, '-') END AS t
    FROM a LEFT JOIN am_pages p ON u.amendment_page_link = link)
  SELECT record_id, string_agg(t, ';' ORDER BY pos) AS amendments FROM m GROUP BY record_id""")
def _(spark, d):
    pages = table(spark, d, "part").selectExpr(
        "'https://am.example.org/' || p_partkey AS amendment_page_link", "'ID' || p_partkey AS amendment_id",
        "case when p_size % 2 = 0 then 'PASS' end AS amendment_outcome")
    merged = enrich.merge_amendment_pages(records(spark, d).select("record_id", "amendments"), pages,
                                          ["amendment_id", "amendment_outcome"])
    text = joined(F.transform("amendments", lambda a: F.concat(
        a["amendment_id"], F.lit("="), F.coalesce(a["amendment_outcome"], F.lit("-")))))
    return merged.where(F.size("amendments") > 0).select("record_id", text.alias("amendments"))


@query("J8_amendment_stage_number", REC + f"""SELECT record_id, {sql_list(
    "list_transform(amendments, lambda a: CAST(list_position(list_transform(legislative_stages, lambda s: s.name), "
    "a.amendment_stage_name) AS VARCHAR))")} AS numbers FROM records""")
def _(spark, d):
    numbered = F.transform("legislative_stages", lambda s, i: s.withField("number", (i + 1).cast("int")))
    out = enrich.with_amendment_stage_numbers(F.col("amendments"), numbered)
    return records(spark, d).select("record_id", joined(F.transform(
        out, lambda a: a["amendment_stage_number"].cast("string"))).alias("numbers"))


def _stage_rows(spark, d):
    return debates(spark, d).selectExpr("record_id", "cast(turn as int) AS number", "name", "house",
                                        "cast(null as bigint) AS debate_size")


@query("J9_debate_to_stage", with_sql(DEBATES) + f"""SELECT record_id, CAST(turn AS INTEGER) AS number, name, house,
    CASE WHEN turn = min(turn) OVER w THEN CAST(sum({sql_dense('debate_text')}) OVER w AS BIGINT) END AS debate_size
    FROM debates WINDOW w AS (PARTITION BY record_id, name, house)""")
def _(spark, d):
    return enrich.sized_stages(_stage_rows(spark, d), debates(spark, d), "debate_text")


VOTES = """vote_texts AS (SELECT 'https://votes.example.org/' || printf('%012d', l_orderkey * 10 + l_linenumber) || '-' ||
    l_partkey || '-' || l_suppkey || '-' || CAST(l_quantity AS INTEGER) AS url, '20/' || (l_orderkey % 5000) AS id, CAST(l_quantity AS INTEGER) AS yes, l_linenumber AS no,
    l_suppkey AS abst FROM lineitem)"""


def vote_texts(spark, d):
    return page_rows(spark, d, "lineitem", [
        "'https://votes.example.org/' || format_string('%012d', l_orderkey * 10 + l_linenumber) || '-' || l_partkey || '-' || "
        "l_suppkey || '-' || cast(l_quantity as int) AS url",
        "concat('Drs. 19/1 und 20/', l_orderkey % 5000, '\\nSeite: eins\\n700\\n690\\n', cast(l_quantity as int), '\\n', "
        "l_linenumber, '\\n', l_suppkey, '\\n3\\nEnde 9/9') AS extracted_text"])


@query("J10_votes", with_sql(RECORDS, VOTES) + """,
  best AS (SELECT id, max(url) AS url, arg_max(yes, url) AS yes, arg_max(no, url) AS no, arg_max(abst, url) AS abst
    FROM vote_texts GROUP BY id),
  own AS (SELECT final_version_printed_matter_id AS id, min(record_id) AS record_id FROM records GROUP BY 1)
  SELECT r.record_id, CASE WHEN b.id IS NULL THEN r.final_vote_for ELSE CAST(b.yes AS VARCHAR) END AS final_vote_for,
    CAST(b.no AS VARCHAR) AS final_vote_against, CAST(b.abst AS VARCHAR) AS final_vote_abst,
    b.url AS final_votes_pdf_url
  FROM records r LEFT JOIN own o ON o.record_id = r.record_id LEFT JOIN best b ON b.id = o.id""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "final_version_printed_matter_id", "final_vote_for")
    return enrich.with_votes(rec, vote_texts(spark, d)).drop("final_version_printed_matter_id")


TOPICS = """topics AS (SELECT '' || l_partkey AS law_id, l_suppkey % 10 AS topic_no, 'Topic ' || (l_suppkey % 10) AS topic
  FROM lineitem)"""


@query("J11_topics", with_sql(RECORDS, TOPICS) + """, last_ AS (SELECT law_id, arg_max(topic, topic_no) AS topic
    FROM topics GROUP BY 1), own AS (SELECT law_id, min(record_id) AS record_id FROM records GROUP BY 1)
  SELECT r.record_id, coalesce(l.topic, r.bill_type) AS bill_type FROM records r
  LEFT JOIN own o ON o.record_id = r.record_id LEFT JOIN last_ l ON l.law_id = o.law_id""")
def _(spark, d):
    topics = table(spark, d, "lineitem").selectExpr(
        "'' || l_partkey AS law_id", "l_suppkey % 10 AS topic_no", "'Topic ' || (l_suppkey % 10) AS topic")
    return enrich.with_topics(records(spark, d).select("record_id", "law_id", "bill_type"), topics).drop("law_id")


MEETINGS = """meetings AS (SELECT l_orderkey % 400 || '/XIV/' || (l_orderkey % 3 + 1) AS a,
  CASE WHEN l_linenumber % 2 = 0 THEN l_partkey % 400 || '/XIV/' || (l_partkey % 3 + 1) END AS b FROM lineitem)"""


def meetings(spark, d):
    return page_rows(spark, d, "lineitem", [
        "concat('Ponto 1: Proposta de Lei n.º ', l_orderkey % 400, ' / XIV | ', l_orderkey % 3 + 1, ' - debate; ', "
        "case when l_linenumber % 2 = 0 then concat('PROJETO DE LEI ', l_partkey % 400, '/XIV/', l_partkey % 3 + 1) "
        "else 'Projeto de Resolução 7/XIV/1' end) AS text"])


MENTIONS = MEETINGS + """, mentions AS (SELECT bill_id, count(*) AS n FROM (SELECT a AS bill_id FROM meetings UNION ALL
  SELECT b FROM meetings WHERE b IS NOT NULL) GROUP BY 1)"""


@query("J12_hearing_counts", with_sql(RECORDS, MENTIONS) + """, own AS (SELECT bill_id, min(record_id) AS record_id
    FROM records GROUP BY 1)
  SELECT r.record_id, CAST(coalesce(m.n, r.committee_hearing_count) AS INTEGER) AS committee_hearing_count FROM records r
  LEFT JOIN own o ON o.record_id = r.record_id LEFT JOIN mentions m ON m.bill_id = o.bill_id""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_id", "committee_hearing_count")
    return enrich.with_hearing_counts(rec, meetings(spark, d), "text").drop("bill_id")


@query("J13_record_page", """SELECT r.doc_id, p.page_id, length(p.html) AS n FROM documents r
    JOIN pages p ON r.doc_id = p.page_id""")
def _(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    pages = table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), "page_id",
                                            F.length("html").cast("long").alias("n"))
    return docs.join(pages, "doc_id")


@query("J14_url_suffix", """WITH s AS (SELECT o_orderkey % 700 AS part, min('https://x.example.org/' || o_orderkey ||
    '?Fich=' || (o_orderkey % 700)) AS stored_url FROM orders GROUP BY 1)
  SELECT 'https://y.example.org/p?Fich=' || c_custkey AS link_url, stored_url FROM customer LEFT JOIN s
  ON part = c_custkey""")
def _(spark, d):
    links = table(spark, d, "customer").selectExpr("'https://y.example.org/p?Fich=' || c_custkey AS link_url")
    stored = table(spark, d, "orders").selectExpr(
        "'https://x.example.org/' || o_orderkey || '?Fich=' || (o_orderkey % 700) AS stored_url")
    return enrich.by_url_suffix(links, stored)


@query("J15_records_citing_a_law", EDGES + """SELECT owner AS record_id, e.record_id AS affecting_record_id
  FROM edges e JOIN owners o ON e.law_id = o.law_id""")
def _(spark, d):
    return citations.affecting_edges(records(spark, d))


# --- aggregations -------------------------------------------------------------------------------------------------

@query("A1_citation_counts", EDGES + "SELECT law_id, count(*) AS count FROM edges GROUP BY 1 ORDER BY 2 DESC, 1")
def _(spark, d):
    return citations.citation_counts(records(spark, d)).orderBy(F.desc("count"), "law_id")


@query("A2_citation_rollup", EDGES + """SELECT owner AS record_id, r.law_id, affecting_laws_count,
    affecting_laws_first_date FROM rollup_ r JOIN owners o ON o.law_id = r.law_id""")
def _(spark, d):
    return citations.owned_rollup(records(spark, d))


@query("A2_rolled_up_records", EDGES + """SELECT r.record_id, affecting_laws_count, affecting_laws_first_date
    FROM records r LEFT JOIN (rollup_ u JOIN owners o ON o.law_id = u.law_id) ON owner = r.record_id""")
def _(spark, d):
    return citations.with_citation_rollup(records(spark, d).select(
        "record_id", "date_passing", "law_id", "modified_laws")).select(
        "record_id", "affecting_laws_count", "affecting_laws_first_date")


@query("A3_duplicate_keys", """SELECT md5(text) AS key, count(*) AS count FROM documents GROUP BY text
    HAVING count(*) > 1""")
def _(spark, d):
    keys = table(spark, d, "documents").select(F.md5("text").alias("key"))
    return keyed.duplicated(keys, "key")


@query("A4_distinct_committees", REC + """SELECT record_id, CAST(len(list_distinct(list_transform(committees,
    lambda c: c.committee_name))) AS INTEGER) AS n FROM records""")
def _(spark, d):
    return records(spark, d).select("record_id", F.size(F.array_distinct(F.transform(
        "committees", lambda c: c["committee_name"]))).alias("n"))


@query("A5_distinct_elements", REC + f"""SELECT record_id, {sql_list(
    "list_filter(committees, lambda c, i: list_position(list_transform(committees, lambda y: y.committee_name), "
    "c.committee_name) = i)", "x.committee_name || coalesce(x.committee_role, '')")} AS by_name,
    CAST(len(list_distinct(committees)) AS INTEGER) AS n_structs FROM records""")
def _(spark, d):
    firsts = enrich.distinct_by_name(F.col("committees"), "committee_name")
    return records(spark, d).select(
        "record_id", joined(F.transform(firsts, lambda c: F.concat(
            c["committee_name"], F.coalesce(c["committee_role"], F.lit(""))))).alias("by_name"),
        F.size(F.array_distinct("committees")).alias("n_structs"))


@query("A6_mentions", with_sql(MENTIONS) + "SELECT bill_id, n AS count FROM mentions")
def _(spark, d):
    return enrich.mentions(meetings(spark, d), "text")


@query("A7_debate_size", with_sql(DEBATES) + f"""SELECT record_id, name, house,
    CAST(sum({sql_dense('debate_text')}) AS BIGINT) AS debate_size FROM debates GROUP BY 1, 2, 3""")
def _(spark, d):
    return enrich.stage_debate_sizes(debates(spark, d), "debate_text")


@query("A7_plenary_size", with_sql(DEBATES) + f"""SELECT record_id,
    CAST(sum({sql_dense('debate_text')}) AS BIGINT) AS plenary_size FROM debates GROUP BY 1""")
def _(spark, d):
    return enrich.record_debate_sizes(debates(spark, d), "debate_text")


@query("A11_pattern_families", """SELECT o_orderkey, array_to_string(list_sort(list_distinct(['2010-' || o_custkey,
    '2011-' || (o_orderkey % 7), '2010-' || o_custkey])), ';') AS laws, CAST(len(list_distinct(['2010-' || o_custkey,
    '2011-' || (o_orderkey % 7)])) AS INTEGER) AS n FROM orders""")
def _(spark, d):
    from lexmill.functions.labels import FR_MODIFIED_LAWS, modified_laws
    text = F.expr("concat('La loi n° 2010-', o_custkey, ' du 3 mai est abrogé.', repeat(' rien', 60), ' La loi n° 2011-', "
                  "o_orderkey % 7, ' est complété.', repeat(' rien', 60), ' La loi n° 2010-', o_custkey, ' est modifié.', "
                  "repeat(' rien', 60), ' La loi n° 2009-1 reste.')")
    orders = page_rows(spark, d, "orders", ["o_orderkey", "o_custkey"])
    found = computed(computed(orders, {"text": text}), {"found": modified_laws("text", FR_MODIFIED_LAWS)})
    return found.select("o_orderkey", joined("found").alias("laws"), F.size("found").alias("n"))


@query("A13_earliest_date", """SELECT l_orderkey, strftime(min(l_shipdate), '%Y-%m-%d') AS first_date FROM lineitem
    WHERE l_linenumber % 3 <> 0 GROUP BY 1""")
def _(spark, d):
    text = F.when(F.col("l_linenumber") % 3 != 0, F.date_format("l_shipdate", "yyyy.MM.dd")).otherwise("sans date")
    rows = table(spark, d, "lineitem").select("l_orderkey", parse_any(text).alias("day"))
    return rows.groupBy("l_orderkey").agg(F.min("day").alias("day")).where("day is not null").select(
        "l_orderkey", iso(F.col("day")).alias("first_date"))


CELLS = """cells AS (SELECT 'doc' || (l_orderkey % 500) AS url, l_orderkey AS page, l_linenumber AS table_no, l_partkey,
  l_linenumber % 4 = 0 AS small, l_suppkey FROM lineitem)"""


def table_cells(spark, d):
    """Four columns per line item and a header; every fourth table lacks the last column, some cells are blank."""
    cell = ("named_struct('row', {r}, 'col', {c}, 'text', {t})")
    cells = [cell.format(r=0, c=c, t=f"'{t}'") for c, t in enumerate(("Nr", "Gesetz", "Datum"))]
    cells += [cell.format(r=1, c=c, t=f"'x{c}'") for c in range(3)]
    last = [cell.format(r=0, c=3, t="case when l_suppkey % 5 = 0 then 'GESTA' else 'FNA' end"),
            cell.format(r=1, c=3, t="case when l_partkey % 3 = 0 then '' else concat('', l_partkey) end")]
    return page_rows(spark, d, "lineitem", [
        "'doc' || (l_orderkey % 500) AS url", "l_orderkey * 100000 + l_partkey AS page",
        "l_linenumber * 1000 + l_suppkey AS table_no",
        f"inline(case when l_linenumber % 4 = 0 then array({', '.join(cells)}) "
        f"else array({', '.join(cells + last)}) end)"])


@query("A14_table_column", with_sql(CELLS) + """SELECT DISTINCT url, '' || l_partkey AS law_id FROM cells
    WHERE NOT small AND l_suppkey % 5 <> 0 AND l_partkey % 3 <> 0""")
def _(spark, d):
    return enrich.modified_law_ids(table_cells(spark, d))


@query("A15_array_sizes", REC + """SELECT record_id, CAST(coalesce(len(legislative_stages), 0) AS INTEGER) AS stages,
    CAST(coalesce(len(amendments), 0) AS INTEGER) AS amendments FROM records""")
def _(spark, d):
    return records(spark, d).select("record_id", F.coalesce(F.size("legislative_stages"), F.lit(0)).alias("stages"),
                                    F.greatest(F.coalesce(F.size("amendments"), F.lit(0)), F.lit(0)).alias("amendments"))


@query("A16_row_count", REC + "SELECT count(*) AS n FROM records")
def _(spark, d):
    return records(spark, d).agg(F.count(F.lit(1)).alias("n"))


# --- windows, limits, sets ----------------------------------------------------------------------------------------

@query("W1_record_ids", """SELECT url, printf('PT%05d', (SELECT count(*) FROM supplier) +
    row_number() OVER (ORDER BY md5(url), url)) AS record_id FROM pages""")
def _(spark, d):
    stored = table(spark, d, "supplier").count()
    return keyed.assign_record_ids(table(spark, d, "pages").select("url"), "url", "PT", stored)


@query("W2_stage_numbers", REC + f"""SELECT record_id, {sql_list(
    "list_transform(legislative_stages, lambda s, i: i || ' ' || s.name)")} AS stages FROM records""")
def _(spark, d):
    from lexmill.plans.repair import stage_numbers
    return stage_numbers(records(spark, d).select("record_id", "legislative_stages")).select(
        "record_id", joined(F.transform("legislative_stages", lambda s: F.concat_ws(
            " ", s["number"].cast("string"), s["name"]))).alias("stages"))


@query("W3_first_of_key", """SELECT min(l_orderkey * 1000000 + l_partkey * 10 + l_linenumber) AS id, l_suppkey
    FROM lineitem GROUP BY l_suppkey""")
def _(spark, d):
    rows = table(spark, d, "lineitem").selectExpr("l_orderkey * 1000000 + l_partkey * 10 + l_linenumber AS id",
                                                  "l_suppkey")
    return keyed.keep_first(rows, "l_suppkey", "id").distinct()


@query("W4_first_stage_with_fallback", REC + """SELECT record_id, coalesce(
    list_filter(legislative_stages, lambda s: contains(s.name, 'Promul'))[1].date,
    list_filter(legislative_stages, lambda s: contains(s.name, 'Beratung'))[1].date) AS date_committee FROM records""")
def _(spark, d):
    from lexmill.plans.portugal import _containing, stage_date
    stages = F.col("legislative_stages")
    return records(spark, d).select("record_id", F.coalesce(
        stage_date(stages, _containing("Promul")), stage_date(stages, _containing("Beratung"))).alias("date_committee"))


@query("W5_last_match", REC + """SELECT record_id, list_filter(legislative_stages, lambda s: contains(s.name, 'Dépôt'))
    [-1].date AS date_introduction, list_filter(legislative_stages, lambda s: contains(s.name, 'Promulgation'))[-1].date
    AS date_passing FROM records""")
def _(spark, d):
    from lexmill.plans.france import last_stage_date
    stages = F.col("legislative_stages")
    return records(spark, d).select("record_id", last_stage_date(stages, "Dépôt").alias("date_introduction"),
                                    last_stage_date(stages, "Promulgation").alias("date_passing"))


@query("L1_sorted_counts", EDGES + "SELECT law_id, count(*) AS count FROM edges GROUP BY 1 ORDER BY count DESC, law_id")
def _(spark, d):
    return citations.citation_counts(records(spark, d)).orderBy(F.desc("count"), "law_id")


@query("L2_one_per_key", REC + """SELECT law_id, arg_min(record_id, record_id) AS record_id,
    arg_min(bill_title, record_id) AS bill_title FROM records WHERE law_id IS NOT NULL GROUP BY law_id""")
def _(spark, d):
    return keyed.pick_one(records(spark, d), "law_id", "record_id", ["record_id", "bill_title"])


@query("L3_first_and_last", """SELECT doc_id, split_part(text, ' ', 1) AS first_word, split_part(text, ' ', -1) AS last_word
    FROM documents""")
def _(spark, d):
    words = F.split("text", " ")
    return table(spark, d, "documents").select("doc_id", F.get(words, 0).alias("first_word"),
                                               F.try_element_at(words, F.lit(-1)).alias("last_word"))


@query("L4_head_of_text", """SELECT doc_id, md5(array_to_string(string_split(text, chr(10))[1:5], '|')) AS first_lines,
    md5(left(text, 300)) AS head FROM documents""")
def _(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.md5(F.array_join(head_lines("text", 5), "|")).alias("first_lines"),
        F.md5(F.substring("text", 1, 300)).alias("head"))


@query("U1_union_all", """SELECT o_orderkey, len(regexp_extract_all(t, '[0-9]+-[A-Z]+')) +
    len(regexp_extract_all(t, '[A-Z]{3,}')) AS n FROM (SELECT o_orderkey, o_orderpriority || ' / ' || o_orderpriority AS t
    FROM orders)""")
def _(spark, d):
    t = F.concat("o_orderpriority", F.lit(" / "), "o_orderpriority")
    both = F.flatten(F.array(all_matches(t, "[0-9]+-[A-Z]+", 0), all_matches(t, "[A-Z]{3,}", 0)))
    return table(spark, d, "orders").select("o_orderkey", F.size(both).cast("long").alias("n"))


@query("U2_distinct_set", REC + "SELECT DISTINCT law_id, bill_status FROM records")
def _(spark, d):
    return records(spark, d).select("law_id", "bill_status").distinct()


@query("U3_difference", "SELECT p_partkey AS k FROM part EXCEPT SELECT l_suppkey FROM lineitem")
def _(spark, d):
    have = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"))
    return keyed.unseen(table(spark, d, "part").select(F.col("p_partkey").alias("k")), have, "k")


@query("U4_authors_and_signers", with_sql(AMENDMENT_ROWS) + """SELECT "Numéro de l'amendement" AS number,
    split_part("Auteur", ' ', 2) || ' ' || split_part("Auteur", ' ', 1) || CASE WHEN "Cosignataire(s)" = '' THEN '' ELSE
    ';' || split_part("Cosignataire(s)", ',', 1) || ';Bo' END AS people FROM amendment_rows""")
def _(spark, d):
    return amendment_rows(spark, d).select(F.col("Numéro de l'amendement").alias("number"),
                                           joined(enrich.amendment_from_row()["amendment_originator"]).alias("people"))


