"""German pages composed from orders and read back, and the repair jobs; the SQL says what the row put in."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.operators.enrich import votes_by_bill
from lexmill.plans import germany as P
from lexmill.plans import repair as R
from queries.inputs import DOC_TEXTS, RECORDS, doc_texts, joined, page_rows, records, with_sql
from queries.portugal import doc_url, each, rep, sql_doc
from queries.records import VOTES, sql_list, vote_texts
from queries.registry import query, table
from queries.texts import sql_dense, sql_strip

URL = "concat('https://bills.example.org/doc/', o_orderkey, case when o_orderkey % 4 = 0 then '#top' else '' end)"
SEL = "SELECT 'https://bills.example.org/doc/' || o_orderkey || CASE WHEN o_orderkey % 4 = 0 THEN '#top' ELSE '' END AS url, "
STATES = ("Verkündet", "Abgelehnt", "Zurückgezogen", "Überwiesen")


def de(expr: str) -> str:
    return f"date_format({expr}, 'dd.MM.yyyy')"


STATE = f"element_at(array({', '.join(repr(s) for s in STATES)}), cast(o_orderkey % 4 + 1 as int))"
# Steps of the procedure: readings with their house, date, link, committees and, every third bill, motions.
STEP = f'''"<li><div><div><span>", case when i = 3 then "BR" else "BT" end, "</span><span>am ", {de("date_add(o_orderdate, 7 * i)")},
 "</span></div><div class=x><div>", case when i = 3 then "Bundesrat" else "Bundestag" end, "</div><h3> ", case i when 1 then
 "1. Beratung" when 2 then "2. Beratung" else "Durchgang" end, case when i = 2 and o_orderkey % 5 = 0 then " (Nachtrag)" else ""
 end, "</h3><a href='", {doc_url("o_orderkey + i")}, case when i = 1 then "#page=2" else "" end, "'>p</a>", case when i < 3 and
 o_orderkey % 2 = 0 then concat("<h4>Ausschüsse:</h4><ul><li>Recht (federführend)</li><li>Ausschuss ", i % 2 + o_orderkey % 2,
 "</li></ul>") else "" end, case when o_orderkey % 3 = 0 and o_orderkey % 9 > 0 and i < 3 then
 concat("<div>Antrag: x</div><a href='https://am.example.org/", o_orderkey * 3 + i, "'>a</a>") else "" end, "</div></div></li>"'''
MAIN = f"""concat('<h1>Gesetz ', o_custkey, '</h1><label>ID:</label><b>x</b><span>', o_orderkey, '</span>',
 case when o_orderkey % 6 < 5 then concat('<label>Beratungsstand:</label><span> ', {STATE}, ' </span>') else '' end,
 '<label>Wichtige Drucksachen</label><div>vom 01.02.2003, ', {de('o_orderdate')}, '</div><ul><li><a href="', {doc_url('o_orderkey')},
 case when o_orderkey % 3 = 0 then 'x' else '' end, '">19/1</a></li><li>BT-Drs. 20/', o_custkey, ' (Beschluss)</li></ul>',
 case when o_orderkey % 4 = 0 then concat('<label>Verkündung:</label><a href="https://law.example.org/', o_orderkey, '">',
   {de('date_add(o_orderdate, 50)')}, ' und ', {de('date_add(o_orderdate, 60)')}, '</a>') else '' end,
 '<label>Inkrafttreten:</label><span>', case when o_orderkey % 2 = 0 then {de('date_add(o_orderdate, 70)')} else 'offen' end, '</span>',
 '<label>Sachgebiete:</label><div><ul><li> Recht </li><li>Wirtschaft ', o_custkey % 5, '</li></ul></div>',
 case when o_orderkey % 7 > 0 then concat('<p><span>Urheber:</span> ', case when o_orderkey % 2 = 0 then concat('Bundesregierung, BM',
   o_custkey % 9) else 'Bundesrat' end, '</p>') else '' end,
 '<label>Initiative:</label><ul><li> Fraktion A', o_custkey % 4, '</li><li>Fraktion B</li></ul>',
 '<label>Schlagwörter:</label><div><div>Wort ', o_custkey % 6, '</div><div>Zwei; drei</div></div>',
 '<label>Archivsignatur:</label><a href="https://gesta.example.org/', o_orderkey, '.pdf">g</a>',
 case when o_orderkey % 2 = 1 then concat('<label>Plenum</label><ul><li><a href="', {doc_url('o_orderkey')}, '#P.1">1</a></li><li>',
   '<a href="', {doc_url('o_orderkey + 2')}, '">2</a></li></ul>') else '' end,
 '<div id="content-vorgangsablauf"><ul>', {rep('1 + o_orderkey % 3', STEP)},
 case when o_orderkey % 9 = 0 then concat('<li><span>BT</span><span>', {de('date_add(o_orderdate, 2)')}, '</span><div><h3>Änderungsantrag',
   '</h3><a href="https://c.example.org/', o_orderkey, '">Drs. 19/', o_orderkey, '</a><p><strong>Änderungsantrag:</strong> Ann A</p>',
   '<p><strong>Änderungsantrag:</strong> Bo B</p><p><span>Urheber:</span> Fraktion C</p></div></li><li><div><h3>2. Beratung (neu)</h3>',
   '<h4>Beschluss:</h4><ul><li>Annahme 20/5</li><li>Ablehnung 19/', o_orderkey, '</li></ul></div></li>') else '' end,
 '</ul><div><span>', {de('date_add(o_orderdate, 5)')}, '</span><h3>Empfehlungen der Ausschüsse</h3></div><div><span>',
 {de('date_add(o_orderdate, 6)')}, '</span><h3>Gesetzentwurf</h3></div></div>')"""

# 2. Beratung (neu) also counts as a reading.
EDGE = "o_orderkey % 9 = 0"


def sql_de(days: str) -> str:
    return f"strftime(o_orderdate + to_days(CAST({days} AS INTEGER)), '%Y.%m.%d')"


def mains(spark, d):
    return page_rows(spark, d, "orders", [f"{URL} AS url", f"{MAIN} AS html"])


def pages(spark, d):
    return mains(spark, d).selectExpr("'GERMANY' AS country", "url", "'main' AS kind", "html")


FIELDS = []  # (columns, SQL, formatting) of each query below, for the check of whole records


def fields(name: str, columns: list[str], sql: str, post=None):
    FIELDS.append((columns, sql, post))

    @query(name, SEL + sql + " FROM orders")
    def _(spark, d):
        out = P.main_fields(mains(spark, d)).select("url", *columns)
        return post(out) if post else out


STATUS = ("CASE WHEN o_orderkey % 6 = 5 THEN 'ONGOING' ELSE CASE o_orderkey % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REJECT' "
          "WHEN 3 THEN 'ONGOING' END END")
fields("X-DE1_title_id_dates", ["bill_title", "bill_id", "date_introduction", "date_passing", "date_entering_into_force"],
       f"""'Gesetz ' || o_custkey AS bill_title, '' || o_orderkey AS bill_id, '2003.02.01' AS date_introduction,
       CASE WHEN o_orderkey % 4 = 0 THEN {sql_de('60')} END AS date_passing,
       CASE WHEN o_orderkey % 2 = 0 THEN {sql_de('70')} END AS date_entering_into_force""")
fields("X-DE2_status", ["bill_status"], STATUS + " AS bill_status")
fields("X-DE3_originators", ["origin_type", "originators"], """CASE WHEN o_orderkey % 7 > 0 OR o_orderkey % 9 = 0 THEN CASE WHEN
    o_orderkey % 7 > 0 AND o_orderkey % 2 = 0 THEN 'GOVERNMENT' ELSE 'INDIVIDUAL_MP' END END AS origin_type, CASE WHEN
    o_orderkey % 7 > 0 OR o_orderkey % 9 = 0 THEN CASE WHEN o_orderkey % 7 > 0 AND o_orderkey % 2 = 0 THEN 'Bundesregierung=BM' || (o_custkey % 9) ELSE 'Fraktion A' || (o_custkey % 4) || '=Fraktion A' ||
    (o_custkey % 4) || ';Fraktion B=Fraktion B' END END AS originators""",
       lambda df: df.withColumn("originators", joined(F.transform("originators", lambda o: F.concat_ws(
           "=", o["originator_name"], o["originator_affiliation"])))))
fields("X-DE4_type_and_area", ["bill_type", "policy_area"], """'Recht - Wirtschaft ' || (o_custkey % 5) AS bill_type,
    'Wort ' || (o_custkey % 6) || ' - Zwei; drei' AS policy_area""")
_HEADS = "CASE WHEN o_orderkey % 2 = 0 THEN least(1 + o_orderkey % 3, 2) ELSE 0 END"
fields("X-DE5_committees", ["committees", "committee_count", "committee_hearing_count", "leading_committee_name"], each(
    _HEADS, f"""'Recht (federführend)/Lead/' || {sql_de('7 * i')} || ';Ausschuss ' || (i % 2 + o_orderkey % 2) || '/-/' ||
    {sql_de('7 * i')}""") + f""" AS committees, CAST(CASE {_HEADS} WHEN 0 THEN 0 ELSE 1 + {_HEADS} END AS INTEGER)
    AS committee_count, CAST({_HEADS} AS INTEGER) AS committee_hearing_count, CASE WHEN o_orderkey % 2 = 0 THEN 'Recht' END
    AS leading_committee_name""",
       lambda df: df.withColumn("committees", joined(F.transform("committees", lambda c: F.concat_ws(
           "/", c["committee_name"], F.coalesce(c["committee_role"], F.lit("-")), c["committee_date"])))))


def sql_stages(item: str) -> str:
    """Stage texts in order; a supplement reading is skipped, the edge case adds one."""
    base = (f"list_transform(list_filter(range(1, CAST(2 + o_orderkey % 3 AS INTEGER)), lambda i: NOT (i = 2 AND "
            f"o_orderkey % 5 = 0)), lambda i: {item})")
    return base


_STAGE = f"""['1. Beratung', '2. Beratung', 'Durchgang'][i] || '/' || CASE WHEN i = 3 THEN 'UPPER' ELSE 'LOWER' END || '/am ' ||
    strftime(o_orderdate + to_days(CAST(7 * i AS INTEGER)), '%d.%m.%Y') || '/' || {sql_doc('o_orderkey + i')} || CASE WHEN i = 1
    THEN '#page=2' ELSE '' END"""
_EDGE_STAGE = f"'2. Beratung (neu)/LOWER/' || {sql_de('2')} || '/-'"


def _stage_text(df):
    return df.withColumn("legislative_stages", joined(F.transform("legislative_stages", lambda s: F.concat_ws(
        "/", s["name"], s["house"], s["date"], F.coalesce(s["debate_url"], F.lit("-"))))))


fields("X-DE6_stages", ["legislative_stages", "stages_count"], f"""array_to_string({sql_stages(_STAGE)} || CASE WHEN {EDGE}
    THEN [{_EDGE_STAGE}] ELSE [] END, ';') AS legislative_stages, CAST(len({sql_stages('i')}) + CASE WHEN {EDGE} THEN 1 ELSE 0
    END AS INTEGER) AS stages_count""", _stage_text)
fields("X-DE8_bill_text_url", ["bill_text_url"], f"CASE WHEN o_orderkey % 3 > 0 THEN {sql_doc('o_orderkey')} END AS bill_text_url")
fields("X-DE9_law_text_url", ["law_text_url"], """CASE WHEN o_orderkey % 4 = 0 THEN 'https://law.example.org/' || o_orderkey END
    AS law_text_url""")
fields("X-DE11_modified_laws_pdf", ["modified_laws_pdf_url"], """'https://gesta.example.org/' || o_orderkey || '.pdf'
    AS modified_laws_pdf_url""")
fields("X-DE12_final_version", ["final_version_printed_matter_id"], f"""CASE WHEN {STATUS} = 'PASS' THEN '20/' || o_custkey END
    AS final_version_printed_matter_id""")
_AMS = f"""CASE WHEN {EDGE} THEN '19/' || o_orderkey || '/1. Beratung/1/LOWER/' || {sql_de('2')} || '/Ann A; Bo B/Fraktion C/REJECT'
    WHEN o_orderkey % 3 = 0 THEN {each('least(1 + o_orderkey % 3, 2)', f'''coalesce('https://am.example.org/' || (o_orderkey * 3 + i))
    || '/' || ['1. Beratung', '2. Beratung'][i] || '/' || i || '/LOWER/am ' || strftime(o_orderdate + to_days(CAST(7 * i AS INTEGER)),
    '%d.%m.%Y') || '/-/-/-' ''')} END"""


def _am_text(df):
    def one(a):
        dash = F.lit("-")
        return F.concat_ws("/", F.coalesce(a["amendment_id"], a["amendment_page_link"]), a["amendment_stage_name"],
                           F.coalesce(a["amendment_stage_number"].cast("string"), dash), a["amendment_plenary"],
                           a["amendment_date"], F.coalesce(F.array_join(a["amendment_originator"], ","), dash),
                           F.coalesce(a["amendment_originator_aff"], dash), F.coalesce(a["amendment_outcome"], dash))
    return df.withColumn("amendments", joined(F.transform("amendments", one)))


fields("X-DE13_amendments", ["amendments"], _AMS + " AS amendments", _am_text)


@query("X-DE18_heading_dates", SEL + f"{sql_de('5')} AS date_committee, {sql_de('6')} AS ia_date FROM orders")
def _(spark, d):
    return P.unused_dates(mains(spark, d))


CACHE = """cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t FROM doc_texts)"""


@query("X-DE7_plenary_size", with_sql(DOC_TEXTS, CACHE) + SEL + f"""CASE WHEN o_orderkey % 2 = 1 THEN
    CAST({sql_dense('a.t')} + {sql_dense('b.t')} AS BIGINT) END AS plenary_size FROM orders LEFT JOIN cache a ON a.u =
    {sql_doc('o_orderkey')} LEFT JOIN cache b ON b.u = {sql_doc('o_orderkey + 2')}""")
def _(spark, d):
    return P.records(pages(spark, d), doc_texts(spark, d)).select(F.col("bill_page_url").alias("url"), "plenary_size")


# Whole texts without the strings that end a section.
BODY = "replace(replace(extracted_text, 'D.', ''), 'II', '')"


def section_texts(spark, d):
    """Cache whose texts hold all German sections around the whole text."""
    return doc_texts(spark, d).withColumn("extracted_text", F.expr(
        f"concat('C. Alternativen\\nKeine ', {BODY}, '\\nD. Kosten\\nArtikel 1\\n', {BODY}, '  Text\\n"
        f"Begründung\\nA', {BODY}, ' II. Besonderer Teil x')"))


def law_cache(spark, d):
    own = page_rows(spark, d, "orders", [
        "'law' AS collection", "'https://law.example.org/' || o_orderkey AS url", "1L AS size",
        "concat(' § ', o_orderkey, case when o_orderkey % 8 = 0 then ' wird aufgehoben' else ' gilt' end, '\\n') AS extracted_text",
        "1L AS text_size"])
    return section_texts(spark, d).unionByName(own)


SECTIONS = f"sections AS (SELECT split_part(url, '#', 1) AS u, {BODY} AS body FROM doc_texts)"
BILL_TEXT = ("regexp_replace('Artikel 1' || chr(10) || body || ' Text' || chr(10) || 'Begründung' || chr(10) || 'A' || body || "
             "' II.', ' +', ' ', 'g')")
IA1 = sql_strip("'C. Alternativen' || chr(10) || 'Keine ' || body")
IA2 = sql_strip("'Begründung' || chr(10) || 'A' || body")


@query("X-DE_records", with_sql(DOC_TEXTS, SECTIONS) + SEL + f"""{BILL_TEXT} AS bill_text, CASE WHEN o_orderkey % 3 > 0 THEN
    CAST(coalesce({sql_dense(BILL_TEXT)}, 0) AS BIGINT) END AS bill_size, {IA1} AS ia_text1, {IA2} AS ia_text2,
    CASE WHEN body IS NOT NULL THEN CAST({sql_dense(IA1)} AS BIGINT) END AS ia_size1,
    CASE WHEN o_orderkey % 4 = 0 THEN o_orderkey % 8 > 0 END AS original_law,
    CASE WHEN o_orderkey % 4 = 0 THEN '§ ' || o_orderkey || CASE WHEN o_orderkey % 8 = 0 THEN ' wird aufgehoben' ELSE ' gilt' END
    END AS law_text FROM orders LEFT JOIN sections ON u = {sql_doc('o_orderkey')} AND o_orderkey % 3 > 0""")
def _(spark, d):
    return P.records(pages(spark, d), law_cache(spark, d)).select(
        F.col("bill_page_url").alias("url"), "bill_text", "bill_size", "ia_text1", "ia_text2", "ia_size1", "original_law",
        "law_text")


@query("X-DE10_impact_sections", f"""SELECT doc_id, {IA1} AS ia_text1, {IA2} AS ia_text2, CAST({sql_dense(IA1)} AS BIGINT)
    AS ia_size1, CAST({sql_dense(IA2)} AS BIGINT) AS ia_size2 FROM (SELECT doc_id,
    replace(replace(text, 'D.', ''), 'II', '') AS body FROM documents)""")
def _(spark, d):
    src = table(spark, d, "documents").selectExpr("doc_id", "replace(replace(text, 'D.', ''), 'II', '') AS body").selectExpr(
        "doc_id", "concat('C. Alternativen\\nKeine ', body, '\\nD. Kosten\\nBegründung\\nA', body, 'III') AS t")
    return src.select("doc_id", *[c.alias(n) for n, c in P.impact_columns(F.col("t")).items()])


AM_PAGE = """concat('<label>ID:</label><span>ID', p_partkey, '</span><label>Beratungsstand:</label><span>', case p_size % 3
 when 0 then 'Angenommen' when 1 then 'Abgelehnt' else 'Offen' end, '</span><label>Wichtige Drucksachen</label><a href="/d/',
 p_partkey, '.pdf">d</a><label>Initiative:</label><span>Fraktion ', p_size, '</span><h3>Antrag</h3><ul><li>Antrag: Ann ', p_partkey,
 '</li><li>Bo</li><li>Bo und andere</li></ul>')"""


def am_pages(spark, d):
    return page_rows(spark, d, "part", ["'https://am.example.org/' || p_partkey AS url", f"{AM_PAGE} AS html"])


@query("X-DE14_amendment_page", """SELECT 'https://am.example.org/' || p_partkey AS amendment_page_link, 'ID' || p_partkey
    AS amendment_id, CASE p_size % 3 WHEN 0 THEN 'PASS' WHEN 1 THEN 'REJECT' END AS amendment_outcome, '/d/' || p_partkey || '.pdf'
    AS amendment_text_url, 'Ann ' || p_partkey || '; Bo' AS amendment_originator, 'Fraktion ' || p_size
    AS amendment_originator_aff FROM part""")
def _(spark, d):
    return P.amendment_page_fields(am_pages(spark, d)).withColumn("amendment_originator", joined("amendment_originator"))


@query("X-DE15_amendment_texts", with_sql(DOC_TEXTS, CACHE) + f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_linenumber % 3 = 0 THEN 'have' WHEN t IS NOT NULL THEN md5('II. ' || t) END AS t, CASE WHEN l_linenumber % 3 = 0 THEN
    4 WHEN t IS NOT NULL THEN CAST({sql_dense('t')} + 3 AS BIGINT) ELSE 0 END AS n FROM lineitem LEFT JOIN cache ON u =
    {sql_doc('l_orderkey')}""")
def _(spark, d):
    src = table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f"concat({doc_url('l_orderkey')}) AS amendment_text_url",
        "case when l_linenumber % 3 = 0 then 'have' end AS amendment_text",
        "case when l_linenumber % 3 = 0 then 4L end AS amendment_text_size")
    cache = doc_texts(spark, d).withColumn("extracted_text", F.expr(
        "case when extracted_text > '' then concat('I. x ', 'II. ', extracted_text) else '' end"))
    out = P.amendment_texts(src, cache)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(
        F.col("amendment_text") == "have", "have").otherwise(F.md5("amendment_text")).alias("t"),
        F.col("amendment_text_size").alias("n"))


@query("X-DE16_votes", with_sql(VOTES) + """SELECT id AS final_version_printed_matter_id, max(url) AS final_votes_pdf_url,
    arg_max(yes, url) AS final_vote_for, arg_max(no, url) AS final_vote_against, CAST(arg_max(abst, url) AS INTEGER)
    AS final_vote_abst FROM vote_texts GROUP BY id""")
def _(spark, d):
    return votes_by_bill(vote_texts(spark, d))


REC = with_sql(RECORDS)


@query("X-DE17_stage_debate_sizes", with_sql(RECORDS, DOC_TEXTS, CACHE) + f""", s AS (SELECT record_id, unnest(legislative_stages)
    AS s, generate_subscripts(legislative_stages, 1) AS pos FROM records), z AS (SELECT record_id, pos, CASE WHEN
    s.debate_url IS NOT NULL AND coalesce(s.debate_size, 0) = 0 THEN CAST({sql_dense('t')} AS VARCHAR) ELSE
    CAST(s.debate_size AS VARCHAR) END AS n FROM s LEFT JOIN cache ON u = split_part(s.debate_url, '#', 1))
  SELECT record_id, string_agg(coalesce(n, '-'), ';' ORDER BY pos) AS sizes FROM z GROUP BY 1""")
def _(spark, d):
    out = P.with_stage_debate_sizes(records(spark, d).select("record_id", "legislative_stages"), doc_texts(spark, d))
    return out.select("record_id", joined(F.transform(
        "legislative_stages", lambda s: s["debate_size"].cast("string"))).alias("sizes"))


# --- repairs ------------------------------------------------------------------------------------------------------

@query("R1_impact_texts", with_sql(RECORDS, DOC_TEXTS, SECTIONS) + f"""SELECT record_id, CASE WHEN body IS NULL THEN ia_text1 ELSE
    {IA1} END AS ia_text1, CASE WHEN body IS NULL THEN ia_text2 ELSE {IA2} END AS ia_text2, CASE WHEN body IS NULL THEN ia_date
    ELSE date_introduction END AS ia_date, CASE WHEN body IS NULL THEN ia_text_url ELSE bill_text_url END AS ia_text_url
    FROM records LEFT JOIN sections ON u = split_part(bill_text_url, '#', 1)""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_text_url", "date_introduction", "ia_date", "ia_text_url", "ia_text1",
                                   "ia_text2")
    return R.impact_texts(rec, section_texts(spark, d)).select("record_id", "ia_text1", "ia_text2", "ia_date", "ia_text_url")


@query("R1_impact_text_urls", REC + """SELECT record_id, CASE WHEN bill_text_url IS NOT NULL AND ia_text1 IS NOT NULL AND
    ia_text_url IS NULL THEN bill_text_url ELSE ia_text_url END AS ia_text_url FROM records""")
def _(spark, d):
    return R.impact_text_urls(records(spark, d)).select("record_id", "ia_text_url")


@query("R1_impact_dates", REC + """SELECT record_id, CASE WHEN (ia_text1 IS NOT NULL OR ia_text2 IS NOT NULL) AND ia_date IS NULL
    THEN date_introduction ELSE ia_date END AS ia_date FROM records""")
def _(spark, d):
    return R.impact_dates(records(spark, d)).select("record_id", "ia_date")


@query("R2_law_text_urls", REC + """SELECT record_id, CASE WHEN o_orderkey % 4 = 0 THEN 'https://law.example.org/' || o_orderkey
    ELSE law_text_url END AS law_text_url FROM records JOIN orders ON record_id = 'R' || o_orderkey""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_page_url", "law_text_url")
    return R.law_text_urls(rec, mains(spark, d)).select("record_id", "law_text_url")


@query("R3_bill_texts", with_sql(RECORDS, DOC_TEXTS, SECTIONS) + f"""SELECT record_id, CASE WHEN bill_text_url IS NOT NULL THEN
    {BILL_TEXT} END AS bill_text, CASE WHEN bill_text_url IS NOT NULL THEN coalesce({sql_dense(BILL_TEXT)}, 0) ELSE bill_size END
    AS bill_size FROM records LEFT JOIN sections ON u = split_part(bill_text_url, '#', 1)""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_text_url", "bill_size", F.lit(None).cast("string").alias("bill_text"))
    return R.bill_texts(rec, section_texts(spark, d)).select("record_id", "bill_text", "bill_size")


@query("R3_bill_sizes", f"SELECT doc_id, CAST({sql_dense('text')} AS BIGINT) AS bill_size FROM documents")
def _(spark, d):
    rec = table(spark, d, "documents").selectExpr("doc_id", "text AS bill_text", "1L AS bill_size")
    return R.bill_sizes(rec).select("doc_id", "bill_size")


@query("R4_committee_hearings", REC + f"""SELECT record_id, CASE WHEN committee_hearing_count IS NULL THEN CAST({_HEADS} AS INTEGER)
    ELSE committee_hearing_count END AS committee_hearing_count FROM records JOIN orders ON record_id = 'R' || o_orderkey""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_page_url", "committee_hearing_count")
    return R.committee_hearings(rec, mains(spark, d)).select("record_id", "committee_hearing_count")


@query("R4_committee_counts", REC + """SELECT record_id, CASE WHEN committee_count > 1 THEN CAST(len(list_distinct(list_transform(
    committees, lambda c: c.committee_name))) AS INTEGER) ELSE committee_count END AS committee_count FROM records""")
def _(spark, d):
    return R.committee_counts(records(spark, d).select("record_id", "committees", "committee_count")).select(
        "record_id", "committee_count")


@query("R5_stage_numbers", REC + f"""SELECT record_id, {sql_list("list_transform(legislative_stages, lambda s, i: '' || i)")}
    AS numbers FROM records""")
def _(spark, d):
    return R.stage_numbers(records(spark, d).select("record_id", "legislative_stages")).select(
        "record_id", joined(F.transform("legislative_stages", lambda s: s["number"].cast("string"))).alias("numbers"))


@query("R5_amendment_stage_numbers", REC + f"""SELECT record_id, {sql_list("list_transform(amendments, lambda a: CAST("
    "list_position(list_transform(legislative_stages, lambda s: s.name), a.amendment_stage_name) AS VARCHAR))")} AS numbers
    FROM records""")
def _(spark, d):
    rec = R.stage_numbers(records(spark, d).select("record_id", "legislative_stages", "amendments"))
    return R.amendment_stage_numbers(rec).select("record_id", joined(F.transform(
        "amendments", lambda a: a["amendment_stage_number"].cast("string"))).alias("numbers"))


@query("R6_status", REC + f"""SELECT record_id, CASE WHEN bill_status = 'ONGOING' THEN {STATUS} ELSE bill_status END AS bill_status
    FROM records JOIN orders ON record_id = 'R' || o_orderkey""")
def _(spark, d):
    return R.bill_status(records(spark, d).select("record_id", "bill_page_url", "bill_status"), mains(spark, d)).select(
        "record_id", "bill_status")


@query("R6_stages", REC + f"""SELECT record_id, CASE WHEN stages_count > 3 THEN array_to_string({sql_stages(_STAGE)} || CASE WHEN
    {EDGE} THEN [{_EDGE_STAGE}] ELSE [] END, ';') ELSE 'old' END AS legislative_stages, CASE WHEN stages_count > 3 THEN
    CAST(len({sql_stages('i')}) + CASE WHEN {EDGE} THEN 1 ELSE 0 END AS INTEGER) ELSE stages_count END AS stages_count
    FROM records JOIN orders ON record_id = 'R' || o_orderkey""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_page_url", "legislative_stages", "stages_count",
                                   (F.col("stages_count") > 3).alias("due"))
    out = R.stages(rec, mains(spark, d), more_than=3)
    return _stage_text(out).select("record_id", F.when(F.col("due"), F.col("legislative_stages")).otherwise("old").alias(
        "legislative_stages"), "stages_count")


@query("R6_amendments", REC + f"""SELECT record_id, CASE WHEN {EDGE} AND amendment_count > 1 THEN 1 ELSE amendment_count END
    AS amendment_count FROM records JOIN orders ON record_id = 'R' || o_orderkey""")
def _(spark, d):
    rec = records(spark, d).select("record_id", "bill_page_url", "amendments", "amendment_count")
    return R.amendments(rec, mains(spark, d)).select("record_id", "amendment_count")


@query("R7_document_urls", """SELECT 'https://d.example.org/' || (l_partkey % 500) AS url, min(l_orderkey * 10000000 + l_partkey *
    1000 + l_suppkey * 8 + l_linenumber) AS id FROM lineitem GROUP BY 1""")
def _(spark, d):
    docs = table(spark, d, "lineitem").selectExpr(
        "'https://d.example.org/' || (l_partkey % 500) || case when l_linenumber % 2 = 0 then '#p=1' else '' end AS url",
        "l_orderkey * 10000000 + l_partkey * 1000 + l_suppkey * 8 + l_linenumber AS id")
    return R.clean_document_urls(docs, "id").distinct()


@query("R8_links", """SELECT 'https://dip.example.org/' || (c_custkey % 300) AS bill_link, min(c_custkey) AS id FROM customer
    GROUP BY 1""")
def _(spark, d):
    base = ("?f.typ=Vorgang&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen"
            "~Gesetzgebung&f.drucksachetyp_p=05Gesetze&f.drucksachetyp_p=05Gesetze~Gesetzentwurf&rows=250&sort=basisdatum_ab&pos=")
    links = table(spark, d, "customer").selectExpr(
        f"'https://dip.example.org/' || (c_custkey % 300) || case when c_custkey % 2 = 0 then '{base}' || c_custkey else '' end "
        "AS bill_link", "c_custkey AS id")
    return R.clean_links(links, "bill_link", "id")


@query("R9_amendment_houses", REC + f"""SELECT record_id, {sql_list("list_transform(amendments, lambda a: CASE lower(a.amendment_plenary)"
    " WHEN 'bundestag' THEN 'LOWER' WHEN 'bundesrat' THEN 'UPPER' ELSE a.amendment_plenary END)")} AS houses FROM records""")
def _(spark, d):
    return R.amendment_houses(records(spark, d).select("record_id", "amendments")).select(
        "record_id", joined(F.transform("amendments", lambda a: a["amendment_plenary"])).alias("houses"))


@query("R9_amendment_affiliations", REC + """, a AS (SELECT record_id, unnest(amendments) AS a, generate_subscripts(amendments, 1)
    AS pos FROM records) SELECT record_id, string_agg(coalesce('Fraktion ' || p_size, '-'), ';' ORDER BY pos) AS affiliations
    FROM a LEFT JOIN part ON a.amendment_page_link = 'https://am.example.org/' || p_partkey GROUP BY 1""")
def _(spark, d):
    out = R.amendment_affiliations(records(spark, d).select("record_id", "amendments"), am_pages(spark, d))
    return out.where(F.size("amendments") > 0).select("record_id", joined(F.transform(
        "amendments", lambda a: a["amendment_originator_aff"])).alias("affiliations"))


