"""Whole runs per country, from composed pages to numbered and enriched records; the SQL covers the columns of a record.

The columns are those of the country's field queries, taken from the run's snapshot, with what the run adds or replaces.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.plans import collect
from lexmill.schema import EXPORT_COLUMNS
from lexmill.session import new_path
from lexmill.sources import sinks
from queries import france, germany, portugal
from queries.inputs import amendment_rows, doc_texts, joined, members, page_rows, with_sql
from queries.records import MENTIONS, VOTES, meetings, vote_texts
from queries.registry import query, table


def _formatted(records, fields, drop=()):
    """Record columns as the field queries show them."""
    columns = ["record_id", "url"]
    out = records.withColumn("url", F.col("bill_page_url"))
    for names, _, post in fields:
        if not set(names) & set(drop):
            out = post(out) if post else out
            columns += names
    return out, columns


def _rec(prefix: str, select: str, fields, drop=(), where: str = "") -> str:
    parts = ", ".join(sql for names, sql, _ in fields if not set(names) & set(drop))
    return f"""rec AS (SELECT printf('{prefix}%05d', row_number() OVER (ORDER BY md5(url), url)) AS record_id, * FROM
      ({select} {parts} FROM orders {where}))"""


_PT_DROP = ["report_url", "law_page_url"]
_PT_TOPICS = """topics AS (SELECT (l_orderkey % 99) || '-A/' || year(l_shipdate) AS law_id, max(l_linenumber) AS n FROM lineitem
  GROUP BY 1), law AS (SELECT o_orderkey, 'https://pt.example.org/bid=' || o_orderkey AS law_url, CASE WHEN o_orderkey % 4 = 3
  THEN (o_orderkey % 99) || '-A/' || year(o_orderdate) END AS law_id FROM orders)"""


@query("PT_run", with_sql(MENTIONS.replace("mentions AS", "mentions_ AS"), _PT_TOPICS, _rec("PT", portugal.SEL, portugal.FIELDS, _PT_DROP)) + """,
  r AS (SELECT rec.*, law.law_id FROM rec JOIN law ON law_url = url),
  own AS (SELECT law_id, min(record_id) AS record_id FROM r WHERE law_id IS NOT NULL GROUP BY 1),
  bill AS (SELECT bill_id AS b, min(record_id) AS record_id FROM r GROUP BY 1)
  SELECT r.*, CASE WHEN t.n IS NOT NULL THEN 'T' || t.n END AS bill_type, CAST(m.n AS INTEGER) AS committee_hearing_count
  FROM r LEFT JOIN own USING (record_id) LEFT JOIN topics t ON t.law_id = own.law_id LEFT JOIN bill USING (record_id)
  LEFT JOIN mentions_ m ON m.bill_id = bill.b""")
def _(spark, d):
    topics = table(spark, d, "lineitem").selectExpr("(l_orderkey % 99) || '-A/' || year(l_shipdate) AS law_id",
                                                    "l_linenumber AS topic_no", "'T' || l_linenumber AS topic")
    run = collect.portuguese(portugal.pages(spark, d), portugal.law_texts(spark, d), topics, meetings(spark, d))
    out, columns = _formatted(run, portugal.FIELDS, _PT_DROP)
    return out.select(*columns, "law_id", "bill_type", "committee_hearing_count")


@query("FR_run", with_sql(_rec("FR", france.SEL, france.FIELDS, where=f"WHERE {france.KEPT}")) + f""",
  own AS (SELECT bill_title AS title, min(record_id) AS record_id FROM rec GROUP BY 1),
  am AS (SELECT 'Titre é ' || l_partkey AS title, l_orderkey || '-' || l_linenumber AS id FROM lineitem),
  got AS (SELECT record_id, count(*) AS n, string_agg(id, ';' ORDER BY id) AS amendments FROM am JOIN own USING (title) GROUP BY 1),
  state AS (SELECT 'https://www.assemblee-nationale.fr/' AS x, o_orderkey, {france._STATUS} AS bill_status FROM orders)
  SELECT rec.* REPLACE (coalesce(n, amendment_count) AS amendment_count), amendments, s.bill_status FROM rec LEFT JOIN got
  USING (record_id) JOIN state s ON CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) = s.o_orderkey""")
def _(spark, d):
    rows = amendment_rows(spark, d).withColumn("bill_title", F.regexp_replace("bill_title", "^Projet", "Titre é"))
    run = collect.french(france.pages(spark, d), france.pdf_texts(spark, d), members(spark, d), rows)
    out, columns = _formatted(run, france.FIELDS)
    ids = joined(F.transform("amendments", lambda a: a["amendment_id"]))
    return out.select(*columns, ids.alias("amendments"), "bill_status")


_SIZES = "sizes AS (SELECT list(p_size ORDER BY p_partkey) AS s FROM part)"
_DE_AM = f"""CASE WHEN {germany.EDGE} THEN '19/' || o_orderkey || '/REJECT/Fraktion C/0' WHEN o_orderkey % 3 = 0 THEN
  array_to_string(list_transform(range(1, CAST(least(1 + o_orderkey % 3, 2) + 1 AS INTEGER)), lambda i: CASE WHEN
  o_orderkey * 3 + i < len(s) THEN 'ID' || (o_orderkey * 3 + i) || '/' || CASE s[o_orderkey * 3 + i + 1] % 3 WHEN 0 THEN 'PASS' WHEN 1
  THEN 'REJECT' ELSE '-' END || '/Fraktion ' || s[o_orderkey * 3 + i + 1] || '/0' ELSE 'https://am.example.org/' || (o_orderkey * 3 + i) ||
  '/-/-/-' END), ';') END AS amendments"""


@query("DE_run", with_sql(VOTES, _SIZES, _rec("DE", germany.SEL, [*germany.FIELDS, (["amendments_"], _DE_AM, None)],
                                             ["amendments"], ", sizes")) + """,
  laws AS (SELECT 'https://gesta.example.org/' || l_orderkey || '.pdf' AS pdf, list_sort(list_distinct(list('' || l_partkey))) AS ids
    FROM lineitem GROUP BY 1),
  best AS (SELECT id, max(url) AS vote_url, arg_max(yes, url) AS yes, arg_max(no, url) AS no, arg_max(abst, url) AS abst FROM vote_texts GROUP BY id),
  own AS (SELECT final_version_printed_matter_id AS id, min(record_id) AS record_id FROM rec GROUP BY 1)
  SELECT rec.*, array_to_string(ids, ';') AS modified_laws, CAST(len(ids) AS INTEGER) AS modified_laws_count, CAST(yes AS VARCHAR)
    AS final_vote_for, CAST(no AS VARCHAR) AS final_vote_against, CAST(abst AS VARCHAR) AS final_vote_abst, vote_url AS final_votes_pdf_url
  FROM rec LEFT JOIN laws ON pdf = modified_laws_pdf_url LEFT JOIN own USING (record_id) LEFT JOIN best ON best.id = own.id""")
def _(spark, d):
    cell = "named_struct('row', {}, 'col', {}, 'text', {})".format
    cells = page_rows(spark, d, "lineitem", [
        "concat('https://gesta.example.org/', l_orderkey, '.pdf') AS url", "l_partkey AS page", "l_linenumber * 1000 + l_suppkey AS table_no",
        f"inline(array({', '.join(cell(0, c, t) for c, t in enumerate(["'1'", "'2'", "'3'", "'FNA'"]))}, "
        f"{cell(1, 3, 'cast(l_partkey as string)')}))"]).withColumn("text", F.col("text").cast("string"))
    pages = germany.pages(spark, d).unionByName(germany.am_pages(spark, d).selectExpr(
        "'GERMANY' AS country", "url", "'amendment' AS kind", "html"))
    run = collect.german(pages, doc_texts(spark, d), cells, vote_texts(spark, d))
    out, columns = _formatted(run, germany.FIELDS, ["amendments"])
    dash = F.lit("-")
    said = joined(F.transform("amendments", lambda a: F.concat_ws(
        "/", F.coalesce(a["amendment_id"], a["amendment_page_link"]), F.coalesce(a["amendment_outcome"], dash),
        F.coalesce(a["amendment_originator_aff"], dash), F.coalesce(a["amendment_text_size"].cast("string"), dash))))
    return out.select(*columns, said.alias("amendments"), joined("modified_laws").alias("modified_laws"), "modified_laws_count",
                      "final_vote_for", "final_vote_against", "final_vote_abst", "final_votes_pdf_url")


@query("PT_run_tables", """SELECT 'bill_main_table' AS name, count(*) AS n FROM orders UNION ALL
  SELECT 'legislative_stages', sum(1 + o_orderkey % 4) FROM orders UNION ALL SELECT 'originators', sum(o_orderkey % 3) FROM orders
  UNION ALL SELECT 'committees', 3 * count(*) FROM orders UNION ALL SELECT 'amendments', 2 * count(*) FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT 'modified_laws', count(*) FROM orders WHERE o_orderkey % 4 = 3 UNION ALL SELECT 'affecting_laws', 0
  UNION ALL SELECT 'law_text', count(*) FROM orders WHERE o_orderkey % 4 = 3 UNION ALL SELECT 'bill_text', count(*) FROM orders JOIN
  documents ON doc_id = o_orderkey + 1 UNION ALL SELECT 'impact_assessments', count(*) FROM orders WHERE o_orderkey % 3 > 0""")
def _(spark, d):
    topics = spark.createDataFrame([], "law_id string, topic_no int, topic string")
    run = collect.portuguese(portugal.pages(spark, d), portugal.law_texts(spark, d), topics, meetings(spark, d))
    paths = sinks.export(collect.materialise(run, "records"), new_path(spark, "export"), "PORTUGAL", "day")
    counts = [sinks.read_table(spark, p, EXPORT_COLUMNS[n]).agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n, p in paths.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
