"""Stores that are kept up to date: ids, patched buckets, citation state, late pages, stored texts, exports, counts of a run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lexmill.operators import citation_state, enrich, keyed
from lexmill.operators.idrange import IdRanges, high_water
from lexmill.plans import collect
from lexmill.plans.metrics import Counts
from lexmill.schema import EXPORT_COLUMNS, PAGES
from lexmill.session import materialise, new_path
from lexmill.sources import sinks, tables
from lexmill.sources.buckets import Buckets
from lexmill.sources.text_cache import TextCache
from lexmill.streaming import halves
from queries import france, germany, portugal
from queries.inputs import (AMENDMENT_ROWS, DOC_TEXTS, RECORDS, amendment_rows, doc_texts, joined, members, page_rows, records,
                            with_sql)
from queries.records import REC, meetings, vote_texts
from queries.registry import query, table
from queries.runs import _PT_DROP, _rec

# --- ids ----------------------------------------------------------------------------------------------------------


@query("W1_ids_after_delete", """WITH first AS (SELECT 'https://s.example.org/' || s_suppkey AS url, s_acctbal, row_number() OVER (ORDER BY
    md5('https://s.example.org/' || s_suppkey), s_suppkey) AS n FROM supplier)
  SELECT url, printf('PT%05d', n) AS record_id FROM first WHERE s_acctbal >= 5000 UNION ALL SELECT url, printf('PT%05d',
    (SELECT max(n) FROM first WHERE s_acctbal >= 5000) + row_number() OVER (ORDER BY md5(url), url)) FROM pages""")
def _(spark, d):
    suppliers = table(spark, d, "supplier").selectExpr("'https://s.example.org/' || s_suppkey AS url", "s_acctbal")
    kept = materialise(keyed.assign_record_ids(suppliers, "url", "PT"), "records").where("s_acctbal >= 5000").select("url", "record_id")
    new = keyed.assign_record_ids(table(spark, d, "pages").select("url"), "url", "PT", high_water(kept, "PT"))
    return kept.unionByName(new)


@query("W1_reserved_ids", """WITH first AS (SELECT 's' || s_suppkey AS url, s_acctbal, row_number() OVER (ORDER BY md5('s' || s_suppkey),
    s_suppkey) AS n FROM supplier), sizes AS (SELECT (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM pages) AS p)
  SELECT url, printf('PT%05d', n) AS record_id FROM first WHERE s_acctbal < 5000
  UNION ALL SELECT url, printf('PT%05d', s + row_number() OVER (ORDER BY md5(url), url)) FROM pages, sizes
  UNION ALL SELECT 'c' || c_custkey, printf('PT%05d', s + p + row_number() OVER (ORDER BY md5('c' || c_custkey), c_custkey)) FROM customer, sizes""")
def _(spark, d):
    """Batches take their ranges before they write; the second is run twice, and deletes before the third give no number back."""
    ids = IdRanges(spark, new_path(spark, "ids"))
    batches = {"a": table(spark, d, "supplier").selectExpr("'s' || s_suppkey AS url", "s_acctbal"), "b": table(spark, d, "pages").select("url"),
               "b again": None, "c": table(spark, d, "customer").selectExpr("'c' || c_custkey AS url")}
    batches["b again"] = batches["b"]
    done = {}
    for name, rows in batches.items():
        first = ids.reserve("PT", name.split()[0], rows.count())
        done[name.split()[0]] = keyed.assign_record_ids(rows, "url", "PT", first - 1)
    done["a"] = done["a"].where("s_acctbal < 5000")
    return reduce(lambda x, y: x.unionByName(y), [x.select("url", "record_id") for x in done.values()])


# --- snapshots ----------------------------------------------------------------------------------------------------

_COLUMNS = {"record_id": "string", "bill_type": "string", "bill_size": "bigint", "law_id": "string"}


@query("S7_bucket_patch", REC + """SELECT r.record_id, CASE WHEN c.c_custkey IS NOT NULL THEN nullif(c.c_mktsegment, 'BUILDING') ELSE r.bill_type
    END AS bill_type, CASE WHEN s.s_suppkey IS NOT NULL THEN s.s_nationkey ELSE r.bill_size END AS bill_size, r.law_id
  FROM records r LEFT JOIN customer c ON r.record_id = 'R' || c.c_custkey LEFT JOIN supplier s ON r.record_id = 'R' || s.s_suppkey
  WHERE r.record_id NOT IN (SELECT 'R' || p_partkey FROM part WHERE p_size > 40)
  UNION ALL SELECT 'N' || r_regionkey, r_name, NULL, NULL FROM region""")
def _(spark, d):
    """Two patches, deletes and new rows in one pass over the buckets they touch, run twice under one name."""
    stored = Buckets(spark, new_path(spark, "snapshot"), "record_id", _COLUMNS, 16).create(records(spark, d))
    types = table(spark, d, "customer").selectExpr("'R' || c_custkey AS record_id", "nullif(c_mktsegment, 'BUILDING') AS bill_type")
    sizes = table(spark, d, "supplier").selectExpr("'R' || s_suppkey AS record_id", "cast(s_nationkey as bigint) AS bill_size")
    gone = table(spark, d, "part").where("p_size > 40").selectExpr("'R' || p_partkey AS record_id")
    new = table(spark, d, "region").selectExpr("'N' || r_regionkey AS record_id", "r_name AS bill_type", "cast(null as bigint) AS bill_size",
                                               "cast(null as string) AS law_id")
    for _ in range(2):
        stored.patch("batch", [(types, ["bill_type"]), (sizes, ["bill_size"])], gone, new)
    return stored.read()


_CHANGED = REC + """, now AS (SELECT record_id, law_id, date_passing, modified_laws FROM records WHERE bill_status = 'PASS'
  UNION ALL SELECT record_id, law_id, date_introduction, modified_laws FROM records WHERE bill_status = 'ONGOING'
  UNION ALL SELECT 'N' || record_id, law_id, '1990-01-01', modified_laws FROM records WHERE amendment_count = 3),
  edges AS (SELECT record_id, date_passing, unnest(modified_laws) AS law_id FROM now),
  rollup_ AS (SELECT law_id, count(*) AS affecting_laws_count, strftime(min(CAST(coalesce(try_strptime(date_passing, '%Y.%m.%d'),
    try_strptime(date_passing, '%Y-%m-%d')) AS DATE)), '%Y-%m-%d') AS affecting_laws_first_date FROM edges GROUP BY 1)
"""


def _advanced(spark, d):
    """The state of all records, after a batch that deletes, dates anew and adds; run twice under one name."""
    rows = records(spark, d).select("record_id", "law_id", "date_passing", "date_introduction", "modified_laws", "bill_status", "amendment_count")
    own = ["record_id", "law_id", "date_passing", "modified_laws"]
    stored = citation_state.store(rows, new_path(spark, "citations"), 16)
    before = rows.where("bill_status <> 'PASS'").select(*own)
    dated = rows.where("bill_status = 'ONGOING'").withColumn("date_passing", F.col("date_introduction")).select(*own)
    new = rows.where("amendment_count = 3").select(F.concat(F.lit("N"), "record_id").alias("record_id"), "law_id",
                                                  F.lit("1990-01-01").alias("date_passing"), "modified_laws")
    for _ in range(2):
        citation_state.advance(stored, before, dated.unionByName(new), "batch")
    return stored.read()


@query("A2_rollup_kept", _CHANGED + "SELECT * FROM rollup_")
def _(spark, d):
    return citation_state.rollup(_advanced(spark, d))


@query("A1_counts_kept", _CHANGED + "SELECT law_id, affecting_laws_count AS count FROM rollup_")
def _(spark, d):
    return citation_state.counts(_advanced(spark, d))


@query("J15_owned_rollup_kept", _CHANGED + """SELECT owner AS record_id, law_id, affecting_laws_count, affecting_laws_first_date FROM rollup_ JOIN
  (SELECT law_id, min(record_id) AS owner FROM now WHERE law_id IS NOT NULL GROUP BY 1) USING (law_id)""")
def _(spark, d):
    return citation_state.owned_rollup(_advanced(spark, d))


# --- amendment files ----------------------------------------------------------------------------------------------


ROWS_PER_SHARE = 500_000  # of all files' rows; a file is read by one task


@query("S4_amendment_headers", with_sql(AMENDMENT_ROWS) + """
  SELECT amendment_file_id, 'Title of ' || amendment_file_id AS bill_title, "Numéro de l'amendement" AS number, "Etape du texte" AS stage,
    CASE WHEN amendment_file_id NOT IN ('F1', 'F5') THEN "Auteur" END AS author, nullif("Cosignataire(s)", '') AS signers,
    "Sort de l'amendement" AS outcome, "URL Amendement" AS url FROM amendment_rows""")
def _(spark, d):
    """Files with their columns in three orders, some with unknown ones in front, some without the author; paths written in two ways.
    The more rows there are, the more files an id has."""
    path = new_path(spark, "amendment_files")
    rows = amendment_rows(spark, d).drop("bill_title")
    shares = max(1, -(-rows.count() // ROWS_PER_SHARE))
    share = F.pmod(F.xxhash64("Numéro de l'amendement"), F.lit(shares))
    names = [c for c in rows.columns if c != "amendment_file_id"]
    kinds = {0: names, 1: ["Extra", *reversed([n for n in names if n != "Auteur"])], 2: [*names[3:], "Extra", *names[:3]]}
    kind = F.when(F.col("amendment_file_id").isin("F1", "F5"), 1).when(F.col("amendment_file_id").isin("F2", "F3"), 2).otherwise(0)
    for k, order in kinds.items():
        own = rows.where(kind == k).withColumn("Extra", F.lit("a;b")).select("amendment_file_id", *order)
        own.repartition(max(spark.sparkContext.defaultParallelism, shares), "amendment_file_id", share).write.mode("append").partitionBy("amendment_file_id").options(**sinks.WRITE_OPTIONS, sep=";").csv(path)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(path).select("path")
    file_id = F.regexp_extract("path", "amendment_file_id=([^/]+)/", 1)
    other = F.when(file_id < "F3", F.regexp_replace("path", "^file:/*", "file:///")).otherwise(F.regexp_replace("path", "^file:/*", "/"))
    manifest = files.select(other.alias("file_path"), file_id.alias("amendment_file_id")).withColumn(
        "bill_title", F.concat(F.lit("Title of "), "amendment_file_id"))
    return tables.read_amendment_files(spark, f"{path}/*", manifest).select(
        "amendment_file_id", "bill_title", F.col("Numéro de l'amendement").alias("number"), F.col("Etape du texte").alias("stage"),
        F.col("Auteur").alias("author"), F.col("Cosignataire(s)").alias("signers"), F.col("Sort de l'amendement").alias("outcome"),
        F.col("URL Amendement").alias("url"))


# --- stored texts -------------------------------------------------------------------------------------------------


@query("S5_stored_text_cache", with_sql(RECORDS, DOC_TEXTS) + """
    , cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t FROM doc_texts), urls AS (
      SELECT record_id, bill_text_url AS url FROM records UNION ALL SELECT record_id, s.debate_url FROM (SELECT record_id,
      unnest(legislative_stages) AS s FROM records) WHERE s.debate_url IS NOT NULL)
    SELECT record_id, url, md5(t) AS text_md5, length(t) AS n FROM urls LEFT JOIN cache ON u = split_part(url, '#', 1)""")
def _(spark, d):
    """Texts written once; two look-ups, the second by another session's handle on the files."""
    cache = TextCache.write(doc_texts(spark, d), 8)
    again = TextCache.open(spark, cache.path, 8)
    rec = records(spark, d)
    stages = rec.select("record_id", F.explode("legislative_stages").alias("s")).selectExpr("record_id", "s.debate_url AS url").where("url is not null")
    read = {"text_md5": F.md5("extracted_text"), "n": F.length("extracted_text").cast("long")}
    found = [enrich.with_text(x, "url", c, derived=read).select("record_id", "url", "text_md5", "n") for x, c in (
        (rec.select("record_id", F.col("bill_text_url").alias("url")), cache), (stages, again))]
    return found[0].unionByName(found[1])


# --- late pages ---------------------------------------------------------------------------------------------------

_LAWS = """SELECT 'https://pt.example.org/bid=' || o_orderkey AS url, 'complete' AS outcome, (o_orderkey % 99) || '-A/' || year(o_orderdate)
  AS law_id, 'https://law.example.org/' || o_orderkey || '.pdf#x' AS law_text_url FROM orders WHERE o_orderkey % 4 = 3"""


@query("J1_late_law_pages", _LAWS)
def _(spark, d):
    """Three batches: the law pages of orders from 1995 on come with or before the bill pages, the others after, and all come once more."""
    source, out, state = (new_path(spark, n) for n in ("pages", "met", "state"))
    pages = portugal.pages(spark, d).drop("country")
    old = F.regexp_extract("html", "-A/([0-9]{4})", 1) < "1995"
    deliveries = [pages.where((F.col("kind") == "law") & ~old), pages.where("kind = 'main'"), pages.where(F.col("kind") == "law")]
    spark.createDataFrame([], halves.OUTPUT).write.parquet(out)

    def complete(rows, batch):
        rows.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/met={batch}")

    for part in deliveries:
        part.withColumn("country", F.lit("PORTUGAL")).select(*[c.split()[0] for c in PAGES.split(", ")]).write.mode("append").parquet(source)
        halves.late_laws(spark, source, state, complete).awaitTermination()
    return spark.read.schema(halves.OUTPUT).parquet(f"{out}/met=*").select("url", "outcome", "law_id", "law_text_url")


@query("PT_run_late_laws", with_sql(_rec("PT", portugal.SEL, portugal.FIELDS, _PT_DROP)) + f""",
  law AS (SELECT url AS law_url, law_id, split_part(law_text_url, '#', 1) AS law_text_url FROM ({_LAWS}))
  SELECT record_id, url, bill_status, law_id, CASE WHEN law_id IS NOT NULL THEN 'https://law.example.org/' ||
    split_part(url, '=', 2) || '.pdf#x' END AS law_text_url, CASE WHEN law_id IS NOT NULL THEN (CAST(split_part(url, '=', 2) AS BIGINT) % 50) || '/1999' END
    AS modified_laws, CASE WHEN law_id IS NOT NULL THEN false END AS original_law FROM rec LEFT JOIN law ON law_url = url""")
def _(spark, d):
    """A run over bill pages alone, then one over everything: the late law pages complete the stored records, whose ids stay."""
    topics = spark.createDataFrame([], "law_id string, topic_no int, topic string")
    pages, texts = portugal.pages(spark, d), portugal.law_texts(spark, d)
    first = materialise(collect.portuguese(pages.where("kind = 'main'"), texts, topics, meetings(spark, d)), "records")
    return collect.portuguese(pages, texts, topics, meetings(spark, d), first).select(
        "record_id", F.col("bill_page_url").alias("url"), "bill_status", "law_id", "law_text_url", joined("modified_laws").alias("modified_laws"),
        "original_law")


@query("FR_run_late_pages", with_sql(_rec("FR", france.SEL, france.FIELDS, where=f"WHERE {france.KEPT}")) + f"""
  SELECT record_id, url, CASE WHEN prom THEN '2009-' || k END AS modified_laws, CASE WHEN prom THEN 1 END AS modified_laws_count, CASE WHEN prom THEN
    false END AS original_law, CASE WHEN prom THEN '' || k END AS final_vote_for, CASE WHEN prom THEN '3' END AS final_vote_against
  FROM (SELECT record_id, url, o_custkey AS k, {france.PROM} AS prom FROM rec JOIN orders ON CAST(regexp_extract(url, '([0-9]+)$', 1) AS BIGINT) =
    o_orderkey)""")
def _(spark, d):
    """A run over dossiers without their law and vote pages, then one over everything."""
    pages, texts, people = france.pages(spark, d), france.pdf_texts(spark, d), members(spark, d)
    rows = amendment_rows(spark, d).where("false")
    first = materialise(collect.french(pages.where("kind not in ('law', 'votes')"), texts, people, rows), "records")
    return collect.french(pages, texts, people, rows, first).select(
        "record_id", F.col("bill_page_url").alias("url"), joined("modified_laws").alias("modified_laws"), "modified_laws_count", "original_law",
        "final_vote_for", "final_vote_against")


# --- exports of runs ----------------------------------------------------------------------------------------------

def _sorted(sql: str) -> str:
    return f"nullif(array_to_string(list_sort(string_split(coalesce({sql}, ''), ';')), ';'), '')"


def _exported(spark, run, country: str, main: list[str], committee: list[str]):
    """One row per exported main row, with what the other tables say of its record."""
    paths = sinks.export(materialise(run, "records"), new_path(spark, "export"), country, "day")
    read = {n: sinks.read_table(spark, p, EXPORT_COLUMNS[n]) for n, p in paths.items()}
    out = read["bill_main_table"].select("record_id", *main)
    said = {"originators": F.concat_ws("=", "originator_name", "originator_affiliation"),
            "committees": F.concat_ws("/", *[F.coalesce(c, F.lit("-")) for c in committee]),
            "legislative_stages": F.concat_ws(" ", "date", "name"),
            "amendments": F.concat_ws(" ", F.coalesce("amendment_id", "amendment_text_url"), "amendment_outcome"),
            "modified_laws": F.concat_ws("=", "modified_law_id", "modified_record_id"),
            "affecting_laws": F.concat_ws("=", "affecting_law_id", "affecting_record_id"),
            "bill_text": F.md5("bill_text"), "law_text": F.length("law_text").cast("string"), "impact_assessments": F.col("ia_text_url")}
    for name, value in said.items():
        items = read[name].groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_list(value)), ";").alias(f"t_{name}"))
        out = out.join(items, "record_id", "left")
    return out


_MAIN = ["bill_id", "bill_title", "bill_status", "origin_type", "date_introduction", "date_committee", "date_passing", "stages_count",
         "committee_count", "bill_text_url", "ia_dummy", "final_vote_for", "final_vote_against", "law_id", "affecting_laws_count",
         "affecting_laws_first_date", "original_law"]
_LAW = portugal.LAW.replace("'-A/'", "'/'")
_LAW_TEXT = """concat('Primeira alteração à Lei n.º ', o_custkey % 99, '/', year(o_orderdate), '.\\n')"""


@query("PT_run_export", with_sql(DOC_TEXTS, _rec("PT", portugal.SEL + "*, ", portugal.FIELDS, _PT_DROP)) + f""",
  cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t FROM doc_texts),
  r AS (SELECT * , CASE WHEN {portugal.PUBLISHED} THEN (o_orderkey % 99) || '/' || year(o_orderdate) END AS law_id, CASE WHEN
    {portugal.PUBLISHED} THEN (o_custkey % 99) || '/' || year(o_orderdate) END AS cited FROM rec),
  own AS (SELECT law_id AS l, min(record_id) AS owner FROM r WHERE law_id IS NOT NULL GROUP BY 1),
  hit AS (SELECT owner AS record_id, count(*) AS n, min(date_passing) AS first, string_agg(r.law_id || '=' || r.record_id, ';' ORDER BY
    r.law_id || '=' || r.record_id) AS laws FROM r JOIN own ON l = cited GROUP BY 1)
  SELECT r.record_id, bill_id, bill_title, bill_status, origin_type, date_introduction, date_committee, date_passing, '' || stages_count AS stages_count,
    '' || committee_count AS committee_count, bill_text_url, '' || ia_dummy AS ia_dummy, final_vote_for, final_vote_against, law_id, '' || n AS
    affecting_laws_count, first AS affecting_laws_first_date, CASE WHEN law_id IS NOT NULL THEN 'false' END AS original_law,
    {_sorted('originators')} AS t_originators, array_to_string(list_sort(list_transform(string_split(committees, ';'), lambda x: x || '/-')), ';')
    AS t_committees, {_sorted('legislative_stages')} AS t_legislative_stages, CASE WHEN o_orderkey % 5 = 0 THEN (
      SELECT string_agg(x, ';' ORDER BY x) FROM (SELECT {portugal.sql_doc('o_orderkey + i')} || CASE WHEN o_orderkey % 10 = 0 THEN ' APPROVED' ELSE '' END
      AS x FROM range(1, 3) t(i))) END AS t_amendments,
    CASE WHEN cited IS NOT NULL THEN cited || coalesce('=' || owner, '') END AS t_modified_laws, laws AS t_affecting_laws, md5(t) AS t_bill_text,
    CASE WHEN cited IS NOT NULL THEN '' || length('Primeira alteração à Lei n.º ' || cited || '..') END AS t_law_text, ia_text_url AS t_impact_assessments
  FROM r LEFT JOIN own ON l = cited LEFT JOIN hit USING (record_id) LEFT JOIN cache ON u = bill_text_url""")
def _(spark, d):
    pages = portugal.pages(spark, d).where("kind = 'main'")
    laws = page_rows(spark, d, "orders", ["'PORTUGAL' AS country", f"{portugal.URL} AS url", "'law' AS kind",
                                          f"case when o_orderkey % 4 = 3 then {_LAW} end AS html"]).where("html is not null")
    texts = doc_texts(spark, d).unionByName(page_rows(spark, d, "orders", [
        "'law' AS collection", "concat('https://law.example.org/', o_orderkey, '.pdf') AS url", "1L AS size", f"{_LAW_TEXT} AS extracted_text",
        "1L AS text_size"]))
    topics = spark.createDataFrame([], "law_id string, topic_no int, topic string")
    run = collect.portuguese(pages.unionByName(laws), texts, topics, meetings(spark, d))
    return _exported(spark, run, "PORTUGAL", _MAIN, ["committee_name", "committee_role"])


_DE_MAIN = ["bill_id", "bill_title", "bill_status", "origin_type", "date_introduction", "date_passing", "date_entering_into_force", "bill_type",
            "stages_count", "committee_count", "committee_hearing_count", "bill_text_url", "law_text_url"]


@query("DE_run_export", with_sql(DOC_TEXTS, _rec("DE", germany.SEL, germany.FIELDS, ["amendments"])) + f"""
  SELECT record_id, bill_id, bill_title, bill_status, origin_type, date_introduction, date_passing, date_entering_into_force, bill_type,
    '' || stages_count AS stages_count, '' || committee_count AS committee_count, '' || committee_hearing_count AS committee_hearing_count,
    bill_text_url, law_text_url, {_sorted('originators')} AS t_originators, {_sorted('committees')} AS t_committees, stages_count AS n_stages FROM rec""")
def _(spark, d):
    cells = spark.createDataFrame([], "url string, page int, table_no int, `row` int, col int, text string")
    run = collect.german(germany.pages(spark, d), doc_texts(spark, d), cells, vote_texts(spark, d))
    out = _exported(spark, run, "GERMANY", _DE_MAIN, ["committee_name", "committee_role", "committee_date"])
    stages = F.when(F.col("t_legislative_stages").isNotNull(), F.size(F.split("t_legislative_stages", ";"))).otherwise(0).alias("n_stages")
    return out.select("record_id", *_DE_MAIN, "t_originators", "t_committees", stages)


_FR_MAIN = ["bill_title", "origin_type", "amendment_count", "stages_count"]
_TR = """concat('<tr data-href="/d/', r_regionkey, '"><td>1</td><td> L', r_regionkey, '\\n</td><td/><td/><td/><td>', case when r_regionkey % 2 = 0
  then 'Adopté' else 'Irrecevable' end, '</td><td></td><td>5 mai 2011</td></tr>')"""


@query("FR_run_export", with_sql(AMENDMENT_ROWS, _rec("FR", france.SEL, france.FIELDS, where=f"WHERE {france.KEPT}")) + f""",
  listed AS (SELECT string_agg(x, ';' ORDER BY x) AS x FROM (SELECT 'L' || r_regionkey || '/' || CASE WHEN r_regionkey % 2 = 0 THEN 'ACCEPTED' ELSE
    'INADMISSIBLE' END || '/' || CASE WHEN r_regionkey < 3 THEN 'Lois ' || r_regionkey ELSE '-' END || '//d/' || r_regionkey AS x FROM region)),
  own AS (SELECT bill_title AS title, min(record_id) AS record_id FROM rec WHERE amendment_count IS NULL GROUP BY 1),
  got AS (SELECT record_id, count(*) AS n, string_agg(x, ';' ORDER BY x) AS x FROM (SELECT record_id, "Numéro de l'amendement" || '/' || CASE
    "Sort de l'amendement" WHEN 'Adopté' THEN 'ACCEPTED' WHEN 'Tombé' THEN 'REJECTED' ELSE 'Autre' END || '/' || 'Com ' || o_custkey || '/' ||
    'https://www.assemblee-nationale.fr/v/' || o_orderkey || '.pdf' AS x FROM amendment_rows JOIN own ON title = replace(bill_title, 'Projet', 'Titre é')
    JOIN orders ON "URL Amendement" = 'https://am.example.org/' || o_orderkey) GROUP BY 1)
  SELECT record_id, bill_title, origin_type, '' || coalesce(n, amendment_count) AS amendment_count, '' || stages_count AS stages_count,
    CASE WHEN amendment_count IS NOT NULL THEN (SELECT x FROM listed) ELSE got.x END AS t_amendments
  FROM rec LEFT JOIN got USING (record_id)""")
def _(spark, d):
    """With list pages, the pages of their amendments, and the own pages of amendments from files."""
    region = table(spark, d, "region")
    lists = region.selectExpr("r_regionkey", f"{_TR} AS tr").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
        "r_regionkey", "tr"))), lambda x: x["tr"]), "").alias("rows")).selectExpr(
        "'FRANCE' AS country", "'https://www.assemblee-nationale.fr/am/1' AS url", "'amendments' AS kind",
        "concat('<table><tbody id=\"tbody-amendements-list\">', rows, '</tbody></table>') AS html")
    details = region.where("r_regionkey < 3").selectExpr(
        "'FRANCE' AS country", "concat('https://www.assemblee-nationale.fr/d/', r_regionkey) AS url", "'amendment' AS kind",
        "concat('<div><b>Examiné par</b><span>Lois ', r_regionkey, '</span></div>') AS html")
    own = page_rows(spark, d, "orders", ["'FRANCE' AS country", "concat('https://am.example.org/', o_orderkey) AS url", "'amendment_page' AS kind",
                                         "concat('<p><b>Examiné par</b> <a>Com ', o_custkey, '</a></p><a href=\"/v/', o_orderkey, "
                                         "'.pdf\"><span>Version PDF</span></a>') AS html"])
    pages = reduce(lambda x, y: x.unionByName(y), [france.pages(spark, d), lists, details, own])
    rows = amendment_rows(spark, d).withColumn("bill_title", F.regexp_replace("bill_title", "^Projet", "Titre é"))
    run = materialise(collect.french(pages, france.pdf_texts(spark, d), members(spark, d), rows), "records")
    paths = sinks.export(run, new_path(spark, "export"), "FRANCE", "day")
    read = {n: sinks.read_table(spark, p, EXPORT_COLUMNS[n]) for n, p in paths.items()}
    amendment = F.concat_ws("/", *[F.coalesce(c, F.lit("-")) for c in (
        "amendment_id", "amendment_outcome", "amendment_committee_name", "amendment_text_url")])
    items = read["amendments"].groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_list(amendment)), ";").alias("t_amendments"))
    return read["bill_main_table"].select("record_id", *_FR_MAIN).join(items, "record_id", "left")


# --- counts of a run ----------------------------------------------------------------------------------------------


@query("X_run_counts", f"""WITH n AS (SELECT count(*) AS n, count(*) FILTER ({portugal.PUBLISHED}) AS laws, count(*) FILTER (doc_id IS NOT NULL) AS texts
  FROM orders LEFT JOIN documents ON doc_id = o_orderkey + 1)
  SELECT 'pages' AS step, unnest(['rows', 'no_bill_id', 'no_bill_title', 'no_origin_type', 'no_date_introduction', 'no_bill_text_url']) AS cause,
    unnest([n + 1, 1, 1, 1, 1, 1]) AS n FROM n
  UNION ALL SELECT 'records', unnest(['rows', 'no_bill_id', 'no_bill_text', 'no_law_id']), unnest([n + 1, 1, n + 1 - texts, n + 1 - laws]) FROM n""")
def _(spark, d):
    """Pages in, records out and what was not found, from the run's own jobs; one page is broken."""
    counts = Counts()
    broken = spark.createDataFrame([("PORTUGAL", "https://pt.example.org/broken", "main", "<p>no such page</p>")], PAGES)
    pages = portugal.pages(spark, d).select("country", "url", "kind", "html").unionByName(broken)
    topics = spark.createDataFrame([], "law_id string, topic_no int, topic string")
    collect.portuguese(pages, portugal.law_texts(spark, d), topics, meetings(spark, d), counts=counts)
    return counts.rows(spark)
