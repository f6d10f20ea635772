"""Record, text and page tables derived from the given tables, once for Spark and once as DuckDB SQL.

Every nested record comes from one `orders` row, so deriving it needs no shuffle and no group. Expressions are written
once; `_Dialect` fills in what the two engines spell differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from queries.registry import table


class _Dialect:
    def __init__(self, spark: bool):
        self.spark = spark

    def day(self, expr: str, form: str = "iso") -> str:
        formats = {"iso": ("yyyy-MM-dd", "%Y-%m-%d"), "dot": ("yyyy.MM.dd", "%Y.%m.%d"), "de": ("dd.MM.yyyy", "%d.%m.%Y"),
                   "y": ("yyyy", "%Y")}
        own, duck = formats[form]
        return f"date_format({expr}, '{own}')" if self.spark else f"strftime({expr}, '{duck}')"

    def later(self, expr: str, days: str) -> str:
        return f"date_add(to_date({expr}), cast({days} as int))" if self.spark else \
            f"(CAST({expr} AS DATE) + CAST({days} AS INTEGER))"

    def struct(self, fields: dict[str, str]) -> str:
        if self.spark:
            return "named_struct(" + ", ".join(f"'{n}', {e}" for n, e in fields.items()) + ")"
        return "{" + ", ".join(f"'{n}': {e}" for n, e in fields.items()) + "}"

    def each(self, count: str, item: str) -> str:
        """List of `item` for i = 1 .. count."""
        if self.spark:
            return f"transform(filter(sequence(0, cast({count} as int)), i -> i > 0), i -> {item})"
        return f"list_transform(range(1, CAST({count} AS INTEGER) + 1), lambda i: {item})"

    def list(self, items: list[str]) -> str:
        return ("array(" if self.spark else "[") + ", ".join(items) + (")" if self.spark else "]")

    def distinct(self, expr: str) -> str:
        """Distinct non-null items."""
        if self.spark:
            return f"array_distinct(filter({expr}, x -> x is not null))"
        return f"list_sort(list_distinct({expr}))"

    @property
    def text(self) -> str:
        return "string" if self.spark else "varchar"


def _record_fields(d: _Dialect) -> dict[str, str]:
    k, c, day = "o_orderkey", "o_custkey", "o_orderdate"
    null = f"cast(null as {d.text})"
    number = "cast(null as int)"
    size = "cast(null as bigint)"
    stage = d.struct({
        "number": number,
        "name": "case when i % 3 = 1 then 'Dépôt' when i % 3 = 2 then '1. Beratung' else 'Promulgation' end",
        "date": d.day(d.later(day, "10 * i")),
        "house": "case when i % 2 = 0 then 'LOWER' else 'UPPER' end",
        "debate_size": f"case when i % 4 = 0 then cast(100 + {k} as bigint) end",
        "debate_url": f"case when i % 2 = 1 then 'https://docs.example.org/' || ({k} + i) || '.pdf' || "
                      f"case when {k} % 3 = 0 then '#page=3' else '' end end",
    })
    amendment = d.struct({
        "amendment_id": f"{k} || '/' || i",
        "amendment_stage_name": "case when i % 2 = 0 then '1. Beratung' else 'Promulgation' end",
        "amendment_stage_number": number, "amendment_date": d.day(day),
        "amendment_plenary": "case when i % 3 = 0 then 'Bundestag' when i % 3 = 1 then 'BUNDESRAT' else 'EP' end",
        "amendment_originator": d.list([f"'Author ' || ({c} % 100)", "'Author ' || i"]),
        "amendment_originator_aff": null, "amendment_committee_name": null,
        "amendment_text_url": f"'https://docs.example.org/' || ({k} + i) || '.pdf'",
        "amendment_text": null, "amendment_text_size": size, "amendment_outcome": null, "amendment_vote_for": null,
        "amendment_vote_against": null, "amendment_vote_abst": null,
        "amendment_page_link": f"'https://am.example.org/' || ({k} * 3 + i)",
    })
    committee = d.struct({
        "committee_name": f"'Ausschuss ' || (({k} + i) % 3)",
        "committee_role": "case when i = 1 then 'Lead' end",
        "committee_date": d.day(day, "dot"),
    })
    originator = d.struct({
        "originator_name": f"'Author ' || ({c} % 100 + i - 1)",
        "originator_affiliation": f"case when i = 1 then 'Party ' || ({c} % 5) end",
    })
    laws = d.distinct(d.list([f"'' || {c}", f"'' || ({k} * 7 % 997)", f"case when {k} % 3 = 0 then '8' end"]))
    return {
        "record_id": f"'R' || {k}",
        "country": f"case when {k} % 3 = 0 then 'FRANCE' when {k} % 3 = 1 then 'GERMANY' else 'PORTUGAL' end",
        "bill_page_url": f"'https://bills.example.org/doc/' || {k} || case when {k} % 4 = 0 then '#top' else '' end",
        "bill_id": f"({k} % 400) || '/XIV/' || ({k} % 3 + 1)",
        "bill_title": f"'Loi ' || {c} || ' - ' || o_orderpriority",
        "bill_status": "case o_orderstatus when 'F' then 'PASS' when 'O' then 'ONGOING' else 'REJECT' end",
        "law_id": f"case when o_orderstatus = 'F' then '' || ({k} - {k} % 2) end",
        "origin_type": "case when o_orderpriority in ('1-URGENT', '2-HIGH') then 'GOVERNMENT' else 'INDIVIDUAL_MP' end",
        "originators": d.each(f"{k} % 3", originator),
        "date_introduction": d.day(day),
        "date_passing": f"case when {k} % 3 = 2 then null when {k} % 13 = 0 then 'unbekannt' "
                        f"when {k} % 2 = 0 then {d.day(day, 'dot')} else {d.day(day)} end",
        "legislative_stages": d.each(f"1 + {k} % 5", stage),
        "stages_count": f"cast(1 + {k} % 5 as int)",
        "plenary_size": f"case when {k} % 6 <> 0 then cast({k} * 3 as bigint) end",
        "committees": d.each(f"{k} % 4", committee),
        "committee_count": f"cast({k} % 4 as int)",
        "committee_hearing_count": f"case when {k} % 5 <> 0 then cast({k} % 7 as int) end",
        "modified_laws": f"case when {k} % 11 = 0 then null when {k} % 5 = 0 then "
                         f"{'cast(array() as array<string>)' if d.spark else 'CAST([] AS VARCHAR[])'} else {laws} end",
        "bill_text_url": f"case when {k} % 8 <> 0 then 'https://docs.example.org/' || {k} || '.pdf' || "
                         f"case when {k} % 3 = 0 then '#a' else '' end end",
        "bill_size": f"case when {k} % 2 = 0 then cast({k} as bigint) end",
        "amendments": f"case when {k} % 9 = 0 then null else {d.each(f'{k} % 4', amendment)} end",
        "amendment_count": f"cast({k} % 4 as int)",
        "ia_dummy": f"{k} % 2 = 0",
        "ia_date": f"case when {k} % 4 = 0 then {d.day(day)} end",
        "ia_text1": f"case when {k} % 3 = 0 then 'Alternativen ' || {c} end",
        "ia_text2": f"case when {k} % 5 = 0 then 'Folgen ' || {c} end",
        "ia_text_url": f"case when {k} % 7 = 0 then 'https://ia.example.org/' || {k} end",
        "original_law": f"{k} % 5 = 0",
        "final_vote_for": f"case when {k} % 4 = 1 then '' || ({k} % 300) end",
        "final_version_printed_matter_id": f"case when {k} % 2 = 0 then '20/' || ({k} % 5000) end",
        "law_text_url": f"case when {k} % 2 = 0 then 'https://www.bgbl.de/xaver/bgbl/' || {k} "
                        f"else 'https://law.example.org/' || {k} end",
        "bill_type": f"case when {k} % 10 = 0 then 'Old topic' end",
    }


_SPARK_FIELDS = _record_fields(_Dialect(True))
RECORDS = "records AS (SELECT " + ",\n  ".join(
    f"{e} AS {n}" for n, e in _record_fields(_Dialect(False)).items()) + " FROM orders)"


def records(spark: SparkSession, folder: str) -> DataFrame:
    return page_rows(spark, folder, "orders", [f"{e} AS {n}" for n, e in _SPARK_FIELDS.items()])


# Text cache: one document per URL.
DOC_TEXTS = """doc_texts AS (SELECT source AS collection,
  'https://docs.example.org/' || doc_id || '.pdf' || CASE WHEN doc_id % 5 = 0 THEN '#page=1' ELSE '' END AS url,
  n_chars AS size, text AS extracted_text, n_chars AS text_size
  FROM documents)"""


def doc_texts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").selectExpr(
        "source AS collection",
        "'https://docs.example.org/' || doc_id || '.pdf' || case when doc_id % 5 = 0 then '#page=1' else '' end AS url",
        "n_chars AS size", "text AS extracted_text", "n_chars AS text_size")


# Members: suppliers sit in the upper house, customers in the lower; names repeat.
MEMBERS = """members AS (
  SELECT 'UPPER' AS house, 'S' || s_suppkey AS page_id, 'Author ' || (s_suppkey % 60) AS parsed_name,
    CASE WHEN s_suppkey % 4 <> 0 THEN 'Group ' || s_nationkey END AS parsed_affiliation FROM supplier
  UNION ALL
  SELECT 'LOWER', 'C' || c_custkey, 'Author ' || (c_custkey % 90), c_mktsegment FROM customer)"""


def members(spark: SparkSession, folder: str) -> DataFrame:
    upper = table(spark, folder, "supplier").selectExpr(
        "'UPPER' AS house", "'S' || s_suppkey AS page_id", "'Author ' || (s_suppkey % 60) AS parsed_name",
        "case when s_suppkey % 4 <> 0 then 'Group ' || s_nationkey end AS parsed_affiliation")
    lower = table(spark, folder, "customer").selectExpr(
        "'LOWER' AS house", "'C' || c_custkey AS page_id", "'Author ' || (c_custkey % 90) AS parsed_name",
        "c_mktsegment AS parsed_affiliation")
    return upper.unionByName(lower)


# Amendment file rows: one per line item, titled by its part.
_ROW = {
    "amendment_file_id": "'F' || (l_partkey % 7)",
    "bill_title": "'Projet ' || l_partkey",
    "Numéro de l'amendement": "l_orderkey || '-' || l_linenumber",
    "Etape du texte": "case when l_linenumber % 2 = 0 then '1ère lecture' else 'Lecture définitive' end",
    "Titre complet": "'Projet de loi n° ' || l_partkey",
    "Auteur": "(l_suppkey % 90) || ' Author'",
    "Cosignataire(s)": "case when l_linenumber % 3 = 0 then '' else 'Ann ' || l_linenumber || ',  Bo, ' end",
    "Sort de l'amendement": "case l_returnflag when 'A' then 'Adopté' when 'N' then 'Tombé' else 'Autre' end",
    "URL Amendement": "'https://am.example.org/' || l_orderkey",
}
AMENDMENT_ROWS = "amendment_rows AS (SELECT " + ", ".join(f'{e} AS "{n}"' for n, e in _ROW.items()) + " FROM lineitem)"


def amendment_rows(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(*[f"{e} AS `{n}`" for n, e in _ROW.items()])


# Bills titled by part; every third already has amendments.
TITLED = """titled AS (SELECT 'P' || p_partkey AS record_id, 'Projet ' || p_partkey AS bill_title,
  CASE WHEN p_partkey % 3 = 0 THEN ['x'] WHEN p_partkey % 3 = 1 THEN CAST([] AS VARCHAR[]) END AS amendments,
  CAST(p_partkey % 3 AS INTEGER) AS amendment_count FROM part)"""


def titled_bills(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "'P' || p_partkey AS record_id", "'Projet ' || p_partkey AS bill_title",
        "case when p_partkey % 3 = 0 then array('x') when p_partkey % 3 = 1 then cast(array() as array<string>) end "
        "AS amendments", "cast(p_partkey % 3 as int) AS amendment_count")


# Debates: a conversation is a bill, a turn one debate of the stage (turn modulo 3) in the house of its role.
DEBATES = """debates AS (SELECT 'V' || conv_id AS record_id, 'Stage ' || (turn % 3) AS name,
  CASE role WHEN 'user' THEN 'LOWER' WHEN 'assistant' THEN 'UPPER' ELSE 'JOINT' END AS house,
  CASE WHEN turn % 7 = 6 THEN NULL ELSE text END AS debate_text, turn FROM conversations)"""


def debates(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations").selectExpr(
        "'V' || conv_id AS record_id", "'Stage ' || (turn % 3) AS name",
        "case role when 'user' then 'LOWER' when 'assistant' then 'UPPER' else 'JOINT' end AS house",
        "case when turn % 7 = 6 then null else text end AS debate_text", "turn")


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def joined(column, sep: str = ";"):
    """List column as text, NULL items as '-'."""
    return F.array_join(column, sep, "-")


# White space of Unicode as a character class for the SQL side, whose \\s knows ASCII only.
SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


PAGES_PER_TASK = 25_000


def page_rows(spark, d, name: str, columns: list[str]):
    """Pages composed from a table's rows. The table is dealt out first, as its few files make far larger pages: to all cores, and to more tasks
    the more rows there are, so that a task's work stays the same."""
    rows = table(spark, d, name)
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // PAGES_PER_TASK))
    return rows.repartition(tasks, rows.columns[0]).selectExpr(*columns)
