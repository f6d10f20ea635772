"""Portuguese pages composed from orders and read back; the SQL says what the row put in."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.operators.keyed import patch
from lexmill.plans import portugal as P
from queries.inputs import DOC_TEXTS, doc_texts, joined, page_rows, with_sql
from queries.registry import query
from queries.texts import PORTUGUESE_MONTH_NAMES, sql_dense

URL = "concat('https://pt.example.org/bid=', o_orderkey)"
DOC = "'https://docs.example.org/{}.pdf'"


def rep(count: str, item: str) -> str:
    """`item` for i = 1 .. count, one after the other."""
    return f"array_join(transform(filter(sequence(0, cast({count} as int)), i -> i > 0), i -> concat({item})), '')"


def doc_url(expr: str) -> str:
    return f"'https://docs.example.org/', {expr}, '.pdf'"


STAGE = ("element_at(array('Entrada', 'Baixa comissão distribuição inicial generalidade', 'Votação na generalidade', "
         "'Lei (Publicação DR)'), i)")
MAIN = f"""concat('<div id="contentBox">', case when o_orderkey % 7 = 1 then '<b>Rejeitado</b><i>Contra: AA</i>' else '' end,
 '\\n<span class="Titulo-Cinzento">', case when o_orderkey % 2 = 0 then 'Proposta de Lei ' else ' Projeto de Lei ' end,
 o_orderkey % 2000, '/XIV/2</span>\\n<div><span title="Detalhe do documento">Título &amp; ', o_custkey,
 '</span> [formato DOC]\\n [formato PDF]</div>\\n\\n',
 {rep("o_orderkey % 3", '''"<a title='Detalhe do autor'>Author ", o_custkey % 100 + i, " (P", i, ")</a>"''')},
 '<div>Parecer da comissão</div>\\n<p><a href="/x">y</a><a href="', {doc_url("o_orderkey")}, '">Parecer</a></p>\\n',
 '<a href="', {doc_url("o_orderkey + 1")}, '">[formato PDF]</a>\\n',
 case when o_orderkey % 3 > 0 then concat('<div><span> A. I. G. </span><i>x</i><a href="', {doc_url("o_orderkey + 2")},
   '">[formato PDF]</a></div>\\n') else '' end,
 {rep("1 + o_orderkey % 4", f'''"<tr><td><span>", date_format(date_add(o_orderdate, 10 * i), 'yyyy-MM-dd'),
   "</span></td><td><span>", {STAGE}, "</span></td></tr>\\n"''')},
 case when o_orderkey % 4 = 3 then '<p><a href="/a/DetalheDiplomaAprovado.aspx?BID=1">lei</a></p>' else '' end,
 '<span>Comissão de A', o_orderkey % 7, '</span><span>comissão de B</span><span>COMISSÃO DE A', o_orderkey % 7,
 '</span><span>comissão de B</span>\\n<div class="Titulo-Cinzento"> Pedidos parecer a </div>',
 {rep("o_orderkey % 3", '"<span>Audição de ", i, "</span>"')},
 '<div class="x Titulo-Cinzento">Outros</div>', case when o_orderkey % 2 = 0 then '<span>Audiência</span>' else '' end,
 {rep("case when o_orderkey % 5 = 0 then 2 else 0 end", f'''"<p><span>Admissão Proposta de Alteração</span><span>[", i,
   "] do PS-X e PCP</span><a href='a.html'>h</a><a href='", {doc_url("o_orderkey + i")}, "'>t</a></p>"''')},
 '<p><span>Votação na especialidade</span>', case when o_orderkey % 10 = 0 then '<b>Aprovado</b>' else '' end,
 '<span>a alteração</span><i>A Favor: PS Contra: CH, ', o_custkey, '</i></p>\\n',
 case when o_orderkey % 2 = 0 then concat('<span>Votação final global</span><table><tr><td>A Favor: PS,  L', o_custkey,
   '</td></tr><tr><td>Contra: PSD</td></tr></table>') else '' end,
 case when o_orderkey % 11 = 0 then '<span>Iniciativa Caducada</span>' else '' end, '\\n',
 case when o_orderkey % 7 = 0 then concat('<b>Rejeitado</b><i>Contra: PCP', o_custkey, ' Abstenção: BE</i>') else '' end,
 '</div>')"""

_DATE = "date_add(o_orderdate, 20)"
LAW = f"""concat('<html><div class="Titulo-Cinzento"><span>Lei n.º ', o_orderkey % 99, '-A/', year(o_orderdate),
 ' de hoje</span></div><p><span>Ver texto</span> <a href="', concat('https://law.example.org/', o_orderkey, '.pdf#x'),
 '">[formato PDF]</a></p></html>')"""
LAW_TEXT = f"""concat('Primeira alteração à Lei n.º ', o_orderkey % 50, '/1999.\\nArtigo 1.º\\n', case when o_orderkey % 8 = 3
 then 'Entrada em vigor\\nA lei entra em vigor 30 dias após a publicação.' else concat('Entrada em vigor\\nEntra em vigor a ',
 day({_DATE}), ' de ', element_at(array({', '.join(repr(n) for n in PORTUGUESE_MONTH_NAMES)}), month({_DATE})), ' de ',
 year({_DATE}), '.') end)"""


def pages(spark, d):
    # One branch per kind, so that a reader of one kind has only that composed.
    dealt = page_rows(spark, d, "orders", ["*"])
    own = [dealt.selectExpr("'PORTUGAL' AS country", f"{URL} AS url", f"'{k}' AS kind", f"{h} AS html").where("html is not null")
           for k, h in (("main", MAIN), ("law", f"case when o_orderkey % 4 = 3 then {LAW} end"))]
    return own[0].unionByName(own[1])


def mains(spark, d):
    return page_rows(spark, d, "orders", ["o_orderkey", f"{URL} AS url", f"{MAIN} AS html"]).select("url", "html")


def laws(spark, d):
    return page_rows(spark, d, "orders", [f"{URL} AS url", f"{LAW} AS html", "o_orderkey"]).select("url", "html")


def law_texts(spark, d):
    own = page_rows(spark, d, "orders", [
        "'law' AS collection", "concat('https://law.example.org/', o_orderkey, '.pdf') AS url", "1L AS size",
        f"{LAW_TEXT} AS extracted_text", "1L AS text_size"])
    return doc_texts(spark, d).unionByName(own)


SEL = "SELECT 'https://pt.example.org/bid=' || o_orderkey AS url, "
PUBLISHED, LATE = "o_orderkey % 4 = 3", "(o_orderkey % 7 = 0 AND o_orderkey % 4 <> 3)"


def day(i: str) -> str:
    return f"strftime(o_orderdate + to_days(CAST(10 * ({i}) AS INTEGER)), '%Y-%m-%d')"


def sql_doc(expr: str) -> str:
    return f"'https://docs.example.org/' || ({expr}) || '.pdf'"


def each(n: str, item: str, sep: str = ";") -> str:
    return f"array_to_string(list_transform(range(1, CAST({n} AS INTEGER) + 1), lambda i: {item}), '{sep}')"


FIELDS = []  # (columns, SQL, formatting) of each query below, for the check of whole records


def fields(name: str, columns: list[str], sql: str, post=None):
    FIELDS.append((columns, sql, post))

    @query(name, SEL + sql + " FROM orders")
    def _(spark, d):
        out = P.main_fields(mains(spark, d)).select("url", *columns)
        return post(out) if post else out


fields("X-PT1_id_type_title", ["bill_id", "origin_type", "bill_title"], """(o_orderkey % 2000) || '/XIV/2' AS bill_id,
  CASE WHEN o_orderkey % 2 = 0 THEN 'GOVERNMENT' ELSE 'INDIVIDUAL_MP' END AS origin_type,
  'Título & ' || o_custkey AS bill_title""")
fields("X-PT2_originators", ["originators"], each(
    "o_orderkey % 3", "'Author ' || (o_custkey % 100 + i) || '=P' || i") + " AS originators",
    lambda df: df.withColumn("originators", joined(F.transform("originators", lambda o: F.concat_ws(
        "=", o["originator_name"], o["originator_affiliation"])))))
fields("X-PT3_committees", ["committees", "committee_count"], """'COMISSÃO DE A' || (o_orderkey % 7) || ';Comissão de A' ||
    (o_orderkey % 7) || ';comissão de B' AS committees, CAST(3 AS INTEGER) AS committee_count""",
    lambda df: df.withColumn("committees", joined(F.transform("committees", lambda c: c["committee_name"]))))
fields("X-PT4_report_link", ["report_url"], sql_doc("o_orderkey") + " AS report_url")
fields("X-PT5_bill_text_link", ["bill_text_url"], sql_doc("o_orderkey + 1") + " AS bill_text_url")
_STAGES = ("['Entrada', 'Baixa comissão distribuição inicial generalidade', 'Votação na generalidade', "
           "'Lei (Publicação DR)'][i]")
fields("X-PT6_stages", ["legislative_stages", "stages_count", "date_introduction", "date_committee", "date_passing"],
       each("1 + o_orderkey % 4", f"{day('i')} || ' ' || {_STAGES}") + f""" AS legislative_stages,
       CAST(1 + o_orderkey % 4 AS INTEGER) AS stages_count, {day('1')} AS date_introduction,
       CASE WHEN o_orderkey % 4 > 0 THEN {day('2')} END AS date_committee,
       CASE WHEN {PUBLISHED} THEN {day('4')} END AS date_passing""",
       lambda df: df.withColumn("legislative_stages", joined(F.transform("legislative_stages", lambda s: F.concat_ws(
           " ", s["date"], s["name"])))))
fields("X-PT7_impact_link", ["ia_dummy", "ia_text_url", "ia_title"], f"""o_orderkey % 3 > 0 AS ia_dummy,
    CASE WHEN o_orderkey % 3 > 0 THEN {sql_doc('o_orderkey + 2')} END AS ia_text_url,
    CASE WHEN o_orderkey % 3 > 0 THEN 'Avaliação Prévia de Impacto de Género' END AS ia_title""")
VOTES = f"""CASE WHEN {LATE} THEN NULL WHEN o_orderkey % 2 = 0 THEN 'PS,  L' || o_custkey END AS final_vote_for,
    CASE WHEN {LATE} THEN 'PCP' || o_custkey WHEN o_orderkey % 2 = 0 THEN 'PSD' END AS final_vote_against,
    CASE WHEN {LATE} THEN 'BE' END AS final_vote_abst"""
fields("X-PT8_final_votes", ["final_vote_for", "final_vote_against", "final_vote_abst"], VOTES)
STATUS = f"""CASE WHEN {PUBLISHED} THEN 'PASS' WHEN {LATE} THEN 'REJECT' WHEN o_orderkey % 11 = 0 THEN 'EXPIRED'
    ELSE 'ONGOING' END AS bill_status"""
fields("X-PT9_status", ["bill_status"], STATUS)
_AMS = each("CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 0 END", f"""'PS-X ' || {sql_doc('o_orderkey + i')} || ' ' ||
    CASE WHEN o_orderkey % 10 = 0 THEN 'APPROVED' ELSE '-' END || ' PS/CH, ' || o_custkey || '/-'""")


def _amendment_text(df):
    text = F.transform("amendments", lambda a: F.concat(
        F.array_join(a["amendment_originator"], ","), F.lit(" "), a["amendment_text_url"], F.lit(" "),
        F.coalesce(a["amendment_outcome"], F.lit("-")), F.lit(" "), a["amendment_vote_for"], F.lit("/"),
        a["amendment_vote_against"], F.lit("/"), F.coalesce(a["amendment_vote_abst"], F.lit("-"))))
    return df.withColumn("amendments", F.coalesce(joined(text), F.lit("")))


fields("X-PT10_amendments", ["amendments"], _AMS + " AS amendments", _amendment_text)
fields("X-PT11_external_hearings", ["committee_hearing_count_external"], """CASE WHEN o_orderkey % 3 > 0 OR
    o_orderkey % 2 = 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS committee_hearing_count_external""")
fields("X-PT12_law_link", ["law_page_url"], f"""CASE WHEN {PUBLISHED} THEN
    'https://www.parlamento.pt/a/DetalheDiplomaAprovado.aspx?BID=1' END AS law_page_url""")


@query("X-PT12_law_page", SEL + """(o_orderkey % 99) || '-A/' || year(o_orderdate) AS law_id,
    'https://law.example.org/' || o_orderkey || '.pdf#x' AS law_text_url FROM orders""")
def _(spark, d):
    return P.law_fields(laws(spark, d)).select("url", "law_id", "law_text_url")


TEXTS = with_sql(DOC_TEXTS) + """, cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t
  FROM doc_texts), o AS (SELECT *, 'https://pt.example.org/bid=' || o_orderkey AS url, """ + sql_doc(
    "o_orderkey") + " AS u0, " + sql_doc("o_orderkey + 1") + " AS u1, " + sql_doc("o_orderkey + 2") + """ AS u2 FROM orders)
"""


@query("X-PT12_records", TEXTS + f"""SELECT o.url, md5(c1.t) AS bill_text, CASE WHEN c0.t IS NOT NULL THEN
    CAST({sql_dense('c0.t')} AS BIGINT) END AS committees_depth, CAST({sql_dense('c1.t')} AS BIGINT) AS bill_size,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST({sql_dense('c2.t')} AS BIGINT) END AS ia_size, {STATUS},
    CASE WHEN {PUBLISHED} THEN (o_orderkey % 50) || '/1999' END AS modified_laws,
    CASE WHEN {PUBLISHED} THEN CAST(1 AS INTEGER) END AS modified_laws_count,
    CASE WHEN {PUBLISHED} THEN false END AS original_law,
    CASE WHEN {PUBLISHED} THEN CASE WHEN o_orderkey % 8 = 3 THEN {day('7')} ELSE {day('2')} END END
      AS date_entering_into_force, {VOTES}
  FROM o LEFT JOIN cache c0 ON c0.u = u0 LEFT JOIN cache c1 ON c1.u = u1 LEFT JOIN cache c2 ON c2.u = u2""")
def _(spark, d):
    return P.records(pages(spark, d), law_texts(spark, d)).select(
        F.col("bill_page_url").alias("url"), F.md5("bill_text").alias("bill_text"), "committees_depth", "bill_size",
        "ia_size", "bill_status", joined("modified_laws").alias("modified_laws"), "modified_laws_count", "original_law",
        "date_entering_into_force", "final_vote_for", "final_vote_against", "final_vote_abst")


@query("X-PT13_amendment_refill", SEL + f"""CASE WHEN o_orderkey % 5 = 0 THEN {_AMS} ELSE 'old' END AS amendments,
    CASE WHEN o_orderkey % 5 = 0 THEN 2 ELSE 0 END AS amendment_count FROM orders""")
def _(spark, d):
    found = P.main_fields(mains(spark, d)).where("amendments is not null").select("url", "amendments").withColumn(
        "amendment_count", F.size("amendments"))
    rec = page_rows(spark, d, "orders", [f"{URL} AS url", "0 AS amendment_count"])
    changes = _amendment_text(found)
    old = rec.withColumn("amendments", F.lit("old"))
    return patch(old, changes, "url", ["amendments", "amendment_count"])


@query("X-PT14_topics", """SELECT (l_orderkey % 300) || CASE WHEN l_linenumber % 2 = 0 THEN '-A' ELSE '' END || '/' ||
    year(l_shipdate) AS law_id, l_linenumber AS topic_no, 'T' || l_linenumber AS topic FROM lineitem""")
def _(spark, d):
    rows = page_rows(spark, d, "lineitem", [
        "l_linenumber AS topic_no", "'T' || l_linenumber AS topic",
        "concat('<ul><li><a href=\"x\">Lei n.º ', l_orderkey % 300, case when l_linenumber % 2 = 0 then '-A' else '' end, "
        "'/', year(l_shipdate), '</a></li><li><a>Portaria 1/2000</a></li></ul>') AS html"])
    return P.topic_laws(rows)
