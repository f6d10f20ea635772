"""French pages composed from orders and line items and read back; the SQL says what the row put in."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lexmill.operators import enrich
from lexmill.plans import france as P
from lexmill.plans.common import parsed
from lexmill.functions.html import Tree
from queries.inputs import (AMENDMENT_ROWS, DOC_TEXTS, MEMBERS, RECORDS, TITLED, amendment_rows, doc_texts, joined, members,
                            page_rows, titled_bills, with_sql)
from queries.portugal import doc_url, each, rep, sql_doc
from queries.registry import query, table
from queries.texts import FRENCH_MONTH_NAMES, sql_dense

URL = "concat('https://www.assemblee-nationale.fr/dyn/', o_orderkey % 3 + 14, '/dossiers/', o_orderkey)"
SEL = "SELECT 'https://www.assemblee-nationale.fr/dyn/' || (o_orderkey % 3 + 14) || '/dossiers/' || o_orderkey AS url, "


def fr_day(expr: str) -> str:
    names = ", ".join(f'"{n}"' for n in FRENCH_MONTH_NAMES)
    return f"day({expr}), ' ', element_at(array({names}), month({expr})), ' ', year({expr})"


PROM = "o_orderkey % 4 = 0"
MAIN = f"""concat('<html><body><p class="x deputy-healine-sub-title">\\n', element_at(array('Proposition de loi', 'Projet de loi',
 'Motion'), cast(o_orderkey % 3 + 1 as int)), '</p><h1>Titre &eacute; ', o_custkey, '</h1>',
 case when {PROM} then concat('<div id="12-PROM"><a href="https://law.example.org/', o_orderkey,
   '">Loi</a><p>Loi n° 2010-', o_custkey, '</p><p>Publiée au Journal Officiel du ', {fr_day('o_orderdate')}, '</p></div>')
   else '' end,
 '<div id="10-AN1-DEPOT"><div class="cartouche-rapporteur-left"><a href="', case when o_orderkey % 2 = 0 then '' else
   'https://x.example.org' end, '/textes/', o_orderkey, '">t</a></div><p>Texte n° ', o_orderkey % 900, '</p></div>',
 case when o_orderkey % 7 = 0 then '<div id="11-AN2-DEPOT"><p>Texte n° 7</p></div>' else '' end,
 '<div class="carrousel-auteurs-rapporteurs"><p class="nom-personne"><a href="a">M. Author ', o_custkey % 90, '</a></p></div>',
 case when o_orderkey % 2 = 0 then concat('<div id="cosignataires-liste">\\n  Mme Author ', o_custkey % 50,
   ', M. Bo Nul.\\n</div>') else '' end,
 case when o_orderkey % 5 = 0 then '<p><strong>Le Gouvernement a engagé la procédure accélérée le 1</strong></p>' else '' end,
 case when o_orderkey % 6 < 4 then concat('<div><h4>Etude d''impact</h4><a href="', element_at(array('/ia.pdf',
   {'concat(' + doc_url('o_orderkey') + ')'}, concat('/ia/', o_orderkey, '.html'), concat('https://docs.example.org/',
   o_orderkey, '.html')), cast(o_orderkey % 6 + 1 as int)), '">doc</a></div>') else '' end,
 '</body></html>')"""

ONE = f"""concat('<div>', {rep("1 + o_orderkey % 4", f'''"<h3>", element_at(array("Dépôt", "1ère lecture", "Commission",
   "Promulgation de la loi"), i), "\\n", case when i = 4 then "" when i % 2 = 1 then " Assemblée nationale (x)" else
   " au Sénat" end, "\\n</h3><p><a title='Accéder au compte-rendu' href='/deb/", o_orderkey, "-", i, "'>c</a></p><div>du 3 mars
   1999, déposé(e) le mercredi ", {fr_day("date_add(o_orderdate, 10 * i)")}, " ici</div>"''')},
 case when o_orderkey % 8 = 1 then '<h4>Texte rejeté le</h4>' else '' end,
 case when o_orderkey % 8 < 3 then '<h2>Retrait du texte</h2>' else '' end,
 {rep("o_orderkey % 3", '''"<span class='commission'>\\n Commission ", i % 2, "\\n", case when i = 1 then
   "Commission saisie au fond" else "Avis" end, "</span>"''')},
 case when o_orderkey % 2 = 0 then concat('<section><h6>Agenda et comptes-rendus des réunions</h6><p>x</p><div>',
   {rep("o_orderkey % 5", '"<div class=reunion>r</div>"')}, '</div></section>') else '' end,
 {rep("o_orderkey % 3", '''"<a class='btn link-examen-amendement' href='/am/", i, "'>Voir les ", o_custkey + i, " am (9)</a>"''')},
 '</div>')"""

LAW = """concat('<ul id="liste-sommaire"><li>Article 1 : la loi n° 2009-', o_custkey, ' du 1er mai est abrogé</li></ul>',
 case when o_orderkey % 2 = 0 then '<div class="summary-annexe">Fait à </div><div class="summary-annexe">Paris</div>'
 else '' end)"""
VOTES = "concat('<p>Pour l''adoption : ', o_custkey, '</p><p>Contre : 3</p>')"
BILL = """case o_orderkey % 4 when 0 then concat('<div id="wysiwyg">Texte  de  loi ', o_orderkey, '\\n\\n\\n\\nfin</div>')
 when 1 then concat('<a href="/pdf/', o_orderkey, '.pdf">Version PDF</a>')
 when 2 then '<em>Document non encore publié</em><div id="englobe">z</div>' else '<p>rien</p>' end"""
DEBATE = """concat('<div class="SYCERON">', repeat('mot ', cast(o_orderkey % 9 + i as int)), '</div>')"""


def rows(spark, d, columns, name="orders"):
    return page_rows(spark, d, name, columns)


def html(spark, d, body: str, url: str = URL):
    return rows(spark, d, [f"{url} AS url", f"{body} AS html"])


def pages(spark, d):
    bill_url = ("concat(case when o_orderkey % 2 = 0 then 'https://www.assemblee-nationale.fr' else 'https://x.example.org' "
                "end, '/textes/', o_orderkey)")
    kinds = [("main", URL, MAIN), ("one_page", URL, ONE), ("law", URL, f"case when {PROM} then {LAW} end"),
             ("votes", URL, f"case when {PROM} then {VOTES} end"), ("bill", bill_url, BILL),
             ("ia", "concat('https://docs.example.org/', o_orderkey, '.html')",
              "case when o_orderkey % 6 = 3 then '<div id=\"wysiwyg\">Etude du 5 mai 2011</div>' end")]
    # One branch per kind, so that a reader of one kind has only that composed.
    debates = f"inline(transform(filter(sequence(0, cast(1 + o_orderkey % 4 as int)), i -> i > 0), i -> named_struct('url', " \
              f"concat('https://www.assemblee-nationale.fr/deb/', o_orderkey, '-', i), 'html', {DEBATE})))"
    dealt = page_rows(spark, d, "orders", ["*"]).where("o_orderkey is not null")
    parts = [dealt.selectExpr("'FRANCE' AS country", f"{u} AS url", f"'{k}' AS kind", f"{h} AS html").where("html is not null") for k, u, h in kinds]
    last = dealt.selectExpr("'FRANCE' AS country", "'debate' AS kind", debates).where("html is not null")
    return reduce(lambda x, y: x.unionByName(y), [*parts, last]).select("country", "url", "kind", "html")


KEPT = "o_orderkey % 3 < 2"


FIELDS = []  # (columns, SQL, formatting) of each query below, for the check of whole records


def main_query(name: str, columns: list[str], sql: str, post=None):
    FIELDS.append((columns, sql, post))

    @query(name, SEL + sql + f" FROM orders WHERE {KEPT}")
    def _(spark, d):
        out = P.main_fields(html(spark, d, MAIN)).select("url", *columns)
        return post(out) if post else out


def one_query(name: str, columns: list[str], sql: str, post=None):
    FIELDS.append((columns, sql, post))

    @query(name, SEL + sql + " FROM orders")
    def _(spark, d):
        out = P.one_page_fields(html(spark, d, ONE)).select("url", *columns)
        return post(out) if post else out


main_query("X-FR1_type_title_origin", ["bill_title", "origin_type"], """'Titre é ' || o_custkey AS bill_title,
    CASE o_orderkey % 3 WHEN 0 THEN 'INDIVIDUAL_MP' WHEN 1 THEN 'GOVERNMENT' END AS origin_type""")
_STATUS = "CASE WHEN o_orderkey % 4 = 0 THEN 'PASS' WHEN o_orderkey % 8 = 1 THEN 'REJECT' WHEN o_orderkey % 8 < 3 THEN " \
          "'WITHDRAWN' ELSE 'ONGOING' END"


@query("X-FR2_status_and_id", SEL + f"""{_STATUS} AS bill_status, CASE WHEN {_STATUS} = 'ONGOING' THEN
    (o_orderkey % 3 + 14) || '/' || (o_orderkey % 900) END AS bill_id FROM orders WHERE {KEPT}""")
def _(spark, d):
    main = P.main_fields(html(spark, d, MAIN)).select("url", "promulgated", "depot_id")
    one = P.one_page_fields(html(spark, d, ONE)).select("url", "rejected", "withdrawn")
    df = main.join(one, "url", "left").withColumn("bill_status", P.status())
    return df.select("url", "bill_status", F.when(F.col("bill_status") == "ONGOING", F.col("depot_id")).alias("bill_id"))


@query("X-FR3_originators", with_sql(MEMBERS) + """, up AS (SELECT parsed_name AS n, arg_min(coalesce(parsed_affiliation,
    ''), page_id) AS a FROM members WHERE house = 'UPPER' GROUP BY 1), lo AS (SELECT parsed_name AS n,
    arg_min(parsed_affiliation, page_id) AS a FROM members WHERE house = 'LOWER' GROUP BY 1), o AS (SELECT o_orderkey,
    unnest(['Author ' || (o_custkey % 90)] || CASE WHEN o_orderkey % 2 = 0 THEN ['Author ' || (o_custkey % 50), 'Bo Nul']
    ELSE [] END) AS name, unnest(CASE WHEN o_orderkey % 2 = 0 THEN [1, 2, 3] ELSE [1] END) AS pos FROM orders)
  SELECT o_orderkey, string_agg(name || '=' || coalesce(nullif(up.a, ''), lo.a, '-'), ';' ORDER BY pos) AS originators
  FROM o LEFT JOIN up ON up.n = name LEFT JOIN lo ON lo.n = name GROUP BY 1""")
def _(spark, d):
    src = rows(spark, d, ["o_orderkey", f"{URL} AS url", f"replace({MAIN}, 'Projet de loi<', 'Proposition de loi<') AS h"])
    ready = src.selectExpr("o_orderkey", "url", "replace(h, 'Motion<', 'Proposition de loi<') AS html")
    found = P.originators(P.main_fields(ready).where("names is not null"), members(spark, d))
    text = joined(F.transform("originators", lambda o: F.concat(
        o["originator_name"], F.lit("="), F.coalesce(o["originator_affiliation"], F.lit("-")))))
    return found.select(F.regexp_extract("url", r"(\d+)$", 1).cast("bigint").alias("o_orderkey"),
                        text.alias("originators"))


_FR_STAGES = each("1 + o_orderkey % 4", """['Dépôt', '1ère lecture', 'Commission', 'Promulgation de la loi'][i] || ' ' ||
    CASE WHEN i = 4 THEN '-' WHEN i % 2 = 1 THEN 'LOWER' ELSE 'UPPER' END || ' ' ||
    strftime(o_orderdate + to_days(CAST(10 * i AS INTEGER)), '%Y-%m-%d')""")
one_query("X-FR4_stages", ["legislative_stages", "stages_count", "date_introduction", "date_passing"], _FR_STAGES +
          """ AS legislative_stages, CAST(1 + o_orderkey % 4 AS INTEGER) AS stages_count,
          strftime(o_orderdate + to_days(10), '%Y-%m-%d') AS date_introduction, CASE WHEN o_orderkey % 4 = 3 THEN
          strftime(o_orderdate + to_days(40), '%Y-%m-%d') END AS date_passing""",
          lambda df: df.withColumn("legislative_stages", joined(F.transform("legislative_stages", lambda s: F.concat_ws(
              " ", s["name"], F.coalesce(s["house"], F.lit("-")), s["date"])))))
main_query("X-FR5_law_id_and_date", ["law_id", "date_entering_into_force"], f"""CASE WHEN {PROM} THEN '2010-' || o_custkey
    END AS law_id, CASE WHEN {PROM} THEN strftime(o_orderdate, '%Y-%m-%d') END AS date_entering_into_force""")

_BILL_URL = ("CASE WHEN o_orderkey % 2 = 0 THEN 'https://www.assemblee-nationale.fr' ELSE 'https://x.example.org' END || "
             "'/textes/' || o_orderkey")
PDF_TEXTS = "pdfs AS (SELECT 'https://www.assemblee-nationale.fr/pdf/' || doc_id || '.pdf' AS u, text AS t FROM documents)"


def pdf_texts(spark, d):
    own = table(spark, d, "documents").selectExpr(
        "'bill' AS collection", "'https://www.assemblee-nationale.fr/pdf/' || doc_id || '.pdf' AS url", "n_chars AS size",
        "text AS extracted_text", "n_chars AS text_size")
    return doc_texts(spark, d).unionByName(own)


@query("X-FR6_bill_text", with_sql(PDF_TEXTS) + SEL + f"""CASE WHEN o_orderkey % 4 = 1 AND t IS NOT NULL THEN u ELSE
    {_BILL_URL} END AS bill_text_url, md5(CASE WHEN o_orderkey % 4 = 0 THEN 'Texte  de  loi ' || o_orderkey || chr(10) ||
    chr(10) || 'fin' WHEN o_orderkey % 4 = 1 THEN t END) AS bill_text, CAST(CASE WHEN o_orderkey % 4 = 0 THEN
    length('Textedeloifin' || o_orderkey) WHEN o_orderkey % 4 = 1 AND t IS NOT NULL THEN {sql_dense('t')} END AS BIGINT)
    AS bill_size FROM orders LEFT JOIN pdfs ON u = 'https://www.assemblee-nationale.fr/pdf/' || o_orderkey || '.pdf'
    AND o_orderkey % 4 = 1 WHERE {KEPT}""")
def _(spark, d):
    main = P.main_fields(html(spark, d, MAIN))
    return P.bill_texts(main, pages(spark, d).where("kind = 'bill'"), pdf_texts(spark, d)).select(
        "url", "bill_text_url", F.md5("bill_text").alias("bill_text"), "bill_size")


@query("X-FR7_law_text", SEL + """'Article 1 : la loi n° 2009-' || o_custkey || ' du 1er mai est abrogé' AS law_text,
    CASE WHEN o_orderkey % 2 = 0 THEN 'Fait à Paris' END AS law_text_footer,
    CAST(length('Article1:laloin°2009-du1ermaiestabrogé' || o_custkey) AS BIGINT) AS law_size FROM orders""")
def _(spark, d):
    return P.law_fields(html(spark, d, LAW)).select("url", "law_text", "law_text_footer", "law_size")


main_query("X-FR8_procedure", ["procedure_type_standard", "procedure_type_national"], """CASE WHEN o_orderkey % 5 = 0 THEN
    'EXCEPTIONAL' ELSE 'REGULAR' END AS procedure_type_standard, CASE WHEN o_orderkey % 5 = 0 THEN 'Accelerée' ELSE
    'Ordinaire' END AS procedure_type_national""")


@query("X-FR9_impact_assessment", with_sql(DOC_TEXTS) + f""", cache AS (SELECT split_part(url, '#', 1) AS u,
    nullif(extracted_text, '') AS t FROM doc_texts), o AS (SELECT *, CASE o_orderkey % 6 WHEN 0 THEN
    'https://www.assemblee-nationale.fr/ia.pdf' WHEN 1 THEN {sql_doc('o_orderkey')} WHEN 2 THEN
    'https://www.assemblee-nationale.fr/ia/' || o_orderkey || '.pdf' WHEN 3 THEN {sql_doc('o_orderkey')} END AS pdf FROM orders
    WHERE {KEPT} AND o_orderkey % 6 < 4) """ + SEL + """CASE WHEN o_orderkey % 6 < 2 OR u IS NOT NULL THEN pdf WHEN
    o_orderkey % 6 = 2 THEN '/ia/' || o_orderkey || '.html' ELSE 'https://docs.example.org/' || o_orderkey || '.html'
    END AS ia_text_url, md5(CASE WHEN u IS NOT NULL THEN t WHEN o_orderkey % 6 = 3 THEN 'Etude du 5 mai 2011' END) AS ia_text,
    CASE WHEN u IS NULL AND o_orderkey % 6 = 3 THEN '2011-05-05' END AS ia_date FROM o LEFT JOIN cache ON u = pdf""")
def _(spark, d):
    out = P.impact_assessments(P.main_fields(html(spark, d, MAIN)), pages(spark, d).where("kind = 'ia'"),
                               doc_texts(spark, d))
    return out.select("url", "ia_text_url", F.md5("ia_text").alias("ia_text"), "ia_date")


one_query("X-FR10_committees", ["committees", "committee_count", "committee_hearing_count"], """CASE o_orderkey % 3 WHEN 1 THEN
    'Commission 1 Lead' WHEN 2 THEN 'Commission 1 Lead;Commission 0 Advisory' END AS committees,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 3 AS INTEGER) END AS committee_count,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 5 AS INTEGER) END AS committee_hearing_count""",
          lambda df: df.withColumn("committees", joined(F.transform("committees", lambda c: F.concat_ws(
              " ", c["committee_name"], c["committee_role"])))))


@query("X-FR11_modified_laws", SEL + """'2009-' || o_custkey AS modified_laws, CAST(1 AS INTEGER) AS modified_laws_count,
    false AS original_law FROM orders""")
def _(spark, d):
    return P.law_fields(html(spark, d, LAW)).select("url", joined("modified_laws").alias("modified_laws"),
                                                    "modified_laws_count", "original_law")


@query("X-FR12_votes", SEL + """'' || o_custkey AS final_vote_for, '3' AS final_vote_against, CAST(NULL AS VARCHAR)
    AS final_vote_abst FROM orders""")
def _(spark, d):
    return P.vote_fields(html(spark, d, VOTES)).drop("page_hash")


@query("X-FR13_debates", SEL + """CAST(list_sum(list_transform(range(1, CAST(2 + o_orderkey % 4 AS INTEGER)),
    lambda i: 3 * (o_orderkey % 9 + i))) AS BIGINT) AS plenary_size, """ + each(
    "1 + o_orderkey % 4", "CASE WHEN i IN (1, 3) THEN '' || (3 * (o_orderkey % 9 + i)) ELSE '-' END") + """ AS sizes
    FROM orders""")
def _(spark, d):
    one = P.one_page_fields(html(spark, d, ONE)).select("url", "legislative_stages", "debates")
    out = P.with_debates(one, pages(spark, d).where("kind = 'debate'"))
    return out.select("url", "plenary_size", joined(F.transform(
        "legislative_stages", lambda s: s["debate_size"].cast("string"))).alias("sizes"))


one_query("X-FR14_amendment_links", ["amendment_count", "amendment_links"], """CASE o_orderkey % 3 WHEN 1 THEN
    CAST(o_custkey + 1 AS BIGINT) WHEN 2 THEN CAST(2 * o_custkey + 3 AS BIGINT) END AS amendment_count,
    CASE o_orderkey % 3 WHEN 1 THEN '/am/1' WHEN 2 THEN '/am/1;/am/2' END AS amendment_links""",
          lambda df: df.withColumn("amendment_links", joined("amendment_links")))


@query("X-FR14_repaired_links", SEL + """CASE o_orderkey % 3 WHEN 1 THEN '/am/1' WHEN 2 THEN '/am/1;/am/2' ELSE 'text' END
    AS amendment_links FROM orders""")
def _(spark, d):
    rec = rows(spark, d, [f"{URL} AS record_id", f"{URL} AS bill_page_url", "array('text') AS amendment_links",
                          "o_orderkey % 3 AS amendment_count"])
    one = P.one_page_fields(html(spark, d, ONE))
    return P.with_repaired_links(rec, one).select(F.col("bill_page_url").alias("url"),
                                                  joined("amendment_links").alias("amendment_links"))


@query("X-FR15_members", """SELECT 'LOWER' AS house, '' || c_custkey AS page_id, c_name AS parsed_name, CASE WHEN
    c_custkey % 3 > 0 THEN c_mktsegment END AS parsed_affiliation FROM customer UNION ALL SELECT 'UPPER', '' || s_suppkey,
    'M. ' || s_name || ' ', CASE WHEN s_suppkey % 3 > 0 THEN 'Parti ' || s_nationkey END FROM supplier""")
def _(spark, d):
    an = rows(spark, d, ["c_custkey AS page_id", "'' AS url", "concat('<h1>M. ', c_name, ' </h1>', case when c_custkey % 3 > "
                         "0 then concat('<p><span>Rattachement au titre du financement de la vie politique</span><b>:</b><span>"
                         " ', c_mktsegment, '\\n</span></p>') else '' end) AS html"], "customer")
    senate = rows(spark, d, ["s_suppkey AS page_id", "'' AS url", "concat('<h1>M. ', s_name, ' </h1><h2>Informations</h2><p>x"
                             "</p><ul><li>a</li>', case when s_suppkey % 3 > 0 then concat('<li>Parti politique (rattachement "
                             "financier) : Parti ', s_nationkey, '\\n</li>') else '' end, '</ul>') AS html"], "supplier")
    return P.members(an, "LOWER").unionByName(P.members(senate, "UPPER"))


AM_ID = "concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey)"


@query("X-FR16_amendment_pages", """WITH am AS (SELECT *, l_partkey + l_suppkey AS k FROM lineitem)
    SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey
    AS amendment_id, strftime(l_shipdate, '%Y-%m-%d') AS amendment_date, CASE l_returnflag WHEN 'A' THEN 'ACCEPTED' WHEN 'N'
    THEN 'INADMISSIBLE' END AS amendment_outcome, 'Lecture ' || (p_partkey % 4) AS amendment_stage_name,
    CASE WHEN p_partkey IS NOT NULL THEN 'Lois' END AS amendment_committee_name,
    'Ann ' || p_partkey || ';Bo' AS amendment_originator, 'Exposé' || chr(10) || 'Motif ' || p_partkey AS amendment_text,
    CAST(length('ExposéMotif' || p_partkey) AS BIGINT) AS amendment_text_size
    FROM am LEFT JOIN part ON p_partkey = k""")
def _(spark, d):
    # A row links to the page of part key plus supplier key, which for the last parts is none.
    lists = rows(spark, d, ["l_orderkey AS url", f"""concat('<table><tbody id="tbody-amendements-list"><tr data-href="/d/',
      l_partkey + l_suppkey, '"><td>1</td><td> ', {AM_ID}, '\n</td><td/><td/><td/><td>', case l_returnflag when 'A' then 'Adopté'
      when 'N' then 'Irrecevable' else 'Autre' end, '</td><td></td><td>', {fr_day('l_shipdate')},
      '</td></tr></tbody></table>') AS html"""], "lineitem")
    details = rows(spark, d, ["concat('https://www.assemblee-nationale.fr/d/', p_partkey) AS url", """concat(
      '<div class="a"><b>Stade de lecture</b><span>no</span></div><div><b>Stade de lecture :</b><i>x</i><span>Lecture ',
      p_partkey % 4, '</span><p><b>Examiné par</b><span>Lois</span></p></div><div class="acteur-list-embed"><ul><li> Ann ',
      p_partkey, '</li><li>Bo </li></ul></div><div><div class="amendement-section-body">eins</div></div>',
      '<section><h4>Exposé</h4>\\n<div class="b amendement-section-body">Motif ', p_partkey, '</div></section>') AS html""",
      "p_partkey"], "part")
    return P.page_amendments(lists, details.select("url", "html")).select(
        "amendment_id", "amendment_date", "amendment_outcome", "amendment_stage_name", "amendment_committee_name",
        joined("amendment_originator").alias("amendment_originator"), "amendment_text", "amendment_text_size")


@query("X-FR17_file_amendments", with_sql(TITLED, AMENDMENT_ROWS, MEMBERS, DOC_TEXTS) + f""",
  cache AS (SELECT split_part(url, '#', 1) AS u, nullif(extracted_text, '') AS t FROM doc_texts),
  lower_ AS (SELECT parsed_name AS n, arg_min(parsed_affiliation, page_id) AS a FROM members WHERE house = 'LOWER'
    GROUP BY 1),
  links AS (SELECT 'https://am.example.org/' || p_partkey AS link, 'Com ' || (p_partkey % 9) AS com,
    'https://docs.example.org/' || p_partkey || '.pdf' AS doc FROM part)
  SELECT bill_title, "Numéro de l'amendement" AS amendment_id, split_part("Titre complet", '° ', 2) AS bill_id,
    split_part("Auteur", ' ', 2) || ' ' || split_part("Auteur", ' ', 1) || CASE WHEN "Cosignataire(s)" = '' THEN '' ELSE ';' ||
    split_part("Cosignataire(s)", ',', 1) || ';Bo' END AS amendment_originator, a AS amendment_originator_aff,
    CASE "Sort de l'amendement" WHEN 'Adopté' THEN 'ACCEPTED' WHEN 'Tombé' THEN 'REJECTED' ELSE 'Autre' END
    AS amendment_outcome, com AS amendment_committee_name, doc AS amendment_text_url, md5(t) AS amendment_text,
    CASE WHEN doc IS NOT NULL THEN CAST({sql_dense('t')} AS BIGINT) END AS amendment_text_size
  FROM amendment_rows LEFT JOIN lower_ ON n = split_part("Auteur", ' ', 2) || ' ' || split_part("Auteur", ' ', 1)
  LEFT JOIN links ON link = "URL Amendement" LEFT JOIN cache ON u = doc
  WHERE bill_title IN (SELECT bill_title FROM titled WHERE amendments IS NULL OR len(amendments) = 0)""")
def _(spark, d):
    links = table(spark, d, "part").selectExpr(
        "'https://am.example.org/' || p_partkey AS amendment_page_link", "'Com ' || (p_partkey % 9) AS amendment_committee_name",
        "'https://docs.example.org/' || p_partkey || '.pdf' AS amendment_text_url")
    out = enrich.file_amendments(titled_bills(spark, d), amendment_rows(spark, d), members(spark, d), doc_texts(spark, d),
                                 links)
    return out.select("bill_title", "amendment_id", "bill_id", joined("amendment_originator").alias("amendment_originator"),
                      "amendment_originator_aff", "amendment_outcome", "amendment_committee_name", "amendment_text_url",
                      F.md5("amendment_text").alias("amendment_text"), "amendment_text_size")


@query("X-FR18_law_types", """SELECT CAST(12 + p_partkey % 3 AS INTEGER) AS legislature, p_type AS law_type, p_name AS title
    FROM part""")
def _(spark, d):
    src = rows(spark, d, ["cast(12 + p_partkey % 3 as int) AS legislature", "'' AS url", "concat('<p align=\"justify\"> ', "
                          "p_type, ' : ', p_name, ' (', p_brand, ')</p><p align=\"justify\">nichts</p><p>a : b</p>') AS html"],
               "part")
    return P.law_types(src)


@query("X-FR19_submission_date", """SELECT '' || o_orderkey AS url, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders""")
def _(spark, d):
    src = rows(spark, d, ["'' || o_orderkey AS url", f"""concat('<div>x<p>Texte déposé(e) le ', {fr_day('date_add(o_orderdate, 9)')},
      '</p></div><div>le 1er mai 1990</div><div>déposé(e) le jeudi ', {fr_day('o_orderdate')}, '</div>') AS html"""])
    t = Tree()
    return parsed(src).select("url", P.submission_dates(t.find_all(name="div")).alias("d"))


@query("X-FR_records", with_sql(RECORDS) + SEL + f"""{_STATUS} AS bill_status, CASE WHEN {PROM} THEN '2009-' || o_custkey END
    AS modified_laws, CASE WHEN {PROM} THEN '' || o_custkey END AS final_vote_for, CAST(list_sum(list_transform(range(1,
    CAST(2 + o_orderkey % 4 AS INTEGER)), lambda i: 3 * (o_orderkey % 9 + i))) AS BIGINT) AS plenary_size,
    CAST(1 + o_orderkey % 4 AS INTEGER) AS stages_count FROM orders WHERE {KEPT}""")
def _(spark, d):
    return P.records(pages(spark, d), pdf_texts(spark, d), members(spark, d)).select(
        F.col("bill_page_url").alias("url"), "bill_status", joined("modified_laws").alias("modified_laws"),
        "final_vote_for", "plenary_size", "stages_count")
