"""Field functions on document texts and on sentences composed from table columns and parsed back."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmill.functions import dates, labels, sections, text, urls, votes
from queries.inputs import SPACE, joined
from queries.registry import query, table

STRIP = r"'^[%s]+|[%s]+$'" % (SPACE, SPACE)


def sql_strip(expr: str) -> str:
    return f"regexp_replace({expr}, {STRIP}, '', 'g')"


def sql_dense(expr: str) -> str:
    return f"coalesce(length(regexp_replace({expr}, '[{SPACE}]', '', 'g')), 0)"


def docs(spark, d):
    return table(spark, d, "documents")


def orders(spark, d):
    return table(spark, d, "orders")


FRENCH_MONTH_NAMES = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre",
                      "novembre", "décembre"]
PORTUGUESE_MONTH_NAMES = list(dates.PORTUGUESE_MONTHS)


def month_name(names, day: str) -> str:
    return f"element_at(array({', '.join(repr(n) for n in names)}), month({day}))"


FR_DAY = (f"concat(case when day(o_orderdate) = 1 then '1er' else '' || day(o_orderdate) end, ' ', "
          f"{month_name(FRENCH_MONTH_NAMES, 'o_orderdate')}, ' ', year(o_orderdate))")
ISO = "strftime(o_orderdate, '%Y-%m-%d')"


# --- white space and lines ----------------------------------------------------------------------------------------

@query("E0_strip", f"""SELECT doc_id, md5({sql_strip("text")}) AS t FROM documents""")
def _(spark, d):
    padded = F.concat(F.lit(" \t  "), F.col("text"), F.lit(" \n　\u0085"))
    return docs(spark, d).select("doc_id", F.md5(text.strip(padded)).alias("t"))


@query("E1_clean_text", f"""SELECT doc_id, md5(nullif({sql_strip(
    "regexp_replace(text || chr(10) || 'a  b' || chr(10) || chr(10) || ' c', '[ \n]{3,}', chr(10) || chr(10), 'g')")}, ''))
    AS t FROM documents""")
def _(spark, d):
    raw = F.expr("concat('Disponible au format Acrobat  (', n_chars, ' Koctets)', text, '\\na  b\\n\\n c', "
                 "'Document \"pastillé\" au format PDF (', doc_id, ' Koctets)  ')")
    return docs(spark, d).select("doc_id", F.md5(text.clean_text(raw)).alias("t"))


@query("E2_remove_whitespace", f"""SELECT doc_id, md5(coalesce(regexp_replace(nullif(text, ''), '[{SPACE}]', '', 'g'), ''))
    AS t FROM documents""")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.md5(text.remove_whitespace("text")).alias("t"))


@query("E3_dense_length", f"""SELECT doc_id, CAST({sql_dense('text')} AS BIGINT) AS n FROM documents""")
def _(spark, d):
    return docs(spark, d).select("doc_id", text.dense_length("text").alias("n"))


@query("E15_filled_lines", f"""SELECT doc_id, md5(array_to_string(list_filter(list_transform(string_split_regex(text,
    '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda l: {sql_strip('l')}), lambda l: l <> ''),
    '|')) AS t FROM documents""")
def _(spark, d):
    return docs(spark, d).select("doc_id", F.md5(F.array_join(text.filled_lines("text"), "|")).alias("t"))


# --- dates --------------------------------------------------------------------------------------------------------

@query("E4_french_date", f"""SELECT o_orderkey, {ISO} AS d FROM orders""")
def _(spark, d):
    day = F.concat(F.expr("element_at(array('lundi ', 'mardi ', ''), cast(o_orderkey % 3 + 1 as int))"), F.expr(FR_DAY))
    return orders(spark, d).select("o_orderkey", dates.iso(dates.french_date(day)).alias("d"))


@query("E5_parse_any", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN {ISO} END AS d FROM orders""")
def _(spark, d):
    raw = F.expr("case o_orderkey % 4 when 0 then date_format(o_orderdate, 'y.M.d') when 1 then "
                 "date_format(o_orderdate, 'yyyy-MM-dd') when 2 then date_format(o_orderdate, 'yyyy.MM.dd') else '?' end")
    return orders(spark, d).select("o_orderkey", dates.iso(dates.parse_any(raw)).alias("d"))


@query("E6_format_date", f"SELECT o_orderkey, {ISO} AS d FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", dates.iso(F.col("o_orderdate")).alias("d"))


@query("E7_rearrange", "SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') AS d FROM orders")
def _(spark, d):
    return orders(spark, d).select("o_orderkey", dates.rearrange(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("d"))


@query("E8_parse_by_country", f"SELECT o_orderkey, {ISO} AS de, {ISO} AS pt FROM orders")
def _(spark, d):
    return orders(spark, d).select(
        "o_orderkey", dates.iso(dates.german_date(F.date_format("o_orderdate", "dd.MM.yyyy"))).alias("de"),
        dates.iso(dates.portuguese_iso(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("pt"))


@query("E9_dates_in_text", f"""SELECT o_orderkey, strftime(o_orderdate, '%Y.%m.%d') || ';2001.02.03' AS de,
    CASE WHEN o_orderkey % 2 = 0 THEN {ISO} ELSE '1999-05-04' END AS fr FROM orders""")
def _(spark, d):
    german = F.concat(F.lit("BT-Drs. 20/1 vom "), F.date_format("o_orderdate", "dd.MM.yyyy"), F.lit(", 03.02.2001 ff."))
    french = F.concat(F.lit("Discuté le 4 mai 1999 et "), F.expr(
        "case when o_orderkey % 2 = 0 then 'déposé(e) le mercredi ' else 'le ' end"), F.expr(FR_DAY))
    return orders(spark, d).select("o_orderkey", joined(dates.german_dates_in(german)).alias("de"),
                                   dates.iso(dates.french_date_in(french)).alias("fr"))


_FORCE = """CASE o_orderkey % 6 WHEN 0 THEN o_orderdate + INTERVAL 1 DAY
    WHEN 1 THEN o_orderdate + to_days(CAST(1 + o_custkey % 90 AS INTEGER))
    WHEN 2 THEN date_trunc('month', o_orderdate) + INTERVAL 1 MONTH
    WHEN 3 THEN o_orderdate - INTERVAL 40 DAY
    WHEN 4 THEN o_orderdate END"""


@query("E36_entry_into_force", f"SELECT o_orderkey, strftime(CAST({_FORCE} AS TIMESTAMP), '%Y-%m-%d') AS d FROM orders")
def _(spark, d):
    written = "date_sub(o_orderdate, 40)"
    rule = F.expr(
        "case o_orderkey % 6 when 0 then 'A lei entra em vigor  no dia\\nseguinte ao da sua publicação.' "
        "when 1 then concat('O diploma entra em vigor ', 1 + o_custkey % 90, ' dias após a publicação.') "
        "when 2 then 'Vigora no primeiro dia do mês seguinte ao da sua publicação.' "
        f"when 3 then concat('Vigora a ', day({written}), ' de ', {month_name(PORTUGUESE_MONTH_NAMES, written)}, ' de ', "
        f"year({written}), '.') "
        "when 4 then 'A presente lei entra imediatamente em vigor.' else 'Nada.' end")
    head = F.expr("case when o_orderkey % 2 = 0 then 'Entrada em vigor' else "
                  "'Entrada em vigor e produção de efeitos' end")
    law = F.concat(F.lit("Artigo 1.º\nObjeto\nArtigo 9.º\n"), head, F.lit("\n"), rule, F.lit("\nAprovada"))
    return orders(spark, d).select("o_orderkey", dates.entry_into_force(law, F.to_date("o_orderdate")).alias("d"))


@query("E41_impact_date", f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN {ISO} END AS d FROM orders""")
def _(spark, d):
    t = F.concat(F.expr("repeat('Étude ', case when o_orderkey % 3 = 0 then 60 else 2 end)"), F.lit("du "),
                 F.expr(FR_DAY), F.lit(" fin"))
    return orders(spark, d).select("o_orderkey", dates.impact_date(t).alias("d"))


# --- URLs ---------------------------------------------------------------------------------------------------------

@query("E10_clean_url", "SELECT page_id, split_part(url, '#', 1) AS u FROM pages")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", urls.clean_url("url").alias("u"))


@query("E11_absolute_url", """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'https://www.assemblee-nationale.fr/dyn/' ||
    page_id WHEN page_id % 3 = 1 THEN 'www.x.example.org/' || page_id ELSE url END AS u FROM pages""")
def _(spark, d):
    raw = F.expr("case page_id % 3 when 0 then '/dyn/' || page_id when 1 then 'www.x.example.org/' || page_id else url end")
    return table(spark, d, "pages").select("page_id", urls.absolute_url(raw).alias("u"))


@query("E12_search_params", "SELECT c_custkey, 'https://dip.example.org/vorgang/' || c_custkey AS u FROM customer")
def _(spark, d):
    base = ("?f.typ=Vorgang&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen"
            "~Gesetzgebung")
    new = base + "&f.drucksachetyp_p=05Gesetze&f.drucksachetyp_p=05Gesetze~Gesetzentwurf"
    old = base + "&f.aktivitaetsart_p=01Antr%C3%A4ge%2C%20Gesetzentw%C3%BCrfe"
    tail = F.expr("concat(case when c_custkey % 2 = 0 then '&start=250' else '' end, "
                  "'&rows=250&sort=basisdatum_ab&pos=', c_custkey)")
    link = F.concat(F.lit("https://dip.example.org/vorgang/"), "c_custkey",
                    F.when(F.col("c_custkey") % 3 == 0, new).otherwise(old), tail)
    return table(spark, d, "customer").select("c_custkey", urls.strip_search_params(link).alias("u"))


@query("E13_part_after", """SELECT page_id, CASE WHEN contains(url, '?') THEN substr(url, instr(url, '?') + 1) ELSE '' END
    AS q FROM pages""")
def _(spark, d):
    return table(spark, d, "pages").select("page_id", urls.part_after("url", "?").alias("q"))


@query("E37_debate_url", """SELECT o_orderkey, 'r3' AS periodo, 'dar' AS publicacao, '01' AS serie, '14' AS legis,
    '' || (o_orderkey % 4) AS sessao, '' || o_custkey AS numero,
    strftime(o_orderdate - INTERVAL 1 DAY, '%Y-%m-%d') AS data, '' || o_orderkey AS pagina, '7' AS start_pg,
    '' || (7 + o_custkey) AS end_pg FROM orders""")
def _(spark, d):
    url = F.expr("concat('https://debates.parlamento.pt/catalogo/r3/dar/01/14/', o_orderkey % 4, '/', o_custkey, '/', "
                 "date_format(o_orderdate, 'yyyy-MM-dd'), '/', o_orderkey, '?pgs=7-', 7 + o_custkey, '&org=PLC')")
    return orders(spark, d).select("o_orderkey", *[c.alias(n) for n, c in urls.debate_parts(url).items()])


# --- names and labels ---------------------------------------------------------------------------------------------

@query("E14_clean_name", "SELECT c_custkey, c_name AS n FROM customer")
def _(spark, d):
    raw = F.expr("concat(case when c_custkey % 2 = 0 then ' M. ' else 'Mme ' end, c_name, ' ')")
    return table(spark, d, "customer").select("c_custkey", text.clean_name(raw).alias("n"))


@query("E16_origin_type", """SELECT o_orderkey,
    CASE o_orderkey % 3 WHEN 0 THEN 'GOVERNMENT' WHEN 1 THEN 'INDIVIDUAL_MP' END AS fr,
    CASE o_orderkey % 3 WHEN 0 THEN 'GOVERNMENT' WHEN 1 THEN 'INDIVIDUAL_MP' END AS pt,
    CASE o_orderkey % 2 WHEN 0 THEN 'GOVERNMENT' ELSE 'INDIVIDUAL_MP' END AS de FROM orders""")
def _(spark, d):
    fr = F.expr("case o_orderkey % 3 when 0 then 'Projet de loi' when 1 then 'PROPOSITION de loi' else 'Motion' end")
    pt = F.expr("case o_orderkey % 3 when 0 then 'Proposta de Lei' when 1 then 'Projeto de Lei' else 'Moção' end")
    de = F.expr("case o_orderkey % 2 when 0 then 'Urheber: Bundesregierung, BMJ' else 'Urheber: Bundesrat' end")
    return orders(spark, d).select("o_orderkey", labels.origin_fr(fr).alias("fr"), labels.origin_pt(pt).alias("pt"),
                                   labels.origin_de(de).alias("de"))


@query("E17_house", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'LOWER' WHEN 1 THEN 'UPPER' END AS fr,
    CASE o_orderkey % 5 WHEN 0 THEN 'LOWER' WHEN 1 THEN 'LOWER' WHEN 2 THEN 'UPPER' WHEN 3 THEN 'UPPER' END AS de,
    CASE o_orderkey % 3 WHEN 0 THEN 'LOWER' WHEN 1 THEN 'UPPER' ELSE 'EP' END AS repaired FROM orders""")
def _(spark, d):
    fr = F.expr("element_at(array('- Assemblée nationale', 'au Sénat', 'Conseil'), cast(o_orderkey % 3 + 1 as int))")
    de = F.expr("element_at(array('Bundestag', 'BT', 'Bundesrat', 'BR', 'EP'), cast(o_orderkey % 5 + 1 as int))")
    old = F.expr("element_at(array('BUNDESTAG', 'bundesrat', 'EP'), cast(o_orderkey % 3 + 1 as int))")
    return orders(spark, d).select("o_orderkey", labels.house_fr(fr).alias("fr"), labels.house_de(de).alias("de"),
                                   labels.repair_house_de(old).alias("repaired"))


@query("E18_stage_name", """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN '1st reading' WHEN 1 THEN '2nd reading'
    ELSE o_orderpriority END AS name FROM orders""")
def _(spark, d):
    raw = F.expr("case o_orderkey % 3 when 0 then '1ère lecture' when 1 then '2ème lecture' else o_orderpriority end")
    return orders(spark, d).select("o_orderkey", labels.stage_name_fr(raw).alias("name"))


@query("E19_outcome", """SELECT o_orderkey,
    ['ACCEPTED', 'REJECTED', 'REJECTED', 'REJECTED', 'REJECTED', NULL, 'Irrecevable', 'Autre'][o_orderkey % 8 + 1] AS file_,
    ['ACCEPTED', 'REJECTED', 'REJECTED', 'REJECTED', 'REJECTED', NULL, 'INADMISSIBLE', NULL][o_orderkey % 8 + 1] AS page_,
    ['PASS', 'PASS', 'REJECT', NULL][o_orderkey % 4 + 1] AS de FROM orders""")
def _(spark, d):
    fr = F.expr("element_at(array('Adopté', 'Rejeté', 'Non soutenu', 'Tombé', 'Retiré', 'Non renseigné', 'Irrecevable', "
                "'Autre'), cast(o_orderkey % 8 + 1 as int))")
    de = F.expr("element_at(array('Verkündet', 'Angenommen', 'Abgelehnt', 'Offen'), cast(o_orderkey % 4 + 1 as int))")
    return orders(spark, d).select("o_orderkey", labels.outcome_fr_file(fr).alias("file_"),
                                   labels.outcome_fr_page(fr).alias("page_"), labels.outcome_de(de).alias("de"))


@query("E20_status", """SELECT o_orderkey, ['PASS', 'REJECT', NULL, NULL, NULL, NULL, 'ONGOING'][o_orderkey % 7 + 1]
    AS status FROM orders""")
def _(spark, d):
    options = ["Verkündet", "Abgelehnt", *labels.GERMAN_NO_STATUS, "Überwiesen"]
    raw = F.get(F.array(*[F.lit(o) for o in options]), (F.col("o_orderkey") % 7).cast("int"))
    return orders(spark, d).select("o_orderkey", labels.status_de(raw).alias("status"))


@query("E21_name_and_affiliation", """SELECT c_custkey, c_name AS name,
    CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS affiliation FROM customer""")
def _(spark, d):
    o = labels.originator_pt(F.expr("case when c_custkey % 3 > 0 then concat(c_name, ' (', c_mktsegment, ')') else c_name end"))
    return table(spark, d, "customer").select("c_custkey", o.originator_name.alias("name"),
                                              o.originator_affiliation.alias("affiliation"))


@query("E22_reverse_words", """SELECT p_partkey, array_to_string(list_reverse(string_split(p_name, ' ')), ' ') AS n
    FROM part""")
def _(spark, d):
    return table(spark, d, "part").select("p_partkey", text.reverse_words("p_name").alias("n"))


@query("E23_split_signers", """SELECT c_custkey, 'Ana ' || c_custkey || ';Bo' AS file_, 'Ana ' || c_custkey || ';Bo X' AS page_
    FROM customer""")
def _(spark, d):
    file_ = F.expr("concat('Ana ', c_custkey, ',  Bo , ')")
    page = F.expr("concat('  \\tMme Ana ', c_custkey, ',\\n   M. Bo X.\\n')")
    return table(spark, d, "customer").select("c_custkey", joined(text.split_names(file_)).alias("file_"),
                                              joined(text.split_page_names(page)).alias("page_"))


@query("E31_committee", """SELECT o_orderkey, 'Commission ' || o_custkey AS name,
    CASE o_orderkey % 3 WHEN 0 THEN 'Lead' WHEN 1 THEN 'Advisory' END AS role FROM orders""")
def _(spark, d):
    raw = F.expr("concat('\\n  Commission ', o_custkey, '\\n\\n', case o_orderkey % 3 when 0 then "
                 "' Commission saisie au fond ' when 1 then 'Saisie pour avis' else '' end, '\\n')")
    c = labels.committee_fr(raw)
    return orders(spark, d).select("o_orderkey", c.committee_name.alias("name"), c.committee_role.alias("role"))


@query("E39_heading", """SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN p_type END AS law_type,
    CASE WHEN p_partkey % 4 > 0 THEN p_name END AS title FROM part""")
def _(spark, d):
    raw = F.expr("case p_partkey % 4 when 0 then p_name when 1 then concat(p_type, ' : ', p_name, ' (', p_brand, ')') "
                 "when 2 then concat(' ', p_type, ' :', p_name, ' : more') else concat(p_type, ': ', p_name) end")
    h = labels.heading_parts(raw)
    return table(spark, d, "part").select("p_partkey", h.law_type.alias("law_type"), h.title.alias("title"))


@query("E40_title", "SELECT p_partkey, p_name AS t FROM part")
def _(spark, d):
    raw = F.expr("concat('[formato DOC] ', p_name, ' [formato DOCX][formato PDF]\\n')")
    return table(spark, d, "part").select("p_partkey", labels.title_pt(raw).alias("t"))


@query("E43_government", "SELECT o_orderkey, 'Ministerium ' || o_custkey AS t FROM orders")
def _(spark, d):
    raw = F.expr("concat(' Urheber: Bundesregierung, Ministerium ', o_custkey, ' ')")
    return orders(spark, d).select("o_orderkey", labels.government_party_de(raw).alias("t"))


@query("E44_party", """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 3 = 1 THEN 'CDS-PP' ELSE
    c_mktsegment END AS p FROM customer""")
def _(spark, d):
    raw = F.expr("case c_custkey % 3 when 0 then 'A. b' when 1 then 'do CDS-PP' else concat('do ', c_mktsegment, '.') end")
    return table(spark, d, "customer").select("c_custkey", labels.party(raw).alias("p"))


# --- ids, votes, laws ---------------------------------------------------------------------------------------------

@query("E24_vote_parties", """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'PS' ELSE 'PS,  CH-' || o_custkey END
    AS vote_for, CASE WHEN o_orderkey % 2 = 0 THEN 'P' || o_custkey END AS vote_against, 'PAN' AS vote_abst
    FROM orders""")
def _(spark, d):
    raw = F.expr("concat('Votação: A Favor: PS,  CH-', o_custkey, ' ', case when o_orderkey % 2 = 0 then "
                 "concat('Contra: P', o_custkey, ' ') else '' end, 'Abstenção:  PAN Ausência: X', "
                 "case when o_orderkey % 4 = 0 then 'A Favor: PS' else '' end)")
    v = votes.vote_parties(raw)
    return orders(spark, d).select("o_orderkey", *[v[n].alias(n) for n in ("vote_for", "vote_against", "vote_abst")])


@query("E25_vote_counts", """SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS final_vote_for,
    CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey % 577 AS INTEGER) END AS final_vote_against,
    CAST(3 AS INTEGER) AS final_vote_abst FROM orders""")
def _(spark, d):
    raw = F.expr("concat('Scrutin. Pour l''adoption : ', o_custkey, '\\n', case when o_orderkey % 2 = 0 then "
                 "concat('Contre : ', o_orderkey % 577) else '' end, ' Abstention : 3.')")
    return orders(spark, d).select("o_orderkey", *[c.alias(n) for n, c in votes.vote_counts_fr(raw).items()])


@query("E26_roll_call", """SELECT o_orderkey, '20/' || o_custkey AS final_version_printed_matter_id,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_orderkey % 700 AS INTEGER) END AS final_vote_for,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(o_custkey % 700 AS INTEGER) END AS final_vote_against,
    CASE WHEN o_orderkey % 3 > 0 THEN CAST(0 AS INTEGER) END AS final_vote_abst FROM orders""")
def _(spark, d):
    raw = F.expr("concat('Drs. 19/5, 20/', o_custkey, ' Seite: x\\n709\\n', case when o_orderkey % 3 = 0 then '700 ' else "
                 "'700 \\n' end, o_orderkey % 700, '\\n', o_custkey % 700, '\\n0\\n9\\nSumme')")
    return orders(spark, d).select("o_orderkey", votes.vote_counts_de(raw).alias("v")).select(
        "o_orderkey", "v.final_version_printed_matter_id", "v.counts.*")


@query("E27_bill_id", """SELECT o_orderkey, (o_orderkey % 2000) || '/XIV/2' AS pt, '16/' || o_custkey AS fr,
    CASE WHEN o_orderkey % 2 = 0 THEN '' || o_orderkey END AS fr_file FROM orders""")
def _(spark, d):
    pt = F.expr("concat('Proposta de Lei ', o_orderkey % 2000, '/XIV/2 x')")
    url = F.expr("concat('https://www.x.example.org/dyn/16/dossiers/', o_orderkey)")
    text_ = F.expr("concat('Texte n° ', o_custkey, ' et n° 9')")
    title = F.expr("concat('Projet n° ', o_orderkey, case when o_orderkey % 2 = 0 then '' else ' bis' end)")
    return orders(spark, d).select("o_orderkey", labels.bill_id_pt(pt).alias("pt"),
                                   labels.bill_id_fr(url, text_).alias("fr"),
                                   labels.bill_id_fr_file(title).alias("fr_file"))


@query("E28_law_id", """SELECT o_orderkey, year(o_orderdate) || '-' || o_custkey AS fr,
    (o_orderkey % 300) || CASE WHEN o_orderkey % 2 = 0 THEN '-A' ELSE '' END || '/' || year(o_orderdate) AS pt
    FROM orders""")
def _(spark, d):
    fr = F.expr("concat('Loi n° ', year(o_orderdate), '-', o_custkey, ' du jour')")
    pt = F.expr("concat('Lei n.º ', o_orderkey % 300, case when o_orderkey % 2 = 0 then '-A' else '' end, '/', "
                "year(o_orderdate), ' de hoje')")
    return orders(spark, d).select("o_orderkey", labels.law_id_fr(fr).alias("fr"), labels.law_id_pt(pt).alias("pt"))


@query("E29_modified_laws", """SELECT o_orderkey, '2010-' || o_custkey AS fr, array_to_string(list_sort(list_distinct([
    (o_orderkey % 90) || '/1999', (o_custkey % 90) || '/2001'])), ';') AS pt FROM orders""")
def _(spark, d):
    verb = F.expr("element_at(array('abrogé', 'completé', 'complété', 'supprimé', 'modifié', 'redigé', 'rédigé', 'inseré', "
                  "'insérés', 'remplacé'), cast(o_orderkey % 10 + 1 as int))")
    fr = F.concat(F.lit("La loi n° 2010-"), "o_custkey", F.lit(" du 1er mai,\nest "), verb, F.lit("."))
    pt = F.expr("concat('Primeira ALTERAÇÃO à Lei n.º ', o_orderkey % 90, '/1999, e ', "
                "element_at(array('alteração ao Decreto-Lei', 'alteração do decreto - lei', 'Altera o Decreto Lei', "
                "'altera o Decreto-Lei'), 1 + case o_orderkey % 4 when 2 then 3 else cast(o_orderkey % 4 as int) end), "
                "' n.º ', o_custkey % 90, '/2001.')")
    return orders(spark, d).select("o_orderkey", joined(labels.modified_laws(fr, labels.FR_MODIFIED_LAWS)).alias("fr"),
                                   joined(labels.modified_laws(pt, labels.PT_MODIFIED_LAWS)).alias("pt"))


@query("E30_original_law", """SELECT doc_id, CASE doc_id % 12 WHEN 11 THEN NULL WHEN 9 THEN true WHEN 10 THEN true ELSE false
    END AS original_law FROM documents""")
def _(spark, d):
    phrases = ["§ 1 wird wie folgt geändert", "Satz 2 wird angefügt", "wird wie folgt gefasst",
               "werden die Wörter 'a b' ersetzt", "wird das Wort 'x' gestrichen", "wird folgender Satz angefügt",
               "wird folgender Absatz 3 angefügt", "wird folgender § 9a eingefügt", "§ 4 wird aufgehoben",
               "werden die Wörter\nersetzt", "tritt in Kraft"]
    pick = F.get(F.array(*[F.lit(p) for p in phrases]), (F.col("doc_id") % 12).cast("int"))
    law = F.concat(F.col("text"), F.lit("\n"), pick)
    return docs(spark, d).select("doc_id", labels.is_original_de(law).alias("original_law"))


# --- sections -----------------------------------------------------------------------------------------------------

_BODY = "replace(replace(text, 'D.', ''), 'II', '')"


@query("E32_bill_section", f"""SELECT doc_id, md5(CASE doc_id % 4 WHEN 0 THEN {sql_strip(
    "'Artikel 1' || chr(10) || regexp_replace(text, ' +', ' ', 'g')")}
    WHEN 1 THEN {sql_strip("'Artikel 1' || chr(10) || regexp_replace(text, ' +', ' ', 'g') || ' Ende'")}
    ELSE {sql_strip("text || '  Besonderer Teil'")} END) AS t FROM documents""")
def _(spark, d):
    raw = F.expr("case doc_id % 4 when 0 then concat('Vorblatt  Artikel  1\\n', text, 'Besonderer  Teil Rest') "
                 "when 1 then concat('Artikel 1\\n', text, '  Ende') else concat(text, '  Besonderer Teil') end")
    return docs(spark, d).select("doc_id", F.md5(sections.bill_section(raw)).alias("t"))


@query("E33_impact_sections", f"""SELECT doc_id, md5(CASE WHEN doc_id % 3 <> 1 THEN {sql_strip(
    f"'C. Alternativen' || chr(10) || {_BODY}")} END) AS first, md5(CASE doc_id % 4
    WHEN 0 THEN {sql_strip(f"'Begründung' || chr(10) || {_BODY}")}
    WHEN 1 THEN 'Begründung' || chr(10) || {_BODY} || ' ' END) AS second FROM documents""")
def _(spark, d):
    first = F.expr(f"case doc_id % 3 when 0 then concat('C. Alternativen\\n', {_BODY}, ' D. Kosten ') "
                   f"when 1 then 'Keine Alternativen D. ' else concat('C. Alternativen\\n', {_BODY}, ' D.') end")
    second = F.expr(f"case doc_id % 4 when 0 then concat('Begründung\\n', {_BODY}, 'III Mehr') "
                    f"when 1 then concat('Begründung\\n', {_BODY}, ' ') else '' end")
    one, two = sections.impact_sections(F.concat(F.lit("Vorspann\n"), first, second))
    return docs(spark, d).select("doc_id", F.md5(one).alias("first"), F.md5(two).alias("second"))


@query("E34_amendment_block", """SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN 'II. ' || text END) AS t
    FROM documents""")
def _(spark, d):
    raw = F.expr(f"case when doc_id % 2 = 0 then concat('I. Der Bundestag\\n', 'II. ', text) else {_BODY} end")
    return docs(spark, d).select("doc_id", F.md5(sections.amendment_block(raw)).alias("t"))


@query("E35_plenary", """SELECT doc_id, CASE WHEN doc_id % 7 < 5 AND doc_id % 2 = 0 THEN 'LOWER' END AS house
    FROM documents""")
def _(spark, d):
    raw = F.expr("concat(repeat('x\\n', cast(doc_id % 7 as int)), case when doc_id % 2 = 0 then 'ASSEMBLÉE NATIONALE' else "
                 "'À L''ASSEMBLÉE NATIONALE' end, '\\n', text)")
    return docs(spark, d).select("doc_id", labels.names_plenary(raw).alias("house"))


@query("E38_separators", """SELECT o_orderkey, 'Lei ' || o_custkey || '/XIV/2 a' AS t FROM orders""")
def _(spark, d):
    raw = F.expr("concat('Lei n.º ', o_custkey, ' | XIV / 2 - a')")
    return orders(spark, d).select("o_orderkey", text.normalise_separators(raw).alias("t"))
