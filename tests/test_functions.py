"""Field functions on hand-written values."""

import datetime

import pytest
from pyspark.sql import functions as F

from lexmill.functions import dates, labels, sections, text, urls, votes


def value(spark, column, x=None):
    return spark.createDataFrame([(x,)], "x string").select(column.alias("y")).first()["y"]


X = "x"
D = datetime.date


@pytest.mark.parametrize("raw,want", [
    ("1er janvier 2020", D(2020, 1, 1)), ("lundi 3 août 2015", D(2015, 8, 3)), ("4 fevrier 2011", D(2011, 2, 4)),
    ("9 décembre 2011", D(2011, 12, 9)), ("décembre 2011", None), ("31 février 2011", None), (None, None)])
def test_french_date(spark, raw, want):
    assert value(spark, dates.french_date(X), raw) == want


@pytest.mark.parametrize("raw,want", [("2022.07.14", D(2022, 7, 14)), ("2022-7-4", D(2022, 7, 4)), ("x", None), (None, None)])
def test_parse_any(spark, raw, want):
    assert value(spark, dates.parse_any(X), raw) == want


@pytest.mark.parametrize("law,want", [
    ("A\nEntrada em vigor\nno dia seguinte ao da sua publicação", "2022-12-06"),
    ("A\nEntrada em vigor\nentra em vigor 30 dias após", "2023-01-04"),
    ("A\nEntrada em vigor\nno primeiro dia do mês seguinte ao da sua publicação", "2023-01-01"),
    ("A\nEntrada em vigor\nem 1 de março de 2024", "2024-03-01"),
    ("A\nEntrada em vigor\nentra imediatamente em vigor", "2022-12-05"),
    ("Entrada em vigor\nentra imediatamente em vigor", None), ("A\nB", None), (None, None)])
def test_entry_into_force(spark, law, want):
    assert value(spark, dates.entry_into_force(X, F.lit(D(2022, 12, 5))), law) == want


def test_entry_into_force_unpublished(spark):
    law = "A\nEntrada em vigor\nentra imediatamente em vigor"
    assert value(spark, dates.entry_into_force(X, F.lit(None).cast("date")), law) is None


@pytest.mark.parametrize("raw,want", [
    ("A Favor: PS,  CH Contra: PSD Abstenção: PAN Ausência: X", ("PS,  CH", "PSD", "PAN")),
    ("A Favor: PS Contra: CH A Favor: L", ("L", "CH", None)), ("Contra PS", (None, None, None)), ("", (None, None, None))])
def test_vote_parties(spark, raw, want):
    assert tuple(value(spark, votes.vote_parties(X), raw)) == want


def test_vote_counts_de(spark):
    raw = "19/1 Drs 20/7 Seite: 1/2\ntext\n700\n690\n5\n6\n7\n8\n"
    assert value(spark, votes.vote_counts_de(X), raw) == ("20/7", (5, 6, 7))
    assert value(spark, votes.vote_counts_de(X), "ohne Marke 20/9") == ("20/9", None)


def test_white_space(spark):
    assert value(spark, text.strip(X), " \t a b \n ") == "a b"
    assert value(spark, text.remove_whitespace(X), None) == ""
    assert value(spark, text.dense_length(X), None) == 0
    assert value(spark, text.dense_length(X), " a b\n") == 2
    assert value(spark, text.clean_text(X), "") is None
    assert value(spark, text.clean_text(X), "Disponible au format Acrobat (12 Koctets)a\n\n\n\nb ") == "a\n\nb"


def test_sections(spark):
    whole = "x\nC. Alternativen\nKeine.\nD. Kosten\nBegründung\nA. Teil II. B"
    first, second = sections.impact_sections(X)
    assert value(spark, first, whole) == "C. Alternativen\nKeine."
    assert value(spark, second, whole) == "Begründung\nA. Teil"
    assert value(spark, first, "C. Alternativen\nKeine") is None
    assert value(spark, second, "Begründung\nA ") == "Begründung\nA "
    assert value(spark, second, "Begründung\nA III") == "Begründung\nA"
    assert value(spark, sections.bill_section(X), " a  b ") == "a  b"
    assert value(spark, sections.bill_section(X), "a Artikel  1\nb  c Besonderer  Teil d") == "Artikel 1\nb c"
    assert value(spark, sections.amendment_block(X), "I. a") is None
    assert value(spark, sections.bill_section(X), None) is None


def test_labels(spark):
    assert value(spark, labels.originator_pt(X), "A B (PS)") == ("A B", "PS")
    assert value(spark, labels.originator_pt(X), "Governo") == ("Governo", None)
    assert value(spark, labels.status_de(X), "Zurückgezogen") is None
    assert value(spark, labels.status_de(X), "Anderes") == "ONGOING"
    assert value(spark, labels.outcome_fr_file(X), "Irrecevable") == "Irrecevable"
    assert value(spark, labels.outcome_fr_page(X), "Irrecevable") == "INADMISSIBLE"
    assert value(spark, labels.law_id_pt(X), "Lei n.º 58-A/2020") == "58-A/2020"
    assert value(spark, labels.is_original_de(X), None) is None
    assert value(spark, labels.heading_parts(X), "no colon") is None
    assert value(spark, urls.part_after(X, "Fich="), "a?Fich=b&Fich=c") == "b&Fich=c"
    assert value(spark, urls.absolute_url(X), "/dyn/1") == "https://www.assemblee-nationale.fr/dyn/1"
