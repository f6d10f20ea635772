"""Date column expressions. Nothing here raises on bad input; unparseable dates are NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import all_matches, as_col, first_match, let, lines

# Month names in French and Portuguese.
FRENCH_MONTHS = {"janvier": 1, "février": 2, "fevrier": 2, "mars": 3, "avril": 4, "mai": 5, "juin": 6, "juillet": 7,
                 "août": 8, "septembre": 9, "octobre": 10, "novembre": 11, "décembre": 12, "decembre": 12}
PORTUGUESE_MONTHS = {"janeiro": 1, "fevereiro": 2, "março": 3, "abril": 4, "maio": 5, "junho": 6, "julho": 7,
                     "agosto": 8, "setembro": 9, "outubro": 10, "novembro": 11, "dezembro": 12}

# Date patterns as they occur in the sources.
FRENCH_DATE = r"(?:[\d]{1,2}|1er) [\wûé]{3,} \d\d\d\d"
FRENCH_SUBMISSION = r"(?U)déposé\(e\) le[\w\s]* (" + FRENCH_DATE + ")"
FRENCH_PUBLICATION = r"Publiée au Journal Officiel du " + FRENCH_DATE
GERMAN_DATE = r"\d{2}\.\d{2}\.\d{4}"
PORTUGUESE_DATE_TEXT = r"(\d{1,2}) de (" + "|".join(PORTUGUESE_MONTHS) + r") de (\d\d\d\d)"


def _month_map(months: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in months.items() for x in pair])


def _ymd(year: Column, month: Column, day: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", year, month, day), "y-M-d")


def french_date(c: Column | str) -> Column:
    """'lundi 3 août 2015' or '1er janvier 2020' to a date."""
    pattern = r"(?U)(\d{1,2})(?:er)?\s+([a-zûé]+|\d{1,2})\s+(\d{4})"

    def read(t: Column) -> Column:
        word = F.regexp_extract(t, pattern, 2)
        month = F.coalesce(F.try_element_at(_month_map(FRENCH_MONTHS), word).cast("string"), word)
        return _ymd(first_match(t, pattern, 3), month, first_match(t, pattern, 1))

    return let(as_col(c), read)


def portuguese_date(c: Column | str) -> Column:
    """'5 de dezembro de 2022' to a date."""
    t = as_col(c)
    month = F.try_element_at(_month_map(PORTUGUESE_MONTHS), F.regexp_extract(t, PORTUGUESE_DATE_TEXT, 2))
    return _ymd(first_match(t, PORTUGUESE_DATE_TEXT, 3), month.cast("string"), first_match(t, PORTUGUESE_DATE_TEXT, 1))


def parse_any(c: Column | str) -> Column:
    """Dates of any country's records: `y.M.d`, then `y-M-d`."""
    t = as_col(c)
    return F.coalesce(F.try_to_date(t, "y.M.d"), F.try_to_date(t, "y-M-d"))


def iso(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM-dd")


def rearrange(c: Column | str) -> Column:
    """'14.07.2022' to '2022.07.14', without validation."""
    return F.regexp_replace(as_col(c), r"^(\d+)\.(\d+)\.(\d+)$", r"$3.$2.$1")


def german_date(c: Column | str) -> Column:
    return F.try_to_date(as_col(c), "d.M.y")


def portuguese_iso(c: Column | str) -> Column:
    return F.try_to_date(as_col(c), "y-M-d")


def german_dates_in(c: Column | str) -> Column:
    """Every date of a text in the record form, in order."""
    return F.transform(all_matches(c, GERMAN_DATE, 0), rearrange)


def french_date_in(c: Column | str) -> Column:
    """Submission date if one is named, else the first date of the text."""
    return let(as_col(c), lambda t: french_date(
        F.coalesce(first_match(t, FRENCH_SUBMISSION), first_match(t, "(?U)" + FRENCH_DATE))))


def impact_date(c: Column | str) -> Column:
    """Date named in the first 300 characters of an impact assessment, ISO."""
    return let(F.substring(as_col(c), 1, 300),
               lambda head: iso(french_date(F.lower(first_match(head, "(?U)" + FRENCH_DATE)))))


def entry_into_force(law_text: Column | str, published: Column) -> Column:
    """Entry into force from the ten lines that start at its heading; `published` is the publication date.

    Five rules, first hit wins: the day after publication; a number of days after; the first day of the next month; a
    written date; immediately. A heading on the first line does not count.
    """
    def block(ls: Column) -> Column:
        short = F.array_position(ls, "Entrada em vigor")
        long = F.array_position(ls, "Entrada em vigor e produção de efeitos")
        return let(F.when(short > 0, short).when(long > 0, long).cast("int"), lambda at: F.when(
            at > 1, F.lower(F.replace(F.array_join(F.slice(ls, at, F.lit(10)), " "), F.lit("  "), F.lit(" ")))))

    def rule(t: Column) -> Column:
        days = first_match(t, r"entra em vigor (\d{1,3}) dias após", 1)
        return (
            F.when(F.contains(t, F.lit("no dia seguinte ao da sua publicação"))
                   | F.contains(t, F.lit("no dia seguinte à sua publicação")), F.date_add(published, 1))
            .when(days.isNotNull(), F.date_add(published, days.try_cast("int")))
            .when(F.contains(t, F.lit("no primeiro dia do mês seguinte ao da sua publicação")),
                  F.add_months(F.trunc(published, "MM"), 1))
            .when(t.rlike(PORTUGUESE_DATE_TEXT), portuguese_date(t))
            .when(F.contains(t, F.lit("entra imediatamente em vigor")), published)
        )

    return iso(let(let(lines(law_text), block), rule))
