"""Sections cut out of document texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import as_col, let, strip

# Section markers of German bill documents. The end of the second impact section is a pattern.
BILL_START, BILL_END = "Artikel 1\n", "Besonderer Teil"
IMPACT_START, IMPACT_END = "C. Alternativen\n", "D."
REASONS_START, REASONS_END = "Begründung\n", "II.|Besonderer Teil"
AMENDMENT_START = "II."


def _from(c: Column, marker: str) -> Column:
    return F.substring(c, F.locate(marker, c), F.length(c))


def bill_section(c: Column | str) -> Column:
    """Bill text from its first article to the special part; the whole text if it has no first article."""
    def cut(b: Column) -> Column:
        body = F.substring_index(_from(b.squeezed, BILL_START), BILL_END, 1)
        return strip(F.when(F.locate(BILL_START, b.squeezed) > 0, body).otherwise(b.t))

    return let(let(as_col(c), lambda t: F.struct(t.alias("t"), F.regexp_replace(t, " +", " ").alias("squeezed"))), cut)


def impact_sections(c: Column | str) -> tuple[Column, Column]:
    """The two impact sections. The first needs both markers; the second may run, unstripped, to the end."""
    def first(t: Column) -> Column:
        return let(F.when(F.locate(IMPACT_START, t) > 0, _from(t, IMPACT_START)), lambda tail: F.when(
            F.locate(IMPACT_END, tail) > 0, strip(F.substring_index(tail, IMPACT_END, 1))))

    def second(t: Column) -> Column:
        return let(F.when(F.locate(REASONS_START, t) > 0, _from(t, REASONS_START)), lambda tail: let(
            F.regexp_instr(tail, F.lit(REASONS_END)),
            lambda stop: F.when(stop > 0, strip(F.substring(tail, F.lit(1), stop - 1))).otherwise(tail)))

    return let(as_col(c), first), let(as_col(c), second)


def amendment_block(c: Column | str) -> Column:
    """Amendment text from its second part on, NULL without one."""
    t = as_col(c)
    return F.when(F.locate(AMENDMENT_START, t) > 0, _from(t, AMENDMENT_START))
