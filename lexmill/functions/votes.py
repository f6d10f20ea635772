"""Vote results from text, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import all_matches, as_col, first_match, let, lines, strip

# Labels of the vote texts.
PT_VOTE_LABELS = ("Contra", "A Favor", "Abstenção", "Ausência")
PT_VOTE_MENTION = "(Contra:|A Favor:|Abstenção:|unanimidade)"
FR_VOTE_PATTERNS = {"final_vote_for": r"Pour l'adoption : ([\d]+)", "final_vote_against": r"Contre : ([\d]+)",
                    "final_vote_abst": r"Abstention : ([\d]+)"}


def vote_parties(c: Column | str) -> Column:
    """Party lists of a Portuguese vote text as struct<vote_for, vote_against, vote_abst>; the last of a label wins."""
    t = as_col(c)
    for label in PT_VOTE_LABELS:
        t = F.replace(t, F.lit(label), F.lit("\n" + label))

    def sides(parts: Column) -> Column:
        def side(label: str) -> Column:
            own = F.filter(parts, lambda x: F.startswith(x, F.lit(label + ":")))
            return strip(F.get(F.split(F.try_element_at(own, F.lit(-1)), ":"), 1))

        return F.when(parts.isNotNull(), F.struct(
            side("A Favor").alias("vote_for"), side("Contra").alias("vote_against"),
            side("Abstenção").alias("vote_abst")))

    return let(lines(t), sides)


def vote_counts_fr(c: Column | str) -> dict[str, Column]:
    return {name: first_match(c, p, 1).try_cast("int") for name, p in FR_VOTE_PATTERNS.items()}


def vote_counts_de(c: Column | str) -> Column:
    """struct<final_version_printed_matter_id, counts<final_vote_for, final_vote_against, final_vote_abst>> of a German roll-call text.

    The id is the last printed-matter number before 'Seite:'; the counts are lines 3 to 5 of the first run of six
    numbers, which must stand on six lines.
    """
    t = as_col(c)
    run = F.regexp_substr(t, F.lit(r"(?U)(\d+\s+){6}"))

    counts = ("final_vote_for", "final_vote_against", "final_vote_abst")
    numbers = let(F.filter(lines(run), lambda x: x != ""), lambda n: F.when(F.size(n) == 6, F.struct(
        *[strip(F.get(n, 2 + i)).try_cast("int").alias(name) for i, name in enumerate(counts)])))
    ids = all_matches(F.substring_index(t, "Seite:", 1), r"\d+/\d+", 0)
    return F.struct(F.try_element_at(ids, F.lit(-1)).alias("final_version_printed_matter_id"), numbers.alias("counts"))
