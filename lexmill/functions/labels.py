"""Label translations and small field parsers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import all_matches, as_col, filled_lines, first_match, let, strip

# Enumerations of the record model.
GOVERNMENT, INDIVIDUAL_MP = "GOVERNMENT", "INDIVIDUAL_MP"
PASSED, REJECTED, EXPIRED, WITHDRAWN, ONGOING = "PASS", "REJECT", "EXPIRED", "WITHDRAWN", "ONGOING"
STATUSES = (PASSED, REJECTED, EXPIRED, WITHDRAWN, ONGOING)
LOWER, UPPER = "LOWER", "UPPER"

# Source labels and their codes.
FRENCH_BILL_TYPES = ("Proposition de loi", "Projet de loi")
PORTUGUESE_BILL_TYPES = ("Projeto de Lei", "Proposta de Lei")
GERMAN_HOUSES = {"Bundestag": LOWER, "BT": LOWER, "Bundesrat": UPPER, "BR": UPPER}
FRENCH_STAGES = {"1ère lecture": "1st reading", "2ème lecture": "2nd reading"}
FRENCH_OUTCOMES = {"Adopté": "ACCEPTED", "Rejeté": "REJECTED", "Non soutenu": "REJECTED", "Tombé": "REJECTED",
                   "Retiré": "REJECTED", "Non renseigné": None}
GERMAN_NO_STATUS = ("Erledigt durch Ablauf der Wahlperiode",
                    "Nicht abgeschlossen - Einzelheiten siehe Vorgangsablauf", "Zurückgezogen", "Für erledigt erklärt")
GERMAN_SKIPPED_STAGES = ("Geschäftsordnungsantrag", "Einzelpläne", "Fortsetzung", "Nachtrag", "(Gesetzentwurf)")
PORTUGUESE_TOPICS = ("Environment", "Communications", "Culture", "Defense", "Education, science, youth and sports",
                     "International Affairs, Cooperation and Portuguese Communities", "Health",
                     "Immigration and Refugees", "Social Security", "Domestic Violence")

# Identifier patterns.
PT_BILL_ID = r"\d{1,4}/[IVX]+/\d"
PT_LAW_ID = r"(?U)\d{1,3}(?:-\w)?/\d{4}"
PT_LAW_MENTION = r"(?U)Lei n.º \d{1,3}(?:-\w)?/\d{4}"
FR_LAW_ID = r"n° (\d+-\d+)"
FR_BILL_ID = r"(?U)n°\s(\d+)"
DE_PRINTED_MATTER = r"\d+/\d+"
PARTY = r"[A-Z]+-?[A-Z]+"
FR_MODIFICATION_VERBS = ("abrogé", "completé", "complété", "supprimé", "modifié", "redigé", "rédigé", "inseré",
                         "insérés", "remplacé")
# Any character is `(?s:.)`: a class such as [\s\S] means the same and takes over twenty times as long.
FR_MODIFIED_LAWS = tuple(rf"loi n° (\d+-\d+) (?s:.{{0,200}}) {v}" for v in FR_MODIFICATION_VERBS)
PT_MODIFIED_LAWS = (
    r"(?iu)alteração à lei n.º (\d+/\d+)",
    r"(?iuU)alteração ao decreto\s?-\s?lei n.º (\d+/\d+)",
    r"(?iuU)alteração do decreto\s?-\s?lei n.º (\d+/\d+)",
    r"(?iuU)altera o decreto\s?-\s?lei n.º (\d+/\d+)",
)
DE_MODIFYING_PHRASES = ("wird wie folgt geändert", "wird angefügt", "wird wie folgt gefasst",
                        "werden die Wörter .{0,200}? ersetzt", "wird das Wort .{0,200}? gestrichen",
                        "wird folgender Satz angefügt", "wird folgender Absatz .{0,200}? angefügt",
                        "wird folgender .{0,200}? eingefügt", "wird aufgehoben")


def has(c: Column, text: str) -> Column:
    return F.contains(c, F.lit(text))


def _lookup(c: Column, table: dict, default: Column) -> Column:
    out = None
    for key, value in table.items():
        v = F.lit(value).cast("string")
        out = F.when(c == key, v) if out is None else out.when(c == key, v)
    return out.otherwise(default)


def is_status(c: Column | str) -> Column:
    return as_col(c).isin(*STATUSES)


def origin_fr(c: Column | str) -> Column:
    t = F.lower(as_col(c))
    return (F.when(F.startswith(t, F.lit("projet")), GOVERNMENT)
            .when(F.startswith(t, F.lit("proposition")), INDIVIDUAL_MP))


def origin_pt(c: Column | str) -> Column:
    t = as_col(c)
    return F.when(t == "Proposta de Lei", GOVERNMENT).when(t == "Projeto de Lei", INDIVIDUAL_MP)


def origin_de(c: Column | str) -> Column:
    t = as_col(c)
    return F.when(has(t, "Bundesregierung"), GOVERNMENT).when(t.isNotNull(), INDIVIDUAL_MP)


def house_fr(c: Column | str) -> Column:
    return let(as_col(c), lambda t: F.when(has(t, "Assemblée nationale"), LOWER).when(has(t, "Sénat"), UPPER))


def house_de(c: Column | str) -> Column:
    return let(as_col(c), lambda t: _lookup(t, GERMAN_HOUSES, F.lit(None).cast("string")))


def repair_house_de(c: Column | str) -> Column:
    """House names in any case to codes; what is neither stays."""
    t = as_col(c)
    return F.when(F.lower(t) == "bundestag", LOWER).when(F.lower(t) == "bundesrat", UPPER).otherwise(t)


def stage_name_fr(c: Column | str) -> Column:
    return let(as_col(c), lambda t: _lookup(t, FRENCH_STAGES, t))


def outcome_fr_file(c: Column | str) -> Column:
    """Outcome in amendment files; unknown labels stay."""
    t = as_col(c)
    return _lookup(t, FRENCH_OUTCOMES, t)


def outcome_fr_page(c: Column | str) -> Column:
    """Outcome on amendment pages; unknown labels are NULL."""
    return let(as_col(c), lambda t: _lookup(t, FRENCH_OUTCOMES | {"Irrecevable": "INADMISSIBLE"},
                                            F.lit(None).cast("string")))


def outcome_de(c: Column | str) -> Column:
    t = as_col(c)
    return F.when(t.isin("Verkündet", "Angenommen"), PASSED).when(t == "Abgelehnt", REJECTED)


def status_de(c: Column | str) -> Column:
    return let(as_col(c), lambda t: F.when(t == "Verkündet", PASSED).when(t == "Abgelehnt", REJECTED)
               .when(t.isin(*GERMAN_NO_STATUS), F.lit(None).cast("string")).otherwise(ONGOING))


def originator(name: Column, affiliation: Column) -> Column:
    return F.struct(name.alias("originator_name"), affiliation.cast("string").alias("originator_affiliation"))


def originator_pt(c: Column | str) -> Column:
    """'Name (PARTY)' to name and affiliation."""
    def read(t: Column) -> Column:
        at = F.locate("(", t)
        both = (at > 0) & has(t, ")")
        name = F.when(both, F.substring(t, F.lit(1), F.greatest(at - 2, F.lit(0)))).otherwise(t)
        return originator(name, F.when(both, F.substring(t, at + 1, F.length(t) - at - 1)))

    return let(as_col(c), read)


def government_party_de(c: Column | str) -> Column:
    return strip(F.replace(as_col(c), F.lit("Urheber: Bundesregierung,"), F.lit("")))


def committee_fr(c: Column | str) -> Column:
    """Committee text to name and role; a role only if there are exactly two lines."""
    def read(b: Column) -> Column:
        two = F.size(b.ls) == 2
        role = F.when(F.get(b.ls, 1) == "Commission saisie au fond", "Lead").otherwise("Advisory")
        return F.struct(F.when(two, F.get(b.ls, 0)).otherwise(strip(b.t)).alias("committee_name"),
                        F.when(two, role).alias("committee_role"),
                        F.lit(None).cast("string").alias("committee_date"))

    return let(let(as_col(c), lambda t: F.struct(t.alias("t"), filled_lines(t).alias("ls"))), read)


def bill_id_pt(c: Column | str) -> Column:
    return first_match(c, PT_BILL_ID)


def bill_id_fr(url: Column | str, text: Column | str) -> Column:
    """Legislature from the URL, number from the text."""
    return F.concat(first_match(url, r"/dyn/(\d+)/", 1), F.lit("/"), first_match(text, FR_BILL_ID, 1))


def bill_id_fr_file(c: Column | str) -> Column:
    return first_match(c, r"n° (\d+)$", 1)


def law_id_fr(c: Column | str) -> Column:
    return first_match(c, FR_LAW_ID, 1)


def law_id_pt(c: Column | str) -> Column:
    return first_match(c, PT_LAW_ID)


def modified_laws(c: Column | str, patterns) -> Column:
    """Sorted distinct law ids named by any of the patterns; NULL for a NULL text. The text is evaluated once."""
    return let(as_col(c), lambda t: F.array_sort(F.array_distinct(F.flatten(F.array(*[all_matches(t, p, 1) for p in patterns])))))


def is_original_de(c: Column | str) -> Column:
    t = F.nullif(as_col(c), F.lit(""))
    return ~t.rlike("|".join(DE_MODIFYING_PHRASES))


def party(c: Column | str) -> Column:
    return first_match(c, PARTY)


def heading_parts(c: Column | str) -> Column:
    """'type : title (…)' to its two fields, NULL without a colon."""
    def read(parts: Column) -> Column:
        title = strip(F.substring_index(F.get(parts, 1), "(", 1))
        return F.when(F.size(parts) > 1, F.struct(F.get(parts, 0).alias("law_type"), title.alias("title")))

    return let(F.transform(F.split(as_col(c), ":"), strip), read)


def title_pt(c: Column | str) -> Column:
    return strip(F.regexp_replace(as_col(c), r"\[formato (DOC|DOCX|PDF)\]", ""))


def names_plenary(c: Column | str) -> Column:
    """LOWER if one of the first five lines is the name of the national assembly."""
    head = F.slice(F.split(as_col(c), "\n"), 1, 5)
    return F.when(F.array_contains(head, "ASSEMBLÉE NATIONALE"), LOWER)
