"""URL column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import as_col, first_match

# Hosts, and the search parameters the German bill lists append to every link.
FRENCH_HOST = "https://www.assemblee-nationale.fr"
PORTUGUESE_HOST = "https://www.parlamento.pt"
_SEARCH = (r"\?f.typ=Vorgang&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen"
           r"&f.vorgangstyp_p=05Gesetze%2C%20Rechtsnormen~Gesetzgebung")
_PAGING = r"(&start=\d+)?&rows=250&sort=basisdatum_ab&pos=\d+"
LINK_PARAMS = _SEARCH + r"&f.drucksachetyp_p=05Gesetze&f.drucksachetyp_p=05Gesetze~Gesetzentwurf" + _PAGING
OLD_LINK_PARAMS = _SEARCH + r"&f.aktivitaetsart_p=01Antr%C3%A4ge%2C%20Gesetzentw%C3%BCrfe" + _PAGING
DEBATE_URL = (r"^https://debates\.parlamento\.pt/catalogo/(.+?)/(.+?)/(.+?)/(.+?)/(.+?)/(.+?)/(.+?)/(.+?)"
              r"\?pgs=(.+?)-(.+?)&(.+)$")
DEBATE_PARTS = ("periodo", "publicacao", "serie", "legis", "sessao", "numero", "data", "pagina", "start_pg", "end_pg")


def clean_url(c: Column | str) -> Column:
    """URL without its fragment."""
    return F.substring_index(as_col(c), "#", 1)


def absolute_url(c: Column | str, host: str = FRENCH_HOST, known=("http://", "https://", "www.")) -> Column:
    url = as_col(c)
    return F.when(url.rlike("^(" + "|".join(k.replace(".", r"\.") for k in known) + ")"), url).otherwise(
        F.concat(F.lit(host), url))


def strip_search_params(c: Column | str) -> Column:
    """Bill link without the parameters of the list it was found on (both known forms)."""
    return F.regexp_replace(F.regexp_replace(as_col(c), OLD_LINK_PARAMS, ""), LINK_PARAMS, "")


def part_after(c: Column | str, delimiter: str) -> Column:
    """Everything behind the first occurrence of a delimiter, empty if there is none."""
    url = as_col(c)
    at = F.locate(delimiter, url)
    return F.when(at > 0, F.substring(url, at + len(delimiter), F.length(url))).when(at == 0, F.lit(""))


def debate_parts(c: Column | str) -> dict[str, Column]:
    """The ten parts of a structured debate URL; the date is moved one day back."""
    url = as_col(c)
    out = {name: first_match(url, DEBATE_URL, i + 1) for i, name in enumerate(DEBATE_PARTS)}
    out["data"] = F.date_format(F.date_sub(F.try_to_date(out["data"], "y-M-d"), 1), "yyyy-MM-dd")
    return out
