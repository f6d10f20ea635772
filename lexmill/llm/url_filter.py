"""URL filter: rules first, then the ratio of two character language models.

Accepted and rejected URLs each give counts of character sequences of one to ORDER + 1. A character's probability after its
context blends the counts of all context lengths (Witten-Bell: a context passes on as much weight as it has distinct
successors), so the order varies with what has been seen. The score is the mean logarithm of the two models' ratio over the
URL's characters and its end. A logistic curve turns a score into a probability; it is fitted on the URLs of one fold in
HELD_OUT, scored by models that count the other folds. The models that judge count all URLs that the rules decide.

Counts cover all rows and grow with them: they stay tables, and each level joins the one below by its suffix. Only the
histogram of held-out scores (2 * 100 * CLIP + 1 bins) reaches the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import partitions, scratch

ORDER = 4
HELD_OUT = 5
CLIP = 20
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without `://` or for null."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.coalesce(url, F.lit("")).substr(at + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null. `rules`: (verdict, rule), a rule being a host and a path from its
    first slash on. It fits the host and its subdomains where the path starts with the rule's."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, rule in sorted(rules, key=lambda r: len(r[1])):
        own_host, slash, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(slash + own_path)
        text, verdict = F.when(fits, rule).otherwise(text), F.when(fits, said).otherwise(verdict)
    return text, verdict


def _grams(urls: DataFrame) -> DataFrame:
    padded = F.concat(F.lit(START * ORDER), F.coalesce("url", F.lit("")), F.lit(END))
    chars = urls.withColumn("_chars", F.regexp_extract_all(padded, F.lit("(?s)(.)"), F.lit(1)))
    grams = F.transform(F.sequence(F.lit(1), F.size("_chars") - ORDER),
                        lambda i: F.concat_ws("", F.slice("_chars", i, ORDER + 1)))
    return chars.withColumn("gram", F.explode(grams)).drop("_chars")


def language_models(urls: DataFrame) -> DataFrame:
    """(gram, ratio) for every gram of `urls` (url, accepted, rejected: how many rows count for each model)."""
    last = ORDER + 1
    counts = _grams(urls).groupBy("gram").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    levels = [scratch(counts, "grams")]
    for k in range(ORDER, 0, -1):  # sequences of k characters, from those of k + 1
        shorter = levels[-1].groupBy(F.substring("gram", 2, k).alias("gram")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        levels.append(scratch(shorter, "grams"))
    model = None
    for k, level in zip(range(1, last + 1), reversed(levels), strict=True):
        level = level.withColumn("context", F.substring("gram", 1, k - 1)).withColumn("suffix", F.substring("gram", 2, k))
        context = level.groupBy("context").agg(*[f(m).alias(f"{n}{m}") for m in "ar" for n, f in (
            ("all_", F.sum), ("kinds_", lambda c: F.count_if(F.col(c) > 0)))])
        joined = level.join(scratch(context, "contexts"), "context")
        joined = joined.withColumns({"pa": F.lit(1 / 256), "pr": F.lit(1 / 256)}) if model is None else \
            joined.join(model.withColumnsRenamed({"gram": "suffix", "a": "pa", "r": "pr"}), "suffix")
        blend = {m: F.when(F.col(f"all_{m}") > 0, (F.col(m) + F.col(f"kinds_{m}") * F.col(f"p{m}")) /
                           (F.col(f"all_{m}") + F.col(f"kinds_{m}"))).otherwise(F.col(f"p{m}")) for m in "ar"}
        model = scratch(joined.select("gram", *[c.alias(m) for m, c in blend.items()]), "model")
    return model.select("gram", F.log(F.col("a") / F.col("r")).alias("ratio"))


def calibrate(held_out: DataFrame, steps: int = 30) -> tuple[float, float]:
    """Slope and offset of a logistic curve through the held-out (score, accepted, rejected), both classes weighing alike.
    With a class missing the raw sign decides."""
    bins = held_out.groupBy(F.round(F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), "score")), 2).alias("x")).agg(
        F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).orderBy("x").collect()
    n_a, n_r = sum(b.a for b in bins), sum(b.r for b in bins)
    if not n_a or not n_r:
        return 1.0, 0.0
    slope, offset = 1.0, 0.0
    for _ in range(steps):  # Newton's method with a small ridge
        g0, g1, h00, h01, h11 = 1e-3 * (slope - 1), 1e-3 * offset, 1e-3, 0.0, 1e-3
        for b in bins:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * b.x + offset))))
            wa, wr = b.a / n_a, b.r / n_r
            e, h = (wa + wr) * p - wa, (wa + wr) * p * (1 - p)
            g0, g1, h00, h01, h11 = g0 + e * b.x, g1 + e, h00 + h * b.x * b.x, h01 + h * b.x, h11 + h
        det = h00 * h11 - h01 * h01
        slope, offset = slope - (h11 * g0 - h01 * g1) / det, offset - (h00 * g1 - h01 * g0) / det
    return slope, offset


def scores(urls: DataFrame, models: DataFrame) -> DataFrame:
    """(uid, score) per row of `urls` (uid, url), all of whose grams are in `models`."""
    scored = _grams(urls.select("uid", "url")).select("uid", "gram").join(models, "gram")
    return scored.groupBy("uid").agg(F.round(F.avg("ratio"), 9).alias("score"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id") -> DataFrame:
    """(key, host, path, rule, verdict, score, p_accept), one row per row of `pages` (key, url).

    Null URLs and URLs without `://` have an empty host and path, fit no rule and are judged by the models (null like the
    empty string). Repeated rows count as often as they occur and get a row each; an empty table gives none. Without rows
    that the rules decide, scores are 0 and the verdict is `allow`. Other columns of `pages` are not read.
    """
    host, path = host_path(F.col("url"))
    urls = pages.groupBy("url").agg(F.count("*").alias("n")).withColumns({"host": host, "path": path})
    rule, said = rule_columns(F.col("host"), F.col("path"), rules)
    urls = urls.withColumns({"rule": rule, "said": said})
    # Dealt out before they are written: few distinct URLs would else lie in one file, and all their characters in one task.
    urls = urls.repartition(partitions(pages.sparkSession), "url")
    urls = scratch(urls.withColumn("uid", F.monotonically_increasing_id()), "urls")
    accepted, rejected = (F.when(F.col("said") == v, F.col("n")).otherwise(0) for v in ("allow", "block"))
    held = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    ruled = urls.where("said IS NOT NULL").select("uid", "url", "n", "said")
    train = ruled.select("url", *[F.when(held, 0).otherwise(c).alias(m) for m, c in
                                  (("accepted", accepted), ("rejected", rejected))])
    apart = scratch(scores(ruled.where(held), language_models(train)), "held_out")
    apart = ruled.join(apart, "uid")
    slope, offset = calibrate(apart.select("score", accepted.alias("accepted"), rejected.alias("rejected")))
    models = language_models(urls.select("url", accepted.alias("accepted"), rejected.alias("rejected")))
    scored = scratch(urls.join(scores(urls, models), "uid"), "scored")
    p = F.round(1 / (1 + F.exp(-(F.col("score") * slope + offset))), 9)
    verdict = F.coalesce("said", F.when(p >= 0.5, "allow").otherwise("block"))
    judged = scored.select(F.col("url").alias("_url"), "host", "path", "rule", verdict.alias("verdict"), "score",
                           p.alias("p_accept"))
    return pages.select(key, "url").join(judged, F.col("url").eqNullSafe(F.col("_url"))).drop("_url", "url")
