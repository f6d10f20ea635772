"""Personal data: fixed forms first, then forms that their contexts reveal.

Base matches of four kinds are the seeds. Every other token or run of digit groups that looks like an identifier (an `@`, or DIGITS
digits or more) is a candidate. Both have contexts: the two words before, and the word before with the word after. A context that
holds instances known to be of one kind is a pattern of that kind; an instance that trusted patterns hold becomes
known; so the graph of contexts and instances is scored in rounds, as joins and sums over distinct (instance,
context) edges, until a round changes nothing. A candidate whose score reaches TRUST is a span of that kind.

    confidence(context, kind) = own / (own + others + unlike + LIGHT * (1 + sqrt(unseen)))
    score(instance, kind)     = 1 - product over trusted contexts of (1 - confidence); 1 for seeds

`own` and `others` are the sums of its instances' scores of the kind and of other kinds. Instances that are not known speak against a
kind in full where their form does (`unlike`: `@` or not, or fewer than SHORT digits, as years and counts have). All others are
`unseen`: what the search is for, so they weigh lightly, and the lighter the more is known. A context is trusted from TRUST
on and with SUPPORT known instances, so contexts that hold all sorts of things say nothing. Scores never fall from round to round.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.llm.common import aside, scratch

KINDS = ["email", "ip", "card", "phone"]
TRUST, SUPPORT, DIGITS = 0.8, 3.0, 4
LIGHT, SHORT = 0.25, 6
FORMS = ["mail", "short", "long"]
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# A number starts where no digit stands before it: a run of digits that fails once fails from each of its digits.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOOKS, TOKEN, STRIP = re.compile(r"[0-9@]"), re.compile(r"\S*"), ".,;:!?()[]{}<>\"'`"
WORDS, NUMBER = re.compile(r"\S+"), re.compile(r"[0-9().+-]+")
NEAR = 120  # characters before and after that contexts are looked for first, and twice as many each time they don't suffice


def _emails(text: str) -> list[tuple[int, int]]:
    """Each match has one `@`: from the run of local characters before it to the domain after it. One pass."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > done and LOCAL.match(text[start - 1]):
                start -= 1
            if start < at:
                out.append((start, domain.end()))
                done = domain.end()
        at = text.find("@", max(at + 1, done))
    return out


def luhn(digits: str) -> bool:
    total = sum(int(c) if i % 2 == 0 else (int(c) * 2 - 9 if c > "4" else int(c) * 2) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed forms, by start, then kind as in KINDS."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if LOOKS.search(text):
        for m in IP.finditer(text):
            if all(len(p) <= 3 and int(p) <= 255 for p in (x.lstrip("0") or "0" for x in m[0].split("."))):
                out.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 40 and 12 <= len(d := _only_digits(m[0])) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= len(_only_digits(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


def candidates(text: str, base: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """What looks like an identifier and touches no base span: tokens with `@` or digits, and as one the maximal runs of tokens of digits
    and separators that are joined by a single space, or by a dash between two. A stop or comma ends a run."""
    out, done, i = [], 0, 0
    run: tuple[int, int, int] | None = None  # start, end, where its last token ends

    def close() -> None:
        if run:
            start, end, _ = run
            inside = text[start:end]
            more = inside.count(")") - inside.count("(")
            start -= more > 0 and text[start - 1:start] == "("
            end += more < 0 and text[end:end + 1] == ")"
            if "@" in inside or len(_only_digits(inside)) >= DIGITS:
                out.append((start, end))

    hit = LOOKS.search(text)
    while hit:
        left = max(text.rfind(c, done, hit.start()) for c in " \n\t\r\x0b\x0c") + 1 or done
        right = TOKEN.match(text, hit.start()).end()
        token = text[left:right]
        start = left + len(token) - len(token.lstrip(STRIP))
        end = right - (len(token) - len(token.rstrip(STRIP)))
        while i < len(base) and base[i][2] <= start:
            i += 1
        j = i
        while j < len(base) and base[j][2] <= start:
            j += 1
        if start < end and (j >= len(base) or base[j][0] >= end):
            number = NUMBER.fullmatch(text, start, end) is not None
            if run and number and text[left:start] in ("", "(") and text[run[2]:left] in (" ", " - "):
                run = run[0], end, right
            else:
                close()
                run = start, end, right
            if not number or text[end:right] not in ("", ")"):
                close()
                run = None
        else:
            close()
            run = None
        done = right
        hit = LOOKS.search(text, right)
    close()
    return out


def form(token: str) -> str:
    return "mail" if "@" in token else "short" if len(_only_digits(token)) < SHORT else "long"


def _mark(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x00".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _around(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    """The last two words before `start` and the first one after `end`, whole however long they are."""
    before, after, n = [], [], NEAR
    while len(before) < 3 and n < 2 * max(NEAR, start):
        before, n = WORDS.findall(text, max(0, start - n), start), 2 * n
    n = NEAR
    while len(after) < 2 and n < 2 * max(NEAR, len(text) - end):
        after, n = WORDS.findall(text, end, end + n), 2 * n
    return before[-2:], after[:1]


def contexts(text: str, start: int, end: int) -> list[int]:
    """The two words before, and the word before with the word after, in lower case, as hashes. None at a text's start."""
    before, after = ([w.lower() for w in words] for words in _around(text, start, end))
    out = [_mark("two", *before)] if len(before) > 1 else []
    return out + [_mark("one", before[-1], after[0])] if before and after else out


def _scan(docs: DataFrame) -> DataFrame:
    """(uid, .., base: spans, found: occurrences) per row of (text, uid, ..)."""
    kept = [c for c in docs.columns if c != "text"]
    span = pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())])
    seen = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("instance", pa.int64()),
                      ("form", pa.string()), ("contexts", pa.list_(pa.int64()))])

    def one(text: str) -> tuple[list, list]:
        base = base_spans(text)
        marks = [(s, e, k) for s, k, e in base] + [(s, e, None) for s, e in candidates(text, base)]
        found = [(s, e, k, _mark(text[s:e].lower()), form(text[s:e]), contexts(text, s, e)) for s, e, k in marks]
        return base, found

    def work(batches):
        for batch in batches:
            rows = [one(t.as_py() or "") for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array([[dict(start=s, kind=k, end=e) for s, k, e in r[0]] for r in rows], pa.list_(span)),
                 pa.array([[dict(zip(("start", "end", "kind", "instance", "form", "contexts"), f, strict=True)) for f in r[1]] for r in rows],
                          pa.list_(seen))], names=[*kept, "base", "found"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(kept).schema)
    return docs.select("text", *kept).mapInArrow(
        work, f"{fields}base array<struct<start: long, kind: string, `end`: long>>, found array<struct<start: long, "
              "`end`: long, kind: string, instance: long, form: string, contexts: array<long>>>")


def bootstrap(found: DataFrame) -> DataFrame:
    """(instance, kind, score) of all instances known or learnt, from occurrences (instance, form, kind or null, contexts)."""
    edges = scratch(found.select("instance", "form", F.explode("contexts").alias("context")).distinct(), "edges")
    known = scratch(found.where("kind IS NOT NULL").select("instance", "kind").distinct().withColumn("score", F.lit(1.0)), "seeds")
    last = None
    while (size := known.agg(F.count("*"), F.sum(F.col("score").cast("decimal(38,3)"))).head()) != last:
        last = size
        weight = edges.join(known, "instance").groupBy("context", "kind").agg(F.sum("score").alias("own"))
        weight = scratch(weight, "weights")
        at = weight.groupBy("context").agg(F.sum("own").alias("all"), F.max("own").alias("most")).where(F.col("most") >= SUPPORT)
        new = edges.join(at.select("context"), "context").join(known.select("instance").distinct(), "instance", "left_anti")
        new = new.groupBy("context").agg(*[F.count_if(F.col("form") == f).alias(f) for f in FORMS])
        unseen = {f: F.coalesce(f, F.lit(0)) for f in FORMS}
        mail = F.col("kind") == "email"
        unlike = F.when(mail, unseen["short"] + unseen["long"]).otherwise(unseen["short"] + unseen["mail"])
        like = F.when(mail, unseen["mail"]).otherwise(unseen["long"])
        trusted = weight.where(F.col("own") >= SUPPORT).join(at, "context").join(new, "context", "left").withColumn(
            "confidence", F.col("own") / (F.col("all") + unlike + LIGHT * (1 + F.sqrt(like)))).where(F.col("confidence") >= TRUST)
        trusted = scratch(trusted.select("context", "kind", "confidence"), "patterns")
        learnt = edges.join(trusted, "context").groupBy("instance", "kind").agg(
            F.round(1 - F.exp(F.sum(F.log(1 - F.col("confidence")))), 3).alias("score"))
        known = scratch(known.unionByName(learnt).groupBy("instance", "kind").agg(F.max("score").alias("score")), "instances")
    return known


def _spans(docs: DataFrame) -> DataFrame:
    """(uid, .., base, spans): spans are the base ones and those that the contexts reveal, by start, then kind."""
    scan = scratch(_scan(docs), "scan")
    found = scan.select("uid", F.explode("found").alias("f")).select("uid", "f.*")
    best = bootstrap(found).where(F.col("score") >= TRUST).groupBy("instance").agg(
        F.max_by("kind", F.struct("score", "kind")).alias("learnt"))
    new = found.where("kind IS NULL").select("uid", "instance", "start", "end").join(scratch(best, "learnt"), "instance")
    new = new.groupBy("uid").agg(F.collect_list(F.struct("start", F.col("learnt").alias("kind"), "end")).alias("new"))
    place = F.array(*map(F.lit, KINDS))
    every = F.transform(F.concat("base", F.coalesce("new", F.array().cast("array<struct<start: bigint, kind: string, end: bigint>>"))),
                        lambda s: F.struct(s["start"], F.array_position(place, s["kind"]).alias("place"), s["end"], s["kind"]))
    out = scan.drop("found").join(new, "uid", "left")
    return out.withColumn("spans", F.array_sort(every)).drop("new")


def personal_data(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of `docs` (key, text).

    Counts and the digest are of the base spans; `spans` lists all as kind:start:end in code points, comma-joined. Null text
    is empty: no spans, the digest of the empty string. Repeated rows get a row each; an empty table gives none; other
    columns are not read. A document's spans gather in its own row, as many as its text holds.
    """
    spans = _spans(docs.select("text", key).withColumn("uid", F.monotonically_increasing_id()))
    write = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    count = [of_kind(k) for k in KINDS]
    return spans.select(key, *count, F.sha2(write(F.col("base")), 256).alias("base_sha256"), write(F.col("spans")).alias("spans"))


def scrubbed(docs: DataFrame) -> DataFrame:
    """`docs` with each span replaced by its kind in brackets, of one that begins inside others the part that reaches
    beyond them; `n_chars`, if there, is the new text's. Null text stays null, empty text empty. All columns, whatever their names, and all rows
    stay; equal texts are changed alike; an empty table gives no rows."""
    plain, back = aside(docs, ["text", "n_chars"])
    rows = scratch(plain.withColumn("uid", F.monotonically_increasing_id()), "documents")
    spans = _spans(rows.select("text", "uid")).where(F.size("spans") > 0).select(F.col("uid").alias("_uid"), F.col("spans").alias("_spans"))
    joined = rows.join(scratch(spans, "spans"), F.col("uid") == F.col("_uid"), "left")
    cut = F.aggregate("_spans", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out")),
                      lambda acc, s: F.when(s["end"] <= acc["at"], acc).otherwise(F.struct(
                          s["end"].alias("at"), F.concat(acc["out"], F.array(
                              F.substr("text", (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int")),
                              F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))).alias("out"))),
                      lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr("text", (acc["at"] + 1).cast("int"))))
    out = joined.withColumn("text", F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut))
    return back(out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out)


def span_text(text: str, spans: str) -> list[str]:
    """The strings that a `spans` value of `personal_data` points to."""
    return [text[int(s):int(e)] for _, s, e in (x.split(":") for x in spans.split(",") if x)]


def digest(spans: list[tuple[int, str, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
