from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import fingerprint, pii, suffix_dedup, toxicity

# --- suffix arrays ------------------------------------------------------------------------------------------------


def cut(rows, span=50):
    """(n_bytes, n_removed, n_spans, kept) per row, by sets of all spans of smaller keys."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, waiting, last, out = set(), set(), object(), {}
    for i in order:
        key, text = rows[i][:2]
        if key != last:
            seen |= waiting
            waiting, last = set(), key
        b = (text or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1):
            if b[k:k + span] in seen:
                gone[k:k + span] = b"\1" * span
            waiting.add(b[k:k + span])
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (key, len(b), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), kept)
    return out.values()


def some_texts(r, n):
    pool = ["".join(r.choice("abcdef é🙂\n") for _ in range(r.randrange(20, 160))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [r.choice(pool) if r.random() < 0.4 else "".join(r.choice("ghij klé") for _ in range(r.randrange(0, 90))) for _ in range(r.randrange(0, 7))]
        rows.append((i, "".join(parts)))
    return rows


def check_cut(documents, rows):
    frame = documents(rows).selectExpr("*", "1 as chunk", "2 as id", "3 as marks", "4 as key")
    got = [tuple(r) for r in suffix_dedup.without_repeats(frame).collect()]
    want = [(*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in cut(rows)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_cuts_of_random_texts_in_small_chunks(documents, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 7)
    r = random.Random(1)
    rows = some_texts(r, 90)
    r.shuffle(rows)
    check_cut(documents, rows)


def test_cuts_of_odd_texts_ties_and_nulls(documents):
    t = "0123456789" * 5
    rows = [(3, t), (3, t), (None, t + "x"), (None, t), (1, t[:49]), (2, None), (4, ""), (5, "a" * 3000), (6, "a" * 60 + "b" * 60),
            (7, "x" + t + "y"), (8, t[1:] + "0"), (9, ("p" * 30 + "q" * 30) * 40), (10, ("q" * 30 + "p" * 30) * 3)]
    check_cut(documents, rows)
    assert suffix_dedup.without_repeats(documents([])).count() == 0


def test_kept_text_is_what_the_digest_says(documents):
    r = random.Random(2)
    rows = some_texts(r, 30)
    got = {x.doc_id: bytes(x.kept) for x in suffix_dedup.without_repeats(documents(rows), with_text=True).collect()}
    assert got == {x[0]: x[4] for x in cut(rows)}


@settings(max_examples=150, deadline=None)
@given(st.binary(min_size=50, max_size=400), st.integers(0, 300))
def test_equal_spans_have_equal_samples(data, at):
    span = data[at % (len(data) - 49):][:50]
    marks = set(suffix_dedup.suffixes(span)[1].tolist())
    assert marks and marks <= set(suffix_dedup.suffixes(data)[1].tolist())


# --- personal data ------------------------------------------------------------------------------------------------

FORMS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(text):
    out = []
    for n, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            luhn = sum(x - 9 * (x > 9) for x in double) % 10 == 0
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 12 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]:
                out.append((m.start(), n, m.end()))
    return [(s, list(FORMS)[n], e) for s, n, e in sorted(out)]


@settings(max_examples=400, deadline=None)
@given(st.text("aZ09@.-+ ()_%25é\n", max_size=60))
def test_base_forms(text):
    assert pii.base_spans(text) == base(text)


@pytest.mark.parametrize("text", ["a@b@c.d", "a@b.c@d.e", "@a.b", "a@b..c", "1.2.3.4.5.6.7.8", "01.002.0003.255", "256.1.1.1 1.1.1.256",
                                  "4111 1111-1111 1111", "4111  1111 1111 1111", "+1 (555) 123-4567", "+1 ( ) +22 333 444 55.", "9" * 40,
                                  "4111111111111111.1.1.1", "+4111111111111111"])
def test_base_forms_next_to_each_other(text):
    assert pii.base_spans(text) == base(text)


def test_long_runs_take_linear_time():
    for run in ("a" * 300_000, "9" * 300_000, "a@" * 100_000, "1." * 100_000, "+1(" * 100_000, "." * 200_000 + "@"):
        spans = pii.base_spans(run)
        pii.candidates(run, spans)


def test_contexts_reveal_what_the_forms_miss(documents):
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} {word()} my phone +1 (555) {r.randrange(100, 999)}-{r.randrange(1000, 9999)} {word()}") for i in range(40)]
    rows += [(100, "so my phone 555-1234-77 now"), (101, "so the year 1999-2000 now"), (102, None), (103, ""), (104, "in my phone book")]
    rows += [(200 + i, f"{word()} the year {1900 + i} {word()}") for i in range(30)]
    docs = documents(rows).selectExpr("*", "1 as uid", "2 as base", "3 as spans", "4 as kind")
    got = {x.doc_id: x for x in pii.personal_data(docs).collect()}
    assert got[100].spans == "phone:12:23" and got[100].n_phone == 0
    assert [got[k].spans for k in (101, 102, 103, 104)] == [""] * 4 and all(got[200 + i].spans == "" for i in range(30))
    for k, t in rows:
        spans = base(t)
        digest = hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, n, e in spans).encode()).hexdigest()
        assert got[k].base_sha256 == digest == pii.digest(spans)
        assert [got[k][f"n_{n}"] for n in FORMS] == [sum(x[1] == n for x in spans) for n in FORMS]
        assert set(f"{n}:{s}:{e}" for s, n, e in spans) <= set(got[k].spans.split(",") if got[k].spans else [])
    clean = pii.scrubbed(docs)
    assert clean.columns == docs.columns
    texts = {x.doc_id: (x.text, x.n_chars) for x in clean.collect()}
    assert texts[100] == ("so my phone [PHONE] now", 23) and texts[102] == (None, None) and texts[101][0] == dict(rows)[101]
    assert texts[0][0].endswith(texts[0][0].split("[PHONE]")[1]) and "[PHONE]" in texts[0][0]
    assert pii.personal_data(documents([])).count() == 0 and pii.scrubbed(documents([])).count() == 0
    twice = pii.personal_data(documents([(1, "a@b.cd"), (1, "a@b.cd"), (None, "é a@b.cd")])).collect()
    assert sorted((x.spans, x.n_email) for x in twice) == [("email:0:6", 1), ("email:0:6", 1), ("email:2:8", 1)]


@pytest.mark.parametrize(("seeds", "unseen"), [(3, 1), (3, 3), (7, 1), (40, 40), (60, 200)])
def test_contexts_of_which_many_instances_are_unseen(documents, seeds, unseen):
    r = random.Random(seeds)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} my phone +1 (555) {100 + i}-{r.randrange(1000, 9999)} {word()}") for i in range(seeds)]
    rows += [(1000 + i, f"{word()} my phone 555-{1000 + i}-77 {word()}") for i in range(unseen)]
    rows += [(2000 + i, f"{word()} in the +1 (444) {100 + i}-{r.randrange(1000, 9999)} {word()}") for i in range(4)]
    rows += [(3000 + i, f"{word()} in the {1900 + i} {word()}") for i in range(8)]  # years: no pattern
    rows += [(4000 + i, f"{word()} send to +1 (333) {100 + i}-{r.randrange(1000, 9999)} {word()}") for i in range(4)]
    rows += [(5000 + i, f"{word()} send to {word()}{i}@example.org {word()}") for i in range(4)] + [(6000, "so send to 333-1234-77 now")]
    got = {x.doc_id: x.spans for x in pii.personal_data(documents(rows)).collect()}
    assert all(got[1000 + i] == "phone:15:26" for i in range(unseen))
    assert all(got[3000 + i] == "" for i in range(8)) and got[6000] == ""


SPACED = ["555 123 4567", "0171 234 567", "555 123 456", "(555) 123-4567", "(555)123-4567", "555 - 123 - 4567", "555.123 4567", "+1 555 123",
          "555 (123) 4567", "555 123 (4567)", "4111 1111 1111 1112", "4111-1111 11111112", "12 34", "555-1234-77"]


@pytest.mark.parametrize("number", SPACED)
def test_numbers_in_groups_are_whole_candidates(number):
    for head, tail in (("my phone ", " now"), ("my phone ", ", now"), ("my phone: ", ". 2 x"), ("a\n", "\n7"), ("", "")):
        text = f"{head}{number}{tail}"
        at = len(head)
        assert pii.candidates(text, pii.base_spans(text)) == [(at, at + len(number))]


@pytest.mark.parametrize(("text", "want"), [
    ("id ab1234 5678 x", ["ab1234", "5678"]), ("1234, 5678", ["1234", "5678"]), ("in 1999. 2000 x", ["1999", "2000"]),
    ("1234  5678\n9012", ["1234", "5678", "9012"]), ("10.0.0.1 5551234", ["5551234"]), ("me @home 1234 5678", ["@home", "1234 5678"]),
    ("(1234) [5678]", ["1234", "5678"]), ("see (555 1234) x", ["555 1234"]), ("1 2 3", [])])
def test_where_candidates_end(text, want):
    assert [text[s:e] for s, e in pii.candidates(text, pii.base_spans(text))] == want


def test_contexts_reveal_spaced_numbers(documents):
    r = random.Random(7)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} my phone +1 (555) {100 + i}-{r.randrange(1000, 9999)} {word()}") for i in range(10)]
    rows += [(100 + i, f"{word()} my phone {x} {word()}") for i, x in enumerate(SPACED) if len(x) > 5]
    got = {x.doc_id: x.spans for x in pii.personal_data(documents(rows)).collect()}
    assert all(got[100 + i] == f"phone:15:{15 + len(x)}" for i, x in enumerate(SPACED) if len(x) > 5)


def test_contexts_are_followed_until_nothing_new_is_learnt(documents):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    rows = [(i, f"{word()} ask hop0 +1 (555) {100 + i}-{r.randrange(1000, 9999)} {word()}") for i in range(4)]
    for hop in range(6):  # each context leads to numbers that the next one holds as well
        rows += [(100 * (hop + 1) + 10 * k + i, f"{word()} ask hop{hop + k} 555-{hop}{i}34-77 {word()}") for k in range(2) for i in range(4)]
    got = {x.doc_id: x.spans for x in pii.personal_data(documents(rows)).collect()}
    assert all(got[k] == "phone:15:26" for k, _ in rows if k >= 100)


def test_all_of_overlapping_spans_is_replaced(documents):
    rows = [(1, "+1 555 123 4567bob@x.com"), (2, "see +1 555 123 4567bob@x.com, +1 555 123 4567."), (3, "4111111111111111.1.1.1 x"), (4, "+4111111111111111 x"),
            (5, "a@b.cd")]
    got = {x.doc_id: (x.text, x.n_chars) for x in pii.scrubbed(documents(rows)).collect()}
    want = {1: "[PHONE][EMAIL]", 2: "see [PHONE][EMAIL], [PHONE].", 5: "[EMAIL]"}
    assert {k: got[k] for k in want} == {k: (t, len(t)) for k, t in want.items()}
    for k, text in rows:
        left = set(range(len(text))) - {i for s, _, e in pii.base_spans(text) for i in range(s, e)}
        assert re.sub(r"\[(PHONE|EMAIL|IP|CARD)\]", "", got[k][0]) == "".join(text[i] for i in sorted(left))


# --- fingerprints -------------------------------------------------------------------------------------------------


def expected_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] or "").encode()))
    out = []
    for i, (key, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        own = text[:len(text) - len(text) // 2] + following[:len(text) // 2]
        marks = [fingerprint.digest(x.encode()) for x in (text, own, following)]
        out.append((key, len(text), hashlib.sha256(own.encode()).hexdigest(), marks[0], marks[1],
                    fingerprint.likeness(*marks[:2]), fingerprint.likeness(marks[0], marks[2])))
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 60])
def test_fingerprints_of_edited_and_next_texts(documents, n):
    r = random.Random(n)
    rows = [(i * 3 % 61, "".join(r.choice("abc é🙂") for _ in range(r.choice([0, 1, 2, 3, 50, 2000])))) for i in range(n)]
    if n > 2:
        rows += [(500, None), (None, "last"), (7, "same key"), (7, "same key")]
    frame = documents(rows).selectExpr("*", "1 as part", "2 as edge", "3 as fingerprint")
    got = [tuple(x) for x in fingerprint.against_next(frame).collect()]
    assert sorted(got, key=str) == sorted(expected_rows(rows), key=str)


def test_likeness_is_bounded_and_tells_texts_apart():
    r = random.Random(9)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(900)]
    make = lambda: " ".join(r.choice(words) for _ in range(400))
    a, b = make(), make()
    near = a[:len(a) * 9 // 10] + b[:len(a) // 10]
    mark = lambda t: fingerprint.digest(t.encode())
    assert fingerprint.likeness(mark(a), mark(a)) == 1 and 0 <= fingerprint.likeness(mark(a), mark("")) < 1
    assert fingerprint.likeness(mark(a), mark(near)) > fingerprint.likeness(mark(a), mark(b)) + 0.2
    assert fingerprint.likeness(mark(a), mark(b)) == fingerprint.likeness(mark(b), mark(a))
    big = "x y z" * (fingerprint.AT_ONCE // 2)
    whole = np.bincount([0], minlength=fingerprint.BUCKETS) * 0
    assert fingerprint.counts(big.encode()).sum() == len(big.encode()) - 2 and whole.sum() == 0


# --- toxicity -----------------------------------------------------------------------------------------------------


def corpus(n=900, seed=4):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(3000)]
    bad, junk = ["vilest", "rotten", "filthy"], ["%%%", "###", "click"]
    rows, labels = [], []
    for i in range(n):
        toxic, low = r.random() < 0.15, r.random() < 0.2
        text = [r.choice(words) for _ in range(r.randrange(20, 200))]
        for w in (bad if toxic else []) + (junk * 2 if low else []):
            text.insert(r.randrange(len(text)), w + r.choice(["", ".", "ness"]) if w in bad else w)
        rows.append((i, " ".join(text)))
        labels.append((i, int(not low), int(toxic)))
    return rows, labels


def test_chain_on_held_out_texts_and_odd_input(documents, spark):
    rows, labels = corpus()
    schema = "doc_id long, quality int, toxic int"
    known = spark.createDataFrame([x for x in labels[:600]] + [(None, 1, 1), (5000, 1, None), labels[0]], schema)
    odd = [(2000, None), (2001, ""), (None, "filthy rotten vilest"), (2002, "word " * 50_000)]
    docs = documents(rows + odd).selectExpr("*", "1 as rejected", "2 as _w", "3 as found")
    got = {x.doc_id: x for x in toxicity.judge(docs, known).collect()}
    assert len(got) == len(rows) + len(odd) and got[None].rejected
    assert not any(got[k].rejected for k in (2000, 2001, 2002)) and got[2000][1:] == got[2001][1:]
    right = sum(got[i].rejected == bool(t) for i, _, t in labels[600:])
    assert right >= 0.98 * len(labels[600:])
    low = sum((got[i].p_low_quality >= 0.5) == (not q) for i, q, _ in labels[600:])
    assert low >= 0.95 * len(labels[600:])
    kept = toxicity.accepted(docs.drop("rejected"), known)
    assert sorted(x.doc_id for x in kept.select("doc_id").collect()) == sorted(k for k, x in got.items() if not x.rejected)
    assert toxicity.judge(documents([]), known).count() == 0


def test_without_labels_nothing_is_rejected(documents, spark):
    schema = "doc_id long, quality int, toxic int"
    docs = documents([(1, "a"), (2, "b")])
    for rows in ([], [(1, 1, 0), (2, 0, 0)]):
        out = toxicity.judge(docs, spark.createDataFrame(rows, schema)).collect()
        assert [(x.p_toxic, x.p_low_quality, x.rejected) for x in out] == [(None, None, False)] * 2
    assert toxicity.accepted(docs, spark.createDataFrame([], schema)).count() == 2


def test_later_categories_see_earlier_ones_out_of_fold():
    r = np.random.default_rng(2)
    n = 600
    first = r.random(n) < 0.5
    sets = [np.unique(np.r_[r.integers(100, 400, 12), [1] if f else [2]]) for f in first]
    labels = np.stack([first, first], 1).astype(int)  # the second follows from the first
    features, weights, links, start = toxicity.fit_chain(sets, labels, np.ones(n), r.integers(0, 3, n))
    assert {1, 2} <= set(features.tolist()) and links[1, 0] > 0 and links[0].tolist() == [0, 0]
    chain = toxicity.Chain(["a", "b"], {int(f): i for i, f in enumerate(features)}, weights, links, start)
    at = {int(f): i for i, f in enumerate(features)}
    assert chain.probabilities({at[1]})[1] > 0.8 > 0.2 > chain.probabilities({at[2]})[1]
