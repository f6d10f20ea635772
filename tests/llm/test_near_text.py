from __future__ import annotations

import random
from collections import defaultdict

import pytest

from lexmill.llm import near_text


def brute(rows):
    """(links, component) per doc_id, for rows with distinct ids."""
    sets = {}
    for k, t in rows:
        w = (t or "").encode().split()
        sets[k] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    links = defaultdict(set)
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both, any_ = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if any_ and both / any_ >= 0.8:
                links[a].add(b), links[b].add(a)
    root = {}
    for k in ids:
        todo = [k]
        while todo:
            x = todo.pop()
            if x not in root:
                root[x] = k
                todo += links[x]
    return {k: (len(links[k]), root[k]) for k in ids}


def found(documents, rows):
    out = near_text.near_duplicates(documents(rows)).collect()
    return {r.doc_id: (r.n_links, r.component_id) for r in out}


def text(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


def edited(r, base, share):
    words = base.split()
    for _ in range(max(1, int(len(words) * share))):
        words[r.randrange(len(words))] = f"x{r.randrange(5000)}"
    return " ".join(words)


def test_against_brute_force(documents):
    r = random.Random(1)
    rows, bases = [], [text(r, n) for n in (30, 60, 120, 400)]
    for base in bases:
        rows += [base] + [edited(r, base, r.choice([0.01, 0.02, 0.04, 0.06])) for _ in range(25)] + [base] * 3
    rows += [text(r, 40) for _ in range(30)]
    rows = list(enumerate(rows))
    r.shuffle(rows)
    assert found(documents, rows) == brute(rows)


def test_blocks_give_the_same(documents, monkeypatch):
    monkeypatch.setattr(near_text, "BLOCK", 8)
    monkeypatch.setattr(near_text, "VERIFY_BLOCK", 4)
    r = random.Random(2)
    base = text(r, 200)
    rows = list(enumerate([edited(r, base, 0.01) for _ in range(60)]))
    assert found(documents, rows) == brute(rows)


def test_short_empty_null_and_white_space(documents):
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, " one "), (5, "one two"), (6, "one\ttwo"), (7, "two one"),
            (8, "a b c d e"), (9, "a  b c d\ne"), (10, "é b c d e"), (11, "x " * 50_000)]
    assert found(documents, rows) == brute(rows)


def test_ties_null_keys_and_repeated_rows(documents):
    t = "the same words in this text here"
    out = near_text.near_duplicates(documents([(5, t), (5, t), (None, t), (3, t), (None, "other words alone in a text")])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_links, r.component_id, r.kept) for r in out) == [
        (False, 3, 3, 3, True), (False, 5, 3, 3, False), (False, 5, 3, 3, False), (True, 0, 0, None, True), (True, 0, 3, 3, False)]


def test_filter_keeps_columns_and_one_of_each_group(documents, spark):
    r = random.Random(4)
    t = text(r, 50)
    docs = documents([(4, t), (2, t), (9, text(r, 50)), (7, None)]).selectExpr("*", "1 as uid", "2 as n", "3 as digest", "4 as cluster")
    out = near_text.without_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(x.doc_id for x in out.collect()) == [2, 7, 9]
    assert near_text.near_duplicates(docs.limit(0)).count() == 0


def test_pruning_bound():
    assert near_text.least_matches(25) < 20
    for n in range(25, 126, 25):
        tail = near_text.least_matches(n)
        assert 0 < tail < 0.8 * n  # a pair at the threshold with its expected matches stays


@pytest.mark.parametrize("n", [1, 4, 5, 6])
def test_shingles_of_short_texts(n):
    words = near_text._Hashes()
    assert len(near_text.shingles(" ".join("abcdef"[:n]), words)) == max(1, n - 4)
