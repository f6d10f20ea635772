from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lexmill.llm import mixing, packing, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "   a", "a   b", "a \n b", "\n\n a\t\tb ", "it's  we'll I'D", "x\u00a0y \u2003z", " <|endoftext|> b  <|endoftext|>",
       "\u0085a \u001c b", "日本語 テキスト", "🙂 🙂🙂 a🙂", "1 22 333  4444", "a" * 3000, " ".join("b" * 5000), "é\u0301 ñ", "\x00 a", "tab\t a", "end "]


def expected(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_ids_are_those_of_the_tokenizer():
    r = random.Random(0)
    made = ["".join(r.choice(["a", "B", " ", "  ", "\n", "é", "9", "'s", ".", "\t", "\u00a0", "日"]) for _ in range(r.randrange(60)))
            for _ in range(400)]
    got = tokens.Ids(PATH).batch(ODD + made)
    assert [x.tolist() + [2] for x in got] == [expected(t) for t in ODD + made]


def check_packing(rows, docs, size=1024):
    by_doc, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, text in docs:
        ids = np.array(expected(text), "<u4")
        parts = sorted(by_doc[key], key=lambda r: r.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.start for p in parts] == [sum(q.length for q in parts[:i]) for i in range(len(parts))]
        assert sum(p.length for p in parts) == len(ids) and all(p.length == size for p in parts[1:])
        assert [p.ids_crc32 for p in parts] == [zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for p in parts]
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_packing_of_odd_and_long_texts(documents):
    r = random.Random(1)
    docs = list(enumerate([*ODD, None, "word " * 4000, *[" ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(1, 700))) for _ in range(150)]]))
    out = packing.pack(documents(docs).selectExpr("*", "1 as rank", "2 as length", "3 as offset"), PATH, with_ids=True).collect()
    n = check_packing(out, docs)
    total = sum(len(expected(t)) for _, t in docs)
    assert n <= 1.05 * total / 1024 + 1
    texts = dict(docs)
    assert all(r.ids == expected(texts[r.doc_id])[r.start:r.start + r.length] for r in out)


def test_packing_of_repeated_rows_and_nothing(documents):
    out = packing.pack(documents([(1, "a b"), (1, "a b"), (None, "a b")]), PATH).collect()
    assert len(out) == 3 and len({r.sequence_id for r in out}) == 1 and sorted(r.offset for r in out) == [0, 3, 6]
    assert packing.pack(documents([]), PATH).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_places_everything_well(seed):
    r = random.Random(seed)
    size = r.choice([10, 100, 1024])
    counts = dict(Counter(min(size, int(r.expovariate(r.choice([2, 5, 20]) / size)) + 1) for _ in range(3000)))
    plan, room, ranks = packing.best_fit(counts, size), defaultdict(list), defaultdict(set)
    for length, rank, n, first, offset in plan:
        for i in range(n):
            room[first + i].append((offset, length))
            ranks[length].add(rank + i)
    assert {k: len(v) for k, v in ranks.items()} == counts and all(v == set(range(len(v))) for v in ranks.values())
    for parts in room.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(k * n for k, n in counts.items()) // size)
    assert len(room) <= 11 / 9 * least + 1


def goals(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by sharing out again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, goal, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            goal |= {s: weight[s] * level for s in free}
            break
        for s in full:
            goal[s] = most * sizes[s]
            left -= goal[s]
        free -= full
    return goal


def words(text):
    return len([w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")])


def mixed(documents, rows):
    return mixing.mix(documents(rows)).collect()


def test_mix_meets_targets_and_limits(documents):
    r = random.Random(5)
    rows = [(i, " ".join("w" * r.randrange(1, 4) for _ in range(r.randrange(0, 300))), f"s{r.choice([0] * 8 + list(range(12)))}") for i in range(600)]
    rows += [(600, None, "s1"), (601, "a\u00a0b \x0b c", "\U0001f600"), (602, " ".join("q" * 3000), None), (603, "", "\uffff"), (604, "x y", "empty?")]
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += words(t)
    goal, out, taken = goals(sizes), mixed(documents, rows), defaultdict(int)
    assert len(out) == len(rows)
    texts = {k: t for k, t, _ in rows}
    for x in out:
        assert x.size == words(texts[x.doc_id]) and x.source_size == sizes[x.source]
        assert x.target == pytest.approx(goal[x.source], rel=1e-9)
        assert 0 <= x.taken <= 2 * x.size
        taken[x.source] += x.taken
    for s in sizes:
        assert abs(taken[s] - goal[s]) <= 1.5 * mixing.BLOCK + 1
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, mixed(documents, rows[::-1])), key=str)


def test_shards_of_a_large_source(documents):
    rows = [(i, "w " * 40, "a" if i % 3 else "b") for i in range(900)]
    out = mixing.mix(documents(rows), shard_words=2000).collect()
    total = {s: sum(x.taken for x in out if x.source == s) for s in "ab"}
    goal = {x.source: x.target for x in out}
    assert all(abs(total[s] / goal[s] - 1) < 0.06 for s in "ab") and max(x.taken for x in out) <= 80


def test_apportionment_is_sainte_lague(spark):
    r = random.Random(6)
    rows = [(h, f"s{i}", float(r.choice([3, 40, 500, 9000]) * r.random()), 10_000) for h in range(12) for i in range(r.randrange(1, 9))]
    got = {(x.shard, x.source): x.seats for x in mixing.apportion(
        spark.createDataFrame(rows, "shard long, source string, votes double, most long"), 32).collect()}
    for h in range(12):
        votes = {s: v for k, s, v, _ in rows if k == h}
        seats = dict.fromkeys(votes, 0)
        for _ in range(int(sum(votes.values()) / 32 + 0.5)):
            best = min(votes, key=lambda s: (-votes[s] / (2 * seats[s] + 1), s))
            seats[best] += 1
        assert {s: got[h, s] for s in votes} == seats


def test_mixed_documents_hold_the_words_taken(documents):
    rows = [(i, " ".join(f"{i}-{j}" for j in range(5 + 13 * i % 90)) + "\n", "abc"[i % 3]) for i in range(60)] + [(70, None, "a"), (71, "", "b")]
    docs = documents(rows).selectExpr("*", "1 as size", "2 as taken", "3 as first")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r.doc_id] += words(r.text)
        assert r.n_chars == len(r.text) and words(r.text) > 0
        assert set(r.text.split()) <= set(rows[r.doc_id][1].split())
    assert {k: v for k, v in taken.items() if v} == dict(got)
    assert mixing.mixed_documents(documents([])).count() == 0
