"""Manifest, divergence of sources and license scans against plain Python, on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest

from lexmill.llm import divergence, licenses, manifest

CLASHES = ("key string, grp long, leaf string, index string, steps string, root string, block string, uid string, pos string, n_words long, p long, "
           "q long, term string, v long, zero long, salt int, doc_id long, source string, lang string, n_chars long, text string")
LOWER = str.maketrans(manifest.UPPER, manifest.LOWER)


def frame(spark, rows):
    """Rows (doc_id, source, lang, n_chars, text) in a table that has the operators' own names as columns too."""
    names = [c.split()[0] for c in CLASHES.split(", ")]
    kinds = [c.split()[1] for c in CLASHES.split(", ")]
    extra = [None if k != "string" else "x" for k in kinds[:-5]]
    return spark.createDataFrame([(*extra, *r) for r in rows], CLASHES), names


ROWS = [(i, f"s{i % 3}", ["en", "de", None, ""][(i * 7) % 4] if i % 5 else "en", 5, f"Aa{i} Bb") for i in range(1500)]
ODD = [(None, None, None, None, None), (None, None, None, None, None), (7, "s", "en", 1, ""), (7, "s", "en", 1, ""), (7, "s", "en", 2, "Z"),
       (-3, "", "", 0, "É Ab" * 50_000), (9, "s", "lone", None, "only one")]


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_manifest(rows):
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(said, (r[0], r[1], r[2], r[3], text))))
    groups = defaultdict(list)
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        groups[r[2]].append((r[0], leaf(r, r[4]), leaf(r, r[4].translate(LOWER)) if hit and r[4] is not None else leaf(r, r[4])))

    def tree(nodes):
        """Root and, per node, its list of (left, right)."""
        paths, owner, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
        while len(level) > 1:
            runs = [range(a, min(a + 8, len(level))) for a in range(0, len(level), 8)]
            for run in runs:
                for i in run:
                    for o in owner[i]:
                        paths[o].append(("".join(level[j] for j in run if j < i), "".join(level[j] for j in run if j > i)))
            owner = [[o for i in run for o in owner[i]] for run in runs]
            level = [sha("".join(level[i] for i in run)) for run in runs]
        return level[0], paths

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subs = {g: tree([x[1] for x in groups[g]]) for g in order}
    root, tops = tree([subs[g][0] for g in order])
    out = []
    for g, above in zip(order, tops):
        for (doc, own, changed), below in zip(groups[g], subs[g][1]):
            got = changed
            for left, right in [*below, *above]:
                got = sha(left + got + right)
            out.append((doc, own, subs[g][0], root, sha("".join(a + b for a, b in [*below, *above])), got, got == root))
    return out


def same(got, want):
    assert Counter(map(repr, map(tuple, got))) == Counter(map(repr, want))


def test_manifest_equals_a_plain_tree(spark):
    docs, _ = frame(spark, ROWS + ODD)
    same(manifest.audit(docs).collect(), plain_manifest(ROWS + ODD))


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 512, 513])
def test_manifest_of_one_group_at_edges_of_blocks(spark, n):
    rows = [(i, "s", "en", 1, "Text") for i in range(n)]
    same(manifest.audit(frame(spark, rows)[0]).collect(), plain_manifest(rows))


def test_empty_manifest(spark):
    assert manifest.audit(frame(spark, [])[0]).collect() == []


def test_appended_batches_give_the_manifest_of_the_whole(spark):
    first, second = ROWS[:900], [(i, "s", ["en", "new"][i % 2], 1, f"T{i}") for i in range(2000, 2700)]
    stored = manifest.append(manifest.manifest(frame(spark, first)[0]), frame(spark, second)[0])
    stored = manifest.append(stored, frame(spark, [(5000, "s", "en", 1, "last")])[0])
    found = manifest.witnesses(stored).select("key", "digest", "subroot", "root", manifest.proof_digest(manifest.F.col("steps")))
    same(found.collect(), [x[:5] for x in plain_manifest([*first, *second, (5000, "s", "en", 1, "last")])])
    with pytest.raises(ValueError):
        manifest.append(stored, frame(spark, [(4999, "s", "en", 1, "late")])[0])


def test_full_blocks_are_taken_over(spark):
    stored = manifest.manifest(frame(spark, [(i, "s", "en", 1, "t") for i in range(1100)])[0])
    marked = stored.withColumn("root", manifest.F.lit("kept"))
    grown = manifest.append(marked, frame(spark, [(2000, "s", "en", 1, "t")])[0])
    assert grown.where("root = 'kept'").count() == 1024 and grown.count() == 1101


def plain_divergences(rows, least, top=50):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))) for _, source, lang, _, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for _, _, w in own for t in set(w))
        kept = [t for t, n in seen.items() if n >= least]
        count = {s: Counter() for s in {d[1] for d in own}}
        for _, s, w in own:
            count[s].update(w)
        everything = sum(count.values(), Counter())

        def p(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 1000000000 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q, ps = p(everything), {s: p(c) for s, c in count.items()}
        for s in ps:
            pairs = [(sum(abs(ps[s][t] - ps[o][t]) for t in kept), o) for o in ps if o != s]
            terms = [(ps[s][t] - q[t], t) for t in kept if count[s][t] and ps[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                for i, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]):
                    out.append((lang, s, part, item, value, i + 1))
    return out


WORDS = ["Foo", "bar", "Straße", "x1y", "ÉTÉ", "été", "日本", "the-end", "don't", "", "  "]


def test_divergences_equal_plain_counting(spark, monkeypatch):
    rows = [(i, ["a", "b", "c", None, "\U0001f600", "￿"][i % 6], ["en", None, "fr"][i % 3 if i % 7 else 0], 0,
             " ".join(WORDS[(i * k + k * k) % len(WORDS)] for k in range(i % 9))) for i in range(400)]
    rows += [(None, "only", "none", None, None), (1, "x", "none", None, "12 34"), (1, "x", "none", None, "12 34"), (2, "a", "en", 1, "foo " * 300_000)]
    got = divergence.weighed(divergence.term_counts(frame(spark, rows)[0]), least=10)
    got = divergence.pair_differences(*got).unionByName(divergence.top_terms(got[0])).collect()
    same(got, plain_divergences(rows, 10))


def test_divergences_of_many_sources_cross_blocks(spark):
    rows = [(i, f"s{i % 150:03}", "en", 0, " ".join(f"w{chr(97 + (i * k) % 26)}" for k in range(1, 6))) for i in range(900)]
    entries, groups = divergence.weighed(divergence.term_counts(frame(spark, rows)[0]), least=5)
    got = divergence.pair_differences(entries, groups).collect()
    same(got, [r for r in plain_divergences(rows, 5) if r[2] == "pair"])


def test_partial_counts_are_given_on_when_many(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(divergence, "HELD", 50)
    monkeypatch.setattr(divergence, "PIECE", 64)
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 200, "source": ["s"] * 200, "text": [f"w{'abcdefghij'[i % 10]}{'xyz'[i % 3]} same" for i in range(200)]})
    total = Counter()
    for b in divergence._counts(iter([batch, batch])):
        for r in b.to_pylist():
            total[r["term"]] += r["n"]
    assert total["same"] == 400 and sum(n for t, n in total.items() if t and t.startswith("w")) == 400


def test_no_divergences_of_no_rows(spark):
    assert divergence.divergences(frame(spark, [])[0]).collect() == []


def test_licenses_on_odd_texts(spark):
    mit = licenses.NOTICES[0].text
    torn = mit.replace("free of charge, ", "").replace("sublicense, and/or sell", "sell")
    texts = [None, "", "mit", "MIT License", "the MIT-license. MIT/License mit license", "GNU General Public License v3", "public license general public",
             mit.upper(), f"x {torn} y", "Licensed under CC BY-NC 4.0", "licensed under the sun", "w " * 300_000 + "apache license",
             "mit license " * 5000, " ".join(mit.split()[:20])]
    docs, _ = frame(spark, [(i, "s", "en", 0, t) for i, t in enumerate(texts)] + [(3, "s", "en", 0, "MIT License")] * 2 + [(None, None, None, None, "GPL")])
    rows = licenses.scan(docs).collect()
    assert len(rows) == len(texts) + 3 and sum(r.doc_id == 3 for r in rows) == 3
    got = {r.doc_id: r for r in rows}
    assert [got[i].n_words for i in (0, 1, 2)] == [0, 0, 1] and got[0].first_word is None and got[0].score == 0
    assert (got[3].n_base, got[3].base_labels, got[3].score) == (1, "mit", 1.0)
    assert (got[4].n_base, got[4].first_word, got[4].last_word) == (3, 1, 5)
    assert (got[5].base_labels, got[5].first_word) == ("gpl", 1)
    assert got[6].n_base == 0 and got[6].labels == "" and got[6].score == pytest.approx(2 / 3)
    assert got[7].labels == "mit" and got[7].base_labels == "" and got[7].score == 1.0
    assert got[8].labels == "mit" and licenses.SHARE < got[8].score < 1
    assert got[9].labels == "cc-by-nc" and got[10].labels == ""
    assert (got[11].n_words, got[11].first_word) == (300_002, 300_000)
    assert (got[12].n_base, got[12].last_word) == (5000, 9998)
    assert got[13].labels == "" and 0 < got[13].score < licenses.SHARE
    assert licenses.scan(frame(spark, [])[0]).collect() == []


def test_templates_are_bounded():
    with pytest.raises(ValueError):
        licenses.template_rows([licenses.Template("long", "word " * (licenses.MOST_WORDS + 1))])
    with pytest.raises(ValueError):
        licenses.template_rows([licenses.Template("short", "one", True)])
