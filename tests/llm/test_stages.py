"""Stages of the pipeline on tables whose other columns have the operators' own names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import common, mixing, near_text, pii, toxicity

OWN = ["uid", "_uid", "_spans", "spans", "base", "found", "new", "learnt", "instance", "kind", "rejected", "p_toxic", "p_low_quality", "_h", "_w", "_y0",
       "epochs", "first", "length", "second", "mdoc_id", "msource", "m_size", "m_hash", "m_copy", "_size", "_hash", "_copy", "_text", "taken", "size",
       "target", "source_size", "shard", "seats", "chunk", "digest", "kept", "head", "key", "n_links", "component_id", "_c0", "_c1", "rank", "_at"]


@pytest.fixture(scope="module")
def crowded(spark):
    r = random.Random(3)
    text = lambda i: " ".join(f"w{r.randrange(900)}" for _ in range(40)) + (" vilest rotten" if i % 6 == 0 else f" mail a{i}@mail.example.org")
    rows = [(i, text(i), f"s{i % 3}", 1) for i in range(240)] + [(300, None, None, None), (301, "", "s1", 0), (None, "some words here", "s1", 3)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, int(i % 6 == 0)) for i in range(240)], "doc_id long, quality int, toxic int")
    full = docs.select(*[F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in OWN[:20]], *docs.columns,
                       *[F.concat(F.lit(f"{c}:"), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in OWN[20:]])
    return common.scratch(docs, "docs"), common.scratch(full, "full"), labels


STAGES = {
    "accepted": lambda docs, labels: toxicity.accepted(docs, labels),
    "without_near_duplicates": lambda docs, labels: near_text.without_near_duplicates(docs),
    "scrubbed": lambda docs, labels: pii.scrubbed(docs),
    "mixed_documents": lambda docs, labels: mixing.mixed_documents(docs),
}


@pytest.mark.parametrize("name", STAGES)
def test_a_stage_reads_its_columns_and_keeps_the_others(crowded, name):
    docs, full, labels = crowded
    got, plain = STAGES[name](full, labels), STAGES[name](docs, labels)
    assert got.columns == full.columns
    rows = got.collect()
    assert rows and all(r[c] == f"{c}:{-1 if r.doc_id is None else r.doc_id}" for r in rows for c in OWN)
    assert sorted((tuple(r[c] for c in docs.columns) for r in rows), key=repr) == sorted((tuple(r) for r in plain.collect()), key=repr)
    assert STAGES[name](full.limit(0), labels).collect() == []


def test_contexts_hold_whole_words_however_long():
    long = "x" * 500
    one, other = f"a {long} 12345 {long}y b", f"a z{long} 12345 {long} b"
    at = one.index("12345")
    marks = pii.contexts(one, at, at + 5)
    assert marks == [pii._mark("two", "a", long), pii._mark("one", long, long + "y")]
    at = other.index("12345")
    assert not set(marks) & set(pii.contexts(other, at, at + 5))
    spaced = "a b" + " " * 700 + "12345"
    assert pii.contexts(spaced, 703, 708) == [pii._mark("two", "a", "b")]
    assert pii.contexts("12345 c", 0, 5) == []
