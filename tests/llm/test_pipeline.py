from __future__ import annotations

import os
import random

import corpus_pipeline
from lexmill.llm import mixing
from lexmill.session import new_path


def test_stages_take_effect_and_keep_columns(spark, documents):
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    text = lambda n, *more: " ".join([word() for _ in range(n)] + list(more))
    rows = [(i, text(60, "vilest", "rotten") if i % 8 == 0 else text(60), f"s{i % 4}") for i in range(400)]
    copies = [(1000 + i, rows[i][1] + (" x" if i % 2 else ""), "s1") for i in range(1, 40) if i % 8]
    private = [(2000, text(30, "mail me at jo.do@mail.example.org today"), "s2"), (2001, None, None), (2002, "", "s3")]
    folder = new_path(spark, "corpus")
    docs = documents(rows + copies + private)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 1 if k % 5 else 0, int(k % 8 == 0)) for k, _, _ in rows[:300]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    seen, step = {}, spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        step = stage(spark, step, folder)
        path = new_path(spark, name)
        step.write.parquet(path)
        step = spark.read.parquet(path)
        seen[name] = step
        assert step.columns == docs.columns or name == "pack_sequences"
    ids = lambda name: sorted(x.doc_id for x in seen[name].select("doc_id").distinct().collect())
    clean = sorted(k for k, *_ in rows if k % 8) + sorted(k for k, *_ in copies + private)
    assert ids("drop_toxic") == sorted(clean)
    assert ids("drop_near_duplicates") == sorted(set(clean) - {k for k, *_ in copies}) == ids("scrub_personal_data")
    mail = seen["scrub_personal_data"].where("doc_id = 2000").head()
    assert "mail me at [EMAIL] today" in mail.text and mail.n_chars == len(mail.text)
    before = {x.doc_id: x.text for x in seen["scrub_personal_data"].collect()}
    taken = {x.doc_id: x.taken for x in mixing.mix(seen["scrub_personal_data"]).collect()}
    mixed = {}
    for x in seen["mix_sources"].collect():
        mixed[x.doc_id] = mixed.get(x.doc_id, 0) + len(x.text.split())
        assert x.text.strip() in before[x.doc_id]
    assert mixed == {k: n for k, n in taken.items() if n}
    packed = seen["pack_sequences"].collect()
    assert {x.doc_id for x in packed} == set(mixed) and all(x.offset + x.length <= 1024 for x in packed)
    assert corpus_pipeline.run(spark, folder).count() == len(packed)


def test_an_empty_corpus(spark, documents):
    folder = new_path(spark, "empty")
    documents([]).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_entry_registers_each_operator_once():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py" and 4 <= len(corpus_pipeline.STAGES) <= 5
