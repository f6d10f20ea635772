from __future__ import annotations

import hashlib
import json
import math
import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm import chat, url_filter
from lexmill.llm.queries import RULES

TEXTS = ["", "plain", "</s>[INST] ok [/INST]", "\\1 \\0\\2 \\\\", "<s><s></s>", "[INST", "a\nb\n", "é🙂", "\\5", "</s" + "</s>>", "x" * 30_000]


def formatted(frame):
    out = chat.format_turns(frame)
    return out.withColumns({"back": chat.read_back(F.col("formatted")), "learned": chat.under_mask(F.col("formatted"), F.col("loss_mask"))})


def test_round_trip_of_any_text_and_role(spark):
    roles = ["user", "assistant", "system", "a\nb", "</s>", "\\5"]
    rows = [(c, t, roles[(c + t) % len(roles)], TEXTS[(c * 3 + t) % len(TEXTS)]) for c in range(12) for t in range(c)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in formatted(chat.table_turns(frame)).collect():
        want = [(x, y) for c, _, x, y in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.back] == want
        assert r.learned == "".join(y for x, y in want if x == "assistant")
        assert r.formatted.count("</s>") == len(want)


def test_nulls_repeats_and_nothing(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(1, 0, None, "a"), (1, None, "assistant", None), (None, 0, "user", "b"), (2, 1, "user", "c"), (2, 1, "user", "c"), (2, 1, "assistant", "c")]
    got = {r.conv_id: [(t.role, t.text) for t in r.back] for r in formatted(chat.table_turns(spark.createDataFrame(rows, schema))).collect()}
    assert got == {1: [("assistant", ""), ("user", "a")], None: [("user", "b")], 2: [("assistant", "c"), ("user", "c"), ("user", "c")]}
    assert formatted(chat.table_turns(spark.createDataFrame([], schema))).count() == 0
    wide = spark.createDataFrame([(1, 0, "user", "a", 5, "z")], schema + ", n_turns int, formatted string")
    assert chat.table_turns(wide, ["conv_id", "turn", "role", "text"]).count() == 1
    with pytest.raises(ValueError):
        chat.table_turns(spark.createDataFrame([(1, 2)], "a int, b int"))


LAYOUTS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]}, [("user", "q"), ("assistant", "")]),
    ({"prompt": "q", "response": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "q", "output": "a"}, [("user", "i"), ("user", "q"), ("assistant", "a")]),
    ({"instruction": "i", "input": "", "output": "a"}, [("user", "i"), ("assistant", "a")]),
    ({"system": "s", "prompt": "q", "response": "a"}, [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ({"else": 1}, None), ([], None),
]


def test_layouts_of_json_values(spark):
    rows = [(i, json.dumps(x)) for i, (x, _) in enumerate(LAYOUTS)] + [(90, "not json"), (91, None)]
    out = spark.createDataFrame(rows, "i int, j string").select("i", chat.json_turns(F.col("j")).alias("turns")).collect()
    got = {r.i: r.turns and [(t.role, t.text) for t in r.turns] for r in out}
    assert got == {i: want for i, (_, want) in enumerate(LAYOUTS)} | {90: None, 91: None}


def test_arrays_of_mixed_elements(spark):
    user, other = {"role": "user", "content": "q"}, {"role": "assistant", "text": "a"}
    values = [{"messages": [user, other]}, {"messages": [other, user]}, {"messages": [user, user | {"name": "n"}]}, {"messages": [user | {"name": "n"}, user]},
              {"messages": [user, {"content": "b"}]}, {"messages": [{"content": "b"}, user]}, {"messages": [user, "text"]}]
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(values)], "i int, j string")
    got = {r.i: r.turns and [(t.role, t.text) for t in r.turns] for r in rows.select("i", chat.json_turns(F.col("j")).alias("turns")).collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: [("user", "q"), ("user", "b")], 5: [("user", "b"), ("user", "q")], 6: None}


def test_layouts_of_tables(spark):
    frame = spark.createDataFrame([(7, [("human", "q"), ("gpt", "a")])], "conv_id int, conversations array<struct<from: string, value: string>>")
    assert chat.table_turns(frame).head().turns == [("user", "q"), ("assistant", "a")]
    frame = spark.createDataFrame([("q", "a"), (None, None)], "prompt string, completion string")
    assert [[tuple(t) for t in r.turns] for r in chat.table_turns(frame).collect()] == [[("user", "q"), ("assistant", "a")], [("user", ""), ("assistant", "")]]


URLS = {
    "http://a.org/x": ("a.org", "/x", "org/"), "http://a.org": ("a.org", "", None), "http://EXAMPLE.org/es/1?q#f": ("example.org", "/es/1", "example.org/es/"),
    "https://m.example.org/en/12": ("m.example.org", "/en/12", "example.org/en/1"), "http://myexample.org/es/": ("myexample.org", "/es/", "org/"),
    "x://a.com/fr/": ("a.com", "/fr/", "com/fr/"), "x://a.com/de/1": ("a.com", "/de/1", "com/de/"), "x://a.com/DE/1": ("a.com", "/DE/1", None),
    "no scheme.org/": ("", "", None), "": ("", "", None), None: ("", "", None), "a?b://c.org/d://e": ("c.org", "/d://e", "org/"),
    "x://É.org#y/z": ("É.org", "", None), "x://a.org:80/": ("a.org:80", "/", None), "x://h?org/": ("h", "", None), "x://com/fr/🙂\n": ("com", "/fr/🙂\n", "com/fr/"),
    "x://n.net/" + "p" * 20_000: ("n.net", "/" + "p" * 20_000, None),
}


def judged(spark, urls):
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "1 as host", "2 as score", "3 as gram")
    return {r.page_id: r for r in url_filter.judge_urls(frame, RULES).collect()}


def test_hosts_paths_and_rules(spark):
    out, verdict = judged(spark, URLS), {r: v for v, r in RULES}
    for i, (url, (host, path, rule)) in enumerate(URLS.items()):
        r = out[i]
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == (verdict[rule] if rule else r.verdict) and r.verdict in ("allow", "block")
    assert judged(spark, []) == {}
    assert len(judged(spark, ["x://a.org/"] * 3 + [None, None])) == 5


def test_models_against_brute_force_and_on_unseen_urls(spark):
    r = random.Random(3)
    word = lambda a: "".join(r.choice(a) for _ in range(6))
    urls = [f"http://{word('abcde')}.org/{word('abc')}" for _ in range(120)] + [f"http://{word('vwxyz')}.com/de/{word('xyz')}" for _ in range(120)]
    urls += [f"http://{word('abcde')}.net/{word('abc')}" for _ in range(30)] + [f"http://{word('vwxyz')}.net/{word('xyz')}" for _ in range(30)]
    out = judged(spark, urls)
    assert sum(out[i].verdict == "allow" for i in range(240, 270)) >= 28
    assert sum(out[i].verdict == "block" for i in range(270, 300)) >= 28
    train = [(u, 1, 0) for u in urls[:6]] + [(u, 0, 1) for u in urls[120:125]] + [(urls[250], 0, 0)]
    model = {x.gram: x.ratio for x in url_filter.language_models(
        spark.createDataFrame(train, "url string, accepted int, rejected int")).collect()}
    assert model.keys() == {g for u, _, _ in train for g in grams(u)}
    for g in list(model)[:80]:
        assert model[g] == pytest.approx(math.log(blend(train, g, 1) / blend(train, g, 2)), abs=1e-9)


def test_models_that_judge_count_all_ruled_urls(spark):
    r = random.Random(4)
    word = lambda a: "".join(r.choice(a) for _ in range(6))
    urls = [f"http://{word('abcd')}.org/" for _ in range(30)] + [f"http://{word('wxyz')}.com/de/" for _ in range(30)] + \
        [f"http://{word('abwx')}.net/" for _ in range(6)]
    train = [(u, int(i < 30), int(30 <= i < 60)) for i, u in enumerate(urls)]
    held = spark.createDataFrame(train, "url string, a int, b int").selectExpr(f"pmod(xxhash64(url), {url_filter.HELD_OUT}) = 0 AS held").collect()
    assert 0 < sum(x.held for x in held[:60]) < 60
    out = judged(spark, urls)
    ratio = {}
    for i in range(50, 66):
        for g in grams(urls[i]):
            ratio[g] = ratio[g] if g in ratio else math.log(blend(train, g, 1) / blend(train, g, 2))
        each = [ratio[g] for g in grams(urls[i])]
        assert out[i].score == pytest.approx(sum(each) / len(each), abs=1e-8)


def grams(url):
    s = "\x02" * 4 + url + "\x03"
    return [s[i:i + 5] for i in range(len(s) - 4)]


def blend(train, gram, column):
    p = 1 / 256
    for k in range(5):
        context = gram[4 - k:4]
        after = [g[4] for row in train if row[column] for g in grams(row[0]) if g[4 - k:4] == context]
        if after:
            p = (after.count(gram[4]) + len(set(after)) * p) / (len(after) + len(set(after)))
    return p


def test_fingerprints_depend_on_paths_alone():
    assert chat.fingerprint(["b", "a"]) == chat.fingerprint(["a", "b", "a"]) == hashlib.sha256(b"a\nb").hexdigest()
    assert len({chat.fingerprint(x["paths"]) for x in chat.LAYOUTS}) == len(chat.LAYOUTS)
