"""Law ids that a French text modifies."""

import re

from pyspark.sql import functions as F

from lexmill.functions.labels import FR_MODIFICATION_VERBS, FR_MODIFIED_LAWS, modified_laws

ANY = [rf"loi n° (\d+-\d+) [\s\S]{{0,200}} {v}" for v in FR_MODIFICATION_VERBS]


def test_french_laws(spark):
    texts = ["", "loi n° 1-2 x modifié", "loi n° 1-2 abrogé", "loi n° 1-2  abrogé", "loi n° 1-2 x\ny abrogé, loi n° 3-4 z abrogé loi n° 5-6 est modifié",
             "loi n° 1-2 " + "a" * 200 + " remplacé", "loi n° 1-2 " + "a" * 201 + " remplacé loi n° 7-8 b\r\n \x85 insérés", "abrogé",
             "loi n° 1-2 " + "\U0001f600" * 200 + " modifié", None]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    got = {r["k"]: r["laws"] for r in df.select("k", modified_laws("t", FR_MODIFIED_LAWS).alias("laws")).collect()}
    for k, t in enumerate(texts):
        assert got[k] == (None if t is None else sorted({x for p in ANY for x in re.findall(p, t)}))


def test_the_text_is_evaluated_once(spark):
    text = F.concat(F.lit("loi n° 1-2 "), F.col("id").cast("string"), F.lit(" est modifié"))
    plan = spark.range(1).select(modified_laws(text, FR_MODIFIED_LAWS).alias("x"))._jdf.queryExecution().analyzed().toString().lower()
    assert plan.count("concat(") == 1


def test_no_pattern_tries_a_class_of_all_characters():
    assert not any(r"[\s\S]" in p for p in FR_MODIFIED_LAWS)
