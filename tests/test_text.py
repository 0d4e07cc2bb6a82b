import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import text as T


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first()["x"]


ALPHABET = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2003\u2028\u202f\u205f\u3000ab'’“\u200béZ9_-"


def test_norm_is_split_and_join(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(0, 30))) for _ in range(500)] + [""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.norm(F.col("t")).alias("n")).collect()
    assert all(r["n"] == " ".join(r["t"].split()) for r in got)
    assert one(spark, T.norm(F.lit(None).cast("string")), t="x") == ""


def test_plain_punctuation(spark):
    got = one(spark, T.norm_ascii(F.col("t")), t="Wi‑Fi y’u Rwanda… “ni byiza”\u200b")
    assert got == "Wi-Fi y'u Rwanda... \"ni byiza\""


def run_of(words):
    best = cur = 0
    for i, w in enumerate(words):
        cur = cur + 1 if i and words[i - 1] == w else 1
        best = max(best, cur)
    return best


def test_longest_run(spark):
    rng = random.Random(1)
    lists = [[rng.choice("ab") for _ in range(rng.randrange(0, 12))] for _ in range(200)]
    got = spark.createDataFrame([(x,) for x in lists], "w array<string>").select("w", T.longest_run(F.col("w")).alias("n")).collect()
    assert all(r["n"] == run_of(r["w"]) for r in got)


def test_ratios_of_nothing(spark):
    none = F.array().cast("array<string>")
    assert one(spark, T.unique_ratio(none), t="x") == 0.0
    assert one(spark, T.english_share(T.words(F.col("t"))), t="the cat and is") == 0.75
    assert one(spark, T.jaccard(none, none), t="x") == 1.0
    assert one(spark, T.jaccard(none, F.array(F.lit("a"))), t="x") == 0.0


@settings(max_examples=30, deadline=None)
@given(st.text(max_size=20))
def test_unit_hash_range(key):
    import hashlib

    x = int(hashlib.sha1(key.encode("utf-8", "replace")).hexdigest()[:8], 16) / 0xFFFFFFFF
    assert 0 <= x <= 1


def test_split_boundaries(spark):
    with pytest.raises(ValueError):
        T.split_of(F.lit("x"), 0.9, 0.1)
    import hashlib

    keys = [f"k{i}" for i in range(300)]
    got = spark.createDataFrame([(k,) for k in keys], "k string").select("k", T.split_of(F.col("k")).alias("s")).collect()
    for r in got:
        x = int(hashlib.sha1(r["k"].encode()).hexdigest()[:8], 16) / 0xFFFFFFFF
        assert r["s"] == ("train" if x < 0.9 else "val" if x < 0.9 + 0.05 else "test")
