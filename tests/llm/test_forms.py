import unicodedata

import pytest

from millrace.llm.forms import form, kind_of, lookalike_pairs, script_sets, with_forms

SAME = [
    ("Мuri Rwanda", "Muri Rwanda"), ("ｂｉｒｏ", "biro"), ("école", "école"), ("y’uko", "y'uko"), ("yʼuko", "y'uko"), ("a​b­c﻿", "abc"), ("a  　b\n\nc ", "a b c"),
    ("Wi‑Fi", "Wi-Fi"), ("ﬁn", "fin"), ("“x”", '"x"'), ("соре", "cope"), ("１２，", "12,"), ("a⁠b", "ab"), ("ό", "ó"), ("＂x＂", '"x"'),
    ("ᎪᏟᎬ", "ACE"), ("ꓡꓲꓢꓴ", "LISU"), ("ⲞⲢ", "OP"), ("𝐦𝐮𝐫𝐢 𝟏𝟐", "muri 12"), ("𝗠uri", "Muri"), ("𝚨", "A"),
]
DIFFERENT = [("A", "a"), ("e", "é"), ("0", "O"), ("1", "l"), ("x²", "x2"), ("①", "1"), ("ab", "a b"), ("«x»", '"x"'), ("😊", "👍"), ("Привет", "Privet"), ("½", "1/2"), ("ß", "ss")]


@pytest.mark.parametrize("a,b", SAME)
def test_same_looks(a, b):
    assert form(a) == form(b) == unicodedata.normalize("NFC", b)


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different_looks(a, b):
    assert form(a) != form(b)


def test_scripts_of_tokens():
    assert kind_of("Мuri") == "mixed" and kind_of("соре") == "whole" and kind_of("muri") == kind_of("Привет") == "single"
    assert frozenset.intersection(*script_sets("соре")) >= {"Latin", "Cyrillic"}
    assert form("Пpивeт") == form("Привет") == "Привет"  # Latin letters in a Russian word
    assert form("Пωs") == form("Пωѕ")  # no script holds all: class by class


def test_form_is_stable():
    for text in [a for a, _ in SAME] + [b for _, b in DIFFERENT]:
        assert form(form(text)) == form(text)


def test_pairs_nulls_long_repeated_and_clashing(spark):
    long = "amata " * 50_000
    rows = [(1, "Мuri", None), (2, "Muri", ""), (3, "Muri", "​"), (4, "muri", " "), (5, long, "x"), (6, long.replace("a", "а", 1), "x"), (7, None, "x​")]
    df = spark.createDataFrame([(i, p, r, "f", "k") for i, p, r in rows], "line_no long, prompt string, response string, field string, form string")
    got = {tuple(r) for r in lookalike_pairs(df, "line_no", ["prompt", "response"]).collect()}
    assert got == {("prompt", 1, 2), ("prompt", 1, 3), ("prompt", 5, 6), ("response", 5, 7), ("response", 6, 7)}
    assert lookalike_pairs(df.limit(0), "line_no", ["prompt"]).count() == 0
    forms = {r["line_no"]: r["prompt_form"] for r in with_forms(df, ["prompt"]).collect()}
    assert forms[7] is None and forms[1] == "Muri" and forms[5] == forms[6] == long.strip()
