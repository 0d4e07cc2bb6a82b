"""Problem 1: one form for text that looks the same.

A field's form is made in five steps: wide, narrow and ligature characters become their plain spelling; typographic
quotes, apostrophes and hyphens become plain ones; invisible characters go; each token is spelled in one script; any
run of white space becomes one space, and none stands at the ends.

The spelling of a token follows its resolved script set. Each letter belongs to a class of glyphs that look the same,
and a class has a spelling in one or several scripts; the intersection of those script sets over the token is what it
can consistently be written in. A mixed-script token ("Мuri" with a Cyrillic first letter) and a whole-script
confusable ("сор" all in Cyrillic) both have Latin in the intersection and are spelled in Latin; a Russian word with
one Latin letter has only Cyrillic left and gets it back; a token with an empty intersection is spelled class by class.
The result depends on the glyph classes alone, so tokens that look the same always come out equal, and case, accents,
digits and letters that differ stay apart.

Nulls stay null, an empty or invisible text gives the empty form, texts of any length are processed whole, repeated
rows are kept, extra columns pass through untouched.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StringType

from millrace.session import stage

# Letters that look like a Latin letter, as letter and Latin letter.
LOOKALIKES = {
    "Cyrillic": "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ҮY ХX ԚQ ԜW аa еe оo рp сc уy үy хx ѕs іi јj ԁd һh ԛq ԝw ѵv ӏl",
    "Greek": "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv ρp ϲc ϳj",
    "Armenian": "ՕO ՏS օo սu հh",
    "Cherokee": "ᎪA ᏴB ᏟC ᎠD ᎬE ᎻH ᎫJ ᏦK ᏞL ᎷM ᏢP ᎡR ᏚS ᎢT ᏙV ᎳW ᏃZ",
    "Coptic": "ⲎH ⲒI ⲔK ⲘM ⲚN ⲞO ⲢP ⲤC ⲦT ⲬX ⲟo ⲣp ⲥc",
    "Lisu": "ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU",
}
# Letters of two other scripts that look alike, Cyrillic and Greek.
CYRILLIC_GREEK = "ПΠ ГΓ ФΦ"
# Typographic marks that look like plain ones.
MARKS = {
    "'": "‘’‚‛ʼʻʹ′‹›ꞌ",
    '"': "“”„‟″",
    "-": "‐‑‒–—―−⁃﹘﹣",
    "...": "…",
    "g": "ɡ",
}
INVISIBLE = (
    "\u0000-\u0008\u000e-\u001b\u007f-\u0084\u0086-\u009f\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f"
    "\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\ufff0-\ufff8\U000e0000-\U000e0fff"
)
_INVISIBLE = re.compile(f"[{INVISIBLE}]+")
_TOKEN = re.compile("(?:[^\\W\\d_][\u0300-\u036f]*)+")
#: Beside these (ASCII, the no-break space, composed Latin letters) a text needs more than its white space made plain
_OTHER = re.compile("[^\\x00-\\x7f\\xa0\\xc0-\\xff]")
SCRIPTS = ("Latin", "Cyrillic", "Greek", "Armenian", "Cherokee", "Coptic", "Lisu")


def _plain_table() -> dict[int, str]:
    """By rule: the compatibility forms that look like their plain spelling (wide, narrow, ligatures, roman numerals, the
    letters and digits of mathematics)."""
    out: dict[int, str] = {}
    for code in [*range(0x80, 0x10000), *range(0x1D400, 0x1D800)]:
        kind, _, rest = unicodedata.decomposition(chr(code)).partition(" ")
        alike = code >= 0x1D400 or 0xFB00 <= code <= 0xFB06 or 0x2160 <= code <= 0x217F or code in (0x132, 0x133) or 0x1C4 <= code <= 0x1CC
        if kind in ("<wide>", "<narrow>") or kind in ("<compat>", "<font>") and alike:
            out[code] = unicodedata.normalize("NFKC", chr(code))
    for plain, marks in MARKS.items():
        out.update((ord(m), plain) for m in marks)
    for code, x in list(out.items()):  # a wide typographic mark
        out[code] = "".join(out.get(ord(c), c) if ord(c) > 127 else c for c in x)
    return out


_PLAIN = _plain_table()
#: letter -> {script: its spelling there}
_CLASS: dict[str, dict[str, str]] = {}
for _script, _pairs in LOOKALIKES.items():
    for _letter, _latin in _pairs.split():
        _CLASS.setdefault(_latin, {"Latin": _latin}).setdefault(_script, _letter)
        _CLASS[_letter] = _CLASS[_latin]
for _c, _g in CYRILLIC_GREEK.split():
    _CLASS[_c] = _CLASS[_g] = {"Cyrillic": _c, "Greek": _g}
_FOREIGN = re.compile("[" + "".join(c for c in _CLASS if ord(c) > 127) + "]")


def script_of(letter: str) -> str:
    return unicodedata.name(letter, "?").split(" ")[0].title()


def script_sets(token: str) -> list[frozenset[str]]:
    """For each letter of a decomposed token the scripts its glyph class can be written in."""
    return [frozenset(_CLASS.get(c) or (script_of(c),)) for c in token if not unicodedata.combining(c)]


def kind_of(token: str) -> str:
    """`single`, `mixed` (letters of several scripts as written) or `whole` (one other script, all of it confusable)."""
    written = {script_of(c) for c in token if not unicodedata.combining(c)}
    if len(written) > 1:
        return "mixed"
    return "whole" if written != {"Latin"} and frozenset.intersection(*script_sets(token)) >= {"Latin"} else "single"


def _spell(m: re.Match) -> str:
    token = m[0]
    if not _FOREIGN.search(token):
        # Latin lookalikes inside a word of another script carry no foreign confusable letter
        if token.isascii() or all(ord(c) < 0x370 for c in token):
            return token
    common = frozenset.intersection(*script_sets(token))
    into = next((s for s in SCRIPTS if s in common), None)
    if into:
        return "".join(_CLASS[c][into] if c in _CLASS else c for c in token)
    return "".join(next(_CLASS[c][s] for s in SCRIPTS if s in _CLASS[c]) if c in _CLASS else c for c in token)


def form(text: str | None, lines: bool = False) -> str | None:
    """The form of a text, in plain Python (what the column function computes). lines: keep line breaks."""
    if text is None:
        return None
    if _OTHER.search(text):
        text = unicodedata.normalize("NFD", _INVISIBLE.sub("", text.translate(_PLAIN)))
        if _FOREIGN.search(text):
            text = _TOKEN.sub(_spell, text)
        text = unicodedata.normalize("NFC", text)
    else:
        text = _INVISIBLE.sub("", text)
    return "\n".join(" ".join(x.split()) for x in text.split("\n")) if lines else " ".join(text.split())


@arrow_udf(StringType())
def _form_udf(texts: pa.Array) -> pa.Array:
    return pa.array([form(x) for x in texts.to_pylist()], pa.string())


@arrow_udf(StringType())
def _lines_udf(texts: pa.Array) -> pa.Array:
    return pa.array([form(x, True) for x in texts.to_pylist()], pa.string())


#: Texts without these need no Python: printable ASCII and plain white space
_SPECIAL = r"[^\x20-\x7e\t\n\x0b\f\r]"


def form_column(text: Column) -> Column:
    """The form of a string column. Plain ASCII is done in the JVM; only other texts cross into Python."""
    plain = F.trim(F.regexp_replace(text, r"[\x20\t\n\x0b\f\r]+", " "))
    special = F.rlike(text, F.lit(_SPECIAL))
    return F.when(special, _form_udf(F.when(special, text))).otherwise(plain)


def lines_column(text: Column) -> Column:
    """The form of a string column that keeps its line breaks. Plain ASCII passes as it is."""
    special = F.rlike(text, F.lit(_SPECIAL))
    return F.when(special, _lines_udf(F.when(special, text))).otherwise(text)


def with_forms(df: DataFrame, fields: list[str], suffix: str = "_form") -> DataFrame:
    """`df` and, for each field, its form as `<field><suffix>`."""
    return df.withColumns({f"{c}{suffix}": form_column(F.col(c)) for c in fields})


def lookalike_pairs(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """field, <key>_a, <key>_b (smaller first): rows whose `field` isn't empty, looks the same, and isn't the same string.

    Rows become (field, digest of the form, digest of the text) once, in a staged table of 40 bytes a row. Classes of
    one spelling, however large, fall out by a partial aggregate; the rest join spelling by spelling, so that a class
    held by a third of all rows costs its output and no more, and adaptive execution may split it.
    """
    formed = df.select(F.col(key).alias("_id"), *fields)
    formed = with_forms(formed, fields, "\u0001")
    digest = lambda c: F.unhex(F.md5(c.cast("binary")))
    parts = F.array(*[
        F.struct(F.lit(c).alias("field"), digest(F.col(f"{c}\u0001")).alias("form"), digest(F.col(c)).alias("text"), (F.col(f"{c}\u0001") != "").alias("ok"))
        for c in fields
    ])
    rows = stage(formed.select("_id", F.inline(parts)).filter("ok").drop("ok"), "forms")
    by = ["field", "form"]
    several = rows.groupBy(*by).agg(F.min("text").alias("lo"), F.max("text").alias("hi")).filter("lo <> hi").select(*by)
    kept = stage(rows.join(several, by, "left_semi"), "lookalikes")
    spellings = kept.select(*by, "text").distinct()
    two = spellings.select(*by, F.col("text").alias("ta")).join(spellings.select(*by, F.col("text").alias("tb")), by).filter("ta < tb")
    left = kept.select(*by, F.col("text").alias("ta"), F.col("_id").alias("ia"))
    right = kept.select(*by, F.col("text").alias("tb"), F.col("_id").alias("ib"))
    found = two.join(left, [*by, "ta"]).join(right, [*by, "tb"])
    return found.select("field", F.least("ia", "ib").alias(f"{key}_a"), F.greatest("ia", "ib").alias(f"{key}_b"))
