"""Text, hash and similarity functions as Column expressions.

White space is the set Python's str.split knows (29 characters); word characters of `word_set` are letters, numbers and
the underscore. Every function takes and gives Columns; null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s\x1c-\x1f]+"
ZERO_WIDTH = r"[\u200b\u200c\u200d\ufeff]"
# Smart punctuation and its plain spelling, position by position; an ellipsis becomes three dots.
SMART = "’‘“”«»‹›–—‑‒−∕⁄：，；（）？！"
PLAIN = "''\"\"\"\"''-----//:,;()?!"
# English function words whose share tells English drift.
ENGLISH = "the and is are to of in that for with on this it as be by an from".split()
# Kinyarwanda function words whose share tells marker density.
MARKERS = "mu ku ni na ndi ariko kandi uko niba rwose cyangwa amakuru ubuzima".split()
# English words that make a text count as mixed.
MIXING = "the and is are to for with how what when where".split()
MIXED_FROM = 0.12


def norm(x: Column) -> Column:
    """Null to empty; ends trimmed; white-space runs to one space."""
    return F.coalesce(F.trim(F.regexp_replace(x, SPACE, " ")), F.lit(""))


def norm_ascii(x: Column) -> Column:
    """`norm`, without zero-width characters and with plain punctuation."""
    bare = F.replace(F.regexp_replace(norm(x), ZERO_WIDTH, ""), F.lit("…"), F.lit("..."))
    return norm(F.translate(bare, SMART, PLAIN))


def fold(x: Column) -> Column:
    """`norm` in lower case: how prompts are compared."""
    return F.lower(norm(x))


def pair_key(prompt: Column, response: Column) -> Column:
    return F.concat(fold(prompt), F.lit("\n"), fold(response))


def words(x: Column) -> Column:
    """ASCII words (letters and apostrophes), found first, then lower-cased."""
    return F.transform(F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit("([A-Za-z']+)"), F.lit(1)), F.lower)


def words_of_lower(x: Column) -> Column:
    """ASCII words of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("([A-Za-z']+)"), F.lit(1))


def word_set(x: Column) -> Column:
    """Distinct lower-case words of any script."""
    found = F.regexp_extract_all(F.coalesce(x, F.lit("")), F.lit(r"([\p{L}\p{N}_']+)"), F.lit(1))
    return F.array_distinct(F.transform(found, F.lower))


def space_words(x: Column) -> Column:
    """Lower-case words between white space; none for a blank text."""
    return F.filter(F.split(fold(x), " "), lambda w: w != "")


def longest_run(ws: Column) -> Column:
    """The longest run of one word, in one pass over the array."""
    zero = F.struct(F.lit("").alias("word"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, w: Column) -> Column:
        run = F.when((a["run"] > 0) & (a["word"] == w), a["run"] + 1).otherwise(F.lit(1))
        return F.struct(w.alias("word"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(ws, zero, step, lambda a: a["best"])


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, 0 where there is nothing."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def unique_ratio(ws: Column) -> Column:
    return ratio(F.size(F.array_distinct(ws)), F.size(ws))


def share_of(ws: Column, listed: Iterable[str]) -> Column:
    """The share of words that are on a list."""
    listed = list(listed)
    return ratio(F.size(F.filter(ws, lambda w: w.isin(listed))), F.size(ws))


def english_share(ws: Column) -> Column:
    return share_of(ws, ENGLISH)


def marker_share(x: Column) -> Column:
    return share_of(words_of_lower(x), MARKERS)


def inferred_mode(x: Column) -> Column:
    """`rw_mixed` if enough words are English, else `rw`."""
    return F.when(share_of(words_of_lower(x), MIXING) >= MIXED_FROM, "rw_mixed").otherwise("rw")


def jaccard(a: Column, b: Column) -> Column:
    """Of two distinct arrays: 1 if both are empty, 0 if one is."""
    common, total = F.size(F.array_intersect(a, b)), F.size(a) + F.size(b)
    return F.when(total == 0, F.lit(1.0)).otherwise(ratio(common, total - common))


def perplexity(loss: Column) -> Column:
    return F.exp(F.least(loss, F.lit(20.0)))


def has_non_ascii(x: Column) -> Column:
    return F.rlike(F.coalesce(x, F.lit("")), F.lit("[^\\x00-\\x7F]"))


def digest16(x: Column) -> Column:
    return F.substring(F.sha1(x), 1, 16)


def record_id(given: Column, line_no: Column, prompt: Column) -> Column:
    """The id as given, else one made of the line and the prompt."""
    made = F.concat(F.lit("auto_"), digest16(F.concat(line_no.cast("string"), F.lit(":"), F.coalesce(prompt, F.lit("")))))
    return F.coalesce(F.nullif(norm(given), F.lit("")), made)


def prompt_id(prefix: str, prompt: Column) -> Column:
    return F.concat(F.lit(prefix), digest16(prompt))


def unit_hash(key: Column) -> Column:
    """A number in [0, 1] from the first eight hex digits of the key's SHA-1."""
    return F.conv(F.substring(F.sha1(key), 1, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def split_of(key: Column, train: float = 0.9, val: float = 0.05) -> Column:
    """train, val or test by the key's hash. The ratios must leave something for test."""
    if not (0 < train and 0 <= val and train + val < 1):
        raise ValueError(f"ratios {train} and {val}")
    x = unit_hash(key)
    return F.when(x < train, "train").when(x < train + val, "val").otherwise("test")


def signed(x: Column) -> Column:
    """A number with its sign and six decimals."""
    return F.format_string("%+.6f", x)
