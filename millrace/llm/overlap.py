"""Problem 5: the same or near-same records across splits.

Two records overlap if they share at least `least` of their distinct words (common words over all words of both), case,
punctuation and character forms aside. Records of one word set are one class, however many there are, so a group of
copies is joined once. An exact prefix-filter join (millrace.operators.setjoin) indexes the rarest shingles of evaluation
classes and probes them with those of training classes; length, position and bitmaps turn pairs away within the join, the
sets of what is left are compared in full, and class pairs become pairs of rows. As overlap is defined on sets of words,
whatever their order, a shingle is a cell of such a set (the words whose hash falls into it), not words in a row.

Words are compared by 64-bit hashes. Records without words overlap with nothing; a null source is reported as null;
repeated rows each count; extra columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.forms import form_column
from millrace.operators.dedup import set_key
from millrace.operators.setjoin import similar_sets
from millrace.session import stage


def word_set(text: Column) -> Column:
    """Hashes of the distinct words of a text."""
    found = F.regexp_extract_all(F.lower(form_column(text)), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda w: F.xxhash64(w))))


def split_overlaps(evaluation: DataFrame, training: DataFrame, key: str, text: str, least: float = 0.8, frequent: int = 20_000) -> DataFrame:
    """eval_key, train_key: all pairs of rows whose texts overlap. Keys are unique LONGs on each side."""
    sides = []
    for label, df in (("evaluation", evaluation), ("training", training)):
        rows = df.select(F.col(key).alias("id"), word_set(F.col(text)).alias("elements")).filter(F.size("elements") > 0)
        rows = stage(rows.withColumn("set", set_key(F.col("elements"))), label)
        classes = stage(rows.groupBy("set").agg(F.min("id").alias("class"), F.first("elements").alias("elements")), f"{label}-sets")
        sides.append((rows.select("id", "set").join(classes.select("set", "class"), "set").select("id", "class"), classes.select(F.col("class").alias("id"), "elements")))
    (eval_rows, eval_sets), (train_rows, train_sets) = sides
    same = similar_sets(eval_sets, train_sets, least, frequent).select("left", "right")
    return same.join(eval_rows.select(F.col("class").alias("left"), F.col("id").alias("eval_key")), "left").join(train_rows.select(F.col("class").alias("right"), F.col("id").alias("train_key")), "right").select("eval_key", "train_key")


def overlap_report(pairs: DataFrame, evaluation: DataFrame, key: str, split: str, source: str) -> DataFrame:
    """Per evaluation split and source: its rows, its rows with a like in training, and the pairs."""
    counts = pairs.groupBy("eval_key").agg(F.count(F.lit(1)).alias("n"))
    rows = evaluation.select(F.col(key).alias("eval_key"), F.col(split).alias("split"), F.col(source).alias("source"))
    joined = rows.join(counts, "eval_key", "left")
    return joined.groupBy("split", "source").agg(F.count(F.lit(1)).alias("n_rows"), F.count("n").alias("n_leaked"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_pairs"))
