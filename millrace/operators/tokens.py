"""Token examples, masks, batches."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType

from millrace.functions import text as T

MASKED = -100
#: A tokenizer takes texts and gives their ids; it is built once per worker.
TokenizerFn = Callable[[list[str]], list[list[int]]]


def prompt_text(prompt: Column, user: str = "User: ", assistant: str = "Assistant: ") -> Column:
    p = T.norm(prompt)
    return F.concat(F.when(F.startswith(p, F.lit(user)), p).otherwise(F.concat(F.lit(user), p)), F.lit("\n" + assistant))


def char_ids(x: Column, modulus: int = 251) -> Column:
    """Ids of a character tokenizer: code point by modulus. Stays in the JVM."""
    return F.transform(F.filter(F.split(x, ""), lambda c: c != ""), lambda c: F.ascii(c) % modulus)


def token_ids(x: Column, make: Callable[[], TokenizerFn]) -> Column:
    """Ids of any tokenizer, a batch at a time."""

    @arrow_udf(ArrayType(IntegerType()))
    def ids(texts: pa.Array) -> pa.Array:
        cache = ids_of.__dict__
        if "made" not in cache:
            cache["made"] = make()
        return pa.array(cache["made"]([t or "" for t in texts.to_pylist()]), pa.list_(pa.int32()))

    def ids_of() -> None: ...

    return ids(x)


def examples(df: DataFrame, ids: Callable[[Column], Column], prompt: str, response: str, seq_len: int, eos: str = "") -> DataFrame:
    """`df` with input_ids, labels (the prompt's masked) and supervised, where something is left to learn from."""
    full = ids(F.concat(prompt_text(F.col(prompt)), F.coalesce(F.col(response), F.lit("")), F.lit(eos)))
    told = df.withColumns({"_p": F.size(ids(prompt_text(F.col(prompt)))), "_f": F.slice(full, 1, seq_len) if seq_len > 0 else full})
    masked = F.least(F.col("_p"), F.size("_f"))
    # what follows the mask begins after it; slice counts from 1
    labels = F.concat(F.array_repeat(F.lit(MASKED), masked), F.slice("_f", masked + 1, F.greatest(F.size("_f") - masked, F.lit(0))))
    return told.select(*df.columns, F.col("_f").alias("input_ids"), labels.alias("labels"), (F.size("_f") - masked).alias("supervised")).filter("supervised > 0")


def batch_numbers(df: DataFrame, order: str, size: int, block: int = 100_000) -> DataFrame:
    """`df` with `batch` (from 0) and `place` in it, in the order's sequence. Places come from counts per block of the
    order, so no task sorts all rows."""
    blocked = df.withColumn("_b", F.floor(F.col(order) / block))
    counts = blocked.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    starts = counts.select("_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.row_number().over(Window.partitionBy("_b").orderBy(order)) - 1
    told = blocked.join(starts, "_b").withColumn("_place", place)
    return told.withColumns({"batch": F.floor(F.col("_place") / size), "place": F.col("_place") % size}).drop("_b", "_start", "_place")


def padded(batched: DataFrame, pad: int = 0) -> DataFrame:
    """`batched` with ids, labels and mask filled up to the longest of their batch (an aggregate joined back: batches are
    small, but many)."""
    longest = batched.groupBy("batch").agg(F.max(F.size("input_ids")).alias("_l"))
    told = batched.join(longest, "batch")
    gap = F.col("_l") - F.size("input_ids")
    fill = lambda c, v: F.concat(F.col(c), F.array_repeat(F.lit(v), gap))
    mask = F.concat(F.array_repeat(F.lit(1), F.size("input_ids")), F.array_repeat(F.lit(0), gap))
    return told.withColumns({"mask": mask}).withColumns({"input_ids": fill("input_ids", pad), "labels": fill("labels", MASKED)}).drop("_l")


def steps(valid: Column, batch: int, accumulation: int, epochs: int, cap: int = 0, warm_up: float = 0.03) -> tuple[Column, Column]:
    """(training steps, warm-up steps)."""
    total = F.ceil(valid / (batch * accumulation)) * epochs
    total = F.least(total, F.lit(cap)) if cap > 0 else total
    return total.cast("bigint"), F.floor(total * warm_up).cast("bigint")
