"""Cleaning: ordered reasons, exact duplicates, rejects, best records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import join_by_size, stage


@dataclass(frozen=True)
class CleanConfig:
    min_prompt: int = 6
    min_response: int = 24
    max_response: int = 6000
    max_run: int = 12
    min_unique: float = 0.12
    max_english: float = 0.45
    refuse_roles: bool = True


def first_reason(checks: list[tuple[str, Column]], ok: str = "ok") -> Column:
    """The name of the first check that holds; CASE evaluates no further ones."""
    (name, condition), *rest = checks
    out = F.when(condition, name)
    for name, condition in rest:
        out = out.when(condition, name)
    return out.otherwise(ok)


def judged(df: DataFrame, prompt: str, response: str, mode: str, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """`df` and `_reason`: why a pair is to be dropped, or `ok`.

    What several checks need (normalised texts, words) is made in projections of its own, once a row."""
    p, r, ws = F.col("_p"), F.col("_r"), F.col("_ws")
    made = df.withColumns({"_p": T.norm(F.col(prompt)), "_r": T.norm(F.col(response))})
    # words are looked for only in responses whose length is in order
    made = made.withColumn("_ws", F.when(F.char_length(r).between(cfg.min_response, cfg.max_response), T.words(r)))
    checks = [
        ("empty_prompt", p == ""),
        ("empty_response", r == ""),
        ("prompt_too_short", F.char_length(p) < cfg.min_prompt),
        ("response_too_short", F.char_length(r) < cfg.min_response),
        ("response_too_long", F.char_length(r) > cfg.max_response),
    ]
    if cfg.refuse_roles:
        checks.append(("role_prefix_leakage", F.contains(r, F.lit("User:")) | F.contains(r, F.lit("Assistant:"))))
    checks += [
        ("response_no_words", F.size(ws) == 0),
        ("response_word_repetition", T.longest_run(ws) > cfg.max_run),
        ("response_low_unique_ratio", T.unique_ratio(ws) < cfg.min_unique),
        ("response_too_english_for_rw", T.fold(F.col(mode)).isin("rw", "control") & (T.english_share(ws) > cfg.max_english)),
    ]
    return made.withColumn("_reason", first_reason(checks)).drop("_ws")


def with_clean_reason(df: DataFrame, order: str, prompt: str = "prompt", response: str = "response", mode: str = "lang_mode", cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """`df` and `reason`: the first failing check, `duplicate_prompt_response` for a later copy of a kept pair, or `ok`.

    A reason but that of copies follows from the row alone. Rows that are good so far give (order, digest of the pair), of
    which `later_copies` are looked up; the rows themselves, with their texts, aren't shuffled unless those are many."""
    good = judged(df.select(order, prompt, response, mode), prompt, response, mode, cfg).filter("_reason = 'ok'")
    later = later_copies(good.select(F.col(order).alias("_order"), F.unhex(F.md5(F.concat(F.lower("_p"), F.lit("\n"), F.lower("_r")).cast("binary"))).alias("_key")))
    told = judged(df, prompt, response, mode, cfg).drop("_p", "_r")
    joined = join_by_size(told, later.withColumn("_later", F.lit(True)), told[order] == later["_order"], "left")
    verdict = F.when((F.col("_reason") == "ok") & F.col("_later"), "duplicate_prompt_response").otherwise(F.col("_reason"))
    return joined.withColumn("reason", verdict).drop("_order", "_later", "_reason")


def later_copies(keyed: DataFrame) -> DataFrame:
    """_order of the rows (_order, _key) that aren't the first of their key, staged. Keys that stand once fall out in a
    partial aggregate, which a key of a third of all rows doesn't strain; no window ranks a key's rows."""
    keyed = stage(keyed, "keys")
    several = keyed.groupBy("_key").agg(F.min("_order").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    return stage(keyed.join(several, "_key").filter("_order <> _first").select("_order"), "later")


def cleaned(df: DataFrame, order: str, prompt: str = "prompt", response: str = "response", mode: str = "lang_mode", cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Kept rows with their pair normalised and all other columns as they are."""
    kept = with_clean_reason(df, order, prompt, response, mode, cfg).filter("reason = 'ok'").drop("reason")
    return kept.withColumns({prompt: T.norm(F.col(prompt)), response: T.norm(F.col(response))})


def rejects(df: DataFrame, order: str, **kw) -> DataFrame:
    """line, reason and the record as JSON, of the rows that are dropped."""
    told = with_clean_reason(df, order, **kw).filter("reason <> 'ok'")
    return told.select(F.col(order), "reason", F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("record"))


def reason_counts(told: DataFrame) -> DataFrame:
    return told.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def keep_first(df: DataFrame, key: Column, order: str) -> DataFrame:
    """The first row of each key (rows of a null key all stay)."""
    digest = F.unhex(F.md5(key.cast("binary")))
    later = later_copies(df.select(F.col(order).alias("_order"), digest.alias("_key")).filter("_key IS NOT NULL"))
    return join_by_size(df, later, df[order] == later["_order"], "left_anti")


def best_record(df: DataFrame, key: Column, scored: list[str], created: str, order: list[str]) -> DataFrame:
    """Of each key the record with most filled fields, then the latest creation time, then the first in order.

    One aggregate with a struct as its maximum: partial on the map side, no sort, no window."""
    filled = sum((F.when(T.norm(F.col(c)) != "", 1).otherwise(0) for c in scored), F.lit(0))
    rank = F.struct(filled.alias("a"), F.coalesce(F.col(created), F.lit("")).alias("b"), *[(-F.col(c)).alias(f"o{i}") for i, c in enumerate(order)])
    keyed = df.withColumn("_key", key).filter("_key <> ''")
    return keyed.groupBy("_key").agg(F.max_by(F.struct(*df.columns), rank).alias("r")).select("r.*")


def frequent_prefixes(df: DataFrame, text: str, created: str, order: str, sample: int = 5000, size: int = 4, limit: int = 50) -> DataFrame:
    """Openings of at least two of the newest `sample` texts, most frequent first, of equals the one seen first (newest)."""
    newest = df.orderBy(F.desc(created), order).limit(sample)
    ws = T.space_words(F.col(text))
    opened = newest.filter(F.size(ws) >= 2).select(F.array_join(F.slice(ws, 1, size), " ").alias("prefix"), F.struct(F.col(created).alias("c"), (-F.col(order)).alias("o")).alias("seen"))
    counted = opened.groupBy("prefix").agg(F.count(F.lit(1)).alias("n"), F.max("seen").alias("seen")).filter("n >= 2")
    return counted.orderBy(F.desc("n"), F.desc("seen")).limit(limit).select("prefix", "n")


def recent(df: DataFrame, created: str, order: str, limit: int, topic: str | None = None, column: str = "topic") -> DataFrame:
    """The newest rows, of a topic if one is given."""
    rows = df if topic is None else df.filter(F.col(column) == topic)
    return rows.orderBy(F.desc(created), order).limit(max(0, limit))


def recent_by(df: DataFrame, group: str, created: str, order: str, limit: int) -> DataFrame:
    """The newest rows of each group. A ranked filter of a window is limited per group before the shuffle (WindowGroupLimit),
    so a group of any size sends `limit` rows a task."""
    w = Window.partitionBy(group).orderBy(F.desc(created), order)
    return df.withColumn("place", F.row_number().over(w)).filter(F.col("place") <= limit)
