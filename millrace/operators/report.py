"""Splits, content mix, summaries, gates, circuit breaking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import running_sum, stage


def split_key(conversation: Column, record: Column, prompt: Column, whole: Column) -> Column:
    """What decides a record's split: its conversation, else its id, else its prompt, else all of it."""
    named = F.when(T.norm(conversation) != "", F.concat(F.lit("conversation:"), T.norm(conversation)))
    return F.coalesce(named, F.nullif(T.norm(record), F.lit("")), F.nullif(T.norm_ascii(prompt), F.lit("")), whole)


def with_split(df: DataFrame, train: float = 0.9, val: float = 0.05, conversation: str = "conversation_id", record: str = "id", prompt: str = "prompt") -> DataFrame:
    """`df` and `split`. No shuffle: the hash of the key alone decides."""
    return df.withColumn("split", T.split_of(split_key(F.col(conversation), F.col(record), F.col(prompt), F.to_json(F.struct(*sorted(df.columns)))), train, val))


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def content_mix(df: DataFrame) -> DataFrame:
    """dim, value, n, ratio: counts of content types, language modes and topics in one pass (grouping sets)."""
    unknown = lambda *cs: F.coalesce(*[F.nullif(T.norm(F.col(c)), F.lit("")) for c in cs], F.lit("unknown"))
    told = df.select(unknown("content_type", "task_type").alias("content_type"), unknown("lang_mode").alias("lang_mode"), unknown("topic").alias("topic"))
    sets = [[F.col("content_type")], [F.col("lang_mode")], [F.col("topic")], []]
    counted = told.groupingSets(sets, "content_type", "lang_mode", "topic").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    dim = F.when(F.col("g") == 3, "content_type").when(F.col("g") == 5, "lang_mode").when(F.col("g") == 6, "topic").otherwise("all")
    named = counted.select(dim.alias("dim"), F.coalesce("content_type", "lang_mode", "topic", F.lit("")).alias("value"), "n")
    total = named.filter("dim = 'all'").select(F.col("n").alias("total"))
    return named.join(F.broadcast(total), how="cross").select("dim", "value", "n", T.ratio(F.col("n"), F.col("total")).alias("ratio"))  # one row


def mix_failures(mix: DataFrame, plan: DataFrame) -> DataFrame:
    """dim, value, ratio, least: planned categories below their least ratio (absent ones have 0)."""
    seen = mix.select("dim", "value", "ratio")
    joined = plan.join(seen, ["dim", "value"], "left").withColumn("ratio", F.coalesce("ratio", F.lit(0.0)))
    return joined.filter(F.col("ratio") < F.col("least")).select("dim", "value", "ratio", "least")


def top_value(df: DataFrame, column: str, order: str) -> DataFrame:
    """The most frequent value; of equals the one seen first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
    return counts.orderBy(F.desc("n"), "first").limit(1).select(column, "n")


def summary(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Per group: lines, valid pairs, invalid lines, mean characters of valid prompts and responses (0 where none)."""
    p, r = T.norm(F.col("prompt")), T.norm(F.col("response"))
    told = pairs.select(*by, p.alias("p"), r.alias("r"), ((p != "") & (r != "")).alias("ok"))
    mean = lambda c: T.ratio(F.coalesce(F.sum(F.when(F.col("ok"), F.char_length(c))), F.lit(0)), F.count_if("ok"))
    return told.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("ok").alias("valid_rows"), F.count_if(~F.col("ok")).alias("invalid_rows"),
        mean("p").alias("avg_prompt_chars"), mean("r").alias("avg_response_chars"),
    )


def preflight(summaries: DataFrame, name: str, least: int = 100) -> DataFrame:
    """Failures of splits with too few valid rows."""
    return summaries.filter(F.col("valid_rows") < least).select(F.concat(F.lit("too_few_valid_rows:"), F.col(name), F.lit(":"), F.col("valid_rows").cast("string")).alias("failure"))


def gate(delta: DataFrame, max_drift: float = 0.0, min_marker: float = 0.0, need_val: bool = True, need_test: bool = True) -> DataFrame:
    """passed and reasons of a one-row frame of metric deltas; a missing delta counts as 0."""
    d = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) if c in delta.columns else F.lit(0.0) for c in ("val_ppl_delta", "test_ppl_delta", "english_drift_delta", "rw_marker_density_delta")}
    worse = lambda name, c: F.when(~(d[c] < 0), F.concat(F.lit(f"{name}_not_improved:"), T.signed(d[c])))
    failed = [
        worse("val_ppl", "val_ppl_delta") if need_val else F.lit(None).cast("string"),
        worse("test_ppl", "test_ppl_delta") if need_test else F.lit(None).cast("string"),
        F.when(d["english_drift_delta"] > max_drift, F.concat(F.lit("english_drift_delta_too_high:"), T.signed(d["english_drift_delta"]), F.lit(">"), T.signed(F.lit(float(max_drift))))),
        F.when(d["rw_marker_density_delta"] < min_marker, F.concat(F.lit("rw_marker_density_too_low:"), T.signed(d["rw_marker_density_delta"]), F.lit("<"), T.signed(F.lit(float(min_marker))))),
    ]
    reasons = F.array_compact(F.array(*failed))
    return delta.select((F.size(reasons) == 0).alias("passed"), F.array_join(reasons, ";").alias("reasons"))


def failure_runs(log: DataFrame, by: str, order: str, failed: Column) -> DataFrame:
    """Per group: runs of consecutive failures (where a run started and its length). A run is the failures between two
    successes, so it is told by the number of successes before; those are running sums over blocks, no group in one task."""
    told = running_sum(log.select(by, order, F.coalesce(failed, F.lit(False)).alias("_f")), F.when(F.col("_f"), 0).otherwise(1), [by], order, "_good")
    return told.filter("_f").groupBy(by, "_good").agg(F.min(order).alias("started"), F.count(F.lit(1)).alias("length")).drop("_good")


def streak(log: DataFrame, by: str, order: str, failed: str, name: str) -> DataFrame:
    """`log` with the number of failures in a row up to and with each row (0 after a success). Both sums are running sums over
    blocks: failures so far, less those up to the last success, which its number of successes tells."""
    bad = F.coalesce(F.col(failed), F.lit(False))
    told = running_sum(log, F.when(bad, 0).otherwise(1), [by], order, "_good")
    told = stage(running_sum(told, F.when(bad, 1).otherwise(0), [by], order, "_bad"), "streak")  # read twice
    before = told.groupBy(by, "_good").agg(F.min(F.col("_bad") - F.when(bad, 1).otherwise(0)).alias("_before"))
    return told.join(before, [by, "_good"]).withColumn(name, F.col("_bad") - F.col("_before")).drop("_good", "_bad", "_before")


def breaker(consecutive: dict[str, Column], limits: list[tuple[str, int]]) -> Column:
    """The first limit reached, in the order given, or the empty string. A limit of 0 is off."""
    out = F.lit("")
    for name, limit in reversed(limits):
        if limit > 0:
            out = F.when(consecutive[name] >= limit, f"consecutive_{name}_limit_reached").otherwise(out)
    return out


def cooldown(base: float, jitter: float, failed: bool, consecutive: int, step: float, cap: float) -> float:
    """Seconds to wait: the base, a share of jitter (0 to 1 of it is the caller's draw), and more after failures in a row."""
    return base + jitter + (min(cap, step * max(1, consecutive)) if failed else 0.0)


# What an error's text holds, and its class, for each of the five kinds of calls, first match first.
FAILURE_CLASSES = {
    "answers": [
        ("http_429", "openai_429"),
        ("empty_completion_text", "empty_completion_text"),
        ("no_json_object_found", "invalid_json_output"),
        ("missing_items_list", "invalid_json_output"),
        ("timed out", "timeout"),
        ("", "openai_error"),
    ],
    "seed items": [
        ("http_429", "429"),
        ("invalid_json_output", "parse"),
        ("items_not_list", "parse"),
        ("invalid_payload_not_object", "parse"),
        ("json_object_not_dict", "parse"),
    ],
    "mixed seeds": [
        ("http_429", "429"),
        ("invalid_json_output", "parse"),
        ("no_json_object_found", "parse"),
        ("json_object_not_dict", "parse"),
        ("invalid_payload_not_object", "parse"),
    ],
    "dialogues": [
        ("http_429", "429"),
        ("invalid_json", "parse"),
        ("json_object_not_dict", "parse"),
        ("no_json_object_found", "parse"),
        ("messages_not_even", "parse"),
        ("roles_not_alternating", "parse"),
    ],
    "listed seeds": [("http_429", "429")],
}


def latest_step(paths: DataFrame, column: str) -> DataFrame:
    """path, step: of paths that end in `step-<number>`, the one of the highest step."""
    step = F.regexp_extract(F.col(column), r"(?:^|/)step-(\d+)/?$", 1)
    told = paths.select(F.col(column).alias("path"), F.nullif(step, F.lit("")).cast("bigint").alias("step"))
    return told.filter("step IS NOT NULL").agg(F.max_by("path", "step").alias("path"), F.max("step").alias("step"))


def throughput(tokens: Column, seconds: Column) -> Column:
    """Tokens a second; a run too short to time counts as a millionth of a second."""
    return tokens.cast("double") / F.greatest(seconds.cast("double"), F.lit(1e-6))


def failure_class(error: Column, classes: list[tuple[str, str]], other: str = "error") -> Column:
    """The class of the first needle found in an error's lower-case text."""
    low = F.lower(F.coalesce(error, F.lit("")))
    out = F.when(F.contains(low, F.lit(classes[0][0])), classes[0][1])
    for needle, name in classes[1:]:
        out = out.when(F.contains(low, F.lit(needle)), name)
    return out.otherwise(other)
