"""JSON lines: reading with physical line numbers, records of changing shape, repair, writing.

Records are VARIANT values, so keys nobody asked for survive. `spark.sql.variant.allowDuplicateKeys` is set on read so
that of repeated keys the last one counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import join_by_size, stage

PAIRS = "array<struct<prompt:string,response:string>>"


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """file, line_no (physical, from 1, blank lines counted) and value, of spark.read.text. A file is read in blocks, each
    by one task; numbers are the place in the block plus the lines of the blocks before, so lines never meet in one task."""
    meta = F.col("_metadata")
    told = lines.select(meta["file_path"].alias("file"), "value", meta["file_block_start"].alias("_at"), F.monotonically_increasing_id().alias("_i"))
    blocks = told.groupBy("file", "_at").agg(F.count(F.lit(1)).alias("_n"), F.min("_i").alias("_first"))
    before = Window.partitionBy("file").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = stage(blocks.select("file", "_at", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")), "blocks")
    joined = join_by_size(told, starts, ["file", "_at"], "inner", 200_000)  # a row per block
    return joined.select("file", (F.col("_start") + F.col("_i") - F.col("_first") + 1).alias("line_no"), "value")


def read_jsonl(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no, value, v (VARIANT) of the lines that are JSON objects; others are skipped, their numbers kept."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    numbered = with_line_numbers(spark.read.text(path))
    return numbered.filter(F.json_object_keys("value").isNotNull()).withColumn("v", F.try_parse_json("value")).filter("v IS NOT NULL")


def has(value: Column, key: str) -> Column:
    """Whether a JSON object has a key, even with a null."""
    return F.coalesce(F.array_contains(F.json_object_keys(value), key), F.lit(False))


def field(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def messages(v: Column, path: str = "$.messages") -> Column:
    """Messages of a record; elements that aren't objects are skipped, one by one."""
    raw = F.try_variant_get(v, path, "array<variant>")
    said = F.transform(raw, lambda m: F.struct(F.try_variant_get(m, "$.role", "string").alias("role"), F.try_variant_get(m, "$.content", "string").alias("content")))
    kept = F.filter(said, lambda m: m["role"].isNotNull() | m["content"].isNotNull())
    return F.coalesce(kept, F.array().cast("array<struct<role:string,content:string>>"))


def _said(v: Column, role: str) -> Column:
    mine = F.filter(messages(v), lambda m: (F.lower(T.norm(m["role"])) == role) & (T.norm_ascii(m["content"]) != ""))
    return F.coalesce(T.norm_ascii(F.get(mine, F.lit(0))["content"]), F.lit(""))


def prompt_of(value: Column, v: Column) -> Column:
    """The prompt of a record of any shape; the first key present decides, even if it is null."""
    get = lambda k: T.norm_ascii(field(v, f"$.{k}"))
    joined = F.when(get("input") != "", F.concat(get("instruction"), F.lit("\n"), get("input"))).otherwise(get("instruction"))
    return F.when(has(value, "prompt"), get("prompt")).when(has(value, "question"), get("question")).when(has(value, "instruction") & has(value, "output"), joined).otherwise(_said(v, "user"))


def response_of(value: Column, v: Column) -> Column:
    get = lambda k: T.norm_ascii(field(v, f"$.{k}"))
    return F.when(has(value, "response"), get("response")).when(has(value, "answer"), get("answer")).when(has(value, "output"), get("output")).otherwise(_said(v, "assistant"))


def pairs_of(value: Column, v: Column) -> Column:
    """All (prompt, response) pairs of a record, as a trainer reads them: pair, instruction, or every turn of a dialogue."""
    from millrace.operators.chat import history_pairs, spoken

    get = lambda k: T.norm(field(v, f"$.{k}"))
    one = lambda p, r: F.array(F.struct(p.alias("prompt"), r.alias("response")))
    joined = F.when(get("input") != "", F.concat(get("instruction"), F.lit("\n"), get("input"))).otherwise(get("instruction"))
    return (
        F.when(has(value, "prompt") & has(value, "response"), one(get("prompt"), get("response")))
        .when(has(value, "instruction") & has(value, "output"), one(joined, get("output")))
        .when(has(value, "messages"), history_pairs(spoken(messages(v))))
        .otherwise(F.array().cast(PAIRS))
    )


def read_pairs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """file, line_no, pair_no, prompt, response: pairs with both sides."""
    exploded = read_jsonl(spark, path).select("file", "line_no", F.posexplode(pairs_of(F.col("value"), F.col("v"))).alias("pair_no", "pair"))
    return exploded.select("file", "line_no", "pair_no", "pair.*").filter("prompt <> '' AND response <> ''")


def summarize_lines(lines: DataFrame, by: list[str]) -> DataFrame:
    """Per group of physical lines (column `value`): n_lines (blank and malformed ones too), valid_pairs (a dialogue may hold
    several), invalid_lines (without a valid pair), mean characters of prompts and responses of valid pairs (0 where none)."""
    record = F.when(F.json_object_keys("value").isNotNull(), F.try_parse_json("value"))
    pairs = F.filter(pairs_of(F.col("value"), F.col("v")), lambda p: (p["prompt"] != "") & (p["response"] != ""))
    told = lines.select(*by, "value", record.alias("v")).select(*by, F.when(F.col("v").isNotNull(), pairs).alias("pairs"))
    chars = lambda k: F.coalesce(F.aggregate("pairs", F.lit(0).cast("bigint"), lambda a, p: a + F.char_length(p[k])), F.lit(0))
    told = told.select(*by, F.greatest(F.coalesce(F.size("pairs"), F.lit(0)), F.lit(0)).alias("n"), chars("prompt").alias("p"), chars("response").alias("r"))
    n = F.coalesce(F.sum("n"), F.lit(0))
    return told.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_lines"), n.alias("valid_pairs"), F.count_if(F.col("n") == 0).alias("invalid_lines"),
        T.ratio(F.sum("p"), n).alias("avg_prompt_chars"), T.ratio(F.sum("r"), n).alias("avg_response_chars"),
    )


def in_file_order(df: DataFrame) -> DataFrame:
    """`df` (file, line_no, ...) with `place`, one whole number that sorts by file name, then line."""
    files = df.select("file").distinct().withColumn("_n", F.row_number().over(Window.orderBy("file")) - 1)  # a row a file
    joined = join_by_size(df, stage(files, "files"), ["file"], "inner", 200_000)
    return joined.withColumn("place", F.col("_n") * F.lit(2**40) + F.col("line_no")).drop("_n")


def token_examples(spark: SparkSession, path: str | list[str], ids: Callable[[Column], Column], seq_len: int, eos: str = "") -> DataFrame:
    """file, line_no, pair_no, input_ids, labels, supervised of every pair in the files that leaves something to learn."""
    from millrace.operators.tokens import examples

    return examples(read_pairs(spark, path), ids, "prompt", "response", seq_len, eos).drop("prompt", "response")


# ---- model output


def unfenced(x: Column) -> Column:
    """Without a code fence around it (and its language word)."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(x, F.lit(""))), r"^```[A-Za-z]*[ \t]*\n?", ""), r"\n?[ \t]*```$", ""))


def json_block(x: Column) -> Column:
    """From the first opening to the last closing brace."""
    return F.regexp_extract(x, r"(?s)(\{.*\})", 1)


def _strings_on_one_line(x: Column) -> Column:
    """JSON text whose strings hold line breaks and tabs as escapes. Quotes that aren't escaped part strings from the rest."""
    parts = F.split(x, r'(?<!\\)"')
    inside = lambda s: F.replace(F.replace(F.replace(s, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("\t"), F.lit("\\t"))
    return F.array_join(F.transform(parts, lambda s, i: F.when(i % 2 == 1, inside(s)).otherwise(s)), '"')


def with_repaired(df: DataFrame, text: str, name: str = "v") -> DataFrame:
    """`df` and a VARIANT from model output: as it is, its block, without trailing commas, with stray backslashes escaped, with
    line breaks and tabs in strings escaped, closed where it breaks off; the first that parses. Each form is made once a row,
    in a projection of its own."""
    body, block, bare, slashes = (F.col(f"_{n}\u0001") for n in ("body", "block", "bare", "slashes"))
    told = df.withColumn("_body\u0001", unfenced(F.col(text)))
    told = told.withColumn("_block\u0001", F.when(json_block(body) != "", json_block(body)).otherwise(F.regexp_extract(body, r"(?s)(\{.*)", 1)))
    told = told.withColumn("_bare\u0001", F.regexp_replace(block, r",(\s*[}\]])", "$1"))
    told = told.withColumn("_slashes\u0001", F.regexp_replace(bare, r'\\(?!["\\/bfnrtu])', r"\\\\\\\\"))
    told = told.withColumn("_line\u0001", _strings_on_one_line(slashes))
    line = F.col("_line\u0001")
    tries = [body, block, bare, slashes, line]
    tries += [F.concat(line, F.lit(end)) for end in ("}", "]}", "}]}", '"}', '"]}', '"}]}')]
    value = F.coalesce(*[F.try_parse_json(F.nullif(t, F.lit(""))) for t in tries])
    return told.withColumn(name, value).drop(*[f"_{n}\u0001" for n in ("body", "block", "bare", "slashes", "line")])


def items_of(v: Column, required: list[str]) -> Column:
    """The objects of `items`, or the value itself if it has all required keys."""
    listed = F.try_variant_get(v, "$.items", "array<variant>")
    own = [F.try_variant_get(v, f"$.{k}", "variant").isNotNull() for k in required]
    whole = own[0]
    for c in own[1:]:
        whole = whole & c
    return F.coalesce(F.filter(listed, lambda i: F.schema_of_variant(i).startswith("OBJECT")), F.when(whole, F.array(v)), F.array().cast("array<variant>"))


def partial_item(x: Column, keys: list[str]) -> Column:
    """Strings of keys found by pattern in output that doesn't parse, JSON escapes undone; null where a key isn't found."""
    told = {k: rf'"{k}"\s*:\s*"((?:[^"\\]|\\.)*+)"' for k in keys}
    found = [F.when(F.rlike(x, F.lit(p)), F.regexp_extract(x, p, 1)) for p in told.values()]
    return F.struct(*[F.try_variant_get(F.try_parse_json(F.concat(F.lit('"'), f, F.lit('"'))), "$", "string").alias(k) for f, k in zip(found, keys)])


def with_salvaged(df: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """`df` and the keys' strings and `how`: from the repaired value (`parsed`; the first of its items, if it has any), else
    from what patterns find (`partial`), else nulls (`lost`). Columns of those names are replaced."""
    told = with_repaired(df, text, "_v\u0001")
    first = F.coalesce(F.try_variant_get("_v\u0001", "$.items[0]", "variant"), F.col("_v\u0001"))
    told = told.withColumn("_first\u0001", first).withColumn("_p\u0001", partial_item(F.col(text), keys))
    told = told.withColumn("_f\u0001", F.struct(*[field(F.col("_first\u0001"), f"$.{k}").alias(k) for k in keys]))
    parsed, partial = F.col("_f\u0001"), F.col("_p\u0001")
    any_of = lambda s: F.coalesce(*[s[k] for k in keys]).isNotNull()
    how = F.when(any_of(parsed), "parsed").when(any_of(partial), "partial").otherwise("lost")
    told = told.withColumns({**{k: F.when(any_of(parsed), parsed[k]).otherwise(partial[k]) for k in keys}, "how": how})
    return told.drop("_v\u0001", "_first\u0001", "_p\u0001", "_f\u0001")


def batch_items(v: Column) -> Column:
    """struct(answers: map of id to response, error): the items of a batch's answer with an id and a response, both made plain;
    of equal ids the last. `missing_items_list` where there is no list of items. Batches are small by their making."""
    listed = F.try_variant_get(v, "$.items", "array<variant>")
    pairs = F.transform(listed, lambda i: F.struct(T.norm_ascii(F.try_variant_get(i, "$.id", "string")).alias("key"), T.norm_ascii(F.try_variant_get(i, "$.response", "string")).alias("value")))
    good = F.filter(pairs, lambda p: (p["key"] != "") & (p["value"] != ""))
    last = F.filter(good, lambda p, i: ~F.exists(F.slice(good, i + 2, F.greatest(F.size(good), F.lit(1))), lambda q: q["key"] == p["key"]))
    return F.struct(F.map_from_entries(last).alias("answers"), F.when(listed.isNull(), "missing_items_list").alias("error"))


def completion_text(v: Column) -> Column:
    """The text of a completion: message content as a string or in parts, choice text, or output_text."""
    parts = F.try_variant_get(v, "$.choices[0].message.content", "array<variant>")
    joined = F.array_join(F.filter(F.transform(parts, lambda p: F.coalesce(F.try_variant_get(p, "$.text", "string"), F.try_variant_get(p, "$", "string"))), lambda t: t != ""), "\n")
    plain = F.when(parts.isNull(), field(v, "$.choices[0].message.content"))
    tries = [plain, joined, field(v, "$.choices[0].text"), field(v, "$.output_text"), field(v, "$.candidates[0].content.parts[0].text")]
    return F.coalesce(*[F.nullif(F.trim(t), F.lit("")) for t in tries], F.lit(""))


# What a list's lines may begin with, and how a line begins that only introduces the list.
BULLETS = ["-", "*", "•", "◦", "▪", "●"]
LABELS = ["prompt", "question", "user"]
INTRODUCTIONS = ["sure", "here are", "below are", "these are"]


def _is_marker(token: Column) -> Column:
    """A bullet, a number or a single letter as an item's mark: 7  7.  (7)  7).  a)  (a)  a."""
    bare = F.regexp_replace(F.regexp_replace(token, r"^\(", ""), r"[.)]{1,2}$", "")
    closed = F.endswith(token, F.lit(")")) | F.endswith(token, F.lit("."))
    return token.isin(BULLETS) | F.rlike(bare, F.lit(r"^\p{Nd}+$")) | (closed & F.rlike(bare, F.lit("^[A-Za-z]$")))


def _introduces(line: Column) -> Column:
    """A folded line that opens a fence, names the format, or says that a list follows."""
    told = F.startswith(line, F.lit("```")) | (line == "json")
    for phrase in INTRODUCTIONS:
        after = F.substring(line, len(phrase) + 1, 1)
        told = told | (F.startswith(line, F.lit(phrase)) & ~F.rlike(after, F.lit(r"[\p{L}\p{N}_]")))
    return told


def _item(line: Column) -> Column:
    """A line without its mark or label: what follows the first white space if a mark stands before it, and what follows the
    first colon if a label does."""
    bare = F.regexp_replace(line, r"(?U)^\s+", "")
    first, rest = F.regexp_extract(bare, r"(?Us)^(\S+)\s", 1), F.regexp_extract(bare, r"(?Us)^\S+\s+(.*)$", 1)
    label, said = F.lower(T.norm(F.substring_index(bare, ":", 1))), F.regexp_extract(bare, r"(?s)^[^:]*:(.*)$", 1)
    return F.when((first != "") & _is_marker(first), rest).when(label.isin(LABELS) & F.rlike(said, F.lit(r"(?U)^\s")), said).otherwise(bare)


def listed_prompts(x: Column) -> Column:
    """The items of an answer written as a list, one a line: introductions and fences dropped, marks and labels taken off,
    white space made plain; of equal items (case aside) the first."""
    lines = F.filter(F.split(F.coalesce(x, F.lit("")), r"\r\n|\n|\r"), lambda s: ~_introduces(T.fold(s)))
    items = F.filter(F.transform(lines, lambda s: T.norm(_item(s))), lambda s: s != "")
    low = F.transform(items, F.lower)
    return F.filter(items, lambda s, i: F.array_position(low, F.lower(s)) == i + 1)


# ---- writing


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object a row, nulls kept. A task's output appears when it commits, so a row is written once."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_splits(split: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder per split."""
    split.write.mode(mode).partitionBy("split").option("ignoreNullFields", "false").json(path)


def write_ordered(df: DataFrame, path: str, *order: str) -> None:
    """JSON lines in order over all part files (a range sort, not one task)."""
    df.orderBy(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def head_prompts(spark: SparkSession, path: str | list[str], k: int = 5) -> DataFrame:
    """The first k prompts in file and line order (a top-k, not a sort of all)."""
    return read_pairs(spark, path).orderBy("file", "line_no", "pair_no").limit(k).select("prompt")
