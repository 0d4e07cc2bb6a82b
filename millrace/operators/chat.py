"""Dialogues: messages, flattening, validation, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.session import running_sum

_MARK = "\u0001"


def messages_of(prompt: Column, response: Column) -> Column:
    """The messages array (role, content) of a prompt of `User: `/`Assistant: ` lines and its response."""
    marked = F.replace(F.replace(F.concat(F.lit("\n"), F.coalesce(prompt, F.lit(""))), F.lit("\nUser: "), F.lit(_MARK + "user\n")), F.lit("\nAssistant: "), F.lit(_MARK + "assistant\n"))
    parts = F.filter(F.split(marked, _MARK), lambda x: F.rlike(x, F.lit("^(user|assistant)\\n")))
    said = F.transform(parts, lambda x: F.struct(F.substring_index(x, "\n", 1).alias("role"), F.regexp_replace(x, "^[a-z]+\\n", "").alias("content")))
    return F.concat(said, F.array(F.struct(F.lit("assistant").alias("role"), F.coalesce(response, F.lit("")).alias("content"))))


def spoken(messages: Column) -> Column:
    """User and assistant messages with content, normalised."""
    lines = F.transform(messages, lambda m: F.struct(F.lower(T.norm(m["role"])).alias("role"), T.norm(m["content"]).alias("content")))
    return F.filter(lines, lambda m: m["role"].isin("user", "assistant") & (m["content"] != ""))


def _line(m: Column) -> Column:
    return F.concat(F.when(m["role"] == "user", "User: ").otherwise("Assistant: "), m["content"])


def history_pairs(messages: Column) -> Column:
    """For each assistant message after the first user message: (prompt: all before it as one line, response).

    What precedes the first user message is no history. Everything stays within the record's own array."""
    start = F.array_position(F.transform(messages, lambda m: m["role"]), "user").cast("int")
    kept = F.when(start > 0, F.slice(messages, F.greatest(start, F.lit(1)), F.greatest(F.size(messages), F.lit(1))))
    pair = lambda m, i: F.when(
        m["role"] == "assistant",
        F.struct(T.norm(F.array_join(F.transform(F.slice(kept, 1, i), _line), "\n")).alias("prompt"), m["content"].alias("response")),
    )
    return F.coalesce(F.filter(F.transform(kept, pair), lambda x: x.isNotNull()), F.array().cast("array<struct<prompt:string,response:string>>"))


def turn_pairs(turns: DataFrame, conversation: str, place: str, window: int = 8, block: int = 1000) -> DataFrame:
    """conversation, turn, prompt (the last `window` messages as lines), response, for each assistant message.

    turns: one row per message with dense `place` from 1, role and content. A turn's number counts the assistant messages
    up to it. A conversation is cut into blocks of places, each with the messages before it that its frames need, and turns
    are counted per block, so one conversation of any length is many tasks' work."""
    turns = running_sum(turns, F.when(F.col("role") == "assistant", 1).otherwise(0), [conversation], place, "_turn", block)
    at = F.floor((F.col(place) - 1) / block)
    spread = F.array_distinct(F.array(at, F.floor((F.col(place) - 1 + window) / block)))
    placed = turns.withColumn("_own", at).withColumn("_block", F.explode(spread))
    w = Window.partitionBy(conversation, "_block").orderBy(place)
    lines = F.concat(F.when(F.col("role") == "user", "User: ").otherwise("Assistant: "), F.col("content"))
    told = placed.withColumn("_line", lines).withColumn("prompt", F.array_join(F.collect_list("_line").over(w.rowsBetween(-window, -1)), "\n"))
    answers = told.filter((F.col("_own") == F.col("_block")) & (F.col("role") == "assistant") & (F.col("prompt") != ""))
    return answers.select(conversation, F.col("_turn").cast("bigint").alias("turn"), "prompt", F.col("content").alias("response"))


def pair_records(pairs: DataFrame, conversation: str, task_type: str = "followup_clarification") -> DataFrame:
    """Turn pairs as records: id (conversation, `_t` and the turn of two digits or more), labels, and the language mode told
    from prompt and response together."""
    turn = F.col("turn").cast("string")
    number = F.when(F.col("turn") < 10, F.concat(F.lit("0"), turn)).otherwise(turn)
    return pairs.select(
        F.concat(F.col(conversation), F.lit("_t"), number).alias("id"), F.col(conversation).alias("conversation_id"), "turn", "prompt", "response",
        F.lit(task_type).alias("task_type"), F.lit("chat_multiturn").alias("content_type"), T.inferred_mode(F.concat("prompt", F.lit(" "), "response")).alias("lang_mode"),
    )


def messages_reason(messages: Column, least: int = 2, most: int = 8, ascii_only: bool = False) -> Column:
    """Why a dialogue is invalid, or `ok`: shape first, then the first offending message, judged in its order."""
    n = F.size(messages)
    judge = lambda m, i: F.when(m["role"] != F.when(i % 2 == 0, "user").otherwise("assistant"), "roles_not_alternating").when(
        F.char_length(m["content"]) < 2, "content_too_short"
    )
    per = F.transform(messages, lambda m, i: judge(m, i).when(T.has_non_ascii(m["content"]), "non_ascii_content") if ascii_only else judge(m, i))
    return (
        F.when(n == 0, "empty_messages")
        .when(F.get(messages, F.lit(0))["role"] != "user", "must_start_user")
        .when(F.element_at(messages, -1)["role"] != "assistant", "must_end_assistant")
        .when(n % 2 != 0, "messages_not_even")
        .when(n < 2 * least, "too_few_turns")
        .when(n > 2 * most, "too_many_turns")
        .otherwise(F.coalesce(F.get(F.filter(per, lambda x: x.isNotNull()), F.lit(0)), F.lit("ok")))
    )


def signature(messages: Column) -> Column:
    """The first two user messages and the first assistant message, as one line."""
    said = lambda role: F.transform(F.filter(messages, lambda m: m["role"] == role), lambda m: m["content"])
    return T.norm(F.array_join(F.concat(F.slice(said("user"), 1, 2), F.slice(said("assistant"), 1, 1)), " || "))


def conversation_id(messages: Column) -> Column:
    return F.concat(F.lit("ch_"), T.digest16(F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), m["content"])), " | ")))
