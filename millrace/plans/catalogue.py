"""Queries over the test tables, each with the SQL that says the same where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chat, clean, dedup, report, seed, teacher, tokens
from millrace.session import table
from millrace.sources import jsonl

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# ---- SQL pieces
_WS = r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def _n(x: str) -> str:
    return f"coalesce(trim(regexp_replace({x}, '{_WS}', ' ', 'g')), '')"


def _na(x: str) -> str:
    smart, plain = T.SMART, T.PLAIN.replace("'", "''")
    bare = rf"replace(regexp_replace({_n(x)}, '[\x{{200b}}-\x{{200d}}\x{{feff}}]', '', 'g'), '…', '...')"
    return _n(f"translate({bare}, '{smart}', '{plain}')")


def _list(ws: list[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in ws) + "]"


def _w(x: str) -> str:
    return f"list_transform(regexp_extract_all(coalesce({x}, ''), '[A-Za-z'']+'), lambda w: lower(w))"


def _wl(x: str) -> str:
    return f"regexp_extract_all(lower(coalesce({x}, '')), '[A-Za-z'']+')"


def _ws(x: str) -> str:
    return rf"list_distinct(list_transform(regexp_extract_all(coalesce({x}, ''), '[\p{{L}}\p{{N}}_'']+'), lambda w: lower(w)))"


def _share(ws: str, listed: list[str]) -> str:
    return f"(CASE WHEN len({ws}) > 0 THEN len(list_filter({ws}, lambda w: list_contains({_list(listed)}, w)))::DOUBLE / len({ws})::DOUBLE ELSE 0.0::DOUBLE END)"


def _hash(k: str) -> str:
    return f"(('0x' || substr(sha1({k}), 1, 8))::BIGINT::DOUBLE / 4294967295.0::DOUBLE)"


def _split(k: str) -> str:
    return f"CASE WHEN {_hash(k)} < 0.9::DOUBLE THEN 'train' WHEN {_hash(k)} < {0.9 + 0.05!r}::DOUBLE THEN 'val' ELSE 'test' END"


_MESSAGES = """list_concat(
  list_transform(list_filter(string_split(replace(replace(chr(10) || coalesce(prompt, ''), chr(10) || 'User: ', chr(1) || 'user' || chr(10)),
    chr(10) || 'Assistant: ', chr(1) || 'assistant' || chr(10)), chr(1)), lambda x: regexp_matches(x, '^(user|assistant)\\n')),
    lambda x: {'role': string_split(x, chr(10))[1], 'content': regexp_replace(x, '^[a-z]+\\n', '')}),
  [{'role': 'assistant', 'content': coalesce(response, '')}])"""
_SPOKEN = f"""list_filter(list_transform({_MESSAGES}, lambda m: {{'role': lower({_n("m.role")}), 'content': {_n("m.content")}}}),
  lambda m: m.role IN ('user', 'assistant') AND m.content <> '')"""
_M = f"(SELECT line_no, {_SPOKEN} AS ms FROM chat_seed_pairs)"


# ---- scalar functions


@query(f"""SELECT line_no, {_n("prompt")} AS norm, {_na("prompt")} AS plain, lower({_n("prompt")}) AS folded, length({_n("prompt")})::BIGINT AS n_chars,
  regexp_matches(coalesce(prompt, ''), '[^\\x00-\\x7F]') AS non_ascii, 'hy_' || substr(sha1({_n("prompt")}), 1, 16) AS made_id FROM prompt_seed_final""")
def text_normalize(spark: SparkSession, d: str) -> DataFrame:
    """Normalised, plain and folded texts, their length and id."""
    x = F.col("prompt")
    return table(spark, d, "prompt_seed_final").select(
        "line_no", T.norm(x).alias("norm"), T.norm_ascii(x).alias("plain"), T.fold(x).alias("folded"), F.char_length(T.norm(x)).cast("bigint").alias("n_chars"),
        T.has_non_ascii(x).alias("non_ascii"), T.prompt_id("hy_", T.norm(x)).alias("made_id"),
    )


@query(f"""SELECT line_no, len({_w("response")})::BIGINT AS n_words, len({_ws("response")})::BIGINT AS n_set,
  len(list_filter(string_split(lower({_n("response")}), ' '), lambda w: w <> ''))::BIGINT AS n_space,
  (CASE WHEN len({_w("response")}) > 0 THEN len(list_distinct({_w("response")}))::DOUBLE / len({_w("response")})::DOUBLE ELSE 0.0::DOUBLE END) AS unique_ratio,
  {_share(_w("response"), T.ENGLISH)} AS english, {_share(_wl("response"), T.MARKERS)} AS markers FROM generated_raw""")
def word_stats(spark: SparkSession, d: str) -> DataFrame:
    """Word counts and ratios of responses."""
    x, ws = F.col("response"), F.col("ws")
    return table(spark, d, "generated_raw").select("line_no", "response", T.words(x).alias("ws")).select(
        "line_no", F.size(ws).cast("bigint").alias("n_words"), F.size(T.word_set(x)).cast("bigint").alias("n_set"), F.size(T.space_words(x)).cast("bigint").alias("n_space"),
        T.unique_ratio(ws).alias("unique_ratio"), T.english_share(ws).alias("english"), T.marker_share(x).alias("markers"),
    )


@query(f"""WITH w AS (SELECT line_no, unnest({_w("response")}) AS w, unnest(range(len({_w("response")}))) AS i FROM generated_raw),
  g AS (SELECT line_no, w, i - row_number() OVER (PARTITION BY line_no, w ORDER BY i) AS isle FROM w),
  r AS (SELECT line_no, count(*) AS n FROM g GROUP BY line_no, w, isle)
  SELECT g.line_no, coalesce(max(r.n), 0)::BIGINT AS longest FROM generated_raw g LEFT JOIN r ON g.line_no = r.line_no GROUP BY g.line_no""")
def max_word_run(spark: SparkSession, d: str) -> DataFrame:
    """The longest run of one word."""
    return table(spark, d, "generated_raw").select("line_no", T.longest_run(T.words(F.col("response"))).cast("bigint").alias("longest"))


@query(f"""SELECT line_no, CASE WHEN len({_wl("response")}) > 0 AND {_share(_wl("response"), T.MIXING)} >= 0.12::DOUBLE THEN 'rw_mixed' ELSE 'rw' END AS mode FROM chat_seed_pairs""")
def infer_lang_mode(spark: SparkSession, d: str) -> DataFrame:
    """Language mode by English words."""
    return table(spark, d, "chat_seed_pairs").select("line_no", T.inferred_mode(F.col("response")).alias("mode"))


# ---- cleaning


_RUN = f"""(WITH w AS (SELECT line_no, unnest({_w("response")}) AS w, unnest(range(len({_w("response")}))) AS i FROM generated_raw),
  g AS (SELECT line_no, w, i - row_number() OVER (PARTITION BY line_no, w ORDER BY i) AS isle FROM w)
  SELECT line_no, max(n) AS longest FROM (SELECT line_no, count(*) AS n FROM g GROUP BY line_no, w, isle) GROUP BY line_no)"""
_REASON = f"""SELECT s.line_no, p, r, CASE WHEN p = '' THEN 'empty_prompt' WHEN r = '' THEN 'empty_response' WHEN length(p) < 6 THEN 'prompt_too_short'
  WHEN length(r) < 24 THEN 'response_too_short' WHEN length(r) > 6000 THEN 'response_too_long'
  WHEN contains(r, 'User:') OR contains(r, 'Assistant:') THEN 'role_prefix_leakage' WHEN len(ws) = 0 THEN 'response_no_words'
  WHEN longest > 12 THEN 'response_word_repetition' WHEN len(list_distinct(ws))::DOUBLE / len(ws)::DOUBLE < 0.12::DOUBLE THEN 'response_low_unique_ratio'
  WHEN mode IN ('rw', 'control') AND {_share("ws", T.ENGLISH)} > 0.45::DOUBLE THEN 'response_too_english_for_rw' ELSE 'ok' END AS reason
  FROM (SELECT line_no, {_n("prompt")} AS p, {_n("response")} AS r, {_w("response")} AS ws, lower({_n("lang_mode")}) AS mode FROM generated_raw) s
  LEFT JOIN {_RUN} m ON s.line_no = m.line_no"""
_TOLD = f"""SELECT line_no, CASE WHEN reason = 'ok' AND row_number() OVER (PARTITION BY reason = 'ok', lower(p), lower(r) ORDER BY line_no) > 1
  THEN 'duplicate_prompt_response' ELSE reason END AS reason FROM ({_REASON})"""


@query(f"SELECT line_no, reason FROM ({_TOLD})")
def clean_decisions(spark: SparkSession, d: str) -> DataFrame:
    """The first reason against each generated record, duplicates among the good ones included."""
    return clean.with_clean_reason(table(spark, d, "generated_raw"), "line_no").select("line_no", "reason")


@query(f"SELECT reason, count(*) AS n FROM ({_TOLD}) GROUP BY reason")
def clean_reason_counts(spark: SparkSession, d: str) -> DataFrame:
    return clean.reason_counts(clean_decisions(spark, d))


@query(f"SELECT line_no, p AS prompt, r AS response FROM ({_REASON}) WHERE line_no IN (SELECT line_no FROM ({_TOLD}) WHERE reason = 'ok')")
def cleaned_records(spark: SparkSession, d: str) -> DataFrame:
    """Kept pairs, normalised."""
    return clean.cleaned(table(spark, d, "generated_raw"), "line_no").select("line_no", "prompt", "response")


@query(f"SELECT t.line_no, t.reason, g.id FROM ({_TOLD}) t JOIN generated_raw g USING (line_no) WHERE t.reason <> 'ok'")
def reject_records(spark: SparkSession, d: str) -> DataFrame:
    """Rejects with the id read back from their record."""
    told = clean.rejects(table(spark, d, "generated_raw"), "line_no")
    return told.select("line_no", "reason", F.get_json_object("record", "$.id").alias("id"))


@query(f"SELECT min(line_no) AS line_no FROM prompt_seed_final GROUP BY lower({_n('prompt')})")
def exact_dedup_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return clean.keep_first(table(spark, d, "prompt_seed_final"), T.fold(F.col("prompt")), "line_no").select("line_no")


_FITS = " OR ".join(f"(t = '{t}' AND m IN ({', '.join(repr(x) for x in ms)}))" for t, ms in seed.COMPATIBLE.items())


@query(f"""SELECT line_no, CASE WHEN p = '' THEN 'empty_prompt' WHEN length(p) < 10 THEN 'prompt_too_short' WHEN length(p) > 260 THEN 'prompt_too_long'
  WHEN NOT list_contains({_list(list(seed.COMPATIBLE))}, t) THEN 'invalid_task_type' WHEN NOT list_contains({_list(seed.MODES)}, m) THEN 'invalid_lang_mode'
  WHEN NOT ({_FITS}) THEN 'task_lang_mode_mismatch' ELSE 'ok' END AS reason
  FROM (SELECT line_no, {_na("prompt")} AS p, {_n("task_type")} AS t, {_n("lang_mode")} AS m FROM prompt_seed_final)""")
def seed_validation(spark: SparkSession, d: str) -> DataFrame:
    """Length, enumeration and compatibility checks of seed prompts."""
    return table(spark, d, "prompt_seed_final").select("line_no", seed.item_reason(F.col("prompt"), F.col("task_type"), F.col("lang_mode")).alias("reason"))


_SCORED = ["prompt", "task_type", "lang_mode", "topic", "source", "teacher_model"]
_FILLED = " + ".join(f"(CASE WHEN {_n(c)} <> '' THEN 1 ELSE 0 END)" for c in _SCORED)
_BEST = f"""SELECT * FROM prompt_seed_final WHERE {_n("prompt")} <> '' QUALIFY row_number() OVER (PARTITION BY lower({_n("prompt")})
  ORDER BY {_FILLED} DESC, coalesce(created_at, '') DESC, line_no) = 1"""


def _best(spark: SparkSession, d: str) -> DataFrame:
    return clean.best_record(table(spark, d, "prompt_seed_final"), T.fold(F.col("prompt")), _SCORED, "created_at", ["line_no"])


@query(f"SELECT line_no, id, created_at FROM ({_BEST})")
def merge_best_record(spark: SparkSession, d: str) -> DataFrame:
    """Of each prompt the fullest, then newest, then first record."""
    return _best(spark, d).select("line_no", "id", "created_at")


@query(f"SELECT source, count(*) AS n FROM ({_BEST}) GROUP BY source")
def merge_lineage_counts(spark: SparkSession, d: str) -> DataFrame:
    """How many kept records came from each source."""
    return _best(spark, d).groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT array_to_string(ws[1:4], ' ') AS prefix, count(*) AS n FROM (SELECT place, list_filter(string_split(lower({_n("prompt")}), ' '), lambda w: w <> '') AS ws
  FROM (SELECT prompt, row_number() OVER (ORDER BY created_at DESC NULLS LAST, line_no) AS place FROM prompt_seed_final) WHERE place <= 5000) WHERE len(ws) >= 2 GROUP BY 1 HAVING count(*) >= 2 ORDER BY n DESC, min(place) LIMIT 50""")
def frequent_prefixes(spark: SparkSession, d: str) -> DataFrame:
    return clean.frequent_prefixes(table(spark, d, "prompt_seed_final"), "prompt", "created_at", "line_no")


@query("SELECT line_no, id FROM prompt_seed_final ORDER BY created_at DESC NULLS LAST, line_no LIMIT 400")
def recent_topk(spark: SparkSession, d: str) -> DataFrame:
    return clean.recent(table(spark, d, "prompt_seed_final"), "created_at", "line_no", 400).select("line_no", "id")


@query("SELECT topic, line_no FROM prompt_seed_final QUALIFY row_number() OVER (PARTITION BY topic ORDER BY created_at DESC NULLS LAST, line_no) <= 20")
def recent_topk_by_topic(spark: SparkSession, d: str) -> DataFrame:
    return clean.recent_by(table(spark, d, "prompt_seed_final"), "topic", "created_at", "line_no", 20).select("topic", "line_no")


_MEMORY = "SELECT prompt, line_no, {p} AS pri FROM (SELECT * FROM prompt_seed_final {w} ORDER BY created_at DESC NULLS LAST, line_no LIMIT {k})"


@query(f"""SELECT line_no, pri FROM ({_MEMORY.format(p=0, w="WHERE topic = 'ikoranabuhanga'", k=20)} UNION ALL {_MEMORY.format(p=1, w="", k=60)})
  QUALIFY row_number() OVER (PARTITION BY lower({_n("prompt")}) ORDER BY pri, line_no) = 1""")
def avoid_memory(spark: SparkSession, d: str) -> DataFrame:
    """The newest prompts of a topic, then of all, without repeats (at most 80 rows)."""
    seeds = table(spark, d, "prompt_seed_final")
    parts = [clean.recent(seeds, "created_at", "line_no", k, t).select("prompt", "line_no", F.lit(p).alias("pri")) for p, (k, t) in enumerate([(20, "ikoranabuhanga"), (60, None)])]
    w = Window.partitionBy(T.fold(F.col("prompt"))).orderBy("pri", "line_no")
    return parts[0].unionByName(parts[1]).withColumn("place", F.row_number().over(w)).filter("place = 1").select("line_no", "pri")


# ---- dialogues


def _spoken(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_seed_pairs").select("line_no", chat.spoken(chat.messages_of(F.col("prompt"), F.col("response"))).alias("ms"))


def _turns(spark: SparkSession, d: str) -> DataFrame:
    """Messages of conversations with dense places, from each turn's last user message and response (first record of an id)."""
    rows = table(spark, d, "chat_seed_pairs").filter("id IS NOT NULL").select("id", "line_no", "prompt", "response")
    one = rows.groupBy("id").agg(F.min_by(F.struct("prompt", "response"), "line_no").alias("r")).select("id", "r.*")
    turn = F.regexp_extract("id", r"_t(\d+)$", 1).cast("bigint")
    said = F.element_at(F.split(F.concat(F.lit("\n"), F.coalesce("prompt", F.lit(""))), "\nUser: "), -1)
    two = F.array(F.struct((turn * 2 - 1).alias("place"), F.lit("user").alias("role"), said.alias("content")), F.struct((turn * 2).alias("place"), F.lit("assistant").alias("role"), F.coalesce("response", F.lit("")).alias("content")))
    return one.select(F.substring("id", 1, 19).alias("conv"), F.inline(two))


_TURNS_SQL = """(SELECT substr(id, 1, 19) AS conv, regexp_extract(id, '_t(\\d+)$', 1)::BIGINT AS turn, list_extract(string_split(chr(10) || coalesce(prompt, ''), chr(10) || 'User: '), -1) AS said,
  coalesce(response, '') AS response FROM chat_seed_pairs WHERE id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY line_no) = 1)"""


@query(f"""SELECT conv, turn, md5(prompt) AS prompt_md5, length(prompt)::BIGINT AS n_chars, md5(response) AS response_md5 FROM (
  SELECT conv, place // 2 AS turn, role, content AS response, string_agg(line, chr(10)) OVER (PARTITION BY conv ORDER BY place ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS prompt FROM (
    SELECT conv, turn * 2 - 1 AS place, 'user' AS role, said AS content, 'User: ' || said AS line FROM {_TURNS_SQL}
    UNION ALL SELECT conv, turn * 2, 'assistant', response, 'Assistant: ' || response FROM {_TURNS_SQL}))
  WHERE role = 'assistant' AND prompt <> ''""")
def chat_turns_window8(spark: SparkSession, d: str) -> DataFrame:
    """Conversations flattened to pairs whose prompt holds the last eight messages."""
    pairs = chat.turn_pairs(_turns(spark, d), "conv", "place")
    return pairs.select("conv", "turn", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"), F.char_length("prompt").cast("bigint").alias("n_chars"), F.md5(F.col("response").cast("binary")).alias("response_md5"))


@query(f"""SELECT conv || '_t' || CASE WHEN turn < 10 THEN '0' ELSE '' END || turn AS id, turn, 'chat_multiturn' AS content_type, 'followup_clarification' AS task_type,
  CASE WHEN len({_wl("prompt || ' ' || response")}) > 0 AND {_share(_wl("prompt || ' ' || response"), T.MIXING)} >= 0.12::DOUBLE THEN 'rw_mixed' ELSE 'rw' END AS lang_mode FROM (
  SELECT conv, sum((role = 'assistant')::INT) OVER (PARTITION BY conv ORDER BY place)::BIGINT AS turn, role, content AS response,
    string_agg(line, chr(10)) OVER (PARTITION BY conv ORDER BY place ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS prompt FROM (
    SELECT conv, turn * 2 - 1 AS place, 'user' AS role, said AS content, 'User: ' || said AS line FROM {_TURNS_SQL}
    UNION ALL SELECT conv, turn * 2, 'assistant', response, 'Assistant: ' || response FROM {_TURNS_SQL})) WHERE role = 'assistant' AND prompt <> ''""")
def chat_turn_records(spark: SparkSession, d: str) -> DataFrame:
    """Turn pairs as records with their ids, labels and language mode."""
    return chat.pair_records(chat.turn_pairs(_turns(spark, d), "conv", "place"), "conv").select("id", "turn", "content_type", "task_type", "lang_mode")


@query(f"""WITH m AS (SELECT line_no, list_slice(ms, list_position(list_transform(ms, lambda m: m.role), 'user'), len(ms)) AS ms FROM {_M} WHERE list_contains(list_transform(ms, lambda m: m.role), 'user')),
  x AS (SELECT line_no, ms, unnest(range(1, len(ms) + 1)) AS i FROM m)
  SELECT line_no, (i - 1)::BIGINT AS place, md5({_n("array_to_string(list_transform(ms[1:i-1], lambda m: CASE WHEN m.role = 'user' THEN 'User: ' ELSE 'Assistant: ' END || m.content), chr(10))")}) AS prompt_md5,
  md5(ms[i].content) AS response_md5 FROM x WHERE ms[i].role = 'assistant' AND i > 1""")
def chat_pairs_unbounded(spark: SparkSession, d: str) -> DataFrame:
    """All (history, response) pairs of each record's messages."""
    ms = _spoken(spark, d)
    start = F.array_position(F.transform("ms", lambda m: m["role"]), "user").cast("int")
    kept = F.when(start > 0, F.slice("ms", F.greatest(start, F.lit(1)), F.greatest(F.size("ms"), F.lit(1))))
    places = F.filter(F.transform(kept, lambda m, i: F.when(m["role"] == "assistant", i)), lambda x: x.isNotNull())
    zipped = ms.select("line_no", F.inline(F.arrays_zip(places.alias("place"), chat.history_pairs(F.col("ms")).alias("pair"))))
    return zipped.select("line_no", F.col("place").cast("bigint").alias("place"), F.md5(F.col("pair.prompt").cast("binary")).alias("prompt_md5"), F.md5(F.col("pair.response").cast("binary")).alias("response_md5"))


@query(f"""SELECT line_no, CASE WHEN len(ms) = 0 THEN 'empty_messages' WHEN ms[1].role <> 'user' THEN 'must_start_user' WHEN ms[-1].role <> 'assistant' THEN 'must_end_assistant'
  WHEN len(ms) % 2 <> 0 THEN 'messages_not_even' WHEN len(ms) < 4 THEN 'too_few_turns' WHEN len(ms) > 16 THEN 'too_many_turns'
  ELSE coalesce(list_filter(list_transform(range(1, len(ms) + 1), lambda i: CASE WHEN ms[i].role <> (CASE WHEN i % 2 = 1 THEN 'user' ELSE 'assistant' END) THEN 'roles_not_alternating'
    WHEN length(ms[i].content) < 2 THEN 'content_too_short' WHEN regexp_matches(ms[i].content, '[^\\x00-\\x7F]') THEN 'non_ascii_content' END), lambda x: x IS NOT NULL)[1], 'ok') END AS reason FROM {_M}""")
def conversation_validation(spark: SparkSession, d: str) -> DataFrame:
    return _spoken(spark, d).select("line_no", chat.messages_reason(F.col("ms"), ascii_only=True).alias("reason"))


@query(f"""SELECT line_no, {_n("array_to_string(list_concat(list_transform(list_filter(ms, lambda m: m.role = 'user')[1:2], lambda m: m.content), list_transform(list_filter(ms, lambda m: m.role = 'assistant')[1:1], lambda m: m.content)), ' || ')")} AS signature FROM {_M}""")
def conversation_signature(spark: SparkSession, d: str) -> DataFrame:
    return _spoken(spark, d).select("line_no", chat.signature(F.col("ms")).alias("signature"))


@query(f"SELECT line_no, 'ch_' || substr(sha1(array_to_string(list_transform(ms, lambda m: m.role || ':' || m.content), ' | ')), 1, 16) AS made_id FROM {_M}")
def conversation_id(spark: SparkSession, d: str) -> DataFrame:
    return _spoken(spark, d).select("line_no", chat.conversation_id(F.col("ms")).alias("made_id"))


# ---- splits and reports

_KEY = f"coalesce(CASE WHEN {_n('conversation_id')} <> '' THEN 'conversation:' || {_n('conversation_id')} END, nullif({_n('id')}, ''), nullif({_na('prompt')}, ''))"


@query(f"SELECT line_no, {_split(_KEY)} AS split FROM chat_seed_pairs")
def hash_split(spark: SparkSession, d: str) -> DataFrame:
    return report.with_split(table(spark, d, "chat_seed_pairs")).select("line_no", "split")


@query(f"SELECT {_split(_KEY)} AS split, count(*) AS n FROM chat_seed_pairs GROUP BY 1")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    return report.split_counts(hash_split(spark, d))


def _known(*cs: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({_n(c)}, '')" for c in cs) + ", 'unknown')"


_MIX = f"""(WITH t AS (SELECT {_known("content_type", "task_type")} AS c, {_known("lang_mode")} AS l, {_known("topic")} AS t FROM prompt_seed_final),
  u AS (SELECT 'content_type' AS dim, c AS value, count(*) AS n FROM t GROUP BY c UNION ALL SELECT 'lang_mode', l, count(*) FROM t GROUP BY l
    UNION ALL SELECT 'topic', t, count(*) FROM t GROUP BY t UNION ALL SELECT 'all', '', count(*) FROM t)
  SELECT dim, value, n, n::DOUBLE / (SELECT count(*) FROM t)::DOUBLE AS ratio FROM u)"""


@query(f"SELECT dim, value, n, ratio FROM {_MIX}")
def content_mix(spark: SparkSession, d: str) -> DataFrame:
    return report.content_mix(table(spark, d, "prompt_seed_final"))


# Least shares of a content plan.
PLAN = {
    "content_type": {
        "rw_instruction": 0.2, "chat_multiturn": 0.2, "followup_clarification": 0.08, "transformation": 0.07, "safety_refusal": 0.06, "structured_output": 0.04,
        "noisy_input_robustness": 0.06, "code_switch_instruction": 0.07, "multilingual_retention": 0.03, "language_control": 0.02, "open_domain_chat": 0.03,
    },
    "lang_mode": {"rw": 0.45, "rw_mixed": 0.12, "en": 0.03, "fr": 0.02, "sw": 0.01, "control": 0.02},
}
_PLAN_ROWS = [(dim, v, x) for dim, least in PLAN.items() for v, x in least.items()]


@query(f"""SELECT p.dim, p.value, coalesce(m.ratio, 0.0::DOUBLE) AS ratio, p.least FROM (VALUES {", ".join(f"('{a}', '{b}', {x}::DOUBLE)" for a, b, x in _PLAN_ROWS)}) AS p(dim, value, least)
  LEFT JOIN {_MIX} m ON p.dim = m.dim AND p.value = m.value WHERE coalesce(m.ratio, 0.0::DOUBLE) < p.least""")
def mix_failures(spark: SparkSession, d: str) -> DataFrame:
    return report.mix_failures(content_mix(spark, d), spark.createDataFrame(_PLAN_ROWS, "dim string, value string, least double"))


@query("SELECT topic, count(*) AS n FROM prompt_seed_final GROUP BY topic ORDER BY n DESC, min(line_no) LIMIT 1")
def top_topic(spark: SparkSession, d: str) -> DataFrame:
    return report.top_value(table(spark, d, "prompt_seed_final"), "topic", "line_no")


_SFT = "(SELECT 'train' AS split, * FROM sft_train UNION ALL SELECT 'val', * FROM sft_val UNION ALL SELECT 'test', * FROM sft_test)"
_OK = f"{_n('prompt')} <> '' AND {_n('response')} <> ''"
_SUMMARY = f"""SELECT split, count(*) AS n_rows, count(*) FILTER ({_OK}) AS valid_rows, count(*) FILTER (NOT ({_OK})) AS invalid_rows,
  coalesce(sum(length({_n("prompt")})) FILTER ({_OK})::DOUBLE / nullif(count(*) FILTER ({_OK}), 0)::DOUBLE, 0.0::DOUBLE) AS avg_prompt_chars,
  coalesce(sum(length({_n("response")})) FILTER ({_OK})::DOUBLE / nullif(count(*) FILTER ({_OK}), 0)::DOUBLE, 0.0::DOUBLE) AS avg_response_chars FROM {_SFT} GROUP BY split"""


def _sft(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, f"sft_{s}").withColumn("split", F.lit(s)) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(_SUMMARY)
def split_summaries(spark: SparkSession, d: str) -> DataFrame:
    return report.summary(_sft(spark, d), ["split"])


@query(f"SELECT 'too_few_valid_rows:' || split || ':' || valid_rows AS failure FROM ({_SUMMARY}) WHERE valid_rows < 100")
def preflight_failures(spark: SparkSession, d: str) -> DataFrame:
    return report.preflight(split_summaries(spark, d), "split")


@query(f"""SELECT split, ceil(valid_rows / 32.0)::BIGINT * 3 AS steps, floor((ceil(valid_rows / 32.0)::BIGINT * 3) * 0.03::DOUBLE)::BIGINT AS warm_up FROM ({_SUMMARY})""")
def training_steps(spark: SparkSession, d: str) -> DataFrame:
    total, warm = tokens.steps(F.col("valid_rows"), 8, 4, 3)
    return split_summaries(spark, d).select("split", total.alias("steps"), warm.alias("warm_up"))


_DRIFT = f"SELECT split, sum(round({_share(_wl('response'), T.ENGLISH)} * 1000000)::BIGINT)::BIGINT AS english, sum(round({_share(_wl('response'), T.MARKERS)} * 1000000)::BIGINT)::BIGINT AS markers, count(*) AS n FROM {_SFT} GROUP BY split"


def _metrics(spark: SparkSession, d: str) -> DataFrame:
    """Per split, millionths of English drift and marker density, summed as whole numbers (the same in any order)."""
    x = T.words_of_lower(F.col("response"))
    part = lambda c: F.sum(F.round(c * 1000000).cast("bigint"))
    return _sft(spark, d).groupBy("split").agg(part(T.share_of(x, T.ENGLISH)).alias("english"), part(T.share_of(x, T.MARKERS)).alias("markers"), F.count(F.lit(1)).alias("n"))


@query(_DRIFT)
def generation_metrics(spark: SparkSession, d: str) -> DataFrame:
    return _metrics(spark, d)


_DELTA = f"""(SELECT exp(least(1.5::DOUBLE, 20)) - exp(least(1.75::DOUBLE, 20)) AS val_ppl_delta, 0.25::DOUBLE AS test_ppl_delta,
  (max(english) FILTER (split = 'test') - max(english) FILTER (split = 'train'))::DOUBLE / 1000000.0::DOUBLE AS english_drift_delta,
  (max(markers) FILTER (split = 'test') - max(markers) FILTER (split = 'train'))::DOUBLE / 1000000.0::DOUBLE AS rw_marker_density_delta FROM ({_DRIFT}))"""


@query(f"""SELECT len(r) = 0 AS passed, array_to_string(r, ';') AS reasons FROM (SELECT list_filter([
  CASE WHEN NOT val_ppl_delta < 0 THEN 'val_ppl_not_improved:' || printf('%+.6f', val_ppl_delta) END, CASE WHEN NOT test_ppl_delta < 0 THEN 'test_ppl_not_improved:' || printf('%+.6f', test_ppl_delta) END,
  CASE WHEN english_drift_delta > 0 THEN 'english_drift_delta_too_high:' || printf('%+.6f', english_drift_delta) || '>+0.000000' END,
  CASE WHEN rw_marker_density_delta < 0 THEN 'rw_marker_density_too_low:' || printf('%+.6f', rw_marker_density_delta) || '<+0.000000' END], lambda x: x IS NOT NULL) AS r FROM {_DELTA})""")
def metric_delta_gate(spark: SparkSession, d: str) -> DataFrame:
    """A gate over differences of metrics."""
    of = lambda c, s: F.max(F.when(F.col("split") == s, F.col(c)))
    delta = _metrics(spark, d).agg(
        (T.perplexity(F.lit(1.5)) - T.perplexity(F.lit(1.75))).alias("val_ppl_delta"), F.lit(0.25).alias("test_ppl_delta"),
        ((of("english", "test") - of("english", "train")).cast("double") / 1000000.0).alias("english_drift_delta"),
        ((of("markers", "test") - of("markers", "train")).cast("double") / 1000000.0).alias("rw_marker_density_delta"),
    )
    return report.gate(delta)


# ---- joins

_ANSWERED = f"(SELECT DISTINCT {_na('id')} AS id FROM generated_raw WHERE {_na('id')} <> '' AND {_na('response')} <> '')"


@query(f"SELECT line_no FROM prompt_seed_final WHERE id NOT IN (SELECT id FROM {_ANSWERED})")
def unanswered_anti(spark: SparkSession, d: str) -> DataFrame:
    """Requests without a response."""
    return table(spark, d, "prompt_seed_final").join(teacher.answered_ids(table(spark, d, "generated_raw")), "id", "left_anti").select("line_no")


@query(f"SELECT line_no FROM prompt_seed_final WHERE id IN (SELECT id FROM {_ANSWERED})")
def answered_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_seed_final").join(teacher.answered_ids(table(spark, d, "generated_raw")), "id", "left_semi").select("line_no")


@query("""SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'extra' WHEN b.g THEN 'succeeded' ELSE 'failed' END AS outcome
  FROM (SELECT DISTINCT id FROM prompt_seed_final) a FULL JOIN (SELECT id, max(coalesce(trim(response), '') <> '') AS g FROM generated_raw GROUP BY id) b ON a.id = b.id""")
def batch_partition(spark: SparkSession, d: str) -> DataFrame:
    """Requests and responses matched: succeeded, failed, extra."""
    return teacher.match_responses(table(spark, d, "prompt_seed_final"), table(spark, d, "generated_raw"))


@query("""SELECT DISTINCT trim(category) AS topic, t.kind, trim(category) || ' - ' || t.kind AS prompt, 'rw_' || substr(sha1(trim(category) || ' - ' || t.kind), 1, 16) AS id
  FROM mix_target, (VALUES ('Sobanura'), ('Tanga inama'), ('Ni gute')) AS t(kind) WHERE dim_name = 'topic'""")
def template_crossjoin(spark: SparkSession, d: str) -> DataFrame:
    """Topics by templates (both small), with ids."""
    topics = table(spark, d, "mix_target").filter("dim_name = 'topic'").select(F.trim("category").alias("topic")).distinct()
    kinds = spark.createDataFrame([("Sobanura",), ("Tanga inama",), ("Ni gute",)], "kind string")
    made = topics.crossJoin(F.broadcast(kinds)).withColumn("prompt", F.concat("topic", F.lit(" - "), "kind"))  # three templates
    return made.withColumn("id", T.prompt_id("rw_", F.col("prompt")))


# ---- near-duplicates

_CLASSES = f"""c AS (SELECT min(line_no) AS rep, ws FROM (SELECT line_no, list_sort({_ws("prompt")}) AS ws FROM sft_train) WHERE len(ws) > 0 GROUP BY ws)"""


@query(f"""WITH {_CLASSES}, w AS (SELECT rep, len(ws) AS n, unnest(ws) AS w FROM c), i AS (SELECT a.rep AS x, b.rep AS y, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM w a JOIN w b ON a.w = b.w AND a.rep < b.rep GROUP BY a.rep, b.rep) SELECT x AS "left", y AS "right", k::DOUBLE / (na + nb - k)::DOUBLE AS similarity FROM i WHERE k >= 0.7::DOUBLE * (na + nb - k) - 1e-9""")
def near_dup_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of class representatives of training prompts that share seven tenths of their words."""
    return dedup.near_duplicates(table(spark, d, "sft_train"), "line_no", "prompt", 0.7)[1].select("left", "right", "similarity")


@query(f"""SELECT line_no, min(line_no) OVER (PARTITION BY ws) AS class FROM (SELECT line_no, list_sort({_ws("prompt")}) AS ws FROM sft_train) WHERE len(ws) > 0""")
def near_dup_members(spark: SparkSession, d: str) -> DataFrame:
    """Each prompt's class of equal word sets."""
    return dedup.near_duplicates(table(spark, d, "sft_train"), "line_no", "prompt")[0].select(F.col("key").alias("line_no"), "class")


@query(f"""WITH RECURSIVE r AS (SELECT line_no, row_number() OVER (ORDER BY line_no) AS i, {_n("topic")} AS topic, lower({_n("prompt")}) AS f, {_ws("prompt")} AS ws FROM prompt_seed_final),
  w AS (SELECT i, len(ws) AS n, unnest(ws) AS w FROM r),
  p AS (SELECT a.i AS x, b.i AS y FROM w a JOIN w b ON a.w = b.w AND b.i < a.i GROUP BY a.i, b.i, a.n, b.n HAVING count(*) >= 0.9::DOUBLE * (a.n + b.n - count(*)) - 1e-9),
  s AS MATERIALIZED (SELECT r.i, r.topic, r.f, r.line_no, coalesce(list(p.y ORDER BY p.y) FILTER (p.y IS NOT NULL), []) AS ys, coalesce(list(p.y ORDER BY p.y) FILTER (o.topic = r.topic AND r.topic <> ''), []) AS ts
    FROM r LEFT JOIN p ON p.x = r.i LEFT JOIN r o ON o.i = p.y GROUP BY r.i, r.topic, r.f, r.line_no),
  t AS (SELECT 0::BIGINT AS i, NULL::BIGINT AS line_no, []::STRUCT(i BIGINT, t VARCHAR, f VARCHAR)[] AS acc, NULL::BIGINT AS m, NULL::VARCHAR AS status
    UNION ALL
    SELECT i, line_no, CASE WHEN st = 'accepted' THEN list_append(acc, {{'i': i, 't': topic, 'f': f}}) ELSE acc END, m, st FROM (
      SELECT *, CASE WHEN m IS NOT NULL THEN 'near_duplicate' WHEN len(list_filter(acc, lambda a: a.f = f)) > 0 THEN 'duplicate' ELSE 'accepted' END AS st FROM (
        SELECT s.i, s.line_no, s.topic, s.f, t.acc, coalesce(
          list_max(list_filter(s.ts, lambda y: len(list_filter(t.acc, lambda a: a.i = y)) > 0 AND len(list_filter(t.acc, lambda a: a.i > y AND a.t = s.topic)) < 200)),
          list_max(list_filter(s.ys, lambda y: len(list_filter(t.acc, lambda a: a.i = y)) > 0 AND len(list_filter(t.acc, lambda a: a.i > y)) < 400))) AS m
        FROM t JOIN s ON s.i = t.i + 1)))
  SELECT t.line_no, t.status, r.line_no AS "match" FROM t LEFT JOIN r ON r.i = t.m WHERE t.i > 0""")
def near_dup_greedy(spark: SparkSession, d: str) -> DataFrame:
    """Acceptance in order against the last 400 accepted prompts and the last 200 of the topic."""
    return dedup.sequential_accept(table(spark, d, "prompt_seed_final"), "line_no", "prompt", "topic")


_CAND = f"SELECT prompt, {_n('topic')} AS topic, {_ws('prompt')} AS ws, row_number() OVER (ORDER BY created_at DESC NULLS LAST, line_no) AS g FROM sft_train"


@query(f"""WITH c AS ({_CAND}), h AS (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY g) AS n FROM c WHERE topic <> ''),
  v AS (SELECT line_no, {_n("topic")} AS topic, {_ws("prompt")} AS mine FROM {_SFT} WHERE split <> 'train'),
  j AS (SELECT v.line_no, v.mine, h.prompt, h.ws, 0 AS part, h.n AS place FROM v JOIN h ON h.topic = v.topic AND h.n <= 200 UNION ALL SELECT v.line_no, v.mine, c.prompt, c.ws, 1, c.g FROM v JOIN c ON c.g <= 400),
  n AS (SELECT *, len(list_intersect(mine, ws)) AS k FROM j WHERE len(mine) > 0 AND len(ws) > 0),
  x AS (SELECT *, k::DOUBLE / (len(mine) + len(ws) - k)::DOUBLE AS score FROM n),
  b AS (SELECT line_no, arg_min(prompt, part * 1000 + place) FILTER (score >= 0.6::DOUBLE) AS hit, arg_min(prompt, {{'s': -score, 'p': part * 1000 + place}}) FILTER (score > 0) AS best FROM x GROUP BY line_no)
  SELECT v.line_no, b.hit IS NOT NULL AS found, coalesce(b.hit, b.best) AS "match" FROM v LEFT JOIN b ON b.line_no = v.line_no""")
def near_dup_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Evaluation prompts against the newest training prompts of their topic and of all."""
    asked = _sft(spark, d).filter("split <> 'train'")
    return dedup.near_in_recent(table(spark, d, "sft_train"), asked, "line_no", "prompt", "topic", "created_at", "line_no", 0.6)


@query("""SELECT min(line_no) AS line_no FROM sft_val WHERE lower(trim(regexp_replace(prompt, '\\s+', ' ', 'g'))) NOT IN
  (SELECT lower(trim(regexp_replace(prompt, '\\s+', ' ', 'g'))) FROM sft_train WHERE prompt IS NOT NULL) GROUP BY lower(trim(regexp_replace(prompt, '\\s+', ' ', 'g')))""".replace(
    "trim(regexp_replace(prompt, '\\s+', ' ', 'g'))", _n("prompt")
))
def add_if_new(spark: SparkSession, d: str) -> DataFrame:
    """Prompts of a batch that the index (the training prompts) hasn't seen, once each."""
    index = table(spark, d, "sft_train").select(T.fold(F.col("prompt")).alias("prompt_key"))
    return dedup.add_new(index, table(spark, d, "sft_val"), T.fold(F.col("prompt")), "line_no").select("line_no")


# ---- tokens and batches


@query("SELECT line_no, (line_no - 1) % 6 AS shard FROM prompt_seed_final")
def modulo_shard(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "prompt_seed_final").select("line_no", F.pmod(F.col("line_no") - 1, F.lit(6)).alias("shard"))


# The cycle of task types.
CYCLE = "rw_instruction followup_clarification transformation safety_refusal noisy_input_robustness code_switch_instruction multilingual_retention structured_output language_control open_domain_chat".split()


@query(f"SELECT line_no, {_list(CYCLE)}[(line_no % 10)::INT + 1] AS task FROM prompt_seed_final")
def round_robin_tasks(spark: SparkSession, d: str) -> DataFrame:
    cycle = F.array(*[F.lit(c) for c in CYCLE])
    return table(spark, d, "prompt_seed_final").select("line_no", F.element_at(cycle, (F.pmod(F.col("line_no"), F.lit(10)) + 1).cast("int")).alias("task"))


@query("SELECT line_no, (row_number() OVER (ORDER BY line_no) - 1) // 5 AS batch, (row_number() OVER (ORDER BY line_no) - 1) % 5 AS place FROM prompt_seed_final")
def micro_batches(spark: SparkSession, d: str) -> DataFrame:
    return tokens.batch_numbers(table(spark, d, "prompt_seed_final").select("line_no"), "line_no", 5)


def _examples(spark: SparkSession, d: str) -> DataFrame:
    """Token examples of all splits, by the character tokenizer."""
    return tokens.examples(_sft(spark, d).select("split", "line_no", "prompt", "response"), tokens.char_ids, "prompt", "response", 512, "<eos>")


_PTEXT = f"(CASE WHEN starts_with({_n('prompt')}, 'User: ') THEN {_n('prompt')} ELSE 'User: ' || {_n('prompt')} END || chr(10) || 'Assistant: ')"
_IDS = "list_transform(list_filter(string_split({x}, ''), lambda c: c <> ''), lambda c: (unicode(c) % 251)::INT)"
_EXAMPLE = f"""(SELECT split, line_no, p, f[1:512] AS f FROM (SELECT split, line_no, length({_PTEXT}) AS p, {_IDS.format(x=f"{_PTEXT} || coalesce(response, '') || '<eos>'")} AS f FROM {_SFT}))"""


@query(f"""SELECT line_no, array_to_string(f, ' ') AS input_ids, array_to_string(list_transform(range(1, len(f) + 1), lambda i: CASE WHEN i <= p THEN -100 ELSE f[i] END), ' ') AS labels,
  (len(f) - least(p, len(f)))::BIGINT AS supervised FROM {_EXAMPLE} WHERE len(f) > p""")
def char_tokens_masked(spark: SparkSession, d: str) -> DataFrame:
    """Token examples with masked prompts, by a character tokenizer."""
    made = _examples(spark, d)
    text = lambda c: F.array_join(F.transform(c, lambda i: i.cast("string")), " ")
    return made.select("line_no", text("input_ids").alias("input_ids"), text("labels").alias("labels"), F.col("supervised").cast("bigint").alias("supervised"))


_BATCHED = f"(SELECT line_no, f, p, (row_number() OVER (ORDER BY line_no) - 1) // 8 AS batch FROM {_EXAMPLE} WHERE len(f) > p)"


@query(f"""SELECT line_no, batch, max(len(f)) OVER (PARTITION BY batch)::BIGINT AS width, len(f)::BIGINT AS n_real FROM {_BATCHED}""")
def padded_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of eight, padded to their longest."""
    made = _examples(spark, d)
    full = tokens.padded(tokens.batch_numbers(made, "line_no", 8))
    real = F.aggregate("mask", F.lit(0), lambda a, x: a + x)
    return full.select("line_no", "batch", F.size("input_ids").cast("bigint").alias("width"), real.cast("bigint").alias("n_real"))


@query(f"""SELECT batch, sum(len(f) - least(p, len(f)))::BIGINT AS supervised, count(*) AS n FROM (SELECT f, p, (row_number() OVER (ORDER BY line_no) - 1) // 8 AS batch FROM {_EXAMPLE}
  WHERE len(f) > p AND split = 'val') WHERE batch < 32 GROUP BY batch""")
def eval_batches(spark: SparkSession, d: str) -> DataFrame:
    """Supervised tokens of the evaluation's batches (at most 32, as the evaluation loop takes them)."""
    made = _examples(spark, d).filter("split = 'val'")
    capped = tokens.batch_numbers(made, "line_no", 8).filter("batch < 32")
    return capped.groupBy("batch").agg(F.sum("supervised").cast("bigint").alias("supervised"), F.count(F.lit(1)).alias("n"))


# ---- JSON


@query("SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events")
def json_props_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"))


@query(f"""SELECT line_no, {_na("prompt")} AS prompt, {_na("response")} AS response, coalesce(nullif({_n("id")}, ''), 'auto_' || substr(sha1(line_no || ':' || {_na("prompt")}), 1, 16)) AS record FROM {_SFT}""")
def record_extraction(spark: SparkSession, d: str) -> DataFrame:
    """Prompt, response and id of records given as JSON text."""
    rows = _sft(spark, d)
    lines = rows.select("line_no", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value")).withColumn("v", F.try_parse_json("value"))
    prompt = jsonl.prompt_of(F.col("value"), F.col("v"))
    return lines.select("line_no", prompt.alias("prompt"), jsonl.response_of(F.col("value"), F.col("v")).alias("response"), T.record_id(jsonl.field(F.col("v"), "$.id"), F.col("line_no"), prompt).alias("record"))


_UNFENCED = "trim(regexp_replace(regexp_replace(trim(coalesce(response, '')), '^```[A-Za-z]*[ \\t]*\\n?', ''), '\\n?[ \\t]*```$', ''))"


@query(f"""SELECT line_no, contains(coalesce(response, ''), '```') AS fenced, md5({_UNFENCED}) AS body_md5 FROM generated_raw""")
def fence_removal(spark: SparkSession, d: str) -> DataFrame:
    x = F.col("response")
    return table(spark, d, "generated_raw").select("line_no", F.contains(F.coalesce(x, F.lit("")), F.lit("```")).alias("fenced"), F.md5(jsonl.unfenced(x).cast("binary")).alias("body_md5"))


@query("""SELECT line_no, coalesce(json_extract_string(j, '$.title'), json_extract_string(j, '$.izina')) AS title FROM (SELECT line_no, response::JSON AS j FROM chat_seed_pairs
  WHERE starts_with(response, '{') AND json_valid(response)) WHERE coalesce(json_extract_string(j, '$.title'), json_extract_string(j, '$.izina')) IS NOT NULL""")
def json_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of responses that are JSON objects as they stand."""
    rows = table(spark, d, "chat_seed_pairs").filter(F.startswith("response", F.lit("{"))).withColumn("v", F.try_parse_json("response")).filter("v IS NOT NULL")
    title = F.coalesce(jsonl.field(F.col("v"), "$.title"), jsonl.field(F.col("v"), "$.izina"))
    return rows.select("line_no", title.alias("title")).filter("title IS NOT NULL")


_WSC = _WS[:-1]
_NOT_WS = "[^" + _WSC[1:]
_LABELLED = f"""regexp_matches(b, '(?i)^(prompt|question|user){_WSC}*:{_WSC}')"""


@query(rf"""WITH l AS (SELECT line_no, unnest(string_split_regex(coalesce(response, ''), '\r\n|\n|\r')) AS s, unnest(range(len(string_split_regex(coalesce(response, ''), '\r\n|\n|\r')))) AS i FROM chat_seed_pairs),
  o AS (SELECT line_no, i, lower({_n("s")}) AS f, regexp_replace(s, '^{_WS}', '') AS b FROM l),
  k AS (SELECT line_no, i, b, regexp_extract(b, '^({_NOT_WS}+){_WSC}', 1) AS t FROM o WHERE NOT (starts_with(f, '```') OR f = 'json'
    OR list_bool_or(list_transform({_list(jsonl.INTRODUCTIONS)}, lambda p: starts_with(f, p) AND NOT regexp_matches(substr(f, length(p) + 1, 1), '[\p{{L}}\p{{N}}_]'))))),
  m AS (SELECT line_no, i, {_n(rf"""CASE WHEN list_contains({_list(jsonl.BULLETS)}, t) OR regexp_matches(t, '^\(?\p{{Nd}}+[.)]{{0,2}}$') OR regexp_matches(t, '^\(?[A-Za-z][.)]{{1,2}}$')
    THEN substr(b, length(t) + 1) WHEN {_LABELLED} THEN regexp_replace(b, '^[^:]*:', '') ELSE b END""")} AS s FROM k),
  f AS (SELECT line_no, s, i FROM m WHERE s <> '' QUALIFY row_number() OVER (PARTITION BY line_no, lower(s) ORDER BY i) = 1)
  SELECT line_no, (row_number() OVER (PARTITION BY line_no ORDER BY i))::BIGINT AS place, s AS item FROM f""")
def line_parser(spark: SparkSession, d: str) -> DataFrame:
    """Items of responses written as lists."""
    told = table(spark, d, "chat_seed_pairs").select("line_no", F.posexplode(jsonl.listed_prompts(F.col("response"))).alias("place", "item"))
    return told.select("line_no", (F.col("place") + 1).cast("bigint").alias("place"), "item")


# ---- runs of failures


@query("""WITH x AS (SELECT *, event_type = 'error' AS f, sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events)
  SELECT user_id, min(event_id) AS started, count(*) AS length FROM x WHERE f GROUP BY user_id, g""")
def failure_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of errors in a row per user."""
    return report.failure_runs(table(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "error")


_STREAK = """count(*) FILTER (WHERE {c}) OVER (PARTITION BY user_id, g{c} ORDER BY event_id)"""
_KINDS = "SELECT user_id, event_id, (event_type = 'error' AND event_id % 3 = 0) AS a, (event_type = 'error' AND event_id % 3 = 1) AS b, event_type = 'error' AS c FROM events"


@query(f"""WITH k AS ({_KINDS}), g AS (SELECT *, count(*) FILTER (WHERE NOT a) OVER w AS ga, count(*) FILTER (WHERE NOT b) OVER w AS gb, count(*) FILTER (WHERE NOT c) OVER w AS gc
    FROM k WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
  n AS (SELECT user_id, event_id, {_STREAK.format(c="a")} AS na, {_STREAK.format(c="b")} AS nb, {_STREAK.format(c="c")} AS nc FROM g)
  SELECT user_id, event_id, CASE WHEN na >= 2 THEN 'consecutive_429_limit_reached' WHEN nb >= 2 THEN 'consecutive_parse_limit_reached' WHEN nc >= 3 THEN 'consecutive_fail_limit_reached' ELSE '' END AS stop FROM n""")
def circuit_breaker(spark: SparkSession, d: str) -> DataFrame:
    """After each event, the first limit of consecutive failures that is reached: too many requests, unreadable output, any failure."""
    kind = F.when(F.col("event_type") == "error", F.pmod("event_id", F.lit(3)))
    log = table(spark, d, "events").select("user_id", "event_id", (kind == 0).alias("429"), (kind == 1).alias("parse"), kind.isNotNull().alias("fail"))
    for name in ("429", "parse", "fail"):
        log = report.streak(log, "user_id", "event_id", name, f"n_{name}")
    stop = report.breaker({k: F.col(f"n_{k}") for k in ("429", "parse", "fail")}, [("429", 2), ("parse", 2), ("fail", 3)])
    return log.select("user_id", "event_id", stop.alias("stop"))


@query("""SELECT event_id, CASE WHEN contains(e, 'error') THEN 'failed' WHEN contains(e, 'sign') THEN 'joined' ELSE 'other' END AS class FROM (SELECT event_id, lower(event_type) AS e FROM events)""")
def failure_classes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", report.failure_class(F.col("event_type"), [("error", "failed"), ("sign", "joined")], "other").alias("class"))


@query(f"""SELECT tab, count(*) AS n, sum(('0x' || substr(md5({_n("prompt")}), 1, 8))::BIGINT)::BIGINT AS fingerprint FROM (SELECT 'train' AS tab, prompt FROM sft_train UNION ALL SELECT 'val', prompt FROM sft_val
  UNION ALL SELECT 'test', prompt FROM sft_test) GROUP BY tab""")
def content_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """A fingerprint of content that doesn't depend on the order or place of files."""
    part = F.conv(F.substring(F.md5(T.norm(F.col("prompt")).cast("binary")), 1, 8), 16, 10).cast("bigint")
    return _sft(spark, d).groupBy(F.col("split").alias("tab")).agg(F.count(F.lit(1)).alias("n"), F.sum(part).alias("fingerprint"))


@query(f"""SELECT split, reason, count(*) AS n FROM (SELECT {_split("coalesce(nullif(" + _n("g.id") + ", ''), nullif(" + _na("g.prompt") + ", ''))")} AS split, t.reason FROM generated_raw g JOIN ({_TOLD}) t USING (line_no)) GROUP BY split, reason""")
def pipeline_report(spark: SparkSession, d: str) -> DataFrame:
    """Generated records cleaned, de-duplicated and split, counted: one shuffle for duplicates, one for the counts."""
    told = clean.with_clean_reason(table(spark, d, "generated_raw").withColumn("conversation_id", F.lit(None).cast("string")), "line_no")
    return report.with_split(told).groupBy("split", "reason").agg(F.count(F.lit(1)).alias("n"))
