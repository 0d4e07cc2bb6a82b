"""Queries over files, streams and model output: each writes tables in the forms that sources, sinks and parsers meet, reads
them back through the operators, and has SQL that says from the tables alone what must come out."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import clean, dedup, report, seed, tokens
from millrace.operators.clean import first_reason
from millrace.plans import pipeline
from millrace.plans.catalogue import _BEST, _FILLED, _KEY, _MIX, _PLAN_ROWS, _REASON, _SCORED, _SFT, PLAN, _list, _n, _na, _sft, _split, query
from millrace.session import _remove_at_end, shared_dir, stage, table
from millrace.sources import jsonl
from millrace.streaming import runs

#: Lines of a written file at most
FILE_LINES = 20_000
_JSON = {"ignoreNullFields": "false"}


def _folder(spark: SparkSession, label: str) -> str:
    path = f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"
    _remove_at_end(spark, path)
    return path


def _write_lines(lines: DataFrame, label: str) -> str:
    """Lines (part, line_no, value) as text files, one a part, in the order of line_no; the path of all."""
    path = _folder(lines.sparkSession, label)
    lines.repartition(F.col("part")).sortWithinPartitions("part", "line_no").select("part", "value").write.partitionBy("part").text(path)
    return path


def _part(file: Column) -> Column:
    return F.regexp_extract(file, "part=([^/]+)/", 1)


# ---- lines of records of several shapes, malformed and blank ones among them


def _lines(spark: SparkSession, d: str) -> str:
    """The records of all splits, by turns as a pair, a question, an instruction, a dialogue, a broken line and a blank one."""
    told = lambda **cs: F.to_json(F.struct(*[c.alias(k) for k, c in cs.items()]), _JSON)
    p, r = F.col("prompt"), F.col("response")
    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    shapes = [
        told(prompt=p, response=r, extra=F.lit(1)), told(question=p, answer=r), told(instruction=p, input=F.col("topic"), output=r),
        told(messages=F.array(said("system", F.lit("s")), said("User", p), said("assistant", r))), F.concat(F.lit('{"prompt": '), F.coalesce(p, F.lit(""))), F.lit(""),
    ]
    value = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        value = F.when(F.pmod("line_no", F.lit(6)) == i, shape).otherwise(value)
    part = F.concat("split", F.lit("-"), F.floor(F.col("line_no") / FILE_LINES).cast("string"))
    return _write_lines(_sft(spark, d).select(part.alias("part"), "line_no", value.alias("value")), "lines")


_L = f"""(SELECT split || '-' || (line_no // {FILE_LINES}) AS part, split, line_no, line_no % 6 AS shape, prompt, response, topic,
  row_number() OVER (PARTITION BY split, line_no // {FILE_LINES} ORDER BY line_no) AS ln FROM {_SFT})"""


def _instruction(f) -> str:  # noqa: ANN001
    return f"CASE WHEN {f('topic')} <> '' THEN {f('prompt')} || chr(10) || {f('topic')} ELSE {f('prompt')} END"


@query(f"SELECT part, ln AS line_no, CASE WHEN shape = 2 THEN {_instruction(_na)} ELSE {_na('prompt')} END AS prompt, {_na('response')} AS response FROM {_L} WHERE shape < 4")
def jsonl_records(spark: SparkSession, d: str) -> DataFrame:
    """Records of all shapes read from files, under their physical line numbers."""
    read = jsonl.read_jsonl(spark, _lines(spark, d))
    value, v = F.col("value"), F.col("v")
    return read.select(_part(F.col("file")).alias("part"), "line_no", jsonl.prompt_of(value, v).alias("prompt"), jsonl.response_of(value, v).alias("response"))


_PAIRS = f"""(SELECT *, CASE WHEN shape = 0 THEN {_n("prompt")} WHEN shape = 2 THEN {_instruction(_n)} WHEN {_n("prompt")} <> '' THEN 'User: ' || {_n("prompt")} ELSE '' END AS p, {_n("response")} AS r
  FROM {_L} WHERE shape IN (0, 2, 3))"""


@query(f"SELECT part, ln AS line_no, 0::INT AS pair_no, p AS prompt, r AS response FROM {_PAIRS} WHERE p <> '' AND r <> ''")
def jsonl_pairs(spark: SparkSession, d: str) -> DataFrame:
    """The pairs a trainer reads from the files."""
    return jsonl.read_pairs(spark, _lines(spark, d)).select(_part(F.col("file")).alias("part"), "line_no", "pair_no", "prompt", "response")


@query(f"""SELECT l.part, count(*) AS n_lines, count(g.ln) AS valid_pairs, count(*) - count(g.ln) AS invalid_lines,
  coalesce(sum(length(g.p))::DOUBLE / nullif(count(g.ln), 0)::DOUBLE, 0.0::DOUBLE) AS avg_prompt_chars, coalesce(sum(length(g.r))::DOUBLE / nullif(count(g.ln), 0)::DOUBLE, 0.0::DOUBLE) AS avg_response_chars
  FROM {_L} l LEFT JOIN (SELECT * FROM {_PAIRS} WHERE p <> '' AND r <> '') g ON g.part = l.part AND g.ln = l.ln GROUP BY l.part""")
def jsonl_summary(spark: SparkSession, d: str) -> DataFrame:
    """Physical lines, valid pairs, invalid lines and mean lengths per file."""
    lines = spark.read.text(_lines(spark, d)).select(_part(F.col("_metadata.file_path")).alias("part"), "value")
    return jsonl.summarize_lines(lines, ["part"])


_FULL = "(CASE WHEN starts_with(p, 'User: ') THEN p ELSE 'User: ' || p END || chr(10) || 'Assistant: ')"


@query(f"""SELECT part, line_no, least(n, 256)::BIGINT AS n_ids, (least(n, 256) - m)::BIGINT AS supervised FROM (SELECT part, ln AS line_no, length({_FULL}) AS m, length({_FULL}) + length(r) + 5 AS n
  FROM (SELECT part, ln, {_n("p")} AS p, r FROM {_PAIRS} WHERE p <> '' AND r <> '')) WHERE least(n, 256) > m""")
def jsonl_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Token examples of the pairs in the files."""
    made = jsonl.token_examples(spark, _lines(spark, d), tokens.char_ids, 256, "<eos>")
    return made.select(_part(F.col("file")).alias("part"), "line_no", F.size("input_ids").cast("bigint").alias("n_ids"), F.col("supervised").cast("bigint").alias("supervised"))


# ---- sinks


@query(f"SELECT {_split(_KEY)} AS split, line_no, prompt IS NULL AS no_prompt FROM chat_seed_pairs")
def split_sink(spark: SparkSession, d: str) -> DataFrame:
    """Records written to a folder per split and read back, nulls as nulls."""
    path = _folder(spark, "splits")
    jsonl.write_splits(report.with_split(table(spark, d, "chat_seed_pairs")).select("split", "line_no", "prompt"), path)
    read = jsonl.read_jsonl(spark, path).select(F.regexp_extract("file", "split=([a-z]+)/", 1).alias("split"), F.try_variant_get("v", "$.line_no", "bigint").alias("line_no"), jsonl.has(F.col("value"), "prompt").alias("there"), jsonl.field(F.col("v"), "$.prompt").alias("prompt"))
    return read.filter("there").select("split", "line_no", F.col("prompt").isNull().alias("no_prompt"))


@query(f"SELECT line_no, row_number() OVER (ORDER BY coalesce(created_at, ''), lower({_n('prompt')}), line_no) AS place FROM ({_BEST})")
def ordered_sink(spark: SparkSession, d: str) -> DataFrame:
    """Best records written in order over all files; their places as read back, file by file."""
    path = _folder(spark, "ordered")
    best = clean.best_record(table(spark, d, "prompt_seed_final"), T.fold(F.col("prompt")), _SCORED, "created_at", ["line_no"])
    keyed = best.withColumns({"a": F.coalesce("created_at", F.lit("")), "b": T.fold(F.col("prompt"))})
    jsonl.write_ordered(keyed, path, "a", "b", "line_no")
    read = jsonl.in_file_order(jsonl.read_jsonl(spark, path).select("file", "line_no", F.try_variant_get("v", "$.line_no", "bigint").alias("n")))
    numbered = tokens.batch_numbers(read.select("place", "n").withColumnRenamed("place", "at"), "at", 1, 2**40)
    return numbered.select(F.col("n").alias("line_no"), (F.col("batch") + 1).alias("place"))


@query("SELECT line_no, n FROM (SELECT line_no, 2::BIGINT AS n FROM sft_val)")
def append_sink(spark: SparkSession, d: str) -> DataFrame:
    """A table appended twice to the same lines: every row stands twice."""
    path = _folder(spark, "appended")
    rows = table(spark, d, "sft_val").select("line_no", "prompt")
    for _ in range(2):
        jsonl.write_jsonl(rows, path)
    read = jsonl.read_jsonl(spark, path).select(F.try_variant_get("v", "$.line_no", "bigint").alias("line_no"))
    return read.groupBy("line_no").agg(F.count(F.lit(1)).alias("n"))


# ---- worker files merged

_WORKER = f"""SELECT *, line_no % 3 AS w FROM prompt_seed_final WHERE {_n("prompt")} <> '' QUALIFY row_number() OVER (PARTITION BY lower({_n("prompt")}) ORDER BY {_FILLED} DESC, coalesce(created_at, '') DESC, line_no % 3, line_no) = 1"""


@query(f"SELECT 'worker_' || w AS worker, count(*) AS n, min(line_no) AS first_line, sum(line_no)::BIGINT AS lines FROM ({_WORKER}) GROUP BY w")
def worker_merge(spark: SparkSession, d: str) -> DataFrame:
    """Shared files of three workers merged to the best record of each prompt, files before lines; kept records per file."""
    rows = table(spark, d, "prompt_seed_final")
    value = F.to_json(F.struct(*rows.columns), _JSON)
    path = _write_lines(rows.select(F.concat(F.lit("worker_"), F.pmod("line_no", F.lit(3)).cast("string")).alias("part"), "line_no", value.alias("value")), "workers")
    read = jsonl.in_file_order(jsonl.read_jsonl(spark, f"{path}/part=worker_*"))
    fields = [jsonl.field(F.col("v"), f"$.{c}").alias(c) for c in [*_SCORED, "created_at"]]
    kept = clean.best_record(read.select("file", "place", F.try_variant_get("v", "$.line_no", "bigint").alias("line_no"), *fields), T.fold(F.col("prompt")), _SCORED, "created_at", ["place"])
    return kept.groupBy(_part(F.col("file")).alias("worker")).agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line"), F.sum("line_no").alias("lines"))


# ---- model output, damaged by turns and repaired


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "prompt_seed_final").select("line_no", "prompt", F.coalesce("task_type", F.lit("none")).alias("task_type"), F.coalesce("lang_mode", F.lit("none")).alias("lang_mode"))
    j = F.to_json(F.struct("prompt", "task_type", "lang_mode"), _JSON)
    open_ = F.substring(j, F.lit(1), F.char_length(j) - 1)  # without its last brace
    shapes = [
        j, F.concat(F.lit("```json\n"), j, F.lit("\n```")), F.concat(F.lit("Here it is: "), open_, F.lit(",} Done.")), F.concat(F.lit('{\n"note": "a\nb\\q",'), F.substring(j, F.lit(2), F.char_length(j))),
        open_, F.concat(F.lit('{"items": ['), j, F.lit(",]}")), F.concat(F.lit('{"items": ['), j), F.concat(F.substring_index(j, '"lang_mode"', 1), F.lit('"lang')),
    ]
    raw = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        raw = F.when(F.pmod("line_no", F.lit(8)) == i, shape).otherwise(raw)
    return stage(rows.select("line_no", raw.alias("raw")), "damaged")


@query("""SELECT line_no, md5(prompt) AS prompt_md5, coalesce(task_type, 'none') AS task_type, CASE WHEN line_no % 8 <> 7 THEN coalesce(lang_mode, 'none') END AS lang_mode,
  CASE WHEN line_no % 8 = 7 THEN 'partial' ELSE 'parsed' END AS how FROM prompt_seed_final WHERE prompt IS NOT NULL""")
def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    """Items written as models write them (fences, talk around, commas, raw line breaks, stray backslashes, ends cut off) and
    got back by repair, or by patterns where nothing parses."""
    found = jsonl.with_salvaged(_damaged(spark, d).filter("raw IS NOT NULL"), "raw", ["prompt", "task_type", "lang_mode"])
    return found.filter("prompt IS NOT NULL").select("line_no", F.md5(F.col("prompt").cast("binary")).alias("prompt_md5"), "task_type", "lang_mode", "how")


@query("""SELECT line_no, CASE WHEN line_no % 8 IN (5, 6) THEN 'list' ELSE 'itself' END AS shape, 1::INT AS n FROM prompt_seed_final WHERE prompt IS NOT NULL AND line_no % 8 <> 7""")
def payload_items(spark: SparkSession, d: str) -> DataFrame:
    """The items of a parsed payload: its list, or itself if it has all keys."""
    parsed = jsonl.with_repaired(_damaged(spark, d).filter("raw IS NOT NULL"), "raw").filter("v IS NOT NULL")
    items = jsonl.items_of(F.col("v"), ["prompt", "task_type", "lang_mode"])
    shape = F.when(F.try_variant_get("v", "$.items", "array<variant>").isNotNull(), "list").otherwise("itself")
    return parsed.select("line_no", shape.alias("shape"), F.size(items).alias("n")).filter("n > 0")


@query(f"""WITH r AS (SELECT line_no // 5 AS batch, line_no, {_na("id")} AS id, {_na("response")} AS response FROM generated_raw),
  x AS (SELECT batch, line_no, CASE WHEN line_no % 5 = 4 THEN coalesce((SELECT min(q.id) FROM r q WHERE q.batch = r.batch AND q.line_no % 5 = 0), id) ELSE id END AS id, response FROM r)
  SELECT batch, id, md5(response) AS response_md5 FROM x WHERE id <> '' AND response <> '' QUALIFY row_number() OVER (PARTITION BY batch, id ORDER BY line_no DESC) = 1""")
def batch_answers(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a batch (the last one under the first one's id again) as a map from id to response, the last one holding."""
    rows = table(spark, d, "generated_raw").select(F.floor(F.col("line_no") / 5).alias("batch"), "line_no", "id", "response")
    whole = rows.groupBy("batch").agg(F.sort_array(F.collect_list(F.struct("line_no", "id", "response"))).alias("r"))  # five rows
    heads = F.filter("r", lambda x: x["line_no"] % 5 == 0)
    first = F.when(F.size(heads) > 0, T.norm_ascii(F.get(heads, F.lit(0))["id"]))
    said = F.transform("r", lambda x: F.struct(F.when(x["line_no"] % 5 == 4, F.coalesce(first, x["id"])).otherwise(x["id"]).alias("id"), x["response"].alias("response")))
    said = whole.withColumn("said", F.to_json(F.struct(said.alias("items")), _JSON))
    told = said.select("batch", jsonl.batch_items(F.try_parse_json("said")).alias("b"))
    return told.select("batch", F.explode("b.answers").alias("id", "response")).select("batch", "id", F.md5(F.col("response").cast("binary")).alias("response_md5"))


@query("SELECT line_no, md5(trim(response)) AS text_md5 FROM generated_raw WHERE response IS NOT NULL")
def completion_texts(spark: SparkSession, d: str) -> DataFrame:
    """The text of completions given in four shapes."""
    r = F.col("response")
    told = lambda x: F.to_json(x, _JSON)
    message = lambda content: F.struct(F.array(F.struct(F.struct(content.alias("content")).alias("message"))).alias("choices"))
    shapes = [told(message(r)), told(message(F.array(F.struct(r.alias("text"))))), told(F.struct(r.alias("output_text"))), told(F.struct(F.array(F.struct(r.alias("text"))).alias("choices")))]
    raw = shapes[0]
    for i, shape in enumerate(shapes[1:], 1):
        raw = F.when(F.pmod("line_no", F.lit(4)) == i, shape).otherwise(raw)
    rows = table(spark, d, "generated_raw").filter("response IS NOT NULL").select("line_no", raw.alias("raw"))
    return rows.select("line_no", F.md5(jsonl.completion_text(F.try_parse_json("raw")).cast("binary")).alias("text_md5"))


@query(f"""SELECT line_no, CASE WHEN {_n("prompt")} = '' THEN 0 ELSE 1 END + CASE WHEN {_n("response")} = '' THEN 0 ELSE 1 END AS n FROM {_SFT}""")
def message_lists(spark: SparkSession, d: str) -> DataFrame:
    """Messages under either name; others than user and assistant, and empty ones, aren't spoken."""
    from millrace.operators.chat import spoken

    said = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    ms = F.array(said("system", F.lit("x")), said(" User ", F.col("prompt")), said("tool", F.lit("x")), said("ASSISTANT", F.col("response")), said("user", F.lit(" ")))
    raw = F.when(F.col("line_no") % 2 == 0, F.to_json(F.struct(ms.alias("messages")), _JSON)).otherwise(F.to_json(F.struct(ms.alias("conversation")), _JSON))
    v = F.col("v")
    both = F.when(F.size(jsonl.messages(v)) > 0, jsonl.messages(v)).otherwise(jsonl.messages(v, "$.conversation"))
    return _sft(spark, d).select("line_no", F.try_parse_json(raw).alias("v")).select("line_no", F.size(spoken(both)).alias("n"))


# ---- reports, choices, classes

_MIN_ROWS, _MAX_TOPIC = 1_000_000_000, 0.01


@query(f"""WITH m AS {_MIX}, t AS (SELECT n FROM m WHERE dim = 'all'), p(place, dim, value, least) AS (VALUES {", ".join(f"({i}, '{a}', '{b}', {x}::DOUBLE)" for i, (a, b, x) in enumerate(_PLAN_ROWS))}),
  top AS (SELECT {_n("topic")} AS v, count(*) AS n, min(line_no) AS l FROM prompt_seed_final GROUP BY 1 ORDER BY n DESC, l LIMIT 1)
  SELECT row_number() OVER (ORDER BY o, place) AS place, failure FROM (
    SELECT 0 AS o, 0 AS place, 'too_few_rows:' || n || '<{_MIN_ROWS}' AS failure FROM t
    UNION ALL SELECT 1, p.place, CASE WHEN p.dim = 'content_type' THEN 'content' ELSE 'lang' END || '_ratio_low:' || p.value || ':' || printf('%.4f', coalesce(m.ratio, 0)) || '<' || printf('%.4f', p.least)
      FROM p LEFT JOIN m ON m.dim = p.dim AND m.value = p.value WHERE coalesce(m.ratio, 0) < p.least
    UNION ALL SELECT 2, 0, 'topic_concentration_high:' || CASE WHEN v = '' THEN 'unknown' ELSE v END || ':' || printf('%.4f', top.n / t.n) || '>' || printf('%.4f', {_MAX_TOPIC}) FROM top, t WHERE top.n / t.n > {_MAX_TOPIC})""")
def mix_verdict(spark: SparkSession, d: str) -> DataFrame:
    """All failures of a content plan in order: rows, content types, language modes, the largest topic."""
    plan = pipeline.MixPlan(_MIN_ROWS, _MAX_TOPIC, PLAN)
    told = pipeline.mix_verdict(table(spark, d, "prompt_seed_final"), plan)
    return spark.createDataFrame(list(enumerate(told, 1)), "place long, failure string")


_ERRORS = ["HTTP_429: slow down", "Empty_Completion_Text", "no_json_object_found", "missing_items_list", "request timed out", "items_not_list", "roles_not_alternating", "invalid_json_output x", "json_object_not_dict", "boom"]


def _class_sql(kind: str) -> str:
    cases = " ".join(f"WHEN contains(e, '{needle}') THEN '{name}'" for needle, name in report.FAILURE_CLASSES[kind])
    return f"CASE {cases} ELSE 'other' END"


@query(f"SELECT event_id, {', '.join(f'{_class_sql(k)} AS c{i}' for i, k in enumerate(report.FAILURE_CLASSES))} FROM (SELECT event_id, lower({_list(_ERRORS)}[(event_id % {len(_ERRORS)})::INT + 1]) AS e FROM events)")
def failure_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Errors told apart by each of the five kinds of calls."""
    e = F.element_at(F.array(*[F.lit(x) for x in _ERRORS]), (F.pmod("event_id", F.lit(len(_ERRORS))) + 1).cast("int"))
    return table(spark, d, "events").select("event_id", *[report.failure_class(e, told, "other").alias(f"c{i}") for i, told in enumerate(report.FAILURE_CLASSES.values())])


_TEMPLATE_ROWS = [(i, *family, t) for i, (family, t) in enumerate((f, t) for f, ts in seed.TEMPLATES.items() for t in ts)]


def _q(x: object) -> str:
    return "'" + str(x).replace("'", "''") + "'" if isinstance(x, str) else str(x)


@query(f"""SELECT o * {len(_TEMPLATE_ROWS)} + t AS place, prefix || '_' || substr(sha1(replace(template, '{{topic}}', topic)), 1, 16) AS id, replace(template, '{{topic}}', topic) AS prompt, task_type, lang_mode
  FROM (VALUES {", ".join(f"({i}, {_q(t)})" for i, t in enumerate(seed.TOPICS))}) AS a(o, topic), (VALUES {", ".join("(" + ", ".join(map(_q, r)) + ")" for r in _TEMPLATE_ROWS)}) AS b(t, prefix, task_type, lang_mode, template)
  QUALIFY row_number() OVER (PARTITION BY lower(replace(template, '{{topic}}', topic)) ORDER BY o * {len(_TEMPLATE_ROWS)} + t) = 1""")
def template_seed(spark: SparkSession, d: str) -> DataFrame:
    """Template seeds: every topic with every template."""
    return seed.template_records(spark)


_DUE = "(SELECT sum(n) FROM c) * (weight::DOUBLE / {w}::DOUBLE)".format(w=float(sum(seed.TASK_WEIGHTS.values())))


@query(f"""WITH c AS (SELECT task_type AS name, count(*) AS n FROM prompt_seed_final WHERE task_type IS NOT NULL GROUP BY 1),
  w(name, weight) AS (VALUES {", ".join(f"('{k}', {v})" for k, v in seed.TASK_WEIGHTS.items())})
  SELECT w.name, coalesce(c.n, 0) AS n, round(weight * greatest(0.15::DOUBLE, 1 + ({_DUE} - coalesce(c.n, 0)) / greatest({_DUE}, 1.0::DOUBLE)) * (0.85::DOUBLE + 0.3::DOUBLE * (('0x' || substr(sha1('7:' || w.name), 1, 8))::BIGINT::DOUBLE / 4294967295.0::DOUBLE)), 9) AS urgency
  FROM w LEFT JOIN c ON c.name = w.name""")
def task_urgency(spark: SparkSession, d: str) -> DataFrame:
    """How much each task type is wanted next, after the rows made so far."""
    return seed.task_urgency(table(spark, d, "prompt_seed_final"), "task_type", 7).select("name", "n", F.round("urgency", 9).alias("urgency"))


@query(f"""WITH c AS (SELECT topic AS name, count(*) AS n FROM prompt_seed_final WHERE topic IS NOT NULL GROUP BY 1), t AS (SELECT unnest([{", ".join(_q(t) for t in seed.TOPICS)}]) AS name),
  x AS (SELECT t.name, coalesce(c.n, 0) AS n FROM t LEFT JOIN c ON c.name = t.name) SELECT name, n FROM x WHERE n <= (SELECT min(n) FROM x) + 1""")
def open_topics(spark: SparkSession, d: str) -> DataFrame:
    """The least used topics."""
    return seed.open_topics(table(spark, d, "prompt_seed_final"), "topic", seed.TOPICS)


@query(f"""SELECT lower({_n("prompt")}) AS prompt_key, arg_min({{'p': prompt, 's': source, 'c': created_at}}, coalesce(created_at, '') || printf('%020d', line_no)).p AS first_prompt,
  arg_min({{'p': prompt, 's': source, 'c': created_at}}, coalesce(created_at, '') || printf('%020d', line_no)).s AS first_source FROM sft_train WHERE {_n("prompt")} <> '' GROUP BY 1""")
def index_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    """The index of seen prompts from rows already written."""
    return dedup.bootstrap_index(table(spark, d, "sft_train"), "prompt", "source", "created_at", "line_no").select("prompt_key", "first_prompt", "first_source")


# ---- runs


@query(f"""SELECT min(line_no) AS line_no FROM (SELECT line_no, prompt, {_na("prompt")} AS p FROM prompt_seed_final) WHERE length(p) BETWEEN 10 AND 260 GROUP BY lower({_n("prompt")})""")
def incremental_accept(spark: SparkSession, d: str) -> DataFrame:
    """A run over the seeds as a stream: accepted rows, each prompt once."""
    rows = table(spark, d, "prompt_seed_final")
    at = {k: _folder(spark, f"run-{k}") for k in ("seen", "accepted", "rejected", "check")}
    p = T.norm_ascii(F.col("prompt"))
    judge = lambda df: df.withColumn("reason", first_reason([("prompt_too_short", F.char_length(p) < 10), ("prompt_too_long", F.char_length(p) > 260)]))
    stream = spark.readStream.schema(rows.schema).parquet(f"{d}/prompt_seed_final.parquet*")
    runs.accept_stream(stream, at["seen"], at["accepted"], at["rejected"], at["check"], "line_no", judge).awaitTermination()
    return spark.read.parquet(at["accepted"]).select("line_no")


@query(f"""SELECT count(*) AS n, count(*) FILTER (WHERE reason = 'ok') AS kept FROM ({_REASON})""")
def judged_counts(spark: SparkSession, d: str) -> DataFrame:
    """Processed and kept records of the cleaning checks, copies aside."""
    told = clean.judged(table(spark, d, "generated_raw"), "prompt", "response", "lang_mode")
    return told.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_reason") == "ok").alias("kept"))
