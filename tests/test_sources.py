import json

from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.clean import first_reason
from millrace.sources import jsonl
from millrace.streaming import runs


def test_line_numbers_and_shapes(spark, tmp_path):
    lines = [
        json.dumps({"prompt": "A", "response": "B", "extra": 1}), "", "not json", "[1]", json.dumps({"instruction": "Sobanura", "input": "ibi", "output": "yego"}),
        json.dumps({"question": "Q", "answer": "A"}), json.dumps({"prompt": None, "question": "Q"}),
        json.dumps({"messages": [{"role": "user", "content": "hi"}, 5, {"role": "assistant", "content": "yo"}, {"role": "user", "content": "more"}, {"role": "assistant", "content": "sure"}]}),
    ]
    path = tmp_path / "x.jsonl"
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        read = jsonl.read_jsonl(spark, str(path))
        got = {r["line_no"]: (r["p"], r["r"]) for r in read.select("line_no", jsonl.prompt_of(F.col("value"), F.col("v")).alias("p"), jsonl.response_of(F.col("value"), F.col("v")).alias("r")).collect()}
        assert got == {1: ("A", "B"), 5: ("Sobanura\nibi", "yego"), 6: ("Q", "A"), 7: ("", ""), 8: ("hi", "yo")}
        pairs = [(r["line_no"], r["prompt"], r["response"]) for r in jsonl.read_pairs(spark, str(path)).orderBy("line_no", "pair_no").collect()]
        assert [r["prompt"] for r in jsonl.head_prompts(spark, str(path), 2).collect()] == ["A", "Sobanura\nibi"]
        assert pairs == [(1, "A", "B"), (5, "Sobanura\nibi", "yego"), (8, "User: hi", "yo"), (8, "User: hi Assistant: yo User: more", "sure")]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_repair(spark):
    texts = ['```json\n{"a": "x",}\n```', 'Sure: {"items": [{"id": "1", "response": "r"},]} done', '{"a": "C:\\q"}', '{"a": "line\nbreak"}', '{"items": [{"a": "b"}', '{"a": "cut off', "no json"]
    got = [r["s"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").transform(lambda x: jsonl.with_repaired(x, "t")).orderBy("i").select(F.schema_of_variant("v").alias("s")).collect()]
    assert all(s and s.startswith("OBJECT") for s in got[:6]) and got[6] is None
    item = spark.createDataFrame([('{"prompt": "a \\"b\\"", "task_type": "x", broken',)], "t string").select(jsonl.partial_item(F.col("t"), ["prompt", "task_type"]).alias("i")).first()["i"]
    assert (item["prompt"], item["task_type"]) == ('a "b"', "x")


def test_salvage_and_batches(spark):
    texts = ['{"prompt": "a\nb\t\\"c\\"", "task_type": "t"}', '{"items": [{"prompt": "p"}, {"prompt": "q"}]}', 'x {"prompt": "cut", "task_type": "t", "la', "nothing", None, '"prompt": "' + "x" * 100_000]
    got = jsonl.with_salvaged(spark.createDataFrame(list(enumerate(texts)), "i int, t string"), "t", ["prompt", "task_type"]).orderBy("i").collect()
    assert [(x["prompt"], x["task_type"], x["how"]) for x in got] == [('a\nb\t"c"', "t", "parsed"), ("p", None, "parsed"), ("cut", "t", "partial"), (None, None, "lost"), (None, None, "lost"), (None, None, "lost")]
    batches = ['{"items": [{"id": "1", "response": "a"}, 5, {"id": " 1 ", "response": "b"}, {"id": "", "response": "x"}, {"id": "2", "response": " "}, {"id": "3", "response": "“c”"}]}', '{"items": 3}', '{"items": []}']
    told = [r["b"] for r in spark.createDataFrame(list(enumerate(batches)), "i int, t string").orderBy("i").select(jsonl.batch_items(F.parse_json("t")).alias("b")).collect()]
    assert told[0]["answers"] == {"1": "b", "3": '"c"'} and told[0]["error"] is None and told[1]["error"] == "missing_items_list" and told[2]["answers"] == {}


def test_completion_shapes(spark):
    shapes = [
        {"choices": [{"message": {"content": "a"}}]}, {"choices": [{"message": {"content": [{"text": "a"}, "b"]}}]}, {"choices": [{"text": "a"}]}, {"output_text": "a"}, {"x": 1},
    ]
    got = [r["t"] for r in spark.createDataFrame([(i, json.dumps(s)) for i, s in enumerate(shapes)], "i int, s string").orderBy("i").select(jsonl.completion_text(F.parse_json("s")).alias("t")).collect()]
    assert got == ["a", "a\nb", "a", "a", ""]


def test_listed_prompts(spark):
    text = "Here are the prompts:\n1. First one\n- second\n* Second\n(a) third\nPrompt: fourth\n```\n"
    more = " json \nSurely not an introduction\n7 apples\n(12) twelve\nA plain line\nb) lettered\nUser : asks\nprompt:glued\n-\n• \nsure, here"
    got = spark.createDataFrame([(1, text), (2, more), (3, None), (4, "")], "i int, t string").orderBy("i").select(jsonl.listed_prompts(F.col("t")).alias("x")).collect()
    assert got[0]["x"] == ["First one", "second", "third", "fourth"]
    assert got[1]["x"] == ["Surely not an introduction", "apples", "twelve", "A plain line", "lettered", "asks", "prompt:glued", "-"]
    assert got[2]["x"] == got[3]["x"] == []


def test_write_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "train"), (2, "x", "val")], "n int, t string, split string")
    jsonl.write_splits(df, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 2
    many = spark.createDataFrame([((i * 7919) % 1000, None) for i in range(1000)], "n int, t string").repartition(4)
    jsonl.write_ordered(many, str(tmp_path / "o"), "n")
    lines = [json.loads(x) for f in sorted((tmp_path / "o").glob("part-*")) for x in f.read_text().splitlines()]
    assert [x["n"] for x in lines] == list(range(1000)) and all("t" in x for x in lines)


def test_stream_resumes_and_keeps_seen(spark, tmp_path):
    source = tmp_path / "in"
    schema = "line_no long, prompt string, source string, topic string, created_at string"
    judge = lambda df: df.withColumn("reason", first_reason([("empty_prompt", T.norm(F.col("prompt")) == "")]))

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source))
        at = {k: str(tmp_path / k) for k in ("seen", "accepted", "rejected", "check")}
        runs.accept_stream(spark.readStream.schema(schema).parquet(str(source)), at["seen"], at["accepted"], at["rejected"], at["check"], "line_no", judge).awaitTermination(120)
        return sorted(r["line_no"] for r in spark.read.parquet(at["accepted"]).collect()), spark.read.parquet(at["rejected"]).count()

    assert run([(1, "A b", "s", "t", "1"), (2, "a  B", "s", "t", "1"), (3, " ", "s", "t", "1")]) == ([1], 1)
    assert run([(4, "A B", "s", "t", "2"), (5, "new", "s", "t", "2")]) == ([1, 5], 1)
    # the commit of the last batch is lost: it runs again and keeps its rows
    for name in ("1", ".1.crc"):
        (tmp_path / "check" / "commits" / name).unlink(missing_ok=True)
    assert run([]) == ([1, 5], 1)
    # a table of prompts known beforehand
    known = spark.createDataFrame([("six", "Six", "s", "", "0")], runs.SEEN)
    runs.start_with(known, str(tmp_path / "seen"))
    assert run([(6, "SIX", "s", "t", "3"), (7, "seven", "s", "t", "3")]) == ([1, 5, 7], 1)


def test_repeats_leave_a_stream(spark, tmp_path):
    source = tmp_path / "in"
    rows = [(1, "A b", "2024-01-01 00:00:00"), (2, "a B", "2024-01-01 00:10:00"), (3, "c", "2024-01-01 00:20:00")]
    frame = spark.createDataFrame(rows, "i int, prompt string, at string").withColumn("at", F.to_timestamp("at"))
    frame.coalesce(1).write.parquet(str(source))
    stream = runs.first_seen_stream(spark.readStream.schema(frame.schema).parquet(str(source)), "prompt", "at")
    stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
    got = [r["prompt_key"] for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == ["a b", "c"]


def test_duplicate_shared_dir():
    from types import SimpleNamespace

    import pytest

    from millrace.session import shared_dir

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError):
        shared_dir(cluster)
    cluster.conf.get = lambda *a: "file:///shared"
    assert shared_dir(cluster) == "file:///shared"


def test_entry_and_catalogue(spark, data):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
