import json
import os
from collections import Counter
from hashlib import sha1, sha256

import pytest
from pyspark.sql import functions as F

from millrace.operators import report, seed
from millrace.plans import pipeline


@pytest.mark.parametrize(
    "item,reason",
    [
        (("", "x", "y"), "empty_prompt"), (("abc", "x", "y"), "prompt_too_short"), (("a" * 261, "x", "y"), "prompt_too_long"), (("Sobanura ibi bintu", "x", "rw"), "invalid_task_type"),
        (("Sobanura ibi bintu", "rw_instruction", "xx"), "invalid_lang_mode"), (("Sobanura ibi bintu", "rw_instruction", "en"), "task_lang_mode_mismatch"), (("Sobanura ibi bintu", "rw_instruction", "rw"), "ok"),
    ],
)
def test_item_reason(spark, item, reason):
    df = spark.createDataFrame([item], "p string, t string, m string")
    assert df.select(seed.item_reason(F.col("p"), F.col("t"), F.col("m")).alias("r")).first()["r"] == reason
    if reason == "ok":
        assert df.select(seed.item_reason(F.col("p"), F.col("t"), F.col("m"), wanted="transformation").alias("r")).first()["r"] == "task_type_not_requested"


def test_choices(spark):
    made = lambda counts: spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "task string")
    assert seed.next_task(made({"a": 50}), "task", 1, {"a": 1, "b": 1}) == "b"
    told = {r["name"]: r for r in seed.task_urgency(made({"a": 50, "x": 50}), "task", 1, {"a": 1, "b": 3}).collect()}
    draw = {n: 0.85 + 0.3 * (int(sha1(f"1:{n}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF) for n in "ab"}
    assert told["a"]["n"] == 50
    assert abs(told["a"]["urgency"] - 0.15 * draw["a"]) < 1e-12 and abs(told["b"]["urgency"] - 3 * 2 * draw["b"]) < 1e-12
    counts = Counter()
    for i in range(5):
        counts[seed.next_task(made(counts), "task", i)] += 1
    assert set(counts) <= set(seed.TASK_WEIGHTS) and len(counts) > 1
    used = made({"a": 3, "b": 1, "c": 2, "z": 9})
    assert sorted(r["name"] for r in seed.open_topics(used, "task", ["a", "b", "c"]).collect()) == ["b", "c"]
    assert {seed.next_topic(used, "task", ["a", "b", "c"], i) for i in range(8)} == {"b", "c"}
    with pytest.raises(RuntimeError):
        seed.open_topics(used, "task", [])
    assert seed.share_of_worker(5000, 3, 0.4) == 667 and seed.share_of_worker(0, 4) == 1


def test_small_inputs(tmp_path, monkeypatch):
    (tmp_path / "t").write_text("  a   b \n\nc\n")
    (tmp_path / "e").write_text("# x\nMILL_A='1'\nMILL_B=2\n")
    (tmp_path / "none").write_text("\n")
    monkeypatch.setenv("MILL_B", "kept")
    monkeypatch.delenv("MILL_A", raising=False)
    pipeline.read_env(str(tmp_path / "e"))
    assert os.environ["MILL_A"] == "1" and os.environ["MILL_B"] == "kept"
    del os.environ["MILL_A"]
    assert pipeline.read_topics(str(tmp_path / "t"), []) == ["a b", "c"] and pipeline.read_topics(None, ["x"]) == ["x"]
    with pytest.raises(RuntimeError):
        pipeline.read_topics(str(tmp_path / "none"), [])
    with pytest.raises(FileNotFoundError):
        pipeline.read_topics(str(tmp_path / "missing"), [])
    one = pipeline.files_fingerprint(train=str(tmp_path / "t"), test="")
    assert len(one) == 64 and one == pipeline.files_fingerprint(train=str(tmp_path / "t"), test="")
    pipeline.write_report(str(tmp_path / "r" / "x.json"), {"a": 1})
    assert json.loads((tmp_path / "r" / "x.json").read_text()) == {"a": 1}


def test_preflight_and_runs(spark, tmp_path):
    lines = [json.dumps({"prompt": "Hi", "response": "Yes"})] * 3 + ["", "bad"]
    (tmp_path / "train.jsonl").write_text("\n".join(lines) + "\n")
    (tmp_path / "val.jsonl").write_text(lines[0] + "\n")
    at = {n: str(tmp_path / f"{n}.jsonl") for n in ("train", "val", "test")}
    told = pipeline.preflight_files(spark, 2, **at)
    assert told["failures"] == ["too_few_valid_rows:val:1", f"missing:test:{at['test']}"] and not told["ok"] and told["dataset_fingerprint"] == ""
    assert told["summaries"]["train"] == {"n_lines": 5, "valid_pairs": 3, "invalid_lines": 2, "avg_prompt_chars": 2.0, "avg_response_chars": 3.0}
    fine = pipeline.preflight_files(spark, 1, train=at["train"], val=at["val"])
    assert fine["ok"] and fine["dataset_fingerprint"] == pipeline.files_fingerprint(train=at["train"], val=at["val"])
    (tmp_path / "c.json").write_text('{"a": 1}')
    print_ = pipeline.config_fingerprint(str(tmp_path / "c.json"))
    assert print_ == sha256(b'{"a": 1}').hexdigest() and pipeline.read_config(str(tmp_path / "c.json")) == {"a": 1}
    assert pipeline.run_id("n", print_, "d") == sha1(f"n:{print_}:d".encode()).hexdigest()[:12] and pipeline.out_path("a/b", "final.jsonl") == "a/b.final.jsonl"
    (tmp_path / "l.json").write_text("[1]")
    with pytest.raises(ValueError):
        pipeline.read_config(str(tmp_path / "l.json"))
    pipeline.append_metrics(str(tmp_path / "m"), 1, loss=0.5)
    pipeline.append_metrics(str(tmp_path / "m"), 2, loss=0.25)
    assert [json.loads(x)["step"] for x in (tmp_path / "m").read_text().splitlines()] == [1, 2]
    steps = spark.createDataFrame([("c/step-00000010",), ("c/step-00000009",), ("c/step-x",), ("c/other",)], "p string")
    assert tuple(report.latest_step(steps, "p").first()) == ("c/step-00000010", 10)
    speed = spark.createDataFrame([(100, 2.0), (5, 0.0)], "t int, s double").select(report.throughput(F.col("t"), F.col("s")).alias("x")).collect()
    assert [r["x"] for r in speed] == [50.0, 5e6]


def test_seeds_and_requests(spark):
    made = seed.template_records(spark, ["a", "A"]).orderBy("place").collect()
    n = sum(map(len, seed.TEMPLATES.values()))
    assert len(made) == n and made[0]["id"].startswith("rw_") and made[-1]["lang_mode"] == "control"  # A is a, case aside
    assert seed.template_records(spark, target=5).count() == 5 and seed.template_records(spark).count() == len(seed.TOPICS) * n
    assert seed.item_schema(True)["properties"]["items"]["items"] == seed.item_schema()
    row = spark.createDataFrame([("t", "o", "rw", ["x", "y"], [])], "t string, o string, m string, a array<string>, f array<string>")
    text = row.select(seed.request_text(*[F.col(c) for c in "tomaf"], 3).alias("r")).first()["r"]
    assert "3 new" in text and "- x\n- y" in text and "begin with" not in text


def test_retries():
    from millrace.operators import teacher

    calls, waits = [], []

    def asks(status):
        def answer(batch):
            calls.append(status)
            if len(calls) < 3:
                raise teacher.StatusError(status, "x")
            return {"1": "ok"}

        return answer

    assert teacher.with_retries(asks(503), 4, 2.0, sleep=waits.append)([("1", "p")]) == {"1": "ok"} and waits == [2.0, 4.0]
    calls.clear()
    with pytest.raises(teacher.StatusError):
        teacher.with_retries(asks(408), 4, sleep=waits.append)([("1", "p")])
    assert len(calls) == 1
    calls.clear()
    assert teacher.with_retries(asks(408), 4, retried=teacher.RETRIED_MORE, sleep=waits.append)([("1", "p")])
    calls.clear()
    with pytest.raises(teacher.StatusError):
        teacher.with_retries(asks(None), 2, sleep=waits.append)([("1", "p")])


def test_end_to_end(spark, tmp_path):
    good = "Iki ni igisubizo kirekire gihagije kandi cyiza cyane nomero {}."
    rows = [{"id": f"i{k}", "prompt": f"Sobanura ikibazo cya {k}", "response": good.format(k), "lang_mode": "rw", "topic": "t" if k % 2 else "u", "task_type": "rw_instruction"} for k in range(40)]
    rows += [rows[0], {"id": "bad", "prompt": "x", "response": "y"}, {"question": "Ese ni iki kibazo?", "answer": good.format("q"), "topic": " "}]
    path = tmp_path / "raw.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in rows) + "\nnot json\n")
    (tmp_path / "plan.json").write_text(json.dumps({"min_rows": 100, "max_single_topic_ratio": 0.4, "content_type_min_ratio": {"rw_instruction": 0.5, "transformation": 0.1}, "lang_mode_min_ratio": {"rw": 0.99}}))
    plan = pipeline.MixPlan.read(str(tmp_path / "plan.json"))
    told = pipeline.run(spark, str(path), str(tmp_path / "out"), plan, least=5)
    assert told["reasons"] == {"ok": 41, "duplicate_prompt_response": 1, "prompt_too_short": 1}
    assert told["mix_failures"] == ["too_few_rows:41<100", "content_ratio_low:transformation:0.0000<0.1000", f"lang_ratio_low:rw:{40 / 41:.4f}<0.9900", f"topic_concentration_high:u:{20 / 41:.4f}>0.4000"]
    assert sum(told["splits"].values()) == 41 == spark.read.json(str(tmp_path / "out" / "splits")).count()
    assert {json.loads(r["record"]).get("id") for r in spark.read.json(str(tmp_path / "out" / "rejects")).collect()} == {"i0", "bad"}


def test_several_files(spark, tmp_path):
    good = "Iki ni igisubizo kirekire gihagije kandi cyiza cyane nomero {}."
    row = lambda k: {"id": f"i{k}", "prompt": f"Sobanura ikibazo cya {k}", "response": good.format(k), "lang_mode": "rw", "topic": "t"}
    bad = {"id": "bad", "prompt": "x", "response": "y"}
    files = {"a": [row(0), bad, row(1), row(1)], "b": [bad, row(2), row(0), row(3)], "c": [row(4)]}
    for name, rows in files.items():
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps(r) for r in rows) + "\n")
    for raw in (str(tmp_path / "*.jsonl"), [str(tmp_path / f"{name}.jsonl") for name in files]):
        told = pipeline.run(spark, raw, str(tmp_path / "out"), pipeline.MixPlan(max_topic=0.5), least=1)
        assert told["reasons"] == {"ok": 5, "duplicate_prompt_response": 2, "prompt_too_short": 2} and sum(told["splits"].values()) == 5
        assert told["mix_failures"] == ["topic_concentration_high:t:1.0000>0.5000"]
        for part in ("clean", "splits"):
            assert sorted(r["id"] for r in spark.read.json(str(tmp_path / "out" / part)).collect()) == [f"i{k}" for k in range(5)]
        lost = {(r["file"][-7:], r["line_no"], r["reason"]) for r in spark.read.json(str(tmp_path / "out" / "rejects")).collect()}
        assert lost == {("a.jsonl", 2, "prompt_too_short"), ("a.jsonl", 4, "duplicate_prompt_response"), ("b.jsonl", 1, "prompt_too_short"), ("b.jsonl", 3, "duplicate_prompt_response")}


def test_breaker_priority(spark):
    df = spark.createDataFrame([(0, 3, 9), (2, 3, 9), (0, 0, 9), (0, 0, 1)], "a int, b int, c int")
    stop = report.breaker({"429": F.col("a"), "parse": F.col("b"), "fail": F.col("c")}, [("429", 2), ("parse", 3), ("fail", 5)])
    assert [r["s"] for r in df.select(stop.alias("s")).collect()] == ["consecutive_parse_limit_reached", "consecutive_429_limit_reached", "consecutive_fail_limit_reached", ""]
