import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import chat, clean, dedup, report, setjoin, teacher, tokens
from millrace.session import exact_rank, hash_sample, running_sum


def test_clean_reasons_in_order(spark):
    long = "Iki ni igisubizo kirekire gihagije kandi cyiza."
    rows = [
        (1, None, long, "rw"), (2, "Sobanura ibi", None, "rw"), (3, "abc", long, "rw"), (4, "Sobanura ibi", "bito", "rw"), (5, "Sobanura ibi", "x " * 4000, "rw"),
        (6, "Sobanura ibi", "User: " + long, "rw"), (7, "Sobanura ibi", "1234567890 1234567890 12345", "rw"), (8, "Sobanura ibi", "na " * 20, "rw"),
        (9, "Sobanura ibi", "the and is are to of in that for with", "rw"), (10, "Sobanura ibi", "the and is are to of in that for with", "en"), (11, "Sobanura ibi", long, "rw"), (12, " sobanura  IBI", long, None),
    ]
    df = spark.createDataFrame(rows, "line_no long, prompt string, response string, lang_mode string").withColumn("reason2", F.lit("clash"))
    got = {r["line_no"]: r["reason"] for r in clean.with_clean_reason(df, "line_no").collect()}
    assert got == {
        1: "empty_prompt", 2: "empty_response", 3: "prompt_too_short", 4: "response_too_short", 5: "response_too_long", 6: "role_prefix_leakage", 7: "response_no_words",
        8: "response_word_repetition", 9: "response_too_english_for_rw", 10: "ok", 11: "ok", 12: "duplicate_prompt_response",
    }
    assert clean.with_clean_reason(df.limit(0), "line_no").count() == 0


def test_best_record_prefers_full_then_new_then_first(spark):
    rows = [(1, "A b", "x", "2020"), (2, "a  B", "x", "2021"), (3, "A B", None, "2022"), (4, "a b", "x", "2021"), (5, None, "x", "2020")]
    df = spark.createDataFrame(rows, "n long, p string, t string, c string")
    got = clean.best_record(df, T.fold(F.col("p")), ["p", "t"], "c", ["n"]).collect()
    assert [r["n"] for r in got] == [2]


def model_pairs(ms):
    ms = [m for m in ms]
    history, out = [], []
    for role, content in ms:
        if role == "user" or history:
            if role == "assistant":
                out.append((" ".join(" ".join(f"{'User' if r == 'user' else 'Assistant'}: {c}" for r, c in history).split()), content))
            history.append((role, content))
    return out


def test_history_pairs_against_model(spark):
    rng = random.Random(3)
    lists = [[(rng.choice(["user", "assistant"]), f"m{i}") for i in range(rng.randrange(0, 7))] for _ in range(100)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, ms array<struct<role:string,content:string>>")
    for r in df.select("i", chat.history_pairs(F.col("ms")).alias("p")).collect():
        assert [(x["prompt"], x["response"]) for x in r["p"]] == model_pairs(lists[r["i"]])


def test_turn_pairs_across_blocks(spark):
    rows = [("c", i + 1, "user" if i % 2 == 0 else "assistant", f"m{i}") for i in range(60)]
    df = spark.createDataFrame(rows, "conv string, place long, role string, content string")
    small = {r["turn"]: r["prompt"] for r in chat.turn_pairs(df, "conv", "place", 8, 10).collect()}
    large = {r["turn"]: r["prompt"] for r in chat.turn_pairs(df, "conv", "place", 8, 1000).collect()}
    assert small == large and len(small) == 30
    assert small[30].split("\n") == [f"{'User' if i % 2 == 0 else 'Assistant'}: m{i}" for i in range(51, 59)]


@pytest.mark.parametrize(
    "ms,reason",
    [
        ([], "empty_messages"), ([("assistant", "ab")], "must_start_user"), ([("user", "ab")], "must_end_assistant"),
        ([("user", "ab"), ("user", "ab"), ("assistant", "ab")], "messages_not_even"), ([("user", "ab"), ("assistant", "ab")], "too_few_turns"),
        ([("user", "ab"), ("user", "ab"), ("assistant", "ab"), ("assistant", "ab")], "roles_not_alternating"),
        ([("user", "ab"), ("assistant", "a"), ("user", "ab"), ("assistant", "ab")], "content_too_short"),
        ([("user", "ab"), ("assistant", "é à"), ("user", "ab"), ("assistant", "ab")], "non_ascii_content"),
        ([("user", "ab"), ("assistant", "ab"), ("user", "ab"), ("assistant", "ab")], "ok"),
    ],
)
def test_messages_reason(spark, ms, reason):
    df = spark.createDataFrame([(ms,)], "ms array<struct<role:string,content:string>>")
    assert df.select(chat.messages_reason(F.col("ms"), ascii_only=True).alias("r")).first()["r"] == reason


def brute(sets, least):
    out = {}
    for a in range(len(sets)):
        for b in range(a + 1, len(sets)):
            j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
            if j >= least - 1e-9:
                out[a, b] = round(j, 9)
    return out


@pytest.mark.parametrize("least", [0.3, 0.55, 0.8, 0.9, 1.0])
def test_similar_sets_is_exact(spark, least):
    rng = random.Random(int(least * 100))
    base = [set(rng.sample(range(40), rng.randrange(1, 15))) for _ in range(60)]
    sets = base + [{x if rng.random() > 0.1 else rng.randrange(40) for x in s} for s in base]
    df = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "id long, elements array<long>")
    got = {(r["left"], r["right"]): round(r["similarity"], 9) for r in setjoin.similar_sets(df, None, least, 10).collect()}
    assert got == brute(sets, least)


def model_accept(rows, least, per_topic, overall):
    accepted, out = [], {}
    for key, text, topic in rows:
        ws = set(__import__("re").findall(r"[\w']+", text.lower()))
        near = False
        if ws:
            pool = ([a for a in accepted if topic and a[2] == topic][-per_topic:]) + accepted[-overall:]
            near = any(a[3] and len(ws & a[3]) / len(ws | a[3]) >= least for a in pool)
        if near:
            out[key] = "near_duplicate"
        elif any(" ".join(a[1].lower().split()) == " ".join(text.lower().split()) for a in accepted):
            out[key] = "duplicate"
        else:
            out[key] = "accepted"
            accepted.append((key, text, topic, ws))
    return out


def test_sequential_accept_against_model(spark):
    rng = random.Random(9)
    rows = [(i + 1, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(0, 5))) or "...", rng.choice(["x", "y", ""])) for i in range(80)]
    df = spark.createDataFrame(rows, "line_no long, prompt string, topic string")
    got = {r["line_no"]: r["status"] for r in dedup.sequential_accept(df, "line_no", "prompt", "topic", 0.7, 3, 5).collect()}
    assert got == model_accept(rows, 0.7, 3, 5)


def test_acceptance_of_a_long_chain(spark):
    # each is near its neighbours only, so verdicts depend on each other all along
    rows = [(i, " ".join(f"w{k}" for k in range(i, i + 12)), "") for i in range(30)]
    rows += [(100 + i, "same words again", "t") for i in range(40)] + [(200, None, "t"), (201, "...", "t"), (202, "... ", "t")]
    df = spark.createDataFrame(rows, "line_no long, prompt string, topic string")
    got = {r["line_no"]: (r["status"], r["match"]) for r in dedup.sequential_accept(df, "line_no", "prompt", "topic", 0.7, 3, 5).collect()}
    assert {k: s for k, (s, _) in got.items()} == model_accept([(i, p or "", t) for i, p, t in rows], 0.7, 3, 5)
    assert got[1] == ("near_duplicate", 0) and got[139] == ("near_duplicate", 100)


def test_near_in_recent(spark):
    index = spark.createDataFrame([(1, "a b c d", "t", "1"), (2, "a b c x", "u", "2"), (3, "A B C D", "t", "3"), (4, "z", None, None), (5, "", "t", "9")], "n int, p string, t string, c string")
    probes = spark.createDataFrame([(1, "a b c d", "t"), (2, "a b q", "u"), (3, "nothing", "t"), (4, "...", "t"), (5, None, None), (6, "a b c x", "t")], "k int, p string, t string")
    got = {r["k"]: (r["found"], r["match"]) for r in dedup.near_in_recent(index, probes.withColumn("n", F.lit(0)).withColumn("c", F.lit("")), "k", "p", "t", "c", "n", 0.7).collect()}
    assert got == {1: (True, "A B C D"), 2: (False, "a b c x"), 3: (False, None), 4: (False, None), 5: (False, None), 6: (True, "a b c x")}
    assert dedup.near_in_recent(index.limit(0), probes.withColumn("n", F.lit(0)), "k", "p", "t", "c", "n").filter("found").count() == 0


def test_examples_mask_the_prompt(spark):
    df = spark.createDataFrame([(1, "Hi", "Yes"), (2, "User: Hi", "Yes"), (3, "Hi", "")], "n long, p string, r string")
    got = {r["n"]: r for r in tokens.examples(df, tokens.char_ids, "p", "r", 0).collect()}
    text = "User: Hi\nAssistant: "
    assert set(got) == {1, 2} and got[1]["input_ids"] == [ord(c) % 251 for c in text + "Yes"] == got[2]["input_ids"]
    assert got[1]["labels"] == [-100] * len(text) + [ord(c) for c in "Yes"] and got[1]["supervised"] == 3
    full = tokens.padded(tokens.batch_numbers(tokens.examples(df, tokens.char_ids, "p", "r", 22), "n", 2), 7).collect()
    assert all(len(r["input_ids"]) == len(r["labels"]) == len(r["mask"]) for r in full)


def test_any_tokenizer(spark):
    df = spark.createDataFrame([("a b c",), (None,)], "t string")
    got = df.select(tokens.token_ids(F.col("t"), lambda: lambda texts: [[len(w) for w in t.split()] for t in texts]).alias("i")).collect()
    assert [r["i"] for r in got] == [[1, 1, 1], []]


def test_teacher_bisects_and_is_bounded(spark):
    def moody(batch):
        if len(batch) > 1:
            raise TimeoutError("too many")
        return {i: f"R {p}" for i, p in batch if i != "c"}

    done, errors = teacher.ask(moody, [(x, x.upper()) for x in "abcd"])
    assert done == {"a": "R A", "b": "R B", "d": "R D"} and list(errors) == ["c"]
    requests = spark.createDataFrame([(x, x) for x in "abcd"], "id string, prompt string")
    answered = spark.createDataFrame([("a", "old"), ("b", " ")], "id string, response string")
    got = {r["id"]: r["response"] for r in teacher.generate(requests, answered, lambda: moody, 2).collect()}
    assert got == {"b": "R b", "c": None, "d": "R d"}
    matched = {r["id"]: r["outcome"] for r in teacher.match_responses(requests, spark.createDataFrame([("a", "x"), ("b", ""), ("z", "x")], "id string, response string")).collect()}
    assert matched == {"a": "succeeded", "b": "failed", "c": "failed", "d": "failed", "z": "extra"}


def test_gate(spark):
    good = spark.createDataFrame([(-1.0, -0.5, -0.1, 0.1)], "val_ppl_delta double, test_ppl_delta double, english_drift_delta double, rw_marker_density_delta double")
    assert report.gate(good).first()["passed"]
    bad = report.gate(spark.createDataFrame([(1.0,)], "val_ppl_delta double")).first()
    assert not bad["passed"] and bad["reasons"] == "val_ppl_not_improved:+1.000000;test_ppl_not_improved:+0.000000"
    assert report.cooldown(2, 0, True, 2, 2, 12) == 6 and report.cooldown(0, 0, True, 50, 2, 12) == 12


def test_exact_rank_and_sample(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 3)
    ranked = exact_rank(df, ["g"], F.xxhash64("id"), F.lit(7)).collect()
    for g in range(3):
        assert sorted(r["rank"] for r in ranked if r["g"] == g) == list(range(len([r for r in ranked if r["g"] == g])))
    assert len(hash_sample(df, "id", 50)) == 50 and len(hash_sample(df.limit(10), "id", 50)) == 10


def test_running_sum_over_blocks(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a", "b", None]), rng.randrange(3)) for i in range(200)]
    df = spark.createDataFrame(rows, "i long, g string, v long")
    got = {r["i"]: r["s"] for r in running_sum(df, F.col("v"), ["g"], "i", "s", 7).collect()}
    total = {}
    for i, g, v in rows:
        total[g] = total.get(g, 0) + v
        assert got[i] == total[g]
    alone = {r["i"]: r["s"] for r in running_sum(df, F.col("v"), [], "i", "s", 7).collect()}
    assert alone[199] == sum(v for _, _, v in rows)


def test_passes_pools_and_bootstrap(spark):
    df = spark.createDataFrame([(1, 1, None, "b", "bad"), (1, 2, "a", "b", "ok"), (1, 3, None, None, "ok"), (2, 4, "a", None, "bad")], "call int, n int, x string, y string, reason string")
    told = [r["t"] for r in df.orderBy("n").select(teacher.first_parsed([F.col("x"), F.col("y")]).alias("t")).collect()]
    assert [(t["value"], t["pass"]) if t else None for t in told] == [("b", 1), ("a", 0), None, ("a", 0)]
    assert [r["n"] for r in teacher.first_valid(df, "call", "n").collect()] == [2]
    rows = spark.createDataFrame([(1, "A b", "s1", "2"), (2, "a  B", "s2", "1"), (3, " ", "s", "0"), (5, "c", "later", None), (4, "c", "s", None)], "n int, prompt string, source string, created_at string")
    index = {r["prompt_key"]: r["first_source"] for r in dedup.bootstrap_index(rows, "prompt", "source", "created_at", "n").collect()}
    assert index == {"a b": "s2", "c": "s"}
    batch = spark.createDataFrame([(1, "A B"), (2, "new"), (3, "NEW"), (4, None)], "n int, prompt string")
    assert [r["n"] for r in dedup.add_new(dedup.bootstrap_index(rows, "prompt", "source", "created_at", "n"), batch, T.fold(F.col("prompt")), "n").collect()] == [2]
