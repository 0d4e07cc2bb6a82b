import cProfile
import pstats

import pytest
from pyspark.sql import functions as F

from millrace.llm import pairs
from millrace.llm.forms import form
from millrace.llm.language import LANGS, is_empty, label_lines, train, with_languages, wrong_label
from millrace.llm.pairs import TAGS, fit, last_message, pair_defects

RW = "Ni byiza gukurikirana ibishyimbo ku mugoroba, kuko abayobozi bishyura inama. Abatoza bahitamo imisoro ku giciro gito."
EN = "Do not forget to update tea leaves before you use the notebook. The students update taxes in the evening."
FR = "N'oubliez pas de livrer le lait frais avant de réparer les légumes. Les élèves traitent l'hygiène à la maison."
SW = "Usisahau kupima dawa kabla ya kubeba utamaduni. Kwanza jaribu kuhesabu mkutano, halafu kueleza mbuzi inavyotakiwa."


@pytest.fixture(scope="module")
def model(spark, data):
    return train(spark.read.parquet(f"{data}/lang_samples.parquet"))


@pytest.fixture(scope="module")
def tagger(spark, model):
    return fit(spark.read.parquet("/root/testdata/sf0.01/chat_seed_pairs.parquet"), "line_no", "prompt", "response", model)


def test_held_out_accuracy(model):
    assert model.held_out_accuracy >= 0.97 and set(LANGS) == {"rw", "en", "fr", "sw"}


def test_labels(model):
    told = model.label([RW, EN, FR, SW, RW + "\n" + EN, RW + " Koresha internet.", "", "123 !!", "x" * 200_000])
    assert [x for x, _ in told][:8] == ["rw", "en", "fr", "sw", "rw_mixed", "rw", None, None]
    assert all(0 <= c <= 1 for _, c in told) and min(c for _, c in told[:4]) > 0.9


def test_lines(model):
    one, two, three = label_lines(model, [f"{RW}\n\n{EN}\n- tea", f"{RW}\n{RW}", f"{RW}, {EN}\n{FR}"])
    assert [x for x, _ in one] == ["rw", "en", "en"] and two is None and three is None


def test_with_languages_cases(spark, model):
    rows = [(1, RW, "rw"), (2, RW, " RW "), (3, EN, "rw"), (4, EN, None), (5, EN, "und"), (6, FR, "control"), (7, None, "rw"), (8, "N/A", None), (9, f"{RW}\n{FR}", "rw_mixed"), (1, RW, "rw")]
    df = spark.createDataFrame([(i, t, m, "clash") for i, t, m in rows], "line_no long, response string, lang_mode string, lang string")
    got = sorted(tuple(r) for r in with_languages(df, ["line_no"], "response", "lang_mode", model, True).filter(wrong_label()).select("line_no", "seg_no", "lang").collect())
    assert got == [(3, 0, "en"), (4, 0, "en"), (5, 0, "en"), (9, 1, "rw"), (9, 2, "fr")]
    assert with_languages(df.limit(0), ["line_no"], "response", "lang_mode", model, True).count() == 0


def test_empty_marks():
    assert all(is_empty(x) for x in (None, "", " \n", "N/A", "null", "{}", '""', "-", "...", "<br>", "```\n```", "[]"))
    assert not any(is_empty(x) for x in ("Yego", "0", "😊", "a" * 100))


def test_last_message():
    assert last_message("User: a\nAssistant: b\nUser: c\nd") == "c\nd" and last_message("c") == "c" and last_message(None) == "" and last_message("Assistant: b") == ""


def test_defects(spark, tagger):
    ask_rw = "User: Ni gute Hepukiroca yafasha abaturanyi gukoresha ikiraro mbere y'uko izuba rirenga?"
    ask_en = "User: How can Hepukiroca help the neighbours to use the bridge before sunset?"
    asked = "User: Subiza mu cyongereza gusa: Ni gute Hepukiroca yafasha abaturanyi gukoresha ikiraro?"
    rows = [
        (1, ask_rw, RW, None), (2, ask_rw, None, "empty"), (3, ask_rw, "​", "empty"), (4, ask_rw, "n/a", "empty"), (5, ask_rw, ask_rw[6:], "copied"), (6, ask_rw, "> " + ask_rw[6:].upper(), "copied"),
        (7, ask_rw, f"Urabaza uti: {ask_rw[6:]} {RW}", None), (8, ask_rw, EN, "wrong_language"), (9, asked, EN, None), (10, ask_en, SW, "wrong_language"), (11, ask_en, EN, None),
        (12, ask_rw, "Mbabarira, sinshobora kugufasha kuri iki kibazo kijyanye na ikiraro. Hari ikindi nagufasha?", "refusal"), (13, ask_en, "Sorry, but I can't help with this request about the bridge.", "refusal"),
        (14, ask_en, EN + " Some people say \"I can't help with that\", yet it works.", None), (15, ask_rw, RW + " Ntukibagirwe gutunganya imiti mbe", "truncated"), (16, ask_rw, RW + " Abatoza bahitamo imisoro ku giciro gito", None),
        (17, ask_en, EN + "\n- tea\n- the bridge", None), (18, ask_rw, '{"izina": "' + RW + '", "ibisobanuro": ["' + RW, "truncated"), (19, ask_rw, "Yego, Hepukiroca.", None), (20, None, RW, None), (21, ask_rw, RW * 400, None), (1, ask_rw, RW, None),
    ]
    df = spark.createDataFrame([(i, p, r, "clash") for i, p, r, _ in rows], "line_no long, prompt string, response string, defect string")
    got = {r["line_no"]: r["defect"] for r in pair_defects(df, "line_no", "prompt", "response", tagger).collect()}
    wrong = {i: (got[i], want) for i, _, _, want in rows if got[i] != want}
    assert not wrong
    shares = pair_defects(df, "line_no", "prompt", "response", tagger).filter("line_no = 5").select(*TAGS).first()
    assert abs(sum(shares) - 1) < 1e-9 and shares["echo"] == 1
    assert pair_defects(df.limit(0), "line_no", "prompt", "response", tagger).count() == 0


def test_refusals_in_words_never_trained(spark, model, monkeypatch):
    """Of each language's stock phrases every other one is left out of training; refusals made of those are told all the same."""
    rows = spark.read.parquet("/root/testdata/sf0.01/chat_seed_pairs.parquet").select("line_no", "prompt", "response").dropna().orderBy("line_no").collect()
    plain = [(pairs.last_message(r["prompt"]), form(r["response"], True)) for r in rows]
    plain = [(m, r) for m, r in plain if m and not is_empty(r)]
    whole = dict(pairs.REFUSALS)
    known = {k: (a, "|".join(b.split("|")[::2]), c) for k, (a, b, c) in whole.items()}
    monkeypatch.setattr(pairs, "REFUSALS", known)
    half = pairs.PairTagger(plain[:1500], model)
    hit = n = 0
    for (m, _), x in zip(plain[1500:], [x for x, _ in model.label([m for m, _ in plain[1500:]])]):
        if x in whole:
            a, b, c = (y.split("|") for y in whole[x])
            text = f"{a[n % len(a)]} {b[1::2][n % len(b[1::2])].format(t='ibyo')}".strip()
            got = half.defect(half.tags([(m, f"{text[0].upper()}{text[1:]}. {c[n % len(c)]}".strip())])[0])
            n, hit = n + 1, hit + (got == "refusal")
    assert n > 200 and hit >= 0.55 * n


def test_fit_reads_every_row(spark, model, tagger):
    """3000 rows without an answer whose keys have the smallest hashes hide none of the others from the fit."""
    rows = spark.read.parquet("/root/testdata/sf0.01/chat_seed_pairs.parquet").select("line_no", "prompt", "response")
    first = rows.select(F.min(F.xxhash64("line_no"))).first()[0]
    blank = spark.range(10**8, 10**8 + 10**7).filter(F.xxhash64("id") < first).limit(3000).select(F.col("id").alias("line_no"), F.lit("User: a").alias("prompt"), F.lit("N/A").alias("response"))
    assert blank.count() == 3000
    told = fit(rows.unionByName(blank), "line_no", "prompt", "response", model)
    assert len(told.total) > 10_000 and (told.total, told.final, told.seldom, told.few) == (tagger.total, tagger.final, tagger.seldom, tagger.few)
    assert told.node.any() and (told.node == tagger.node).all() and (told.step == tagger.step).all()


def test_fit_in_blocks(spark, model, tagger):
    rows = spark.read.parquet("/root/testdata/sf0.01/chat_seed_pairs.parquet").select("line_no", "prompt", "response")
    cfg = pairs.PairConfig(piece=700, block=2)
    told = fit(rows, "line_no", "prompt", "response", model, cfg)
    assert (told.total, told.final, told.seldom) == (tagger.total, tagger.final, tagger.seldom)
    other = fit(rows.repartition(7), "line_no", "prompt", "response", model, cfg)
    assert (told.node == other.node).all() and (told.step == other.step).all()
    a, b = ({r["line_no"]: r["defect"] for r in pair_defects(rows, "line_no", "prompt", "response", t).collect()} for t in (told, tagger))
    assert sum(a[i] != b[i] for i in b) <= 0.005 * len(b)


def _spelled(t, message, response, cs, j):
    """The features of a clause but those of a response's end, spelled one by one."""
    ws, mw = ([w.lower() for w in pairs._WORD.findall(x)] for x in (cs[j], message))
    n, c, json, first, many = len(ws), cs[j], response[:1] in "{[", j == 0, len(cs)
    grams = set(zip(mw, mw[1:], mw[2:]))
    held = {k for i in range(n - 2) if tuple(ws[i : i + 3]) in grams for k in (i, i + 1, i + 2)}
    share = 1.0 if n < 3 and set(ws) <= set(mw) else len(held) / n
    lang = t.languages.label([message])[0][0]
    own, k, p = t.languages.clauses([c])
    told, size = None, 0
    for x, a, b in zip(p.argmax(1), k, p.max(1)):
        if b >= 0.9 and a >= 2:
            both = told not in (None, LANGS[x]) and min(a, size) >= 4
            told, size = ("rw_mixed", size) if both else (LANGS[x], a) if a > size else (told, size)
    asked = [x for x, names in pairs._ASKED.items() if names.search(message)]
    m = "m?" if lang in (None, "rw_mixed") or told is None else "m=" if told == lang else "masked" if told in asked else "mmixed" if told == "rw_mixed" else "m#"
    quoted = ('"' in c or "«" in c) and not json
    e = f"e{0 if share == 0 else 1 + int(share * 4.99)}"
    f = ["b", e, m, f"q{quoted}", "first" if first else "later", "only" if many == 1 else "many", f"n{min(n, 6)}", f"{e}n{min(n, 6)}", f"{m}n{min(n, 4)}", f"{e}{m}"]
    f += [f"q{int(quoted)}w{w}" for w in ws] + [f"w{a} {b}" for a, b in zip(ws, ws[1:])]
    if many <= 3:
        out = [w for w in ws if w not in mw]
        rare = int(sum(t.total.get(w, 0) <= t.seldom for w in out) / max(1, len(out)) * 4.99)
        f += [f"p{w[:2]}" for w in ws[:12]] + [f"p{w[:3]}" for w in ws] + [f"p{w[:5]}" for w in ws]
        f += [f"s{i}{w[:3]}" for i, w in enumerate(ws[:4])] + [f"r{rare}", f"r{rare}{min(n, 6)}{many}", f"o{int(len(out) / n * 4.99)}"]
    return [pairs._h(x) for x in f]


def test_features_as_spelled(tagger):
    """Ids made from numbered words and joined CRCs are those of the features' texts, whatever the script and the words' length."""
    rows = [
        ("Ni gute Hepukiroca yafasha abaturanyi gukoresha ikiraro?", RW + " Ntukibagirwe gutunganya imiti mbe"), ("How can the neighbours use the bridge before sunset?", EN + '\nThe neighbours use the bridge "before" noon'),
        ("a b c", "a b c d. a b c? ..."), ("", "x y"), ("Réponds en français : pourquoi ?", FR), ("İstanbul ΑΣ ß", "İstanbul ΑΣ ß é 3rd 123 a1b2 œuvre. Я не знаю 😊 этого"), ("w" * 300, "q" * 70 + " " + "w" * 300 + " " + "é" * 90),
        ("m", '{"izina": "' + RW + '", "ibisobanuro": ["' + RW), ("tea", "- tea\n- green tea\n- the bridge of 1999"), ("tea", "Yego (tea"), ("tea", ""), ("tea", "Yego, ni tea :)"), ("tea", "one, two, three, four, five, six, seven"),
    ]
    rows += rows[::-1]
    ids, long, sizes, words = tagger.features(rows)
    split = [tagger.clauses(r) for _, r in rows]
    assert sizes.tolist() == [len(x) for x in split] and words.tolist() == [len(pairs._WORD.findall(c)) for cs in split for c in cs]
    at = k = 0
    for (m, r), cs in zip(rows, split):
        for j in range(len(cs)):
            want, got = _spelled(tagger, m, r, cs, j), ids[at : at + long[k]].tolist()
            assert got[: len(want)] == want and (len(got) > len(want)) == (j == len(cs) - 1)
            at, k = at + long[k], k + 1
    last = ids[long[: sizes[0]].sum() - 17 : long[: sizes[0]].sum()].tolist()  # of a response that breaks off: its last words, one by one
    assert {pairs._h(x) for x in ("END", "ENDword", "END-1mbe", "END-2imiti", "END-3gutunganya", "END23gutunganya imiti", "END34ntukibagirwe gutunganya", "ENDfntukibagirweFalse", "ENDl4", "ENDfntukibagirwe-gutunganya")} <= set(last)


def test_cost(spark, model):
    """Calls of Python by training and tagging, for a row: they were over 1900 when each feature of each clause was spelled."""
    rows = spark.read.parquet("/root/testdata/sf0.01/chat_seed_pairs.parquet").select("line_no", "prompt", "response").dropna().orderBy("line_no").collect()
    plain = [(pairs.last_message(r["prompt"]), form(r["response"], True)) for r in rows]
    plain = [(m, r) for m, r in plain if m and not is_empty(r)]
    calls = cProfile.Profile()
    calls.enable()
    pairs.PairTagger(plain, model).tags(plain)
    calls.disable()
    assert pstats.Stats(calls).total_calls < 700 * len(plain)


def test_fit_on_nothing(spark, model):
    empty = spark.createDataFrame([], "line_no long, prompt string, response string")
    tagger = fit(empty, "line_no", "prompt", "response", model)
    assert pair_defects(spark.createDataFrame([(1, "User: a", None)], empty.schema), "line_no", "prompt", "response", tagger).first()["defect"] == "empty"
    assert F is not None
