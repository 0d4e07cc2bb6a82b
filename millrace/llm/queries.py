"""The pN_ queries: each problem's operator over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import table

Query = Callable[[SparkSession, str], DataFrame]
#: Rows of the small tables of targets and capacities that the driver takes
MAX_SMALL = 10_000


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.forms import lookalike_pairs

    return lookalike_pairs(table(spark, d, "chat_seed_pairs"), "line_no", ["prompt", "response"])


def p1_forms(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.forms import with_forms

    return with_forms(table(spark, d, "chat_seed_pairs").select("line_no", "prompt", "response"), ["prompt", "response"]).select("line_no", "prompt_form", "response_form")



def p10_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.residue import with_residue

    return with_residue(table(spark, d, "documents").select("doc_id", "text")).filter("kind IS NOT NULL").select("doc_id", "kind")


def p10_clean(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.residue import clean_corpus

    return clean_corpus(table(spark, d, "documents")).select("doc_id", "source", "n_chars")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.leaks import leaked_passages

    return leaked_passages(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_report(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.leaks import leak_report
    from millrace.session import stage

    found = stage(p9_found(spark, d), "leaks")
    return leak_report(found, table(spark, d, "eval_items"), table(spark, d, "documents"))


def _languages(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.language import train, with_languages

    model = train(table(spark, d, "lang_samples"))
    parts = []
    for name, text, lines in (("chat_seed_pairs", "response", True), ("prompt_seed_final", "prompt", False)):
        labelled = with_languages(table(spark, d, name), ["line_no"], text, "lang_mode", model, lines)
        parts.append(labelled.select(F.lit(name).alias("tab"), "*"))
    return parts[0].unionByName(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.language import wrong_label

    return _languages(spark, d).filter(wrong_label()).select("tab", "line_no", "seg_no", "lang")


def p6_labels(spark: SparkSession, d: str) -> DataFrame:
    return _languages(spark, d).select("tab", "line_no", "seg_no", "lang", F.round("confidence", 4).alias("confidence"))


def _defects(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.language import train
    from millrace.llm.pairs import fit_and_tag

    return fit_and_tag(table(spark, d, "chat_seed_pairs"), "line_no", "prompt", "response", train(table(spark, d, "lang_samples")))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _defects(spark, d).filter("defect IS NOT NULL").select("line_no", "defect")


def p2_coverage(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.pairs import TAGS

    return _defects(spark, d).select("line_no", "defect", *[F.round(t, 4).alias(t) for t in TAGS])


def _repetition(spark: SparkSession, d: str, every: bool) -> DataFrame:
    from millrace.llm.repetition import fit, with_repetition

    raw = table(spark, d, "generated_raw")
    return with_repetition(raw, "line_no", "response", fit(raw, "line_no", "response"), every)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _repetition(spark, d, False).filter("flagged AND share >= 0.3").select("line_no")


def p3_share(spark: SparkSession, d: str) -> DataFrame:
    return _repetition(spark, d, True).select("line_no", "share")


def _evaluation(spark: SparkSession, d: str) -> DataFrame:
    val, test = (table(spark, d, f"sft_{s}").select("line_no", "prompt", "source", F.lit(s).alias("split")) for s in ("val", "test"))
    return val.unionByName(test)


def _overlaps(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.overlap import split_overlaps

    return split_overlaps(_evaluation(spark, d), table(spark, d, "sft_train"), "line_no", "prompt")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _overlaps(spark, d).select(F.least("eval_key", "train_key").alias("line_no_a"), F.greatest("eval_key", "train_key").alias("line_no_b"))


def p5_report(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.overlap import overlap_report

    return overlap_report(_overlaps(spark, d), _evaluation(spark, d), "line_no", "split", "source")


def _splits(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.splits import assign_splits, conversation_key

    pairs = table(spark, d, "chat_seed_pairs").select("line_no", F.col("conversation_id").alias("written"), conversation_key(F.col("id"), F.col("conversation_id")).alias("conversation_id"), "source")
    return assign_splits(pairs, "line_no", "conversation_id", "source")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    other = F.col("written").isNull() | (F.col("written") != F.col("conversation_id"))
    return _splits(spark, d).filter(F.col("conversation_id").isNotNull() & other).select("line_no", "conversation_id")


def p4_splits(spark: SparkSession, d: str) -> DataFrame:
    return _splits(spark, d).select("line_no", "conversation_id", "split")


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows of each split, and how many conversations stand in it and in another one too."""
    assigned = _splits(spark, d)
    apart = assigned.filter("conversation_id IS NOT NULL").groupBy("conversation_id").agg(F.min("split").alias("a"), F.max("split").alias("b")).filter("a <> b")
    marked = assigned.join(apart.select("conversation_id", F.lit(1).alias("_apart")), "conversation_id", "left")
    return marked.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count("_apart").alias("n_apart"))


def _capacities(spark: SparkSession, d: str) -> dict[str, int]:
    """All capacities: a table of a few rows by its meaning; the driver refuses it (and drops nothing) where it isn't."""
    rows = table(spark, d, "pack_capacity").orderBy("pack_name").limit(MAX_SMALL + 1).collect()
    if len(rows) > MAX_SMALL:
        raise ValueError(f"more than {MAX_SMALL} capacities: pack them in several calls")
    return {r["pack_name"]: r["capacity_tokens"] for r in rows}


def p8_packs(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.packing import pack, token_counts

    return pack(token_counts(table(spark, d, "documents"), "doc_id", "text"), "doc_id", "n_tokens", _capacities(spark, d))


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    from millrace.llm.packing import pack_report

    return pack_report(p8_packs(spark, d), _capacities(spark, d))


def _matched(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    from millrace.llm.sampling import Target, category, matched_sample
    from millrace.session import stage

    rows = table(spark, d, "prompt_seed_final").filter("id IS NOT NULL")
    rows = rows.select("id", "line_no", F.coalesce(category(F.col("content_type")), category(F.col("task_type"))).alias("content_type"), category(F.col("topic")).alias("topic"))
    rows = stage(rows, "seeds")
    first = rows.groupBy("id").agg(F.min_by(F.struct("content_type", "topic"), "line_no").alias("r")).select("id", "r.*")
    told = table(spark, d, "mix_target").orderBy("dim_name", "category").limit(MAX_SMALL + 1).collect()
    if len(told) > MAX_SMALL:
        raise ValueError(f"more than {MAX_SMALL} targets: their cells wouldn't fit the driver")
    targets = [Target(r["dim_name"], r["category"].strip().lower(), r["target_pct"] / 100, r["min_rows"]) for r in told]
    size = max((r["sample_rows"] for r in told), default=0)
    sample, report = matched_sample(first, "id", ["content_type", "topic"], targets, size)
    # an id whose rows differ counts for each of its categories
    seen = rows.select("id", F.inline(F.array(*[F.struct(F.lit(c).alias("dim_name"), F.col(c).alias("category")) for c in ("content_type", "topic")]))).distinct()
    counts = seen.groupBy("dim_name", "category").agg(F.count(F.lit(1)).alias("n_ids"))
    named = F.broadcast(spark.createDataFrame([(r["dim_name"], r["category"], r["category"].strip().lower()) for r in told], "dim_name string, written string, category string"))
    report = report.join(counts, ["dim_name", "category"], "left").withColumn("available", F.coalesce("n_ids", F.lit(0))).drop("n_ids")
    return sample, report.join(named, ["dim_name", "category"]).drop("category").withColumnRenamed("written", "category")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d)[1].filter("available < wanted").select("dim_name", "category")


def p7_sample(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d)[0].select("id", "content_type", "topic")


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return _matched(spark, d)[1].select("dim_name", "category", "wanted", "available", "sampled", "gap")


def p7_gaps(spark: SparkSession, d: str) -> DataFrame:
    """Categories of which the sample has fewer rows than wanted, and how many."""
    return _matched(spark, d)[1].filter("gap > 0").select("dim_name", "category", "wanted", "available", "gap")


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1:2].isdigit() and callable(v)}


_REPEATED = r"""(WITH w AS (SELECT line_no, regexp_extract_all(lower(coalesce(response, '')), '\p{L}+') AS ws FROM generated_raw),
  g AS (SELECT line_no, i, list_slice(ws, i, i + 4) AS gram FROM (SELECT line_no, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
  r AS (SELECT line_no, i FROM g QUALIFY row_number() OVER (PARTITION BY line_no, gram ORDER BY i) > 1),
  c AS (SELECT line_no, count(DISTINCT i + k) AS n FROM r, range(5) AS t(k) GROUP BY line_no)
  SELECT w.line_no, CASE WHEN len(ws) > 0 THEN coalesce(c.n, 0)::DOUBLE / len(ws)::DOUBLE ELSE 0.0::DOUBLE END AS share FROM w LEFT JOIN c ON w.line_no = c.line_no)"""


def _looks(column: str) -> str:
    """A text in the form in which words are compared: composed, without invisible characters, wide and look-alike letters plain."""
    from millrace.llm.forms import LOOKALIKES

    plain = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94) if chr(0x21 + i) != "'"} | {x[0]: x[1] for pairs in LOOKALIKES.values() for x in pairs.split()}
    bare = rf"regexp_replace({column}, '[\x{{ad}}\x{{200b}}-\x{{200f}}\x{{2060}}-\x{{206f}}\x{{feff}}]', '', 'g')"
    return f"nfc_normalize(translate({bare}, '{''.join(plain)}', '{''.join(plain.values())}'))"


_TRIM = r"nullif(lower(regexp_replace({}, '^[\s\x{{a0}}\x{{2000}}-\x{{200f}}\x{{202f}}\x{{2060}}\x{{3000}}\x{{feff}}]+|[\s\x{{a0}}\x{{2000}}-\x{{200f}}\x{{202f}}\x{{2060}}\x{{3000}}\x{{feff}}]+$', '', 'g')), '')"


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express, the same by definition."""
    content = f"coalesce({_TRIM.format('content_type')}, {_TRIM.format('task_type')})"
    seen = f"(SELECT 'content_type' AS dim_name, {content} AS c, id FROM prompt_seed_final UNION ALL SELECT 'topic', {_TRIM.format('topic')}, id FROM prompt_seed_final)"
    counts = f"(SELECT dim_name, c, count(DISTINCT id) AS n FROM {seen} WHERE id IS NOT NULL GROUP BY dim_name, c)"
    overlap = rf"""WITH s AS (SELECT 0 AS t, line_no, prompt FROM sft_train UNION ALL SELECT 1, line_no, prompt FROM sft_val UNION ALL SELECT 1, line_no, prompt FROM sft_test),
  w AS (SELECT t, line_no, list_distinct(regexp_extract_all(lower({_looks('prompt')}), '[\p{{L}}\p{{N}}]+')) AS ws FROM s),
  u AS (SELECT t, line_no, len(ws) AS n, unnest(ws) AS w FROM w)
  SELECT least(a.line_no, b.line_no) AS line_no_a, greatest(a.line_no, b.line_no) AS line_no_b FROM u a JOIN u b ON a.w = b.w AND a.t = 0 AND b.t = 1
  GROUP BY a.line_no, b.line_no, a.n, b.n HAVING count(*) >= 0.8::DOUBLE * (a.n + b.n - count(*)) - 1e-9"""
    return {
        "p5_found": overlap,
        # each split has its quota to the row (largest remainders), no conversation is in two
        "p4_report": """WITH n AS (SELECT count(*) AS n FROM chat_seed_pairs), q AS (SELECT s, i, n, n * r AS x FROM n, (VALUES ('train', 0, 0.9::DOUBLE), ('val', 1, 0.05::DOUBLE), ('test', 2, 0.05::DOUBLE)) AS v(s, i, r))
  SELECT s AS split, floor(x)::BIGINT + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, i) <= n - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS n_rows, 0::BIGINT AS n_apart FROM q""",
        # only what isn't there is missing
        "p7_gaps": f"""SELECT * FROM (SELECT m.dim_name, m.category, greatest(m.min_rows, ceil(m.target_pct * m.sample_rows / 100.0))::BIGINT AS wanted, coalesce(s.n, 0)::BIGINT AS available,
  greatest(m.min_rows, ceil(m.target_pct * m.sample_rows / 100.0))::BIGINT - coalesce(s.n, 0)::BIGINT AS gap FROM mix_target m LEFT JOIN {counts} s ON s.dim_name = m.dim_name AND s.c = lower(trim(m.category))) WHERE gap > 0""",
        "p3_share": f"SELECT line_no, share FROM {_REPEATED}",
        "p3_found": f"SELECT line_no FROM {_REPEATED} WHERE share >= 0.3::DOUBLE",
        "p4_found": "SELECT line_no, substr(id, 1, 19) AS conversation_id FROM chat_seed_pairs WHERE conversation_id IS DISTINCT FROM substr(id, 1, 19)",
        "p7_found": f"""SELECT m.dim_name, m.category FROM mix_target m LEFT JOIN {counts} s ON s.dim_name = m.dim_name AND s.c = lower(trim(m.category))
  WHERE coalesce(s.n, 0) < greatest(m.min_rows, ceil(m.target_pct * m.sample_rows / 100.0))""",
    }
