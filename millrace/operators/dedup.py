"""Near-duplicates by word sets, and acceptance in order against what was accepted before.

Joins work on classes of equal word sets, so copies (even a third of all rows) are joined once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.setjoin import similar_sets
from millrace.session import release, running_max, running_sum, stage


def set_key(elements: Column) -> Column:
    """128 bits that tell sorted sets of hashes apart."""
    return F.struct(F.xxhash64(elements, F.lit(1)).alias("a"), F.xxhash64(F.lit(2), elements).alias("b"))


def word_classes(df: DataFrame, key: str, text: str, label: str = "classes") -> tuple[DataFrame, DataFrame]:
    """(members: key, class; classes: id, elements): rows with words by their word set; a class's id is its smallest key."""
    hashes = F.array_sort(F.transform(T.word_set(F.col(text)), lambda w: F.xxhash64(w)))
    rows = df.select(F.col(key).alias("key"), hashes.alias("elements")).filter(F.size("elements") > 0)
    rows = stage(rows.withColumn("set", set_key(F.col("elements"))), label)
    classes = stage(rows.groupBy("set").agg(F.min("key").alias("id"), F.first("elements").alias("elements")), f"{label}-sets")
    members = rows.select("key", "set").join(classes.select("set", F.col("id").alias("class")), "set").select("key", "class")
    return members, classes.select("id", "elements")


def near_duplicates(df: DataFrame, key: str, text: str, least: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """(members: key, class; pairs: left, right, similarity of class representatives)."""
    members, classes = word_classes(df, key, text)
    return members, similar_sets(classes, None, least)


def sequential_accept(df: DataFrame, order: str, text: str, topic: str, least: float = 0.9, per_topic: int = 200, overall: int = 400) -> DataFrame:
    """order, status (`accepted`, `near_duplicate`, `duplicate`), match: rows in order, each judged against rows accepted before.

    A row is a near duplicate if one of the last `per_topic` accepted rows of its topic, or of the last `overall` accepted
    rows, is at least so similar (`match` is the newest such row, of its topic if there is one); else a duplicate if any
    accepted row has its folded text. `order` is a unique whole number.

    Similar pairs of classes are found once. Only rows of classes that have a like, or several rows, can be refused; all
    others are accepted and count through their ranks alone. For the former, verdicts start as all accepted and are computed
    again from the verdicts before until none changes: a verdict depends on earlier rows only, so each round settles at
    least the first row that changed, rows before that aren't judged again, and the fixed point is the sequential result.
    Of a class only the latest accepted row before a row can matter, which is a running maximum over blocks of the order:
    a class of a third of all rows costs its rows, not their pairs, and is many tasks' work."""
    base = stage(df.select(F.col(order).alias("key"), F.unhex(F.md5(T.fold(F.col(text)).cast("binary"))).alias("fold"), T.norm(F.col(topic)).alias("topic"), F.col(text).alias("_text")), "accept")
    members, classes = word_classes(base, "key", "_text", "accept-classes")
    members = stage(members, "accept-members")
    alike = similar_sets(classes, None, least)
    both = F.array(*[F.struct(F.col(x).alias("x"), F.col(y).alias("y")) for x, y in (("left", "right"), ("right", "left"))])
    links = stage(alike.select(F.inline(both)), "accept-links")
    several = members.groupBy("class").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("class")
    open_classes = stage(several.union(links.select("x")).distinct(), "accept-open")
    peers = stage(links.unionByName(open_classes.select(F.col("class").alias("x"), F.col("class").alias("y"))), "accept-peers")
    rows = running_sum(base.drop("_text"), F.lit(1), [], "key", "r_all")
    rows = running_sum(rows, F.lit(1), ["topic"], "key", "r_topic").join(members.withColumnRenamed("class", "rep"), "key", "left")
    rows = stage(rows, "accept-rows")
    judged = rows.join(open_classes.withColumnRenamed("class", "rep"), "rep", "left_semi").unionByName(rows.filter("rep IS NULL"))  # without words only the text counts
    state = stage(judged.select(*rows.columns, F.lit("accepted").alias("status"), F.lit(None).cast(base.schema["key"].dataType).alias("match")), "accept-state")
    settled = None
    while True:
        bad = F.when(F.col("status") == "accepted", 0).otherwise(1)
        ranked = running_sum(running_sum(state, bad, [], "key", "bad_all"), bad, ["topic"], "key", "bad_topic")
        # accepted rows up to and with each row, of all and of its topic
        ranked = stage(ranked.withColumns({"a": F.col("r_all") - F.col("bad_all"), "b": F.col("r_topic") - F.col("bad_topic")}).drop("bad_all", "bad_topic"), "accept-ranks")
        taken = ranked.filter("status = 'accepted'").select(F.col("rep").alias("y"), "topic", (F.col("key") * 2 + 1).alias("at"), F.struct("a", "key").alias("la"), F.struct("b", "key").alias("lb"))
        asked = ranked if settled is None else ranked.filter(F.col("key") > settled)
        own = F.when(F.col("status") == "accepted", 1).otherwise(0)
        probes = asked.select("rep", "key", "topic", (F.col("a") - own).alias("pa"), (F.col("b") - own).alias("pb")).join(peers.withColumnRenamed("x", "rep"), "rep")
        events = probes.select("y", "topic", (F.col("key") * 2).alias("at"), "key", "pa", "pb").unionByName(taken, allowMissingColumns=True)
        events = running_max(running_max(events, F.col("la"), ["y"], "at", "last_all"), F.col("lb"), ["y", "topic"], "at", "last_topic")
        events = events.filter("key IS NOT NULL")
        of_topic = F.when((F.col("topic") != "") & (F.col("pb") - F.col("last_topic.b") < per_topic), F.col("last_topic.key"))
        of_all = F.when(F.col("pa") - F.col("last_all.a") < overall, F.col("last_all.key"))
        near = events.groupBy("key").agg(F.max(of_topic).alias("t"), F.max(of_all).alias("g")).select(F.col("key").alias("_near"), F.coalesce("t", "g").alias("_match")).filter("_match IS NOT NULL")
        first = ranked.filter("status = 'accepted'").groupBy("fold").agg(F.min("key").alias("_first"))
        told = ranked.join(near, ranked["key"] == near["_near"], "left").join(first, "fold", "left")
        verdict = F.when(F.col("_match").isNotNull(), "near_duplicate").when(F.col("_first") < F.col("key"), "duplicate").otherwise("accepted")
        if settled is not None:
            verdict = F.when(F.col("key") <= settled, F.col("status")).otherwise(verdict)
            told = told.withColumn("_match", F.when(F.col("key") <= settled, F.col("match")).otherwise(F.col("_match")))
        told = stage(told.select(*rows.columns, F.col("status").alias("_before"), verdict.alias("status"), F.col("_match").alias("match")), "accept-state")
        release(ranked, state)
        state = told
        settled = told.filter("status <> _before").agg(F.min("key").alias("k")).first()["k"]
        if settled is None:
            break
    refused = state.filter("status <> 'accepted'").select(F.col("key").alias("_key"), "status", "match")
    out = rows.select("key").join(refused, F.col("key") == F.col("_key"), "left")
    return out.select(F.col("key").alias(order), F.coalesce("status", F.lit("accepted")).alias("status"), "match")


def near_in_recent(index: DataFrame, probes: DataFrame, key: str, text: str, topic: str, created: str, order: str, least: float = 0.9, per_topic: int = 200, overall: int = 400) -> DataFrame:
    """key, found, match: each probe against the newest rows of an index, those of its topic first (`per_topic` of them), then
    those of all (`overall`), the newest first, each text (case aside) once. `match` is the first that is at least so
    similar, else (not found) the first of the most similar, if any word is shared. Probes without words match nothing.

    What is compared with is bounded by the two numbers, whatever the index's size: a top-k, and a ranked filter that Spark
    limits per topic before its shuffle. Probes are joined to an array of it, compared in the JVM, never one by one."""
    word_hashes = F.transform(T.word_set(F.col(text)), lambda w: F.xxhash64(w))
    made = index.select(F.col(text).alias("said"), T.norm(F.col(topic)).alias("topic"), F.col(created).alias("at"), F.col(order).alias("o"), word_hashes.alias("ws"))
    fields = F.struct("at", "o", "said", "ws")
    newest_first = lambda c: F.transform(F.sort_array(F.collect_list(c), False), lambda s: F.struct(s["said"].alias("said"), s["ws"].alias("ws")))
    tied = made.withColumn("o", -F.col("o"))  # of equal times the first in order
    everywhere = tied.orderBy(F.desc("at"), F.desc("o")).limit(overall).agg(newest_first(fields).alias("all"))
    w = Window.partitionBy("topic").orderBy(F.desc("at"), F.desc("o"))
    here = tied.filter("topic <> ''").withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_topic).groupBy("topic").agg(newest_first(fields).alias("own"))
    asked = probes.select(F.col(key), T.norm(F.col(topic)).alias("topic"), word_hashes.alias("mine"))
    told = asked.join(here, "topic", "left").join(F.broadcast(everywhere), how="cross")  # one row
    empty = F.array().cast("array<struct<said:string,ws:array<bigint>>>")
    told = told.withColumn("c", F.concat(F.coalesce("own", empty), F.coalesce("all", empty)))
    told = told.withColumn("score", F.transform("c", lambda c: F.when(F.size(c["ws"]) == 0, F.lit(0.0)).otherwise(T.jaccard(F.col("mine"), c["ws"]))))
    hit = F.array_position(F.transform("score", lambda s: s >= least), F.lit(True))
    best = F.array_max("score")
    found = (F.size("mine") > 0) & (hit > 0)
    place = F.when(found, hit).when((F.size("mine") > 0) & (best > 0), F.array_position("score", best))
    return told.select(key, found.alias("found"), F.get(F.col("c"), (place - 1).cast("int"))["said"].alias("match"))


def add_new(index: DataFrame, batch: DataFrame, key: Column, order: str) -> DataFrame:
    """Rows of a batch whose key isn't in the index and didn't come earlier in the batch."""
    keyed = batch.withColumn("prompt_key", key).filter("prompt_key <> ''")
    fresh = keyed.join(index.select("prompt_key").distinct(), "prompt_key", "left_anti")
    first = fresh.groupBy("prompt_key").agg(F.min(order).alias("_first")).select("_first")
    return fresh.join(first, fresh[order] == first["_first"], "left_semi")


def bootstrap_index(rows: DataFrame, prompt: str, source: str, created: str, order: str) -> DataFrame:
    """The index of seen prompts from rows already written: each folded prompt once, with its earliest appearance."""
    told = rows.withColumn("prompt_key", T.fold(F.col(prompt))).filter("prompt_key <> ''")
    first = F.min_by(F.struct(F.col(prompt).alias("first_prompt"), F.col(source).alias("first_source"), F.lit("").alias("topic"), F.col(created).alias("created_at")), F.struct(F.coalesce(F.col(created), F.lit("")), F.col(order)))
    return told.groupBy("prompt_key").agg(first.alias("r")).select("prompt_key", "r.*")
