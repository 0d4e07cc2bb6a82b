"""Problem 4: splits that keep related records together.

Every record gets the key of its entity, here its conversation: the id its record id carries, else its conversation_id
brought to the one right form (prefixes, case, separators, turn suffixes and invisible characters aside), else itself.
The records of a key are a component, and a component goes to one split.

Components of the same size and label profile are interchangeable, so they are bundled. Sizes up to `exact` are bundles of
their own, larger ones share a bundle with sizes within a tenth, so the driver sees a few hundred sizes for each of the
`flow_profiles` labels with most rows, whatever the data. A min-cost flow allocates their rows: source -> profile (and the
splits its components fit into) -> (profile, split) -> split -> sink, where rows beyond a profile's share of a split cost 1
and rows beyond a split's quota cost more, and a component larger than a split's quota has no way to it. A profile's flow
is divided among its bundles in proportion and rounded to whole components; what is left over goes, largest first, where
the quota lacks most. Members of a bundle are dealt by the rank of their key's hash, so the same data give the same splits.

Components come in three steps, and each step's quotas are what the steps before really left: those of rarer labels, dealt
within each label at even spacing of its rows in hash order (no label loses its stratification, and none of them reaches
the driver); large ones; small ones, whose exact sizes make up for what the others missed.

A component may hold a third of all rows: sizes come from partial aggregates, the few components of a thousandth of all
rows and more are joined by a broadcast (there are at most a thousand), the rest by their key. Rows with neither id are
components of one. Null labels are a label of their own; repeated rows count; extra columns aren't touched, but a `split` among them is
replaced.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.forms import form_column
from millrace.session import exact_rank, running_sum, stage

_HEX = "([0-9a-f]{16})"


@dataclass(frozen=True)
class SplitConfig:
    ratios: tuple[tuple[str, float], ...] = (("train", 0.90), ("val", 0.05), ("test", 0.05))
    flow_profiles: int = 64
    exact: int = 32
    slice_rows: int = 50_000


def conversation_key(record_id: Column, conversation_id: Column) -> Column:
    """The right id of a record's conversation (`ch_` and 16 hex digits), or null."""
    of_record = F.regexp_extract(F.lower(form_column(record_id)), rf"^\W*ch[_-]?{_HEX}(?:[_-]?t?\d*)?\W*$", 1)
    of_conversation = F.regexp_extract(F.lower(form_column(conversation_id)), rf"(?:^|[^0-9a-z]|ch[_-]?){_HEX}(?![0-9a-f])", 1)
    digits = F.coalesce(F.nullif(of_record, F.lit("")), F.nullif(of_conversation, F.lit("")))
    return F.concat(F.lit("ch_"), digits)


class _Flow:
    """Min-cost flow by shortest augmenting paths (costs are small whole numbers)."""

    def __init__(self, n: int):
        self.arcs: list[list[int]] = []  # to, capacity, cost; the reverse arc follows at index ^ 1
        self.out: list[list[int]] = [[] for _ in range(n)]

    def arc(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, s: int, t: int) -> None:
        n = len(self.out)
        height = [0] * n
        while True:
            far, via, heap = [None] * n, [-1] * n, [(0, s)]
            far[s] = 0
            while heap:
                d, a = heapq.heappop(heap)
                if d > far[a]:
                    continue
                for k in self.out[a]:
                    b, capacity, cost = self.arcs[k]
                    if capacity > 0:
                        x = d + cost + height[a] - height[b]
                        if far[b] is None or x < far[b]:
                            far[b], via[b] = x, k
                            heapq.heappush(heap, (x, b))
            if far[t] is None:
                return
            for i in range(n):
                if far[i] is not None:
                    height[i] += far[i]
            path, b = [], t
            while b != s:
                path.append(via[b])
                b = self.arcs[via[b] ^ 1][0]
            amount = min(self.arcs[k][1] for k in path)
            for k in path:
                self.arcs[k][1] -= amount
                self.arcs[k ^ 1][1] += amount


def allocate(bundles: list[tuple[int, str, int]], ratios: tuple[tuple[str, float], ...], quotas: list[int] | None = None, room: list[int] | None = None) -> list[list[int]]:
    """For bundles (size, profile, components): components per split. quotas: rows each split is to get (by the ratios, if
    not given); room: the size a component may have at most to fit a split (the quotas, if not given)."""
    total = sum(s * n for s, _, n in bundles)
    quotas = quotas or _shares(total, [r for _, r in ratios])
    room = room or quotas
    largest = max(range(len(room)), key=room.__getitem__)
    fits = [tuple(size <= q for q in room) for size, _, _ in bundles]
    fits = [f if any(f) else tuple(k == largest for k in range(len(room))) for f in fits]
    groups = sorted({(p, f) for (_, p, _), f in zip(bundles, fits)})  # bundles of a group are one to the flow
    of = {g: i for i, g in enumerate(groups)}
    profiles = sorted({p for _, p, _ in bundles})
    rows_in, rows_of = [0] * len(groups), dict.fromkeys(profiles, 0)
    for (size, p, n), f in zip(bundles, fits):
        rows_in[of[p, f]] += size * n
        rows_of[p] += size * n
    p0 = 1 + len(groups)
    s0 = p0 + len(profiles) * len(ratios)
    sink = s0 + len(ratios)
    flow, ways = _Flow(sink + 1), []
    for i, (p, f) in enumerate(groups):
        flow.arc(0, 1 + i, rows_in[i], 0)
        ways.append([flow.arc(1 + i, p0 + profiles.index(p) * len(ratios) + k, rows_in[i], 0) if f[k] else None for k in range(len(ratios))])
    for j, p in enumerate(profiles):
        for k, x in enumerate(_shares(rows_of[p], [r for _, r in ratios])):
            node = p0 + j * len(ratios) + k
            flow.arc(node, s0 + k, x, 0)
            flow.arc(node, s0 + k, rows_of[p], 1)
    for k, q in enumerate(quotas):
        flow.arc(s0 + k, sink, q, 0)
        flow.arc(s0 + k, sink, total, 10)
    flow.run(0, sink)
    out, left = [], []
    filled = [0] * len(ratios)
    for i, (size, p, n) in enumerate(bundles):
        g = of[p, fits[i]]
        given = [0 if w is None else flow.arcs[w ^ 1][1] * n // max(1, rows_in[g]) for w in ways[g]]  # rows of the flow / rows of the group * components
        out.append(given)
        left += [(size, i)] * (n - sum(given))
        for k, x in enumerate(given):
            filled[k] += x * size
    for size, i in sorted(left, reverse=True):
        open_ = [k for k in range(len(ratios)) if fits[i][k]]
        k = max(open_, key=lambda k: (min(0, quotas[k] - filled[k] - size), quotas[k] - filled[k]))
        out[i][k] += 1
        filled[k] += size
    for size, i in sorted(((b[0], i) for i, b in enumerate(bundles)), reverse=True):  # rounding's last rows
        for k in range(len(ratios)):
            for j in range(len(ratios)):
                n = min(out[i][k], max(0, filled[k] - quotas[k]) // size, max(0, quotas[j] - filled[j]) // size) if fits[i][j] else 0
                if n > 0:
                    out[i][k], out[i][j] = out[i][k] - n, out[i][j] + n
                    filled[k], filled[j] = filled[k] - n * size, filled[j] + n * size
    return out


def _rest(quotas: list[int], taken: list[int], total: int) -> list[int]:
    """What the splits still want of `total` rows, none less than nothing."""
    open_ = [max(0, q - t) for q, t in zip(quotas, taken)]
    return open_ if sum(open_) == total else _shares(total, [float(x) for x in open_]) if sum(open_) else _shares(total, [1.0] * len(open_))


def _shares(total: int, ratios: list[float]) -> list[int]:
    """Whole parts of a total in the ratios, by largest remainder."""
    exact = [total * r / sum(ratios) for r in ratios]
    whole = [int(x) for x in exact]
    for k in sorted(range(len(exact)), key=lambda k: whole[k] - exact[k])[: total - sum(whole)]:
        whole[k] += 1
    return whole


def assign_splits(rows: DataFrame, key: str, component: str, label: str, cfg: SplitConfig = SplitConfig()) -> DataFrame:
    """`rows` (of a unique `key`, with a `component`, null for a row of its own) and `split`."""
    names = [name for name, _ in cfg.ratios]
    own = F.concat(F.lit("row:"), F.col(key).cast("string"))
    keyed = stage(rows.drop("split").withColumn("_component", F.coalesce(component, own)), "split-rows")
    sized = keyed.groupBy("_component").agg(F.count(F.lit(1)).alias("size"), F.min(F.coalesce(F.lower(F.trim(label)), F.lit(""))).alias("profile"))
    sized = stage(sized, "split-components")
    common = sized.groupBy("profile").agg(F.sum("size").alias("n")).orderBy(F.desc("n"), "profile").limit(cfg.flow_profiles).select("profile")
    common = stage(common, "split-profiles")
    told = sized.agg(F.sum("size").alias("n")).first()
    total = told["n"] or 0
    if not total:
        return keyed.drop("_component").withColumn("split", F.lit(None).cast("string"))
    quotas = _shares(total, [r for _, r in cfg.ratios])
    rare = sized.join(F.broadcast(common), "profile", "left_anti")  # at most flow_profiles rows are sent
    frequent = sized.join(F.broadcast(common), "profile", "left_semi")
    step = F.when(F.col("size") <= cfg.exact, F.col("size")).otherwise(cfg.exact + 1 + F.floor(F.log(F.col("size") / cfg.exact) / math.log(1.1)))
    frequent = frequent.withColumn("class", step.cast("long"))

    def rows_of(plan: DataFrame) -> list[int]:
        got = {r["split"]: r["n"] for r in plan.groupBy("split").agg(F.sum("size").alias("n")).collect()}
        return [got.get(name, 0) for name in names]

    plans = [stage(_even(rare, quotas, cfg), "split-rare")]
    taken = rows_of(plans[0])
    for large in (True, False):
        part = frequent.filter(F.col("class") > cfg.exact if large else F.col("class") <= cfg.exact)
        found = part.groupBy("class", "profile").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("rows")).orderBy(F.desc("class"), "profile").collect()
        if not found:
            continue
        bundles = [(max(1, round(r["rows"] / r["n"])), r["profile"], r["n"]) for r in found]
        mine = sum(s * n for s, _, n in bundles)
        wanted = _shares(mine, [r for _, r in cfg.ratios]) if large else _rest(quotas, taken, mine)
        plan = []
        for r, given in zip(found, allocate(bundles, cfg.ratios, wanted, quotas)):
            plan.append((r["class"], r["profile"], r["n"] // cfg.slice_rows + 1, [sum(given[: k + 1]) for k in range(len(given))]))
        planned = F.broadcast(rows.sparkSession.createDataFrame(plan, "class long, profile string, width long, ends array<long>"))  # a row a bundle
        ranked = exact_rank(part.join(planned, ["class", "profile"]), ["class", "profile"], F.xxhash64("_component"), F.col("width"))
        split = F.lit(None).cast("string")
        for k, name in reversed(list(enumerate(names))):
            split = F.when(F.col("rank") < F.col("ends")[k], name).otherwise(split)
        plans.append(stage(ranked.select("_component", "size", split.alias("split")), "split-plan"))
        taken = [a + b for a, b in zip(taken, rows_of(plans[-1]))]
    decided = plans[0]
    for plan in plans[1:]:
        decided = decided.unionByName(plan)
    large = decided.filter(F.col("size") * 1000 >= total).select("_component", F.col("split").alias("_large"))  # at most 1000
    with_large = keyed.join(F.broadcast(large), "_component", "left")
    done = with_large.filter("_large IS NOT NULL").withColumnRenamed("_large", "split")
    rest = with_large.filter("_large IS NULL").drop("_large").join(decided.filter(F.col("size") * 1000 < total).select("_component", "split"), "_component")
    return done.unionByName(rest).drop("_component")


def _even(components: DataFrame, quotas: list[int], cfg: SplitConfig) -> DataFrame:
    """_component, size, split: each label's components in hash order, a split's by the place of their middle row on the
    label's rows, turned by the label's own hash so that labels of a few rows don't all begin with the same split."""
    placed = running_sum(components.withColumn("_h", F.xxhash64("_component")), F.col("size"), ["profile"], "_h", "_until", 2**54)
    whole = components.groupBy("profile").agg(F.sum("size").alias("_whole"))
    turn = (F.xxhash64("profile").cast("double") + 2.0**63) / 2.0**64
    place = (F.col("_until") - F.col("size") / 2) / F.col("_whole") + turn
    place = place - F.floor(place)
    largest = cfg.ratios[max(range(len(quotas)), key=quotas.__getitem__)][0]
    ends, cases = 0.0, None
    for (name, ratio), quota in zip(cfg.ratios, quotas):
        ends += ratio / sum(r for _, r in cfg.ratios)
        told = F.when(F.col("size") <= quota, name).otherwise(largest)
        cases = F.when(place < ends, told) if cases is None else cases.when(place < ends, told)
    return placed.join(whole, "profile").select("_component", "size", cases.otherwise(largest).alias("split"))


def split_report(assigned: DataFrame, component: str) -> DataFrame:
    """Per split: rows, components."""
    per = assigned.groupBy("split", component).agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("split").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_components"))
