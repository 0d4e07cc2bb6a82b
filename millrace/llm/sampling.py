"""Problem 7: a sample whose shares of each category match targets.

1. Each record is one unit (repeated ids count once, the first row holds). Its cell is its category in every dimension;
   categories without a target are one cell value, so the table of cells is bounded by the targets, not by the data.
2. Iterative proportional fitting rakes the cells' expected counts to the margins of all dimensions in turn, never above
   what a cell has; what one cell can't give goes to others.
3. A unit of a cell with expected share p of its units gets the weight -ln(1 - p) and the key e / weight, e exponential
   from the hash of its id: the `size` smallest keys are the sample. Within a cell keys run as hashes do, so the sample is
   told by a count per cell. Those come from counts of keys below thresholds, refined by bisection of a bounded table,
   without collecting or sorting units.
4. A category below its minimum or the whole rows of its share (or what it has, if less) takes further units of its cells,
   and cells above their expectation give back as many, as long as no other category falls below its own.
5. Units of a cell with a rank (by hash, exact, no cell in one task) below the count are the sample; the report tells
   what each category should have, has, got, and lacks.

Categories are compared trimmed and lower-cased; nulls and blanks are categories without a target; records with a null id
are no units. Where fewer units exist than the sample's size, all are taken. Other columns of the units are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import exact_rank, stage

_BLANK = r"(?U)^[\s\u200b-\u200f\u2060\ufeff]+|[\s\u200b-\u200f\u2060\ufeff]+$"


@dataclass(frozen=True)
class Target:
    dim: str
    category: str
    share: float
    least: int


@dataclass(frozen=True)
class SampleConfig:
    rounds: int = 500
    slice_rows: int = 50_000
    buckets: int = 4096


def category(x: Column) -> Column:
    """A category as compared: trimmed, lower-cased, null if blank."""
    return F.nullif(F.lower(F.regexp_replace(x, _BLANK, "")), F.lit(""))


def rake(have: np.ndarray, codes: np.ndarray, shares: list[np.ndarray], size: int, rounds: int) -> np.ndarray:
    """Expected counts of cells (with units `have`, category codes per dimension, -1 for none) whose margins meet the
    shares of `size`, as near as `0 <= count <= have` allows."""
    x = have.astype(float).copy()
    for _ in range(rounds):
        before = x.copy()
        for d, share in enumerate(shares):
            now = np.bincount(codes[:, d] + 1, weights=x, minlength=len(share) + 1)[1:]
            factor = np.concatenate(([0.0], np.where(now > 0, share * size / np.maximum(now, 1e-12), 0.0)))
            x = np.minimum(x * factor[codes[:, d] + 1], have)
        if np.abs(x - before).max(initial=0.0) < 1e-6:
            break
    lack = min(size, have.sum()) - x.sum()
    for _ in range(50):  # what the margins can't hold goes where units are left, in proportion
        room = have - x
        if lack <= 1e-6 or room.sum() <= 0:
            break
        give = np.minimum(room, (x + 1e-9 * have) / (x + 1e-9 * have)[room > 0].sum() * lack * (room > 0))
        x += give
        lack -= give.sum()
    return x


def repair(counts: np.ndarray, have: np.ndarray, codes: np.ndarray, least: list[np.ndarray], expected: np.ndarray, paid: bool = False) -> np.ndarray:
    """Counts in which every category has its minimum, or all it has, for as many units given back elsewhere. paid: only as
    far as units can be given back."""
    counts = counts.copy()

    def margins(d: int) -> np.ndarray:
        return np.bincount(codes[:, d] + 1, weights=counts, minlength=len(least[d]) + 1)[1:]

    for d, need in enumerate(least):
        for c in np.argsort(-need, kind="stable"):
            mine = codes[:, d] == c
            lack = int(min(need[c], have[mine].sum()) - counts[mine].sum())
            for cell in sorted(np.flatnonzero(mine), key=lambda i: counts[i] - expected[i]):
                if lack <= 0:
                    break
                take = int(min(lack, have[cell] - counts[cell]))
                counts[cell] += take
                lack -= take
                back, at = take, cell
                for other in sorted(np.flatnonzero(counts > 0), key=lambda i: expected[i] - counts[i]):
                    if back <= 0:
                        break
                    if mine[other]:
                        continue
                    spare = counts[other]
                    for e in range(len(least)):
                        if codes[other, e] >= 0:
                            spare = min(spare, margins(e)[codes[other, e]] - least[e][codes[other, e]])
                    give = int(max(0, min(back, spare)))
                    counts[other] -= give
                    back -= give
                if paid and back > 0:
                    counts[at] -= back
                    lack += back
    return counts


def matched_sample(units: DataFrame, key: str, dims: list[str], targets: list[Target], size: int, cfg: SampleConfig = SampleConfig()) -> tuple[DataFrame, DataFrame]:
    """(sample, report). units: one row per `key`, with a category column per dimension."""
    spark = units.sparkSession
    cats = {d: [t.category for t in targets if t.dim == d] for d in dims}
    share = [np.array([t.share for t in targets if t.dim == d]) for d in dims]
    least = [np.array([t.least for t in targets if t.dim == d]) for d in dims]
    code = lambda d: F.coalesce(*[F.when(F.col(d) == c, F.lit(i)) for i, c in enumerate(cats[d])], F.lit(-1))
    cells_of = [f"_{d}" for d in dims]
    coded = stage(units.select(key, *dims).withColumns({f"_{d}": code(d) for d in dims}).withColumn("_h", F.xxhash64(F.col(key))), "sample-units")
    unit = (F.col("_h").cast("double") + F.lit(2.0**63) + F.lit(0.5)) / F.lit(2.0**64)
    exponential = -F.log(F.greatest(F.lit(2.0**-60), 1 - unit))
    told = coded.groupBy(*cells_of).agg(F.count(F.lit(1)).alias("n")).orderBy(*cells_of).collect()
    codes = np.array([[r[c] for c in cells_of] for r in told], int).reshape(len(told), len(dims))
    have = np.array([r["n"] for r in told], float)
    expected = rake(have, codes, share, size, cfg.rounds)
    part = np.divide(expected, have, out=np.zeros_like(have), where=have > 0)
    weight = -np.log1p(-np.minimum(part, 1 - 1e-12))
    counts = np.zeros(len(told))
    if len(told):
        weights = F.broadcast(spark.createDataFrame([(*map(int, c), float(w)) for c, w in zip(codes, weight)], ", ".join([*[f"`{c}` int" for c in cells_of], "_w double"])))
        keyed = coded.select(*cells_of, exponential.alias("_e")).join(weights, cells_of).filter("_w > 0").withColumn("_key", F.col("_e") / F.col("_w"))
        counts = _below(keyed, cells_of, [tuple(map(int, c)) for c in codes], min(size, int(have.sum())), cfg.buckets)
        counts = np.minimum(counts, have)
        # chance leaves categories off their share; where units are left, each gets its whole rows
        due = [np.maximum(m, np.floor(s * min(size, have.sum()) + 1e-9)) for m, s in zip(least, share)]
        counts = repair(repair(counts, have, codes, least, expected), have, codes, due, expected, True)
    chosen = [(*map(int, c), int(n), int(h) // cfg.slice_rows + 1) for c, n, h in zip(codes, counts, have) if n > 0]
    plan = F.broadcast(spark.createDataFrame(chosen, ", ".join([*[f"`{c}` int" for c in cells_of], "_take long", "_width long"])))
    ranked = exact_rank(coded.join(plan, cells_of), cells_of, F.col("_h"), F.col("_width"), "_rank")
    sample = ranked.filter("_rank < _take").drop("_h", "_take", "_width", "_rank", *cells_of)
    rows = []
    for d, (dim, s, m) in enumerate(zip(dims, share, least)):
        for i, c in enumerate(cats[dim]):
            mine = codes[:, d] == i
            wanted = int(max(m[i], math.ceil(s[i] * size - 1e-9)))
            rows.append((dim, c, wanted, int(have[mine].sum()), int(counts[mine].sum())))
    report = spark.createDataFrame(rows, "dim_name string, category string, wanted long, available long, sampled long")
    return sample, report.withColumn("gap", F.greatest(F.col("wanted") - F.col("sampled"), F.lit(0)))


def _below(keyed: DataFrame, by: list[str], cells: list[tuple], size: int, buckets: int) -> np.ndarray:
    """Per cell, the number of the `size` smallest keys that lie in it."""
    place = {c: i for i, c in enumerate(cells)}
    low, high, sure = 0.0, 64.0, np.zeros(len(cells))
    for _ in range(6):
        width = (high - low) / buckets
        inside = keyed.filter((F.col("_key") >= low) & (F.col("_key") < high)).withColumn("\u0001bucket", F.least(F.floor((F.col("_key") - low) / width), F.lit(buckets - 1)))
        table = inside.groupBy(*by, "\u0001bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        per = np.zeros((buckets, len(cells)))
        for r in table:
            per[r["\u0001bucket"], place[tuple(r[c] for c in by)]] += r["n"]
        total = np.cumsum(per.sum(1)) + sure.sum()
        at = int(np.searchsorted(total, size, side="left"))
        if at == buckets:  # fewer keys than wanted
            return sure + per.sum(0)
        sure = sure + per[:at].sum(0)
        rest = size - sure.sum()
        if per[at].sum() == rest or width < 1e-12:
            break
        low, high = low + at * width, low + (at + 1) * width
    # keys that can't be told apart: cells in order
    out = sure.copy()
    for i in range(len(cells)):
        take = min(rest, per[at][i])
        out[i] += take
        rest -= take
    return out


