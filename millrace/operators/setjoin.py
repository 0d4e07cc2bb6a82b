"""Exact set-similarity join: all pairs of sets with Jaccard similarity of at least t, by prefixes of rare shingles.

A set's elements are dealt into P cells by their hash; a cell with its content is a shingle of the set. An element that
only one of two sets has spoils one cell, so sets that differ in at most H elements share at least P - H of their P
shingles, whatever else they hold. Shingles are put in one order, rare before frequent (by the summed rarity of their
elements); of P - H common ones at least one lies among the first H + 1 of each set (prefix filter), and those are its
keys. P is larger than H + 1 by a third of H, so each set leaves out its emptiest and commonest cells. Keys grow
linearly with the set (0.25 a word at t = 0.8), and several words must agree for a key to meet, so neither a small
vocabulary nor a long set floods the join.

H depends on the sizes. Sizes fall into bands, and P and H are those of the right set's band: a right set has keys of its
own band, a left set keys of each band its partners' sizes may lie in.

A pair that meets is turned away, inside the join, if the sizes are out of proportion (length filter), if the key stands
behind more shingles of either set than the two sets, of their sizes, may have spoiled (position filter: before the first
common shingle all are spoiled), or if the 128-bit parity bitmaps of the sets differ in more bits than the sets may differ
in elements. None of these loses a pair; the few left are compared in full.

Rarity comes from counts over all sets of the most frequent `frequent` elements, a list of bounded size; the rest count as
rarer than all of them. Any order is exact; this one keeps what a third of all sets may hold out of the keys. Sets are
compared by 64-bit hashes of their elements.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

_KEYS = StructType([
    StructField("keys", ArrayType(StructType([StructField("k", LongType()), StructField("at", IntegerType())]))),
    StructField("low", LongType()),
    StructField("high", LongType()),
])
#: Least ratio of a size band's ends
BAND = 1.15


class Bands:
    """Size bands for a similarity, with the cells and the prefix of each."""

    def __init__(self, least: float, largest: int):
        self.least, starts = least, [1]
        while starts[-1] <= largest / least + 1:
            starts.append(max(starts[-1] + 1, math.ceil(starts[-1] * BAND)))
        self.starts = np.array(starts)
        top = self.starts[1:] - 1
        partner = np.floor(top / least + 1e-9)
        self.differ = np.floor((1 - least) / (1 + least) * (top + partner) + 1e-9).astype(np.int64)  # H
        self.cells = self.differ + 1 + -(-self.differ // 3)  # P

    def own(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, n, side="right") - 1

    def reached(self, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last band of the sizes that sets of `n` elements may be similar to."""
        return self.own(np.maximum(1, np.ceil(self.least * n - 1e-9)).astype(np.int64)), self.own(np.floor(n / self.least + 1e-9).astype(np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_keys(flat: np.ndarray, sizes: np.ndarray, weight: np.ndarray, least: float, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, place in the prefix, number of keys of each set) of sets given by their elements one after
    another, their sizes and their elements' weights (whole numbers)."""
    bands = Bands(least, int(sizes.max(initial=1)))
    first, last = bands.reached(sizes) if wide else (bands.own(sizes),) * 2
    times = last - first + 1
    # one row for each set and band
    of = np.repeat(np.arange(len(sizes)), times)
    band = np.repeat(first, times) + np.arange(len(of)) - np.repeat(np.cumsum(times) - times, times)
    cells, differ, n = bands.cells[band], bands.differ[band], sizes[of]
    begin = (np.cumsum(sizes) - sizes)[of]
    row = np.repeat(np.arange(len(of)), n)
    element = np.repeat(begin, n) + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    hashed = _mixed(flat.view(np.uint64))
    base = np.cumsum(cells) - cells
    cell = base[row] + (hashed[element] % cells[row].astype(np.uint64)).astype(np.int64)
    total = int(cells.sum())
    content = np.zeros(total, np.uint64)
    order = np.argsort(cell, kind="stable")
    if len(order):
        sorted_cells = cell[order]
        starts = np.flatnonzero(np.concatenate(([True], sorted_cells[1:] != sorted_cells[:-1])))
        with np.errstate(over="ignore"):
            content[sorted_cells[starts]] = np.add.reduceat(_mixed(hashed[element[order]]), starts)
    strength = np.bincount(cell, weights=weight[element], minlength=total)
    owner = np.repeat(np.arange(len(of)), cells)
    index = np.arange(total) - base[owner]
    ranked = np.lexsort((index, content, -strength, owner))
    place = np.arange(total) - base[owner[ranked]]
    kept = place <= differ[owner[ranked]]
    ranked, place = ranked[kept], place[kept]
    whose = owner[ranked]
    with np.errstate(over="ignore"):
        key = _mixed(content[ranked] + _mixed(index[ranked].astype(np.uint64) * np.uint64(1_000_003) + band[whose].astype(np.uint64) + np.uint64(1)))
    per_set = np.bincount(of[whose], minlength=len(sizes))
    return key.view(np.int64), place.astype(np.int32), per_set


def similar_sets(left: DataFrame, right: DataFrame | None, least: float, frequent: int = 20_000) -> DataFrame:
    """left, right (ids), similarity. left, right: `id` (unique, LONG) and `elements` (distinct LONGs, none empty).
    Without `right`, pairs within `left`, the smaller id first. Of two tables, give the smaller one as `left`."""
    if not 0 < least <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    spark = left.sparkSession
    both = left if right is None else left.select("id", "elements").unionByName(right.select("id", "elements"))
    counts = both.select(F.explode("elements").alias("e")).groupBy("e").count()
    top = counts.orderBy(F.desc("count"), "e").limit(frequent).collect()
    # rarity in hundredths of a nat against the commonest element, most for what isn't listed
    most = top[0]["count"] if top else 1
    known = np.array(sorted((r["e"], round(100 * math.log(most / r["count"]))) for r in top), np.int64).reshape(-1, 2)
    listed = spark.sparkContext.broadcast((known[:, 0].copy(), known[:, 1].copy(), int(known[:, 1].max(initial=0)) + 100))

    def keys(sets: DataFrame, wide: bool, label: str) -> DataFrame:
        @arrow_udf(_KEYS)
        def keyed(elements: pa.Array) -> pa.Array:
            names, values, rest = listed.value
            sizes = elements.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = elements.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            weight = np.full(len(flat), rest, np.int64)
            if len(names):
                at = np.minimum(np.searchsorted(names, flat), len(names) - 1)
                weight = np.where(names[at] == flat, values[at], rest)
            key, place, per_set = prefix_keys(flat, sizes, weight + 1, least, wide)
            bit = flat.view(np.uint64) & np.uint64(127)
            owner = np.repeat(np.arange(len(sizes)), sizes)
            halves = []
            for half in (0, 1):
                odd = np.zeros((len(sizes), 64), np.uint8)
                mine = (bit >> np.uint64(6)) == half
                np.bitwise_xor.at(odd, (owner[mine], (bit[mine] & np.uint64(63)).astype(np.int64)), 1)
                halves.append(pa.array(np.packbits(odd, axis=1).reshape(-1).view(np.int64)))
            each = pa.StructArray.from_arrays([pa.array(key), pa.array(place)], ["k", "at"])
            ends = pa.array(np.concatenate(([0], np.cumsum(per_set))).astype(np.int32))
            return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, each), *halves], ["keys", "low", "high"])

        told = sets.select("id", F.size("elements").alias("n"), keyed("elements").alias("x"))
        return told.select("id", "n", "x.low", "x.high", F.inline("x.keys"))

    a, b = keys(left, True, "keys-left"), keys(left if right is None else right, False, "keys-right")
    a, b = (x.select("k", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "n", "at", "low", "high")]) for x, s in ((a, "a"), (b, "b")))
    need = F.ceil(least / (1 + least) * (F.col("n_a") + F.col("n_b")) - 1e-9)
    near = (F.col("n_a") >= least * F.col("n_b") - 1e-9) & (F.col("n_b") >= least * F.col("n_a") - 1e-9)
    differ = F.col("n_a") + F.col("n_b") - 2 * need
    near = near & (F.greatest("at_a", "at_b") <= differ)
    apart: Column = F.bit_count(F.col("low_a").bitwiseXOR(F.col("low_b"))) + F.bit_count(F.col("high_a").bitwiseXOR(F.col("high_b")))
    near = near & (apart <= differ)
    if right is None:
        near = near & (F.col("id_a") < F.col("id_b"))
    # a set's keys are many times its size, which the optimiser can't know: never a broadcast
    met = a.join(b.hint("merge"), "k").filter(near).select("id_a", "id_b").distinct()
    whole = [x.select(F.col("id").alias(f"id_{s}"), F.col("elements").alias(f"e_{s}")) for x, s in ((left, "a"), (left if right is None else right, "b"))]
    common = F.size(F.array_intersect("e_a", "e_b"))
    told = met.join(whole[0], "id_a").join(whole[1], "id_b").select("id_a", "id_b", common.alias("common"), (F.size("e_a") + F.size("e_b")).alias("total"))
    told = told.filter(F.col("common") >= least * (F.col("total") - F.col("common")) - 1e-9)
    return told.select(F.col("id_a").alias("left"), F.col("id_b").alias("right"), (F.col("common").cast("double") / (F.col("total") - F.col("common")).cast("double")).alias("similarity"))
