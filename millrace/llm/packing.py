"""Problem 8: filling fixed-capacity containers with items.

Texts are counted in tokens of a public tokenizer (a byte-pair vocabulary file; its path is a parameter), then packed by
bounded-space online best-fit: `open_bins` containers are open at a time, kept in a bitset whose bit f says that some open
container has f tokens free; the lowest bit at or above an item's size is the container it fits best; where none fits and
all are open, the fullest closes first. What is open at the end is merged where two fit into one. A text longer than the
capacity fills containers of its own and its remainder is packed as an item; no other text is divided.

Token counts are made where the texts are read, and only (key, tokens) is shuffled, to as many partitions as leave each
some twenty times the open containers' space, so the waste at partitions' ends stays small at any size. Each partition
packs its items in the order of the keys' hashes, for all capacities at once; the containers' names hold the partition, so
a task that runs again gives the same result. Null and empty texts have no tokens and take no space in a container;
repeated keys are items of their own; extra columns aren't read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from millrace.session import stage

#: How the vocabulary's texts are cut before merging (fixed value, stated with the vocabulary)
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@dataclass(frozen=True)
class PackConfig:
    vocabulary: str = VOCABULARY
    open_bins: int = 64
    fills: int = 20


@lru_cache(maxsize=2)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, path: str = VOCABULARY) -> DataFrame:
    """<key>, n_tokens."""

    @arrow_udf(LongType())
    def count(texts: pa.Array) -> pa.Array:
        encode = encoding(path).encode_ordinary
        return pa.array([len(encode(t)) if t else 0 for t in texts.to_pylist()], pa.int64())

    return df.select(F.col(key), count(F.col(text)).alias("n_tokens"))


class Bins:
    """Open containers of one capacity."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most, self.open = capacity, most, 0
        self.mask = 0
        self.by_free: dict[int, list[list]] = {}

    def add(self, size: int, item: tuple) -> list[list]:
        """Put an item into a container; gives the containers that this closes."""
        closed = []
        fitting = self.mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._take(free)
        else:
            if self.open == self.most:
                closed.append(self._take((self.mask & -self.mask).bit_length() - 1))
            free, bin_ = self.capacity, []
        bin_.append(item)
        if free - size:
            self._put(free - size, bin_)
        else:
            closed.append(bin_)
        return closed

    def _take(self, free: int) -> list:
        stack = self.by_free[free]
        bin_ = stack.pop()
        if not stack:
            del self.by_free[free]
            self.mask &= ~(1 << free)
        self.open -= 1
        return bin_

    def _put(self, free: int, bin_: list) -> None:
        self.by_free.setdefault(free, []).append(bin_)
        self.mask |= 1 << free
        self.open += 1

    def rest(self) -> list[list]:
        """The containers still open, merged where two fit into one (fullest first, each into the best fit)."""
        merged = Bins(self.capacity, self.open + 1)
        out = []
        for free in sorted(self.by_free):
            for bin_ in self.by_free[free]:
                out += merged.add(self.capacity - free, (bin_,))
        out += [b for bins in merged.by_free.values() for b in bins]
        return [[x for (part,) in bin_ for x in part] for bin_ in out]


def pack(items: DataFrame, key: str, size: str, capacities: dict[str, int], cfg: PackConfig = PackConfig()) -> DataFrame:
    """pack_name, pack_id, <key>, part_no (from 0), start (token of the text), n_tokens: every item in a container, for each capacity."""
    for name, capacity in capacities.items():
        if capacity < 1:
            raise ValueError(f"{name}: capacity {capacity}")
    staged = stage(items.select(F.col(key), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("_size")), "pack-items")
    kinds = dict(staged.dtypes)
    schema = f"pack_name string, pack_id string, `{key}` {kinds[key]}, part_no int, start long, n_tokens long"
    total = staged.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]
    room = max(capacities.values(), default=1) * cfg.open_bins * cfg.fills
    width = max(1, total // room)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        bins = {name: Bins(c, cfg.open_bins) for name, c in capacities.items()}
        made = dict.fromkeys(bins, 0)

        def batch(closed: list[tuple[str, list]]) -> pa.RecordBatch:
            names, ids, keys, parts, starts, sizes = [], [], [], [], [], []
            for name, bin_ in closed:
                pack_id = f"{name}-{part}-{made[name]}"
                made[name] += 1
                for k, number, start, n in bin_:
                    names.append(name)
                    ids.append(pack_id)
                    keys.append(k)
                    parts.append(number)
                    starts.append(start)
                    sizes.append(n)
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(ids, pa.string()), pa.array(keys, key_type), pa.array(parts, pa.int32()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                ["pack_name", "pack_id", key, "part_no", "start", "n_tokens"],
            )

        key_type = None
        for b in batches:
            key_type = b.schema.field(0).type
            closed: list[tuple[str, list]] = []
            for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for name, open_ in bins.items():
                    c, start, number = open_.capacity, 0, 0
                    while n - start > c:
                        closed.append((name, [(k, number, start, c)]))
                        start, number = start + c, number + 1
                    closed += [(name, x) for x in open_.add(n - start, (k, number, start, n - start))]
            yield batch(closed)
        if key_type is not None:
            yield batch([(name, x) for name, open_ in bins.items() for x in open_.rest()])

    # copies of one key, however many, spread over 256 places; the staged files keep this the same when a task runs again
    placed = staged.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(256)))
    dealt = placed.repartition(width, key, "_salt").sortWithinPartitions(F.xxhash64(key, "_salt"), key, "_size").select(key, "_size")
    return dealt.mapInArrow(fill, schema)


def pack_report(packed: DataFrame, capacities: dict[str, int]) -> DataFrame:
    """Per capacity: containers, items (whole or parts), tokens, and the share of the space that stays unused."""
    per = packed.groupBy("pack_name").agg(F.count_distinct("pack_id").alias("n_packs"), F.count(F.lit(1)).alias("n_parts"), F.sum("n_tokens").alias("n_tokens"))
    capacity = F.coalesce(*[F.when(F.col("pack_name") == n, F.lit(c)) for n, c in capacities.items()])
    return per.withColumn("unused", 1 - F.col("n_tokens") / (F.col("n_packs") * capacity))
