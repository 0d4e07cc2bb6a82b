"""Problem 9: evaluation texts leaking into training text.

A document holds an item if `min_words` running words of the item stand in it with at most `max_edits` of them changed
or added (20 and one in ten), case, punctuation, mark-up, line breaks and character forms aside.

Both sides are cut into windows at every word. The window is as wide as the longest run that such a passage must keep
untouched: 20 words with 2 edits fall into 3 runs of 18 words together, so one run has 6, and a longer passage has a
longer one. A passage begins and ends with unchanged words. (Windows of a whole item would need a radius of 15 and more of 64 bits at that edit rate, where blocks no
longer select.) A window's 64-bit SimHash is the sign of the sum of its words' hash bits. The items' fingerprints are
indexed by each of `radius + 1` blocks of bits: two fingerprints within the radius agree in a block (pigeonhole), so
every pair within it is found. A (document, item) with fewer than three such windows can't hold a passage (three runs
of six give three, any other division more). Windows at any distance within the radius seed the alignment, from the first
word they share. What remains is aligned word by word from its windows outward, where that
leaves doubt in all ways that could do, and passes if a stretch of enough words with few enough edits exists and its three-word shingles, weighted by how rare they are
among the items, are shared; shingles of frame lines that many items share weigh nothing.

The items' index is broadcast in blocks of at most `block_windows` windows (48 bytes each), so its size is bounded
whatever the number of items; documents are never shuffled, every one is read whole, and the result has one row per
document and item. Null and short texts hold nothing; items shorter than `min_words` are never found; repeated
documents (rows) come out under their ids; extra columns aren't read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.forms import form

_WORD = re.compile(r"[^\W_]+")
_TAG = re.compile(r"</?[A-Za-z][^<>\n]*>")


def words(text: str | None) -> list[str]:
    """Lower-case words without mark-up, punctuation and character forms."""
    return _WORD.findall(_TAG.sub(" ", form(text)).lower()) if text else []


@dataclass(frozen=True)
class LeakConfig:
    min_words: int = 20
    max_edits: float = 0.1
    radius: int = 3
    block_windows: int = 1_000_000
    min_shared: float = 0.3
    common_items: float = 0.05

    @property
    def window(self) -> int:
        edits = int(self.min_words * self.max_edits)
        return max(2, (self.min_words - edits) // (edits + 1))

    @property
    def min_hits(self) -> int:
        edits = int(self.min_words * self.max_edits)
        return max(1, self.min_words - edits - (edits + 1) * (self.window - 1))


class _Hashes(dict):
    """Word -> 64-bit hash; forgets all when it grows too large."""

    def __missing__(self, w: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[w] = h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
        return h


def simhashes(hashes: np.ndarray, window: int) -> np.ndarray:
    """The fingerprint of each window of the running words."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).view(np.int8)
    total = bits[:n].copy()
    for k in range(1, window):
        total += bits[k : n + k]
    return np.packbits(total * 2 > window, axis=1).reshape(-1).view(np.uint64)


class ItemIndex:
    """Fingerprints of all windows of a block of items, by each block of bits."""

    def __init__(self, items: list[tuple[int, str]], cfg: LeakConfig):
        self.cfg, hashes = cfg, _Hashes()
        self.ids = [i for i, _ in items]
        self.words = [np.array([hashes[w] for w in words(t)], np.uint64) for _, t in items]
        prints = [simhashes(w, cfg.window) for w in self.words]
        self.prints = np.concatenate(prints) if prints else np.zeros(0, np.uint64)
        self.item = np.repeat(np.arange(len(items)), [len(p) for p in prints]).astype(np.int32)
        self.at = np.concatenate([np.arange(len(p)) for p in prints]).astype(np.int32) if prints else np.zeros(0, np.int32)
        self.blocks = []
        width, extra = divmod(64, cfg.radius + 1)
        shift = 0
        for b in range(cfg.radius + 1):
            bits = width + (b < extra)
            bits, mask = min(bits, 20), np.uint64((1 << min(bits, 20)) - 1)  # a part of a block agrees where the block does
            value = ((self.prints >> np.uint64(shift)) & mask).astype(np.int64)
            order = np.argsort(value, kind="stable").astype(np.int32)
            start = np.searchsorted(value[order], np.arange((1 << bits) + 1)).astype(np.int32)
            self.blocks.append((np.uint64(shift), mask, start, order))
            shift += width + (b < extra)
        df = Counter(s for w in self.words for s in set(self._shingles(w)))
        n = len(items)
        self.weight = {s: 0.0 if n >= 20 and c > cfg.common_items * n else math.log((n + 1) / c) + 1e-9 for s, c in df.items()}

    @staticmethod
    def _shingles(w: np.ndarray) -> list[tuple]:
        x = w.tolist()
        return list(zip(x, x[1:], x[2:]))

    def hits(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (window of the text, window of the items) within the radius."""
        left, right = [], []
        for shift, mask, start, order in self.blocks:
            value = ((prints >> shift) & mask).astype(np.int64)
            lo = start[value]
            n = start[value + 1] - lo
            has = np.flatnonzero(n)
            if not len(has):
                continue
            n = n[has]
            a = np.repeat(has, n)
            b = order[np.repeat(lo[has] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())]
            near = np.bitwise_count(prints[a] ^ self.prints[b]) <= self.cfg.radius
            left.append(a[near])
            right.append(b[near])
        if not left:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pair = np.unique(np.concatenate(left).astype(np.int64) * len(self.prints) + np.concatenate(right))
        return pair // len(self.prints), pair % len(self.prints)

    def found(self, texts: list[tuple[int, list[str]]], hashes: dict) -> list[tuple[int, int]]:
        """(item id, text id) of all passages in the texts."""
        cfg, w = self.cfg, self.cfg.window
        flat = np.array([hashes[x] for _, ws in texts for x in ws], np.uint64)
        sizes = np.array([len(ws) for _, ws in texts], np.int64)
        ends = np.cumsum(sizes)
        prints = simhashes(flat, w)
        if not len(prints) or not len(self.prints):
            return []
        a, b = self.hits(prints)
        doc = np.searchsorted(ends, a, side="right")
        inside = a + w <= ends[doc]  # windows across two texts
        a, b, doc = a[inside], b[inside], doc[inside]
        key = doc * len(self.ids) + self.item[b]
        order = np.argsort(key, kind="stable")
        a, b, doc, key = a[order], b[order], doc[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        out = []
        for k, end in zip(first, [*first[1:], len(key)]):
            if end - k < cfg.min_hits:
                continue
            d, i = int(doc[k]), int(self.item[b[k]])
            text = flat[ends[d] - sizes[d] : ends[d]]
            base = int(ends[d] - sizes[d])
            if self._holds(text.tolist(), self.words[i].tolist(), [(int(x) - base, int(self.at[y])) for x, y in zip(a[k:end], b[k:end])]):
                out.append((self.ids[i], texts[d][0]))
        return out

    def _holds(self, text: list[int], item: list[int], hits: list[tuple[int, int]]) -> bool:
        done: set[tuple[int, int]] = set()
        doubtful = []
        for p, q in hits:
            same = next((k for k in range(self.cfg.window) if text[p + k] == item[q + k]), None)  # windows may differ in a word
            if (p - q, q) in done or same is None:
                continue
            p, q = p + same, q + same
            runs = _align(text, item, p, q)
            done.update((x - y, y + k) for y, x, n in runs for k in range(n))
            for s in range(len(runs)):
                edits = 0
                for e in range(s, len(runs)):
                    if e > s:
                        (y0, x0, n0), (y1, x1, _) = runs[e - 1], runs[e]
                        edits += max(y1 - y0 - n0, x1 - x0 - n0)
                    q0, q1 = runs[s][0], runs[e][0] + runs[e][2]
                    if self._enough(q1 - q0, edits) and self._shared(item[q0:q1], text[runs[s][1] : runs[e][1] + runs[e][2]]):
                        return True
            doubtful.append(p - q)
        # what quick alignment couldn't tell: a place for each diagonal that may hold enough words, then all alignments
        seen: list[int] = []
        for d in doubtful:
            if all(abs(d - x) > 2 for x in seen):
                seen.append(d)
                qs = [q for p, q in hits if abs(p - q - d) <= 3]
                if len(qs) >= self.cfg.min_hits and self._may(text, item, d, min(qs), max(qs) + self.cfg.window):
                    drift = int(len(item) * self.cfg.max_edits) + 1  # no passage strays further from its diagonal
                    if self._any(text[max(0, d - drift) : max(0, d + len(item) + drift)], item):
                        return True
        return False

    def _enough(self, words: int, edits: int) -> bool:
        return words >= self.cfg.min_words and edits <= words * self.cfg.max_edits + 1e-9

    def _may(self, text: list[int], item: list[int], d: int, first: int, last: int) -> bool:
        """Whether enough words of some stretch of the item, about its windows on the diagonal, stand near that: a passage has a stretch of `min_words`
        with at most one edit more than such a stretch may have (an edit in each half of a passage half as long again)."""
        n, slack = self.cfg.min_words, int(self.cfg.min_words * self.cfg.max_edits) + 1
        missing, places = 0, []
        for k, q in enumerate(range(max(0, first - n), min(len(item), last + n))):
            at = q + d
            gone = item[q] not in text[max(0, at - slack - 1) : max(0, at + slack + 2)]
            places.append(gone)
            missing += gone - (places[k - n] if k >= n else 0)
            if k >= n - 1 and missing <= slack:
                return True
        return False

    def _any(self, text: list[int], item: list[int]) -> bool:
        """Whether any stretch of the item, its first and last words unchanged, stands in the text with few enough edits:
        least edits from each start, as long as they can still suffice."""
        most = int(len(item) * self.cfg.max_edits)
        for s in range(len(item) - self.cfg.min_words + 1):
            room = int((len(item) - s) * self.cfg.max_edits + 1e-9)
            row = {j: (0, j) for j, w in enumerate(text) if w == item[s]}  # place of the last word -> (edits, where it began)
            for i in range(s + 1, len(item)):
                new: dict[int, tuple[int, int]] = {}
                for j, (e, j0) in row.items():
                    # the item's next word: unchanged after up to `most` added words, changed, or left out
                    ways = [(j + 1 + x, x, True) for x in range(min(most, room - e) + 1) if j + 1 + x < len(text) and text[j + 1 + x] == item[i]]
                    for k, cost, kept in [*ways, (j + 1, 1, False), (j, 1, False)]:
                        if k < len(text) and e + cost <= room:
                            if kept and self._enough(i + 1 - s, e + cost) and self._shared(item[s : i + 1], text[j0 : k + 1]):
                                return True
                            if k not in new or e + cost < new[k][0]:
                                new[k] = (e + cost, j0)
                row = new
                if not row:
                    break
        return False

    def _shared(self, item: list[int], text: list[int]) -> bool:
        """Whether the stretches share enough of the weight of their shingles."""
        mine, theirs = list(zip(item, item[1:], item[2:])), set(zip(text, text[1:], text[2:]))
        total = sum(self.weight[s] for s in mine)
        return total > 0 and sum(self.weight[s] for s in mine if s in theirs) >= self.cfg.min_shared * total


#: Ways to go on after a break, as words skipped in the item and in the text, least edits first
_STEPS = sorted(((i, j) for i in range(5) for j in range(5) if i or j), key=lambda s: (max(s), abs(s[0] - s[1])))


def _align(text: list[int], item: list[int], p: int, q: int) -> list[tuple[int, int, int]]:
    """Runs (place in the item, place in the text, words) around a common place, in order."""

    def onward(x: list[int], y: list[int]) -> list[tuple[int, int, int]]:
        runs, i, j = [], 0, 0
        while True:
            n = 0
            while i + n < len(x) and j + n < len(y) and x[i + n] == y[j + n]:
                n += 1
            if n:
                runs.append((i, j, n))
            i, j = i + n, j + n
            for di, dj in _STEPS:
                a, b = x[i + di : i + di + 3], y[j + dj : j + dj + 3]
                if a and a == b[: len(a)]:
                    i, j = i + di, j + dj
                    break
            else:
                return runs

    right = onward(item[q:], text[p:])
    left = onward(item[:q][::-1], text[max(0, p - 2 * q - 40) : p][::-1])
    runs = [(q - i - n, p - j - n, n) for i, j, n in reversed(left)] + [(q + i, p + j, n) for i, j, n in right]
    if left and right and left[0][:2] == (0, 0):  # one run across the common place
        k = len(left) - 1
        (y0, x0, n0), (_, _, n1) = runs[k], runs[k + 1]
        runs[k : k + 2] = [(y0, x0, n0 + n1)]
    return runs


def _blocks(items: DataFrame, id_col: str, text_col: str, cfg: LeakConfig) -> Iterator[ItemIndex]:
    """Indexes of blocks of items, each of bounded size."""
    block: list[tuple[int, str]] = []
    size = 0
    for i, t in items.select(id_col, text_col).dropna().orderBy(id_col).toLocalIterator():
        block.append((i, t))
        size += len(t) // 2 + 1
        if size >= cfg.block_windows:
            yield ItemIndex(block, cfg)
            block, size = [], 0
    if block:
        yield ItemIndex(block, cfg)


def leaked_passages(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "item_text", cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """<item_id>, <doc_id>: every document that holds a passage of an item, and the item."""
    spark = docs.sparkSession
    schema = f"{item_id} bigint, {doc_id} bigint"
    source = docs.select(docs[doc_id].cast("bigint").alias(doc_id), docs[text].alias(text)).dropna()
    out = None
    for index in _blocks(items, item_id, item_text, cfg):
        shared = spark.sparkContext.broadcast(index)

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hashes, index = _Hashes(), shared.value
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                found, part, n = [], [], 0
                for i, t in zip(ids, texts):
                    w = words(t)
                    part.append((i, w))
                    n += len(w)
                    if n > 100_000:  # bounds the memory of the bit matrix, not the text
                        found += index.found(part, hashes)
                        part, n = [], 0
                if part:
                    found += index.found(part, hashes)
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], [item_id, doc_id])

        part = source.mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], schema)


def leak_report(found: DataFrame, items: DataFrame, docs: DataFrame, source: str = "source") -> DataFrame:
    """Per item with leaks: its suite, the number of documents that hold it and of their sources."""
    held = found.distinct().join(docs.select("doc_id", source), "doc_id")
    from pyspark.sql import functions as F

    counts = held.groupBy("item_id").agg(F.count_distinct("doc_id").alias("n_docs"), F.count_distinct(source).alias("n_sources"))
    return counts.join(items.select("item_id", "suite"), "item_id")
