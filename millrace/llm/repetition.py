"""Problem 3: repetition inside a document.

A word (letters only, case aside) is repeated if it lies in a run of five words that already began earlier in the same
text; the share of repeated words is exact. Which texts are worth that count is told by gradient-boosted trees over
statistics that are cheaper than it and don't contain it: the shares of words and of triples of words (between white space)
that stand again, of repeated sentences and lines, and the length. The trees predict the share: least-squares boosting on histogram bins, grown to
a small depth, where a split on a feature declared monotone must not lower the prediction and its children's values stay on
their sides of the split's middle. They are flattened to numpy node arrays, and a batch of texts goes down all trees at once.

The trees are fitted on four of five rows of a sample of at most `max_rows` rows (those with the smallest hash of their
key). A text is flagged if its predicted share reaches the cut: half of the lowest prediction for any repetitive text of
the whole sample, and no more than `doubt` of `least`. Flagged texts are counted exactly; texts below the cut are not
(their share is null, unless `every` asks for all). `held_out` has the recall and precision on the fifth row.
Null, blank and short texts have the share 0; texts are read whole; repeated rows are told alike.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.session import hash_sample

_WORD = re.compile(r"[^\W\d_]+")
RUN = 5
#: Statistics of a text, and whether more of one can only mean more repetition
FEATURES = {"triples": 1, "words": 0, "sentences": 1, "lines": 1, "length": 0}


def repeated(words: list[str], run: int = RUN) -> tuple[int, int]:
    """The number of words in runs that began before, and of such runs."""
    seen: set[tuple[str, ...]] = set()
    covered = again = 0
    end = 0  # words before this place are counted
    for i, gram in enumerate(zip(*(words[k:] for k in range(run)))):
        if gram in seen:
            again += 1
            covered += i + run - max(i, end)
            end = i + run
        else:
            seen.add(gram)
    return covered, again


def share(text: str | None, run: int = RUN) -> float:
    words = _WORD.findall(text.lower()) if text else []
    return repeated(words, run)[0] / len(words) if words else 0.0


def _again(parts: list[str]) -> float:
    """The share of characters in parts that stood before."""
    seen: set[str] = set()
    total = twice = 0
    for p in parts:
        p = p.strip().lower()
        if len(p) > 3:
            total += len(p)
            if p in seen:
                twice += len(p)
            seen.add(p)
    return twice / total if total else 0.0


def statistics(text: str | None) -> list[float]:
    """What the trees see of a text."""
    words = text.lower().split() if text else []
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    return [
        1 - len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 0.0,
        1 - len(set(words)) / n,
        _again(text.split(".")),
        _again(text.split("\n")) if "\n" in text else 0.0,
        math.log1p(n),
    ]


@dataclass(frozen=True)
class RepetitionConfig:
    max_rows: int = 4000
    least: float = 0.3
    doubt: float = 0.5  # of `least`; predictions above it are always counted exactly
    held_out: int = 5
    trees: int = 40
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    least_rows: int = 8
    l2: float = 1.0


class BoostedTrees:
    """Least-squares gradient boosting with monotone constraints, flattened for vectorised scoring."""

    def __init__(self, x: np.ndarray, y: np.ndarray, monotone: list[int], cfg: RepetitionConfig = RepetitionConfig()):
        self.cfg, self.monotone = cfg, monotone
        self.base = float(y.mean()) if len(y) else 0.0
        self.edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, cfg.bins + 1)[1:-1])) if len(x) else np.zeros(0) for f in range(len(monotone))]
        self.feature, self.threshold, self.left, self.right, self.value, self.roots = [], [], [], [], [], []
        binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros((0, len(monotone)), int)
        guess = np.full(len(y), self.base)
        for _ in range(cfg.trees if len(y) else 0):
            self.roots.append(len(self.feature))
            self._grow(binned, y - guess, np.arange(len(y)), 0, -np.inf, np.inf)
            self._flatten()
            guess += self._tree(x, self.roots[-1])
        self._flatten()

    def _flatten(self) -> None:
        self.nodes = tuple(np.array(a, t) for a, t in ((self.feature, np.int32), (self.threshold, float), (self.left, np.int32), (self.right, np.int32), (self.value, float)))

    def _grow(self, binned: np.ndarray, rest: np.ndarray, rows: np.ndarray, depth: int, low: float, high: float) -> int:
        c, at = self.cfg, len(self.feature)
        total, n = rest[rows].sum(), len(rows)
        for a, v in ((self.feature, -1), (self.threshold, 0.0), (self.left, at), (self.right, at), (self.value, c.rate * float(np.clip(total / (n + c.l2), low, high)))):
            a.append(v)
        if depth == c.depth or n < 2 * c.least_rows:
            return at
        best = (1e-9, None)
        for f, e in enumerate(self.edges):
            if not len(e):
                continue
            count = np.bincount(binned[rows, f], minlength=len(e) + 1)
            sums = np.bincount(binned[rows, f], weights=rest[rows], minlength=len(e) + 1)
            nl, gl = np.cumsum(count)[:-1], np.cumsum(sums)[:-1]
            nr, gr = n - nl, total - gl
            vl, vr = np.clip(gl / (nl + c.l2), low, high), np.clip(gr / (nr + c.l2), low, high)
            gain = gl * gl / (nl + c.l2) + gr * gr / (nr + c.l2) - total * total / (n + c.l2)
            ok = (nl >= c.least_rows) & (nr >= c.least_rows) & (self.monotone[f] * (vr - vl) >= 0)
            if ok.any():
                k = int(np.argmax(np.where(ok, gain, -np.inf)))
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, vl[k], vr[k]))
        if best[1] is None:
            return at
        f, k, vl, vr = best[1]
        goes_left = binned[rows, f] <= k
        middle = (vl + vr) / 2
        m = self.monotone[f]
        self.feature[at], self.threshold[at] = f, float(self.edges[f][k])
        self.left[at] = self._grow(binned, rest, rows[goes_left], depth + 1, *((low, min(high, middle)) if m > 0 else (max(low, middle), high) if m < 0 else (low, high)))
        self.right[at] = self._grow(binned, rest, rows[~goes_left], depth + 1, *((max(low, middle), high) if m > 0 else (low, min(high, middle)) if m < 0 else (low, high)))
        return at

    def _tree(self, x: np.ndarray, root: int) -> np.ndarray:
        feature, threshold, left, right, value = self.nodes
        node = np.full(len(x), root)
        for _ in range(self.cfg.depth):
            f = feature[node]
            down = x[np.arange(len(x)), np.maximum(f, 0)] <= threshold[node]
            node = np.where(f < 0, node, np.where(down, left[node], right[node]))
        return value[node]

    def score(self, x: np.ndarray) -> np.ndarray:
        """All trees for all rows: (rows, trees) node ids go down level by level."""
        if not self.roots or not len(x):
            return np.full(len(x), self.base)
        feature, threshold, left, right, value = self.nodes
        node = np.tile(np.array(self.roots), (len(x), 1))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.cfg.depth):
            f = feature[node]
            down = x[rows, np.maximum(f, 0)] <= threshold[node]
            node = np.where(f < 0, node, np.where(down, left[node], right[node]))
        return self.base + value[node].sum(axis=1)


@dataclass
class RepetitionModel:
    trees: BoostedTrees
    cut: float
    held_out: dict[str, float]


def train(texts: list[str | None], cfg: RepetitionConfig = RepetitionConfig()) -> RepetitionModel:
    """Trees, cut and held-out figures from texts; the exact share is the label."""
    x = np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES))
    y = np.array([share(t) for t in texts])
    held = np.arange(len(texts)) % cfg.held_out == cfg.held_out - 1

    def cut(trees: BoostedTrees, rows: np.ndarray) -> float:
        lowest = trees.score(x[rows])[y[rows] >= cfg.least]
        return min(cfg.doubt * cfg.least, float(lowest.min()) / 2 if len(lowest) else np.inf)

    trees = BoostedTrees(x[~held], y[~held], list(FEATURES.values()), cfg)
    flagged, true = trees.score(x[held]) >= cut(trees, ~held), y[held] >= cfg.least
    both = float((flagged & true).sum())
    told = {"rows": float(held.sum()), "recall": both / true.sum() if true.any() else 1.0, "precision": both / flagged.sum() if flagged.any() else 1.0, "flagged": float(flagged.mean()) if len(flagged) else 0.0}
    return RepetitionModel(trees, cut(trees, np.ones(len(texts), bool)), told)


def fit(df: DataFrame, key: str, text: str, cfg: RepetitionConfig = RepetitionConfig()) -> RepetitionModel:
    """A model from the cfg.max_rows rows with the smallest hash of their key."""
    return train([r[text] for r in hash_sample(df.select(key, text).dropna(), key, cfg.max_rows)], cfg)


def with_repetition(df: DataFrame, key: str, text: str, model: RepetitionModel, every: bool = False) -> DataFrame:
    """<key>, share (of repeated words; null where the trees rule repetition out, unless `every`), score, flagged."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kinds = dict(df.select(key).dtypes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            score = model.trees.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES)))
            flagged = score >= model.cut
            exact = [share(t) if every or f else None for t, f in zip(texts, flagged.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(exact, pa.float64()), pa.array(score), pa.array(flagged)], [key, "share", "score", "flagged"])

    return df.select(key, text).mapInArrow(scan, f"`{key}` {kinds[key]}, share double, score double, flagged boolean")
