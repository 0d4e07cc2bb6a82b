"""Problem 6: the language of each text and of each line, with a confidence.

A sparse multinomial logistic regression over hashed character n-grams (1 to 4, with word ends), TF-IDF weighted, trained
by follow-the-regularised-leader with an elastic net on labelled sentences, then calibrated by a temperature on sentences
it hasn't seen. Term frequencies are taken per n-gram of a text, so a text's logits are the mean of its words' vectors:
words are scored once per worker and looked up afterwards, and a batch of texts is a gather and a segmented sum.

A text is cut into clauses (lines, sentences, parts between commas). A clause of enough words with a clear language is
evidence for it. Texts with Kinyarwanda clauses and whole clauses of another language are `rw_mixed`; a few foreign
words inside a clause change nothing. The model is fitted on at most `max_samples` labelled rows and is applied to every
row; nothing else is sampled. Texts without letters have no language (null).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.forms import form
from millrace.session import hash_sample

LANGS = ("rw", "en", "fr", "sw")
MODES = ("rw", "rw_mixed", "en", "fr", "sw", "control")
_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[,.;:!?()\[\]{}\"|]+|\s[-•*]\s")
BITS = 16
# Short answers, which sentences of articles don't show.
SHORT = {
    "rw": "yego|oya|ni byo|yego ni|murakoze|murakoze cyane|mwaramutse|oya si byo",
    "en": "yes|no|yes it is|no it is not|thank you|thank you very much|hello|yes please",
    "fr": "oui|non|oui c'est|non ce n'est pas|merci|merci beaucoup|bonjour|c'est",
    "sw": "ndiyo|hapana|ndiyo ni|hapana sio|asante|asante sana|habari|hujambo",
}


@dataclass(frozen=True)
class LanguageConfig:
    max_samples: int = 20_000
    epochs: int = 12
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.02
    held_out: int = 5
    clause_words: int = 4
    clear: float = 0.9
    sure: float = 0.995
    split: float = 0.998
    unknown_share: float = 0.3  # of words never seen in the samples (names, typing errors)
    seed: int = 7


def ngrams(word: str) -> list[int]:
    """Hashed character n-grams of a word with its ends."""
    w = f"<{word}>"
    return [zlib.crc32(w[i : i + n].encode()) & ((1 << BITS) - 1) for n in (1, 2, 3, 4) for i in range(len(w) - n + 1)]


def _shifts() -> np.ndarray:
    """For a length, a byte's place and its value: what the byte of a CRC becomes when as many bytes follow."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    out = [(np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]).ravel()]
    for _ in range(_LONGEST):
        out.append(out[-1] >> 8 ^ table[out[-1] & 255])
    return np.concatenate(out)


_LONGEST = 64
_SHIFTS = _shifts()


def joined_crc(crc: np.ndarray | int, then: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRCs of texts of which `crc` is the first part's, and `then` that of the second, of `size` bytes."""
    crc, size = np.broadcast_to(np.asarray(crc, np.uint32), then.shape), size.astype(np.int64)
    while len(long := np.flatnonzero(size > _LONGEST)):
        crc = crc.copy()
        crc[long] = joined_crc(crc[long], np.zeros(len(long), np.uint32), np.full(len(long), _LONGEST))
        size[long] -= _LONGEST
    at = size << 10
    out = then.copy()
    for place in range(4):
        out ^= _SHIFTS.take(at + (256 * place) + (crc >> np.uint32(8 * place) & np.uint32(255)))
    return out


#: What a character is: part of a word of letters, of letters and digits; a mark between clauses, white space, a mark of items
LETTER, LETTER_OR_DIGIT, _MARK, _SPACE, _ITEM = 1, 2, 4, 8, 16


def _kind(c: str) -> int:
    letter, mark = c.isalnum(), c == "\n" or bool(_CLAUSE.match(c))
    return LETTER * (letter and not c.isdecimal()) | LETTER_OR_DIGIT * letter | _MARK * mark | _SPACE * c.isspace() | _ITEM * (c in "-•*")


_KINDS = np.array([_kind(chr(i)) for i in range(256)], np.uint8)


def words_of(texts: list[str], kind: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of all texts, one after the other; how many each text has; and how many ends of clauses stand before each."""
    text = "\n".join([*texts, ""])
    try:
        codec, codes = "latin-1", np.frombuffer(text.encode("latin-1"), np.uint8)
        kinds = _KINDS[codes]
    except UnicodeEncodeError:
        codec, codes = "utf-32-le", np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        far = codes > 255
        kinds = _KINDS[np.where(far, 0, codes)]
        several, which = np.unique(codes[far], return_inverse=True)
        kinds[far] = np.array([_kind(chr(c)) for c in several.tolist()], np.uint8)[which]
    inside = (kinds & kind) > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    words = np.where(inside, codes, 32).astype(codes.dtype).tobytes().decode(codec, "strict" if codec == "latin-1" else "surrogatepass").split()
    ends = (kinds & _MARK) > 0
    space = (kinds & _SPACE) > 0
    ends[1:-1] |= space[:-2] & ((kinds[1:-1] & _ITEM) > 0) & space[2:]
    size = np.array([len(t) + 1 for t in texts], np.int64)
    many = np.add.reduceat(begins, np.cumsum(size) - size, dtype=np.int64) if texts else np.zeros(0, np.int64)
    return words, many, np.cumsum(ends)[begins]


class _Numbers(dict):
    def __missing__(self, w: str) -> int:
        self[w] = i = len(self)
        return i


class LanguageModel:
    """Trained on (text, language); gives clause and text probabilities."""

    def __init__(self, samples: list[tuple[str, str]], cfg: LanguageConfig = LanguageConfig()):
        self.cfg = cfg
        samples = [(form(t).lower(), x) for t, x in samples if t and x in LANGS] + [(t, x) for x, ts in SHORT.items() for t in ts.split("|")] * 3
        parts = [(" ".join(p), x) for t, x in samples for p in self._parts(_WORD.findall(t))]
        feats = [np.array([g for w in p.split() for g in ngrams(w)], np.int64) for p, _ in parts]
        labels = np.array([LANGS.index(x) for _, x in parts], np.int64)
        df = np.zeros(1 << BITS)
        for f in feats:
            df[np.unique(f)] += 1
        self.idf = (np.log((1 + len(feats)) / (1 + df)) + 1).astype(np.float32)
        held = np.arange(len(parts)) // 2 % cfg.held_out == 0
        self.weights = self._ftrl([f for f, h in zip(feats, held) if not h], labels[~held])
        self.temperature = 1.0
        self.temperature = self._calibrate([f for f, h in zip(feats, held) if h], labels[held])
        self.held_out_accuracy = float(np.mean([np.argmax(self._logits(f)) == y for f, y, h in zip(feats, labels, held) if h])) if held.any() else 0.0
        self.vocabulary = frozenset(w for t, _ in samples for w in _WORD.findall(t))
        self._forget()

    @staticmethod
    def _parts(ws: list[str]) -> list[list[str]]:
        """A sentence whole, in halves and in pieces of four words, so that short clauses are known too."""
        k = len(ws) // 2
        halves = [ws[:k], ws[k:]] if len(ws) >= 8 else []
        return [p for p in [ws, *halves, *(ws[i : i + 4] for i in range(0, len(ws), 4))] if p]

    def _x(self, f: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        idx, n = np.unique(f, return_counts=True)
        return idx, n / len(f) * self.idf[idx]

    def _ftrl(self, feats: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
        c, k = self.cfg, len(LANGS)
        z, n = np.zeros((1 << BITS, k)), np.zeros((1 << BITS, k))

        def weights(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
            w = -(zi - np.sign(zi) * c.l1) / ((c.beta + np.sqrt(ni)) / c.alpha + c.l2)
            return np.where(np.abs(zi) <= c.l1, 0.0, w)

        rng, xs = np.random.default_rng(c.seed), [self._x(f) for f in feats]
        for _ in range(c.epochs):
            for r in rng.permutation(len(xs)):
                idx, x = xs[r]
                w = weights(z[idx], n[idx])
                p = _softmax(x @ w)
                p[labels[r]] -= 1
                g = x[:, None] * p
                sigma = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / c.alpha
                z[idx] += g - sigma * w
                n[idx] += g * g
        return weights(z, n).astype(np.float32)

    def _logits(self, f: np.ndarray) -> np.ndarray:
        return (self.weights[f] * self.idf[f][:, None]).sum(0) / max(1, len(f)) / self.temperature

    def _calibrate(self, feats: list[np.ndarray], labels: np.ndarray) -> float:
        """The temperature of least cross-entropy on sentences not trained on."""
        if not len(feats):
            return 1.0
        raw = np.array([self._logits(f) for f in feats])
        grid = np.geomspace(0.05, 20, 80)
        loss = [-np.log(_softmax(raw / t)[np.arange(len(labels)), labels] + 1e-9).mean() + 1e-3 * abs(np.log(t)) for t in grid]
        return float(grid[int(np.argmin(loss))])

    def _forget(self) -> None:
        self._known, self._filled = _Numbers(), 0
        self._table = np.zeros((0, len(LANGS) + 1), np.float32)

    def __getstate__(self) -> dict:
        keep = {k: v for k, v in self.__dict__.items() if k not in ("_known", "_filled", "_table", "weights", "idf")}
        rows = np.flatnonzero(np.abs(self.weights).any(1))
        return keep | {"sparse": (rows.astype(np.int32), self.weights[rows] * self.idf[rows][:, None])}

    def __setstate__(self, state: dict) -> None:
        rows, values = state.pop("sparse")
        self.__dict__.update(state)
        self.weights, self.idf = np.zeros((1 << BITS, len(LANGS)), np.float32), np.ones(1 << BITS, np.float32)
        self.weights[rows] = values
        self._forget()

    def _fill(self) -> None:
        """The vectors of words seen first: their n-grams' summed logits and their number."""
        new = list(islice(self._known, self._filled, None))
        if not new:
            return
        self._filled = len(self._known)
        text = "".join(f"<{w}>" for w in new)
        n = np.array([len(w) + 2 for w in new])
        letters = {c: c.encode() for c in set(text)}
        crc = {c: zlib.crc32(x) for c, x in letters.items()}
        one, size = np.array([crc[c] for c in text], np.uint32), np.array([len(letters[c]) for c in text])
        begin, many = np.cumsum(n) - n, 4 * n - 6  # words have a letter at least
        left = np.repeat(begin + n, n) - np.arange(len(text))
        at = (np.cumsum(many) - many)[word := np.repeat(np.arange(len(n)), n)] + np.arange(len(text)) - begin[word]
        grams, told = np.empty(int(many.sum()), np.int64), one
        for k in range(4):
            if k:
                told = joined_crc(told[:-1], one[k:], size[k:])
            ok = np.flatnonzero(left[: len(told)] > k)
            grams[at[ok]] = told[ok] & np.uint32((1 << BITS) - 1)
            at += n[word] - k
        share = np.array([1.0 if w in self.vocabulary else self.cfg.unknown_share for w in new])
        sums = np.add.reduceat(self.weights[grams] * self.idf[grams][:, None], np.cumsum(many) - many, axis=0) * share[:, None]
        self._table = np.concatenate([self._table, np.concatenate([sums, (many * share)[:, None]], axis=1).astype(np.float32)])

    def clauses(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each run of clauses of one language: its text, its words, its probabilities."""
        if len(self._known) > 300_000:
            self._forget()
        words, many, clause = words_of([t.lower() for t in texts], LETTER)
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(LANGS)))
        return self.runs(self.numbers(words), clause, np.repeat(np.arange(len(texts)), many))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Words' numbers, which hold as long as `_known` is the same."""
        return np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))

    def runs(self, ids: np.ndarray, clause: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`clauses` for words by their numbers, with their clause and text."""
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(LANGS)))
        starts = np.flatnonzero(np.concatenate(([True], (clause[1:] != clause[:-1]) | (text[1:] != text[:-1]))))
        owner = text[starts]
        self._fill()
        at, own = self._split(ids, starts, owner)
        total, n = np.add.reduceat(self._table.take(ids, axis=0), at, axis=0), np.diff(np.append(at, len(ids)))
        best = total[:, :-1].argmax(1)
        # neighbouring clauses of one language are one
        run = np.flatnonzero(np.concatenate(([True], (own[1:] != own[:-1]) | (best[1:] != best[:-1]))))
        total, n = np.add.reduceat(total, run, axis=0), np.add.reduceat(n, run)
        return own[run], n, _softmax(total[:, :-1] / total[:, -1:] / self.temperature)

    def _split(self, ids: np.ndarray, starts: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Clauses in which two languages meet without a mark are cut where both parts are clearest."""
        least = self.cfg.clause_words
        ends = np.append(starts[1:], len(ids))
        total = np.add.reduceat(self._table.take(ids, axis=0), starts, axis=0)
        top = _softmax(total[:, :-1] / total[:, -1:] / self.temperature).max(1)
        doubtful = np.flatnonzero((ends - starts >= 2 * least) & (top < self.cfg.sure))
        if not len(doubtful):
            return starts, owner
        cuts, owners = [], []
        for k in doubtful.tolist():
            parts = [(int(starts[k]), int(ends[k]))]
            while parts:
                a, b = parts.pop()
                if b - a < 2 * least:
                    continue
                sums = np.cumsum(self._table[ids[a:b]], axis=0)
                left, right = sums[least - 1 : b - a - least], sums[-1] - sums[least - 1 : b - a - least]
                p, q = (_softmax(x[:, :-1] / x[:, -1:] / self.temperature) for x in (left, right))
                score = np.log(p.max(1)) + np.log(q.max(1))
                score[p.argmax(1) == q.argmax(1)] = -np.inf
                at = int(score.argmax()) if len(score) else 0
                if len(score) and min(p[at].max(), q[at].max()) >= self.cfg.split:
                    cut_at = a + least + at
                    cuts.append(cut_at)
                    owners.append(owner[k])
                    parts += [(a, cut_at), (cut_at, b)]
        if not cuts:
            return starts, owner
        starts = np.concatenate([starts, cuts])
        order = np.argsort(starts, kind="stable")
        return starts[order], np.concatenate([owner, owners])[order]

    def label(self, texts: list[str]) -> list[tuple[str | None, float]]:
        """Language (or rw_mixed, or None) and confidence of plain-form texts."""
        return self.told(*self.clauses(texts), len(texts))

    def told(self, own: np.ndarray, n: np.ndarray, p: np.ndarray, m: int) -> list[tuple[str | None, float]]:
        """`label` for the clauses of `m` texts."""
        k = len(LANGS)
        best = p.argmax(1) if len(p) else np.zeros(0, int)
        clear = (n >= self.cfg.clause_words) & (p.max(1) >= self.cfg.clear) if len(p) else np.zeros(0, bool)
        mass, seen, sure = np.zeros((m, k)), np.zeros((m, k)), np.zeros((m, k))
        np.add.at(mass, own, p * n[:, None])
        np.add.at(seen, (own[clear], best[clear]), n[clear])
        np.maximum.at(sure, (own[clear], best[clear]), p.max(1)[clear])
        total, top = mass.sum(1), mass.argmax(1)
        mixed = (seen[:, 0] > 0) & (seen[:, 1:].max(1, initial=0) > 0)
        share = mass.max(1, initial=0) / np.where(total > 0, total, 1)
        both = np.minimum(sure[:, 0], sure[:, 1:].max(1, initial=0))
        return [
            (None, 0.0) if not t else ("rw_mixed", b) if x else (LANGS[k], s)
            for t, x, k, s, b in zip(total.tolist(), mixed.tolist(), top.tolist(), share.tolist(), both.tolist())
        ]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def train(samples: DataFrame, text: str = "sample_text", lang: str = "lang", cfg: LanguageConfig = LanguageConfig()) -> LanguageModel:
    """Fit on labelled rows, at most cfg.max_samples of them: those with the smallest hash of their text, in the texts' order,
    so that the same rows give the same model and no language is cut off."""
    rows = sorted((r[text], r[lang]) for r in hash_sample(samples.select(text, lang).dropna(), text, cfg.max_samples))
    by: dict[str, list[tuple[str, str]]] = {}
    for t, x in rows:
        by.setdefault(x, []).append((t, x))
    mixed = [r for i in range(max(map(len, by.values()), default=0)) for r in (by[x][i] for x in sorted(by) if i < len(by[x]))]
    return LanguageModel(mixed, cfg)


# What stands for no answer, beside what has no letter or digit.
NO_ANSWER = frozenset("n/a|na|n.a|null|none|nil|nan|undefined|empty|blank|no answer|no response|sans réponse|pas de réponse|nta gisubizo|hakuna jibu|tbd|unknown".split("|"))
_TAGS = re.compile(r"<[^<>]*>|```\w*")
_LETTER = re.compile(r"[^\W_]")


def is_empty(plain: str | None) -> bool:
    """Whether a text in its plain form is null, has nothing visible, or only a mark that stands for no answer."""
    if plain is None:
        return True
    if len(plain) > 60:
        return not _LETTER.search(_TAGS.sub(" ", plain))
    bare = _TAGS.sub(" ", plain).strip(" \n\t()[]{}<>\"'`*_.!-:;,")
    if not _LETTER.search(bare):
        return not any(ord(c) > 0x2600 for c in plain)  # a lone emoji is seen
    return bare.lower() in NO_ANSWER


def label_lines(model: LanguageModel, plain: list[str]) -> list[list[tuple[str, float]] | None]:
    """For each text in plain form: the language of each of its non-empty lines, if every line is in one language and
    they aren't all the same, else None. Lines too short to tell (items of a list) go with the line above."""
    lines = [[x for x in t.split("\n") if x.strip()] for t in plain]
    many = [i for i, x in enumerate(lines) if len(x) > 1]
    flat = [x for i in many for x in lines[i]]
    own, n, p = model.clauses(flat)
    by: dict[int, list[int]] = {}
    for k, o in enumerate(own.tolist()):
        by.setdefault(o, []).append(k)
    out: list[list[tuple[str, float]] | None] = [None] * len(plain)
    at = 0
    for i in many:
        told: list[tuple[str, float] | None] = []
        single = True
        for j in range(at, at + len(lines[i])):
            clear = [k for k in by.get(j, []) if n[k] >= model.cfg.clause_words and p[k].max() >= model.cfg.clear]
            langs = {int(p[k].argmax()) for k in clear}
            single &= len(langs) <= 1
            told.append((LANGS[langs.pop()], float(min(p[k].max() for k in clear))) if len(langs) == 1 else None)
        at += len(lines[i])
        if single and len({x[0] for x in told if x}) > 1:
            last = next(x for x in told if x)
            filled = []
            for x in told:
                last = x or last
                filled.append(last)
            out[i] = filled
    return out


def with_languages(df: DataFrame, keys: list[str], text: str, mode: str, model: LanguageModel, lines: bool) -> DataFrame:
    """<keys>, seg_no, mode, lang, confidence: a row of seg_no 0 for each text that isn't empty, with its label as given
    (trimmed, lower-cased; null where it is none of the known ones), and, if `lines`, rows for the lines of texts that
    change language by lines."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    given = F.lower(F.regexp_replace(df[mode], r"(?U)^[\s\u200b-\u200f\u2060\ufeff]+|[\s\u200b-\u200f\u2060\ufeff]+$", ""))
    source = df.select(*[df[k] for k in keys], F.when(given.isin(*MODES), given).alias("mode"), df[text].alias("_text"))
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "seg_no int", "mode string", "lang string", "confidence double"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            plain = [form(x, True) for x in batch.column(len(keys) + 1).to_pylist()]
            plain = [x if x and not is_empty(x) else "" for x in plain]
            labels = model.label(plain)
            segments = label_lines(model, plain) if lines else [None] * len(plain)
            row, seg, lang, sure = [], [], [], []
            for i, (x, c) in enumerate(labels):
                if x is None:
                    continue
                for k, (a, b) in enumerate([(x, c), *(segments[i] or [])]):
                    row.append(i)
                    seg.append(k)
                    lang.append(a)
                    sure.append(b)
            take = pa.array(row, pa.int64())
            kept = [batch.column(k).take(take) for k in range(len(keys) + 1)]
            yield pa.RecordBatch.from_arrays([*kept[:-1], pa.array(seg, pa.int32()), kept[-1], pa.array(lang, pa.string()), pa.array(sure, pa.float64())], [*keys, "seg_no", "mode", "lang", "confidence"])

    return source.mapInArrow(scan, schema)


def wrong_label() -> Column:
    """Of the rows of with_languages: a line of a text that changes language, or a text whose label is missing or wrong."""
    return (F.col("seg_no") > 0) | F.col("mode").isNull() | ((F.col("mode") != "control") & (F.col("mode") != F.col("lang")))
