"""Problem 2: prompt and response pairs whose response doesn't answer.

A response is cut into clauses (sentences, list items, lines), a linear-chain conditional random field tags each of them
as answer, refusal, echo, foreign or unfinished, and the words the tags cover decide the pair's defect:

* `empty`: null, nothing visible, or only a mark that stands for no answer (no clause to tag);
* `copied`: echo covers (nearly) all words;
* `refusal`: refusals, and nothing that answers;
* `wrong_language`: foreign covers (nearly) all words;
* `truncated`: the last clause is unfinished.

The field is trained on pairs made from every row that has a message and a response:
responses as they are, with their full stop taken off, cut at a random place, exchanged for a copy of the message in
several guises, for a response in another language (with the message as it is, and with one that asks for that language), or
for a refusal composed of stock phrases. Features are the share of
a clause's words that lie in runs shared with the last user message, whether its language is the message's (a model of
the same kind as problem 6's), how and on what words it ends and how often sentences end on them, open brackets and
fences, its place, and its words; of short responses also how words begin and how many of those that the message doesn't hold
are seldom in responses, so that refusals in other words than the stock phrases are told too.

Nothing is sampled. Words and their endings are counted over all rows; known are those that stand more often than in one of
1500 responses (and at least twice), which bounds their number whatever the table's size. Rows fall into pieces of about `piece`
by their hash, `block` pieces are trained on as one block in a task, and a feature's weights are the mean over all blocks,
each counted as often as it has the feature: a table of one piece is trained on as a whole. Tagging is applied to every row.
Rows without a user message can't be copies or foreign; extra columns aren't read; repeated rows are judged alike.
"""

from __future__ import annotations

import gc
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.forms import _OTHER, form
from millrace.llm.language import LANGS, LETTER_OR_DIGIT, LanguageModel, is_empty, joined_crc, words_of
from millrace.session import release, stage

TAGS = ("answer", "refusal", "echo", "foreign", "unfinished")
ANSWER, REFUSAL, ECHO, FOREIGN, UNFINISHED = range(5)
_WORD = re.compile(r"[^\W_]+")
_LETTERS = re.compile(r"[^\W\d_]+")
_TURN = re.compile(r"(?:^|\n)(?:User|Assistant):[ \t]?")
_LABEL = re.compile(r"\n[^\n:]{4,24}:")
#: Ends of clauses, from a sentence's mark or a line's end on
_CUT = re.compile(r"[.!?\n](?:(?<=\n)\n*|[)\"'\]]*,?\s+)")
#: For texts of Latin-1: letters and digits in lower case, a space for the rest
_LOWER = "".join(c.lower() if _WORD.match(c) else " " for c in map(chr, range(256))).encode("latin-1")
#: A plain list of short items at the end
_WHOLE_LIST = re.compile(r"\n[-*•] [^\n*\"(`:,]{2,30}\n[-*•] [^\n*\"(`:,]{2,30}$")
_ITEM = re.compile(r"\s*(?:[-*•]|\d+[.)])\s")
BITS = 15

# How a message names a language it asks for.
ASKED = {
    "rw": "kinyarwanda|ikinyarwanda|kinyarwand",
    "en": "english|cyongereza|icyongereza|anglais|kiingereza|ingereza",
    "fr": "french|français|francais|gifaransa|igifaransa|kifaransa",
    "sw": "swahili|giswayire|igiswayire|giswahili|igiswahili|kiswahili",
}
# Short answers that are answers, as opening and name.
YES_NO = {
    "rw": "Yego, {t}.|Oya, {t}.|Yego, ni {t}.|Oya, si {t}.|Ni {t}.",
    "en": "Yes, it is {t}.|No, it is not {t}.|Yes, {t}.|It is {t}.",
    "fr": "Oui, c'est {t}.|Non, ce n'est pas {t}.|Oui, {t}.|C'est {t}.",
    "sw": "Ndiyo, ni {t}.|Hapana, si {t}.|Ndiyo, {t}.|Ni {t}.",
}
# Stock phrases of refusals: openings, cores ({t} is the topic), endings.
REFUSALS = {
    "rw": (
        "Mbabarira,|Ihangane, ariko|Birababaje ariko|Nsabye imbabazi:|Nk'umufasha w'ikoranabuhanga,|Oya,|",
        "sinshobora kugufasha kuri iki kibazo kijyanye na {t}|ntabwo nemerewe gusubiza ibyo usabye kuri {t}|ndakwangiye kuvuga kuri {t}"
        "|sinabasha gutanga igisubizo ku byerekeye {t}|ibyo ku bya {t} sinabikora|ibyo sinabikora|amategeko ngenderaho ambuza kuvuga kuri {t}"
        "|icyo kibazo cya {t} sinagisubiza; shaka inzobere|reka tuvuge ibindi, {t} ndayiretse|nta gisubizo mfite kuri {t}, kandi sinshaka gukeka|sinshobora gusubiza icyo kibazo|mpisemo kutavuga kuri {t}|simfite icyo mvuga kuri {t}, shaka ahandi",
        "Hari ikindi nagufasha?|Wabaza undi muntu ubizi.|Murakoze kubyumva.|Gerageza ikindi kibazo.|",
    ),
    "en": (
        "Sorry, but|I'm sorry,|I apologize,|Unfortunately,|As an assistant,|No,|",
        "I can't help with this request about {t}|I cannot answer that|I am not able to discuss {t}|it is not possible for me to discuss {t}|I would rather not"
        "|that is something I have to decline when it concerns {t}|my guidelines keep me from going into {t}|I must decline to answer about {t}|I won't talk about {t}"
        "|I have no answer on {t}, and I don't want to guess|I am unable to give an answer regarding {t}|let us talk about something else, I will leave {t} aside"
        "|I have to pass on {t}, please look elsewhere|I won't be providing anything regarding {t}|I would prefer to say nothing about {t}|answering about {t} is not something I do|that question on {t} is one for a specialist, not for me",
        "Thank you for understanding.|Please ask someone else.|Is there something else I can do?|Try another question.|",
    ),
    "fr": (
        "Désolé, mais|Je regrette,|Toutes mes excuses :|Malheureusement,|En tant qu'assistant,|Non,|",
        "je ne peux pas vous aider sur {t}|il m'est impossible de répondre à propos de {t}|je ne le ferai pas|je dois refuser de parler de {t}|je ne suis pas autorisé à répondre sur {t}"
        "|mes règles m'interdisent de parler de {t}|je ne répondrai pas à cette question sur {t}|je n'ai pas de réponse sur {t} et je ne veux pas deviner|parlons d'autre chose, je laisse {t} de côté"
        "|je préfère ne rien dire sur {t}|mes consignes m'interdisent de parler de {t}|je n'ai rien à dire sur {t}, cherchez ailleurs|je ne fournirai rien concernant {t}"
        "|cette question sur {t} relève d'un spécialiste, pas de moi|je ne suis pas en mesure de traiter {t}",
        "Merci de votre compréhension.|Demandez à quelqu'un d'autre.|Avez-vous un autre sujet ?|Essayez une autre question.|",
    ),
    "sw": (
        "Samahani,|Pole, lakini|Naomba radhi,|Kwa bahati mbaya,|Kama msaidizi,|Hapana,|",
        "siwezi kukusaidia kuhusu {t}|sitaweza kutoa jibu lolote juu ya {t}|sina ruhusa ya kujibu swali la {t}|sitafanya hivyo|ninakataa kuzungumza kuhusu {t}"
        "|kanuni zangu zinanizuia kuongelea {t}|swali hilo la {t} sitalijibu|sina jibu kuhusu {t} na sitaki kubahatisha|tuongee mengine, {t} naliacha|nalazimika kukataa swali la {t}"
        "|inabidi nikatae kuzungumzia {t}|haiwezekani kwangu kueleza {t}|miongozo yangu inanizuia kuzungumza kuhusu {t}|sina la kusema kuhusu {t}, tafuta kwingine|tuzungumze jambo jingine, {t} naliacha|swali la {t} ni la mtaalamu, si langu",
        "Asante kwa kuelewa.|Tafadhali muulize mtu mwingine.|Una swali jingine?|Jaribu swali lingine.|",
    ),
}
_REFUSING = re.compile(
    r"(?i)sinshobora|sinabi|sinabasha|sinagi|ntabwo nemerewe|ndakwangiye|ambuza|ndayiretse|sinshaka|nta gisubizo|can't help|cannot answer|decline|rather not|guidelines keep|not able to|unable to|possible for me"
    r"|peux pas|impossible de|ne le ferai|refuser|autorisé à|m'interdi|siwezi|sitaweza|sina ruhusa|sitafanya|sitali|ninakataa|kukataa|zinanizuia"
)
_REFUSING_PARTS = _REFUSING.pattern.removeprefix("(?i)").split("|")  # plain words, looked for first


@dataclass(frozen=True)
class PairConfig:
    piece: int = 3000  # rows that pairs are made from together
    block: int = 5  # pieces trained on together
    max_clauses: int = 16  # of a response to train on
    shard: int = 500
    epochs: int = 10  # over a piece; a block of several has as many steps in all
    rate: float = 0.12
    l2: float = 2e-4
    cover: float = 0.85
    seed: int = 11


def last_message(prompt: str | None) -> str:
    """The last user message of a prompt in plain form (all of it if no turns are marked)."""
    if not prompt:
        return ""
    at = prompt.rfind("\nUser: ")
    if at >= 0 and not _LABEL.search(prompt, at + 7):  # no later line that begins like a label, however it is spelled
        return _form(prompt[at + 7 :])
    text = _form(prompt)
    starts = [m for m in _TURN.finditer(text)]
    if not starts:
        return text
    users = [m for m in starts if m[0].lstrip("\n").startswith("User")]
    if not users:
        return ""
    last = users[-1]
    return text[last.end() : next((m.start() for m in starts if m.start() >= last.end()), len(text))]


def _form(text: str) -> str:
    """The plain form of a text, with its lines; most are so as they are."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER.search(text) or not text.replace("\n", "").isprintable():
        return form(text, True)
    return text


def _words(text: str) -> list[str]:
    """Its words in lower case."""
    try:
        return text.encode("latin-1").translate(_LOWER).decode("latin-1").split()
    except UnicodeEncodeError:
        return [w.lower() for w in _WORD.findall(text)]


def _sentences(text: str) -> list[str]:
    """Its parts between ends of clauses."""
    out, begin = [], 0
    for m in _CUT.finditer(text):
        a, b = m.span()
        out.append(text[begin : a if text[a] == "\n" else a + 1])
        begin = b
    out.append(text[begin:])
    return out


def _h(x: str) -> int:
    return zlib.crc32(x.encode()) & ((1 << BITS) - 1)


def _hs(crc: np.ndarray) -> np.ndarray:
    return (crc & np.uint32((1 << BITS) - 1)).astype(np.int32)


def _grid(*parts: list) -> np.ndarray:
    """Ids of the features spelled by one of each part."""
    return np.array([_h("".join(map(str, x))) for x in product(*parts)], np.int32).reshape([len(x) for x in parts])


class _Numbers(dict):
    def __missing__(self, x: str) -> int:
        self[x] = i = len(self)
        return i


class _Words(_Numbers):
    """Word -> its number; of the numbers: CRCs and bytes of the word and its beginnings, feature ids, counts."""

    def __init__(self, total: dict[str, int], final: dict[str, int], seldom: int, few: int, languages: LanguageModel):
        self.total, self.final, self.most, self.few = total, final, seldom, few
        self.languages, self.spoken = languages, languages._known
        self.seen = 0
        #: The language model's words in the word (one, but where it has digits), how many, and where they begin
        self.letters, self.many, self.begin = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: CRC and bytes of the word, ids of q0w, q1w, p (2, 3, 5 letters), s0 to s3; then whether it is seldom, unknown, and its bucket
        self.crc, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.ids = np.zeros((9, 0), np.int32)
        self.seldom, self.new, self.bucket = np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.int8)

    def fill(self) -> None:
        """The tables for words seen first."""
        new = list(islice(self, self.seen, None))
        if not new:
            return
        self.seen = len(self)
        letters = [[w] if w.isalpha() else _LETTERS.findall(w) for w in new]
        many = np.array([len(x) for x in letters], np.int64)
        self.begin = np.append(self.begin, len(self.letters) + np.cumsum(many) - many)
        self.many = np.append(self.many, many)
        self.letters = np.append(self.letters, self.languages.numbers([x for y in letters for x in y]))
        parts = []
        for cut_at in (None, 2, 3, 5):
            spelled = [w[:cut_at].encode() for w in new]
            parts.append((np.array([zlib.crc32(w) for w in spelled], np.uint32), np.array([len(w) for w in spelled], np.int64)))
        ids = [_hs(joined_crc(zlib.crc32(x), *parts[k])) for x, k in ((b"q0w", 0), (b"q1w", 0), (b"p", 1), (b"p", 2), (b"p", 3), (b"s0", 2), (b"s1", 2), (b"s2", 2), (b"s3", 2))]
        counts = [self.total.get(w, 0) for w in new]
        self.crc, self.size = np.append(self.crc, parts[0][0]), np.append(self.size, parts[0][1])
        self.ids = np.concatenate([self.ids, np.stack(ids)], axis=1)
        self.seldom = np.append(self.seldom, np.array(counts) <= self.most)
        self.new = np.append(self.new, [w not in self.total for w in new])
        self.bucket = np.append(self.bucket, np.array([BUCKETS.index(_bucket(self.final.get(w, 0), n, self.few)) for w, n in zip(new, counts)], np.int8))


BUCKETS = ("few", "0", "1", "2", "3", "4", "5")


def _bucket(final: int, total: int, few: int) -> str:
    if total < few:
        return "few"
    r = final / total
    return "0" if r < 0.01 else "1" if r < 0.1 else "2" if r < 0.3 else "3" if r < 0.6 else "4" if r < 0.95 else "5"


class PairTagger:
    """The conditional random field with what its features need."""

    def __init__(self, pairs: list[tuple[str, str]], languages: LanguageModel, cfg: PairConfig = PairConfig()):
        self.cfg, self.languages = cfg, languages
        self.final: dict[str, int] = {}
        self.total: dict[str, int] = {}
        self.seldom, self.few = 0, 3
        self.know(*count_endings(r for _, r in pairs), len(pairs))
        self.node = np.zeros((1 << BITS, len(TAGS)), np.float32)
        self.step = np.zeros((len(TAGS), len(TAGS)), np.float32)
        made = self._made(pairs, cfg.seed)
        if made:
            self._train([self._prepared(made)], cfg.epochs)

    def __getstate__(self) -> dict:
        state = {k: v for k, v in self.__dict__.items() if k != "words"}
        rows = np.flatnonzero(self.node.any(1))
        return state | {"node": (rows.astype(np.int32), self.node[rows])}

    def __setstate__(self, state: dict) -> None:
        rows, values = state.pop("node")
        self.__dict__.update(state)
        self.node = np.zeros((1 << BITS, len(TAGS)), np.float32)
        self.node[rows] = values
        self._forget()

    # ---- features

    def know(self, total: dict[str, int], final: dict[str, int], n: int) -> None:
        """Take the counts of `n` responses; which words are known, few or seldom goes by their share."""
        least = least_count(n)
        self.total = {k: v for k, v in total.items() if v >= least}
        self.few = max(3, -(-n // 1000))
        self.seldom = n // 100  # words that next to no response has
        self.final = {k: final[k] for k in self.total if final.get(k)}
        self._forget()

    def _forget(self) -> None:
        self.words = _Words(self.total, self.final, self.seldom, self.few, self.languages)

    @staticmethod
    def clauses(response: str) -> list[str]:
        return [c for c in _sentences(response) if c[:1].isalnum() or _WORD.search(c)]

    def features(self, rows: list[tuple[str, str]], split: list[list[str]] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """For plain (message, response) rows: feature ids, features of each clause, clauses of each row, words of each clause.

        Features are texts, told apart by the low bits of their CRC. They aren't spelled one by one: words are numbered, and the
        CRC of a text made of parts follows from those of its parts."""
        split = [self.clauses(r) for _, r in rows] if split is None else split
        sizes = np.array([len(cs) for cs in split], np.int32)
        if not sizes.any():
            return np.zeros(0, np.int32), np.zeros(0, np.int32), sizes, np.zeros(0, np.int32)
        if len(self.words) > 300_000:
            self.languages._forget()
        if self.words.spoken is not self.languages._known:
            self._forget()
        messages, clauses, words = _Numbers(), _Numbers(), self.words
        of_message = np.array([messages[m] if cs else 0 for (m, _), cs in zip(rows, split)], np.int64)
        of_clause = np.array([clauses[c] for cs in split for c in cs], np.int64)
        clauses, messages = list(clauses), list(messages)
        of_clauses, of_messages = self._numbered(clauses), self._numbered(messages)
        words.fill()
        (spelled, count, _), asks = of_clauses, of_messages[:2]
        langs = self._languages(of_messages, of_clauses)
        # what a clause's features depend on; rows made from one pair share most clauses
        json = np.array([r[:1] in "{[" for _, r in rows], np.int64)
        first = np.zeros(len(of_clause), np.int64)
        first[(np.cumsum(sizes, dtype=np.int64) - sizes)[sizes > 0]] = 1
        key = ((np.repeat(of_message, sizes) * len(clauses) + of_clause) * 4 + np.repeat(np.minimum(sizes, 4) - 1, sizes)) * 4 + np.repeat(json, sizes) * 2 + first
        key, where = np.unique(key, return_inverse=True)
        message, clause = np.divmod(key >> 4, len(clauses))
        ids, long = self._clauses(message, clause, (key >> 2 & 3) + 1, key >> 1 & 1, key & 1, messages, clauses, langs, asks, spelled, count)
        # a clause's features, and after those of a row's last clause those of its end
        ends, end_long = self._endings(rows, split, spelled, count, of_clause, sizes)
        last = np.cumsum(sizes, dtype=np.int64)[sizes > 0] - 1
        own = long[where]
        more = np.zeros(len(own), np.int64)
        more[last] = end_long
        whole = own + more
        begin = np.cumsum(whole) - whole
        out = np.empty(int(whole.sum()), np.int32)
        out[_spans(begin, own)] = ids[_spans((np.cumsum(long) - long)[where], own)]
        out[_spans((begin + own)[last], end_long)] = ends
        return out, whole.astype(np.int32), sizes, count[of_clause].astype(np.int32)

    def _numbered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of the words of all texts, one after the other; how many each text has; ends of clauses before each."""
        ws, many, clause = words_of(texts, LETTER_OR_DIGIT)
        return np.fromiter(map(self.words.__getitem__, map(str.lower, ws)), np.int64, len(ws)), many, clause

    def _clauses(self, message: np.ndarray, clause: np.ndarray, many: np.ndarray, json: np.ndarray, first: np.ndarray, messages: list[str], clauses: list[str], langs: tuple[list[str | None], list[str | None]], asks: tuple[np.ndarray, np.ndarray], flat: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of clauses in rows of `many` clauses (4: or more), but for those of a response's end, and their number."""
        words = self.words
        n = length[clause]
        w = flat[_spans((np.cumsum(length) - length)[clause], n)]
        owner = np.repeat(np.arange(len(n)), n)
        begin = np.cumsum(n) - n
        place = np.arange(len(w)) - np.repeat(begin, n)
        known, held = _shared(w, message[owner], place, np.repeat(n, n), *asks, len(words))
        share = np.add.reduceat(held, begin, dtype=np.int64) / n
        own = n - np.add.reduceat(known, begin, dtype=np.int64)
        share[(n < 3) & (own == 0)] = 1.0
        echo = np.where(share == 0, 0, 1 + (share * 4.99).astype(np.int64))
        code = {None: -1, "rw_mixed": 4} | {x: i for i, x in enumerate(LANGS)}
        asked = np.zeros((len(messages), len(LANGS) + 2), bool)
        for i, m in enumerate(messages):
            for x in _asked(m):
                asked[i, code[x]] = True
        lang, told = np.array([code[x] for x in langs[0]])[message], np.array([code[x] for x in langs[1]])[clause]
        match = np.select([(lang < 0) | (lang > 3) | (told < 0), told == lang, asked[message, told], told == 4], [0, 1, 2, 3], 4)
        quoted = np.array(['"' in c or "«" in c for c in clauses], np.int64)[clause] * (1 - json)  # JSON quotes all
        n6, n4 = np.minimum(n, 6), np.minimum(n, 4)
        short = many <= 3  # a refusal is short; how its words begin carries over to words never seen
        fixed = [np.full(len(n), _h("b")), _E[echo], _M[match], _Q[quoted], _FIRST[first], _ONLY[(many > 1) * 1], _N[n6], _EN[echo, n6], _MN[match, n4], _EM[echo, match]]
        begins = np.minimum(n, 12)
        long = len(fixed) + 2 * n - 1 + short * (begins + 2 * n + n4 + 3)
        start = np.cumsum(long) - long
        out = np.empty(int(long.sum()), np.int32)
        for k, f in enumerate(fixed):
            out[start + k] = f
        at = start + len(fixed)
        out[at[owner] + place] = words.ids.take(quoted[owner] * words.ids.shape[1] + w)
        at = at + n
        two = np.flatnonzero(place[1:] > 0)
        a, b = w[two], w[two + 1]
        space = joined_crc(joined_crc(zlib.crc32(b"w"), words.crc, words.size), np.full(len(words.crc), zlib.crc32(b" "), np.uint32), np.ones(len(words.crc)))
        out[at[owner[two]] + place[two]] = _hs(joined_crc(space[a], words.crc[b], words.size[b]))
        at = at + n - 1
        in_short = np.flatnonzero(short[owner])
        o, p, v = owner[in_short], place[in_short], w[in_short]
        few = p < 12
        out[at[o[few]] + p[few]] = words.ids[2].take(v[few])
        at = at + begins
        out[at[o] + p] = words.ids[3].take(v)
        out[(at + n)[o] + p] = words.ids[4].take(v)
        at = at + 2 * n
        few = p < 4
        out[at[o[few]] + p[few]] = words.ids[5 + p[few], v[few]]
        at = (at + n4)[short]
        rare = np.add.reduceat(~known & words.seldom[w], begin, dtype=np.int64) / np.maximum(1, own)
        rare = (rare * 4.99).astype(np.int64)[short]
        out[at], out[at + 1], out[at + 2] = _R[rare], _RN[rare, n6[short], many[short]], _O[(own / n * 4.99).astype(np.int64)[short]]
        return out, long

    def _languages(self, messages: tuple[np.ndarray, ...], clauses: tuple[np.ndarray, ...]) -> tuple[list[str | None], list[str | None]]:
        """Languages of messages, and of clauses, given as `_numbered` has them."""
        words, told = self.words, []
        for w, of_text, clause in (messages, clauses):
            text, many = np.repeat(np.arange(len(of_text)), of_text), words.many[w]
            if (many == 1).all():
                told.append(self.languages.runs(words.letters[words.begin[w]], clause, text))
            else:
                told.append(self.languages.runs(words.letters[_spans(words.begin[w], many)], np.repeat(clause, many), np.repeat(text, many)))
        own, n, p = told[1]
        out: list[str | None] = [None] * len(clauses[1])
        size: dict[int, int] = {}
        best, top = (p.argmax(1), p.max(1)) if len(p) else (own, own)
        sure = np.flatnonzero((top >= 0.9) & (n >= 2))
        for o, k, b in zip(own[sure].tolist(), n[sure].tolist(), best[sure].tolist()):
            x = LANGS[b]
            if out[o] is None:
                out[o], size[o] = x, k
            elif out[o] != x and k >= 4 and size[o] >= 4:
                out[o] = "rw_mixed"
            elif k > size[o]:
                out[o], size[o] = x, k
        return [x for x, _ in self.languages.told(*told[0], len(messages[1]))], out

    def _endings(self, rows: list[tuple[str, str]], split: list[list[str]], spelled: np.ndarray, count: np.ndarray, of_clause: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features of the end of each row that has clauses, and their number."""
        words, names = self.words, list(self.words)
        total, final, few = self.total, self.final, self.few
        last = of_clause[np.cumsum(sizes, dtype=np.int64)[sizes > 0] - 1]
        many, end_at = count[last], np.cumsum(count)[last]
        ones, twos, lengths = spelled[end_at - 1].tolist(), spelled[end_at - 2].tolist(), many.tolist()
        ids: list[list[int]] = []
        told: dict[str, list[int]] = {}
        upper, bucket, at = [], [], []  # of those that end on a word, after three others at least
        for k, (i, one, many_words) in enumerate(zip(np.flatnonzero(sizes).tolist(), ones, lengths)):
            end = rows[i][1].rstrip()
            if end.endswith(":)"):
                end = end[:-2].rstrip()
            body = end.rstrip(")\"'*_` ]}")
            times = end.count
            kind = "stop"
            marked = '"' in end and times('"') % 2 == 1 or "**" in end and times("**") % 2 == 1
            if "{" in end and times("{") > times("}") or "[" in end and times("[") > times("]") or "```" in end and times("```") % 2 == 1 or "(" in end and times("(") > times(")"):
                kind = f"open1{int(marked)}"
            elif marked:
                kind = "open01"
            elif end[-1:] in ",:;":
                kind = "comma"
            elif body[-1:].isalnum():
                kind = "item" if _ITEM.match(split[i][-1]) else "word"
            if kind == "word" and many_words > 3:
                one = names[one]
                two = f"{names[twos[k]]} {one}"
                n = total.get(two, 0)
                at.append(k)
                upper.append(body[-len(one) :][:1].isupper())
                bucket.append(0 if n < few else BUCKETS.index(_bucket(final.get(two, 0), n, few)))
                ids.append([])
            elif kind in ("item", "word"):
                ids.append(self._end(kind, [names[w] for w in spelled[end_at[k] - many_words : end_at[k]].tolist()], body))
            else:
                ids.append(told.get(kind) or told.setdefault(kind, self._end(kind, [], body)))
        long = np.array([len(x) for x in ids], np.int64)
        if not at:
            return np.fromiter((x for y in ids for x in y), np.int32), long
        n = many[at]
        to = end_at[at]
        tail = np.stack([*(spelled[np.maximum(0, to - k)] for k in range(1, 6)), spelled[to - n]])
        two, cap = np.array(bucket), np.array(upper, np.int64)
        crc, size = words.crc, words.size
        after = lambda x, k: joined_crc(zlib.crc32(x.encode()) if isinstance(x, str) else x, crc[tail[k]], size[tail[k]])
        mark = lambda x, c: joined_crc(x, np.full(len(n), zlib.crc32(c), np.uint32), np.ones(len(n)))
        one = words.bucket[tail[0]]
        columns = [np.full(len(n), _h("END")), np.full(len(n), _h("ENDword")), _END1[one], _END2[two], _ENDNEW[words.new[tail[0]] * 1, cap]]
        columns += [_hs(after(f"END-{k + 1}", k)) for k in range(5)]
        columns += [_hs(after(mark(after("END23", 2), b" "), 1)), _hs(after(mark(after("END34", 3), b" "), 2)), _hs(after(_ENDB[one], 2))]
        start = after("ENDf", 5)
        five = n > 5
        columns += [_hs(np.where(five, joined_crc(start, np.full(len(n), zlib.crc32(b"True"), np.uint32), np.full(len(n), 4)), joined_crc(start, np.full(len(n), zlib.crc32(b"False"), np.uint32), np.full(len(n), 5))))]
        columns += [_ENDL[np.minimum(n, 9)], _hs(after(mark(start, b"-"), 2))]
        table = np.stack(columns, axis=1).astype(np.int32)
        keep = np.ones(table.shape, bool)
        keep[:, 9] = n > 4
        long[at] = keep.sum(1)
        begin = np.cumsum(long) - long
        out = np.empty(int(long.sum()), np.int32)
        out[_spans(begin[at], long[at])] = table[keep]
        others = [k for k, x in enumerate(ids) if x]
        out[_spans(begin[others], long[others])] = [x for y in ids for x in y]
        return out, long

    def _end(self, kind: str, ws: list[str], body: str) -> list[int]:
        if kind == "item":
            new = ws[-1] not in self.total
            f = ["END", "ENDitem", f"ENDitemnew{new}", f"ENDitem{min(len(ws), 5)}{new}"]
        elif kind == "word":
            f = ["END", "ENDword"]
            one, two = ws[-1], " ".join(ws[-2:])
            told = _bucket(self.final.get(one, 0), self.total.get(one, 0), self.few)
            f += [f"END1{told}", f"END2{_bucket(self.final.get(two, 0), self.total.get(two, 0), self.few)}"]
            f.append(f"ENDnew{one not in self.total}{body[-len(one):][:1].isupper()}")
            f += [f"END-{k}{ws[-k]}" for k in (1, 2, 3, 4, 5) if len(ws) >= k]
            f += [f"END23{' '.join(ws[-3:-1])}", f"END34{' '.join(ws[-4:-2])}", f"END{told}{ws[-3] if len(ws) > 2 else ''}"]
            f += [f"ENDf{ws[0]}{len(ws) > 5}", f"ENDl{min(len(ws), 9)}", f"ENDf{ws[0]}-{ws[-3] if len(ws) > 3 else ''}"]
        else:
            f = ["END", "ENDopen", f"END{kind}"] if kind.startswith("open") else ["END", f"END{kind}"]
        return [_h(x) for x in f]

    # ---- training

    def _made(self, pairs: list[tuple[str, str]], seed: int) -> list[tuple[str, str, list[int], list[str]]]:
        """Pairs with their clauses and the clauses' tags."""
        rng = random.Random(seed)
        langs = [x for x, _ in self.languages.label([r for _, r in pairs])]
        asks = [x for x, _ in self.languages.label([m for m, _ in pairs])]
        good, by = [], {}
        for (m, r), x, a in zip(pairs, langs, asks):
            cs = self.clauses(r)
            low = r.lower()
            plain = [c for c in cs if not (_REFUSING.search(c) and '"' not in c)] if any(map(low.__contains__, _REFUSING_PARTS)) else cs
            mw, rw = set(_words(m)), _words(r)
            if not cs or len(cs) > self.cfg.max_clauses or not x or not a or len(plain) < len(cs) or sum(map(mw.__contains__, rw)) > 0.7 * len(rw):
                continue
            by.setdefault(x, []).append(r)
            if x == a and (r.rstrip()[-1:] in ".!?}" or _WHOLE_LIST.search(r.rstrip())):
                good.append((m, r, x, cs))
        made: list[tuple[str, str, list[int], list[str]]] = []

        def add(m: str, r: str, tag: int, last: int | None = None, cs: list[str] | None = None) -> None:
            cs = self.clauses(r) if cs is None else cs
            if cs:
                made.append((m, r, [tag] * (len(cs) - 1) + [tag if last is None else last], cs))

        words = sorted({w for m, *_ in good for w in _words(m) if len(w) > 3})
        for i, (m, r, x, cs) in enumerate(good):
            add(m, r, ANSWER, cs=cs)
            stem = r.rstrip()
            if stem[-1:] in ".!?":
                sentence = cs[-1]
                # where it is the end of the text, what is cut off it leaves the clauses before as they are
                before = cs[:-1] if len(sentence) > 1 and stem.endswith(sentence) else None
                end = len(stem) - len(sentence)
                add(m, stem[:-1], ANSWER, cs=None if before is None else [*before, sentence[:-1]])
                if len(sentence) > 20:
                    for _ in range(2):
                        at = rng.randrange(4, len(sentence) - 3)
                        if not (sentence[at].isspace() and sentence[:at].rstrip()[-1:] in ".!?"):
                            short = stem[: len(stem) - len(sentence)] + sentence[:at]
                            if rng.random() < 0.5:  # at a word's end
                                short = short.rsplit(" ", 1)[0]
                            short = short.rstrip()
                            if short[-1:].isalnum():
                                add(m, short, ANSWER, UNFINISHED, cs=None if before is None or len(short) <= end else [*before, short[end:]])
            elif stem[-1:] == "}":
                add(m, stem[: rng.randrange(len(stem) // 2, len(stem))], ANSWER, UNFINISHED)
            elif len(stem.rsplit(" ", 1)[-1]) > 5:  # a list cut within its last word, or after a comma
                add(m, stem[: -rng.randrange(2, 4)], ANSWER, UNFINISHED)
                add(m, stem + rng.choice([",", ":"]), ANSWER, UNFINISHED)
            if i % 3 == 0:
                self._add_copy(add, made, rng, m, r, words)
            if i % 3 == 1 and not _asked(m):
                other = [y for y in by if y not in (x, "rw_mixed")]
                if other and x != "rw_mixed":
                    y = rng.choice(other)
                    r2 = rng.choice(by[y])
                    add(m, r2, FOREIGN)
                    name = rng.choice(ASKED[y].split("|"))  # the same answer to a message that asks for its language
                    add(rng.choice([f"{name}: {m}", f"{m} ({name})", f"{m} {name}."]), r2, ANSWER)
            if i % 3 == 2:
                a, b, c = (s.split("|") for s in REFUSALS["rw" if x == "rw_mixed" else x])
                topic = rng.choice([w for w in _WORD.findall(m) if len(w) > 3] or ["ibyo"])
                parts = []
                for _ in range(1 if rng.random() < 0.7 else 2):
                    s = f"{rng.choice(a)} {rng.choice(b).format(t=topic)}".strip()
                    parts.append(s[0].upper() + s[1:] + ".")
                if rng.random() < 0.5:
                    parts.append(rng.choice(c))
                refusal = " ".join(p for p in parts if p)
                if x != "rw_mixed":
                    add(m, refusal, REFUSAL)
                    names = [w for w in _WORD.findall(m) if w[:1].isupper()] or [topic]
                    if rng.random() < 0.5:
                        add(m, rng.choice(YES_NO[x].split("|")).format(t=names[-1]), ANSWER)
        for x, (a, b, c) in REFUSALS.items():  # every stock phrase a few times, however rare its language is in the sample
            asked = [m for m, _, y, _ in good if y == x]
            for core in b.split("|") if asked else ():
                for _ in range(4):
                    m = rng.choice(asked)
                    topic = rng.choice([w for w in _WORD.findall(m) if len(w) > 3] or ["ibyo"])
                    text = f"{rng.choice(a.split('|'))} {core.format(t=topic)}".strip() + "."
                    add(m, f"{text[0].upper()}{text[1:]} {rng.choice(c.split('|'))}".strip(), REFUSAL)
        return made

    def _add_copy(self, add, made: list, rng: random.Random, m: str, r: str, words: list[str]) -> None:
        kind = rng.randrange(7)
        text = m
        ws = m.split(" ")
        if kind == 0:
            text = rng.choice([m.upper(), m.lower(), re.sub(r"[^\w' ]", "", m)])
        elif kind == 1:
            text = rng.choice(["Ikibazo: ", "Q: ", "User: ", "> ", "Question: ", "Swali: "]) + m
        elif kind == 2:
            text = f"{m} {m}"
        elif kind in (3, 4) and len(ws) > 6:
            ws[rng.randrange(len(ws))] = rng.choice(words) if kind == 3 else ""
            text = " ".join(w for w in ws if w)
        elif kind == 5:  # the question again, then an answer
            intro = rng.choice(["Urabaza uti: ", "You asked: ", "Vous demandez : ", "Umeuliza: "])
            n, k = len(self.clauses(intro + m)), len(self.clauses(r))
            both = f"{intro}{m}\n{r}"
            made.append((m, both, [ECHO] * n + [ANSWER] * k, self.clauses(both)))
            return
        add(m, text, ECHO)

    def _prepared(self, made: list[tuple[str, str, list[int], list[str]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Feature ids, features of each clause, clauses of each row, tag of each clause."""
        ids, long, sizes, _ = self.features([x[:2] for x in made], [x[3] for x in made])
        gold = np.array([t for x in made for t in x[2]], np.int8)
        if len(gold) != len(long):
            raise ValueError("clauses and tags differ")
        return ids, long, sizes, gold

    def _train(self, pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], epochs: int) -> np.ndarray:
        """Stochastic maximum likelihood: steps of Adam over shards of the pairs, with forward and backward sums. How often
        each feature occurs is returned."""
        c, k = self.cfg, len(TAGS)
        ids, long, sizes, gold = (np.concatenate(x) for x in zip(*pieces))
        begin, head = np.cumsum(long, dtype=np.int64) - long, np.cumsum(sizes, dtype=np.int64) - sizes
        uses = np.bincount(ids, minlength=1 << BITS)
        used = np.flatnonzero(uses)
        number = np.cumsum(uses > 0) - 1
        shards = []
        for part in np.array_split(np.random.default_rng(c.seed).permutation(len(sizes)), max(1, len(sizes) // c.shard)):
            of, rows = _by_place(head[part], sizes[part])
            n = long[of].astype(np.int64)
            tags = gold[of].astype(np.int64)
            steps = np.zeros((k, k))
            at = 0
            for m, then in zip(rows, rows[1:]):
                np.add.at(steps, (tags[at : at + then], tags[at + m : at + m + then]), 1)
                at += m
            shards.append((number[ids[_spans(begin[of], n)]], n, rows, tags, steps))
        del ids, number
        params = [np.zeros((len(used), k)), np.zeros((k, k))]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        t, last = 0, epochs * len(shards)
        for _ in range(epochs):
            for shard in shards:
                t += 1
                grads = self._gradients(params, *shard)
                rate = c.rate * (1 - t / (last + 1)) + 0.005
                for p, g, a, b in zip(params, grads, first, second):  # in place: these are the large arrays
                    g += c.l2 * p
                    a *= 0.9
                    a += 0.1 * g
                    b *= 0.99
                    g *= g
                    g *= 0.01
                    b += g
                    np.multiply(b, 1 / (1 - 0.99**t), out=g)
                    np.sqrt(g, out=g)
                    g += 1e-6
                    np.divide(a, g, out=g)
                    g *= rate / (1 - 0.9**t)
                    p -= g
        self.node[used] = params[0]
        self.step = params[1].astype(np.float32)
        return uses

    @staticmethod
    def _gradients(params: list[np.ndarray], flat: np.ndarray, long: np.ndarray, rows: list[int], gold: np.ndarray, steps: np.ndarray) -> list[np.ndarray]:
        """Of a shard whose clauses stand by their place, of rows with more clauses first: rows[j] have a clause at place j.
        Forward and backward are shares of each place's sum, so they neither vanish nor overflow."""
        (w, step), k = params, len(TAGS)
        score = np.add.reduceat(w.take(flat, axis=0), np.cumsum(long) - long, axis=0)
        score -= np.maximum.reduce(score.T)[:, None]
        x = np.exp(score, out=score)
        go, ones = np.exp(step - step.max()), np.ones((k, k))  # by ones: a row's sum in each of its columns
        at = np.cumsum([0, *rows]).tolist()
        alpha, beta = np.empty_like(x), np.ones_like(x)
        np.divide(x[: rows[0]], x[: rows[0]] @ ones, out=alpha[: rows[0]])
        for i, j, m in zip(at, at[1:], rows[1:]):
            a = alpha[i : i + m] @ go
            a *= x[j : j + m]
            np.divide(a, a @ ones, out=alpha[j : j + m])
        for i, j, m in zip(at[-3::-1], at[-2::-1], rows[:0:-1]):
            x[j : j + m] *= beta[j : j + m]
            b = x[j : j + m] @ go.T
            np.divide(b, b @ ones, out=beta[i : i + m])
        later = x[at[1] :]  # of places after the first, with what follows
        before = alpha[np.concatenate([np.arange(i, i + m) for i, m in zip(at, rows[1:])] or [at[:0]]).astype(np.int64)]
        joint = before.T @ (later / ((before * (later @ go.T)) @ ones))
        alpha *= beta
        alpha /= alpha @ ones
        alpha[np.arange(len(gold)), gold] -= 1
        alpha /= rows[0]
        node = np.empty_like(w)
        for y in range(k):
            node[:, y] = np.bincount(flat, weights=np.repeat(alpha[:, y], long), minlength=len(w))
        return [node, (joint * go - steps) / rows[0]]

    # ---- tagging

    def tags(self, rows: list[tuple[str, str]]) -> list[list[tuple[int, int]]]:
        """(tag, words) of each clause of plain (message, response) rows, by Viterbi over all rows at once."""
        ids, long, sizes, words = self.features(rows)
        if not len(ids):
            return [[] for _ in rows]
        long = long.astype(np.int64)
        scores = np.add.reduceat(self.node.take(ids, axis=0), np.cumsum(long) - long, axis=0)
        of, many = _by_place(np.cumsum(sizes, dtype=np.int64) - sizes, sizes)
        scores = scores[of]  # long rows first: step j concerns a shrinking head
        at = np.cumsum([0, *many])
        best = np.zeros((many[0], len(TAGS)), np.float32)
        back: list[np.ndarray] = []
        for j, m in enumerate(many):
            if j:
                options = best[:m, :, None] + self.step
                back.append(options.argmax(1).astype(np.int8))
                best[:m] = options.max(1)
            best[:m] += scores[at[j] : at[j] + m]
        state = best.argmax(1)
        path = np.empty(len(of), np.int8)
        for j in range(len(many) - 1, -1, -1):
            m = many[j]
            path[of[at[j] : at[j] + m]] = state[:m]
            if j:
                state[:m] = back[j - 1][np.arange(m), state[:m]]
        told = list(zip(path.tolist(), words.tolist()))
        ends = np.cumsum(sizes, dtype=np.int64).tolist()
        return [told[a:b] for a, b in zip([0, *ends], ends)]

    def defect(self, clauses: list[tuple[int, int]]) -> str | None:
        """The defect of a pair from the words its tags cover."""
        cover = [0] * len(TAGS)
        for t, n in clauses:
            cover[t] += n
        total = sum(cover)
        if not total:
            return None
        answer = cover[ANSWER] + cover[UNFINISHED]
        if cover[ECHO] >= self.cfg.cover * total:
            return "copied"
        if cover[REFUSAL] and answer <= 0.5 * total and cover[REFUSAL] >= cover[FOREIGN]:
            return "refusal"
        if cover[FOREIGN] >= self.cfg.cover * total:
            return "wrong_language"
        return "truncated" if clauses[-1][0] == UNFINISHED else None


_ASKED = {x: re.compile(rf"(?i)(?<!\w)(?:{names})(?!\w)") for x, names in ASKED.items()}


# Ids of features that few values spell
_E, _M, _Q, _FIRST, _ONLY = _grid([f"e{i}" for i in range(6)]), _grid(MATCH := ["m?", "m=", "masked", "mmixed", "m#"]), _grid(["qFalse", "qTrue"]), _grid(["later", "first"]), _grid(["only", "many"])
_N, _EN = _grid([f"n{i}" for i in range(7)]), _grid([f"e{i}n" for i in range(6)], range(7))
_MN, _EM = _grid([f"{m}n" for m in MATCH], range(5)), _grid([f"e{i}" for i in range(6)], MATCH)
_R, _RN, _O = _grid([f"r{i}" for i in range(5)]), _grid([f"r{i}" for i in range(5)], range(7), range(4)), _grid([f"o{i}" for i in range(5)])
_END1, _END2, _ENDL = _grid(["END1"], BUCKETS)[0], _grid(["END2"], BUCKETS)[0], _grid(["ENDl"], range(10))[0]
_ENDNEW, _ENDB = _grid(["ENDnewFalse", "ENDnewTrue"], [False, True]), np.array([zlib.crc32(f"END{b}".encode()) for b in BUCKETS], np.uint32)


#: In lower case every name of a language holds one of these
_STEMS = ("rwand", "engl", "ereza", "angla", "fren", "fran", "fara", "swah", "sway")


def _asked(message: str) -> list[str]:
    if message.isascii() and not any(map(message.lower().__contains__, _STEMS)):
        return []
    return [x for x, names in _ASKED.items() if names.search(message)]


def _among(keys: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Whether keys are among the sorted `own`."""
    return own[np.minimum(np.searchsorted(own, keys), len(own) - 1)] == keys if len(own) else np.zeros(len(keys), bool)


def _shared(w: np.ndarray, message: np.ndarray, place: np.ndarray, n: np.ndarray, has: np.ndarray, length: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """For words of clauses, with their message, place and the clause's length: whether the message holds the word, and
    whether the word lies in three in a row that the message holds in a row."""
    whose = np.repeat(np.arange(len(length)), length)
    own = np.sort(whose * words + has)
    key = message * words + w
    marks = np.zeros(1 << 21, bool)  # most words are in no message: only those that may be are looked up
    marks[own * 0x9E3779B1 >> 9 & 0x1FFFFF] = True
    maybe = np.flatnonzero(marks[key * 0x9E3779B1 >> 9 & 0x1FFFFF])
    known = np.zeros(len(w), bool)
    known[maybe] = _among(key[maybe], own)
    held = np.zeros(len(w), bool)
    begin = np.flatnonzero(known[:-2] & known[1:-1] & known[2:] & (place + 2 < n)[:-2])
    inside = np.flatnonzero((np.arange(len(has)) - np.repeat(np.cumsum(length) - length, length) + 2 < np.repeat(length, length)))
    if len(begin) and len(inside):
        name = np.concatenate([has[inside], w[begin]])
        for of in ((has, w, 1), (has, w, 2)):
            name = np.unique(name * words + np.concatenate([of[0][inside + of[2]], of[1][begin + of[2]]]), return_inverse=True)[1]
        name = np.concatenate([whose[inside], message[begin]]) * (int(name.max()) + 1) + name
        begin = begin[_among(name[len(inside) :], np.sort(name[: len(inside)]))]
        for k in range(3):
            held[begin + k] = True
    return known, held


def _by_place(head: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The clauses of rows, given by each row's first and their number: those at the first place, at the second and so on,
    rows with more clauses first; and how many have that place."""
    order = np.argsort(-sizes.astype(np.int64), kind="stable")
    head, sizes = head[order], sizes[order]
    rows = [int((sizes > j).sum()) for j in range(int(sizes[0]))] if len(sizes) else []
    return np.concatenate([head[:m] + j for j, m in enumerate(rows)]) if rows else np.zeros(0, np.int64), rows


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one span after the other."""
    sizes = sizes.astype(np.int64)
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


def count_endings(responses: Iterable[str]) -> tuple[Counter, Counter]:
    """How often words, and pairs of words, stand at all, and how often they end a sentence."""
    parts = [s for r in responses for s in _sentences(r)]
    numbers = _Numbers()
    spelled, many, _ = words_of(parts, LETTER_OR_DIGIT)
    w = np.fromiter(map(numbers.__getitem__, map(str.lower, spelled)), np.int64, len(spelled))
    names, n = list(numbers), len(numbers)
    inner = np.ones(len(w), bool)
    inner[np.cumsum(many)[many > 0] - 1] = False
    inner = np.flatnonzero(inner)
    stop = np.array([s.rstrip(" )\"'").endswith((".", "!", "?")) for s in parts], bool)
    ends, ends_two = np.cumsum(many)[stop & (many > 0)] - 1, np.cumsum(many)[stop & (many > 1)] - 1

    def counts(one: np.ndarray, two: np.ndarray) -> Counter:
        ones = np.bincount(one, minlength=n)
        keys, times = np.unique(two, return_counts=True)
        told = Counter({names[i]: k for i, k in enumerate(ones.tolist()) if k})
        told.update({f"{names[i]} {names[j]}": k for i, j, k in zip((keys // n).tolist(), (keys % n).tolist(), times.tolist())})
        return told

    return counts(w, w[inner] * n + w[inner + 1]), counts(w[ends], w[ends_two - 1] * n + w[ends_two])


def least_count(n: int) -> int:
    """How often a word known from n responses stands at least: they are at most 1500 times the words of a response."""
    return max(2, -(-n // 1500))


def plain_pairs(pairs: DataFrame, key: str, prompt: str, response: str) -> DataFrame:
    """<key>, _h (hash of the key), _row (hash of the row), _m (last user message in plain form, empty where there is none) and _r
    (response in plain form, null where it is empty) of each row."""
    raw = pairs.select(F.col(key), F.xxhash64(key).alias("_h"), F.col(prompt).alias("_p"), F.col(response).alias("_r")).withColumn("_row", F.xxhash64("_h", "_p", "_r"))

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 2000):
                batch = whole.slice(start, 2000)
                responses = [None if x is None else _form(x) for x in batch.column(3).to_pylist()]
                responses = [None if is_empty(x) else x for x in responses]
                messages = ["" if x is None else last_message(p) for p, x in zip(batch.column(2).to_pylist(), responses)]
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(4), pa.array(messages, pa.string()), pa.array(responses, pa.string())], [key, "_h", "_row", "_m", "_r"])

    return raw.mapInArrow(plain, f"`{key}` {dict(pairs.select(key).dtypes)[key]}, _h long, _row long, _m string, _r string")


#: Steps of a whole unit in which weights are summed, as whole numbers, so that the order of the sum doesn't matter
UNIT = 1 << 20


def fit(pairs: DataFrame, key: str, prompt: str, response: str, languages: LanguageModel, cfg: PairConfig = PairConfig()) -> PairTagger:
    """Train on pairs made from all rows: counts as an aggregate, blocks of pieces in tasks, the mean of their weights."""
    plain = stage(plain_pairs(pairs, key, prompt, response), "pairs")
    tagger = _fit(plain, key, languages, cfg)
    release(plain)
    return tagger


def _fit(plain: DataFrame, key: str, languages: LanguageModel, cfg: PairConfig) -> PairTagger:
    spark = plain.sparkSession
    rows = plain.filter("_m <> '' AND _r IS NOT NULL")
    tagger = PairTagger([], languages, cfg)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, final = 0, Counter(), Counter()

        def out() -> pa.RecordBatch:
            grams = ["", *total]
            batch = pa.RecordBatch.from_arrays([pa.array(grams, pa.string()), pa.array([n, *total.values()], pa.int64()), pa.array([final[g] for g in grams], pa.int64())], ["gram", "total", "final"])
            total.clear()
            final.clear()
            return batch

        for whole in batches:
            for start in range(0, len(whole), 2000):
                responses = whole.column(0).slice(start, 2000).to_pylist()
                n += len(responses)
                for known, new in zip((total, final), count_endings(responses)):
                    known.update(new)
                if len(total) > 300_000:
                    yield out()
                    n = 0
        yield out()

    counted = rows.select("_r").mapInArrow(count, "gram string, total long, final long").groupBy("gram").agg(F.sum("total").alias("total"), F.sum("final").alias("final"))
    counted = stage(counted, "grams")
    n = sum(r["total"] for r in counted.filter("gram = ''").collect())
    if not n:
        release(counted)
        return tagger
    known = counted.filter((F.col("gram") != "") & (F.col("total") >= least_count(n))).collect()
    release(counted)
    tagger.know({r["gram"]: r["total"] for r in known}, {r["gram"]: r["final"] for r in known}, n)

    pieces = -(-n // cfg.piece)
    blocks = -(-pieces // cfg.block)
    epochs = -(-cfg.epochs * blocks // pieces)
    shared = spark.sparkContext.broadcast(tagger)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger, at, held, ready = shared.value, None, [], []

        def prepare() -> None:
            made = tagger._made(held, cfg.seed + at)
            if made:
                ready.append(tagger._prepared(made))
            held.clear()

        def weights() -> pa.RecordBatch:
            uses = tagger._train(ready, epochs)
            used = np.flatnonzero(uses)
            n = np.concatenate([uses[used], np.full(len(TAGS), sum(len(x[2]) for x in ready))])
            w = np.rint(np.concatenate([tagger.node[used], tagger.step]).astype(np.float64) * UNIT).astype(np.int64) * n[:, None]
            ready.clear()
            ids = np.concatenate([used, -1 - np.arange(len(TAGS))]).astype(np.int32)
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n.astype(np.int64)), *(pa.array(np.ascontiguousarray(x)) for x in w.T)], ["id", "n", *TAGS])

        gc.disable()  # nothing here is cyclic, and looking for cycles among so many small lists takes a tenth of the time
        try:
            for whole in batches:  # in the order of pieces
                for start in range(0, len(whole), 1000):
                    batch = whole.slice(start, 1000)
                    piece = batch.column(0).to_numpy()
                    for a, b in zip(edges := [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(piece)], edges[1:]):
                        if held and (piece[a] != at or len(held) >= 2 * cfg.piece):  # beyond twice its size only where rows repeat
                            prepare()
                            if len(ready) >= 2 * cfg.block:
                                yield weights()
                        at = int(piece[a])
                        held += zip(batch.column(1).slice(a, b - a).to_pylist(), batch.column(2).slice(a, b - a).to_pylist())
            if held:
                prepare()
            if ready:
                yield weights()
        finally:
            gc.enable()

    placed = rows.withColumn("_piece", F.pmod("_row", F.lit(pieces)).cast("int"))
    placed = placed.repartitionById(blocks, F.col("_piece") % blocks).sortWithinPartitions("_piece", "_h", F.col(f"`{key}`"), "_m", "_r").select("_piece", "_m", "_r")
    sums = placed.mapInArrow(train, "id int, n long, " + ", ".join(f"{t} long" for t in TAGS)).groupBy("id").agg(F.sum("n").alias("n"), *[F.sum(t).alias(t) for t in TAGS])
    for r in sums.collect():  # at most as many as there are features
        mean = np.array([r[t] for t in TAGS]) / r["n"] / UNIT
        if r["id"] < 0:
            tagger.step[-1 - r["id"]] = mean
        else:
            tagger.node[r["id"]] = mean
    shared.unpersist()
    return tagger


def pair_defects(pairs: DataFrame, key: str, prompt: str, response: str, tagger: PairTagger) -> DataFrame:
    """<key>, defect (null if none), and the share of the response's words under each tag."""
    return _tagged(plain_pairs(pairs, key, prompt, response), key, tagger)


def fit_and_tag(pairs: DataFrame, key: str, prompt: str, response: str, languages: LanguageModel, cfg: PairConfig = PairConfig()) -> DataFrame:
    """`pair_defects` by a tagger fitted on the same rows, whose plain form is made once."""
    plain = stage(plain_pairs(pairs, key, prompt, response), "pairs")
    return _tagged(plain, key, _fit(plain, key, languages, cfg))


def _tagged(plain: DataFrame, key: str, tagger: PairTagger) -> DataFrame:
    shared = plain.sparkSession.sparkContext.broadcast(tagger)
    kinds = dict(plain.select(key).dtypes)
    schema = f"`{key}` {kinds[key]}, defect string, " + ", ".join(f"{t} double" for t in TAGS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for whole in batches:
            for start in range(0, max(1, len(whole)), 2000):
                batch = whole.slice(start, 2000)
                rows = [("", "") if r is None else (m, r) for m, r in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                tags = tagger.tags(rows)
                defect = ["empty" if not r else tagger.defect(t) for (_, r), t in zip(rows, tags)]
                shares = [[0.0] * len(tags) for _ in TAGS]
                for i, t in enumerate(tags):
                    n = sum(x for _, x in t)
                    for tag, x in t:
                        shares[tag][i] += x / n
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(defect, pa.string()), *(pa.array(s, pa.float64()) for s in shares)], [key, "defect", *TAGS])

    return plain.select(key, "_m", "_r").mapInArrow(scan, schema)
