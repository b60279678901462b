"""Personal data: exact patterns, and a linear-chain conditional random field
over word-shape features that adds what the patterns miss.

The field labels the words of a text as email, ip, card, phone or none. A
word is reduced to a shape, the shape to features; a word's score takes its
own features and those of its neighbours. It is trained here on a small
labelled table by gradient ascent on the conditional likelihood. Decoding is
Viterbi over whole texts in numpy batches; words that the best path must
leave unlabelled, whatever their neighbours are, cut a text into independent
pieces, so that only the pieces between them are decoded.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from basketlens.llm.common import slices
from basketlens.llm.pii_examples import EXAMPLES

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def _is_card(text: str) -> bool:
    return 13 <= len(d := _digits(text)) <= 19 and luhn(d)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@`` and a domain: from each @ backwards, so that a
    long run of name characters without one is not read again and again."""
    before = 0
    for m in _DOMAIN.finditer(text):
        at = m.start()
        while at > before and text[at - 1] in _LOCAL:
            at -= 1
        if at < m.start():
            before = m.end()
            yield at, before


def _is_byte(digits: str) -> bool:
    """At most 255; tested by length first, since numbers can be of any length."""
    plain = digits.lstrip("0")
    return len(plain) <= 3 and int(plain or 0) <= 255


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers joined by points; a longer chain gives one for every four."""
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = at + sum(map(len, four)) + 3
            if all(map(_is_byte, four)):
                yield at, end
            at = end + 1


def base_spans(text: str | None) -> list[Span]:
    """The spans that the exact patterns find, leftmost without overlap per
    kind, in the order of ``KINDS`` and then of their starts."""
    if not text:
        return []
    out: list[Span] = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGITS.search(text):
        out += [("ip", a, b) for a, b in _ips(text)]
        out += [("card", m.start(), m.end()) for m in _CARD.finditer(text) if _is_card(m[0])]
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


# -- word shapes ---------------------------------------------------------

_NEVER = 1000.0
_TRIM = ".,;:!?\"'<>"
_WORD = re.compile(r"\S+")
_HEX_GROUPS = re.compile(r"(?=.*:.*:)[0-9a-fA-F:]{6,}\Z")
_BUCKETS = ((0, "0"), (2, "1-2"), (3, "3"), (4, "4"), (8, "5-8"), (12, "9-12"), (19, "13-19"))
#: words that announce a kind, in the languages of the corpus
_ANNOUNCE = {w: k for k, ws in {"phone": "call phone tel telefon telefono téléphone mobile fax dial number appelez llame rufen",
                                "email": "mail e-mail email contact write", "card": "card visa karte carte tarjeta pay",
                                "ip": "ip host server ping route"}.items() for w in ws.split()}

_PLAIN = {case: ("plain", f"case={case}") for case in ("lower", "title", "upper", "mixed")}


def features(word: str) -> tuple[str, ...]:
    """What the field sees of a word: its shape, not its letters."""
    core = word if word.isalpha() else word.strip(string.punctuation)
    if core.isalpha() or not core:
        known = _ANNOUNCE.get(core.lower())
        if known is not None:
            return "plain", f"announces={known}"
        return _PLAIN["lower" if core.islower() else "title" if core.istitle() else "upper" if core.isupper() else "mixed"]
    core = word.strip(_TRIM)
    digits = sum(c.isdigit() and c.isascii() for c in core)
    rest = re.sub(r"[0-9]+", "d", re.sub(r"[^\W\d_]+", "a", core))
    bucket = next((name for most, name in _BUCKETS if digits <= most), "20+")
    out = [f"digits={bucket}", f"shape={rest if len(rest) <= 9 else 'long'}", f"dots={min(rest.count('.'), 4)}"]
    if digits and not set(core) - set("0123456789()-./ +"):
        out.append(f"number,{bucket}")
    if "@" in core[1:-1]:
        out.append("at sign within")
    elif re.fullmatch(r"[\w.%+-]+[\[(]at[\])][\w.-]+", core):
        out.append("spelled at sign")
    if core[:1] == "(" and digits:
        out.append("opens with number")
    if core[:1] == "+":
        out.append("opens with plus")
    if _HEX_GROUPS.match(core):
        out.append("hex groups")
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}([:/][0-9]+)?", core):
        out.append("four numbers")
    return tuple(out)


class Field:
    """Weights: ``unary`` (feature x offset -1, 0, 1 x label) and ``pair`` (label x label)."""

    def __init__(self, index: dict[str, int], unary: np.ndarray, pair: np.ndarray):
        self.index, self.unary, self.pair = index, unary, pair
        self.rows: dict[tuple[str, ...], int] = {}
        self.table = np.zeros((0, 3, len(KINDS) + 1))
        self.shape_of: dict[str, int] = {}

    def _shape(self, word: str) -> int:
        f = features(word)
        if f not in self.rows:
            self.rows[f] = len(self.rows)
            known = [self.index[x] for x in f if x in self.index]
            score = self.unary[known].sum(axis=0)
            if f[0] == "plain":  # a word of letters alone is never personal data of these kinds
                score[1, 1:] = -_NEVER
            self.table = np.concatenate([self.table, score[None]])
        return self.rows[f]

    def emissions(self, words: list[str], starts: np.ndarray) -> np.ndarray:
        """Scores (word x label) of concatenated texts that begin at ``starts``."""
        if len(self.shape_of) > 200_000:  # a worker's memory stays bounded
            self.shape_of.clear()
        get = self.shape_of.get
        ids = np.empty(len(words), np.int64)
        for i, w in enumerate(words):
            s = get(w)
            if s is None:
                s = self.shape_of[w] = self._shape(w)
            ids[i] = s
        before, own, after = (np.ascontiguousarray(self.table[:, i], np.float32) for i in range(3))
        out = own[ids]
        if len(words) > 1:
            first = starts[(starts > 0) & (starts < len(words))] - 1  # pairs of words of two texts
            for rows, add in ((out[1:], before[ids[:-1]]), (out[:-1], after[ids[1:]])):
                add[first] = 0
                rows += add
        return out

    def decode(self, scores: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Best labels of concatenated texts. A word is surely unlabelled if
        that beats each label by more than the label's two transitions can
        make good, whatever its neighbours' labels are; the pieces between
        such words are decoded by length, many at once."""
        labels = np.zeros(len(scores), np.int64)
        into = (self.pair - self.pair[:, :1]).max(axis=0).clip(0)
        out_of = (self.pair - self.pair[:1]).max(axis=1).clip(0)
        unsure = np.flatnonzero((scores[:, :1] - scores <= into + out_of)[:, 1:].any(axis=1))
        if not len(unsure):
            return labels
        is_start = np.zeros(len(scores) + 1, bool)
        is_start[starts] = True
        is_start[-1] = True
        cut = np.flatnonzero((np.diff(unsure) > 1) | is_start[unsure[1:]]) + 1
        pieces = np.split(unsure, cut)
        by_length: dict[int, list[np.ndarray]] = {}
        for p in pieces:
            by_length.setdefault(len(p), []).append(p)
        for length, group in by_length.items():
            for k in range(0, len(group), max(1, 100_000 // length)):
                at = np.stack(group[k:k + max(1, 100_000 // length)])
                # a neighbour outside the piece is unlabelled, unless the text begins or ends there
                first = np.where(is_start[at[:, 0]][:, None], 0, self.pair[0])
                last = np.where(is_start[at[:, -1] + 1][:, None], 0, self.pair[:, 0])
                score = scores[at[:, 0]] + first
                back = []
                for t in range(1, length):
                    through = score[:, :, None] + self.pair
                    back.append(through.argmax(axis=1))
                    score = through.max(axis=1) + scores[at[:, t]]
                best = (score + last).argmax(axis=1)
                labels[at[:, -1]] = best
                for t in range(length - 1, 0, -1):
                    best = back[t - 1][np.arange(len(at)), best]
                    labels[at[:, t - 1]] = best
        return labels


def marked(example: str) -> tuple[str, list[Span]]:
    """A marked-up sentence as its text and spans."""
    text, spans, at = "", [], 0
    for m in re.finditer(r"<(\w+)>(.*?)</\1>", example):
        text += example[at:m.start()]
        spans.append((m[1], len(text), len(text) + len(m[2])))
        text += m[2]
        at = m.end()
    return text + example[at:], spans


def train(examples: Iterable[str] = EXAMPLES, steps: int = 400, rate: float = 0.1, decay: float = 0.01) -> Field:
    """Adam on the regularised conditional log-likelihood of the marked
    sentences, all in one padded batch; deterministic."""
    index: dict[str, int] = {}
    words, gold = [], []
    for example in examples:
        text, spans = marked(example)
        found = list(_WORD.finditer(text))
        words.append([[index.setdefault(f, len(index)) for f in features(m[0])] for m in found])
        gold.append([next((KINDS.index(k) + 1 for k, a, b in spans if a < m.end() and m.start() < b), 0) for m in found])
    n, longest, labels = len(words), max(map(len, words)), len(KINDS) + 1
    x = np.zeros((n, longest, 3, len(index)))  # offsets: features of the word before, of itself, of the word after
    y, mask = np.zeros((n, longest), int), np.zeros((n, longest), bool)
    for i, sentence in enumerate(words):
        y[i, :len(sentence)], mask[i, :len(sentence)] = gold[i], True
        for t, fs in enumerate(sentence):
            x[i, t, 1, fs] = 1
            if t + 1 < len(sentence):
                x[i, t + 1, 0, fs] = 1
            if t:
                x[i, t - 1, 2, fs] = 1
    x = x.reshape(n, longest, -1)
    theta = np.zeros(x.shape[2] * labels + labels * labels)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    hot = np.eye(labels)[y] * mask[:, :, None]
    both = mask[:, 1:] & mask[:, :-1]
    gold_pair = np.einsum("nta,ntb,nt->ab", hot[:, :-1], hot[:, 1:], both)

    def lse(a: np.ndarray, axis: int) -> np.ndarray:
        top = a.max(axis=axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))

    for step in range(1, steps + 1):
        unary, pair = theta[:-labels * labels].reshape(-1, labels), theta[-labels * labels:].reshape(labels, labels)
        e = x @ unary
        ahead, behind = np.zeros_like(e), np.zeros_like(e)
        ahead[:, 0] = e[:, 0]
        for t in range(1, longest):
            nxt = lse(ahead[:, t - 1][:, :, None] + pair, 1) + e[:, t]
            ahead[:, t] = np.where(mask[:, t][:, None], nxt, ahead[:, t - 1])
        total = lse(ahead[:, -1], 1)
        for t in range(longest - 2, -1, -1):
            prev = lse(pair + (e[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(mask[:, t + 1][:, None], prev, 0)
        one = np.exp(ahead + behind - total[:, None, None]) * mask[:, :, None]
        two = np.exp(ahead[:, :-1, :, None] + pair + (e[:, 1:] + behind[:, 1:])[:, :, None, :]
                     - total[:, None, None, None]) * both[:, :, None, None]
        grad = np.concatenate([np.einsum("ntf,ntl->fl", x, hot - one).ravel(),
                               (gold_pair - two.sum(axis=(0, 1))).ravel()]) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    unary = theta[:-labels * labels].reshape(3, len(index), labels).transpose(1, 0, 2)
    return Field(index, unary, theta[-labels * labels:].reshape(labels, labels))


_SHAPED = {"email": re.compile(r"[\w.%+-]+(?:@|[\[(]at[\])])[\w-]+(?:\.[\w-]+)*"),
           "ip": re.compile(r"[0-9]+(?:\.[0-9]+){3}(?:[:/][0-9]+)?|(?=[^:]*:[^:]*:)[0-9a-fA-F:]{6,}")}


def _is(kind: str, text: str) -> bool:
    """Whether a labelled stretch has what its kind must have."""
    if kind == "card":
        return _is_card(text) and not set(text) - set("0123456789 .-")
    if kind == "phone":
        return 9 <= len(_digits(text)) <= 15 and not set(text) - set("0123456789 ().-/")
    if kind == "ip" and "." in text:
        return bool(_SHAPED[kind].fullmatch(text)) and all(map(_is_byte, re.split(r"[:/]", text)[0].split(".")))
    return bool(_SHAPED[kind].fullmatch(text))


def added_spans(text: str, words: list[tuple[int, int]], labels: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans of labelled words: a run of card or phone words is one, each
    email or ip word is one; trimmed, and only if the kind's form holds and
    no exact span is touched."""
    out: list[Span] = []
    at = 0
    while at < len(labels):
        kind = KINDS[labels[at] - 1] if labels[at] else None
        end = at + 1
        while kind in ("card", "phone") and end < len(labels) and labels[end] == labels[at]:
            end += 1
        if kind:
            a, b = words[at][0], words[end - 1][1]
            while a < b and text[a] in _TRIM + ")":
                a += 1
            while a < b and text[b - 1] in _TRIM + "(":
                b -= 1
            if not any(x < b and a < y for _, x, y in base) and _is(kind, text[a:b]):
                out.append((kind, a, b))
        at = end
    return out


def find(docs: DataFrame, field: Field) -> DataFrame:
    """``row`` (struct of the columns of ``docs``, so names cannot clash) and
    ``spans``: kind, start, end (code points of column text, end exclusive)
    and whether the exact patterns gave it, by kind and start. A null or
    empty text has none; rows are independent of each other."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in slices(batches, 512):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            words = [t.split() for t in texts]
            starts = np.cumsum([0, *map(len, words)])
            labels = field.decode(field.emissions([w for ws in words for w in ws], starts[:-1]), starts[:-1])
            out = []
            for i, text in enumerate(texts):
                base = base_spans(text)
                mine = labels[starts[i]:starts[i + 1]]
                more = added_spans(text, [m.span() for m in _WORD.finditer(text)], mine, base) if mine.any() else []
                both = [(*s, True) for s in base] + [(*s, False) for s in more]
                both.sort(key=lambda s: (KINDS.index(s[0]), s[1]))
                out.append([dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in both])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["row", "spans"])

    given = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"))
    span = StructType([StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()),
                       StructField("base", BooleanType())])
    return given.mapInArrow(run, StructType([given.schema["row"], StructField("spans", ArrayType(span))]))
