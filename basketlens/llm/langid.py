"""Language spans: script ranges narrow the candidates, then Viterbi over
per-word scores with a switching penalty.

The model is byte-trigram counts per language (hashed into a fixed table, so
its size is languages x 2**16 whatever the corpus) and each language's script
counts, gathered from all labelled training rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from basketlens.llm.common import portions

TABLE_BITS = 16
UNKNOWN = "und"
# First code points of script ranges (Unicode blocks) and their scripts.
_SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
            (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
            (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"),
            (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"), (0x3100, "other"),
            (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
            (0xFB00, "latin"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, "other"), (0x20000, "han")]
_STARTS = np.array([s for s, _ in _SCRIPTS], np.uint32)
SCRIPTS = sorted({n for _, n in _SCRIPTS})
_SCRIPT_OF = np.array([SCRIPTS.index(n) for _, n in _SCRIPTS])


def script_of(code_points: np.ndarray) -> np.ndarray:
    return _SCRIPT_OF[np.searchsorted(_STARTS, code_points, "right") - 1]


def trigrams(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table slots of the byte trigrams around each non-blank byte of a text
    that starts and ends with a blank, and the bytes' positions."""
    at = np.flatnonzero(raw[1:-1] != 32) + 1
    x = raw.astype(np.uint32)
    h = (x[at - 1] << np.uint32(16)) | (x[at] << np.uint32(8)) | x[at + 1]
    return (h * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS), at


def _bytes(words: list[str]) -> np.ndarray:
    return np.frombuffer((" " + " ".join(words) + " ").encode("utf-8", "surrogatepass"), np.uint8)


class Model:
    def __init__(self, langs: list[str], score: np.ndarray, allowed: np.ndarray):
        self.langs, self.score, self.allowed = langs, score, allowed

    def words(self, words: list[str], most: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
        """Scores (word x language) and whether the word has a letter; the
        trigrams of ``most`` words are held at a time."""
        parts = [self._words(words[at:at + most]) for at in range(0, len(words), most)]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = _bytes(words)
        slot, at = trigrams(raw)
        word = np.cumsum(raw == 32)[at] - 1
        first = np.flatnonzero(np.diff(word, prepend=-1))
        out = np.add.reduceat(self.score[slot], first, axis=0)
        letters = np.zeros(len(words), bool)
        first_letter = np.zeros(len(words), np.uint32)
        for i, w in enumerate(words):
            if w.isalpha() and w.isascii():
                letters[i] = True
            else:
                c = next((c for c in w if c.isalpha()), None)
                if c is not None:
                    letters[i], first_letter[i] = True, ord(c)
        out += np.where(self.allowed[script_of(first_letter)], 0, -100)
        out[~letters] = 0
        return out, letters


def fit(docs: DataFrame) -> Model:
    """Counts over every row of ``docs`` (text, lang) with both set."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in portions(batches, lambda b: b.column(0)):
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text.lower())
            for lang, texts in by_lang.items():
                whole = " ".join(texts)
                slot, _ = trigrams(_bytes(whole.split()))
                grams[lang] = grams.get(lang, 0) + np.bincount(slot, minlength=1 << TABLE_BITS)
                cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
                n = np.bincount(script_of(cp[cp >= 0xAA]), minlength=len(SCRIPTS))
                n[SCRIPTS.index("latin")] += int(((cp >= 97) & (cp <= 122)).sum())
                scripts[lang] = scripts.get(lang, 0) + n
        for lang, n in grams.items():
            both = np.concatenate([n, scripts[lang]])
            slot = np.flatnonzero(both)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot)), pa.array(slot.astype(np.int32)), pa.array(both[slot].astype(np.int64))],
                ["lang", "slot", "n"])

    counts = (docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
              .where("text is not null and lang is not null")
              .mapInArrow(run, "lang string, slot int, n long").groupBy("lang", "slot").agg(F.sum("n").alias("n")))
    got = counts.toArrow()
    lang, slot, n = (got.column(i).to_numpy() for i in range(3))
    langs = sorted(set(lang))
    table = np.zeros((len(langs), (1 << TABLE_BITS) + len(SCRIPTS)))
    table[np.searchsorted(langs, lang) if len(langs) else [], slot] = n
    grams, scripts = table[:, :1 << TABLE_BITS] + 0.1, table[:, 1 << TABLE_BITS:]
    score = np.log(grams / grams.sum(axis=1, keepdims=True))
    share = scripts / np.maximum(1, scripts.sum(axis=1, keepdims=True))
    allowed = (share >= 0.005).T  # script x language
    allowed[~allowed.any(axis=1)] = True
    return Model(langs, np.ascontiguousarray(score.T).astype(np.float32), allowed)


def _single(s: np.ndarray, penalty: float) -> int:
    """The one language whose whole-text path is optimal, or -1 if that is
    not sure: no stretch in another language may gain more than a switch, nor
    may the first and the last stretch of a path without it, which has one
    switch fewer than stretches, gain more than that together."""
    best = int(s.sum(axis=0).argmax())
    gain = np.cumsum(s - s[:, best:best + 1], axis=0)
    before = np.minimum.accumulate(np.vstack([np.zeros((1, s.shape[1]), gain.dtype), gain[:-1]]), axis=0)
    ends = gain.max() + (gain[-1] - before[-1]).max()  # largest gains of a prefix and of a suffix
    return best if max((gain - before).max(), ends) <= penalty else -1


def viterbi(seqs: list[np.ndarray], penalty: float, most: int = 400_000) -> list[np.ndarray]:
    """Best label sequence of each score matrix; sequences of like length are
    decoded together, at most ``most`` padded words at a time."""
    out: list[np.ndarray] = [np.empty(0, np.int16)] * len(seqs)
    order = sorted(range(len(seqs)), key=lambda i: len(seqs[i]))
    while order:
        longest = len(seqs[order[-1]])
        take = order[-max(1, most // max(1, longest)):]
        take = [i for i in take if 2 * len(seqs[i]) >= longest]
        del order[len(order) - len(take):]
        n, labels = len(take), seqs[take[0]].shape[1]
        s = np.zeros((longest, n, labels), np.float32)
        for k, i in enumerate(take):
            s[:len(seqs[i]), k] = seqs[i]
        back = np.empty((longest, n, labels), np.int16)
        own, row = np.arange(labels, dtype=np.int16)[None, :], np.arange(n)
        score = s[0].copy()
        for t in range(1, longest):
            top = score.argmax(axis=1)
            switch = (score[row, top] - penalty)[:, None]
            stay = score >= switch
            back[t] = np.where(stay, own, top[:, None])
            score = np.where(stay, score, switch) + s[t]
        path = np.empty((longest, n), np.int16)
        path[-1] = score.argmax(axis=1)
        for t in range(longest - 1, 0, -1):
            path[t - 1] = back[t, row, path[t]]
        for k, i in enumerate(take):
            out[i] = path[:len(seqs[i]), k]
    return out


def identify(docs: DataFrame, model: Model, penalty: float = 12.0) -> DataFrame:
    """One row per row of ``docs``: ``row`` (struct of all its columns),
    ``lang_pred`` (the language of most words, ties to the smaller name;
    ``und`` for a null text, one without letters, or an empty model),
    ``score`` (share of the words with letters that it labels, 0 for ``und``)
    and ``spans`` (start and end word, language)."""

    # the text is sent once, inside the row, unless it has to be cast
    cast = docs.schema["text"].dataType != StringType()
    place = docs.columns.index("text")

    def texts(batch: pa.RecordBatch) -> pa.Array:
        return batch.column(1) if cast else batch.column(0).field(place)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, texts, 1 << 22):
            ids: dict[str, int] = {}
            docs_ = [np.array([ids.setdefault(w, len(ids)) for w in t.lower().split()] if t else [], np.int64)
                     for t in texts(batch).to_pylist()]
            labels: dict[int, np.ndarray] = {}
            if ids and model.langs:
                scores, letters = model.words(list(ids))
                wait: list[int] = []
                for i, d in enumerate(docs_):
                    if len(d) and letters[d].any():
                        one = _single(scores[d], penalty)
                        if one >= 0:
                            labels[i] = np.full(len(d), one, np.int16)
                        else:
                            wait.append(i)
                labels |= dict(zip(wait, viterbi([scores[docs_[i]] for i in wait], penalty), strict=True))
            pred, score, spans = [], [], []
            for i, d in enumerate(docs_):
                if i not in labels:
                    pred.append(UNKNOWN)
                    score.append(0.0)
                    spans.append([])
                    continue
                n = np.bincount(labels[i][letters[d]], minlength=len(model.langs))
                pred.append(model.langs[int(n.argmax())])
                score.append(float(n.max() / n.sum()))
                cut = np.flatnonzero(np.diff(labels[i])) + 1
                spans.append([{"start": int(a), "end": int(b), "lang": model.langs[labels[i][a]]}
                              for a, b in zip([0, *cut], [*cut, len(d)], strict=True)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("lang", pa.string())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(spans, kind)],
                ["row", "lang_pred", "score", "spans"])

    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    given = docs.select(row, docs["text"].cast("string").alias("text")) if cast else docs.select(row)
    spans_type = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType()),
                                       StructField("lang", StringType())]))
    schema = StructType([given.schema["row"], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType()), StructField("spans", spans_type)])
    return given.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    """Rows that are never learned from: crc32(doc_id as text) mod 4 is 2
    (a null doc_id is not held out)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
