"""Language of texts and of the spans of mixed-language texts.

Method: a word's script narrows its candidate languages to those seen in that script; each
candidate scores the word by its character trigrams (naive Bayes over hashed byte trigrams,
including the spaces around the word); Viterbi over the words of a text with a penalty for each
switch labels every word, and runs of one label are the spans. A text's language is that of most
of its letters' bytes.

The trigram counts come from a bounded sample of the training rows (about ``ROWS_PER_LANGUAGE``
of each language), counted and added up in Spark.
"""

from __future__ import annotations

import dataclasses

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitecorpus.llm.folds import by_value, held_out
from sitecorpus.llm.words import LETTERS, Batch, mix

SLOTS = 1 << 16
ROWS_PER_LANGUAGE = 4_000
SWITCH = 12.0        # log-probability that a change of language costs
SCRIPT_SHARE = 1e-3  # share of a language's words from which it counts as written in a script
WORDS_AT_ONCE = 1 << 19
#: First code points of script blocks and the script each begins (fixed values; 0: no script).
SCRIPTS = ["none", "latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "devanagari",
           "south asian", "thai and lao", "tibetan", "georgian", "hangul", "ethiopic", "kana", "han"]
BLOCKS = [(0x0, 0), (0x41, 1), (0x5B, 0), (0x61, 1), (0x7B, 0), (0xAA, 1), (0xAB, 0), (0xB5, 1), (0xB6, 0),
          (0xBA, 1), (0xBB, 0), (0xC0, 1), (0x2C2, 0), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5),
          (0x600, 6), (0x900, 7), (0x980, 8), (0xE00, 9), (0xF00, 10), (0x1000, 0), (0x10A0, 11),
          (0x1100, 12), (0x1200, 13), (0x13A0, 0), (0x1C80, 3), (0x1C90, 11), (0x1CC0, 0), (0x1E00, 1),
          (0x1F00, 2), (0x2000, 0), (0x2C60, 1), (0x2C80, 2), (0x2D00, 11), (0x2D30, 0), (0x2DE0, 3),
          (0x2E00, 0), (0x3041, 14), (0x3100, 0), (0x3400, 15), (0xA000, 0), (0xAC00, 12), (0xD7B0, 0),
          (0xF900, 15), (0xFB00, 1), (0xFB13, 0), (0xFB1D, 5), (0xFB50, 6), (0xFE00, 0), (0xFE70, 6),
          (0xFF00, 0), (0xFF21, 1), (0xFF5B, 0), (0xFF66, 14), (0xFFA0, 0), (0x20000, 15), (0x32000, 0)]
_FROM, _SCRIPT = (np.array(x) for x in zip(*BLOCKS, strict=True))


def _scripts(batch: Batch) -> np.ndarray:
    """The script of each word: the highest-numbered one of its letters."""
    raw = batch.raw
    lead = np.flatnonzero(raw >= 0xC0)
    script = (raw >= 0x61).astype(np.int8)
    script[raw >= 0x80] = 0
    if len(lead):
        b = raw[np.minimum(lead[:, None] + np.arange(4), len(raw) - 1)].astype(np.int64)
        tail = b[:, 1:] & 0x3F
        point = np.select([b[:, 0] < 0xE0, b[:, 0] < 0xF0],
                          [(b[:, 0] & 0x1F) << 6 | tail[:, 0],
                           (b[:, 0] & 0x0F) << 12 | tail[:, 0] << 6 | tail[:, 1]],
                          (b[:, 0] & 0x07) << 18 | tail[:, 0] << 12 | tail[:, 1] << 6 | tail[:, 2])
        script[lead] = _SCRIPT[np.searchsorted(_FROM, point, "right") - 1]
    return np.maximum.reduceat(script, batch.start) if len(batch.start) else np.empty(0, np.int8)


def _trigrams(batch: Batch) -> np.ndarray:
    """A slot for each byte of the batch: it, the one before and the one after."""
    raw = batch.raw.astype(np.uint32)
    raw[raw == 10] = 32
    padded = np.concatenate(([np.uint32(32)], raw, [np.uint32(32)]))
    key = (padded[:-2] << np.uint32(16)) | (padded[1:-1] << np.uint32(8)) | padded[2:]
    return ((key * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


@dataclasses.dataclass
class Model:
    languages: list[str]
    weights: np.ndarray   # log-probability by slot and language
    written: np.ndarray   # whether a language is written in a script, by script and language

    def emissions(self, batch: Batch) -> np.ndarray:
        """Score of each word by language; languages that its script rules out get a very low one."""
        slot = _trigrams(batch)
        out = np.empty((len(batch.start), len(self.languages)), np.float32)
        for k in range(len(self.languages)):
            total = np.concatenate(([0.0], np.cumsum(self.weights[slot, k], dtype=np.float64)))
            out[:, k] = total[batch.end] - total[batch.start]
        script = _scripts(batch)
        out[script == 0] = 0  # no letter of a script: says nothing
        allowed = self.written[script]
        allowed |= ~allowed.any(1, keepdims=True)
        return np.where(allowed, out, out.min(1, keepdims=True) - 1e4)

    def paths(self, batch: Batch) -> np.ndarray:
        """The language number of each word on the best path of its text."""
        e, n = self.emissions(batch), batch.n_words
        order = np.argsort(-n, kind="stable")
        first, longest = batch.first[:-1][order], int(n.max(initial=0))
        active = np.searchsorted(-n[order], -np.arange(longest), "left")
        label = np.zeros(len(e), np.int16)
        back = np.zeros(e.shape, np.int16)
        own = np.arange(e.shape[1], dtype=np.int16)[None, :]
        score = np.zeros((len(order), e.shape[1]), np.float64)
        for t in range(longest):
            m = active[t]
            f = score[:m]
            top = f.argmax(1)
            switched = f[np.arange(m), top][:, None] - SWITCH
            back[first[:m] + t] = np.where(f >= switched, own, top[:, None])
            score[:m] = np.maximum(f, switched) + e[first[:m] + t]
        now = score.argmax(1)
        for t in range(longest - 1, -1, -1):
            m = active[t]
            at = first[:m] + t
            label[at] = now[:m]
            now[:m] = back[at, now[:m]]
        return label

    def spans(self, texts) -> list[tuple]:
        """(language or None, share, spans) of each text."""
        out = []
        lengths = np.array([len(t or "") for t in texts])
        order = np.argsort(lengths, kind="stable")
        groups = np.cumsum(lengths[order]) // (6 * WORDS_AT_ONCE)
        for g in np.unique(groups):
            rows = order[groups == g]
            out += zip(rows, self._spans([texts[i] for i in rows]))
        return [x for _, x in sorted(out, key=lambda x: x[0])]

    def _spans(self, texts) -> list[tuple]:
        batch = Batch(texts, LETTERS)
        label = self.paths(batch)
        size = batch.end - batch.start
        new = np.ones(len(label), bool)
        new[1:] = label[1:] != label[:-1]
        new[batch.first[:-1][batch.n_words > 0]] = True
        cut = np.concatenate((np.flatnonzero(new), [len(label)]))
        at = np.searchsorted(cut, batch.first)
        total = np.concatenate(([0], np.cumsum(size)))
        out = []
        for i, text in enumerate(texts):
            a, b = at[i], at[i + 1]
            if not text or not (a < b) or not any(map(str.isalpha, text)):
                out.append((None, 0.0, []))
                continue
            begin, end, which = cut[a:b], cut[a + 1:b + 1], label[cut[a:b]]
            weight = np.bincount(which, total[end] - total[begin])
            best, word = int(weight.argmax()), batch.first[i]
            out.append((self.languages[best], float(weight[best] / weight.sum()),
                        [(int(x - word), int(y - word), self.languages[k])
                         for x, y, k in zip(begin, end, which, strict=True)]))
        return out


def fit(rows: DataFrame, lang: str = "lang", text: str = "text") -> Model:
    """A model of the languages in ``rows``, a bounded sample."""

    def count(parts):
        seen: dict[str, np.ndarray] = {}
        for part in parts:
            for name, texts in part.groupby(lang)[text]:
                batch = Batch(texts, LETTERS)
                slots = np.bincount(_trigrams(batch), minlength=SLOTS)
                words = np.bincount(_scripts(batch), minlength=len(SCRIPTS))
                seen[name] = seen.get(name, 0) + np.concatenate((slots, words))
        if seen:
            yield pd.DataFrame({"lang": list(seen), "counts": [c.astype(np.int64).tobytes() for c in seen.values()]})

    def add(part):
        total = sum(np.frombuffer(c, np.int64) for c in part["counts"])
        return pd.DataFrame({"lang": part["lang"].iloc[:1], "counts": [total.tobytes()]})

    counts = (rows.select(F.col(lang).alias(lang), F.col(text).alias(text))
              .mapInPandas(count, "lang string, counts binary")
              .groupBy("lang").applyInPandas(add, "lang string, counts binary")
              .toPandas().sort_values("lang"))
    if counts.empty:
        return Model([], np.empty((SLOTS, 0)), np.empty((len(SCRIPTS), 0), bool))
    table = np.stack([np.frombuffer(c, np.int64) for c in counts["counts"]], 1).astype(np.float64)
    slots, words = table[:SLOTS] + 0.5, table[SLOTS:]
    return Model(counts["lang"].tolist(), np.log(slots / slots.sum(0)).astype(np.float32),
                 words >= SCRIPT_SHARE * np.maximum(words.sum(0), 1))


def fit_fold(docs: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text",
             rows_per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """A model fitted on about ``rows_per_language`` rows of each language in the training fold;
    null texts and languages are left out."""
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(key))
    return fit(by_value(known.select(key, lang, text), lang, rows_per_language, key), lang, text)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``keep`` columns, lang_pred, score (share of the
    text's letter bytes in that language) and ``spans`` (start and end word, end exclusive, words
    being runs of letters; lang).

    ``und`` with score 0 and no spans for a null text, one without a letter, or a model without
    languages. Ties go to the first language by name. Repeated rows and null keys stay; other
    columns are ignored; an empty table gives an empty result."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, spans array<struct<start:int,end:int,lang:string>>")
    def label(texts: pd.Series) -> pd.DataFrame:
        found = shared.value.spans(list(texts)) if shared.value.languages else [(None, 0.0, [])] * len(texts)
        return pd.DataFrame({"lang": [x[0] or "und" for x in found], "score": [x[1] for x in found],
                             "spans": [[dict(zip(("start", "end", "lang"), s)) for s in x[2]] for x in found]})

    return (docs.select(F.col(key).alias("doc_id"), *(keep or []), label(text).alias("found"))
            .select("doc_id", *(keep or []), F.col("found.lang").alias("lang_pred"), "found.score", "found.spans"))
