"""Toxicity score of texts: a factorization machine over hashed terms.

Terms are a text's distinct words (letters and digits, ASCII lower case) and the first ``HEAD``
bytes of each word, hashed into 2**BITS slots. The score of a text that has the terms i is
sigmoid(b + sum w_i + sum_{i<j} <v_i, v_j> / sqrt(n)) for its n terms, the pair sum computed per
factor as half of (sum v)**2 - sum v**2, so a pair such as an insult with a group mention counts
although no pair is listed.

The model is fitted on a bounded sample of labelled rows (about ``MAX_ROWS``, half of them toxic
if there are so many), chosen by a hash of the key. Every slot that a sample text holds has a
weight and factors, whatever its share in the labels: a word that tells nothing alone can tell in a
pair. They are learned with Adagrad, which shrinks a weight, or the factors of a slot together,
towards zero (2**BITS slots at most, 15 MB), the only step on the driver. Scoring runs over all rows
in Arrow batches.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from sitecorpus.llm.folds import by_value, held_out
from sitecorpus.llm.words import ALNUM, Batch, distinct_per_text, give_back, in_parts

BITS, HEAD, FACTORS = 18, 4, 6
MAX_ROWS = 8_000    # labelled rows the model is fitted on, about
EPOCHS, MEAN_OF = 30, 10  # passes over the sample; the model is the mean after the last of them
SCORE_CHARS = 1 << 18  # of the texts that are scored at once, about
RATE, PENALTY = (1.0, 0.05), (2e-4, 3e-4)  # of the weights and of the factors


def slots(texts, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (slot, text) pairs of the texts, by text; with ``place``, of the slots that have
    one. A few texts at a time, so memory does not follow the batch."""
    shift, found = np.uint64(64 - BITS), []
    for at, part in in_parts(texts):
        batch = Batch(part, ALNUM, head=HEAD)
        owner = np.repeat(np.arange(len(part), dtype=np.int32), batch.n_words)
        for h in (batch.hash >> shift, (batch.head ^ np.uint64(0x5555 << 44)) >> shift):
            slot = h.astype(np.int32)
            kept = slice(None) if place is None else np.flatnonzero(place[slot] > 0)
            found.append((slot[kept], owner[kept] + at))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return distinct_per_text(*(np.concatenate(x).astype(np.int64) for x in zip(*found, strict=True)))


class Machine:
    """Weights of the slots in the sample; position 0 is the constant term, every text has it."""

    def __init__(self, kept: np.ndarray, prior: float):
        self.place = np.full(1 << BITS, -1, np.int32)
        self.place[kept] = np.arange(1, len(kept) + 1)
        self.prior = prior
        self.w = np.zeros(len(kept) + 1)
        self.v = np.random.default_rng(7).normal(0, 0.02, (len(kept) + 1, FACTORS))
        self.v[0] = 0

    def active(self, slot: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = self.place[slot]
        return i[i > 0], owner[i > 0]

    def sums(self, i: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The log-odds, the factor sums and the weight of a pair in n texts."""
        v = self.v[i]
        total = np.stack([np.bincount(owner, v[:, f], n) for f in range(FACTORS)], 1)
        pairs = (total ** 2).sum(1) - np.bincount(owner, (v ** 2).sum(1), n)
        share = 1 / np.sqrt(np.maximum(np.bincount(owner, minlength=n), 1))
        return self.w[0] + np.bincount(owner, self.w[i], n) + share * pairs / 2, total, share

    def fit(self, i: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> None:
        n = len(labels)
        first = np.searchsorted(owner, np.arange(n + 1))
        gw, gv = np.full_like(self.w, 1e-4), np.full_like(self.v, 3e-3)
        rng = np.random.default_rng(11)
        mean_w, mean_v = np.zeros_like(self.w), np.zeros_like(self.v)
        for epoch in range(EPOCHS):
            order = rng.permutation(n)
            for at in range(0, n, 128):
                rows = order[at:at + 128]
                sizes = first[rows + 1] - first[rows]
                own = np.repeat(np.arange(len(rows)), sizes)
                own_i = i[np.repeat(first[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                z, total, share = self.sums(own_i, own, len(rows))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[rows]) / len(rows)
                dw = np.bincount(own_i, error[own], len(self.w))
                dw[0] = error.sum()
                dv = np.empty_like(self.v)
                part = (error * share)[own][:, None] * (total[own] - self.v[own_i])
                for f in range(FACTORS):
                    dv[:, f] = np.bincount(own_i, part[:, f], len(self.w))
                gw += dw ** 2
                gv += dv ** 2
                self.w -= RATE[0] * dw / np.sqrt(gw)
                self.v -= RATE[1] * dv / np.sqrt(gv)
                less = RATE[0] * PENALTY[0] / np.sqrt(gw[1:])
                self.w[1:] = np.sign(self.w[1:]) * np.maximum(np.abs(self.w[1:]) - less, 0)
                size = np.sqrt((self.v ** 2).sum(1))
                less = RATE[1] * PENALTY[1] / np.sqrt(gv.mean(1))
                self.v *= np.maximum(1 - less / np.maximum(size, 1e-12), 0)[:, None]
            if epoch >= EPOCHS - MEAN_OF:
                mean_w += self.w / MEAN_OF
                mean_v += self.v / MEAN_OF
        self.w, self.v = mean_w, mean_v

    def score(self, texts) -> np.ndarray:
        z = [self.sums(*self.active(*slots(part, self.place)), len(part))[0] for _, part in in_parts(texts, SCORE_CHARS)]
        return 1 / (1 + np.exp(-np.clip(np.concatenate([np.empty(0), *z]) + self.prior, -30, 30)))


def fit(rows: DataFrame, shares: dict[int, float], key: str = "doc_id", text: str = "text",
        label: str = "toxic") -> Machine:
    """A machine fitted on a bounded sample: rows of (key, text, label 0/1). ``shares`` are the
    label counts where the sample was drawn. Without labelled rows it scores 0 (nothing is known
    to be toxic); with one label only, that one."""

    def terms(parts):
        for part in parts:
            slot, owner = slots(part[text])
            first = np.searchsorted(owner, np.arange(len(part) + 1))
            yield pd.DataFrame({"label": part[label].to_numpy(), "order": part[key].astype(str),
                                "slots": [slot[a:b].astype(np.int32).tobytes()
                                          for a, b in zip(first, first[1:])]})

    got = (rows.select(F.col(key).cast("string").alias(key), text, F.col(label).cast("int").alias(label))
           .mapInPandas(terms, "label int, order string, slots binary").toPandas()
           .sort_values(["order", "slots"]))
    labels = got["label"].to_numpy(np.float64)
    parts = [np.frombuffer(x, np.int32) for x in got["slots"]]
    n1, n0 = labels.sum(), len(labels) - labels.sum()
    if not n1 or not n0:
        machine = Machine(np.empty(0, np.int64), 0.0)
        machine.w[0] = 30 if n1 else -30
        return machine
    slot = np.concatenate(parts).astype(np.int64)
    owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
    # The sample holds the labels in other shares than the rows: correct the odds for that.
    machine = Machine(np.unique(slot), float(np.log(shares[1] / shares[0]) - np.log(n1 / n0)))
    machine.fit(*machine.active(slot, owner), labels)
    return machine


def scorer(spark: SparkSession, machine: Machine):
    """The machine's score of a text column."""
    model = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        found = pd.Series(model.value.score(texts))
        give_back()
        return found

    return score


def score_toxicity(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``keep`` columns, score (0 to 1) and predicted
    (1 from 0.5 on).

    A null or empty text has no terms and gets the constant term's score. Repeated rows and null
    keys stay; other columns are ignored; an empty table gives an empty result."""
    score = scorer(docs.sparkSession, machine)
    out = docs.select(F.col(key).alias("doc_id"), *(keep or []), score(text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def fit_fold(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
             text: str = "text", max_rows: int = MAX_ROWS) -> Machine:
    """A machine fitted on about ``max_rows`` rows of the training fold. Labels are sampled before
    the texts are read, so the join broadcasts that sample alone. A key with several labels counts
    as 1 if any is, one with several texts gives the least of them; null keys and labels are left out."""
    marks = (labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1) & ~held_out(key))
             .groupBy(key).agg(F.max(label).cast("int").alias(label)))
    shares = {r[0]: r[1] for r in marks.groupBy(label).count().collect()}
    sample = by_value(marks, label, max_rows // 2, key)
    rows = docs.select(key, text).join(F.broadcast(sample), key).groupBy(key, label).agg(F.min(text).alias(text))
    return fit(rows, shares, key, text, label)
