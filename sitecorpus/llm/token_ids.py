"""Token ids of whole texts, cut into pieces of bounded length.

The vocabulary file's own library (tokenizers) gives the ids. Its rules never look across white
space, nor from a letter to a full stop, and take no notice of case, so it is asked once per distinct
word; a worker keeps the ids of a bounded number of words under the words' 64-bit hashes and puts
texts together from them with array operations.
"""

from __future__ import annotations

import functools
import itertools
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from sitecorpus.llm.token_counts import PIECE, byte_letters
from sitecorpus.llm.words import LOWER, in_parts, word_hashes

KEEP_WORDS = 1_500_000  # words whose ids a worker keeps
BATCH_CHARS = 1 << 21   # text whose ids are made at once, about
LATIN = "\u0250"         # letters below it have no marks to compose and one lower case
#: Between a letter and one of these marks the library's rules always cut; special strings hold none.
LETTER, MARK = np.zeros(256, bool), np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
MARK[list(b'.,;:!?()"')] = True


def _joined(texts: list) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, a line break after each and a space at every sure cut, and where each
    text ends. Case is dropped unless a special string, which is read as it is written, may occur."""
    raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    raw = b"\n".join([*raws, b""])
    raw = np.frombuffer(raw if b"<|" in raw else raw.translate(LOWER), np.uint8)
    letter, mark = LETTER[raw], MARK[raw]
    cut = np.flatnonzero(letter[:-1] & mark[1:] | mark[:-1] & letter[1:]) + 1
    stop = np.cumsum([len(r) + 1 for r in raws])
    return np.insert(raw, cut, 32), stop + np.searchsorted(cut, stop, "left")


class WordIds:
    """Ids by word: ``known`` (sorted hashes), ``at`` and ``size`` (place in ``ids``) of each."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.letters = str.maketrans(byte_letters())
        self.clear()

    def clear(self) -> None:
        self.known, self.at = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.size, self.ids = np.empty(0, np.int64), np.empty(0, np.uint32)

    def word(self, word: str) -> list[int]:
        """The library's ids. A Latin word is cut by the pre-tokenizer's pattern here and the library's
        model asked for each piece; any other word goes through all of the library's rules."""
        low = word.lower()
        if max(low) < LATIN and word.isprintable() and "<|" not in word:
            tokenize, letters = self.tokenizer.model.tokenize, self.letters
            pieces = (low,) if low.isalpha() else PIECE.findall(low)
            return [t.id for p in pieces for t in tokenize(p.encode().decode("latin-1").translate(letters))]
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _learn(self, raw: bytes, start: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> None:
        """Ask the library for the words at these bytes, by rising hash."""
        found = [self.word(raw[a:b].decode("utf-8", "surrogatepass")) for a, b in
                 zip(start.tolist(), end.tolist(), strict=True)]
        size = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(size.sum()))
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.at = np.insert(self.at, place, len(self.ids) + np.cumsum(size) - size)
        self.size = np.insert(self.size, place, size)
        self.ids = np.concatenate((self.ids, flat))

    def texts(self, texts: list, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids, each text's followed by ``end``, and where each text ends."""
        raw, stop = _joined(texts)
        start, last, hashes, _ = word_hashes(raw)
        code, hashes = pd.factorize(hashes)
        first = np.flatnonzero(np.diff(np.maximum.accumulate(code), prepend=-1))
        order = np.argsort(hashes)
        place = np.searchsorted(self.known, hashes[order])
        if len(self.known):
            new = self.known[np.minimum(place, len(self.known) - 1)] != hashes[order]
        else:
            new = np.ones(len(hashes), bool)
        if new.any():
            if len(self.known) + int(new.sum()) > KEEP_WORDS:  # start anew with this batch's words
                self.clear()
                new[:] = True
            at = first[order[new]]
            self._learn(raw.tobytes(), start[at], last[at], hashes[order[new]])
            place = np.searchsorted(self.known, hashes[order])
        at, size = np.empty(len(hashes) + 1, np.int64), np.ones(len(hashes) + 1, np.int64)
        at[order], size[order], at[-1] = self.at[place], self.size[place], len(self.ids)
        flat = np.append(self.ids, np.uint32(end))  # the end mark is one more word
        after = np.searchsorted(start, stop)
        code = np.insert(code, after, len(hashes))
        size, at = size[code], at[code]
        stop = np.cumsum(size)
        ids = flat[np.repeat(at - (stop - size), size) + np.arange(int(stop[-1]) if len(stop) else 0)]
        return ids, stop[after + np.arange(len(texts))]


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def cut(ids: np.ndarray, stop: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
    """Text number, piece number, first id's place in its text, and place in ``ids`` of every piece
    of at most ``limit`` ids."""
    begin = np.concatenate(([0], stop[:-1]))
    count = -(-(stop - begin) // limit)
    text = np.repeat(np.arange(len(stop)), count)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    a = begin[text] + piece * limit
    return text, piece, piece * limit, a, np.minimum(a + limit, stop[text])


def token_pieces(docs: DataFrame, path: str, limit: int = 2048, end: int = 0, key: str = "doc_id",
                 text: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start, length, ids_crc32 (of the little-endian
    unsigned 32-bit ids), ``ids`` if asked for, and ``part`` and ``place``: the task that made the
    piece and the number of pieces of its length that this task made before.

    A text's ids are followed by ``end`` and cut where they pass ``limit``. A null or empty text is
    one piece of the end mark alone. Repeated rows and null keys give their own pieces, other columns
    are ignored, an empty table gives an empty result. Two words of one 64-bit hash within a worker's
    words would share ids (about 10⁻⁷ a worker)."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("_text"))
    schema = T.StructType([rows.schema[0]]).add("piece", "integer").add("start", "long").add("length", "long").add(
        "ids_crc32", "long").add("part", "long").add("place", "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.LongType()))

    def pieces(batches):
        part, made = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64)
        for batch in batches:
            for first, texts in in_parts(batch.column(1).to_pylist(), BATCH_CHARS):
                ids, stop = word_ids(path).texts(texts, end)
                owner, piece, start, a, b = cut(ids, stop, limit)
                length, raw = b - a, ids.astype("<u4", copy=False)
                crc = [zlib.crc32(raw[x:y]) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                run = length[order]
                place = np.empty(len(run), np.int64)
                place[order] = np.arange(len(run)) - np.searchsorted(run, run) + made[run]
                made += np.bincount(run, minlength=limit + 1)
                columns = [batch.column(0).take(pa.array(owner + first)), pa.array(piece.astype(np.int32)),
                           pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                           pa.array(np.full(len(run), part)), pa.array(place)]
                if with_ids:
                    offsets = np.concatenate((a, b[-1:])).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(pieces, schema)
