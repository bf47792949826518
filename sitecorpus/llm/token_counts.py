"""Exact token counts under a byte-pair vocabulary with word ends, without token identifiers.

Method: the symbols of a piece form a linked list; a heap holds the mergeable adjacent pairs by
rank and place. The lowest is popped and merged, its new neighbours are pushed, until none is
left. A piece has as many tokens as it had symbols less the merges.

The vocabulary is a tokenizers file (.json) whose text rules are: special strings first (each one
token), then NFC, lower case, and pieces by pattern, each spelled in bytes. Pieces never cross
white space, so counts are kept per white-space word, in a dictionary of bounded size.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata

import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

KEEP_WORDS = 1_000_000  # words whose count a worker remembers, and half as many pieces
KEEP_LENGTH = 64        # of at most so many characters
#: The pieces of the vocabulary's pre-tokenizer (a fixed value of that format).
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
SPACE = regex.compile(r"\s+")
#: Control characters that str.split() takes for white space and the pattern does not.
ODD_SPACE = regex.compile(r"[\x1c-\x1f]")


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte: printable Latin-1 itself, others from 256
    on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Counter(dict):
    """Tokens by white-space word."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        n = len(vocab)  # a byte without a symbol gets a number of its own
        self.inner = [vocab.get(letters[b], n + b) for b in range(256)]
        self.last = [vocab.get(letters[b] + end, n + 256 + b) for b in range(256)]
        self.merges = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << 32 | vocab[b], rank << 32 | vocab[a + b])
        self.pieces = {}
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.hints = [s[:2] for s in special]

    def piece(self, data: bytes) -> int:
        """Symbols less merges. Pairs are one integer (left << 32 | right), merges give
        rank << 32 | new symbol, and heap entries are rank << 32 | place."""
        inner = self.inner
        symbols = [inner[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        n = left = len(symbols)
        get, low = self.merges.get, 0xFFFFFFFF
        heap = [(m >> 32 << 32) | i for i, a in enumerate(symbols[:-1])
                if (m := get(a << 32 | symbols[i + 1])) is not None]
        if not heap:
            return n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            top = pop(heap)
            i = top & low
            j, a = after[i], symbols[i]
            if a is None or j >= n or (m := get(a << 32 | symbols[j])) is None or m >> 32 != top >> 32:
                continue  # one of the two is merged already
            new = m & low
            symbols[i], symbols[j] = new, None
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (m := get(new << 32 | symbols[k])) is not None:
                    push(heap, (m >> 32 << 32) | i)
            k = before[i]
            if k >= 0 and (m := get(symbols[k] << 32 | new)) is not None:
                push(heap, (m >> 32 << 32) | k)
        return left

    def short(self, piece: str) -> int:
        """The count of a piece; a worker remembers it like a word's."""
        count = self.pieces.get(piece)
        if count is None:
            count = self.piece(piece.encode("utf-8", "surrogatepass"))
            if len(piece) <= KEEP_LENGTH:
                if 2 * len(self.pieces) >= KEEP_WORDS:
                    self.pieces.clear()
                self.pieces[piece] = count
        return count

    def __missing__(self, word: str) -> int:
        text = word
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final form in this rule
        text = text.lower()
        count = self.short(text) if text.isalpha() else sum(map(self.short, PIECE.findall(text)))
        if len(word) <= KEEP_LENGTH:
            if len(self) >= KEEP_WORDS:
                self.clear()
            self[word] = count
        return count

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        total = 0
        if self.special and any(h in text for h in self.hints):
            parts = self.special.split(text)
            total = len(parts) - 1
        else:
            parts = (text,)
        for part in parts:
            words = SPACE.split(part) if ODD_SPACE.search(part) else part.split()
            total += sum(map(self.__getitem__, words))
        return total


@functools.cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = 2048, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens >
    limit). ``path`` names the vocabulary file on every worker.

    A null or empty text has 0 bytes and tokens; white space alone has 0 tokens. Repeated rows and
    null keys stay as they are, other columns are ignored, an empty table gives an empty result."""

    @F.pandas_udf("long")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.map(counter(path).count, na_action=None).astype("int64")

    out = docs.select(F.col(key).alias("doc_id"),
                      F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")).alias("n_bytes"),
                      tokens(text).alias("n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
