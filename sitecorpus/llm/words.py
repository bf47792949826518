"""Words and their hashes over whole batches of texts, vectorised with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D (the separators are ASCII, so
cutting UTF-8 bytes equals cutting characters). Word hashes are polynomial in the word's bytes
(one table value per byte, arithmetic modulo 2**64) and window hashes are Rabin-Karp sums of
word hashes; both come from running sums, so the cost is a few array operations per byte
whatever the word or window length.
"""

from __future__ import annotations

import functools

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C13)          # odd, 3 modulo 8
WINDOW_BASE = np.uint64(0xD1342543DE82EF9B)   # odd, 3 modulo 8
BLOCK = 1 << 16                               # bytes, and words of windows, hashed at once
#: Byte tables: A-Z to a-z; that, and every other ASCII byte but letters (and digits) to a space.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in LOWER)
ALNUM = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in LOWER)


def give_back() -> None:
    """Return freed memory to the system, so that a worker waits for its next task with little."""
    import ctypes

    import pyarrow
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """n pseudo-random unsigned 64-bit integers that depend on the seed alone."""
    step = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 20)) * step)


@functools.cache
def _table(seed: int) -> np.ndarray:
    return numbered(256, seed + 1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand; a worker keeps the first 2 * BLOCK."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) >= n:
            return self.up, self.down
        n = max(n, min(2 * len(self.up), 2 * BLOCK))
        up, down = np.full(n, self.base), np.full(n, self.inverse)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, out=up), np.cumprod(down, out=down)
        if n <= 2 * BLOCK:
            self.up, self.down = up, down
        return up, down


_BYTES, _WORDS = _Powers(BASE), _Powers(WINDOW_BASE)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[9, 10, 11, 12, 13, 32]] = True


def _blocks(raw: np.ndarray):
    """Consecutive pieces of about BLOCK bytes that end at a separator (one longer word stays
    in one piece)."""
    at, n = 0, len(raw)
    while at < n:
        seen, end = at, min(n, at + BLOCK)
        while end < n:
            cut = np.flatnonzero(_SEPARATOR[raw[seen:end]])
            if len(cut):
                end = seen + int(cut[-1]) + 1
                break
            seen, end = end, min(n, end + BLOCK)
        yield at, raw[at:end]
        at = end


def word_hashes(raw: np.ndarray, seed: int = 0, head: int = 0) -> tuple[np.ndarray, ...]:
    """Start, end (exclusive) and 64-bit hash of each word of the bytes, and the hash of its first
    ``head`` bytes."""
    table, out = _table(seed), []
    for offset, block in _blocks(raw):
        sep = _SEPARATOR[block]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        if not sep[0]:
            edge = np.concatenate(([0], edge))
        if not sep[-1]:
            edge = np.concatenate((edge, [len(block)]))
        if not len(edge):
            continue
        start, end = edge[::2], edge[1::2]
        up, down = _BYTES.to(len(block))
        total = np.empty(len(block) + 1, np.uint64)
        total[0] = 0
        np.cumsum(table[block] * up[:len(block)], out=total[1:])
        short = np.minimum(end, start + head)
        out.append((start + offset, end + offset, mix((total[end] - total[start]) * down[start]),
                    mix((total[short] - total[start]) * down[start])))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Batch:
    """The words of a batch of texts: ``hash`` of every word in order, and ``first``, the index
    of each text's first word (with the total at the end). ``table`` maps the bytes first."""

    def __init__(self, texts, table: bytes | None = None, seed: int = 0, head: int = 0):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        if table:
            raws = [r.translate(table) for r in raws]
        self.raws = raws
        self.offsets = np.zeros(len(raws) + 1, np.int64)
        np.cumsum([len(r) + 1 for r in raws], out=self.offsets[1:])
        self.raw = np.frombuffer(b"\n".join([*raws, b""]), np.uint8)
        self.start, self.end, self.hash, self.head = word_hashes(self.raw, seed, head)
        self.first = np.searchsorted(self.start, self.offsets)

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and text of every window of ``size`` consecutive words of one text.
        With ``short``, a text of 1 to size - 1 words gives its whole sequence as one window."""
        n = self.n_words
        doc = np.repeat(np.arange(len(n)), n)
        at = np.flatnonzero(np.arange(size, len(self.hash) + size) <= self.first[1:][doc])
        owner = doc[at]
        h = self._sums(at, at + size)
        if short:
            few = np.flatnonzero((n > 0) & (n < size))
            a, b = self.first[few], self.first[few + 1]
            whole = mix(self._sums(a, b) + (b - a).astype(np.uint64))
            at, owner, h = (np.concatenate(x) for x in ((at, a), (owner, few), (h, whole)))
        return h, at, owner

    def _sums(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the words from ``start`` (ascending) to ``end``, of those that start in BLOCK words at a time."""
        out = np.empty(len(start), np.uint64)
        bounds = np.searchsorted(start, np.arange(0, len(self.hash) + BLOCK, BLOCK))
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            if a == b:
                continue
            words = self.hash[i * BLOCK:int(end[a:b].max())]
            up, down = _WORDS.to(len(words) + 1)
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * up[:len(words)], out=total[1:])
            one, two = start[a:b] - i * BLOCK, end[a:b] - i * BLOCK
            out[a:b] = mix((total[two] - total[one]) * down[one])
        return out


def in_parts(texts, size: int = 1 << 20):
    """Consecutive texts of about ``size`` characters together (one longer text is a part of its
    own), with the first one's number."""
    texts = list(texts)
    at = total = 0
    for i, text in enumerate(texts):
        total += len(text or "")
        if total >= size or i + 1 == len(texts):
            yield at, texts[at:i + 1]
            at, total = i + 1, 0


def distinct_per_text(h: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (text, hash) pairs, by text and then hash."""
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return h[new], owner[new]
