"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

The vocabulary is a sentencepiece model file. A text's lattice has a node between any two
characters and an edge for each piece that spells what lies between two nodes (a character without
a piece has one edge, its bytes). A piece's weight falls with its rank, -SHARPNESS * log(2 + rank);
a segmentation's probability is its weight against all of the text's lattice, known exactly from
the sums over the rest of the lattice (``rest``) that serve as the search's heuristic.

Method (Gumbel top-k by perturbed A*): the set of all segmentations has a Gumbel-perturbed
log-probability; the best set is taken from the queue, its best member is drawn edge by edge, and
what is left of the set is split along that path: for each edge, the segmentations that share all
edges before and differ there, each with a Gumbel truncated at the taken value. The k members taken
first are k distinct segmentations, as if drawn without replacement. The next perturbed value in
the queue is the threshold t that gives each member its inclusion score 1 - exp(-exp(log p - t)).

All randomness is a hash of the seed, the row's key and the place, so it does not depend on
partitions or batches. Pieces never cross the start of a word (they hold the word mark only at their
start) nor two characters that follow each other in no piece. So a word falls into segments, whose
lattices are built once, and a worker keeps a bounded number of them. The texts of a batch are
searched in step, so that the paths of all are drawn together.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from sitecorpus.llm.words import give_back, in_parts, mix, numbered

MARK = "▁"          # stands for a space
SHARPNESS = 1.0
SAMPLES = 2
SEED = 9
KEEP_EDGES = 1_000_000   # of the lattices that a worker keeps, while it works on a partition
WINDOW = 256             # places of a path where it is left that are looked at first
KEEP_LENGTH = 64         # characters of a segment it keeps
BATCH_CHARS = 200_000  # text that is sampled at once, about
DECODE_ROWS = 64       # rows that are decoded at once
NEAR_BITS = 1 << 24    # of the table of characters that follow each other in a piece, at most
SAMPLE = "struct<ids:array<int>,log_p:double,perturbed:double,inclusion:double>"


class Spelling:
    """Pieces and the bytes that each stands for."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = np.full(256, sp.unk_id(), np.int32)
        for i in range(n):
            if sp.is_byte(i):
                self.byte_ids[int(self.pieces[i][1:-1], 16)] = i
        spelled = [p.encode() for p in self.pieces]
        for b, i in enumerate(self.byte_ids.tolist()):
            if i != sp.unk_id():
                spelled[i] = bytes([b])
        self.size = np.array([len(x) for x in spelled])
        self.at = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.model = sp

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """The texts of rows of ids, which end at ``bounds``: all pieces' bytes are put together at once."""
        size = self.size[ids]
        stop = np.cumsum(size)
        raw = self.bytes[np.repeat(self.at[ids] - (stop - size), size) + np.arange(int(size.sum()))].tobytes()
        ends = np.concatenate(([0], stop))[bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace").replace(MARK, " ")[1:] for a, b in zip(ends, ends[1:])]


class Vocabulary:
    """Pieces as a trie: the child of ``state`` by a letter is at ``base[state] + letter`` if ``owner`` there is the
    state. ``near`` has a bit for letters that follow each other in a piece (perhaps for some others too)."""

    def __init__(self, path: str, sharpness: float):
        spelling = Spelling(path)
        sp, self.pieces, self.byte_ids = spelling.model, spelling.pieces, spelling.byte_ids
        n = len(self.pieces)
        own = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        rank = {i: r for r, i in enumerate(sorted(own, key=lambda i: (-sp.get_score(i), i)))}
        self.byte_weight = -sharpness * np.log(2 + len(own))
        letters = sorted({c for i in own for c in self.pieces[i]})
        self.width = len(letters) + 1
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        number = {c: i for i, c in enumerate(letters, 1)}
        children, final, weight, near = [{}], [-1], [0.0], set()
        for i in own:
            state, before = 0, 0
            for c in self.pieces[i]:
                now = number[c]
                near.add(before * self.width + now)
                before, state = now, children[state].setdefault(now, len(final))
                if state == len(final):
                    children.append({})
                    final.append(-1)
                    weight.append(0.0)
            final[state], weight[state] = i, -sharpness * np.log(2 + rank[i])
        self.final, self.weight = np.array(final, np.int32), np.array(weight)
        self.near = np.zeros(min(self.width * self.width, NEAR_BITS), bool)
        self.near[np.array(sorted(near), np.int64) % len(self.near)] = True
        self.bits, self.near = len(self.near), np.packbits(self.near)
        self._place(children)

    def _place(self, children: list[dict[int, int]]) -> None:
        """Lay the children of all states into one array, those of many children first."""
        room = 8 * len(children)
        self.base = np.zeros(len(children), np.int32)
        self.owner = np.full(room + self.width, -1, np.int32)
        self.next = np.zeros(room + self.width, np.int32)
        taken = set()
        for state in sorted(range(len(children)), key=lambda i: -len(children[i])):
            if not (own := children[state]):
                break
            base = state * 0x9E3779B1 % room
            while any(base + letter in taken for letter in own):
                base = (base + 1) % room
            slots = [base + letter for letter in own]
            taken.update(slots)
            self.base[state], self.owner[slots], self.next[slots] = base, state, list(own.values())

    def joined(self, letter: np.ndarray) -> np.ndarray:
        """Whether each letter but the first can stand behind the one before it in a piece."""
        key = (letter[:-1].astype(np.int64) * self.width + letter[1:]) % self.bits
        return (self.near[key >> 3] >> (7 - (key & 7)).astype(np.uint8) & 1).astype(bool) & (letter[:-1] > 0) & (letter[1:] > 0)

    def edges(self, code: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
        """All edges over concatenated segments; ``end`` is where each character's segment ends. Number of edges and first
        edge of each character, the characters by falling place of their segment's rest (``order``), and length, piece
        (-1: bytes of one character) and weight of each edge. Edges lie in that order, long ones first."""
        letter = self.letter[code]
        at, state, found = np.arange(len(code), dtype=np.int32), np.zeros(len(code), np.int32), []
        fan = np.zeros(len(code), np.int32)
        while len(at):
            slot = self.base[state] + letter[at + len(found)]
            hit = np.flatnonzero(self.owner[slot] == state)
            at, state = at[hit], self.next[slot[hit]]
            done = np.flatnonzero(self.final[state] >= 0)
            found.append((at[done], state[done]))
            fan[at[done]] += 1
            if len(found) == 1:
                lone = np.flatnonzero(fan == 0)
                fan[lone] = 1
            more = np.flatnonzero(at + len(found) < end[at])
            at, state = at[more], state[more]
        left = end - np.arange(len(code))
        order = np.argsort(left.astype(np.uint16) if left.max() < 1 << 16 else left, kind="stable")
        stop = np.cumsum(fan[order])
        first = np.empty(len(code), np.int64)
        first[order] = stop - fan[order]
        total, free = int(stop[-1]), first.copy()
        length, piece, weight = np.ones(total, np.int32), np.full(total, -1, np.int32), np.empty(total)
        for k in range(len(found), 0, -1):
            start, state = found[k - 1]
            e = free[start]
            free[start] += 1
            length[e], piece[e], weight[e] = k, self.final[state], self.weight[state]
        c = code[lone]
        weight[free[lone]] = self.byte_weight * (1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))
        return fan, first, order, length, piece, weight


class Lattices:
    """Lattices of segments in flat arrays. Node i of a segment is before its i-th character (``code``; -1 at its end); each
    node's edges are consecutive, long ones first (a draw then looks at few), with their log-probability given the node and the
    running sum of the probabilities."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.held: dict[str, np.ndarray] = {}
        self.clear()

    def clear(self) -> None:
        for name in self.held:  # parts of the arrays held, which would keep them
            delattr(self, name)
        self.known = np.empty(0, np.uint64)  # hashes of the segments kept, ascending
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.again = np.empty(0, bool)       # whether it was asked for after it was added
        self.nodes = self.n_edges = 0
        self.held = {}

    def _forget(self) -> None:
        """Keep the segments that came again, unless they fill half of the store; drop the rest."""
        known, node, size = self.known[self.again], self.at[self.again], self.size[self.again] + 1
        old = np.repeat(node - np.cumsum(size) + size, size) + np.arange(int(size.sum()))  # kept nodes, in order
        fan, code, first = self.fan[old].copy(), self.code[old], self.edge_of[old]
        if 2 * int(fan.sum()) > KEEP_EDGES:
            self.clear()
            return
        edges = np.cumsum(fan) - fan
        edge = np.repeat(first - edges, fan) + np.arange(int(fan.sum()))
        moved = np.zeros(self.nodes, np.int32)
        moved[old] = np.arange(len(old))
        kept = dict(run=self.run[edge], start=moved[self.start[edge]], to=moved[self.to[edge]], piece=self.piece[edge], log_p=self.log_p[edge])
        self.clear()
        self._append(0, **kept)
        self._append(0, code=code, edge_of=edges.astype(np.int32), fan=fan)
        self.known, self.at, self.size, self.again = known, np.cumsum(size) - size, size - 1, np.zeros(len(known), bool)
        self.nodes, self.n_edges = len(old), len(edge)

    def _append(self, size: int, **new: np.ndarray) -> None:
        """Put the new entries behind the first ``size`` of each array, which grows by doubling."""
        for name, values in new.items():
            held, total = self.held.get(name), size + len(values)
            if held is None or len(held) < total:
                more = np.empty(max(total, KEEP_EDGES, size + size // 4), values.dtype)
                if size:
                    more[:size] = held[:size]
                self.held[name] = held = more
            held[size:total] = values
            setattr(self, name, held[:total])

    def of(self, code: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The first node of the lattice of each segment of ``code`` (they begin at ``start``, the first at 0), which
        it adds if it is new."""
        if self.n_edges > KEEP_EDGES:
            self._forget()
        size = np.diff(start, append=len(code))
        place = np.arange(len(code)) - np.repeat(start, size)
        distinct, where, which = np.unique(_hashes(code, place, start), return_index=True, return_inverse=True)
        j = np.searchsorted(self.known, distinct)
        old = np.zeros(len(distinct), bool)
        inside = np.flatnonzero(j < len(self.known))
        old[inside] = self.known[j[inside]] == distinct[inside]
        self.again[j[old]] = True
        node = np.empty(len(distinct), np.int64)
        node[old] = self.at[j[old]]
        new = np.flatnonzero(~old)
        if len(new):
            node[new] = self._add(code, start[where[new]], size[where[new]])
            kept = new[size[where[new]] <= KEEP_LENGTH]
            for name, values in (("again", np.zeros(len(kept), bool)), ("at", node[kept]), ("size", size[where[kept]]), ("known", distinct[kept])):
                setattr(self, name, np.insert(getattr(self, name), j[kept], values))
        node = node[which]
        most = self.nodes - 1
        same = np.logical_and.reduceat(self.code[np.minimum(np.repeat(node, size) + place, most)] == code, start)
        other = np.flatnonzero(~same | (self.code[np.minimum(node + size, most)] != -1))
        if len(other):  # another segment has the same hash
            node[other] = self._add(code, start[other], size[other])
        return node

    def _add(self, code: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first nodes of new lattices of some segments of ``code``."""
        first = np.cumsum(size) - size
        code = code[np.repeat(start - first, size) + np.arange(int(size.sum()))]
        end = np.repeat(first + size, size)
        fan, head, order, length, piece, weight = self.vocabulary.edges(code, end)
        # One more node per segment for its end: node numbers are places plus the segment's number.
        segment = np.repeat(np.arange(len(size)), size)
        node = order + segment[order]  # by the length of what is left of the segment, as their edges are
        reps = fan[order]
        begin = np.repeat(node, reps)
        to = begin + length
        rest, run, log_p = np.zeros(len(code) + len(size)), np.empty(len(begin)), np.empty(len(begin))
        heads = head[order]
        left = (end - np.arange(len(code)))[order]
        cut = np.flatnonzero(np.diff(left, prepend=0))
        bounds = np.concatenate((heads, [len(begin)]))
        for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(order)]):
            e, n = slice(bounds[a], bounds[b]), reps[a:b]
            at = heads[a:b] - bounds[a]
            x = weight[e] + rest[to[e]]
            top = np.maximum.reduceat(x, at)
            p = np.exp(x - np.repeat(top, n))
            total = np.add.reduceat(p, at)
            whole = top + np.log(total)
            rest[node[a:b]] = whole
            log_p[e] = x - np.repeat(whole, n)
            p /= np.repeat(total, n)
            sums = np.cumsum(p)
            run[e] = sums - np.repeat(sums[at] - p[at], n)
        run[bounds[1:] - 1] = 1.0
        edge_of, fans = np.zeros(len(rest), np.int32), np.zeros(len(rest), np.int32)
        edge_of[node], fans[node] = heads + self.n_edges, reps
        letters = np.full(len(rest), -1, np.int32)
        letters[node] = code[order]
        lone = np.flatnonzero(piece < 0)
        piece[lone] = -1 - letters[begin[lone]]
        self._append(self.n_edges, run=run, start=(begin + self.nodes).astype(np.int32), to=(to + self.nodes).astype(np.int32),
                     piece=piece, log_p=log_p)
        self._append(self.nodes, code=letters, edge_of=edge_of, fan=fans)
        out = first + np.arange(len(size)) + self.nodes
        self.nodes += len(rest)
        self.n_edges += len(begin)
        return out

    def draw(self, node: np.ndarray, seed: np.ndarray, segment: np.ndarray, firsts: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Edges of a path from each node, which is in ``segment``, to the end of its word, and how many; ``seed`` gives the
        randomness of each. ``firsts`` has the first node of all segments, ``opens`` whether they begin a word; both
        have one entry more, for the end."""
        active, at, seed, segment, steps = np.arange(len(node)), node.copy(), seed, segment.copy(), []
        while True:
            over = np.flatnonzero(self.code[at] < 0)
            segment[over] += 1
            at[over] = firsts[segment[over]]
            ended = over[opens[segment[over]]]
            if len(ended):
                more = np.ones(len(at), bool)
                more[ended] = False
                active, at, seed, segment = active[more], at[more], seed[more], segment[more]
            if not len(active):
                break
            u = _uniform(seed + np.uint64(len(steps)))
            edge = self.edge_of[at]
            on = np.flatnonzero(u > self.run[edge])
            while len(on):
                edge[on] += 1
                on = on[u[on] > self.run[edge[on]]]
            steps.append((active, edge))
            at = self.to[edge]
        n = np.zeros(len(node), np.int64)
        for active, _ in steps:
            n[active] += 1
        first, out = np.cumsum(n) - n, np.empty(int(n.sum()), np.int64)
        for k, (active, edge) in enumerate(steps):
            out[first[active] + k] = edge
        return out, n


def _hashes(code: np.ndarray, place: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of segments, of each character and its place."""
    return mix(np.add.reduceat(mix(code.astype(np.uint64) | place.astype(np.uint64) << np.uint64(32)), start))


def _uniform(x: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 by hashing."""
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53


class _Search:
    """Perturbed A* over one text's lattice: the path drawn last, its value and the set it is the best of (paths that
    share the edges before ``start`` and take there none of ``shut``, edges of probability ``shut_p``); the
    paths ``taken`` with log-probability and value; a ``queue`` of (perturbed value, path that it leaves, place where
    it leaves it, edges already excluded there, their probability). ``begin`` has the first segment of each word."""

    __slots__ = ("salt", "value", "path", "begin", "start", "shut", "shut_p", "taken", "queue", "edge", "asked")

    def __init__(self, salt: np.ndarray, value: float, path: np.ndarray, begin: np.ndarray):
        self.salt, self.value, self.path, self.begin = salt, value, path, begin
        self.start, self.shut, self.shut_p, self.taken, self.queue = 0, (), 0.0, [], []


class Sampler:
    def __init__(self, path: str, sharpness: float, k: int, seed: int):
        self.vocabulary = Vocabulary(path, sharpness)
        self.lattices = Lattices(self.vocabulary)
        self.k, self.seed = k, np.uint64(seed)
        self.salt = numbered(3 * k + 3, 31)
        self.mixed = np.empty(0, np.uint64)

    def places(self, n: int) -> np.ndarray:
        """The hashes of 0 to n - 1."""
        if len(self.mixed) < n:
            self.mixed = mix(np.arange(max(n, 2 * len(self.mixed), 1 << 12), dtype=np.uint64))
        return self.mixed[:n]

    def texts(self, keys: np.ndarray, texts: list[str]) -> list[list[dict]]:
        """The samples of each text, by falling perturbed value."""
        out = []
        for at, part in in_parts(texts, BATCH_CHARS):
            out += self._batch(keys[at:at + len(part)], [t or "" for t in part])
        return out

    def _batch(self, keys: np.ndarray, texts: list[str]) -> list[list[dict]]:
        lat, v = self.lattices, self.vocabulary
        out: list = [[dict(ids=np.empty(0, np.int32), log_p=0.0, perturbed=0.0, inclusion=1.0)] for _ in texts]
        some = np.array([i for i, t in enumerate(texts) if t], np.int64)
        if not len(some):
            return out
        size = np.array([len(texts[i]) + 1 for i in some])
        whole = "".join(MARK + texts[i] for i in some).replace(" ", MARK)
        code = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.int32)
        # A word begins with its marks, so at a text's start and at the first of some marks
        word = code == ord(MARK)
        word[1:] &= ~word[:-1]
        word[np.cumsum(size) - size] = True
        cut = word.copy()
        cut[1:] |= ~v.joined(v.letter[code])
        start = np.flatnonzero(cut)
        firsts, opens = np.append(lat.of(code, start), 0), np.append(word[start], True)
        begin = np.flatnonzero(opens)  # the first segment of each word, and the end
        words = np.concatenate(([0], np.cumsum(np.add.reduceat(word, np.cumsum(size) - size, dtype=np.int64))))  # of the texts
        count = np.diff(words)
        base = mix(keys.astype(np.uint64) ^ mix(np.full(len(keys), self.seed)))[some]
        place = np.arange(words[-1]) - np.repeat(words[:-1], count)
        word_seed = np.repeat(base, count) + self.places(int(count.max()))[place]
        edges, n = lat.draw(firsts[begin[:-1]], word_seed, begin[:-1], firsts, opens)
        cuts = np.concatenate(([0], np.cumsum(n)))[words]
        salt = base[:, None] + self.salt
        value = -np.log(-np.log(_uniform(salt[:, 0])))
        searches = running = [_Search(salt[k], float(value[k]), edges[cuts[k]:cuts[k + 1]], begin[words[k]:words[k + 1]]) for k in range(len(some))]
        while running := self._split(running, WINDOW):
            edges, n = lat.draw(*map(np.concatenate, zip(*[self._leave(x, firsts) for x in running], strict=True)), firsts, opens)
            cuts = np.concatenate(([0], np.cumsum(n)[np.cumsum([x.asked for x in running]) - 1]))
            for x, a, b in zip(running, cuts, cuts[1:]):
                x.path = np.concatenate((x.path[:x.start], [x.edge], edges[a:b]))
        ids = iter(self._ids([path for x in searches for path, _, _ in x.taken]))
        for i, x in zip(some, searches, strict=True):
            bound = x.queue[0][0] if x.queue else -np.inf
            out[i] = [dict(ids=next(ids), log_p=log_p, perturbed=value,
                           inclusion=float(-np.expm1(-np.exp(min(log_p - bound, 700)))) if x.queue else 1.0)
                      for _, log_p, value in x.taken]
        return out

    def _split(self, searches: list[_Search], window: int) -> list[_Search]:
        """Take each search's path and split what is left of the set that it was the best of: for each place from the
        first to the last that can be among the k + 1 taken next, the segmentations that share the edges before and
        differ there. -log u lies between 2**-54 and 38, so a set of exp(-42) times another's probability stays
        behind it; ``window`` places are looked at, more where that is not enough. Returns the searches that go on."""
        lat, k = self.lattices, self.k
        whole = np.concatenate([x.path for x in searches])
        log_p = lat.log_p[whole]
        size = np.array([len(x.path) for x in searches])
        first = np.cumsum(size) - size
        start, shut_p, value = (np.array([getattr(x, name) for x in searches]) for name in ("start", "shut_p", "value"))
        before = np.array([float(log_p[a:a + x.start].sum()) for a, x in zip(first, searches)])
        place = start[:, None] + np.arange(min(max(window, k + 1), int((size - start).max())))
        inside = place < size[:, None]
        at = first[:, None] + np.minimum(place, size[:, None] - 1)
        step = np.where(inside, log_p[at], 0.0)
        sums = before[:, None] + np.cumsum(step, axis=1)
        fan, other = lat.fan[lat.start[whole[at]]], -np.expm1(step)
        fan[:, 0] -= [len(x.shut) for x in searches]
        other[:, 0] -= shut_p
        some = np.nonzero(inside & (fan > 1) & (other > 1e-15))
        rest = np.full(place.shape, -np.inf)
        rest[some] = (sums - step)[some] + np.log(other[some])
        beyond = size - start > place.shape[1]
        if place.shape[1] > k:
            bound = np.partition(rest, -k - 1, axis=1)[:, -k - 1] - 42
            beyond &= sums[:, -1] >= bound
            some = np.nonzero((rest >= bound[:, None]) & (rest > -np.inf))
        salt = np.array([x.salt[3 * len(x.taken) + 3] for x in searches])
        u = _uniform(salt[some[0]] + self.places(place.shape[1])[some[1]])
        perturbed = np.full(place.shape, -np.inf)
        perturbed[some] = rest[some] - np.log(np.exp(np.minimum(rest[some] - value[some[0]], 700)) - np.log(u))
        top = np.argpartition(-perturbed, min(k, place.shape[1] - 1), axis=1)[:, :k + 1]
        p, found = np.exp(np.take_along_axis(step, top, axis=1)).tolist(), np.take_along_axis(perturbed, top, axis=1).tolist()
        total = np.add.reduceat(log_p, first).tolist()
        again = [x for x, more in zip(searches, beyond.tolist()) if more]
        on = self._split(again, 4 * window) if again else []
        for i, (x, more, places) in enumerate(zip(searches, beyond.tolist(), top.tolist())):
            if more:
                continue
            x.taken.append((x.path, total[i], x.value))
            for t, q, y in zip(places, p[i], found[i]):
                if y > -np.inf:
                    shut, q = ((*x.shut, int(x.path[x.start])), x.shut_p + q) if t == 0 else ((int(x.path[x.start + t]),), q)
                    x.queue.append((y, len(x.taken) - 1, x.start + t, shut, q))
            x.queue.sort(key=lambda entry: -entry[0])
            if x.queue and len(x.taken) < k:
                x.value, which, x.start, x.shut, x.shut_p = x.queue.pop(0)
                x.path = x.taken[which][0]
                on.append(x)
        return on

    def _leave(self, x: _Search, firsts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Draw ``edge``, by which a path that shares the edges before ``start`` and takes there none of ``shut`` goes on.
        Returns the nodes from where it goes on at random, their seeds and their segments."""
        lat = self.lattices
        here = int(lat.start[x.path[x.start]])
        a = int(lat.edge_of[here])
        edges = np.array([e for e in range(a, a + int(lat.fan[here])) if e not in x.shut])
        run = np.cumsum(np.exp(lat.log_p[edges]))
        salt = x.salt[3 * len(x.taken) + 1:]
        x.edge = int(edges[min(np.searchsorted(run, _uniform(salt[:1])[0] * run[-1]), len(edges) - 1)])
        segment = int(x.begin[0]) + np.count_nonzero(lat.code[lat.to[x.path[:x.start]]] < 0)
        later = x.begin[np.searchsorted(x.begin, segment, "right"):]
        x.asked = len(later) + 1
        return np.append(lat.to[x.edge], firsts[later]), salt[1] + self.places(x.asked), np.append(segment, later)

    def _ids(self, paths: list[np.ndarray]) -> list[np.ndarray]:
        """The ids of the pieces of each path; a character without a piece has those of its bytes."""
        ids = self.lattices.piece[np.concatenate(paths)]
        ends = np.cumsum([len(path) for path in paths])
        lone = np.flatnonzero(ids < 0)
        if len(lone):
            code = -1 - ids[lone]
            size = np.ones(len(ids), np.int64)
            size[lone] += (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF)
            raw = code.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass")
            ids, ends = np.repeat(ids, size), np.cumsum(size)[ends - 1]
            ids[ids < 0] = self.vocabulary.byte_ids[np.frombuffer(raw, np.uint8)]
        return np.split(ids, ends[:-1])


@functools.cache
def sampler(path: str, sharpness: float, k: int, seed: int) -> Sampler:
    return Sampler(path, sharpness, k, seed)


def encode(docs: DataFrame, path: str, k: int = SAMPLES, sharpness: float = SHARPNESS, seed: int = SEED,
           key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, the ``keep`` columns, ``samples`` (up to ``k`` distinct
    segmentations by falling perturbed value: piece ids, log-probability, perturbed log-probability,
    inclusion score). A text with fewer segmentations gives all of them, each with inclusion 1.

    A null or empty text has one segmentation, without pieces. Rows of one key and text (also
    repeated ones) get the same samples; a null key is seeded as one. Other columns are ignored; an
    empty table gives an empty result. ``path`` names the model on every worker."""

    rows = docs.select(F.xxhash64(F.col(key)).alias("_seed"), F.col(text).alias("_text"),
                       F.col(key).alias("doc_id"), *(keep or []))
    schema = T.StructType(rows.schema.fields[2:]).add("samples", T._parse_datatype_string(f"array<{SAMPLE}>"))

    def sample(batches):
        engine = sampler(path, sharpness, k, seed)
        try:
            for batch in batches:
                sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
                for at, n in _stretches(sizes, BATCH_CHARS):  # texts become Python's, and results leave the worker, part by part
                    part = batch.slice(at, n)
                    found = engine.texts(part.column(0).to_numpy(), part.column(1).to_pylist())
                    yield pa.RecordBatch.from_arrays([*part.columns[2:], _arrow(found)], names=schema.names)
                    del found, part
                give_back()
        finally:
            engine.lattices.clear()  # a worker holds no lattices for the tasks after
            give_back()

    return rows.mapInArrow(sample, schema)


def _stretches(sizes: np.ndarray, most: int):
    """First and number of consecutive rows of about ``most`` characters together."""
    at = total = 0
    for i, n in enumerate(sizes.tolist()):
        total += n
        if total >= most or i + 1 == len(sizes):
            yield at, i + 1 - at
            at, total = i + 1, 0


def _arrow(samples: list[list[dict]]) -> pa.Array:
    """The samples of some texts as an Arrow array."""
    flat = [s for x in samples for s in x]

    def bounds(sizes):
        return pa.array(np.concatenate(([0], np.cumsum(sizes, dtype=np.int64))).astype(np.int32))

    ids = pa.ListArray.from_arrays(bounds([len(s["ids"]) for s in flat]), pa.array(
        np.concatenate([np.empty(0, np.int32), *(s["ids"] for s in flat)]).astype(np.int32)))
    numbers = [pa.array([s[name] for s in flat], pa.float64()) for name in ("log_p", "perturbed", "inclusion")]
    each = pa.StructArray.from_arrays([ids, *numbers], names=["ids", "log_p", "perturbed", "inclusion"])
    return pa.ListArray.from_arrays(bounds([len(x) for x in samples]), each)


@functools.cache
def spelling(path: str) -> Spelling:
    return Spelling(path)


def decode(rows: DataFrame, path: str, ids: str = "ids", out: str = "text") -> DataFrame:
    """``rows`` with ``out``, the text of the piece ids: pieces in order, runs of byte pieces read
    as UTF-8, marks as spaces, without the first one (the encoder puts it before every text). Null
    ids give null; the mark itself in an encoded text comes back as a space. A column named ``out`` is
    replaced."""
    kept = [c for c in rows.columns if c != out]
    rows = rows.select(kept)
    schema = T.StructType(list(rows.schema.fields)).add(out, "string")

    def join(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, DECODE_ROWS):  # texts leave the worker part by part
                part = batch.slice(at, DECODE_ROWS)
                column = part.column(kept.index(ids))
                sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
                bounds = np.concatenate(([0], np.cumsum(sizes)))
                texts = spelling(path).decoded(column.flatten().to_numpy(zero_copy_only=False), bounds)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string(), mask=column.is_null().to_numpy(zero_copy_only=False))],
                    names=schema.names)

    return rows.mapInArrow(join, schema)
