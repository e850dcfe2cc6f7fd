"""SentencePiece encoding, decoding and sampled segmentations without replacement.

`encode` and `decode` are the model's own.  `sample` draws for each row the
`k` segmentations with the largest Gumbel-perturbed log-probabilities, which
are distinct and distributed as draws without replacement.  They are found by
a perturbed A-star search over the text's lattice of pieces.  A region of the
search is "the path so far, then any edge but those taken", and its bound is
the maximum of its leaves' perturbed log-probabilities: a Gumbel variate at the
region's log-mass, cut at its parent's.  The regions that leave one path share
the cut, so they stand in the queue as one entry: the largest of their variates
is one cut Gumbel variate at the log of their summed mass, and which of them
has it is drawn by mass.  The search pops the best entry, draws the path that
attains its bound, and puts back what leaves that path and what is left of the
entry.  Masses come from the backward sums of the lattice, so a bound is exact
and every pop yields a sample.

Besides the ids each sample has its log-probability, its perturbed value and
the log of its inclusion probability at the search's threshold, the perturbed
value of the best region left.  Random numbers are a hash of row key, sample,
place and purpose: the same rows give the same samples however they are
partitioned or retried.

Piece log-probabilities follow the pieces' ranks by Zipf's law (the model's own
scores are ranks).  A space opens a new word, no piece reaches over it, and the
lattices of new distinct words are built together in numpy and kept for later
groups of texts in buffers of a fixed size.

Edge cases.  Null and empty texts have one segmentation without pieces, log-
probability 0.  Texts with fewer than k segmentations give all of them.
Characters without a piece are spelled in bytes.  U+2581 reads as a space, as
in the model.  A null key is hashed as its own value.  Repeated rows give the
same samples.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SAMPLES = 2
SPACE = "▁"
GROUP_CHARS = 1_000_000
#: Log-probability that a code point of a common word costs about.
SCALE = 3.0

_word = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
_U = np.uint64


def model_file() -> str:
    """The default model: the installed public 32k piece model."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.atleast_1d(x)  # arrays wrap around without a warning
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _uniform(key: np.ndarray, sample: np.ndarray | int, place: np.ndarray | int, purpose: int) -> np.ndarray:
    """Uniform numbers in (0, 1): a hash of row key, sample, place (a code point of the text) and purpose."""
    at = np.asarray(place, np.int64) * 8 + np.asarray(sample, np.int64) * (1 << 40) + np.int64(purpose)
    h = _mix(_mix(key + _U(0x9E3779B97F4A7C15)) ^ (at.astype(np.uint64) * np.array(0xD6E8FEB86659FD93, np.uint64)))
    return ((h >> _U(11)).astype(np.float64) + 0.5) / float(1 << 53)


class Pieces:
    """A SentencePiece model and what the lattice needs of it."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.spelled = np.zeros(256, np.int64)
        self.bytes: list[bytes] = []
        entries: dict[int, int] = {}
        rank, self.log_p = 0, np.full(self.size, -np.inf)
        norm = np.log(np.log(self.size) + 0.5772)
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            if self.model.is_byte(i):
                self.spelled[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
                self.log_p[i] = -np.log(self.size) - norm
                continue
            self.bytes.append(b"" if self.model.is_control(i) or self.model.is_unknown(i) else piece.encode())
            if not self.bytes[i]:
                continue
            rank += 1
            self.log_p[i] = -np.log(rank) - norm
            h = np.zeros(1, np.uint64)
            for j, c in enumerate(piece):
                h = self._extend(h, np.array([ord(c)], np.uint64))
                entries[int(h[0])] = i if j == len(piece) - 1 else entries.get(int(h[0]), -1)
        self.table = common.HashTable(entries)
        self.spelling = pa.array(self.bytes, pa.large_binary())
        self._store: Store | None = None

    @staticmethod
    def _extend(h: np.ndarray, c: np.ndarray) -> np.ndarray:
        h = (h + c + _U(1)) * _U(0x9E3779B97F4A7C15)
        return h ^ (h >> _U(29))

    def lattice(self, words: list[str]) -> Lattice:
        return Lattice(self, words)

    def store(self) -> Store:
        """The lattice that this process keeps from group to group."""
        if self._store is None:
            self._store = Store(self)
        return self._store


class Lattice:
    """The lattices of distinct words, laid end to end; a node is a code point's place.

    Edges are sorted by node, the longest piece of a node first: it is mostly the
    likeliest, so a draw that walks along `cumulated` stops after a step or two.
    """

    def __init__(self, pieces: Pieces, words: list[str]):
        self.pieces = pieces
        c = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.concatenate([[0], np.cumsum(length)])
        self.end = np.repeat(self.start[1:], length)
        at, h, found = np.arange(len(c)), np.zeros(len(c), np.uint64), []
        many = np.ones(len(c), np.int64)
        while len(at):
            h = pieces._extend(h, c[at + len(found)])
            entry = pieces.table.find(h)
            piece = np.where(entry >= 0, pieces.table.values[entry], -1)
            good = piece >= 0
            if not found:  # a character without a piece of its own is spelled: piece number size + code point
                found.append((at, np.where(good, piece, pieces.size + c.astype(np.int64))))
            else:
                found.append((at[good], piece[good]))
                many[at[good]] += 1
            go = (entry >= 0) & (at + len(found) < self.end[at])
            at, h = at[go], h[go]
        self.first = np.concatenate([[0], np.cumsum(many)])
        edges = int(self.first[-1])
        self.src, self.dst, self.piece = np.repeat(np.arange(len(c)), many), np.empty(edges, np.int64), np.empty(edges, np.int64)
        place = self.first[:-1].copy()
        for span in range(len(found), 0, -1):
            node, piece = found[span - 1]
            to = place[node]
            place[node] += 1
            self.dst[to], self.piece[to] = node + span, piece
        self.final = self.dst == self.end[self.src]
        p, self.log_prob = self._probabilities()
        cum = np.cumsum(p)
        self.cumulated = cum - np.concatenate([[0.0], cum])[self.first[self.src]]
        self.cumulated[self.first[1:] - 1] = 1.0

    def _weights(self) -> np.ndarray:
        """Log-probability of each edge's piece; a spelled character counts as its bytes."""
        known = self.piece < self.pieces.size
        if known.all():
            return self.pieces.log_p[self.piece]
        odd = self.piece - self.pieces.size
        cost = 1.0 + (odd >= 0x80) + (odd >= 0x800) + (odd >= 0x10000)
        return np.where(known, self.pieces.log_p[np.where(known, self.piece, 0)], self.pieces.log_p[self.pieces.spelled[0]] * cost)

    def _levels(self) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """Edges by their node's distance from its word's end, and where each distance starts and ends."""
        left = self.end[self.src] - self.src
        many = int(left.max()) if len(left) else 0
        order = np.argsort(left.astype(np.uint16) if many < 1 << 16 else left, kind="stable")
        cuts = np.searchsorted(left[order], np.arange(1, many + 2)).tolist()
        return order, [(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

    def _probabilities(self) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each edge at its node, given all ways to the word's end, and its logarithm.

        Every way from a node covers the same code points, so a factor for each
        of them keeps the sums near 1; where that is not enough, logarithms are summed.
        """
        weight = self._weights()
        order, levels = self._levels()
        w = np.exp(weight + SCALE * (self.dst - self.src))
        src, dst, x, final = self.src[order], self.dst[order], w[order], self.final[order]
        total = np.zeros(len(self.end) + 1)
        with np.errstate(over="ignore"):
            for a, b in levels:
                starts = np.concatenate([[0], np.flatnonzero(np.diff(src[a:b])) + 1])
                total[src[a:b][starts]] = np.add.reduceat(x[a:b] * np.where(final[a:b], 1.0, total[dst[a:b]]), starts)
        if len(total) == 1 or (total[:-1].min() > 1e-200 and total.max() < 1e200):
            p = w * np.where(self.final, 1.0, total[self.dst]) / total[self.src]
            p[(self.first[1:] - self.first[:-1] == 1)[self.src]] = 1.0
            return p, np.log(p)
        weight_ = weight[order]
        for a, b in levels:
            v = weight_[a:b] + np.where(final[a:b], 0.0, total[dst[a:b]])
            starts = np.concatenate([[0], np.flatnonzero(np.diff(src[a:b])) + 1])
            m = np.maximum.reduceat(v, starts)
            total[src[a:b][starts]] = m + np.log(np.add.reduceat(np.exp(v - np.repeat(m, np.diff(np.append(starts, b - a)))), starts))
        log_p = weight + np.where(self.final, 0.0, total[self.dst]) - total[self.src]
        return np.exp(log_p), log_p

    def draw(self, nodes: np.ndarray, u: np.ndarray) -> np.ndarray:
        """An edge for each node."""
        e = self.first[nodes]
        on = np.flatnonzero(u >= self.cumulated[e])
        while len(on):
            e[on] += 1
            on = on[u[on] >= self.cumulated[e[on]]]
        return e

    def paths(self, nodes: np.ndarray, key: np.ndarray, sample: int, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Random paths from each node to its word's end: edges in order of the nodes given, and how many each.

        place: of each node in its row's text; the draws of a path count on from it.
        """
        live, at, parts, of = np.arange(len(nodes)), nodes, [], []
        count = np.zeros(len(nodes), np.int64)
        while len(live):
            e = self.draw(at, _uniform(key[live], sample, place[live] + count[live], 1))
            parts.append(e)
            of.append((live, count[live]))
            count[live] += 1
            go = ~self.final[e]
            live, at = live[go], self.dst[e[go]]
        out = np.empty(int(count.sum()), np.int64)
        first = np.cumsum(count) - count
        for e, (k, s) in zip(parts, of, strict=True):
            out[first[k] + s] = e
        return out, count


def _cut(mass: float, bound: float, u: float) -> float:
    """A Gumbel variate at log-mass `mass`, conditioned to lie below `bound`."""
    return -float(np.logaddexp(-bound, np.log(-np.log(u)) - mass))


class Store(Lattice):
    """A lattice that words are added to, so that words met in earlier groups are not built again.

    Buffers are allocated once; when they are full the store starts anew with
    the words of the present group.
    """

    NODES, EDGES = 3_000_000, 8_000_000
    _BY_EDGE = (("src", np.int32), ("dst", np.int32), ("piece", np.int32), ("log_prob", np.float64), ("cumulated", np.float64), ("final", bool))

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._edge = {k: np.empty(self.EDGES, t) for k, t in self._BY_EDGE}
        self._first, self._end, self._start = np.zeros(self.NODES + 1, np.int32), np.empty(self.NODES, np.int32), np.zeros(self.NODES + 1, np.int32)
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.nodes = self.edges = 0
        for k, _ in self._BY_EDGE:
            setattr(self, k, self._edge[k][:0])
        self.first, self.end, self.start = self._first[:1], self._end[:0], self._start[:1]

    def add(self, words: list[str]) -> Lattice:
        """A lattice whose `index` holds all of `words`: the store itself, or a separate one if they are too many."""
        new = [w for w in words if w not in self.index]
        if not new:
            return self
        part = Lattice(self.pieces, new)
        if self.nodes + len(part.end) > self.NODES or self.edges + len(part.src) > self.EDGES:
            self._clear()
            if len(new) < len(words):
                part = Lattice(self.pieces, words)
            new = words
            if len(part.end) > self.NODES or len(part.src) > self.EDGES:
                part.index = {w: i for i, w in enumerate(words)}
                return part
        n, e, t = self.nodes, self.edges, len(self.index)
        for k, shift in (("src", n), ("dst", n), ("piece", 0), ("log_prob", 0), ("cumulated", 0), ("final", 0)):
            into = self._edge[k][e : e + len(part.src)]
            into[:] = getattr(part, k)
            if shift:
                into += shift
        self._first[n : n + len(part.end) + 1] = part.first + e
        self._end[n : n + len(part.end)] = part.end + n
        self._start[t : t + len(new) + 1] = part.start + n
        self.index.update(zip(new, range(t, t + len(new)), strict=True))
        self.nodes, self.edges = n + len(part.end), e + len(part.src)
        for k, _ in self._BY_EDGE:
            setattr(self, k, self._edge[k][: self.edges])
        self.first, self.end, self.start = self._first[: self.nodes + 1], self._end[: self.nodes], self._start[: len(self.index) + 1]
        return self


class _Leaf:
    def __init__(self, edges: np.ndarray, log_prob: float, value: float):
        self.edges, self.log_prob, self.value = edges, log_prob, value


class _Regions:
    """Regions of the search that share a bound: the ways that leave `leaf` at a place from `first` on.

    head: log-probability of the leaf up to `first`; total: mass of the regions
    over that; taken: edges of a place that were left out with other leaves,
    besides the leaf's own.
    """

    def __init__(self, lat: Lattice, leaf: _Leaf, first: int, head: float, total: float, taken: dict[int, tuple[int, ...]]):
        self.leaf, self.first, self.head, self.taken = leaf, first, head, taken
        #: Whether the masses have to be added up one by one: small ones are lost in the rounding of the path's own.
        self.fine = bool(taken) or total < 1e-7
        self.total = total if total >= 1e-7 else float(self.masses(lat)[0].sum())
        self.log_mass = head + float(np.log(self.total)) if self.total > 0 else -np.inf

    def without(self, lat: Lattice, place: int, edge: int, mass: float) -> _Regions:
        """What is left once `edge` of `place`, of that mass over `head`, was taken too."""
        left = self.total - mass
        return _Regions(lat, self.leaf, self.first, self.head, left if left > 1e-6 * self.total else 0.0, self.taken | {place: (*self.taken.get(place, ()), edge)})

    def masses(self, lat: Lattice) -> tuple[np.ndarray, np.ndarray]:
        """Mass of the ways that leave the leaf at each place, over `head`, and the log-probability from `first` up to it."""
        e = self.leaf.edges[self.first :]
        if not len(e):
            return np.zeros(0), np.zeros(0)
        log_p, node = lat.log_prob[e], lat.src[e]
        before = np.cumsum(log_p) - log_p
        start = lat.first[node].astype(np.int64)
        many = lat.first[node + 1] - start
        at = np.cumsum(many) - many
        p = np.exp(lat.log_prob[np.repeat(start - at, many) + np.arange(int(many.sum()))])
        p[at + e - start] = 0.0
        for place, out in self.taken.items():
            p[at[place - self.first] + np.array(out) - start[place - self.first]] = 0.0
        return np.exp(before) * np.add.reduceat(p, at), before

    def pick(self, lat: Lattice, u: float, v: float) -> tuple[int, int, float]:
        """A place of the leaf and an edge there that leaves it, drawn by mass, and the log-probability from `first` up to it."""
        edges = self.leaf.edges
        if self.fine:
            mass, before = self.masses(lat)
            run = np.cumsum(mass)
            i = min(int(np.searchsorted(run, u * run[-1], side="right")), int(np.flatnonzero(mass)[-1]))
            place, head = self.first + i, float(before[i])
        else:  # the ways that leave up to a place have what the path has lost by then
            goal, lo, size, head, place = -np.log1p(-u * self.total), self.first, 64, 0.0, -1
            while place < 0 and lo < len(edges):
                log_p = lat.log_prob[edges[lo : lo + size]]
                run = head + np.cumsum(log_p)
                i = int(np.searchsorted(-run, goal, side="right"))
                if i < len(run):
                    place, head = lo + i, float(run[i] - log_p[i])
                else:
                    lo, size, head = lo + size, size * 4, float(run[-1])
            if place < 0:  # rounding: the last place that can be left
                log_p = lat.log_prob[edges[self.first :]]
                i = int(np.flatnonzero(log_p < 0)[-1])
                place, head = self.first + i, float(log_p[:i].sum())
        own = int(edges[place])
        node = int(lat.src[own])
        gone = (own, *self.taken.get(place, ()))
        options = np.array([x for x in range(lat.first[node], lat.first[node + 1]) if x not in gone])
        weight = np.cumsum(np.exp(lat.log_prob[options]))
        return place, int(options[min(int(np.searchsorted(weight, v * weight[-1], side="right")), len(options) - 1)]), head


def _group(pieces: Pieces, views: list[str | None], keys: np.ndarray, k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each row (its `view_of`) up to k samples (pieces, log_prob, value, log_inclusion)."""
    words = pc.split_pattern(pa.array(views, pa.string()), " ")
    flat = words.flatten().dictionary_encode()
    distinct = flat.dictionary.to_pylist()
    lat = pieces.store().add(distinct)
    types = np.fromiter(map(lat.index.__getitem__, distinct), np.int64, len(distinct))[flat.indices.to_numpy()]
    n = pc.fill_null(pc.list_value_length(words), 0).to_numpy().astype(np.int64)
    base = np.concatenate([[0], np.cumsum(n)])
    start = lat.start[types]
    size = lat.start[types + 1] - start
    run = np.concatenate([[0], np.cumsum(size)])
    offset = run[:-1] - np.repeat(run[base[:-1]], n)  # of each word in its row's text
    leaves: list[list[_Leaf]] = [[] for _ in views]
    pools: list[list[tuple[float, _Regions]]] = [[] for _ in views]

    # what each row draws now: (row, regions to leave or None, place, edge, log-probability up to it, value)
    jobs = [(r, None, 0, 0, 0.0, float(-np.log(-np.log(u)))) for r, u in enumerate(_uniform(keys, 0, 0, 0).tolist())]
    for turn in range(k):
        nodes, places = [], []
        for r, regions, place, edge, *_ in jobs:
            lo = base[r]
            if regions is not None:
                ended = np.flatnonzero(lat.final[regions.leaf.edges[:place]])
                lo += len(ended)
                if not lat.final[edge]:  # the rest of the word that the edge lies in
                    nodes.append(lat.dst[edge : edge + 1])
                    places.append(offset[lo : lo + 1] + place + 1 - (ended[-1] + 1 if len(ended) else 0))
                lo += 1
            nodes.append(start[lo : base[r + 1]])
            places.append(offset[lo : base[r + 1]])
        if not jobs:
            break
        many = np.fromiter(map(len, nodes), np.int64, len(nodes))
        part = np.cumsum([0, *(1 + (j[1] is not None and not lat.final[j[3]]) for j in jobs)])
        many = np.add.reduceat(many, part[:-1])
        nodes_ = np.concatenate(nodes).astype(np.int64)
        edges, count = lat.paths(nodes_, np.repeat(keys[[j[0] for j in jobs]], many), turn, np.concatenate(places))
        cuts = np.concatenate([[0], np.cumsum(count)])[np.concatenate([[0], np.cumsum(many)])]
        lp = lat.log_prob[edges]
        later = []
        own_keys = keys[[j[0] for j in jobs]][:, None]
        cut_at, picked_at = (_uniform(own_keys, sample, np.arange(2)[None, :], purpose).tolist() for sample, purpose in ((turn, 2), (turn + 1, 3)))
        for j, (r, regions, place, edge, before, value) in enumerate(jobs):
            tail = edges[cuts[j] : cuts[j + 1]]
            log_p = float(lp[cuts[j] : cuts[j + 1]].sum())
            if regions is None:
                leaf = _Leaf(tail, log_p, value)
                found = [_Regions(lat, leaf, 0, 0.0, -float(np.expm1(log_p)), {})]
            else:
                own = before + float(lat.log_prob[edge])
                head = regions.head + own
                leaf = _Leaf(np.concatenate([regions.leaf.edges[:place], [edge], tail]), head + log_p, value)
                found = [_Regions(lat, leaf, place + 1, head, -float(np.expm1(log_p)), {}), regions.without(lat, place, edge, float(np.exp(own)))]
            leaves[r].append(leaf)
            pools[r] += [(_cut(x.log_mass, value, w), x) for x, w in zip(found, cut_at[j], strict=False) if x.log_mass > -np.inf]
            pools[r].sort(key=lambda x: -x[0])
            if pools[r] and turn < k - 1:
                bound, best = pools[r].pop(0)
                later.append((r, best, *best.pick(lat, *picked_at[j]), bound))
        jobs = later
    out = []
    for r, found in enumerate(leaves):
        limit = pools[r][0][0] if pools[r] else -np.inf
        rows = []
        for leaf in found:
            x = leaf.log_prob - limit
            rows.append((lat.piece[leaf.edges], leaf.log_prob, leaf.value, 0.0 if x > 30 else float(np.log(-np.expm1(-np.exp(x)))) if x > -30 else x))
        out.append(rows)
    return out


def view_of(text: str | None) -> str | None:
    """The words of the model's view of a text (a space before it, spaces as U+2581), parted by spaces; None without any."""
    if not text:
        return None
    if "  " in text or SPACE in text or text[-1] == " " or text[0] == " ":
        return " ".join(_word(SPACE + text.replace(" ", SPACE)))
    return SPACE + text.replace(" ", " " + SPACE)


def words_of(text: str | None) -> list[str]:
    """The words of `view_of`."""
    view = view_of(text)
    return view.split(" ") if view else []


def spell(pieces: Pieces, found: np.ndarray) -> np.ndarray:
    """Piece ids with characters that have no piece spelled in bytes."""
    if not len(found) or found.max() < pieces.size:
        return found
    if (found < pieces.size + 128).all():
        return np.where(found < pieces.size, found, pieces.spelled[np.maximum(found - pieces.size, 0) & 127])
    return np.fromiter(chain.from_iterable((i,) if i < pieces.size else (int(pieces.spelled[b]) for b in chr(i - pieces.size).encode("utf-8", "surrogatepass")) for i in found.tolist()), np.int64)


def spelled_bytes(pieces: Pieces, ids: np.ndarray) -> bytes:
    taken = pieces.spelling.take(pa.array(ids, pa.int64()))
    end = int(np.frombuffer(taken.buffers()[1], np.int64, len(ids) + 1)[-1]) if len(ids) else 0
    return bytes(memoryview(taken.buffers()[2])[:end]) if end else b""


def join(pieces: Pieces, ids: np.ndarray) -> str:
    """The text of piece ids."""
    s = spelled_bytes(pieces, ids).decode("utf-8", "surrogatepass").replace(SPACE, " ")
    return s[1:] if s[:1] == " " else s


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def sample_texts(pieces: Pieces, texts: list[str | None], keys: list[int], k: int) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to k samples (ids, log_prob, value, log_inclusion), best value first."""
    out, at = [], 0
    while at < len(texts):
        to, chars = at, 0
        while to < len(texts) and (to == at or chars + len(texts[to] or "") <= GROUP_CHARS):
            chars += len(texts[to] or "")
            to += 1
        rows = _group(pieces, [view_of(t) for t in texts[at:to]], np.array(keys[at:to], np.int64).view(np.uint64), k)
        out += [[(spell(pieces, p), *rest) for p, *rest in r] for r in rows]
        at = to
    return out


_SCHEMA = "doc_id long, sample int, n_ids long, ids_crc32 long, log_prob double, perturbed double, log_inclusion double, round_trip boolean"


def _sample(batches: Iterator[pa.RecordBatch], path: str, k: int, ids_as: pa.DataType | None) -> Iterator[pa.RecordBatch]:
    pieces = load(path)
    for batch in batches:
        texts = batch.column("text").to_pylist()
        for at in range(0, len(texts), 1024):
            part = texts[at : at + 1024]
            rows, cols = [], [[] for _ in range(8)]
            for i, (text, found) in enumerate(zip(part, sample_texts(pieces, part, batch.column("key")[at : at + 1024].to_pylist(), k), strict=True)):
                # what decoding reads, before the first space is dropped and U+2581 turned into spaces
                view = (SPACE + text.replace(" ", SPACE)).encode("utf-8", "surrogatepass") if text else b""
                for s, (ids, log_p, value, inclusion) in enumerate(found):
                    data = ids.astype("<u4").tobytes()
                    for col, v in zip(cols, (s, len(ids), zlib.crc32(data), log_p, value, inclusion, spelled_bytes(pieces, ids) == view, None if ids_as is None else data if ids_as == pa.binary() else ids.astype(np.int32)), strict=True):
                        col.append(v)
                    rows.append(at + i)
            types = [pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_(), ids_as or pa.null()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            names = [c.split()[0] for c in _SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int32())), *arrays[: 7 if ids_as is None else 8]], names if ids_as is None else [*names, "ids"])


def sample(docs: DataFrame, k: int = SAMPLES, path: str | None = None, keep_ids: bool = True, packed: bool = False) -> DataFrame:
    """Sampled segmentations of `docs` (doc_id, text): one row for each sample, seeded by doc_id.

    `ids` is an array, or, `packed`, little-endian unsigned 32-bit integers in one binary value.
    """
    path = path or model_file()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id").cast("string")).alias("key"))
    ids_as = (pa.binary() if packed else pa.list_(pa.int32())) if keep_ids else None
    return rows.mapInArrow(lambda it: _sample(it, path, k, ids_as), _SCHEMA + (", ids binary" if packed else ", ids array<int>") * keep_ids)


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    model = load(path).model
    for batch in batches:
        ids = model.encode([t or "" for t in batch.column("text").to_pylist()], num_threads=1)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and ids of the model's own (deterministic) segmentation; null texts have no ids."""
    path = path or model_file()
    return docs.select("doc_id", "text").mapInArrow(lambda it: _encode(it, path), "doc_id long, ids array<int>")


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = load(path)
    for batch in batches:
        texts = [join(pieces, np.array(i or [], np.int64)) for i in batch.column("ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text of rows of piece ids."""
    path = path or model_file()
    return encoded.select("doc_id", "ids").mapInArrow(lambda it: _decode(it, path), "doc_id long, text string")
