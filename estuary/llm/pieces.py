"""SentencePiece encoding with sampled segmentations, and lossless decoding.

All segmentations of a text into vocabulary pieces form a lattice. A text's
segmentation is drawn from it exactly: a forward filter sums the probability of
all ways to reach each position, a backward sampler walks from the end and picks
each piece in proportion to the probability of the paths through it. Uniform
numbers come from a hash of the row key, the word's place and the step, so a
text gives the same pieces on any cluster and after any retry.

The vocabulary file ranks its pieces (byte-pair merges). A piece of rank r has
probability proportional to 1 / (r + 2), raised to ``theta``: 1 follows the
ranks, smaller values flatten the draw.

No piece goes on after a space has ended it or across a line feed, so the lattice
of a text is a chain of the lattices of its units (spaces with the word that
follows; a line feed). The filter of a unit is computed once and kept in a bounded
table; the sampler walks all units of many texts in step. A character without a
piece of its own, also U+2581 that stands for the space in the vocabulary file,
is spelled in byte pieces, which keeps decoding lossless for every text.
"""

from __future__ import annotations

import math
import re
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from estuary.llm.common import id_text, rebatched, trimmed

MODEL = "piece_bpe_32k.model"
THETA = 0.3
CACHE_UNITS = 80_000
_MARK = "▁"
_UNITS = re.compile(r"\n| *[^ \n]+| +")


class Vocabulary:
    """Pieces of a model file, with a plain space for the file's space mark."""

    def __init__(self, path: str):
        import sentencepiece

        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.byte_id = [0] * 256
        self.text: list[bytes] = [b""] * p.get_piece_size()
        self.log_p = np.zeros(p.get_piece_size())
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            self.log_p[i] = -math.log(i + 2.0)
            if p.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.text[i] = bytes([int(piece[1:-1], 16)])
            elif not (p.is_control(i) or p.is_unknown(i) or p.is_unused(i)):
                plain = piece.replace(_MARK, " ")
                if plain and "\n" not in plain and " " not in plain.lstrip(" "):
                    self.ids[plain] = i
                self.text[i] = plain.encode()
        at = np.cumsum([0, *map(len, self.text)])
        self.flat, self.start = np.frombuffer(b"".join(self.text), np.uint8), at[:-1]
        self.size = np.diff(at)

    def spell(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of many id sequences, one after the other in ``ids``."""
        n = self.size[ids]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.flat[np.repeat(self.start[ids] - (ends - n), n) + np.arange(total)].tobytes()
        cut = np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts)))].tolist()
        return [raw[a:b].decode("utf-8", "replace")[1:] for a, b in zip(cut, cut[1:])]


class PieceTrie:
    """Trie of the pieces, as a table addressed by node and next character.

    The key of an edge, node << 21 | character, is exact, so no two edges are ever
    mistaken for one another. Node 0 is the root."""

    _GOLDEN = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, ids: dict[str, int]):
        edges: dict[int, int] = {}
        piece = [-1]
        for text, k in ids.items():
            node = 0
            for c in text:
                node = edges.setdefault(node << 21 | ord(c), len(piece))
                if node == len(piece):
                    piece.append(-1)
            piece[node] = k
        self.piece = np.array(piece, np.int32)
        bits = max(4, (4 * len(edges)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys, self.child = np.full((1 << bits) + 1, -1, np.int64), np.zeros((1 << bits) + 1, np.int64)
        keys, nodes = np.array(list(edges), np.int64), np.array(list(edges.values()), np.int64)
        slot = self._slot(keys)
        while len(keys):  # of the edges that want a slot the first takes it, the others go on to the next
            free = self.keys[slot] < 0
            _, first = np.unique(slot, return_index=True)
            first = first[free[first]]
            self.keys[slot[first]], self.child[slot[first]] = keys[first], nodes[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, nodes, slot = keys[rest], nodes[rest], self._next(slot[rest])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * self._GOLDEN) >> self.shift).astype(np.int64)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return (slot + 1) % (len(self.keys) - 1)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """Child of each node by its character; 0 where there is none."""
        key = node << 21 | char
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.child[slot], 0)
        on = np.flatnonzero((there != key) & (there >= 0))
        while len(on):
            slot_on = slot[on] = self._next(slot[on])
            there = self.keys[slot_on]
            hit = there == key[on]
            out[on[hit]] = self.child[slot_on[hit]]
            on = on[~hit & (there >= 0)]
        return out


class Sampler:
    """Forward filters of units, and the backward sampler over many texts.

    Node k stands for a position of a unit; its arcs (the pieces that end there)
    are first_arc[k] to first_arc[k + 1]. Node 0 is where every unit begins. The
    table keeps up to ``cache`` units, the first that two batches have met; others
    are filtered where they occur. Shares are kept as 32-bit floats.
    """

    def __init__(self, path: str, theta: float = THETA, cache: int = CACHE_UNITS):
        v = self.vocabulary = Vocabulary(path)
        self.theta, self.cache = theta, cache
        self.log_w = theta * v.log_p
        self.units: dict[str, int] = {"": 0}  # last node of each unit
        self.met: set[int] = set()  # hashes of units that were met, while there is room for more
        self.first_arc = array("q", [0, 0])
        self.piece, self.previous, self.upto = array("i"), array("i"), array("f")
        self.trie = PieceTrie(v.ids)

    def _arcs(self, codes: np.ndarray, place: np.ndarray):
        """(end character, length, piece) of every vocabulary piece inside a unit, in the
        order of (end, length): all characters walk down the trie together, as far as
        their unit and the trie go."""
        ends, ranks, pieces, lengths = [], [], [], []
        at, node, n = np.arange(len(codes), dtype=np.int32), np.zeros(len(codes), np.int64), 0
        count = np.zeros(len(codes) + 1, np.int32)  # arcs that end at each character so far
        while len(at):
            node = self.trie.step(node, codes[at])
            on = node > 0
            at, node, n = at[on], node[on], n + 1
            piece = self.trie.piece[node]
            hit = piece >= 0
            end = at[hit]
            rank = count[end]
            count[end] = rank + 1
            ends.append(end)
            ranks.append(rank)
            pieces.append(piece[hit])
            lengths.append(np.full(len(end), n, np.int32))
            at = at + 1
            on = at < len(codes)
            on[on] = place[at[on]] > 0
            at, node = at[on], node[on]
        first = np.cumsum(count, dtype=np.int32) - count
        out = [np.empty(int(count.sum()), np.int32) for _ in range(3)]
        for end, rank, piece, length in zip(ends, ranks, pieces, lengths):
            to = first[end] + rank
            for x, v in zip(out, (end, length, piece)):
                x[to] = v
        return out

    def _learn(self, units: list[str]) -> dict[str, int]:
        """Filter new units together, position by position; returns their last nodes.

        The filter runs on logarithms: unit lengths are not bounded.
        """
        text = "".join(units)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        size = np.fromiter(map(len, units), np.int64, len(units))
        last = np.cumsum(size) - 1
        place = (np.arange(len(codes)) - np.repeat(last + 1 - size, size)).astype(np.int32)
        end, length, piece = self._arcs(codes, place)
        base = len(self.first_arc) - 1  # node of character c: base + c
        before = np.where(length > place[end], 0, np.int32(base) + end - length)
        log_w = self.log_w[piece]
        extra_piece, extra_before = [], []
        spelled = np.ones(len(codes), bool)
        spelled[end[length == 1]] = False
        if spelled.any():  # characters without a piece: a chain of byte pieces through extra nodes
            rows = []
            for c in np.flatnonzero(spelled).tolist():
                ids = [self.vocabulary.byte_id[b] for b in text[c].encode()]
                at = base + c - 1 if place[c] else 0
                for k in ids[:-1]:
                    extra_piece.append(k)
                    extra_before.append(at)
                    at = base + len(codes) + len(extra_piece) - 1
                rows.append((c, 1, ids[-1], at, sum(self.log_w[k] for k in ids)))
            c, n, k, at, w = (np.array(x) for x in zip(*rows))
            end, length = np.concatenate((end, c)), np.concatenate((length, n))
            piece, before = np.concatenate((piece, k.astype(np.int32))), np.concatenate((before, at))
            log_w = np.concatenate((log_w, w))
            order = np.lexsort((length, end))
            end, length, piece, before, log_w = (x[order] for x in (end, length, piece, before, log_w))
        mass, upto = np.zeros(len(codes)), np.empty(len(end))
        level = place[end]
        longest = int(place.max())
        by_place = np.argsort(level.astype(np.uint16) if longest < 1 << 16 else level, kind="stable")
        bounds = np.concatenate(([0], np.cumsum(np.bincount(level, minlength=longest + 1))))
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            arc = by_place[a:b]
            e, n = end[arc], length[arc]
            x = log_w[arc] + np.where(n > place[e], 0.0, mass[e - n])
            new = np.flatnonzero(np.concatenate(([True], e[1:] != e[:-1])))
            count = np.diff(np.append(new, len(e)))
            top = np.maximum.reduceat(x, new)
            share = np.exp(x - np.repeat(top, count))
            total = np.add.reduceat(share, new)
            run = np.cumsum(share)
            upto[arc] = (run - np.repeat(run[new] - share[new], count)) / np.repeat(total, count)
            mass[e[new]] = top + np.log(total)
        upto[np.append(np.flatnonzero(np.diff(end)), len(end) - 1)] = 2.0  # the last arc takes what rounding leaves
        arcs = len(self.piece)
        first = np.searchsorted(end, np.arange(1, len(codes) + 1)) + arcs
        self.first_arc.frombytes(first.astype(np.int64).tobytes())
        self.first_arc.extend(range(arcs + len(end) + 1, arcs + len(end) + 1 + len(extra_piece)))
        self.piece.frombytes(piece.astype(np.int32).tobytes())
        self.piece.extend(extra_piece)
        self.previous.frombytes(before.astype(np.int32).tobytes())
        self.previous.extend(extra_before)
        self.upto.frombytes(upto.astype(np.float32).tobytes())
        self.upto.extend([2.0] * len(extra_piece))
        return dict(zip(units, (base + last).tolist()))

    def _admit(self, units: dict[str, None]) -> tuple[list[str], list[str]]:
        """Units that the table takes, and the others: it takes a unit that an earlier batch met too,
        as long as there is room, so units that occur once do not fill it."""
        room = self.cache - len(self.units)
        if room <= 0:
            return [], list(units)
        codes = [hash(u) for u in units]
        again, once = [], []
        for u, c in zip(units, codes):
            (again if c in self.met and len(again) < room else once).append(u)
        if len(self.met) + len(codes) > 4 * self.cache:
            self.met.clear()
        self.met.update(codes)
        return again, once

    def _forget(self, nodes: int) -> None:
        """Drop every node after the first ``nodes``."""
        del self.first_arc[nodes + 1:]
        for x in (self.piece, self.previous, self.upto):
            del x[self.first_arc[-1]:]

    def split(self, text: str) -> list[str]:
        """Units of the text with one space put in front."""
        if "  " in text or "\0" in text or text[:1] == " " or text[-1:] == " ":
            return _UNITS.findall(" " + text)
        return (" " + text.replace(" ", "\0 ").replace("\n", "\0\n\0")).split("\0")

    def encode(self, texts: list[str | None], seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts (int32) and their number per text. NULL and empty
        texts have none. ``seeds`` (uint64) has one per text."""
        units: list[str] = []  # of all texts
        counts = []
        for t in texts:
            own = self.split(t) if t else []
            units += own
            counts.append(len(own))
        last = np.fromiter(map(self.units.get, units, repeat(-1)), np.int64, len(units))
        kept = len(self.first_arc) - 1
        holes = np.flatnonzero(last < 0).tolist()
        if holes:
            missing = [units[i] for i in holes]
            again, once = self._admit(dict.fromkeys(missing))
            new = self._learn(again) if again else {}
            if again:
                self.units |= new
                kept = len(self.first_arc) - 1
            if once:
                new |= self._learn(once)
            last[holes] = np.fromiter(map(new.__getitem__, missing), np.int64, len(missing))
        counts = np.array(counts, np.int64)
        owner = np.repeat(np.arange(len(texts)), counts)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        base = _mix(seeds[owner] + place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))
        pieces, n = self._walk(last, base)
        self._forget(kept)
        per_text = np.bincount(owner, n, len(texts)).astype(np.int64) if len(owner) else np.zeros(len(texts), np.int64)
        return pieces, per_text

    def _walk(self, node: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sample every unit backwards from its last node, one piece each a step."""
        first, piece = np.frombuffer(self.first_arc, np.int64), np.frombuffer(self.piece, np.int32)
        previous, upto = np.frombuffer(self.previous, np.int32), np.frombuffer(self.upto, np.float32)
        steps, who = [], np.flatnonzero(node)
        node = node[who]
        n = np.zeros(len(base), np.int64)
        k = 0
        while len(who):
            u = (_mix(base[who] + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(11)) * 2.0 ** -53
            arc = first[node]
            behind = np.flatnonzero(upto[arc] <= u)
            while len(behind):
                arc[behind] += 1
                behind = behind[upto[arc[behind]] <= u[behind]]
            steps.append((who, piece[arc]))
            n[who] += 1
            node = previous[arc]
            on = node > 0
            who, node = who[on], node[on]
            k += 1
        ends = np.cumsum(n)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.int32)
        for back, (w, p) in enumerate(steps):
            out[ends[w] - 1 - back] = p
        return out, n

    def decode(self, ids) -> str:
        """The text that the ids were made from."""
        return self.vocabulary.spell(np.asarray(ids, np.int64), np.array([len(ids)]))[0]


def _mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every bit of the result depends on every bit of x."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_samplers: dict[tuple, Sampler] = {}


def _sampler(path: str, theta: float) -> Sampler:
    if (path, theta) not in _samplers:
        _samplers[path, theta] = Sampler(path, theta)
    return _samplers[path, theta]


def encode(docs: DataFrame, keep: list[str] = ("doc_id",), model: str | None = None, theta: float = THETA,
           seed: int = 0) -> DataFrame:
    """The ``keep`` columns of every document and ``ids`` (array<int>), its sampled pieces.

    The draw is seeded by ``seed`` and doc_id (NULL as the empty text); equal
    texts of one doc_id get equal pieces. NULL and empty texts give []. Texts are
    read whole; batches are cut by bytes, so a task's memory follows the longest
    text, not the number of rows.
    """
    path = model or public_tokenizers.path(MODEL)
    keep = [c for c in keep if c != "ids"]
    fields = [docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(path, theta)
        for b in rebatched(batches, "_text", 1 << 19):
            seeds = b.column("_seed").to_numpy().view(np.uint64)
            ids, n = sampler.encode(b.column("_text").to_pylist(), seeds)
            offsets = pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
            yield pa.record_batch([*(b.column(c) for c in keep), lists], names=[*keep, "ids"])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.xxhash64(id_text("doc_id"), F.lit(seed)).alias("_seed"),
                       F.coalesce("text", F.lit("")).alias("_text"))
    return rows.mapInArrow(lambda it: trimmed(run(it)), T.StructType(fields))


def decode(encoded: DataFrame, model: str | None = None, theta: float = THETA) -> DataFrame:
    """``encoded`` with ``text``: the original text of each ``ids`` array ('' for [])."""
    path = model or public_tokenizers.path(MODEL)
    keep = [c for c in encoded.columns if c != "text"]
    fields = [encoded.schema[c] for c in keep] + [T.StructField("text", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = _sampler(path, theta)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                ids = part.column("ids")
                counts = pa.compute.fill_null(pa.compute.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
                texts = sampler.vocabulary.spell(ids.flatten().to_numpy(zero_copy_only=False), counts)
                yield pa.record_batch([*(part.column(c) for c in keep), pa.array(texts, pa.string())],
                                      names=[*keep, "text"])

    return encoded.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(lambda it: trimmed(run(it)), T.StructType(fields))
