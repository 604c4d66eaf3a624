"""Token-ID output: grammar-compressed binary blocks with random access.

Documents are dealt into ascending doc_id ranges, encoded, ended with an end id
and packed into blocks of about ``BLOCK_IDS`` ids. Each block is compressed by
Re-Pair: frequent neighbouring pairs of ids are replaced by nonterminals, round
after round until none is left, and the rules are stored with the length each expands
to. No rule
spans two documents, so a document is a slice of the block's symbols and can be
decoded alone; expansion lengths find any token range inside it.

Block layout, little-endian (counts first, then arrays in this order):

    8 bytes  magic b"RPAIR01\\n"
    u32 x 4  n_docs, n_rules, base (first nonterminal), symbol width in bytes (2 or 4)
    u64 x 2  n_symbols, n_ids
    i64      doc_id        [n_docs]       0 where absent
    u8       doc_id known  [n_docs]
    u64      symbol start  [n_docs + 1]   of each document
    u64      id start      [n_docs + 1]   of each document inside the block
    u32      left, right   [n_rules] each
    u32      length        [n_rules]      ids that a rule expands to
    u16/u32  symbols       [n_symbols]

Blocks are rows (part, block, n_docs, n_ids, payload) of a Parquet table, so any
store that Spark writes to can hold them. Order: part, then block.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import count, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from estuary.llm.common import rebatched, scratch

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 1_000_000
PER_ROUND, MIN_COUNT = 512, 16  # Re-Pair: rules of the first round, least count of a pair
CACHE_WORDS = 600_000
MAGIC = b"RPAIR01\n"
_HEAD = struct.Struct("<8s4I2Q")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 18
_SEPARATOR = "\u241e".encode()
# A word of Latin-1 letters, perhaps with ASCII punctuation after it: two pre-tokens at most.
_PLAIN = re.compile(rb"((?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([!-&(-/:;=?@\[-`{}~]{0,4})")
_TAILS = 10_000  # tails whose ids are kept
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


# ---- encoding -----------------------------------------------------------------------------

class WordEncoder:
    """Ids of whole texts through a bounded table of words.

    The tokenizer drops white space and never joins characters across it, so a
    text's ids are those of its space-separated words. ASCII letters are
    lower-cased here as the tokenizer would (not in texts that may hold a special
    token). The table keeps the first ``cache`` words it meets, which hold nearly
    all of the frequent ones; other words are encoded where they occur.
    Word 0 of the table is the end id.
    """

    def __init__(self, path: str, end_id: int = END_ID, cache: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.end_id, self.cache = Tokenizer.from_file(path), end_id, cache
        self.known: dict[bytes, int] = {b"": 0}
        self.flat, self.start = array("I", [end_id]), array("q", [0, 1])
        self.model, self.mapped = self.tokenizer.model, self._plain_map()
        self.tails: dict[bytes, list[int]] = {b"": []}

    def _plain_map(self) -> dict[int, str] | None:
        """Characters that the model knows the bytes of plain words by, or None if this
        tokenizer does not cut such a word into its letters and its punctuation."""
        t = self.tokenizer
        letters = bytes(range(97, 123)).decode() + "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
        tail = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
        word = letters + tail
        if t.pre_tokenizer is None or (t.normalizer and any(
                t.normalizer.normalize_str(w) != word for w in (word, letters.upper().replace("SS", "ß") + tail))):
            return None
        if any(_PLAIN.fullmatch(a.content.lower().encode()) for a in t.get_added_tokens_decoder().values()):
            return None
        cut = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(word)]
        raw = letters.encode()
        return dict(zip(raw, cut[0])) if len(cut) == 2 and cut[1] == tail and len(cut[0]) == len(raw) else None

    def _model_ids(self, stem: bytes) -> list[int]:
        text = stem.decode()
        if not text.isascii():
            text = text.lower().encode().decode("latin-1").translate(self.mapped)
        return [t.id for t in self.model.tokenize(text)]

    def _learn(self, words: list[bytes]) -> dict[bytes, int]:
        """Numbers of words that are not in the table; they are appended to it.

        Letters and punctuation of a plain word go straight to the model, letters that
        are a word of the table are copied from there; other words go through the
        whole tokenizer.
        """
        if self.mapped is None:
            return self._learn_whole(words)
        whole, plain, stems = [], [], {}
        first, known, flat, start = len(self.start) - 1, self.known, self.flat, self.start
        for w, m in zip(words, map(_PLAIN.fullmatch, words)):
            if m is None:
                whole.append(w)
                continue
            stem, tail = m.groups()
            k = known.get(stem, -1)
            if k >= 0:
                flat += flat[start[k]:start[k + 1]]
            else:
                ids = stems.get(stem)
                if ids is None:
                    ids = stems[stem] = self._model_ids(stem)
                flat.extend(ids)
            if tail:
                ids = self.tails.get(tail)
                if ids is None:
                    ids = self._model_ids(tail)
                    if len(self.tails) < _TAILS:
                        self.tails[tail] = ids
                flat.extend(ids)
            start.append(len(flat))
            plain.append(w)
        new = dict(zip(plain, range(first, first + len(plain))))
        return new | self._learn_whole(whole) if whole else new

    def _learn_whole(self, words: list[bytes]) -> dict[bytes, int]:
        """Numbers of words, encoded in one call with a separator word between them
        whose ids no other text without its character can give. A word that holds
        this character is encoded alone."""
        first = len(self.start) - 1
        odd = [w for w in words if _SEPARATOR in w]
        words = [w for w in words if _SEPARATOR not in w] if odd else words
        if words:
            sep = _SEPARATOR.decode()
            text = f" {sep} ".join([b"\n".join(words).decode().replace("\n", f" {sep} "), ""])
            ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            mark = np.array(self.tokenizer.encode(sep, add_special_tokens=False).ids, np.uint32)
            m = len(mark)
            hit = np.ones(len(ids) - m + 1, bool)
            for k in range(m):
                hit &= ids[k:len(ids) - m + 1 + k] == mark[k]
            at = np.flatnonzero(hit)
            drop = np.ones(len(ids), bool)
            for k in range(m):
                drop[at + k] = False
            ends = at - m * np.arange(len(at))  # without the separators before
            self.start.frombytes((len(self.flat) + ends).astype(np.int64).tobytes())
            self.flat.frombytes(ids[drop].tobytes())
        for w in odd:
            self.flat.extend(self.tokenizer.encode(w.decode(), add_special_tokens=False).ids)
            self.start.append(len(self.flat))
        return dict(zip([*words, *odd], range(first, first + len(words) + len(odd))))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), each text followed by the end id, and the ids per text."""
        if not texts:
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        words: list[bytes] = []  # of all texts, an empty word (number 0) after each text
        counts = []
        for t in texts:
            raw = (t or "").encode()
            own = (raw if b"<|" in raw else raw.translate(_LOWER)).split()
            words += own
            words.append(b"")
            counts.append(len(own) + 1)
        which = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        kept = len(self.start)
        holes = np.flatnonzero(which < 0).tolist()
        if holes:
            missing = [words[i] for i in holes]
            new = self._learn(list(dict.fromkeys(missing)))
            which[holes] = np.fromiter(map(new.__getitem__, missing), np.int64, len(missing))
            if len(self.known) < self.cache:
                self.known |= new
                kept = len(self.start)
        start, flat = np.frombuffer(self.start, np.int64), np.frombuffer(self.flat, np.uint32)  # no copies
        n = (start[1:] - start[:-1])[which]
        ends = np.cumsum(n)
        ids = flat[np.repeat(start[which] - (ends - n), n) + np.arange(ends[-1])]
        del start, flat  # an array that is looked at keeps its size
        del self.start[kept:]
        del self.flat[self.start[-1]:]
        return ids, np.add.reduceat(n, np.concatenate(([0], np.cumsum(counts)[:-1])))


_encoders: dict[tuple, WordEncoder] = {}


def _encoder(path: str, end_id: int) -> WordEncoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = WordEncoder(path, end_id)
    return _encoders[path, end_id]


# ---- Re-Pair --------------------------------------------------------------------------------

def compress(ids: np.ndarray, closes: np.ndarray, base: int, rounds: int | None = None, per_round: int = PER_ROUND,
             min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, rules (n, 2), expansion lengths). ``closes[i]`` marks the last id
    of a document: no pair starts there. A round replaces the most frequent pairs
    (``per_round`` in the first, then twice as many as the round before); where two
    chosen pairs overlap, the more frequent one wins. Rounds go on until no pair is
    left that occurs ``min_count`` times, or for ``rounds`` rounds."""
    seq = ids.astype(np.uint32)
    flags = closes.astype(np.uint8) | np.uint8(2)  # 1: closes a document, 2: its pair may occur min_count times
    flags[-1:] |= 1
    made: dict[int, int] = {}  # pair -> nonterminal
    for done in count() if rounds is None else range(rounds):
        where = np.flatnonzero(flags == 2)
        code = (seq[where].astype(np.uint64) << np.uint64(32)) | seq[where + 1]
        slot = ((code * _MIX) >> np.uint64(64 - _SLOT_BITS)).astype(np.intp)
        counts = np.bincount(slot, minlength=1 << _SLOT_BITS)
        often = (counts >= min_count)[slot]  # other pairs never become frequent again
        flags[where[np.flatnonzero(~often)]] = 0
        if not often.any():
            break
        limit, full = per_round << min(done, _SLOT_BITS), counts[counts >= min_count]
        least = np.partition(full, -limit)[-limit] if len(full) > limit else min_count
        look = np.flatnonzero((counts >= least)[slot] if least > min_count else often)
        at = where[look]
        pairs, back, n = _distinct(code[look], slot[look])
        flags[at[n[back] < min_count]] = 0
        by_count = np.argsort(-n, kind="stable")
        by_count = by_count[n[by_count] >= min_count][:limit]
        rank = np.full(len(pairs), -1, np.int64)
        rank[by_count] = np.arange(len(by_count))
        r = rank[back]
        chosen = np.flatnonzero(r >= 0)
        at, r = at[chosen], r[chosen]
        # a run of one repeated id: every other position
        same = np.concatenate(([False], (np.diff(at) == 1) & (r[1:] == r[:-1])))[:len(at)]
        offset = np.arange(len(at)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(at))))
        even = np.flatnonzero(offset & 1 == 0)
        at, r = at[even], r[even]
        touch = np.diff(at) == 1
        beaten = np.zeros(len(at), bool)
        beaten[1:] |= touch & (r[1:] > r[:-1])
        beaten[:-1] |= touch & (r[:-1] > r[1:])
        won = np.flatnonzero(~beaten)
        at, r = at[won], r[won]
        # a pair that lost most of its places waits; the most frequent one loses none
        enough = np.bincount(r, minlength=len(by_count)) >= max(min_count // 2, 1)
        used, kept = np.flatnonzero(enough), np.flatnonzero(enough[r])
        at, r = at[kept], (np.cumsum(enough) - 1)[r[kept]]
        symbols = [made.setdefault(c, base + len(made)) for c in pairs[by_count[used]].tolist()]
        seq[at] = np.array(symbols, np.uint32)[r]
        flags[at] = flags[at + 1] | 2
        flags[at[at > 0] - 1] |= 2
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, flags = seq[keep], flags[keep]
    codes = np.array(list(made), np.uint64)
    table = np.stack((codes >> np.uint64(32), codes & np.uint64(0xFFFFFFFF)), 1).astype(np.uint32)
    return seq, table, rule_lengths(table, base)


def _distinct(code: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes in ascending order, the place of each code among them and its count.
    Only codes that share a slot with another one are sorted place by place."""
    first, seen = np.zeros(1 << _SLOT_BITS, np.uint64), np.zeros(1 << _SLOT_BITS, bool)
    first[slot], seen[slot] = code, True
    slots = np.flatnonzero(seen)
    number = np.zeros(1 << _SLOT_BITS, np.intp)
    number[slots] = np.arange(len(slots))
    back = number[slot]
    other = np.flatnonzero(first[slot] != code)
    more, place = np.unique(code[other], return_inverse=True)
    back[other] = len(slots) + place
    codes = np.concatenate((first[slots], more))
    order = np.argsort(codes)
    rank = np.empty(len(order), np.intp)
    rank[order] = np.arange(len(order))
    back = rank[back]
    return codes[order], back, np.bincount(back, minlength=len(codes))


def rule_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Ids that each rule expands to; a rule refers to earlier rules only."""
    side = rules.astype(np.int64) - base
    made, side, out = side >= 0, np.maximum(side, 0), np.zeros(len(rules), np.int64)
    todo = np.arange(len(rules))
    while len(todo):  # rules whose two sides are known, as often as rules are nested
        n = np.where(made[todo], out[side[todo]], 1)
        ready = (n > 0).all(1)
        out[todo[ready]] = n[ready].sum(1)
        todo = todo[~ready]
    return out.astype(np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    start = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
    flat = np.empty(int(start[-1]), np.uint32)  # the ids of every rule, one after the other
    side = rules.astype(np.int64)
    size = np.where(side < base, 1, lengths[np.maximum(side - base, 0)].astype(np.int64)) if len(side) else side
    todo, done = np.arange(len(side)), np.zeros(len(side), bool)
    while len(todo):  # rules whose two sides are there, as often as rules are nested
        own = side[todo] - base
        ready = ((own < 0) | done[np.maximum(own, 0)]).all(1)
        now, todo = todo[ready], todo[~ready]
        for k, at in ((0, start[now]), (1, start[now] + size[now, 0])):
            s = side[now, k]
            flat[at[s < base]] = s[s < base]
            at, m, s = at[s >= base], size[now, k][s >= base], s[s >= base] - base
            _copy(flat, at, flat, start[s], m)
        done[now] = True
    sym = symbols.astype(np.int64)
    is_rule = sym >= base
    n, at = np.ones(len(sym), np.int64), len(flat) + np.arange(len(sym))  # an id of its own follows the rules' ids
    n[is_rule], at[is_rule] = lengths[sym[is_rule] - base], start[sym[is_rule] - base]
    total = int(n.sum())
    return np.concatenate((flat, symbols.astype(np.uint32)))[np.repeat(at - (np.cumsum(n) - n), n) + np.arange(total)]


def _copy(to: np.ndarray, at: np.ndarray, source: np.ndarray, start: np.ndarray, n: np.ndarray) -> None:
    """``to[at[i]:at[i] + n[i]] = source[start[i]:start[i] + n[i]]`` for every i."""
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    to[np.repeat(at, n) + step] = source[np.repeat(start, n) + step]


# ---- blocks -----------------------------------------------------------------------------------

def pack(doc_ids: list[int | None], ids: np.ndarray, per_doc: np.ndarray, base: int) -> bytes:
    id_start = np.concatenate(([0], np.cumsum(per_doc))).astype(np.uint64)
    closes = np.zeros(len(ids), bool)
    closes[id_start[1:].astype(np.int64) - 1] = True
    symbols, rules, lengths = compress(ids, closes, base)
    n = np.ones(len(symbols), np.int64)
    n[symbols >= base] = lengths[symbols[symbols >= base].astype(np.int64) - base]
    symbol_start = np.searchsorted(np.concatenate(([0], np.cumsum(n))), id_start.astype(np.int64)).astype(np.uint64)
    width = 2 if base + len(rules) <= 1 << 16 else 4
    known = np.array([d is not None for d in doc_ids], np.uint8)
    head = _HEAD.pack(MAGIC, len(doc_ids), len(rules), base, width, len(symbols), len(ids))
    parts = (np.array([d or 0 for d in doc_ids], "<i8"), known, symbol_start.astype("<u8"), id_start.astype("<u8"),
             rules[:, 0].astype("<u4"), rules[:, 1].astype("<u4"), lengths.astype("<u4"), symbols.astype(f"<u{width}"))
    return head + b"".join(p.tobytes() for p in parts)


class Block:
    """Reader of one packed block."""

    def __init__(self, payload: bytes):
        magic, self.n_docs, n_rules, self.base, width, n_symbols, self.n_ids = _HEAD.unpack_from(payload)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = _HEAD.size

        def take(kind, n):
            nonlocal at
            out = np.frombuffer(payload, kind, n, at)
            at += out.nbytes
            return out

        ids, known = take("<i8", self.n_docs), take("u1", self.n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, known)]
        self.symbol_start, self.id_start = take("<u8", self.n_docs + 1), take("<u8", self.n_docs + 1)
        left, right = take("<u4", n_rules), take("<u4", n_rules)
        self.rules, self.lengths = np.stack((left, right), 1), take("<u4", n_rules)
        self.symbols = take(f"<u{width}", n_symbols)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        return expand(symbols, self.rules, self.lengths, self.base)

    def all_ids(self) -> np.ndarray:
        return self._expand(self.symbols)

    def document(self, i: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the ``i``-th document. Only the symbols that
        cover the range are expanded; they are found by their expansion lengths."""
        sym = self.symbols[int(self.symbol_start[i]):int(self.symbol_start[i + 1])].astype(np.int64)
        n = np.ones(len(sym), np.int64)
        n[sym >= self.base] = self.lengths[sym[sym >= self.base] - self.base]
        ends = np.cumsum(n)
        start, stop, _ = slice(start, stop).indices(int(ends[-1]))
        if start >= stop:
            return np.empty(0, np.uint32)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        skipped = int(ends[a] - n[a])
        return self._expand(sym[a:b].astype(np.uint32))[start - skipped:stop - skipped]


# ---- Spark ------------------------------------------------------------------------------------

_BLOCKS = "part int, block bigint, n_docs bigint, n_ids bigint, payload binary"


def _encode_blocks(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder = _encoder(path, end_id)
    base = max(encoder.tokenizer.get_vocab_size(with_added_tokens=True), end_id + 1)
    part, n_block = TaskContext.get().partitionId(), 0
    docs, ids, per, held = [], [], [], 0

    def flush():
        nonlocal docs, ids, per, held, n_block
        payload = pack(docs, np.concatenate(ids), np.concatenate(per), base)
        row = pa.record_batch([pa.array([part], pa.int32()), pa.array([n_block]), pa.array([len(docs)]),
                               pa.array([held]), pa.array([payload], pa.binary())],
                              names=["part", "block", "n_docs", "n_ids", "payload"])
        docs, ids, per, held, n_block = [], [], [], 0, n_block + 1
        return row

    for b in rebatched(batches, "text", 1 << 20):
        new, n = encoder.encode(b.column("text").to_pylist())
        docs += b.column("doc_id").to_pylist()
        ids.append(new)
        per.append(n)
        held += len(new)
        if held >= BLOCK_IDS:
            yield flush()
    if docs:
        yield flush()


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID) -> str:
    """Encode every text (NULL: empty) and write the blocks below ``path``, in
    ascending doc_id order (NULL first; equal ids by text hash, so a hot id is
    split over ranges). Returns ``path``."""
    model = tokenizer or public_tokenizers.path(TOKENIZER)
    tie = F.xxhash64("text")
    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                        tie.alias("tie"))
            .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("tie").asc())
            .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie"))
    rows.mapInArrow(lambda it: _encode_blocks(it, model, end_id), _BLOCKS).write.mode("error").parquet(path)
    return path


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, block, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            k = Block(payload.as_buffer().to_pybytes())
            raw = memoryview(k.all_ids().astype("<u4").tobytes())
            at = (4 * k.id_start.astype(np.int64)).tolist()
            crc = [zlib.crc32(raw[s:e]) for s, e in zip(at, at[1:])]
            n = np.diff(k.id_start.astype(np.int64))
            yield pa.record_batch(
                [pa.array([part] * k.n_docs, pa.int32()), pa.array([block] * k.n_docs, pa.int64()),
                 pa.array(k.doc_ids, pa.int64()), pa.array(k.id_start[:-1].astype(np.int64)), pa.array(n),
                 pa.array(crc, pa.int64())], names=["part", "block", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_digests(blocks: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 of
    every document, decoded from the blocks.

    Block offsets come from their id counts in two levels (parts, blocks of a
    part); they meet the narrow decoded rows, the payloads are not shuffled.
    """
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_p"))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.withColumn("_b", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part")
               .select("part", "block", (F.col("_p") + F.col("_b")).alias("_off")))
    rows = blocks.select("part", "block", "payload").mapInArrow(
        _decode, "part int, block bigint, doc_id bigint, at bigint, n_tokens bigint, ids_crc32 bigint")
    return rows.join(offsets, ["part", "block"]).select(
        "doc_id", (F.col("_off") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def token_digests(docs: DataFrame, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the token store of ``docs`` to the shared scratch folder and read it back."""
    spark = docs.sparkSession
    path = write_tokens(docs, scratch(spark, "tokens"), tokenizer, end_id)
    return read_digests(spark.read.schema(_BLOCKS).parquet(path))
