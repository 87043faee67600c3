"""Byte-level BPE encoding and decoding (operator 8), and the merge engine that other operators share.

Pre-tokens come from :mod:`pretok`; each distinct pre-token is merged once per worker and kept in a bounded cache. New pre-tokens are
merged together: a round joins the pair of least rank of every unfinished one, all in numpy; a long one is merged alone,
with a heap. :class:`Encoder` keeps a value per pre-token in dictionaries; :class:`Lookup` finds ids by the bytes of
pre-tokens, a whole chunk at a time. An encoded text keeps, beside its ids, the byte offset at which each id starts, so that spans of ids map back to the
text; decoding writes the bytes of each id at its offset.

Defined results: a null text counts as empty; an empty text has no ids, the digest of the empty string, and decodes to
no bytes. Each row is encoded by itself: repeated rows and repeated ids give repeated results; a null id stays null.
Very long texts and pre-tokens are encoded whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common, pretok

#: Half the pre-tokens in a worker's cache.
CACHE = 200_000


#: Bytes up to which pre-tokens are merged side by side; longer ones are merged one by one.
LONG = 64
#: Pre-tokens that are merged side by side at once, and bits of a place in one.
BLOCK, PLACE_BITS = 4096, 6
_NONE = 1 << 40
#: Of the table of pairs.
SLOT_BITS = 18
#: Bytes of a pre-token that has a slot in a lookup: two numbers hold them and their count. Bits of a slot.
SHORT, LOOKUP_BITS = 15, 19
#: Pre-tokens that are looked up at once.
PART = 1 << 18


def _slot(pairs: np.ndarray) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOT_BITS)).view(np.int64)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... of each, ``size`` of them."""
    return np.repeat(begin - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


def words(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    return np.array(ids, "<u4").tobytes()


class Vocabulary:
    """Tokens by id, and for each pair of ids that merges, the id it becomes, which is also the pair's priority."""

    def __init__(self, tokens: dict[bytes, int], pairs: dict[int, int], whole: bool):
        """``pairs``: merged id by ``left << 32 | right``; ``whole``: a pre-token that is a token is not merged at all."""
        self.bytes_of = [b""] * (max(tokens.values()) + 1)
        for token, i in tokens.items():
            self.bytes_of[i] = token
        self.size = np.array([len(t) for t in self.bytes_of], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.whole = tokens if whole else {}
        self.pairs = pairs
        self._byte = np.array([tokens[bytes([i])] for i in range(256)], np.int64)
        self._keys = np.array(sorted(pairs), np.int64)
        self._ids = np.array([pairs[k] for k in self._keys.tolist()], np.int64)
        # a pair is at the slot of its hash; of several with one slot one is, and a sorted search finds the others
        slot = _slot(self._keys)
        self._key_at, self._id_at = np.full(1 << SLOT_BITS, -1), np.full(1 << SLOT_BITS, _NONE)
        self._key_at[slot], self._id_at[slot] = self._keys, self._ids
        self._crowded = np.bincount(slot, minlength=1 << SLOT_BITS) > 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 32 | right
        slot = _slot(wanted)
        met = self._key_at[slot] == wanted
        out = np.where(met, self._id_at[slot], _NONE)
        rest = np.flatnonzero(self._crowded[slot] & ~met)
        if len(rest):
            wanted = wanted[rest]
            at = np.minimum(np.searchsorted(self._keys, wanted), len(self._keys) - 1)
            out[rest] = np.where(self._keys[at] == wanted, self._ids[at], _NONE)
        return out

    def merge(self, pieces: list[bytes], make=tuple) -> list:
        """What ``make`` makes of the ids of each pre-token."""
        ids, size = self.merged(pieces)
        ends = np.cumsum(size)
        if make is words:
            own, ends = words(ids), (4 * ends).tolist()
            return [own[a:b] for a, b in zip([0, *ends], ends)]
        own, ends = ids.tolist(), ends.tolist()
        return [make(own[a:b]) for a, b in zip([0, *ends], ends)]

    def merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pre-tokens in order, and how many each has: the adjacent pair of least rank is joined first, the leftmost of equals."""
        length = np.fromiter(map(len, pieces), np.int64, len(pieces))
        alone = {i: (self.whole[piece],) for i, piece in enumerate(pieces) if piece in self.whole} if self.whole else {}
        alone |= {i: self._merge_long(pieces[i]) for i in np.flatnonzero(length > LONG).tolist() if i not in alone}
        length[list(alone)] = 0
        parts = [([i], own, [len(own)]) for i, own in alone.items()]
        for side in (np.flatnonzero((length > 0) & (length <= SHORT)), np.flatnonzero(length > SHORT)):
            for k in range(0, len(side), BLOCK):
                some = side[k : k + BLOCK]
                parts.append((some, *self._merge_side_by_side([pieces[i] for i in some.tolist()])))
        size = np.zeros(len(pieces), np.int64)
        for which, _, n in parts:
            size[which] = n
        begin = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int64)
        for which, ids, n in parts:
            out[ranges(begin[which], np.asarray(n))] = ids
        return out, size

    def _merge_side_by_side(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """A column per pre-token; a joined pair stays at the place of its left id, and ``after`` and ``before`` skip the other's.
        The last row stands for no neighbour; its id is that of no token."""
        n, size = len(pieces), np.array([len(piece) for piece in pieces])
        rows = int(size.max())
        own = ranges(np.zeros(n, np.int64), size) * n + np.repeat(np.arange(n), size)
        ids = np.full((rows + 1) * n, len(self.bytes_of))
        ids[own] = self._byte[np.frombuffer(b"".join(pieces), np.uint8)]
        there = np.zeros(rows * n, bool)
        there[own] = True
        place = np.repeat(np.arange(rows + 1), n)
        after, before = place + 1, np.where(place, place - 1, rows)
        last = (size - 1) * n + np.arange(n)
        after[last] = rows
        order = np.full((rows + 1) * n, _NONE << PLACE_BITS)  # rank of the pair that begins at a place, then the place
        order[own] = self._rank(ids[own], ids[after[own] * n + own % n]) << PLACE_BITS | place[own]
        table = order.reshape(rows + 1, n)
        while True:
            least = table.min(0)
            column = np.flatnonzero(least < _NONE << PLACE_BITS)
            if not len(column):
                return ids[:-n].reshape(rows, n).T[there.reshape(rows, n).T], there.reshape(rows, n).sum(0)
            least = least[column]
            new, left = least >> PLACE_BITS, least & (1 << PLACE_BITS) - 1
            at = left * n + column
            gone = after[at] * n + column
            right = after[gone]
            following, previous = right * n + column, before[at]
            preceding = previous * n + column
            ids[at], there[gone], order[gone] = new, False, _NONE << PLACE_BITS
            after[at], before[following] = right, left
            m = len(column)
            rank = self._rank(np.concatenate([new, ids[preceding]]), np.concatenate([ids[following], new]))
            order[at] = rank[:m] << PLACE_BITS | left
            order[preceding] = rank[m:] << PLACE_BITS | previous

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        ids, pairs = self._byte[np.frombuffer(piece, np.uint8)].tolist(), self.pairs
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := pairs.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            rank, i = heappop(heap)
            j = after[i]
            if ids[i] is None or j >= n or pairs.get(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the pair has been joined with another
            ids[i], ids[j] = rank, None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := pairs.get(rank << 32 | ids[k])) is not None:
                    heappush(heap, (r, i))
            if (h := before[i]) >= 0 and (r := pairs.get(ids[h] << 32 | rank)) is not None:
                heappush(heap, (r, h))
        return tuple(i for i in ids if i is not None)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The bytes of ids that start at ``offsets``."""
        size = self.size[ids]
        return self.flat[np.repeat(self.start[ids] - offsets, size) + np.arange(int(size.sum()))]


@lru_cache(2)
def tiktoken_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file of ranks: any two tokens merge whose bytes together are a token."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    pairs = {a << 32 | b: rank for token, rank in ranks.items() for k in range(1, len(token)) if (a := ranks.get(token[:k])) is not None and (b := ranks.get(token[k:])) is not None}
    return Vocabulary(ranks, pairs, whole=True)


@lru_cache(2)
def json_vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a byte-level BPE .json file, whose merges must be in the order of their ids."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    vocab, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [vocab["".join(m)] for m in merges]
    if any(a >= b for a, b in zip(ids, ids[1:])):
        raise ValueError(f"{path}: the order of the merges differs from the order of the ids")
    pairs = {vocab[a] << 32 | vocab[b]: i for (a, b), i in zip(merges, ids)}
    return Vocabulary({bytes(byte_of[c] for c in token): i for token, i in vocab.items() if all(c in byte_of for c in token)}, pairs, bool(model.get("ignore_merges")))


@lru_cache(2)
def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a .json tokenizer, which the library cuts out of texts before it splits them."""
    with open(path, encoding="utf-8") as file:
        return {x["content"]: x["id"] for x in json.load(file)["added_tokens"]}


@lru_cache(2)
def special_pattern(path: str) -> re.Pattern | None:
    added = added_tokens(path)
    return re.compile("|".join(map(re.escape, sorted(added, key=len, reverse=True)))) if added else None


def begins_of(data: np.ndarray, offsets: np.ndarray, special: re.Pattern | None) -> tuple[str, np.ndarray, np.ndarray, int]:
    """A chunk as one str, where its pre-tokens begin, added tokens among them as one piece each, where its texts do, and its length."""
    text, points, at = common.codepoints(data, offsets)
    if special is None or not special.search(text):
        return text, pretok.starts(points, at), at, len(points)
    spans = [(a + m.start(), a + m.end()) for a, b in zip(at.tolist(), at[1:].tolist()) for m in special.finditer(text[a:b])]
    cuts = np.union1d(at, np.array(spans, np.int64).reshape(-1))
    begin = pretok.starts(points, cuts)
    inside = np.zeros(len(points) + 1, np.int8)
    for a, b in spans:
        inside[a + 1 : b] = 1
    return text, begin[inside[begin] == 0], at, len(points)


def pieces_of(data: np.ndarray, offsets: np.ndarray, special: re.Pattern | None) -> tuple[list[str], np.ndarray]:
    """The pre-tokens of a chunk, added tokens among them as one piece each, and where each text's begin and end."""
    text, begin, at, n = begins_of(data, offsets, special)
    edges = np.append(begin, n).tolist()
    return [text[a:b] for a, b in zip(edges, edges[1:])], np.searchsorted(begin, at)


class Encoder:
    """What is made of the ids of each pre-token of a chunk. Pre-tokens met before come from a cache: ``young`` has those met in
    two chunks or more, ``old`` those met in one and those that ``young`` had before it was full."""

    def __init__(self, vocabulary: Vocabulary, make=tuple, added: dict[str, int] | None = None, special: re.Pattern | None = None):
        self.vocabulary, self.make, self.special = vocabulary, make, special
        self.added = {text: make([i]) for text, i in (added or {}).items()}
        self.young, self.old = dict(self.added), {}

    def pieces(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list, list[int]]:
        """A value per pre-token, and where each text's pre-tokens begin and end."""
        pieces, bounds = pieces_of(data, offsets, self.special)
        young, old = self.young, self.old
        found = list(map(young.get, pieces))
        missing = [i for i, value in enumerate(found) if value is None]
        new = []
        for piece in {pieces[i] for i in missing}:
            if (value := old.get(piece)) is None:
                new.append(piece)
            else:
                young[piece] = value
        made = dict(zip(new, self.vocabulary.merge([piece.encode() for piece in new], self.make)))
        for i in missing:
            piece = pieces[i]
            found[i] = made[piece] if piece in made else young[piece]
        old.update(made)
        if len(young) + len(old) > 2 * CACHE:
            self.young, self.old = (dict(self.added), young) if len(young) > CACHE else (young, {})
        return found, bounds.tolist()

    def texts(self, data: np.ndarray, offsets: np.ndarray):
        """The values of each text of a chunk."""
        found, bounds = self.pieces(data, offsets)
        for a, b in zip(bounds, bounds[1:]):
            yield found[a:b]


_size = np.arange(SHORT + 2)
_LOW = np.array([(1 << 8 * min(k, 8)) - 1 for k in _size.tolist()], np.uint64)
_HIGH = np.array([(1 << 8 * max(k - 8, 0)) - 1 for k in _size.tolist()], np.uint64)
_COUNT = _size.astype(np.uint64) << np.uint64(56)
_LOW[-1] = _HIGH[-1] = 0  # longer ones have no slot


class Lookup:
    """The ids of all texts of a chunk. A pre-token of up to ``SHORT`` bytes is two numbers, its bytes and their count, and is found at the slot of
    their hash if both are equal there. Others are merged and get the slot; one that was found since the slot was last wanted
    keeps it that once. The ids of all slots lie in one array. Longer pre-tokens are kept in a dictionary."""

    def __init__(self, vocabulary: Vocabulary, added: dict[str, int] | None = None, special: re.Pattern | None = None, bits: int = LOOKUP_BITS):
        self.vocabulary, self.special = vocabulary, special
        self.added = {text.encode(): i for text, i in (added or {}).items()}
        self._shift = np.uint64(64 - bits)
        self._low, self._high = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.uint64)
        self._begin, self._n = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
        self._met = np.zeros(1 << bits, bool)
        self._ids, self._used = np.empty(1 << bits, np.uint32), 0
        self._long: dict[bytes, list[int]] = {}

    def _room(self, n: int) -> bool:
        """Makes place for ``n`` ids, if need be by leaving out those that no slot has any more; whether ids were moved."""
        if self._used + n <= len(self._ids) <= 32 * len(self._low):  # more than that is left from a very long pre-token
            return False
        size = self._n.astype(np.int64)
        kept = self._ids[ranges(self._begin.astype(np.int64), size)]
        self._begin[:] = np.cumsum(size) - size
        self._used = len(kept)
        self._ids = np.empty(len(kept) + n + len(self._low), np.uint32)
        self._ids[: len(kept)] = kept
        return True

    def _merged(self, number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their numbers of numbered pre-tokens, which may be added tokens or long ones met before."""
        pieces = list(number)
        known = {number[piece]: [i] for piece, i in self.added.items() if piece in number}
        known |= {number[piece]: own for piece in pieces if len(piece) > SHORT and (own := self._long.get(piece)) is not None}
        rest = [i for i in range(len(pieces)) if i not in known]
        ids, size = self.vocabulary.merged([pieces[i] for i in rest])
        begin = np.cumsum(size) - size
        every = np.empty(len(pieces), np.int64)
        every[rest], every[list(known)] = size, [len(own) for own in known.values()]
        at, out = np.cumsum(every) - every, np.empty(int(every.sum()), np.int64)
        out[ranges(at[rest], size)] = ids
        for i, own in known.items():
            out[at[i] : at[i] + len(own)] = own
        if len(self._long) > CACHE:
            self._long.clear()
        for i, a, n in zip(rest, begin.tolist(), size.tolist()):
            if SHORT < len(pieces[i]) <= LONG:
                self._long[pieces[i]] = ids[a : a + n].tolist()
        return out, every

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a chunk, and where each text's begin and end."""
        begin = begins_of(data, offsets, self.special)[1]
        begin = np.flatnonzero((data & 0xC0) != 0x80)[begin]
        size = np.diff(np.append(begin, len(data)))
        raw = data.tobytes() + bytes(16)
        parts = [self._part(raw, begin[k : k + PART], size[k : k + PART]) for k in range(0, len(begin), PART)]
        n = [np.zeros(1, np.int32), *(n for _, n in parts)]
        bounds = np.cumsum(np.concatenate(n), dtype=np.int64)[np.searchsorted(begin, offsets)]
        return np.concatenate([np.empty(0, np.uint32), *(ids for ids, _ in parts)]), bounds

    def _part(self, raw: bytes, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some pre-tokens, and how many each has. ``raw`` has 16 bytes more."""
        eight = np.ndarray(len(raw) - 7, "<u8", raw, 0, 1)  # the number of the eight bytes from each place on
        width = np.minimum(size, SHORT + 1)
        low, high = eight[begin] & _LOW[width], eight[begin + 8 * (width > 8)] & _HIGH[width] | _COUNT[width]
        slot = ((low ^ high * np.uint64(0xD1342543DE82EF95)) * np.uint64(0x9E3779B97F4A7C15) >> self._shift).view(np.int64)
        found = (self._low[slot] == low) & (self._high[slot] == high)
        self._met[slot[found]] = True
        at, n = self._begin[slot].astype(np.int64), self._n[slot]
        new = np.flatnonzero(~found)
        if len(new):
            pieces = [raw[a:b] for a, b in zip(begin[new].tolist(), (begin[new] + size[new]).tolist())]
            number = {piece: i for i, piece in enumerate(dict.fromkeys(pieces))}
            of = np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
            ids, count = self._merged(number)
            first = np.empty(len(number), np.int64)
            first[of[::-1]] = new[::-1]
            if self._room(len(ids)):
                at = self._begin[slot].astype(np.int64)
            own = self._used + np.cumsum(count) - count
            self._ids[self._used : self._used + len(ids)] = ids
            self._used += len(ids)
            at[new], n[new] = own[of], count[of]
            short = np.flatnonzero(width[first] <= SHORT)
            to = slot[first[short]]
            free = ~self._met[to]
            self._met[to] = False
            to, one = np.unique(to[free], return_index=True)
            short = short[free][one]
            self._low[to], self._high[to] = low[first[short]], high[first[short]]
            self._begin[to], self._n[to] = own[short], count[short]
        return self._ids[ranges(at, n)], n


_kept: dict = {}


def kept(key, make):
    """An encoder that stays in the worker between tasks; one at a time."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


def encoded(enc: Encoder, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids of all texts of a chunk, the byte of the chunk at which each id starts, and where each text's ids begin and end."""
    found, bounds = enc.pieces(data, offsets)
    ids = np.fromiter(chain.from_iterable(found), np.int64)
    size = enc.vocabulary.size[ids]
    places = np.cumsum(size) - size
    return ids, places, np.searchsorted(places, offsets)


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, ``ids`` array<int>, and ``offsets`` array<int>, the byte at which each id starts in the text."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches):
        enc = kept(("ids", path), lambda: Encoder(tiktoken_vocabulary(path)))
        for batch in batches:
            for i, data, offsets in common.text_chunks(batch.column(1)):
                ids, places, bounds = encoded(enc, data, offsets)
                places = places - np.repeat(offsets[:-1], np.diff(bounds))
                at = pa.array(bounds, pa.int32())
                lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (ids, places)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(offsets) - 1), *lists], [id_col, "ids", "offsets"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, offsets array<int>")


def decode(rows: DataFrame, path: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """Per row of ids and offsets: the id and the decoded ``bytes``. Null ids decode to no bytes."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches):
        vocabulary = tiktoken_vocabulary(path)
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            out = [vocabulary.decode(np.array(ids or (), np.int64), np.array(offsets or (), np.int64)).tobytes() for ids, offsets in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], [id_col, "bytes"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, "ids", "offsets").mapInArrow(run, f"`{id_col}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row: number and digest of the ids, and the digest of the bytes that ids and offsets decode to, in one pass over the texts."""
    path = path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

    def run(batches):
        enc = kept(("ids", path), lambda: Encoder(tiktoken_vocabulary(path)))
        written = list(map(str, range(len(enc.vocabulary.bytes_of))))
        sha = hashlib.sha256
        for batch in batches:
            for i, data, offsets in common.text_chunks(batch.column(1)):
                ids, places, bounds = encoded(enc, data, offsets)
                back = enc.vocabulary.decode(ids, places)
                bounds, flat = bounds.tolist(), ids.tolist()
                ends = np.append(places, len(back))[bounds].tolist()
                ids_sha = [sha(",".join(map(written.__getitem__, flat[a:b])).encode()).hexdigest() for a, b in zip(bounds, bounds[1:])]
                decoded_sha = [sha(back[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]
                columns = [batch.column(0).slice(i, len(ids_sha)), pa.array(np.diff(bounds).astype(np.int64)), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
