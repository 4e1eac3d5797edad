"""Byte-pair encoding and decoding as bounded-lookahead streams.

``Encoder`` reads a byte-level vocabulary of the ``tokenizers`` library. The merge
list has a sufficient lookahead: so many bytes behind a token decide whether it is
final. A piece of text goes through a window of bounded size; tokens that end before
the lookahead are emitted, the rest of the window is encoded again with what follows.
Encoding can go on from a token's end, because every part of a merge result between
two of its tokens is the merge result of its own bytes. Merges never cross the end of a
piece, so there everything is stable: pieces shorter than the lookahead, which is nearly
all of them, need no window. A text is read in blocks that end between words, and its
ids leave block by block; the new pieces of some blocks are merged together. ``Decoder`` turns ids to text
as they come, through the bytes of a character that is not complete yet.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
from collections.abc import Callable, Collection, Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import regex
from pyspark.sql import DataFrame

from .arrow import map_rows

#: Fixed value: how byte-level vocabularies split text before merging.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: White space never stands inside a piece, so runs between it are encoded alone.
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
RUNS = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Up to such a place, no run goes on behind it.
BREAK = re.compile(f"[^{SPACE}](?=[{SPACE}])")
#: Encoded strings of a generation of memory, characters of a string that is kept.
KEPT, KEPT_CHARS = 150_000, 48
#: Characters of a block, as far as there is a break between words, and of the blocks whose
#: new pieces are merged together.
BLOCK, GROUP = 1 << 16, 1 << 20
#: Texts handed over at once, so that groups fill up.
TEXTS = 512
#: Bytes of a piece that is merged with others of its length, in one matrix.
TOGETHER = (4, 8, 12, 16, 24, 32)
#: Windows up to so many bytes are scanned for the next merge.
SCANNED = 48
#: Ids decoded at once.
IDS = 8192


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes.

    Printable Latin-1 characters stand for themselves, the other bytes follow from
    256 on in their order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def sufficient_lookahead(merges: list[tuple[int, int]], made: list[int], size: list[int]) -> int:
    """Bytes behind a token's end that decide whether a merge takes it.

    A merge (u, v) needs the bytes of v, and v must not lose its right end to a merge
    that comes earlier; such a merge starts with v or with one of the tokens down
    v's right side. So in the order of the list a merge needs the length of v and
    the most that an earlier merge starting there needs.
    """
    right: dict[int, int] = {}
    needs: dict[int, int] = {}
    most = 0
    for (u, v), token in zip(merges, made, strict=True):
        behind, end = 0, v
        while end is not None:
            behind = max(behind, needs.get(end, 0))
            end = right.get(end)
        need = size[v] + behind
        needs[u] = max(needs.get(u, 0), need)
        right.setdefault(token, v)
        most = max(most, need)
    return most


class Ranks:
    """The place of a pair of ids in the list of merges, for many pairs at once.

    A table with open addressing: a pair lies at its hash or right behind it.
    """

    BITS = 19

    def __init__(self, rank: dict[tuple[int, int], int], none: int):
        self.none, self.mask = none, (1 << self.BITS) - 1
        while len(rank) * 4 > self.mask:
            self.BITS += 1
            self.mask = (1 << self.BITS) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.ranks = np.full(self.mask + 1, none, dtype=np.int32)
        pairs = np.array(list(rank), dtype=np.int64).reshape(-1, 2)
        keys, ranks = pairs[:, 0] << 32 | pairs[:, 1], np.array(list(rank.values()), dtype=np.int32)
        at = self.start(keys)
        while len(keys):
            # Of pairs that ask for the same free place, one gets it.
            free = self.keys[at] < 0
            self.keys[at[free]] = keys[free]
            there = self.keys[at] == keys
            self.ranks[at[there]] = ranks[there]
            keys, ranks, at = keys[~there], ranks[~there], at[~there] + 1 & self.mask

    def start(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        at = self.start(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.ranks[at], self.none)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        while len(open_):
            at[open_] = at[open_] + 1 & self.mask
            there = self.keys[at[open_]]
            hit = there == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return out


class Encoder:
    """Text to ids, as ``Tokenizer.encode(text, add_special_tokens=False)``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes: dict[int, bytes] = {
            i: bytes(map(letters.__getitem__, token)) for token, i in vocab.items()
        } | {i: token.encode() for token, i in self.special.items()}
        self.byte_id = [0] * 256
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(vocab[a], vocab[b]) for a, b in pairs]
        made = [vocab[a + b] for a, b in pairs]
        self.rank: dict[tuple[int, int], int] = {}
        for rank, pair in enumerate(merges):
            self.rank.setdefault(pair, rank)
        self.made = made
        self.ranks, self.made_by = Ranks(self.rank, len(made)), np.array([*made, -1], dtype=np.int32)
        self.letters = np.array(self.byte_id, dtype=np.int32)
        size = [0] * (max(self.bytes) + 1)
        for i, b in self.bytes.items():
            size[i] = len(b)
        self.size = size
        self.lookahead = sufficient_lookahead(merges, made, size)
        self.window = 2 * (self.lookahead + max(size))
        self.split = regex.compile(PATTERN)
        self.specials = (
            regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
            if self.special
            else None
        )
        self.pieces, self.runs = Memory(self.piece), Memory(self.run)
        #: Tokens that streams emitted before the end of their piece.
        self.early = 0

    def merged(self, data: bytes) -> list[int]:
        """All merges of a window: the first of the list that applies, again and again."""
        rank, made, none = self.rank, self.made, len(self.made)
        ids = [self.byte_id[b] for b in data]
        if len(ids) > SCANNED:
            return self.merged_by_heap(ids)
        ranks = [rank.get(p, none) for p in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            ids[i] = made[best]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), none)
        return ids

    def merged_by_heap(self, ids: list[int]) -> list[int]:
        """The same for long windows, where scanning for the first merge is slow."""
        rank, made, n = self.rank, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has gone into another merge
            ids[i], ids[j] = made[best], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (p := (ids[i], ids[k])) in rank:
                    heapq.heappush(heap, (rank[p], i, *p))
            if (h := before[i]) >= 0 and (p := (ids[h], ids[i])) in rank:
                heapq.heappush(heap, (rank[p], h, *p))
        return [i for i in ids if i >= 0]

    def merged_together(self, pieces: list[bytes], width: int) -> list[bytes]:
        """``merged`` for many pieces of up to ``width`` bytes, a merge of each per turn."""
        none = self.ranks.none
        n = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        data = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), dtype=np.uint8)
        column = np.arange(width)
        ids = np.where(column < n[:, None], self.letters[data.reshape(-1, width)], -1)
        ids = np.concatenate((ids, np.full((len(n), 1), -1)), axis=1).astype(np.int32)
        pair = self.ranks.of(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(-1, width)
        out, rows = np.empty_like(ids), np.arange(len(n))
        while len(rows):
            best = pair.argmin(axis=1)
            every = np.arange(len(rows))
            rank = pair[every, best]
            going = rank < none
            out[rows[~going]] = ids[~going]
            rows, ids, pair, best, rank = (x[going] for x in (rows, ids, pair, best, rank))
            every = every[: len(rows)]
            ids[every, best] = self.made_by[rank]
            behind = column + (column > best[:, None])
            ids[:, :-1] = np.take_along_axis(ids, behind, axis=1)
            moved = np.minimum(behind, width - 1)
            pair = np.take_along_axis(pair, moved, axis=1)
            pair[:, -1] = none
            pair[every, best] = self.ranks.of(ids[every, best], ids[every, best + 1])
            inner = np.flatnonzero(best)
            left = best[inner] - 1
            pair[inner, left] = self.ranks.of(ids[inner, left], ids[inner, left + 1])
        held = out >= 0
        ends = np.concatenate(([0], np.cumsum(held.sum(axis=1)) * 4)).tolist()
        flat = out[held].astype("<u4").tobytes()
        return [flat[a:z] for a, z in zip(ends, ends[1:])]

    def stream(self, data: Iterable[bytes]) -> Iterator[int]:
        """The ids of one piece that comes in parts; a token is emitted once stable."""
        held = b""
        for part in data:
            for start in range(0, len(part), self.window):
                held += part[start : start + self.window]
                if len(held) < self.window:
                    continue
                end = 0
                for token in self.merged(held):
                    if end + self.size[token] + self.lookahead > len(held):
                        break
                    end += self.size[token]
                    self.early += 1
                    yield token
                held = held[end:]
        yield from self.merged(held)

    def piece(self, text: str) -> bytes:
        if len(text) < self.window // 4:
            return packed(self.merged(text.encode()))
        step = self.window // 4
        return packed(self.stream(text[i : i + step].encode() for i in range(0, len(text), step)))

    def run(self, text: str) -> bytes:
        if len(text) > KEPT_CHARS:
            return b"".join([self.pieces[m[0]] for m in self.split.finditer(text)])
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))

    def learn(self, runs: set[str]) -> None:
        """Encode the short runs that are not known yet, their new pieces together."""
        new = [m for m in self.runs.unknown(runs) if len(m) <= KEPT_CHARS]
        split = list(map(self.split.findall, new))
        sized: list[list[str]] = [[] for _ in range(TOGETHER[-1] + 1)]
        for p in self.pieces.unknown(set(chain.from_iterable(split))):
            n = len(p) if p.isascii() else len(p.encode())
            if n <= TOGETHER[-1]:
                sized[n].append(p)
        least = 0
        for width in TOGETHER:
            some = [p for group in sized[least : width + 1] for p in group]
            self.pieces.keep(some, self.merged_together([p.encode() for p in some], width))
            least = width + 1
        ids = self.pieces.__getitem__
        self.runs.keep(new, [b"".join(map(ids, parts)) for parts in split])

    def parts(self, text: str) -> Iterator[list[str] | bytes]:
        """The runs of a text, a block of whole runs at a time, and its special tokens."""
        start = 0
        specials = self.specials.finditer(text) if self.specials else ()
        for found in chain(specials, (None,)):
            end = found.start() if found else len(text)
            while start < end:
                cut = BREAK.search(text, start + BLOCK, end) if end - start > BLOCK else None
                stop = cut.end() if cut else end
                yield RUNS.findall(text, start, stop)
                start = stop
            if found:
                yield packed((self.special[found[0]],))
                start = found.end()

    def encode_many(self, texts: Iterable[str]) -> Iterator[tuple[int, np.ndarray]]:
        """The number of a text and its next ids, in order; no more than a group is held."""
        group: list[tuple[int, list[str] | bytes]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in self.parts(text):
                group.append((i, part))
                size += min(len(text), BLOCK)
                if size >= GROUP:
                    yield from self.encoded(group)
                    group, size = [], 0
        yield from self.encoded(group)

    def encoded(self, group: list[tuple[int, list[str] | bytes]]) -> Iterator[tuple[int, np.ndarray]]:
        self.learn({m for _, part in group if isinstance(part, list) for m in part})
        for i, part in group:
            if isinstance(part, list):
                part = b"".join(map(self.runs.__getitem__, part))
            yield i, np.frombuffer(part, dtype="<u4")

    def encode(self, text: str) -> np.ndarray:
        return np.concatenate([np.zeros(0, dtype="<u4"), *(ids for _, ids in self.encode_many([text]))])


class Memory(dict):
    """What ``make`` returns per short string, of the last two generations of strings.

    A generation that is full becomes the older one, and what is asked for again moves
    from there to the new one; the rest of it goes when that is full in turn.
    """

    def __init__(self, make: Callable[[str], bytes]):
        self.make, self.older = make, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.older.get(text)
        if ids is None:
            ids = self.make(text)
        if len(text) <= KEPT_CHARS:
            self.keep((text,), (ids,))
        return ids

    def unknown(self, texts: set[str]) -> set[str]:
        """Those of which nothing is remembered; older ones among the others become new."""
        new = texts - self.keys()
        again = new & self.older.keys()
        self.keep(again, map(self.older.__getitem__, again))
        return new - again

    def keep(self, texts: Collection[str], ids: Iterable[bytes]) -> None:
        found = list(zip(texts, ids))
        if len(self) + len(found) > KEPT:
            self.older = dict(self)
            self.clear()
        self.update(found)


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, dtype="<u4").tobytes()


class Decoder:
    """Ids to text as they come, as ``Tokenizer.decode(ids, skip_special_tokens=False)``.

    Bytes that form no character become U+FFFD; the state holds at most three bytes.
    """

    def __init__(self, pieces: dict[int, bytes]):
        self.pieces = pieces
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.pieces.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", final=True)


def decoded(ids: np.ndarray | Iterable[np.ndarray], pieces: dict[int, bytes]) -> Iterator[str]:
    """The text of ids, given as one array or as arrays that follow each other."""
    decoder = Decoder(pieces)
    for block in (ids,) if isinstance(ids, np.ndarray) else ids:
        for start in range(0, len(block), IDS):
            yield decoder.feed(block[start : start + IDS].tolist())
    yield decoder.end()


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_column(df: DataFrame, text: str, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``ids array<int>``, the token ids of ``text`` (null: none)."""

    def make():
        e = Encoder(path)

        def rows(texts):
            out = [[] for _ in texts]
            for i, ids in e.encode_many(t or "" for t in texts):
                out[i] += ids.tolist()
            return (out,)

        return rows

    return map_rows(df, keep, [text], "ids array<int>", make, TEXTS)


def decode_column(df: DataFrame, ids: str, path: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``decoded string``, the text of the token ids (null: empty)."""

    def make():
        pieces = Encoder(path).bytes
        return lambda rows: (["".join(decoded(np.array(r or [], "<u4"), pieces)) for r in rows],)

    return map_rows(df, keep, [ids], "decoded string", make)


def token_digests(df: DataFrame, text: str, path: str, keep: list[str]) -> DataFrame:
    """Encode and decode ``text`` and return digests instead of the ids and the text.

    Adds ``n_tokens`` (long), ``ids_sha256`` (of the ids as little-endian unsigned
    32-bit integers) and ``decoded_sha256`` (of the decoded text in UTF-8). A null
    text counts as empty; repeated rows stay; an empty table gives no rows. It maps
    rows without a shuffle, so a lost task is run again and nothing else.
    """

    def make():
        e = Encoder(path)

        def rows(texts):
            texts = [t or "" for t in texts]
            counts, hashes = [0] * len(texts), [hashlib.sha256() for _ in texts]
            back = [hashlib.sha256() for _ in texts]
            found = groupby(e.encode_many(texts), key=itemgetter(0))
            for i, blocks in found:

                def ids():
                    for _, block in blocks:
                        counts[i] += len(block)
                        hashes[i].update(block)
                        yield block

                for part in decoded(ids(), e.bytes):
                    back[i].update(part.encode())
            return counts, [h.hexdigest() for h in hashes], [h.hexdigest() for h in back]

        return rows

    outputs = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(df, keep, [text], outputs, make, TEXTS)

