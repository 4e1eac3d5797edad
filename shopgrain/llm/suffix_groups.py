"""Repeated passages through suffix arrays built by linear grouping.

``suffix_orders`` sorts the suffixes of many texts at once. Suffixes are grouped by
the Lyndon word that starts them: groups are processed from the highest to the lowest,
each sends the suffixes that its members' previous-smaller pointers name to new groups
right behind their own, the more members point to them the further back. A second
pass emits the order inside the groups along the same pointers. No ranks are ever
renamed, and every text advances in step with the others, so each step is an
operation on arrays.

``remove_repeats`` finds bytes covered by a string of ``LENGTH`` bytes that also
starts in a document with a smaller id. Every such string holds an anchor: the
16 bytes with the smallest hash among those in it. Anchors that occur in one text only
are unique and go no further. For the others the strings around an anchor, its
context, meet in one task with all contexts of equal anchors; the suffix order brings
equal strings together, and the smallest id of each run of equal strings decides.
An anchor with very many contexts is crowded: it goes on string by string, each string
dealt out by its own hash, so that no task holds all contexts of a frequent phrase.

Repeats are resolved as early as they show, so that nothing hot is shuffled: an
anchor that two texts of a batch share asks nobody, a context that occurs twice in a
batch asks once, and copies of a whole text are settled by their hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import record_batch, slices

#: Bytes of a repeated string, of an anchor; anchors that a string holds.
LENGTH, ANCHOR = 50, 16
WINDOW = LENGTH - ANCHOR + 1
#: Bytes of text searched for anchors at once.
STEP = 1 << 20
#: Contexts ordered at once by suffixes for one anchor, and sent by one batch; bytes of a
#: batch of texts.
CONTEXTS, BATCH = 48, 1 << 19
#: Rows of contexts held while their anchors are completed, of one anchor at most.
ROWS = 50_000
#: Strings cut at once of crowded anchors.
STRINGS = 1 << 16

LAST = (1 << 63) - 1


# -- suffix orders ------------------------------------------------------------------


class Suffixes:
    """The suffixes of many texts while they are grouped.

    All arrays are flat, a row of ``stride`` cells per text. A text's symbols stand one
    cell to the right, behind a guard that is smaller than all; places in the order
    start at the row's first cell. A group is named by the place where it starts.
    """

    def __init__(self, text: np.ndarray, length: np.ndarray):
        rows, width = text.shape
        self.stride = width + 2
        self.base = np.arange(rows) * self.stride
        self.length = length.astype(np.int64)
        cells = rows * self.stride
        self.group = np.full(cells, -1, dtype=np.int64)
        self.pointer = np.zeros(cells, dtype=np.int64)
        # By place: the suffix there, the size of the group that starts there, the
        # start of the group that ends there. By suffix: its place.
        self.slot = np.zeros(cells, dtype=np.int64)
        self.size = np.zeros(cells, dtype=np.int64)
        self.start_of = np.zeros(cells, dtype=np.int64)
        self.place = np.zeros(cells, dtype=np.int64)
        self.moved = np.zeros(cells, dtype=bool)
        self.first_groups(text)

    def first_groups(self, text: np.ndarray) -> None:
        """Suffixes grouped by their first symbol."""
        row, column = np.nonzero(np.arange(text.shape[1]) < self.length[:, None])
        order = np.lexsort((text[row, column], row))
        row, column = row[order], column[order]
        at = self.base[row] + np.arange(len(row)) - np.repeat(
            np.cumsum(self.length) - self.length, self.length
        )
        suffix = self.base[row] + column + 1
        symbol = text[row, column]
        self.slot[at], self.place[suffix] = suffix, at
        first = np.flatnonzero(
            np.r_[True, (symbol[1:] != symbol[:-1]) | (row[1:] != row[:-1])]
        )
        many = np.diff(np.r_[first, len(row)])
        self.group[suffix] = np.repeat(at[first], many)
        self.size[at[first]] = many
        self.start_of[at[first] + many] = at[first]

    def grouped(self) -> None:
        """Process the groups of all texts from the highest to the lowest."""
        base, end = self.base, self.base + self.length
        while len(end):
            start = self.start_of[end]
            many = end - start
            cells = np.arange(int(many.sum())) + np.repeat(start - np.cumsum(many) + many, many)
            members = np.sort(self.slot[cells])
            found = self.previous_smaller(members, np.repeat(start, many))
            self.pointer[members] = found
            self.move_behind(found)
            going = start > base
            base, end = (base, start) if going.all() else (base[going], start[going])

    def previous_smaller(self, members: np.ndarray, own: np.ndarray) -> np.ndarray:
        """For members of the groups ``own``: the last earlier suffix of a smaller group.

        Suffixes of higher groups are done, so their pointers skip what lies between;
        a member that meets another member of its group takes over what that one finds.
        """
        j = members - 1
        group = self.group[j]
        higher = np.flatnonzero(group > own)
        while len(higher):
            j[higher] = self.pointer[j[higher]]
            group[higher] = self.group[j[higher]]
            higher = higher[group[higher] > own[higher]]
        # Members come in order, so a chain of equals starts at the last that met none.
        first = np.maximum.accumulate(np.where(group == own, 0, np.arange(len(j))))
        return j[first]

    def move_behind(self, found: np.ndarray) -> None:
        """Split the suffixes that were pointed to off their groups.

        Those pointed to most often go last; equally often, they stay together.
        """
        j = found[self.group[found] >= 0]
        if not len(j):
            return
        at = np.flatnonzero(np.r_[True, j[1:] != j[:-1]])
        times = np.diff(np.r_[at, len(j)])
        j = j[at]
        home = self.group[j]
        order = np.lexsort((-times, home))
        j, home, times = j[order], home[order], times[order]
        block = np.r_[True, home[1:] != home[:-1]]
        part = block.copy()
        part[1:] |= times[1:] != times[:-1]
        part_at, block_at = np.flatnonzero(part), np.flatnonzero(block)
        part_size = np.diff(np.r_[part_at, len(j)])
        block_size = np.diff(np.r_[block_at, len(j)])
        of_block = np.cumsum(block) - 1
        behind = part_at + part_size - block_at[of_block[part_at]]
        low = home[block_at]
        high = low + self.size[low]
        starts = high[of_block[part_at]] - behind
        which = np.cumsum(part) - 1
        self.group[j] = starts[which]
        self.exchange(j, starts[which] + np.arange(len(j)) - part_at[which],
                      (high - block_size)[of_block])
        left = self.size[low] - block_size
        self.size[low] = left
        self.size[starts] = part_size
        self.start_of[starts + part_size] = starts
        stay = left > 0
        self.start_of[low[stay] + left[stay]] = low[stay]

    def exchange(self, j: np.ndarray, target: np.ndarray, zone: np.ndarray) -> None:
        """Put suffixes ``j`` at ``target``; who stands there takes a place left free.

        The targets of a group fill its end, from ``zone`` on.
        """
        here = self.place[j]
        self.moved[j] = True
        there = self.slot[target]
        displaced = there[~self.moved[there]]
        self.moved[j] = False
        # Targets are in falling parts, so bring both sides into the order of groups.
        free = here[here < zone]
        free.sort()
        displaced = displaced[np.argsort(self.group[displaced], kind="stable")]
        self.slot[free], self.place[displaced] = displaced, free
        self.slot[target], self.place[j] = j, target

    def emitted(self) -> np.ndarray:
        """The order of all suffixes, place by place, as columns of the texts.

        The suffix before one that has its place comes next in its own group, and so
        do the ones that its pointers lead to, until one has its place already.
        """
        order = np.zeros(len(self.group), dtype=np.int64)
        filled = np.zeros(len(self.group), dtype=np.int64)
        placed = np.zeros(len(self.group), dtype=bool)
        placed[self.base] = True
        last = self.base + self.length
        order[self.base] = last
        placed[last] = True
        filled[self.base] = 1
        by_length = np.argsort(-self.length, kind="stable")
        base, falling = self.base[by_length], -self.length[by_length]
        for i in range(int(self.length.max(initial=0))):
            live = int(np.searchsorted(falling, -i))
            j = order[base[:live] + i] - 1
            j = j[~placed[j]]
            while len(j):
                group = self.group[j]
                order[group + filled[group]] = j
                filled[group] += 1
                placed[j] = True
                j = self.pointer[j]
                j = j[~placed[j]]
        columns = order.reshape(-1, self.stride)[:, :-2] - self.base[:, None] - 1
        return columns


def suffix_orders(text: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The suffix array of each row of ``text``, in its first ``length`` columns.

    Row r is a text of ``length[r]`` symbols that ends with a symbol smaller than all
    others in it; columns beyond are not looked at.
    """
    suffixes = Suffixes(text, length)
    suffixes.grouped()
    return suffixes.emitted()


# -- anchors --------------------------------------------------------------------------


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the anchor-sized string at each place of ``data``."""
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,)).copy()
    h = words[:-8] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += words[8:]
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def anchors(
    data: np.ndarray, start: np.ndarray, stop: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the texts ``data[start:stop]``: text, place, strings before, strings, hash.

    A string of ``LENGTH`` bytes belongs to the first of its smallest hashes. Strings
    that share an anchor start at ``place - before`` and follow each other.
    """
    counts = np.maximum(stop - start - LENGTH + 1, 0)
    if not counts.sum():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none.astype(np.uint64)
    hashes = gram_hashes(data)
    least = (hashes & ~np.uint64(0xFFFFFFFF)) | np.arange(len(hashes), dtype=np.uint64)
    reach = 1
    while reach * 2 <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < WINDOW:
        rest = WINDOW - reach
        least = np.minimum(least[:-rest], least[rest:])
    text = np.repeat(np.arange(len(start)), counts)
    before = np.cumsum(counts) - counts
    string = np.arange(len(text)) + np.repeat(start - before, counts)
    place = (least[string] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (text[1:] != text[:-1])])
    strings = np.diff(np.r_[first, len(place)])
    place, text = place[first], text[first]
    return text, place - start[text], place - string[first], strings, hashes[place]


def text_anchors(values: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of binary values in steps of bounded size; long ones in overlapping parts."""
    offsets, data = buffers(values)
    row, start, stop = [], [], []
    for i, (a, z) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        for part in range(a, max(a + 1, z - LENGTH + 1), STEP):
            row.append(i)
            start.append(part)
            stop.append(min(z, part + STEP + LENGTH - 1))
    row, start, stop = (np.array(x, dtype=np.int64) for x in (row, start, stop))
    at = 0
    while at < len(row):
        end = max(at + 1, int(np.searchsorted(stop, start[at] + STEP, side="right")))
        low, high = int(start[at]), int(stop[end - 1])
        found = anchors(data[low:high], start[at:end] - low, stop[at:end] - low)
        text, place, before, strings, hashes = found
        rows = row[at:end][text]
        yield rows, place + start[at:end][text] - offsets[rows], before, strings, hashes
        at = end


def buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of binary values (none null)."""
    width = np.int64 if pa.types.is_large_binary(values.type) else np.int32
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, width)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return offsets.astype(np.int64), data


def packed(place: np.ndarray, before: np.ndarray, strings: np.ndarray) -> np.ndarray:
    return place << 12 | before << 6 | strings


def unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return x >> 12, x >> 6 & 63, x & 63


def spread(x: np.ndarray) -> np.ndarray:
    """Well-mixed whole numbers."""
    mixed = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) ^ mixed).view(np.int64)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start."""
    change = np.zeros(max(0, len(keys[0]) - 1), dtype=bool)
    for key in keys:
        change |= key[1:] != key[:-1]
    return np.flatnonzero(np.r_[True, change]) if len(keys[0]) else np.zeros(0, dtype=np.int64)


#: Bits of an anchor's hash that are sent: enough to keep strangers apart mostly. They are
#: the lowest ones: the highest, by which anchors are chosen, crowd at the low end.
HASH_BITS = 44
PARCEL = pa.schema([("part", pa.int32()), ("parcel", pa.binary())])


def packed_numbers(x: np.ndarray) -> bytes:
    """Whole numbers that are not negative, byte by byte: first all lowest bytes.

    Only as many bytes as the largest needs.
    """
    size = max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)
    low = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].T)
    return len(x).to_bytes(4, "little") + bytes([size]) + low.tobytes()


def unpacked_numbers(data: memoryview, at: int) -> tuple[np.ndarray, int]:
    count, size = int.from_bytes(data[at : at + 4], "little"), data[at + 4]
    end = at + 5 + count * size
    out = np.zeros((count, 8), dtype=np.uint8)
    out[:, :size] = np.frombuffer(data[at + 5 : end], np.uint8).reshape(size, count).T
    return out.view("<u8").ravel().astype(np.uint64), end


def parcel(kind: int, h: np.ndarray, t: np.ndarray, at: np.ndarray) -> bytes:
    """Anchors in the order of their hashes, close together: hashes as differences
    behind the first, texts by number in a table, places as they are."""
    texts, number = np.unique(t.view(np.uint64), return_inverse=True)
    lists = (
        h[:1].view(np.uint64),
        np.diff(h, prepend=h[:1]).view(np.uint64),
        np.diff(texts, prepend=np.uint64(0)),
        number,
        (at + 1).view(np.uint64),
    )
    return bytes([kind]) + b"".join(map(packed_numbers, lists))


def opened(data: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    view, at, lists = memoryview(data), 1, []
    for _ in range(5):
        x, at = unpacked_numbers(view, at)
        lists.append(x)
    first, steps, texts, number, places = lists
    texts = np.cumsum(texts, dtype=np.uint64).view(np.int64)
    h = (first + np.cumsum(steps, dtype=np.uint64)).view(np.int64)
    return data[0], h, texts[number.astype(np.int64)], places.view(np.int64) - 1


#: Kinds of parcels: anchors that ask for other texts, anchors known to be repeated.
ASKING, KNOWN = 0, 1


def ask_anchors(parts: int):
    """Anchors of texts, parcelled by ranges of their hashes, a like number in each.

    An anchor asks whether another text has it. Where two texts of a batch share one,
    its places are repeated for sure: they go on as known, in parcels dealt out by text,
    and two witnesses (at -1) answer for them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in byte_slices(batch, "data", 1 << 23):
                texts = piece.column("t").to_numpy()
                found = list(text_anchors(piece.column("data")))
                row, place, before, strings, hashes = (np.concatenate(x) for x in zip(*found))
                h = (hashes & np.uint64((1 << HASH_BITS) - 1)).view(np.int64)
                t, at = texts[row], packed(place, before, strings)
                order = np.lexsort((at, t, h))
                h, t, at = h[order], t[order], at[order]
                once = runs(h, t, at)
                h, t, at = h[once], t[once], at[once]
                start = runs(h)
                if not len(start):
                    continue
                low, high = np.minimum.reduceat(t, start), np.maximum.reduceat(t, start)
                shared = low != high
                known = np.repeat(shared, np.diff(np.r_[start, len(h)]))
                w = start[shared]
                none = np.full(len(w), -1)
                ask_h = np.concatenate((h[~known], h[w], h[w]))
                order = np.argsort(ask_h, kind="stable")
                ask_t = np.concatenate((t[~known], low[shared], high[shared]))[order]
                ask_at = np.concatenate((at[~known], none, none))[order]
                yield parcels(ASKING, ask_h[order] >> 16, ask_h[order], ask_t, ask_at)
                dealt = spread(t[known]) >> 32 & ((1 << HASH_BITS - 16) - 1)
                order = np.argsort(dealt, kind="stable")
                zero = np.zeros(len(order), dtype=np.int64)
                yield parcels(KNOWN, dealt[order], zero, t[known][order], at[known][order])

    def parcels(kind, key, h, t, at) -> pa.RecordBatch:
        """Parcels of rows in the order of ``key``, cut into even ranges of it."""
        cuts = [(i << HASH_BITS - 16) // parts for i in range(1, parts)]
        ends = np.r_[0, np.searchsorted(key, cuts), len(key)]
        part = [i for i in range(parts) if ends[i] < ends[i + 1]]
        spans_ = [slice(ends[i], ends[i + 1]) for i in part]
        data = [parcel(kind, h[x], t[x], at[x]) for x in spans_]
        return record_batch([pa.array(part), pa.array(data, pa.binary())], PARCEL)

    return run


def byte_slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``limit`` bytes of a binary column, of one row at least."""
    offsets, _ = buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), batch.num_rows)
        yield batch.slice(at, end - at)
        at = end


def packed_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows with ``data`` compressed, for the shuffle of the texts."""
    pack = zstandard.ZstdCompressor().compress
    for batch in batches:
        yield from recoded(batch, lambda data: pack(data.as_buffer()), 1 << 22)


def unpacked_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        yield from recoded(batch, lambda data: unpack(data.as_buffer()), 1 << 20)


def recoded(batch: pa.RecordBatch, code, limit: int) -> Iterator[pa.RecordBatch]:
    at = batch.schema.get_field_index("data")
    for part in byte_slices(batch, "data", limit):
        yield part.set_column(at, "data", pa.array(map(code, part.column(at)), pa.binary()))


FLAGGED = pa.schema([("t", pa.int64()), ("at", pa.int64())])


def repeated_anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The anchors that occur in two texts, of parcels sorted by part.

    Holds the parcels of one part, of as many even ones as there are shuffle partitions.
    """
    held: list[bytes] = []
    part = None
    for batch in batches:
        for p, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if p != part and held:
                yield from flagged(held)
                held = []
            part = p
            held.append(data)
    if held:
        yield from flagged(held)


def flagged(parcels: list[bytes]) -> Iterator[pa.RecordBatch]:
    asking, known = [], []
    for data in parcels:
        kind, *columns = opened(data)
        (asking if kind == ASKING else known).append(columns)
    parcels.clear()
    for _, t, at in known:
        yield record_batch([pa.array(t), pa.array(at)], FLAGGED)
    known.clear()
    if not asking:
        return
    h, t, at = (np.concatenate(x) for x in zip(*asking))
    asking.clear()
    order = np.lexsort((at, t, h))
    h, t, at = h[order], t[order], at[order]
    start = runs(h)
    low, high = np.minimum.reduceat(t, start), np.maximum.reduceat(t, start)
    repeated = np.repeat(low != high, np.diff(np.r_[start, len(h)])) & (at >= 0)
    t, at = t[repeated], at[repeated]
    yield record_batch([pa.array(t), pa.array(at)], FLAGGED)


# -- contexts ---------------------------------------------------------------------------

CONTEXT = pa.schema(
    [
        ("h", pa.int64()), ("context", pa.binary()), ("k", pa.int32()), ("d", pa.int64()),
        ("start", pa.int32()), ("stop", pa.int32()), ("more", pa.binary()),
    ]
)
SPAN = pa.schema(
    [("k", pa.int32()), ("d", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())]
)
#: ``stop`` of rows of CONTEXT that are no spans: a context or a mark of a crowded anchor
#: (context null, start -1, so that it comes first), a string of one. What a text holds
#: more than once asks once; ``more`` has its other starts.
ASKED, STRING = 0, -1
#: Bits of the hash that deals out contexts; strangers that share it are told apart.
DEALT_BITS = 40


def short(t: np.ndarray) -> np.ndarray:
    """Half of a text's hash: beside the id it tells the texts of one id apart."""
    return (t & 0xFFFFFFFF).astype(np.uint32).view(np.int32)


def ask_contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings around each repeated anchor, which ask which of them repeat.

    Where a batch has the same context in a document with a smaller id, all of it
    is repeated; it goes on as a span (context null), dealt out by text. An anchor with
    more than ``CONTEXTS`` of them is crowded: its strings ask for themselves, and a mark
    tells those who have its other contexts.
    """
    for batch in batches:
        for part in byte_slices(batch, "data", 1 << 22):
            offsets, data = buffers(part.column("data"))
            lists = part.column("at")
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(part.num_rows), lengths)
            place, before, strings = unpacked(lists.flatten().to_numpy())
            base = offsets[row]
            start = place - before
            stop = start + strings + LENGTH - 1
            # A text with the same hash t but another one u cannot have been meant.
            fits = (stop <= offsets[row + 1] - base) & (start >= 0)
            row, place, base, start, stop = (x[fits] for x in (row, place, base, start, stop))
            if not len(row):
                continue
            view = memoryview(data)
            cut = [
                bytes(view[a:z])
                for a, z in zip((base + start).tolist(), (base + stop).tolist(), strict=True)
            ]
            t, d = (part.column(c).to_numpy()[row] for c in ("t", "d"))
            k = short(t)
            names = pa.array(cut, pa.binary()).dictionary_encode().indices.to_numpy()
            first = np.full(int(names.max()) + 1, LAST, dtype=np.int64)
            np.minimum.at(first, names, d)
            settled = first[names] < d
            yield span_rows(k[settled], d[settled], start[settled], stop[settled])
            h = place_hashes(data, base + place) & ((1 << DEALT_BITS) - 1)
            anchor = np.zeros(len(first), dtype=np.int64)
            anchor[names] = h
            anchor, many = np.unique(anchor, return_counts=True)
            marks = anchor[many > CONTEXTS]
            none, null = np.zeros(len(marks), dtype=np.int64), pa.nulls(len(marks), pa.binary())
            yield context_rows(marks, null, none, none, none - 1, none + ASKED, null)
            crowded = np.isin(h, marks) & ~settled
            x = np.flatnonzero(crowded)
            yield from string_rows(data, (base + start)[x], (base + stop)[x], k[x], d[x], start[x])
            x = np.flatnonzero(~crowded & ~settled)
            context = pa.array([cut[i] for i in x.tolist()], pa.binary())
            yield asking_once(h[x], context, names[x], k[x], d[x], start[x], ASKED)


def context_rows(h, context, k, d, start, stop, more) -> pa.RecordBatch:
    columns = (pa.array(x) for x in (k, d, start, stop))
    return record_batch([pa.array(h), context, *columns, more], CONTEXT)


def asking_once(h, context, name, k, d, start, stop) -> pa.RecordBatch:
    """A row for all places that one text has of a context or string ``name``."""
    order = np.lexsort((start, d, k, name))
    at = runs(name[order], k[order], d[order])
    many = np.diff(np.r_[at, len(order)])
    rest = np.ones(len(order), dtype=bool)
    rest[at] = False
    ends = np.r_[0, np.cumsum(many - 1)].astype(np.int32) * 4
    starts = start[order][rest].astype(np.int32)
    buffers_ = [None, pa.py_buffer(ends), pa.py_buffer(starts)]
    more = pa.Array.from_buffers(pa.binary(), len(at), buffers_)
    more = pc.if_else(pa.array(many > 1), more, pa.scalar(None, pa.binary()))
    x = order[at]
    stop = np.full(len(x), stop)
    return context_rows(h[x], context.take(pa.array(x)), k[x], d[x], start[x], stop, more)


def all_starts(start: np.ndarray, more: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The starts of rows, ``more`` among them, behind each other, and where a row's begin."""
    extra = pc.fill_null(pc.binary_length(more), 0).to_numpy(zero_copy_only=False) // 4
    first = np.r_[0, np.cumsum(extra + 1)].astype(np.int64)
    out = np.empty(first[-1], dtype=np.int64)
    rest = np.ones(len(out), dtype=bool)
    rest[first[:-1]] = False
    out[first[:-1]] = start
    out[rest] = np.frombuffer(b"".join(more.drop_null().to_pylist()), np.int32)
    return out, first


def every_start(batch: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Row and start of each place that the rows stand for."""
    more = batch.column("more")
    more = more.combine_chunks() if isinstance(more, pa.ChunkedArray) else more
    starts, first = all_starts(batch.column("start").to_numpy(), more)
    return np.repeat(np.arange(batch.num_rows), np.diff(first)), starts


def span_rows(k, d, start, stop) -> pa.RecordBatch:
    """Spans, those that meet as one, dealt out by text."""
    k, d, start, stop = merged(k, d, start, stop)
    null = pa.nulls(len(k), pa.binary())
    return context_rows(k.astype(np.int64) & 0xFFFFFFFF, null, k, d, start, stop, null)


def merged(k, d, start, stop) -> tuple[np.ndarray, ...]:
    """Spans of texts in order, those that overlap or touch as one."""
    order = np.lexsort((start, d, k))
    k, d, start, stop = (x[order].astype(np.int64) for x in (k, d, start, stop))
    text = np.zeros(len(k), dtype=np.int64)
    text[runs(k, d)] = 1
    text = np.cumsum(text) << 32
    end = np.maximum.accumulate(text + stop)
    begin = np.flatnonzero(np.r_[True, (text + start)[1:] > end[:-1]][: len(k)])
    last = np.r_[begin[1:], len(k)][: len(begin)] - 1
    return k[begin].astype(np.int32), d[begin], start[begin], end[last] - text[last]


def string_rows(data, low, high, k, d, start) -> Iterator[pa.RecordBatch]:
    """The strings in ``data[low:high]``, each dealt out by its hash.

    Of equal ones that are cut at once, only those with the smallest id ask.
    """
    counts = high - low - LENGTH + 1
    ends = np.cumsum(counts)
    a = 0
    while a < len(counts):
        z = max(a + 1, int(np.searchsorted(ends, ends[a] - counts[a] + STRINGS, side="right")))
        own = np.repeat(np.arange(a, z), counts[a:z])
        inside = np.arange(len(own)) - np.repeat(ends[a:z] - counts[a:z] - ends[a] + counts[a], counts[a:z])
        at, begin = low[own] + inside, start[own] + inside
        offsets = np.arange(len(own) + 1, dtype=np.int32) * LENGTH
        cut = data[at[:, None] + np.arange(LENGTH)]
        buffers_ = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(cut))]
        strings = pa.Array.from_buffers(pa.binary(), len(own), buffers_)
        h = place_hashes(data, at)
        for step in (ANCHOR, 2 * ANCHOR, LENGTH - ANCHOR):
            h = spread(h) ^ place_hashes(data, at + step)
        yield from asking(spread(h), strings, k[own], d[own], begin)
        a = z


def asking(h, strings: pa.Array, k, d, start) -> Iterator[pa.RecordBatch]:
    """Strings that have the smallest id among equal ones here; the others as spans."""
    name = strings.dictionary_encode().indices.to_numpy()
    least = np.full(int(name.max(initial=-1)) + 1, LAST, dtype=np.int64)
    np.minimum.at(least, name, d)
    bad = d > least[name]
    yield span_rows(k[bad], d[bad], start[bad], start[bad] + LENGTH)
    x = np.flatnonzero(~bad)
    strings = strings.take(pa.array(x))
    yield asking_once(h[x], strings, name[x], k[x], d[x], start[x], STRING)


def place_hashes(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    grams = data[place[:, None] + np.arange(ANCHOR)]
    return gram_hashes(np.ascontiguousarray(grams).ravel())[::ANCHOR].view(np.int64)


def repeated_spans(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte spans of repeated strings, of contexts sorted by h and start.

    Anchors are completed, then all contexts of the completed ones are ordered. Those of
    crowded anchors, marked or of ``ROWS`` rows, go on as strings without being held.
    """
    held: list[pa.RecordBatch] = []
    rows = 0
    crowded = None
    for batch in batches:
        if crowded is not None:
            same = batch.column("h").to_numpy() == crowded
            end = batch.num_rows if same.all() else int(same.argmin())
            yield from broken(pa.Table.from_batches([batch.slice(0, end)]))
            if end == batch.num_rows:
                continue
            batch, crowded = batch.slice(end), None
        held.append(batch)
        rows += batch.num_rows
        if rows < ROWS:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        h = table.column("h").to_numpy()
        done = int(runs(h)[-1])
        if done:
            yield from spans(table.slice(0, done))
        held, rows = table.slice(done).to_batches(), table.num_rows - done
        if rows >= ROWS:
            crowded = h[-1]
            yield from broken(table.slice(done))
            held, rows = [], 0
    if rows:
        yield from spans(pa.Table.from_batches(held))


def broken(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Contexts of crowded anchors as strings; spans and strings among them as they are."""
    yield from spans(table, np.unique(table.column("h").to_numpy()))


def spans(table: pa.Table, crowded: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """Spans and strings that still ask, of whole anchors or of a part of ``crowded`` ones."""
    table = table.combine_chunks()
    stop = table.column("stop").to_numpy()
    settled = table.filter(pa.array(stop > ASKED))
    if settled.num_rows:
        yield span_rows(*(settled.column(c).to_numpy() for c in SPAN.names))
    string = table.filter(pa.array(stop == STRING))
    if string.num_rows:
        own, start = every_start(string)
        h, k, d = (string.column(c).to_numpy()[own] for c in ("h", "k", "d"))
        context = string.column("context").combine_chunks().take(pa.array(own))
        yield from asking(h, context, k, d, start)
    asked = table.filter(pa.array(stop == ASKED))
    mark = asked.column("start").to_numpy() < 0
    h = asked.column("h").to_numpy()
    many = np.isin(h, h[mark] if crowded is None else crowded)
    lone = asked.filter(pa.array(many & ~mark))
    if lone.num_rows:
        offsets, data = buffers(lone.column("context").combine_chunks())
        own, start = every_start(lone)
        k, d = (lone.column(c).to_numpy()[own] for c in ("k", "d"))
        yield from string_rows(data, offsets[own], offsets[own + 1], k, d, start)
    asked = asked.filter(pa.array(~many))
    if not asked.num_rows:
        return
    h, k, d = (asked.column(c).to_numpy() for c in ("h", "k", "d"))
    coded = asked.column("context").combine_chunks().dictionary_encode()
    name = coded.indices.to_numpy()
    contexts = coded.dictionary
    first = np.full(len(contexts), LAST, dtype=np.int64)
    np.minimum.at(first, name, d)
    anchor = np.zeros(len(contexts), dtype=np.int64)
    anchor[name] = h
    offset, least = smallest_ids(contexts, anchor, first)
    # Every string of every asking context, against the smallest id that has it.
    counts = np.diff(offset)[name]
    owner = np.repeat(np.arange(len(name)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    bad = least[offset[name[owner]] + inside] < d[owner]
    owner, inside = owner[bad], inside[bad]
    if not len(owner):
        return
    new = np.r_[True, (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)]
    begin = np.flatnonzero(new)
    end = np.r_[begin[1:], len(owner)] - 1
    at = owner[begin]
    low, high = inside[begin], inside[end] + LENGTH
    starts, first = all_starts(
        asked.column("start").to_numpy(), asked.column("more").combine_chunks()
    )
    many = first[at + 1] - first[at]
    x = np.repeat(np.arange(len(at)), many)
    place = starts[np.repeat(first[at] - np.cumsum(many) + many, many) + np.arange(len(x))]
    yield span_rows(k[at][x], d[at][x], place + low[x], place + high[x])


def resolved_strings(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans, those of repeated strings too, of rows sorted by h, context and d.

    The first of equal strings has the smallest id; nothing but it is held.
    """
    last, least_of_last = (None, None), LAST
    for batch in batches:
        string = batch.column("stop").to_numpy() == STRING
        settled = batch.filter(pa.array(~string))
        k, d, start, stop = (settled.column(c).to_numpy() for c in SPAN.names)
        batch = batch.filter(pa.array(string))
        if batch.num_rows:
            context = batch.column("context")
            name = context.dictionary_encode().indices.to_numpy()
            h, k2, d2 = (batch.column(c).to_numpy() for c in ("h", "k", "d"))
            at = runs(h, name)
            least = d2[at].copy()
            if (h[0], context[0].as_py()) == last:
                least[0] = least_of_last
            last, least_of_last = (h[-1], context[-1].as_py()), least[-1]
            bad = np.repeat(least, np.diff(np.r_[at, len(h)])) < d2
            own, place = every_start(batch)
            own, place = own[bad[own]], place[bad[own]]
            k, d = np.r_[k, k2[own]], np.r_[d, d2[own]]
            start, stop = np.r_[start, place], np.r_[stop, place + LENGTH]
        yield record_batch([pa.array(x) for x in merged(k, d, start, stop)], SPAN)


def smallest_ids(
    contexts: pa.Array, anchor: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each string of each distinct context the smallest id that has it.

    Returns where each context's strings start in the second array. ``first`` is the
    smallest id of each context. Only contexts of equal anchors can share strings.
    """
    offsets, data = buffers(contexts)
    size = np.diff(offsets)
    strings = size - LENGTH + 1
    offset = np.r_[0, np.cumsum(strings)]
    least = np.repeat(first, strings)
    order = np.argsort(anchor, kind="stable")
    start = runs(anchor[order])
    many = np.diff(np.r_[start, len(order)])
    text = np.repeat(np.arange(len(start)), many)
    # One context alone has its answer; very many are told apart string by string.
    few = np.repeat((many > 1) & (many <= CONTEXTS), many)
    crowd = order[np.repeat(many > CONTEXTS, many)]
    if len(crowd):
        least_of_strings(data, offsets, strings, offset, crowd, first, least)
    chosen, text = order[few], text[few]
    if not len(chosen):
        return offset, least
    # Texts of one anchor each: its contexts, each with a mark behind, and a last mark.
    at = runs(text)
    text = np.repeat(np.arange(len(at)), np.diff(np.r_[at, len(text)]))
    total = np.add.reduceat(size[chosen] + 1, at)
    column = np.cumsum(size[chosen] + 1) - (size[chosen] + 1)
    column -= column[at][text]
    by_size = np.argsort(total, kind="stable")
    begin = 0
    while begin < len(by_size):
        end = begin + 1
        while end < len(by_size) and (end + 1 - begin) * total[by_size[end]] <= BATCH:
            end += 1
        lane = np.full(len(at), -1)
        lane[by_size[begin:end]] = np.arange(end - begin)
        own = np.flatnonzero(lane[text] >= 0)
        c, r, col = chosen[own], lane[text[own]], column[own]
        matrix = np.ones((end - begin, int(total[by_size[end - 1]])), dtype=np.int32)
        k = np.repeat(np.arange(len(c)), size[c])
        step = np.arange(len(k)) - np.repeat(np.cumsum(size[c]) - size[c], size[c])
        matrix[r[k], col[k] + step] = data[offsets[c][k] + step].astype(np.int32) + 2
        length = total[by_size[begin:end]]
        matrix[np.arange(len(length)), length - 1] = 0
        ranked = suffix_orders(matrix, length)
        # The strings that start inside a context, in the order of the suffixes.
        holder = np.full(matrix.shape, -1, dtype=np.int64)
        k = np.repeat(np.arange(len(c)), strings[c])
        step = np.arange(len(k)) - np.repeat(np.cumsum(strings[c]) - strings[c], strings[c])
        holder[r[k], col[k] + step] = offset[c][k] + step
        inside = np.arange(matrix.shape[1]) < length[:, None]
        rr, rank = np.nonzero(inside)
        pos = ranked[rr, rank]
        target = holder[rr, pos]
        rr, pos, target = rr[target >= 0], pos[target >= 0], target[target >= 0]
        equal = np.zeros(len(rr), dtype=bool)
        for a in range(1, len(rr), 1 << 16):
            z = min(len(rr), a + (1 << 16))
            one = matrix[rr[a:z, None], pos[a:z, None] + np.arange(LENGTH)]
            two = matrix[rr[a - 1 : z - 1, None], pos[a - 1 : z - 1, None] + np.arange(LENGTH)]
            equal[a:z] = (rr[a:z] == rr[a - 1 : z - 1]) & (one == two).all(axis=1)
        groups = np.flatnonzero(~equal)
        smallest = np.minimum.reduceat(least[target], groups)
        least[target] = np.repeat(smallest, np.diff(np.r_[groups, len(rr)]))
        begin = end
    return offset, least


def least_of_strings(data, offsets, strings, offset, crowd, first, least) -> None:
    """The same for contexts too many to order at once: each string is a text of its own."""
    k = np.repeat(crowd, strings[crowd])
    step = np.arange(len(k)) - np.repeat(np.cumsum(strings[crowd]) - strings[crowd], strings[crowd])
    view = memoryview(data)
    cut = [bytes(view[a : a + LENGTH]) for a in (offsets[k] + step).tolist()]
    name = pa.array(cut, pa.binary()).dictionary_encode().indices.to_numpy()
    smallest = np.full(int(name.max()) + 1, LAST, dtype=np.int64)
    np.minimum.at(smallest, name, first[k])
    least[offset[k] + step] = smallest[name]


# -- documents ----------------------------------------------------------------------------

KEPT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def apply_spans(content: bool):
    """Cut the spans out of the texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in unpacked_texts(batches):
            for part in slices([batch]):
                out = []
                for data, copy, spans_ in zip(
                    part.column("data").to_pylist(),
                    part.column("copy").to_pylist(),
                    part.column("spans").to_pylist(),
                    strict=True,
                ):
                    merged = merged_spans(len(data), copy, spans_)
                    kept, end = [], 0
                    for a, z in merged:
                        kept.append(data[end:a])
                        end = z
                    kept = b"".join([*kept, data[end:]])
                    digest = hashlib.sha256(kept).hexdigest()
                    row = (len(data), len(data) - len(kept), len(merged), digest)
                    out.append((*row, kept) if content else row)
                names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
                columns = [part.column("doc_id"), *map(pa.array, zip(*out, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names + ["kept"] * content)

    return run


def merged_spans(size: int, copy: bool, spans_: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal removed runs; a copy of a whole text with a smaller id goes as a whole."""
    if copy:
        return [(0, size)] if size >= LENGTH else []
    out: list[list[int]] = []
    for a, z in sorted((s["start"], s["stop"]) for s in spans_ or ()):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [(a, z) for a, z in out]


def text_hash(data: Column, seed: int) -> Column:
    return F.xxhash64(data, F.lit(seed))


def remove_repeats(df: DataFrame, doc_id: str, text: str, content: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``) per row.

    A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a row
    with a smaller id; strings never cross rows and are judged on the input. Null texts
    are empty. Rows with one id never remove each other's bytes, and a null id is larger
    than all others. An empty table gives no rows. Ids are whole numbers.
    """
    data = F.coalesce(df[text], F.lit("")).cast("binary")
    rows = df.select(
        df[doc_id].alias("doc_id"),
        F.coalesce(df[doc_id].cast("long"), F.lit(LAST)).alias("d"),
        data.alias("data"),
    )
    docs = rows.withColumns({"t": text_hash(F.col("data"), 1), "u": text_hash(F.col("data"), 2)})
    classes = docs.groupBy("t", "u").agg(F.min("d").alias("first"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = docs.select("t", "data").mapInArrow(ask_anchors(parts), "part int, parcel binary")
    met = asked.repartition("part").sortWithinPartitions("part")
    found = met.mapInArrow(repeated_anchors, "t long, at long")
    per_text = found.groupBy("t").agg(F.collect_set("at").alias("at"))
    known = classes.join(per_text, "t").select("t", "u", "first", "at")
    kind = df.schema[doc_id].dataType.simpleString()
    # Texts shrink further than the shuffle's own codec would bring them, row by row. Both
    # joins with them read all columns, so that one shuffle serves them; a filter for nulls
    # on one side, of columns that have none, would be in its way.
    schema = f"doc_id {kind}, d long not null, data binary not null, t long not null, u long not null"
    docs = docs.mapInArrow(packed_texts, schema)
    # No id is below the first of its texts; an equality would become a key of the join.
    own = docs.join(known, ["t", "u"]).where("d <= first")
    schema = "h long, context binary, k int, d long, start int, stop int, more binary"
    given = own.select("t", "u", "d", "data", "at", "doc_id")
    contexts = given.mapInArrow(lambda batches: ask_contexts(unpacked_texts(batches)), schema)
    keyed = contexts.repartition("h").sortWithinPartitions("h", "start")
    single = keyed.mapInArrow(repeated_spans, schema).repartition("h")
    single = single.sortWithinPartitions("h", "context", "d")
    removed = single.mapInArrow(resolved_strings, "k int, d long, start int, stop int")
    removed = removed.groupBy("k", F.col("d").alias("first")).agg(
        F.collect_list(F.struct("start", "stop")).alias("spans")
    )
    half = F.expr("cast(if(t & 4294967295 > 2147483647, (t & 4294967295) - 4294967296, t & 4294967295) as int)")
    verdicts = classes.withColumn("k", half).join(removed, ["k", "first"], "left").drop("k")
    judged = docs.join(verdicts, ["t", "u"]).select(
        "doc_id", "data", (F.col("first") < F.col("d")).alias("copy"), "spans"
    )
    schema = f"doc_id {kind}, {KEPT}" + (", kept binary" if content else "")
    return judged.mapInArrow(apply_spans(content), schema).withColumnRenamed("doc_id", doc_id)
