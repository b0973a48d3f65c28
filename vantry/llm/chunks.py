"""Texts as sequences of cached pieces, for byte-level tokenizers.

The pre-tokenizer pattern never lets a piece continue over a blank that is followed by a
non-blank: such a blank always opens the next piece. So a text may be cut before each of
these blanks, and each cut is tokenized alone, once for as long as it stays in the cache.
Caches are bounded in bytes; a full one keeps what was asked for more than once.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

CUT = re.compile(r" (?=\S)")
IRREGULAR = re.compile(r" (?:\s|\Z)")
PLAIN = re.compile(r" ?\S+\Z")
BATCH_BYTES = 4 << 20
CACHE_BYTES = 64 << 20
ENTRY_BYTES = 200  # of a cache entry, besides its text and its ids


Ids = tuple[np.ndarray, np.ndarray]  # ids of all entries one after the other; number of ids of each


class IdTable:
    """ids of entries, numbered as they are first asked for; `encode` makes the ids of queued entries."""

    def __init__(self, encode: Callable[[list[str]], Ids]):
        self.encode = encode
        self.clear()

    def clear(self) -> None:
        self.queue: list[str] = []
        self.lens, self.starts, self.uses = (np.zeros(0, np.int64) for _ in range(3))
        self.flat, self.used, self.weight = np.zeros(1 << 16, np.uint32), 0, 0

    def number(self, entry: str) -> int:
        self.queue.append(entry)
        return len(self.lens) + len(self.queue) - 1

    def settle(self) -> None:
        if not self.queue:
            return
        new, lens = self.encode(self.queue)
        size = len(self.flat)
        while self.used + len(new) > size:
            size *= 2
        if size > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(size - len(self.flat), np.uint32)])
        self.flat[self.used : self.used + len(new)] = new
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lens) - lens])
        self.lens = np.concatenate([self.lens, lens])
        self.uses = np.concatenate([self.uses, np.zeros(len(lens), np.int64)])
        self.used += len(new)
        self.weight += sum(map(len, self.queue)) + ENTRY_BYTES * len(lens) + 4 * len(new)
        self.queue = []

    def ids(self, numbers: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of the entries, and where each group of entries begins among them (ends: among the entries)."""
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        lens = self.lens[numbers]
        total = np.concatenate([[0], np.cumsum(lens)])
        return gathered(self.flat, self.starts[numbers], lens), total[ends]

    def keep(self, numbers: np.ndarray) -> None:
        """Only these entries, numbered anew in this order."""
        lens, flat, weight = self.lens[numbers], gathered(self.flat, self.starts[numbers], self.lens[numbers]), self.weight
        share = len(numbers) / max(1, len(self.lens))
        self.clear()
        self.flat, self.used, self.weight = np.concatenate([flat, np.zeros(1 << 16, np.uint32)]), len(flat), int(weight * share)
        self.lens, self.starts, self.uses = lens, np.cumsum(lens) - lens, np.zeros(len(lens), np.int64)


class Numbers(dict):
    """Numbers of keys in a table; an unseen key is queued there with `lead` before it."""

    def __init__(self, table: IdTable, lead: str = ""):
        super().__init__()
        self.table, self.lead = table, lead

    def __missing__(self, key: str) -> int:
        found = self[key] = self.table.number(self.lead + key)
        return found


class WordCoder:
    """ids of cuts: split by the pattern, and each distinct word encoded once."""

    def __init__(self, encode: Callable[[list[str]], Ids], pattern: str):
        self.split, self.encode = regex.compile(pattern).findall, encode

    def __call__(self, cuts: list[str]) -> Ids:
        plain = np.fromiter((PLAIN.match(cut) is not None for cut in cuts), bool, len(cuts))
        # cuts without inner white space are split together: a line break between two of them is a word of its own
        words = self.split("\n".join([cut for cut, one in zip(cuts, plain.tolist(), strict=True) if one]))
        seen = pa.array(words, pa.string()).dictionary_encode()
        codes, names = seen.indices.to_numpy(), seen.dictionary.to_pylist()
        stop = names.index("\n") if "\n" in names else -1
        counts = np.zeros(len(cuts), np.int64)
        inner = np.flatnonzero(codes != stop)
        if plain.any():
            stops = np.flatnonzero(codes == stop)
            counts[plain] = np.diff(np.concatenate([[-1], stops, [len(codes)]])) - 1
        codes = codes[inner]
        # the others one by one
        number = {name: k for k, name in enumerate(names)}
        more: list[int] = []
        for k in np.flatnonzero(~plain).tolist():
            for word in self.split(cuts[k]):
                more.append(number.setdefault(word, len(number)))
                counts[k] += 1
        names = list(number)
        new, lens = self.encode(names)
        starts = np.cumsum(lens) - lens
        place = np.zeros(len(cuts), np.int64)  # of the first word of a cut among all
        place[plain] = np.cumsum(counts[plain]) - counts[plain]
        place[~plain] = len(codes) + np.cumsum(counts[~plain]) - counts[~plain]
        order = gathered(np.concatenate([codes, np.array(more, np.int64)]), place, counts)
        total = np.concatenate([[0], np.cumsum(lens[order])])
        ends = np.concatenate([[0], np.cumsum(counts)])
        return gathered(new, starts[order], lens[order]), np.diff(total[ends])


class CutCoder:
    """ids of texts; `encode` makes the ids of a list of cuts."""

    def __init__(self, encode: Callable[[list[str]], Ids], most_bytes: int = CACHE_BYTES):
        self.table, self.most_bytes = IdTable(encode), most_bytes
        self.inner, self.first = Numbers(self.table, " "), Numbers(self.table)

    def clear(self) -> None:
        for x in (self.table, self.inner, self.first):
            x.clear()

    def prune(self) -> None:
        """A full cache keeps what was used more than once; where that fills over half of it, nothing."""
        keep = [[(key, number) for key, number in numbers.items() if self.table.uses[number] > 1] for numbers in (self.inner, self.first)]
        if 2 * sum(map(len, keep)) > len(self.table.lens):
            self.clear()
            return
        self.table.keep(np.array([number for part in keep for _, number in part], np.int64))
        begin = 0
        for numbers, part in zip((self.inner, self.first), keep, strict=True):
            numbers.clear()
            numbers.update((key, begin + k) for k, (key, _) in enumerate(part))
            begin += len(part)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text begins (one entry more than texts)."""
        if self.table.weight > self.most_bytes:
            self.prune()
        codes: list[int] = []
        ends = np.zeros(len(texts) + 1, np.int64)
        inner = self.inner.__getitem__
        for k, text in enumerate(texts):
            cuts = CUT.split(text) if IRREGULAR.search(text) else text.split(" ")
            if cuts[0]:
                codes.append(self.first[cuts[0]])
            codes.extend(map(inner, cuts[1:]))
            ends[k + 1] = len(codes)
        self.table.settle()
        return self.table.ids(np.array(codes, np.int64), ends)


LETTER, SIGN = 1, 2
KIND = np.zeros(256, np.uint8)
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xC3, 0xC4, 0xC5]] = LETTER  # and the first byte of most letters up to U+017F
KIND[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = SIGN
SOLID = np.ones(256, bool)  # first bytes of characters that are no white space for sure
SOLID[[*range(0x09, 0x0E), *range(0x1C, 0x21), 0xC2, 0xE1, 0xE2, 0xE3]] = False


def whole_pieces(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The texts one after the other; where each stretch of them begins (and the last ends); whether a stretch is one piece of the byte-level
    pattern for sure; where each text begins among the stretches (one entry more than texts).

    Stretches begin before a blank, and before and after a line break, that a character follows which is no white space. One of letters with ASCII
    signs after them is cut between the two. Characters beyond U+017F are not judged: their stretches are left to the pattern.
    """
    data = b"".join(texts)
    all_bytes = np.frombuffer(data, np.uint8)
    n = len(all_bytes)
    begins = np.cumsum([0] + [len(t) for t in texts])
    solid = SOLID[all_bytes]
    at = np.flatnonzero(all_bytes == 0xE2)  # dashes and quotation marks: no white space begins with E2 82 or a later pair, or is in E2 80 8B to A7
    second, third = all_bytes[at + 1], all_bytes[at + 2]
    solid[at[(second > 0x81) | ((second == 0x80) & (third > 0x8A) & (third < 0xA8))]] = True
    solid[begins[begins < n]] = False  # what follows in another text does not follow
    mark = np.zeros(n + 1, bool)
    mark[: n - 1] = (all_bytes[:-1] == 0x20) & solid[1:]
    breaks = np.flatnonzero((all_bytes[:-1] == 0x0A) & solid[1:])
    mark[breaks] = mark[breaks + 1] = True
    mark[begins] = True
    kind = KIND[all_bytes]
    lead = np.flatnonzero((all_bytes >= 0xC3) & (all_bytes <= 0xC5))
    kind[lead + 1] = LETTER
    odd = lead[(all_bytes[lead] == 0xC3) & ((all_bytes[lead + 1] == 0x97) | (all_bytes[lead + 1] == 0xB7))]  # the signs of multiplication and division
    kind[odd] = kind[odd + 1] = 0
    count = lambda x: np.concatenate([np.zeros(1, np.int32), np.cumsum(x, dtype=np.int32)])
    edges = np.flatnonzero(mark)
    if n == 0:
        return data, np.zeros(1, np.int64), np.zeros(0, bool), np.zeros(len(texts) + 1, np.int64)
    first = edges[:-1] + (all_bytes[edges[:-1]] == 0x20)
    other = count(kind == 0)
    rises = count(np.concatenate([[False], (kind[:-1] == SIGN) & (kind[1:] == LETTER)]))
    whole = (first < edges[1:]) & (other[edges[1:]] == other[first])
    whole &= rises[edges[1:]] == rises[np.minimum(first + 1, edges[1:])]
    falls = np.flatnonzero((kind[:-1] == LETTER) & (kind[1:] == SIGN)) + 1
    mark[falls[whole[np.searchsorted(edges, falls, side="right") - 1]]] = True
    bounds = np.flatnonzero(mark)
    return data, bounds, np.repeat(whole, np.diff(np.searchsorted(bounds, edges))), np.searchsorted(bounds, begins)


class PieceCoder:
    """ids of texts by the byte-level pattern, as of a CutCoder: each distinct stretch of `whole_pieces` is encoded once for as long as it stays in
    the cache. `encode` makes the ids of single pieces and, after them, of other stretches."""

    def __init__(self, encode: Callable[[list[bytes], list[bytes]], Ids], most_bytes: int = CACHE_BYTES):
        self.pieces = 0  # among the queued entries, which come first
        self.table, self.most_bytes = IdTable(lambda queue: encode(queue[: self.pieces], queue[self.pieces :])), most_bytes
        self.numbers: dict[bytes, int] = {}

    def clear(self) -> None:
        self.table.clear()
        self.numbers.clear()

    def prune(self) -> None:
        """A full cache keeps what was used more than once; where that fills over half of it, nothing."""
        keep = [(key, number) for key, number in self.numbers.items() if self.table.uses[number] > 1]
        if 2 * len(keep) > len(self.table.lens):
            self.clear()
            return
        self.table.keep(np.array([number for _, number in keep], np.int64))
        self.numbers = {key: k for k, (key, _) in enumerate(keep)}

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text begins (one entry more than texts)."""
        if self.table.weight > self.most_bytes:
            self.prune()
        data, bounds, whole, ends = whole_pieces([text.encode() for text in texts])
        found = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)]).dictionary_encode()
        codes, names = found.indices.to_numpy(), bytes_of(found.dictionary)
        single = np.zeros(len(names), bool)
        single[codes] = whole
        new: tuple[list[bytes], list[bytes]] = ([], [])
        for name, one in zip(names, single.tolist(), strict=True):
            if name not in self.numbers:
                new[not one].append(name)
        self.pieces, self.table.queue = len(new[0]), [*new[0], *new[1]]
        self.numbers.update(zip(self.table.queue, range(len(self.table.lens), len(self.table.lens) + len(self.table.queue)), strict=True))
        self.table.settle()
        numbers = np.fromiter(map(self.numbers.__getitem__, names), np.int64, len(names))
        return self.table.ids(numbers[codes], ends)


SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def split_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of texts with A-Z lower-cased, split at 09-0D and 20: code of each word, the words, number of words of each text."""
    data = b"\n".join(texts).lower()  # of bytes only A-Z
    space = SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    starts, ends = edges[::2], edges[1::2]
    bare = np.frombuffer(data, np.uint8)[~space]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(bare)]).dictionary_encode()
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return found.indices.to_numpy().astype(np.int64), found.dictionary, np.diff(np.searchsorted(starts, begins))


def bytes_of(column: pa.Array) -> list[bytes]:
    """The values of a string or binary column without nulls; several times as fast as to_pylist."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return []
    _, cuts, held = column.buffers()
    cuts = np.frombuffer(cuts, np.int64)[column.offset : column.offset + len(column) + 1]
    held = memoryview(held)[cuts[0] : cuts[-1]].tobytes() if held else b""
    cuts = (cuts - cuts[0]).tolist()
    return [held[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def gathered(flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lens[i]] for all i, one after the other."""
    ends = np.cumsum(lens)
    if not len(ends):
        return flat[:0]
    at = np.repeat(starts - (ends - lens), lens)
    at += np.arange(ends[-1])
    return flat[at]


def slices(batch: pa.RecordBatch, column: int, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of the given column (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    at = 0
    for end in np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // most, append=-1)) + 1:
        yield batch.slice(at, end - at)
        at = end


def id_lists(ids: np.ndarray, ends: np.ndarray, packed: bool) -> pa.Array:
    """Arrow lists of ids, or the ids of each row as little-endian unsigned 32-bit integers."""
    if packed:
        return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))
