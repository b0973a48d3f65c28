"""Byte-level BPE encoding and decoding by merge replay.

The distinct words of a block of texts form one corpus. An inverted index leads from each
pair of neighbouring tokens, by the rank of its merge, to the word positions where it stands.
Merges are applied in rank order; each touches the listed positions and re-indexes only the
two neighbours. Blocks are independent, so encoding is a narrow map without any shuffle; words
of earlier blocks of a task are not replayed while they stay in its cache, which is bounded in
bytes and dropped when the task ends.

Null texts count as empty. An empty text has no ids. Repeated rows, null keys and equal texts are
encoded like others; columns other than the key and the text are not carried, so their names
cannot clash. A word may have any length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.chunks import CutCoder, WordCoder, gathered, id_lists, slices
from vantry.llm.scratch import small_batches


SLICE_BYTES = 1 << 20  # of texts encoded at once
CACHE_BYTES = 32 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Merges:
    """A rank table as arrays: all pairs of tokens that merge, and the bytes of each token. Made once, by the driver."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.width = max(ranks.values()) + 1
        found: dict[int, int] = {}
        careful = set()
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut], -1), ranks.get(token[cut:], -1)
                if left >= 0 and right >= 0:
                    found[left * self.width + right] = rank
                careful.update(part for part in (left, right) if part >= rank)
        #: tokens that join a neighbour to a token of lower rank: their places in a word must be merged one by one
        self.careful = careful
        self.codes = np.array(sorted(found), np.int64)
        self.made = np.array([found[code] for code in self.codes.tolist()], np.int32)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        names = [b""] * self.width
        for token, rank in ranks.items():
            names[rank] = token
        self.lens = np.fromiter(map(len, names), np.int64, self.width)
        self.flat = np.frombuffer(b"".join(names), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, -1 without one."""
        codes = left.astype(np.int64) * self.width + right
        if not len(self.codes):
            return np.full(len(codes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.made[at], np.int32(-1))

    def bytes_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the tokens one after the other, and where each begins (one entry more than ids)."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.width or not self.lens[ids].all()):
            raise ValueError("an id that the vocabulary does not have")
        lens = self.lens[ids]
        starts = np.cumsum(self.lens) - self.lens
        return gathered(self.flat, starts[ids], lens), np.concatenate([[0], np.cumsum(lens)])


class MergeReplay:
    """Token ids of words, as the merges of a rank table make them."""

    def __init__(self, ranks: dict[bytes, int] | Merges):
        merges = ranks if isinstance(ranks, Merges) else Merges(ranks)
        self.ranks, self.single, self.careful, self.merged = merges.ranks, merges.single, merges.careful, merges.rank
        low = merges.single
        self.byte_pairs = merges.rank(np.repeat(low, 256), np.tile(low, 256)).reshape(256, 256)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all words one after the other, and how many each has."""
        whole = np.fromiter((self.ranks.get(word, -1) for word in words), np.int64, len(words))
        sizes = np.where(whole < 0, np.fromiter(map(len, words), np.int64, len(words)), 1)
        ends = np.cumsum(sizes)
        n = int(ends[-1]) if len(words) else 0
        data = np.frombuffer(b"".join(b"\0" if at >= 0 else word for word, at in zip(words, whole.tolist(), strict=True)), np.uint8)
        symbol = self.single[data]  # token at each position; -1 once it is merged into the one before
        symbol[(ends - sizes)[whole >= 0]] = whole[whole >= 0]
        word = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        place = np.arange(n, dtype=np.int32)
        last = np.zeros(n + 1, bool)
        last[ends - 1] = True
        follow = np.where(last[:n], np.int32(-1), place + np.int32(1))
        before = np.where(np.concatenate([[True], last[: n - 1]])[:n], np.int32(-1), place - np.int32(1))
        merges = np.full(n, -1, np.int32)  # rank of the merge of a position and the next
        inner = np.flatnonzero(follow >= 0)
        merges[inner] = self.byte_pairs[data[inner], data[inner + 1]]  # what is no whole token is single bytes

        index: dict[int, list[np.ndarray]] = {}  # rank of a pair's merge -> places where the pair stands
        due: list[int] = []

        def listed(places: np.ndarray) -> None:
            ranks = merges[places]
            order = np.argsort(ranks, kind="stable")
            ranks, places = ranks[order], places[order]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(places, cuts), strict=True):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heappush(due, rank)

        if len(open_places := np.flatnonzero(merges >= 0)):
            listed(open_places)
        while due:
            rank = heappop(due)
            places = index.pop(rank)
            places = np.unique(np.concatenate(places)) if len(places) > 1 else places[0]
            places = places[merges[places] == rank]
            if not len(places):
                continue
            # of places that overlap in a row, every second one
            alone = np.ones(len(places), bool)
            alone[1:] = follow[places[:-1]] != places[1:]
            if not alone.all():
                row = np.maximum.accumulate(np.where(alone, np.arange(len(places)), 0))
                places = places[(np.arange(len(places)) - row) % 2 == 0]
            if rank in self.careful:
                owner = word[places]
                lead = np.ones(len(places), bool)
                lead[1:] = owner[1:] != owner[:-1]
                if not lead.all():
                    index[rank] = [places[~lead]]
                    heappush(due, rank)
                    places = places[lead]
            after = follow[places]
            behind = follow[after]
            symbol[places] = rank
            symbol[after] = merges[after] = merges[places] = -1
            symbol[places] = rank
            follow[places] = behind
            more = behind >= 0
            before[behind[more]] = places[more]
            ahead = before[places]
            ahead = ahead[ahead >= 0]
            touched = np.concatenate([places[more], ahead])
            if len(touched):
                merges[touched] = self.merged(symbol[touched], symbol[follow[touched]])
                touched = touched[merges[touched] >= 0]
                if len(touched):
                    listed(np.unique(touched))
        alive = symbol >= 0
        return symbol[alive].astype(np.uint32), np.bincount(word[alive], minlength=len(words))


def _coder(merges: Merges, pattern: str) -> CutCoder:
    replay = MergeReplay(merges)
    return CutCoder(WordCoder(lambda words: replay.encode([word.encode("utf-8", "surrogatepass") for word in words]), pattern), CACHE_BYTES)


def encode(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text", packed: bool = False, decoded: bool = False) -> DataFrame:
    """key, ids (array of int; with packed: bytes of unsigned 32-bit little-endian integers), with decoded also the binary
    that the ids decode to, in the same pass.

    `vocabulary` is a rank file that the driver reads; its content (a few MB) goes to the executors.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(Merges(read_ranks(vocabulary)))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = shared.value
        code = _coder(merges, pattern)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                ids, ends = code(part.column(1).to_pylist())
                columns = [part.column(0), id_lists(ids, ends, packed)]
                if decoded:
                    columns.append(_decoded(merges, ids.astype(np.int64), ends))
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "decoded"][: len(columns)])
        code.clear()

    kinds = f"key {docs.schema[key].dataType.simpleString()}, ids {'binary' if packed else 'array<int>'}" + ", decoded binary" * decoded
    return rows.mapInArrow(run, kinds).withColumnRenamed("key", key)


def _decoded(merges: Merges, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    out, total = merges.bytes_of(ids)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(total[ends].astype(np.int32)), pa.py_buffer(out)])


def decode(tokens: DataFrame, vocabulary: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """key, ids, decoded (binary: the bytes of the tokens). Null ids decode to no bytes; an unknown or null id is an error."""
    shared = tokens.sparkSession.sparkContext.broadcast(Merges(read_ranks(vocabulary)))
    kind = tokens.schema[ids].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                if kind == "binary":
                    rows = [np.frombuffer(x or b"", "<u4") for x in part.column(1).to_pylist()]
                else:
                    rows = [np.array([-1 if y is None else y for y in x or ()], np.int64) for x in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, rows)])
                decoded = _decoded(shared.value, np.concatenate([*rows, np.zeros(0, np.uint32)]).astype(np.int64), ends)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), decoded], ["key", "ids", "decoded"])

    out = tokens.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    kinds = f"key {tokens.schema[key].dataType.simpleString()}, ids {kind}, decoded binary"
    return out.mapInArrow(run, kinds).withColumnRenamed("key", key).withColumnRenamed("ids", ids)
