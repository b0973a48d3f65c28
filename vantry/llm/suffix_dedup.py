"""Removal of repeated byte strings by a distributed merge sort of suffixes.

Each byte that lies in a string of `length` bytes which also starts anywhere else is removed.
Strings never cross texts, and are judged on the input.

1. Anchors. Of the GRAM-byte substrings in each `length`-byte window, the one with the least
   hash (the leftmost of equals) is the window's anchor, so equal windows have anchors at equal
   places. A task lists its anchors with the windows that they own.
2. Anchor hashes are counted, each once from each batch unless it repeats there. Only anchors
   whose gram occurs again stay; texts and anchors meet by a join on the key.
3. Sorted runs. A task takes the suffixes that start at its anchors (the bytes of the windows
   before the anchor follow as the last part of the order), keeps one of equal ones with its
   owners, deals them into ranges by the gram hash, sorts each, and sends front-coded runs: for
   each suffix the length of the prefix it shares with the one before, and the rest.
4. Merge. Each range is merged by a loser tree over the runs. Entries carry the length of the
   prefix that they share with the last output, so comparisons start after it and known prefixes
   are never compared again. Suffixes that share GRAM bytes come out together.
5. The common prefixes decide. A window that begins k bytes before its anchor is its entry's
   first length - k bytes and the k bytes before; two are equal if the common prefix of their
   entries in merged order reaches length - k and, in the order of what stands before the anchor,
   their common end reaches k. No window is compared as a whole, and none by a hash.

Equal suffixes collapse in their task before they travel. A gram of more than HOT occurrences is
split: each piece of its windows (PIECES of them, by k) is sent by the hash of the bytes that all
windows of the piece hold, at least `length` less (length - gram) / PIECES of them. A passage as long as that but shorter than a window, with
other bytes around it in each text, would still meet in one range; so the different forms of such pieces are counted too, and a
piece of more than HOT forms is sent window by window, by the hash of the window. What then meets in a range is equal as a whole, and
collapses in its tasks. Such pieces reach the tasks as a bitmap of PLACES bits: one set by chance splits a piece that need not be, and decides nothing.

Null texts count as empty. Equal rows repeat each other's bytes and lose them. Rows without a key
are treated like others. Other columns, whatever their names, are not carried. An empty table
gives no rows.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.chunks import slices
from vantry.llm.scratch import dropped, hinted, small_batches, written

LENGTH = 200
GRAM = 64
HOT = 20_000
PIECES = 8
GROUP = 20_000  # entries compared at once
ODD = np.uint64(0x9E3779B97F4A7C15)
SEGMENT = 1 << 20
PLACES = 1 << 24  # of hashes of hot pieces


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from each position (fewer positions than bytes by size - 1)."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    table = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * ODD)
    power: dict[int, np.ndarray] = {1: table[data]}
    step = 1
    base = pow(0xD6E8FEB86659FD93, 1, 1 << 64)
    bases = {1: base}
    while step * 2 <= size:
        whole = power[step]
        power[step * 2] = whole[:-step] * np.uint64(bases[step]) + whole[step:]
        bases[step * 2] = pow(bases[step], 2, 1 << 64)
        step *= 2
    out, done = power[step], step
    for part in sorted((p for p in power if p < step), reverse=True):
        if done + part <= size:
            n = len(data) - done - part + 1
            out = out[:n] * np.uint64(bases[part]) + power[part][done : done + n]
            done += part
    return mixed(out)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` values in a row."""
    step, out = 1, values
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    return np.minimum(out[: len(out) - (width - step)], out[width - step :]) if width > step else out


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Number of the text, gram hash, place of the anchor, first and last window that it owns there."""
    pieces = [(k, at) for k, text in enumerate(texts) for at in range(0, len(text) - length + 1, SEGMENT)]
    found: list[tuple[np.ndarray, ...]] = []
    begin = 0
    while begin < len(pieces):
        parts, size, end = [], 0, begin
        while end < len(pieces) and (not parts or size < SEGMENT):
            k, at = pieces[end]
            parts.append(texts[k][at : at + SEGMENT + length - 1])
            size += len(parts[-1])
            end += 1
        data = np.frombuffer(b"".join(parts), np.uint8)
        lens = np.array([len(x) for x in parts])
        edge = np.concatenate([[0], np.cumsum(lens)])
        piece = np.repeat(np.arange(len(parts)), lens)
        hashes = rolling(data, gram)
        low = least((hashes & ~np.uint64(0x3FFFFF)) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
        start = np.flatnonzero(piece[: len(low)] == piece[length - 1 :][: len(low)])
        place = (low[start] & np.uint64(0x3FFFFF)).astype(np.int64)
        owner = piece[start]
        head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])]))
        tail = np.concatenate([head[1:], [len(start)]]) - 1
        who = np.array([k for k, _ in pieces[begin:end]])[owner[head]]
        shift = np.array([at for _, at in pieces[begin:end]])[owner[head]] - edge[owner[head]]
        found.append((who, hashes[place[head]].astype(np.int64), place[head] + shift, start[head] + shift, start[tail] + shift))
        begin = end
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else tuple(np.zeros(0, np.int64) for _ in range(5))


def shared_prefix(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix, known to be at least `start`."""
    n = min(len(a), len(b))
    if a[start:n] == b[start:n]:
        return n
    low, step = start, 32
    while a[low : low + step] == b[low : low + step]:
        low += step
    while a[low] == b[low]:
        low += 1
    return low


def front_coded(strings: list[bytes]) -> Iterator[bytes]:
    before = b""
    for string in strings:
        same = shared_prefix(before, string, 0)
        yield struct.pack("<II", same, len(string) - same)
        yield string[same:]
        before = string


class Run:
    """Entries of a front-coded run, one after the other: string, prefix shared with the one before."""

    def __init__(self, coded: bytes):
        self.coded, self.at, self.count = coded, 0, 0
        self.string, self.same = b"", 0

    def advance(self) -> bool:
        if self.at >= len(self.coded):
            return False
        same, more = struct.unpack_from("<II", self.coded, self.at)
        self.at += 8
        self.string = self.string[:same] + self.coded[self.at : self.at + more]
        self.at += more
        self.same = same
        self.count += 1
        return True


class LoserTree:
    """Merge of sorted runs. Each entry in play knows the prefix it shares with the last string put out:
    of two entries, the one that shares more comes first; if they share as much, they are compared from there on."""

    def __init__(self, runs: list[Run]):
        self.runs = runs
        self.live = [run.advance() for run in runs]
        self.known = [0] * len(runs)  # prefix shared with the last output
        self.size = max(1, len(runs))
        self.losers = [-1] * self.size
        self.winner = self._build(1) if len(runs) > 1 else 0

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        return self._play(node, self._build(2 * node), self._build(2 * node + 1))

    def _play(self, node: int, a: int, b: int) -> int:
        """The winner of two runs; the loser stays at the node."""
        if not self.live[b]:
            first, second = a, b
        elif not self.live[a]:
            first, second = b, a
        elif self.known[a] != self.known[b]:
            first, second = (a, b) if self.known[a] > self.known[b] else (b, a)
        else:
            x, y = self.runs[a].string, self.runs[b].string
            same = shared_prefix(x, y, self.known[a])
            first, second = (a, b) if x[same : same + 1] < y[same : same + 1] or (same == len(x) and same == len(y) and a < b) else (b, a)
            self.known[second] = same  # what it shares with the winner, which goes out before it
        self.losers[node] = second
        return first

    def __iter__(self) -> Iterator[tuple[int, int, bytes, int]]:
        """Run, entry of the run, string, prefix shared with the string before."""
        while self.runs and self.live[self.winner]:
            top = self.winner
            run = self.runs[top]
            yield top, run.count - 1, run.string, self.known[top]
            self.live[top] = run.advance()
            self.known[top] = run.same
            node = (top + self.size) // 2
            current = top
            while node:
                current = self._play(node, self.losers[node], current)
                node //= 2
            self.winner = current


RUNS = "part int, rights array<int>, counts array<int>, keys array<bigint>, marks array<bigint>, firsts array<int>, payload binary"
RUNS_ARROW = pa.schema(
    [("part", pa.int32()), ("rights", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("keys", pa.list_(pa.int64()))]
    + [("marks", pa.list_(pa.int64())), ("firsts", pa.list_(pa.int32())), ("payload", pa.binary())]
)


def pieces(right: bytes, left: bytes, length: int, gram: int, step: int) -> Iterator[tuple[bytes, bytes, int]]:
    """(right, left, bytes skipped of the left) of the parts, of `step` windows at most, that an anchor's windows are sent in."""
    low, high = length - len(right), len(left)
    for begin in range(low - low % step, high + 1, step):
        a, b = max(low, begin), min(high, begin + step - 1)
        yield right[: length - a], left[len(left) - b :], high - b


def context(right: bytes, left: bytes, length: int, gram: int, step: int) -> int:
    """Hash of the bytes around a hot anchor that all windows of its piece hold, by the piece's place. Of a piece of one window, all of it."""
    begin = len(left) // step * step
    end = min(begin + step - 1, length - gram)
    return xxhash.xxh3_64_intdigest(left[len(left) - begin :] + right[: length - end], begin)


def hot_pieces(right: bytes, left: bytes, length: int, gram: int, filled: np.ndarray | None) -> Iterator[tuple[bytes, bytes, int, int]]:
    """(right, left, bytes skipped of the left, hash to be sent by) of a hot anchor's pieces; those whose place in `filled` is set go window by window."""
    step = -(-(length - gram + 1) // PIECES)
    for a, b, skipped in pieces(right, left, length, gram, step):
        where = context(a, b, length, gram, step)
        if filled is None or not filled[where % PLACES >> 3] >> (where & 7) & 1:
            yield a, b, skipped, where
            continue
        for x, y, more in pieces(a, b, length, gram, 1):
            yield x, y, skipped + more, context(x, y, length, gram, 1)


def sorted_runs(batches: Iterator[pa.RecordBatch], length: int, gram: int, parts: int, filled: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
    """The front-coded run of each range that the task's anchors reach, and the owners of each entry (text and first window)."""
    owners: dict[tuple[bytes, bytes, int], list[tuple[int, int, int]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            data = row["text"].encode()
            for anchor in row["anchors"]:
                place, first = anchor["place"], anchor["first"]
                whole = data[place : anchor["last"] + length], data[first:place]
                for right, left, skipped, where in hot_pieces(*whole, length, gram, filled) if anchor["hot"] else [(*whole, 0, anchor["hash"] >> 20)]:
                    owners.setdefault((right, left, where % parts), []).append((row["key"], row["mark"], first + skipped))
    ranges: dict[int, list[tuple[bytes, int, list]]] = {}
    for (right, left, part), who in owners.items():
        ranges.setdefault(part, []).append((right + left, len(right), who))
    owners.clear()
    for part in list(ranges):
        mine = ranges.pop(part)
        mine.sort(key=lambda x: x[:2])
        keys, marks, firsts = zip(*(w for _, _, who in mine for w in who), strict=True)
        row = {"part": part, "rights": [r for _, r, _ in mine], "counts": [len(who) for _, _, who in mine], "keys": keys, "marks": marks, "firsts": firsts}
        yield pa.RecordBatch.from_pylist([row | {"payload": b"".join(front_coded([x for x, _, _ in mine]))}], RUNS_ARROW)


def repeated_windows(strings: list[bytes], rights: np.ndarray, counts: np.ndarray, same: np.ndarray, length: int, gram: int) -> Iterator[tuple[int, list[int]]]:
    """(entry, edges): windows of an entry that occur again, as begins and ends counted from its first window.

    Entries stand in merged order; same: the prefix that each shares with the one before.
    """
    n = len(strings)
    group = np.cumsum(same < gram)
    lefts = [string[right:][::-1] for string, right in zip(strings, rights.tolist(), strict=True)]
    numbers = group.tolist()
    order = sorted(range(n), key=lambda k: (numbers[k], lefts[k]))
    ends = np.array([-1] + [shared_prefix(lefts[a], lefts[b], 0) if numbers[a] == numbers[b] else -1 for a, b in zip(order, order[1:], strict=False)])
    order = np.array(order)
    low, high = length - rights, np.fromiter(map(len, lefts), np.int64, n)
    places = np.arange(n)
    again = np.zeros((n, length - gram + 3), np.int8)  # a gap on either side
    for k in range(length - gram + 1):
        own = np.flatnonzero((low <= k) & (k <= high))
        if not len(own):
            continue
        head = np.maximum.accumulate(np.where(same < length - k, places, 0))
        tail = np.zeros(n, np.int64)
        tail[order] = np.maximum.accumulate(np.where(ends < k, places, 0))
        _, back = np.unique(head[own] * n + tail[own], return_inverse=True)
        again[own, high[own] - k + 1] = np.bincount(back, weights=counts[own])[back] >= 2
    change = np.diff(again, axis=1)
    rows, begins = np.nonzero(change > 0)
    _, stops = np.nonzero(change < 0)
    found: dict[int, list[int]] = {}
    for k, begin, stop in zip(rows.tolist(), begins.tolist(), stops.tolist(), strict=True):
        found.setdefault(k, []).extend((begin, stop))
    yield from found.items()


def merged_intervals(runs: list[dict], length: int, gram: int) -> Iterator[tuple[int, int, list[int]]]:
    """(run, entry, edges) of the entries with windows that occur again."""
    ready: list[tuple[int, int, bytes, int]] = []
    group: list[tuple[int, int, bytes, int]] = []

    def compared() -> Iterator[tuple[int, int, list[int]]]:
        if ready:
            rights = np.array([runs[run]["rights"][entry] for run, entry, _, _ in ready])
            counts = np.array([runs[run]["counts"][entry] for run, entry, _, _ in ready])
            same = np.array([x for _, _, _, x in ready])
            for k, edges in repeated_windows([x for _, _, x, _ in ready], rights, counts, same, length, gram):
                yield ready[k][0], ready[k][1], edges
            ready.clear()

    def close() -> None:
        if len(group) > 1 or (group and runs[group[0][0]]["counts"][group[0][1]] > 1):
            ready.extend([(*group[0][:3], 0), *group[1:]])
        group.clear()

    for run, entry, string, same in LoserTree([Run(r["payload"]) for r in runs]):
        if same < gram:
            close()
            if len(ready) > GROUP:
                yield from compared()
        group.append((run, entry, string, same))
    close()
    yield from compared()


def repeated_grams(docs: DataFrame, length: int, gram: int, parts: int) -> DataFrame:
    """hash, hot of the anchor grams that occur more than once."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                _, found, *_ = anchors([t.encode() for t in part.column(0).to_pylist()], length, gram)
                one, counts = np.unique(found, return_counts=True)
                for few in (True, False):  # the count travels only with those that repeat here
                    mine = (counts == 1) == few
                    yield pa.RecordBatch.from_arrays([pa.array(one[mine]), pa.nulls(int(mine.sum()), pa.int64()) if few else pa.array(counts[mine])], ["hash", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            hashes.append(batch.column(0).to_numpy())
            counts.append(batch.column(1).fill_null(1).to_numpy())
        one, back = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate(counts), minlength=len(one))
        yield pa.RecordBatch.from_arrays([pa.array(one[total > 1]), pa.array(total[total > 1] > HOT)], ["hash", "hot"])

    return docs.select("text").mapInArrow(hashed, "hash long, n long").repartition(parts, "hash").mapInArrow(counted, "hash long, hot boolean")


def marked(hashes: DataFrame) -> np.ndarray:
    """PLACES bits, set at the hashes."""
    place = F.col("hash").bitwiseAND(PLACES - 1)
    rows = hashes.groupBy(F.shiftright(place, 15).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits")).collect()  # PLACES bits at most
    out = np.zeros((PLACES >> 15, 4096), np.uint8)
    for r in rows:
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def crowded(docs: DataFrame, hot: DataFrame, length: int, gram: int) -> np.ndarray:
    """Bits at the hashes of the pieces of hot grams (hash) that come in more than HOT different forms.

    Texts are read again where they lie; anchors that a bitmap of the hot grams lets pass by chance are counted as well, which no hot one notices."""
    shared = docs.sparkSession.sparkContext.broadcast(marked(hot))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled = shared.value
        for batch in batches:
            for part in slices(batch, 0):
                texts = [t.encode() for t in part.column(0).to_pylist()]
                who, grams, *spots = anchors(texts, length, gram)
                place = grams.astype(np.int64) & (PLACES - 1)
                mine = np.flatnonzero(filled[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                found: set[tuple[int, int]] = set()
                for k, at, first, last in zip(*(x[mine].tolist() for x in (who, *spots)), strict=True):
                    data = texts[k]
                    for right, left, _, where in hot_pieces(data[at : last + length], data[first:at], length, gram, None):
                        found.add((where, xxhash.xxh3_64_intdigest(right + left, len(left))))
                pairs = np.array(list(found), np.uint64).reshape(-1, 2).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["hash", "form"])

    forms = docs.select("text").mapInArrow(hashed, "hash long, form long").distinct()
    return marked(forms.groupBy("hash").count().where(F.col("count") > HOT))


def spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """key, mark, edges: begins and ends of the runs of bytes that go, for each text (key, mark, text) that loses any."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                who, hashed, place, first, last = anchors([t.encode() for t in part.column(2).to_pylist()], length, gram)
                rows = part.select([0, 1]).take(pa.array(who))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(hashed), *(pa.array(x.astype(np.int32)) for x in (place, first, last))], ["key", "mark", "hash", "place", "first", "last"])

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(12, size >> 24))  # a range for each 16 MB of text
    common = written(repeated_grams(docs, length, gram, parts), "grams")
    found = docs.select("key", "mark", "text").mapInArrow(listed, "key long, mark long, hash long, place int, first int, last int")
    filled = None
    if not (hot := common.where("hot")).isEmpty():
        filled = docs.sparkSession.sparkContext.broadcast(crowded(docs, hot, length, gram))
    kept = found.join(hinted(common, 9), "hash").groupBy("key", "mark").agg(F.collect_list(F.struct("hash", "hot", "place", "first", "last")).alias("anchors"))
    runs = docs.select("key", "mark", "text").join(kept, ["key", "mark"]).mapInArrow(lambda batches: sorted_runs(batches, length, gram, parts, filled and filled.value), RUNS)

    def merge(table: pa.Table) -> pa.Table:
        rows = table.drop_columns(["keys", "marks", "firsts"]).to_pylist()
        owners = [table.column(c) for c in ("keys", "marks", "firsts")]
        begins = [np.concatenate([[0], np.cumsum(r["counts"], dtype=np.int64)]) for r in rows]
        out: list[list] = [[], [], []]
        for run, entry, edges in merged_intervals(rows, length, gram):
            a, b = int(begins[run][entry]), int(begins[run][entry + 1])
            keys, marks, firsts = (x[run].values.slice(a, b - a).to_numpy() for x in owners)
            out[0].append(keys)
            out[1].append(marks)
            out[2] += list(np.array(edges, np.int32)[None] + firsts[:, None])
        lists = pa.array(out[2], pa.list_(pa.int32()))
        return pa.table({"key": np.concatenate([*out[0], np.zeros(0, np.int64)]), "mark": np.concatenate([*out[1], np.zeros(0, np.int64)]), "edges": lists})

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_united(np.array(x).reshape(-1, 2), length) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.list_(pa.int32()))], ["key", "mark", "edges"])

    merged = runs.groupBy("part").applyInArrow(merge, "key long, mark long, edges array<int>")
    each = merged.groupBy("key", "mark").agg(F.flatten(F.collect_list("edges")).alias("edges"))
    out = written(each.mapInArrow(joined, "key long, mark long, edges array<int>"), "spans")
    dropped(common)
    return out


def _united(windows: np.ndarray, length: int) -> np.ndarray:
    """Begins and ends of the bytes that windows starting in [begin, end) cover, without overlaps."""
    windows = windows[np.argsort(windows[:, 0], kind="stable")]
    begins, ends = windows[:, 0], np.maximum.accumulate(windows[:, 1] - 1 + length)
    fresh = np.concatenate([[True], begins[1:] > ends[:-1]])
    return np.stack([begins[fresh], ends[np.append(np.flatnonzero(fresh)[1:] - 1, len(ends) - 1)]], axis=1).ravel()


def keep_unrepeated(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, broadcast_bytes: int = 32 << 20) -> DataFrame:
    """key, n_bytes, n_removed, n_spans (long; maximal removed runs), kept (binary: the remaining bytes) of every row.

    Rows are told apart by key and a hash of key and text. Removed runs return to the texts by a broadcast while they have at
    most `broadcast_bytes`, else by a shuffled join.
    """
    small_batches(docs.sparkSession)
    body = F.coalesce(F.col(text), F.lit(""))
    number = F.col(key).cast("long")
    rows = docs.select(number.alias("own"), F.coalesce(number, F.lit(0)).alias("key"), F.xxhash64(body, number).alias("mark"), body.alias("text"))
    side = hinted(spans(rows, length, gram), 40, "edges", most=broadcast_bytes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                total, gone, runs, kept = [], [], [], []
                for value, edges in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    data, edges = value.encode(), edges or []
                    total.append(len(data))
                    gone.append(sum(edges[1::2]) - sum(edges[::2]))
                    runs.append(len(edges) // 2)
                    kept.append(b"".join(data[a:b] for a, b in zip([0, *edges[1::2]], [*edges[::2], len(data)], strict=True)))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in (total, gone, runs)), pa.array(kept, pa.binary())], ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    joined = rows.join(side, ["key", "mark"], "left").select("own", "text", "edges")
    return joined.mapInArrow(cut, "key long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("key", key)
