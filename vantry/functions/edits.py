"""Edit distances and alignments of token sequences, bit-parallel, on Arrow batches.

A column of the distance matrix is kept as whole-number bit vectors of where it rises or falls by one, so a step costs one pass over
machine words for all rows together. Tokens are words or code points. Distances of many pairs go in lanes of arrays of 64-bit words.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Column4 = tuple[int, int, int, int]  # rises and falls down the column, rises and falls from the column before


def _places(a: Sequence) -> dict:
    out: dict = {}
    for k, token in enumerate(a):
        out[token] = out.get(token, 0) | 1 << k
    return out


def _step(same: int, up: int, down: int, full: int) -> Column4:
    diagonal = (((same & up) + up) ^ up) | same | down
    right_up = (down | ~(diagonal | up)) & full
    right_down = up & diagonal
    above_up = (right_up << 1 | 1) & full
    above_down = right_down << 1 & full
    return (above_down | ~(diagonal | above_up)) & full, above_up & diagonal, right_up, right_down


def trimmed(a: Sequence, b: Sequence) -> tuple[Sequence, Sequence]:
    """Both without what they begin and end with alike."""
    n = min(len(a), len(b))
    k = 0
    while k < n and a[k] == b[k]:
        k += 1
    e = 0
    while e < n - k and a[len(a) - 1 - e] == b[len(b) - 1 - e]:
        e += 1
    return a[k : len(a) - e], b[k : len(b) - e]


def distance(a: Sequence, b: Sequence) -> int:
    """Least number of tokens to insert, delete or replace."""
    a, b = trimmed(a, b)
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return len(b)
    places, full, last, edits = _places(a), (1 << len(a)) - 1, 1 << len(a) - 1, len(a)
    up, down = full, 0
    for token in b:
        up, down, right_up, right_down = _step(places.get(token, 0), up, down, full)
        edits += bool(right_up & last) - bool(right_down & last)
    return edits


def alignment(a: Sequence, b: Sequence) -> list[tuple[int | None, int | None]]:
    """Index pairs of a least alignment; None for a token that is inserted or deleted.

    Of the least alignments it is the one that, read from the end, pairs two tokens wherever it can, deletes a token of a where it
    cannot, and inserts one of b only where it must. Every root-th column is kept and those between are made again, so memory grows
    with len(a) times the root of len(b), in bits.
    """
    full = (1 << len(a)) - 1
    places = _places(a)
    every = max(1, math.isqrt(len(b)))
    kept: list[tuple[int, int]] = []
    up, down = full, 0
    for j, token in enumerate(b):
        if j % every == 0:
            kept.append((up, down))
        up, down, _, _ = _step(places.get(token, 0), up, down, full)
    out: list[tuple[int | None, int | None]] = []
    i, j = len(a), len(b)
    block, columns = -1, []
    while i and j:
        if (j - 1) // every != block:
            block = (j - 1) // every
            up, down = kept[block]
            columns = []
            for token in b[block * every : (block + 1) * every]:
                columns.append(_step(places.get(token, 0), up, down, full))
                up, down = columns[-1][:2]
        up, down, right_up, right_down = columns[j - 1 - block * every]
        bit = 1 << i - 1
        rise = bool(up & bit) - bool(down & bit)
        before = 1 if i == 1 else bool(right_up & bit >> 1) - bool(right_down & bit >> 1)
        if rise + before == (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif rise == 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    out += [(k, None) for k in reversed(range(i))] + [(None, k) for k in reversed(range(j))]
    return out[::-1]


def words(text: str) -> list[str]:
    return [w for w in text.split(" ") if w]


WORD = 64  # rows of the matrix in a machine word
CELLS = 6144  # words that take a step together, about: their arrays stay in a core's cache
FEWEST = 24  # for fewer pairs of about one length, one after the other is faster
BAND = 128  # edits up to which the first pass looks; what has more is looked at again, four times as far
ROOM = 64 << 20  # bytes of the tables of a group, about


def _codes(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Where the tokens of each lane's a and b stand in one table of its a's distinct tokens; a b's token that a lacks stands at 0. The table's rows."""
    keys = lambda parts: np.repeat(np.arange(len(parts), dtype=np.int64), [len(x) for x in parts]) << 32 | np.concatenate(parts)
    table, of_a = np.unique(keys(a), return_inverse=True)
    wanted = keys(b)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return of_a + 1, np.where(table[at] == wanted, at + 1, 0), len(table) + 1


def _together(a: list[np.ndarray], b: list[np.ndarray], most: int) -> np.ndarray:
    """Edits of pairs by the same steps in 64-bit words, the longest b first; right where they are at most `most`, else above it.

    In step s the w-th word of rows is at column s - w, so all words of all lanes go by one set of operations. The last rows of all lanes stand
    together; rows before a lane's first neither rise nor match, which hands on what comes from above. Only words of rows about `most` from
    the diagonal are looked at: one that comes in rises by all its rows, and what lies above those left out counts as rising. Neither makes a number too small."""
    n, m = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    blocks, lanes, columns = -(-int(n.max()) // WORD), len(a), int(m[0])
    pad = blocks * WORD - n
    of_a, of_b, size = _codes(a, b)
    places = np.zeros((blocks, size), np.uint64)
    row = np.arange(len(of_a)) - np.repeat(np.cumsum(n) - n - pad, n)
    np.bitwise_or.at(places.reshape(-1), row // WORD * size + of_a, np.uint64(1) << (row % WORD).astype(np.uint64))
    code = np.zeros((columns, lanes), np.int32)
    code[np.arange(len(of_b)) - np.repeat(np.cumsum(m) - m, m), np.repeat(np.arange(lanes), m)] = of_b
    first = np.clip(pad[None, :] - WORD * np.arange(blocks)[:, None], 0, WORD)  # rows of each word before the lane's first
    up = np.where(first < WORD, ~np.uint64(0) << np.minimum(first, WORD - 1).astype(np.uint64), np.uint64(0))
    down = np.zeros((blocks, lanes), np.uint64)
    in_up, in_down = np.zeros((blocks + 1, lanes), np.uint64), np.zeros((blocks + 1, lanes), np.uint64)
    bottom = np.bitwise_count(up[0]).astype(np.int64)  # edits at the last row of the lowest word
    out = np.zeros(lanes, np.int64)
    one, top = np.uint64(1), np.uint64(WORD - 1)
    spare = [np.empty((blocks, lanes), np.uint64) for _ in range(4)]
    at = np.empty((blocks, lanes), np.int64)
    offset = (np.arange(blocks) * size)[:, None]
    flat = places.reshape(-1)
    high, active = 0, lanes
    least, greatest = int(pad.min()), int(pad.max())
    for s in range(columns + blocks - 1):
        if high < min(blocks - 1, s, (s + most + greatest) // (WORD + 1) + 1):
            high += 1
            bottom += np.bitwise_count(up[high]).astype(np.int64) - in_up[high].astype(np.int64) + in_down[high].astype(np.int64)
        above = max(0, (s - most + least) // (WORD + 1))
        low = max(above, s - columns + 1)
        k = high + 1 - low
        if low == above:
            in_up[low, :active], in_down[low, :active] = 1, 0
        u, d = up[low : high + 1, :active], down[low : high + 1, :active]
        place = np.add(code[s - high : s - low + 1, :active][::-1], offset[low : high + 1], out=at[:k, :active])
        same, x, right_up, right_down = (z[:k, :active] for z in spare)
        np.take(flat, place, out=same, mode="clip")
        np.bitwise_or(same, d, out=x)  # what moves by the diagonal without the word above
        same |= in_down[low : high + 1, :active]
        np.bitwise_and(same, u, out=right_up)
        right_up += u
        right_up ^= u
        right_up |= same
        np.bitwise_and(u, right_up, out=right_down)
        right_up |= u
        np.invert(right_up, out=right_up)
        right_up |= d
        np.right_shift(right_up, top, out=u)
        np.right_shift(right_down, top, out=d)
        right_up <<= one
        right_up |= in_up[low : high + 1, :active]
        right_down <<= one
        right_down |= in_down[low : high + 1, :active]
        in_up[low + 1 : high + 2, :active], in_down[low + 1 : high + 2, :active] = u, d
        np.bitwise_or(x, right_up, out=u)
        np.invert(u, out=u)
        u |= right_down
        np.bitwise_and(right_up, x, out=d)
        bottom[:active] += in_up[high + 1, :active].astype(np.int64) - in_down[high + 1, :active].astype(np.int64)
        while active and m[active - 1] + blocks - 1 <= s + 1:
            active -= 1
            out[active] = bottom[active] if high == blocks - 1 else most + 1
    return out


def distances(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """`distance` of each pair of token numbers (not negative, below 2^31); pairs of about one length go together."""
    out = np.zeros(len(a), np.int64)
    todo = []
    for k, (x, y) in enumerate(zip(a, b, strict=True)):
        if len(x) > len(y):
            x, y = y, x
        if not len(x) or (len(y) >= 2 * len(x) and _within(x, y)):
            out[k] = len(y) - len(x)
        else:
            todo.append((len(y), len(x), k, x, y))
    most = BAND
    while todo:
        # a band pays where it is narrower than the shorter side and can hold the answer
        near = [r for r in todo if r[0] - r[1] <= most and 3 * most < r[1]]
        rest = [r for r in todo if not (r[0] - r[1] <= most and 3 * most < r[1])]
        later = [r for r in rest if 12 * most < r[1] and r[0] - r[1] <= r[1] // 4]
        whole = [r for r in rest if not (12 * most < r[1] and r[0] - r[1] <= r[1] // 4)]
        todo = later
        for group, reach in [(g, most) for g in _groups(near, 2 * most, 4 * most)] + [(g, None) for g in _groups(whole)]:
            if len(group) < FEWEST:
                for r in group:
                    out[r[2]] = distance(r[3].tolist(), r[4].tolist())
                continue
            found = _together([r[3] for r in group], [r[4] for r in group], reach or group[0][0] + group[0][1])
            for r, edits in zip(group, found.tolist(), strict=True):
                if reach is None or edits <= reach:
                    out[r[2]] = edits
                else:
                    todo.append(r)
        most *= 4
    return out


def _within(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether b has a's tokens in their order: then nothing but the rest of b is inserted, and no alignment can do with less."""
    rest = iter(b.tolist())
    return all(token in rest for token in a.tolist())


def _groups(rows: list[tuple], step: int = 1 << 31, band: int = 1 << 31) -> Iterator[list[tuple]]:
    """The longest first; the lengths of a group lie within a factor of two, those of its shorter sides within `step`, its words (rows of a band alone) in CELLS and its tables in ROOM."""
    group: list[tuple] = []
    size = wide = 0
    for r in sorted(rows, key=lambda r: (-(r[1] // step), -r[0], r[2])):
        size, wide = size + r[1], max(wide, r[1])
        full = group and (len(group) * min(wide, band) // WORD >= CELLS or size * -(-wide // WORD) * 8 > ROOM)
        if group and (full or 2 * r[0] < group[0][0] or r[1] // step != group[0][1] // step):
            yield group
            group, size, wide = [], r[1], r[1]
        group.append(r)
    if group:
        yield group


def _points(texts: list[str]) -> list[np.ndarray]:
    return [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64) for t in texts]


def _numbers(texts: list[str]) -> list[np.ndarray]:
    known: dict[str, int] = {}
    return [np.array([known.setdefault(w, len(known)) for w in words(t)], np.int64) for t in texts]


def _counted(numbered):
    def run(refs: pd.Series, hyps: pd.Series) -> pd.Series:
        both = [(r, h) for r, h in zip(refs, hyps, strict=True) if r is not None and h is not None]
        tokens = numbered([r for r, _ in both] + [h for _, h in both])
        pairs = [trimmed_arrays(x, y) for x, y in zip(tokens[: len(both)], tokens[len(both) :], strict=True)]
        found = iter(distances([x for x, _ in pairs], [y for _, y in pairs]).tolist())
        return pd.Series([None if r is None or h is None else next(found) for r, h in zip(refs, hyps, strict=True)], dtype="Int64")

    return run


def trimmed_arrays(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`trimmed` of arrays."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    k = int(differ[0]) if len(differ) else n
    left = n - k
    differ = np.flatnonzero(a[len(a) - left :][::-1] != b[len(b) - left :][::-1])
    e = int(differ[0]) if len(differ) else left
    return a[k : len(a) - e], b[k : len(b) - e]


def word_edits(ref: Column, hyp: Column) -> Column:
    """Edits between words, which blanks part; null for nulls."""
    return F.pandas_udf(_counted(_numbers), "long")(ref, hyp)


def char_edits(ref: Column, hyp: Column) -> Column:
    """Edits between code points; null for nulls."""
    return F.pandas_udf(_counted(_points), "long")(ref, hyp)


def aligned_words(pairs: DataFrame) -> DataFrame:
    """pairs (id, ref, hyp) as rows (id, step, ref_word, hyp_word): deleted words have no hyp_word, inserted ones no ref_word. Pairs with a null have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ref, hyp = batch.column(1)[row].as_py(), batch.column(2)[row].as_py()
                if ref is None or hyp is None:
                    continue
                a, b = words(ref), words(hyp)
                path = alignment(a, b)
                ids = batch.column(0).take(pa.array([row] * len(path), pa.int64()))
                columns = [ids, pa.array(range(len(path)), pa.int64()), pa.array([None if i is None else a[i] for i, _ in path], pa.string()), pa.array([None if j is None else b[j] for _, j in path], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "step", "ref_word", "hyp_word"])

    kind = pairs.schema["id"].dataType.simpleString()
    return pairs.select("id", "ref", "hyp").mapInArrow(run, f"id {kind}, step long, ref_word string, hyp_word string")


def substitution_pairs(pairs: DataFrame) -> DataFrame:
    """ref_word, hyp_word, n, share: how often one word stands for another in pairs (id, ref, hyp), and in what part of the places where
    the reference has that word. Which least alignment counts is stated at `alignment`."""
    steps = aligned_words(pairs).where("ref_word is not null").groupBy("ref_word", "hyp_word").agg(F.count("*").alias("n"))
    total = steps.groupBy("ref_word").agg(F.sum("n").alias("of"))
    return steps.where("hyp_word is not null and hyp_word <> ref_word").join(total, "ref_word").select("ref_word", "hyp_word", "n", (F.col("n") / F.col("of")).alias("share"))
