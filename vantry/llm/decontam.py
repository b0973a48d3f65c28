"""Benchmark decontamination by templates.

Texts become templates: numbers, units and names are replaced by typed placeholders, other words
are case-folded and stripped of punctuation at their ends. A second, case-free view types numbers and
units only, so that a copy in other letter case meets its item even if capitals make or hide names. Windows of WINDOW template words (a
whole item where it is shorter) of all benchmark items are joined by hash with the windows of all documents. A hit counts only if its slots are consistent:
within the window each benchmark value stands for one document value of the same type and each
document value for one benchmark value. So a question with other numbers or names is caught,
while a window whose slots contradict each other is not. The same holds over the whole item: a document's
windows of an item are taken along each diagonal (place in the document less place in the item), and one that contradicts the slots of
those taken before is dropped; then the diagonals are joined, the one that kept the most places first (of equals the least), by the same rule.
So a copy with one value changed in two ways has only the windows of the first way, while of several copies in a document, each
with its own values, the one that keeps most has all of these.

A document is contaminated with an item if consistent windows cover at least COVER of the
item's windows: those of the first view, or those of either view (a window counts once). Windows made of placeholders and fewer than PLAIN plain words are not used. An item that has no
other, and one of fewer than SHORTEST words, is looked for word by word instead, values and all, in any
letter case (a third view); one of fewer than SHORTEST words must also stand as a sentence of its own.

The benchmark's windows are written once. A bitmap of their hashes, of 16 MB at most, goes to all tasks,
and only document windows that it lets pass are sent on. They meet the benchmark's by a broadcast while
those have at most `broadcast_bytes`, else in a shuffled join.

Null and empty texts have no windows and are clean. Repeated rows get repeated results; equal
items are told apart by their ids. `contaminated` gives a row for each key: rows without one count as one document there, as do rows
that share one. `judged` needs no key: it judges each row by its text.
Other columns are not used, so their names cannot clash. Empty tables give no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.chunks import slices
from vantry.llm.scratch import BROADCAST_BYTES, hinted, small_batches, written

WINDOW = 10
SHORTEST = 4
COVER = 0.5
PLAIN = 3

# Units that follow a number.
UNITS = frozenset(
    "mm cm m km inch inches ft foot feet yard yards mile miles mg g kg gram grams kilogram kilograms lb lbs pound pounds oz ounce ounces "
    "ml l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks month months "
    "year years dollar dollars euro euros cent cents percent % mph kmh hz khz mhz ghz w kw mw v kv j kj pa kpa n k c f degree degrees".split()
)
NUMBER = re.compile(r"[-+$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%)?\Z")
STRIP = "\"'`.,;:!?()[]{}<>|*_~“”‘’«»…-–—"
KINDS = ("word", "number", "unit", "name")
EXACT = np.uint64(0x5851F42D4C957F2D)  # sets the hashes of the third view apart
MOST_BITS = 27  # of places in the bitmap of hashes
WORD_BYTES = 24 << 20  # words that a task keeps
WORD_WEIGHT = 240  # of a kept word, besides its text
SLICE_BYTES = 1 << 20  # of texts looked at together


class Words(dict):
    """(hash of the template word, kind, hash of the value, ends a sentence, case-free hash and kind) of words as they stand in a text; bounded."""

    def __missing__(self, word: str) -> int:
        found = self[word] = len(self.rows) // 6
        self.weight += len(word) + WORD_WEIGHT
        bare = word.strip(STRIP)
        low = bare.casefold()
        template = value = free = _hash(low)
        kind = free_kind = 0
        digits = not bare.isalpha()  # perhaps; letters alone are no number
        if digits and NUMBER.match(bare):
            kind, template = 1, NUMBER_HASH
        elif low in UNITS:
            kind = free_kind = 2
            template = free = UNIT_HASH
        elif bare and bare[0].isupper() and (len(bare) == 1 or not bare.isupper()):
            kind, template = 3, NAME_HASH  # a name unless it opens a sentence
        if digits and NUMBER.match(low):
            free, free_kind = NUMBER_HASH, 1
        self.rows.extend((template, kind, value, word[-1:] in ".!?:|" or "\n" in word, free, free_kind))
        return found

    def __init__(self):
        super().__init__()
        self.rows = array("Q")  # six a word
        self.weight = 0


def _hash(word: str) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))


NUMBER_HASH, UNIT_HASH, NAME_HASH = map(_hash, ("<number>", "<unit>", "<name>"))


def templates(texts: list[str], words: Words) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template hash and kind of each word in either view, its value hash, where each text begins among the words,
    and whether a word opens or ends a sentence."""
    if words.weight > WORD_BYTES:
        words.clear()
        words.rows = array("Q")
        words.weight = 0
    codes: list[int] = []
    ends = [0]
    get = words.__getitem__
    for text in texts:
        codes.extend(map(get, text.split()))
        ends.append(len(codes))
    at = np.array(codes, np.int64)
    rows = np.frombuffer(words.rows, np.uint64).reshape(-1, 6)[at]
    template, kind, value, stop = rows[:, 0], rows[:, 1].astype(np.uint8), rows[:, 2], rows[:, 3].astype(bool)
    starts = np.array(ends, np.int64)
    opens = np.concatenate([[True], stop[:-1]])[: len(at)]
    opens[starts[:-1][starts[:-1] < len(at)]] = True
    common = (kind == 3) & opens  # a capital at the start of a sentence says nothing
    template = np.where(common, value, template)
    kind = np.where(common, np.uint8(0), kind)
    stop[starts[1:][starts[1:] > 0] - 1] = True
    return [(template, kind), (rows[:, 4], rows[:, 5].astype(np.uint8))], value, starts, opens, stop


def window_hashes(template: np.ndarray, size: int) -> np.ndarray:
    n = len(template) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out = (out ^ template[j : n + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


class Slots:
    """A one-to-one map of values within each type, from the windows that were taken."""

    def __init__(self):
        self.there: dict[tuple[int, int], int] = {}
        self.back: dict[tuple[int, int], int] = {}

    def take(self, kinds: bytes, ours: bytes, theirs: bytes) -> bool:
        """Whether a window's slots fit each other and the map; those that fit are added, of others nothing."""
        there: dict[tuple[int, int], int] = {}
        back: dict[tuple[int, int], int] = {}
        if any(kinds):
            for kind, a, b in zip(kinds, np.frombuffer(ours, np.uint64).tolist(), np.frombuffer(theirs, np.uint64).tolist(), strict=True):
                if not kind:
                    continue
                if self.there.get((kind, a), b) != b or self.back.get((kind, b), a) != a or there.setdefault((kind, a), b) != b or back.setdefault((kind, b), a) != a:
                    return False
        self.there |= there
        self.back |= back
        return True


def item_windows(items: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, at, size, view, of and any_of (usable windows of the item in the first view and in either), hash, kinds and values of every
    usable window; those that both views see alike are listed with the first."""
    rows = items.select(F.col(key).cast("long").alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            out: list[tuple] = []
            views, value, starts, *_ = templates(batch.column(1).to_pylist(), words)
            for k, item in enumerate(batch.column(0).to_pylist()):
                a, b = int(starts[k]), int(starts[k + 1])
                if a == b:
                    continue
                size = min(WINDOW, b - a)
                found: list[dict[int, tuple]] = []
                for template, kind in views:
                    found.append({
                        at: (hashed, kind[a + at : a + at + size].tobytes(), value[a + at : a + at + size].tobytes())
                        for at, hashed in enumerate(window_hashes(template[a:b], size).astype(np.int64).tolist())
                        if b - a >= SHORTEST and int((kind[a + at : a + at + size] == 0).sum()) >= min(PLAIN, size)
                    })
                if not found[0] and not found[1]:
                    hashed = (window_hashes(value[a:b], size) ^ EXACT).astype(np.int64).tolist()
                    out += [(item, at, size, 2, 0, len(hashed), h, bytes(size), value[a + at : a + at + size].tobytes()) for at, h in enumerate(hashed)]
                    continue
                of, any_of = len(found[0]), len(found[0].keys() | found[1].keys())
                out += [(item, at, size, view, of, any_of, *rest) for view in (0, 1) for at, rest in found[view].items() if not view or found[0].get(at) != rest]
            columns = list(zip(*out, strict=True)) if out else [[]] * 9
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.binary(), pa.binary()), strict=True)], ["item", "at", "size", "view", "of", "any_of", "hash", "kinds", "values"])

    return rows.mapInArrow(run, "item long, at int, size int, view int, of int, any_of int, hash long, kinds binary, values binary")


def bitmap(windows: DataFrame) -> np.ndarray:
    """Bits at the low ends of the windows' hashes; 256 places a window, 2 ** MOST_BITS at most."""
    bits = min(MOST_BITS, max(18, windows.count().bit_length() + 8))
    place = F.col("hash").bitwiseAND((1 << bits) - 1)
    parts = windows.groupBy(F.shiftright(place, 15).alias("part")).agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bits")).collect()  # 4,096 of 4 KB at most
    out = np.zeros((1 << bits - 15, 4096), np.uint8)
    for r in parts:
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def hits(docs: DataFrame, windows: DataFrame, key: str = "doc_id", text: str = "text", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """key, item, at and view (of the item's window), of, any_of, doc_at (word of the document): the consistent windows.

    windows: a written table of item_windows."""
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    shapes = sorted((r["size"], r["exact"]) for r in windows.groupBy("size").agg(F.bool_or(F.col("view") == 2).alias("exact")).collect())  # 1 to WINDOW
    shared = spark.sparkContext.broadcast(bitmap(windows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, filled = Words(), shared.value
        low = np.uint64(8 * len(filled) - 1)
        for batch in batches:
            for part in slices(batch, 1, SLICE_BYTES):
                views, value, starts, opens, stop = templates(part.column(1).to_pylist(), words)
                plain = np.zeros(len(value), np.uint8)
                owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                for size, exact in shapes:
                    first = None
                    for view, (template, kinds) in enumerate([*views, (value, plain)][: 3 if exact else 2]):
                        hashed = window_hashes(template, size)
                        inside = owner[: len(hashed)] == owner[size - 1 :][: len(hashed)]
                        if view == 2:
                            hashed = hashed ^ EXACT
                            if size < SHORTEST:
                                inside = inside & opens[: len(hashed)] & stop[size - 1 :][: len(hashed)]
                        elif view == 1:
                            inside &= hashed != first  # the other windows are the same in both views
                        first = hashed
                        place = hashed & low
                        inside &= (filled[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0
                        at = np.flatnonzero(inside)
                        hashed = hashed.astype(np.int64)
                        if not len(at):
                            continue
                        yield pa.RecordBatch.from_arrays(
                            [
                                part.column(0).take(pa.array(owner[at])),
                                pa.array((at - starts[owner[at]]).astype(np.int32)),
                                pa.array(np.full(len(at), size, np.int32)),
                                pa.array(hashed[at]),
                                pa.array([kinds[a : a + size].tobytes() for a in at], pa.binary()),
                                pa.array([value[a : a + size].tobytes() for a in at], pa.binary()),
                            ],
                            ["key", "doc_at", "size", "hash", "kinds", "doc_values"],
                        )

    found = rows.mapInArrow(run, f"key {kind}, doc_at int, size int, hash long, kinds binary, doc_values binary")
    side = windows.select("item", "at", "view", "of", "any_of", "size", "hash", "kinds", "values")
    both = found.join(hinted(side, 48, "kinds", "values", most=broadcast_bytes), ["hash", "size", "kinds"])

    # few rows from here on; they are checked behind exchanges, so that the workers that read the texts are done by then
    rows = both.select("key", "item", "at", "view", "of", "any_of", "doc_at", (F.col("doc_at") - F.col("at")).alias("diagonal"), "kinds", "values", "doc_values")
    diagonal = Window.partitionBy("key", "item", "diagonal")
    rows = fitting(rows.repartition("key", "item", "diagonal").sortWithinPartitions("key", "item", "diagonal", "doc_at", "view"), 8, "key", "item", "diagonal")
    rows = rows.repartition("key", "item").withColumn("place", F.dense_rank().over(diagonal.orderBy("doc_at"))).withColumn("places", F.max("place").over(diagonal)).drop("place")
    rows = fitting(rows.sortWithinPartitions("key", "item", F.desc("places"), "diagonal", "doc_at", "view"), 8, "key", "item")
    return rows.select("key", "item", "at", "view", "of", "any_of", "doc_at")


def fitting(rows: DataFrame, at: int, *group: str) -> DataFrame:
    """Those rows, in their order, whose slots (kinds, values and doc_values, columns from `at` on) fit those of the rows kept before in their
    group. Rows of a group stand together."""
    names, places = rows.columns, [rows.columns.index(g) for g in group]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, slots = None, Slots()
        for batch in batches:
            good = []
            columns = [batch.column(k).to_pylist() for k in (*places, at, at + 1, at + 2)]
            for *mine, kinds, ours, theirs in zip(*columns, strict=True):
                if now != mine:
                    now, slots = mine, Slots()
                good.append(slots.take(kinds, ours, theirs))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns], names)

    return rows.mapInArrow(run, rows.schema)


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", cover: float = COVER, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """key, n_items, item_id (lowest of those with the largest share), share: documents that hold benchmark items; one row for each key."""
    small_batches(docs.sparkSession)
    windows = written(item_windows(items, item_key, item_text), "windows")
    found = hits(docs, windows, key, text, broadcast_bytes)
    shares = (
        found.groupBy("key", "item", "of", "any_of", "at").agg(F.min("view").alias("view")).groupBy("key", "item")
        .agg(F.greatest(F.try_divide(F.count_if(F.col("view") == 0), F.first("of")), F.count("*") / F.first("any_of")).alias("share")).where(F.col("share") >= cover)
    )
    best = F.max(F.struct("share", (-F.col("item")).alias("low")))
    return shares.groupBy("key").agg(F.count("*").alias("n_items"), best.alias("best")).select(F.col("key").alias(key), "n_items", (-F.col("best.low")).alias("item_id"), F.col("best.share").alias("share"))


def judged(docs: DataFrame, items: DataFrame, text: str = "text", broadcast_bytes: int = BROADCAST_BYTES, **names: str) -> DataFrame:
    """row (all columns of docs), contaminated, item_id, n_items, share (see `contaminated`): every row of docs, whatever its key, judged by its text.

    Rows of one text have one verdict, so verdicts are joined by the text's SHA-256; null texts are clean."""
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.sha2(F.col(text).cast("binary"), 256).alias("judged"))
    found = contaminated(rows.select("judged", F.col("row").getField(text).alias("text")), items, key="judged", broadcast_bytes=broadcast_bytes, **names)
    leaks = written(found, "leaks")
    return rows.join(hinted(leaks, 32, "judged", most=broadcast_bytes), "judged", "left").select(
        "row", F.col("item_id").isNotNull().alias("contaminated"), "item_id", F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), "share"
    )
