"""Token-id tables in Simple-8b words.

A table is a Parquet folder with one row per block, so that Spark's own committers write it and
any store that Spark reads can hold it. Rows: shard (ascending with the key), block (ascending
within the shard), n_ids and payload. A block holds whole documents in ascending key order,
about BLOCK_IDS ids of them; its payload is little-endian:

    u32 x 4   documents, ids, words, escapes
    i64       key of each document
    u32       ids of each document (the offsets for decoding, as lengths)
    u64       words: the top 4 bits select how many ids of how many bits the other 60 hold
    u64       escapes: ids of more than 60 bits, in order

Selector k below 14 holds COUNTS[k] ids of 60 // COUNTS[k] bits each, the first in the lowest
bits. Selector 15 stands for one id from the escapes.

Null texts count as empty: they have the end id alone. Documents with equal keys keep all their
rows, in the order of their text. Null keys come first and read back as null (the least long key is
read back as null, too). Other columns are not carried. An empty table has no blocks.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.chunks import PLAIN, CutCoder, PieceCoder, gathered, id_lists, slices
from vantry.llm.scratch import small_batches

COUNTS = np.array([60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = 60 // COUNTS
ESCAPE = 15
BLOCK_IDS = 32_768


WIDTHS = sorted({*BITS.tolist()})


def width_classes(ids: np.ndarray) -> np.ndarray:
    """How many of the widths are too small for each id."""
    wide = np.zeros(len(ids), np.uint8)
    for bits in WIDTHS:
        wide += ids >= np.uint64(1 << bits)
    return wide


SMALL = width_classes(np.arange(1 << 16, dtype=np.uint64))


def chain(after: np.ndarray, doublings: int = 6) -> np.ndarray:
    """The places 0, after[0], after[after[0]] and so on that lie within; steps of 2 ** doublings are walked, those between are looked up."""
    n = len(after)
    jumps = [np.append(after, n)]
    for _ in range(doublings):
        jumps.append(jumps[-1][jumps[-1]])
    far, at, walked = jumps.pop().tolist(), 0, []
    while at < n:
        walked.append(at)
        at = far[at]
    found = np.array(walked)
    for jump in reversed(jumps):
        found = np.stack([found, jump[found]], 1).ravel()
    return found[found < n]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of a run of unsigned 64-bit ids; each word takes as many ids as fit."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return ids, ids
    classes = {bits: k for k, bits in enumerate(WIDTHS)}
    wide = width_classes(ids) if int(ids.max()) >= len(SMALL) else SMALL[ids.astype(np.int64)]
    choice = np.full(n, ESCAPE, np.uint8)
    choice[wide <= classes[60]] = 13
    spans = {1: wide}
    for size in (2, 4, 8, 16, 32):
        half = spans[size // 2]
        spans[size] = np.maximum(half[: n - size + 1], half[size // 2 :][: n - size + 1]) if n >= size else half[:0]
    for k in range(12, -1, -1):  # from two ids a word to sixty: a later hit holds more
        count = int(COUNTS[k])
        if count > n:
            break
        size = 1 << (count.bit_length() - 1)
        last = n - count + 1
        most = np.maximum(spans[size][:last], spans[size][count - size :][:last])
        fits = most <= classes[int(BITS[k])]
        choice[:last][fits] = k
    starts = chain(np.arange(n) + np.append(COUNTS, [0, 1])[choice])
    chosen = choice[starts]
    words = chosen.astype(np.uint64) << np.uint64(60)
    for k in np.unique(chosen):
        if k == ESCAPE:
            continue
        rows = np.flatnonzero(chosen == k)
        for j in range(int(COUNTS[k])):
            words[rows] |= ids[starts[rows] + j] << np.uint64(j * int(BITS[k]))
    return words, ids[starts[chosen == ESCAPE]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids again."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    counts = np.append(COUNTS, [0, 1])[chosen]
    starts = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for k in np.unique(chosen):
        rows = np.flatnonzero(chosen == k)
        if k == ESCAPE:
            out[starts[rows]] = escapes
            continue
        mask = np.uint64((1 << int(BITS[k])) - 1)
        for j in range(int(COUNTS[k])):
            out[starts[rows] + j] = (words[rows] >> np.uint64(j * int(BITS[k]))) & mask
    return out


def block_bytes(keys: np.ndarray, lens: np.ndarray, ids: np.ndarray) -> bytes:
    words, escapes = pack(ids)
    head = np.array([len(keys), len(ids), len(words), len(escapes)], "<u4")
    return b"".join((head.tobytes(), keys.astype("<i8").tobytes(), lens.astype("<u4").tobytes(), words.astype("<u8").tobytes(), escapes.astype("<u8").tobytes()))


def block_parts(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, lengths and ids of a block."""
    docs, ids, words, escapes = np.frombuffer(payload, "<u4", 4).tolist()
    at = 16
    keys = np.frombuffer(payload, "<i8", docs, at)
    lens = np.frombuffer(payload, "<u4", docs, at := at + 8 * docs)
    packed = np.frombuffer(payload, "<u8", words, at := at + 4 * docs)
    found = unpack(packed, np.frombuffer(payload, "<u8", escapes, at + 8 * words))
    if len(found) != ids or int(lens.sum()) != ids:
        raise ValueError("damaged block")
    return keys, lens.astype(np.int64), found


JOINED = 50
CACHE_BYTES = 100 << 20
NO_KEY = -(2**63)  # stands for a null key in a block


def library_ids(library, cuts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """ids of the cuts. Those without inner white space go to the library in lines, a line break between two of them:
    the break is a piece of its own there, with an id that no such cut contains, and marks where each ends."""
    if not cuts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    mark = library.encode("\n", add_special_tokens=False).ids
    plain = np.array([len(mark) == 1 and PLAIN.match(cut) is not None for cut in cuts])
    lens = np.zeros(len(cuts), np.int64)
    apart = np.flatnonzero(~plain)
    together = [cuts[k] for k in np.flatnonzero(plain).tolist()]
    lines = ["\n".join(together[at : at + JOINED]) + "\n" for at in range(0, len(together), JOINED)]
    ids = _flat(library, lines)[0]
    stops = np.flatnonzero(ids == mark[0]) if len(mark) == 1 else np.zeros(0, np.int64)
    if len(stops) != len(together):
        raise ValueError("a line break is not a piece of its own for this tokenizer")
    lens[plain] = np.diff(stops, prepend=-1) - 1
    ids = np.delete(ids, stops)
    single, lens[apart] = _flat(library, [cuts[k] for k in apart])
    starts = np.zeros(len(cuts), np.int64)
    starts[plain] = np.cumsum(lens[plain]) - lens[plain]
    starts[apart] = len(ids) + np.cumsum(lens[apart]) - lens[apart]
    return gathered(np.concatenate([ids, single]), starts, lens), lens


def _flat(library, texts: list[str], at_once: int = 500) -> tuple[np.ndarray, np.ndarray]:
    found = [np.array(x.ids, np.uint32) for at in range(0, len(texts), at_once) for x in library.encode_batch_fast(texts[at : at + at_once], add_special_tokens=False)]
    return np.concatenate([*found, np.zeros(0, np.uint32)]), np.array([len(x) for x in found], np.int64)


class AddedTokens:
    """Added tokens of a tokenizer's definition. The library looks for them in the raw text first, longest one first at each place, and
    encodes what lies between for itself; so do we, as blanks beside one belong to no piece beyond it."""

    def __init__(self, definition: str):
        tokens = json.loads(definition).get("added_tokens") or []
        if odd := [t["content"] for t in tokens if t.get("lstrip") or t.get("rstrip") or t.get("single_word")]:
            raise ValueError(f"added tokens that take blanks or whole words are not supported: {odd}")
        self.ids = {t["content"]: t["id"] for t in tokens if t["content"]}
        self.pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.ids, key=len, reverse=True))) + ")") if self.ids else None

    def __call__(self, code: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text begins (one entry more than texts)."""
        if not any(token in text for token in self.ids for text in texts):
            return code(texts)
        parts = [self.pattern.split(text) for text in texts]  # every second part is a token
        ids, ends = code([part for text in parts for part in text[::2]])
        tokens = [[self.ids[t] for t in text[1::2]] for text in parts]
        last = np.cumsum([len(text[::2]) for text in parts])  # of the sections of each text
        after = np.ones(len(ends) - 1, bool)
        after[last - 1] = False  # a text's last section has no token after it
        flat = np.array([t for text in tokens for t in text], ids.dtype)
        more = np.concatenate([[0], np.cumsum([len(text) for text in tokens])])
        return np.insert(ids, ends[1:][after], flat), ends[np.concatenate([[0], last])] + more


SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
HIDDEN = [b for b in range(256) if b not in SHOWN]
#: The character that byte-level tokenizers write for each byte; the zero byte, which no letter or sign holds, is the delimiter here.
BYTE_CHARS = "\n" + "".join(chr(b if b in SHOWN else 0x100 + HIDDEN.index(b)) for b in range(1, 256))


@lru_cache(1)
def _libraries(definition: str):
    """The library's tokenizer; if the definition splits by the plain byte-level pattern, one of the same model for whole pieces; bytes of each id."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # each task has one core
    from tokenizers import Tokenizer

    parts = json.loads(definition)
    split, model = parts.get("pre_tokenizer") or {}, parts["model"]
    plain = split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and split.get("use_regex", True) and parts.get("normalizer") is None
    plain = plain and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    whole, sizes = None, np.zeros(0, np.int64)
    if plain:
        whole = Tokenizer.from_str(json.dumps(parts | {"added_tokens": [], "pre_tokenizer": {"type": "CharDelimiterSplit", "delimiter": "\n"}, "post_processor": None}))
        tokens = whole.get_vocab()
        sizes = np.zeros(max(tokens.values()) + 1, np.int64)
        sizes[list(tokens.values())] = [len(token) for token in tokens]
    return Tokenizer.from_str(definition), whole, sizes


def whole_ids(library, sizes: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """ids of pieces of the pattern. They are written as byte-level characters, as the library's own splitter leaves them, and go to its model
    in lines; each id stands for so many bytes (`sizes`), so the bytes say where a piece ends."""
    lines = [codecs.charmap_decode(b"\0".join(pieces[at : at + JOINED]), "strict", BYTE_CHARS)[0] for at in range(0, len(pieces), JOINED)]
    ids = _flat(library, lines)[0]
    ends = np.cumsum(sizes[ids])
    stops = np.cumsum([len(x) for x in pieces], dtype=np.int64)
    last = np.searchsorted(ends, stops)
    if len(pieces) and not (last[-1] == len(ids) - 1 and np.array_equal(ends[last], stops)):
        raise ValueError("ids do not give the bytes of their pieces for this tokenizer")
    return ids, np.diff(last, prepend=-1)


def _coder(definition: str) -> CutCoder | PieceCoder:
    library, whole, sizes = _libraries(definition)
    if whole is None:
        return CutCoder(lambda cuts: library_ids(library, cuts), CACHE_BYTES)

    def encode(pieces: list[bytes], others: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        a, b = whole_ids(whole, sizes, pieces), library_ids(library, [x.decode() for x in others])
        return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])

    return PieceCoder(encode, CACHE_BYTES)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, key: str = "doc_id", text: str = "text") -> None:
    """Encodes the texts with a byte-level tokenizer of the tokenizers library and writes the table.

    `tokenizer` is the library's JSON file, read by the driver. Texts are exchanged once, by ranges of the key. A text that holds an added
    token's literal gets that token's id there, as the library gives it.
    """
    small_batches(docs.sparkSession)
    with open(tokenizer) as lines:
        definition = lines.read()
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_KEY)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("key").sortWithinPartitions("key", "text")
    ordered = ordered.withColumn("shard", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, added = _coder(shared.value), AddedTokens(shared.value)
        block, shard = 0, 0
        keys: list[np.ndarray] = []
        lens: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def full(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal block
            if not keys:
                return
            all_keys, all_lens, all_ids = map(np.concatenate, (keys, lens, ids))
            ends = np.cumsum(all_lens)
            at = done = 0
            while at < len(ends) and (ends[-1] - done >= least):
                to = min(len(ends), int(np.searchsorted(ends, done + BLOCK_IDS)) + 1)
                payload = block_bytes(all_keys[at:to], all_lens[at:to], all_ids[done : ends[to - 1]])
                yield pa.RecordBatch.from_pydict({"shard": [shard], "block": [block], "n_ids": [int(ends[to - 1] - done)], "payload": [payload]}, schema)
                block, done, at = block + 1, int(ends[to - 1]), to
            keys[:], lens[:], ids[:] = ([all_keys[at:]], [all_lens[at:]], [all_ids[done:]]) if at < len(ends) else ([], [], [])

        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("payload", pa.binary())])
        for batch in batches:
            for part in slices(batch, 1):
                shard = part.column(2)[0].as_py()
                found, ends = added(code, part.column(1).to_pylist())
                if end_id is not None:
                    found = np.insert(found, ends[1:], end_id)
                    ends = ends + np.arange(len(ends))
                keys.append(part.column(0).to_numpy(zero_copy_only=False))
                lens.append(np.diff(ends))
                ids.append(found)
                yield from full(BLOCK_IDS)
        yield from full(0)
        code.clear()

    blocks = ordered.mapInArrow(run, "shard int, block int, n_ids long, payload binary")
    blocks.write.option("compression", "zstd").parquet(path)


def read(spark, path: str, broadcast_blocks: int = 1_000_000) -> DataFrame:
    """key, start (ids of all documents before it), n_tokens, ids (unsigned 32-bit little-endian), in any order.

    Block totals (one small row each) are summed in two steps, within each shard and over the
    shards; each block then decodes by itself.
    """
    blocks = spark.read.schema("shard int, block int, n_ids long, payload binary").parquet(path)
    sizes = blocks.select("shard", "block", "n_ids")
    within = Window.partitionBy("shard").orderBy("block")
    over = Window.orderBy("shard")  # one row for each shard
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("total")).select("shard", (F.sum("total").over(over) - F.col("total")).alias("base"))
    bases = sizes.withColumn("_in", F.sum("n_ids").over(within) - F.col("n_ids")).join(shards, "shard").select("shard", "block", (F.col("base") + F.col("_in")).alias("start"))
    if sizes.count() <= broadcast_blocks:  # 16 bytes each
        bases = F.broadcast(bases)
    placed = blocks.select("shard", "block", "payload").join(bases, ["shard", "block"]).select("start", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys, lens, ids = block_parts(payload.as_buffer())
                ends = np.concatenate([[0], np.cumsum(lens)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(start + ends[:-1]), pa.array(lens), id_lists(ids.astype(np.uint32), ends, True)],
                    ["key", "start", "n_tokens", "ids"],
                )

    found = placed.mapInArrow(run, "key long, start long, n_tokens long, ids binary")
    return found.withColumn("key", F.nullif("key", F.lit(NO_KEY)))
