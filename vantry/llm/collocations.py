"""Phrases of two and three words that stand together more often than their parts do.

The layout is that of external count streams: n-grams are counted order by order, each order a table of
(lang, words, n). An order reaches only what can still be frequent: both words of a pair must be frequent
themselves, both pairs of a triple too. A bitmap of hashed places stands for the frequent lower order; it
has a fixed size and lets through more than it must, never less, and the counts decide.

Left, right and extension counts come from merge joins of sorted streams: the stream of triples in prefix
order (w1, w2) runs in lockstep with the pairs in that order, the stream in suffix order (w2, w3) with the
pairs again, and pairs with the words at either end. No table of counts is looked up by hashing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.scratch import dropped, small_batches, written

LEAST = 10  # occurrences of a candidate
COVER = 50  # percent of a phrase's occurrences that a longer candidate has to hold
TOP = 2000
BITS = 27  # of places in a bitmap: 16 MB
SLICE_BYTES = 3 << 20
BATCH_ROWS = 50_000
SALTS = 64

BLANK, BREAK = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANK)], KIND[list(BREAK)] = 1, 2
NO_LANG = "und"


def split(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Of lower-cased texts: code of each word, the words, the piece and the text that each word stands in."""
    data = b"\n".join(texts).lower()  # of bytes only A-Z
    kind = KIND[np.frombuffer(data, np.uint8)]
    inner = np.concatenate([[False], kind == 0, [False]])
    edges = np.flatnonzero(inner[1:] != inner[:-1])
    starts, ends = edges[::2], edges[1::2]
    bare = np.frombuffer(data, np.uint8)[kind == 0]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(bare)]).dictionary_encode()
    piece = np.cumsum(kind == 2)[starts] if len(starts) else starts
    begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    return found.indices.to_numpy().astype(np.int64), found.dictionary.to_pylist(), piece, np.searchsorted(begins, starts, "right") - 1


def word_hashes(lang: str, words: list[bytes]) -> list[int]:
    """What xxhash64(lang, word) is in Spark, unsigned."""
    import xxhash

    seed = xxhash.xxh64_intdigest(lang.encode(), 42)
    return [xxhash.xxh64_intdigest(word, seed) for word in words]


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (first << np.uint64(21) | first >> np.uint64(43)) ^ second


def place(words: tuple[str, ...]) -> Column:
    """Place of a word or a pair in a bitmap; the same as word_hash and pair_hash give."""
    hashes = [F.xxhash64("lang", w) for w in words]
    mixed = hashes[0]
    for h in hashes[1:]:
        mixed = F.shiftleft(mixed, 21).bitwiseOR(F.shiftrightunsigned(mixed, 43)).bitwiseXOR(h)
    return mixed.bitwiseAND((1 << BITS) - 1)


def bitmap(grams: DataFrame, words: tuple[str, ...]) -> np.ndarray:
    """Bits at the places of all rows: 2^27 of them, whatever the number of rows."""
    at = place(words)
    parts = grams.groupBy(F.shiftright(at, 15).alias("part")).agg(F.bitmap_construct_agg(at.bitwiseAND(32767)).alias("bits")).collect()  # 4,096 of 4 KB at most
    out = np.zeros((1 << BITS) >> 3, np.uint8)
    for r in parts:
        out[r.part * 4096 : (r.part + 1) * 4096] = np.frombuffer(r.bits, np.uint8)
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64((1 << BITS) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def grams(langs: list[str], texts: list[bytes], order: int, bits: np.ndarray | None) -> pa.Table:
    """gram, n: the n-grams of the texts that the bitmap of the order below lets through, as language, tab, words with blanks between."""
    code, names, piece, text = split(texts)
    known = sorted(set(langs))
    number = {x: k for k, x in enumerate(known)}
    word = np.array([number[x] for x in langs], np.int64)[text] * len(names) + code  # a word of one language
    go = np.arange(max(0, len(word) - order + 1))
    go = go[piece[go] == piece[go + order - 1]]
    if bits is not None:
        hashes = np.zeros(len(known) * len(names), np.uint64)
        used = np.flatnonzero(np.bincount(word, minlength=len(hashes)))
        for k, lang in enumerate(known):
            own = used[used // max(1, len(names)) == k]
            hashes[own] = word_hashes(lang, [names[x] for x in (own % len(names)).tolist()])
        fine = marked(bits, hashes)[word] if order == 2 else marked(bits, pair_hash(hashes[word[:-1]], hashes[word[1:]]))
        go = go[fine[go] & fine[go + 1]]
    keys, prefixes = pa.array(word[go]), []
    for k in range(1, order):  # dense numbers of prefixes, so keys never outgrow 64 bits
        dense = keys.dictionary_encode()
        prefixes.append(dense.dictionary.to_numpy())
        keys = pa.array(dense.indices.to_numpy().astype(np.int64) * len(names) + code[go + k])
    found = keys.value_counts()
    last, n = found.field(0).to_numpy(), found.field(1)
    ends = []
    for prefix in reversed(prefixes):
        ends.append(last % len(names))
        last = prefix[last // len(names)]
    vocabulary = pa.array(names, pa.binary()).cast(pa.string())
    words = [vocabulary.take(pa.array(x)) for x in (last % max(1, len(names)), *reversed(ends))]
    lang = pa.array(known, pa.string()).take(pa.array(last // max(1, len(names))))
    phrase = pc.binary_join_element_wise(*words, " ") if order > 1 else words[0]
    return pa.table([pc.binary_join_element_wise(lang, phrase, "\t"), n], names=["gram", "n"])


def counted(docs: DataFrame, order: int, bits: np.ndarray | None, label: str) -> DataFrame:
    """The counts of one order, as a written table of lang, w1 .. w<order>, n."""
    shared = docs.sparkSession.sparkContext.broadcast(bits) if bits is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: list[str] = []
        texts: list[bytes] = []
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                langs.append(lang)
                texts.append(text)
                held += len(text)
                if held > SLICE_BYTES:
                    yield from grams(langs, texts, order, shared.value if shared else None).to_batches(BATCH_ROWS)
                    langs, texts, held = [], [], 0
        if texts:
            yield from grams(langs, texts, order, shared.value if shared else None).to_batches(BATCH_ROWS)

    table = docs.mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    phrase = F.substring_index("gram", "\t", -1)  # a language may hold tabs, words don't
    words = F.split(phrase, " ")
    split = [F.expr("substring(gram, 1, char_length(gram) - char_length(substring_index(gram, '\t', -1)) - 1)").alias("lang"), *(F.get(words, F.lit(k)).alias(f"w{k + 1}") for k in range(order))]
    out = written((table if order == 1 else table.where(F.col("n") >= LEAST)).select(*split, "n"), label)
    if shared:
        shared.unpersist()
    return out


def collocations(docs: DataFrame, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases of two and three words.

    Letters A-Z are lower-cased; texts are cut at . , ; : ! ? and line ends into pieces, pieces at blanks and tabs into words. n counts
    the words of a language, a the phrase, l and r the two parts of its lowest-scoring cut (ties: the first), with score
    floor(1000000 a a / (l r)). Phrases of under LEAST occurrences, and those of which a longer candidate holds COVER percent or more,
    are left out. Null texts are empty, null languages `und`; repeated rows count again; ties are parted by a, then by phrase. Texts
    without words and empty tables give no rows. Other columns are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    every = counted(rows, 1, None, "words")
    total = every.groupBy("lang").agg(F.sum("n").alias("total"))
    words = every.where(F.col("n") >= LEAST)
    pairs = counted(rows, 2, bitmap(words, ("w1",)), "pairs")
    triples = counted(rows, 3, bitmap(pairs, ("w1", "w2")), "triples")

    one = words.select("lang", F.col("w1").alias("w"), F.col("n").alias("f"))
    at_first, at_last = one.withColumnsRenamed({"w": "w1", "f": "f1"}), one.withColumnsRenamed({"w": "w2", "f": "f2"})
    two = written(pairs.join(at_first.hint("merge"), ["lang", "w1"]).join(at_last.hint("merge"), ["lang", "w2"]), "pairs-with-words")
    prefix = two.select("lang", "w1", "w2", F.col("n").alias("f12"), "f1")
    suffix = two.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("n").alias("f23"), F.col("f2").alias("f3"))
    three = triples.join(prefix.hint("merge"), ["lang", "w1", "w2"]).join(suffix.hint("merge"), ["lang", "w2", "w3"])

    right = triples.groupBy("lang", "w1", "w2").agg(F.max("n").alias("longer_right"))
    left = triples.groupBy("lang", F.col("w2").alias("w1"), F.col("w3").alias("w2")).agg(F.max("n").alias("longer_left"))
    open_pairs = two.join(right.hint("merge"), ["lang", "w1", "w2"], "left").join(left.hint("merge"), ["lang", "w1", "w2"], "left")
    longer = F.greatest(F.coalesce("longer_right", F.lit(0)), F.coalesce("longer_left", F.lit(0)))
    open_pairs = open_pairs.where(100 * longer.cast("decimal(20,0)") < COVER * F.col("n").cast("decimal(20,0)"))

    def cut(a: str, l: str, r: str, k: int) -> Column:  # noqa: E741
        exact = lambda c: f"cast({c} as decimal(15,0))"
        score = F.expr(f"({exact(a)} * {exact(a)} * 1000000) div ({exact(l)} * {exact(r)})")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r"))

    of_two = open_pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), cut("n", "f1", "f2", 1).alias("cut"))
    lowest = F.least(cut("n", "f1", "f23", 1), cut("n", "f12", "f3", 2))
    of_three = three.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), F.col("n").alias("a"), lowest.alias("cut"))
    scored = of_two.unionByName(of_three).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    out = written(ranked.join(F.broadcast(total.hint("broadcast")), "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"), "phrases")
    dropped(every, pairs, triples, two)
    return out
