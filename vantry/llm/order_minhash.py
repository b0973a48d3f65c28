"""Order MinHash fingerprints of documents, with DataFrame functions only.

A text's words give k-mers of K words: single characters of scripts that are written without blanks, and runs of other non-blanks. A run
of over 12 characters is cut before letters and digits of a fixed set (after 12 characters where none comes), so that a character put in
moves the cuts next to it alone. Each k-mer
is told apart by its occurrence number, so repeats count. Their hashes fall into BUCKETS by the
highest bits (one permutation for all sketches); in each bucket the two least are selected, put
into the order of the text, and hashed as a pair. The pairs are the signature: two texts have a
pair in common if they share both k-mers in the same order, so moved text lowers the likeness,
as it raises the edit distance. A text shorter than K words has one k-mer of all its words, a
text without words has none.

likeness: pairs in common over the buckets that either text fills; 1 for two texts without
words. Equal texts have equal fingerprints. Null texts count as empty.

Every step is linear in the text but for sorting its hashes; nothing is collected or exploded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.scratch import written

K = 3
BUCKETS = 32  # 5 bits
PLACE = (1 << 24) - 1  # bits of a code that hold the place in the text


SINGLE = "".join(rf"\p{{Is{name}}}" for name in ("Han", "Hiragana", "Katakana", "Hangul", "Thai", "Lao", "Khmer", "Myanmar", "Tibetan"))
WORD = rf"[{SINGLE}]|[^\s{SINGLE}]{{1,12}}(?![^\s{SINGLE}])|[^\s{SINGLE}]{{2,12}}?(?=[aeiouAEIOU0-4])|[^\s{SINGLE}]{{1,12}}"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _bucket(code: Column) -> Column:
    return F.shiftright(code, 59)


def _hash_part(code: Column) -> Column:
    return F.shiftrightunsigned(code, 24)


def signature(text: Column) -> Column:
    """Array of up to BUCKETS numbers below 2^32, one for each filled bucket, in the order of the buckets."""
    words = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0)), lambda word: F.xxhash64(word))
    return let(words, lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(let(_codes(w), lambda c: let(_numbered(c), _pairs))))


def _codes(w: Column) -> Column:
    """Sorted codes of the k-mers: 40 bits of hash, then 24 bits of place (scaled down in texts of more words)."""
    n = F.size(w) - K + 1
    place = lambda i: F.when(n <= PLACE, i.cast("bigint")).otherwise((i.cast("bigint") * PLACE / n).cast("bigint"))
    code = lambda h, i: h.bitwiseAND(F.lit(~PLACE)).bitwiseOR(place(i))
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda i: code(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), i))
    return F.when(n < 1, F.array(F.xxhash64(w).bitwiseAND(F.lit(~PLACE)))).otherwise(F.sort_array(many))


def _numbered(s: Column) -> Column:
    """Codes with the occurrence number in the hash, sorted anew."""
    first = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (_hash_part(F.get(s, i)) != _hash_part(F.get(s, i - 1))))

    def renumbered(starts: Column) -> Column:
        def run(start: Column, r: Column) -> Column:
            end = F.coalesce(F.get(starts, r + 1), F.size(s))
            code = lambda i: F.when(i == start, F.get(s, i)).otherwise(
                F.xxhash64(_hash_part(F.get(s, i)), i - start).bitwiseAND(F.lit(~PLACE)).bitwiseOR(F.get(s, i).bitwiseAND(F.lit(PLACE)))
            )
            return F.when(end == start + 1, F.array(F.get(s, start))).otherwise(F.transform(F.sequence(start, end - 1), code))

        return F.when(F.size(starts) == F.size(s), s).otherwise(F.sort_array(F.flatten(F.transform(starts, run))))

    return let(first, renumbered)


def _pairs(s: Column) -> Column:
    least = F.filter(s, lambda x, i: (i < 2) | (_bucket(F.get(s, i - 2)) != _bucket(x)))

    def paired(p: Column) -> Column:
        heads = F.filter(F.sequence(F.lit(0), F.size(p) - 1), lambda i: (i == 0) | (_bucket(F.get(p, i - 1)) != _bucket(F.get(p, i))))

        def pair(i: Column) -> Column:
            a, b = F.get(p, i), F.get(p, i + 1)
            alone = b.isNull() | (_bucket(b) != _bucket(a))
            early = a.bitwiseAND(F.lit(PLACE)) <= b.bitwiseAND(F.lit(PLACE))
            hashed = F.when(alone, F.xxhash64(_hash_part(a))).when(early, F.xxhash64(_hash_part(a), _hash_part(b))).otherwise(F.xxhash64(_hash_part(b), _hash_part(a)))
            return F.shiftrightunsigned(a, 59) * (1 << 27) + F.shiftrightunsigned(hashed, 37)

        return F.transform(heads, pair)

    return let(least, paired)


def fingerprint(signature: Column) -> Column:
    """Eight hexadecimal digits for each number."""
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    bucket = lambda x: F.transform(x, lambda v: F.shiftright(v, 27))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(bucket(a), bucket(b))))


def neighbours(keys: DataFrame) -> DataFrame:
    """key, before, before_n: of each key (key, n) the one before in ascending order; before the first comes the last.

    Keys are sorted by ranges; the ends of the ranges (one small row each) are stitched together.
    """
    ranged = written(keys.repartitionByRange("key").withColumn("part", F.spark_partition_id()), "keys")
    within = Window.partitionBy("part").orderBy("key")
    ends = ranged.groupBy("part").agg(F.max(F.struct("key", "n")).alias("end"))
    over = Window.orderBy("part")  # one row for each range
    whole = ends.agg(F.max(F.struct("part", "end")).alias("very"))
    ends = ends.withColumn("ahead", F.lag("end").over(over)).crossJoin(F.broadcast(whole)).select("part", F.coalesce("ahead", "very.end").alias("ahead"))
    return (
        ranged.withColumn("near", F.lag(F.struct("key", "n")).over(within))
        .join(ends, "part")
        .select("key", F.coalesce("near", "ahead").alias("b"))
        .select("key", F.col("b.key").alias("before"), F.col("b.n").alias("before_n"))
    )


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text, signature, tail, next_signature: tail holds the first floor(n/2) characters of the next document.

    The next document is the one with the next higher key; after the last comes the first. Where rows share a key,
    each has the same next document: of the rows with the next key, the one with the least text. Rows without a key have none.
    Texts are exchanged once by key, and the tails that are needed once more.
    """
    every = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = every.where("key is not null")  # the same on both sides of the last join, so that they share one exchange
    before = neighbours(rows.groupBy("key").agg(F.max(F.char_length("text")).alias("n")))
    signed = rows.withColumn("signature", signature(F.col("text")))
    sent = signed.join(before, "key").select(
        F.col("before").alias("key"), F.expr("substring(text, 1, cast(floor(before_n / 2) as int))").alias("tail"), F.col("signature").alias("next_signature")
    )
    tails = sent.groupBy("key").agg(F.min(F.struct("tail", "next_signature")).alias("t")).select("key", "t.tail", "t.next_signature")
    kind = tails.schema
    keyless = every.where("key is null").select("key", "text", signature(F.col("text")).alias("signature"), *(F.lit(None).cast(kind[c].dataType).alias(c) for c in ("tail", "next_signature")))
    return signed.join(tails, "key", "left").unionByName(keyless).select(
        F.col("key").alias(key), "text", "signature", F.expr("substring(coalesce(tail, ''), 1, cast(floor(char_length(text) / 2) as int))").alias("tail"), "next_signature"
    )
