"""Exact similarity join on word shingles, and the components of its links.

A text's set holds the distinct shingles of WORDS words (its whole word sequence where it has
fewer), as 64-bit hashes. Two texts link if 100 * intersection >= PERCENT * union. Size-aware
heavy-light join:

* Equal sets form a class; only its representative goes on.
* Light sets (few shingles) enumerate fixed-size subsets: sets of sizes a and b link if and only
  if they share a subset of ceil(p (a + b) / (100 + p)) shingles, so for each partner size a set
  emits all its subsets of that fixed size, and equal subsets of one set of either size are links without
  any check. Two sets of the same size that meet in a subset made for a smaller partner are no link.
* Heavy sets scan inverted lists: shingles are put into one global order, rare ones first, and
  linked sets must share a shingle among the first n - ceil(p n / 100) + 1 of each. Only those
  are listed, and lists of one set are dropped. Lists also serve pairs of a light and a heavy set.
* The boundary is the largest size up to which enumeration costs no more than scanning, by the
  measured mean length of the lists.

The order comes from a count sketch of all shingles of fixed size (CELLS counters): it decides
how much work there is, never the result.

A list entry knows its place in its set: what two sets share from there on is no more than what
either has left, which bounds the size of a partner (`most`). The first shingle that two linked
sets share holds them within both bounds, so pairs outside them are never made.

Only what connects matters for components. Each list first proposes its members paired with one
leader, its smallest set and then one drawn for each list, and each member is tried with the most alike of its leaders;
verified pairs are merged into components; then,
in lists that still hold several components, members with a possible partner in another component
are paired with those. So groups of near copies cost a pair or two a member, while no link between
components is lost: every pair that could link and is not yet connected is verified on the full
sets. A pair shares up to all the lists of its sets and needs one: of lists with the same members only the first in the global order is read,
and a pair that shares one of the last EARLIER lists that either set was in before is left to that list. Parities of hash buckets of a set differ in no more places than the sets do, which rules out
nearly all pairs that do not link: those of a few buckets as the pairs are made, those of about
twice as many buckets as the set has shingles before any set is sent.

Null texts and texts without words have empty sets and link with nothing. Repeated rows link by
equality. Keys must be integers; rows that share a key are one document with several sets. A row
without a key cannot be named: it links with nothing and has no component. Other columns, whatever
their names, are not used. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.chunks import bytes_of, slices, split_words
from vantry.llm.components import components
from vantry.llm.scratch import dropped, hinted, small_batches, written

WORDS = 5
PERCENT = 80
CELLS = 1 << 18
LIGHT_MOST = 12
LEADERS = 2
LONGEST_SIGN = 1 << 16  # parities of a set at most
COARSE = 128  # parities that list entries carry while leaders are tried
FINE = 512  # and when all open pairs are made
EARLIER = 8  # lists that an entry remembers


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; each distinct word of the texts is hashed once."""
    codes, names, n_words = split_words(texts)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, bytes_of(names)), np.uint64, len(names))
    ends = [0, *np.cumsum(n_words).tolist()]
    flat = hashes[codes]
    out = []
    n = max(0, len(flat) - words + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(words):
        rolled = mix(rolled ^ flat[j : n + j])
    for a, b in zip(ends, ends[1:], strict=False):
        if b - a >= words:
            out.append(distinct(rolled[a : b - words + 1]))
        elif b > a:
            one = np.full(1, 0x5EED + b - a, np.uint64)
            for h in flat[a:b]:
                one = mix(one ^ h)
            out.append(one)
        else:
            out.append(flat[:0])
    return out


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values of a row that is not empty; sorting short rows is faster than np.unique."""
    x = np.sort(x)
    return x[np.concatenate([[True], x[1:] != x[:-1]])]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


#: prefix_length in SQL.
PREFIX = "({n} + 1 - ceil({p} * {n} / 100))"


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n + (-percent * n) // 100 + 1 if n else 0


def overlap_needed(total: Column | int, percent: int = PERCENT):
    """Least intersection of two linked sets whose sizes add up to total."""
    if isinstance(total, int):
        return -(-percent * total // (100 + percent))
    return F.ceil(F.lit(percent) * total / F.lit(100 + percent))


def sketch(docs: DataFrame, text: str = "text", words: int = WORDS) -> np.ndarray:
    """CELLS counters of all shingles of all documents (each document counts a shingle once)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                sets = shingle_sets(bytes_of(part.column(0)), words)
                total += np.bincount((np.concatenate([*sets, np.zeros(0, np.uint64)]) >> np.uint64(46)).astype(np.int64), minlength=CELLS)
        if total.any():
            rows = total.astype("<u4").reshape(64, -1)
            yield pa.RecordBatch.from_arrays([pa.array(range(64), pa.int32()), pa.array([r.tobytes() for r in rows])], ["part", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[part] = total.get(part, 0) + np.frombuffer(counts, "<u4").astype(np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([np.minimum(v, 2**32 - 1).astype("<u4").tobytes() for v in total.values()])], ["part", "counts"])

    rows = docs.select(F.col(text).alias("text")).where(F.col("text").isNotNull())
    parts = rows.mapInArrow(counted, "part int, counts binary").repartition(16, "part").mapInArrow(summed, "part int, counts binary").collect()  # CELLS counters
    out = np.zeros((64, CELLS // 64), np.int64)
    for r in parts:
        out[r["part"]] = np.frombuffer(r["counts"], "<u4")
    return out.ravel()


ODD = [f"odd{k}" for k in range(FINE // 64)]


def sign(s: np.ndarray) -> np.ndarray:
    """Whether each hash bucket holds an odd number of the set's shingles, as bits; twice as many buckets as shingles or more, up to LONGEST_SIGN."""
    buckets = min(LONGEST_SIGN, max(FINE, 1 << (2 * len(s)).bit_length()))
    return np.packbits((np.bincount((mix(s) & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets) & 1).astype(np.uint8))


def fold(signs: np.ndarray, size: int) -> np.ndarray:
    """Parities of fewer buckets (size bytes of them), each the sum of several."""
    return np.bitwise_xor.reduce(signs.reshape(-1, size), axis=0)


def parities(s: np.ndarray) -> np.ndarray:
    """Those of FINE buckets, as 64-bit integers."""
    return fold(sign(s), FINE // 8).view(np.int64)


def folded(buckets: int) -> list[Column]:
    n = buckets // 64
    return [F.expr(" ^ ".join(ODD[k::n])).alias(f"odd{k}") for k in range(n)]


def apart(buckets: int) -> Column:
    """In how many parities two sets differ: no more than the shingles that only one of them has."""
    return F.expr(" + ".join(f"bit_count(odd{k} ^ yodd{k})" for k in range(buckets // 64)))


def near_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b, total) that differ in few enough parities of all buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for total, x, y in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
                x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
                size = min(len(x), len(y))
                differ = int.from_bytes((fold(x, size) ^ fold(y, size)).tobytes(), "little").bit_count()
                good.append(differ <= total - 2 * overlap_needed(total, percent))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(good, pa.bool_())) for c in batch.columns[:3]], ["a", "b", "total"])

    signs = reps.select("key", "sign")
    both = pairs.join(signs.select(F.col("key").alias("a"), F.col("sign").alias("x")), "a").join(signs.select(F.col("key").alias("b"), F.col("sign").alias("y")), "b")
    return both.select("a", "b", "total", "x", "y").mapInArrow(run, "a long, b long, total int")


def prefixes(docs: DataFrame, counts: np.ndarray, key: str, text: str, words: int, percent: int) -> DataFrame:
    """key, n (set size), digest, sign and odd0 and on (parities), first (the listed shingles in the global order; all of them in sets of LIGHT_MOST or fewer)."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingle_sets(bytes_of(part.column(1)), words)
                first = []
                for s in sets:
                    cell = counts[(s >> np.uint64(46)).astype(np.int64)]
                    order = np.argsort(cell, kind="stable")
                    first.append(s[order[: prefix_length(len(s), percent) if len(s) > LIGHT_MOST else len(s)]].astype(np.int64))
                ends = np.cumsum([0, *map(len, first)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*first, np.zeros(0, np.int64)])))
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                signs = [sign(s) for s in sets]
                odd = np.array([fold(x, FINE // 8).view(np.int64) for x in signs], np.int64).reshape(-1, len(ODD))
                columns = [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array([x.tobytes() for x in signs], pa.binary()), *map(pa.array, np.ascontiguousarray(odd.T)), lists]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "digest", "sign", *ODD, "first"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"key long, n long, digest binary, sign binary, {' long, '.join(ODD)} long, first array<bigint>")


def light_boundary(sizes: dict[int, int], mean_list: float, percent: int = PERCENT) -> int:
    """Largest size up to which enumerating subsets costs no more than scanning lists, for the sizes that occur."""
    bound = 0
    for n in range(1, LIGHT_MOST + 1):
        emitted = sum(comb(n, overlap_needed(n + t, percent)) for t in range(1, n + 1) if overlap_needed(n + t, percent) <= t)
        if sizes.get(n, 0) and emitted > max(4.0, prefix_length(n, percent) * mean_list):
            break
        bound = n
    return bound


def light_links(light: DataFrame, bound: int, percent: int) -> DataFrame:
    """a, b: links among sets of up to `bound` shingles.

    A subset is made for a smaller and a larger size. Sets of one size are linked as a star only where both sizes are equal;
    otherwise each smaller set is linked with the larger one of least key and the other way round.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sides, subsets = [], [], []
            for key, shingles in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                n, ordered = len(shingles), sorted(shingles)
                for t in range(1, bound + 1):
                    need = overlap_needed(n + t, percent)
                    if need > min(n, t):
                        continue
                    low, high = min(n, t), max(n, t)
                    for subset in combinations(ordered, need):
                        keys.append(key)
                        sides.append((n > t) - (n < t))
                        subsets.append(hashlib.blake2b(np.array([low, high, *subset], np.int64).tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(sides, pa.int8()), pa.array(subsets, pa.binary())], ["key", "side", "subset"])

    found = light.mapInArrow(run, "key long, side byte, subset binary")
    of = lambda side: F.when(F.col("side") == side, F.col("key"))
    least = found.groupBy("subset").agg(F.min(of(-1)).alias("low"), F.min(of(1)).alias("high"), F.min(of(0)).alias("same"), F.max(of(0)).alias("top"))
    least = least.where("same < top or (low is not null and high is not null)").drop("top")
    other = F.when(F.col("side") == 0, F.col("same")).when(F.col("side") < 0, F.col("high")).otherwise(F.col("low"))
    return found.join(least, "subset").select(F.col("key").alias("a"), other.alias("b")).where("a <> b").distinct()


def linked_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component (least key reachable by links) of every row."""
    small_batches(docs.sparkSession)
    counts = sketch(docs, text, words)
    sets = written(prefixes(docs, counts, key, text, words, percent), "sets")
    named = sets.where("n > 0 and key is not null")
    classes = named.groupBy("digest", "n").agg(F.min("key").alias("rep"))
    chosen = written(classes.select(F.col("rep").alias("key")), "reps")
    reps = named.join(hinted(chosen, 8), "key", "left_semi").withColumn("n", F.col("n").cast("int"))

    # inverted lists of two sets or more; light sets list their prefix too
    listed = reps.select("key", "n", F.posexplode(F.expr(f"slice(first, 1, cast({PREFIX.format(p=percent, n='n')} as int))")).alias("pos", "shingle"))
    common = listed.groupBy("shingle").agg(F.count("*").alias("m")).where("m > 1").select("shingle")
    lists = written(listed.join(common, "shingle", "left_semi"), "lists")

    small = {r["n"]: r["count"] for r in reps.where(F.col("n") <= LIGHT_MOST).groupBy("n").count().collect()}  # LIGHT_MOST rows at most
    shape = lists.agg(F.count("*").alias("rows"), F.countDistinct("shingle").alias("lists")).first()
    bound = light_boundary(small, shape["rows"] / max(1, shape["lists"]), percent)
    edges = written(light_links(reps.where(F.col("n") <= bound).select("key", "first"), bound, percent), "light")

    def linked(pairs: DataFrame) -> None:
        nonlocal edges, labels
        old = edges, labels
        edges = written(edges.unionByName(verified(pairs, reps, docs, key, text, words, bound, percent)), "links")
        labels = components(edges)
        dropped(*old)

    labels = components(edges)
    for turn in range(LEADERS):
        entries = named_lists(lists, labels, reps.select("key", *folded(COARSE)), COARSE, percent)
        first = F.struct("n", F.xxhash64("key").alias("h")) if turn == 0 else F.xxhash64("key", "shingle", F.lit(turn))
        lead = entries.groupBy("shingle").agg(F.min(F.struct(first.alias("first"), *partner(COARSE))).alias("l"))
        pairs = entries.join(lead, "shingle").select("*", "l.*").where(possible(COARSE, percent))
        # of a member's leaders the one it differs least from
        best = F.min(F.struct(apart(COARSE).alias("d"), "y", "n", "yn")).alias("b")
        linked(pairs.groupBy("key").agg(best).select("key", "b.n", "b.y", "b.yn"))

    # lists that still hold several components: all pairs within both bounds of members that have any
    entries = written(named_lists(lists, labels, reps.select("key", *folded(FINE)), FINE, percent), "named")
    linked(open_pairs(entries, percent))
    dropped(lists, entries, edges, chosen)

    # copies with a lower key than their representative cannot exist; the component is named by its least key
    found = F.when(F.col("key").isNotNull(), F.coalesce("component", "rep", "key"))
    return reps_to_rows(sets, classes, labels).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), found.alias("component"))


def reps_to_rows(sets: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row with its class and component. Classes hold many rows, labels one for each class."""
    joined = classes.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return sets.select("key", "n", "digest").join(joined, ["digest", "n"], "left")


def full_sets(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """key, shingles: whole sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                sets = shingle_sets(bytes_of(part.column(1)), words)
                ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                flat = np.concatenate([*sets, np.zeros(0, np.uint64)]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["key", "shingles"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text")).mapInArrow(run, "key long, shingles array<bigint>")


#: A member of a list as another one's partner.
PARTNER = {"y": "key", "yn": "n", "ycomp": "comp", "ymost": "most"}


def partner(buckets: int) -> list[Column]:
    return [F.col(old).alias(new) for new, old in PARTNER.items()] + [F.col(x).alias(f"y{x}") for x in ODD[: buckets // 64]]


def possible(buckets: int, percent: int) -> Column:
    """Whether a member and its partner are in different components, within both bounds, and differ in few enough parities."""
    few = apart(buckets) <= F.expr("n + yn") - 2 * overlap_needed(F.expr("n + yn"), percent)
    return (F.col("comp") != F.col("ycomp")) & (F.col("n") <= F.col("ymost")) & (F.col("yn") <= F.col("most")) & few


def named_lists(lists: DataFrame, labels: DataFrame, odd: DataFrame, buckets: int, percent: int) -> DataFrame:
    """shingle, key, n, pos, comp, parities, most (size of the largest set that can link with this one if this is the first shingle they share)."""
    named = lists.join(odd.join(labels.withColumnRenamed("node", "key"), "key", "left"), "key")
    most = F.expr(f"cast({100 + percent} * (n - pos) div {percent} - n as int)")
    return named.select("shingle", "key", "n", "pos", F.coalesce("component", "key").alias("comp"), *ODD[: buckets // 64], most.alias("most"))


def open_pairs(named: DataFrame, percent: int) -> DataFrame:
    """key, n, y, yn: pairs of a list that are possible links.

    The first list that two linked sets share holds them within both bounds, and is the first one with its members. So of lists with the
    same members (told apart by number and two sums of key hashes) only the first is read, and pairs that share an earlier list are left to it.
    A member joins only if the smallest member of the other components is within its bound; for that the smallest of
    each component, and the two smallest of these, are enough. Members of a list's most frequent component
    are not paired with each other.
    """
    hashes = [F.bit_xor(F.xxhash64("key", F.lit(k))).alias(f"hash{k}") for k in range(2)]
    parts = named.groupBy("shingle", "comp").agg(F.min("n").alias("n"), F.count("*").alias("m"), *hashes, F.min(F.struct("key", "pos")).alias("top"))
    least = parts.groupBy("shingle").agg(
        F.min(F.struct("n", "comp")).alias("least"), F.max(F.struct("m", "comp"))["comp"].alias("main"), F.count("*").alias("parts"),
        F.sum("m").alias("m"), *(F.bit_xor(f"hash{k}").alias(f"hash{k}") for k in range(2)), F.min("top")["pos"].alias("place"),
    ).where("parts > 1")
    first = least.groupBy("m", "hash0", "hash1").agg(F.min_by(F.struct("shingle", "least", "main"), "place").alias("f")).select("f.*")
    second = parts.join(first, "shingle").where(F.col("comp") != F.col("least.comp")).groupBy("shingle").agg(F.min("n").alias("second"), F.first("least").alias("least"), F.first("main").alias("main"))
    before = Window.partitionBy("key").orderBy("pos").rowsBetween(-EARLIER, -1)
    able = named.join(second, "shingle").withColumn("before", F.collect_list("shingle").over(before))
    able = able.where(F.when(F.col("comp") == F.col("least.comp"), F.col("second")).otherwise(F.col("least.n")) <= F.col("most"))
    able = able.select("shingle", "key", "n", "comp", "most", *ODD[: FINE // 64], "before", "main")
    other = able.select("shingle", *partner(FINE), F.col("before").alias("ybefore"))
    once = (F.col("ycomp") == F.col("main")) | (F.col("key") < F.col("y"))
    return able.where("comp <> main").join(other, "shingle").where(possible(FINE, percent) & once & ~F.arrays_overlap("before", "ybefore")).select("key", "n", "y", "yn")


def verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, key: str, text: str, words: int, bound: int, percent: int) -> DataFrame:
    """a, b of the pairs (key, n, y, yn) that link.

    Pairs of two light sets are left out. The parities of all buckets are compared, and sets are made again from the texts of the
    pairs that remain.
    """
    one = pairs.where(F.greatest("n", "yn") > bound).select(F.least("key", "y").alias("a"), F.greatest("key", "y").alias("b"), F.expr("n + yn").alias("total"))
    need = overlap_needed(F.col("total"), percent)
    each = written(one.distinct(), "pairs")
    near = written(near_pairs(each, reps, percent), "near")
    dropped(each)
    active = written(near.select(F.explode(F.array("a", "b")).alias(key)).distinct(), "active")
    full = full_sets(docs.where(F.col(text).isNotNull()).join(hinted(active, 8), key, "left_semi"), key, text, words)
    left = full.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = full.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = near.join(left, "a").join(right, "b")
    return both.where(F.size(F.array_intersect("sa", "sb")) >= need).select("a", "b").distinct()
