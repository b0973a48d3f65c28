"""The trie of shared conversation prefixes, rolled up by centroid decomposition of its parent edges.

A node is a distinct sequence of first turns, named by a running hash of them. Its subtree's sums need no walk
level by level: the forest of parent edges is cut into components, a component's sum is made once, at its centroid,
and added along the path from the centroid to the component's top; what remains on either side is cut again.

On a cluster this has two stages. The turns that a node's members still have ahead bound its subtree's size (its reach).
Connected nodes whose reach falls into the same multiple of a bound form a component: under one multiple a whole subtree of
at most `bound` nodes, above it a chain of at most `bound` nodes, as two children of one multiple would take its parent out of
it. So every component fits into a task. Those above one multiple are few (in the order of rows / bound) and are rolled up
first, with the sums of their components as values; with bound at least the root of the rows, they fit into a task too.
Then each component is rolled up for itself, with the sums of those that hang on its nodes.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vantry.llm.scratch import dropped, small_batches, written

BOUND = 20_000  # nodes of a component, at least
NAME_BYTES = 16
ROOT = hashlib.sha256().digest()[:NAME_BYTES]
CHUNK = 100_000  # ids of one node that are hashed together


def rollup(parents: list[int], values: list[tuple[int, ...]]) -> list[list[int]]:
    """Sums over the subtree of each node of a forest (parents: indices, -1 for tops; every parent before its children)."""
    n = len(parents)
    totals = [[0] * len(values[0]) for _ in range(n)] if n else []
    home = list(range(n))  # component of a node, named by any number
    first: dict[int, int] = {}
    parts: dict[int, list[int]] = {}
    for v, p in enumerate(parents):
        first[v] = v if p < 0 else first[p]
        parts.setdefault(first[v], []).append(v)
    stack = list(parts.values())
    fresh = n
    size = [0] * n
    while stack:
        part = stack.pop()  # in the order of the forest: its top is first
        top = part[0]
        fresh += 1
        for v in part:
            size[v], home[v] = 1, fresh
        for v in reversed(part[1:]):
            size[parents[v]] += size[v]
        centre = max((v for v in part if 2 * size[v] >= len(part)), key=lambda v: -size[v]) if len(part) > 1 else top
        # the component below the centre, by child; the one above
        below: dict[int, list[int]] = {}
        above: list[int] = []
        label = {centre: centre}
        total = list(values[centre])
        for v in part:
            if v == centre:
                continue
            up = label.get(parents[v]) if v != top else None
            if up is None:
                above.append(v)
                continue
            label[v] = v if up == centre else up
            below.setdefault(label[v], []).append(v)
            for k, x in enumerate(values[v]):
                total[k] += x
        v = centre
        while True:
            for k, x in enumerate(total):
                totals[v][k] += x
            if v == top:
                break
            v = parents[v]
        stack.extend(below.values())
        if above:
            stack.append(above)
    return totals


def rebuilt(turns: DataFrame, most_head: int = 6, family: int = 100) -> tuple[DataFrame, DataFrame]:
    """conv_id, depth, role, text, length of the rebuilt turns; conv_id, length of all conversations.

    The first h turns are those of conversation conv_id - conv_id % family (with the sign of conv_id, as in SQL), h a hash of conv_id below `most_head`.
    """
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    placed = turns.withColumn("pos", F.row_number().over(order) - 1)
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most_head).cast("int")
    own = placed.groupBy("conv_id").agg(F.count("*").cast("int").alias("n")).withColumn("h", head).withColumn("base", F.col("conv_id") - F.col("conv_id") % family)
    heads = own.where("conv_id = base").select("base", F.col("n").alias("base_n"))
    given = F.least("h", F.coalesce("base_n", F.lit(0)))
    plan = own.join(heads, "base", "left").select("conv_id", "base", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))
    front = placed.where((F.col("conv_id") % family == 0) & (F.col("pos") < most_head - 1)).select(F.col("conv_id").alias("base"), "pos", "role", "text")
    taken = plan.join(front, "base").where("pos < given").select("conv_id", (F.col("pos") + 1).alias("depth"), "role", "text", "length")
    kept = placed.join(plan.drop("base"), "conv_id").where("pos >= h").select("conv_id", (F.col("given") + F.col("pos") - F.col("h") + 1).alias("depth"), "role", "text", "length")
    return taken.unionByName(kept), plan.select("conv_id", "length")


def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id, depth, node, parent, chars, reach of turns in the order of conv_id and depth; only a running hash is held."""
    conv, running, name = None, None, ROOT
    for batch in batches:
        nodes, ups = [], []
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "role", "text")), strict=True):
            if c != conv:
                conv, running, name = c, hashlib.sha256(), ROOT
            for part in (role.encode(), text.encode()):
                running.update(len(part).to_bytes(8, "little") + part)
            ups.append(name)
            name = running.copy().digest()[:NAME_BYTES]
            nodes.append(name)
        rows = [batch.column("conv_id"), batch.column("depth"), pa.array(nodes, pa.binary()), pa.array(ups, pa.binary()), pc.utf8_length(batch.column("text")).cast(pa.int64())]
        reach = pc.add(pc.subtract(batch.column("length"), batch.column("depth")), 1).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([*rows, reach], names=["conv_id", "depth", "node", "parent", "chars", "reach"])


def id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, first, ids: runs of rows of one node, their decimal ids joined by commas."""
    for batch in batches:
        nodes, ids = batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()
        cuts = [k for k in range(len(ids)) if k == 0 or nodes[k] != nodes[k - 1]] + [len(ids)]
        spans = list(zip(cuts, cuts[1:], strict=False)) if ids else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([nodes[a] for a, _ in spans], pa.binary()), pa.array([ids[a] for a, _ in spans], pa.int64()), pa.array([",".join(map(str, ids[a:b])) for a, b in spans], pa.string())],
            names=["node", "first", "ids"],
        )


def id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, ends_sha256 of chunks in the order of node and first; only a running hash is held."""
    node, running = None, None
    names = ["node", "ends_sha256"]
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for name, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if name != node:
                if running:
                    done.append((node, running.hexdigest()))
                node, running = name, hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], names=names)
    if running:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([running.hexdigest()], pa.string())], names=names)


SUMS = ("leaves", "saved")


def summed(tables: Iterator[pa.RecordBatch], most: int = 50_000) -> Iterator[pa.RecordBatch]:
    """node and the sums over its subtree within its component, of rows (part, node, parent, depth, leaves, saved) in the order of part and depth."""

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        place: dict[bytes, int] = {}
        for k, r in enumerate(rows):
            place[r[1]] = k
        ups = [place[r[2]] if r[1] != r[0] else -1 for r in rows]
        sums = rollup(ups, [(r[3], r[4]) for r in rows])
        return pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary())] + [pa.array([s[k] for s in sums], pa.int64()) for k in range(2)], names=["node", *SUMS])

    held: list[tuple] = []
    for batch in tables:
        for row in zip(*(batch.column(c).to_pylist() for c in ("part", "node", "parent", *SUMS)), strict=True):
            if len(held) >= most and row[0] != held[-1][0]:
                yield flush(held)
                held = []
            held.append(row)
    if held:
        yield flush(held)


KIND = "node binary, leaves long, saved long"


def trie(conversations: DataFrame, bound: int = BOUND) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    Turns are ordered by turn, nulls first, then by role and text, so ties and repeated rows have one order and repeated rows are turns
    of their own. Null roles and texts are empty; rows without conv_id belong to no conversation and are left out. An empty table has no
    nodes, not even the root. Other columns are not read, whatever their names.
    """
    small_batches(conversations.sparkSession)
    empty = F.lit("")
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), empty).alias("role"), F.coalesce(F.col("text").cast("string"), empty).alias("text"))
    turns, lengths = rebuilt(turns.where("conv_id is not null"))
    # dealt by a hash of the key: dealt by the key itself, the planner takes the union's sides for dealt already, which adaptive execution then undoes
    below = turns.repartition(F.xxhash64("conv_id")).sortWithinPartitions("conv_id", "depth").mapInArrow(named, "conv_id long, depth int, node binary, parent binary, chars long, reach long")
    roots = lengths.select("conv_id", F.lit(0).alias("depth"), F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("chars"), (F.col("length") + 1).cast("long").alias("reach"))
    rows = written(below.unionByName(roots), "prefixes")

    nodes = rows.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("depth").cast("long").alias("depth"), F.max("parent").alias("parent"), F.max("chars").alias("chars"), F.sum("reach").alias("reach"))
    nodes = written(nodes, "nodes")
    n_rows = nodes.agg(F.sum("n_convs")).first()[0] or 0
    bound = max(bound, math.isqrt(n_rows))

    # every node's component, by the path of its least member
    owners = nodes.select("conv_id").distinct()
    bands = nodes.select("node", F.floor(F.col("reach") / bound).alias("band"), F.col("conv_id").alias("owner"))
    path = rows.select("conv_id", "depth", "node").join(owners, "conv_id", "left_semi").join(bands, "node")
    along = Window.partitionBy("conv_id").orderBy("depth")
    begins = F.lag("band").over(along).isNull() | (F.lag("band").over(along) != F.col("band"))
    marked = path.withColumn("begin", F.when(begins, F.col("node")))
    parts = marked.withColumn("part", F.last("begin", ignorenulls=True).over(along)).where("conv_id = owner").select("node", "part", (F.col("band") > 0).alias("heavy"))

    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    leaf = F.col("n_children").isNull().cast("long").alias("leaves")
    saved = ((F.col("n_convs") - 1) * F.col("chars")).alias("saved")
    values = written(nodes.join(parts, "node").join(children, "node", "left").select("node", "part", "heavy", "parent", "depth", F.coalesce("n_children", F.lit(0)).alias("n_children"), leaf, saved), "values")

    tops = values.where("node = part").select("part", "parent", "depth", "heavy")
    whole = values.groupBy("part").agg(*(F.sum(c).alias(c) for c in SUMS)).join(tops, "part")
    above = values.select(F.col("node").alias("parent"), F.col("part").alias("up"))
    whole = written(whole.join(above, "parent", "left"), "parts")
    hung = whole.where("not heavy").groupBy(F.col("up").alias("part")).agg(*(F.sum(c).alias(f"{c}_more") for c in SUMS))
    heavy = whole.where("heavy").join(hung, "part", "left").select(
        F.lit(ROOT).alias("part"), F.col("part").alias("node"), F.col("up").alias("parent"), "depth", *((F.col(c) + F.coalesce(f"{c}_more", F.lit(0))).alias(c) for c in SUMS)
    )
    heavy = heavy.repartition(1).sortWithinPartitions("depth").mapInArrow(summed, KIND)  # as many as rows / bound
    full = whole.where("not heavy").select("parent", *SUMS).unionByName(whole.where("heavy").select("parent", F.col("part").alias("node")).join(heavy, "node").select("parent", *SUMS))
    more = full.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(*(F.sum(c).alias(f"{c}_more") for c in SUMS))
    ready = values.join(more, "node", "left").select("part", "node", "parent", "depth", *((F.col(c) + F.coalesce(f"{c}_more", F.lit(0))).alias(c) for c in SUMS))
    sums = ready.repartition("part").sortWithinPartitions("part", "depth").mapInArrow(summed, KIND)

    ends = rows.where("reach = 1").select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = ends.mapInArrow(id_chunks, "node binary, first long, ids string")
    ends = chunks.repartition("node").sortWithinPartitions("node", "first").mapInArrow(id_hashes, "node binary, ends_sha256 string")

    up = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    facts = nodes.select("node", "conv_id", "depth", "parent", "n_convs").join(values.select("node", "n_children"), "node").join(sums, "node").join(ends, "node", "left").join(up, "parent", "left")
    out = facts.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"))
    out = written(out, "trie")
    dropped(rows, nodes, values, whole)
    return out
