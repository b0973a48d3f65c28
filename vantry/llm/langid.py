"""Language identification by string kernels.

The kernel of two texts is a blended spectrum of presence: for each order n from 1 to ORDERS,
the number of distinct character n-grams that both have, divided by the root of the product of
their numbers of distinct n-grams, averaged over the orders. Texts are lower-cased; everything
but letters counts as a blank. n-grams are hashed into WIDTH places an order.

Nystroem: a bounded sample of landmarks stands for the kernel matrix; kernel ridge regression
with one target per language (one against the rest, +1 and -1) is solved in the space of the
landmarks on a bounded sample of labelled texts. Scoring is one matrix product of a batch of
presence vectors with the landmarks and one with the weights; it is a narrow map.

LANDMARKS and TRAINING bound the sample in rows; the rows are those with the lowest hashes of
their key, an equal share for each language, so that they do not depend on the layout of the
table. Everything else covers whole texts of all rows.

The score is the best language's value between what a text without evidence gets (0; with K languages
the K values add up to 2 - K, so that is 1 / K of the way) and certainty (1). `least` of a model is a bound
that the labelled rows of the sample hold with a wide margin; texts in no learned language mostly do not.

A text that is null, empty or without any letter gets `und` with score 0. Without labelled rows
every text does. Repeated rows are scored alike; null keys are kept. Other columns are carried as asked
for, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantry.llm.chunks import slices
from vantry.llm.scratch import small_batches

ORDERS = 4
WIDTH = 4096
LANDMARKS = 192
TRAINING = 2400
RIDGE = 1e-2
UNKNOWN = "und"
LEAST_QUANTILE = 0.01  # of the scores of labelled rows
LEAST_SHARE = 0.35  # of that quantile is the least score of a learned language


def _places(points: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: where n-grams start, and their places. points: classes of code points; starts: of texts."""
    n = len(points)
    code = np.zeros(n, np.uint32)
    inside = np.ones(n, bool)
    border = np.zeros(n + 1, bool)
    border[starts] = True
    for order in range(ORDERS):
        if order:
            inside = inside[: n - order] & ~border[order:n]
        size = n - order
        if size <= 0:
            return
        code = code[:size] * np.uint32(0x9E3779B1) + points[order:] + np.uint32(1)
        mixed = code ^ (code >> np.uint32(15))
        mixed = (mixed * np.uint32(0x85EBCA6B)) >> np.uint32(20)  # WIDTH = 2 ** 12
        yield np.flatnonzero(inside), mixed[inside].astype(np.int64) + order * WIDTH


def _letters() -> np.ndarray:
    """Lower-case class of each code point below 0x3000; 0 for what is no letter. Others count as letters by themselves."""
    table = np.zeros(0x3000, np.uint32)
    for point in range(0x3000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


_TABLE: list[np.ndarray] = []


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Presence vectors (rows scaled so that the product of two is the kernel) and whether a text has a letter."""
    if not _TABLE:
        _TABLE.append(_letters())
    table = _TABLE[0]
    out = np.zeros((len(texts), ORDERS * WIDTH), np.float32)
    spelled = np.zeros(len(texts), bool)
    if not texts:
        return out, spelled
    joined = "".join(texts)
    raw = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens)
    starts = ends - lens
    high = raw >= len(table)
    points = table[np.where(high, 0, raw)]
    if high.any():
        points[high] = [p if chr(p).isalpha() else 0 for p in raw[high].tolist()]
    # runs of blanks count once
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 0) | (points[:-1] != 0)
    keep[starts[lens > 0]] = True
    owner = np.repeat(np.arange(len(texts)), lens)[keep]
    points = points[keep]
    spelled[np.unique(owner[points != 0])] = True
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, np.int64)
    for at, places in _places(points, first):
        out[owner[at], places] = 1
    for order in range(ORDERS):
        part = out[:, order * WIDTH : (order + 1) * WIDTH]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * ORDERS)
    return out, spelled


class Model:
    """Landmark vectors, weights, constants and the names of the languages."""

    def __init__(self, landmarks: np.ndarray, weights: np.ndarray, constants: np.ndarray, names: list[str], least: float = 0.0):
        self.landmarks, self.weights, self.constants, self.names, self.least = landmarks, weights, constants, names, least

    def score(self, best: np.ndarray) -> np.ndarray:
        floor = 1 / len(self.names) if len(self.names) > 1 else 0.0
        return np.clip(((best + 1) / 2 - floor) / (1 - floor), 0, 1)

    def predict(self, texts: list[str], rows: int = 128) -> tuple[list[str], np.ndarray]:
        names, scores = [], np.zeros(len(texts))
        for at in range(0, len(texts), rows):
            vectors, spelled = presence(texts[at : at + rows])
            if self.names:
                values = (vectors @ self.landmarks.T) @ self.weights + self.constants
                best = values.argmax(axis=1)
                scores[at : at + rows] = np.where(spelled, self.score(values[np.arange(len(best)), best]), 0)
                names += [self.names[k] if ok else UNKNOWN for k, ok in zip(best.tolist(), spelled.tolist(), strict=True)]
            else:
                names += [UNKNOWN] * len(spelled)
        return names, scores


def fit(vectors: np.ndarray, labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model:
    """Model of labelled presence vectors; landmarks are taken in turns from the languages."""
    names = sorted(set(labels))
    if not names:
        return Model(np.zeros((0, ORDERS * WIDTH), np.float32), np.zeros((0, 0), np.float32), np.zeros(0, np.float32), [])
    turn: dict[str, int] = {}
    rank = []
    for k, label in enumerate(labels):
        turn[label] = turn.get(label, -1) + 1
        rank.append((turn[label], label, k))
    chosen = [k for _, _, k in sorted(rank)[:landmarks]]
    marks = vectors[chosen]
    kernel = (vectors @ marks.T).astype(np.float64)
    square = (marks @ marks.T).astype(np.float64)
    values, basis = np.linalg.eigh(square)
    good = values > 1e-6 * max(values.max(), 1e-12)
    root = basis[:, good] / np.sqrt(values[good])  # maps kernel rows to Nystroem features
    features = kernel @ root
    targets = np.where(np.array(labels)[:, None] == np.array(names)[None], 1.0, -1.0)
    weight = 1.0 / np.array([labels.count(x) for x in labels], float)
    weight *= len(labels) / weight.sum()
    bias = np.hstack([features, np.ones((len(labels), 1))])
    gram = bias.T @ (bias * weight[:, None]) + ridge * np.diag([1.0] * features.shape[1] + [1e-6])
    solved = np.linalg.solve(gram, bias.T @ (targets * weight[:, None]))
    model = Model(marks.astype(np.float32), (root @ solved[:-1]).astype(np.float32), solved[-1].astype(np.float32), names)
    own = (bias @ solved)[np.arange(len(labels)), [names.index(x) for x in labels]]
    model.least = float(LEAST_SHARE * np.quantile(model.score(own), LEAST_QUANTILE))
    return model


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", landmarks: int = LANDMARKS, training: int = TRAINING) -> Model:
    """Model of the labelled rows of docs; reads the texts of at most `training` of them. Rows without text are left out."""
    spark = docs.sparkSession
    small_batches(spark)
    known = docs.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"))
    counts = known.groupBy("label").count().orderBy(F.desc("count"), "label").limit(training).collect()  # labels beyond the sample's size cannot be learned
    if not counts:
        return fit(np.zeros((0, ORDERS * WIDTH), np.float32), [])
    share = max(1, training // len(counts))
    # one pass for all labels: rows with hashes under a bound that leaves somewhat more than the share
    bounds = spark.createDataFrame([(r["label"], min(1.0, (1.2 * share + 30) / r["count"])) for r in counts], "label string, part double")
    order = F.xxhash64("key")
    low = known.join(F.broadcast(bounds), "label").where(order / 2.0**64 + 0.5 < F.col("part")).select("label", "key", order.alias("h")).distinct()
    found: dict[str, list] = {}
    for r in low.collect():  # a little over `training` keys
        found.setdefault(r["label"], []).append((r["h"], r["key"]))
    keys = [k for rows in found.values() for _, k in sorted(rows)[:share]]
    wanted = F.broadcast(spark.createDataFrame([(k,) for k in sorted(set(keys))], docs.select(F.col(key).alias("key")).schema))
    rows = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("key"), F.col(label).cast("string").alias("label"), F.col(text).alias("text")).join(wanted, "key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2, 256 << 10):
                vectors, _ = presence(part.column(2).to_pylist())
                bits = [np.packbits(v > 0).tobytes() for v in vectors]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(bits, pa.binary())], ["key", "label", "bits"])

    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(run, f"key {kind}, label string, bits binary").collect()  # at most 2 KB for each of the `training` rows, but for repeated keys
    found = sorted(found, key=lambda r: (hash_order(r["key"]), r["label"], bytes(r["bits"])))[: 2 * training]
    vectors = np.zeros((len(found), ORDERS * WIDTH), np.float32)
    for k, r in enumerate(found):
        vectors[k] = np.unpackbits(np.frombuffer(r["bits"], np.uint8))
    for order in range(ORDERS):
        part = vectors[:, order * WIDTH : (order + 1) * WIDTH]
        part /= np.sqrt(np.maximum(part.sum(axis=1, keepdims=True), 1) * ORDERS)
    return fit(vectors, [r["label"] for r in found], landmarks)


def hash_order(key) -> int:
    import zlib

    return zlib.crc32(repr(key).encode())


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", keep: bool = False) -> DataFrame:
    """key, lang_pred, score; with keep instead row (a struct of all columns of docs), lang_pred, score."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks x 16,384 numbers
    rows = docs.select(F.struct("*").alias("row")) if keep else docs.select(F.struct(F.col(key).alias("key"), F.col(text).alias("text")).alias("row"))
    place = docs.columns.index(text) if keep else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(0).field(place)
            at = 0
            for part in slices(pa.RecordBatch.from_arrays([texts], ["text"]), 0, 1 << 20):
                names, scores = model.predict([x or "" for x in part.column(0).to_pylist()])
                row = batch.column(0).slice(at, len(part))
                at += len(part)
                yield pa.RecordBatch.from_arrays([row if keep else row.field(0).slice(0, len(part)), pa.array(names, pa.string()), pa.array(scores)], ["row", "lang_pred", "score"])

    kind = rows.schema["row"].dataType.simpleString() if keep else docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(run, f"row {kind}, lang_pred string, score double")
    return out if keep else out.withColumnRenamed("row", key)
