"""A causal self-attention model over subword ids, trained in numpy inside Spark tasks, and texts scored by it.

Words are counted over all training documents: those counts give the base score, the share of each subword id, the
classes of the output layer and its first biases. All training documents train, each in one round. Trainers, as many as a round's texts
ask for, each go over their own documents from the same parameters, and the mean of what they come to, weighted by tokens, is where the next round starts.

A text is cut into windows that overlap: each predicts its last STRIDE tokens and sees up to WINDOW tokens, so every token is scored
once. All windows of a slice of texts go through attention together, under a mask of the future and of what lies before a text.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantry.llm.chunks import gathered, split_words
from vantry.llm.scratch import dropped, hinted, small_batches, written

DIM, INNER = 32, 32
WINDOW, STRIDE = 48, 32  # tokens that a window sees; tokens that it predicts
VOCABULARY = 4096  # ids with vectors of their own
CLASSES = 48
ROUNDS = 3  # every training document trains in one of them
DECAY = 0.4  # of the rate from round to round
TRAINER_BYTES = 4 << 20  # of text of a trainer, about
LEAST_STEPS = 400  # of a trainer: a smaller share of texts is gone over again
BATCH, MOST_BATCH = 32, 256  # windows of a training step: as many as leave LEAST_STEPS steps
RATE = 0.03
HEAD = 100_000  # most frequent words, at most, whose counts go to all tasks; the others' counts are joined
SLICE_BYTES = 1 << 20
BLOCK = 128  # rows of one product
SUMMERS = 8


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def sliced(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.Table]:
    """Batches put together or cut to about `most` bytes of a column, one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False)
        at = 0
        for k, n in enumerate(sizes.tolist()):
            size += n
            if size >= most:
                yield pa.Table.from_batches([*held, batch.slice(at, k + 1 - at)])
                held, size, at = [], 0, k + 1
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def texts_of(table: pa.Table) -> list[bytes]:
    return table.column("text").cast(pa.binary()).to_pylist()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n over all texts (text not null), as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in sliced(batches, "text", 4 * SLICE_BYTES):
            codes, words, _ = split_words(texts_of(table))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(np.bincount(codes, minlength=len(words)))], names=["word", "n"])

    return written(docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


class Subwords:
    """ids of words by the merges of a rank file; a word begins with a blank, so ids of a text's words give the words back."""

    def __init__(self, rank_file: str, pattern: str):
        import tiktoken

        with open(rank_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.end = max(ranks.values()) + 1
        self.encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, number of ids of each word."""
        each = [self.encode(" " + w) for w in words]
        lens = np.fromiter(map(len, each), np.int64, len(each))
        return np.fromiter((x for e in each for x in e), np.int32, int(lens.sum())), lens


class Coder(Subwords):
    """Subwords of texts; the ids of the given words are kept."""

    def __init__(self, rank_file: str, pattern: str, known: list[str]):
        super().__init__(rank_file, pattern)
        self.known = pa.array(known, pa.string()).cast(pa.binary())
        self.flat, lens = super().__call__(known)
        self.lens, self.starts = lens, np.cumsum(lens) - lens

    def texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """Of texts: ids with an end after each text, their number; codes, words, words' places among the known (-1: none), words of each text."""
        codes, words, n = split_words(texts)
        place = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy().astype(np.int64) if len(self.known) else np.full(len(words), -1)
        new = np.flatnonzero(place < 0)
        more, more_lens = super().__call__(words.take(pa.array(new)).cast(pa.string()).to_pylist())
        flat = np.concatenate([self.flat, more, [self.end]]).astype(np.int32)
        starts, lens = np.zeros(len(words) + 1, np.int64), np.ones(len(words) + 1, np.int64)
        old = np.flatnonzero(place >= 0)
        starts[old], lens[old] = self.starts[place[old]], self.lens[place[old]]
        starts[new], lens[new] = len(self.flat) + np.cumsum(more_lens) - more_lens, more_lens
        starts[-1] = len(flat) - 1
        ends = np.cumsum(n)
        row = np.insert(codes, ends, len(words))  # the end after each text
        ids = gathered(flat, starts[row], lens[row])
        total = np.concatenate([[0], np.cumsum(lens[row])])
        return ids, np.diff(total[np.concatenate([[0], ends + np.arange(1, len(n) + 1)])]), codes, words, place, n


class Vocabulary:
    """Places of ids, the most frequent first, and classes of about the same weight (root of counts) of neighbouring places.

    Ids beyond VOCABULARY share the last place; their own probability given that place is their share of counts, each with one more.
    """

    def __init__(self, counts: np.ndarray):
        order = np.argsort(-counts, kind="stable")
        own = order[: min(VOCABULARY - 1, len(order) - 1)]
        self.size = len(own) + 1
        self.place = np.full(len(counts), self.size - 1, np.int32)
        self.place[own] = np.arange(len(own))
        rest = order[len(own) :]
        self.inside = np.zeros(len(counts), np.float32)  # log probability of an id given its place
        self.inside[rest] = np.log((counts[rest] + 1) / (counts[rest].sum() + len(rest)))
        mass = np.concatenate([counts[own], [counts[rest].sum()]]).astype(np.float64) + 1
        weight = np.cumsum(np.sqrt(mass))
        cuts = np.searchsorted(weight, np.arange(1, CLASSES) * weight[-1] / CLASSES)
        self.starts = np.unique(np.concatenate([[0], cuts, [self.size - 1]]))
        self.stops = np.concatenate([self.starts[1:], [self.size]])
        self.kind = np.repeat(np.arange(len(self.starts)), self.stops - self.starts).astype(np.int32)
        by_class = np.bincount(self.kind, mass)
        self.kind = self.kind.astype(np.int16)  # sorted by counting
        self.class_bias = np.log(by_class / by_class.sum()).astype(np.float32)
        self.token_bias = (np.log(mass) - np.log(by_class)[self.kind]).astype(np.float32)


def first_parameters(v: Vocabulary, seed: int = 0) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    normal = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[-2] if len(shape) > 1 else 1)).astype(np.float32)
    p = {"embed": normal(v.size + 1, DIM) * np.float32(np.sqrt(v.size + 1) * 0.3)}  # the last row is the padding before a text
    p |= {k: normal(DIM, DIM) for k in ("query", "key", "value")}
    p |= {"near": np.linspace(0, -2, WINDOW, dtype=np.float32), "inner": normal(DIM, INNER), "inner_bias": np.zeros(INNER, np.float32), "outer": normal(INNER, DIM) * np.float32(0.5)}
    p |= {"classes": np.zeros((DIM, len(v.starts)), np.float32), "class_bias": v.class_bias.copy(), "tokens": np.zeros((v.size, DIM), np.float32), "token_bias": v.token_bias.copy()}
    return p


BACK = np.arange(STRIDE)[:, None] + (WINDOW - STRIDE) - np.arange(WINDOW)[None, :]  # how far a seen token lies behind
FUTURE = BACK < 0


def windows(places: np.ndarray, lens: np.ndarray, end: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts' tokens: seen tokens (windows x WINDOW), tokens to predict (windows x STRIDE; -1: none), text of each window."""
    n = -(-lens // STRIDE)
    before = WINDOW - STRIDE
    room = n * STRIDE + before
    begin = np.cumsum(room) - room
    seen, target = np.full(room.sum(), pad, np.int32), np.full(room.sum(), -1, np.int32)
    at = np.repeat(begin + before - (np.cumsum(lens) - lens), lens) + np.arange(len(places))
    target[at] = places
    shifted = np.concatenate([[end], places[:-1]]).astype(np.int32)
    shifted[np.cumsum(lens) - lens] = end
    seen[at] = shifted
    first = np.repeat(begin - STRIDE * (np.cumsum(n) - n), n) + STRIDE * np.arange(n.sum())
    view = np.lib.stride_tricks.sliding_window_view
    return view(seen, WINDOW)[first], view(target, STRIDE)[first + before], np.repeat(np.arange(len(lens)), n)


def below_highest(x: np.ndarray) -> np.ndarray:
    """Logits less the highest of their row, so no exponential leaves 32-bit numbers."""
    x -= x.max(-1, keepdims=True)
    return x


def tables(p: dict) -> tuple[np.ndarray, ...]:
    """Query, key and value of each place: they depend on the token alone."""
    return (p["embed"] @ p["query"]) * np.float32(1 / math.sqrt(DIM)), p["embed"] @ p["key"], p["embed"] @ p["value"]


@np.errstate(over="ignore", invalid="ignore", divide="ignore")
def log_probabilities(p: dict, vocabulary: Vocabulary, h: np.ndarray, target: np.ndarray, grads: dict | None = None, safe: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural logarithms of the targets' probabilities from hidden rows; with grads, also the mean loss's slope at the rows.

    Rows are sorted by class, so those of a class lie together, and go through the classes' weights BLOCK at a time. Biases are a last
    column of the weights. Exponentials are taken as they are, and all again with the highest of their row away if they leave 32-bit numbers."""
    v, m, ones = vocabulary, len(h), np.ones(vocabulary.size, np.float32)
    kinds = v.kind[target]
    order = np.argsort(kinds, kind="stable")
    kind, at = kinds[order].astype(np.int64), target[order]
    n_kinds = len(v.starts)
    own = np.zeros((-(-m // BLOCK) * BLOCK, DIM + 1), np.float32)
    np.take(h, order, 0, out=own[:m, :DIM], mode="clip")
    own[:m, DIM] = 1
    blocks = own.reshape(-1, BLOCK, DIM + 1)
    tokens = np.concatenate([p["tokens"], p["token_bias"][:, None]], 1)
    z = blocks @ np.concatenate([p["classes"], p["class_bias"][None]])
    if safe:
        below_highest(z)
    one = np.arange(m) * n_kinds + kind
    chosen = z.reshape(-1)[one]
    np.exp(z, out=z)
    total = z.reshape(-1, n_kinds) @ ones[:n_kinds]
    if grads is not None:
        each = np.float32(1 / max(1, m))
        z.reshape(-1, n_kinds)[...] *= (each / total)[:, None]
        z.reshape(-1)[one] -= each
        g = (blocks.transpose(0, 2, 1) @ z).sum(0)
        grads["classes"], grads["class_bias"] = g[:DIM], g[DIM]
        slope = (z @ np.ascontiguousarray(p["classes"].T)).reshape(-1, DIM)[:m]
        more, rows = np.zeros_like(own), np.zeros_like(tokens)
    cuts = np.searchsorted(kind, np.arange(n_kinds + 1))
    sizes = v.stops - v.starts
    places = (np.arange(m) - cuts[kind]) * sizes[kind] + at - v.starts[kind]  # among the logits of a class
    held = np.empty(int((np.diff(cuts) * sizes).max(initial=0)), np.float32)
    inside = np.ones(m, np.float32)
    cuts = cuts.tolist()
    for c, (a, b) in enumerate(zip(v.starts.tolist(), v.stops.tolist(), strict=True)):
        lo, hi = cuts[c], cuts[c + 1]
        if lo == hi or b - a == 1:
            continue
        mine, weights, one = own[lo:hi], tokens[a:b], places[lo:hi]
        flat = held[: (hi - lo) * (b - a)]
        z = flat.reshape(hi - lo, b - a)
        np.matmul(mine, weights.T, out=z)
        if safe:
            below_highest(z)
        chosen[lo:hi] += flat[one]
        np.exp(z, out=z)
        total_inside = np.matmul(z, ones[: b - a], out=inside[lo:hi])
        if grads is not None:
            z *= (each / total_inside)[:, None]
            flat[one] -= each
            np.matmul(z.T, mine, out=rows[a:b])
            np.matmul(z, weights, out=more[lo:hi])
    if not safe and not all(1e-20 < x.min(initial=1) and x.max(initial=1) < 1e30 for x in (total, inside)):
        return log_probabilities(p, vocabulary, h, target, grads, True)
    found = np.empty(m, np.float32)
    found[order] = chosen - np.log(total[:m]) - np.log(inside)
    if grads is None:
        return found, None
    grads["tokens"], grads["token_bias"] = rows[:, :DIM], rows[:, DIM]
    slope += more[:m, :DIM]
    out = np.empty_like(slope)
    out[order] = slope
    return found, out


def slopes(p: dict, vocabulary: Vocabulary, seen: np.ndarray, target: np.ndarray) -> tuple[dict, float]:
    """Slopes of the mean loss at the parameters, and the loss.

    Queries, keys and values are made once for each place that occurs.
    Weights of attention stay exponentials: their sums are the last column of the product with the values, which has a one for each
    token and none for the padding, and division by them is done on the products. What a logit's slope loses by that sum
    is a last column of the product with the values as well, so windows x STRIDE x WINDOW numbers are gone over few times."""
    flat = lambda t: t.reshape(-1, t.shape[-1])
    take = lambda t, at: np.take(t, at, 0, mode="clip")
    n, before, pad = len(seen), WINDOW - STRIDE, vocabulary.size
    ids = seen.ravel().astype(np.uint16)  # sorted by counting
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.diff(ids.astype(np.int32), prepend=-1) > 0
    used, codes = ids[first], np.cumsum(first) - 1
    code = np.empty((n, WINDOW), np.int64)
    code.reshape(-1)[order] = codes
    late = np.ascontiguousarray(code[:, before:])
    scale = np.float32(1 / math.sqrt(DIM))
    weights = np.concatenate([p["query"] * scale, p["key"], p["value"]], 1)
    embed = p["embed"][used]
    made = embed @ weights
    value = np.concatenate([made[:, 2 * DIM :], np.ones((len(used), 1), np.float32)], 1)
    value[used == pad] = 0
    mine, q, k, v = take(embed, late), take(made[:, :DIM], late), take(made[:, DIM : 2 * DIM], code), take(value, code)
    near = np.where(FUTURE, np.float32(0), np.exp(p["near"])[np.maximum(BACK, 0)])
    e = q @ np.ascontiguousarray(k.transpose(0, 2, 1))  # such a product is several times as fast
    if not (e.max(initial=0) < 60 and e.min(initial=0) > -60):
        e -= np.where(FUTURE | (seen == pad)[:, None, :], np.float32(-np.inf), e).max(-1, keepdims=True)
        np.minimum(e, 0, out=e)
    np.exp(e, out=e)
    e *= near
    sums = e @ v
    part = 1 / sums[..., DIM:]
    mean = sums[..., :DIM] * part
    y = mean + mine
    inner = y @ p["inner"]
    inner += p["inner_bias"]
    np.maximum(inner, 0, out=inner)
    h = inner @ p["outer"]
    h += y

    targets = target.ravel()
    real = np.flatnonzero(targets >= 0)
    g: dict = {}
    found, at_rows = log_probabilities(p, vocabulary, take(flat(h), real), targets[real], g)
    out = np.zeros_like(h)
    flat(out)[real] = at_rows
    g["outer"] = flat(inner).T @ flat(out)
    d_inner = out @ np.ascontiguousarray(p["outer"].T)
    d_inner *= inner > 0
    g["inner"], g["inner_bias"] = flat(y).T @ flat(d_inner), np.ones(n * STRIDE, np.float32) @ flat(d_inner)
    d_late, d_all = np.empty((n, STRIDE, 2 * DIM), np.float32), np.empty((n, WINDOW, 2 * DIM), np.float32)
    d_mine = np.add(out, d_inner @ np.ascontiguousarray(p["inner"].T), out=d_late[..., DIM:])
    d_y = np.empty((n, STRIDE, DIM + 1), np.float32)  # over the sum of weights; last, what the sum takes away
    np.multiply(d_mine, part, out=d_y[..., :DIM])
    d_y[..., DIM] = -np.einsum("wsd,wsd->ws", d_y[..., :DIM], mean)
    np.matmul(e.transpose(0, 2, 1), d_y[..., :DIM], out=d_all[..., DIM:])
    d_e = d_y @ np.ascontiguousarray(v.transpose(0, 2, 1))
    d_e *= e
    g["near"] = np.bincount(np.maximum(BACK, 0).ravel(), np.ones(n, np.float32) @ d_e.reshape(n, -1), WINDOW).astype(np.float32)
    np.matmul(d_e, k, out=d_late[..., :DIM])
    np.matmul(d_e.transpose(0, 2, 1), q, out=d_all[..., :DIM])

    starts = np.flatnonzero(seen[:, 0] == pad)
    d_all[starts] *= (seen[starts] != pad)[..., None]
    late_x = d_late @ np.concatenate([p["query"].T * scale, np.eye(DIM, dtype=np.float32)])
    d_x = d_all @ np.concatenate([p["key"].T, p["value"].T])
    d_x[:, before:] += late_x
    g["query"] = (mine.transpose(0, 2, 1) @ d_late[..., :DIM]).sum(0) * scale
    g["key"], g["value"] = np.split((take(embed, code).transpose(0, 2, 1) @ d_all).sum(0), 2, 1)
    g["embed"] = np.zeros_like(p["embed"])
    g["embed"][used] = np.add.reduceat(take(flat(d_x), order), np.flatnonzero(first))
    g["embed"][pad] = 0
    return g, -float(found.sum()) / max(1, len(real))


class Steps:
    """Adam over all parameters as one row of numbers, a part that stays in a core's cache at a time. `p` has views of it."""

    def __init__(self, p: dict):
        self.names = sorted(p)
        self.row = np.concatenate([p[k].ravel() for k in self.names])
        self.p, at = {}, 0
        for k in self.names:
            self.p[k] = self.row[at : at + p[k].size].reshape(p[k].shape)
            at += p[k].size
        self.slope, self.mean, self.square = (np.zeros_like(self.row) for _ in range(3))
        self.buffer = np.empty((2, 1 << 13), np.float32)
        self.moved = np.zeros(-(-len(self.row) // self.buffer.shape[1]), bool)
        self.step = 0

    def __call__(self, g: dict, rate: float) -> None:
        self.step += 1
        np.concatenate([g[k].ravel() for k in self.names], out=self.slope)
        far, root = np.float32(-rate / (1 - 0.9**self.step)), np.float32(1 / math.sqrt(1 - 0.99**self.step))
        for a in range(0, len(self.row), self.buffer.shape[1]):
            row, slope, mean, square = (x[a : a + self.buffer.shape[1]] for x in (self.row, self.slope, self.mean, self.square))
            at = a // self.buffer.shape[1]
            if not (self.moved[at] or slope.any()):
                continue  # no step has moved these
            self.moved[at] = True
            x, y = self.buffer[:, : len(row)]
            np.multiply(slope, slope, out=x)
            x -= square
            x *= np.float32(0.01)
            square += x
            slope -= mean
            slope *= np.float32(0.1)
            mean += slope
            np.sqrt(square, out=x)
            x *= root
            x += np.float32(1e-6)
            np.divide(mean, x, out=y)
            y *= far
            row += y


def trained(p: dict, vocabulary: Vocabulary, seen: np.ndarray, target: np.ndarray, rate: float, seed: int) -> dict:
    """Parameters after steps over all windows in a random order, again until there are LEAST_STEPS of them."""
    steps = Steps(p)
    rng = np.random.default_rng(seed)
    batch = min(MOST_BATCH, max(BATCH, len(seen) // LEAST_STEPS))
    total = max(LEAST_STEPS, -(-len(seen) // batch))
    while steps.step < total:
        order = rng.permutation(len(seen))
        for a in range(0, len(order), batch):
            if steps.step == total:
                break
            mine = order[a : a + batch]
            g, _ = slopes(steps.p, vocabulary, seen[mine], target[mine])
            steps(g, rate * (1 - 0.9 * (steps.step + 1) / total))
    return steps.p


def log_share(h: np.ndarray, weights: np.ndarray, bias: np.ndarray, at: np.ndarray, rows: int = 4096) -> np.ndarray:
    """Logarithm of the share that each row's own logit has of all its exponentials; `rows` at a time, in one buffer."""
    out = np.empty(len(h), np.float32)
    buffer = np.empty((min(rows, len(h)), weights.shape[1]), np.float32)
    ones, count = np.ones(weights.shape[1], np.float32), np.arange(len(buffer))
    for a in range(0, len(h), rows):
        part = h[a : a + rows]
        z = np.matmul(part, weights, out=buffer[: len(part)])
        z += bias
        chosen = z[count[: len(part)], at[a : a + rows]]
        total = np.zeros(1, np.float32)
        if z.max() < 60:
            total = np.exp(z, out=z) @ ones
        if total.min() < 1e-20:  # exponentials out of range: less the highest of the row
            z = part @ weights
            z += bias
            top = z.max(-1)
            chosen -= top
            total = np.exp(z - top[:, None]).sum(-1)
        out[a : a + rows] = chosen - np.log(total)
    return out


class Scorer:
    """Parameters as scoring reads them: one row of query, key and value for each place, as these depend on the token alone. Buffers are made once."""

    def __init__(self, p: dict, vocabulary: Vocabulary, most: int):
        self.p, self.v = p, vocabulary
        self.query, self.key, value = tables(p)
        # a last column of ones sums the weights; the padding has none, so it weighs nothing
        self.value = np.concatenate([value, np.ones((len(value), 1), np.float32)], 1)
        self.value[vocabulary.size] = 0
        self.near = np.where(FUTURE, np.float32(0), np.exp(p["near"])[np.maximum(BACK, 0)]).astype(np.float32)
        make = lambda *shape: np.empty(shape, np.float32)
        n = self.n = 128  # windows that go through attention together
        self.a, self.y, self.q = make(n, STRIDE, WINDOW), make(n, STRIDE, DIM + 1), make(n * STRIDE, DIM)
        self.k, self.val = make(n * STRIDE + WINDOW, DIM), make(n * STRIDE + WINDOW, DIM + 1)
        self.inner, self.outer = make(n * STRIDE, INNER), make(n * STRIDE, DIM)
        self.h, self.own = make(most * STRIDE, DIM), make(most * STRIDE, DIM)

    def hidden(self, seen: np.ndarray, out: np.ndarray) -> None:
        """seen: tokens of neighbouring windows, STRIDE each after WINDOW - STRIDE before the first. The same as `hidden` of each window."""
        before = WINDOW - STRIDE
        n = (len(seen) - before) // STRIDE
        mine = seen[before:]
        shape = lambda x: np.lib.stride_tricks.as_strided(x, (n, WINDOW, x.shape[1]), (x.strides[0] * STRIDE, *x.strides), writeable=False)
        k, v = (np.take(t, seen, 0, out=b[: len(seen)], mode="clip") for t, b in ((self.key, self.k), (self.value, self.val)))
        q = np.take(self.query, mine, 0, out=self.q[: len(mine)], mode="clip")
        a = np.matmul(q.reshape(n, STRIDE, DIM), shape(k).transpose(0, 2, 1), out=self.a[:n])
        if a.max() > 60:
            np.minimum(a, 60, out=a)
        np.exp(a, out=a)
        a *= self.near
        y = np.matmul(a, shape(v), out=self.y[:n]).reshape(-1, DIM + 1)
        np.take(self.p["embed"], mine, 0, out=out, mode="clip")
        mean = np.divide(y[:, :DIM], np.maximum(y[:, DIM:], 1e-30), out=self.outer[: len(mine)])
        out += mean
        windows = lambda x: x.reshape(n, STRIDE, -1)  # noqa: E731  products a window at a time stay in a core's cache
        inner = np.matmul(windows(out), self.p["inner"], out=windows(self.inner[: len(mine)]))
        inner += self.p["inner_bias"]
        np.maximum(inner, 0, out=inner)
        out += np.matmul(inner, self.p["outer"], out=windows(mean)).reshape(out.shape)

    def __call__(self, seen: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the tokens to predict among target (-1: none), and natural logarithms of their probabilities."""
        v, p, before = self.v, self.p, WINDOW - STRIDE
        for a in range(0, len(target), self.n * STRIDE):
            b = min(len(target), a + self.n * STRIDE)
            self.hidden(seen[a : b + before], self.h[a:b])
        real = np.flatnonzero(target >= 0)
        kind = v.kind[target[real]]
        order = np.argsort(kind, kind="stable")
        real, kind = real[order], kind[order]
        own, at = np.take(self.h, real, 0, out=self.own[: len(real)], mode="clip"), target[real]
        out = log_share(own, p["classes"], p["class_bias"], kind)
        cuts = np.searchsorted(kind, np.arange(len(v.starts) + 1))
        for c in np.flatnonzero(np.diff(cuts)).tolist():
            a, b, one = v.starts[c], v.stops[c], slice(cuts[c], cuts[c + 1])
            if b - a > 1:
                out[one] += log_share(own[one], p["tokens"][a:b].T, p["token_bias"][a:b], at[one] - a)
        return real, out


def neighbours(places: np.ndarray, lens: np.ndarray, end: int, pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' tokens one after the other, so that every window begins STRIDE after the one before: seen tokens, tokens to predict
    (-1: none) from the first window's own on, text of each of these. Between texts stands as much padding as a window sees before its own."""
    before = WINDOW - STRIDE
    n = -(-(lens + before) // STRIDE)
    begin = STRIDE * (np.cumsum(n) - n)
    seen, target = np.full(STRIDE * int(n.sum()) + before, pad, np.int32), np.full(STRIDE * int(n.sum()), -1, np.int32)
    at = np.repeat(begin - (np.cumsum(lens) - lens), lens) + np.arange(len(places))
    target[at] = places
    shifted = np.concatenate([[end], places[:-1]]).astype(np.int32)
    shifted[np.cumsum(lens) - lens] = end
    seen[at + before] = shifted
    return seen, target, np.repeat(np.arange(len(lens)), n * STRIDE)


def packed(p: dict) -> bytes:
    return b"".join(p[k].astype("<f4").tobytes() for k in sorted(p))


def unpacked(data: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = data[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


class Model:
    """What scoring needs: counts of the head of the words, subwords, vocabulary, parameters."""

    def __init__(self, rank_file: str, pattern: str, head: list[str], head_counts: np.ndarray, train_tokens: int, distinct: int, vocabulary: Vocabulary, parameters: dict):
        self.rank_file, self.pattern, self.head, self.head_counts = rank_file, pattern, head, head_counts
        self.train_tokens, self.distinct, self.vocabulary, self.parameters = train_tokens, distinct, vocabulary, parameters

    def __getstate__(self) -> dict:
        return {k: x for k, x in self.__dict__.items() if k != "_coder"}

    @property
    def coder(self) -> Coder:
        if not hasattr(self, "_coder"):
            self._coder = Coder(self.rank_file, self.pattern, self.head)
        return self._coder

    def score(self, ids: np.ndarray, lens: np.ndarray, most: int = 1024) -> np.ndarray:
        """log10 of the probability of each text's ids; `most` windows at a time."""
        v = self.vocabulary
        scorer = Scorer(self.parameters, v, most)
        seen, target, text = neighbours(v.place[ids], lens, v.place[self.coder.end], v.size)
        out = np.bincount(np.repeat(np.arange(len(lens)), lens), v.inside[ids].astype(np.float64), len(lens))
        for a in range(0, len(target), most * STRIDE):
            b = min(len(target), a + most * STRIDE)
            real, found = scorer(seen[a : b + WINDOW - STRIDE], target[a:b])
            out += np.bincount(text[a:b][real], found, len(lens))
        return out / math.log(10)


def most_frequent(words: DataFrame, most: int) -> DataFrame:
    """Words of the highest counts, `most` at most: those above a count that a histogram of sixteenths of powers of two gives."""
    step = F.floor(F.log2("n") * 16)
    found = {r.step: r.n_words for r in words.groupBy(step.alias("step")).agg(F.count("*").alias("n_words")).collect()}  # 1,024 rows at most
    least, held = float("inf"), 0
    for at in sorted(found, reverse=True):
        held += found[at]
        if held > most:
            break
        least = at
    return words.where(step >= least) if found and least < float("inf") else words.limit(0)


def rounds(docs: DataFrame, key: str) -> list[tuple[DataFrame, int]]:
    """Documents (key, text) dealt to rounds, each to one, with the bytes of text of each."""
    turn = F.pmod(F.xxhash64(F.col(key).cast("string"), "text"), F.lit(ROUNDS))
    sizes = {r.turn: r.size for r in docs.groupBy(turn.alias("turn")).agg(F.sum(F.octet_length("text")).alias("size")).collect()}  # a row a round
    return [(docs.where(turn == k), sizes.get(k, 0)) for k in range(ROUNDS)]


def learn(docs: DataFrame, words: DataFrame, key: str, rank_file: str, pattern: str) -> Model:
    """The model of training documents (key, text not null) and their word counts."""
    spark = docs.sparkSession
    n_docs, n_words, distinct = *docs.agg(F.count("*")).first(), *words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    best = most_frequent(words, HEAD).collect()
    head, head_counts = [r.word for r in best], np.array([r.n for r in best], np.int64)

    def id_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Subwords(rank_file, pattern)
        total = np.zeros(code.end + 1, np.int64)
        for batch in batches:
            ids, lens = code(batch.column(0).to_pylist())
            np.add.at(total, ids, np.repeat(batch.column(1).to_numpy(), lens))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    counts = np.zeros(Subwords(rank_file, pattern).end + 1, np.int64)
    for r in words.mapInArrow(id_counts, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():  # at most the vocabulary
        counts[r.id] = r.n
    counts[-1] = n_docs
    vocabulary = Vocabulary(counts)
    model = Model(rank_file, pattern, head, head_counts, n_words + n_docs, distinct + (n_docs > 0), vocabulary, first_parameters(vocabulary))

    same = spark.sparkContext.broadcast(model)  # its coder and vocabulary serve all rounds: a worker makes the coder once
    for turn, (share, size) in enumerate(rounds(docs, key)):
        if not size:
            continue
        shared = spark.sparkContext.broadcast(model.parameters)
        rate = RATE * DECAY**turn

        def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            texts = [t for batch in batches for t in batch.column(0).cast(pa.binary()).to_pylist()]  # noqa: B023
            if not texts:
                return
            m = same.value
            v = m.vocabulary
            ids, lens, *_ = m.coder.texts(texts)
            seen, target, _ = windows(v.place[ids], lens, v.place[m.coder.end], v.size)
            p = trained(shared.value, v, seen, target, rate, len(ids))  # noqa: B023
            whole = np.frombuffer(packed(p), "<f4").astype(np.float64) * len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int64()), pa.array([whole.astype("<f8").tobytes()], pa.binary())], names=["n", "sums"])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, sums = 0, None
            for batch in batches:
                for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    row = np.frombuffer(b, "<f8")
                    n, sums = n + a, row.copy() if sums is None else sums + row
            if n:
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums.tobytes()], pa.binary())], names=["n", "sums"])

        kind = "n long, sums binary"
        trainers = -(-size // TRAINER_BYTES)
        dealt = share.select("text").repartition(trainers)
        sums = dealt.mapInArrow(train, kind).repartition(SUMMERS).mapInArrow(add, kind).collect()  # one row a summer
        whole = sum(np.frombuffer(r.sums, "<f8") for r in sums) / sum(r.n for r in sums)
        model.parameters = unpacked(whole, model.parameters)
        shared.unpersist()
    same.unpersist()
    return model


def scored(docs: DataFrame, rank_file: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    The model learns from documents whose crc32(key as text) mod 7 is not 2; a null key is no hash and trains. Null and empty texts have
    the end alone. Repeated rows train and are scored each for itself. Long texts are scored whole. With no training document, base
    counts are 0 and the model is the uniform one that it starts from. Other columns are not read, whatever their names.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), held_out(key).alias("held_out"))
    training = rows.where("not held_out")
    words = word_counts(training)
    model = learn(training, words, "key", rank_file, pattern)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    of_all = math.log10(model.train_tokens + model.distinct + 1)
    ends = training.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        bases = np.log10(m.head_counts + 1.0) - of_all
        mark = TaskContext.get().partitionId() << 40
        for table in sliced(batches, "text"):
            ids, lens, codes, words, place, n = m.coder.texts(texts_of(table))
            of_text = np.repeat(np.arange(len(n)), n)
            at = place[codes]
            old = at >= 0
            base = np.bincount(of_text[old], bases[at[old]], len(n)) + math.log10(ends + 1) - of_all
            known = np.bincount(of_text[old], minlength=len(n)) + (ends > 0)
            # the other words of each text, with their number
            pair, times = np.unique(of_text[~old] * max(1, len(words)) + codes[~old], return_counts=True)
            begins = np.searchsorted(pair, np.arange(len(n) + 1) * max(1, len(words))).astype(np.int32)
            rare = pa.ListArray.from_arrays(pa.array(begins), words.cast(pa.string()).take(pa.array(pair % max(1, len(words)))))
            uses = pa.ListArray.from_arrays(pa.array(begins), pa.array(times.astype(np.int64)))
            marks = pa.array(mark + np.arange(len(n)))
            mark += len(n)
            columns = [marks, table.column("key").combine_chunks(), table.column("held_out").combine_chunks(), pa.array(n + 1), pa.array(known.astype(np.int64)), pa.array(base), pa.array(m.score(ids, lens)), rare, uses]
            yield pa.RecordBatch.from_arrays(columns, names=["mark", "key", "held_out", "n_tokens", "known", "base", "score", "rare", "uses"])

    kind = f"mark long, key {rows.schema['key'].dataType.simpleString()}, held_out boolean, n_tokens long, known long, base double, score double, rare array<string>, uses array<long>"
    done = written(rows.mapInArrow(run, kind), "scored")
    each = done.select("mark", F.explode(F.arrays_zip("rare", "uses")).alias("x")).select("mark", F.col("x.rare").alias("word"), F.col("x.uses").alias("times"))
    found = each.join(words, "word", "left")
    log = (F.log10(F.coalesce("n", F.lit(0)) + 1.0) - F.lit(of_all)) * F.col("times")
    more = found.groupBy("mark").agg(F.sum(log).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    more = written(more, "rare-words")
    zero = F.lit(0)
    out = done.join(hinted(more, 24), "mark", "left").select(
        F.col("key").alias(key), "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score",
    )
    dropped(words)
    return out
