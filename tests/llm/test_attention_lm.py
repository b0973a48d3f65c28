import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from vantry.llm import attention_lm as lm
from vantry.llm import queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
NAMES = "key held_out n_tokens n_known train_tokens base_score".split()


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x20\x09-\x0d]+", low)


def plain(docs):
    """All but the model's score, by dictionaries."""
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    counts = Counter(w for k, t in docs if not out(k) for w in words_of(t))
    ends = sum(not out(k) for k, _ in docs)
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    rows = []
    for k, t in docs:
        ws = words_of(t)
        c = [counts[w] for w in ws] + [ends]
        rows.append((k, out(k), len(c), sum(x > 0 for x in c), n, sum(math.log10((x + 1) / (n + v + 1)) for x in c)))
    return rows


def small_model(seed=0):
    """Random parameters over a few counts."""
    rng = np.random.default_rng(seed)
    counts = np.zeros(50_257, np.int64)
    counts[rng.integers(0, 50_257, 6000)] = rng.integers(1, 900, 6000)
    counts[:300] = 50
    v = lm.Vocabulary(counts)
    p = lm.first_parameters(v, seed)
    p["classes"], p["tokens"] = (rng.standard_normal(p[k].shape).astype(np.float32) * 0.3 for k in ("classes", "tokens"))
    return lm.Model(RANKS, public_tokenizers.PATTERN, [], np.zeros(0, np.int64), 0, 0, v, p)


def plain_log10(m, ids):
    """One token after the other, each from the tokens that its window sees."""
    p, v = {k: x.astype(np.float64) for k, x in m.parameters.items()}, m.vocabulary
    places = [int(v.place[m.coder.end])] + [int(v.place[x]) for x in ids]
    total = 0.0
    for i, target in enumerate(places[1:]):
        first = max(0, i // lm.STRIDE * lm.STRIDE - (lm.WINDOW - lm.STRIDE))
        seen = p["embed"][places[first : i + 1]]
        score = [seen[-1] @ p["query"] @ (x @ p["key"]) / math.sqrt(lm.DIM) + p["near"][i - first - k] for k, x in enumerate(seen)]
        weight = np.exp(score - np.max(score))
        y = seen[-1] + (weight / weight.sum()) @ (seen @ p["value"])
        h = y + np.maximum(y @ p["inner"] + p["inner_bias"], 0) @ p["outer"]
        z = h @ p["classes"] + p["class_bias"]
        kind = v.kind[target]
        a, b = v.starts[kind], v.stops[kind]
        inside = h @ p["tokens"][a:b].T + p["token_bias"][a:b]
        total += z[kind] - np.log(np.exp(z).sum()) + inside[target - a] - np.log(np.exp(inside).sum()) + v.inside[ids[i]]
    return total / math.log(10)


def test_batched_windows_equal_token_by_token():
    m = small_model()
    rng = random.Random(1)
    texts = [b"", b"Ab", "é 漢字 x\x00y".encode(), " ".join(rng.choice(["the", "thononouinwh", "éèau", "1234"]) for _ in range(90)).encode()]
    ids, lens, *_ = m.coder.texts(texts)
    got = m.score(ids, lens, most=3)
    cuts = np.concatenate([[0], np.cumsum(lens)])
    for k in range(len(texts)):
        own = ids[cuts[k] : cuts[k + 1]]
        assert got[k] == pytest.approx(plain_log10(m, own.tolist()), rel=1e-4)
        assert m.score(own, lens[k : k + 1])[0] == pytest.approx(got[k], rel=1e-5)


def test_probabilities_sum_to_one():
    m = small_model(3)
    h = np.random.default_rng(0).standard_normal((1, lm.DIM)).astype(np.float32)
    v = m.vocabulary
    every, _ = lm.log_probabilities(m.parameters, v, np.repeat(h, v.size, 0), np.arange(v.size))
    assert np.exp(every.astype(np.float64)).sum() == pytest.approx(1, abs=1e-3)
    last = v.place == v.size - 1
    assert np.exp(v.inside[last].astype(np.float64)).sum() == pytest.approx(1, abs=1e-3) and (v.inside[~last] == 0).all()


def test_slopes_against_differences():
    m = small_model(2)
    v, p = m.vocabulary, m.parameters
    ids, lens, *_ = m.coder.texts([b"the cat and the dog " * 9, b"a"])
    seen, target, _ = lm.windows(v.place[ids], lens, v.place[m.coder.end], v.size)
    g, _ = lm.slopes(p, v, seen, target)
    for name in p:
        at = tuple(x[0] for x in np.nonzero(np.abs(g[name]) == np.abs(g[name]).max()))
        step, losses = 1e-2, []
        for sign in (1, -1):
            q = {k: x.copy() for k, x in p.items()}
            q[name][at] += sign * step
            losses.append(lm.slopes(q, v, seen, target)[1])
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(float(g[name][at]), rel=0.05, abs=1e-4), name


def padded_windows(v, end):
    """Windows of texts of 1 to 200 tokens, most of which begin with padding."""
    rng = np.random.default_rng(6)
    lens = np.concatenate([[1, 2, 31, 32, 33, 200], rng.integers(1, 60, 40)])
    return lm.windows(v.place[rng.integers(0, 50_257, lens.sum())], lens, v.place[end], v.size)[:2]


@pytest.mark.parametrize("far", [1.0, 40.0])
def test_slopes_do_not_depend_on_how_windows_go_together(far):
    """The mean slope of all windows is that of single ones; also where exponentials leave 32-bit numbers."""
    m = small_model(4)
    v, p = m.vocabulary, {k: x * np.float32(far if k in ("query", "classes") else 1) for k, x in m.parameters.items()}
    seen, target = padded_windows(v, m.coder.end)
    got, loss = lm.slopes(p, v, seen, target)
    weight = (target >= 0).sum(1) / (target >= 0).sum()
    alone = [lm.slopes(p, v, seen[k : k + 1], target[k : k + 1]) for k in range(len(seen))]
    assert loss == pytest.approx(sum(w * one for w, (_, one) in zip(weight, alone, strict=True)), rel=1e-4)
    for name in p:
        want = sum(w * g[name].astype(np.float64) for w, (g, _) in zip(weight, alone, strict=True))
        assert np.abs(got[name] - want).max() < 1e-3 * np.abs(want).max() + 1e-7, name


def test_value_slope_leaves_padding_out():
    """What stands for padding weighs nothing, so no slope reaches the values through it."""
    m = small_model(5)
    v, p = m.vocabulary, m.parameters
    seen, target = padded_windows(v, m.coder.end)
    g, _ = lm.slopes(p, v, seen, target)
    move = np.random.default_rng(1).standard_normal((lm.DIM, lm.DIM)).astype(np.float32) * 1e-2
    losses = [lm.slopes({**p, "value": p["value"] + sign * move}, v, seen, target)[1] for sign in (1, -1)]
    assert losses[0] - losses[1] == pytest.approx(2 * float((g["value"] * move).sum()), rel=0.03)
    assert not g["embed"][v.size].any()


def test_steps_are_those_of_plain_adam():
    rng = np.random.default_rng(2)
    p = {"a": rng.standard_normal((300, 70)).astype(np.float32), "b": rng.standard_normal(5).astype(np.float32)}
    want, mean, square = {k: x.astype(np.float64) for k, x in p.items()}, dict.fromkeys(p, 0.0), dict.fromkeys(p, 0.0)
    steps = lm.Steps(p)
    for step in range(1, 7):
        g = {k: rng.standard_normal(x.shape).astype(np.float32) for k, x in p.items()}
        g["a"][100 if step < 4 else 200 :] = 0  # never moved, or moved later
        steps(g, 0.03)
        for k in p:
            mean[k], square[k] = mean[k] * 0.9 + 0.1 * g[k], square[k] * 0.99 + 0.01 * g[k].astype(np.float64) ** 2
            want[k] -= 0.03 / (1 - 0.9**step) * mean[k] / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-6)
    for k in p:
        assert np.abs(steps.p[k] - want[k]).max() < 1e-5
    assert (steps.p["a"][200:] == p["a"][200:]).all()


def test_base_against_dictionaries(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 5)
    monkeypatch.setattr(lm, "LEAST_STEPS", 2)
    rng = random.Random(4)
    words = ["The", "the", "É", "é", "x\x00", "a,b", " ", "w" * 400] + [f"r{k}" for k in range(60)]
    docs = [(k, "".join(rng.choice(words) + rng.choice([" ", "\t", "\n", "\x0b\x0c", "  "]) for _ in range(rng.choice([0, 1, 5, 200])))) for k in range(80)]
    docs += [(500, None), (501, ""), (None, "the lost key"), docs[3], docs[3], (502, "\x1c \x85 é")]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in docs], "doc_id long, text string, word string, mark int").repartition(3)
    got = lm.scored(frame, RANKS, public_tokenizers.PATTERN).collect()
    order = lambda rows: sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for a, b in zip(order([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got]), order(plain(docs)), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9)
    assert all(r.score < 0 for r in got)


def test_most_frequent_words(spark):
    words = spark.createDataFrame([(f"w{k}", n) for k, n in enumerate([1] * 20 + [2] * 5 + [9, 1000, 10**12])], "word string, n long")
    assert [sorted(r.n for r in lm.most_frequent(words, most).collect()) for most in (0, 1, 3, 7, 8, 99)] == [[], [10**12], [9, 1000, 10**12], [9, 1000, 10**12], [2] * 5 + [9, 1000, 10**12], sorted([1] * 20 + [2] * 5 + [9, 1000, 10**12])]
    assert lm.most_frequent(words.limit(0), 5).count() == 0


def test_every_document_trains_once(spark):
    """Nothing is left out of training, however much there is; repeated rows and null keys train too."""
    docs = spark.range(3000).selectExpr("if(id % 100 = 3, null, id % 2900) key", "concat(repeat('word ', 1000), id % 2900) text")
    shares = lm.rounds(docs, "key")
    whole = shares[0][0]
    for share, _ in shares[1:]:
        whole = whole.unionAll(share)
    assert whole.exceptAll(docs).isEmpty() and docs.exceptAll(whole).isEmpty()
    assert [size for _, size in shares] == [share.selectExpr("sum(octet_length(text)) n").first().n for share, _ in shares]


def test_empty_table_and_no_training_rows(spark):
    kind = "doc_id long, text string"
    assert lm.scored(spark.createDataFrame([], kind), RANKS, public_tokenizers.PATTERN).collect() == []
    k = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 7 == 2)
    (row,) = lm.scored(spark.createDataFrame([(k, "a b")], kind), RANKS, public_tokenizers.PATTERN).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0) and row.base_score == 0.0


def test_model_beats_word_counts_on_held_out_texts(spark):
    rows = queries.op13_attention_lm(spark, "/root/testdata/sf0.01").collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and len(out) > 80
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: r for r in plain(docs)}
    assert all((r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][2:5] and r.base_score == pytest.approx(want[r.doc_id][5], rel=1e-9) for r in rows)
