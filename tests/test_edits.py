import random

import numpy as np
import pandas as pd

from vantry.functions import edits


def matrix(a, b):
    d = [[i + j if not i or not j else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
    return d


def plain_alignment(a, b):
    d, i, j, out = matrix(a, b), len(a), len(b), []
    while i or j:
        if i and j and d[i][j] == d[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and d[i][j] == d[i - 1][j] + 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def test_distance_and_path_against_the_whole_matrix():
    rng = random.Random(0)
    for _ in range(400):
        a, b = ([rng.choice("abcd"[: rng.choice([1, 2, 4])]) for _ in range(rng.choice([0, 1, 3, 20, 90]))] for _ in range(2))
        assert edits.distance(a, b) == matrix(a, b)[-1][-1]
        assert edits.alignment(a, b) == plain_alignment(a, b)


def test_long_sequences():
    a = [f"w{k}" for k in range(3000)]
    b = [x for k, x in enumerate(a) if k % 100] + ["new"]
    path = edits.alignment(a, b)
    assert edits.distance(a, b) == 31 == sum(i is None or j is None or a[i] != b[j] for i, j in path)
    assert edits.distance(["x"], [f"w{k}" for k in range(70_000)]) == 70_000


def test_pairs_against_plain_counts(spark):
    rng = random.Random(3)
    texts = [tuple(" ".join(rng.choice(["nurse", "nerds", "é", "a"]) for _ in range(rng.choice([0, 2, 25]))) for _ in range(2)) for _ in range(60)]
    texts += [(None, "a"), ("a", None), ("  a  b ", "a c"), texts[0]]
    want, of = {}, {}
    for r, h in texts:
        if r is None or h is None:
            continue
        a, b = edits.words(r), edits.words(h)
        for i, j in plain_alignment(a, b):
            if i is not None:
                of[a[i]] = of.get(a[i], 0) + 1
                if j is not None and a[i] != b[j]:
                    want[a[i], b[j]] = want.get((a[i], b[j]), 0) + 1
    frame = spark.createDataFrame([(k, r, h, 1) for k, (r, h) in enumerate(texts)], "id long, ref string, hyp string, n int").repartition(3)
    got = edits.substitution_pairs(frame).collect()
    assert {(r.ref_word, r.hyp_word): r.n for r in got} == want
    assert all(abs(r.share - r.n / of[r.ref_word]) < 1e-12 for r in got)
    steps = edits.aligned_words(frame).where("id = 62").orderBy("step").collect()
    assert [(r.ref_word, r.hyp_word) for r in steps] == [("a", "a"), ("b", "c")]
    assert edits.substitution_pairs(spark.createDataFrame([], "id long, ref string, hyp string")).count() == 0


def test_lanes_against_one_after_the_other():
    """Pairs go together in lanes, in bands where they are near: every number is the plain one's, however long, far or few they are."""
    rng = random.Random(5)
    pairs = []
    for k in range(400):
        a = [rng.randrange(rng.choice([1, 3, 9])) for _ in range(rng.choice([0, 1, 63, 64, 65, 128, 300, 900]))]
        b = [rng.randrange(10) for _ in range(rng.choice([0, 2, 64, 500, 2000]))] if k % 3 == 0 else [x for x in a for x in ([x] if rng.random() > 0.05 else [x, 11] if rng.random() < 0.5 else [])]
        pairs.append((a, b) if k % 2 else (b, a))
    found = edits.distances([np.array(a, np.int64) for a, _ in pairs], [np.array(b, np.int64) for _, b in pairs])
    assert found.tolist() == [edits.distance(a, b) for a, b in pairs]
    edges = ("", "\ud83d", "aé\U0001d11e")
    assert [len(x) for x in edits._points(list(edges))] == [0, 1, 3]


def test_rates_take_pairs_together(spark, monkeypatch):
    """A column of rates is found in lanes; pairs alone, one after the other, are for a few odd lengths."""
    calls = []
    monkeypatch.setattr(edits, "distance", lambda a, b: calls.append(1))
    run = edits._counted(edits._points)
    texts = [f"the patient {k} said no word {k % 7} of it" for k in range(300)]
    got = run(pd.Series([*texts, None]), pd.Series([t[::-1] for t in texts] + ["x"]))
    monkeypatch.undo()
    assert not calls and got.isna().tolist() == [False] * 300 + [True]
    assert got[:300].tolist() == [edits.distance(t, t[::-1]) for t in texts]
