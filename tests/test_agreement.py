import random
from itertools import permutations

import pandas as pd
import pytest

from vantry.operators import agreement


def plain_der(turns, gold):
    """Tenths of a second, one after the other, with every way to pair speakers."""
    on = lambda rows, t: {r[3] for r in rows if None not in r and r[1] <= t < r[2]}
    ticks = [(on(gold, t), on(turns, t)) for t in range(60)]
    refs, hyps = (sorted(set().union(*side)) for side in zip(*ticks, strict=True))
    few, many = sorted((refs, hyps), key=len)
    flip = few is hyps
    best = 0
    for order in permutations(many, len(few)):
        pairs = {(b, a) if flip else (a, b) for a, b in zip(few, order, strict=True)}
        best = max(best, sum((r, h) in pairs for R, H in ticks for r in R for h in H))
    total = sum(len(r) for r, _ in ticks)
    wrong = sum(max(len(r), len(h)) for r, h in ticks) - best
    return total, wrong


@pytest.mark.parametrize("seed", range(3))
def test_der_against_all_pairings(spark, seed):
    rng = random.Random(seed)

    def some(case, names):
        return [(case, s := rng.randrange(50), s + rng.randrange(0, 9), rng.choice(names)) for _ in range(rng.randrange(1, 9))]

    gold, turns = [], []
    for case in ("a", "b", "c"):
        gold += some(case, "xyz")
        turns += some(case, "1234")
    gold += [("d", 1, 5, None), ("e", 1, 5, "x"), ("e", 3, 5, "x")]
    turns += [("d", 2, 6, "1")]
    kind = "case_id string, start_s double, end_s double, speaker string"
    rows = lambda x: spark.createDataFrame([(c, float(s), float(e), w) for c, s, e, w in x], kind)
    got = {r.case_id: r for r in agreement.der(rows(turns), rows(gold)).collect()}
    for case in sorted({*got, "a", "b", "c", "d", "e"}):
        total, wrong = plain_der([r for r in turns if r[0] == case], [r for r in gold if r[0] == case])
        if total + wrong == 0:
            assert case not in got
            continue
        assert got[case].total_s == pytest.approx(total)
        assert got[case].miss_s + got[case].false_alarm_s + got[case].confusion_s == pytest.approx(wrong)
        assert (got[case].der is None) == (total == 0)
    assert agreement.der(rows([]), rows([])).count() == 0


def test_tags_and_pairs(spark):
    words = spark.createDataFrame([("1", "Ana,"), ("1", "ana"), ("2", "Ana"), ("1", None), ("1", "3/4/99."), ("2", "000123")], "case_id string, word string")
    names = spark.createDataFrame([("1", "Ana", "[B]"), ("1", "ANA", "[A]"), ("2", "?", "[C]")], "case_id string, name string, tag string")
    assert sorted(str(r.word) for r in agreement.phi_tagged(words, names).collect()) == sorted(["[A]", "[A]", "Ana", "None", "[DOB]", "[ID]"])
    texts = spark.createDataFrame([("1", "x", "a b c"), ("1", "y", "A, c"), ("1", "z", None), ("2", "x", "q")], "case_id string, annotator string, text string")
    assert [tuple(r) for r in agreement.annotator_agreement(texts).collect()] == [("1", "x", "y", 0.3333)]


def test_speakers_of_many_cases_are_paired_in_one_call():
    """Cases go to Python in batches; each is paired by itself, with any numbers of speakers on either side."""
    rows = [(["a", "a", "b"], ["x", "y", "x"], [1.0, 2.0, 5.0]), (["a"], ["x"], [3.0]), (["a", "b", "c"], ["x", "x", "x"], [1.0, 4.0, 2.0])]
    got = agreement._shared(*(pd.Series([r[k] for r in rows]) for k in range(3)))
    assert got.tolist() == [7.0, 3.0, 4.0]
