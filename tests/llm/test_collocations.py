import random
import re
from collections import Counter

import duckdb
import pytest

from vantry.llm import collocations, queries


def plain(docs, top=2000):
    """The contract by dictionaries, one language after the other."""
    out = []
    for lang in sorted({x or "und" for x, _ in docs}):
        f = Counter()
        for x, text in docs:
            if (x or "und") == lang:
                low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
                for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
                    w = re.findall("[^ \t]+", piece)
                    f.update(tuple(w[k : k + o]) for o in (1, 2, 3) for k in range(len(w) - o + 1))
        n = sum(c for p, c in f.items() if len(p) == 1)
        cand = {p: c for p, c in f.items() if len(p) > 1 and c >= 10}
        rows = []
        for p, a in cand.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in cand.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))  # noqa: E741
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        out += [(lang, k, p.decode(), -a, l, r, n, -s) for k, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1)]
    return out


def got(spark, docs, **more):
    frame = spark.createDataFrame(docs, "lang string, text string")
    return sorted(tuple(r) for r in collocations.collocations(frame, **more).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


@pytest.mark.parametrize("seed", range(2))
def test_against_dictionaries(spark, seed):
    rng = random.Random(seed)
    words = ["A", "a", "é", "É", "b-c", " ", "x\x00", "d" * 50]
    docs = []
    for _ in range(60):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\r\n", "!?"]) for _ in range(rng.choice([0, 1, 2, 30, 90])))
        docs.append((rng.choice(["en", "en", "fr", None, "und"]), text))
    docs += [("en", None), ("en", ""), ("fr", "  \t "), (None, None), docs[0], docs[0]]
    assert got(spark, docs) == sorted(plain(docs))
    assert got(spark, docs, top=3) == sorted(plain(docs, 3))


def test_longer_candidates_overlaps_and_ties(spark):
    docs = [("en", "a b c. " * 10 + "a b " * 9), ("en", "z z z z z z z z z z z z z"), ("de", "q w. " * 10 + "e r! " * 10), ("it", "u v. " * 9)]
    assert got(spark, docs) == sorted(plain(docs))
    assert [r[2] for r in got(spark, docs) if r[0] == "de"] == ["e r", "q w"]


def test_counts_beyond_64_bit_products(spark, monkeypatch):
    big = 3_000_000_000
    monkeypatch.setattr(collocations, "counted", lambda docs, order, bits, label: spark.createDataFrame(
        [[("x", "p", big), ("x", "q", big + 7)], [("x", "p", "q", big - 5)], []][order - 1], ["lang string, w1 string, n long", "lang string, w1 string, w2 string, n long", "lang string, w1 string, w2 string, w3 string, n long"][order - 1]))
    (row,) = got(spark, [("x", "")])
    assert row[7] == 10**6 * (big - 5) ** 2 // (big * (big + 7))


def test_empty_and_clashing_columns(spark):
    assert got(spark, []) == [] and got(spark, [(None, None)]) == []
    frame = spark.createDataFrame([(1, "en", "w x. " * 10, "y", 5)], "n long, lang string, text string, w1 string, total int")
    assert [r.phrase for r in collocations.collocations(frame).collect()] == ["w x"]


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{d}/documents.parquet'")
    want = con.execute(queries.OP11_SQL).fetchall()
    frame = queries.op11_phrase_collocations(spark, d)
    assert len(want) > 50 and sorted(want) == sorted(tuple(r) for r in frame.collect())
