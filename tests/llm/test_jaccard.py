import random
import re
from itertools import combinations

import numpy as np

from vantry.llm import jaccard_join as jj


def brute(docs):
    sets = {}
    for key, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: chr(c + 32) for c in range(65, 91)}))
        sets[key] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            r, s = sorted((find(a), find(b)))
            parent[s] = r
    return {k: (len(sets[k]), find(k)) for k in sets}


def check(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component) for r in jj.linked_classes(frame).collect()}
    assert got == brute(docs)


def test_random_texts_against_all_pairs(spark):
    rng = random.Random(11)
    docs = [None, "", "  \t", "one", "ONE", "a b c d", "A b\x0bc d", "a b c d e", "ö Ö", "ö ö", "\x1c x", "nb sp x"]
    words = [f"w{k}" for k in range(400)]
    passage = [rng.choice(words) for _ in range(40)]
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([5, 6, 8, 9, 11, 14, 30, 60, 150]))]
        if rng.random() < 0.4:
            base = passage + base
        for _ in range(rng.randrange(1, 14)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(copy) + 1)
                copy[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
            docs.append(" ".join(copy))
    docs.append("loop " * 4000)
    keys = rng.sample(range(5000), len(docs))
    check(spark, list(zip(keys, docs, strict=True)))


def test_chains_of_near_copies_and_small_sets(spark):
    rng = random.Random(12)
    text = [f"t{k}" for k in range(120)]
    docs = []
    for k in range(25):  # neighbours link, the ends do not
        docs.append((100 - k, " ".join(text)))
        at = rng.randrange(len(text))
        text[at] = f"n{k}"
    for k in range(40):
        docs.append((200 + k, " ".join(f"s{j}" for j in range(rng.randrange(3), rng.randrange(8, 15)))))
    check(spark, docs)
    assert jj.linked_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_test_tables_against_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, docs)


def test_a_pair_below_the_bound_is_made_once_or_twice(spark):
    """Copies that share hundreds of lists and do not link are open pairs a few times, not once for each list they share."""
    rng = random.Random(15)
    base = [f"p{k}" for k in range(600)]
    docs = []
    for k in range(12):
        copy = list(base)
        for j in range(8):  # 40 of 596 shingles are its own: two copies share about 76 %
            copy[70 * j + rng.randrange(60)] = f"q{k}_{j}"
        docs.append((k, " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    sets = jj.prefixes(frame, jj.sketch(frame), "doc_id", "text", jj.WORDS, 80).cache()
    listed = sets.selectExpr("key", "cast(n as int) n", f"posexplode(slice(first, 1, cast({jj.PREFIX.format(p=80, n='n')} as int))) as (pos, shingle)")
    lists = listed.join(listed.groupBy("shingle").count().where("count > 1").select("shingle"), "shingle", "left_semi")
    labels = spark.createDataFrame([], "node long, component long")
    named = jj.named_lists(lists, labels, sets.select("key", *jj.folded(jj.FINE)), jj.FINE, 80).cache()
    made = [(min(r.key, r.y), max(r.key, r.y)) for r in jj.open_pairs(named, 80).collect()]
    assert named.count() > 12 * 20 and len(set(made)) > 12 and len(made) <= 2 * len(set(made))
    assert {c for _, c in brute(docs).values()} == set(range(12))


def test_boundary_grows_with_the_lists():
    assert jj.light_boundary({9: 10}, 1.0) < jj.light_boundary({9: 10, 10: 5}, 10_000.0)


def test_parities_never_differ_in_more_places_than_the_sets():
    rng = np.random.default_rng(13)
    for _ in range(300):
        a, b = (np.unique(rng.integers(0, 400, rng.integers(0, 200)).astype(np.uint64)) for _ in range(2))
        x, y = jj.parities(a), jj.parities(b)
        assert sum(int(v).bit_count() for v in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))


def test_any_boundary_of_light_sets(spark, monkeypatch):
    rng = random.Random(14)
    pair = ["a b c d e f g h i", "a b c d e f g h x"]  # 5 shingles each, 4 shared: no link
    docs = list(enumerate(pair))
    for size in range(1, 17):
        base = [f"v{size}_{j}" for j in range(size)]
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(3)):  # longer, shorter or other words at either end
                at = rng.choice([0, len(copy)])
                copy[at:at] = [f"x{rng.randrange(3)}"]
                if rng.random() < 0.6:
                    del copy[rng.choice([0, -1])]
            docs.append((len(docs), " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3).cache()
    want = brute(docs)
    assert want[0] == (5, 0) and want[1] == (5, 1)
    words = {k: t.split() for k, t in docs}
    sets = {k: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} for k, w in words.items() if w}
    number = {x: k for k, x in enumerate(sorted(set().union(*sets.values())))}
    light = spark.createDataFrame([(k, [number[x] for x in s]) for k, s in sets.items()], "key long, first array<bigint>").repartition(3).cache()
    for bound in range(jj.LIGHT_MOST + 1):
        got = {(r.a, r.b) for r in jj.light_links(light.where(f"size(first) <= {bound}"), bound, 80).collect()}
        links = [(a, b) for a, b in combinations(sorted(sets), 2) if max(len(sets[a]), len(sets[b])) <= bound and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
        assert {(min(x), max(x)) for x in got} <= set(links), bound
        assert parts(got) == parts(links), bound
    monkeypatch.setattr(jj, "light_boundary", lambda *_: 5)
    assert {r.doc_id: (r.n_shingles, r.component) for r in jj.linked_classes(frame).collect()} == want


def parts(links):
    group = {}
    for a, b in links:
        both = group.get(a, {a}) | group.get(b, {b})
        group.update(dict.fromkeys(both, both))
    return {frozenset(g) for g in group.values()}


def test_each_word_is_hashed_once_and_sets_are_those_of_plain_loops(monkeypatch):
    calls = []
    real = jj.xxhash.xxh3_64_intdigest
    monkeypatch.setattr(jj.xxhash, "xxh3_64_intdigest", lambda w: calls.append(w) or real(w))
    rng = random.Random(16)
    words = ["Long" * 30, "long" * 30, "É", "é", "a\x1cb", "nb sp", *"abcdefgh"]
    texts = ["", " \t\x0b", "one"] + ["".join(rng.choice(words) + rng.choice([" ", "\n", "\r \x0c"]) for _ in range(rng.randrange(60))) for _ in range(50)]
    got = jj.shingle_sets([t.encode() for t in texts])
    assert len(calls) == len(set(calls))
    one = lambda ws, seed: [seed := int(jj.mix(np.array([seed ^ real(w)], np.uint64))[0]) for w in ws][-1]  # noqa: E731, F841
    for text, found in zip(texts, got, strict=True):
        ws = text.encode().lower().split()
        want = {one(ws[k : k + 5], 0) for k in range(len(ws) - 4)} if len(ws) >= 5 else {one(ws, 0x5EED + len(ws))} if ws else set()
        assert found.tolist() == sorted(want)
