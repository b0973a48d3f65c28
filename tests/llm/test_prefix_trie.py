import hashlib
import random
import zlib

import duckdb
import pytest

from vantry.llm import prefix_trie, queries

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain(rows):
    """The contract with whole prefixes as keys."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    turns = {c: [(r.decode(), t.decode()) for *_, r, t in sorted(x)] for c, x in turns.items()}
    made = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = abs(c) // 100 * 100 * (1 if c > 0 else -1)  # % of SQL takes the sign of c
        made[c] = turns.get(base, [])[:h] + own[h:]
    nodes = {}
    for c, seq in made.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for p, convs in nodes.items():
        below = [q for q in nodes if q[: len(p)] == p]
        leaves = sum(not any(len(x) == len(q) + 1 and x[: len(q)] == q for x in below) for q in below)
        saved = sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q)
        ends = ",".join(str(c) for c in sorted(convs) if len(made[c]) == len(p))
        kids = sum(len(q) == len(p) + 1 for q in below)
        out.append((min(convs), len(p), min(nodes[p[:-1]]) if p else None, len(convs), kids, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(frame, bound=prefix_trie.BOUND):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.trie(frame, bound).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_rollup_against_walks(seed):
    rng = random.Random(seed)
    for n in (0, 1, 2, 7, 60, 300):
        parents = [-1 if k == 0 or rng.random() < 0.02 else (k - 1 if seed == 0 else rng.randrange(max(0, k - 9), k)) for k in range(n)]
        values = [(rng.randrange(9), rng.randrange(10**12)) for _ in range(n)]
        want = [list(v) for v in values]
        for k in reversed(range(n)):
            if parents[k] >= 0:
                want[parents[k]] = [a + b for a, b in zip(want[parents[k]], want[k], strict=True)]
        assert prefix_trie.rollup(parents, values) == want


def test_against_whole_prefixes(spark):
    rng = random.Random(5)
    some = ["", "a", "ä", "hello", "x" * 300, None]
    rows = []
    for c in [*range(0, 40), *range(200, 230), *range(301, 320), -5, -100, 10**12]:
        rows += [(c, rng.choice([None, 0, 1, 2, 3, 3]), rng.choice(["u", "v", None]), rng.choice(some[: rng.choice([2, 6])])) for _ in range(rng.choice([1, 1, 2, 6, 9]))]
    rows += [(150 + k, t, "u", f"copy {t}") for k in range(30) for t in range(5)]  # a group of copies
    rows += [(400, t, "u", str(t)) for t in range(150)] + [(401, t, "u", str(t)) for t in range(40)]  # a long chain and a branch of it
    rows += [(None, 1, "u", "lost"), rows[3], rows[3]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    want = plain(rows)
    for bound in (1, 5, 10**6):
        prefix = prefix_trie.math.isqrt
        prefix_trie.math.isqrt = lambda n: 0  # as small parts as the bound says
        try:
            assert got(frame, bound) == want
        finally:
            prefix_trie.math.isqrt = prefix


def test_empty_and_clashing_columns(spark):
    frame = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert got(frame) == []
    clash = spark.createDataFrame([(7, 0, "u", "a", 1, "n", 3)], "conv_id int, turn int, role string, text string, depth int, node string, pos int")
    assert got(clash) == plain([(7, 0, "u", "a")])


@pytest.mark.parametrize("d", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_query_equals_sql(spark, d):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{d}/conversations.parquet'")
    want = con.execute(queries.OP12_SQL).fetchall()
    assert len(want) > 10 and sorted(want, key=repr) == got(spark.read.parquet(f"{d}/conversations.parquet"))
