import random
from collections import Counter

import numpy as np

from vantry.llm import suffix_dedup as sd


def brute(docs, length):
    seen = Counter(t[i : i + length] for _, t in docs for i in range(len(t) - length + 1))
    out = []
    for key, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((key, len(t), sum(gone), runs, bytes(b for b, g in zip(t, gone, strict=True) if not g)))
    return sorted(out)


def check(spark, docs, length, gram):
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for limit in (0, 1 << 20):
        got = sd.keep_unrepeated(frame, length=length, gram=gram, broadcast_bytes=limit).collect()
        assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute([(k, (t or "").encode()) for k, t in docs], length)


def test_random_texts_against_all_windows(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(30) for _ in range(6)]
    docs = [None, "", "x", "a" * 500, "ab" * 300, "same " * 100, "same " * 100]
    for _ in range(80):
        docs.append(" ".join(rng.choice([text(rng.randrange(12)), rng.choice(passages)[rng.randrange(40) :]]) for _ in range(rng.randrange(5))))
    rows = list(zip(rng.sample(range(1000), len(docs)), docs, strict=True))
    check(spark, rows + [rows[-1], rows[3], (rows[-1][0], docs[20])], 40, 12)
    check(spark, rows, 64, 12)


def test_hot_grams_and_rows_without_key(spark, monkeypatch):
    rng = random.Random(9)
    text = lambda n: " ".join("".join(rng.choice("abcde") for _ in range(rng.randrange(1, 7))) for _ in range(n))
    short, near, long = text(6), text(9), text(40)
    docs = [(k, " ".join((text(8), rng.choice((short, near, long)), text(rng.randrange(9)), rng.choice((short, near, long)), text(8)))) for k in range(60)]
    docs += [(3, docs[3][1]), (4, docs[9][1]), (0, "again " * 30), (1, "again " * 31)]
    for hot in (1, 5, 10**9):
        monkeypatch.setattr(sd, "HOT", hot)
        check(spark, docs, 40, 12)
    monkeypatch.setattr(sd, "HOT", 20)
    common = "a passage that is just too short here."
    check(spark, [(k, f"{text(9)}{rng.choice((common, common[:25] + text(9)))}{text(2)}{rng.choice('xyz')}{common}{text(9)}") for k in range(90)], 40, 12)
    frame = spark.createDataFrame([(None, docs[0][1]), (0, docs[0][1]), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.n_bytes, r.n_removed) for r in sd.keep_unrepeated(frame).collect()))
    size = len(docs[0][1])
    assert got == [(False, size, size if size >= 200 else 0), (True, 0, 0), (True, size, size if size >= 200 else 0)]


def test_a_passage_shorter_than_a_window_does_not_meet_in_one_range():
    rng = random.Random(11)
    other = lambda n: bytes(rng.choice(b"abcdefgh") for _ in range(n))
    passage = other(190)
    owned = []
    for _ in range(2000):
        data = other(150) + passage + other(150)
        _, _, places, firsts, lasts = sd.anchors([data])
        owned += [(data[p : z + 200], data[a:p]) for p, a, z in zip(places.tolist(), firsts.tolist(), lasts.tolist(), strict=True) if 150 <= p <= 150 + 190 - 64]
    met = Counter(where for x in owned for *_, where in sd.hot_pieces(*x, 200, 64, None))
    assert met.most_common(1)[0][1] > 1000  # as pieces go by the bytes that their windows share
    filled = np.zeros(sd.PLACES >> 3, np.uint8)
    for where in (w for w, n in met.items() if n > 100):
        filled[where % sd.PLACES >> 3] |= 1 << (where & 7)
    sent = Counter()
    for right, left in owned:
        begin = len(left)
        for a, b, skipped, where in sd.hot_pieces(right, left, 200, 64, filled):
            assert left[skipped:] == b and right.startswith(a) and skipped + len(b) == begin
            sent[where] += 1
    assert sent.most_common(1)[0][1] <= 100


def test_windows_decided_by_common_prefixes_alone():
    rng = random.Random(10)
    for _ in range(60):
        texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(20, 60))) for _ in range(rng.randrange(1, 6))]
        found = sd.anchors(texts, 20, 6)
        runs, entries = [], {}
        for who, _, place, first, last in zip(*map(list, found), strict=True):
            entries.setdefault((texts[who][place : last + 20], texts[who][first:place]), []).append((who, first))
        rows = sorted(((right + left, len(right), who) for (right, left), who in entries.items()), key=lambda x: x[:2])
        for k in range(3):
            mine = rows[k::3]
            runs.append({"payload": b"".join(sd.front_coded([x for x, _, _ in mine])), "rights": [r for _, r, _ in mine], "counts": [len(w) for _, _, w in mine], "who": [w for _, _, w in mine]})
        got = set()
        for run, entry, edges in sd.merged_intervals(runs, 20, 6):
            for who, first in runs[run]["who"][entry]:
                got |= {(who, first + x) for a, b in zip(edges[::2], edges[1::2], strict=True) for x in range(a, b)}
        seen = Counter(t[i : i + 20] for t in texts for i in range(len(t) - 19))
        assert got == {(k, i) for k, t in enumerate(texts) for i in range(len(t) - 19) if seen[t[i : i + 20]] > 1}


def test_test_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(spark, docs, sd.LENGTH, sd.GRAM)
    assert sd.keep_unrepeated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_segments_of_a_long_text(monkeypatch):
    rng = random.Random(7)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (3000, 10, 900, 41)]
    whole = sd.anchors(texts, 40, 12)
    monkeypatch.setattr(sd, "SEGMENT", 100)
    cut = sd.anchors(texts, 40, 12)
    where = lambda found: {(w, s): (h, p) for w, h, p, a, b in zip(*map(list, found), strict=True) for s in range(a, b + 1)}
    assert where(whole) == where(cut) and len(where(cut)) == sum(max(0, len(t) - 39) for t in texts)


def test_merge_of_runs():
    rng = random.Random(8)
    for n in (1, 2, 3, 7):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(20))}) for _ in range(n)]
        out = list(sd.LoserTree([sd.Run(b"".join(sd.front_coded(r))) for r in runs]))
        assert [s for _, _, s, _ in out] == sorted(s for r in runs for s in r)
        before = b""
        for run, entry, string, same in out:
            assert runs[run][entry] == string and same == sd.shared_prefix(before, string, 0)
            before = string
