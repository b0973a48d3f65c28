import hashlib

import regex
import xxhash
from pyspark.sql import functions as F

from vantry.llm import order_minhash as omh
from vantry.llm.components import components
from vantry.llm.queries import op6_order_minhash

SF = "/root/testdata/sf0.001"


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def xx(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


ALONE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Hangul}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]")


def words_of(text):
    """The rule step by step."""
    out = []
    for run in regex.split(r"[ \t\n\x0b\f\r]+|(" + ALONE.pattern + ")", text):
        if not run or ALONE.fullmatch(run):
            out += [run] if run else []
            continue
        while len(run) > 12:
            cut = next((k for k in range(2, 13) if run[k] in "aeiouAEIOU01234"), 12)
            out.append(run[:cut])
            run = run[cut:]
        out += [run] if run else []
    return out


def brute(text):
    words = [xx(w) for w in words_of(text)]
    if not words:
        return []
    n = len(words) - omh.K + 1
    kmers = [(xx(*words[i : i + omh.K]) >> 24, i) for i in range(n)] if n > 0 else [(xx(*words) >> 24, 0)]
    seen, items = {}, []
    for h, i in kmers:
        o = seen[h] = seen.get(h, -1) + 1
        # the occurrence number is a 32-bit integer
        h2 = h if not o else xxhash.xxh64_intdigest(o.to_bytes(4, "little"), xx(h)) >> 24
        items.append((signed(h2 << 24 | i), h2, i))
    out, by = [], {}
    for code, h, i in sorted(items):
        by.setdefault(code >> 59, []).append((i, h))
    for b in sorted(by):
        two = sorted(by[b][:2])
        out.append((b % 32 << 27) + (xx(*(h for _, h in two)) >> 37))
    return out


def test_query_against_brute_force(spark):
    docs = sorted((r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {r.doc_id: r for r in op6_order_minhash(spark, SF).collect()}
    assert len(got) == len(docs)
    like = lambda a, b: 1.0 if not a and not b else len(set(a) & set(b)) / len({x >> 27 for x in a + b})
    mean = [0.0, 0.0]
    for k, (key, text) in enumerate(docs):
        after = docs[(k + 1) % len(docs)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r, mine, theirs = got[key], brute(text), brute(edited)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{x:08x}" for x in mine) and r.edited_fingerprint == "".join(f"{x:08x}" for x in theirs)
        assert abs(r.near_edited - like(mine, theirs)) < 1e-9 and abs(r.near_next - like(mine, brute(after))) < 1e-9
        mean = [mean[0] + r.near_edited / len(docs), mean[1] + r.near_next / len(docs)]
    assert mean[0] > 0.1 and mean[0] > 3 * mean[1]


def test_odd_rows(spark):
    rows = [(5, None), (1, ""), (1, "same key b"), (1, "same key a"), (9, "é漢" * 20_000), (9, "a a a a a a a"), (7, "one")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, signature string")
    got = omh.edited_pairs(docs).collect()
    assert len(got) == len(rows)
    assert {r.tail for r in got if r.doc_id == 7} == {"a"} and {r.tail for r in got if r.doc_id == 5} == {""}
    assert omh.edited_pairs(docs.limit(0)).count() == 0
    one = omh.edited_pairs(docs.where("doc_id = 7")).collect()
    assert [r.tail for r in one] == ["o"]
    s = docs.select(omh.signature(F.col("text")).alias("s"), omh.likeness(omh.signature(F.col("text")), omh.signature(F.col("text"))).alias("l")).collect()
    assert {r.l for r in s} == {1.0}


def test_components(spark):
    import random

    rng = random.Random(4)
    for n, m in ((1, 0), (50, 40), (200, 150), (60, 400)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(k, k + 1) for k in range(1000, 1040)]
        parent = {}

        def find(x, parent=parent):
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        for a, b in edges:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
        got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_texts_without_blanks_keep_their_likeness(spark):
    import random

    rng = random.Random(0)
    scripts = {"han": [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)], "latin": [rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(3000)], "thai": [chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(3000)]}
    rows = []
    for name, chars in scripts.items():
        text = "".join(chars)
        rows.append((name, text, "x" + text if name == "latin" else chars[7] + text, text[:1500] + chars[3] + text[1500:], text[1500:] + text[:1500]))
    frame = spark.createDataFrame(rows, "name string, text string, front string, middle string, moved string")
    sign = lambda c: omh.signature(F.col(c))
    got = frame.select("name", *(omh.likeness(sign("text"), sign(c)).alias(c) for c in ("front", "middle", "moved"))).collect()
    assert all(r.front > 0.8 and r.middle > 0.8 and r.moved < 0.75 for r in got), got
    assert all(words_of(t) == regex.findall(omh.WORD.replace("Is", ""), t) for _, *texts in rows for t in texts)
