import random
import re
import zlib

import numpy as np
import public_tokenizers

from vantry.llm import decontam, langid, line_dedup, queries, secrets, sharding, token_files

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_pack_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 59, 60, 61, 1000):
        for top in (1, 2, 7, 300, 50_257, 2**31, 2**60, 2**63):
            ids = rng.integers(0, top, n, dtype=np.uint64)
            if n > 5:
                ids[3] = 2**64 - 1
            assert (token_files.unpack(*token_files.pack(ids)) == ids).all()


def test_token_files_against_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(2)
    end = "<|endoftext|>"
    texts = [None, "", " ", "a  b", end, f"x {end} y", f"x  {end}  y", f"{end}{end} ", f" {end}a\n{end}", f"a<|endof{end}", f"<|END|>{end[:-1]}", f"it{end}'s", "x" * 50_000] + ["".join(rng.choice("ab \n'sé漢1.") for _ in range(rng.randrange(80))) for _ in range(200)]
    keys = rng.sample(range(10_000), len(texts))
    docs = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string").repartition(3)
    path = str(tmp_path / "tokens")
    token_files.write(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    got = {r.key: r for r in token_files.read(spark, path).collect()}
    at = 0
    for key, text in sorted(zip(keys, texts, strict=True)):
        want = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        assert (got[key].start, got[key].n_tokens, bytes(got[key].ids)) == (at, len(want), want.tobytes())
        at += len(want)
    odd = docs.limit(0).unionByName(spark.createDataFrame([(5, "b"), (5, "a"), (None, "n"), (None, None), (-7, "m")], docs.schema))
    token_files.write(odd, path + "1", public_tokenizers.path("byte_bpe_50k.json"))
    starts = sorted((r.start, r.key, r.n_tokens) for r in token_files.read(spark, path + "1").collect())
    assert [(k, n) for _, k, n in starts] == [(None, 1), (None, 2), (-7, 2), (5, 2), (5, 2)] and [a for a, *_ in starts] == [0, 1, 3, 5, 7]
    token_files.write(docs.limit(0), path + "0", public_tokenizers.path("byte_bpe_50k.json"))
    assert token_files.read(spark, path + "0").count() == 0


def test_query_of_token_files_against_the_library(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op4_simple8b_files(spark, SF).collect()}
    at, want = 0, {}
    for key in sorted(docs):
        ids = np.array([*library.encode(docs[key], add_special_tokens=False).ids, 0], "<u4")
        want[key] = (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    assert got == want


def test_shards_are_exact_gapless_and_uniform(spark):
    rows = spark.range(0, 1003).selectExpr("id % 500 as doc_id", "cast(null as string) as shard", "'x' as size").repartition(5)
    out = sharding.assign(rows, 8).toPandas()
    assert sorted(out.groupby("shard").size()) == [125] * 5 + [126] * 3
    for _, part in out.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert sharding.assign(rows.limit(0), 8).count() == 0
    hits = [0] * 4
    for seed in range(2000):
        m = sharding.matrix([3, 1], [1, 1, 1, 1], seed)
        assert [sum(r) for r in m] == [3, 1] and [sum(c) for c in zip(*m, strict=True)] == [1, 1, 1, 1]
        hits[m[1].index(1)] += 1
    assert min(hits) > 400
    rng = np.random.default_rng(1)
    big = [sharding.hypergeometric(10**9, 10**9, 10**6, rng) for _ in range(300)]
    assert abs(np.mean(big) - 5e5) < 200 and 300 < np.std(big) < 700


def test_line_dedup_by_hand(spark):
    pages = [(i, "a", f"own {i}\nmenu\n\nmenu") for i in range(10)] + [(100 + i, None, "menu\nfoot") for i in range(6)] + [(200, "b", "menu"), (201, "b", None), (202, "b", "")]
    docs = spark.createDataFrame([(*p, "clash") for p in pages], "doc_id long, source string, text string, n_pages string")
    for limit in (0, 10_000):
        got = {r.doc_id: r for r in line_dedup.clean(docs, counts=True, broadcast_bytes=limit).collect()}
        assert got[3].text == "own 3\n" and (got[3].n_lines, got[3].n_dropped) == (4, 2)
        assert got[101].text == "" and got[200].text == "menu" and got[201].text is None and got[202].text == ""
        assert got[201].n_lines == 0 and got[3].n_pages == "clash"
    assert line_dedup.clean(docs.limit(0)).count() == 0


def brute_spans(text):
    kinds = (
        ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 6),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
    )
    found = [(m.start(), k, f"{name}:{m.start()}:{m.end()}") for k, (name, p, ok) in enumerate(kinds) for m in p.finditer(text) if ok(m)]
    return ",".join(x for _, _, x in sorted(found))


def test_secret_spans_and_costs(spark):
    rng = random.Random(8)
    parts = ["password", "PassWD", "api_key", "apikey=", "token: ", "='", " ", "AKIA", "ABCDEFGHIJKLMNOP", "0123456789abcdef01234567", "é漢", "xYz-1", "secret = \"hunter22\"", "pwd: k8Qz!rT2#pLw9x"]
    texts = [None, "", "x" * 100_000] + ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan(docs, RANKS).collect():
        assert r.base == brute_spans(texts[r.doc_id] or "")
        assert set(filter(None, r.base.split(","))) <= set(r.spans.split(","))
    assert secrets.scan(docs.limit(0), RANKS).count() == 0
    words = secrets.dictionary(RANKS)
    cost = lambda v: secrets.guess_bits(v, words)
    assert cost("password") < 15 and cost("aaaaaaaaaa") < 10 and cost("qwertyuiop") < 18 and cost("2021-03-04") < 17
    assert cost("k8Qz!rT2#pLw9x") > 45 > cost("password2021")
    (row,) = secrets.scan(spark.createDataFrame([(1, "my pwd: k8Qz!rT2#pLw9x ok")], "doc_id long, text string"), RANKS).collect()
    assert row.spans == "guess:8:22"


def test_guess_spans_are_whole_and_need_no_digit(spark):
    rng = random.Random(15)
    token = "".join(rng.choice("abcdefghijkmnopqrstuvwxyzABCDEFGHJKLMNPQRSTUVWXYZ23456789-_") for _ in range(603))
    odd = "xKqZvWjTgRbYpLmD"
    holder = "Zk!" + "0123456789abcdef01234567" + "!qWv#Tz"
    texts = [f"Bearer {token} end", f"passphrase: {odd} end", f"credential: {holder} end", "bearer 0123456789abcdef0123456789 end", "passphrase: password end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in secrets.scan(docs, RANKS).collect()}
    assert got[0].spans == "guess:7:610" and got[1].spans == f"guess:12:{12 + len(odd)}"
    assert got[2].spans == f"guess:12:{12 + len(holder)},hex:15:39"
    assert (got[3].spans, got[3].n_guess) == (got[3].base, 0) and got[4].spans == ""


def test_decontamination_catches_new_parameters(spark):
    item = "A train leaves Boston at 40 km per hour and meets another train from Denver after 3 hours of travel on one track"
    texts = [
        item, "Noise before. " + item.lower() + " and noise", item.replace("40", "75").replace("Boston", "Lima").replace(" 3 ", " 9 "),
        "Clean text about nothing in particular that goes on for some words more than ten", None, "", item[:60], item, "word " * 5000,
    ]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, item string")
    items = spark.createDataFrame([(7, item), (8, "too short"), (9, None), (10, item)], "item_id long, text string")
    for limit in (0, 1 << 20):
        got = {r.doc_id: r for r in decontam.contaminated(docs, items, broadcast_bytes=limit).collect()}
        assert set(got) == {0, 1, 2, 7}
        assert got[0].item_id == 7 and got[0].n_items == 2 and got[0].share == 1.0
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    fits = lambda slots, a, b: slots.take(bytes([1, 0, 1]), np.array(a).tobytes(), np.array(b).tobytes())
    slots = decontam.Slots()
    assert fits(slots, [5, 1, 5], [6, 1, 6]) and not fits(slots, [5, 1, 7], [7, 1, 8]) and fits(slots, [7, 1, 8], [7, 1, 8])
    assert not fits(decontam.Slots(), [5, 1, 5], [6, 1, 7]) and not fits(decontam.Slots(), [5, 1, 4], [6, 1, 6])


def test_an_unseen_word_is_hashed_once(monkeypatch):
    """Its template and its case-free form are the word itself or one of three placeholders, whose hashes are known."""
    plain, hashed = decontam._hash, []
    monkeypatch.setattr(decontam, "_hash", lambda word: hashed.append(word) or plain(word))
    words = decontam.Words()
    text = "Anna has 3 cows, 12kg 1ST x² % ... 5 KG of Hay. cows, Anna ١٢ ß"
    views, value, *_ = decontam.templates([text], words)
    bare = [w.strip(decontam.STRIP) for w in text.split()]
    assert len(hashed) == len(words) == len(set(text.split()))
    assert value.tolist() == [plain(w.casefold()) for w in bare]
    for k, w in enumerate(bare):
        low = w.casefold()
        want = ("<number>", 1) if decontam.NUMBER.match(low) else ("<unit>", 2) if low in decontam.UNITS else (low, 0)
        assert (views[1][0][k], views[1][1][k]) == (plain(want[0]), want[1])


def test_slots_hold_over_the_whole_item(spark):
    item = "The farm by the river sold 40 baskets of ripe plums on the first market day and then it sold 40 more of them to a baker from town"
    copy = lambda a, b: item.replace("40 b", f"{a} b").replace("40 m", f"{b} m")
    texts = [copy(75, 75), copy(75, 99), copy(40, 99), copy(75, 75) + " and " + copy(99, 99), copy(75, 99) + " " + copy(31, 31), item.replace("river", "Po")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    for limit in (0, 1 << 20):
        got = {r.doc_id: r.share for r in decontam.contaminated(docs, items, broadcast_bytes=limit).collect()}
        want = {k: plain_share(t, item) for k, t in enumerate(texts)}
        assert got == {k: x for k, x in want.items() if x >= decontam.COVER}
        assert got[0] == got[3] == got[4] == 1.0 and got[1] == got[2] == 11 / 20  # of 20 windows 9 hold the second value


def plain_share(doc, item):
    """The rule of decontamination word by word: largest share of an item's windows in a document."""

    def seen(text, view):
        out, opens = [], True
        for word in text.split():
            bare = word.strip(decontam.STRIP)
            low = bare.casefold()
            number, name = decontam.NUMBER.match(bare if view == 0 else low), bare[:1].isupper() and (len(bare) == 1 or not bare.isupper())
            kind = 1 if bare and number else 2 if low in decontam.UNITS else 3 if view == 0 and name and not opens else 0
            out.append((kind if view < 2 else 0, low if view == 2 or not kind else "", low))
            opens = word[-1:] in ".!?:|"
        return out

    words = item.split()
    size = min(10, len(words))
    usable, hit, met = [set(), set(), set()], [set(), set(), set()], []
    for view in range(3):
        ours, theirs = seen(item, view), seen(doc, view)
        for at in range(len(ours) - size + 1):
            a = ours[at : at + size]
            if view < 2 and (len(words) < 4 or sum(x[0] == 0 for x in a) < min(3, size)):
                continue
            usable[view].add(at)
            for k in range(len(theirs) - size + 1):
                b = theirs[k : k + size]
                ends = doc.split()[k + size - 1][-1] in ".!?:|" or k + size == len(theirs)
                begins = k == 0 or doc.split()[k - 1][-1] in ".!?:|"
                if [x[:2] for x in a] == [x[:2] for x in b] and (size >= 4 or (begins and ends)):
                    met.append((k - at, k, view, at, {((x[0], x[2]), (y[0], y[2])) for x, y in zip(a, b, strict=True) if x[0]}))
    if not (usable[0] or usable[1]):
        return len({m[3] for m in met}) / len(usable[2])
    met = [m for m in met if m[2] < 2]

    def kept(rows):
        taken = set()
        for row in rows:
            both = taken | row[4]
            if len({x for x, _ in both}) == len(both) == len({y for _, y in both}):
                taken = both
                yield row

    copies = [list(kept(sorted((m for m in met if m[0] == d), key=lambda m: m[:3]))) for d in {m[0] for m in met}]
    copies = sorted(filter(None, copies), key=lambda rows: (-len({m[1] for m in rows}), rows[0][0]))
    for m in kept([m for rows in copies for m in rows]):
        hit[m[2]].add(m[3])
    return max(len(hit[0]) / len(usable[0]) if usable[0] else 0, len(hit[0] | hit[1]) / len(usable[0] | usable[1]))


def test_decontamination_against_the_plain_rule(spark):
    rng = random.Random(16)
    items = [
        "Take 7 apples and 7 pears to Anna before noon", "Which river runs by Paris?", "Forty-two.", "3 km 5 km 7 km",
        "The answer is 12 kg for Rosa Mann and 15 kg for Rosa Mann but 12 kg for nobody else in town", "12 13 14 15 16 17 18 19 20 21 22 23",
    ]
    texts = [
        "Take 5 apples and 6 pears to Anna before noon",  # slots contradict each other
        "Take 5 apples and 5 pears to Rosa before noon", "so: Which river runs by Rome? None.", "Yes. Forty-two. No.", "The forty-two. of",
        "it is 3 km 5 km 7 km long", "it is 4 km 5 km 7 km long", "12 13 14 15 16 17 18 19 20 21 22 23", "12 13 14 15 16 17 18 19 20 21 22 24", "12 13 14 15 16 99 18 19 20 21 22 24",
    ]
    for _ in range(120):
        words = rng.choice(items).split()
        for _ in range(rng.randrange(5)):
            k = rng.randrange(len(words))
            words[k] = rng.choice([words[k].upper(), words[k].lower(), words[k].title(), str(rng.randrange(20)), "Rosa", "word", words[k] + "."])
        texts.append(" ".join(["Before", "that.", *words, "and", "after"][rng.randrange(3) : 20]))
    docs = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string").repartition(3)
    frame = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {}
    for k, text in enumerate(texts):
        shares = {i: plain_share(text, item) for i, item in enumerate(items)}
        if over := {i: x for i, x in shares.items() if x >= decontam.COVER}:
            want[k] = (len(over), min(i for i in over if over[i] == max(over.values())), round(max(over.values()), 9))
    got = {r.doc_id: (r.n_items, r.item_id, round(r.share, 9)) for r in decontam.contaminated(docs, frame).collect()}
    assert got == want and 0 not in got and {1, 2, 3, 5, 7} <= set(got) and not {4, 6, 9} & set(got)


def test_decontamination_catches_copies_in_any_letter_case(spark):
    item = "On Monday Anna Keller from Boston met Peter Novak of Denver near the Große Straße in Vienna and gave Maria Lopez the 1st of 40 letters for Tom Baker in Lima"
    twist = item.replace("Anna Keller", "Rosa Mann").replace("Vienna", "Oslo").replace("40", "75")
    wrong = " ".join(reversed(item.lower().split()))
    texts = [item, item.lower(), item.upper(), item.title(), "Some words. " + item.title().swapcase() + " more", twist, wrong]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    for limit in (0, 1 << 20):
        got = {r.doc_id: r.share for r in decontam.contaminated(docs, items, broadcast_bytes=limit).collect()}
        assert set(got) == {0, 1, 2, 3, 4, 5} and all(got[k] == 1.0 for k in range(5))


def cheapest(value, words):
    """guess_bits by trying every segmentation."""
    from functools import cache
    from math import log2

    low = value.lower()

    def part(a, b):
        piece, n = low[a:b], b - a
        brute = secrets._brute_bits(value[b - 1])
        yield brute if n == 1 else float("inf")
        if piece in words and n >= 3:
            upper = sum(c.isupper() for c in value[a:b])
            yield log2(words[piece] + 2) + (0 if not upper else 1 if upper == n or (upper == 1 and value[a].isupper()) else 1 + upper)
        if (m := secrets.DATE.match(value, a)) and m.end() == b:
            yield log2(365 * 120 if n > 4 else 120)
        if n >= 3 and len(set(piece)) == 1:
            yield brute + log2(n)
        if n >= 3 and all(y in secrets._NEXT.get(x, ()) for x, y in zip(piece, piece[1:], strict=False)):
            yield log2(94) + n - 1
        if n in (2, 3, 4) and a >= n and low[a - n : a] == piece:
            yield 2.0

    @cache
    def best(b):
        return min((best(a) + cost for a in range(b) for cost in part(a, b)), default=float("inf")) if b else 0.0

    return best(len(value))


def test_guess_cost_equals_exhaustive_segmentation():
    rng = random.Random(17)
    words = {"pass": 3, "word": 9, "password": 1, "dragon": 40, "abc": 2}
    parts = ["pass", "Word", "DRAGON", "aaa", "qwe", "2021", "2021-03-04", "x", "Q", "!", "7", "abab", "é", "zzzz", "123"]
    for _ in range(300):
        value = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 6)))
        assert abs(secrets.guess_bits(value, words) - cheapest(value, words)) < 1e-9, value
    assert secrets.guess_bits("a" * 5000, words) < 900 and secrets.guess_bits("", words) == 0


def test_assign_values_get_a_guess_span_by_their_cost(spark):
    docs = spark.createDataFrame([(1, "password=changeme"), (2, "x token: k8QzErT2kpLw9xVb"), (None, None)], "doc_id long, text string")
    got = {r.doc_id: (r.spans, r.n_guess) for r in secrets.scan(docs, RANKS).collect()}
    assert got == {1: ("assign:0:17", 0), 2: ("assign:2:25,guess:9:25", 1), None: ("", 0)}


def test_names_of_input_columns_never_clash(spark):
    docs = spark.createDataFrame([(1, "a", "x y", 5, 6, 7, 8)], "doc_id long, source string, text string, _bad int, _site int, score int, lang_pred int")
    assert line_dedup.clean(docs).columns == docs.columns and line_dedup.clean(docs).first() == docs.first()
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    assert langid.predict(docs, model, keep=True).select("row.*").first() == docs.first()
    named = docs.selectExpr("doc_id", "1 as _bin", "2 as _place", "3 as _start", "4 as _cuts", "5 as _row", "6 as _group")
    assert sharding.assign(named, 2).drop("shard", "slot").first() == named.first()


def test_language_on_held_out_rows(spark):
    from vantry.llm.queries import op3_language_id

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").toPandas()
    got = op3_language_id(spark, SF).toPandas().merge(docs, on="doc_id")
    held = np.array([zlib.crc32(str(d).encode()) % 4 == 2 for d in got.doc_id])
    assert (got.held_out == held).all() and ((got.lang_pred == got.lang)[held]).mean() > 0.95 and got.score.between(0, 1).all()
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "der und die " * 20_000), (4, "x")], "doc_id long, text string")
    model = langid.train(spark.read.parquet(f"{SF}/documents.parquet"))
    pred = [(r.doc_id, r.lang_pred) for r in langid.predict(odd, model).orderBy("doc_id").collect()]
    assert pred[:3] == [(1, "und"), (2, "und"), (3, "und")] and (4, "de") in pred and len(pred) == 5
    none = langid.train(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_kernel_is_the_share_of_common_grams():
    a, b = langid.presence(["abcab", "bcabx"])[0]
    want = 0
    for n in range(1, langid.ORDERS + 1):
        x, y = ({t[i : i + n] for i in range(len(t) - n + 1)} for t in ("abcab", "bcabx"))
        want += len(x & y) / np.sqrt(len(x) * len(y)) / langid.ORDERS
    assert abs(float(a @ b) - want) < 1e-5


def test_rows_without_or_with_shared_keys_are_judged_each(spark):
    item = "A train leaves Paris at 9 and travels 120 km in 2 hours before it stops for lunch near Lyon"
    items = spark.createDataFrame([(4, item), (5, None)], "item_id long, text string")
    rows = [(None, f"So: {item}. Yes."), (None, "Nothing to see here, just some plain words that belong to nobody."), (7, item), (7, "clean words of a row that shares its key with a copy"), (8, None), (None, None), (7, item)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, judged string, share int")
    for limit in (0, 1 << 20):
        got = decontam.judged(docs, items, broadcast_bytes=limit).collect()
        assert sorted((str(r.row.doc_id), str(r.row.text)[:3], r.contaminated, r.item_id, r.n_items) for r in got) == sorted(
            (str(k), str(t)[:3], bool(t) and item in t, 4 if t and item in t else None, int(bool(t) and item in t)) for k, t in rows
        )
        assert {r.row.judged for r in got} == {"x"}
    assert decontam.judged(docs.limit(0), items).count() == 0
