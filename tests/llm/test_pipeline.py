import hashlib
from collections import Counter

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages_keep_clean_documents_and_take_effect(spark):
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = raw
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == raw.columns, name
        docs = spark.createDataFrame(out.collect(), raw.schema)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert not any(item in text for item in items for text in texts.values())
    first = {}
    for r in raw.orderBy("doc_id").collect():
        first.setdefault(r.text, r.doc_id)
    assert set(texts) <= set(first.values())
    leaks = sum(any(item in r.text for item in items) for r in raw.collect())
    assert len(texts) > 0.8 * (len(first) - leaks)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id: r.decoded_sha256 for r in rows} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in texts.items()}
    assert all(r.n_tokens == len(r.ids) for r in rows)


def test_run_against_plain_code(spark, tmp_path):
    """run() on a small table with every odd case, against what plain Python says of each document."""
    import random

    rng = random.Random(3)
    base = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars between 500 and 3000 and text not like '%|%'").orderBy("doc_id").limit(40).collect()
    item = "A baker in Lyon sells 40 loaves an hour and closes after 6 hours so how many loaves are sold"
    rows = [(r.doc_id, r.text, f"site{k % 2}", r.lang, 0, "extra") for k, r in enumerate(base)]
    kept = {r[0] for r in rows}
    menu = "Home | News | Contact"
    rows = [(a, f"{menu}\n{b}", *rest) for a, b, *rest in rows]
    text = rows[0][1].split(" ")
    at = rng.randrange(len(text))
    rows += [
        (5001, None, "site0", None, 0, "x"), (5002, "", "site0", None, 0, "x"), (5003, "12 34 !!", "site1", None, 0, "x"), (5004, rows[0][1], "site1", "en", 0, "x"),
        (5005, " ".join([*text[:at], "changed", *text[at:]]), "site9", None, 0, "x"), (5006, rows[1][1] + " " + item.replace("40", "75").replace("Lyon", "Rome"), "site0", None, 0, "x"),
        (None, rows[3][1] + " tail of its own that differs", None, rows[3][3], 0, "x"), (5007, "\u65e5\u672c\u8a9e\u306e\u30c6\u30ad\u30b9\u30c8\u3067\u3059" * 30, "site0", None, 0, "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, score string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    pages = [(k, text, site) for k, text, site, *_ in rows if k not in (5001, 5002, 5003, 5007)]
    sites = Counter(site for *_, site in pages)
    lines = Counter((site, line) for _, text, site in pages for line in set(text.split("\n")) if line.strip())
    bad = {key for key, n in lines.items() if n >= 5 and n > 0.1 * sites[key[0]]}
    assert ("site0", menu) in bad
    for k, text, site in (page for page in pages if page[0] in kept):
        clean = "\n".join(line for line in text.split("\n") if (site, line) not in bad)
        assert got[k].decoded_sha256 == hashlib.sha256(clean.encode()).hexdigest() and got[k].n_tokens == len(got[k].ids)
    assert set(got) - kept == {None}
    lost = docs.limit(0).unionByName(spark.createDataFrame([(None, f"Look: {item}", "s", "en", 1, "x"), (None, "Look: nothing", "s", "en", 1, "x")], docs.schema))
    assert [r.text for r in corpus_pipeline.decontamination(spark, lost, str(tmp_path)).collect()] == ["Look: nothing"]
    empty = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0, name
