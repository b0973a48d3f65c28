import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken

from vantry.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "  ", "a", " a", "a  b", "a   b\n\n  c", "x\n ", "\t\tq \n z", "it's we'll I'd 'sx", "<|endoftext|> ok", "naïve 日本語 テスト 🎉🎉",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa" * 30, "a  b  c \u0085d", "same", "same", "\x1c\x1d \x1e", "0123456789 12 3.14!!! ??", "word " * 3000,
]


def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_librarys_and_decode_to_the_text(spark):
    rng = random.Random(5)
    texts = ODD + ["".join(rng.choice("ab  \n\t'sé漢1.,t") for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    lib = library()
    for packed in (False, True):
        ids = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, packed=packed)
        for row in bpe.decode(ids, RANKS).collect():
            want = lib.encode_ordinary(texts[row.doc_id] or "")
            if packed:
                assert bytes(row.ids) == b"".join(i.to_bytes(4, "little") for i in want)
            else:
                assert row.ids == want
            assert bytes(row.decoded) == (texts[row.doc_id] or "").encode()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).count() == 0


def test_query_against_the_library(spark):
    from vantry.llm.queries import op1_byte_bpe

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    lib, rows = library(), op1_byte_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_replay_order_where_a_merge_opens_a_lower_one():
    single = {bytes([b]): b for b in range(256)}
    ranks = single | {b"bc": 300, b"abc": 256, b"ab": 301, b"bcbc": 257, b"cb": 299}
    lib = tiktoken.Encoding("t", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(400)]
    ids, lens = bpe.MergeReplay(ranks).encode([w.encode() for w in words])
    assert [x.tolist() for x in np.split(ids, np.cumsum(lens))[:-1]] == [lib.encode_ordinary(w) for w in words]


def test_pieces_equal_the_librarys_and_are_encoded_once():
    """A word goes to the library once, whatever signs or line break stand after it; texts that are not plain words keep the library's ids."""
    from tokenizers import Tokenizer

    from vantry.llm import token_files

    definition = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    signs = ["", ".", ",", "...", "!", "'", "\nThe", ".\nThe"]
    code = token_files._coder(definition)
    code([f"The word{k}{s} and" for k in ("", "n", "rä") for s in signs])
    assert len(code.table.lens) <= 14
    rng = random.Random(6)
    alphabet = [*"abZ  \n\t\r'.,#_-1é×÷ſƀ漢\u0085\xa0 　—“\x00\x1c᠎ªµ😀", "'s", "'ll", " the", " The.", "\n\n", "don't"]
    texts = [t or "" for t in ODD if t is None or "<|" not in t] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(4000)]
    library = Tokenizer.from_str(definition)
    for part in (texts[:2000], texts[2000:], [], [""]):
        ids, ends = code(part)
        assert [x.tolist() for x in np.split(ids, ends[1:-1])][: len(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
