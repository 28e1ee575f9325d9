"""Byte-level BPE and token counts against the libraries they must equal."""

import hashlib
import random
import struct

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer as Library

from newsgraph.llm import bpe, queries, token_counts

from .conftest import TEXTS, messy_rows

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
READY = bpe.model_and_spec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
    DEFINITION = file.read()
TOKENIZER = token_counts.Tokenizer(DEFINITION, public_tokenizers.PATTERN)


def strange_texts(count, seed):
    rnd = random.Random(seed)
    pick = lambda: rnd.choice([rnd.randrange(0x20, 0x7F), rnd.randrange(1, 0x3000), rnd.randrange(0xE000, 0x110000), 32, 10, 39])
    return ["".join(chr(pick()) for _ in range(120)) for _ in range(count)] + [f"a{chr(c)} 1{chr(c)}!" for c in range(0x80, 0xD800, 41)]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_encoder_equals_library():
    encoder, decoder = bpe._Encoder(*READY), bpe._Decoder(READY[0])
    for text in [t or "" for t in TEXTS] + strange_texts(300, 1):
        ids = encoder.ids(text)
        assert ids == packed(TIKTOKEN.encode_ordinary(text))
        assert decoder.text(ids) == text.encode()


def test_cache_limits_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ROWS", 5)
    monkeypatch.setattr(bpe, "CACHED_CHARS", 3)
    monkeypatch.setattr("newsgraph.llm.pretokens.LIST_ROWS", 4)
    encoder = bpe._Encoder(*READY)
    for text in strange_texts(20, 2) + ["to be or not to be " * 9]:
        assert encoder.ids(text) == packed(TIKTOKEN.encode_ordinary(text))


def test_every_piece_is_itself():
    encoder = bpe._Encoder(*READY)
    for data, rank in list(RANKS.items())[::97]:
        try:
            text = data.decode()
        except UnicodeDecodeError:
            continue
        if TIKTOKEN.encode_ordinary(text) == [rank]:
            assert encoder.ids(text) == packed([rank])


def test_bpe_query(spark, messy, empty, rows):
    expected = []
    for row in messy_rows():
        ids = TIKTOKEN.encode_ordinary(row[1] or "")
        expected.append((row[0], len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()))
    assert rows(bpe.digests(messy, *READY)) == sorted(expected, key=repr)
    assert bpe.digests(empty, *READY).count() == 0
    assert bpe.decode(bpe.encode(messy.drop("ids"), *READY), READY[0]).columns == [c for c in messy.columns if c != "ids"] + ["ids", "decoded"]


def test_counts_equal_library():
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    lengths = token_counts._Lengths({}, DEFINITION)
    texts = [t or "" for t in TEXTS] + strange_texts(300, 3) + ["a<|endoftext|> b<|endoftext|><|endoftext|", "<|endoftext|>"]
    for text in texts:
        assert lengths.count(text, TOKENIZER.special, TOKENIZER.spec) == len(library.encode(text, add_special_tokens=False).ids)


def test_counts_query(spark, messy, empty, rows):
    library = Library.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = []
    for row in messy_rows():
        n = len(library.encode(row[1] or "", add_special_tokens=False).ids)
        expected.append((row[0], len((row[1] or "").encode()), n, n > 512))
    expected.sort(key=repr)
    assert rows(token_counts.budget(messy, TOKENIZER, 512)) == expected
    few = token_counts.count_tokens(messy.select("doc_id", "text"), TOKENIZER, frequent=[])
    assert rows(few, "doc_id", "n_tokens") == sorted([(e[0], e[2]) for e in expected], key=repr)
    assert token_counts.budget(empty, TOKENIZER, 512).count() == 0


def test_queries_read_all_documents(spark, rows):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in queries.op2_byte_bpe(spark, sf).collect():
        assert row.ids_sha256 == hashlib.sha256(packed(TIKTOKEN.encode_ordinary(texts[row.doc_id]))).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
