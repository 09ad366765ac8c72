"""Both tokenizers against their own libraries."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagloom.llm import bpe, queries, token_counts
from tagloom.llm.common import text_runs, word_runs

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
FOLDER = "/root/testdata/sf0.001"

random.seed(3)
ODD = [
    "", " ", "a", "İSTANBUL ΣΑΣ σας", "<|endoftext|> x<|startoftext|>y < |endoftext|>", "a\x1cb\x1d \x85c d　e",
    " \n\n  x\n", "aaaa" * 50, "é é́", "漢字かな混じり文 한국어", "🙂👩‍👧 12345 ½ Ⅷ", "don't WE'LL 'S'", "x" * 3000,
    "ab" * 500 + " " * 100 + "\t\n" * 20 + "z", "zq" * 200_000, "word " * 150_000 + "\n\n" * 1000 + "end",
    *["".join(random.choice("ab cdE1.,!\n\t é漢'’‍🙂Σς<|>́") for _ in range(300)) for _ in range(200)],
]


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def table(spark, texts):
    rows = [(n, text, "clash", [1], b"x") for n, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, _text string, token_ids array<int>, decoded binary")


def test_perfect_hash_is_minimal_and_perfect():
    for n in (1, 2, 3, 10, 5000):
        keys = [f"key {at}".encode() for at in range(n)]
        perfect = bpe.PerfectHash(keys)
        assert sorted(perfect.key_at.tolist()) == list(range(n))
        assert perfect.candidates(keys).tolist() == list(range(n))
        assert set(perfect.candidates([b"other", b""]).tolist()) <= set(range(n))


def test_byte_ids_and_decoding(spark, encoding):
    found = {row.doc_id: row for row in bpe.encode(table(spark, [*ODD, None]), RANKS, public_tokenizers.PATTERN).collect()}
    for n, text in enumerate([*ODD, ""]):
        assert found[n].token_ids == encoding.encode_ordinary(text)
        assert bytes(found[n].decoded) == text.encode()


def test_byte_query(spark, encoding):
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = queries.op8_byte_bpe(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = encoding.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_forgetting_changes_nothing(monkeypatch, encoding):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    codec = bpe.Codec(bpe.Codec.shared(RANKS, public_tokenizers.PATTERN))
    counter = token_counts.Counter(token_counts.WordMerges(WORDS))
    whole = Tokenizer.from_file(WORDS)
    for text in ODD[:14]:
        assert codec.encode(text).tolist() == encoding.encode_ordinary(text)
        assert counter.count([text]) == [len(whole.encode(text, add_special_tokens=False).ids)]


WHITE = [c for c in map(chr, range(0x10000)) if c.isspace() or ord(c) < 32 or 0x7F <= ord(c) <= 0xA0]


@pytest.mark.parametrize("size", [1, 2, 3, 7])
def test_pieces_cut_at_any_white_space_or_control_character(monkeypatch, encoding, size):
    monkeypatch.setattr(bpe, "RUN_CHARS", size)
    monkeypatch.setattr(token_counts, "RUN_CHARS", size)
    codec = bpe.Codec(bpe.Codec.shared(RANKS, public_tokenizers.PATTERN))
    counter = token_counts.Counter(token_counts.WordMerges(WORDS))
    whole = Tokenizer.from_file(WORDS)
    for c in WHITE:
        for text in (f"!!!!!!{c}!!!!!x{c}{c}x-{c} -", f"it{c}'s <|endoftext|>{c} 12{c}3", f"{c} {c}--{c}--\n{c}"):
            assert counter.count([text]) == [len(whole.encode(text, add_special_tokens=False).ids)], hex(ord(c))
            assert codec.encode(text).tolist() == encoding.encode_ordinary(text), hex(ord(c))


def test_characters_newer_than_the_tables(encoding):
    counter = token_counts.Counter(token_counts.WordMerges(WORDS))
    codec = bpe.Codec(bpe.Codec.shared(RANKS, public_tokenizers.PATTERN))
    whole = Tokenizer.from_file(WORDS)
    texts = []
    for at in [*range(0x500, 0x3000), *range(0xA000, 0xAC00), *range(0x10000, 0x1F000, 3), *range(0x2B700, 0x40000, 41)]:
        c = chr(at)
        texts.append(f"ab{c}cd {c}{c}1!{c}é?{c.upper()}Z")
    assert counter.count(texts) == [len(found.ids) for found in whole.encode_batch(texts, add_special_tokens=False)]
    for text, ids in zip(texts, encoding.encode_ordinary_batch(texts)):
        assert codec.encode(text).tolist() == ids


def test_heap_takes_the_leftmost_of_equal_ranks():
    ranks = {bytes([n]): n for n in range(256)} | {b"aa": 300, b"aaa": 301, b"ba": 299}
    assert bpe.merged(b"aaaaa", ranks) == [300, 301]
    assert bpe.merged(b"baa", ranks) == [299, ord("a")]


def test_incomplete_vocabulary_is_refused(tmp_path):
    (tmp_path / "few").write_bytes(base64.b64encode(b"a") + b" 0\n")
    with pytest.raises(ValueError, match="lacks single bytes"):
        bpe.Codec.shared(str(tmp_path / "few"), ".")


def test_word_counts(spark):
    whole = Tokenizer.from_file(WORDS)
    found = {row.doc_id: row for row in token_counts.token_counts(table(spark, [*ODD, None]), WORDS).collect()}
    for n, text in enumerate([*ODD, ""]):
        assert found[n].n_tokens == len(whole.encode(text, add_special_tokens=False).ids), text[:40]
        assert found[n].n_bytes == len(text.encode())


def test_word_query(spark):
    whole = Tokenizer.from_file(WORDS)
    texts = {row.doc_id: row.text or "" for row in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    for row in queries.op6_token_counts(spark, FOLDER).collect():
        n = len(whole.encode(texts[row.doc_id], add_special_tokens=False).ids)
        assert (row.n_tokens, row.over_limit) == (n, n > 2048)


def test_no_rows_and_repeated_rows(spark):
    assert bpe.encode(table(spark, []), RANKS, public_tokenizers.PATTERN).collect() == []
    assert token_counts.token_counts(table(spark, []), WORDS).collect() == []
    twice = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "doc_id long, text string")
    assert sorted(row.n_tokens for row in token_counts.token_counts(twice, WORDS).collect()) == [2, 2, 2]
    assert bpe.digests(bpe.encode(twice, RANKS, public_tokenizers.PATTERN)).agg(F.sum("n_tokens")).first()[0] == 6


def test_pieces_make_up_the_whole():
    for text in [*ODD, " x\n y  z" * 50]:
        assert "".join(text_runs(text, 7)) == text
        raw = text.encode()
        assert [word for run in word_runs(raw, 7) for word in run] == raw.lower().split()


def test_rounds_take_overlaps_in_turn():
    merges = token_counts.WordMerges(WORDS)
    whole = Tokenizer.from_file(WORDS)
    words = ["a" * n for n in range(1, 40)] + ["ab" * n for n in range(1, 20)]
    expected = [len(whole.encode(word, add_special_tokens=False).ids) for word in words]
    assert merges.counts([word.encode() for word in words]).tolist() == expected
    assert np.array_equal(merges.counts([word.encode() for word in words[::-1]])[::-1], expected)
