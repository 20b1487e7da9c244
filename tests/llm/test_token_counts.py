"""Token counts against the library whose model file they read."""

import json
import random

import duckdb
import public_tokenizers
import pytest
import tokenizers

from counterfoil.llm import token_counts
from counterfoil.llm.registry import QUERIES, count_model

from test_operators import HOSTILE, docs_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
SIGNS = [chr(i) for i in [*range(0x20, 0x250), *range(0x3040, 0x30A0), 0x85, 0x2028, 0x1F600, 0, 0x1C]]
BITS = ["  ", " ", "\n", "the", "<|endoftext|>", "<|endof", "'ll", "\t", "aaaa", "123", "\r\n "]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def model():
    return count_model()


def counted(library, text):
    return len(library.encode(text or "", add_special_tokens=False))


def test_counts_equal_the_library(library, model):
    draw = random.Random(7)
    texts = [
        "".join(draw.choice(SIGNS if draw.random() < 0.5 else BITS) for _ in range(draw.randint(0, 40)))
        for _ in range(1500)
    ]
    texts += ["a" * 50_000, "ab" * 20_000 + "!" * 20_000, "<|endoftext|>" * 3, " <|endoftext|> x", "x  y"]
    assert [model.counter.tokens(t) for t in texts] == [counted(library, t) for t in texts]


def test_every_sign_alone_and_in_context(library, model):
    """Also those beyond ASCII where two pattern engines could differ in a class."""
    wrong = [
        hex(i)
        for i in range(0x3100)
        if model.counter.tokens(f"a{chr(i)} b1{chr(i)}1 {chr(i)}")
        != counted(library, f"a{chr(i)} b1{chr(i)}1 {chr(i)}")
    ]
    assert not wrong


def test_proof_covers_just_what_encodes_alone(library, model):
    signs = token_counts.byte_signs()
    for token in list(json.load(open(PATH, encoding="utf-8"))["model"]["vocab"])[::97]:
        try:
            text = bytes(map(signs.__getitem__, token)).decode()
        except UnicodeDecodeError:
            continue
        if len(library.encode(text, add_special_tokens=False)) == 1:
            assert text in model.proven


def test_both_ways_of_merging_agree(model, monkeypatch):
    words = ["internationalization", "zzzzqqqq", "ünïcödé", " abracadabra", "a" * 24]
    scanned = [model.parts(w.encode()) for w in words]
    monkeypatch.setattr(token_counts, "SCANNED", 0)
    assert [model.parts(w.encode()) for w in words] == scanned


def test_memo_of_two_generations(model, library, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO_PIECES", 3)
    counter = token_counts.Counter(model)
    text = " ".join(f"qz{i % 11}xv" for i in range(200))
    assert counter.tokens(text) == counted(library, text)


def test_odd_rows(spark, model, library):
    rows = token_counts.count_tokens(docs_of(spark, HOSTILE).repartition(3), model).collect()
    want = [(i, len((t or "").encode()), counted(library, t)) for i, t, _, _ in HOSTILE]
    assert sorted(map(repr, ((r.doc_id, r.n_bytes, r.n_tokens) for r in rows))) == sorted(map(repr, want))
    assert all(r.over_limit == (r.n_tokens > 512) for r in rows) and any(r.over_limit for r in rows)
    empty = token_counts.count_tokens(docs_of(spark, []), model)
    assert empty.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and not empty.count()


def test_other_models_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Model.read(public_tokenizers.path("word_bpe_49k.json"))


def test_registered_query_equals_the_library(spark, medium, library):
    rows = QUERIES["op12_token_counts"](spark, medium).collect()
    texts = duckdb.execute(f"SELECT doc_id, text FROM '{medium}/documents.parquet'").fetchall()
    want = {i: counted(library, t) for i, t in texts}
    assert len(rows) == len(texts) and {r.doc_id: r.n_tokens for r in rows} == want
    assert all(r.n_bytes == len((t or "").encode()) for r, t in zip(
        sorted(rows, key=lambda r: r.doc_id), (t for _, t in sorted(texts, key=lambda x: x[0]))))
