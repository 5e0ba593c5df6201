"""Token files: blocks, ids against the tokenizer, offsets, read back from the files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from fitmill.llm import tokens, workload
from tests.llm.data import SMALL, edge_docs, edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("ids", [[0], [7] * 5000, list(range(4096)), [5, 2**32 - 1, 0, 9], [2**31] * 3 + [1], [3] * 4000 + [50_000] * 3])
def test_block_round_trip(ids):
    data = tokens.pack_block(np.array(ids, np.uint32))
    assert tokens.unpack_block(data).tolist() == ids


def test_outliers_are_exceptions():
    ids = np.array([*range(100, 1100), 4_000_000_000], np.uint32)
    assert len(tokens.pack_block(ids)) < 1500 and tokens.unpack_block(tokens.pack_block(ids)).tolist() == ids.tolist()


def test_encoder_equals_the_tokenizer(plain):
    encoder, draw = tokens.Encoder(PATH), random.Random(1)
    pieces = ["a", "b", "the", " ", " ", "  ", "\n", "\n\n", "\t", "é", "!", "'s", "1", "23", "<|endoftext|>", "　", "\x1c", "日本", ".", "\r\n"]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(14))) for _ in range(2000)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text), repr(text)


def test_encoder_cuts_runs_and_marked_words(plain):
    encoder, draw = tokens.Encoder(PATH), random.Random(2)
    pieces = ["der", "Ñandú", "don't", "'LL", " ", " ", " ", "\n", "\n\n ", ",", "%%%", "×", "ª", "<|", "7", "\x85", "   "]
    texts = ["".join(draw.choices(pieces, k=draw.randrange(14))) for _ in range(2000)] + ["x" * 1000, "a\n\n", "\n\n<|endoftext|>é"]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text), repr(text)


def test_usual_words_need_the_model_alone(plain, monkeypatch):
    encoder, met = tokens.Encoder(PATH), []
    whole, cut = encoder.tokenizer, encoder.cut
    encoder.tokenizer, encoder.cut = None, lambda word: met.append(word) or cut(word)
    text = "Verlich queasñ, queasñ queasñ%%%\nVerlich don't 12"
    assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain(text) == whole.encode(text).ids
    assert met.count("Ġqueas" + "Ã±") == 1  # once for all marks behind it
    monkeypatch.setattr(tokens, "REMEMBERED", 10)
    encoder.encode([" ".join(f"w{'a' * (k % 7)}{'b' * (k // 7)}" for k in range(60))])
    assert len(encoder.known) <= 10 and len(encoder.known.before) <= 40


def test_new_pieces_of_many_texts_go_to_the_model_together(plain, monkeypatch):
    encoder, met, draw = tokens.Encoder(PATH), [], random.Random(3)
    cut = encoder.cut
    encoder.cut = lambda word: met.append(word) or cut(word)
    texts = [" ".join("".join(draw.choices("abcdeéß", k=9)) + draw.choice(["", ",", ".", "'s"]) for _ in range(40)) for _ in range(50)]
    texts[7:7] = ["", " ", "a ", "\n", "  a\n\n  b ", "日本 a", "a <|endoftext|> b", "a\tb"]
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text), repr(text)
    assert len(met) <= 2000 // tokens.JOINED + 3
    monkeypatch.setattr(tokens, "REMEMBERED", 100)
    monkeypatch.setattr(tokens, "TOGETHER", 500)
    for text, ids in zip(texts * 2, encoder.encode(texts * 2), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text), repr(text)


def check(out, rows, plain):
    start, want = 0, []
    for doc_id, text in rows:
        ids = np.array([*plain(text), 0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert out == want


def test_given_documents(spark, plain):
    out = sorted(tuple(r) for r in workload.op9_token_files(spark, SMALL).collect())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id")
    check(out, [(r.doc_id, r.text) for r in docs.collect()], plain)


def test_awkward_rows(spark, plain):
    docs = edge_docs(spark)
    keyed = docs.selectExpr("doc_id", "text", "xxhash64(text) AS k").orderBy("doc_id", "k").collect()
    out = sorted((tuple(r) for r in tokens.read(tokens.write(docs, PATH)).collect()), key=lambda r: r[1])
    assert len(out) == len(edge_rows())
    check(out, [(r.doc_id, r.text) for r in keyed], plain)
    assert tokens.read(tokens.write(docs.limit(0), PATH)).collect() == []
