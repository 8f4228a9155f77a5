"""BPE codec against the tokenizers library."""

import os
import random
import tempfile

import numpy as np
import pytest
from tokenizers import Tokenizer

from quire.llm import bpe
from quire.llm.queries import tokenizer_file

ODD = ["", " ", "\x1c\x1d a\x1eb\x85c", "don't WE'LL they're 'story o'clock's", "ΟΔΟΣ Σ ΣΑΣ", "İstanbul ǅ ﬁ",
       "<|startoftext|>a<|endoftext|>", "x<|endoftext|>  <|STARTOFTEXT|> <|endoftext", "á é́ 가",
       "12 345½ ²³ ①", "日本語 テキスト 🙂🙂👩‍👩‍👧", "a" * 5000, "​　᠎﻿", "!!!...??--", "ñandú ÅNGSTRÖM K K"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_file())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_texts_match_the_library(library):
    own = bpe.Encoder(bpe.Vocabulary(tokenizer_file()), None)
    rng = random.Random(1)
    pool = [chr(c) for c in [*range(1, 0x250), *range(0x370, 0x530), *range(0x1e00, 0x2100), *range(0x3000, 0x3100),
                             *range(0x1f600, 0x1f640), *range(0x660, 0x66a)]]
    texts = ODD + ["".join(rng.choice(pool) for _ in range(rng.randrange(200))) for _ in range(400)] \
        + ["".join(rng.choice("abcdeé 'sltrvm.") for _ in range(300)) for _ in range(200)]
    for t in texts:
        ids, decoded = expected(library, t)
        got = own.encode(t)
        assert np.frombuffer(got, "<u4").tolist() == ids, repr(t)
        assert own.decode(got) == decoded


def test_many_words_side_by_side_merge_as_one_by_one():
    vocabulary, rng = bpe.Vocabulary(tokenizer_file()), random.Random(3)
    words = ["".join(rng.choice("abcdeé日 .thein") for _ in range(rng.randrange(1, 90))).encode() for _ in range(600)]
    assert vocabulary.merge_all(words) == [vocabulary.merge(w) for w in words]
    assert vocabulary.merge_all([]) == []


def test_memo_forgets(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 20)
    own = bpe.Encoder(bpe.Vocabulary(tokenizer_file()), None)
    for k in range(30):
        texts = [f"word{k} other{k * 7} <|endoftext|> the", "same words again and again"]
        for text, (ids, decoded) in zip(texts, own.encode_all(texts)):
            assert (np.frombuffer(ids, "<u4").tolist(), decoded) == expected(library, text)
        assert len(own.memo) == len(own.ids) == len(own.texts) <= 40


def test_lexicon_is_exact_and_minimal():
    rng = random.Random(2)
    words = {"".join(rng.choice("abcä") for _ in range(rng.randrange(1, 7))).encode() for _ in range(500)}
    entries = {w: [rng.randrange(1 << 20) for _ in range(rng.randrange(1, 4))] for w in words}
    path = os.path.join(tempfile.mkdtemp(), "x.bin")
    with open(path, "wb") as f:
        f.write(bpe.compile_lexicon(entries))
    lex = bpe.Lexicon(path)
    assert all(lex.find(w) == ids for w, ids in entries.items())
    others = {w + x for w in words for x in (b"a", b"\xc3")} | {w[:-1] for w in words} | {b"zzz", b""}
    assert all(lex.find(w) is None for w in others - words)
    # equal right languages share one state
    rights = set()
    for w in words | {b""}:
        for k in range(len(w) + 1):
            rights.add(frozenset(x[k:] for x in words if x.startswith(w[:k])))
    assert len(lex.final) == len(rights)
    with open(path, "wb") as f:
        f.write(bpe.compile_lexicon({}))
    assert bpe.Lexicon(path).find(b"a") is None


@pytest.mark.parametrize("words", [0, 40, 50_000])
def test_operator_matches_the_library(spark, library, words):
    data = [(i, t, i, "r") for i, t in enumerate([*ODD, None, "the same words the same words", "the same words " * 20_000])]
    data.append(data[-1])
    df = spark.createDataFrame(data, "doc_id long, text string, ids long, row string").repartition(3)
    coded = bpe.encode(df, tokenizer_file(), words=words, decoded=True)
    assert coded.columns == ["row", "ids", "decoded"]
    again = bpe.decode(coded.select("row", "ids"), tokenizer_file())
    for r in [*coded.collect(), *again.collect()]:
        ids, decoded = expected(library, r.row.text)
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == decoded


def test_lexicon_takes_the_most_frequent_words(spark):
    """Ties at the highest count, and counts of which every one is high."""
    tied = spark.createDataFrame([("aa bb cc dd ee",)] * 4, "text string")
    got = bpe.frequent_words(tied, tokenizer_file(), words=3)
    everything = bpe.frequent_words(tied, tokenizer_file(), words=100)
    assert len(everything) >= 5 and got == everything[:3]
    uneven = spark.createDataFrame([("aa " * 90 + "bb " * 50 + "cc " * 7 + "dd " * 7,)], "text string")
    every = bpe.frequent_words(uneven, tokenizer_file(), words=100)
    for k in range(1, len(every) + 1):
        assert len(bpe.frequent_words(uneven, tokenizer_file(), words=k)) == k


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, tokenizer_file()), tokenizer_file()).collect() == []
