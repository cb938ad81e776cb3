"""Encoding and decoding against the tokenizers library."""

import hashlib
import random
import sys

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer as Library

from homelake.llm import bpe
from homelake.llm.bpe import Encoder, Lexicon, Merger, Splitter, Tokenizer, compiled, decode_ids, encode_texts, minimal_automaton, op13_bpe
from tests.llm.helpers import digest, documents, write_tables

FILE = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "  \n\n ", "Hello world", "it's they'll we'VE 'sx", "a  b   c \t\n d", "<|endoftext|>", "x <|endoftext|>  y<|endoftext|><|endoftext|>", "<|endoftext",
    "Ünïcödé 日本語テキスト 🙂🙃 é", "  　x\u0085y\x1cz", "123,456.78 ½ ² ٣", "A" * 5000, "ab" * 3000, "aaaa" * 700 + " " * 900, "�﻿​",
    "new \U0001df90 letters ࢏࢏", "\U00010d40\U00010d41 1", "word " * 20_000,
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer(FILE)


@pytest.fixture(scope="module")
def library():
    return Library.from_file(FILE)


@pytest.mark.parametrize("chunk, words", [(1 << 20, 1 << 16), (50, 3), (1 << 20, 0)])
def test_query_matches_the_library(spark, tmp_path, monkeypatch, library, chunk, words):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", chunk)
    monkeypatch.setattr(bpe.frequent_words, "__defaults__", ("text", words))
    rows = [*enumerate(TEXTS), (4, TEXTS[4]), (None, "no id"), (2**60 + 1, "far")]
    folder = write_tables(spark, tmp_path, documents=documents(spark, rows).withColumn("ids", F.lit("x")))
    want = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), digest(back)))
    assert sorted(map(repr, map(tuple, op13_bpe(spark, folder).collect()))) == sorted(map(repr, want))


def test_empty_table(spark, tmp_path):
    assert op13_bpe(spark, write_tables(spark, tmp_path, documents=documents(spark, []))).collect() == []


def test_other_columns_stay(spark, tokenizer, library):
    docs = spark.createDataFrame([(None, "x y", 2**61 + 1), (1, "z", None)], "a int, body string, decoded long")
    encoded = encode_texts(docs, tokenizer, "body", "ids")
    assert {(r["a"], tuple(r["ids"]), r["decoded"]) for r in encoded.collect()} == {
        (None, tuple(library.encode("x y").ids), 2**61 + 1), (1, tuple(library.encode("z").ids), None)}
    assert sorted(r["decoded"] for r in decode_ids(encoded, tokenizer).collect()) == ["x y", "z"]


def test_merges_of_random_words(tokenizer, library):
    rng, words = random.Random(2), [b"", b"x" * 64, b"xy" * 40]
    for _ in range(3000):
        word = "".join(rng.choice("abcdehinorst'ÄÖüß日 ") for _ in range(rng.randint(1, 40)))
        parts = [part.encode() for part in Splitter({})(word)]
        own = [i for part in parts for i in tokenizer.merged(part)]
        assert own == library.encode(word).ids, word
        words += parts
    assert [own.tolist() for own in Merger(tokenizer)(words)] == [tokenizer.merged(word) for word in words]
    assert tokenizer._merged_long([tokenizer.single[b] for b in b"internationalisation"]) == tokenizer.merged(b"internationalisation")


def test_every_code_point_is_split_as_the_library_does(library):
    from tokenizers.pre_tokenizers import ByteLevel

    split, theirs = Splitter({}), ByteLevel(add_prefix_space=False)
    for c in (chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000):
        text = f"a{c}b {c}{c} 1{c}1 .{c}. {c}"
        assert split(text) == [text[a:b] for _, (a, b) in theirs.pre_tokenize_str(text)], hex(ord(c))


def test_automaton_is_minimal_and_numbers_its_words(tokenizer):
    rng = random.Random(5)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 7))) for _ in range(400)} | {b"walking", b"talking", b"walked", b"talked"})
    states, _ = minimal_automaton(words)
    # Two states of a minimal automaton never accept the same endings.
    endings = []
    for ends, arcs in states:
        endings.append(frozenset(([b""] if ends else []) + [bytes([label]) + rest for label, target in arcs for rest in endings[target]]))
    assert len(set(endings)) == len(endings)
    lexicon = Lexicon(compiled(words, tokenizer))
    assert lexicon.numbers(words).tolist() == list(range(len(words)))
    others = [b"abcabcabcabc", b"walk", b"zz", b"x" * 50]
    assert lexicon.numbers(others).tolist() == [-1] * 4
    ids, starts = Encoder(lexicon, tokenizer)(["walking", None, "zzz talked"])
    assert starts.tolist() == [0, len(tokenizer.merged(b"walking")), len(tokenizer.merged(b"walking")), len(ids)]


def test_a_worker_looks_a_word_up_once(tokenizer, monkeypatch):
    lexicon = Lexicon(compiled([b"known"], tokenizer))
    encoder, asked, numbers = Encoder(lexicon, tokenizer), [], lexicon.numbers
    monkeypatch.setattr(lexicon, "numbers", lambda words: asked.extend(words) or numbers(words))
    first, again = encoder(["known strange", "strange"]), encoder(["strange", "known strange<|endoftext|>"])
    assert sorted(asked) == [b"", b" strange", b"known", b"strange"]  # the added token's place is empty
    assert again[0].tolist() == [*first[0][first[1][1] :], *first[0][: first[1][1]], tokenizer.added["<|endoftext|>"]]


@pytest.mark.parametrize("name, bound", [("HELD_WORDS", 3), ("HELD_CHARS", 8)])
def test_kept_words_are_bounded(tokenizer, library, monkeypatch, name, bound):
    monkeypatch.setattr(bpe, name, bound)
    encoder = Encoder(Lexicon(compiled([b"b"], tokenizer)), tokenizer)
    for at in range(20):
        text = f"word{at} b Ünï{at % 3}"
        assert encoder([text])[0].tolist() == library.encode(text).ids
        assert len(encoder.index) <= bound + 6


def test_counts_do_not_depend_on_what_is_kept(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 4)
    monkeypatch.setattr(bpe, "HELD_WORDS", 2)
    docs = spark.createDataFrame([("a b a",), ("a é<|endoftext|>é",), (None,), ("x" * 40,)], "text string")
    assert bpe.frequent_words(docs, tokenizer) == sorted([b"a", b" b", b" a", " é".encode(), "é".encode()])


@pytest.mark.parametrize("tokens", [1, 3, 1 << 18])
def test_texts_cut_inside_characters_decode_by_themselves(spark, tokenizer, monkeypatch, tokens):
    monkeypatch.setattr(bpe, "CHUNK_TOKENS", tokens)
    low, high = (tokenizer.single[b] for b in "é".encode())
    rows = [(0, [low]), (1, [high]), (2, []), (3, [low, high]), (4, tokenizer.merged(b" word")), (5, [low, high, low]), (6, [])]
    decoded = decode_ids(spark.createDataFrame(rows, "at int, ids array<int>").coalesce(1), tokenizer, packed="packed").collect()
    assert {r["at"]: r["decoded"] for r in decoded} == {0: "�", 1: "�", 2: "", 3: "é", 4: " word", 5: "é�", 6: ""}
    assert {r["at"]: bytes(r["packed"]) for r in decoded} == {at: np.array(ids, dtype="<u4").tobytes() for at, ids in rows}
