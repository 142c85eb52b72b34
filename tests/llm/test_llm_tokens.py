"""Token counts and byte-level BPE against plain versions of the same."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from conftest import SMALL
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opdiag.llm import byte_bpe, piece_bpe, token_counts
from opdiag.llm.queries import PIECES as QUERY_PIECES
from opdiag.llm.queries import QUERIES, RANKS

with open(RANKS, "rb") as file:
    CONTENT = file.read()
VOCABULARY = byte_bpe.Vocabulary(CONTENT, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=VOCABULARY.ids, special_tokens={}
)
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "a" * 3000 + "é" * 500), (5, "it's  the\n\n end. x"),
    (5, "it's  the\n\n end. x"), (None, "naïve 北京 \U0001f600!!"), (7, "<|endoftext|>"),
    (8, "word " * 30_000 + "\x85\x1c\xa0 end"),
]


def digests(text):
    ids = REFERENCE.encode_ordinary(text or "")
    return (
        len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256((text or "").encode()).hexdigest(),
    )


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None)
def test_ids_equal_the_public_library(text):
    assert VOCABULARY.encode(text) == REFERENCE.encode_ordinary(text)
    assert VOCABULARY.decode(VOCABULARY.encode(text)) == text.encode()


def test_long_matches_merge_alike():
    random.seed(5)
    for letters in ("ab", "abcdeéa", "e", "the of"):
        word = "".join(random.choice(letters) for _ in range(5000))
        assert VOCABULARY.encode(word) == REFERENCE.encode_ordinary(word)
    assert not any(VOCABULARY.used)


def test_latin_pattern_splits_like_the_full_one():
    for at in range(byte_bpe.LATIN):
        text = f"a{chr(at)}1{chr(at)}{chr(at)} {chr(at)} b{chr(at)}"
        assert VOCABULARY.latin.findall(text) == VOCABULARY.pattern.findall(text)


def test_encoding_of_odd_rows(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("n_tokens", F.lit(1))
    encode = byte_bpe.encoder(spark, RANKS, public_tokenizers.PATTERN, with_ids=True)
    decode = byte_bpe.decoded(spark, RANKS, public_tokenizers.PATTERN)
    rows = docs.select("doc_id", "text", encode("text").alias("e"))
    rows = rows.withColumn("back", decode("e.ids")).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert (row.e.n_tokens, row.e.ids_sha256, row.e.decoded_sha256) == digests(row.text)
        assert row.e.ids == REFERENCE.encode_ordinary(row.text or "")
        assert bytes(row.back) == (row.text or "").encode()


def test_query_covers_every_document(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op2_byte_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == digests(texts[row.doc_id])


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    encode = byte_bpe.encoder(spark, RANKS, public_tokenizers.PATTERN)
    count = token_counts.counter(spark, RANKS)
    assert empty.select(encode("text"), count("text")).count() == 0


def greedy(word, first, later):
    """Longest pieces from the left; 1 if some rest has no piece."""
    at, count = 0, 0
    while at < len(word):
        known = first if at == 0 else later
        size = next((n for n in range(len(word) - at, 0, -1) if word[at : at + n] in known), 0)
        if not size:
            return 1
        at, count = at + size, count + 1
    return count


PIECES = st.lists(st.text("abc", min_size=1, max_size=4).map(str.encode), max_size=12)


@given(PIECES, PIECES, st.text("abcd", min_size=1, max_size=14).map(str.encode))
@settings(max_examples=400, deadline=None)
def test_counts_equal_greedy_matching(first, later, word):
    automaton = token_counts.Automaton(first, later)
    assert automaton.count(word) == greedy(word, set(first), set(later))


def test_word_piece_list():
    first, later = token_counts.word_piece_list(b"un\n##aff\n##able\n##a\nable\n")
    automaton = token_counts.Automaton(first, later)
    assert [automaton.count(w) for w in (b"unaffable", b"able", b"unx", b"unaable")] == [3, 1, 1, 3]


def test_count_query_against_brute_force(spark):
    first, later = (set(x) for x in token_counts.rank_file_pieces(CONTENT))
    known = {}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op1_token_counts"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words = (texts[row.doc_id] or "").encode().split()
        for word in words:
            if word not in known:
                known[word] = greedy(b" " + word, first, later)
        assert (row.n_words, row.n_tokens) == (len(words), sum(known[word] for word in words))


def test_count_of_odd_rows(spark):
    count = token_counts.counter(spark, RANKS)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    rows = docs.select("text", count("text").alias("c")).collect()
    first, later = (set(x) for x in token_counts.rank_file_pieces(CONTENT))
    for row in rows:
        words = (row.text or "").encode().split()
        if len(row.text or "") < 5000:
            assert row.c.n_tokens == sum(greedy(b" " + word, first, later) for word in words)
        assert row.c.n_words == len(words)


@pytest.mark.parametrize("size", [1, 7, 1000])
def test_pieces_keep_words_whole(size):
    from opdiag.llm.texts import pieces

    text = ("aa bbb\n" + "c" * 50 + "  d").encode()
    assert b"".join(pieces(text, size)) == text
    assert sum((part.split() for part in pieces(text, size)), []) == text.split()


def test_rank_file_is_not_copied():
    assert base64.b64decode(CONTENT.split()[0])
    assert RANKS.startswith(public_tokenizers.path(""))


PIECES = piece_bpe.Vocabulary(open(QUERY_PIECES, "rb").read())
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=QUERY_PIECES)


def piece_digests(text):
    ids = LIBRARY.encode(text or "")
    return (
        len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


@given(st.text(max_size=60) | st.text("abe th▁ \n1é北", max_size=60))
@settings(max_examples=200, deadline=None)
def test_pieces_equal_the_public_library(text):
    ids = PIECES.encode(text)
    assert ids == LIBRARY.encode(text)
    assert PIECES.decode(ids).decode() == LIBRARY.decode(ids)


def test_long_words_and_runs_of_spaces_in_pieces(monkeypatch):
    random.seed(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(random.choice(letters) for _ in range(20_000)), "a" * 5000, "the" * 2000]
    texts += [" " * n + "x" for n in range(14, 36)] + ["ing" * 50 + " " * 40, "x " * 3000]
    for text in texts:
        assert PIECES.encode(text) == LIBRARY.encode(text)
    monkeypatch.setattr(piece_bpe, "CHARS", 50)
    for text in texts[1:] + ["北京 and more words. " * 40, "y" * 49, "y" * 50]:
        assert PIECES.encode(text) == LIBRARY.encode(text)


def test_pieces_of_odd_rows(spark):
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string").withColumn("ids", F.lit(1))
    encode, decode = piece_bpe.encoder(spark, QUERY_PIECES, True), piece_bpe.decoder(spark, QUERY_PIECES)
    rows = docs.select("text", encode("text").alias("e")).withColumn("back", decode("e.ids")).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        assert (row.e.n_tokens, row.e.ids_sha256, row.e.decoded_sha256) == piece_digests(row.text)
        assert row.e.ids == LIBRARY.encode(row.text or "") and row.back == (row.text or "")
    assert docs.limit(0).select(encode("text")).count() == 0


def test_piece_query_covers_every_document(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = QUERIES["op11_piece_bpe"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == piece_digests(texts[row.doc_id])
