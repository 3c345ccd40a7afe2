import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loomtab.llm import bpe as B
from loomtab.llm import tokens

PATH = tokens.VOCABULARY
pytestmark = pytest.mark.skipif(not os.path.exists(PATH), reason="no public vocabulary here")


@pytest.fixture(scope="module")
def both():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return B.load(PATH), lambda s: t.encode(s, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_any_text(both, text):
    ours, theirs = both
    assert ours.encode(text) == theirs(text)
    assert ours.decode(ours.encode(text)) == text


@pytest.mark.parametrize("base", ["a", "ab", "ers", "tion", "日本", "=-", "0", " ", "\n", " \n", "é", "'s", "-"])
def test_long_runs_stream_in_windows(both, base):
    ours, theirs = both
    text = "x " + base * 40_000 + " end"
    assert ours.encode(text) == theirs(text)


def test_chunks_do_not_show(both, monkeypatch):
    ours, theirs = both
    monkeypatch.setattr(B, "CHUNK", 48)
    rng = random.Random(5)
    pieces = ["aaaa", "the", "ing", "é", "日本", " ", "  ", "\n", "12", "...", "'s", "'ll", "'", "<|endoftext|>", "tion", " "]
    for _ in range(400):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 80)))
        text += rng.choice([" ", "\n", "a", "7", "="]) * rng.randint(0, 150) + rng.choice(["", "b", " ", "'s"])
        assert ours.encode(text) == theirs(text), text


def test_lookahead_bounds_the_window(both):
    ours, _ = both
    assert 0 < ours.lookahead < 2000
    stream = B.ByteStream(ours)
    for _ in range(200):
        stream.push(b"abcdefgh" * 100)
        assert len(stream.pending) < 2 * stream.window


def test_small_merge_list_lookahead():
    # b c merges first, so whether a b may merge depends on one byte to its right
    assert B.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2
    assert B.sufficient_lookahead([]) == 0


def test_ranks_give_the_same_ids(both):
    ours, _ = both
    other = PATH.replace(".json", ".tiktoken")
    if os.path.exists(other):
        ranked = B.Bpe.from_file(other)
        for text in ("Hello there, tokenizer!", "  spaces\n\nand 12345 numbers", "日本語 ünïcode"):
            assert ranked.encode(text) == ours.encode(text)


def test_corpus(spark, both):
    docs = spark.createDataFrame(
        [(1, "Hello <|endoftext|>", "x"), (2, "", "x"), (3, None, "x"), (3, " ", "x"), (4, "word " * 60_000, "x")], "doc_id bigint, text string, ids string"
    )
    got = [(r["doc_id"], list(r["ids"])) for r in tokens.encode_corpus(docs).collect()]
    assert sorted(got) == sorted([(1, both[1]("Hello <|endoftext|>")), (2, []), (3, []), (3, both[1](" ")), (4, both[1]("word " * 60_000))])
    back = {(r["doc_id"], r["text"]) for r in tokens.decode_corpus(tokens.encode_corpus(docs)).collect()}
    assert (1, "Hello <|endoftext|>") in back and (2, "") in back
    sizes = {(r["doc_id"], r["n_tokens"]) for r in tokens.count_tokens(docs, ("ids",)).collect()}
    assert (2, 0) in sizes and (4, len(both[1]("word " * 60_000))) in sizes
    assert tokens.encode_corpus(docs.limit(0)).count() == 0
