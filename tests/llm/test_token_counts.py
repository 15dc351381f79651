"""Token counts against the tokenizer itself."""

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.token_counts import KEPT_LENGTH, TokenCounter, count_tokens, whole_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def counter():
    return TokenCounter(PATH, public_tokenizers.PATTERN)


def texts(seed=1, n=400):
    rng = random.Random(seed)
    pieces = ["the", " The", "ing", "'s", "'LL", " don't", "12", " 345678", "\n", "\n\n", "  ", "\t", " ", ".", "...", "é", "naïve", "漢字", "नमस्ते", "😀", "👩‍👩‍👧",
              " ", " ", "\u0085", "​", "\x1c", "<|endoftext|>", "<|endoftext", "|>", "x" * 30, "\r\n", "ſ", "K", "࢏", "꟎", "\U00033333", "Zyxxqv"]
    return ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(n)]


def test_counts_are_the_tokenizers(counter):
    cases = texts() + ["", " ", "<|endoftext|>", "<|endoftext|><|endoftext|> a", "a" * 5000, " " * 5000, "é" * 2500, "\n" * 3000, "1" * 2500 + " x", "!" * 2100]
    cases += ["word " * 20_000, "<|endoftext|>" * 50]
    assert [counter.count(t) for t in cases] == [counter.by_library(t) for t in cases]
    # and again, from what was kept
    assert [counter.count(t) for t in cases] == [counter.by_library(t) for t in cases]


def test_every_whole_token_is_one_token(counter):
    whole = whole_tokens(PATH)
    assert len(whole) > 40_000 and "<|endoftext|>" not in whole
    rng = random.Random(2)
    assert all(counter.by_library(t) == 1 for t in rng.sample(whole, 2000))


def test_most_pieces_take_the_shortcut(counter):
    pieces = counter._split("This is an ordinary sentence about the weather, and its tokens are whole words. " * 20)
    whole = set(whole_tokens(PATH))
    assert sum(p in whole for p in pieces) > 0.9 * len(pieces)


def test_kept_pieces_are_bounded():
    counter = TokenCounter(PATH, public_tokenizers.PATTERN, [])
    counter.costs.room = 50
    rng = random.Random(3)
    words = ["".join(rng.choices("qxzjkv", k=rng.randint(3, KEPT_LENGTH + 9))) for _ in range(300)]
    assert [counter.count(w) for w in words] == [counter.by_library(w) for w in words]
    assert len(counter.costs) <= 50


def test_unknown_characters_are_looked_up(counter):
    # code points assigned only by newer versions of Unicode, beside common ones
    for c in ("՘", "֋", "࢏", "꟒", "\U00010940", "\U0001e6c0", "\U000323b0"):
        text = f"a{c}1{c} {c}{c}. {c}b"
        assert counter.count(text) == counter.by_library(text)


def test_rows(docs):
    rows = [(1, None), (2, ""), (3, "Grüße <|endoftext|>"), (3, "Grüße <|endoftext|>"), (None, "a"), (5, "word " * 513), (6, "word " * 511)]
    frame = docs(rows).withColumn("n_tokens", F.lit("x")).withColumn("ident", F.lit(0))
    found = count_tokens(frame, PATH, public_tokenizers.PATTERN)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    counter = TokenCounter(PATH, public_tokenizers.PATTERN)
    want = [(i, len((t or "").encode()), counter.by_library(t or ""), counter.by_library(t or "") > 512) for i, t in rows]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert count_tokens(docs([]), PATH, public_tokenizers.PATTERN).collect() == []
