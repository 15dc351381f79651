"""Passages in text without full stops, or with those of other scripts."""

import random

import pytest

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.sentence_spans import remove_repeated_spans, repeated_spans, sentence_runs


def words(rng, n):
    return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))


@pytest.mark.parametrize("size, least", [(51, 20), (80, 48), (200, 168)])
def test_a_passage_in_a_line_without_sentence_ends(docs, size, least):
    rng = random.Random(size)
    passage = words(rng, size)
    rows = [(i, f"{words(rng, 7 + 31 * i)} {passage} {words(rng, 40 - 9 * i)}") for i in range(4)]
    found = {r["doc_id"]: r for r in repeated_spans(docs(rows)).collect()}
    assert sorted(found) == [1, 2, 3]
    for i, r in found.items():
        text = dict(rows)[i][r["start"] : r["start"] + r["length"]]
        assert text in passage and len(text.split()) == r["n_words"] >= least and r["n_sentences"] == 1
    kept = {r["doc_id"]: r["text"] for r in remove_repeated_spans(docs(rows)).collect()}
    assert kept[0] == rows[0][1] and len(kept[3].split()) == len(rows[3][1].split()) - found[3]["n_words"]


def test_unrelated_lines_lose_nothing(docs):
    rng = random.Random(2)
    assert repeated_spans(docs([(i, words(rng, 300)) for i in range(20)])).collect() == []


@pytest.mark.parametrize("end", ["।", "۔", "؟", "。", "…", '."', ".)", "!»", "?”", ".')]"])
def test_ends_of_sentences(docs, end):
    rng = random.Random(3)
    sentence = lambda n: words(rng, n) + end + " "
    starts = sentence_runs([(sentence(4) * 3 + "x").encode()], 2, 20, 50)[3]
    assert len(starts[0]) == 4
    passage = sentence(15) + sentence(15)
    rows = [(i, sentence(9) + passage + sentence(9)) for i in range(2)]
    out = [(r["doc_id"], r["n_sentences"], r["n_words"]) for r in repeated_spans(docs(rows)).collect()]
    assert out == [(1, 2, 30)]
