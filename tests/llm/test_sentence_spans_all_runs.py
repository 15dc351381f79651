"""Sentence spans against all runs of sentences, not only the shortest from each."""

import random

from llm_fixtures import docs  # noqa: F401
from test_sentence_spans import corpus, got, sentences
from epipanel.llm.sentence_spans import ENOUGH_WORDS, MIN_SENTENCES, MIN_WORDS, remove_repeated_spans, repeated_spans


def all_runs(text):
    sents = sentences(text)
    low = [tuple(text[s:e].lower() for s, e in sent) for sent in sents]
    out = []
    for i in range(len(sents)):
        for j in range(i + 1, len(sents) + 1):
            n = sum(map(len, sents[i:j]))
            if (j - i >= MIN_SENTENCES and n >= MIN_WORDS) or n >= ENOUGH_WORDS:
                out.append((i, j, tuple(low[i:j])))
    return sents, out


def brute(rows):
    """rows have distinct ids."""
    found = {ident: all_runs(text or "") for ident, text in rows}
    first = {}
    for ident in sorted(found):
        for _, _, run in found[ident][1]:
            first.setdefault(run, ident)
    out = []
    for ident, (sents, runs) in found.items():
        covered, seen = {}, set()
        for i, j, run in runs:
            if first[run] != ident or run in seen:
                for k in range(i, j):
                    covered[k] = min(covered.get(k, first[run]), first[run])
            seen.add(run)
        k = 0
        while k < len(sents):
            j = k
            while j in covered:
                j += 1
            if j > k:
                start, end = sents[k][0][0], sents[j - 1][-1][1]
                out.append((ident, min(covered[x] for x in range(k, j)), start, end - start, j - k, sum(map(len, sents[k:j]))))
            k = j + 1
    return sorted(out)


def test_matches_all_runs(docs):
    rows = [*corpus(1), *((10_000 + i, t) for i, t in corpus(2))]
    want = brute(rows)
    assert len(want) > 40
    assert got(repeated_spans(docs(rows))) == want


def test_the_tail_of_a_repeated_passage_goes(docs):
    rng = random.Random(5)
    sentence = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n)) + ". "
    passage = sentence(60) + sentence(40)
    rows = [(i, sentence(9) + passage + sentence(9)) for i in range(3)]
    assert [r[-1] for r in got(repeated_spans(docs(rows)))] == [100, 100]
    kept = {r["doc_id"]: len(r["text"].split()) for r in remove_repeated_spans(docs(rows)).collect()}
    assert kept == {0: 118, 1: 18, 2: 18}
