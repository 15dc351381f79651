"""Texts in no learned language are rejected."""

import random

import duckdb

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.langid import learn_dictionaries, predict_languages

SF_DIR = "/root/testdata/sf0.01"


def test_gibberish_and_an_unlearned_language_are_rejected(spark, docs):
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9)))
    rows = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((30, 60, 150, 400, 1500) * 8)]
    french = duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' WHERE lang = 'fr' AND n_chars > 300 ORDER BY doc_id LIMIT 40").fetchall()
    rows += [(100 + i, t) for i, (t,) in enumerate(french)]
    learned = learn_dictionaries(spark.read.parquet(f"{SF_DIR}/documents.parquet").where("lang <> 'fr'"))
    out = predict_languages(docs(rows), learned).collect()
    assert len(out) == 80 and sum(r["__lang_rejected"] for r in out) >= 76


def test_the_margin_loses_few_clean_rows(spark):
    """Set on rows not learned from, it rejects at most its share of them."""
    import random

    from epipanel.llm import langid

    rng = random.Random(9)
    letters = {"aa": "abcdefghij", "bb": "ghijklmnop", "cc": "mnopqrstuv"}
    word = lambda lang: "".join(rng.choices(letters[lang], k=rng.randint(2, 8)))
    rows = [(i, " ".join(word(lang) for _ in range(rng.randint(2, 60))), lang) for i in range(900) for lang in letters]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = langid.learn_dictionaries(df.where("doc_id % 2 = 0"))
    held = df.where("doc_id % 2 = 1")
    share = langid.margin_share(held, learned, max_rows=2000)
    assert 0 <= share <= langid.MIN_SHARE
    found = langid.predict_languages(held, learned, min_share=share).where("__lang_pred = lang")
    assert found.where("__lang_rejected AND __lang_margin > 0").count() <= 0.005 * found.count() + 1
    assert langid.margin_share(held.limit(5), learned) == langid.MIN_SHARE
    assert langid.margin_share(held.limit(0), {}) == langid.MIN_SHARE


def test_prediction_is_the_smallest_output(spark, docs):
    """Every text compressed with every dictionary in one process gives the same rows."""
    import random

    import zstandard

    from epipanel.llm import langid

    rng = random.Random(3)
    text = lambda alphabet: " ".join("".join(rng.choices(alphabet, k=5)) for _ in range(rng.randint(1, 40)))
    learned = {"x": text("abcdef").encode() * 9, "y": text("defghi").encode() * 9}
    rows = [(i, text(rng.choice(["abcdef", "defghi", "xyz"]))) for i in range(60)] + [(100, None), (101, "12 !"), (102, "")]
    got = {r["doc_id"]: r for r in langid.predict_languages(docs(rows), learned).collect()}
    for ident, body in rows:
        if not any(c.isalpha() for c in body or ""):
            assert (got[ident]["__lang_pred"], got[ident]["__lang_rejected"]) == ("und", True)
            continue
        sizes = {}
        for lang, content in learned.items():
            coder = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False)
            lead = content[: langid.LEAD_BYTES]
            sizes[lang] = len(coder.compress(lead + f" {body} ".encode())) - len(coder.compress(lead))
        best, second = sorted(sizes.values())
        r = got[ident]
        assert r["__lang_pred"] == min(sizes, key=lambda k: (sizes[k], k)) and r["__lang_margin"] == second - best and r["__lang_size"] == best
        assert r["__lang_rejected"] == (second - best < max(1, langid.MIN_SHARE * best))


def test_the_margin_is_set_on_all_rows(spark):
    """Every labelled row counts, however many counts the driver adds up."""
    import random

    from epipanel.llm import langid

    rng = random.Random(4)
    letters = {"aa": "abcdefghij", "bb": "ghijklmnop", "cc": "mnopqrstuv"}
    words = {lang: ["".join(rng.choices(a, k=rng.randint(2, 8))) for _ in range(300)] for lang, a in letters.items()}
    text = lambda lang, n, odd: " ".join(rng.choice(words[rng.choice([*letters]) if rng.random() < odd else lang]) for _ in range(n))
    learned = {lang: text(lang, 3000, 0).encode() for lang in letters}
    rows = [(i, text(lang, rng.randint(10, 40), 0.6), lang) for i in range(3000) for lang in letters]
    rows += rows[:9] + [(1, None, "aa"), (2, "12 !", "bb"), (3, "abc", None)]
    held = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = langid.predict_languages(held, learned).where("__lang_pred = lang").collect()
    shares = sorted(r["__lang_margin"] / r["__lang_size"] for r in found)
    at = lambda lost: shares[int(lost * len(shares))]
    assert len(shares) > langid.MARGIN_ROWS and 0 < at(0.05) < at(0.1) < at(0.2) < langid.MIN_SHARE < at(0.9)
    for lost in (0.05, 0.1, 0.2, 0.9):
        want = min(langid.MIN_SHARE, at(lost) * (1 - 1e-9))
        assert langid.margin_share(held, learned, lost=lost) == want
        assert langid.margin_share(held, learned, lost=lost, max_rows=10) == want
