"""Language identification by compression (operator 6).

For each language a raw-content zstandard dictionary is filled with training
text. A text is encoded with every dictionary; the language whose dictionary
gives the smallest output is predicted, and the prediction is rejected when
its margin over the second is narrow for the output's size. What is encoded are the lower-cased
letters, other characters as one space between words, so that symbols and
digits do not count. A few KiB of the dictionary stand before the text and
their own output size is taken off: zstandard would otherwise store a short
text uncompressed, and every language would cost the same.

The dictionaries are a bounded sample of the training rows (``dict_bytes`` a
language, chosen by the hash of the text); prediction reads whole texts of all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import col, crc_bucket, narrow, table, tidy
from epipanel.llm.words import few_rows
from epipanel.operators.ranges import running_total
from epipanel.session import write_scratch

DICT_BYTES = 64 * 1024
LEAD_BYTES = 5000
LEVEL = 12
MIN_MARGIN = 1  # bytes by which the best language must beat the second
MIN_SHARE = 0.07  # and of its own output size; at sf0.1 2 of 1,960 held-out texts have less, as unlearned languages and random letters do
MARGIN_ROWS = 4000  # counts, at most, that margin_share adds up on the driver
LOST_SHARE = 0.005  # of the rightly predicted rows that the margin may reject
LEAST_ROWS = 200  # with fewer MIN_SHARE holds
MAX_LANGUAGES = 512  # dictionaries are sent to every task: 512 x 64 KiB at most
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"


def letters(text: Column) -> Column:
    """Lower-cased words of letters, each between single spaces."""
    return F.lower(F.concat(F.lit(" "), F.trim(F.regexp_replace(text, r"[^\p{L}]+", " ")), F.lit(" ")))


def learn_dictionaries(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dict_bytes: int = DICT_BYTES
) -> dict[str, bytes]:
    """``{language: dictionary content}`` from the rows with a language and a letter.

    Of each language about four dictionaries' worth of text is drawn by the
    text's hash, so that repeated texts count once; the driver sees only
    that sample. Texts longer than a dictionary are drawn only where a
    language has no shorter ones, and then cut to it. Raises ValueError
    beyond ``MAX_LANGUAGES``. No usable row: an empty dict.
    """
    rows = narrow(labelled, text=text_col, lang=lang_col).where(
        F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER)
    )
    rows = rows.select("lang", "text", F.octet_length("text").alias("size"), F.xxhash64("text").alias("draw"))
    fits = F.col("size") <= dict_bytes
    volume = rows.groupBy("lang").agg(F.sum(F.when(fits, F.col("size"))).alias("short"), F.count("*").alias("rows"))
    volume = volume.limit(MAX_LANGUAGES + 1).collect()
    if len(volume) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages: their dictionaries would not fit into every task")
    if not volume:
        return {}
    share = {r["lang"]: min(1.0, 4 * dict_bytes / r["short"] if r["short"] else 4 / r["rows"]) for r in volume}
    limit = F.element_at(
        F.create_map(*[F.lit(x) for lang, s in share.items() for x in (lang, int((s - 0.5) * (2**64 - 2**12)))]), F.col("lang")
    )
    only_long = F.col("lang").isin([r["lang"] for r in volume if not r["short"]])
    sample = rows.where((fits | only_long) & (F.col("draw") <= limit))
    texts: dict[str, dict[int, str]] = {}
    for r in sample.select("lang", "draw", letters(F.substring("text", 1, dict_bytes)).alias("text")).collect():
        texts.setdefault(r["lang"], {})[r["draw"]] = r["text"]
    learned = {}
    for lang in sorted(texts):
        content = "".join(texts[lang][draw] for draw in sorted(texts[lang]))
        learned[lang] = content.encode()[:dict_bytes]
    return learned


def predict_languages(
    docs: DataFrame, dictionaries: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
    level: int = LEVEL, min_margin: int = MIN_MARGIN, min_share: float = MIN_SHARE,
) -> DataFrame:
    """``docs`` with ``__lang_pred, __lang_score, __lang_margin, __lang_size, __lang_rejected`` added.

    * null text, or text without a letter: ``und``, score 0, rejected;
    * score: 2^-bytes shares of the languages' output sizes, so 1/2 for a
      tie of two; ties go to the language that sorts first, and are rejected;
    * margin: bytes by which the second language is larger (null with one language);
      less than ``min_margin``, or than ``min_share`` of the best size, is rejected;
    * size: bytes of the best language (null where nothing was encoded);
    * without dictionaries every row is ``und``; repeated rows are predicted alike; an empty table gives no rows.
    """
    langs = sorted(dictionaries)
    schema = docs.select(
        "*",
        F.lit("").alias("__lang_pred"),
        F.lit(0.0).alias("__lang_score"),
        F.lit(None).cast("bigint").alias("__lang_margin"),
        F.lit(None).cast("bigint").alias("__lang_size"),
        F.lit(True).alias("__lang_rejected"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coders, leads, spent = [], [], []
        for lang in langs:
            content = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(level=level, dict_data=content, write_content_size=False))
            leads.append(dictionaries[lang][:LEAD_BYTES])
            spent.append(len(coders[-1].compress(leads[-1])))
        for batch in few_rows(batches):
            pred, score, margin, size, rejected = [], [], [], [], []
            for text in batch.column("__lang_bytes").to_pylist():
                if text is None or not coders:
                    pred.append(UNKNOWN), score.append(0.0), margin.append(None), size.append(None), rejected.append(True)
                    continue
                sizes = [len(c.compress(lead + text)) - s for c, lead, s in zip(coders, leads, spent)]
                best = min(sizes)
                first = sizes.index(best)
                second = min((s for i, s in enumerate(sizes) if i != first), default=None)
                pred.append(langs[first])
                score.append(1.0 / sum(2.0 ** max(best - s, -1000) for s in sizes))
                margin.append(None if second is None else second - best)
                size.append(best)
                rejected.append(second is not None and second - best < max(min_margin, min_share * best))
            arrays = [*batch.drop_columns(["__lang_bytes"]).columns]
            arrays += [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(margin, pa.int64()), pa.array(size, pa.int64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    text = col(text_col)
    encoded = F.when(text.rlike(HAS_LETTER), letters(text).cast("binary")).alias("__lang_bytes")
    return docs.select("*", encoded).mapInArrow(tidy(run), schema)


def margin_share(
    labelled: DataFrame, dictionaries: dict[str, bytes], text_col: str = "text", lang_col: str = "lang",
    max_rows: int = MARGIN_ROWS, lost: float = LOST_SHARE, level: int = LEVEL,
) -> float:
    """The margin, as a share of the output size, that rejects at most ``lost`` of the
    rightly predicted ones among ``labelled`` rows that the dictionaries have not seen;
    never more than ``MIN_SHARE``.

    Every row with a language and a letter is predicted and counts, repeated ones each. The counts of
    equal shares are added up on the driver if there are at most ``max_rows`` of them, otherwise
    by ranges on the executors; the result is the same. Fewer than ``LEAST_ROWS`` rightly predicted rows: ``MIN_SHARE``.
    """
    rows = narrow(labelled, text=text_col, lang=lang_col).where(F.col("lang").isNotNull() & F.col("text").rlike(HAS_LETTER))
    found = predict_languages(rows, dictionaries, text_col="text", level=level).where("__lang_pred = lang AND __lang_margin IS NOT NULL")
    share = F.col("__lang_margin") / F.greatest(F.col("__lang_size"), F.lit(1))
    # among shares well over MIN_SHARE the order does not matter
    counted = found.groupBy(F.least(share, F.lit(2 * MIN_SHARE)).alias("share")).agg(F.count("*").alias("rows"))
    counted = write_scratch(counted, "margin-shares")
    shares, number = counted.agg(F.count("*"), F.coalesce(F.sum("rows"), F.lit(0))).first()
    if number < LEAST_ROWS:
        return MIN_SHARE
    place = int(lost * number)
    if shares <= max_rows:
        ranked = sorted(counted.collect())
        ends = accumulate(r["rows"] for r in ranked)
        at = next(r["share"] for r, end in zip(ranked, ends) if end > place)
    else:
        ranked = running_total(counted, [F.col("share")], F.col("rows"))
        at = ranked.where(F.col("before") <= place).agg(F.max("share")).first()[0]
    return min(MIN_SHARE, at * (1 - 1e-9))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    dictionaries = learn_dictionaries(docs.where(~held_out))
    slim = docs.select("doc_id", "text")
    # only the id and the text reach the tasks, and only the text is looked at
    predicted = predict_languages(slim, dictionaries)
    return predicted.select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("__lang_pred").alias("lang_pred"),
        F.col("__lang_score").alias("score"),
        F.col("__lang_margin").alias("margin"),
        F.col("__lang_rejected").alias("rejected"),
    )
