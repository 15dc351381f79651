"""Token counts by the whole-token shortcut (operator 12).

A byte-level BPE splits a text into pre-tokens and merges the bytes of each.
Most pre-tokens are vocabulary strings. Which of these encode alone as one token
is proved once on the driver, with the tokenizer itself; a pre-token among them counts one
without being merged. Only the others are merged, and what they count is
kept for the next time.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import narrow, table
from epipanel.llm.words import few_rows

LIMIT = 512
KEPT_PIECES = 1 << 18  # merged pre-tokens kept by a task; beyond it the kept ones are forgotten
KEPT_LENGTH = 64  # characters: longer pre-tokens are merged each time
LONG_PIECE = 2000  # characters: merging a longer pre-token pair by pair is left to the library
PROVED_AT_ONCE = 4096

# Fixed value: how byte-level BPE writes a byte as a character. Printable bytes stand for
# themselves, the others for the code points from 256 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_CHARACTERS = {b: b for b in _PRINTABLE} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTABLE))}
_BYTES = {chr(c): b for b, c in _CHARACTERS.items()}


def _spelt(piece: str) -> str:
    """The piece's bytes as the characters that stand for them."""
    return piece.encode().decode("latin-1").translate(_CHARACTERS)


def _load(tokenizer_path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path)


def whole_tokens(tokenizer_path: str) -> list[str]:
    """The vocabulary strings that the tokenizer encodes alone as one token.

    Those whose bytes are no UTF-8 are no texts and are left out, as are
    special tokens. At most the vocabulary: a bound that does not grow with the data.
    """
    tokenizer = _load(tokenizer_path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    texts = []
    for token in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(_BYTES[c] for c in token).decode())
        except (KeyError, UnicodeDecodeError):
            continue
    texts = sorted(set(texts) - special - {""})
    whole = []
    for at in range(0, len(texts), PROVED_AT_ONCE):
        part = texts[at : at + PROVED_AT_ONCE]
        encoded = tokenizer.encode_batch(part, add_special_tokens=False)
        whole += [t for t, e in zip(part, encoded) if len(e.ids) == 1 and e.offsets == [(0, len(t))]]
    return whole


class _Costs(dict):
    """Tokens of each pre-token: 1 for whole tokens, merged on demand for others."""

    def __init__(self, whole: list[str], tokenizer) -> None:
        super().__init__(dict.fromkeys(whole, 1))
        self.tokenizer, self.room = tokenizer, KEPT_PIECES
        self.merged: list[str] = []

    def __missing__(self, piece: str) -> int:
        # model.tokenize merges the characters that stand for the piece's bytes, without splitting again
        n = len(self.tokenizer.model.tokenize(_spelt(piece)))
        if len(piece) <= KEPT_LENGTH:
            if len(self.merged) >= self.room:
                for old in self.merged:
                    del self[old]
                self.merged.clear()
            self.merged.append(piece)
            self[piece] = n
        return n


class TokenCounter:
    """``count(text)``: how many tokens the tokenizer file gives for a text.

    ``pattern`` is the file's pre-token pattern. Texts with a special token are
    split around it as the library does, each occurrence counting one. Texts with a character that
    ``regex`` and the tokenizer class differently (their Unicode versions may
    differ), or with a very long pre-token, are counted by the library itself.
    Whether they class a character alike is looked up once for each character met.
    """

    def __init__(self, tokenizer_path: str, pattern: str, whole: list[str] | None = None) -> None:
        self.tokenizer = _load(tokenizer_path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        # a special token that also takes the white space beside it is left to the library
        self.plain_specials = not any(t.lstrip or t.rstrip or t.single_word for t in added)
        self.at_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.pieces = regex.compile(pattern)
        self.alike: set[str] = set()
        self.unlike: set[str] = set()
        self.long = regex.compile(rf"\p{{L}}{{{LONG_PIECE}}}|\p{{N}}{{{LONG_PIECE}}}|\s{{{LONG_PIECE}}}|[^\s\p{{L}}\p{{N}}]{{{LONG_PIECE}}}")
        self.costs = _Costs(whole_tokens(tokenizer_path) if whole is None else whole, self.tokenizer)

    def count(self, text: str) -> int:
        if not self._classed_alike(text) or (len(text) >= LONG_PIECE and self.long.search(text)):
            return self.by_library(text)
        if not any(s in text for s in self.special):
            return sum(map(self.costs.__getitem__, self._split(text)))
        if not self.plain_specials:
            return self.by_library(text)
        parts = self.at_special.split(text)
        return len(parts) - 1 + sum(self.costs[p] for part in parts for p in self._split(part))

    def by_library(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _classed_alike(self, text: str) -> bool:
        if text.isascii():
            return True
        for c in set(text) - self.alike:
            if c not in self.unlike:
                # beside a letter, a digit, a sign, itself and spaces: another class splits otherwise
                sample = f"a{c}1{c}.{c}{c} {c} {c}b"
                theirs = [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(sample)]
                ours = [_spelt(piece) for piece in self.pieces.findall(sample)]
                (self.alike if theirs == ours else self.unlike).add(c)
        return not self.unlike or self.unlike.isdisjoint(text)

    def _split(self, text: str) -> Iterator[str]:
        if len(text) < 1 << 16:
            return self.pieces.findall(text)
        return (m[0] for m in self.pieces.finditer(text))


def count_tokens(
    docs: DataFrame, tokenizer_path: str, pattern: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    * null and empty texts: 0 bytes, 0 tokens; an empty table gives no rows;
    * repeated rows and null ids are counted like others; other columns are
      ignored, whatever their names;
    * texts are whole, whatever their length.

    No shuffle: each text is counted where it is read. The proved whole tokens
    (at most the vocabulary) are broadcast once.
    """
    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("ident"), F.coalesce("text", F.lit("")).alias("text")
    )
    proved = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(tokenizer_path, pattern, proved.value)
        for batch in few_rows(batches):
            counts = [counter.count(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("ident"), batch.column("n_bytes"), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
            )

    sized = rows.select("ident", "text", F.octet_length("text").cast("bigint").alias("n_bytes"))
    counted = sized.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
