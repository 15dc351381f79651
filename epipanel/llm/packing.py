"""Best-fit packing of token sequences (operator 8), in bulk-synchronous steps.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens;
pieces are packed into sequences of ``capacity`` tokens, longest first, each
into the smallest gap that holds it.

Pieces and gaps are sorted by size. Sizes are integers up to the capacity, so
either sorted list is held as runs of equal size: at most ``capacity`` of
them for any number of documents. One superstep takes all pieces of a size and
sweeps over the gaps from the successor of that size upward; each run of gaps
is matched with as many pieces as fit into it, first rank to first rank, so
no two pieces claim one place; the gaps are updated and the next smaller size
follows. The steps need only the number of pieces of each size. The ranks of
the rows are counted on the cluster (per stored partition and size, so a size that
a third of all pieces share is no bottleneck), and each row then finds its
sequence and offset from its rank alone.
"""

from __future__ import annotations

import base64
import os
import zlib
from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epipanel.llm.common import narrow, table, tidy
from epipanel.llm.words import few_rows
from epipanel.session import write_scratch

CAPACITY = 1024
END_ID = 2
LONG_RUN = 2000  # characters


class Encoder:
    """Ids of a byte-level BPE tokenizer file, special tokens in texts included.

    Where a file with the same vocabulary as ranks is given, ordinary texts go
    through it, which gives the same ids in a quarter of the time. Texts that hold a special
    token, or a run of characters so long that merging it pair by pair would
    take too long, always go through ``tokenizers``."""

    def __init__(self, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as file:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.ranks is None or any(s in text for s in self.special) or self._long_run(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.asarray(self.ranks.encode_to_numpy(text, disallowed_special=()), dtype="<u4")

    @staticmethod
    def _long_run(text: str) -> bool:
        if len(text) <= LONG_RUN:
            return False
        sizes = [len(w) for w in text.split()]
        return max(sizes, default=0) > LONG_RUN or len(text) - sum(sizes) - len(sizes) > LONG_RUN


def _pieces(tokenizer_path: str, ranks_path: str | None, pattern: str | None, end_id: int, capacity: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path, ranks_path, pattern)
        rows: list[tuple] = []
        size = 0
        for batch in few_rows(batches):
            for ident, text in zip(batch.column("ident").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encoder.ids(text), np.array([end_id], dtype="<u4"))
                cut = len(ids) % capacity or capacity
                for piece, (a, b) in enumerate(zip([0, *range(cut, len(ids), capacity)], range(cut, len(ids) + 1, capacity))):
                    part = ids[a:b]
                    rows.append((ident, piece, a, b - a, zlib.crc32(part.tobytes()), part.astype(np.int32) if with_ids else None))
                    size += b - a + 100 if with_ids else 100
                    if size >= 1_000_000:
                        yield _piece_batch(rows, with_ids)
                        rows, size = [], 0
        if rows:
            yield _piece_batch(rows, with_ids)

    return run


def _piece_batch(rows: list[tuple], with_ids: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
    arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
    return pa.RecordBatch.from_arrays(arrays[: 5 + with_ids], names=names[: 5 + with_ids])


def best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Places for ``counts[size]`` pieces of each size: rows of (size, first
    rank, pieces, first sequence, pieces per sequence, offset), and the number
    of sequences. Best fit, longest first; a superstep per size."""
    runs: dict[int, deque] = {}  # gap -> runs of (first sequence, number)
    gaps: list[int] = []  # sorted
    flows: list[tuple] = []
    sequences = 0

    def open_run(gap: int, first: int, number: int) -> None:
        if gap and number:
            if gap not in runs:
                insort(gaps, gap)
                runs[gap] = deque()
            runs[gap].append((first, number))

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        rank, left = 0, counts[size]

        def fill(first: int, number: int, gap: int) -> int:
            """Fill up to ``number`` gaps; the number that got pieces."""
            nonlocal rank, left
            per = gap // size
            full = min(number, left // per)
            if full:
                flows.append((size, rank, full * per, first, per, capacity - gap))
                rank, left = rank + full * per, left - full * per
                open_run(gap - per * size, first, full)
            if full < number and left:
                flows.append((size, rank, left, first + full, left, capacity - gap))
                open_run(gap - left * size, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            return full

        at = bisect_left(gaps, size)
        for gap in gaps[at:]:
            while left and runs[gap]:
                first, number = runs[gap].popleft()
                used = fill(first, number, gap)
                if used < number:
                    runs[gap].appendleft((first + used, number - used))
            if not left:
                break
        if left:
            new = -(-left // (capacity // size))
            first, sequences = sequences, sequences + new
            fill(first, new, capacity)
        for gap in [g for g in gaps if not runs[g]]:
            gaps.remove(gap)
            del runs[gap]
    return np.array(flows, dtype=np.int64).reshape(-1, 6), sequences


def _place(flows: np.ndarray):
    """Sequence and offset of each row from its size and rank."""
    order = np.lexsort((flows[:, 1], flows[:, 0]))
    flows = flows[order]
    sizes, firsts = np.unique(flows[:, 0], return_index=True) if len(flows) else (np.zeros(0, np.int64),) * 2
    bounds = dict(zip(sizes.tolist(), zip(firsts.tolist(), [*firsts[1:].tolist(), len(flows)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"))
            rank = np.asarray(batch.column("rank"))
            flow = np.zeros(len(length), dtype=np.int64)
            for size in np.unique(length).tolist():
                mine = length == size
                a, b = bounds[size]
                flow[mine] = a + np.searchsorted(flows[a:b, 1], rank[mine], side="right") - 1
            _, first_rank, _, first_sequence, per, offset = flows[flow].T
            step = rank - first_rank
            batch = batch.drop_columns(["rank"])
            arrays = [*batch.columns, pa.array(first_sequence + step // per), pa.array(offset + step % per * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "sequence_id", "offset"])

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, pattern: str | None = None,
    end_id: int = END_ID, capacity: int = CAPACITY, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset``.

    * null text: empty, that is, the end token alone;
    * only documents of more than ``capacity`` tokens are cut; the first piece takes the remainder;
    * repeated rows and null ids are packed like any others; an empty table
      gives no rows; other columns are ignored, whatever their names.

    Tokenises when called; the pieces are written to the shared checkpoint folder.
    """
    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("ident"), F.coalesce("text", F.lit("")).alias("text")
    )
    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    cut = rows.mapInArrow(tidy(_pieces(tokenizer_path, ranks_path, pattern, end_id, capacity, with_ids)), schema)
    pieces = write_scratch(cut.withColumn("part", F.spark_partition_id()), "pieces")

    sizes = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    counts = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    flows, _ = best_fit(counts, capacity)
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.row_number().over(within) - 1)
    ranked = ranked.select(*[c for c in pieces.columns if c != "part"], "rank")
    return ranked.mapInArrow(tidy(_place(flows)), schema + ", sequence_id bigint, offset bigint")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_public(table(spark, sf_dir, "documents"))


def pack_public(docs: DataFrame, with_ids: bool = False) -> DataFrame:
    """With the public byte-level tokenizer of 50,257 ids."""
    import public_tokenizers

    return pack_documents(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
        with_ids=with_ids,
    )
