"""Exact deduplication with Patricia-trie owners (operator 10).

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is
replaced by one space. Rows are dealt by (length, content hash); inside a
partition the full byte strings are inserted into compressed radix tries whose
terminal nodes keep the smallest identifier and the number of rows. The trie,
not the hash, decides equality (rows are then matched with their owner by the
SHA-256 that the result carries anyway).

Copies are folded twice: each input task first builds a trie of its own rows,
so a text held by a third of all rows reaches its owner as one entry per input
task; the owner then merges the entries. A trie that outgrows its byte budget
is spilled by subtree (one temporary file per leading bytes) and the subtrees are
finished one after the other, so memory is bounded at any partition size.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import col, fresh, narrow, table, tidy
from epipanel.llm.words import few_rows

TRIE_BYTES = 96 * 1024 * 1024  # text bytes of one trie before it spills
ROWS_PER_BATCH = 2_000
BYTES_PER_BATCH = 8 * 1024 * 1024


class RadixTrie:
    """A compressed trie over byte strings. Each edge holds the bytes between
    two branchings; a terminal node holds ``[smallest id, its rows, all rows]``."""

    __slots__ = ("root", "nbytes")

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]  # label, children by first byte, terminal
        self.nbytes = 0

    def insert(self, key: bytes, ident: int | None, ident_rows: int, rows: int) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                leaf = [key[at:], {}, None]
                node[1][key[at]] = leaf
                self.nbytes += len(key) - at + 200
                node, at = leaf, len(key)
                break
            label = child[0]
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            cut = _common(label, key, at)
            inner = [label[:cut], {label[cut]: child}, None]
            child[0] = label[cut:]
            node[1][key[at]] = inner
            self.nbytes += 200
            node, at = inner, at + cut
        node[2] = merge_owner(node[2], ident, ident_rows, rows)

    def terminals(self) -> Iterator[tuple[bytes, list]]:
        stack = [(b"", self.root)]
        while stack:
            prefix, node = stack.pop()
            key = prefix + node[0]
            if node[2] is not None:
                yield key, node[2]
            stack.extend((key, child) for child in node[1].values())


def _common(label: bytes, key: bytes, at: int) -> int:
    """How many leading bytes ``label`` shares with ``key`` from ``at``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if key.startswith(label[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def merge_owner(owner: list | None, ident: int | None, ident_rows: int, rows: int) -> list:
    """Null ids lose against any id."""
    if owner is None:
        return [ident, ident_rows, rows]
    owner[2] += rows
    if ident == owner[0]:
        owner[1] += ident_rows
    elif ident is not None and (owner[0] is None or ident < owner[0]):
        owner[0], owner[1] = ident, ident_rows
    return owner


class SpillingOwners:
    """Owners of any number of texts in bounded memory.

    Beyond ``budget`` bytes the trie is cut at its first branching: its entries
    are appended to one temporary file for each subtree there (told by the byte
    at that depth), as are all later entries when memory fills again. Each file
    is then finished by a trie of its own, which may spill in turn. A single
    text larger than the budget has no branching and stays."""

    def __init__(self, budget: int) -> None:
        self.budget = budget
        self.trie = RadixTrie()
        self.depth = 0
        self.folder: str | None = None

    def add(self, key: bytes, ident: int | None, ident_rows: int, rows: int) -> None:
        self.trie.insert(key, ident, ident_rows, rows)
        if self.trie.nbytes > self.budget:
            self._spill()

    def _branching(self) -> int | None:
        """The depth of the first node where strings part or one ends."""
        node, depth = self.trie.root, 0
        while len(node[1]) == 1 and node[2] is None:
            (node,) = node[1].values()
            depth += len(node[0])
        return depth if node[1] else None

    def _spill(self) -> None:
        if self.folder is None:
            depth = self._branching()
            if depth is None:
                return
            self.depth, self.folder = depth, tempfile.mkdtemp(prefix="trie-")
        for key, owner in self.trie.terminals():
            ident = "" if owner[0] is None else str(owner[0])
            head = f"{len(key)} {owner[1]} {owner[2]} {ident}\n".encode()
            subtree = f"{key[self.depth]:02x}" if len(key) > self.depth else "ended"
            with open(os.path.join(self.folder, subtree), "ab") as file:
                file.write(head + key)
        self.trie = RadixTrie()

    def results(self) -> Iterator[tuple[bytes, list]]:
        if self.folder is None:
            yield from self.trie.terminals()
            return
        self._spill()
        try:
            for name in sorted(os.listdir(self.folder)):
                inner = SpillingOwners(self.budget)
                path = os.path.join(self.folder, name)
                with open(path, "rb") as file:
                    while head := file.readline():
                        size, ident_rows, rows, ident = head.rstrip(b"\n").split(b" ")
                        inner.add(file.read(int(size)), int(ident) if ident else None, int(ident_rows), int(rows))
                os.remove(path)
                yield from inner.results()
        finally:
            shutil.rmtree(self.folder, ignore_errors=True)


_OWNER_SCHEMA = "sha binary, body binary, ident bigint, ident_rows bigint, n_rows bigint"


def _fold(merge: bool, budget: int):
    """A mapInArrow function: the owners of a task's rows. ``merge``: rows are
    owners of other tasks already, and the texts are not passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners = SpillingOwners(budget)
        for batch in few_rows(batches):
            cells = batch.to_pydict()
            ones = [1] * batch.num_rows
            counts = zip(cells["ident_rows"], cells["n_rows"]) if merge else zip(ones, ones)
            for body, sha, ident, (ident_rows, n_rows) in zip(cells["body"], cells["sha"], cells["ident"], counts):
                # the trie's key is the whole text; the digest follows it so that
                # it need not be computed again when a terminal node is emitted
                owners.add(body + sha, ident, ident_rows, n_rows)
        rows: list[tuple] = []
        size = 0
        for key, (ident, ident_rows, n_rows) in owners.results():
            body = None if merge else key[:-32]
            rows.append((key[-32:], body, ident, ident_rows, n_rows))
            size += 64 + len(body or b"")
            if len(rows) >= ROWS_PER_BATCH or size >= BYTES_PER_BATCH:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    sha, body, ident, ident_rows, n_rows = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(sha, pa.binary()),
            pa.array(body, pa.binary()),
            pa.array(ident, pa.int64()),
            pa.array(ident_rows, pa.int64()),
            pa.array(n_rows, pa.int64()),
        ],
        names=["sha", "body", "ident", "ident_rows", "n_rows"],
    )


def normalised(text):
    """Each run of white space as one space; null counts as empty. A single
    space already is its own replacement, so only other runs are matched."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]", " ")


def exact_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256, copies`` (rows with the same id and text), in no order.

    * null text: the empty text; empty texts are equal to each other;
    * null id: never the smallest while its group has another id; a group of
      null ids only has a null ``keep_id`` and keeps one row;
    * rows repeated with the same id and equal texts: one of them is kept;
    * an empty table gives no rows; other columns are ignored, whatever their names.
    """
    body = normalised(F.col("text"))
    texts = narrow(docs, ident=id_col, text=text_col).select(F.col("ident").cast("bigint").alias("ident"), body.alias("body"))
    keyed = texts.select("ident", F.unhex(F.sha2("body", 256)).alias("sha"), F.col("body").cast("binary").alias("body"))
    local = keyed.mapInArrow(tidy(_fold(False, budget)), _OWNER_SCHEMA)
    dealt = local.repartition(F.octet_length("body"), F.xxhash64("body"))
    owners = dealt.mapInArrow(tidy(_fold(True, budget)), _OWNER_SCHEMA).select(
        "sha", F.col("ident").alias("keep_id"), F.col("n_rows").alias("group_size")
    )
    # rows that repeat both id and text are counted once here and dealt out again below
    rows = keyed.groupBy("ident", "sha").agg(F.count("*").cast("int").alias("copies"))
    joined = rows.join(owners, "sha").select("*", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return joined.select(
        F.col("ident").alias("doc_id"),
        "keep_id",
        "group_size",
        (F.col("ident").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        F.col("copies").cast("bigint").alias("copies"),
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were. Of rows that
    repeat both the owner's id and its text one stays."""
    sha, keep_id, keep_sha, many = fresh(docs, "sha", "keep_id", "keep_sha", "many")
    owners = exact_owners(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias(keep_id), F.unhex("text_sha256").alias(keep_sha), (F.col("copies") > 1).alias(many)
    )
    keyed = docs.withColumn(sha, F.unhex(F.sha2(normalised(col(text_col)), 256)))
    joined = keyed.join(owners, (F.col(sha) == F.col(keep_sha)) & col(id_col).eqNullSafe(F.col(keep_id)))
    single = joined.where(~F.col(many))
    several = joined.where(F.col(many)).dropDuplicates([keep_id, keep_sha])
    return single.unionAll(several).select(*[col(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_owners(table(spark, sf_dir, "documents")).drop("copies")


ORACLE_SQL = r"""
WITH normalised AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), owned AS (
  SELECT doc_id, body, min(doc_id) OVER (PARTITION BY body) AS keep_id,
         count(*) OVER (PARTITION BY body) AS group_size,
         row_number() OVER (PARTITION BY body ORDER BY doc_id NULLS LAST) AS place
  FROM normalised
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM owned
"""
