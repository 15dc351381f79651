r"""Spelling variants by a relational trie frontier (operator 13).

The words' trie is a table of edges: a node is the hash of the letters that
lead to it, an edge carries the next letters. States ``(word, position, node,
edits)`` walk down it level by level. Without an edit a word stands at its own
nodes: at each level it is joined with all edges there, and those that
differ by a letter (inserted, deleted or replaced) take it on with one edit. From then on only the
edge with the word's next letters leads on, a join by node and letters. Where
another word ends with it, that is a neighbour.

* A pair one edit apart shares its first or its last half. So there are two
  tries, of the words and of the reversed words, and a state starts at the node of
  its own first half: the crowded top of either trie is never fanned out.
* Edges leading on carry the lengths and next letters found below them, as bit masks.
  A state that has used its edit knows the length and the next letter it
  needs, and is dropped where the mask has none.
* Edges hold one letter down to ``FINE`` letters and more further down (a
  quarter of the depth), so that very long words need few levels.

Node hashes only gather candidates: every neighbour is verified on the words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import LOWER, UPPER, narrow, table
from epipanel.llm.crc_sql import crc_of, crc_table
from epipanel.session import shared_scratch_path, write_scratch

BETWEEN_RUNS = "[^a-zÀ-ÿ]+"  # A-Z are lower-cased before; a class of three ranges takes twenty times as long
TYPO_EVERY = 97
MIN_LETTERS = 5
MIN_COUNT = 3
FACTOR = 2
FINE = 12


def boundaries(longest: int) -> list[int]:
    """Depths at which the tries have nodes, up to the longest word."""
    out = [0]
    while out[-1] < longest:
        out.append(out[-1] + max(1, out[-1] // 4 if out[-1] >= FINE else 1))
    return out


def corpus_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n``: the letter runs of all texts, A-Z lower-cased, that have at
    least ``min_letters`` code points and occur at least ``min_count`` times.

    A run loses the letter number ``h % length`` where ``TYPO_EVERY`` divides ``h``, the crc32 of
    ``<doc_id>:<run>``: misspellings with a known origin. A null text has
    no runs, a null id counts as the text ``null``; repeated rows count each time.
    Occurrences are counted before the shuffle, so a word of any frequency is one row a task.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # lower() is right, and faster, for ASCII texts
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    texts = narrow(docs, ident=id_col, text=text_col).select(F.coalesce(F.col("ident").cast("string"), F.lit("null")).alias("ident"), lowered.alias("text"))
    runs = texts.select("ident", F.explode(F.split("text", BETWEEN_RUNS)).alias("run")).where(F.length("run") >= min_letters)
    h = F.crc32(F.concat("ident", F.lit(":"), "run").cast("binary"))
    cut = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), cut), F.substring(F.col("run"), cut + 2, F.length("run")))
    words = runs.select("run", h.alias("h")).select(F.when(F.col("h") % TYPO_EVERY == 0, shorter).otherwise(F.col("run")).alias("word"))
    counted = words.where(F.length("word") >= min_letters).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def near_words(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: every pair of words of ``words`` (``word, n``)
    that differ by exactly one inserted, deleted or replaced code point, both ways round.

    ``words`` has distinct words; null and empty ones have no neighbours. An
    empty table gives no rows. One job a level; states and edges are
    written to the shared checkpoint folder. No group is held in a task:
    a node is met by the words through it and left by at most one edge a letter.
    """
    spark = words.sparkSession
    words = write_scratch(words.where(F.length("word") > 0).select("word", F.col("n").cast("bigint").alias("n")), "words")
    longest = words.agg(F.max(F.length("word"))).first()[0] or 0
    if not longest:
        return spark.createDataFrame([], "word string, near string, near_n bigint")
    depths = boundaries(longest)
    grid = F.array(*[F.lit(b) for b in depths])

    both = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("back"))
    spelt = both.select("word", "n", "back", F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word")).alias("s"))
    spelt = spelt.withColumn("size", F.length("s"))
    node = lambda depth: F.xxhash64(F.col("back"), F.substring(F.col("s"), F.lit(1), depth))
    # the deepest boundary within the first half, and before the end of any neighbour
    half = lambda size: F.array_max(F.filter(grid, lambda b: (b == 0) | ((b * 2 <= size) & (b < size - 1))))

    # the last edge of a word ends it, the ones before lead on; only those a state can reach are kept
    at = F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(depths) - 2)), lambda i: (F.get(grid, i) >= half(F.col("size") - 1)) & (F.get(grid, i) < F.col("size"))))
    steps = spelt.select("*", at.alias("level")).select("*", F.get(grid, F.col("level")).alias("depth"), F.get(grid, F.col("level") + 1).alias("below"))
    label = F.substring(F.col("s"), F.col("depth") + 1, F.col("below") - F.col("depth"))
    steps = steps.select("*", node(F.col("depth")).alias("node"), label.alias("label"))
    ends = steps.where("below >= size").select("level", "node", "label", F.lit(None).cast("bigint").alias("child"), F.lit(None).cast("bigint").alias("sizes"), F.lit(None).cast("bigint").alias("nexts"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    bit = lambda c: F.expr(f"shiftleft(1L, cast({c} % 64 as int))")
    inner = steps.where("below < size").select(
        "level", "node", "label", node(F.col("below")).alias("child"), bit("size").alias("size_bit"), bit("ascii(substring(s, below + 1, 1))").alias("next_bit")
    )
    inner = inner.groupBy("level", "node", "label", "child").agg(F.bit_or("size_bit").alias("sizes"), F.bit_or("next_bit").alias("nexts"))
    inner = inner.select("*", F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    edges_path = shared_scratch_path(spark, "trie-edges")
    edges = ends.unionByName(inner)
    edges.write.partitionBy("level").parquet(edges_path)
    edges = spark.read.schema(edges.schema).parquet(edges_path)

    state = "word string, back boolean, position int, node bigint"
    frontier = spark.createDataFrame([], state)
    matches = []
    for level, (depth, below) in enumerate(zip(depths[:-1], depths[1:])):
        here = edges.where(F.col("level") == level)
        unedited = spelt.where((half(F.col("size")) <= depth) & (F.col("size") >= depth)).select("word", "back", "s", "size", node(F.lit(depth)).alias("node"))
        walked = write_scratch(_edit(unedited, here, depth, below).unionByName(_follow(frontier, here, depth, below)), f"trie-{level}")
        matches.append(walked.where("near IS NOT NULL").select("word", "near", "near_n"))
        frontier = walked.where("near IS NULL").select(*[c.split()[0] for c in state.split(", ")])
    found = matches[0]
    for part in matches[1:]:
        found = found.unionAll(part)
    # both tries may give a pair, and hashes only suggest one
    return found.dropDuplicates(["word", "near"]).where(F.levenshtein("word", "near", 1) == 1)


def _walked(rows: DataFrame, position: Column) -> DataFrame:
    """States after an edge, and neighbours (with ``near``)."""
    return rows.select("word", "back", position.cast("int").alias("position"), F.col("child").alias("node"), "near", "near_n")


def _needed(below: int) -> Column:
    """Whether below the edge there is a word of the length, and with the next letter, that
    a state at ``position`` of ``s`` with its edit used still needs."""
    length_ = F.getbit("sizes", F.expr(f"cast(pmod({below} + size - position, 64) as int)")) == 1
    letter = F.getbit("nexts", F.expr("cast(ascii(substring(s, position + 1, 1)) % 64 as int)")) == 1
    return (F.col("position") < F.col("size")) & length_ & letter


def _edit(states: DataFrame, edges: DataFrame, depth: int, below: int) -> DataFrame:
    """Words without an edit, at ``depth`` letters, over all edges that differ by one."""
    width = below - depth
    letter = lambda k: F.substring(F.col("s"), depth + 1 + k, 1)
    bit = lambda k: (F.ascii(letter(k)) % 64).cast("int").alias(f"bit{k}")
    mod = lambda k: F.pmod(F.col("size") + k, F.lit(64)).cast("int")
    if width == 1:
        states = states.select(
            "word", "back", "s", "size", "node", *[letter(k).alias(f"c{k}") for k in (0, 1)], *[bit(k) for k in (0, 1, 2)], mod(0).alias("same"), mod(1).alias("more"), mod(-1).alias("less")
        )
        pairs = states.join(edges, "node")
        label, size = F.col("label"), F.col("size")
        has = lambda mask, number: F.getbit(mask, F.col(number)) == 1
        replaced = (label != F.col("c0")) & has("sizes", "same") & (size > depth + 1) & has("nexts", "bit1")
        inserted = has("sizes", "more") & (size > depth) & has("nexts", "bit0")
        deleted = (label == F.col("c1")) & has("sizes", "less") & (size > depth + 2) & has("nexts", "bit2")
        ended = (size == depth) | ((size == depth + 1) & (label != F.col("c0"))) | ((size == depth + 2) & label.isin(F.col("c0"), F.col("c1")))
        pairs = pairs.where(F.when(F.col("near").isNotNull(), ended).otherwise(replaced | inserted | deleted))
        ways = F.array_compact(F.array(F.when(replaced, depth + 1), F.when(inserted, depth), F.when(deleted, depth + 2)))
        ways = F.when(F.col("near").isNotNull(), F.array(F.lit(depth))).otherwise(ways)
        return _walked(pairs.select("*", F.explode(ways).alias("position")), F.col("position"))
    pairs = states.join(edges, "node")
    ahead = lambda n: F.substring(F.col("s"), depth + 1, n)
    rest = F.substring(F.col("s"), F.lit(depth + 1), F.col("size"))
    ended = (F.abs(F.length(rest) - F.length("label")) <= 1) & (F.levenshtein(rest, F.col("label"), 1) == 1)
    ways = [F.when((F.col("size") >= below + k) & (F.levenshtein(ahead(width + k), F.col("label"), 1) == 1), below + k) for k in (-1, 0, 1)]
    ways = F.when(F.col("near").isNotNull(), F.when(ended, F.array(F.lit(depth)))).otherwise(F.array_compact(F.array(*ways)))
    taken = pairs.select("*", F.explode(ways).alias("position"))
    return _walked(taken.where(F.col("near").isNotNull() | _needed(below)), F.col("position"))


def _follow(states: DataFrame, edges: DataFrame, depth: int, below: int) -> DataFrame:
    """States that have used their edit, over the one edge with their next letters."""
    s = F.when(F.col("back"), F.reverse("word")).otherwise(F.col("word"))
    states = states.select("word", "back", F.col("position").alias("from"), "node", s.alias("s"))
    states = states.select(
        "word", "back", "from", "node", "s", F.length("s").alias("size"), F.substring(F.col("s"), F.col("from") + 1, F.lit(below - depth)).alias("label")
    )
    states = states.withColumn("ends", F.col("size") - F.col("from") <= below - depth)
    edges = edges.withColumn("ends", F.col("near").isNotNull())
    pairs = states.join(edges, ["node", "label", "ends"]).withColumn("position", F.col("from") + (below - depth))
    return _walked(pairs.where(F.col("near").isNotNull() | _needed(below)), F.col("position"))


def spelling_groups(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words`` (``word, n``).

    ``form`` is the commonest near word (ties: the first in code-point order) if it occurs at least
    ``factor`` (over 1) times as often, else null; ``root`` follows the forms to the last.
    """
    near = near_words(words)
    best = near.groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("near"))).alias("best")
    )
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.k")).alias("near_n"))
    known = words.select("word", F.col("n").cast("bigint").alias("n")).join(best, "word", "left")
    better = F.col("near_n") >= F.col("n") * factor
    rows = write_scratch(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("near")).alias("form"), F.when(better, F.col("near_n")).alias("form_n")
        ),
        "forms",
    )
    # pointer jumping: every round doubles how far each word sees
    roots = write_scratch(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        jumped = write_scratch(
            roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
        moved = jumped.where("moved").limit(1).count()
        roots = jumped.select("word", "root")
        if not moved:
            break
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(write_scratch(corpus_words(table(spark, sf_dir, "documents")), "corpus-words"))


ORACLE_SQL = rf"""
WITH RECURSIVE {crc_table()},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, 'null') AS ident,
         unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
  FROM documents
), counted AS MATERIALIZED (
  SELECT ident, run, count(*) AS n FROM runs WHERE length(run) >= {MIN_LETTERS} GROUP BY ALL
), hashed AS (
  SELECT run, n, {crc_of("ident || ':' || run")} AS h FROM counted, crc_table
), spelt AS (
  SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spelt WHERE length(word) >= {MIN_LETTERS} GROUP BY word HAVING sum(n) >= {MIN_COUNT}
), cuts AS MATERIALIZED (
  SELECT word, n, unnest(range(length(word))) AS place FROM words
), shorter AS MATERIALIZED (
  SELECT word, n, place, substr(word, 1, place) || substr(word, place + 2) AS cut FROM cuts
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM shorter a JOIN words b ON b.word = a.cut
  UNION SELECT a.cut, a.word, a.n FROM shorter a JOIN words b ON b.word = a.cut
  UNION SELECT a.word, b.word, b.n FROM shorter a JOIN shorter b ON a.cut = b.cut AND a.place = b.place AND a.word <> b.word
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near,
         row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) AS place
  FROM pairs
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {FACTOR} * w.n THEN near END AS form, CASE WHEN near_n >= {FACTOR} * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND place = 1
), chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next
)
SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
