"""Place names that are spelt in other ways: exact, alias and similar matches.

Names are compared within their country (or any other columns): first as they
are, then without case, accents and punctuation, then through an alias table, and
at last by similarity. Similar names are found by a q-gram prefix join: two names
within ``k`` edits share one of their ``2k + 1`` rarest pairs of letters, so an
equi-join on those gives every candidate; the edit distance is then checked.
Nothing is dropped: a name with several best candidates is reported as
ambiguous with all of them, one with none as unmatched.

Only distinct names are compared. No cross join: candidates meet on a rare pair
of letters within one country.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.plans.joins import null_safe

PAIR = 2  # letters of a gram
# (letters of the shorter normal name, edits it may differ by)
ALLOWANCE = ((8, 2), (4, 1))


def _accents() -> tuple[str, str]:
    """Latin letters with a mark, and the plain letters they are made from."""
    found = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    found = [(a, b) for a, b in found if b.isascii() and b.isalpha()]
    return "".join(a for a, _ in found), "".join(b for _, b in found)


def normal_name(name: Column) -> Column:
    """The name in lower case without accents, everything but letters and
    digits as one space. Null stays null."""
    plain = F.lower(F.translate(name, *_accents()))
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}]+", " "))


def allowance(normal: Column) -> Column:
    """Edits a name may differ by: fewer for short names, none below four letters."""
    out = F.lit(0)
    for letters, edits in reversed(ALLOWANCE):
        out = F.when(F.length(normal) >= letters, edits).otherwise(out)
    return out


def _grams(normal: Column) -> Column:
    """Pairs of neighbouring letters (the ends padded), equal ones numbered, as
    the bound on edits counts each occurrence."""
    padded = F.concat(F.lit("\u0001"), normal, F.lit("\u0001"))
    pairs = F.transform(F.sequence(F.lit(1), F.length(normal) + 1), lambda i: F.substring(padded, i, F.lit(PAIR)))
    return F.transform(
        pairs, lambda g, i: F.concat(g, F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda before: before == g)).cast("string"))
    )


def match_names(
    names: DataFrame, reference: DataFrame, name_col: str, within: str | Sequence[str] = (), aliases: DataFrame | None = None
) -> DataFrame:
    """One row per distinct name of ``names``: ``within..., name, match, how,
    edits, candidates``.

    ``reference`` has ``within..., name_col`` of the right names; ``aliases`` (optional)
    has ``within..., alias, name_col``. ``how`` is, in this order of preference,

    * ``exact``: the very name; ``normal``: the same but for case, accents and punctuation;
    * ``alias``: an alias (compared in the same normal form);
    * ``similar``: the least number of edits, within the allowance of the shorter name;
    * ``ambiguous``: several right names are equally good (``match`` is null);
    * ``none``: no candidate (``match`` and ``edits`` are null, no candidates).

    ``candidates`` lists the equally good names in order. Null names give one
    unmatched row; a null in ``within`` is a group of its own. Repeated rows
    count once; an empty reference matches nothing; other columns are ignored.
    """
    keys = as_list(within)
    w = [f"_w{i}" for i in range(len(keys))]

    def slim(df: DataFrame, *cols: str) -> DataFrame:
        quoted = ["`" + c.replace("`", "``") + "`" for c in [*keys, *cols]]
        out = df.select(*[F.col(c) for c in quoted]).toDF(*w, *[f"_{i}" for i in range(len(cols))])
        return out.distinct()

    asked = slim(names, name_col).withColumnRenamed("_0", "_name").withColumn("_normal", normal_name(F.col("_name")))
    right = slim(reference, name_col).withColumnRenamed("_0", "_right").where("_right IS NOT NULL")
    right = right.withColumn("_rnormal", normal_name(F.col("_right")))
    rw = [f"{c}r" for c in w]
    right = right.toDF(*rw, "_right", "_rnormal")
    same = null_safe(w, rw)

    def candidate(rows: DataFrame, order: Column, edits: Column) -> DataFrame:
        return rows.select(*w, "_name", order.alias("_order"), edits.cast("int").alias("_edits"), F.col("_right"))

    zero = F.lit(0)
    equal = asked.join(right, same & (F.col("_normal") == F.col("_rnormal")))
    found = candidate(equal, F.when(F.col("_name") == F.col("_right"), 0).otherwise(1), zero)
    if aliases is not None:
        known = slim(aliases, "alias", name_col).toDF(*rw, "_alias", "_right").withColumn("_rnormal", normal_name(F.col("_alias")))
        by_alias = asked.join(known, same & (F.col("_normal") == F.col("_rnormal")))
        found = found.unionAll(candidate(by_alias, F.lit(2), zero))
    # only names without an equal one are compared by similarity
    settled = found.select(*[F.col(c).alias(f"{c}s") for c in w], F.col("_name").alias("_settled")).distinct()
    open_ = asked.where("_name IS NOT NULL").join(settled, null_safe([*w, "_name"], [*[f"{c}s" for c in w], "_settled"]), "left_anti")
    near = _similar(open_, right, w, rw)
    found = found.unionAll(candidate(near, F.lit(3), F.col("_edits")))

    per_grade = found.groupBy(*w, "_name", "_order", "_edits").agg(F.sort_array(F.collect_set("_right")).alias("_all"))
    best = per_grade.groupBy(*w, "_name").agg(F.min_by("_all", F.struct("_order", "_edits")).alias("candidates"), F.min(F.struct("_order", "_edits")).alias("_grade"))
    best = best.toDF(*[f"{c}b" for c in w], "_bname", "candidates", "_grade")
    joined = asked.join(best, null_safe([*w, "_name"], [*[f"{c}b" for c in w], "_bname"]), "left")
    several = F.size("candidates") > 1
    how = F.when(F.col("candidates").isNull(), "none").when(several, "ambiguous").otherwise(
        F.element_at(F.array(*[F.lit(x) for x in ("exact", "normal", "alias", "similar")]), F.col("_grade._order") + 1)
    )
    return joined.select(
        *[F.col(a).alias(b) for a, b in zip(w, keys)],
        F.col("_name").alias("name"),
        F.when(F.size("candidates") == 1, F.get("candidates", F.lit(0))).alias("match"),
        how.alias("how"),
        F.col("_grade._edits").alias("edits"),
        F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"),
    )


def _similar(asked: DataFrame, right: DataFrame, w: list[str], rw: list[str]) -> DataFrame:
    """Pairs of names within the allowance, and their edit distance."""
    left = asked.select(*w, "_name", "_normal").withColumn("_allow", allowance(F.col("_normal"))).where("_allow > 0")
    other = right.withColumn("_rallow", allowance(F.col("_rnormal"))).where("_rallow > 0")
    left_grams = left.select("*", F.explode(_grams(F.col("_normal"))).alias("_gram"))
    right_grams = other.select("*", F.explode(_grams(F.col("_rnormal"))).alias("_rgram"))
    # rare pairs first: the order is free, as long as both sides use the same
    usual = left_grams.select("_gram").unionAll(right_grams.select(F.col("_rgram").alias("_gram"))).groupBy("_gram").agg(F.count("*").alias("_usual"))

    def rarest(grams: DataFrame, gram: str, by: list[str], allow: str) -> DataFrame:
        counted = grams.join(usual.withColumnRenamed("_gram", "_of"), F.col(gram) == F.col("_of"))
        place = F.row_number().over(Window.partitionBy(*by).orderBy("_usual", gram))
        return counted.withColumn("_place", place).where(F.col("_place") <= F.col(allow) * PAIR + 1).drop("_place", "_usual", "_of")

    a = rarest(left_grams, "_gram", [*w, "_name"], "_allow")
    b = rarest(right_grams, "_rgram", [*rw, "_right"], "_rallow")
    limit = F.least("_allow", "_rallow")
    pairs = a.join(b, null_safe(w, rw) & (F.col("_gram") == F.col("_rgram")) & (F.abs(F.length("_normal") - F.length("_rnormal")) <= limit))
    pairs = pairs.select(*w, "_name", "_normal", "_right", "_rnormal", limit.alias("_limit")).distinct()
    checked = pairs.withColumn("_edits", F.levenshtein("_normal", "_rnormal", max(k for _, k in ALLOWANCE)))
    return checked.where((F.col("_edits") >= 0) & (F.col("_edits") <= F.col("_limit")))


def match_places(
    names: DataFrame, reference: DataFrame, aliases: DataFrame | None = None, country_aliases: DataFrame | None = None,
    country: str = "country", state: str = "state",
) -> DataFrame:
    """States of any country: the country's name is matched first, then the
    state's within the right country.

    ``reference`` has the right ``country, state`` pairs, ``aliases`` has ``country, alias, state``,
    ``country_aliases`` has ``alias, country``. One row per distinct pair of ``names``: ``country, state,
    country_match, country_how, state_match, state_how, edits, candidates``. Where
    the country has no single match the state is not looked for (``none``).
    """
    pairs = names.select(F.col(country).alias("country"), F.col(state).alias("state")).distinct()
    known = reference.select(F.col(country).alias("country"), F.col(state).alias("state")).distinct()
    countries = match_names(pairs, known, "country", aliases=country_aliases)
    countries = countries.select(F.col("name").alias("_name"), F.col("match").alias("country_match"), F.col("how").alias("country_how"))
    placed = pairs.join(countries, F.col("country").eqNullSafe(F.col("_name"))).drop("_name")
    asked = placed.where("country_match IS NOT NULL").select(F.col("country_match").alias("country"), "state")
    states = match_names(asked, known, "state", "country", aliases)
    states = states.select(
        F.col("country").alias("_country"), F.col("name").alias("_state"), F.col("match").alias("state_match"), F.col("how").alias("state_how"), "edits", "candidates"
    )
    same = (F.col("country_match") == F.col("_country")) & F.col("state").eqNullSafe(F.col("_state"))
    return placed.join(states, same, "left").select(
        "country", "state", "country_match", "country_how", "state_match", F.coalesce("state_how", F.lit("none")).alias("state_how"), "edits",
        F.coalesce("candidates", F.array().cast("array<string>")).alias("candidates"),
    )


def rename_matched(df: DataFrame, matches: DataFrame, name_col: str, within: str | Sequence[str] = (), match_col: str = "match") -> DataFrame:
    """``df`` with ``match_col`` (the right name, null where ambiguous or
    unmatched) of :func:`match_names` added. Every row stays."""
    if match_col in df.columns:
        raise ValueError(f"{match_col!r} is a column already")
    keys = as_list(within)
    names = [f"_m{i}" for i in range(len(keys) + 1)]
    table = matches.select(*[F.col("`" + k.replace("`", "``") + "`") for k in keys], "name", "match").toDF(*names, match_col)
    return df.join(table, null_safe([*keys, name_col], names), "left").drop(*names)
