"""Name matching against all pairs of names."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from epipanel.operators.names import allowance, match_names, match_places, normal_name, rename_matched

REFERENCE = [("US", "Washington"), ("US", "New York"), ("Canada", "Québec"), ("Canada", "British Columbia"), (None, "Cruise Ship")]


def table(spark, data, cols="country string, state string"):
    return spark.createDataFrame(data, cols)


def found(matches):
    return {(r["country"], r["name"]): (r["match"], r["how"], r["edits"], r["candidates"]) for r in matches.collect()}


def test_each_way_of_matching(spark):
    asked = [("US", "Washington"), ("US", " new  YORK."), ("US", "washingtn"), ("US", "N.Y."), ("Canada", "Quebec"), ("Canada", "Washington"),
             ("US", None), ("US", ""), (None, "cruise ships"), ("US", "Washington"), (None, None)]
    aliases = table(spark, [("US", "NY", "New York"), ("US", "n y", "New York")], "country string, alias string, state string")
    got = found(match_names(table(spark, asked), table(spark, REFERENCE), "state", "country", aliases))
    assert got == {
        ("US", "Washington"): ("Washington", "exact", 0, ["Washington"]),
        ("US", " new  YORK."): ("New York", "normal", 0, ["New York"]),
        ("US", "washingtn"): ("Washington", "similar", 1, ["Washington"]),
        ("US", "N.Y."): ("New York", "alias", 0, ["New York"]),
        ("Canada", "Quebec"): ("Québec", "normal", 0, ["Québec"]),
        ("Canada", "Washington"): (None, "none", None, []),
        ("US", None): (None, "none", None, []),
        ("US", ""): (None, "none", None, []),
        (None, "cruise ships"): ("Cruise Ship", "similar", 1, ["Cruise Ship"]),
        (None, None): (None, "none", None, []),
    }


def test_equally_good_names_are_reported(spark):
    reference = table(spark, [("x", "North Land"), ("x", "North Lane"), ("x", "Saint-Jean"), ("x", "Saint Jean")])
    got = found(match_names(table(spark, [("x", "North Lan"), ("x", "SAINT JEAN"), ("x", "Saint Jean")]), reference, "state", "country"))
    assert got[("x", "North Lan")] == (None, "ambiguous", 1, ["North Land", "North Lane"])
    assert got[("x", "SAINT JEAN")] == (None, "ambiguous", 0, ["Saint Jean", "Saint-Jean"])
    assert got[("x", "Saint Jean")] == ("Saint Jean", "exact", 0, ["Saint Jean"])


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_the_prefix_join_misses_no_similar_name(spark):
    rng = random.Random(5)
    words = lambda n: ["".join(rng.choices("aab", k=rng.randint(1, 12))) for _ in range(n)]
    reference, asked = sorted(set(words(150))), sorted(set(words(150)))
    got = found(match_names(table(spark, [("x", w) for w in asked]), table(spark, [("x", w) for w in reference]), "state", "country"))
    allow = lambda w: 2 if len(w) >= 8 else 1 if len(w) >= 4 else 0
    similar = 0
    for w in asked:
        near = [(distance(w, r), r) for r in reference if distance(w, r) <= min(allow(w), allow(r)) or w == r]
        best = sorted(r for d, r in near if d == min(near)[0]) if near else []
        assert got[("x", w)][3] == best, w
        similar += bool(near) and min(near)[0] > 0
    assert similar > 30


def test_states_of_other_countries(spark):
    asked = table(spark, [("Canda", "British Colombia"), ("Canada", "Quebec"), ("Atlantis", "Washington"), ("USA", "New York"), (None, "x")])
    countries = table(spark, [("USA", "US")], "alias string, country string")
    got = {(r["country"], r["state"]): r for r in match_places(asked, table(spark, REFERENCE), country_aliases=countries).collect()}
    assert (got[("Canda", "British Colombia")]["country_match"], got[("Canda", "British Colombia")]["state_match"]) == ("Canada", "British Columbia")
    assert got[("USA", "New York")]["country_how"] == "alias" and got[("USA", "New York")]["state_how"] == "exact"
    assert (got[("Atlantis", "Washington")]["country_how"], got[("Atlantis", "Washington")]["state_how"]) == ("none", "none")
    assert len(got) == 5


def test_no_row_is_lost(spark):
    asked = table(spark, [("US", "washingtn"), ("US", "washingtn"), ("US", "?"), (None, None)]).withColumn("name", F.lit("mine"))
    matches = match_names(asked, table(spark, REFERENCE), "state", "country")
    out = rename_matched(asked, matches, "state", "country")
    assert sorted(map(str, rows(out, "match"))) == ["('Washington',)", "('Washington',)", "(None,)", "(None,)"]
    with pytest.raises(ValueError):
        rename_matched(out, matches, "state", "country")


def test_empty(spark):
    none = table(spark, [])
    assert match_names(none, table(spark, REFERENCE), "state", "country").collect() == []
    assert found(match_names(table(spark, REFERENCE[:1]), none, "state", "country"))[("US", "Washington")][1] == "none"


def test_normal_names(spark):
    df = table(spark, [("x", "  Åland--Islands (Ö) "), ("x", None), ("x", "Nord-Pas-de-Calais")])
    got = [r[0] for r in df.select(normal_name(F.col("state"))).collect()]
    assert got == ["aland islands o", None, "nord pas de calais"]
    assert [r[0] for r in df.select(allowance(F.lit("abc")), ).limit(1).collect()] == [0]


def test_plan_has_no_cross_join(spark):
    matches = match_names(table(spark, REFERENCE), table(spark, REFERENCE), "state", "country")
    plan = matches._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
