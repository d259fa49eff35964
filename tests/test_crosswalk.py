"""Merged units between periods."""

import random

from pyspark.sql import functions as F

from canton.plans.votes import commune_units
from canton.operators.crosswalk import COMMON_WORDS, WEIGHT, _by_name, carried_forward, latest_units, merge_links, unit_changes

UNITS = "period int, area string, key string, name string, size long, votes long"

#: A department's communes that vanished and appeared between two elections, with registered voters.
GONE = {
    "Avenas": 115, "Belleville": 4714, "Chassagny": 1058, "Dareizé": 370, "Jarnioux": 495, "Les Olmes": 641,
    "Monsols": 591, "Ouroux": 242, "Pontcharra-sur-Turdine": 2025, "Saint-Andéol-le-Château": 1276,
    "Saint-Christophe-la-Montagne": 198, "Saint-Jacques-des-Arrêts": 90, "Saint-Jean-d'Ardières": 2739,
    "Saint-Jean-de-Touslas": 630, "Saint-Loup": 857, "Saint-Mamert": 59, "Trades": 87,
}
NEW = {"Beauvallon": 3086, "Belleville-en-Beaujolais": 8451, "Deux-Grosnes": 1343, "Vindry-sur-Turdine": 3931}


def communes(spark):
    rows = [(2017, "69", n, n, v, v) for n, v in GONE.items()] + [(2022, "69", n, n, v, v) for n, v in NEW.items()]
    rows += [(p, "69", f"k{i}", f"Place {i}", 100 + i, 1) for p in (2017, 2022) for i in range(5)]
    rows += [(2017, "01", "Belleville", "Belleville", 10, 1)]  # another area is another unit
    return spark.createDataFrame(rows, UNITS)


def test_a_department_with_merged_communes(spark):
    units = communes(spark).cache()
    links = {r["key"]: (r["to_key"], r["method"]) for r in merge_links(units).where("area = '69'").collect()}
    assert links["Belleville"] == ("Belleville-en-Beaujolais", "name")
    assert links["Pontcharra-sur-Turdine"] == ("Vindry-sur-Turdine", "name")
    assert links["k3"] == ("k3", "same") and len(links) == len(GONE) + 5
    assert links["Saint-Jean-d'Ardières"][1] == "size"
    latest = latest_units(units, merge_links(units))
    facts = carried_forward(units, latest, {"votes": "votes_then"})
    by = {(r["latest_key"], r["period"]): (r["votes_then"], r["n_merged"], r["n_keys"]) for r in facts.where("area = '69'").collect()}
    merged = {k: v for (k, p), v in by.items() if p == 2017 and k in NEW}
    assert sum(v for v, _, _ in merged.values()) == sum(GONE.values())
    assert all(v <= NEW[k] * 1.1 + max(GONE.values()) for k, (v, _, _) in merged.items())
    assert sum(n for _, _, n in merged.values()) == len(GONE)
    # The unit of the other area has no successor and stays what it was.
    alone = latest.where("area = '01'").collect()
    assert [(r["latest_period"], r["latest_key"], r["n_merged"]) for r in alone] == [(2017, "Belleville", 1)]
    units.unpersist()


def test_closure_over_several_periods(spark, rows):
    data = [
        (1, "x", "a", "Alba", 10), (1, "x", "b", "Brena", 20), (1, "x", "c", "Cor", 5),
        (2, "x", "ab", "Alba Brena", 30), (2, "x", "c", "Cor", 5),
        (3, "x", "abc", "Brena Cor", 36),
        (4, "x", "abc", "Brena Cor", 36), (4, "x", "n", "Novel", 3),
        (5, "x", "abcn", "Cor Novel", 40),
    ]
    units = spark.createDataFrame([(*d, 1) for d in data], UNITS)
    latest = latest_units(units, merge_links(units))
    assert {tuple(r)[3:] for r in latest.collect()} == {(5, "abcn", 7)}  # a, b, c, ab, abc, n and itself
    assert latest.count() == len(data)


def test_sizes_fill_rooms_in_order(spark, rows):
    data = [(1, "x", f"g{i}", None, s) for i, s in enumerate((50, 30, 20, 10, 5))]
    data += [(2, "x", "big", "Big", 80), (2, "x", "mid", "Mid", 22), (2, "x", "nil", "Nil", None)]
    got = rows(merge_links(spark.createDataFrame([(*d, 1) for d in data], UNITS)), "key", "to_key", "method")
    # Middles 25, 65, 90, 105, 112.5 over the rooms [0, 80) and [80, 102).
    assert got == [("g0", "big", "size"), ("g1", "big", "size"), ("g2", "mid", "size")]


def test_nulls_ties_and_empty(spark, rows):
    empty = spark.createDataFrame([], UNITS)
    assert merge_links(empty).count() == 0 and latest_units(empty, merge_links(empty)).count() == 0
    data = [
        (1, "x", "old", "Twin Hill", 5), (1, None, "q", "Q", 1), (1, "x", None, "Q", 1), (None, "x", "q", "Q", 1),
        (2, "x", "t2", "Twin Hill", 9), (2, "x", "t1", "Hill Twin", 9), (2, "x", "t3", "Hill", 90),
    ]
    units = spark.createDataFrame([(*d, 1) for d in data], UNITS)
    assert rows(merge_links(units), "key", "to_key", "method") == [("old", "t1", "name")]
    small = units.withColumn("size", F.when(F.col("key") == "old", 1000).otherwise(F.col("size")))
    assert rows(merge_links(small), "key", "to_key") == []  # larger than any successor with its name, and than all rooms


def test_changes_need_one_shuffle_of_the_units(spark):
    units = spark.range(1000).selectExpr(
        "CAST(id % 5 AS INT) AS period", "CAST(id % 3 AS STRING) AS area", "CAST(id DIV 7 AS STRING) AS key", "'n' AS name", "id AS size"
    )
    plan = unit_changes(units)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(area") == 1 and "CartesianProduct" not in plan


def test_units_of_silver_votes(spark, rows):
    votes = spark.createDataFrame(
        [(y, 2, "69", c, n, s, who) for y, c, n, s in ((2017, "001", "Bel", 9), (2022, "002", "Bel-en-Val", 12)) for who in "ab"],
        "annee_election long, tour long, code_departement string, code_commune string, libelle_commune string, inscrits long, nom string",
    )
    units = commune_units(votes)
    assert rows(units) == [(20172, "69", "001", "Bel", 9), (20222, "69", "002", "Bel-en-Val", 12)]
    assert rows(merge_links(units), "key", "to_key", "method") == [("001", "002", "name")]


def _joined_rows(plan) -> int:
    """Rows that the joins of an executed plan gave."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return _joined_rows(plan.executedPlan())
    if "QueryStage" in name:
        return _joined_rows(plan.plan())
    metric = plan.metrics().get("numOutputRows") if "Join" in name else None
    children = plan.children()
    own = metric.get().value() if metric is not None and metric.isDefined() else 0
    return own + sum(_joined_rows(children.apply(i)) for i in range(children.size()))


def test_names_that_many_units_share_make_no_pairs(spark):
    rows = [(p, "x", f"{p}-{i}", f"Val Mont {i % 7}", 100 + i, 1) for p in (1, 2) for i in range(400)]
    units = spark.createDataFrame(rows, UNITS).withColumnRenamed("period", "step")
    named = _by_name(units.where("step = 1").withColumn("step", F.lit(2)), units.where("step = 2"), COMMON_WORDS, 0.1)
    assert len(named.collect()) == 400
    assert _joined_rows(named._jdf.queryExecution().executedPlan()) < 4_000


def test_names_against_brute_force(spark):
    draw = random.Random(7)
    words = ["a", "b", "c", "dd", "ee", "ff"]
    longer = [f"w{i}" for i in range(12)]

    def unit(period, i):
        pool = longer if draw.random() < 0.2 else words
        name = " ".join(draw.sample(pool, draw.randint(1, len(pool)))) if draw.random() < 0.95 else None
        return (period, draw.choice("xy"), f"{period}-{i:02}", name, draw.choice((5, 9, 10, 20, 40)), 1)

    rows = [unit(p, i) for p in (1, 2) for i in range(60)]
    want = {}
    for area in "xy":
        sets = {r[2]: set((r[3] or "").split()) for r in rows if r[1] == area}
        weight = {w: WEIGHT // sum(w in s for s in sets.values()) for w in (*words, *longer) if any(w in s for s in sets.values())}
        for g in (r for r in rows if r[0] == 1 and r[1] == area):
            found = [
                (-sum(weight[w] for w in sets[g[2]] & sets[n[2]]), -n[4], n[2])
                for n in rows
                if n[0] == 2 and n[1] == area and sets[g[2]] & sets[n[2]] and g[4] <= n[4] * (1 + 0.1)
            ]
            if found:
                want[g[2]] = (min(found)[2], -min(found)[0])
    got = merge_links(spark.createDataFrame(rows, UNITS)).where("method = 'name'").collect()
    assert {r["key"]: (r["to_key"], r["score"]) for r in got} == want
