"""What keeps a query's work from outgrowing its input, read from plans: no sorted tables of criteria, bounded tasks, rows scored once."""

import random

import pytest
from pyspark.sql import functions as F

from episodica import plans
from episodica.functions.numbers import fixed
from episodica.operators import fit as T
from episodica.operators import score as S
from episodica.operators.selection import dealt

SF = "/root/testdata/sf0.001"


def plan(spark, name):
    return plans.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["criteria_rows_all", "top_offenders"])
def test_criteria_are_ranked_inside_their_row(spark, name):
    assert "Window" not in plan(spark, name) and "Sort" not in plan(spark, name)


@pytest.mark.parametrize("name", ["criteria_rows_all", "top_offenders"])
def test_lambdas_only_find_the_order_of_criteria(spark, name):
    # they aren't compiled, so a lambda judges nothing that rows show later (a violation has the only power)
    listed = [x for x in plan(spark, name).splitlines() if "posexplode" in x]
    assert listed and all("sort_array" in x and "POWER" not in x.upper() for x in listed)


def test_order_of_criteria(spark):
    # costs of 0 (1, 4), unknown (0), equal to nine places (2, 5), not judged (3)
    good = lambda n, **more: T.Criterion(n, 0.0, 1.0, 1.0, "f", n, **more)
    p = T.Profile(criteria=(good("a"), good("b"), good("c"), good("d", enabled=False), good("e"), good("f"), good("g", action="review")))
    row = spark.range(1).select(F.col("id").alias("episode"), F.lit(True).alias("valid"), F.lit(None).cast("double").alias("a"), *[F.lit(v).alias(k) for k, v in {"b": -1.0, "c": 0.5, "d": 9.0, "e": 1e-12, "f": 0.5 + 1e-12, "g": 2.0}.items()])
    got = S.ranked(row, p).orderBy("place").collect()
    assert [(r.place, r.quantity, r["rank"]) for r in got] == [(1, "g", 6), (2, "c", 2), (3, "f", 5), (4, "b", 1), (5, "e", 4), (6, "a", 0)]
    assert [r.u for r in got] == [2.0, 0.5, 0.5 + 1e-12, -1.0, 1e-12, None] and got[0].p == pytest.approx(1 - 0.02**2) and got[5].p is got[5].cost is None
    assert [(r.place, r.quantity) for r in S.top_offenders(row, p).orderBy("place").collect()] == [(1, "c"), (2, "f")]
    # values and costs of either are those of the table of penalties
    key = ["quantity", "value", "p", "cost"]
    assert sorted(map(str, S.penalties(row, p).select(key).collect())) == sorted(map(str, S.ranked(row, p).select(key).collect()))


def test_episode_detail_moves_no_list_of_its_own(spark):
    # measures and criteria are lists of the scored row, not rows gathered again
    assert "inline(" not in plan(spark, "episode_detail")


def test_decisions_print_no_numbers(spark):
    assert "lpad" not in plan(spark, "decide_absolute")


def test_family_view_spreads_values_alone(spark):
    assert "posexplode" in plan(spark, "family_view")


def test_severities_are_counted_once(spark):
    assert "Join" not in plan(spark, "severity_histogram") and "parquet" not in plan(spark, "severity_histogram")


def test_tasks_hold_a_fixed_number_of_rows(spark):
    assert dealt(spark.range(1000), 10, "id").rdd.getNumPartitions() == 100
    assert dealt(spark.range(1000), 10, "id", of=spark.range(2000)).rdd.getNumPartitions() == 200
    for name in ("sparc", "judge_replies", "json_repair"):
        assert "REPARTITION_BY_NUM" in plan(spark, name), name


def test_numbers_near_and_far_from_halves(spark):
    r = random.Random(3)
    values = [r.uniform(-1, 1) * 10 ** r.randrange(12) for _ in range(300)] + [(2 * n + 1) / 2000 for n in range(300)] + [0.1785, 0.17850000000000002, 1e9 + 0.0005, 0.0005, -0.0005]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", fixed(F.col("v"), 3).alias("s")).collect()
    assert all(x.s == f"{x.v:.3f}" for x in got)
