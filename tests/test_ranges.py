import random
from datetime import date, timedelta

import pytest
from conftest import plan_of, rows

from pyspark.sql import functions as F

from forecourt.lens import spread_rows
from forecourt.operators.ranges import join_valid, stretch_months

DAY0 = date(2024, 1, 1)


def random_case(seed):
    rng = random.Random(seed)
    days = [(n, rng.choice(["a", "b", None]), rng.choice([None, *[DAY0 + timedelta(rng.randrange(400))] * 9])) for n in range(120)]
    periods = []
    for n in range(40):
        start = DAY0 + timedelta(rng.randrange(-500, 500))
        end = rng.choice([None, start + timedelta(rng.randrange(-3, 300)), start])
        periods.append((f"p{n}", rng.choice(["a", "b", None]), rng.choice([start] * 9 + [None]), end))
    return days, periods


def slow(days, periods, how):
    out = []
    for n, key, day in days:
        found = [
            (n, p) for p, k, start, end in periods
            if day and k is not None and k == key and start and start <= day <= (end or date.max)
        ]
        out += found or ([(n, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_rows_meet_the_periods_of_their_day(spark, how):
    days, periods = random_case(how)
    left = spark.createDataFrame(days, "n int, key string, day date")
    right = spark.createDataFrame(periods, "p string, k string, effective_from date, effective_to date")
    found = join_valid(left, right, "day", {"key": "k"}, {"p": "p"}, how=how)
    assert rows(found, "n", "p") == slow(days, periods, how)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    none = join_valid(left.limit(0), right, "day", {"key": "k"}, {"p": "p"}, how=how)
    assert none.collect() == []
    lost = join_valid(left, right.limit(0), "day", {"key": "k"}, {"p": "p"}, how=how)
    assert lost.count() == (len(days) if how == "left" else 0)


def test_rows_that_become_many_are_dealt_to_tasks(spark):
    dealt = spread_rows(spark.range(10_000).coalesce(1), per_task=1_000)
    sizes = [r[0] for r in dealt.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(sizes) == 10_000 and len(sizes) == 10 and max(sizes) < 1_500


def test_long_periods_are_listed_a_few_times(spark):
    assert [stretch_months(m) for m in (None, 1, 3.5, 9, 32, 600)] == [1, 1, 1, 4, 12, 12]
    starts = [date(1995 + y, 1 + y % 12, 1 + y) for y in range(20)]
    periods = [(f"p{i}", "a", start, None) for i, start in enumerate(starts)]
    days = [(i, "a", date(1994 + i, 12, 31)) for i in range(24)]
    left = spark.createDataFrame(days, "n int, key string, day date")
    right = spark.createDataFrame(periods, "p string, k string, effective_from date, effective_to date")
    found = join_valid(left, right, "day", {"key": "k"}, {"p": "p"})
    wanted = [(n, p) for n, _, day in days for p, _, start, _ in periods if start <= day]
    assert rows(found, "n", "p") == sorted(wanted, key=repr)
