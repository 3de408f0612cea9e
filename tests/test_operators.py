import hashlib
import os
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from conftest import plan_of, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.functions.casts import text_to_month, text_to_timestamp
from forecourt.functions.keys import hash_key, path_safe_run_id
from forecourt.functions.measures import per_entity, ratio_pct
from forecourt.functions.workspace import scratch_path
from forecourt.operators import aggregates, catalogue, joins, paging
from forecourt.plans.dimensions import dim_date

QUIET = settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


def test_hash_key_is_upper_case_and_null_safe(spark):
    expected = hashlib.md5(b"2024-01-01|DE").hexdigest().upper()
    day = F.lit(date(2024, 1, 1))
    assert one(spark, hash_key(day, F.lit("DE"))) == expected
    assert one(spark, hash_key(day, F.lit(None))) is None


def test_month_and_timestamp_text(spark):
    assert one(spark, text_to_month(F.lit("2026-01"))) == date(2026, 1, 1)
    assert one(spark, text_to_month(F.lit("2026-01-20"))) == date(2026, 1, 1)
    assert one(spark, text_to_month(F.lit("2026-13"))) is None
    assert one(spark, text_to_month(F.lit("2026-01"), strict=True)) is None
    assert one(spark, text_to_timestamp(F.lit("2026-01-01T10:00:00"))).hour == 10
    assert one(spark, text_to_timestamp(F.lit("2026-01-01T10:00:00"), strict=True)) is None
    assert one(spark, text_to_timestamp(F.lit("10:00"))) is None


def test_run_id(spark):
    run = F.lit("manual__2024-01-01T00:00:00+00:00")
    assert one(spark, path_safe_run_id(run)) == "manual__2024-01-01T00-00-00_00-00"


def test_calendar_edges(spark):
    days = dim_date(spark)
    assert days.count() == 1827
    found = rows(
        days.filter(F.col("calendar_date").isin(date(2024, 12, 30), date(2024, 12, 29))),
        "date_key",
        "week_of_year",
        "day_of_week",
        "day_name",
        "month_name",
        "year_month",
        "is_weekend",
    )
    assert found == [
        (20241229, 52, 7, "Sunday", "December", "2024-12", True),
        (20241230, 1, 1, "Monday", "December", "2024-12", False),
    ]


def test_ratio_rounds_half_up_once(spark):
    def pct(a, b, **kw):
        return one(spark, ratio_pct(F.lit(a), F.lit(b), **kw))

    assert pct(3, 7) == Decimal("42.8571")
    assert pct(3, 7, first_round=1) == Decimal("42.9000")
    assert pct(0, 5) == Decimal("0.0000")
    assert pct(5, 0) is None and pct(5, None) is None and pct(None, 5) == Decimal("0.0000")
    assert pct(1, 800000) == Decimal("0.0001")
    assert one(spark, per_entity(F.lit(Decimal("10.00")), F.lit(3))) == Decimal("3.33")
    assert one(spark, per_entity(F.lit(Decimal("10.00")), F.lit(0))) is None


def test_mean_is_rounded_once(spark):
    # The mean lies just below half a cent.
    values = spark.range(20_001).select(
        F.when(F.col("id") < 10_000, Decimal("0.01")).otherwise(Decimal("0.00")).alias("v")
    )
    exact = values.agg(aggregates.mean_decimal(F.col("v"), "decimal(14,2)", 2)).first()[0]
    assert exact == Decimal("0.00")


def test_lookup_null_keys_match_nothing_and_are_spread(spark):
    left = spark.range(9000).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("k")
    )
    right = spark.createDataFrame(
        [("1", "one"), ("2", "two"), (None, "nothing")], "key string, name string"
    )
    found = joins.lookup(left, right, on={"k": "key"}, take={"name": "name"})
    assert found.count() == 9000
    assert rows(found.filter("name is not null"), "id", "name") == [(1, "one"), (2, "two")]
    key = joins.spread_null_key(left, "k")
    assert left.filter("k is null").select(key).distinct().count() > 1000


def test_lookup_reads_only_what_is_asked_for(spark, folder):
    wide = spark.range(100).select(
        F.col("id").cast("string").alias("invoice_id"),
        F.col("id").cast("string").alias("k"),
        *[F.col("id").cast("string").alias(f"c{i}") for i in range(5)],
    )
    wide.write.parquet(f"{folder}/wide")
    left = spark.read.parquet(f"{folder}/wide")
    right = spark.createDataFrame([("1", "one")], "key string, name string")
    found = joins.lookup(left, right, on={"k": "key"}, take={"name": "name"}).select("c0", "name")
    scan = next(line for line in plan_of(found).splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<invoice_id:string,k:string,c0:string>" in scan


def test_lookup_replaces_a_column_of_the_same_name(spark):
    left = spark.createDataFrame([("a", "old")], "k string, v string")
    right = spark.createDataFrame([("a", "new")], "k string, v string")
    assert rows(joins.lookup(left, right, on={"k": "k"}, take={"v": "v"})) == [("a", "new")]


def test_composite_null_keys_do_not_match(spark):
    left = spark.createDataFrame([("a", None), ("a", "b")], "k string, m string")
    right = spark.createDataFrame([("a", None, 1), ("a", "b", 2)], "k string, m string, n int")
    found = joins.lookup(left, right, on={"k": "k", "m": "m"}, take={"n": "n"})
    assert rows(found, "m", "n") == [("b", 2), (None, None)]


keyed = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 50)), max_size=12
)


@QUIET
@given(keyed, keyed)
def test_stack_equals_spine_equals_full_join(spark, one_side, other_side):
    a = spark.createDataFrame(one_side, "k string, x int").filter("k is not null")
    b = spark.createDataFrame(other_side, "k string, y int").filter("k is not null")
    sums = [a.groupBy("k").agg(F.sum("x").alias("x")), b.groupBy("k").agg(F.sum("y").alias("y"))]
    spine = joins.key_spine(sums, ["k"])
    for part in sums:
        spine = spine.join(part, "k", "left")
    stacked = joins.stack([a, b]).groupBy("k").agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    outer = sums[0].join(sums[1], "k", "full")
    assert rows(spine, "k", "x", "y") == rows(stacked, "k", "x", "y") == rows(outer, "k", "x", "y")


def test_orphans(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "fk string")
    parent = spark.createDataFrame([("a",), (None,)], "pk string")
    assert rows(joins.orphans(child, "fk", parent, "pk")) == [("x",), ("x",)]


def test_repeated_keys_counts_null_as_a_key(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(aggregates.repeated_keys(df, ["k"])) == [("a", 2), (None, 2)]


@pytest.mark.parametrize("n,size", [(0, 10), (1, 10), (10, 10), (1003, 100)])
def test_row_numbers_and_pages(spark, n, size):
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("k"))
    df = df.repartition(7)
    numbered = rows(paging.with_row_number(df, ["k"]), "k", "row_no", "total_records")
    assert numbered == [(f"{i:08d}", i + 1, n) for i in range(n)]
    pages = paging.paged_envelopes(df, ["k"], size).select(
        "page",
        F.from_json("raw_json", "total_pages int, data array<struct<k string>>").alias("p"),
    )
    found = rows(pages, "page", "p.total_pages", F.size("p.data"))
    total = -(-n // size)
    assert found == sorted(
        [(p + 1, total, min(size, n - p * size)) for p in range(total)], key=repr
    )


def test_page_slice(spark):
    df = spark.range(95).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("k"))
    assert [r[0] for r in rows(paging.page_slice(df, ["k"], 10, 10))] == [
        f"{i:04d}" for i in range(90, 95)
    ]
    assert paging.page_slice(df, ["k"], 11, 10).count() == 0


def test_page_slice_by_order_statistics(spark):
    """Every page, with NULLs, ties, equal rows and times, found by narrowing; nothing is written."""
    kinds = "a string, b double, t timestamp, n bigint, m map<string,int>"
    start = datetime(2024, 10, 27, 0, 30)
    made = [
        (
            [None, "x", "y", "z"][i % 4],
            [None, float("nan"), -1.5, 2.0][i % 7 % 4],
            start + timedelta(minutes=i % 11),
            i // 3,
            {"k": i},
        )
        for i in range(300)
    ] + [("x", 2.0, start, 7, None)] * 400
    df = spark.createDataFrame(made, kinds).repartition(5)
    df.write.parquet(path := scratch_path(spark, "paged"))
    df = spark.read.parquet(path)
    root = os.path.dirname(path)
    before = os.listdir(root)
    order, size = ["a", "b", "t"], 175
    total = len(made)
    whole = [tuple(r) for r in df.select(*order).orderBy(*order).collect()]
    seen = []
    for page in range(1, -(-total // size) + 2):
        found = paging.page_slice(df, order, page, size, sort_at_most=20, bounds=8)
        found = found.collect()
        assert {(r.total_records, r.total_pages) for r in found} <= {(total, -(-total // size))}
        got = sorted(repr(tuple(r)[:3]) for r in found)
        assert got == sorted(repr(r) for r in whole[(page - 1) * size : page * size])
        seen += [repr(tuple(r)[:5]) for r in found]
    assert sorted(seen) == sorted(repr(tuple(r)) for r in df.collect())
    assert os.listdir(root) == before
    assert paging.page_slice(df.limit(0), order, 1, size, sort_at_most=0).count() == 0


def test_page_slice_bounds_reach_the_scan(spark):
    spark.range(5000).write.parquet(path := scratch_path(spark, "paged"))
    df = spark.read.parquet(path)
    found = paging.page_slice(df, ["id"], 40, 10, sort_at_most=100)
    assert [r.id for r in found.orderBy("id").collect()] == list(range(390, 400))
    assert "GreaterThanOrEqual(id" in plan_of(found) and "Exchange" not in plan_of(found)


def test_catalogue(spark):
    df = spark.createDataFrame(
        [
            ("P1", "DE", date(2024, 1, 1), date(2024, 3, 31)),
            ("P1", "DE", date(2024, 4, 1), None),
            ("P1", "IT", date(2024, 1, 1), None),
        ],
        "product_id string, market string, effective_from date, effective_to date",
    )
    assert catalogue.in_catalogue(df, market="de").count() == 2
    assert catalogue.in_catalogue(df).count() == 3
    last_day = catalogue.effective_on(df, date(2024, 3, 31))
    assert rows(last_day, "market", "effective_from") == [
        ("DE", date(2024, 1, 1)),
        ("IT", date(2024, 1, 1)),
    ]


def test_scan_reads_only_what_is_needed(spark):
    from conftest import DATA

    rows_read = spark.read.parquet(f"{DATA}/lineitem.parquet")
    query = rows_read.filter("l_shipdate >= '1998-01-01'").groupBy("l_returnflag").count()
    plan = plan_of(query)
    assert "GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_returnflag:string,l_shipdate" in plan


def test_two_lookups_by_one_key_share_a_shuffle(spark):
    left = spark.range(100).selectExpr("concat('i', id) AS invoice_id", "concat('d', id) AS dealer_id")
    right = left.selectExpr("dealer_id", "upper(dealer_id) AS name")
    on = {"dealer_id": "dealer_id"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        once = joins.lookup(left, right, on, {"name": "name"})
        twice = joins.lookup(once, right, on, {"again": "name"})
        assert plan_of(twice).count("Exchange hashpartitioning") == 3  # the rows once, each right side
        assert twice.filter("again = upper(dealer_id) AND name = again").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_parent_told_unique_costs_nothing_unless_it_is_used(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    parent = spark.createDataFrame([("a", "x"), ("c", "y"), (None, "z"), (None, "w")], "p string, v string")
    found = joins.lookup(left, joins.told_unique(parent, "p"), {"k": "p"}, {"v": "v"})
    assert rows(found) == [(1, "a", "x"), (2, "b", None), (3, None, None)]
    assert "Join" not in plan_of(found.select("id"))
    twice = parent.unionAll(parent)  # rows that meet a repeated key are still multiplied
    found = joins.lookup(left, joins.told_unique(twice, "p"), {"k": "p"}, {"v": "v"})
    assert rows(found.select("id")) == [(1,), (1,), (2,), (3,)]


def test_keys_are_named_after_the_last_move_and_stay_what_they_are(spark):
    from forecourt.functions.keys import hash_key
    from forecourt.plans.intermediate import find_key, named_keys

    facts = spark.createDataFrame([("D1",), ("D2",), ("D3",), ("D4",), (None,)], "dealer_id string")
    ids = spark.createDataFrame([("D1",), ("D2",), ("D3",)], "dealer_id string")
    odd = F.when(F.col("dealer_id") == "D2", "own").when(F.col("dealer_id") == "D1", hash_key("dealer_id"))
    dim = ids.withColumn("dealer_key", odd)
    moved = find_key(facts, dim, "dealer")
    assert "dealer_key" not in moved.columns  # the long text is not moved
    plain = joins.lookup(facts, dim, {"dealer_id": "dealer_id"}, {"dealer_key": "dealer_key"})
    named = named_keys(moved, "dealer")
    assert rows(named, "dealer_id", "dealer_key") == rows(plain, "dealer_id", "dealer_key")
    assert named.columns == ["dealer_id", "dealer_key"]
