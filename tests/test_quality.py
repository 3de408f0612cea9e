from collections import Counter

import pytest
from conftest import DATA, plan_of, rows
from pyspark.sql import functions as F

from forecourt.checks.frames import LensModels
from forecourt.checks.gates import staged_frames
from forecourt.functions.workspace import cut_lineage
from forecourt.plans import quality
from forecourt.schemas import KEYS


def test_clean_tables_pass(spark):
    quality.assert_clean(quality.staging_checks(staged_frames(LensModels(spark, DATA))))


def test_each_planted_defect_is_counted(spark):
    frames = staged_frames(LensModels(spark, DATA))
    for name, (child, key, _) in quality.FOREIGN_KEYS.items():
        planted = frames[child].limit(3).withColumn(key, F.lit("nobody"))
        bad = {**frames, child: frames[child].unionAll(planted)}
        found = dict(rows(quality.staging_checks(bad), "check_name", "bad_rows"))
        assert found[name] == 3
        assert found["duplicate_primary_keys"] == (1 if child == "stg_commercial_accounts" else 3)


def test_each_planted_analytics_defect_is_counted(spark):
    m = LensModels(spark, DATA)
    names = [t for t in KEYS if t.startswith(("dim_", "fact_", "mart_"))]
    tables = {t: cut_lineage(getattr(m, t)) for t in names}
    empty = {t: df.limit(0) for t, df in tables.items()}

    def found(**changed):
        checks = quality.analytics_checks({**empty, **changed})
        return {name: n for name, n in rows(checks, "check_name", "bad_rows") if n}

    assert found() == {}
    names = dict.fromkeys(quality.DIMENSIONS, "dimension_duplicate_keys")
    names |= dict.fromkeys(quality.FACTS, "fact_duplicate_keys") | quality.CHECKED_MARTS
    few = {t: tables[t].orderBy(KEYS[t]).limit(2) for t in names}
    counts = found(**{t: df.unionAll(df) for t, df in few.items()})
    planted = Counter(names.values())
    assert {name: counts[name] for name in planted} == {n: 2 * k for n, k in planted.items()}
    for place in range(3):
        bare = {}
        for fact, keys in quality.FACT_KEYS.items():
            kinds = {s: tables[fact].schema[s].dataType for s in keys.values()}
            held = {s: F.lit(1).cast(kind) for s, kind in kinds.items()}
            natural, surrogate = list(keys.items())[place]
            held[surrogate] = F.lit(None).cast(kinds[surrogate])
            row = tables[fact].filter(F.col(natural).isNotNull()).limit(1)
            bare[fact] = row.withColumns(held)
        assert found(**bare) == {f"{fact}_unresolved_keys": 1 for fact in bare}


def test_staging_gate_reads_each_table_once(spark):
    staged = staged_frames(LensModels(spark, DATA))
    written = {table: cut_lineage(df) for table, df in staged.items()}
    plan = plan_of(quality.staging_checks(written))
    plan = plan.split("Initial Plan")[-1]
    assert plan.count("FileScan") == len(written)
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_null_and_empty(spark):
    df = spark.createDataFrame([(None,), ("a",), (None,)], "k string")
    assert rows(quality.null_keys(df, "k", "n")) == [("n", 2)]
    assert rows(quality.duplicate_keys(df, "k", "d")) == [("d", 1)]
    assert rows(quality.no_rows(df, "e")) == [("e", 0)]
    assert rows(quality.no_rows(df.limit(0), "e")) == [("e", 1)]
    assert rows(quality.null_keys(df.limit(0), "k", "n")) == [("n", 0)]
    assert rows(quality.wrong_count(df, 5, "w")) == [("w", 2)]


def test_gate_names_what_failed(spark):
    checks = spark.createDataFrame([("fine", 0), ("broken", 4)], "check_name string, bad_rows bigint")
    with pytest.raises(quality.QualityError, match="broken: 4"):
        quality.assert_clean(checks)
    quality.assert_clean(checks.filter("bad_rows = 0"))


def test_unresolved_keys_need_a_natural_key(spark):
    df = spark.createDataFrame(
        [("a", None), (None, None), ("a", "k")], "dealer_id string, dealer_key string"
    )
    assert rows(quality.unresolved_keys(df, {"dealer_id": "dealer_key"}, "u")) == [("u", 1)]


def test_hot_orphan_key(spark):
    child = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "gone").otherwise("here").alias("k"))
    parent = spark.createDataFrame([("here",)], "k string")
    assert rows(quality.orphan_rows(child, "k", parent, "k", "o")) == [("o", 3000)]


def test_short_keys_are_equal_where_keys_are(spark):
    from pyspark.sql import functions as F

    from forecourt.plans.quality import short_key

    keys = ["0A" * 16, "0a" * 16, "A" * 31, "0" + "A" * 31, "", "I1-1", None]
    df = spark.createDataFrame([(k,) for k in keys for _ in range(2)], "key string")
    found = df.groupBy(*short_key(df, "key")).agg(F.count(F.lit(1)).alias("n")).collect()
    assert [r.n for r in found] == [2] * len(keys)
    assert max(len(r.packed or b"") + len(r.plain or "") for r in found if r.packed) == 16
    number = spark.range(1)
    assert number.select(*short_key(number, "id")).columns == ["id"]
