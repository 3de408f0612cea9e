import itertools
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forecourt.operators import incremental, upsert
from forecourt.schemas import schema_of
from forecourt.sources import tables

CONTRACTS = "stg_commercial_contracts"
INVOICES = "stg_commercial_invoices"


def frame(spark, table, *records):
    names = schema_of(table).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema_of(table))


def contract(key, status, day=None):
    return {"contract_id": key, "contract_status": status, "updated_at": day}


def invoice(key, day, status="PAID", updated=None):
    return {"invoice_id": key, "invoice_date": day, "payment_status": status, "updated_at": updated}


def test_merge_updates_inserts_and_keeps(spark):
    target = frame(spark, CONTRACTS, contract("a", "old"), contract("b", "old"))
    batch = frame(spark, CONTRACTS, contract("b", "new"), contract("c", "new"))
    merged = upsert.merge_rows(target, batch, "contract_id")
    assert rows(merged, "contract_id", "contract_status") == [
        ("a", "old"),
        ("b", "new"),
        ("c", "new"),
    ]
    again = upsert.merge_rows(merged, batch, "contract_id")
    assert rows(again) == rows(merged)


def test_null_keys(spark):
    target = frame(spark, CONTRACTS, contract(None, "kept"), contract("a", "old"))
    batch = frame(spark, CONTRACTS, contract(None, "extra"), contract("a", "new"))
    strict = upsert.merge_rows(target, batch, "contract_id", drop_null_keys=False)
    assert rows(strict, "contract_status") == [("extra",), ("kept",), ("new",)]
    assert rows(upsert.merge_rows(target, batch, "contract_id"), "contract_status") == [
        ("kept",),
        ("new",),
    ]


def test_guard_makes_batch_order_irrelevant(spark):
    day = date(2024, 1, 1)
    batches = [
        frame(spark, CONTRACTS, contract("a", f"v{i}", day + timedelta(i)), contract("b", f"w{i}", None))
        for i in range(3)
    ]
    results = set()
    for order in itertools.permutations(batches):
        table = frame(spark, CONTRACTS)
        for batch in order:
            table = upsert.merge_rows(table, batch, "contract_id", guard=["updated_at"])
        results.add(tuple(rows(table.filter("contract_id = 'a'"), "contract_status")))
    assert results == {(("v2",),)}


def test_guard_lets_equal_and_newer_pass_and_null_is_oldest(spark):
    day = date(2024, 1, 5)
    target = frame(
        spark, CONTRACTS, *[contract(k, "old", d) for k, d in zip("abcd", [day, day, day, None])]
    )
    batch = frame(
        spark,
        CONTRACTS,
        contract("a", "new", day),
        contract("b", "new", day - timedelta(1)),
        contract("c", "new", None),
        contract("d", "new", day),
    )
    merged = upsert.merge_rows(target, batch, "contract_id", guard=["updated_at"])
    assert rows(merged, "contract_id", "contract_status") == [
        ("a", "new"),
        ("b", "old"),
        ("c", "old"),
        ("d", "new"),
    ]


def test_versions(spark, folder):
    for status in ("one", "two", "three"):
        upsert.upsert_version(
            spark, folder, CONTRACTS, frame(spark, CONTRACTS, contract("a", status))
        )
    assert tables.complete_versions(spark, folder) == [2, 3]
    # A version that was never completed is not seen.
    frame(spark, CONTRACTS, contract("x", "torn")).write.parquet(f"{folder}/version=4")
    import os

    os.unlink(f"{folder}/version=4/_SUCCESS")
    assert rows(tables.read_version(spark, folder, CONTRACTS), "contract_status") == [("three",)]
    upsert.upsert_version(spark, folder, CONTRACTS, frame(spark, CONTRACTS, contract("b", "four")))
    assert rows(tables.read_version(spark, folder, CONTRACTS), "contract_id") == [("a",), ("b",)]


def test_repeated_batch_keys_are_refused(spark, folder):
    batch = frame(spark, CONTRACTS, contract("a", "x"), contract("a", "y"))
    with pytest.raises(ValueError, match="several batch rows"):
        upsert.upsert_version(spark, folder, CONTRACTS, batch)
    assert tables.read_version(spark, folder, CONTRACTS) is None


def stored(spark, folder):
    return rows(
        tables.read_partitions(spark, folder, INVOICES), "invoice_id", "payment_status", "part"
    )


def put(spark, folder, *records, **kw):
    return upsert.upsert_partitions(
        spark, folder, INVOICES, frame(spark, INVOICES, *records), "invoice_date", True, **kw
    )


def test_partitions_touched_only(spark, folder):
    put(spark, folder, invoice("a", date(2024, 1, 5)), invoice("b", date(2024, 2, 5)))
    before = tables.partition_folders(spark, folder)["2024-01-01"]
    touched = put(spark, folder, invoice("b", date(2024, 2, 9), "OPEN"), invoice("c", date(2024, 3, 1)))
    assert sorted(touched) == ["2024-02-01", "2024-03-01"]
    assert tables.partition_folders(spark, folder)["2024-01-01"] == before
    assert stored(spark, folder) == [
        ("a", "PAID", "2024-01-01"),
        ("b", "OPEN", "2024-02-01"),
        ("c", "PAID", "2024-03-01"),
    ]


def test_moved_rows_leave_their_partition(spark, folder):
    put(spark, folder, invoice("a", date(2024, 1, 5)), invoice("n", None), invoice("k", date(2024, 5, 1)))
    put(spark, folder, invoice("a", date(2024, 2, 5)), invoice("n", date(2024, 2, 6)))
    expected = [
        ("a", "PAID", "2024-02-01"),
        ("k", "PAID", "2024-05-01"),
        ("n", "PAID", "2024-02-01"),
    ]
    assert stored(spark, folder) == expected
    put(spark, folder, invoice("a", date(2024, 2, 5)), invoice("n", date(2024, 2, 6)))
    assert stored(spark, folder) == expected


def test_a_write_that_dies_changes_nothing(spark, folder, monkeypatch):
    put(spark, folder, invoice("a", date(2024, 1, 5)), invoice("b", date(2024, 1, 6)))
    before = stored(spark, folder)

    def die(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(tables, "publish", die)
        with pytest.raises(OSError):
            put(spark, folder, invoice("a", date(2024, 2, 5)), mark="2024-02-05")
    assert stored(spark, folder) == before
    assert tables.read_manifest(spark, folder)["mark"] is None
    put(spark, folder, invoice("a", date(2024, 2, 5)), mark="2024-02-05")
    assert stored(spark, folder) == [("a", "PAID", "2024-02-01"), ("b", "PAID", "2024-01-01")]
    assert tables.read_manifest(spark, folder)["mark"] == "2024-02-05"


def opened(df):
    return {f.split("/keys/")[1].rsplit("/", 1)[0] for f in df.inputFiles()}


def test_a_batch_opens_the_index_buckets_of_its_keys_only(spark, folder):
    put(spark, folder, *[invoice(f"i{n}", date(2024, 1 + n % 12, 5)) for n in range(300)])
    batch = frame(spark, INVOICES, invoice("i7", date(2024, 3, 1)), invoice("new", date(2024, 4, 1)))
    known = upsert.known_entries(spark, folder, INVOICES, batch, ())
    assert 1 <= len(opened(known)) <= 2
    assert ("i7", "2024-08-01") in rows(known)
    touched = put(spark, folder, invoice("i7", date(2024, 3, 1)), invoice("new", date(2024, 4, 1)))
    assert sorted(touched) == ["2024-03-01", "2024-04-01", "2024-08-01"]
    found = {r[0]: r[2] for r in stored(spark, folder)}
    assert len(found) == 301 and found["i7"] == "2024-03-01"


def test_the_index_says_what_the_table_holds_after_many_commits(spark, folder, monkeypatch):
    monkeypatch.setattr(tables, "KEY_BUCKETS", 2)
    monkeypatch.setattr(tables, "KEY_LAYERS", 3)
    for turn in range(9):
        put(spark, folder, *[invoice(f"i{n}", date(2024, 1 + (n + turn) % 3, 5)) for n in range(turn, turn + 6)])
        layers = tables.read_manifest(spark, folder)["keys"]["layers"]
        assert all(len(commits) <= 3 for commits in layers.values())
    everything = tables.read_partitions(spark, folder, INVOICES)
    known = upsert.known_entries(spark, folder, INVOICES, everything, ())
    assert rows(known) == rows(everything, "invoice_id", "part")


def test_the_index_guards_against_older_rows_and_follows_the_guard(spark, folder):
    guard = ("updated_at",)
    old, new = (
        frame(spark, INVOICES, invoice("a", date(2024, month, 5), status, date(2024, month, 5)))
        for month, status in ((1, "OPEN"), (2, "PAID"))
    )

    def put_frame(batch, guard):
        return upsert.upsert_partitions(spark, folder, INVOICES, batch, "invoice_date", True, guard)

    put_frame(new, guard)
    assert put_frame(old, guard) == []
    assert sorted(put_frame(old, ())) == ["2024-01-01", "2024-02-01"]  # without a guard it replaces
    assert stored(spark, folder) == [("a", "OPEN", "2024-01-01")]
    put_frame(new, guard)  # the index of other guard columns is made anew
    assert tables.read_manifest(spark, folder)["keys"]["guard"] == ["updated_at"]
    assert put_frame(old, guard) == [] and stored(spark, folder) == [("a", "PAID", "2024-02-01")]


def test_a_commit_number_is_published_once(spark, folder):
    put(spark, folder, invoice("a", date(2024, 1, 5)))
    with pytest.raises(RuntimeError, match="another run"):
        tables.publish(spark, folder, 1, {}, None)
    assert len(stored(spark, folder)) == 1


def test_old_commits_are_removed(spark, folder):
    import os

    for day in range(1, 6):
        put(spark, folder, invoice("a", date(2024, 1, day)), invoice(f"n{day}", date(2024, day, 1)))
    assert sorted(os.listdir(f"{folder}/_commits"))[-2:] == ["000000000004.json", "000000000005.json"]
    assert len(stored(spark, folder)) == 6
    left = [d for d, _, files in os.walk(folder) if any(f.endswith(".parquet") for f in files)]
    assert len(left) == 6


def test_guarded_partitions(spark, folder):
    new, old = date(2024, 6, 2), date(2024, 6, 1)
    put(spark, folder, invoice("a", date(2024, 1, 5), "NEW", new))
    touched = put(
        spark, folder, invoice("a", date(2024, 2, 5), "OLD", old), guard=["updated_at"]
    )
    assert touched == [] and stored(spark, folder) == [("a", "NEW", "2024-01-01")]


# Incremental ranges


def test_source_filter(spark):
    days = spark.createDataFrame([(f"2024-01-{d:02d}",) for d in range(1, 8)], "d string")

    def kept(**kw):
        return [r[0][-2:] for r in rows(days.filter(incremental.source_filter(**kw)))]

    day = date(2024, 1, 5)
    assert kept(column="d", run_day=day, first_run=True) == [f"{d:02d}" for d in range(1, 8)]
    assert kept(column=None, run_day=day, first_run=False) == [f"{d:02d}" for d in range(1, 8)]
    assert kept(column="d", run_day=day, first_run=False) == ["05"]
    assert kept(column="d", run_day=day, first_run=False, lookback_days=2) == ["03", "04", "05"]


def test_resume_range():
    d = [date(2024, 1, i) for i in range(1, 32)]
    assert incremental.resume_range(None, None, None, 2) is None
    assert incremental.resume_range(d[0], d[9], None, 2) == (d[0], d[9])
    assert incremental.resume_range(d[0], d[9], d[7], 2) == (d[5], d[9])
    assert incremental.resume_range(d[4], d[9], d[5], 2) == (d[4], d[9])
    assert incremental.resume_range(d[0], d[9], d[20], 2) is None
    assert incremental.resume_range(d[0], d[9], d[11], 2) == (d[9], d[9])


@settings(max_examples=200, deadline=None)
@given(st.dates(date(2020, 1, 1), date(2030, 1, 1)), st.integers(0, 800))
def test_month_windows_cover_every_day_once(first, length):
    last = first + timedelta(days=length)
    windows = list(incremental.month_windows(first, last))
    assert windows[0][0] == first and windows[-1][1] == last + timedelta(days=1)
    for start, end in windows:
        assert start < end
        assert (start.year, start.month) == ((end - timedelta(1)).year, (end - timedelta(1)).month)
    assert all(a[1] == b[0] for a, b in zip(windows, windows[1:]))


def test_changes_and_marks(spark, folder):
    df = spark.createDataFrame(
        [(i, datetime(2024, 1, i)) for i in range(1, 6)], "id int, updated_at timestamp_ntz"
    )
    high = incremental.high_watermark(df, "updated_at")
    assert high == "2024-01-05 00:00:00"
    assert incremental.changed_between(df, "updated_at", None, high).count() == 5
    later = incremental.changed_between(df, "updated_at", "2024-01-03 00:00:00", high)
    assert rows(later, "id") == [(4,), (5,)]
    assert incremental.high_watermark(df.limit(0), "updated_at") is None
    since = incremental.changed_since(df, "updated_at", "2024-01-04T18:00:00")
    assert rows(since, "id") == [(4,), (5,)]
    control = f"{folder}/marks"
    assert incremental.read_watermark(spark, control, "a") is None
    incremental.commit_watermark(spark, control, "a", "1", datetime(2024, 1, 1))
    incremental.commit_watermark(spark, control, "a", "2", datetime(2024, 1, 2))
    incremental.commit_watermark(spark, control, "b", "9", datetime(2024, 1, 3))
    assert incremental.read_watermark(spark, control, "a") == "2"
    assert incremental.read_watermark(spark, control, "c") is None


def test_month_partition_values(spark):
    df = spark.createDataFrame([(date(2024, 2, 9),), (None,)], "d date")
    assert rows(df.select(tables.partition_value("d", True))) == [("2024-02-01",), ("none",)]
    assert rows(df.select(tables.partition_value("d", False))) == [("2024-02-09",), ("none",)]


def test_a_first_load_computes_its_rows_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    batch = frame(spark, INVOICES, invoice("a", date(2024, 1, 1)), invoice("b", date(2024, 2, 1)))
    upsert.upsert_partitions(
        spark, folder, INVOICES, batch.mapInArrow(counted, batch.schema), "invoice_date", True,
        verify_keys=False,
    )
    assert seen.value == 2
    put(spark, folder, invoice("a", date(2024, 3, 1)))
    assert len(stored(spark, folder)) == 2  # the index knows where the old row is


def test_a_first_load_is_written_once_and_refused_before_it_is_published(spark, folder):
    import os

    from forecourt.functions.workspace import shared_root

    rows = frame(spark, INVOICES, invoice("a", date(2024, 1, 1)), invoice("b", date(2024, 2, 1)))
    shared = shared_root(spark)
    before = set(os.listdir(shared))
    with pytest.raises(ValueError, match="several batch rows"):
        upsert.upsert_partitions(spark, f"{folder}/twice", INVOICES, rows.unionAll(rows), "invoice_date", True)
    assert tables.read_partitions(spark, f"{folder}/twice", INVOICES) is None
    upsert.upsert_partitions(spark, f"{folder}/once", INVOICES, rows, "invoice_date", True)
    assert tables.read_partitions(spark, f"{folder}/once", INVOICES).count() == 2
    assert set(os.listdir(shared)) == before  # no copy of the batch


def test_partitions_replaced_whole_are_not_read(spark, folder, monkeypatch):
    both = invoice("a", date(2024, 1, 5)), invoice("b", date(2024, 2, 5))
    put(spark, folder, *both)
    put(spark, folder, invoice("c", date(2024, 2, 6)))
    read = []
    merge = upsert.merge_rows
    monkeypatch.setattr(upsert, "merge_rows", lambda t, *a, **k: read.append(rows(t, "invoice_id")) or merge(t, *a, **k))
    assert put(spark, folder, *both) == ["2024-01-01", "2024-02-01"]
    assert read == [[("b",), ("c",)]]  # only the month with a row that stays
    assert [r[0] for r in stored(spark, folder)] == ["a", "b", "c"]


def test_columns_that_follow_are_added_after_rows_are_gathered(spark, folder):
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-02-01")], "n int, day string")
    tables.write_partitions(
        df, folder, F.col("day"), finish=lambda moved: moved.withColumn("twice", F.col("n") * 2)
    )
    found = tables.read_parts(spark, folder, spark.createDataFrame([], "n int, twice int").schema)
    assert rows(found, "n", "twice", "part") == [(1, 2, "2024-01-01"), (2, 4, "2024-02-01")]
