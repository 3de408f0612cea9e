import gzip
import json
import os
import shutil
from datetime import date, datetime
from decimal import Decimal

import pytest
from conftest import DATA, rows
from pyspark.sql import functions as F

from forecourt.checks.registry import QUERIES
from forecourt.functions import workspace
from forecourt.operators import incremental
from forecourt.operators.unnest import unnest_records
from forecourt.schemas import RAW_VEHICLES, TARGET_COLUMNS
from forecourt.sources.tables import move_folder
from forecourt.sources import landing, raw


def test_rows_as_json(spark):
    df = spark.createDataFrame(
        [("é", date(2024, 1, 2), datetime(2024, 1, 2, 3, 4, 5), Decimal("1.50"), None)],
        "a string, b date, c timestamp_ntz, d decimal(5,2), e string",
    )
    line = rows(landing.json_encode_rows(df))[0][0]
    assert line == '{"a":"é","b":"2024-01-02","c":"2024-01-02T03:04:05","d":1.50,"e":null}'
    assert json.loads(line)["d"] == 1.5


def test_json_lines_round_trip_in_small_files(spark, folder):
    df = spark.range(1, 2501).select(
        F.concat(F.lit("V"), "id").alias("vehicle_id"),
        F.col("id").cast("int").alias("mileage_km"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("updated_at"),
    )
    target = landing.run_folder(spark, folder, "2024-01-01", "a:b+c")
    landing.land_json_lines(df.coalesce(1), target, rows_per_file=1000)
    assert target.endswith("run_id=a-b_c")
    assert len([f for f in os.listdir(target) if f.endswith(".gz")]) == 3
    found = raw.read_json_lines(spark, folder, RAW_VEHICLES)
    assert found.count() == 2500
    assert rows(found.select("extract_date", "run_id", "updated_at").distinct()) == [
        ("2024-01-01", "a-b_c", "2024-01-01T00:00:00")
    ]


def source(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, updated_at timestamp_ntz")


def test_incremental_runs_do_not_overlap(spark, folder):
    first = source(spark, ("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2)))
    second = first.union(source(spark, ("a", datetime(2024, 1, 3)), ("c", datetime(2024, 1, 2))))
    paths = (f"{folder}/m", f"{folder}/w")
    assert landing.incremental_extract(first.limit(0), folder, "d", "x", "r0", *paths) is None
    landing.incremental_extract(first, folder, "d", "2024-01-02", "r1", *paths)
    target = landing.incremental_extract(second, folder, "d", "2024-01-03", "r2", *paths)
    assert rows(spark.read.schema("id string").json(target)) == [("a",)]
    manifests = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(paths[0])
    assert rows(manifests, "mode", "previous_watermark", "new_watermark", "records") == [
        ("full", None, "2024-01-02 00:00:00", 2),
        ("incremental", "2024-01-02 00:00:00", "2024-01-03 00:00:00", 1),
    ]


def test_watermark_stays_when_landing_fails(spark, folder, monkeypatch):
    rows_in = source(spark, ("a", datetime(2024, 1, 1)))

    def broken(*_, **__):
        raise RuntimeError("no space")

    with monkeypatch.context() as m:
        m.setattr(landing, "write_manifest", broken)
        with pytest.raises(RuntimeError):
            landing.incremental_extract(rows_in, folder, "d", "x", "r1", f"{folder}/m", f"{folder}/w")
    assert incremental.read_watermark(spark, f"{folder}/w", "d") is None
    landing.incremental_extract(rows_in, folder, "d", "x", "r1", f"{folder}/m", f"{folder}/w")
    assert incremental.read_watermark(spark, f"{folder}/w", "d") == "2024-01-01 00:00:00"


def test_a_repeated_run_touches_nothing(spark, folder, monkeypatch):
    rows_in = source(spark, ("a", datetime(2024, 1, 1)), ("b", datetime(2024, 1, 2)))
    paths = (f"{folder}/m", f"{folder}/w")
    with monkeypatch.context() as m:  # dies between its manifest row and its mark
        m.setattr(landing, "commit_watermark", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.incremental_extract(rows_in, folder, "d", "2024-01-02", "r1", *paths)
    for _again in range(2):
        target = landing.incremental_extract(rows_in, folder, "d", "2024-01-02", "r1", *paths)
        assert rows(spark.read.schema("id string").json(target)) == [("a",), ("b",)]
        assert incremental.read_watermark(spark, paths[1], "d") == "2024-01-02 00:00:00"
    manifests = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(paths[0])
    assert rows(manifests, "run_id", "records") == [("r1", 2)]


def test_days_without_lines_stay_open(spark, folder):
    src, dst, ledger, notes = (f"{folder}/{n}" for n in "sdln")
    put_day(src, "2024-01-01", {"event_id": "1"})
    put_day(src, "bad", {"event_id": "2"})
    os.makedirs(f"{src}/event_date=2024-01-02")
    with open(f"{src}/event_date=2024-01-02/events.csv", "w") as f:
        f.write("event_id")
    assert landing.land_new_days(spark, src, dst, ledger, notes, "r1") == ["2024-01-01"]
    assert landing.land_new_days(spark, src, dst, ledger, notes, "r2") == []
    put_day(src, "2024-01-02", {"event_id": "3"})
    assert landing.land_new_days(spark, src, dst, ledger, notes, "r3") == ["2024-01-02"]
    manifests = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(notes)
    assert rows(manifests.filter("run_id <> 'r2'"), "run_id", "extract_date", "mode") == [
        ("r1", "2024-01-01", "copied"),
        ("r1", "2024-01-02", "invalid"),
        ("r1", "bad", "invalid"),
        ("r3", "2024-01-01", "skipped"),
        ("r3", "2024-01-02", "copied"),
        ("r3", "bad", "invalid"),
    ]


def test_days_are_noted_after_the_copy_and_once(spark, folder, monkeypatch):
    src, dst, ledger, notes = (f"{folder}/{n}" for n in "sdln")
    put_day(src, "2024-01-01", {"event_id": "1"}, {"event_id": "2"})
    with monkeypatch.context() as m:  # dies between the copy and its manifest
        m.setattr(landing, "_note_days", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            landing.land_new_days(spark, src, dst, ledger, notes, "r1")
    assert not os.path.exists(notes)
    landing.land_new_days(spark, src, dst, ledger, notes, "r1")
    shutil.rmtree(ledger)  # died between its manifest and its ledger
    landing.land_new_days(spark, src, dst, ledger, notes, "r1")
    manifests = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(notes)
    assert rows(manifests, "mode", "records", "parts") == [("copied", 2, 1)]


def test_content_lands_whole_before_its_manifest(spark, folder, monkeypatch):
    src, dst, notes = (f"{folder}/{n}" for n in "sdn")
    os.makedirs(src)
    for name in ("a", "b"):
        with open(f"{src}/{name}.csv", "w") as f:
            f.write(f"x\n{name}")
    moves = []

    def move(spark, path, target):
        if moves:
            raise OSError("lost")
        moves.append(move_folder(spark, path, target))

    with monkeypatch.context() as m:  # dies between two moves
        m.setattr(landing, "move_folder", move)
        with pytest.raises(OSError):
            landing.land_by_content(spark, src, dst, notes, "r1")
    assert not os.path.exists(notes)
    assert landing.land_by_content(spark, src, dst, notes, "r1").count() == 2
    lines = spark.read.text(dst)
    assert rows(lines, "value") == [("a",), ("b",), ("x",), ("x",)]
    manifests = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(notes)
    assert rows(manifests, "mode") == [("copied",), ("skipped",)]


def test_an_empty_table_lands_with_no_records(spark, folder):
    empty = source(spark, ("a", datetime(2024, 1, 1))).filter("id = 'none'")
    landing.snapshot_extract(empty, folder, "d", "2024-01-01", "r1", f"{folder}/m")
    manifest = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(f"{folder}/m")
    assert rows(manifest, "records") == [(0,)]


def test_pages_land_and_come_back(spark, folder):
    df = spark.range(250).select(
        F.lpad(F.col("id").cast("string"), 4, "0").alias("id"),
        F.lit(date(2024, 1, 1)).alias("updated_at"),
    )
    landing.land_pages(
        df, f"{folder}/p", "d", "2024-01-01", "r1", f"{folder}/m", f"{folder}/w", ["id"], page_size=100
    )
    found = unnest_records(raw.read_json_pages(spark, f"{folder}/p"), ["id", "updated_at"])
    assert rows(found, "id", "updated_at") == [(f"{i:04d}", "2024-01-01") for i in range(250)]
    manifest = spark.read.schema(landing.MANIFEST_SCHEMA).parquet(f"{folder}/m")
    assert rows(manifest, "records", "parts") == [(250, 3)]


def put_day(folder, day, *events):
    path = f"{folder}/event_date={day}"
    os.makedirs(path, exist_ok=True)
    with gzip.open(f"{path}/events.jsonl.gz", "wt") as f:
        f.write("\n".join(json.dumps(e) for e in events))


def landed(spark, folder):
    found = raw.read_events(spark, folder)
    return rows(found, "event_id", "event_timestamp", "event_date")


def test_days_land_once(spark, folder):
    src, dst, ledger = f"{folder}/s", f"{folder}/d", f"{folder}/l"
    put_day(src, "2024-01-01", {"event_id": "1", "timestamp": "t1"})
    put_day(src, "2024-1-2", {"event_id": "bad folder"})
    assert landing.land_new_days(spark, src, dst, ledger) == ["2024-01-01"]
    put_day(src, "2024-01-01", {"event_id": "changed"})
    put_day(src, "2024-01-02", {"event_id": "2", "event_timestamp": "t2"})
    assert landing.land_new_days(spark, src, dst, ledger) == ["2024-01-02"]
    assert landing.land_new_days(spark, src, dst, ledger) == []
    assert landed(spark, dst) == [("1", "t1", "2024-01-01"), ("2", "t2", "2024-01-02")]


def test_half_landed_day_is_repaired(spark, folder):
    src, dst, ledger = f"{folder}/s", f"{folder}/d", f"{folder}/l"
    put_day(src, "2024-01-01", {"event_id": "1"}, {"event_id": "2"})
    # A run that died before its ledger row left a file behind.
    os.makedirs(f"{dst}/event_date=2024-01-01")
    with gzip.open(f"{dst}/event_date=2024-01-01/part-0.txt.gz", "wt") as f:
        f.write('{"event_id":"1"}\n')
    landing.land_new_days(spark, src, dst, ledger)
    assert [r[0] for r in landed(spark, dst)] == ["1", "2"]


def test_same_content_lands_once(spark, folder):
    import hashlib

    header = ",".join(TARGET_COLUMNS)
    contents = {"a.csv": f"{header}\nT1,,,,,,,,,,\n", "b.csv": f"{header}\nT2,,,,,,,,,,"}
    os.makedirs(f"{folder}/in")
    for name, text in {**contents, "copy.csv": contents["a.csv"]}.items():
        with open(f"{folder}/in/{name}", "w") as f:
            f.write(text)
    for _ in range(2):
        digests = rows(landing.land_by_content(spark, f"{folder}/in", f"{folder}/out"))
        assert digests == sorted((hashlib.sha256(t.encode()).hexdigest(),) for t in contents.values())
    found = raw.read_sales_targets(spark, f"{folder}/out")
    assert rows(found, "target_id", F.length("sha256")) == [("T1", 64), ("T2", 64)]


def test_required_columns(spark):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert landing.require_columns(df, ["x"]) is df
    with pytest.raises(ValueError, match=r"\['z'\]"):
        landing.require_columns(df, ["x", "z"])
    with pytest.raises(ValueError, match="no rows"):
        landing.require_columns(df.limit(0), ["x"])


def test_scratch_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.scratch_path(spark, "x").startswith(root.rstrip("/") + "/x-")
    cut = workspace.cut_lineage(spark.range(5))
    assert rows(cut) == [(i,) for i in range(5)]


def test_unnested_account_pages_have_the_columns_of_the_sql(spark):
    columns = QUERIES["unnest_join"](spark, DATA).columns
    assert columns == ["page", "dealer_id", "dealer_name", "market", "segment", "sales_rep"]
