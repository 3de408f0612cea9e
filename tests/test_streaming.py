import gzip
import json
import os

from conftest import rows

from forecourt.plans.layers import Lake, stage_events
from forecourt.sources.raw import RAW_FOLDERS
from forecourt.streaming.events import append_once, read_event_stream, stage_event_stream

EVENTS = "stg_engagement_events"
COLUMNS = ("event_id", "event_timestamp", "event_date", "device")


def deliver(root, day, name, *events):
    path = f"{root}/{RAW_FOLDERS[EVENTS]}/event_date={day}"
    os.makedirs(path, exist_ok=True)
    with gzip.open(f"{path}/{name}.jsonl.gz", "wt") as f:
        f.write("\n".join(json.dumps(e) for e in events))


def event(i, at, device="a"):
    return {"event_id": i, "event_timestamp": at, "listing_id": "L", "device": device}


def fill(root):
    deliver(root, "2024-01-30", "x", event("1", "2024-01-30T01:00:00"), event("2", "2024-01-30T02:00:00"))
    deliver(root, "2024-01-31", "x", event("1", "2024-01-31T01:00:00", "later"), event("3", "bad"))
    deliver(root, "2024-02-01", "x", event("4", "2024-02-01T01:00:00"), event(None, "2024-02-01T01:00:00"))
    deliver(root, "2024-03-02", "x", event("2", "2024-01-30T02:00:00", "same time"))


EXPECTED = ["1", "2", "3", "4"]


def run_stream(spark, lake, checkpoint, **kw):
    stream = read_event_stream(spark, lake.raw_path(EVENTS), **kw)
    stage_event_stream(stream, lake.path(EVENTS), checkpoint).awaitTermination()


def test_one_shot_months_and_stream_agree(spark, folder):
    raw = f"{folder}/raw"
    fill(raw)
    once, months, stream = (Lake(spark, raw, f"{folder}/{n}") for n in ("once", "months", "stream"))
    stage_events(once)
    stage_events(months, by_month=True)
    run_stream(spark, stream, f"{folder}/progress", files_per_batch=1)
    found = rows(once.table(EVENTS), *COLUMNS)
    assert [r[0] for r in found] == EXPECTED
    assert found[0][3] == "later" and found[1][3] == "same time" and found[2][1] is None
    assert rows(months.table(EVENTS), *COLUMNS) == found
    assert rows(stream.table(EVENTS), *COLUMNS) == found


def test_stream_goes_on_where_it_stopped(spark, folder):
    raw = f"{folder}/raw"
    fill(raw)
    lake = Lake(spark, raw, f"{folder}/tables")
    run_stream(spark, lake, f"{folder}/progress")
    before = rows(lake.table(EVENTS), *COLUMNS)
    run_stream(spark, lake, f"{folder}/progress")
    assert rows(lake.table(EVENTS), *COLUMNS) == before
    deliver(raw, "2024-03-03", "new", event("9", "2024-03-03T00:00:00"))
    run_stream(spark, lake, f"{folder}/progress")
    assert [r[0] for r in rows(lake.table(EVENTS), *COLUMNS)] == [*EXPECTED, "9"]


def test_lookback_takes_events_up_to_two_days_late(spark, folder):
    raw = f"{folder}/raw"
    deliver(raw, "2024-01-10", "x", event("a", "2024-01-10T00:00:00"))
    lake = Lake(spark, raw, f"{folder}/tables")
    stage_events(lake)
    deliver(raw, "2024-01-08", "late", event("two days", "2024-01-08T00:00:00"))
    deliver(raw, "2024-01-07", "late", event("three days", "2024-01-07T00:00:00"))
    stage_events(lake)
    assert [r[0] for r in rows(lake.table(EVENTS), "event_id")] == ["a", "two days"]


def test_repeats_are_found_over_restarts_without_reading_earlier_batches(spark, folder):
    raw, out, progress = f"{folder}/raw", f"{folder}/out", f"{folder}/progress"
    path = f"{raw}/{RAW_FOLDERS[EVENTS]}"
    known = []
    for turn in range(4):
        deliver(
            raw, f"2024-01-0{turn + 1}", f"f{turn}",
            event("always", "2024-01-01T00:00:00"), event("always", "2024-01-01T00:00:00"),
            event(f"new {turn}", "2024-01-01T00:00:00"), event(None, "2024-01-01T00:00:00"),
        )
        query = append_once(read_event_stream(spark, path), out, progress)
        query.awaitTermination()
        state = query.lastProgress["stateOperators"][0]
        known.append((state["numRowsTotal"], state["numRowsUpdated"]))
        for batch in os.listdir(out)[:-1]:  # a micro-batch needs none of the earlier ones
            assert batch.startswith("batch=")
    found = [r[0] for r in rows(spark.read.parquet(out), "event_id")]
    assert found == sorted([None, "always", *(f"new {t}" for t in range(4))], key=repr)
    assert known == [(3, 3), (4, 1), (5, 1), (6, 1)]
