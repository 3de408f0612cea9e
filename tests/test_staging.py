import json
import os
from datetime import date, datetime
from decimal import Decimal

from conftest import plan_of, rows
from pyspark.sql import functions as F

from forecourt.operators.latest import latest_record_wins
from forecourt.operators.unnest import unnest_records
from forecourt.plans.staging import STAGES, stage, typed_rows
from forecourt.schemas import RAW_EVENTS, RAW_LISTINGS, RAW_TARGETS, schema_of
from forecourt.sources.raw import read_json_pages, read_listings, read_sales_targets

ACCOUNTS = STAGES["stg_commercial_accounts"]
PAGE = "raw_json string, extract_date string, run_id string, source_file string"


def pages(spark, *records, day="2024-01-01", run="r1", file="f"):
    text = json.dumps({"page": 1, "data": list(records)})
    return spark.createDataFrame([(text, day, run, file)], PAGE)


def test_newest_change_wins_and_null_is_oldest(spark):
    raw = pages(
        spark,
        {"dealer_id": "D1", "dealer_name": "older", "updated_at": "2024-01-01"},
        {"dealer_id": "D1", "dealer_name": "newer", "updated_at": "2024-03-01"},
        {"dealer_id": "D1", "dealer_name": "undated", "updated_at": None},
        {"dealer_id": "D2", "dealer_name": "only", "updated_at": None},
    )
    assert rows(stage(ACCOUNTS, raw), "dealer_id", "dealer_name") == [
        ("D1", "newer"),
        ("D2", "only"),
    ]


def test_extract_date_then_run_break_ties(spark):
    record = {"dealer_id": "D1", "updated_at": "2024-01-01"}
    raw = (
        pages(spark, {**record, "dealer_name": "day 1"}, day="2024-01-01", run="r9")
        .union(pages(spark, {**record, "dealer_name": "day 2 a"}, day="2024-01-02", run="r1"))
        .union(pages(spark, {**record, "dealer_name": "day 2 b"}, day="2024-01-02", run="r2"))
        .union(pages(spark, {**record, "dealer_name": "no day"}, day="later", run="r9"))
    )
    assert rows(stage(ACCOUNTS, raw), "dealer_name") == [("day 2 b",)]


def test_exact_tie_does_not_depend_on_row_order(spark):
    records = [
        {"dealer_id": "D1", "updated_at": "2024-01-01", "dealer_name": n} for n in "abcdefgh"
    ]
    one = rows(stage(ACCOUNTS, pages(spark, *records)), "dealer_name")
    other = rows(stage(ACCOUNTS, pages(spark, *records[::-1]).repartition(4)), "dealer_name")
    assert one == other and len(one) == 1


def test_malformed_values_become_null_and_rows_without_key_go(spark):
    raw = pages(
        spark,
        {"dealer_id": "D1", "created_date": "2024-13-01", "updated_at": "2024-05"},
        {"dealer_id": "D2", "created_date": "2024-02-30"},
        {"dealer_id": "D3", "created_date": "2024-2-3", "updated_at": "2024-01-01T10:00:00"},
        {"dealer_id": None, "dealer_name": "nobody"},
        {"dealer_name": "nobody"},
        {"dealer_id": {"id": 1}},
        7,
    )
    assert rows(stage(ACCOUNTS, raw), "dealer_id", "created_date", "updated_at") == [
        ("D1", None, None),
        ("D2", None, None),
        ("D3", date(2024, 2, 3), None),
    ]


def test_pages_without_records_give_no_rows(spark):
    texts = ['{"data":[]}', '{"data":null}', "{}", "{broken", None]
    raw = spark.createDataFrame([(t, "2024-01-01", "r", "f") for t in texts], PAGE)
    assert stage(ACCOUNTS, raw).count() == 0


def test_nested_values_are_not_scalars(spark):
    raw = pages(
        spark,
        {"a": "{x}", "b": {"c": 1}, "d": [1], "e": "[1]", "f": None, "g": 1.5, "h": True},
        {"a": "plain"},
    ).select("raw_json")
    found = unnest_records(raw, list("abdefgh"))
    assert rows(found) == sorted(
        [
            ("{x}", None, None, "[1]", None, "1.5", "true"),
            ("plain", None, None, None, None, None, None),
        ],
        key=repr,
    )


def test_subscription_types(spark):
    spec = STAGES["stg_commercial_subscriptions"]
    raw = pages(
        spark,
        {"subscription_id": "S1", "contract_price": 375.055, "discount_pct": "6"},
        {"subscription_id": "S2", "contract_price": "99999999999", "discount_pct": "x"},
    )
    assert rows(stage(spec, raw), "subscription_id", "contract_price", "discount_pct") == [
        ("S1", Decimal("375.06"), Decimal("6.0000")),
        ("S2", None, None),
    ]


def test_boolean_words(spark):
    spec = STAGES["stg_pricing_products"]
    words = [True, "TRUE", "t", "1", False, "f", "0", "yes", None]
    raw = pages(spark, *[{"product_id": str(i), "active": w} for i, w in enumerate(words)])
    found = [r[1] for r in rows(stage(spec, raw), "product_id", "active")]
    assert found == [True, True, True, True, False, False, False, None, None]


def test_all_staging_schemas(spark):
    for table, spec in STAGES.items():
        if spec.envelope:
            raw = pages(spark, {spec.key: "K"})
        elif table == "stg_engagement_events":
            raw = spark.createDataFrame([], f"{RAW_EVENTS}, event_date string")
        elif table == "stg_sales_targets":
            raw = spark.createDataFrame([], f"{RAW_TARGETS}, sha256 string")
        else:
            continue
        found = stage(spec, raw).schema
        assert [(f.name, f.dataType) for f in found] == [
            (f.name, f.dataType) for f in schema_of(table)
        ]


def test_predicate_restricts_partitions(spark):
    raw = pages(spark, {"dealer_id": "D1"}, day="2024-01-01").union(
        pages(spark, {"dealer_id": "D2"}, day="2024-01-02")
    )
    found = stage(ACCOUNTS, raw, F.col("extract_date") == "2024-01-02")
    assert rows(found, "dealer_id") == [("D2",)]


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_page_files_and_manifest(spark, folder):
    run = f"{folder}/accounts/extract_date=2024-01-01/run_id=0012"
    page = {"page": 1, "data": [{"dealer_id": "Dé", "dealer_name": "a\u0001b"}]}
    write(f"{run}/page=0001.json", json.dumps(page, ensure_ascii=False))
    write(f"{run}/manifest.json", json.dumps({"data": [{"dealer_id": "wrong"}]}))
    write(f"{run}/_manifest.json", json.dumps({"data": [{"dealer_id": "wrong"}]}))
    found = rows(
        stage(ACCOUNTS, read_json_pages(spark, f"{folder}/accounts")),
        "dealer_id",
        "dealer_name",
        "source_run_id",
        F.col("source_file").endswith("page=0001.json"),
    )
    assert found == [("Dé", "a\u0001b", "0012", True)]


def test_json_lines_keep_rows_with_bad_fields(spark, folder):
    import gzip

    run = f"{folder}/listings/extract_date=2024-01-01/run_id=r1"
    os.makedirs(run)
    lines = [
        {"listing_id": "L1", "asking_price_eur": 19999.5, "created_at": "2025-01-02T00:00:00"},
        {"listing_id": "L2", "asking_price_eur": "much", "listing_start_date": "2025-01-02"},
        {"listing_id": "L3", "asking_price_eur": None},
    ]
    with gzip.open(f"{run}/part-0001.jsonl.gz", "wt") as f:
        f.write("\n".join(json.dumps(line) for line in lines))
    found = stage(STAGES["stg_marketplace_listings"], read_listings(spark, f"{folder}/listings"))
    assert rows(found, "listing_id", "asking_price_eur", "created_at", "listing_start_date") == [
        ("L1", Decimal("19999.50"), datetime(2025, 1, 2), None),
        ("L2", None, None, date(2025, 1, 2)),
        ("L3", None, None, None),
    ]


CSV_HEADER = ",".join(part.split()[0] for part in RAW_TARGETS.split(", "))


def test_target_file_versions(spark, folder):
    old = "T1,2024-01,DE,R1,BASIC,100.00,1.00,3,95.2,BUDGET_2024,2024-01-01"
    new = 'T1,2024-01,DE,"R1, east",BASIC,200.00,,x,95.2,BUDGET_2024_B,2024-02-01'
    full = "T2,2024-03-15,DE,R1,BASIC,1,1,1,1,B,2024-01-01T10:00:00"
    write(f"{folder}/sha256=aa/sales_targets.csv", f"{CSV_HEADER}\n{old}\n")
    write(f"{folder}/sha256=bb/sales_targets.csv", f"{CSV_HEADER}\n{new}\n{full}\n,,,,,,,,,,\n")
    raw = read_sales_targets(spark, folder)
    spec = STAGES["stg_sales_targets"]
    found = rows(
        stage(spec, raw),
        "target_id",
        "target_month",
        "sales_rep",
        "revenue_target_eur",
        "upsell_target_eur",
        "new_dealer_target",
        "source_sha256",
    )
    assert found == [
        ("T1", date(2024, 1, 1), "R1, east", Decimal("200.00"), None, None, "bb"),
        ("T2", date(2024, 3, 1), "R1", Decimal("1.00"), Decimal("1.00"), 1, "bb"),
    ]
    strict = rows(stage(spec, raw, strict=True), "target_id", "target_month", "created_at")
    assert strict == [
        ("T1", None, datetime(2024, 2, 1)),
        ("T2", date(2024, 3, 15), None),
    ]


def test_empty_csv_fields_can_be_kept(spark, folder):
    write(f"{folder}/sha256=aa/sales_targets.csv", f"{CSV_HEADER}\n,,,,,,,,,,x\n")
    kept = read_sales_targets(spark, folder, keep_empty=True)
    assert rows(kept, "target_id", "market", "created_at") == [("", "", "x")]
    assert rows(read_sales_targets(spark, folder), "target_id", "created_at") == [(None, "x")]


def test_hot_key_is_cut_before_the_shuffle(spark):
    raw = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("at"),
    )
    latest = latest_record_wins(raw, ["k"], ["at"])
    assert "WindowGroupLimit" in plan_of(latest) and "Partial" in plan_of(latest)
    assert latest.count() == 40_001
    assert rows(latest.filter("k = 'hot'")) == [("hot", 59_997)]


def test_each_record_is_parsed_once(spark):
    raw = pages(spark, {"dealer_id": "D1"})
    typed = typed_rows(ACCOUNTS, raw)
    plan = plan_of(typed)
    assert plan.count("from_json(StructField(dealer_id") == 1


def test_flat_pages_and_odd_pages_are_read_alike(spark):
    from forecourt.operators.unnest import holds_flat_records, unnest_records

    pages = [
        ('{"page": 1, "data": [{"a": "x", "b": 1.50}, {"a": null, "b": true}]}', [("x", "1.5"), (None, "true")], True),
        ('{"data": [{"a": "{[", "b": "]}"}]}', [("{[", "]}")], False),
        ('{"data": [{"a": {"c": 1}, "b": "y"}, {"a": [1], "b": "z"}]}', [(None, "y"), (None, "z")], False),
        ('{"data": [7, {"a": "x"}]}', [(None, None), ("x", None)], False),
        ('{"data": [null, {"a": "x"}]}', [(None, None), ("x", None)], False),
        ('{"data": [null, {"a": {"k": 1}}]}', [(None, None), (None, None)], True),
        ('{"data": [{"a": 1E400, "b": NaN}]}', [("Infinity", "NaN")], True),
        ('{"meta": {"k": 1}, "data": [{"a": "m"}]}', [("m", None)], False),
        ('{"data": []}', [], False),
        ('{"data": [{"a": "x"}', [], False),
        ("no json", [], False),
        (None, [], False),
    ]
    raw = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)], "no int, raw_json string")
    found = [tuple(r) for r in unnest_records(raw, ["a", "b"]).orderBy("no").collect()]
    wanted = [(i, *r) for i, p in enumerate(pages) for r in p[1]]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    read = F.from_json("raw_json", "data array<struct<a: string, b: string>>").getField("data")
    flat = raw.select("no", holds_flat_records(F.col("raw_json"), read).alias("flat")).collect()
    assert {r.no for r in flat if r.flat} <= {i for i, p in enumerate(pages) if p[2] or p[0] == '{"data": []}'}
