from datetime import date

from conftest import rows

from forecourt.plans.refresh import refresh_months
from forecourt.sources import tables

FACT = "fact_revenue"


def invoices(spark, *records):
    return spark.createDataFrame(records, "invoice_id string, invoice_date date, subscription_id string")


def test_touched_months_only_and_equal_to_the_full_fact(spark, folder):
    built = []

    def build(status):
        def facts(base):
            built.append(sorted(r[0] for r in base.collect()))
            parents = spark.createDataFrame(list(status.items()), "subscription_id string, currency string")
            full = base.join(parents, "subscription_id", "left")
            from forecourt.schemas import schema_of
            from pyspark.sql import functions as F

            have = set(full.columns)
            return full.select(
                *[
                    (F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in schema_of(FACT)
                ]
            )

        return facts

    def refresh(base, status, **changed):
        keys = {c: spark.createDataFrame([(k,) for k in ks], f"{c} string") for c, ks in changed.items()}
        return refresh_months(folder, FACT, "invoice_id", "invoice_date", base, build(status), keys)

    def stored():
        return rows(tables.read_partitions(spark, folder, FACT), "invoice_id", "currency", "part")

    first = invoices(
        spark, ("a", date(2024, 1, 5), "s"), ("b", date(2024, 2, 5), "s"), ("c", date(2024, 3, 5), "t"), ("n", None, "t")
    )
    assert refresh(first, {"s": "on", "t": "on"}, invoice_id=[]) == ["2024-01-01", "2024-02-01", "2024-03-01", "none"]
    march = tables.partition_folders(spark, folder)["2024-03-01"]
    # a moves from January to April; the subscription of a and b changes.
    second = invoices(
        spark, ("a", date(2024, 4, 5), "s"), ("b", date(2024, 2, 5), "s"), ("c", date(2024, 3, 5), "t"), ("n", None, "t")
    )
    months = refresh(second, {"s": "off", "t": "on"}, invoice_id=["a"], subscription_id=["s"])
    assert months == ["2024-01-01", "2024-02-01", "2024-04-01"] and built[-1] == ["a", "b"]
    assert tables.partition_folders(spark, folder)["2024-03-01"] == march
    assert stored() == [
        ("a", "off", "2024-04-01"), ("b", "off", "2024-02-01"), ("c", "on", "2024-03-01"), ("n", "on", "none")
    ]
    assert refresh(second, {"s": "off", "t": "gone"}, invoice_id=[], subscription_id=["t"]) == ["2024-03-01", "none"]
    assert [r[1] for r in stored()] == ["off", "off", "gone", "gone"]
    assert refresh(second, {}, invoice_id=[]) == []


def test_partitions_hold_hashed_keys_in_half_their_text(spark, folder):
    import os

    keys = spark.range(20_000).selectExpr("upper(md5(cast(id AS string))) AS dealer_key", "DATE '2024-01-01' AS day")
    tables.write_partitions(keys, folder, tables.partition_value("day", True))
    size = sum(os.path.getsize(f"{d}/{f}") for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))
    assert size < 20_000 * 32 * 0.7
