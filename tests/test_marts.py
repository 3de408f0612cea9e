"""Marts over hand-made facts, and against a plain Python count of the same rows."""

import random
from collections import defaultdict
from datetime import date, datetime
from decimal import ROUND_HALF_UP, Decimal

import pytest
from conftest import plan_of, rows

from forecourt.functions.keys import hash_key
from forecourt.plans import dimensions, facts, intermediate, marts
from forecourt.schemas import column_types, schema_of
from pyspark.sql import functions as F


def frame(spark, table, *records):
    names = schema_of(table).names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema_of(table))


def money(text):
    return Decimal(text)


JAN, FEB = date(2024, 1, 1), date(2024, 2, 1)


def test_sales_mart(spark):
    revenue = frame(
        spark,
        "fact_revenue",
        dict(invoice_id="1", invoice_date=date(2024, 1, 9), market="DE", sales_rep="R", product_family="A", invoice_amount=money("100.10"), dealer_id="D1"),
        dict(invoice_id="2", invoice_date=date(2024, 1, 31), market="DE", sales_rep="R", product_family="A", invoice_amount=money("0.05"), dealer_id="D1"),
        dict(invoice_id="3", invoice_date=date(2024, 1, 1), market=None, sales_rep=None, product_family=None, invoice_amount=None, dealer_id=None),
        dict(invoice_id="4", invoice_date=None, market="DE", sales_rep="R", product_family="A", invoice_amount=money("9.00")),
    )
    targets = frame(
        spark,
        "fact_sales_target",
        dict(target_id="1", target_month=date(2024, 1, 1), market="DE", sales_rep="R", product_group="A", revenue_target_eur=money("300.00"), upsell_target_eur=money("1.00"), new_dealer_target=3, retention_target_pct=money("95.0000")),
        dict(target_id="2", target_month=date(2024, 1, 20), market="DE", sales_rep="R", product_group="A", revenue_target_eur=money("7.00"), new_dealer_target=4, retention_target_pct=money("95.0001")),
        dict(target_id="3", target_month=date(2024, 2, 1), market="DE", sales_rep="R", product_group="A", revenue_target_eur=money("0.00")),
        dict(target_id="4", target_month=None, market="DE", sales_rep="R", product_group="A", revenue_target_eur=money("5.00")),
    )
    subs = frame(
        spark,
        "fact_subscription",
        dict(subscription_id="1", subscription_start_date=date(2024, 2, 3), subscription_status="Active", market="IT", sales_rep="S", product_family="B"),
        dict(subscription_id="2", subscription_start_date=date(2024, 2, 3), subscription_status="CANCELLED", market="XX", sales_rep="S", product_family="B"),
        dict(subscription_id="3", subscription_start_date=None, subscription_status="ACTIVE", market="XX"),
        dict(subscription_id="4", subscription_start_date=date(2024, 2, 3), subscription_status=None, market="XX"),
    )
    mart = marts.mart_sales_performance_monthly(revenue, targets, subs)
    assert [f.name for f in mart.schema] == list(column_types("mart_sales_performance_monthly"))
    z = money("0.00")
    assert rows(mart.drop("performance_key", "refreshed_at")) == sorted(
        [
            (JAN, "DE", "R", "A", money("100.15"), money("307.00"), money("1.00"), 7, money("95.0001"), money("32.6221"), 2, 1, 0),
            (JAN, "UNKNOWN", "UNKNOWN", "UNKNOWN", z, z, z, 0, money("0.0000"), None, 1, 0, 0),
            (FEB, "DE", "R", "A", z, z, z, 0, money("0.0000"), None, 0, 0, 0),
            (FEB, "IT", "S", "B", z, z, z, 0, money("0.0000"), None, 0, 0, 1),
        ],
        key=repr,
    )
    rounded = marts.mart_sales_performance_monthly(revenue, targets, subs, first_round=3)
    assert rows(rounded.filter("market = 'DE' and invoice_count > 0"), "attainment_pct") == [
        (money("32.6220"),)
    ]
    keys = rows(mart.filter("market = 'IT'"), "performance_key")
    expected = spark.range(1).select(hash_key(F.lit(FEB), F.lit("IT"), F.lit("S"), F.lit("B")))
    assert keys == rows(expected)


def test_funnel_mart(spark):
    def event(i, kind, day=date(2024, 1, 5), dealer="D1", session="s", listing="L"):
        return dict(event_id=str(i), event_date=day, event_type=kind, dealer_id=dealer, session_id=session, listing_id=listing)

    events = frame(
        spark,
        "stg_engagement_events",
        event(1, "view"), event(2, "VIEW", session="t"), event(3, "View", listing=None),
        event(4, "click"), event(5, "lead"), event(6, None),
        event(7, "click", dealer="D9"), event(8, "view", dealer=None), event(9, "view", day=None),
    )
    accounts = frame(
        spark,
        "stg_commercial_accounts",
        dict(dealer_id="D1", market="DE"),
        dict(dealer_id="D2", market="IT"),
    )
    mart = marts.mart_marketplace_funnel_monthly(events, accounts)
    assert rows(mart.drop("funnel_key", "refreshed_at")) == [
        (JAN, "DE", 3, 1, 1, 2, 1, 1, money("33.3333"), money("33.3333")),
        (JAN, "UNKNOWN", 1, 1, 0, 1, 1, 1, money("100.0000"), money("0.0000")),
    ]
    strict = marts.mart_marketplace_funnel_monthly(events, accounts, keep_null_months=True, first_round=1)
    assert rows(strict, "month_start", "views", "lead_rate_pct", F.col("funnel_key").isNull()) == sorted(
        [
            (JAN, 3, money("33.3000"), False),
            (JAN, 1, money("0.0000"), False),
            (None, 1, money("0.0000"), True),
        ],
        key=repr,
    )
    # The marketplace's own event names.
    named = events.withColumn("event_type", F.lit("EMAIL_LEAD"))
    mapped = marts.mart_marketplace_funnel_monthly(named, accounts, stages=intermediate.MARKETPLACE_STAGES)
    assert rows(mapped, "views", "leads") == [(0, 2), (0, 6)]


def test_dealer_mart_keeps_every_dealer(spark):
    dealers = frame(spark, "dim_dealer", dict(dealer_id="D1"), dict(dealer_id="D2"))
    revenue = frame(
        spark,
        "fact_revenue",
        dict(invoice_id="1", dealer_id="D1", invoice_amount=money("5.00"), invoice_date=JAN),
        dict(invoice_id="2", dealer_id="D1", invoice_amount=None, invoice_date=FEB),
        dict(invoice_id="3", dealer_id=None, invoice_amount=money("7.00")),
    )
    subs = frame(
        spark,
        "fact_subscription",
        dict(subscription_id="1", dealer_id="D1", product_id="P", subscription_status="ACTIVE", discount_pct=money("1.0000")),
        dict(subscription_id="2", dealer_id="D1", product_id="P", subscription_status="x", discount_pct=money("2.0001")),
    )
    at = datetime(2024, 3, 1, 10)
    listings = frame(
        spark,
        "fact_listing_performance",
        dict(listing_id="1", dealer_id="D1", listing_status="Active", views=7, clicks=1, leads=3, last_event_at=at),
        dict(listing_id="2", dealer_id="D1", listing_status="SOLD", views=0, clicks=0, leads=0),
    )
    mart = marts.mart_dealer_360(dealers, revenue, subs, listings)
    columns = list(column_types("mart_dealer_360"))[7:-1]
    assert rows(mart, "dealer_id", *columns) == [
        ("D1", money("5.00"), 2, 1, 1, money("1.5001"), 2, 1, 7, 1, 3, money("42.8571"), FEB, at),
        ("D2", money("0.00"), 0, 0, 0, money("0.0000"), 0, 0, 0, 0, 0, None, None, None),
    ]


def test_product_mart(spark):
    revenue = frame(
        spark,
        "fact_revenue",
        dict(invoice_id="1", dealer_id="D1", product_id="P", market="DE", invoice_amount=money("10.00"), invoice_date=JAN),
        dict(invoice_id="2", dealer_id="D2", product_id="P", market="DE", invoice_amount=money("0.01"), invoice_date=JAN),
        dict(invoice_id="3", dealer_id="D2", product_id=None, market="DE", invoice_amount=money("1.00"), invoice_date=JAN),
        dict(invoice_id="4", dealer_id="D2", product_id="P", market="DE", invoice_amount=money("1.00")),
    )
    subs = frame(
        spark,
        "fact_subscription",
        dict(subscription_id="1", product_id="P", market="DE", subscription_start_date=FEB, subscription_status="active", contract_price=money("1.00"), discount_pct=money("5.0000")),
        dict(subscription_id="2", product_id="P", market="DE", subscription_start_date=FEB, contract_price=money("1.01")),
    )
    prices = frame(
        spark,
        "int_price_book",
        dict(price_id="1", product_id="P", market="DE", effective_from=FEB, list_price=money("3.00")),
        dict(price_id="2", product_id="Q", market=None, effective_from=FEB, list_price=money("4.00")),
    )
    products = frame(spark, "dim_product", dict(product_id="P", product_name="n", product_family="f"))
    mart = marts.mart_product_performance_monthly(revenue, subs, prices, products)
    columns = list(column_types("mart_product_performance_monthly"))[1:-1]
    z = money("0.00")
    assert rows(mart, *columns) == sorted(
        [
            (JAN, "DE", "P", "n", "f", money("10.01"), 2, 2, 0, None, None, None, money("5.01")),
            (FEB, "DE", "P", "n", "f", z, 0, 0, 1, money("1.01"), money("5.0000"), money("3.00"), None),
            (FEB, "UNKNOWN", "Q", None, None, z, 0, 0, 0, None, None, money("4.00"), None),
        ],
        key=repr,
    )
    strict = marts.mart_product_performance_monthly(revenue, subs, prices, products, keep_null_months=True)
    assert rows(strict.filter("month_start is null"), "revenue_eur", "product_month_key") == [
        (money("1.00"), None)
    ]


def test_sales_mart_against_plain_python(spark):
    rng = random.Random(7)
    invoices = [
        dict(
            invoice_id=str(i),
            invoice_date=date(2024, rng.randint(1, 3), rng.randint(1, 28)),
            # One market holds most of the rows.
            market=rng.choice(["DE", "DE", "DE", "IT", None]),
            sales_rep=rng.choice(["R1", "R2"]),
            product_family="F",
            invoice_amount=Decimal(rng.randint(1, 10**6)) / 100,
            dealer_id=f"D{rng.randint(1, 40)}",
        )
        for i in range(3000)
    ]
    plan = [
        dict(target_id=f"{m}{k}{r}", target_month=date(2024, m, 1), market=k, sales_rep=r, product_group="F", revenue_target_eur=Decimal(rng.randint(10**5, 10**7)) / 100)
        for m in (1, 2, 4) for k in ("DE", "NL") for r in ("R1", "R2")
    ]
    expected = defaultdict(lambda: [Decimal(0), set(), 0, Decimal(0)])
    for i in invoices:
        group = expected[(i["invoice_date"].replace(day=1), i["market"] or "UNKNOWN", i["sales_rep"])]
        group[0] += i["invoice_amount"]
        group[1].add(i["dealer_id"])
        group[2] += 1
    for t in plan:
        expected[(t["target_month"], t["market"], t["sales_rep"])][3] += t["revenue_target_eur"]
    mart = marts.mart_sales_performance_monthly(
        frame(spark, "fact_revenue", *invoices),
        frame(spark, "fact_sales_target", *plan),
        frame(spark, "fact_subscription"),
    )
    found = rows(mart, "month_start", "market", "sales_rep", "revenue_eur", "revenue_dealer_count", "invoice_count", "attainment_pct")
    wanted = []
    for (month, market, rep), (amount, dealers, n, target) in expected.items():
        pct = None
        if target:
            pct = (100 * amount / target).quantize(Decimal("0.0001"), ROUND_HALF_UP)
        wanted.append((month, market, rep, amount.quantize(Decimal("0.01")), len(dealers), n, pct))
    assert found == sorted(wanted, key=repr)


def test_facts_resolve_keys_and_keep_unresolved_rows(spark):
    days = dimensions.dim_date(spark, date(2024, 1, 1), date(2024, 12, 31))
    dealers = dimensions.dim_dealer(frame(spark, "stg_commercial_accounts", dict(dealer_id="D1")))
    products = dimensions.dim_product(frame(spark, "stg_pricing_products", dict(product_id="P1")))
    snapshot = frame(
        spark,
        "int_dealer_subscription_snapshot",
        dict(subscription_id="1", dealer_id="D1", product_id="P1", subscription_start_date=date(2024, 3, 1), subscription_end_date=date(2024, 5, 1)),
        dict(subscription_id="2", dealer_id="DX", product_id=None, subscription_start_date=date(2023, 3, 1)),
    )
    fact = facts.fact_subscription(snapshot, days, dealers, products)
    found = rows(fact, "subscription_id", "start_date_key", "end_date_key", F.col("dealer_key").isNull(), F.col("product_key").isNull())
    assert found == [("1", 20240301, 20240501, False, False), ("2", None, None, True, True)]


def test_invoice_takes_contract_and_product_from_its_subscription(spark):
    enriched = intermediate.int_invoice_enriched(
        frame(spark, "stg_commercial_invoices", dict(invoice_id="1", subscription_id="S", dealer_id="D2"), dict(invoice_id="2", subscription_id="gone", dealer_id="D1")),
        frame(spark, "stg_commercial_subscriptions", dict(subscription_id="S", contract_id="C", dealer_id="D1", product_id="P", subscription_status="ACTIVE")),
        frame(spark, "stg_commercial_contracts", dict(contract_id="C", contract_status="EXPIRED")),
        frame(spark, "stg_commercial_accounts", dict(dealer_id="D1", market="DE"), dict(dealer_id="D2", market="IT")),
        frame(spark, "stg_pricing_products", dict(product_id="P", product_family="F")),
    )
    assert rows(enriched, "invoice_id", "market", "contract_status", "product_family", "subscription_status") == [
        ("1", "IT", "EXPIRED", "F", "ACTIVE"),
        ("2", "DE", None, None, None),
    ]


def test_listing_without_events_counts_zero(spark):
    fact = intermediate.int_listing_engagement(
        frame(spark, "stg_marketplace_listings", dict(listing_id="L1", vehicle_id="V1"), dict(listing_id="L2")),
        frame(spark, "stg_marketplace_vehicles", dict(vehicle_id="V1", make="m")),
        frame(spark, "stg_engagement_events", dict(event_id="1", listing_id="L1", event_type="VIEW", session_id="s", event_timestamp=datetime(2024, 1, 1)), dict(event_id="2", listing_id="L1", event_type="x", session_id="s", event_timestamp=datetime(2024, 1, 2)), dict(event_id="3", listing_id=None, event_type="view")),
    )
    assert rows(fact, "listing_id", "make", "views", "leads", "engagement_events", "unique_sessions", "last_event_at") == [
        ("L1", "m", 1, 0, 2, 1, datetime(2024, 1, 2)),
        ("L2", None, 0, 0, 0, 0, None),
    ]


def invoice_parents(spark):
    """Invoices with unknown and absent ids beside their parents and dimensions."""
    staged = {
        "invoices": spark.createDataFrame(
            [("i1", "s1", "d1"), ("i2", "s2", "d2"), ("i3", None, "d9"), ("i4", "s9", None), ("i5", "s3", "d1")],
            "invoice_id string, subscription_id string, dealer_id string",
        ).selectExpr(
            "*", "DATE '2024-05-06' AS invoice_date", "CAST(7 AS decimal(14,2)) AS invoice_amount",
            "'EUR' AS currency", "'OPEN' AS payment_status", "DATE '2024-05-06' AS updated_at",
        ),
        "subscriptions": spark.createDataFrame(
            [("s1", "c1", "p1"), ("s2", None, "p9"), ("s3", "c9", None), ("s4", "c1", "p1")],
            "subscription_id string, contract_id string, product_id string",
        ).selectExpr(
            "*", "'MONTHLY' AS billing_frequency", "CAST(5 AS decimal(12,2)) AS contract_price",
            "CAST(1 AS decimal(7,4)) AS discount_pct", "'ACTIVE' AS subscription_status",
        ),
        "contracts": spark.createDataFrame([("c1", "ACTIVE")], "contract_id string, contract_status string"),
        "accounts": spark.createDataFrame(
            [("d1", "Ann", "EU", "A", "R1")],
            "dealer_id string, dealer_name string, market string, segment string, sales_rep string",
        ),
        "products": spark.createDataFrame(
            [("p1", "Plan", "BASIC")], "product_id string, product_name string, product_family string"
        ),
    }
    days = dimensions.dim_date(spark, date(2024, 5, 1), date(2024, 5, 31))
    dealers = spark.createDataFrame([("d1", "D1"), ("d2", "D2")], "dealer_id string, dealer_key string")
    products = spark.createDataFrame([("p1", "P1"), ("p9", "P9")], "product_id string, product_key string")
    return staged, (days, dealers, products)


@pytest.mark.parametrize("few", [False, True])
def test_revenue_from_staging_equals_the_fact_of_written_rows(spark, few):
    staged, dims = invoice_parents(spark)
    enriched = intermediate.int_invoice_enriched(**staged, at="2024-06-01")
    written = facts.fact_revenue(enriched, *dims, at="2024-06-01")
    direct = facts.revenue_from_staging(*staged.values(), *dims, at="2024-06-01", few=few)
    assert rows(direct) == rows(written) and direct.schema == written.schema
    found = {r.invoice_id: r for r in direct.collect()}
    assert len(found) == 5
    assert (found["i1"].dealer_key, found["i1"].product_key, found["i1"].market) == ("D1", "P1", "EU")
    # A key does not hang on the parent, only on the id.
    assert (found["i2"].dealer_key, found["i2"].product_key, found["i2"].market) == ("D2", "P9", None)
    assert (found["i3"].dealer_key, found["i3"].product_key) == (None, None)
    assert (found["i4"].subscription_id, found["i4"].product_id) == ("s9", None)


def test_invoices_stay_out_of_the_lookups_of_their_subscriptions(spark):
    staged, _ = invoice_parents(spark)
    plan = intermediate.int_invoice_enriched(**staged)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    tops = [i for i, line in enumerate(lines) if "Join" in line and ("contract_id" in line or "product_id" in line)]
    assert len(tops) == 2
    for top in tops:
        below = []
        for line in lines[top + 1 :]:
            if depth(line) <= depth(lines[top]):
                break
            below.append(line)
        assert below and not any("invoice_amount" in line for line in below)


def test_a_fact_from_staging_moves_its_rows_once_for_each_id(spark):
    staged, dims = invoice_parents(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enriched = intermediate.int_invoice_enriched(**staged)
        twice = plan_of(facts.fact_revenue(enriched, *dims)).count("Exchange hashpartitioning")
        once = plan_of(facts.revenue_from_staging(*staged.values(), *dims)).count("Exchange hashpartitioning")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The dimensions of dealer and product are moved, the rows are not moved for them again.
    assert once == twice - 2
