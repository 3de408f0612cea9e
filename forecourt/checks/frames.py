"""The model tables over the lens, lazily and each from its own inputs."""

from __future__ import annotations

from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame

from forecourt.functions.workspace import cut_lineage
from forecourt.lens import Lens
from forecourt.operators.joins import told_unique
from forecourt.plans import dimensions, facts, intermediate, marts

# Days covered by the given tables.
FIRST_DAY = date(1995, 1, 1)
LAST_DAY = date(2024, 12, 31)


class LensModels(Lens):
    @cached_property
    def accounts(self) -> DataFrame:
        return self.view("accounts")

    @cached_property
    def products(self) -> DataFrame:
        return self.view("products")

    @cached_property
    def vehicles(self) -> DataFrame:
        return self.view("vehicles")

    @cached_property
    def listings(self) -> DataFrame:
        return self.view("listings")

    @cached_property
    def contracts(self) -> DataFrame:
        return self.view("contracts")

    @cached_property
    def subscriptions(self) -> DataFrame:
        return self.view("subscriptions")

    @cached_property
    def invoices(self) -> DataFrame:
        return self.view("invoices")

    @cached_property
    def staged_lines(self) -> DataFrame:
        """Order lines written once, as a staged table would be: several models read them."""
        return cut_lineage(self.view("line_records").drop("l_quantity", "l_tax"), "zstd")

    @cached_property
    def staged_subscriptions(self) -> DataFrame:
        return self.view("subscriptions", line_records=self.staged_lines)

    @cached_property
    def staged_invoices(self) -> DataFrame:
        return self.view("invoices", line_records=self.staged_lines)

    @cached_property
    def known_contracts(self) -> DataFrame:
        return told_unique(self.contracts, "contract_id")

    @cached_property
    def known_products(self) -> DataFrame:
        return told_unique(self.products, "product_id")

    @cached_property
    def prices(self) -> DataFrame:
        return self.view("prices")

    @cached_property
    def events(self) -> DataFrame:
        return self.view("events_view")

    @cached_property
    def targets(self) -> DataFrame:
        return self.view("targets", accounts=self.accounts)

    @cached_property
    def int_dealer_subscription_snapshot(self) -> DataFrame:
        return intermediate.int_dealer_subscription_snapshot(
            self.staged_subscriptions, self.known_contracts, self.accounts, self.known_products
        )

    @cached_property
    def int_invoice_enriched(self) -> DataFrame:
        return intermediate.int_invoice_enriched(
            self.staged_invoices,
            self.staged_subscriptions,
            self.known_contracts,
            self.accounts,
            self.known_products,
        )

    @cached_property
    def int_listing_engagement(self) -> DataFrame:
        return intermediate.int_listing_engagement(self.listings, self.vehicles, self.events)

    @cached_property
    def int_price_book(self) -> DataFrame:
        return intermediate.int_price_book(self.prices, self.known_products)

    @cached_property
    def int_sales_targets(self) -> DataFrame:
        return intermediate.int_sales_targets(self.targets)

    @cached_property
    def dim_dealer(self) -> DataFrame:
        return dimensions.dim_dealer(self.accounts)

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.products)

    @cached_property
    def known_dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.known_products)

    @cached_property
    def dim_vehicle(self) -> DataFrame:
        return dimensions.dim_vehicle(self.vehicles)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date(self.spark, FIRST_DAY, LAST_DAY)

    @cached_property
    def fact_revenue(self) -> DataFrame:
        return self.revenue_on(self.dim_date)

    def revenue_on(self, calendar: DataFrame) -> DataFrame:
        return facts.revenue_from_staging(
            self.staged_invoices,
            self.staged_subscriptions,
            self.known_contracts,
            self.accounts,
            self.known_products,
            calendar,
            self.dim_dealer,
            self.known_dim_product,
        )

    @cached_property
    def fact_subscription(self) -> DataFrame:
        return self.subscriptions_on(self.dim_date)

    def subscriptions_on(self, calendar: DataFrame) -> DataFrame:
        return facts.subscription_from_staging(
            self.staged_subscriptions,
            self.known_contracts,
            self.accounts,
            self.known_products,
            calendar,
            self.dim_dealer,
            self.known_dim_product,
        )

    @cached_property
    def fact_listing_performance(self) -> DataFrame:
        return facts.fact_listing_performance(
            self.int_listing_engagement, self.dim_date, self.dim_dealer, self.dim_vehicle
        )

    @cached_property
    def fact_sales_target(self) -> DataFrame:
        return facts.fact_sales_target(self.int_sales_targets, self.dim_date)

    @cached_property
    def mart_sales_performance_monthly(self) -> DataFrame:
        return marts.mart_sales_performance_monthly(
            self.fact_revenue, self.fact_sales_target, self.fact_subscription
        )

    @cached_property
    def mart_product_performance_monthly(self) -> DataFrame:
        return marts.mart_product_performance_monthly(
            self.fact_revenue, self.fact_subscription, self.int_price_book, self.known_dim_product
        )

    @cached_property
    def mart_dealer_360(self) -> DataFrame:
        return marts.mart_dealer_360(
            self.dim_dealer,
            self.fact_revenue,
            self.fact_subscription,
            self.fact_listing_performance,
        )

    @cached_property
    def mart_marketplace_funnel_monthly(self) -> DataFrame:
        return marts.mart_marketplace_funnel_monthly(self.events, self.accounts)
