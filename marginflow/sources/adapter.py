"""Commerce star schema derived from the driver's order/line/customer/event tables.

Mapping (one prospect per customer, one order per order in the analysis window):

* prospect: market from the customer's region, channel from the market segment,
  ``converted`` = the customer has an order on or after the campaign start;
* customer: one per customer key that orders name, acquired on the date of its first order;
* order: every order; amounts in thousandths of the line prices, each rounded to cents.  An order
  without lines has zero amounts and no delivery; one whose customer is unknown keeps its row
  with NULL attributes, so that the quality checks report it;
* delivery: one per order with lines; carrier from the lowest supplier key, delivered on the last
  ship date;
* marketing spend: event values by month, user bucket and event type.

All amounts are exact ``decimal(18,2)``; source values finer than the units stop the job rather
than be rounded.  Plans only: nothing here triggers a job.

Scale notes.  ``lineitem`` is the only large input; it is aggregated per order with
map-side partial aggregation before it is shuffled, so the shuffle carries one row per
order and map partition.  The only explicit broadcast is the hot-key table of the salted
orders-to-customer join (fewer than P/2 rows by construction); all other joins are left to AQE
(sort-merge, or broadcast when the runtime size is under the threshold).  The
first order of a customer is a hash-aggregated ``min`` of a packed (day, order key), not a
window, so a customer holding a third of all orders is combined map-side, and that customer's
orders are spread over several join tasks by salting.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import surrogate_key
from ..functions.numeric import MONEY, clamp
from ..operators import economics, marts
from ..operators.skew import hot_keys, salted_join
from .tables import read_table

# Mapping of the driver tables onto the commerce model.
CAMPAIGN_START = "2001-01-01"  # assignment date; orders from then on make a conversion
EXPERIMENT_ID = "free_shipping_threshold"
MARKET_BY_REGION = {0: "LV", 1: "LV", 2: "LT", 3: "LT", 4: "EE"}
CHANNEL_BY_SEGMENT = {
    "AUTOMOBILE": "Paid Search",
    "BUILDING": "Paid Social",
    "FURNITURE": "Organic Search",
    "HOUSEHOLD": "CRM",
    "MACHINERY": "Affiliate",
}
CATEGORY_BY_KEY_MOD5 = ["Electronics", "Home", "Beauty", "Sports", "Pet Care"]
CATEGORY_BY_PRIORITY = {
    "1-URGENT": "Electronics",
    "2-HIGH": "Home",
    "3-MEDIUM": "Beauty",
    "4-NOT SPECIFIED": "Sports",
    "5-LOW": "Pet Care",
}
CARRIER_BY_SUPPKEY_MOD3 = ["BalticPost", "FastShip", "EconomyBox"]
DELIVERY_BASE_BY_MARKET = {"LV": "4.1", "LT": "4.8", "EE": "5.4"}
COST_FACTOR_BY_CARRIER = {"BalticPost": "0.95", "FastShip": "1.15", "EconomyBox": "0.82"}
ACQUISITION_COST_BY_CHANNEL = {"Paid Search": "18", "Paid Social": "23", "Organic Search": "5",
                               "CRM": "4", "Affiliate": "15"}
PRODUCT_COST_SHARE = "0.70"
FULFILLMENT_COST = "2.10"
CONTROL_HASH_MULT, CONTROL_HASH_ADD, CONTROL_BELOW = 7919, 17, 505
CHANNEL_BY_EVENT_TYPE = {"click": "Paid Search", "error": "Paid Social", "purchase": "Organic Search",
                         "signup": "CRM", "view": "Affiliate"}
MARKET_BY_USER_MOD3 = ["LV", "LT", "EE"]


def lookup(mapping: dict, key: Column) -> Column:
    """Literal map lookup (JVM-side ``element_at`` on a constant map; NULL when absent)."""
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*items), key)


def dec(value: str) -> Column:
    """Exact decimal literal."""
    digits = value.split(".")[1] if "." in value else ""
    return F.lit(value).cast(f"decimal({len(value.replace('.', '').lstrip('-'))},{len(digits)})")


def keyed(prefix: str, key: Column) -> Column:
    return F.concat(F.lit(prefix), key.cast("string"))


# Order ids: "O" + the order key zero-padded to 12 digits (string order = key order).
ORDER_ID_DIGITS = 12
_KEY_BITS = 40  # 2**40 > 10**12: a padded key also fits the low bits of a packed (day, key)
EPOCH = "1970-01-01"


def guarded_order_key(key: Column) -> Column:
    """The order key, failing the job if it does not fit the 12-digit id (never truncated)."""
    fits = (key >= 0) & (key < 10 ** ORDER_ID_DIGITS)
    return F.when(fits, key).otherwise(F.raise_error(F.lit("order key outside 0..10^12-1")).cast("bigint"))


def order_key_id(key: Column) -> Column:
    return surrogate_key("O", guarded_order_key(key), ORDER_ID_DIGITS)


def exact_units(value: Column, units: int) -> Column:
    """``value * units`` as a whole number, failing the job where the source is finer than that."""
    scaled = value * F.lit(float(units))
    whole = F.rint(scaled)  # ``round`` goes through big decimals; halves are refused in either case
    exact = F.abs(scaled - whole) < 1e-4
    return F.when(exact, whole).when(value.isNotNull(), F.raise_error(
        F.lit(f"source value finer than 1/{units}")).cast("double")).cast("bigint")


def wall_date(df: DataFrame, column: str) -> Column:
    """Calendar date of a wall-clock timestamp column, independent of the session time zone."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampType):
        days = F.floor(F.unix_micros(F.col(column)) / F.lit(86_400_000_000))
        return F.date_from_unix_date(days.cast("int"))
    return F.col(column).cast("date")


@dataclass
class CommerceModel:
    """Lazy commerce tables over one driver data directory."""

    spark: SparkSession
    data_dir: str
    # When set, the order rows (orders with line totals, customer attributes and first-order
    # flag) are read from this already-written table; all six tables are then projections of it
    # and ``lineitem`` is not read again.
    staged_order_rows: DataFrame | None = None
    # When set, the first order, last date and count of each customer come from this table.
    staged_customer_orders: DataFrame | None = None
    # When set, orders joined with their aggregated lines come from this already-written
    # table: the only pass over ``lineitem``.
    staged_order_totals: DataFrame | None = None

    def _read(self, name: str, columns: list[str]) -> DataFrame:
        return read_table(self.spark, self.data_dir, name, columns)

    # ---- customer attributes (prospect dimension before conversion) ----
    @cached_property
    def customer_attributes(self) -> DataFrame:
        c = self._read("customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
        nation = self._read("nation", ["n_nationkey", "n_regionkey"])
        joined = c.join(nation, c.c_nationkey == nation.n_nationkey, "left")
        return joined.select(
            F.col("c_custkey"),
            lookup(MARKET_BY_REGION, F.col("n_regionkey")).alias("market"),
            lookup(CHANNEL_BY_SEGMENT, F.col("c_mktsegment")).alias("acquisition_channel"),
            F.element_at(F.array(*[F.lit(v) for v in CATEGORY_BY_KEY_MOD5]),
                         (F.pmod(F.col("c_custkey"), F.lit(5)) + 1).cast("int")).alias("category_interest"),
            F.when(F.pmod(F.col("c_custkey"), F.lit(3)) < 2, "mobile").otherwise("desktop").alias("device_type"),
            clamp((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(11000.0), 0.0, 1.0).alias("engagement_score"),
        )

    # ---- order lines aggregated per order ----
    @cached_property
    def order_lines(self) -> DataFrame:
        """Per order: line totals in exact integer units, return flags, supplier and ship date.

        Prices carry at most two decimals and discounts are whole percents (checked row by row),
        so cents and cent-percents are exact ``bigint`` values; summing them per line is plain
        long arithmetic inside generated code (no per-row decimal objects).  Conversion to
        ``decimal(18,2)`` happens once per order.
        """
        li = self._read("lineitem", ["l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice",
                                     "l_discount", "l_returnflag", "l_shipdate"])
        returned = F.col("l_returnflag") == F.lit("R")
        late_return = returned & (F.col("l_linenumber") >= 5)
        li = li.select("l_orderkey", "l_suppkey", "l_shipdate", returned.alias("returned"),
                       late_return.alias("late_return"), exact_units(F.col("l_extendedprice"), 100).alias("cents"),
                       exact_units(F.col("l_discount"), 100).alias("pct"))
        cents, pct, returned, late_return = (F.col(c) for c in ("cents", "pct", "returned", "late_return"))
        return li.groupBy("l_orderkey").agg(
            F.sum(cents).alias("price_cents"),                                   # 1e-2
            F.sum(cents * pct).alias("discount_units"),                          # 1e-4
            F.bool_and(returned).alias("all_returned"),
            F.sum(F.when(late_return, cents * (F.lit(100) - pct)).otherwise(F.lit(0))).alias("refund_units"),
            F.min("l_suppkey").alias("min_suppkey"),
            F.max("l_shipdate").alias("last_ship"),
        )

    # ---- orders with their line totals ----
    @cached_property
    def order_totals(self) -> DataFrame:
        """Every order; one without lines has zero totals, no supplier and no ship date."""
        if self.staged_order_totals is not None:
            return self.staged_order_totals
        o = self._read("orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
        lines = self.order_lines
        w = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
        zero = F.lit(0).cast("bigint")
        return w.select(
            "o_orderkey", "o_custkey", "o_orderpriority", "min_suppkey",
            F.col("l_orderkey").isNotNull().alias("has_lines"),
            F.coalesce("all_returned", F.lit(False)).alias("all_returned"),
            *[F.coalesce(c, zero).alias(c) for c in ("price_cents", "discount_units", "refund_units")],
            wall_date(w, "o_orderdate").alias("order_date"),
            wall_date(w, "last_ship").alias("last_ship_date"),
        )

    @cached_property
    def customer_orders(self) -> DataFrame:
        """Per customer: first order (by date, then order key), its date, the last date, the count.

        Order ids are zero-padded, so their string order is the order-key order, and
        ``(date, key)`` packs into one ``bigint`` (days << 40 | key): a plain ``min`` that Spark
        hash-aggregates with map-side combining, instead of a sort-based ``min`` over a struct.
        """
        if self.staged_customer_orders is not None:
            return self.staged_customer_orders
        days = F.datediff(F.col("order_date"), F.lit(EPOCH).cast("date")).cast("bigint")
        packed = F.shiftleft(days, _KEY_BITS) + guarded_order_key(F.col("o_orderkey"))
        first = self.order_totals.groupBy("o_custkey").agg(
            F.min(packed).alias("_first"), F.max("order_date").alias("last_order_date"),
            F.count(F.lit(1)).alias("n_orders"))
        first_day = F.shiftright(F.col("_first"), _KEY_BITS).cast("int")
        first_key = F.col("_first").bitwiseAND((1 << _KEY_BITS) - 1)
        return first.select("o_custkey", F.date_add(F.lit(EPOCH).cast("date"), first_day).alias("acquisition_date"),
                            first_key.alias("first_order_key"), "n_orders",
                            (F.col("last_order_date") >= F.lit(CAMPAIGN_START).cast("date")).cast("int").alias("converted"))

    # ---- the six commerce tables ----
    @cached_property
    def prospects(self) -> DataFrame:
        a = self.customer_attributes
        if self.staged_order_rows is not None:
            f = self._first_rows.select("o_custkey", "converted")
        else:
            f = self.customer_orders.select("o_custkey", "converted")
        j = a.join(f, a.c_custkey == f.o_custkey, "left")
        return j.select(
            keyed("P", F.col("c_custkey")).alias("prospect_id"), "market", "acquisition_channel",
            "category_interest", "device_type", "engagement_score",
            F.lit(CAMPAIGN_START).cast("date").alias("assignment_date"),
            F.coalesce(F.col("converted"), F.lit(0)).cast("int").alias("converted"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        if self.staged_order_rows is not None:
            # One row per customer: its first order carries the acquisition date.
            return self._first_rows.select(
                keyed("C", F.col("o_custkey")).alias("customer_id"),
                keyed("P", F.col("o_custkey")).alias("prospect_id"),
                "market", "acquisition_channel", F.col("order_date").alias("acquisition_date"))
        a = self.customer_attributes
        f = self.customer_orders.where("o_custkey is not null")
        j = f.join(a, a.c_custkey == f.o_custkey, "left")
        return j.select(
            keyed("C", F.col("o_custkey")).alias("customer_id"),
            keyed("P", F.col("o_custkey")).alias("prospect_id"),
            "market", "acquisition_channel", "acquisition_date",
        )

    @cached_property
    def experiment_assignments(self) -> DataFrame:
        c = self._read("customer", ["c_custkey"])
        bucket = F.pmod(F.col("c_custkey") * F.lit(CONTROL_HASH_MULT) + F.lit(CONTROL_HASH_ADD), F.lit(1000))
        return c.select(
            keyed("P", F.col("c_custkey")).alias("prospect_id"),
            F.lit(EXPERIMENT_ID).alias("experiment_id"),
            F.when(bucket < CONTROL_BELOW, "control").otherwise("treatment").alias("treatment"),
            F.lit(CAMPAIGN_START).cast("date").alias("assignment_date"),
        )

    @cached_property
    def _first_rows(self) -> DataFrame:
        return self._order_rows.where((F.col("first_order") == 1) & F.col("o_custkey").isNotNull())

    @cached_property
    def _order_rows(self) -> DataFrame:
        """Orders with line totals in whole units, customer attributes and first-order flag: all that
        amounts follow from row by row, so that shuffles carry no amounts."""
        if self.staged_order_rows is not None:
            return self.staged_order_rows
        w = self.order_totals
        a = self.customer_attributes.select("c_custkey", "market", "acquisition_channel")
        first = self.customer_orders
        f = first.select(F.col("o_custkey").alias("f_custkey"), "first_order_key", "converted")
        # Both per-customer tables have one row per key: join them first, then make a single
        # join against the orders.  A customer with a large share of the orders is spread over
        # several tasks by a salted join (hot keys found from the per-customer order counts).
        # Left joins: an order whose customer is missing keeps its row for the quality checks.
        per_customer = f.join(a, a.c_custkey == f.f_custkey, "left").select(
            F.col("f_custkey").alias("o_custkey"), "market", "acquisition_channel", "first_order_key", "converted")
        hot = hot_keys(first, "o_custkey", "n_orders")
        j = salted_join(w, per_customer, "o_custkey", hot, "left", spread_by="o_orderkey")
        is_first = F.coalesce(F.col("o_orderkey") == F.col("first_order_key"), F.lit(False))
        return j.select(*w.columns, "market", "acquisition_channel", "converted", is_first.cast("int").alias("first_order"))

    @cached_property
    def _order_frame(self) -> DataFrame:
        """The order rows with carrier and all amounts."""
        j = self._order_rows

        def cents(x: Column) -> Column:
            return F.round(x, 2).cast(MONEY)

        def scaled(units: str, scale: str) -> Column:
            # integer units -> currency, in thousandths of the source price, rounded to cents
            return cents(F.col(units).cast("decimal(20,0)") * dec(scale))

        # Column expressions are composed in Python and projected once; Catalyst collapses
        # the projection and shares common subexpressions.
        gross = scaled("price_cents", "0.00001")
        discount = scaled("discount_units", "0.0000001")
        # An order returned in full is refunded in full; else the late returns are paid back.
        refund = F.when(F.col("all_returned"), gross).otherwise(scaled("refund_units", "0.0000001")).cast(MONEY)
        carrier = F.element_at(F.array(*[F.lit(v) for v in CARRIER_BY_SUPPKEY_MOD3]),
                               (F.pmod(F.col("min_suppkey"), F.lit(3)) + 1).cast("int"))
        acq_cost = lookup(ACQUISITION_COST_BY_CHANNEL, F.col("acquisition_channel")).cast(MONEY)
        has_lines, nothing = F.col("has_lines"), F.lit(0).cast(MONEY)
        delivery_cost = F.when(has_lines, cents(
            lookup(DELIVERY_BASE_BY_MARKET, F.col("market")).cast("decimal(2,1)")
            * lookup(COST_FACTOR_BY_CARRIER, carrier).cast("decimal(3,2)"))).otherwise(nothing)
        product_cost = cents(gross * dec(PRODUCT_COST_SHARE))
        payment = economics.payment_cost(gross)
        fulfillment = F.when(has_lines, dec(FULFILLMENT_COST).cast(MONEY)).otherwise(nothing)
        marketing = economics.attributed_marketing(acq_cost, F.col("first_order") == 1)
        net = economics.net_revenue(gross, discount, refund)
        margin = economics.contribution_margin(net, product_cost, delivery_cost, payment, fulfillment, marketing)
        return j.select(
            order_key_id(F.col("o_orderkey")).alias("order_id"), "o_custkey", "order_date", "market",
            "acquisition_channel", "last_ship_date", "o_orderpriority", "has_lines", "converted",
            economics.order_status(refund, gross).alias("order_status"),
            gross.alias("gross_revenue"), discount.alias("discount_amount"), refund.alias("refund_amount"),
            product_cost.alias("product_cost"), delivery_cost.alias("delivery_cost"),
            payment.alias("payment_cost"), fulfillment.alias("fulfillment_cost"),
            marketing.alias("attributed_marketing_cost"), net.alias("net_revenue"),
            margin.alias("contribution_margin"), carrier.alias("carrier"), "first_order",
        )

    @cached_property
    def orders(self) -> DataFrame:
        o = self._order_frame
        return o.select(
            "order_id",
            keyed("C", F.col("o_custkey")).alias("customer_id"),
            keyed("P", F.col("o_custkey")).alias("prospect_id"),
            "order_date", "market", "acquisition_channel",
            lookup(CATEGORY_BY_PRIORITY, F.col("o_orderpriority")).alias("category"),
            "order_status", "gross_revenue", "discount_amount", "refund_amount", "product_cost",
            "delivery_cost", "payment_cost", "fulfillment_cost", "attributed_marketing_cost",
            "net_revenue", "contribution_margin",
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        o = self._order_frame.where("has_lines")
        promised = economics.promised_date(F.col("order_date"))
        return o.select(
            "order_id", "carrier", promised.alias("promised_date"),
            F.col("last_ship_date").alias("delivered_date"),
            economics.on_time(F.col("last_ship_date"), promised).alias("on_time"),
            "delivery_cost",
        )

    @cached_property
    def marketing_spend(self) -> DataFrame:
        e = self._read("events", ["ts", "user_id", "event_type", "value"])
        keyed_events = e.select(
            F.trunc(wall_date(e, "ts"), "month").alias("month"),
            F.element_at(F.array(*[F.lit(v) for v in MARKET_BY_USER_MOD3]),
                         (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int")).alias("market"),
            lookup(CHANNEL_BY_EVENT_TYPE, F.col("event_type")).alias("channel"),
            exact_units(F.col("value"), 100).alias("cents"),
        )
        spend = (F.sum("cents").cast("decimal(20,0)") * dec("0.01")).cast(MONEY)
        return keyed_events.groupBy("month", "market", "channel").agg(spend.alias("spend"))

    @cached_property
    def prospect_outcomes(self) -> DataFrame:
        return marts.prospect_outcomes(self.prospects, self.orders, self.experiment_assignments)

    def table(self, name: str) -> DataFrame:
        return {
            "dim_prospect": self.prospects,
            "dim_customer": self.customers,
            "fct_orders": self.orders,
            "fct_deliveries": self.deliveries,
            "fct_experiment_assignments": self.experiment_assignments,
            "fct_marketing_spend": self.marketing_spend,
        }[name]


def commerce(spark: SparkSession, data_dir: str) -> CommerceModel:
    return CommerceModel(spark, data_dir)
