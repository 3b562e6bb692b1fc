"""KPI tables (E11-E17), over the fact or over per-order contributions.

A KPI is a grain and a list of measures (``KPIS``). ``over_fact`` evaluates
them on the fact's payments x refunds rows; the ``*_orders`` forms give the
same tables from one row per order (see ``order_contributions``), which the
registered queries and the pipeline use. Every KPI is a grouped aggregate:
Spark plans a partial aggregate per map task, so a hot day or customer is
combined before the shuffle. The single ``countDistinct(order_id)`` is
rewritten by Catalyst into a two-level aggregate keyed first by (group,
order_id), which stays distributed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from govlake.functions.columns import pct, success_flag
from govlake.operators.policy import apply_row_rules
from govlake.sources.sinks import cut_lineage

#: Grain and measures of each KPI. Names are the output contract.
KPIS = {
    "daily_order_revenue": ("order_date", ("total_orders", "gross_revenue", "net_revenue")),
    "payment_success_rate": ("order_date", ("total_payments", "successful_payments", "payment_success_rate")),
    "refund_rate": ("order_date", ("total_orders", "refunded_orders", "total_refund_amount", "refund_rate")),
    "discount_impact": ("order_date", ("total_discount", "gross_revenue", "net_revenue")),
    "customer_lifetime_value": ("customer_id", ("total_orders", "lifetime_value", "avg_order_value")),
    "payment_method_performance": ("payment_method", ("total_transactions", "successful_transactions", "total_revenue")),
    "daily_all": ("order_date", (
        "total_orders", "gross_revenue", "net_revenue", "total_payments", "successful_payments", "payment_success_rate",
        "refunded_orders", "total_refund_amount", "refund_rate", "total_discount")),
}


def _day() -> Column:
    return F.to_date("order_date").alias("order_date")


def fact_measures() -> dict[str, Column]:
    """Every measure as an aggregate over fact rows.

    Refunds and payments are counted as rows: with the fan-out a refund rate
    can pass 100 (S11). A rate over nothing is NULL (S12). The average is the
    exact decimal sum over the non-NULL count.
    """
    orders, paid, refunds = F.countDistinct("order_id"), F.count("payment_id"), F.count("refund_id")
    good = F.sum(success_flag(F.col("payment_status"))).cast("bigint")
    net = F.sum("net_amount")
    out = {"total_orders": orders, "refunded_orders": refunds, "refund_rate": pct(refunds, orders)}
    out |= {"payment_success_rate": pct(good, paid)}
    out |= dict.fromkeys(("total_payments", "total_transactions"), paid)
    out |= dict.fromkeys(("successful_payments", "successful_transactions"), good)
    out |= dict.fromkeys(("net_revenue", "lifetime_value", "total_revenue"), net)
    out |= {"avg_order_value": F.try_divide(net.cast("double"), F.count("net_amount").cast("double"))}
    sums = {"gross_revenue": "payment_amount", "total_refund_amount": "refund_amount", "total_discount": "discount_amount"}
    return out | {name: F.sum(source) for name, source in sums.items()}


def over_fact(fact: DataFrame, kpi: str) -> DataFrame:
    """One KPI table over the fact."""
    grain, names = KPIS[kpi]
    measures = fact_measures()
    return fact.groupBy(_day() if grain == "order_date" else F.col(grain)).agg(*[measures[n].alias(n) for n in names])


# ---------------------------------------------------------------------------
# KPIs without the fan-out.
#
# The fact holds one row per (order, payment, refund) combination, so an
# order with many payments and refunds contributes their product in rows.
# Every KPI above is a count or a sum over those rows, and each such total
# is a closed form of per-order aggregates: with C matching customer rows,
# P payment rows and R refund rows, an order stands for C * max(P,1) *
# max(R,1) fact rows, a payment amount is repeated C * max(R,1) times, a
# refund amount C * max(P,1) times. ``order_contributions`` pre-aggregates
# payments and refunds per order (map-side partial aggregation, so a hot
# order never reaches one task whole) and joins them 1:1 to the orders; the
# KPIs then aggregate one row per order. No pair is ever materialised and
# the totals are exactly those of the fan-out fact (DECIMAL arithmetic).
# ---------------------------------------------------------------------------


def _pay_aggs():
    return [
        F.count(F.lit(1)).alias("p_rows"),
        F.count("payment_id").alias("p_ids"),
        F.count("amount").alias("p_amts"),
        F.sum(success_flag(F.col("payment_status"))).cast("bigint").alias("p_success"),
        F.sum("amount").alias("p_sum"),
    ]


#: What an order brings besides its keys: day, discount, rows of its customer id, its refunds.
BASE = ("customer_id", "order_date", "discount_amount", "cm", "rm", "r_ids", "r_sum")


def _order_base(orders: DataFrame, customers: DataFrame, refunds: DataFrame, rules, keys: Sequence[str]) -> DataFrame:
    """Valid orders with their customer multiplicity and refund aggregates."""
    o, _ = apply_row_rules(orders, "orders", rules)
    c, _ = apply_row_rules(customers, "customers", rules)
    r, _ = apply_row_rules(refunds, "refunds", rules)
    # Only a customer with more than one row changes a total (none and one
    # both count once). That table is small or empty, and stored, so its real
    # size decides the join: normally a broadcast, and no shuffle of all
    # orders on customer_id; else a join whose hot customers AQE can split.
    repeated = c.groupBy("customer_id").agg(F.count(F.lit(1)).alias("c_rows")).filter(F.col("c_rows") > 1)
    cust = cut_lineage(repeated, "repeated-customers")
    ref = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("r_rows"),
        F.count("refund_id").alias("r_ids"),
        F.sum("refund_amount").alias("r_sum"),
    )
    one = F.lit(1).cast("bigint")
    return (
        o.select(*keys, "customer_id", "order_date", "discount_amount")
        .join(cust, "customer_id", "left")
        .join(ref, list(keys), "left")
        .select(
            *keys, "customer_id", "order_date", "discount_amount",
            F.coalesce("c_rows", one).alias("cm"),
            F.greatest(F.coalesce("r_rows", one), one).alias("rm"),
            F.coalesce("r_ids", F.lit(0)).alias("r_ids"),
            "r_sum",
        )
    )


#: Figures of a set of payments, and the names they have for an order's payments of one method.
PAY_FIGURES = ("p_rows", "p_ids", "p_amts", "p_success", "p_sum")
METHOD_FIGURES = tuple(f"m{c}" for c in PAY_FIGURES)
#: Columns by which orders, payments and refunds meet.
ORDER = ("order_id",)


def _with_payments(rows: DataFrame, columns: Sequence[str], figures: Sequence[str] = PAY_FIGURES) -> DataFrame:
    """Joined rows as ``columns`` and the figures of their payments, those of an order without payments filled in."""
    one, (n, ids, amounts, successes, total) = F.lit(1).cast("bigint"), figures
    return rows.select(
        *columns,
        F.greatest(F.coalesce(n, one), one).alias("pm"),
        F.coalesce(ids, F.lit(0)).alias("p_ids"),
        F.coalesce(amounts, F.lit(0)).alias("p_amts"),
        F.coalesce(successes, F.lit(0)).alias("p_success"),
        F.col(total).alias("p_sum"),
    )


def method_contributions(orders: DataFrame, customers: DataFrame, payments: DataFrame, refunds: DataFrame,
                         rules=(), keys: Sequence[str] = ORDER) -> DataFrame:
    """One row per (policy-valid) order and payment method, one for an order without
    payments, with the figures of the order's payments and of those by the method.

    Stored and given as ``joined`` to ``order_contributions`` and
    ``kpi_payment_method_performance_orders``, it joins the feeds once for both.
    ``_lead`` marks one row of each order that has payments.
    """
    p, _ = apply_row_rules(payments, "payments", rules)
    rows = p.groupBy(*keys, "payment_method").agg(*[a.alias(m) for a, m in zip(_pay_aggs(), METHOD_FIGURES, strict=True)])
    whole = Window.partitionBy(*keys)  # an order's rows are as many as its methods
    place = F.struct(F.col("payment_method").isNotNull(), "payment_method")
    sums = {c: F.sum(m).over(whole).cast(rows.schema[m].dataType) for c, m in zip(PAY_FIGURES, METHOD_FIGURES, strict=True)}
    rows = rows.withColumns(sums | {"_lead": place == F.min(place).over(whole)})
    return _order_base(orders, customers, refunds, rules, keys).join(rows, list(keys), "left")


def order_contributions(orders: DataFrame, customers: DataFrame, payments: DataFrame, refunds: DataFrame,
                        rules=(), keys: Sequence[str] = ORDER, joined: DataFrame | None = None) -> DataFrame:
    """One row per (policy-valid) order with the multiplicities and sums the
    fan-out fact would spread over its rows. ``joined``: these feeds' stored ``method_contributions``."""
    if joined is not None:
        return _with_payments(joined.where(F.coalesce("_lead", F.lit(True))), [*keys, *BASE])
    p, _ = apply_row_rules(payments, "payments", rules)
    base = _order_base(orders, customers, refunds, rules, keys)
    return _with_payments(base.join(p.groupBy(*keys).agg(*_pay_aggs()), list(keys), "left"), base.columns)


def _net(p_sum, p_amts, discount):
    """Sum of (payment amount - discount) over an order's payments; NULL
    when there is no payment amount or no discount (as every fact row's
    ``net_amount`` would be)."""
    return F.when(discount.isNotNull() & (p_amts > 0), p_sum - p_amts * discount)


def _contrib_cols():
    cm, pm, rm = F.col("cm"), F.col("pm"), F.col("rm")
    disc = F.col("discount_amount")
    return {
        "payments": cm * F.col("p_ids") * rm,
        "successes": cm * F.col("p_success") * rm,
        "gross": cm * rm * F.col("p_sum"),
        "net": cm * rm * _net(F.col("p_sum"), F.col("p_amts"), disc),
        "net_rows": F.when(disc.isNotNull(), cm * rm * F.col("p_amts")).otherwise(F.lit(0)),
        "refund_ids": cm * pm * F.col("r_ids"),
        "refund_sum": cm * pm * F.col("r_sum"),
        "discount": cm * pm * rm * disc,
    }


def kpi_daily_all_orders(contrib: DataFrame) -> DataFrame:
    """E17 from ``order_contributions``: equal to ``over_fact(fact, "daily_all")``."""
    k = _contrib_cols()
    successes = F.sum(k["successes"]).cast("bigint")
    payments_n = F.sum(k["payments"]).cast("bigint")
    refunds_n = F.sum(k["refund_ids"]).cast("bigint")
    return contrib.groupBy(_day()).agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum(k["gross"]).alias("gross_revenue"),
        F.sum(k["net"]).alias("net_revenue"),
        payments_n.alias("total_payments"),
        successes.alias("successful_payments"),
        pct(successes, payments_n).alias("payment_success_rate"),
        refunds_n.alias("refunded_orders"),
        F.sum(k["refund_sum"]).alias("total_refund_amount"),
        pct(refunds_n, F.countDistinct("order_id")).alias("refund_rate"),
        F.sum(k["discount"]).alias("total_discount"),
    )


def daily_kpi(kpi_all: DataFrame, kpi: str) -> DataFrame:
    """One of the day-grained KPIs (E11-E13, E16) as columns of E17."""
    grain, names = KPIS[kpi]
    return kpi_all.select(grain, *names)


def kpi_customer_lifetime_value_orders(contrib: DataFrame) -> DataFrame:
    """E14 from ``order_contributions``."""
    k = _contrib_cols()
    return contrib.groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum(k["net"]).alias("lifetime_value"),
        F.try_divide(F.sum(k["net"]).cast("double"), F.sum(k["net_rows"]).cast("double")).alias("avg_order_value"),
    )


def kpi_payment_method_performance_orders(orders: DataFrame, customers: DataFrame, payments: DataFrame,
                                          refunds: DataFrame, rules=(), by: Sequence[Column] = (),
                                          keys: Sequence[str] = ORDER, joined: DataFrame | None = None) -> DataFrame:
    """E15 without the fan-out: payments pre-aggregated per (order, method)
    and left-joined to the orders, so an order without payments is one row
    of the NULL method group, as its fact row has no method.

    ``by``: further groups, expressions of ``order_date``; their rows add up. ``joined``: as in
    ``order_contributions``."""
    if joined is not None:
        rows = _with_payments(joined, [*keys, *BASE, "payment_method"], METHOD_FIGURES)
    else:
        p, _ = apply_row_rules(payments, "payments", rules)
        base = _order_base(orders, customers, refunds, rules, keys)
        per_method = p.groupBy(*keys, "payment_method").agg(*_pay_aggs())
        rows = _with_payments(base.join(per_method, list(keys), "left"), [*base.columns, "payment_method"])
    cm, rm = F.col("cm"), F.col("rm")
    return rows.groupBy(*by, "payment_method").agg(
        F.sum(cm * F.col("p_ids") * rm).cast("bigint").alias("total_transactions"),
        F.sum(cm * F.col("p_success") * rm).cast("bigint").alias("successful_transactions"),
        F.sum(cm * rm * _net(F.col("p_sum"), F.col("p_amts"), F.col("discount_amount"))).alias("total_revenue"),
    )
