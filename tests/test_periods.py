"""Period datasets: equal to a full run after any drops, and only changed periods are touched."""

import datetime as dt

import pytest
from govlake.operators import facts, kpis
from govlake.operators.periods import BY_DAY, PeriodStore
from govlake.sources import sinks

SCHEMAS = {
    "orders": "order_id long, customer_id long, order_date timestamp_ntz, order_status string, amount decimal(18,2), discount_amount decimal(18,4)",
    "customers": "customer_id long, city string",
    "payments": "payment_id long, order_id long, payment_status string, payment_method string, amount decimal(18,2)",
    "refunds": "refund_id long, order_id long, refund_status string, refund_amount decimal(18,4), refund_reason string",
}
RULES = [{"table": "orders", "rule_name": "positive", "expression": "amount > 0", "severity": "HIGH", "on_fail": "QUARANTINE"}]


def day(n):
    return None if n is None else dt.datetime(2024, 1, n, 5)


def order(i, n, customer=1, amount=10):
    return (i, customer, day(n), "COMPLETED", dt_dec(amount), dt_dec(1))


def dt_dec(x):
    import decimal

    return decimal.Decimal(x)


def payment(i, order_id, status="SUCCESS"):
    return (i, order_id, status, "CARD", dt_dec(10))


def refund(i, order_id):
    return (i, order_id, "APPROVED", dt_dec(2), "LATE")


DROPS = [
    {"orders": [order(1, 1), order(2, 2), order(3, None), order(4, 2, amount=-1)], "customers": [(1, "a"), (2, "b")],
     "payments": [payment(10, 1), payment(11, 1), payment(12, 5), payment(13, None)], "refunds": [refund(20, 2), refund(21, 6)]},
    {"orders": [order(5, 3, 2), order(6, 4)], "payments": [payment(14, 5), payment(15, 3)]},  # orders after their payment, refund
    {"refunds": [refund(22, 1), refund(23, 99)]},  # late
    {"orders": [order(1, 5), order(1, 6), order(5, 3, 2)], "payments": [payment(16, 1)]},  # ids that come again
    {"customers": [(2, "c")]},  # repeats a customer
    {"orders": [order(None, 7)], "payments": [payment(17, 1), payment(17, 1)]},
    {},
]
CHANGED = [["2024-01-01", "2024-01-02", "undated"], ["2024-01-03", "2024-01-04", "undated"], ["2024-01-01"], ["2024-01-01", "2024-01-03", "2024-01-05", "2024-01-06"],
           ["2024-01-03"], ["2024-01-01", "2024-01-05", "2024-01-06", "2024-01-07"], []]


def frames(spark, drops):
    return {n: spark.createDataFrame([r for d in drops for r in d.get(n, [])], s) for n, s in SCHEMAS.items()}


def store_of(spark):
    schemas = {n: spark.createDataFrame([], s).schema for n, s in SCHEMAS.items()}
    return PeriodStore(spark, sinks.scratch_dir(spark, "periods"), schemas, RULES, BY_DAY)


def told(df):
    return sorted((tuple(map(str, r)) for r in df.collect()))


def test_every_drop_equals_a_full_run(spark):
    store = store_of(spark)
    for k, drop in enumerate(DROPS):
        feeds = {n: df for n, df in frames(spark, [drop]).items() if n in drop}
        assert store.add(k, feeds) == CHANGED[k], k
        if k == 3:
            assert store.add(k, feeds) == CHANGED[k]  # again: each row once
        if k in (1, 3, 6):
            full = frames(spark, DROPS[: k + 1]).values()
            o, c, p, r = (dict(zip(SCHEMAS, full, strict=True))[n] for n in ("orders", "customers", "payments", "refunds"))
            fact = facts.fact_orders(o, c, p, r, RULES)
            assert told(store.dataset("fact").select(*fact.columns)) == told(fact)
            kpi = kpis.kpi_daily_all_orders(kpis.order_contributions(o, c, p, r, RULES))
            want = kpis.over_fact(fact, "daily_all")
            # an id on two days is one order a day in both
            assert told(store.dataset("kpi").select(*want.columns)) == told(want) == told(kpi.select(*want.columns))
            want = kpis.over_fact(fact, "payment_method_performance")
            assert told(store.method_performance().select(*want.columns)) == told(want)
    with pytest.raises(ValueError, match="does not follow"):
        store.add(9, {})


def test_scans_and_writes_are_pruned_to_the_changed_periods(spark):
    store = store_of(spark)
    store.add(0, frames(spark, DROPS[:1]))
    before = set(store.dataset("kpi").inputFiles())
    store.add(1, {"refunds": frames(spark, DROPS[2:3])["refunds"]})
    after = set(store.dataset("kpi").inputFiles())
    assert {f.split("period=")[1].split("/")[0] for f in before ^ after} == {"2024-01-01"}
    plan = store.feed("payments", 1, ["2024-01-01"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-01-01" in plan.split("PartitionFilters")[1]


def _counted(monkeypatch):
    """Calls that join orders with refunds for KPIs."""
    calls, join = [], kpis._order_base
    monkeypatch.setattr(kpis, "_order_base", lambda *a: calls.append(1) or join(*a))
    return calls


def test_the_feeds_of_changed_periods_are_joined_once_for_the_sums(spark, monkeypatch):
    calls, store = _counted(monkeypatch), store_of(spark)
    store.add(0, frames(spark, DROPS[:1]))
    assert len(calls) == 1


def test_a_first_drop_reads_nothing_before_it(spark):
    """No rows are a relation that the optimizer folds away, not one scanned by Python tasks."""
    store = store_of(spark)
    nothing = store.feed("orders", -1)
    assert nothing.schema == spark.createDataFrame([], nothing.schema).schema and nothing.count() == 0
    plan = nothing.join(frames(spark, DROPS[:1])["payments"], "order_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "ExistingRDD" not in plan
