"""Plan-shape assertions and the driver contract."""

import re

from ledgerloom.plans import catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_plan_shape(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(catalog.daily_city_sales(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # no Python in the plan, everything JVM-side
    assert "EvalPython" not in plan and "ExistingRDD" not in plan
    # keep-first is a partial top-1 before the shuffle and a final one after
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    # keep-first, the head join, per-order and the refund join share one order_id
    # partitioning: items, heads and refund sums are each shuffled on order_id once
    assert len(re.findall(r"Exchange hashpartitioning\(order_id", plan)) <= 3
    # nation (fixed 25 rows) is broadcast to the customer scan
    assert "BroadcastHashJoin" in plan and "BroadcastExchange" in plan
    # the scans read only the needed columns
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and not any("o_totalprice" in s or "c_name" in s or "c_acctbal" in s for s in schemas)


def test_per_order_reuses_keep_first_partitioning(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(catalog.per_order(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # items once (keep-first) and heads once (join); per-order adds none
    assert len(re.findall(r"Exchange hashpartitioning", plan)) <= 2


def test_entry_contract(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    from ledgerloom.schemas import DAILY_CITY_SALES, ORDERS_CLEAN

    def shape(schema):
        return [(f.name, f.dataType.simpleString()) for f in schema.fields]

    assert shape(df.schema) == shape(DAILY_CITY_SALES)
    assert shape(E.queries()["orders_clean"](spark, SF).schema) == shape(ORDERS_CLEAN)
    assert set(E.oracle_sql()) <= set(E.queries())


def test_flagship_exchanges_at_scale_settings(spark):
    """With no broadcast allowed (as when every side is large), the whole
    chain needs at most 8 hash exchanges: items, heads and refund sums on
    order_id; the hot-key count; per-order rows and the customer dimension
    on (customer_id, salt) -- the dimension only once; two report levels."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(catalog.daily_city_sales(spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(exchanges) <= 8
    assert sum(1 for e in exchanges if e.startswith("customer_id") and "_salt" in e) == 2
    assert "SortMergeJoin" in plan and "Expand" not in plan
