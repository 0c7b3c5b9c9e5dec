
import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import dedup, lines as L, sales as S
from ledgerloom.plans.report import from_documents
from ledgerloom.schemas import CUSTOMERS_RAW, ORDER_DOC, REFUNDS_RAW

D1 = dt.date(2025, 3, 1)


def docs(spark, rows):
    full = [r + (None,) * (len(ORDER_DOC.fields) - len(r)) for r in rows]
    return spark.createDataFrame(full, ORDER_DOC).drop("_corrupt_record")


def cust(spark, rows):
    return spark.createDataFrame(rows, CUSTOMERS_RAW)


def refunds(spark, rows):
    return spark.createDataFrame(rows, REFUNDS_RAW)


def item(q=None, p=None, quantity=None, price=None):
    return (q, quantity, p, price)


def report(spark, d, c, r, **kw):
    return [tuple(x) for x in from_documents(d, c, r, **kw).report.collect()]


def test_d3_no_refunds_is_zero(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01 10:00:00", "paid", [item("2", "5")])])
    rep = report(spark, d, cust(spark, [("c1", "Paris", "1")]), refunds(spark, []))
    assert rep == [(D1, "Paris", "web", 1, 1, 2.0, 10.0, 0.0, 10.0)]


def test_d4_bad_amount_is_zero_d22_unknown_order_ignored(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01 10:00:00", "paid", [item("1", "5")])])
    r = refunds(spark, [("o1", "abc", None), ("o1", "1.5", None), ("zz", "9", None)])
    rep = report(spark, d, cust(spark, [("c1", "Paris", "yes")]), r)
    assert rep[0][-2:] == (1.5, 3.5)


def test_d2_no_customers_gives_empty_report(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01 10:00:00", "paid", [item("1", "5")])])
    assert report(spark, d, cust(spark, []), refunds(spark, [])) == []


def test_d6_unparseable_date_is_null_group(spark):
    d = docs(spark, [("o1", "c1", "web", "not a date", "paid", [item("1", "5")])])
    rep = report(spark, d, cust(spark, [("c1", "Paris", "1")]), refunds(spark, []))
    assert rep[0][0] is None


def test_d7_empty_items_keep_empty(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", []), ("o2", "c1", "web", "2025-03-01", "paid", None)])
    assert L.explode_items(d).count() == 0
    assert L.explode_items(d, keep_empty=True).count() == 2


def test_d8_null_price_dropped_or_zero(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item("1", None), item("1", "4")])])
    lines = L.item_lines(d)
    good, rej = L.split_rejects(lines)
    assert good.count() == 1 and rej.count() == 0  # null price is in neither
    zero = L.item_lines(d, null_policy="zero")
    assert L.split_rejects(zero)[0].count() == 2


def test_d10_tie_keeps_lowest_position_any_partitioning(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01 10:00:00", "paid", [item("1", "9"), item("1", "2")])])
    lines = L.item_lines(d)
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        kept = dedup.keep_first(lines, "order_id", ("created_at", "item_pos")).collect()
        assert [(r.item_pos, float(r.item_unit_price)) for r in kept] == [(0, 9.0)]
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_d11_null_created_at_sorts_last(spark):
    d = docs(spark, [("o1", "c1", "web", None, "paid", [item("1", "1")]), ("o1", "c1", "web", "2025-03-01", "paid", [item("1", "2")])])
    kept = dedup.keep_first(L.item_lines(d)).collect()
    assert kept[0].created_at == "2025-03-01"


def test_d12_null_city_is_its_own_group(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item("1", "5")])])
    rep = report(spark, d, cust(spark, [("c1", None, "1")]), refunds(spark, []))
    assert rep[0][1] is None and rep[0][3] == 1


def test_d13_duplicate_customer_no_fan_out(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item("1", "5")])])
    c = cust(spark, [("c1", "Paris", "1"), ("c1", "Paris", "1"), ("c1", "Lyon", "1")])
    rep = report(spark, d, c, refunds(spark, []))
    assert rep == [(D1, "Lyon", "web", 1, 1, 1.0, 5.0, 0.0, 5.0)]


def test_d14_alternate_names_per_row(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item("2", "3"), item(quantity="4", price="5")])])
    got = sorted((float(r.item_qty), float(r.item_unit_price)) for r in L.item_lines(d).collect())
    assert got == [(2.0, 3.0), (4.0, 5.0)]


def test_d20_paid_is_exact(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "Paid", [item("1", "1")]), ("o2", "c1", "web", "2025-03-01", None, [item("1", "1")])])
    assert L.paid_only(d).count() == 0


def test_active_customers_filter(spark):
    c = S.normalize_customers(cust(spark, [("c1", "P", " TRUE"), ("c2", "P", "maybe"), ("c3", "P", None)]))
    assert [r.customer_id for r in S.active_customers(c).collect()] == ["c1"]


def test_hot_customer_salted_join_same_result(spark):
    from ledgerloom.operators.skew import hot_keys, salted_join

    rows = [(f"o{i}", "c1" if i % 3 else "c2", "web", "2025-03-01", "paid", [item("1", str(i))]) for i in range(1, 40)]
    d = docs(spark, rows)
    c = cust(spark, [("c1", "Paris", "1"), ("c2", "Lyon", "yes"), ("c3", "Nice", "1")])
    plain = report(spark, d, c, refunds(spark, []), hot_rows=None)
    salted = report(spark, d, c, refunds(spark, []), hot_rows=5)  # c1 and c2 are hot
    assert plain == salted and sum(r[3] for r in plain) == 39
    facts = spark.createDataFrame([(f"o{i}", "k") for i in range(100)], "order_id string, customer_id string")
    dim = spark.createDataFrame([("k", "v")], "customer_id string, city string")
    hot = hot_keys(facts, "customer_id", 10, salt_rows=12)  # 100 rows -> 9 salts
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(facts, dim, "customer_id", hot, salt_by=["order_id"])
        assert joined.count() == 100
        # the one hot key is spread over several shuffle partitions (sort-merge join)
        parts = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_d14b_neither_field_name_gives_null(spark):
    from pyspark.sql.types import ArrayType, StringType, StructField, StructType

    other = StructType([StructField("sku", StringType())])
    schema = StructType([StructField("order_id", StringType()), StructField("items", ArrayType(other))])
    d = spark.createDataFrame([("o1", [("x",)])], schema)
    row = L.item_lines(d).collect()[0]
    assert row.item_qty is None and row.item_unit_price is None and row.item_sku == "x"


def test_d16_null_quantity_policy(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item(None, "5")])])
    c = cust(spark, [("c1", "Paris", "1")])
    assert report(spark, d, c, refunds(spark, []))[0][5] is None  # sum of nulls stays null
    assert report(spark, d, c, refunds(spark, []), null_policy="zero")[0][5] == 0.0


def test_hot_order_copies_salted_refund_join(spark):
    # one order sent 30 times with different times: at 'all' grain every copy counts
    rows = [("o1", "c1", "web", f"2025-03-01 10:{i:02d}:00", "paid", [item("1", "2")]) for i in range(30)]
    d = docs(spark, rows)
    c = cust(spark, [("c1", "Paris", "1")])
    r = refunds(spark, [("o1", "1", None)])
    plain = report(spark, d, c, r, grain="all", hot_rows=None)
    salted = report(spark, d, c, r, grain="all", hot_rows=4)
    assert plain == salted == [(D1, "Paris", "web", 1, 1, 30.0, 60.0, 30.0, 30.0)]


def test_p17_customers_without_is_active_are_inactive(spark):
    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "paid", [item("1", "5")])])
    c = spark.createDataFrame([("c1", "Paris")], "customer_id string, city string")
    assert report(spark, d, c, refunds(spark, [])) == []


def test_d15_ids_compare_as_strings(spark):
    d = docs(spark, [("o1", "7", "web", "2025-03-01", "paid", [item("1", "5")])])
    c = cust(spark, [("007", "Paris", "1")])  # not the same id as "7"
    assert report(spark, d, c, refunds(spark, [])) == []


def test_d21_nothing_left_gives_typed_empty_outputs(spark):
    from ledgerloom.schemas import DAILY_CITY_SALES, ORDERS_CLEAN

    d = docs(spark, [("o1", "c1", "web", "2025-03-01", "pending", [item("1", "5")])])
    frames = from_documents(d, cust(spark, [("c1", "Paris", "1")]), refunds(spark, []))
    assert frames.report.count() == 0 and frames.orders_clean.count() == 0
    assert [f.name for f in frames.report.schema.fields] == [f.name for f in DAILY_CITY_SALES.fields]
    assert [f.name for f in frames.orders_clean.schema.fields] == [f.name for f in ORDERS_CLEAN.fields]
