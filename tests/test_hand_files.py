"""Hand-written input files: columns by name, quotes, white space."""

import os

from ledgerloom.functions import parse_date, safe_number, to_double
from ledgerloom.operators import sales as S
from ledgerloom.schemas import CUSTOMERS_RAW, REFUNDS_RAW
from ledgerloom.sources.files import read_csv, read_orders_month, split_corrupt


def put(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def read_split(spark, folder):
    return [f.collect() for f in split_corrupt(read_orders_month(spark, folder, 2025, 3))]


def test_columns_are_taken_by_header_name(spark, tmp_dir):
    path = put(tmp_dir, "c.csv", 'name,is_active,customer_id,city\nZoe,yes\t,k7,"North ""Old"" Port"\n')
    rows = read_csv(spark, path, CUSTOMERS_RAW).collect()
    assert [(r["customer_id"], r["city"]) for r in rows] == [("k7", 'North "Old" Port')]
    assert S.normalize_customers(read_csv(spark, path, CUSTOMERS_RAW)).first()["is_active"] is True


def test_absent_columns_are_null(spark, tmp_dir):
    path = put(tmp_dir, "r.csv", "refund_id,amount,order_id\nq1,3.5,z9\n")
    row = read_csv(spark, path, REFUNDS_RAW).first().asDict()
    assert row["order_id"] == "z9" and str(row["amount"]) == "3.5"
    assert all(v is None for k, v in row.items() if k not in ("order_id", "amount", "refund_id"))


def test_active_duplicate_customer_wins(spark, tmp_dir):
    path = put(tmp_dir, "d.csv", "customer_id,city,is_active\nk1,Turin,1\nk1,Bari,0\n")
    rows = S.normalize_customers(read_csv(spark, path, CUSTOMERS_RAW)).collect()
    assert [(r["city"], r["is_active"]) for r in rows] == [("Turin", True)]


def test_numbers_are_not_cut(spark):
    rows = [("100000000000000", "2"), ("0.00004", "1000000"), ("0.0000000001", "3"), ("12345678901234567.5", "0.1")]
    lines = spark.createDataFrame(rows, "q string, p string").select(safe_number("q").alias("item_qty"), safe_number("p").alias("item_unit_price"))
    got = [r[0] for r in S.with_line_gross(lines).select(to_double("line_gross")).collect()]
    assert got == [2e14, 40.0, 3e-10, 1234567890123456.8]


def test_one_bad_document_leaves_the_others(spark, tmp_dir):
    good = '{"order_id":"g%d","payment_status":"paid","items":[{"qty":%d,"unit_price":"4"}]}'
    bad = '{"order_id":"b%d","payment_status":"paid","items":"none %d"}'
    put(tmp_dir, "orders_2025-03-04.json", "[%s,%s,%s,%s]" % (good % (1, 1), bad % (1, 1), good % (2, 2), bad % (2, 2)))
    put(tmp_dir, "orders_2025-03-05.json", "[" + good % (3, 3) + ",{")
    clean, bad = read_split(spark, tmp_dir)
    assert {(r["order_id"], r["items"][0]["qty"]) for r in clean if r["order_id"] in ("g1", "g2")} == {("g1", "1"), ("g2", "2")}
    assert {(r["order_id"], r["_corrupt_record"]) for r in bad if r["order_id"]} == {("b1", "none 1"), ("b2", "none 2")}
    size = os.path.getsize(os.path.join(tmp_dir, "orders_2025-03-05.json"))
    whole = [r for r in bad if r["order_id"] is None]
    assert [(r["source_file"], r["_corrupt_record"]) for r in whole] == [("orders_2025-03-05.json", f"unreadable file, bytes: {size}")]


def test_date_layouts(spark):
    texts = ["3/1/2025", "03/01/2025 10:00:00", "20250301", "March 1, 2025", "01-Mar-2025", "2025/03/01 10:00"]
    rows = spark.createDataFrame([(t,) for t in [*texts, "soon", None]], "t string").select(parse_date("t")).collect()
    assert [str(r[0]) for r in rows] == ["2025-03-01"] * 6 + ["None"] * 2
