"""Open schema and element-level quarantine on hand-written files."""

import json

from ledgerloom.operators import lines as L
from ledgerloom.plans.month_job import run_month
from ledgerloom.sources import files as SRC
from ledgerloom.sources import open_json as OPEN

DAY = """[{"order_id": "a", "customer_id": "c1", "channel": "web", "created_at": "2025-03-01 10:00:00", "payment_status": "paid",
  "note": "gift", "Weird Name": {"x": [1, 2]},
  "items": [{"qty": 2, "unit_price": "2.50", "color": "red"}, {"quantity": "1", "price": 3, "dim": {"w": 1}}]},
 7, "x", null,
 {"order_id": 12, "customer_id": "c1", "channel": "web", "created_at": "2025-03-01 11:00:00", "payment_status": "paid",
  "NOTE": "late", "vip": true, "items": [{"qty": 1, "unit_price": 4, "Color": "blue"}]},
 {"order_id": "bad", "items": {"qty": 1}}, {"order_id": "none", "items": null}]"""


def write_month(folder):
    (folder / "orders_2025-03-01.json").write_text(DAY)
    (folder / "orders_2025-03-02.json").write_text('{"order_id": "single", "payment_status": "paid", "items": []}')
    (folder / "orders_2025-03-03.json").write_text('[{"order_id": "cut"')
    (folder / "orders_2025-03-04.json").write_text("")
    (folder / "orders_2025-03-05.json").write_text("[]")
    (folder / "orders_2025-03-32.json").write_text('[{"order_id": "no such day"}]')
    (folder / "customers.csv").write_text("customer_id,city,is_active\nc1,Oslo,1\n")
    (folder / "refunds.csv").write_text("order_id,amount,created_at\n")


def test_every_field_becomes_a_column(spark, tmp_path):
    write_month(tmp_path)
    docs = OPEN.read_open_orders(spark, str(tmp_path), 2025, 3)
    clean, quarantine = SRC.split_corrupt(docs)
    rows = {r["order_id"]: r for r in clean.collect()}
    assert set(rows) == {"a", "12", "none", "single"}
    assert (rows["a"]["NOTE"], rows["12"]["NOTE"], rows["12"]["vip"]) == ("gift", "late", "true")
    assert json.loads(rows["a"]["Weird Name"]) == {"x": [1, 2]} and rows["none"]["items"] is None and rows["single"]["items"] == []
    lines = L.explode_items(clean).orderBy("order_id", "item_pos").collect()
    assert [(r["order_id"], r["item_qty"], r["item_quantity"], r["item_unit_price"], r["item_price"], r["item_Color"], r["item_dim"]) for r in lines] == [
        ("12", "1", None, "4", None, "blue", None),
        ("a", "2", None, "2.50", None, "red", None),
        ("a", None, "1", None, "3", None, '{"w":1}'),
    ]
    assert sorted((r["source_file"], r["_corrupt_record"]) for r in quarantine.collect()) == [
        ("orders_2025-03-01.json", '"x"'),
        ("orders_2025-03-01.json", "7"),
        ("orders_2025-03-01.json", "null"),
        ("orders_2025-03-01.json", '{"qty":1}'),
        ("orders_2025-03-03.json", "unreadable file, bytes: 19"),
    ]


def test_lines_of_a_month_partition(spark, tmp_path):
    folder = tmp_path / "order_month=2025-03"
    folder.mkdir()
    (folder / "part-0.json").write_text('{"order_id": "a", "extra": 1.50, "items": [{"qty": 1, "line": 3}]}\n\n{"order_id": "b"')
    docs = OPEN.read_open_orders(spark, str(tmp_path), 2025, 3, "month_partitions")
    clean, quarantine = SRC.split_corrupt(docs)
    assert [(r["order_id"], r["extra"], r["items"][0]["line"]) for r in clean.collect()] in ([("a", "1.5", "3")], [("a", "1.50", "3")])
    assert [r["_corrupt_record"] for r in quarantine.collect()] == ['{"order_id": "b"']
    given = OPEN.read_open_orders(spark, str(tmp_path), 2025, 3, "month_partitions", OPEN.Fields(("later",), ()))
    assert "later" in given.columns and "extra" not in given.columns
    assert OPEN.read_open_orders(spark, str(tmp_path), 2024, 1, "month_partitions").count() == 0
    assert OPEN.read_open_orders(spark, str(tmp_path), 2024, 1).count() == 0


def test_job_keeps_the_documents_of_a_day_with_a_stray_element(spark, tmp_path):
    write_month(tmp_path)
    counters = run_month(spark, str(tmp_path), str(tmp_path / "out"), 2025, 3)
    assert counters["orders_loaded"] == 4 and counters["orders_paid"] == 3 and counters["orders_corrupt"] == 5
    report = spark.read.parquet(str(tmp_path / "out" / "tables" / "daily_city_sales")).collect()
    assert [(r["city"], r["orders_count"], r["gross_revenue_eur"]) for r in report] == [("Oslo", 2, 9.0)]
