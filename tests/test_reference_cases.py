"""Unit cases of explode, keep-first and rows-to-frame, on own rows."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from ledgerloom.operators import dedup, lines as L

ITEM = StructType([StructField("qty", DoubleType()), StructField("unit_price", DoubleType())])
DOC = StructType(
    [
        StructField("order_id", StringType()),
        StructField("customer_id", StringType()),
        StructField("channel", StringType()),
        StructField("created_at", StringType()),
        StructField("items", ArrayType(ITEM)),
    ]
)


def test_explode_items(spark):
    rows = [
        ("S-17", "k40", "phone", "2024-11-08 23:59:59", [(4.0, 0.25), (0.5, 18.4), (3.0, -6.75)]),
        ("S-18", None, "store", None, [(12.0, 1.99)]),
        ("S-19", "k41", "store", "2024-11-09 07:15:00", []),
    ]
    out = L.normalize_items(L.explode_items(spark.createDataFrame(rows, DOC)))
    prices = {}
    for r in out.collect():
        prices.setdefault(r.order_id, []).append(float(r.item_unit_price))
    assert {k: sorted(v) for k, v in prices.items()} == {"S-17": [-6.75, 0.25, 18.4], "S-18": [1.99]}
    assert "item_qty" in out.columns and "item_unit_price" in out.columns


def test_keep_first(spark):
    schema = "order_id string, customer_id string, channel string, created_at string, item_qty double, item_unit_price double"
    rows = [
        ("S-20", "k7", "store", "2024-11-10 18:30:00", 1.0, 44.0),
        ("S-21", "k8", "phone", "2024-11-10 08:00:00", 6.0, 2.2),
        ("S-20", "k7", "store", "2024-11-10 18:29:59", 2.0, 45.5),
        ("S-20", "k7", "store", "2024-11-11 00:00:00", 3.0, 43.0),
    ]
    out = dedup.keep_first(spark.createDataFrame(rows, schema))
    kept = {r.order_id: (r.created_at, r.item_unit_price) for r in out.collect()}
    assert kept == {"S-20": ("2024-11-10 18:29:59", 45.5), "S-21": ("2024-11-10 08:00:00", 2.2)}
    assert out.where(F.col("order_id") == "S-20").count() == 1


def test_rows_to_frame_inferred_and_declared(spark, capsys):
    from ledgerloom.sources.files import rows_to_frame

    depots = [{"depot": "north quay", "docks": 11}, {"depot": "mill lane", "docks": 4}, {"depot": "upper yard", "docks": None}]
    df = rows_to_frame(spark, depots)
    assert sorted(df.columns) == ["depot", "docks"] and df.count() == 3
    df.show()  # K6
    assert "mill lane" in capsys.readouterr().out
    df2 = rows_to_frame(spark, [("north quay", 11)], "depot string, docks int")
    assert df2.schema.simpleString() == "struct<depot:string,docks:int>"
