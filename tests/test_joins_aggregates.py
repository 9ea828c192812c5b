from decimal import Decimal


from cartwright.operators.aggregate import aggregate_items, aggregate_payments
from cartwright.operators.joins import build_master, enrich_products
from cartwright.operators.clean import clean_orders
from cartwright.sources.schemas import MASTER_COLUMNS
from support import rows


def _orders(spark):
    return spark.createDataFrame(
        [("o1", "c1", "delivered", "2017-10-02 10:00:00", None, None, "2017-10-05 00:00:00",
          "2017-10-10 00:00:00"),
         ("o2", "c2", "canceled", "2017-10-03 10:00:00", None, None, None, "2017-10-20 00:00:00")],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
        "order_approved_at string, order_delivered_carrier_date string, "
        "order_delivered_customer_date string, order_estimated_delivery_date string")


def test_payment_and_item_summaries(spark):
    pay = spark.createDataFrame(
        [("o1", 1, "voucher", Decimal("10.00")), ("o1", 2, "card", Decimal("5.50")),
         ("o1", 3, "card", Decimal("0.00")), ("o1", 4, "card", Decimal("2.25"))],
        "order_id string, payment_sequential int, payment_type string, payment_value decimal(18,2)")
    got = aggregate_payments(pay).collect()[0]
    assert got["total_payment"] == Decimal("17.75") and got["payment_count"] == 3
    assert got["payment_types"] == ["card", "voucher"]
    items = spark.createDataFrame(
        [("o1", 1, Decimal("10.00"), Decimal("1.00")), ("o1", 2, Decimal("5.00"), None)],
        "order_id string, order_item_id int, price decimal(18,2), freight_value decimal(18,2)")
    got = aggregate_items(items).collect()[0]
    assert got["item_count"] == 2 and got["items_total"] == Decimal("15.00")
    assert got["freight_total"] == Decimal("1.00") and got["order_total"] == Decimal("16.00")


def test_master_keeps_orders_without_sides_and_never_fans_out(spark):
    orders = clean_orders(_orders(spark))
    items = aggregate_items(spark.createDataFrame(
        [("o1", i, Decimal("1.00"), Decimal("0.10")) for i in range(1, 4)],
        "order_id string, order_item_id int, price decimal(18,2), freight_value decimal(18,2)"))
    pay = aggregate_payments(spark.createDataFrame(
        [("o1", i, "card", Decimal("1.10")) for i in range(1, 4)],
        "order_id string, payment_sequential int, payment_type string, payment_value decimal(18,2)"))
    customers = spark.createDataFrame(
        [("c1", "u1", 1000, "sp", "SP")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix int, "
        "customer_city string, customer_state string")
    m = build_master(orders, items, customers, pay)
    assert m.columns == MASTER_COLUMNS
    got = {r["order_id"]: r for r in m.collect()}
    assert len(got) == 2                                     # 3 items x 3 payments: still 1 row
    assert got["o1"]["item_count"] == 3 and got["o1"]["payment_count"] == 3
    assert got["o1"]["customer_state"] == "SP"
    o2 = got["o2"]
    assert o2["order_total"] == 0 and o2["total_payment"] == 0     # money filled with 0
    assert o2["item_count"] is None and o2["payment_types"] is None  # counts stay NULL
    assert o2["customer_state"] is None


def test_enrich_products_unknown_has_no_translation(spark):
    products = spark.createDataFrame(
        [("p1", "casa"), ("p2", None), ("p3", "esporte")], "product_id string, product_category_name string")
    tr = spark.createDataFrame([("casa", "home")],
                               "product_category_name string, product_category_name_english string")
    got = rows(enrich_products(products, tr), "product_id", "product_category_name",
               "product_category_name_english")
    assert got == [("p1", "casa", "home"), ("p2", "unknown", None), ("p3", "esporte", None)]
    # a translation of known small size is broadcast by the planner, one of unknown size is not forced
    sized = spark.range(3).selectExpr("concat('casa', id) AS product_category_name",
                                      "concat('home', id) AS product_category_name_english")
    assert "BroadcastHashJoin" in enrich_products(products, sized)._jdf.queryExecution().executedPlan().toString()
    assert "strategy=broadcast" not in enrich_products(products, tr)._jdf.queryExecution().toString()
