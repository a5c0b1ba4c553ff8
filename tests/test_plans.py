"""Report behaviour on tiny inputs, and the shape of the large plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from ledgerloom import documents
from ledgerloom.catalog import catalog
from ledgerloom.operators import aggregates, joins, ledgers, months, nested
from ledgerloom.plans import amazon, shopify
from ledgerloom.queries import AS_OF
from tests.compare import TESTDATA

FOLDER = f"{TESTDATA}/sf0.001"
AT = dt.datetime(2024, 1, 1, 12)

PAYOUTS = "type string, source_type string, source_order_id string, payout_id string, amount double, fee double, net double, processed_at timestamp_ntz"
ORDERS = (
    "id string, name string, email string, processed_at timestamp_ntz, financial_status string, payment_gateway_names string,"
    "lineitem_name string, lineitem_sku string, lineitem_quantity double, lineitem_price double, shipping_shop_amount double,"
    "total_discounts double, discount_amount double, current_total_discounts double"
)


def order(status, name="Tea", ident="1"):
    return (ident, f"#{ident}", "m", AT, status, "g", name, None, 2.0, 540.0, 300.0, 0.0, 0.0, 0.0)


def lines(report):
    return sorted((r["product"], r["real_amount"], r["sku"]) for r in report.collect())


def test_partial_refund_and_adjustment(frame):
    orders = frame([order("partially_refunded"), order("partially_refunded", "Cup")], ORDERS)
    payouts = frame([
        ("refund", "Payments::Refund", "1", "70", -500.0, 0.0, -500.0, AT),
        ("adjustment", "adjustment", "1", "70", -50.0, 0.0, -40.0, AT),
        ("payout", "payout", None, "70", 0.0, 0.0, 0.0, AT),
    ], PAYOUTS)
    got = lines(shopify.shopify_settlement(payouts, orders))
    # one line for the whole partial refund; an adjustment line per order line; no shipping total for adjustments
    assert got == [("adjustment", -40.0, "adjustment")] * 2 + [("partial refund", -500.0, "partial refund")]


def test_charge_with_null_name_keeps_only_order_lines(frame):
    orders = frame([order("paid", None)], ORDERS)
    payouts = frame([("charge", "charge", "1", "70", 1380.0, 47.0, 1333.0, AT)], PAYOUTS)
    got = lines(shopify.shopify_settlement(payouts, orders).fillna("-", ["sku"]))
    assert got == [("Handling Fee", -47.0, "-"), ("Shipping", 300.0, "-")]


def test_two_payout_dates_repeat_goods_lines(frame):
    orders = frame([order("paid")], ORDERS)
    later = AT + dt.timedelta(days=1)
    payouts = frame([
        ("charge", "charge", "1", "70", 1380.0, 0.0, 1380.0, AT),
        ("payout", "payout", None, "70", 0.0, 0.0, 0.0, AT),
        ("payout", "payout", None, "70", 0.0, 0.0, 0.0, later),
    ], PAYOUTS)
    got = [x[0] for x in lines(shopify.shopify_settlement(payouts, orders).fillna("-", ["sku"]))]
    assert got.count("Tea") == 4 and got.count("Shipping") == 2


def test_second_run_books_nothing(spark):
    c = catalog(spark, FOLDER)
    full = shopify.shopify_settlement(c.shopify_payouts, c.orders_master)
    again = shopify.shopify_settlement(c.shopify_payouts, c.orders_master, full.select("control_number"))
    assert full.count() > 0 and again.count() == 0


def test_goods_lines_add_up_to_the_orders(spark):
    c = catalog(spark, FOLDER)
    lines_ = entry.queries()["expand_ss"](spark, FOLDER)
    kinds = ("Shipping", "Tax not included", "Discount", "Handling Fee")
    goods = lines_.where(~F.coalesce(F.col("product").isin(*kinds), F.lit(False))).agg(F.sum("total")).first()[0]
    own = c.orders_master.where("payment_gateway_names = 'stripe'")
    assert goods == own.agg(F.sum(F.col("lineitem_price") * F.col("lineitem_quantity"))).first()[0]


def test_header_rows_without_a_date_are_left_out(frame):
    tv = frame([(1.0, "Order", "a", "b", 5.0, 1.0, "o", "s", None, AT)],
               "settlement_id double, transaction_type string, amount_type string, amount_description string, amount double,"
               "quantity_purchased double, order_id string, sku string, posted_date_time timestamp_ntz, deposit_date timestamp_ntz")
    oc = frame([], "amazon_order_id string, purchase_date timestamp_ntz")
    rules = frame([], "concatenated_fields string, remarks string, account string, item string, tax_distiction string")
    assert amazon.amazon_report(tv, oc, rules, as_of=AS_OF).count() == 0
    dated = tv.withColumn("posted_date_time", F.col("deposit_date"))
    row = amazon.amazon_report(dated, oc, rules, as_of=AS_OF).first()
    assert row.account == "MISSING NOMENCLATURE" and row.DATE_TYPE == "POSTED_DATE"


LARGE = [n for n in entry.queries() if n.startswith(("rpt_", "expand_", "sku_monthly"))]


@pytest.mark.parametrize("name", LARGE)
def test_plans_have_no_python_and_no_nested_loops(spark, name):
    frame_ = entry.queries()[name](spark, FOLDER)
    text = frame_._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython"):
        assert word not in text, (name, word)


def test_a_payout_without_a_date_counts_as_a_date(frame):
    orders = frame([order("paid")], ORDERS)
    payouts = frame([
        ("charge", "charge", "1", "70", 1380.0, 0.0, 1380.0, AT),
        ("payout", "payout", None, "70", 0.0, 0.0, 0.0, AT),
        ("payout", "payout", None, "70", 0.0, 0.0, 0.0, None),
    ], PAYOUTS)
    got = [x[0] for x in lines(shopify.shopify_settlement(payouts, orders).fillna("-", ["sku"]))]
    assert got.count("Tea") == 4 and got.count("Shipping") == 2


def test_payout_ids_that_are_no_numbers_stay(frame):
    orders = frame([order("paid")], ORDERS)
    payouts = frame([("charge", "charge", "1", "P-70", 1380.0, 0.0, 1380.0, AT)], PAYOUTS)
    full = shopify.shopify_settlement(payouts, orders)
    ledger = frame([(1,)], "control_number bigint")
    assert shopify.shopify_settlement(payouts, orders, ledger).count() == full.count() > 0


def ancestors(plan, word):
    """For each line of the plan tree with ``word``: the operators above it, nearest first."""
    plain = [re.sub(r"^[\s:+-]*", "", line) for line in plan.split("\n")]
    depth = [len(line) - len(text) for line, text in zip(plan.split("\n"), plain)]
    for at, text in enumerate(plain):
        if word in text:
            found, deep = [], depth[at]
            for i in range(at - 1, -1, -1):
                if depth[i] < deep:
                    found.append(plain[i])
                    deep = depth[i]
            yield found


@pytest.mark.parametrize("name", ["rpt_shopify", "rpt_stripe", "rpt_amazonpay", "rpt_amazon", "rpt_rakuten"])
def test_the_ledger_is_not_shuffled(spark, name):
    """Between the stored ledger and the join that drops booked settlements nothing moves."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joined = 0
    for above in ancestors(plan, "spark_catalog.default.ledger_"):
        until = next(i for i, text in enumerate(above) if text.startswith(("SortMergeJoin", "Subquery")))
        if above[until].startswith("SortMergeJoin"):
            joined += 1
            assert "LeftAnti" in above[until] and not any("Exchange" in text for text in above[:until]), above[:until]
    assert joined


def test_a_ledger_grows_by_key_and_is_opened_again(spark, frame, tmp_path):
    path = f"{tmp_path}/ledger"
    rows = frame([("s1", 1.0), (None, 2.0)], "settlement string, total double")
    name = ledgers.open_ledger(spark, path, "settlement", rows.schema, buckets=4)
    assert spark.table(name).count() == 0
    ledgers.book(rows, name)
    ledgers.book(frame([(3.0, "s2"), (4.0, "s1")], "total double, settlement string"), name)
    assert sorted(map(tuple, spark.table(name).collect()), key=str) == [("s1", 1.0), ("s1", 4.0), ("s2", 3.0), (None, 2.0)]
    assert ledgers.open_ledger(spark, path, "settlement", rows.schema, buckets=4) == name
    spark.sql(f"DROP TABLE {name}")  # a new session knows nothing of the table, only its files are there
    again = ledgers.open_ledger(spark, path, "settlement", rows.schema, buckets=4)
    new = frame([("s1",), ("s3",), (None,)], "settlement string")
    assert [r[0] for r in joins.not_booked(new, spark.table(again), "settlement").collect()] == ["s3"]


# ---------------------------------------------------------------- order documents


def test_documents_hold_the_lines_of_their_order(spark):
    c = catalog(spark, FOLDER)
    counts = {r["l_orderkey"]: r["count"] for r in c.lineitem.groupBy("l_orderkey").count().collect()}
    docs = documents.order_documents(c.orders, c.lineitem)
    found = {r["id"]: (r["n"], r["returned"]) for r in docs.selectExpr("id", "size(line_items) AS n", "size(flatten(refunds.refund_line_items)) AS returned").collect()}
    assert {k: n for k, (n, _) in found.items()} == {r["o_orderkey"]: counts.get(r["o_orderkey"], 0) for r in c.orders.select("o_orderkey").collect()}
    assert 0 in {n for n, _ in found.values()}  # orders without lines stay
    assert sum(n for _, n in found.values()) == c.lineitem.where("l_returnflag = 'R'").count()
    assert nested.explode_lines(docs.where("size(line_items) = 0").select("id", "line_items")).where("lineitem_name IS NULL").count() == c.orders.count() - len(counts)


def test_an_order_with_many_lines_comes_as_several_documents(spark):
    c = catalog(spark, FOLDER)
    hot = c.lineitem.select(*[F.lit(1).cast("bigint").alias(x) if x == "l_orderkey" else F.col(x) for x in c.lineitem.columns])
    orders = c.orders.limit(2).withColumn("o_orderkey", F.monotonically_increasing_id() % 2 + 1).dropDuplicates(["o_orderkey"])
    sizes = sorted(r[0] for r in documents.order_documents(orders, hot).where("id = 1").selectExpr("size(line_items)").collect())
    assert sum(sizes) == hot.count() and len(sizes) == -(-hot.count() // documents.LINES_PER_DOCUMENT)
    assert max(sizes) < 2 * documents.LINES_PER_DOCUMENT


# ---------------------------------------------------------------- roll-ups by month

FEED = "SOURCE string, item_name string, sku string, quantity double, amount double, transaction_date timestamp_ntz"


def months_read(df):
    """Folders that a frame's rows come from."""
    return {r[0].split(f"{months.MONTH}=")[1].split("/")[0] for r in df.select("_metadata.file_path").distinct().collect()}


def test_sales_of_a_month_read_that_month_only(spark, frame, tmp_path):
    at = lambda y, m, d: dt.datetime(y, m, d, 23, 59, 59)
    rows = [("A", "tea", "s", 1.0, 2.0, at(1998, 1, 1)), ("A", "tea", "s", 1.0, 3.0, at(1998, 1, 31)), ("B", "tea", "s", 1.0, 5.0, at(1998, 1, 9)),
            ("A", "tea", "s", 1.0, 7.0, at(1998, 2, 1)), ("A", "tea", "s", 1.0, 11.0, at(1997, 1, 5)), ("A", "tea", "s", 1.0, 13.0, None)]
    feed = frame(rows, FEED)
    months.append_by_month(feed, "transaction_date", str(tmp_path))
    stored = months.read_by_month(spark, str(tmp_path), feed.schema)
    assert months_read(stored) == {"1997-01", "1998-01", "1998-02", months.UNDATED}
    got = aggregates.sales_by_sku(stored, "A", 1998, 1)
    assert [tuple(r) for r in got.collect()] == [("tea", "s", 2.0, 5.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*ledger_month#\d+ = 1998-01", plan)
    assert [tuple(r) for r in aggregates.sales_by_sku(feed, "A", 1998, 1).collect()] == [("tea", "s", 2.0, 5.0)]
    assert sorted((r.year, r.total) for r in aggregates.yearly_sales_by_source(stored.withColumn("item", F.lit("Sales")).where("SOURCE = 'A' AND transaction_date IS NOT NULL")).collect()) == [(1997, 11.0), (1998, 12.0)]


def test_a_batch_rolls_up_its_own_months_again(spark, frame, tmp_path):
    schema = "k string, at timestamp_ntz, v double"
    day = lambda m, d: dt.datetime(2024, m, d)
    ledger, rollup = str(tmp_path / "ledger"), str(tmp_path / "rollup")

    def roll_up(rows):
        lines = rows.select("k", F.trunc("at", "month").alias("month"), "v")
        return lines.groupBy("k", "month").agg(F.sum("v").alias("v"))

    def add(rows):
        batch = frame(rows, schema)
        months.append_by_month(batch, "at", ledger)
        stored = months.read_by_month(spark, ledger, batch.schema)
        months.refresh_rollup(stored, batch, "at", roll_up, "month", rollup)
        return stored, batch

    def result():
        return sorted(((r.k, r.month and r.month.month, r.v) for r in spark.read.parquet(rollup).collect()), key=repr)

    def files():
        return {str(p.relative_to(tmp_path)): p.stat().st_mtime_ns for p in (tmp_path / "rollup").rglob("*.parquet")}

    add([("a", day(1, 1), 1.0), ("a", day(1, 31), 2.0), ("b", day(2, 1), 4.0), ("b", None, 8.0), ("c", day(3, 3), 16.0)])
    assert result() == [("a", 1, 3.0), ("b", 2, 4.0), ("b", None, 8.0), ("c", 3, 16.0)]
    before = files()
    stored, batch = add([("a", day(2, 2), 32.0), ("b", None, 64.0), ("d", day(4, 4), 128.0)])
    want = [("a", 1, 3.0), ("a", 2, 32.0), ("b", 2, 4.0), ("b", None, 72.0), ("c", 3, 16.0), ("d", 4, 128.0)]
    assert result() == want
    same = {f for f, time in files().items() if before.get(f) == time}
    assert {f.split("=")[1].split("/")[0] for f in same} == {"2024-01", "2024-03"}
    touched = months.in_months_of(stored, batch, "at")
    assert months_read(touched) == {"2024-02", "2024-04", months.UNDATED}
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\n]*array_contains\([^\n]*subquery[^\n]*ledger_month", plan, re.I)
    touched.collect()
    months.refresh_rollup(stored, batch, "at", roll_up, "month", rollup)  # a batch that is repeated
    assert result() == want
    months.refresh_rollup(stored, batch.where("false"), "at", roll_up, "month", rollup)
    assert result() == want
