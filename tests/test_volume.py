"""What a query moves and writes before its result: no whole copy of the order lines."""

import datetime as dt
import hashlib
import os
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom import documents, landing
from ledgerloom.catalog import catalog
from ledgerloom.functions.rules import SALES_ACCOUNT
from ledgerloom.operators import months
from ledgerloom.operators.aggregates import HOME, SKU_COLUMN, SKU_MONTHLY_INPUT, fee_preagg, sales_by_sku, sku_monthly
from ledgerloom.plans import amazon, dashboard
from ledgerloom.queries import AS_OF, _ledgers, all_queries, rpt_amazon_full
from ledgerloom.sources.files import read_json_pages
from ledgerloom.storage import checkpoint_dir

SMALL = "/root/testdata/sf0.001"

PAYMENTS = {"shopify_payouts", "stripe_payouts", "amazon_pay"}

# Tables that a query may store: payments, ledgers, and what it reads several times.
STORED = {
    "adjust_rows": set(),
    "delivery_lines_of_a_month": {"booked_rpt_amazon_full"},
    "rpt_dashboard": PAYMENTS | {"order_lines"},
    "sales_by_sku": PAYMENTS | {"order_lines"},
    "sku_monthly_refresh_amazon": {"booked_rpt_amazon_full"},
    "yearly_sales_by_source": PAYMENTS | {"order_lines"},
    "tax_from_label": set(),
    "control_total": set(),
    "union_channels": set(),
    "rpt_shopify_v1": {"shopify_payouts"},
    "signed_qty": set(),
    "high_water_mark": set(),
    "last_seen_by_amount": set(),
    "expand_sa": {"amazon_pay"},
    "time_window_join": {"stripe_payouts"},
    "rpt_shopify": {"shopify_payouts", "ledger_shopify"},
    "validated_lookup_join": {"stripe_payouts"},
    "latest_k_settlements": set(),
    "running_sum": set(),
    "rpt_dashboard_lite": PAYMENTS | {"order_lines"},
    "sku_monthly_amazon": set(),
    "sku_monthly_shopify": {"shopify_payouts"},
    "sku_monthly_rakuten": set(),
}


@pytest.mark.parametrize("name", STORED)
def test_stores_no_lines_that_it_reads_once(spark, tmp_path, name):
    folder = tmp_path / "tables"
    folder.symlink_to(SMALL)
    all_queries()[name](spark, str(folder))
    base = checkpoint_dir(spark).removeprefix("file:")
    path = f"{base}/tables-{spark.sparkContext.applicationId}/{hashlib.md5(str(folder).encode()).hexdigest()}"
    assert set(os.listdir(path) if os.path.isdir(path) else ()) == STORED[name]


def test_report_lines_are_shuffled_once(spark):
    plan = rpt_amazon_full(catalog(spark, SMALL))._jdf.queryExecution().executedPlan().toString()
    moved = re.findall(r"Exchange hashpartitioning\(([^\n]*?), \d+\), (\w+)", plan)
    assert [how for keys, how in moved if HOME in keys] == ["REPARTITION_BY_COL"]
    assert not [keys for keys, _ in moved if "posted_date_time" in keys]


def test_lines_without_an_order_are_spread_and_added_up_alike(spark, frame):
    schema = "settlement_id double, posted_date_time timestamp_ntz, transaction_type string, amount_type string, amount_description string, order_id string, sku string, amount double, quantity_purchased double"
    rows = [
        (float(s), None, kind, "t", None, order, sku, 2.0, 1.0)
        for s in range(20) for kind in ("Order", "Refund") for order in ("A", None) for sku in ("x", None) for _ in range(3)
    ]
    lines = frame(rows, schema)
    by_order = fee_preagg(lines, by_order=True)
    key = lambda r: repr(r)
    assert sorted(by_order.drop(HOME).collect(), key=key) == sorted(fee_preagg(lines).collect(), key=key)
    homes = by_order.select("order_id", HOME).distinct().groupBy("order_id").agg(F.count("*").alias("n"))
    assert {r.order_id: r.n for r in homes.collect()} == {"A": 1, None: 40}


@pytest.mark.parametrize("name", ["orders_master", "rakuten_all"])
def test_columns_of_the_order_are_shuffled_by_order_only(spark, name):
    """The lines go to their part without the order's columns, and meet the order afterwards."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = catalog(spark, SMALL).table(name)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    joins = re.findall(r"SortMergeJoin[^\n]*", plan)
    assert "orderkey" in joins[0] and "p_partkey" in joins[1]


@pytest.fixture
def no_broadcast(spark):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


@pytest.mark.parametrize("name", ["rpt_dashboard_lite", "yearly_sales_by_source"])
def test_marketplace_lines_meet_their_area_where_they_lie(spark, no_broadcast, name):
    plan = all_queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert [line for line in re.findall(r"SortMergeJoin[^\n]*", plan) if HOME in line and "effective_id" in line]


@pytest.mark.parametrize("channel, report", [("amazon", "rpt_amazon_full"), ("rakuten", "rpt_rakuten_full"), ("shopify", "rpt_shopify_full")])
def test_a_roll_up_by_shards_is_shuffled_once_and_alike(spark, no_broadcast, channel, report):
    lines = all_queries()[report](spark, SMALL).select(*SKU_MONTHLY_INPUT[channel])
    ts = {"amazon": "main_date", "rakuten": "order_date", "shopify": "transaction_date"}[channel]
    stored = lines.withColumn(months.MONTH, months.month_of(ts)).localCheckpoint()
    roll_up = lambda rows: sku_monthly(rows, channel, (months.MONTH, months.SHARD))
    rows = months.rolled_up(stored, roll_up, "month", SKU_COLUMN[channel])
    assert rows._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    plain = months.rolled_up(stored, lambda rows: sku_monthly(rows, channel), "month", None)
    assert set(rows.columns) == set(plain.columns)
    picked = sorted(plain.columns)
    assert rows.select(*picked).exceptAll(plain.select(*picked)).isEmpty() and rows.count() == plain.count()


def test_the_feed_by_month_is_stored_without_item_names(spark, tmp_path):
    """A stock code of several items would multiply the stored lines, and all of them would be shuffled by it."""
    folder = tmp_path / "feed"
    folder.symlink_to(SMALL)
    all_queries()["sales_by_sku"](spark, str(folder))
    by_month = [f for name, f in catalog(spark, str(folder))._frames.items() if name.endswith("_by_month")]
    assert len(by_month) == 1 and "item_name" not in by_month[0].columns


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["last_seen_by_amount", "control_total", "yearly_sales_by_source"])
def test_only_lines_of_the_wanted_rules_are_shuffled(spark, name):
    shuffle = _plan(all_queries()[name](spark, SMALL)).split("REPARTITION_BY_COL")[1]
    assert "LeftSemi" in shuffle.split("Exchange hashpartitioning")[0]


def test_lines_of_some_rules_are_those_of_the_whole_report(spark, frame):
    """Also with keys that have no rule, two rules or a NULL part, and rules that share their labels."""
    line = "settlement_id double, deposit_date timestamp_ntz, posted_date_time timestamp_ntz, transaction_type string, amount_type string, amount_description string, order_id string, sku string, amount double, quantity_purchased double"
    at = dt.datetime(2002, 1, 5)
    keys = [("Order", "Promotion", "Shipping"), ("Order", "Promotion", "Twice"), ("Order", "Promotion", "Also"),
            ("Order", "ItemPrice", "Principal"), ("Order", "ItemPrice", "Unknown"), ("Order", None, "Shipping"), (None, None, None)]
    tv = frame([(float(s), at, at, *key, order, "x", 2.0, 1.0) for s in (1, 2) for key in keys for order in ("A", None)], line)
    oc = frame([("A", at)], "amazon_order_id string, purchase_date timestamp_ntz")
    delivery, other = ("Shipping", SALES_ACCOUNT, "Delivery", "t"), ("Charges", SALES_ACCOUNT, "Sales", "t")
    rules = frame(
        [("OrderPromotionShipping", *delivery), ("OrderPromotionAlso", *delivery), ("OrderPromotionTwice", *delivery),
         ("OrderPromotionTwice", *other), ("OrderItemPricePrincipal", *other)],
        "concatenated_fields string, remarks string, account string, item string, tax_distiction string",
    )
    labels = amazon.delivery_lines(SALES_ACCOUNT, "Delivery", "Shipping")
    whole = amazon.amazon_report(tv, oc, rules, as_of=AS_OF).where(labels)
    some = amazon.amazon_report(tv, oc, rules, as_of=AS_OF, labels=labels)
    assert sorted(some.collect(), key=repr) == sorted(whole.collect(), key=repr) and some.count() == 4
    assert some.agg({"total_real": "sum"}).first()[0] == 24.0


def test_orders_meet_their_lines_before_the_heads_are_made(spark, no_broadcast):
    c = catalog(spark, SMALL)
    plan = _plan(documents.order_documents(c.orders, c.lineitem))
    assert "note_attributes" in plan.split("SortMergeJoin")[0] and "note_attributes" not in plan.split("SortMergeJoin")[1]
    assert documents.order_documents(c.orders, c.lineitem).columns == [*documents.order_heads(c.orders).columns, "line_items", "refunds"]


def test_pages_take_little_disk_and_give_all_documents(spark, frame):
    docs = frame([(i, "x" * 50) for i in range(1000)], "id long, name string")
    folder = landing.order_pages(catalog(spark, SMALL), docs)
    files = [os.path.join(d, f) for d, _, names in os.walk(folder.removeprefix("file:")) for f in names if f.startswith("part-")]
    assert sum(map(os.path.getsize, files)) < 20_000  # 67 KB as plain text
    back = read_json_pages(spark, folder, "orders", "id long, name string", page_per_file=False)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, docs.collect()))


def test_preamble_reports_are_landed_compressed(spark):
    folder = landing.preamble_tsv(catalog(spark, SMALL)).removeprefix("file:").removesuffix("*/")
    files = [f for _, _, names in os.walk(folder) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".txt.gz") for f in files)


def test_refund_lines_read_the_pages_that_were_landed(spark, monkeypatch):
    landed, write = [], landing.order_pages
    monkeypatch.setattr(landing, "order_pages", lambda c, docs: landed.append(write(c, docs)) or landed[-1])
    rows = all_queries()["ingest_refund_lines"](spark, SMALL)
    files = [f for _, _, names in os.walk(landed[0].removeprefix("file:")) for f in names if f.startswith("part-")]
    assert files and all(f.endswith(".json.gz") for f in files) and rows.count() > 0


def test_the_feed_by_month_is_stored_with_what_the_sales_read(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.symlink_to(SMALL)
    all_queries()["sales_by_sku"](spark, str(folder))
    c = catalog(spark, str(folder))
    stored = next(f for name, f in c._frames.items() if name.endswith("_by_month"))
    assert set(stored.columns) == {"transaction_date", "amount", "quantity", "sku", "SOURCE", "item", "account", months.MONTH}
    whole = dashboard.feed_lines(_ledgers(c)).where("date_format(transaction_date, 'yyyy-MM') = '1998-01'")
    plain = sales_by_sku(dashboard.named_feed(whole, c.combined_sku, c.full_imported), "Amazon", 1998, 1)
    key = lambda r: repr(r[:2])
    assert sorted(all_queries()["sales_by_sku"](spark, str(folder)).collect(), key=key) == sorted(plain.collect(), key=key)
