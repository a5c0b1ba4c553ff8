import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import aggregates, expand, joins, maintenance, nested, windows
from ledgerloom.schemas import schema


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---------------------------------------------------------------- joins


def test_contains_join_equals_brute_force(frame):
    random.seed(1)
    texts = ["".join(random.choice("123") for _ in range(random.randint(0, 9))) for _ in range(60)] + [None]
    ids = ["".join(random.choice("123") for _ in range(random.randint(1, 5))) for _ in range(40)] + [None, "12", "12"]
    left = frame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    right = frame([(i, t) for i, t in enumerate(ids)], "m int, c string")
    got = joins.contains_join(left, "t", right, "c")
    want = [(n, m) for n, t in enumerate(texts) for m, c in enumerate(ids) if t is not None and c is not None and c in t]
    assert rows(got.select("n", "m")) == sorted(want, key=repr)
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_time_window_join_edges_and_hot_key(frame):
    base = dt.datetime(2024, 1, 1, 0, 0, 5, 500000)
    offsets = [-1.0, 0.0, 0.2, 1.0, 6.4, 7.0, 7.4, 7.6, 8.0, 9.0]
    left = frame([("a", base), ("b", base), (None, base)], "mail string, at timestamp_ntz")
    right = frame([("a", base + dt.timedelta(seconds=s), s) for s in offsets], "who string, paid timestamp_ntz, s double")
    got = joins.time_window_join(left, right, [("mail", "who")], "at", "paid", 7)
    # strictly later, and at most 7 second boundaries apart (5.5 s + 7.4 s is second 12)
    assert sorted(r.s for r in got.where("mail = 'a'").collect()) == [0.2, 1.0, 6.4, 7.0, 7.4]
    assert [r.s for r in got.where("mail = 'b' OR mail IS NULL").collect()] == [None, None]


def test_not_booked_null_rules(frame):
    df = frame([(1,), (2,), (None,)], "k int")
    assert rows(joins.not_booked(df, frame([(1,), (None,)], "k int"), "k")) == [(2,)]
    assert rows(joins.not_booked(df, frame([(None,)], "k int"), "k")) == [(1,), (2,), (None,)]
    assert rows(joins.not_booked(df, frame([], "k int"), "k")) == [(1,), (2,), (None,)]
    assert rows(joins.not_booked(df, None, "k")) == [(1,), (2,), (None,)]


def test_lookup_join_is_void_on_repeated_key(frame):
    left = frame([("1", None), ("2", "own"), ("3", None)], "id string, reference string")
    good = frame([("1", "a"), ("2", "b")], "order_id string, charge_ref string")
    bad = good.unionByName(frame([("2", "c")], "order_id string, charge_ref string"))
    on, fill = ("id", "order_id"), ("reference", "charge_ref")
    assert rows(joins.lookup_join(left, good, on, fill)) == [("1", "a"), ("2", "own"), ("3", None)]
    assert rows(joins.lookup_join(left, bad, on, fill)) == rows(left)
    assert rows(joins.lookup_join(left, bad, on, fill, validate=False)) == [("1", "a"), ("2", "own"), ("3", None)]


def test_sparse_left_join_keeps_null_keys(frame):
    left = frame([(None, "A", 1)] * 3 + [("s", "A", 2), ("s", "B", 3)], "sku string, SOURCE string, n int")
    names = frame([("s", "A", "item"), (None, "A", "never")], "sku_item string, store_name string, item_name string")
    got = joins.attach_item(left, names)
    assert rows(got) == sorted([(None, "A", 1, None)] * 3 + [("s", "A", 2, "item"), ("s", "B", 3, None)], key=repr)


def test_scalar_lookup_rejects_second_row(frame):
    df = frame([("a",)], "k string")
    two = frame([("a", 1), ("a", 2)], "d string, v int")
    with pytest.raises(Exception, match="more than one row"):
        joins.scalar_lookup(df, two, ("k", "d"), "v", "x").collect()
    assert rows(joins.scalar_lookup(df, two.limit(1), ("k", "d"), "v", "x")) == [("a", 1)]


def test_positional_join_marks_wrong_mail(frame):
    left = frame([("c1", "a", 1), ("c2", "b", 2), ("c3", None, 3), ("c4", "d", 4)], "charge string, mail string, at int")
    right = frame([("o1", "a", 5), ("o2", "x", 6), ("o3", "c", 7)], "name string, email string, placed int")
    got = joins.positional_join(left, right, ["at"], ["placed"], ("mail", "email"))
    assert [(r.charge, r.name, r.verify) for r in got.orderBy("charge").collect()] == [
        ("c1", "o1", None), ("c2", "o2", "WRONG_UNION"), ("c3", "o3", None), ("c4", None, None)]


def test_positional_join_over_many_partitions(frame):
    random.seed(4)
    lefts = [(f"c{i}", random.randint(0, 40), i) for i in range(700)]  # ties, told apart by the second key
    rights = [(f"o{i}", float(random.randint(0, 9)), f"n{i:04}") for i in range(500)]
    left = frame(lefts, "charge string, at int, tie int").repartition(7)
    right = frame(rights, "name string, at double, tie string").repartition(5)
    got = joins.positional_join(left, right.withColumnsRenamed({"at": "placed", "tie": "last"}), ["at", "tie"], ["placed", "last"], ("charge", "name"))
    by_left, by_right = sorted(lefts, key=lambda r: r[1:]), sorted(rights, key=lambda r: r[1:])
    assert sorted((r.charge, r.name) for r in got.collect()) == sorted(
        (c[0], by_right[i][0] if i < len(by_right) else None) for i, c in enumerate(by_left))


@pytest.mark.parametrize("n_left, n_right", [(0, 3), (3, 0), (0, 0), (2, 5)])
def test_positional_join_with_an_empty_side(frame, n_left, n_right):
    left = frame([(i,) for i in range(n_left)], "a int")
    right = frame([(i * 10,) for i in range(n_right)], "b int")
    got = joins.positional_join(left, right, ["a"], ["b"], ("a", "a"))
    assert sorted((r.a, r.b) for r in got.collect()) == [(i, i * 10 if n_right else None) for i in range(n_left)]


def test_positional_join_partitions_both_sides_at_once(frame, monkeypatch):
    plans = []
    keep = windows.stored
    monkeypatch.setattr(windows, "stored", lambda df, name: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df, name))
    left, right = frame([(1,)], "a int"), frame([(2,)], "b int")
    joined = joins.positional_join(left, right, ["a"], ["b"], ("a", "b"))._jdf.queryExecution().optimizedPlan().toString()
    assert len(plans) == 1 and plans[0].count("RepartitionByExpression") == 1
    assert "RepartitionByExpression" not in joined


def test_join_distinct_fans_out_on_different_rows(frame):
    left = frame([("p",)], "k string")
    dim = frame([("p", 1), ("p", 1), ("p", 2)], "k2 string, v int")
    assert rows(joins.join_distinct(left, dim, [("k", "k2")], {"v": F.col("v")})) == [("p", 1), ("p", 2)]
    assert rows(joins.join_distinct(left, dim, [("k", "k2")], {"v": F.col("v")}, sparse=True)) == [("p", 1), ("p", 2)]


# ---------------------------------------------------------------- windows


@pytest.mark.parametrize("hot", [False, True])
def test_global_row_number(frame, hot):
    random.seed(2)
    data = [(7 if hot and i % 3 == 0 else random.randint(0, 500), i) for i in range(2000)]
    got = windows.global_row_number(frame(data, "a int, b int").repartition(5), ["a", "b"])
    assert [(r.a, r.b, r.row_number) for r in got.orderBy("row_number").collect()] == [
        (a, b, n) for n, (a, b) in enumerate(sorted(data), 1)]


def test_running_sum_peers_and_nulls(frame):
    df = frame([(None, 5), (1, None), (1, 2), (2, 3), (2, 4), (3, None)], "d int, v bigint")
    assert sorted((str(r.d), r.running_sum) for r in windows.running_sum(df, "d", "v").collect()) == [
        ("1", 7), ("1", 7), ("2", 14), ("2", 14), ("3", 14), ("None", 5)]
    assert {r.running_sum for r in windows.running_sum(frame([(1, None)], "d int, v bigint"), "d", "v").collect()} == {None}


def test_no_single_task_window_over_rows(frame):
    df = frame([(i, i) for i in range(50)], "d int, v bigint")
    for part in plan(windows.running_sum(df, "d", "v")).split("\n"):
        # the only window without partition keys runs over one row per partition
        if "Window" in part and "_part" not in part:
            raise AssertionError(part)


def test_latest_k_and_order(frame):
    df = frame([("9",), ("10",), ("10",), ("8",), (None,)], "k string")
    assert rows(windows.latest_k(df, "k", 2)) == [("8",), ("9",)]
    assert [r.k for r in windows.order_report(df, [("k", True)]).collect()][0] is None
    assert [r.k for r in windows.order_report(df, [("k", False)]).collect()][-1] is None


# ---------------------------------------------------------------- expansion


def test_expand_distinct_only_within_branch(frame):
    df = frame([("o1", 5.0)] * 3 + [("o2", 0.0)], "o string, x double")
    same = {"o": F.col("o"), "x": F.col("x")}
    branches = [
        expand.Branch("all", None, same),
        expand.Branch("some", F.col("x") > 0, same, distinct=True),
        expand.Branch("more", F.col("x") > 0, same, distinct=True),
    ]
    got = expand.expand(df, branches, schema("o string, x double"))
    assert plan(got).count("Exchange hashpartitioning") == 1  # both DISTINCT branches share it
    assert rows(got) == sorted([("o1", 5.0)] * 5 + [("o2", 0.0)])


def test_expand_has_no_negative_zero(frame):
    df = frame([(0.0,)], "x double")
    got = expand.expand(df, [expand.Branch("a", None, {"x": -F.col("x")})], schema("x double"))
    assert str(got.first().x) == "0.0"


# ---------------------------------------------------------------- aggregates


def test_shopify_month_groups_by_rewritten_remark(frame):
    day = dt.date(2023, 1, 31)
    ledger = frame(
        [(1, "s", day, "acc", "t", f"Product Charges (#{i})", "Sales", "P", 10.0, 1.0) for i in (1, 2)]
        + [(1, "s", day, "acc", "t", "Fee (#1)", "Sales", "Handling Fee", -30.0, 1.0)],
        "control_number bigint, sku string, transaction_date date, account string, tax_distinction string, remarks string,"
        " item string, product string, real_amount double, product_count double")
    got = {r.remarks: r for r in aggregates.sku_monthly(ledger, "shopify").collect()}
    assert got["Product Charges"].total_quantity == 2 and got["Product Charges"].total_amount == 20.0
    assert got["Fee"].total_quantity is None and got["Fee"].balance == "支出"
    assert got["Fee"].month == dt.date(2023, 1, 1)


# ---------------------------------------------------------------- maintenance


def test_replace_by_key_is_idempotent(frame):
    target = frame([("1", "a"), ("1", "b"), ("2", "c")], "id string, v string")
    batch = frame([("1", "z"), ("3", "y")], "id string, v string")
    once = maintenance.replace_by_key(target, batch, "id")
    assert rows(once) == [("1", "z"), ("2", "c"), ("3", "y")]
    assert rows(maintenance.replace_by_key(once, batch, "id")) == rows(once)


def test_trims_keep_all_without_a_bound(frame):
    at = dt.datetime
    orders = frame([("9", at(2024, 1, 1)), ("10", at(2024, 1, 20)), (None, at(2024, 1, 2))], "order_number string, created_at timestamp_ntz")
    kept = maintenance.trim_recent(orders, 14, dt.date(2024, 1, 21))
    assert sorted(str(r.order_number) for r in kept.collect()) == ["9", "None"]
    assert maintenance.trim_recent(orders, 14, dt.date(2020, 1, 1)).count() == 3
    paid = frame([("9", "paid"), ("10", "pending"), ("11", "paid")], "id string, payout_status string")
    assert rows(maintenance.trim_from_first_pending(paid)) == [("9", "paid")]
    assert maintenance.trim_from_first_pending(paid.where("id <> '10'")).count() == 2


def test_high_water_mark_is_numeric(frame):
    df = frame([("9", "a"), ("10", "b")], "order_number string, id string")
    assert maintenance.high_water_mark(df, "order_number", "id").first().cursor == "b"
    assert maintenance.high_water_mark(df.limit(0), "order_number", "id", maintenance.NO_ORDER_CURSOR).first().cursor == "9999999999999"


def test_last_refunded_order(frame):
    orders = frame([("11", "#1"), ("12", "#2")], "id string, name string")
    refunds = frame([(5, "#1"), (9, "#2")], "id bigint, name string")
    assert rows(maintenance.last_refunded_order(orders, refunds)) == [("12",)]


def test_conform_quarantine_align(frame):
    df = frame([("1", "x", "z"), ("bad", "y", "z")], "a string, b string, extra string")
    target = schema("a bigint, b string, token string, other double")
    assert rows(maintenance.conform(df, target, ("token",))) == sorted(
        [(1, "x", "DEPRECATED", None), (None, "y", "DEPRECATED", None)], key=repr)
    good, bad = maintenance.quarantine(df, schema("a bigint, b string"))
    assert rows(good) == [(1, "x")] and rows(bad) == [("bad", "y", "z")]
    with pytest.raises(KeyError):
        maintenance.align_to(df, target)
    assert maintenance.align_to(df, target, strict=False).columns == ["a", "b", "token", "other"]


def test_incremental_window_bounds(frame):
    at = dt.datetime
    df = frame([(at(2024, 1, 1),), (at(2024, 1, 1, 0, 0, 1),), (at(2024, 1, 8, 23, 59, 59),), (at(2024, 1, 9),)], "t timestamp_ntz")
    got = maintenance.incremental_window(df, "t", F.lit(at(2024, 1, 1)).cast("timestamp_ntz"), dt.date(2024, 1, 10), "payouts")
    assert rows(got) == [(at(2024, 1, 1, 0, 0, 1),), (at(2024, 1, 8, 23, 59, 59),)]


def test_new_files_only_and_stamp(frame):
    df = frame([("f1", 1), ("f2", 2)], "FILE_NAME string, x int")
    assert rows(maintenance.new_files_only(df, frame([("f1", 0)], "FILE_NAME string, y int"))) == [("f2", 2)]
    assert maintenance.new_files_only(df, None).count() == 2
    stamped = maintenance.stamp(frame([(1,)], "x int"), F.lit("f"), F.lit("t"))
    assert rows(stamped) == [(1, "f", "t")]


def test_sinks(spark, frame, tmp_path):
    df = frame([(1,), (2,)], "x int")
    maintenance.load_batch([df, df], f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 4
    path = maintenance.snapshot_csv(df, str(tmp_path), dt.date(2024, 1, 8))
    assert path.endswith("2024_01_08") and spark.read.option("header", True).csv(path).count() == 2


# ---------------------------------------------------------------- nested


def test_order_without_lines_stays(frame):
    docs = frame([(1, []), (2, None)], "id bigint, line_items array<struct<quantity bigint, name string, price string, sku string,"
                 " discount_allocations array<struct<amount string>>>>")
    assert rows(nested.explode_lines(docs)) == [(1, None, None, None, None, 0.0), (2, None, None, None, None, 0.0)]


def test_charge_refs_cases(frame):
    ok = '{"status": "success", "payment_id": "p%d", "receipt": {"a": ["ch_2", "ch_1"]}}'
    plain = '{"status": "success", "payment_id": "p%d"}'
    df = frame([("o1", [ok % 1, ok % 2]), ("o2", [plain % 1, plain % 2]), ("o3", ['{"status": "failure", "x": "ch_9"}'])],
               "order_id string, transactions array<string>")
    assert rows(nested.charge_refs(df)) == [("o1", "ch_1-ch_2"), ("o2", "p1"), ("o2", "p2")]


def test_expand_once_gives_the_same_lines(frame):
    df = frame([("a", 1.0), ("a", 1.0), ("b", 2.0), (None, -0.0)], "k string, v double")
    branches = [
        expand.Branch("plain", None, {"o": F.col("k"), "x": F.col("v")}),
        expand.Branch("once", F.col("v") > 0, {"o": F.col("k"), "x": F.col("v")}, distinct=True),
    ]
    target = schema("o string, x double")
    rows = [sorted(map(tuple, f(df, branches, target).collect()), key=repr) for f in (expand.expand, expand.expand_once)]
    assert rows[0] == rows[1] and len(rows[0]) == 6


def test_a_gateway_with_a_repeated_reference_loses_only_its_own(frame):
    orders = frame([("1", "stripe", None), ("2", "Komoju - card", None), ("3", "komoju", "kept"), ("4", None, None)],
                   "id string, payment_gateway_names string, reference string")
    refs = frame([("1", "ch_1"), ("2", "ch_2"), ("2", "ch_3"), ("3", "ch_4"), (None, "ch_5"), ("9", "ch_9")], "order_id string, charge_ref string")
    got = joins.attach_charge_refs(orders, refs)
    assert got.columns == orders.columns
    assert sorted((r.id, r.reference) for r in got.collect()) == [("1", "ch_1"), ("2", None), ("3", "kept"), ("4", None)]
