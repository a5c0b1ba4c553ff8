import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import dates, money, nested, rules, text


def values(frame, column):
    return [r[0] for r in frame.select(column).collect()]


def test_rounding_is_half_away_from_zero(frame):
    df = frame([(2.5,), (-2.5,), (0.4,)], "x double")
    assert values(df, F.round("x")) == [3.0, -3.0, 0.0]


def test_truncate_goes_toward_zero(frame):
    df = frame([(2.9,), (-2.9,), (None,)], "x double")
    assert values(df, money.truncate(F.col("x"))) == [2.0, -2.0, None]


def test_tax_parts_add_up(frame):
    df = frame([(108.0,), (-216.0,), (99.0,)], "x double")
    total = F.col("x")
    for net, tax, x in df.select(money.net_of_tax(total), money.tax_part(total), "x").collect():
        assert net + tax == x
    assert values(df.limit(1), money.eleventh(F.lit(110.0))) == [10.0]
    assert values(df.limit(1), money.net_of_eleventh(F.lit(110.0))) == [100.0]


def test_gateway_fee_rounds_each_rate(frame):
    # 0.036 * 50 = 1.8 -> 2 and 0.01 * 50 = 0.5 -> 1
    assert values(frame([(50.0,)], "x double"), money.gateway_fee(F.col("x"))) == [-3.0]


def test_tax_rate_of_label(frame):
    df = frame([(rules.TAX_8,), (rules.TAX_10,), (rules.TAX_NONE,), (None,)], "x string")
    assert values(df, money.tax_rate_of_label(F.col("x"))) == [0.08, 0.1, 0.0, 0.0]


def test_null_tokens_differ_per_feed(frame):
    df = frame([("NaN",), ("NULL",), (" ",), ("none",), ("x",), (None,)], "a string")
    kept = lambda tokens, fold: [r.a for r in text.null_tokens(df, tokens, fold).collect()]
    assert kept(text.MARKETPLACE_NULLS, True) == [None, None, None, "none", "x", None]
    assert kept(text.ORDER_NULLS, True) == [None, None, " ", None, "x", None]
    assert kept(text.PAYOUT_NULLS, False) == [None, "NULL", " ", "none", "x", None]
    assert kept(text.RAKUTEN_NULLS, False) == ["NaN", "NULL", " ", None, "x", None]


def test_ids_and_numbers(frame):
    df = frame([("77.0",), ("1.05",), ("1.234E3",), ("9007199254740993",), ("abc",), (None,)], "a string")
    a = F.col("a")
    assert values(df, text.canonical_id(a)) == ["77", "1", "1234", "9007199254740993", None, None]
    assert values(df, text.strip_dot_zero(a)) == ["77", "1.05", "1.234E3", "9007199254740993", "abc", None]
    assert values(df, text.strip_dot_zero(a, anywhere=True))[1] == "15"
    assert values(frame([("1,234.00",)], "a string"), text.clean_number(a, (",", ".00"))) == [1234.0]
    assert values(frame([("{'a': [1]}\n",)], "a string"), text.clean_text(a)) == ["a: 1"]


def test_sku_and_zip(frame):
    df = frame([("v_4901234567890x", "012", "7"), ("vX4901234567890x", "012", "12345"), ("4901234567890-b", "012", None)],
               "item string, a string, b string")
    assert values(df, text.normalize_sku(F.col("item"))) == ["4901234567890"] * 3
    assert values(df, text.zip_code(F.col("a"), F.col("b"))) == ["012-0007", "012-12345", None]


def test_rule_key_needs_all_parts(frame):
    df = frame([("Order", "ItemPrice", "Principal"), ("Order", "ItemPrice", None), ("CouponRedemptionFee", "Coupon", None)],
               "t string, a string, d string")
    assert values(df, text.rule_key(*map(F.col, "tad"))) == ["OrderItemPricePrincipal", None, "CouponRedemptionFeeCoupon"]


def test_headers(frame):
    assert text.normalize_headers(frame([(1,)], "` Settlement-ID ` int")).columns == ["settlement_id"]
    assert text.normalize_headers(frame([(1,)], "`,SettlementId` int"), drop_commas=True).columns == ["settlementid"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_parse_ts_does_not_depend_on_the_session_zone(spark, frame, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = frame([("15.01.2024 10:20:30 UTC",), ("2024-01-15T10:20:30+09:00",), ("15.01.2024",), ("bad",)], "x string")
        formats = ("dd.MM.yyyy HH:mm:ss z", "yyyy-MM-dd'T'HH:mm:ssXXX", "dd.MM.yyyy")
        assert values(df, dates.parse_ts(F.col("x"), formats)) == [
            dt.datetime(2024, 1, 15, 10, 20, 30), dt.datetime(2024, 1, 15, 1, 20, 30), dt.datetime(2024, 1, 15), None,
        ]
        assert values(df.limit(1), dates.epoch_to_ts(F.lit(86400))) == [dt.datetime(1970, 1, 2)]
        assert values(df.limit(1), dates.to_local(dates.ntz("2024-01-01 20:00:00"))) == [dt.datetime(2024, 1, 2, 5)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_find_tokens(frame):
    body = '{"ch_key": 1, "a": [["ch_b", "x"], {"c": "ch_a"}], "d": "ch_b", "e": "xch_q", "ch_k2" : "v"}'
    assert values(frame([(body,)], "j string"), nested.find_tokens(F.col("j"), "ch_")) == [["ch_a", "ch_b"]]


def test_sum_amounts_handles_empty_and_text(frame):
    df = frame([([("12.50",), ("bad",), (None,)],), ([],), (None,)], "a array<struct<amount:string>>")
    assert values(df, nested.sum_amounts(F.col("a"))) == [12.5, 0.0, 0.0]
    assert values(df, nested.sum_amounts(F.col("a"), whole_units=True)) == [12.0, 0.0, 0.0]


def test_classify_null_product(frame):
    df = frame([(None, 100.0), ("Shipping", 110.0), ("Handling Fee", -3.0), ("GoCLN シェイカー B", 100.0)], "product string, total double")
    labels = rules.classify(F.col("product"), F.lit("#1"), F.col("total"), rules.RULESETS["sa"])
    rows = df.select(*[v.alias(k) for k, v in labels.items()]).collect()
    assert tuple(rows[0]) == (rules.SALES_ACCOUNT, rules.TAX_8, 8.0, None, None)
    assert tuple(rows[1]) == (rules.SALES_ACCOUNT, rules.TAX_10, 11.0, "Delivery (#1)", "Delivery")
    assert tuple(rows[2]) == (rules.FEE_ACCOUNT, rules.TAX_NONE, 0.0, "Fee (#1)", "Fee Shopify")
    assert rows[3]["tax_distinction"] == rules.TAX_10
    old = rules.classify(F.col("product"), F.lit("#1"), F.col("total"), rules.RULESETS["sa_old"])
    assert df.select(old["tax_distinction"]).collect()[3][0] == rules.TAX_8  # exact name only


def test_points_are_reduced_rate_and_cut(frame):
    labels = rules.classify_marketplace(F.col("p"), F.lit("7"), F.col("t"))
    rows = frame([("points", -199.0), ("delivery", 199.0), (None, 5.0)], "p string, t double").select(
        *[v.alias(k) for k, v in labels.items()]).collect()
    assert rows[0].tax_distinction == rules.TAX_8 and rows[0].tax_amount == 15.0 and rows[0].remarks == "Points issued (#7)"
    assert rows[1].tax_amount == 19.0
    assert rows[2].tax_distinction is None and rows[2].tax_amount is None


def test_long_ids_keep_all_digits(frame):
    texts = ["12345678901234567890", "12345678901234567890.0", "0012.0", "-7.9", "-0", "0", "1.234E3", " 5 ", "x", "", "1e50", None, ".5", "+8"]
    rows = frame([(i, t) for i, t in enumerate(texts)], "i int, x string")
    got = [r[0] for r in rows.orderBy("i").select(text.canonical_id(F.col("x"))).collect()]
    assert got == ["12345678901234567890", "12345678901234567890", "12", "-7", "0", "0", "1234", "5", None, None, None, None, "0", "8"]
