"""Readers on small hand-written files."""

import datetime as dt
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.sources import feeds, files, heads
from ledgerloom.sources.rakuten_headers import ORDER_HEADERS


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("preamble", [6, 7])
def test_preamble_of_any_length(spark, tmp_path, preamble):
    body = "note\n" * preamble + "settlement-id\tamount\tposted-date\tsku\r\n11.0\t1.5\t15.01.2024\tNaN\r\n12\tx\tbad\tS1\r\n"
    got = feeds.read_preamble_tsv(spark, write(tmp_path / "tv_1.txt", body)).orderBy("settlement_id").collect()
    assert [(r.settlement_id, r.amount, r.sku, r.promotion_id) for r in got] == [(11.0, 1.5, None, None), (12.0, None, "S1", None)]
    assert got[0].posted_date == dt.datetime(2024, 1, 15) and got[0].FILE_NAME == "tv_1.txt"


def test_settlement_text(spark, tmp_path):
    body = ('"Settlement report"\nSettlementEndDate,"2024-01-31 00:00:00"\n\n'
            '"TransactionPostedDate","SettlementId","TransactionType","SellerOrderId","TransactionAmount","NetTransactionAmount"\n'
            '"2024-01-02 03:04:05","900","Capture","S/1, x","1,234.00","-1,100.00"\n"2024-01-03 00:00:00","900","","S/2","",""\n')
    got = feeds.read_settlement_txt(spark, write(tmp_path / "AMA_1.txt", body)).orderBy("sellerorderid").collect()
    assert [(r.sellerorderid, r.transactiontype, r.transactionamount, r.nettransactionamount) for r in got] == [
        ("S/1, x", "Capture", 1234.0, -1100.0), ("S/2", None, None, None)]
    assert got[0].settlement_end_date == dt.datetime(2024, 1, 31)


SECTIONS = (
    "a\nb\nc\n連番,注文確認日,受注番号,決済番号,決済機関連携番号,お問合せ番号,決済確定日,楽天ペイ入金額,決済方法,摘要,\n"
    '1,2024/01/02,"2001",P,L,,2024/01/03,"1,500",card,,55.0\n2,2024/01/02,2002,P,L,,2024/01/03,700,card,,55.0\n'
    "合計,,,,,,,2200,,,\n連番,受注番号,注文確認日,クーポン名,クーポン利用額,クーポン利用確定日,,,,,\n"
    '1,2001,2024/01/02,"夏, 割引","1,000",2024/01/05,,,,,55.0\n合計,,,,1000,,,,,,\n'
)


def test_payment_sections(spark, tmp_path):
    write(tmp_path / "p" / "one.csv", SECTIONS)
    write(tmp_path / "p" / "two.csv", SECTIONS.split("連番,受注番号")[0])  # no coupon section
    main, coupon = feeds.read_payment_sections(spark, str(tmp_path / "p"))
    assert sorted((r.order_number, r.rakuten_pay_money, r.report_id) for r in main.where("FILE_NAME = 'one.csv'").collect()) == [
        ("2001", 1500.0, "55"), ("2002", 700.0, "55")]
    assert main.count() == 4
    row = coupon.collect()
    assert len(row) == 1 and row[0].coupon_name == "夏, 割引" and row[0].coupon_amount == 1000.0
    assert row[0].coupon_confirmation_date == dt.datetime(2024, 1, 5) and row[0].report_id == "55"


def test_japanese_order_export(spark, tmp_path):
    heads = list(ORDER_HEADERS)
    values = {"注文番号": "2001", "商品名": "①番", "単価": "100", "注文日時": "2024-01-02 03:04:05", "ステータス": "null"}
    body = ",".join(heads + ["余分"]) + "\n" + ",".join([values.get(h, "") for h in heads] + ["x"]) + "\n"
    path = write(tmp_path / "r.csv", body, "cp932")
    row = feeds.read_rakuten_orders(spark, path).first()
    assert (row.order_number, row.product_name, row.unit_price, row.status) == ("2001", "①番", 100.0, None)
    assert row.order_date_time == dt.datetime(2024, 1, 2, 3, 4, 5) and "余分" not in row.asDict()
    short = write(tmp_path / "s.csv", "注文番号\n1\n", "cp932")
    with pytest.raises(KeyError):
        feeds.read_rakuten_orders(spark, short)
    assert feeds.read_rakuten_orders(spark, short, strict=False).first().order_number == "1"


def test_marketplace_kind_by_header(spark, tmp_path):
    oc = write(tmp_path / "x.txt", "amazon-order-id\tproduct-name\tquantity\tpurchase-date\nA\t①\t2\t2024-01-02T03:00:00+0900\n", "cp932")
    row = feeds.read_marketplace_tsv(spark, oc).first()
    assert (row.amazon_order_id, row.product_name, row.quantity) == ("A", "①", 2)
    assert row.purchase_date == dt.datetime(2024, 1, 1, 18)
    tv = write(tmp_path / "y.txt", "settlement-id\tamount\torder-id\n7\t1.5\tnull\n")
    row = feeds.read_marketplace_tsv(spark, tv).first()
    assert (row.settlement_id, row.amount, row.order_id) == (7.0, 1.5, None)
    with pytest.raises(ValueError):
        feeds.classify_marketplace(["other"])
    assert feeds.report_kind("2024_TV.txt") == "tv"
    with pytest.raises(ValueError):
        feeds.report_kind("x.txt")


def test_stripe_sheets_and_routes(spark, tmp_path):
    names = [f.name for f in schemas.STRIPE_BALANCE.fields]
    cells = {"balance_transaction_id": "t1", "created_utc": "2024-01-02 03:04:05", "gross": "10.5"}
    bal = write(tmp_path / "f" / "BAL_1.csv", ",".join(names) + "\n" + ",".join(cells.get(n, "") for n in names) + "\n")
    write(tmp_path / "f" / "PAY_1.csv", "x\n1\n")
    row = feeds.read_stripe_balance(spark, bal).first()
    assert (row.balance_transaction_id, row.gross, row.created_utc) == ("t1", 10.5, dt.datetime(2024, 1, 2, 3, 4, 5))
    plain = lambda s, p: s.read.text(p).selectExpr("value", "_metadata.file_name AS FILE_NAME")
    routes = files.route_by_prefix(spark, str(tmp_path / "f"), {"PAY": plain, "BAL": feeds.read_stripe_balance})
    assert {p: {r.FILE_NAME for r in d.select("FILE_NAME").collect()} for p, d in routes.items()} == {"PAY": {"PAY_1.csv"}, "BAL": {"BAL_1.csv"}}
    for kind, width in (("sa", 19), ("ss", 18), ("sh", 18)):
        heads = [f.name for f in schemas.REPORT_SHEETS[kind].fields]
        path = write(tmp_path / f"{kind}.csv", ",".join(heads) + "\n" + ",".join("5" if h == "TOTAL" else "" for h in heads) + "\n")
        sheet = feeds.read_report_sheet(spark, path, kind)
        assert len(sheet.columns) == width and sheet.first().TOTAL == 5.0
    heads = [f.name for f in schemas.NOMENCLATURE.fields]
    assert feeds.load_nomenclature(spark, write(tmp_path / "n.csv", ",".join(heads) + "\na,b,c,abc,r,acc,i,t\n")).first().account == "acc"


def test_bulk_names_by_position(spark, tmp_path):
    line = ",".join(str(i) for i in range(155))
    for n in (1, 2):
        write(tmp_path / "b" / f"{n}.csv", ",".join(f"h{i}" for i in range(155)) + "\n" + line + "\n", "cp932")
    got = feeds.read_rakuten_bulk(spark, str(tmp_path / "b"))
    assert got.count() == 2 and got.first().order_number == "0" and got.first().warning_display_type_details == "154"


def test_json_page_per_file(spark, tmp_path):
    write(tmp_path / "j" / "1.json", '{\n "orders": [{"id": 1}, {"id": 2}]\n}')
    write(tmp_path / "j" / "2.json", '{"orders": []}')
    got = files.read_json_pages(spark, str(tmp_path / "j"), "orders", "id bigint, note string")
    assert sorted((r.id, r.note) for r in got.collect()) == [(1, None), (2, None)]


def test_split_cells(frame):
    df = frame([('a,"b, ""c""",,"",d',)], "x string")
    assert df.select(files.split_cells(F.col("x"), ",")).first()[0] == ["a", 'b, "c"', "", "", "d"]


def test_files_go_by_their_own_headers(spark, tmp_path):
    write(tmp_path / "m" / "a b.txt", "amazon-order-id\tsku\tquantity\nA\tS1\t3\n", "cp932")
    write(tmp_path / "m" / "c.txt", "quantity\tamazon-order-id\n4\tB\n", "cp932")
    got = feeds.read_marketplace_tsv(spark, str(tmp_path / "m"), kind="oc").collect()
    assert sorted((r.amazon_order_id, r.sku, r.quantity, r.FILE_NAME) for r in got) == [("A", "S1", 3, "a%20b.txt"), ("B", None, 4, "c.txt")]


def test_encoding_by_file(spark, tmp_path):
    heads = list(ORDER_HEADERS)
    body = ",".join(heads) + "\n" + ",".join("2001" if h == "注文番号" else "①" if h == "商品名" else "" for h in heads) + "\n"
    write(tmp_path / "r" / "jp.csv", body, "cp932")
    write(tmp_path / "r" / "utf.csv", body)
    got = feeds.read_rakuten_orders(spark, str(tmp_path / "r")).collect()
    assert sorted((r.FILE_NAME, r.order_number, r.product_name) for r in got) == [("jp.csv", "2001", "①"), ("utf.csv", "2001", "①")]


def test_quoted_breaks_and_unreadable_values(spark, tmp_path):
    heads = [f.name for f in schemas.STRIPE_PAYOUTS.fields]
    line = lambda **v: ",".join(v.get(h, "") for h in heads) + "\n"
    path = write(tmp_path / "PAY_1.csv", ",".join(heads) + "\n" + line(balance_transaction_id="t1", gross="1.5") + line(balance_transaction_id="t2", gross="1O.5"))
    good, bad = feeds.read_stripe_payouts_apart(spark, path)
    assert [(r.balance_transaction_id, r.gross) for r in good.collect()] == [("t1", 1.5)] and good.count() == 1
    assert [(r.balance_transaction_id, r.gross, r.FILE_NAME) for r in bad.collect()] == [("t2", "1O.5", "PAY_1.csv")]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        feeds.read_stripe_payouts(spark, path).collect()
    quoted = write(tmp_path / "q.txt", 'amazon-order-id\tproduct-name\nA\t"two\nlines ""x"""\nB\tp\n')
    got = feeds.read_marketplace_tsv(spark, quoted, kind="oc", encoding="UTF-8", multi_line=True).collect()
    assert sorted((r.amazon_order_id, r.product_name) for r in got) == [("A", 'two\nlines "x"'), ("B", "p")]


# ---------------------------------------------------------------- blocks and heads


@pytest.fixture
def small_blocks(spark):
    """Files are cut into blocks of 200 bytes."""
    keys = {"spark.sql.files.maxPartitionBytes": "200b", "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def plain_sections(lines):
    """Rows between the first header and the first total, and between the next header and the next total."""
    lead = [x.split(",")[0] for x in lines]
    at = lambda word, start: next((i for i in range(start, len(lead)) if lead[i] == word), None)
    main, total = at(schemas.SECTION_HEADER, 0), at(schemas.SECTION_TOTAL, 0)
    coupon = None if total is None else at(schemas.SECTION_HEADER, total + 1)
    end = None if coupon is None else at(schemas.SECTION_TOTAL, coupon + 1)
    first = lines[main + 1 : total] if main is not None and total is not None else []
    return first, [] if coupon is None else lines[coupon + 1 : end]


def test_sections_over_many_blocks(spark, tmp_path, small_blocks):
    """Files whose headers and totals stand anywhere, often blocks apart, or are missing."""
    draw = random.Random(2)
    want = {}
    for number in range(12):
        kinds = [schemas.SECTION_HEADER] * draw.randrange(4) + [schemas.SECTION_TOTAL] * draw.randrange(4) + ["row"] * draw.randrange(1, 60)
        draw.shuffle(kinds)
        lines = [f"{k},{number}-{i},{'x' * draw.randrange(30)}" for i, k in enumerate(kinds)]
        write(tmp_path / f"f{number}.csv", "\n".join(lines) + "\n")
        want[f"f{number}.csv"] = plain_sections(lines)
    lines = files.numbered_lines(spark, str(tmp_path))
    assert lines.select("pos.block").distinct().count() > 5
    lead = F.split_part("line", F.lit(","), F.lit(1))
    marks = files.section_marks(lead == schemas.SECTION_HEADER, lead == schemas.SECTION_TOTAL)
    rows = files.per_file(lines, {"_marks": marks}, files.sections("_marks")).orderBy("FILE_NAME", "pos").collect()
    for name, (first, second) in want.items():
        own = [r for r in rows if r["FILE_NAME"] == name]
        assert [r["line"] for r in own if r["main"] and r["total"] and r["main"]["pos"] < r["pos"] < r["total"]["pos"]] == first
        assert [r["line"] for r in own if r["coupon"] and r["coupon"]["pos"] < r["pos"] and (r["end"] is None or r["pos"] < r["end"]["pos"])] == second


def test_a_preamble_in_another_block_than_its_rows(spark, tmp_path, small_blocks):
    head = "settlement-id\tdeposit-date\ttransaction-type\tamount"
    text = "".join(f"about {i}\n" for i in range(40)) + head + "\n" + "".join(f"{i}\t01.02.2024 10:00:00 UTC\tOrder\t{i}.5\n" for i in range(300))
    write(tmp_path / "a.txt", text)
    rows = feeds.read_preamble_tsv(spark, str(tmp_path)).select("settlement_id", "amount").collect()
    assert sorted(map(tuple, rows)) == [(float(i), i + 0.5) for i in range(300)]


@pytest.mark.parametrize("reader", [feeds.read_preamble_tsv, feeds.read_settlement_txt, lambda s, p: feeds.read_payment_sections(s, p)[0], lambda s, p: feeds.read_payment_sections(s, p)[1]])
def test_lines_meet_their_file_in_one_join_by_block(spark, tmp_path, reader):
    write(tmp_path / "a.csv", "settlement-id\tTransactionPostedDate\n1\t2\n")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = reader(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    joins = [line for line in plan.split("\n") if "Join" in line]
    assert plan.count("Scan ExistingRDD") == 1 and len(joins) == 2  # the lines are read once; the other join is among block rows
    assert sum("_block" in line and "pos" in line for line in joins) == 1 and "Window" not in plan


class Counted:
    """A file that counts the bytes read from it."""

    def __init__(self, source):
        self.source, self.read_bytes = source, 0

    def seek(self, *at):
        return self.source.seek(*at)

    def read(self, n):
        found = self.source.read(n)
        self.read_bytes += len(found)
        return found


def test_few_bytes_of_a_large_file_are_read(tmp_path):
    path = tmp_path / "large.tsv"
    path.write_bytes(b"head\tline\r\n" + b"0123456789\tabcdefghij\n" * 1_000_000)
    with open(path, "rb") as source:
        counted = Counted(source)
        assert heads.first_line(counted) == b"head\tline"
        parts = heads.samples(counted, path.stat().st_size)
    assert len(parts) == heads.SLICES and counted.read_bytes <= (heads.SLICES + 1) * heads.SLICE_BYTES
    assert all(line == b"0123456789\tabcdefghij" for part in parts[1:] for line in part.split(b"\n") if line)


def test_heads_of_files(spark, tmp_path):
    (tmp_path / "empty file.csv").write_bytes(b"")
    (tmp_path / "注文 100%.csv").write_bytes("a,b\r\nあ,い\r\n".encode("cp932"))
    (tmp_path / "plain.csv").write_bytes(b"a,b")
    (tmp_path / "wide.csv").write_bytes(b"x" * 100_000 + "\n日本\n".encode())
    found = {unquote(r["file"]).rsplit("/", 1)[1]: (bytes(r["head"]), r["encodings"]) for r in heads.file_heads(spark, str(tmp_path), (heads.JAPANESE, "UTF-8")).collect()}
    both = [heads.JAPANESE, "UTF-8"]
    assert found["empty file.csv"] == (b"", both) and found["plain.csv"] == (b"a,b", both)
    assert found["注文 100%.csv"] == (b"a,b", [heads.JAPANESE])
    assert found["wide.csv"][0] == b"x" * 100_000 and found["wide.csv"][1][0] == "UTF-8"


@pytest.mark.parametrize("encoding", ["cp932", "utf-8"])
def test_the_body_decides_the_encoding(spark, tmp_path, encoding):
    """The header is plain, and so are the first ten thousand rows."""
    body = "".join(f"{i}\tplain\n" for i in range(10_000)) + "".join(f"{i}\t健康サプリ\n" for i in range(10_000, 30_000))
    write(tmp_path / "oc.txt", "amazon-order-id\tproduct-name\n" + body, encoding)
    rows = feeds.read_marketplace_tsv(spark, str(tmp_path))
    assert {(r[0], r[1]) for r in rows.groupBy("product_name").count().collect()} == {("plain", 10_000), ("健康サプリ", 20_000)}
