import datetime as dt

import pytest

from ledgerloom.operators import maintenance
from ledgerloom.streaming import jobs
from ledgerloom.streaming.keyed_table import KeyedTable
from ledgerloom.streaming.range_table import RangeTable

SCHEMA = "id string, v string"


def files_of(folder):
    """Name, size and time of every data file, by bucket folder."""
    return {str(p.relative_to(folder)): (p.stat().st_size, p.stat().st_mtime_ns) for p in folder.rglob("*.parquet")}


def rows_of(table, before=None):
    return sorted(map(tuple, table.read(before).select("id", "v").collect()), key=str)


def test_keys_are_replaced_over_runs(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    table = KeyedTable(spark, target, "id")
    assert table.read() is None and table.commits() == []
    for batch in ([("1", "a"), ("2", "b"), (None, "n")], [("1", "c"), ("1", "d")], [("3", "d"), (None, "m")]):
        df = frame(batch, SCHEMA)
        df.write.mode("append").parquet(source)
        jobs.replace_keys(jobs.file_stream(spark, source, df.schema).drop("FILE_NAME"), "id", target, state)
    # rows without a key are never replaced
    assert rows_of(table) == [("1", "c"), ("1", "d"), ("2", "b"), ("3", "d"), (None, "m"), (None, "n")]
    assert rows_of(table, before=1) == [("1", "a"), ("2", "b"), (None, "n")]


def test_a_batch_leaves_other_buckets_alone(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "id", buckets=8)
    table.replace(frame([(str(i), "a") for i in range(200)], SCHEMA), 0)
    before = files_of(tmp_path)
    assert len(before) == 8
    table.replace(frame([("7", "b")], SCHEMA), 1)
    after = files_of(tmp_path)
    assert {f: after[f] for f in before} == before and len(after) == len(before) + 1
    read = {r[0].split("/batch=")[1] for r in table.read().select("_metadata.file_path").distinct().collect()}
    assert sum(f.startswith("0/") for f in read) == 7 and sum(f.startswith("1/") for f in read) == 1
    assert rows_of(table) == sorted([(str(i), "b" if i == 7 else "a") for i in range(200)], key=str)


def test_a_repeated_batch_gives_the_same_table(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "id", buckets=4)
    table.replace(frame([("1", "a"), ("2", "b")], SCHEMA), 0)
    for _ in range(2):
        table.replace(frame([("1", "c"), ("5", "e")], SCHEMA), 1)
        assert rows_of(table) == [("1", "c"), ("2", "b"), ("5", "e")] and table.commits() == [0, 1]
    # a batch that was written without its commit doesn't count, and is written again
    frame([("2", "lost")], SCHEMA).write.parquet(f"{tmp_path}/batch=2/_bucket=0")
    (tmp_path / "_commits" / ".2").touch()
    assert rows_of(table) == [("1", "c"), ("2", "b"), ("5", "e")]
    table.replace(frame([("2", "z")], SCHEMA), 2)
    assert rows_of(table) == [("1", "c"), ("2", "z"), ("5", "e")]
    # an empty batch changes nothing
    table.replace(frame([], SCHEMA), 3)
    assert rows_of(table) == [("1", "c"), ("2", "z"), ("5", "e")] and table.commits() == [0, 1, 2, 3]


def test_superseded_folders_go(spark, frame, tmp_path):
    table = KeyedTable(spark, str(tmp_path), "id", buckets=2)
    for number, value in enumerate("abc"):
        table.replace(frame([(str(i), value) for i in range(20)], SCHEMA), number)
    assert table.drop_superseded(keep=2) == 2 and table.commits() == [1, 2]
    assert {v for _, v in rows_of(table, before=2)} == {"b"} and {v for _, v in rows_of(table)} == {"c"}
    assert table.drop_superseded() == 2 and len(files_of(tmp_path)) == 2
    with pytest.raises(ValueError):
        table.drop_superseded(keep=0)


def test_another_bucket_count_is_an_error(spark, frame, tmp_path):
    KeyedTable(spark, str(tmp_path), "id", buckets=2).replace(frame([("1", "a")], SCHEMA), 0)
    with pytest.raises(ValueError, match="2 buckets by id"):
        KeyedTable(spark, str(tmp_path), "id", buckets=4).read()


ORDERS = "order_number string, created_at timestamp_ntz, v int"


def all_rows(table):
    return sorted(map(tuple, table.read().collect()), key=repr)


def _orders(frame, numbers):
    return frame([(n, dt.datetime(2024, 1, 1) + dt.timedelta(days=int(n)) if n and n.lstrip("-").isdigit() else None, i) for i, n in enumerate(numbers)], ORDERS)


def test_a_stored_trim_rewrites_one_range(spark, frame, tmp_path):
    table = RangeTable(spark, str(tmp_path), "order_number", width=10)
    everything = _orders(frame, [str(n) for n in range(-25, 60)] + [None, "x7", "0012"])
    table.replace(everything, 0)
    before = files_of(tmp_path)
    assert len(before) == 10  # nine ranges and the rows without a number
    table.trim_recent(1, 14, dt.date(2024, 2, 20))
    want = maintenance.trim_recent(everything, 14, dt.date(2024, 2, 20))
    assert all_rows(table) == sorted(map(tuple, want.collect()), key=repr)
    after = files_of(tmp_path)
    assert all(after[f] == time for f, time in before.items())  # nothing that was there has been touched
    assert {f.split("/")[-2] for f in after.keys() - before.keys()} == {"_bucket=3"}
    table.trim_recent(1, 14, dt.date(2024, 2, 20))  # the batch comes again
    assert all_rows(table) == sorted(map(tuple, want.collect()), key=repr) and table.commits() == [0, 1]


def test_a_stored_trim_at_the_edge_of_a_range(spark, frame, tmp_path):
    schema = "id string, payout_status string"
    payouts = frame([(str(n), "pending" if n in (20, 35) else "paid") for n in range(40)] + [(None, "paid")], schema)
    table = RangeTable(spark, str(tmp_path), "id", width=10)
    table.replace(payouts, 0)
    before = files_of(tmp_path)
    table.trim_from_first_pending(1)
    assert all_rows(table) == sorted(map(tuple, maintenance.trim_from_first_pending(payouts).collect()), key=repr)
    # 19 is the last number of its range; the whole range is kept as rewritten rows, all later ones are gone
    assert {f.split("/")[-2] for f in files_of(tmp_path).keys() - before.keys()} <= {"_bucket=1"}
    table.trim_from_first_pending(2)  # nothing is open any more
    assert len(all_rows(table)) == 21
    table.replace(frame([("19", "paid again"), ("41", "pending")], schema), 3)
    table.trim_from_first_pending(4)
    assert ("19", "paid again") in all_rows(table) and len(all_rows(table)) == 21


def test_stored_trims_of_nothing(spark, frame, tmp_path):
    table = RangeTable(spark, str(tmp_path), "id")
    table.trim_from_first_pending(0)
    assert table.read() is None
    table.replace(frame([("7", "pending")], "id string, payout_status string"), 1)
    table.trim_from_first_pending(2)
    assert table.read() is None


def test_files_are_loaded_once(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = frame([("1", "a")], SCHEMA)
    for _ in range(2):
        df.write.mode("append").parquet(source)
        for _ in range(2):
            jobs.load_new_files(jobs.file_stream(spark, source, df.schema), target, state)
    loaded = spark.read.parquet(target)
    assert loaded.count() == 2 and loaded.select("FILE_NAME").distinct().count() == 2


def test_settlement_is_booked_once(spark, frame, tmp_path):
    source, ledger, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in ([("1", "a")], [("1", "late"), ("2", "b")]):
        df = frame(batch, SCHEMA)
        df.write.mode("append").parquet(source)
        jobs.book_once(jobs.file_stream(spark, source, df.schema).drop("FILE_NAME"), "id", ledger, state)
    assert sorted(map(tuple, spark.read.parquet(ledger).select("id", "v").collect())) == [("1", "a"), ("2", "b")]


def test_open_days_count_and_late_days_close_after_the_tail(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    at = lambda d: dt.datetime(2024, 1, d, 23)
    schema = "src string, at timestamp_ntz, v double"

    def run(batch):
        df = frame(batch, schema).coalesce(1)
        df.write.mode("append").parquet(source)
        stream = jobs.file_stream(spark, source, df.schema)
        jobs.write_daily_totals(jobs.daily_totals(stream, "at", ["src"], "v"), target, state)
        return sorted((r.day.day, r.src, r.total) for r in jobs.read_daily_totals(spark, target, ["src"]).collect())

    assert jobs.read_daily_totals(spark, target, ["src"]) is None
    assert run([("a", at(1), 1.0), ("a", at(2), 2.0)]) == [(1, "a", 1.0), (2, "a", 2.0)]
    assert run([("a", at(1), 10.0), ("a", at(16), 3.0)]) == [(1, "a", 11.0), (2, "a", 2.0), (16, "a", 3.0)]
    # the first day is closed: a row that comes too late changes nothing
    assert run([("a", at(1), 100.0), ("a", at(17), 3.0)]) == [(1, "a", 11.0), (2, "a", 2.0), (16, "a", 3.0), (17, "a", 3.0)]


def test_a_damaged_ledger_is_an_error(spark, frame, tmp_path):
    ledger = tmp_path / "ledger"
    assert jobs.read_versions(spark, str(ledger), "batch") is None
    (ledger / "batch=0").mkdir(parents=True)
    assert jobs.read_versions(spark, str(ledger), "batch") is None  # nothing finished yet
    (ledger / "batch=0" / "_SUCCESS").touch()
    (ledger / "batch=0" / "part-0.parquet").write_bytes(b"damaged")
    with pytest.raises(Exception):
        jobs.read_versions(spark, str(ledger), "batch").count()


def test_an_unfinished_folder_stays_unread(spark, frame, tmp_path):
    ledger = str(tmp_path)
    for number in (0, 1):
        frame([(str(number), "a")], SCHEMA).write.parquet(f"{ledger}/batch={number}")
    (tmp_path / "batch=1" / "_SUCCESS").unlink()
    assert [r["id"] for r in jobs.read_versions(spark, ledger, "batch").collect()] == ["0"]
    assert jobs.read_versions(spark, ledger, "batch", upto=0) is None


def test_repeated_records_count_once_after_a_restart(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    day = lambda d: dt.datetime(2024, 1, d)
    schema = "id string, at timestamp_ntz"
    for batch in ([("k", day(1)), ("m", day(10))], [("k", day(1)), ("m", day(10)), ("n", day(12)), ("n", day(12))], [("n", day(12)), ("o", day(13))]):
        df = frame(batch, schema).coalesce(1)
        df.write.mode("append").parquet(source)
        jobs.load_new_files(jobs.distinct_records(jobs.file_stream(spark, source, df.schema), "at", ["id"]), target, state)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["k", "m", "n", "o"]


def test_repeated_records_count_once(spark, frame, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    df = frame([("k", dt.datetime(2024, 1, 1)), ("k", dt.datetime(2024, 1, 2)), ("m", dt.datetime(2024, 1, 2))], "id string, at timestamp_ntz")
    df.write.parquet(source)
    stream = jobs.distinct_records(jobs.file_stream(spark, source, df.schema), "at", ["id"])
    jobs.load_new_files(stream, target, state)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["k", "m"]
