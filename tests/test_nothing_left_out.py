"""What must not cost a record, a file or a day."""

import datetime as dt
import os

import pytest
from records import line, rows
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from paytally.operators import net_spending, signed_legs
from paytally.plans import load_payments, report, run_period
from paytally.session import listed_bytes, sized_for
from paytally.sinks import insert_ignore, merge_staged, stage
from paytally.sources import parse_payments, scan_lines, scan_payments
from paytally.sources.sample import write_period_files
from paytally.streaming import ingest_available

DAY = dt.date(2017, 1, 5)
LARGEST = 2**63 - 1


def test_old_files_are_loaded_once(spark, warehouse, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    folders = [str(landing), str(tmp_path / "done"), str(tmp_path / "checkpoint")]
    year = 365 * 86_400
    for day, age in ((5, 0), (6, 4 * year), (7, 0)):
        path = landing / f"{day}.json"
        path.write_text(line(at=f"2017-01-{day:02}T10:00:00Z"))
        old = path.stat().st_mtime - age
        os.utime(path, (old, old))
        ((counts),) = ingest_available(spark, *folders, warehouse)
        assert counts["pair_activity"] == 1
    assert ingest_available(spark, *folders, warehouse) == []
    assert warehouse.read_table("pair_activity").count() == 3


def test_long_and_deep_values_do_not_cost_the_record(lines):
    plain = line("1", "2")
    picture = line("3", "4").replace("http://pics/3", "x" * 21_000_000)
    number = line("5", "6")[:-1] + ', "unread": ' + "7" * 1200 + "}"
    nested = line("7", "8")[:-1] + ', "unread": ' + "[" * 1100 + "]" * 1100 + "}"
    found = parse_payments(lines(plain, picture, number, nested))
    assert rows(found.select("sender_id", "receiver_id")) == [(1, 2), (3, 4), (5, 6), (7, 8)]


def test_unread_fields_do_not_disturb(lines):
    extras = line("1", "2")[:-1] + ', "flag": true, "tags": ["a", {"b": 1}], "o": {"p": null}}'
    assert rows(parse_payments(lines(extras)).select("sender_id", "amount_cents")) == [(1, 250)]


def test_extreme_amounts_cost_nobody_else(warehouse, lines):
    texts = [
        line("1", "2", amount_cents=LARGEST),
        line("1", "2", amount_cents=LARGEST),
        line("3", "4", amount_cents=-LARGEST - 1),
        line("5", "6"),
    ]
    payments = parse_payments(lines(*texts))
    load_payments(payments, warehouse)
    stored = {r.user_id: int(r.amount_cents) for r in warehouse.read_table("net_spending").collect()}
    assert stored == {
        1: 2 * LARGEST, 2: -2 * LARGEST, 3: -LARGEST - 1, 4: LARGEST + 1, 5: 250, 6: -250
    }
    assert net_spending(payments).count() == 6 and signed_legs(payments).count() == 8
    top = report(warehouse, "active_spenders", DAY, 2).collect()
    assert [str(r.amount) for r in top] == ["184467440737095516.14", "92233720368547758.08"]


def test_rows_without_keys_are_never_stored(spark, warehouse):
    users = spark.createDataFrame(
        [(None, "a", "", "", ""), (2, None, "", "", ""), (2, "named", "", "", ""), (3, None, "", "", "")],
        "id bigint, username string, firstname string, lastname string, picture string",
    )
    for _ in range(2):
        insert_ignore(users, warehouse, "users")
        merge_staged(warehouse, stage(users, warehouse, "users"), "users")
    assert rows(warehouse.read_table("users").select("id", "username")) == [(2, "named")]

    ddl = "user_id bigint, transaction_date date, send_freq bigint"
    without_day = (2, None, 1)
    for batch in ([without_day], [without_day, (2, DAY, 5), (None, DAY, 1)], [without_day]):
        insert_ignore(spark.createDataFrame(batch, ddl), warehouse, "sender_activity")
    assert rows(warehouse.read_table("sender_activity")) == [(2, DAY, 5)]


def test_a_user_stored_twice_does_not_double_metrics(spark, warehouse, lines):
    ddl = "id bigint, username string, firstname string, lastname string, picture string"
    twice = spark.createDataFrame([(7, "x", "a", "b", "")] * 2, ddl)
    warehouse.ensure_table("users")
    warehouse.append(twice, "users")
    load_payments(parse_payments(lines(line("7", "9"))), warehouse)
    assert warehouse.read_table("sender_activity").count() == 1
    assert warehouse.read_table("net_spending").count() == 2


def test_reports_pass_over_users_who_are_gone(spark, warehouse, lines):
    texts = [line("1", "9")] * 3 + [line("2", "9")] * 2 + [line("3", "9")]
    load_payments(parse_payments(lines(*texts)), warehouse)

    class WithoutFirst:
        def read_table(self, table):
            found = warehouse.read_table(table)
            return found.where("id <> 1") if table == "users" else found

    top = report(WithoutFirst(), "active_senders", DAY, 2).collect()
    assert [r.send_freq for r in top] == [2, 1]


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        hot = spark.range(40_000, numPartitions=8).select(
            F.lit("2024-01-05").cast("date").alias("day"), F.sha2(F.col("id").cast("string"), 256).alias("value")
        )
        few = spark.range(10).select(F.lit("2023-12-31").cast("date").alias("day"), F.lit("x").alias("value"))
        write_period_files(hot.union(few), str(tmp_path / "raw"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    day = tmp_path / "raw" / "2024_01" / "payments_2024_01_05.json"
    assert len(list(day.glob("part-*"))) > 1
    assert (tmp_path / "raw" / "2023_12" / "payments_2023_12_31.json").exists()


@pytest.mark.parametrize("name", ["run_period", "run_metrics", "stored_report", "scan_period"])
def test_queries_read_every_year(spark, tmp_path, name):
    import check

    source = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{source}/events.parquet")
    events.withColumn("ts", F.expr("ts - INTERVAL 20 DAYS")).write.parquet(str(tmp_path / "events.parquet"))
    duck = check.connect(source)
    duck.execute(
        f"CREATE OR REPLACE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'"
    )
    for table in ("customer", "supplier"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{source}/{table}.parquet")
    assert check.compare(spark, duck, str(tmp_path), name) == ""
    assert name in entry_points.queries()


def test_partitions_follow_the_listed_size(spark, warehouse, tmp_path, monkeypatch):
    for name in ("a.json", "b.json"):
        (tmp_path / name).write_text(line())
    size = len(line())
    assert listed_bytes(scan_lines(spark, str(tmp_path / "*.json"))) == 2 * size
    assert listed_bytes(scan_lines(spark, [str(tmp_path / "a.json")])) == size
    assert listed_bytes(scan_lines(spark, str(tmp_path))) == 2 * size
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with sized_for(spark, 10**12):
        assert int(spark.conf.get(key)) > 400
    assert spark.conf.get(key) == before
    seen = []
    monkeypatch.setattr("paytally.plans.load.listed_bytes", lambda *_: 10**11)
    monkeypatch.setattr(
        "paytally.plans.load.load_payments", lambda *_: seen.append(int(spark.conf.get(key)))
    )
    run_period(spark, str(tmp_path / "a.json"), warehouse)
    assert seen == [45] and spark.conf.get(key) == before


def test_scan_reads_what_is_there(spark, tmp_path):
    (tmp_path / "x.json").write_text(line())
    assert scan_payments(spark, str(tmp_path)).count() == 1
