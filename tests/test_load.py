import datetime as dt

import pytest
from records import line, party, rows
from pyspark.sql import functions as F

from paytally.operators import (
    net_spending,
    pair_activity,
    receiver_activity,
    sender_activity,
    user_mentions,
    users_dim,
)
from paytally.plans import load, load_payments, run_period
from paytally.schema import TABLES
from paytally.sinks import Warehouse, days, insert_ignore, merge_staged, stage
from paytally.sources import parse_payments, period_path
from paytally.sources.sample import raw_lines, write_period_files

DAY = dt.date(2017, 1, 5)
NEXT = dt.date(2017, 1, 6)
SF_DIR = "/root/testdata/sf0.001"
METRICS = {
    "sender_activity": sender_activity,
    "receiver_activity": receiver_activity,
    "pair_activity": pair_activity,
    "net_spending": net_spending,
}


def stored(warehouse):
    return {table: rows(warehouse.read_table(table)) for table in TABLES}


def test_load_writes_all_tables_and_counts_them(warehouse, lines):
    written = load_payments(parse_payments(lines(line(), line("9", "7"), "{bad")), warehouse)
    tables = stored(warehouse)
    assert written == {table: len(found) for table, found in tables.items()}
    assert tables["sender_activity"] == [(7, DAY, 1), (9, DAY, 1)]
    assert tables["pair_activity"] == [(7, 9, DAY, 2)]
    assert tables["net_spending"] == [(7, DAY, 0), (9, DAY, 0)]
    assert [u[0] for u in tables["users"]] == [7, 9]


def test_a_second_run_changes_nothing(warehouse, lines):
    payments = parse_payments(lines(line(), line("9", "8"), line(at="2017-01-06T01:00:00Z")))
    load_payments(payments, warehouse)
    before = stored(warehouse)
    assert set(load_payments(payments, warehouse).values()) == {0}
    assert stored(warehouse) == before


def test_stored_keys_keep_their_first_value(warehouse, lines):
    load_payments(parse_payments(lines(line(), line("9", "8"))), warehouse)
    renamed = line(actor=party("7", "New"), at="2016-01-01T00:00:00Z")
    load_payments(parse_payments(lines(line(), line(), line("9", "7"), renamed)), warehouse)
    tables = stored(warehouse)
    assert (7, DAY, 1) in tables["sender_activity"]
    assert (7, 9, DAY, 1) in tables["pair_activity"]
    assert [u[2] for u in tables["users"] if u[0] == 7] == ["Ann"]


def test_interrupted_load_is_completed_by_the_next(warehouse, lines, monkeypatch):
    payments = parse_payments(lines(line(), line("9", "8")))
    fine = load.insert_ignore

    def broken(df, house, table, **kw):
        if table == "net_spending":
            raise OSError("disk gone")
        return fine(df, house, table, **kw)

    monkeypatch.setattr(load, "insert_ignore", broken)
    with pytest.raises(OSError):
        load_payments(payments, warehouse)
    monkeypatch.setattr(load, "insert_ignore", fine)
    written = load_payments(payments, warehouse)
    assert written["net_spending"] == 3 and written["sender_activity"] == 0
    assert stored(warehouse)["net_spending"] == rows(net_spending(payments))


def test_rows_of_unknown_users_are_left_out(warehouse, lines, monkeypatch):
    texts = [
        line(),
        line("5", "7", actor=party("5", lastname=...)),
        line("7", "6", transactions=[{"target": party("6", picture=...)}]),
        line("8", transactions=[]),
    ]
    payments = parse_payments(lines(*texts))
    load_payments(payments, warehouse)
    tables = stored(warehouse)
    assert tables["sender_activity"] == [(7, DAY, 2)]
    assert tables["receiver_activity"] == [(7, DAY, 1), (9, DAY, 1)]
    assert tables["pair_activity"] == [(7, 9, DAY, 1)]
    # The received 250 from the unknown 5 and the 250 sent to the unknown 6 count.
    assert tables["net_spending"] == [(7, DAY, 250), (9, DAY, -250)]

    # The same through the semi joins that take over when unknown ids are many.
    other = Warehouse(warehouse.spark, warehouse.location + "_2", warehouse.database + "_2")
    monkeypatch.setattr(load, "MAX_BROADCAST_IDS", 0)
    load_payments(payments, other)
    assert stored(other) == tables


def test_many_days_are_pruned_by_range(warehouse, lines, monkeypatch):
    monkeypatch.setattr(days, "MAX_LISTED_DAYS", 2)
    texts = [line(at=f"2017-01-{d:02}T10:00:00Z") for d in range(1, 8)]
    load_payments(parse_payments(lines(*texts[:4])), warehouse)
    load_payments(parse_payments(lines(*texts)), warehouse)
    assert len(stored(warehouse)["pair_activity"]) == 7


def test_source_without_amounts_is_refused_before_anything_is_stored(warehouse, lines):
    payments = parse_payments(lines(line(amount_cents=...), line("9", "8", amount_cents=...)))
    with pytest.raises(load.MissingAmounts):
        load_payments(payments, warehouse)
    assert not any(stored(warehouse).values())
    assert load_payments(payments, warehouse, ["users", "sender_activity"]) == {
        "users": 3,
        "sender_activity": 2,
    }


def test_unknown_table(warehouse, lines):
    with pytest.raises(ValueError):
        load_payments(parse_payments(lines(line())), warehouse, ["senders"])


def test_empty_source(warehouse, lines):
    assert set(load_payments(parse_payments(lines("{bad")), warehouse).values()) == {0}


def test_staged_payments_are_removed(warehouse, lines, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "scratch_path", lambda *_: str(tmp_path / "staged"))
    load_payments(parse_payments(lines(line())), warehouse)
    assert not (tmp_path / "staged").exists()


def test_period_files_to_tables(spark, warehouse, tmp_path):
    root = str(tmp_path / "raw")
    lines_by_day = raw_lines(spark, SF_DIR)
    write_period_files(lines_by_day, root)
    assert (tmp_path / "raw" / "2024_01" / "payments_2024_01_05.json").exists()
    payments = parse_payments(lines_by_day)
    known = {r.id for r in users_dim(user_mentions(payments)).collect()}

    run_period(spark, period_path(root, 2024, 1, 5), warehouse)
    one_day = rows(warehouse.read_table("sender_activity"))
    assert {r[1] for r in one_day} == {dt.date(2024, 1, 5)}

    run_period(spark, period_path(root, 2024), warehouse)
    for table, metric in METRICS.items():
        columns = TABLES[table].user_columns
        want = [r for r in rows(metric(payments)) if set(r[: len(columns)]) <= known]
        got = rows(warehouse.read_table(table))
        # The 5th was loaded first, with the users known from that day alone.
        later = [r for r in want if dt.date(2024, 1, 5) not in r]
        assert [r for r in got if dt.date(2024, 1, 5) not in r] == later


def test_tables_of_an_earlier_session_are_found(spark, warehouse, lines):
    load_payments(parse_payments(lines(line(), line(at="2017-01-06T01:00:00Z"))), warehouse)
    before = stored(warehouse)
    spark.sql(f"DROP DATABASE `{warehouse.database}` CASCADE")  # forgets, keeps the files
    assert stored(warehouse) == before
    assert before["sender_activity"] == [(7, DAY, 1), (7, NEXT, 1)]


def test_insert_ignore_of_plain_rows(spark, warehouse):
    users = spark.createDataFrame(
        [(1, "b", "x"), (1, "a", "y"), (2, "c", "z")], "id bigint, username string, picture string"
    ).select("id", "username", F.lit("F").alias("firstname"), F.lit("L").alias("lastname"), "picture")
    assert insert_ignore(users, warehouse, "users", order_by=["picture"]) == 2
    assert [u[1] for u in rows(warehouse.read_table("users"))] == ["b", "c"]
    pairs = spark.createDataFrame(
        [(1, 2, DAY, 3), (1, 9, DAY, 1), (1, 2, NEXT, 1)],
        "user1 bigint, user2 bigint, transaction_date date, transaction_freq bigint",
    )
    assert insert_ignore(pairs, warehouse, "pair_activity") == 2
    assert insert_ignore(pairs, warehouse, "pair_activity") == 0
    assert insert_ignore(pairs.limit(0), warehouse, "pair_activity") == 0
    assert rows(warehouse.read_table("pair_activity")) == [(1, 2, DAY, 3), (1, 2, NEXT, 1)]


def test_staging_is_replaced_and_merged(spark, warehouse):
    def users(*ids, name):
        made = [(i, f"{name}{i}", name, "L", None) for i in ids]
        return spark.createDataFrame(made, TABLES["users"].ddl)

    insert_ignore(users(1, 2, name="old"), warehouse, "users")
    stage(users(7, 8, name="gone"), warehouse, "users")
    staging = stage(users(2, 3, name="new"), warehouse, "users")
    assert merge_staged(warehouse, staging, "users") == 1
    assert [u[1] for u in rows(warehouse.read_table("users"))] == ["old1", "old2", "new3"]


def test_a_load_leaves_few_files_per_day(warehouse, lines):
    texts = [
        line(str(s), str(s + 1), at=f"2017-01-{d:02}T10:00:00Z") for d in (5, 6, 7) for s in range(40)
    ]
    load_payments(parse_payments(lines(*texts)), warehouse)
    activity = warehouse.read_table("sender_activity")
    assert activity.count() == 120 and len(activity.inputFiles()) == 3


def test_existing_keys_are_read_for_the_days_of_the_batch_only(warehouse, lines):
    load_payments(parse_payments(lines(line(), line(at="2017-01-06T01:00:00Z"))), warehouse)
    batch = days.BatchDays(DAY, DAY, (DAY,))
    plan = warehouse.read_table("pair_activity").where(batch.predicate())
    assert len(plan.inputFiles()) == 1


def test_new_users_join_the_stored_ones(warehouse, lines, monkeypatch):
    """With few new ids and, past the limit, with many."""
    days_of_two = [line(str(n), str(n + 1), at=f"2017-01-{5 + n:02}T10:00:00Z") for n in range(4)]
    load_payments(parse_payments(lines(days_of_two[0])), warehouse)
    load_payments(parse_payments(lines(*days_of_two[:2])), warehouse)
    monkeypatch.setattr(load, "MAX_BROADCAST_IDS", 1)
    written = load_payments(parse_payments(lines(*days_of_two)), warehouse)
    assert written["users"] == 2
    assert [u[0] for u in rows(warehouse.read_table("users"))] == [0, 1, 2, 3, 4]


def test_files_the_catalog_has_not_heard_of_are_seen(spark, warehouse, lines, monkeypatch):
    """As after a driver that died between its files' commit and the catalog's."""
    payments = parse_payments(lines(line(), line("9", "8"), line(at="2017-01-06T01:00:00Z")))
    load_payments(payments, warehouse)
    before = stored(warehouse)

    def forget_a_day():
        for table in METRICS:
            spark.sql(
                f"ALTER TABLE {warehouse.full_name(table)} "
                f"DROP PARTITION (transaction_date = '{DAY}')"
            )
        assert len(stored(warehouse)["sender_activity"]) == 1

    for listed in (days.MAX_LISTED_DAYS, 1):
        monkeypatch.setattr(days, "MAX_LISTED_DAYS", listed)
        forget_a_day()
        assert set(load_payments(payments, warehouse).values()) == {0}
        assert stored(warehouse) == before


def test_only_what_the_wanted_tables_need_is_staged(spark, warehouse, lines, monkeypatch):
    payments = parse_payments(lines(line(), line("9", "8")))
    load_payments(payments, warehouse, ["users"])
    staged = []
    monkeypatch.setattr(load, "drop_path", lambda _, path: staged.append(spark.read.parquet(path)))
    wanted = {
        "users": ["payment_id", "created_time", "sender_id", "receiver_id", "sender", "receiver"],
        "pair_activity": ["sender_id", "receiver_id", "transaction_date", "amount_cents"],
        "net_spending": ["sender_id", "receiver_id", "transaction_date", "amount_cents"],
    }
    for table, columns in wanted.items():
        load_payments(payments, warehouse, [table])
        assert staged.pop().columns == columns
    load_payments(payments, warehouse)
    assert staged.pop().columns == payments.columns
    assert [r[0] for r in stored(warehouse)["users"]] == [7, 8, 9]
