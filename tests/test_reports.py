import datetime as dt
from decimal import Decimal

import pytest
from records import line, party, rows

from paytally.plans import (
    load_payments,
    report,
    top_pair_ids,
    top_pairs,
    top_receivers,
    top_senders,
    top_spenders,
)
from paytally.sources import parse_payments

DAY = dt.date(2017, 1, 5)


@pytest.fixture
def users(spark):
    made = [(i, f"u{i}", f"F{i}", f"L{i}", f"p{i}") for i in range(1, 6)]
    made.append((6, "u6", "F6", None, None))
    return spark.createDataFrame(
        made, "id bigint, username string, firstname string, lastname string, picture string"
    )


@pytest.fixture
def activity(spark):
    def build(measure, *found):
        made = [(u, DAY, n) for u, n in found] + [(1, dt.date(2017, 1, 6), 99)]
        return spark.createDataFrame(
            made, f"user_id bigint, transaction_date date, {measure} bigint"
        )

    return build


def in_order(df):
    return [tuple(r) for r in df.collect()]


def test_ties_go_to_the_smaller_id(activity, users):
    found = activity("send_freq", (5, 2), (3, 2), (1, 1), (4, 7))
    assert in_order(top_senders(found, users, DAY, 3)) == [
        ("F4 L4", "p4", 7),
        ("F3 L3", "p3", 2),
        ("F5 L5", "p5", 2),
    ]


def test_unknown_users_take_no_place(activity, users):
    found = activity("recv_freq", (50, 9), (51, 8), (2, 1), (3, 1))
    assert in_order(top_receivers(found, users, "2017-01-05", 1)) == [("F2 L2", "p2", 1)]


def test_name_is_null_if_a_part_is(activity, users):
    assert in_order(top_senders(activity("send_freq", (6, 1)), users, DAY, 5)) == [(None, None, 1)]


def test_spenders_in_units(activity, users):
    found = activity("amount_cents", (1, -5), (2, 12345), (3, 0))
    assert [r[2] for r in in_order(top_spenders(found, users, DAY, 9))] == [
        Decimal("123.45"),
        Decimal("0.00"),
        Decimal("-0.05"),
    ]


def test_pairs(spark, users):
    made = [(1, 2, DAY, 3), (1, 9, DAY, 8), (2, 3, DAY, 3), (4, 4, DAY, 5)]
    pairs = spark.createDataFrame(
        made, "user1 bigint, user2 bigint, transaction_date date, transaction_freq bigint"
    )
    assert in_order(top_pairs(pairs, users, DAY, 2)) == [
        ("F4 L4", "p4", "F4 L4", "p4", 5),
        ("F1 L1", "p1", "F2 L2", "p2", 3),
    ]
    assert in_order(top_pair_ids(pairs, DAY, 2)) == [(1, 9, 8), (4, 4, 5)]


def test_reports_over_stored_tables(warehouse, lines):
    texts = [
        line("7", "9"),
        line("7", "9"),
        line("9", "8", amount_cents=900),
        line("3", "9", actor=party("3", lastname=...)),
    ]
    load_payments(parse_payments(lines(*texts)), warehouse)
    senders = in_order(report(warehouse, "active_senders", DAY, 10))
    assert senders == [("Ann Lee", "http://pics/7", 2), ("Ann Lee", "http://pics/9", 1)]
    assert in_order(report(warehouse, "active_receivers", DAY, 1)) == [
        ("Ann Lee", "http://pics/9", 3)
    ]
    (pair,) = in_order(report(warehouse, "active_pairs", DAY, 1))
    assert pair[1::2] == ("http://pics/7", "http://pics/9") and pair[4] == 2
    # 900 sent to 8; 250 received twice from 7 and once from the unknown 3.
    assert [r[2] for r in in_order(report(warehouse, "active_spenders", DAY, 2))] == [
        Decimal("5.00"),
        Decimal("1.50"),
    ]
    assert in_order(report(warehouse, "active_senders", "2017-01-09", 10)) == []


def test_bad_arguments(warehouse, activity, users):
    with pytest.raises(ValueError):
        report(warehouse, "active_lurkers", DAY, 10)
    with pytest.raises(ValueError):
        top_senders(activity("send_freq", (1, 1)), users, DAY, 0)


def test_plan_of_a_stored_report(warehouse, lines):
    load_payments(parse_payments(lines(line(), line(at="2017-01-06T01:00:00Z"))), warehouse)
    # More rows than a day's best are read from the day.
    df = report(warehouse, "active_pairs", DAY, 5000, users_known=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2
    assert plan.count("BroadcastHashJoin") == 2
    assert "PartitionFilters: [isnotnull(transaction_date" in plan
    assert "SortMergeJoin" not in plan and "Python" not in plan


def test_a_large_n_is_not_broadcast(warehouse, lines):
    load_payments(parse_payments(lines(line())), warehouse)
    small = report(warehouse, "active_senders", DAY, 100)._jdf.queryExecution().toString()
    large = report(warehouse, "active_senders", DAY, 10**6)._jdf.queryExecution().toString()
    assert "strategy=broadcast" in small and "strategy=broadcast" not in large
