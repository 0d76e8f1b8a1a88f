import datetime as dt
import random
from collections import Counter

import pytest
from records import line, party, rows
from pyspark.sql import functions as F

from paytally.operators import (
    canonical_pairs,
    first_per_key,
    keep_known_users,
    net_spending,
    new_keys_only,
    pair_activity,
    receiver_activity,
    sender_activity,
    signed_legs,
    user_day_totals,
    user_mentions,
    users_dim,
)
from paytally.schema import PAYMENTS
from paytally.sources import parse_payments
from paytally.sources.sample import payments_from_events

DAY = dt.date(2017, 1, 5)
SF_DIR = "/root/testdata/sf0.001"


def test_self_payment(lines):
    payments = parse_payments(lines(line("7", "7")))
    assert rows(pair_activity(payments)) == [(7, 7, DAY, 1)]
    assert rows(sender_activity(payments)) == rows(receiver_activity(payments)) == [(7, DAY, 1)]
    assert rows(net_spending(payments)) == [(7, DAY, 0)]


def test_pairs_are_unordered(lines):
    payments = parse_payments(lines(line("9", "7"), line("7", "9"), line("7", "10")))
    assert rows(pair_activity(payments)) == [(7, 10, DAY, 1), (7, 9, DAY, 2)]


def test_net_is_sent_minus_received_and_joins_padded_ids(lines):
    payments = parse_payments(
        lines(line("07", "9", amount_cents=100), line("7", "9", amount_cents=50),
              line("9", "7", amount_cents=400))
    )
    assert rows(net_spending(payments)) == [(7, DAY, -250), (9, DAY, 250)]


def test_days_are_apart(lines):
    payments = parse_payments(lines(line(), line(at="2017-01-06T00:00:00Z")))
    assert rows(sender_activity(payments)) == [(7, DAY, 1), (7, DAY + dt.timedelta(1), 1)]


def test_metrics_agree_with_each_other(spark):
    payments = payments_from_events(spark, SF_DIR)
    total = payments.count()
    for metric, measure in (
        (sender_activity, "send_freq"),
        (receiver_activity, "recv_freq"),
        (pair_activity, "transaction_freq"),
    ):
        assert metric(payments).agg(F.sum(measure)).first()[0] == total
    by_day = net_spending(payments).groupBy("transaction_date").agg(F.sum("amount_cents").alias("s"))
    assert by_day.where("s <> 0").count() == 0
    assert canonical_pairs(payments).where("user1 > user2").count() == 0
    assert signed_legs(payments).count() == 2 * total


def test_daily_totals_hold_the_three_user_metrics(lines):
    payments = parse_payments(
        lines(
            line("7", "9"),
            line("9", "7", amount_cents=None),
            line("8", transactions=[]),
            line("x", "6"),
            line(at="never"),
        )
    )
    totals = user_day_totals(payments)
    senders = totals.where("send_freq > 0").select("user_id", "transaction_date", "send_freq")
    receivers = totals.where("recv_freq > 0").select("user_id", "transaction_date", "recv_freq")
    net = totals.where("amount_cents IS NOT NULL").drop("send_freq", "recv_freq")
    assert rows(senders) == rows(sender_activity(payments))
    assert rows(receivers) == rows(receiver_activity(payments))
    assert rows(net) == rows(net_spending(payments))


def test_a_hot_user_counts_in_full(spark):
    """One user takes part in a third of all payments, one pair in most of those."""
    rng = random.Random(5)
    made = []
    for n in range(6000):
        pair = (1, 2) if n % 3 == 0 else (rng.randrange(3, 400), rng.randrange(3, 400))
        made.append((*pair, DAY, n))
    payments = spark.createDataFrame(
        made, "sender_id bigint, receiver_id bigint, transaction_date date, amount_cents bigint"
    ).repartition(7)
    sends = Counter(s for s, *_ in made)
    net = Counter()
    for s, r, _, cents in made:
        net[s] += cents
        net[r] -= cents
    assert {r.user_id: r.send_freq for r in sender_activity(payments).collect()} == sends
    assert {r.user_id: r.amount_cents for r in net_spending(payments).collect()} == net
    pairs = Counter((min(s, r), max(s, r)) for s, r, *_ in made)
    got = {(r.user1, r.user2): r.transaction_freq for r in pair_activity(payments).collect()}
    assert got == pairs


def users_of(lines, *texts):
    return rows(users_dim(user_mentions(parse_payments(lines(*texts)))))


def test_first_mention_wins(lines):
    def at(time, payment_id, sender, receiver):
        return line(
            actor=party("7", sender),
            transactions=[{"target": party("7", receiver)}],
            at=time,
            payment_id=payment_id,
        )

    def winner(*texts):
        (user,) = users_of(lines, *texts)
        return user[2]

    late, early = "2017-01-06T00:00:00Z", "2017-01-05T00:00:00Z"
    assert winner(at(late, 1, "Ann", "Bob"), at(early, 2, "Cid", "Dan")) == "Cid"
    assert winner(at(early, 2, "Ann", "Bob"), at(early, 1, "Cid", "Dan")) == "Cid"
    assert winner(at(early, 1, "Zoe", "Bob")) == "Zoe"  # the sender comes first
    assert winner(at(None, 1, "Ann", "Bob"), at(late, 2, "Cid", "Dan")) == "Cid"
    assert winner(at(early, 1, "Eve", "Bob"), at(early, 1, "Cid", "Dan")) == "Cid"


def test_mentions_without_username_are_dropped(lines):
    assert [u[0] for u in users_of(lines, line(actor=party("7", username=None)))] == [9]
    named_later = users_of(
        lines,
        line(actor=party("7", username=None)),
        line(actor=party("7", "Late"), at="2017-02-01T00:00:00Z"),
    )
    assert [u[1] for u in named_later if u[0] == 7] == ["Late-7"]


def test_key_checks(spark):
    df = spark.createDataFrame([(1, 2, 5), (1, 3, 6), (4, 4, 7)], "user1 int, user2 int, n int")
    users = spark.createDataFrame([(1,), (2,), (4,)], "id int")
    assert rows(keep_known_users(df, users, "user1", "user2")) == [(1, 2, 5), (4, 4, 7)]
    existing = df.where("n = 6")
    assert rows(new_keys_only(df, existing, "user1", "user2")) == [(1, 2, 5), (4, 4, 7)]


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, None, 1)], "k int, v string, o int")
    assert rows(first_per_key(df, ["k"], "o")) == [(1, "b", 2), (2, None, 1)]
    assert rows(first_per_key(df, ["k"])) == [(1, "a", 3), (2, None, 1)]
    assert rows(first_per_key(df.select("k"), ["k"])) == [(1,), (2,)]


@pytest.mark.parametrize("job", [sender_activity, pair_activity, net_spending, user_day_totals])
def test_aggregates_are_reduced_before_their_one_shuffle(spark, job):
    plan = job(payments_from_events(spark, SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_" in plan.split("Exchange hashpartitioning")[1]
    assert "Python" not in plan


def test_jobs_read_only_their_columns(spark, tmp_path):
    path = str(tmp_path / "staged")
    spark.createDataFrame([], PAYMENTS).write.parquet(path)
    staged = spark.read.schema(PAYMENTS).parquet(path)

    def read(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.split("ReadSchema: struct<")[1].split("\n")[0]

    assert read(sender_activity(staged)) == "sender_id:bigint,transaction_date:date>"
    assert read(pair_activity(staged)) == (
        "sender_id:bigint,receiver_id:bigint,transaction_date:date>"
    )
    assert read(user_day_totals(staged)) == (
        "sender_id:bigint,receiver_id:bigint,transaction_date:date,amount_cents:bigint>"
    )
    ids = user_mentions(staged, ("username",)).select("id", "username")
    assert read(ids).startswith(
        "sender_id:bigint,receiver_id:bigint,sender:struct<username:string>,"
    )


def test_a_hot_user_is_split_in_the_known_user_check(spark):
    """A third of all pairs share one user; the join spreads them over several tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        n = F.col("id")
        pairs = spark.range(0, 60_000, 1, 8).select(
            F.when(n % 3 == 0, F.lit(5)).otherwise(F.pmod(F.xxhash64(n), F.lit(9000))).alias("user1"),
            n.alias("user2"),
        )
        users = spark.range(0, 50_000, 1, 4)
        kept = keep_known_users(pairs, users, "user1", "user2")
        assert len(kept.collect()) == 50_000
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
