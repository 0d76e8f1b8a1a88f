"""How tables are stored: whole days, users in buckets, best rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from records import line, rows

from paytally.operators import pair_activity, user_day_totals
from paytally.plans import load_payments, report
from paytally.plans import reports as reports_module
from paytally.schema import TABLES
from paytally.session import drop_path
from paytally.sinks import Warehouse, insert_ignore
from paytally.sinks import warehouse as module
from paytally.sinks.versions import DayVersions, Version
from paytally.sources import parse_payments

DAY, NEXT = dt.date(2017, 1, 5), dt.date(2017, 1, 6)
TABLE = "sender_activity"
DDL = TABLES[TABLE].ddl


@pytest.fixture
def users(spark, warehouse):
    made = [(i, f"u{i}", f"F{i}", "L", f"p{i}") for i in range(1, 101)]
    insert_ignore(spark.createDataFrame(made, TABLES["users"].ddl), warehouse, "users")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def add(spark, warehouse, *found):
    return insert_ignore(spark.createDataFrame(found, DDL), warehouse, TABLE)


def broken(spark, *found):
    """A batch whose last task fails when it is written."""
    fine = spark.createDataFrame(found, DDL).coalesce(1)
    bad = spark.range(1, numPartitions=1).select(
        F.lit(99).cast("bigint").alias("user_id"),
        F.lit(DAY).alias("transaction_date"),
        F.raise_error(F.lit("half-way")).cast("bigint").alias("send_freq"),
    )
    return fine.union(bad)


# --- whole days ------------------------------------------------------------------


def test_readers_see_none_or_all_of_a_day(spark, warehouse, users, monkeypatch):
    seen, fine = [], DayVersions.publish

    def publish(self, load, days):
        if not self.root.endswith("_best"):
            seen.append(rows(warehouse.read_table(TABLE)))
        fine(self, load, days)

    monkeypatch.setattr(DayVersions, "publish", publish)
    assert add(spark, warehouse, (1, DAY, 5), (2, DAY, 6), (1, NEXT, 1)) == 3
    assert add(spark, warehouse, (1, DAY, 9), (3, DAY, 7), (2, NEXT, 2)) == 2
    # All rows of each load lay in files when the table still showed what it had before.
    assert seen == [[], [(1, DAY, 5), (1, NEXT, 1), (2, DAY, 6)]]
    assert rows(warehouse.read_table(TABLE)) == [
        (1, DAY, 5), (1, NEXT, 1), (2, DAY, 6), (2, NEXT, 2), (3, DAY, 7)
    ]


@pytest.mark.parametrize("before", [(), ((1, DAY, 5), (2, DAY, 6))])
def test_a_write_that_fails_half_way_shows_nothing(spark, warehouse, users, before):
    if before:
        add(spark, warehouse, *before)
    batch = broken(spark, (1, DAY, 9), (3, DAY, 7))
    with pytest.raises(Exception, match="half-way"):
        warehouse.add_new(batch, TABLE, module.BatchDays(DAY, DAY, (DAY,)))
    assert rows(warehouse.read_table(TABLE)) == sorted(before)
    add(spark, warehouse, (1, DAY, 9), (3, DAY, 7))
    kept = {1: (1, DAY, 9), 3: (3, DAY, 7), **{r[0]: r for r in before}}
    assert rows(warehouse.read_table(TABLE)) == sorted(kept.values())
    assert warehouse.drop_unused() > 0
    assert warehouse.read_table(TABLE).count() == len({1, 3, *(r[0] for r in before)})


def test_a_publication_that_the_catalog_missed_is_told_to_it(spark, warehouse, users, monkeypatch):
    add(spark, warehouse, (1, DAY, 5))
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "register_days", lambda *_: None)  # dies before
        add(spark, warehouse, (2, DAY, 6))
    assert rows(warehouse.read_table(TABLE)) == [(1, DAY, 5)]
    assert add(spark, warehouse, (2, DAY, 7)) == 0
    assert rows(warehouse.read_table(TABLE)) == [(1, DAY, 5), (2, DAY, 6)]


def test_another_session_sees_the_last_versions(spark, warehouse, users):
    add(spark, warehouse, (1, DAY, 5), (1, NEXT, 5))
    add(spark, warehouse, (2, DAY, 6))
    other = Warehouse(spark, warehouse.location, warehouse.database + "_other")
    try:
        assert rows(other.read_table(TABLE)) == [(1, DAY, 5), (1, NEXT, 5), (2, DAY, 6)]
        assert rows(other.snapshot(TABLE)) == rows(other.read_table(TABLE))
        assert add(spark, other, (3, DAY, 1), (2, DAY, 9)) == 1
        assert add(spark, warehouse, (3, DAY, 2)) == 0
        assert rows(warehouse.read_table(TABLE)) == rows(other.read_table(TABLE))
    finally:
        spark.sql(f"DROP DATABASE `{other.database}` CASCADE")


def test_days_put_there_by_others_are_found(spark, warehouse, users, tmp_path):
    made = spark.createDataFrame([(1, 5), (2, 6)], "user_id bigint, send_freq bigint")
    made.write.parquet(f"{warehouse.path(TABLE)}/transaction_date={DAY}")
    assert rows(warehouse.read_table(TABLE)) == [(1, DAY, 5), (2, DAY, 6)]
    assert add(spark, warehouse, (2, DAY, 1), (3, DAY, 7), (1, NEXT, 1)) == 2
    want = [(1, DAY, 5), (1, NEXT, 1), (2, DAY, 6), (3, DAY, 7)]
    assert rows(warehouse.read_table(TABLE)) == want
    other = Warehouse(spark, warehouse.location, warehouse.database + "_other")
    assert rows(other.read_table(TABLE)) == want
    spark.sql(f"DROP DATABASE `{other.database}` CASCADE")


def test_versions_and_what_is_unused(spark, tmp_path):
    versions = DayVersions(spark, str(tmp_path))
    assert versions.current() == {} and versions.written("none") == []
    for load, days in (("a", ["2017-01-05", "2017-01-06"]), ("b", ["2017-01-05"]), ("c", ["2017-01-07"])):
        for day in days:
            spark.range(1).write.parquet(versions.day_folder(Version(day, 0, load)))
    versions.publish("a", versions.written("a"))
    versions.publish("b", versions.written("b"))
    assert versions.current() == {
        "2017-01-05": Version("2017-01-05", 2, "b"),
        "2017-01-06": Version("2017-01-06", 1, "a"),
    }
    # A publication that died before the older one was taken away.
    (tmp_path / "_days" / Version("2017-01-06", 7, "b").name).touch()
    assert versions.current()["2017-01-06"].load == "b"
    (tmp_path / "_days" / Version("2017-01-06", 7, "b").name).unlink()
    assert versions.drop_unused() == 2  # the 5th of a, the 7th of c
    assert versions.written("a") == ["2017-01-06"] and versions.written("c") == []


# --- new days and stored keys ------------------------------------------------------


def test_keys_of_new_days_are_compared_with_nothing(spark, warehouse, users, monkeypatch):
    plans, fine = [], Warehouse._write_days

    def write(self, df, table, folder, one):
        if "_best" not in folder:
            plans.append(plan_of(df))
        return fine(self, df, table, folder, one)

    monkeypatch.setattr(Warehouse, "_write_days", write)
    add(spark, warehouse, (1, DAY, 5), (1, NEXT, 5))
    assert len(plans) == 1 and "LeftAnti" not in plans.pop()
    # One known day and one new one: only the known day's rows are compared, and as
    # nothing is new there, it is not written again.
    add(spark, warehouse, (1, DAY, 5), (1, dt.date(2017, 1, 7), 5))
    assert ["LeftAnti" in plan for plan in plans] == [False, True]
    assert warehouse.read_table(TABLE).count() == 3


# --- users in buckets -------------------------------------------------------------


def test_stored_users_are_not_shuffled_for_joins(spark, warehouse, users, lines):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        payments = parse_payments(lines(line("1", "2"), line("3", "200")))
        daily = user_day_totals(payments)
        ids = warehouse.known_users(one_row_a_day=True).select("id").distinct()
        plan = plan_of(daily.join(ids, daily["user_id"] == ids["id"], "left"))
        stored = plan[plan.index("Sort [id#") :]
        assert "Bucketed: true" in stored and "Exchange" not in stored
        new = spark.range(50, 150).join(warehouse.read_table("users"), "id", "left_anti")
        assert plan_of(new).count("Exchange") == 1
        assert new.count() == 49
        # Where a user has many rows, both sides are shuffled, so that skew can be split.
        pairs = pair_activity(payments)
        known = warehouse.known_users(one_row_a_day=False)
        plan = plan_of(pairs.join(known, pairs["user1"] == known["id"], "left_semi"))
        assert "Bucketed: true" not in plan
    finally:
        spark.conf.set(key, before)


def test_buckets_too_few_for_a_load_are_not_used(spark, warehouse, users):
    assert "Bucketed" in plan_of(warehouse.known_users(True).groupBy("id").count())
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, "4000")
    try:
        assert "Bucketed" not in plan_of(warehouse.known_users(True).groupBy("id").count())
    finally:
        spark.conf.set(key, before)


def test_another_session_reads_the_buckets_that_were_written(spark, warehouse, users):
    assert warehouse.buckets_of("users") == 2
    other = Warehouse(spark, warehouse.location, warehouse.database + "_other", user_buckets=7)
    try:
        assert other.read_table("users").groupBy("id").count().where("count > 1").isEmpty()
        assert other.buckets_of("users") == 2
        assert other.read_table("users").where("id = 77").count() == 1
    finally:
        spark.sql(f"DROP DATABASE `{other.database}` CASCADE")


def test_files_without_buckets_are_read_as_such(spark, warehouse):
    made = spark.createDataFrame([(1, "a", "b", "c", "d")], TABLES["users"].ddl)
    made.write.parquet(warehouse.path("users"))
    more = spark.createDataFrame([(1, "x", "", "", ""), (2, "x", "", "", "")], TABLES["users"].ddl)
    assert insert_ignore(more, warehouse, "users") == 1
    assert warehouse.buckets_of("users") == 0
    assert rows(warehouse.read_table("users").select("id", "username")) == [(1, "a"), (2, "x")]


# --- best rows ---------------------------------------------------------------------


@pytest.fixture
def few_best(monkeypatch):
    monkeypatch.setattr(module, "BEST_ROWS", 5)
    monkeypatch.setattr(reports_module, "BEST_ROWS", 5)


def top(warehouse, n, **kw):
    return [tuple(r) for r in report(warehouse, "active_senders", DAY, n, **kw).collect()]


def named(*found):
    return [(f"F{i} L", f"p{i}", n) for i, n in found]


def test_best_rows_follow_each_load(spark, warehouse, users, few_best):
    add(spark, warehouse, *[(i, DAY, i % 7) for i in range(1, 31)], (50, NEXT, 1))
    best = [(6, 6), (13, 6), (20, 6), (27, 6), (5, 5)]
    assert rows(warehouse.read_best(TABLE, str(DAY))) == sorted(((i, DAY, n) for i, n in best), key=repr)
    assert top(warehouse, 5) == named(*best)
    # A later load brings a better row, one that ties, and one that is stored already.
    add(spark, warehouse, (40, DAY, 9), (7, DAY, 99), (2, NEXT, 3), (41, DAY, 6))
    best = [(40, 9), (6, 6), (13, 6), (20, 6), (27, 6)]
    assert rows(warehouse.read_best(TABLE, str(DAY))) == sorted(((i, DAY, n) for i, n in best), key=repr)
    assert top(warehouse, 5) == named(*best)
    assert top(warehouse, 2, users_known=True) == named(*best[:2])
    assert warehouse.read_best(TABLE, "2017-03-01") is None


def test_a_report_reads_the_best_rows_and_no_more(spark, warehouse, users, few_best):
    add(spark, warehouse, *[(i, DAY, i) for i in range(1, 31)])
    df = report(warehouse, "active_senders", DAY, 3)
    assert all(TABLE not in path or f"{TABLE}_best/" in path for path in df.inputFiles())
    plan = plan_of(df)
    assert "In(id, [28,29,30])" in plan  # the users of the report, looked up by value
    larger = report(warehouse, "active_senders", DAY, 6)
    assert any(f"{TABLE}/_loads" in path for path in larger.inputFiles())
    assert [r.send_freq for r in larger.collect()] == [30, 29, 28, 27, 26, 25]


def test_a_report_falls_back_where_too_few_are_left(spark, warehouse, users, few_best):
    add(spark, warehouse, *[(i, DAY, i) for i in range(1, 31)])

    class Without:
        def __init__(self, *gone):
            self.gone = gone
            self.read_best = warehouse.read_best

        def read_table(self, table):
            found = warehouse.read_table(table)
            return found.where(~F.col("id").isin(*self.gone)) if table == "users" else found

    def read_day(df):
        return any(f"{TABLE}/_loads" in path for path in df.inputFiles())

    two_left = report(Without(30, 28, 27), "active_senders", DAY, 2)
    assert [r.send_freq for r in two_left.collect()] == [29, 26] and not read_day(two_left)
    too_few = report(Without(30, 28, 27), "active_senders", DAY, 3)
    assert [r.send_freq for r in too_few.collect()] == [29, 26, 25] and read_day(too_few)


def test_a_day_of_few_rows_is_answered_whole(spark, warehouse, users, few_best):
    add(spark, warehouse, (1, DAY, 1), (2, DAY, 2))
    df = report(warehouse, "active_senders", DAY, 4)
    assert [r.send_freq for r in df.collect()] == [2, 1]
    assert not any(f"{TABLE}/_loads" in path for path in df.inputFiles())


def test_best_rows_of_another_version_do_not_count(spark, warehouse, users, few_best, monkeypatch):
    add(spark, warehouse, *[(i, DAY, i) for i in range(1, 31)])
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "_keep_best", lambda *_: None)  # dies before
        add(spark, warehouse, (31, DAY, 99))
    assert warehouse.read_best(TABLE, str(DAY)) is None
    assert top(warehouse, 1) == named((31, 99))
    # The next load of the day ranks it anew, though it adds nothing.
    assert add(spark, warehouse, (31, DAY, 1)) == 0
    assert warehouse.read_best(TABLE, str(DAY)).count() == 5
    assert top(warehouse, 2) == named((31, 99), (30, 30))


def test_all_reports_equal_those_without_best_rows(warehouse, lines):
    texts = [line(str(a), str(b), amount_cents=a * b) for a in range(1, 7) for b in range(1, a)]
    load_payments(parse_payments(lines(*texts)), warehouse)

    class Plain:
        read_table = staticmethod(warehouse.read_table)

    for metric in reports_module.REPORTS:
        for n in (1, 3, 50):
            want = report(Plain, metric, DAY, n).collect()
            assert report(warehouse, metric, DAY, n).collect() == want


def test_best_rows_of_some_days_are_mended_beside_the_others(spark, warehouse, users, few_best):
    add(spark, warehouse, *[(i, DAY, i) for i in range(1, 9)], *[(i, NEXT, -i) for i in range(1, 9)])
    before = {day: rows(warehouse.read_best(TABLE, str(day))) for day in (DAY, NEXT)}
    # As after a driver that died between the two publications.
    best = warehouse.best_versions(TABLE)
    drop_path(spark, f"{best.root}/_days/{best.current()[str(NEXT)].name}")
    assert warehouse.read_best(TABLE, str(NEXT)) is None
    assert add(spark, warehouse, (1, DAY, 1), (1, NEXT, 1)) == 0
    assert {day: rows(warehouse.read_best(TABLE, str(day))) for day in (DAY, NEXT)} == before
    warehouse.drop_unused()
    assert {day: rows(warehouse.read_best(TABLE, str(day))) for day in (DAY, NEXT)} == before
