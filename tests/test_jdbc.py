"""What the JDBC target asks of Spark. No database takes part."""

import datetime as dt
from unittest import mock

import pytest
from records import line, rows

from paytally import __main__ as command_line
from paytally.plans import load_payments
from paytally.schema import TABLES
from paytally.sinks import JdbcTarget, insert_ignore, merge_staged, stage
from paytally.sources import parse_payments

OPTIONS = {"driver": "org.example.Driver", "user": "u"}
BOUNDS = {"sender_activity": ("user_id", "0", "9"), "users": ("id", "1", "5")}
DAY = dt.date(2017, 1, 5)


def chain():
    """A reader or writer whose every step returns itself."""
    step = mock.MagicMock()
    for name in ("format", "options", "option", "mode", "load", "select", "observe"):
        getattr(step, name).return_value = step
    return step


def test_each_table_is_read_by_its_own_bounds():
    spark = mock.MagicMock()
    target = JdbcTarget(spark, "jdbc:x", OPTIONS, BOUNDS, max_connections=4)
    for table, column, upper in (("sender_activity", "user_id", "9"), ("users", "id", "5")):
        spark.read = reader = chain()
        target.read_table(table)
        reader.format.assert_called_with("jdbc")
        reader.options.assert_any_call(**OPTIONS)
        lower = BOUNDS[table][1]
        reader.options.assert_called_with(partitionColumn=column, lowerBound=lower, upperBound=upper)
        reader.option.assert_any_call("numPartitions", "4")
        reader.option.assert_any_call("dbtable", table)
        reader.select.assert_called_with(*TABLES[table].column_names)
    spark.read = reader = chain()
    target.read_table("pair_activity")
    reader.options.assert_called_once_with(**OPTIONS)


def test_bounds_for_all_tables_are_refused():
    with pytest.raises(ValueError):
        JdbcTarget(mock.MagicMock(), "jdbc:x", {"partitionColumn": "user_id"})


def test_staging_overwrites_from_the_executors():
    df = chain()
    df.write = writer = chain()
    assert JdbcTarget(mock.MagicMock(), "jdbc:x", OPTIONS).stage(df, "users") == "users_temp"
    df.select.assert_called_with(*TABLES["users"].column_names)
    writer.options.assert_called_with(numPartitions="32", **OPTIONS)
    writer.option.assert_any_call("dbtable", "users_temp")
    writer.mode.assert_called_with("overwrite")
    writer.save.assert_called_once()


def test_missing_tables_are_created_with_their_keys():
    spark = mock.MagicMock()
    JdbcTarget(spark, "jdbc:x", OPTIONS).ensure_table("users")
    connect = spark.sparkContext._jvm.java.sql.DriverManager.getConnection
    connection = connect.return_value
    (statement,), _ = connection.createStatement.return_value.executeUpdate.call_args
    assert statement == (
        "CREATE TABLE IF NOT EXISTS users (id BIGINT NOT NULL, username TEXT NOT NULL, "
        "firstname TEXT, lastname TEXT, picture TEXT, PRIMARY KEY (id))"
    )
    connection.close.assert_called_once()
    assert "PRIMARY KEY (user1, user2, transaction_date)" in JdbcTarget(
        spark, "jdbc:x"
    ).create_statement("pair_activity")


class Stored:
    """The tables of a database as frames; writes replace or extend them."""

    def __init__(self, spark, monkeypatch):
        self.spark, self.tables, self.created = spark, {}, []
        monkeypatch.setattr(JdbcTarget, "_execute", lambda _, sql: self.created.append(sql))
        monkeypatch.setattr(JdbcTarget, "_read", lambda _, name, bounds: self.frame(name))
        monkeypatch.setattr(JdbcTarget, "_write", lambda _, df, name, mode: self.put(df, name, mode))

    def frame(self, name):
        ddl = TABLES[name.removesuffix("_temp")].ddl
        return self.spark.createDataFrame(self.tables.get(name, []), ddl)

    def put(self, df, name, mode):
        found = [tuple(r) for r in df.collect()]
        self.tables[name] = found + (self.tables.get(name, []) if mode == "append" else [])


def test_insert_ignore_appends_only_what_is_missing(spark, monkeypatch):
    """The key checks run for real, with frames in place of the tables."""
    stored = Stored(spark, monkeypatch)
    stored.tables = {
        "users": [(i, "u", "", "", "") for i in (1, 2, 3)],
        "pair_activity": [(1, 2, DAY, 7)],
    }
    ddl = TABLES["pair_activity"].ddl
    batch = [(1, 2, DAY, 1), (2, 3, DAY, 4), (3, 9, DAY, 2), (None, 2, DAY, 1), (1, 3, None, 1)]
    target = JdbcTarget(spark, "jdbc:x")
    for written in (1, 0):
        assert insert_ignore(spark.createDataFrame(batch, ddl), target, "pair_activity") == written
    assert sorted(stored.tables["pair_activity"]) == [(1, 2, DAY, 7), (2, 3, DAY, 4)]


def test_a_staged_table_is_merged(spark, monkeypatch):
    stored = Stored(spark, monkeypatch)
    stored.tables["users"] = [(1, "old", "", "", "")]
    new = [(1, "new", "", "", ""), (2, "two", "", "", ""), (None, "x", "", "", "")]
    target = JdbcTarget(spark, "jdbc:x")
    staging = stage(spark.createDataFrame(new, TABLES["users"].ddl), target, "users")
    assert merge_staged(target, staging, "users") == 1
    assert sorted(r[:2] for r in stored.tables["users"]) == [(1, "old"), (2, "two")]


def test_a_load_fills_all_tables_as_a_warehouse(spark, warehouse, lines, monkeypatch):
    stored = Stored(spark, monkeypatch)
    payments = parse_payments(lines(line(), line("9", "7"), line("9", "8"), "{bad"))
    target = JdbcTarget(spark, "jdbc:x")
    written = load_payments(payments, target)
    assert written == load_payments(payments, warehouse)
    for table in TABLES:
        assert sorted(stored.tables[table]) == rows(warehouse.read_table(table))
    assert {sql.split()[5] for sql in stored.created} == set(TABLES)
    assert set(load_payments(payments, target).values()) == {0}


def test_command_line_builds_the_target():
    text = "--jdbc-url jdbc:x --jdbc-option user=u --jdbc-option password=a=b"
    text += " --jdbc-bounds users:id:0:9 load-file /raw/x.json"
    target = command_line.target_of(mock.MagicMock(), command_line.arguments(text.split()))
    assert (target.url, target.options) == ("jdbc:x", {"user": "u", "password": "a=b"})
    assert target.bounds == {"users": ("id", "0", "9")}
