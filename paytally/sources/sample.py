"""The given test tables seen as payments, users and raw JSON lines.

``events`` plays the payments: ``user_id`` pays the user in ``props.k`` the amount
in ``value``. Nothing is sampled; each frame covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytally.session import file_system


# Stated so that reading a table costs no job to infer its schema.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _receiver() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _created(zone: str) -> Column:
    return F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))


def _profile(user_id: Column) -> list[Column]:
    """A profile that tells from which event it was taken."""
    return [
        F.concat(F.lit("user"), user_id).alias("username"),
        F.col("event_type").alias("firstname"),
        user_id.cast("string").alias("lastname"),
        F.concat_ws("/", "event_type", "event_id").alias("picture"),
    ]


def payments_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments frame straight from ``events``."""
    receiver = _receiver()
    return (
        _table(spark, sf_dir, "events")
        .select(
            F.col("event_id").alias("payment_id"),
            _created("Z").alias("created_time"),
            F.col("user_id").alias("sender_id"),
            receiver.alias("receiver_id"),
            F.col("ts").cast("date").alias("transaction_date"),
            _cents().alias("amount_cents"),
            F.struct(*_profile(F.col("user_id"))).alias("sender"),
            F.struct(*_profile(receiver)).alias("receiver"),
        )
    )


def users_from_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as users; every party of ``events`` is among them."""
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("username"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("firstname"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("lastname"),
        F.col("c_mktsegment").alias("picture"),
    )


def users_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers as users; they are fewer than the parties of ``events``."""
    return _table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("username"),
        F.split_part("s_name", F.lit("#"), F.lit(1)).alias("firstname"),
        F.split_part("s_name", F.lit("#"), F.lit(2)).alias("lastname"),
        F.col("s_name").alias("picture"),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as ``(day, value)``, one JSON line each, in a shape per event type.

    click: complete. view: complete, ids as JSON numbers. signup: no transactions.
    purchase: the actor lacks its lastname, and the time has another zone.
    error: the line is cut off.
    """
    kind = F.col("event_type")
    receiver = _receiver()

    def party(user_id: Column, has_lastname: Column) -> Column:
        username, firstname, lastname, picture = _profile(user_id)
        return F.struct(
            user_id.cast("string").alias("id"),
            username,
            firstname,
            F.when(has_lastname, lastname).alias("lastname"),
            picture,
        )

    # NULL fields are left out of the JSON text.
    paid = F.array(F.struct(party(receiver, F.lit(True)).alias("target")))
    record = F.struct(
        F.col("event_id").alias("payment_id"),
        F.when(kind != "signup", paid).alias("transactions"),
        party(F.col("user_id"), kind != "purchase").alias("actor"),
        F.lit("payment").alias("type"),
        F.when(kind == "purchase", _created("-05:00"))
        .otherwise(_created("Z"))
        .alias("created_time"),
        F.lit('for lunch, "thanks"').alias("message"),
        _cents().alias("amount_cents"),
    )
    text = F.col("text")
    value = (
        F.when(kind == "view", F.regexp_replace(text, r'"id":"(\d+)"', r'"id":$1'))
        .when(kind == "error", F.substring(text, F.lit(1), F.length(text) - 1))
        .otherwise(text)
    )
    events = _table(spark, sf_dir, "events")
    return events.select("ts", "event_type", F.to_json(record).alias("text")).select(
        F.col("ts").cast("date").alias("day"), value.alias("value")
    )


def write_period_files(lines: DataFrame, root: str, prefix: str = "payments") -> None:
    """Write ``(day, value)`` lines in the layout that ``period_path`` reads.

    One distributed write split by day, in partitions that Spark sizes at run time, so
    a day with most of the lines is written by several tasks; then each day's folder
    gets its final name.
    """
    spark = lines.sparkSession
    name = F.date_format("day", "yyyy_MM_dd")
    daily = lines.select("value", name.alias("name"))
    landing = f"{root}/_written"
    daily.hint("rebalance", "name").write.partitionBy("name").text(landing)
    fs, base = file_system(spark, landing)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for entry in fs.listStatus(base):
        folder = entry.getPath().getName()
        if folder.startswith("name="):
            day = folder.removeprefix("name=")
            target = jvm_path(f"{root}/{day[:7]}/{prefix}_{day}.json")
            fs.mkdirs(target.getParent())
            fs.rename(entry.getPath(), target)
