"""Shapes of the raw record, the parsed payments frame and the result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Text fields of a user mention besides its id.
PROFILE_FIELDS = ("username", "firstname", "lastname", "picture")

# A raw line wrapped in brackets parses as an array with one record. Scalars
# stay text here and are cast leniently later; the two parties are maps because
# a map, unlike a struct, tells an absent key from a JSON null. Transactions stay
# text because only the first is read, and a broken later one must not spoil it.
RAW_RECORDS = (
    "array<struct<"
    "payment_id:string,"
    "created_time:string,"
    "amount_cents:string,"
    "actor:map<string,string>,"
    "transactions:array<string>"
    ">>"
)
RAW_TRANSACTION = "target map<string,string>"

PROFILE = T.StructType([T.StructField(f, T.StringType()) for f in PROFILE_FIELDS])

PAYMENTS = T.StructType(
    [
        T.StructField("payment_id", T.LongType()),
        T.StructField("created_time", T.StringType()),
        T.StructField("sender_id", T.LongType()),
        T.StructField("receiver_id", T.LongType()),
        T.StructField("transaction_date", T.DateType()),
        T.StructField("amount_cents", T.LongType()),
        T.StructField("sender", PROFILE),
        T.StructField("receiver", PROFILE),
    ]
)


@dataclass(frozen=True)
class TableSpec:
    """Columns, primary key and the columns that must exist in ``users``."""

    name: str
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]
    user_columns: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()

    @property
    def required(self) -> tuple[str, ...]:
        """Columns without which a row is not stored: the keys, and those not null."""
        return (*self.keys, *self.not_null)

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def is_dated(self) -> bool:
        return "transaction_date" in self.column_names

    @property
    def measure(self) -> str:
        """What a metric measures; of a table of keys only, its last key."""
        return self.column_names[-1]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{name}` {dtype}" for name, dtype in self.columns)


# Sums of BIGINT amounts and their negatives.
CENTS = "DECIMAL(38,0)"

# Ids and counts are BIGINT: one key may hold a large share of all payments, and
# an INT counter would overflow (and fail the job) at that size.
USERS = TableSpec(
    "users",
    (
        ("id", "BIGINT"),
        ("username", "STRING"),
        ("firstname", "STRING"),
        ("lastname", "STRING"),
        ("picture", "STRING"),
    ),
    keys=("id",),
    not_null=("username",),
)
SENDER_ACTIVITY = TableSpec(
    "sender_activity",
    (("user_id", "BIGINT"), ("transaction_date", "DATE"), ("send_freq", "BIGINT")),
    keys=("user_id", "transaction_date"),
    user_columns=("user_id",),
)
RECEIVER_ACTIVITY = TableSpec(
    "receiver_activity",
    (("user_id", "BIGINT"), ("transaction_date", "DATE"), ("recv_freq", "BIGINT")),
    keys=("user_id", "transaction_date"),
    user_columns=("user_id",),
)
PAIR_ACTIVITY = TableSpec(
    "pair_activity",
    (
        ("user1", "BIGINT"),
        ("user2", "BIGINT"),
        ("transaction_date", "DATE"),
        ("transaction_freq", "BIGINT"),
    ),
    keys=("user1", "user2", "transaction_date"),
    user_columns=("user1", "user2"),
)
NET_SPENDING = TableSpec(
    "net_spending",
    (("user_id", "BIGINT"), ("transaction_date", "DATE"), ("amount_cents", CENTS)),
    keys=("user_id", "transaction_date"),
    user_columns=("user_id",),
)

TABLES = {
    spec.name: spec
    for spec in (USERS, SENDER_ACTIVITY, RECEIVER_ACTIVITY, PAIR_ACTIVITY, NET_SPENDING)
}
