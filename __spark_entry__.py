"""

Each query runs over the whole of the tables it reads. ``events`` plays the
payments (see ``paytally.sources.sample``); where a job starts from JSON lines,
Spark derives them from ``events``, with a different defect per event type.
"""

from __future__ import annotations

import importlib
import importlib.util
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paytally.functions import valid
from paytally.operators import (
    canonical_pairs,
    keep_known_users,
    net_spending,
    pair_activity,
    receiver_activity,
    receiver_keys,
    sender_activity,
    sender_keys,
    signed_legs,
    user_day_totals,
    user_mentions,
    users_dim,
)
from paytally.plans import (
    report,
    run_period,
    top_pair_ids,
    top_pairs,
    top_receivers,
    top_senders,
    top_spenders,
)
from paytally.schema import CENTS
from paytally.session import drop_path, scratch_path
from paytally.sinks import Warehouse, insert_ignore, merge_staged, stage
from paytally.sources import landing_path, parse_payments, period_path, scan_payments
from paytally.sources.sample import (
    payments_from_events,
    raw_lines,
    users_from_customers,
    users_from_suppliers,
    write_period_files,
)
from paytally.streaming import ingest_available


def _optional(name: str):
    """The module, or None in a copy from which it was left out; its errors are raised."""
    try:
        found = importlib.util.find_spec(name)
    except ModuleNotFoundError:
        found = None
    return importlib.import_module(name) if found else None


llm_queries = _optional("paytally.llm.queries")
corpus_pipeline = _optional("corpus_pipeline") if llm_queries else None

DAY = "2024-01-05"
TOP_N = 10
# The period of the scan over raw files.
YEAR = 2024
# A user who is gone by the time of the stored reports.
REMOVED_USER = 3
# The second of two arrivals starts on this day.
SECOND_ARRIVAL = "2024-01-16"
# Event types of the first of two loads of the same days.
FIRST_LOAD = ("click", "purchase")


# --- queries ---------------------------------------------------------------


def _warehouse(spark: SparkSession) -> Warehouse:
    """An empty warehouse of its own below the shared folder."""
    return Warehouse(spark, scratch_path(spark, "warehouse"), f"paytally_{uuid.uuid4().hex}")


class _StoredFiles:
    """The tables of a warehouse by path, for ``report``; one user has been removed.

    By path, so that the scratch database can be dropped.
    """

    def __init__(self, warehouse: Warehouse) -> None:
        self.warehouse = warehouse
        self.read_best = warehouse.read_best

    def read_table(self, table: str) -> DataFrame:
        rows = self.warehouse.snapshot(table)
        return rows.where(F.col("id") != REMOVED_USER) if table == "users" else rows


def _all_metrics(warehouse: Warehouse) -> DataFrame:
    """The four stored metric tables below each other."""

    def rows(table: str, user1: str, user2, measure: str) -> DataFrame:
        return warehouse.snapshot(table).select(
            F.lit(table).alias("metric"),
            F.col(user1).alias("user1"),
            user2.cast("bigint").alias("user2"),
            "transaction_date",
            F.col(measure).cast(CENTS).alias("measure"),
        )

    return (
        rows("sender_activity", "user_id", F.lit(None), "send_freq")
        .unionByName(rows("receiver_activity", "user_id", F.lit(None), "recv_freq"))
        .unionByName(rows("net_spending", "user_id", F.lit(None), "amount_cents"))
        .unionByName(rows("pair_activity", "user1", F.col("user2"), "transaction_freq"))
    )


def _drop_database(warehouse: Warehouse) -> None:
    """Forget the scratch tables; they are external, so their files stay."""
    warehouse.spark.sql(f"DROP DATABASE IF EXISTS `{warehouse.database}` CASCADE")


def _period_files(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_path(spark, "raw")
    write_period_files(raw_lines(spark, sf_dir), root)
    return root


def _loaded(spark: SparkSession, sf_dir: str) -> tuple[Warehouse, dict[str, int]]:
    warehouse = _warehouse(spark)
    root = _period_files(spark, sf_dir)
    written = run_period(spark, root, warehouse)  # every day that there is
    drop_path(spark, root)
    return warehouse, written


def q_parse_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_payments(raw_lines(spark, sf_dir))
    return parsed.select(
        "payment_id",
        "created_time",
        "sender_id",
        "receiver_id",
        "transaction_date",
        "amount_cents",
        F.col("sender.username").alias("sender_username"),
        F.col("sender.lastname").alias("sender_lastname"),
        F.col("receiver.username").alias("receiver_username"),
        F.col("receiver.picture").alias("receiver_picture"),
    )


def q_valid_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parse_payments(raw_lines(spark, sf_dir))
    return valid(parsed, "sender_id", "receiver_id", "transaction_date").select(
        "payment_id", "sender_id", "receiver_id", "transaction_date", "amount_cents"
    )


def q_scan_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _period_files(spark, sf_dir)
    return scan_payments(spark, period_path(root, YEAR)).select(
        "payment_id", "sender_id", "receiver_id", "transaction_date", "amount_cents"
    )


def q_user_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_mentions(parse_payments(raw_lines(spark, sf_dir)))


def q_users_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_dim(user_mentions(parse_payments(raw_lines(spark, sf_dir))))


def _on_payments(job: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return job(payments_from_events(spark, sf_dir))

    return query


def _top(build: Callable, metric: Callable, users: Callable):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        activity = metric(payments_from_events(spark, sf_dir))
        return build(activity, users(spark, sf_dir), DAY, TOP_N)

    return query


def q_top_pair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_pair_ids(pair_activity(payments_from_events(spark, sf_dir)), DAY, TOP_N)


def q_fk_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = pair_activity(payments_from_events(spark, sf_dir))
    return keep_known_users(pairs, users_from_suppliers(spark, sf_dir), "user1", "user2")


def q_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the same days; the first holds only some of the payments."""
    warehouse = _warehouse(spark)
    insert_ignore(users_from_suppliers(spark, sf_dir), warehouse, "users")
    payments = payments_from_events(spark, sf_dir)
    first = payments.where(F.col("sender.firstname").isin(*FIRST_LOAD))
    insert_ignore(pair_activity(first), warehouse, "pair_activity", unique=True)
    insert_ignore(pair_activity(payments), warehouse, "pair_activity", unique=True)
    _drop_database(warehouse)
    return warehouse.snapshot("pair_activity")


def q_staged_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers are users already; customers come in through the staging table.

    With each customer comes a row without an id and one of a new id without a name,
    neither of which may be stored.
    """
    warehouse = _warehouse(spark)
    insert_ignore(users_from_suppliers(spark, sf_dir), warehouse, "users")
    customers = users_from_customers(spark, sf_dir)
    without_id = customers.withColumn("id", F.lit(None).cast("bigint"))
    without_name = customers.withColumn("id", -F.col("id") - 1)
    without_name = without_name.withColumn("username", F.lit(None).cast("string"))
    staging = stage(customers.union(without_id).union(without_name), warehouse, "users")
    merge_staged(warehouse, staging, "users")
    _drop_database(warehouse)
    return warehouse.snapshot("users")


def q_run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, written = _loaded(spark, sf_dir)
    _drop_database(warehouse)
    drop_path(spark, warehouse.location)
    return spark.createDataFrame(sorted(written.items()), "table_name string, rows_written bigint")


def q_run_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, _ = _loaded(spark, sf_dir)
    _drop_database(warehouse)
    return _all_metrics(warehouse)


def q_stored_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, _ = _loaded(spark, sf_dir)
    _drop_database(warehouse)
    tables = _StoredFiles(warehouse)

    def rows(metric: str, name, other, measure: str) -> DataFrame:
        return report(tables, metric, DAY, TOP_N).select(
            F.lit(metric).alias("report"),
            name.alias("name"),
            other.cast("string").alias("other"),
            F.col(measure).cast("decimal(38,2)").alias("measure"),
        )

    name, nobody = F.col("name"), F.lit(None)
    return (
        rows("active_senders", name, nobody, "send_freq")
        .unionByName(rows("active_receivers", name, nobody, "recv_freq"))
        .unionByName(rows("active_pairs", F.col("user1"), F.col("user2"), "transaction_freq"))
        .unionByName(rows("active_spenders", name, nobody, "amount"))
    )


def q_incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals in a landing folder, each followed by a run of the stream."""
    warehouse = _warehouse(spark)
    root = scratch_path(spark, "landing")
    landing = f"{root}/unprocessed"
    archive = scratch_path(spark, "archive")
    checkpoint = scratch_path(spark, "stream")
    lines = raw_lines(spark, sf_dir)
    second = F.col("day") >= F.lit(SECOND_ARRIVAL).cast("date")
    for number, arrival in enumerate((lines.where(~second), lines.where(second)), start=1):
        arrival.select("value").write.text(landing_path(root, YEAR, 1, number))
        ingest_available(spark, landing, archive, checkpoint, warehouse)
    _drop_database(warehouse)
    for path in (root, archive, checkpoint):
        drop_path(spark, path)
    return _all_metrics(warehouse)


def entry(spark: SparkSession) -> DataFrame:
    """Who sent most often on one day: ranked activity joined to the users."""
    query = _top(top_senders, sender_activity, users_from_customers)
    return query(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    return {
        "parse_payments": q_parse_payments,
        "valid_payments": q_valid_payments,
        "scan_period": q_scan_period,
        "sender_keys": _on_payments(sender_keys),
        "receiver_keys": _on_payments(receiver_keys),
        "canonical_pairs": _on_payments(canonical_pairs),
        "signed_legs": _on_payments(signed_legs),
        "user_mentions": q_user_mentions,
        "sender_activity": _on_payments(sender_activity),
        "receiver_activity": _on_payments(receiver_activity),
        "pair_activity": _on_payments(pair_activity),
        "net_spending": _on_payments(net_spending),
        "user_day_totals": _on_payments(user_day_totals),
        "users_dim": q_users_dim,
        "fk_filter": q_fk_filter,
        "insert_ignore": q_insert_ignore,
        "staged_merge": q_staged_merge,
        "run_metrics": q_run_metrics,
        "run_period": q_run_period,
        "stored_report": q_stored_report,
        "top_senders": _top(top_senders, sender_activity, users_from_customers),
        "top_receivers": _top(top_receivers, receiver_activity, users_from_customers),
        "top_pairs": _top(top_pairs, pair_activity, users_from_customers),
        "top_spenders": _top(top_spenders, net_spending, users_from_customers),
        "top_senders_some_unknown": _top(top_senders, sender_activity, users_from_suppliers),
        "top_receivers_some_unknown": _top(top_receivers, receiver_activity, users_from_suppliers),
        "top_pairs_some_unknown": _top(top_pairs, pair_activity, users_from_suppliers),
        "top_spenders_some_unknown": _top(top_spenders, net_spending, users_from_suppliers),
        "top_pair_ids": q_top_pair_ids,
        "incremental_ingest": q_incremental_ingest,
        **(llm_queries.queries() if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


# --- SQL twins -------------------------------------------------------------

# Payments straight from events.
PAY = """
pay AS (
  SELECT event_id AS payment_id, ts, event_type, user_id AS sender_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS receiver_id,
         CAST(ts AS DATE) AS transaction_date,
         CAST(round(value * 100) AS BIGINT) AS amount_cents
  FROM events
)"""

# Payments as they come out of the JSON lines: error lines are cut off, signups
# have no receiver, purchases lack a name and so mention no users.
PARSED = """
parsed AS (
  SELECT event_id AS payment_id, event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
           || CASE WHEN event_type = 'purchase' THEN '-05:00' ELSE 'Z' END AS created_time,
         user_id AS sender_id,
         CASE WHEN event_type <> 'signup'
              THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS receiver_id,
         CAST(ts AS DATE) AS transaction_date,
         CAST(round(value * 100) AS BIGINT) AS amount_cents
  FROM events WHERE event_type <> 'error'
),
mentions AS (
  SELECT created_time, payment_id, CAST(role AS INTEGER) AS role, id,
         'user' || id AS username, event_type AS firstname,
         CAST(id AS VARCHAR) AS lastname, event_type || '/' || payment_id AS picture,
         transaction_date
  FROM (
    SELECT *, 0 AS role, sender_id AS id FROM parsed
    UNION ALL
    SELECT *, 1 AS role, receiver_id AS id FROM parsed
  ) WHERE event_type IN ('click', 'view')
),
dim AS (
  SELECT id, username, firstname, lastname, picture FROM mentions
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_time, payment_id, role) = 1
)"""

SENDERS = """
  SELECT sender_id AS user_id, transaction_date, CAST(count(*) AS BIGINT) AS send_freq
  FROM {pay} GROUP BY sender_id, transaction_date"""
RECEIVERS = """
  SELECT receiver_id AS user_id, transaction_date, CAST(count(*) AS BIGINT) AS recv_freq
  FROM {pay} WHERE receiver_id IS NOT NULL GROUP BY receiver_id, transaction_date"""
PAIRS = """
  SELECT least(sender_id, receiver_id) AS user1, greatest(sender_id, receiver_id) AS user2,
         transaction_date, CAST(count(*) AS BIGINT) AS transaction_freq
  FROM {pay} WHERE receiver_id IS NOT NULL GROUP BY 1, 2, 3"""
LEGS = """
  SELECT sender_id AS user_id, transaction_date,
         CAST(amount_cents AS DECIMAL(38,0)) AS amount_cents
  FROM {pay} WHERE receiver_id IS NOT NULL
  UNION ALL
  SELECT receiver_id, transaction_date, -CAST(amount_cents AS DECIMAL(38,0))
  FROM {pay} WHERE receiver_id IS NOT NULL"""
NET = (
    """
  SELECT user_id, transaction_date, CAST(sum(amount_cents) AS DECIMAL(38,0)) AS amount_cents
  FROM ("""
    + LEGS
    + """) GROUP BY user_id, transaction_date"""
)

CUSTOMERS = """
  SELECT c_custkey AS id, c_name AS username, split_part(c_name, '#', 1) AS firstname,
         split_part(c_name, '#', 2) AS lastname, c_mktsegment AS picture FROM customer"""
SUPPLIERS = """
  SELECT s_suppkey AS id, s_name AS username, split_part(s_name, '#', 1) AS firstname,
         split_part(s_name, '#', 2) AS lastname, s_name AS picture FROM supplier"""

# The four metrics below each other, for known users ``u`` of a load.
ALL_METRICS = """
  SELECT 'sender_activity' AS metric, user_id AS user1, CAST(NULL AS BIGINT) AS user2,
         transaction_date, CAST(send_freq AS DECIMAL(38,0)) AS measure
  FROM s WHERE user_id IN (SELECT id FROM {u})
  UNION ALL
  SELECT 'receiver_activity', user_id, NULL, transaction_date,
         CAST(recv_freq AS DECIMAL(38,0))
  FROM r WHERE user_id IN (SELECT id FROM {u})
  UNION ALL
  SELECT 'net_spending', user_id, NULL, transaction_date, amount_cents
  FROM n WHERE user_id IN (SELECT id FROM {u})
  UNION ALL
  SELECT 'pair_activity', user1, user2, transaction_date,
         CAST(transaction_freq AS DECIMAL(38,0))
  FROM p WHERE user1 IN (SELECT id FROM {u}) AND user2 IN (SELECT id FROM {u})"""


def _metrics_of(pay: str) -> str:
    return (
        f"s AS ({SENDERS.format(pay=pay)}), r AS ({RECEIVERS.format(pay=pay)}), "
        f"n AS ({NET.format(pay=pay)}), p AS ({PAIRS.format(pay=pay)})"
    )


def _top_users_sql(metric: str, measure: str, shown: str, users: str) -> str:
    return f"""
WITH {PAY}, m AS ({metric.format(pay="pay")}), u AS ({users})
SELECT u.firstname || ' ' || u.lastname AS name, u.picture AS image, {shown}
FROM m JOIN u ON m.user_id = u.id
WHERE transaction_date = DATE '{DAY}'
ORDER BY m.{measure} DESC, m.user_id LIMIT {TOP_N}"""


def _top_pairs_sql(with_clause: str, users: str) -> str:
    return f"""
WITH {with_clause}
SELECT u1.firstname || ' ' || u1.lastname AS user1, u1.picture AS user1_img,
       u2.firstname || ' ' || u2.lastname AS user2, u2.picture AS user2_img,
       m.transaction_freq
FROM m JOIN {users} u1 ON u1.id = m.user1 JOIN {users} u2 ON u2.id = m.user2
WHERE m.transaction_date = DATE '{DAY}'
ORDER BY m.transaction_freq DESC, m.user1, m.user2 LIMIT {TOP_N}"""


def _stored_report_sql() -> str:
    """The four reports below each other, without the user who has been removed."""

    def ranked(metric: str, name: str, source: str, measure: str) -> str:
        return f"""(
SELECT '{metric}' AS report, {name} AS name, CAST(NULL AS VARCHAR) AS other,
       {measure} AS measure
FROM {source} m JOIN left_users u ON u.id = m.user_id
WHERE transaction_date = DATE '{DAY}' ORDER BY {measure} DESC, m.user_id LIMIT {TOP_N})"""

    full = "{0}.firstname || ' ' || {0}.lastname"
    units = "CAST(m.amount_cents / 100.0 AS DECIMAL(38,2))"
    return f"""
WITH {PARSED}, {_metrics_of("parsed")},
left_users AS (SELECT * FROM dim WHERE id <> {REMOVED_USER})
{ranked("active_senders", full.format("u"), "s", "CAST(m.send_freq AS DECIMAL(38,2))")}
UNION ALL
{ranked("active_receivers", full.format("u"), "r", "CAST(m.recv_freq AS DECIMAL(38,2))")}
UNION ALL
{ranked("active_spenders", full.format("u"), "n", units)}
UNION ALL (
SELECT 'active_pairs', {full.format("a")}, {full.format("b")},
       CAST(m.transaction_freq AS DECIMAL(38,2))
FROM p m JOIN left_users a ON a.id = m.user1 JOIN left_users b ON b.id = m.user2
WHERE m.transaction_date = DATE '{DAY}'
ORDER BY m.transaction_freq DESC, m.user1, m.user2 LIMIT {TOP_N})"""


def _reports_sql(users: str) -> dict[str, str]:
    amount = "CAST(m.amount_cents / 100.0 AS DECIMAL(38,2)) AS amount"
    pairs = f"{PAY}, m AS ({PAIRS.format(pay='pay')}), u AS ({users})"
    return {
        "top_senders": _top_users_sql(SENDERS, "send_freq", "m.send_freq", users),
        "top_receivers": _top_users_sql(RECEIVERS, "recv_freq", "m.recv_freq", users),
        "top_pairs": _top_pairs_sql(pairs, "u"),
        "top_spenders": _top_users_sql(NET, "amount_cents", amount, users),
    }


def oracle_sql() -> dict[str, str]:
    """The same results as SQL over the same tables."""
    first_types = ", ".join(f"'{t}'" for t in FIRST_LOAD)
    known = "(SELECT s_suppkey FROM supplier)"
    parsed_columns = "payment_id, sender_id, receiver_id, transaction_date, amount_cents"
    day1 = f"transaction_date < DATE '{SECOND_ARRIVAL}'"
    some_unknown = {f"{k}_some_unknown": v for k, v in _reports_sql(SUPPLIERS).items()}
    return {
        "parse_payments": f"""
WITH {PARSED}
SELECT payment_id, created_time, sender_id, receiver_id, transaction_date, amount_cents,
       CASE WHEN event_type <> 'purchase' THEN 'user' || sender_id END AS sender_username,
       CASE WHEN event_type <> 'purchase' THEN CAST(sender_id AS VARCHAR) END AS sender_lastname,
       'user' || receiver_id AS receiver_username,
       CASE WHEN receiver_id IS NOT NULL THEN event_type || '/' || payment_id END
         AS receiver_picture
FROM parsed""",
        "valid_payments": f"WITH {PARSED} SELECT {parsed_columns} FROM parsed "
        "WHERE receiver_id IS NOT NULL",
        "scan_period": f"WITH {PARSED} SELECT {parsed_columns} FROM parsed "
        f"WHERE year(transaction_date) = {YEAR}",
        "sender_keys": f"WITH {PAY} SELECT sender_id AS user_id, transaction_date FROM pay",
        "receiver_keys": f"WITH {PAY} SELECT receiver_id AS user_id, transaction_date FROM pay",
        "canonical_pairs": f"""
WITH {PAY}
SELECT least(sender_id, receiver_id) AS user1, greatest(sender_id, receiver_id) AS user2,
       transaction_date FROM pay""",
        "signed_legs": f"WITH {PAY} {LEGS.format(pay='pay')}",
        "user_mentions": f"WITH {PARSED} SELECT * EXCLUDE (transaction_date) FROM mentions",
        "sender_activity": f"WITH {PAY} {SENDERS.format(pay='pay')}",
        "receiver_activity": f"WITH {PAY} {RECEIVERS.format(pay='pay')}",
        "pair_activity": f"WITH {PAY} {PAIRS.format(pay='pay')}",
        "net_spending": f"WITH {PAY} {NET.format(pay='pay')}",
        "user_day_totals": f"""
WITH {PAY}, {_metrics_of("pay")}
SELECT user_id, transaction_date, coalesce(send_freq, 0) AS send_freq,
       coalesce(recv_freq, 0) AS recv_freq, amount_cents
FROM s FULL JOIN r USING (user_id, transaction_date)
       FULL JOIN n USING (user_id, transaction_date)""",
        "users_dim": f"WITH {PARSED} SELECT * FROM dim",
        "fk_filter": f"""
WITH {PAY}, m AS ({PAIRS.format(pay="pay")})
SELECT * FROM m WHERE user1 IN {known} AND user2 IN {known}""",
        "insert_ignore": f"""
WITH {PAY}, part_pay AS (SELECT * FROM pay WHERE event_type IN ({first_types})),
first_load AS ({PAIRS.format(pay="part_pay")}), second_load AS ({PAIRS.format(pay="pay")}),
merged AS (
  SELECT * FROM first_load
  UNION ALL
  SELECT * FROM second_load b WHERE NOT EXISTS (
    SELECT 1 FROM first_load a WHERE a.user1 = b.user1 AND a.user2 = b.user2
      AND a.transaction_date = b.transaction_date)
)
SELECT * FROM merged WHERE user1 IN {known} AND user2 IN {known}""",
        "staged_merge": f"""
WITH c AS ({CUSTOMERS}), s AS ({SUPPLIERS})
SELECT * FROM s UNION ALL SELECT * FROM c WHERE id NOT IN (SELECT id FROM s)""",
        "run_metrics": f"""
WITH {PARSED}, {_metrics_of("parsed")}, loaded AS ({ALL_METRICS.format(u="dim")})
SELECT metric AS table_name, CAST(count(*) AS BIGINT) AS rows_written FROM loaded GROUP BY 1
UNION ALL SELECT 'users', CAST(count(*) AS BIGINT) FROM dim""",
        "run_period": f"WITH {PARSED}, {_metrics_of('parsed')} {ALL_METRICS.format(u='dim')}",
        "stored_report": _stored_report_sql(),
        **_reports_sql(CUSTOMERS),
        **some_unknown,
        "top_pair_ids": f"""
WITH {PAY}, m AS ({PAIRS.format(pay="pay")})
SELECT user1, user2, transaction_freq FROM m WHERE transaction_date = DATE '{DAY}'
ORDER BY transaction_freq DESC, user1, user2 LIMIT {TOP_N}""",
        # Users of the first arrival are known to both, those of the second only to it.
        "incremental_ingest": f"""
WITH {PARSED}, {_metrics_of("parsed")},
early AS (SELECT DISTINCT id FROM mentions WHERE {day1})
SELECT * FROM ({ALL_METRICS.format(u="early")}) WHERE {day1}
UNION ALL
SELECT * FROM ({ALL_METRICS.format(u="dim")}) WHERE NOT ({day1})""",
        **(llm_queries.oracle_sql() if llm_queries else {}),
        **_pipeline_sql(),
    }


def _pipeline_sql() -> dict[str, str]:
    sql = corpus_pipeline.ORACLE_SQL if corpus_pipeline else None
    return {"pipeline": sql} if sql else {}
