"""JSON-lines payment records to the parsed payments frame."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paytally.functions import calendar_date, integer_id
from paytally.schema import PROFILE_FIELDS, RAW_RECORDS, RAW_TRANSACTION

# Strict JSON: Spark would by default accept single-quoted strings. Its limits on the
# length of texts and numbers and on nesting would make a whole record vanish.
NO_LIMIT = str(2**31 - 1)
JSON_OPTIONS = {
    "allowSingleQuotes": "false",
    "maxStringLen": NO_LIMIT,
    "maxNumLen": NO_LIMIT,
    "maxNestingDepth": NO_LIMIT,
}


def scan_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text lines of a file, folder or glob.

    Looks into subfolders, since a day's file may be a folder of part files.
    """
    return spark.read.option("recursiveFileLookup", "true").text(path)


def scan_payments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parsed payments of a file, folder or glob of JSON lines."""
    return parse_payments(scan_lines(spark, path))


def _profile(party: Column) -> Column:
    """The party's profile, or NULL unless all of its keys are there."""
    complete = reduce(and_, [F.map_contains_key(party, key) for key in PROFILE_FIELDS])
    fields = [F.try_element_at(party, F.lit(key)).alias(key) for key in PROFILE_FIELDS]
    return F.when(complete, F.struct(*fields))


def parse_payments(lines: DataFrame) -> DataFrame:
    """One payments row per line that holds one JSON object.

    Fields that are missing or broken are NULL, so that each metric can drop what
    it cannot use (``functions.valid``). Lines that are no single JSON object drop
    out here: wrapped in brackets, text after the object breaks the parse, and a
    second object makes the array longer than one.

    The explode keeps later filters above it, so a line is decoded only once.
    """
    wrapped = F.concat(F.lit("["), F.col("value"), F.lit("]"))
    decoded = lines.select(F.from_json(wrapped, RAW_RECORDS, JSON_OPTIONS).alias("records"))
    single = F.when(F.size("records") == 1, F.col("records"))
    record = decoded.select(F.explode(single).alias("record")).where("record IS NOT NULL")

    first = F.get(F.col("record.transactions"), F.lit(0))
    transaction = F.from_json(first, RAW_TRANSACTION, JSON_OPTIONS)
    actor, target = F.col("record.actor"), F.col("target")
    return record.select("record", transaction.getField("target").alias("target")).select(
        F.col("record.payment_id").try_cast("bigint").alias("payment_id"),
        F.col("record.created_time").alias("created_time"),
        integer_id(F.try_element_at(actor, F.lit("id"))).alias("sender_id"),
        integer_id(F.try_element_at(target, F.lit("id"))).alias("receiver_id"),
        calendar_date(F.col("record.created_time")).alias("transaction_date"),
        F.col("record.amount_cents").try_cast("bigint").alias("amount_cents"),
        _profile(actor).alias("sender"),
        _profile(target).alias("receiver"),
    )
