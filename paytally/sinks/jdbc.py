"""The same tables in a relational database, through Spark's JDBC source.

Rows go from the executors to the database; the driver sees none of them. A
``JdbcTarget`` stands in for a ``Warehouse`` in loads, merges and reports.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paytally.operators import new_keys_only
from paytally.schema import TABLES
from paytally.sinks.days import BatchDays

# Options that say how one table is read in parallel; another table has other columns.
BOUNDS = ("partitionColumn", "lowerBound", "upperBound")


@dataclass(frozen=True)
class JdbcTarget:
    """A database reached over JDBC.

    ``options`` are Spark's JDBC options for all tables: ``driver``, ``user``,
    ``password``. ``bounds`` are (column, lower, upper) of the tables that are too large
    for one connection; they are read over ``max_connections``.
    """

    spark: SparkSession
    url: str
    options: dict[str, str] = field(default_factory=dict)
    bounds: dict[str, tuple[str, str, str]] = field(default_factory=dict)
    max_connections: int = 32

    def __post_init__(self) -> None:
        shared = [key for key in BOUNDS if key in self.options]
        if shared:
            raise ValueError(f"give {shared} per table, as bounds")

    def _read(self, name: str, bounds: tuple[str, str, str] | None) -> DataFrame:
        reader = self.spark.read.format("jdbc").options(**self.options)
        if bounds:
            reader = reader.options(**dict(zip(BOUNDS, bounds, strict=True)))
            reader = reader.option("numPartitions", str(self.max_connections))
        return reader.option("url", self.url).option("dbtable", name).load()

    def read_table(self, table: str) -> DataFrame:
        """A result table. A day filter on it is pushed to the database."""
        return self._read(table, self.bounds.get(table)).select(*TABLES[table].column_names)

    def read_staged(self, staging: str, table: str) -> DataFrame:
        return self._read(staging, self.bounds.get(table)).select(*TABLES[table].column_names)

    def known_users(self, one_row_a_day: bool) -> DataFrame:
        """The users, to check ids against."""
        self.ensure_table("users")
        return self.read_table("users")

    def create_statement(self, table: str) -> str:
        """DDL with the key and what may not be null."""
        spec = TABLES[table]
        # A key cannot be of unlimited text; no key is text here.
        kinds = {"STRING": "TEXT"}
        columns = [
            f"{name} {kinds.get(kind, kind)}" + (" NOT NULL" if name in spec.required else "")
            for name, kind in spec.columns
        ]
        key = f"PRIMARY KEY ({', '.join(spec.keys)})"
        return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join([*columns, key])})"

    def _execute(self, statement: str) -> None:
        """Run a statement from the driver, over a connection of its own."""
        jvm = self.spark.sparkContext._jvm
        properties = jvm.java.util.Properties()
        for key, value in self.options.items():
            properties.setProperty(key, value)
        if "driver" in self.options:
            jvm.org.apache.spark.util.Utils.classForName(self.options["driver"], True, False)
        connection = jvm.java.sql.DriverManager.getConnection(self.url, properties)
        try:
            connection.createStatement().executeUpdate(statement)
        finally:
            connection.close()

    def ensure_table(self, table: str) -> None:
        """Create the table if the database lacks it."""
        self._execute(self.create_statement(table))

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        options = {"numPartitions": str(self.max_connections), **self.options}
        writer = df.write.format("jdbc").options(**options)
        writer.option("url", self.url).option("dbtable", table).mode(mode).save()

    def append(self, df: DataFrame, table: str) -> int:
        """Append rows and return how many; counted while they are written."""
        written = Observation()
        rows = df.select(*TABLES[table].column_names)
        self._write(rows.observe(written, F.count(F.lit(1)).alias("rows")), table, "append")
        return written.get["rows"]

    def add_new(self, rows: DataFrame, table: str, days: BatchDays | None) -> int:
        """Append the rows whose key is not stored yet; return how many."""
        stored = self.read_table(table)
        if days is not None:
            stored = stored.where(days.predicate())
        return self.append(new_keys_only(rows, stored, *TABLES[table].keys), table)

    def stage(self, df: DataFrame, table: str) -> str:
        """Overwrite the staging table of ``table`` with ``df``; return its name."""
        staging = f"{table}_temp"
        self._write(df.select(*TABLES[table].column_names), staging, "overwrite")
        return staging
