"""The state, the change log and the run table as named tables, by SQL with parameters, session variables and identifiers.

Names are given as catalog.schema.table and checked; they go into statements as IDENTIFIER(:name), never as text, and values
as parameters or session variables.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from shelfwise.sources.schemas import INDEX_RUNS, VARIANT, VARIANT_CHANGES, VARIANT_STATE

_PART = re.compile(r"[A-Za-z0-9_\-]+")


def table_name(name: str) -> str:
    """name, if it has three parts of letters, digits, _ and -; each part is quoted."""
    parts = name.strip().split(".")
    if len(parts) != 3 or not all(_PART.fullmatch(p) for p in parts):
        raise ValueError(f"{name!r} is no catalog.schema.table")
    return ".".join(f"`{p}`" for p in parts)


def beside(name: str, table: str) -> str:
    """Another table of the same schema: that of runs beside the log, say."""
    return ".".join([*table_name(name).replace("`", "").split(".")[:2], table])


@dataclass(frozen=True)
class NamedTables:
    """The tables of one schema that a run works on."""

    state: str
    log: str
    runs: str
    buckets: int = 64

    @classmethod
    def beside(cls, log: str, buckets: int = 64) -> NamedTables:
        """The tables that go with a change log."""
        return cls(beside(log, "VariantState"), log, beside(log, "IndexerRuns"), buckets)

    def create(self, spark: SparkSession) -> None:
        """Makes those that are missing; the state is bucketed by id, the log partitioned by batch."""
        args = {"state": table_name(self.state), "log": table_name(self.log), "runs": table_name(self.runs)}
        spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:state) ({VARIANT_STATE}) USING parquet CLUSTERED BY (id) SORTED BY (id) INTO {int(self.buckets)} BUCKETS", args=args)
        spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:log) ({VARIANT_CHANGES}) USING parquet PARTITIONED BY (batch_run_id)", args=args)
        spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:runs) ({INDEX_RUNS}) USING parquet", args=args)
        for name, schema in ((self.state, VARIANT_STATE), (self.runs, INDEX_RUNS)):
            add_missing(spark, name, schema)


def add_missing(spark: SparkSession, name: str, schema: str) -> list[str]:
    """Adds the columns of schema that a table of an earlier release lacks; its rows have null there."""
    known = {c.lower() for c in spark.table(table_name(name)).columns}
    missing = [f for f in StructType.fromDDL(schema) if f.name.lower() not in known]
    if missing:
        spark.sql(f"ALTER TABLE IDENTIFIER(:t) ADD COLUMNS ({', '.join(f'{f.name} {f.dataType.simpleString()}' for f in missing)})", args={"t": table_name(name)})
    return [f.name for f in missing]


_COLUMNS = ", ".join(VARIANT[1:])


def append_changes(spark: SparkSession, tables: NamedTables, snapshot: str, batch_run_id: str, batch_run_ts: str) -> None:
    """Compares a view of hashed variants with the state and appends UPSERT and DELETE rows to the log.

    The batch is held in session variables, as a script would declare them. A batch that the log has is refused.
    """
    args = {"state": table_name(tables.state), "log": table_name(tables.log), "snapshot": snapshot}
    spark.sql("DECLARE OR REPLACE VARIABLE run_id STRING")
    spark.sql("DECLARE OR REPLACE VARIABLE run_ts TIMESTAMP")
    spark.sql("SET VAR (run_id, run_ts) = (SELECT :id, CAST(:ts AS TIMESTAMP))", args={"id": batch_run_id, "ts": batch_run_ts})
    if spark.sql("SELECT 1 FROM IDENTIFIER(:log) WHERE batch_run_id = session.run_id LIMIT 1", args=args).first():
        raise ValueError(f"the log has batch {batch_run_id}")
    changes = f"""
        SELECT session.run_ts AS batch_run_ts, operation, id, {_COLUMNS}, row_hash, current_timestamp() AS change_ts FROM (
          SELECT CASE WHEN n.id IS NULL THEN 'DELETE' WHEN o.id IS NULL OR n.row_hash <> o.row_hash THEN 'UPSERT' END AS operation,
            coalesce(n.id, o.id) AS id, {', '.join(f'n.{c}' for c in VARIANT[1:])}, n.row_hash
          FROM (SELECT * FROM IDENTIFIER(:snapshot) WHERE trim(id) <> '') n
          FULL OUTER JOIN (SELECT id, row_hash FROM IDENTIFIER(:state) WHERE trim(id) <> '') o ON n.id = o.id
        ) WHERE operation IS NOT NULL"""
    spark.sql(f"INSERT INTO IDENTIFIER(:log) PARTITION (batch_run_id) (batch_run_ts, operation, id, {_COLUMNS}, row_hash, change_ts, batch_run_id) SELECT *, session.run_id FROM ({changes})", args=args)


def replace_state(spark: SparkSession, tables: NamedTables, snapshot: str, seen_at: str) -> None:
    """The state becomes the view's variants, each seen now."""
    spark.sql(
        f"INSERT OVERWRITE IDENTIFIER(:state) SELECT {', '.join(VARIANT)}, row_hash, CAST(:seen AS TIMESTAMP) FROM IDENTIFIER(:snapshot) DISTRIBUTE BY id",
        args={"state": table_name(tables.state), "snapshot": snapshot, "seen": seen_at},
    )


def newest_batch(spark: SparkSession, log: str) -> str | None:
    """The id of the log's newest batch; None for an empty log."""
    found = spark.sql("SELECT batch_run_id FROM IDENTIFIER(:log) ORDER BY batch_run_ts DESC NULLS LAST, batch_run_id DESC LIMIT 1", args={"log": table_name(log)}).first()
    return found and found[0]


LATEST = """
    SELECT * EXCEPT (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY change_ts DESC, operation DESC) AS rn FROM IDENTIFIER(:log) WHERE batch_run_id = :batch
    ) WHERE rn = 1"""


def latest_changes(spark: SparkSession, log: str, batch: str, ordered: bool = False) -> DataFrame:
    """The last change of each id of a batch; in order of id, if asked for. log: a three-part name, or a view of the session."""
    name = table_name(log) if "." in log else log
    return spark.sql(LATEST + (" ORDER BY id" if ordered else ""), args={"log": name, "batch": batch})
