"""Incremental ingest by high-water mark.

A batch copies the rows changed in ``(from, to]``. The upper bound is fixed
before the copy, so a row written meanwhile belongs to the next batch. The
watermark moves only by successful log rows, which are written after the copy.

Instants come to the driver as UTC, whatever the time zones of the machine and the session;
one without a time zone is taken as UTC.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F

from parcelflow.model import WATERMARK_START
from parcelflow.sources.layers import batch_folder, read_history, replace_batch

LOG_SCHEMA = (
    "batch_id string, table_name string, watermark_from timestamp, watermark_to timestamp, "
    "records bigint, bytes bigint, seconds double, status string, logged_at timestamp, ingested_at timestamp"
)
#: A committed batch: its log rows, the watermark that each leaves behind, and the batch's place in the order of batches.
#: ``from_start``: the copy had no lower bound. ``ingested_on``: the day whose folder holds the rows.
COMMIT_SCHEMA = LOG_SCHEMA + ", from_start boolean, ingested_on string, watermark timestamp, sequence bigint"
CONTROL_SCHEMA = "table_name string, watermark timestamp, last_batch_id string, updated_at timestamp"


EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
FIRST_INSTANT = datetime.fromisoformat(WATERMARK_START).replace(tzinfo=timezone.utc)


class BatchOrder(RuntimeError):
    """Another batch was committed while this one was being copied."""


def as_utc(value: datetime) -> datetime:
    return value.replace(tzinfo=timezone.utc) if value.tzinfo is None else value.astimezone(timezone.utc)


def _instant(value: datetime | str) -> Column:
    return F.lit(as_utc(value) if isinstance(value, datetime) else value).cast("timestamp")


def collect_utc(rows: DataFrame) -> list[Row]:
    """A few rows on the driver, their instants in UTC."""
    instants = [name for name, kind in rows.dtypes if kind == "timestamp"]
    found = rows.withColumns({c: F.unix_micros(c) for c in instants}).collect() if instants else rows.collect()

    def instant(micros: int | None) -> datetime | None:
        return None if micros is None else EPOCH + timedelta(microseconds=micros)

    return [Row(**{c: instant(v) if c in instants else v for c, v in r.asDict().items()}) for r in found]


def upper_watermark(source: DataFrame, changed: str = "updated_at") -> DataFrame:
    """One row ``watermark_to``: the newest change there is."""
    return source.agg(F.max(changed).cast("timestamp").alias("watermark_to"))


def extract(
    source: DataFrame,
    lower: datetime | str | None,
    upper: datetime | str,
    changed: str = "updated_at",
    full_reload: bool = False,
) -> DataFrame:
    """Rows changed after ``lower`` up to and including ``upper``; the filter reaches the source's scan.

    The bounds take the type of the column, so that the column itself stays bare. A first copy (``lower`` is
    None) and a full reload have no lower bound and also take the rows without a time of change, which
    no later increment can see.
    """
    kind = dict(source.dtypes)[changed]
    until = F.col(changed) <= _instant(upper).cast(kind)
    if full_reload or lower is None:
        return source.filter(until | F.col(changed).isNull())
    return source.filter((F.col(changed) > _instant(lower).cast(kind)) & until)


def stamp(rows: DataFrame, batch_id: str, source_system: str, instant: datetime | str) -> DataFrame:
    return rows.withColumns(
        {"_ingest_ts": _instant(instant), "_source_system": F.lit(source_system), "_batch_id": F.lit(batch_id)}
    )


def raw_folder(root: str, table: str, batch_id: str, day: str) -> str:
    """Where the rows of a batch lie; the day as yyyy-mm-dd."""
    year, month, day_of_month = day.split("-")
    return batch_folder(f"{root}/{table}/year={year}/month={month}/day={day_of_month}", batch_id)


def append_raw(rows: DataFrame, root: str, table: str, batch_id: str, instant: datetime) -> tuple[int, int]:
    """Add stamped rows to ``table/year=/month=/day=`` of the ingest date; returns (rows, bytes) written.

    The batch has a folder of its own below the day (in UTC), so repeating it with the same instant adds nothing.
    """
    folder = raw_folder(root, table, batch_id, f"{as_utc(instant):%Y-%m-%d}")
    seen = Observation()
    rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("compression", "snappy").parquet(folder)
    return seen.get["n"], written_bytes(rows.sparkSession, folder)


def written_bytes(spark: SparkSession, folder: str) -> int:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    # only the length column: the files are listed, not read
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("b")).first()["b"]


def log_rows(spark: SparkSession, rows: list[dict[str, object]], schema: str = LOG_SCHEMA) -> DataFrame:
    """Ingest-log rows, one per table of a batch."""
    names = [part.split()[0] for part in schema.split(", ")]
    return spark.createDataFrame([tuple(row[n] for n in names) for row in rows], schema)


def read_log(spark: SparkSession, path: str) -> DataFrame | None:
    """The committed batches; None before the first one."""
    try:
        return read_history(spark, path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def last_sequence(log: DataFrame | None) -> int:
    """The place of the newest committed batch; 0 before the first one."""
    return 0 if log is None else log.agg(F.max("sequence").alias("n")).first()["n"] or 0


def commit(spark: SparkSession, path: str, batch_id: str, rows: list[dict[str, object]], seen: int) -> DataFrame:
    """Log rows and watermarks of a batch in one file: either all of them count or none.

    ``seen`` is the newest sequence that the run had read; a batch committed since then has moved the watermarks
    that this run started from, and the commit is refused.
    """
    now = last_sequence(read_log(spark, path))
    if now != seen:
        raise BatchOrder(f"batch {batch_id} started after commit {seen}, the newest one is {now}")
    return replace_batch(log_rows(spark, rows, COMMIT_SCHEMA).coalesce(1), path, batch_id)


def succeeded(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == "SUCCESS")


def advance(control: DataFrame, log: DataFrame) -> DataFrame:
    """Control rows moved forward by successful log rows; never backwards, unchanged without success."""
    reached = succeeded(log).groupBy("table_name").agg(
        F.max(F.struct("watermark_to", "batch_id", "logged_at")).alias("new")
    )
    moved = F.col("new.watermark_to") > F.col("watermark")
    return control.join(reached, "table_name", "left").select(
        "table_name",
        F.when(moved, F.col("new.watermark_to")).otherwise(F.col("watermark")).alias("watermark"),
        F.when(moved, F.col("new.batch_id")).otherwise(F.col("last_batch_id")).alias("last_batch_id"),
        F.when(moved, F.col("new.logged_at")).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def initial_control(spark: SparkSession, tables: list[str]) -> DataFrame:
    rows = spark.createDataFrame([(t,) for t in tables], "table_name string")
    return rows.select(
        "table_name",
        _instant(WATERMARK_START).alias("watermark"),
        F.lit(None).cast("string").alias("last_batch_id"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def watermark_state(log: DataFrame) -> DataFrame:
    """Watermark reached by each table, in table order; tables without success stay at the start."""
    reached = F.max(F.when(F.col("status") == "SUCCESS", F.col("watermark_to")).cast("timestamp"))
    return (
        log.groupBy("table_name")
        .agg(F.coalesce(reached, _instant(WATERMARK_START)).alias("watermark"))
        .orderBy("table_name")
    )
