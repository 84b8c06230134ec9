"""One run: ingest, volume audit, cleaning, modelling, quality gate, publishing, summary.

Every layer is written and read back before the next one starts: later steps
see files with known sizes, nothing is computed twice, and a run that loses
executors repeats tasks, not layers. Readers see the tables of a run once it has passed the gate.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import partial, wraps
from time import monotonic
from typing import NamedTuple, TypeVar

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StructType

from parcelflow.model import CITY_NAMES, CONTRACTS
from parcelflow.operators import audit, gate, refresh, summary, verdicts
from parcelflow.operators.cleanse import clean_columns
from parcelflow.operators.reports import quality_report
from parcelflow.plans import gold as model, silver as cleaning
from parcelflow.plans.together import shuffles_dropped, together
from parcelflow.sources import ingest, layers, versions


class VolumeAlert(RuntimeError):
    """The audit found an anomaly; the run stops before cleaning."""


@dataclass(frozen=True)
class Run:
    """Where a run works and what it is called."""

    spark: SparkSession
    root: str
    batch_id: str
    as_of: date
    started_at: str | None = None
    source_system: str = "source"
    # catalog database in which published tables are registered; none by default
    database: str | None = None
    # schemas of the tables written for the next version, by layer and name
    pending: dict[tuple[str, str], StructType] = field(default_factory=dict, compare=False, repr=False)
    # folders of earlier versions, of the tables that this one takes over as they are
    kept: dict[tuple[str, str], str] = field(default_factory=dict, compare=False, repr=False)
    # batches that these verdicts hold, by table
    merged: dict[str, list[str]] = field(default_factory=dict, compare=False, repr=False)

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def next_version(self) -> int:
        """The version that this run will publish."""
        return versions.newest(self.spark, self.root) + 1

    def folder(self, version: int, layer: str, table: str) -> str:
        return f"{self.root}/{versions.folder_of(version, layer, table)}"

    def history(self, name: str) -> str:
        return self.path("history", name)

    def now(self) -> datetime:
        return datetime.now(timezone.utc)


T = TypeVar("T")


def frugal(step: Callable[..., T]) -> Callable[..., T]:
    """A step of a run that leaves no shuffle files to the next one."""

    @wraps(step)
    def within(run: Run, *args: object, **named: object) -> T:
        with shuffles_dropped(run.spark):
            return step(run, *args, **named)

    return within


def accepted(judged: DataFrame, table: str) -> DataFrame:
    """The cleaned rows of a written verdict table; its accepted part is the only folder that the scan opens."""
    return judged.filter("accepted").select(*clean_columns(judged, CONTRACTS[table]))


def read_silver(run: Run, version: int | None = None) -> dict[str, DataFrame]:
    """Cleaned tables of the newest published version, or of another one."""
    judged = versions.tables(run.spark, run.root, "judged", version)
    return {t: accepted(judged[t], t) for t in CONTRACTS}


def read_gold(run: Run, version: int | None = None, names: tuple[str, ...] = model.DIMENSIONS + model.FACTS) -> dict[str, DataFrame]:
    """Tables of the model (dimensions and facts by default) of the newest published version, or of another one."""
    gold = versions.tables(run.spark, run.root, "gold", version)
    return {t: gold[t] for t in names}


def read_log(run: Run) -> DataFrame | None:
    """The ingest log of all batches; None before the first one."""
    return ingest.read_log(run.spark, run.history("ingest_log"))


@frugal
def ingest_all(
    run: Run, sources: dict[str, DataFrame], full_reload: bool = False, upper: datetime | None = None
) -> dict[str, int]:
    """Copy what changed in each source, then commit the log rows and watermarks of all tables at once.

    A batch that succeeded before is repeated over its own logged range and into its own folder, whatever batches came
    after it. ``upper`` saves looking for the newest change in each source.
    """
    log = read_log(run)
    tables = list(sources)
    control = ingest.initial_control(run.spark, tables)
    earlier: list[Row] = []
    seen = ingest.last_sequence(log)
    if log is not None:
        # a few rows per table
        earlier = ingest.collect_utc(log.filter(F.col("batch_id") == run.batch_id))
        control = ingest.advance(control, log.filter(F.col("batch_id") != run.batch_id))
    done = {r["table_name"]: r for r in earlier if r["status"] == "SUCCESS"}
    sequence = earlier[0]["sequence"] if earlier else seen + 1
    # One row per table; held here, because the log folder it comes from is written below.
    rows = {r["table_name"]: r for r in ingest.collect_utc(control)}

    failures: dict[str, Exception] = {}

    def copy(table: str) -> dict[str, object]:
        before, begun = done.get(table), monotonic()
        if before:
            start, from_start = before["watermark_from"], before["from_start"]
        else:
            # a table that no batch has moved has no lower bound
            from_start = full_reload or rows[table]["last_batch_id"] is None
            start = ingest.FIRST_INSTANT if from_start else rows[table]["watermark"]
        # a repeat goes to the day of the first time
        instant = before["ingested_at"] if before else ingest.as_utc(run.now())
        until, records, written = start, 0, 0
        try:
            # fixed before the copy: what is written meanwhile belongs to the next batch
            newest = before["watermark_to"] if before else upper and ingest.as_utc(upper)
            until = newest or ingest.collect_utc(ingest.upper_watermark(sources[table]))[0]["watermark_to"] or start
            changed = ingest.extract(sources[table], None if from_start else start, until)
            stamped = ingest.stamp(changed, run.batch_id, run.source_system, instant)
            records, written = ingest.append_raw(stamped, f"{run.root}/bronze", table, run.batch_id, instant)
        except Exception as error:
            failures[table] = error
        mark = before["watermark"] if before else rows[table]["watermark"]
        moved = table not in failures and not before and until > mark
        return {
            "batch_id": run.batch_id,
            "table_name": table,
            "watermark_from": start,
            "watermark_to": until,
            "records": records,
            "bytes": written,
            "seconds": round(monotonic() - begun, 3),
            "status": "FAILED" if table in failures else "SUCCESS",
            "logged_at": ingest.as_utc(run.now()),
            "ingested_at": instant,
            "from_start": from_start,
            "ingested_on": f"{instant:%Y-%m-%d}",
            "watermark": until if moved else mark,
            "sequence": sequence,
        }

    copied = together(run.spark, {t: partial(copy, t) for t in tables})
    new_log = ingest.commit(run.spark, run.history("ingest_log"), run.batch_id, list(copied.values()), seen)
    # for readers; runs go by the log alone
    control = run.spark.createDataFrame(
        [tuple(r[c] for c in ("table_name", "watermark", "last_batch_id", "updated_at")) for r in rows.values()], ingest.CONTROL_SCHEMA
    )
    layers.replace_batch(ingest.advance(control, new_log), run.history("watermarks"), run.batch_id)
    for error in failures.values():
        raise error
    return {t: row["records"] for t, row in copied.items()}


@frugal
def audit_volumes(run: Run, tables: list[str], force_alert: bool = False) -> tuple[str, bool]:
    """Store the batch's audit rows and alerts; returns the verdict line and whether to stop."""
    log = layers.read_batch(run.spark, run.history("ingest_log"), run.batch_id)
    batch = audit.audit_batch(log, run.batch_id)
    audit.require_complete(batch, tables)
    batch = layers.replace_batch(batch, run.history("ingest_audit"), run.batch_id)
    history = layers.read_history(run.spark, run.history("ingest_audit"))
    if force_alert:
        alerts = audit.forced_alert(batch)
    else:
        alerts = audit.volume_alerts(audit.audit_deviation(batch, audit.mean_before(history, run.batch_id)))
    alerts = layers.replace_batch(alerts, run.history("volume_alerts"), run.batch_id)
    verdict = audit.verdict_line(batch, alerts, run.batch_id).first()["verdict"]
    return verdict, not alerts.isEmpty()


class Copied(NamedTuple):
    """A batch of a table in the raw layer: where its rows lie, and how many they are."""

    folder: str
    records: int


def copied_batches(run: Run) -> dict[str, dict[str, Copied]]:
    """Of each table the batches of its raw rows, as the log has them."""
    names = ("table_name", "batch_id", "ingested_on", "records")
    found: dict[str, dict[str, Copied]] = {t: {} for t in CONTRACTS}
    for table, batch, day, records in sorted(ingest.succeeded(read_log(run)).select(*names).collect()):  # one row per table and batch
        found.setdefault(table, {})[batch] = Copied(ingest.raw_folder(f"{run.root}/bronze", table, batch, day), records)
    return found


def own_verdicts(run: Run, table: str, batches: dict[str, Copied], stored: versions.Entry | None) -> DataFrame | None:
    """Verdicts of a table's own rows: those of the published version with the batches that it lacks; None if these hold no rows.

    Without a published version, or to repeat a batch that is in it, all raw rows are judged.
    """
    contract = CONTRACTS[table]
    busy = run.folder(run.next_version(), "busy", table)
    if stored is None or run.batch_id in stored.batches or not set(stored.batches) <= set(batches):
        return cleaning.judge_own(layers.scan_evolved(run.spark, [c.folder for c in batches.values()]), contract, busy)
    lacking = [copied for batch, copied in batches.items() if batch not in stored.batches]
    if not any(copied.records for copied in lacking):
        return None
    before = versions.read(run.spark, run.root, stored)
    fresh = layers.scan_evolved(run.spark, [copied.folder for copied in lacking])
    return verdicts.merge(before, cleaning.judge_own(fresh, contract, busy), contract)


@frugal
def build_silver(run: Run) -> dict[str, DataFrame]:
    """Judge the new rows of every table; cleaned rows, findings and report all come from the written verdicts."""
    run.pending.clear()
    run.kept.clear()
    published = versions.entries(run.spark, run.root)
    batches = copied_batches(run)
    run.merged.update({t: list(batches[t]) for t in CONTRACTS})
    version = run.next_version()
    paths = {(layer, t): run.folder(version, layer, t) for layer in ("verdicts", "judged") for t in CONTRACTS}
    judged: dict[str, DataFrame] = {}
    keys: dict[str, DataFrame] = {}

    def judge(table: str) -> DataFrame:
        contract = CONTRACTS[table]
        stored = published.get(("verdicts", table))
        own = own_verdicts(run, table, batches[table], stored)
        if own is None:  # nothing new: the files of the published version serve this one, too
            run.kept["verdicts", table], schema = stored.folder, stored.schema
            own = versions.read(run.spark, run.root, stored)
        else:
            layers.write(own, paths["verdicts", table])
            schema = own.schema
            own = layers.read_table(run.spark, paths["verdicts", table], schema)
        run.pending["verdicts", table] = schema
        verdict = cleaning.complete(own, contract, keys).withColumn("accepted", F.expr(verdicts.ACCEPTED))
        # Rejected keys lie beside the accepted ones, so the rows are written only once.
        layers.write(verdict, paths["judged", table], ["accepted"])
        run.pending["judged", table] = verdict.schema
        return layers.read_table(run.spark, paths["judged", table], verdict.schema)

    for wave in cleaning.waves(CONTRACTS):
        done = together(run.spark, {t: partial(judge, t) for t in wave})
        judged |= done
        keys |= {t: verdicts.closed_keys(df, CONTRACTS[t]) for t, df in done.items()}
    noted = F.lit(run.now()).cast("timestamp")
    found = verdicts.quarantine(cleaning.all_findings(judged), run.batch_id).withColumn("noted_at", noted)
    report = quality_report(judged).select(F.lit(run.batch_id).alias("batch_id"), "*", noted.alias("generated_at"))
    together(
        run.spark,
        {
            "quarantine": partial(layers.replace_batch, found, run.history("quarantine"), run.batch_id),
            "report": partial(layers.replace_batch, report, run.history("quality_report"), run.batch_id),
        },
    )
    return {t: accepted(judged[t], t) for t in CONTRACTS}


@frugal
def build_gold(run: Run, silver: dict[str, DataFrame], city_names: dict[str, str] = CITY_NAMES) -> dict[str, DataFrame]:
    """Write the model's tables for the next version; daily aggregates only of the days that differ from the published one."""
    earlier = versions.tables(run.spark, run.root, "gold")
    version = run.next_version()
    paths = {t: run.folder(version, "gold", t) for t in (*model.DIMENSIONS, *model.FACTS, *model.AGGREGATES, model.DAY_SUMS)}

    def write(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        run.pending.update({("gold", t): df.schema for t, df in tables.items()})

        def one(table: str) -> DataFrame:
            return layers.overwrite(tables[table], paths[table], model.PARTITIONS.get(table))

        # A large table keeps the cluster busy by itself; one after the other, their shuffles do not add up on disk.
        large = [t for t in model.LARGE if t in tables]
        jobs = {t: lambda t=t: {t: one(t)} for t in tables if t not in large}
        written = together(run.spark, {"large": lambda: {t: one(t) for t in large}, **jobs})
        return {t: df for done in written.values() for t, df in done.items()}

    base = write(model.base_tables(silver, run.as_of, city_names))
    base |= write({model.DAY_SUMS: refresh.day_sums(base["fact_shipment"])})
    derived = model.derived_tables(silver, base)
    if model.DAY_SUMS in earlier:
        days = refresh.changed_days(earlier[model.DAY_SUMS], base[model.DAY_SUMS])
        for table, build in model.AGGREGATES.items():
            derived[table] = refresh.refreshed(earlier[table], base["fact_shipment"], days, build)
    return base | write(derived)


def publish(run: Run) -> int:
    """Let readers see the tables that this run has written; returns their version."""
    version = run.next_version()
    versions.publish(run.spark, run.root, version, run.batch_id, run.pending, run.merged, ingest.as_utc(run.now()), run.kept)
    if run.database:
        for (layer, table), entry in versions.entries(run.spark, run.root, version).items():
            if layer == "gold":
                name, folder = f"{run.database}.{table}", f"{run.root}/{entry.folder}"
                layers.register(run.spark, name, folder, entry.schema, model.PARTITIONS.get(table))
    return version


@frugal
def check_gold(run: Run, gold: dict[str, DataFrame]) -> DataFrame:
    """Store the check results, then raise GateFailed if one failed."""
    results = gate.dq_results(gold["fact_shipment"], gold["dim_driver"])
    stored = results.select(F.lit(run.batch_id).alias("batch_id"), "*", F.lit(run.now()).cast("timestamp").alias("run_at"))
    stored = layers.replace_batch(stored, run.history("dq_results"), run.batch_id)
    gate.require_pass(stored)
    return stored


@frugal
def summarise(run: Run, silver: dict[str, DataFrame], gold: dict[str, DataFrame]) -> str:
    counted = {"silver": silver, "gold": {t: gold[t] for t in model.DIMENSIONS + model.FACTS}}
    row = summary.run_summary(
        summary.table_counts(counted),
        layers.read_batch(run.spark, run.history("quality_report"), run.batch_id),
        layers.read_batch(run.spark, run.history("dq_results"), run.batch_id),
        run.batch_id,
        run.started_at,
        run.now(),
    )
    return layers.replace_batch(row, run.history("run_summary"), run.batch_id).first()["summary_line"]


def note_failure(run: Run, stage: str, error: Exception) -> None:
    """A failed stage as a quarantine row of the table ``_pipeline``."""
    payload = F.to_json(
        F.struct(
            F.lit(type(error).__name__).alias("type"),
            F.lit(str(error)).alias("message"),
            F.lit(stage).alias("stage"),
        )
    )
    instant = run.now()
    row = run.spark.range(1).select(
        F.sha2(F.lit(f"{run.batch_id}/_pipeline/{stage}/{instant.isoformat()}"), 256).alias("finding_id"),
        F.lit(run.batch_id).alias("batch_id"),
        F.lit("_pipeline").alias("table_name"),
        F.lit(stage).alias("record_key"),
        F.lit("OPERATIONAL_ERROR").alias("rule"),
        payload.alias("payload"),
        F.lit(instant).cast("timestamp").alias("noted_at"),
    )
    row.write.mode("append").parquet(layers.batch_folder(run.history("operational_errors"), run.batch_id))


def staged(run: Run, stage: str, step):
    """Run one stage; a failure is noted and raised again, also when noting it fails."""
    try:
        return step()
    except Exception as error:
        try:
            note_failure(run, stage, error)
        except Exception as second:
            error.add_note(f"the failure could not be recorded: {second}")
        raise


def run(
    settings: Run,
    sources: dict[str, DataFrame],
    full_reload: bool = False,
    upper: datetime | None = None,
    force_alert: bool = False,
    city_names: dict[str, str] = CITY_NAMES,
) -> str:
    """The whole run; returns the summary line."""
    settings.spark.conf.set("spark.sql.session.timeZone", "UTC")
    staged(settings, "ingest", lambda: ingest_all(settings, sources, full_reload, upper))
    verdict, alerted = staged(settings, "audit", lambda: audit_volumes(settings, list(sources), force_alert))
    if alerted:
        raise VolumeAlert(verdict)
    silver = staged(settings, "silver", lambda: build_silver(settings))
    gold = staged(settings, "gold", lambda: build_gold(settings, silver, city_names))
    staged(settings, "gate", lambda: check_gold(settings, gold))
    staged(settings, "publish", lambda: publish(settings))
    return staged(settings, "summary", lambda: summarise(settings, silver, gold))
