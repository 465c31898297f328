"""The daily jobs: Bronze to Silver, Silver to Gold, and on to the warehouse."""

import datetime as dt
import logging
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paytrail import contract as c
from paytrail.operators import activity, cleaning, metrics, publishing, quality, routing, scoring
from paytrail.plans import partials
from paytrail.sources import catalog, tables
from paytrail.sources.landing import BRONZE, Landing
from paytrail.sources.seen import SeenKeys
from paytrail.sources.snapshots import DayTable

log = logging.getLogger(__name__)


def to_complete(bronze: DataFrame, mismatch_types=None) -> DataFrame:
    """Clean and flag messages and drop those without a key. No shuffle."""
    return (
        bronze.transform(cleaning.cast_types)
        .transform(cleaning.standardize_time)
        .transform(cleaning.flag_quality, mismatch_types)
        .transform(cleaning.drop_incomplete)
    )


def to_latest(complete: DataFrame) -> DataFrame:
    """Fill gaps and keep the latest copy. One shuffle, for the duplicates."""
    return complete.transform(cleaning.fill_missing).transform(cleaning.latest_only)


def to_silver(bronze: DataFrame, mismatch_types=None) -> DataFrame:
    """Clean, flag and deduplicate messages."""
    return to_latest(to_complete(bronze, mismatch_types))


def messages_to_silver(messages: DataFrame) -> DataFrame:
    """Silver straight from enriched messages: keep the valid ones and clean them."""
    return to_silver(routing.valid(routing.judge(messages)))


def warehouse_frames(silver: DataFrame, loaded_at: Column) -> dict[str, DataFrame]:
    """The three warehouse tables, derived lazily from Silver."""
    gold = {
        "fact_transactions": silver,
        "fraud_alerts": scoring.alerts(silver),
        "transaction_summary": activity.summarize(silver),
    }
    return {name: publishing.shape(df, name, loaded_at) for name, df in gold.items()}


@dataclass(frozen=True)
class Lake:
    """Folder layout under one root that all executors reach."""

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root}/landing"

    @property
    def bronze(self) -> str:
        return f"{self.landing}/route={BRONZE}"

    @property
    def compacted(self) -> str:
        return f"{self.root}/compacted/{BRONZE}"

    def landed(self, spark: SparkSession) -> Landing:
        return Landing(spark, self.landing, self.compacted)

    @property
    def silver(self) -> str:
        return f"{self.root}/silver/transactions"

    @property
    def alerts(self) -> str:
        return f"{self.root}/gold/fraud_alerts"

    @property
    def summary(self) -> str:
        return f"{self.root}/gold/transaction_summary"

    def warehouse(self, table: str) -> str:
        return f"{self.root}/warehouse/{table}"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"

    def partials(self, table: str) -> str:
        return f"{self.root}/partials/{table}"


def run_silver(spark: SparkSession, lake: Lake, day: dt.date, seen_keys: SeenKeys | None = None) -> dict:
    """Bronze to Silver for one day. Metrics are observed during the write.

    With ``seen_keys``, messages that an earlier day has had are left out, and the day's keys are
    recorded once its rows are published.
    """
    bronze = lake.landed(spark).read_day(day)
    read, complete, seen = Observation(), Observation(), Observation()
    counted = metrics.count_rows(to_complete(metrics.count_rows(bronze, read)), complete)
    latest = to_latest(counted)
    if seen_keys:
        latest = seen_keys.unseen(latest, day)
    stamped = latest.withColumn("silver_processed_at", F.current_timestamp())
    table = DayTable(spark, lake.silver)
    rows = table.publish(stamped.observe(seen, *metrics.silver_columns()), day)
    if seen_keys:
        seen_keys.record(table.read([day]), day)
    if rows:
        counts = read.get["rows"], complete.get["rows"]
    else:
        counts = bronze.count(), to_complete(bronze).count()
    found = _seen(seen, rows, table, day, metrics.silver_columns())
    return found | metrics.row_counts(*counts, rows)


def _seen(seen: Observation, rows: int, table: DayTable, day: dt.date, columns) -> dict:
    """Metrics observed during a write; an empty day is measured from its empty table.

    Adaptive execution may drop an emptied plan together with its observation.
    """
    if rows:
        return seen.get
    return table.read([day]).agg(*columns).first().asDict()


def run_gold(spark: SparkSession, lake: Lake, day: dt.date) -> dict:
    """Silver to Gold for one day: the alert table and the account-day summary."""
    source = DayTable(spark, lake.silver)
    tables.require_day(source, day)
    silver = source.read([day])
    stamp = F.current_timestamp()

    seen = {}
    for frame, root, columns in (
        (activity.summarize(silver), lake.summary, metrics.summary_columns()),
        (scoring.alerts(silver), lake.alerts, metrics.alert_columns()),
    ):
        observed = Observation()
        stamped = frame.withColumn("gold_processed_at", stamp).observe(observed, *columns)
        table = DayTable(spark, root)
        rows = table.publish(stamped, day)
        seen |= _seen(observed, rows, table, day, columns)
    return seen


def run_load(
    spark: SparkSession, lake: Lake, day: dt.date, database: str | None = None
) -> dict[str, int]:
    """Publish one day of the three tables; returns rows loaded per table.

    With a ``database``, the tables declared there get the day's partition.
    """
    sources = {
        "fact_transactions": lake.silver,
        "fraud_alerts": lake.alerts,
        "transaction_summary": lake.summary,
    }
    loaded = {}
    for name, path in sources.items():
        source = DayTable(spark, path)
        if not source.has(day):
            log.warning("nothing to load into %s for %s", name, day)
            loaded[name] = 0
            continue
        rows = publishing.shape(source.read([day]), name, F.current_timestamp())
        target = DayTable(spark, lake.warehouse(name))
        loaded[name] = target.publish(rows, day, [c.WAREHOUSE_TABLES[name][1]])
        if name in partials.PARTIALS:
            reduced = partials.PARTIALS[name](target.read([day]))
            DayTable(spark, lake.partials(name)).publish(reduced, day)
        if database:
            catalog.show_day(f"{database}.{name}", target, day)
        if not loaded[name]:
            log.warning("no rows for %s on %s", name, day)
    return loaded


def read_warehouse(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    return {name: DayTable(spark, lake.warehouse(name)).read() for name in c.WAREHOUSE_TABLES}


def read_report(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A report from the partials of all days loaded; the warehouse tables are not read."""
    table, build = partials.REPORTS[name]
    return build(DayTable(spark, lake.partials(table)).read())


def run_day(
    spark: SparkSession, lake: Lake, day: dt.date, must_have=tuple(c.WAREHOUSE_TABLES)
) -> dict:
    """All stages of one day in order, each behind a gate on its input.

    At the end the tables in ``must_have`` need rows. By default that is all of them, so a day
    without alerts is published and then rejected; leave the alert table out to accept it.
    """
    lake.landed(spark).require_files(day)
    seen = {"silver": run_silver(spark, lake, day)}
    seen["gold"] = run_gold(spark, lake, day)
    for path in (lake.alerts, lake.summary):
        tables.require_day(DayTable(spark, path), day)
    seen["loaded"] = run_load(spark, lake, day)
    published = read_warehouse(spark, lake)
    tables.require_rows({name: published[name] for name in must_have}, day)
    return seen


def run_quality(spark: SparkSession, lake: Lake, day: dt.date, only=None) -> DataFrame:
    """Quality report of one day, for all layers or the chosen ones.

    A layer without files for the day gets one failed row. ``quality_gate`` stores and judges it.
    """
    silver, alerts, summary = (DayTable(spark, p) for p in (lake.silver, lake.alerts, lake.summary))
    published = {name: DayTable(spark, lake.warehouse(name)) for name in c.WAREHOUSE_TABLES}

    landing = lake.landed(spark)

    def landed() -> int:
        return len(landing.day_files(day))

    def bronze_report() -> DataFrame:
        return quality.check_bronze(landing.read_day(day), landed())

    def gold_report() -> DataFrame:
        return quality.check_gold(alerts.read([day]), summary.read([day]))

    def warehouse_report() -> DataFrame:
        return quality.check_warehouse(
            silver.read([day]), {name: table.read([day]) for name, table in published.items()}
        )

    layers = {
        "bronze": (bronze_report, landed),
        "silver": (lambda: quality.check_silver(silver.read([day])), lambda: silver.has(day)),
        "gold": (gold_report, lambda: alerts.has(day) and summary.has(day)),
        "warehouse": (warehouse_report, lambda: all(t.has(day) for t in (silver, *published.values()))),
    }

    def checked(name, build, present) -> DataFrame:
        return build() if present() else quality.absent(spark.range(1), name)

    return quality.run_checks(
        {name: partial(checked, name, *layer) for name, layer in layers.items()}, only
    )


def quality_gate(
    spark: SparkSession, lake: Lake, day: dt.date, only=None, strict: bool = False
) -> DataFrame:
    """Run the checks of one day once, publish their report and return its verdict (one row).

    The report stays readable in ``lake.quality`` also when the gate refuses the day: with failed
    checks, or with warnings if ``strict``, it raises after publishing.
    """
    table = DayTable(spark, lake.quality)
    table.publish(run_quality(spark, lake, day, only).withColumn("transaction_date", F.lit(day)), day)
    summed = quality.verdict(table.read([day]))
    found = summed.first()
    if found.failed or (strict and found.warnings):
        raise tables.DataGateError(
            f"{found.verdict} on {day}: {found.failed} failed, {found.warnings} warnings, {found.passed} passed"
        )
    return summed
