"""Every registered query: operator by operator, each over the whole table."""

import datetime as dt
import functools
import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paytrail import contract as c
from paytrail.functions.calendar import day_folder
from paytrail.functions.money import total_cents
from paytrail.operators import (
    activity, cleaning, metrics, publishing, quality, routing, scoring,
)
from paytrail.operators.enrich import enrich as enrich_rows
from paytrail.plans import feed, lasting, medallion, partials, views
from paytrail.session import prepare, shared_dir
from paytrail.sources import catalog as tables_catalog
from paytrail.sources import ledger_file, tables
from paytrail.sources.seen import SeenKeys
from paytrail.sources.snapshots import DayTable
from paytrail.streaming import batches, ingest
from verification import fixture

def store(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as they are now, stored and read back."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TX = ("nameOrig", "nameDest", "amount", "step", "kafka_offset")
SCAN_DAY = dt.date(2024, 1, 15)
SLICE = (100, 500)
LARGE_TRANSACTION = 500_000

QUERIES = {}


def query(build):
    """Register a query; its result is made comparable across engines."""

    @functools.wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(build(prepare(spark), sf_dir))

    QUERIES[build.__name__] = run
    return run


def comparable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text, whole numbers as long."""

    def plain(field):
        column = F.col(field.name)
        if isinstance(field.dataType, T.TimestampType):
            return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        if isinstance(field.dataType, T.DateType):
            return column.cast("string")
        if isinstance(field.dataType, T.IntegralType):
            return column.cast("bigint")
        return column

    return df.select(*(plain(f).alias(f.name) for f in df.schema.fields))


def _events(spark, sf_dir):
    return fixture.events(spark, sf_dir)


def _messages(spark, sf_dir):
    return fixture.messages(_events(spark, sf_dir))


def _bronze(spark, sf_dir):
    """Messages that passed validation."""
    return routing.valid(routing.judge(_messages(spark, sf_dir)))


def _silver(spark, sf_dir):
    return medallion.to_silver(_bronze(spark, sf_dir))


def _flagged(spark, sf_dir):
    """Unvalidated messages, cast and flagged, so that every flag occurs."""
    return cleaning.flag_quality(
        cleaning.standardize_time(cleaning.cast_types(_messages(spark, sf_dir)))
    )


def _load_stamp():
    """A repeatable load time, a few minutes after the message."""
    return F.timestamp_add("MINUTE", F.coalesce("kafka_partition", F.lit(0)) * 7, "sent_at")


def _table(spark, sf_dir, name):
    """One warehouse table, derived from the events."""
    build = {
        views.FACT: lambda silver: silver,
        views.ALERTS: scoring.alerts,
        views.SUMMARY: activity.summarize,
    }[name]
    midnight = F.col("transaction_date").cast("timestamp")
    stamp = midnight if name == views.SUMMARY else _load_stamp()
    return publishing.shape(build(_silver(spark, sf_dir)), name, stamp)


def _warehouse(spark, sf_dir):
    return {name: _table(spark, sf_dir, name) for name in c.WAREHOUSE_TABLES}


# --- sources and sinks -----------------------------------------------------


@query
def unknown_types(spark, sf_dir):
    return ledger_file.unknown_types(fixture.ledger(_events(spark, sf_dir)))


@query
def ledger_slice(spark, sf_dir):
    skip, limit = SLICE
    rows = fixture.ledger(_events(spark, sf_dir))
    return ledger_file.ledger_slice(rows, ["kafka_offset"], skip, limit).select(
        *c.LEDGER_SCHEMA.names, "kafka_offset"
    )


@query
def ledger_csv(spark, sf_dir):
    """Written as CSV files with a header and read back."""
    path = shared_dir(spark, "ledger")
    rows = fixture.ledger(_events(spark, sf_dir)).select(*c.LEDGER_SCHEMA.names)
    # Spark's writer trims values unless told otherwise.
    rows.write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return ledger_file.read_ledger(spark, path)


@query
def ledger_slice_deep(spark, sf_dir):
    """The second half of the ledger, by positions in the stored order."""
    rows = fixture.ledger(_events(spark, sf_dir))
    half = rows.count() // 2
    return ledger_file.ledger_slice(rows, ["kafka_offset"], half, half, one_task=0).select(
        *c.LEDGER_SCHEMA.names, "kafka_offset"
    )


@query
def ledger_fed(spark, sf_dir):
    """The ledger but its first rows, published as one batch; what the topic holds beside the job's counts."""
    topic = f"{shared_dir(spark, 'feed')}/topic"
    counts = feed.run_feed(
        fixture.ledger(_events(spark, sf_dir)), lambda messages: fixture.wrapped(messages).write.parquet(topic),
        order=["kafka_offset"], skip=SLICE[0], sent_at=F.col("kafka_timestamp"),
    )
    held = routing.parse(spark.read.schema(c.ENVELOPE_SCHEMA).parquet(topic))
    return held.groupBy("type").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("isSuspicious").alias("fraud_count"),
        F.count_if("isFullDrain").alias("drained"),
    ).select("*", *(F.lit(n).alias(f"job_{name}") for name, n in sorted(counts.items())))


@query
def json_roundtrip(spark, sf_dir):
    parsed = routing.parse(fixture.envelope(_events(spark, sf_dir)))
    return parsed.select("kafka_partition", "kafka_offset", *c.MESSAGE_SCHEMA.names)


def _ingested(spark, sf_dir, purpose):
    """Land the whole table through the streaming query; returns the landing folder."""
    work = shared_dir(spark, purpose)
    stream = fixture.envelope(fixture.stream_events(spark, sf_dir))
    ingest.start_ingest(
        stream, f"{work}/landing", f"{work}/checkpoint", {"availableNow": True}
    ).awaitTermination()
    return f"{work}/landing"


@query
def bronze_stream(spark, sf_dir):
    rows = ingest.read_route(spark, _ingested(spark, sf_dir, "bronze"), ingest.BRONZE)
    return rows.drop("ingested_at")


@query
def quarantine_stream(spark, sf_dir):
    landing = _ingested(spark, sf_dir, "quarantine")
    rows = ingest.read_route(spark, landing, ingest.QUARANTINE)
    return rows.drop("ingested_at", "raw_value", "rescued_fields", "rescue_reason")


@query
def stream_dedup(spark, sf_dir):
    work = shared_dir(spark, "dedup")
    parsed = routing.parse(fixture.envelope(fixture.stream_events(spark, sf_dir)))
    ingest.append_stream(
        ingest.drop_repeats(parsed).select(*c.DEDUP_KEY),
        f"{work}/rows", f"{work}/checkpoint", (), {"availableNow": True},
    ).awaitTermination()
    return spark.read.parquet(f"{work}/rows")


BATCHES = 6
ROW_GROUP = 8 << 20
BY_FILE = {"availableNow": True}


def _topic(spark, sf_dir, purpose, *parts):
    """The envelope in files, read as a stream of one file a batch; parts come one after the other."""
    root = shared_dir(spark, purpose)
    sent = fixture.envelope(_events(spark, sf_dir))
    for part in parts or (F.lit(True),):
        # A batch is one file; small row groups let many tasks read it.
        files = sent.where(part).repartition(BATCHES).write.option("parquet.block.size", ROW_GROUP)
        files.mode("append").parquet(f"{root}/topic")
    stream = spark.readStream.schema(sent.schema).option("maxFilesPerTrigger", 1)
    return root, stream.parquet(f"{root}/topic")


@query
def stream_restart(spark, sf_dir):
    """A stream of several batches fails before one commit and after another, and is started again.

    Every message is there once; the batches are as many as the files, and one was given twice.
    """
    root, topic = _topic(spark, sf_dir, "restart")
    table, given = batches.BatchTable(spark, f"{root}/table"), []
    messages = routing.parse(topic).select(*TX, "kafka_partition")

    def failing(rows, batch):
        first = batch not in given
        given.append(batch)
        if first and batch == 1:
            rows.write.parquet(f"{root}/table/rows/query=restart/batch=1/cut-off")
            raise RuntimeError("stopped before the commit")
        written = table.append(rows, "restart", batch)
        if first and batch == 3:
            raise RuntimeError("stopped after the commit")
        if not first and batch == 3 and written:
            raise ValueError("a committed batch was written again")

    def run():
        stream = batches.start_batches(messages, table, "restart", f"{root}/checkpoint", BY_FILE, failing)
        try:
            stream.awaitTermination()
        except StreamingQueryException as error:
            if "stopped" not in str(error):
                raise

    for _ in range(3):
        run()
    enough = table.batches().count() == BATCHES and given.count(1) == given.count(3) == 2
    return table.read(messages.schema).withColumn("each_batch_once", F.lit(enough))


@query
def batch_metrics(spark, sf_dir):
    """Counts observed in each batch, written by a listener and added up; they equal the landed rows."""
    root, topic = _topic(spark, sf_dir, "metrics")
    log = batches.ProgressLog(spark, f"{root}/progress", "routes")
    spark.streams.addListener(log)
    try:
        stream = ingest.start_ingest(topic, f"{root}/landing", f"{root}/checkpoint", BY_FILE, metrics="routes")
        stream.awaitTermination()
        log.wait(stream)
    finally:
        spark.streams.removeListener(log)
    landed = spark.read.parquet(f"{root}/landing").count()
    return log.read().agg(
        F.count(F.lit(1)).alias("batch_count"),
        *(F.sum(name).alias(name) for name in ("input_rows", "valid", "quarantined", "rescued", "fraud")),
        (F.sum("valid") + F.sum("quarantined") == landed).alias("equals_landed"),
    )


@query
def ingest_dedup(spark, sf_dir):
    """Ingest that drops repeats, over several batches; the repeats of all messages come in later ones."""
    again = F.col("offset") >= fixture.REPEAT_OFFSET
    root, topic = _topic(spark, sf_dir, "dedup-ingest", ~again, again)
    landing = f"{root}/landing"
    ingest.start_ingest(topic, landing, f"{root}/checkpoint", BY_FILE, repeat_delay="1 hour").awaitTermination()
    return spark.read.parquet(landing).select("route", "kafka_partition", "kafka_offset", *c.MESSAGE_SCHEMA.names)


@query
def partition_scan(spark, sf_dir):
    root = shared_dir(spark, "days")
    rows = routing.with_day_partition(_bronze(spark, sf_dir))
    tables.write_table(rows, root, c.DAY_PARTITION)
    return tables.read_day(spark, root, SCAN_DAY).drop("kafka_timestamp")


@query
def partition_file_count(spark, sf_dir):
    root = shared_dir(spark, "files")
    tables.write_table(routing.with_day_partition(_bronze(spark, sf_dir)), root, c.DAY_PARTITION)
    # How many files a day has depends on the cluster; that it has some, and their rows, does not.
    listed = tables.day_text(tables.list_files(spark, root)).groupBy(*c.DAY_PARTITION).agg(
        (F.count(F.lit(1)) > 0).alias("has_files")
    )
    rows = tables.read_days(spark, root).groupBy(*c.DAY_PARTITION, F.col("_metadata.file_path")).count()
    held = rows.groupBy(*c.DAY_PARTITION).agg(F.sum("count").alias("row_count"))
    return listed.join(held, list(c.DAY_PARTITION), "left")


def _published(spark, sf_dir, name, times):
    table = DayTable(spark, f"{shared_dir(spark, 'publish')}/{name}")
    rows = _table(spark, sf_dir, name)
    for _ in range(times):
        table.publish(rows, cluster_by=[c.WAREHOUSE_TABLES[name][1]])
    return table.read()


@query
def overwrite_idempotent(spark, sf_dir):
    """Publish twice; each day holds its rows once."""
    rows = _published(spark, sf_dir, views.FACT, times=2)
    return rows.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        total_cents(F.col("amount")).alias("cents"),
        F.count_distinct("transaction_id").alias("id_count"),
    )


@query
def publish_fact(spark, sf_dir):
    return _published(spark, sf_dir, views.FACT, times=1)


@query
def publish_interrupted(spark, sf_dir):
    """A publish of doubled amounts stops before its commit, and is then run again.

    Readers see the old day after the first, the new one after the second, and the
    old one again as of the first commit; vacuumed, the table holds what it held.
    """
    table = DayTable(spark, shared_dir(spark, "interrupted"))
    rows = _table(spark, sf_dir, views.FACT)
    table.publish(rows)
    first = table.sequence()
    doubled = rows.withColumn("amount", F.col("amount") * 2)

    def held(phase, **which):
        days = table.read(**which).groupBy("transaction_date").agg(
            F.count(F.lit(1)).alias("row_count"), total_cents(F.col("amount")).alias("cents")
        )
        return store(days.withColumn("phase", F.lit(phase)), "held")

    table.stage(doubled, SCAN_DAY)
    phases = [held("interrupted")]
    table.commit(table.stage(doubled, SCAN_DAY))
    phases += [held("rerun"), held("as of the first", as_of=first)]
    table.vacuum(keep=1)
    return functools.reduce(DataFrame.unionByName, [*phases, held("vacuumed")])


# --- enrichment and routing ------------------------------------------------


@query
def enrich(spark, sf_dir):
    return _messages(spark, sf_dir).drop("kafka_timestamp")


@query
def date_parts(spark, sf_dir):
    rows = routing.with_day_partition(_messages(spark, sf_dir))
    return rows.select("kafka_offset", *c.DAY_PARTITION)


@query
def bronze_valid(spark, sf_dir):
    return _bronze(spark, sf_dir).drop("kafka_timestamp")


@query
def quarantine(spark, sf_dir):
    rows = routing.quarantined(routing.judge(_messages(spark, sf_dir)))
    return rows.drop("kafka_timestamp", routing.REASONS)


@query
def quarantine_reasons(spark, sf_dir):
    rows = routing.quarantined(routing.judge(_messages(spark, sf_dir)))
    return rows.select("kafka_offset", routing.REASONS)


# --- Silver ----------------------------------------------------------------


@query
def rescued_fields(spark, sf_dir):
    """Messages with broken, mistyped and unknown parts, by the same read as the stream's."""
    odd = fixture.garbled(fixture.envelope(_events(spark, sf_dir)))
    return routing.ingest(odd).select("kafka_offset", "nameOrig", "rescued_fields", "rescue_reason")


@query
def silver_cast(spark, sf_dir):
    return cleaning.cast_types(_messages(spark, sf_dir)).drop("kafka_timestamp")


@query
def silver_time(spark, sf_dir):
    rows = cleaning.standardize_time(_messages(spark, sf_dir))
    return rows.select("kafka_offset", "sentAt", "transaction_date", "transaction_hour")


@query
def dq_flags(spark, sf_dir):
    flags = [*c.BLOCKING_FLAGS, *c.INFORMATIVE_FLAGS, "dq_is_clean"]
    return _flagged(spark, sf_dir).select("kafka_offset", *flags)


@query
def dq_mismatch_by_type(spark, sf_dir):
    rows = cleaning.cast_types(_messages(spark, sf_dir))
    flag = cleaning.balance_mismatch(("TRANSFER", "CASH_OUT"))
    return rows.select("kafka_offset", flag.alias("dq_balance_mismatch"))


@query
def null_drop(spark, sf_dir):
    return cleaning.drop_incomplete(_flagged(spark, sf_dir)).select(*TX, "type")


@query
def null_fill(spark, sf_dir):
    """Balances, flags and offsets are blanked on some rows first, to be filled."""
    gaps = {
        "oldbalanceOrg": 3, "newbalanceOrig": 5, "oldbalanceDest": 7, "newbalanceDest": 11,
        "balanceDropOrig": 13, "balanceChangeDest": 17, "isFlaggedFraud": 19,
        "kafka_partition": 23,
    }
    rows = cleaning.cast_types(_messages(spark, sf_dir)).withColumns({
        name: F.when(F.col("kafka_offset") % n != 0, F.col(name)) for name, n in gaps.items()
    })
    return cleaning.fill_missing(rows).select("kafka_offset", *gaps)


@query
def dedup_latest(spark, sf_dir):
    return cleaning.latest_only(_bronze(spark, sf_dir)).select(*TX, "kafka_partition")


@query
def duplicate_count(spark, sf_dir):
    return cleaning.surplus_copies(_bronze(spark, sf_dir))


@query
def silver_metrics(spark, sf_dir):
    return metrics.silver_metrics(_silver(spark, sf_dir))


@query
def silver(spark, sf_dir):
    return _silver(spark, sf_dir).drop("kafka_timestamp")


# --- Gold: alerts ----------------------------------------------------------


@query
def alerts(spark, sf_dir):
    return scoring.alerts(_silver(spark, sf_dir))


def _profiled(spark, sf_dir, *columns):
    return scoring.with_sender_profile(_silver(spark, sf_dir)).select(*TX, *columns)


@query
def sender_avg(spark, sf_dir):
    return _profiled(spark, sf_dir, "sender_avg_amount")


@query
def sender_avg_history(spark, sf_dir):
    rows = scoring.with_sender_profile(_silver(spark, sf_dir), scoring.HISTORY_SCOPE)
    return rows.select(*TX, "sender_avg_amount", "sender_tx_count_in_step", "r4_large_amount")


@query
def rule_large_amount(spark, sf_dir):
    return _profiled(spark, sf_dir, "r4_large_amount")


@query
def sender_velocity(spark, sf_dir):
    return _profiled(spark, sf_dir, "sender_tx_count_in_step")


@query
def rule_rapid_repeat(spark, sf_dir):
    return _profiled(spark, sf_dir, "r5_rapid_repeat")


def _scored(spark, sf_dir, column, **policy):
    return scoring.score_all(_silver(spark, sf_dir), **policy).select(*TX, column)


@query
def alert_reasons(spark, sf_dir):
    return _scored(spark, sf_dir, "alert_reasons")


@query
def alert_score(spark, sf_dir):
    return _scored(spark, sf_dir, "alert_score")


@query
def alert_severity(spark, sf_dir):
    return _scored(spark, sf_dir, "alert_severity")


@query
def alert_severity_5tier(spark, sf_dir):
    return _scored(spark, sf_dir, "alert_severity", tiers=c.SEVERITY_TIERS_WITH_CRITICAL)


@query
def rule_threshold(spark, sf_dir):
    rules = (*scoring.RULES, scoring.amount_over(LARGE_TRANSACTION))
    rows = scoring.alerts(_silver(spark, sf_dir), rules=rules)
    return rows.select(*TX, "alert_reasons", "alert_score", "alert_severity")


@query
def gold_metrics(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return metrics.gold_metrics(scoring.alerts(rows), activity.summarize(rows))


# --- Gold: account days ----------------------------------------------------


def _account_days(spark, sf_dir, *measures, names=False):
    return activity.account_days(_silver(spark, sf_dir), measures, names)


@query
def summary_volume(spark, sf_dir):
    return _account_days(spark, sf_dir, *activity.volume())


@query
def summary_balance(spark, sf_dir):
    return _account_days(spark, sf_dir, *activity.balances())


@query
def summary_risk(spark, sf_dir):
    days = _account_days(spark, sf_dir, *activity.risk_counts())
    return days.withColumn("account_risk_level", activity.risk_level())


@query
def summary_diversity(spark, sf_dir):
    return _account_days(spark, sf_dir, *activity.diversity(), names=True)


@query
def summary_types(spark, sf_dir):
    return _account_days(spark, sf_dir, *activity.type_counts())


@query
def summary_quality(spark, sf_dir):
    return _account_days(spark, sf_dir, *activity.quality_counts())


@query
def summary(spark, sf_dir):
    return activity.summarize(_silver(spark, sf_dir))


@query
def summary_alert_count(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    counted = activity.with_alert_counts(activity.summarize(rows), scoring.alerts(rows))
    return counted.select(*activity.ACCOUNT_DAY, "tx_count", "alert_tx_count")


# --- warehouse -------------------------------------------------------------


@query
def fact(spark, sf_dir):
    return _table(spark, sf_dir, views.FACT)


@query
def fact_ids(spark, sf_dir):
    return _table(spark, sf_dir, views.FACT).select("kafka_offset", "transaction_id")


@query
def alert_ids(spark, sf_dir):
    return _table(spark, sf_dir, views.ALERTS).select("kafka_offset", "alert_id")


@query
def summary_ids(spark, sf_dir):
    rows = _table(spark, sf_dir, views.SUMMARY)
    return rows.select("name_orig", "transaction_date", "summary_id")


@query
def load_report(spark, sf_dir):
    return publishing.load_report(_warehouse(spark, sf_dir))


# --- reports ---------------------------------------------------------------


def _register_view(name):
    def build(spark, sf_dir):
        view = views.VIEWS[name]
        return view.build(_table(spark, sf_dir, view.table))

    # The two documented-only trend reports go by their plain names.
    build.__name__ = name.removeprefix("v_") if name in (
        "v_fraud_trend_7d", "v_fraud_heatmap") else name
    query(build)


for _name in views.VIEWS:
    _register_view(_name)


@query
def pipeline_health(spark, sf_dir):
    return views.pipeline_health(_warehouse(spark, sf_dir))


LOOKUP = {"step": (337, 341), "amount": (1_000.0, 30_000.0), "name_orig": ("C1", "C12")}
LOOKUP_FILES = 128


@query
def clustered_lookup(spark, sf_dir):
    """Ranges of steps, amounts and senders in one day laid out along the curve, from a tenth of its files."""
    table = DayTable(spark, shared_dir(spark, "clustered"))
    rows = store(_table(spark, sf_dir, views.FACT), "lookup")
    table.commit(table.stage_clustered(rows, SCAN_DAY, ["step", "amount", "name_orig"], LOOKUP_FILES))
    found = table.look_up(LOOKUP, [SCAN_DAY])
    few = 10 * len(found.inputFiles()) <= len(table.read([SCAN_DAY]).inputFiles())
    return found.select("transaction_id", "kafka_offset", "step", "amount", F.lit(few).alias("few_files"))


@query
def alerts_with_history(spark, sf_dir):
    """The three tables in buckets of the sender, joined."""
    names = {name: f"{name}_{uuid.uuid4().hex[:8]}" for name in c.WAREHOUSE_TABLES}
    for name, df in _warehouse(spark, sf_dir).items():
        tables_catalog.save_bucketed(df, names[name], "name_orig", 8)
    found = views.alerts_with_history({name: spark.table(saved) for name, saved in names.items()})
    kept = store(found, "history")
    for saved in names.values():
        spark.sql(f"DROP TABLE {saved}")
    return kept


def _partials(spark, sf_dir):
    """Partials of both tables; one day is loaded wrongly first, then again."""
    found = {}
    for name, reduce in partials.PARTIALS.items():
        table = DayTable(spark, f"{shared_dir(spark, 'partials')}/{name}")
        rows = store(_table(spark, sf_dir, name), "partials")
        wrong = rows.unionByName(rows.where(F.col("transaction_date") == F.lit(SCAN_DAY)))
        table.publish(reduce(wrong))
        table.publish(reduce(rows), SCAN_DAY)
        found[name] = table.read()
    return found


@query
def kpi_from_partials(spark, sf_dir):
    """Both key figure reports, from partials alone, after a rerun of one day."""
    held = _partials(spark, sf_dir)
    return partials.kpi_fraud_rate(held[views.FACT]).unionByName(
        partials.kpi_alert_summary(held[views.ALERTS]), allowMissingColumns=True
    )


@query
def median_from_sketches(spark, sf_dir):
    """Per type, whether the median from merged sketches has its rank, counted in the rows."""
    fact = store(_table(spark, sf_dir, views.FACT), "sketched")
    return partials.within_rank(fact, partials.median_by_type(partials.fact_partials(fact)))


# --- quality ---------------------------------------------------------------


@query
def dq_bronze(spark, sf_dir):
    return quality.check_bronze(_messages(spark, sf_dir))


@query
def type_distribution(spark, sf_dir):
    return quality.distribution(_messages(spark, sf_dir), "type")


@query
def dq_silver(spark, sf_dir):
    return quality.check_silver(_silver(spark, sf_dir))


def _gold(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return scoring.alerts(rows), activity.summarize(rows)


@query
def dq_gold(spark, sf_dir):
    return quality.check_gold(*_gold(spark, sf_dir))


@query
def severity_distribution(spark, sf_dir):
    return quality.distribution(_gold(spark, sf_dir)[0], "alert_severity")


@query
def risk_distribution(spark, sf_dir):
    return quality.distribution(_gold(spark, sf_dir)[1], "account_risk_level")


@query
def warehouse_counts(spark, sf_dir):
    return quality.table_counts(_warehouse(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    """The fact table lacks one day and some rows of another."""
    fact = _table(spark, sf_dir, views.FACT)
    day = F.col("transaction_date")
    short = (day == F.lit(SCAN_DAY)) & (F.col("step") % 2 == 0)
    gone = day == F.lit(SCAN_DAY + dt.timedelta(days=1))
    return quality.reconcile(_silver(spark, sf_dir), fact.where(~(short | gone)))


def _lake(spark, sf_dir, purpose):
    """All messages landed by the stream, and the folder layout around them."""
    return medallion.Lake(_ingested(spark, sf_dir, purpose).removesuffix("/landing"))


@query
def compacted_day(spark, sf_dir):
    """One day of the landing, read from its compacted files; a file of no commit is beside them."""
    lake = _lake(spark, sf_dir, "compacted")
    landing = lake.landed(spark)
    landing.read_day(SCAN_DAY).write.mode("append").parquet(day_folder(lake.bronze, SCAN_DAY))
    landing.compact(SCAN_DAY)
    landing.require_files(SCAN_DAY)
    return landing.read_day(SCAN_DAY).drop("ingested_at")


@query
def dedup_across_days(spark, sf_dir):
    """Silver of three days when every repeat is sent a day after its message; the second day runs twice."""
    lake = medallion.Lake(shared_dir(spark, "across"))
    sent = F.col("kafka_timestamp")
    rows = fixture.ledger(_events(spark, sf_dir)).withColumn("kafka_timestamp", F.when(
        F.col("kafka_offset") >= fixture.REPEAT_OFFSET, sent + F.expr("INTERVAL 1 DAY")
    ).otherwise(sent))
    messages = enrich_rows(rows, sent)
    start_landing(messages, lake)
    seen = SeenKeys(spark, f"seen_{uuid.uuid4().hex[:8]}", buckets=8)
    for offset in (0, 1, 1, 2):
        medallion.run_silver(spark, lake, SCAN_DAY + dt.timedelta(days=offset), seen)
    found = DayTable(spark, lake.silver).read().select("transaction_date", *TX)
    kept = store(found, "across")
    spark.sql(f"DROP TABLE {seen.name}")
    return kept


def start_landing(messages: DataFrame, lake: medallion.Lake) -> None:
    """Land messages through the stream, by way of files in the envelope's form."""
    topic = f"{lake.root}/topic"
    spark = messages.sparkSession
    envelope = fixture.wrapped(messages)
    envelope.write.parquet(topic)
    stream = spark.readStream.schema(envelope.schema).parquet(topic)
    ingest.start_ingest(stream, lake.landing, f"{lake.root}/checkpoint", {"availableNow": True}).awaitTermination()


@query
def job_rerun_emptied_day(spark, sf_dir):
    """Two days are loaded, one is emptied in Silver and rerun: only the other has rows."""
    lake, emptied = _lake(spark, sf_dir, "emptied"), SCAN_DAY
    for day in (emptied, emptied + dt.timedelta(days=1)):
        medallion.run_day(spark, lake, day)
    silver = DayTable(spark, lake.silver)
    silver.publish(silver.read([emptied]).where(F.lit(False)), emptied)
    medallion.run_gold(spark, lake, emptied)
    medallion.run_load(spark, lake, emptied)
    return quality.table_counts(medallion.read_warehouse(spark, lake))


@query
def job_day(spark, sf_dir):
    """The daily jobs over one day, twice; each table holds the day's rows once."""
    lake = _lake(spark, sf_dir, "job")
    for _ in range(2):
        medallion.run_day(spark, lake, SCAN_DAY)
    return quality.table_counts(medallion.read_warehouse(spark, lake))


@query
def catalog_after_two_loads(spark, sf_dir):
    """Views made once, over tables of one day; a second day is loaded and another session reads them."""
    lake, later = _lake(spark, sf_dir, "lasting"), SCAN_DAY + dt.timedelta(days=1)
    database = f"paytrail_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database}")
    medallion.run_day(spark, lake, SCAN_DAY)
    for name in c.WAREHOUSE_TABLES:
        tables_catalog.create_table(spark, f"{database}.{name}", DayTable(spark, lake.warehouse(name)))
    tables_catalog.create_views(spark, database, lasting.DEFINITIONS)
    medallion.run_silver(spark, lake, later)
    medallion.run_gold(spark, lake, later)
    medallion.run_load(spark, lake, later, database)
    other = prepare(spark.newSession())
    found = other.table(f"{database}.v_fraud_by_type").unionByName(
        other.table(f"{database}.pipeline_health"), allowMissingColumns=True
    )
    path = shared_dir(spark, "lasting")
    found.write.parquet(path)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.read.parquet(path)


@query
def silver_job_metrics(spark, sf_dir):
    seen = medallion.run_silver(spark, _lake(spark, sf_dir, "silver-job"), SCAN_DAY)
    return spark.createDataFrame([seen])


@query
def dq_absent_day(spark, sf_dir):
    """Quality run of a day that only Silver has been made for."""
    lake = _lake(spark, sf_dir, "absent")
    medallion.run_silver(spark, lake, SCAN_DAY)
    return medallion.run_quality(spark, lake, SCAN_DAY, ["silver", "gold", "warehouse"])


@query
def dq_gate(spark, sf_dir):
    """The gate refuses a day that only Silver was made for; its stored report and verdict are readable."""
    lake = _lake(spark, sf_dir, "gate")
    medallion.run_silver(spark, lake, SCAN_DAY)
    try:
        medallion.quality_gate(spark, lake, SCAN_DAY, ["silver", "gold", "warehouse"])
        refused = False
    except tables.DataGateError:
        refused = True
    report = DayTable(spark, lake.quality).read([SCAN_DAY])
    return quality.verdict(report).withColumn("refused", F.lit(refused))


@query
def dq_report(spark, sf_dir):
    rows = _silver(spark, sf_dir)
    return quality.verdict(quality.run_checks({
        "bronze": lambda: quality.check_bronze(_messages(spark, sf_dir)),
        "silver": lambda: quality.check_silver(rows),
        "gold": lambda: quality.check_gold(*_gold(spark, sf_dir)),
        "warehouse": lambda: quality.check_warehouse(rows, _warehouse(spark, sf_dir)),
    }))
