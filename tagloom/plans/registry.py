"""Every operator as a query over the sample tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.days import days_before, partition_value
from ..operators import backfill, cookie, paid, returns, rfm, sms
from ..operators.coverage import CoveredDays
from ..operators.paid_state import PaidState, paid_tags_of
from ..operators.writer import PathTagTable, PublishedTagTable
from ..session import STREAMING, scratch_dir, stored, with_settings
from ..sources import sample
from ..sources.kafka import after_ledger, union_streams
from ..sources.replay import table, table_stream
from ..streaming import events, rolling, runner, words
from ..streaming.late import WindowTable
from ..streaming.offsets import OffsetLedger, batch_offsets
from ..streaming.sinks import BatchFolder
from . import daily

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SECOND = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- user tags ---------------------------------------------------------------

def _rfm_base(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm_base(sample.user_consume_info(spark, folder),
                        sample.user_info(spark, folder), sample.RFM_DAY, sample.SAMPLE_RFM)


def _rfm_score(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm_score(_rfm_base(spark, folder), sample.RFM_DAY, sample.SAMPLE_RFM)


@query
def rfm_base(spark: SparkSession, folder: str) -> DataFrame:
    return _rfm_base(spark, folder).select(
        "user_id", "country", "last_1y_paid_orders",
        F.col("last_1y_paid_order_amount").cast("string").alias("last_1y_paid_order_amount"),
        F.col("last_pay_date").cast("string").alias("last_pay_date"))


@query
def rfm_score(spark: SparkSession, folder: str) -> DataFrame:
    return _rfm_score(spark, folder)


@query
def rfm_user_tag(spark: SparkSession, folder: str) -> DataFrame:
    return rfm.rfm_user_tag(_rfm_score(spark, folder))


@query
def cookie_user_binding(spark: SparkSession, folder: str) -> DataFrame:
    return cookie.cookie_user_binding(sample.cookie_user_relation(spark, folder))


@query
def cookie_user_binding_latest(spark: SparkSession, folder: str) -> DataFrame:
    return cookie.cookie_user_binding(sample.cookie_user_relation(spark, folder), latest=True)


@query
def cookie_rfm_tag(spark: SparkSession, folder: str) -> DataFrame:
    return cookie.cookie_rfm_tag(rfm_user_tag(spark, folder), cookie_user_binding(spark, folder))


@query
def tag_total_paid_amount(spark: SparkSession, folder: str) -> DataFrame:
    return paid.tag_total_paid_amount(sample.order_fact(spark, folder))


@query
def tag_total_paid_orders(spark: SparkSession, folder: str) -> DataFrame:
    return paid.tag_total_paid_orders(sample.order_lines(spark, folder))


@query
def tag_days_since_last_paid(spark: SparkSession, folder: str) -> DataFrame:
    return paid.tag_days_since_last_paid(sample.order_fact(spark, folder), sample.PAID_DAY)


@query
def paid_tags(spark: SparkSession, folder: str) -> DataFrame:
    return paid.paid_tags(sample.order_lines(spark, folder), sample.PAID_DAY)


@query
def tag_registered_unpaid(spark: SparkSession, folder: str) -> DataFrame:
    return paid.tag_registered_unpaid(sample.user_info(spark, folder), sample.RFM_DAY)


@query
def paid_orders_window(spark: SparkSession, folder: str) -> DataFrame:
    return returns.paid_orders_window(sample.order_lines(spark, folder), sample.RETURN_DAY)


@query
def returned_orders_window(spark: SparkSession, folder: str) -> DataFrame:
    return returns.returned_orders_window(
        sample.order_fact(spark, folder), sample.returned_order_info(spark, folder),
        sample.RETURN_DAY)


@query
def tag_return_rate(spark: SparkSession, folder: str) -> DataFrame:
    return returns.tag_return_rate(
        sample.order_fact(spark, folder), sample.returned_order_info(spark, folder),
        sample.RETURN_DAY)


@query
def sms_repeat_failures(spark: SparkSession, folder: str) -> DataFrame:
    return sms.sms_repeat_failures(sample.sms_delivered(spark, folder), sample.SMS_DAY)


@query
def sms_hard_failures(spark: SparkSession, folder: str) -> DataFrame:
    return sms.sms_hard_failures(sample.sms_delivered(spark, folder))


@query
def sms_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    """Two days, the second on top of the first."""
    log = sample.sms_delivered(spark, folder)
    first = sms.sms_blacklist(log, None, days_before(sample.SMS_DAY, 1))
    return sms.sms_blacklist(log, first, sample.SMS_DAY)


# --- the tag table -----------------------------------------------------------

def sample_sources(spark: SparkSession, folder: str) -> daily.Sources:
    return {name: lambda make=make: make(spark, folder) for name, make in {
        "order_fact": sample.order_fact, "user_info": sample.user_info,
        "user_consume_info": sample.user_consume_info,
        "returned_order_info": sample.returned_order_info,
        "sms_delivered": sample.sms_delivered,
        "cookie_user_relation": sample.cookie_user_relation}.items()}


@query
def tag_writer(spark: SparkSession, folder: str) -> DataFrame:
    """The payment partitions of one day, written twice."""
    tags = PathTagTable(spark, scratch_dir(spark, "tag_writer"))
    for _ in range(2):
        daily.run_paid_info(sample_sources(spark, folder), tags, sample.PAID_DAY)
    return tags.read()


@query
def tag_publish(spark: SparkSession, folder: str) -> DataFrame:
    """The payment partitions of one day by one commit, after a run of the day before's tags and a rerun."""
    tags = PublishedTagTable(spark, scratch_dir(spark, "tag_publish"))
    for day in (days_before(sample.PAID_DAY, 1), sample.PAID_DAY, sample.PAID_DAY):
        daily.run_paid_info(sample_sources(spark, folder), tags, day)
    return tags.read().where(F.col("data_date") == partition_value(sample.PAID_DAY))


@query
def sms_blacklist_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Two days through the table: each reads the partition before its own."""
    tags = PathTagTable(spark, scratch_dir(spark, "sms_blacklist"))
    sources = sample_sources(spark, folder)
    daily.run_sms_blacklist(sources, tags, days_before(sample.SMS_DAY, 1), bootstrap=True)
    daily.run_sms_blacklist(sources, tags, sample.SMS_DAY)
    return tags.partition(sample.SMS_DAY, "sms_blacklist")


@query
def cookie_rfm_chain(spark: SparkSession, folder: str) -> DataFrame:
    """User tags written to one table and carried into the cookie table."""
    tags = PathTagTable(spark, scratch_dir(spark, "rfm_users"))
    cookies = PathTagTable(spark, scratch_dir(spark, "rfm_cookies"), "cookieid")
    sources = sample_sources(spark, folder)
    daily.run_rfm(sources, tags, sample.RFM_DAY, settings=sample.SAMPLE_RFM)
    daily.run_cookie_rfm(sources, tags, cookies, sample.RFM_DAY)
    return cookies.read()


# --- states carried from day to day, and many days at once -------------------

STATE_DAYS = 4


@query
def paid_state_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Payments up to a day, then three days one by one, each on top of the day before.

    The payments are derived by a join that no day filter can get past, so it runs once and not for each day.
    """
    out = scratch_dir(spark, "paid_state")
    state = PaidState(spark, f"{out}/state")
    payments = stored(sample.order_payments(spark, folder), f"{out}/payments")
    for n in reversed(range(STATE_DAYS)):
        day = days_before(sample.PAID_DAY, n)
        totals = state.run_day(payments, day, bootstrap=n == STATE_DAYS - 1)
    return paid_tags_of(totals, day)


@query
def cookie_links_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Links up to a day, then three days one by one."""
    state = cookie.CookieLinks(spark, scratch_dir(spark, "cookie_links"))
    for n in reversed(range(STATE_DAYS)):
        links = state.run_day(sample.cookie_user_relation(spark, folder), days_before(sample.LINK_DAY, n),
                              bootstrap=n == STATE_DAYS - 1)
    return cookie.binding_of(links)


@query
def sms_blacklist_covered_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Blacklists that read only the days not covered yet; the log of one day comes a day late."""
    out = scratch_dir(spark, "sms_covered")
    tags, covered = PathTagTable(spark, f"{out}/tags"), CoveredDays(spark, f"{out}/covered")
    late = days_before(sample.SMS_DAY, 2)
    for n in reversed(range(STATE_DAYS)):
        day = days_before(sample.SMS_DAY, n)
        arrived = sample.sms_delivered(spark, folder)
        if day == late:
            arrived = arrived.where(F.col("event_captured_dt") < F.lit(late))
        daily.run_sms_blacklist({"sms_delivered": lambda arrived=arrived: arrived}, tags, day,
                                bootstrap=n == STATE_DAYS - 1, covered=covered, absent=[late] if day == late else [])
    return tags.partition(sample.SMS_DAY, "sms_blacklist")


@query
def return_rate_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """The return rates of 31 days from one pass."""
    return backfill.tag_return_rate_days(
        sample.order_fact(spark, folder), sample.returned_order_info(spark, folder),
        days_before(sample.RETURN_DAY, 30), sample.RETURN_DAY)


@query
def window_orders_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """Paid and returned orders of 31 windows from one pass; orders are paid over several days."""
    return backfill.paid_orders_days(
        sample.order_payments(spark, folder), sample.returned_order_info(spark, folder),
        days_before(sample.RETURN_DAY, 30), sample.RETURN_DAY)


@query
def sms_repeat_failures_backfill(spark: SparkSession, folder: str) -> DataFrame:
    return backfill.sms_repeat_failures_days(sample.sms_delivered(spark, folder),
                                             days_before(sample.SMS_DAY, 30), sample.SMS_DAY)


@query
def sms_blacklist_backfill(spark: SparkSession, folder: str) -> DataFrame:
    """The blacklists of 14 days, written by one job."""
    tags = PathTagTable(spark, scratch_dir(spark, "sms_backfill"))
    daily.run_sms_blacklist_days(sample_sources(spark, folder), tags, days_before(sample.SMS_DAY, 13), sample.SMS_DAY,
                                 bootstrap=True)
    return tags.read()


# --- streams -----------------------------------------------------------------

def _log_stream(spark: SparkSession, folder: str) -> DataFrame:
    return sample.kafka_log(table_stream(spark, folder, "events"))


@query
def stream_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of every batch, added up."""
    out = scratch_dir(spark, "word_count")
    sink = BatchFolder(spark, f"{out}/counts")
    runner.drain_batches(table_stream(spark, folder, "documents").select("text"),
                         words.word_count_handler(sink, "text"), out)
    return sink.read().groupBy("word").agg(F.sum("n").alias("n"))


def _timed(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("ts").cast("timestamp").alias("timestamp"),
                           F.col("event_type").alias("value"))


def _window_text(counts: DataFrame) -> DataFrame:
    return counts.select(F.date_format("window_start", SECOND).alias("window_start"),
                         F.date_format("window_end", SECOND).alias("window_end"), "word", "n")


@query
def stream_window_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """The windows the watermark has closed, then those that are open at the end of the input."""
    counts = words.window_word_counts(_timed(table_stream(spark, folder, "events")))
    closed, watermark, _ = runner.drain_closed(counts, scratch_dir(spark, "window_word_count"))
    still_open = words.open_window_counts(_timed(table(spark, folder, "events")), watermark)
    return _window_text(closed.unionByName(still_open))


@query
def stream_rolling_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """The same windows from one running total for each word."""
    session = with_settings(spark, STREAMING)
    counts = rolling.rolling_word_counts(_timed(table_stream(session, folder, "events")), lateness="1 minute")
    out = scratch_dir(spark, "rolling_word_count")
    closed, watermark, _ = runner.drain_closed(counts, out)
    closed = spark.read.schema(closed.schema).parquet(f"{out}/rows")  # by the caller's session
    still_open = words.open_window_counts(_timed(table(spark, folder, "events")), watermark)
    return _window_text(closed.unionByName(still_open))


@query
def stream_late_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of a stream whose messages come in no order at all: closed, corrected by the late words, and open."""
    out = scratch_dir(spark, "late_word_count")
    # Six batches with messages of all times in each.
    _timed(table(spark, folder, "events")).repartition(6, F.xxhash64("timestamp")).write.parquet(f"{out}/in/events.parquet")
    windows = WindowTable(spark, f"{out}/windows", lateness=600)
    runner.drain_batches(table_stream(spark, f"{out}/in", "events", files_per_batch=1), windows.handle, out)
    windows.correct()
    return _window_text(windows.counts().unionByName(windows.open_counts()))


@query
def window_word_count(spark: SparkSession, folder: str) -> DataFrame:
    """All windows, from the same plan over the whole table."""
    return _window_text(words.window_word_counts(_timed(table(spark, folder, "events"))))


@query
def stream_union(spark: SparkSession, folder: str) -> DataFrame:
    """Three inputs as one stream of messages."""
    inputs = [table_stream(spark, folder, name).select(F.lit(name).alias("source"),
                                                       F.col(text).alias("value"))
              for name, text in (("events", "event_type"), ("documents", "text"),
                                 ("conversations", "text"))]
    rows = runner.drain(union_streams(*inputs), scratch_dir(spark, "union"))
    return rows.groupBy("source").agg(
        F.count("*").alias("n"), F.sum(F.length("value")).alias("characters"))


@query
def stream_event_extract(spark: SparkSession, folder: str) -> DataFrame:
    parsed = events.extract_events(_log_stream(spark, folder), "partition", "offset")
    return runner.drain(parsed, scratch_dir(spark, "event_extract"))


@query
def stream_batch_append(spark: SparkSession, folder: str) -> DataFrame:
    """Events appended per batch, each batch delivered twice."""
    out = scratch_dir(spark, "batch_append")
    sink = BatchFolder(spark, f"{out}/events")
    append = events.append_handler(sink)
    runner.drain_batches(_log_stream(spark, folder), events.together(append, append), out)
    return sink.read().select("data_date", "cookies_num")


@query
def stream_two_runs_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs with checkpoints of their own share a sink and keep each other's batches."""
    out = scratch_dir(spark, "two_runs")
    sink = BatchFolder(spark, f"{out}/events")
    for run in (0, 1):
        part = _log_stream(spark, folder).where(F.col("offset") % 2 == run)
        runner.drain_batches(part, events.append_handler(sink), f"{out}/run{run}")
    return sink.read().select("data_date", "cookies_num")


@query
def stream_offset_ledger(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_dir(spark, "offset_ledger")
    ledger = OffsetLedger(spark, f"{out}/ledger")
    positions = _log_stream(spark, folder).select("topic", "partition", "offset")
    runner.drain_batches(positions, events.ledger_handler(ledger), out)
    return ledger.read()


@query
def stream_ledger_from_progress(spark: SparkSession, folder: str) -> DataFrame:
    """End offsets and row counts measured while the events are written; one partition is silent, one new."""
    out = scratch_dir(spark, "ledger_from_progress")
    ledger = OffsetLedger(spark, f"{out}/ledger")
    sink, counts = (BatchFolder(spark, f"{out}/{name}", kind) for name, kind in (
        ("events", events.EVENTS), ("counts", events.BATCH_COUNT)))
    start = [("events", partition, 0) for partition in (*range(7), 8)]
    handler = events.recorded(events.append_handler(sink), ledger, counts, start)
    runner.drain_batches(_log_stream(spark, folder), handler, out)
    total = counts.read().agg(F.sum("n").alias("batch_rows"))
    written = sink.read().agg(F.count("*").alias("events"))
    return ledger.counts().join(total.join(written, how="full"), how="full")


@query
def stream_merged_append(spark: SparkSession, folder: str) -> DataFrame:
    """Four runs share a sink, which is merged after each of them."""
    out = scratch_dir(spark, "merged_append")
    sink = BatchFolder(spark, f"{out}/events", events.EVENTS)
    for run in range(4):
        part = _log_stream(spark, folder).where(F.col("offset") % 4 == run)
        runner.drain_batches(part, events.append_handler(sink), f"{out}/run{run}")
        if run > 0:
            sink.merge(keep=0, runs=2)
    return sink.read().select("data_date", "cookies_num")


@query
def stream_batch_count(spark: SparkSession, folder: str) -> DataFrame:
    out = scratch_dir(spark, "batch_count")
    sink = BatchFolder(spark, f"{out}/counts")
    positions = _log_stream(spark, folder).select("offset")
    runner.drain_batches(positions, events.count_handler(sink), out)
    return sink.read().select(F.col("batch_id").cast("bigint").alias("batch_id"), "n")


@query
def stream_source_from_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """Seven partitions from the middle of their offsets, the first one, which no ledger knows, from its start."""
    log = sample.kafka_log(table(spark, folder, "events"))
    ledger = batch_offsets(log.where("partition > 0")).withColumn(
        "untilOffset", F.expr("untilOffset * partitionname div 8"))
    messages = after_ledger(_log_stream(spark, folder).select("topic", "partition", "offset"), ledger)
    rows = runner.drain(messages, scratch_dir(spark, "from_offsets"))
    return rows.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"))
