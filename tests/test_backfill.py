"""Many days in one pass against the runs of single days."""

import datetime as dt
import random

import pytest

from frames import rows
from tagloom.functions.days import days_before, partition_value
from tagloom.operators import backfill, returns, sms
from tagloom.settings import ReturnSettings, SmsSettings

FIRST, LAST = dt.date(2024, 3, 1), dt.date(2024, 3, 31)
DAYS = [FIRST + dt.timedelta(n) for n in range(31)]
ORDERS = "user_id bigint, order_id bigint, pay_status int, pay_time string"
RETURNS = "user_id string, returned_order_id string, return_status int, site_id int, returned_time bigint"
SMS = "user_id bigint, status_code string, event_captured_dt timestamp"


def moment(rng, spread=90):
    return dt.datetime(2024, 1, 20) + dt.timedelta(days=rng.randrange(spread), hours=rng.randrange(24))


def order_tables(spark, seed, users, orders):
    """Orders paid and returned several times, at the edges of the windows, with missing keys and other statuses."""
    rng = random.Random(seed)
    paid = [(rng.choice([None, *range(users)]), rng.choice([None, *range(orders)]), rng.choice([0, 1, 1, 3, None]),
             rng.choice([None, str(moment(rng))]) if rng.random() < 0.1 else str(moment(rng))) for _ in range(500)]
    back = [(rng.choice(["x", None, *map(str, range(users))]), rng.choice([None, *map(str, range(orders))]),
             rng.randrange(-1, 11), rng.randrange(3),
             int(moment(rng).replace(tzinfo=dt.timezone.utc).timestamp())) for _ in range(300)]
    return spark.createDataFrame(paid, ORDERS), spark.createDataFrame(back, RETURNS)


def day_rows(df, day, *columns):
    return rows(df.filter(df.data_date == partition_value(day)), *columns)


@pytest.mark.parametrize("seed, users, orders, window", [(1, 5, 40, 30), (2, 40, 300, 30), (3, 3, 8, 2), (4, 6, 20, 0)])
def test_return_rates_equal_single_days(spark, seed, users, orders, window):
    settings = ReturnSettings(window_days=window)
    paid, back = (t.persist() for t in order_tables(spark, seed, users, orders))
    rates = backfill.tag_return_rate_days(paid, back, FIRST, LAST, settings).persist()
    counts = backfill.paid_orders_days(paid, back, FIRST, LAST, settings).persist()
    for day in DAYS[::6] if seed > 1 else DAYS[::2]:
        single = returns.tag_return_rate(paid, back, day, settings)
        assert day_rows(rates, day, *single.columns) == rows(single)
        assert (day_rows(counts, day, "user_id", "paid_orders")
                == rows(returns.paid_orders_window(paid, day, settings)))
        assert (day_rows(counts.filter("returned_orders > 0"), day, "user_id", "returned_orders")
                == rows(returns.returned_orders_window(paid, back, day, settings)))
    assert {r.data_date for r in rates.select("data_date").distinct().collect()} <= {partition_value(d) for d in DAYS}


def deliveries(spark, seed):
    rng = random.Random(seed)
    return spark.createDataFrame(
        [(rng.choice([None, *range(60)]), rng.choice(["0", "0", "2", "5", None, "9" if rng.random() < 0.1 else "0"]),
          None if rng.random() < 0.03 else moment(rng)) for _ in range(900)], SMS)


@pytest.mark.parametrize("seed, settings", [(1, SmsSettings()), (2, SmsSettings(window_days=0, min_failures=1)),
                                            (3, SmsSettings(window_days=5, min_failures=2))])
def test_blacklists_equal_a_chain_of_days(spark, seed, settings):
    log = deliveries(spark, seed).persist()
    before = spark.createDataFrame([("old",), (None,)] if seed == 1 else [], "userid string")
    days = DAYS if seed == 1 else DAYS[:9]
    lists = backfill.sms_blacklist_days(log, before if seed < 3 else None, FIRST, days[-1], settings).persist()
    failures = backfill.sms_repeat_failures_days(log, FIRST, days[-1], settings).persist()
    state = before.collect() if seed < 3 else None
    for n, day in enumerate(days):
        previous = None if state is None else spark.createDataFrame(state, "userid string")
        single = sms.sms_blacklist(log, previous, day, settings)
        state = [(r.userid,) for r in single.collect()]
        assert day_rows(lists, day, "userid") == sorted(state, key=lambda r: (r[0] is not None, r[0]))
        if n % 6 == 0:
            assert day_rows(failures, day, "userid", "num") == rows(sms.sms_repeat_failures(log, day, settings))
            assert day_rows(lists, day, *single.columns) == rows(single)


def test_empty_tables_and_one_day(spark):
    paid, back = order_tables(spark, 5, 4, 20)
    assert backfill.tag_return_rate_days(paid.limit(0), back.limit(0), FIRST, LAST).count() == 0
    assert backfill.sms_blacklist_days(deliveries(spark, 1).limit(0), None, FIRST, LAST).count() == 0
    one = backfill.tag_return_rate_days(paid, back, LAST, LAST)
    assert rows(one.drop("data_date")) == rows(returns.tag_return_rate(paid, back, LAST))
    assert days_before(LAST, 30) == FIRST


def test_the_sources_are_read_once(spark, tmp_path):
    deliveries(spark, 1).write.parquet(f"{tmp_path}/sms")
    log = spark.read.parquet(f"{tmp_path}/sms")
    plan = backfill.sms_repeat_failures_days(log, FIRST, LAST)._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Scan parquet") == 1
    assert "event_captured_dt" in plan.optimizedPlan().toString() and ">= 2024-02-16" in plan.optimizedPlan().toString()
