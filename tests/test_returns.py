import datetime as dt
from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from frames import rows
from tagloom.operators import returns

DAY = dt.date(2024, 1, 31)
ORDERS = "user_id bigint, order_id bigint, pay_status int, pay_time string"
RETURNS = ("user_id bigint, returned_order_id bigint, return_status int, site_id int, "
           "returned_time bigint")


def at(days, time="12:00:00"):
    return f"{DAY + dt.timedelta(days)} {time}"


def seconds(days, second=0):
    day = dt.datetime.combine(DAY + dt.timedelta(days), dt.time(), dt.timezone.utc)
    return int(day.timestamp()) + second


def test_window_edges(spark):
    orders = spark.createDataFrame([
        (1, 10, 1, at(-31)), (1, 11, 1, at(-30, "00:00:00")), (1, 12, 3, at(0, "23:59:59")),
        (1, 13, 1, at(1, "00:00:00")), (1, 14, 2, at(0)), (1, 11, 1, at(-3))], ORDERS)
    assert rows(returns.paid_orders_window(orders, DAY)) == [(1, 2)]


def test_returns_need_status_site_day_and_a_paid_order(spark):
    orders = spark.createDataFrame(
        [(1, n, 1, at(-1)) for n in range(8)] + [(1, 8, 1, at(-40)), (2, 20, 1, at(-1)),
                                                 (None, 30, 1, at(-1)), (3, None, 1, at(-1))], ORDERS)
    returned = spark.createDataFrame([
        (1, 0, 8, 1, seconds(-30)), (1, 0, 8, 0, seconds(0)),   # counted once
        (1, 1, 0, 0, seconds(0, 86399)),
        (1, 2, 9, 0, seconds(0)),          # status
        (1, 3, 0, 2, seconds(0)),          # site
        (1, 4, 0, 0, seconds(-30, -1)),    # too early
        (1, 5, 0, 0, seconds(1)),          # too late
        (1, 8, 0, 0, seconds(0)),          # paid before the window
        (2, 7, 0, 0, seconds(0)),          # another user's order
        (None, 30, 0, 0, seconds(0)), (3, None, 0, 0, seconds(0))], RETURNS)
    assert rows(returns.returned_orders_window(orders, returned, DAY)) == [(1, 2)]
    assert rows(returns.tag_return_rate(orders, returned, DAY), "userid", "tagweight") == [
        (None, "0.0"), ("1", "0.25"), ("2", "0.0"), ("3", None)]


def test_keys_of_another_type(spark):
    orders = spark.createDataFrame([(1, 10, 1, at(0)), (None, 10, 1, at(0))], ORDERS)
    returned = spark.createDataFrame(
        [("1", "10", 0, 0, seconds(0)), ("x", "10", 0, 0, seconds(0))],
        RETURNS.replace("user_id bigint", "user_id string").replace("order_id bigint", "order_id string"))
    assert rows(returns.tag_return_rate(orders, returned, DAY), "userid", "tagweight") == [
        (None, "0.0"), ("1", "1.0")]


def test_half_up_rounding(spark):
    orders = spark.createDataFrame([(1, n, 1, at(0)) for n in range(200)], ORDERS)
    returned = spark.createDataFrame([(1, n, 0, 0, seconds(0)) for n in range(57)], RETURNS)
    assert rows(returns.tag_return_rate(orders, returned, DAY), "tagweight") == [("0.29",)]


def test_rate_is_exact_for_all_small_counts(spark):
    pairs = [(r, p) for p in range(1, 120) for r in range(p + 1)]
    df = spark.createDataFrame(pairs, "returned bigint, paid bigint")
    for r in df.selectExpr("*", f"{returns.RATE} AS rate").collect():
        exact = (Fraction(r.returned, r.paid) * 100 + Fraction(1, 2)).__floor__()
        assert r.rate == exact / 100 and 0 <= r.rate <= 1


ORDER = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([1, 2, 3, None]),
                  st.sampled_from([0, 1, 3]), st.integers(-32, 2))
RETURN = st.tuples(st.sampled_from([1, 2, None]), st.sampled_from([1, 2, 3, None]),
                   st.integers(0, 9), st.integers(0, 2), st.integers(-32, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ORDER, max_size=15), st.lists(RETURN, max_size=15))
def test_grouping_equals_the_join(spark, orders, returned):
    """The grouped form against counts made pair by pair."""
    paid = [(u, o) for u, o, status, day in orders if status in (1, 3) and -30 <= day <= 0]
    back = {(u, o) for u, o, status, site, day in returned
            if status <= 8 and site < 2 and -30 <= day <= 0 and u is not None and o is not None}
    expected = []
    for user in {u for u, _ in paid}:
        mine = {o for u, o in paid if u == user and o is not None}
        n = len({o for o in mine if (user, o) in back})
        rate = None if not mine else str(((200 * n + len(mine)) // (2 * len(mine))) / 100)
        expected.append((None if user is None else str(user), rate))
    result = returns.tag_return_rate(
        spark.createDataFrame([(u, o, s, at(d)) for u, o, s, d in orders], ORDERS),
        spark.createDataFrame([(u, o, s, w, seconds(d)) for u, o, s, w, d in returned], RETURNS), DAY)
    assert rows(result, "userid", "tagweight") == sorted(expected, key=lambda r: (r[0] is not None, r[0]))


def test_no_join_and_two_combining_shuffles(spark):
    orders = spark.createDataFrame([], ORDERS)
    plan = returns.tag_return_rate(orders, spark.createDataFrame([], RETURNS), DAY)
    text = plan._jdf.queryExecution().sparkPlan().toString()
    assert "Join" not in text and "partial_max" in text and "partial_count" in text
