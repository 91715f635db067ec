from decimal import Decimal

from frames import rows
from tagloom.operators import paid

ORDERS = ("user_id bigint, order_id bigint, order_total_amount decimal(18,2), pay_status int, "
          "result_pay_time string")
INFO = "user_id bigint, paid_order_amount decimal(18,2), data_date string"


def orders(spark):
    return spark.createDataFrame([
        (1, 10, Decimal("5.10"), 1, "2024-01-01 10:00:00"),
        (1, 10, Decimal("5.10"), 3, "2024-01-03 10:00:00"),    # the same order again
        (1, 11, Decimal("1.00"), 2, "2024-01-09 10:00:00"),    # not paid
        (2, 20, Decimal("7.00"), 1, "2024-01-12 00:00:00"),    # after the day
        (3, 30, None, 1, None),
        (None, 40, Decimal("2.00"), 1, "2024-01-10 00:00:00"),
        (4, 50, Decimal("2.00"), None, "2024-01-10 00:00:00")], ORDERS)


def test_amounts_orders_and_days(spark):
    df = orders(spark)
    assert rows(paid.tag_total_paid_amount(df), "userid", "tagweight") == [
        (None, "2.00"), ("1", "10.20"), ("2", "7.00"), ("3", None)]
    assert rows(paid.tag_total_paid_orders(df), "userid", "tagweight") == [
        (None, "1"), ("1", "1"), ("2", "1"), ("3", "1")]
    assert rows(paid.tag_days_since_last_paid(df, "20240110"), "userid", "tagweight") == [
        (None, "0"), ("1", "7"), ("2", "-2"), ("3", None)]


def test_until_bounds_the_history(spark):
    df = orders(spark)
    assert rows(paid.tag_total_paid_amount(df, until="20240102"), "userid", "tagweight") == [("1", "5.10")]
    assert rows(paid.tag_total_paid_orders(df, until="20240110"), "userid", "tagweight") == [
        (None, "1"), ("1", "1")]
    assert rows(paid.tag_days_since_last_paid(df, "20240110", until="20240102"),
                "userid", "tagweight") == [("1", "9")]


def test_one_pass_equals_the_single_tags(spark):
    df = orders(spark)
    together = paid.paid_tags(df, "20240110")
    single = {"userid_all_paid_money": paid.tag_total_paid_amount(df),
              "userid_all_paid_times": paid.tag_total_paid_orders(df),
              "userid_last_paid": paid.tag_days_since_last_paid(df, "20240110")}
    for tagtype, expected in single.items():
        part = together.filter(together.tagtype == tagtype).drop("tagtype")
        assert rows(part) == rows(expected)


def test_registered_unpaid(spark):
    day = "20240110"
    info = spark.createDataFrame([
        (1, Decimal("0.00"), day), (1, None, day), (2, None, day), (3, Decimal("0.01"), day),
        (4, Decimal("-1.00"), day), (5, None, "20240109"), (None, None, day)], INFO)
    result = paid.tag_registered_unpaid(info, day)
    assert rows(result, "tagid", "userid", "tagweight") == [
        ("A220U088_001", None, ""), ("A220U088_001", "1", ""), ("A220U088_001", "2", "")]
