"""Shuffles, scans and pushed filters of the operators over stored tables."""

import re

import pytest

from tagloom.operators import cookie, paid, returns, rfm, sms

DAY = "20240131"
TABLES = {
    "orders": "user_id bigint, order_id bigint, order_total_amount decimal(18,2), pay_status int, "
              "pay_time string, result_pay_time string, other string",
    "returned": "user_id bigint, returned_order_id bigint, return_status int, site_id int, "
                "returned_time bigint, other string",
    "sms": "user_id bigint, status_code string, event_captured_dt timestamp, other string",
    "links": "cookie_id string, userid bigint, last_time string, last_date string, other string",
    "users": "user_id bigint, country string, site_id int, last_date string, "
             "paid_order_amount decimal(18,2), other string, data_date string",
    "consume": "user_id bigint, last_1y_paid_orders bigint, last_1y_paid_order_amount decimal(18,2), "
               "last_order_paid_time string, app_name string, other string, data_date string",
    "tags": "tagid string, userid string, other string, data_date string, tagtype string",
}
STORED_BY = {"users": ["data_date"], "consume": ["data_date"], "tags": ["data_date", "tagtype"]}


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("stored")
    found = {}
    for name, schema in TABLES.items():
        path = f"{base}/{name}"
        keys = {"data_date": DAY, "tagtype": "rfm_model"}
        row = tuple(keys.get(column.split()[0]) for column in re.split(r", ", schema))
        spark.createDataFrame([row], schema).write.partitionBy(*STORED_BY.get(name, [])).parquet(path)
        found[name] = spark.read.schema(schema).parquet(path)
    return found


OPERATORS = {
    # name: (operator, scans, shuffles)
    "total_amount": (lambda t: paid.tag_total_paid_amount(t["orders"]), 1, 1),
    "total_orders": (lambda t: paid.tag_total_paid_orders(t["orders"]), 1, 2),
    "days_since": (lambda t: paid.tag_days_since_last_paid(t["orders"], DAY), 1, 1),
    "paid_tags": (lambda t: paid.paid_tags(t["orders"], DAY), 1, 2),
    "unpaid": (lambda t: paid.tag_registered_unpaid(t["users"], DAY), 1, 1),
    "paid_window": (lambda t: returns.paid_orders_window(t["orders"], DAY), 1, 2),
    "returned_window": (lambda t: returns.returned_orders_window(t["orders"], t["returned"], DAY), 2, 2),
    "return_rate": (lambda t: returns.tag_return_rate(t["orders"], t["returned"], DAY), 2, 2),
    "repeat_failures": (lambda t: sms.sms_repeat_failures(t["sms"], DAY), 1, 1),
    "hard_failures": (lambda t: sms.sms_hard_failures(t["sms"]), 1, 1),
    "blacklist": (lambda t: sms.sms_blacklist(t["sms"], t["tags"], DAY), 2, 1),
    "binding": (lambda t: cookie.cookie_user_binding(t["links"]), 1, 1),
    "rfm_tags": (lambda t: rfm.rfm_user_tag(rfm.rfm_score(
        rfm.rfm_base(t["consume"], t["users"], DAY), DAY)), 2, 3),
    "cookie_tags": (lambda t: cookie.cookie_rfm_tag(
        t["tags"].filter(f"data_date = '{DAY}' AND tagtype = 'rfm_model'"),
        cookie.cookie_user_binding(t["links"])), 2, 4),
}


def physical(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", OPERATORS)
def test_scans_and_shuffles(stored, changed_conf, name):
    changed_conf(spark__sql__autoBroadcastJoinThreshold="-1")
    operator, scans, shuffles = OPERATORS[name]
    _, plan = physical(operator(stored))
    assert plan.count("FileScan") == scans
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert plan.count("Exchange ") == shuffles           # nothing goes to a single task
    for word in ("Python", "Cartesian", "NestedLoop", "Broadcast"):
        assert word not in plan
    assert "other" not in "".join(re.findall(r"ReadSchema: \S+", plan))


@pytest.mark.parametrize("name", ["total_amount", "days_since", "paid_tags", "unpaid", "return_rate",
                                  "repeat_failures", "blacklist"])
def test_groupings_combine_before_the_shuffle(stored, name):
    plan, _ = physical(OPERATORS[name][0](stored))
    aggregates = plan.count("Aggregate(")
    assert aggregates >= 2 and "SortAggregate" not in plan


@pytest.mark.parametrize("name, filters", [
    ("total_amount", ["In(pay_status, [1,3])"]),
    ("return_rate", ["GreaterThanOrEqual(pay_time,2024-01-01)", "LessThan(pay_time,2024-02-01)",
                     "GreaterThanOrEqual(returned_time,1704067200)", "LessThan(returned_time,1706745600)"]),
    ("repeat_failures", ["Not(EqualTo(status_code,0))", "GreaterThanOrEqual(event_captured_dt,2024-01-17"]),
    ("hard_failures", ["In(status_code, ["]),
    ("binding", ["IsNotNull(cookie_id)", "IsNotNull(userid)"]),
    ("rfm_tags", ["EqualTo(app_name,JC)", "In(site_id, [600,900])"]),
])
def test_filters_reach_the_scan(spark, stored, name, filters):
    df = OPERATORS[name][0](stored)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pushed = " ".join(line for line in text.splitlines() if "PushedFilters" in line)
    for expected in filters:
        assert expected in pushed


@pytest.mark.parametrize("name, keys", [("rfm_tags", 2), ("unpaid", 1), ("cookie_tags", 1)])
def test_partitions_are_pruned(spark, stored, name, keys):
    df = OPERATORS[name][0](stored)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    pruned = [line for line in text.splitlines() if "PartitionFilters" in line and DAY in line]
    assert len(pruned) == keys


def test_top_rows_are_cut_before_the_shuffle(stored):
    for name in ("binding", "rfm_tags"):
        _, plan = physical(OPERATORS[name][0](stored))
        assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan
