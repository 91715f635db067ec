"""The daily tag jobs: read the upstream tables, write tag partitions.

Each job rewrites the partitions of one day and can be repeated.  The cookie
job reads the RFM partition of the same day, the blacklist job reads its own
partition of the day before.

    spark-submit daily.py rfm 20240116 --tags dw.user_tags \
        --source user_consume_info=dw.consumption --source user_info=dw.users
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.functions.days import Day, days_before, parse_day
from tagloom.operators import backfill, cookie, paid, returns, rfm, sms
from tagloom.operators.coverage import CoveredDays, without_days
from tagloom.operators.paid_state import PaidState, paid_tags_of
from tagloom.operators.writer import CatalogTagTable, PathTagTable, PublishedTagTable, TagTable
from tagloom.session import build_session
from tagloom.settings import (RFM_COOKIE_TAGTYPE, RFM_USER_TAGTYPE, ReturnSettings, RfmSettings,
                              SmsSettings)

Sources = Mapping[str, Callable[[], DataFrame]]
Written = dict[str, int]
PAID_TAGTYPES = ("userid_all_paid_money", "userid_all_paid_times", "userid_last_paid")
UNPAID_TAGTYPE = "userid_regist_notpaid"


def run_rfm(sources: Sources, tags: TagTable, day: Day, recency_as_of: Day | None = None,
            settings: RfmSettings = RfmSettings()) -> Written:
    """RFM tags of users.  Recency counts to the snapshot day unless given."""
    base = rfm.rfm_base(sources["user_consume_info"](), sources["user_info"](), day, settings)
    scores = rfm.rfm_score(base, recency_as_of or day, settings)
    return tags.overwrite(rfm.rfm_user_tag(scores), day, RFM_USER_TAGTYPE)


def run_cookie_rfm(sources: Sources, tags: TagTable, cookie_tags: TagTable, day: Day,
                   links: cookie.CookieLinks | None = None, bootstrap: bool = False) -> Written:
    """The day's RFM tags, moved to the cookies of the users.

    With ``links`` only the day's own links are read, on top of the day before.
    """
    relation = sources["cookie_user_relation"]()
    if links is None:
        binding = cookie.cookie_user_binding(relation)
    else:
        binding = cookie.binding_of(links.run_day(relation, day, bootstrap))
    rows = cookie.cookie_rfm_tag(tags.partition(day, RFM_USER_TAGTYPE), binding)
    return cookie_tags.overwrite(rows, day, RFM_COOKIE_TAGTYPE)


def run_paid_info(sources: Sources, tags: TagTable, day: Day, state: PaidState | None = None,
                  bootstrap: bool = False) -> Written:
    """The three payment tags and the users who never paid, written together.

    With ``state`` only the day's own payments are read, on top of the day before.
    """
    unpaid = paid.tag_registered_unpaid(sources["user_info"](), day).withColumn(
        "tagtype", F.lit(UNPAID_TAGTYPE))
    orders = sources["order_fact"]()
    if state is None:
        rows = paid.paid_tags(orders, day)
    else:
        rows = paid_tags_of(state.run_day(orders, day, bootstrap), day)
    return tags.overwrite(rows.unionByName(unpaid), day, [*PAID_TAGTYPES, UNPAID_TAGTYPE])


def run_return_rate(sources: Sources, tags: TagTable, day: Day,
                    settings: ReturnSettings = ReturnSettings()) -> Written:
    rates = returns.tag_return_rate(sources["order_fact"](), sources["returned_order_info"](),
                                    day, settings)
    return tags.overwrite(rates, day, "return_goods_rate")


def run_return_rate_days(sources: Sources, tags: TagTable, first: Day, last: Day,
                         settings: ReturnSettings = ReturnSettings()) -> Written:
    """The return rates of every day in [first, last] from one pass."""
    rates = backfill.tag_return_rate_days(sources["order_fact"](), sources["returned_order_info"](),
                                          first, last, settings)
    return tags.overwrite_days(rates, first, last, "return_goods_rate")


def run_sms_blacklist(sources: Sources, tags: TagTable, day: Day, bootstrap: bool = False,
                      settings: SmsSettings = SmsSettings(), covered: CoveredDays | None = None,
                      absent: Sequence[Day] = (), fill_gaps: bool = False) -> Written:
    """Today's blacklist on top of yesterday's partition of the same table.

    Without ``covered`` the whole log is searched for permanent failures.
    With it only the days that yesterday's list does not hold are; ``absent``
    names days whose log has not arrived, which stay uncovered.
    """
    previous = tags.previous_state(days_before(day, 1), "sms_blacklist", bootstrap)
    to_read = None if covered is None else covered.to_read(day, bootstrap and previous is None, fill_gaps or bool(absent))
    rows = sms.sms_blacklist(sources["sms_delivered"](), previous, day, settings, to_read)
    written = tags.overwrite(rows, day, "sms_blacklist")
    if covered is not None:
        held = covered.of(days_before(day, 1)) if previous is not None else []
        covered.record(day, without_days([*held, *to_read], absent))
    return written


def run_sms_blacklist_days(sources: Sources, tags: TagTable, first: Day, last: Day, bootstrap: bool = False,
                           settings: SmsSettings = SmsSettings()) -> Written:
    """The blacklists of every day in [first, last] from one pass, on top of the day before ``first``."""
    previous = tags.previous_state(days_before(first, 1), "sms_blacklist", bootstrap)
    rows = backfill.sms_blacklist_days(sources["sms_delivered"](), previous, first, last, settings)
    return tags.overwrite_days(rows, first, last, "sms_blacklist")


def _source(spark: SparkSession, name: str) -> Callable[[], DataFrame]:
    return lambda: spark.read.parquet(name) if "/" in name else spark.table(name)


def _tag_table(spark: SparkSession, name: str, owner: str, published: bool = False) -> TagTable:
    kind = CatalogTagTable if "/" not in name else PublishedTagTable if published else PathTagTable
    return kind(spark, name, owner)


def main(argv: list[str] | None = None) -> Written:
    parser = argparse.ArgumentParser(description="daily tag jobs")
    parser.add_argument("job", choices=["rfm", "cookie-rfm", "paid-info", "return-rate",
                                        "sms-blacklist"])
    parser.add_argument("day", type=parse_day, help="yyyyMMdd")
    parser.add_argument("--tags", required=True, help="user tag table or path")
    parser.add_argument("--cookie-tags", help="cookie tag table or path")
    parser.add_argument("--published", action="store_true",
                        help="tag tables under a path appear by one commit for each day")
    parser.add_argument("--source", action="append", default=[], metavar="NAME=TABLE",
                        help="table or path of an upstream table")
    parser.add_argument("--recency-as-of", type=parse_day)
    parser.add_argument("--bootstrap", action="store_true", help="first day of a blacklist or state")
    parser.add_argument("--until", type=parse_day, metavar="DAY",
                        help="return-rate, sms-blacklist: all days up to this one, in one pass")
    parser.add_argument("--state", metavar="PATH",
                        help="paid-info, cookie-rfm: read one day on top of the state of the day before; "
                             "sms-blacklist: read only days that are not covered yet")
    parser.add_argument("--absent", action="append", default=[], type=parse_day, metavar="DAY",
                        help="sms-blacklist: a day whose log has not arrived")
    parser.add_argument("--fill-gaps", action="store_true", help="sms-blacklist: read days missing between covered ones")
    parser.add_argument("--hive", action="store_true", help="use the Hive metastore")
    args = parser.parse_args(argv)

    catalog = {"spark.sql.catalogImplementation": "hive"} if args.hive else {}
    spark = build_session(f"tags-{args.job}", **catalog)
    sources = {name: _source(spark, target)
               for name, target in (item.split("=", 1) for item in args.source)}
    tags = _tag_table(spark, args.tags, "userid", args.published)
    if args.job == "rfm":
        return run_rfm(sources, tags, args.day, args.recency_as_of)
    if args.job == "cookie-rfm":
        if not args.cookie_tags:
            parser.error("cookie-rfm needs --cookie-tags")
        links = cookie.CookieLinks(spark, args.state) if args.state else None
        return run_cookie_rfm(sources, tags, _tag_table(spark, args.cookie_tags, "cookieid", args.published),
                              args.day, links, args.bootstrap)
    if args.job == "paid-info":
        state = PaidState(spark, args.state) if args.state else None
        return run_paid_info(sources, tags, args.day, state, args.bootstrap)
    if args.job == "return-rate":
        if args.until:
            return run_return_rate_days(sources, tags, args.day, args.until)
        return run_return_rate(sources, tags, args.day)
    if args.until:
        if args.state:
            parser.error("--until reads the whole log; it goes without --state")
        return run_sms_blacklist_days(sources, tags, args.day, args.until, args.bootstrap)
    covered = CoveredDays(spark, args.state) if args.state else None
    return run_sms_blacklist(sources, tags, args.day, args.bootstrap, covered=covered, absent=args.absent,
                             fill_gaps=args.fill_gaps)


if __name__ == "__main__":
    print(main())
