"""User segments carried over to the users' cookies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..commits import DayFolder
from ..functions.days import Day, days_before, in_days, until_day
from ..functions.tagrows import tag_rows
from ..settings import RFM_COOKIE_TAG_PREFIX, RFM_USER_TAG_PREFIX


def cookie_user_binding(relation: DataFrame, latest: bool = False) -> DataFrame:
    """(userid, cookieid): the one user each cookie is bound to.

    By default the oldest link wins and a link without a time counts as
    oldest; ``latest`` takes the newest one.  Equal links go to the highest
    user id.
    """
    def order(name: str) -> Column:
        return F.col(name).desc() if latest else F.col(name).asc()

    first = Window.partitionBy("cookie_id").orderBy(
        order("last_time"), order("last_date"), F.col("userid").desc())
    return (relation
            .filter(F.col("cookie_id").isNotNull() & F.col("userid").isNotNull())
            .select("userid", F.col("cookie_id").alias("cookieid"),
                    F.row_number().over(first).alias("_rank"))
            .filter("_rank = 1").drop("_rank"))


LINK = ("cookie_id", "last_time", "last_date", "userid")


def best_links(relation: DataFrame, latest: bool = False) -> DataFrame:
    """(cookie_id, last_time, last_date, userid): the link that decides each cookie's user.

    The same choice as ``cookie_user_binding`` by aggregates, which merge: the
    best link of best links of parts is the best link of all.
    """
    links = relation.filter("cookie_id IS NOT NULL AND userid IS NOT NULL").select(*LINK)
    if not latest:
        # Of equal times the highest user, so that the smallest triple has that one.
        links = links.groupBy(*LINK[:3]).agg(F.max("userid").alias("userid"))
    pick = F.max if latest else F.min
    return (links.groupBy("cookie_id").agg(pick(F.struct(*LINK[1:])).alias("link")).select("cookie_id", "link.*"))


def binding_of(links: DataFrame) -> DataFrame:
    """(userid, cookieid) of best links."""
    return links.select("userid", F.col("cookie_id").alias("cookieid"))


@dataclass(frozen=True)
class CookieLinks:
    """The best link of every cookie by day, each day merged from the day before and its own links.

    ``day_column`` holds the day on which a link comes in; links without one
    count on every day.  A rerun of a day replaces it; the days after it have
    to be rerun as well.
    """

    spark: SparkSession
    location: str
    latest: bool = False
    day_column: str = "last_time"

    @property
    def days(self) -> DayFolder:
        return DayFolder(self.spark, self.location)

    def run_day(self, relation: DataFrame, day: Day, bootstrap: bool = False) -> DataFrame:
        """Bring the links to ``day`` and return them; the first day takes in everything up to its end."""
        undated = F.col(self.day_column).isNull()
        yesterday = days_before(day, 1)
        if self.days.previous(yesterday, "links", bootstrap):
            today = relation.filter(in_days(relation, self.day_column, day, day) | undated).select(*LINK)
            links = today.unionByName(self.days.read(yesterday, "links"))
        else:
            links = relation.filter(until_day(relation, self.day_column, day) | undated)
        self.days.publish(day, {"links": best_links(links, self.latest)})
        return self.links(day)

    def links(self, day: Day) -> DataFrame:
        return self.days.read(day, "links")


def cookie_tag_id(user_tag: Column) -> Column:
    """The cookie tag for a user tag; unknown tags get the last segment."""
    known = [f"{RFM_USER_TAG_PREFIX}{n:03d}" for n in range(1, 8)]
    suffix = F.when(user_tag.isin(known), F.substring_index(user_tag, "_", -1)).otherwise("008")
    return F.concat(F.lit(RFM_COOKIE_TAG_PREFIX), suffix)


def cookie_rfm_tag(user_tags: DataFrame, binding: DataFrame) -> DataFrame:
    """Distinct (tag, cookie) rows for the RFM tags of bound users.

    A user's tags are made distinct first.  Each cookie has one user, so the
    join result is distinct as it stands, and both inputs reach the join as
    plain shuffles that adaptive execution can split for a user with very
    many cookies.
    """
    tags = user_tags.select(F.col("userid"), cookie_tag_id(F.col("tagid")).alias("tagid")).distinct()
    bound = binding.select(F.col("userid").cast("string").alias("userid"), "cookieid")
    return tag_rows(bound.join(tags, "userid"), F.col("tagid"), "cookieid", None, "cookieid")
