"""Parameters of the tag jobs.

Every default below is a fixed value: consumers of the tag table, or the
upstream tables, depend on it.  Callers override a value by passing their own
instance.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Tag id and tagtype partition of every tag.
RFM_USER_TAG_PREFIX = "A111U008_"
RFM_COOKIE_TAG_PREFIX = "A111H008_"
TAG_IDS = {
    "userid_all_paid_money": "A220U083_001",
    "userid_all_paid_times": "A220U087_001",
    "userid_last_paid": "A220U084_001",
    "userid_regist_notpaid": "A220U088_001",
    "return_goods_rate": "B220U071_001",
    "sms_blacklist": "B120U037_003",
}
RFM_USER_TAGTYPE = "rfm_model"
RFM_COOKIE_TAGTYPE = "cookie_rfm_model"

# pay_status codes of a paid order.
PAID_STATUSES = (1, 3)


@dataclass(frozen=True)
class RfmSettings:
    app_name: str = "JC"
    site_ids: tuple[int, ...] = (600, 900)
    near_days: int = 90
    frequent_orders: int = 3
    # Amount from which a user counts as high value, by country.
    high_amount: dict[str, float] = field(default_factory=lambda: {"ID": 50})
    high_amount_elsewhere: float = 300


@dataclass(frozen=True)
class ReturnSettings:
    window_days: int = 30
    return_statuses: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6, 7, 8)
    site_ids: tuple[int, ...] = (0, 1)
    paid_statuses: tuple[int, ...] = PAID_STATUSES


@dataclass(frozen=True)
class SmsSettings:
    window_days: int = 14
    min_failures: int = 3
    delivered_code: str = "0"
    hard_codes: tuple[str, ...] = ("1", "3", "9", "10", "12", "15", "19", "21")
