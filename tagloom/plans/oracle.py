"""The same results in plain SQL over the sample tables.

Written apart from the operators: joins where they group, windows where they
aggregate, and a JSON reader of its own.
"""

from __future__ import annotations

_CTES = {
    "order_fact": """
        SELECT o_custkey AS user_id, o_orderkey AS order_id,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
               CAST(o_orderdate AS DATE) AS pay_day, o_orderdate AS pay_time
        FROM orders WHERE o_orderstatus IN ('F', 'O')""",
    "order_lines": """
        SELECT f.* FROM order_fact f LEFT JOIN lineitem l ON l.l_orderkey = f.order_id""",
    "user_info": """
        SELECT c_custkey AS user_id,
               CASE n_nationkey WHEN 3 THEN 'ID' WHEN 7 THEN NULL ELSE n_name END AS country,
               CASE c_mktsegment WHEN 'FURNITURE' THEN 600 WHEN 'BUILDING' THEN 900 ELSE 100 END
                   AS site_id,
               CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal < 100 THEN NULL ELSE c_acctbal END
                   AS paid_order_amount
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "consume": """
        SELECT user_id, count(DISTINCT order_id) AS orders, sum(amount) AS amount,
               max(pay_day) AS last_day
        FROM order_fact WHERE pay_time > TIMESTAMP '2000-07-01 00:00:00' GROUP BY user_id""",
    "base": """
        SELECT c.user_id, u.country, c.orders, c.amount, c.last_day
        FROM consume c LEFT JOIN user_info u
          ON u.user_id = c.user_id AND u.site_id IN (600, 900) AND u.country IS NOT NULL""",
    "score": """
        SELECT user_id,
               CASE WHEN date_diff('day', last_day, DATE '2001-07-31') < 90 THEN 'near' ELSE 'far' END
                   AS recency,
               CASE WHEN orders < 3 THEN 'low' ELSE 'high' END AS frequency,
               CASE WHEN country = 'ID' AND amount < 200000 THEN 'low'
                    WHEN country <> 'ID' AND amount < 450000 THEN 'low' ELSE 'high' END AS monetary
        FROM base WHERE country IS NOT NULL""",
    "cells": """
        SELECT * FROM (VALUES ('near','high','high','001'), ('far','high','high','002'),
            ('near','low','high','003'), ('far','low','high','004'), ('near','high','low','005'),
            ('far','high','low','006'), ('near','low','low','007'), ('far','low','low','008'))
            AS t(recency, frequency, monetary, cell)""",
    "user_rfm": """
        SELECT user_id, cell FROM score JOIN cells USING (recency, frequency, monetary)""",
    "links": """
        SELECT 'ck' || CAST(event_id % 800 AS VARCHAR) AS cookie_id, user_id, ts, event_id
        FROM events""",
    "binding": """
        SELECT cookie_id, user_id FROM (
            SELECT *, row_number() OVER (PARTITION BY cookie_id
                ORDER BY ts ASC NULLS FIRST, event_id ASC NULLS FIRST, user_id DESC) AS place
            FROM links) t WHERE place = 1""",
    "returned": """
        SELECT o_custkey AS user_id, o_orderkey AS order_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_linenumber BETWEEN 0 AND 8 AND l_suppkey % 3 IN (0, 1)
          AND CAST(o_orderdate + to_days(CAST(5 * l_linenumber AS INTEGER)) AS DATE)
              BETWEEN DATE '2001-06-01' AND DATE '2001-07-01'""",
    "window_orders": """
        SELECT user_id, order_id FROM order_fact
        WHERE pay_day BETWEEN DATE '2001-06-01' AND DATE '2001-07-01'""",
    "paid_window": """
        SELECT user_id, count(DISTINCT order_id) AS paid_orders FROM window_orders GROUP BY user_id""",
    "returned_window": """
        SELECT r.user_id, count(DISTINCT r.order_id) AS returned_orders
        FROM returned r JOIN window_orders o ON o.user_id = r.user_id AND o.order_id = r.order_id
        GROUP BY r.user_id""",
    "sms": """
        SELECT user_id, CAST(ts AS DATE) AS day,
               CASE WHEN event_type = 'error' AND json_extract_string(props, '$.k') = '9' THEN '9'
                    WHEN event_type = 'error' AND event_id % 4 = 0 THEN '2' ELSE '0' END AS code
        FROM events""",
    "sms_repeat": """
        SELECT user_id, count(*) AS num FROM sms
        WHERE code <> '0' AND day BETWEEN DATE '2024-01-02' AND DATE '2024-01-16'
        GROUP BY user_id HAVING count(*) >= 3""",
    "sms_hard": """
        SELECT DISTINCT user_id FROM sms
        WHERE code IN ('1', '3', '9', '10', '12', '15', '19', '21')""",
    "sms_hard_until": """
        SELECT DISTINCT user_id FROM sms WHERE day <= DATE '2024-01-16'
          AND code IN ('1', '3', '9', '10', '12', '15', '19', '21')""",
    "sms_listed": """
        SELECT user_id FROM sms_repeat UNION SELECT user_id FROM sms_hard
        UNION SELECT user_id FROM sms
        WHERE code <> '0' AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'
        GROUP BY user_id HAVING count(*) >= 3""",
    "paid_rows": """
        SELECT user_id, sum(amount) AS amount, count(DISTINCT order_id) AS orders,
               date_diff('day', max(pay_day), DATE '2001-07-31') AS days
        FROM {orders} GROUP BY user_id""",
    "payments": """
        SELECT f.user_id, f.order_id, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
               CAST(f.pay_time + to_days(CAST(l_linenumber AS INTEGER)) AS DATE) AS pay_day
        FROM order_fact f JOIN lineitem ON l_orderkey = f.order_id""",
    "paid_rows_until": """
        SELECT user_id, sum(amount) AS amount, count(DISTINCT order_id) AS orders,
               date_diff('day', max(pay_day), DATE '2001-07-31') AS days
        FROM payments WHERE pay_day <= DATE '2001-07-31' GROUP BY user_id""",
    "return_days": """
        SELECT CAST(d AS DATE) AS as_of FROM range(DATE '2001-06-01', DATE '2001-07-02', INTERVAL 1 DAY) t(d)""",
    "returned_any": """
        SELECT o_custkey AS user_id, o_orderkey AS order_id,
               CAST(o_orderdate + to_days(CAST(5 * l_linenumber AS INTEGER)) AS DATE) AS return_day
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_returnflag = 'R' AND l_linenumber BETWEEN 0 AND 8 AND l_suppkey % 3 IN (0, 1)""",
    "day_orders": """
        SELECT as_of, user_id, order_id, bool_or(back) AS back FROM (
            SELECT as_of, p.user_id, p.order_id, r.order_id IS NOT NULL AS back
            FROM return_days JOIN {paid} p ON p.pay_day BETWEEN as_of - 30 AND as_of
            LEFT JOIN returned_any r ON r.user_id = p.user_id AND r.order_id = p.order_id
                AND r.return_day BETWEEN as_of - 30 AND as_of) t GROUP BY ALL""",
    "day_counts": """
        SELECT as_of, user_id, count(*) AS paid_orders, count_if(back) AS returned_orders
        FROM day_orders GROUP BY as_of, user_id""",
    "sms_days": """
        SELECT CAST(d AS DATE) AS as_of FROM range({from}, DATE '2024-01-17', INTERVAL 1 DAY) t(d)""",
    "sms_day_repeat": """
        SELECT as_of, user_id, count(*) AS num FROM sms_days
        JOIN sms ON code <> '0' AND day BETWEEN as_of - 14 AND as_of
        GROUP BY as_of, user_id HAVING count(*) >= 3""",
    "messages": """
        SELECT event_id, event_id % 8 AS part, event_id // 8 AS off,
          CASE WHEN event_id % 50 = 7 THEN 'not json' ELSE
            '{"i":{"timestamp":' ||
            CASE event_id % 50
              WHEN 23 THEN '"yesterday"'
              WHEN 29 THEN '"' || CAST((epoch_us(ts) // 1000) // 1000 AS VARCHAR) || '"'
              ELSE CAST((epoch_us(ts) // 1000) // 1000 AS VARCHAR) END || '}' ||
            CASE event_id % 50
              WHEN 11 THEN '' WHEN 13 THEN ',"d":"none"' WHEN 17 THEN ',"d":{"d":null}'
              WHEN 19 THEN ',"d":{"d":"u' || CAST(user_id AS VARCHAR) || '##x"}'
              WHEN 31 THEN ',"d":{"d":""}'
              ELSE ',"d":{"d":"u' || CAST(user_id AS VARCHAR) || '"}' END || '}' END AS value
        FROM events""",
    "checked": """
        SELECT part, off, CASE WHEN json_valid(value) THEN value END AS v FROM messages""",
    "fields": """
        SELECT part, off,
               TRY_CAST(json_extract_string(v, '$.i.timestamp') AS BIGINT) AS seconds,
               CASE WHEN json_type(v, '$.d') = 'OBJECT'
                    THEN coalesce(split_part(json_extract_string(v, '$.d.d'), '##', 1), 'null')
                    END AS device
        FROM checked""",
    "extracted": """
        SELECT part, off,
               coalesce(strftime(epoch_ms(seconds * 1000), '%Y-%m-%d %H:%M:%S'), '(unknown)')
                   AS data_date,
               coalesce(nullif(device, ''), '(unknown)') AS cookies_num
        FROM fields""",
    "slid": """
        SELECT event_type AS word, ts,
               (epoch_us(ts) // 1000) // 2000 * 2000 - 2000 * k + 60000 AS end_ms
        FROM events, range(0, 30) AS r(k)""",
}


def _with(names: str, body: str, **values: str) -> str:
    ctes = ", ".join(f"{name} AS ({_CTES[name]})" for name in names.split())
    text = f"WITH {ctes} {body}"
    for key, value in values.items():
        text = text.replace("{" + key + "}", value)
    return text


def _tag(tagid: str, owner: str, weight: str = "''", name: str = "userid") -> str:
    return (f"{tagid} AS tagid, CAST({owner} AS VARCHAR) AS {name}, "
            f"CAST({weight} AS VARCHAR) AS tagweight, '' AS tagranking, '' AS reserve, "
            "'' AS reserve1")


_RFM = "order_fact user_info consume base score cells user_rfm"
_RETURNS = "order_fact returned window_orders paid_window returned_window"
_MESSAGES = "messages checked fields extracted"
_PAID = (f"SELECT {_tag(chr(39) + 'A220U083_001' + chr(39), 'user_id', 'amount')}, "
         "'userid_all_paid_money' AS tagtype FROM paid_rows UNION ALL "
         f"SELECT {_tag(chr(39) + 'A220U087_001' + chr(39), 'user_id', 'orders')}, "
         "'userid_all_paid_times' FROM paid_rows UNION ALL "
         f"SELECT {_tag(chr(39) + 'A220U084_001' + chr(39), 'user_id', 'days')}, "
         "'userid_last_paid' FROM paid_rows")
_UNPAID = (f"SELECT DISTINCT {_tag(chr(39) + 'A220U088_001' + chr(39), 'user_id')} "
           "FROM user_info WHERE paid_order_amount = 0 OR paid_order_amount IS NULL")
_BLACKLIST = _with("sms sms_repeat sms_hard sms_listed",
                   f"SELECT {_tag(chr(39) + 'B120U037_003' + chr(39), 'user_id')} {{extra}} "
                   "FROM sms_listed")
_COOKIE = _with(_RFM + " links binding",
                f"SELECT DISTINCT {_tag(chr(39) + 'A111H008_' + chr(39) + ' || cell', 'cookie_id', name='cookieid')} "
                "{extra} FROM user_rfm JOIN binding USING (user_id)")
_WINDOWS = """
    SELECT strftime(epoch_ms(end_ms - 60000), '%Y-%m-%d %H:%M:%S') AS window_start,
           strftime(epoch_ms(end_ms), '%Y-%m-%d %H:%M:%S') AS window_end, word, count(*) AS n
    FROM slid GROUP BY end_ms, word"""


def _partition(day: str, tagtype: str) -> str:
    return f", '{day}' AS data_date, '{tagtype}' AS tagtype"


ORACLE: dict[str, str] = {
    "rfm_base": _with("order_fact user_info consume base", """
        SELECT user_id, country, orders AS last_1y_paid_orders,
               CAST(amount AS VARCHAR) AS last_1y_paid_order_amount,
               CAST(last_day AS VARCHAR) AS last_pay_date FROM base"""),
    "rfm_score": _with("order_fact user_info consume base score", "SELECT * FROM score"),
    "rfm_user_tag": _with(_RFM, f"SELECT {_tag(chr(39) + 'A111U008_' + chr(39) + ' || cell', 'user_id')} "
                                "FROM user_rfm"),
    "cookie_user_binding": _with("links binding",
                                 "SELECT user_id AS userid, cookie_id AS cookieid FROM binding"),
    "cookie_user_binding_latest": _with("links", """
        SELECT user_id AS userid, cookie_id AS cookieid FROM (
            SELECT *, row_number() OVER (PARTITION BY cookie_id
                ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST, user_id DESC) AS place
            FROM links) t WHERE place = 1"""),
    "cookie_rfm_tag": _COOKIE.replace("{extra}", ""),
    "cookie_rfm_chain": _COOKIE.replace("{extra}", _partition("20010731", "cookie_rfm_model")),
    "tag_total_paid_amount": _with("order_fact", f"""
        SELECT {_tag("'A220U083_001'", 'user_id', 'sum(amount)')} FROM order_fact GROUP BY user_id"""),
    "tag_total_paid_orders": _with("order_fact order_lines", f"""
        SELECT {_tag("'A220U087_001'", 'user_id', 'count(DISTINCT order_id)')}
        FROM order_lines GROUP BY user_id"""),
    "tag_days_since_last_paid": _with("order_fact", f"""
        SELECT DISTINCT {_tag("'A220U084_001'", 'user_id', "date_diff('day', pay_day, DATE '2001-07-31')")}
        FROM (SELECT user_id, pay_day, row_number() OVER (PARTITION BY user_id
              ORDER BY pay_time DESC NULLS LAST) AS place FROM order_fact) t WHERE place = 1"""),
    "paid_tags": _with("order_fact order_lines paid_rows", _PAID, orders="order_lines"),
    "tag_registered_unpaid": _with("user_info", _UNPAID),
    "paid_orders_window": _with("order_fact window_orders paid_window", "SELECT * FROM paid_window"),
    "returned_orders_window": _with(_RETURNS, "SELECT * FROM returned_window"),
    "tag_return_rate": _with(_RETURNS, f"""
        SELECT {_tag("'B220U071_001'", 'coalesce(r.user_id, p.user_id)',
                     "((200 * coalesce(returned_orders, 0) + paid_orders) // (2 * paid_orders)) / 100")}
        FROM paid_window p FULL JOIN returned_window r ON r.user_id = p.user_id"""),
    "sms_repeat_failures": _with("sms sms_repeat",
                                 "SELECT CAST(user_id AS VARCHAR) AS userid, num FROM sms_repeat"),
    "sms_hard_failures": _with("sms sms_hard",
                               "SELECT CAST(user_id AS VARCHAR) AS userid FROM sms_hard"),
    "sms_blacklist": _BLACKLIST.replace("{extra}", ""),
    "sms_blacklist_chain": _BLACKLIST.replace("{extra}", _partition("20240116", "sms_blacklist")),
    "paid_state_chain": _with("order_fact payments paid_rows_until", _PAID).replace(
        "FROM paid_rows", "FROM paid_rows_until"),
    "cookie_links_chain": _with("links binding",
                                "SELECT user_id AS userid, cookie_id AS cookieid FROM binding"),
    "sms_blacklist_covered_chain": _with("sms sms_days sms_day_repeat sms_hard_until", f"""
        SELECT {_tag(chr(39) + 'B120U037_003' + chr(39), 'user_id')} {_partition('20240116', 'sms_blacklist')}
        FROM (SELECT user_id FROM sms_day_repeat UNION SELECT user_id FROM sms_hard_until) t""",
                                         **{"from": "DATE '2024-01-13'"}),
    "return_rate_backfill": _with("order_fact return_days returned_any day_orders day_counts", f"""
        SELECT {_tag("'B220U071_001'", 'user_id', "((200 * returned_orders + paid_orders) // (2 * paid_orders)) / 100")},
               strftime(as_of, '%Y%m%d') AS data_date FROM day_counts""", paid="order_fact"),
    "window_orders_backfill": _with("order_fact payments return_days returned_any day_orders day_counts", """
        SELECT user_id, paid_orders, returned_orders, strftime(as_of, '%Y%m%d') AS data_date FROM day_counts""",
                                    paid="payments"),
    "sms_repeat_failures_backfill": _with("sms sms_days sms_day_repeat", """
        SELECT CAST(user_id AS VARCHAR) AS userid, num, strftime(as_of, '%Y%m%d') AS data_date
        FROM sms_day_repeat""", **{"from": "DATE '2023-12-17'"}),
    "sms_blacklist_backfill": _with("sms sms_days sms_day_repeat sms_hard", f"""
        SELECT {_tag(chr(39) + 'B120U037_003' + chr(39), 'user_id')}, strftime(d.as_of, '%Y%m%d') AS data_date,
               'sms_blacklist' AS tagtype
        FROM sms_days d JOIN (SELECT user_id, min(as_of) AS since FROM (
            SELECT user_id, as_of FROM sms_day_repeat
            UNION ALL SELECT user_id, DATE '2024-01-03' FROM sms_hard) u GROUP BY user_id) l
          ON l.since <= d.as_of""", **{"from": "DATE '2024-01-03'"}),
    "tag_writer": _with("order_fact user_info paid_rows", f"""
        SELECT *, '20010731' AS data_date FROM ({_PAID} UNION ALL
        SELECT *, 'userid_regist_notpaid' FROM ({_UNPAID}) u) t""", orders="order_fact"),
    "tag_publish": _with("order_fact user_info paid_rows", f"""
        SELECT *, '20010731' AS data_date FROM ({_PAID} UNION ALL
        SELECT *, 'userid_regist_notpaid' FROM ({_UNPAID}) u) t""", orders="order_fact"),
    "stream_word_count": """
        SELECT word, count(*) AS n FROM (
            SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
                               ELSE string_split(rtrim(text, ' '), ' ') END) AS word
            FROM documents) t GROUP BY word""",
    "stream_window_word_count": _with("slid", _WINDOWS),
    "stream_rolling_word_count": _with("slid", _WINDOWS),
    "stream_late_word_count": _with("slid", _WINDOWS),
    "window_word_count": _with("slid", _WINDOWS),
    "stream_union": """
        SELECT source, count(*) AS n, CAST(sum(length(value)) AS BIGINT) AS characters FROM (
            SELECT 'events' AS source, event_type AS value FROM events
            UNION ALL SELECT 'documents', text FROM documents
            UNION ALL SELECT 'conversations', text FROM conversations) t GROUP BY source""",
    "stream_event_extract": _with(_MESSAGES, """
        SELECT CAST(part AS INTEGER) AS partition, off AS "offset", data_date, cookies_num
        FROM extracted"""),
    "stream_batch_append": _with(_MESSAGES, "SELECT data_date, cookies_num FROM extracted"),
    "stream_two_runs_append": _with(_MESSAGES, "SELECT data_date, cookies_num FROM extracted"),
    "stream_offset_ledger": """
        SELECT 'events' AS topic, CAST(event_id % 8 AS INTEGER) AS partitionname,
               max(event_id // 8) + 1 AS "untilOffset" FROM events GROUP BY event_id % 8""",
    "stream_merged_append": _with(_MESSAGES, "SELECT data_date, cookies_num FROM extracted"),
    "stream_ledger_from_progress": """
        SELECT 'events' AS topic, CAST(p AS INTEGER) AS partitionname,
               coalesce(max(event_id // 8) + 1, 0) AS "untilOffset", count(event_id) AS n,
               (SELECT count(*) FROM events) AS batch_rows, (SELECT count(*) FROM events) AS events
        FROM range(0, 9) r(p) LEFT JOIN events ON event_id % 8 = p GROUP BY p""",
    "stream_batch_count": "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n FROM events",
    "stream_source_from_offsets": """
        SELECT 'events' AS topic, CAST(event_id % 8 AS INTEGER) AS partition, count(*) AS n,
               min(event_id // 8) AS first_offset, max(event_id // 8) AS last_offset
        FROM (SELECT event_id, (max(event_id // 8) OVER (PARTITION BY event_id % 8) + 1)
                     * (event_id % 8) // 8 AS seen FROM events) t
        WHERE event_id // 8 >= seen GROUP BY event_id % 8""",
}
