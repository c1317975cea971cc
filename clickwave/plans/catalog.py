"""Registered queries over the driver tables, and their SQL oracles.

Each query reads whole tables from ``sf_dir`` and returns a DataFrame; each
oracle is an independent ANSI-SQL statement of the same result over the
same tables (DuckDB dialect), with the same column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwave.operators.timeutil import plus_seconds
from clickwave.operators.windows import sliding_counts
from clickwave.plans import ads, hot_items, hot_pages, marketing, streamed, traffic
from clickwave.sources.events import (
    ad_clicks_from_events, marketing_from_events, read_table, user_behavior_from_events,
    web_log_from_events,
)

# Fixed roles of the event types in the reference's records (see sources.events).
PAGE_VIEW = "view"        # plays "pv"
UNINSTALL = "signup"      # plays "UNINSTALL"
# Cap of the registered ad query: two clicks per (user, ad) and UTC+8 day.
AD_CAP = 2


def _behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_behavior_from_events(read_table(spark, sf_dir, "events"))


def _web_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web_log_from_events(read_table(spark, sf_dir, "events"))


def _clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks_from_events(read_table(spark, sf_dir, "events"))


def q_hot_items_topn(spark, sf_dir):
    r = hot_items.hot_items(_behavior(spark, sf_dir), page_view=PAGE_VIEW)
    return r.select(F.col("itemId").alias("item_id"), "window_end", "cnt", "rank")


def q_hot_items_sql(spark, sf_dir):
    r = hot_items.hot_items_sql(spark, _behavior(spark, sf_dir), page_view=PAGE_VIEW)
    return r.select(F.col("itemId").alias("item_id"), "cnt", F.col("windowEnd").alias("window_end"), "row_num")


def q_hot_pages_topn(spark, sf_dir):
    return hot_pages.hot_pages(_web_log(spark, sf_dir)).select("url", "window_end", "cnt", "rank")


def q_hot_items_table_api(spark, sf_dir):
    r = hot_items.hot_items_table_api(_behavior(spark, sf_dir), page_view=PAGE_VIEW)
    return r.select(F.col("itemId").alias("item_id"), F.col("windowEnd").alias("window_end"), "cnt")


def q_hot_pages_report(spark, sf_dir):
    return hot_pages.hot_pages_report(_web_log(spark, sf_dir))


def q_ranking_report(spark, sf_dir):
    return hot_items.hot_items_report(_behavior(spark, sf_dir), page_view=PAGE_VIEW)


def q_pv_hourly(spark, sf_dir):
    return traffic.page_views(_behavior(spark, sf_dir), PAGE_VIEW)


def q_pv_hourly_salted(spark, sf_dir):
    return traffic.page_views_salted(_behavior(spark, sf_dir), PAGE_VIEW)


def q_uv_hourly_exact(spark, sf_dir):
    return traffic.unique_visitors(_behavior(spark, sf_dir), PAGE_VIEW)


def q_uv_hourly_bitmap(spark, sf_dir):
    return traffic.unique_visitors_bitmap(_behavior(spark, sf_dir), PAGE_VIEW)


def q_uv_running(spark, sf_dir):
    return traffic.unique_visitors_running(_behavior(spark, sf_dir), PAGE_VIEW)


def q_uv_sliding_sketch(spark, sf_dir):
    r = traffic.unique_visitors_sliding(_behavior(spark, sf_dir), PAGE_VIEW)
    return r.select("window_end", "uv", "within")


def q_hot_items_uneven(spark, sf_dir):
    """Windows of 10 minutes every 4: panes of 2 minutes."""
    views = _behavior(spark, sf_dir).where(F.col("behavior") == PAGE_VIEW)
    r = sliding_counts(views, ["itemId"], "ts", "10 minutes", "4 minutes")
    return r.select(F.col("itemId").alias("item_id"), "window_end", "cnt")


def q_marketing_by_channel(spark, sf_dir):
    ev = marketing_from_events(read_table(spark, sf_dir, "events"))
    return marketing.by_channel_runs(ev, UNINSTALL)


def q_marketing_total(spark, sf_dir):
    ev = marketing_from_events(read_table(spark, sf_dir, "events"))
    return marketing.total(ev, UNINSTALL)


def q_ad_click_capped(spark, sf_dir):
    ok = ads.passed(_clicks(spark, sf_dir), AD_CAP)
    return ok.select(F.col("userId").alias("user_id"), F.col("adId").alias("ad_id"), "province",
                     "city", "ts", F.col("offset").alias("event_id"), "day")


def q_ad_click_alerts(spark, sf_dir):
    al = ads.alerts(_clicks(spark, sf_dir), AD_CAP)
    return al.select(F.col("userId").alias("user_id"), F.col("adId").alias("ad_id"), "day", "ts",
                     "warning_msg")


def q_ads_by_province(spark, sf_dir):
    return ads.by_province(_clicks(spark, sf_dir), AD_CAP)


def q_late_split(spark, sf_dir):
    log = _web_log(spark, sf_dir)
    delay = F.pmod(F.col("offset") * F.lit(7919), F.lit(1800))
    log = (log.withColumn("source", F.pmod(F.col("user_id"), F.lit(4)))
           .withColumn("arrival", plus_seconds(F.col("ts"), delay)))
    tagged = hot_pages.late_rows(log, "source", "arrival", "offset")
    return tagged.select(F.col("offset").alias("event_id"), "source", "url", "ts", "arrival",
                         "watermark", "is_late")


def q_hot_items_stream(spark, sf_dir):
    return streamed.hot_items_streamed(spark, sf_dir, PAGE_VIEW)


def q_ad_click_capped_stream(spark, sf_dir):
    return streamed.ad_click_capped_streamed(spark, sf_dir, AD_CAP)


def q_ad_click_alerts_stream(spark, sf_dir):
    return streamed.ad_click_alerts_streamed(spark, sf_dir, AD_CAP)


def q_uv_running_stream(spark, sf_dir):
    return streamed.uv_running_streamed(spark, sf_dir, PAGE_VIEW)


def q_uv_count_stream(spark, sf_dir):
    return streamed.uv_count_streamed(spark, sf_dir, PAGE_VIEW)


def q_late_split_stream(spark, sf_dir):
    return streamed.late_split_streamed(spark, sf_dir)


def q_pv_hourly_stream(spark, sf_dir):
    return streamed.pv_hourly_streamed(spark, sf_dir, PAGE_VIEW)


def q_uv_hourly_stream(spark, sf_dir):
    return streamed.uv_hourly_streamed(spark, sf_dir, PAGE_VIEW)


def q_hot_pages_stream(spark, sf_dir):
    return streamed.hot_pages_streamed(spark, sf_dir)


def q_marketing_total_stream(spark, sf_dir):
    return streamed.marketing_total_streamed(spark, sf_dir, UNINSTALL)


def q_marketing_by_channel_stream(spark, sf_dir):
    return streamed.marketing_by_channel_streamed(spark, sf_dir, UNINSTALL)


def q_hot_items_sql_stream(spark, sf_dir):
    return streamed.hot_items_sql_streamed(spark, sf_dir, PAGE_VIEW)


def q_ads_by_province_stream(spark, sf_dir):
    return streamed.ads_by_province_streamed(spark, sf_dir, AD_CAP)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items_topn": q_hot_items_topn,
    "hot_items_sql": q_hot_items_sql,
    "hot_pages_topn": q_hot_pages_topn,
    "ranking_report": q_ranking_report,
    "hot_items_table_api": q_hot_items_table_api,
    "hot_pages_report": q_hot_pages_report,
    "pv_hourly": q_pv_hourly,
    "pv_hourly_salted": q_pv_hourly_salted,
    "uv_hourly_exact": q_uv_hourly_exact,
    "uv_hourly_bitmap": q_uv_hourly_bitmap,
    "uv_running": q_uv_running,
    "uv_sliding_sketch": q_uv_sliding_sketch,
    "hot_items_uneven": q_hot_items_uneven,
    "marketing_by_channel": q_marketing_by_channel,
    "marketing_total": q_marketing_total,
    "ad_click_capped": q_ad_click_capped,
    "ad_click_alerts": q_ad_click_alerts,
    "ads_by_province": q_ads_by_province,
    "late_split": q_late_split,
    "hot_items_stream": q_hot_items_stream,
    "ad_click_capped_stream": q_ad_click_capped_stream,
    "ad_click_alerts_stream": q_ad_click_alerts_stream,
    "uv_running_stream": q_uv_running_stream,
    "uv_count_stream": q_uv_count_stream,
    "late_split_stream": q_late_split_stream,
    "pv_hourly_stream": q_pv_hourly_stream,
    "uv_hourly_stream": q_uv_hourly_stream,
    "ads_by_province_stream": q_ads_by_province_stream,
    "hot_pages_stream": q_hot_pages_stream,
    "marketing_total_stream": q_marketing_total_stream,
    "marketing_by_channel_stream": q_marketing_by_channel_stream,
    "hot_items_sql_stream": q_hot_items_sql_stream,
}

# ---------------------------------------------------------------- oracles

_ITEM = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_VIEWS = f"SELECT user_id, {_ITEM} AS item_id, ts, event_id FROM events WHERE event_type = 'view'"

_ITEM_TOP5 = f"""
WITH v AS ({_VIEWS}),
p AS (SELECT item_id, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS pane_end, count(*) AS c
      FROM v GROUP BY ALL),
w AS (SELECT item_id, unnest(generate_series(pane_end, pane_end + INTERVAL 55 MINUTE, INTERVAL 5 MINUTE)) AS window_end, c
      FROM p),
c AS (SELECT item_id, window_end, CAST(sum(c) AS BIGINT) AS cnt FROM w GROUP BY ALL),
r AS (SELECT item_id, window_end, cnt,
             CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, item_id) AS INTEGER) AS rnk
      FROM c)
"""

_WEB = f"""
l AS (SELECT event_id, user_id, event_type, date_trunc('second', ts) AS ts, {_ITEM} AS k FROM events),
g AS (SELECT event_id, user_id, ts,
             '/p/' || CAST(k AS VARCHAR) || (['', '.html', '.css', '.js', '.png', '.ico'])[k % 6 + 1] AS url
      FROM l WHERE event_type IS DISTINCT FROM 'error'),
f AS (SELECT * FROM g WHERE NOT regexp_matches(url, '\\.(css|js|png|ico)$'))
"""

_MARKETING = """
m AS (SELECT CASE user_id % 3 WHEN 0 THEN 'apps store' WHEN 1 THEN 'wechat' ELSE 'weibo' END AS channel,
             event_type AS behavior, ts
      FROM events WHERE event_type IS DISTINCT FROM 'signup')
"""

_CAPPED = f"""
a AS (SELECT user_id, {_ITEM} % 5 AS ad_id, 'prov_' || CAST(user_id % 7 AS VARCHAR) AS province,
             'city_' || CAST(user_id % 9 AS VARCHAR) AS city, ts, event_id,
             CAST(ts + INTERVAL 8 HOUR AS DATE) AS day
      FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, ad_id, day ORDER BY ts, event_id) AS click_rank FROM a)
"""

ORACLES: dict[str, str] = {
    "hot_items_topn": _ITEM_TOP5 + "SELECT item_id, window_end, cnt, rnk AS rank FROM r WHERE rnk <= 5",
    "hot_items_sql": _ITEM_TOP5 + "SELECT item_id, cnt, window_end, rnk AS row_num FROM r WHERE rnk <= 5",
    "hot_pages_topn": f"""
WITH {_WEB},
p AS (SELECT url, time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS pane_end, count(*) AS c FROM f GROUP BY ALL),
w AS (SELECT url, unnest(generate_series(pane_end, pane_end + INTERVAL 595 SECOND, INTERVAL 5 SECOND)) AS window_end, c
      FROM p),
c AS (SELECT url, window_end, CAST(sum(c) AS BIGINT) AS cnt FROM w GROUP BY ALL),
r AS (SELECT url, window_end, cnt,
             CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS INTEGER) AS rnk FROM c)
SELECT url, window_end, cnt, rnk AS rank FROM r WHERE rnk <= 3""",
    "ranking_report": _ITEM_TOP5 + """
SELECT window_end,
       '=====================窗口结束时间：' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg('NO ' || CAST(rnk AS VARCHAR) || ': 商品ID=' || CAST(item_id AS VARCHAR)
                     || '热门度=' || CAST(cnt AS VARCHAR) || chr(10), '' ORDER BY rnk)
       || '=====================' || chr(10) || chr(10) AS report
FROM r WHERE rnk <= 5 GROUP BY window_end""",
    "hot_items_table_api": _ITEM_TOP5 + "SELECT item_id, window_end, cnt FROM c",
    "hot_pages_report": f"""
WITH {_WEB},
p AS (SELECT url, time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS pane_end, count(*) AS c FROM f GROUP BY ALL),
w AS (SELECT url, unnest(generate_series(pane_end, pane_end + INTERVAL 595 SECOND, INTERVAL 5 SECOND)) AS window_end, c
      FROM p),
c AS (SELECT url, window_end, CAST(sum(c) AS BIGINT) AS cnt FROM w GROUP BY ALL),
r AS (SELECT url, window_end, cnt,
             row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC, url) AS rnk FROM c)
SELECT window_end,
       '=====================窗口结束时间：' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
       || string_agg('NO ' || CAST(rnk AS VARCHAR) || ': 页面URL=' || url
                     || '浏览量=' || CAST(cnt AS VARCHAR) || chr(10), '' ORDER BY rnk)
       || '=====================' || chr(10) || chr(10) AS report
FROM r WHERE rnk <= 3 GROUP BY window_end""",
    "pv_hourly": """
SELECT 'pv' AS key, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "pv_hourly_salted": """
SELECT 'pv' AS key, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(*) AS cnt
FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "uv_hourly_exact": """
SELECT 'uv' AS key, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY ALL""",
    # the bitmap has no collision among ids below 1,000,000, so it equals the exact count
    "uv_hourly_bitmap": """
SELECT 'uv' AS key, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end, count(DISTINCT user_id) AS uv
FROM events WHERE event_type = 'view' GROUP BY ALL""",
    "uv_running": f"""
WITH v AS (SELECT *, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end FROM ({_VIEWS})),
f AS (SELECT window_end, ts, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY window_end, user_id ORDER BY ts, event_id) AS rn FROM v)
      WHERE rn = 1)
SELECT 'uv' AS key, window_end, ts, row_number() OVER (PARTITION BY window_end ORDER BY ts, event_id) AS uv_count
FROM f""",
    "marketing_by_channel": f"""
WITH {_MARKETING},
p AS (SELECT channel, behavior, time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS e, count(*) AS c
      FROM m GROUP BY ALL),
d AS (SELECT channel, behavior, e, c AS d FROM p
      UNION ALL SELECT channel, behavior, e + INTERVAL 1 HOUR, -c FROM p),
pts AS (SELECT channel, behavior, e, sum(d) AS d FROM d GROUP BY ALL HAVING sum(d) <> 0),
runs AS (SELECT channel, behavior, e AS window_end_from,
                lead(e) OVER (PARTITION BY channel, behavior ORDER BY e) AS window_end_until,
                CAST(sum(d) OVER (PARTITION BY channel, behavior ORDER BY e ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cnt
         FROM pts)
SELECT * FROM runs WHERE cnt > 0""",
    "marketing_total": f"""
WITH {_MARKETING},
p AS (SELECT time_bucket(INTERVAL 5 SECOND, ts) + INTERVAL 5 SECOND AS pane_end, count(*) AS c FROM m GROUP BY ALL),
w AS (SELECT unnest(generate_series(pane_end, pane_end + INTERVAL 3595 SECOND, INTERVAL 5 SECOND)) AS window_end, c
      FROM p)
SELECT 'total' AS channel, 'total' AS behavior, window_end, CAST(sum(c) AS BIGINT) AS cnt FROM w GROUP BY window_end""",
    "ad_click_capped": f"""
WITH {_CAPPED}
SELECT user_id, ad_id, province, city, ts, event_id, day FROM r WHERE click_rank <= {AD_CAP}""",
    "ad_click_alerts": f"""
WITH {_CAPPED}
SELECT user_id, ad_id, day, ts, 'click over{AD_CAP} times' AS warning_msg FROM r WHERE click_rank = {AD_CAP + 1}""",
    "ads_by_province": f"""
WITH {_CAPPED},
ok AS (SELECT province, ts FROM r WHERE click_rank <= {AD_CAP}),
p AS (SELECT province, time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS pane_end, count(*) AS c
      FROM ok GROUP BY ALL),
w AS (SELECT province, unnest(generate_series(pane_end, pane_end + INTERVAL 55 MINUTE, INTERVAL 5 MINUTE)) AS window_end, c
      FROM p)
SELECT province, window_end, CAST(sum(c) AS BIGINT) AS cnt FROM w GROUP BY ALL""",
    "late_split": f"""
WITH {_WEB},
a AS (SELECT event_id, user_id % 4 AS source, ts,
             ts + to_seconds((event_id * 7919) % 1800) AS arrival FROM l),
m AS (SELECT *, max(ts) OVER (PARTITION BY source ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 SECOND AS watermark
      FROM a)
SELECT event_id, source, url, m.ts, arrival, watermark,
       coalesce(time_bucket(INTERVAL 5 SECOND, m.ts) + INTERVAL 600 SECOND + INTERVAL 60 SECOND
                - INTERVAL 1 MILLISECOND <= watermark, false) AS is_late
FROM m JOIN f USING (event_id)""",
}

ORACLES["uv_sliding_sketch"] = f"""
WITH w AS (SELECT DISTINCT user_id, unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE,
                                                         time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 60 MINUTE, INTERVAL 5 MINUTE)) AS window_end
           FROM events WHERE event_type = 'view')
SELECT window_end, count(DISTINCT user_id) AS uv, true AS within FROM w GROUP BY window_end"""
ORACLES["hot_items_uneven"] = f"""
WITH v AS ({_VIEWS}),
w AS (SELECT item_id, unnest(generate_series(time_bucket(INTERVAL 4 MINUTE, ts) + INTERVAL 10 MINUTE,
                                             ts + INTERVAL 1 MICROSECOND, INTERVAL '-4' MINUTE)) AS window_end FROM v)
SELECT item_id, window_end, count(*) AS cnt FROM w GROUP BY ALL"""

# Streams over the whole table give every window: those closed by the watermark,
# and those read from the state at the end of the input.
ORACLES.update({f"{name}_stream": ORACLES[name] for name in (
    "hot_items_sql", "ad_click_capped", "ad_click_alerts", "uv_running", "late_split", "pv_hourly", "ads_by_province",
    "marketing_total", "marketing_by_channel")})
ORACLES["hot_items_stream"] = ORACLES["hot_items_topn"]
ORACLES["uv_hourly_stream"] = ORACLES["uv_hourly_exact"]
ORACLES["hot_pages_stream"] = ORACLES["hot_pages_topn"]
ORACLES["uv_count_stream"] = f"SELECT window_end, uv FROM ({ORACLES['uv_hourly_exact']})"
