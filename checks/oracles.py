"""The same results in SQL over the test tables, written for DuckDB.

``PRELUDE`` states the derived inputs of ``inputs.py`` and the star the jobs
build from them; each query selects from these.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def _round(value: str, digits: int) -> str:
    """Half up on a decimal, so that ties fall the same way in both engines."""
    return f"cast(round(cast({value} as decimal(28,10)), {digits}) as double)"


def _half_even(number: str, unit: int) -> str:
    """``number / unit`` to the nearest whole, ties to even, for integers."""
    return (
        f"(({number}) // {unit} + case when ({number}) % {unit} * 2 > {unit} "
        f"or (({number}) % {unit} * 2 = {unit} and ({number}) // {unit} % 2 = 1) "
        "then 1 else 0 end)"
    )


_ENGAGEMENT = (
    "case when views > 0 then "
    + _round("(coalesce(likes, 0) + coalesce(comment_count, 0))::double / views * 100", 4)
    + " else 0.0 end"
)
_LIKE_RATIO = (
    "case when views > 0 then "
    + _round("coalesce(likes, 0)::double / views * 100", 4)
    + " else 0.0 end"
)
_DAYS = (
    "cast(greatest(datediff('day', cast(published_at as date), date '2001-09-01'), 1) as integer)"
)
_VELOCITY = _round("coalesce(views, 0)::double / days_since_published", 2)
_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_TAG_GROUP = (
    "case when tag_count = 0 then 'No tags' when tag_count between 1 and 5 then '1-5 tags' "
    "when tag_count between 6 and 15 then '6-15 tags' else '15+ tags' end"
)


def _metrics(source: str) -> str:
    return f"""
      select *, {_VELOCITY} as view_velocity from (
        select *, {_ENGAGEMENT} as engagement_rate, {_LIKE_RATIO} as like_ratio,
               {_DAYS} as days_since_published,
               cast(year(published_at) as integer) as year,
               cast(month(published_at) as integer) as month
        from {source})"""


def _channels(condition: str) -> str:
    return f"""
      select cast(c_custkey as varchar) as channel_id, c_name as channel_name,
             c_mktsegment as country, t.*
      from (select o_custkey,
                   cast(sum(case when o_orderstatus = 'F' then 1 end) as bigint)
                     as subscriber_count,
                   cast(sum(cast(floor(o_totalprice) as bigint)) as bigint) as total_views,
                   count(*) filter (o_orderpriority = '1-URGENT') as video_count,
                   {_STAMP.format('max(o_orderdate)')} as seen_at
            from orders where {condition} group by o_custkey) t
      join customer on c_custkey = o_custkey"""


_VERSION = "channel_id, channel_name, country, subscriber_count, total_views, video_count"

PRELUDE = f"""
with order_lines as (
  select l_orderkey, sum(l_quantity) as quantity, count(*) as line_count,
         count(*) filter (l_returnflag = 'R') as returned
  from lineitem group by l_orderkey),
videos as (
  select cast(o_orderkey as varchar) as video_id,
         o_orderpriority || ' #' || o_orderkey as title,
         cast(o_custkey as varchar) as channel_id, c_name as channel_title,
         cast(c_nationkey + case when o_orderkey % 12 = 0 then 900 else 0 end as varchar) as category_id, o_orderdate as published_at,
         'status ' || o_orderstatus as description, 'PT' || line_count || 'M' as duration,
         cast(coalesce(floor(quantity / 10), 0) as integer) as tag_count,
         cast(floor(o_totalprice) as bigint) as views, cast(floor(quantity) as bigint) as likes,
         line_count as comment_count, returned as favorite_count,
         'https://img.example/' || o_orderkey as thumbnail_url
  from orders join customer on c_custkey = o_custkey
  left join order_lines on l_orderkey = o_orderkey),
stats as (
  select *, cast(published_at as date) as ingestion_date,
         {_STAMP.format('published_at')} as ingestion_timestamp, 'stats' as source
  from videos),
trending as (
  select * replace (views + 1 as views, 'trending' as source,
         case when description = 'status F'
              then {_STAMP.format("published_at + interval 1 day")}
              else ingestion_timestamp end as ingestion_timestamp)
  from stats),
combined as (
  select * from (select *, 0 as r from stats union all select *, 1 as r from trending)
  qualify row_number() over (partition by video_id order by ingestion_timestamp desc, r) = 1),
categories as (
  select cast(n_nationkey as varchar) as category_id, n_name as category_name,
         n_regionkey <> 0 as assignable
  from nation),
gold as (
  select m.*, category_name from ({_metrics('combined')}) m
  left join categories using (category_id)),
channels_all as ({_channels('true')}),
channels_before as ({_channels("o_orderdate < timestamp '1998-04-15'")}),
channels_from as ({_channels("o_orderdate >= timestamp '1998-04-15'")}),
history as (
  select {_VERSION}, date '2025-01-01' as effective_start_date,
         date '9999-12-31' as effective_end_date, true as is_current
  from channels_before),
changed as (
  select n.* from channels_from n join history o using (channel_id)
  where n.subscriber_count is distinct from o.subscriber_count
     or n.video_count is distinct from o.video_count),
merged as (
  select {_VERSION}, effective_start_date,
         case when changed.channel_id is null then effective_end_date
              else date '2025-06-01' end as effective_end_date,
         changed.channel_id is null as is_current
  from (select * from history) history
  left join (select channel_id from changed) changed using (channel_id)
  union all
  select {_VERSION}, date '2025-06-01', date '9999-12-31', true from channels_from
  where channel_id in (select channel_id from changed)
     or channel_id not in (select channel_id from history)),
dirty as (
  select case when l_linestatus = 'O' then cast(l_orderkey as varchar)
              else nullif(cast(l_orderkey as varchar), cast(l_partkey as varchar)) end
           as video_id,
         nullif(l_returnflag, 'N') as title, cast(l_suppkey as varchar) as channel_id,
         cast(floor(l_extendedprice) - 5000 as bigint) as views,
         nullif(cast(floor(l_quantity) as bigint), 1) as likes,
         cast(floor(l_quantity) - 3 as bigint) as comment_count,
         {_STAMP.format('l_shipdate')} || '.' || lpad(cast(l_linenumber as varchar), 3, '0')
           || '.' || lpad(cast(l_partkey as varchar), 12, '0')
           || '.' || lpad(cast(l_suppkey as varchar), 12, '0') as ingestion_timestamp
  from lineitem),
judged as (
  select *, case
      when video_id is null or title is null or channel_id is null
        then 'NULL in: [''video_id'', ''title'', ''channel_id'']'
      when views < 0 or likes < 0 or comment_count < 0
        then 'Negative values in: [''views'', ''likes'', ''comment_count'']' end as dq_issue
  from dirty),
star_videos as (
  select * replace (views + case when description = 'status F' then 1 else 0 end as views)
  from videos),
fact as (
  select *, strftime(published_at, '%Y%m%d') as date_id from ({_metrics('star_videos')})),
days as (
  select strftime(full_date, '%Y%m%d') as date_id, full_date,
         cast(year(full_date) as integer) as year, cast(month(full_date) as integer) as month,
         strftime(full_date, '%B') as month_name, cast(quarter(full_date) as integer) as quarter,
         strftime(full_date, '%A') as day_of_week, dayofweek(full_date) in (0, 6) as is_weekend
  from (select distinct cast(published_at as date) as full_date from videos
        where published_at is not null)),
pages as (
  select o_orderpriority as keyword, o_orderkey // 50 as page, count(*) as items
  from orders group by all)
"""


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = PRELUDE + sql


_TOP = "from fact join categories using (category_id)"
_PUBLISHED = "cast(published_at as varchar) as published_at"
_AVG_VIEWS = _round("avg(views)", 0)
_AVG_ENGAGEMENT = _round("avg(engagement_rate)", 4)
_TOTALS = (
    "cast(sum(views) as bigint) as total_views, cast(sum(likes) as bigint) as total_likes"
)
_TRENDING = (
    "title, channel_title, category_name, views, likes, comment_count, engagement_rate, "
    "view_velocity as views_per_day"
)
_GROWING = (
    "title, channel_title, category_name, views, view_velocity as views_per_day, engagement_rate"
)
_VIEWS_M = f"{_half_even('views', 10000)} / 100.0::double"
_PER_DAY_K = f"{_half_even('cast(round(view_velocity * 100) as bigint)', 10000)} / 10.0::double"

oracle(
    "top_trending_videos",
    f"select {_TRENDING}, {_PUBLISHED} {_TOP} where views is not null "
    "order by views desc, video_id limit 20",
)
oracle(
    "top_videos_dashboard",
    f"select {_TRENDING}, left(title, 40) || '...' as title_short, {_VIEWS_M} as \"views_M\" "
    f"{_TOP} where views is not null order by views desc, video_id limit 20",
)
oracle(
    "most_engaging_videos",
    "select title, channel_title, category_name, views, likes, comment_count, engagement_rate, "
    f"like_ratio as like_ratio_pct {_TOP} where views > 10000 "
    "order by engagement_rate desc, video_id limit 20",
)
oracle(
    "fastest_growing_videos",
    f"select {_GROWING}, {_PUBLISHED} {_TOP} where view_velocity is not null "
    "order by view_velocity desc, video_id limit 20",
)
oracle(
    "fastest_growing_dashboard",
    f"select {_GROWING}, left(title, 35) || '...' as title_short, "
    f"{_PER_DAY_K} as \"views_per_day_K\" {_TOP} where view_velocity is not null "
    "order by view_velocity desc, video_id limit 15",
)
oracle(
    "channel_performance",
    f"select channel_id, count(distinct video_id) as total_videos, {_TOTALS}, "
    f"{_AVG_VIEWS} as avg_views, {_AVG_ENGAGEMENT} as avg_engagement, "
    "max(views) as best_video_views from fact group by channel_id",
)
oracle(
    "top_performing_categories",
    f"select category_name, count(video_id) as total_videos, {_TOTALS}, "
    f"{_AVG_VIEWS} as avg_views_per_video, {_AVG_ENGAGEMENT} as avg_engagement_rate, "
    f"max(views) as max_views {_TOP} where views is not null group by category_name",
)
oracle(
    "category_top10",
    "select category_name, count(video_id) as total_videos, "
    f"cast(sum(views) as bigint) as total_views, {_AVG_ENGAGEMENT} as avg_engagement "
    f"{_TOP} where views is not null group by category_name "
    "order by total_views desc, category_name limit 10",
)
oracle(
    "monthly_trend",
    "select d.year, d.month, month_name, quarter, count(video_id) as videos_published, "
    f"{_TOTALS}, {_AVG_ENGAGEMENT} as avg_engagement "
    "from fact join days d using (date_id) group by d.year, d.month, month_name, quarter",
)
oracle(
    "monthly_trend_dashboard",
    "select d.year, d.month, month_name, count(video_id) as video_count, "
    f"cast(sum(views) as bigint) as total_views, {_AVG_ENGAGEMENT} as avg_engagement, "
    "month_name || ' ' || d.year as period "
    "from fact join days d using (date_id) group by d.year, d.month, month_name",
)
_DAY_TYPE = "case when is_weekend then 'Weekend' else 'Weekday' end as day_type"
oracle(
    "weekend_vs_weekday",
    f"select {_DAY_TYPE}, count(video_id) as total_videos, {_AVG_VIEWS} as avg_views, "
    f"{_round('avg(likes)', 0)} as avg_likes, {_AVG_ENGAGEMENT} as avg_engagement "
    "from fact join days using (date_id) group by is_weekend",
)
oracle(
    "weekend_vs_weekday_dashboard",
    f"select {_DAY_TYPE}, count(video_id) as total_videos, {_AVG_VIEWS} as avg_views, "
    f"{_AVG_ENGAGEMENT} as avg_engagement from fact join days using (date_id) "
    "group by is_weekend",
)
oracle(
    "tag_count_vs_views",
    f"select {_TAG_GROUP} as tag_group, count(video_id) as video_count, "
    f"{_AVG_VIEWS} as avg_views, {_AVG_ENGAGEMENT} as avg_engagement "
    f"from fact group by {_TAG_GROUP}",
)
oracle(
    "summary_kpis",
    f"select count(distinct video_id) as total_videos, {_TOTALS}, "
    f"{_AVG_ENGAGEMENT} as avg_engagement from fact where views is not null",
)
oracle(
    "kpi_texts",
    "select format('{:,}', count(distinct video_id)) as total_videos, "
    "printf('%.1fM', round_even(sum(views) / 1e6, 1)) as total_views, "
    "printf('%.1fM', round_even(sum(likes) / 1e6, 1)) as total_likes, "
    f"{_AVG_ENGAGEMENT} || '%' as avg_engagement from fact where views is not null",
)

oracle("join_star_inner", f"select video_id, title, category_name, views {_TOP}")
oracle(
    "join_fact_date",
    "select video_id, date_id, month_name, day_of_week, is_weekend "
    "from fact join days using (date_id)",
)
oracle("join_fact_video", "select video_id, tag_count as video_tags, views from fact")
oracle("join_fact_category", f"select video_id, category_name, assignable {_TOP}")
oracle(
    "join_left_dim",
    "select video_id, category_id, category_name from videos left join categories "
    "using (category_id)",
)
oracle("filter_threshold", "select video_id, views from fact where views > 10000")
oracle(
    "filter_not_null_key",
    "select title, count(*) as rows, cast(sum(views) as bigint) as views from dirty "
    "where title is not null group by title",
)

oracle("engagement_rate", f"select video_id, {_ENGAGEMENT} as engagement_rate from videos")
oracle("like_ratio", f"select video_id, {_LIKE_RATIO} as like_ratio from videos")
oracle(
    "view_velocity",
    f"select video_id, days_since_published, view_velocity from ({_metrics('videos')})",
)
oracle(
    "year_month_cols",
    "select video_id, cast(year(published_at) as integer) as year, "
    "cast(month(published_at) as integer) as month from videos",
)
oracle("tag_bucket", f"select video_id, {_TAG_GROUP} as tag_group from videos")
oracle("day_type", f"select date_id, {_DAY_TYPE} from days")
oracle(
    "presentation_cols",
    "select video_id, strftime(published_at, '%B') || ' ' || year as period, "
    "left(title, 40) || '...' as title_40, left(title, 9) || '...' as title_9, "
    f"{_VIEWS_M} as views_m, {_PER_DAY_K} as views_per_day_k from gold",
)
oracle(
    "scalar_functions",
    f"""select o_orderkey, {_STAMP.format('o_orderdate')} as as_timestamp,
       cast(o_orderdate as date) as as_date, try_cast(o_orderpriority as bigint) as bad_count,
       o_orderkey as good_count, cast(try_cast(o_orderstatus as timestamp) as varchar) as bad_time,
       strftime(o_orderdate, '%Y%m%d') as date_id, strftime(o_orderdate, '%B') as month_name,
       strftime(o_orderdate, '%A') as day_name, cast(quarter(o_orderdate) as integer) as quarter,
       dayofweek(o_orderdate) in (0, 6) as weekend,
       cast(datediff('day', cast(o_orderdate as date), date '2001-09-01') as integer) as days,
       1 as greatest_skips_null, coalesce(nullif(o_orderstatus, 'F'), 'none') as status,
       {_round('o_totalprice / 7', 2)} as rounded,
       cast(len(string_split(o_orderpriority, '-')) as integer) as parts,
       case when o_totalprice between 1000 and 100000 then 'low' else 'high' end as band
       from orders""",
)

_RUN = "date '2001-09-01' as ingestion_date, '2001-09-01 01:00:00' as ingestion_timestamp"
oracle(
    "audit_columns",
    f"select event_id, event_type, {_RUN}, 'youtube_api_trending' as source from events",
)
oracle(
    "source_audit",
    "select event_id, 'batch_20010901_010000_0a1b2c3d' as _batch_id, "
    "'2001-09-01T01:00:00Z' as _ingestion_ts, 'youtube_data_api_v3' as _source_system, "
    "'videos.list[trending][cat=10]' as _api_endpoint, '10' as _source_category from events",
)
_FLAT = (
    f"select * replace (cast(published_at as varchar) as published_at), {_RUN}, "
    "'youtube_api_video_stats' as source from videos"
)
oracle("flatten_video_stats", _FLAT)
oracle("scan_json_array", _FLAT)
oracle("sink_raw_json", _FLAT)
oracle(
    "flatten_channel_stats",
    "select channel_id, channel_name, cast(null as varchar) as description, country, "
    "seen_at as published_at, subscriber_count, total_views, video_count, "
    f"{_RUN}, 'youtube_api_channel_stats' as source from channels_all",
)
oracle(
    "flatten_categories",
    f"select category_id, category_name, assignable, {_RUN}, 'youtube_api_categories' as source "
    "from categories",
)
oracle(
    "flatten_search_videos",
    f"select video_id, title, channel_id, channel_title, {_PUBLISHED}, description, "
    "thumbnail_url, coalesce(nullif(split_part(title, ' #', 1), '5-LOW'), 'unknown') "
    f"as source_keyword, {_RUN}, 'youtube_api_keyword_search' as source from videos",
)
oracle(
    "extract_video_ids",
    "select cast(o_orderkey as varchar) as video_id from orders where o_orderstatus in ('F', 'O')",
)
oracle("select_existing", "select o_custkey, o_orderkey from orders")
oracle(
    "conform_channel_input",
    "select channel_id, max(channel_title) as channel_name, cast(null as varchar) as country, "
    "cast(0 as bigint) as subscriber_count, cast(sum(views) as bigint) as total_views, "
    "count(video_id) as video_count from videos group by channel_id",
)

_DIRTY = "video_id, title, channel_id, views, likes, comment_count, ingestion_timestamp"
_NEGATIVE = "(coalesce(views, 0) < 0 or coalesce(likes, 0) < 0 or coalesce(comment_count, 0) < 0)"
oracle(
    "dq_completeness",
    f"select case when title is null or video_id is null or channel_id is null then 'bad' "
    f"else 'good' end as outcome, {_DIRTY}, case when title is null or video_id is null or "
    "channel_id is null then 'NULL in: [''video_id'', ''title'', ''channel_id'']' end as dq_issue "
    "from dirty",
)
oracle(
    "dq_validity",
    f"select case when {_NEGATIVE} then 'bad' else 'good' end as outcome, {_DIRTY}, "
    f"case when {_NEGATIVE} then 'Negative values in: [''views'', ''likes'', ''comment_count'']' "
    "end as dq_issue from dirty",
)
oracle(
    "dq_failed_columns",
    """select concat_ws(',', case when video_id is null then 'video_id' end,
         case when title is null then 'title' end, case when channel_id is null then 'channel_id' end,
         case when views < 0 then 'views' end, case when likes < 0 then 'likes' end,
         case when comment_count < 0 then 'comment_count' end) as failed, dq_issue,
       count(*) as rows from judged group by 1, 2""",
)
oracle(
    "dq_unique_latest",
    "select user_id, event_id, event_type, value from events "
    "qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1",
)
_UNIQUE = (
    "select * from judged where dq_issue is null "
    "qualify row_number() over (partition by video_id order by ingestion_timestamp desc) = 1"
)
oracle(
    "dq_run_all",
    f"select 'good' as outcome, {_DIRTY}, dq_issue from ({_UNIQUE}) union all "
    f"select 'bad', {_DIRTY}, dq_issue from judged where dq_issue is not null",
)
oracle(
    "dq_metrics",
    f"""select count(*) as input_rows,
       count(*) filter (not coalesce(dq_issue like 'NULL%', false)) as complete_good,
       count(*) filter (dq_issue like 'NULL%') as complete_bad,
       count(*) filter (dq_issue is null) as valid_good,
       count(*) filter (dq_issue like 'Neg%') as valid_bad,
       (select count(*) from ({_UNIQUE})) as unique_rows,
       count(*) filter (dq_issue is null) - (select count(*) from ({_UNIQUE}))
         as duplicates_removed from judged""",
)
oracle(
    "union_quarantine",
    "select video_id, title, views, ingestion_timestamp, dq_issue from judged "
    "where dq_issue is not null",
)
oracle(
    "empty_like",
    "select o_orderkey, o_orderstatus, cast(null as varchar) as dq_issue from orders where false",
)

oracle(
    "union_dedup_videos", "select video_id, views, ingestion_timestamp, source from combined"
)
oracle(
    "dedup_key",
    "select video_id, ingestion_timestamp, views from dirty where video_id is not null "
    "qualify row_number() over (partition by video_id order by ingestion_timestamp desc) = 1",
)
oracle(
    "first_seen_dedup",
    """select l_orderkey as id, l_returnflag, l_linenumber, l_partkey, l_suppkey from lineitem
       qualify row_number() over (partition by l_orderkey order by
         case l_returnflag when 'R' then 0 when 'A' then 1 else 2 end,
         l_linenumber, l_partkey, l_suppkey) = 1""",
)
oracle("distinct_ids", "select distinct video_id from dirty where video_id is not null")
oracle("distinct_dates", "select full_date from days")

oracle(
    "gold_video_engagement",
    f"""select video_id, title, channel_id, channel_title, category_id, category_name, {_PUBLISHED},
       duration, tag_count, views, likes, comment_count, favorite_count, thumbnail_url,
       engagement_rate, like_ratio, view_velocity, days_since_published, year, month,
       ingestion_date, ingestion_timestamp from gold""",
)
_RATED = f"(select *, {_ENGAGEMENT} as engagement_rate from stats)"
oracle(
    "gold_channel_performance",
    f"""select channel_id, max(channel_title) as channel_title, count(video_id) as total_videos,
       {_TOTALS}, cast(sum(comment_count) as bigint) as total_comments, {_AVG_VIEWS} as avg_views,
       max(views) as max_views, min(views) as min_views, {_AVG_ENGAGEMENT} as avg_engagement_rate,
       date '2001-09-01' as ingestion_date from {_RATED} group by channel_id""",
)
oracle(
    "gold_category_performance",
    f"""select category_id, category_name, count(video_id) as total_videos, {_TOTALS},
       {_AVG_VIEWS} as avg_views, max(views) as max_views,
       {_AVG_ENGAGEMENT} as avg_engagement_rate, date '2001-09-01' as ingestion_date
       from {_RATED} left join categories using (category_id)
       group by category_id, category_name""",
)
oracle(
    "dim_video",
    f"select video_id, title, channel_id, channel_title, category_id, {_PUBLISHED}, duration, "
    "tag_count, thumbnail_url from gold",
)
oracle("dim_category", "select category_id, category_name, assignable from categories")
oracle("dim_date", "select * from days")
oracle("sink_dim", "select * from days")
oracle(
    "fact_video_performance",
    "select video_id, channel_id, category_id, strftime(published_at, '%Y%m%d') as date_id, "
    "views, likes, comment_count, favorite_count, tag_count, engagement_rate, like_ratio, "
    "view_velocity, year, month from gold",
)

oracle("scd2_first_load", "select * from history")
oracle("scd2_changed", "select channel_id from changed")
oracle(
    "scd2_new_keys",
    f"select {_VERSION} from channels_from "
    "where channel_id not in (select channel_id from history)",
)
oracle("scd2_changed_rows", f"select {_VERSION} from changed")
oracle("scd2_merge", "select * from merged")
oracle("scd2_union", "select * from merged")
oracle(
    "scd2_as_of",
    """select o_orderkey, channel_id, asked, subscriber_count, video_count from
       (select o_orderkey, cast(o_custkey as varchar) as channel_id,
               case when o_orderstatus = 'F' then date '2025-03-01' else date '2025-07-01' end
                 as asked from orders)
       join merged using (channel_id)
       where effective_start_date <= asked and asked < effective_end_date""",
)
oracle("surrogate_key", "select count(*) as versions, count(*) as keys from merged")

_DIGIT = "cast(video_id as bigint) % 10"
_SECOND_DAY = (
    f"(select * replace (views + case {_DIGIT} when 0 then 5 when 3 then 3 when 7 then 7 else 0 end as views) from videos)"
)
_WITH_TRENDING = f"(select * replace (views + case {_DIGIT} when 9 then 9 else 0 end as views) from {_SECOND_DAY})"
_SEEN = (
    f"case {_DIGIT} when 0 then timestamp '2001-09-02 01:00:00' when 3 then timestamp '2001-09-01 02:00:00' "
    "when 7 then timestamp '2001-09-02 03:00:00' else timestamp '2001-09-01 01:00:00' end"
)
oracle(
    "silver_after_append",
    f"""select video_id, views, likes, cast({_SEEN} as date) as ingestion_date,
       {_STAMP.format(_SEEN)} as ingestion_timestamp from {_SECOND_DAY}""",
)
oracle(
    "gold_mart_after_update_day",
    f"""select video_id, title, category_name, views, engagement_rate, like_ratio,
       days_since_published, view_velocity, year, month
       from ({_metrics(_WITH_TRENDING)}) m left join categories using (category_id)""",
)
_RATED_AGAIN = f"(select *, {_ENGAGEMENT} as engagement_rate from {_SECOND_DAY})"
oracle(
    "gold_channels_after_update_day",
    f"""select channel_id, max(channel_title) as channel_title, count(video_id) as total_videos,
       {_TOTALS}, cast(sum(comment_count) as bigint) as total_comments, {_AVG_VIEWS} as avg_views,
       max(views) as max_views, min(views) as min_views, {_AVG_ENGAGEMENT} as avg_engagement_rate,
       date '2001-09-02' as ingestion_date from {_RATED_AGAIN} group by channel_id""",
)
oracle(
    "gold_categories_after_update_day",
    f"""select category_id, max(category_name) as category_name, count(video_id) as total_videos,
       {_TOTALS}, {_AVG_VIEWS} as avg_views, max(views) as max_views,
       {_AVG_ENGAGEMENT} as avg_engagement_rate, date '2001-09-02' as ingestion_date
       from {_RATED_AGAIN} left join categories using (category_id) group by category_id""",
)
oracle("channel_history_in_parts", "select * from merged")

_VIDEO_COUNT = "(select count(*) from videos)"
_FINISHED = "(select count(*) from orders where o_orderstatus = 'F')"
_IN_CATEGORY = (
    "(select count(*) from videos where description = 'status F' "
    "and category_id in ('1', '10', '17', '22', '23', '24', '25', '28'))"
)
_CHANNELS = "(select count(*) from channels_all)"
_GOOD_CHANNELS = "(select count(*) from channels_all where subscriber_count is not null)"
_MARKS = (
    "(select count(distinct channel_id) + count(distinct split_part(title, ' #', 1)) from videos)"
)
_CATEGORIES = "(select count(*) from categories)"
_DAYS_COUNT = "(select count(*) from days)"
_VIDEO_CATEGORIES = "(select count(distinct category_id) from videos)"
_CHANNEL_COUNT = "(select count(distinct channel_id) from videos)"

_RAW = {
    "trending": _FINISHED,
    "trending_by_category": _IN_CATEGORY,
    "channel_videos": _VIDEO_COUNT,
    "keyword_videos": _VIDEO_COUNT,
    "video_stats": _VIDEO_COUNT,
    "channel_stats": _CHANNELS,
    "categories": _CATEGORIES,
}
_LAYERS = {
    "silver": {f"silver_{name}": rows for name, rows in _RAW.items()}
    | {"silver_channel_stats": _GOOD_CHANNELS},
    "gold": {
        "gold_video_engagement": _VIDEO_COUNT,
        "gold_channel_performance": _CHANNEL_COUNT,
        "gold_category_performance": _VIDEO_CATEGORIES,
    },
    "warehouse": {
        "dim_video": _VIDEO_COUNT,
        "dim_channel": _GOOD_CHANNELS,
        "dim_category": _CATEGORIES,
        "dim_date": _DAYS_COUNT,
        "fact_video_performance": _VIDEO_COUNT,
    },
}
_RUNS = (
    {
        "landing": dict.fromkeys(_RAW, "cast(null as bigint)") | {"marks": _MARKS},
        "bronze": {f"bronze_{name}": rows for name, rows in _RAW.items()},
    }
    | _LAYERS
)


def _union(rows: list[str]) -> str:
    return " union all ".join(f"select {row}" for row in rows)


oracle(
    "scan_missing_ok",
    _union(
        [
            f"'present' as case_name, true as found, {_VIDEO_COUNT} as rows",
            "'missing', false, cast(0 as bigint)",
        ]
    ),
)
oracle(
    "scan_layer",
    "select video_id, views, likes, tag_count, date '2001-09-01' as ingestion_date, "
    "'youtube_api_video_stats' as source from star_videos",
)
_LABELS = {
    "trending": "youtube_api_trending",
    "trending_by_category": "youtube_api_trending_category",
    "channel_videos": "youtube_api_channel_search",
    "keyword_videos": "youtube_api_keyword_search",
    "video_stats": "youtube_api_video_stats",
    "channel_stats": "youtube_api_channel_stats",
    "categories": "youtube_api_categories",
}
oracle(
    "source_map_ingest",
    _union(
        [
            f"'bronze_{name}' as table_name, '{label}' as source, {_RAW[name]} as rows"
            for name, label in _LABELS.items()
        ]
    ),
)
oracle(
    "bronze_stream_ingest",
    "select video_id, views, likes, 'youtube_api_video_stats' as source from star_videos",
)
oracle(
    "register_views",
    f"select category_name, count(*) as videos, max(engagement_rate) as best {_TOP} "
    "group by category_name",
)
oracle(
    "external_tables",
    _union(
        [
            f"'{table}' as table_name, {rows} as rows"
            for table, rows in _LAYERS["warehouse"].items()
        ]
    ),
)
oracle(
    "run_sql_file",
    "select category_name, cast(sum(views) as bigint) as views, "
    f"cast(sum(likes) as bigint) as likes {_TOP} group by category_name",
)
oracle(
    "run_sql_folder",
    "select 'weekday_videos' as file, cast(day_of_week as varchar) as name, count(*) as videos, "
    "cast(null as bigint) as likes from fact join days using (date_id) group by day_of_week "
    "union all select 'category_views', category_name, cast(sum(views) as bigint), "
    f"cast(sum(likes) as bigint) {_TOP} group by category_name",
)
oracle(
    "explode_page_items",
    "select video_id, title, split_part(title, ' #', 1) as _source_keyword from videos",
)
oracle(
    "rejected_pages",
    "select n_name as _source_keyword, 'empty items' as dq_issue from nation union all "
    "select r_name, 'no items' from region",
)
_PURCHASES = (
    "select user_id, max(ts) as last_ts from events where event_type = 'purchase' group by user_id"
)
oracle(
    "incremental_read",
    f"select event_id, user_id, event_type from events left join ({_PURCHASES}) using (user_id) "
    "where user_id % 7 = 0 or ts >= coalesce(last_ts, timestamp '2024-01-05 00:00:00')",
)
oracle(
    "watermark_upsert",
    """select source_type, cast(user_id as varchar) as source_key,
       rtrim(rtrim(strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f'), '0'), '.') as last_ts
       from (select case event_type when 'click' then 'clicker' when 'signup' then 'joiner'
                    when 'error' then 'failer' else 'user' end as source_type, user_id, ts from events)
       group by all""",
)
oracle(
    "sharded_source_union",
    """select _source_category, status, count(*) as rows, cast(sum(id) as bigint) as ids,
       count(line) as lines from (
         select 'orders' as _source_category, o_orderkey as id, o_orderstatus as status,
                cast(null as integer) as line from orders
         union all select 'lines', l_orderkey, l_linestatus, l_linenumber from lineitem
         union all select 'events', event_id, null, null from events)
       group by 1, 2""",
)
oracle(
    "trending_shards",
    "select video_id, category_id, '0' as _source_category from videos union all "
    "select video_id, category_id, category_id from videos "
    "where category_id in ('1', '10', '17', '22', '23', '24', '25', '28')",
)

_SILVER = (
    "select cast(o_orderkey as varchar) as video_id, cast(floor(o_totalprice) as bigint) as views, "
    "cast(date_trunc('month', o_orderdate) as date) as ingestion_date, "
    "cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month "
    "from orders"
)
_STORED = f"select video_id, views, ingestion_date from ({_SILVER})"
oracle("sink_append_partitioned", f"{_STORED} union all {_STORED}")
oracle(
    "sink_replace_partitions",
    "select video_id, views + case when ingestion_date >= date '2000-01-01' then 1 else 0 end "
    f"as views, ingestion_date from ({_SILVER})",
)
oracle(
    "sink_overwrite_partitioned",
    f"select video_id, views + 1 as views, ingestion_date from ({_SILVER})",
)
oracle("sink_gold", f"select video_id, views, year, month from ({_SILVER})")
oracle(
    "sink_fact",
    "select video_id, views, case when views > 10000 then year end as year, "
    f"case when views > 10000 then month end as month from ({_SILVER})",
)
oracle(
    "sink_quarantine",
    "select quarantine_date, dq_issue, count(*) as rows from judged, "
    "(select unnest([date '2025-01-01', date '2025-06-01']) as quarantine_date) "
    "where dq_issue is not null group by all",
)
oracle(
    "sink_lineage",
    _union(
        [
            f"'{pipeline}' as pipeline, '{table}' as table_name, 'written' as status, "
            f"{rows} as rows, '2001-09-01 01:00:00' as logged_at"
            for pipeline, found in _RUNS.items()
            for table, rows in found.items()
        ]
    ),
)
oracle(
    "layer_row_counts",
    _union(
        [
            f"'{layer}' as layer, '{table}' as table_name, {rows} as rows"
            for layer, found in _LAYERS.items()
            for table, rows in found.items()
        ]
    ),
)

for _name in ("channel_performance", "summary_kpis"):
    ORACLES[f"{_name}_distinct"] = ORACLES[_name]

for _any, _same in (
    ("top_trending_any_state", "top_trending_videos"),
    ("most_engaging_any_state", "most_engaging_videos"),
    ("fastest_growing_any_state", "fastest_growing_videos"),
    ("tag_count_any_state", "tag_count_vs_views"),
):
    ORACLES[_any] = ORACLES[_same]
