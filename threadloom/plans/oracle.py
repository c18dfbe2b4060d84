"""SQL text (DuckDB dialect) that each registered query is checked against."""

from __future__ import annotations

# Fixed values of threadloom.plans.views, stated again so that the SQL stands on its own.
_E = """e as (
  select turn as pos, conv_id,
    case when turn = 0 then 'Post' else 'Comment' end as "Type",
    case when turn = 0 then 't3_' || conv_id || '_0' else 't1_' || conv_id || '_' || turn end as "Id",
    't2_' || role as "AuthorId", role as "AuthorName", 'new' as "SubredditRankingType",
    '/r/b' || (conv_id % 5) || '/comments/' ||
      case when turn = 0 then 't3_' || conv_id || '_0' else 't1_' || conv_id || '_' || turn end
      || '/' as "Permalink",
    text as "Comment",
    cast(1704067200000 + conv_id * 3600000 + turn * 60000 as varchar) as "CreatedAt",
    case when turn > 1 then 't1_' || conv_id || '_' || (turn - 1) end as "ParentCommentId",
    case when turn > 0 then 't3_' || conv_id || '_0' end as "ParentPostId",
    '/r/b' || (conv_id % 5) || '/new/' as "SubredditName",
    true as "IsActive", '2024-01-31 00:00:00' as "ParsedTime"
  from conversations)"""


def _listing(n_boards: int) -> str:
    return f"""l as (
  select cast(user_id % {n_boards} as varchar) as board,
    event_id // 125 as page_no, event_id % 125 as pos, 't3_' || event_id as fullname,
    1706659200000 - cast(floor(value * 1000) as bigint) * 1000 as created_ms,
    '/r/b/comments/' || event_id || '/' as permalink,
    case event_type when 'error' then 'true' when 'signup' then null when 'click' then ''
      else 'false' end as promoted
  from events),
organic as (select * from l where promoted is distinct from 'true')"""


_L = _listing(5)
_L50 = _listing(50)
_IN_PERIOD = "1706659200000 - created_ms <= 150000000"
_TRIM = r"""regexp_replace("Comment", '^\s+|\s+$', '', 'g')"""

_TAKE_WHILE = f"""take_while as (
  select * from (
    select *, sum(case when {_IN_PERIOD} then 0 else 1 end)
      over (partition by board order by page_no, pos) as n_out from organic) where n_out = 0)"""


def _pages(listing: str, page_size: int) -> str:
    return f"""{listing},
pages_ as (
  select board, page_no, count(*) as n_elements, arg_max(fullname, pos) as cursor
  from l group by all),
{_crawl(page_size)}"""


def _crawl(page_size: int) -> str:
    """The last page a crawl gets to, per board of pages_."""
    return f"""ends as (
  select board, page_no, lead(page_no) over (partition by board order by page_no) as following,
    min(page_no) over (partition by board) as first_page, n_elements from pages_),
stops as (
  select board, case when min(first_page) > 0 then -1 else min(page_no) filter (
    n_elements < {page_size} or following is null or following > page_no + 1) end as stop
  from ends group by 1)"""


def _listing_pages(listing: str, page_size: int) -> str:
    return f"""with {_pages(listing, page_size)}
select board, page_no, cast(n_elements as bigint) as n_elements, cursor,
  n_elements < {page_size} as is_last, page_no <= stop as is_reached
from pages_ left join stops using (board)"""


_RANKINGS = """['tophour','day','topweek','topmonth','topyear','topall','new','hot','rising',
  'controversial','bogus']"""
_SUFFIXES = """map {'tophour': 'top/?sort=top&t=hour', 'day': 'top/?sort=top&t=day',
  'topweek': 'top/?sort=top&t=week', 'topmonth': 'top/?sort=top&t=month',
  'topyear': 'top/?sort=top&t=year', 'topall': 'top/?sort=top&t=all', 'new': 'new/', 'hot': '/',
  'rising': '/rising/', 'controversial': 'controversial/'}"""
_BOARD_PATH = f"""case when contains(base, ranking) or {_SUFFIXES}[ranking] is null then base
  else base || {_SUFFIXES}[ranking] end"""

# A run per board, as the resolved mode and period of _board_plan.
_PLANNED = f"""numbered as (
  select *, cast(board as int) as b, row_number() over (partition by board order by page_no, pos) as nth
  from organic),
timed as (
  select *, sum(case when 1706659200000 - created_ms <= (case b when 3 then 150000000 else 100000000 end)
    then 0 else 1 end) over (partition by board order by page_no, pos) as n_out from numbered),
planned as (
  select * from timed
  where b = 0 or (b in (1, 2) and nth <= b * 10) or (b in (3, 4) and n_out = 0))"""

_SCHEDULES = """s as (
  select o_orderkey as sid, o_custkey as bid, o_orderdate as last, o_orderpriority as word,
    o_orderstatus = 'O' as active from orders)"""
_BOARDS = """b as (
  select c_custkey as bid, 'r/' || c_mktsegment || c_nationkey as name from customer)"""

_RUN_PLAN = f"""with {_SCHEDULES},
last_run as (select bid, max(last) as last from s where active group by 1),
plan as (
  select c_custkey as "SubredditId", c_nationkey = 0 as take_all,
    case when c_mktsegment = 'BUILDING' and c_nationkey <> 0 then c_nationkey end as count_limit,
    case when c_mktsegment = 'MACHINERY' then 3600.0::double end as given, last,
    (epoch_us(timestamp '2024-01-31 00:00:00') - epoch_us(last)) / 1000000.0::double as since
  from customer left join last_run on bid = c_custkey)"""

_MATCH = "lang = 'en' and source = 'src3'"

ORACLE: dict[str, str] = {
    "value_decode": """
select md5(text) as digest, length(text) as n_chars from conversations""",

    "envelope_roundtrip": f"""with {_E}
select * exclude (pos, conv_id), cast(null as varchar) as related_ids from e""",

    "posts": f"""with {_E}
select "Id", "AuthorId", "AuthorName", "Permalink", "Comment", "CreatedAt", "SubredditName",
  "SubredditRankingType", "IsActive", "ParsedTime", cast(null as varchar) as related_ids
from e where "Type" = 'Post'""",

    "comments": f"""with {_E}
select "Id", "AuthorId", cast(null as varchar) as "AuthorName", "Permalink", "Comment",
  "CreatedAt", "SubredditName", "SubredditRankingType", "ParentPostId", "ParentCommentId",
  "IsActive", "ParsedTime"
from e where "Type" = 'Comment'""",

    "bad_record_counts": f"""with {_E}
select case cast('0x' || substr(md5("Id"), 1, 1) as int) % 8 when 0 then 'ok' when 1 then 'malformed'
  when 2 then 'malformed' when 3 then 'unknown_type' when 4 then 'no_type' when 5 then 'partial'
  else 'empty' end as status, count(*) as n
from e group by 1""",

    "route_target": """
select event_id, case event_type when 'view' then 'Posts' when 'click' then 'Comments'
  else 'Unknown' end as target from events""",

    "encode_json": f"""with {_E}
select "Id", case when "Type" = 'Post' then cast(to_json(struct_pack(
    "Type" := "Type", "Id" := "Id", "AuthorId" := "AuthorId", "AuthorName" := "AuthorName",
    "Permalink" := "Permalink", "Comment" := "Comment", "CreatedAt" := "CreatedAt",
    "RelatedCommentId" := cast(null as varchar), "SubredditName" := "SubredditName",
    "SubredditRankingType" := "SubredditRankingType", "ParsedTime" := "ParsedTime",
    "IsActive" := "IsActive")) as varchar)
  else cast(to_json(struct_pack(
    "Type" := "Type", "Id" := "Id", "AuthorId" := "AuthorId", "Author" := "AuthorName",
    "Permalink" := "Permalink", "Comment" := "Comment", "ParentCommentId" := "ParentCommentId",
    "ParentPostId" := "ParentPostId", "CreatedAt" := cast("CreatedAt" as bigint),
    "SubredditName" := "SubredditName", "SubredditRankingType" := "SubredditRankingType",
    "ParsedTime" := "ParsedTime", "IsActive" := "IsActive")) as varchar) end as value
from e""",

    "enrich": f"""with {_E}
select "Id",
  case when pos % 2 = 1 then '/r/b/top/?sort=top&t=all' else '/r/b/new/' end as "SubredditName",
  case when pos % 2 = 1 then 'topall' else 'new' end as "SubredditRankingType",
  '2024-01-31 00:00:00' as "ParsedTime", true as "IsActive"
from e""",

    "thread_related_ids": f"""with {_E},
c as (
  select "ParentPostId", string_agg("Id", ',' order by pos) as related_ids, count(*) as n_related
  from e where "Type" = 'Comment' group by all)
select p."Id", coalesce(related_ids, '') as related_ids,
  coalesce(n_related, 0) as n_related
from (select * from e where "Type" = 'Post') p left join c on c."ParentPostId" = p."Id" """,

    "thread_messages": f"""with {_E},
c as (
  select "ParentPostId" as post, string_agg("Id", ',' order by pos) as related_ids
  from e where "Type" = 'Comment' group by all)
select "Id", "AuthorId", "AuthorName", "Permalink", "Comment", "CreatedAt", "SubredditName",
  "SubredditRankingType", "IsActive", "ParsedTime", coalesce(related_ids, '') as related_ids
from e left join c on post = "Id" where "Type" = 'Post'""",

    "thread_union": f"""with {_E}
select "Type", "Id", "AuthorName", "Comment", null::varchar as "Author",
  null::varchar as "ParentPostId", null::varchar as "ParentCommentId" from e where "Type" = 'Post'
union all
select "Type", "Id", null, "Comment", "AuthorName", "ParentPostId", "ParentCommentId"
from e where "Type" = 'Comment'""",

    "thread_order": f"""with {_E}
select 't3_' || conv_id || '_0' as "ThreadId",
  row_number() over (partition by conv_id order by pos) - 1 as nth, "Id" from e""",

    "comment_with_post": f"""with {_E}
select c."Id", c."ParentPostId", c."AuthorName", c."Comment", p."AuthorName" as "PostAuthorName",
  p."Permalink" as "PostPermalink"
from e c join e p on p."Id" = c."ParentPostId" """,

    "comment_with_parent": f"""with {_E}
select c."Id", c."ParentCommentId", c."AuthorName", c."CreatedAt",
  p."AuthorName" as "ParentAuthorName", p."CreatedAt" as "ParentCreatedAt"
from e c join e p on p."Id" = c."ParentCommentId" """,

    "comment_depths": f"""with recursive {_E},
up as (select distinct c."Id" as id, c."ParentCommentId" as parent, p."Id" as known
  from e c left join e p on p."Id" = c."ParentCommentId" and p."Type" = 'Comment'
  where c."Type" = 'Comment'),
down as (select id, id as root, 0 as depth, parent from up where known is null
  union all select up.id, down.root, down.depth + 1, up.parent
  from up join down on up.known = down.id),
pairs as (select id, id as above from up
  union all select pairs.id, up.known from pairs join up on up.id = pairs.above
  where up.known is not null),
below as (select above, count(*) - 1 as n from pairs group by 1)
select down.id as "Id", root as "RootId", depth::bigint as depth, n::bigint as n_below,
  case when depth > 0 then 'reply' when parent is null then 'root' else 'lost parent' end as kind
from down join below on above = down.id""",

    "event_schedule_asof": """with rows as (
  select event_id, event_type, user_id % 5 as board, epoch_us(ts) as micros from events),
states as (select board, micros, max(event_id) as set_by, arg_max(event_type, event_id) as status
  from rows where event_type in ('signup', 'error') group by all)
select event_id, rows.board, set_by, status
from rows asof left join states on rows.board = states.board and rows.micros >= states.micros""",

    "listing_select": f"""with {_L}
select board, fullname, created_ms, permalink from organic""",

    "listing_counts": f"""with {_L}, {_TAKE_WHILE},
nth as (select *, row_number() over (partition by board order by page_no, pos) as n from organic)
select 'all' as mode, board, count(*) as n_posts from organic group by all
union all select 'count', board, count(*) from nth where n <= 7 group by all
union all select 'period', board, count(*) from take_while group by all""",

    "take_while_recent": f"""with {_L}, {_TAKE_WHILE}
select board, fullname, created_ms from take_while""",

    "first_n_per_group": f"""with {_L}
select board, fullname, created_ms from (
  select *, row_number() over (partition by board order by page_no, pos) as n from organic)
where n <= 10""",

    "recent_in_period": f"""with {_L}
select board, fullname, created_ms from l where {_IN_PERIOD}""",

    "listing_pages": _listing_pages(_L, 25),
    "listing_pages_sparse": _listing_pages(_L50, 2),

    "listing_reached": f"""with {_pages(_L50, 2)}
select board, fullname, created_ms, page_no from l join stops using (board) where page_no <= stop""",

    "listing_by_plan": f"""with {_L}, {_PLANNED}
select board, fullname, created_ms from planned""",

    "listing_crawl": f"""with {_pages(_L50, 2)},
seen as (
  select o.*, cast(board as int) as b,
    row_number() over (partition by board order by page_no, pos) as nth,
    sum(case when {_IN_PERIOD} then 0 else 1 end)
      over (partition by board order by page_no, pos) as n_out,
    sum(case when 1706659200000 - created_ms <= 100000000 then 0 else 1 end)
      over (partition by board order by page_no, pos) as n_older
  from organic o join stops using (board) where page_no <= stop)
select 'all' as mode, board, fullname, page_no from seen
union all select 'count', board, fullname, page_no from seen where nth <= 9
union all select 'period', board, fullname, page_no from seen where n_out = 0
union all select 'plan', board, fullname, page_no from seen
where case when b in (1, 2) then nth <= b * 10 when b = 3 then n_out = 0
  when b = 4 then n_older = 0 else true end""",

    "board_path": f"""with named as (
  select event_id, {_RANKINGS}[event_id % 11 + 1] as ranking,
    case event_type when 'view' then '/r/news/' when 'click' then '/r/friday/'
      else '/r/b' || user_id || '/' end as base
  from events)
select event_id, {_BOARD_PATH} as path from named""",

    "next_page_suffix": f"""with named as (
  select event_id, {_RANKINGS}[event_id % 11 + 1] as ranking, '/r/b/' as base, props from events)
select event_id, case when contains({_BOARD_PATH}, 'top') then '&' else '/?' end
  || 'count=25&after=t3_'
  || replace(replace(replace(replace(url_encode(props), '%20', '+'), '*', '%2A'), '%7E', '~'), '''', '%27')
  || '~%2A' as suffix
from named""",

    "absolute_url": r"""
select page_id, 'https://forum.example' || regexp_extract(url, '^https?://[^/]+(.*)$', 1) as full_url
from pages""",

    "hms": """with t as (select event_id, value * 1000 - 5000 as s from events)
select event_id, printf('%02d:%02d:%02d', cast(floor(s / 3600) as bigint),
  cast(floor((s - 3600 * floor(s / 3600)) / 60) as bigint),
  cast(floor(s - 60 * floor(s / 60)) as bigint)) as hms from t""",

    "created_ts": f"""with {_L}
select fullname, case when promoted is distinct from 'true'
  then strftime(make_timestamp(created_ms * 1000), '%Y-%m-%d %H:%M:%S') end as created from l""",

    "iso_to_millis": """
select event_id, case when event_type <> 'error' then epoch_us(ts) // 1000 - 14400000 end as millis
from events""",

    "zone_display": """
select event_id, strftime(ts + interval 4 hours, '%Y-%m-%d %H:%M:%S') as shown from events""",

    "ledger_left_join_filtered": f"""with {_SCHEDULES}, {_BOARDS}
select b.bid as "SubredditId", b.name as "SubredditName", s.sid as "SubredditScheduleId",
  strftime(s.last, '%Y-%m-%d %H:%M:%S') as "LastParsedDate"
from b left join s on s.bid = b.bid where s.active = true""",

    "ledger_lookup_top1": f"""with {_SCHEDULES}, {_BOARDS}
select name as "SubredditName", bid as "SubredditId", sid as "SubredditScheduleId",
  strftime(last, '%Y-%m-%d %H:%M:%S') as "LastParsedDate", last is not null as is_ready
from (
  select b.name, b.bid, s.sid, s.last,
    row_number() over (partition by b.name order by b.bid desc, s.sid desc) as n
  from b left join s on s.bid = b.bid where s.active = true)
where n = 1""",

    "lookup_board": f"""with {_SCHEDULES}, {_BOARDS}
select b.bid as "SubredditId", name as "SubredditName", sid as "SubredditScheduleId",
  strftime(last, '%Y-%m-%d %H:%M:%S') as "LastParsedDate"
from b join s on s.bid = b.bid where active and name = 'r/BUILDING3'
order by b.bid desc, sid desc limit 1""",

    "sql_bound_rows": """
select c_custkey, count(*) as n_orders, max(o_orderkey) as last_order
from orders join customer on o_custkey = c_custkey
where c_mktsegment = 'BUILDING' and o_orderdate >= date '1995-01-01' group by 1""",

    "sql_first_row": """
select o_orderkey, o_custkey, o_orderstatus from orders where o_orderstatus = 'O'
order by o_orderdate desc, o_orderkey desc limit 1""",

    "get_or_create_topic": """with requested as (
  select distinct case event_type when 'view' then 'NATION_' || (user_id % 30)
    else event_type || '-' || user_id end as name from events),
new as (select name from requested where name not in (select n_name from nation))
select n_name as "TopicName", cast(n_nationkey as bigint) as "TopicId", false as created
from nation where n_name in (select name from requested)
union all
select name, (select max(n_nationkey) from nation) + row_number() over (order by md5(name), name),
  true from new""",

    "get_or_create_board": f"""with {_SCHEDULES},
requested as (select distinct 'Customer#' || lpad(cast(event_id as varchar), 9, '0') as name from events),
known as (select name, c_custkey as bid from requested left join customer on c_name = name),
ids as (
  select name, bid is null as created_board, coalesce(bid, (select max(c_custkey) from customer)
    + row_number() over (partition by bid is null order by md5(name), name)) as bid from known),
last_sched as (
  select bid, max(sid) as sid, arg_max(last, sid) as last from s where active group by 1),
state as (select ids.name, ids.bid, created_board, sid, last from ids left join last_sched using (bid))
select name as "SubredditName", bid as "SubredditId",
  coalesce(sid, (select max(o_orderkey) from orders)
    + row_number() over (partition by sid is null order by md5(name), name)) as "SubredditScheduleId",
  strftime(last, '%Y-%m-%d %H:%M:%S') as "LastParsedDate", created_board,
  sid is null as created_schedule
from state""",

    "ledger_job_update": """
select o_orderkey as "SubredditJobId",
  case when o_orderstatus = 'P' then o_custkey end as "SubredditId",
  case when o_orderstatus = 'P'
    then (select n_nationkey from nation where lower(n_name) = lower('Nation_7'))
    else cast(o_orderkey % 2 + 1 as int) end as "JobTypeId",
  case when o_orderstatus = 'P' then o_custkey % 10 end as "TopicId"
from orders""",

    "ledger_job_latest": """with t as (
  select user_id as job, ts,
    case event_type when 'signup' then 'started' when 'error' then 'fail' else 'success' end as word,
    case event_type when 'signup' then 0 when 'error' then 2 else 1 end as code
  from events),
last_event as (select job, arg_max(word, struct_pack(a := ts, b := code)) as word, min(ts) as a,
  max(ts) as z from t group by 1)
select job as "SubredditJobId", strftime(a, '%Y-%m-%d %H:%M:%S') as "JobStartDate",
  case when word <> 'started' then strftime(z, '%Y-%m-%d %H:%M:%S') end as "JobEndDate",
  word as "JobStatus"
from last_event""",

    "ledger_schedule_close": f"""with {_SCHEDULES}
select sid as "SubredditScheduleId",
  case when active and bid % 3 = 0 then 'Success' when active and bid % 3 = 1 then 'failed'
    when not active and bid % 3 = 2 then 'running' else word end as "LastCheckStatus",
  case when active and bid % 3 = 0 then '2024-01-31 00:00:00'
    else strftime(last, '%Y-%m-%d %H:%M:%S') end as "LastParsedDate"
from s""",

    "ledger_jobs_by_type": """
select case when event_type = 'click' then 2 else 1 end as "JobTypeId",
  case when event_type = 'click' then 'manual' else 'scheduled' end as "JobTypeName",
  count(*) as n_jobs
from events group by all""",

    "incremental_period": f"""{_RUN_PLAN}
select "SubredditId", coalesce(given, since) as period from plan""",

    "resolve_mode": f"""{_RUN_PLAN}
select "SubredditId", coalesce(given, since) as period,
  case when take_all or (given is null and last is null and count_limit is null) then 'all'
    when count_limit is not null then 'count' else 'period' end as mode
from plan""",

    "doc_find": f"""
select doc_id, lang, source, n_chars, md5(text) as digest from documents where {_MATCH}""",

    "doc_insert": """
select doc_id, lang, source, n_chars, md5(text) as digest from documents
union all
select item_id + 1000000000000, null, null, length(text), md5(text) from benchmark""",

    "doc_update_one": f"""with first_match as (select min(doc_id) as id from documents where {_MATCH})
select doc_id, case when doc_id = id then 'xx' else lang end as lang,
  case when doc_id = id then 'archive' else source end as source, n_chars
from documents, first_match""",

    "doc_rewrite": f"""with first_match as (select min(doc_id) as id from documents where {_MATCH}),
changed as (select doc_id, case when doc_id = id then 'xx' else lang end as lang,
  case when doc_id = id then 'archive' else source end as source, n_chars
  from documents, first_match)
select * from changed where (source = 'src3' and lang = 'en') is distinct from true""",

    "doc_update_counts": f"""
select least(count(*), 1) as matched, least(count(*), 1) as modified
from documents where {_MATCH}""",

    "doc_delete_many": f"""
select doc_id, lang, source, n_chars from documents where ({_MATCH}) is distinct from true""",

    "doc_delete_counts": f"""
select count(*) as deleted from documents where {_MATCH}""",

    "page_title": r"""
select page_id, url, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') as title
from pages""",

    "listing_extract": f"""with {_L}
select board, page_no, row_number() over (partition by board, page_no order by pos) - 1 as nth,
  fullname, created_ms, permalink, nullif(promoted, '') as promoted
from l""",

    "listing_page_cursor": f"""with {_L}
select board, page_no, count(*) as n_elements, arg_max(fullname, pos) as cursor,
  count(*) < 25 as is_last
from l group by all""",

    "thread_extract": f"""with {_E},
c as (
  select "ParentPostId" as post, string_agg("Id", ',' order by pos) as related_ids
  from e where "Type" = 'Comment' group by all)
select 'https://forum.example/comments/t3_' || conv_id || '_0/' as url,
  "Type", "Id", "AuthorId",
  case when "Type" = 'Post' then "AuthorName" end as "AuthorName",
  case when "Type" = 'Comment' then "AuthorName" end as "Author",
  "Permalink", {_TRIM} as "Comment",
  "ParentCommentId", "ParentPostId", "CreatedAt",
  case when "Type" = 'Post' then coalesce(related_ids, '') end as related_ids
from e left join c on post = "Id" """,

    "publish_threads": f"""with {_E},
l as (
  select cast(conv_id % 5 as varchar) as board, conv_id // 125 as page_no, conv_id % 125 as pos,
    conv_id, cast("CreatedAt" as bigint) as created_ms, conv_id % 7 = 0 as ad
  from e where "Type" = 'Post'),
pages_ as (select board, page_no, count(*) as n_elements from l group by all),
{_crawl(25)},
organic as (select l.* from l join stops using (board) where page_no <= stop and not ad),
{_PLANNED},
c as (
  select "ParentPostId" as post, string_agg("Id", ',' order by pos) as related_ids
  from e where "Type" = 'Comment' group by all)
select "Type", "Id", "AuthorId",
  case when "Type" = 'Post' then "AuthorName" end as "AuthorName",
  case when planned.b = 2 then 'topall' else 'new' end as "SubredditRankingType",
  "Permalink", {_TRIM} as "Comment", "CreatedAt",
  "ParentCommentId", "ParentPostId",
  '/r/b' || planned.b || case when planned.b = 2 then '/top/?sort=top&t=all' else '/new/' end
    as "SubredditName",
  true as "IsActive", '2024-01-31 00:00:00' as "ParsedTime",
  case when "Type" = 'Post' then coalesce(related_ids, '') end as related_ids
from e join planned on planned.conv_id = e.conv_id left join c on post = "Id" """,
}
