"""DuckDB SQL for the queries of __spark_entry__.py."""

FIVE = 'event_type, uid, "timestamp", ip, impression_id'


def events_cte(types: str = "where event_type in ('view', 'click')") -> str:
    return f"""ev as (
  select event_id as seq,
         case event_type when 'view' then 'display' else event_type end as event_type,
         user_id::varchar as uid,
         cast(floor(epoch(ts)) as bigint) as "timestamp",
         '10.0.0.' || (props->>'k') as ip,
         user_id::varchar || '-' || strftime(ts, '%Y%m%d') as impression_id
  from events {types})"""


EV = events_cte()

JSON = """'{"eventType":"' || event_type || '","uid":"' || uid || '","timestamp":' || "timestamp"
  || ',"ip":"' || ip || '","impressionId":"' || impression_id || '"}'"""
HOUR = """strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d--%H')"""

# Boundaries of the data-anchored window and events marked with them.
BOUNDED = """sec as (select "timestamp" as ts, min(seq) as seq from ev group by 1),
b(seq, ts) as (
  select min(seq), arg_min("timestamp", seq) from ev
  union all
  select min(sec.seq), arg_min(sec.ts, sec.seq) from b join sec on sec.ts >= b.ts + 1800 group by b.seq),
hits as (select seq, ts from b where seq <> (select min(seq) from ev)),
m as (select ev.*, case when hits.seq is null then 0 else 1 end as hit from ev left join hits on hits.seq = ev.seq)"""
MARKED = f"{EV},\n{BOUNDED}"
# The same over all messages that decode.
JOB = events_cte("where event_type <> 'error'") + f",\n{BOUNDED}"

P1 = """p1_a as (select *, sum(hit) over (partition by uid order by seq) as seg from m),
p1_b as (select *, sum(case when event_type = 'display' then 1 else -1 end)
                     over (partition by uid, seg order by seq) as bal from p1_a),
p1_c as (select *, max(case when event_type <> 'display' and bal < 0 then 1 else 0 end)
                     over (partition by uid order by seq) as bad from p1_b),
p1 as (select * from p1_c where event_type <> 'display' and bad = 1)"""

P2 = """p2_a as (select *, sum(hit) over (partition by impression_id order by seq) as seg from m),
p2_b as (select *, last_value(case when event_type = 'display' then "timestamp" end ignore nulls)
                     over (partition by impression_id, seg order by seq) as ld from p2_a),
p2 as (select * from p2_b where event_type <> 'display' and ld - "timestamp" < 2)"""

P3 = """p3_a as (select *, sum(hit) over (partition by ip order by seq) as seg from m),
p3_b as (select *, count(*) over (partition by ip, seg order by seq) as n from p3_a),
p3_c as (select *, case when event_type <> 'display' and n >= 10 then 1 else 0 end as h from p3_b),
p3_d as (select *, h + coalesce(max(h) over (partition by ip order by seq
                     rows between unbounded preceding and 1 preceding), 0) as k from p3_c),
p3 as (select p3_d.*, g.copy from p3_d join (select unnest([1, 2]) as copy) g on g.copy <= p3_d.k
       where event_type <> 'display')"""

ALL = f"""with recursive {MARKED},
{P1},
{P2},
{P3},
flagged as (select 'Pattern 1' as pattern, seq, 1 as copy, {FIVE} from p1
  union all select 'Pattern 2', seq, 1, {FIVE} from p2
  union all select 'Pattern 3', seq, copy, {FIVE} from p3)"""


def grid(window_seconds: int) -> str:
    return f"""with {EV},
g as (select *, "timestamp" // {window_seconds} as w from ev)"""


def p1_grid(rows: str = "g") -> str:
    return f"""a as (select *, sum(case when event_type = 'display' then 1 else -1 end)
        over (partition by uid, w order by seq) as bal from {rows}),
b as (select *, max(case when event_type <> 'display' and bal < 0 then 1 else 0 end)
        over (partition by uid order by seq) as bad from a)"""


def p1_documented(w: int) -> str:
    return f"{grid(w)}, {p1_grid()} select seq, {FIVE} from b where event_type <> 'display' and bad = 1"


def p2_documented(w: int, threshold: int) -> str:
    return f"""{grid(w)},
a as (select *, last_value(case when event_type = 'display' then "timestamp" end ignore nulls)
        over (partition by impression_id, w order by seq) as ld from g)
select seq, {FIVE} from a
where event_type <> 'display' and "timestamp" - ld >= 0 and "timestamp" - ld < {threshold}"""


def p3_grid(w: int, condition: str) -> str:
    return f"""{grid(w)},
a as (select *,
        sum(case when event_type = 'display' then 0 else 1 end) over (partition by ip, w order by seq) as ck,
        sum(case when event_type = 'display' then 1 else 0 end) over (partition by ip, w order by seq) as dk from g),
b as (select *, max(case when event_type <> 'display' and ck >= 10 and coalesce({condition}, false) then 1 else 0 end)
        over (partition by ip order by seq) as bad from a)
select seq, {FIVE} from b where event_type <> 'display' and bad = 1"""


REAL_RATIO = "ck::double / nullif(dk, 0)::double >= 0.3"
INT_RATIO = "ck // nullif(dk, 0) >= 1"

RUNNING = f"""with {EV}
select seq, event_type, count(*) over (partition by event_type order by seq) as n from ev"""

AFTER = f"""{ALL},
inv as (select count(*) as n_invalid from (select distinct {FIVE} from flagged)),
cnt as (select count(*) filter (event_type = 'display') as n_displays,
               count(*) filter (event_type = 'click') as n_clicks from ev),
per as (select count(*) filter (pattern = 'Pattern 1') as n_1, count(*) filter (pattern = 'Pattern 2') as n_2,
               count(*) filter (pattern = 'Pattern 3') as n_3 from flagged)"""


def late(window: int, delay: int) -> str:
    """Events with their window, and whether it was over for the stream, of three pieces, when they came."""
    return f"""span as (select min(seq) as low, max(seq) as high from ev),
cut as (select ev.*, "timestamp" // {window} as w,
        (seq >= low + (high - low) // 3)::int + (seq >= low + (high - low) * 2 // 3)::int as piece from ev, span),
latest as (select piece, max("timestamp") as last from cut group by piece),
marks as (select a.piece, max(b.last) - {delay} as mark from latest a join latest b on b.piece < a.piece group by a.piece),
g as (select cut.*, coalesce((w + 1) * {window} <= mark, false) as late from cut left join marks using (piece))"""


def oracle_sql(window: int, threshold: int, ip_window: int, delay: int) -> dict[str, str]:
    p1 = f"with recursive {MARKED}, {P1} select seq, {FIVE} from p1"
    p2 = f"with recursive {MARKED}, {P2} select seq, {FIVE} from p2"
    p3 = f"with recursive {MARKED}, {P3} select seq, {FIVE} from p3"
    p1_doc = p1_documented(window)
    p2_doc = p2_documented(window, threshold)
    p3_doc = p3_grid(ip_window, REAL_RATIO)
    p3_int = p3_grid(ip_window, INT_RATIO)
    five = f"with {EV} select seq, {FIVE} from ev"
    totals = f"with {EV} select event_type, count(*) as n from ev group by 1"
    tumbling = f"""with {EV}
select make_timestamp(("timestamp" // 1800) * 1800000000) as window_start, event_type, count(*) as n
from ev group by 1, 2"""
    pattern_totals = f"{ALL} select event_type, pattern, count(*) as n from flagged group by 1, 2"
    pattern_running = f"""{ALL}
select seq, pattern, event_type, count(*) over (partition by pattern, event_type order by seq, copy
                                                rows between unbounded preceding and current row) as n from flagged"""
    return {
        "project_event": five,
        "filter_clicks": f"with {EV} select seq, {FIVE} from ev where event_type = 'click'",
        "split_types": f"""with {events_cte("")}
select case when event_type = 'display' then 'display' else 'click' end as role, count(*) as n from ev group by 1""",
        "event_time": f"""with {EV} select seq, make_timestamp("timestamp" * 1000000) as event_time from ev""",
        "json_decode": five,
        "json_malformed": f"""with {events_cte("")}
select count(*) filter (event_type <> 'error') as decoded, count(*) filter (event_type = 'error') as rejected from ev""",
        "event_to_text": f"""with {EV}
select seq, 'Event{{eventType=''' || event_type || ''', uid=''' || uid || ''', timestamp=' || "timestamp"
  || ', ip=''' || ip || ''', impressionId=''' || impression_id || '''}}' as line from ev""",
        "log_parse": five,
        "window_boundaries": f"""with recursive {MARKED} select seq, ts as "timestamp" from hits""",
        "key_segments": f"""with recursive {MARKED}
select seq, cast(sum(hit) over (partition by uid order by seq) as bigint) as seg_uid,
       cast(sum(hit) over (partition by impression_id order by seq) as bigint) as seg_impression,
       cast(sum(hit) over (partition by ip order by seq) as bigint) as seg_ip from m""",
        "p1_as_coded": p1,
        "p2_as_coded": p2,
        "p3_as_coded": p3,
        "p1_documented": p1_doc,
        "p2_documented": p2_doc,
        "p3_documented": p3_doc,
        "p3_separate_int": p3_int,
        "p1_as_coded_split": p1,
        "p2_as_coded_split": p2,
        "p3_as_coded_split": p3,
        "p1_documented_split": p1_doc,
        "p3_documented_split": p3_doc,
        "blacklist_uid": f"with recursive {MARKED}, {P1} select uid, min(seq) as first_seq from p1 group by 1",
        "blacklist_ip": f"with recursive {MARKED}, {P3} select ip, min(seq) as first_seq from p3 group by 1",
        "running_counts": RUNNING,
        "running_counts_split": RUNNING,
        "type_totals": totals,
        "pattern_totals": pattern_totals,
        "pattern_running": pattern_running,
        "pattern_running_split": pattern_running,
        "tumbling_counts": tumbling,
        "fraud_union_all": f"{ALL} select {FIVE} from flagged",
        "fraud_distinct": f"{ALL} select distinct {FIVE} from flagged",
        "ctr": f"""with {EV},
cnt as (select count(*) filter (event_type = 'display') as n_displays,
               count(*) filter (event_type = 'click') as n_clicks from ev)
select n_displays, n_clicks, n_clicks::double / nullif(n_displays, 0)::double as ctr from cnt""",
        "ctr_after_fraud": f"""{AFTER}
select n_displays, n_clicks, n_invalid,
       (n_clicks - n_invalid)::double / nullif(n_displays, 0)::double as ctr from cnt, inv""",
        "report_lines": f"""{AFTER},
num as (select *, n_clicks::double / nullif(n_displays, 0)::double as before,
               (n_clicks - n_invalid)::double / nullif(n_displays, 0)::double as after from cnt, inv, per)
select 1 as line_no, printf('The click-through-rate equals %.1f%%.', 100 * before) as text from num
union all select 2, printf('%d clicks have been detected as fraudulent out of %d clicks.', n_invalid, n_clicks) from num
union all select 3, printf('The click-through-rate equals %.1f%%.', 100 * after) from num
union all select 4, printf('The pattern that detects clicks without corresponding displays flagged %d clicks.', n_1) from num
union all select 5, printf('The pattern that detects clicks that occured too fast flagged %d clicks.', n_2) from num
union all select 6, printf('The pattern that detects clicks with hyperactive IP addresses %d clicks.', n_3) from num""",
        "hour_bucket": f"""with {EV}
select strftime(make_timestamp("timestamp" * 1000000), '%Y-%m-%d--%H') as bucket, count(*) as n from ev group by 1""",
        "fraud_json": f"""{ALL}
select seq, '{{"eventType":"' || event_type || '","uid":"' || uid || '","timestamp":' || "timestamp"
  || ',"ip":"' || ip || '","impressionId":"' || impression_id || '"}}' as value
from (select distinct seq, {FIVE} from flagged)""",
        "p1_documented_stream": p1_doc,
        "p2_documented_stream": p2_doc,
        "p3_documented_stream": p3_doc,
        "as_coded_stream": f"{ALL} select pattern, seq, {FIVE} from flagged",
        "tumbling_counts_stream": tumbling,
        "blacklist_uid_stream": f"""{grid(window)}, {p1_grid()}
select uid, min(seq) as first_seq from b where event_type <> 'display' and bad = 1 group by 1""",
        "blacklist_ip_stream": f"select ip, min(seq) as first_seq from ({p3_doc}) group by 1",
        "p1_late_stream": f"""with {EV}, {late(window, delay)}, {p1_grid("g where not late")}
select seq, 'flagged' as verdict from b where event_type <> 'display' and bad = 1
union all select seq, 'late' from g where late""",
        "tumbling_late_stream": f"""with {EV}, {late(1800, delay)}
select make_timestamp(w * 1800000000) as window_start, event_type, count(*) filter (not late) as n,
       count(*) filter (late) as n_late from g group by 1, 2""",
        "totals_table": totals,
        "log_compacted": f"with {EV} select {FIVE} from ev",
        "p1_held_stream": p1,
        "kafka_frame": f"""with {EV}
select cast("timestamp"::hugeint * 1000 * {10**24}::hugeint
            + (case when event_type = 'display' then 2 else 1 end)::hugeint * {10**23}::hugeint
            + (uid::bigint % 4)::hugeint * {10**18}::hugeint + seq as varchar) as seq, {FIVE} from ev""",
        "topic_strings": f"with {EV} select {JSON} as value from ev where event_type <> 'display'",
        "record_lines": f"""with {EV}
select 'offset = ' || seq || ', key = ' || uid || ', value = ' || {JSON} as line from ev""",
        "json_lines": f"""with {EV} select event_type as topic, uid, "timestamp", ip, impression_id from ev""",
        "log_hour": f"""with {EV} select {FIVE} from ev where {HOUR} = (select min({HOUR}) from ev)""",
        "log_sink": f"with {EV} select {FIVE} from ev",
        "raw_to_files": f"with {EV} select {JSON} as value from ev where event_type <> 'display'",
        "job_totals": f"""with recursive {JOB},
{P1},
{P2},
{P3},
flagged as (select 'Pattern 1' as pattern, event_type from p1 union all select 'Pattern 2', event_type from p2
  union all select 'Pattern 3', event_type from p3)
select pattern, event_type, count(*) as n from flagged group by 1, 2
union all select null, event_type, count(*) from ev group by 2
union all select null, 'rejected', count(*) from events where event_type = 'error'""",
        "report_numbers": f"""{AFTER}
select n_displays, n_clicks, n_invalid, n_1, n_2, n_3, n_clicks::double / nullif(n_displays, 0)::double as ctr_before,
       (n_clicks - n_invalid)::double / nullif(n_displays, 0)::double as ctr_after from cnt, inv, per""",
    }
