"""The same results in DuckDB's SQL."""

from __future__ import annotations

REC = """
rec as (
  select 'events' as topic, cast(user_id % 4 as int) as kafka_partition,
         cast(row_number() over (partition by user_id % 4 order by event_id) - 1 as bigint) as kafka_offset,
         event_id, ts, user_id, event_type as protocol, value, props
  from events)"""

TOPICS = """
messages as (
  select 'events' as topic, cast(user_id % 4 as int) as kafka_partition, event_id as ord,
         case when event_id % 101 <> 0 then props end as body, epoch_us(ts) // 1000 as ingest_ms from events
  union all
  select 'orders', cast(o_custkey % 3 as int), o_orderkey, o_orderpriority, epoch_us(o_orderdate) // 1000 from orders
  union all
  select 'documents', cast(doc_id % 2 as int), doc_id, text, null from documents),
topics as (
  select topic, kafka_partition,
         cast(row_number() over (partition by topic, kafka_partition order by ord) - 1 as bigint) as kafka_offset,
         printf('%016X', ord) as key_hex, body, ingest_ms
  from messages)"""

PLAN = f"""{REC},
ranges as (
  select topic, kafka_partition, protocol as encoded_partition, kafka_offset // 1000 as chunk,
         min(kafka_offset) as start_offset, max(kafka_offset) as end_offset, count(*) as n_records
  from rec group by all),
plan as (
  select *, sum(n_records) over (partition by topic, kafka_partition, chunk) >= 1000 as complete,
         topic || '/' || encoded_partition as directory,
         printf('%s+%d+%010d+%010d%s', topic, kafka_partition, start_offset, end_offset, '.parquet') as committed_file,
         printf('+tmp/%s/%s/%d-%d_tmp.parquet', topic, encoded_partition, kafka_partition, chunk) as temp_file
  from ranges)"""

NAMES = f"""{PLAN},
stems as (
  select *, 'topics/' || directory || '/' as dir,
         printf('%s+%d+%d+%d', topic, kafka_partition, start_offset, end_offset) as stem
  from plan),
names as (
  select dir || committed_file as path, committed_file as file_name from stems
  union all select dir || 'a.b-' || committed_file, 'a.b-' || committed_file from stems
  union all select dir || stem, stem from stems
  union all select dir || stem || 'xparquet', stem || 'xparquet' from stems
  union all select dir || stem || '.a.b', stem || '.a.b' from stems
  union all select dir || printf('%s+%d+%010d+1%012d.seq', topic, kafka_partition, start_offset, end_offset),
                   printf('%s+%d+%010d+1%012d.seq', topic, kafka_partition, start_offset, end_offset) from stems
  union all select dir || stem || '_tmp.parquet', stem || '_tmp.parquet' from stems
  union all select 'topics/+tmp/' || committed_file, committed_file from stems)"""

PATTERN = r"^([a-zA-Z0-9._\-]+)\+(\d+)\+(\d+)\+(\d+)(.\w+)?$"


def _part(number: int) -> str:
    return f"regexp_extract(file_name, '{PATTERN}', {number})"


PARSED = f"""{NAMES},
parsed as (
  select path, file_name, regexp_matches(file_name, '{PATTERN}') as ok, {_part(1)} as topic,
         try_cast({_part(2)} as int) as kafka_partition, try_cast({_part(3)} as bigint) as start_offset,
         try_cast({_part(4)} as bigint) as end_offset, {_part(5)} as extension
  from names)"""

REDELIVERED = f"""{REC},
src as (
  select topic, kafka_partition, kafka_offset,
         cast(row_number() over (partition by topic, kafka_partition
                                 order by kafka_offset // 500, pass, kafka_offset) - 1 as bigint) as arrival_seq
  from (select topic, kafka_partition, kafka_offset, 0 as pass from rec
        union all select topic, kafka_partition, kafka_offset, 1 from rec where kafka_offset % 500 >= 450))"""

GAPPED = f"""{REC},
src as (
  select topic, kafka_partition, kafka_offset, kafka_offset as arrival_seq from rec where kafka_offset % 333 <> 332)"""

POSITIONS = """
positions as (
  select topic, kafka_partition, max(end_offset) + 1 as next_offset from plan where complete group by all)"""

LOG = f"""{PLAN},
entries as (
  select topic, kafka_partition, chunk, 1 as step, temp_file as key, committed_file as value from plan
  union all select distinct topic, kafka_partition, chunk, 0, 'BEGIN', '' from plan
  union all select distinct topic, kafka_partition, chunk, 2, 'END', '' from plan where chunk % 3 <> 2),
log as (
  select topic, kafka_partition,
         cast(row_number() over (partition by topic, kafka_partition order by chunk, step, value, key) - 1 as bigint) as seq,
         key, value
  from entries)"""


def _strict(source: str) -> str:
    return f"""
with recursive {source},
 s as (select *, case when kafka_offset = lag(kafka_offset) over w + 1 then 0 else 1 end brk from src
       window w as (partition by topic, kafka_partition order by arrival_seq)),
 u as (select *, sum(brk) over (partition by topic, kafka_partition order by arrival_seq) run from s),
 r as (select topic, kafka_partition, run, min(kafka_offset) a, max(kafka_offset) b from u group by all),
 f as (select topic, kafka_partition, run, a as lo, b + 1 as expected from r where run = 1
       union all
       select r.topic, r.kafka_partition, r.run,
              case when f.expected between r.a and r.b then f.expected end,
              case when f.expected between r.a and r.b then r.b + 1 else f.expected end
       from f join r on r.topic = f.topic and r.kafka_partition = f.kafka_partition and r.run = f.run + 1)
select u.topic, u.kafka_partition, u.kafka_offset, u.arrival_seq
from u join f using (topic, kafka_partition, run) where u.kafka_offset >= f.lo"""


def _monotonic(source: str) -> str:
    return f"""
with {source}
select topic, kafka_partition, kafka_offset, arrival_seq from (
  select *, max(kafka_offset) over (partition by topic, kafka_partition order by arrival_seq
                                    rows between unbounded preceding and 1 preceding) m from src)
where m is null or kafka_offset > m"""


def _rotation(flush_size: int, interval_ms: int) -> str:
    return f"""
with recursive {REC},
 d as (select topic, kafka_partition, kafka_offset,
              epoch_us(date_trunc('hour', ts)) // 1000 + 3600000 as now_ms from rec),
 e as (select *, dense_rank() over (partition by topic, kafka_partition order by now_ms) b,
              row_number() over (partition by topic, kafka_partition, now_ms order by kafka_offset) p from d),
 s as (select topic, kafka_partition, b, now_ms, count(*) n from e group by all),
 t as (select topic, kafka_partition, 0::bigint b, 0::bigint n, false fire, 0::bigint c_in, 0::bigint base,
              0::bigint c, 0::bigint last, 0::bigint chunks from s where b = 1
       union all
       select topic, kafka_partition, b, n, fire, c, chunks,
              case when fire then (n - 1) % {flush_size} else (c + n) % {flush_size} end,
              case when rot > 0 then now_ms else last end, chunks + rot
       from (select s.topic, s.kafka_partition, s.b, s.n, s.now_ms, t.c, t.last, t.chunks,
                    s.now_ms - t.last >= {interval_ms} fire,
                    case when s.now_ms - t.last >= {interval_ms} then 1 + (s.n - 1) // {flush_size}
                         else (t.c + s.n) // {flush_size} end rot
             from t join s on s.topic = t.topic and s.kafka_partition = t.kafka_partition and s.b = t.b + 1))
select e.topic, e.kafka_partition, e.kafka_offset,
       cast(t.base + case when not t.fire then (t.c_in + e.p - 1) // {flush_size}
                          when e.p = 1 then 0 else 1 + (e.p - 2) // {flush_size} end as bigint) as chunk
from e join t using (topic, kafka_partition, b)"""


ENVELOPE = "topic, kafka_partition, kafka_offset"

ORACLES: dict[str, str] = {
    "records_scan": f"""
with {TOPICS}
select {ENVELOPE}, key_hex, cast(strlen(body) as bigint) as value_bytes, ingest_ms from topics""",
    "route_counts": f"""
with {TOPICS} select topic, kafka_partition, count(*) as n_records from topics group by all""",
    "raw_bytes": f"""
with {TOPICS} select {ENVELOPE}, key_hex, md5(body) as value_md5 from topics""",
    "leaf_dirs": f"""
with {NAMES} select distinct regexp_extract(path, '^(.*)/[^/]*$', 1) as directory from names""",
    "decode_payload": f"""
with {REC}
select {ENVELOPE}, protocol, event_id, epoch_us(ts) // 1000 as ts_millis, user_id, value, props,
       replace(props, ' ', '|') as tags
from rec where event_id % 97 <> 0 and event_id % 101 <> 0""",
    "dead_letter": f"""
with {REC}
select {ENVELOPE}, case when event_id % 97 = 0 then '0AFF' end as value_hex,
       case when event_id % 97 = 0 then 'DecodeError' else 'null payload' end as decode_error
from rec where event_id % 97 = 0 or event_id % 101 = 0""",
    "reencode_payload": f"""
with {REC} select {ENVELOPE}, event_id, protocol, props, epoch_us(ts) // 1000 as ts_millis from rec""",
    "time_key": f"""
with {REC} select {ENVELOPE}, printf('%016X', epoch_us(ts) // 1000) as key_hex from rec""",
    "encode_default": f"""
with {REC} select {ENVELOPE}, 'partition=' || kafka_partition as encoded_partition from rec""",
    "encode_protocol": f"""
with {REC}
select {ENVELOPE}, case event_id % 10 when 0 then 'unknown' when 1 then '' else protocol end as encoded_partition
from rec""",
    "encode_field": f"""
with {REC} select {ENVELOPE}, 'user_id=' || user_id as encoded_partition from rec""",
    "encode_time": f"""
with {REC}
select {ENVELOPE}, strftime(date_trunc('hour', ts) + interval 210 minute,
                            'year=%Y/month=%m/day=%d/hour=%H/half=%M') as encoded_partition
from rec""",
    "encode_custom": f"""
with {REC} select {ENVELOPE}, protocol || '/' || (user_id % 10) as encoded_partition from rec""",
    "partition_path": f"""
with {REC}
select topic, kafka_partition, count(*) as n_records, topic || '/partition=' || kafka_partition as relative,
       'hdfs://data/topics/' || topic as topic_directory,
       'hdfs://data/topics/' || topic || '/partition=' || kafka_partition as directory,
       'hdfs://data/topics/' || topic || '/partition=' || kafka_partition || '/f.parquet' as file,
       'hdfs://data/logs/' || topic || '/' || kafka_partition || '/log' as log
from rec group by topic, kafka_partition""",
    "committed_name": f"""
with {PLAN}
select committed_file as padded,
       printf('%s+%d+%02d+%02d%s', topic, kafka_partition, start_offset, end_offset, '.seq') as narrow,
       printf('%s+%d+%d+%d', topic, kafka_partition, start_offset, end_offset) as bare
from plan""",
    "parse_committed": f"""
with {PARSED}
select path, case when ok then topic end as topic, case when ok then kafka_partition end as kafka_partition,
       case when ok then start_offset end as start_offset, case when ok then end_offset end as end_offset,
       case when ok then extension end as extension
from parsed""",
    "filter_committed": f"with {PARSED} select path, file_name from parsed where ok",
    "filter_topic": f"with {PARSED} select path, file_name from parsed where ok and topic = 'a.b-events'",
    "filter_topic_partition": f"""
with {PARSED} select path, file_name from parsed where ok and topic = 'events' and kafka_partition = 2""",
    "filter_end_offset": f"with {PARSED} select path, file_name from parsed where ok and end_offset = 999",
    "exclude_temp": rf"""
with {NAMES}
select path, file_name from names where not contains(path, '/+tmp/') and not regexp_matches(path, '_tmp(\.\w+)?$')""",
    "accept_strict": _strict(REDELIVERED),
    "accept_strict_gapped": _strict(GAPPED),
    "accept_monotonic": _monotonic(REDELIVERED),
    "accept_monotonic_gapped": _monotonic(GAPPED),
    "resume_filter": f"""
with {PLAN}, {POSITIONS}
select {ENVELOPE}, event_id from rec left join positions using (topic, kafka_partition)
where next_offset is null or kafka_offset >= next_offset""",
    "redelivery": f"""
with {PLAN}, {POSITIONS}, {REDELIVERED[len(REC) + 1:]}
select {ENVELOPE}, min(arrival_seq) as arrival_seq from src left join positions using (topic, kafka_partition)
where next_offset is null or kafka_offset >= next_offset group by all""",
    "publish_pending": f"""
with {PLAN} select topic, kafka_partition, chunk, committed_file from plan where chunk % 2 <> 0""",
    "file_plan": f"with {PLAN} select * exclude (temp_file) from plan",
    "max_offset_file": f"""
with {PARSED}
select topic, kafka_partition, max(end_offset) as end_offset,
       arg_min(path, row(-end_offset, path)) as path
from parsed where ok and extension <> '.seq' and not contains(path, '/+tmp/') group by all""",
    "committed_positions": f"""
with {PLAN}, {POSITIONS}, {TOPICS}
select topic, kafka_partition, coalesce(next_offset, -1) as next_offset
from (select distinct topic, kafka_partition from topics) left join positions using (topic, kafka_partition)""",
    "uncommitted_counts": f"""
with {PLAN}, {POSITIONS}
select topic, kafka_partition, count(case when next_offset is null or kafka_offset >= next_offset then 1 end) as n_uncommitted
from rec left join positions using (topic, kafka_partition) group by all""",
    "rotate_by_count": f"with {REC} select {ENVELOPE}, kafka_offset // 1000 as chunk from rec",
    "rotate_by_count_gapped": f"""
with {GAPPED}
select {ENVELOPE}, (row_number() over (partition by topic, kafka_partition order by kafka_offset) - 1) // 1000 as chunk
from src""",
    "rotate_by_time": _rotation(1 << 62, 21_600_000),
    "rotate_combined": _rotation(20, 21_600_000),
    "rotation_tail": f"""
with {PLAN}
select topic, kafka_partition, chunk, count(*) as n_files, cast(sum(n_records) as bigint) as n_records
from plan where not complete group by all""",
    "file_order": f"""
with {REC}
select topic, kafka_partition, protocol as encoded_partition, kafka_offset // 1000 as chunk, kafka_offset, event_id,
       row_number() over (partition by topic, kafka_partition, protocol, kafka_offset // 1000 order by kafka_offset) as place
from rec""",
    "name_order": f"with {PLAN} select committed_file, start_offset from plan order by committed_file",
    "commitlog_entries": f"with {LOG} select * from log",
    "commitlog_replay": f"""
with {LOG},
l as (select *, sum(case when key = 'BEGIN' then 1 else 0 end)
                  over (partition by topic, kafka_partition order by seq) g from log),
m as (select topic, kafka_partition, g, max(case when key = 'END' then seq end) last_end from l group by all)
select l.topic, l.kafka_partition, min(l.seq) as seq, l.value as committed_file, arg_min(l.key, l.seq) as temp_file
from l join m using (topic, kafka_partition, g)
where l.key not in ('BEGIN', 'END') and l.seq < m.last_end
  and not exists (select 1 from plan p where p.committed_file = l.value and p.chunk % 2 = 0)
  and exists (select 1 from plan p where p.temp_file = l.key
              and (p.kafka_partition <> 3 or p.encoded_partition <> 'error'))
group by l.topic, l.kafka_partition, l.value""",
    "list_committed": f"""
with {PLAN}
select 'topics/' || directory || '/' || committed_file as path, topic, kafka_partition, start_offset, end_offset
from plan where complete""",
    "manifest_rebuilt": f"""
with {PLAN}
select topic, kafka_partition, encoded_partition, start_offset, end_offset, committed_file from plan""",
    "read_committed": f"""
with {PLAN}
select topic, kafka_partition, start_offset, end_offset, event_id, protocol
from rec join plan using (topic, kafka_partition)
where protocol = encoded_partition and kafka_offset // 1000 = chunk""",
    "read_committed_sequence": f"""
with {PLAN}
select topic, kafka_partition, start_offset, end_offset, event_id, protocol
from rec join plan using (topic, kafka_partition)
where protocol = encoded_partition and kafka_offset // 1000 = chunk""",
    "parquet_sink_roundtrip": f"""
with {REC}
select topic, kafka_partition, event_id, protocol, user_id, epoch_us(ts) // 1000 as ts_millis, value, props,
       replace(props, ' ', '|') as tags
from rec""",
    "sequence_sink_roundtrip": f"""
with {REC} select printf('%016X', 1706745600000) as key_hex, event_id, protocol, props from rec""",
    "exactly_once_ingest": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "stream_ingest": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "stream_rotation": f"""
with {REC}, sizes as (select topic, kafka_partition, count(*) // 1000 as n_full from rec group by all)
select topic, kafka_partition, protocol as encoded_partition, min(kafka_offset) as start_offset, max(kafka_offset) as end_offset,
       count(*) as n_records,
       topic || '+' || kafka_partition || '+' || printf('%010d', min(kafka_offset)) || '+' || printf('%010d', max(kafka_offset)) || '.parquet' as committed_file
from rec join sizes using (topic, kafka_partition) where kafka_offset // 1000 < n_full group by topic, kafka_partition, protocol, kafka_offset // 1000""",
    "manifest_compacted": f"""
with {PLAN} select topic, kafka_partition, encoded_partition, start_offset, end_offset, n_records, committed_file from plan where complete""",
    "manifest_addressed": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "follow_committed": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "fenced_writers": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "tail_drained": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "crash_before_manifest": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "resume_new_checkpoint": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "replay_time_partitioned": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec",
    "ingest_duplicates": f"with {REC} select topic, kafka_partition, event_id, protocol, props from rec where kafka_offset < 40",
    "stream_accept": _strict(REDELIVERED),
    "stream_accept_stateful": _strict(REDELIVERED),
}
