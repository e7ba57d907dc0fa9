"""The same questions in plain SQL, for an independent engine to answer.

Written for DuckDB over the given tables. Percentages and means are rounded with
integer arithmetic, half away from zero, so no tie depends on binary fractions.
"""

from __future__ import annotations

MARK = "timestamp '2024-01-15 12:20:00'"
SECOND_RUN = "timestamp '2024-01-20 09:30:00'"
CLOCK = "timestamp '2024-01-15 12:00:00'"
EPOCH = "timestamp '1970-01-01 00:00:00'"


def _pct(a: str, n: str) -> str:
    return f"((20000 * cast({a} as bigint) + {n}) // (2 * {n})) / 100.0"


def _mean(total: str, n: str) -> str:
    return f"((200 * cast({total} as bigint) + {n}) // (2 * {n})) / 100.0"


def _payments(name: str = "payments", edge: bool = False) -> str:
    ets = "case when n = 1 and event_id % 40 = 1 then ts + interval 5 minute else ts end" if edge else "ts"
    flag = "n > 0 and event_id % 40 <> 2" if edge else "n > 0"
    return f"""{name}_rows as (
  select event_id, user_id, n, {ets} as ets, {flag} as is_retry_flag,
         cast(value as decimal(18,4)) as amount,
         ['NGN','USD','GBP','EUR','KES','GHS'][1 + event_id % 6] as currency
  from events, unnest(range(0, 1 + case when event_id % 100 = 0 then 5
                                         when event_id % 20 < 3 then 1 else 0 end)) as r(n)
), {name}_named as (
  select case when n = 0 then 'pay_' || event_id else 'ret_' || event_id || '_' || n end as payment_id,
         'cust_' || user_id as customer_id, 'merchant_' || (event_id % 10) as merchant_id,
         amount, currency,
         ['card','bank_transfer','wallet','ussd'][1 + (event_id + n) % 4] as payment_method,
         ['initiated','pending'][1 + (event_id + n) % 2] as status,
         n as retry_count, is_retry_flag,
         case when n > 0 then 'pay_' || event_id end as original_payment_id,
         ets as event_timestamp, ets + to_seconds(7 * n) as ingested_at,
         cast(user_id % 6 as integer) as kafka_partition,
         cast((event_id * 7919 + n * 31) % 61 as bigint) as processing_latency_ms,
         time_bucket(interval 5 minute, ets) as bucket, event_id
  from {name}_rows
), {name} as (
  select payment_id,
         sha256(customer_id || '|' || merchant_id || '|' || cast(amount as varchar) || '|' || currency
                || '|' || strftime(bucket, '%Y-%m-%dT%H:%M:%S') || '+00:00') as idempotency_key,
         * exclude (payment_id, bucket),
         ingested_at + to_milliseconds(processing_latency_ms) as decision_at
  from {name}_named
)"""


def _decide(source: str, out: str) -> str:
    return f"""{out}_ranked as (
  select *, row_number() over w as rn, first_value(payment_id) over w as holder from {source}
  window w as (partition by idempotency_key order by ingested_at, kafka_partition, payment_id)
), {out} as (
  select * exclude (rn, holder, original_payment_id),
         case when rn = 1 then 'ACCEPTED' else 'REJECTED_DUPLICATE' end as dedup_status,
         case when rn > 1 then 'Duplicate idempotency key detected' end as rejection_reason,
         case when rn > 1 then holder end as original_payment_id
  from {out}_ranked
)"""


BASE = "with " + _payments() + ", " + _decide("payments", "silver")
EDGE = "with " + _payments(edge=True) + ", " + _decide("payments", "silver")

_STATS = f"""count(*) as n,
    count(*) filter (dedup_status = 'ACCEPTED') as acc,
    count(*) filter (dedup_status = 'REJECTED_DUPLICATE') as rej,
    count(*) filter (processing_latency_ms < 50) as within_sla,
    count(*) filter (processing_latency_ms >= 50) as breached,
    {_mean('sum(processing_latency_ms)', 'count(*)')} as avg_ms,
    max(processing_latency_ms) as max_ms,
    round(quantile_cont(processing_latency_ms, 0.5), 2) as p50_ms,
    round(quantile_cont(processing_latency_ms, 0.95), 2) as p95_ms,
    round(quantile_cont(processing_latency_ms, 0.99), 2) as p99_ms"""


def _merchant(source: str) -> str:
    return f"""select merchant_id, hour_bucket, n as total_payments, acc as accepted_payments,
    rej as rejected_duplicates, {_pct('rej', 'n')} as duplicate_rate_pct, avg_ms as avg_latency_ms,
    p95_ms as p95_latency_ms, p99_ms as p99_latency_ms
  from (select merchant_id, date_trunc('hour', decision_at) as hour_bucket, {_STATS}
        from {source} group by all) g"""


def _sla(source: str) -> str:
    return f"""select hour_bucket, n as total_decisions, within_sla as within_sla_count,
    breached as breached_sla_count, {_pct('within_sla', 'n')} as sla_compliance_pct,
    avg_ms as avg_latency_ms, max_ms as max_latency_ms, p50_ms as p50_latency_ms,
    p95_ms as p95_latency_ms, p99_ms as p99_latency_ms
  from (select date_trunc('hour', decision_at) as hour_bucket, {_STATS} from {source} group by all) g"""


def _customer(source: str) -> str:
    return f"""select customer_id, strftime(decision_at, '%Y-%m-%d') as day_bucket,
    count(*) as total_payments,
    count(*) filter (dedup_status = 'ACCEPTED') as unique_payments,
    count(*) filter (dedup_status = 'REJECTED_DUPLICATE') as duplicate_attempts,
    cast(max(case when dedup_status = 'REJECTED_DUPLICATE' then 1 else 0 end) as bigint) as max_retries_single_txn,
    count(*) filter (dedup_status = 'REJECTED_DUPLICATE') > 3 as flagged_for_review
  from {source} group by all"""


def _upsert(make, keys: list[str]) -> str:
    on = " and ".join(f"o.{k} = w.{k}" for k in keys)
    return f"""{BASE}, old as ({make(f"(select * from silver where decision_at <= {MARK})")}),
  new as ({make(f"(select * from silver where decision_at > {MARK})")})
select * from new as w union all
select * from old as o where not exists (select 1 from new as w where {on})"""


def _two_slices(make, keys: list[str]) -> str:
    on = " and ".join(f"o.{k} = w.{k}" for k in keys)
    return f"""{BASE}, first_run as ({make(f"(select * from silver where decision_at <= {SECOND_RUN})")}),
  second_run as ({make(f"(select * from silver where decision_at > {SECOND_RUN})")})
select * from second_run as w union all
select * from first_run as o where not exists (select 1 from second_run as w where {on})"""


# The JSON record, once plain and once with itself embedded.
_FIELDS = """payment_id: payment_id, idempotency_key: idempotency_key, customer_id: customer_id,
  merchant_id: merchant_id, amount: cast(amount as double), currency: currency,
  payment_method: payment_method, status: status, source_ip: cast(null as varchar),
  user_agent: cast(null as varchar), retry_count: retry_count, is_retry_flag: is_retry_flag,
  original_payment_id: original_payment_id,
  event_timestamp: strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'"""
_VALUE = f"cast(to_json({{{_FIELDS}, raw_payload: {{{_FIELDS}}}}}) as varchar)"

_FAULTY = f"""messages as (select *, event_id % 50 as kind, {_VALUE} as value from payments),
faulty as (
  select * exclude (value),
    case kind
      when 0 then left(value, length(value) - 20)
      when 1 then regexp_replace(value, '"payment_id":"[^"]*",', '', 'g')
      when 2 then regexp_replace(value, '"currency":"([A-Z]{{3}})"', '"currency":"\\1X"', 'g')
      when 3 then regexp_replace(value, '"amount":[0-9.E-]+', '"amount":"n/a"', 'g')
      when 4 then regexp_replace(value, '"customer_id":"[^"]*"', '"customer_id":null', 'g')
      else value end as value,
    case kind
      when 0 then 'not valid JSON' when 1 then 'payment_id missing' when 2 then 'currency longer than 3'
      when 3 then 'amount not a decimal' when 4 then 'customer_id missing' end as reason
  from messages
)"""

_BRONZE_COLUMNS = """payment_id, idempotency_key, customer_id, merchant_id, cast(amount as double) as amount,
  currency, payment_method, status, cast(retry_count as bigint) as retry_count, is_retry_flag,
  original_payment_id, event_timestamp, ingested_at"""

_VALID_DECISIONS = f"""{BASE}, {_FAULTY}, good as (select * from faulty where reason is null),
{_decide('good', 'decided')}, all_decisions as (
  select payment_id, idempotency_key, customer_id, merchant_id, dedup_status, rejection_reason, original_payment_id
  from decided
  union all
  select payment_id, idempotency_key, case when kind <> 4 then customer_id end, merchant_id,
         'REJECTED_INVALID', reason, cast(null as varchar)
  from faulty where kind in (2, 3, 4)
)"""

_TTL = """with recursive ev as (
  select 'pay_' || event_id as payment_id, user_id || '|' || event_type as idempotency_key, ts from events
), chain(idempotency_key, since) as (
  select idempotency_key, min(ts) from ev group by 1
  union all
  select c.idempotency_key, min(e.ts) from chain c
  join ev e on e.idempotency_key = c.idempotency_key and e.ts >= c.since + interval 24 hour
  group by c.idempotency_key
), holders as (
  select c.idempotency_key, c.since, min(e.payment_id) as holder
  from chain c join ev e on e.idempotency_key = c.idempotency_key and e.ts = c.since group by all
)
select ev.payment_id, ev.idempotency_key,
       case when ev.payment_id = h.holder then 'ACCEPTED' else 'REJECTED_DUPLICATE' end as dedup_status,
       case when ev.payment_id <> h.holder then h.holder end as original_payment_id
from ev asof join holders h on ev.idempotency_key = h.idempotency_key and ev.ts >= h.since"""

_CELLS = """cells as (
  select b.is_retry_flag, s.dedup_status, count(*) as "count"
  from payments b join silver s using (payment_id) group by all
), matrix as (
  select cast(coalesce(sum("count") filter (is_retry_flag and dedup_status = 'REJECTED_DUPLICATE'), 0) as bigint) as tp,
         cast(coalesce(sum("count") filter (not is_retry_flag and dedup_status = 'ACCEPTED'), 0) as bigint) as tn,
         cast(coalesce(sum("count") filter (not is_retry_flag and dedup_status = 'REJECTED_DUPLICATE'), 0) as bigint) as fp,
         cast(coalesce(sum("count") filter (is_retry_flag and dedup_status = 'ACCEPTED'), 0) as bigint) as fn
  from cells
)"""

_SUMMARY = f"""summary as (
  select (select count(*) from payments) as bronze_total,
         (select count(*) from silver) as silver_total,
         (select count(*) from silver where dedup_status = 'ACCEPTED') as accepted,
         (select count(*) from silver where dedup_status = 'REJECTED_DUPLICATE') as rejected,
         (select {_mean('sum(processing_latency_ms)', 'count(*)')} from silver) as avg_latency_ms,
         (select round(quantile_cont(processing_latency_ms, 0.99), 2) from silver) as p99_latency_ms,
         (select count(*) from silver where processing_latency_ms >= 50) as sla_breaches,
         (select count(*) from ({_customer('silver')}) where flagged_for_review) as flagged_customers
)"""

_CHAINS = """chains as (
  select customer_id, coalesce(original_payment_id, payment_id) as chain, decision_at, dedup_status,
         lag(decision_at) over (partition by customer_id, coalesce(original_payment_id, payment_id)
                                order by decision_at) as before
  from silver
)"""


def _histogram(by: str) -> str:
    part = f"partition by {by}" if by else ""
    lead = f"{by}, " if by else ""
    using = f"{by}, bin" if by else "bin"
    return f"""{BASE}, placed as (
  select {lead}processing_latency_ms as ms, min(processing_latency_ms) over ({part}) as lo,
         max(processing_latency_ms) over ({part}) as hi from silver
), counted as (
  select {lead}least(29, (ms - lo) * 30 // nullif(hi - lo, 0)) as bin, count(*) as n from placed group by all
), ranges as (
  select distinct {lead}lo, hi, bin from placed, unnest(range(0, 30)) as r(bin)
)
select {lead}ranges.bin as bin, round(lo + ranges.bin * ((hi - lo) / 30.0), 6) as bin_start,
       round(lo + (ranges.bin + 1) * ((hi - lo) / 30.0), 6) as bin_end, coalesce(n, 0) as n
from ranges left join counted using ({using})"""


_SYSTEM = f"""{BASE}, r as (
  select strftime(ingested_at, '%Y-%m-%d') as day_bucket, count(*) as total_events_received from payments group by 1
), g as (
  select strftime(decision_at, '%Y-%m-%d') as day_bucket, count(distinct customer_id) as unique_customers,
         count(distinct merchant_id) as unique_merchants, {_STATS} from silver group by 1
) select day_bucket, coalesce(total_events_received, 0) as total_events_received,
    coalesce(acc, 0) as total_accepted, coalesce(rej, 0) as total_rejected,
    coalesce({_pct('rej', 'n')}, 0) as overall_duplicate_rate,
    coalesce({_pct('within_sla', 'n')}, 0) as overall_sla_compliance,
    avg_ms as avg_latency_ms, p99_ms as p99_latency_ms,
    coalesce(unique_customers, 0) as unique_customers, coalesce(unique_merchants, 0) as unique_merchants
from r full outer join g using (day_bucket)"""


SQL: dict[str, str] = {
    "idempotency_key": f"{BASE} select payment_id, idempotency_key from payments",
    "five_minute_bucket": "select event_id, time_bucket(interval 5 minute, ts) as bucket from events",
    "key_mismatch": "with " + _payments("plain") + ", " + _payments("shifted", edge=True) + """
select s.payment_id, s.customer_id, p.idempotency_key, s.idempotency_key as recomputed_key
from shifted s join plain p using (payment_id) where p.idempotency_key <> s.idempotency_key""",
    "latency_ms": f"""{BASE} select payment_id,
  (epoch_us(decision_at) - epoch_us(event_timestamp)) // 1000 as latency_ms from payments""",
    "kafka_projection": f"{BASE} select customer_id as key, {_VALUE} as value from payments",
    "decisions_projection": f"""{BASE} select customer_id as key, cast(to_json({{
  payment_id: payment_id, idempotency_key: idempotency_key, idempotency_key_hash: idempotency_key,
  customer_id: customer_id, merchant_id: merchant_id, amount: cast(amount as double), currency: currency,
  payment_method: payment_method, dedup_status: dedup_status, rejection_reason: rejection_reason,
  original_payment_id: original_payment_id, processing_latency_ms: processing_latency_ms,
  event_timestamp: strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00',
  decision_at: strftime(decision_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'}}) as varchar) as value from silver""",
    "bronze_parse": f"{BASE} select {_BRONZE_COLUMNS} from payments",
    "bronze_append": f"""{BASE}, {_FAULTY} select {_BRONZE_COLUMNS},
  strftime(ingested_at, '%Y-%m-%d') as ingested_date from faulty where reason is null""",
    "deadletter": f"""{BASE}, {_FAULTY} select case when kind > 1 then payment_id end as payment_id,
  reason as invalid_reason, value as raw_payload, ingested_at, cast(kafka_partition as bigint) as kafka_partition
from faulty where reason is not null""",
    "decisions_with_invalid": f"{_VALID_DECISIONS} select * from all_decisions",
    "dedup_decisions": f"""{BASE} select payment_id, idempotency_key, 'idem:' || idempotency_key as registry_key,
  customer_id, merchant_id, cast(amount as double) as amount, currency, payment_method, dedup_status,
  rejection_reason, original_payment_id, processing_latency_ms, event_timestamp, decision_at from silver""",
    "dedup_decisions_edge": f"{EDGE} select payment_id, dedup_status, original_payment_id from silver",
    "dedup_decisions_ttl": _TTL,
    "dedup_decisions_hot": _TTL,
    "decision_counts": f"""{_VALID_DECISIONS} select count(*) as total_processed,
  count(*) filter (dedup_status = 'ACCEPTED') as total_accepted,
  count(*) filter (dedup_status = 'REJECTED_DUPLICATE') as total_rejected,
  count(*) filter (dedup_status = 'REJECTED_INVALID') as total_errors from all_decisions""",
    "registry_snapshot": f"""{BASE} select count(distinct idempotency_key) as live_keys from silver
where dedup_status = 'ACCEPTED' and ingested_at <= {CLOCK} and ingested_at + interval 24 hour > {CLOCK}""",
    "silver_insert_if_absent": f"""{BASE} select payment_id, dedup_status, decision_at from silver
where decision_at > {MARK}""",
    "gold_merchant_hourly": f"{BASE} {_merchant('silver')}",
    "gold_sla_hourly": f"{BASE} {_sla('silver')}",
    "gold_customer_daily": f"{BASE} {_customer('silver')}",
    "customer_retry_depth": f"""{BASE}, {_CHAINS} select customer_id, day_bucket, max(dups) as max_retries_per_payment
from (select customer_id, strftime(decision_at, '%Y-%m-%d') as day_bucket, chain,
             count(*) filter (dedup_status = 'REJECTED_DUPLICATE') as dups from chains group by all) g
group by all""",
    "customer_retry_interval": f"""{BASE}, {_CHAINS}, gaps as (
  select customer_id, strftime(decision_at, '%Y-%m-%d') as day_bucket, count(*) as retry_gaps,
         cast(sum(epoch_us(decision_at) - epoch_us(before)) as bigint) as us
  from chains where before is not null group by all
) select customer_id, day_bucket, coalesce(retry_gaps, 0) as retry_gaps,
         ((2 * us + retry_gaps * 10000) // (retry_gaps * 20000)) / 100.0 as avg_retry_interval_sec
from (select distinct customer_id, strftime(decision_at, '%Y-%m-%d') as day_bucket from silver)
left join gaps using (customer_id, day_bucket)""",
    "gold_system_summary": _SYSTEM,
    "gold_flagged_top10": f"""{BASE} select customer_id, day_bucket, duplicate_attempts
from ({_customer('silver')}) where flagged_for_review
order by duplicate_attempts desc, customer_id, day_bucket limit 10""",
    "gold_merchant_upsert": _upsert(_merchant, ["merchant_id", "hour_bucket"]),
    "gold_sla_upsert": _upsert(_sla, ["hour_bucket"]),
    "gold_customer_upsert": _upsert(_customer, ["customer_id", "day_bucket"]),
    "gold_merchant_two_runs_slice": _two_slices(_merchant, ["merchant_id", "hour_bucket"]),
    "gold_merchant_two_runs_full": f"{BASE} {_merchant('silver')}",
    "gold_sla_two_runs_full": f"{BASE} {_sla('silver')}",
    "gold_customer_two_runs_full": f"{BASE} {_customer('silver')}",
    "gold_system_two_runs_full": _SYSTEM,
    "gold_merchant_two_runs_merge": f"{BASE} {_merchant('silver')}",
    "gold_sla_two_runs_merge": f"{BASE} {_sla('silver')}",
    "gold_customer_two_runs_merge": f"{BASE} {_customer('silver')}",
    "gold_unique_estimates": f"""{BASE} select strftime(decision_at, '%Y-%m-%d') as day_bucket,
  count(distinct customer_id) as unique_customers, count(distinct merchant_id) as unique_merchants,
  true as unique_customers_within, true as unique_merchants_within from silver group by 1""",
    "hwm_max": f"{BASE} select max(decision_at) as max_decision_at from silver where decision_at > {MARK}",
    "hwm_slice": f"""{BASE} select payment_id, dedup_status, decision_at from silver
where decision_at > {MARK} and decision_at <= {SECOND_RUN}""",
    "hwm_seed": f"""select p as pipeline_name, {EPOCH} as last_processed_at, cast(0 as bigint) as rows_processed
from (values ('customer_retry_patterns_daily'), ('system_summary_daily')) as s(p)""",
    "hwm_read": f"""{BASE} select 'sla_compliance_hourly' as pipeline_name, max(decision_at) as last_processed_at from silver
union all select 'system_summary_daily', {EPOCH}""",
    "hwm_advance": f"""{BASE}, m as (select max(decision_at) as newest from silver)
select 'merchant_duplicate_rate_hourly' as pipeline_name, (select newest from m) as last_processed_at,
       (select count(*) from ({_merchant('silver')})) as rows_processed
union all select 'sla_compliance_hourly', (select newest from m), (select count(*) from ({_sla('silver')}))
union all select p, {EPOCH}, 0
from (values ('customer_retry_patterns_daily'), ('system_summary_daily')) as s(p)""",
    "hwm_advance_runs": f"""{BASE}
select 'merchant_duplicate_rate_hourly' as pipeline_name, (select max(decision_at) from silver) as last_processed_at,
  (select count(*) from ({_merchant(f"(select * from silver where decision_at <= {SECOND_RUN})")}))
  + (select count(*) from ({_merchant(f"(select * from silver where decision_at > {SECOND_RUN})")})) as rows_processed
union all select p, {EPOCH}, 0
from (values ('sla_compliance_hourly'), ('customer_retry_patterns_daily'), ('system_summary_daily')) as s(p)""",
    "recon_layer_counts": f"""{EDGE}
select 'Bronze (Raw Events)' as layer, count(*) as total, count(*) filter (is_retry_flag) as duplicates,
       count(*) filter (not is_retry_flag) as fresh from payments
union all
select 'Silver (Decisions)', count(*), count(*) filter (dedup_status = 'REJECTED_DUPLICATE'),
       count(*) filter (dedup_status = 'ACCEPTED') from silver""",
    "recon_confusion": f"""{EDGE}, {_CELLS} select * from cells order by is_retry_flag, dedup_status""",
    "recon_confusion_matrix": f"{EDGE}, {_CELLS} select * from matrix",
    "recon_precision_recall": f"""{EDGE}, {_CELLS} select tp, tn, fp, fn,
  round(case when tp + fp > 0 then tp / (tp + fp) else 0 end, 6) as "precision",
  round(case when tp + fn > 0 then tp / (tp + fn) else 0 end, 6) as recall from matrix""",
    "recon_sla": f"""{BASE} select within_sla, breached, {_pct('within_sla', 'n')} as compliance_pct,
  avg_ms, p95_ms, p99_ms, max_ms from (select {_STATS} from silver) g""",
    "recon_merchant_rate": f"""{BASE} select merchant_id, n as total, acc as accepted, rej as rejected,
  {_pct('rej', 'n')} as duplicate_rate_pct from (select merchant_id, {_STATS} from silver group by 1) g
order by duplicate_rate_pct desc, merchant_id""",
    "recon_merchant_band": f"""{BASE} select *, case when duplicate_rate_pct > 16 then 'red'
    when duplicate_rate_pct > 14 then 'yellow' else 'green' end as band
from (select merchant_id, n as total, acc as accepted, rej as rejected, {_pct('rej', 'n')} as duplicate_rate_pct
      from (select merchant_id, {_STATS} from silver group by 1) g) m""",
    "recon_missing_decisions": f"""{BASE}, b as (
  select payment_id, count(*) as c from payments where processing_latency_ms <> 11 group by 1
), s as (select payment_id, count(*) as c from silver where processing_latency_ms <> 7 group by 1)
select payment_id, case when s.c is null then 'silver' else 'bronze' end as missing_in, coalesce(b.c, s.c) as row_count
from b full outer join s using (payment_id) where b.c is null or s.c is null""",
    "recon_summary": f"""{BASE}, {_SUMMARY} select *,
  ((2000 * rejected + bronze_total) // (2 * bronze_total)) / 10.0 as duplicate_rate_pct from summary""",
    "recon_verdicts": f"""{BASE}, {_SUMMARY}, {_CELLS}
select bronze_total = silver_total as counts_match,
       (select fp = 0 and fn = 0 from matrix) as detection_perfect,
       sla_breaches = 0 and silver_total > 0 as sla_met,
       case when bronze_total = silver_total and sla_breaches = 0
            then 'ALL CHECKS PASSED' else 'REVIEW REQUIRED' end as overall_status from summary""",
    "latency_histogram": _histogram(""),
    "latency_histogram_by_status": _histogram("dedup_status"),
    "stream_bronze": f"{BASE}, {_FAULTY} select {_BRONZE_COLUMNS} from faulty where reason is null",
    "stream_dedup": f"{BASE} select payment_id, dedup_status, original_payment_id from silver",
    "stream_dedup_batches": _TTL,
    "stream_dedup_stateful_batches": _TTL,
    "stream_deadletter": f"""{BASE}, {_FAULTY} select distinct case when kind > 1 then payment_id end as payment_id,
  reason as invalid_reason, value as raw_payload, 'silver' as layer from faulty where reason is not null""",
    "stream_dedup_moved_batches": _TTL,
    "stream_dedup_stateful_moved_batches": _TTL,
    "stream_dedup_stateful_evict": _TTL,
    "stream_state_after_evict": f"""with decided as ({_TTL}), times as (
  select d.idempotency_key, d.payment_id, ts as accepted_at, (select max(ts) from events) as newest
  from decided d join events on d.payment_id = 'pay_' || event_id where dedup_status = 'ACCEPTED'
) select idempotency_key, payment_id, accepted_at from times
where accepted_at + interval 24 hour > newest - interval 1 day
qualify row_number() over (partition by idempotency_key order by accepted_at desc) = 1""",
    "stream_running_counts": f"""{BASE}, {_FAULTY}, span as (
  select epoch_us(min(ingested_at)) as low, (epoch_us(max(ingested_at)) - epoch_us(min(ingested_at))) // 4 + 1 as width from payments
), received as (
  select reason from faulty union all
  select reason from faulty, span where (epoch_us(ingested_at) - low) // width = 1
) select count(*) as total_received, count(*) filter (reason is null) as total_processed,
  count(*) filter (reason is not null) as total_errors, cast(4 as bigint) as batches from received""",
    "stream_dedup_stateful": f"{BASE} select payment_id, dedup_status, original_payment_id from silver",
}
