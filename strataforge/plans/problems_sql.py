"""DuckDB SQL for the pN_ queries of the general problems, written from the problem statements, not from the Spark plans."""

_FILLED = "lower(trim({0})) not in ('', 'n/a', 'unknown', '-', 'tbc')"
_OPEN = "timestamp '9999-12-31 00:00:00'"
_FMT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


def _txn(*cols: str) -> str:
    return f"(select fuel_transaction_id, {', '.join(cols)} from feature_fuel_anomaly_score where fuel_transaction_id is not null qualify row_number() over (partition by fuel_transaction_id order by scored_at desc, batch_date desc) = 1)"


P1 = f"""
with recursive v as (
  select distinct on (vehicle_sk) vehicle_sk sk, upper(trim(vehicle_id)) v, effective_from f, coalesce(effective_to, {_OPEN}) t, lower(trim(source_record_hash)) h
  from dim_vehicle where vehicle_id is not null and effective_from is not null order by vehicle_sk
), cut as (
  select v, f, least(t, coalesce(lead(f) over (partition by v order by f, sk), {_OPEN})) t, h from v
), marks as (
  select *, case when lag(t) over w = f and lag(h) over w is not distinct from h then 0 else 1 end s from cut where f < t window w as (partition by v order by f)
), runs as (
  select *, sum(s) over (partition by v order by f) r from marks
), base as (
  select v, min(f) f, max(t) t, any_value(h) h from runs group by v, r
), fullrows as (
  select upper(trim(vehicle_id)) v, _batch_date::timestamp d, effective_at e, lower(trim(_record_hash)) h, coalesce(_is_latest_for_business_key, false) l, updated_at u, staged_row_id i
  from vehicles_ext where _load_type = 'full' and vehicle_id is not null and _batch_date is not null
), cal as (
  select d, row_number() over (order by d) n from (select distinct d from fullrows)
), snap as (
  select v, n, max(l) l, arg_max(e, (u, i)) filter (l) e, arg_max(h, (u, i)) filter (l) h from fullrows join cal using (d) group by v, n
), ents as (
  select v from base union select v from snap
), st as (
  select v, 0::bigint n, max(f) filter (t = {_OPEN}) ofrom, max(h) filter (t = {_OPEN}) ohash, max(greatest(f, case when t <> {_OPEN} then t end)) latest, null::timestamp xfrom, null::timestamp xto
  from ents left join base using (v) group by v
  union all
  select v, n,
    case when gone then null when begins then b else ofrom end,
    case when gone then null when begins then h else ohash end,
    case when gone then greatest(latest, d) when begins then greatest(latest, b) else latest end,
    case when gone or begins then ofrom end,
    case when ofrom is null then null when gone then d when begins then b end
  from (
    select s.v, c.n, c.d, s.ofrom, s.ohash, s.latest, r.h,
      r.v is null and s.ofrom is not null gone,
      coalesce(r.l, false) and (s.ofrom is null or s.ohash is distinct from r.h) begins,
      case when r.e > coalesce(s.latest, timestamp '1900-01-01') then r.e else c.d end b
    from st s join cal c on c.n = s.n + 1 left join snap r on r.v = s.v and r.n = c.n
  )
)
select v vehicle_id, {_FMT.format('f')} effective_from, {_FMT.format('t')} effective_to from (
  select v, f, t from base where t <> {_OPEN}
  union all select v, xfrom, xto from st where xfrom is not null
  union all select v, ofrom, {_OPEN} from st where n = (select coalesce(max(n), 0) from cal) and ofrom is not null
)
"""

P2 = f"""
with v as (
  select distinct vehicle_sk sk, upper(trim(vehicle_id)) v, effective_from f, coalesce(effective_to, {_OPEN}) t from dim_vehicle
), p as (
  select sk, v, f, least(t, coalesce(lead(f) over (partition by v order by f, sk), {_OPEN})) t from v
), x as (
  select t.fuel_transaction_id, t.vehicle_sk stored, max(p.sk) sk
  from {_txn('vehicle_id', 'vehicle_sk', 'transaction_datetime')} t
  left join p on p.v = upper(trim(t.vehicle_id)) and {_FILLED.format('t.vehicle_id')} and p.f <= t.transaction_datetime and t.transaction_datetime < p.t
  group by all
)
select fuel_transaction_id, coalesce(sk, -1)::bigint vehicle_sk from x where stored is distinct from sk
"""

P3 = """
select vehicle_id, record_hash from (
  select upper(trim(vehicle_id)) vehicle_id, lower(trim(_record_hash)) record_hash, _delta_action a,
    row_number() over (partition by upper(trim(vehicle_id)) order by updated_at desc, _ingest_timestamp desc nulls last, _source_row_number desc nulls last) r
  from vehicles_ext where _load_type = 'delta' and updated_at is not null and vehicle_id is not null
) where r = 1 and not coalesce(upper(ltrim(a)) like 'D%', false)
"""

P4 = """
with recursive rows_ as (
  select upper(trim(vehicle_id)) v, _batch_date d, coalesce(_is_latest_for_business_key, false) l, lower(trim(_record_hash)) h, updated_at u, staged_row_id i
  from vehicles_ext where _load_type = 'full' and vehicle_id is not null and _batch_date is not null
), cal as (select d, row_number() over (order by d) n from (select distinct d from rows_)),
snap as (select v, n, bool_or(l) l, arg_max(h, (u, i)) filter (l) h from rows_ join cal using (d) group by v, n),
ents as (select distinct v from snap),
st as (
  select v, 0::bigint n, null::varchar old, null::varchar h from ents
  union all
  select s.v, c.n, s.h, case when r.v is null then null when r.l then r.h else s.h end
  from st s join cal c on c.n = s.n + 1 left join snap r on r.v = s.v and r.n = c.n
)
select strftime(d, '%Y-%m-%d') batch_date, v vehicle_id, case when old is null then 'added' when h is null then 'removed' else 'changed' end change_kind
from st join cal using (n) where n > 1 and old is distinct from h
"""

_P6_DENSE = f"""
with t as (
  select upper(trim(fuel_card_id)) c, coalesce(transaction_date, transaction_datetime::date) d, coalesce(gross_amount, 0) a
  from {_txn('fuel_card_id', 'transaction_date', 'transaction_datetime', 'gross_amount')} where {_FILLED.format('fuel_card_id')}
), daily as (select c, d, sum(a) a, count(*) n from t where d is not null group by all),
firsts as (select c, min(d) d0 from daily group by c),
dense as (
  select f.c, x.d::date d, coalesce(y.a, 0) a, coalesce(y.n, 0) n
  from (select c, unnest(generate_series(d0::timestamp, timestamp '2025-03-31', interval 1 day)) d from firsts) x
  join firsts f using (c) left join daily y on y.c = f.c and y.d = x.d::date
), roll as (
  select c, d, sum(a) over w7 s7, sum(n) over w7 n7, sum(a) over w30 s30, sum(n) over w30 n30 from dense
  window w7 as (partition by c order by d rows 6 preceding), w30 as (partition by c order by d rows 29 preceding)
)
"""
P6 = _P6_DENSE + "select c fuel_card_id, strftime(d, '%Y-%m-%d') on_date from roll where n7 >= 4 and s7 >= 900 and s30 / 30 < 50"
P6_ROLLING = _P6_DENSE + (
    "select c entity, d on_date, s7::decimal(38,2) total_7, n7::bigint n_7, s30::decimal(38,2) total_30, n30::bigint n_30,"
    " (round(s7 / 7, 6))::decimal(28,6) avg_7, (round(s30 / 30, 6))::decimal(28,6) avg_30 from roll"
)

_P7 = f"""
select 'vehicles_ext' child_table, strftime(_batch_date, '%Y-%m') period_month, staged_row_id::varchar record_key, upper(trim(client_id)) ref_key
from vehicles_ext x where {_FILLED.format('client_id')} and not exists (
  select 1 from dim_client p where upper(trim(p.client_id)) = upper(trim(x.client_id)) and p.effective_from <= x._batch_date::timestamp and x._batch_date::timestamp < coalesce(p.effective_to, {_OPEN}))
union all
select 'feature_fuel_anomaly_score', strftime(transaction_datetime, '%Y-%m'), fuel_transaction_id, upper(trim(fuel_card_id))
from {_txn('fuel_card_id', 'transaction_datetime')} x where {_FILLED.format('fuel_card_id')} and not exists (
  select 1 from dim_fuel_card p where upper(trim(p.fuel_card_id)) = upper(trim(x.fuel_card_id)) and p.effective_from <= x.transaction_datetime and x.transaction_datetime < coalesce(p.effective_to, {_OPEN}))
"""
P7_REPORT = f"select child_table, period_month, count(*) n_references, count(distinct ref_key) n_keys from ({_P7}) group by all"

SQL = {"p1_found": P1, "p2_found": P2, "p3_found": P3, "p4_found": P4, "p6_rolling": P6_ROLLING, "p6_found": P6, "p7_found": _P7, "p7_report": P7_REPORT}
