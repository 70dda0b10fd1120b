"""SQL twins of the registered queries (DuckDB dialect, plain windows and
group-bys). The adapter views they name are added as CTEs by ``with_views``."""

from __future__ import annotations

from basketry.plans.views_sql import with_views

_SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    _SQL[name] = text


def oracle_sql() -> dict[str, str]:
    return {k: with_views(v) for k, v in _SQL.items()}


# --- carts -------------------------------------------------------------------------

sql("cart_totals", """
select session_id, cast(sum(price * quantity) as decimal(38,4)) as total,
       cast(sum(quantity) as bigint) as item_count, count(*) as scan_count
from cart_lines group by session_id""")

_MERGED = """
merged as (
  select session_id, barcode, quantity, price_at_addition, added_at from (
    select session_id, barcode,
           cast(sum(quantity) over (partition by session_id, barcode) as bigint) as quantity,
           price as price_at_addition, scanned_at as added_at,
           row_number() over (partition by session_id, barcode order by scanned_at, seq, price) as rn
    from cart_lines) x where rn = 1)"""

sql("scan_merge", f"with {_MERGED} select * from merged")

sql("cart_snapshot", f"""
with {_MERGED},
totals as (select session_id, cast(sum(price_at_addition * quantity) as decimal(38,4)) as total,
                  cast(sum(quantity) as bigint) as item_count from merged group by session_id)
select s.session_id, m.barcode, m.quantity, m.price_at_addition,
       coalesce(t.total, cast(0 as decimal(38,4))) as total,
       coalesce(t.item_count, cast(0 as bigint)) as item_count
from (select distinct session_id from sessions) s
left join totals t on t.session_id = s.session_id
left join merged m on m.session_id = s.session_id""")

sql("sorted_cart_lines", f"with {_MERGED} select * from merged order by session_id, barcode")

sql("cart_item_view", f"""
with {_MERGED}
select m.session_id, m.barcode as product_id, c.name as product_name, m.quantity, m.price_at_addition,
       cast(null as varchar) as image_url, m.added_at
from merged m left join catalog c on c.barcode = m.barcode""")

sql("cart_lines_by_session", """
with req as (
  select event_id, try_cast(regexp_extract(path, '^/api/cart/([0-9]+)', 1) as bigint) as session_id
  from access_log where starts_with(path, '/api/cart/'))
select r.event_id, r.session_id, l.barcode, l.quantity, l.price, l.seq
from req r join cart_lines l on l.session_id = r.session_id""")

sql("cart_line_by_session_product", """
with asked as (select distinct session_id, case when session_id % 3 = 0 then '0000000000000' else barcode end as barcode from cart_lines)
select a.session_id, a.barcode, c.seq, c.quantity, c.price, c.quantity is not null as found
from asked a left join cart_lines c on c.session_id = a.session_id and c.barcode = a.barcode""")

sql("enrich_scans", """
select r.request_id, r.barcode, c.name, c.price, c.image_url,
       case when c.name is null then 'product_not_found' else 'ok' end as outcome
from barcode_requests r left join full_products c on c.barcode = r.barcode""")

_W1 = """
ev as (
  select *, sum(case when kind = 'CLEAR' then 1 else 0 end) over (
           partition by session_id order by event_time, event_id rows between unbounded preceding and current row) as epoch
  from cart_events where kind in ('ADD', 'REMOVE', 'CLEAR')),
s1 as (
  select *, sum(case when kind = 'ADD' then 1 else -1 end) over (
           partition by session_id, barcode, epoch order by event_time, event_id
           rows between unbounded preceding and current row) as s
  from ev where kind <> 'CLEAR'),
s2 as (
  select *, least(0, min(s) over (partition by session_id, barcode, epoch order by event_time, event_id
                                  rows between unbounded preceding and current row)) as smin,
         least(0, coalesce(min(s) over (partition by session_id, barcode, epoch order by event_time, event_id
                                  rows between unbounded preceding and 1 preceding), 0)) as sminb
  from s1),
w1 as (
  select event_id, event_time, session_id, barcode, kind, cast(epoch as bigint) as epoch, price,
         cast(s - smin as int) as quantity,
         (kind = 'REMOVE' and s + 1 - sminb = 0) as rejected
  from s2)"""

sql("cart_running_quantity", f"with {_W1} select * from w1")

_W2 = _W1 + """,
lv as (
  select *, cast(sum(case when kind = 'ADD' and quantity = 1 then 1 else 0 end) over (
           partition by session_id, barcode, epoch order by event_time, event_id
           rows between unbounded preceding and current row) as bigint) as life
  from w1),
w2 as (
  select lv.*, st.price as line_price
  from lv left join (select session_id, barcode, epoch, life, price from lv
                     where kind = 'ADD' and quantity = 1) st
    on st.session_id = lv.session_id and st.barcode = lv.barcode and st.epoch = lv.epoch and st.life = lv.life)"""

sql("price_at_addition", f"""
with {_W2}
select event_id, event_time, session_id, barcode, kind, epoch, life, quantity, rejected,
       price as event_price, case when quantity > 0 then line_price end as price_at_addition
from w2""")

sql("price_drift", f"""
with {_W2}
select event_id, session_id, barcode, price as event_price, line_price as price_at_addition,
       price - line_price as drift
from w2 where kind = 'ADD' and price <> line_price""")

sql("cart_change_feed", f"""
with {_W2},
ch as (
  select event_id, event_time, session_id, barcode, kind, epoch, quantity,
         case when kind = 'ADD' then 1 else -1 end as dq,
         case when kind = 'ADD' then 1 else -1 end * line_price as dm
  from w2 where not rejected)
select event_id, event_time, session_id,
       case when kind = 'ADD' then 'ITEM_ADDED' else 'ITEM_REMOVED' end as event_type,
       barcode, quantity as line_quantity,
       cast(sum(dq) over (partition by session_id, epoch order by event_time, event_id
                          rows between unbounded preceding and current row) as bigint) as item_count,
       cast(sum(dm) over (partition by session_id, epoch order by event_time, event_id
                          rows between unbounded preceding and current row) as decimal(38,4)) as total,
       '/topic/cart/' || cast(session_id as varchar) as destination
from ch
union all
select event_id, event_time, session_id, 'CLEARED', cast(null as varchar), cast(null as int),
       cast(0 as bigint), cast(0 as decimal(38,4)), '/topic/cart/' || cast(session_id as varchar)
from cart_events where kind = 'CLEAR'""")

_LIVE = _W2 + """,
lastrow as (
  select session_id, barcode, epoch, quantity, case when quantity > 0 then line_price end as price from (
    select *, row_number() over (partition by session_id, barcode order by event_time desc, event_id desc) as rn
    from w2) x where rn = 1),
lastep as (select session_id, max(epoch) as last_epoch from ev group by session_id),
live as (
  select l.session_id, l.barcode, cast(l.quantity as bigint) as quantity, l.price
  from lastrow l join lastep e on e.session_id = l.session_id
  where l.epoch = e.last_epoch and l.quantity > 0)"""

sql("cart_read_through", f"""
with {_LIVE}, {_MERGED}
select session_id, barcode, quantity, price, 'cache' as source from live
union all
select session_id, barcode, quantity, price_at_addition as price, 'store' as source from merged m
where not exists (select 1 from live c where c.session_id = m.session_id)""")

sql("cart_ttl_view", f"""
with {_W1},
puts as (select * from w1 where not rejected and (kind = 'ADD' or quantity > 0)),
g as (
  select *, sum(case when prev is null or event_time >= prev + interval '24' hour then 1 else 0 end) over (
           partition by session_id, epoch order by event_time, event_id
           rows between unbounded preceding and current row) as grp
  from (select *, lag(event_time) over (partition by session_id, epoch order by event_time, event_id) as prev
        from puts) x)
select session_id, epoch, min(event_time) as first_put, max(event_time) as last_put, count(*) as puts,
       max(event_time) + interval '24' hour as expires_at
from g group by session_id, epoch, grp""")

_AS_OF = _W2 + """,
gone as (select session_id, event_time from cart_events where kind = 'CLEAR'),
asked as (select r.*, (select count(*) from gone c where c.session_id = r.session_id and c.event_time <= r.as_of) as epoch_now from cart_reads r),
puts as (
  select *, sum(case when prev is null or event_time >= prev + interval '24' hour then 1 else 0 end) over (
           partition by session_id, epoch order by event_time, event_id rows between unbounded preceding and current row) as grp
  from (select *, lag(event_time) over (partition by session_id, epoch order by event_time, event_id) as prev
        from w2 where not rejected and quantity > 0) x),
lastput as (
  select a.request_id, arg_max(struct_pack(grp := p.grp, t := p.event_time), (p.event_time, p.event_id)) as lp
  from asked a join puts p on p.session_id = a.session_id and p.epoch = a.epoch_now and p.event_time <= a.as_of group by a.request_id),
linenow as (
  select a.request_id, a.session_id, a.as_of, w.barcode, w.event_id, w.quantity, w.line_price
  from asked a join w2 w on w.session_id = a.session_id and w.epoch = a.epoch_now and w.event_time <= a.as_of
  qualify row_number() over (partition by a.request_id, w.barcode order by w.event_time desc, w.event_id desc) = 1),
stored as (select * from linenow where quantity > 0),
cached as (
  select s.*, l.lp.t + interval '24' hour as expires_at
  from stored s join puts p on p.event_id = s.event_id join lastput l on l.request_id = s.request_id
  where p.grp = l.lp.grp and s.as_of < l.lp.t + interval '24' hour)"""

sql("cart_as_of", f"""
with {_AS_OF}
select request_id, session_id, as_of, barcode, cast(quantity as bigint) as quantity, line_price as price, expires_at from cached""")

sql("cart_read_through_as_of", f"""
with {_AS_OF}
select request_id, session_id, as_of, barcode, cast(quantity as bigint) as quantity, line_price as price, 'cache' as source from cached
union all
select request_id, session_id, as_of, barcode, cast(quantity as bigint), line_price, 'store' from stored s
where not exists (select 1 from cached c where c.request_id = s.request_id)""")

sql("delete_by_key", f"""
with {_W1}
select * from cart_lines l
where not exists (select 1 from cart_events c where c.kind = 'CLEAR' and c.session_id = l.session_id)
  and not exists (select 1 from w1 where w1.kind = 'REMOVE' and not w1.rejected and w1.quantity = 0
                  and w1.session_id = l.session_id and w1.barcode = l.barcode)""")


# --- shared SQL fragments ------------------------------------------------------------

def _pads_hex(secret: str, bits: int = 256) -> tuple[str, str]:
    import hashlib

    from basketry.functions.columns import _hmac_pads
    block, digest = (64, hashlib.sha256) if bits == 256 else (128, hashlib.sha512)
    i, o = _hmac_pads(secret, block, digest)
    return i.hex(), o.hex()


def hmac_sql(msg: str, secret: str) -> str:
    """base64(HMAC-SHA256(secret, msg)) in DuckDB SQL."""
    i, o = _pads_hex(secret)
    return (f"to_base64(unhex(sha256(from_hex('{o}') || unhex(sha256(from_hex('{i}') || encode({msg}))))))")


def iso_sql(ts: str) -> str:
    us = f"(epoch_us({ts}) % 1000000)"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S') || case when {us} = 0 then '' "
            f"when {us} % 1000 = 0 then '.' || lpad(cast({us} // 1000 as varchar), 3, '0') "
            f"else '.' || lpad(cast({us} as varchar), 6, '0') end || 'Z')")


def uuid_sql(text: str) -> str:
    h = f"sha256({text})"
    return (f"(substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || "
            f"substr({h}, 17, 4) || '-' || substr({h}, 21, 12))")


def token_cols_sql(session: str, user: str, ttype: str, now: str, secret: str) -> str:
    exp = f"({now} + interval '24' hour)"
    payload = (f"cast(json_object('sessionId', cast({session} as varchar), 'userId', {user}, "
               f"'type', {ttype}, 'expiresAt', {iso_sql(exp)}) as varchar)")
    corr = uuid_sql(f"'qr:' || cast({session} as varchar) || ':' || {ttype}")
    return (f"{corr} as correlation_id, {ttype} as token_type, {payload} as payload, "
            f"'hmac:' || {hmac_sql(payload, secret)} as signature, 1 as key_version, "
            f"{exp} as expires_at, 'ACTIVE' as status")


from basketry.plans.registry import LOG_AS_OF, SESSIONS_AS_OF  # noqa: E402
from basketry.sources.fixtures import QR_SECRET as _QS  # noqa: E402

_EDGES = """edges as (select * from (values ('CREATED', 'ACTIVE'), ('CREATED', 'CANCELLED'), ('ACTIVE', 'PAYING'),
  ('ACTIVE', 'CANCELLED'), ('PAYING', 'COMPLETED'), ('PAYING', 'CANCELLED')) t(from_state, to_state))"""

_CHAIN = """chain as (
  select event_id, event_time, session_id,
         coalesce(lag(target) over (partition by session_id order by event_time, event_id), 'CREATED') as from_state,
         target as to_state
  from session_log)"""

sql("transition_check", f"""
with {_EDGES}, {_CHAIN}
select c.event_id, c.event_time, c.session_id, c.from_state, c.to_state, e.from_state is not null as legal,
       case when e.from_state is null then 'Cannot transition from ' || c.from_state || ' to ' || c.to_state end as message
from chain c left join edges e on e.from_state = c.from_state and e.to_state = c.to_state""")

sql("illegal_edges", f"""
with {_EDGES}, {_CHAIN}
select from_state, to_state, count(*) as n from chain c
where not exists (select 1 from edges e where e.from_state = c.from_state and e.to_state = c.to_state)
group by from_state, to_state""")

_CUR = "regexp_extract(a, '[A-Z]+$')"
_REPLAY = f"""
folded as (
  select session_id, list(event_id order by event_time, event_id) as ids,
         list_reduce(list(target order by event_time, event_id),
           lambda a, x: a || '|' || case
             when ({_CUR} = 'CREATED' and x in ('ACTIVE', 'CANCELLED'))
               or ({_CUR} = 'ACTIVE' and x in ('PAYING', 'CANCELLED'))
               or ({_CUR} = 'PAYING' and x in ('COMPLETED', 'CANCELLED')) then x
             else {_CUR} end,
           'CREATED') as states
  from session_log group by session_id),
per as (
  select session_id, unnest(ids) as event_id, unnest(range(1, len(ids) + 1)) as i,
         string_split(states, '|') as st
  from folded),
replay as (
  select l.event_id, l.event_time, l.session_id, l.user_id, l.target,
         p.st[p.i] as from_state, p.st[p.i] <> p.st[p.i + 1] as accepted, p.st[p.i + 1] as to_state,
         p.st[len(p.st)] as final_state
  from session_log l join per p on p.event_id = l.event_id)"""

sql("session_replay", f"with {_REPLAY} select * from replay")

_AUDIT = _REPLAY + """,
audit as (select event_id, event_time as transitioned_at, session_id, user_id, from_state, to_state
          from replay where accepted)"""

sql("transition_chain_audit", f"""
with {_EDGES}, {_AUDIT},
kept as (select * replace (case when event_id % 10 = 1 then 'CREATED' else to_state end as to_state) from audit where event_id % 9 <> 0)
select a.event_id, a.transitioned_at, a.session_id, a.from_state, a.to_state,
       a.from_state = coalesce(lag(a.to_state) over (partition by a.session_id order by a.transitioned_at, a.event_id),
                               'CREATED') as chain_ok,
       exists (select 1 from edges e where e.from_state = a.from_state and e.to_state = a.to_state) as edge_ok
from kept a""")

sql("state_dwell_time", f"""
with {_AUDIT},
d as (select to_state, transitioned_at,
             lead(transitioned_at) over (partition by session_id order by transitioned_at, event_id) as left_at
      from audit)
select to_state as state, count(*) as n,
       cast(sum(epoch_us(left_at) - epoch_us(transitioned_at)) // count(*) as bigint) as avg_micros,
       min(epoch_us(left_at) - epoch_us(transitioned_at)) as min_micros,
       max(epoch_us(left_at) - epoch_us(transitioned_at)) as max_micros
from d where left_at is not null group by to_state""")

sql("stuck_payments", f"""
with {_REPLAY}
select session_id, event_time as paying_since from replay
where final_state = 'PAYING' and accepted and target = 'PAYING'
  and event_time < timestamp '{LOG_AS_OF}' - interval '15' minute""")

sql("payment_receipts", f"""
with {_REPLAY}
select session_id, user_id, event_time as paid_at,
       cast(json_object('sessionId', session_id, 'userId', user_id, 'paidAt', {iso_sql('event_time')}) as varchar) as paid_event,
       cast(json_object('sessionId', session_id, 'completedAt', {iso_sql('event_time')}) as varchar) as completed_event,
       {token_cols_sql('session_id', 'user_id', "'EXIT'", 'event_time', _QS)}
from replay where accepted and target = 'COMPLETED'""")

sql("issue_tokens", f"""
select session_id, user_id,
       {token_cols_sql('session_id', 'user_id', "case when status = 'COMPLETED' then 'EXIT' else 'ENTRY' end", 'created_at', _QS)}
from sessions""")

sql("resolve_user", """
select event_id, path, coalesce(header_user_id, param_user_id) as user_id,
       case when coalesce(header_user_id, param_user_id) is null then 'missing_user' else 'ok' end as outcome
from access_log""")

_SID = uuid_sql("'session:' || cast(event_id as varchar)")
sql("start_sessions", f"""
with s as (
  select event_id, {_SID} as session_id, coalesce(header_user_id, param_user_id) as user_id,
         cast(coalesce(store_id, 1) as bigint) as store_id, 'CREATED' as status, event_time as created_at,
         event_time + interval '24' hour as expires_at
  from access_log where starts_with(path, '/api/sessions/') and coalesce(header_user_id, param_user_id) is not null)
select s.*, t.* exclude (k, expires_at, status), t.expires_at as token_expires_at, t.status as token_status
from s join (select event_id as k, {token_cols_sql('session_id', 'user_id', "'ENTRY'", 'created_at', _QS)} from s) t on t.k = s.event_id""")

_STORED = f"""stored as (
  select *, 'hmac:' || {hmac_sql("case when tampered then payload || '#' else payload end", _QS)} as vault_signature
  from qr_tokens)"""

sql("validate_tokens", """
select r.request_id, r.requested_at, r.correlation_id, r.gate, t.session_id, t.status as token_status,
       case when t.session_id is null then 'not_found' when t.status <> 'ACTIVE' then 'not_active'
            when r.requested_at > t.expires_at then 'expired' when t.signed_as <> 'own' then 'bad_signature' else 'ok' end as verdict
from gate_requests r left join gate_tokens t on t.correlation_id = r.correlation_id""")

# A fold: the requests of a session one after the other, with its status and the status of both tokens as the state.
_GATES = """
gq as (
  select r.*, t.session_id, t.expires_at, t.signed_as, right(r.correlation_id, 1) as no,
         row_number() over (partition by t.session_id order by r.requested_at, r.request_id) as n
  from gate_requests r join gate_tokens t on t.correlation_id = r.correlation_id),
gates as (
  with recursive step as (
    select s.session_id, cast(0 as bigint) as n, s.status as sess, a.status as s0, b.status as s1,
           cast(null as bigint) as request_id, cast(null as varchar) as found, cast(null as varchar) as held, cast(null as varchar) as result
    from gate_sessions s join gate_tokens a on a.correlation_id = 'gate-' || cast(s.session_id as varchar) || '-0'
    join gate_tokens b on b.correlation_id = 'gate-' || cast(s.session_id as varchar) || '-1'
    union all
    select session_id, n, case when result = 'ok' and gate = 'entry' then 'ACTIVE' else sess end,
           case when no = '0' then after else s0 end, case when no = '1' then after else s1 end, request_id, cur, sess, result
    from (
      select *, case result when 'ok' then 'USED' when 'expired' then 'EXPIRED' else cur end as after
      from (
        select *, case when cur <> 'ACTIVE' then 'not_active' when requested_at > expires_at then 'expired'
                       when signed_as <> 'own' then 'bad_signature'
                       when gate = 'entry' then case when sess = 'CREATED' then 'ok' else 'illegal_transition' end
                       when sess = 'COMPLETED' then 'ok' else 'not_completed' end as result
        from (select p.session_id, q.n, p.sess, p.s0, p.s1, q.request_id, q.requested_at, q.expires_at, q.signed_as, q.gate, q.no,
                     case when q.no = '0' then p.s0 else p.s1 end as cur
              from step p join gq q on q.session_id = p.session_id and q.n = p.n + 1) x) y) z)
  select r.request_id, r.correlation_id, r.gate, p.session_id, coalesce(p.result, 'not_found') as result, p.found, p.held
  from gate_requests r left join step p on p.request_id = r.request_id),
said as (
  select *, case result when 'not_found' then 'QR token not found for correlationId=' || correlation_id
                        when 'not_active' then 'QR token is not active, status=' || found when 'expired' then 'QR token has expired'
                        when 'bad_signature' then 'QR token signature verification failed'
                        when 'illegal_transition' then 'Cannot transition from ' || held || ' to ACTIVE' end as refusal
  from gates)"""

sql("gate_entry", f"""
with {_GATES}
select request_id, correlation_id, session_id, result as outcome, refusal as message, result = 'ok' as token_used,
       case when result = 'ok' then 'CREATED' end as from_state, case when result = 'ok' then 'ACTIVE' end as to_state,
       case when result = 'ok' then 'gate-entry' end as triggered_by, cast(null as varchar) as reason
from said where gate = 'entry'""")

sql("gate_exit", f"""
with {_GATES}
select request_id, correlation_id, case when result in ('ok', 'not_completed') then session_id end as session_id,
       result = 'ok' as valid, case result when 'ok' then 'Exit authorized' when 'not_completed' then 'Session is not in COMPLETED state'
                                           else refusal end as message,
       result = 'ok' as token_used
from said where gate = 'exit'""")

_PLONG = "case when regexp_matches({c}, '^[+-]?[0-9]+$') then try_cast({c} as bigint) end"

sql("session_access_check", f"""
with r as (
  select event_id, session_text, user_text, {_PLONG.format(c='session_text')} as sid,
         {_PLONG.format(c='user_text')} as uid
  from access_requests),
j as (select r.*, s.user_id as owner, s.status from r left join sessions s on s.session_id = r.sid),
o as (select *, case when sid is null or uid is null then 'INVALID_ARGUMENT' when owner is null then 'NOT_FOUND'
                     when owner <> uid then 'PERMISSION_DENIED' else 'OK' end as outcome from j)
select event_id, session_text, user_text, outcome, coalesce(outcome = 'OK' and status = 'ACTIVE', false) as valid
from o""")

_HELP = f"""
hq as (
  select e.event_id, e.event_time, e.session_id, e.aisle_number, a.header_user_id,
         cast(e.session_id as varchar) as session_text,
         coalesce(cast(a.header_user_id as varchar), '') as user_text
  from (select c.event_id, c.event_time, c.kind, c.aisle_number, coalesce(f.s, -1) as session_id
        from cart_events c left join (select user_id as u, min(session_id) as s from sessions group by user_id) f
          on f.u = c.session_id) e
  left join access_log a on a.event_id = e.event_id where e.kind = 'HELP'),
hj as (select hq.*, s.user_id as owner, s.status,
              {_PLONG.format(c='user_text')} as uid from hq left join sessions s on s.session_id = hq.session_id),
helps as (
  select event_id, 'help.requested' as topic, cast(session_id as varchar) as key,
         cast(json_object('sessionId', cast(session_id as varchar), 'aisleNumber', coalesce(aisle_number, 0),
                          'userId', header_user_id, 'timestamp', {iso_sql('event_time')}) as varchar) as value
  from hj where uid is not null and owner is not null and owner = uid and status = 'ACTIVE')"""
sql("accepted_help_requests", f"with {_HELP} select * from helps")

sql("verify_owner", """
select r.*, exists (select 1 from sessions s where s.session_id = r.session_id and s.user_id = r.user_id) as visible
from owner_requests r""")

sql("exit_token_eligibility", f"""
with r as (
  select event_id, event_time, session_text, {_PLONG.format(c='session_text')} as sid from access_requests),
j as (select r.*, s.status, s.user_id from r left join sessions s on s.session_id = r.sid),
o as (select *, case when sid is null then 'INVALID_ARGUMENT' when status is null then 'NOT_FOUND'
                     when status <> 'COMPLETED' then 'FAILED_PRECONDITION' else 'OK' end as outcome from j),
t as (select event_id as k, {token_cols_sql('sid', 'user_id', "'EXIT'", 'event_time', _QS)} from o where outcome = 'OK')
select event_id, session_text, outcome,
       case when outcome = 'OK' then {uuid_sql("'exit:' || cast(event_id as varchar)")} end as correlation_id,
       t.payload, t.signature,
       case when outcome = 'OK' then epoch_us(event_time + interval '24' hour) // 1000 end as expires_at_epoch
from o left join t on t.k = o.event_id""")

sql("session_view", "select session_id, user_id, status, created_at from sessions")

sql("sessions_by_user_status", """
select s.* from sessions s
where s.status = 'ACTIVE' and exists (select 1 from users u where u.id = s.user_id)""")

sql("expired_sessions", f"""
select * from sessions
where expires_at < timestamp '{SESSIONS_AS_OF}' and status not in ('COMPLETED', 'CANCELLED')""")


# --- tokens --------------------------------------------------------------------------

_P = "split_part(a, ';', {})"
_FOLD = f"""
stored as (select *, sha256(token) as token_hash from tokens),
ev as (
  select l.event_id, l.event_time, l.kind, l.token, s.family_id as t_family, s.user_id, s.revoked as init_revoked,
         s.expires_at < l.event_time as expired, s.family_id is not null as known
  from token_log l left join stored s on s.token_hash = sha256(l.token)),
fam as (
  select t_family,
         list(event_id order by event_time, event_id) as ids,
         list_reduce(list({{'kind': kind, 'token': token, 'init_revoked': init_revoked, 'expired': expired}}
                          order by event_time, event_id),
           lambda a, x: case
             when x.kind = 'LOGOUT' then 'C;' || {_P.format(2)} || ';' || {_P.format(3)} || ',logged_out'
             when x.init_revoked or {_P.format(1)} = 'C' or contains({_P.format(2)}, '|' || x.token || '|')
               then 'C;' || {_P.format(2)} || ';' || {_P.format(3)} || ',reuse'
             when x.expired then {_P.format(1)} || ';' || {_P.format(2)} || ';' || {_P.format(3)} || ',expired'
             else {_P.format(1)} || ';' || {_P.format(2)} || x.token || '|;' || {_P.format(3)} || ',rotate' end,
           'N;|;') as acc
  from ev where known group by t_family),
per as (
  select t_family, unnest(ids) as event_id, unnest(range(1, len(ids) + 1)) as i,
         string_split(split_part(acc, ';', 3), ',') as outs, split_part(acc, ';', 2) as rotated_set
  from fam),
hist as (
  select e.event_id, e.event_time, e.kind, e.token, e.t_family as family_id, e.user_id,
         case when not e.known then 'invalid' else p.outs[p.i + 1] end as outcome
  from ev e left join per p on p.event_id = e.event_id),
firstc as (
  select family_id, event_time, event_id, outcome from (
    select *, row_number() over (partition by family_id order by event_time, event_id) as rn
    from hist where outcome in ('reuse', 'logged_out')) x where rn = 1),
final as (
  select s.token, s.family_id, s.user_id,
         case when s.revoked then s.revocation_reason
              when contains(f.rotated_set, '|' || s.token || '|') then 'ROTATED'
              when c.outcome = 'reuse' then 'REUSE_DETECTED'
              when c.outcome = 'logged_out' then 'LOGOUT' end as revocation_reason
  from stored s
  left join (select distinct t_family, rotated_set from per) f on f.t_family = s.family_id
  left join firstc c on c.family_id = s.family_id)"""

sql("refresh_outcomes", f"""
with {_FOLD}
select event_id, event_time, token, family_id, outcome from hist where kind = 'PRESENT'""")

sql("reuse_detection", f"""
with {_FOLD}
select family_id, event_time as compromised_at, event_id as reuse_event_id from firstc where outcome = 'reuse'""")

sql("logout_revocation", f"""
with {_FOLD}
select event_id, event_time, token, family_id, case when family_id is null then 'invalid' else 'ok' end as outcome
from hist where kind = 'LOGOUT'""")

sql("family_revoke", f"""
with {_FOLD}
select token, family_id, user_id, revocation_reason is not null as revoked, revocation_reason from final""")

sql("revoked_per_family", f"""
with {_FOLD}
select family_id, revocation_reason as reason, count(*) as revoked_count from final
where revocation_reason in ('REUSE_DETECTED', 'LOGOUT') group by family_id, revocation_reason""")

sql("rotation_lineage", """
select token, family_id, created_at,
       row_number() over (partition by family_id order by created_at, token) as generation,
       lag(token) over (partition by family_id order by created_at, token) as prev_token,
       lead(token) over (partition by family_id order by created_at, token) as next_token
from tokens""")

sql("issue_refresh_tokens", f"""
with {_FOLD},
both_ as (
  select event_id, event_time, header_user_id as user_id,
         {uuid_sql("'family:' || cast(event_id as varchar)")} as family_id
  from access_log where starts_with(path, '/api/auth/') and header_user_id is not null
  union all
  select event_id, event_time, user_id, cast(family_id as varchar) from hist where outcome = 'rotate')
select event_id, sha256({uuid_sql("'refresh:' || cast(event_id as varchar)")}) as token_hash, family_id, user_id,
       event_time as created_at, event_time + interval '7' day as expires_at, false as revoked
from both_""")

sql("token_with_session", f"""
with {_GATES}
select 'qr_token' as hop, q.correlation_id as child_key, cast(q.session_id as varchar) as parent_key,
       s.status as parent_label
from qr_tokens q join sessions s on s.session_id = q.session_id
union all
select 'refresh_token', t.token, cast(t.user_id as varchar), u.email
from tokens t join users u on u.id = t.user_id
union all
select 'transition', cast(g.request_id as varchar), cast(g.session_id as varchar), s.status
from gates g join sessions s on s.session_id = g.session_id where g.gate = 'entry' and g.result = 'ok'""")

sql("tokens_by_family", """
select * from tokens t
where exists (select 1 from token_log l where l.kind = 'LOGOUT' and l.family_id = t.family_id)""")

sql("hash_tokens", "select token, sha256(token) as token_hash from tokens")

sql("sign_verify", f"""
with {_STORED}
select correlation_id, vault_signature,
       coalesce(starts_with(vault_signature, 'hmac:') and vault_signature = 'hmac:' || {hmac_sql('payload', _QS)},
                false) as valid
from stored""")

_DEC = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
sql("parse_price", f"""
with t as (
  select p_partkey,
         case p_partkey % 4 when 0 then cast(cast(p_retailprice as decimal(19,2)) as varchar)
              when 1 then ' ' || cast(cast(p_retailprice as decimal(19,2)) as varchar) || ' '
              when 2 then 'n/a' else '' end as price_text
  from part)
select p_partkey, price_text,
       coalesce(case when regexp_matches(price_text, '{_DEC}') then try_cast(price_text as decimal(19,4)) end,
                cast(0 as decimal(19,4))) as price
from t""")


# --- access --------------------------------------------------------------------------

def _blank(c: str) -> str:
    return f"({c} is null or regexp_matches({c}, '^\\s*$'))"


_EMAIL_OK = "regexp_matches(email, '^[^@\\s]+@[^@\\s]+$')"
_RULES = [
    ("email", _blank("email"), "must not be blank"),
    ("email", f"not {_blank('email')} and not {_EMAIL_OK}", "must be a well-formed email address"),
    ("email", "length(email) > 100", "size must be between 0 and 100"),
    ("username", _blank("username"), "must not be blank"),
    ("username", "not (length(username) between 3 and 50)", "size must be between 3 and 50"),
    ("password", _blank("password"), "must not be blank"),
    ("password", "not (length(password) between 8 and 100)", "size must be between 8 and 100"),
]
_ERRS = "concat_ws(', ', " + ", ".join(
    f"case when coalesce({c}, false) then '{f}: {m}' end" for f, c, m in _RULES) + ")"

sql("validate_requests", f"""
select request_id, email, username, {_ERRS} = '' as valid, nullif({_ERRS}, '') as errors from signups""")

_entries = []
_seen: dict[str, str] = {}
for _f, _c, _m in _RULES:
    _hit = f"coalesce({_c}, false)"
    _earlier = _seen.get(_f, "false")
    _entries.append(f"case when {_hit} and not ({_earlier}) then '\"{_f}\":\"{_m}\"' end")
    _seen[_f] = f"({_earlier}) or {_hit}"
sql("error_map", f"""
select * from (select request_id, '{{' || concat_ws(',', {', '.join(_entries)}) || '}}' as field_errors from signups) x
where field_errors <> '{{}}'""")

_EMAIL_RULES = [("email", _blank("email"), "must not be blank"),
                ("email", f"not {_blank('email')} and not {_EMAIL_OK}", "must be a well-formed email address")]
_KINDS = {"login": [*_EMAIL_RULES, ("password", _blank("password"), "must not be blank")],
          "refresh": [("refresh_token", _blank("refresh_token"), "must not be blank")],
          "logout": [("refresh_token", _blank("refresh_token"), "must not be blank")],
          "add_item": [("barcode", _blank("barcode"), "must not be blank")],
          "gate": [("correlation_id", _blank("correlation_id"), "must not be blank")]}


# No two rules of one field can fail together here, so first and last message are the same.
def _said(form: str, sep: str) -> str:
    return "case kind " + " ".join(
        f"when '{k}' then concat_ws('{sep}', " + ", ".join(f"case when coalesce({c}, false) then '{form.format(f, m)}' end" for f, c, m in rules) + ")"
        for k, rules in _KINDS.items()) + " end"


_ASKED = f"""asked as (
  select *, {_said("{}: {}", ", ")} as e, {_said('"{}":"{}"', ",")} as m from field_requests)"""
sql("validate_all_requests", f"""
with {_ASKED}
select request_id, kind, e = '' as valid, nullif(e, '') as errors, case when e <> '' then '{{' || m || '}}' end as field_errors from asked""")

sql("lookups_by_key", """
select 'token_hash' as lookup, sha256(l.token) as request_key, exists (select 1 from tokens t where t.token = l.token) as found from token_log l
union all
select 'correlation_id', r.correlation_id, exists (select 1 from gate_tokens t where t.correlation_id = r.correlation_id) from gate_requests r
union all
select 'user_id', cast(a.header_user_id as varchar), exists (select 1 from users u where u.id = a.header_user_id) from access_log a
union all
select 'role_name', u.role, u.role in ('ROLE_CUSTOMER', 'ROLE_WORKER', 'ROLE_ADMIN') from users u""")

_U = "'session:' || {}"
sql("session_access_check_uuid", f"""
with s as (select {uuid_sql(_U.format("cast(session_id as varchar)"))} as sid, user_id, status from sessions),
r as (
  select event_id, user_text, {_PLONG.format(c='user_text')} as uid,
         case when session_text = 'x' then session_text when event_id % 2 = 0 then upper({uuid_sql(_U.format("session_text"))})
              else {uuid_sql(_U.format("session_text"))} end as session_text
  from access_requests),
j as (select r.*, s.user_id as owner, s.status from r left join s on s.sid = lower(r.session_text)),
o as (select *, case when session_text = 'x' or uid is null then 'INVALID_ARGUMENT' when owner is null then 'NOT_FOUND'
                     when owner <> uid then 'PERMISSION_DENIED' else 'OK' end as outcome from j)
select event_id, session_text, user_text, outcome, coalesce(outcome = 'OK' and status = 'ACTIVE', false) as valid from o""")

_Q = "split_part(a, ';', {})"
_REG = f"""
rq as (
  select s.request_id, s.email, s.username, {_ERRS} = '' as valid,
         exists (select 1 from users u where u.email = s.email) as email_exists,
         exists (select 1 from users u where u.username = s.username) as username_exists
  from signups s),
rfold as (
  select list(request_id order by request_id) as ids,
         list_reduce(list({{'valid': valid, 'email': email, 'username': username, 'ee': email_exists,
                            'ue': username_exists}} order by request_id),
           lambda a, x: case
             when not x.valid then {_Q.format(1)} || ';' || {_Q.format(2)} || ';' || {_Q.format(3)} || ',invalid'
             when x.ee or contains({_Q.format(1)}, '|' || x.email || '|')
               then {_Q.format(1)} || ';' || {_Q.format(2)} || ';' || {_Q.format(3)} || ',email_taken'
             when x.ue or contains({_Q.format(2)}, '|' || x.username || '|')
               then {_Q.format(1)} || ';' || {_Q.format(2)} || ';' || {_Q.format(3)} || ',username_taken'
             else {_Q.format(1)} || x.email || '|;' || {_Q.format(2)} || x.username || '|;' || {_Q.format(3)}
                  || ',registered' end,
           '|;|;') as acc
  from rq),
rper as (
  select unnest(ids) as request_id, unnest(range(1, len(ids) + 1)) as i,
         string_split(split_part(acc, ';', 3), ',') as outs from rfold),
reg as (select q.request_id, q.email, q.username, p.outs[p.i + 1] as outcome
        from rq q join rper p on p.request_id = q.request_id)"""

sql("registration_conflicts", f"""
with {_REG}
select request_id, email, username,
       case when outcome = 'email_taken' then 'Email already registered' else 'Username already taken' end as reason
from reg where outcome in ('email_taken', 'username_taken')""")

sql("register_batch", f"""
with {_REG}
select r.request_id, r.email, r.username, r.outcome,
       case when r.outcome = 'registered' then 'ROLE_CUSTOMER' end as role,
       case when r.outcome = 'registered' then s.requested_at end as created_at,
       case when r.outcome = 'registered' then true end as enabled,
       case r.outcome when 'email_taken' then 'Email already registered'
                      when 'username_taken' then 'Username already taken'
                      when 'invalid' then 'Validation failed' end as reason
from reg r join signups s on s.request_id = r.request_id""")

sql("lookup_by_unique_key", """
select s.request_id, s.email, u.id as user_id, u.id is not null as found
from signups s left join users u on u.email = s.email""")

_GRANTS = """grants as (select * from (values
  ('ROLE_CUSTOMER', 'SCAN_PRODUCT'), ('ROLE_CUSTOMER', 'VIEW_CART'), ('ROLE_CUSTOMER', 'CHECKOUT'),
  ('ROLE_WORKER', 'VIEW_HELP_REQUESTS'), ('ROLE_WORKER', 'CONFIRM_PRICE'), ('ROLE_WORKER', 'MANAGE_STOCK'),
  ('ROLE_ADMIN', 'SCAN_PRODUCT'), ('ROLE_ADMIN', 'VIEW_CART'), ('ROLE_ADMIN', 'CHECKOUT'),
  ('ROLE_ADMIN', 'VIEW_HELP_REQUESTS'), ('ROLE_ADMIN', 'CONFIRM_PRICE'), ('ROLE_ADMIN', 'MANAGE_STOCK'),
  ('ROLE_ADMIN', 'MANAGE_USERS'), ('ROLE_ADMIN', 'MANAGE_CATALOG'), ('ROLE_ADMIN', 'VIEW_ANALYTICS')
) t(role_name, privilege_name)),
roles as (select cast(role_id as bigint) as role_id, role_name from (values (1, 'ROLE_CUSTOMER'), (2, 'ROLE_WORKER'),
  (3, 'ROLE_ADMIN')) t(role_id, role_name)),
privs as (select cast(privilege_id as bigint) as privilege_id, privilege_name from (values (1, 'SCAN_PRODUCT'),
  (2, 'VIEW_CART'), (3, 'CHECKOUT'), (4, 'VIEW_HELP_REQUESTS'), (5, 'CONFIRM_PRICE'), (6, 'MANAGE_STOCK'),
  (7, 'MANAGE_USERS'), (8, 'MANAGE_CATALOG'), (9, 'VIEW_ANALYTICS')) t(privilege_id, privilege_name))"""

sql("user_privileges", f"""
with {_GRANTS}
select u.id as user_id, u.role as role_name, r.role_id, p.privilege_id, g.privilege_name
from users u left join grants g on g.role_name = u.role
left join roles r on r.role_name = g.role_name left join privs p on p.privilege_name = g.privilege_name""")

sql("role_privilege_grants", f"""
with {_GRANTS}, n as (select role as role_name, count(*) as n_users from users group by role)
select g.role_name, g.privilege_name, coalesce(n.n_users, 0) as n_users
from grants g left join n on n.role_name = g.role_name""")

sql("grant_union", f"""
with {_GRANTS}, n as (select role as role_name, count(*) as n_users from users group by role)
select r.role_id, p.privilege_id, coalesce(n.n_users, 0) as n_users
from grants g join roles r on r.role_name = g.role_name join privs p on p.privilege_name = g.privilege_name
left join n on n.role_name = g.role_name""")

sql("cascade_delete", f"""
with gone as (select id as user_id from users where not {_EMAIL_OK}),
kids as (select id as user_id, role as child_key, 'users_roles' as table_name from users
         union all select user_id, token, 'refresh_tokens' from tokens)
select * from kids k where not exists (select 1 from gone g where g.user_id = k.user_id)""")

sql("route_requests", """
with routes as (select * from (values ('auth-service', '/api/auth'), ('product-service', '/api/products'),
  ('cart-service-rest', '/api/cart'), ('cart-service-websocket', '/ws'),
  ('session-service-sessions', '/api/sessions'), ('session-service-gate', '/api/gate')) t(route_id, prefix)),
hits as (select a.event_id, arg_max(r.route_id, length(r.prefix)) as route_id
         from access_log a join routes r on a.path = r.prefix or starts_with(a.path, r.prefix || '/')
         group by a.event_id)
select a.event_id, a.path, coalesce(h.route_id, 'unrouted') as route_id
from access_log a left join hits h on h.event_id = a.event_id""")

sql("open_path_filter", """
select event_id, path,
       starts_with(path, '/api/auth/') or starts_with(path, '/actuator/') or starts_with(path, '/ws/') as open
from access_log""")

# A6 composes the fragments above; rename the CTEs that would clash
import re as _re  # noqa: E402

_FOLD_T = _re.sub(r"\bstored\b", "tstored", _re.sub(r"\bper\b", "tper", _FOLD))
_W1_C = _re.sub(r"\bev\b", "cev", _W1)
_REPLAY_S = _re.sub(r"\bper\b", "sper", _REPLAY)
sql("outcome_counts", f"""
with {_FOLD_T}, {_GATES}, {_REPLAY_S}, {_REG}, {_W1_C}, {_ASKED},
cart as (
  select {_PLONG.format(c='session_text')} as sid, {_PLONG.format(c='user_text')} as uid
  from access_requests),
cartj as (select c.*, s.user_id as owner, s.status from cart c left join sessions s on s.session_id = c.sid),
ex as (
  select 'auth' as service, case outcome when 'invalid' then 'MethodArgumentNotValidException'
         else 'DuplicateResourceException' end as exception from reg where outcome <> 'registered'
  union all
  select 'auth', case outcome when 'reuse' then 'TokenReuseException' else 'InvalidTokenException' end
  from hist where kind = 'PRESENT' and outcome <> 'rotate'
  union all
  select 'cart', 'InvalidSessionException' from cartj
  where not (sid is not null and uid is not null and owner is not null and owner = uid and status = 'ACTIVE')
  union all
  select 'auth', 'InvalidTokenException' from hist where kind = 'LOGOUT' and family_id is null
  union all
  select case kind when 'add_item' then 'cart' else 'auth' end, 'MethodArgumentNotValidException' from asked where e <> '' and kind <> 'gate'
  union all
  select 'auth', 'BadCredentialsException' from asked a
  where e = '' and kind = 'login' and not exists (select 1 from users u where u.email = a.email)
  union all
  select 'cart', 'ProductNotFoundException' from barcode_requests r where not exists (select 1 from catalog c where c.barcode = r.barcode)
  union all
  select 'cart', 'CartItemNotFoundException' from w1 where rejected
  union all
  select 'session', 'SessionNotFoundException' from owner_requests r
  where not exists (select 1 from sessions s where s.session_id = r.session_id and s.user_id = r.user_id)
  union all
  select 'session', case result when 'expired' then 'QrTokenExpiredException' when 'illegal_transition' then 'IllegalStateTransitionException'
                                else 'InvalidQrTokenException' end
  from gates where gate = 'entry' and result <> 'ok'
  union all
  select 'session', 'IllegalStateTransitionException' from replay where not accepted),
codes as (select * from (values
  ('auth', 'DuplicateResourceException', 'duplicate_resource', 409), ('auth', 'BadCredentialsException', 'bad_credentials', 401),
  ('auth', 'InvalidTokenException', 'invalid_token', 401), ('auth', 'TokenReuseException', 'token_reuse', 401),
  ('auth', 'MethodArgumentNotValidException', 'validation_failed', 400),
  ('cart', 'InvalidSessionException', 'invalid_session', 403), ('cart', 'ProductNotFoundException', 'product_not_found', 404),
  ('cart', 'CartItemNotFoundException', 'cart_item_not_found', 404),
  ('cart', 'MethodArgumentNotValidException', 'validation_error', 400),
  ('session', 'IllegalStateTransitionException', 'illegal_transition', 409),
  ('session', 'SessionNotFoundException', 'session_not_found', 404),
  ('session', 'InvalidQrTokenException', 'invalid_qr_token', 400),
  ('session', 'QrTokenExpiredException', 'qr_token_expired', 410)) t(service, exception, code, http_status))
select c.service, c.code, c.http_status, count(*) as n
from ex e join codes c on c.service = e.service and c.exception = e.exception
group by c.service, c.code, c.http_status""")


# The headers are derived from the event ids, so the ids say what each must come to.
from basketry.schemas import OPEN_PATHS  # noqa: E402

_OPEN = " or ".join(f"starts_with(path, '{o}')" for o in OPEN_PATHS)
sql("token_audit", f"""
with a as (
  select event_id, path, case when {_OPEN} then 'open' when header_user_id is null then 'missing_header'
         when event_id % 29 = 0 then 'wrong_scheme' when event_id % 23 = 0 or event_id % 31 = 0 then 'bad_signature'
         when event_id % 11 = 0 then 'expired' else 'ok' end as outcome, header_user_id
  from access_log)
select event_id, path, outcome, case when outcome = 'ok' then cast(header_user_id as varchar) end as x_user_id,
       case when outcome = 'ok' then coalesce(u.email, '') end as x_user_email,
       case when outcome = 'ok' then coalesce(u.role, '') end as x_user_role
from a left join users u on u.id = a.header_user_id""")


# --- catalog -------------------------------------------------------------------------

from basketry.plans.registry import SEARCH_QUERY  # noqa: E402
from basketry.schemas import SEED_CATEGORIES, SEED_PRODUCTS  # noqa: E402

sql("product_by_barcode", """
select r.request_id, r.barcode, c.name, c.brand, c.price
from barcode_requests r join catalog c on c.barcode = r.barcode""")

sql("products_by_barcodes", """
select barcode, name, brand, price from catalog where barcode in (select barcode from barcode_requests)""")

sql("product_search", f"""
select barcode, name, price from catalog where lower(name) like '%{SEARCH_QUERY}%' order by barcode limit 10""")

sql("first_page", "select barcode, name, price from catalog order by barcode limit 10")

sql("product_dto", """
select id, barcode, name, brand, price, currency_code, category_id, aisle_number, image_url, nutriscore_grade, nova_group, ingredients_text,
       allergen_codes, stock_quantity, rfid_security_required,
       case when energy is not null then '{"energy":' || cast(energy::double as varchar) || ',"sugar":' || cast(sugar::double as varchar) || '}' end as nutriments, attributes
from full_products""")

sql("product_nutrition", """
select barcode, coalesce(list_contains(allergen_codes, 'milk'), false) as has_milk, cast(coalesce(len(allergen_codes), 0) as int) as n_allergens,
       coalesce(sugar, 0)::double as sugar, 0.0::double as salt
from full_products""")

sql("product_wire_row", """
select barcode, name, coalesce(brand, '') as brand, cast(price as varchar) as price,
       coalesce(currency_code, '') as currency_code, coalesce(aisle_number, 0) as aisle_number, '' as image_url,
       coalesce(nutriscore_grade, '') as nutriscore_grade, coalesce(rfid_security_required, false) as rfid_flag,
       coalesce(attributes, '') as attributes_json
from catalog""")

_MATCH = """m as (
  select q.query_id, c.barcode, c.name, q.lim from search_requests q
  join catalog c on lower(c.name) like '%' || lower(q.query) || '%')"""
sql("trigram_search", f"with {_MATCH} select query_id, barcode, name from m")
sql("top_n_per_query", f"""
with {_MATCH}
select query_id, barcode, name, rank from (
  select *, row_number() over (partition by query_id order by barcode) as rank from m) x where rank <= lim""")

_NUT = ", ".join(
    f"case when json_extract(body, '$.product.nutriments') is not null then "
    f"coalesce(try_cast(json_extract_string(body, '$.product.nutriments.\"{src}\"') as double), 0.0) end as {dst}"
    for dst, src in [("energy_kcal", "energy-kcal_100g"), ("fat", "fat_100g"),
                     ("carbohydrates", "carbohydrates_100g"), ("proteins", "proteins_100g"),
                     ("salt", "salt_100g")])


def _blank_null(c: str) -> str:
    return f"case when {_blank(c)} then null else {c} end"


_NORM = f"""norm as (
  select barcode,
         case when {_blank("json_extract_string(body, '$.product.product_name')")} then 'Unknown'
              else json_extract_string(body, '$.product.product_name') end as name,
         {_blank_null("json_extract_string(body, '$.product.brands')")} as brand,
         {_blank_null("json_extract_string(body, '$.product.image_url')")} as image_url,
         case when length(json_extract_string(body, '$.product.nutriscore_grade')) <= 1
              then {_blank_null("json_extract_string(body, '$.product.nutriscore_grade')")} end as nutriscore_grade,
         coalesce(length({_blank_null("json_extract_string(body, '$.product.nutriscore_grade')")}) > 1, false) as grade_rejected,
         cast(0 as decimal(19,4)) as price, 0 as stock_quantity, false as rfid_security_required, {_NUT}
  from raw_products
  where cast(try_cast(json_extract_string(body, '$.status') as double) as int) = 1)"""

sql("product_json_normalize", f"with {_NORM} select * from norm")
sql("apply_defaults", """
select barcode, coalesce(store_id, 1) as store_id, coalesce(aisle_number, 0) as aisle_number, coalesce(currency_code, 'EUR') as currency_code,
       coalesce(stock_quantity, 100) as stock_quantity, coalesce(rfid_security_required, false) as rfid_security_required,
       coalesce(status, 'CREATED') as status, coalesce(quantity, 1) as quantity, coalesce(version, 0) as version
from partial_rows""")

sql("catalog_fallback", f"""
with {_NORM}
select r.request_id, r.barcode,
       case when c.name is not null then 'catalog' when f.name is not null then 'fallback' else 'none' end as source,
       coalesce(c.name, f.name) as name, coalesce(c.price, f.price) as price
from barcode_requests r left join catalog c on c.barcode = r.barcode left join norm f on f.barcode = r.barcode""")


def _q(x) -> str:
    if x is None:
        return "null"
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return str(x)
    return "'" + str(x).replace("'", "''") + "'"


_SEEDP = ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in SEED_PRODUCTS)
_SEEDC = ", ".join("(" + ", ".join(_q(x) for x in r) + ")" for r in SEED_CATEGORIES)
sql("seed_dimensions", f"""
with sp as (select * from (values {_SEEDP}) t(barcode, name, brand, price, category_id, aisle_number,
                                              nutriscore_grade, rfid_security_required)),
sc as (select * from (values {_SEEDC}) t(category_id, category_name, slug, parent_id)),
seed as (select sp.barcode, sp.name, sp.brand, cast(sp.price as decimal(19,4)) as price, sc.category_name as category,
                sp.aisle_number, sp.nutriscore_grade, sp.rfid_security_required, 'seed' as source
         from sp join sc on sc.category_id = sp.category_id)
select barcode, name, brand, price, category, aisle_number, nutriscore_grade, rfid_security_required,
       'catalog' as source from catalog
union all
select * from seed where barcode not in (select barcode from catalog)""")

sql("upsert_by_key", """
with n as (
  select lpad(cast(p_partkey as varchar), 13, '0') as barcode,
         case when p_partkey % 5 = 0 then upper(p_name) end as name,
         case when p_partkey % 15 = 0 then cast(p_retailprice * 1.2 as decimal(19,4))
              when p_partkey % 3 = 0 then cast(p_retailprice * 1.1 as decimal(19,4)) end as price
  from part where p_partkey % 3 = 0 or p_partkey % 5 = 0
  union all
  select '9' || lpad(cast(p_partkey as varchar), 13, '0'), p_name, cast(p_retailprice as decimal(19,4)) from part where p_partkey % 50 = 7),
j as (
  select coalesce(o.barcode, n.barcode) as barcode, o.name as o_name, o.price as o_price, o.version as o_version,
         n.name as n_name, n.price as n_price, n.barcode is not null as is_new
  from catalog o full join n on n.barcode = o.barcode),
k as (
  select *, case when o_version is null then 'insert'
                 when is_new and ((n_name is not null and n_name is distinct from o_name)
                                  or (n_price is not null and n_price is distinct from o_price)) then 'update'
                 else 'keep' end as op
  from j)
select barcode, coalesce(n_name, o_name) as name, coalesce(n_price, o_price) as price,
       case op when 'insert' then cast(0 as bigint) when 'update' then o_version + 1 else o_version end as version,
       case op when 'insert' then timestamp '2024-01-01' else timestamp '2023-01-01' end as created_at,
       case op when 'keep' then timestamp '2023-06-01' else timestamp '2024-01-01' end as updated_at, op
from k""")

sql("assign_surrogate_ids", f"""
with {_NORM},
hits as (select distinct r.barcode from barcode_requests r join norm f on f.barcode = r.barcode
         where r.barcode not in (select barcode from catalog)),
new as (select n.barcode, n.name from norm n join hits h on h.barcode = n.barcode)
select barcode, name,
       (select max(cast(barcode as bigint) + 1) from catalog) + row_number() over (order by barcode) as id
from new""")

sql("category_tree", """
with recursive nodes as (
  select 'r' || cast(r_regionkey as varchar) as node_id, cast(null as varchar) as parent_id, r_name as name from region
  union all select 'n' || cast(n_nationkey as varchar), 'r' || cast(n_regionkey as varchar), n_name from nation
  union all select 'c' || cast(c_custkey as varchar), 'n' || cast(c_nationkey as varchar), c_name from customer),
walk(node_id, cur, path, depth) as (
  select node_id, parent_id, name, 0 from nodes
  union all
  select w.node_id, p.parent_id, p.name || '/' || w.path, w.depth + 1
  from walk w join nodes p on p.node_id = w.cur)
select node_id, depth, path, split_part(path, '/', 1) as root_name from walk where cur is null""")

sql("attribute_filter", """
with req as (select s.s_suppkey as query_id, p.p_type as want_type, p.p_size as want_size
             from supplier s join part p on (s.s_suppkey * 7) % ((select max(p_partkey) from part) + 1) = p.p_partkey)
select r.query_id, c.barcode from req r join catalog c
  on json_extract_string(c.attributes, '$.type') = r.want_type
 and cast(json_extract_string(c.attributes, '$.size') as int) = r.want_size""")

from basketry.sources.relations import attribute_ctes as _attribute_ctes  # noqa: E402

sql("attribute_containment", f"""
with {_attribute_ctes()}
select query_id, barcode from attribute_wants w, rich_products p
where json_valid(p.attributes) and json_contains(case when json_valid(p.attributes) then p.attributes::json end, w.want::json)""")

sql("catalog_by_aisle_category", """
select aisle_number, category, count(*) as products, cast(sum(stock_quantity) as bigint) as stock,
       count(*) filter (where rfid_security_required) as rfid_products
from catalog group by aisle_number, category""")


# --- quality, scans and topics -------------------------------------------------------

from basketry.schemas import DOMAINS as _DOMAINS, FOREIGN_KEYS as _FKS, ROW_KEYS as _ROW_KEYS, UNIQUE_KEYS as _UNIQUE  # noqa: E402
from basketry.sources.relations import relation_ctes as _relation_ctes  # noqa: E402


def _row_key_sql(table: str) -> str:
    return "concat_ws('|', " + ", ".join(f"cast({c} as varchar)" for c in _ROW_KEYS.get(table, ["id"])) + ")"


def _rules_sql(table: str) -> str:
    rules = []
    for c, (required, longest, allowed, least) in _DOMAINS[table].items():
        rules += [(f"{c}_not_null", f"{c} is null")] if required else []
        rules += [(f"{c}_len_{longest}", f"length({c}) > {longest}")] if longest else []
        rules += [(f"{c}_enum", f"{c} not in ({', '.join(repr(x) for x in allowed)})")] if allowed else []
        rules += [(f"{c}_range", f"{c} < {least}")] if least is not None else []
    return "\nunion all\n".join(f"select '{table}' as table_name, {_row_key_sql(table)} as row_key, '{r}' as rule from rel_{table} where {cond}"
                                for r, cond in rules)


sql("unique_violations", f"with {_relation_ctes()}\n" + "\nunion all\n".join(
    f"select '{name}' as constraint_name, concat_ws('|', {', '.join(f'cast({c} as varchar)' for c in cols)}) as key_value, count(*) as n "
    f"from rel_{t} where {' and '.join(f'{c} is not null' for c in cols)} group by {', '.join(cols)} having count(*) > 1"
    for t, named in _UNIQUE.items() for name, cols in named.items()))

sql("fk_orphans", f"with {_relation_ctes()}\n" + "\nunion all\n".join(
    f"select '{c}.{col}' as fk_name, cast(x.{col} as varchar) as child_key, count(*) as n_rows from rel_{c} x "
    f"where x.{col} is not null and not exists (select 1 from rel_{p} y where y.{pcol} = x.{col}) group by x.{col}"
    for c, col, p, pcol, _ in _FKS))

sql("domain_violations", f"with {_relation_ctes()}\n" + "\nunion all\n".join(_rules_sql(t) for t in _DOMAINS))

sql("cascade_graph", f"""
with {_relation_ctes()},
u as (select * from rel_users where email is null or not contains(email, '@')),
r as (select * from rel_roles where id % 9 = 0),
p as (select * from rel_privileges where id % 4 = 2)
select 'users' as table_name, cast(id as varchar) as row_key from u
union all select 'roles', cast(id as varchar) from r
union all select 'privileges', cast(id as varchar) from p
union all select 'users_roles', {_row_key_sql('users_roles')} from rel_users_roles
  where user_id in (select id from u) or role_id in (select id from r)
union all select 'roles_privileges', {_row_key_sql('roles_privileges')} from rel_roles_privileges
  where role_id in (select id from r) or privilege_id in (select id from p)
union all select 'refresh_tokens', cast(id as varchar) from rel_refresh_tokens where user_id in (select id from u)""")

sql("schema_evolve", """
select barcode, rtrim(currency_code) as currency_code, nullif(rtrim(nutriscore_grade), '') as nutriscore_grade,
       rtrim(category) as category
from landed_catalog""")

sql("latest_version", """
with w as (select barcode, cast(seq as bigint) as version, session_id as writer, price from cart_lines),
cur as (select * from (select *, row_number() over (partition by barcode order by version desc, writer desc,
                                                   price desc) as rn from w) x where rn = 1),
conf as (select barcode, count(*) as conflicts from (
           select barcode, version from w group by barcode, version having count(*) > 1) y group by barcode)
select c.barcode, c.version as current_version, c.writer as current_writer, c.price as current_price,
       coalesce(f.conflicts, 0) as conflicts
from cur c left join conf f on f.barcode = c.barcode""")

from basketry.sources.tables import DRIVER_TABLES as _DT  # noqa: E402

sql("scan_tables", "\nunion all\n".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in _DT))

_FEED = _HELP + f""",
names as (select barcode, name as product_name from catalog),
feed as (
  select w.event_id, 'cart.item.added' as topic, cast(w.session_id as varchar) as key,
         cast(json_object('sessionId', cast(w.session_id as varchar), 'barcode', w.barcode,
                          'productName', n.product_name, 'price', w.price, 'quantity', w.quantity,
                          'timestamp', {iso_sql('w.event_time')}) as varchar) as value
  from w1 w left join names n on n.barcode = w.barcode where w.kind = 'ADD' and not w.rejected
  union all
  select event_id, 'cart.item.removed', cast(session_id as varchar),
         cast(json_object('sessionId', cast(session_id as varchar), 'barcode', barcode,
                          'timestamp', {iso_sql('event_time')}) as varchar)
  from w1 where kind = 'REMOVE' and not rejected
  union all
  select * from helps
  union all
  select cast(null as bigint), 'session.paid', session_id,
         cast(json_object('sessionId', session_id, 'userId', user_id, 'paidAt', {iso_sql('event_time')}) as varchar)
  from replay where accepted and target = 'COMPLETED'
  union all
  select cast(null as bigint), 'session.completed', session_id,
         cast(json_object('sessionId', session_id, 'completedAt', {iso_sql('event_time')}) as varchar)
  from replay where accepted and target = 'COMPLETED')"""

sql("encode_events", f"with {_W1}, {_REPLAY}, {_FEED} select * from feed")

_TS = "coalesce(json_extract_string(value, '$.timestamp'), json_extract_string(value, '$.paidAt'), " \
      "json_extract_string(value, '$.completedAt'))"
_CORRUPT = f"""
cf as (select topic, key, case coalesce(event_id % 50, -1)
                               when 0 then substring(value, 1, length(value) // 2)
                               when 1 then regexp_replace(value, '"quantity":[0-9]+', '"quantity":"x"')
                               when 2 then regexp_replace(value, '"timestamp":"[^"]*"', '"timestamp":"nope"') else value end as value
       from feed),
cd as (select topic, key, value, coalesce(
         case when json_valid(value) then (json_extract_string(value, '$.quantity') is null
                                           or try_cast(json_extract_string(value, '$.quantity') as int) is not null)
              and try_cast(regexp_replace({_TS}, 'Z$', '') as timestamp) is not null end, false) as ok from cf)"""
sql("decode_topics", f"""
with {_W1}, {_REPLAY}, {_FEED}, {_CORRUPT}
select topic, key,
       case when ok then json_extract_string(value, '$.sessionId') end as session_id,
       case when ok then json_extract_string(value, '$.barcode') end as barcode,
       case when ok then json_extract_string(value, '$.productName') end as product_name,
       case when ok then try_cast(json_extract_string(value, '$.price') as decimal(19,4)) end as price,
       case when ok then try_cast(json_extract_string(value, '$.quantity') as int) end as quantity,
       case when ok then try_cast(json_extract_string(value, '$.aisleNumber') as int) end as aisle_number,
       case when ok then try_cast(json_extract_string(value, '$.userId') as bigint) end as user_id,
       case when ok then try_cast(regexp_replace({_TS}, 'Z$', '') as timestamp) end as event_time,
       not ok as malformed, value
from cd""")


# --- streaming -----------------------------------------------------------------------

_DEC = f"""
dec as (
  select topic, key, json_extract_string(value, '$.sessionId') as session_id,
         json_extract_string(value, '$.barcode') as barcode,
         try_cast(json_extract_string(value, '$.price') as decimal(19,4)) as price,
         try_cast(json_extract_string(value, '$.quantity') as int) as quantity,
         try_cast(json_extract_string(value, '$.aisleNumber') as int) as aisle_number,
         try_cast(json_extract_string(value, '$.userId') as bigint) as user_id,
         try_cast(regexp_replace({_TS}, 'Z$', '') as timestamp) as event_time
  from feed)"""
_STREAM_BASE = f"{_W1}, {_REPLAY}, {_FEED}, {_DEC}"

sql("stream_scan_enrich", f"""
with {_STREAM_BASE}
select d.session_id, d.barcode, d.event_time, c.name as catalog_name, c.name is not null as found
from dec d left join catalog c on c.barcode = d.barcode where d.topic = 'cart.item.added'""")

sql("stream_help_by_aisle", f"""
with {_STREAM_BASE},
h as (select * from dec where topic = 'help.requested'),
g as (select aisle_number, time_bucket(interval '15 minutes', event_time) as window_start, count(*) as requests
      from h group by 1, 2)
select aisle_number, window_start, window_start + interval '15 minutes' as window_end, requests from g
where window_start + interval '15 minutes' <= (select max(event_time) from h) - interval '30 minutes'""")

sql("stream_help_by_aisle_sliding", f"""
with {_STREAM_BASE},
h as (select * from dec where topic = 'help.requested'),
x as (select aisle_number, time_bucket(interval '5 minutes', event_time) - o * interval '5 minutes' as window_start
      from h, (values (0), (1), (2)) t(o)),
g as (select aisle_number, window_start, count(*) as requests from x group by 1, 2)
select aisle_number, window_start, window_start + interval '15 minutes' as window_end, requests from g
where window_start + interval '15 minutes' <= (select max(event_time) from h) - interval '30 minutes'""")

sql("stream_paid_completed", f"""
with {_STREAM_BASE},
p as (select key, event_time from dec where topic = 'session.paid'),
c as (select key, event_time from dec where topic = 'session.completed' and cast(split_part(key, '-', 1) as bigint) % 3 <> 0),
mark as (select date_trunc('millisecond', least((select max(event_time) from p), (select max(event_time) from c))) - interval '10' minute as w)
select p.key as session_id, p.event_time as paid_at, c.event_time as completed_at
from p left join c on c.key = p.key and c.event_time >= p.event_time
                   and c.event_time <= p.event_time + interval '5 minutes', mark
where c.key is not null or p.event_time + interval '5' minute < w""")

sql("stream_event_dedup", f"""
with {_STREAM_BASE}
select distinct topic, key, session_id, barcode, price, quantity, aisle_number, user_id, event_time from dec""")

sql("stream_upsert_sink", f"""
with {_LIVE}, lasttime as (
  select session_id, barcode, max(event_time) as event_time from w2 where not rejected group by session_id, barcode)
select l.session_id, l.barcode, t.event_time, l.quantity, l.price
from live l join lasttime t on t.session_id = l.session_id and t.barcode = l.barcode""")

sql("stream_quarantine", f"with {_W1}, {_REPLAY}, {_FEED}, {_CORRUPT} select topic, key, value from cd where not ok")

# What a stream says is final up to its last watermark; a cart ends 24 hours after its last event.
_SEEN = """
mark as (select date_trunc('millisecond', max(event_time)) - interval '1' hour as w from cart_events where kind in ('ADD', 'REMOVE', 'CLEAR')),
seen as (
  select *, case when event_time > lag(event_time) over (partition by session_id order by event_time, event_id) + interval '24' hour
                 then 1 else 0 end as ended
  from cart_events, mark where kind in ('ADD', 'REMOVE', 'CLEAR') and event_time <= w)"""
_LIVE_SEEN = _LIVE.replace("from cart_events where kind in ('ADD', 'REMOVE', 'CLEAR')", "from seen").replace(
    "sum(case when kind = 'CLEAR' then 1 else 0 end)", "sum(ended + case when kind = 'CLEAR' then 1 else 0 end)")
assert "from seen" in _LIVE_SEEN and "sum(ended" in _LIVE_SEEN
sql("stream_cart_state", f"""
with {_SEEN}, {_LIVE_SEEN},
ends as (select session_id, max(event_time) + interval '24' hour as until from seen group by session_id)
select l.session_id, l.barcode, l.quantity, l.price from live l join ends e on e.session_id = l.session_id, mark where e.until >= w""")

_W1_SEEN = _W1.replace("from cart_events where kind in ('ADD', 'REMOVE', 'CLEAR')", "from cart_events, mark where kind in ('ADD', 'REMOVE', 'CLEAR') and event_time <= w")
sql("stream_cart_expiry", f"""
with mark as (select date_trunc('millisecond', max(event_time)) - interval '1' hour as w from cart_events where kind in ('ADD', 'REMOVE', 'CLEAR')),
{_W1_SEEN},
g as (
  select *, sum(case when prev is null or event_time >= prev + interval '24' hour then 1 else 0 end) over (
           partition by session_id, epoch order by event_time, event_id rows between unbounded preceding and current row) as grp
  from (select *, lag(event_time) over (partition by session_id, epoch order by event_time, event_id) as prev
        from w1 where not rejected and quantity > 0) x),
life as (select session_id, epoch, min(event_time) as first_put, max(event_time) + interval '24' hour as expires_at, count(*) as puts
         from g group by session_id, epoch, grp),
lastep as (select session_id, max(epoch) as last_epoch from ev group by session_id)
select l.session_id, first_put, expires_at, puts from life l join lastep e on e.session_id = l.session_id, mark
where expires_at <= w or epoch < last_epoch""")

sql("stream_session_state", f"""
with {_REPLAY}, mark as (select date_trunc('millisecond', max(event_time)) - interval '1' hour as w from session_log)
select event_id, session_id, target, from_state, accepted, to_state from replay, mark where event_time <= w""")

# A fold over the lookups of a barcode: the time of the last load, and the loads so far.
sql("stream_lookup_dedup", """
with r as (
  select b.request_id, b.barcode, e.ts as requested_at, epoch_us(e.ts) as us from barcode_requests b join events e on e.event_id = b.request_id),
seen as (select * from r where requested_at <= (select date_trunc('millisecond', max(requested_at)) - interval '1' hour from r)),
f as (
  select barcode, list_reduce(list(cast(us as varchar) || ':' || cast(request_id as varchar) order by us, request_id),
           lambda a, x: case when a = '' or cast(split_part(x, ':', 1) as bigint) >= cast(split_part(split_part(a, ',', -1), ':', 1) as bigint) + 3600000000
                             then a || case when a = '' then '' else ',' end || x else a end, '') as loads
  from seen group by barcode)
select cast(split_part(l, ':', 2) as bigint) as request_id, barcode, make_timestamp(cast(split_part(l, ':', 1) as bigint)) as requested_at
from f, unnest(string_split(loads, ',')) u(l)""")


# --- the request path as one plan ----------------------------------------------------

_W2_PASS = _W2.replace("from cart_events", "from pass_cmds")
assert _W2_PASS.count("pass_cmds") == 1
sql("cart_request_flow", f"""
with first_ as (select user_id as u, min(session_id) as s from sessions group by user_id),
cmds as (
  select c.event_id, c.event_time, coalesce(f.s, -1) as session_id, c.barcode, c.kind,
         cast(coalesce(f.s, -1) as varchar) as session_text,
         coalesce(cast(a.header_user_id as varchar), '') as user_text
  from cart_events c left join first_ f on f.u = c.session_id
  left join access_log a on a.event_id = c.event_id
  where c.kind in ('ADD', 'REMOVE', 'CLEAR')),
chk as (
  select m.*, {_PLONG.format(c='m.session_text')} as sid, {_PLONG.format(c='m.user_text')} as uid from cmds m),
pre as (
  select k.*, c.name as cname, c.price as cprice,
         case when k.kind <> 'CLEAR' and not coalesce(k.sid is not null and k.uid is not null and s.user_id is not null
                                                      and s.user_id = k.uid and s.status = 'ACTIVE', false)
              then 'invalid_session'
              when k.kind = 'ADD' and c.name is null then 'product_not_found' end as pre
  from chk k left join sessions s on s.session_id = k.sid left join catalog c on c.barcode = k.barcode),
pass_cmds as (select event_id, event_time, session_id, barcode, kind, cprice as price from pre where pre is null),
{_W2_PASS},
ch as (
  select event_id, event_time, session_id, kind, epoch,
         case when kind = 'ADD' then 1 else -1 end as dq,
         case when kind = 'ADD' then 1 else -1 end * line_price as dm
  from w2 where not rejected)
select event_id, session_id, kind, pre as outcome, cast(null as varchar) as event_type,
       cast(null as bigint) as item_count, cast(null as decimal(38,4)) as total
from pre where pre is not null
union all
select event_id, session_id, kind, 'cart_item_not_found', null, null, null from w1 where rejected
union all
select event_id, session_id, kind, 'ok', case when kind = 'ADD' then 'ITEM_ADDED' else 'ITEM_REMOVED' end,
       cast(sum(dq) over (partition by session_id, epoch order by event_time, event_id
                          rows between unbounded preceding and current row) as bigint),
       cast(sum(dm) over (partition by session_id, epoch order by event_time, event_id
                          rows between unbounded preceding and current row) as decimal(38,4))
from ch
union all
select event_id, session_id, 'CLEAR', 'ok', 'CLEARED', cast(0 as bigint), cast(0 as decimal(38,4))
from pass_cmds where kind = 'CLEAR'""")
