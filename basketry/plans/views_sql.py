"""The adapter views as SQL text (DuckDB dialect) for the oracle side.

They mirror ``basketry.sources.tables`` one for one; ``with_views`` prepends
the ones a query names as CTEs over the driver's pre-registered tables.
"""

from __future__ import annotations

import re

VIEW_SQL = {
    "catalog": """
select lpad(cast(p_partkey as varchar), 13, '0') as barcode, p_name as name, p_brand as brand,
       cast(p_retailprice as decimal(19,4)) as price, 'EUR' as currency_code, p_type as category,
       p_size as aisle_number,
       case when p_partkey % 7 = 0 then null
            else substring('abcde', cast(p_partkey % 5 + 1 as int), 1) end as nutriscore_grade,
       p_partkey % 20 = 0 as rfid_security_required, 100 as stock_quantity,
       '{"type":"' || p_type || '","size":' || cast(p_size as varchar) || '}' as attributes,
       cast(0 as bigint) as version
from part""",
    "cart_lines": """
select l_orderkey as session_id, lpad(cast(l_partkey as varchar), 13, '0') as barcode,
       cast(trunc(l_quantity) as int) as quantity, cast(l_extendedprice as decimal(19,4)) as price,
       l_shipdate as scanned_at, l_linenumber as seq
from lineitem""",
    "sessions": """
select o_orderkey as session_id, o_custkey as user_id, cast(1 as bigint) as store_id,
       case o_orderstatus when 'O' then 'ACTIVE' when 'P' then 'PAYING' else 'COMPLETED' end as status,
       o_orderdate as created_at, o_orderdate + interval '24' hour as expires_at
from orders""",
    "cart_events": """
select event_id, ts as event_time, user_id as session_id,
       lpad(cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 5 as varchar), 13, '0') as barcode,
       case when event_type in ('view', 'purchase') then 'ADD' when event_type = 'click' then 'REMOVE'
            when event_type = 'error' then 'HELP' when event_id % 10 = 0 then 'CLEAR' else 'ADD' end as kind,
       cast(value as decimal(19,4)) as price,
       cast(regexp_extract(props, '[0-9]+', 0) as int) as aisle_number
from events""",
    "cart_reads": """
select event_id as request_id, user_id as session_id, ts + to_hours(cast(event_id % 60 as int)) as as_of
from events where event_type = 'error'""",
    "session_log": """
select event_id, ts as event_time, user_id,
       cast(user_id as varchar) || '-' || cast(cast(ts as date) as varchar) as session_id,
       case event_type when 'signup' then 'ACTIVE' when 'click' then 'PAYING'
            when 'purchase' then 'COMPLETED' else 'CANCELLED' end as target
from events
where event_type in ('signup', 'click', 'purchase') or (event_type = 'error' and event_id % 4 = 0)""",
    "token_log": """
select event_id, ts as event_time, user_id as family_id,
       cast(user_id as varchar) || ':' || cast(cast(regexp_extract(props, '[0-9]+', 0) as int) % 10 as varchar) as token,
       case when event_type = 'view' then 'PRESENT' else 'LOGOUT' end as kind
from events
where event_type = 'view' or (event_type = 'signup' and event_id % 20 = 0)""",
    "tokens": """
select cast(user_id as varchar) || ':' || cast(k as varchar) as token, user_id as family_id, user_id,
       min(ts) as created_at, min(ts) + interval '7' day as expires_at, k % 4 = 0 as revoked,
       case when k % 4 = 0 then 'ROTATED' end as revocation_reason
from (select user_id, ts, cast(regexp_extract(props, '[0-9]+', 0) as int) % 10 as k from events) e
group by user_id, k""",
    "qr_tokens": """
select 'corr-' || cast(o_orderkey as varchar) as correlation_id, o_orderkey as session_id,
       case when o_orderkey % 2 = 0 then 'ENTRY' else 'EXIT' end as token_type,
       '{"sessionId":"' || cast(o_orderkey as varchar) || '","userId":' || cast(o_custkey as varchar) || '}' as payload,
       o_orderkey % 10 = 0 as tampered,
       case when o_orderpriority = '1-URGENT' then 'USED' when o_orderpriority = '5-LOW' then 'REVOKED'
            else 'ACTIVE' end as status,
       o_orderdate as created_at, o_orderdate + interval '24' hour as expires_at
from orders""",
    "users": """
select c_custkey as id,
       lower(replace(c_name, '#', '.')) || case when c_custkey % 11 = 0 then '' else '@example.org' end as email,
       'u' || cast(c_custkey % 1400 as varchar) as username,
       case c_mktsegment when 'BUILDING' then 'ROLE_ADMIN' when 'MACHINERY' then 'ROLE_WORKER'
            else 'ROLE_CUSTOMER' end as role
from customer""",
    "access_log": """
select event_id, ts as event_time,
       case event_type when 'view' then '/api/products/' when 'click' then '/api/cart/'
            when 'purchase' then '/api/sessions/' when 'signup' then '/api/auth/' else '/other/' end
         || cast(event_id as varchar) as path,
       case when event_id % 5 = 0 then null else user_id end as header_user_id,
       case when event_id % 7 = 0 then null else user_id end as param_user_id,
       case when event_id % 3 = 0 then null else event_id % 4 + 1 end as store_id
from events""",
    "access_requests": """
select event_id, ts as event_time,
       case when event_id % 19 = 0 then 'x' when event_id % 4 = 1 then '-' || cast(event_id as varchar)
            when event_id % 2 = 0 and own is not null then cast(own as varchar) else cast(event_id as varchar) end as session_text,
       case when event_id % 13 = 0 then '' when event_id % 17 = 0 then 'abc' else cast(user_id as varchar) end as user_text
from events left join (select o_custkey, max(o_orderkey) as own from orders group by o_custkey) o on o_custkey = user_id""",
    "owner_requests": """
select event_id, case when event_id % 3 = 0 then own else event_id end as session_id, user_id
from events left join (select o_custkey, max(o_orderkey) as own from orders group by o_custkey) o on o_custkey = user_id""",
    "raw_products": """
select '9' || lpad(cast(p_partkey as varchar), 12, '0') as barcode,
       '{"status":' || case when p_partkey % 9 = 0 then '0' else '1' end || ',"product":{' ||
       case when p_partkey % 4 = 0 then '' else '"product_name":"' || p_name || '",' end ||
       '"brands":"' || case when p_partkey % 6 = 0 then ' ' else p_brand end ||
       '","nutriscore_grade":"' || case when p_partkey % 8 = 3 then 'unknown' when p_partkey % 8 = 4 then '' else 'b' end ||
       '","nutriments":{"energy-kcal_100g":' ||
       case when p_partkey % 5 = 0 then '"n/a"' else cast(p_size as varchar) end || '}}}' as body
from part""",
    "barcode_requests": """
select event_id as request_id,
       case event_id % 3 when 0 then '9' when 1 then '0' else '8' end
         || lpad(cast(case when event_id % 5 < 2 then event_id % 4 else event_id * 7919 % ((select max(p_partkey) from part) + 1) end as varchar), 12, '0') as barcode
from events""",
    "full_products": """
select p_partkey + 1 as id, lpad(cast(p_partkey as varchar), 13, '0') as barcode, p_name as name, p_brand as brand,
       cast(p_retailprice as decimal(19,4)) as price, 'EUR' as currency_code, p_partkey % 5 + 1 as category_id, p_size as aisle_number,
       case when p_partkey % 6 <> 0 then 'https://img.example.org/' || lpad(cast(p_partkey as varchar), 13, '0') || '.jpg' end as image_url,
       case when p_partkey % 7 <> 0 then substring('abcde', cast(p_partkey % 5 + 1 as int), 1) end as nutriscore_grade,
       case when p_partkey % 8 <> 0 then cast(p_partkey % 4 + 1 as smallint) end as nova_group,
       case when p_partkey % 9 <> 0 then 'made of ' || p_name end as ingredients_text,
       case when p_partkey % 10 <> 0 then ['gluten', 'milk', 'nuts', 'soy', 'egg'][1 : p_partkey % 4] end as allergen_codes,
       100 as stock_quantity, p_partkey % 20 = 0 as rfid_security_required,
       case when p_partkey % 11 <> 0 then p_size end as energy, case when p_partkey % 11 <> 0 then p_partkey % 30 end as sugar,
       '{"type":"' || p_type || '"}' as attributes
from part""",
    "search_requests": """
select s.s_suppkey as query_id,
       upper(case when s.s_suppkey % 50 = 7 then '%' when s.s_suppkey % 50 = 8 then '__'
                  when s.s_suppkey % 50 = 9
                  then substring(split_part(coalesce(p.p_name, 'zzz qq'), ' ', cast(s.s_suppkey % 2 + 1 as int)), 1, 1) || '_'
                    || substring(split_part(coalesce(p.p_name, 'zzz qq'), ' ', cast(s.s_suppkey % 2 + 1 as int)), 3, 2)
                  when s.s_suppkey % 5 = 0
                  then substring(split_part(coalesce(p.p_name, 'zzz qq'), ' ', cast(s.s_suppkey % 2 + 1 as int)), 1, 2)
                  else substring(split_part(coalesce(p.p_name, 'zzz qq'), ' ', cast(s.s_suppkey % 2 + 1 as int)), 2, 4)
             end) as query,
       cast(s.s_suppkey % 4 + 2 as int) as lim
from supplier s left join part p on (s.s_suppkey * 7) % ((select max(p_partkey) from part) + 1) = p.p_partkey""",
    "gate_sessions": """
select o_orderkey as session_id, o_custkey as user_id,
       case when o_orderstatus = 'F' then 'COMPLETED' when o_orderkey % 7 = 0 then 'PAYING'
            when o_orderkey % 11 = 0 then 'CANCELLED' else 'CREATED' end as status
from orders""",
    "gate_tokens": """
select 'gate-' || cast(o_orderkey as varchar) || '-' || cast(no as varchar) as correlation_id, o_orderkey as session_id,
       case when o_orderstatus = 'F' then 'EXIT' else 'ENTRY' end as token_type,
       -- what the stored signature is worth: over the payload, over other text, or a remote one
       case when o_orderkey % 13 = 12 then 'vault' when o_orderkey % 10 = 9 then 'altered' else 'own' end as signed_as,
       case when o_orderpriority = '1-URGENT' and no = 1 then 'USED' when o_orderpriority = '5-LOW' and no = 0 then 'REVOKED'
            else 'ACTIVE' end as status,
       timestamp '2024-01-01 00:00:00' + to_hours(cast(o_orderkey * 5 % 600 + no + 24 as int)) as expires_at
from orders, (values (0), (1)) t(no)""",
    "gate_requests": """
select o_orderkey * 8 + i as request_id,
       timestamp '2024-01-01 01:00:00' + to_hours(cast(o_orderkey * 5 % 600 + (o_orderkey * 7 + i * 11) % 40 as int)) as requested_at,
       'gate-' || cast(o_orderkey as varchar) || case when (o_orderkey * 3 + i) % 23 = 0 then '-x'
         when (o_orderkey + i) % 3 = 0 then '-1' else '-0' end as correlation_id,
       case when (o_orderstatus = 'F') = ((o_orderkey + i) % 5 = 0) then 'entry' else 'exit' end as gate
from (select *, unnest(range(0, o_orderkey % 6 + 1)) as i from orders) o""",
    "field_requests": """
select event_id as request_id,
       case event_type when 'view' then 'add_item' when 'click' then 'gate' when 'purchase' then 'login' when 'signup' then 'refresh' else 'logout' end as kind,
       case when event_id % 8 = 0 then '' when event_id % 8 = 1 then '  ' when event_id % 8 = 2 then null when event_id % 8 = 3 then 'not-an-email' when event_id % 8 = 4 then 'nobody@example.org'
            else 'customer.' || lpad(cast(user_id as varchar), 9, '0') || '@example.org' end as email,
       case when event_id % 7 = 0 then '' else 'secret' end as password,
       case when event_id % 8 = 0 then '' when event_id % 8 = 1 then '  ' when event_id % 8 = 2 then null else 'x' || cast(event_id as varchar) end as refresh_token,
       case when event_id % 8 = 0 then '' when event_id % 8 = 1 then '  ' when event_id % 8 = 2 then null else 'x' || cast(event_id as varchar) end as barcode,
       case when event_id % 8 = 0 then '' when event_id % 8 = 1 then '  ' when event_id % 8 = 2 then null else 'x' || cast(event_id as varchar) end as correlation_id
from events""",
    "partial_rows": """
select lpad(cast(p_partkey as varchar), 13, '0') as barcode, case when p_partkey % 2 <> 0 then p_partkey % 9 end as store_id,
       case when p_partkey % 3 <> 0 then p_size end as aisle_number, case when p_partkey % 4 <> 0 then 'USD' end as currency_code,
       case when p_partkey % 5 <> 0 then cast(p_partkey % 50 as int) end as stock_quantity,
       case when p_partkey % 6 <> 0 then true end as rfid_security_required, case when p_partkey % 7 <> 0 then 'ACTIVE' end as status,
       case when p_partkey % 8 <> 0 then cast(p_partkey % 4 as int) end as quantity, case when p_partkey % 9 <> 0 then p_partkey % 11 end as version
from part""",
    "landed_catalog": """
select lpad(cast(p_partkey as varchar), 13, '0') as barcode, rpad('EUR', 3, ' ') as currency_code,
       rpad(case when p_partkey % 7 = 0 then '' else substring('abcde', cast(p_partkey % 5 + 1 as int), 1) end, 1, ' ') as nutriscore_grade,
       rpad(p_type, 25, ' ') as category
from part""",
    "signups": """
select event_id as request_id, ts as requested_at,
       case when event_id % 6 = 0 then 'customer.' || lpad(cast(user_id as varchar), 9, '0') || '@example.org'
            when event_id % 6 = 1 then 'not-an-email'
            when event_id % 6 = 2 then 'shopper' || cast(user_id % 40 as varchar) || '@shop.example'
            else 'new' || cast(event_id as varchar) || '@shop.example' end as email,
       case when event_id % 5 = 0 then 'u' || cast(user_id % 1400 as varchar)
            when event_id % 5 = 1 then 'ab'
            when event_id % 5 = 2 then 'shopper' || cast(user_id % 25 as varchar)
            else 'user' || cast(event_id as varchar) end as username,
       case when event_id % 7 = 0 then 'short' else 'secret-password-' || cast(event_id as varchar) end as password
from events where event_type = 'signup'""",
}

# views that read other views
VIEW_DEPS: dict[str, list[str]] = {}


def with_views(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every adapter view it mentions."""
    used = [v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)]
    if not used:
        return sql
    ctes = ",\n".join(f"{v} as ({VIEW_SQL[v].strip()})" for v in used)
    body = sql.strip()
    if body[:4].lower() == "with":
        return f"with {ctes},\n{body[4:].lstrip()}"
    return f"with {ctes}\n{body}"
