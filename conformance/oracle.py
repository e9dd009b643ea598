"""The queries as SQL on the given tables, written for DuckDB.

``BRONZE`` repeats ``adapter.py``; the rest states each query's result directly.
"""

from __future__ import annotations

MEMBERS_FIRST = """
  select cast(c_custkey as varchar) as member_id, c_name as first_name, c_mktsegment as last_name,
    case when c_acctbal > 9000 then 'unknown'
         else cast(date '1950-01-01' + cast(c_custkey % 20000 as integer) as varchar) end as date_of_birth,
    case when c_custkey % 2 = 0 then 'F' else 'M' end as gender,
    c_mktsegment as plan_code, cast(c_nationkey as varchar) as state_code,
    cast(date '1994-01-01' + cast(c_nationkey as integer) as varchar) as effective_date,
    '1994-01-01T00:00:00' as created_at, '1994-06-01T00:00:00' as updated_at,
    timestamp '2026-07-01 00:00:00' as _loaded_at
  from customer"""

MEMBERS_CHANGED = """
  select member_id, first_name, last_name, date_of_birth, gender, 'PLAN_' || state_code as plan_code,
    state_code, effective_date, created_at, '1995-06-01 08:30:00' as updated_at,
    timestamp '2026-07-02 00:00:00' as _loaded_at
  from members_first where member_id in (select cast(c_custkey as varchar) from customer where c_acctbal < 0)"""

PROVIDERS = """
  select cast(s_suppkey as varchar) as provider_id, s_name as provider_name,
    cast(s_suppkey + 1000000000 as varchar) as npi, 'SPEC_' || cast(s_suppkey % 5 as varchar) as specialty,
    cast(s_nationkey as varchar) as state_code, '1994-01-01T00:00:00' as created_at,
    case when s_acctbal > 9000 then 'soon' else '1994-06-01T00:00:00' end as updated_at,
    timestamp '2026-07-01 00:00:00' as _loaded_at
  from supplier
  union all
  select cast(s_suppkey as varchar), s_name, cast(s_suppkey + 1000000000 as varchar), 'General',
    cast(s_nationkey as varchar), '1994-01-01T00:00:00', '1995-06-01 08:30:00', timestamp '2026-07-02 00:00:00'
  from supplier"""

MEDICAL_CLAIMS = """
  select l_orderkey || '-' || l_linenumber as claim_id,
    case when l_quantity = 1 then 'NOBODY' else cast(o_custkey as varchar) end as member_id,
    case when l_quantity <> 2 then cast(l_suppkey as varchar) end as provider_id,
    'D' || cast(l_partkey % 7 as varchar) as diagnosis_code, 'P' || cast(l_linenumber as varchar) as procedure_code,
    case when l_quantity = 3 then 'not a date' when l_quantity = 4 then '1997-02'
         else strftime(l_shipdate, '%Y-%m-%d') end as service_date,
    case when l_quantity = 5 then 'n/a' when l_quantity = 6 then '99999999999.99'
         else cast(cast(l_extendedprice as decimal(12,2)) as varchar) end as billed_amount,
    case when l_quantity = 7 then '12.345'
         else cast(cast(cast(l_extendedprice as decimal(12,2))
                        * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2))) as decimal(12,2)) as varchar)
         end as allowed_amount,
    l_returnflag || l_linestatus as claim_status,
    strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') as created_at,
    case when l_quantity = 8 then 'later' else strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') end as updated_at,
    timestamp '2026-07-01 00:00:00' as _loaded_at
  from lineitem join orders on l_orderkey = o_orderkey"""

PHARMACY_CLAIMS = """
  select 'RX' || o_orderkey as claim_id,
    case when o_totalprice < 2000 then 'NOBODY' else cast(o_custkey as varchar) end as member_id,
    '00071-' || o_orderpriority[1] as ndc_code, 'Tablet, "' || o_orderpriority || '"' as drug_name,
    case o_orderpriority when '3-MEDIUM' then '30.6' when '5-LOW' then 'many'
         else cast(o_orderkey % 90 as varchar) end as quantity,
    case when o_totalprice > 450000 then '3000000000' else '30' end as days_supply,
    case when o_totalprice between 440000 and 450000 then 'noon'
         else strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') end as fill_time,
    cast(cast(o_totalprice as decimal(12,2)) as varchar) as ingredient_cost,
    copay as copay_amount,
    case when month >= date '1998-07-01' then cast(o_custkey + 1000000000 as varchar) end as pharmacy_npi,
    'pharmacy_claims_' || strftime(month, '%Y%m%d') || '_00.csv' as _source_file,
    loaded as _loaded_at
  from (
    select *, cast(date_trunc('month', o_orderdate) as date) as month, '5.0' as copay,
      timestamp '2026-07-01 00:00:00' as loaded from orders
    union all
    select *, cast(date_trunc('month', o_orderdate) as date), '5.0', timestamp '2026-07-01 00:00:00'
    from orders where o_orderpriority = '1-URGENT'
    union all
    select *, cast(date_trunc('month', o_orderdate) + interval 1 month as date), '7.5', timestamp '2026-07-02 00:00:00'
    from orders where o_orderstatus = 'P')"""

ENROLLMENT_EVENTS = """
  select 'EV' || event_id as event_id, cast(user_id as varchar) as member_id, event_type,
    plan || cast(user_id % 4 as varchar) as plan_code,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') as event_time,
    strftime(ts + delay * interval 1 hour, '%Y-%m-%dT%H:%M:%S.%f') as created_at,
    timestamp '2026-07-01 00:00:00' as _loaded_at
  from (
    select *, 'PLAN_' as plan, case when event_type = 'error' then event_id % 6 + 1 else 0 end as delay from events
    union all
    select *, 'AGAIN_', 1 from events where event_type = 'signup')"""

BRONZE = {
    "members_first": MEMBERS_FIRST,
    "members_changed": MEMBERS_CHANGED,
    "bronze_members": "select * from members_first union all select * from members_changed",
    "bronze_providers": PROVIDERS,
    "bronze_medical_claims": MEDICAL_CLAIMS,
    "bronze_pharmacy_claims": PHARMACY_CLAIMS,
    "bronze_enrollment_events": ENROLLMENT_EVENTS,
}

def _newest(bronze: str, key: str, order_by: str, casts: dict[str, str], *ties: str) -> str:
    """Typed bronze with one row per key: the newest, NULL counting as newest, ties by the other columns."""
    typed = ", ".join(f"{sql} as {c}" for c, sql in casts.items())
    rest = "".join(f", {c} nulls last" for c in ties)
    return f"""
  select * from (select * replace ({typed}) from {bronze})
  qualify row_number() over (partition by {key} order by {order_by} desc nulls first{rest}) = 1"""


def _try(kind: str, *columns: str) -> dict[str, str]:
    return {c: f"try_cast({c} as {kind})" for c in columns}


SILVER = {
    "silver_medical_claims": _newest(
        "bronze_medical_claims", "claim_id", "updated_at",
        _try("date", "service_date") | _try("decimal(12,2)", "billed_amount", "allowed_amount")
        | _try("timestamp", "created_at", "updated_at"),
        "member_id", "provider_id", "diagnosis_code", "procedure_code", "service_date", "billed_amount",
        "allowed_amount", "claim_status", "created_at", "_loaded_at",
    ),
    "silver_members": _newest(
        "bronze_members", "member_id", "updated_at",
        _try("date", "date_of_birth", "effective_date") | _try("timestamp", "created_at", "updated_at"),
        "first_name", "last_name", "date_of_birth", "gender", "plan_code", "state_code", "effective_date",
        "created_at", "_loaded_at",
    ),
    "silver_providers": _newest(
        "bronze_providers", "provider_id", "updated_at", _try("timestamp", "created_at", "updated_at"),
        "provider_name", "npi", "specialty", "state_code", "created_at", "_loaded_at",
    ),
    "silver_pharmacy_claims": _newest(
        "bronze_pharmacy_claims", "claim_id", "_loaded_at",
        _try("bigint", "quantity", "days_supply") | _try("timestamp", "fill_time")
        | _try("decimal(10,2)", "ingredient_cost", "copay_amount")
        | {"pharmacy_npi": "ifnull(pharmacy_npi, 'UNKNOWN')"},
        "member_id", "ndc_code", "drug_name", "quantity", "days_supply", "fill_time", "ingredient_cost",
        "copay_amount", "pharmacy_npi", "_source_file",
    ),
    "silver_enrollment_events": _newest(
        "bronze_enrollment_events", "event_id", "created_at", _try("timestamp", "event_time", "created_at"),
        "member_id", "event_type", "plan_code", "event_time", "_loaded_at",
    ),
}

GOLD = {
    "gold_claims_enriched": """
  select c.* exclude (created_at, updated_at, _loaded_at), c.updated_at, billed_amount - allowed_amount as disallowed_amount,
    plan_code, m.state_code as member_state, gender, provider_name, specialty, p.state_code as provider_state,
    m.state_code is not null and p.state_code is not null and m.state_code = p.state_code as in_state_care
  from silver_medical_claims c
  left join silver_members m using (member_id)
  left join silver_providers p using (provider_id)""",
    "gold_member_360": """
  select m.member_id, m.first_name, m.last_name, m.plan_code, m.state_code, m.date_of_birth,
    coalesce(c.n, 0) as total_claims, cast(coalesce(c.billed, 0) as decimal(22,2)) as total_billed,
    cast(coalesce(c.allowed, 0) as decimal(22,2)) as total_allowed, c.last_day as last_service_date,
    coalesce(r.n, 0) as total_rx_fills, cast(coalesce(r.cost, 0) as decimal(20,2)) as total_rx_cost,
    coalesce(e.n, 0) as total_enrollment_events, e.last_time as last_enrollment_event
  from silver_members m
  left join (select member_id, count(*) as n, sum(billed_amount) as billed, sum(allowed_amount) as allowed,
      max(service_date) as last_day from silver_medical_claims group by 1) c using (member_id)
  left join (select member_id, count(*) as n, sum(ingredient_cost) as cost
      from silver_pharmacy_claims group by 1) r using (member_id)
  left join (select member_id, count(*) as n, max(event_time) as last_time
      from silver_enrollment_events group by 1) e using (member_id)""",
}

PARTS = {**BRONZE, **SILVER, **GOLD}

# What each named part reads, so that a query carries only what it needs.
NEEDS = {
    "members_changed": ["members_first"],
    "bronze_members": ["members_first", "members_changed"],
    **{name: [name.replace("silver_", "bronze_")] for name in SILVER},
    "gold_claims_enriched": ["silver_medical_claims", "silver_members", "silver_providers"],
    "gold_member_360": [
        "silver_members", "silver_medical_claims", "silver_pharmacy_claims", "silver_enrollment_events",
    ],
}


def with_parts(body: str, *names: str, replace: dict[str, str] | None = None) -> str:
    """``body`` preceded by the named parts and whatever these read.

    ``replace`` gives other SQL for a part; ``%s`` in it stands for the usual one.
    """
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = {**PARTS, **{n: sql % PARTS[n] for n, sql in (replace or {}).items()}}
    return "with " + ",\n".join(f"{n} as ({parts[n]})" for n in ordered) + f"\n{body}"
