"""The catalog's queries as ANSI SQL over the same tables.

Fixed values: the category rule and the rate, as the data contract states them.
"""

from __future__ import annotations

RUN_DATE = "2002-01-01"
NOW = "2002-01-01 06:00:00"
LOADED_RUN = "1998-06-15"
HALF = "2000-01-01"
LATE_RUN = "2002-01-02"
TOKEN_KEY = "k1"

MONEY = ("billed_amount", "allowed_amount", "paid_amount")


def dbl(*names: str) -> str:
    return ", ".join(f"cast({n} as double) as {n}" for n in names)


def txt(*names: str) -> str:
    return ", ".join(f"cast({n} as varchar) as {n}" for n in names)


def big(*names: str) -> str:
    return ", ".join(f"cast({n} as bigint) as {n}" for n in names)


def ratio(part: str, whole: str) -> str:
    # Adding zero turns the negative zero of 0 / -x into zero.
    return f"(round(cast({part} as double) / nullif(cast({whole} as double), 0), 4) + 0)"


def stamp(name: str) -> str:
    return f"strftime(cast({name} as timestamp), '%Y-%m-%d %H:%M:%S') as {name}"


LINES = """
lines as (
  select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
    l_returnflag, l_linestatus, cast(l_shipdate as date) as day,
    cast(l_extendedprice as decimal(18,2)) as price,
    cast(l_discount as decimal(4,2)) as disc, cast(l_tax as decimal(4,2)) as tax
  from lineitem
)"""

CLAIMS = """
claims as (
  select 'C' || l_orderkey || '-' || l_linenumber as claim_id,
    case when l_quantity <> 2 then 'M' || o_custkey end as member_id,
    'NPI' || l_suppkey as provider_npi,
    day as service_date,
    case when l_returnflag = 'R' then cast(day + l_linenumber as date) end as discharge_date,
    ' d' || (l_partkey % 100) || ' ' as diagnosis_code,
    'p' || (l_partkey % 50) as procedure_code,
    cast(case when l_quantity = 1 then -price when l_quantity = 4 then 0 else price end
      as decimal(18,2)) as billed_amount,
    cast(round(price * (1 - disc), 2) as decimal(18,2)) as allowed_amount,
    cast(case when l_quantity = 5 then null when l_returnflag = 'R' then 0
      else round(price * (1 - disc) * (1 - tax), 2) end as decimal(18,2)) as paid_amount,
    case l_returnflag || l_linestatus when 'RF' then 'DENIED' when 'RO' then 'VOID'
      when 'NF' then 'PENDING' when 'AO' then 'ADJUSTED' else 'APPROVED' end as claim_status,
    c_mktsegment as plan_id,
    case substr(o_orderpriority, 1, 1) when '1' then 'medical' when '2' then 'pharmacy'
      when '3' then 'dental' when '4' then 'vision' when '5' then 'behavioral' end as claim_type,
    cast(day as timestamp) as ingested_at,
    cast(day as varchar) as run_date,
    case when l_quantity = 3 then '2024-13-01' else cast(day as varchar) end as service_text,
    l_extendedprice as tie_price, l_partkey as tie_part, l_quantity as quantity
  from lines
  left join orders on l_orderkey = o_orderkey
  left join customer on o_custkey = c_custkey
)"""

CLEAN = """
clean as (
  select * from claims
  where claim_id is not null and member_id is not null
    and billed_amount >= 0 and paid_amount >= 0
)"""

LATEST = """
latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by claim_id
      order by ingested_at desc, tie_price desc, tie_part desc) as rn
    from clean) where rn = 1
)"""

MEMBERS = """
members as (
  select 'M' || c_custkey as member_id, c_mktsegment as plan_type,
    cast(c_nationkey as varchar) as group_id, n_name as state
  from customer left join nation on c_nationkey = n_nationkey
  where c_custkey % 10 <> 0
)"""

DIM_MEMBERS = """
dim_members as (
  select 'M' || c_custkey as member_id,
    case c_custkey % 5 when 0 then '0-17' when 1 then '18-34' when 2 then '35-49'
      when 3 then '50-64' else '65+' end as age_band,
    case c_custkey % 2 when 0 then 'F' else 'M' end as gender,
    c_custkey % 4 = 0 as chronic_condition_flag,
    cast(cast(c_acctbal as decimal(18,2)) * 0.01 as decimal(18,6)) as risk_score
  from customer where c_custkey % 10 <> 0
)"""

PROVIDERS = """
providers as (
  select 'NPI' || s_suppkey as provider_npi, s_name as provider_name,
    case s_nationkey % 5 when 0 then 'cardiology' when 1 then 'family' when 2 then 'oncology'
      when 3 then 'pediatrics' else 'surgery' end as specialty,
    case when s_suppkey % 3 = 0 then 'OUT' else 'IN' end as network_flag
  from supplier where s_suppkey % 7 <> 0
)"""

DIM_PROVIDERS = """
dim_providers as (
  select 'NPI' || s_suppkey as provider_npi,
    case s_suppkey % 3 when 0 then 'tier1' when 1 then 'tier2' else 'tier3' end as provider_tier,
    s_suppkey % 2 = 0 as hospital_flag, s_suppkey % 4 = 0 as teaching_hospital_flag
  from supplier where s_suppkey % 7 <> 0
)"""


def conformed(name: str, source: str) -> str:
    """Reference attributes and derived columns on unmasked claims, then the mask."""
    return f"""
{name} as (
  select c.* replace (sha256(c.member_id) as member_id), plan_type, group_id, state,
    provider_name, specialty, network_flag,
    claim_status = 'DENIED' as denied_flag,
    paid_amount > 10000 as high_cost_flag,
    network_flag <> 'IN' as out_of_network_flag,
    cast(date_diff('day', service_date, discharge_date) as integer) as length_of_stay_days,
    {ratio('paid_amount', 'billed_amount')} as cost_ratio,
    cast(year(service_date) as integer) as service_year,
    cast(month(service_date) as integer) as service_month
  from {source} c
  left join members on c.member_id = members.member_id
  left join providers on c.provider_npi = providers.provider_npi
)"""


FACT = """claim_id, member_id, provider_npi, service_date, discharge_date, diagnosis_code,
    procedure_code, billed_amount, allowed_amount, paid_amount, claim_status, claim_type,
    plan_id, denied_flag, high_cost_flag, out_of_network_flag, length_of_stay_days, cost_ratio,
    service_year, service_month, provider_name, specialty, network_flag, state, ingested_at,
    run_date"""


def stg(source: str) -> str:
    return f"""
stg as (
  select {FACT} from (
    select * replace (upper(trim(diagnosis_code)) as diagnosis_code,
      upper(trim(procedure_code)) as procedure_code,
      cast(billed_amount as decimal(18,2)) as billed_amount,
      cast(allowed_amount as decimal(18,2)) as allowed_amount,
      cast(paid_amount as decimal(18,2)) as paid_amount,
      upper(trim(claim_status)) as claim_status, lower(trim(claim_type)) as claim_type,
      try_cast(cost_ratio as decimal(8,4)) as cost_ratio)
    from {source}
    where claim_id is not null and member_id is not null and billed_amount >= 0
      and service_date is not null)
)"""


INT = f"""
int_claims as (
  select s.*, age_band, gender, chronic_condition_flag, risk_score, provider_tier,
    hospital_flag, teaching_hospital_flag,
    case when claim_type = 'medical' and high_cost_flag then 'high_cost_medical'
      when claim_type = 'pharmacy' then 'pharmacy'
      when out_of_network_flag then 'out_of_network' else 'standard' end as claim_category,
    cast(date_diff('day', service_date, date '{RUN_DATE}') as bigint) as days_since_service
  from stg s
  left join dim_members m on s.member_id = sha256(m.member_id)
  left join dim_providers p on s.provider_npi = p.provider_npi
)"""

BASE = [LINES, CLAIMS]
REFERENCE = [MEMBERS, PROVIDERS]
TO_CONFORMED = [*BASE, CLEAN, LATEST, *REFERENCE, conformed("conformed", "latest")]
TO_STG = [*TO_CONFORMED, stg("conformed")]
TO_INT = [*TO_STG, DIM_MEMBERS, DIM_PROVIDERS, INT]

TO_INT_COPIES = [
    *BASE,
    CLEAN,
    *REFERENCE,
    conformed("conformed", "clean"),
    stg("conformed"),
    DIM_MEMBERS,
    DIM_PROVIDERS,
    INT,
]
# The latest run of a claim; other columns, in stored order, decide between copies of one run.
LATEST_RUN = """
int_claims as (
  select * exclude (rn) from (
    select *, row_number() over (partition by claim_id order by run_date desc,
      member_id desc nulls last, provider_npi desc nulls last, service_date desc nulls last,
      discharge_date desc nulls last, diagnosis_code desc nulls last,
      procedure_code desc nulls last, billed_amount desc nulls last,
      allowed_amount desc nulls last, paid_amount desc nulls last,
      claim_status desc nulls last) as rn
    from int_all) where rn = 1
)"""

STG_OUT = f"""claim_id, member_id, provider_npi, {txt('service_date', 'discharge_date')},
  diagnosis_code, procedure_code, {dbl(*MONEY)}, claim_status, claim_type, plan_id, denied_flag,
  high_cost_flag, out_of_network_flag, {big('length_of_stay_days')}, {dbl('cost_ratio')},
  {big('service_year', 'service_month')}, provider_name, specialty, network_flag, state,
  {stamp('ingested_at')}, run_date"""

KEYS = "service_year, service_month, plan_id, claim_type, claim_category, state"


def average(name: str, alias: str) -> str:
    """Rounded half up in whole numbers: a binary quotient can fall beside an exact tie."""
    total = f"cast(sum({name}) * 10000 as hugeint)"
    half_up = f"(2 * abs({total}) + count({name})) // nullif(2 * count({name}), 0)"
    return f"cast(sign({total}) * {half_up} as double) / 10000 as {alias}"


MEASURES = {
    "total_claims": "count(distinct claim_id) as total_claims",
    "unique_members": "count(distinct member_id) as unique_members",
    "unique_providers": "count(distinct provider_npi) as unique_providers",
    "total_billed": "cast(sum(billed_amount) as double) as total_billed",
    "total_allowed": "cast(sum(allowed_amount) as double) as total_allowed",
    "total_paid": "cast(sum(paid_amount) as double) as total_paid",
    "avg_paid_per_claim": average("paid_amount", "avg_paid_per_claim"),
    "median_paid_per_claim": (
        "round(median(cast(paid_amount as double)), 4) as median_paid_per_claim"
    ),
    "denied_claims": (
        "cast(sum(case when denied_flag then 1 else 0 end) as bigint) as denied_claims"
    ),
    "high_cost_claims": (
        "cast(sum(case when high_cost_flag then 1 else 0 end) as bigint) as high_cost_claims"
    ),
    "out_of_network_claims": (
        "cast(sum(case when out_of_network_flag then 1 else 0 end) as bigint)"
        " as out_of_network_claims"
    ),
    "denial_rate_pct": (
        "round(cast(sum(case when denied_flag then 1 else 0 end) as double)"
        " / nullif(count(distinct claim_id), 0) * 100, 2) as denial_rate_pct"
    ),
    "avg_los_days": average("length_of_stay_days", "avg_los_days"),
    "avg_cost_ratio": average("cost_ratio", "avg_cost_ratio"),
    "avg_member_risk_score": average("risk_score", "avg_member_risk_score"),
}


def grouped(names: list[str], keys: str = KEYS, extra: str = "") -> str:
    shown = keys.replace("service_year", big("service_year")).replace(
        "service_month", big("service_month")
    )
    measures = ", ".join(MEASURES[name] for name in names)
    return f"select {shown}, {measures}{extra} from int_claims group by {keys}"


MART = grouped(list(MEASURES), extra=f", '{NOW}' as updated_at")


def sql(ctes: list[str], body: str) -> str:
    return f"with {','.join(ctes)}\n{body}"


HALVES = f"""
old_rows as (
  select * from (select *, row_number() over (partition by claim_id
      order by ingested_at desc, tie_price desc, tie_part desc) as rn
    from claims where service_date < date '{HALF}') where rn = 1),
new_rows as (
  select * from (select *, row_number() over (partition by claim_id
      order by ingested_at desc, tie_price desc, tie_part desc) as rn
    from claims where service_date >= date '{HALF}') where rn = 1)"""

HALF_OUT = f"""claim_id, {txt('service_date')}, {dbl('paid_amount')}, {stamp('ingested_at')},
  run_date, cast(year(service_date) as bigint) as service_year,
  cast(month(service_date) as bigint) as service_month"""

RAW_STAGED = f"""
raw_staged as (
  select claim_id, member_id, provider_npi,
    try_cast(service_text as date) as service_date, discharge_date, diagnosis_code,
    procedure_code, billed_amount, allowed_amount, paid_amount, claim_status, plan_id,
    '{RUN_DATE}' as run_date, timestamp '{NOW}' as ingested_at, 'test' as env, claim_type
  from clean
)"""

STAGED_OUT = f"""select claim_id, sha256(member_id) as member_id, provider_npi,
  {txt('service_date', 'discharge_date')}, diagnosis_code, procedure_code, {dbl(*MONEY)},
  claim_status, plan_id, run_date, {stamp('ingested_at')}, env, claim_type from raw_staged"""

# Copies of one run tie on their time; the other columns decide, in stored order.
RAW_LATEST = """
raw_latest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by claim_id order by sha256(member_id) desc nulls last,
      provider_npi desc nulls last, service_date desc nulls last, discharge_date desc nulls last,
      diagnosis_code desc nulls last, procedure_code desc nulls last,
      billed_amount desc nulls last, allowed_amount desc nulls last, paid_amount desc nulls last,
      claim_status desc nulls last, plan_id desc nulls last, run_date desc nulls last,
      env desc nulls last, claim_type desc nulls last) as rn
    from raw_staged) where rn = 1
)"""

TO_DAY = [
    *BASE,
    CLEAN,
    RAW_STAGED,
    RAW_LATEST,
    *REFERENCE,
    conformed("conformed", "raw_latest"),
    stg("conformed"),
    DIM_MEMBERS,
    DIM_PROVIDERS,
    INT,
]

# Two runs: the later one holds the earlier half of the claims.
TO_BACKFILL = [
    *BASE,
    CLEAN,
    RAW_STAGED.replace(
        f"'{RUN_DATE}' as run_date",
        f"case when service_text < '{HALF}' then '{LATE_RUN}' else '{RUN_DATE}' end as run_date",
    ),
    RAW_LATEST.replace("order by sha256", "order by run_date desc, sha256"),
    *REFERENCE,
    conformed("conformed", "raw_latest"),
    stg("conformed"),
    DIM_MEMBERS,
    DIM_PROVIDERS,
    INT,
]

CHANGES = """
daily as (
  select member_id, day, plan_type from (
    select 'M' || o_custkey as member_id, cast(o_orderdate as date) as day,
      o_orderpriority as plan_type,
      row_number() over (partition by o_custkey, cast(o_orderdate as date)
        order by o_orderkey desc) as rn
    from orders) where rn = 1),
changed as (
  select * from (
    select *, lag(plan_type) over (partition by member_id order by day) as previous from daily)
  where previous is distinct from plan_type),
history as (
  select member_id, plan_type, day as valid_from,
    lead(day) over (partition by member_id order by day) as valid_to
  from changed)"""

HISTORY_OUT = f"""select member_id, plan_type, {txt('valid_from', 'valid_to')},
  valid_to is null as is_current from history"""

FAILURES = {
    "not_null": [
        (c, f"{c} is null") for c in ("claim_id", "member_id", "billed_amount")
    ],
    "accepted_range": [(c, f"{c} < 0") for c in ("billed_amount", "paid_amount")],
    "accepted_values": [
        (
            "claim_status",
            "claim_status not in ('APPROVED', 'DENIED', 'PENDING', 'ADJUSTED', 'VOID')",
        ),
        ("claim_type", "claim_type not in ('medical', 'pharmacy', 'dental', 'vision')"),
    ],
}


def failures(rule: str, table: str = "claims", extra: str = "") -> str:
    return " union all ".join(
        f"select {extra}'{rule}' as rule, '{column}' as column_name,"
        f" count(*) filter (where {failing}) as failures from {table}"
        for column, failing in FAILURES[rule]
    )


MART_FAILURES = [
    ("total_claims", "total_claims < 0"),
    ("denial_rate_pct", "denial_rate_pct < 0 or denial_rate_pct > 100"),
]


def mart_failures(extra: str = "") -> str:
    return " union all ".join(
        f"select {extra}'accepted_range' as rule, '{column}' as column_name,"
        f" count(*) filter (where {failing}) as failures from mart"
        for column, failing in MART_FAILURES
    )


def from_claims(body: str) -> str:
    return sql(BASE, body)


FRESHNESS = """select strftime(newest, '%Y-%m-%d %H:%M:%S') as newest, age_hours,
  case when age_hours is null or age_hours > 48 then 'error'
    when age_hours > 24 then 'warn' else 'pass' end as status, as_of
  from (select newest, as_of,
      cast(date_diff('second', newest, cast(as_of as timestamp)) as double) / 3600 as age_hours
    from (select max(cast(cast(l_shipdate as date) as timestamp)) as newest from lineitem),
      (values ('2001-11-04 12:00:00'), ('2001-11-05 06:00:00'), ('2001-11-06 12:00:00')) v(as_of))"""

TREND = """with days as (
  select cast(ts as date) as day, count(*) as rows from events where ts is not null group by 1)
select cast(day as varchar) as day, rows, avg_before, rows < 0.95 * avg_before as suspicious
from (select day, rows, round(cast(sum(rows) over w as double) / nullif(count(*) over w, 0), 4)
    as avg_before from days
  window w as (order by day range between interval 7 days preceding
    and interval 1 day preceding))"""

# Rows of the odd landing that the extract drops, by quantity, with the rules they break.
REJECTED = """
rejected as (
  select *, case quantity when 1 then 'negative billed_amount ' || cast(cast(billed_amount as double) as varchar)
      when 2 then 'missing member_id -' when 5 then 'missing paid_amount -'
      when 6 then 'not_finite billed_amount NaN' when 7 then 'not_finite billed_amount Infinity'
      when 8 then 'too_large billed_amount 1.0E20'
      when 9 then 'malformed billed_amount 12x; malformed paid_amount ?'
      when 10 then 'negative paid_amount -0.5' end as rules
  from (select * replace (case when claim_status = 'VOID' then 'hospice' else claim_type end as claim_type) from claims)
)"""

ORACLES = {
    "scan_csv_roundtrip": from_claims(
        f"""select claim_id, member_id, provider_npi, service_text as service_date,
        {txt('discharge_date')}, diagnosis_code, procedure_code, {dbl(*MONEY)}, claim_status,
        plan_id, claim_type from claims"""
    ),
    "staging_roundtrip": sql([*BASE, CLEAN, RAW_STAGED], STAGED_OUT),
    "staging_by_month": sql(
        [*BASE, CLEAN, RAW_STAGED],
        """select strftime(service_date, '%Y-%m') as service_month, count(*) as claims,
        cast(sum(paid_amount) as double) as paid from raw_staged group by 1""",
    ),
    "dim_members": sql(
        [MEMBERS.replace("where c_custkey % 10 <> 0", "")],
        "select member_id, plan_type, group_id, state from members",
    ),
    "dim_providers": sql(
        [PROVIDERS.replace("where s_suppkey % 7 <> 0", "")],
        "select provider_npi, provider_name, specialty, network_flag from providers",
    ),
    "filter_required_keys": from_claims(
        "select claim_id, member_id from claims where claim_id is not null and member_id is not null"
    ),
    "filter_required_fields": from_claims(
        f"""select claim_id, service_text as service_date, {dbl('billed_amount')} from claims
        where try_cast(service_text as date) is not null and billed_amount is not null"""
    ),
    "filter_non_negative": from_claims(
        f"""select claim_id, {dbl('billed_amount', 'paid_amount')} from claims
        where billed_amount >= 0 and paid_amount >= 0"""
    ),
    "parse_dates": from_claims(
        """select claim_id, cast(try_cast(service_text as date) as varchar) as service_text,
        cast(discharge_date as varchar) as discharge_text from claims"""
    ),
    "audit_columns": from_claims(
        f"""select claim_id, '{RUN_DATE}' as run_date, '{NOW}' as ingested_at, 'test' as env
        from claims"""
    ),
    "pii_mask": from_claims("select claim_id, sha256(member_id) as member_id from claims"),
    "pii_mask_any": from_claims(
        """select claim_id, sha256(provider_npi) as provider_npi,
        sha256(cast(service_date as varchar)) as service_date,
        sha256(cast(billed_amount as varchar)) as billed_amount from claims"""
    ),
    "tokenize_npi": from_claims(
        f"select claim_id, sha256('{TOKEN_KEY}' || provider_npi) as provider_npi from claims"
    ),
    "normalize_codes": from_claims(
        """select claim_id, upper(trim(diagnosis_code)) as diagnosis_code,
        upper(trim(procedure_code)) as procedure_code, upper(trim(claim_status)) as claim_status,
        lower(trim(claim_type)) as claim_type from claims"""
    ),
    "standardize_claim_type": from_claims(
        """select claim_id, sent, case when upper(trim(sent)) in
          ('MEDICAL', 'PHARMACY', 'DENTAL', 'VISION', 'BEHAVIORAL') then upper(trim(sent)) end
          as standard
        from (select claim_id, case when claim_status = 'VOID' then 'hospice'
          else ' ' || claim_type || ' ' end as sent from claims)"""
    ),
    "codes_to_array": from_claims(
        """select claim_id, cast(2 as bigint) as n, upper(trim(diagnosis_code)) as first,
        upper(trim(diagnosis_code)) || '|' || upper(trim(procedure_code)) as codes from claims"""
    ),
    "length_of_stay": from_claims(
        f"""select claim_id, {txt('service_date', 'discharge_date')},
        cast(date_diff('day', service_date, discharge_date) as bigint) as length_of_stay_days
        from claims"""
    ),
    "days_since_service": from_claims(
        f"""select claim_id, {txt('service_date')},
        cast(date_diff('day', service_date, date '{RUN_DATE}') as bigint) as days_since_service
        from claims"""
    ),
    "days_to_payment": from_claims(
        """select claim_id, cast(payment_date as varchar) as payment_date,
        cast(date_diff('day', service_date, payment_date) as bigint) as days_to_payment
        from (select claim_id, service_date, case when paid_amount > 0 then
          cast(service_date + 10 + cast(cast(floor(paid_amount) as bigint) % 20 as integer)
            as date) end as payment_date from claims)"""
    ),
    "service_period": from_claims(
        """select claim_id, cast(year(service_date) as bigint) as service_year,
        cast(month(service_date) as bigint) as service_month from claims"""
    ),
    "cost_ratio": from_claims(
        f"""select claim_id, {dbl('paid_amount', 'billed_amount')}, cost_ratio,
        cast(try_cast(cost_ratio as decimal(8,4)) as double) as stored_ratio
        from (select *, {ratio('paid_amount', 'billed_amount')} as cost_ratio from claims)"""
    ),
    "allowed_ratio": from_claims(
        f"""select claim_id, {dbl('allowed_amount', 'billed_amount')},
        {ratio('allowed_amount', 'billed_amount')} as allowed_ratio from claims"""
    ),
    "business_flags": sql(
        [*BASE, PROVIDERS],
        """select claim_id, c.provider_npi, claim_status = 'DENIED' as denied_flag,
        paid_amount > 10000 as high_cost_flag, network_flag <> 'IN' as out_of_network_flag
        from claims c left join providers p on c.provider_npi = p.provider_npi""",
    ),
    "claim_category": sql(
        [*BASE, CLEAN, PROVIDERS],
        """select claim_id, claim_type,
        case when claim_type = 'medical' and paid_amount > 10000 then 'high_cost_medical'
          when claim_type = 'pharmacy' then 'pharmacy'
          when network_flag <> 'IN' then 'out_of_network' else 'standard' end as claim_category
        from clean c left join providers p on c.provider_npi = p.provider_npi""",
    ),
    "enrich_reference": sql(
        [*BASE, *REFERENCE],
        """select claim_id, sha256(c.member_id) as member_id, c.provider_npi, plan_type, group_id,
        state, provider_name, specialty, network_flag from claims c
        left join members m on c.member_id = m.member_id
        left join providers p on c.provider_npi = p.provider_npi""",
    ),
    "dedup_latest": sql(
        [*BASE, CLEAN, LATEST],
        f"""select claim_id, member_id, provider_npi, {txt('service_date', 'discharge_date')},
        diagnosis_code, procedure_code, {dbl(*MONEY)}, claim_status, plan_id, claim_type,
        {stamp('ingested_at')}, run_date from latest""",
    ),
    "upsert_initial": sql([*BASE, LATEST.replace("from clean", "from claims")], f"select {HALF_OUT} from latest"),
    "upsert_merge": sql(
        [*BASE, HALVES],
        f"""select {HALF_OUT} from (select * from new_rows union all
        select * from old_rows where claim_id not in (select claim_id from new_rows))""",
    ),
    "merge_actions": sql(
        [*BASE, HALVES],
        """select case when o.claim_id is not null and n.claim_id is not null then 'updated'
          when n.claim_id is not null then 'inserted' else 'kept' end as action,
        count(*) as claims
        from old_rows o full join new_rows n on o.claim_id = n.claim_id group by 1""",
    ),
    "incremental_filter": from_claims(
        f"""select claim_id, run_date from claims where run_date >
        (select max(run_date) from claims where run_date < '{HALF}')"""
    ),
    "load_fact": sql(
        TO_CONFORMED,
        f"""select {STG_OUT} from conformed where run_date = '{LOADED_RUN}'""",
    ),
    "int_incremental_merge": sql(
        TO_INT_COPIES,
        """select claim_id, run_date, claim_category, days_since_service, state, age_band,
          provider_tier
        from (select *, row_number() over (partition by claim_id order by run_date desc,
            member_id desc nulls last, provider_npi desc nulls last,
            service_date desc nulls last, discharge_date desc nulls last,
            diagnosis_code desc nulls last, procedure_code desc nulls last,
            billed_amount desc nulls last, allowed_amount desc nulls last,
            paid_amount desc nulls last, claim_status desc nulls last) as rn
          from int_claims) where rn = 1""",
    ),
    "stg_claims": sql(TO_STG, f"select {STG_OUT} from stg"),
    "int_claims_enriched": sql(
        TO_INT,
        f"""select {STG_OUT}, age_band, gender, chronic_condition_flag, {dbl('risk_score')},
        provider_tier, hospital_flag, teaching_hospital_flag, claim_category,
        days_since_service from int_claims""",
    ),
    "agg_distinct_counts": sql(
        TO_INT_COPIES, grouped(["total_claims", "unique_members", "unique_providers"])
    ),
    "agg_sums": sql(TO_INT, grouped(["total_billed", "total_allowed", "total_paid"])),
    "agg_averages": sql(
        TO_INT,
        grouped(["avg_paid_per_claim", "avg_los_days", "avg_cost_ratio", "avg_member_risk_score"]),
    ),
    "agg_median": sql(TO_INT, grouped(["median_paid_per_claim"])),
    "agg_median_merged": sql(TO_INT, grouped(["median_paid_per_claim"])),
    "agg_distinct_rollup": sql(
        TO_INT,
        """select plan_id, cast(service_year as bigint) as service_year, count(distinct member_id) as unique_members,
        count(distinct provider_npi) as unique_providers from int_claims group by all""",
    ),
    "agg_conditional_counts": sql(
        TO_INT, grouped(["denied_claims", "high_cost_claims", "out_of_network_claims"])
    ),
    "agg_denial_rate": sql(TO_INT_COPIES, grouped(["denial_rate_pct"])),
    "mart_claims_summary": sql(TO_INT, MART),
    "mart_payer_type_month": sql(
        TO_INT,
        grouped(list(MEASURES), "plan_id, claim_type, service_year, service_month"),
    ),
    "validation_metrics": from_claims(
        """select count(*) as rows_in, count(*) filter (where ok) as rows_valid,
        count(*) - count(*) filter (where ok) as rows_dropped
        from (select claim_id is not null and member_id is not null and billed_amount >= 0
          and paid_amount >= 0 as ok from claims)"""
    ),
    "dq_unique": from_claims(
        "select claim_id, count(*) as copies from claims group by 1 having count(*) > 1"
    ),
    "dq_not_null": from_claims(failures("not_null")),
    "dq_accepted_range": from_claims(failures("accepted_range")),
    "dq_accepted_values": from_claims(failures("accepted_values")),
    "dq_mart_range": sql([*TO_INT_COPIES, f"mart as ({MART})"], mart_failures()),
    "dq_freshness": FRESHNESS,
    "dq_row_count_trend": TREND,
    "scd2_build": f"with {CHANGES} {HISTORY_OUT}",
    "point_in_time_join": sql(
        [*BASE, CHANGES],
        f"""select claim_id, c.member_id, {txt('service_date')}, plan_type,
        {txt('valid_from', 'valid_to')}
        from (select claim_id, member_id, service_date from claims) c
        left join history h on c.member_id = h.member_id and service_date >= valid_from
          and (service_date < valid_to or valid_to is null)""",
    ),
    "transform_run": sql(
        [*BASE, CLEAN, RAW_STAGED, RAW_LATEST, *REFERENCE, conformed("conformed", "raw_latest")],
        f"select {STG_OUT}, env, plan_type, group_id from conformed",
    ),
    "daily_run": sql(TO_DAY, MART),
    "daily_rerun": sql(TO_DAY, MART),
    "daily_backfill": sql(TO_BACKFILL, MART),
    "daily_interrupted": sql(TO_BACKFILL, MART),
    "load_fact_emptied": sql(
        [*TO_CONFORMED, f"""moved as (select * replace ('{RUN_DATE}' as run_date) from conformed
        where run_date = '{LOADED_RUN}')"""],
        f"select {STG_OUT} from moved",
    ),
    "extract_odd_amounts": sql(
        [*BASE, CLEAN],
        """select count(*) filter (where quantity not in (6, 7, 8)) as staged,
        cast(max(billed_amount) filter (where quantity not in (6, 7, 8)) as double) as most_billed,
        (select count(*) from claims) as rows_in,
        count(*) filter (where quantity not in (6, 7, 8)) as rows_valid,
        (select count(*) from claims) - count(*) filter (where quantity not in (6, 7, 8)) as rows_dropped
        from clean""",
    ),
    "quarantined_claims": sql(
        [*BASE, REJECTED],
        """select claim_id, sha256(member_id) as member_id, claim_type, rules, service_text as service_date
        from rejected where rules is not null""",
    ),
    "quarantine_report": sql(
        [*BASE, REJECTED],
        """select *, (select count(*) from rejected where rules is not null) as rows_dropped from (
          select 'rejected' as route, split_part(r, ' ', 1) as rule, split_part(r, ' ', 2) as column_name, count(*) as rows
          from (select unnest(string_split(rules, '; ')) as r from rejected) group by all
          union all select 'rejected', 'any', 'any', count(*) from rejected where rules is not null
          union all select 'staged', 'malformed', 'service_date', count(*) from rejected where rules is null and quantity = 3
          union all select 'staged', 'malformed', 'allowed_amount', count(*) from rejected where rules is null and quantity = 11
          union all select 'staged', 'unknown', 'claim_type', count(*) from rejected
            where rules is null and claim_type = 'hospice') where rows > 0""",
    ),
    "model_views": sql(
        [*TO_INT_COPIES[:-1], INT.replace("int_claims as", "int_all as"), LATEST_RUN], MART
    ),
    "dq_report": sql(
        [*TO_DAY, f"mart as ({MART})"],
        f"""select 'stg_claims' as table_name, 'unique' as rule, 'claim_id' as column_name,
          count(*) as failures
        from (select claim_id from stg group by 1 having count(*) > 1)
        union all {failures('not_null', 'stg', "'stg_claims' as table_name, ")}
        union all {failures('accepted_range', 'stg', "'stg_claims' as table_name, ")}
        union all {failures('accepted_values', 'stg', "'stg_claims' as table_name, ")}
        union all {mart_failures("'mart_claims_summary' as table_name, ")}""",
    ),
}
ORACLES["scan_json_roundtrip"] = ORACLES["scan_csv_roundtrip"]
ORACLES["upsert_only_if_newer"] = ORACLES["upsert_merge"]
ORACLES["mart_layout"] = ORACLES["mart_claims_summary"]
ORACLES["scd2_apply"] = ORACLES["scd2_build"]
ORACLES["extract_run"] = ORACLES["staging_roundtrip"]
