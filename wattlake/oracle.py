"""DuckDB oracle SQL for the registered queries.

Each text is standalone ANSI-ish SQL over the driver's pre-registered views
(``events``, ``orders``, ``customer`` ...). The silver feeds are rebuilt as
CTEs with the same definitions as ``wattlake.sources.adapters``. Only the
CTEs a query mentions are prepended.
"""

from __future__ import annotations

import re

SLOT = ("lpad(cast(hour(ts) as varchar),2,'0') || ':' || "
        "lpad(cast(minute(ts) - minute(ts) % 15 as varchar),2,'0') || ':00'")

VIEWS = {
    "a_production": f"""a_production as (
  with g as (select cast(ts as date) as date, {SLOT} as time, cast(user_id % 5 + 1 as int) as inv_id,
    sum(case when event_type='error' then cast(0 as decimal(18,2)) else cast(value as decimal(18,2)) end) as pac,
    max(event_type) as status, max(case when event_type='error' then cast(user_id % 3 as int) + 1 else 0 end) as error
    from events group by 1,2,3)
  select date, time, inv_id, cast(pac as double) as pac,
    cast(sum(pac) over (partition by date, inv_id order by time rows between unbounded preceding and current row) as double) as daysum,
    status, error from g)""",
    "a_consumption": f"""a_consumption as (
  with g as (select cast(ts as date) as date, {SLOT} as time, sum(cast(value as decimal(18,2))) as v from events group by 1,2)
  select date, time, 'kWh' as unit,
    cast(sum(v) over (order by date, time rows between unbounded preceding and current row) as double) as value_acquired,
    cast(v as double) as variation from g)""",
    "a_humidity": f"""a_humidity as (
  select cast(ts as date) as date, {SLOT} as time, '%' as unit, value as value_acquired,
    cast(user_id % 7 as double) as variation from events where event_type='view')""",
    "a_temperature": f"""a_temperature as (
  select cast(ts as date) as date, {SLOT} as time, 'C' as unit, value as value_acquired,
    cast(user_id % 7 as double) as variation from events where event_type='click')""",
    "a_weather": f"""a_weather as (
  select cast(ts as date) as date, {SLOT} as time, value, value + cast(user_id % 4 as double) as prediction,
    'site' || cast(user_id % 3 as varchar) as site, event_type as measurement,
    case when event_type='signup' then 'W/m2' else 'C' end as unit, event_id as issued
  from events where event_type in ('signup','purchase'))""",
    "a_booking": """a_booking as (
  select cast(o_orderdate as date) as date, 'R' || lpad(cast(o_custkey % 60 as varchar),3,'0') as room_id,
    lpad(cast(7 + o_orderkey % 11 as varchar),2,'0') || ':00' as start_time,
    lpad(cast(8 + o_orderkey % 11 + o_orderkey % 3 as varchar),2,'0') || ':00' as end_time,
    o_orderkey as reservation_id, o_orderpriority as activity_type, o_orderstatus as department,
    c_name as reserved_by, c_mktsegment as class
  from orders join customer on o_custkey = c_custkey)""",
}


ENERGY_DAYS = "select * replace (cast(date '2024-01-01' + cast(reservation_id % 45 as int) as date) as date) from a_booking"


def on_energy_days(sql: str) -> str:
    """The same SQL over bookings moved into the days of the energy feeds."""
    return re.sub(r"\ba_booking\b", "a_moved", sql)


def with_views(body: str, extra: list[str] | None = None) -> str:
    """Prepend the ``a_*`` CTEs the body uses (plus ``extra`` CTE texts)."""
    moved = "a_moved" in body
    used = [v for v in VIEWS if re.search(rf"\b{v}\b", body) or (moved and v == "a_booking")]
    ctes = [VIEWS[v] for v in used] + ([f"a_moved as ({ENERGY_DAYS})"] if moved else []) + list(extra or [])
    body = body.strip()
    if body.lower().startswith("with "):
        body = body[5:]
        return "with " + ",\n".join(ctes + [body]) if ctes else "with " + body
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body


def norm_time(expr: str, bare_hour: bool = False) -> str:
    """DuckDB twin of ``text.normalize_time`` (pads, never truncates)."""
    s = f"trim(cast({expr} as varchar))"
    n = f"len(string_split({s}, ':'))"
    bare = (f" when {n} = 1 then (case when length({s}) < 2 then lpad({s}, 2, '0') else {s} end) || ':00:00'"
            if bare_hour else "")
    p = f"(case when {n} = 2 then {s} || ':00'{bare} else {s} end)"
    return f"(case when length({p}) < 8 then lpad({p}, 8, '0') else {p} end)"


def hour_key(expr: str) -> str:
    h = f"split_part(trim(cast({expr} as varchar)), ':', 1)"
    return f"(case when length({h}) < 2 then lpad({h}, 2, '0') else {h} end)"


def hour_num(expr: str) -> str:
    return f"coalesce(try_cast({hour_key(expr)} as int), 0)"


def ktext(expr: str) -> str:
    """DuckDB twin of ``keys.key_text``: doubles print like Python ``str``."""
    return f"coalesce(cast({expr} as varchar), 'nan')"


def d(expr: str) -> str:
    return f"cast({expr} as varchar)"


def valid(t: str) -> str:
    return f"regexp_matches({t}, '^[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}$')"


def tid(date_expr: str, t: str) -> str:
    return f"md5({d(date_expr)} || 'T' || {t})"


def tid_or_empty(date_expr: str, t: str) -> str:
    return f"(case when {date_expr} is not null and {valid(t)} then {tid(date_expr, t)} else '' end)"


def ts_of(date_expr: str, t: str) -> str:
    return f"try_cast({d(date_expr)} || ' ' || {norm_time(t, True)} as timestamp)"


def dbl(x) -> str:
    return f"cast({x} as double)"


from .functions.text import FRENCH_MONTHS as MONTHS_SWAP  # noqa: E402  (the one fixed-values table)

MONTHS_FR = "[" + ", ".join(f"'{fr}'" for fr, _ in MONTHS_SWAP) + "]"


def french_parse(expr: str) -> str:
    s = f"trim({expr})"
    for fr, en in MONTHS_SWAP:
        s = f"replace({s}, '{fr}', '{en}')"
    return f"coalesce(cast(try_strptime({s}, '%d %b %Y') as date), date '1900-01-01')"


def messy(c: str, k: str) -> str:
    m = f"({k}) % 9"
    return (f"(case when {m} = 0 then '' when {m} = 1 then 'nan' when {m} = 2 then 'None' when {m} = 3 then null "
            f"when {m} = 4 then '\"' || {c} || '\"' when {m} = 5 then '  \"' || {c} || '\" ' else {c} end)")


def strip_fill(x: str) -> str:
    s = f"trim(replace({x}, '\"', ''))"
    return f"(case when {s} is null or {s} in ('nan', 'None', '') then 'EMPTY' else {s} end)"


def redact(x: str) -> str:
    return f"(case when trim({x}) != '' then 'ANONYMIZED' else {x} end)"


def first_by(src: str, keys: str, order: str) -> str:
    return (f"(select * exclude (rn) from (select *, row_number() over (partition by {keys} order by {order}) as rn "
            f"from {src}) where rn = 1)")


# --- reusable bodies (no a_* CTEs; ``with_views`` adds them) ------------------------------------

BODY: dict[str, str] = {}

BODY["power_fact"] = f"""
with slot_cons as (
  select date, time as t, variation as cons_w,
    md5('cons_profile_' || {ktext('value_acquired')} || '_' || {ktext('variation')}) as cons_id
  from {first_by('a_consumption', 'date, time', 'value_acquired, variation')}),
slot_run as (select date, time as t, cast(count_if(pac > 0) as double) / count(*) * 100.0 as pct
  from a_production group by 1, 2),
day_p as (select date, max(daysum) as mx from a_production group by 1),
day_c as (select date, cast(sum(cast(variation as decimal(18,2))) as double) as sv from a_consumption group by 1)
select md5('pf_' || {d('p.date')} || '_' || p.time || '_' || {d('p.inv_id')}) as FactID,
  {tid_or_empty('p.date', 'p.time')} as TimeID,
  coalesce(sc.cons_id, '') as ConsumptionID,
  md5('inv_' || {d('p.inv_id')}) as InverterKey,
  md5('err_' || {d('p.error')}) as ErrorID,
  coalesce(p.status, 'Unknown') as Status,
  p.pac as PAC, p.daysum as Daysum,
  cast(0 as double) as PDC1, cast(0 as double) as PDC2, cast(0 as double) as UDC1, cast(0 as double) as UDC2,
  p.pac / 1000.0 - coalesce(sc.cons_w, 0.0) / 1000.0 as Prod_vs_Consumption_Diff,
  dp.mx / 1000.0 as Total_Production_End_of_Day,
  coalesce(dc.sv, 0.0) / 1000.0 as Total_Consumption_End_of_day,
  coalesce(sr.pct, 0.0) as Pct_Inverters_Running,
  p.date as partition_date
from a_production p
left join slot_run sr on sr.date = p.date and sr.t = p.time
left join slot_cons sc on sc.date = p.date and sc.t = p.time
left join day_p dp on dp.date = p.date
left join day_c dc on dc.date = p.date"""

TIMES = f"""(
  select distinct date, time from (
    select date, {norm_time('start_time', True)} as time from a_booking
    union all select date, {norm_time('time')} from a_consumption
    union all select date, {norm_time('time')} from a_humidity
    union all select date, {norm_time('time')} from a_temperature
    union all select date, {norm_time('time')} from a_production
    union all select date, {norm_time('time')} from a_weather)
  where date is not null and time is not null)"""


def dim_time_of(times: str) -> str:
    return f"""select {tid('date', 'time')} as TimeID, cast(year(date) as int) as Year, cast(month(date) as int) as Month,
  cast(day(date) as int) as Day, try_cast(split_part(time, ':', 1) as int) as Hour,
  try_cast(split_part(time, ':', 2) as int) as Minute, try_cast(split_part(time, ':', 3) as int) as Second
from (select distinct date, time from {times} where {valid('time')})"""


BODY["distinct_timestamps"] = f"select date, time from {TIMES}"
BODY["dim_time"] = dim_time_of(TIMES)
BODY["dim_room"] = """select md5(room_id) as RoomID, room_id as Alt_RoomID, room_id as FullName, room_id as Alt_FullName
from (select distinct room_id from a_booking where room_id is not null)"""
BODY["dim_reservation"] = f"""
with b as (select *, '' as reservation_code, '' as instructor from a_booking where reservation_id is not null),
f as {first_by('b', 'reservation_id, start_time',
               'date nulls first, end_time nulls first, reservation_code nulls first, activity_type nulls first, '
               'class nulls first, department nulls first, instructor nulls first, reserved_by nulls first')}
select md5('res_' || {d('reservation_id')} || '_' || coalesce(start_time, '')) as ReservationID,
  {ts_of('date', 'start_time')} as Start_time, {ts_of('date', 'end_time')} as End_time,
  coalesce(reservation_code, '') as List_Item, coalesce(activity_type, '') as Activity, coalesce(class, '') as Class,
  coalesce(department, '') as Department, coalesce(instructor, '') as Professor, coalesce(reserved_by, '') as ReservedBy
from f"""


def dim_profile_sql(src: str, prefix: str, id_col: str) -> str:
    return f"""select md5('{prefix}_' || {ktext('value_acquired')} || '_' || {ktext('variation')}) as {id_col},
  value_acquired as Value, variation as Variation
from (select distinct value_acquired, variation from {src})"""


BODY["dim_consumption"] = dim_profile_sql("a_consumption", "cons_profile", "ConsumptionID")
BODY["dim_humidity"] = dim_profile_sql("a_humidity", "hum_lvl", "HumidityID")
BODY["dim_temp"] = dim_profile_sql("a_temperature", "temp_lvl", "TempID")
BODY["dim_inverter"] = """select md5('inv_' || cast(inv_id as varchar)) as InverterKey, inv_id as InverterID
from (select distinct inv_id from a_production where inv_id is not null)"""
BODY["dim_errors"] = """select distinct md5('err_' || cast(error as varchar)) as ErrorID,
  case when error is null or error = 0 then 'No Error' else cast(error as varchar) end as Error_info
from a_production"""
BODY["dim_forecast"] = """select md5('fc_def_' || site || '_' || measurement) as ForecastID, site as Site,
  measurement as Measurement, min(unit) as Unit
from a_weather group by site, measurement"""
BODY["dim_consumption_prediction"] = f"""select distinct md5('cpred_' || {d('date')} || '_' || {norm_time('time')})
  as Cons_PredictionID from a_consumption"""


def dim_pred_sql(prefix: str, pred_col: str, actual_col: str) -> str:
    return f"""select md5('{prefix}_' || {d('date')} || '_' || t) as Prod_PredictionID, date as pred_date,
  {hour_num('t')} as pred_hour, round(avg(prediction), 6) as {pred_col}, cast(0 as double) as {actual_col}
from (select *, {norm_time('time')} as t from a_weather) group by date, t"""


BODY["dim_production_prediction_pac"] = dim_pred_sql("ppred_pac", "pred_sum_pac", "sum_pac")
BODY["dim_production_prediction_daysum"] = dim_pred_sql("ppred_daysum", "pred_daysum", "daysum")

ROOM_SLOTS = """
  select date, start_time, rooms_booked, rooms_total,
    coalesce(cast(rooms_booked as double) / nullif(cast(rooms_total as double), 0), 0.0) as pct_rooms_booked,
    rooms_total - rooms_booked as rooms_free
  from (select date, date_trunc('month', date) as ym, start_time, count(distinct room_id) as rooms_booked
        from {src} group by 1, 2, 3) bk
  join (select date_trunc('month', date) as ym, count(distinct room_id) as rooms_total from {src} group by 1) tt
  using (ym)"""

BODY["rooms_booked_by_slot"] = ROOM_SLOTS.format(src="a_booking")


def rooms_rows(src: str) -> str:
    return f"""
with b as (select *, {norm_time('start_time', True)} as t from {src}),
s as ({ROOM_SLOTS.format(src=src)})
select md5('rf_' || {d('b.date')} || '_' || b.t || '_' || {ktext('b.room_id')} || '_' || {d('b.reservation_id')}) as FactID,
  case when b.date is not null and {valid('b.t')} then {tid('b.date', 'b.t')} end as TimeID,
  case when b.room_id is not null and b.room_id != '' then md5(b.room_id) end as RoomID,
  case when b.reservation_id is not null
       then md5('res_' || {d('b.reservation_id')} || '_' || coalesce(b.start_time, '')) else '' end as ReservationID,
  s.pct_rooms_booked as Pct_Rooms_Booked, cast(s.rooms_free as bigint) as Rooms_Free_Count, b.date as partition_date
from b left join s on s.date = b.date and s.start_time = b.start_time"""


BODY["rooms_fact"] = f"""select * from ({rooms_rows('a_booking')})
where TimeID is not null and TimeID != '' and RoomID is not null and RoomID != ''"""

BODY["weather_fact"] = f"""
with w as (select *, {norm_time('time')} as t from a_weather),
f as {first_by('w', 'date, t', 'issued desc, site desc, measurement desc')},
h as (select date, {hour_key('time')} as hour, round(avg(value_acquired), 6) as v from a_humidity group by 1, 2),
tp as (select date, {hour_key('time')} as hour, round(avg(value_acquired), 6) as v from a_temperature group by 1, 2)
select md5('wf_' || {d('f.date')} || '_' || f.t || '_' || {ktext('f.site')}) as FactID,
  {tid_or_empty('f.date', 'f.t')} as TimeID,
  md5('fc_def_' || {ktext('f.site')} || '_' || {ktext('f.measurement')}) as ForecastID,
  true as Most_Recent_Forecast, h.v as Humidity_Today, tp.v as Temp_Today, f.date as partition_date
from f
left join h on h.date = f.date and h.hour = {hour_key('f.t')}
left join tp on tp.date = f.date and tp.hour = {hour_key('f.t')}"""

BODY["prediction_fact"] = f"""
with c as (select *, {norm_time('time')} as t from a_consumption),
f as {first_by('c', 'date, t', 'value_acquired, variation')},
sm as (select date, {norm_time('time')} as t, round(avg(prediction), 6) as m from a_weather group by 1, 2),
df as {first_by('sm', 'date', 't')}
select md5('predf_' || {d('f.date')} || '_' || f.t) as FactID, {tid_or_empty('f.date', 'f.t')} as TimeID,
  md5('cpred_' || {d('f.date')} || '_' || f.t) as Cons_PredictionID,
  coalesce(md5('ppred_pac_' || {d('df.date')} || '_' || df.t), '') as Prod_PredictionIDPac,
  coalesce(md5('ppred_daysum_' || {d('df.date')} || '_' || df.t), '') as Prod_PredictionIDDaysum,
  df.m as Predicted_ProductionPac, df.m as Predicted_ProductionDaysum,
  f.value_acquired as Predicted_Consumption, f.date as partition_date
from f left join df on df.date = f.date"""


def cte(**bodies: str) -> str:
    """``name as (body), ...`` for composing bodies."""
    return ",\n".join(f"{n} as ({BODY[b] if b in BODY else b})" for n, b in bodies.items())


SQL: dict[str, str] = {}

SQL["clean_sensor_text"] = f"""
with ev as (select *, cast(ts as date) as date, {SLOT} as time from events where event_type = 'view'),
raw as (select case when event_id % 23 = 0 then 'n/a' when event_id % 2 = 0 then strftime(date, '%d.%m.%Y')
                    else strftime(date, '%-d.%-m.%Y') end as raw_date,
          ' ' || time || '  ' as time_str, '%' as unit,
          case when event_id % 19 = 0 then 'x,y' else replace(cast(value as varchar), '.', ',') end as val_raw,
          replace(cast(cast(user_id % 7 as double) as varchar), '.', ',') as var_raw from ev),
p as (select cast(try_strptime(trim(raw_date), '%d.%m.%Y') as date) as date, trim(time_str) as time, unit,
        try_cast(replace(trim(val_raw), ',', '.') as double) as value_acquired,
        try_cast(replace(trim(var_raw), ',', '.') as double) as variation from raw)
select * from p where date is not null and value_acquired is not null"""

SQL["parse_inverter_date"] = with_views("""
with raw as (select case when day(date) % 10 = 0 and inv_id = 3 then 'xx.xx.xx' else strftime(date, '%d.%m.%y') end as raw_date,
    time, cast(inv_id as varchar) as inv_raw, case when error > 0 then '-' else cast(pac as varchar) end as pac_raw,
    cast(daysum as varchar) as daysum_raw, status, cast(error as varchar) as error_raw from a_production),
p as (select cast(try_strptime(trim(raw_date), '%d.%m.%y') as date) as date, time,
    cast(try_cast(trim(inv_raw) as double) as int) as inv_id, try_cast(trim(pac_raw) as double) as pac,
    try_cast(trim(daysum_raw) as double) as daysum, status, try_cast(trim(error_raw) as double) as error from raw)
select * from p where date is not null""")

SQL["parse_iso_utc"] = """
with raw as (select event_id, event_id % 29 = 0 as bad, date_trunc('second', ts) as wall, event_id % 3 as k,
    cast(value as varchar) as value_raw from events where event_type in ('signup', 'purchase')),
p as (select event_id, case when bad then null when k = 0 then wall when k = 1 then wall - interval 1 hour
                            else wall + interval 150 minute end as ts, try_cast(value_raw as double) as value from raw)
select event_id, cast(ts as date) as date, strftime(ts, '%H:%M:%S') as time, value from p where ts is not null"""

SQL["french_date"] = with_views(f"""
select reservation_id, raw_date, {french_parse('raw_date')} as date from (
  select reservation_id, case when reservation_id % 31 = 0 then '?? ??? ????'
    else lpad(cast(day(date) as varchar), 2, '0') || ' ' || {MONTHS_FR}[month(date)] || ' ' || cast(year(date) as varchar)
    end as raw_date from a_booking)""")

SQL["strip_quotes_fill_empty"] = with_views(f"""
select reservation_id, {strip_fill('room_id')} as room_id, {strip_fill('activity_type')} as activity_type,
  {strip_fill('department')} as department, {strip_fill('reserved_by')} as reserved_by, {strip_fill('class')} as class
from (select reservation_id, {messy('room_id', 'reservation_id')} as room_id,
        {messy('activity_type', 'reservation_id + 1')} as activity_type,
        {messy('department', 'reservation_id + 2')} as department,
        {messy('reserved_by', 'reservation_id + 3')} as reserved_by, {messy('class', 'reservation_id + 4')} as class
      from a_booking)""")

SQL["redact_people"] = with_views(f"""
select reservation_id, {redact('reserved_by')} as reserved_by, {redact('instr')} as instructor
from (select *, case when reservation_id % 4 = 0 then '' when reservation_id % 4 = 1 then '  '
                     else 'Prof ' || department end as instr from a_booking)""")

SQL["normalize_time"] = with_views(f"""
select reservation_id, raw_time, {norm_time('raw_time', True)} as time, {hour_key('raw_time')} as hour_key,
  {hour_num('raw_time')} as hour
from (select reservation_id, case when reservation_id % 4 = 0 then start_time
        when reservation_id % 4 = 1 then regexp_replace(start_time, '^0', '')
        when reservation_id % 4 = 2 then regexp_replace(split_part(start_time, ':', 1), '^0', '')
        else start_time || ':00' end as raw_time from a_booking)""")

SQL["sentinel_filter"] = with_views("""
select date, time, site, measurement, value, issued from (
  select date, time, site, measurement, issued, case when issued % 9 = 0 then -99999.0
    when issued % 11 = 0 then null else value end as value from a_weather)
where not (value is not distinct from -99999.0)""")

SQL["month_guard"] = f"""
select date, time, value_acquired, folder_month from (
  select cast(ts as date) as date, {SLOT} as time, value as value_acquired,
    lpad(cast(case when event_id % 10 = 0 then month(ts) % 12 + 1 else month(ts) end as varchar), 2, '0') as folder_month
  from events where event_type = 'view')
where month(date) = try_cast(folder_month as int)"""

SQL["rooms_integrity_filter"] = with_views(f"""
with broken as (select * replace (
    case when reservation_id % 13 = 0 then null else room_id end as room_id,
    case when reservation_id % 17 = 0 then 'n/a' else start_time end as start_time) from a_booking),
r as ({rooms_rows('broken')})
select FactID, TimeID, RoomID, ReservationID, partition_date,
  (TimeID is null or TimeID = '' or RoomID is null or RoomID = '') as quarantined from r""")

SQL["role_filter"] = with_views("""
select 'director' as role, date, room_id, start_time, reservation_id, department from a_booking where department = 'F'""")

SQL["unpivot_inverters"] = with_views("select date, time, inv_id, pac, daysum, status, error from a_production")

for _name in ["distinct_timestamps", "dim_time", "dim_room", "dim_reservation", "dim_consumption", "dim_humidity",
              "dim_temp", "dim_inverter", "dim_errors", "dim_forecast", "dim_consumption_prediction",
              "dim_production_prediction_pac", "dim_production_prediction_daysum", "rooms_booked_by_slot",
              "power_fact", "weather_fact", "rooms_fact", "prediction_fact"]:
    SQL[_name] = with_views(BODY[_name])

SQL["upsert_new_rows"] = with_views(f"""
with new as ({BODY['dim_time']}),
old as ({dim_time_of(f"(select distinct date, {norm_time('time')} as time from a_production where date is not null)")})
select * from new where TimeID not in (select TimeID from old)""")

SQL["fact_day_replace"] = with_views(f"""
with {cte(pf='power_fact')}
select FactID, partition_date, case when dayofweek(partition_date) in (0, 6) then 2 else 1 end as load_version from pf""")

SQL["daily_totals"] = with_views("""
with p as (select date, max(daysum) as mx from a_production group by 1),
c as (select date, cast(sum(cast(variation as decimal(18,2))) as double) as sv from a_consumption group by 1)
select coalesce(p.date, c.date) as date, p.mx / 1000.0 as total_production_kwh, c.sv / 1000.0 as total_consumption_kwh
from p full join c on p.date = c.date""")

SQL["running_pct"] = with_views("""
select date, time, cast(count_if(pac > 0) as bigint) as n_running, count(*) as n_readings,
  cast(count_if(pac > 0) as double) / count(*) * 100.0 as pct_running
from a_production group by 1, 2""")

SQL["hourly_sensor_mean"] = with_views(f"""
select feed, date, hour, round(avg(value_acquired), 6) as mean_value from (
  select 'humidity' as feed, date, {hour_key('time')} as hour, value_acquired from a_humidity
  union all select 'temperature', date, {hour_key('time')}, value_acquired from a_temperature)
group by 1, 2, 3""")

SQL["power_export"] = with_views(f"""
with {cte(pf='power_fact', dt='dim_time', di='dim_inverter', dc='dim_consumption', de='dim_errors')}
select f.FactID, f.partition_date, f.Prod_vs_Consumption_Diff, f.Total_Production_End_of_Day,
  f.Total_Consumption_End_of_day, f.Pct_Inverters_Running, t.Year, t.Month, t.Day, t.Hour,
  i.InverterID as Inverter_Business_Key, f.Status as Inverter_Status, f.PAC, f.Daysum,
  c.Value as Consumption_Value, c.Variation as Consumption_Variation, e.Error_info
from pf f left join dt t on f.TimeID = t.TimeID left join di i on f.InverterKey = i.InverterKey
left join dc c on f.ConsumptionID = c.ConsumptionID left join de e on f.ErrorID = e.ErrorID""")

DAY_PROD = "(select date, max(daysum) as mx from a_production group by 1)"
DAY_CONS = "(select date, cast(sum(cast(variation as decimal(18,2))) as double) as sv from a_consumption group by 1)"

SQL["campus_kpis"] = with_views(on_energy_days(f"""
with prod as {DAY_PROD},
per_inv as (select date, cast(sum(cast(m as decimal(18,2))) as double) as si
            from (select date, inv_id, max(daysum) as m from a_production group by 1, 2) group by 1),
cons as {DAY_CONS},
hum as (select date, avg(value_acquired) as h from a_humidity group by 1),
tmp as (select date, avg(value_acquired) as t from a_temperature group by 1),
rooms as (select date, avg(pct_rooms_booked) as r from ({BODY['rooms_booked_by_slot']}) group by 1),
day as (select *, strftime(date, '%Y-%m') as month from prod join per_inv using (date) full join cons using (date)
        full join hum using (date) full join tmp using (date) full join rooms using (date)),
g as (select month, date, sum(cast(mx as decimal(18,2))) as p, sum(cast(si as decimal(18,2))) as pi,
        sum(cast(sv as decimal(18,2))) as c, avg(h) as h, avg(t) as t, avg(r) as r, grouping(month, date) as gid
      from day group by rollup(month, date))
select case gid when 0 then 'day' when 1 then 'month' else 'all' end as level, month, date,
  round(cast(p as double) / 1000.0, 6) as production_kwh, round(cast(pi as double) / 1000.0, 6) as production_sum_inverters_kwh,
  round(cast(c as double) / 1000.0, 6) as consumption_kwh, round(h, 6) as humidity_mean, round(t, 6) as temperature_mean,
  round(r, 6) as rooms_booked_pct_mean
from g"""))

SQL["energy_value_chf"] = with_views(f"""
with x as (select coalesce(p.date, c.date) as date, cast(coalesce(p.mx, 0.0) as decimal(18,2)) as pw,
             cast(coalesce(c.sv, 0.0) as decimal(18,2)) as cw
           from {DAY_PROD} p full join {DAY_CONS} c on p.date = c.date)
select date, round(cast(pw as double) / 1000.0, 6) as production_kwh, round(cast(cw as double) / 1000.0, 6) as consumption_kwh,
  cast(pw * cast(0.00012 as decimal(12,9)) as double) as production_chf,
  cast(cw * cast(0.00025 as decimal(12,9)) as double) as consumption_chf,
  cast(pw * cast(0.00012 as decimal(12,9)) - cw * cast(0.00025 as decimal(12,9)) as double) as net_chf
from x""")

SQL["production_vs_climate"] = with_views(f"""
select p.date, round(p.mx / 1000.0, 6) as production_kwh, round(t.t, 6) as temperature_mean, round(h.h, 6) as humidity_mean
from {DAY_PROD} p
left join (select date, avg(value_acquired) as t from a_temperature group by 1) t on t.date = p.date
left join (select date, avg(value_acquired) as h from a_humidity group by 1) h on h.date = p.date""")

SQL["forecast_accuracy"] = with_views("""
with x as (select strftime(date, '%Y-%m') as month, date, cast(abs(value - prediction) as decimal(18,2)) as err,
             cast(abs(value) as decimal(18,2)) as mag from a_weather),
g as (select month, date, count(*) as n, sum(err) as se, sum(mag) as sm, grouping(month, date) as gid
      from x group by rollup(month, date))
select case gid when 0 then 'day' when 1 then 'month' else 'all' end as level, month, date, n,
  round(cast(se as double) / n, 6) as mae,
  round((1.0 - cast(se as double) / nullif(cast(sm as double), 0)) * 100.0, 6) as accuracy_pct
from g""")

SQL["status_counts"] = with_views("""
select inv_id, cast(count_if(cls = 'Error') as bigint) as n_error, cast(count_if(cls = 'OK-Standby') as bigint) as n_ok_standby,
  cast(count_if(cls = 'Running') as bigint) as n_running
from (select inv_id, case when coalesce(error, 0) > 0 then 'Error' when pac > 0 then 'Running' else 'OK-Standby' end as cls
      from a_production) group by inv_id""")

SQL["error_counts"] = with_views("""
select inv_id, error, count(*) as n_readings,
  case when error is null or error = 0 then 'No Error' else cast(error as varchar) end as error_info
from a_production group by inv_id, error""")

SQL["reservations_share"] = with_views("""
with b as (select *, 'Prof ' || cast(reservation_id % 37 as varchar) as instructor from a_booking),
g as (select activity_type, department, instructor, count(*) as n_bookings,
             grouping(activity_type, department, instructor) as gid
           from b group by grouping sets ((activity_type), (department), (instructor))),
n as (select case gid when 3 then 'activity_type' when 5 then 'department' when 6 then 'instructor' end as breakdown,
        case gid when 3 then activity_type when 5 then department when 6 then instructor end as value, n_bookings from g)
select breakdown, value, n_bookings,
  round(cast(n_bookings as double) * 100.0 / cast(sum(n_bookings) over (partition by breakdown) as double), 6) as pct
from n""")

ODD_HOURS = """(select * replace (
    case when reservation_id % 17 = 0 then null when reservation_id % 3 = 1 then substr(start_time, 1, 3) || '15' else start_time end as start_time,
    case when reservation_id % 3 = 1 then substr(end_time, 1, 3) || '30' else end_time end as end_time) from a_booking)"""
BOOK_HOURS = f"""(select *, {hour_num('start_time')} as start_hour,
    greatest({hour_num('end_time')} + case when split_part(end_time, ':', 2) > '00' then 1 else 0 end, {hour_num('start_time')} + 1) as end_hour
  from {ODD_HOURS} where start_time is not null)"""

SQL["room_date_heatmap"] = with_views(f"""
select room_id, date, count(*) as n_bookings, cast(sum(end_hour - start_hour) as bigint) as booked_hours
from {BOOK_HOURS} group by room_id, date""")

SQL["room_hour_timeline"] = with_views(f"""
select date, hour, room_id, count(*) as n_bookings from (
  select date, room_id, cast(unnest(generate_series(start_hour, end_hour - 1)) as int) as hour from {BOOK_HOURS})
group by date, hour, room_id""")

SQL["most_recent_forecast"] = with_views("""
select w.date, w.time, w.site, w.measurement, w.value, w.prediction, w.issued from a_weather w
join (select date, time, site, measurement, max(issued) as m from a_weather group by all) l
  on l.date = w.date and l.time = w.time and l.site = w.site and l.measurement = w.measurement
where w.issued = l.m""")

SQL["stalled_inverters"] = with_views("""
with p as (select date, time, inv_id, daysum,
             lag(daysum) over (partition by date, inv_id order by time) as prev_daysum from a_production),
p2 as (select *, daysum > prev_daysum as rising from p),
s as (select date, time, cast(count_if(rising) as bigint) as n_rising from p2 group by 1, 2)
select date, time, inv_id, daysum, prev_daysum, n_rising - (case when rising then 1 else 0 end) as n_peers_rising
from p2 join s using (date, time)
where daysum <= prev_daysum and n_rising - (case when rising then 1 else 0 end) > 0""")

SQL["peer_underperformers"] = with_views("""
with s as (select date, time, avg(pac) as a, count(*) as n from a_production group by 1, 2)
select date, time, inv_id, pac, round(a, 6) as peer_avg_pac, n as n_inverters
from a_production join s using (date, time) where n > 1 and pac < a * 0.5""")

CORE = dict(DimTime="dim_time", DimInverter="dim_inverter", DimConsumption="dim_consumption", DimErrors="dim_errors",
            DimForecast="dim_forecast", DimRoom="dim_room", DimReservation="dim_reservation",
            Power_FactTable="power_fact", Weather_FactTable="weather_fact", Rooms_FactTable="rooms_fact",
            Prediction_FactTable="prediction_fact")
PK = dict(DimTime="TimeID", DimInverter="InverterKey", DimConsumption="ConsumptionID", DimErrors="ErrorID",
          DimForecast="ForecastID", DimRoom="RoomID", DimReservation="ReservationID", Power_FactTable="FactID",
          Weather_FactTable="FactID", Rooms_FactTable="FactID", Prediction_FactTable="FactID")
FKS = [("Power_FactTable", "TimeID", "DimTime", "TimeID"),
       ("Power_FactTable", "ConsumptionID", "DimConsumption", "ConsumptionID"),
       ("Power_FactTable", "InverterKey", "DimInverter", "InverterKey"),
       ("Power_FactTable", "ErrorID", "DimErrors", "ErrorID"),
       ("Weather_FactTable", "TimeID", "DimTime", "TimeID"),
       ("Weather_FactTable", "ForecastID", "DimForecast", "ForecastID"),
       ("Rooms_FactTable", "TimeID", "DimTime", "TimeID"),
       ("Rooms_FactTable", "RoomID", "DimRoom", "RoomID"),
       ("Rooms_FactTable", "ReservationID", "DimReservation", "ReservationID"),
       ("Prediction_FactTable", "TimeID", "DimTime", "TimeID")]
NOT_NULL = dict(DimTime=["TimeID"], DimInverter=["InverterKey"], DimConsumption=["ConsumptionID"],
                DimErrors=["ErrorID"], DimForecast=["ForecastID"], DimRoom=["RoomID"],
                DimReservation=["ReservationID"],
                Power_FactTable=["FactID", "TimeID", "ConsumptionID", "InverterKey", "partition_date"],
                Weather_FactTable=["FactID", "TimeID", "ForecastID", "partition_date"],
                Rooms_FactTable=["FactID", "TimeID", "RoomID", "partition_date"],
                Prediction_FactTable=["FactID", "TimeID", "partition_date"])
# keys broken on purpose, as in the registered checks
DAMAGE = {
    "DimRoom": "select * from {t} where Alt_RoomID not like '%5' union all select * from {t} where Alt_RoomID like '%7'",
    "DimInverter": "select * from {t} where InverterID <> 3",
    "Power_FactTable": "select * replace (case when day(partition_date) <> 13 then ConsumptionID end as ConsumptionID, "
                       "case when day(partition_date) = 14 then '' else TimeID end as TimeID) from {t}",
    "Weather_FactTable": "select * from {t} union all select * from {t} where day(partition_date) = 2",
}
CORE_CTES = cte(**{(f"whole_{t}" if t in DAMAGE else t): b for t, b in CORE.items()}) + "".join(
    f",\n{t} as ({q.format(t='whole_' + t)})" for t, q in DAMAGE.items())

SQL["pk_duplicates"] = with_views("with " + CORE_CTES + "\n" + "\nunion all\n".join(
    f"select '{t}' as table_name, cast(coalesce(sum(n), 0) as bigint) as n_rows, "
    f"cast(count_if(n > 1) as bigint) as n_duplicate_keys from (select {PK[t]}, count(*) as n from {t} group by 1)"
    for t in CORE))

SQL["fk_orphans"] = with_views("with " + CORE_CTES + "\n" + "\nunion all\n".join(
    f"select '{f}' as fact_table, '{c}' as column_name, '{dm}' as dim_table, count(*) as n_orphans from {f} "
    f"where {c} is not null and {c} != '' and {c} not in (select {k} from {dm} where {k} is not null)"
    for f, c, dm, k in FKS))

SQL["not_null_counts"] = with_views("with " + CORE_CTES + "\n" + "\nunion all\n".join(
    f"select '{t}' as table_name, '{c}' as column_name, "
    f"cast(count_if({c} is null or cast({c} as varchar) = '') as bigint) as n_nulls from {t}"
    for t, cols in NOT_NULL.items() for c in cols))

FEEDS = ["production", "consumption", "humidity", "temperature", "weather", "booking"]

SQL["missing_days"] = with_views("\nunion all\n".join(
    f"select '{fd}' as feed, cast(dd as date) as date from (select unnest(generate_series(min(date), max(date), "
    f"interval 1 day)) as dd from a_{fd}) where cast(dd as date) not in "
    f"(select date from a_{fd} where date is not null)" for fd in FEEDS))

SQL["backfill_range"] = with_views(on_energy_days(f"""
with {cte(pf='power_fact', wf='weather_fact', rf='rooms_fact', prf='prediction_fact')},
alld as ({" union all ".join(f"select date from a_{fd}" for fd in FEEDS)}),
cal as (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from alld)
select cal.date,
  coalesce(a.n, 0) as n_power_rows, coalesce(b.n, 0) as n_weather_rows, coalesce(c.n, 0) as n_rooms_rows,
  coalesce(e.n, 0) as n_prediction_rows
from cal
left join (select partition_date as date, count(*) as n from pf group by 1) a on a.date = cal.date
left join (select partition_date as date, count(*) as n from wf group by 1) b on b.date = cal.date
left join (select partition_date as date, count(*) as n from rf group by 1) c on c.date = cal.date
left join (select partition_date as date, count(*) as n from prf group by 1) e on e.date = cal.date"""))

_LOGGED = [("Power_FactTable", "pf"), ("Weather_FactTable", "wf"), ("Rooms_FactTable", "rf"), ("Prediction_FactTable", "prf")]
SQL["run_log"] = with_views(on_energy_days(f"""
with {cte(pf='power_fact', wf='weather_fact', rf='rooms_fact', prf='prediction_fact')},
cal as (select cast(unnest(generate_series(min(date), max(date), interval 1 day)) as date) as date from a_booking),
n as ({" union all ".join(f"select '{t}' as table_name, cal.date, count(x.partition_date) as n_rows from cal left join {a} x on x.partition_date = cal.date group by 2" for t, a in _LOGGED)})
select table_name, date, n_rows, case when n_rows > 0 then 'loaded' else 'empty' end as status from n"""))

SQL["future_time_rows"] = with_views("""
with r as (select distinct date from a_consumption),
t as (select distinct make_date(2023, month(x), least(day(x), day(last_day(make_date(2023, month(x), 1))))) as target
      from (select unnest([date + 1, date + 2]) as x from r)),
s as (select unnest(generate_series(cast(target as timestamp), cast(target as timestamp) + interval 1425 minute,
                                    interval 15 minute)) as ts from t)
select distinct md5(strftime(ts, '%Y-%m-%d') || 'T' || strftime(ts, '%H:%M:%S')) as TimeID,
  cast(year(ts) as int) as Year, cast(month(ts) as int) as Month, cast(day(ts) as int) as Day,
  cast(hour(ts) as int) as Hour, cast(minute(ts) as int) as Minute, cast(second(ts) as int) as Second
from s""")

def sensor_parsed(event_type: str, unit: str, value: str = "value", days: str = "true") -> str:
    """CTEs ``raw`` and ``p``: sensor lines as the drops hold them, and their parsed cells."""
    return f"""
ev as (select * from (select *, cast(ts as date) as date, {SLOT} as time from events where event_type = '{event_type}') where {days}),
raw as (select case when event_id % 23 = 0 then 'n/a' when event_id % 2 = 0 then strftime(date, '%d.%m.%Y')
                    else strftime(date, '%-d.%-m.%Y') end as raw_date,
          ' ' || time as time_str, '{unit}' as unit,
          case when event_id % 19 = 0 then 'x,y' else replace(cast({value} as varchar), '.', ',') end as val_raw,
          replace(cast(cast(user_id % 7 as double) as varchar), '.', ',') as var_raw,
          event_id % 13 = 0 as too_long,
          lpad(cast(case when event_id % 10 = 0 then month(date) % 12 + 1 else month(date) end as varchar), 2, '0')
            as folder_month from ev),
p as (select cast(try_strptime(trim(raw_date), '%d.%m.%Y') as date) as date, trim(time_str) as time, unit,
        try_cast(replace(trim(val_raw), ',', '.') as double) as value_acquired,
        try_cast(replace(trim(var_raw), ',', '.') as double) as variation, folder_month, too_long
      from raw)"""


SENSOR_KEPT = """select date, time, unit, value_acquired, variation from p
where not too_long and date is not null and value_acquired is not null and month(date) = try_cast(folder_month as int)"""

for _name, _type, _unit in [("silver_sensor_load", "view", "%"), ("silver_temperature_load", "click", "C"),
                            ("silver_consumption_load", "purchase", "kWh"), ("silver_pv_load", "signup", "W")]:
    SQL[_name] = f"with {sensor_parsed(_type, _unit)}\n{SENSOR_KEPT}"

SQL["power_fact_unstored"] = SQL["power_fact"]

SQL["silver_mixed_schema"] = with_views("""
select date, count(*) as n_rows, count(case when day(date) % 5 <> 0 then variation end) as n_variations,
  cast(sum(cast(case when day(date) % 5 = 0 then value_acquired else variation end as decimal(18,2))) as double) as sum_variation_w
from a_consumption group by date""")

SQL["sensor_rejects"] = f"""with {sensor_parsed('view', '%')}
select reason, count(*) as n_lines from (
  select case when too_long then 'too many cells' when date is null then 'bad date' when value_acquired is null then 'bad value'
              when month(date) is distinct from try_cast(folder_month as int) then 'wrong month folder' end as reason from p)
where reason is not null group by reason"""

_FIRST = SENSOR_KEPT + " and day(date) not in (10, 20)"
SQL["incremental_ingest"] = f"""
select * from (with {sensor_parsed('view', '%')} {_FIRST})
union all
select * from (with {sensor_parsed('view', '%', 'value + 1.0', 'day(date) in (10, 20)')} {SENSOR_KEPT})"""

SQL["actual_vs_predicted"] = with_views(f"""
with a as (select date, {norm_time('time')} as time, cast(sum(cast(pac as decimal(18,2))) as double) as actual_sum_pac
           from a_production group by 1, 2),
p as (select date, {norm_time('time')} as time, round(avg(prediction), 6) as pred_sum_pac from a_weather group by 1, 2)
select coalesce(a.date, p.date) as date, coalesce(a.time, p.time) as time, a.actual_sum_pac, p.pred_sum_pac
from a full join p on a.date = p.date and a.time = p.time""")

SQL["dashboard_slicers"] = with_views(f"""
select department, activity_type, count(*) as n_bookings from (
  select department, {strip_fill(messy('activity_type', 'reservation_id + 1'))} as activity_type, date, start_time from a_booking)
where activity_type != 'EMPTY' and department in ('F', 'O') and date between date '1996-01-01' and date '2000-12-31'
  and month(date) in (1, 2, 3, 9, 10, 11) and start_time between '08:00' and '15:59'
group by department, activity_type""")

PRODUCTION_PARSED = """
with raw as (select *, case when day(date) = 7 and time < '06:00:00' then 'xx.xx.xx' else strftime(date, '%d.%m.%y')
                      end as raw_date,
               lpad(cast(case when day(date) = 15 and time >= '12:00:00' then month(date) % 12 + 1 else month(date) end
                         as varchar), 2, '0') as folder_month from a_production),
p as (select cast(try_strptime(raw_date, '%d.%m.%y') as date) as pdate, * from raw)"""
SQL["silver_production_load"] = with_views(PRODUCTION_PARSED + """
select pdate as date, time, inv_id, pac, daysum, status, cast(error as double) as error,
  cast(null as double) as pdc1, cast(null as double) as pdc2, cast(null as double) as udc1,
  cast(null as double) as udc2, cast(null as double) as temp, cast(null as double) as uac
from p where pdate is not null and month(pdate) = try_cast(folder_month as int)""")

SQL["production_rejects"] = with_views(PRODUCTION_PARSED + """
select reason, count(*) as n_lines from (
  select distinct date, time, case when day(date) = 21 and time between '10:00:00' and '10:59:59' then 'too many cells' when pdate is null then 'bad date'
              when month(pdate) is distinct from try_cast(folder_month as int) then 'wrong month folder' end as reason from p)
where reason is not null group by reason""")

WEATHER_PARSED = """
with ev as (select *, date_trunc('second', ts) as utc from events where event_type in ('signup', 'purchase')),
raw as (select case when event_id % 29 = 0 then 'garbage' else strftime(utc, '%Y-%m-%dT%H:%M:%S') end as time_raw,
          case when event_id % 9 = 0 then '-99999.0' when event_id % 11 = 0 then ''
               else cast(value as varchar) end as value_raw,
          value + cast(user_id % 4 as double) as prediction, 'site' || cast(user_id % 3 as varchar) as site,
          event_type as measurement, case when event_type = 'signup' then 'W/m2' else 'C' end as unit,
          lpad(cast(case when event_id % 10 = 0 then month(utc) % 12 + 1 else month(utc) end as varchar), 2, '0')
            as folder_month,
          cast(cast(utc as date) - 1 as timestamp) + case when event_id % 2 = 0 then interval 6 hour else interval 12 hour end as issued,
          event_id % 37 = 0 as too_long from ev),
p as (select try_strptime(time_raw, '%Y-%m-%dT%H:%M:%S') as ts, try_cast(value_raw as double) as value,
        prediction, site, measurement, unit, folder_month, issued, too_long from raw)"""
SQL["silver_weather_load"] = WEATHER_PARSED + """
select cast(ts as date) as date, strftime(ts, '%H:%M:%S') as time, value, prediction, site, measurement, unit, issued
from p
where ts is not null and month(ts) = try_cast(folder_month as int) and value is distinct from -99999.0"""

SQL["weather_rejects"] = WEATHER_PARSED + """
select reason, count(*) as n_lines from (
  select case when too_long then 'too many cells' when ts is null then 'bad time' when month(ts) is distinct from try_cast(folder_month as int) then 'wrong month folder'
              when value = -99999.0 then 'sentinel' end as reason from p)
where reason is not null group by reason"""

SQL["booking_rejects"] = with_views("select 'too many cells' as reason, cast(reservation_id as varchar) as reservation_id from a_booking where reservation_id % 41 = 0")

SQL["silver_booking_load"] = with_views(f"""
select {french_parse("case when reservation_id % 31 = 0 then '?? ??? ????' else lpad(cast(day(date) as varchar), 2, '0') || ' ' || " + MONTHS_FR + "[month(date)] || ' ' || cast(year(date) as varchar) end")} as date,
  {strip_fill('room_id')} as room_id, start_time, end_time, cast(reservation_id as varchar) as reservation_id,
  {strip_fill('reserved_by')} as reserved_by,
  {strip_fill("case when reservation_id % 7 = 0 then '' else activity_type end")} as activity_type,
  {strip_fill("case when reservation_id % 4 = 0 then '' when reservation_id % 4 = 1 then 'nan' else 'Prof ' || department end")} as instructor,
  {strip_fill('department')} as department, {strip_fill('class')} as class
from a_booking where reservation_id % 41 != 0""")

SQL["rooms_fact_day_runs"] = with_views(f"""
with {cte(rf='rooms_fact', dr='dim_reservation')}
select rf.FactID, rf.RoomID, rf.ReservationID, rf.Pct_Rooms_Booked, rf.Rooms_Free_Count, rf.partition_date, dr.Start_time as first_start
from rf left join dr using (ReservationID)""")
SQL["rooms_fact_bitmaps"] = SQL["rooms_fact"]
SQL["campus_kpis_incremental"] = SQL["campus_kpis"]
SQL["forecast_accuracy_incremental"] = SQL["forecast_accuracy"]

SQL["stall_episodes"] = with_views("""
with p as (select date, time, inv_id, daysum - lag(daysum) over (partition by date, inv_id order by time) as rise from a_production),
s as (select date, time, count_if(rise > 0) as n, sum(case when rise > 0 then cast(rise as decimal(18,2)) end) as gain from p group by 1, 2),
q as (select p.*, n, gain, coalesce(rise <= 0 and n > 0, false) as stalled from p join s using (date, time)),
i as (select *, sum(case when stalled then 0 else 1 end) over (partition by date, inv_id order by time rows unbounded preceding) as island from q)
select date, inv_id, min(time) as start_time, max(time) as end_time, count(*) as n_readings, round(sum(cast(gain as double) / n), 4) as lost_daysum
from i where stalled group by date, inv_id, island""")

SQL["missing_day_ranges"] = with_views("""
with d as (select distinct 'production' as feed, date from a_production where day(date) not in (5, 6, 7, 20)
  union all select distinct 'humidity', date from a_humidity where day(date) not in (1, 9) union all select distinct 'booking', date from a_booking),
n as (select feed, date, lead(date) over (partition by feed order by date) as nxt from d)
select feed, cast(date + 1 as date) as first_day, cast(nxt - 1 as date) as last_day, cast(nxt - date - 1 as int) as n_days from n where nxt - date > 1""")

SQL["room_month_matrix"] = with_views(f"""
with h as (select room_id, date, cast(sum(end_hour - start_hour) as bigint) as hours from {BOOK_HOURS} group by room_id, date),
m as (select distinct room_id, date_trunc('month', date) as month from h),
g as (select x.room_id, x.month, x.d, coalesce(cast(h.hours as varchar), case when x.d <= day(last_day(x.month)) then '0' else '-' end) as place, h.hours
      from (select *, unnest(range(1, 32)) as d from m) x left join h on h.room_id = x.room_id and date_trunc('month', h.date) = x.month and day(h.date) = x.d)
select room_id, strftime(month, '%Y-%m') as month, string_agg(place, ',' order by d) as hours, cast(sum(hours) as bigint) as total_hours from g group by room_id, month""")

SQL["role_views"] = with_views("""
select 'director' as role, 'rooms' as page, department || ' ' || room_id as item, count(*) as n_rows from a_booking where department = 'F' group by department, room_id
union all select r, 'solar', cast(inv_id as varchar), count(*) from a_production, (values ('director'), ('technician')) t(r) group by r, inv_id""")

FRAME = f"""
with p as (select date, {hour_num('time')} as hour, cast(sum(cast(pac as decimal(18,2))) as double) / 1000.0 as production_kwh from a_production group by 1, 2),
c as (select date, {hour_num('time')} as hour, cast(sum(cast(variation as decimal(18,2))) as double) / 1000.0 as consumption_kwh from a_consumption group by 1, 2),
h as (select date, {hour_num('time')} as hour, round(avg(value_acquired), 6) as humidity from a_humidity group by 1, 2),
tm as (select date, {hour_num('time')} as hour, round(avg(value_acquired), 6) as temperature from a_temperature group by 1, 2),
rm as (select date, round(avg(pct_rooms_booked), 6) as rooms_booked from ({BODY['rooms_booked_by_slot']}) group by 1),
lw as {first_by('a_weather', 'date, time, site, measurement', 'issued desc')},
wf as (select date, {hour_num('time')} as hour, round(avg(prediction), 6) as forecast from lw group by 1, 2)
select date, hour, coalesce(consumption_kwh, 0.0) as consumption_kwh, coalesce(production_kwh, 0.0) as production_kwh,
  coalesce(humidity, 0.0) as humidity, coalesce(temperature, 0.0) as temperature, coalesce(rooms_booked, 0.0) as rooms_booked,
  coalesce(forecast, 0.0) as forecast, cast(dayofweek(date) + 1 as int) as weekday
from c full join p using (date, hour) left join h using (date, hour) left join tm using (date, hour) left join rm using (date) left join wf using (date, hour)"""
SQL["forecast_features"] = with_views(on_energy_days(FRAME))
SQL["energy_forecast_accuracy"] = with_views(on_energy_days(f"""
with fr as ({FRAME}),
x as (select a.date, unnest([{{'kind': 'production', 'a': a.production_kwh, 'p': b.production_kwh}},
                            {{'kind': 'consumption', 'a': a.consumption_kwh, 'p': b.consumption_kwh}}]) as s
      from fr a join fr b on a.date = b.date + 1 and a.hour = b.hour),
y as (select date, strftime(date, '%Y-%m') as month, s.kind as kind, cast(abs(round(s.a, 2) - round(s.p, 2)) as decimal(18,2)) as err,
        cast(abs(round(s.a, 2)) as decimal(18,2)) as mag from x)
select kind, case grouping(kind, month, date) when 0 then 'day' when 1 then 'month' else 'all' end as level, month, date, count(*) as n,
  round(cast(sum(err) as double) / count(*), 6) as mae,
  round((1.0 - cast(sum(err) as double) / nullif(cast(sum(mag) as double), 0)) * 100.0, 6) as accuracy_pct
from y group by grouping sets ((kind, month, date), (kind, month), (kind))"""))

SQL["forecast_backtest"] = with_views(on_energy_days(f"""
with fr as ({FRAME}),
n as (select a.date, count(case when b.date >= a.date - 7 then 1 end) as np, count(*) as nc
      from (select distinct date from fr) a join fr b on b.date < a.date group by a.date)
select date, hour, production_kwh, consumption_kwh, cast(coalesce(np, 0) as int) as n_train_production, cast(coalesce(nc, 0) as int) as n_train_consumption,
  coalesce(np > 0 and nc > 0, false) as scored
from fr left join n using (date)"""))
