"""Registration of queries, and the given tables' shapes in SQL for the oracle side."""

from __future__ import annotations

import atexit

from tripspot.functions.fixed import WEATHER_CODE_LABELS, WEATHER_NO_DATA, WEATHER_OTHER
from tripspot.session import Scratch

QUERIES: dict = {}
ORACLES: dict = {}
_OWNED: dict = {}


def owned(spark) -> Scratch:
    """The tables that queries store in a session. Results are read after a query has returned, so they are kept until
    the program ends, and removed then if the session is still open."""
    key = spark.sparkContext.applicationId
    if key not in _OWNED:
        _OWNED[key] = scratch = Scratch(spark, "queries")
        atexit.register(lambda: scratch.close() if spark.sparkContext._jsc else None)
    return _OWNED[key]


# The shapes of tripspot.fixtures in SQL. Each entry may use the ones before it.
CTES = {
    "raw": """
        select event_id, ts as tpep_pickup_datetime, cast(user_id % 26 as integer) as PULocationID,
               cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 26 as DOLocationID
        from events""",
    "zones": """
        select n_nationkey as LocationID, r_name as Borough, n_name as Zone,
               case when n_nationkey % 2 = 0 then 'Zone A' else 'Zone B' end as service_zone
        from nation join region on n_regionkey = r_regionkey""",
    "trips": """
        select cast(event_id as varchar) as event_id, tpep_pickup_datetime as pickup_datetime,
               tpep_pickup_datetime as event_time,
               cast(PULocationID as varchar) as pickup_zone, cast(DOLocationID as varchar) as dropoff_zone,
               cast(hour(tpep_pickup_datetime) as integer) as pickup_hour,
               cast(dayofweek(tpep_pickup_datetime) as integer) as pickup_dow
        from raw""",
    "curated": """
        select t.*, p.Borough as pickup_borough, p.Zone as pickup_zone_name, p.service_zone as pickup_service_zone,
               q.Borough as dropoff_borough, q.Zone as dropoff_zone_name, q.service_zone as dropoff_service_zone
        from trips t
        left join zones p on t.pickup_zone = cast(p.LocationID as varchar)
        left join zones q on t.dropoff_zone = cast(q.LocationID as varchar)""",
    "demand": """
        select date '2024-01-01' + cast(l_orderkey % 120 as integer) as service_date,
               cast(cast(floor(l_quantity * l_quantity / 100) as bigint) as varchar) as pickup_zone,
               l_linenumber as pickup_hour,
               cast(dayofweek(date '2024-01-01' + cast(l_orderkey % 120 as integer)) as integer) as pickup_dow
        from lineitem""",
    "daily": """
        select service_date, pickup_zone, pickup_hour, pickup_dow, cast(count(*) as double) as trip_count
        from demand where service_date >= date '2022-01-01' group by all""",
    "scores": """
        select d.*, round(trip_count / greatest(busiest, 1.0) * 100.0, 2) as hotspot_score,
               strftime(service_date, '%Y-%m-%d') || 'T' || lpad(cast(pickup_hour as varchar), 2, '0') as weather_hour
        from daily d
        join (select service_date, pickup_hour, pickup_dow, max(trip_count) as busiest from daily group by all) b
        using (service_date, pickup_hour, pickup_dow)""",
    "split": """
        select *, case when position <= days * 4 // 5 then 'train' else 'test' end as side
        from (select service_date, row_number() over (order by service_date) as position, count(*) over () as days
              from (select distinct service_date from scores))""",
    "train": "select s.* from scores s join split using (service_date) where side = 'train'",
    "test": "select s.* from scores s join split using (service_date) where side = 'test'",
    "baseline": """
        select pickup_zone, pickup_hour, pickup_dow, round(avg(hotspot_score), 9) as mean,
               round(stddev_pop(hotspot_score), 9) as stddev, count(*) as n
        from train group by all""",
    "weather_base": """
        select strftime(ts, '%Y-%m-%dT%H') as weather_hour, dayofyear(ts) as day, count(*) as n
        from events group by all having count(*) filter (where event_type = 'error') > 0""",
    "all_hours_base": """
        select strftime(ts, '%Y-%m-%dT%H') as weather_hour, dayofyear(ts) as day, count(*) as n from events group by all""",
    "demand_weather_base": """
        select strftime(service_date, '%Y-%m-%d') || 'T' || lpad(cast(pickup_hour as varchar), 2, '0') as weather_hour,
               dayofyear(service_date) as day, count(*) as n
        from demand group by all""",
}
WEATHER_BODY = """
        select weather_hour,
               case when n % 11 <> 0 then cast(day % 17 - 3 as double) end as temperature_2m,
               (n % 7) / 10 as precipitation,
               cast(day % 3 as double) as snowfall,
               cast(n % 25 as double) as wind_speed_10m,
               cast(n % 50 + 40 as double) as relative_humidity_2m,
               case when n % 13 <> 0
                    then cast([0, 2, 3, 45, 61, 71, 80, 95, 100][n % 9 + 1] as double) end as weather_code
        from {}"""
CTES["weather"] = WEATHER_BODY.format("weather_base")
CTES["all_weather"] = WEATHER_BODY.format("all_hours_base")
CTES["demand_weather"] = """
        select * replace (coalesce(temperature_2m, 5.0) as temperature_2m, coalesce(weather_code, 3.0) as weather_code)
        from (""" + WEATHER_BODY.format("demand_weather_base") + ")"
CTES |= {
    "predictions": """
        select cast(event_id as varchar) as event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') as event_time,
               cast(user_id % 26 as varchar) as pickup_zone,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 26 as varchar) as dropoff_zone,
               cast(hour(ts) as integer) as pickup_hour, cast(dayofweek(ts) as integer) as pickup_dow,
               (event_id * 37 % 1000) / 10.0 as hotspot_score,
               case when event_id * 37 % 1000 >= 750 then 'very hot' when event_id * 37 % 1000 >= 500 then 'hot'
                    when event_id * 37 % 1000 >= 250 then 'medium' else 'low' end as hotspot_level
        from events""",
    "vehicles": """
        select printf('V-%03d', user_id % 40) as vehicle_id,
               case when event_type in ('view', 'click') then 'available' else 'occupied' end as status,
               cast(user_id % 26 as varchar) as pickup_zone,
               cast(cast(regexp_extract(props, '([0-9]+)', 1) as integer) % 26 as varchar) as dropoff_zone,
               40.6::double + cast(regexp_extract(props, '([0-9]+)', 1) as double) / 1000 as latitude,
               -74.1::double + cast(regexp_extract(props, '([0-9]+)', 1) as double) / 1000 as longitude,
               value as speed_kmh, cast(ts as varchar) as updated_at, cast(event_id as integer) as simulation_cycle
        from events""",
    "fleet": """
        select * exclude (r) from (
            select *, row_number() over (partition by vehicle_id order by updated_at desc, simulation_cycle desc) as r
            from vehicles) where r = 1""",
    "zone_means": """
        select pickup_zone, round(avg(hotspot_score), 9) as hotspot_score, count(*) as sample_count
        from predictions group by pickup_zone""",
}

# What a common table expression reads.
NEEDS = {
    "trips": ["raw"],
    "curated": ["trips", "zones"],
    "daily": ["demand"],
    "scores": ["daily"],
    "split": ["scores"],
    "train": ["scores", "split"],
    "test": ["scores", "split"],
    "baseline": ["train"],
    "weather": ["weather_base"],
    "all_weather": ["all_hours_base"],
    "demand_weather_base": ["demand"],
    "demand_weather": ["demand_weather_base"],
    "fleet": ["vehicles"],
    "zone_means": ["predictions"],
}


def sql(body: str, *names: str) -> str:
    """`body` after the common table expressions it names and those they need."""
    wanted, todo = set(), list(names)
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += NEEDS.get(name, [])
    ctes = ",\n".join(f"{name} as ({text}\n)" for name, text in CTES.items() if name in wanted)
    return f"with {ctes}\n{body.strip()}" if ctes else body.strip()


def query(name: str, oracle: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows if there is any."""

    def add(function):
        QUERIES[name] = function
        if oracle:
            ORACLES[name] = oracle
        return function

    return add


def level_sql(score: str, lang="en") -> str:
    labels = {"en": ("very hot", "hot", "medium", "low"), "vi": ("Rất nóng", "Nóng", "Trung bình", "Thấp")}[lang]
    return (
        f"case when {score} >= 75 then '{labels[0]}' when {score} >= 50 then '{labels[1]}' "
        f"when {score} >= 25 then '{labels[2]}' else '{labels[3]}' end"
    )


def label_sql(code: str, lang="vi") -> str:
    """Weather label of a code as a CASE expression."""
    cases = " ".join(f"when {key} then '{text}'" for key, text in WEATHER_CODE_LABELS[lang].items())
    return (
        f"case when {code} is null then '{WEATHER_NO_DATA[lang]}' "
        f"else case cast({code} as integer) {cases} else '{WEATHER_OTHER[lang]}' end end"
    )
