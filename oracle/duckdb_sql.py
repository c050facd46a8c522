"""Independent DuckDB definition of every registered query.

Written against the rules, not against the Spark code: dimensions come from window
functions, times from one anchored pattern, dense ids from a plain ``dense_rank``.
"""

from __future__ import annotations

# The test input, as defined in FIXTURES.md.
_RACES = """b AS (
  SELECT l.l_orderkey * 31 + l.l_linenumber * 17 + l.l_partkey * 7 AS k,
         l.l_partkey AS pk, CAST(year(l.l_shipdate) AS int) AS yr,
         CAST(CAST(l.l_shipdate AS date) AS string) AS d,
         p.p_name, p.p_brand, p.p_size, c.c_custkey AS ck, c.c_nationkey AS nk, c.c_mktsegment AS seg
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
), s AS (SELECT *, 14400 + k % 150000 AS sec, 5 + k % 200 AS t FROM b)
, races AS (SELECT yr AS year_of_event, d AS event_dates,
  CASE WHEN k % 97 = 0 THEN NULL ELSE concat(p_name, ' ', p_brand) END AS event_name,
  CASE WHEN k % 89 = 0 THEN NULL WHEN pk % 12 <= 4 THEN '50km' WHEN pk % 12 = 5 THEN '100km'
       WHEN pk % 12 = 6 THEN ' 80KM ' WHEN pk % 12 = 7 THEN '50mi' WHEN pk % 12 = 8 THEN '24h'
       WHEN pk % 12 = 9 THEN '6d' WHEN pk % 12 = 10 THEN '100' ELSE '20km,42km' END AS event_distance_length,
  p_size * 10 AS event_number_of_finishers,
  CASE WHEN k % 67 = 0 THEN NULL WHEN k % 61 = 0 THEN '1d 05:00:00 h' WHEN k % 59 = 0 THEN 'DNF'
       WHEN k % 53 = 0 THEN '0:00:00 h'
       WHEN pk % 12 = 8 THEN concat(CAST(30 + k % 200 AS string), CASE WHEN k % 2 = 0 THEN '.5 km' ELSE '.5' END)
       ELSE concat(CASE WHEN sec >= 86400 THEN '1 day, ' ELSE '' END,
            CAST(CAST(floor((sec % 86400) / 3600) AS int) AS string), ':',
            lpad(CAST(CAST(floor((sec % 3600) / 60) AS int) AS string), 2, '0'), ':',
            lpad(CAST(sec % 60 AS string), 2, '0'), CASE WHEN k % 2 = 0 THEN ' h' ELSE '' END) END AS athlete_performance,
  CASE WHEN ck % 5 = 0 THEN seg ELSE NULL END AS athlete_club,
  CASE WHEN nk % 5 = 0 THEN 'SWE' WHEN nk % 5 = 1 THEN ' fra ' WHEN nk % 5 = 2 THEN 'USA'
       WHEN nk = 3 THEN 'GBR' WHEN nk = 8 THEN 'GER' WHEN nk = 13 THEN 'ITA' WHEN nk = 18 THEN 'ESP' WHEN nk = 23 THEN 'POL'
       ELSE 'NOR' END AS athlete_country,
  CASE WHEN ck % 29 = 0 THEN NULL WHEN ck % 211 = 0 THEN CAST(1193 AS double) ELSE CAST(1930 + ck % 70 AS double) END AS athlete_year_of_birth,
  CASE WHEN ck % 10 <= 4 THEN 'M' WHEN ck % 10 <= 6 THEN 'F' WHEN ck % 10 = 7 THEN ' f ' WHEN ck % 10 = 8 THEN 'W'
       WHEN ck % 20 = 9 THEN 'X' ELSE NULL END AS athlete_gender,
  concat(CASE WHEN ck % 10 <= 4 THEN 'M' ELSE 'W' END, CAST(20 + 5 * (ck % 10) AS string)) AS athlete_age_category,
  CASE WHEN k % 71 = 0 THEN NULL WHEN k % 73 = 0 THEN '4:03:00' WHEN k % 79 = 0 THEN '99.9 km/h' WHEN k % 83 = 0 THEN '8.5km/h'
       WHEN k % 101 = 0 THEN 'n/a' WHEN k % 103 = 0 THEN '1.2.3'
       ELSE concat(CAST(CAST(floor(t / 10) AS int) AS string), '.', CAST(t % 10 AS string), ' km/h') END AS athlete_average_speed,
  CASE WHEN k % 107 = 0 THEN NULL ELSE ck END AS athlete_id
FROM s)"""

# Countries in scope.
_EUROPE = (
    "'SWE','NOR','FIN','DNK','DEU','FRA','ESP','ITA','GBR','BEL','NLD','POL','AUT','CHE','PRT','CZE',"
    "'HUN','ROU','GRC','HRV','SVK','SVN','SRB','BGR','EST','LVA','LTU','IRL','LUX','ISL','MKD','ALB'"
)


def _seconds(text: str) -> str:
    pattern = r"^(?:([+-]?[0-9]+) [^,:]*day[^,:]*,\s*)?([+-]?[0-9]+):([0-9]+):([0-9]+(?:\.[0-9]*)?)$"

    def part(i: int) -> str:
        return f"regexp_extract({text}, '{pattern}', {i})"

    return (
        f"CASE WHEN regexp_matches({text}, '{pattern}') THEN try_cast("
        f"coalesce(try_cast(nullif({part(1)}, '') AS bigint), 0) * 86400 + CAST({part(2)} AS bigint) * 3600"
        f" + CAST({part(3)} AS bigint) * 60 + CAST(trunc(CAST({part(4)} AS double)) AS bigint) AS integer) END"
    )


_BARE = r"trim(regexp_replace(athlete_performance, '\s*(h|km|mi)$', ''))"
_DIGITS = "try_cast(regexp_replace(athlete_average_speed, '[^0-9.]', '', 'g') AS float)"
_STORED_SPEED = "try_cast(split_part(athlete_average_speed, ' ', 1) AS float)"
_BORN = "CAST(trunc(athlete_year_of_birth) AS integer)"


def _ends(text: str, *unit_names: str) -> str:
    return "CASE " + " ".join(f"WHEN suffix({text}, '{u}') THEN '{u}'" for u in unit_names) + " END"


_TIDY_DISTANCE = r"lower(regexp_replace(event_distance_length, '^\s+|\s+$', '', 'g'))"
_KEPT_SILVER = f"""{_ends(_TIDY_DISTANCE, "km", "mi", "h")} = 'km'
  AND upper(trim(athlete_country)) IN ({_EUROPE}) AND contains(athlete_performance, ':')
  AND athlete_id IS NOT NULL AND NOT contains(athlete_average_speed, ':') AND {_DIGITS} BETWEEN 0.5 AND 35"""

_SILVER = f"""silver AS (SELECT * FROM (SELECT year_of_event, event_dates, event_name, event_distance_length,
  event_number_of_finishers, athlete_performance, athlete_club, upper(trim(athlete_country)) AS athlete_country,
  {_BORN} AS athlete_year_of_birth,
  CASE WHEN upper(trim(athlete_gender)) IN ('M','F','W') THEN upper(trim(athlete_gender)) END AS athlete_gender,
  athlete_age_category, {_STORED_SPEED} AS athlete_average_speed, athlete_id,
  {_seconds(_BARE)} AS performance_seconds,
  sha256(coalesce(event_name, '')) AS event_id, sha256(CAST(athlete_id AS varchar)) AS athlete_key,
  sha256(coalesce(CAST(year_of_event AS varchar), '')) AS year_id,
  year_of_event - {_BORN} AS athlete_age_at_event
  FROM races WHERE {_KEPT_SILVER}) WHERE performance_seconds > 0)"""

_FCT = """fct AS (SELECT sha256(concat_ws('||', CAST(athlete_id AS varchar), event_id, CAST(year_of_event AS varchar))) AS result_id,
  event_id, athlete_key, year_id, performance_seconds, athlete_average_speed, athlete_age_at_event FROM silver)"""


def _latest(name: str, key: str, attributes: list[str]) -> str:
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["year_of_event", *attributes])
    cols = ", ".join([key, *attributes])
    return (
        f"{name} AS (SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS nth"
        f" FROM silver) WHERE nth = 1)"
    )


_DIM_ATHLETE = _latest(
    "dim_athlete",
    "athlete_key",
    ["athlete_id", "athlete_country", "athlete_gender", "athlete_year_of_birth", "athlete_age_category"],
)
_DIM_EVENT = _latest(
    "dim_event",
    "event_id",
    ["event_name", "event_distance_length", "event_number_of_finishers", "event_dates"],
)
_DIM_TIME = "dim_time AS (SELECT DISTINCT year_id, year_of_event FROM silver)"


def _hours(seconds: str) -> str:
    # Exact half-up rounding of seconds / 3600 to two decimals.
    return f"floor(({seconds} * 100 + 1800) / 3600) / 100.0::double"


def _top_countries(fct: str) -> str:
    return f"""SELECT athlete_country, count(*) AS total_finishers,
  round(avg(athlete_average_speed), 2) AS avg_speed_kmh, round(avg(performance_seconds) / 3600.0, 2) AS avg_time_hours
  FROM {fct} LEFT JOIN dim_athlete USING (athlete_key) GROUP BY athlete_country"""


def _fastest(fct: str, k: int) -> str:
    return f"""SELECT athlete_id, athlete_country, athlete_gender, event_name, event_distance_length, performance_seconds,
  {_hours("performance_seconds")} AS performance_hours, athlete_average_speed::double AS athlete_average_speed
  FROM {fct} LEFT JOIN dim_athlete USING (athlete_key) LEFT JOIN dim_event USING (event_id)
  WHERE performance_seconds IS NOT NULL ORDER BY performance_seconds, athlete_id NULLS LAST, event_name NULLS LAST,
  result_id, athlete_average_speed NULLS LAST LIMIT {k}"""


_MART_COUNTRIES = f"mart_countries AS ({_top_countries('fct')})"
_MART_FASTEST = f"mart_fastest AS ({_fastest('fct', 1000)})"
_FCT_1998 = "fct_1998 AS (SELECT fct.* FROM fct JOIN dim_time USING (year_id) WHERE year_of_event = 1998)"

_UNITS = f"""with_units AS (SELECT *, ((event_unit IN ('km', 'mi') AND performance_unit = 'h')
   OR (coalesce(event_unit, '') = 'h' AND performance_unit = 'km')) IS TRUE AS is_valid_combo FROM (SELECT *,
  {_ends("event_distance_length", "km", "mi", "h", "d")} AS event_unit,
  CASE WHEN contains(athlete_performance, ':') THEN 'h' ELSE 'km' END AS performance_unit FROM races))"""


def _kept(low: float, high: float) -> str:
    return f"""event_unit <> 'd' AND is_valid_combo AND athlete_performance IS NOT NULL AND event_distance_length IS NOT NULL
  AND athlete_id IS NOT NULL AND NOT contains(athlete_average_speed, ':') AND {_DIGITS} BETWEEN {low} AND {high}"""


def _variant(name: str, low: float, high: float, seconds: str, km: str) -> str:
    return f"""{name} AS (SELECT year_of_event, event_dates, event_name, event_distance_length, event_number_of_finishers,
  athlete_performance, athlete_club, upper(trim(athlete_country)) AS athlete_country, {_BORN} AS athlete_year_of_birth,
  upper(trim(athlete_gender)) AS athlete_gender, athlete_age_category, {_STORED_SPEED}::double AS athlete_average_speed,
  athlete_id, CASE WHEN performance_unit = 'h' THEN {seconds} END AS performance_seconds,
  CASE WHEN performance_unit = 'km' THEN {km}::double END AS performance_km,
  CAST(dense_rank() OVER (ORDER BY event_name NULLS FIRST) AS integer) AS event_id,
  CAST(dense_rank() OVER (ORDER BY athlete_id NULLS FIRST) AS integer) AS athlete_key,
  CAST(dense_rank() OVER (ORDER BY year_of_event NULLS FIRST) AS integer) AS year_id,
  year_of_event - {_BORN} AS athlete_age_at_event, performance_unit
  FROM with_units WHERE {_kept(low, high)})"""


_V1 = _variant(
    "v1", 1, 30, _seconds("trim(athlete_performance)"), "try_cast(split_part(athlete_performance, ' ', 1) AS float)"
)
_V2 = _variant("v2", 0.5, 35, _seconds(f"split_part({_BARE}, ' ', 1)"), f"try_cast({_BARE} AS float)")
_CLEAN = f"""clean AS (SELECT * FROM with_units WHERE {_kept(1, 30)})"""
_SPEEDS = f"""speeds AS (SELECT athlete_average_speed, event_distance_length, {_DIGITS}::double AS speed_float
  FROM clean WHERE {_DIGITS} IS NOT NULL)"""

_PARTS = {
    "races": ([], _RACES),
    "silver": (["races"], _SILVER),
    "fct": (["silver"], _FCT),
    "dim_athlete": (["silver"], _DIM_ATHLETE),
    "dim_event": (["silver"], _DIM_EVENT),
    "dim_time": (["silver"], _DIM_TIME),
    "mart_countries": (["fct", "dim_athlete"], _MART_COUNTRIES),
    "mart_fastest": (["fct", "dim_athlete", "dim_event"], _MART_FASTEST),
    "fct_1998": (["fct", "dim_time"], _FCT_1998),
    "with_units": (["races"], _UNITS),
    "v1": (["with_units"], _V1),
    "v2": (["with_units"], _V2),
    "clean": (["with_units"], _CLEAN),
    "speeds": (["clean"], _SPEEDS),
}


def _query(select: str, *uses: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        for below in _PARTS[name][0]:
            add(below)
        if name not in needed:
            needed.append(name)

    for name in uses:
        add(name)
    return "WITH " + ",\n".join(_PARTS[name][1] for name in needed) + "\n" + select


_BRONZE_COLUMNS = (
    "year_of_event event_dates event_name event_distance_length event_number_of_finishers athlete_performance "
    "athlete_club athlete_country athlete_year_of_birth athlete_gender athlete_age_category athlete_average_speed "
    "athlete_id"
).split()
_NUMERIC = {"year_of_event", "event_number_of_finishers", "athlete_year_of_birth", "athlete_id"}
_V_COLUMNS = [
    *_BRONZE_COLUMNS, "performance_seconds", "performance_km", "event_id", "athlete_key", "year_id", "athlete_age_at_event",
]


def _each(columns: list[str], template: str) -> str:
    return " UNION ALL ".join(template.replace("@", c) for c in columns)


def _described(column: str) -> str:
    # Spark also reads a number with a trailing type letter, such as 6d.
    number = f"try_cast(regexp_replace(CAST({column} AS varchar), '[dDfF]$', '') AS double)"
    return f"""SELECT '{column}' AS "column", count({column}) AS count, avg({number}) AS mean,
  stddev_samp({number}) AS stddev, CAST(min({column}) AS varchar) AS min,
  CAST(max({column}) AS varchar) AS max FROM races"""


def _ranked(value: str, rank: str) -> str:
    return f"SELECT DISTINCT {value}, {rank} FROM v1"


def _dims_of(fct: str) -> dict[str, str]:
    """Dashboard datasets over a fact, whole or of one year."""
    return {
        "kpi": f"""SELECT count(DISTINCT event_id) AS unique_races, count(*) AS total_results,
  count(DISTINCT athlete_country) AS countries, round(avg(athlete_average_speed), 2) AS avg_speed_kmh
  FROM {fct} LEFT JOIN dim_athlete USING (athlete_key)""",
        "countries": f"""SELECT athlete_country, total_finishers, avg_speed_kmh FROM ({_top_countries(fct)})
  ORDER BY total_finishers DESC, athlete_country LIMIT 15""",
        "gender": f"""SELECT athlete_gender, count(*) AS number_of_results FROM {fct} JOIN dim_athlete USING (athlete_key)
  WHERE athlete_gender IS NOT NULL GROUP BY athlete_gender""",
        "distance": f"""SELECT event_distance_length, round(avg(athlete_average_speed), 2) AS avg_speed_kmh
  FROM {fct} JOIN dim_event USING (event_id) GROUP BY event_distance_length""",
        "fastest": f"""SELECT athlete_id, athlete_country, athlete_gender, event_name, athlete_average_speed,
  performance_seconds, performance_hours FROM ({_fastest(fct, 10)})""",
    }


_ALL, _YEAR = _dims_of("fct"), _dims_of("fct_1998")
_PARTICIPATION = "SELECT year_of_event, count(*) AS total_results FROM fct JOIN dim_time USING (year_id) {} GROUP BY year_of_event"
_COUNT = "SELECT {0}, count(*) AS results FROM {1} GROUP BY {0}"

_GOLD_COLUMNS = {
    "dim_athlete": (
        "dim_athlete",
        "athlete_key string, athlete_id bigint, athlete_country string, athlete_gender string, "
        "athlete_year_of_birth int, athlete_age_category string",
    ),
    "dim_event": (
        "dim_event",
        "event_id string, event_name string, event_distance_length string, event_number_of_finishers int, event_dates string",
    ),
    "dim_time": ("dim_time", "year_id string, year_of_event int"),
    "fct_results": (
        "fct",
        "result_id string, event_id string, athlete_key string, year_id string, performance_seconds int, "
        "athlete_average_speed float, athlete_age_at_event int",
    ),
    "mart_fastest_athletes": (
        "mart_fastest",
        "athlete_id bigint, athlete_country string, athlete_gender string, event_name string, "
        "event_distance_length string, performance_seconds int, performance_hours decimal(14;2), athlete_average_speed float",
    ),
    "mart_top_countries": (
        "mart_countries",
        "athlete_country string, total_finishers bigint, avg_speed_kmh double, avg_time_hours double",
    ),
}


def _gold_schema() -> str:
    rows = []
    for table, (cte, columns) in _GOLD_COLUMNS.items():
        for position, column in enumerate(columns.split(", "), start=1):
            name, kind = column.split(" ")
            kind = kind.replace(";", ",")
            rows.append(
                f"SELECT '{table}' AS table_name, {position} AS position, '{name}' AS column_name,"
                f" '{kind}' AS data_type, count({name}) AS \"values\" FROM {cte}"
            )
    return " UNION ALL ".join(rows)


_LAYER_COLUMNS = {
    ("bronze", "races", "races"): "year_of_event int, event_dates string, event_name string, event_distance_length string, "
    "event_number_of_finishers int, athlete_performance string, athlete_club string, athlete_country string, "
    "athlete_year_of_birth double, athlete_gender string, athlete_age_category string, athlete_average_speed string, athlete_id bigint",
    ("silver", "obt", "silver"): "year_of_event int, event_dates string, event_name string, event_distance_length string, "
    "event_number_of_finishers int, athlete_performance string, athlete_club string, athlete_country string, "
    "athlete_year_of_birth int, athlete_gender string, athlete_age_category string, athlete_average_speed float, athlete_id bigint, "
    "performance_seconds int, event_id string, athlete_key string, year_id string, athlete_age_at_event int",
}


def _layer_schema() -> str:
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{table}' AS table_name, {position} AS position, '{column.split(' ')[0]}' AS column_name,"
        f" '{column.split(' ')[1]}' AS data_type, count({column.split(' ')[0]}) AS \"values\" FROM {cte}"
        for (layer, table, cte), columns in _LAYER_COLUMNS.items()
        for position, column in enumerate(columns.split(", "), start=1)
    )


def _distance_stats(rows: str) -> str:
    return f"""SELECT event_distance_length, min(performance_seconds) AS fastest_seconds,
  {_hours("min(performance_seconds)")} AS fastest_hours, round(avg(athlete_average_speed), 2) AS avg_speed_kmh,
  count(*) AS results FROM {rows} WHERE event_distance_length IN ('50km', '100km', '50mi', '100mi') GROUP BY 1"""


def _zero_time_stats(rows: str) -> str:
    return f"""SELECT event_distance_length, count(*) AS results, count(*) FILTER (performance_seconds = 0) AS zero_times,
  min(performance_seconds) FILTER (performance_seconds > 0) AS fastest_seconds,
  {_hours("min(CASE WHEN performance_seconds > 0 THEN performance_seconds END)")} AS fastest_hours
  FROM {rows} WHERE event_distance_length IN ('50km', '100km', '50mi', '100mi') GROUP BY 1"""


_REVIEWED = (
    "event_id", "event_name", "event_distance_length", "athlete_key", "athlete_id", "athlete_performance",
    "performance_seconds", "performance_km", "athlete_gender", "athlete_country", "year_of_event",
)

_STAR = ("fct", "dim_athlete", "dim_event", "dim_time")
_SILVER_OUT = "SELECT * REPLACE (athlete_average_speed::double AS athlete_average_speed) FROM silver"
_LATER_STAGE = """CASE WHEN regexp_matches(trim(athlete_performance),
  '^(?:[+-]?(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?|[+-]?(?i:inf|infinity|nan))$') THEN 'km' END"""

ORACLE: dict[str, str] = {
    "bronze_races": _query("SELECT * FROM races", "races"),
    "bronze_races_csv": _query("SELECT * FROM races", "races"),
    "silver_obt": _query(_SILVER_OUT, "silver"),
    "csv_line_counts": _query(
        f"""SELECT count(*) AS lines, count(*) FILTER (athlete_id % 101 = 0) AS rejected,
  {" + ".join(f"count({c})" for c in _BRONZE_COLUMNS)} - count(*) FILTER (athlete_id % 101 = 0) AS values_read FROM races""",
        "races",
    ),
    "silver_stream": _query(_SILVER_OUT, "silver"),
    "dim_athlete": _query("SELECT * FROM dim_athlete", "dim_athlete"),
    "dim_event": _query("SELECT * FROM dim_event", "dim_event"),
    "dim_time": _query("SELECT * FROM dim_time", "dim_time"),
    "fct_results": _query("SELECT * REPLACE (athlete_average_speed::double AS athlete_average_speed) FROM fct", "fct"),
    "star_wide": _query(
        """SELECT fct.* REPLACE (athlete_average_speed::double AS athlete_average_speed), dim_time.year_of_event,
  dim_event.* EXCLUDE (event_id), dim_athlete.* EXCLUDE (athlete_key) FROM fct LEFT JOIN dim_time USING (year_id)
  LEFT JOIN dim_event USING (event_id) LEFT JOIN dim_athlete USING (athlete_key)""",
        *_STAR,
    ),
    "mart_top_countries": _query("SELECT * FROM mart_countries", "mart_countries"),
    "mart_fastest_athletes": _query("SELECT * FROM mart_fastest", "mart_fastest"),
    "genie_top_country": _query(
        "SELECT athlete_country, total_finishers FROM mart_countries ORDER BY total_finishers DESC, athlete_country LIMIT 1",
        "mart_countries",
    ),
    "genie_participation": _query(_PARTICIPATION.format(""), *_STAR),
    "genie_gender": _query(_ALL["gender"], *_STAR),
    "genie_fastest": _query(
        """SELECT athlete_country, athlete_gender, event_name, athlete_average_speed FROM mart_fastest
  ORDER BY athlete_average_speed DESC NULLS LAST, performance_seconds, athlete_id, event_name NULLS LAST LIMIT 10""",
        "mart_fastest",
    ),
    "genie_speed_by_distance": _query(_ALL["distance"], *_STAR),
    "genie_top_speed_countries": _query(
        "SELECT athlete_country, avg_speed_kmh FROM mart_countries ORDER BY avg_speed_kmh DESC NULLS LAST, athlete_country LIMIT 10",
        "mart_countries",
    ),
    "dash_kpi_overview": _query(_ALL["kpi"], *_STAR),
    "dash_top_countries": _query(_ALL["countries"], *_STAR),
    "dash_gender_distribution": _query(_ALL["gender"], *_STAR),
    "dash_participation_trend": _query(_PARTICIPATION.format("WHERE year_of_event BETWEEN 1996 AND 2023"), *_STAR),
    "dash_speed_by_distance": _query(_ALL["distance"], *_STAR),
    "dash_top10_fastest": _query(_ALL["fastest"], *_STAR),
    "kpi_by_year": _query(
        """SELECT year_of_event, count(DISTINCT event_id) AS unique_races, count(*) AS total_results,
  count(DISTINCT athlete_country) AS countries, round(avg(athlete_average_speed), 2) AS avg_speed_kmh
  FROM fct JOIN dim_time USING (year_id) LEFT JOIN dim_athlete USING (athlete_key) GROUP BY year_of_event""",
        *_STAR,
    ),
    "kpi_year_filter": _query(_YEAR["kpi"], "fct_1998", *_STAR),
    "top_countries_year_filter": _query(_YEAR["countries"], "fct_1998", *_STAR),
    "gender_year_filter": _query(_YEAR["gender"], "fct_1998", *_STAR),
    "speed_by_distance_year_filter": _query(_YEAR["distance"], "fct_1998", *_STAR),
    "top10_fastest_year_filter": _query(_YEAR["fastest"], "fct_1998", *_STAR),
    "describe_numeric": _query(
        "SELECT \"column\", count, round(mean, 4) AS mean, round(stddev, 4) AS stddev, min, max FROM ("
        + " UNION ALL ".join(_described(c) for c in _BRONZE_COLUMNS)
        + ")",
        "races",
    ),
    "null_counts_wide": _query(
        "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _BRONZE_COLUMNS) + " FROM races", "races"
    ),
    "null_or_blank_pct": _query(
        _each(
            _BRONZE_COLUMNS,
            """SELECT '@' AS "column", count(*) FILTER (@ IS NULL OR CAST(@ AS varchar) = '') AS nulls,
  round(count(*) FILTER (@ IS NULL OR CAST(@ AS varchar) = '') * 100.0::double / count(*), 1) AS pct FROM races""",
        ),
        "races",
    ),
    "null_summary": _query(
        _each(
            _BRONZE_COLUMNS,
            """SELECT '@' AS "column", count(*) - count(@) AS null_count,
  round((count(*) - count(@)) * 100.0::double / count(*), 2) AS null_pct FROM races""",
        ),
        "races",
    ),
    "value_counts_country": _query(
        """SELECT athlete_country, count(*) AS count FROM races GROUP BY athlete_country
  ORDER BY 2 DESC, 1 NULLS FIRST LIMIT 20""",
        "races",
    ),
    "country_counts": _query(_COUNT.format("athlete_country", "races"), "races"),
    "distance_counts": _query(_COUNT.format("event_distance_length", "races"), "races"),
    "unique_counts": _query(
        """SELECT 'bronze' AS layer, 'event_name' AS "column", count(*) AS unique_values FROM (SELECT DISTINCT event_name FROM races)
  UNION ALL SELECT 'explore_v1', 'event_name', count(*) FROM (SELECT DISTINCT event_id FROM v1)
  UNION ALL SELECT 'explore_v1', 'athlete_id', count(*) FROM (SELECT DISTINCT athlete_key FROM v1)
  UNION ALL SELECT 'explore_v1', 'year_of_event', count(*) FROM (SELECT DISTINCT year_id FROM v1)""",
        "v1",
    ),
    "age_distribution_bronze": _query(
        "SELECT 2025 - athlete_year_of_birth AS age, count(*) AS results FROM races GROUP BY 1", "races"
    ),
    "distinct_birth_years": _query("SELECT DISTINCT athlete_year_of_birth FROM races", "races"),
    "distance_suffix_counts": _query(
        "SELECT regexp_extract(event_distance_length, '[a-z]+$') AS suffix, count(*) AS results FROM races GROUP BY 1", "races"
    ),
    "event_unit_counts": _query(
        "SELECT coalesce(event_unit, 'SKRÄP') AS event_unit, count(*) AS results FROM with_units GROUP BY 1", "with_units"
    ),
    "event_unit_counts_normalised": _query(
        f"SELECT {_ends(_TIDY_DISTANCE, 'km', 'mi', 'h', 'd')} AS event_unit, count(*) AS results FROM races GROUP BY 1", "races"
    ),
    "performance_unit_counts": _query(
        f"""SELECT CASE WHEN contains(athlete_performance, ':') THEN 'h' ELSE {_LATER_STAGE} END AS performance_unit,
  count(*) AS results FROM races GROUP BY 1""",
        "races",
    ),
    "performance_format_counts": _query(
        r"""SELECT CASE WHEN contains(athlete_performance, ':') THEN 'HH:MM:SS'
  WHEN regexp_matches(athlete_performance, '^\d+\.\d+') THEN 'decimal' ELSE 'övrigt' END AS format,
  count(*) AS results FROM races GROUP BY 1""",
        "races",
    ),
    "performance_seconds_parsed": _query(
        f"""SELECT athlete_performance, {_seconds(_BARE)} AS seconds,
  {_seconds("trim(athlete_performance)")} AS seconds_with_unit,
  {_seconds(f"split_part({_BARE}, ' ', 1)")} AS seconds_first_word, results
  FROM (SELECT athlete_performance, count(*) AS results FROM races GROUP BY 1)""",
        "races",
    ),
    "unit_combo_profile": _query(
        _COUNT.format("event_unit, performance_unit, is_valid_combo", "with_units"), "with_units"
    ),
    "invalid_combo_count": _query("SELECT count(*) FILTER (NOT is_valid_combo) AS invalid_rows FROM with_units", "with_units"),
    "speed_quartiles": _query(
        f"""SELECT min(x) AS min_speed, quantile_disc(x, 0.25) AS q1_speed, quantile_disc(x, 0.75) AS q3_speed,
  max(x) AS max_speed FROM (SELECT {_DIGITS}::double AS x FROM races)""",
        "races",
    ),
    "cleaning_report": _query(
        """SELECT cleaning, rows_before, rows_after, rows_before - rows_after AS rows_removed,
  round((rows_before - rows_after) * 100.0::double / rows_before, 2) AS removed_pct
  FROM (SELECT 'silver' AS cleaning, count(*) AS rows_after FROM silver UNION ALL SELECT 'explore_v1', count(*) FROM v1
  UNION ALL SELECT 'explore_v2', count(*) FROM v2), (SELECT count(*) AS rows_before FROM races)""",
        "silver",
        "v1",
        "v2",
    ),
    "explore_clean": _query("SELECT * FROM clean", "clean"),
    "explore_silver_v1": _query(f"SELECT {', '.join(_V_COLUMNS)} FROM v1", "v1"),
    "explore_silver_v2": _query(f"SELECT {', '.join(_V_COLUMNS)} FROM v2", "v2"),
    "dense_ids_event": _query(_ranked("event_name", "event_id"), "v1"),
    "dense_ids_athlete": _query(_ranked("athlete_id", "athlete_key"), "v1"),
    "dense_ids_year": _query(_ranked("year_of_event", "year_id"), "v1"),
    "dense_ids_event_first10": _query(_ranked("event_name", "event_id") + " ORDER BY event_id LIMIT 10", "v1"),
    "dense_ids_athlete_first10": _query(_ranked("athlete_id", "athlete_key") + " ORDER BY athlete_key LIMIT 10", "v1"),
    "performance_sample": _query(
        """SELECT athlete_performance, performance_unit, performance_seconds, performance_km FROM v1
  ORDER BY athlete_performance, performance_unit LIMIT 20""",
        "v1",
    ),
    "conversion_failures": _query(
        _each(
            ["v1", "v2"],
            """SELECT '@' AS variant, count(*) FILTER (performance_unit = 'h' AND performance_seconds IS NULL) AS failed_times,
  count(*) FILTER (performance_seconds IS NULL AND performance_km IS NULL) AS no_measure FROM @""",
        ),
        "v1",
        "v2",
    ),
    "speed_top20": _query(
        "SELECT * FROM speeds ORDER BY speed_float DESC, athlete_average_speed, event_distance_length LIMIT 20", "speeds"
    ),
    "speed_stats": _query(
        """SELECT 'v1' AS variant, min(speed_float) AS min_speed, max(speed_float) AS max_speed,
  round(avg(speed_float), 6) AS avg_speed FROM speeds UNION ALL SELECT 'v2', min(athlete_average_speed),
  max(athlete_average_speed), round(avg(athlete_average_speed), 6) FROM v2""",
        "speeds",
        "v2",
    ),
    "speed_p99": _query("SELECT quantile_disc(speed_float, 0.99) AS p99_speed FROM speeds", "speeds"),
    "null_counts_silver": _query(
        "SELECT " + ", ".join(f"count(*) - count({c}) AS {c}" for c in _V_COLUMNS) + " FROM v2", "v2"
    ),
    "age_distribution": _query(_COUNT.format("athlete_age_at_event", "v2"), "v2"),
    "marathon_type_counts": _query(
        """SELECT CASE WHEN performance_seconds IS NOT NULL THEN 'time_based' ELSE 'distance_based' END AS marathon_type,
  count(*) AS results FROM v2 GROUP BY 1""",
        "v2",
    ),
    "hour_event_profile": _query(
        """SELECT event_distance_length, performance_km, performance_seconds, count(*) AS results FROM v2
  WHERE event_distance_length LIKE '%h' GROUP BY 1, 2, 3
  ORDER BY 4 DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 20""",
        "v2",
    ),
    "hour_performance_profile": _query(
        """SELECT event_distance_length, athlete_performance, athlete_average_speed, count(*) AS results FROM v2
  WHERE event_distance_length LIKE '%h' GROUP BY 1, 2, 3
  ORDER BY 4 DESC, 1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST LIMIT 20""",
        "v2",
    ),
    "hour_distance_counts_top20": _query(
        """SELECT event_distance_length, count(*) AS results FROM v2 WHERE performance_km IS NOT NULL GROUP BY 1
  ORDER BY 2 DESC, 1 LIMIT 20""",
        "v2",
    ),
    "distance_stats": _query(_distance_stats("v2"), "v2"),
    "distance_stats_silver": _query(_distance_stats("silver"), "silver"),
    "zero_time_stats": _query(_zero_time_stats("v2"), "v2"),
    "zero_time_stats_silver": _query(_zero_time_stats("silver"), "silver"),
    "explore_review_sample": _query(
        f"SELECT {', '.join(_REVIEWED)} FROM v1 ORDER BY {', '.join(f'{c} NULLS FIRST' for c in _REVIEWED)} LIMIT 20", "v1"
    ),
    "distance_counts_top20": _query(
        "SELECT event_distance_length, count(*) AS results FROM silver GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20", "silver"
    ),
    "distinct_distances": _query("SELECT DISTINCT event_distance_length FROM silver", "silver"),
    "distinct_distances_top50": _query("SELECT DISTINCT event_distance_length FROM silver ORDER BY 1 LIMIT 50", "silver"),
    "distinct_countries_silver": _query("SELECT DISTINCT athlete_country FROM silver", "silver"),
    "distinct_countries_gold": _query("SELECT DISTINCT athlete_country FROM dim_athlete", "dim_athlete"),
    "odd_distances": _query(
        """SELECT DISTINCT event_distance_length FROM dim_event WHERE event_distance_length NOT LIKE '%km'
  OR event_distance_length LIKE '%,%' OR event_distance_length LIKE '%/%'""",
        "dim_event",
    ),
    "performance_hms": _query(
        """SELECT result_id, performance_seconds, concat(lpad(CAST(performance_seconds // 3600 AS varchar),
  CAST(greatest(2, length(CAST(performance_seconds // 3600 AS varchar))) AS integer), '0'), ':',
  lpad(CAST(performance_seconds % 3600 // 60 AS varchar), 2, '0'), ':',
  lpad(CAST(performance_seconds % 60 AS varchar), 2, '0')) AS performance_hms FROM fct""",
        "fct",
    ),
    "surrogate_keys": _query(
        """SELECT DISTINCT 'event_id' AS key_column, event_name AS source_value, event_id AS key_value FROM silver
  UNION SELECT DISTINCT 'athlete_key', CAST(athlete_id AS varchar), athlete_key FROM silver
  UNION SELECT DISTINCT 'year_id', CAST(year_of_event AS varchar), year_id FROM silver""",
        "silver",
    ),
    "layer_row_counts": _query(
        """SELECT 'bronze' AS layer, count(*) AS rows FROM races UNION ALL SELECT 'silver', count(*) FROM silver
  UNION ALL SELECT 'gold', count(*) FROM fct""",
        "fct",
    ),
    "gold_table_inventory": _query(
        _each(list(_GOLD_COLUMNS), "SELECT '@' AS table_name, count(*) AS rows FROM @")
        .replace("FROM fct_results", "FROM fct")
        .replace("FROM mart_fastest_athletes", "FROM mart_fastest")
        .replace("FROM mart_top_countries", "FROM mart_countries"),
        *_STAR,
        "mart_countries",
        "mart_fastest",
    ),
    "tables_after_drop": _query("SELECT 'dim_event' AS table_name, count(*) AS rows FROM dim_event", "dim_event"),
    "layer_schema_inventory": _query(_layer_schema(), "races", "silver"),
    "gold_schema_inventory": _query(_gold_schema(), *_STAR, "mart_countries", "mart_fastest"),
    "dq_pk_duplicates": _query(
        """SELECT 'fct_results' AS table_name, result_id AS key_value, count(*) AS occurrences FROM fct GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'dim_athlete', athlete_key, count(*) FROM dim_athlete GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'dim_event', event_id, count(*) FROM dim_event GROUP BY 2 HAVING count(*) > 1
  UNION ALL SELECT 'dim_time', year_id, count(*) FROM dim_time GROUP BY 2 HAVING count(*) > 1""",
        *_STAR,
    ),
    "dq_fk_orphans": _query(
        """SELECT 'dim_athlete' AS dimension, count(DISTINCT athlete_key) AS orphan_keys, count(*) AS orphan_results
  FROM fct WHERE athlete_key NOT IN (SELECT athlete_key FROM dim_athlete)
  UNION ALL SELECT 'dim_event', count(DISTINCT event_id), count(*) FROM fct WHERE event_id NOT IN (SELECT event_id FROM dim_event)
  UNION ALL SELECT 'dim_time', count(DISTINCT year_id), count(*) FROM fct WHERE year_id NOT IN (SELECT year_id FROM dim_time)""",
        *_STAR,
    ),
    "dq_result_id_collisions": _query(
        """SELECT athlete_id, event_name, year_of_event, count(*) AS results,
  count(DISTINCT event_distance_length) AS distances FROM silver GROUP BY 1, 2, 3 HAVING count(*) > 1""",
        "silver",
    ),
    "dq_birth_year": _query(
        """SELECT count(*) AS rows, count(*) - count(athlete_year_of_birth) AS missing,
  count(*) FILTER (athlete_year_of_birth < 1900) AS too_early,
  count(*) FILTER (athlete_year_of_birth > year_of_event) AS after_event,
  min(athlete_year_of_birth) AS earliest_year, max(athlete_year_of_birth) AS latest_year FROM races""",
        "races",
    ),
}

ORACLE["mart_top_countries_streamed"] = ORACLE["mart_top_countries"]

for _name, _rows in (("race_type_counts", "silver"), ("race_type_counts_explore", "v2")):
    ORACLE[_name] = _query(
        f"""SELECT CASE WHEN event_distance_length LIKE '%mi' THEN 'miles' WHEN event_distance_length LIKE '%km'
  THEN 'kilometers' ELSE 'other' END AS race_type, count(*) AS results FROM {_rows} GROUP BY 1""",
        _rows,
    )
ORACLE |= {
    "mart_top_countries_incremental": ORACLE["mart_top_countries"],
    "mart_fastest_athletes_incremental": ORACLE["mart_fastest_athletes"],
    "dim_athlete_incremental": ORACLE["dim_athlete"],
    "dim_event_incremental": ORACLE["dim_event"],
    "kpi_overview_incremental": ORACLE["dash_kpi_overview"],
    "kpi_by_year_incremental": ORACLE["kpi_by_year"],
    "gender_incremental": ORACLE["dash_gender_distribution"],
    "speed_by_distance_incremental": ORACLE["dash_speed_by_distance"],
}

# Questions about ranges of years, and audits.
_KPI_OF = """count(DISTINCT event_id) AS unique_races, count(DISTINCT athlete_key) AS unique_athletes,
  count(DISTINCT athlete_country) AS countries, count(*) AS total_results, round(avg(athlete_average_speed::double), 2) AS avg_speed_kmh"""
_WITH_YEARS = "fct JOIN dim_time USING (year_id) JOIN dim_athlete USING (athlete_key)"
ORACLE["kpi_year_range"] = _query(f"SELECT {_KPI_OF} FROM {_WITH_YEARS} WHERE year_of_event BETWEEN 1993 AND 1996", *_STAR)
ORACLE["kpi_up_to_each_year"] = _query(
    f"SELECT y.year_of_event AS up_to, {_KPI_OF} FROM dim_time y JOIN ({_WITH_YEARS}) r ON r.year_of_event <= y.year_of_event GROUP BY 1", *_STAR
)
ORACLE["speed_sketches_by_year"] = _query(
    """SELECT year_of_event, quantile, count(athlete_average_speed) AS speeds, true AS within_error
FROM fct JOIN dim_time USING (year_id) CROSS JOIN (VALUES ('p25'), ('p50'), ('p75'), ('p99')) q(quantile) GROUP BY ALL""",
    *_STAR,
)


def _found(table: str, rows: str, rule: str, column: str, broken: str, must_hold: bool = True) -> str:
    """One finding; ``broken`` selects the rows (n) of each key that breaks the rule."""
    return f"""SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, (SELECT count(*) FROM {rows}) AS checked_rows,
  (SELECT count(*) FROM ({broken})) AS broken_keys, (SELECT coalesce(sum(n), 0)::bigint FROM ({broken})) AS broken_rows,
  {must_hold} AS must_hold, ((SELECT count(*) FROM ({broken})) = 0 OR NOT {must_hold}) AS passed"""


def _missing(rows: str, column: str) -> str:
    return f"SELECT count(*) AS n FROM {rows} WHERE {column} IS NULL HAVING count(*) > 0"


def _repeated(rows: str, column: str) -> str:
    return f"SELECT count(*) AS n FROM {rows} GROUP BY {column} HAVING count(*) > 1"


def _dangling(dimension: str, column: str) -> str:
    return f"SELECT count(*) AS n FROM fct WHERE {column} NOT IN (SELECT {column} FROM {dimension}) GROUP BY {column}"


_DIMENSIONS = {"dim_athlete": "athlete_key", "dim_event": "event_id", "dim_time": "year_id"}
ORACLE["audit_gold"] = _query(
    "\nUNION ALL ".join(
        [_found(d, d, "required", c, _missing(d, c)) for d, c in _DIMENSIONS.items()]
        + [_found(d, d, "unique", c, _repeated(d, c)) for d, c in _DIMENSIONS.items()]
        + [_found("fct_results", "fct", "required", c, _missing("fct", c)) for c in ("result_id", *_DIMENSIONS.values())]
        + [_found("fct_results", "fct", "unique", "result_id", _repeated("fct", "result_id"), False)]
        + [_found("fct_results", "fct", "reference", c, _dangling(d, c)) for d, c in _DIMENSIONS.items()]
    ),
    *_STAR,
)
ORACLE["audit_rejected_keys"] = _query(
    """SELECT 'required' AS rule, 'event_id' AS column_name, NULL::varchar AS key_value, count(*) AS rows
FROM fct WHERE performance_seconds % 97 = 0
UNION ALL SELECT 'unique', 'result_id', result_id, count(*) FROM fct GROUP BY result_id HAVING count(*) > 1
UNION ALL SELECT 'reference', 'athlete_key', athlete_key, count(*) FROM fct JOIN dim_athlete USING (athlete_key)
WHERE athlete_id % 50 = 0 GROUP BY athlete_key""",
    *_STAR,
)
ORACLE["star_wide_bucketed"] = ORACLE["star_wide"]
ORACLE["csv_files_set_aside"] = _query(
    """SELECT 'read' AS reason, '' AS column_name, count(*) AS rows FROM races WHERE year_of_event < 1994
UNION ALL VALUES ('missing', 'Athlete club', NULL), ('unknown', 'Club', NULL), ('missing', 'Athlete gender', NULL)""",
    "races",
)
