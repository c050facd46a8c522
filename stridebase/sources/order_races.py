"""Race results derived from the order tables: one result per lineitem.

The expressions are the fixed definition of the test input (see FIXTURES.md). Orders
are joined to customers before lineitem, so the wide customer columns meet the largest
table in one shuffle instead of two.
"""

from pyspark.sql import DataFrame, SparkSession

from stridebase.sources import files

TABLES = ("lineitem", "orders", "customer", "part")

RACES_SQL = """
WITH buyer AS (
  SELECT o.o_orderkey, c.c_custkey AS ck, c.c_nationkey AS nk, c.c_mktsegment AS seg
  FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
), b AS (
  SELECT l.l_orderkey * 31 + l.l_linenumber * 17 + l.l_partkey * 7 AS k,
         l.l_partkey AS pk, CAST(year(l.l_shipdate) AS int) AS yr,
         CAST(CAST(l.l_shipdate AS date) AS string) AS d,
         p.p_name, p.p_brand, p.p_size, buyer.ck, buyer.nk, buyer.seg
  FROM {lineitem} l
  JOIN buyer ON l.l_orderkey = buyer.o_orderkey
  JOIN {part} p ON l.l_partkey = p.p_partkey
), s AS (SELECT *, 14400 + k % 150000 AS sec, 5 + k % 200 AS t FROM b)
SELECT yr AS year_of_event, d AS event_dates,
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
FROM s
"""


def races_from_orders(spark: SparkSession, directory: str) -> DataFrame:
    tables = {
        name: spark.read.parquet(f"{directory}/{name}.parquet")
        for name in TABLES
    }
    return spark.sql(RACES_SQL, **tables)


def orders_state(spark: SparkSession, directory: str) -> tuple[tuple[int, ...], ...]:
    """Changes when one of the tables that :func:`races_from_orders` reads is replaced."""
    return tuple(files.state(spark, f"{directory}/{name}.parquet") for name in TABLES)
