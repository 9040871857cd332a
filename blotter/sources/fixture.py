"""The ``incidents`` view: the 28-column source record derived from the driver
tables (orders, customer, nation). The same SQL text runs in Spark and DuckDB,
so the DuckDB oracle can rebuild the exact input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


INCIDENTS_SQL = """SELECT
  CASE WHEN o_orderkey % 997 = 5 THEN NULL ELSE o_orderkey END AS dr_no,
  CASE WHEN o_orderkey % 89 = 7 THEN NULL ELSE o_orderdate + INTERVAL '25' YEAR + (CAST(o_orderkey % 31 AS INT) - 1) * INTERVAL '1' DAY END AS date_rptd,
  CASE WHEN o_orderkey % 499 = 8 THEN NULL ELSE o_orderdate + INTERVAL '25' YEAR END AS date_occ,
  CAST(CASE WHEN o_orderkey % 401 = 6 THEN 2575 ELSE (o_orderkey * 37 % 24) * 100 + (o_orderkey * 13 % 60) END AS INT) AS time_occ,
  CAST(1 + o_custkey % 23 AS INT) AS area,
  concat('AREA_', CAST(1 + o_custkey % 23 AS VARCHAR(10))) AS area_name,
  CAST((1 + o_custkey % 23) * 100 + o_orderkey % 57 AS INT) AS rpt_dist_no,
  CAST(1 + o_custkey % 140 % 2 AS INT) AS part_1_2,
  CAST(110 + o_custkey % 140 AS INT) AS crm_cd,
  concat(CASE o_custkey % 140 % 5 WHEN 0 THEN 'BATTERY' WHEN 1 THEN 'BURGLARY' WHEN 2 THEN 'Narcotic' WHEN 3 THEN 'BIKE - STOLEN' ELSE 'TRESPASS' END, ' ', CAST(110 + o_custkey % 140 AS VARCHAR(10))) AS crm_cd_desc,
  CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE concat('0', CAST(o_orderkey % 900 AS VARCHAR(10)), ' 1822') END AS mocodes,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 WHEN o_orderkey % 101 = 3 THEN -1 WHEN o_orderkey % 211 = 9 THEN 130 WHEN o_orderkey % 223 = 10 THEN 120 WHEN o_orderkey % 53 = 1 THEN NULL ELSE o_custkey % 99 END AS INT) AS vict_age,
  CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'F' WHEN 2 THEN 'M' WHEN 3 THEN 'X' WHEN 4 THEN 'H' WHEN 5 THEN '-' ELSE 'M' END AS vict_sex,
  CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE substr('HWBAOXCKFJVIZ-GQ', CAST(1 + o_custkey % 16 AS INT), 1) END AS vict_descent,
  CASE WHEN o_orderkey % 251 = 11 THEN NULL ELSE CAST(101 + o_custkey % 10 AS DOUBLE) END AS premis_cd,
  CASE WHEN o_orderkey % 251 = 11 THEN NULL ELSE CASE o_custkey % 10 WHEN 0 THEN 'STREET' WHEN 1 THEN 'SINGLE FAMILY DWELLING' WHEN 2 THEN 'PARKING LOT' WHEN 3 THEN 'Department Store' WHEN 4 THEN 'VEHICLE, PASSENGER/TRUCK' WHEN 5 THEN 'WAREHOUSE' WHEN 6 THEN 'CARD CLUB' WHEN 7 THEN 'PARK' WHEN 8 THEN 'STREET MARKET' ELSE NULL END END AS premis_desc,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(100 + o_orderkey % 79 AS DOUBLE) END AS weapon_used_cd,
  CASE WHEN o_orderkey % 3 = 0 THEN concat(CASE o_orderkey % 79 % 6 WHEN 0 THEN 'HAND GUN' WHEN 1 THEN 'KNIFE' WHEN 2 THEN 'PIPE' WHEN 3 THEN 'STRONG-ARM' WHEN 4 THEN 'Shotgun' ELSE 'VERBAL THREAT' END, ' ', CAST(100 + o_orderkey % 79 AS VARCHAR(10))) END AS weapon_desc,
  CASE o_orderstatus WHEN 'F' THEN 'AA' WHEN 'P' THEN 'IC' ELSE CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'JA' END END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'Adult Arrest' WHEN 'P' THEN 'Invest Cont' ELSE CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Juv Arrest' END END AS status_desc,
  CAST(110 + o_custkey % 140 AS DOUBLE) AS crm_cd_1,
  CASE WHEN o_orderkey % 14 = 0 THEN CAST(998 AS DOUBLE) END AS crm_cd_2,
  CASE WHEN o_orderkey % 400 = 0 THEN CAST(998 AS DOUBLE) END AS crm_cd_3,
  CAST(NULL AS DOUBLE) AS crm_cd_4,
  concat(n_name, ' BL') AS location,
  CASE WHEN o_orderkey % 6 = 0 THEN concat('X', CAST(o_custkey % 50 AS VARCHAR(10))) END AS cross_street,
  CASE WHEN o_orderkey % 307 = 2 THEN CAST(0 AS DOUBLE) WHEN o_orderkey % 61 = 4 THEN 32.5 ELSE CAST(33.7 AS DOUBLE) + CAST(o_custkey % 60 AS DOUBLE) / 100 END AS lat,
  CASE WHEN o_orderkey % 307 = 2 THEN CAST(0 AS DOUBLE) ELSE CAST(-118.7 AS DOUBLE) + CAST(o_orderkey % 60 AS DOUBLE) / 100 END AS lon
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """The 28-column incident source over ``sf_dir``'s orders/customer/nation.

    Only the columns the view uses are read (Catalyst prunes the parquet
    scans). nation is tiny and broadcast. customer grows with the orders, so in
    batch both are shuffled by its key: no part of either passes the driver, and
    the rows are dealt over all cores however few row groups the orders have.

    ``orders`` replaces the orders table, e.g. with a stream over it: the
    result is then a stream (stream-static joins to customer and nation).
    """
    text = (INCIDENTS_SQL.replace("FROM orders JOIN customer", "FROM {orders} JOIN {customer}")
            .replace("JOIN nation ON", "JOIN {nation} ON"))
    customer = read_driver_table(spark, sf_dir, "customer")
    return spark.sql(
        text,
        orders=orders if orders is not None else read_driver_table(spark, sf_dir, "orders"),
        customer=customer if orders is not None and orders.isStreaming else customer.hint("shuffle_merge"),
        nation=read_driver_table(spark, sf_dir, "nation"),
    )
