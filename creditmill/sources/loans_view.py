"""Loans derived from the star schema: one loan per order.

The same SQL text runs in Spark (here) and in the SQL checks, so both start from equal rows.
Loans and their lines are both large, so the hint asks for a sort-merge join, whose skewed partitions
adaptive execution splits; the join goes away altogether where no line column is read.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from creditmill.operators import cleaning

TABLES = ("orders", "customer", "nation", "lineitem")

LOANS_SQL = """
SELECT o_orderkey AS id, o_custkey AS member_id, o_orderdate AS issue_d,
  CAST(FLOOR(o_totalprice/12.5E0) AS DOUBLE) AS loan_amnt,
  CAST(FLOOR(o_totalprice/12.5E0) AS DOUBLE) AS funded_amnt,
  CASE WHEN o_orderkey%3=0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  CONCAT(CAST(5+CAST(FLOOR(rk/100.0E0) AS INT) AS VARCHAR(4)),'.',LPAD(CAST(rk%100 AS VARCHAR(4)),2,'0'),'%') AS int_rate,
  CAST(FLOOR(o_totalprice/400.0E0) AS DOUBLE) AS installment,
  SUBSTRING('ABCDEFG',CAST(FLOOR(sg/5.0E0) AS INT)+1,1) AS grade,
  CONCAT(SUBSTRING('ABCDEFG',CAST(FLOOR(sg/5.0E0) AS INT)+1,1),CAST(sg%5+1 AS VARCHAR(2))) AS sub_grade,
  CASE WHEN ek=11 THEN NULL WHEN ek=0 THEN '< 1 year' WHEN ek=1 THEN '1 year' WHEN ek=10 THEN '10+ years'
       ELSE CONCAT(CAST(ek AS VARCHAR(2)),' years') END AS emp_length,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'OWN' WHEN 'AUTOMOBILE' THEN 'RENT' WHEN 'HOUSEHOLD' THEN 'MORTGAGE'
       WHEN 'FURNITURE' THEN 'ANY' ELSE 'OTHER' END AS home_ownership,
  CASE WHEN o_custkey%17=0 THEN NULL ELSE CAST(FLOOR((c_acctbal+1000.0E0)*18.0E0) AS DOUBLE) END AS annual_inc,
  CASE o_orderkey%3 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Source Verified' ELSE 'Not Verified' END AS verification_status,
  CASE WHEN o_orderstatus='P' AND o_orderkey%2=0 THEN 'Current' WHEN dk < 60+9*sg THEN 'Charged Off'
       ELSE 'Fully Paid' END AS loan_status,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'small_business' WHEN '2-HIGH' THEN 'credit_card'
       WHEN '3-MEDIUM' THEN 'debt_consolidation' WHEN '4-NOT SPECIFIED' THEN 'other' ELSE 'home_improvement' END AS purpose,
  n_name AS addr_state,
  CAST(qty%41 AS DOUBLE) AS dti,
  CAST(n_ret AS DOUBLE) AS delinq_2yrs, CAST(n_open AS DOUBLE) AS inq_last_6mths, CAST(n_lines AS DOUBLE) AS open_acc,
  CASE WHEN o_orderkey%10=0 THEN 1.0E0 ELSE 0.0E0 END AS pub_rec,
  CAST(FLOOR(ext/25.0E0) AS DOUBLE) AS revol_bal,
  CASE WHEN ext IS NULL THEN NULL ELSE CONCAT(CAST(ext%170 AS VARCHAR(6)),'.5%') END AS revol_util,
  CAST(n_lines*2+o_orderkey%7 AS DOUBLE) AS total_acc,
  CASE WHEN o_custkey%20=0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
  CAST(ext AS DOUBLE) AS tot_cur_bal,
  CASE WHEN o_orderkey%5<2 THEN CAST(ext*2 AS DOUBLE) ELSE NULL END AS total_rev_hi_lim,
  CAST(sg*20 + (o_orderkey*7919)%293 AS DOUBLE)/1000.0E0 AS fixture_pd
FROM (SELECT *, CAST(FLOOR(rk*35.0E0/2503.0E0) AS INT) AS sg FROM (
  SELECT /*+ MERGE(li) */ *, CAST((o_orderkey*7919+11)%2503 AS INT) AS rk, CAST((o_orderkey*104729+17)%1009 AS INT) AS dk,
         CAST((o_custkey*31+5)%12 AS INT) AS ek
  FROM {orders} JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n_lines, SUM(CAST(l_quantity AS BIGINT)) AS qty,
      SUM(CAST(ROUND(l_extendedprice) AS BIGINT)) AS ext,
      SUM(CASE WHEN l_returnflag='R' THEN 1 ELSE 0 END) AS n_ret,
      SUM(CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END) AS n_open
    FROM {lineitem} GROUP BY l_orderkey) li ON l_orderkey=o_orderkey) b) g
"""


def raw_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned loans: text percentages, padded terms, every status."""
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return spark.sql(LOANS_SQL, **tables)


def keyed_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_loans(spark, sf_dir).withColumn("loan_id", F.col("id"))


def clean_loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans after the cleaning chain, still carrying their key, date and fixture PD."""
    return keyed_loans(spark, sf_dir).transform(cleaning.clean)
