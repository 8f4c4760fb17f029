"""Driver parquet tables and the two loan-shaped views built from them.

``loans`` stands in for a raw loan table (dirty percent / month / term /
employment text) and ``scored`` for an evaluation table (label + score).
Both are one SQL text run by Spark with DataFrame arguments, and by DuckDB
in the oracle with plain table names, so the two engines read identical rows.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed fixture text; {orders} and {customer} are table arguments.
LOANS_SQL = """
SELECT o.o_orderkey AS id, o.o_custkey AS member_id,
  o.o_totalprice AS loan_amnt,
  o.o_totalprice / 36 AS installment,
  c.c_acctbal * 10 AS annual_inc,
  CASE WHEN o.o_orderkey % 11 = 0 THEN NULL
       ELSE CAST(5 + o.o_orderkey % 20 AS STRING) || '.' || CAST(o.o_orderkey % 10 AS STRING) || '%' END AS int_rate,
  CASE WHEN o.o_orderkey % 13 = 0 THEN '' WHEN o.o_orderkey % 17 = 0 THEN 'n/a'
       ELSE CAST(o.o_orderkey % 100 AS STRING) || '%' END AS revol_util,
  CASE WHEN o.o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
  CASE o.o_custkey % 12 WHEN 0 THEN '< 1 year' WHEN 1 THEN '1 year' WHEN 10 THEN '10+ years' WHEN 11 THEN NULL
       ELSE CAST(o.o_custkey % 12 AS STRING) || ' years' END AS emp_length,
  substring('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * month(o.o_orderdate) - 2, 3) || '-' || CAST(year(o.o_orderdate) AS STRING) AS issue_d,
  CASE WHEN o.o_orderkey % 19 = 0 THEN 'bad' ELSE
    substring('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3 * ((year(o.o_orderdate) * 12 + month(o.o_orderdate) - 1 - o.o_custkey % 400) % 12) + 1 AS INT), 3)
    || '-' || CAST(CAST(floor((year(o.o_orderdate) * 12 + month(o.o_orderdate) - 1 - o.o_custkey % 400) / 12) AS INT) AS STRING) END AS earliest_cr_line,
  CASE o.o_orderstatus WHEN 'F' THEN 'Charged Off' WHEN 'O' THEN 'Fully Paid'
    ELSE CASE o.o_orderkey % 5 WHEN 0 THEN 'Current' WHEN 1 THEN 'Late (31-120 days)' WHEN 2 THEN 'Late (16-30 days)'
         WHEN 3 THEN 'In Grace Period' ELSE 'Default' END END AS loan_status,
  CASE o.o_orderkey % 6 WHEN 0 THEN 'medical' WHEN 1 THEN 'car' WHEN 2 THEN 'home_improvement' WHEN 3 THEN 'major_purchase'
       WHEN 4 THEN 'debt_consolidation' ELSE 'credit_card' END AS purpose,
  CASE c.c_nationkey % 5 WHEN 0 THEN 'CA' WHEN 1 THEN 'NY' WHEN 2 THEN 'TX' WHEN 3 THEN 'FL' ELSE 'NJ' END AS addr_state,
  c.c_mktsegment AS home_ownership,
  CAST(o.o_orderkey % 400 AS DOUBLE) / 10 AS dti,
  CAST(o.o_orderkey % 5000 AS DOUBLE) AS revol_bal,
  CAST((o.o_orderkey * 31) % 9000 AS DOUBLE) AS total_rev_hi_lim
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
"""

# Fixed fixture text; {loans} is a table argument.
SCORED_SQL = """
SELECT *, CASE WHEN loan_status IN ('Current', 'Fully Paid') THEN 0 ELSE 1 END AS label,
  CAST((id * 7919) % 700 + (CASE WHEN loan_status IN ('Current', 'Fully Paid') THEN 0 ELSE 300 END) AS DOUBLE) / 1000 AS score
FROM {loans} WHERE loan_status <> 'In Grace Period'
"""

# Split cut dates that suit the driver's order dates (1995-2001).
FIXTURE_TRAIN_END = "1998-12-31"
FIXTURE_VAL_END = "1999-12-31"
FIXTURE_HORIZON = "2001-01-01"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-loan view: orders joined to customers on the customer key.

    The join is left to the planner: sort-merge on ``custkey`` at scale,
    broadcast only when AQE measures the customer side below the threshold.
    """
    return spark.sql(LOANS_SQL, orders=read_table(spark, sf_dir, "orders"),
                     customer=read_table(spark, sf_dir, "customer"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation view: the six labelled statuses with a deterministic score."""
    return spark.sql(SCORED_SQL, loans=loans(spark, sf_dir))


def oracle_prelude() -> str:
    """``WITH loans AS (..), scored AS (..)`` for DuckDB over the driver views."""
    lo = LOANS_SQL.format(orders="orders", customer="customer")
    sc = SCORED_SQL.format(loans="loans")
    return f"WITH loans AS ({lo}), scored AS ({sc})"
