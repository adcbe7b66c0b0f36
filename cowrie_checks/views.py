"""The platform's facts as projections of the driver's star tables.

One text for both engines: ``{orders}`` and its like name the tables.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")

VIEWS = {
    "v_customers": """
  SELECT c_custkey AS customer_id,
         CASE c_nationkey % 8 WHEN 0 THEN 'CI' WHEN 1 THEN 'SN' WHEN 2 THEN 'ML' WHEN 3 THEN 'BF'
              WHEN 4 THEN 'GN' WHEN 5 THEN 'TG' WHEN 6 THEN 'BJ' ELSE 'GH' END AS country_code,
         CASE (c_nationkey + 1) % 8 WHEN 0 THEN 'CI' WHEN 1 THEN 'SN' WHEN 2 THEN 'ML' WHEN 3 THEN 'BF'
              WHEN 4 THEN 'GN' WHEN 5 THEN 'TG' WHEN 6 THEN 'BJ' ELSE 'GH' END AS neighbour_country,
         c_mktsegment AS segment,
         CASE WHEN c_custkey % 10 < 3 THEN 'BASIC' WHEN c_custkey % 10 < 8 THEN 'STANDARD' ELSE 'ENHANCED' END AS kyc_level
  FROM {customer}""",
    "v_accounts": """
  SELECT c_custkey AS account_id, c_custkey AS customer_id,
         CASE c_custkey % 3 WHEN 0 THEN 'CURRENT' WHEN 1 THEN 'SAVINGS' ELSE 'LOAN' END AS account_type,
         CASE WHEN c_acctbal < 0 THEN 'FROZEN' ELSE 'ACTIVE' END AS status
  FROM {customer}
  WHERE c_acctbal >= -800""",
    "v_branches": """
  SELECT s_suppkey AS branch_id,
         CASE s_suppkey % 4 WHEN 0 THEN 'FULL_SERVICE' WHEN 1 THEN 'DIGITAL_ONLY' WHEN 2 THEN 'AGENCY_BANKING' ELSE 'ATM_POINT' END AS branch_type,
         s_nationkey AS region
  FROM {supplier}""",
    "v_bank": """
  SELECT o_orderkey AS transaction_id, o_orderdate AS event_ts, o_custkey AS account_id,
         o_orderkey % 12 AS branch_id, c.country_code,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'TRANSFER' WHEN '2-HIGH' THEN 'PAYMENT' WHEN '3-MEDIUM' THEN 'WITHDRAWAL'
              WHEN '4-NOT SPECIFIED' THEN 'DEPOSIT' ELSE 'INTERNATIONAL_WIRE' END AS transaction_type,
         CASE WHEN c.country_code = 'GH' THEN o_totalprice / 50e0 ELSE o_totalprice * 5e0 END AS amount,
         CASE WHEN c.country_code = 'GH' THEN 'GHS' ELSE 'XOF' END AS currency,
         CASE o_orderstatus WHEN 'F' THEN 'SUCCESS' WHEN 'O' THEN 'FAILED' ELSE 'REVERSED' END AS transaction_status,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 0.01e0 ELSE 0e0 END AS fee_amount,
         CASE WHEN o_orderkey % 4 = 0 THEN 'MICROFINANCE' ELSE 'BANK' END AS entity_type
  FROM {orders} JOIN v_customers c ON o_custkey = c.customer_id""",
    "v_loans": """
  SELECT l_orderkey * 10 + l_linenumber AS repayment_id, CAST(l_shipdate AS DATE) AS due_date,
         o_custkey AS loan_account_id, o_custkey AS customer_id, c.country_code,
         l_extendedprice AS amount_due,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN l_extendedprice * 0.5e0 ELSE l_extendedprice END AS amount_paid,
         CASE WHEN c.country_code = 'GH' THEN 'GHS' ELSE 'XOF' END AS currency,
         CASE l_linenumber % 5 WHEN 0 THEN 'CONSUMER' WHEN 1 THEN 'MORTGAGE' WHEN 2 THEN 'SME' WHEN 3 THEN 'AGRICULTURAL' ELSE 'MICROCREDIT' END AS loan_type,
         CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'DEFAULT' WHEN l_returnflag = 'A' THEN 'LATE' ELSE 'ON_TIME' END AS repayment_status,
         l_partkey AS tie_part, l_suppkey AS tie_supp, l_quantity AS tie_qty
  FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN v_customers c ON o_custkey = c.customer_id""",
    "v_insurance": """
  SELECT x.*,
         CASE WHEN operation_type IN ('CLAIM_SUBMISSION', 'CLAIM_PAYMENT')
              THEN CASE k2 WHEN 0 THEN 'PAID' WHEN 1 THEN 'PENDING' WHEN 2 THEN 'REJECTED' ELSE 'APPROVED' END END AS claim_status,
         CASE WHEN operation_type IN ('CLAIM_SUBMISSION', 'CLAIM_PAYMENT') AND k2 IN (0, 2) THEN p_size END AS processing_days
  FROM (SELECT l_orderkey * 10 + l_linenumber AS operation_id, l_shipdate AS event_ts, o_custkey AS customer_id,
               o_custkey AS account_id, c.country_code, p_type AS product_line, p_size, l_extendedprice AS amount,
               CASE WHEN c.country_code = 'GH' THEN 'GHS' ELSE 'XOF' END AS currency,
               CASE (l_partkey + l_suppkey) % 5 WHEN 0 THEN 'CLAIM_SUBMISSION' WHEN 1 THEN 'CLAIM_PAYMENT'
                    WHEN 2 THEN 'POLICY_RENEWAL' ELSE 'PREMIUM_PAYMENT' END AS operation_type,
               l_suppkey % 4 AS k2
        FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {part} ON l_partkey = p_partkey
             JOIN v_customers c ON o_custkey = c.customer_id) x""",
    "v_mobile": """
  SELECT event_id AS payment_id, ts AS event_ts, user_id AS sender_id,
         CASE WHEN event_type = 'signup' THEN c.neighbour_country ELSE c.country_code END AS sender_country,
         CASE WHEN event_type IN ('purchase', 'signup') THEN c.neighbour_country ELSE c.country_code END AS receiver_country,
         value * 1000e0 AS amount,
         CASE WHEN c.country_code = 'GH' THEN 'GHS' ELSE 'XOF' END AS currency,
         CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status, value * 15e0 AS fee_amount
  FROM {events} JOIN v_customers c ON user_id = c.customer_id""",
    "v_bank_stream": """
  SELECT event_id AS transaction_id, ts AS event_ts, user_id AS account_id, c.country_code,
         CASE event_type WHEN 'purchase' THEN 'TRANSFER' WHEN 'view' THEN 'PAYMENT' WHEN 'error' THEN 'WITHDRAWAL'
              WHEN 'click' THEN 'DEPOSIT' ELSE 'INTERNATIONAL_WIRE' END AS transaction_type,
         value * 5000e0 AS amount, CASE WHEN c.country_code = 'GH' THEN 'GHS' ELSE 'XOF' END AS currency
  FROM {events} JOIN v_customers c ON user_id = c.customer_id""",
}


VIEWS |= {
    # every tenth transaction is larger than whole cents in 64 bits allow to sum up
    "v_bank_large": """
  SELECT transaction_id, event_ts, account_id, country_code, transaction_type, currency, entity_type,
         CASE WHEN transaction_id % 10 = 0 THEN 2e16 ELSE amount END AS amount
  FROM v_bank""",
}

#: Spark joins as the text says: customers meet the orders, which are fewer than the lines, so the
#: lines move by order once and not by customer too.  The SQL of the checks stays as it is.
_WITH_ORDERS = "JOIN {orders} ON l_orderkey = o_orderkey"
_WITH_HOLDERS = "JOIN v_customers c ON o_custkey = c.customer_id"
_HOLDERS_FIRST = "JOIN ({orders} JOIN v_customers c ON o_custkey = c.customer_id) ON l_orderkey = o_orderkey"


def holders_first(text: str) -> str:
    """A text over lines, orders and customers, the orders joined with their customers before the lines."""
    parts = rf"{re.escape(_WITH_ORDERS)}((?:\s+JOIN \{{part\}} ON l_partkey = p_partkey)?)\s+{re.escape(_WITH_HOLDERS)}"
    return re.sub(parts, lambda found: _HOLDERS_FIRST + found[1], text)


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; its schema is inferred once, not by a job for each query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _views_of(text: str) -> list[str]:
    """The views a text needs, each after those it needs itself."""
    found: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", text):
            found += [v for v in [*_views_of(VIEWS[name]), name] if v not in found]
    return found


def with_views(body: str, *ctes: str) -> str:
    """A query over the views, with further named parts, as one WITH statement."""
    parts = [f"{name} AS ({VIEWS[name]})" for name in _views_of(" ".join([body, *ctes]))]
    parts += ctes
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body


def oracle(body: str, *ctes: str) -> str:
    return with_views(body, *ctes).format(**{t: t for t in TABLES})


def view(spark: SparkSession, sf_dir: str, name: str, **given: DataFrame) -> DataFrame:
    """A view over the tables; ``given`` replaces tables, for instance by streams."""
    text = holders_first(with_views(f"SELECT * FROM {name}"))
    tables = {
        t: given.get(t) if t in given else table(spark, sf_dir, t)
        for t in TABLES
        if "{" + t + "}" in text
    }
    return spark.sql(text, **tables)
