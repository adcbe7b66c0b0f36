"""Every operator run on the driver's tables, and the SQL that says what it must give.

Dates and times leave as text, so that both engines print them alike.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cowrie_checks.views import oracle, table, view
from cowrie import session
from cowrie.functions.money import with_eur
from cowrie.functions.periods import on_day
from cowrie.model import DATASETS, FACTS
from cowrie.operators import incremental, indicators, latest, quality, regulatory
from cowrie.plans import bronze, gold, report, silver
from cowrie.sources import files, raw_files
from cowrie.sources.lake import NO_VALUE, FactTable, Lake, PeriodTable
from cowrie.streaming import alerts

#: The tables are thin: a folder for each of the thousands of days holds all countries.
BY_DAY = {name: ["event_date"] for name in FACTS}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def printed(df: DataFrame) -> DataFrame:
    """Dates and times as text, microseconds included."""
    as_text = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DateType):
            as_text[field.name] = F.date_format(field.name, "yyyy-MM-dd")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            as_text[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.withColumns(as_text) if as_text else df


def query(name: str, sql: str | None = None):
    def register(build):
        def build_printed(spark: SparkSession, sf_dir: str) -> DataFrame:
            return printed(build(session.configure(spark), sf_dir.rstrip("/")))

        QUERIES[name] = build_printed
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


# -- pieces of SQL ---------------------------------------------------------------


def rate(currency: str = "currency") -> str:
    return f"(CASE {currency} WHEN 'XOF' THEN 1e0 / 655.957e0 WHEN 'GHS' THEN 1e0 / 13.5e0 END)"


def eur(amount: str) -> str:
    """To the cent, half up on the decimal text of the double, as 291.525 -> 291.53."""
    text = f"CAST({amount} * {rate()} AS VARCHAR)"
    return f"CAST(round(CAST({text} AS DECIMAL(38, 15)), 2) AS DOUBLE)"


def cts(amount: str) -> str:
    """Cents of a native amount once converted."""
    return f"CAST(round({eur(amount)} * 100) AS BIGINT)"


def as_eur(cents: str) -> str:
    return f"CAST({cents} AS DOUBLE) / 100"


def half_up(numerator: str, denominator: str, decimals: int) -> str:
    """Exact half-up quotient of two non-negative integers."""
    n, d, p = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)", 10**decimals
    return (
        f"CASE WHEN {d} = 0 THEN NULL ELSE CAST(({2 * p} * {n} + {d}) // (2 * {d}) AS DOUBLE) / {p} END"
    )


def day_text(column: str) -> str:
    return f"CAST(CAST({column} AS DATE) AS VARCHAR)"


def month_text(column: str) -> str:
    return day_text(f"date_trunc('month', {column})")


def time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"


# -- facts -------------------------------------------------------------------------


def bank(spark: SparkSession, sf: str) -> DataFrame:
    return with_eur(view(spark, sf, "v_bank"), ["amount", "fee_amount"])


def loans(spark: SparkSession, sf: str) -> DataFrame:
    return with_eur(view(spark, sf, "v_loans"), ["amount_due", "amount_paid"])


def insurance(spark: SparkSession, sf: str) -> DataFrame:
    return with_eur(view(spark, sf, "v_insurance"), ["amount"])


def mobile(spark: SparkSession, sf: str) -> DataFrame:
    payments = with_eur(view(spark, sf, "v_mobile"), ["amount", "fee_amount"])
    return quality.with_country(payments, "sender_country")


def references(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: view(spark, sf, f"v_{name}") for name in ("accounts", "customers", "branches")}


# -- E: indicators -------------------------------------------------------------------


@query(
    "e1_daily_transaction_volume",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, country_code, entity_type, transaction_type,
                   count(*) AS txn_count, {as_eur(f"sum({cts('amount')})")} AS total_amount_eur
            FROM v_bank GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return indicators.daily_transaction_volume(bank(spark, sf), "event_ts")


@query(
    "e1_large_amounts",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, country_code, entity_type, transaction_type,
                   count(*) AS txn_count, {as_eur(f"sum({cts('amount')})")} AS total_amount_eur
            FROM v_bank_large GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return indicators.daily_transaction_volume(with_eur(view(spark, sf, "v_bank_large"), ["amount"]), "event_ts")


NPL_CTES = (
    f"""daily AS (SELECT due_date, country_code, loan_type,
              sum(CASE WHEN repayment_status = 'DEFAULT' THEN {cts('amount_due')} ELSE 0 END) AS d,
              sum({cts('amount_due')}) AS t
       FROM v_loans GROUP BY ALL)""",
    """grid AS (SELECT a.due_date, g.country_code, g.loan_type
       FROM (SELECT DISTINCT due_date FROM daily) a
            CROSS JOIN (SELECT DISTINCT country_code, loan_type FROM daily) g)""",
    """stock AS (SELECT grid.due_date, grid.country_code, grid.loan_type,
              sum(d) OVER w AS d, sum(t) OVER w AS t
       FROM grid LEFT JOIN daily USING (due_date, country_code, loan_type)
       WINDOW w AS (PARTITION BY grid.country_code, grid.loan_type ORDER BY grid.due_date))""",
)


@query(
    "e2_npl_stock",
    oracle(
        f"""SELECT {day_text('due_date')} AS period, country_code, loan_type,
                   {half_up('d', 't', 4)} AS npl_ratio,
                   {as_eur('d')} AS encours_defaut_eur, {as_eur('t')} AS encours_total_eur
            FROM stock WHERE t IS NOT NULL""",
        *NPL_CTES,
    ),
)
def _(spark, sf):
    return indicators.npl_ratio_by_country(loans(spark, sf))


@query(
    "e3_arpu_monthly",
    oracle(
        f"""SELECT CAST(month AS VARCHAR) AS period, country_code, segment,
                   {half_up('sum(fees + paid)', 'count(DISTINCT customer_id) * 100', 2)} AS arpu_eur,
                   count(DISTINCT customer_id) AS nb_customers
            FROM (SELECT coalesce(b.month, l.month) AS month, coalesce(b.country_code, l.country_code) AS country_code,
                         coalesce(b.segment, l.segment) AS segment, coalesce(b.customer_id, l.customer_id) AS customer_id,
                         coalesce(fees, 0) AS fees, coalesce(paid, 0) AS paid
                  FROM b FULL JOIN l USING (month, country_code, segment, customer_id))
            WHERE month IN (SELECT month FROM b)
            GROUP BY month, country_code, segment""",
        f"""b AS (SELECT CAST(date_trunc('month', event_ts) AS DATE) AS month, v_bank.country_code, segment,
                  customer_id, sum({cts('fee_amount')}) AS fees
           FROM v_bank JOIN v_customers ON account_id = customer_id GROUP BY ALL)""",
        f"""l AS (SELECT CAST(date_trunc('month', due_date) AS DATE) AS month, v_loans.country_code, segment,
                  v_loans.customer_id, sum({cts('amount_paid')}) AS paid
           FROM v_loans JOIN v_customers USING (customer_id) GROUP BY ALL)""",
    ),
)
def _(spark, sf):
    customers = view(spark, sf, "v_customers").select("customer_id", "segment")
    fees = bank(spark, sf).withColumnRenamed("account_id", "customer_id").join(customers, "customer_id")
    paid = loans(spark, sf).join(customers, "customer_id")
    return indicators.customer_arpu_monthly(fees, paid, "event_ts")


LOSS_CTES = (
    f"""claims AS (SELECT date_trunc('month', event_ts) AS month, country_code, product_line, sum({cts('amount')}) AS c
        FROM v_insurance WHERE operation_type = 'CLAIM_PAYMENT' AND claim_status = 'PAID' GROUP BY ALL)""",
    f"""premiums AS (SELECT date_trunc('month', event_ts) AS month, country_code, product_line, sum({cts('amount')}) AS p
        FROM v_insurance WHERE operation_type = 'PREMIUM_PAYMENT' GROUP BY ALL)""",
    """losses AS (SELECT month, country_code, product_line, coalesce(c, 0) AS c, coalesce(p, 0) AS p
        FROM claims FULL JOIN premiums USING (month, country_code, product_line))""",
)


@query(
    "e4_loss_ratio",
    oracle(
        f"""SELECT {day_text('month')} AS period, country_code, product_line,
                   {as_eur('c')} AS claims_paid_eur, {as_eur('p')} AS premiums_eur,
                   {half_up('c', 'p', 4)} AS loss_ratio
            FROM losses""",
        *LOSS_CTES,
    ),
)
def _(spark, sf):
    return indicators.loss_ratio_by_product(insurance(spark, sf), "event_ts")


@query(
    "e5_processing_time",
    oracle(
        f"""SELECT {month_text('event_ts')} AS period, country_code, product_line,
                   {half_up('sum(processing_days)', 'count(processing_days)', 1)} AS avg_processing_days
            FROM v_insurance WHERE processing_days IS NOT NULL GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return indicators.claims_processing_time(view(spark, sf, "v_insurance"), "event_ts")


FLOW_COLUMNS = f"""count(*) AS txn_count, {as_eur(f"sum({cts('amount')})")} AS total_amount_eur,
    {half_up("sum(CASE status WHEN 'FAILED' THEN 1 ELSE 0 END)", 'count(*)', 4)} AS failure_rate,
    count(DISTINCT sender_id) AS active_users"""


@query(
    "e6_mobile_daily_flow",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, sender_country AS country_code, {FLOW_COLUMNS}
            FROM v_mobile GROUP BY ALL"""
    ),
)
def _(spark, sf):
    return indicators.mobile_money_daily_flow(mobile(spark, sf), "event_ts")


CORRIDORS = f"""SELECT {day_text("date_trunc('week', event_ts)")} AS period, sender_country, receiver_country,
       count(*) AS txn_count,
       {half_up(f"sum({cts('amount')})", 'count(*) * 100', 2)} AS avg_amount_eur,
       {as_eur(f"sum({cts('amount')})")} AS total_amount_eur
FROM v_mobile
WHERE sender_country <> receiver_country
  AND sender_country IN ('CI', 'SN', 'ML', 'BF', 'GN', 'TG', 'BJ')
  AND receiver_country IN ('CI', 'SN', 'ML', 'BF', 'GN', 'TG', 'BJ')
GROUP BY ALL"""


@query("e7_cross_border", oracle(CORRIDORS))
def _(spark, sf):
    return indicators.cross_border_transfers(mobile(spark, sf), "event_ts")


@query(
    "e8_high_water_mark",
    oracle(
        f"""SELECT 'bank' AS source, {day_text('max(event_ts)')} AS mark FROM v_bank
            UNION ALL SELECT 'loans', {day_text('max(due_date)')} FROM v_loans
            UNION ALL SELECT 'mobile', {day_text('max(event_ts)')} FROM v_mobile"""
    ),
)
def _(spark, sf):
    sources = {
        "bank": (view(spark, sf, "v_bank"), "event_ts"),
        "loans": (view(spark, sf, "v_loans"), "due_date"),
        "mobile": (view(spark, sf, "v_mobile"), "event_ts"),
    }
    marks = [(n, incremental.high_water_mark(df, moment)) for n, (df, moment) in sources.items()]
    return spark.createDataFrame(marks, "source string, mark date")


CLAIMS_TODAY = dt.date(2000, 6, 30)
PREMIUMS_CTE = f"""p AS (SELECT customer_id, sum({cts('amount')}) AS premium FROM v_insurance
    WHERE operation_type = 'PREMIUM_PAYMENT'
      AND event_ts >= CAST(DATE '{CLAIMS_TODAY}' - INTERVAL 365 DAY AS TIMESTAMP)
    GROUP BY ALL)"""


@query(
    "e9_recent_premiums",
    oracle(f"SELECT customer_id, {as_eur('premium')} AS annual_premium_eur FROM p", PREMIUMS_CTE),
)
def _(spark, sf):
    return alerts.recent_premiums(insurance(spark, sf), CLAIMS_TODAY, "event_ts")


# -- F, C, I: rows --------------------------------------------------------------------


@query(
    "f1_latest_dedup",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus, {time_text('l_shipdate')} AS l_shipdate
        FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
                     l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
                     l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) = 1""",
)
def _(spark, sf):
    return latest.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query(
    "c4_c5_clean_amounts",
    """SELECT c_custkey, c_acctbal AS amount, CASE WHEN c_acctbal >= 5000 THEN c_acctbal - 5000 END AS fee_amount
       FROM customer WHERE c_acctbal >= 0""",
)
def _(spark, sf):
    balances = table(spark, sf, "customer").select(
        "c_custkey", F.col("c_acctbal").alias("amount"), (F.col("c_acctbal") - 5000).alias("fee_amount")
    )
    return quality.usable_amounts(balances, ["amount", "fee_amount"])


@query(
    "c22_country_selection",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, sender_country AS country_code, {FLOW_COLUMNS}
            FROM v_mobile WHERE sender_country IN ('CI', 'GH') GROUP BY ALL"""
    ),
)
def _(spark, sf):
    chosen = quality.in_countries(mobile(spark, sf), ["CI", "GH"])
    return indicators.mobile_money_daily_flow(chosen, "event_ts")


@query(
    "i11_eur_conversion",
    oracle(
        f"""SELECT transaction_id, currency, {eur('amount')} AS amount_eur, {eur('fee_amount')} AS fee_amount_eur
            FROM (SELECT transaction_id, amount, fee_amount,
                         CASE transaction_type WHEN 'INTERNATIONAL_WIRE' THEN 'USD' ELSE currency END AS currency
                  FROM v_bank)"""
    ),
)
def _(spark, sf):
    wire = F.col("transaction_type") == "INTERNATIONAL_WIRE"
    foreign = view(spark, sf, "v_bank").withColumn("currency", F.when(wire, "USD").otherwise(F.col("currency")))
    return with_eur(foreign, ["amount", "fee_amount"]).select(
        "transaction_id", "currency", "amount_eur", "fee_amount_eur"
    )


# -- D, P2: silver ----------------------------------------------------------------------


def silver_ctes(
    name: str, source: str, key: str, moment: str, amounts: list[str], ties: list[str]
) -> tuple[str, str]:
    """Newest row per key and day, cleaned; then the last surviving day per key, as ``name``."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in [moment, *ties])
    return (
        f"""{name}_days AS (SELECT *, CAST({moment} AS DATE) AS k_day FROM {source}
             QUALIFY row_number() OVER (PARTITION BY {key}, CAST({moment} AS DATE) ORDER BY {order}) = 1)""",
        f"""{name} AS (SELECT * FROM {name}_days WHERE {amounts[0]} >= 0
             QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY k_day DESC) = 1)""",
    )


def silver_sql(source: str, key: str, moment: str, amounts: list[str], ties: list[str], joins: str, extra: str) -> str:
    shown = {moment: time_text(moment) if moment == "event_ts" else day_text(moment)}
    shown |= {a: f"CASE WHEN {a} >= 0 THEN {a} END" for a in amounts[1:]}
    columns = ", ".join(f"{shown.get(c, f's.{c}')} AS {c}" for c in [key, moment, *ties])
    converted = ", ".join(f"{eur(shown.get(a, a))} AS {a}_eur" for a in amounts)
    return oracle(
        f"SELECT {columns}, {converted}, {extra} FROM s {joins}",
        *silver_ctes("s", source, key, moment, amounts, ties),
    )


BANK_TIES = ["account_id", "branch_id", "country_code", "transaction_type", "amount", "currency",
             "transaction_status", "fee_amount", "entity_type"]
INSURANCE_TIES = ["customer_id", "account_id", "country_code", "product_line", "p_size", "amount", "currency",
                  "operation_type", "k2", "claim_status", "processing_days"]


@query(
    "p2_silver_bank",
    silver_sql(
        "v_bank", "transaction_id", "event_ts", ["amount", "fee_amount"],
        BANK_TIES,
        """LEFT JOIN v_accounts a ON s.account_id = a.account_id
           LEFT JOIN v_customers c ON a.customer_id = c.customer_id
           LEFT JOIN v_branches b ON s.branch_id = b.branch_id""",
        """a.customer_id, a.account_type, a.status AS account_status, c.segment,
           c.kyc_level AS customer_kyc_level, b.branch_type, b.region AS branch_region""",
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_bank")
    return silver.refined(rows, DATASETS["bank_transactions"], references(spark, sf), "event_ts", "event_ts", apart=False)


@query(
    "p2_silver_insurance",
    silver_sql(
        "v_insurance", "operation_id", "event_ts", ["amount"],
        INSURANCE_TIES,
        """LEFT JOIN v_accounts a ON s.account_id = a.account_id
           LEFT JOIN v_customers c ON s.customer_id = c.customer_id""",
        "a.account_type, a.status AS account_status, c.segment, c.kyc_level AS customer_kyc_level",
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_insurance")
    return silver.refined(rows, DATASETS["insurance_operations"], references(spark, sf), "event_ts", "event_ts", apart=False)


@query(
    "p2_silver_mobile",
    silver_sql(
        "v_mobile", "payment_id", "event_ts", ["amount", "fee_amount"],
        ["sender_id", "sender_country", "receiver_country", "amount", "currency", "status", "fee_amount"],
        "LEFT JOIN v_customers c ON s.sender_id = c.customer_id",
        "s.sender_country AS country_code, c.segment, c.kyc_level AS customer_kyc_level",
    ),
)
def _(spark, sf):
    rows = quality.with_country(view(spark, sf, "v_mobile"), "sender_country")
    return silver.refined(rows, DATASETS["mobile_money"], references(spark, sf), "event_ts", "event_ts", apart=False)


LOAN_TIES = ["loan_account_id", "customer_id", "country_code", "amount_due", "amount_paid", "currency",
             "loan_type", "repayment_status", "tie_part", "tie_supp", "tie_qty"]
LOAN_SILVER = silver_sql(
    "v_loans", "repayment_id", "due_date", ["amount_due", "amount_paid"], LOAN_TIES,
    """LEFT JOIN v_accounts a ON s.loan_account_id = a.account_id
       LEFT JOIN v_customers c ON s.customer_id = c.customer_id""",
    "a.account_type, a.status AS account_status, c.segment, c.kyc_level AS customer_kyc_level",
)


@query("p2_silver_loans", LOAN_SILVER)
def _(spark, sf):
    rows = view(spark, sf, "v_loans")
    return silver.refined(rows, DATASETS["loan_repayments"], references(spark, sf), "due_date", "due_date", apart=False)


REPLAYED = dt.date(1998, 6, 30)


@query("k3_single_day_replay", LOAN_SILVER.replace("FROM v_loans\n", f"FROM v_loans WHERE due_date = DATE '{REPLAYED}'\n"))
def _(spark, sf):
    day = on_day(view(spark, sf, "v_loans"), "due_date", REPLAYED)
    return silver.refined(
        day, DATASETS["loan_repayments"], references(spark, sf), "due_date", "due_date", single_day=True
    )


# -- B: merges through the lake ----------------------------------------------------------

LOAN_COLUMNS = ["repayment_id", "due_date", *LOAN_TIES]
LOAN_SHOWN = ", ".join(["repayment_id", f"{day_text('due_date')} AS due_date", *LOAN_TIES])
LOAN_LATEST = f"""ROW_NUMBER() OVER (PARTITION BY repayment_id ORDER BY due_date DESC NULLS LAST,
    {', '.join(f'{c} DESC NULLS LAST' for c in LOAN_TIES)})"""


@query(
    "b4_insert_only_merge",
    oracle(
        f"""SELECT {LOAN_SHOWN} FROM v_loans WHERE due_date < DATE '1998-07-01'
            UNION ALL
            SELECT {LOAN_SHOWN} FROM v_loans WHERE due_date >= DATE '1998-01-01'
              AND repayment_id NOT IN (SELECT repayment_id FROM v_loans WHERE due_date < DATE '1998-07-01')"""
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_loans")
    path = session.shared_folder(spark, "b4")
    loans_table = FactTable(spark, f"{path}/loans", "repayment_id", ["country_code"])
    loans_table.append(rows.filter("due_date < DATE '1998-07-01'"))
    loans_table.merge(rows.filter("due_date >= DATE '1998-01-01'"))
    return loans_table.read().select(*LOAN_COLUMNS)


@query(
    "b5_upsert",
    oracle(
        f"""SELECT {LOAN_SHOWN} FROM old WHERE repayment_id NOT IN (SELECT repayment_id FROM new)
            UNION ALL SELECT {LOAN_SHOWN} FROM new""",
        f"old AS (SELECT * FROM v_loans WHERE due_date < DATE '1998-07-01' QUALIFY {LOAN_LATEST} = 1)",
        f"new AS (SELECT * FROM v_loans WHERE due_date >= DATE '1998-01-01' QUALIFY {LOAN_LATEST} = 1)",
    ),
)
def _(spark, sf):
    rows = view(spark, sf, "v_loans")
    path = session.shared_folder(spark, "b5")
    # a repayment whose status changes moves from one partition to another
    loans_table = FactTable(spark, f"{path}/loans", "repayment_id", ["repayment_status"], update=True)
    for part in ("due_date < DATE '1998-07-01'", "due_date >= DATE '1998-01-01'"):
        loans_table.merge(latest.latest_per_key(rows.filter(part), ["repayment_id"], "due_date"))
    return loans_table.read().select(*LOAN_COLUMNS)


@query(
    "b6_upsert_composite",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, country_code, entity_type, transaction_type,
                   CASE WHEN {day_text('event_ts')} >= '1998-01-01' THEN count(*)
                        ELSE count(*) FILTER (transaction_status = 'SUCCESS') END AS txn_count,
                   {as_eur(f'''CASE WHEN {day_text('event_ts')} >= '1998-01-01' THEN sum({cts('amount')})
                        ELSE sum({cts('amount')}) FILTER (transaction_status = 'SUCCESS') END''')} AS total_amount_eur
            FROM v_bank GROUP BY {day_text('event_ts')}, country_code, entity_type, transaction_type
            HAVING {day_text('event_ts')} >= '1998-01-01' OR count(*) FILTER (transaction_status = 'SUCCESS') > 0"""
    ),
)
def _(spark, sf):
    facts = bank(spark, sf)
    volumes = PeriodTable(spark, f"{session.shared_folder(spark, 'b6')}/volumes")
    keys = list(gold.INDICATORS["daily_transaction_volume"].keys)
    successes = facts.filter("transaction_status = 'SUCCESS'")
    volumes.upsert(indicators.daily_transaction_volume(successes, "event_ts"), keys)
    recent = incremental.pending_rows(facts, "event_ts", "day", dt.date(1997, 12, 31))
    volumes.upsert(indicators.daily_transaction_volume(recent, "event_ts"), keys)
    return volumes.read()


@query(
    "b7_replace_period",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, sender_country AS country_code, {FLOW_COLUMNS}
            FROM v_mobile WHERE CAST(event_ts AS DATE) <> DATE '2024-01-15' OR status = 'SUCCESS' GROUP BY ALL"""
    ),
)
def _(spark, sf):
    payments = mobile(spark, sf)
    flows = FactTable(spark, f"{session.shared_folder(spark, 'b7')}/flows", "period", ["period"])
    flows.append(indicators.mobile_money_daily_flow(payments, "event_ts"))
    day = on_day(payments, "event_ts", dt.date(2024, 1, 15)).filter("status = 'SUCCESS'")
    flows.replace_partitions(indicators.mobile_money_daily_flow(day, "event_ts"))
    return flows.read()


# -- K: incremental ------------------------------------------------------------------------

MARK = dt.date(1998, 6, 30)


@query(
    "k1_pending_dates",
    oracle(f"SELECT DISTINCT {day_text('event_ts')} AS period FROM v_bank WHERE CAST(event_ts AS DATE) > DATE '{MARK}'"),
)
def _(spark, sf):
    return incremental.pending_periods(view(spark, sf, "v_bank"), "event_ts", "day", MARK)


for _grain, _mark in (("week", dt.date(1998, 6, 29)), ("month", dt.date(1998, 6, 1))):
    @query(
        f"k2_new_periods_{_grain}",
        oracle(
            f"""SELECT DISTINCT {day_text(f"date_trunc('{_grain}', event_ts)")} AS period FROM v_bank
                WHERE CAST(date_trunc('{_grain}', event_ts) AS DATE) > DATE '{_mark}'"""
        ),
    )
    def _(spark, sf, grain=_grain, mark=_mark):
        return incremental.pending_periods(view(spark, sf, "v_bank"), "event_ts", grain, mark)


# -- A, P1: raw files ------------------------------------------------------------------------


def bank_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Bank facts with all columns of the raw file, as text; reversed ones are damaged."""
    wanted = DATASETS["bank_transactions"].fields
    rows = view(spark, sf, "v_bank").withColumns(
        {
            "timestamp": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"),
            "beneficiary_account": F.col("account_id"),
            "channel": F.lit("ATM"),
            "amount": F.when(F.col("transaction_status") == "REVERSED", "n/a").otherwise(
                F.col("amount").cast("string")
            ),
            "transaction_id": F.when(F.col("transaction_type") != "DEPOSIT", F.col("transaction_id")),
        }
    )
    return rows.select(*(F.col(c).cast("string") for c in wanted))


def parsed_bank_file(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{session.shared_folder(spark, 'csv')}/bank"
    bank_rows(spark, sf).write.option("header", True).csv(folder)
    return raw_files.read_csv(spark, folder, DATASETS["bank_transactions"].columns)


@query(
    "a1_csv_permissive",
    oracle(
        f"""SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, {time_text('event_ts')} AS timestamp,
                   amount, fee_amount, country_code
            FROM v_bank WHERE transaction_status <> 'REVERSED' AND transaction_type <> 'DEPOSIT'"""
    ),
)
def _(spark, sf):
    rows = quality.sound_rows(parsed_bank_file(spark, sf), "transaction_id")
    return rows.select("transaction_id", "timestamp", "amount", "fee_amount", "country_code")


@query(
    "b13_load_metrics",
    oracle(
        """SELECT count(*) FILTER (transaction_status <> 'REVERSED' AND transaction_type <> 'DEPOSIT') AS rows_handled,
                  count(*) FILTER (transaction_status = 'REVERSED') AS rows_rejected
           FROM v_bank"""
    ),
)
def _(spark, sf):
    counts = Observation()
    parsed = parsed_bank_file(spark, sf).observe(counts, *quality.load_counts("transaction_id"))
    staged = f"{session.shared_folder(spark, 'b13')}/staged"
    quality.sound_rows(parsed, "transaction_id").write.parquet(staged)
    return spark.createDataFrame(
        [(counts.get["rows_handled"], counts.get["rows_rejected"])], "rows_handled long, rows_rejected long"
    )


def payment_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Mobile payments with all columns of the raw file, times as text."""
    wanted = DATASETS["mobile_money"].fields
    rows = view(spark, sf, "v_mobile").withColumns(
        {
            "timestamp": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
            "receiver_id": F.col("sender_id"),
            "payment_type": F.lit("P2P"),
            "operator": F.lit("WALLET"),
            "entity_type": F.lit("MOBILE_MONEY"),
        }
    )
    return rows.select(*(F.col(c).cast("string") for c in wanted))


HALF, AGAIN = dt.date(2024, 1, 16), dt.date(2024, 1, 15)
LATE = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))
ARRIVED = """arrived AS (SELECT DISTINCT sender_country AS country_code, CAST(event_ts AS DATE) AS day FROM v_mobile)"""


def deliver(spark: SparkSession, rows: DataFrame, root: str) -> None:
    """Payments as raw day files ``<country>/mobile_money/<day>/mobile_money_<country>_<day>_0001.csv``."""
    staged = session.shared_folder(spark, "staged")
    dated = rows.withColumns(
        {"_country": F.col("sender_country"), "_day": F.regexp_replace(F.left("timestamp", F.lit(10)), "-", "")}
    )
    # one file for each country and day
    dated.repartition("_country", "_day").write.partitionBy("_country", "_day").option("header", True).csv(staged)
    for country in files.children(spark, staged):
        for day in files.children(spark, f"{staged}/{country}"):
            if "=" in day:
                place, stamp = country.partition("=")[2], day.partition("=")[2]
                name = f"mobile_money_{place}_{stamp}_0001.csv"
                files.publish_single(spark, f"{staged}/{country}/{day}", f"{root}/{place}/mobile_money/{stamp}/{name}")


def on_days(rows: DataFrame, condition: str) -> DataFrame:
    return rows.filter(condition.replace("day", "CAST(timestamp AS DATE)"))


@query(
    "a4_unread_files",
    oracle(
        f"""SELECT country_code, CAST(day AS VARCHAR) AS day FROM arrived
            WHERE day >= DATE '{HALF}' OR (day = DATE '{AGAIN}' AND country_code = 'GH')""",
        ARRIVED,
    ),
)
def _(spark, sf):
    """The first half of the files is read; the others come, and one of the first once more."""
    root = session.shared_folder(spark, "a4")
    lake, rows = Lake(spark, f"{root}/lake"), payment_rows(spark, sf)
    deliver(spark, on_days(rows, f"day < DATE '{HALF}'"), f"{root}/raw")
    bronze.ingest(spark, lake, f"{root}/raw", "mobile_money")
    again = f"day = DATE '{AGAIN}' AND sender_country = 'GH'"
    deliver(spark, on_days(rows, f"day >= DATE '{HALF}' OR ({again})"), f"{root}/raw")
    left = bronze.unread_files(spark, lake, f"{root}/raw", "mobile_money")
    return raw_files.located(left).select("country_code", "day")


@query(
    "a5_arrival_coverage",
    oracle(
        f"""SELECT country_code, dataset, CAST(day AS VARCHAR) AS day, CAST(a.day IS NOT NULL AS BIGINT) AS files,
                  CASE WHEN a.day IS NULL OR (a.day NOT IN (DATE '{LATE[0]}', DATE '{LATE[1]}')
                            AND NOT (country_code = 'GH' AND a.day = DATE '{AGAIN}')) THEN 0 ELSE 1 END::BIGINT AS unread,
                  CASE WHEN a.day IS NULL THEN 'MISSING' WHEN a.day IN (DATE '{LATE[0]}', DATE '{LATE[1]}') THEN 'NEW'
                       WHEN country_code = 'GH' AND a.day = DATE '{AGAIN}' THEN 'REDELIVERED' ELSE 'READ' END AS state
           FROM (SELECT unnest(['CI', 'SN', 'ML', 'BF', 'GN', 'TG', 'BJ', 'GH']) AS country_code) c
                CROSS JOIN (SELECT unnest(['mobile_money', 'insurance_operations']) AS dataset) t
                CROSS JOIN (SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-30', TIMESTAMP '2024-02-02',
                                               INTERVAL 1 DAY)) AS DATE) AS day) d
                LEFT JOIN (SELECT *, 'mobile_money' AS dataset FROM arrived) a USING (country_code, dataset, day)""",
        ARRIVED,
    ),
)
def _(spark, sf):
    """All countries miss two days, which come after the others were read; one file comes twice."""
    root = session.shared_folder(spark, "a5")
    lake, rows = Lake(spark, f"{root}/lake"), payment_rows(spark, sf)
    late = f"day IN (DATE '{LATE[0]}', DATE '{LATE[1]}')"
    deliver(spark, on_days(rows, f"NOT {late}"), f"{root}/raw")
    bronze.ingest(spark, lake, f"{root}/raw", "mobile_money")
    again = f"day = DATE '{AGAIN}' AND sender_country = 'GH'"
    deliver(spark, on_days(rows, f"{late} OR ({again})"), f"{root}/raw")
    return bronze.arrival_report(
        spark, lake, f"{root}/raw", ["mobile_money", "insurance_operations"], dt.date(2023, 12, 30), dt.date(2024, 2, 2)
    ).drop("bytes")


def write_by_country(spark: SparkSession, rows: DataFrame, column: str, place: Callable[[str], str]) -> list[str]:
    """Raw CSV folders, one for each country; the rows are computed once for all of them."""
    staged = session.shared_folder(spark, "by-country")
    rows.withColumn("_country", F.col(column)).write.partitionBy("_country").option("header", True).csv(staged)
    folders = {f.partition("=")[2]: f"{staged}/{f}" for f in files.children(spark, staged) if f.startswith("_country=")}
    countries = sorted(c for c in folders if c != NO_VALUE)
    for country in countries:
        files.exchange(spark, folders[country], place(country))
    return countries


def write_payment_files(spark: SparkSession, sf: str, root: str) -> list[str]:
    """The payments as raw CSV folders, ``<country>/mobile_money/<day>/``."""
    rows = payment_rows(spark, sf)
    return write_by_country(spark, rows, "sender_country", lambda country: f"{root}/{country}/mobile_money/20240131")


def ingested_payments(spark: SparkSession, sf: str, label: str) -> Lake:
    root = session.shared_folder(spark, label)
    lake = Lake(spark, f"{root}/lake")
    write_payment_files(spark, sf, f"{root}/raw")
    for _ in range(2):  # the second time no file is unread
        bronze.ingest(spark, lake, f"{root}/raw", "mobile_money")
    return lake


@query("a3_file_provenance", oracle("SELECT DISTINCT sender_country AS country_code FROM v_mobile"))
def _(spark, sf):
    root = session.shared_folder(spark, "a3")
    write_payment_files(spark, sf, root)
    pattern = raw_files.file_pattern(root, DATASETS["mobile_money"])
    rows = raw_files.read_csv(spark, pattern, DATASETS["mobile_money"].columns)
    files = raw_files.located(raw_files.files_read(rows), raw_files.SOURCE_FILE)
    return files.select("country_code").distinct()


PAYMENT_SQL = f"""SELECT CAST(payment_id AS VARCHAR) AS payment_id, {time_text('event_ts')} AS timestamp,
    CAST(sender_id AS VARCHAR) AS sender_id, sender_country, receiver_country, amount, currency, status,
    fee_amount, sender_country AS country_code, {day_text('event_ts')} AS event_date"""
PAYMENT_COLUMNS = ["payment_id", "timestamp", "sender_id", "sender_country", "receiver_country", "amount",
                   "currency", "status", "fee_amount", "country_code", "event_date"]


@query("p1_bronze_ingest", oracle(f"{PAYMENT_SQL} FROM v_mobile"))
def _(spark, sf):
    return ingested_payments(spark, sf, "p1").bronze("mobile_money").read().select(*PAYMENT_COLUMNS)


@query("p1_redelivered_files", oracle(f"{PAYMENT_SQL} FROM v_mobile"))
def _(spark, sf):
    """Each country's file comes with half its rows, then under the same name with all of them."""
    root = session.shared_folder(spark, "redelivered")
    lake, rows = Lake(spark, f"{root}/lake"), payment_rows(spark, sf)
    # computed once, by all tasks: the one task that writes a file has only to copy rows
    staged = f"{root}/payments"
    rows.write.parquet(staged)
    rows = spark.read.schema(rows.schema).parquet(staged)
    countries = sorted(r[0] for r in rows.select("sender_country").distinct().collect())
    for part in (rows.filter("CAST(payment_id AS BIGINT) % 2 = 0"), rows):
        for country in countries:
            parts, stamp = f"{root}/parts-{country}", "20240131"
            mine = part.filter(F.col("sender_country") == country).coalesce(1)
            mine.write.mode("overwrite").option("header", True).csv(parts)
            name = f"mobile_money_{country}_{stamp}_01.csv"
            files.publish_single(spark, parts, f"{root}/raw/{country}/mobile_money/{stamp}/{name}")
        bronze.ingest(spark, lake, f"{root}/raw", "mobile_money")
    return lake.bronze("mobile_money").read().select(*PAYMENT_COLUMNS)


def raw_rows(spark: SparkSession, sf: str, name: str, rows: DataFrame) -> DataFrame:
    """Rows with all columns of a raw file as text; what the view hasn't got is empty."""
    known = set(rows.columns)
    if "timestamp" in DATASETS[name].fields and "timestamp" not in known:
        moment = F.col("event_ts") if "event_ts" in known else F.col("due_date").cast("timestamp")
        rows = rows.withColumn("timestamp", F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    fields = DATASETS[name].fields
    return rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast("string").alias(c) for c in fields))


def write_raw(spark: SparkSession, rows: DataFrame, name: str, root: str) -> None:
    """Raw files of a type: a folder for each country, or the one file of a referential."""
    if DATASETS[name].is_reference:
        parts = session.shared_folder(spark, "parts")
        rows.coalesce(1).write.option("header", True).csv(parts)
        files.publish_single(spark, parts, f"{root}/shared/referentials/{name}.csv")
        return
    write_by_country(spark, rows, "country_code", lambda country: f"{root}/{country}/{name}/20240131")


OTHER_TYPES = {  # view, business key, amount
    "bank_transactions": ("v_bank", "transaction_id", "amount"),
    "insurance_operations": ("v_insurance", "operation_id", "amount"),
    "loan_repayments": ("v_loans", "repayment_id", "amount_due"),
    "customers": ("v_customers", "customer_id", None),
    "accounts": ("v_accounts", "account_id", None),
    "branches": ("v_branches", "branch_id", None),
    "products": ("(SELECT p_partkey AS product_id FROM {part})", "product_id", None),
}


def _other_type_sql(name: str) -> str:
    source, key, amount = OTHER_TYPES[name]
    day = {"loan_repayments": day_text("due_date")}.get(name, day_text("event_ts")) if amount else "NULL"
    country = "country_code" if amount or name == "customers" else "NULL"
    return f"""SELECT '{name}' AS dataset, CAST({key} AS VARCHAR) AS id, {country} AS country_code,
               {day} AS event_date, {amount or 'CAST(NULL AS DOUBLE)'} AS amount FROM {source}"""


@query("p1_bronze_other_types", oracle(" UNION ALL ".join(map(_other_type_sql, OTHER_TYPES))))
def _(spark, sf):
    """The other seven types from raw files, facts by country and referentials as one file each."""
    root = session.shared_folder(spark, "p1o")
    lake, loaded = Lake(spark, f"{root}/lake", BY_DAY), []
    for name, (source, key, amount) in OTHER_TYPES.items():
        rows = view(spark, sf, source) if source.startswith("v_") else table(spark, sf, "part").withColumnRenamed("p_partkey", key)
        write_raw(spark, raw_rows(spark, sf, name, rows), name, f"{root}/raw")
        for _ in range(2):  # facts aren't read again, referentials add nothing new
            bronze.ingest(spark, lake, f"{root}/raw", name)
        stored = lake.bronze(name).read()
        day = F.col("event_date") if amount else F.lit(None).cast("date")
        loaded.append(stored.select(
            F.lit(name).alias("dataset"), F.col(key).alias("id"),
            (F.col("country_code") if "country_code" in stored.columns else F.lit(None).cast("string")).alias("country_code"),
            day.alias("event_date"), (F.col(amount) if amount else F.lit(None).cast("double")).alias("amount"),
        ))
    return reduce(DataFrame.unionByName, loaded)


def customer_table(spark: SparkSession, sf: str, lake: Lake) -> None:
    customers = view(spark, sf, "v_customers").select(
        F.col("customer_id").cast("string").alias("customer_id"), "country_code", "segment", "kyc_level"
    )
    lake.bronze("customers").append(customers)


@query(
    "p3_gold_corridors_incremental",
    oracle(CORRIDORS),
)
def _(spark, sf):
    """Bronze to silver to gold in two runs; the second adds the later weeks only."""
    lake = Lake(spark, f"{session.shared_folder(spark, 'p3')}/lake")
    customer_table(spark, sf, lake)
    payments = payment_rows(spark, sf).withColumns(
        {c: F.col(c).cast(kind) for c, kind in DATASETS["mobile_money"].fields.items()}
    ).withColumns({"country_code": F.col("sender_country"), "event_date": F.to_date("timestamp")})
    for part in ("event_date < DATE '2024-01-15'", "event_date >= DATE '2024-01-15'"):
        lake.bronze("mobile_money").merge(payments.filter(part))
        silver.refresh(lake, "mobile_money")
        gold.refresh(lake, "cross_border_transfers")
    return lake.gold("cross_border_transfers").read()


def begun_lake(spark: SparkSession, sf: str, label: str) -> Lake:
    """All payments in bronze, those up to a day in silver, and their corridors in gold."""
    lake = Lake(spark, f"{session.shared_folder(spark, label)}/lake")
    customer_table(spark, sf, lake)
    payments = payment_rows(spark, sf).withColumns(
        {c: F.col(c).cast(kind) for c, kind in DATASETS["mobile_money"].fields.items()}
    ).withColumns({"country_code": F.col("sender_country"), "event_date": F.to_date("timestamp")})
    lake.bronze("mobile_money").merge(payments.filter("event_date < DATE '2024-01-15'"))
    silver.refresh(lake, "mobile_money")
    gold.refresh(lake, "cross_border_transfers")
    lake.bronze("mobile_money").merge(payments)
    return lake


@query(
    "k1_pending_days_of_the_lake",
    oracle("SELECT DISTINCT CAST(CAST(event_ts AS DATE) AS VARCHAR) AS day FROM v_mobile WHERE event_ts >= TIMESTAMP '2024-01-15 00:00:00'"),
)
def _(spark, sf):
    days = silver.pending_days(begun_lake(spark, sf, "k1"), "mobile_money")
    return spark.createDataFrame([(d,) for d in days], "day date")


@query(
    "k2_new_periods_of_the_lake",
    oracle(
        """SELECT DISTINCT CAST(CAST(date_trunc('week', event_ts) AS DATE) AS VARCHAR) AS period FROM v_mobile
           WHERE date_trunc('week', event_ts) > (SELECT max(date_trunc('week', event_ts)) FROM v_mobile
               WHERE event_ts < TIMESTAMP '2024-01-15 00:00:00')"""
    ),
)
def _(spark, sf):
    lake = begun_lake(spark, sf, "k2")
    silver.refresh(lake, "mobile_money")
    periods = gold.new_periods(lake, "cross_border_transfers")
    return spark.createDataFrame([(d,) for d in periods], "period date")


# Bronze, silver and gold in one go.


def refined_lake(spark: SparkSession, sf: str, label: str, *names: str) -> Lake:
    lake = Lake(spark, f"{session.shared_folder(spark, label)}/lake", BY_DAY)
    for name, frame in references(spark, sf).items():
        FactTable(spark, lake.path("bronze", name), DATASETS[name].key, []).append(frame)
    sources = {
        "bank_transactions": "v_bank", "insurance_operations": "v_insurance", "loan_repayments": "v_loans",
        "mobile_money": "v_mobile",
    }
    for name in names:
        rows = quality.with_country(view(spark, sf, sources[name]), DATASETS[name].country_from)
        moment = "due_date" if "due_date" in rows.columns else "event_ts"
        stamped = rows.withColumns(
            {"timestamp": F.col(moment).cast("timestamp"), "event_date": F.to_date(moment)}
        )
        lake.bronze(name).merge(stamped)
        silver.refresh(lake, name)
    return lake


S_LOANS = silver_ctes("s_loans", "v_loans", "repayment_id", "due_date", ["amount_due"], LOAN_TIES)
S_BANK = silver_ctes("s_bank", "v_bank", "transaction_id", "event_ts", ["amount"], BANK_TIES)
S_INSURANCE = silver_ctes("s_insurance", "v_insurance", "operation_id", "event_ts", ["amount"], INSURANCE_TIES)


FIRST_LOT, SECOND_LOT = dt.date(1995, 7, 1), dt.date(1998, 1, 1)
LOT_SQL = f"""CASE WHEN due_date < DATE '{FIRST_LOT}' AND loan_type <> 'SME' THEN 1
                   WHEN due_date < DATE '{SECOND_LOT}' THEN 2 ELSE 3 END"""


@query(
    "e2_stock_of_three_refreshes",
    oracle(
        f"""SELECT {day_text('due_date')} AS period, country_code, loan_type, {half_up('d', 't', 4)} AS npl_ratio,
                   {as_eur('d')} AS encours_defaut_eur, {as_eur('t')} AS encours_total_eur
            FROM stock WHERE t IS NOT NULL AND due_date IN (SELECT due_date FROM reported r WHERE r.run = stock.run)""",
        f"daily AS (SELECT *, {LOT_SQL} AS lot FROM (SELECT due_date, country_code, loan_type, "
        f"sum(CASE WHEN repayment_status = 'DEFAULT' THEN {cts('amount_due')} ELSE 0 END) AS d, "
        f"sum({cts('amount_due')}) AS t FROM v_loans GROUP BY ALL))",
        # a run reports the days after the last one there was
        """reported AS (SELECT run, due_date FROM (SELECT unnest([1, 2, 3]) AS run) JOIN daily ON lot <= run
           WHERE due_date > coalesce((SELECT max(due_date) FROM daily WHERE lot < run), DATE '0001-01-01') GROUP BY ALL)""",
        """stock AS (SELECT run, due_date, country_code, loan_type, sum(d) OVER w AS d, sum(t) OVER w AS t
           FROM (SELECT r.run, a.due_date, g.country_code, g.loan_type FROM (SELECT unnest([1, 2, 3]) AS run) r
                 JOIN (SELECT DISTINCT due_date, lot FROM daily) a ON a.lot <= r.run
                 JOIN (SELECT DISTINCT country_code, loan_type, lot FROM daily) g ON g.lot <= r.run GROUP BY ALL) grid
                LEFT JOIN (SELECT r.run, x.* FROM (SELECT unnest([1, 2, 3]) AS run) r JOIN daily x ON x.lot <= r.run)
                USING (run, due_date, country_code, loan_type)
           WINDOW w AS (PARTITION BY run, country_code, loan_type ORDER BY due_date))""",
    ),
)
def _(spark, sf):
    """Loans come in three lots of days; all loans of one type come late, with the second.

    Each refresh reads the facts of the days that changed and reports the new days.
    """
    lake = Lake(spark, f"{session.shared_folder(spark, 'e2')}/lake", BY_DAY)
    facts = loans(spark, sf).withColumn("event_date", F.col("due_date")).withColumn("lot", F.expr(LOT_SQL))
    for lot in (1, 2, 3):
        lake.silver("loan_repayments").append(facts.filter(F.col("lot") == lot).drop("lot"))
        gold.refresh(lake, "npl_ratio_by_country")
    return lake.gold("npl_ratio_by_country").read()


@query(
    "p3_gold_npl",
    oracle(
        f"""SELECT {day_text('due_date')} AS period, country_code, loan_type, {half_up('d', 't', 4)} AS npl_ratio,
                   {as_eur('d')} AS encours_defaut_eur, {as_eur('t')} AS encours_total_eur
            FROM stock WHERE t IS NOT NULL""",
        *S_LOANS,
        *(cte.replace("FROM v_loans", "FROM s_loans") for cte in NPL_CTES),
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3n", "loan_repayments")
    gold.refresh(lake, "npl_ratio_by_country")
    return lake.gold("npl_ratio_by_country").read()


@query(
    "p3_gold_arpu",
    oracle(
        f"""SELECT CAST(month AS VARCHAR) AS period, country_code, segment,
                   {half_up('sum(fees + paid)', 'count(DISTINCT customer_id) * 100', 2)} AS arpu_eur,
                   count(DISTINCT customer_id) AS nb_customers
            FROM (SELECT coalesce(b.month, l.month) AS month, coalesce(b.country_code, l.country_code) AS country_code,
                         coalesce(b.segment, l.segment) AS segment, coalesce(b.customer_id, l.customer_id) AS customer_id,
                         coalesce(fees, 0) AS fees, coalesce(paid, 0) AS paid
                  FROM b FULL JOIN l ON b.month = l.month AND b.country_code = l.country_code
                       AND b.segment = l.segment AND b.customer_id = l.customer_id)
            WHERE month IN (SELECT month FROM b)
            GROUP BY month, country_code, segment""",
        *S_BANK,
        *S_LOANS,
        f"""b AS (SELECT CAST(date_trunc('month', event_ts) AS DATE) AS month, s_bank.country_code, segment,
                  a.customer_id, sum({cts('fee_amount')}) AS fees
           FROM s_bank LEFT JOIN v_accounts a USING (account_id)
                LEFT JOIN v_customers c ON a.customer_id = c.customer_id GROUP BY ALL)""",
        f"""l AS (SELECT CAST(date_trunc('month', due_date) AS DATE) AS month, s_loans.country_code, segment,
                  s_loans.customer_id, sum({cts('amount_paid')}) AS paid
           FROM s_loans LEFT JOIN v_customers USING (customer_id) GROUP BY ALL)""",
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3a", "bank_transactions", "loan_repayments")
    gold.refresh(lake, "customer_arpu_monthly")
    return lake.gold("customer_arpu_monthly").read()


@query(
    "p3_gold_loss_ratio",
    oracle(
        f"""SELECT {day_text('month')} AS period, country_code, product_line, {as_eur('c')} AS claims_paid_eur,
                   {as_eur('p')} AS premiums_eur, {half_up('c', 'p', 4)} AS loss_ratio
            FROM losses""",
        *S_INSURANCE,
        *(cte.replace("FROM v_insurance", "FROM s_insurance") for cte in LOSS_CTES),
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3l", "insurance_operations")
    gold.refresh(lake, "loss_ratio_by_product")
    return lake.gold("loss_ratio_by_product").read()


S_MOBILE = silver_ctes(
    "s_mobile", "v_mobile", "payment_id", "event_ts", ["amount"],
    ["sender_id", "sender_country", "receiver_country", "amount", "currency", "status", "fee_amount"],
)


@query(
    "p3_gold_volume",
    oracle(
        f"""SELECT {day_text('event_ts')} AS period, country_code, entity_type, transaction_type,
                   count(*) AS txn_count, {as_eur(f"sum({cts('amount')})")} AS total_amount_eur
            FROM s_bank GROUP BY ALL""",
        *S_BANK,
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3v", "bank_transactions")
    gold.refresh(lake, "daily_transaction_volume")
    return lake.gold("daily_transaction_volume").read()


@query(
    "p3_gold_processing_time",
    oracle(
        f"""SELECT {month_text('event_ts')} AS period, country_code, product_line,
                   {half_up('sum(processing_days)', 'count(processing_days)', 1)} AS avg_processing_days
            FROM s_insurance WHERE processing_days IS NOT NULL GROUP BY ALL""",
        *S_INSURANCE,
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3t", "insurance_operations")
    gold.refresh(lake, "claims_processing_time")
    return lake.gold("claims_processing_time").read()


@query(
    "p3_gold_mobile_flow",
    oracle(
        f"SELECT {day_text('event_ts')} AS period, sender_country AS country_code, {FLOW_COLUMNS} FROM s_mobile GROUP BY ALL",
        *S_MOBILE,
    ),
)
def _(spark, sf):
    lake = refined_lake(spark, sf, "p3f", "mobile_money")
    gold.refresh(lake, "mobile_money_daily_flow")
    return lake.gold("mobile_money_daily_flow").read()


# -- P4: report ----------------------------------------------------------------------------

REPORT_DAY = dt.date(1998, 6, 30)
REPORT_SQL = f"""SELECT '{REPORT_DAY}' AS report_date, country_code, 'NPL' AS indicator_type, loan_type AS dimension,
           {half_up('d', 't', 4)} AS value, 0.05e0 AS threshold, {half_up('d', 't', 4)} >= 0.05e0 AS breach
    FROM (SELECT country_code, loan_type, sum(CASE WHEN repayment_status = 'DEFAULT' THEN {cts('amount_due')} ELSE 0 END) AS d,
                 sum({cts('amount_due')}) AS t
          FROM v_loans WHERE due_date <= DATE '{REPORT_DAY}' GROUP BY ALL)
    UNION ALL
    SELECT '{REPORT_DAY}', country_code, 'LOSS_RATIO', product_line,
           {half_up('c', 'p', 4)}, 0.7e0, {half_up('c', 'p', 4)} > 0.7e0
    FROM losses WHERE month = DATE '{REPORT_DAY.replace(day=1)}'"""


def report_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    day = spark.createDataFrame([(REPORT_DAY,)], "period date")
    npl = indicators.npl_ratio_by_country(loans(spark, sf), periods=day)
    return npl, indicators.loss_ratio_by_product(insurance(spark, sf), "event_ts")


@query("p4_regulatory_report", oracle(REPORT_SQL, *LOSS_CTES))
def _(spark, sf):
    return regulatory.report_lines(*report_inputs(spark, sf), REPORT_DAY)


@query("p4_report_csv", oracle(REPORT_SQL, *LOSS_CTES))
def _(spark, sf):
    root = session.shared_folder(spark, "p4")
    lake = Lake(spark, f"{root}/lake")
    npl, loss = report_inputs(spark, sf)
    for name, rows in (("npl_ratio_by_country", npl), ("loss_ratio_by_product", loss)):
        lake.gold(name).upsert(rows, list(gold.INDICATORS[name].keys))
    report.publish(lake, REPORT_DAY, f"{root}/report.csv")
    columns = "report_date date, country_code string, indicator_type string, dimension string, " \
              "value double, threshold double, breach boolean"
    return spark.read.schema(columns).option("header", True).csv(f"{root}/report.csv")


@query(
    "e13_breach_count",
    oracle(f"SELECT report_date, count(*) FILTER (breach) AS breaches FROM ({REPORT_SQL}) GROUP BY ALL", *LOSS_CTES),
)
def _(spark, sf):
    return regulatory.breaches(regulatory.report_lines(*report_inputs(spark, sf), REPORT_DAY))


# -- J: alerts in batch form -----------------------------------------------------------------


def bank_events(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "v_bank_stream")


BURST_SQL = f"""SELECT 'MULTIPLE_TRANSACTIONS_THRESHOLD' AS alert_type, {time_text('w')} AS window_start,
       {time_text('w + INTERVAL 5 MINUTE')} AS window_end, account_id, country_code,
       CAST(sum(CAST(amount AS DECIMAL(20, 4))) AS DOUBLE) AS total_amount_xof, count(*) AS txn_count
FROM (SELECT *, unnest([date_trunc('minute', event_ts) - INTERVAL 1 MINUTE * i FOR i IN [0, 1, 2, 3, 4]]) AS w
      FROM v_bank_stream WHERE currency = 'XOF')
GROUP BY w, account_id, country_code HAVING sum(CAST(amount AS DECIMAL(20, 4))) > 500000"""


@query("j12_multi_txn", oracle(BURST_SQL))
def _(spark, sf):
    return alerts.multiple_transactions(bank_events(spark, sf), "event_ts")


@query("j12_large_amounts", oracle(BURST_SQL.replace("v_bank_stream", "v_bank_large").replace("DECIMAL(20, 4)", "DECIMAL(30, 4)")))
def _(spark, sf):
    return alerts.multiple_transactions(view(spark, sf, "v_bank_large"), "event_ts")


UNUSUAL_SQL = """SELECT 'UNUSUAL_COUNTRY_MOBILE_MONEY' AS alert_type, payment_id, sender_id, sender_country,
       c.country_code AS registered_country, amount, currency
FROM v_mobile JOIN v_customers c ON sender_id = c.customer_id WHERE sender_country <> c.country_code"""


@query("j13_unusual_country", oracle(UNUSUAL_SQL))
def _(spark, sf):
    return alerts.unusual_country(view(spark, sf, "v_mobile"), view(spark, sf, "v_customers"))


@query(
    "j14_claim_ratio",
    oracle(
        f"""SELECT 'CLAIM_EXCEEDS_PREMIUM_RATIO' AS alert_type, operation_id, customer_id, country_code,
                   {eur('amount')} AS claim_amount_eur, {as_eur('premium')} AS annual_premium_eur
            FROM v_insurance JOIN p USING (customer_id)
            WHERE operation_type = 'CLAIM_PAYMENT' AND claim_status = 'PAID' AND {cts('amount')} > 3 * premium""",
        PREMIUMS_CTE,
    ),
)
def _(spark, sf):
    operations = insurance(spark, sf)
    return alerts.claim_over_premiums(operations, operations, CLAIMS_TODAY, "event_ts")


AML_SQL = f"""SELECT 'AML_DECLARATIVE_THRESHOLD' AS alert_type, transaction_id, account_id, country_code, amount,
       currency, {time_text('event_ts')} AS timestamp
FROM v_bank WHERE transaction_type = 'TRANSFER'
  AND ((currency = 'XOF' AND amount > 1000000) OR (currency = 'GHS' AND amount > 5000))"""


@query("j15_aml", oracle(AML_SQL))
def _(spark, sf):
    return alerts.aml_threshold(view(spark, sf, "v_bank"), "event_ts")


def liquidity_sql(floor: float, ghs_floor: float) -> str:
    balance = """sum(CAST(CASE transaction_type WHEN 'DEPOSIT' THEN amount ELSE -amount END AS DECIMAL(20, 4)))"""
    return f"""SELECT 'LIQUIDITY_COVERAGE_BREACH' AS alert_type, {time_text("date_trunc('day', event_ts)")} AS window_start,
       {time_text("date_trunc('day', event_ts) + INTERVAL 1 DAY")} AS window_end, country_code, currency,
       CAST({balance} AS DOUBLE) AS net_balance,
       CASE currency WHEN 'GHS' THEN {ghs_floor}e0 ELSE {floor}e0 END AS min_threshold
FROM v_bank_stream GROUP BY date_trunc('day', event_ts), country_code, currency
HAVING CAST({balance} AS DOUBLE) < CASE currency WHEN 'GHS' THEN {ghs_floor}e0 ELSE {floor}e0 END"""


FLOORS = {"floors": {"GHS": -500000.0}, "default_floor": -1000000.0}


@query("j16_liquidity", oracle(liquidity_sql(-1000000, -500000)))
def _(spark, sf):
    return alerts.liquidity_breach(bank_events(spark, sf), "event_ts", **FLOORS)


@query(
    "j16_large_amounts",
    oracle(liquidity_sql(-1000000, -500000).replace("v_bank_stream", "v_bank_large").replace("DECIMAL(20, 4)", "DECIMAL(30, 4)")),
)
def _(spark, sf):
    return alerts.liquidity_breach(view(spark, sf, "v_bank_large"), "event_ts", **FLOORS)
