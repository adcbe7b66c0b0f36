"""Left joins of facts with the referentials.

No side is hinted for broadcast: AQE broadcasts a referential only when its
measured size is below the threshold and otherwise shuffles both sides, splitting
the hot partitions of the fact side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def account_view(accounts: DataFrame) -> DataFrame:
    return accounts.select(
        F.col("account_id").alias("_account"),
        F.col("customer_id").alias("_holder"),
        "account_type",
        F.col("status").alias("account_status"),
    )


def customer_view(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("customer_id").alias("_customer"),
        "segment",
        F.col("kyc_level").alias("customer_kyc_level"),
    )


def branch_view(branches: DataFrame) -> DataFrame:
    return branches.select(
        F.col("branch_id").alias("_branch"), "branch_type", F.col("region").alias("branch_region")
    )


def attach(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return left.join(right, left[left_key] == right[right_key], "left").drop(right[right_key])


def enrich(facts: DataFrame, references: Mapping[str, DataFrame]) -> DataFrame:
    """Attach account, customer and branch details where they are given.

    Facts without a ``customer_id`` get it from their account.  The holder's
    details are then joined to the accounts first, which are far fewer than the
    facts, so the facts move through one large join instead of two.
    """
    accounts = references.get("accounts")
    customers = references.get("customers")
    through_account = accounts is not None and not {"customer_id", "sender_id"} & set(facts.columns)
    if accounts is not None:
        view = account_view(accounts)
        if through_account and customers is not None:
            view = attach(view, customer_view(customers), "_holder", "_customer")
        key = "account_id" if "account_id" in facts.columns else "loan_account_id"
        facts = attach(facts, view, key, "_account")
        facts = (
            facts.withColumnRenamed("_holder", "customer_id")
            if through_account
            else facts.drop("_holder")
        )
    if customers is not None and not through_account:
        owners = [c for c in ("customer_id", "sender_id") if c in facts.columns]
        if not owners:
            raise ValueError(f"no customer column among {facts.columns}")
        facts = attach(facts, customer_view(customers), owners[0], "_customer")
    if "branches" in references:
        facts = attach(facts, branch_view(references["branches"]), "branch_id", "_branch")
    return facts
