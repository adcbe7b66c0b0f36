"""Datasets of the platform and the fixed values its results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values -----------------------------------------------------------------
COUNTRIES = ("CI", "SN", "ML", "BF", "GN", "TG", "BJ", "GH")
MONETARY_ZONE = ("CI", "SN", "ML", "BF", "GN", "TG", "BJ")
EUR_PER_UNIT = {"XOF": 1 / 655.957, "GHS": 1 / 13.5}

DEFAULTED = "DEFAULT"
PREMIUM = "PREMIUM_PAYMENT"
CLAIM = "CLAIM_PAYMENT"
CLAIM_SETTLED = "PAID"
PAYMENT_FAILED = "FAILED"

NPL_LIMIT = 0.05          # reached or passed: breach
LOSS_RATIO_LIMIT = 0.70   # passed: breach

BURST_LIMIT_XOF = 500_000
BURST_WINDOW = "5 minutes"
BURST_SLIDE = "1 minute"
CLAIM_TO_PREMIUM_LIMIT = 3
PREMIUM_DAYS = 365
AML_LIMITS = {"XOF": 1_000_000, "GHS": 5_000}
LIQUIDITY_FLOORS = {"GHS": -1_000_000}
LIQUIDITY_DEFAULT_FLOOR = -50_000_000

DEDUP_WATERMARK = "10 minutes"
BURST_WATERMARK = "10 minutes"
LIQUIDITY_WATERMARK = "1 hour"
TRIGGER = "30 seconds"
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Dataset:
    """One kind of input: its columns, business key and how it is refined.

    ``amounts`` starts with the main amount: rows without it are dropped.
    ``references`` names the referentials joined in silver.  ``country_from`` is
    the column that supplies ``country_code`` where the file has none.
    """

    name: str
    key: str
    columns: str
    event_column: str | None = None
    amounts: tuple[str, ...] = ()
    references: tuple[str, ...] = ()
    file_prefix: str | None = None
    country_from: str | None = None
    raw_topic: str | None = None
    silver_topic: str | None = None

    @property
    def fields(self) -> dict[str, str]:
        return dict(column.split() for column in self.columns.split(", "))

    @property
    def is_reference(self) -> bool:
        return self.event_column is None

    @property
    def partition_by(self) -> list[str]:
        has_country = "country_code" in self.fields or self.country_from
        country = ["country_code"] if has_country else []
        return country + ([] if self.is_reference else ["event_date"])

    @property
    def message_columns(self) -> str:
        """Columns of a raw message: times are text, two fields come from the publisher."""
        as_text = {"timestamp": "string", "date": "string"}
        fields = {name: as_text.get(kind, kind) for name, kind in self.fields.items()}
        fields |= {"source_file": "string", "ingestion_timestamp": "string"}
        return ", ".join(f"{name} {kind}" for name, kind in fields.items())


DATASETS = {
    dataset.name: dataset
    for dataset in (
        Dataset(
            name="bank_transactions",
            key="transaction_id",
            columns="transaction_id string, timestamp timestamp, account_id string, "
            "beneficiary_account string, branch_id string, country_code string, "
            "transaction_type string, amount double, currency string, channel string, "
            "transaction_status string, fee_amount double, entity_type string",
            event_column="timestamp",
            amounts=("amount", "fee_amount"),
            references=("accounts", "customers", "branches"),
            file_prefix="bank_txn",
            raw_topic="raw-bank-transactions",
            silver_topic="silver-bank-transactions",
        ),
        Dataset(
            name="insurance_operations",
            key="operation_id",
            columns="operation_id string, timestamp timestamp, customer_id string, "
            "account_id string, country_code string, operation_type string, "
            "product_line string, amount double, currency string, claim_status string, "
            "processing_days int, entity_type string",
            event_column="timestamp",
            amounts=("amount",),
            references=("accounts", "customers"),
            file_prefix="insurance_ops",
            raw_topic="raw-insurance-operations",
            silver_topic="silver-insurance-operations",
        ),
        Dataset(
            name="mobile_money",
            key="payment_id",
            columns="payment_id string, timestamp timestamp, sender_id string, "
            "receiver_id string, sender_country string, receiver_country string, "
            "amount double, currency string, payment_type string, operator string, "
            "status string, fee_amount double, entity_type string",
            event_column="timestamp",
            amounts=("amount", "fee_amount"),
            references=("customers",),
            file_prefix="mobile_money",
            country_from="sender_country",
            raw_topic="raw-mobile-money-payments",
            silver_topic="silver-mobile-money",
        ),
        Dataset(
            name="loan_repayments",
            key="repayment_id",
            columns="repayment_id string, timestamp timestamp, loan_account_id string, "
            "customer_id string, country_code string, amount_due double, "
            "amount_paid double, currency string, due_date date, payment_date date, "
            "days_overdue int, loan_type string, repayment_status string, entity_type string",
            event_column="due_date",
            amounts=("amount_due", "amount_paid"),
            references=("accounts", "customers"),
            file_prefix="loan_repayments",
            raw_topic="raw-loan-repayments",
            silver_topic="silver-loan-repayments",
        ),
        Dataset(
            name="customers",
            key="customer_id",
            columns="customer_id string, country_code string, entity_type string, "
            "segment string, kyc_level string, onboarding_date date, region string, "
            "is_active boolean",
        ),
        Dataset(
            name="accounts",
            key="account_id",
            columns="account_id string, customer_id string, branch_id string, "
            "country_code string, account_type string, currency string, balance double, "
            "credit_limit double, opened_date date, status string",
        ),
        Dataset(
            name="branches",
            key="branch_id",
            columns="branch_id string, country_code string, entity_type string, "
            "city string, region string, branch_type string, is_active boolean",
        ),
        Dataset(
            name="products",
            key="product_id",
            columns="product_id string, entity_type string, product_name string, "
            "is_active boolean",
        ),
    )
}

FACTS = tuple(name for name, dataset in DATASETS.items() if not dataset.is_reference)
REFERENCES = tuple(name for name, dataset in DATASETS.items() if dataset.is_reference)
STREAMED = ("bank_transactions", "insurance_operations", "mobile_money", "loan_repayments")

FRAUD_TOPIC = "gold-fraud-alerts"
AML_TOPIC = "gold-aml-events"
LIQUIDITY_TOPIC = "gold-liquidity-alerts"
REJECTED_TOPIC = "dlq-financial-events"

REPORT_COLUMNS = (
    "report_date date, country_code string, indicator_type string, dimension string, "
    "value double, threshold double, breach boolean"
)
