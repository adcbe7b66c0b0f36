"""Streams run to their end on the driver's tables, against the SQL of their batch form."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cowrie_checks.queries import (
    AML_SQL,
    BURST_SQL,
    BY_DAY,
    CLAIMS_TODAY,
    FLOORS,
    PREMIUMS_CTE,
    UNUSUAL_SQL,
    as_eur,
    bank_events,
    cts,
    eur,
    liquidity_sql,
    payment_rows,
    query,
    time_text,
    write_payment_files,
)
from cowrie_checks.views import oracle, table, view
from cowrie import session
from cowrie.functions import messages as msg
from cowrie.functions.money import with_eur
from cowrie.model import DATASETS, REJECTED_TOPIC
from cowrie.operators import latest, reconcile
from cowrie.plans import premiums
from cowrie.plans.ledger import Ledger
from cowrie.sources import files, raw_files
from cowrie.sources.lake import Lake
from cowrie.sources.topics import Channel
from cowrie.streaming import alerts
from cowrie.streaming import silver as stream
from cowrie.streaming.sinks import StreamTable, run, state_pieces

NOW = {"availableNow": True}


def finish(*queries) -> None:
    for running in queries:
        running.awaitTermination()


def cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def streamed_events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream."""
    source = spark.readStream.schema(table(spark, sf, "events").schema)
    return source.option("pathGlobFilter", "events.parquet").parquet(sf)


def wire_text(moment: str) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def bank_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Bank events as raw JSON messages."""
    events = bank_events(spark, sf).withColumn("timestamp", wire_text("event_ts")).drop("event_ts")
    return msg.to_messages(events)


class Platform:
    """Folders of one run: topics, lake and checkpoints."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        root = session.shared_folder(spark, label)
        self.root = root
        self.channel = Channel("parquet", {"root": f"{root}/topics"})
        self.lake = Lake(spark, f"{root}/lake", BY_DAY)
        self.checkpoints = f"{root}/checkpoints"

    def raw_to_silver(self, name: str, messages: DataFrame, folders: tuple[str, ...] = ("country_code", "event_date")) -> None:
        self.channel.write(messages, DATASETS[name].raw_topic, "all")
        finish(
            *stream.start(
                self.spark, name, self.channel, self.lake.root, self.checkpoints, NOW,
                state_partitions=cores(self.spark), folders=folders,
            )
        )

    def table(self, name: str) -> DataFrame:
        return stream.stream_table(self.lake.root, name).read(self.spark)

    def topic(self, topic: str, columns: str) -> DataFrame:
        return msg.parsed(self.channel.read(self.spark, topic), columns).select("data.*")

    def alerts(self, rule: str, messages: DataFrame, columns: str, rules=None) -> DataFrame:
        """What a rule publishes for raw messages, refined onto the silver topic first."""
        dataset = DATASETS[alerts.RULES[rule].dataset]
        refined = stream.stream_silver(messages, dataset)
        self.channel.write(msg.to_messages(refined), dataset.silver_topic, "all")
        width = state_pieces(self.spark, self.channel.folder(dataset.silver_topic))
        finish(
            alerts.start(
                self.spark, rule, self.channel, premiums.loader(self.lake, lambda: CLAIMS_TODAY), self.checkpoints, NOW,
                lambda: CLAIMS_TODAY, rules, width,
            )
        )
        return self.topic(alerts.RULES[rule].topic, columns)


STREAM_BANK_SQL = f"""SELECT transaction_id, {time_text('event_ts')} AS timestamp, account_id, country_code,
    transaction_type, amount, currency, {eur('amount')} AS amount_eur FROM v_bank_stream"""
STREAM_BANK_COLUMNS = ["transaction_id", "timestamp", "account_id", "country_code", "transaction_type",
                       "amount", "currency", "amount_eur"]


@query("j2_stream_dedup", oracle(STREAM_BANK_SQL))
def _(spark, sf):
    """Every event arrives twice in the stream."""
    events = view(spark, sf, "v_bank_stream", events=streamed_events(spark, sf))
    events = events.withColumn("timestamp", F.col("event_ts").cast("timestamp")).drop("event_ts")
    twice = stream.distinct_events(events.unionByName(events), "transaction_id")
    out = StreamTable(f"{session.shared_folder(spark, 'j2')}/events", ["country_code"])
    rows = with_eur(twice, ["amount"])
    finish(run(rows, out.write_batch, f"{out.path}/_checkpoint", "append", NOW, cores(spark)))
    return out.read(spark).select(*STREAM_BANK_COLUMNS)


TEXT_IDS = STREAM_BANK_SQL.replace("SELECT transaction_id", "SELECT CAST(transaction_id AS VARCHAR) AS transaction_id") \
    .replace(" account_id,", " CAST(account_id AS VARCHAR) AS account_id,")


@query("p5_stream_silver_bank", oracle(TEXT_IDS))
def _(spark, sf):
    platform = Platform(spark, "p5")
    messages = bank_messages(spark, sf)
    platform.raw_to_silver("bank_transactions", messages.unionByName(messages))
    return platform.table("bank_transactions").select(*STREAM_BANK_COLUMNS)


@query(
    "j17_stream_silver_mobile",
    oracle(
        f"""SELECT CAST(payment_id AS VARCHAR) AS payment_id, {time_text('event_ts')} AS timestamp,
                   CAST(sender_id AS VARCHAR) AS sender_id, sender_country, receiver_country,
                   sender_country AS country_code, amount, fee_amount, currency, status,
                   {eur('amount')} AS amount_eur, {eur('fee_amount')} AS fee_amount_eur
            FROM v_mobile"""
    ),
)
def _(spark, sf):
    platform = Platform(spark, "j17")
    platform.raw_to_silver("mobile_money", msg.to_messages(numbers(payment_rows(spark, sf))))
    return platform.table("mobile_money").select(
        "payment_id", "timestamp", "sender_id", "sender_country", "receiver_country", "country_code",
        "amount", "fee_amount", "currency", "status", "amount_eur", "fee_amount_eur",
    )


FIRST_OPERATIONS = """(SELECT * FROM v_insurance
    QUALIFY row_number() OVER (PARTITION BY operation_id, event_ts ORDER BY amount) = 1)"""


def first_operations(operations: DataFrame) -> DataFrame:
    """One row per key and time, so that which duplicate arrives first does not matter; times as text."""
    # by the time itself: its text, which says as much, needn't be shuffled
    first = latest.latest_per_key(operations.withColumn("less", -F.col("amount")), ["operation_id", "event_ts"], "less")
    return first.withColumn("timestamp", wire_text("event_ts")).drop("less", "event_ts")


@query(
    "j17_stream_silver_insurance",
    oracle(
        f"""SELECT CAST(operation_id AS VARCHAR) AS operation_id, {time_text('event_ts')} AS timestamp,
                   CAST(customer_id AS VARCHAR) AS customer_id, country_code, product_line, operation_type, claim_status,
                   processing_days, amount, currency, {eur('amount')} AS amount_eur
            FROM {FIRST_OPERATIONS}"""
    ),
)
def _(spark, sf):
    platform = Platform(spark, "j17i")
    platform.raw_to_silver("insurance_operations", msg.to_messages(first_operations(view(spark, sf, "v_insurance"))), ("event_date",))
    return platform.table("insurance_operations").select(
        "operation_id", "timestamp", "customer_id", "country_code", "product_line", "operation_type", "claim_status",
        "processing_days", "amount", "currency", "amount_eur",
    )


def numbers(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in ("amount", "fee_amount")})


MILLIS = "strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%gZ')"


@query(
    "a11_topic_table",
    oracle(
        f"""SELECT CAST(transaction_id AS VARCHAR) AS _key, CAST(transaction_id AS VARCHAR) AS transaction_id, {MILLIS} AS event_time,
                   CAST(account_id AS VARCHAR) AS account_id, CAST(NULL AS VARCHAR) AS customer_id, country_code,
                   transaction_type, amount, {eur('amount')} AS streaming_amount_eur, currency,
                   CAST(NULL AS VARCHAR) AS entity_type
            FROM v_bank_stream"""
    ),
)
def _(spark, sf):
    """The second sink of the stream, the silver topic, seen as a table."""
    platform = Platform(spark, "a11")
    platform.raw_to_silver("bank_transactions", bank_messages(spark, sf))
    topic = platform.channel.read(spark, DATASETS["bank_transactions"].silver_topic)
    return msg.as_table(topic, msg.SILVER_BANK_TABLE)


@query(
    "c11_dead_letters",
    oracle(
        """SELECT CASE transaction_type WHEN 'DEPOSIT' THEN 'no JSON: ' || transaction_id
                  ELSE '{{"account_id":' || account_id || '}}' END AS value
           FROM v_bank_stream WHERE transaction_type IN ('DEPOSIT', 'PAYMENT')"""
    ),
)
def _(spark, sf):
    """Messages that are no JSON or lack the key come back unchanged, the others do not."""
    events = bank_events(spark, sf).withColumn("timestamp", wire_text("event_ts"))
    kind = F.col("transaction_type")
    damaged = events.select(
        F.when(kind == "DEPOSIT", F.concat(F.lit("no JSON: "), F.col("transaction_id")))
        .when(kind == "PAYMENT", F.to_json(F.struct("account_id")))
        .otherwise(F.to_json(F.struct("transaction_id", "account_id", "timestamp")))
        .alias("value")
    )
    platform = Platform(spark, "c11")
    platform.raw_to_silver("bank_transactions", damaged)
    return platform.channel.read(spark, REJECTED_TOPIC).select("value")


@query(
    "a12_publish_events",
    oracle(
        f"""SELECT CAST(payment_id AS VARCHAR) AS payment_id, {time_text('event_ts')} AS timestamp, sender_country,
                   amount, fee_amount, true AS from_csv
            FROM v_mobile"""
    ),
)
def _(spark, sf):
    platform = Platform(spark, "a12")
    dataset = DATASETS["mobile_money"]
    write_payment_files(spark, sf, f"{platform.root}/raw")
    rows = raw_files.event_stream(spark, f"{platform.root}/raw/*/mobile_money/*/", dataset.columns)
    finish(stream.start_publisher(rows, dataset, platform.channel, platform.checkpoints, NOW))
    published = platform.topic(dataset.raw_topic, dataset.message_columns)
    return published.select(
        "payment_id", "timestamp", "sender_country", "amount", "fee_amount",
        F.col("source_file").endswith(".csv").alias("from_csv"),
    )


# -- P6: alert streams ------------------------------------------------------------------------

WINDOW_COLUMNS = "alert_type string, window_start timestamp, window_end timestamp, country_code string, "


@query(
    "j12_multi_txn_stream",
    oracle(BURST_SQL.replace(", account_id, country_code,", ", CAST(account_id AS VARCHAR) AS account_id, country_code,")),
)
def _(spark, sf):
    platform = Platform(spark, "j12")
    sent = platform.alerts(
        "fraud_multiple_txn",
        bank_messages(spark, sf),
        WINDOW_COLUMNS + "account_id string, total_amount_xof double, txn_count long, detected_at timestamp",
    )
    keys = ["window_start", "account_id", "country_code"]
    return latest.latest_per_key(sent, keys, "detected_at").drop("detected_at")


@query("j16_liquidity_stream", oracle(liquidity_sql(-1000000, -500000)))
def _(spark, sf):
    platform = Platform(spark, "j16")
    lower = replace(
        alerts.RULES["liquidity_alerts"],
        check=lambda events, load, today: alerts.liquidity_breach(events, **FLOORS),
    )
    sent = platform.alerts(
        "liquidity_alerts",
        bank_messages(spark, sf),
        WINDOW_COLUMNS + "currency string, net_balance double, min_threshold double, detected_at timestamp",
        {"liquidity_alerts": lower},
    )
    keys = ["window_start", "country_code", "currency"]
    return latest.latest_per_key(sent, keys, "detected_at").drop("detected_at")


@query(
    "j15_aml_stream",
    oracle(
        AML_SQL.replace("FROM v_bank ", "FROM v_bank_stream ")
        .replace("transaction_id, account_id", "CAST(transaction_id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id")
        .replace(time_text("event_ts"), MILLIS)
    ),
)
def _(spark, sf):
    platform = Platform(spark, "j15")
    return platform.alerts(
        "aml_threshold",
        bank_messages(spark, sf),
        "alert_type string, transaction_id string, account_id string, country_code string, amount double, "
        "currency string, timestamp string",
    )


@query(
    "j15_aml_beneficiary_stream",
    oracle(
        AML_SQL.replace("FROM v_bank ", "FROM v_bank_stream ")
        .replace("transaction_id, account_id", "CAST(transaction_id AS VARCHAR) AS transaction_id, "
                 "CAST(account_id AS VARCHAR) AS account_id, 'to ' || account_id AS beneficiary_account")
        .replace(time_text("event_ts"), MILLIS)
    ),
)
def _(spark, sf):
    platform = Platform(spark, "j15b")
    events = bank_events(spark, sf).withColumns(
        {"timestamp": wire_text("event_ts"), "beneficiary_account": F.concat(F.lit("to "), F.col("account_id"))}
    )
    return platform.alerts(
        "aml_threshold",
        msg.to_messages(events.drop("event_ts")),
        "alert_type string, transaction_id string, account_id string, beneficiary_account string, country_code string, "
        "amount double, currency string, timestamp string",
    )


@query(
    "j13_unusual_country_stream",
    oracle(UNUSUAL_SQL.replace("payment_id, sender_id,", "CAST(payment_id AS VARCHAR) AS payment_id, CAST(sender_id AS VARCHAR) AS sender_id,")),
)
def _(spark, sf):
    platform = Platform(spark, "j13")
    customers = view(spark, sf, "v_customers").withColumn("customer_id", F.col("customer_id").cast("string"))
    platform.lake.bronze("customers").append(customers)
    return platform.alerts(
        "fraud_unusual_country",
        msg.to_messages(numbers(payment_rows(spark, sf))),
        "alert_type string, payment_id string, sender_id string, sender_country string, "
        "registered_country string, amount double, currency string",
    )


@query(
    "j14_claim_ratio_stream",
    oracle(
        f"""SELECT 'CLAIM_EXCEEDS_PREMIUM_RATIO' AS alert_type, CAST(operation_id AS VARCHAR) AS operation_id,
                   CAST(customer_id AS VARCHAR) AS customer_id, country_code,
                   {eur('amount')} AS claim_amount_eur, {as_eur('premium')} AS annual_premium_eur
            FROM {FIRST_OPERATIONS} JOIN p USING (customer_id)
            WHERE operation_type = 'CLAIM_PAYMENT' AND claim_status = 'PAID' AND {cts('amount')} > 3 * premium""",
        PREMIUMS_CTE,
    ),
)
def _(spark, sf):
    platform = Platform(spark, "j14")
    # joined once, for the history and for the stream
    staged, operations = f"{platform.root}/operations", view(spark, sf, "v_insurance")
    operations.write.parquet(staged)
    operations = spark.read.schema(operations.schema).parquet(staged)
    history = with_eur(operations, ["amount"]).withColumns(
        {"event_date": F.to_date("event_ts"), "customer_id": F.col("customer_id").cast("string")}
    )
    platform.lake.silver("insurance_operations").append(history)
    premiums.refresh(platform.lake, CLAIMS_TODAY)
    return platform.alerts(
        "fraud_claim_ratio",
        msg.to_messages(first_operations(operations)),
        "alert_type string, operation_id string, customer_id string, country_code string, "
        "claim_amount_eur double, annual_premium_eur double",
    )


# -- several micro-batches --------------------------------------------------------------------------

# Events arrive in pieces of five days; two kinds come one and two pieces late.
PIECE_SQL = """CAST(floor((day(event_ts) - 1) / 5) AS INT)
    + CASE transaction_type WHEN 'WITHDRAWAL' THEN 2 WHEN 'INTERNATIONAL_WIRE' THEN 1 ELSE 0 END"""
PIECES = 9  # days 1 to 31 give 0 to 6, the latest come two later


def watermarks(delay: str, restarts: tuple[int, ...] = ()) -> tuple[str, ...]:
    """Parts of SQL: ``arriving`` events with their piece, and the time up to which a piece's rows are late.

    Rows are late by the watermark of the micro-batch before theirs, which knows the pieces
    before that one.  Where a run has ended in between, its last micro-batch, without rows,
    knew all pieces.
    """
    known = " ".join(f"WHEN {piece} THEN {piece - 1}" for piece in restarts)
    before = f"CASE p.piece {known} ELSE p.piece - 2 END" if known else "p.piece - 2"
    return (
        f"arriving AS (SELECT *, {PIECE_SQL} AS piece FROM v_bank_stream)",
        f"""late AS (SELECT p.piece, date_trunc('millisecond', max(a.event_ts)) - INTERVAL {delay} AS up_to
            FROM (SELECT unnest(range({PIECES})) AS piece) p LEFT JOIN arriving a ON a.piece <= {before} GROUP BY p.piece)""",
    )


def in_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return bank_events(spark, sf).withColumn("piece", F.expr(PIECE_SQL))


def raw_message(rows: DataFrame) -> DataFrame:
    return msg.to_messages(rows.withColumn("timestamp", wire_text("event_ts")).drop("event_ts", "piece"))


class Replay(Platform):
    """A stream whose topic gets as many files for each piece as there are cores; a micro-batch takes those."""

    def __init__(self, spark: SparkSession, label: str):
        super().__init__(spark, label)
        self.width = cores(spark)
        self.channel = Channel("parquet", {"root": f"{self.root}/topics", "maxFilesPerTrigger": str(self.width)})

    def send(self, messages: DataFrame, topic: str, piece: int) -> None:
        part = f"all/batch_id={piece}"
        self.channel.write(messages.repartition(self.width), topic, part)
        # a task without rows writes no file: empty ones make up the number
        folder = f"{self.channel.folder(topic)}/{part}"
        written = sum(name.startswith("part-") for name in files.children(self.spark, folder))
        if written < self.width:
            empty = self.spark.createDataFrame([], "key string, value string").coalesce(1)
            for _ in range(self.width - written):
                empty.write.format("parquet").mode("append").options(**files.MARK_DONE).save(folder)


@query(
    "j2_dedup_over_batches",
    oracle(
        f"""{TEXT_IDS.replace("FROM v_bank_stream", "FROM arriving a LEFT JOIN late USING (piece)")}
            WHERE up_to IS NULL OR event_ts > up_to""",
        *watermarks("10 MINUTE"),
    ),
)
def _(spark, sf):
    """Nine micro-batches, each with all events of the piece before once more; one run."""
    replay, events = Replay(spark, "j2b"), in_pieces(spark, sf).persist()
    topic = DATASETS["bank_transactions"].raw_topic
    for piece in range(PIECES):
        replay.send(raw_message(events.filter(F.col("piece").isin(piece, piece - 1))), topic, piece)
    finish(*stream.start(spark, "bank_transactions", replay.channel, replay.lake.root, replay.checkpoints, NOW, cores(spark)))
    events.unpersist()
    return replay.table("bank_transactions").select(*STREAM_BANK_COLUMNS)


RESTART = 5


@query(
    "j9_run_ledger",
    oracle(
        f"""SELECT piece, rows_in, rejected, late FROM (
              SELECT piece, count(*) AS rows_in, count(*) FILTER (transaction_type = 'PAYMENT') AS rejected,
                     count(*) FILTER (transaction_type <> 'PAYMENT' AND event_ts <= up_to) AS late
              FROM arriving LEFT JOIN late USING (piece) GROUP BY piece)""",
        *(part.replace("LEFT JOIN arriving a ON", "LEFT JOIN arriving a ON a.transaction_type <> 'PAYMENT' AND")
          for part in watermarks("10 MINUTE", (RESTART,))),
    ),
)
def _(spark, sf):
    """What each micro-batch took in, rejected and found late, over a stop and a restart.

    Payments come without a time: they are rejected and move no watermark.
    """
    replay, events = Replay(spark, "j9"), in_pieces(spark, sf).persist()
    topic, runs = DATASETS["bank_transactions"].raw_topic, Ledger(replay.lake)
    timed = F.when(F.col("transaction_type") != "PAYMENT", F.col("event_ts"))
    for pieces in (range(RESTART), range(RESTART, PIECES)):
        for piece in pieces:
            replay.send(raw_message(events.filter(F.col("piece") == piece).withColumn("event_ts", timed)), topic, piece)
        queries = stream.start(
            spark, "bank_transactions", replay.channel, replay.lake.root, replay.checkpoints, NOW, cores(spark)
        )
        finish(*queries)
        runs.stream("silver", queries[0])
    events.unpersist()
    taken = runs.read().filter("job = 'silver' AND rows_in > 0")
    # one row for each micro-batch
    numbered = taken.withColumn("piece", F.row_number().over(Window.partitionBy("job").orderBy("batch")) - 1)
    return numbered.select("piece", "rows_in", "rejected", "late")


@query(
    "j12_windows_over_batches",
    oracle(
        BURST_SQL.replace(", account_id, country_code,", ", CAST(account_id AS VARCHAR) AS account_id, country_code,")
        .replace("FROM v_bank_stream WHERE", "FROM arriving LEFT JOIN late USING (piece) WHERE")
        .replace("GROUP BY w,", "WHERE up_to IS NULL OR w + INTERVAL 5 MINUTE > up_to GROUP BY w,"),
        *(part.replace("FROM (SELECT unnest", "FROM (SELECT unnest").replace(
            "LEFT JOIN arriving a ON", "LEFT JOIN arriving a ON a.currency = 'XOF' AND") for part in watermarks("10 MINUTE", (RESTART,))),
    ),
)
def _(spark, sf):
    """Windows whose rows come in several micro-batches, over a restart: the last alert of each counts."""
    replay, events = Replay(spark, "j12b"), in_pieces(spark, sf).persist()
    dataset = DATASETS["bank_transactions"]
    for pieces in (range(RESTART), range(RESTART, PIECES)):
        for piece in pieces:
            refined = stream.stream_silver(raw_message(events.filter(F.col("piece") == piece)), dataset)
            replay.send(msg.to_messages(refined), dataset.silver_topic, piece)
        finish(alerts.start(
            spark, "fraud_multiple_txn", replay.channel, replay.lake.load, replay.checkpoints, NOW, state_partitions=cores(spark)
        ))
    events.unpersist()
    sent = replay.topic(
        alerts.RULES["fraud_multiple_txn"].topic,
        WINDOW_COLUMNS + "account_id string, total_amount_xof double, txn_count long, detected_at timestamp",
    )
    return latest.latest_per_key(sent, ["window_start", "account_id", "country_code"], "detected_at").drop("detected_at")


# -- topics by key and range ------------------------------------------------------------------------


@query(
    "a9_topic_range",
    oracle(
        """SELECT reading, CAST(transaction_id AS VARCHAR) AS _key, transaction_type
           FROM v_bank_stream, (SELECT unnest(['first', 'again']) AS reading)
           WHERE transaction_type IN ('DEPOSIT', 'PAYMENT')
           UNION ALL SELECT 'rest', CAST(transaction_id AS VARCHAR), transaction_type
           FROM v_bank_stream WHERE transaction_type NOT IN ('DEPOSIT', 'PAYMENT')"""
    ),
)
def _(spark, sf):
    """A range is read, new messages come, the same range is read again and then the rest."""
    platform, events = Platform(spark, "a9"), bank_events(spark, sf)
    columns, topic = {"transaction_type": ("transaction_type", "string")}, "a9"

    def send(condition: str, part: str) -> None:
        platform.channel.write(msg.to_messages(events.filter(condition), "transaction_id"), topic, part)

    def reading(name: str, since: str | None, until: str | None) -> DataFrame:
        rows = msg.as_table(platform.channel.read(spark, topic, since, until), columns)
        return rows.select(F.lit(name).alias("reading"), "_key", "transaction_type")

    send("transaction_type = 'DEPOSIT'", "writer/batch_id=0")
    send("transaction_type = 'PAYMENT'", "other/batch_id=7")
    end = platform.channel.end(spark, topic)
    first = reading("first", None, end)
    send("transaction_type NOT IN ('DEPOSIT', 'PAYMENT')", "writer/batch_id=1")
    return first.unionByName(reading("again", None, end)).unionByName(reading("rest", end, None))


@query(
    "a10_schema_drift",
    oracle(
        """SELECT * FROM (VALUES ('transaction_id', 'string', 'number', (SELECT count(*) FROM v_bank_stream), 'RETYPED'),
             ('amount', 'double', 'number', (SELECT count(*) FROM v_bank_stream WHERE transaction_type <> 'DEPOSIT'), 'SAME'),
             ('currency', 'string', 'string', (SELECT count(*) FROM v_bank_stream), 'SAME'),
             ('channel', 'string', NULL, 0, 'MISSING'),
             ('country_code', NULL, 'string', (SELECT count(*) FROM v_bank_stream WHERE transaction_type = 'TRANSFER'), 'NEW')
           ) t(field, stated, found, messages, state)"""
    ),
)
def _(spark, sf):
    """No field but two is in every message; one is stated and never sent, one sent and not stated."""
    kind = F.col("transaction_type")
    events = bank_events(spark, sf).select(
        "transaction_id", "currency",
        F.when(kind != "DEPOSIT", F.col("amount")).alias("amount"),
        F.when(kind == "TRANSFER", F.col("country_code")).alias("country_code"),
    )
    platform = Platform(spark, "a10")
    platform.channel.write(msg.to_messages(events), "a10", "all")
    stated = "transaction_id string, amount double, currency string, channel string"
    return msg.schema_drift(platform.channel.read(spark, "a10"), stated)


# -- D10 ------------------------------------------------------------------------------------------


@query(
    "d10_batch_stream_reconcile",
    oracle(
        f"""SELECT transaction_id, CAST(b IS NOT NULL AS BIGINT) AS batch_rows, CAST(s IS NOT NULL AS BIGINT) AS stream_rows,
                   {as_eur('b')} AS batch_amount_eur, {as_eur('s')} AS streaming_amount_eur,
                   {as_eur('(s - b)')} AS difference_eur,
                   CASE WHEN s IS NULL THEN 'ONLY_BATCH' WHEN b IS NULL THEN 'ONLY_STREAM'
                        WHEN s = b THEN 'SAME' ELSE 'DIFFERENT' END AS outcome
            FROM (SELECT transaction_id, {cts('amount')} AS b FROM v_bank_stream WHERE transaction_type <> 'DEPOSIT')
                 FULL JOIN
                 (SELECT transaction_id, {cts("CASE transaction_type WHEN 'PAYMENT' THEN amount * 2 ELSE amount END")} AS s
                  FROM v_bank_stream WHERE transaction_type <> 'TRANSFER') USING (transaction_id)"""
    ),
)
def _(spark, sf):
    events = bank_events(spark, sf)
    doubled = F.when(F.col("transaction_type") == "PAYMENT", F.col("amount") * 2).otherwise(F.col("amount"))
    batch = with_eur(events.filter("transaction_type <> 'DEPOSIT'"), ["amount"])
    streamed = with_eur(
        events.filter("transaction_type <> 'TRANSFER'").withColumn("amount", doubled), ["amount"]
    )
    return reconcile.reconcile(batch, streamed, "transaction_id")
