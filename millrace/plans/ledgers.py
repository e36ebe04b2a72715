"""Transfers, refusals and lost updates (G1-G3) over the events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import ledger as G
from millrace.plans.registry import query
from millrace.sources.tables import Tables

# Opening balance of every account, in cents.
OPENING = 10_000


def _cents() -> Column:
    return F.round(F.col("value") * 100).cast("bigint")


def _movements(t: Tables) -> DataFrame:
    """Purchases and errors take money out, other events bring it in; a user's day is a unit."""
    out = F.col("event_type").isin("purchase", "error")
    return t.events.select(
        F.col("user_id").alias("account"),
        F.col("event_id").alias("seq"),
        F.when(out, -_cents()).otherwise(_cents()).alias("delta"),
        F.to_date("ts").alias("unit"),
    )


def _accounts(t: Tables) -> DataFrame:
    return t.events.select(F.col("user_id").alias("account")).distinct().withColumn("balance", F.lit(OPENING).cast("bigint"))


_LOG = """log AS (
  SELECT user_id AS account, event_id AS seq, CAST(ts AS DATE) AS unit,
         CASE WHEN event_type IN ('purchase', 'error') THEN -1 ELSE 1 END * CAST(round(value * 100) AS BIGINT) AS delta
  FROM events)"""


@query(f"""
WITH legs AS (
  SELECT user_id AS account, -CAST(round(value * 100) AS BIGINT) AS delta FROM events
  UNION ALL SELECT xor(user_id, 1), CAST(round(value * 100) AS BIGINT) FROM events)
SELECT account, CAST({OPENING} + SUM(delta) AS BIGINT) AS balance FROM legs GROUP BY 1""")
def transfers_applied(t: Tables) -> DataFrame:
    """Every event is a transfer to the user whose number differs in the last bit."""
    transfers = t.events.select(
        F.col("user_id").alias("source"), F.col("user_id").bitwiseXOR(F.lit(1)).alias("target"), _cents().alias("amount")
    )
    ids = transfers.select(F.explode(F.array("source", "target")).alias("account")).distinct()
    return G.apply_transfers(ids.withColumn("balance", F.lit(OPENING).cast("bigint")), transfers)


@query(f"""
WITH known AS (SELECT DISTINCT user_id FROM events)
SELECT CAST({OPENING} * COUNT(*) AS BIGINT) AS before, CAST({OPENING} * COUNT(*) AS BIGINT) AS after, TRUE AS same,
       (SELECT COUNT(*) FROM events WHERE xor(user_id, 1) NOT IN (SELECT user_id FROM known)) AS refused
FROM known""")
def transfers_conserved(t: Tables) -> DataFrame:
    """Money in all accounts before and after, and the transfers to users that are not there."""
    accounts = _accounts(t)
    transfers = t.events.select(
        F.col("user_id").alias("source"), F.col("user_id").bitwiseXOR(F.lit(1)).alias("target"), _cents().alias("amount")
    )
    refused = G.refused_transfers(accounts, transfers).agg(F.count("*")).scalar()
    return G.conserved(accounts, G.apply_transfers(accounts, transfers)).withColumn("refused", refused)


# One row per step of each account, in order.
_STEPS = """steps AS (SELECT account, seq, delta, delta AS low, row_number() OVER (PARTITION BY account ORDER BY seq) AS n FROM log)"""
_UNITS = """sums AS (SELECT *, SUM(delta) OVER (PARTITION BY account, unit ORDER BY seq) AS so_far FROM log),
units AS (SELECT account, MIN(seq) AS seq, CAST(SUM(delta) AS BIGINT) AS delta, CAST(MIN(so_far) AS BIGINT) AS low FROM sums GROUP BY account, unit),
steps AS (SELECT *, row_number() OVER (PARTITION BY account ORDER BY seq) AS n FROM units)"""
_WALK = f"""walk AS (
  SELECT account, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS seq, TRUE AS accepted, CAST({OPENING} AS BIGINT) AS balance
  FROM (SELECT DISTINCT account FROM log)
  UNION ALL
  SELECT s.account, s.n, s.seq, w.balance + s.low >= 0, CASE WHEN w.balance + s.low >= 0 THEN w.balance + s.delta ELSE w.balance END
  FROM walk w JOIN steps s ON s.account = w.account AND s.n = w.n + 1)"""
_BALANCES = """
SELECT account, arg_max(balance, n) AS balance, COUNT(*) FILTER (NOT accepted) AS refused FROM walk GROUP BY 1"""
_DECISIONS = "SELECT account, seq, accepted, balance FROM walk WHERE n > 0"


@query(f"WITH RECURSIVE {_LOG}, {_STEPS}, {_WALK} {_BALANCES}")
def ledger_balances(t: Tables) -> DataFrame:
    return G.apply_in_order(_accounts(t), _movements(t))[0]


@query(f"WITH RECURSIVE {_LOG}, {_STEPS}, {_WALK} {_DECISIONS}")
def ledger_decisions(t: Tables) -> DataFrame:
    return G.apply_in_order(_accounts(t), _movements(t))[1]


@query(f"WITH RECURSIVE {_LOG}, {_UNITS}, {_WALK} {_BALANCES}")
def ledger_units(t: Tables) -> DataFrame:
    return G.apply_in_order(_accounts(t), _movements(t), unit="unit")[0]


@query(f"""
WITH {_LOG}
SELECT account, CAST({OPENING} + arg_max(delta, seq) AS BIGINT) AS overwritten, CAST({OPENING} + SUM(delta) AS BIGINT) AS added,
       CAST(SUM(delta) - arg_max(delta, seq) AS BIGINT) AS lost
FROM log GROUP BY 1""")
def writes_compared(t: Tables) -> DataFrame:
    """Every writer saw the opening balance."""
    writes = _movements(t).withColumn("read", F.lit(OPENING).cast("bigint"))
    return G.compare_writes(_accounts(t), writes)
