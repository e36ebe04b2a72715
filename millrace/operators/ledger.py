"""Transfers, ordered movements with refusals, and absolute against relative writes."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.operators.ordered import running
from millrace.scratch import written

CHUNK_ROWS = 50_000
MOST_PIECES = 100  # of a chunk's map, before it is cut


def _known(accounts: DataFrame, transfers: DataFrame) -> DataFrame:
    """Transfers with whether both their accounts are there."""
    for end in ("source", "target"):
        known = accounts.select(F.col("account").alias(end), F.lit(True).alias(f"_{end}"))
        transfers = transfers.join(known, end, "left")
    return transfers.withColumn("_both", F.col("_source").isNotNull() & F.col("_target").isNotNull())


def refused_transfers(accounts: DataFrame, transfers: DataFrame) -> DataFrame:
    """Transfers from or to an account that is not there; apply_transfers leaves them out."""
    return _known(accounts, transfers).where("not _both").select(*transfers.columns)


def apply_transfers(accounts: DataFrame, transfers: DataFrame) -> DataFrame:
    """New balances after all transfers between known accounts.

    accounts(account, balance), transfers(source, target, amount). Every transfer becomes two
    legs; legs are summed per account before they meet the accounts.
    """
    legs = _known(accounts, transfers).where("_both").select(
        F.explode(
            F.array(
                F.struct(F.col("source").alias("account"), (-F.col("amount")).alias("delta")),
                F.struct(F.col("target").alias("account"), F.col("amount").alias("delta")),
            )
        ).alias("leg")
    ).select("leg.*")
    net = legs.groupBy("account").agg(F.sum("delta").alias("_net"))
    return accounts.join(net, "account", "left").select(
        "account", (F.col("balance") + F.coalesce("_net", F.lit(0))).alias("balance")
    )


def conserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: the sums of all balances before and after, and whether they agree."""
    sums = before.agg(F.sum("balance").alias("before")).withColumn("after", after.agg(F.sum("balance")).scalar())
    return sums.withColumn("same", F.col("before").eqNullSafe(F.col("after")))


def compare_writes(accounts: DataFrame, writes: DataFrame) -> DataFrame:
    """The same log read as absolute writes (the latest wins) and as changes (all count).

    writes(account, seq, read, delta): a writer that saw `read` and meant to add `delta`.
    """
    folded = writes.groupBy("account").agg(
        F.max_by(F.col("read") + F.col("delta"), "seq").alias("_last"), F.sum("delta").alias("_sum")
    )
    out = accounts.join(folded, "account", "left").select(
        "account",
        F.coalesce("_last", "balance").alias("overwritten"),
        (F.col("balance") + F.coalesce("_sum", F.lit(0))).alias("added"),
    )
    return out.withColumn("lost", F.col("added") - F.col("overwritten"))


# --- ordered movements that may be refused ------------------------------------------------
#
# A movement is refused when it would take the balance below zero, which depends on all earlier
# ones, yet an account may be far too long for one task. So it is cut into chunks. A chunk that
# is entered with at least `needs` refuses nothing, and its effect is a plain sum; a first walk
# along an account's chunks settles all up to one that may refuse. What every later chunk does to
# any balance it may be entered with is a map of pieces (from this balance on: so much more, so
# many refused), and all maps are made at once. A map that gets too many pieces is cut into maps
# one after the other. A second walk looks each entering balance up in its map. So the number of
# jobs does not depend on how much is refused, and a task folds a chunk, never an account.


def _steps(movements: DataFrame, unit: str | None) -> DataFrame:
    """One row per all-or-nothing step: account, seq, net, and the lowest point on the way."""
    if unit is None:
        return movements.select("account", "seq", F.col("delta").alias("net"), F.col("delta").alias("low"))
    inside = running(movements, [F.col("seq")], {"_sum": F.col("delta")}, ["account", unit])
    return inside.groupBy("account", unit).agg(
        F.min("seq").alias("seq"), F.sum("delta").alias("net"), F.min("_sum").alias("low")
    )


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Decide on steps that arrive sorted by (account, chunk, at); only the balance is kept."""
    key, balance = None, 0
    for batch in batches:
        out = []
        columns = ("account", "chunk", "seq", "net", "low", "entering")
        for account, chunk, seq, net, low, entering in zip(*(batch[c].tolist() for c in columns)):
            if (account, chunk) != key:
                key, balance = (account, chunk), entering
            accepted = balance + low >= 0
            if accepted:
                balance += net
            out.append((account, seq, accepted, balance))
        yield pd.DataFrame(out, columns=["account", "seq", "accepted", "balance"])


def _decided(steps: DataFrame, chunks: DataFrame) -> DataFrame:
    """A decision for each step of the given chunks(account, chunk, entering)."""
    types = {c: steps.schema[c].dataType.simpleString() for c in ("account", "seq")}
    placed = (
        steps.join(chunks.select("account", "chunk", "entering"), ["account", "chunk"])
        .select("account", "chunk", "at", "seq", "net", "low", "entering")
        .repartition("account", "chunk")
        .sortWithinPartitions("account", "chunk", "at")
    )
    return placed.mapInPandas(_fold, f"account {types['account']}, seq {types['seq']}, accepted boolean, balance bigint")


def _walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Carry each account's balance over its chunks, sorted by (account, chunk), to the first that may refuse."""
    account, balance, settled = None, 0, True
    for batch in batches:
        entering, done = [], []
        for key, opening, net, needs in zip(*(batch[c].tolist() for c in ("account", "opening", "net", "needs"))):
            if key != account:
                account, balance, settled = key, opening, True
            # The balance is known up to the first chunk that may refuse, and not behind it.
            entering.append(balance if settled else None)
            settled = settled and balance >= needs
            done.append(settled)
            balance += net
        yield batch.assign(entering=pd.array(entering, dtype="Int64"), settled=done)


CHUNK = ["account", "chunk", "opening", "net", "needs"]


def _walked(chunks: DataFrame) -> DataFrame:
    """Chunks with their entering balance and whether they are settled; there is one row per chunk here."""
    account = chunks.schema["account"].dataType.simpleString()
    schema = f"account {account}, chunk bigint, opening bigint, net bigint, needs bigint, entering bigint, settled boolean"
    return chunks.select(*CHUNK).repartition("account").sortWithinPartitions("account", "chunk").mapInPandas(_walk, schema)


class Pieces:
    """What steps do to any balance of at least zero: from `low` on, `shift` more and `refused` steps refused."""

    def __init__(self) -> None:
        # One column a piece, and one more where the next would begin.
        self.n, self.table = 1, np.zeros((3, 64), dtype=np.int64)
        self.table[0, 1] = FAR

    low = property(lambda self: self.table[0, : self.n])
    shift = property(lambda self: self.table[1, : self.n])
    refused = property(lambda self: self.table[2, : self.n])

    def step(self, net: int, low: int) -> None:
        """A step that is refused where the balance would go below zero by `low`."""
        if low >= 0:
            self.shift[:] += net
            return
        need = -low
        least = need - self.shift  # the entering balances that it accepts
        accepts = self.low >= least
        cut = np.flatnonzero((self.table[0, 1 : self.n + 1] > least) ^ accepts)
        if len(cut):
            self._cut(cut.tolist(), least)
            accepts = self.low + self.shift >= need
        self.shift[accepts] += net
        self.refused[~accepts] += 1

    def _cut(self, pieces: list[int], at: np.ndarray) -> None:
        """Cut pieces where they begin to hold the entering balances `at`."""
        if self.n + len(pieces) + 1 > self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
        for piece in reversed(pieces):
            self.table[:, piece + 1 : self.n + 2] = self.table[:, piece : self.n + 1]
            self.table[0, piece + 1] = at[piece]
            self.n += 1

    def after(self, balance: int) -> tuple[int, int]:
        return looked_up(balance, self.low, self.shift, self.refused)


def looked_up(balance: int, low: np.ndarray, shift: np.ndarray, refused: np.ndarray) -> tuple[int, int]:
    """The balance behind a map, and the steps refused."""
    at = int(np.searchsorted(low, balance, side="right")) - 1
    return balance + int(shift[at]), int(refused[at])


FAR = 1 << 62
PIECES = ["low", "shift", "refused"]


def _maps(batches: Iterator[pa.RecordBatch], most: int, account_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Maps of chunks whose steps arrive sorted by (account, chunk, at): one, or more in a row numbered by `part`."""
    schema = pa.schema([("account", account_type), ("chunk", pa.int64()), ("part", pa.int64()), *[(n, pa.list_(pa.int64())) for n in PIECES]])
    key, part, pieces = None, 0, Pieces()

    def row() -> pa.RecordBatch:
        values = {"account": key[0], "chunk": key[1], "part": part, **{n: getattr(pieces, n) for n in PIECES}}
        return pa.RecordBatch.from_arrays([pa.array([values[f.name]], f.type) for f in schema], schema=schema)

    for batch in batches:
        for account, chunk, net, low in zip(*(batch.column(c).to_pylist() for c in ("account", "chunk", "net", "low"))):
            if (account, chunk) != key:
                if key:
                    yield row()
                key, part, pieces = (account, chunk), 0, Pieces()
            elif pieces.n > most:
                yield row()
                part, pieces = part + 1, Pieces()
            pieces.step(net, low)
    if key:
        yield row()


def _mapped(steps: DataFrame, chunks: DataFrame, most: int) -> DataFrame:
    """Rows (account, chunk, part, low, shift, refused) of the given chunks(account, chunk, net, needs)."""
    kind = steps.schema["account"].dataType
    plain = chunks.where("needs <= 0").select(
        "account", "chunk", F.lit(0).cast("long").alias("part"), F.array(F.lit(0).cast("long")).alias("low"),
        F.array("net").alias("shift"), F.array(F.lit(0).cast("long")).alias("refused"),
    )
    placed = (
        steps.join(chunks.where("needs > 0").select("account", "chunk"), ["account", "chunk"])
        .select("account", "chunk", "at", F.col("net").cast("long"), F.col("low").cast("long"))
        .repartition("account", "chunk")
        .sortWithinPartitions("account", "chunk", "at")
    )
    schema = f"account {kind.simpleString()}, chunk bigint, part bigint, low array<bigint>, shift array<bigint>, refused array<bigint>"
    folded = placed.mapInArrow(functools.partial(_maps, most=most, account_type=to_arrow_type(kind)), schema)
    return folded.union(plain)


def _walk_maps(batches: Iterator[pa.RecordBatch], account_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Look balances up in maps sorted by (account, chunk, part); the first of an account has its entering balance."""
    schema = pa.schema([("account", account_type), *[(n, pa.int64()) for n in ("chunk", "entering", "net", "refused")]])
    key, balance, entering, refused = None, 0, 0, 0
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            now = (batch.column("account")[i].as_py(), batch.column("chunk")[i].as_py())
            if now != key:
                if key:
                    out.append((*key, entering, balance - entering, refused))
                if not key or key[0] != now[0]:
                    balance = batch.column("entering")[i].as_py()
                key, entering, refused = now, balance, 0
            balance, more = looked_up(balance, *(batch.column(n)[i].values.to_numpy() for n in PIECES))
            refused += more
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if key:
        last = (*key, entering, balance - entering, refused)
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, schema)], schema=schema)


def _settled(steps: DataFrame, chunks: DataFrame, most: int) -> DataFrame:
    """Rows (account, chunk, entering, net, refused) of all chunks."""
    walked = written(_walked(chunks), "chunks")
    done = walked.where("settled").select("account", "chunk", "entering", "net", F.lit(0).cast("long").alias("refused"))
    open_ = walked.where("not settled")
    maps = written(_mapped(steps, open_, most), "maps")
    placed = (
        maps.join(open_.select("account", "chunk", "entering"), ["account", "chunk"])
        .select("account", "chunk", "part", "entering", *PIECES)
        .repartition("account")
        .sortWithinPartitions("account", "chunk", "part")
    )
    kind = steps.schema["account"].dataType
    schema = f"account {kind.simpleString()}, chunk bigint, entering bigint, net bigint, refused bigint"
    later = placed.mapInArrow(functools.partial(_walk_maps, account_type=to_arrow_type(kind)), schema)
    return done.union(later)


def apply_in_order(
    accounts: DataFrame,
    movements: DataFrame,
    unit: str | None = None,
    chunk_rows: int = CHUNK_ROWS,
    most_pieces: int = MOST_PIECES,
) -> tuple[DataFrame, DataFrame]:
    """Apply each account's movements in `seq` order, refusing what would go below zero.

    accounts(account, balance) and movements(account, seq, delta[, unit]) in whole numbers, with
    balances not below zero. Without `unit` a bad movement is undone alone; with it, all of its
    unit is undone, and a unit belongs to one account. Returns balances(account, balance,
    refused) and decisions(account, seq, accepted, balance), the latter one row per movement or
    unit. Movements of unknown accounts are left out.
    """
    steps = running(
        _steps(movements, unit), [F.col("seq")], {"at": F.lit(1), "_sum": F.col("net")}, ["account"]
    ).withColumn("chunk", F.floor((F.col("at") - 1) / chunk_rows).cast("long"))
    steps = written(steps, "steps")
    openings = accounts.select("account", F.col("balance").cast("long").alias("opening"))

    before = F.col("_sum") - F.col("net")
    sums = steps.groupBy("account", "chunk").agg(
        F.sum("net").cast("long").alias("net"),
        F.min(before + F.col("low")).alias("_lowest"),
        F.min_by(before, "at").alias("_before"),
    )
    # Steps of unknown accounts go no further than this join.
    chunks = sums.join(openings, "account").select(
        "account", "chunk", "opening", "net",
        F.greatest(F.lit(0), F.col("_before") - F.col("_lowest")).cast("long").alias("needs"),
    )
    state = written(_settled(steps, chunks, most_pieces), "settled")

    net = state.groupBy("account").agg(F.sum("net").alias("_net"), F.sum("refused").alias("_refused"))
    balances = openings.join(net, "account", "left").select(
        "account",
        (F.col("opening") + F.coalesce("_net", F.lit(0))).alias("balance"),
        F.coalesce("_refused", F.lit(0)).alias("refused"),
    )

    # Where nothing was refused the balance follows from the running sum.
    starts = steps.groupBy("account", "chunk").agg(F.min_by(before, "at").alias("_before"))
    plain = state.filter("refused = 0").select("account", "chunk", "entering").join(starts, ["account", "chunk"])
    untouched = steps.join(plain, ["account", "chunk"]).select(
        "account", "seq", F.lit(True).alias("accepted"),
        (F.col("entering") + F.col("_sum") - F.col("_before")).cast("long").alias("balance"),
    )
    return balances, untouched.unionByName(_decided(steps, state.filter("refused > 0")))
