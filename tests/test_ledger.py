"""Ledger jobs against a plain loop."""

import random

import pytest
from conftest import rows

from millrace.operators import ledger as G


def walk(opening, movements, by_unit):
    balances, refused, decisions = dict(opening), dict.fromkeys(opening, 0), []
    steps = {}
    for account, seq, delta, unit in movements:
        if account in balances:
            steps.setdefault((account, unit if by_unit else seq), []).append((seq, delta))
    for (account, _), parts in sorted(steps.items(), key=lambda s: s[1][0][0]):
        balance, accepted = balances[account], True
        for _, delta in parts:
            balance += delta
            accepted = accepted and balance >= 0
        if accepted:
            balances[account] = balance
        else:
            refused[account] += 1
        decisions.append((account, parts[0][0], accepted, balances[account]))
    return sorted((a, balances[a], refused[a]) for a in balances), sorted(decisions, key=repr)


def tables(spark, opening, movements):
    return (
        spark.createDataFrame(list(opening.items()), "account bigint, balance bigint"),
        spark.createDataFrame(movements, "account bigint, seq bigint, delta bigint, unit bigint").repartition(5),
    )


@pytest.mark.parametrize("by_unit", [False, True])
@pytest.mark.parametrize("chunk_rows, pieces", [(9, 3), (20, 1), (50_000, 40)])
@pytest.mark.parametrize("lean", [-8, 2])
def test_in_order(spark, by_unit, chunk_rows, pieces, lean):
    rng = random.Random(lean)
    opening = {1: 100, 2: 0, 3: 50, 4: 7}
    movements = [(rng.choice([1, 1, 1, 2, 3, 5]), s, rng.randint(-50 + lean, 50 + lean), s // 25) for s in range(150)]
    balances, decisions = G.apply_in_order(*tables(spark, opening, movements), "unit" if by_unit else None, chunk_rows, pieces)
    expected = walk(opening, movements, by_unit)
    assert rows(balances) == expected[0]
    assert rows(decisions) == expected[1]


def test_known_results(spark):
    opening = {103: 0, 104: 300000, 105: 10}
    movements = [(104, 1, -5000, 1), (104, 2, -1000000, 1), (103, 3, -500000, 2)]
    alone, _ = G.apply_in_order(*tables(spark, opening, movements))
    assert rows(alone) == [(103, 0, 1), (104, 295000, 1), (105, 10, 0)]
    whole, _ = G.apply_in_order(*tables(spark, opening, movements), "unit")
    assert rows(whole) == [(103, 0, 1), (104, 300000, 1), (105, 10, 0)]


def test_transfers_keep_the_total(spark):
    accounts = spark.createDataFrame([(101, 100000), (102, 50000), (103, 0)], "account int, balance bigint")
    transfers = spark.createDataFrame([(101, 102, 30000)], "source int, target int, amount bigint")
    assert rows(G.apply_transfers(accounts, transfers)) == [(101, 70000), (102, 80000), (103, 0)]


def test_lost_update(spark):
    accounts = spark.createDataFrame([(101, 100000), (102, 5)], "account int, balance bigint")
    writes = spark.createDataFrame([(101, 2, 100000, -20000), (101, 1, 100000, -10000)], "account int, seq int, read bigint, delta bigint")
    assert rows(G.compare_writes(accounts, writes)) == [(101, 80000, 70000, -10000), (102, 5, 5, 0)]


def test_transfers_conserve(spark):
    accounts = spark.createDataFrame([(1, 100), (2, 50), (3, 0)], "account bigint, balance bigint")
    moves = spark.createDataFrame([(1, 2, 30), (1, 9, 30), (8, 2, 5), (2, 3, 70), (None, 1, 4)], "source bigint, target bigint, amount bigint")
    after = G.apply_transfers(accounts, moves)
    assert rows(after) == [(1, 70), (2, 10), (3, 70)]
    assert G.conserved(accounts, after).first().same
    assert rows(G.refused_transfers(accounts, moves)) == [(1, 9, 30), (8, 2, 5), (None, 1, 4)]


@pytest.mark.parametrize("lean", [-20, 0, 20])
def test_pieces_are_the_fold(lean):
    """A map says for every entering balance what one step after another would do."""
    rng = random.Random(lean)
    steps = []
    for _ in range(120):
        net = rng.randint(-60 + lean, 60 + lean)
        steps.append((net, min(net, rng.randint(-80, 10))))
    pieces = G.Pieces()
    for step in steps:
        pieces.step(*step)
    for entering in [*range(400), 10**6]:
        balance, refused = entering, 0
        for net, low in steps:
            if balance + low >= 0:
                balance += net
            else:
                refused += 1
        assert pieces.after(entering) == (balance, refused)


def test_jobs_do_not_grow_with_refusals(spark, monkeypatch):
    """Half of all movements of one account are refused; the tables written are as many as without refusals."""
    made = []
    monkeypatch.setattr(G, "written", lambda df, label, own=G.written: made.append(label) or own(df, label))
    rng = random.Random(5)
    counts = []
    for amounts in ([1], [-100, 1]):
        made.clear()
        movements = [(1, i, rng.choice(amounts), 0) for i in range(4000)]
        balances, decisions = G.apply_in_order(*tables(spark, {1: 50}, movements), None, 100, 20)
        expected = walk({1: 50}, movements, False)
        assert rows(balances) == expected[0] and rows(decisions) == expected[1]
        counts.append(len(made))
    assert counts[0] == counts[1] and expected[0][0][2] > 1000
