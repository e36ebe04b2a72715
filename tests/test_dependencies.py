"""Dependencies found, against brute force."""

import itertools
import random

import pytest
from conftest import rows

from millrace.operators import dependencies as D
from millrace.operators.quality import split_tables


def brute(data, columns, most):
    """Minimal keys and dependencies by looking at all sets."""
    keys, deps = [], []
    for level in range(most + 1):
        for own in itertools.combinations(range(len(columns)), level):
            names = tuple(columns[i] for i in own)
            seen = [tuple(r[i] for i in own) for r in data]
            if len(set(seen)) == len(data) and not any(set(k) <= set(names) for k in keys):
                keys.append(names)
            for other in range(len(columns)):
                if other in own or any(set(p) < set(names) and c == columns[other] for p, c in deps):
                    continue
                if len(set(seen)) == len({(s, r[other]) for s, r in zip(seen, data)}):
                    deps.append((names, columns[other]))
    return keys, deps


def minimal(deps, keys):
    return sorted(deps), sorted(keys)


@pytest.mark.parametrize("seed, some_rows", [(0, 10**6), (1, 10**6), (2, 8), (3, 8), (4, 20)])
def test_same_as_brute_force(spark, seed, some_rows):
    pick = random.Random(seed)
    columns = ["a", "b", "c", "odd `d`", "e"]
    data = []
    for i in range(60):
        a, b = pick.randrange(8), pick.choice([None, "x", "y", ""])
        data.append((a, b, None if a == 3 else a % 3, pick.randrange(2 + seed * 10), i if seed % 2 else 7))
    df = spark.createDataFrame(data, "a int, b string, c int, `odd ``d``` int, e int")
    found = D.find_dependencies(df, most=2, some_rows=some_rows)
    keys, deps = brute(data, columns, 2)
    assert sorted(found.keys) == sorted(keys)
    assert sorted(found.dependencies) == sorted(deps)


def test_small_tables(spark):
    schema = "a int, b int"
    assert D.find_dependencies(spark.createDataFrame([], schema)).keys == [()]
    one = D.find_dependencies(spark.createDataFrame([(1, None)], schema))
    assert one.keys == [()] and one.dependencies == [((), "a"), ((), "b")]
    twice = D.find_dependencies(spark.createDataFrame([(1, 2), (1, 2)], schema))
    assert twice.keys == [] and twice.dependencies == [((), "a"), ((), "b")]


ORDERS = ["order_id", "customer_id", "customer_name", "city", "product_id", "product_name", "price", "quantity"]


def orders():
    """A wide table of order lines: customers have a name and a city, products a name and a price."""
    pick = random.Random(3)
    people = {i: (f"name {i % 7}", pick.choice(["north", "south"])) for i in range(12)}
    things = {i: (f"thing {i % 9}", pick.choice([100, 200, 300])) for i in range(15)}
    out = []
    for order in range(80):
        person = pick.randrange(12)
        for thing in pick.sample(range(15), 3):
            out.append((order, person, *people[person], thing, *things[thing], pick.randrange(1, 9)))
    return out


def test_a_wide_table_of_orders(spark):
    data = orders()
    df = spark.createDataFrame(data, "order_id int, customer_id int, customer_name string, city string, product_id int, product_name string, price int, quantity int")
    found = D.find_dependencies(df)
    assert ("order_id", "product_id") in found.keys
    for one in [(("order_id",), "customer_id"), (("customer_id",), "customer_name"), (("customer_id",), "city"),
                (("product_id",), "product_name"), (("product_id",), "price"), (("order_id", "product_id"), "quantity")]:
        assert one in found.dependencies
    split = D.proposed_split(ORDERS, found)
    assert set(split["order_id"]) >= {"order_id", "customer_id"} and "customer_name" not in split["order_id"]
    assert split["customer_id"] == ["customer_id", "customer_name", "city"]
    assert split["product_id"] == ["product_id", "product_name", "price"]
    tables = split_tables(df, split)
    order = D.join_order(ORDERS, split, D.minimal_cover(found.dependencies))
    assert rows(D.rejoin_split(tables, order, ORDERS)) == sorted(set(data), key=repr)


def test_cover_and_closure():
    deps = [(("a",), "b"), (("b",), "c"), (("a",), "c"), (("a", "d"), "e"), (("a", "d"), "c")]
    assert D.closure({"a"}, deps) == {"a", "b", "c"}
    assert D.minimal_cover(deps) == [(("a",), "b"), (("b",), "c"), (("a", "d"), "e")]
    split = D.proposed_split(["a", "b", "c", "d", "e", "k"], D.Found([], [*deps, ((), "k")]))
    assert split == {"a": ["a", "b"], "b": ["b", "c"], "a_d": ["a", "d", "e", "k"]}


def test_some_rows_are_written_once_for_all_sets(spark, monkeypatch):
    """Whole groups, from one pass; what they contradict and what is found stay the same."""
    table = spark.range(6_000).selectExpr("id div 2 AS a", "id div 4 AS b", "id % 3000 AS `c d`")
    made = []
    samples = D._samples
    monkeypatch.setattr(D, "_samples", lambda *args: made.append(samples(*args)) or made[-1])
    found = D.find_dependencies(table, some_rows=500, is_written=True)
    assert found == D.find_dependencies(table, some_rows=10_000)
    assert (("a",), "b") in found.dependencies and ("a", "c d") in found.keys
    assert sorted(made[0]) == ["a", "b", "c d"]
    for c, some in made[0].items():
        assert sorted(some.collect()) == sorted(table.where(D._some(c, 12)).collect())
