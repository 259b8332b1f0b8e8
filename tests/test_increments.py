"""Features that build on earlier runs: states, digests, sketches, buckets, stores and whole lineage."""

import random
from collections import Counter
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tablewright import lineage as L
from tablewright import plans
from tablewright import publishing as P
from tablewright.operators import digests as D
from tablewright.operators import joins as J
from tablewright.operators.diff import diff_tables
from tablewright.quality import ContractStates, contract_state, judge_state, merge_states, run_contract
from tablewright.quality.contracts import Check, Contract
from tablewright.sources.colocated import drop_bucketed, write_bucketed

# contract states

SCHEMA = "id int, k string, price double, at timestamp"
CONTRACT = Contract(
    "t",
    (
        Check("row_count", limit=(">=", 5)),
        Check("missing", ("k",)),
        Check("missing_percent", ("price",), ("<", 30)),
        Check("invalid", ("price",), options={"valid_min": 2, "valid_max": 8}),
        Check("invalid_percent", ("k",), ("<=", 50), {"valid_values": ["a", "b"]}),
        Check("min", ("price",), (">", 0)),
        Check("max", ("price",), ("<=", 9)),
        Check("duplicate", ("k",)),
        Check("duplicate", ("id", "k"), ("<", 3)),
        Check("freshness", ("at",), options={"freshness_limit": "P1D"}),
    ),
)
NOW = datetime(2024, 1, 10)


def some_rows(seed, count):
    dice = random.Random(seed)
    return [
        (dice.randint(1, 5), dice.choice([None, "a", "b", "c"]), dice.choice([None, 0.0, 1.0, 2.5, 5.0, 8.0, 9.0]), datetime(2024, 1, dice.randint(1, 9)))
        for _ in range(count)
    ]


@pytest.mark.parametrize("cuts", [[7], [0, 3, 11]])
def test_states_of_any_slices_give_the_result_of_one_run(frame, rows, cuts):
    found = some_rows(1, 20)
    whole = rows(run_contract(frame(SCHEMA, *found), CONTRACT, NOW))
    edges = [0, *cuts, len(found)]
    states = [contract_state(frame(SCHEMA, *found[a:b]), CONTRACT) for a, b in zip(edges, edges[1:])]
    together = states[0]
    for state in states[1:]:
        together = together.unionByName(state)
    assert rows(judge_state(together, CONTRACT, NOW)) == whole
    assert rows(judge_state(merge_states(together), CONTRACT, NOW)) == whole


def test_states_of_nothing(frame, rows):
    empty = frame(SCHEMA)
    assert rows(judge_state(contract_state(empty, CONTRACT), CONTRACT, NOW)) == rows(run_contract(empty, CONTRACT, NOW))
    with pytest.raises(ValueError, match="no checks"):
        contract_state(empty, Contract("none", ()))


def test_kept_states_are_read_instead_of_slices(spark, frame, folder, rows):
    """A slice that comes again takes its own place, and no slice is read for the result."""
    found = some_rows(2, 30)
    states = ContractStates(spark, folder("states"), CONTRACT)
    data = folder("slice")
    for name, own in (("a", found[:10]), ("b", found[:3]), ("c", found[20:]), ("b", found[10:20])):
        frame(SCHEMA, *own).write.mode("overwrite").parquet(data)
        states.add(name, spark.read.parquet(data))
    for file in Path(data).iterdir():
        file.unlink()
    assert rows(states.result(NOW)) == rows(run_contract(frame(SCHEMA, *found), CONTRACT, NOW))
    assert rows(states.result(NOW, ["a", "c"])) == rows(run_contract(frame(SCHEMA, *found[:10], *found[20:]), CONTRACT, NOW))


def test_a_contract_reads_a_stored_table_as_it_is(spark, frame, folder, rows):
    frame(SCHEMA, *some_rows(3, 12)).write.parquet(folder("t"))
    table = spark.read.parquet(folder("t"))
    assert rows(run_contract(table, CONTRACT, NOW, stored=True)) == rows(run_contract(table, CONTRACT, NOW))


# digests

ROWS = "k int, v string, w double"


def ranged(spark, folder, name, df, **settings):
    table = D.RangedTable(spark, folder(name), df.schema, ["k"], **{"ranges": 32, "fan": 4, **settings})
    table.write(df)
    return table


def table_rows(seed, count=300):
    dice = random.Random(seed)
    return [(dice.choice([None, *range(120)]), dice.choice([None, "", "x", "y"]), dice.choice([None, 0.5, float("nan"), 2.0])) for _ in range(count)]


def test_equal_tables_are_compared_by_one_row(spark, frame, folder):
    found = table_rows(1)
    shuffled = random.Random(2).sample(found, len(found))
    one, two = ranged(spark, folder, "a", frame(ROWS, *found)), ranged(spark, folder, "b", frame(ROWS, *shuffled).repartition(5))
    diff, read = D.diff_stored(one, two)
    assert read == [] and diff.matches()
    root = [t.digests().filter("level = 3").collect() for t in (one, two)]
    assert len(root[0]) == 1 and root[0] == root[1] and root[0][0].rows == 300


@pytest.mark.parametrize("change", ["value", "null", "lost", "repeated", "swapped", "several", "all"])
def test_only_differing_ranges_are_read(spark, frame, folder, rows, change):
    found = table_rows(3)
    other = list(found)
    if change == "value":
        other[7] = (other[7][0], "changed", 1.0)
    elif change == "null":
        other[8] = (None, None, None)
    elif change == "lost":
        other.pop(9)
    elif change == "repeated":
        other.append(other[10])
    elif change == "swapped":  # the same values in other columns' rows
        other += [(500, "p", 1.0), (500, "q", 2.0)]
        found += [(500, "q", 1.0), (500, "p", 2.0)]
    elif change == "several":
        other = [(k, "new" if k == 5 or k == 77 else v, w) for k, v, w in other]
    else:
        other = [(k, "all", w) for k, v, w in other]
    left, right = frame(ROWS, *found), frame(ROWS, *other)
    one, two = ranged(spark, folder, "a", left), ranged(spark, folder, "b", right)
    diff, read = D.diff_stored(one, two)
    whole = diff_tables(left, right)
    assert list(map(repr, rows(diff.rows))) == list(map(repr, rows(whole.rows))) and diff.rows.count() > 0
    touched = one.rows(read).count() + two.rows(read).count()
    if change in ("value", "null", "lost", "repeated", "swapped", "several"):
        assert len(read) <= 2 and touched < (len(found) + len(other)) / 4
    assert (change == "all") == (len(read) > 20)


def test_ranges_that_differ_are_pruned_from_the_scan(spark, frame, folder):
    one = ranged(spark, folder, "a", frame(ROWS, *table_rows(4)))
    plan = one.rows([3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "__range" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_tables_that_cannot_be_compared(spark, frame, folder):
    df = frame(ROWS, *table_rows(5, 10))
    one, two = ranged(spark, folder, "a", df), ranged(spark, folder, "b", df, ranges=16)
    with pytest.raises(ValueError, match="same columns"):
        D.diff_stored(one, two)
    empty = ranged(spark, folder, "c", df.limit(0))
    diff, read = D.diff_stored(empty, empty)
    assert read == [] and diff.matches()
    diff, read = D.diff_stored(one, empty)
    assert diff.rows.agg(F.sum("left_count")).first()[0] == 10


# frequent keys


def skewed(seed, count=20_000):
    dice = random.Random(seed)
    return [(dice.choice([None, 1, 1, 1, 2, 2, dice.randint(3, 5000)]),) for _ in range(count)]


@pytest.mark.parametrize("counters", [4, 50, 1 << 16])
def test_no_frequent_key_is_missed(frame, rows, counters):
    found = skewed(counters)
    df = frame("k int", *found).repartition(4)
    counts = Counter(k for k, in found if k is not None)
    hashes = {r.h: r.k for r in df.select("k", F.xxhash64("k").alias("h")).distinct().collect()}
    bounds = {hashes[r.h]: (r.at_least, r.at_most) for r in J.heavy_hitters(df, "k", counters).collect()}
    error = max(b - a for a, b in bounds.values())
    assert error <= len(found) / counters
    for key, n in counts.items():
        if n > error:
            assert key in bounds
    assert all(a <= counts[k] <= b for k, (a, b) in bounds.items())
    for more_than in (0 if counters > 5000 else int(error), 2000):
        want = sorted((k, n) for k, n in counts.items() if n > more_than)
        assert rows(J.frequent_keys(df, "k", more_than, counters)) == sorted(want, key=repr)


def test_hot_keys_of_other_number_types_still_match(frame):
    left = frame("k double, v int", *[(0.0 if i % 2 else -0.0, i) for i in range(200)], (7.0, -1), (None, -2))
    right = frame("k long, w string", (0, "zero"), (7, "seven"), (2**40, "far"))
    for counters in (1, 100):
        spread = J.spread_hot_keys(left, right, "k", "left", hot_rows=50, salts=4, counters=counters)
        assert diff_tables(left.join(right, "k", "left"), spread).matches()


# buckets

SALES = "sale_id long, artwork_id long, sale_date string, sale_price_usd long, buyer_country string"
ART = "artwork_id long, title string, artist_id long, year double, medium string, price_usd long"


def test_bucketed_sales_join_without_an_exchange(spark, frame, folder):
    dice = random.Random(1)
    sales = frame(SALES, *[(i, dice.choice([None, *range(40)]), "2024-01-01", dice.randint(1, 99), "FR") for i in range(500)])
    art = frame(ART, *[(i, f"t{i}", i % 7, 1900.0 if i % 3 else None, "oil", i % 5 * 10) for i in range(35)])
    artists = frame("artist_id long, name string, nationality string", *[(i, f" a{i} ", "DE") for i in range(6)])
    stored = plans.store_for_sales(sales, art, folder("buckets"), "colocated", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        joined = plans.sales_colocated(*stored, artists)  # the artists are measured here
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # so that the artworks could only be shuffled
        assert joined.count() == 500
        two = stored[0].join(stored[1], "artwork_id", "left")
        plan = two._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert diff_tables(plans.sales_transform(sales, art, artists, ordered=False), joined).matches()
    drop_bucketed(spark, "colocated_sales", "colocated_artworks")


def test_bucketed_tables_are_replaced(spark, frame, folder, rows):
    for own in ([(1, "a")], [(2, "b"), (None, "c")]):
        table = write_bucketed(frame("k int, v string", *own), "again", "k", 3, folder("again"))
    assert rows(table) == [(2, "b"), (None, "c")]
    drop_bucketed(spark, "again", "never_there")


# texts embedded once


@pytest.fixture
def service(folder):
    calls = Path(folder("calls"))
    calls.mkdir()

    def embed(texts):
        import uuid

        (calls / uuid.uuid4().hex).write_text("\n".join(texts))
        return [[float(len(t))] for t in texts], len(texts)

    return embed, lambda: sorted(t for f in calls.iterdir() for t in f.read_text().split("\n"))


def test_each_text_is_paid_for_once(frame, folder, rows, service):
    embed, sent = service
    df = frame("id int, text string", (1, "one"), (2, "three"), (3, "one"), (4, None), (5, ""))
    made = P.embed_once(df, "text", embed, "m", folder("store"))
    assert sent() == ["", "one", "three"]
    want = [(1, "one", [3.0]), (2, "three", [5.0]), (3, "one", [3.0]), (4, None, None), (5, "", [0.0])]
    for _ in range(2):  # actions do not send anything
        assert rows(made.select("id", "text", "embedding")) == want and made.count() == 5
    assert sent() == ["", "one", "three"]
    more = P.embed_once(df.unionByName(frame("id int, text string", (6, "new"))), "text", embed, "m", folder("store"))
    assert rows(more.select("id", "text", "embedding")) == [*want, (6, "new", [3.0])] and sent() == ["", "new", "one", "three"]
    P.embed_once(df, "text", embed, "other", folder("store"))  # another model has vectors of its own
    assert sent() == ["", "", "new", "one", "one", "three", "three"]
    assert P.embed_once(df.limit(0), "text", embed, "m", folder("store")).count() == 0


def test_a_failed_run_stores_nothing(frame, folder, rows, service):
    embed, sent = service

    def broken(texts):
        raise RuntimeError("out of order")

    df = frame("id int, text string", (1, "one"))
    with pytest.raises(Exception, match="out of order"):
        P.embed_once(df, "text", broken, "m", folder("store"), retry_wait=0)
    assert rows(P.embed_once(df, "text", embed, "m", folder("store")).select("embedding")) == [([3.0],)] and sent() == ["one"]


# whole lineage


def plain_closure(edges):
    ways = {(a, b): 1 for a, b in edges}
    for _ in range(40):
        for (a, b), n in list(ways.items()):
            for c, d in edges:
                if b == c and ways.get((a, d), 99) > n + 1:
                    ways[a, d] = n + 1
    return ways


@pytest.mark.parametrize("seed", range(3))
def test_lineage_over_many_tables(spark, rows, seed):
    dice = random.Random(seed)
    chain = [((f"t{i}", "c"), (f"t{i + 1}", "c")) for i in range(20)]
    edges = chain + [((f"t{dice.randint(0, 20)}", dice.choice("cd")), (f"t{dice.randint(0, 20)}", dice.choice("cd"))) for _ in range(15)]
    df = spark.createDataFrame([(*a, *b, "computed") for a, b in edges] + [("t1", "c", None, "c", "computed")], L.edges.EDGE_SCHEMA)
    made = {a for a, _ in edges}
    want = sorted(((*a, *b, n, b not in made) for (a, b), n in plain_closure(set(edges)).items()), key=repr)
    assert rows(L.whole_lineage(df)) == want


def test_failures_reach_each_root_once(spark, frame, rows):
    edges = L.column_lineage(spark, "b", computed={"x": [("a", "p"), ("a", "q")], "y": [("a", "p")]})
    edges = edges.unionByName(L.column_lineage(spark, "c", computed={"z": [("b", "x"), ("b", "y")]}))
    report = frame("table string, column string, check string, failures long", ("c", "z", "null", 3), ("b", "y", "null", 2), ("d", "w", "null", 1))
    assert rows(L.trace_to_roots(edges, report)) == [("a", "p", "null", 5, 2), ("a", "q", "null", 3, 1), ("d", "w", "null", 1, 1)]
