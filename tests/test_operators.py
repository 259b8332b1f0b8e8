"""Table operators: shapes, joins, aggregates, windows, SQL and chains."""

import random

import pytest
from pyspark.sql import functions as F

from tablewright.errors import MissingColumn
from tablewright.operators import aggregates as A
from tablewright.operators import columns as C
from tablewright.operators import filters
from tablewright.operators import joins as J
from tablewright.operators import ordering as O
from tablewright.operators import windows as W
from tablewright.operators.chain import (
    AggregateStep,
    Chain,
    FilterStep,
    JoinStep,
    SqlStep,
    TextStep,
    WindowStep,
)
from tablewright.operators.diff import diff_tables
from tablewright.operators.sql import SqlSteps, sql_to_parquet, sql_transform


# --- columns and filters ---------------------------------------------------


def test_rename_keep_drop_copy(frame):
    df = frame("old_name string, title string, internal_id string", ("value1", "Art", "abc"))
    renamed = C.rename(df, {"old_name": "new_name", "title": "artwork_title"})
    assert renamed.columns == ["new_name", "artwork_title", "internal_id"]
    assert C.keep_only(df, ["title", "old_name"]).columns == ["title", "old_name"]
    assert C.drop_columns(df, ["internal_id"]).columns == ["old_name", "title"]
    assert C.copy_column(df, "title", "display").columns[-1] == "display"
    with pytest.raises(MissingColumn) as error:
        C.keep_only(df, ["nope"])
    assert "old_name" in str(error.value)


def test_drop_null_columns(frame):
    df = frame("id int, `empty.col` string, title string", (1, None, "Art"), (2, None, None))
    assert C.drop_null_columns(df).columns == ["id", "title"]


def test_move_renamed_last_and_replace_in_place(frame):
    df = frame("a int, b int, c int", (1, 2, 3))
    assert C.move_renamed_last(df, {"a": "first"}).columns == ["b", "c", "first"]
    replaced = C.replace_in_place(df, {"b": "b * 10"})
    assert replaced.columns == ["a", "b", "c"] and replaced.first().b == 20


def test_explode_with_and_without_empty(frame, rows):
    df = frame("id int, tags array<string>", (1, ["a", "b"]), (2, []), (3, None))
    assert rows(C.explode_list(df, "tags")) == [(1, "a"), (1, "b")]
    assert rows(C.explode_list(df, "tags", keep_empty=True)) == [
        (1, "a"), (1, "b"), (2, None), (3, None)
    ]


def test_transform_text(frame, rows):
    df = frame("s string", (" aB ",))
    got = {h: rows(C.transform_text(df, "s", h))[0][0] for h in C.TEXT_TRANSFORMS}
    assert got == {"upper": " AB ", "lower": " ab ", "title": " Ab ", "strip": "aB"}
    with pytest.raises(ValueError):
        C.transform_text(df, "s", "reverse")


def test_drop_rows_also_drops_unknown(frame, rows):
    df = frame(
        "status string, price int",
        ("active", 100), ("deleted", 50), ("active", -10), ("deleted", 200), (None, 5),
    )
    assert rows(filters.drop_rows(df, "status = 'deleted' OR price < 0")) == [("active", 100)]


def test_other_filters(frame, rows):
    df = frame("s string, n int", ("a", 1), ("b", None), (None, 40_000_000))
    assert rows(filters.keep_members(df, "s", ["a", "z"])) == [("a", 1)]
    assert rows(filters.drop_nulls(df, "s")) == [("a", 1), ("b", None)]
    assert rows(filters.drop_nulls(df)) == [("a", 1)]
    assert rows(filters.high_value(df, "n")) == [(None, 40_000_000)]
    assert rows(filters.contains_rows(df, "s", "b")) == [("b", None)]


# --- joins -----------------------------------------------------------------


@pytest.fixture
def sales(frame):
    return frame(
        "sale_id int, artwork_id int, price int",
        (1, 101, 100_000), (2, 102, 250_000), (3, 101, 150_000), (4, 104, 50_000), (5, None, 1),
    )


@pytest.fixture
def artworks(frame):
    return frame("artwork_id int, title string", (101, "A"), (102, "B"), (103, "C"))


def test_semi_anti_orphans(sales, artworks, rows):
    assert [r[0] for r in rows(J.semi_join(sales, artworks, "artwork_id"))] == [1, 2, 3]
    assert [r[0] for r in rows(J.anti_join(sales, artworks, "artwork_id"))] == [4, 5]
    assert rows(J.orphan_keys(sales, artworks, "artwork_id").dropna()) == [(104,)]


def test_not_in_is_null_aware(spark, frame, rows):
    child = frame("k int", (1,), (3,), (None,), (3,))
    for parent in (frame("k int", (1,), (2,)), frame("k int", (1,), (None,)), frame("k int")):
        child.createOrReplaceTempView("c")
        parent.createOrReplaceTempView("p")
        expected = spark.sql("SELECT DISTINCT k FROM c WHERE k NOT IN (SELECT k FROM p)")
        assert rows(J.not_in_keys(child, parent, "k")) == rows(expected)


def test_full_join_coalesces_the_key(frame, rows):
    left, right = frame("k int, a int", (1, 10), (2, 20)), frame("k int, b int", (2, 200), (3, 300))
    assert rows(J.full_join(left, right, "k")) == [(1, 10, None), (2, 20, 200), (3, None, 300)]


def test_join_chain_aliases(sales, artworks, frame, rows):
    artists = frame("title string, artist string", ("A", "Monet"))
    out = J.join_chain(
        sales,
        [(artworks, "artwork_id", "artwork_id"), (artists, "b.title", "title")],
        ["a.sale_id", "b.title", "c.artist"],
    )
    assert rows(out)[:2] == [(1, "A", "Monet"), (2, "B", None)]
    assert J.join_chain(sales, [(artworks, "artwork_id", "artwork_id")], how="inner").count() == 3
    with pytest.raises(ValueError):
        J.join_chain(sales, [], how="sideways")


def test_join_chain_has_no_end(spark):
    tables = [spark.range(2).withColumnRenamed("id", f"k{i}") for i in range(30)]
    out = J.join_chain(
        spark.range(3), [(t, "id", f"k{i}") for i, t in enumerate(tables)], ["a.id", "ad.k28", "ae.k29"]
    )
    assert sorted(tuple(r) for r in out.collect() if r.k28 is not None) == [(0, 0, 0), (1, 1, 1)]
    chained = J.join_chain(spark.range(3), [(tables[0], "id", "k0"), (tables[1], "b.k0", "k1")], ["id", "c.k1"])
    assert chained.count() == 3


@pytest.mark.parametrize("how", ["full", "right"])
def test_lookup_keeps_the_key_of_either_side(frame, rows, how):
    left, right = frame("k int, x string", (1, "a"), (2, "b")), frame("id int, y string", (2, "B"), (3, "C"))
    found = rows(J.lookup(left, right, "k", "id", ["y"], how=how))
    assert (3, None, "C") in found and (2, "b", "B") in found
    assert ((1, "a", None) in found) == (how == "full")
    with pytest.raises(ValueError):
        J.lookup(left, right, "k", "id", ["y"], how="sideways")


def test_hot_keys_are_spread_in_one_read(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    left = spark.range(1000).selectExpr("if(id < 600, 1, id) k", "id v").mapInPandas(count, "k long, v long")
    right = spark.range(1000).selectExpr("id k", "id * 2 w")
    out = J.spread_hot_keys(left, right, "k", hot_rows=100, salts=4)
    assert out.count() == 1000
    # once for the count of its keys, once for the join
    assert seen.value == 2000


def test_empty_tables_have_no_distinct_values(frame, rows):
    df = frame("v int, f boolean").limit(0)
    assert rows(df.agg(A.distinct_count("v"))) == [(0,)]
    assert rows(A.summarise(df, distinct=["v"])) == [(0, 0)]


def test_names_with_dots(frame, rows):
    df = frame("`a.b` int, c int", (None, 1), (2, None))
    assert rows(A.null_counts(df)) == [(1, 1)]
    assert diff_tables(df, df).matches() and not diff_tables(df, df.limit(1)).matches()


def test_lookup_renames_clashes(frame, rows):
    left = frame("id int, artist_id int", (1, 100), (2, 101), (3, 100), (4, 9))
    right = frame("id int, artist_name string, extra int", (100, "Monet", 0), (101, "Van Gogh", 0))
    out = J.lookup(left, right, "artist_id", "id", ["id", "artist_name"])
    assert out.columns == ["id_x", "artist_id", "id_y", "artist_name"]
    assert rows(out) == [
        (1, 100, 100, "Monet"), (2, 101, 101, "Van Gogh"), (3, 100, 100, "Monet"), (4, 9, None, None)
    ]
    assert J.lookup(left, right, "artist_id", "id", ["artist_name"], how="inner").count() == 3


def test_aggregate_then_join_keeps_rows_single(frame, rows):
    left, right = frame("k int", (1,), (2,)), frame("k int, v int", (1, 5), (1, 6))
    assert rows(J.aggregate_then_join(left, right, "k", {"total": "sum(v)"})) == [(1, 11), (2, None)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_hot_keys_equals_plain_join(frame, how):
    # key 1 holds a third of all rows, most of them exact copies; null is hot as well
    data = [(1, 0)] * 120 + [(None, i) for i in range(60)] + [(i, i) for i in range(2, 180)]
    left = frame("k int, a int", *data)
    right = frame("k int, b int", *[(i, -i) for i in range(0, 150)], (1, 7), (None, 8))
    spread = J.spread_hot_keys(left, right, "k", how, hot_rows=40, salts=4)
    assert diff_tables(left.join(right, "k", how), spread).matches()


def test_spread_hot_keys_without_any(frame):
    left, right = frame("k int, a int", (1, 1), (2, 2)), frame("k int, b int", (1, 1))
    assert diff_tables(left.join(right, "k", "left"), J.spread_hot_keys(left, right, "k")).matches()
    with pytest.raises(ValueError):
        J.spread_hot_keys(left, right, "k", "full")


# --- aggregates ------------------------------------------------------------


def test_aggregate_and_value_counts(sales, rows):
    out = A.aggregate(sales, "artwork_id", {"n": "count(*)", "total": "sum(price)"})
    assert (101, 2, 250_000) in rows(out)
    assert rows(A.aggregate(sales, [], {"n": "count(*)"})) == [(5,)]
    assert (101, 2) in rows(A.value_counts(sales, "artwork_id"))
    with pytest.raises(ValueError):
        A.aggregate(sales, "artwork_id", {})


def test_sales_per_item(frame, rows):
    sales = frame("k int, p long, d string", (1, 10, "2020-01-02"), (1, 15, "2019-05-01"))
    assert rows(A.sales_per_item(sales, "k", "p", "d")) == [
        (1, 2, 25, 13.0, "2019-05-01", "2020-01-02")
    ]


def test_ordered_structs_and_parts(frame, rows):
    df = frame(
        "k int, o int, f string", (1, 3, "c"), (1, 1, "a"), (1, None, "z"), (1, 2, "b"), (2, 1, "x")
    )
    assert rows(A.ordered_structs(df, "k", "o", ["f", "o"], "l")) == [
        (1, [("a", 1), ("b", 2), ("c", 3), ("z", None)]), (2, [("x", 1)])
    ]
    for limit in (1_000_000, 1):
        parts = A.ordered_struct_parts(
            df, "k", ["o", "f"], ["o", "f"], "l", part_rows=3, single_task_rows=limit
        )
        assert rows(parts) == [
            (1, 0, [(1, "a"), (2, "b"), (3, "c")]), (1, 1, [(None, "z")]), (2, 0, [(1, "x")])
        ]


def test_first_where_takes_one_row(frame, rows):
    df = frame(
        "k int, o int, f string, a string",
        (1, 1, "b", None), (1, 1, "c", "second"), (1, 2, "a", "x"), (2, 2, "d", "y"),
    )
    out = A.first_where(df, "k", {"image": "f", "alt": "a"}, "o = 1", ["f"])
    assert rows(out) == [(1, "b", None), (2, None, None)]


def test_implode_keeps_nulls(frame, rows):
    df = frame(
        "artwork_id int, tag string",
        (1, "oil"), (1, "portrait"), (2, "landscape"), (2, None), (2, "nature"),
    )
    assert rows(A.implode(df, "artwork_id", "tag")) == [
        (1, ["oil", "portrait"]), (2, ["landscape", "nature", None])
    ]


def test_ordered_text_and_list(frame, rows):
    df = frame("k int, t string, y int", (1, "old", 1900), (1, "new", 2000))
    assert rows(A.ordered_text(df, "k", "t", ["y DESC"], "titles", "; ")) == [(1, "new; old")]
    assert rows(A.ordered_list(df, "k", "t", "y", "titles")) == [(1, ["old", "new"])]


def test_group_total(frame, rows):
    df = frame("c string, amount int", ("A", 10), ("B", 20), ("A", 30), ("B", 40), (None, 50))
    assert rows(A.group_total(df, "c", "amount", "total")) == [
        ("A", 10, 40), ("A", 30, 40), ("B", 20, 60), ("B", 40, 60), (None, 50, 50)
    ]


def test_distinct_count_and_summary(frame, rows):
    df = frame("v int, f boolean", (1, True), (None, False), (1, None))
    counts = df.agg(A.distinct_count("v"), A.distinct_count("v", count_null=False))
    assert rows(counts) == [(2, 1)]
    summary = A.summarise(df, sums=["v"], ranges=["v"], distinct=["v"], flags=["f"])
    assert rows(summary) == [(3, 2, 1, 1, 2, 1, 1)]
    assert rows(A.null_counts(df)) == [(1, 1)]


# --- windows ---------------------------------------------------------------


@pytest.fixture(scope="module")
def ranked(spark):
    """400 rows; one group and one value hold more than a third of them."""
    rng = random.Random(7)
    data = [
        (i, rng.choice(["a", "a", "b", None]), rng.choice([1, 1, 1, 2, 3, 5, None]), rng.choice([None, 0, 1, 8]),
         rng.choice([float("nan"), -0.5, 2.0, 7.25, None]))
        for i in range(400)
    ]
    # nothing to add up for the first order values, in either direction
    data = [(i, g, v, None if v in (1, None) or v == 5 else w, x) for i, g, v, w, x in data]
    return spark.createDataFrame(data, "id long, g string, v int, w int, x double").repartition(40)


@pytest.mark.parametrize("limit", [1_000_000, 90, 3])
def test_windows_without_one_task(ranked, limit):
    out = W.number_rows(ranked, ["v desc", "id"], "n", ["g"], single_task_rows=limit)
    out = W.number_rows(out, ["v", "id"], "nn", single_task_rows=limit)
    out = W.rank_rows(out, "v", "r", single_task_rows=limit)
    out = W.rank_rows(out, "v", "ra", descending=False, single_task_rows=limit)
    out = W.running_total(out, "v", {"s": "w"}, ["g"], single_task_rows=limit)
    out = W.running_total(out, "v desc", {"ss": "w"}, single_task_rows=limit)
    out = W.rank_rows(out, "x", "rx", single_task_rows=limit)
    out = W.running_total(out, "x", {"sx": "w", "xx": "x"}, ["g"], single_task_rows=limit)
    out = W.running_total(out, "id", {"si": "w"}, single_task_rows=limit)
    out = W.group_measures(out, "g", {"gc": "count(*)", "gs": "sum(w)"})
    last = "NULLS LAST"
    expected = ranked.selectExpr(
        "*",
        f"row_number() over (partition by g order by v desc {last}, id) n",
        f"row_number() over (order by v {last}, id) nn",
        f"rank() over (order by v desc {last}) r",
        f"rank() over (order by v {last}) ra",
        f"sum(w) over (partition by g order by v {last}) s",
        f"sum(w) over (order by v desc {last}) ss",
        f"rank() over (order by x desc {last}) rx",
        f"sum(w) over (partition by g order by x {last}) sx",
        f"sum(x) over (partition by g order by x {last}) xx",
        f"sum(w) over (order by id {last}) si",
        "count(*) over (partition by g) gc",
        "sum(w) over (partition by g) gs",
    )
    assert dict(out.dtypes)["r"] == "bigint"
    found = diff_tables(expected, out)
    assert found.matches(), found.rows.collect()[:3]


def test_number_rows_with_many_equal_rows(frame):
    df = frame("g string, v int", *[("x", 1)] * 90, *[("x", 2)] * 5)
    out = W.number_rows(df, ["v"], "n", ["g"], single_task_rows=10, unique=False)
    assert sorted(r.n for r in out.collect()) == list(range(1, 96))
    assert out.columns == ["g", "v", "n"]


def test_many_offsets_are_joined_by_a_shuffle(ranked, monkeypatch):
    monkeypatch.setattr(W, "MAX_OFFSETS", 0)
    out = W.number_rows(ranked, ["v desc", "id"], "n", ["g"], single_task_rows=5)
    out = W.running_total(out, "v", {"s": "w"}, ["g"], single_task_rows=2)
    expected = ranked.selectExpr(
        "*",
        "row_number() over (partition by g order by v desc NULLS LAST, id) n",
        "sum(w) over (partition by g order by v NULLS LAST) s",
    )
    assert diff_tables(expected, out).matches()


def test_broadcast_only_what_was_measured(spark, frame):
    left = frame("k int", (1,), (2,))
    right = frame("k int, s string", *[(i, "x" * 100) for i in range(50)])

    def plan(df):
        return left.join(df, "k")._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in plan(J.broadcast_if_small(right))
    assert "strategy=broadcast" not in plan(J.broadcast_if_small(right, max_rows=49))
    assert "strategy=broadcast" not in plan(J.broadcast_if_small(right, max_bytes=1000))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "strategy=broadcast" not in plan(J.broadcast_if_small(right))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_distributed_windows_use_more_than_one_task(ranked):
    out = W.number_rows(ranked, ["v", "id"], "n", single_task_rows=10)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan.split("BroadcastExchange")[0]


def test_window_columns_and_order_spec(sales, rows):
    out = W.window_columns(sales, {"n": "COUNT(*) OVER (PARTITION BY artwork_id)"})
    assert {r[0]: r[3] for r in rows(out)}[1] == 2
    with pytest.raises(ValueError):
        W.order_column("price upwards")


def test_sorts_and_limits(frame, rows):
    df = frame("d string, id int", ("2020", 2), ("2021", 3), (None, 4), ("2020", 1))
    assert rows(O.sort_rows(df, "d desc", "id"), True) == [
        ("2021", 3), ("2020", 1), ("2020", 2), (None, 4)
    ]
    assert rows(O.top_rows(df, 1, "id desc")) == [(None, 4)]
    assert O.preview(df, 2).count() == 2
    assert rows(O.example_row(df, "id", 3)) == [("2021", 3)]
    assert O.example_row(df).count() == 1
    assert O.distinct_rows(df, ["d"]).count() == 3


# --- comparison, SQL, chains -----------------------------------------------


def test_diff_counts_repeated_rows(frame, rows):
    left = frame("a int, x double", (1, float("nan")), (1, float("nan")), (2, None))
    right = frame("a int, x double", (1, float("nan")), (2, None), (3, 0.0))
    found = diff_tables(left, right)
    assert not found.matches()
    assert sorted((r.a, r.left_count, r.right_count) for r in found.rows.collect()) == [
        (1, 2, 1), (3, 0, 1)
    ]
    assert diff_tables(left, left.orderBy("a")).matches()
    extra = diff_tables(left, right.drop("x").withColumn("z", F.lit(1)))
    assert extra.missing_columns == ["x"] and extra.extra_columns == ["z"]
    assert diff_tables(left, right.select(F.lit(1).alias("q"))).rows is None


def test_sql_transform_restores_views(spark, frame, rows):
    frame("v int", (99,)).createOrReplaceTempView("other")
    df, other = frame("v int", (1,), (2,)), frame("v int", (2,))
    out = sql_transform(df, "SELECT v FROM _input JOIN other USING (v)", {"other": other})
    again = sql_transform(frame("v int", (7,)), "SELECT v FROM _input")
    assert rows(out) == [(2,)] and rows(again) == [(7,)]
    assert rows(spark.table("other")) == [(99,)]
    assert not spark.catalog.tableExists("_input")


def test_sql_to_parquet_and_steps(spark, frame, folder, rows):
    frame("v int", (1,), (2,)).write.parquet(folder("in"))
    sql = "SELECT v * 2 AS w FROM up"
    assert sql_to_parquet(spark, sql, folder("out"), {"up": folder("in")}) == 2
    assert rows(spark.read.parquet(folder("out"))) == [(2,), (4,)]
    steps = SqlSteps(spark).view("base", folder("in"))
    steps.step("doubled", "SELECT v * 2 AS v FROM base", keep=True)
    steps.step("summed", "SELECT sum(v) AS s FROM doubled")
    assert rows(steps.result("summed")) == [(6,)]


def test_chain_is_one_plan(sales, artworks, rows):
    chain = Chain(
        [
            FilterStep("price", 50_000, ">"),
            JoinStep([(artworks, "artwork_id", "artwork_id")], ["a.*", "b.title"]),
            TextStep("title", "lower"),
            WindowStep({"n": "count(*) OVER (PARTITION BY title)"}),
            SqlStep("SELECT title, price, n FROM _input"),
            AggregateStep(["title", "n"], {"total": "sum(price)"}),
            lambda df: df.filter("total > 0"),
        ]
    )
    assert rows(chain.apply(sales)) == [("a", 2, 250_000), ("b", 1, 250_000)]


def test_chain_refuses_bad_steps():
    with pytest.raises(ValueError):
        Chain([])
    with pytest.raises(TypeError):
        Chain([3])
    with pytest.raises(ValueError):
        FilterStep("a", 1, "~")
    with pytest.raises(ValueError):
        TextStep("a", "shout")


def test_operators_accept_empty_and_all_null_tables(frame, rows):
    for df in (frame("k int, v int, s string"), frame("k int, v int, s string", (None, None, None))):
        n = df.count()
        assert W.number_rows(df, ["v", "k"], "n", ["s"]).count() == n
        assert W.rank_rows(df, "v", "r").count() == n
        assert W.rank_rows(df, "v", "r", single_task_rows=0).count() == n
        assert W.running_total(df, "k", {"t": "v"}).count() == n
        assert W.group_measures(df, "k", {"c": "count(*)"}).count() == n
        assert A.ordered_structs(df, "k", "v", ["v", "s"], "l").count() == n
        assert A.implode(df, "k", "v").count() == n
        assert J.lookup(df, df, "k", "k", ["v"]).count() == n
        assert diff_tables(df, df).matches()
        assert A.summarise(df, ["v"]).count() == 1
