"""Schemas, contracts and checks."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tablewright.errors import CheckFailed, MissingColumn
from tablewright.plans import ARTWORKS_SCHEMA, SALES_SCHEMA
from tablewright.quality import checks as K
from tablewright.quality import contracts as R
from tablewright.quality import schema as S


@pytest.fixture
def people(frame):
    return frame(
        "id int, age string, kind string, code string",
        (1, "30", "a", "X1"),
        (2, "-5", "b", "Y2"),
        (3, "old", "c", None),
        (4, None, "a", "yX"),
    )


RULES = S.TableSchema(
    "people",
    {
        "id": S.Field("int", ge=1, le=3),
        "age": S.Field("int", gt=0, lt=120),
        "kind": S.Field("string", isin=("a", "b")),
        "code": S.Field("string", nullable=True, str_matches="[XY]"),
    },
)


def test_every_error_of_every_row(people, rows):
    assert rows(S.error_table(people, RULES, keep=["id"])) == [
        (2, "age", "greater_than(0)", "-5"),
        (3, "age", "coerce_dtype('int')", "old"),
        (3, "kind", "isin(['a', 'b'])", "c"),
        (4, "age", "not_nullable", None),
        (4, "code", "str_matches('[XY]')", "yX"),
        (4, "id", "less_than_or_equal_to(3)", "4"),
    ]


def test_validate_counts_in_one_pass(people):
    result = S.validate(people, RULES)
    assert (result.valid, result.record_count, result.error_count, result.invalid_rows) == (
        False, 4, 6, 3
    )
    assert result.rows.schema["age"].dataType.simpleString() == "int"
    assert S.validate(people.filter("id = 1"), RULES).valid
    assert S.validate(people.limit(0), RULES).valid


def test_remove_invalid_and_flags(people, rows):
    clean, removed = S.remove_invalid(people, RULES)
    assert removed == 3 and rows(clean) == [(1, 30, "a", "X1")]
    assert S.invalid_rows(people, RULES).count() == 3
    assert S.check_rows(people, RULES).select(F.sum(F.size(S.ERRORS))).first()[0] == 6


def test_report_counts_by_column_and_check(people, rows):
    report = rows(S.validation_report(people, RULES))
    assert ("*", "rows", 4) in report and ("*", "invalid_rows", 3) in report
    assert ("age", "not_nullable", 1) in report and len(report) == 8


def test_strict_modes(people):
    strict = S.TableSchema("people", {"id": S.Field("int")}, strict=True)
    assert [e[1:] for e in S.schema_errors(people, strict)] == [
        ("column_in_schema", c) for c in ("age", "kind", "code")
    ]
    assert not S.validate(people, strict).valid
    filtered = S.TableSchema("people", {"id": S.Field("int")}, strict="filter")
    assert S.valid_rows(people, filtered).columns == ["id"]
    with pytest.raises(ValueError):
        S.TableSchema("people", strict="maybe")


def test_missing_column_and_type_without_coercion(people):
    rules = S.TableSchema("people", {"age": S.Field("int"), "no": S.Field("int")}, coerce=False)
    assert S.schema_errors(people, rules) == [
        ("people", "column_in_dataframe", "no"), ("age", "dtype('int')", "string")
    ]
    assert S.validate(people, rules).error_count == 2 + 1


def test_other_rules(frame, rows):
    df = frame("n int", (1,), (2,), (None,))
    rules = S.TableSchema("t", {"n": S.Field("int", nullable=True, eq=1)})
    assert rows(S.error_table(df, rules)) == [("n", "equal_to(1)", "2")]


def test_the_plan_schemas_accept_good_rows(frame):
    sale = frame(
        "sale_id long, artwork_id long, sale_date string, sale_price_usd long, buyer_country string,"
        "title string, artist_id long, artwork_year double, medium string, list_price_usd long,"
        "artist_name string, nationality string, price_diff long, pct_change double",
        (1, 2, "2020-01-01", 10, "US", "T", 3, None, "oil", 5, "A", "FR", 5, 100.0),
    )
    assert S.validate(sale, SALES_SCHEMA).valid
    assert S.validate(sale.withColumn("sale_price_usd", F.lit(0)), SALES_SCHEMA).error_count == 1
    assert ARTWORKS_SCHEMA.fields["price_tier"].isin == ("budget", "mid", "premium")


# --- contracts -------------------------------------------------------------


@pytest.fixture
def orders(frame):
    return frame(
        "id int, price double, tier string, seen timestamp",
        (1, 10.0, "a", datetime(2024, 1, 1)),
        (2, None, "b", datetime(2024, 1, 2)),
        (2, -1.0, None, None),
        (None, 5.0, "z", None),
    )


def test_contract_from_dict_runs_in_one_table(orders, rows):
    contract = R.Contract.from_dict(
        {
            "dataset": "orders",
            "columns": [
                {"name": "id"},
                {
                    "name": "price",
                    "checks": [
                        {"missing": {"must_be": 0}},
                        {"invalid": {"must_be": 0, "valid_min": 0, "valid_max": 9}},
                        {"missing_percent": {"must_be_less_than": 50}},
                    ],
                },
                {
                    "name": "tier",
                    "checks": [{"invalid": {"must_be": 1, "valid_values": ["a", "b"]}}],
                },
            ],
            "checks": [
                {"row_count": {"must_be_greater_than": 0}},
                {"duplicate": {"columns": ["id"], "must_be": 0}},
                {"freshness": {"column": "seen", "freshness_limit": "P1D"}},
            ],
        }
    )
    results = R.run_contract(orders, contract, now=datetime(2024, 1, 2, 12))
    assert rows(results) == [
        ("duplicate(id)", 1.0, "= 0", False),
        ("freshness(seen)", 43200.0, "<= P1D", True),
        ("invalid(price)", 2.0, "= 0", False),
        ("invalid(tier)", 1.0, "= 1", True),
        ("missing(price)", 1.0, "= 0", False),
        ("missing_percent(price)", 25.0, "< 50", True),
        ("row_count", 4.0, "> 0", True),
    ]
    assert rows(R.contract_totals(results)) == [(7, 4, 3, False)]
    with pytest.raises(CheckFailed) as error:
        K.require(results, "orders")
    assert sorted(error.value.failed) == ["duplicate(id)", "invalid(price)", "missing(price)"]
    assert rows(R.duplicate_keys(orders, ["id"])) == [(2, 2)]


def test_contract_on_an_empty_table(orders, rows):
    contract = R.checks_from_lists("o", ["id"], ["price"], {"tier": ["a"]}, min_rows=0)
    assert all(r[3] for r in rows(R.run_contract(orders.limit(0), contract)))
    fresh = R.Contract.from_dict(
        {
            "dataset": "o",
            "checks": [
                {
                    "freshness": {
                        "column": "seen", "freshness_limit": "PT1H", "fail_when_missing": True
                    }
                }
            ],
        }
    )
    assert rows(R.run_contract(orders.limit(0), fresh, now=datetime(2024, 1, 1)))[0][3] is False
    with pytest.raises(ValueError):
        R.run_contract(orders, fresh)


def test_bad_contracts():
    for spec in (
        {"dataset": "d", "columns": [{"name": "a", "checks": [{"odd": {}}]}]},
        {"dataset": "d", "checks": [{"odd": {}}]},
        {"dataset": "d", "checks": [{"row_count": {"must_be": 1, "must_be_less_than": 2}}]},
        {"dataset": "d", "checks": [{"row_count": {"about": 1}}]},
    ):
        with pytest.raises(ValueError):
            R.Contract.from_dict(spec)


def test_durations():
    assert R.parse_duration("P1D") == timedelta(days=1)
    assert R.parse_duration("P1W2DT3H4M5S") == timedelta(
        weeks=1, days=2, hours=3, minutes=4, seconds=5
    )
    for bad in ("P", "1D", "P1M"):
        with pytest.raises(ValueError):
            R.parse_duration(bad)


# --- single checks ---------------------------------------------------------


def test_single_checks(orders, rows):
    assert rows(K.threshold_check(orders, "price", 0)) == [(1, -1.0, False)]
    check, counts = K.allowed_values(orders, "tier", ["a", "b"])
    assert rows(check) == [(1, False)] and counts.count() == 4
    assert rows(K.minimum_rows(orders, 6)) == [(4, 6, 2, False)]
    assert rows(K.minimum_rows(orders, 4)) == [(4, 4, 0, True)]
    assert rows(K.value_range(orders, "price", -2, 11)) == [(-1.0, 10.0, True)]
    assert K.schema_contract(orders, ["id", "x"]) == (["x"], ["price", "seen", "tier"])
    with pytest.raises(MissingColumn):
        K.require_columns(orders, ["id", "nope"], "orders")


def test_failure_rate(people, rows):
    assert rows(K.failure_rate(people, RULES, 0.5)) == [(4, 3, 0.75, False)]
    assert rows(K.failure_rate(people.limit(0), RULES, 0.0)) == [(0, 0, 0.0, True)]


def test_references(frame, rows):
    child = frame("k int, j int", *[(i, i % 3) for i in range(30)], (None, 1), (None, 2))
    parent = frame("id int", (0,), (1,), (2,))
    assert rows(K.reference_check(child, parent, "k", "id")) == [
        ("k", 28, [str(i) for i in range(3, 13)], False)
    ]
    few = child.filter("k > 27 OR k IS NULL")
    assert rows(K.reference_check(few, parent, "k", "id")) == [("k", 3, ["28", "29", None], False)]
    found = K.foreign_keys(child, {"k": (parent, "id"), "j": (parent, "id")})
    assert [(r[0], r[1], r[3]) for r in rows(found)] == [("j", 0, True), ("k", 28, False)]
    with pytest.raises(CheckFailed) as error:
        K.require(found, "keys")
    assert error.value.failed == ["k"]


def test_gate_writes_only_what_passed(frame):
    df, written = frame("v int", (1,), (None,)), []
    contract = R.checks_from_lists("t", required=["v"])
    with pytest.raises(CheckFailed):
        K.write_when_passed(df, lambda d: R.run_contract(d, contract), written.append, "t")
    assert written == []
    good = df.dropna()
    K.write_when_passed(good, lambda d: R.run_contract(d, contract), written.append, "t")
    assert len(written) == 1 and written[0].count() == 1


def test_warnings_report(people, orders, rows):
    strict = S.TableSchema("orders", {"id": S.Field("int"), "gone": S.Field("int")})
    report = K.warnings_report({"people": (people, RULES), "orders": (orders, strict)})
    assert report.count() == 6 + 2
    assert rows(K.warnings_status(report)) == [("warnings", 8)]
    assert rows(K.warnings_status(report.limit(0))) == [("clean", 0)]


def test_plans_are_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(frames):
        for frame in frames:
            seen.add(len(frame))
            yield frame

    df = spark.range(100).selectExpr("id", "id % 10 as k").mapInPandas(count, "id long, k long")
    contract = R.Contract.from_dict(
        {
            "dataset": "d",
            "columns": [{"name": "id", "checks": [{"missing": {"must_be": 0}}]}],
            "checks": [
                {"duplicate": {"columns": ["id"], "must_be": 0}},
                {"duplicate": {"columns": ["k"], "must_be": 90}},
            ],
        }
    )
    assert all(r.passed for r in R.run_contract(df, contract).collect()) and seen.value == 100
    rules = S.TableSchema("t", {"id": S.Field("bigint"), "k": S.Field("bigint", gt=0)})
    clean, removed = S.remove_invalid(df, rules)
    assert (clean.count(), removed, seen.value) == (90, 10, 200)
