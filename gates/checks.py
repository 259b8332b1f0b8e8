"""Schemas, contracts and single checks."""

from datetime import datetime

from pyspark.sql import functions as F

from gates.registry import query
from tablewright.operators.columns import move_renamed_last
from tablewright.quality import checks as K
from tablewright.quality import contracts as R
from tablewright.quality.increments import ContractStates
from tablewright.quality import schema as S
from tablewright.session import fresh_path
from tablewright.sources import write_parquet

LABELLED = "SELECT doc_id, lang, source, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)"


def _labelled(t):
    documents = t.documents.select("doc_id", "lang", "source", "n_chars")
    return documents.join(t.labels, "doc_id", "left")


DOCUMENT_RULES = S.TableSchema(
    "documents",
    {
        "doc_id": S.Field("bigint", ge=0),
        "lang": S.Field("string", isin=("en", "fr", "de")),
        "source": S.Field("string", str_matches="src[0-9]"),
        "n_chars": S.Field("bigint", gt=200, le=5000),
        "quality": S.Field("bigint", eq=1),
        "toxic": S.Field("int", nullable=True, lt=1),
    },
)

_ERRORS = f"""
rows AS ({LABELLED}),
errors AS (
  SELECT doc_id, 'lang' AS "column", 'isin([''en'', ''fr'', ''de''])' AS "check", lang AS failure_case
  FROM rows WHERE lang NOT IN ('en', 'fr', 'de')
  UNION ALL SELECT doc_id, 'source', 'str_matches(''src[0-9]'')', source
  FROM rows WHERE NOT regexp_matches(source, '^src[0-9]')
  UNION ALL SELECT doc_id, 'n_chars', 'greater_than(200)', CAST(n_chars AS VARCHAR)
  FROM rows WHERE NOT n_chars > 200
  UNION ALL SELECT doc_id, 'n_chars', 'less_than_or_equal_to(5000)', CAST(n_chars AS VARCHAR)
  FROM rows WHERE NOT n_chars <= 5000
  UNION ALL SELECT doc_id, 'quality', 'not_nullable', NULL FROM rows WHERE quality IS NULL
  UNION ALL SELECT doc_id, 'quality', 'equal_to(1)', CAST(quality AS VARCHAR)
  FROM rows WHERE quality != 1
  UNION ALL SELECT doc_id, 'toxic', 'less_than(1)', CAST(toxic AS VARCHAR)
  FROM rows WHERE toxic >= 1)"""


@query(
    """
    SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey,
           TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority,
           CASE WHEN TRY_CAST(o_orderpriority AS INTEGER) IS NULL THEN 1 ELSE 0 END
             + CASE WHEN o_custkey < 100 THEN 1 ELSE 0 END AS errors
    FROM orders
    """
)
def q1_typed_schema(t):
    # priorities such as 1-URGENT cannot be cast, so each row has that error
    rules = S.TableSchema(
        "orders",
        {
            "o_orderkey": S.Field("bigint"),
            "o_custkey": S.Field("int", ge=100),
            "o_orderpriority": S.Field("int"),
        },
        strict="filter",
    )
    rows = S.check_rows(t.orders, rules)
    return rows.withColumn("errors", F.size(S.ERRORS)).drop(S.ERRORS)


@query(f"WITH {_ERRORS} SELECT * FROM errors")
def q2_validate_all_errors(t):
    return S.error_table(_labelled(t), DOCUMENT_RULES, keep=["doc_id"])


@query(f"WITH {_ERRORS} SELECT * FROM rows WHERE doc_id NOT IN (SELECT doc_id FROM errors)")
def q3_remove_invalid(t):
    clean, _ = S.remove_invalid(_labelled(t), DOCUMENT_RULES)
    return clean.select(
        "doc_id", "lang", "source", "n_chars", F.col("quality").cast("int").alias("quality"), "toxic"
    )


@query(
    f"""
    WITH {_ERRORS}
    SELECT "column", "check", count(*) AS failures FROM errors GROUP BY ALL
    UNION ALL SELECT '*', 'rows', (SELECT count(*) FROM rows)
    UNION ALL SELECT '*', 'invalid_rows', (SELECT count(DISTINCT doc_id) FROM errors)
    """
)
def q4_validation_report(t):
    return S.validation_report(_labelled(t), DOCUMENT_RULES)


@query("SELECT l_orderkey, l_quantity FROM lineitem")
def q5_required_columns(t):
    return K.require_columns(t.lineitem, ["l_orderkey", "l_quantity"]).select(
        "l_orderkey", "l_quantity"
    )


def _contract(*checks):
    return R.Contract("gate", tuple(checks))


def _line(name, value, limit, passed):
    return (
        f"SELECT '{name}' AS check_name, CAST({value} AS DOUBLE) AS value, "
        f"'{limit}' AS \"limit\", {passed} AS passed"
    )


@query(_line("missing(quality)", "count_if(quality IS NULL)", "= 0", "count_if(quality IS NULL) = 0")
       + f" FROM ({LABELLED})")
def q6_contract_missing(t):
    return R.run_contract(_labelled(t), _contract(R.Check("missing", ("quality",))))


_OUT = "n_chars < 100 OR n_chars > 10000"


@query(
    _line("invalid(n_chars)", f"count_if({_OUT})", "= 0", f"count_if({_OUT}) = 0")
    + f" FROM ({LABELLED}) UNION ALL "
    + _line("invalid(lang)", "count_if(lang NOT IN ('en', 'fr'))", "< 1000000",
            "count_if(lang NOT IN ('en', 'fr')) < 1000000")
    + f" FROM ({LABELLED})"
)
def q7_contract_invalid(t):
    checks = [
        R.Check("invalid", ("n_chars",), options={"valid_min": 100, "valid_max": 10_000}),
        R.Check("invalid", ("lang",), ("<", 1_000_000), {"valid_values": ["en", "fr"]}),
    ]
    return R.run_contract(_labelled(t), _contract(*checks))


@query("SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem "
       "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def q8_contract_duplicates(t):
    return R.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(_line("row_count", "count(*)", "> 0", "count(*) > 0") + " FROM lineitem")
def q9_contract_row_count(t):
    return R.run_contract(t.lineitem, _contract(R.Check("row_count", limit=(">", 0))))


_SHARE = "count_if(quality IS NULL) * CAST(100 AS DOUBLE) / count(*)"


@query(
    _line("missing_percent(quality)", _SHARE, "< 2", f"{_SHARE} < 2") + f" FROM ({LABELLED}) UNION ALL "
    + _line("missing_count(quality)", "count_if(quality IS NULL)", "< 50000000",
            "count_if(quality IS NULL) < 50000000") + f" FROM ({LABELLED}) UNION ALL "
    + _line("invalid_percent(n_chars)", "count_if(n_chars < 500) * CAST(100 AS DOUBLE) / count(*)",
            "< 5", "count_if(n_chars < 500) * CAST(100 AS DOUBLE) / count(*) < 5")
    + f" FROM ({LABELLED})"
)
def q10_contract_percent(t):
    checks = [
        R.Check("missing_percent", ("quality",), ("<", 2)),
        R.Check("missing_count", ("quality",), ("<", 50_000_000)),
        R.Check("invalid_percent", ("n_chars",), ("<", 5), {"valid_min": 500}),
    ]
    return R.run_contract(_labelled(t), _contract(*checks))


_AGE = "epoch(TIMESTAMP '2024-02-01 00:00:00') - epoch(max(ts))"


@query(
    f"""
    SELECT 'freshness(ts)' AS check_name, round(CAST({_AGE} AS DOUBLE), 3) AS value,
           '<= P3D' AS "limit", {_AGE} <= 3 * 86400 AS passed FROM events
    """
)
def q11_contract_freshness(t):
    contract = R.Contract.from_dict(
        {
            "dataset": "events",
            "checks": [
                {
                    "freshness": {
                        "column": "ts",
                        "freshness_limit": "P3D",
                        "fail_when_missing": True,
                    }
                }
            ],
        }
    )
    result = R.run_contract(t.events, contract, now=datetime(2024, 2, 1))
    return result.withColumn("value", F.round("value", 3))


@query(
    " UNION ALL ".join(
        [
            _line("missing(l_shipdate)", "count_if(l_shipdate IS NULL)", "= 0",
                  "count_if(l_shipdate IS NULL) = 0") + " FROM lineitem",
            _line("invalid(l_returnflag)", "count_if(l_returnflag NOT IN ('A', 'N'))", "= 0",
                  "count_if(l_returnflag NOT IN ('A', 'N')) = 0") + " FROM lineitem",
            _line("min(l_quantity)", "min(l_quantity)", ">= 1", "min(l_quantity) >= 1")
            + " FROM lineitem",
            _line("row_count", "count(*)", "> 0", "count(*) > 0") + " FROM lineitem",
            _line("duplicate(l_orderkey, l_linenumber)",
                  "count(*) - count(DISTINCT (l_orderkey, l_linenumber))", "= 0",
                  "count(*) - count(DISTINCT (l_orderkey, l_linenumber)) = 0") + " FROM lineitem",
        ]
    )
)
def q12_contract_runner(t):
    contract = R.Contract.from_dict(
        {
            "dataset": "lineitem",
            "columns": [
                {"name": "l_shipdate", "checks": [{"missing": {"must_be": 0}}]},
                {
                    "name": "l_returnflag",
                    "checks": [{"invalid": {"must_be": 0, "valid_values": ["A", "N"]}}],
                },
                {
                    "name": "l_quantity",
                    "checks": [{"min": {"must_be_greater_than_or_equal": 1}}],
                },
            ],
            "checks": [
                {"row_count": {"must_be_greater_than": 0}},
                {"duplicate": {"columns": ["l_orderkey", "l_linenumber"], "must_be": 0}},
            ],
        }
    )
    return R.run_contract(t.lineitem, contract, stored=True)


@query(
    " UNION ALL ".join(
        [
            _line("missing(l_shipdate)", "count_if(l_shipdate IS NULL)", "= 0", "count_if(l_shipdate IS NULL) = 0") + " FROM lineitem",
            _line("invalid_percent(l_returnflag)", "count_if(l_returnflag NOT IN ('A', 'N')) * CAST(100 AS DOUBLE) / count(*)", "< 20",
                  "count_if(l_returnflag NOT IN ('A', 'N')) * CAST(100 AS DOUBLE) / count(*) < 20") + " FROM lineitem",
            _line("max(l_quantity)", "max(l_quantity)", "<= 50", "max(l_quantity) <= 50") + " FROM lineitem",
            _line("row_count", "count(*)", "> 0", "count(*) > 0") + " FROM lineitem",
            _line("duplicate(l_orderkey)", "count(*) - count(DISTINCT l_orderkey)", "= 0",
                  "count(*) - count(DISTINCT l_orderkey) = 0") + " FROM lineitem",
        ]
    )
)
def q12_contract_states(t):
    """Three slices of lineitem, one of them kept twice, judged from their states; orders lie across slices."""
    contract = R.Contract.from_dict(
        {
            "dataset": "lineitem",
            "columns": [
                {"name": "l_shipdate", "checks": [{"missing": {"must_be": 0}}]},
                {"name": "l_returnflag", "checks": [{"invalid_percent": {"must_be_less_than": 20, "valid_values": ["A", "N"]}}]},
                {"name": "l_quantity", "checks": [{"max": {"must_be_less_than_or_equal": 50}}]},
            ],
            "checks": [{"row_count": {"must_be_greater_than": 0}}, {"duplicate": {"columns": ["l_orderkey"], "must_be": 0}}],
        }
    )
    states = ContractStates(t.spark, fresh_path(t.spark, "states"), contract)
    for part in (0, 1, 2, 1):
        states.add(f"line-{part}", t.lineitem.filter(F.col("l_linenumber") % 3 == part))
    return states.result()


@query(
    """
    SELECT CAST(4 AS BIGINT) AS checks_run, checks_passed, 4 - checks_passed AS checks_failed,
           checks_passed = 4 AS passed
    FROM (SELECT CAST(count(*) >= 1 AS BIGINT) + CAST(count_if(o_custkey IS NULL) = 0 AS BIGINT)
            + CAST(min(o_totalprice) > 0 AS BIGINT)
            + CAST(count_if(o_orderstatus NOT IN ('F', 'O')) = 0 AS BIGINT) AS checks_passed
          FROM orders)
    """
)
def q13_checks_from_lists(t):
    contract = R.checks_from_lists(
        "orders",
        required=["o_custkey"],
        positive=["o_totalprice"],
        allowed={"o_orderstatus": ["F", "O"]},
    )
    return R.contract_totals(R.run_contract(t.orders, contract))


@query(
    """
    SELECT CAST(count_if(l_extendedprice < 5000) AS BIGINT) AS below_threshold_count,
           min(l_extendedprice) AS min_value, count_if(l_extendedprice < 5000) = 0 AS passed
    FROM lineitem
    """
)
def q14_threshold_check(t):
    return K.threshold_check(t.lineitem, "l_extendedprice", 5000)


@query(
    """
    SELECT CAST(count_if(quality NOT IN (1)) AS BIGINT) AS invalid_count, count_if(quality NOT IN (1)) = 0 AS passed
    FROM documents LEFT JOIN labels USING (doc_id)
    """
)
def q15_allowed_values(t):
    return K.allowed_values(_labelled(t), "quality", [1])[0]


@query("SELECT quality, count(*) AS count FROM documents LEFT JOIN labels USING (doc_id) GROUP BY quality")
def q15_allowed_values_distribution(t):
    return K.allowed_values(_labelled(t), "quality", [1])[1]


@query(
    """
    SELECT count(*) AS row_count, CAST(1000000000000 AS BIGINT) AS minimum,
           greatest(0, 1000000000000 - count(*)) AS shortfall, count(*) >= 1000000000000 AS passed
    FROM orders
    """
)
def q16_minimum_rows(t):
    return K.minimum_rows(t.orders, 10**12)


@query(
    f"""
    WITH {_ERRORS}
    SELECT (SELECT count(*) FROM rows) AS total_rows, count(DISTINCT doc_id) AS failed_rows,
           count(DISTINCT doc_id) / CAST((SELECT count(*) FROM rows) AS DOUBLE) AS failure_rate,
           count(DISTINCT doc_id) / CAST((SELECT count(*) FROM rows) AS DOUBLE) <= 0.25 AS passed
    FROM errors
    """
)
def q17_failure_rate(t):
    return K.failure_rate(_labelled(t), DOCUMENT_RULES, 0.25)


def _reference_sql(child, parent, key, parent_key, label):
    orphans = (
        f"(SELECT DISTINCT {key} AS k FROM {child} WHERE {key} NOT IN "
        f"(SELECT {parent_key} FROM {parent}))"
    )
    return (
        f"SELECT '{label}' AS reference, count(*) AS orphan_count, count(*) = 0 AS passed, "
        f"(SELECT coalesce(string_agg(CAST(k AS VARCHAR), ',' ORDER BY k), '') FROM "
        f"(SELECT k FROM {orphans} ORDER BY k LIMIT 10)) AS orphan_sample FROM {orphans}"
    )


@query(_reference_sql("documents", "labels", "doc_id", "doc_id", "doc_id"))
def q18_referential_integrity(t):
    result = K.reference_check(t.documents, t.labels, "doc_id")
    return result.withColumn("orphan_sample", F.array_join("orphan_sample", ","))


@query(
    _reference_sql("(SELECT * REPLACE (CASE WHEN l_quantity > 45 THEN -l_partkey ELSE l_partkey END AS l_partkey) FROM lineitem)",
                   "part", "l_partkey", "p_partkey", "l_partkey")
    + " UNION ALL "
    + _reference_sql("lineitem", "supplier", "l_suppkey", "s_suppkey", "l_suppkey")
    + " UNION ALL "
    + _reference_sql("lineitem", "orders", "l_orderkey", "o_orderkey", "l_orderkey")
)
def q19_foreign_keys(t):
    broken = F.when(F.col("l_quantity") > 45, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    result = K.foreign_keys(
        t.lineitem.withColumn("l_partkey", broken),
        {
            "l_partkey": (t.part, "p_partkey"),
            "l_suppkey": (t.supplier, "s_suppkey"),
            "l_orderkey": (t.orders, "o_orderkey"),
        },
    )
    return result.withColumn("orphan_sample", F.array_join("orphan_sample", ","))


@query(
    """
    SELECT min(l_quantity) AS min_value, max(l_quantity) AS max_value,
           min(l_quantity) > 0 AND max(l_quantity) < 40 AS passed FROM lineitem
    """
)
def q20_value_range(t):
    return K.value_range(t.lineitem, "l_quantity", 0, 40)


@query("SELECT count(*) AS rows, 'c_phone' AS missing, 'c_mktsegment,c_nationkey' AS extra FROM customer")
def q21_schema_contract(t):
    missing, extra = K.schema_contract(t.customer, ["c_custkey", "c_name", "c_acctbal", "c_phone"])
    return t.customer.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", F.lit(",".join(missing)).alias("missing"), F.lit(",".join(extra)).alias("extra")
    )


@query("SELECT * EXCLUDE (o_totalprice), o_totalprice AS total FROM orders")
def q22_blocking_gate(t):
    contract = R.checks_from_lists("orders", required=["o_custkey"], positive=["o_totalprice"])
    path = fresh_path(t.spark, "gated-orders")
    K.write_when_passed(
        t.orders,
        lambda df: R.run_contract(df, contract),
        lambda df: write_parquet(move_renamed_last(df, {"o_totalprice": "total"}), path),
        "orders",
    )
    return t.spark.read.parquet(path)


@query(
    f"""
    WITH {_ERRORS}
    SELECT 'documents' AS "table", "column", "check", failure_case FROM errors
    UNION ALL SELECT 'orders', 'o_orderstatus', 'isin([''F'', ''O''])', o_orderstatus
    FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
    """
)
def q23_warnings_report(t):
    orders = S.TableSchema("orders", {"o_orderstatus": S.Field("string", isin=("F", "O"))})
    return K.warnings_report(
        {"documents": (_labelled(t), DOCUMENT_RULES), "orders": (t.orders, orders)}
    )
