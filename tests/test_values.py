"""Scalar, list and struct values on small frames with known results."""

import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import functions as E
from tablewright.operators import columns as C


def test_fill_empty_from_column_then_constant(frame, rows):
    df = frame(
        "title string, alt_title string, price int",
        (None, "Backup", None),
        ("Main Title", "Alt", 100),
        (None, None, 50),
    )
    out = df.select(
        E.fill_empty("title", F.col("alt_title")).alias("title"), E.fill_empty("price", 0).alias("p")
    )
    assert rows(out, True) == [("Backup", 0), ("Main Title", 100), (None, 50)]


def test_remove_nulls_makes_empty_null(frame, rows):
    df = frame("tags array<string>", (["a", None, "b"],), ([None, None],), (["x", "y"],), (None,), ([],))
    out = df.select(E.remove_nulls("tags"))
    assert rows(out, True) == [(["a", "b"],), (None,), (["x", "y"],), (None,), (None,)]


def test_strip_all_white_space(frame, rows):
    df = frame("name string", ("  hello  ",), ("\tworld\n",), ("no_space",), (" x ",), (None,))
    assert rows(df.select(E.strip("name")), True) == [
        ("hello",), ("world",), ("no_space",), ("x",), (None,)
    ]


def test_strip_sides_and_characters(frame, rows):
    df = frame("s string", ("--a--",), ("  a  ",))
    out = df.select(E.strip("s", "-"), E.strip("s", "-", "left"), E.strip("s", side="right"))
    assert rows(out, True) == [("a", "a--", "--a--"), ("  a  ", "  a  ", "  a")]
    with pytest.raises(ValueError):
        E.strip("s", side="middle")


def test_first_of_list(frame, rows):
    df = frame("authors array<string>", (["Alice", "Bob"],), (["Charlie"],), ([],), (None,))
    assert rows(df.select(E.first_element("authors")), True) == [
        ("Alice",), ("Charlie",), (None,), (None,)
    ]


def test_extract_when(frame, rows):
    df = frame("price int, is_on_sale boolean", (100, True), (200, False), (150, True), (1, None))
    out = df.select(E.extract_when((F.col("is_on_sale"), F.col("price"))))
    assert rows(out, True) == [(100,), (None,), (150,), (None,)]


def test_extract_when_takes_the_first_branch(frame, rows):
    df = frame("n int", (1,), (5,), (9,))
    out = df.select(E.extract_when((F.col("n") > 6, "big"), (F.col("n") > 3, "mid"), default="low"))
    assert rows(out, True) == [("low",), ("mid",), ("big",)]
    with pytest.raises(ValueError):
        E.extract_when()


def test_contains_is_case_sensitive_and_literal(frame, rows):
    df = frame(
        "d string", ("This is important",), ("Nothing here",), ("Also important stuff",), ("IMPORTANT",)
    )
    assert rows(df.select(E.contains_text("d", "important")), True) == [
        (True,), (False,), (True,), (False,)
    ]
    assert df.filter(E.contains_text("d", "i.p")).count() == 0
    assert df.filter(E.matches_pattern("d", "i.p")).count() == 2


def test_constant(frame, rows):
    df = frame("id int", (1,), (2,), (3,))
    assert rows(C.add_constant(df, "source", "museum"), True) == [
        (1, "museum"), (2, "museum"), (3, "museum")
    ]


def test_append_when(frame, rows):
    df = frame(
        "tags array<string>, category string, is_featured boolean",
        (["art"], "new", True),
        (["photo"], "old", False),
        (None, "x", True),
    )
    out = df.select(E.append_when(F.col("is_featured"), "tags", "category"))
    assert rows(out, True) == [(["art", "new"],), (["photo"],), (["x"],)]


def test_concat_shows_null_as_text(frame, rows):
    df = frame("first string, last string", ("John", "Doe"), ("Jane", "Smith"), (None, "Unknown"))
    out = df.select(E.concat_columns("first", "last"), E.concat_present("first", "last"))
    assert rows(out, True) == [
        ("John Doe", "John Doe"), ("Jane Smith", "Jane Smith"), ("None Unknown", "Unknown")
    ]


def test_is_empty_means_null(frame, rows):
    df = frame("email string", (None,), ("a@b.com",), ("",))
    out = df.select(E.is_empty("email"), E.is_not_empty("email"))
    assert rows(out, True) == [(True, False), (False, True), (False, True)]


def test_replace_when_leaves_nulls(frame, rows):
    df = frame("status string, price int", ("", -10), ("active", 50), ("", -5), (None, None))
    out = df.select(E.replace_when("status", "==", "", "unknown"), E.replace_when("price", "<", 0, 0))
    assert rows(out, True) == [("unknown", 0), ("active", 50), ("unknown", 0), (None, None)]


@pytest.mark.parametrize(
    "op, expected",
    [(">=", [2, 3]), (">", [3]), ("<=", [1, 2]), ("<", [1]), ("==", [2]), ("!=", [1, 3])],
)
def test_six_comparisons(frame, rows, op, expected):
    df = frame("n int", (1,), (2,), (3,), (None,))
    assert rows(df.filter(E.compare("n", op, 2)), True) == [(n,) for n in expected]
    with pytest.raises(ValueError):
        E.compare("n", "=>", 2)


def test_lower_and_upper(frame, rows):
    df = frame("email string", ("John@Example.COM",), ("JANE@TEST.ORG",), ("mixed@Case.Net",))
    assert rows(df.select(E.lower("email")), True) == [
        ("john@example.com",), ("jane@test.org",), ("mixed@case.net",)
    ]
    assert rows(C.uppercase_columns(df, "email"), True)[0] == ("JOHN@EXAMPLE.COM",)


def test_replace_value(frame, rows):
    df = frame("status string", ("",), ("active",), (" ",))
    out = df.select(E.replace_value("status", "", "unknown"), E.replace_value("status", "active", None))
    assert rows(out, True) == [("unknown", ""), ("active", None), (" ", " ")]


def test_fill_missing_list_is_as_long_as_the_others(frame, rows):
    df = frame(
        "names array<string>, roles array<string>",
        (["Alice", "Bob"], None),
        (None, ["editor", "viewer"]),
        (None, None),
        (None, ["a", "b", "c"]),
    )
    out = df.select(E.fill_missing_list("names", "roles"), E.fill_missing_list("roles", "names"))
    assert rows(out, True) == [
        (["Alice", "Bob"], [None, None]),
        ([None, None], ["editor", "viewer"]),
        ([], []),
        ([None, None, None], ["a", "b", "c"]),
    ]


def test_flag_from_sql_or_column(frame, rows):
    df = frame("price int, status string", (1500, "active"), (500, "active"), (2000, "inactive"))
    sql = df.select(E.flag_when("price > 1000 AND status = 'active'"))
    column = df.select(E.flag_when((F.col("price") > 1000) & (F.col("status") == "active")))
    assert rows(sql, True) == rows(column, True) == [(True,), (False,), (False,)]


def test_capitalize_lowers_the_rest(frame, rows):
    df = frame("title string", ("hello world",), ("UPPERCASE",), ("mIxEd CaSe",), ("",), (None,))
    assert rows(df.select(E.capitalize("title")), True) == [
        ("Hello world",), ("Uppercase",), ("Mixed case",), ("",), (None,)
    ]


def test_title_case_starts_words_at_other_characters(frame, rows):
    df = frame("s string", ("hello WORLD",), ("o'brien-smith 3rd",), ("élan vital",), (None,))
    assert rows(df.select(E.title_case("s")), True) == [
        ("Hello World",), ("O'Brien-Smith 3rd",), ("Élan Vital",), (None,)
    ]


def test_prepend_and_append_keep_null(frame, rows):
    df = frame("id string, filename string", ("123", "image"), ("456", "photo"), (None, None))
    out = df.select(E.prepend_text("id", "ID-"), E.append_text("filename", ".jpg"))
    assert rows(out, True) == [("ID-123", "image.jpg"), ("ID-456", "photo.jpg"), (None, None)]


def test_add_and_subtract(frame, rows):
    df = frame("year int", (2024,), (None,))
    assert rows(df.select(E.add_number("year", 1), E.subtract_number("year", 1)), True) == [
        (2025, 2023), (None, None)
    ]


def test_split_is_literal(frame, rows):
    df = frame("tags string", ("a,b,c",), ("x,y",), ("single",), ("a.b",))
    assert rows(df.select(E.split_text("tags")), True) == [
        (["a", "b", "c"],), (["x", "y"],), (["single"],), (["a.b"],)
    ]
    assert rows(df.select(E.split_text("tags", ".")), True)[3] == (["a", "b"],)


def test_cast_strict_raises_and_lenient_gives_null(frame, rows):
    df = frame("year string, price string", ("2024", "99.99"), ("2023", "49.50"))
    out = df.select(E.cast_column("year", "int"), E.cast_column("price", "double"))
    assert rows(out, True) == [(2024, 99.99), (2023, 49.5)]
    bad = frame("year string", ("soon",))
    assert rows(bad.select(E.cast_column("year", "int", strict=False))) == [(None,)]
    with pytest.raises(PySparkException):
        bad.select(E.cast_column("year", "int")).collect()


def test_columns_to_structs(frame, rows):
    df = frame("id int, width int, height int, depth int", (1, 10, 20, 5), (2, 15, 30, 8))
    out = C.structs_from_columns(df, {"w": "width", "h": "height", "d": "depth"}, "dims")
    assert out.columns == ["id", "dims"]
    assert rows(out, True) == [(1, [(10, 20, 5)]), (2, [(15, 30, 8)])]


def test_append_columns(frame, rows):
    df = frame(
        "tags array<string>, category string, source string",
        (["a", "b"], "new", "web"),
        (["x"], "old", "api"),
        (None, "c", "s"),
    )
    assert rows(df.select(E.append_columns("tags", "category", "source")), True) == [
        (["a", "b", "new", "web"],), (["x", "old", "api"],), (["c", "s"],)
    ]


def test_as_list(frame, rows):
    df = frame("names string", ("Alice",), ("Bob",))
    assert rows(df.select(E.as_list("names")), True) == [(["Alice"],), (["Bob"],)]


def test_zip_structs(frame, rows):
    df = frame("a array<int>, b array<string>", ([1, 2], ["x", "y"]), ([], []), (None, None))
    assert rows(df.select(E.zip_structs({"n": "a", "s": "b"})), True) == [
        ([(1, "x"), (2, "y")],), ([],), (None,)
    ]


def test_extract_pattern(frame, rows):
    df = frame("text string", ("Item-123-A",), ("Product-456-B",), ("none",), ("--",), (None,))
    out = df.select(
        E.extract_pattern("text", r"-(\d+)-"),
        E.extract_pattern("text", r"-(\d+)-", no_match=""),
        E.extract_pattern("text", r"-(\d*)-"),
    )
    assert rows(out, True) == [
        ("123", "123", "123"), ("456", "456", "456"), (None, "", None), (None, "", ""), (None,) * 3
    ]


def test_whitespace_replace_and_first_character(frame, rows):
    df = frame("s string", ("a  b\t\nc aXa",))
    out = df.select(
        E.collapse_whitespace("s"), E.replace_text("s", "a", "*"), E.first_character("s"),
        E.replace_pattern("s", "[bc]", "#"), E.normalise_name("s"),
    )
    assert rows(out) == [("a b c aXa", "*  b\t\nc *X*", "a", "a  #\t\n# aXa", "A  B\t\nC AXA")]


def test_percent_change_is_guarded(frame, rows):
    df = frame("price long, base long", (150, 100), (100, 3), (1, 0), (1, None), (None, 5))
    out = df.select(E.price_difference("price", "base"), E.percent_change("price", "base"))
    assert rows(out, True) == [(50, 50.0), (97, 3233.3), (1, None), (None, None), (None, None)]


def test_price_tier_bounds(frame, rows):
    df = frame("p long", (499_999,), (500_000,), (3_000_000,), (None,))
    out = df.select(E.price_tier("p"), E.price_tier("p", inclusive=True))
    assert rows(out, True) == [
        ("budget", "budget"), ("mid", "budget"), ("premium", "mid"), ("premium", "premium")
    ]
    with pytest.raises(ValueError):
        E.price_tier("p", (1, 2), ("low", "high"))


def test_priority_map_age_and_bucket(frame, rows):
    df = frame("kind string, views long, year int", ("news", 50, 1890), ("static", 100, None))
    out = df.select(
        E.scale_to_priority(df, "views"),
        E.map_values("kind", {"news": "daily"}),
        E.map_values("kind", {"news": "daily"}, "never", keep_unmapped=False),
        E.age_in_years("year", 2024),
        E.bucket_label("year", 1900, "old", "modern"),
    )
    assert rows(out, True) == [
        (0.75, "daily", "daily", 134, "old"), (1.0, "static", "never", None, "modern")
    ]


def test_list_length_and_dates(frame, rows):
    df = frame("l array<int>, d string", ([1, 2], "2024-03-05"), (None, "2023-12-31"), ([], None))
    out = df.select(
        E.list_length("l"), E.year_of(E.to_date_value("d")), E.iso_date(E.to_date_value("d"))
    )
    assert rows(out, True) == [(2, 2024, "2024-03-05"), (0, 2023, "2023-12-31"), (0, None, None)]
    bad = frame("d string", ("soon",))
    assert rows(bad.select(E.to_date_value("d", strict=False))) == [(None,)]
    with pytest.raises(PySparkException):
        bad.select(E.to_date_value("d")).collect()


def test_text_functions_on_random_text(frame):
    """Against plain Python, on text of many scripts and kinds of white space."""
    rng = random.Random(3)
    alphabet = "aZé ñß\t\n\x0b\x85\xa0\u2003\u3000'-_1٣中🎨" + E.strings.WHITE_SPACE
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))) for _ in range(3000)]
    df = frame("s string", *[(t,) for t in texts])
    found = df.select("s", E.strip("s"), E.collapse_whitespace("s"), E.title_case("s")).collect()
    space = E.strings.WHITE_SPACE
    for text, stripped, collapsed, titled in found:
        assert stripped == text.strip(space)
        assert collapsed == re.sub(f"[{space}]+", " ", text)
        runs = re.findall(r"[^\W_]+|[\W_]+", text)
        assert titled == "".join(r[:1].upper() + r[1:].lower() for r in runs)


def _display(value):
    """The display rule in plain Python."""
    size, sign = abs(value), "-" if value < 0 else ""
    if size >= 1_000_000:
        return f"{sign}${size / 1_000_000:.1f}M"
    if size >= 1_000:
        return f"{sign}${size / 1_000:.1f}K"
    return f"{sign}${size:.2f}" if isinstance(value, float) else f"{value:,}"


def test_display_value_rounds_like_printf(frame, rows):
    whole = [0, -7, 999, 1000, 1250, 1350, 12_350, -1_250_000, 1_150_000, 86_265_000]
    whole += [n * 50 for n in range(15, 600)]
    real = [0.005, 0.125, 1.005, 2.675, 999.995, 1250.0, 1e6, -0.5, 123456.789, 0.1 + 0.2]
    real += [n / 1000 for n in range(5, 3000, 10)]
    for name, kind, values in (("long", T.LongType(), whole), ("double", T.DoubleType(), real)):
        df = frame(f"v {name}", *[(v,) for v in values])
        got = {r[0]: r[1] for r in df.select("v", E.display_value("v", kind)).collect()}
        assert {v: t for v, t in got.items() if t != _display(v)} == {}


def test_display_value_of_other_types(frame, rows):
    df = frame("s string, l array<int>, d double, n long", ("x", [1], float("nan"), None))
    out = df.select(*[E.display_value(f.name, f.dataType) for f in df.schema])
    assert rows(out) == [("x", "[1]", "$nan", None)]


def test_large_numbers_are_displayed(frame, rows):
    df = frame("v double", (2e30,), (-2.5e29,), (1.5e22,), (123456789.0,), (1e300,))
    shown = [r[0] for r in rows(df.select(E.display_value("v", T.DoubleType())), True)]
    assert shown[0] == "$2" + "0" * 24 + ".0M" and shown[1] == "-$25" + "0" * 22 + ".0M"
    assert shown[2] == "$15000000000000000.0M" and shown[3] == "$123.5M" and len(shown[4]) == 1 + 295 + 3


def test_a_value_may_be_mapped_to_null(frame, rows):
    df = frame("s string", ("a",), ("b",), ("c",), (None,))
    mapped = df.select(E.map_values("s", {"a": None, "b": "B"}))
    assert rows(mapped, True) == [(None,), ("B",), ("c",), (None,)]
    assert rows(df.select(E.map_values("s", {"a": None}, "x", keep_unmapped=False)), True) == [(None,), ("x",), ("x",), ("x",)]
