"""XML records by field paths, from files or from a text column.

A field path is relative to the record: ``./@id`` (attribute), ``./a/b/text()``
(text of the first match), ``./a/@b`` (attribute of the first match) or
``./a/b`` (text; several matches give a JSON list). A nested field, such as
``./images/image``, becomes a JSON list with one object for each match.

The paths are turned into a read schema, so the parser keeps only what they
name. Spark reads a file of XML whole in one task and deals out files, so large
data should lie in many files (``sinks.write_xml`` writes such ones).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright.session import fresh_path
from tablewright.sources.sinks import XML_RECORDS

_ATTRIBUTE, _TEXT = "_", "_VALUE"
_OPTIONS = {"attributePrefix": _ATTRIBUTE, "valueTag": _TEXT, "ignoreNamespace": "true"}


@dataclass
class _Node:
    """What is read of one element."""

    attributes: set[str] = field(default_factory=set)
    children: dict[str, _Node] = field(default_factory=dict)

    def child(self, steps: Sequence[str]) -> _Node:
        node = self
        for step in steps:
            node = node.children.setdefault(step, _Node())
        return node

    def data_type(self) -> T.DataType:
        """Text alone for a plain element, else a struct; children are always lists."""
        if not self.attributes and not self.children:
            return T.StringType()
        fields = [T.StructField(_ATTRIBUTE + a, T.StringType()) for a in sorted(self.attributes)]
        fields += [
            T.StructField(n, T.ArrayType(c.data_type())) for n, c in sorted(self.children.items())
        ]
        return T.StructType([*fields, T.StructField(_TEXT, T.StringType())])

    def text(self, element: Column) -> Column:
        plain = not self.attributes and not self.children
        return element if plain else element.getField(_TEXT)


@dataclass(frozen=True)
class _Path:
    steps: tuple[str, ...]
    attribute: str | None
    first: bool

    @classmethod
    def parse(cls, text: str) -> _Path:
        path = text.removeprefix("./")
        attribute, first = None, True
        if path == "text()" or path.endswith("/text()"):
            path = path.removesuffix("text()").rstrip("/")
        elif "@" in path:
            path, _, attribute = path.rpartition("@")
            path = path.rstrip("/")
        else:
            first = False
        # names are compared without their namespace prefix
        steps = tuple(s.rpartition(":")[2] for s in path.split("/") if s not in ("", "."))
        return cls(steps, attribute, first)


def _elements(record: Callable[[str], Column], steps: Sequence[str]) -> Column:
    """All elements at a path, as one list."""
    found = record(steps[0])
    for step in steps[1:]:
        found = F.flatten(F.transform(found, lambda e: F.coalesce(e.getField(step), F.array())))
    return found




def _value(path: _Path, root: _Node, record) -> Column:
    if not path.steps:
        return record(_ATTRIBUTE + path.attribute if path.attribute else _TEXT)
    node = root.child(path.steps)
    found = _elements(record, path.steps)
    if path.attribute:
        return F.get(found, F.lit(0)).getField(_ATTRIBUTE + path.attribute)
    if path.first:
        return node.text(F.get(found, F.lit(0)))
    texts = F.transform(found, node.text)
    several = F.to_json(F.filter(texts, lambda t: t.isNotNull() & (t != "")))
    return F.when(F.size(found) == 1, F.get(texts, F.lit(0))).when(F.size(found) > 1, several)


def _nested(path: _Path, keys: Sequence[str], root: _Node, record) -> Column:
    node = root.child(path.steps)

    def entry(name: str, value: Column, there: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.alias("value"), there.alias("there"))

    def item(element: Column) -> Column:
        entries = []
        for key in keys:
            if key == "value":
                trimmed = F.btrim(node.text(element))
                entries.append(entry("value", trimmed, F.coalesce(trimmed != "", F.lit(False))))
            elif key.startswith("@"):
                value = element.getField(_ATTRIBUTE + key[1:])
                entries.append(entry(key[1:], value, value.isNotNull()))
            else:
                children = F.coalesce(element.getField(key), F.array())
                last = F.get(children, F.size(children) - 1)
                text = F.nullif(node.children[key].text(last), F.lit(""))
                entries.append(entry(key, text, F.size(children) > 0))
        there = F.filter(F.array(*entries), lambda e: e["there"])
        return F.map_from_entries(F.transform(there, lambda e: F.struct(e["key"], e["value"])))

    found = _elements(record, path.steps)
    listed = F.to_json(F.transform(found, item), {"ignoreNullFields": "false"})
    return F.when(F.size(found) > 0, listed)


def _plan(fields: Mapping[str, str], nested: Mapping[str, tuple[str, Sequence[str]]]):
    root = _Node()
    paths = {name: _Path.parse(text) for name, text in fields.items()}
    for path in paths.values():
        node = root.child(path.steps)
        if path.attribute:
            node.attributes.add(path.attribute)
    lists = {}
    for name, (text, keys) in nested.items():
        path = _Path.parse(text)
        node = root.child(path.steps)
        for key in keys:
            if key.startswith("@"):
                node.attributes.add(key[1:])
            elif key != "value":
                node.child([key])
        lists[name] = (path, keys)
    data_type = root.data_type()
    if isinstance(data_type, T.StringType):
        data_type = T.StructType([T.StructField(_TEXT, T.StringType())])
    return root, paths, lists, data_type


def _project(root, paths, lists, record) -> list[Column]:
    columns = [_value(p, root, record).alias(n) for n, p in paths.items()]
    return columns + [_nested(p, k, root, record).alias(n) for n, (p, k) in lists.items()]


def read_xml(
    spark: SparkSession,
    path: str,
    record_tag: str,
    fields: Mapping[str, str],
    nested: Mapping[str, tuple[str, Sequence[str] | None]] | None = None,
    **options,
) -> DataFrame:
    """One row for each ``record_tag`` element of the files at ``path``.

    ``nested`` maps names to ``(path, keys)``: ``@type`` takes an attribute,
    ``value`` the text of the element and any other key the text of a child, the
    last one if it is repeated; what an element does not have is left out, and an
    empty child is null. ``None`` for the keys takes all attributes and children,
    which are found by one more pass over the files. A record inside a record of
    the same tag belongs to the outer one.

    A ``record_tag`` of several steps, ``list/item``, takes only records at that
    path. Then one element of the first step is read at a time, so that should
    not be one that holds a whole file.
    """
    nested = {
        name: (text, _all_keys(spark, path, text, options) if keys is None else keys)
        for name, (text, keys) in (nested or {}).items()
    }
    root, paths, lists, schema = _plan(fields, nested)
    outer, *steps = [s.rpartition(":")[2] for s in record_tag.strip("/").split("/")]
    for step in reversed(steps):
        schema = T.StructType([T.StructField(step, T.ArrayType(schema))])
    reader = spark.read.format("xml").schema(schema).options(**_OPTIONS)
    df = reader.option("rowTag", outer).options(**options).load(path)
    for step in steps:
        df = df.select(F.inline(step))
    return df.select(*_project(root, paths, lists, F.col))


def _all_keys(spark: SparkSession, path: str, element_path: str, options: Mapping) -> list[str]:
    """Keys of everything that the elements at a path have, from their inferred schema."""
    tag = _Path.parse(element_path).steps[-1]
    reader = spark.read.format("xml").options(**_OPTIONS).option("inferSchema", False)
    names = reader.option("rowTag", tag).options(**options).load(path).schema.names
    keys = ["@" + n.removeprefix(_ATTRIBUTE) for n in names if n.startswith(_ATTRIBUTE) and n != _TEXT]
    return [*keys, *(n for n in names if not n.startswith(_ATTRIBUTE)), "value"]


def parse_xml_column(
    df: DataFrame,
    column: str,
    fields: Mapping[str, str],
    nested: Mapping[str, tuple[str, Sequence[str] | None]] | None = None,
) -> DataFrame:
    """Add the fields of the XML record that each cell of ``column`` holds.

    ``nested`` is that of ``read_xml``. To find all keys where they are ``None``,
    the cells are written to the shared folder as text and read once more; a
    stream has to name its keys.
    """
    nested = dict(nested or {})
    if any(keys is None for _, keys in nested.values()):
        if df.isStreaming:
            raise ValueError("a stream has to name the keys of its nested fields")
        cells = fresh_path(df.sparkSession, "xml-cells")
        df.select(F.col(column).cast("string").alias("value")).filter("value is not null").write.option("maxRecordsPerFile", XML_RECORDS).text(cells)
        nested = {
            name: (text, _all_keys(df.sparkSession, cells, text, {}) if keys is None else keys)
            for name, (text, keys) in nested.items()
        }
    root, paths, lists, schema = _plan(fields, nested)
    parsed = df.withColumn("__xml", F.from_xml(column, schema, _OPTIONS))
    record = F.col("__xml").getField
    return parsed.select(*df.columns, *_project(root, paths, lists, record))
