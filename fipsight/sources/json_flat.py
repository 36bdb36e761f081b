"""Nested JSON documents -> flat columns or flat rows.

Object members are joined with a separator (``@a@b``); array positions are appended to the
member name (``@d0@e``, ``@d1@e``); scalars inside arrays are stored under that name (``@f0``);
an array element that is itself an array is kept as JSON text; empty arrays and objects give
nothing. Every document is flattened on its own: a member that is a scalar in one document and an
object in another gives ``@a`` for the first and ``@a@c`` for the second.

``flatten_json_long`` gives one row per document and leaf, whatever the documents hold: an array of
any length is rows, never columns. ``flatten_json`` gives one column per leaf name (the union over
all documents), so it suits documents with a bounded set of names.

``flatten_json`` finds the names in one pass: every task decodes its documents to shapes (member names and
kinds of values), walks each shape that it does not know yet and keeps the set of (name, path, kind of
value) it has met; the sets are merged by one aggregate, and the rows are then a projection
of the VARIANT documents. ``flatten_json_long`` explodes the VARIANT documents one nesting level at a time;
a small job per level finds out whether a further level exists.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


MOST_COLUMNS = 20_000


KNOWN_SHAPES = 10_000  # that a task remembers


class _Number(str):
    """The first number of its kind, as it is written."""


def _no_constant(name: str):
    raise ValueError(name)


def _shape(value):
    """What decides the names and types below a value: the keys and shapes of members, those of elements
    after None, any text as the empty one."""
    if type(value) is str:
        return ""
    return (None, *map(_shape, value)) if type(value) is list else value


def _members(pairs: list) -> tuple:
    out = dict(pairs)
    if len(out) < len(pairs):
        raise ValueError("a member name twice")
    for key, value in pairs:
        kind = type(value)
        if kind is str:
            out[key] = ""
        elif kind is list:
            out[key] = _shape(value)
    return (*out, *out.values())


def _decoder() -> json.JSONDecoder:
    """A decoder to shapes; an object is a tuple of its keys, then of their values."""
    whole, other = {}, {}

    def integer(text: str) -> _Number:
        size = 0 if text == "0" or text == "-0" else len(text) - (text[0] == "-")
        found = whole.get(size)
        return whole.setdefault(size, _Number(text)) if found is None else found

    def decimal(text: str) -> _Number:
        return other.setdefault(_kind_of(_Number(text)), _Number(text))

    return json.JSONDecoder(parse_int=integer, parse_float=decimal, parse_constant=_no_constant, object_pairs_hook=_members)


def _parse(text: str | None, decoder: json.JSONDecoder):
    """(shape, True) or (None, False) for text that is no JSON (as the VARIANT parser sees it, which
    does not look behind the document)."""
    try:
        return _shape(decoder.raw_decode(text.lstrip(" \t\r\n"))[0]), True
    except (ValueError, AttributeError, RecursionError):
        return None, False


def _path_steps(path: str) -> list:
    """Members and positions of a variant path such as ``$.a['b'][0]``."""
    steps = []
    for name, quoted, double, place in re.findall(r"""\.([^.\[]+)|\['([^']*)'\]|\["([^"]*)"\]|\[(\d+)\]""", path):
        steps.append(int(place) if place else name or quoted or double)
    return steps


def _is_array(shape) -> bool:
    return type(shape) is tuple and shape[:1] == (None,)


def _pairs(shape: tuple) -> zip:
    return zip(shape[:len(shape) // 2], shape[len(shape) // 2:])


def _records(doc, steps: list) -> tuple:
    """Shapes of the elements of the array at a path; none if it is not there."""
    for s in steps:
        if isinstance(s, int) and _is_array(doc) and s < len(doc) - 1:
            doc = doc[s + 1]
        elif not isinstance(s, int) and type(doc) is tuple and not _is_array(doc) and s in doc[:len(doc) // 2]:
            doc = dict(_pairs(doc))[s]
        else:
            return ()
    return doc[1:] if _is_array(doc) else ()


def _kind_of(value) -> tuple:
    """What decides a value's type: values of equal kind have equal types."""
    if isinstance(value, _Number):
        digits = re.sub(r"^-|\.", "", value.lower().partition("e")[0])
        end = len(digits.rstrip("0")) if "." in value else 0  # zeros at the end of a fraction are no digits of its type
        return "number", "e" in value.lower(), len(digits), len(digits.lstrip("0")), end, len(value.partition(".")[2]), "." in value
    return (type(value).__name__,)


def _walk(shape, name: str, path: str | None, within_array: bool, sep: str, found: dict) -> None:
    """Note an example of each (name, path, kind) of the leaves below a shape; None for a value that has
    names of its own."""
    if _is_array(shape) and not within_array:
        found[name, path, "nested"] = None
        for i, v in enumerate(shape[1:]):
            _walk(v, f"{name}{i}", None if path is None else f"{path}[{i}]", True, sep, found)
    elif type(shape) is tuple and not _is_array(shape):
        found[name, path, "nested"] = None
        for key, v in _pairs(shape):
            quote = "'" if "'" not in key else '"' if '"' not in key else None
            _walk(v, name + sep + key, None if path is None or quote is None else f"{path}[{quote}{key}{quote}]", False, sep, found)
    elif name:
        at = (name, path, _kind_of(shape))
        if at not in found:
            found[at] = shape if isinstance(shape, _Number) else "[]" if type(shape) is tuple else json.dumps(shape)


def json_names(df: DataFrame, col: str, sep: str, prefix: str, record_path: str | None) -> DataFrame:
    """Distinct ``(name, path, type, nested)`` of the leaves of all documents; ``nested``: in some document
    the path holds a value with names of its own. A document is walked only if its shape is not known."""
    steps = _path_steps(record_path) if record_path else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, known, decoder = {}, set(), _decoder()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                doc, ok = _parse(text, decoder)
                if ok:
                    for d in (doc,) if steps is None else _records(doc, steps):
                        if (at := (type(d), d)) not in known:  # True is no 1
                            if len(known) >= KNOWN_SHAPES:
                                known.clear()
                            known.add(at)
                            _walk(d, prefix, "$", False, sep, found)
        rows = [(name, path, example) for (name, path, _), example in found.items()]
        for i in range(0, len(rows), 10_000):
            part = rows[i:i + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in part], pa.string()) for j in range(3)], ["name", "path", "example"])

    each = df.select(F.col(col).cast("string")).mapInArrow(run, "name string, path string, example string")
    return (each.groupBy("name", "path").agg(F.schema_of_variant_agg(F.try_parse_json("example")).alias("type"),
                                             F.bool_or(F.col("example").isNull()).alias("nested"), F.count("example").alias("n"))
            .where("n > 0").drop("n"))


def _member_path(parent: Column, key: Column) -> Column:
    """Variant path of a member: variant paths have no escapes, so the quote that the key does not
    contain is used; a key with both quote characters cannot be addressed and has no path."""
    single, double = F.contains(key, F.lit("'")), F.contains(key, F.lit('"'))
    return (F.when(~single, F.concat(parent, F.lit("['"), key, F.lit("']")))
            .when(~double, F.concat(parent, F.lit('["'), key, F.lit('"]'))))


def _kind(v: Column) -> Column:
    return F.regexp_extract(F.schema_of_variant(v), "^[A-Z]+", 0)


def _documents(df: DataFrame, col: str, keep: Sequence[str], record_path: str | None) -> DataFrame:
    base = df.select(*keep, F.try_parse_json(F.col(col)).alias("_v"))
    if record_path:
        base = base.select(*keep, F.explode(F.try_variant_get("_v", record_path, "array<variant>")).alias("_v"))
    return base


def _leaves(base: DataFrame, keep: Sequence[str], sep: str, prefix: str) -> DataFrame:
    """keep, name, path, value (VARIANT) of every leaf of the documents ``_v``."""
    level = base.where("_v IS NOT NULL").select(*keep, F.lit(prefix).alias("name"), F.lit("$").alias("path"),
                                                F.col("_v").alias("value"), F.lit("").alias("within"))
    out = None
    while True:
        level = level.withColumn("kind", _kind(F.col("value")))
        # an array inside an array stays JSON text
        deeper = (F.col("kind") == "OBJECT") | ((F.col("kind") == "ARRAY") & (F.col("within") != "ARRAY"))
        leaf = level.where(~deeper & (F.col("name") != "")).select(*keep, "name", "path", "value")
        out = leaf if out is None else out.unionByName(leaf)
        nested = level.where(deeper)
        if nested.isEmpty():
            return out
        level = (nested.select(*keep, "name", "path", "kind", F.col("value").alias("_parent"))
                 .selectExpr(*[f"`{c}`" for c in keep], "name", "path", "kind",
                             "explode(CASE WHEN kind = 'ARRAY' THEN transform(try_variant_get(_parent, '$', "
                             "'array<variant>'), (x, i) -> struct(i AS pos, CAST(NULL AS STRING) AS key, x AS value)) "
                             "ELSE transform(map_entries(try_variant_get(_parent, '$', 'map<string, variant>')), "
                             "e -> struct(-1 AS pos, e.key AS key, e.value AS value)) END) AS e"))
        member = F.col("e.key").isNotNull()
        level = level.select(
            *keep,
            F.when(member, F.concat("name", F.lit(sep), "e.key")).otherwise(
                F.concat("name", F.col("e.pos").cast("string"))).alias("name"),
            F.when(member, _member_path(F.col("path"), F.col("e.key"))).otherwise(
                F.concat("path", F.lit("["), F.col("e.pos").cast("string"), F.lit("]"))).alias("path"),
            F.col("e.value").alias("value"), F.col("kind").alias("within"))


def _text(v: Column) -> Column:
    """A scalar as plain text, an array as JSON text."""
    return F.when(_kind(v).isin("ARRAY", "OBJECT"), F.to_json(v)).otherwise(F.try_variant_get(v, "$", "string"))


def flatten_json_long(df: DataFrame, col: str, sep: str = "@", keep: Sequence[str] = (),
                      record_path: str | None = None, prefix: str = "") -> DataFrame:
    """One row per document and leaf: the ``keep`` columns, ``name``, ``value`` (text; NULL for a JSON
    null). Documents that do not parse or hold nothing give no row."""
    keep = list(keep)
    leaves = _leaves(_documents(df, col, keep, record_path), keep, sep, prefix)
    return leaves.select(*keep, "name", _text(F.col("value")).alias("value"))


def flatten_json(df: DataFrame, col: str, sep: str = "@", keep: Sequence[str] = (),
                 record_path: str | None = None, prefix: str = "") -> DataFrame:
    """Flatten the JSON text column ``col``; ``record_path`` (e.g. ``'$.value'``) turns each element
    of that array into its own row (the API-response layout). ``keep`` columns are carried. A name
    whose values have one type over all documents gets that type, otherwise it is text."""
    keep = list(keep)
    base = _documents(df, col, keep, record_path)
    found = json_names(df, col, sep, prefix, record_path).orderBy("name", "path").limit(MOST_COLUMNS + 1).collect()
    if len(found) > MOST_COLUMNS:
        raise ValueError(f"more than {MOST_COLUMNS} names; use flatten_json_long")
    if any(r.path is None for r in found):
        raise ValueError("a JSON member name holds both quote characters; it cannot be addressed by a variant path")
    by_name: dict[str, list[tuple[str, str, bool]]] = {}
    for r in found:
        by_name.setdefault(r.name, []).append((r.path, r.type, r.nested))
    cols = []
    for name, places in by_name.items():
        plain = len({t for _, t, _ in places}) == 1 and places[0][1] not in ("VARIANT", "VOID") and \
            not places[0][1].startswith(("ARRAY", "OBJECT"))
        values = []
        for path, kind, nested in places:
            v = F.try_variant_get("_v", path, "variant")
            element = re.search(r"\[\d+\]$", path) is not None
            arrays = element and (kind == "VARIANT" or kind.startswith("ARRAY"))  # as leaves
            got = _text(v) if arrays else F.try_variant_get("_v", path, kind if plain else "string")
            if nested and (not plain or kind == "STRING"):
                # a document that holds an object here, or an array that is no array's element, has its own names for it
                got = F.when(~_kind(v).isin(["OBJECT"] if element else ["OBJECT", "ARRAY"]), got)
            values.append(got)
        cols.append(F.coalesce(*values).alias(name))
    return base.select(*keep, *cols)
