"""Names found in one pass against the rows of the long form, on random and malformed documents."""

import contextlib
import json
import random
from decimal import Decimal, InvalidOperation

import pyarrow as pa

from fipsight.sources import json_flat
from fipsight.sources.json_flat import _path_steps, flatten_json, flatten_json_long


def value(r, depth):
    kind = r.randrange(9 if depth else 6)
    if kind == 6:
        return {r.choice(["a", "b", "c d", "e.f", "é", "q'"]): value(r, depth - 1) for _ in range(r.randrange(4))}
    if kind in (7, 8):
        return [value(r, depth - 1) for _ in range(r.randrange(4))]
    return [None, True, r.randrange(-5, 10 ** 6), 1.5 * r.randrange(9), "text", 2 ** 70][kind]


def same(value, text):
    """Equal as numbers (a column of numbers has one scale), else as text."""
    try:
        return Decimal(str(value)) == Decimal(text)
    except InvalidOperation:
        return str(value).lower() == text.lower()


def test_columns_are_the_leaves_of_the_long_form(spark):
    r = random.Random(5)
    docs = [(i, json.dumps({"x": value(r, 3), "y": value(r, 2)})) for i in range(300)]
    docs += [(1000 + i, t) for i, t in enumerate([None, "", "{", '{"a": NaN}', '{"a": 1, "a": 2}', "[1, 2]", "7", '{"a": 1} x', "{'a': 1}"])]
    df = spark.createDataFrame(docs, "id long, j string").repartition(5)
    long = {(x.id, x.name): x.value for x in flatten_json_long(df, "j", keep=["id"]).collect() if x.value is not None}
    wide = flatten_json(df, "j", keep=["id"])
    assert set(wide.columns) >= {"id"} | {n for _, n in long}
    told = {}
    for row in wide.collect():
        told |= {(row["id"], c): row[c] for c in wide.columns if c != "id" and row[c] is not None}
    assert told.keys() == long.keys()
    assert [(k, v, long[k]) for k, v in told.items() if not same(v, long[k])] == []


def test_paths():
    assert _path_steps("$.value") == ["value"] and _path_steps("$") == []
    assert _path_steps("$.a['b c'][2][\"d\"]") == ["a", "b c", 2, "d"]


def test_a_record_path_below_members_and_no_records(spark):
    df = spark.createDataFrame([('{"r": {"items": [{"k": 1}, {"k": "x"}, 3]}}',), ('{"r": {"items": {"k": 9}}}',), ('{"r": 1}',)], "j string")
    assert sorted(str(x["@k"]) for x in flatten_json(df, "j", record_path="$.r.items").collect()) == ["1", "None", "x"]
    assert flatten_json(df.where("false"), "j").columns == []


def test_a_known_shape_is_not_walked_again(spark, monkeypatch):
    docs = [json.dumps({"v": [{"k": i, "t": f"text {i}", "l": [i, f"{i}"][:1 + i % 2]}, {"k": f"{i}"}]}) for i in range(2000)]
    df = spark.createDataFrame([(d,) for d in docs], "j string")
    held, walks = {}, []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, fn, schema: held.update(fn=fn) or (_ for _ in ()).throw(StopIteration()))
    with contextlib.suppress(StopIteration, RuntimeError):
        json_flat.json_names(df, "j", "@", "", "$.v")
    monkeypatch.setattr(json_flat, "_walk", lambda *a, plain=json_flat._walk: (walks.append(a[1]), plain(*a))[1])
    batches = [pa.RecordBatch.from_pydict({"j": docs[i:i + 100]}) for i in range(0, 2000, 100)]
    names = {n for b in held["fn"](iter(batches)) for n, e in zip(b.column(0).to_pylist(), b.column(2).to_pylist()) if e is not None}
    assert names == {"@k", "@t", "@l0", "@l1"}
    assert walks.count("") < 20  # before: one for each of 4000 records


def test_shapes_tell_members_elements_texts_and_numbers_apart(spark):
    docs = ['{"a": {}, "b": [], "c": [[]], "d": true}', '{"a": "x", "b": "y", "c": [{}], "d": 1}', '{"a": "", "b": 2.50, "c": ["[]"], "d": 1e3}',
            '{"a": ["a"], "b": {"b": 12345678901234567890}, "c": {"0": 1}, "d": null}', '{"a": "a", "b": -0, "c": [-12, [3]], "d": 0.05}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs * 3)], "id long, j string")
    got = {r.id % 5: r.asDict() for r in flatten_json(df, "j", keep=["id"]).collect()}
    want = {(r.id % 5, r.name): r.value for r in flatten_json_long(df, "j", keep=["id"]).collect()}
    assert {n for _, n in want} | {"id"} == set(got[0])
    for (i, name), value in want.items():
        assert got[i][name] == value or same(got[i][name], value), (i, name)
    assert [got[i]["@a"] for i in range(5)] == [None, "x", "", None, "a"]
    assert [got[i]["@c0"] for i in range(5)] == ["[]", None, "[]", None, "-12"]
    assert sum(v is not None for r in got.values() for k, v in r.items() if k != "id") == sum(v is not None for v in want.values())
