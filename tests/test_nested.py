import json
from collections import Counter

from tidewater.operators import nested

TEXTS = ['{"a": 1, "items": [{"x": 1, "y": "u"}, {"x": "7"}, 3], "o": {"p": {"q": true}}}', '{"a": null, "items": []}', '{"a": "s", "extra": [1, [2, "z"]]}', "{broken", None, "", "[1, null]", '"text"', "{}"]


def brute():
    seen = Counter()

    def walk(path, v):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(v), "number")
        if path:
            seen[path, kind] += 1
        for k, x in v.items() if isinstance(v, dict) else ():
            walk(f"{path}.{k}" if path else k, x)
        for x in v if isinstance(v, list) else ():
            walk(f"{path}[]", x)

    for t in TEXTS:
        try:
            walk("", json.loads(t))
        except (TypeError, ValueError):
            pass
    return sorted((f, k, n) for (f, k), n in seen.items())


def test_field_inventory_equals_a_walk(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "body string")
    assert sorted(tuple(r) for r in nested.field_inventory(df, "body").collect()) == brute()
    assert {r.field for r in nested.field_inventory(df, "body", depth=1).collect()} == {"a", "items", "o", "extra", "[]"}
    assert nested.field_inventory(df.filter("false"), "body").count() == 0


def test_items_of_any_shape(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, body string")
    got = nested.open_items(df, "body", "$.items", {"a": ("$.a", "string")}, {"x": ("$.x", "int"), "y": ("$.y", "string")})
    assert got.columns == ["id", "is_broken", "a", "x", "y"]
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == sorted([(0, False, "1", 1, "u"), (0, False, "1", 7, None), (0, False, "1", None, None), (1, False, None, None, None), (2, False, "s", None, None),
                           (3, True, None, None, None), (4, False, None, None, None), (5, True, None, None, None), (6, False, None, None, None), (7, False, None, None, None), (8, False, None, None, None)], key=repr)
