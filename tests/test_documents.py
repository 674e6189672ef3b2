"""JSON documents apart, against a walk in plain Python."""

import json
import random

from concordat.operators.documents import document_diff


def walk(a, b, at=""):
    kind = lambda x: "null" if x is None else "boolean" if isinstance(x, bool) else "number" if isinstance(x, (int, float)) else {dict: "object", list: "array", str: "string"}[type(x)]
    if kind(a) != kind(b):
        return [(at or "/", "kind", kind(a), kind(b))]
    if isinstance(a, dict):
        out = []
        for k in sorted(a.keys() | b.keys()):
            place = f"{at}/{k.replace('~', '~0').replace('/', '~1')}"
            if k not in a:
                out.append((place, "unexpected", None, kind(b[k])))
            elif k not in b:
                out.append((place, "absent", kind(a[k]), None))
            else:
                out += walk(a[k], b[k], place)
        return out
    if isinstance(a, list):
        if len(a) != len(b):
            return [(at or "/", "length", str(len(a)), str(len(b)))]
        return [x for i, (c, d) in enumerate(zip(a, b)) for x in walk(c, d, f"{at}/{i}")]
    return [] if a == b else [(at or "/", "value", json.dumps(a), json.dumps(b))]


def random_node(rng, depth=0):
    pick = rng.randint(0, 6 if depth < 4 else 3)
    if pick < 4:
        return rng.choice([None, True, False, 1, 2, 2.5, "a", "b"])
    if pick < 6:
        return {rng.choice(["a", "b", "a/b", "~", ""]): random_node(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [random_node(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def test_random_documents(spark):
    rng = random.Random(6)
    pairs = [(i, random_node(rng), random_node(rng)) for i in range(300)]
    pairs += [(300 + i, {"k": a, "l": [a, b]}, {"k": a, "l": [a, b]}) for i, a, b in pairs[:20]]
    left = spark.createDataFrame([(i, json.dumps(a)) for i, a, _ in pairs], "id int, body string")
    right = spark.createDataFrame([(i, json.dumps(b)) for i, _, b in pairs], "id int, body string")
    expected = [(i, *x) for i, a, b in pairs for x in walk(a, b)]
    diff = document_diff(left, right, "id", "body")
    assert sorted((tuple(r) for r in diff.collect()), key=repr) == sorted(expected, key=repr)
    assert "Python" not in diff._jdf.queryExecution().executedPlan().toString()


def test_what_is_no_json_is_a_finding(spark):
    left = spark.createDataFrame([(1, "nope"), (2, "{}"), (3, '{"a":1,"a":2}'), (4, None), (5, "[1.0]"), (6, None), (8, '{"b":12345678901234567890123}')], "id int, body string")
    right = spark.createDataFrame([(1, "{}"), (3, "{}"), (4, "1"), (5, "[1]"), (6, None), (7, "{"), (8, '{"b":12345678901234567890124}')], "id int, body string")
    got = [tuple(r) for r in document_diff(left, right, "id", "body").orderBy("id").collect()]
    assert got[:5] == [
        (1, "/", "unreadable", "unreadable", "object"), (2, "/", "absent", "object", None), (3, "/", "unreadable", "unreadable", "object"),
        (4, "/", "unexpected", None, "number"), (7, "/", "unreadable", None, "unreadable")]


def test_no_documents(spark):
    none = spark.createDataFrame([], "id int, body string")
    assert document_diff(none, none, "id", "body").collect() == []


def test_shallow_documents_are_gone_over_once(spark, monkeypatch):
    from concordat.operators import documents

    kept, stagings = documents.staged, []
    monkeypatch.setattr(documents, "staged", lambda table, name: (stagings.append(name), kept(table, name))[1])
    deep = '{"a":{"b":{"c":[1,%s]}}}'
    left = spark.createDataFrame([(1, deep % 1), (2, deep % '{"d":{"e":{"f":1}}}')], "id int, body string")
    right = spark.createDataFrame([(1, deep % 2), (2, deep % '{"d":{"e":{"f":2}}}')], "id int, body string")
    flat = document_diff(left.where("id = 1").selectExpr("id", "'{\"a\":{\"b\":1}}' as body"), right.where("id = 1").selectExpr("id", "'{\"a\":{\"b\":2}}' as body"), "id", "body")
    assert [tuple(r) for r in flat.collect()] == [(1, "/a/b", "value", "1", "2")] and len(stagings) == 1
    both = document_diff(left, right, "id", "body")
    assert sorted(r.pointer for r in both.collect()) == ["/a/b/c/1", "/a/b/c/1/d/e/f"]
