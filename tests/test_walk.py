"""Walks over VARIANT against plain loops over parsed JSON."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from chainloom.functions import walk as W


def tree(r, depth):
    kind = r.randrange(8 if depth else 5)
    if kind < 5:
        return r.choice(["x", "", 7, 2.5, True, False, None, "string", "int", "NoneType", "Number", 10**25])
    if kind < 7:
        return {r.choice(["a", "b", "cD", "type", "properties", "items", "e"]): tree(r, depth - 1) for _ in range(r.randrange(4))}
    return [tree(r, depth - 1) for _ in range(r.randrange(13 if r.random() < 0.2 else 3))]


def all_leaves(v, key=""):
    if isinstance(v, dict):
        return [x for k, c in v.items() for x in all_leaves(c, k)]
    if isinstance(v, list):
        return [x for c in v for x in all_leaves(c, key)]
    return [] if v is None or v == "" else [(key, str(v))]


def seen(v, depth, stops, declares):
    """What a schema declares, by its rules in the plainest form."""
    out = []
    if not isinstance(v, dict) or depth > stops:
        return out
    props = v.get("properties")
    for name, p in (props if isinstance(props, dict) else {}).items():
        if declares or isinstance(p, dict):
            kind = p.get("type", "string") if isinstance(p, dict) else ""
            out.append((name, "" if declares else kind if isinstance(kind, str) else "string"))
        if isinstance(p, dict):
            out += seen(p, depth + 1, stops, declares) + seen(p.get("items"), depth + 1, stops, declares)
    for name, p in v.items() if not declares else ():
        if name not in W.SCHEMA_WORDS:
            if isinstance(p, str) and p.lower() in W.TYPE_WORDS:
                out.append((name, p))
            elif isinstance(p, (dict, list)):
                out.append((name, "object" if isinstance(p, dict) else "array"))
                out += seen(p if isinstance(p, dict) else next((x for x in p if isinstance(x, dict)), None), depth + 1, stops, declares)
    return out


@pytest.fixture(scope="module")
def trees(spark):
    r = random.Random(8)
    data = [{"k": tree(r, 5), "properties": {"p": {"type": r.choice(["int", 3, "object"]), "properties": {"q": tree(r, 3)}, "items": tree(r, 3)}}, "m": tree(r, 4)} for _ in range(300)]
    return data, spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(data)], "i long, t string").repartition(4).cache()


def got(df, walk, *columns):
    return {r.i: Counter(tuple(x[c] for c in columns) for x in r.x) for r in df.select("i", walk(F.col("t")).alias("x")).collect()}


def test_leaves(trees):
    found = got(trees[1], W.leaves, "key", "value")
    assert all(found[i] == Counter(all_leaves(d)) for i, d in enumerate(trees[0]))


def test_leaf_values_are_the_leaves(spark, trees):
    found = got(trees[1], W.leaf_values, "value")
    assert all(found[i] == Counter((v,) for _, v in all_leaves(d)) for i, d in enumerate(trees[0]))
    odd = {'a"b\\': ['\\"', "\\\\", 'x: "y"', "\n\t\x01", "é", "1", "true", "a:b", ":"], "k": [-0.5, 1e3, -7, 0, 1.25e-7, False, None, {"n": "q"}], "e" * 3: "\\" * 9999 + '"' * 9999}
    for t in (json.dumps(odd), json.dumps(odd, indent=3, ensure_ascii=False)):
        assert Counter(x.value for x in spark.range(1).select(W.leaf_values(F.lit(t)).alias("x")).first().x) == Counter(v.replace("e-07", "E-7") for _, v in all_leaves(odd))
    assert spark.range(1).select(W.leaf_values(F.lit("{1")).alias("x")).first().x == []


def test_schema_walks(trees):
    for walk, stops, declares in ((W.fields_of, 4, False), (W.property_names, 3, True)):
        found = got(trees[1], walk, "key", "kind")
        assert all(found[i] == Counter(seen(d, 0, stops, declares)) for i, d in enumerate(trees[0]))


def test_values_by_path_and_key(trees):
    def first(v):
        return v[0] if isinstance(v, list) and v else v

    def values(d, prefix, keyed):
        out = []
        for k, v in d.items():
            one = first(v)
            if isinstance(one, dict):
                out += values(one, k if keyed else f"{prefix}{k}{'[0].' if isinstance(v, list) else '.'}", keyed)
                out += [(f"{k}_count", str(len(v)))] if keyed and isinstance(v, list) else []
            elif v is not None and v != [] and not (keyed and v == ""):
                out.append((k if keyed else prefix + k, json.dumps(one)))
        return out

    for walk, keyed in ((W.path_values, False), (W.key_values, True)):
        found = got(trees[1], walk, "key", "value")
        for i, d in enumerate(trees[0]):
            want = Counter((k, json.dumps(json.loads(x), sort_keys=True)) for k, x in values(d, "", keyed))
            assert Counter((k, json.dumps(json.loads(x), sort_keys=True)) for k, x in found[i].elements()) == want


def test_comparable_values(trees):
    def values(d, depth):
        out = []
        for k, v in d.items() if depth <= 5 else ():
            for x in v[:10] if isinstance(v, list) else [v]:
                out += values(x, depth + 1) if isinstance(x, dict) else [(k, str(x))] if x is not None and x != "" and not isinstance(x, (bool, list)) else []
        return out

    found = got(trees[1], W.comparable_values, "key", "value")
    assert all(found[i] == Counter(values(d, 0)) for i, d in enumerate(trees[0]))


def test_odd_texts(spark):
    one = lambda f, t: spark.range(1).select(f(F.lit(t).cast("string")).alias("x")).first().x
    for t in (None, "", "{broken", "3", '"s"', "[]", "{}", "null"):
        assert one(W.entries, t) == [] and one(W.fields_of, t) == [] and one(W.path_values, t) == []
    assert [x.value for x in one(W.leaves, "3")] == ["3"]
    deep = "[" * 10 + "1" + "]" * 10
    assert [x.value for x in one(W.leaves, deep)] == ["1"]
    with pytest.raises(Exception, match="deeper"):
        one(W.leaves, "[" * 14 + "1" + "]" * 14)
