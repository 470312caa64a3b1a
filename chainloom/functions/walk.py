"""Walks over JSON texts of any depth, as column expressions over VARIANT.

A walk goes level by level: a column holds the nodes that are still open, an expression says what a level gives
and what it opens, and each level binds the next one's nodes once. So a text stays one row, and no Python worker is needed.
Keys of an object come in order of their names. A text that is no JSON, or names a key of one object
twice, has nothing. Walks without a bound of their own go ``LEVELS`` deep and raise an error at a deeper text.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, normal_name

#: Words that mark a schema's own keys, and texts that stand for types.
SCHEMA_WORDS = ("type", "properties", "items", "required", "description", "default", "enum", "format", "additionalProperties")
TYPE_WORDS = ("str", "int", "float", "bool", "string", "integer", "number", "boolean")

ITEM = "array<struct<key: string, kind: string, value: string>>"
#: ``t``: the first two letters of the value's type, worked out once a node.
NODE = "array<struct<key: string, v: variant, t: string>>"
LEVELS = 12


def _object(v: Column) -> Column:
    """An object's entries; none of anything else."""
    return F.coalesce(F.map_entries(v.try_cast("map<string, variant>")), F.array().cast("array<struct<key: string, value: variant>>"))


def _list(v: Column) -> Column:
    return F.coalesce(v.try_cast("array<variant>"), F.array().cast("array<variant>"))


def _type(v: Column) -> Column:
    return F.substring(F.schema_of_variant(v), 1, 2)


def _is(node: Column, *types: str) -> Column:
    return node["t"].isin(*[t[:2] for t in types])


def _kind(t: Column) -> Column:
    return F.when(t == "BO", "boolean").when(t.isin("ST", "OB", "AR", "VO"), "string").otherwise("number")


def _text(node: Column) -> Column:
    """As Python shows a value, but for exponents: booleans with a capital, numbers that aren't whole or have an exponent as doubles."""
    shown = node["v"].cast("string")
    return F.when(_is(node, "BOOLEAN"), F.initcap(shown)).when(_is(node, "DOUBLE") | (_is(node, "DECIMAL") & shown.contains(".")), node["v"].try_cast("double").cast("string")).otherwise(shown)


def _item(key: Column, node: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), _kind(node["t"]).alias("kind"), value.alias("value"))


def _node(key: Column, v: Column) -> Column:
    return F.struct(key.alias("key"), v.alias("v"), _type(v).alias("t"))


def _children(node: Column) -> Column:
    """An object's entries; none of anything else."""
    return F.when(_is(node, "OBJECT"), _object(node["v"])).otherwise(F.array().cast("array<struct<key: string, value: variant>>"))


def _elements(node: Column) -> Column:
    return F.when(_is(node, "ARRAY"), _list(node["v"])).otherwise(F.array().cast("array<variant>"))


def _each(nodes: Column, f: Callable[[Column], Column]) -> Column:
    return F.flatten(F.transform(nodes, f))


def _entries(nodes: Column) -> Column:
    """The entries of all objects among the nodes, under (their node's key, own key)."""
    return _each(nodes, lambda n: F.transform(_children(n), lambda e: F.struct(n["key"].alias("under"), e["key"].alias("key"), e["value"].alias("v"), _type(e["value"]).alias("t"))))


def _walk(text: Column, gives: Callable[[Column], Column], opens: Callable[[Column], Column], levels: int = LEVELS, whole: bool = True, sees: Callable[[Column], Column] = lambda nodes: nodes, parts: tuple[str, ...] = ()) -> Column:
    """``gives`` maps what is seen of a level to items, ``opens`` to the next level's nodes. ``sees`` makes of nodes, once a level, what both look
    at: an array, or a struct of the arrays ``parts``. ``whole``: more levels than these are an error."""
    none = F.array().cast(ITEM)

    def level(seen: Column, left: int) -> Column:
        empty = F.size(seen) == 0 if not parts else functools.reduce(operator.and_, [F.size(seen[p]) == 0 for p in parts])
        if not left:
            return F.when(~empty, F.raise_error(F.lit(f"JSON is nested deeper than {levels} levels")).cast(ITEM)).otherwise(none) if whole else none
        if left == 1 and not whole:
            return F.when(empty, none).otherwise(gives(seen).cast(ITEM))
        return F.when(empty, none).otherwise(let(sees(opens(seen)), lambda more: F.concat(gives(seen).cast(ITEM), level(more, left - 1))))

    top = F.transform(F.filter(F.array(F.try_parse_json(text)), lambda v: v.isNotNull()), lambda v: _node(F.lit(""), v))
    return let(sees(top.cast(NODE)), lambda seen: level(seen, levels))


def _filled(node: Column) -> Column:
    """Neither a container nor null nor an empty text."""
    return ~_is(node, "OBJECT", "ARRAY", "VOID") & (node["v"].cast("string") != "")


def leaves(text: Column) -> Column:
    """All texts that aren't empty, numbers and booleans, with the key they lie under."""
    open_ = lambda nodes: _each(nodes, lambda n: F.concat(F.transform(_children(n), lambda e: _node(e["key"], e["value"])), F.transform(_elements(n), lambda x: _node(n["key"], x))))
    return _walk(text, lambda nodes: F.transform(F.filter(nodes, lambda n: _filled(n)), lambda n: _item(n["key"], n, _text(n))), open_)


def leaf_values(text: Column) -> Column:
    """The values of ``leaves``, at any depth, without their keys: a JSON text's scalars are its tokens, and a quoted one before a colon is a key.

    Escaped quotes and backslashes are put aside as control characters first, which valid JSON has none of, so a quote ends its token."""
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit("\x02")), F.lit('\\"'), F.lit("\x01"))
    tokens = F.regexp_extract_all(plain, F.lit('"[^"]*+"(?:\\s*+:)?|-?[0-9][0-9.eE+-]*+|true|false'), F.lit(0))
    whole = lambda t: F.try_parse_json(F.replace(F.replace(t, F.lit("\x01"), F.lit('\\"')), F.lit("\x02"), F.lit("\\\\"))).cast("string")

    def item(t: Column) -> Column:
        quoted = t.startswith('"')
        simple = ~t.rlike("[\\\\\x01\x02]")
        value = F.when(quoted & simple, F.substring(t, F.lit(2), F.length(t) - 2)).when(t == "true", "True").when(t == "false", "False").when(~quoted & t.rlike("[.eE]"), t.try_cast("double").cast("string")).when(t.rlike("^[1-9][0-9]*$"), t).otherwise(whole(t))
        return F.struct(F.lit("").alias("key"), F.when(quoted, "string").when(t.isin("true", "false"), "boolean").otherwise("number").alias("kind"), value.alias("value"))

    kept = F.transform(F.filter(tokens, lambda t: ~t.endswith(":") & (t != '""')), item)
    return F.when(F.try_parse_json(text).isNotNull(), kept.cast(ITEM)).otherwise(F.array().cast(ITEM))


def entries(text: Column) -> Column:
    """The scalars among a JSON object's own values."""
    own = lambda nodes: F.filter(_entries(nodes), _filled)
    return _walk(text, lambda nodes: F.transform(own(nodes), lambda e: _item(e["key"], e, _text(e))), lambda nodes: F.array().cast(NODE), 1, whole=False)


def _firsts(nodes: Column) -> Column:
    """Entries whose value is, of a list, the first element: with ``n``, the list's length, and null for an empty one."""
    def first(e: Column, listed: Column) -> Column:
        own, v = listed.isNull(), F.get(listed, 0)
        return F.struct(e["under"].alias("under"), e["key"].alias("key"), F.when(own, e["v"]).otherwise(v).alias("v"), F.when(own, e["t"]).otherwise(F.coalesce(_type(v), F.lit(""))).alias("t"), F.when(~own, F.size(listed)).alias("n"))

    return F.transform(_entries(nodes), lambda e: let(F.when(_is(e, "ARRAY"), _list(e["v"])), lambda listed: first(e, listed)))


def _plain(e: Column, empty: bool) -> Column:
    """Whether an entry is a value: no object, no null, and no list that is empty or of objects. ``empty``: an empty text is one too."""
    listed = e["n"].isNotNull()
    return ~_is(e, "OBJECT") & (e["t"] != "") & (listed | ~_is(e, "VOID")) & (F.lit(True) if empty else listed | (e["v"].cast("string") != ""))


def _inner(firsts: Column, name: Callable[[Column], Column]) -> Column:
    """The objects that lie in entries, themselves or first in a list."""
    return F.transform(F.filter(firsts, lambda e: _is(e, "OBJECT")), lambda e: F.struct(name(e).alias("key"), e["v"].alias("v"), e["t"].alias("t")))


def path_values(text: Column) -> Column:
    """Values (JSON texts) under dotted paths; of a list the first element alone, marked ``[0]`` if it is an object."""
    found = lambda firsts: F.transform(F.filter(firsts, lambda e: _plain(e, True)), lambda e: _item(F.concat(e["under"], e["key"]), e, F.to_json(e["v"])))
    return _walk(text, found, lambda firsts: _inner(firsts, lambda e: F.concat(e["under"], e["key"], F.when(e["n"].isNotNull(), "[0].").otherwise("."))), sees=_firsts)


def key_values(text: Column) -> Column:
    """Values (JSON texts) under their bare keys; of a list of objects the first, and its length as ``<key>_count``."""
    counted = lambda firsts: F.transform(F.filter(firsts, lambda e: e["n"].isNotNull() & _is(e, "OBJECT")), lambda e: F.struct(F.concat(e["key"], F.lit("_count")).alias("key"), F.lit("number").alias("kind"), e["n"].cast("string").alias("value")))
    found = lambda firsts: F.transform(F.filter(firsts, lambda e: _plain(e, False)), lambda e: _item(e["key"], e, F.to_json(e["v"])))
    return _walk(text, lambda firsts: F.concat(found(firsts).cast(ITEM), counted(firsts).cast(ITEM)), lambda firsts: _inner(firsts, lambda e: e["key"]), sees=_firsts)


def aliased(items: Column) -> Column:
    """``items`` (a column, as it is read twice) and, under the normal form of its key, each whose key has another."""
    alias = lambda x: F.trim(normal_name(x["key"], "session"), F.lit("_"))
    named = lambda own: F.transform(own, lambda x: F.struct(alias(x).alias("key"), x["kind"].alias("kind"), x["value"].alias("value"), x["key"].alias("old")))
    more = lambda own: F.transform(F.filter(named(own), lambda x: x["key"] != x["old"]), lambda x: F.struct(x["key"].alias("key"), x["kind"].alias("kind"), x["value"].alias("value")))
    return F.concat(items.cast(ITEM), more(items).cast(ITEM))


def comparable_values(text: Column) -> Column:
    """Texts and numbers under their keys, of lists the first ten elements, five levels below the top; no booleans."""
    items = lambda nodes: _each(_entries(nodes), lambda e: F.transform(F.when(_is(e, "ARRAY"), F.slice(_list(e["v"]), 1, 10)).otherwise(F.array(e["v"])), lambda x: _node(e["key"], x)))
    found = lambda own: F.transform(F.filter(own, lambda n: _filled(n) & ~_is(n, "BOOLEAN")), lambda n: _item(n["key"], n, _text(n)))
    return _walk(text, found, lambda own: F.filter(own, lambda n: _is(n, "OBJECT")), 6, whole=False, sees=items)


def _properties(nodes: Column) -> Column:
    """The entries of the nodes' ``properties``."""
    return _each(nodes, lambda n: F.transform(_object(F.try_variant_get(n["v"], "$.properties", "variant")), lambda e: _node(e["key"], e["value"])))


def _below(nodes: Column) -> Column:
    """Each object node, and the object in its ``items``."""
    objects = F.filter(nodes, lambda n: _is(n, "OBJECT"))
    inside = F.transform(objects, lambda n: _node(n["key"], F.try_variant_get(n["v"], "$.items", "variant")))
    return F.concat(objects, F.filter(inside, lambda n: F.coalesce(_is(n, "OBJECT"), F.lit(False))))


def fields_of(schema: Column) -> Column:
    """Names with their types, of JSON Schema and of plain examples of types, four levels below the top."""
    declared = lambda nodes: F.filter(_properties(nodes), lambda p: _is(p, "OBJECT"))
    other = lambda nodes: F.filter(_entries(nodes), lambda e: ~e["key"].isin(*SCHEMA_WORDS))
    typed = lambda e: _is(e, "STRING") & F.lower(e["v"].cast("string")).isin(*TYPE_WORDS)
    named = lambda key, kind: F.struct(key.alias("key"), kind.alias("kind"), F.lit("").alias("value"))

    def gives(seen: Column) -> Column:
        kind = lambda p: let(F.try_variant_get(p["v"], "$.type", "variant"), lambda k: F.when(F.coalesce(_type(k) == "ST", F.lit(False)), k.cast("string")).otherwise("string"))
        of_schema = F.transform(seen["declared"], lambda p: named(p["key"], kind(p)))
        shown = F.filter(seen["other"], lambda e: typed(e) | _is(e, "OBJECT", "ARRAY"))
        return F.concat(of_schema.cast(ITEM), F.transform(shown, lambda e: named(e["key"], F.when(_is(e, "OBJECT"), "object").when(_is(e, "ARRAY"), "array").otherwise(e["v"].cast("string")))).cast(ITEM))

    def opens(seen: Column) -> Column:
        example = lambda e: F.when(_is(e, "ARRAY"), F.get(F.filter(_list(e["v"]), lambda x: _type(x) == "OB"), 0)).when(_is(e, "OBJECT"), e["v"])
        return F.concat(_below(seen["declared"]).cast(NODE), F.filter(F.transform(seen["other"], lambda e: _node(e["key"], example(e))), lambda n: n["v"].isNotNull()).cast(NODE))

    return _walk(schema, gives, opens, 5, whole=False, sees=lambda nodes: let(nodes, lambda n: F.struct(declared(n).alias("declared"), other(n).alias("other"))), parts=("declared", "other"))


def property_names(schema: Column) -> Column:
    """Names of JSON Schema properties, each as often as it is declared, three levels below the top."""
    gives = lambda own: F.transform(own, lambda p: F.struct(p["key"].alias("key"), F.lit("").alias("kind"), F.lit("").alias("value")))
    return _walk(schema, gives, _below, 4, whole=False, sees=_properties)
