"""Scalar functions on names, types and descriptions, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def normal_name(name: Column, mode: str = "graph") -> Column:
    """snake_case of a field name. Modes differ on purpose: ``graph`` splits acronyms and joins underscores,
    ``judge`` also maps other characters to underscores, ``simple`` splits once, ``session`` splits acronyms only."""
    out = F.regexp_replace(name, "([a-z0-9])([A-Z])", "$1_$2")
    if mode != "simple":
        out = F.regexp_replace(out, "([A-Z]+)([A-Z][a-z])", "$1_$2")
    out = F.lower(out)
    if mode == "judge":
        out = F.regexp_replace(out, "[^a-z0-9]+", "_")
    if mode in ("graph", "judge"):
        out = F.regexp_replace(out, "_+", "_")
    return out if mode == "session" else F.trim(out, F.lit("_"))


def field_root(name: Column) -> Column:
    return F.regexp_replace(normal_name(name), f"^(.+)_({'|'.join(K.ROOT_SUFFIXES)})$", "$1")


def normal_type(raw: Column) -> Column:
    bare = F.trim(F.regexp_replace(F.lower(F.trim(raw)), r"\s*\(.*\)", ""))
    known = F.create_map(*[F.lit(x) for pair in K.TYPE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, bare), F.lit("string"))


def normal_method(raw: Column) -> Column:
    upper = F.trim(F.upper(raw))
    return F.when(upper.isin(*K.METHODS), upper).otherwise("GET")


def types_compatible(a: Column, b: Column) -> Column:
    loose = ("string", "integer", "number")
    return (a == b) | (a.isin(*loose) & b.isin(*loose))


def clean_description(text: Column) -> Column:
    """Without tags, boilerplate, closing quotes and repeated white space; placeholders become empty."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", "")
    out = F.regexp_replace(out, r'This is the subfunction for tool "[^"]+",?\s*you can use this tool\.?\s*', "")
    out = F.regexp_replace(out, r'The description of this function is:\s*"?', "")
    out = F.trim(F.regexp_replace(F.regexp_replace(out, r'"+$', ""), r"\s+", " "))
    return let(out, lambda x: F.when(x.isin("-", "N/A", "n/a", "None", "none", "null", "..."), "").otherwise(x))


def standard_name(name: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), "[^a-zA-Z0-9]+", "_"), F.lit("_"))


def human_name(name: Column) -> Column:
    spaced = F.translate(name, "_-", "  ")
    return F.concat(F.upper(F.substring(spaced, 1, 1)), F.lower(F.substring(spaced, 2, 1 << 30)))


def dedup_name(name: Column) -> Column:
    out = F.lower(F.trim(name))
    for pattern in (r"[_\s]*v\d+$", r"\s*\(v\d+\)", r"[_\s]+\d+$", r"[^a-z0-9\s]"):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, r"\s+", " "))


def junk_name(name: Column) -> Column:
    return ~F.substring(name, 1, 1).rlike("^[\\x00-\\x7F]?$") | name.rlike("(?i)" + "|".join(K.JUNK_NAMES))


def auth_param(name: Column) -> Column:
    """Whether a parameter is a credential; ``key`` alone is not."""
    n = F.trim(F.translate(F.lower(name), "-", "_"), F.lit("_"))
    tokens = "|".join(K.AUTH_TOKENS)
    return F.coalesce(n.rlike(f"^({tokens})$|_({tokens})$|^({tokens})_|{'|'.join(K.AUTH_PARTS)}"), F.lit(False))


def scenario_param(name: Column, description: Column) -> Column:
    """Whether a scenario should not mention a parameter: credentials by name or description, infrastructure by name."""
    both = F.lower(F.concat_ws(" ", F.coalesce(name, F.lit("")), F.coalesce(description, F.lit(""))))
    return both.rlike("|".join(K.SCENARIO_AUTH)) | F.lower(F.coalesce(name, F.lit(""))).rlike("|".join(K.SCENARIO_INFRA))


def tool_identifier(name: Column) -> Column:
    plain = F.regexp_replace(name, "[^a-zA-Z0-9_]", "_")
    return F.substring(F.when(plain.rlike("^[^a-zA-Z]"), F.concat(F.lit("t_"), plain)).otherwise(plain), 1, 60)


def param_identifier(name: Column) -> Column:
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^a-zA-Z0-9_.\-]", "_"), "_+", "_"), F.lit("_"))
    return let(plain, lambda p: F.when(p == "", "param").otherwise(F.substring(p, 1, 64)))


def short_description(text: Column) -> Column:
    """At most 200 characters, cut at the last full stop if that lies beyond the 51st character."""
    head = F.substring(text, 1, 200)
    stop = F.length(head) - F.locate(".", F.reverse(head))  # place from 0; the length itself if there is none
    has = F.locate(".", head) > 0
    cut = F.when(has & (stop > 50), F.substring(head, F.lit(1), stop + 1)).otherwise(F.concat(head, F.lit("...")))
    return F.trim(F.when(F.length(text) > 200, cut).otherwise(F.coalesce(text, F.lit(""))))


def endpoint_parts(endpoint: Column) -> tuple[Column, Column]:
    """(tool, api): at the first slash; without one both are the whole."""
    at = F.instr(endpoint, "/")
    rest = F.try_element_at(F.split(endpoint, "/", 2), F.lit(2))
    return F.when(at > 0, F.substring_index(endpoint, "/", 1)).otherwise(endpoint), F.when(at > 0, rest).otherwise(endpoint)


def clamp(score: Column) -> Column:
    """To [1, 5]; what is no number is 3."""
    number = score.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), 3.0).otherwise(F.greatest(F.lit(1.0), F.least(F.lit(5.0), number)))
