"""What an assistant is told of endpoints: identifiers and input schemas, with the way back to the names they stand for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.text import let
from .planning import mapped_type


def distinct_names(names: Column) -> Column:
    """Each name, or if one before has it, the name with the first number from 2 on that is free; numbered names take part like others."""
    def free(taken: Column, name: Column) -> Column:
        numbered = F.transform(F.sequence(F.lit(2), F.size(taken) + 2), lambda k: F.concat_ws("_", name, k.cast("string")))
        return F.when(~F.array_contains(taken, name), name).otherwise(F.get(F.filter(numbered, lambda x: ~F.array_contains(taken, x)), 0))

    return F.aggregate(names, F.array().cast("array<string>"), lambda taken, name: F.array_append(taken, free(taken, name)))


def definitions(endpoints: DataFrame) -> DataFrame:
    """``endpoints``: tool_name, name, description, required, optional (arrays of name, type, description). tool_name, name, identifier, about,
    input_schema (JSON text), and the parameters: identifier, name, type, required. Credentials are left out; names are made identifiers that
    differ from each other, so each leads back to one parameter."""
    plain = lambda c, needed: F.transform(F.filter(c, lambda p: ~T.auth_param(p["name"])), lambda p: F.struct(p["name"].alias("name"), mapped_type(p["type"]).alias("type"), F.coalesce(F.nullif(p["description"], F.lit("")), p["name"]).alias("about"), F.lit(needed).alias("required")))
    # Names are told apart once a row; as a column of its own Spark may put that into the loop over the parameters.
    safe = lambda p: distinct_names(F.transform(p, lambda x: T.param_identifier(x["name"])))
    given = lambda own, names: F.transform(own, lambda p, i: F.struct(F.get(names, i).alias("identifier"), p["name"].alias("name"), p["type"].alias("type"), p["about"].alias("about"), p["required"].alias("required")))
    rows = endpoints.withColumn("parameters", let(F.concat(plain("required", True), plain("optional", False)), lambda own: let(safe(own), lambda names: given(own, names))))
    text = lambda c: F.to_json(c.cast("variant"))
    one = lambda p: F.concat(text(p["identifier"]), F.lit(':{"type":'), text(p["type"]), F.lit(',"description":'), text(p["about"]), F.lit("}"))
    needed = F.transform(F.filter("parameters", lambda p: p["required"]), lambda p: text(p["identifier"]))
    schema = F.concat(F.lit('{"type":"object","properties":{'), F.array_join(F.transform("parameters", one), ","), F.lit('},"required":['), F.array_join(needed, ","), F.lit("]}"))
    identifier = F.concat_ws("__", T.tool_identifier(F.col("tool_name")), T.tool_identifier(F.col("name")))
    about = F.coalesce(F.nullif("description", F.lit("")), F.lit("No description available."))
    return rows.select("tool_name", "name", identifier.alias("identifier"), about.alias("about"), schema.alias("input_schema"), "parameters")


def named(calls: DataFrame, defined: DataFrame) -> DataFrame:
    """``calls``: identifier, ...; ``defined`` as of ``definitions``. The calls with tool_name and name; an identifier that stands for none is split at its first ``__``, or is both names."""
    back = defined.groupBy("identifier").agg(F.max(F.struct("tool_name", "name")).alias("n"))
    at = F.instr("identifier", "__")
    tool = F.when(at > 0, F.substring_index("identifier", "__", 1)).otherwise(F.col("identifier"))
    api = F.when(at > 0, F.expr("substring(identifier, instr(identifier, '__') + 2)")).otherwise(F.col("identifier"))
    return calls.join(back, "identifier", "left").withColumns({"tool_name": F.coalesce("n.tool_name", tool), "name": F.coalesce("n.name", api)}).drop("n")
