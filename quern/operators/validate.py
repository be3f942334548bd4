"""Record rules: which rows are valid, what is wrong with the others, and a compiler for JSON Schemas."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.names import employee_count, pricing_model
from quern.functions.urls import clean_repository_url, stripped


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def record_errors(kind: Column, *, name: Column, source_name: Column, source_url: Column, pricing: Column, stars: Column) -> Column:
    """What is wrong with a record by the rules of collection, as an array of texts; empty if nothing is.

    Papers may lack a source; pricing is read from free text; counts are null or zero and more.
    """
    sourced = kind != "RESEARCH_PAPER"
    rules = [
        (~kind.isin("STARTUP", "PRODUCT", "RESEARCH_PAPER", "JOB"), "recordType: unknown"),
        (_blank(name), "name: empty"),
        (sourced & _blank(source_name), "source.name: empty"),
        (sourced & _blank(source_url), "source.url: empty"),
        ((kind == "PRODUCT") & pricing_model(F.coalesce(pricing, F.lit(""))).isNull(), "pricingModel: unknown"),
        ((kind == "RESEARCH_PAPER") & (stars < 0), "github_stars: below 0"),
    ]
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for bad, text in rules)))


def validated(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows with coerced values, and the others with their errors (never dropped).

    records: kind, name, source_name, source_url, pricing, employees, repository, stars, and what else there is.
    """
    errors = record_errors(F.col("kind"), name=F.col("name"), source_name=F.col("source_name"), source_url=F.col("source_url"), pricing=F.col("pricing"), stars=F.col("stars"))
    df = records.withColumn("errors", errors)
    good = df.where(F.size("errors") == 0).drop("errors")
    coerced = {"pricing": pricing_model(F.col("pricing")), "employees": employee_count(F.col("employees")), "repository": clean_repository_url(F.col("repository"))}
    return good.withColumns(coerced), df.where(F.size("errors") > 0)


class Schema:
    """A JSON Schema (type, required, enum, const, minLength, minimum, maximum, anyOf with null, items, properties) over a
    column of type variant, as one expression that gives all errors.

    The schema is a constant, so the expression is built once; nothing of it runs in Python.
    """

    # What schema_of_variant calls the types of JSON.
    TYPES = {"object": "OBJECT", "array": "ARRAY", "string": "STRING", "boolean": "BOOLEAN", "null": "VOID"}

    def __init__(self, schema: dict) -> None:
        self.schema = schema

    def errors(self, value: Column) -> Column:
        """An array of ``path text``, in order of the schema; a null column is not JSON at all."""
        found = F.array_compact(F.array(*self._rules(value, self.schema, "$", "/"))) if self._rules(value, self.schema, "$", "/") else F.array().cast("array<string>")
        each = [e for e in self._items(value, self.schema, "$", "/")]
        every = F.concat(found, *each) if each else found
        return F.when(value.isNull(), F.array(F.lit("/ is not JSON"))).otherwise(every)

    def message(self, value: Column) -> Column:
        return F.concat_ws("; ", self.errors(value))

    def _kind(self, value: Column, path: str) -> Column:
        """The JSON type at a path: upper-case, null if there is nothing."""
        return F.upper(F.schema_of_variant(F.try_variant_get(value, path, "variant")))

    def _is(self, kind: Column, name: str) -> Column:
        if name in ("number", "integer"):
            return kind.rlike("^(BIGINT|DECIMAL|INT|SMALLINT|TINYINT)" if name == "integer" else "^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
        return F.startswith(kind, F.lit(self.TYPES[name]))

    def _rules(self, value: Column, schema: dict, path: str, shown: str) -> list[Column]:
        kind, out = self._kind(value, path), []
        there = kind.isNotNull()
        bad = lambda when, text: out.append(F.when(F.coalesce(when, F.lit(False)), F.lit(f"{shown} {text}")))
        if "anyOf" in schema:
            tries = [F.size(F.array_compact(F.array(*self._rules(value, s, path, shown)))) == 0 if self._rules(value, s, path, shown) else F.lit(True) for s in schema["anyOf"]]
            bad(there & ~functools.reduce(lambda a, b: a | b, tries), "must match a schema in anyOf")
        if "type" in schema:
            names = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
            bad(there & ~functools.reduce(lambda a, b: a | b, (self._is(kind, n) for n in names)), f"must be {','.join(names)}")
        text, number = F.try_variant_get(value, path, "string"), F.try_variant_get(value, path, "double")
        if "enum" in schema:
            allowed = [x for x in schema["enum"] if x is not None]
            null = self._is(kind, "null") if None in schema["enum"] else F.lit(False)
            bad(there & ~(text.isin(*map(str, allowed)) | null), "must be equal to one of the allowed values")
        if "const" in schema:
            bad(there & (text != str(schema["const"])), "must be equal to constant")
        if "minLength" in schema:
            bad(self._is(kind, "string") & (F.length(text) < schema["minLength"]), f"must NOT have fewer than {schema['minLength']} characters")
        if "minimum" in schema:
            bad(self._is(kind, "number") & (number < schema["minimum"]), f"must be >= {schema['minimum']}")
        if "maximum" in schema:
            bad(self._is(kind, "number") & (number > schema["maximum"]), f"must be <= {schema['maximum']}")
        for name in schema.get("required", []):
            bad(self._is(kind, "object") & self._kind(value, f"{path}['{name}']").isNull(), f"must have required property '{name}'")
        for name, inner in schema.get("properties", {}).items():
            out += self._rules(value, inner, f"{path}['{name}']", f"{shown.rstrip('/')}/{name}")
        return out

    def _items(self, value: Column, schema: dict, path: str, shown: str) -> list[Column]:
        """For each array of the schema an array of its items' errors."""
        out = []
        if "items" in schema:
            items = F.coalesce(F.try_variant_get(value, path, "array<variant>"), F.array().cast("array<variant>"))
            rules = lambda v: F.array_compact(F.array(*self._rules(v, schema["items"], "$", f"{shown}/items")))
            out.append(F.flatten(F.transform(items, rules)))
        for name, inner in schema.get("properties", {}).items():
            out += self._items(value, inner, f"{path}['{name}']", f"{shown.rstrip('/')}/{name}")
        return out


# What an extracted record of each kind must have, and of which type.
_TEXT, _NAME, _COUNT = {"type": "string"}, {"type": "string", "minLength": 1}, {"type": "integer", "minimum": 0}
_CONTENTS = {
    "STARTUP": (["entityName"], {"entityName": _NAME, "data": {"type": "object", "properties": {"employeeCount": {"anyOf": [_COUNT, {"type": "null"}]}}}}),
    "PRODUCT": (["startupName", "pricingModel"], {"startupName": _NAME, "pricingModel": {"type": "string", "enum": ["FREE", "FREEMIUM", "PAID", "ENTERPRISE"]}}),
    "RESEARCH_PAPER": (
        ["title", "authors", "paper_url", "github_stars", "published_date"],
        {"title": _NAME, "authors": {"type": "array", "items": _TEXT}, "paper_url": _NAME, "github_url": {"anyOf": [_TEXT, {"type": "null"}]}, "github_stars": _COUNT, "published_date": _TEXT},
    ),
    "JOB": (["company", "date", "is_remote", "role_family"], {"company": _NAME, "date": _TEXT, "is_remote": {"type": "boolean"}, "role_family": _NAME}),
}


def canonical_schema(kind: str) -> dict:
    """The schema of extracted records of a kind: stricter than the rules of collection (no coercion, papers need a source). Jobs
    may lack a source and the time of collection."""
    required, properties = _CONTENTS[kind]
    loose = kind == "JOB"
    source = {"type": "object", "properties": {"name": _TEXT, "url": _TEXT}} if loose else {"type": "object", "required": ["name", "url"], "properties": {"name": _NAME, "url": _NAME}}
    return {
        "type": "object", "required": ["schemaVersion", "recordType", "content"] if loose else ["schemaVersion", "recordType", "source", "content", "collectedAt"],
        "properties": {
            "schemaVersion": {"type": "string", "enum": ["1.0"]}, "recordType": {"type": "string", "enum": [kind]}, "source": source,
            "content": {"type": "object", "required": required, "properties": properties}, "collectedAt": _TEXT,
        },
    }


def trimmed_or_null(text: Column) -> Column:
    return F.nullif(stripped(text), F.lit(""))
