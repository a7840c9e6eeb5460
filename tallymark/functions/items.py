"""JSON metric documents: strict decoding into typed items.

Spark's JSON rules are lenient: ``"delta": 1.5`` or ``"delta": "7"`` becomes NULL and ``"id": 5``
the text ``5``, where a strict reader refuses the document. Documents that plainly have only the
right types take Spark's typed parse; all others are parsed into VARIANT fields, which keep the
JSON type of each field, and are checked.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("id", "type", "delta", "value")

_TYPED = "array<struct<id:string,type:string,delta:bigint,value:double>>"
_VARIANTS = "array<struct<id:variant,type:variant,delta:variant,value:variant>>"
_STANDARD_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# A field name in another case.
_ODD_KEY = r'"(?!(?:id|type|delta|value)")(?i:id|type|delta|value)"\s*+:'

# A document whose fields all have their JSON type, checked in one anchored pass without
# backtracking: plain texts, a delta within 18 digits, a value far from overflow, no other fields.
# Any other legal document only takes the slower parse.
_S = r"\s*+"
_TEXT_FIELD = rf'(?:id|type)"{_S}:{_S}"[^"\\]*+"'
_DELTA_FIELD = rf'delta"{_S}:{_S}-?[0-9]{{1,18}}+(?![0-9.eE])'
_VALUE_FIELD = rf'value"{_S}:{_S}-?[0-9]{{1,20}}+(?:\.[0-9]{{1,40}}+)?+(?:[eE][+-]?[0-9]{{1,2}}+)?+(?![0-9])'
_FIELD = rf'"(?:{_TEXT_FIELD}|{_DELTA_FIELD}|{_VALUE_FIELD}){_S}'
_OBJECT = rf"\{{{_S}(?:{_FIELD}(?:,{_S}{_FIELD})*+)?+\}}{_S}"
_CLEAN = rf"\A{_S}\[?+{_S}{_OBJECT}(?:,{_S}{_OBJECT})*+\]?+{_S}\z"

# One object without nesting and nothing after it but blanks. Possessive, so it never backtracks.
_FLAT_OBJECT = r'\A\s*+\{(?:[^{}\[\]"]++|"(?:[^"\\]++|\\.)*+")*+\}\s*+\z'


def _fold_key_case(doc: Column) -> Column:
    """Field names match in any case; rewrite the odd ones before the case-sensitive parse."""
    folded = doc
    for field in FIELDS:
        folded = F.regexp_replace(folded, rf'(?<!\\)"(?i:{field})"(\s*+:)', f'"{field}"$1')
    return F.when(doc.rlike(_ODD_KEY), folded).otherwise(doc)


def _has_type(v: Column, *prefixes: str) -> Column:
    """Whether a field is absent, ``null`` or of a JSON type whose name starts with a two-letter prefix."""
    return v.isNull() | F.substring(F.schema_of_variant(v), 1, 2).isin("VO", *prefixes)


def _has_types(e: Column) -> Column:
    value = F.try_variant_get(e["value"], "$", "double")
    return (
        _has_type(e["id"], "ST") & _has_type(e["type"], "ST")
        & _has_type(e["delta"], "BI") & _has_type(e["value"], "BI", "DE", "DO")
        & (value.isNull() | (F.abs(value) < F.lit(float("inf"))))
    )


def _typed(e: Column) -> Column:
    return F.struct(
        F.try_variant_get(e["id"], "$", "string").alias("id"),
        F.try_variant_get(e["type"], "$", "string").alias("type"),
        F.try_variant_get(e["delta"], "$", "bigint").alias("delta"),
        F.try_variant_get(e["value"], "$", "double").alias("value"),
    )


def decode_items(doc: Column) -> Column:
    """Array of ``(id, type, delta, value)``; NULL where the text is not a document of items.

    A single object gives one item, a ``null`` element a NULL or an empty one. Text after the first
    JSON value is ignored.
    """
    variants = F.from_json(_fold_key_case(doc), _VARIANTS, _STANDARD_JSON)
    strict = F.when(F.forall(variants, _has_types), F.transform(variants, _typed))
    return F.when(doc.rlike(_CLEAN), F.from_json(doc, _TYPED, _STANDARD_JSON)).otherwise(strict)


def stripped(doc: Column) -> Column:
    """The text without the JSON blanks around it."""
    return F.trim(doc, F.lit(" \t\r\n"))


def is_null_document(doc: Column) -> Column:
    return stripped(doc) == "null"


def starts_with(doc: Column, bracket: str) -> Column:
    """Whether the first JSON token is this bracket."""
    return F.ltrim(doc, F.lit(" \t\r\n")).startswith(bracket)


def has_unknown_field(doc: Column, many: bool = False) -> Column:
    """Whether the object, or with ``many`` any object of the array, has a field outside ``FIELDS``."""
    unknown = lambda m: F.exists(F.map_keys(m), lambda k: ~F.lower(k).isin(*FIELDS))
    if many:
        return F.exists(F.from_json(doc, "array<map<string,string>>", _STANDARD_JSON), unknown)
    return unknown(F.from_json(doc, "map<string,string>", _STANDARD_JSON))


def is_single_flat_object(doc: Column) -> Column:
    return doc.rlike(_FLAT_OBJECT)
