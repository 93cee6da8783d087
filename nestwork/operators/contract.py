"""Contract audit for rate files (Q4).

The declared contract of an in-network rate file (enums, required fields,
anyOf / oneOf, uniqueItems, URI pattern, dates, dependentRequired) is kept
here as data.  Every rule is compiled into one boolean over the element it
applies to, and all levels are walked with nested ``transform`` calls inside
the file row, so the audit is ONE pass with no exchange and returns one row per
(file, rule, JSON path) violation.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import array_pattern, fits_sql, object_pattern

# Enumerations declared by the contract.
BILLING_CODE_TYPES = ["CPT", "HCPCS", "ICD", "MS-DRG", "R-DRG", "S-DRG", "APS-DRG", "AP-DRG", "APR-DRG",
                      "APC", "NDC", "HIPPS", "LOCAL", "EAPG", "CDT", "RC", "CSTM-ALL"]
NEGOTIATION_ARRANGEMENTS = ["ffs", "bundle", "capitation"]
TIN_TYPES = ["ein", "npi"]
BILLING_CLASSES = ["professional", "institutional", "both"]
NEGOTIATED_TYPES = ["negotiated", "derived", "fee schedule", "percentage", "per diem"]
PLAN_MARKET_TYPES = ["group", "individual"]
# Place-of-service codes: two-digit 01..99 plus one custom code (built from the rule).
SERVICE_CODES = [f"{i:02d}" for i in range(1, 100)] + ["CSTM-00"]
PLAN_FIELDS = ["plan_name", "plan_id_type", "plan_id", "plan_market_type"]
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
URI_PATTERN = "^https://"

# level -> (parent level, array field in the parent)
LEVELS = {
    "root": (None, None),
    "provider_references": ("root", "provider_references"),
    "provider_references.provider_groups": ("provider_references", "provider_groups"),
    "in_network": ("root", "in_network"),
    "in_network.covered_services": ("in_network", "covered_services"),
    "in_network.bundled_codes": ("in_network", "bundled_codes"),
    "negotiated_rates": ("in_network", "negotiated_rates"),
    "negotiated_rates.provider_groups": ("negotiated_rates", "provider_groups"),
    "negotiated_prices": ("negotiated_rates", "negotiated_prices"),
}


def _in(field: str, values: Sequence[str]) -> str:
    vals = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"(x.{field} IS NULL OR x.{field} IN ({vals}))"


def _required(*fields: str) -> list[tuple[str, str, str]]:
    return [(f, "required", f"x.{f} IS NOT NULL") for f in fields]


def _unique(field: str) -> tuple[str, str, str]:
    return (field, "uniqueItems", f"(x.{field} IS NULL OR size(array_distinct(x.{field})) = size(x.{field}))")


def _date(field: str) -> tuple[str, str, str]:
    return (field, "date", f"(x.{field} IS NULL OR (x.{field} RLIKE '{DATE_PATTERN}' "
                           f"AND try_to_date(x.{field}, 'yyyy-MM-dd') IS NOT NULL))")


_CODE_RULES = [*_required("billing_code_type", "billing_code_type_version", "billing_code", "description"),
               ("billing_code_type", "enum", _in("billing_code_type", BILLING_CODE_TYPES))]
_PROVIDER_RULES = [*_required("npi", "tin"), _unique("npi"),
                   ("tin", "required", "(x.tin IS NULL OR (x.tin.type IS NOT NULL AND x.tin.value IS NOT NULL))"),
                   ("tin.type", "enum", "(x.tin.type IS NULL OR x.tin.type IN (" + ", ".join(f"'{t}'" for t in TIN_TYPES) + "))")]

# level -> [(field, kind, passing predicate over element x)]
RULES: dict[str, list[tuple[str, str, str]]] = {
    "root": [
        *_required("reporting_entity_name", "reporting_entity_type", "last_updated_on", "in_network", "version"),
        ("plan_market_type", "enum", _in("plan_market_type", PLAN_MARKET_TYPES)),
        _date("last_updated_on"),
        *[(f, "dependentRequired",
           f"(x.{f} IS NULL OR (" + " AND ".join(f"x.{o} IS NOT NULL" for o in PLAN_FIELDS if o != f) + "))")
          for f in PLAN_FIELDS],
    ],
    "provider_references": [
        *_required("provider_group_id"),
        ("", "anyOf", "(x.location IS NOT NULL OR x.provider_groups IS NOT NULL)"),
        _unique("provider_groups"),
        ("location", "pattern", f"(x.location IS NULL OR x.location RLIKE '{URI_PATTERN}')"),
    ],
    "provider_references.provider_groups": _PROVIDER_RULES,
    "in_network": [
        *_required("negotiation_arrangement", "name", "billing_code_type", "billing_code_type_version",
                   "billing_code", "negotiated_rates", "description"),
        ("negotiation_arrangement", "enum", _in("negotiation_arrangement", NEGOTIATION_ARRANGEMENTS)),
        ("billing_code_type", "enum", _in("billing_code_type", BILLING_CODE_TYPES)),
    ],
    "in_network.covered_services": _CODE_RULES,
    "in_network.bundled_codes": _CODE_RULES,
    "negotiated_rates": [
        *_required("negotiated_prices"),
        ("", "oneOf", "((x.provider_references IS NOT NULL) <> (x.provider_groups IS NOT NULL))"),
        _unique("negotiated_prices"), _unique("provider_groups"), _unique("provider_references"),
    ],
    "negotiated_rates.provider_groups": _PROVIDER_RULES,
    "negotiated_prices": [
        *_required("negotiated_type", "billing_class", "negotiated_rate", "expiration_date"),
        ("negotiated_type", "enum", _in("negotiated_type", NEGOTIATED_TYPES)),
        ("billing_class", "enum", _in("billing_class", BILLING_CLASSES)),
        ("service_code", "enum", "(x.service_code IS NULL OR forall(x.service_code, s -> s IN ("
         + ", ".join(f"'{c}'" for c in SERVICE_CODES) + ")))"),
        _unique("service_code"), _unique("billing_code_modifier"), _date("expiration_date"),
        # an absent class breaks ``required`` alone
        ("", "oneOf", "(x.billing_class IS NULL OR "
                      "(coalesce(x.billing_class = 'professional' AND x.service_code IS NOT NULL, false)) <> "
                      "(coalesce(x.billing_class IN ('institutional', 'both'), false)))"),
    ],
}


def _chain(level: str) -> list[tuple[str, str]]:
    out = []
    while level != "root":
        parent, field = LEVELS[level]
        out.append((level, field))
        level = parent
    return list(reversed(out))


def _violations_sql(level: str, doc: str) -> str:
    chain = _chain(level)
    checks = []
    for field, kind, ok in RULES[level]:
        rule = f"{level}.{field}.{kind}" if field else f"{level}.{kind}"
        path_tail = f"'.{field}'" if field else "''"
        checks.append(f"CASE WHEN NOT coalesce({ok}, false) THEN struct('{rule}' AS rule, "
                      f"concat(__PATH__, {path_tail}) AS path) END")
    body = f"filter(array({', '.join(checks)}), v -> v IS NOT NULL)"
    chain_depth = len(chain)

    def bind(text: str, elem: str, path: str) -> str:
        return re.sub(r"\bx\.", elem + ".", text).replace("__PATH__", path)

    if not chain_depth:
        return bind(body, doc, "'$'")
    inner = bind(body, f"e{chain_depth}", f"p{chain_depth}")
    for d in range(chain_depth, 0, -1):
        _, field = chain[d - 1]
        parent = doc if d == 1 else f"e{d - 1}"
        parent_path = "'$'" if d == 1 else f"p{d - 1}"
        inner = (f"flatten(transform(coalesce({parent}.{field}, array()), (e{d}, i{d}) -> "
                 f"transform(array(concat({parent_path}, '.{field}[', CAST(i{d} AS STRING), ']')), p{d} -> {inner})[0]))")
    return inner


def audit(docs: DataFrame, doc: str = "doc", keep: Sequence[str] = ("file_path",)) -> DataFrame:
    """One row per violation: (keep..., rule, path)."""
    arrays = [_violations_sql(level, doc) for level in RULES]
    return (docs.select(*keep, F.explode(F.expr(f"concat({', '.join(arrays)})")).alias("v"))
            .select(*keep, "v.rule", "v.path"))


# The declared JSON types of the fields that are no arrays of a level; "[x]" is an array of x.
_CODE_TYPES = dict.fromkeys(["billing_code_type", "billing_code_type_version", "billing_code", "description"], "string")
_PROVIDER_TYPES = {"npi": "[number]", "tin": "object", "tin.type": "string", "tin.value": "string"}
TYPES: dict[str, dict[str, str]] = {
    "root": {**dict.fromkeys(["reporting_entity_name", "reporting_entity_type", "plan_name", "plan_id_type", "plan_id", "plan_market_type",
                              "last_updated_on", "version"], "string")},
    "provider_references": {"provider_group_id": "number", "location": "string"},
    "provider_references.provider_groups": _PROVIDER_TYPES,
    "in_network": {"negotiation_arrangement": "string", "name": "string", **_CODE_TYPES},
    "in_network.covered_services": _CODE_TYPES,
    "in_network.bundled_codes": _CODE_TYPES,
    "negotiated_rates": {"provider_references": "[number]"},
    "negotiated_rates.provider_groups": _PROVIDER_TYPES,
    "negotiated_prices": {"negotiated_type": "string", "billing_class": "string", "negotiated_rate": "number", "expiration_date": "string",
                          "additional_information": "string", "service_code": "[string]", "billing_code_modifier": "[string]"},
}
_KINDS = {"string": "^STRING$", "number": "^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$", "object": "^OBJECT", "array": "^ARRAY"}
_PATTERNS = {"string": "(?:STRING|VOID)", "number": "(?:BIGINT|DOUBLE|FLOAT|VOID|DECIMAL[(][0-9]+, ?[0-9]+[)])"}
_NODE = "STRUCT<rule: STRING, level: STRING, path: STRING, v: VARIANT>"


def _level_pattern(level: str) -> str:
    """Pattern of the ``schema_of_variant`` text of nodes of a level that hold no value of a wrong type, at any depth."""
    fields = {}
    for field, kind in TYPES[level].items():
        if "." not in field and kind != "object":
            fields[field] = array_pattern(_PATTERNS[kind[1:-1]]) if kind.startswith("[") else _PATTERNS[kind]
        elif kind == "object":
            inner = {f.split(".")[1]: _PATTERNS[k] for f, k in TYPES[level].items() if f.startswith(field + ".")}
            fields[field] = object_pattern(inner, is_open=True)
    fields |= {field: array_pattern(_level_pattern(child)) for child, (parent, field) in LEVELS.items() if parent == level}
    return object_pattern(fields, is_open=True)


def _type_checks(level: str) -> list[str]:
    """Arrays of found violations of one level's node ``v`` at ``path``; missing and null values have no type."""
    out = []

    def wrong(value: str, kind: str) -> str:
        return f"({value} IS NOT NULL AND NOT is_variant_null({value}) AND NOT schema_of_variant({value}) RLIKE '{_KINDS[kind]}')"

    def found(field: str, at: str) -> str:
        return f"struct('{level}.{field}.type' AS rule, CAST(NULL AS STRING) AS level, {at} AS path, CAST(NULL AS VARIANT) AS v)"

    none = f"CAST(array() AS ARRAY<{_NODE}>)"
    fields = dict(TYPES[level]) | {field: "array" for parent, field in LEVELS.values() if parent == level}
    for field, kind in fields.items():
        value, at = f"try_variant_get(v, '$.{field}', 'variant')", f"concat(path, '.{field}')"
        outer = "array" if kind.startswith("[") else kind
        out.append(f"CASE WHEN {wrong(value, outer)} THEN array({found(field, at)}) ELSE {none} END")
        if outer != kind:
            items = f"transform(coalesce(try_cast({value} AS ARRAY<VARIANT>), array()), (x, i) -> CASE WHEN {wrong('x', kind[1:-1])} THEN " \
                    f"{found(field, f'concat({at}, chr(91), CAST(i AS STRING), chr(93))')} END)"
            out.append(f"filter({items}, f -> f IS NOT NULL)")
    for child, (parent, field) in LEVELS.items():
        if parent == level:
            items = f"coalesce(try_cast(try_variant_get(v, '$.{field}', 'variant') AS ARRAY<VARIANT>), array())"
            # children that one pass shows to hold no wrong type are not walked
            out.append(f"filter(transform({items}, (x, i) -> CASE WHEN NOT {fits_sql('x', _level_pattern(child))} THEN "
                       f"struct(CAST(NULL AS STRING) AS rule, '{child}' AS level, "
                       f"concat(path, '.{field}[', CAST(i AS STRING), ']') AS path, x AS v) END), f -> f IS NOT NULL)")
            out.append(f"filter(transform({items}, (x, i) -> CASE WHEN {wrong('x', 'object')} THEN "
                       f"struct('{child}.type' AS rule, CAST(NULL AS STRING) AS level, concat(path, '.{field}[', CAST(i AS STRING), ']') AS path, "
                       f"CAST(NULL AS VARIANT) AS v) END), f -> f IS NOT NULL)")
    return out


def type_audit(docs: DataFrame, doc: str = "doc", keep: Sequence[str] = ("file_path",)) -> DataFrame:
    """One row per value whose JSON type is not the declared one: (keep..., rule, path).

    The VARIANT is read, since a typed reader has already made such a value NULL.  Documents are exploded level by level: each
    step turns a node into its violations and those children whose schema shows a value to look for, so no row holds more
    than one node's; no exchange.
    """
    keep = list(keep)
    fits = fits_sql("v", _level_pattern("root"))
    nodes = docs.select(*keep, F.lit(None).cast("string").alias("rule"), F.lit("root").alias("level"), F.lit("$").alias("path"), F.col(doc).alias("v"))
    step = ["root"]
    while step:
        cases = f"WHEN level = 'root' AND {fits} THEN CAST(array() AS ARRAY<{_NODE}>) " if step == ["root"] else ""
        cases += " ".join(f"WHEN level = '{x}' THEN concat({', '.join(_type_checks(x))})" for x in step)
        nodes = nodes.select(*keep, F.explode(F.expr(
            f"CASE WHEN level IS NULL THEN array(struct(rule, level, path, v)) {cases} END")).alias("n")).select(*keep, "n.*")
        step = [x for x, (parent, _) in LEVELS.items() if parent in step]
    return nodes.where("rule IS NOT NULL").select(*keep, "rule", "path")
