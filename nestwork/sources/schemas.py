"""Declared schemas (S7, 1.3).

The rate-file tree is declared in full, including provider references,
covered services and bundled codes.  ``npi`` is STRING: one 10-digit value above
2^31-1 would otherwise turn the whole array NULL.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

S = StringType()

TIN = StructType([StructField("type", S), StructField("value", S)])
PROVIDER_GROUP = StructType([StructField("npi", ArrayType(S)), StructField("tin", TIN)])
CODE = StructType([StructField("billing_code_type", S), StructField("billing_code_type_version", S),
                   StructField("billing_code", S), StructField("description", S)])
NEGOTIATED_PRICE = StructType([
    StructField("negotiated_type", S),
    StructField("negotiated_rate", DoubleType()),
    StructField("expiration_date", S),
    StructField("billing_class", S),
    StructField("service_code", ArrayType(S)),
    StructField("billing_code_modifier", ArrayType(S)),
    StructField("additional_information", S),
])
NEGOTIATED_RATE = StructType([
    StructField("negotiated_prices", ArrayType(NEGOTIATED_PRICE)),
    StructField("provider_groups", ArrayType(PROVIDER_GROUP)),
    StructField("provider_references", ArrayType(LongType())),
])
IN_NETWORK = StructType([
    StructField("negotiation_arrangement", S), StructField("name", S),
    StructField("billing_code_type", S), StructField("billing_code_type_version", S),
    StructField("billing_code", S), StructField("description", S),
    StructField("negotiated_rates", ArrayType(NEGOTIATED_RATE)),
    StructField("covered_services", ArrayType(CODE)),
    StructField("bundled_codes", ArrayType(CODE)),
])
PROVIDER_REFERENCE = StructType([
    StructField("provider_group_id", LongType()),
    StructField("provider_groups", ArrayType(PROVIDER_GROUP)),
    StructField("location", S),
])
RATES_SCHEMA = StructType([
    StructField("reporting_entity_name", S), StructField("reporting_entity_type", S),
    StructField("plan_name", S), StructField("plan_id_type", S), StructField("plan_id", S),
    StructField("plan_market_type", S), StructField("last_updated_on", S), StructField("version", S),
    StructField("provider_references", ArrayType(PROVIDER_REFERENCE)),
    StructField("in_network", ArrayType(IN_NETWORK)),
])

CORRUPT_COLUMN = "_corrupt_record"
RATES_SCHEMA_WITH_CORRUPT = StructType(RATES_SCHEMA.fields + [StructField(CORRUPT_COLUMN, S)])

# File metadata as the hidden ``_metadata`` column exposes it.
FILE_METADATA = StructType([
    StructField("file_path", S), StructField("file_name", S), StructField("file_size", LongType()),
    StructField("file_block_start", LongType()), StructField("file_block_length", LongType()),
    StructField("file_modification_time", TimestampType()),
])

FILE_STATUS = StructType([StructField("success", BooleanType()), StructField("message", S)])
