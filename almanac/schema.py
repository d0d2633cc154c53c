"""Schemas of the observation contract, the fact table and the published view."""

from __future__ import annotations

from pyspark.sql import types as T

DEMOGRAPHIC_COLUMNS = ["age", "race", "ethnicity", "sex"]
VARIABLE_COLUMNS = ["category", "measurement", "unit"]
CMU_COLUMNS = VARIABLE_COLUMNS + DEMOGRAPHIC_COLUMNS

# The default variable / demographic descriptor.
CMU_DEFAULTS = {
    "category": "cases", "measurement": "cumulative", "unit": "people",
    "age": "all", "race": "all", "ethnicity": "all", "sex": "all",
}


def observation_schema(has_location: bool = True, with_location_type: bool = False) -> T.StructType:
    loc = (T.StructField("location", T.LongType()) if has_location
           else T.StructField("location_name", T.StringType()))
    fields = [T.StructField("vintage", T.TimestampNTZType()),
              T.StructField("dt", T.DateType()), loc]
    if with_location_type:
        fields.append(T.StructField("location_type", T.StringType()))
    fields += [T.StructField(c, T.StringType()) for c in CMU_COLUMNS]
    fields.append(T.StructField("value", T.DoubleType()))
    return T.StructType(fields)


def contract_columns(has_location: bool = True) -> list[str]:
    return [f.name for f in observation_schema(has_location).fields]


FACT_PK = ["dt", "location_id", "variable_id", "demographic_id", "provider_id"]

FACT_SCHEMA = T.StructType([
    T.StructField("dt", T.DateType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("variable_id", T.IntegerType()),
    T.StructField("demographic_id", T.IntegerType()),
    T.StructField("provider_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("last_updated", T.TimestampNTZType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("deleted", T.BooleanType()),
    T.StructField("delete_batch_id", T.LongType()),
])

# Published view columns and their types (the pandas dtype map of the
# publisher, expressed as Spark types; categoricals are plain strings).
PUBLISHED_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType()),
    T.StructField("dt", T.DateType()),
    T.StructField("location_id", T.StringType()),
    T.StructField("location", T.LongType()),
    T.StructField("location_type", T.StringType()),
    T.StructField("variable_name", T.StringType()),
    T.StructField("measurement", T.StringType()),
    T.StructField("unit", T.StringType()),
    T.StructField("age", T.StringType()),
    T.StructField("race", T.StringType()),
    T.StructField("ethnicity", T.StringType()),
    T.StructField("sex", T.StringType()),
    T.StructField("last_updated", T.TimestampNTZType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
