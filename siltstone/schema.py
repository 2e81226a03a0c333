"""Table schemas shared by the sources, operators and streams."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BRONZE = T.StructType([
    T.StructField("chunk_id", T.StringType(), False),
    T.StructField("source_url", T.StringType(), False),
    T.StructField("content", T.StringType(), False),
    T.StructField("ingested_at", T.DoubleType(), False),
    T.StructField("language", T.StringType(), False),
    T.StructField("embedding", T.ArrayType(T.FloatType()), True),
])

DISCOVERY = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("language", T.StringType()),
])

# The columns a Kafka source delivers; the file form stores key and value as text.
TOPIC = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
])

TRAVERSAL_CONFIG = T.StructType([
    T.StructField("active", T.BooleanType()),
    T.StructField("query", T.StringType()),
    T.StructField("required_path_segments", T.ArrayType(T.StringType())),
    T.StructField("blocked_path_segments", T.ArrayType(T.StringType())),
    T.StructField("max_depth", T.IntegerType()),
])

RELEVANCE_CONFIG = T.StructType([
    T.StructField("active", T.BooleanType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("include_terms", T.ArrayType(T.StringType())),
    T.StructField("exclude_terms", T.ArrayType(T.StringType())),
])


def relaxed(schema: T.StructType) -> T.StructType:
    """The same fields, all nullable: what a permissive reader can promise."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def enforce(df: DataFrame, schema: T.StructType = BRONZE) -> DataFrame:
    """Reorder, cast and check `df` against `schema`.

    Extra columns go; a missing nullable column becomes NULL; a nullable column
    bound to a required field is refused by the analyzer, so required fields
    must be made non-null first (see `operators.records.to_bronze_record`).
    """
    return df.to(schema)
