"""Row types of the tables the library reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

REGISTRY = T.StructType(
    [
        T.StructField("dataset", T.StringType(), False),
        T.StructField("source_name", T.StringType()),
        T.StructField("config", T.StringType()),
        T.StructField("subdir", T.StringType()),
        T.StructField("grp", T.StringType()),
    ]
)

EMBEDDING = T.StructType(
    [
        T.StructField("embeddings", T.ArrayType(T.DoubleType())),
        T.StructField("original_index", T.LongType()),
    ]
)

EMBEDDING_JSON = T.StructType(
    [
        T.StructField(
            "embeddings",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("embedding", T.ArrayType(T.DoubleType())),
                        T.StructField("split", T.StringType()),
                        T.StructField("text", T.StringType()),
                        T.StructField("dataset", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "metadata",
            T.StructType(
                [
                    T.StructField("model", T.StringType()),
                    T.StructField("total_samples", T.LongType()),
                    T.StructField("datasets_processed", T.LongType()),
                    T.StructField("embedding_dimension", T.IntegerType()),
                    T.StructField("extraction_time", T.StringType()),
                ]
            ),
        ),
    ]
)

_CORNERS = ("xmin", "ymin", "xmax", "ymax")
BBOX = T.StructType([T.StructField(c, T.DoubleType()) for c in _CORNERS])
PIXELS = T.StructType([T.StructField(c, T.IntegerType()) for c in ("x0", "y0", "x1", "y1")])

RAW_BLOCK = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("bbox", BBOX),
    ]
)

BLOCK_RECORD = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("block_id", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("bbox_normalized", BBOX),
        T.StructField("bbox_pixels", PIXELS),
        T.StructField("is_valid", T.BooleanType()),
    ]
)

ARCHIVE = T.StructType(
    [
        T.StructField(
            "elements",
            T.ArrayType(T.StructType([T.StructField("Path", T.StringType()), T.StructField("Text", T.StringType())])),
        )
    ]
)
