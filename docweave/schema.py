"""The annotation data model.

An annotation column is ``array<struct<annotatorType, begin, end, result,
metadata, embeddings>>``; ``begin``/``end`` are 0-based character offsets with
an *inclusive* end, so ``substring(text, begin + 1, end - begin + 1) = result``.

Operators work on the *long* form (one row per sentence / token / chunk) which
Spark can partition, window and join; ``functions.annotations.to_annotations``
folds the long form back into this nested form per document.
"""

from pyspark.sql import types as T

ANNOTATION = T.StructType([
    T.StructField("annotatorType", T.StringType()),
    T.StructField("begin", T.IntegerType()),
    T.StructField("end", T.IntegerType()),
    T.StructField("result", T.StringType()),
    T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    T.StructField("embeddings", T.ArrayType(T.FloatType())),
])

ANNOTATIONS = T.ArrayType(ANNOTATION)

# Flat entity table written to the relational sink.
ENTITY_TABLE = T.StructType([
    T.StructField("docId", T.LongType()),
    T.StructField("entity", T.StringType()),
    T.StructField("entity_type", T.StringType()),
    T.StructField("sentence_num", T.IntegerType()),
    T.StructField("start_pos", T.IntegerType()),
    T.StructField("id", T.StringType()),
])
