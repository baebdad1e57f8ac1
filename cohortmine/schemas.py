"""Fixed schemas of the data model."""

from pyspark.sql import types as T

# Measurement row: (subject, feature, value). Text files carry a header line.
MEASUREMENT = T.StructType([
    T.StructField("subject_id", T.StringType()),
    T.StructField("feature_id", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

# Counted itemset: sorted item ids, size, support count.
ITEMSET = T.StructType([
    T.StructField("items", T.ArrayType(T.IntegerType())),
    T.StructField("k", T.IntegerType()),
    T.StructField("cnt", T.LongType()),
])

# The cohort labels and thresholds the reference jobs hard-code.
DEFAULT_LABELS = ("breast-cancer", "prostate-cancer", "pancreatic-cancer", "leukemia", "lymphoma")
DEFAULT_FEATURE = 42
DEFAULT_MIN_VALUE = 1250000.0
DEFAULT_MIN_SUPPORT = 0.3
DEFAULT_MIN_CONFIDENCE = 0.6
