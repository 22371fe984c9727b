"""Flow files as rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logwarden import rules
from logwarden.operators.flows import flow_label_map


def read_flows(
    spark: SparkSession, path: str, features: list[str] | None = None, labels: dict[str, str] | None = None
) -> DataFrame:
    """Flow CSV with trimmed column names: the known features as doubles, Label, Attack_Type and
    is_attack; infinite values count as missing and rows with a missing value are dropped.

    Only the header is looked at to find the columns; values are read as declared, not inferred.  All files must
    have the same header: one with its columns in another order is an error, not misread.
    """
    features = features or rules.FLOW_FEATURES
    header = spark.read.csv(path, header=True, enforceSchema=False).columns
    names = {c.strip(): c for c in header}
    label = next((c for name, c in names.items() if name.lower() == "label"), None)
    if label is None:
        raise ValueError("no Label column in the flow file")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = spark.read.csv(path, header=True, schema=schema, enforceSchema=False)

    def number(column: str):
        # "Infinity" and the like are not numbers to try_cast's taste in every spelling
        value = F.col(f"`{column}`").try_cast("double")
        return F.when(F.isnan(value) | (F.abs(value) == float("inf")), None).otherwise(value)

    found = [f for f in features if f in names]
    chosen = rows.select(*[number(names[f]).alias(f) for f in found], F.col(f"`{label}`").alias("Label"))
    return flow_label_map(chosen, labels=labels).dropna(subset=[*found, "Label"])
