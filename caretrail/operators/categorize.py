"""Ordered rule-based categorization (U8).

Plan shape. The ``eq`` / ``in`` lines form a constant table (literal -> index of the first line that
names it); its size is fixed by the ruleset, not by the data, so it is broadcast and matched with one
hash lookup per row instead of a long chain of string comparisons. The few wildcard lines are
evaluated as ``ilike`` expressions; the smallest matching index wins, as in a searched CASE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caretrail.functions.categories import Ruleset, prepared, rule_test


def categorize(df: DataFrame, value, rs: Ruleset, out: str) -> DataFrame:
    """Append (or replace) ``out`` with the label of the first matching line of ``rs``."""
    v = prepared(F.col(value) if isinstance(value, str) else value, rs)
    spark = df.sparkSession
    schema = T.StructType([T.StructField("_rule_value", T.StringType()), T.StructField("_rule_idx", T.IntegerType()),
                           T.StructField("_rule_label", T.StringType())])
    exact = spark.createDataFrame([(lit, i, rs.rules[i].label) for lit, i in rs.exact], schema)
    joined = df.withColumn("_rule_in", v).join(F.broadcast(exact), F.col("_rule_in") == F.col("_rule_value"), "left")
    # Wildcard lines in order: the first hit is the smallest wildcard index.
    wild = None
    for i, r in rs.wildcards:
        hit = F.struct(F.lit(i).alias("i"), F.lit(r.label).alias("label"))
        wild = F.when(rule_test(F.col("_rule_in"), r), hit) if wild is None else wild.when(rule_test(F.col("_rule_in"), r), hit)
    default = F.lit(rs.default).cast("string")
    if wild is None:
        label = F.coalesce(F.col("_rule_label"), default)
    else:
        joined = joined.withColumn("_rule_wild", wild)
        exact_wins = F.col("_rule_idx").isNotNull() & (F.col("_rule_wild").isNull() | (F.col("_rule_idx") < F.col("_rule_wild.i")))
        label = F.when(exact_wins, F.col("_rule_label")).otherwise(F.coalesce(F.col("_rule_wild.label"), default))
    cols = [F.col(c) for c in df.columns if c != out]
    return joined.select(*cols, label.alias(out))
