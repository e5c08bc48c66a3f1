"""Column selection, recoding, missing values, quality flags, labels and codebooks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename_positional(df: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """Name columns X1, X2, ..., or by the given list."""
    return df.toDF(*(names or [f"X{i + 1}" for i in range(len(df.columns))]))


def clean_name(name: str, split_camel: bool = False) -> str:
    if split_camel:
        name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"[^0-9A-Za-z]+", "_", name).strip("_").lower()


def clean_names(df: DataFrame, split_camel: bool = False) -> DataFrame:
    """Lower-case snake names; ``split_camel`` turns ResponseId into response_id."""
    return df.toDF(*[clean_name(c, split_camel) for c in df.columns])


def keep_finite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows in which any column is null, NaN or infinite."""
    inf = float("inf")
    checks = [
        F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(F.col(c)) < F.lit(inf)) for c in cols
    ]
    return df.filter(reduce(lambda a, b: a & b, checks))


def strict_number(col: str, kind: str = "double") -> Column:
    """Cast that fails on text that is not a number, whatever the session's ANSI setting."""
    out = F.col(col).try_cast(kind)
    message = F.concat(F.lit(f"not a {kind} in {col}: "), F.col(col).cast("string"))
    return F.when(F.col(col).isNotNull() & out.isNull(), F.raise_error(message).cast(kind)).otherwise(out)


def lenient_number(col: str | Column, kind: str = "double") -> Column:
    """Cast that turns bad text into null."""
    return (F.col(col) if isinstance(col, str) else col).try_cast(kind)


def recode_missing(df: DataFrame, codes: Mapping[str, Sequence]) -> DataFrame:
    """Replace the listed codes of each column with null."""
    return df.withColumns(
        {c: F.when(~F.col(c).isin(list(bad)), F.col(c)) for c, bad in codes.items()}
    )


def map_values(df: DataFrame, col: str, mapping: Mapping, out: str) -> DataFrame:
    """Dictionary recode; values outside the dictionary become null."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return df.withColumn(out, F.try_element_at(F.create_map(*pairs), F.col(col)))


def override_in_order(base: Column, rules: Sequence[tuple[Column, Column]]) -> Column:
    """Sequential conditional assignment: a later rule wins over an earlier one."""
    out = base
    for condition, value in rules:
        out = F.when(condition, value).otherwise(out)
    return out


def null_unless(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


def differs(col: str, value) -> Column:
    """True where the column is not ``value``; a missing answer counts as different."""
    return ~F.col(col).eqNullSafe(F.lit(value))


def any_flag(*flags: str) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(f), F.lit(False)) for f in flags])


def missing_share(*cols: str) -> Column:
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in cols]) / len(cols)


def row_mean(*cols: str) -> Column:
    """Mean over the columns that are present; null when none is."""
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [F.col(c).isNotNull().cast("int") for c in cols])
    return F.when(n > 0, total / n)


def all_equal(*cols: str) -> Column:
    """Straight-lining: every answer present and the same."""
    same = [F.col(a) == F.col(b) for a, b in zip(cols, cols[1:])]
    return F.coalesce(reduce(lambda a, b: a & b, same), F.lit(False))


def add_blank(df: DataFrame, *names: str, value: str = "") -> DataFrame:
    return df.withColumns({n: F.lit(value) for n in names})


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in ``order``: a minimum of structs, combined map-side."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("__first"))
    return picked.select(*keys, "__first.*").select(*df.columns)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    picked = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__last"))
    return picked.select(*keys, "__last.*").select(*df.columns)


def quality_flags(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add boolean flags; a null condition counts as not flagged."""
    return df.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in rules.items()})


def flag_summary(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])


def check_suite(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One pass over the data; one row per rule with the number of failing rows."""
    wide = df.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in rules.items()])
    long = wide.unpivot([], list(rules), "check", "n_bad")
    return long.withColumn("status", F.when(F.col("n_bad") == 0, "pass").otherwise("fail"))


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """The rows that fail a rule, with the names of the rules they fail."""
    names = F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in rules.items()])
    return df.withColumn("failed_checks", F.array_compact(names)).filter(F.size("failed_checks") > 0)


def threshold_sensitivity(df: DataFrame, col: str, cuts: Sequence[float]) -> DataFrame:
    """Rows kept at each cut-off, all cut-offs in one pass."""
    wide = df.agg(*[F.count_if(F.col(col) >= c).alias(str(c)) for c in cuts])
    long = wide.unpivot([], [f"`{c}`" for c in map(str, cuts)], "cut", "n_kept")
    return long.select(F.col("cut").cast("double").alias("cut"), "n_kept")


def set_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Attach variable labels as column metadata."""
    for name, label in labels.items():
        df = df.withMetadata(name, {"label": label})
    return df


def get_labels(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["label"] for f in df.schema if "label" in f.metadata}


def value_labels(df: DataFrame, col: str, labels: DataFrame, out: str) -> DataFrame:
    """Join a (value, label) code table back to a coded column."""
    codes = labels.select(F.col("value").alias("__value"), F.col("label").alias(out))
    return df.join(codes, F.col(col) == F.col("__value"), "left").drop("__value")


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row per variable: type, missing and distinct counts.

    Values are counted per (variable, value) first, with counts combined before the shuffle, then per variable.
    """
    cols = list(cols or df.columns)
    types = dict(df.dtypes)
    plus_zero = {"double", "float"}  # so that the two zeros are one value
    cells = F.array(*[F.struct(F.lit(c).alias("variable"), (
        F.col(c) + 0.0 if types[c] in plus_zero else F.col(c)).cast("string").alias("value")) for c in cols])
    values = df.select(F.inline(cells)).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    counted = values.groupBy("variable").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        F.count("value").alias("n_distinct"))
    known = df.sparkSession.createDataFrame([(c, types[c]) for c in cols], "variable string, type string")
    return known.join(counted, "variable", "left").na.fill(0, ["n_rows", "n_missing", "n_distinct"])


def codebook(df: DataFrame, descriptions: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Variable, description and notes next to the profile of each variable."""
    rows = [(k, d, n) for k, (d, n) in descriptions.items()]
    text = df.sparkSession.createDataFrame(
        rows, "variable string, description string, notes string"
    )
    return profile(df, list(descriptions)).join(text, "variable", "left")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum and maximum per numeric column, in long form."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__n"), F.avg(x).alias(f"{c}__m"), F.stddev_samp(x).alias(f"{c}__s"),
                 F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi")]
    rows = F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"{c}__n").alias("n"), F.col(f"{c}__m").alias("mean"),
                 F.col(f"{c}__s").alias("sd"), F.col(f"{c}__lo").alias("min"),
                 F.col(f"{c}__hi").alias("max")) for c in cols
    ])
    return df.agg(*aggs).select(F.inline(rows))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
