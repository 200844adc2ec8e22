"""Reading labelled tables and checking that they can be trained on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The cell texts a CSV reader treats as missing by default.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# The cell texts that make a boolean column.
TRUE_TOKENS = ("True", "TRUE", "true")
FALSE_TOKENS = ("False", "FALSE", "false")

_INTEGER = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|Infinity)\s*$"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = False) -> DataFrame:
    """Read a CSV file with a header row; missing-value tokens become NULL, a line with too many or too
    few cells stops the job.

    With a schema every other cell must be a value of its column's type; one that is not stops the
    job. Without one the cells are read as text, and one aggregate over the whole file settles each
    column's type: boolean, bigint, double, or string. An integer column with gaps becomes double,
    one with a number too large for a bigint stays text.

    ``multi_line`` allows line breaks inside quoted cells; a file is then one task's work, so it is
    for tables of many files.
    """
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=multi_line, mode="FAILFAST")
    names = raw.columns
    cells = raw.select([_missing_to_null(F.col(_q(c))).alias(c) for c in names])
    if schema is not None:
        wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if wanted.names != names:
            raise ValueError(f"the file has the columns {names}, the schema {wanted.names}")
        return cells.select([_as_type(f).alias(f.name) for f in wanted])
    counts = []
    for i, c in enumerate(names):
        cell = F.col(_q(c))
        whole = cell.rlike(_INTEGER)
        fits = F.when(whole, F.trim(cell).try_cast("bigint")).isNotNull()  # a cast that fails costs far more than the match
        counts += [
            F.count(F.lit(1)).alias("n"),
            F.count(cell).alias(f"filled_{i}"),
            F.count(F.when(whole & fits, 1)).alias(f"integer_{i}"),
            F.count(F.when(cell.rlike(_NUMBER) & (~whole | fits), 1)).alias(f"number_{i}"),
            F.count(F.when(cell.isin(*TRUE_TOKENS, *FALSE_TOKENS), 1)).alias(f"boolean_{i}"),
        ]
    seen = cells.agg(*counts[:1], *[c for j, c in enumerate(counts) if j % 5]).first()
    typed = []
    for i, c in enumerate(names):
        cell, filled = F.col(_q(c)), seen[f"filled_{i}"]
        if filled and seen[f"boolean_{i}"] == filled:
            out = F.when(cell.isNotNull(), cell.isin(*TRUE_TOKENS))
        elif filled and seen[f"integer_{i}"] == filled == seen["n"]:
            out = F.trim(cell).cast("bigint")
        elif seen[f"number_{i}"] == filled:
            out = F.trim(cell).cast("double")
        else:
            out = cell
        typed.append(out.alias(c))
    return cells.select(typed)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None, kind: str | None = None) -> DataFrame:
    """A ``kind`` of table, "parquet" or "csv"; if not told, Parquet where the path or a file below it
    has that ending, CSV otherwise."""
    kind = kind or ("parquet" if _holds_parquet(spark, path) else "csv")
    if kind not in ("parquet", "csv"):
        raise ValueError(f"a table is 'parquet' or 'csv', not {kind!r}")
    return spark.read.parquet(path) if kind == "parquet" else read_csv(spark, path, schema)


def _holds_parquet(spark: SparkSession, path: str) -> bool:
    if path.rstrip("/").endswith(".parquet"):
        return True
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place) or files.getFileStatus(place).isFile():
        return False
    below = files.listFiles(place, True)
    while below.hasNext():
        if below.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def _as_type(column: T.StructField) -> Column:
    cell = F.col(_q(column.name))
    if isinstance(column.dataType, T.StringType):
        return cell
    kind = column.dataType.simpleString()
    if isinstance(column.dataType, T.BooleanType):
        value = F.when(cell.isin(*TRUE_TOKENS), True).when(cell.isin(*FALSE_TOKENS), False)
    else:
        value = F.trim(cell).try_cast(kind)
    bad = F.raise_error(F.concat(F.lit(f"not a value of {column.name} ({kind}): "), cell)).cast(kind)
    return F.when(cell.isNotNull(), F.coalesce(value, bad))


def feature_columns(df: DataFrame, label: str, key_cols: Sequence[str] = ()) -> list[str]:
    """Every column but the label and the key; all must be numeric or boolean."""
    missing = [c for c in (label, *key_cols) if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in the table: {missing}")
    names = [c for c in df.columns if c != label and c not in key_cols]
    if not names:
        raise ValueError("the table has no feature column")
    refused = [
        f"{c} ({df.schema[c].dataType.simpleString()})"
        for c in names
        if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))
    ]
    if refused:
        raise ValueError(f"features must be numeric or boolean: {', '.join(refused)}")
    return names


def features(df: DataFrame, label: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """The feature projection."""
    return df.select([_q(c) for c in feature_columns(df, label, key_cols)])


def labels(df: DataFrame, label: str) -> DataFrame:
    """The label projection, as the double MLlib expects."""
    if label not in df.columns:
        raise KeyError(f"columns not in the table: [{label!r}]")
    return df.select(F.col(_q(label)).cast("double").alias(label))


def labelled(df: DataFrame, label: str, key_cols: Sequence[str] = ()) -> DataFrame:
    """Key columns, features as double, label as int: the shape every fit reads. A label that is neither
    0 nor 1 stops the job."""
    names = feature_columns(df, label, key_cols)
    bad = F.raise_error(F.concat(F.lit(f"{label} must be 0 or 1, not "), F.coalesce(F.col(_q(label)).cast("string"), F.lit("NULL")))).cast("int")
    return df.select(
        *[F.col(_q(c)) for c in key_cols],
        *[F.col(_q(c)).cast("double").alias(c) for c in names],
        F.when(label_group(label) >= 0, label_group(label)).otherwise(bad).alias(label),
    )


def check_labels(df: DataFrame, label: str) -> dict[int, int]:
    """Rows per class; anything but exactly the classes 0 and 1 is an error."""
    rows = df.groupBy(label_group(label).alias("c")).count().collect()
    return binary_counts({r["c"]: r["count"] for r in rows}, label)


def label_group(label: str) -> Column:
    """0 or 1 for a valid label and -1 for anything else, text that is no number too, so a grouping stays tiny."""
    c = F.col(_q(label)).try_cast("double")
    return F.when(c == 0, 0).when(c == 1, 1).otherwise(-1)


def binary_counts(counts: dict[int, int], label: str) -> dict[int, int]:
    if counts.get(-1):
        raise ValueError(f"{counts[-1]} rows of {label!r} are neither 0 nor 1")
    if set(counts) != {0, 1}:
        raise ValueError(f"{label!r} needs both classes 0 and 1, found {sorted(counts)}")
    return counts


def label_profile(df: DataFrame, candidates: Sequence[str]) -> DataFrame:
    """Rows of class 0, of class 1 and of neither per column that might be a label, and whether a fit takes it:
    both classes and nothing else, as ``check_labels`` has it. One pass over the table for all columns; an
    empty table gives zeros."""
    kinds = {"n_zero": 0, "n_one": 1, "n_refused": -1}
    counted = [
        F.struct(F.lit(c).alias("label"), *[F.count_if(label_group(c) == k).alias(n) for n, k in kinds.items()])
        for c in candidates
    ]
    rows = df.agg(F.array(*counted).alias("found")).select(F.inline("found"))
    return rows.withColumn("usable", (F.col("n_zero") > 0) & (F.col("n_one") > 0) & (F.col("n_refused") == 0))


def class_profile(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """Rows per (split, class) and the width of the table without the split column."""
    width = len([c for c in df.columns if c != split])
    return (
        df.groupBy(split, label)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("n_columns", F.lit(width))
    )


def assemble(df: DataFrame, names: Sequence[str], output: str = "features") -> DataFrame:
    """Pack numeric columns into one vector; a NULL or NaN feature stops the job."""
    wide = df.withColumns({c: F.col(_q(c)).cast("double") for c in names})
    return VectorAssembler(inputCols=list(names), outputCol=output, handleInvalid="error").transform(wide)


def _missing_to_null(cell: Column) -> Column:
    return F.when(~cell.isin(*NA_TOKENS), cell)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
