"""Reading a history whose columns changed over the years.

``mergeSchema`` adds columns, but refuses a column whose type grew (INT to BIGINT, a
DECIMAL with more digits), and then the whole history cannot be read. A run's schema
is therefore registered when it is appended, runs of one schema are read together
under it, and each is cast to the common, widened schema:

    byte < short < int < long,  float < double,  a whole number < a decimal or double
    that holds it,  decimal(p, s): the larger of whole and of fractional digits
    (up to 38),  date < timestamp without zone

A column that a run lacks is null there. Types with no common one (text and number)
are an error that names the column. Runs appended before there was a register are
read by their own files' schema."""

from __future__ import annotations

import functools
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTER = "_schemas"  # inside the table's folder, which readers of tables pass over
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = dict(zip(_WHOLE, (3, 5, 10, 19), strict=True))


class NoCommonType(TypeError):
    """Two runs hold a column in types that no one type takes in."""


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds all values of both, or None."""
    if a == b:
        return a
    ka, kb = type(a), type(b)
    if ka == T.NullType or kb == T.NullType:
        return b if ka == T.NullType else a
    if ka in _WHOLE and kb in _WHOLE:
        return _WHOLE[max(_WHOLE.index(ka), _WHOLE.index(kb))]()
    if {ka, kb} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    for x, y in ((a, b), (b, a)):
        if type(x) in _WHOLE and isinstance(y, T.DecimalType):
            return wider(T.DecimalType(_DIGITS[type(x)], 0), y)
        if type(x) in _WHOLE[:3] and isinstance(y, T.DoubleType) or type(x) in _WHOLE[:2] and isinstance(y, T.FloatType):
            return y
        if type(x) == T.IntegerType and isinstance(y, T.FloatType):
            return T.DoubleType()
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    return None


def common_schema(schemas: list[T.StructType]) -> T.StructType:
    """Columns of all schemas, in the order in which they first occur, widened."""
    kinds: dict[str, T.DataType] = {}
    for s in schemas:
        for f in s.fields:
            kind = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
            if kind is None:
                raise NoCommonType(f"column {f.name!r} is {kinds[f.name].simpleString()} in some runs and {f.dataType.simpleString()} in others")
            kinds[f.name] = kind
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


def register_schema(df: DataFrame, path: str, run_id: str, partition: str = "run_id") -> None:
    """Note the schema of a run's rows; appending the run again replaces it."""
    own = T.StructType([f for f in df.schema.fields if f.name != partition])
    row = df.sparkSession.createDataFrame([(own.json(), run_id)], f"schema string, {partition} string").coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(f"{path.rstrip('/')}/{REGISTER}")


def run_schemas(spark: SparkSession, path: str, partition: str = "run_id") -> dict[str, T.StructType]:
    """The schema of every run of a history (a row a run passes the driver)."""
    path = path.rstrip("/")
    try:
        known = spark.read.schema(f"schema string, {partition} string").parquet(f"{path}/{REGISTER}").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        known = []
    out = {r[partition]: T.StructType.fromJson(json.loads(r["schema"])) for r in known}
    # Folder names as they are; a type drawn from them could change the text.
    names = spark.read.schema(f"{partition} string").option("basePath", path).parquet(path)
    runs = sorted(r[0] for r in names.select(partition).distinct().collect())
    for run in runs:
        if run not in out:
            out[run] = spark.read.parquet(f"{path}/{partition}={run}").schema
    return {r: out[r] for r in runs}


def read_widened(spark: SparkSession, path: str, partition: str = "run_id") -> DataFrame:
    """All runs under their common schema; one read for each schema there is."""
    path = path.rstrip("/")
    schemas = run_schemas(spark, path, partition)
    if not schemas:
        raise FileNotFoundError(f"no run in {path}")
    common = common_schema(list(schemas.values()))
    groups: dict[str, list[str]] = {}
    for run, s in schemas.items():
        groups.setdefault(s.json(), []).append(run)
    parts = []
    for text, runs in groups.items():
        own = T.StructType.fromJson(json.loads(text))
        rows = spark.read.schema(T.StructType([*own.fields, T.StructField(partition, T.StringType())])).option("basePath", path)
        rows = rows.parquet(*([path] if len(groups) == 1 else [f"{path}/{partition}={r}" for r in runs]))
        have = set(own.names)
        cols = [(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in common.fields]
        parts.append(rows.select(*cols, partition))
    return functools.reduce(DataFrame.unionByName, parts)
