"""Organisation snapshot with its bad rows set aside.

The plain reader turns what it cannot parse into nulls: a row with a missing
separator becomes an organisation without an id, and nobody sees it. Here every row
of the file ends in one of two places, and every value that is given up leaves a
trace:

    orgs      the rows that can be used
    rejects   file, record, field, value, reason, kept

    reason    fields    too few or too many fields: the row is set aside
              id        no whole number as id: the row is set aside
              number, date    the value is null in a row that stays (``kept``)

A file where more than ``max_share`` of the rows are set aside is refused: it is
most likely the wrong file, or cut off."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import ISO_FMT
from ..session import materialize
from .readers import ORG_SNAPSHOT_COLUMNS, org_columns, quoted

MAX_SHARE = 0.01
_RECORD, _FILE = "__record", "__file"
# What a value that cannot be read is called, by the model's column.
_REASONS = {"crm_curve": "number", "crm_first": "date", "crm_last": "date", "crm_status": "number", "crm_group_status": "number"}


class TooManyRejects(ValueError):
    """More rows are bad than the reader was told to accept."""


@dataclass(frozen=True)
class CheckedSnapshot:
    orgs: DataFrame
    rejects: DataFrame
    rows: int
    rejected: int


def _text_rows(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """All columns as text, the raw line of rows with a wrong number of fields, and
    the file. Files whose header differs from the first one's are an error."""
    plain = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8").option("quote", '"').option("escape", '"')
    names = plain.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _RECORD]])
    # A pruned scan would not count the fields.
    rows = plain.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False).option("enforceSchema", False)
    return rows.csv(path).select("*", F.col("_metadata.file_path").alias(_FILE))


def read_orgs_checked(
    spark: SparkSession, path: str, sep: str = "|", columns: dict = ORG_SNAPSHOT_COLUMNS, date_fmt: str = ISO_FMT, max_share: float = MAX_SHARE
) -> CheckedSnapshot:
    """The snapshot at ``path``, its rejects, and how many rows it has and lost."""
    text = _text_rows(spark, path, sep)
    source = {v: k for k, v in columns.items()}
    typed = org_columns(columns, date_fmt)
    had = {n.lower() for n in text.columns}
    if lost := [source[n] for n in typed if source[n].lower() not in had]:
        raise ValueError(f"the header of {path} lacks {', '.join(lost)}")
    raw = {n: F.nullif(F.trim(F.col(quoted(source[n]))), F.lit("")) for n in typed}
    faults = [F.when(raw[n].isNotNull() & typed[n].isNull(), F.struct(F.lit(n).alias("field"), raw[n].alias("value"), F.lit(why).alias("reason"), F.lit(True).alias("kept"))) for n, why in _REASONS.items()]
    no_id = F.struct(F.lit("id").alias("field"), raw["id"].alias("value"), F.lit("id").alias("reason"), F.lit(False).alias("kept"))
    torn = F.struct(F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("value"), F.lit("fields").alias("reason"), F.lit(False).alias("kept"))
    found = F.when(F.col(_RECORD).isNotNull(), F.array(torn)).when(typed["id"].isNull(), F.array(no_id)).otherwise(F.filter(F.array(*faults), lambda x: x.isNotNull()))
    line = F.coalesce(F.col(_RECORD), F.concat_ws(sep, *[F.coalesce(F.col(quoted(n)), F.lit("")) for n in text.columns if n not in (_RECORD, _FILE)]))
    rows = text.select(*[c.alias(n) for n, c in typed.items()], F.col(_FILE).alias("file"), line.alias("record"), found.alias("found"))
    rows = materialize(rows, "parquet")  # the file is parsed once
    set_aside = F.exists("found", lambda x: ~x["kept"])
    counts = rows.agg(F.count("*").alias("rows"), F.count_if(set_aside).alias("bad")).first()
    if counts["bad"] > max_share * counts["rows"]:
        raise TooManyRejects(f"{counts['bad']} of {counts['rows']} rows of {path} cannot be read; at most a share of {max_share:g} is accepted")
    orgs = rows.where(~set_aside).select(*typed)
    rejects = rows.where(F.size("found") > 0).select("file", "record", F.explode("found").alias("x")).select("file", "record", "x.field", "x.value", "x.reason", "x.kept")
    return CheckedSnapshot(orgs, rejects, counts["rows"], counts["bad"])
