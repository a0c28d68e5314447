"""Readers for the production inputs.

* invoices / billing dates / employee intervals come from a relational
  database over JDBC (partitioned reads, filters pushed to the database);
* the CRM organisation snapshot is a pipe-delimited UTF-8 file in object
  storage (any Hadoop path: ``abfss://``, ``s3a://``, ``hdfs://``...);
* the HTTP-code dimension is a semicolon file with a byte-order mark and a
  repeated header name;
* the segment dimensions are one JSON document with two arrays.

Schemas are pinned; delimited files are read as text and typed by name with
``try_*`` functions, so a bad value becomes null instead of failing the job
and the column order of the export does not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.dates import ISO_FMT, coerce_date
from ..sinks.history import read_widened

# Column names of the source systems.
INVOICE_COLUMNS = {
    "CodigoCliente": "client_code",
    "DataEmissao": "issue_date",
    "ValorBruto": "gross",
    "Status": "status",
    "NroNfe": "nfe_no",
}
EMPLOYEE_COLUMNS = {
    "CodigoCliente": "client_code",
    "CodigoFuncionario": "employee_code",
    "DataAdmissao": "admitted",
    "DataDemissao": "dismissed",
}
ORG_SNAPSHOT_COLUMNS = {
    "id": "id",
    "COD Contrato G.I": "codes",
    "Grupo Econômico": "econ_group",
    "Categoria": "crm_curve",
    "Primeiro Faturamento": "crm_first",
    "Último Faturamento": "crm_last",
    "Status da Organização": "crm_status",
    "8cc8862b52157830bf56ee015fcedcca7ea75dba": "crm_group_status",
}
IDENTITY_ORG_COLUMNS = {f.name: f.name for f in S.ORGS.fields}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# ---------------------------------------------------------------- JDBC (S1-S3)
def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict | None = None,
    partition_column: str | None = None,
    lower_bound: str | int | None = None,
    upper_bound: str | int | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10000,
) -> DataFrame:
    """A database table as a DataFrame, read in parallel slices of
    ``partition_column``. Filters applied afterwards on plain columns are
    pushed into the database's WHERE clause by Spark."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", int(num_partitions or 1))
        )
    return reader.load()


def jdbc_query(spark: SparkSession, url: str, query: str, properties: dict | None = None, fetch_size: int = 10000) -> DataFrame:
    """The result of a SQL statement run by the database itself (e.g. a
    GROUP BY that should be reduced at the source before crossing the
    network). Spark wraps it as a subquery; it is read by one task, so use
    it for already-reduced results and :func:`jdbc_table` for bulk reads."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def invoices_from_source(df: DataFrame, columns: dict = INVOICE_COLUMNS) -> DataFrame:
    """Source invoice rows -> ``invoices`` model (types per schemas.INVOICES)."""
    c = {v: F.col(quoted(k)) for k, v in columns.items()}
    return df.select(
        c["client_code"].cast("string").alias("client_code"),
        c["issue_date"].cast("date").alias("issue_date"),
        c["gross"].cast(S.MONEY).alias("gross"),
        c["status"].cast("string").alias("status"),
        c["nfe_no"].cast("bigint").alias("nfe_no"),
    )


def employees_from_source(df: DataFrame, columns: dict = EMPLOYEE_COLUMNS) -> DataFrame:
    c = {v: F.col(quoted(k)) for k, v in columns.items()}
    return df.select(
        c["client_code"].cast("string").alias("client_code"),
        c["employee_code"].cast("string").alias("employee_code"),
        c["admitted"].cast("date").alias("admitted"),
        c["dismissed"].cast("date").alias("dismissed"),
    )


# ------------------------------------------------------- delimited files (S4, S5)
def read_delimited_text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Header-led delimited UTF-8 file with every column as text (no inference)."""
    return (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')  # a doubled quote stands for one
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def org_columns(columns: dict = ORG_SNAPSHOT_COLUMNS, date_fmt: str = ISO_FMT) -> dict[str, Column]:
    """The columns of the ``orgs`` model, from a snapshot's text columns."""
    c = {v: F.col(quoted(k)) for k, v in columns.items()}

    def whole(x, kind):
        # "27" and "27.0" both occur in exports; anything else becomes null. Only
        # text with a fraction goes through a double, so long ids keep their digits.
        return F.coalesce(x.try_cast(kind), F.nullif(x.try_cast("double"), F.lit(float("nan"))).try_cast(kind))

    def as_date(x):
        # Stored dates also come as timestamp text.
        return F.coalesce(coerce_date(x, date_fmt), x.try_cast("timestamp_ntz").cast("date"))

    return {
        "id": whole(c["id"], "bigint"),
        "codes": F.nullif(c["codes"], F.lit("")),
        "econ_group": F.nullif(c["econ_group"], F.lit("")),
        "crm_curve": whole(c["crm_curve"], "int"),
        "crm_first": as_date(c["crm_first"]),
        "crm_last": as_date(c["crm_last"]),
        "crm_status": whole(c["crm_status"], "int"),
        "crm_group_status": whole(c["crm_group_status"], "int"),
    }


def orgs_from_text(df: DataFrame, columns: dict = ORG_SNAPSHOT_COLUMNS, date_fmt: str = ISO_FMT) -> DataFrame:
    """Text snapshot -> ``orgs`` model. Picks columns by name, so extra or
    reordered export columns are harmless; codes stay text."""
    return df.select(*[c.alias(n) for n, c in org_columns(columns, date_fmt).items()])


def read_orgs_snapshot(
    spark: SparkSession, path: str, sep: str = "|", columns: dict = ORG_SNAPSHOT_COLUMNS, date_fmt: str = ISO_FMT
) -> DataFrame:
    """CRM organisation snapshot (pipe-delimited by default)."""
    return orgs_from_text(read_delimited_text(spark, path, sep), columns, date_fmt)


def read_http_codes(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """HTTP-code dimension file. The header repeats a name, so columns are
    taken by position under a pinned schema; the byte-order mark is dropped
    by the UTF-8 reader."""
    return (
        spark.read.schema(S.HTTP_CODES)
        .option("header", True)
        .option("enforceSchema", True)
        .option("sep", sep)
        .option("encoding", "UTF-8")
        .csv(path)
    )


# ----------------------------------------------------------------- JSON (S6)
def read_segment_dims(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(dim_recency, dim_demand) from the segment JSON document."""
    doc = spark.read.schema(S.SEGMENT_DIMS_JSON).option("multiLine", True).json(path)
    recency = doc.select(F.inline("DimRecencia")).select(
        F.col("R_ID").alias("r_id"),
        F.col("R_Segmento").alias("segment"),
        F.col("minimo").alias("lo"),
        F.col("maximo").alias("hi"),
    )
    demand = doc.select(F.inline("DimDemanda")).select(
        F.col("D_ID").alias("d_id"),
        F.col("D_Segmento").alias("segment"),
        F.col("minimo").alias("lo"),
        F.col("maximo").alias("hi"),
    )
    return recency, demand


# --------------------------------------------------------------- history (S9)
def read_history(spark: SparkSession, path: str) -> DataFrame:
    """Append-only run history. Runs written by older versions may lack columns,
    which read back as null, or hold them in narrower types, which are widened."""
    return read_widened(spark, path)
