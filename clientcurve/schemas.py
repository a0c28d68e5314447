"""Explicit schemas of every source. Nothing is inferred."""

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

INVOICES = T.StructType(
    [
        T.StructField("client_code", T.StringType(), False),
        T.StructField("issue_date", T.DateType(), False),
        T.StructField("gross", MONEY, True),
        T.StructField("status", T.StringType(), True),
        T.StructField("nfe_no", T.LongType(), True),
    ]
)

# CRM organisation snapshot. ``codes`` is a dot-separated list of contract
# codes and must stay a string (a float reading turns "10.19" into 10.19).
ORGS = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("codes", T.StringType(), True),
        T.StructField("econ_group", T.StringType(), True),
        T.StructField("crm_curve", T.IntegerType(), True),
        T.StructField("crm_first", T.DateType(), True),
        T.StructField("crm_last", T.DateType(), True),
        T.StructField("crm_status", T.IntegerType(), True),
        T.StructField("crm_group_status", T.IntegerType(), True),
    ]
)

HTTP_CODES = T.StructType(
    [
        T.StructField("code", T.IntegerType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("link", T.StringType(), True),
        T.StructField("detail", T.StringType(), True),
    ]
)

DIM_RECENCY = T.StructType(
    [
        T.StructField("r_id", T.IntegerType(), False),
        T.StructField("segment", T.StringType(), False),
        T.StructField("lo", T.IntegerType(), False),
        T.StructField("hi", T.IntegerType(), False),
    ]
)

DIM_DEMAND = T.StructType(
    [
        T.StructField("d_id", T.IntegerType(), False),
        T.StructField("segment", T.StringType(), False),
        T.StructField("lo", T.DoubleType(), False),
        T.StructField("hi", T.DoubleType(), False),
    ]
)

# JSON document holding both segment dimensions. The key names
# of the segment file as the CRM team maintains it.
SEGMENT_DIMS_JSON = T.StructType(
    [
        T.StructField(
            "DimRecencia",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("R_ID", T.IntegerType()),
                        T.StructField("R_Segmento", T.StringType()),
                        T.StructField("minimo", T.IntegerType()),
                        T.StructField("maximo", T.IntegerType()),
                    ]
                )
            ),
        ),
        T.StructField(
            "DimDemanda",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("D_ID", T.IntegerType()),
                        T.StructField("D_Segmento", T.StringType()),
                        T.StructField("minimo", T.DoubleType()),
                        T.StructField("maximo", T.DoubleType()),
                    ]
                )
            ),
        ),
    ]
)
