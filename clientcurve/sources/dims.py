"""Small, fixed-size dimensions (a few dozen rows at most), built as literal
frames. Their size is bounded by construction, so they are safe to broadcast."""

from __future__ import annotations

from http import HTTPStatus

from pyspark.sql import DataFrame, SparkSession

from .. import config as C
from .. import schemas as S

def http_code_rows() -> list[tuple]:
    """(code, description, link, detail) for every standard HTTP status code.

    Built from the standard registry instead of a hand-kept list."""
    return [
        (int(s.value), s.phrase, C.HTTP_DOC_LINK.format(code=int(s.value)), s.description or None)
        for s in HTTPStatus
    ]


def http_codes(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(http_code_rows(), S.HTTP_CODES)


def dim_recency(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.RECENCY_SEGMENTS, S.DIM_RECENCY)


def dim_demand(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(C.DEMAND_SEGMENTS, S.DIM_DEMAND)
