"""Report labels as Column expressions (map lookups with fall-through, trend
arrows, delivery outcome, weekday names, dotted change codes)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(mapping.items())])


def curve_label(code) -> Column:
    """27/28/29 -> A/B/C; any other id stays as its number (text); null stays null."""
    code = _c(code)
    return F.coalesce(F.element_at(_map_literal(C.CURVE_LABELS), code), code.cast("string"))


def trend(new, old) -> Column:
    """'up' when the new class id is lower (better) than the old one, else 'down'.

    A null on either side compares false and so reads 'down'."""
    return F.when(F.coalesce(_c(new) < _c(old), F.lit(False)), F.lit("up")).otherwise(F.lit("down"))


def delivery_outcome(http_code) -> Column:
    """Success on HTTP 200, failure on any other code, error when no response."""
    code = _c(http_code)
    return (
        F.when(code.isNull(), F.lit(C.OUTCOME_ERROR))
        .when(code == C.SUCCESS_HTTP_CODE, F.lit(C.OUTCOME_SUCCESS))
        .otherwise(F.lit(C.OUTCOME_FAILURE))
    )


def weekday_number(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def weekday_label(d) -> Column:
    labels = F.array(*[F.lit(x) for x in C.WEEKDAY_LABELS])
    return F.element_at(labels, weekday_number(d) + 1)


def change_code(*flags) -> Column:
    """Dotted code of 0/1 flags, null counted as 0: e.g. '1.0.0.1.0'."""
    parts = [F.coalesce(_c(f).cast("int"), F.lit(0)).cast("string") for f in flags]
    return F.concat_ws(".", *parts)
