"""Update outbox (one sparse record per changed organisation), its JSON
payload, and the delivery report of the sent updates.

Sending is left to the caller: the outbox is a table, written once per run,
that any sender can consume; nothing here talks to the network."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.labels import change_code, delivery_outcome
from ..functions.nulls import flag_is_one


def _first_last_flags():
    billing = flag_is_one("billing_changed")
    first = F.coalesce(F.col("first_changed"), F.lit(False)) & billing
    last = F.coalesce(F.col("last_changed"), F.lit(False)) & billing
    return first, last


def outbox_change_code():
    """'status.curve.first.last.group' change code of a flagged row."""
    first, last = _first_last_flags()
    return change_code("status_changed", "curve_changed", first, last, "group_status_changed")


def update_outbox(changed: DataFrame) -> DataFrame:
    """(id, change_code, status, curve, first_billed, last_billed, group_status).

    A value is filled only when its flag is 1; the two dates also need the
    billing flag. ``change_code`` lists the five flags as 'status.curve.first.
    last.group' with null read as 0."""
    first, last = _first_last_flags()
    return changed.select(
        "id",
        outbox_change_code().alias("change_code"),
        F.when(flag_is_one("status_changed"), F.col("status")).alias("status"),
        F.when(flag_is_one("curve_changed"), F.col("curve")).alias("curve"),
        F.when(first, F.col("first_billed")).alias("first_billed"),
        F.when(last, F.col("last_billed")).alias("last_billed"),
        F.when(flag_is_one("group_status_changed"), F.col("group_status")).alias("group_status"),
    )


def payload_column(field_keys: dict | None = None):
    """The outbox record as a JSON object keyed by the CRM field keys; null
    values are left out (to_json drops null fields)."""
    keys = field_keys or C.FIELD_KEYS
    fields = [
        F.col("status").cast("int").alias(keys["status"]),
        F.col("curve").cast("int").alias(keys["curve"]),
        F.date_format("first_billed", "yyyy-MM-dd").alias(keys["first_billed"]),
        F.date_format("last_billed", "yyyy-MM-dd").alias(keys["last_billed"]),
        F.col("group_status").cast("int").alias(keys["group_status"]),
    ]
    return F.to_json(F.struct(*fields))


def update_payload(outbox: DataFrame, field_keys: dict | None = None) -> DataFrame:
    """(id, payload) for every outbox record."""
    return outbox.select("id", payload_column(field_keys).alias("payload"))


def delivery_report(log: DataFrame, http_codes: DataFrame) -> DataFrame:
    """(org_id, run_date, http_code, outcome, description, link): each delivery
    attempt with its outcome label and the HTTP code's description.

    Nothing runs while the plan is built: Spark broadcasts the code dimension
    when its size at run time allows it."""
    codes = http_codes.select(F.col("code"), "description", "link")
    return log.join(codes, log["http_code"] == codes["code"], "left").select(
        "org_id",
        "run_date",
        "http_code",
        delivery_outcome("http_code").alias("outcome"),
        "description",
        "link",
    )
