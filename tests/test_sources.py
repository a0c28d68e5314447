"""Readers and writers: delimited snapshot, HTTP-code file with BOM and a
repeated header, segment JSON, history append and re-run idempotence."""

import datetime as dt
import json
import os

from clientcurve import config as C
from clientcurve.sinks import writers
from clientcurve.sources import readers
from clientcurve.session import shared_path


def test_pipe_snapshot_by_name_keeps_codes_text(spark, tmp_path):
    p = tmp_path / "orgs.csv"
    header = "|".join(["extra", *readers.ORG_SNAPSHOT_COLUMNS.keys()])
    lines = [
        header,
        "z|10|10.19|GRP_2|27|2001-01-05|2001-07-01|171|654",
        "z|11||GRP_2|28.0|bad|2001-07-01||",
        "z|12|7||||||",
    ]
    p.write_text("\n".join(lines) + "\n", encoding="utf-8")
    df = readers.read_orgs_snapshot(spark, str(p))
    got = {r["id"]: tuple(r) for r in df.collect()}
    assert got[10] == (10, "10.19", "GRP_2", 27, dt.date(2001, 1, 5), dt.date(2001, 7, 1), 171, 654)
    assert got[11] == (11, None, "GRP_2", 28, None, dt.date(2001, 7, 1), None, None)
    assert got[12] == (12, "7", None, None, None, None, None, None)


def test_http_codes_file_with_bom_and_duplicate_header(spark, tmp_path):
    p = tmp_path / "codes.csv"
    text = "﻿Code;Descr;Link;Descr\n200;OK;https://x/200;tudo certo\n404;Not Found;https://x/404;\n"
    p.write_bytes(text.encode("utf-8"))
    df = readers.read_http_codes(spark, str(p))
    assert df.columns == ["code", "description", "link", "detail"]
    assert sorted(tuple(r) for r in df.collect()) == [
        (200, "OK", "https://x/200", "tudo certo"),
        (404, "Not Found", "https://x/404", None),
    ]


def test_segment_json(spark, tmp_path):
    doc = {
        "DimRecencia": [{"R_ID": i, "R_Segmento": s, "minimo": lo, "maximo": hi} for i, s, lo, hi in C.RECENCY_SEGMENTS],
        "DimDemanda": [{"D_ID": i, "D_Segmento": s, "minimo": lo, "maximo": hi} for i, s, lo, hi in C.DEMAND_SEGMENTS],
    }
    p = tmp_path / "dims.json"
    p.write_text(json.dumps(doc, indent=2), encoding="utf-8")
    rec, dem = readers.read_segment_dims(spark, str(p))
    assert sorted(tuple(r) for r in rec.collect()) == sorted(C.RECENCY_SEGMENTS)
    assert sorted(tuple(r) for r in dem.collect()) == sorted(C.DEMAND_SEGMENTS)


def test_history_append_is_additive_and_rerun_safe(spark):
    path = shared_path(spark, "hist")
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, econ_group string")
    b = spark.createDataFrame([(3, "z", "1.0.0.0.0")], "id long, econ_group string, change_code string")
    writers.append_history(a, path, dt.datetime(2024, 1, 1))
    writers.append_history(b, path, dt.datetime(2024, 1, 8))
    h = readers.read_history(spark, path)
    assert h.count() == 3
    assert {r["org_id"]: r["change_code"] for r in h.collect()} == {1: None, 2: None, 3: "1.0.0.0.0"}
    # the same run written again (a retried job) replaces only its own partition
    writers.append_history(b, path, dt.datetime(2024, 1, 8))
    assert readers.read_history(spark, path).count() == 3


def test_pipe_roundtrip_nulls(spark):
    path = shared_path(spark, "pipe")
    df = spark.createDataFrame([(1, "1.2", None)], "id long, codes string, econ_group string")
    writers.write_delimited(df, path)
    back = readers.read_delimited_text(spark, path, "|")
    assert [tuple(r) for r in back.collect()] == [("1", "1.2", None)]
    assert os.path.isdir(path.replace("file:", ""))


def test_snapshot_keeps_values(spark):
    """Values that pandas would read as they stand: long ids, timestamp text,
    doubled quotes, blanks in codes; what is no number becomes null."""
    from clientcurve.session import shared_path
    from clientcurve.sources import readers

    names = {v: k for k, v in readers.ORG_SNAPSHOT_COLUMNS.items()}
    fields = ["id", "codes", "econ_group", "crm_curve", "crm_first", "crm_last", "crm_status", "crm_group_status"]
    lines = [
        "|".join(names[f] for f in fields),
        '9007199254740993| 12.13|"G ""A"" x"|27.0|2024-01-05 00:00:00|2024-01-05T00:00:00|171|654',
        "8|7|plain|1e400|2024-01-06|x|NaN|99999999999",
        "9.0|||27.5|||inf|",
    ]
    path = shared_path(spark, "snapshot")
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    got = {r["id"]: r.asDict() for r in readers.read_orgs_snapshot(spark, path).collect()}
    a, b, c = got[9007199254740993], got[8], got[9]
    assert (a["codes"], a["econ_group"], a["crm_curve"], str(a["crm_first"]), str(a["crm_last"])) == (" 12.13", 'G "A" x', 27, "2024-01-05", "2024-01-05")
    assert (b["crm_curve"], str(b["crm_first"]), b["crm_last"], b["crm_status"], b["crm_group_status"]) == (None, "2024-01-06", None, None, None)
    assert c["codes"] is None and c["econ_group"] is None and c["crm_status"] is None


def test_cluster_needs_a_shared_folder():
    import pytest

    from clientcurve import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda key, default=None: default)})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
