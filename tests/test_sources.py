"""Reading, conforming and storing tables."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from icuqm.config import LungProtection, Sedation, fingerprint
from icuqm.sources.tables import Field, Stages, conform, read_path, resolve_table, scan_table, write_csv


def test_resolve_and_scan(spark, tmp_path):
    raw = spark.createDataFrame([(1, " IMV ", "2024-01-01 10:00:00", "x"), (2, "Cpap", "2024-01-01 11:00:00Z", "0.4")], "hospitalization_id int, device_category string, recorded_dttm string, fio2_set string")
    raw.write.parquet(str(tmp_path / "site_respiratory_support.parquet"))
    assert resolve_table(spark, str(tmp_path), "respiratory_support").endswith("site_respiratory_support.parquet")
    assert resolve_table(spark, str(tmp_path), "labs") is None
    df = scan_table(spark, str(tmp_path), "respiratory_support", keep={"device_category": ["IMV"]})
    got = df.first()
    assert (got.hospitalization_id, got.device_category, got.fio2_set, got.tracheostomy, got.peep_set) == ("1", "imv", None, None, None)
    keys = spark.createDataFrame([("2",)], "hospitalization_id string")
    assert rows(scan_table(spark, str(tmp_path), "respiratory_support", keys=keys), "device_category", "fio2_set") == [("cpap", 0.4)]
    with pytest.raises(FileNotFoundError):
        scan_table(spark, str(tmp_path), "labs")


def test_conform_aliases_and_required(spark):
    df = spark.createDataFrame([("a", "2024-01-01 00:00:00")], "hid string, admit_dttm string")
    out = conform(df, [Field("hid", "id"), Field("admission_dttm", "time", ("admit_dttm",))])
    assert out.columns == ["hid", "admission_dttm"]
    with pytest.raises(ValueError, match="nope"):
        conform(df, [Field("nope", "id")])


def test_stage_is_reused_only_under_the_same_configuration(spark, tmp_path):
    stages, built = Stages(spark, str(tmp_path)), []

    def build():
        built.append(1)
        return spark.range(3)

    key = fingerprint(Sedation())
    assert fingerprint(Sedation(hold=1)) != key != fingerprint(LungProtection())
    for _ in range(2):
        assert stages.get("days", key, build).count() == 3
    stages.get("days", fingerprint(Sedation(hold=1)), build)
    Stages(spark, str(tmp_path), refresh=["days"]).get("days", key, build)
    assert len(built) == 3


def test_csv_report(spark, tmp_path):
    write_csv(spark.createDataFrame([("m", 1)], "metric string, num int"), str(tmp_path / "out.csv"), "here", "now")
    back = read_path(spark, str(tmp_path / "out.csv"))
    assert back.columns == ["site", "metric", "num", "generated"]
    # csv columns are text; conform types them
    assert back.select(F.col("num")).first()[0] == "1"
    assert conform(back, [Field("num", "number")]).first()["num"] == 1.0
