"""CSV export reading: BOM, multi-line quoted fields, merge by column name, error paths."""

import pytest
from pyspark.sql import functions as F

from formspark.operators.reshape import expand_responses
from formspark.plans import outputs
from formspark.sources.exports import ExportNotFoundError, NoExportFilesError, read_export, read_export_frame

def test_read_and_merge(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    assert rep.count() == 5 + 1 + 1
    feel = rep.where(F.col("item.name") == "feel").first()
    assert feel.response.value.text == 'Tired but\nfine, "really"'
    assert feel.item.prompt == 'Question feel, "quoted"'
    assert rep.select("applet_version").distinct().first()[0] == "1.10"
    sub = rep.where(F.col("item.type") == "subscale").first()
    assert sub.item.name == "mood" and sub.response.value.subscale == 2.5
    assert sub.activity_submission.id == "sub-3"


def test_users_per_role(spark, export_dir):
    u = outputs.users(read_export(spark, str(export_dir)))
    counts = {r.user_type: r["count"] for r in u.groupBy("user_type").count().collect()}
    assert counts == {"target_user": 3, "source_user": 2, "input_user": 1, "account_user": 1}


def test_single_file_and_errors(spark, export_dir, tmp_path_factory):
    raw = read_export_frame(spark, [str(export_dir / "applet_responses_1.csv")])
    assert raw.count() == 5 and all(t == "string" for _, t in raw.dtypes)
    with pytest.raises(ExportNotFoundError):
        read_export(spark, str(export_dir / "missing"))
    empty = tmp_path_factory.mktemp("empty")
    with pytest.raises(NoExportFilesError):
        read_export(spark, str(empty))


def test_long_and_expand(spark, export_dir):
    rep = read_export(spark, str(export_dir))
    long = expand_responses(rep)
    foods = long.where((F.col("item.name") == "foods") & (F.col("activity_submission.id") == "sub-1"))
    assert sorted((r.response_value_value_index, r.response_value_value) for r in foods.collect()) == [(0, 0), (1, 1)]
    assert "response" in long.columns and "response_value" in long.columns
