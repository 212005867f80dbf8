import json

from pyspark.sql import functions as F

from ebbmark import job
from ebbmark.sources.control_log import LOG_SCHEMA, conform


def test_command_line(spark, tmp_path, capsys):
    spark.range(10).write.parquet(f"{tmp_path}/t")
    row = spark.sql(
        "SELECT 't' AS tablename, 4 AS typeid, 'id' AS checkcolumn, 2 AS columntypeid, "
        "7L AS longoffset, 0L AS seq"
    )
    missing = {f.name: F.lit(None) for f in LOG_SCHEMA if f.name not in row.columns}
    conform(row.withColumns(missing), LOG_SCHEMA).write.parquet(f"{tmp_path}/control")
    settings = {
        "control": {"name_value": f"{tmp_path}/{{table}}", "name": "control"},
        "tables": {"name_value": f"{tmp_path}/{{table}}"},
        "sink": {"format": "json", "options": {"path": f"{tmp_path}/out"}},
        "export": {"shift_hours": 0},
    }
    (tmp_path / "settings.json").write_text(json.dumps(settings))
    job.main(["4", "--settings", str(tmp_path / "settings.json")])
    assert capsys.readouterr().out.strip() == "t: 3 rows, offset 7 -> 9"
    assert spark.read.json(f"{tmp_path}/out").count() == 3
