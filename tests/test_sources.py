import json
import os
import tempfile

from pyspark.sql import functions as F

from estuary.sources import files


def test_log_file_selection_orders_servers_numerically(spark):
    root = tempfile.mkdtemp(prefix="logs-")
    for server in (2, 10):
        for day in ("2023-05-01", "2023-05-02"):
            d = os.path.join(root, f"server{server}")
            os.makedirs(d, exist_ok=True)
            with open(os.path.join(d, f"{day}-conv.json"), "w") as f:
                f.write(json.dumps({"type": "chat", "tstamp": 1.0}) + "\n")
    idx = files.log_files_index(spark, root)
    sel = files.select_log_files(idx, files.default_dates(), max_num_files=3).orderBy("rank_from_end").collect()
    assert [(r.date, r.server) for r in sel] == [("2023-05-02", 10), ("2023-05-02", 2), ("2023-05-01", 10)]
    dates, cutoff = files.cutoff_dates()
    assert cutoff == "20230523" and dates[0] == "2023-04-24" and len(dates) == 31


def test_conv_log_defaults_and_required_fields(spark):
    root = tempfile.mkdtemp(prefix="convlog-")
    with open(os.path.join(root, "2023-05-01-conv.json"), "w") as f:
        f.write(json.dumps({"type": "chat", "tstamp": 1.5, "model": "m"}) + "\n")
        f.write(json.dumps({"type": "leftvote", "tstamp": 2.0, "models": ["a", "b"]}) + "\n")
        f.write(json.dumps({"tstamp": 3.0}) + "\n")
    rows = sorted(files.scan_conv_log(spark, root).collect(), key=lambda r: r.tstamp)
    assert [(r.model, list(r.models), r.bad_row) for r in rows] == [("m", ["", ""], False), ("", ["a", "b"], False), ("", ["", ""], True)]


def test_json_arrays_roundtrip(spark):
    path = tempfile.mkdtemp(prefix="arr-")
    df = spark.range(25).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    files.sink_json_arrays(df, path + "/out", ["k"], rows_per_file=10)
    back = files.scan_json_arrays(spark, path + "/out", "k long, v long")
    assert sorted(tuple(r) for r in back.collect()) == [(i, 2 * i) for i in range(25)]


def test_reviews_csv_multiline_and_dropna(spark):
    path = tempfile.mkdtemp(prefix="rev-")
    with open(os.path.join(path, "r.csv"), "w") as f:
        f.write(',Time,ProductId,UserId,Score,Summary,Text\n0,5,p,u,1,"sum","line1\nline2 ""q"""\n1,6,p,,2,s,t\n')
    rows = files.scan_reviews(spark, path).collect()
    assert len(rows) == 1 and rows[0].Text == 'line1\nline2 "q"'


def test_conv_log_malformed_line_fails(spark):
    import pytest

    root = tempfile.mkdtemp(prefix="convbad-")
    with open(os.path.join(root, "2023-05-01-conv.json"), "w") as f:
        f.write(json.dumps({"type": "chat", "tstamp": 1.5}) + "\n{not json\n")
    with pytest.raises(Exception):
        files.scan_conv_log(spark, root).collect()
    assert files.scan_conv_log(spark, root, mode="PERMISSIVE").count() == 2


def test_parquet_by_key_makes_few_files(spark, tmp_path):
    """Many keys lie in a bounded number of folders and files, a key in one file; every row comes back, a NULL key too."""
    df = spark.range(3000).selectExpr("if(id % 300 = 7, null, cast(id % 300 as string)) site", "cast(id div 300 as int) chunk", "id v")
    files.sink_parquet_by_key(df.repartition(16), str(tmp_path / "cube"), "site", ["chunk"], folders=5)
    back = spark.read.parquet(str(tmp_path / "cube"))
    assert sorted(map(repr, back.select(*df.columns).collect())) == sorted(map(repr, df.collect()))
    assert len(list((tmp_path / "cube").glob("part=*/*.parquet"))) == 5
    held = back.select("site", F.input_file_name().alias("f")).distinct()
    assert held.groupBy("site").count().where("count > 1").count() == 0
