"""Readers and sinks on small files."""

import pytest
from pyspark.sql import functions as F

from sparkloom.sources import readers as R
from sparkloom.sources import sinks as K
from sparkloom.streaming.ingest import append_results, result_stream


def test_stream_takes_each_file_once(spark, tmp_path):
    folder, table, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    for i, sample in enumerate(("D0", "D1")):
        (tmp_path / "in" / f"res_{sample}.txt").write_text(f"target_name\tadj_pval\nt{i}\t0.{i + 1}\n")
        append_results(result_stream(spark, folder, "target_name string, adj_pval double"), table, checkpoint).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(table).select("target_name", "adj_pval", "sample").collect())) == [("t0", 0.1, "D0"), ("t1", 0.2, "D1")]


def test_loci_need_their_columns(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("chromosome\tstart\nchr1\t5\n")
    with pytest.raises(ValueError, match="end"):
        R.read_loci(spark, str(tmp_path / "l.tsv"))


def test_names_without_case(spark):
    df = spark.createDataFrame([(1, 2)], "`Gene Name` int, `gene_name` int")
    assert R.with_lower_names(df).first().asDict() == {"gene_name": 1}


def test_batch_lines_keep_corrupt_rows(spark):
    lines = ['{"custom_id": "topic_4", "response": {"content": [{"text": "x"}]}}', "{", "", '{"custom_id": "topic_5", "result": {"type": "errored"}}']
    got = R.parse_batch_lines(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [(r.topic, r.status) for r in got] == [(4, "ok"), (None, "corrupt"), (None, "corrupt"), (5, "errored")]


def test_sheets_number_rows_without_gaps(spark):
    got = K.sheets(spark.range(1000).repartition(7), ["id"], 300).groupBy("sheet").agg(F.count("*").alias("n"), F.min("id").alias("lo")).orderBy("sheet").collect()
    assert [(r.sheet, r.n, r.lo) for r in got] == [(0, 300, 0), (1, 300, 300), (2, 300, 600), (3, 100, 900)]


def test_payload_has_no_infinities(spark):
    df = spark.createDataFrame([("a b/c", float("inf"), 1)], "k string, x double, n int")
    r = K.json_payload(df, "k", ["x", "n"]).first()
    assert r.file_key == "a_b_c" and r.payload == '{"x":null,"n":1}'


def test_written_partitions_of_other_runs_stay(spark, tmp_path):
    df = spark.createDataFrame([(5, 2.0, "s", 1), (6, 2.0, "s", 2)], "K int, sel_thresh double, sample string, v int")
    K.write_partitioned(df.filter("K = 5"), str(tmp_path / "t"))
    K.write_partitioned(df.filter("K = 6"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
