from viewloom.streaming.incremental import write_new_pairs


def test_pairs_are_written_once(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    for n, rows in enumerate(([(0, 1), (2, 1)], [(1, 0), (1, 2), (3, 4)])):
        spark.createDataFrame(rows, "src long, dst long").write.mode("append").parquet(source)
        stream = spark.readStream.schema("src long, dst long").parquet(source)
        write_new_pairs(stream, table, str(tmp_path / "check")).awaitTermination(120)
        found = sorted((r.src, r.dst) for r in spark.read.parquet(table).collect())
        assert found == [(0, 1), (1, 2)] + [(3, 4)] * n
