from pyspark.sql import functions as F

from vetline.plans import jobs
from vetline.sources import jsonl, sinks

SCHEMA = "id bigint, name string, note string, load_type string, dt string"


def _rows(spark, name):
    return spark.range(2000, numPartitions=2).select(
        "id", F.lit(name).alias("name"), F.when(F.col("id") > 5, "é\n\"").alias("note"), F.lit("daily").alias("load_type"), F.concat(F.lit("d"), F.col("id") % 3).alias("dt"))


def test_landed_lines_are_written_small_and_whole(spark, tmp_path):
    path = tmp_path / "land"
    rows = _rows(spark, "a name that each line repeats")
    # a plain first load is replaced as a compressed one is
    sinks.write_jsonl_partitions(_rows(spark, "first load"), str(path), compression="none")
    plain = sum(p.stat().st_size for p in path.rglob("part-*"))
    sinks.write_jsonl_partitions(rows, str(path))
    assert sum(p.stat().st_size for p in path.rglob("part-*")) * 4 < plain
    found = jsonl.read_jsonl(spark, str(path), SCHEMA)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, rows.select(*found.columns).collect()), key=repr)
    assert jobs._landed_files(spark, str(path / "load_type=daily" / "dt=d1")).count() == 2


def test_bad_lines_of_compressed_files_keep_their_numbers(spark, tmp_path):
    lines = spark.createDataFrame([('{"id":1}',), ("",), ("oops",), ('{"id":2}',)], "value string").coalesce(1)
    lines.write.option("compression", "gzip").text(str(tmp_path / "land"))
    good, bad = jsonl.read_jsonl_quarantine(spark, str(tmp_path / "land"), "id bigint")
    assert sorted(r.id for r in good.collect()) == [1, 2]
    assert [(r.line_no, r.line) for r in bad.collect()] == [(3, "oops")]
