"""Records over several lines, found in splits of files that are read at once."""

import random

from pyspark.sql import functions as F

from assetloom.sources import files

HEADER = "id_node;type;id_source;payload;version;detection_date"


def written(rows, end="\n"):
    cell = lambda v: '"' + v.replace("\\", "\\\\").replace('"', '\\"') + '"'
    return HEADER + end + "".join(f"{i};fqdn;2;{cell(p)};;{end}" for i, p in rows)


def test_records_over_split_borders_equal_what_was_written(spark, tmp_path):
    rng = random.Random(3)
    want = {}
    for k, end in ((1, "\n"), (2, "\r\n"), (3, "\n")):
        rows = [(1000 * k + i, "".join(rng.choices(["a", "\n", '"', ";", "\\n", " b", "\n\n"], k=rng.randrange(0, 400 if i == 50 else 30)))) for i in range(200)]
        (tmp_path / f"p{k}.csv").write_bytes(written(rows, end).encode())
        want |= {str(i): p for i, p in rows}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "150")
    try:
        scan = spark.read.text(str(tmp_path)).select("_metadata.file_path", F.spark_partition_id().alias("task")).groupBy("file_path").agg(F.count_distinct("task").alias("tasks"))
        assert all(r.tasks > 10 for r in scan.collect())
        good, bad = files.read_staged(spark, str(tmp_path), "property", multi_line=True)
        assert {r.id_node: r.payload or "" for r in good.collect()} == want and good.count() == len(want) and bad.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_endless_records_and_empty_files(spark, tmp_path):
    text = f'{HEADER}\n1;fqdn;2;"a\nb";;\n2;fqdn;2;"open;;\n' + "".join(f"{i};fqdn;2;x;;\n" for i in range(3, 50))
    (tmp_path / "p.csv").write_text(text)
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text(HEADER)
    records, endless = files.read_records(spark, str(tmp_path), max_lines=20)
    assert [r.record for r in records.collect()] == ['1;fqdn;2;"a\nb";;'] and endless.count() == 48
    records, endless = files.read_records(spark, str(tmp_path / "empty.csv"))
    assert records.count() == 0 and endless.count() == 0
