"""The month files that stand for the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tripmill.sources import testtables


def test_month_files_are_written_without_a_shuffle(spark, tmp_path):
    days = spark.range(0, 4_000, 1, 4).select(
        "id", F.expr("timestamp_ntz '1999-01-31 00:00:00' + make_dt_interval(cast(id % 90 as int))").alias("pickup")
    )
    root = str(tmp_path / "months")
    context = spark.sparkContext
    context.setJobGroup("month-files", "write")
    try:
        testtables._write_months(days, "pickup", root)
    finally:
        context.setJobGroup("tests", "")
    tracker = context.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("month-files") for s in tracker.getJobInfo(job).stageIds]
    assert len(stages) == 1
    back = spark.read.parquet(root)
    assert sorted(p.name for p in (tmp_path / "months").glob("ym=*")) == [f"ym=1999-0{m}" for m in (1, 2, 3, 4)]
    assert back.filter(F.date_format("pickup", "yyyy-MM") != F.date_format(F.to_date("ym", "yyyy-MM"), "yyyy-MM")).count() == 0
    assert sorted(map(tuple, back.select("id", "pickup").collect())) == sorted(map(tuple, days.collect()))
