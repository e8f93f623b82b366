"""Text sink format (A4) and round trips (A1, A3, A4)."""

from __future__ import annotations

import glob

import pytest
from pyspark.sql import functions as F

from cellscope.operators import aggregate as agg
from cellscope.sources import sinks
from cellscope.sources import text as text_src
from cellscope.operators.aggregate import AREA_HOUR_OUTPUT
from tests.helpers import line


def test_batch_output_format_roundtrip(spark, tmp_path):
    """Lines of the output format read back and written again are the same."""
    rows = ["Avenue_00\t-89.74,5.55,34.91,3.03,0.70,0.02", "Big_Park_23\t-0.57,0.00,1234.50,8.07,0.71,0.47"]
    (tmp_path / "part-0").write_text("\n".join(rows) + "\n")
    parsed = sinks.read_area_hour_text(spark, str(tmp_path / "part-0"))
    assert sorted((r.area, r.hour) for r in parsed.collect()) == [("Avenue", 0), ("Big_Park", 23)]
    again = sinks.area_hour_lines(parsed.select("area", "hour", *[parsed[n].cast("double").alias(n) for n in AREA_HOUR_OUTPUT]))
    assert [r.value for r in again.collect()] == rows


def test_write_and_read_back(spark, tmp_path):
    lines = spark.createDataFrame([(line(id=str(i), area=a, timestamp=str(1624367008 + 3600 * h)),)
                                   for i, (a, h) in enumerate([("Park", 0), ("Park", 0), ("Avenue", 5)])],
                                  "value string")
    src = tmp_path / "in"
    lines.write.text(str(src))
    result = agg.area_hour_averages(text_src.read_measurement_lines(spark, str(src)))
    out = tmp_path / "out"
    sinks.write_area_hour_text(result, str(out))
    text = "".join(open(p).read() for p in sorted(glob.glob(str(out / "part-*"))))
    assert text.splitlines() == ["Avenue_18\t1.50,1.50,1.50,1.50,1.50,1.50", "Park_13\t1.50,1.50,1.50,1.50,1.50,1.50"]
    with pytest.raises(Exception):
        sinks.write_area_hour_text(result, str(out))  # target must not exist


def test_area_hour_job(spark, tmp_path):
    from cellscope.plans import area_hour_job
    src = tmp_path / "in"
    spark.createDataFrame([(line(area="Park"),), (line(area="Park", PCell_SNR_max="2.5"),), ("",)],
                          "value string").write.text(str(src))
    area_hour_job.run(spark, str(src), str(tmp_path / "out"))
    text = "".join(open(p).read() for p in sorted(glob.glob(str(tmp_path / "out" / "part-*"))))
    assert text.splitlines() == ["Park_13\t1.50,2.00,1.50,1.50,1.50,1.50"]
    assert area_hour_job.main([]) == 2
