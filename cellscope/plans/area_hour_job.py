"""The batch area-hour job: positional text in, key-ordered text out.

    spark-submit -m cellscope.plans.area_hour_job <input path> <output path>

Input lines are parsed by the tolerant positional source (A3), averaged per
(area, UTC hour) over complete rows (E1, one shuffle with map-side partial
aggregation) and written as ``<area>_<HH><TAB>v1,...,v6`` lines in key
order (A4); the output path must not exist. A failure raises (non-zero exit),
unlike a job whose success flag is ignored.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession

from cellscope.operators.aggregate import area_hour_averages
from cellscope.sources.sinks import write_area_hour_text
from cellscope.sources.text import read_measurement_lines


def area_hour_result(spark: SparkSession, input_path: str) -> DataFrame:
    """The job's result frame (``area, hour, avg_*..., n``), lazy."""
    return area_hour_averages(read_measurement_lines(spark, input_path), order=False)


def run(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Run the job: read, aggregate, write the text output."""
    write_area_hour_text(area_hour_result(spark, input_path), output_path)


def main(argv: list[str] | None = None) -> int:
    args = sys.argv[1:] if argv is None else argv
    if len(args) != 2:
        print("Usage: area_hour_job <input path> <output path>", file=sys.stderr)
        return 2
    from cellscope.session import get_session
    spark = get_session(app_name="area-hour-job")
    run(spark, args[0], args[1])
    return 0


if __name__ == "__main__":
    sys.exit(main())
