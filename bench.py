"""Time the headline queries and print one JSON line.

Environment: ``BENCH_SF_DIR`` (data folder), ``BENCH_CPUS`` (local threads).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from checks import queries as checks  # noqa: E402
from checks.adapter import instances  # noqa: E402
from seriesloom.plans import derived, geometry, modality, slide  # noqa: E402

HEADLINE = (
    "series_index",
    "version_span",
    "prior_versions",
    "ct_index",
    "mr_index",
    "pt_index",
    "contrast_index",
    "slide_series",
    "slide_instance",
    "segmentation_index",
    "structure_set_index",
    "annotation_groups",
    "volume_geometry",
    "slice_intervals",
    "study_selection",
    "catalogue_mapping",
    "keyed_diff",
    "keyed_diff_repeated",
    "multiset_diff",
    "profile_diff",
)


#: Builders timed on a stored table of instances as well, without the joins that derive it.
STORED = {
    "stored_ct_index": (modality.ct_index, checks.CT_COLUMNS),
    "stored_mr_index": (modality.mr_index, checks.MR_COLUMNS),
    "stored_pt_index": (modality.pt_index, checks.PT_COLUMNS),
    "stored_slide_series": (slide.sm_index, checks.SLIDE_COLUMNS),
    "stored_structure_set_index": (derived.rtstruct_index, checks.RT_COLUMNS),
    "stored_volume_geometry": (geometry.volume_geometry_index, checks.GEOMETRY_COLUMNS),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    registered = checks.queries()
    names = sys.argv[1:] or HEADLINE
    # one untimed query takes the JVM's class loading and first compilation
    registered["series_index"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in (n for n in names if n not in STORED):
        start = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    wanted = {name: STORED[name] for name in STORED if len(sys.argv) < 2 or name in sys.argv[1:]}
    if wanted:
        columns = list(dict.fromkeys(c for _, names in wanted.values() for c in names))
        path = checks.scratch_dir(spark) + "/instances"
        instances(spark, folder, columns).write.parquet(path)
        rows = spark.read.parquet(path)
        for name, (builder, names) in wanted.items():
            start = time.perf_counter()
            builder(rows.select(*names)).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(s for n, s in seconds.items() if n not in STORED), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
