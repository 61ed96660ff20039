"""Time the headline jobs and queries; prints one line of JSON.

``BENCH_SF_DIR`` names the folder of the test tables and ``BENCH_CPUS`` the number of threads.
Raw lines are derived and written as gzip text first, untimed. Every query then runs once to
warm up and ``BENCH_REPEATS`` times (2 unless set) for the record; the least time counts.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

import gridclimate as gc  # noqa: E402
from gridclimate import fixtures  # noqa: E402

POINT = (3.3, -2.6)
AREA = (-5, -1, 10, 5, 1901, 1904)


def run(rows):
    rows.write.format("noop").mode("overwrite").save()


def prepare(spark, sf_dir, cpus, root):
    raw = {
        "records": fixtures.observation_lines(spark, sf_dir).repartition(cpus),
        "stations": fixtures.station_lines(spark, sf_dir),
        "countries": fixtures.country_lines(spark, sf_dir),
    }
    for name, lines in raw.items():
        lines.write.option("compression", "gzip").text(f"{root}/raw/{name}")


def timed_queries(spark, sf_dir, root):
    raw = f"{root}/raw"

    def table(name):
        return gc.read_table(spark, root, name)

    def grid():
        return gc.seasonal_grid_summary(table("observations"), table("stations"))

    return {
        "parse_observations": lambda: run(
            gc.parse_observations(gc.read_observation_lines(spark, f"{raw}/records"))
        ),
        "ingest_observations": lambda: gc.ingest_observations(spark, f"{raw}/records", root),
        "ingest_stations": lambda: gc.ingest_stations(
            spark, f"{raw}/stations", f"{raw}/countries", root
        ),
        "seasonal_grid_summary": lambda: run(grid()),
        "build_summary": lambda: gc.build_summary(spark, root),
        "coordinate_summary": lambda: run(gc.coordinate_summary(table("summary"), *POINT)),
        "coordinate_document": lambda: run(gc.coordinate_document(table("summary"), *POINT)),
        "area_entries": lambda: run(gc.area_entries(table("summary"), *AREA)),
        "area_average": lambda: run(gc.area_average(table("summary"), *AREA)),
        "area_document": lambda: run(gc.area_document(table("summary"), *AREA)),
        "coordinate_summary_batch": lambda: run(
            gc.coordinate_summary_batch(table("summary"), fixtures.points(spark, sf_dir))
        ),
        "area_average_batch": lambda: run(
            gc.area_average_batch(table("summary"), fixtures.boxes(spark, sf_dir))
        ),
        "build_area_sums": lambda: gc.build_area_sums(spark, root),
        "area_average_batch_stored": lambda: run(
            gc.area_average_batch(
                table("summary"),
                fixtures.boxes(spark, sf_dir),
                prepared=gc.read_area_sums(spark, root),
            )
        ),
        "heatmap_feed": lambda: run(gc.heatmap_feed(table("summary"), *POINT)),
        "observation_cells": lambda: run(
            gc.to_cells(table("observations"), gc.OBSERVATION_CELLS)
        ),
        "summary_cells_round_trip": lambda: run(
            gc.from_cells(
                gc.to_cells(table("summary"), gc.SUMMARY_CELLS),
                gc.SUMMARY_CELLS,
                table("summary").schema,
            )
        ),
    }


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("gridclimate-bench")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = gc.shared_folder(spark)
    prepare(spark, sf_dir, cpus, root)
    seconds = {}
    for name, query in timed_queries(spark, sf_dir, root).items():
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            query()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times[1:] or times), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline jobs and queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": cpus,
                "repeats": repeats,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
