import json
import re
from pathlib import Path

import pytest
import samples
from samples import dicts, lines, record, summary
from pyspark.sql import functions as F

import gridclimate as gc
from gridclimate.sources.tables import read_key_ranges


def some(spark):
    rows = summary(spark, (45.0, -93.0, 1950, "FALL", 1.5, 3), (-5.0, 7.0, 1951, "", None, 0))
    return rows.withColumn("stations", F.array(F.lit("A"), F.lit("B")))


def test_tables_are_ordered_across_files(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("k"), F.xxhash64("id").cast("string")).alias("key"))
    with_cells = rows.selectExpr("key", "'F' AS family", "'Q' AS qualifier", "'v' AS value")
    gc.write_table(with_cells, str(tmp_path), "some_cells")
    back = gc.read_table(spark, str(tmp_path), "some_cells")
    assert back.count() == 5000
    ranges = sorted(
        tuple(r) for r in back.groupBy(F.input_file_name()).agg(F.min("key"), F.max("key"))
        .select("min(key)", "max(key)").collect()
    )
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_text_view(spark):
    gc.register_summary_view(some(spark), "text_view")
    view = spark.table("text_view")
    assert {t for _, t in view.dtypes} == {"string"} and len(view.columns) == 8
    rows = {r["key"]: r for r in dicts(view)}
    assert rows["45.0:-93.0:1950:FALL"] == {
        "key": "45.0:-93.0:1950:FALL", "latitude": "45.0", "longitude": "-93.0", "year": "1950",
        "season": "FALL", "avg_temp": "1.5", "data_points": "3", "stations": "A;B",
    }


def test_csv(spark, tmp_path):
    gc.export_csv(some(spark).where("year = 1950"), str(tmp_path / "csv"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "csv").glob("part-*")))
    assert text == "45.0:-93.0:1950:FALL,45.0,-93.0,1950,FALL,1.5,3,A;B\n"


def test_json_values_are_text_in_order(spark):
    (row,) = gc.to_json_documents(gc.coordinate_document(some(spark), 45.2, "-93")).collect()
    assert row.json == (
        '{"latitude":"45.2","longitude":"-93","data_list":[{"year":"1950","season":"FALL",'
        '"avg_temp":"1.5","data_points":"3","stations":"A;B"}]}'
    )
    documents = [json.loads(r.json) for r in gc.to_json_documents(some(spark)).collect()]
    assert {d["avg_temp"] for d in documents} == {"1.5", None}


def test_shared_folder_is_the_named_one(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = gc.shared_folder(spark), gc.shared_folder(spark)
    assert first.startswith(named + "/") and first != second


def test_jobs_from_files(spark, tmp_path):
    root = str(tmp_path / "tables")
    records = [
        record("AA000000001", "1950-01", "", "1.0"), record("AA000000001", "1950-01", "2", "3.0"),
        record("AA000000001", "1950-12", "2", "5.0"), record("AA000000001", "1899-12", "2", "5.0"),
    ]
    lines(spark, *records).write.option("compression", "gzip").text(str(tmp_path / "raw"))
    place = "AA000000001  27.3237  -80.3111    3.0 FL PORT ST. LUCIE 4.1 E           GSN HCN 72204"
    lines(spark, place, place).write.text(str(tmp_path / "stations"))
    lines(spark, "AA Somewhere").write.text(str(tmp_path / "countries"))

    gc.ingest_observations(spark, str(tmp_path / "raw"), root, parallelism=3)
    gc.ingest_stations(spark, str(tmp_path / "stations"), str(tmp_path / "countries"), root)
    gc.build_summary(spark, root)
    assert gc.read_table(spark, root, "observations").count() == 3
    assert dicts(gc.read_table(spark, root, "stations"))[0]["country_name"] == "Somewhere"
    assert dicts(gc.read_table(spark, root, "summary")) == [
        {"key": "27.0:-80.0:1950:WINTER", "latitude": 27.0, "longitude": -80.0, "year": 1950,
         "season": "WINTER", "avg_temp": 4.0, "data_points": 2, "stations": ["AA000000001"]}
    ]


def test_gzip_lines_are_dealt_out(spark, tmp_path):
    path = str(tmp_path / "one")
    lines(spark, *[record()] * 50).coalesce(1).write.option("compression", "gzip").text(path)
    assert gc.read_observation_lines(spark, path).rdd.getNumPartitions() == 1
    assert gc.read_observation_lines(spark, path, 5).rdd.getNumPartitions() == 5


class Session:
    """As much of a session as ``shared_folder`` looks at."""

    def __init__(self, master, shared=None):
        self.conf = {"spark.checkpoint.dir": shared}
        self.sparkContext = type("Context", (), {"master": master})


def test_shared_folder_of_a_cluster_must_be_named():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            gc.shared_folder(Session(master))
        assert gc.shared_folder(Session(master, "hdfs://x/y/")).startswith("hdfs://x/y/gridclimate-")
    for master in ("local", "local[4]", "local[*]"):
        assert Path(gc.shared_folder(Session(master))).is_dir()


def observation_rows(spark, *rows):
    return samples.observations(spark, *[samples.observation(*r) for r in rows])


def data_files(root, name):
    return {str(p): p.stat().st_mtime_ns for p in (Path(root) / name).rglob("*.parquet")}


def test_added_rows_replace_those_of_their_key(spark, tmp_path):
    root = str(tmp_path)
    first = observation_rows(spark, ("AA", 1950, 1, 1.0), ("AB", 1951, 2, 2.0), ("AC", 1963, 3, 3.0), ("AD", 1999, 4, 4.0))
    second = observation_rows(spark, ("AA", 1950, 1, 9.0), ("AB", 1951, 2, 1.0), ("AE", 1955, 5, 5.0), ("AF", 2001, 1, 6.0))
    assert gc.merge_table(first, root, "observations", gc.latest_per_key) == ["195", "196", "199"]
    before = data_files(root, "observations")
    assert gc.merge_table(second, root, "observations", gc.latest_per_key) == ["195", "200"]
    stored = {r.key: r.avg_temp for r in gc.read_table(spark, root, "observations").collect()}
    assert stored == {
        "1950:1:AA": 9.0, "1951:2:AB": 2.0, "1955:5:AE": 5.0, "1963:3:AC": 3.0, "1999:4:AD": 4.0, "2001:1:AF": 6.0,
    }
    both = gc.latest_per_key(first.unionByName(second))
    assert gc.read_table(spark, root, "observations").exceptAll(both).count() == 0
    after = data_files(root, "observations")
    # The files of the two ranges that no new key touches are the same ones.
    assert len(before.items() & after.items()) == 2
    assert gc.merge_table(second.where("false"), root, "observations", gc.latest_per_key) == []
    assert data_files(root, "observations") == after


def failing(rows):
    return rows.withColumn("avg_temp", F.when(F.col("month") == 7, F.raise_error(F.lit("no")).cast("double")).otherwise(F.col("avg_temp")))


def test_a_failed_write_leaves_the_table(spark, tmp_path):
    root = str(tmp_path)
    good = observation_rows(spark, *[("AA", 1900 + i, 1, float(i)) for i in range(40)])
    bad = observation_rows(spark, *[("AA", 1900 + i, 1 + i % 12, 7.0) for i in range(40)])
    gc.write_table(good, root, "observations")
    with pytest.raises(Exception, match="no"):
        gc.write_table(failing(bad), root, "observations")
    assert gc.read_table(spark, root, "observations").exceptAll(good).count() == 0
    before = data_files(root, "observations")
    with pytest.raises(Exception, match="no"):
        gc.merge_table(bad, root, "observations", lambda rows: gc.latest_per_key(failing(rows)))
    assert data_files(root, "observations") == before
    assert gc.read_table(spark, root, "observations").count() == 40
    gc.write_table(bad, root, "observations")
    assert gc.read_table(spark, root, "observations").exceptAll(bad).count() == 0
    # The version before is kept for its readers, the failed one is gone.
    assert len(list((Path(root) / "observations").iterdir())) == 2


def test_a_reader_keeps_its_version(spark, tmp_path):
    root = str(tmp_path)
    gc.write_table(some(spark), root, "summary")
    reader = gc.read_table(spark, root, "summary")
    gc.write_table(some(spark).where("false"), root, "summary")
    assert reader.count() == 2 and gc.read_table(spark, root, "summary").count() == 0
    gc.write_table(gc.read_table(spark, root, "summary").unionByName(some(spark)), root, "summary")
    assert gc.read_table(spark, root, "summary").count() == 2


def test_refreshed_summary_reads_changed_ranges_only(spark, tmp_path):
    root = str(tmp_path)
    places = samples.stations(spark, ("AA", 1.2, 2.2), ("AB", 1.4, 2.4), ("AC", 50.0, 60.0))
    rows = [(s, y, 1, float(y - 1900 + k)) for k, s in enumerate(("AA", "AB", "AC")) for y in (1899, 1905, 1911, 1923, 1937)]
    gc.write_table(places, root, "stations")
    gc.merge_table(observation_rows(spark, *rows), root, "observations", gc.latest_per_key)
    gc.build_summary(spark, root)
    ranges = gc.merge_table(observation_rows(spark, ("AA", 1911, 2, 30.0), ("AC", 1912, 1, 5.0)), root, "observations", gc.latest_per_key)
    assert ranges == ["191"]
    read = read_key_ranges(spark, root, "observations", ranges)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 5 and re.search(r"PartitionFilters: \[[^\]]*key_range", plan)
    gc.refresh_summary(spark, root, ranges)
    refreshed = gc.read_table(spark, root, "summary").collect()
    gc.build_summary(spark, root)
    assert sorted(refreshed) == sorted(gc.read_table(spark, root, "summary").collect())
    assert len(refreshed) == 4 * 2 + 1
