import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from conftest import plan_of
from emberlake.plans import history, profiles, registry
from emberlake.schemas import CANONICAL, FEATURE_COLUMNS, RAW_ARCHIVE, RAW_NRT
from emberlake.sinks import tables
from emberlake.sources import files
from helpers import ARCHIVE, NRT, raw_frame, raw_row


def write_csv(path, header, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    lines = [",".join(header)] + [",".join(str(r.get(h, "")) for h in header) for r in records]
    path.write_text("\n".join(lines) + "\n")


@pytest.fixture
def data_dir(tmp_path):
    """Two years; the later one has an archive and a near-real-time file."""
    base = tmp_path / "raw"
    early = [{**ARCHIVE, "acq_time": str(t), "frp": t / 10} for t in (5, 30, 125, 125)]
    write_csv(base / "2024" / "fire_archive_1.csv", RAW_ARCHIVE.names, *early, {**ARCHIVE, "latitude": "95"})
    late = {**ARCHIVE, "acq_date": "2026-03-01", "type": "2"}
    write_csv(base / "2026" / "fire_archive_2.csv", RAW_ARCHIVE.names, late)
    write_csv(base / "2026" / "fire_NRT_2.csv", RAW_NRT.names, NRT, {**NRT, "brightness": "n/a"})
    return str(base)


def test_products_are_routed_by_file_name(spark, data_dir):
    rows = files.read_year(spark, data_dir, 2026).collect()
    assert sorted((r.version, r.type) for r in rows if r.type is not None) == [("2", 2)]
    assert sum(r.version == "2.0NRT" and r.type is None for r in rows) == 2
    assert sum(r.brightness is None for r in rows) == 1


def test_other_products_files_are_never_opened(spark, data_dir):
    plan = plan_of(files.read_year(spark, data_dir, 2026))
    assert plan.count("FileScan csv") == 2
    assert files.read_year(spark, data_dir, 2026).select("frp").count() == 3
    assert plan_of(files.read_year(spark, data_dir, 2024)).count("FileScan csv") == 1


def test_missing_inputs(spark, data_dir, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such year folder"):
        files.read_year(spark, data_dir, 1999)
    (tmp_path / "raw" / "2001").mkdir()
    (tmp_path / "raw" / "2001" / "notes.txt").write_text("x")
    with pytest.raises(FileNotFoundError, match="no CSV files"):
        files.read_year(spark, data_dir, 2001)


def test_sample_is_taken_from_every_file(spark, data_dir):
    assert files.read_year(spark, data_dir, 2026, sample_limit=1).count() == 2
    assert files.read_years(spark, data_dir, [2024, 2026], sample_limit=2).count() == 2 + 1 + 2


def test_header_mismatch_is_an_error(spark, tmp_path):
    names = RAW_ARCHIVE.names
    write_csv(tmp_path / "2024" / "swapped.csv", [names[1], names[0], *names[2:]], ARCHIVE)
    with pytest.raises(Exception, match="header"):
        files.read_year(spark, str(tmp_path), 2024).collect()


def test_file_metadata(spark, data_dir):
    rows = files.file_metadata(spark, data_dir, [2024, 2026]).collect()
    assert sorted(r.file_name for r in rows) == ["fire_NRT_2.csv", "fire_archive_1.csv", "fire_archive_2.csv"]
    assert all(r.file_size > 0 and r.size_mb == round(r.file_size / 2**20, 2) for r in rows)


def test_history_run(spark, data_dir, tmp_path):
    layout = history.Layout.under(str(tmp_path / "out"), raw_sample=True)
    reports = {r.year: r for r in history.run(spark, data_dir, [2026, 2024], layout).collect()}
    early = reports[2024]
    assert (early.input_rows, early.invalid_rows, early.duplicate_rows, early.output_curated_rows) == (5, 1, 1, 3)
    assert early.quality_status == "PASSED_WITH_WARNINGS" and reports[2026].quality_status == "PASSED"
    assert early.spatial_bounds.max_latitude == -21.375 and early.temporal_bounds.min_acq_date == "2024-09-22"
    assert [f.file_name for f in reports[2026].input_files] == ["fire_NRT_2.csv", "fire_archive_2.csv"]

    overall = spark.read.json(f"{layout.reports}/overall").first()
    assert (overall.total_input_rows, overall.total_output_rows, list(overall.years_processed)) == (8, 5, [2024, 2026])

    stored = files.read_partitioned(spark, layout.features, [2024])
    assert set(stored.columns) == {*FEATURE_COLUMNS, "folder_year"} - {"folder_year"} and stored.count() == 3
    assert spark.read.option("header", True).csv(f"{layout.raw_sample}/year=2024").count() == 5
    quarantined = history.quarantine(spark.read.parquet(layout.checked))
    assert [r.latitude for r in quarantined.collect()] == [95.0]


def test_reprocessing_one_year_leaves_the_others(spark, data_dir, tmp_path):
    layout = history.Layout.under(str(tmp_path / "out"))
    history.run(spark, data_dir, [2024, 2026], layout)
    history.run(spark, data_dir, [2026], layout, sample_limit=1)
    counts = {r.year: r["count"] for r in spark.read.parquet(layout.curated).groupBy("year").count().collect()}
    assert counts == {2024: 3, 2026: 2}


def test_year_wide_near_real_time_flag(spark, data_dir, tmp_path):
    layout = history.Layout.under(str(tmp_path / "out"))
    history.run(spark, data_dir, [2024, 2026], layout, nrt=F.col("source_year") == 2026)
    stored = spark.read.parquet(layout.curated)
    assert stored.where("year = 2026 AND type IS NOT NULL").isEmpty()
    assert stored.where("year = 2024 AND type IS NULL").isEmpty()


def test_profile_run(spark, data_dir, tmp_path):
    summary = {r.year: r for r in profiles.run(spark, data_dir, [2024, 2026], str(tmp_path / "p")).collect()}
    assert (summary[2024].total_rows, summary[2024].duplicate_rows, summary[2024].total_files) == (5, 1, 1)
    assert summary[2026].date_range == "2026-03-01 to 2026-05-01" and summary[2026].satellites == "SNPP"
    yearly = {r.year: r for r in spark.read.json(f"{tmp_path}/p/yearly").collect()}
    assert yearly[2026].null_counts.type == 2 and yearly[2026].null_counts.brightness == 1
    assert yearly[2024].validation.invalid_latitude_count == 1
    assert yearly[2024].numeric_statistics.frp.asDict() == {"min": 0.5, "max": 27.5, "avg": 11.2}
    assert yearly[2026].distinct_values.versions == ["2", "2.0NRT"] and yearly[2024].distinct_values.fire_types == [0]
    assert yearly[2024].spatial_bounds.max_latitude == 95.0 and len(yearly[2024].columns) == 15
    assert len(yearly[2026].file_metadata) == 2
    overall = spark.read.json(f"{tmp_path}/p/overall").first()
    assert (overall.grand_total_rows, overall.grand_total_files) == (8, 3)


def test_a_rerun_replaces_a_year_that_comes_out_empty(spark, tmp_path):
    layout = history.Layout.under(str(tmp_path / "h"))
    good = raw_frame(spark, raw_row(), raw_row(latitude=12.5)).withColumn("source_year", F.lit(2024))
    other = raw_frame(spark, raw_row(acq_date="2023-02-03")).withColumn("source_year", F.lit(2023))
    history.process(spark, good.unionByName(other), [2023, 2024], layout).collect()
    bad = raw_frame(spark, raw_row(latitude=123.0)).withColumn("source_year", F.lit(2024))
    row = history.process(spark, bad, [2024], layout).first()
    assert (row["input_rows"], row["invalid_rows"], row["output_rows"], row["duplicate_rows"]) == (1, 1, 0, 0)
    for base, kept in ((layout.checked, [2023, 2024]), (layout.curated, [2023]), (layout.features, [2023])):
        assert sorted(r["year"] for r in spark.read.parquet(base).select("year").distinct().collect()) == kept


def test_text_round_trip(spark, tmp_path):
    path = str(tmp_path / "text")
    tables.write_text(spark.createDataFrame([(bytearray(b"one"),), (bytearray(b"two"),)], "value BINARY"), path)
    assert sorted(r.value for r in files.read_text(spark, path).collect()) == ["one", "two"]


def test_large_csv_results_stay_in_parts(spark, tmp_path):
    df = spark.range(100).repartitionByRange(4, "id")
    tables.write_result_csv(df, str(tmp_path / "parts"))
    assert len(list((tmp_path / "parts").glob("*.csv"))) == 4


def test_missing_partitions_give_no_rows(spark, tmp_path):
    base = str(tmp_path / "t")
    rows = spark.createDataFrame([(1.0, 2024), (2.0, 2025)], "latitude DOUBLE, year INT")
    tables.write_years(rows, base)
    read = files.read_partitioned(spark, base, [2025, 2030])
    assert [r.latitude for r in read.collect()] == [2.0]
    assert files.missing_years(read, [2025, 2030]) == [2030]


def test_glob_over_year_folders(spark, tmp_path):
    base = str(tmp_path / "t")
    stamps = spark.sql("SELECT timestamp_seconds(id * 40000000) AS event_timestamp FROM range(40, 46)")
    tables.write_years(stamps.withColumn("year", F.year("event_timestamp")), base)
    read = files.read_partitioned(spark, f"{base}/year=*", [2021])
    assert [r.year for r in read.collect()] == [2021]


def test_year_is_derived_when_not_stored(spark, tmp_path):
    base = str(tmp_path / "flat")
    spark.sql("SELECT TIMESTAMP '2024-05-06 07:08:00' AS event_timestamp").write.parquet(base)
    assert files.read_partitioned(spark, base, [2024]).first().year == 2024


def test_canonical_contract():
    assert CANONICAL.names[:15] == RAW_ARCHIVE.names and len(FEATURE_COLUMNS) == 27


def test_year_folders_are_written_without_sorting_a_year(spark, sf_dir, tmp_path, monkeypatch):
    name, seen, write = "spark.sql.maxConcurrentOutputFileWriters", [], DataFrameWriter.csv
    before = spark.conf.get(name)

    def csv(self, *args, **options):
        seen.append(int(spark.conf.get(name)))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "csv", csv)
    registry.write_year_folders(spark, sf_dir, str(tmp_path / "years"), one_file=True)
    assert seen == [len(registry.FIXTURE_YEARS)] * 2 and spark.conf.get(name) == before
    assert sorted(len(list(p.glob("fire_archive*.csv"))) for p in (tmp_path / "years").glob("source_year=*")) == [1] * 7
