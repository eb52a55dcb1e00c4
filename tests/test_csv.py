import pytest
from pyspark.sql import functions as F

from palate.sources import csv_files, schemas

EDGE_CASES = '''movieId,title,genres
1,"A, The (1990)",Comedy|Drama
xx,Bad,Comedy
3,Short
4,T,G,EXTRA
5,"He said ""hi"" (2000)",Sci-Fi
,Null id,Comedy
7,,Comedy
'''


@pytest.fixture
def edge_csv(tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(EDGE_CASES)
    return str(path)


def test_malformed_rows_and_null_ids_are_left_out(spark, edge_csv):
    rows = csv_files.load_csv(spark, edge_csv, schemas.ITEMS).collect()
    assert [tuple(r) for r in rows] == [
        (1, "A, The (1990)", "Comedy|Drama"), (5, 'He said "hi" (2000)', "Sci-Fi"), (7, None, "Comedy")]


def test_null_ids_can_be_kept(spark, edge_csv):
    rows = csv_files.load_csv(spark, edge_csv, schemas.ITEMS, ids=())
    assert rows.count() == 4


@pytest.mark.parametrize("column", ["movieId", "title", "genres"])
def test_rows_kept_do_not_depend_on_the_columns_used(spark, edge_csv, column):
    rows = csv_files.load_csv(spark, edge_csv, schemas.ITEMS, ids=())
    assert len(rows.select(column).collect()) == 4
    assert rows.agg(F.count("*")).first()[0] == 4


def test_audit_accounts_for_every_line(spark, edge_csv):
    row = csv_files.audit_csv(spark, edge_csv, schemas.ITEMS, "movieId").first()
    assert row.asDict() == {"n_lines": 7, "n_malformed": 3, "n_null_id": 1, "n_kept": 3}


def test_one_read_keeps_rejects_and_counts(spark, edge_csv, tmp_path):
    done = csv_files.convert_audited(spark, edge_csv, schemas.ITEMS, str(tmp_path / "items"), str(tmp_path / "rejects"))
    assert done.counts == {"n_lines": 7, "n_malformed": 3, "n_null_id": 1, "n_kept": 3}
    assert sorted(map(tuple, done.rows.collect()), key=str) == sorted(
        map(tuple, csv_files.load_csv(spark, edge_csv, schemas.ITEMS).collect()), key=str)
    rejected = {(r[csv_files.CORRUPT], r.title, r[csv_files.REASON]) for r in done.rejected.collect()}
    assert {(line, reason) for line, _, reason in rejected if line} == {
        ("xx,Bad,Comedy", "malformed"), ("3,Short", "malformed"), ("4,T,G,EXTRA", "malformed")}
    assert (None, "Null id", "null id") in rejected and len(rejected) == 4
    kept = csv_files.convert_audited(spark, edge_csv, schemas.ITEMS, str(tmp_path / "all"), str(tmp_path / "none"), ids=())
    assert kept.counts["n_kept"] == 4 == kept.rows.count() and kept.counts["n_null_id"] == 0


def test_the_lines_are_parsed_by_one_scan(spark, edge_csv, tmp_path, monkeypatch):
    """All but one read of a conversion is of Parquet."""
    scans, load = [], csv_files._reader
    monkeypatch.setattr(csv_files, "_reader", lambda *a: scans.append(a) or load(*a))
    started, kind = [], type(spark.range(0))
    write = kind.write.fget
    monkeypatch.setattr(kind, "write", property(
        lambda df: started.append(df._jdf.queryExecution().executedPlan().toString()) or write(df)))
    csv_files.convert_csv(spark, edge_csv, schemas.ITEMS, str(tmp_path / "out"))
    assert len(scans) == 1 and [("FileScan csv" in p, "FileScan parquet" in p) for p in started] == [(True, False), (False, True), (False, True)]


def test_converting_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("movieId,title,genres\n")
    done = csv_files.convert_audited(spark, str(tmp_path / "empty.csv"), schemas.ITEMS, str(tmp_path / "a"), str(tmp_path / "b"))
    assert done.counts == {"n_lines": 0, "n_malformed": 0, "n_null_id": 0, "n_kept": 0}
    assert done.rows.count() == done.rejected.count() == 0 and done.rows.schema == schemas.ITEMS


def test_schema_is_the_declared_one(spark, edge_csv):
    assert csv_files.load_csv(spark, edge_csv, schemas.ITEMS).schema == schemas.ITEMS


def test_parquet_copy_splits_a_hot_user(spark, tmp_path):
    """One user with most of the rows must not end up in one file."""
    source, target = str(tmp_path / "csv"), str(tmp_path / "parquet")
    rows = spark.range(20000).select(
        F.when(F.col("id") % 10 < 9, 7).otherwise(F.col("id")).cast("int").alias("userId"),
        F.col("id").cast("int").alias("movieId"), F.lit(3.5).cast("float").alias("rating"),
        F.lit("0").alias("timestamp"))
    rows.write.option("header", True).csv(source)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        copy = csv_files.convert_csv(spark, source, schemas.RATINGS, target)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert copy.count() == 20000
    files = copy.filter("userId = 7").select(F.input_file_name().alias("f")).distinct().count()
    assert files >= 4
    plan = copy.filter("userId = 7").select("movieId")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(userId,7)" in plan
