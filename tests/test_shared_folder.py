"""A cluster whose machines mount the folder of ``spark.checkpoint.dir``: its ``file:`` path does not tell, so the folder is tried."""

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from palate import session

WORDS = "the quick brown fox jumps over the lazy dog and sleeps".split()


@pytest.fixture
def mounted(spark, tmp_path, monkeypatch):
    """The session as one on a cluster with such a folder, and the folder."""
    session.shared_dir(spark)  # the session keeps checkpoints in its own folder
    known, named = spark.conf.get, f"file://{tmp_path}/shared"
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(spark.conf, "get", lambda key, *default: named if key == "spark.checkpoint.dir" else known(key, *default))
    return named


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    made = str(tmp_path_factory.mktemp("mounted"))
    text = f"concat_ws(' ', slice(split('{' '.join(WORDS * 9)}', ' '), int(id % 7) + 1, 60), id % 5)"
    for name, n, columns in (
            ("lineitem", 60, ("id AS l_orderkey", "id % 11 AS l_partkey", "id % 50 + 1.0D AS l_quantity", "TIMESTAMP_NTZ '1995-01-01' AS l_shipdate")),
            ("orders", 60, ("id AS o_orderkey", "id % 7 AS o_custkey")),
            ("documents", 20, ("id AS doc_id", f"{text} AS text", "'en' AS lang", "concat('s', id % 2) AS source", f"length({text}) AS n_chars")),
            ("benchmark", 1, ("'1' AS item_id", f"'{' '.join(WORDS)}' AS text")),
            ("labels", 10, ("id AS doc_id", "int(id % 2) AS quality", "0 AS toxic")),
            ("embeddings", 20, ("id AS vec_id", "transform(sequence(1, 64), i -> float((i * 7 + id) % 13)) AS embedding"))):
        spark.range(n).selectExpr(*columns).write.parquet(f"{made}/{name}.parquet")
    return made


@pytest.mark.parametrize("name, rows", [
    ("als_factor_counts", 2), ("als_save_load_roundtrip", 1), ("op1_token_counts", 20), ("op3_decontamination", 20), ("op7_token_files", 20),
    ("op9_mixing", 20), ("op10_near_dups", 20), ("op11_ranked_search", 20), ("op12_centroid_clusters", 20), ("op13_nearest_vectors", 10)])
def test_queries_run_with_a_mounted_folder(spark, mounted, tables, name, rows):
    assert entry_point.queries()[name](spark, tables).count() == rows


def test_the_pipeline_runs_with_a_mounted_folder(spark, mounted, tables):
    documents = spark.read.parquet(f"{tables}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["near duplicates"](spark, documents, tables)
    assert kept.columns == documents.columns and 1 <= kept.count() <= 20


def test_a_folder_is_tried_once_and_nothing_is_left(spark, mounted, monkeypatch):
    tried, own = [], session.is_shared
    monkeypatch.setattr(session, "is_shared", lambda *args: tried.append(args) or own(*args))
    assert [session.shared_dir(spark) for _ in range(3)] == [mounted] * 3
    assert tried == [(spark, mounted)] and session.names_in(spark, session.application_dir(spark)) == []


def test_a_folder_in_which_a_file_is_missing_is_refused(spark, mounted, monkeypatch):
    """What one executor wrote is on its own disk."""
    names_in = session.names_in
    monkeypatch.setattr(session, "names_in", lambda *args: [n for n in names_in(*args) if not n.startswith("part-00007")])
    for _ in range(2):
        with pytest.raises(RuntimeError, match="local folder.*does not find"):
            session.shared_dir(spark)


def test_a_folder_that_cannot_be_written_is_refused(spark, mounted, tmp_path):
    (tmp_path / "shared").write_text("a file")
    with pytest.raises(RuntimeError, match="local folder.*could not be tried"):
        session.shared_dir(spark)
