import time

import bench
from palate.operators import als


def test_a_timing_covers_the_action_and_is_rounded():
    result, seconds = bench.timed(lambda: time.sleep(0.05) or "done")
    assert result == "done" and 0.05 <= seconds < 5 and seconds == round(seconds, 3)


def test_every_row_is_consumed(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    bench.consume(spark.range(1000, numPartitions=3).mapInArrow(counted, "id bigint"))
    assert seen.value == 1000


def test_every_stage_of_a_session_is_timed(spark, folder, monkeypatch):
    """Search, fit, lists cold and warm, save and load; quick fits, the shape is what counts."""
    fit = als.fit
    monkeypatch.setattr(als, "fit", lambda *args, **options: fit(*args, **{**options, "max_iter": 1}))
    seconds = bench.stages(spark, folder)
    assert list(seconds) == ["stage_search", "stage_fit", "stage_top_cold", "stage_top_genre_warm", "stage_save", "stage_load"]
    assert all(s > 0 and s == round(s, 3) for s in seconds.values())
