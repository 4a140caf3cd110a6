"""Incremental trusted API job: only new raw folders are processed, once."""

import datetime

from reelstack.layout import Layout
from reelstack.plans.jobs import trusted_api
from reelstack.schemas import API_RAW
from reelstack.session import scratch_path
from reelstack.streaming import run_trusted_api_stream

from .conftest import rows


def _raw(spark, ids):
    data = [(2005, 14, i, f"t{i}", "2005-01-01", 1.0, 7.0, 30 + i, False, 10 * i,
             f"tt{i}", 70 + 3 * i, 5 * i) for i in ids]
    return spark.createDataFrame(data, API_RAW)


def test_stream_processes_new_days_exactly_once(spark):
    layout = Layout(scratch_path(spark, "lake"))
    out, ckpt = layout.trusted_api, scratch_path(spark, "stream_ckpt")
    _raw(spark, range(1, 8)).write.json(layout.raw_api("2024-04-11"))
    q = run_trusted_api_stream(spark, layout.raw_api_root, out, ckpt)
    q.awaitTermination()
    first = spark.read.parquet(out)
    assert rows(first, "imdb_id", "dt") == [(f"tt{i}", datetime.date(2024, 4, 11))
                                            for i in (4, 5, 6, 7)]
    _raw(spark, range(8, 12)).write.json(layout.raw_api("2024-04-12"))
    q = run_trusted_api_stream(spark, layout.raw_api_root, out, ckpt)
    q.awaitTermination()
    both = spark.read.parquet(out)
    assert both.count() == 8 and both.select("imdb_id").distinct().count() == 8
    day2 = both.filter("dt = DATE'2024-04-12'")
    batch = trusted_api(_raw(spark, range(8, 12)))
    cols = [c for c in batch.columns if c != "data_coleta_tmdb"]
    assert rows(day2, *cols) == rows(batch, *cols)
    assert {r.data_coleta_tmdb for r in day2.collect()} == {"2024/04/12"}
