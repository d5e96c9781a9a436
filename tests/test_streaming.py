"""The streaming monthly job gives the batch answer and resumes from its checkpoint."""

from chaintally.plans import binding as B
from chaintally.plans import ledger as L
from chaintally.session import staging_path
from chaintally.streaming.monthly import run_monthly_value_stream

from conftest import SF_SMALL


def test_stream_equals_batch_and_is_incremental(spark):
    lines = B.export_lines(spark, SF_SMALL, "tx_part")
    batch = sorted(L.monthly_value(lines).collect())
    src = staging_path(spark, "stream-src")
    work = staging_path(spark, "stream-work")
    parts = lines.randomSplit([0.5, 0.5], seed=7)
    parts[0].write.text(f"{src}/a")
    first = run_monthly_value_stream(spark, f"{src}/*", work).collect()
    assert sum(r.n for r in first) < sum(r.n for r in batch)
    parts[1].write.text(f"{src}/b")
    second = sorted(run_monthly_value_stream(spark, f"{src}/*", work).collect())
    assert [(r.month, r.n) for r in second] == [(r.month, r.n) for r in batch]
    assert all(abs(a.avg_value - b.avg_value) <= 1e-9 * abs(b.avg_value) for a, b in zip(second, batch))


def test_a_stream_without_input_has_an_empty_result(spark):
    src, work = staging_path(spark, "stream-none"), staging_path(spark, "stream-none-work")
    spark.range(0).selectExpr("cast(id as string) as value").write.text(src)
    empty = run_monthly_value_stream(spark, src, work)
    assert empty.columns == ["month", "n", "avg_value"] and empty.collect() == []
