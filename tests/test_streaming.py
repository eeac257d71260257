"""The streaming load step equals the batch quality cascade, and replays are idempotent."""


from conftest import SF001
from tripgauge.plans.catalog import RAW_CSV_SCHEMA, _raw_csv
from tripgauge.plans.evaluation import evaluation_for
from tripgauge.session import stage_path
from tripgauge.streaming.ingest import read_stream_output, start_clean_trips_stream


def test_stream_matches_batch(spark):
    ev = evaluation_for(spark, SF001)
    src = _raw_csv(spark, SF001)
    sink, ckpt = stage_path(spark, "sink"), stage_path(spark, "ckpt")
    q = start_clean_trips_stream(spark, src, RAW_CSV_SCHEMA, sink, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    clean, rejects = read_stream_output(spark, sink)
    assert clean.count() == ev.clean.count()
    batch = {r["reject_reason"]: r["count"] for r in ev.labelled.groupBy("reject_reason").count().collect()}
    assert {r["reject_reason"]: r["n"] for r in rejects.collect()} == batch
    assert sorted(r[0] for r in clean.select("event_id").collect()) == \
        sorted(r[0] for r in ev.clean.select("event_id").collect())
    # restarting on the same checkpoint processes nothing new and duplicates nothing
    q2 = start_clean_trips_stream(spark, src, RAW_CSV_SCHEMA, sink, ckpt, max_files_per_trigger=1)
    q2.awaitTermination()
    assert read_stream_output(spark, sink)[0].count() == ev.clean.count()
