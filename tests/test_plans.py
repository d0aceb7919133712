"""Plan-shape guard: only queries whose single-partition step runs on a
bounded input (a global aggregate after partial aggregation, per-batch /
per-classifier / per-slice tables, a fixed grid) may contain one."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
BOUNDED_SINGLE_PARTITION = {
    "table_bounds",            # global min/max after partial aggregation
    "classifier_dim",          # rank over the distinct classifier identities
    "load_totals", "cumulative_counts",      # running sums over one row per batch
    "simulation_ids",          # offsets over one row per partition
    "luminosity_distance", "redshift_from_distance",   # a tabulated cosmology
}
WRITES_FIXTURES = {"read_fits_lightcurves", "read_alert_archive", "convert_to_parquet", "stream_nightly_counts",
                   "stream_dedupe", "stream_ingest_alert_ids", "stream_classify", "stream_detections",
                   "replay_nights", "ack_sent", "stream_restart", "batch_handler", "stream_progress_observed", "message_latency_tail"}


def test_no_unbounded_single_partition_steps(spark):
    bad = []
    for name, fn in E.queries().items():
        if name in WRITES_FIXTURES:
            continue
        plan = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
        if "SinglePartition" in plan and name not in BOUNDED_SINGLE_PARTITION:
            bad.append(name)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    assert bad == []
