"""The reference's streaming scenario and pure option builders."""
import os
import time

from pyspark.sql import functions as F

from tillroll.session import scratch_path
from tillroll.streaming import job as SP

NOW = "2024-01-10T12:00:00"
OLD = "2024-01-10T07:00:00"  # five hours earlier


def _ev(tid, region, amount, ts):
    return ('{"transaction_id":"%s","customer_id":"C1","region":"%s","store_id":"S1","amount":%s,'
            '"status":"COMPLETED","event_time":"%s"}' % (tid, region, amount, ts))


def test_dedup_watermark_dlq_across_restart(spark):
    inbox = scratch_path(spark, "t-stream-in")
    out = scratch_path(spark, "t-stream-out")
    local = inbox.replace("file:", "")
    os.makedirs(local)
    with open(f"{local}/batch1.json", "w") as fh:
        fh.write("\n".join([_ev("T1", "north", "100.0", NOW), _ev("T2", "south", "200.0", NOW), "not json at all"]) + "\n")
    run = SP.start(spark, SP.read_source(spark, "files", inbox, SP.file_options()), out)
    SP.await_all(run)
    time.sleep(1.1)
    with open(f"{local}/batch2.json", "w") as fh:
        fh.write("\n".join([_ev("T1", "north", "100.0", NOW), _ev("T3_VERY_LATE", "east", "300.0", OLD),
                            _ev("T4", "west", "400.0", NOW)]) + "\n")
    run = SP.start(spark, SP.read_source(spark, "files", inbox, SP.file_options()), out)
    SP.await_all(run)
    ids = sorted(r[0] for r in spark.read.parquet(run.clean_path).select("transaction_id").collect())
    assert ids == ["T1", "T2", "T4"]
    dlq = [r[0] for r in spark.read.parquet(run.dlq_path).select("error_reason").collect()]
    assert dlq == ["malformed_json"]


def test_option_builders():
    k = SP.kafka_options("b:9098", "topic", 500)
    assert k["maxOffsetsPerTrigger"] == "500" and k["failOnDataLoss"] == "false"
    assert k["kafka.sasl.mechanism"] == "AWS_MSK_IAM" and k["startingOffsets"] == "latest"
    assert "kafka.sasl.mechanism" not in SP.kafka_options("b", "t", iam_auth=False)
    kin = SP.kinesis_options("s", "ap-south-1", 10)
    assert kin["endpointUrl"] == "https://kinesis.ap-south-1.amazonaws.com"
    assert kin["kinesis.executor.maxFetchRecordsPerShard"] == "10"
    assert SP.file_options(5) == {"maxFilesPerTrigger": "5"}
    sink = SP.kafka_sink_options("b:9098", "out")
    assert sink["topic"] == "out" and "subscribe" not in sink and sink["kafka.bootstrap.servers"] == "b:9098"


def test_cli_stream_once(spark):
    """The command line runs the file-source pipeline once."""
    from tillroll.__main__ import main

    inbox = scratch_path(spark, "t-cli-in")
    out = scratch_path(spark, "t-cli-out")
    local = inbox.replace("file:", "")
    os.makedirs(local)
    with open(f"{local}/b.json", "w") as fh:
        fh.write(_ev("T9", "north", "10.0", NOW) + "\n")
    assert main(["stream", "--source", "files", "--input", inbox, "--output", out, "--once"]) == 0
    assert [r[0] for r in spark.read.parquet(f"{out}/processed/transactions_stream").select("transaction_id").collect()] == ["T9"]


def test_status_normalisation_is_optional(spark):
    """D20: status stays as sent by default; the batch rule is available."""
    raw = spark.createDataFrame([(_ev("T5", "north", "1.0", NOW).replace("COMPLETED", " completed"),)], "raw string")
    parsed = SP.parse(raw, stamp=False).withColumn("ingest_time", F.current_timestamp())
    as_sent = SP.valid_events(parsed).select("status").first()[0]
    batch_like = SP.valid_events(parsed, normalise_status=True).select("status").first()[0]
    assert (as_sent, batch_like) == (" completed", "COMPLETED")


def test_compaction_of_a_stream_table_and_complete_progress(spark):
    """The sink's files stay readable; the compacted copy has the same rows in
    one file a day; progress counts every payload of every query."""
    import pytest

    from tillroll.operators.lake import compact, compact_stream, file_report

    inbox, out = scratch_path(spark, "t-compact-in"), scratch_path(spark, "t-compact-out")
    local = inbox.replace("file:", "")
    os.makedirs(local)
    for i in range(4):
        with open(f"{local}/b{i}.json", "w") as fh:
            fh.write("\n".join(_ev(f"T{i}{j}", "north", "1.0", NOW) for j in range(3)) + "\n")
    run = SP.start(spark, SP.read_source(spark, "files", inbox, SP.file_options(1)), out)
    SP.await_all(run)
    with pytest.raises(ValueError, match="compact_stream"):
        compact(spark, run.clean_path, ["event_date"], {})
    copy = compact_stream(spark, run.clean_path, f"{out}/clean_compacted", ["event_date"])
    before = spark.read.parquet(run.clean_path)
    assert before.count() == copy.count() == 12
    assert file_report(spark, f"{out}/clean_compacted", ["event_date"]).first()["n_files"] == 1
    read = {}
    for r in SP.progress(spark, out, SP.file_rows(spark, "text", inbox)).collect():
        read.setdefault(r.query_name, []).append((r.batch_id, r.num_input_rows))
    assert {q: sorted(b) for q, b in read.items()} == {"dlq": [(i, 3) for i in range(4)], "clean": [(i, 3) for i in range(4)], "agg": [(0, 12)]}


def test_one_deduplication_state(spark):
    """Only the clean table's query keeps ids as state; the totals keep windows."""
    inbox, out = scratch_path(spark, "t-state-in"), scratch_path(spark, "t-state-out")
    local = inbox.replace("file:", "")
    os.makedirs(local)
    with open(f"{local}/b.json", "w") as fh:
        fh.write("\n".join([_ev("T1", "north", "1.0", OLD), _ev("T1", "north", "1.0", OLD), _ev("T2", "north", "2.0", OLD), _ev("T3", "east", "4.0", NOW)]) + "\n")
    run = SP.start(spark, SP.read_source(spark, "files", inbox), out)
    SP.await_all(run)
    root = f"{out}/_checkpoints/transactions_stream".replace("file:", "")
    operators = {name: sorted(os.listdir(f"{root}/{name}/state")) if os.path.isdir(f"{root}/{name}/state") else [] for name in ("dlq", "clean", "agg")}
    assert operators == {"dlq": [], "clean": ["0"], "agg": ["0"]}
    plan = {q.name: q._jsq.explainInternal(False) if hasattr(q._jsq, "explainInternal") else "" for q in run.queries}
    assert "Dedup" not in plan["agg"] and "Dedup" not in plan["dlq"]
    sums = [tuple(r) for r in spark.read.parquet(run.agg_path).select("region", "txn_count", "total_sales").collect()]
    assert [(r, n, float(t)) for r, n, t in sums] == [("NORTH", 2, 3.0)]


def test_progress_of_more_than_a_hundred_batches_and_a_restart(spark):
    """The checkpoints tell every batch, also beyond what Spark lists; the
    progress table is appended to and never counts a batch twice."""
    inbox, out = scratch_path(spark, "t-many-in"), scratch_path(spark, "t-many-out")
    local = inbox.replace("file:", "")
    os.makedirs(local)

    def arrive(first, last):
        for i in range(first, last):
            with open(f"{local}/b{i:03d}.json", "w") as fh:
                fh.write("\n".join("not json" for _ in range(1 + i % 3)) + "\n")
            os.utime(f"{local}/b{i:03d}.json", (1_600_000_000 + i,) * 2)

    def dlq_only():
        parsed = SP.parse(SP.read_source(spark, "files", inbox, SP.file_options(1)))
        SP._ended(SP._start_sink(SP.dlq(parsed), out, SP.DLQ, once=True))
        return SP.record_progress(spark, out, SP.file_rows(spark, "text", inbox))

    arrive(0, 105)
    first = dlq_only()
    assert [tuple(r) for r in first.orderBy("batch_id").collect()] == [("dlq", i, 1 + i % 3) for i in range(105)]
    arrive(105, 107)
    assert [tuple(r) for r in dlq_only().orderBy("batch_id").collect()] == [("dlq", i, 1 + i % 3) for i in range(107)]
    for i in range(107):  # the sources may go, the table stays
        os.remove(f"{local}/b{i:03d}.json")
    assert spark.read.parquet(f"{out}/progress/transactions_stream").count() == 107
