"""Job entry points, driven in-process with the test session."""

from transferlake import cli
from transferlake.plans.views import Views
from transferlake.session import local_path
from transferlake.sources import landing
from transferlake.sources import tables as tb
from transferlake.streaming import replay as rp
from tests.conftest import SF001


def test_cli_jobs(spark, tmp_dir):
    v = Views(spark, SF001)
    landing.write_landing(v.raw, f"{tmp_dir}/landing")
    out = cli.main(["load-landing", "--landing", f"{tmp_dir}/landing", "--table", f"{tmp_dir}/t",
                    "--dlq", f"{tmp_dir}/dlq", "--load-id", "1", "--replace"], spark)
    assert out["good_rows"] == v.good.count()
    pub = cli.main(["publish", "--landing", f"{tmp_dir}/landing", "--out", f"{tmp_dir}/topic", "--cap", "100"], spark)
    assert pub["published"] == 100
    assert spark.read.text(f"{tmp_dir}/topic").count() == 100
    fields = ["tx_id", "status", "amount", "timestamp", "receiver_id", "currency"]
    rp.write_chunk(v.events, rp.chunk_of(v.events, 1), 0, fields, f"{tmp_dir}/events")
    res = cli.main(["stream-stats", "--events", f"{tmp_dir}/events", "--table", f"{tmp_dir}/t",
                    "--out", f"{tmp_dir}/stats", "--checkpoint", f"{tmp_dir}/ck", "--state-partitions", "2"], spark)
    assert res["batches"] >= 1
    assert spark.read.parquet(f"{tmp_dir}/stats/stats").count() > 0
    again = ["load-landing", "--landing", f"{tmp_dir}/landing", "--table", f"{tmp_dir}/t2", "--dlq", f"{tmp_dir}/dlq2", "--only-new", "--load-id"]
    assert cli.main([*again, "1"], spark)["good_rows"] == v.good.count() and cli.main([*again, "2"], spark)["files"] == 0
    cli.main(["stream-stats", "--events", f"{tmp_dir}/events", "--table", f"{tmp_dir}/t", "--out", f"{tmp_dir}/stats2", "--checkpoint", f"{tmp_dir}/ck2",
              "--state-partitions", "2", "--salt-buckets", "4", "--audit", f"{tmp_dir}/audit"], spark)
    assert spark.read.parquet(f"{tmp_dir}/audit").agg({"events": "sum"}).first()[0] == v.events.count()
    hist = cli.main(["history", "--table", f"{tmp_dir}/t"], spark)
    assert hist["loads"][0]["operation"] == "replace"
    cli.main(["rollback", "--table", f"{tmp_dir}/t", "--to", "1"], spark)
    cli.main(["compact", "--table", f"{tmp_dir}/t"], spark)
    assert tb.read_table(spark, f"{tmp_dir}/t").count() == v.good.count()
    assert local_path(tmp_dir) is not None


def test_stream_jobs_take_kafka_and_serving_options(spark, tmp_dir, monkeypatch):
    """The options reach the source and the sink; no broker or database is started."""
    from transferlake.plans import jobs
    from transferlake.sources import events
    seen = {}
    v = Views(spark, SF001)
    tb.write_load(v.good, f"{tmp_dir}/t", 1, "replace")
    fields = ["tx_id", "status", "amount", "timestamp", "receiver_id", "currency"]
    rp.write_chunk(v.events, rp.chunk_of(v.events, 1), 0, fields, f"{tmp_dir}/events")
    files = events.read_event_stream

    def source(spark_, kind, path=None, options=None, max_per_trigger=None):
        seen.update(kind=kind, options=events.kafka_options(options, max_per_trigger))
        return files(spark_, "files", path=f"{tmp_dir}/events")
    monkeypatch.setattr(events, "read_event_stream", source)
    kafka = ["--source", "kafka", "--source-option", "kafka.bootstrap.servers=h:1", "--source-option", "subscribe=p2p", "--max-per-trigger", "4000"]
    cli.main(["stream-stats", *kafka, "--table", f"{tmp_dir}/t", "--out", f"{tmp_dir}/o", "--checkpoint", f"{tmp_dir}/c1",
              "--serving", f"{tmp_dir}/served", "--serving-format", "json", "--serving-option", "compression=gzip", "--state-partitions", "2"], spark)
    assert seen == {"kind": "kafka", "options": {"startingOffsets": "earliest", "failOnDataLoss": "false", "maxOffsetsPerTrigger": "4000",
                                                 "kafka.bootstrap.servers": "h:1", "subscribe": "p2p"}}
    assert "batch_id" in spark.read.json(f"{tmp_dir}/served").columns
    cli.main(["alerts", *kafka, "--out", f"{tmp_dir}/alerts", "--checkpoint", f"{tmp_dir}/c2", "--threshold", "200"], spark)
    assert spark.read.parquet(f"{tmp_dir}/alerts").count() == v.events.where("amount > 200").count()
    wrote = {}
    monkeypatch.setattr(events, "write_events", lambda df, fmt, path=None, options=None: wrote.update(fmt=fmt, options=options, n=df.count()))
    landing.write_landing(v.raw, f"{tmp_dir}/landing")
    jobs_out = cli._parser().parse_args(["publish", "--landing", "x", "--format", "kafka", "--option", "topic=p2p"])
    assert jobs_out.format == "kafka" and cli._options(jobs_out.option) == {"topic": "p2p"}
    assert jobs.publish_landing(spark, f"{tmp_dir}/landing", fmt="kafka", options={"topic": "p2p"}, cap=10) == 10
    assert wrote["fmt"] == "kafka" and wrote["options"] == {"topic": "p2p"}
