import pytest

from millrace.plans import jobs
from millrace.streaming import stream_to_parquet


@pytest.fixture
def params(spark):
    """Set job parameters for one test."""
    names = []

    def set_params(**values):
        for name, value in values.items():
            names.append(f"spark.app.{name}")
            spark.conf.set(names[-1], str(value))

    yield set_params
    for name in names:
        spark.conf.unset(name)


def test_average_rating(spark, params, tmp_path):
    (tmp_path / "ratings").write_text("1::1::4.0::0\n2::1::5.0::0\n")
    params(ratings_path=tmp_path / "ratings", output_path=tmp_path / "out")
    assert jobs.average_rating(spark).collect() == [(4.5,)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_ratings_report(spark, params, tmp_path):
    lines = [f"{user}\t{item}\t{item % 5}\t0" for item in range(1, 30) for user in range(item * 10)]
    (tmp_path / "ratings").write_text("\n".join(lines))
    (tmp_path / "movies").write_text("".join(f"{i}|Title {i}|01-Jan-1995|x\n" for i in range(30)))
    params(ratings_path=tmp_path / "ratings", movies_path=tmp_path / "movies")
    every = [14, 19, 24, 29, 13, 18, 23, 28, 12, 17, 22, 27, 11, 16, 21, 26, 15, 20, 25]
    assert [row.item_id for row in jobs.ratings_report(spark).collect()] == every
    params(output_path=tmp_path / "out")
    jobs.run(spark, "ratings_report")
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(every)
    params(output_path="", top=10)
    report = jobs.ratings_report(spark).collect()
    assert [row.item_id for row in report] == every[:10]
    assert report[0] == (14, 140, 4.0, 14, "Title 14")


def test_movies_by_date(spark, params, tmp_path, capsys):
    (tmp_path / "movies").write_text("1|a|01-Jan-1995|\n2|b|02-Jan-1995\n3|c|\n")
    params(movies_path=tmp_path / "movies", output_path=tmp_path / "out")
    jobs.run(spark, "movies_by_date")
    assert spark.read.parquet(str(tmp_path / "out")).where("date = '1995-01-02'").count() == 1


def test_nested_field(spark, params, tmp_path):
    (tmp_path / "docs").write_text('{"attributes": {"AgesAllowed": "all"}}\n{"attributes": null}\n')
    params(json_path=tmp_path / "docs")
    assert [row.attributes_AgesAllowed for row in jobs.nested_field(spark).collect()] == ["all"]


@pytest.fixture
def broker(monkeypatch):
    """Messages and a sink in place of a broker."""
    sent = []

    def use(messages):
        monkeypatch.setattr(jobs, "kafka_source", lambda spark, *settings: messages)
        monkeypatch.setattr(jobs, "kafka_sink", lambda df, *settings: sent.append((df, settings)))
        return sent
    return use


def test_stream_jobs(spark, params, broker, tmp_path, monkeypatch):
    triggers = []

    def until_all_is_read(df, path, checkpoint, partition_by=None, trigger=None, **options):
        triggers.append(trigger)
        return stream_to_parquet(df, path, checkpoint, partition_by, {"availableNow": True})

    monkeypatch.setattr(jobs, "stream_to_parquet", until_all_is_read)
    inbox = str(tmp_path / "inbox")
    message = ('{"page_title": "p", "event_time": "2024-01-01T00:%s:00Z", "namespace": 0, '
               '"bot": false, "event_type": "edit", "minor": true}')
    spark.createDataFrame(
        [(None, message % minute) for minute in ("00", "30")], "key string, value string"
    ).write.parquet(inbox)
    broker(spark.readStream.schema("key string, value string").parquet(inbox))
    for name, columns in (
        ("page_counts", {"window", "page_title", "count"}),
        ("article_counts", {"window_start", "window_end", "page_title", "edit_count",
                            "minor_edits", "major_edits"}),
    ):
        params(kafka_bootstrap_servers="b:1", kafka_topic="t", output_path=tmp_path / name,
               checkpoint_dir=tmp_path / f"{name}_checkpoint")
        jobs.run(spark, name)
        params(order_by="window.start,count" if name == "page_counts" else "window_start,edit_count")
        latest = jobs.latest_counts(spark)
        assert set(latest.columns) == columns and latest.count() == 1
    assert triggers == [None, {"processingTime": "1 minute"}]


def test_feed_messages(spark, params, broker, tmp_path):
    (tmp_path / "feed").mkdir()
    (tmp_path / "feed" / "a.txt").write_text('data: {"id": 1}\n\ndata: {"id": 2}\n\n')
    sent = broker(None)
    params(feed_path=tmp_path / "feed", kafka_bootstrap_servers="b:1", kafka_topic="t")
    jobs.feed_messages(spark)
    params(checkpoint_dir=tmp_path / "checkpoint")
    running = jobs.feed_messages(spark)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    assert len(sent) == 2
    for batch, settings in sent:
        assert sorted(row.key for row in batch.collect()) == ["1", "2"]
        assert settings == ("b:1", "t")
