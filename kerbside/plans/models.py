"""Registered queries around the model and the serving table."""

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions.rules import alert_level
from kerbside.operators import kpis as kpi_ops
from kerbside.operators import corrections, layers, moments, scoring, serving, training
from kerbside.plans import batch, feeds, streams
from kerbside.session import workspace
from kerbside.sources.datasets import read_silver
from kerbside.sources.topics import read_message_files
from kerbside.streaming.gold import start_gold, table_sink, windows
from kerbside.streaming.layers import start_moments
from kerbside.streaming.triggers import ONCE

DIGITS = 6


def trained(spark, events, path):
    """Train on the cleaned feeds and save the model at ``path``."""
    model = training.train_on_pairs(*[batch.silver(events, feed) for feed in streams.FEEDS])
    scoring.save(model, path)


def _rounded(rows, *names):
    return rows.withColumns({name: F.round(name, DIGITS) for name in names})


def _line(spark, model):
    return _rounded(
        scoring.coefficients(spark, model),
        "speed_coefficient",
        "vehicle_coefficient",
        "intercept",
    )


def model_coefficients(spark, sf_dir):
    """The training job: cleaned history as a stream wrote it, fitted, saved and loaded."""
    paths = streams.run_silver(spark, sf_dir)
    model = training.train_on_pairs(*[read_silver(spark, paths[f], f) for f in streams.FEEDS])
    path = workspace(spark, "model")
    scoring.save(model, path)
    return _line(spark, scoring.LatestModel(spark, path).get())


def model_incremental(spark, sf_dir):
    """The same model from sums that a stream over the cleaned feeds kept up to date, merged in between."""
    root = workspace(spark, "moments")

    def update(paths):
        for feed in streams.FEEDS:
            start_moments(spark, paths[feed], feed, f"{root}/sums", f"{root}/progress_{feed}", ONCE).awaitTermination()
            moments.merge(spark, f"{root}/sums", feed)

    streams.silver_in_halves(spark, sf_dir, update)
    scoring.save(moments.train(spark, f"{root}/sums"), f"{root}/model")
    return _line(spark, scoring.LatestModel(spark, f"{root}/model").get())


def model_window_coefficients(spark, sf_dir):
    """The model trained on hourly windows in place of event pairs."""
    kpi = batch.kpi(feeds.read_events(spark, sf_dir), "1 hour")
    return _line(spark, training.train_on_windows(kpi))


def kpi_predicted(spark, sf_dir):
    events = feeds.read_events(spark, sf_dir)
    path = workspace(spark, "model")
    trained(spark, events, path)
    return _predicted(spark, events, path)


def kpi_predicted_high(spark, sf_dir):
    """A city with three times the pollution, so that forecasts reach all alert levels."""
    events = feeds.read_events(spark, sf_dir)
    path = workspace(spark, "model")
    traffic, pollution = [batch.silver(events, feed) for feed in streams.FEEDS]
    worse = pollution.withColumn("pm25", F.col("pm25") * 3)
    scoring.save(training.train_on_pairs(traffic, worse), path)
    return _predicted(spark, events, path)


def _predicted(spark, events, path):
    model = scoring.LatestModel(spark, path).get()
    scored = scoring.with_alert_predicted(scoring.score(batch.kpi(events, "1 hour"), model))
    return _rounded(
        scored.select(
            "district",
            batch.ntz("window_end"),
            "avg_pm25",
            "predicted_pm25",
            "alert_level",
            "alert_predicted",
        ),
        "predicted_pm25",
    )


def _serving_log(spark, sf_dir):
    """A serving table of two batches, the second correcting part of the first.

    The correction raises every measured mean by five; windows without a measurement are in
    the first batch only, which is written once more at the end, as a replay.
    """
    path = workspace(spark, "serving")
    kpi = scoring.score(batch.kpi(feeds.read_events(spark, sf_dir), "1 hour"), None)
    kpi.drop("window").write.parquet(f"{path}/kpi")
    first = spark.read.schema(streams.SCORED_WINDOWS).parquet(f"{path}/kpi")
    raised = first.where("has_pm25").withColumn("avg_pm25", F.col("avg_pm25") + 5)
    second = raised.withColumn("alert_level", alert_level(F.col("avg_pm25")))
    for batch_id, rows in ((0, first), (1, second), (0, first)):
        serving.upsert_batch(rows, batch_id, f"{path}/table")
    return f"{path}/table"


def serving_latest(spark, sf_dir):
    rows = serving.newest_first(serving.current(spark, _serving_log(spark, sf_dir)))
    return rows.withColumn("window_end", batch.ntz("window_end"))


def district_series(spark, sf_dir):
    rows = serving.district_series(spark, _serving_log(spark, sf_dir), "Centre")
    return rows.withColumn("window_end", batch.ntz("window_end"))


def gold_serving(spark, sf_dir):
    """The whole gold job: both feeds streamed, windows closed, scored and served."""
    root = workspace(spark, "gold")
    trained(spark, feeds.read_events(spark, sf_dir), f"{root}/model")
    start_gold(
        streams.stream_kpis(spark, sf_dir, "1 hour"),
        table_sink(f"{root}/serving"),
        f"{root}/progress",
        f"{root}/model",
        ONCE,
    ).awaitTermination()
    return _served(spark, f"{root}/serving")


def gold_new_checkpoint(spark, sf_dir):
    """The gold job on one half of the events, then on the other with a checkpoint of its own.

    Both count their batches from zero and write one serving table, which keeps both's windows.
    """
    events, *parts = feeds.halves(spark, sf_dir)
    root = workspace(spark, "checkpoints")
    for number, part in enumerate(parts):
        for feed in streams.FEEDS:
            feeds.messages(events.where(part), feed).write.parquet(f"{root}/{number}/{feed}")
        sources = [read_message_files(spark, f"{root}/{number}/{feed}") for feed in streams.FEEDS]
        sink = table_sink(f"{root}/serving")
        kpi = windows(*sources, width="1 hour")
        start_gold(kpi, sink, f"{root}/progress{number}", None, ONCE).awaitTermination()
    return _served(spark, f"{root}/serving")


def gold_two_runs(spark, sf_dir):
    """The gold job stopped and resumed, with the first model saved in between.

    The first run takes the events up to the day in the middle, the second the rest; windows
    closed by the first carry no prediction.
    """
    return _two_runs(spark, sf_dir, lambda path: None)


def serving_folded(spark, sf_dir):
    """The same, with the table folded after each run; both runs are on one checkpoint."""
    return _two_runs(spark, sf_dir, lambda path: serving.fold(spark, path))


def gold_retrained(spark, sf_dir):
    """The same with a model from the start, replaced between the runs by one of all events."""
    return _two_runs(spark, sf_dir, lambda path: None, first_model=True)


def _two_runs(spark, sf_dir, then, first_model=False):
    events, early, late = feeds.halves(spark, sf_dir)
    root = workspace(spark, "runs")

    def run(part):
        for feed in streams.FEEDS:
            sent = feeds.messages(events.where(part), feed)
            sent.write.mode("append").parquet(f"{root}/{feed}")
        kpi = windows(
            *[read_message_files(spark, f"{root}/{feed}") for feed in streams.FEEDS],
            width="1 hour",
        )
        sink = table_sink(f"{root}/serving")
        start_gold(kpi, sink, f"{root}/progress", f"{root}/model", ONCE).awaitTermination()

    if first_model:
        trained(spark, events.where(early), f"{root}/model")
    run(early)
    then(f"{root}/serving")
    trained(spark, events, f"{root}/model")
    run(late)
    then(f"{root}/serving")
    return _served(spark, f"{root}/serving")


def gold_reloaded(spark, sf_dir):
    """One run of several micro-batches, which takes up a model that is saved between two of them.

    The first batch with closed windows has the model of the early events; when it is served,
    the model of all events is saved, and the windows of the batches after it have that one.
    """
    events, *parts = feeds.halves(spark, sf_dir)
    root = workspace(spark, "reload")
    for part in parts:  # a file for each half, and a micro-batch for each file
        for feed in streams.FEEDS:
            sent = feeds.messages(events.where(part), feed).coalesce(1)
            sent.write.mode("append").parquet(f"{root}/{feed}")
    kpi = windows(
        *[read_message_files(spark, f"{root}/{feed}", maxFilesPerTrigger=1) for feed in streams.FEEDS],
        width="1 hour",
    )
    trained(spark, events.where(parts[0]), f"{root}/model")
    served, table = [], table_sink(f"{root}/serving")

    def sink(rows, batch_id, stream_id):
        table(rows, batch_id, stream_id)
        if not served:
            trained(spark, events, f"{root}/model")
        served.append(batch_id)

    start_gold(kpi, sink, f"{root}/progress", f"{root}/model", ONCE).awaitTermination()
    return _served(spark, f"{root}/serving")


def gold_crashed(spark, sf_dir):
    """The gold job that ends between the write of a batch and its commit, and is started again."""
    root = workspace(spark, "crash")
    trained(spark, feeds.read_events(spark, sf_dir), f"{root}/model")
    table = table_sink(f"{root}/serving")

    def run(sink):
        kpi = streams.stream_kpis(spark, sf_dir, "1 hour")
        start_gold(kpi, sink, f"{root}/progress", f"{root}/model", ONCE).awaitTermination()

    def failing(rows, batch_id, stream_id):
        table(rows, batch_id, stream_id)
        raise InterruptedError("after the write, before the commit")

    try:
        run(failing)
    except StreamingQueryException:
        run(table_sink(f"{root}/serving"))
    return _served(spark, f"{root}/serving")


def late_corrected(spark, sf_dir):
    """Events that come after their windows have closed, and the table once it is corrected by the history.

    The first run sees all event types but two, the second only those two.
    """
    events = feeds.read_events(spark, sf_dir)
    overdue = F.col("event_type").isin("error", "signup")
    root = workspace(spark, "corrected")
    for part in (~overdue, overdue):
        for feed in streams.FEEDS:
            feeds.messages(events.where(part), feed).write.mode("append").parquet(f"{root}/{feed}")
        sent = [read_message_files(spark, f"{root}/{feed}") for feed in streams.FEEDS]
        kpi = windows(*sent, width="1 hour")
        start_gold(kpi, table_sink(f"{root}/serving"), f"{root}/progress", None, ONCE).awaitTermination()
    sides = [batch.silver(events, feed) for feed in streams.FEEDS]
    corrections.correct(spark, *sides, f"{root}/serving", width="1 hour")
    return _served(spark, f"{root}/serving")


def gaps_served(spark, sf_dir):
    """Feeds with missing districts, measures and times: trained on, scored and served."""
    events = feeds.read_events(spark, sf_dir)
    root = workspace(spark, "gaps")
    sides = [
        layers.to_silver(feeds.messages_with_gaps(events, feed), schema)
        for feed, schema in schemas.PAYLOADS.items()
    ]
    scoring.save(training.train_on_pairs(*sides), f"{root}/model")
    model = scoring.LatestModel(spark, f"{root}/model").get()
    scored = scoring.score(kpi_ops.kpis(kpi_ops.unify(*sides), "1 hour"), model)
    serving.upsert_batch(scoring.with_alert_predicted(scored), 0, f"{root}/serving")
    return _served(spark, f"{root}/serving")


def _served(spark, path):
    rows = serving.current(spark, path)
    return _rounded(rows.withColumn("window_end", batch.ntz("window_end")), "predicted_pm25")
