"""Command line entry points: ``spark-submit run_job.py JOB ...``.

Each job is one of the functions of this package with its sources and sinks attached.
Streaming jobs run until one of their queries ends, or over what is there with ``--once``.
"""

import argparse

from kerbside import schemas, session
from kerbside.operators import corrections, history, kpis, moments, packing, scoring, serving, training
from kerbside.sources.datasets import read_silver
from kerbside.sources.topics import read_message_files, read_topic
from kerbside.streaming import gold, layers
from kerbside.streaming.carry import carry, windows_from
from kerbside.streaming.triggers import ONCE, wait

FEEDS = list(schemas.PAYLOADS)


def _options(pairs):
    return dict(pair.split("=", 1) for pair in pairs)


def _messages(spark, args, feed):
    where, options = getattr(args, feed), _options(args.source_option)
    if args.source == "kafka":
        return read_topic(spark, where, args.servers, args.starting_offsets, **options)
    return read_message_files(spark, where, args.source, **options)


def _every(args):
    return ONCE if args.once else args.every


def bronze(spark, args):
    return [
        layers.start_bronze(
            _messages(spark, args, feed),
            f"{args.output}/{feed}",
            f"{args.checkpoint}/{feed}",
            _every(args),
            f"bronze_{feed}",
        )
        for feed in FEEDS
    ]


def silver(spark, args):
    queries = []
    for feed, schema in schemas.PAYLOADS.items():
        queries.append(
            layers.start_silver(
                _messages(spark, args, feed),
                schema,
                f"{args.output}/{feed}",
                f"{args.checkpoint}/{feed}",
                _every(args),
                f"silver_{feed}",
                f"silver_{feed}",
                args.by_day,
            )
        )
        queries.append(
            layers.start_rejects(
                _messages(spark, args, feed),
                schema,
                f"{args.rejects or args.output + '_rejects'}/{feed}",
                f"{args.checkpoint}/rejects_{feed}",
                ONCE if args.once else args.rejects_every,
                f"rejects_{feed}",
            )
        )
    return queries


def run_gold(spark, args):
    messages = [_messages(spark, args, feed) for feed in FEEDS]
    if args.carried:
        rows = windows_from(args.carried, *messages, args.width, args.watermark, "gold")
    else:
        rows = gold.windows(*messages, args.width, args.watermark, args.watermark_per_feed, "gold", args.idle)
    if args.store:
        sink = gold.store_sink(args.store, **_options(args.store_option))
    else:
        sink = gold.table_sink(args.serving)
    return [gold.start_gold(rows, sink, args.checkpoint, args.model, _every(args), "gold")]


def carry_windows(spark, args):
    for position in carry(spark, args.checkpoint, args.output, args.watermark):
        print(position)


def train(spark, args):
    if args.train_on == "moments":
        model = moments.train(spark, args.moments, args.min_rows)
        return _save(model, args)
    traffic, pollution = [_history(spark, args, feed) for feed in FEEDS]
    if args.train_on == "pairs":
        model = training.train_on_pairs(traffic, pollution, args.min_rows)
    else:
        windows = kpis.kpis(kpis.unify(traffic, pollution), args.width)
        model = training.train_on_windows(windows, args.min_rows)
    return _save(model, args)


def _history(spark, args, feed):
    if args.packed:
        return packing.read_history(spark, f"{args.silver}/{feed}", f"{args.packed}/{feed}", feed)
    return read_silver(spark, f"{args.silver}/{feed}", feed)


def _save(model, args):
    if model is None:
        print(f"No model: fewer than {args.min_rows} training rows.")
        return None
    scoring.save(model, args.model)
    print(f"Model saved to {args.model}.")
    return model


def _result(rows, args):
    """The whole result, written by the executors, or a preview of its first rows."""
    if args.output:
        rows.write.format(args.format).mode("overwrite").save(args.output)
    else:
        print(f"First {args.rows} rows; --output writes all.")
        rows.show(args.rows, truncate=False)
    return rows


def series(spark, args):
    return _result(serving.district_series(spark, args.serving, args.district, args.since), args)


def query(spark, args):
    packed = {feed: f"{args.packed}/{feed}" for feed in FEEDS} if args.packed else None
    history.register(spark, {feed: f"{args.silver}/{feed}" for feed in FEEDS}, packed)
    return _result(spark.sql(args.sql), args)


def pack(spark, args):
    for feed in FEEDS:
        taken = packing.pack(spark, f"{args.silver}/{feed}", f"{args.output}/{feed}", feed, args.rows_per_file, args.before)
        print(f"{feed}: {taken} files packed.")


def run_moments(spark, args):
    queries = [
        layers.start_moments(spark, f"{args.silver}/{feed}", feed, args.output, f"{args.checkpoint}/moments_{feed}", _every(args), f"moments_{feed}")
        for feed in FEEDS
    ]
    if args.once:
        wait(spark, *queries)
        for feed in FEEDS:
            moments.merge(spark, args.output, feed)
    return queries


def correct(spark, args):
    traffic, pollution = [_history(spark, args, feed) for feed in FEEDS]
    model = scoring.LatestModel(spark, args.model).get() if args.model else None
    count = corrections.correct(spark, traffic, pollution, args.serving, model, args.width, args.since)
    print(f"{count} windows corrected.")


def fold(spark, args):
    serving.fold(spark, args.serving, args.before)
    serving.clean(spark, args.serving, args.keep_hours)


def _stream_arguments(parser, every):
    parser.add_argument("--source", default="kafka", help="kafka, or a file format")
    parser.add_argument("--servers", help="broker addresses")
    parser.add_argument("--traffic", default="traffic-raw", help="topic or folder")
    parser.add_argument("--pollution", default="pollution-raw", help="topic or folder")
    parser.add_argument("--starting-offsets", default="earliest")
    parser.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--every", default=every)
    parser.add_argument("--once", action="store_true")


def _result_arguments(parser):
    parser.add_argument("--output", help="folder for the whole result")
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--rows", type=int, default=20, help="rows to print without --output")


def _parser():
    parser = argparse.ArgumentParser(prog="kerbside")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("bronze", help="keep raw messages, by ingestion day")
    _stream_arguments(job, "10 seconds")
    job.add_argument("--output", required=True)
    job.set_defaults(run=bronze, streaming=True)

    job = jobs.add_parser("silver", help="clean and type messages, by district")
    _stream_arguments(job, "10 seconds")
    job.add_argument("--output", required=True)
    job.add_argument("--rejects", help="folder for unreadable messages (default: OUTPUT_rejects)")
    job.add_argument("--rejects-every", default="10 minutes")
    job.add_argument("--by-day", action="store_true")
    job.set_defaults(run=silver, streaming=True)

    job = jobs.add_parser("gold", help="KPIs, alerts and predictions to the serving table")
    _stream_arguments(job, "30 seconds")
    job.add_argument("--width", default="1 minute")
    job.add_argument("--watermark", default="1 minute")
    clock = job.add_mutually_exclusive_group()
    clock.add_argument("--watermark-per-feed", action="store_true")
    clock.add_argument("--carried", help="open windows of a stopped gold job, from the job carry")
    job.add_argument("--idle", help="how far behind a feed may be before windows close without it")
    job.add_argument("--model")
    sink = job.add_mutually_exclusive_group(required=True)
    sink.add_argument("--serving", help="folder of the serving table")
    sink.add_argument("--store", help="format of an external keyed store")
    job.add_argument("--store-option", action="append", default=[], metavar="KEY=VALUE")
    job.set_defaults(run=run_gold, streaming=True)

    job = jobs.add_parser("carry", help="open windows of a stopped gold job, for one with another checkpoint")
    job.add_argument("--checkpoint", required=True, help="of the stopped job")
    job.add_argument("--watermark", default="1 minute", help="of the stopped job")
    job.add_argument("--output", required=True)
    job.set_defaults(run=carry_windows, streaming=False)

    job = jobs.add_parser("moments", help="keep the sums that training takes up to date")
    job.add_argument("--silver", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--every", default="1 minute")
    job.add_argument("--once", action="store_true", help="take what is there, merge the sums and stop")
    job.set_defaults(run=run_moments, streaming=True)

    job = jobs.add_parser("train", help="fit the PM2.5 model on cleaned history")
    job.add_argument("--silver")
    job.add_argument("--packed", help="folder of packed history, which counts with the live one")
    job.add_argument("--moments", help="folder of the sums, for --train-on moments")
    job.add_argument("--model", required=True)
    job.add_argument("--train-on", choices=["pairs", "windows", "moments"], default="pairs")
    job.add_argument("--width", default="1 minute")
    job.add_argument("--min-rows", type=int, default=training.MIN_ROWS)
    job.set_defaults(run=train, streaming=False)

    job = jobs.add_parser("series", help="observed and predicted PM2.5 of a district")
    job.add_argument("--serving", required=True)
    job.add_argument("--district", required=True)
    job.add_argument("--since", help="first UTC day (yyyy-MM-dd)")
    _result_arguments(job)
    job.set_defaults(run=series, streaming=False)

    job = jobs.add_parser("history", help="SQL over silver_traffic and silver_pollution")
    job.add_argument("--silver", required=True)
    job.add_argument("--packed", help="folder of packed history, which counts with the live one")
    job.add_argument("--sql", required=True)
    _result_arguments(job)
    job.set_defaults(run=query, streaming=False)

    job = jobs.add_parser("pack", help="add what a stream has written since to the packed history")
    job.add_argument("--silver", required=True)
    job.add_argument("--output", required=True)
    job.add_argument("--before", help="only files of earlier UTC days (yyyy-MM-dd)")
    job.add_argument("--rows-per-file", type=int, default=5_000_000)
    job.set_defaults(run=pack, streaming=False)

    job = jobs.add_parser("correct", help="bring served windows up to date with events that came late")
    job.add_argument("--silver", required=True)
    job.add_argument("--packed", help="folder of packed history, which counts with the live one")
    job.add_argument("--serving", required=True)
    job.add_argument("--model")
    job.add_argument("--width", default="1 minute")
    job.add_argument("--since", help="first UTC day (yyyy-MM-dd)")
    job.set_defaults(run=correct, streaming=False)

    job = jobs.add_parser("fold", help="gather closed days of the serving table into its base")
    job.add_argument("--serving", required=True)
    job.add_argument("--before", help="only windows before this UTC day (yyyy-MM-dd)")
    job.add_argument("--keep-hours", type=float, default=serving.KEPT_HOURS, help="how long files of earlier lists stay for readers")
    job.set_defaults(run=fold, streaming=False)
    return parser


def main(argv=None, spark=None):
    args = _parser().parse_args(argv)
    if args.job == "train" and not (args.moments if args.train_on == "moments" else args.silver):
        raise SystemExit("training takes --silver, or --moments with --train-on moments")
    if args.job in ("bronze", "silver", "gold") and args.source == "kafka" and not args.servers:
        raise SystemExit("--servers is needed to read topics")
    spark = session.use_utc(spark or session.build(f"kerbside {args.job}"))
    # Streams this session ran earlier do not count as this job's.
    spark.streams.resetTerminated()
    result = args.run(spark, args)
    if args.streaming:
        wait(spark, *(result if args.once else []))
    return result
