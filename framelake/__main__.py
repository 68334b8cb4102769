"""python -m framelake convert|topics|files: the engine from a shell."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession


def show(df: DataFrame, form: str) -> None:
    """Rows as a table, JSON lines or CSV; they come in turn, and all of them."""
    rows = (r.asDict(recursive=True) for r in df.toLocalIterator())
    if form == "json":
        for r in rows:
            print(json.dumps(r, default=str))
    elif form == "csv":
        import csv

        out = csv.DictWriter(sys.stdout, df.columns)
        out.writeheader()
        out.writerows(rows)
    else:
        print(" | ".join(df.columns))
        for r in rows:
            print(" | ".join(map(str, r.values())))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="framelake")
    p.add_argument("--output", choices=("table", "json", "csv"), default="table")
    sub = p.add_subparsers(dest="what", required=True)
    c = sub.add_parser("convert", help="recordings to a dataset directory")
    c.add_argument("source")
    c.add_argument("target")
    c.add_argument("--config", required=True)
    c.add_argument("--task", help="what the recorded robot does")
    for name in ("topics", "files"):
        sub.add_parser(name).add_argument("source")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("framelake").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    from framelake.operators.metadata import topic_metadata
    from framelake.plans.convert import convert, messages_of
    from framelake.sources import splits
    from framelake.sources.config import from_toml
    from framelake.sources.recordings import kind_of, read_messages, read_recordings
    from framelake.sources.sidecars import list_files

    if a.what == "files":
        return show(list_files(spark, a.source).orderBy("path"), a.output)
    if kind_of(a.source) == "rrd":
        p.error("rrd recordings can't be read")
    whole = not splits.ranged(a.source)  # a store that only Spark's reader opens: files of up to 2 GB
    if a.what == "topics":
        messages = read_recordings(spark, a.source) if whole else splits.read_splits(spark, a.source)
        return show(topic_metadata(messages, ["topic", "type"]).orderBy("topic"), a.output)
    with open(a.config) as f:
        config = from_toml(f.read())
    topics = [m.topic for m in config.mappings] or None  # only chunks that have them are read
    rows, infos = messages_of(read_messages(spark, a.source, topics) if whole else splits.read_splits(spark, a.source, topics, typed=True))
    report = convert(spark, rows, a.target, config, ["source"], task=a.task, infos=infos)
    show(spark.createDataFrame([tuple(report.values())], list(report)), a.output)


if __name__ == "__main__":
    main()
