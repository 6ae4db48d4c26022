"""The three service queries as one job::

    spark-submit ... -m editstream.service --source files --path RECORDS --rate 200 --root TABLES
    spark-submit ... -m editstream.service --source kafka --bootstrap HOST --topic TOPIC --rate 50000 --root TABLES

``--rate`` is required: files, or records, that a trigger admits at most. The
job runs until a query ends; a failure ends all and is raised.
"""

from __future__ import annotations

import argparse

from .session import build_session
from .sources import dims
from .streaming import runner
from .streaming.sources import edit_stream


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--source", choices=("files", "kafka"), required=True)
    p.add_argument("--path")
    p.add_argument("--bootstrap")
    p.add_argument("--topic")
    p.add_argument("--rate", type=int, required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--dimension", help="JSON Lines file of the language dimension; the bundled one if not given")
    p.add_argument("--partitions", type=int, help="state partitions, fixed for the life of the checkpoints")
    p.add_argument("--trigger", help="one trigger for all queries; their own if not given")
    a = p.parse_args(argv)
    spark = build_session()
    options = ({"path": a.path, "max_files": a.rate} if a.source == "files" else
               {"bootstrap": a.bootstrap, "topic": a.topic, "max_records_per_trigger": a.rate})
    edits = edit_stream(spark, a.source, **options)
    queries = runner.start_all(spark, edits, dims.language_dim(spark, a.dimension), a.root.rstrip("/"),
                               trigger=a.trigger, partitions=a.partitions)
    runner.serve(spark, queries)


if __name__ == "__main__":
    main()
