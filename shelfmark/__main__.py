"""Submit a job: `python -m shelfmark COMMAND --bronze-dir ... --as-of ... [--engine ...] [--queries FILE]`.

    land     land the pages of a request log     silver   refine landed pages
    stream   refine page files not seen before   gold     bring the vector store up to date
    rebuild  divide a grown store anew           index    build codes or graphs beside the store
    search   top entries for a query file        pacing   check the pauses of a request log
    all      everything, with both reports
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .config import from_args
from .operators.topk import STRATEGIES
from .plans.full_run import run_all
from .plans.gold_job import rebuild_index, run_gold, run_search
from .plans.index_job import KINDS, build_index, search_index
from .plans.landing_job import audit_pacing, run_landing
from .plans.silver_job import run_silver
from .streaming.incremental import start_incremental

# Commands and the options they cannot do without.
COMMANDS = {"land": ("attempts",), "silver": (), "stream": (), "gold": (), "rebuild": (), "index": ("index",),
            "search": ("queries", "out"), "pacing": ("attempts", "out"), "all": ()}


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="shelfmark", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--as-of", required=True, help="time stamp of the run")
    parser.add_argument("--run-id", help="name of the run (default: the time stamp)")
    parser.add_argument("--layout", choices=("files", "table"), default="files")
    parser.add_argument("--engine", choices=STRATEGIES, default="exact")
    parser.add_argument("--delta-on", choices=("id", "hash", "feed"), default="id", help="how gold finds what to embed")
    parser.add_argument("--index", choices=KINDS, help="index to build, or to search instead of the vectors")
    parser.add_argument("--attempts", help="request log as Parquet; `all` lands its pages first")
    parser.add_argument("--checkpoint", help="of the stream (default: beside its table)")
    parser.add_argument("--queries", help="JSON lines with query_id and text")
    parser.add_argument("--out", help="where the results go, as Parquet")
    own, rest = parser.parse_known_args(argv)
    lacking = [f"--{name}" for name in COMMANDS[own.command] if not getattr(own, name)]
    if lacking:
        parser.error(f"{own.command} needs {' and '.join(lacking)}")
    config, run_id = from_args(rest), own.run_id or own.as_of
    spark = SparkSession.builder.appName("shelfmark").getOrCreate()
    attempts = spark.read.parquet(own.attempts) if own.attempts else None
    if own.command == "land":
        run_landing(spark, config, attempts, own.as_of, run_id).show(truncate=False)
    elif own.command == "silver":
        run_silver(spark, config, own.as_of, run_id, own.layout).show(truncate=False)
    elif own.command == "stream":
        start_incremental(spark, config, own.as_of, own.checkpoint).awaitTermination()
    elif own.command == "gold":
        run_gold(spark, config, run_id, own.engine, delta_on=own.delta_on).show(truncate=False)
    elif own.command == "rebuild":
        print(rebuild_index(spark, config, own.engine, run_id), "vectors divided anew")
    elif own.command == "index":
        print(build_index(spark, config, own.index, run_id, own.engine), "vectors indexed")
    elif own.command == "search":
        queries = spark.read.schema("query_id long, text string").json(own.queries)
        found = (search_index(spark, config, queries, kind=own.index, engine=own.engine) if own.index
                 else run_search(spark, config, queries, engine=own.engine))
        found.write.mode("overwrite").parquet(own.out)
    elif own.command == "pacing":
        audit_pacing(config, attempts).write.mode("overwrite").parquet(own.out)
    else:
        run_all(spark, config, own.as_of, run_id, attempts)
    return 0


if __name__ == "__main__":
    sys.exit(main())
