"""One run from the command line, for a scheduler to start:

    spark-submit --py-files tidemark.zip tidemark/plans/job.py --pipeline landing \\
        --source-root /mnt/remote/in --target-root gs://bucket/in --state-root gs://bucket/state \\
        --run-id 2024-01-01 --logical-start-ms 1704240300000

Prints one JSON line with the window and the number of files by check.
"""

from __future__ import annotations

import argparse
import json
from dataclasses import fields

from pyspark.sql import functions as F

from tidemark.options import TransferOptions, safety_from_text
from tidemark.plans.run import run_transfer
from tidemark.session import build_session

_WHOLE = ("port", "from_delta", "lookback_s", "retries", "wait_s", "parallelism")
_FLAGS = ("recursive", "preview")


def parse(arguments: list[str] | None = None) -> tuple[TransferOptions, str, int]:
    """Options not given keep their defaults; a bad safety lag falls back to its own."""
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--logical-start-ms", required=True, type=int)
    for option in fields(TransferOptions):
        name = "--" + option.name.replace("_", "-")
        if option.name in _FLAGS:
            parser.add_argument(name, action="store_true", default=argparse.SUPPRESS)
        elif option.name in _WHOLE:
            parser.add_argument(name, type=int, default=argparse.SUPPRESS)
        elif option.name == "safety_s":
            parser.add_argument(name, type=safety_from_text, default=argparse.SUPPRESS)
        else:
            parser.add_argument(name, default=argparse.SUPPRESS)
    given = vars(parser.parse_args(arguments))
    run_id, logical_ms = given.pop("run_id"), given.pop("logical_start_ms")
    return TransferOptions(**{"pipeline": "", "source_root": "", "target_root": "", **given}), run_id, logical_ms


def main(arguments: list[str] | None = None) -> dict:
    options, run_id, logical_ms = parse(arguments)
    spark = build_session(f"tidemark-{options.pipeline}")
    result = run_transfer(spark, options, run_id, logical_ms)
    if result.ledger is None:
        files = {"planned": result.plan.count()}
    else:
        files = {row["check"]: row["n"] for row in result.ledger.groupBy("check").agg(F.count("*").alias("n")).collect()}
    summary = {"from_s": result.from_s, "to_s": result.to_s, "committed": result.committed, "files": files}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main()
