"""Run a job: ``python -m pactlens <job> <path> ...``; paths in the order of the job's parameters."""

from __future__ import annotations

import sys

from pactlens.plans import jobs
from pactlens.session import build_session

JOBS = (
    "extract", "land", "land_stream", "process", "process_new", "features", "profile", "reference_tables", "train", "score", "top_report",
    "search", "data_drift", "model_drift", "retrain_signals", "compare_models",
)


def main(argv: list[str]) -> None:
    if not argv or argv[0] not in JOBS:
        raise SystemExit(f"usage: python -m pactlens <{'|'.join(JOBS)}> <path> ...")
    getattr(jobs, argv[0])(build_session(), *argv[1:]).show(truncate=False)


if __name__ == "__main__":
    main(sys.argv[1:])
