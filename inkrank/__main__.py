"""The jobs on the command line: ``python -m inkrank <job> …``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from inkrank.plans.link_jobs import (
    initial_graph_job,
    page_count_job,
    page_rank_job,
    rank_graph_job,
    save_graph_job,
)
from inkrank.plans.text_jobs import (
    search_index_job,
    search_job,
    term_frequency_job,
    tf_idf_job,
    word_count_job,
)

JOBS = {
    "word-count": (word_count_job, ["inputs", "output"]),
    "term-frequency": (term_frequency_job, ["inputs", "output"]),
    "tf-idf": (tf_idf_job, ["inputs", "output", "--index_path"]),
    "search": (search_job, ["index_path", "output", "query"]),
    "search-index": (search_index_job, ["index_path", "output", "query"]),
    "page-count": (page_count_job, ["inputs", "output"]),
    "initial-graph": (initial_graph_job, ["inputs", "output", "--graph_path"]),
    "page-rank": (page_rank_job, ["inputs", "output", "--iterations"]),
    "save-graph": (save_graph_job, ["inputs", "graph_path"]),
    "rank-graph": (rank_graph_job, ["graph_path", "work_path", "output", "--iterations"]),
}


def _unless_given(argument: str) -> dict[str, object]:
    """Options that are not given leave the job its own default."""
    return {"default": argparse.SUPPRESS} if argument.startswith("--") else {}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="inkrank")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name, (job, arguments) in JOBS.items():
        front = jobs.add_parser(name, help=job.__doc__)
        for argument in arguments:
            kind = int if argument == "--iterations" else str
            front.add_argument(argument, type=kind, **_unless_given(argument))
    chosen = vars(parser.parse_args(argv))
    job, _ = JOBS[chosen.pop("job")]
    spark = SparkSession.builder.appName("inkrank").getOrCreate()
    job(spark, **chosen)


if __name__ == "__main__":
    main()
