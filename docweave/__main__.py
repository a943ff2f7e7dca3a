"""Run a job from the command line (or ``spark-submit``):

    python -m docweave enrich   --tables DIR --out PATH [--format json] [--batch 30] ...
    python -m docweave entities --tables DIR --out PATH
    python -m docweave copy     --tables DIR --out PATH [--batch 100]
    python -m docweave keywords --tables DIR --out PATH [--min-n 2] [--top 5]

``--tables`` is a folder of Parquet tables (documents, labels, ...).  The
session comes from spark-submit when present; credentials are never taken on
the command line (JDBC properties belong in the Spark configuration).
"""

from __future__ import annotations

import argparse

from docweave.plans import jobs
from docweave.session import get_spark
from docweave.sources import files
from docweave.sources import tables as tb


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="docweave")
    ap.add_argument("job", choices=["enrich", "entities", "copy", "keywords"])
    ap.add_argument("--tables", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="json")
    ap.add_argument("--mode", default="overwrite")
    ap.add_argument("--min-size", type=int, default=None)
    ap.add_argument("--max-size", type=int, default=None)
    ap.add_argument("--batch", type=int, default=None, help="newest-N batch; all rows when omitted")
    ap.add_argument("--partitions", type=int, default=None)
    ap.add_argument("--min-n", type=int, default=1)
    ap.add_argument("--top", type=int, default=5)
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    given = lambda value, default: default if value is None else value
    spark = get_spark(a.master, f"docweave-{a.job}")
    content, source = tb.content(spark, a.tables), tb.source(spark, a.tables)
    if a.job == "enrich":
        out = jobs.enrich_batch(content, source, given(a.min_size, 1000), given(a.max_size, 100000), a.batch, a.partitions)
    elif a.job == "entities":
        out = jobs.entity_job(content, given(a.min_size, 1000), given(a.max_size, 10000), partitions=a.partitions)["table"]
    elif a.job == "copy":
        out = jobs.incremental_copy(content, source, tb.ledger(spark, a.tables),
                                    given(a.min_size, 100), given(a.max_size, 1000000), a.batch)
    else:
        docs = tb.table(spark, a.tables, "documents").select("doc_id", "text")
        out = jobs.keyword_report(docs, "doc_id", "text", min_n=a.min_n, top=a.top)
    files.write_index(out, a.format, mode=a.mode, path=a.out)


if __name__ == "__main__":
    main()
