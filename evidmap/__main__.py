"""Run a job:  spark-submit ... -m evidmap, or  python -m evidmap --store ROOT ...

    python -m evidmap --store ROOT --batch 2024-06 --files RECORDS [--checksums MD5S]
    python -m evidmap --store ROOT --batch 2024-07 --stages extraction analytics
    python -m evidmap --store ROOT --stream --files RECORDS [--every '10 minutes']
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from evidmap.operators.quality import run_checks
from evidmap.plans import jobs
from evidmap.sources.store import Store
from evidmap.streaming.incremental import ingest_new_files


def main() -> None:
    parser = argparse.ArgumentParser(prog="evidmap")
    parser.add_argument("--store", required=True, help="root folder of the stored tables")
    parser.add_argument("--files", help="folder of the record files")
    parser.add_argument("--checksums", help="folder of .md5 files; others are not ingested")
    parser.add_argument("--batch", help="name of this run; a run of the same name replaces it")
    parser.add_argument("--stages", nargs="+", choices=jobs.FULL, default=jobs.FULL)
    parser.add_argument("--limit", type=int, help="abstracts per extraction stage; all by default")
    parser.add_argument("--retry-failed", action="store_true", help="extract again what failed")
    parser.add_argument("--stream", action="store_true", help="ingest files as they arrive")
    parser.add_argument("--every", help="keep looking for files at this interval")
    options = parser.parse_args()

    spark = SparkSession.builder.appName("evidmap").getOrCreate()
    if options.stream:
        if not options.files:
            parser.error("--stream needs --files")
        ingest_new_files(spark, options.files, options.store, every=options.every).awaitTermination()
        return
    if not options.batch:
        parser.error("a job needs --batch")
    summary = jobs.run_job(
        spark,
        options.store,
        options.batch,
        options.stages,
        path=options.files,
        checksums=options.checksums,
        limit=options.limit,
        retry_failed=options.retry_failed,
    )
    summary.show(100, truncate=False)
    store = Store(spark, options.store)
    run_checks(store.read("articles"), store.extractions()).show(100, truncate=False)


if __name__ == "__main__":
    main()
