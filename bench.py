"""Headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; one JSON line.

Page texts are derived from ``documents`` and written once before the clock starts:
the jobs read a page table, as they would on a cluster.
"""

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from folioscope.operators import analytics, chunks, conservative, extraction
from folioscope.plans import documents, retrieval
from folioscope.streaming.changes import snapshot_diff
from workload import fixtures

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    fixtures.legal_pages(spark, SF_DIR).write.parquet(f"{scratch}/pages")
    fixtures.chunk_search(spark, SF_DIR).write.parquet(f"{scratch}/chunks")
    pages = spark.read.parquet(f"{scratch}/pages")
    corpus = spark.read.parquet(f"{scratch}/chunks")
    queries = fixtures.search_queries(spark, SF_DIR)
    encode = fixtures.stored_encoder(spark, SF_DIR)
    conversations = fixtures.table(spark, SF_DIR, "conversations")

    def extracted() -> DataFrame:
        return extraction.extract_pages(pages, skip=0)

    jobs = {
        "hybrid_extraction": extracted,
        "semantic_chunks": lambda: chunks.semantic_chunks(extracted()),
        "run_statistics": lambda: extraction.run_statistics(extraction.page_status(extracted())),
        "sections": lambda: conservative.page_sections(pages),
        "conservative_footnotes": lambda: conservative.conservative_footnotes(pages),
        "main_text_chunks": lambda: chunks.flatten_chunks(chunks.main_text_chunks(pages, 200)),
        "section_coverage": lambda: analytics.section_coverage(chunks.chunk_index(pages, 200)),
        "conservative_statistics": lambda: documents.process_conservative(pages, 200)["statistics"],
        "batch_search": lambda: retrieval.enhanced_search(queries, corpus, encode),
        "rag_rows": lambda: retrieval.rag_rows(queries, corpus, encode, conversations),
        "change_feed": lambda: snapshot_diff(*fixtures.snapshots(spark, SF_DIR)),
    }
    timings = {}
    for attempt in ("warm", "timed"):
        for name, job in jobs.items():
            started = time.perf_counter()
            job().write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline jobs",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
