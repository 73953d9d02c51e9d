"""Records of pages that share few or very common payloads."""

import hashlib

from pyspark.sql import functions as F

from linkspark.llm import warc_store as W


def expected(pages):
    first = {}
    for i, html in pages:
        if i is not None and len((html or "").encode()) >= W.MIN_DUP_BYTES:
            first[html] = min(i, first.get(html, i))
    return sorted((i or -1, hashlib.sha256((html or "").encode()).hexdigest(),
                   first[html] if html in first and first[html] != i else -1) for i, html in pages)


def test_common_payloads_spread_over_tasks(spark):
    common, twin = "é" * 60, "x" * 100
    pages = [(i, common if i % 3 == 0 else twin + str(i // 7) if i % 3 == 1 else "short") for i in range(5, 3000)]
    pages += [(None, common)] * 300 + [(None, None)] * 300 + [(3, common)] * 2
    rows = spark.createDataFrame([(i, None, h) for i, h in pages], "page_id long, url string, html string").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for hot_rows in (1, 500, 10**9):
            got = W.plan_records(rows, hot_rows=hot_rows).withColumn("p", F.spark_partition_id()).collect()
            assert sorted((r.page_id or -1, r.payload_digest, -1 if r.refers_to is None else r.refers_to) for r in got) == expected(pages)
            if hot_rows == 500:  # the common payload, a third of all rows, meets in no task
                tasks = [r.p for r in got if r.payload.decode() == common]
                assert max(map(tasks.count, set(tasks))) < len(tasks) / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
