from strata import catalogue as C
from strata.session import scratch_path
from strata.sources import DriverTables, ingest_films
from strata.streaming import start_page_ingest


def test_stream_ingest_is_incremental_and_equals_batch(spark, small_sf):
    t = DriverTables(spark, small_sf)
    pages = t.film_pages()
    base = scratch_path(spark, "stream-test")
    landing, table = f"{base}/landing", "stream_" + base.rsplit("-", 1)[-1]
    first, second = pages.randomSplit([0.5, 0.5], seed=3)
    first.write.text(f"{landing}/batch1")
    query = start_page_ingest(spark, f"{landing}/*", table, f"{base}/checkpoint")
    query.awaitTermination()
    n1 = spark.table(table).count()
    assert n1 == ingest_films(spark.read.text(f"{landing}/*").withColumnRenamed("value", "body")).count()

    second.write.text(f"{landing}/batch2")
    start_page_ingest(spark, f"{landing}/*", table, f"{base}/checkpoint").awaitTermination()
    # a third run with no new files adds nothing
    start_page_ingest(spark, f"{landing}/*", table, f"{base}/checkpoint").awaitTermination()

    streamed = sorted(tuple(r) for r in spark.table(table).collect())
    batch = sorted(tuple(r) for r in ingest_films(pages).collect())
    assert streamed == batch and n1 < len(batch)
    assert spark.table(table).columns[0] == C.FILM_ID


def test_stream_quarantine_keeps_going_past_a_bad_page(spark, small_sf):
    from strata.streaming import start_bad_page_capture
    t = DriverTables(spark, small_sf)
    base = scratch_path(spark, "stream-q")
    suffix = base.rsplit("-", 1)[-1]
    landing, table, bad_table = f"{base}/landing", f"streamq_{suffix}", f"streamq_bad_{suffix}"
    pages = t.film_pages()
    pages.unionByName(spark.createDataFrame([("{bad",)], "body string")).write.text(f"{landing}/b1")
    start_page_ingest(spark, f"{landing}/*", table, f"{base}/ck", lenient=True).awaitTermination()
    start_bad_page_capture(spark, f"{landing}/*", bad_table, f"{base}/ck_bad").awaitTermination()
    assert spark.table(table).count() == ingest_films(pages).count()
    assert [r.body for r in spark.table(bad_table).collect()] == ["{bad"]
