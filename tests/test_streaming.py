from quarry.streaming import stream_word_count


def test_stream_word_count_matches_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.txt").write_text("--Hello, world!\nHello again\n")
    (src / "b.txt").write_text("Hi.\n")
    q = (stream_word_count(spark, str(src)).writeStream.outputMode("complete")
         .format("memory").queryName("wc_stream")
         .option("checkpointLocation", str(tmp_path / "ckpt")).start())
    try:
        q.processAllAvailable()
        got = {r.word: r["count"] for r in spark.sql("SELECT * FROM wc_stream").collect()}
    finally:
        q.stop()
    assert got == {"hello": 2, "world": 1, "again": 1, "hi": 1}
