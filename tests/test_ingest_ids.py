from lectern.plans import catalog


def test_ids_follow_urls_over_all_landings(spark, tmp_path):
    """Every row has its id; articles land in the order of urls, so ids follow it."""
    rows = [(i, None if i % 17 == 3 else f"text of number {i} " * 30, "en", f"s{i % 5}", 10) for i in range(80)]
    rows.append((80, "  ", "en", "s1", 2))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, [1.0], i % 2) for i in range(40)], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{tmp_path}/embeddings.parquet")
    got = catalog.QUERIES["incremental_ingest"](spark, str(tmp_path))
    assert got.columns == ["id", "url", "content_hash", "topic_id"]
    urls = sorted(f"https://corpus.example/library/{s}-{i}" for i, t, _, s, _ in rows if t and t.strip())
    assert sorted((r.id, r.url) for r in got.collect()) == list(enumerate(urls, 1))
