def test_payload_files_are_written_one_per_row_without_a_committer(spark, tmp_path):
    from vetline.sources.payloads import raw_payloads, write_payload_files

    rows = [("k=1.txt", "one\n"), ("k=2.txt", " "), ("k=4.txt", "é\r\nx")]
    for _ in range(2):  # a second run writes the same files
        write_payload_files(spark.createDataFrame(rows, "object_key string, payload string"), str(tmp_path / "raw"))
    assert {p.name: p.read_bytes() for p in (tmp_path / "raw").iterdir()} == {k: (v or "").encode() for k, v in rows}
    raw = raw_payloads(spark, str(tmp_path / "raw"), "s").select("payload", "content_length").collect()
    assert sorted(tuple(r) for r in raw) == sorted((v or "", len((v or "").encode())) for _, v in rows)
