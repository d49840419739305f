def test_only_probes_with_a_candidate_are_cut_for_the_score(spark, tmp_path):
    from vetline.operators.similarity import scored_pairs

    probes = spark.createDataFrame([("anna smith", 1), ("bob", 2)], "left_value string, left_hash long")
    listed = spark.createDataFrame([("anna smiths", 7)], "right_value string, right_hash long")
    met = spark.createDataFrame([(1, 7)], "left_hash long, right_hash long")
    found = scored_pairs(met, probes, listed, 0.7)
    assert [(r.left_value, r.right_value) for r in found.collect()] == [("anna smith", "anna smiths")]
    assert "with_candidate" in "".join(found.inputFiles())
