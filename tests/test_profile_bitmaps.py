from vetline.plans.profiles import Profile, tag_profiles


def test_groups_are_met_as_bitmaps_not_as_rows_per_text_and_group(spark):
    words = [f"w{i}x" for i in range(12)]
    texts = [(i, " ".join(w for k, w in enumerate(words) if (i >> (k % 6)) & 1 or k == i % 12)) for i in range(70)] + [(70, None), (71, ""), (72, "none")]
    profiles = [Profile(f"p{a}-{b}", ((words[a], words[b]), (words[b], words[(a + b) % 12])), None if a == 3 else "c") for a in range(12) for b in range(12)]
    profiles.append(Profile("unmet", ((words[0],), ("nowhere",)), "c"))
    tagged = tag_profiles(spark.createDataFrame(texts, "id int, text string"), "text", profiles)
    expected = sorted((i, p.profile_id, p.expected_risk_category) for i, text in texts for p in profiles if all(set(g) & set((text or "").split()) for g in p.groups))
    assert sorted((r.id, r.search_profile, r.expected_risk_category) for r in tagged.collect()) == expected
    assert "bitmap_and_agg" in tagged._jdf.queryExecution().optimizedPlan().toString()
