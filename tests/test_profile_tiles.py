import pytest
from pyspark.sql import functions as F

from vetline.plans import profiles
from vetline.plans.profiles import Profile, tag_profiles

WORDS = [f"w{i}x" for i in range(20)]
TEXTS = [(i, " ".join(w for k, w in enumerate(WORDS) if (i >> (k % 6)) & 1 or k == i % 20)) for i in range(70)]
TEXTS += [(70, None), (71, ""), (72, "none"), (73, TEXTS[5][1]), (74, TEXTS[5][1]), (None, TEXTS[6][1])]
PROFILES = [Profile(f"p{a}-{b}", ((WORDS[a], WORDS[b]), (WORDS[b], WORDS[(a + b) % 20])), None if a == 3 else "c") for a in range(20) for b in range(20)]
PROFILES += [Profile("unmet", ((WORDS[0],), ("nowhere",)), "c"), Profile("off", ((WORDS[0],),), "c", False), Profile("none", ((WORDS[0],), ()), "c")]


def _expected() -> list:
    return sorted(
        (str(i), text, p.profile_id, str(p.expected_risk_category)) for i, text in TEXTS for p in PROFILES if p.enabled and all(set(g) & set((text or "").split()) for g in p.groups)
    )


def _got(tagged) -> list:
    return sorted((str(r["id.no"]), r.text, r.search_profile, str(r.expected_risk_category)) for r in tagged.collect())


def test_result_rows_of_many_profiles_are_not_shuffled(spark):
    tagged = tag_profiles(spark.createDataFrame(TEXTS, "`id.no` int, text string"), "text", PROFILES)
    assert _got(tagged) == _expected()
    plan = tagged._jdf.queryExecution().sparkPlan().toString()
    # rows are made above the product of texts and profiles; nothing joins or groups them afterwards
    above = plan[: plan.index("CartesianProduct")]
    assert "explode" in above and "Exchange" not in above and "Join" not in above and "Aggregate" not in above


@pytest.mark.parametrize("same_keys", [False, True])
def test_buckets_and_slices_give_all_rows(spark, monkeypatch, same_keys):
    for name, value in (("FEW", 0), ("BUCKET_ROWS", 9), ("SLICE_PROFILES", 50), ("CHUNK", 7)):
        monkeypatch.setattr(profiles, name, value)
    if same_keys:  # postings are told apart by their checks as well
        monkeypatch.setattr(profiles, "_key", lambda posting: F.pmod(F.xxhash64(posting), F.lit(3)))
    tagged = tag_profiles(spark.createDataFrame(TEXTS, "`id.no` int, text string"), "text", PROFILES)
    assert _got(tagged) == _expected()
