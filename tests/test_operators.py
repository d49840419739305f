import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vetline import operators as op
from vetline.functions import trigram_similarity
from vetline.operators.incremental import rows_since_max_lazy
from vetline.operators.quality import check_all

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def merged(spark, updates):
    target = spark.createDataFrame([(1, "a", 5), (2, "b", 6), (3, None, 7)], "k int, v string, n int")
    new = spark.createDataFrame(updates, "k int, v string, n int")
    rules = {"n": op.Rule.LEAST}
    once = op.merge_rows(target, new, ["k"], rules, latest_by=[F.col("n").desc()])
    return once, op.merge_rows(once, new, ["k"], rules, latest_by=[F.col("n").desc()])


def test_merge_rows_rules_and_idempotence(spark):
    once, twice = merged(spark, [(2, None, 1), (2, "x", 9), (4, "n", 2)])
    # the later update of key 2 counts; its n loses against the older one by rule
    assert rows(once) == [(1, "a", 5), (2, "x", 6), (3, None, 7), (4, "n", 2)]
    assert rows(twice) == rows(once)


def test_merge_replaces_with_null(spark):
    once, _ = merged(spark, [(1, None, 9)])
    assert (1, None, 5) in rows(once)


def test_merge_streams_the_target(spark):
    """With a small delta the target is not shuffled: broadcast joins only, on top of its scan."""
    target = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    delta = spark.range(5).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    plan = op.merge_rows(target, delta, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_insert_ignore(spark):
    target = spark.createDataFrame([(1, "s", D(2024, 1, 1))], "id int, skill string, d date")
    new = spark.createDataFrame(
        [(1, "s", D(2024, 2, 1)), (1, "t", D(2024, 2, 1)), (1, "t", D(2024, 1, 5))], "id int, skill string, d date"
    )
    got = op.insert_ignore(target, new, ["id", "skill"], [F.col("d")])
    assert rows(got) == [(1, "s", D(2024, 1, 1)), (1, "t", D(2024, 1, 5))]


def test_ranking_is_pruned_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = op.top_k(df, ["k"], [F.col("id")], 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keep_first_drops_empty_keys(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("", 0), (None, 0)], "id string, pos int")
    assert rows(op.keep_first(df, "id", [F.col("pos")])) == [("a", 1)]


def test_incremental_on_empty_target(spark):
    source = spark.createDataFrame([(1, D(2024, 1, 1)), (2, D(2024, 1, 2))], "id int, load_dt date")
    empty = source.limit(0)
    for since in (op.rows_since_max, rows_since_max_lazy):
        assert rows(since(source, empty), "id") == []
        assert rows(since(source, empty, on_empty="all"), "id") == [(1,), (2,)]
        assert rows(since(source, source.filter("id = 1")), "id") == [(2,)]


def test_file_watermark_has_day_granularity(spark):
    stamp = dt.datetime
    listing = spark.createDataFrame(
        [
            ("x/dt=2024-01-01/batch=000/p", stamp(2024, 1, 5, 10)),
            ("x/dt=2024-01-01/batch=001/p", stamp(2024, 1, 7, 1)),
            ("x/dt=2024-01-02/p", stamp(2024, 1, 6, 23)),
            ("x/other/p", stamp(2024, 1, 9)),
        ],
        "key string, last_modified timestamp_ntz",
    )
    assert rows(op.partitions_to_reload(listing, "2024-01-06"), "dt") == [("2024-01-01",)]
    assert len(rows(op.files_since(listing, "2024-01-06"))) == 2


def test_batches_number_every_row(spark):
    df = spark.range(1003).select((F.col("id") * 7 % 1003).alias("n"))
    got = op.assign_batches(df, 50, [F.col("n")], partitions=5).collect()
    assert len(got) == 1003 and all(r.batch_idx == r.n // 50 for r in got)


def test_explode_drops_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, "[]"), (3, '[{"name":"a"},{"name":null}]')], "id int, s string")
    assert rows(op.explode_json_array(df, "s", "name", "skill"), "id", "skill") == [(3, "a"), (3, None)]


def test_existing_columns(spark):
    df = spark.createDataFrame([(1, (2, "x"))], "id int, e struct<id: int, name: string>")
    assert op.existing_columns(df, ["e.name", "id", "e.gone", "z"]).columns == ["e.name", "id"]


def report(spark, expected, loaded, failures=()):
    manifest = spark.createDataFrame([(i,) for i in expected], "vacancy_id string")
    details = spark.createDataFrame([(i,) for i in loaded], "id string")
    failed = spark.createDataFrame(list(failures), "reason string, http_status string")
    return op.coverage_report(manifest, details, failed, ds="2026-01-04", load_type="daily").first()


def test_coverage_report(spark):
    got = report(
        spark,
        [str(i) for i in range(2803)] + ["0", ""],
        [str(i) for i in range(2793)],
        [("not_found", "404"), ("not_found", "404"), (None, None)],
    )
    assert (got.expected_count, got.loaded_count, got.missing_count) == (2803, 2793, 10)
    assert round(got.coverage_pct, 2) == 99.64 and got.severity == "WARNING" and got.coverage_reason == "OK"
    assert got.sample_missing_ids == ["2793", "2794", "2795", "2796", "2797"]
    assert got.failures_by_reason == {"not_found": 2, "unknown": 1}
    assert got.failures_by_status == {"404": 2, "unknown": 1}


def test_coverage_edges(spark):
    empty = report(spark, [], ["1"])
    assert (empty.severity, empty.coverage_reason, empty.coverage_pct) == ("CRITICAL", "EMPTY_MANIFEST", 0.0)
    over = report(spark, ["1"], ["1", "2"])
    assert over.coverage_pct == 200.0 and over.severity == "OK" and over.sample_missing_ids == []


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "k int, v string")
    got = rows(check_all({"t": (df, ["k", "v"], ["k"])}))
    assert got == [("t", "k", "not_null", 2), ("t", "k", "unique", 1), ("t", "v", "not_null", 2)]


def names(seed, count):
    pick = random.Random(seed)
    words = ["al", "qaida", "front", "karim", "karimov", "ali", "bank", "ivan", "ivanov", "юрий", "北京"]
    made = []
    for _ in range(count):
        text = " ".join(pick.choices(words, k=pick.randint(1, 4)))
        if pick.random() < 0.5:
            at = pick.randrange(len(text))
            text = text[:at] + pick.choice("abк ") + text[at + 1 :]
        made.append(text)
    return made + ["", "", "-", made[0]]


@pytest.mark.parametrize("small_rows", [0, 10])
def test_merge_rows_small_and_large(spark, small_rows):
    schema = "k int, l string, v string, n int"
    target = spark.createDataFrame([(1, "a", "x", 1), (2, None, "y", 2), (3, "c", None, 3)], schema)
    new = spark.createDataFrame([(2, None, "z", 1), (4, "d", "w", 4), (1, "a", None, 5)], schema)
    rules = {"n": op.Rule.GREATEST, "v": op.Rule.KEEP_FIRST}
    want = [(1, "a", "x", 5), (2, None, "y", 2), (3, "c", None, 3), (4, "d", "w", 4)]
    for _ in range(2):
        target = op.merge_rows(target, new, ["k", "l"], rules, small_rows=small_rows)
        assert rows(target.select("k", "l", "v", "n")) == rows(spark.createDataFrame(want, schema).select("k", "l", "v", "n"))


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.7, 0.9])
@pytest.mark.parametrize("broadcast_limit", [0, 1 << 27])
def test_similarity_join_is_brute_force(spark, threshold, broadcast_limit):
    left = spark.createDataFrame(list(enumerate(names(1, 120))), "i int, a string").repartition(3)
    right = spark.createDataFrame(list(enumerate(names(2, 90))), "j int, b string").repartition(3)
    score = F.round("similarity_score", 6)
    got = op.similarity_join(
        left, right, "a", "b", threshold, include_equal=True, broadcast_limit=broadcast_limit
    ).select("i", "j", score)
    everything = left.crossJoin(right).withColumn("similarity_score", trigram_similarity("a", "b"))
    want = everything.filter((F.col("similarity_score") > threshold) | (F.col("a") == F.col("b")))
    assert rows(got) == rows(want.select("i", "j", score))
    assert len(rows(want)) > 10  # the fixture holds true pairs at every threshold


def test_similarity_join_of_texts_that_grow_in_lower_case(spark):
    left, right = (spark.createDataFrame([(v,)], f"{c} string") for c, v in (("a", "a\u0130b c"), ("b", "a\u0130b")))
    score = left.crossJoin(right).select(trigram_similarity("a", "b")).first()[0]
    assert score > 0.7
    for broadcast_limit in (1 << 27, 0):
        found = op.similarity_join(left, right, "a", "b", 0.7, broadcast_limit=broadcast_limit).collect()
        assert [(r.a, r.b, r.similarity_score) for r in found] == [("a\u0130b c", "a\u0130b", pytest.approx(score))]


def test_similarity_join_emits_less_than_a_cross_product(spark):
    from vetline.operators.similarity import _distinct_values, candidate_rows, gram_order, signed_values

    syllables = ["ka", "rim", "ov", "an", "der", "sen", "mo", "li", "ta", "ru"]
    text = lambda i: " ".join("".join(syllables[(i * k + k) % 10] for k in range(j, j + 3)) for j in (1, 3))
    probes = _distinct_values(spark.createDataFrame([(f"{text(i)} {i}",) for i in range(2000)], "a string"), "a", "left")
    listed = _distinct_values(spark.createDataFrame([(f"{text(i)} {i}",) for i in range(0, 6000, 15)], "b string"), "b", "right")
    order = gram_order(listed)
    sides = [signed_values(values, side, order, 0.7) for values, side in ((probes, "left"), (listed, "right"))]
    assert candidate_rows(*sides, 0.7).count() < probes.count() * listed.count() / 20
    # probes are signed where they lie
    assert "Exchange" not in signed_values(spark.createDataFrame([("a b", 1)], "left_value string, left_hash long"), "left", order, 0.7)._jdf.queryExecution().executedPlan().toString()


def test_similarity_join_with_a_hot_name(spark):
    """A third of the probes carry one name: it is scored once and fanned out again."""
    left = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, "karim bank").otherwise(F.concat(F.lit("name "), F.col("id"))).alias("a")
    )
    right = spark.createDataFrame([("karim banks",), ("karim bank",)], "b string")
    got = op.similarity_join(left, right, "a", "b", 0.7).groupBy("b").count()
    assert rows(got) == [("karim bank", 1000), ("karim banks", 1000)]


@pytest.mark.parametrize("broadcast_limit", [0, 1 << 27])
def test_pair_store_day_by_day_is_a_full_run(spark, tmp_path, broadcast_limit):
    from vetline.operators.pairstore import PairStore

    left, right = names(1, 120) + [None, ""], names(2, 90) + [None, "--"]
    table = lambda values, c: spark.createDataFrame([(v,) for v in values], f"{c} string")
    store = PairStore(spark, str(tmp_path / "pairs"), 0.5, broadcast_limit)
    assert store.pairs().count() == 0
    for days in ((50, 30), (50, 90), (122, 92), (122, 92)):
        found = store.update(table(left[: days[0]], "a"), table(right[: days[1]], "b"), "a", "b")
        full = op.similarity_join(table(left[: days[0]], "a").distinct(), table(right[: days[1]], "b").distinct(), "a", "b", 0.5)
        assert rows(found.select("left_value", "right_value", F.round("score", 6))) == rows(full.select("a", "b", F.round("similarity_score", 6)))
    assert store.last_batch() == 2  # nothing new, no batch
    # a batch without its commit is not read, and is written anew
    found.write.mode("overwrite").parquet(f"{store.path}/pairs/batch=3")
    assert store.pairs().count() == found.count()
    again = store.update(table(["some new name"], "a"), table(["some new names"], "b"), "a", "b")
    assert store.last_batch() == 3 and again.count() >= found.count() + 1
    everything = op.similarity_join(table([*left, "some new name"], "a").distinct(), table([*right, "some new names"], "b").distinct(), "a", "b", 0.5)
    assert rows(again.select("left_value", "right_value")) == rows(everything.select("a", "b"))
