import random

from tests.llm import plain
from vetline.llm import minhash


def test_texts_that_nobody_asks_for_are_left_out(spark):
    nodes = [*range(-500, 500), 2**62, -(2**63)]
    texts = spark.createDataFrame([(n, n % 7, b"t") for n in nodes] + [(3, 8, b"u")], "node long, mark long, body binary")
    wanted = spark.createDataFrame([(n,) for n in (3, 3, -500, 2**62, -(2**63), 10**9)], "node long")
    found = sorted((r.node, bytes(r.body)) for r in minhash._near_wanted(texts, wanted).collect())
    assert found == [(-(2**63), b"t"), (-500, b"t"), (3, b"t"), (3, b"u"), (2**62, b"t")]
    assert minhash._near_wanted(texts, wanted.filter("false")).count() == 0


def test_near_duplicates_deals_only_texts_of_candidates(spark, monkeypatch):
    random.seed(3)
    rows = [(i, " ".join(f"w{random.randrange(10**6)}" for _ in range(40))) for i in range(200)]
    rows += [(1000 + i, f"{t} tail") for i, t in rows[:5]]
    plans, store = {}, minhash.materialize

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(minhash, "materialize", kept)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()} == plain.near_duplicates(rows, 85)
    # both sides of a pair and the members of clusters
    assert [plans[name].count("Join LeftSemi") for name in ("links", "more_links")] == [2, 2]
