"""Conversation repair, quality votes and the manifest against plain versions."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tests.llm import plain_rules as plain
from vetline.llm import conversations, merkle, queries, rules

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(table):
    return {r.conv_id: tuple(r[n] for n in NAMES) for r in table.collect()}


# -- conversations


def test_conversations_given(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_conversation_dawg(spark, FOLDER)) == plain.conversations({r[0] for r in rows}, plain.damaged(rows))


CHAT = "conv_id long, turn long, role string, text string, c string, ord int, symbols int, right int"


def chat(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], CHAT)


def test_conversations_awkward(spark):
    texts = ["Hi.", "Hi.", "no end", "", " \n", None, "a!\t", "b?  x", "Long " * 3000 + "end.", "é." * 10]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ü", "u", "a"]
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 3, 4, 5, None]), rng.choice([0, 1, 2, 3, 7, None, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(90)]
    rows += [(9, None, "user", "only."), (10, 1, "user", "x."), (10, 1, "user", "x."), (10, 1, "user", "x."), (11, 0, "system", "s."), (12, 0, "user", "\x00.")]
    table = chat(spark, rows)
    ids = {r[0] for r in rows}
    told = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    expected = plain.conversations(ids, told)
    assert found(conversations.repair(table)) == expected
    # pieces of one, two or three rows, or of few bytes, give the same
    for options in ({"piece": 1}, {"piece": 3}, {"piece_bytes": 4}):
        assert found(conversations.repair(table, **options)) == expected
    assert found(conversations.repair(conversations.damage(table), ids=table)) == plain.conversations(ids, plain.damaged(rows))
    kept = {r.conv_id: r for r in conversations.repair(table, piece=2, keep_text=True).collect()}
    assert all(plain.sha(r.repaired) == r.repaired_sha256 for r in kept.values())


def test_conversations_long(spark):
    """One conversation with most of the rows, in pieces; its plain version walks it row by row."""
    rng = random.Random(7)
    rows = [(1, t, rng.choice(["user", "assistant", "user", "assistant", "system"]), f"t{t} {rng.choice(['.', '.', ''])}") for t in range(400)]
    rows += [(i, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b.", "c"])) for i in range(2, 60) for t in range(rng.randrange(1, 6))]
    expected = plain.conversations({r[0] for r in rows}, rows)
    for piece in (5, 64, 1000):
        assert found(conversations.repair(chat(spark, rows), piece=piece)) == expected


def test_conversations_none(spark):
    table = chat(spark, [(1, 1, "user", "x.")])
    assert conversations.repair(table.filter("false")).count() == 0
    assert found(conversations.repair(table.filter("false"), ids=table)) == {1: (0, 0, 0, 0, 0, 0, "", plain.sha(""))}


def test_suffixes_shared_once():
    """Nodes of a suffix that signatures share are made once; all ties are those of the plain search."""
    shared = conversations.Suffixes()
    first = shared.outcomes("uaUAx", conversations.END)
    kept = shared.nodes[:4]
    shared.outcomes("ssUAx", conversations.END)
    assert all(a is b for a, b in zip(kept, shared.nodes[:4], strict=True))
    assert first == conversations.Suffixes().outcomes("uaUAx", conversations.END)
    assert len(conversations.grammar().classes) < 100


# -- rules

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, at int, n int, digest string, pos int"
LINE = "The cat sat on the mat and then it ran away from us."
TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h", "a b c d e f g h " * 2, "a b c d e f g " * 9, f"{LINE}\n{LINE}\n \n\r\n \r\n", "x #$ | <b> é ü\n",
    " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000)), " ".join(["same"] * 5000), "Ünï cödé 　nbsp end." * 30, "\x0b\x0ca\x1cb c\n\nc", "#" * 300,
]


def table(spark, texts):
    rows = [(i if i % 7 else None, t, "en" if i % 3 else None, f"s{i % 4}" if i % 4 else None, i if i % 5 else None, "w", 1, 2, "d", 3) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[:4], SCHEMA)


def test_measures(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(table(spark, TEXTS).select("doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = sorted((repr(r.doc_id), *(r[n] for n in names)) for r in rules.measures(docs).collect())
    assert got == sorted((repr(r.doc_id), *plain.measures(r.text)) for r in docs.collect())


def test_judge(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    for r in got.values():
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= rules.THRESHOLD)
    judged = [r for r in got.values() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r in judged if labels[r.doc_id] == 1)
    assert sum(r.kept == (labels[r.doc_id] == 1) for r in judged) >= 0.95 * len(judged)


def test_judge_awkward(spark):
    docs = table(spark, TEXTS)
    got = rules.judge(docs).collect()
    assert len(got) == docs.count() and all(0 <= r.posterior <= 1 for r in got)
    assert rules.judge(docs.filter("false")).count() == 0
    python = rules.judge(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in python and "Arrow" not in python


def test_fit_drawn(spark):
    """Votes drawn from known accuracies: the estimates find them, a plain version of the rounds agrees."""
    truth = {"a": (0.9, 0.8), "b": (0.95, 0.7), "c": (0.8, 0.9), "d": (0.85, 0.85), "e": (0.5, 0.5)}
    rng = random.Random(11)
    drawn = []
    for _ in range(20_000):
        good = rng.random() < 0.7
        row = []
        for on_good, on_bad in truth.values():
            right = rng.random() < (on_good if good else on_bad)
            row.append(0 if rng.random() < 0.3 else 1 if right == good else -1)
        drawn.append(tuple(row))
    votes = spark.createDataFrame(drawn, ", ".join(f"{n} int" for n in truth)).groupBy(*truth).agg(F.count("*").alias("n")).cache()
    good, right = rules.fit(votes, list(truth))
    assert abs(good - 0.7) < 0.03
    assert all(abs(x - y) < 0.04 for n in truth for x, y in zip(right[n], truth[n], strict=True))
    # one round by hand
    one_good, one = rules.fit(votes, list(truth), rounds=1)
    counts = {tuple(r[n] for n in truth): r["n"] for r in votes.collect()}
    chance = {}
    for row in counts:
        odds = 3.0
        for v in row:
            odds *= {1: 3.0, -1: 1 / 3, 0: 1.0}[v]
        chance[row] = odds / (1 + odds)
    share = (sum(n * chance[r] for r, n in counts.items()) + rules.PRIOR) / (sum(counts.values()) + 2 * rules.PRIOR)
    assert abs(one_good - share) < 1e-9
    for i, name in enumerate(truth):
        g = (sum(n * chance[r] for r, n in counts.items() if r[i] > 0) + 1.5) / (sum(n * chance[r] for r, n in counts.items() if r[i]) + 2)
        assert abs(one[name][0] - g) < 1e-9


# -- manifest


def run(spark, docs, **options):
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = merkle.manifest(docs, changed={"text": lower}, changed_where=changed, **options)
    return sorted((tuple(r) for r in out.drop("source", "path").collect()), key=repr)


def test_manifest(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = run(spark, docs)
    assert got == plain.manifest(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize(("fanout", "span"), [(16, 256), (2, 2), (3, 9)])
def test_manifest_awkward(spark, fanout, span):
    docs = table(spark, TEXTS * 3)
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert run(spark, docs, fanout=fanout, span=span) == plain.manifest(rows, fanout)
    assert run(spark, docs.limit(1), fanout=fanout, span=span) == plain.manifest(rows[:1], fanout)
    assert run(spark, docs.filter("false"), fanout=fanout, span=span) == []


def test_manifest_many_groups(spark):
    docs = spark.range(700).selectExpr("id AS doc_id", "concat('T', id) AS text", "'en' AS lang", "CAST(id % 60 AS string) AS source", "id AS n_chars")
    docs = docs.unionByName(spark.range(5000, 5700).selectExpr("id AS doc_id", "'A' AS text", "'en' AS lang", "'big' AS source", "id AS n_chars"))
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert run(spark, docs) == plain.manifest(rows)
