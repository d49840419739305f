"""Passages and periods that make a large part of all regions reach no single task."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from vetline.llm import suffixes


def _word() -> str:
    return "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=6))


def test_equal_regions_that_touch_are_one_row():
    random.seed(5)
    own = " ".join(_word() for _ in range(150))
    texts = ["over and over again " * 500, own, own + "xy " * 400 + own, "xy " * 400]
    batch = pa.record_batch([pa.array([b"a", b"b", b"c", b"d"]), pa.array([t.encode() for t in texts])], ["key", "body"])
    (found,) = suffixes._find_regions(iter([batch]), 400, 160)
    held = {k: [r for r in found.to_pylist() if r["key"] == k.encode()] for k in "abcd"}
    # the period's regions and one at either end
    assert [sum(r["n"] > 1 for r in held[k]) for k in "abcd"] == [1, 0, 1, 1]
    assert len(held["a"]) <= 3 and len(held["d"]) <= 3
    for k, text in zip("abcd", texts, strict=True):
        parts = [tuple(np.concatenate(x)) for x in zip(*suffixes.regions(np.frombuffer(text.encode(), np.uint8), 400, 160), strict=True)]
        assert sum(r["n"] for r in held[k]) == len(parts[0])
        assert max(r["end"] for r in held[k]) == len(text)


@pytest.mark.parametrize("more", [{}, {"hot_rows": 2}, {"hot_rows": 2, "sort_classes": 2}])
def test_hot_passage_and_period(spark, monkeypatch, more):
    random.seed(6)
    passage, line = " ".join(_word() for _ in range(14)), "ha, " * 60
    texts = [f"{_word()} {_word()} {passage} {_word()} {_word()}" for _ in range(1200)]
    texts += [f"{_word()} {line}{_word()}" for _ in range(20)] + [texts[0]] * 3 + [" ".join(_word() for _ in range(30)) for _ in range(40)]
    places, store = {}, suffixes.materialize

    def kept(df, name):
        if name == "shared_regions":
            at = df.select("anchor", F.spark_partition_id().alias("part"))
            places.update(at.groupBy("anchor").agg(F.count("*").alias("n"), F.countDistinct("part").alias("parts")).orderBy(F.desc("n")).first().asDict())
        return store(df, name)

    monkeypatch.setattr(suffixes, "materialize", kept)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8, "doc_id")
    found = {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(docs, 60, **more).collect()}
    assert found == dict(enumerate(plain.repeats(texts, 60)))
    assert places["n"] >= 1200 and places["parts"] > 1


def test_sort_holds_few_slices(monkeypatch):
    """A group of many classes is sorted without a copy of 400 bytes for each of its suffixes."""
    random.seed(7)
    own = lambda n: " ".join(_word() for _ in range(n))
    passage = own(75)
    texts = [f"{own(3)} {passage} {own(3)}".encode() for _ in range(400)] + [b"ab " * 300, b"ab\0" * 300, b"\0" * 900]
    tracemalloc.start()
    found = suffixes.repeated_windows(texts, 400)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * sum(map(len, texts))
    counts = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    want = [[i for i in range(len(t) - 399) if counts[t[i : i + 400]] > 1] for t in texts]
    assert [f.tolist() for f in found] == want
    monkeypatch.setattr(suffixes, "_SLICES", 3)
    assert [f.tolist() for f in suffixes.repeated_windows(texts, 400)] == want
