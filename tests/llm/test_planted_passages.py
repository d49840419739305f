"""Removal of repeats decides by 400 bytes, not by words."""

import random

import pytest

from tests.llm import plain
from vetline.llm import suffixes


@pytest.mark.parametrize("sort_classes", [suffixes.SORT_CLASSES, 2])
def test_planted_passages_at_the_border(spark, sort_classes):
    """Passages of 67 words and 399, 400 and 401 bytes, each in two texts, lie in 12 partitions among texts of their own."""
    random.seed(8)
    word = lambda: "".join(random.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    texts = [" ".join(word() for _ in range(150)) for _ in range(48)]
    sizes = {}
    for at, size in enumerate((399, 400, 401)):
        passage = " ".join(word() for _ in range(67))[:size].ljust(size, "z")
        assert len(passage.split()) > 50
        # the bytes around the two places differ, so that the repeat is as long as the passage
        for i, (before, after) in ((at, "AB"), (at + 24 + 5, "CD")):
            cut = 100 + 7 * i
            texts[i] = f"{texts[i][:cut]}{before}{passage}{after}{texts[i][cut:]}"
            sizes[i] = size
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12, "doc_id")
    found = {r[0]: tuple(r[1:]) for r in suffixes.remove_repeats(docs, sort_classes=sort_classes).collect()}
    assert {i: r[1] for i, r in found.items() if r[1]} == {i: size for i, size in sizes.items() if size >= 400}
    assert found == dict(enumerate(plain.repeats(texts, 400)))
