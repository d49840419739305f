"""The pipeline's stages, each on what the one before kept."""

import os

import pytest

import corpus_pipeline
from tests.llm import plain
from vetline.llm import lines

FOLDER = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    items = [plain.words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        out = stage(spark, docs, FOLDER)
        after = out.cache().collect()
        kept = {r.doc_id for r in after}
        assert kept and kept <= {r.doc_id for r in before}
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
            right = [(r.doc_id in kept) == (labels[r.doc_id] == 1) for r in before if r.doc_id in labels]
            assert sum(right) > 0.97 * len(right)
        elif name == "line_dedup":
            sites = {}
            for r in before:
                for line in (r.text or "").split("\n"):
                    sites.setdefault(line.strip(" "), set()).add(r.source)
            keep = lambda x: not x.strip(" ") or len(sites[x.strip(" ")]) < lines.MIN_SITES
            want = {r.doc_id: "\n".join(x for x in r.text.split("\n") if keep(x)) for r in before}
            assert {r.doc_id: r.text for r in after} == want and all(r.n_chars == len(r.text) for r in after)
        elif name == "near_dedup":
            found = plain.near_duplicates([(r.doc_id, r.text) for r in before], 80)
            blank = {r.doc_id for r in before if not plain.words(r.text)}
            assert kept == {i for i, (_, c) in found.items() if c == i} | blank
        elif name == "decontamination":
            def leaks(text):
                own, sets = plain.words(text), plain.shingles(text)
                return any(len(w) >= 5 and {tuple(w[i : i + 5]) for i in range(len(w) - 4)} & sets and plain.tiling(own, w, 5) >= 0.8 * len(w) for w in items)

            assert kept == {r.doc_id for r in before if not leaks(r.text)}
        else:
            assert len(after) == len(before) and "ids" in out.columns
        if name != "bpe_encode":
            assert out.columns == columns
        docs = out


def test_awkward_rows_pass(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "some words that nobody else has at all", None, "s", None), (None, "x y", "en", "s", 3)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, mark int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", "mark"]
        assert docs.count() == (5 if name in ("quality_classifier", "line_dedup") else 4)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == 4
