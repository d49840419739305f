"""The operators against plain versions, on the smallest tables and on the awkward cases of each."""

import base64
import gzip
import hashlib
import os
import random
import uuid

import numpy as np
import pytest

from tests.llm import plain
from vetline.llm import bpe, components, lines, minhash, permutation, pii, ppm, quality, suffixes, tiling, warc
from vetline.llm.queries import vocabulary
from vetline.session import scratch_path

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, mark string, body string, path int, component_id int"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


LONG = " ".join(f"Word{i % 977}x{i % 31}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(80))
AWKWARD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three four"), (6, PASSAGE), (7, PASSAGE), (8, PASSAGE + " tail"),
    (9, LONG), (10, LONG), (11, "Ünïcode " * 40), (12, "x" * 3000), (13, "\x00﻿ 　 é <|endoftext|> it's"), (7, PASSAGE), (None, PASSAGE),
    (None, None), (15, "one two three four"), (16, f"a {PASSAGE} b"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls everywhere, blank and long texts, ties, repeated rows, and columns whose names operators use."""
    return spark.createDataFrame([(i, t, None, None if i == 1 else f"s{n % 3}", None, "k", "m", "b", 1, 2) for n, (i, t) in enumerate(AWKWARD)], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(awkward):
    return awkward.filter("false")


def key(row):
    return repr(row)


# -- components


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 90), (90, 100), (100, 110), (5, 5), (None, 3)]
    found = dict(map(tuple, components.components(spark.createDataFrame(edges, "x long, y long")).collect()))
    assert found == {i: 0 for i in range(31)} | {90: 90, 100: 90, 110: 90}
    assert components.components(spark.createDataFrame([], "x long, y long")).count() == 0


# -- permutation index


def test_nearest_recall(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    held = table.orderBy("vec_id").toPandas()
    unit = np.stack(held.embedding).astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    found = permutation.nearest(table, shard_rows=100).toPandas()
    hits = total = 0
    for i, q in enumerate(held.vec_id):
        if q % 50:
            continue
        scores = unit @ unit[i]
        scores[i] = -9
        best = set(held.vec_id[np.argsort(-scores, kind="stable")[:5]])
        own = found[found.query_id == q].sort_values("rank")
        assert list(own["rank"]) == [1, 2, 3, 4, 5] and own.score.is_monotonic_decreasing
        assert np.allclose(own.score, [scores[list(held.vec_id).index(v)] for v in own.vec_id], atol=1e-12)
        hits, total = hits + len(best & set(own.vec_id)), total + 5
    assert hits >= 0.9 * total


def recall(spark, vectors, **options):
    """Share of the true five, ties to smaller ids, of every 50th vector."""
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>").repartition(4)
    found = permutation.nearest(table, **options).toPandas()
    held = vectors.astype(np.float32).astype(np.float64)
    held, copies = np.unique(held, axis=0, return_inverse=True)
    unit = held / np.linalg.norm(held, axis=1, keepdims=True)
    hits = total = 0
    for q in range(0, len(vectors), 50):
        scores = (unit @ unit[copies[q]])[copies]
        scores[q] = -9
        best = set(np.lexsort((np.arange(len(scores)), -scores))[:5].tolist())
        hits, total = hits + len(best & set(found[found.query_id == q].vec_id)), total + 5
    return hits / total


def test_nearest_copies(spark):
    vectors = np.random.default_rng(1).normal(size=(3000, 32))
    vectors[::3] = vectors[0]  # a third are equal
    assert recall(spark, vectors, shard_rows=1000, prefix=64, pivots=256) >= 0.95


def cone():
    draw = np.random.default_rng(2)
    return draw.normal(size=32) * 3 + draw.normal(size=(3000, 32)) * 0.5


def clusters():
    draw = np.random.default_rng(3)
    centres = np.concatenate([np.zeros((1000, 32)), np.repeat(draw.normal(size=(4, 32)), 500, axis=0)])
    return centres + draw.normal(size=(3000, 32)) * np.where(np.arange(3000) < 1000, 1, 0.05)[:, None]


@pytest.mark.parametrize("made", [cone, clusters])
def test_nearest_dense_vectors(spark, made):
    vectors = made()
    assert recall(spark, vectors[np.random.default_rng(4).permutation(len(vectors))], shard_rows=1000) >= 0.9


def test_nearest_awkward(spark):
    table = spark.createDataFrame(
        [(50, [1.0, 0.0]), (100, None), (150, [0.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, float("nan")]), (3, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (4, [0.0, 1.0]), (5, [None, 1.0]), (6, [float("inf"), 1.0])],
        "vec_id long, embedding array<float>",
    )
    assert sorted(map(tuple, permutation.nearest(table).collect())) == [(50, 1, 1, 1.0), (50, 2, 1, 1.0), (50, 3, 4, 0.0)]
    assert permutation.nearest(table.filter("false")).count() == 0
    assert permutation.nearest(table.filter("vec_id = 50")).count() == 0


# -- personal data


def test_pii_base(spark, rows):
    random.seed(3)
    parts = ["a", "b@", "@", "@c.d", ".", "1", "23", "+1", "-", " ", "(4)", "255.", "1.2.3.4", "4111 1111 1111 1111", "a.b@x-y.com", "555-123-4567", "é", "9" * 40]
    for text in ["".join(random.choices(parts, k=random.randint(1, 14))) for _ in range(4000)] + [t or "" for _, t in rows]:
        assert pii.base_spans(text) == plain.pii(text)


def test_pii_rows(spark, awkward, none):
    more = spark.createDataFrame([(20, "phone (415) 555-2671 now"), (21, "joe@example.com, +1 (415) 555-2671, 10.0.0.1, 4111111111111111"), (22, "nothing here 12")], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(more.unionByName(awkward.select("doc_id", "text"))).collect()}
    assert found[21].spans.split(",") == ["email:0:15", "phone:17:34", "ip:36:44", "card:46:62"]
    assert (found[21].n_email, found[21].n_ip, found[21].n_card, found[21].n_phone) == (1, 1, 1, 1)
    assert found[21].base_sha256 == hashlib.sha256(found[21].spans.encode()).hexdigest()
    assert found[20].spans == "phone:6:20" and found[20].n_phone == 0 and found[20].n_added == 1
    assert found[22].spans == "" and found[1].spans == ""
    assert pii.find(awkward).count() == len(AWKWARD) and pii.find(none).count() == 0


def test_pii_estimation():
    """Labelers of known reliability are told apart from their votes alone."""
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.4
    given = np.stack([np.where(rng.random(20_000) < p, np.where(truth, 1, -1), np.where(truth, -1, 1)) for p in (0.95, 0.8, 0.7, 0.9, 0.6)], axis=1)
    patterns, inverse, counts = np.unique(given, axis=0, return_inverse=True, return_counts=True)
    true, tables = pii.estimate(patterns, counts.astype(float))
    assert np.abs(tables[:, 1, 2] - [0.95, 0.8, 0.7, 0.9, 0.6]).max() < 0.03
    assert ((true[inverse.ravel()] > 0.5) == truth).mean() > 0.95


# -- quality


def test_quality_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = {r.doc_id: r.kept for r in quality.score(docs, labels.filter("doc_id % 3 <> 0")).collect()}
    unseen = [(r.quality == 1, found[r.doc_id]) for r in labels.filter("doc_id % 3 = 0").collect()]
    assert len(found) == 1000
    assert np.mean([a == b for a, b in unseen]) > 0.95
    assert np.mean([b for a, b in unseen if a]) > 0.97


def plain_strengths(by, rate):
    """Analysis of variance of documents within paths within hosts; by: (host, path) -> probabilities."""
    n = sum(map(len, by.values()))
    hosts = {}
    for (h, _), own in by.items():
        hosts.setdefault(h, []).extend(own)
    mean = {h: sum(v) / len(v) for h, v in hosts.items()}
    every = sum(sum(v) for v in hosts.values()) / n

    def strength(around, between, within, free, weight):
        if weight <= 0 or free <= 0 or within is None:
            return 1e4
        return min(max(around * (1 - around) / max((between - within * free) / weight, 1e-9) - 1, 1.0), 1e4)

    in_hosts = sum((p - mean[h]) ** 2 for h, v in hosts.items() for p in v) / (n - len(hosts)) if n > len(hosts) else None
    in_paths = sum((p - sum(v) / len(v)) ** 2 for v in by.values() for p in v) / (n - len(by)) if n > len(by) else None
    k_host = strength(rate, sum(len(v) * (mean[h] - every) ** 2 for h, v in hosts.items()), in_hosts, len(hosts) - 1, n - sum(len(v) ** 2 for v in hosts.values()) / n)
    around = 0.5 + max(0.25 - rate * (1 - rate) * k_host / (k_host + 1), 0) ** 0.5
    weight = n - sum(len(v) ** 2 / len(hosts[h]) for (h, _), v in by.items())
    k_path = strength(around, sum(len(v) * (sum(v) / len(v) - mean[h]) ** 2 for (h, _), v in by.items()), in_paths, len(by) - len(hosts), weight)
    return k_host, k_path


def check_rates(found, chance):
    """Rates and posteriors against a plain version; chance: the probability that each row counts with."""
    by, hosts = {}, {}
    for r in found:
        by.setdefault((r.host, r.path), []).append(chance(r))
        hosts.setdefault(r.host, []).append(chance(r))
    total = [p for own in by.values() for p in own]
    rate = min(max(sum(total) / len(total), 1e-3), 1 - 1e-3)
    k_host, k_path = plain_strengths(by, rate)
    for r in found:
        p, own, host = chance(r), by[r.host, r.path], hosts[r.host]
        assert r.host_rate == pytest.approx((sum(host) - p + k_host * rate) / (len(host) - 1 + k_host), rel=1e-6)
        path_rate = (sum(own) - p + k_path * r.host_rate) / (len(own) - 1 + k_path)
        assert r.path_rate == pytest.approx(path_rate, rel=1e-6)
        bounded = min(max(path_rate, 0.02), 0.98)
        odds = np.exp(r.evidence) * bounded / (1 - bounded)
        assert r.posterior == pytest.approx(odds / (1 + odds), rel=1e-6) and r.kept == (r.posterior >= 0.5)
    return k_host, k_path


def test_quality_rates(spark, awkward, none):
    """Without a usable model the posterior is the shrunk rate of labels and priors."""
    labels = spark.createDataFrame([(6, 1), (8, 1), (9, None), (None, 1), (99, 0)], "doc_id long, quality int")
    found = quality.score(awkward, labels).collect()
    assert len(found) == len(AWKWARD) and all(r.evidence == 0.0 for r in found)
    assert all(0 < r.path_rate < 1 and r.kept for r in found)
    check_rates(found, lambda r: 1.0 if r.doc_id in (6, 8) else 0.5)
    assert quality.score(none, labels).count() == 0
    assert all(r.kept for r in quality.score(awkward, labels.filter("false")).collect())


def test_quality_rates_given(spark):
    """Several paths a host, evidence of a fitted model, labels for a part."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{n}.parquet") for n in ("documents", "labels"))
    found = quality.score(docs, labels).collect()
    known = {r.doc_id: float(r.quality) for r in labels.collect()}
    held = [known[i] for i in known if i in {r.doc_id for r in found}]
    prior = np.log(np.mean(held) / (1 - np.mean(held)))
    check_rates(found, lambda r: known.get(r.doc_id, 1 / (1 + np.exp(-(r.evidence + prior)))))
    assert len({(r.host, r.path) for r in found}) > 2 * len({r.host for r in found})


def test_quality_of_pages(spark):
    """Hosts and paths from addresses."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    host, path = quality.host_and_path(pages["url"])
    sites = pages.select("page_id", "html", host.alias("host"), path.alias("path"))
    labels = sites.selectExpr("page_id", "page_id % 2 AS quality")
    named = [table.withColumnRenamed("page_id", "doc_id") for table in (sites, labels)]
    found = quality.score(*named, text="html", host="host", path="path").collect()
    assert len(found) == pages.count() and all(r.host for r in found)
    check_rates(found, lambda r: float(r.doc_id % 2))


@pytest.mark.parametrize("size", [2, 3, 20])
def test_quality_strength_of_drawn_sites(spark, size):
    """Sparse sites drawn from a prior of known strength, hosts and paths: both strengths are found again."""
    rng = np.random.default_rng(size)
    hosts = 20_000
    rate = np.repeat(rng.beta(5 * 0.7, 5 * 0.3, hosts), 2)
    good = rng.binomial(size, rng.beta(8 * rate, 8 * (1 - rate)))
    sites = spark.createDataFrame([(i // 2, i, size, float(s), float(s)) for i, s in enumerate(good.tolist())], "h long, w long, n long, s double, q double")
    k_host, k_path = quality.strengths(sites, good.mean() / size)
    # what a path adds to a host's own spread counts as the documents' when hosts are compared
    assert k_path == pytest.approx(8, rel=0.15)
    pooled = spark.createDataFrame([(i, 0, size, float(s), float(s)) for i, s in enumerate(rng.binomial(size, rng.beta(3.5, 1.5, 40_000)).tolist())], "h long, w long, n long, s double, q double")
    assert quality.strengths(pooled, 0.7)[0] == pytest.approx(5, rel=0.1)


# -- lines


def test_lines_awkward(spark, awkward, none):
    rows = [(i, f" shared line \nown {i}\n\n near \n shared line", f"s{i}") for i in range(12)] + [(20, None, "a"), (21, "", "b"), (22, "shared line", None), (0, " shared line \nown 0\n\n near \n shared line", "s0")]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, text string, source string, line string, n_removed string")
    out = lines.remove_spread_lines(table, min_sites=10)
    found = sorted(((r.doc_id, r.n_lines, r.n_removed, r.text, r.line) for r in out.collect()), key=key)
    want = [(i, 5, 3, f"own {i}\n", "x") for i in [*range(12), 0]] + [(20, 0, 0, None, "x"), (21, 1, 0, "", "x"), (22, 1, 1, "", "x")]
    assert found == sorted(want, key=key)
    assert lines.remove_spread_lines(table, min_sites=13).filter("n_removed > 0").count() == 0
    assert lines.remove_spread_lines(awkward).count() == len(AWKWARD) and lines.remove_spread_lines(none).count() == 0


def test_lines_near_the_limit_are_exact(spark):
    rows = [(s, f"a{s % 2}\nline {n}", f"site{s}") for n in (19, 20, 21) for s in range(n)]
    table = spark.createDataFrame([(i, t, s) for i, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    gone = lines.remove_spread_lines(table, min_sites=20, lg_k=4).filter("text not like '%line%'").count()
    assert gone == 41


def test_lines_run_no_python(spark, docs):
    plan = lines.remove_spread_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# -- tiling


def test_tiles():
    random.seed(2)
    for _ in range(400):
        item = random.choices("abc", k=random.randint(3, 18))
        text = random.choices("abcd", k=random.randint(0, 25))
        n = random.randint(2, 4)
        codes = [np.array([ord(c) for c in x], np.uint64) for x in (text, item)]
        found = list(tiling.Seeds([(7, codes[1])], n).compare(codes[0], 0.0))
        want = plain.tiling(text, item, n)
        assert (found[0][2] if found else 0) == want


def test_contaminated(spark, docs, rows):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    want = {(i, j) for i, t in rows for j, u in map(tuple, items.collect()) if (w := plain.words(u)) and plain.shingles(t) & plain.shingles(u) and plain.tiling(plain.words(t), w, 5) >= 0.8 * len(w)}
    for bound in (1 << 20, 0):
        found = {(r.doc_id, r.item_id) for r in tiling.contaminated(docs, items, broadcast_words=bound).collect()}
        assert found == want and want


def test_contaminated_awkward(spark, awkward, none):
    first, second = " ".join(PASSAGE.split()[:40]), " ".join(PASSAGE.split()[40:])
    items = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "one two three four"), (None, PASSAGE), (4, PASSAGE.upper()), (1, "zz yy xx ww vv uu")], "item_id long, text string")
    more = awkward.select("doc_id", "text").union(spark.createDataFrame([(30, f"{second} in between {first}"), (31, first)], "doc_id long, text string"))
    want = sorted([(i, j) for i in (6, 7, 7, 8, 16, 30, None) for j in (1, 4)], key=key)
    for bound in (1 << 20, 0):
        found = tiling.contaminated(more, items, broadcast_words=bound).select("doc_id", "item_id").collect()
        assert sorted(map(tuple, found), key=key) == want
        assert tiling.contaminated(none, items, broadcast_words=bound).count() == 0
        assert tiling.contaminated(more, items.filter("false"), broadcast_words=bound).count() == 0


def test_contaminated_shared_phrases(spark):
    """Texts and items that share one phrase and no more: joined by count, no pair moves a body."""
    phrase = "what is the answer to"
    texts = [(i, f"text {i} says {phrase} a{i} b{i} c{i} d{i}") for i in range(60)] + [(100, f"{phrase} x1 y1 z1 u1 v1"), (101, f"{phrase} x2 y2 z2 u2 v2 and x2")]
    items = [(j, f"{phrase} x{j} y{j} z{j} u{j} v{j}") for j in range(40)]
    tables = spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for bound in (1 << 20, 0):
        assert sorted(tuple(r)[:1] + (r.item_id,) for r in tiling.contaminated(*tables, broadcast_words=bound).collect()) == [(100, 1), (101, 2)]


# -- WARC


def expected_records(rows):
    largest = {}
    for i, body in rows:
        if i is not None:
            largest[body] = max(largest.get(body, i), i)
    out = []
    for i, body in rows:
        response = largest.get(body, i) == i
        out.append((i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if response else "revisit", None if response else largest[body]))
    return sorted(out, key=key)


def test_warc_round_trip(spark):
    rows = [(1, "http://u", "a"), (2, "u\n x", "a"), (2, "u", "a"), (None, "n", "a"), (None, None, None), (3, "z", ""), (3, "z", "b\r\n\r\nc"), (4, None, None), (9, "l", "é" * 90_000)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, shard string")
    folders = [scratch_path(spark, "warc") for _ in range(2)]
    names = [warc.write_archives(t, f, shard_bytes=900, file_bytes=500) for t, f in ((table, folders[0]), (table.repartition(3), folders[1]))]
    assert names[0] == names[1] and len(names[0]) > 3
    paths = [f.removeprefix("file://") for f in folders]
    assert all(open(f"{paths[0]}/{n}", "rb").read() == open(f"{paths[1]}/{n}", "rb").read() for n in names[0])
    assert gzip.open(f"{paths[0]}/{names[0][0]}").read().startswith(b"WARC/1.1\r\n")
    found = warc.read_archives(spark, folders[0], with_payload=True)
    assert sorted((tuple(r)[:5] for r in found.collect()), key=key) == expected_records([(i, (h or "").encode()) for i, _, h in rows])
    assert {bytes(r.payload) for r in found.filter("record_type = 'response'").collect()} == {(h or "").encode() for _, _, h in rows}
    # files that no manifest names are not read
    open(f"{paths[0]}/shard-999999-00000.warc.gz", "wb").write(b"cut off")
    assert warc.read_archives(spark, folders[0]).count() == len(rows)


def test_warc_short_payloads_and_no_rows(spark):
    table = spark.createDataFrame([(1, "u", "abc"), (2, "u", "abc"), (3, "u", "long enough"), (4, "u", "long enough")], "page_id long, url string, html string")
    folder = scratch_path(spark, "warc")
    warc.write_archives(table, folder, min_revisit=5)
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in warc.read_archives(spark, folder).collect() if r.refers_to) == [(3, "revisit", 4)]
    empty = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    assert warc.write_archives(table.filter("false"), empty) == []
    assert warc.read_archives(spark, empty).count() == 0


# -- language model


def test_ppm_base_scores(spark, docs, rows, awkward, none):
    found = {r.doc_id: r for r in ppm.score(docs).collect()}
    for i, (tokens, known, total, score) in plain.unigrams(rows).items():
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (tokens, known, total, plain.held_out(i))
        assert r.base_score == pytest.approx(score)
    again = {r.doc_id: r for r in ppm.score(docs, support=6).collect()}  # most words and strings go the other way
    assert all(again[i].base_score == pytest.approx(r.base_score) and again[i].n_known == r.n_known for i, r in found.items())
    assert ppm.score(awkward).count() == len(AWKWARD) and ppm.score(none).count() == 0


@pytest.mark.parametrize("support", [20, 9])
def test_ppm_scores(spark, docs, rows, support):
    model = plain.Ppm([t for i, t in rows if not plain.held_out(i)], 3, 2.0**-support)
    found = {r.doc_id: r.score for r in ppm.score(docs, order=3, support=support).collect()}
    for i, t in [r for r in rows if len(r[1] or "") < 3000][:40]:
        assert found[i] == pytest.approx(model.text(t))
    assert sum(10 ** model.symbol(b"the", s) for s in range(256)) == pytest.approx(1)


@pytest.mark.parametrize("common", [22, 9])
def test_ppm_counts_rare_strings_of_large_texts(spark, common):
    """Three million bytes of one sentence: strings that occur once or twice are under 1 / 2**20 of them."""
    held = [i for i in range(200) if plain.held_out(i)]
    texts = {i: "the same words over and over " * 500 for i in range(240) if i not in held}
    texts |= {i: f"quartz {i} jumbo vex " * (1 + i % 3) for i in [*range(300, 312), *held[:6]]}
    model = plain.Ppm([t for i, t in texts.items() if not plain.held_out(i)], 3, 0.0)
    found = {r.doc_id: r.score for r in ppm.score(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), order=3, common=common).collect()}
    assert all(found[i] == pytest.approx(model.text(t)) for i, t in texts.items() if len(t) < 3000)


# -- suffixes


def test_sorted_suffixes():
    random.seed(1)
    for _ in range(300):
        data = np.array([random.choice([97, 98, 98, 255]) for _ in range(random.randint(1, 60))] + [255], np.uint8)
        held = data.tobytes()
        assert suffixes.sorted_suffixes(data, 100).tolist() == sorted(range(len(held)), key=lambda i: held[i:])


@pytest.mark.parametrize(("length", "sort_classes"), [(400, 4096), (60, 4096), (60, 2)])
def test_repeats(spark, docs, rows, length, sort_classes):
    want = dict(zip([i for i, _ in rows], plain.repeats([t for _, t in rows], length), strict=True))
    found = suffixes.remove_repeats(docs, length, sort_classes=sort_classes)
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want
    assert any(n for _, n, _, _ in want.values())


def test_repeats_awkward(spark, awkward, none):
    want = sorted(((i, *found) for (i, _), found in zip(AWKWARD, plain.repeats([t for _, t in AWKWARD], 400), strict=True)), key=key)
    assert sorted(map(tuple, suffixes.remove_repeats(awkward).collect()), key=key) == want
    assert suffixes.remove_repeats(none).count() == 0


def test_long_texts_in_segments(spark, monkeypatch):
    random.seed(4)
    body = "".join(random.choices("abcdefgh ", k=9000))
    table = spark.createDataFrame([(1, body), (2, body[3000:8500]), (3, body[100:900] + "?" + body[100:900])], "doc_id long, text string").coalesce(1)
    want = plain.repeats([r.text for r in table.orderBy("doc_id").collect()], 400)
    monkeypatch.setattr(suffixes, "_SEGMENT", 1000)
    spans = [r for r in suffixes.regions(np.frombuffer(body.encode(), np.uint8), 400, 160)]
    assert len(spans) == 9
    assert [tuple(r)[1:] for r in suffixes.remove_repeats(table).orderBy("doc_id").collect()] == want


# -- BPE


def encoded(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    said = tokenizer.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest(), ids, said


@pytest.mark.parametrize("chunk_bytes", [64, 2048])
def test_bpe(spark, docs, rows, awkward, none, chunk_bytes):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary())
    found = {r.doc_id: tuple(r)[1:] for r in bpe.encode(docs, vocabulary(), chunk_bytes=chunk_bytes).collect()}
    assert found == {i: encoded(tokenizer, t)[:3] for i, t in rows}
    got = sorted((tuple(r) for r in bpe.encode(awkward, vocabulary(), chunk_bytes=chunk_bytes, keep_ids=True).collect()), key=key)
    assert got == sorted(((i, *encoded(tokenizer, t)) for i, t in AWKWARD), key=key)
    assert bpe.encode(none, vocabulary()).count() == 0


def test_bpe_joins_grow_until_they_agree():
    """Ids that do not fit their text are not taken over."""
    encoder = bpe.WordEncoder(vocabulary())
    text = b"some words stand here, and others there at the end"
    a, b = bpe.inner(text[5:40])
    right = np.array(encoder.ids(text[5:40][a:b]), np.uint16)
    assert bpe.joined(encoder, text, [(5, 40, right)]) == encoder.ids(text)
    assert bpe.joined(encoder, text, [(5, 40, right + 1)]) == encoder.ids(text)


def test_chunks_follow_content():
    random.seed(6)
    body = "".join(random.choices("abcdefgh ", k=60_000)).encode()
    one, two = (np.frombuffer(x, np.uint8) for x in (body, b"some bytes before" + body))
    assert set(bpe.cuts(one, 512)[1:] + 17) == set(bpe.cuts(two, 512)[1:])


# -- MinHash


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates(spark, docs, rows, percent):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, percent).collect()}
    assert found == plain.near_duplicates(rows, percent)


def test_near_duplicates_chains(spark):
    """Links that only pairs from different first comparisons show, and copies of each."""
    random.seed(8)
    base = [f"w{i}" for i in range(400)]
    texts = []
    for i in range(60):
        own = list(base)
        for j in range(4 * i, 4 * i + 8):  # neighbours are alike, the ends are not
            own[j % 400] = f"n{i}-{j}"
        texts.append(" ".join(own))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(2000 + i, t.upper()) for i, t in enumerate(texts[:10])]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(table, 85).collect()}
    assert found == plain.near_duplicates(rows, 85)


def test_near_duplicates_awkward(spark, awkward, none):
    found = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(awkward, 80).collect()), key=key)
    same = {6: 6, 7: 6, 8: 6, 16: 6, 10: 9, 15: 5}
    want = []
    for i, t in AWKWARD:
        component = (6 if t else None) if i is None else same.get(i, i)
        want.append((i, len(plain.shingles(t)), component, i == component))
    assert found == sorted(want, key=key)
    assert minhash.near_duplicates(none).count() == 0


def test_bounds():
    for threshold in (0.8, 0.85):
        rows, n = minhash.bands(threshold)
        assert (1 - threshold**rows) ** n <= minhash.MISS < (1 - threshold ** (rows + 1)) ** (minhash.HASHES // (rows + 1))
    least = [m / n for n, m in minhash.least_matches(0.85)]
    assert least == sorted(least) and least[-1] < 0.85


def test_model_of_classes_far_apart():
    """Separable classes and nearly constant columns: full Newton steps would run away."""
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.86).astype(float)
    x = np.column_stack([np.where(y > 0, 0.0, rng.choice([0.2, 0.5], 4000)), rng.random((4000, 40)) * 1e-3, np.zeros((4000, 60)), np.where(rng.random(4000) < 0.001, 1.0, 0.0)])
    evidence = quality.Model(x, y).evidence(x)
    assert ((evidence > 0) == (y > 0)).mean() > 0.999
