"""Quality classifier with hierarchical empirical Bayes over sites.

1. A logistic regression over the shares of byte values and a few sizes gives each document's own evidence,
   as log odds less the log odds of the labelled rows it was fitted on. It is fitted on at most `fit_rows`
   labelled rows, those with the smallest hash of their id; where one class is missing, all evidence is 0.
2. Sites are hosts and, within them, paths. A site's evidence is the sum of its documents' probabilities (of
   labels, where there are some), from grouped aggregation. Beta priors are fitted by analysis of variance: the
   spread of host rates around the global rate, and of path rates around their host's, beyond that of the documents
   within them.
   A host's posterior rate shrinks to the global rate, a path's to its host's, the more the fewer documents.
3. A document's posterior joins its own evidence with its path's rate as prior. The rate leaves the document
   itself out and stays within RATE_BOUNDS, so that no site condemns or clears its documents alone.

The columns `source` and `lang` stand in for host and path where a table has no address; `host_and_path` takes both
from one. Null and empty texts have no evidence and get their site's rate. A posterior equal to the threshold keeps.
Long texts are read whole, slice by slice. Null hosts and paths are sites of their own.
Null, repeated or unknown ids in labels: null labels are ignored, several labels of an id are averaged, ids
without a document are ignored. Repeated rows count each. Tables without rows give no rows, without labels
everything is kept at a rate of 1/2. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.llm.kernels import slices, words
from vetline.session import materialize

FIT_ROWS = 20_000
THRESHOLD = 0.5
RATE_BOUNDS = (0.02, 0.98)
EVIDENCE_BOUND = 12.0
STRENGTH_BOUNDS = (1.0, 1e4)


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of features per text: square roots of byte shares, word and line sizes."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(n), sizes)
    counts = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
    starts, ends, first = words(data, offsets)
    n_words = np.diff(first)
    length = np.bincount(np.repeat(np.arange(n), n_words), ends - starts, n) / np.maximum(n_words, 1)
    upper = counts[:, 65:91].sum(axis=1) / np.maximum(counts[:, 97:123].sum(axis=1) + counts[:, 65:91].sum(axis=1), 1)
    lines = (counts[:, 10] + 1) / np.maximum(n_words, 1)
    shares = np.sqrt(counts / np.maximum(sizes, 1)[:, None])
    return np.column_stack([shares, np.log1p(length), upper, np.log1p(lines), np.log1p(n_words) / 10])


class Model:
    """Logistic regression with standardised features, fitted by damped Newton steps with a ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25):
        self.usable = len(y) > 0 and 0 < y.mean() < 1
        if not self.usable:
            return
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-9

        def loss(b: np.ndarray) -> float:
            margin = z @ b
            return float((np.logaddexp(0, margin) - y * margin).sum() + 0.5 * (penalty * b * b).sum())

        beta = np.zeros(z.shape[1])
        now = loss(beta)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
            grad = z.T @ (p - y) + penalty * beta
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), grad)
            # a full step can overshoot where classes lie far apart: halve it until the loss falls
            size = 1.0
            while size > 1e-6 and not (after := loss(beta - size * step)) < now:
                size /= 2
            if size <= 1e-6:
                break
            beta, gained, now = beta - size * step, now - after, after
            if gained < 1e-6 * max(now, 1.0):
                break
        self.beta = beta
        self.prior = float(np.log(y.mean() / (1 - y.mean())))

    def evidence(self, x: np.ndarray) -> np.ndarray:
        if not self.usable:
            return np.zeros(len(x))
        z = np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])
        return np.clip(z @ self.beta - self.prior, -EVIDENCE_BOUND, EVIDENCE_BOUND)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(1)):
            found = features(data, offsets).astype(np.float32)
            values = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * found.shape[1]), pa.array(found.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), values], ["label", "x"])


def _evidence(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, data, offsets in slices(batch.column(4), 1 << 20):
            found = model.value.evidence(features(data, offsets))
            found[np.diff(offsets) == 0] = 0.0
            yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(lo, hi - lo) for i in range(4)), pa.array(found)], ["doc_id", "mark", "host", "path", "evidence"])


def _strength(rate: float, between: float, within: float, groups: float, weight: float) -> float:
    """Strength of a Beta prior around `rate` from the analysis of variance of its groups.

    between: sum over groups of n (mean - mean of all)**2; within: variance of single documents in their group;
    groups: how many means are free; weight: sum of n less its share that the mean of all takes up.
    """
    if weight <= 0 or groups <= 0 or not np.isfinite(within):
        return STRENGTH_BOUNDS[1]
    spread = max((between - within * groups) / weight, 1e-9)
    return float(np.clip(rate * (1 - rate) / spread - 1, *STRENGTH_BOUNDS))


def strengths(sites: DataFrame, rate: float) -> tuple[float, float]:
    """Strengths of the priors of hosts around all and of paths around their host.

    sites: h, w, n, s, q a path: documents, sum of their probabilities and of the squares. The spread of observed
    means is that of the true rates plus the documents' own, which is measured within hosts and paths; so soft
    probabilities, which vary less than labels, need no other rule.
    """
    hosts = sites.groupBy("h").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("n") ** 2).alias("n2"), F.count("*").alias("paths"), F.sum(F.col("s") ** 2 / F.col("n")).alias("fit"))
    mean = F.col("s") / F.col("n")
    all_ = hosts.agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") ** 2).alias("n2"),
        F.count("*").alias("hosts"),
        F.sum("paths").alias("paths"),
        F.sum("q").alias("q"),
        F.sum("fit").alias("path_fit"),
        F.sum(mean * F.col("s")).alias("host_fit"),
        F.sum("s").alias("s"),
        F.sum(F.col("n") - F.col("n2") / F.col("n")).alias("path_weight"),
        F.sum(F.col("s") * (1 - mean)).alias("host_variance"),
    ).first()
    if not all_["n"]:
        return STRENGTH_BOUNDS[1], STRENGTH_BOUNDS[1]
    n, hosts_n, paths_n = all_["n"], all_["hosts"], all_["paths"]
    in_hosts = (all_["q"] - all_["host_fit"]) / (n - hosts_n) if n > hosts_n else np.nan
    in_paths = (all_["q"] - all_["path_fit"]) / (n - paths_n) if n > paths_n else np.nan
    k_host = _strength(rate, all_["host_fit"] - all_["s"] ** 2 / n, in_hosts, hosts_n - 1, n - all_["n2"] / n)
    # the rates of paths spread around those of their hosts
    variance = rate * (1 - rate) * k_host / (k_host + 1)
    around = 0.5 + float(np.sqrt(max(0.25 - variance, 0.0)))
    k_path = _strength(around, all_["path_fit"] - all_["host_fit"], in_paths, paths_n - hosts_n, all_["path_weight"])
    return k_host, k_path


def host_and_path(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host and first path segment of an address."""
    return F.try_parse_url(url, F.lit("HOST")), F.regexp_extract(F.try_parse_url(url, F.lit("PATH")), "^/[^/]*", 0)


def score(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", host: str = "source", path: str = "lang", label: str = "quality", fit_rows: int = FIT_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, mark, host, path, evidence, host_rate, path_rate, posterior, kept.

    `label` is 1 for good documents and 0 for bad ones. `mark` is a 64-bit hash of the text.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("mark"),
        F.col(host).cast("string").alias("host"),
        F.col(path).cast("string").alias("path"),
        F.col(text).alias("body"),
    )
    known = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("double").alias("label")).dropna().groupBy("doc_id").agg(F.avg("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # an id that many rows repeat gives one row of the sample
    once = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("mark", "body")).alias("row"))
    sample = once.select("label", "row.body").mapInArrow(_features, "label double, x array<float>").toArrow()
    y = (sample.column(0).to_numpy() >= 0.5).astype(float)
    x = sample.column(1).combine_chunks().flatten().to_numpy().reshape(len(y), -1).astype(float) if len(y) else np.zeros((0, 0))
    model = spark.sparkContext.broadcast(Model(x, y))
    own = rows.mapInArrow(lambda it: _evidence(it, model), "doc_id long, mark long, host string, path string, evidence double")
    base = float(y.mean()) if model.value.usable else 0.5
    prior = float(np.log(base / (1 - base)))
    chance = F.coalesce("label", 1 / (1 + F.exp(-(F.col("evidence") + prior))))
    own = materialize(own.join(known, "doc_id", "left").withColumn("p", chance), "evidence")

    def named(column: str) -> F.Column:  # nulls are a site of their own
        return F.struct(F.col(column).isNull(), F.coalesce(column, F.lit("")))

    own = own.select("*", named("host").alias("h"), named("path").alias("w"))
    paths = own.groupBy("h", "w").agg(F.count("*").alias("n"), F.sum("p").alias("s"), F.sum(F.col("p") ** 2).alias("q"))
    hosts = paths.groupBy("h").agg(F.sum("n").alias("n_h"), F.sum("s").alias("s_h"))
    sites = materialize(paths.join(hosts, "h"), "sites")
    total = sites.agg(F.sum("n"), F.sum("s")).first()
    rate = float(np.clip(total[1] / total[0], 1e-3, 1 - 1e-3)) if total[0] else 0.5
    k_host, k_path = strengths(sites, rate)
    # without the document itself
    host_rate = (F.col("s_h") - F.col("p") + k_host * rate) / (F.col("n_h") - 1 + k_host)
    path_rate = (F.col("s") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    bounded = F.greatest(F.least("path_rate", F.lit(RATE_BOUNDS[1])), F.lit(RATE_BOUNDS[0]))
    return (
        own.join(sites, ["h", "w"])
        .withColumn("host_rate", host_rate)
        .withColumn("path_rate", path_rate)
        .withColumn("posterior", 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded))))))
        .select("doc_id", "mark", "host", "path", "evidence", "host_rate", "path_rate", "posterior", (F.col("posterior") >= threshold).alias("kept"))
    )
