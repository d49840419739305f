"""Quality rules as weak supervision, with DataFrame and SQL functions only.

1. Every text is measured where it is read: words, symbols, repeated lines, words in repeated windows, and so on.
2. Each rule votes on a document, for (1) or against (-1), or abstains (0) where the measure says nothing.
3. Expectation-maximisation estimates how often each rule is right about good and about bad documents, from the
   agreement of the rules alone; no label is read. Its data are the counts of the votes that occur (at most 3 to the
   power of the number of rules rows): each round is one aggregation over that table, from which only the new
   parameters, a few numbers per rule, come back. Documents that fail the base rule below are settled and not learnt from.
4. A document's posterior probability of being good joins the votes by these accuracies. It replaces the demand that
   all rules pass: `kept` is posterior >= THRESHOLD. Base rule: documents of fewer than MIN_WORDS words, or with more than
   REPEAT_PERCENT of all words in repeated windows, are not kept.

A rule's votes never count against their own sense: estimates are bounded so that a vote for a document speaks for it.
Symmetric counts are added to all estimates (PRIOR documents each), so that tables of a few rows give finite weights.

Null texts have no words; nor have empty ones. Very long texts are measured whole; only texts in which two windows have
equal hashes sort their windows as strings. A posterior equal to the threshold keeps. Repeated rows and rows with
repeated or null ids are measured and counted each. Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vetline.session import materialize

WINDOW = 8  # a power of two
MIN_WORDS = 20
REPEAT_PERCENT = 30
THRESHOLD = 0.5
PRIOR = 2.0
ROUNDS = 60
START = {"good": 0.75, "rule": 0.75}
_GOOD, _BAD = "__good_weight", "__bad_weight"
_BLANKS = r"\x20\x09-\x0D"


def _count(characters: str) -> Column:
    """How many characters of this class the text holds; runs of others go in one step each."""
    return F.length(F.regexp_replace("body", f"[^{characters}]+", ""))


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))


def measures(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: doc_id and the measures of its whole text (long).

    Words in repeated windows: equal windows have equal hashes, so texts whose hashes are distinct have none. In the
    others the windows themselves are sorted with their places; a window equal to a neighbour there occurs again, and
    covers the words up to the next such window, WINDOW at most.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("body"))
    words = rows.select(
        "doc_id",
        F.filter(F.split("body", f"[{_BLANKS}]+"), lambda word: word != "").alias("words"),
        F.filter(F.split("body", "\n"), lambda line: line.rlike(f"[^{_BLANKS}]")).alias("lines"),
        F.length(F.regexp_replace("body", f"[{_BLANKS}]+", "")).alias("word_chars"),
        _count("#*$%&|<>").alias("n_symbols"),
        _count("A-Z").alias("n_upper"),
        _count(r"\p{L}").alias("n_letters"),
        _count(".!?,;:").alias("n_points"),
        F.regexp_count("body", F.lit(rf"(?<![^{_BLANKS}])\p{{L}}+[.,;:!?]?(?![^{_BLANKS}])")).alias("n_plain"),
    )
    # hashes of two, four and eight words from neighbours in one pass each: time follows the length of the text
    hashed = words.withColumn("hashes", F.transform("words", lambda word: F.xxhash64(word)))
    hashed = hashed.withColumn("windows", F.col("hashes"))
    for step in (1, 2, 4):
        behind = F.slice("windows", F.lit(step + 1), F.greatest(F.size("windows") - step, F.lit(0)))
        hashed = hashed.withColumn("windows", F.zip_with("windows", behind, lambda own, other: F.xxhash64(own, other)))
    hashed = hashed.withColumn("windows", F.when(F.size("words") > WINDOW, F.slice("windows", F.lit(1), F.size("words") - (WINDOW - 1))))
    starts = F.sequence(F.lit(0), F.size("words") - WINDOW)
    # word by word: to slice an array copies all of it
    placed = F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *[F.get("words", i + k) for k in range(WINDOW)]).alias("window"), i.alias("at")))
    ordered = hashed.withColumn("ordered", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(placed)))

    def again(own: Column, i: Column) -> Column:
        before, after = F.get(F.col("ordered"), i - 1), F.get(F.col("ordered"), i + 1)
        return F.when(own["window"].eqNullSafe(before["window"]) | own["window"].eqNullSafe(after["window"]), own["at"])

    repeated = ordered.withColumn("at", F.sort_array(F.array_compact(F.transform("ordered", again))))
    covered = F.transform("at", lambda at, i: F.coalesce(F.least(F.get(F.col("at"), i + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)))
    counts = {
        "n_words": F.size("words"),
        "word_chars": F.col("word_chars"),
        "n_symbols": F.col("n_symbols"),
        "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")),
        "n_repeat_words": F.coalesce(F.aggregate(covered, F.lit(0), lambda total, n: total + n), F.lit(0)),
        "n_upper": F.col("n_upper"),
        "n_letters": F.col("n_letters"),
        "n_points": F.col("n_points"),
        "n_plain": F.col("n_plain"),
        "n_lines": F.size("lines"),
        "n_ended": F.size(F.filter("lines", lambda line: line.rlike(rf"[.!?][{_BLANKS}]*\z"))),
        "n_kinds": F.size(F.array_distinct("hashes")),
    }
    return repeated.select("doc_id", *[value.cast("long").alias(name) for name, value in counts.items()])


def rules() -> dict[str, Column]:
    """Each rule's vote by its name: 1 for the document, -1 against it, 0 where it abstains."""

    def vote(good: Column, bad: Column) -> Column:
        return F.when(F.col("n_words") == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    word, symbols, points = _share("word_chars", "n_words"), _share("n_symbols", "n_words"), _share("n_points", "n_words")
    again, copies = _share("n_repeat_words", "n_words"), _share("n_dup_lines", "n_lines")
    upper, ended, kinds = _share("n_upper", "n_letters"), _share("n_ended", "n_lines"), _share("n_kinds", "n_words")
    plain, letters = _share("n_plain", "n_words"), _share("n_letters", "word_chars")
    # a long text repeats more of its words
    fresh = kinds * F.sqrt(F.col("n_words") / 100)
    return {
        "length": vote(F.col("n_words") >= 50, F.col("n_words") < 10),
        "word_size": vote((word >= 3.5) & (word <= 8), (word < 2) | (word > 14)),
        "symbols": vote(symbols == 0, symbols > 0.1),
        "points": vote((points >= 0.05) & (points <= 0.4), (points < 0.01) | (points > 1)),
        "repeats": vote(again <= 0.1, again > REPEAT_PERCENT / 100),
        "line_copies": vote(copies <= 0.1, copies > 0.3),
        "upper": vote(upper <= 0.15, upper > 0.4),
        "line_ends": vote(ended >= 0.6, ended < 0.1),
        "plain_words": vote(plain >= 0.8, plain < 0.6),
        "letters": vote(letters >= 0.9, letters < 0.8),
        "vocabulary": vote(fresh >= 0.3, fresh < 0.1),
    }


def _odds(good: float, right: dict[str, tuple[float, float]]) -> Column:
    """Log odds of a good document from its votes; an abstention says nothing."""
    total = F.lit(math.log(good / (1 - good)))
    for name, (on_good, on_bad) in right.items():
        for_, against = math.log(on_good / (1 - on_bad)), math.log((1 - on_good) / on_bad)
        total = total + F.when(F.col(name) > 0, for_).when(F.col(name) < 0, against).otherwise(0.0)
    return total


def _chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def fit(votes: DataFrame, names: list[str], rounds: int = ROUNDS, prior: float = PRIOR) -> tuple[float, dict[str, tuple[float, float]]]:
    """Share of good documents, and by rule how often its votes are right about good and about bad documents.

    votes: a row per pattern of votes with its count n. One aggregation a round.
    """
    good, right = START["good"], dict.fromkeys(names, (START["rule"], START["rule"]))
    for _ in range(rounds):
        p = _chance(_odds(good, right))
        weighed = votes.select("*", (F.col("n") * p).alias(_GOOD), (F.col("n") * (1 - p)).alias(_BAD))
        sums = [F.sum(_GOOD).alias("good"), F.sum(_BAD).alias("bad")]
        for i, name in enumerate(names):
            sums += [
                F.sum(F.when(F.col(name) > 0, F.col(_GOOD)).otherwise(0.0)).alias(f"gr{i}"),
                F.sum(F.when(F.col(name) != 0, F.col(_GOOD)).otherwise(0.0)).alias(f"gv{i}"),
                F.sum(F.when(F.col(name) < 0, F.col(_BAD)).otherwise(0.0)).alias(f"br{i}"),
                F.sum(F.when(F.col(name) != 0, F.col(_BAD)).otherwise(0.0)).alias(f"bv{i}"),
            ]
        found = weighed.agg(*sums).first()
        before, right = (good, right), {}
        good = ((found["good"] or 0.0) + prior) / ((found["good"] or 0.0) + (found["bad"] or 0.0) + 2 * prior)
        for i, name in enumerate(names):
            on_good = ((found[f"gr{i}"] or 0.0) + prior * START["rule"]) / ((found[f"gv{i}"] or 0.0) + prior)
            on_bad = ((found[f"br{i}"] or 0.0) + prior * START["rule"]) / ((found[f"bv{i}"] or 0.0) + prior)
            # a vote must not speak against its own sense
            short = max(0.0, 1 - on_good - on_bad) / 2
            right[name] = (on_good + short, on_bad + short)
        if abs(good - before[0]) < 1e-6 and all(abs(x - y) < 1e-6 for name in names for x, y in zip(right[name], before[1][name], strict=True)):
            break
    return good, right


def judge(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", votes: dict[str, Column] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, its measures, a vote_<rule> each, base_failed, posterior, kept."""
    ballot = {f"vote_{name}": vote for name, vote in (rules() if votes is None else votes).items()}
    measured = materialize(measures(docs, text, doc_id).select("*", *[vote.cast("int").alias(name) for name, vote in ballot.items()]), "measures")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    measured = measured.withColumn("base_failed", failed)
    patterns = materialize(measured.filter("not base_failed").groupBy(*ballot).agg(F.count("*").alias("n")), "votes")
    good, right = fit(patterns, list(ballot))
    return measured.withColumn("posterior", _chance(_odds(good, right))).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
