"""Weak supervision of text quality: rules vote good or bad or abstain, and a label model weighs their votes.

Signals are built-in expressions over the whole text, computed once per document and stored narrow. Votes make at most
3 ** len(RULES) different patterns; Spark counts the documents of each, and expectation-maximisation over these
counts estimates how often each rule votes how on good documents and on each kind of bad ones. The posterior probability
of a good document is a built-in expression of its votes. No Python runs on the executors.

Bad documents come in kinds that differ in which rules see them, so the model has one bad class per rule beside the good
one, instead of one bad class in which rules would have to be independent. Whether a rule's kind is bad at all is left to
the other rules: where they find its documents more like good ones than like those of the other kinds, the kind counts as
good, and this rule alone rejects nothing.

Defined results: null text has no words and is rejected; equal texts get equal results; an empty table gives no
rows; other columns of the documents are not read, so they may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.materialize import checkpointed
from .rows import absent_name, content_key

SEPARATORS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
ENDS = r"[.!?:\"\x{2026}\x{3002}\x{FF01}\x{FF1F}][\x20\x09-\x0D]*\z"
LEAST_WORDS = 50
KEEP_AT = 0.5
ROUNDS = 60
START = {0: 0.95, 1: 0.3}  # the first guess that a document is good, by its number of bad votes; 0.05 from two on


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that stand twice or more in ``words``.

    Windows are compared by a 64-bit hash. Only texts with an equal pair sort theirs: equal hashes then are
    neighbours, and the starts of repeated windows in text order cover at most three words each.
    """
    def starts(sorted_windows: Column) -> Column:
        def has_twin(w: Column, i: Column) -> Column:
            return F.coalesce(F.get(sorted_windows, i - 1)["h"] == w["h"], F.lit(False)) | \
                F.coalesce(F.get(sorted_windows, i + 1)["h"] == w["h"], F.lit(False))
        marked = F.transform(sorted_windows, lambda w, i: F.when(has_twin(w, i), w["i"]))
        return F.array_sort(F.filter(marked, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        spans = F.transform(at, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - x, F.lit(3))))
        return F.aggregate(spans, F.lit(0), lambda total, x: total + x)

    def of_windows(windows: Column) -> Column:
        ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(
            let(let(ordered, starts), covered))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3),
                          lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(windows, of_windows))


def most_frequent(words: Column) -> Column:
    """How often the most frequent word stands in ``words``: the longest run of equal hashes in their order."""
    def longest(ordered: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(ordered) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return let(starts, lambda at: F.array_max(F.transform(
            at, lambda x, i: F.coalesce(F.get(at, i + 1), F.size(ordered)) - x)))

    hashed = F.sort_array(F.transform(words, lambda w: F.xxhash64(F.lower(w))))
    return F.when(F.size(words) == 0, F.lit(0)).otherwise(let(hashed, longest))


def signals(docs: DataFrame) -> DataFrame:
    """(doc_id, counts) of whole texts: words, their characters, symbols, lines, repetitions, capitals, marks, the most
    frequent word, lines that end a sentence, and characters that are no letters."""
    text = F.coalesce(docs["text"], F.lit(""))
    of_words = let(F.array_remove(F.split(text, SEPARATORS), ""), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).cast("long").alias("n_repeat_words"), most_frequent(w).cast("long").alias("n_top_word")))
    of_lines = let(F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), lambda l: F.struct(
        F.size(l).cast("long").alias("n_lines"), (F.size(l) - F.size(F.array_distinct(l))).cast("long").alias("n_dup_lines"),
        F.size(F.filter(l, lambda line: line.rlike(ENDS))).cast("long").alias("n_end_lines")))
    found = docs.select(docs["doc_id"], of_words.alias("w"), of_lines.alias("l"),
                        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
                        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
                        F.regexp_count(text, F.lit("[.!?]")).cast("long").alias("n_marks"),
                        F.regexp_count(text, F.lit(r"[^\p{L}\p{M}\x20\x09-\x0D]")).cast("long").alias("n_others"))
    return found.select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_lines", "l.n_dup_lines",
                        "w.n_repeat_words", "n_capitals", "n_marks", "n_others", "w.n_top_word", "l.n_end_lines")


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, good where ``good`` holds, else abstains."""
    name: str
    bad: Callable[[], Column]
    good: Callable[[], Column]


def _per_word(column: str) -> Column:
    return F.col(column) / F.greatest(F.col("n_words"), F.lit(1))


def _share(column: str, of: str) -> Column:
    return F.col(column) / F.greatest(F.col(of), F.lit(1))


RULES = (
    Rule("length", lambda: F.col("n_words") < LEAST_WORDS, lambda: F.col("n_words") >= 2 * LEAST_WORDS),
    Rule("symbols", lambda: _per_word("n_symbols") > 0.1, lambda: _per_word("n_symbols") < 0.02),
    Rule("repetition", lambda: _per_word("n_repeat_words") > 0.3, lambda: _per_word("n_repeat_words") < 0.05),
    Rule("lines", lambda: _share("n_dup_lines", "n_lines") > 0.3, lambda: (F.col("n_lines") > 0) & (F.col("n_dup_lines") == 0)),
    Rule("capitals", lambda: _share("n_capitals", "word_chars") > 0.1, lambda: _share("n_capitals", "word_chars") < 0.04),
    Rule("marks", lambda: _per_word("n_marks") > 0.3, lambda: _per_word("n_marks").between(0.02, 0.16)),
    Rule("word_length", lambda: ~_share("word_chars", "n_words").between(4.2, 6.5),
         lambda: _share("word_chars", "n_words").between(4.5, 5.8)),
    Rule("spread", lambda: _per_word("n_top_word") > 0.15, lambda: (F.col("n_words") > 0) & (_per_word("n_top_word") < 0.1)),
    Rule("line_ends", lambda: (F.col("n_lines") >= 3) & (_share("n_end_lines", "n_lines") < 0.9),
         lambda: (F.col("n_lines") > 0) & (_share("n_end_lines", "n_lines") >= 0.95)),
    Rule("letters", lambda: _share("n_others", "word_chars") > 0.2,
         lambda: (F.col("word_chars") > 0) & (_share("n_others", "word_chars") < 0.1)),
)


def votes(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``found`` and one column ``vote_<rule>`` per rule: 0 bad, 1 good, 2 abstains."""
    return found.withColumns({
        f"vote_{r.name}": F.when(r.bad(), F.lit(0)).when(r.good(), F.lit(1)).otherwise(F.lit(2)) for r in rules})


@dataclass(frozen=True)
class LabelModel:
    """Class 0 is the good one, class 1 + j the kind of bad documents that rule j sees. ``share[y]``: of all documents;
    ``chance[y][j][v]``: how often rule j votes v there, abstaining being a third answer; ``good[y]``: 1 where the
    documents of the class count as good, else 0."""
    share: tuple
    chance: tuple
    good: tuple

    def log_chance(self, y: int) -> list[list[float]]:
        return [[math.log(c) for c in row] for row in self.chance[y]]

    @property
    def prior(self) -> float:
        return sum(s * g for s, g in zip(self.share, self.good))

    def posterior(self, pattern) -> float:
        logs = [math.log(s) + sum(t[v] for t, v in zip(self.log_chance(y), pattern)) for y, s in enumerate(self.share)]
        weights = [math.exp(x - max(logs)) for x in logs]
        return sum(w * g for w, g in zip(weights, self.good)) / sum(weights)


def fit(counts: list[tuple[tuple[int, ...], int]], n_rules: int, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and their numbers of documents.

    The start takes the votes at their word: bad votes make a document bad, of the kinds of the rules that cast them. Each
    chance starts from a few imagined votes, as a rule that never votes is no proof. At last a kind is compared
    with the other kinds by the votes of all rules but its own: how much likelier are they on good documents?
    """
    counts, k = sorted(counts), n_rules + 1
    votes_cast = np.array([p for p, _ in counts], int).reshape(len(counts), n_rules)
    times = np.array([n for _, n in counts], float)[:, None]
    cast = (votes_cast[:, :, None] == np.arange(3)).reshape(len(counts), 3 * n_rules).astype(float)
    bad = (votes_cast == 0).astype(float)
    n_bad = bad.sum(axis=1, keepdims=True)
    first = np.select([n_bad == 0, n_bad == 1], [START[0], START[1]], 0.05)
    belief = np.hstack([first, (1 - first) * np.where(n_bad > 0, bad / np.maximum(n_bad, 1), 1 / n_rules)])
    imagined = np.ones((k, n_rules, 3))
    imagined[0, :, 0] = 0.1
    for j in range(n_rules):
        imagined[1 + j, j] = 2.0, 0.1, 0.1
    share, chance = np.array([0.9, *[0.1 / n_rules] * n_rules]), imagined / imagined.sum(axis=2, keepdims=True)
    for _ in range(rounds if len(counts) else 0):
        weight = belief * times
        share = (weight.sum(axis=0) + 1) / (times.sum() + k)
        seen = (weight.T @ cast).reshape(k, n_rules, 3) + imagined
        chance = seen / seen.sum(axis=2, keepdims=True)
        logs = np.log(share) + cast @ np.log(chance).reshape(k, 3 * n_rules).T
        belief = np.exp(logs - logs.max(axis=1, keepdims=True))
        belief /= belief.sum(axis=1, keepdims=True)
    good = [1.0]
    for y in range(1, k):
        rest = [x for x in range(1, k) if x != y]
        like_good = 0.0
        if rest:
            other = np.tensordot(share[rest] / share[rest].sum(), chance[rest], 1)
            by_rule = (chance[y] * np.log(chance[0] / other)).sum(axis=1)
            like_good = by_rule.sum() - by_rule[y - 1]
        good.append(float(like_good > 0))
    return LabelModel(tuple(map(float, share)), tuple(tuple(tuple(map(float, r)) for r in c) for c in chance), tuple(good))


def posterior(model: LabelModel, columns: list[str]) -> Column:
    """``model.posterior`` of the votes in ``columns``."""
    cast = F.array(*columns)

    def of_class(y: int) -> Column:
        table = F.array(*(F.array(*map(F.lit, row)) for row in model.log_chance(y)))
        return F.aggregate(F.zip_with(cast, table, lambda v, row: F.get(row, v)), F.lit(math.log(model.share[y])), lambda a, x: a + x)

    def ratio(logs: Column) -> Column:
        weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
        return let(weights, lambda w: F.aggregate(F.zip_with(w, F.array(*map(F.lit, model.good)), lambda a, g: a * g), F.lit(0.0), lambda a, x: a + x)
                   / F.aggregate(w, F.lit(0.0), lambda a, x: a + x))
    return let(F.array(*(of_class(y) for y in range(len(model.share)))), ratio)


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, keep_at: float = KEEP_AT) -> DataFrame:
    """Signals, votes, ``base_failed``, ``quality`` (posterior) and ``kept`` of each document."""
    found = checkpointed(votes(signals(docs), rules))
    columns = [f"vote_{r.name}" for r in rules]
    patterns = found.groupBy(*columns).count().collect()  # at most 3 ** len(rules) rows
    model = fit([(tuple(r[c] for c in columns), r["count"]) for r in patterns], len(rules))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumns({"base_failed": failed, "quality": F.round(posterior(model, columns), 9)}) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns; ids may repeat or be null, so rows carry a key of their own.

    The kept ids come back by a join on 128 bits of id and text, the same for equal rows.
    """
    name, key = absent_name(docs, "row_key"), content_key("doc_id", "text")
    found = judged(docs.select(key.alias("doc_id"), "text"))
    kept = found.where("kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.withColumn(name, key).join(kept, name, "left_semi").drop(name)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept", "quality")
