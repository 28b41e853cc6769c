"""Quality rules as weak supervision.

Every rule looks at one measure of a text and votes good (1), bad (-1) or abstains (0) between two thresholds. No rule
decides alone: expectation-maximisation estimates how often each rule is right when it votes, and the share of good
texts, from how the rules agree over all documents; a text is kept if its posterior probability of
being good reaches the threshold. The votes of eight rules have 3^8 patterns, so the estimation runs on the table
of patterns and their counts, 6,561 rows at most whatever the corpus.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import bounded_batches, chunks
from zonecast.llm.near_dups import mix64, odd_numbers, word_hashes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words",
            "n_top_word", "n_lettered_words")
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Rule:
    """``value`` is an SQL expression over the measures. Good lies from ``good[0]`` to ``good[1]``; bad is outside ``fair``."""

    name: str
    value: str
    good: tuple[float, float]
    fair: tuple[float, float]


INF = float("inf")
RULES = (
    Rule("long_enough", "n_words", (100, INF), (50, INF)),
    Rule("word_length", "word_chars / greatest(n_words, 1)", (3.5, 8.5), (2.5, 12.0)),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", (-INF, 0.02), (-INF, 0.1)),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", (-INF, 0.1), (-INF, 0.3)),
    Rule("repeated_words", "n_repeat_words / greatest(n_words, 1)", (-INF, 0.15), (-INF, 0.4)),
    Rule("distinct_words", "n_distinct_words / sqrt(greatest(n_words, 1))", (4.0, INF), (2.0, INF)),
    Rule("top_word", "n_top_word / greatest(n_words, 1)", (-INF, 0.12), (-INF, 0.25)),
    Rule("lettered_words", "n_lettered_words / greatest(n_words, 1)", (0.9, INF), (0.75, INF)),
)


def measures(texts: list[str]) -> list[tuple[int, ...]]:
    """The measures of each text; an empty text has zeros.

    Words are runs without ASCII white space, their case kept. A line is one between line ends that has a word; it repeats
    if it equals an earlier one. A word repeats if it stands in a window of three words that the text holds twice.
    """
    found = [text.encode("utf-8", "replace").split() for text in texts]
    sizes = np.array([len(w) for w in found], np.int64)
    hashes = np.fromiter(map(word_hashes().__getitem__, chain.from_iterable(found)), np.uint64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    a, b, c = odd_numbers(3, 23)
    triples = mix64(hashes[:-2] * a + hashes[1:-1] * b + hashes[2:] * c) if len(hashes) > 2 else hashes[:0]
    out = []
    for text, words, size, end in zip(texts, found, sizes.tolist(), ends.tolist(), strict=True):
        if not size:
            out.append((0, 0, sum(map(text.count, SYMBOLS)), 0, 0, 0, 0, 0, 0))
            continue
        start, repeated, twice = end - size, 0, 0
        if size > 3:
            own = triples[start:end - 2]
            order = np.argsort(own, kind="stable")
            same = own[order[1:]] == own[order[:-1]]
            if same.any():
                again = np.zeros(len(own), bool)
                again[order[1:][same]] = again[order[:-1][same]] = True
                covered = np.zeros(size, bool)
                for j in range(3):
                    covered[j:j + len(own)] |= again
                repeated = int(covered.sum())
        lines = [line for line in text.split("\n") if line.strip(SPACE)]
        counts = np.unique(hashes[start:end], return_counts=True)[1]
        twice = len(lines) - len(set(lines))
        lettered = sum(1 for w in words if w.isalpha() or LETTER.search(w.decode("utf-8", "replace")))
        out.append((size, len(text) - sum(map(text.count, SPACE)), sum(map(text.count, SYMBOLS)), twice, repeated,
                    len(lines), len(counts), int(counts.max()), lettered))
    return out


def measured(text: Column) -> Column:
    """A struct of the measures of a text column; a null text counts as empty."""
    bounded_batches()

    @F.pandas_udf(", ".join(f"{name} long" for name in MEASURES))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, rows = [t if isinstance(t, str) else "" for t in batch], []
            for start, end in chunks(texts):
                rows += measures(texts[start:end])
            yield pd.DataFrame(rows, columns=list(MEASURES))

    return measure.asNondeterministic()(text)


def vote(rule: Rule) -> Column:
    value = F.expr(rule.value)

    def between(limits: tuple[float, float]) -> Column:
        inside = F.lit(True)
        if limits[0] > -INF:
            inside &= value >= limits[0]
        if limits[1] < INF:
            inside &= value <= limits[1]
        return inside
    return F.when(between(rule.good), 1).when(between(rule.fair), 0).otherwise(-1)


@dataclass(frozen=True)
class Accuracies:
    """Share of good texts, and of right votes of each rule, with the steps the estimation took."""

    good: float
    right: tuple[float, ...]
    steps: int

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        right = np.array(self.right)
        odds = np.log(self.good / (1 - self.good)) + votes @ np.log(right / (1 - right))
        return 1.0 / (1.0 + np.exp(-odds))


def estimate(votes: np.ndarray, counts: np.ndarray, steps: int = 500) -> Accuracies:
    """Expectation-maximisation over vote patterns (rows of 1, 0, -1) and their counts.

    A rule that votes is right with its accuracy, whichever class the text is of; whether it abstains says
    nothing. Accuracies stay between 0.55 and 0.99, so that good votes never count against a text, and the share
    of good texts between 0.05 and 0.95. All rules start at 0.8.
    """
    model = Accuracies(0.8, (0.8,) * votes.shape[1], 0)
    total = counts.sum()
    for step in range(1, steps + 1):
        good = model.posterior(votes)
        right = np.where(votes > 0, good[:, None], 1 - good[:, None]) * (votes != 0)
        cast = ((votes != 0) * counts[:, None]).sum(axis=0)
        accuracy = np.clip(((right * counts[:, None]).sum(axis=0) + 0.8) / (cast + 1.0), 0.55, 0.99)
        share = float(np.clip((good * counts).sum() / total, 0.05, 0.95)) if total else 0.8
        change = max(abs(share - model.good), float(np.abs(accuracy - np.array(model.right)).max()))
        model = Accuracies(share, tuple(accuracy.tolist()), step)
        if change < 1e-9:
            break
    return model


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES) -> Accuracies:
    """Estimate from a frame with the column ``votes``; only its distinct patterns reach the driver."""
    if len(rules) > 10:
        raise ValueError("more than 10 rules have too many patterns of votes for the driver")
    found = voted.groupBy("votes").count().orderBy("votes").collect()
    votes = np.array([list(row["votes"]) for row in found], float).reshape(-1, len(rules))
    return estimate(votes, np.array([row["count"] for row in found], float))


def judged(measured_rows: DataFrame, threshold: float = 0.5, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows (with the measures as columns) plus votes and quality, the posterior probability, and good.

    ``measured_rows`` is read twice, so it should be a table.
    """
    voted = measured_rows.withColumn("votes", F.array(*[vote(rule) for rule in rules]))
    model = fit(voted, rules)
    weights = F.array(*[F.lit(float(np.log(r / (1 - r)))) for r in model.right])
    odds = F.aggregate(F.zip_with("votes", weights, lambda v, w: v * w), F.lit(float(np.log(model.good / (1 - model.good)))), lambda a, b: a + b)
    quality = 1.0 / (1.0 + F.exp(-odds))
    return voted.withColumn("quality", quality).withColumn("good", F.col("quality") >= threshold)
