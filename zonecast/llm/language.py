"""Language identification by prediction by partial matching.

Every language has a byte context tree: for each context of 0 to ``order`` bytes, the counts of
the bytes that followed it in the training text. A byte seen c times in a context with n bytes,
q of them distinct, costs -log2(c / (n + q)) bits; a byte not seen there first pays the escape,
-log2(q / (n + q)), and is then coded in the context shortened by one byte; below the empty
context all 256 bytes are alike. The statistics are frozen: the text being coded changes nothing, so
the code length of a text is a sum of table entries, the same wherever the text is read.

The trees are fitted on a bounded sample of labelled rows and shipped to the tasks; every
text is then coded whole, under all languages at once. The language with the shortest code
wins, the alphabetically first one in a tie.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import HashIndex, bounded_batches, chunks, only, ranges
from zonecast.session import stored

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    """``sample_docs`` and ``sample_bytes`` bound the training rows of each language: what reaches the
    driver, and the broadcast trees, are at most that many bytes times the languages (times a small factor)."""

    order: int = 4
    sample_docs: int = 600
    sample_bytes: int = 500_000


@dataclass(frozen=True)
class ContextTrees:
    """Code lengths of all grams any language has seen, one column per language.

    ``grams[d]`` are the sorted (d + 1)-byte grams and ``costs[d]`` the bits of their last byte after
    the first d; ``contexts[d]`` the sorted d-byte contexts and ``escapes[d]`` the bits of leaving them
    (0 for a language that has not seen the context: it codes in the shorter one at no cost).
    """

    languages: tuple[str, ...]
    order: int
    grams: tuple[np.ndarray, ...]
    costs: tuple[np.ndarray, ...]
    contexts: tuple[np.ndarray, ...]
    escapes: tuple[np.ndarray, ...]


def flat_bytes(texts: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, each text after ``order`` line ends, and the number of bytes of each text."""
    coded = [text.encode("utf-8", "replace") for text in texts]
    pad = b"\n" * order
    flat = np.frombuffer(pad + pad.join(coded), np.uint8) if coded else np.zeros(order, np.uint8)
    return flat, np.array([len(c) for c in coded], np.int64)


def rolling_grams(flat: np.ndarray, order: int) -> list[np.ndarray]:
    """For d = 0..order, the d + 1 bytes that end at each position as one integer."""
    grams = [flat.astype(np.uint64)]
    for d in range(1, order + 1):
        gram = grams[0].copy()
        gram[1:] |= grams[-1][:-1] << np.uint64(8)
        grams.append(gram)
    return grams


def text_positions(sizes: np.ndarray, order: int) -> np.ndarray:
    starts = np.cumsum(sizes + order) - sizes
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def fit_trees(texts: dict[str, list[str]], order: int = 4) -> ContextTrees:
    """Context trees of the given texts by language; languages without a byte are left out."""
    texts = {k: [t for t in texts[k] if t] for k in sorted(texts) if any(texts[k])}
    counted: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(order + 1)]
    for lang in texts:
        flat, sizes = flat_bytes(texts[lang], order)
        at, grams = text_positions(sizes, order), rolling_grams(flat, order)
        for d in range(order + 1):
            counted[d].append(np.unique(grams[d][at], return_counts=True))
    keys, costs, contexts, escapes = [], [], [], []
    for d in range(order + 1):
        union = np.unique(np.concatenate([k for k, _ in counted[d]])) if texts else np.zeros(0, np.uint64)
        counts = np.zeros((len(union), len(texts)))
        for column, (k, c) in enumerate(counted[d]):
            counts[np.searchsorted(union, k), column] = c
        context, first, inverse = np.unique(union >> np.uint64(8), return_index=True, return_inverse=True)
        seen = np.add.reduceat(counts, first, axis=0) if len(first) else counts
        distinct = np.add.reduceat((counts > 0).astype(float), first, axis=0) if len(first) else counts
        with np.errstate(divide="ignore", invalid="ignore"):
            escape = np.where(seen > 0, -np.log2(distinct / (seen + distinct)), 0.0)
            own = -np.log2(counts / (seen + distinct)[inverse])
        shorter = np.full_like(counts, 8.0)
        if d:
            shorter = costs[-1][np.searchsorted(keys[-1], union & np.uint64((1 << 8 * d) - 1))]
        keys.append(union)
        contexts.append(context)
        escapes.append(escape.astype(np.float32))
        costs.append(np.where(counts > 0, own, escape[inverse] + shorter).astype(np.float32))
    return ContextTrees(tuple(texts), order, tuple(keys), tuple(costs), tuple(contexts), tuple(escapes))


class Coder:
    """Code lengths in bits of whole texts under every language.

    Texts are coded in pieces of ``piece`` bytes, whose bits add up, so a text of any length needs the arrays of one piece
    and, beside the text itself, a copy of its bytes.
    """

    def __init__(self, trees: ContextTrees, piece: int = 1 << 20):
        self.trees, self.piece = trees, piece
        self.grams = [HashIndex(k) for k in trees.grams]
        self.contexts = [HashIndex(k) for k in trees.contexts]

    def bits(self, texts: list[str]) -> np.ndarray:
        """One row per text, one column per language."""
        trees, out = self.trees, np.zeros((len(texts), len(self.trees.languages)))
        for start, end in chunks(texts):
            flat, sizes = flat_bytes(texts[start:end], trees.order)
            begins = np.cumsum(sizes + trees.order) - sizes
            for first in range(trees.order, len(flat), self.piece):
                # What of each text lies in the piece; the piece takes along the ``order`` bytes before it.
                low, high = (np.clip(edge, first, first + self.piece) for edge in (begins, begins + sizes))
                filled = np.flatnonzero(high > low)
                if len(filled):
                    low, lengths = low[filled], (high - low)[filled]
                    cost = self.costs(flat[first - trees.order:first + self.piece], ranges(low - (first - trees.order), lengths))
                    out[start + filled] += np.add.reduceat(cost, np.cumsum(lengths) - lengths, axis=0, dtype=np.float64)
        return out

    def costs(self, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Bits of each byte at the places ``at``, which have ``order`` bytes before them in ``flat``."""
        trees, grams = self.trees, rolling_grams(flat, self.trees.order)
        cost = np.zeros((len(at), len(trees.languages)), np.float32)
        left = np.arange(len(at))
        for d in range(trees.order, -1, -1):
            found = self.grams[d].find(grams[d][at[left]])
            hit = found >= 0
            cost[left[hit]] += trees.costs[d][found[hit]]
            left = left[~hit]
            if not len(left):
                break
            context = grams[d - 1][at[left] - 1] if d else np.zeros(len(left), np.uint64)
            known = self.contexts[d].find(context)
            cost[left[known >= 0]] += trees.escapes[d][known[known >= 0]]
            if not d:
                cost[left] += 8.0
        return cost


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def classify(coder: Coder, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text.

    The score is the posterior of the winner for equally likely languages, 2^-bits over the sum of all
    2^-bits. Null, empty and letterless texts are ``und`` with score 0; so is every text without training rows.
    """
    names = np.array(list(coder.trees.languages) + [UNKNOWN], dtype=object)
    lettered = np.array([has_letter(t) for t in texts], bool)
    if not len(texts) or not coder.trees.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    bits = coder.bits([t if ok else "" for t, ok in zip(texts, lettered, strict=True)])
    best = bits.argmin(axis=1)
    share = 1.0 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000.0)).sum(axis=1)
    return list(names[np.where(lettered, best, len(names) - 1)]), np.where(lettered, share, 0.0)


def training_sample(labelled: DataFrame, config: LanguageConfig) -> dict[str, list[str]]:
    """Whole texts of each language in an order given by a hash of id and text, as far as both bounds allow.

    A text that would exceed the bytes is passed over, and the following ones are taken. If all of them are too long alone,
    the first one gives its beginning, so that every labelled language is trained. Rows without text or language are no training rows. ``labelled`` has doc_id, text, lang.
    """
    rows = labelled.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND length(text) > 0")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, 2.0 * config.sample_docs / n)])
    place = F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit(17))
    near = rows.withColumn("place", place).filter(F.shiftrightunsigned("place", 1) / float(1 << 63) < share[F.col("lang")])
    # About twice the wanted rows are left of each language; rank and bytes are settled among these.
    order = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    ranked = near.select("lang", "text", F.row_number().over(order).alias("rank"), F.octet_length("text").alias("bytes"))
    # A character has four bytes at most, so the beginning fits.
    beginning = F.substring("text", 1, max(1, config.sample_bytes // 4))
    ranked = stored(ranked.withColumn("text", F.when(F.col("bytes") <= config.sample_bytes, F.col("text")).otherwise(beginning)), "language-sample")
    taken: dict[str, list[int]] = {}
    first, used = {}, dict.fromkeys(sizes, 0)
    for lang, rank, size in ranked.select("lang", "rank", "bytes").orderBy("lang", "rank").collect():
        first.setdefault(lang, rank)
        if len(taken.get(lang, ())) < config.sample_docs and used[lang] + size <= config.sample_bytes:
            taken.setdefault(lang, []).append(rank)
            used[lang] += size
    chosen = [(lang, rank) for lang in first for rank in taken.get(lang, [first[lang]])]
    picks = ranked.sparkSession.createDataFrame(chosen, "lang string, rank int")
    out: dict[str, list[str]] = {}
    for row in ranked.join(F.broadcast(picks), ["lang", "rank"]).select("lang", "text").orderBy("lang", "rank").collect():
        out.setdefault(row.lang, []).append(row.text)
    return out


def language_of(spark, trees: ContextTrees, text: Column) -> Column:
    """A struct of lang_pred and score for a text column."""
    digest = hashlib.sha256(pickle.dumps(trees)).hexdigest()
    shipped = spark.sparkContext.broadcast(trees)

    bounded_batches()

    @F.pandas_udf("lang_pred string, score double")
    def identify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        coder = only(("language", digest), lambda: Coder(shipped.value))
        for batch in batches:
            lang, score = classify(coder, [t if isinstance(t, str) else None for t in batch])
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return identify.asNondeterministic()(text)


def train(labelled: DataFrame, config: LanguageConfig = LanguageConfig()) -> ContextTrees:
    """Fit trees on the bounded sample of the labelled rows."""
    return fit_trees(training_sample(labelled, config), config.order)
