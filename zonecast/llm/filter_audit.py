"""Filter interaction audit: which documents five filters remove, in every order.

Every document becomes a 32-bit word. Bit s is set if the document survives the set s of filters (bit k of s
stands for the k-th letter of ``ABCDE``), so the word is the truth table of "none of its failing filters is in s".
Carry-save adders count all 32 positions of many words side by side, for every part and label; these survivor counts
are all the audit needs, whatever the order of the filters:

- after the filters p are applied, survivors(p) documents are left, and the next filter f removes survivors(p) - survivors(p + f);
- survivors(none) - survivors(f) fail f, so the rest of them was removed earlier;
- survivors(all but f) - survivors(all) fail f only;
- f is applied after a set p in |p|! (4 - |p|)! of the 120 orders.

Texts are read once. After that only an id, a part, five bits and a digest travel for each document.

Odd input: a null text is empty, a null part the empty string. A document without an id has no smaller id beside it and
no labels, so it never fails E. Rows that repeat an id and a text are both kept by E (neither id is smaller). A document with several
label rows has a label if one of them says so; label rows without an id are passed over. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import bounded_batches
from zonecast.session import stored

# The filters and their thresholds.
FILTERS = "ABCDE"
MIN_WORDS = 100
DISTINCT_PERCENT = 80
CAPITAL_PERCENT = 10
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"

SUBSETS = 1 << len(FILTERS)
ALL = SUBSETS - 1
COPY = 1 << FILTERS.index("E")
LABELS = ("any", "good", "toxic")
HELD_COUNTS = 20_000
"""Parts and labels a task counts before it hands the counts on and starts anew."""

#: The word of every set of failing filters: bit s is set if s holds none of them.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failing) for failing in range(SUBSETS)], np.uint32)


def failing(text: str) -> int:
    """The filters a text fails by itself, as bits. Bytes methods know ASCII only, which is what the rules speak of."""
    data = text.encode("utf-8", "replace")
    words = data.split()
    capitals = len(data) - len(data.translate(None, CAPITALS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    rules = (len(words) < MIN_WORDS, 100 * len(set(words)) < DISTINCT_PERCENT * len(words),
             100 * capitals > CAPITAL_PERCENT * len(text), symbols > 0)
    return sum(1 << k for k, failed in enumerate(rules) if failed)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, part, failing (without E), digest of the text."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array([failing(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t.encode("utf-8", "replace")).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "failing", "digest"])

    bounded_batches()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), "text")
    return rows.mapInArrow(measure, "doc_id long, part string, failing int, digest binary")


def carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and carries of three words in all 32 positions at once."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each of the 32 bits set.

    Three words of the same weight become one of that weight and one of twice it, until at most two of a weight are left.
    """
    counts, weight = np.zeros(32, np.int64), 1
    while len(words):
        carries = [np.zeros(0, np.uint32)]
        while len(words) >= 3:
            third = len(words) // 3
            total, carry = carry_save(words[:third], words[third:2 * third], words[2 * third:3 * third])
            carries.append(carry)
            words = np.concatenate([total, words[3 * third:]])
        counts += weight * ((words[:, None] >> np.arange(32, dtype=np.uint32)) & 1).sum(axis=0, dtype=np.int64)
        words, weight = np.concatenate(carries), 2 * weight
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """part, label, subset, n: documents of each part and label that survive a set of filters. ``rows``: part, failing, good, toxic."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], np.ndarray] = {}

        def handed() -> pa.RecordBatch:
            keys = list(held)
            return pa.RecordBatch.from_arrays([
                pa.array([part for part, _ in keys for _ in range(SUBSETS)], pa.string()),
                pa.array([label for _, label in keys for _ in range(SUBSETS)], pa.string()),
                pa.array(np.tile(np.arange(SUBSETS, dtype=np.int32), len(keys))),
                pa.array(np.concatenate(list(held.values())))], names=["part", "label", "subset", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).dictionary_encode()
            at, names = parts.indices.to_numpy(zero_copy_only=False), parts.dictionary.to_pylist()
            words = WORDS[batch.column(1).to_numpy(zero_copy_only=False)]
            told = {"any": np.ones(len(words), bool), "good": batch.column(2).to_numpy(zero_copy_only=False), "toxic": batch.column(3).to_numpy(zero_copy_only=False)}
            order = np.argsort(at, kind="stable")
            for own in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                for label, has in told.items():
                    if (mine := words[own[has[own]]]).size:
                        key = names[at[own[0]]], label
                        held[key] = held.get(key, 0) + positional_popcount(mine)
            if len(held) > HELD_COUNTS:
                yield handed()
                held.clear()
        if held:
            yield handed()

    counted = rows.select("part", "failing", "good", "toxic").mapInArrow(count, "part string, label string, subset int, n long")
    return counted.groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))


def report(counts: DataFrame) -> DataFrame:
    """The rows of every part, order and step from its survivor counts (at most 96 numbers a part)."""
    fields = [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32()),
              *[(n, pa.int64()) for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]]
    steps = [("".join(order), k + 1, 1 << FILTERS.index(order[k]), sum(1 << FILTERS.index(f) for f in order[:k]))
             for order in permutations(FILTERS) for k in range(len(FILTERS))]
    own, before = np.array([s[2] for s in steps]), np.array([s[3] for s in steps])
    after = own | before
    apart = [(f, [s for s in range(SUBSETS) if not s & f]) for f in (1 << k for k in range(len(FILTERS)))]
    weight = [factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) for s in range(ALL)]  # no filter follows all of them

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = {label: np.zeros(SUBSETS, np.int64) for label in LABELS}
                for cell in row["cells"]:
                    n[cell["label"]][cell["subset"]] = cell["n"]
                left = n["any"]
                removed = left[before] - left[after]
                fair = {f: sum(weight[s] * (left[s] - left[s | f]) for s in sets) for f, sets in apart}
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["part"]] * len(steps)), pa.array([s[0] for s in steps]), pa.array([s[1] for s in steps], pa.int32()),
                    pa.array(left[after]), pa.array(removed), pa.array(left[0] - left[own] - removed), pa.array(left[ALL & ~own] - left[ALL]),
                    pa.array(n["good"][before] - n["good"][after]), pa.array(n["toxic"][before] - n["toxic"][after]),
                    pa.array(np.array([fair[f] for f in own.tolist()], np.int64))], schema=pa.schema(fields))

    by_part = counts.groupBy("part").agg(F.collect_list(F.struct("label", "subset", "n")).alias("cells"))
    return by_part.mapInArrow(expand, ", ".join(f"{n} {'string' if t == pa.string() else 'int' if t == pa.int32() else 'long'}" for n, t in fields))


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, good, toxic of the labelled documents."""
    flag = lambda name: F.max(F.coalesce(F.col(name) == 1, F.lit(False)))
    return labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        flag("quality").alias("good"), flag("toxic").alias("toxic"))


def documents_failing(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, failing (all five filters), good, toxic of every document of ``docs`` (doc_id, text, lang).

    A text that many documents share is one row of the table of smallest ids, counted in the map tasks; its documents meet
    that row in a join, whose large partitions adaptive execution splits.
    """
    rows = stored(measured(docs), "audit-rows")
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    copy = F.when(F.col("doc_id") > F.col("least"), F.lit(COPY)).otherwise(0)
    judged = rows.join(shared, "digest", "left").select("doc_id", "part", F.col("failing").bitwiseOR(copy).alias("failing"))
    no = F.lit(False)
    known = (judged.filter("doc_id IS NOT NULL").join(labelled(labels), "doc_id", "left")
             .select("doc_id", "part", "failing", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")))
    return known.unionByName(judged.filter("doc_id IS NULL").withColumns({"good": no, "toxic": no}))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: 600 rows a part."""
    return report(survivors(documents_failing(docs, labels)))
