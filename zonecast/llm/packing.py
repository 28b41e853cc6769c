"""Best-fit packing of documents into sequences under several capacities at once.

A sequence holds so many tokens, so many documents, and so much attention cost (the sum of squared lengths, as
documents do not see each other). Documents are encoded once; longer ones are cut into pieces that fit a sequence alone. Then
pieces are items with a demand in each capacity. In groups of bounded size, dealt out evenly, items go in
descending order of their demand, each into the open sequence that is best for it among those it fits in every
capacity: by the norm of what would be left, or by the weighted product of demand and room. Sequences that end up with room
are the items of the next round, whole, among those of other groups, so a round never needs more sequences than the
one before. A piece that fills a sequence has one for itself from the start.

The text is read once; afterwards a piece is a row of numbers.

Odd input: a null or empty text is its end id alone. Rows with the same id are packed each by itself. Null ids stay null.
A text is encoded by words, so its memory is a few times its own length. An empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import bounded_batches, only
from zonecast.llm.near_dups import bounds, grouped
from zonecast.llm.token_files import WordEncoder
from zonecast.session import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, at long"
PLACED = "task int, at long, bin long, inner long"


@dataclass(frozen=True)
class PackConfig:
    """Capacities of a sequence. The defaults of the last two bind only where the first does.

    ``rule`` is "norm" (the least norm of what is left) or "dot" (the largest product of demand and room); ``weights``
    weigh tokens, documents and cost in it. A task packs ``group`` items. Sequences less full than ``closed`` go round again.
    """

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    rule: str = "norm"
    weights: tuple[float, float, float] = (1.0, 1e-4, 1e-4)
    group: int = 8192
    closed: float = 1.0

    @property
    def longest(self) -> int:
        """The longest piece that fits a sequence alone."""
        return min(self.tokens, isqrt(self.cost))

    @property
    def capacity(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], np.int64)


def best_fit(demands: np.ndarray, config: PackConfig) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of every item (from 0, in the order they were opened), and the tokens that stand before it there.

    ``demands`` has a row of tokens, documents and cost for each item, each within the capacities.
    """
    capacity, scale = config.capacity, np.array(config.weights) / config.capacity.astype(float)
    bins, inner = np.zeros(len(demands), np.int64), np.zeros(len(demands), np.int64)
    order = np.lexsort((-demands[:, 2], -demands[:, 0])) if len(demands) else np.zeros(0, np.int64)
    least = np.minimum.accumulate(demands[order[::-1]], axis=0)[::-1]  # the least demand still to come
    room = np.zeros((3, 256), np.int64)
    names = np.zeros(256, np.int64)
    n, opened = 0, 0
    for step, item in enumerate(order.tolist()):
        need = demands[item]
        if step % 256 == 0 and n:  # sequences nothing fits any more are closed
            useful = np.flatnonzero((room[:, :n] >= least[step][:, None]).all(axis=0))
            room[:, :len(useful)], names[:len(useful)] = room[:, useful], names[useful]
            n = len(useful)
        left = room[:, :n] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            if config.rule == "norm":
                score = (np.square(left[:, fits] * scale[:, None])).sum(axis=0)
            else:
                score = -((room[:, fits] * scale[:, None]) * (need * scale)[:, None]).sum(axis=0)
            at = int(fits[np.argmin(score)])
        else:
            if n == room.shape[1]:
                room, names = np.concatenate([room, room], axis=1), np.concatenate([names, names])
            at, n = n, n + 1
            room[:, at], names[at] = capacity, opened
            opened += 1
        bins[item], inner[item] = names[at], capacity[0] - room[0, at]
        room[:, at] -= need
    return bins, inner


def encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return only(("word-bpe", path), lambda: WordEncoder(path))


def pieces(docs: DataFrame, tokenizer: str, end_id: int, config: PackConfig) -> DataFrame:
    """Every piece of every document: doc_id, piece, start, length, ids_crc32, and its place (task, at)."""
    longest = config.longest

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, at = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, lengths = words.encode(texts, end_id, added_tokens=True)
            ends = np.cumsum(lengths)
            number = -(-lengths // longest)
            piece = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number)
            first = np.repeat(ends - lengths, number) + piece * longest
            length = np.minimum(longest, np.repeat(ends, number) - first)
            view = memoryview(ids.astype("<u4")).cast("B")
            crc = [zlib.crc32(view[4 * a:4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(len(texts)), number))), pa.array(piece.astype(np.int32)), pa.array(piece * longest),
                pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(piece), task, np.int32)), pa.array(at + np.arange(len(piece)))],
                names=[f.split()[0] for f in PIECES.split(", ")])
            at += len(piece)

    bounded_batches()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def packed_round(items: DataFrame, groups: int, number: int, config: PackConfig) -> DataFrame:
    """task, at, bin, inner of the items (task, at, tokens, documents, cost), packed in ``groups`` groups of about equal size.

    A bin is named by its group and its place there, so names of one round differ. Items are dealt by a hash of their
    place, which no two share, so no group is larger than the others.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ("group",)):
            group, task, at = (table.column(c).to_numpy() for c in ("group", "task", "at"))
            demands = np.stack([table.column(c).to_numpy() for c in ("tokens", "documents", "cost")], axis=1)
            for own in map(slice, *bounds(table, ("group",))):
                bins, inner = best_fit(demands[own], config)
                yield pa.RecordBatch.from_arrays([
                    pa.array(task[own]), pa.array(at[own]), pa.array((group[own].astype(np.int64) << 32) + bins), pa.array(inner)],
                    names=["task", "at", "bin", "inner"])

    dealt = items.withColumn("group", F.pmod(F.xxhash64("task", "at", F.lit(number)), F.lit(groups)))
    n = min(groups, int(items.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # Sorted by place, a group gives the same result however its rows arrive.
    return dealt.repartition(n, "group").sortWithinPartitions("group", "task", "at").mapInArrow(pack, PLACED)


def group_count(items: DataFrame, config: PackConfig) -> int:
    return max(1, -(-items.count() // config.group))


def packed(docs: DataFrame, tokenizer: str, end_id: int = 0, config: PackConfig = PackConfig()) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of ``docs`` (doc_id, text)."""
    rows = stored(pieces(docs, tokenizer, end_id, config), "pack-pieces")
    full = F.col("length") == config.tokens
    number, one = F.col("length"), F.lit(1).cast("long")
    items = rows.filter(~full).select("task", "at", number.alias("tokens"), one.alias("documents"), (number * number).alias("cost"))
    groups = group_count(items, config)
    placed = stored(packed_round(items, groups, 0, config), "pack-placed")
    bins = stored(items.join(placed, ["task", "at"]).groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("tokens", "documents", "cost")]), "pack-bins")

    # Sequences with room meet those of other groups: where ``bin`` went, and the tokens before it there.
    moved, number = None, 0
    open_bins = bins.filter(F.col("tokens") < config.closed * config.tokens)
    while groups > 1:
        number += 1
        again = open_bins.select(F.shiftright("bin", 32).cast("int").alias("task"), F.col("bin").bitwiseAND(F.lit(0xFFFFFFFF)).alias("at"), "tokens", "documents", "cost")
        before, groups = groups, group_count(again, config)
        step = stored(packed_round(again, groups, number, config)
                      .select((F.shiftleft(F.col("task").cast("long"), 32) + F.col("at")).alias("bin"), F.col("bin").alias("into"), "inner"), "pack-moved")
        # The new name carries the round, so that it is none of an earlier one.
        step = step.withColumn("into", F.col("into") + (F.lit(number) * F.lit(1 << 56)))
        moved = step if moved is None else (moved.join(step.select(F.col("bin").alias("into"), F.col("into").alias("next"), F.col("inner").alias("more")), "into", "left")
                                            .select("bin", F.coalesce("next", "into").alias("into"), (F.col("inner") + F.coalesce("more", F.lit(0))).alias("inner")))
        if groups == 1 or groups > before // 2:
            break
        merged = step.join(open_bins, "bin").groupBy(F.col("into").alias("bin")).agg(*[F.sum(c).alias(c) for c in ("tokens", "documents", "cost")])
        open_bins = stored(merged.filter(F.col("tokens") < config.closed * config.tokens), "pack-open")
    found = rows.join(placed, ["task", "at"], "left")
    if moved is not None:
        found = found.join(moved.select("bin", "into", F.col("inner").alias("shift")), "bin", "left")
    else:
        found = found.withColumns({"into": F.lit(None).cast("long"), "shift": F.lit(None).cast("long")})
    # Full pieces have negative numbers, one for each place.
    alone = -1 - (F.shiftleft(F.col("task").cast("long"), 36) + F.col("at"))
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", F.coalesce("into", "bin", alone).alias("sequence_id"),
                        F.coalesce(F.col("inner") + F.coalesce("shift", F.lit(0)), F.lit(0)).cast("long").alias("offset"))
