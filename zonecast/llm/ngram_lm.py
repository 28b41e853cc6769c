"""Language-model scores by a weighted backoff automaton over word bigrams.

Tokens are the words of a text, A-Z lowered, and one end. With c(w) of N training tokens of V kinds,

    p(w) = (c(w) + 1) / (N + V + 1)             p(w | h) = (c(h w) + strength * p(w)) / (c(h) + strength)

so a history that was seen rarely, or a pair never, leans on the single-word estimate. Both sum to one, all
unknown words together counting as one kind. As an automaton: one state per known history, the beginning of a text
among them, and one state without history. A seen pair is an arc with log10 p(w | h) to the state of w. Any other
word first takes the failure arc, log10 (strength / (c(h) + strength)), to the state without history, which has an arc
log10 p(w) for every word. A text is read once from left to right; it carries a state and adds up weights.

The counts cover all training documents and are never gathered in one place. Documents are cut into
blocks; each block asks for the counts of its own distinct words and pairs, in slices by hash; every slice of the
hash range is summed over all blocks, and the sums go back to the blocks that asked. So a block builds
just that part of the automaton its texts can reach, which is exact for them.
Words and pairs are told apart by 64-bit and 56-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import ascii_words, bounded_batches, HashIndex, only
from zonecast.llm.near_dups import bounds, grouped, mix64, word_hashes
from zonecast.session import stored

END = np.uint64(0x3C2F733E3C2F733E)
START = np.uint64(0x3C733E203C733E20)
PAIR_BITS = 56
WORDS, PAIRS = 0, 1
BLOCK = "block long, doc_ids binary, null_id binary, learns binary, lengths binary, tokens binary, words binary"
SLICE = "kind int, slice long, block long, keys binary, counts binary"
ANSWER = "kind int, slice long, block long, totals binary, n_kinds long, n_tokens long"
SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


@dataclass(frozen=True)
class LmConfig:
    """``block_tokens`` and ``slice_keys`` bound what a task holds: a block, and the keys of a hash range (as expected)."""

    strength: float = 1000.0
    block_tokens: int = 1 << 20
    slice_keys: int = 2_000_000


def packed(values: np.ndarray, width: int) -> bytes:
    """Unsigned integers as ``width`` planes of bytes, compressed."""
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel().astype(np.uint64)


def record(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], names=[n for n, _ in fields])


def in_blocks(docs: DataFrame, learns: Column, config: LmConfig) -> DataFrame:
    """Rows of ``BLOCK``: whole documents of one scan task, up to a number of tokens. ``learns`` marks training documents."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, ids, training, size = TaskContext.get().partitionId() << 32, [], [], [], 0

        def row() -> pa.RecordBatch:
            words, tokens = np.unique(np.concatenate(held), return_inverse=True)
            return record(BLOCK, [(
                block, np.array([x or 0 for x in ids], "<i8").tobytes(), np.array([x is None for x in ids], bool).tobytes(),
                np.array(training, bool).tobytes(), np.array([len(h) for h in held], "<i8").tobytes(),
                packed(tokens, 4), words.astype("<u8").tobytes())])

        for batch in batches:
            for doc_id, text, learn in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                words = ascii_words(text or "")
                stream = np.empty(len(words) + 1, np.uint64)
                stream[:-1] = list(map(word_hashes().__getitem__, words))
                stream[-1] = END
                if size and size + len(stream) > config.block_tokens:
                    yield row()
                    block, held, ids, training, size = block + 1, [], [], [], 0
                held.append(stream)
                ids.append(doc_id)
                training.append(bool(learn))
                size += len(stream)
        if held:
            yield row()

    bounded_batches()
    return docs.select("doc_id", "text", F.coalesce(learns, F.lit(False)).alias("learns")).mapInArrow(cut, BLOCK)


class Block:
    """A block's tokens and their distinct words and pairs."""

    def __init__(self, row: dict):
        self.number = row["block"]
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        self.null_id = np.frombuffer(row["null_id"], bool)
        self.lengths = np.frombuffer(row["lengths"], "<i8")
        self.learns = np.repeat(np.frombuffer(row["learns"], bool), self.lengths)
        self.words = np.frombuffer(row["words"], "<u8")
        self.tokens = unpacked(row["tokens"], 4).astype(np.int32)
        self.starts = np.cumsum(self.lengths) - self.lengths
        before = np.concatenate([[0], self.tokens[:-1]]).astype(np.int64)
        before[self.starts] = len(self.words)  # the beginning of a text
        codes = before * (len(self.words) + 1) + self.tokens
        pairs, at = np.unique(codes, return_inverse=True)
        self.pair_at = at.astype(np.int32)
        self.left, self.right = (x.astype(np.int32) for x in np.divmod(pairs, len(self.words) + 1))

    def keys(self, kind: int) -> np.ndarray:
        if kind == WORDS:
            return self.words.astype(np.uint64)
        history = np.append(self.words, START)[self.left].astype(np.uint64)
        return mix64(history * np.uint64(0x9E3779B97F4A7C15) + mix64(self.words[self.right].astype(np.uint64))) >> np.uint64(64 - PAIR_BITS)

    def sorted_keys(self, kind: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys in order, the order, and where each of the 2^bits slices of the range begins."""
        keys = self.keys(kind)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        width = 64 if kind == WORDS else PAIR_BITS
        edges = np.arange(1 << bits, dtype=np.uint64) << np.uint64(width - bits) if bits else np.zeros(1, np.uint64)
        return keys, order, np.append(np.searchsorted(keys, edges), len(keys))

    def learned(self, kind: int) -> np.ndarray:
        """How often each word or pair stands in the block's training documents."""
        at, n = (self.tokens, len(self.words)) if kind == WORDS else (self.pair_at, len(self.left))
        return np.bincount(at[self.learns], minlength=n)


def slices_of(block: Block, bits: tuple[int, int]) -> pa.RecordBatch:
    rows = []
    for kind in (WORDS, PAIRS):
        keys, order, edges = block.sorted_keys(kind, bits[kind])
        counts = block.learned(kind)[order]
        for s in np.flatnonzero(np.diff(edges)).tolist():
            a, b = edges[s], edges[s + 1]
            rows.append((kind, s, block.number, packed(np.diff(keys[a:b], prepend=np.uint64(0)), 8), packed(counts[a:b], 4)))
    return record(SLICE, rows)


def ask(bits: tuple[int, int]):
    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("no words", dict)  # those of the blocks are not looked up again
        for batch in batches:
            for i in range(batch.num_rows):
                yield slices_of(Block(batch.slice(i, 1).to_pylist()[0]), bits)  # no name: one block at a time in memory
    return slices


def answered(part: pa.Table) -> pa.RecordBatch:
    """A slice's counts summed over the blocks, in the order of each."""
    keys = [np.cumsum(unpacked(k.as_py(), 8), dtype=np.uint64) for k in part.column("keys")]
    ends = np.cumsum([len(k) for k in keys])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    del keys
    counts = np.concatenate([unpacked(c.as_py(), 4).astype(np.uint32) for c in part.column("counts")])
    totals = np.add.reduceat(counts[order], firsts, dtype=np.int64)
    del counts
    answers = np.empty(len(order), np.int64)
    answers[order] = np.repeat(totals, np.diff(firsts, append=len(order)))
    del order
    kind, slice_ = part.column("kind")[0].as_py(), part.column("slice")[0].as_py()
    rows = [(kind, slice_, block, packed(a, 8), 0, 0) for block, a in zip(part.column("block").to_pylist(), np.split(answers, ends[:-1]), strict=True)]
    rows[0] = (*rows[0][:4], int((totals > 0).sum()), int(totals.sum()))
    return record(ANSWER, rows)


def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum each slice's counts over the blocks, and answer every block in its own order."""
    names = ("kind", "slice")
    for table in grouped(batches, names):
        for s, e in zip(*bounds(table, names), strict=True):
            yield answered(table.slice(s, e - s))


class Automaton:
    """Arcs (state, word) -> (weight, state), and a failure arc per state; state 0 has an arc for every word."""

    def __init__(self, states: np.ndarray, words: np.ndarray, weights: np.ndarray, targets: np.ndarray,
                 failure_weights: np.ndarray, plain_weights: np.ndarray, plain_targets: np.ndarray):
        self.arcs = HashIndex(states.astype(np.uint64) << np.uint64(32) | words.astype(np.uint64))
        self.weights, self.targets = weights, targets
        self.failure_weights = failure_weights
        self.plain_weights, self.plain_targets = plain_weights, plain_targets

    def read(self, tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first: int) -> np.ndarray:
        """Log10 weight of each text; all texts advance side by side, longest first, one token a step."""
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        state, total = np.full(len(starts), first, np.int64), np.zeros(len(starts))
        alive = np.searchsorted(-lengths, -np.arange(int(lengths.max()) if len(lengths) else 0), "left").tolist()
        for step, n in enumerate(alive):
            word, here = tokens[starts[:n] + step], state[:n]
            arc = self.arcs.find(here.astype(np.uint64) << np.uint64(32) | word.astype(np.uint64))
            hit = arc >= 0
            # A missing arc fails to state 0, which has one for every word.
            total[:n] += np.where(hit, self.weights[arc], self.failure_weights[here] + self.plain_weights[word])
            state[:n] = np.where(hit, self.targets[arc], self.plain_targets[word])
        out = np.empty(len(starts))
        out[order] = total
        return out


def automaton_of(block: Block, word_totals: np.ndarray, pair_totals: np.ndarray, n: int, kinds: int, texts: int, strength: float) -> Automaton:
    """State 0 without history, 1 the beginning of a text, 2 + i the i-th word of the block."""
    plain = (word_totals + 1.0) / (n + kinds + 1)
    history = np.append(word_totals, texts).astype(float)
    seen = np.flatnonzero(pair_totals > 0)
    left, right = block.left[seen], block.right[seen]
    weights = np.log10((pair_totals[seen] + strength * plain[right]) / (history[left] + strength))
    state_of = np.append(np.where(word_totals > 0, np.arange(len(word_totals)) + 2, 0), 1)
    failure = np.concatenate([[0.0], np.log10(strength / (np.append(texts, word_totals) + strength))])
    return Automaton(state_of[left], right, np.append(weights, 0.0), np.append(state_of[right], 0), failure, np.log10(plain), state_of[:-1])


def scored(table: pa.Table, bits: tuple[int, int], n: int, kinds: int, texts: int, strength: float) -> pa.RecordBatch:
    """A block and the answers to it, the block first, then by kind and slice."""
    block, totals = Block(table.slice(0, 1).to_pylist()[0]), []
    kind_of = table.column("kind").to_numpy()
    for kind in (WORDS, PAIRS):
        order = block.sorted_keys(kind, bits[kind])[1]
        out = np.empty(len(order), np.int64)
        out[order] = np.concatenate([unpacked(a.as_py(), 8).astype(np.int64) for a in table.column("totals").filter(pa.array(kind_of == kind))])
        totals.append(out)
    known = np.add.reduceat((totals[WORDS] > 0)[block.tokens], block.starts, dtype=np.int64)
    base = np.add.reduceat(np.log10((totals[WORDS] + 1.0) / (n + kinds + 1))[block.tokens], block.starts)
    automaton = automaton_of(block, *totals, n, kinds, texts, strength)
    return pa.RecordBatch.from_arrays([
        pa.array(block.doc_ids, pa.int64(), mask=block.null_id), pa.array(block.lengths, pa.int64()), pa.array(known), pa.array(base),
        pa.array(automaton.read(block.tokens, block.starts, block.lengths, 1))], names=[f.split()[0] for f in SCORED.split(", ")])


def score_blocks(bits: tuple[int, int], n: int, kinds: int, texts: int, strength: float):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only("no words", dict)
        for table in grouped(batches, ("block",)):
            for s, e in zip(*bounds(table, ("block",)), strict=True):
                yield scored(table.slice(s, e - s), bits, n, kinds, texts, strength)
    return score


def slice_bits(keys: int, config: LmConfig) -> int:
    return max(0, (-(-keys // config.slice_keys) - 1).bit_length())


def scores(docs: DataFrame, learns: Column, config: LmConfig = LmConfig()) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every row of ``docs`` (doc_id, text).

    ``learns`` marks the rows the counts come from; null counts as false. A null or empty text is an end alone. Without
    training rows every token is unknown, and both scores are the same.
    """
    spark = docs.sparkSession
    blocks = stored(in_blocks(docs, learns, config), "lm-blocks")
    tokens = blocks.agg(F.sum(F.octet_length("words")).alias("w"), F.count("*").alias("n")).first()
    bits = (slice_bits((tokens["w"] or 0) // 8, config), slice_bits((tokens["n"] or 0) * config.block_tokens, config))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    answers = stored(blocks.mapInArrow(ask(bits), SLICE).repartition(n, "kind", "slice").sortWithinPartitions("kind", "slice")
                     .mapInArrow(add_up, ANSWER), "lm-counts")
    facts = answers.filter(F.col("kind") == WORDS).agg(F.sum("n_kinds").alias("kinds"), F.sum("n_tokens").alias("tokens")).first()
    kinds, total = int(facts["kinds"] or 0), int(facts["tokens"] or 0)
    texts = docs.filter(F.coalesce(learns, F.lit(False))).count()
    # Blocks and answers are sorted together and read one after the other, so that no task holds those of all its blocks.
    told = blocks.select("*", F.lit(-1).alias("kind"), F.lit(-1).cast("long").alias("slice")).unionByName(
        answers.select("block", "kind", "slice", "totals"), allowMissingColumns=True)
    return (told.repartition(n, "block").sortWithinPartitions("block", "kind", "slice")
            .mapInArrow(score_blocks(bits, total, kinds, texts, config.strength), SCORED)
            .select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"))
