"""Byte-level BPE: encoding and decoding by a rank file.

A text is cut by the split pattern; each piece that is no token as a whole is merged on its own. The new
pieces of a batch are put into padded integer matrices by length. In each round every row merges its
leftmost pair of minimum rank: all ranks of a matrix come from one hashed lookup of pairs, the merged
column closes up, rows without a mergeable pair leave. Pieces seen before come from a bounded table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.llm.common import HashIndex, Numbered, bounded_batches, chunks, only, ranges

NO_PAIR = np.int32(np.iinfo(np.int32).max)
WIDTHS = (4, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)
"""Widths of the matrices. A longer piece is merged alone with a heap, in the same order of merges."""
ROWS = 1 << 14
KEPT_PIECES = 300_000
"""Pieces whose ids a worker remembers. The table starts anew beyond that; results do not depend on it."""
ROUND_TRIP = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType())])


class ByteBpe:
    """``tokens[i]`` are the bytes of id i; a pair merges to the id of its joined bytes, the lowest id first."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.pattern = regex.compile(pattern)
        self.ids = {token: i for i, token in enumerate(tokens)}
        self.size = len(tokens)
        pairs = [(left, right, rank) for rank, token in enumerate(tokens) for cut in range(1, len(token))
                 if (left := self.ids.get(token[:cut])) is not None
                 and (right := self.ids.get(token[cut:])) is not None]
        table = np.array(pairs, np.uint64).reshape(-1, 3)
        self.pairs = HashIndex(table[:, 0] << np.uint64(32) | table[:, 1])
        self.ranks = np.append(table[:, 2].astype(np.int32), NO_PAIR)  # -1, not found, is the last
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int32)
        lengths = np.array([len(t) for t in tokens], np.int64)
        self.lengths, self.starts = lengths, np.cumsum(lengths) - lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.forget()

    def forget(self) -> None:
        self.known = Numbered()
        self.piece_ids = np.zeros(0, np.int32)
        self.piece_lengths = np.zeros(0, np.int64)
        self.piece_starts = np.zeros(0, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs; a padding id (-1) is in no pair."""
        return self.ranks[self.pairs.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))]

    def merge_matrix(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the padded rows to the end; returns the rows, and how many ids each has."""
        done = np.full_like(ids, -1)
        rows, ranks = np.arange(len(ids)), self.rank(ids[:, :-1], ids[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)  # the leftmost of the minima
            best = ranks[np.arange(len(rows)), at]
            over = best == NO_PAIR
            if over.any():
                done[rows[over], :ids.shape[1]] = ids[over]
                rows, ids, ranks, at, best = rows[~over], ids[~over], ranks[~over], at[~over], best[~over]
                if not len(rows):
                    break
            each, column = np.arange(len(rows)), np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), axis=1)
            ids[each, at] = best
            if ids.shape[1] == 1:
                done[rows, :1] = ids
                break
            column = column[:-1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), axis=1)
            inner = np.flatnonzero(at > 0)
            ranks[inner, at[inner] - 1] = self.rank(ids[inner, at[inner] - 1], ids[inner, at[inner]])
            inner = np.flatnonzero(at < ids.shape[1] - 1)
            ranks[inner, at[inner]] = self.rank(ids[inner, at[inner]], ids[inner, at[inner] + 1])
        return done, (done >= 0).sum(axis=1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """The same merges for one long piece: a heap of (rank, place) over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.rank(np.array(ids[:-1]), np.array(ids[1:])).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != NO_PAIR]
        heapq.heapify(heap)
        joined: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < n:
                pair = (ids[i], ids[j])
                if pair not in joined:
                    joined[pair] = int(self.rank(np.array(pair[:1]), np.array(pair[1:]))[0])
                if joined[pair] != NO_PAIR:
                    heapq.heappush(heap, (joined[pair], i, *pair))

        while heap:
            r, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([x for x in ids if x >= 0], np.int32)

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces not seen so far, and remember them."""
        coded = [piece.encode("utf-8", "replace") for piece in pieces]
        out: list[np.ndarray | None] = [None] * len(coded)
        by_width: dict[int, list[int]] = {}
        for i, piece in enumerate(coded):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = np.array([whole], np.int32)
            elif len(piece) > WIDTHS[-1]:
                out[i] = self.merge_long(piece)
            else:
                by_width.setdefault(next(w for w in WIDTHS if w >= len(piece)), []).append(i)
        for width, members in by_width.items():
            for begin in range(0, len(members), ROWS):
                part = members[begin:begin + ROWS]
                sizes = np.array([len(coded[i]) for i in part])
                matrix = np.full((len(part), width), -1, np.int32)
                matrix[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(coded[i] for i in part), np.uint8)]
                merged, lengths = self.merge_matrix(matrix)
                for i, row, n in zip(part, merged, lengths, strict=True):
                    out[i] = row[:n]
        lengths = np.array([len(x) for x in out], np.int64)
        begin = len(self.piece_ids)
        self.piece_ids = np.concatenate([self.piece_ids, *out])
        self.piece_starts = np.concatenate([self.piece_starts, begin + np.cumsum(lengths) - lengths])
        self.piece_lengths = np.concatenate([self.piece_lengths, lengths])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the number of ids of each text."""
        found = [self.pattern.findall(text) for text in texts]
        pieces = [piece for each in found for piece in each]
        if len(self.known) > KEPT_PIECES:
            self.forget()
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        if self.known.new:
            self.learn(self.known.new)
            self.known.new = []
        lengths = self.piece_lengths[at]
        ids = self.piece_ids[ranges(self.piece_starts[at], lengths)]
        owner = np.repeat(np.arange(len(texts)), [len(each) for each in found])
        return ids, np.bincount(owner, weights=lengths, minlength=len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, one after the other. An id outside the vocabulary is an error."""
        if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < self.size:
            raise ValueError(f"ids must lie in 0..{self.size - 1}")
        return self.bytes[ranges(self.starts[ids], self.lengths[ids])]


def load(path: str, pattern: str) -> ByteBpe:
    return only(("byte-bpe", path, pattern), lambda: read_ranks(path, pattern))


def read_ranks(path: str, pattern: str) -> ByteBpe:
    """Read a rank file: a line per token, its bytes in base64 and its rank, the ranks 0, 1, 2 ..."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"{path}: ranks must run from 0 without a gap")
    return ByteBpe([token for _, token in ranked], pattern)


def _texts(batch: pd.Series) -> list[str]:
    return [t if isinstance(t, str) else "" for t in batch]


def encoded(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text column as array<int>; a null text has none."""
    bounded_batches()

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path, pattern)
        for batch in batches:
            texts, out = _texts(batch), []
            for start, end in chunks(texts):
                ids, counts = bpe.encode(texts[start:end])
                out.extend(np.split(ids, np.cumsum(counts)[:-1]))
            yield pd.Series(out, dtype=object)

    return encode.asNondeterministic()(text)


def decoded(ids: Column, path: str, pattern: str) -> Column:
    """The bytes of an array<int> column; null has none."""
    bounded_batches()

    @F.pandas_udf("binary")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path, pattern)
        for batch in batches:
            yield pd.Series([bpe.decode(np.asarray(x if x is not None else [], np.int64)).tobytes() for x in batch], dtype=object)

    return decode.asNondeterministic()(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Encode and decode in one pass; a struct of the number of ids and the digests of ids and decoded bytes."""
    bounded_batches()

    @F.pandas_udf(ROUND_TRIP)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = load(path, pattern)
        for batch in batches:
            texts, rows = _texts(batch), []
            for start, end in chunks(texts):
                ids, counts = bpe.encode(texts[start:end])
                raw = bpe.decode(ids)
                id_ends = np.cumsum(counts)
                sizes = np.add.reduceat(np.append(bpe.lengths[ids], 0), id_ends - counts) * (counts > 0)
                byte_ends = np.cumsum(sizes)
                words = ids.astype("<u4")
                for n, i, size, b in zip(counts.tolist(), id_ends.tolist(), sizes.tolist(), byte_ends.tolist(), strict=True):
                    rows.append((n, hashlib.sha256(words[i - n:i]).hexdigest(), hashlib.sha256(raw[b - size:b]).hexdigest()))
            yield pd.DataFrame(rows, columns=ROUND_TRIP.names)

    return digest.asNondeterministic()(text)
