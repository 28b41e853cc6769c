"""Helpers shared by the text operators: input tables, text batches, a hash index over integers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
CHUNK_CHARS = 1 << 18
SPACES = re.compile(rb"[\x20\x09-\x0d]+")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches() -> None:
    """Let Arrow hand texts to Python in batches of a few MB, whatever their length; a longer text is a batch of its own."""
    conf = SparkSession.active().conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


_HELD: dict = {}


def only(key, build):
    """``build()`` for ``key``, kept in this Python worker until another key is asked for.

    Workers serve one operator after the other; just the tables of the present one stay in memory.
    """
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def crc_mod(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def ascii_words(text: str) -> list[bytes]:
    """Words between the six ASCII white-space characters, with A-Z in lower case.

    ``bytes`` methods know ASCII only, so other letters and other spaces stay as they are.
    """
    return text.encode("utf-8", "replace").lower().split()


def chunks(texts: list[str], chars: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of about ``chars`` characters; a longer text is a range of its own."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > chars:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)


class HashIndex:
    """Position of each of the given distinct unsigned 64-bit keys, by open addressing.

    At most half of the slots are taken; all keys of a call are probed side by side.
    """

    MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        keys = np.ascontiguousarray(keys, dtype=np.uint64)
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        pending, at = np.arange(len(keys), dtype=np.int32), self._home(keys)
        while len(pending):
            free = self.slots[at] < 0
            self.slots[at[free]] = pending[free]
            lost = self.slots[at] != pending
            pending, at = pending[lost], (at[lost] + 1) & self.mask
        self.held = np.zeros(1 << bits, np.uint64)
        taken = self.slots >= 0
        self.held[taken] = keys[self.slots[taken]]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MULTIPLIER) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Positions of the keys, -1 where a key is not held; of the shape of ``keys``."""
        shape, keys = keys.shape, keys.ravel()
        at = self._home(keys)
        found = self.slots[at]
        open_ = np.flatnonzero((found >= 0) & (self.held[at] != keys))
        while len(open_):
            here = (at[open_] + 1) & self.mask
            at[open_] = here
            found[open_] = self.slots[here]
            open_ = open_[(found[open_] >= 0) & (self.held[here] != keys[open_])]
        return found.reshape(shape)


class Numbered(dict):
    """Numbers keys in the order they are first looked up; ``new`` holds those not dealt with yet."""

    def __init__(self, held=()):
        super().__init__(held)
        self.new: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.new.append(key)
        return number


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
