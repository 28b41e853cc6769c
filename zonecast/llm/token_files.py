"""Token ids in files compressed by a pair grammar (Re-Pair), with random access.

Documents are encoded, ordered by id, and written as shards of consecutive documents. In a shard, frequent
pairs of neighbouring ids are replaced by new symbols until no pair stands often enough. A round ranks the frequent
pairs by their number and replaces a pair wherever it outranks the pairs it overlaps with, so all of the most frequent one and
most of the others go at once; in a run of one symbol every other place is a pair. Later rounds look only at the places of pairs
that were frequent and at those beside a new symbol, where alone a frequent pair can be. The rules, the number of ids behind each
symbol and the shortened sequence are stored; sums of these numbers find any id without expanding what stands before it.

The files are Parquet, one row per shard:

``part, shard``     range of ids, and place in it; their order is the order of documents
``first``           ids before the shard in its part
``n_ids``           ids in the shard
``doc_ids``         int64 per document;  ``null_id``  true if a document has no id (its entry is 0)
``doc_lengths``     int64, ids of each document, its end id included
``rules``           two uint32 per new symbol; the k-th one is ``base + k``
``expansions``      int64 per new symbol, the ids behind it
``sequence``        uint32 symbols
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonecast.llm.common import HashIndex, Numbered, bounded_batches, only, ranges

SHARD = ("part int, shard int, first long, n_ids long, base long, doc_ids binary, null_id binary, doc_lengths binary, "
         "rules binary, expansions binary, sequence binary")
KEPT_WORDS = 1_000_000
"""Words whose ids a worker remembers, about 250 MB. The table starts anew beyond that; results do not depend on it."""

CALL_CHARS = 1 << 22
"""Characters encoded in one call; a longer text is a call of its own."""


@dataclass(frozen=True)
class GrammarConfig:
    """A shard holds about ``shard_ids`` ids. At its end no pair stands ``least`` times (2 at least) in it."""

    shard_ids: int = 1 << 20
    least: int = 8


@dataclass(frozen=True)
class Grammar:
    base: int
    rules: np.ndarray
    expansions: np.ndarray
    sequence: np.ndarray

    def lengths(self, symbols: np.ndarray) -> np.ndarray:
        out = np.ones(len(symbols), np.int64)
        new = symbols >= self.base
        out[new] = self.expansions[symbols[new] - self.base]
        return out

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids behind symbols, by a table of what every rule stands for."""
        lengths = np.concatenate([np.ones(self.base, np.int64), self.expansions])
        rules = np.arange(self.base, self.base + len(self.rules))
        while (new := rules >= self.base).any():  # one level of rules at a time
            places = np.cumsum(1 + new) - (1 + new)
            wider = np.zeros(len(rules) + int(new.sum()), np.int64)
            wider[places[~new]] = rules[~new]
            wider[places[new]], wider[places[new] + 1] = self.rules[rules[new] - self.base].T
            rules = wider
        table = np.concatenate([np.arange(self.base), rules])
        return table[ranges((np.cumsum(lengths) - lengths)[symbols], lengths[symbols])]

    def ids(self, start: int, count: int) -> np.ndarray:
        """``count`` ids from the ``start``-th on; only the symbols that hold them are expanded."""
        ends = np.cumsum(self.lengths(self.sequence))
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + count, "left")
        before = int(ends[first - 1]) if first else 0
        return self.expand(self.sequence[first:last + 1])[start - before:start - before + count] if count else np.zeros(0, np.int64)


def pair_codes(sequence: np.ndarray, at: np.ndarray) -> np.ndarray:
    return sequence[at].astype(np.int64) << 32 | sequence[at + 1]


def countable(sequence: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of the pairs at the ascending places ``at`` count: in a run of one symbol every other one, from its start."""
    twins = np.flatnonzero(sequence[at] == sequence[at + 1])
    fine = np.ones(len(at), bool)
    if len(twins):
        places = at[twins]
        starts = np.concatenate([[True], np.diff(places) != 1])
        first = places[np.maximum.accumulate(np.where(starts, np.arange(len(places)), 0))]
        fine[twins[(places - first) % 2 == 1]] = False
    return fine


def frequent(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The codes that stand ``least`` times, and their ranks from 1 by number and code."""
    ordered = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, np.int64)
    counts = np.diff(np.append(starts, len(ordered)))
    often = counts >= least
    codes, counts = ordered[starts[often]], counts[often]
    rank = np.empty(len(codes), np.int32)
    rank[np.argsort(counts, kind="stable")] = np.arange(1, len(codes) + 1)  # the codes are in order
    return codes, rank


def compress(ids: np.ndarray, base: int, config: GrammarConfig = GrammarConfig()) -> Grammar:
    """The pair grammar of a sequence of ids below ``base``."""
    sequence, symbols, least = ids.astype(np.int32), base, max(2, config.least)
    rules = []
    live = np.arange(max(0, len(sequence) - 1))  # the places a frequent pair can have, in ascending order
    while len(live):
        codes, fine = pair_codes(sequence, live), countable(sequence, live)
        pairs, rank = frequent(codes[fine], least)
        if not len(pairs):
            break
        found = HashIndex(pairs.view(np.uint64)).find(codes.view(np.uint64))
        held = found >= 0
        live, found, fine = live[held], found[held], fine[held]
        own = rank[found] * fine
        apart = live[1:] - live[:-1] > 1
        above = fine.copy()
        above[1:] &= apart | (own[1:] > own[:-1])
        above[:-1] &= apart | (own[:-1] > own[1:])
        # A pair that would be replaced once only waits; the first in rank never does.
        number = np.bincount(found[above], minlength=len(pairs))
        above &= (number >= 2)[found]
        at, used = live[above], np.flatnonzero(number >= 2)
        name = np.zeros(len(pairs), np.int64)
        name[used] = symbols + np.arange(len(used))
        sequence[at] = name[found[above]]
        stays = np.ones(len(sequence), bool)
        stays[at + 1] = False
        new = at - np.arange(len(at))  # where the new symbols are in the shortened sequence
        again = np.zeros(len(sequence), bool)
        again[live[~above]] = True
        again, sequence = again[stays], sequence[stays]
        again[new] = again[np.maximum(new - 1, 0)] = True
        live = np.flatnonzero(again[:-1])
        rules.append(np.stack([pairs[used] >> 32, pairs[used] & 0xFFFFFFFF], axis=1))
        symbols += len(used)
    made = np.concatenate([np.zeros((0, 2), np.int64), *rules])
    size = np.ones(symbols, np.int64)
    at = base
    for some in rules:  # a rule's halves come from earlier rounds
        size[at:at + len(some)] = size[some].sum(axis=1)
        at += len(some)
    return Grammar(base, made, size[base:], sequence.astype(np.int64))


class WordEncoder:
    """The tokenizers library, called once for each new word.

    Its normaliser and splitter never look across ASCII white space, so a text's ids are its words' ids; upper and
    lower case are one to it, so A-Z is lowered first, but not in a text with combining marks: some compose with the small
    letter only. A word of letters is one piece to the splitter, and a mark behind it another, so letters are encoded
    by the hundred in one call, cut where a piece ends, and a marked word is put together from its letters and
    its mark. That does not hold of letters the normaliser turns into a letter and a combining mark; see ``parts_mark``.

    Small Latin letters below U+0250 stay as they are in the normaliser and are one piece, and printable ASCII is cut by the
    splitter's own rule, ``PIECES``: such pieces go to the library's model between spaces, past its normaliser and splitter.
    """

    MARKS = ",.;:!?"
    LATIN = "\u0250"
    PRINTABLE = re.compile(r"[!-@\[-~]+")
    PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.tokenizer.encode_special_tokens = True  # words are ordinary text; see ``encode`` for texts with added tokens
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        self.ends_piece = np.zeros(self.size, bool)
        self.ends_piece[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        self.marks = {mark: int(self.separately([mark])[0][0]) for mark in self.MARKS}
        self.parting: dict[str, bool] = {}
        self.forget()

    def forget(self) -> None:
        self.known = Numbered({b"": 0})
        self.ids = np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def separately(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words in one array, and how many each has."""
        ids = [done.ids for done in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        lengths = np.array([len(x) for x in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum())), lengths

    def together(self, words: list[str], tokenizer=None, pieces: list[list[str]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that are one piece each, or the given ones."""
        texts, number = (words, np.arange(1, len(words) + 1)) if pieces is None else (chain.from_iterable(pieces), np.cumsum(list(map(len, pieces))))
        ids = np.array((tokenizer or self.tokenizer).encode_batch_fast([" ".join(texts)], add_special_tokens=False)[0].ids, np.int32)
        ends = np.flatnonzero(self.ends_piece[ids]) + 1
        if len(ends) != number[-1]:
            return self.separately(words)
        return ids, np.diff(ends[number - 1], prepend=0)

    def parts_mark(self, letter: str) -> bool:
        """Whether a mark behind ``letter`` is a piece of its own, asked of the library once for each letter."""
        if letter not in self.parting:
            alone, marked = (int(self.ends_piece[self.separately([x])[0]].sum()) for x in (letter, letter + self.MARKS[0]))
            self.parting[letter] = marked == alone + 1
        return self.parting[letter]

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts by the library as loaded, added tokens found."""
        self.tokenizer.encode_special_tokens = False
        try:
            return [np.array(done.ids, np.int32) for done in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        finally:
            self.tokenizer.encode_special_tokens = True

    def keep(self, at: list[int], ids: np.ndarray, lengths: np.ndarray) -> None:
        """Append ids, and note where those of the words numbered ``at`` are."""
        self.starts[at] = len(self.ids) + np.cumsum(lengths) - lengths
        self.lengths[at] = lengths
        self.ids = np.concatenate([self.ids, ids])

    def learn(self) -> None:
        """Encode the words looked up since the last call."""
        latin, latin_at, cut, cut_at, pieces, plain, plain_at, marked, other, other_at = [], [], [], [], [], [], [], [], [], []
        at = len(self.lengths)
        while self.known.new:  # a second time for the letters looked up in the first
            texts = b" ".join(self.known.new).decode("utf-8").split(" ")
            self.known.new = []
            for at, text in enumerate(texts, at):
                if text.isalpha():
                    small = text.islower() and (text.isascii() or max(text) < self.LATIN)
                    (latin if small else plain).append(text)
                    (latin_at if small else plain_at).append(at)
                elif text[-1] in self.marks and text[:-1].isalpha() and self.parts_mark(text[-2]):
                    marked.append((at, self.known[text[:-1].encode()], self.marks[text[-1]]))
                elif self.PRINTABLE.fullmatch(text):
                    cut.append(text)
                    cut_at.append(at)
                    pieces.append(self.PIECES.findall(text))
                else:
                    other.append(text)
                    other_at.append(at)
            at += 1
        self.starts = np.concatenate([self.starts, np.zeros(at - len(self.starts), np.int64)])
        self.lengths = np.concatenate([self.lengths, np.zeros(at - len(self.lengths), np.int64)])
        done = [self.together(latin[i:i + 512], self.model) for i in range(0, len(latin), 512)]
        done += [self.together(cut[i:i + 512], self.model, pieces[i:i + 512]) for i in range(0, len(cut), 512)]
        done += [self.together(plain[i:i + 512]) for i in range(0, len(plain), 512)]
        if other:
            done.append(self.separately(other))
        if done:
            self.keep(latin_at + cut_at + plain_at + other_at, *map(np.concatenate, zip(*done, strict=True)))
        if marked:
            own, stems, marks = np.array(marked, np.int64).T
            lengths = self.lengths[stems] + 1
            ids = np.empty(int(lengths.sum()), np.int32)
            last = np.zeros(len(ids), bool)
            last[np.cumsum(lengths) - 1] = True
            ids[last] = marks
            ids[~last] = self.ids[ranges(self.starts[stems], lengths - 1)]
            self.keep(own, ids, lengths)

    def encode(self, texts: list[str], end_id: int, added_tokens: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, ``end_id`` after each, and the number of ids of each.

        The strings of added tokens are ordinary text, or, with ``added_tokens``, those tokens, as in the library as loaded.
        """
        special = [i for i, text in enumerate(texts) if any(a in text for a in self.added)] if added_tokens else []
        if special:
            own = set(special)
            out, counts = self.encode(["" if i in own else text for i, text in enumerate(texts)], end_id)
            each = np.split(out, np.cumsum(counts)[:-1])
            for i, ids in zip(special, self.whole([texts[i] for i in special]), strict=True):
                each[i] = np.append(ids, np.int32(end_id))
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        if len(self.known) > KEPT_WORDS:
            self.forget()
        coded = [text.encode("utf-8", "replace") for text in texts]
        # The first bytes of U+0300 to U+037F, which hold all marks that compose with A-Z or a-z.
        coded = [(c if b"\xcc" in c or b"\xcd" in c else c.lower()).strip() for c in coded]
        found = pc.ascii_split_whitespace(pa.array(coded, pa.binary()).view(pa.string()))
        # Every word of the call is looked up once; a text without words is one empty word to the splitter.
        words = found.values.dictionary_encode()
        numbers = np.fromiter(map(self.known.__getitem__, words.dictionary.view(pa.binary()).to_numpy(zero_copy_only=False)), np.int64, len(words.dictionary))
        at, sizes = numbers[words.indices.to_numpy()], np.diff(found.offsets.to_numpy())
        if self.known.new:
            self.learn()
        lengths = self.lengths[at]
        total = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        counts = np.diff(total) + 1
        out = np.full(int(counts.sum()), end_id, np.int32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = self.ids[ranges(self.starts[at], lengths)]
        return out, counts


def encoder(path: str) -> WordEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    return only(("word-bpe", path), lambda: WordEncoder(path))


def _shard_row(part: int, shard: int, first: int, base: int, ids: np.ndarray, doc_ids: list, lengths: list, config: GrammarConfig) -> dict:
    grammar = compress(ids, base, config)
    return {"part": part, "shard": shard, "first": first, "n_ids": len(ids), "base": base,
            "doc_ids": np.array([x or 0 for x in doc_ids], "<i8").tobytes(), "null_id": np.array([x is None for x in doc_ids], bool).tobytes(),
            "doc_lengths": np.array(lengths, "<i8").tobytes(), "rules": grammar.rules.astype("<u4").tobytes(),
            "expansions": grammar.expansions.astype("<i8").tobytes(), "sequence": grammar.sequence.astype("<u4").tobytes()}


def write_shards(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, config: GrammarConfig = GrammarConfig(),
                 added_tokens: bool = False) -> None:
    """Encode doc_id, text and write the shards of all documents in ascending order of ids.

    With ``added_tokens`` the ids are those of the library as loaded; without, strings of added tokens are ordinary text.
    A null or empty text is the end id alone. Null ids come first; rows with equal ids are ordered by a hash of their texts.
    """
    names = [field.split()[0] for field in SHARD.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = encoder(tokenizer), TaskContext.get().partitionId()
        shard, first, held, doc_ids, lengths, size = 0, 0, [], [], [], 0

        def row() -> pa.RecordBatch:
            one = _shard_row(part, shard, first, words.size, np.concatenate(held), doc_ids, lengths, config)
            return pa.RecordBatch.from_pylist([one], schema=pa.schema([
                (n, pa.int32() if n in ("part", "shard") else pa.int64() if n in ("first", "n_ids", "base") else pa.binary()) for n in names]))

        for batch in batches:
            texts, ids = [t or "" for t in batch.column(1).to_pylist()], batch.column(0).to_pylist()
            step = 0
            while step < len(texts):
                stop, chars = step, 0
                while stop < len(texts) and (not chars or chars + len(texts[stop]) <= CALL_CHARS):
                    chars += len(texts[stop]) + 1
                    stop += 1
                coded, counts = words.encode(texts[step:stop], end_id, added_tokens)
                for doc_id, one, n in zip(ids[step:stop], np.split(coded, np.cumsum(counts)[:-1]), counts.tolist(), strict=True):
                    if size and size + n > config.shard_ids:
                        yield row()
                        shard, first, held, doc_ids, lengths, size = shard + 1, first + size, [], [], [], 0
                    held.append(one)
                    doc_ids.append(doc_id)
                    lengths.append(n)
                    size += n
                step = stop
        if doc_ids:
            yield row()

    bounded_batches()
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (docs.select("doc_id", "text").repartitionByRange(n, F.col("doc_id"), F.xxhash64("text")).sortWithinPartitions(
        F.col("doc_id"), F.xxhash64("text")).mapInArrow(write, SHARD)
     .write.option("compression", "zstd").parquet(folder))


def grammar_of(base: int, rules: bytes, expansions: bytes, sequence: bytes) -> Grammar:
    return Grammar(base, np.frombuffer(rules, "<u4").astype(np.int64).reshape(-1, 2), np.frombuffer(expansions, "<i8"),
                   np.frombuffer(sequence, "<u4").astype(np.int64))


def read_shards(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 and, if wanted, the ids of every document."""
    schema = "doc_id long, part int, inner long, n_tokens long, ids_crc32 long" + (", ids array<int>" if ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                grammar = grammar_of(row["base"], row["rules"], row["expansions"], row["sequence"])
                coded = grammar.expand(grammar.sequence).astype("<u4")
                lengths = np.frombuffer(row["doc_lengths"], "<i8")
                ends = np.cumsum(lengths)
                view = memoryview(coded).cast("B")
                crc = [zlib.crc32(view[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                null = np.frombuffer(row["null_id"], bool)
                columns = [pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=null), pa.array(np.full(len(lengths), row["part"], np.int32)),
                           pa.array(row["first"] + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(coded.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "part", "inner", "n_tokens", "ids_crc32", "ids"][:len(columns)])

    shards = spark.read.parquet(folder)
    # One row per part of the range, so at most as many as the shuffle has partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (shards.groupBy("part").agg(F.sum("n_ids").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("part", "before"))
    docs = shards.mapInArrow(read, schema).join(F.broadcast(parts), "part")
    return docs.select("doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
