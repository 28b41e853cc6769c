"""Near-duplicate classes: MinHash signatures, a multi-index Hamming join, exact confirmation.

Texts with the same set of word shingles are one node, whatever their ids; nodes are numbered, and ids matter only for the
texts that represent a node and at the end. A node's signature has ``chunks * chunk`` MinHash values
of 16 bits. Two signatures that differ in at most ``2 * chunks - 1`` values have, by the pigeonhole
principle, a chunk in which they differ in at most one; so every chunk gives one key for each of its
values left out, and such a pair meets under a key whatever the value that differs. Under each key the nodes
within that distance are linked by star edges, never by all pairs; under a key with more nodes than one task
should hold, all of them are linked to its smallest one, near or not. The connected components of
these edges hold every pair within the distance. Inside a component, blocks of bounded size
compare the full shingle sets of all members, and only those links count. A component of many blocks is compared
in two steps: every block with itself and with the first one, which already joins a large group of copies; then
only members of different classes are left to compare.

With 60 values, a pair of similarity 0.85 lies beyond the distance of 23 with a probability of about 1e-5;
a pair below it never becomes a link.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import ascii_words, bounded_batches, chunks, only, ranges
from zonecast.session import stored

PROFILE = "n_shingles long, set_hash binary, signature binary"


@dataclass(frozen=True)
class NearDupConfig:
    """Two documents are linked if 100 * common shingles >= ``percent`` * all their shingles.

    ``block_nodes`` and ``block_shingles`` bound what one verification task holds of a component; a larger
    component is cut into blocks, and two blocks meet in a task of their own. Under a key of more than ``key_nodes``
    nodes no distances are taken. The table of who meets where is broadcast up to ``small_tasks`` rows of 64 bytes.
    """

    words: int = 5
    percent: int = 85
    chunks: int = 12
    chunk: int = 5
    block_nodes: int = 2000
    block_shingles: int = 1_000_000
    key_nodes: int = 20_000
    small_tasks: int = 300_000

    @property
    def values(self) -> int:
        return self.chunks * self.chunk

    @property
    def distance(self) -> int:
        return 2 * self.chunks - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a number of them."""

    KEPT = 300_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.KEPT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def word_hashes() -> WordHashes:
    return only("word-hashes", WordHashes)


def shingle_hashes(texts: list[str], words: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles, text after text, repeats included, and their number in each text.

    A text with fewer words has one shingle, all its words; a text without words has none.
    """
    found = [ascii_words(text) for text in texts]
    sizes = np.array([len(w) for w in found], np.int64)
    hashes = np.fromiter(map(word_hashes().__getitem__, chain.from_iterable(found)), np.uint64, int(sizes.sum()))
    starts, counts = np.cumsum(sizes) - sizes, np.where(sizes >= words, sizes - words + 1, np.minimum(sizes, 1))
    first = ranges(starts, counts)
    length = np.repeat(np.minimum(sizes, words), counts)
    total = length.astype(np.uint64)
    for j, factor in enumerate(odd_numbers(words, 7)):
        at = np.minimum(first + j, max(len(hashes) - 1, 0))
        total += np.where(j < length, hashes[at] * factor, np.uint64(0)) if len(hashes) else np.uint64(0)
    return mix64(total), counts


def signatures(hashes: np.ndarray, counts: np.ndarray, values: int) -> np.ndarray:
    """One row of 16-bit MinHash values for each text that has a shingle."""
    starts = (np.cumsum(counts) - counts)[counts > 0]
    out = np.zeros((len(starts), values), np.uint16)
    if len(starts):
        for i, factor in enumerate(odd_numbers(values, 11)):
            least = np.minimum.reduceat(hashes * factor, starts)
            out[:, i] = mix64(least) >> np.uint64(48)
    return out


def profile(text: Column, config: NearDupConfig) -> Column:
    """A struct of the number of distinct shingles, a 128-bit hash of the set, and the signature; null hash and signature for none."""
    bounded_batches()

    @F.pandas_udf(PROFILE)
    def profiled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, rows = [t if isinstance(t, str) else "" for t in batch], []
            for start, end in chunks(texts):
                hashes, counts = shingle_hashes(texts[start:end], config.words)
                rows_of = iter(signatures(hashes, counts, config.values))
                stop = np.cumsum(counts)
                for n, e in zip(counts.tolist(), stop.tolist(), strict=True):
                    if not n:
                        rows.append((0, None, None))
                        continue
                    own = np.unique(hashes[e - n:e])
                    rows.append((len(own), xxhash.xxh3_128_digest(own), next(rows_of).tobytes()))
            yield pd.DataFrame(rows, columns=["n_shingles", "set_hash", "signature"])

    return profiled.asNondeterministic()(text)


def chunk_keys(signature: Column, config: NearDupConfig) -> Column:
    """The keys of a signature: each chunk with each one of its values left out."""
    bounded_batches()

    @F.pandas_udf("array<long>")
    def keys(batch: pd.Series) -> pd.Series:
        rows = np.frombuffer(b"".join(batch), np.uint16).reshape(len(batch), config.chunks, config.chunk)
        out = np.zeros((len(batch), config.chunks, config.chunk), np.uint64)
        for left_out in range(config.chunk):
            for j in range(config.chunk):
                if j != left_out:
                    # Up to four values of 16 bits fit one to one; more are mixed in.
                    value = out[:, :, left_out]
                    out[:, :, left_out] = (value << np.uint64(16) | value >> np.uint64(48)) ^ rows[:, :, j]
        place = mix64(np.arange(1, config.values + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(1, config.chunks, config.chunk)
        return pd.Series(list(mix64(out ^ place).reshape(len(batch), -1).view(np.int64)), dtype=object)

    return keys(signature)


def grouped(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[pa.Table]:
    """Tables that hold whole groups of rows sorted by ``keys``; the last group of a batch waits for the next one."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in column], axis=0)) + 1
        if waiting:
            last = [waiting[-1].column(waiting[-1].schema.get_field_index(k))[-1].as_py() for k in keys]
            if last != [c[0].item() for c in column]:
                change = np.concatenate([[0], change])
        if len(change):
            yield pa.Table.from_batches([*waiting, batch.slice(0, int(change[-1]))], batch.schema)
            waiting = [batch.slice(int(change[-1]))]
        else:
            waiting.append(batch)
    if waiting:
        yield pa.Table.from_batches(waiting, waiting[0].schema)


def bounds(table: pa.Table, keys: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    column = [table.column(k).to_numpy() for k in keys]
    starts = np.concatenate([[0], np.flatnonzero(np.any([c[1:] != c[:-1] for c in column], axis=0)) + 1])
    return starts, np.append(starts[1:], table.num_rows)


def once(table: pa.Table, keys: tuple[str, ...]) -> pa.Table:
    """The first row for each value of ``keys`` of a table sorted by them."""
    starts, _ = bounds(table, keys)
    return table if len(starts) == table.num_rows else table.take(starts)


def row_key(doc_id: str, text: str) -> list[Column]:
    """What tells rows apart: the id, null or not, and a hash of the text."""
    return [F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash")]


def near_stars(nodes: np.ndarray, codes: np.ndarray, distance: int) -> tuple[list[int], list[int]]:
    """Star edges of the components that nodes within ``distance`` of each other form.

    A search that compares a node with those not reached so far only.
    """
    left, right = [], []
    waiting = np.arange(len(nodes))
    while len(waiting) > 1:
        frontier, members, waiting = [int(waiting[0])], [int(waiting[0])], waiting[1:]
        while frontier and len(waiting):
            one = frontier.pop()
            near = (codes[waiting] != codes[one]).sum(axis=1) <= distance
            reached = waiting[near].tolist()
            frontier += reached
            members += reached
            waiting = waiting[~near]
        if len(members) > 1:
            ids = nodes[members]
            least = int(ids.min())
            left += [least] * (len(members) - 1)
            right += [int(x) for x in ids if x != least]
    return left, right


def candidate_edges(nodes: DataFrame, config: NearDupConfig) -> DataFrame:
    """Edges (a, b), a < b, whose components hold every two nodes (rep, signature) within the distance."""
    keyed = nodes.select("rep", F.explode(chunk_keys(F.col("signature"), config)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least")).filter("n > 1")
    met = stored(keyed.join(shared, "key"), "dup-keys")
    meeting = met.filter(F.col("n") <= config.key_nodes).select("key", "rep")
    stars = met.filter(F.col("n") > config.key_nodes).select(F.col("least").alias("a"), F.col("rep").alias("b"))
    distance, values = config.distance, config.values

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ("key",)):
            starts, ends = bounds(table, ("key",))
            ids = table.column("rep").to_numpy()
            codes = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, values)
            two = starts[ends - starts == 2]
            near = two[(codes[two] != codes[two + 1]).sum(axis=1) <= distance]
            a, b = np.minimum(ids[near], ids[near + 1]).tolist(), np.maximum(ids[near], ids[near + 1]).tolist()
            for s, e in zip(starts[ends - starts > 2].tolist(), ends[ends - starts > 2].tolist(), strict=True):
                more_a, more_b = near_stars(ids[s:e], codes[s:e], distance)
                a += more_a
                b += more_b
            edges = pd.DataFrame({"a": a, "b": b}, dtype="int64").drop_duplicates()
            yield pa.RecordBatch.from_pandas(edges, preserve_index=False)

    rows = meeting.join(nodes.select("rep", "signature"), "rep")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    near = rows.repartition(n, "key").sortWithinPartitions("key").mapInArrow(link, "a long, b long")
    return near.union(stars).filter("a <> b").distinct()


class Forest:
    """Union by the smaller id."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        path = []
        while (up := self.parent.get(x, x)) != x:
            path.append(x)
            x = up
        for one in path:
            self.parent[one] = x
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            forest.join(a, b)
    nodes = list(forest.parent)
    yield pa.RecordBatch.from_pydict({"a": pa.array([forest.root(x) for x in nodes], pa.int64()), "b": pa.array(nodes, pa.int64())})


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """node, component (its smallest node) of every node of ``edges`` (a, b).

    Every partition first replaces its edges by stars. Then two steps alternate until nothing changes: larger neighbours are
    hung on the smallest neighbour, and so are the smaller ones. Each round is written to the shared folder.
    """
    def facts(table: DataFrame) -> tuple:
        row = table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return row[0], row[1]

    current = stored(edges.mapInArrow(_local_stars, "a long, b long").filter("a <> b").distinct(), purpose)
    known = facts(current)
    while True:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("m").alias("a"), "b").distinct()
        lowest = large.groupBy("b").agg(F.min("a").alias("m"))
        small = (large.join(lowest, "b").select(F.col("m").alias("x"), F.col("a").alias("y"))
                 .union(lowest.select(F.col("m").alias("x"), F.col("b").alias("y"))))
        following = stored(small.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), purpose)
        now = facts(following)
        if now == known:
            break
        current, known = following, now
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        current.select("a", F.col("a").alias("component")).distinct())


def exact_links(sets: list[np.ndarray], side: np.ndarray | None, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(x, all y) such that the sets x and y are linked; with ``side``, only x of side 0 and y of side 1.

    An inverted index gives the sizes of a set's intersections with all others at once.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    starts = np.cumsum(sizes) - sizes
    held = np.arange(len(ids)) if side is None else np.flatnonzero(side[owner] == 1)
    order = held[np.argsort(ids[held], kind="stable")]
    counts = np.bincount(ids[order], minlength=int(ids.max()) + 1)
    begins, owners = np.cumsum(counts) - counts, owner[order]
    for x in range(len(sets)) if side is None else np.flatnonzero(side == 0).tolist():
        own = ids[starts[x]:starts[x] + sizes[x]]
        common = np.bincount(owners[ranges(begins[own], counts[own])], minlength=len(sets))
        linked = 100 * common >= percent * (sizes[x] + sizes - common)
        linked &= common > 0
        linked[x] = False
        if side is not None:
            linked &= side == 1
        if linked.any():
            yield x, np.flatnonzero(linked)


def block_count(nodes: Column, shingles: Column, config: NearDupConfig) -> Column:
    return F.greatest(F.ceil(nodes / config.block_nodes), F.ceil(shingles / config.block_shingles)).cast("long")


def first_tasks(members: DataFrame, config: NearDupConfig) -> DataFrame:
    """Who meets where in the first step: each block of a component alone, and the first one with each other one.

    rep, the key of its text, component, and the blocks ``one`` and ``two`` that meet in the task, ``side`` the one of the
    row. A block is a pair of numbers: ``group``, 0 in this step, and its place in the group.
    """
    size = members.groupBy("component").agg(block_count(F.count("*"), F.sum("n_shingles"), config).alias("blocks"))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    others = F.when(F.col("own") == 0, F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).otherwise(F.array_distinct(F.array(F.lit(0).cast("long"), "own")))
    zero = F.lit(0).cast("long")
    return (members.join(size, "component").withColumn("own", own).withColumn("other", F.explode(others))
            .select("rep", "doc_id", "text_hash", "component", zero.alias("group_one"), F.least("own", "other").alias("one"), zero.alias("group_two"),
                    F.greatest("own", "other").alias("two"), (F.col("own") == F.greatest("own", "other")).cast("long").alias("side")))


def second_tasks(members: DataFrame, classes: DataFrame, config: NearDupConfig) -> DataFrame:
    """Who meets where in the second step, in components of more than two blocks.

    ``classes`` (node, component) are the classes after the first step. Classes of more than a block are groups of
    their own, numbered from 1, all others are group 0. Any two blocks meet, but those of the same class.
    """
    whole = members.groupBy("component").agg(block_count(F.count("*"), F.sum("n_shingles"), config).alias("of_component")).filter("of_component > 2")
    told = (members.join(whole, "component")
            .join(classes.select(F.col("node").alias("rep"), F.col("component").alias("class")), "rep", "left")
            .withColumn("class", F.coalesce("class", "rep")))
    by_class = told.groupBy("component", "class").agg(F.count("*").alias("nodes"), F.sum("n_shingles").alias("shingles"))
    by_class = by_class.withColumn("large", block_count(F.col("nodes"), F.col("shingles"), config) > 1)
    number = F.row_number().over(Window.partitionBy("component").orderBy("class")).cast("long")
    large = by_class.filter("large").select("component", "class", number.alias("group"))
    groups = stored(by_class.join(large, ["component", "class"], "left").withColumn("group", F.coalesce("group", F.lit(0).cast("long"))), "dup-groups")
    sized = groups.groupBy("component", "group").agg(block_count(F.sum("nodes"), F.sum("shingles"), config).alias("blocks"))
    blocks = sized.select("component", "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("own"))
    one, two = blocks.alias("x"), blocks.alias("y")
    first, second = F.struct("x.group", "x.own"), F.struct("y.group", "y.own")
    pairs = (one.join(two, F.col("x.component") == F.col("y.component"))
             .filter((F.col("x.group") == 0) & (F.col("y.group") == 0) | (F.col("x.group") != F.col("y.group")))
             .select(F.col("x.component").alias("component"), F.col("x.group").alias("group"), F.col("x.own").alias("own"),
                     F.least(first, second).alias("low"), F.greatest(first, second).alias("high"), (first >= second).cast("long").alias("side")))
    placed = (told.join(groups.select("component", "class", "group"), ["component", "class"]).join(sized, ["component", "group"])
              .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks"))))
    return (placed.join(pairs, ["component", "group", "own"])
            .select("rep", "doc_id", "text_hash", "component", F.col("low.group").alias("group_one"), F.col("low.own").alias("one"),
                    F.col("high.group").alias("group_two"), F.col("high.own").alias("two"), "side"))


def confirmed_links(docs: DataFrame, tasks: DataFrame, config: NearDupConfig) -> DataFrame:
    """Star edges of the exact links between the members that meet in a task."""
    words, percent = config.words, config.percent
    key = ("component", "group_one", "one", "group_two", "two")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, key):
            forest = Forest()
            table = once(table, (*key, "rep"))  # rows that repeat an id and its text
            ids, text, sides = table.column("rep").to_numpy(), table.column("text"), table.column("side").to_numpy()
            alone = np.all([table.column(a).to_numpy() == table.column(b).to_numpy() for a, b in (("group_one", "group_two"), ("one", "two"))], axis=0)
            for s, e in zip(*bounds(table, key), strict=True):
                side = None if alone[s] else sides[s:e]
                if e - s < 2 or side is not None and side.min() == side.max():
                    continue
                hashes, counts = shingle_hashes([t or "" for t in text.slice(s, e - s).to_pylist()], words)
                sets = [np.unique(x) for x in np.split(hashes, np.cumsum(counts)[:-1])]
                if e - s == 2:
                    common = len(np.intersect1d(*sets, assume_unique=True))
                    if common and 100 * common >= percent * (len(sets[0]) + len(sets[1]) - common):
                        forest.join(int(ids[s]), int(ids[s + 1]))
                    continue
                for x, linked in exact_links(sets, side, percent):
                    for y in linked.tolist():
                        forest.join(int(ids[s + x]), int(ids[s + y]))
            nodes = list(forest.parent)
            yield pa.RecordBatch.from_pydict({"a": pa.array([forest.root(x) for x in nodes], pa.int64()), "b": pa.array(nodes, pa.int64())})

    tasks = stored(tasks, "dup-tasks")
    if tasks.count() <= config.small_tasks:
        tasks = F.broadcast(tasks)  # then only the members' texts are shuffled, not all texts
    bounded_batches()
    texts = docs.select("text", *row_key("doc_id", "text"))
    rows = texts.join(tasks, texts["doc_id"].eqNullSafe(tasks["doc_id"]) & (texts["text_hash"] == tasks["text_hash"]))
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, *key).sortWithinPartitions(*key, "rep").select("rep", "text", "side", *key)
            .mapInArrow(verify, "a long, b long").filter("a <> b"))


def confirmed_classes(docs: DataFrame, members: DataFrame, config: NearDupConfig) -> DataFrame:
    """node, component by the exact links inside the components of ``members`` (rep, n_shingles, component)."""
    links = stored(confirmed_links(docs, first_tasks(members, config), config), "dup-first")
    classes = components(links, "dup-links")
    more = second_tasks(members, classes, config)
    if more.isEmpty():
        return classes
    return components(links.union(confirmed_links(docs, more, config)), "dup-links")


def near_duplicates(docs: DataFrame, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept, first of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id of the class; null if no row of it has one. ``first`` holds for one row of each class: the
    one with the smallest id, null ids last, then with the smallest hash of its text; of rows that repeat both, for one of them. ``kept`` is
    doc_id = component_id, or ``first`` for rows without an id. A row without words is a class of its own. Rows that repeat an id
    with other texts are different nodes, linked only if their texts are.
    """
    profiles = stored(docs.select(*row_key("doc_id", "text"), F.monotonically_increasing_id().alias("row"), profile(F.col("text"), config).alias("p"))
                      .select("doc_id", "text_hash", "row", "p.*"), "dup-profiles")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "row"))
    nodes = stored(profiles.filter("set_hash IS NOT NULL").groupBy("set_hash")
                   .agg(first.alias("first"), F.min("signature").alias("signature"), F.min("n_shingles").alias("n_shingles"))
                   .withColumn("rep", F.monotonically_increasing_id()), "dup-nodes")
    near = components(candidate_edges(nodes, config), "dup-candidates")
    members = stored(near.join(nodes.withColumnRenamed("rep", "node"), "node")
                     .select(F.col("node").alias("rep"), "first.doc_id", "first.text_hash", "n_shingles", "component"), "dup-members")
    classes = confirmed_classes(docs, members, config)
    by_node = nodes.join(classes.withColumnRenamed("node", "rep"), "rep", "left").select("set_hash", "first", F.coalesce("component", "rep").alias("class"))
    leaders = by_node.groupBy("class").agg(F.min("first").alias("leader"))
    by_set = by_node.join(leaders, "class").select("set_hash", "leader")
    # Rows without a set have no partner and need none, so they may meet nothing in the join.
    alone = F.col("set_hash").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("leader.doc_id"))
    is_first = alone | (F.col("row") == F.col("leader.row"))
    return (profiles.join(by_set, "set_hash", "left")
            .select("doc_id", "text_hash", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, is_first).alias("kept"), is_first.alias("first")))


def first_rows(docs: DataFrame, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """One row of each class of ``docs`` (doc_id, text and any more columns), all its columns as they were.

    Rows that repeat an id and its text are one class and leave one row, whatever their other columns: the one with the smallest hash of them.
    """
    found = stored(near_duplicates(docs.select("doc_id", "text"), config).select("doc_id", "text_hash", "first"), "dup-rows")
    keys = stored(found.groupBy("doc_id", "text_hash").agg(F.max("first").alias("first"), F.count(F.lit(1)).alias("n"))
                  .filter("first").select(F.col("doc_id").alias("own_id"), F.col("text_hash").alias("own_hash"), "n"), "dup-first-rows")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    rows = docs.select(whole.alias("whole"), *row_key("doc_id", "text"))

    def of(some: DataFrame) -> DataFrame:
        return rows.join(some, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_hash") == F.col("own_hash")), "left_semi")

    kept = of(keys.filter("n = 1")).select("whole.*")
    repeated = keys.filter("n > 1")
    if repeated.isEmpty():
        return kept
    one = of(repeated).groupBy("doc_id", "text_hash").agg(F.min_by("whole", F.xxhash64("whole")).alias("whole"))
    return kept.unionByName(one.select("whole.*"))
