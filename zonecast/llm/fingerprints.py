"""Order MinHash fingerprints, in DataFrame functions only.

The k-mers of a text are its runs of ``k`` words; the n-th occurrence of the same k-mer is numbered n, so repeats count.
The hashes of the numbered k-mers are one random permutation of them, dealt into bins by their top bits. In
each bin the ``picks`` smallest are selected, put back into text order, and hashed as one tuple: a bin's entry
agrees in two texts only if they share the selected k-mers and have them in the same order, which is what
makes the share of agreeing bins sensitive to edit distance and not only to the set of k-mers.

A fingerprint is the bins that hold anything, in order, ten hexadecimal digits each: two of the bin, eight of its tuple.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
PLACE_BITS = 24
"""Low bits of a packed k-mer hold its place; the others its hash. Texts of more than 16 million words still work, their places wrap."""
BIN_BITS = 6


@dataclass(frozen=True)
class OrderMinHash:
    k: int = 3
    picks: int = 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def kmers(words: Column, k: int) -> Column:
    """A hash of each run of k words; of all words together if there are fewer; nothing for no words."""
    def run(word: Column, i: Column) -> Column:
        return F.xxhash64(word, *[F.get(words, i + j) for j in range(1, k)])
    whole = F.array(F.xxhash64(F.concat_ws(" ", words)))
    return (F.when(F.size(words) == 0, F.array().cast("array<bigint>")).when(F.size(words) < k, whole)
            .otherwise(F.slice(F.transform(words, run), F.lit(1), F.size(words) - (k - 1))))


def packed(value: Column, place: Column) -> Column:
    low = (1 << PLACE_BITS) - 1
    return value.bitwiseAND(F.lit(~low)).bitwiseOR(place.cast("bigint").bitwiseAND(F.lit(low)))


def numbered(hashes: Column) -> Column:
    """Packed hashes of (k-mer, number of its occurrence), sorted. Equal k-mers are neighbours once sorted, in text order."""
    def upper(x: Column) -> Column:
        return F.shiftright(x, PLACE_BITS)

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))

    def own(x: Column, n: Column) -> Column:
        return packed(F.xxhash64(upper(x), n), place(x))

    def by_runs(rows: Column) -> Column:
        def begins(i: Column) -> Column:
            return (i == 0) | (upper(F.get(rows, i)) != upper(F.get(rows, i - 1)))

        def spread(starts: Column) -> Column:
            def run(start: Column, j: Column) -> Column:
                size = F.coalesce(F.get(starts, j + 1), F.size(rows)) - start
                return F.transform(F.slice(rows, start + 1, size), own)
            once = F.transform(rows, lambda x: own(x, F.lit(0)))
            return F.when(F.size(starts) == F.size(rows), once).otherwise(F.flatten(F.transform(starts, run)))
        return let(F.filter(F.sequence(F.lit(0), F.size(rows) - 1), begins), spread)

    sorted_rows = F.sort_array(F.transform(hashes, packed))
    return F.when(F.size(hashes) == 0, F.array().cast("array<bigint>")).otherwise(F.sort_array(let(sorted_rows, by_runs)))


def bin_of(x: Column) -> Column:
    return F.shiftright(x, 64 - BIN_BITS)


def tuples(rows: Column, picks: int) -> Column:
    """The entries of the bins, as text, from the sorted numbered k-mers."""
    def selected(x: Column, i: Column) -> Column:
        return (i < picks) | (bin_of(x) != bin_of(F.get(rows, i - picks)))

    def entry(picked: Column) -> Column:
        def first(x: Column, i: Column) -> Column:
            return (i == 0) | (bin_of(x) != bin_of(F.get(picked, i - 1)))

        def one(x: Column, i: Column) -> Column:
            mates = F.filter(F.slice(picked, i + 1, picks), lambda y: bin_of(y) == bin_of(x))
            # The place goes to the top, so that sorting restores the order of the text.
            ordered = F.sort_array(F.transform(mates, lambda y: F.struct(
                y.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("place"), F.shiftright(y, PLACE_BITS).alias("kmer"))))
            code = F.xxhash64(F.transform(ordered, lambda y: y["kmer"]))
            return F.concat(F.lpad(F.hex(bin_of(x) + (1 << BIN_BITS - 1)), 2, "0"), F.lpad(F.hex(code.bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
        return F.array_compact(F.transform(picked, lambda x, i: F.when(first(x, i), one(x, i))))
    return let(F.filter(rows, selected), entry)


def entries(text: Column, config: OrderMinHash = OrderMinHash()) -> Column:
    """array<string>, one entry per bin that holds a k-mer; empty for a null text or one without words."""
    return let(words_of(text), lambda words: let(kmers(words, config.k), lambda hashes: let(numbered(hashes), lambda rows: tuples(rows, config.picks))))


def fingerprint(entry_list: Column) -> Column:
    return F.lower(F.array_join(entry_list, ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of the bins held by either text whose entries agree; 1 if neither holds any."""
    bins = F.size(F.array_union(F.transform(a, lambda x: F.left(x, F.lit(2))), F.transform(b, lambda x: F.left(x, F.lit(2)))))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def range_of(doc_id: Column, bounds: list) -> Column:
    """The number of bounds that are not above the id, by halving; 0 for a null id."""
    if not bounds:
        return F.lit(0)
    size = 1 << len(bounds).bit_length()
    steps = F.array(*[F.lit(size >> i) for i in range(1, size.bit_length())])
    table = F.array(*[F.lit(b) for b in bounds])

    def halve(found: Column, step: Column) -> Column:
        return found + F.when(F.coalesce(F.get(table, found + step - 1) <= doc_id, F.lit(False)), step).otherwise(0)
    return F.aggregate(steps, F.lit(0), halve)


def in_ranges(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, Window]:
    """The rows dealt into ranges of ascending ids, each with a copy (``guard``) of the row behind its last one.

    The row behind the last range is the first of all. With the window returned, ``lead`` of a row that
    is no guard is its successor, without a sort of the whole table. The ranges are four per shuffle
    partition; what the driver sees of them is their bounds.
    """
    spark: SparkSession = docs.sparkSession
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / wanted for i in range(1, wanted)]
    found = docs.agg(F.percentile_approx("doc_id", shares, 20 * wanted)).first()[0] or []
    dealt = docs.select(*columns, range_of(F.col("doc_id"), sorted(set(found))).alias("range"))
    firsts = dealt.groupBy("range").agg(F.min("doc_id").alias("least"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).collect()
    firsts = sorted((r["range"], None if r["nulls"] else r["least"]) for r in firsts)
    edges = [(least, firsts[i - 1][0]) for i, (_, least) in enumerate(firsts)]  # the first range follows the last one
    kind = docs.schema["doc_id"].dataType.simpleString()
    edge = F.broadcast(spark.createDataFrame(edges, f"first {kind}, before int"))
    own = F.struct(F.col("range"), F.lit(False).alias("guard"))
    also = F.struct(F.col("before").alias("range"), F.lit(True).alias("guard"))
    rows = (dealt.join(edge, F.col("doc_id").eqNullSafe(F.col("first")), "left")
            .withColumn("at", F.explode(F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, also))))
            .select(*columns, F.col("at.range").alias("range"), F.col("at.guard").alias("guard")))
    return rows, Window.partitionBy("range").orderBy("guard", "doc_id", F.xxhash64("text"))


def edited_neighbours(docs: DataFrame, config: OrderMinHash = OrderMinHash()) -> DataFrame:
    """Fingerprints of every text, of its edited text, and how like they and the next document's are.

    ``docs`` has doc_id and text. The edited text is the text whose last quarter is replaced by the beginning, as
    long, of the next document by ascending id; the first one follows the last. A null text is empty. Null
    ids come first, rows of equal ids in the order of a hash of their texts. An only document is its own next.
    """
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows, order = in_ranges(plain, ["doc_id", "text"])
    n = F.length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.left("text", n - tail), F.left("next_text", tail))
    made = (rows.withColumn("next_text", F.coalesce(F.lead("text").over(order), F.lit("")))
            .select("doc_id", "range", "guard", "text", n.cast("long").alias("n_chars"), edited.alias("edited")))
    hashed = made.select("doc_id", "range", "guard", "text", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                         entries(F.col("text"), config).alias("own"), entries(F.col("edited"), config).alias("other"))
    return (hashed.withColumn("next", F.coalesce(F.lead("own").over(order), F.array().cast("array<string>"))).filter("NOT guard")
            .select("doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("other")).alias("edited_fingerprint"),
                    likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next")))
