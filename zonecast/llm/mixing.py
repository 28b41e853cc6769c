"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source has a share of all words by its weight, at most ``max_epochs`` times its own words; what exceeds
that goes to the others by weight. A source first gives whole epochs, every document once each, and then a
part of one more: documents in the order of exponential keys -ln(u) / quality, u a hash of the id, up to the words
that are left. A document that would exceed them is passed over, and the gap goes round a few more times among
the following documents of its part that fit; what then remains goes to the document nearest to it in size, if that is
nearer than leaving it.

No large source is sorted as a whole. Keys fall into equal parts of the unit interval, as many as the source's own rows
fill; sizes are summed by source and part, a running sum finds the part in which the budget ends, and only its documents are sorted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import WORD
from zonecast.session import stored

SYMBOLS = "0123456789#*$%&|<>{}[]()=+_~^@\\/"
SMALL_SOURCES = 50_000
"""The table of sources is broadcast up to that many rows, of under 100 bytes and a name each; more are joined by a shuffle."""


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (5, 2, 1)
    max_epochs: int = 3
    seed: int = 20
    part_rows: int = 4096
    rounds: int = 4


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(text: Column) -> Column:
    """Share of characters that are no digits or symbols, at least 0.1; 0.1 for a null or empty text."""
    length = F.length(text)
    symbols = length - F.length(F.translate(text, SYMBOLS, ""))
    return F.coalesce(F.greatest(F.lit(0.1), 1.0 - symbols / F.nullif(length, F.lit(0))), F.lit(0.1))


def uniform(doc_id: Column, seed: int) -> Column:
    """A number in (0, 1) from a hash of the id; the same in every run."""
    digits = F.substring(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / float(1 << 52)


def keyed(config: MixConfig) -> list[Column]:
    """doc_id, source, size, the exponential key, and a hash of the text that orders rows of equal ids."""
    text = F.col("text")
    key = -F.log(uniform(F.col("doc_id"), config.seed)) / quality(text)
    return [F.col("doc_id"), F.col("source"), word_count(text).alias("size"), key.alias("es_key"), F.xxhash64(text).alias("tie")]


def part(key: Column, parts: Column) -> Column:
    return F.least(parts - 1, F.floor((1.0 - F.exp(-key)) * parts).cast("long"))


def targets(sizes: DataFrame, config: MixConfig) -> DataFrame:
    """source, source_size, target, parts, one row per source of ``sizes`` (source, size).

    Weights go round by the order of the names. Sources are taken by the level at which they reach their
    limit; one is at its limit if the level, with all before it at theirs, is not below its own.
    """
    by_source = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.ceil(F.count(F.lit(1)) / config.part_rows).cast("long").alias("parts"))
    turn = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy("level", F.col("source").asc_nulls_last())
    weights = F.array(*[F.lit(w) for w in config.weights])
    level = (by_source
             .withColumn("weight", F.get(weights, (F.row_number().over(turn) - 1) % len(config.weights)))
             .withColumn("limit", config.max_epochs * F.col("source_size"))
             .withColumn("level", F.col("limit") / F.col("weight")))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = level.withColumn("reached", left / weight_left).withColumn("full", F.col("reached") >= F.col("level"))
    common = F.min(F.when(~F.col("full"), F.struct("level", "source", "reached"))).over(whole)["reached"]
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(common * F.col("weight"))
    return shared.select("source", "source_size", target.alias("target"), "parts")


def cuts(rows: DataFrame, config: MixConfig) -> DataFrame:
    """Per source its target, whole epochs, and where the fractional epoch ends: a part, and the last row taken inside it."""
    spark = rows.sparkSession
    goal = stored(targets(rows, config)
                  .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
                  .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-goal")
    place = part(F.col("es_key"), F.col("g.parts"))
    summed = (small(rows.alias("s"), goal.alias("g"), spark).groupBy("g.source", "g.rest", place.alias("part")).agg(F.sum("s.size").alias("words"))
              .withColumn("end", F.sum("words").over(Window.partitionBy("source").orderBy("part"))))
    ends = (summed.filter("end > rest").groupBy("source")
            .agg(F.min(F.struct("part", (F.col("end") - F.col("words")).alias("before"))).alias("stop"))
            .select("source", "stop.part", "stop.before"))
    stops = stored(goal.join(ends.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")), "left")
                   .select("source", "source_size", "target", "epochs", "rest", "parts", F.coalesce("part", "parts").alias("stop"), F.coalesce("before", F.lit(0)).alias("before")), "mix-stops")
    by_source = Window.partitionBy("g.source")
    running = by_source.orderBy("es_key", "doc_id", "s.size", "tie").rowsBetween(Window.unboundedPreceding, 0)
    row = F.struct("es_key", "doc_id", F.col("s.size").alias("size"), "tie")
    inside = (small(rows.alias("s"), stops.alias("g"), spark)
              .filter(place == F.col("g.stop")).withColumn("row", row)
              .withColumn("gap", F.col("rest") - F.col("before")).withColumn("taken", F.lit(False)))
    rounds = []
    for i in range(config.rounds):
        fits = ~F.col("taken") & (F.col("s.size") <= F.col("gap"))
        inside = inside.withColumn("fits", fits).withColumn("at", F.sum(F.when(F.col("fits"), F.col("s.size")).otherwise(0)).over(running))
        now = F.col("fits") & (F.col("at") <= F.col("gap"))
        inside = inside.withColumn("now", now).withColumns({
            f"gap{i}": F.col("gap"), f"last{i}": F.max(F.when(F.col("now"), F.col("row"))).over(by_source),
            "gap": F.col("gap") - F.coalesce(F.max(F.when(F.col("now"), F.col("at"))).over(by_source), F.lit(0)),
            "taken": F.col("taken") | F.col("now")})
        rounds.append(F.struct(F.col(f"gap{i}").alias("gap"), F.col(f"last{i}").alias("last")))
    miss = F.abs(F.col("gap") - F.col("s.size"))
    found = (inside.withColumn("rounds", F.array(*rounds)).groupBy("g.source").agg(
        F.first("rounds").alias("rounds"),
        F.min(F.when(~F.col("taken") & (miss < F.col("gap")), F.struct(miss.alias("miss"), "row"))).alias("filler"))
        .select(F.col("source").alias("name"), "rounds", F.col("filler.row").alias("filler")))
    return stored(stops.join(found, F.col("source").eqNullSafe(F.col("name")), "left")
                  .select("source", "source_size", "target", "epochs", "parts", "stop", "rounds", "filler"), "mix-cuts")


def small(rows: DataFrame, by_source: DataFrame, spark) -> DataFrame:
    """Join rows (alias s) with the table of sources (alias g); broadcast after its rows have been counted."""
    if by_source.count() <= SMALL_SOURCES:
        by_source = F.broadcast(by_source)
    return rows.join(by_source, F.col("s.source").eqNullSafe(F.col("g.source")))


def with_copies(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    """``rows`` of :func:`keyed` with more columns, beside source_size, target, copies."""
    place = part(F.col("es_key"), F.col("parts"))
    row = F.struct("es_key", "doc_id", F.col("s.size").alias("size"), "tie")
    inside = F.coalesce(F.exists("rounds", lambda r: (F.col("s.size") <= r.gap) & F.coalesce(row <= r.last, F.lit(False))), F.lit(False))
    inside |= F.coalesce(row == F.col("filler"), F.lit(False))
    partial = ((place < F.col("stop")) | ((place == F.col("stop")) & inside)).cast("long")
    return (small(rows.alias("s"), by_source.alias("g"), rows.sparkSession)
            .withColumn("copies", F.when(F.col("s.size") > 0, F.col("epochs") + partial).otherwise(0)))


def mixture(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """doc_id, size, source_size, target, taken of every row of ``docs`` (doc_id, text, source).

    A null text or one without words has size 0 and gives nothing; a null source is a source of its own.
    Rows with the same id and text go in or stay out together.
    """
    rows = stored(docs.select(*keyed(config)), "mix-rows")
    return (with_copies(rows, cuts(rows, config))
            .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")))


def mixed(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The mix itself: every row as often as it is taken, all columns as they were."""
    rows = stored(docs.select(*keyed(config)), "mix-rows")
    by_source = cuts(rows, config)
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return (with_copies(docs.select(whole.alias("row"), *keyed(config)), by_source).filter("copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*"))
