"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.rows import WORD, boxed, distinct_name, field
from ledgerloom.session import stage

WEIGHTS = (5, 2, 1)  # of the sources by code point, repeating, null last
MOST = 3  # a target stops at so many times its source's size
UNIT = 1 << 32  # expected copies are whole multiples of 1 / UNIT, so that their sums are exact in any order
SEED = 42


def words(text: str = "text") -> Column:
    """Number of words, 0 for a null text."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, target, units``: the words to take of each source, and expected copies of its documents.

    All sizes are shared by weight; a share above ``most`` sizes is cut to that, and the excess is shared again by
    weight. With the sources in order of size per weight, those that are cut are a prefix, so one running sum finds
    the fixed point. ``sizes`` has one row per source (``source, source_size``); only these rows meet in one task.
    """
    ordered = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weighed = sizes.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn.cast("int") + 1).cast("long"))
    rank = (F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    rising, everything = Window.orderBy(*rank), Window.partitionBy()
    before = F.sum(F.col("source_size") * most).over(rising.rowsBetween(Window.unboundedPreceding, -1))
    filled = weighed.select(
        "source", "source_size", "weight",
        F.row_number().over(rising).alias("turn"),
        (F.sum("source_size").over(everything) - F.coalesce(before, F.lit(0))).alias("rest"),
        F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing)).alias("sharing"),
    )
    cut = F.col("source_size") * most * F.col("sharing") < F.col("weight") * F.col("rest")
    level = F.min(F.when(~cut, F.struct("turn", "rest", "sharing"))).over(everything)
    shared = (F.col("weight") * F.col("level.rest")).cast("double") / F.col("level.sharing").cast("double")
    target = F.when(F.col("cut"), (F.col("source_size") * most).cast("double")).otherwise(shared)
    out = filled.select("source", "source_size", "weight", cut.alias("cut"), level.alias("level"))
    out = out.select("source", "source_size", target.alias("target"))
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    return out.withColumn("units", F.floor(copies * UNIT).cast("long"))


def offset(source: Column, seed: int = SEED) -> Column:
    """The source's random offset, 0 to UNIT - 1, from the seed and its name."""
    own = F.coalesce(F.concat(F.lit(f"{seed}:s"), source), F.lit(f"{seed}:n"))
    return F.conv(F.substring(F.md5(own), 1, 8), 16, 10).cast("decimal(38,0)")


def sample(sized: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``copies`` to rows with ``source, size, doc_id`` and ``units``, the expected copies of each row.

    Within a source, rows are laid on a line in order of size (so that every stretch of it takes rows of all sizes in
    turn), then id, each as long as its expected copies; the line starts at the source's random offset, and a row is
    emitted once per whole number that it crosses. The running sum is taken per range partition and shifted by the
    sums of the source's earlier partitions, so that a source that holds most rows is many tasks. Rows that agree in
    source, size and id may be exchanged for one another; the rest repeats exactly.
    """
    order = (F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id").isNull(), F.col("doc_id"))
    placed = sized.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(placed.withColumn("place", F.monotonically_increasing_id()), "placed")
    exact = F.col("units").cast("decimal(38,0)")
    parted = placed.withColumn("part", F.shiftright("place", 33)).withColumn("keyed", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    sums = parted.groupBy("keyed", "part").agg(F.sum(exact).alias("own"))
    before = Window.partitionBy("keyed").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage(sums.select("keyed", "part", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before")), "sums")
    inside = Window.partitionBy("keyed", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    run = parted.withColumn("upto", F.sum(exact).over(inside)).join(sums, ["keyed", "part"])
    end = (F.col("before") + F.col("upto") + offset(F.col("source"), seed)).cast("decimal(38,0)")
    run = run.withColumn("end", end).withColumn("start", (F.col("end") - exact).cast("decimal(38,0)"))
    copies = F.expr(f"(end div {UNIT}) - (start div {UNIT})").cast("long")
    return run.select(*sized.columns, copies.alias("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST, seed: int = SEED, key: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken`` (words), and ``key`` if given.

    ``taken`` is ``copies * size``, over a source close to its target. An empty or null text has size 0 and takes
    nothing; null sources are one source; repeated rows count each; an empty table gives an empty result.
    """
    extra = [key.alias("key")] if key is not None else []
    sized = stage(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), *extra), "sized")
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = stage(targets(per, weights, most), "targets")
    joined = sized.join(aims.withColumnRenamed("source", "_of"), F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    return sample(joined, seed).drop("units", "place").withColumn("taken", F.col("copies") * F.col("size"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document once per copy, with its columns, its size and target, and the copy's number.

    Rows that agree in every column stand for each other, so their copies are added up.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.concat_ws(":", F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns))
    counted = mix(docs, key=own, **options).filter("copies > 0")
    facts = ("size", "source_size", "target")
    counted = stage(counted.groupBy("key").agg(F.sum("copies").alias("copies"), *[F.first(c).alias(c) for c in facts]), "copies")
    found = boxed(docs, own=own).dropDuplicates(["own"]).join(counted, F.col("own") == F.col("key"))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias(distinct_name(docs, "copy"))
    return found.select(*[F.col(field(c)).alias(c) for c in docs.columns], *[F.col(c).alias(distinct_name(docs, c)) for c in facts], copies)
