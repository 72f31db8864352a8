"""Mixing sources to target weights (DataFrame operations only).

Words are counted per document, summed per source, and each source's share of the whole is turned into a repetition
rate.  A document is then emitted ``floor(rate)`` times plus one Bernoulli copy whose probability is the fraction and
whose draw is a seeded hash of the document's id, so a rerun takes the same copies.  The draw is compared with the
fraction as it falls among the source's own draws, weighted by words (``rates``): with long documents, or a source of a
few, independent draws miss the target by several percent.

Targets: sources sorted by code point (null last) weigh 5, 2, 1, 5, 2, 1, ... and share the whole; no target passes
``MAX_REPEATS`` times its source's size, and what is cut off is shared again by weight.  That is water filling: with
``cap`` the largest target of a source, the level L at which ``sum(min(cap, L * weight))`` is the whole is found from
running sums over the sources in the order of cap / weight.  One row per source is sorted, never one per document.

Defined cases: null or blank text has size 0 and is taken 0 times as many words; a null source is a source of its own;
repeated rows get the same draw; when all sizes are 0 all targets are 0; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aulastar.llm.joins import join_groups
from aulastar.llm.store import stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
SEED = "mix-1"
DRAW_BITS = 52
BINS = 4096   # of the draws, per source


def words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def draw(key: Column, seed: str = SEED) -> Column:
    """Uniform in [0, 1) from 52 bits of a digest of the key and the seed."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(":" + seed)))
    return F.conv(F.substring(digest, 1, DRAW_BITS // 4), 16, 10).cast("double") / F.lit(float(1 << DRAW_BITS))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, size) -> (source, source_size, target, rate).  One row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("long")
    s = sizes.select("source", "source_size", weight.alias("w"), (F.col("source_size") * repeats).alias("cap"))
    everyone = Window.partitionBy()
    level = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    upto, before = level.rowsBetween(Window.unboundedPreceding, 0), level.rowsBetween(Window.unboundedPreceding, -1)
    s = s.select("*", F.sum("source_size").over(everyone).alias("total"), F.sum("w").over(everyone).alias("all_w"),
                 F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"), F.coalesce(F.sum("w").over(before), F.lit(0)).alias("w_before"))
    # with all sources of a lower cap / weight at their caps, this one reaches its own at that level or not
    here = (F.col("total") - F.col("cap_before")).cast("double") / (F.col("all_w") - F.col("w_before")).cast("double")
    s = s.select("*", here.alias("here"), (here * F.col("w") >= F.col("cap")).alias("full"))
    water = F.first(F.when(~F.col("full"), F.col("here")), ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(water * F.col("w"))
    s = s.select("source", "source_size", target.alias("target"))
    return s.withColumn("rate", F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(repeats)))).otherwise(F.lit(0.0)))


def rates(words_by_bin: DataFrame) -> DataFrame:
    """(source, bin, words) -> (source, source_size, target, whole, below): a document of the source is taken ``whole``
    times, and once more if its draw's bin is under ``below``.

    ``below`` is the bin boundary nearest to the fraction of the rate *in words*: the draws of a source are uniform, so
    it differs from the fraction by the luck of the draws alone, and without that luck the words taken meet the target."""
    per = targets(words_by_bin.groupBy("source").agg(F.sum("words").alias("source_size")))
    per = per.withColumns({"whole": F.floor("rate"), "goal": (F.col("rate") - F.floor("rate")) * F.col("source_size")})
    run = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    upto = words_by_bin.select(F.col("source").alias("s"), (F.col("bin") + 1).alias("k"), F.sum("words").over(run).alias("upto"))
    near = per.join(upto, F.col("source").eqNullSafe(F.col("s")), "left").groupBy("source", "source_size", "target", "whole", "goal").agg(
        F.min(F.struct(F.abs(F.col("upto").cast("double") - F.col("goal")).alias("off"), "k")).alias("best"))
    below = F.when(F.col("goal") <= F.col("best.off"), F.lit(0)).otherwise(F.col("best.k"))
    return near.select("source", "source_size", "target", F.col("whole").cast("long").alias("whole"), below.alias("below"))


def _bin(key: Column, seed: str) -> Column:
    return F.floor(draw(key, seed) * BINS).cast("int")


def _with_rates(rows: DataFrame, binned: DataFrame) -> DataFrame:
    """``rows`` (with ``__mix_source``) and their source's __mix_size, __mix_target, __mix_whole and __mix_below.
    ``binned``: (source, bin, words, docs)."""
    per = rates(binned.select("source", "bin", "words")).withColumnRenamed("source", "s")
    docs = binned.groupBy("source").agg(F.sum("docs").alias("__mix_docs"))
    per = docs.join(per, F.col("source").eqNullSafe(F.col("s"))).select(
        _name(F.col("source")).alias("__mix_source"), "__mix_docs", F.col("source_size").alias("__mix_size"), F.col("target").alias("__mix_target"),
        F.col("whole").alias("__mix_whole"), F.col("below").alias("__mix_below"))
    per = stored(per, "mix-rates")
    total = per.agg(F.sum("__mix_docs")).first()[0] or 0
    return join_groups(rows, per, ["__mix_source"], "__mix_docs", total)


def _name(source: Column) -> Column:
    """The null source joins as a name of its own."""
    return F.coalesce(F.concat(F.lit("s:"), source.cast("string")), F.lit("null"))


def _binned(rows: DataFrame) -> DataFrame:
    return stored(rows.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")), "mix-bins")


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """One row per document: size, its source's size and target, and how many copies the mix takes."""
    sized = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), _bin(F.col(id_col), seed).alias("bin"))
    sized = stored(sized, "mix-sizes")
    joined = _with_rates(sized.withColumn("__mix_source", _name(F.col("source"))), _binned(sized))
    copies = F.col("__mix_whole") + (F.col("bin") < F.col("__mix_below")).cast("long")
    return joined.select("doc_id", "source", "size", F.col("__mix_size").alias("source_size"), F.col("__mix_target").alias("target"), copies.alias("copies"))


def mix_report(docs: DataFrame, **options) -> DataFrame:
    return mix_plan(docs, **options).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED) -> DataFrame:
    """The mixed documents themselves: every column of ``docs`` plus ``mix_copy``, one row per copy taken."""
    sized = docs.select(F.col(source_col).alias("source"), _bin(F.col(id_col), seed).alias("bin"), words(F.col(text_col)).alias("size"))
    joined = _with_rates(docs.withColumn("__mix_source", _name(F.col(source_col))), _binned(sized))
    copies = (F.col("__mix_whole") + (_bin(F.col(id_col), seed) < F.col("__mix_below")).cast("long")).cast("int")
    return (joined.withColumn("__mix_copies", copies).filter("__mix_copies > 0")
            .select(*[F.col(f"`{c}`") for c in docs.columns], F.explode(F.sequence(F.lit(1), F.col("__mix_copies"))).alias("mix_copy")))
