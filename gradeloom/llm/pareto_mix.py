"""Mixing sources to target weights by Pareto order sampling.

Sources get shares of all words by weight, at most ``max_copies`` times what they hold.
Within a source a document is expected ``copies = min(max_copies, scale * preference)``
times. The whole part of that is certain. The fractional part is an inclusion
probability ``p``: documents are ranked by their random odds divided by their inclusion
odds, ``u / (1 - u) / (p / (1 - p))``, and taken in this order until the words still
missing are filled. Last, up to two documents that fit close what is left of the gap.

The rank is cut by counting words in 32768 slices of its range and then in 32768 slices
of the slice that holds the cut, so a source that holds most of the table is counted in
partial sums like any other; only one slice of a slice is put in order.

Random numbers come from a hash of the id, so reruns agree. A null or blank text has
size 0 and is taken like its neighbours in rank; a source without words has target 0 and
gives nothing. A null source sorts last and is a source of its own. Rows equal in id and
size share one fate. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeloom.llm.common import WORD, stored
from gradeloom.operators.ordered import with_ordinal

_SLICES = 32768
_DRAW_BITS = 52
FRAGMENT_WORDS = 50
FRAGMENT_PREFERENCE = 0.5


def word_count(text: str | Column) -> Column:
    """Number of words; 0 for null."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(WORD)).cast("long")


def prefer_long(size: str) -> Column:
    """Fragments are wanted half as often as other documents."""
    return F.when(F.col(size) < FRAGMENT_WORDS, F.lit(FRAGMENT_PREFERENCE)).otherwise(F.lit(1.0))


def _draw(id_col: str, seed: str) -> Column:
    """Uniform number between 0 and 1 from 52 bits of a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    bits = F.conv(F.substring(F.md5(key.cast("binary")), 1, _DRAW_BITS // 4), 16, 10).cast("long")
    return (bits + F.lit(0.5)) / F.lit(float(1 << _DRAW_BITS))


def source_targets(sources: DataFrame, weights: Sequence[int], max_copies: int) -> DataFrame:
    """Add ``target`` to (source, source_size): shares by weight, held to the limit.

    Raising the level of water: sources at their limit leave the rest to the others.
    Each step is two sums; it ends when no further source reaches its limit.
    """
    cycle = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("ord") % len(weights) + 1).cast("int"))
    placed = with_ordinal(sources, [F.col("source").asc_nulls_last()]).withColumn("weight", cycle.cast("long"))
    placed = stored(placed.drop("ord"), "mix-sources")
    limit = F.col("source_size") * max_copies
    total = placed.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, 0
    while True:
        at_limit = F.lit(False) if level is None else limit < F.lit(level) * F.col("weight")
        row = placed.agg(
            F.sum(F.when(at_limit, limit).otherwise(0)),
            F.sum(F.when(at_limit, 0).otherwise(F.col("weight"))),
            F.count(F.when(at_limit, 1)),
        ).first()
        if level is not None and row[2] == full:
            break
        full = row[2]
        level = (total - row[0]) / row[1] if row[1] else 0.0
    target = F.least(limit.cast("double"), F.lit(float(level)) * F.col("weight"))
    return placed.withColumn("target", target)


def _scales(levels: DataFrame, targets: DataFrame, max_copies: int) -> DataFrame:
    """Per source the scale that makes the expected words equal the target.

    The most preferred levels reach ``max_copies`` first; a source has few levels.
    """
    by_preference = Window.partitionBy("source").orderBy(F.col("preference").desc())
    before = by_preference.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_preference.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    joined = _with_source(levels, targets.select("source", "source_size", "target"))
    capped = F.coalesce(F.sum("words").over(before), F.lit(0))
    rest = F.sum(F.col("words") * F.col("preference")).over(onward)
    tried = joined.withColumn("rest", rest).withColumn(
        "scale", F.when(F.col("rest") > 0, (F.col("target") - max_copies * capped) / F.col("rest"))
    )
    fits = F.when(F.col("scale") * F.col("preference") <= max_copies, F.col("scale"))
    # Without a fitting level every document is at the limit.
    most = F.max_by(fits, F.when(fits.isNotNull(), F.col("preference")))
    scale = F.when(F.first("target") > 0, F.coalesce(most, F.lit(1e9))).otherwise(F.lit(0.0))
    return tried.groupBy("source", "source_size", "target").agg(scale.alias("scale"))


def _with_source(left: DataFrame, right: DataFrame) -> DataFrame:
    other = right.withColumnRenamed("source", "__source")
    return left.join(other, left["source"].eqNullSafe(other["__source"]), "left").drop("__source")


def _ranked(df: DataFrame, max_copies: int) -> DataFrame:
    """Add the certain copies, the inclusion probability and the rank between 0 and 1."""
    copies = F.least(F.lit(float(max_copies)), F.col("scale") * F.col("preference"))
    odds = (F.col("u") / (F.lit(1.0) - F.col("u"))) * ((F.lit(1.0) - F.col("p")) / F.col("p"))
    return (
        df.withColumn("copies", copies)
        .withColumn("whole", F.floor("copies").cast("long"))
        .withColumn("p", F.col("copies") - F.col("whole"))
        .withColumn("odds", F.when(F.col("p") > 0, odds))
        .withColumn("place", F.col("odds") / (F.lit(1.0) + F.col("odds")) * _SLICES)
        .withColumn("slice_1", F.floor("place").cast("int"))
        .withColumn("slice_2", F.floor((F.col("place") - F.col("slice_1")) * _SLICES).cast("int"))
        .withColumn("key", F.when(F.col("p") > 0, F.struct("place", F.col("id").alias("id"), F.col("size").alias("size"))))
    )


def _cut(rows: DataFrame, slices: str, budget: str) -> DataFrame:
    """The slice of each source in which its budget of words runs out."""
    sums = rows.groupBy("source", budget, slices).agg(F.sum("size").alias("words"))
    upto = F.sum("words").over(Window.partitionBy("source").orderBy(slices))
    over = sums.withColumn("upto", upto).where(F.col("upto") > F.col(budget))
    first = over.groupBy("source").agg(F.min_by(F.struct(slices, (F.col("upto") - F.col("words")).alias("before")), slices).alias("c"))
    return first.select("source", F.col(f"c.{slices}").alias(f"cut_{slices}"), F.col("c.before").alias(f"before_{slices}"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (1, 2, 3),
    max_copies: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    preference=prefer_long,
    seed: str = "mix",
) -> DataFrame:
    """row (a struct of all columns), size, source_size, target and copies of every row.

    ``copies`` is how many times the mix takes the row.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), _draw(id_col, seed).alias("u")
    ).withColumn("preference", preference("size"))
    compact = stored(rows, "mix-rows")
    levels = stored(compact.groupBy("source", "preference").agg(F.sum("size").alias("words")), "mix-levels")
    targets = source_targets(levels.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_copies)
    scaled = stored(_scales(levels, targets, max_copies), "mix-scales")

    whole = _with_source(levels, scaled)
    whole = whole.withColumn("whole", F.floor(F.least(F.lit(float(max_copies)), F.col("scale") * F.col("preference"))))
    certain = whole.groupBy("source", "source_size", "target", "scale").agg(F.sum(F.col("whole") * F.col("words")).alias("certain"))
    plan = stored(certain.withColumn("budget", F.col("target") - F.col("certain")).drop("certain"), "mix-plan")

    ranked = _ranked(_with_source(compact, plan), max_copies).where(F.col("p") > 0)
    first = stored(_cut(ranked, "slice_1", "budget"), "mix-cut")
    inside = _with_source(ranked, first).where(F.col("slice_1") == F.col("cut_slice_1"))
    inside = inside.withColumn("left", F.col("budget") - F.col("before_slice_1"))
    second = stored(_cut(inside, "slice_2", "left"), "mix-cut")
    last = _with_source(inside, second).where(F.col("slice_2") == F.col("cut_slice_2"))
    in_order = Window.partitionBy("source").orderBy("key")
    last = last.withColumn("upto", F.sum("size").over(in_order))
    end = last.where(F.col("upto") <= F.col("left") - F.col("before_slice_2")).groupBy("source").agg(F.max("key").alias("end_key"))

    taken_before = F.col("slice_1") < F.coalesce(F.col("cut_slice_1"), F.lit(_SLICES))
    same_slice = F.col("slice_1") == F.col("cut_slice_1")
    in_slice = F.col("slice_2") < F.coalesce(F.col("cut_slice_2"), F.lit(_SLICES))
    at_end = (F.col("slice_2") == F.col("cut_slice_2")) & F.coalesce(F.col("key") <= F.col("end_key"), F.lit(False))
    selected = F.coalesce(taken_before | (same_slice & (in_slice | at_end)), F.lit(False)) & (F.col("p") > 0)

    limits = _with_source(_with_source(_with_source(plan, first), second), end)
    limits = stored(limits.withColumns({"fill_1": F.lit(None).cast(_key_type(ranked)), "fill_2": F.lit(None).cast(_key_type(ranked))}), "mix-limits")
    is_filled = F.coalesce(F.col("key") == F.col("fill_1"), F.lit(False)) | F.coalesce(F.col("key") == F.col("fill_2"), F.lit(False))
    for fill in ("fill_1", "fill_2"):
        marked = _ranked(_with_source(compact, limits), max_copies).withColumn("in", selected | is_filled)
        gaps = marked.groupBy("source").agg(
            (F.first("budget") - F.sum(F.when(F.col("in"), F.col("size")).otherwise(0))).alias("gap")
        )
        limits = stored(_closed(limits, _with_source(marked, stored(gaps, "mix-gaps")), fill), "mix-limits")

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    keyed = docs.select(
        row, F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(text_col).alias("size"), _draw(id_col, seed).alias("u")
    ).withColumn("preference", preference("size"))
    # The decision needs the small table of limits only.
    decided = _ranked(_with_source(keyed, limits), max_copies)
    copies = F.coalesce(F.col("whole") + F.when(selected | is_filled, 1).otherwise(0), F.lit(0)).cast("long")
    return decided.select("row", "size", "source_size", "target", copies.alias("copies"))


def _key_type(df: DataFrame) -> str:
    return df.select("key").schema[0].dataType.simpleString()


def _closed(limits: DataFrame, marked: DataFrame, fill: str) -> DataFrame:
    """Choose per source the largest row not yet in that fits the gap."""
    fits = (~F.col("in")) & (F.col("p") > 0) & (F.col("size") <= F.col("gap")) & (F.col("size") > 0)
    best = marked.where(fits).groupBy("source").agg(F.max_by("key", F.struct("size", "key")).alias("new"))
    return _with_source(limits.drop(fill), best).withColumnRenamed("new", fill)


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: every row as many times as it is taken."""
    taken = mixed.where(F.col("copies") > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
