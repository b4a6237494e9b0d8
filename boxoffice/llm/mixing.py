"""Mixing sources to target weights with Efraimidis-Spirakis sampling, in DataFrame functions only.

Sources share the words of the whole corpus by weight; no source is read more than ``most``
times, and what it cannot take is shared out again. Within a source every document is taken in
each complete epoch. The rest of the target is a weighted sample without replacement: documents
are ordered by an exponential key divided by their quality weight, and taken while the running
sum of their sizes stays within the budget. The key comes from a hash of seed and id, so that
reruns agree.

A source may hold most of the corpus, so it is never sorted whole: keys fall into ranges, ranges
are summed, and only the range in which the budget ends is sorted, one row for each id and size
in it, so that an id may hold most of a source as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxoffice.llm.scratch import small, stored

WORD = r"[^\x20\x09-\x0D]+"
# Ranges that the keys of one source fall into; one range of it is sorted by one task.
RANGES = 4096

_PRE = "mix__"
_SOURCE, _SIZE, _KEY, _RANGE, _ROW = (f"{_PRE}{name}" for name in ("source", "size", "key", "range", "row"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size) with ``target`` for each source.

    Sources by code point, null last, weigh ``weights``, repeating. The level L at which the
    targets min(most * size, L * weight) add up to the total is found in one pass: in the order
    of most * size / weight, the sources before some point are full and the rest share what is
    left. Empty sources get 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights)) + 1)
    filling = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.withColumn("weight", weight)
        .withColumn("full_at", F.col("source_size") * float(most) / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("source_size").over(before), F.lit(0)) * float(most))
        .withColumn(
            "share", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
        )
        .withColumn("level", F.col("left") / F.col("share"))
        .withColumn("place", F.row_number().over(filling))
    )
    # The first source, in that order, which its level does not fill; all before it are full.
    open_level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("place", "level"))).over(everything)
    return ranked.withColumn("open_level", open_level["level"]).select(
        "source",
        "source_size",
        F.least(
            F.col("source_size") * float(most),
            F.coalesce(F.col("open_level"), F.lit(float("inf"))) * F.col("weight"),
        ).alias("target"),
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    quality: Column | None = None,
    weights: tuple[float, ...] = (5, 2, 1),
    most: int = 3,
    seed: int = 17,
) -> DataFrame:
    """(id, size, source_size, target, taken, times) for every row: how often the mix takes it.

    ``quality`` is a positive weight for each row, by default 0.5 for an empty text rising to 1 at 100
    words; null, zero and less count as the smallest one allowed, 1e-6. A null text has size 0, a null source is a source. Repeated rows are separate
    documents that share a key. An empty table gives an empty result.
    """
    size = word_count(F.col(text_col).cast("string"))
    if quality is None:
        quality = 0.5 + F.least(size, F.lit(100)) / 200.0
    # Uniform in (0, 1]; an exponential key divided by the weight.
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / float(1 << 52)
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).alias(_SOURCE),
            size.alias(_SIZE),
            (-F.log(uniform) / F.greatest(F.coalesce(quality.cast("double"), F.lit(0.0)), F.lit(1e-6))).alias(_KEY),
        )
        # Falls as the key grows and is even for weights about one; any such rule gives the same sample.
        .withColumn(_RANGE, F.floor(F.lit(float(RANGES)) * (1 - F.exp(-F.col(_KEY)))))
        .withColumn(_ROW, F.monotonically_increasing_id()),
        "mix-rows",
    )
    ranges = stored(rows.groupBy(_SOURCE, _RANGE).agg(F.sum(_SIZE).alias("range_size")), "mix-ranges")
    sizes = ranges.groupBy(F.col(_SOURCE).alias("source")).agg(F.sum("range_size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, most), "mix-targets")
    plan = _plan(ranges, targets)
    placed = rows.join(
        plan, rows[_SOURCE].eqNullSafe(plan["source"]) & (rows[_RANGE] == plan["range"])
    ).drop("source", "range")
    return _taken(placed, most).select(
        F.col("id").alias(id_col),
        F.col(_SIZE).alias("size"),
        "source_size",
        "target",
        (F.col("times") * F.col(_SIZE)).alias("taken"),
        "times",
    )


def _plan(ranges: DataFrame, targets: DataFrame) -> DataFrame:
    """For each source and range: complete epochs, the budget of the rest, and the words of earlier ranges."""
    earlier = Window.partitionBy(_SOURCE).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.withColumn("earlier", F.coalesce(F.sum("range_size").over(earlier), F.lit(0)))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    joined = sums.join(targets, sums[_SOURCE].eqNullSafe(targets["source"])).withColumn("epochs", epochs.cast("long"))
    return stored(
        joined.select(
            "source",
            F.col(_RANGE).alias("range"),
            "range_size",
            "earlier",
            "source_size",
            "target",
            "epochs",
            (F.col("target") - F.col("epochs") * F.col("source_size")).alias("budget"),
        ),
        "mix-plan",
    )


def _taken(placed: DataFrame, most: int) -> DataFrame:
    """Rows of ranges before the budget's end are taken once more, those after it are not; its own range is cut.

    In that range equal keys (of one id, and one size) are summed before they are sorted, so an id
    that holds much of a source is one row there. The rows before the cut are taken, and as many of
    those at it as the budget reaches.
    """
    whole = F.col("earlier") + F.col("range_size") <= F.col("budget")
    none = F.col("earlier") >= F.col("budget")
    sure = placed.where(whole | none).withColumn("extra", F.when(whole, 1).otherwise(0))
    edge = placed.where(~whole & ~none)
    cuts = small(stored(_cuts(edge), "mix-cuts"))
    met = edge.join(cuts, edge[_SOURCE].eqNullSafe(cuts["cut_source"]), "left").drop("cut_source")
    here = F.struct(F.col(_KEY).alias("key"), F.col("id"), F.col(_SIZE).alias("size"))
    cut = F.struct(F.col("cut.key").alias("key"), F.col("cut.id").alias("id"), F.col("cut.size").alias("size"))
    at = F.col("cut").isNotNull() & here.eqNullSafe(cut)
    before = F.col("cut").isNull() | (here < cut)
    decided = met.where(~at).withColumn("extra", F.when(before, 1).otherwise(0))
    tied = _numbered(met.where(at)).withColumn("extra", F.when(F.col("nth") <= F.col("cut.taken"), 1).otherwise(0))
    names = sure.columns
    times = F.least(F.col("epochs") + F.col("extra"), F.lit(most)).cast("long")
    return sure.unionByName(decided.select(names)).unionByName(tied.select(names)).withColumn("times", times)


def _cuts(edge: DataFrame) -> DataFrame:
    """For each source the first key, id and size of which not all rows are taken, and how many are."""
    same = edge.groupBy(_SOURCE, _KEY, "id", _SIZE).agg(
        F.count("*").alias("n"), F.first("earlier").alias("earlier"), F.first("budget").alias("budget")
    )
    upto = Window.partitionBy(_SOURCE).orderBy(_KEY, "id", _SIZE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size, budget = F.col(_SIZE), F.col("budget")
    total = F.col("n") * size
    summed = same.withColumn("start", F.col("earlier") + F.sum(total).over(upto) - total)
    # A document counts when its middle is within the budget, so the sum ends as near as whole texts allow.
    about = F.ceil((budget - F.col("start")) / F.greatest(size, F.lit(1)) + 0.5) - 1
    about = F.greatest(F.least(about, F.col("n")), F.lit(0))
    more = (about < F.col("n")) & (F.col("start") + (about + 0.5) * size < budget)
    less = (about > 0) & ~(F.col("start") + (about - 0.5) * size < budget)
    exact = F.when(more, about + 1).when(less, about - 1).otherwise(about)
    taken = F.when(size > 0, exact).otherwise(F.when(F.col("start") < budget, F.col("n")).otherwise(0))
    short = summed.withColumn("taken", taken.cast("long")).where(F.col("taken") < F.col("n"))
    cut = F.min(F.struct(F.col(_KEY).alias("key"), F.col("id"), F.col(_SIZE).alias("size"), F.col("taken"))).alias("cut")
    return short.groupBy(F.col(_SOURCE).alias("cut_source")).agg(cut)


def _numbered(rows: DataFrame) -> DataFrame:
    """``nth`` of equal rows of a source: within each part of the stored rows, then over the parts."""
    part = F.shiftright(F.col(_ROW), 33)  # the partition that wrote the row
    parted = rows.withColumn("mix__part", part)
    counts = parted.groupBy(F.col(_SOURCE).alias("of"), F.col("mix__part").alias("in")).agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("of").orderBy("in").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("mix__start", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    inner = Window.partitionBy(_SOURCE, "mix__part").orderBy(_ROW)
    joined = parted.withColumn("inner", F.row_number().over(inner)).join(
        F.broadcast(starts), parted[_SOURCE].eqNullSafe(F.col("of")) & (F.col("mix__part") == F.col("in"))
    )  # at most a row for each source and partition of the stored rows
    return joined.withColumn("nth", F.col("inner") + F.col("mix__start"))
