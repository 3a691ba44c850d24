"""Mixing sources to target weights by entropy balancing.

Of all document rates between 0 and ``cap`` that give every source its target
of words, those closest to one copy each (in relative entropy) are exponential
tilts: ``rate = min(cap, exp(lambda_s * size / mean size))`` with one multiplier
per source. Newton steps, kept inside a bracket, solve the convex dual over the
counts of each (source, size), all sources at once. Rates are then rounded into
copies: a document's fraction is held against a number drawn from its own
fields, shifted by a source's offset that makes the taken words meet the target.

Sources are never gathered: documents are pre-aggregated to (source, size) and
to histogram bins. Only the table with a row per source is ordered as a whole.
Defined results: null, empty or blank text has size 0 and takes nothing; null is
a source of its own, last; a source of size 0 has target 0; equal rows get equal
copies; input columns named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from martlet.llm.registry import SPACE, read_table, register
from martlet.session import cut_lineage

WEIGHTS, SHARE, CAP = (3, 1, 2), 1.5, 2.0
#: Newton steps at most (bisection alone would reach the tolerance by then).
STEPS, TOLERANCE = 80, 1e-9
#: Bits of the rounding offset, settled in two halves.
HALF = 10
#: Bytes of source rows that may be broadcast; a larger table is joined by shuffle.
BROADCAST = 8 << 20

RESULT = ["size", "source_size", "target", "rate", "copies", "taken"]


def word_count(text: Column) -> Column:
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")
    return F.size(words).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(_src, source_size, n, target): sources by code point, null last, take
    ``weights`` in turn and split ``share`` of all words. A target stops at
    ``cap`` times its source; the excess is shared again among the others."""
    by_source = sizes.groupBy("_src").agg(F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n"))
    order = Window.orderBy(F.col("_src").asc_nulls_last())
    each = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    df = by_source.withColumn("_w", each).withColumn("_cap", cap * F.col("source_size"))
    # Filled in the order of cap per weight: a source is full if the level that
    # those from it on would share reaches its cap.
    fill = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("_src").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("_w").over(after)
    df = df.withColumn("_level", level)
    open_level = F.max(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.col("_level"))).over(everything)
    df = df.withColumn("_open", open_level)
    target = F.least("_cap", F.coalesce(F.col("_open") * F.col("_w"), F.col("_cap")))
    return df.select("_src", "source_size", "n", target.alias("target"))


def _rate(size: Column, lam: Column, mean: Column, cap: float) -> Column:
    return F.least(F.lit(cap), F.exp(lam * size / mean))


def tilts(sizes: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """``targets`` with ``lam``, the dual solution of each source (null where
    the target takes every document ``cap`` times, or the source is empty)."""
    counts = cut_lineage(sizes.filter("size > 0").groupBy("_src", "size").agg(F.count("*").alias("c")), "sizes")
    state = (targets.withColumn("mean", F.col("source_size") / F.col("n"))
             .withColumn("lam", F.when((F.col("n") > 0) & (F.col("target") < cap * F.col("source_size")), F.lit(0.0)))
             .withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double"), "off": F.lit(None).cast("double")}))
    state = cut_lineage(state, "tilts")
    for _ in range(STEPS):
        at = state.filter("lam is not null").select(F.col("_src").alias("_s"), "lam", "mean")
        rate = _rate(F.col("size"), F.col("lam"), F.col("mean"), cap)
        words = F.col("c") * F.col("size")
        met = (counts.join(at, F.col("_src").eqNullSafe(F.col("_s"))).groupBy("_s")
               .agg(F.sum(words * rate).alias("g"), F.sum(F.when(rate < cap, words * rate * F.col("size") / F.col("mean"))).alias("slope")))
        new = state.join(met, F.col("_src").eqNullSafe(F.col("_s")), "left").drop("_s")
        low = F.col("g") < F.col("target")
        new = new.withColumns({"lo": F.when(low, F.col("lam")).otherwise(F.col("lo")), "hi": F.when(low, F.col("hi")).otherwise(F.col("lam"))})
        off = F.abs(F.col("g") - F.col("target")) / F.greatest("target", F.lit(1.0))
        step = F.col("lam") + (F.col("target") - F.col("g")) / F.col("slope")
        inside = ((F.col("slope") > 0) & F.coalesce(step > F.col("lo"), F.lit(True)) & F.coalesce(step < F.col("hi"), F.lit(True))
                  & (F.abs(step - F.col("lam")) <= 4 * (1 + F.abs("lam"))))
        half = (F.when(F.col("hi").isNull(), 2 * F.abs("lo") + 1).when(F.col("lo").isNull(), -2 * F.abs("hi") - 1)
                .otherwise((F.col("lo") + F.col("hi")) / 2))
        moved = F.when(off <= TOLERANCE, F.col("lam")).when(inside, step).otherwise(half)
        new = new.withColumns({"off": off, "lam": F.when(F.col("lam").isNotNull(), moved)}).drop("g", "slope")
        state = cut_lineage(new, "tilts")
        if not state.filter(F.col("off") > TOLERANCE).limit(1).count():
            break
    return state.drop("lo", "hi", "off")


def _rounded(df: DataFrame, cap: float) -> DataFrame:
    """Adds rate, _base (whole copies) and _key, the offset from which on the
    document gets one copy more (null where it can't)."""
    size, lam = F.col("size"), F.col("lam")
    rate = F.when(size == 0, 0.0).when(F.col("target") <= 0, 0.0).when(lam.isNull(), cap).otherwise(_rate(size, lam, F.col("mean"), cap))
    draw = F.col("_draw").bitwiseAND((1 << 40) - 1) / float(1 << 40)
    key = F.floor((draw - (F.col("rate") - F.col("_base")) + 1) * float(1 << 2 * HALF))
    return (df.withColumn("rate", rate).withColumn("_base", F.floor("rate"))
            .withColumn("_key", F.when((F.col("rate") < cap) & (size > 0), key)))


def _crossing(bins: DataFrame, need: str) -> DataFrame:
    """Of each source's bins (_src, bin, words) the first whose running sum
    reaches ``need``: (_s, bin, words, left), left being what it has to give."""
    run = Window.partitionBy("_src").orderBy("bin")
    df = bins.withColumn("_sum", F.sum("words").over(run)).filter(F.col("_sum") >= F.col(need))
    first = F.min_by(F.struct("bin", "words", (F.col(need) - F.col("_sum") + F.col("words")).alias("left")), "bin")
    return df.groupBy("_src").agg(first.alias("x")).select(F.col("_src").alias("_s"), "x.*")


def _with_flips(rounded: DataFrame, table: DataFrame) -> DataFrame:
    """``table`` with ``_flip``: of each source the document (by draw and size)
    whose other rounding brings the taken words nearest to the target, if any."""
    more = F.col("_key").isNotNull() & (F.col("_key") < F.col("_offset"))
    taken = (F.col("_base") + more.cast("long")) * F.col("size")
    gaps = rounded.groupBy("_src").agg((F.first("target") - F.sum(taken)).alias("gap")).withColumnRenamed("_src", "_s")
    each = (rounded.filter("_key is not null").groupBy("_src", "_draw", "size", more.alias("more"))
            .agg((F.count("*") * F.col("size") * F.when(more, -1).otherwise(1)).alias("change")))
    after = F.abs(F.col("gap") - F.col("change"))
    best = (each.join(gaps, F.col("_src").eqNullSafe(F.col("_s"))).filter(after < F.abs("gap")).groupBy("_s")
            .agg(F.min_by(F.struct("_draw", "size"), F.struct(after, "_draw", "size")).alias("_flip")))
    best = best.withColumnRenamed("_s", "_t")
    return table.join(best, F.col("_s").eqNullSafe(F.col("_t")), "left").drop("_t")


def mix_sources(documents: DataFrame, text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS,
                share: float = SHARE, cap: float = CAP, fields: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``documents`` with size, source_size, target, rate, copies and taken.
    ``fields`` are what a document's draw is made from, beside its size."""
    docs = documents.drop(*RESULT).withColumns({
        "size": word_count(F.col(text)) if text else F.col("size"), "_src": F.col(source),
        "_draw": F.xxhash64(*fields, F.lit("mix"))})
    sizes = cut_lineage(docs.select("_src", "size", "_draw"), "document-sizes")
    targets = tilts(sizes, cut_lineage(source_targets(sizes, weights, share, cap), "targets"), cap)

    def with_source(df: DataFrame, table: DataFrame, kind: str = "inner") -> DataFrame:
        return df.join(table, F.col("_src").eqNullSafe(F.col("_s")), kind).drop("_s")

    table = targets.withColumnRenamed("_src", "_s")
    rounded = _rounded(with_source(sizes, table), cap)
    base = rounded.groupBy("_src").agg(F.sum(F.col("_base") * F.col("size")).alias("words")).withColumnRenamed("_src", "_s")
    need = with_source(targets, base).select(F.col("_src").alias("_s"), (F.col("target") - F.col("words")).alias("need"))
    open_keys = rounded.filter("_key is not null")
    coarse = with_source(open_keys.groupBy("_src", F.shiftright("_key", HALF).alias("bin")).agg(F.sum("size").alias("words")), need)
    at = cut_lineage(_crossing(coarse, "need").select("_s", F.col("bin").alias("top"), "left"), "offsets")
    fine = (with_source(open_keys, at).filter(F.shiftright("_key", HALF) == F.col("top"))
            .groupBy("_src", "left", F.col("_key").alias("bin")).agg(F.sum("size").alias("words")))
    # The last bin is taken whole or not at all, whichever is nearer.
    last = _crossing(fine, "left").select("_s", (F.col("bin") + F.when(F.col("left") * 2 >= F.col("words"), 1).otherwise(0)).alias("_offset"))
    table = cut_lineage(with_source(targets, last, "left").select(F.col("_src").alias("_s"), "source_size", "target", "mean", "lam",
                                                                F.coalesce("_offset", F.lit(0)).alias("_offset")), "mix-sources")
    table = cut_lineage(_with_flips(_rounded(with_source(sizes, table), cap), table), "mix-flips")
    width = table.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("_s"), F.lit(0)) + 64), F.lit(0))).first()[0]
    out = _rounded(with_source(docs, F.broadcast(table) if width <= BROADCAST else table), cap)
    flipped = F.struct("_draw", "size").eqNullSafe(F.col("_flip"))
    more = F.when(F.col("_key").isNull(), 0).when((F.col("_key") < F.col("_offset")) != flipped, 1).otherwise(0)
    out = out.withColumn("copies", (F.col("_base") + more).cast("long")).withColumn("taken", F.col("copies") * F.col("size"))
    return out.select(*[c for c in documents.columns if c not in RESULT], *RESULT)


@register("op2_source_mixing")
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes from every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
