"""Mixing sources to target weights by Pareto order sampling.

Sources get shares of a word budget by weight, none more than ``cap`` times its
own words; the excess is shared again by weight, which is a water level over the
sources sorted by words per weight. A source that needs r times its words gives
every document floor(r) whole copies for certain. The rest is drawn: a document
with uniform number u (from a hash of its id) and inclusion probability p ranks
by ``(u / (1 - u)) / (p / (1 - p))``, and the lowest ranks are taken while their
words fit. The gap below the first one that no longer fits is then narrowed by
the remaining documents closest to it in size, ``FILLS`` at most. What gap that
leaves, as where a single large document did not fit, goes on in rank order to the
remaining documents that fit, until none does.

No source is ever ordered as a whole. Words are summed in 65,536 slices of u per
source, the slice that holds the cut is found from these sums, and only its
documents are ranked. What a row needs to know is its source's line of the plan.

Defined results: a null text has size 0; a null source is a source of its own and
the last; rows that share source and doc_id are drawn together and each takes its
own words; rows without a doc_id are drawn by their text instead, equal ones
together; a table without words takes none; other
columns pass through :func:`mix`, whatever their names. Equal input gives equal
output, however it is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .words import packed

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SLICES = 65536
FILLS = 3
OVER = 0.01
SEED = "mix-1"


def size(text: Column) -> Column:
    """Number of words."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def unit(doc_id: Column, text: Column) -> Column:
    """What is drawn as one: a document by its id, without one by its text."""
    digest = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    return F.struct(doc_id.alias("doc_id"), F.when(doc_id.isNull(), digest).alias("text"))


def uniform(unit: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) from 52 bits of a hash of the id, or of the text's digest."""
    named = F.coalesce(unit.getField("doc_id").cast("string"), unit.getField("text"))
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), named).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(2**52))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per source: words, target, whole copies, and the words and probability left to draw.

    The two windows run over one row per source.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weighted = sources.select(
        "*", F.get(F.array(*[F.lit(w) for w in weights]), place % len(weights)).cast("bigint").alias("weight"))
    limit = (F.col("source_size") * F.lit(cap)).alias("limit")
    by_level = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (
        F.sum("weight").over(after))
    filled = weighted.select("*", limit).select("*", level.alias("level")).select(
        "*", F.max("level").over(everything).alias("water"))
    target = F.least(F.col("limit").cast("double"), F.col("weight") * F.col("water"))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("copies") * F.col("source_size")
    return (
        filled.select("source", "source_size", target.alias("target"))
        .select("*", copies.cast("int").alias("copies"))
        .select("*", rest.alias("rest"))
        .select("*", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")).otherwise(0.0).alias("p"))
    )


def rank(u: Column, p: Column) -> Column:
    """Random odds over inclusion odds; null where nothing is drawn."""
    return F.when((p > 0) & (p < 1), (u / (1 - u)) / (p / (1 - p)))


def slice_of(u: Column) -> Column:
    return F.floor(u * SLICES).cast("int")


def with_source(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows beside their source's line, as columns ``s``; null is a source too."""
    lines = plan.select(F.struct("*").alias("s"))
    return rows.join(lines, rows["source"].eqNullSafe(F.col("s.source")))


def under(row_rank: Column, unit: Column, bar: Column, closed: Column) -> Column:
    """Whether a unit comes before the bar, or is the bar where that is taken too."""
    own = F.struct(row_rank.alias("rank"), unit.alias("unit"))
    return (own < bar) | (closed & (own <= bar))


def drawn(row_rank: Column, unit: Column) -> Column:
    """Whether a row beside its source's line is below the bar or a fill."""
    below = under(row_rank, unit, F.col("s.bar"), F.col("s.closed"))
    filled = F.exists("s.fills", lambda f: f.eqNullSafe(unit))
    return row_rank.isNotNull() & (F.coalesce(below, F.lit(False)) | filled)


def cuts(ranked: DataFrame) -> DataFrame:
    """Per source with more words than ``rest``: the last unit in rank order that fits, and the words up to it.

    ``ranked`` has (source, unit, size, rest, slice, rank).
    """
    running = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranked.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("rest").alias("rest")).select(
        "*", F.coalesce(F.sum("words").over(running), F.lit(0)).alias("before"))
    cut = sums.where("before <= rest and rest < before + words").select(
        F.col("source").alias("cut_source"), F.col("slice").alias("cut_slice"), "before")
    inside = ranked.join(cut, ranked["source"].eqNullSafe(F.col("cut_source")) & (F.col("slice") == F.col("cut_slice")))
    upto = Window.partitionBy("source").orderBy("rank", "unit").rowsBetween(Window.unboundedPreceding, 0)
    fits = inside.select("*", (F.col("before") + F.sum("size").over(upto)).alias("taken")).groupBy("source").agg(
        F.max(F.when(F.col("taken") <= F.col("rest"), F.struct("rank", "unit"))).alias("bar"),
        F.greatest(F.first("before"), F.coalesce(F.max(F.when(F.col("taken") <= F.col("rest"), F.col("taken"))), F.lit(0)))
        .alias("taken"),
        F.min(F.struct("rank", "unit")).alias("first"),
    )
    # With nothing of the cut slice taken, everything before its first rank is.
    return fits.select(
        F.col("source").alias("cut_source"), F.coalesce("bar", "first").alias("bar"),
        F.col("bar").isNotNull().alias("closed"), "taken")


def plan_mix(
    sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP, seed: str = SEED
) -> tuple[DataFrame, DataFrame | None]:
    """One line per source (its target, whole copies, the last rank drawn, the units that fill the gap), and :func:`further`.

    ``sized`` has (unit, source, size) and is read several times.
    """
    plan = stored(targets(sized, weights, share, cap), "mix-targets")
    units = sized.groupBy("source", "unit").agg(F.sum("size").alias("size")).select(
        "*", uniform(F.col("unit"), seed).alias("u"))
    ranked = with_source(units, plan.where("p > 0")).select(
        "s.source", "unit", "size", "s.rest", slice_of(F.col("u")).alias("slice"),
        rank(F.col("u"), F.col("s.p")).alias("rank"))
    ranked = stored(ranked, "mix-ranks")
    cut = cuts(ranked)
    none = F.array().cast(f"array<{sized.schema['unit'].dataType.simpleString()}>")
    state = plan.join(cut, plan["source"].eqNullSafe(F.col("cut_source")), "left").select(
        *plan.columns, "bar", "closed", (F.col("rest") - F.coalesce("taken", "rest")).alias("gap"), none.alias("fills"))
    state = stored(state, "mix-plan")
    for _ in range(FILLS):
        state = stored(fill(state, ranked), "mix-plan")
    return state, further(state, ranked)


def further(state: DataFrame, ranked: DataFrame) -> DataFrame | None:
    """(source, unit) of the undrawn units that in rank order still fit the gap; None if there is none.

    Each round takes the units that fit up to the first that does not; those too large for
    what is then left go, and the others have the next round.
    """
    left = with_source(ranked, state.where("gap > 0")).where(
        ~drawn(F.col("rank"), F.col("unit")) & F.col("size").between(F.lit(1), F.col("s.gap"))
    ).select("s.source", "unit", "size", F.col("s.gap").alias("rest"), "slice", "rank")
    left, out = stored(left, "mix-left"), None
    while not left.isEmpty():
        cut = cuts(left)
        judged = stored(left.join(cut, left["source"].eqNullSafe(F.col("cut_source")), "left").select(
            *left.columns, "taken", F.coalesce(under(F.col("rank"), F.col("unit"), F.col("bar"), F.col("closed")), F.lit(True)).alias("fits")),
            "mix-round")
        now = judged.where("fits").select("source", "unit")
        out = now if out is None else out.unionByName(now)
        rest = F.col("rest") - F.col("taken")
        left = stored(judged.where(~F.col("fits") & (F.col("size") <= rest)).select(
            "source", "unit", "size", rest.alias("rest"), "slice", "rank"), "mix-left")
    return out


def fill(state: DataFrame, ranked: DataFrame) -> DataFrame:
    """Per source, add the undrawn document whose size comes closest to the gap, if it narrows it.

    One that exceeds the gap by more than ``OVER`` of the target is left out where smaller ones come as close.
    """
    gap, size = F.col("s.gap"), F.col("size")
    off = F.abs(size - gap)
    one = F.struct(off.alias("off"), "rank", "unit", "size")
    small = (size <= gap) | (off <= F.col("s.target") * OVER)
    best = with_source(ranked, state.where("gap > 0")).where(
        ~drawn(F.col("rank"), F.col("unit")) & (off < gap)
    ).groupBy("s.source").agg(
        F.min(one).alias("best"), F.min(F.when(small, one)).alias("small"), F.first("s.gap").alias("gap"),
        F.coalesce(F.sum(F.when(size <= gap, size)), F.lit(0)).alias("fitting"))
    best = best.select("source", F.when(F.col("fitting") >= F.col("gap") - F.col("best.off"), F.col("small"))
                       .otherwise(F.col("best")).alias("best")).where("best is not null")
    best = best.select(F.col("source").alias("fill_source"), "best")
    found = F.col("best").isNotNull()
    return state.join(best, state["source"].eqNullSafe(F.col("fill_source")), "left").select(
        *[c for c in state.columns if c not in ("gap", "fills")],
        F.when(found, F.col("gap") - F.col("best.size")).otherwise(F.col("gap")).alias("gap"),
        F.when(found, F.concat("fills", F.array("best.unit"))).otherwise(F.col("fills")).alias("fills"),
    )


def beside(rows: DataFrame, plan: DataFrame, more: DataFrame | None, seed: str) -> DataFrame:
    """Rows with ``unit`` beside their source's line, and how often the mix takes them, as column ``times``."""
    lines = with_source(rows, plan)
    also = F.lit(False)
    if more is not None:
        found = more.select(F.col("source").alias("more_source"), F.col("unit").alias("more_unit"), F.lit(True).alias("also"))
        lines = lines.join(found, lines["source"].eqNullSafe(F.col("more_source")) & (F.col("unit") == F.col("more_unit")), "left")
        also = F.coalesce("also", F.lit(False))
    return lines.select("*", copies(F.col("unit"), seed, also).alias("times"))


def copies(unit: Column, seed: str, also: Column) -> Column:
    """How often the mix takes a row that stands beside its source's line."""
    return F.col("s.copies") + (drawn(rank(uniform(unit, seed), F.col("s.p")), unit) | also).cast("int")


def sizes(docs: DataFrame) -> DataFrame:
    return stored(docs.select(
        "doc_id", "source", size(F.col("text")).alias("size"), unit(F.col("doc_id"), F.col("text")).alias("unit")), "mix-sizes")


def report(docs: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes of it."""
    sized = sizes(docs)
    plan, more = plan_mix(sized, seed=seed, **settings)
    return beside(sized, plan, more, seed).select(
        "doc_id", "size", "s.source_size", "s.target", (F.col("size") * F.col("times")).alias("taken"))


def mix(docs: DataFrame, seed: str = SEED, **settings) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with their own columns."""
    plan, more = plan_mix(sizes(docs), seed=seed, **settings)
    rows = packed(docs).select(
        "row", F.col("row.source").alias("source"), unit(F.col("row.doc_id"), F.col("row.text")).alias("unit"))
    return (
        beside(rows, plan, more, seed)
        .select("row", F.explode(F.array_repeat(F.lit(1), F.col("times"))).alias("copy"))
        .select("row.*")
    )
