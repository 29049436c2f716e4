"""Mixing sources to target weights by systematic sampling, native.

Sources have weights and share a budget of words.  A source takes at most
``most`` times its own size; what it can't take is shared out again among the
others by weight, until none is above.  That is one common level: a source's
target is the smaller of its cap and ``level * weight``.  Sources in the order
of cap per weight are full up to some place and open from there on, so prefix
sums of caps and weights in that order decide each source on its own and give
the level, without rounds.

Every document of a source is expected as often as any other, ``target /
source size`` times.  Within its source it covers an interval of that length:
the expected copies are summed up before it, one random offset per source is
added, and the document is taken once per integer boundary in its interval.
The rate is rounded to a multiple of 2**-20 and all sums are integers, so
the result does not depend on how the work was dealt out, and a document is
never taken more than ``most`` times.  Documents stand in the order of
their size: the sum of the taken words is then within twice the largest
document of what the rate stands for, as the error of a sorted sequence
telescopes.

Places come from sorted partitions (``ordered``), so a source of any size is
spread over many tasks.

Defined cases: a null text has no words; documents without words are dealt
copies like any other and take no words; a null source is a source of its
own, the last one; rows without ``doc_id`` come first among their size;
repeated rows are documents of their own; an empty table and a table without
words give zeros or no rows; ties in size go by ``doc_id``; columns other
than ``doc_id``, ``source`` and ``text`` are not read by the query.  ``emit``
keeps all columns, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, materialise
from .ordered import lay_out, place, running, starts

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
#: rates and offsets are multiples of 2**-UNIT
UNIT = 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null and sorts by code point, null last."""
    return F.when(source.isNull(), "~").otherwise(F.concat(F.lit("="), source.cast("string")))


def targets(sources: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """(g, source_size, target) of ``sources`` (g, source_size)."""
    order = running(lay_out(sources, [F.col("g").asc()], "mix-sources"), [], "mix-source-places")
    weight = reduce(lambda c, k: F.when(F.col("pos") % len(weights) == k, weights[k]).otherwise(c), range(len(weights)), F.lit(0))
    weighed = order.select("g", "source_size", weight.cast("long").alias("weight"), (F.col("source_size") * most).alias("cap"))
    # order of cap / weight in whole numbers
    unit = reduce(lambda a, b: a * b, sorted(set(weights)), 1)
    laid = lay_out(materialise(weighed.withColumn("ratio", F.expr(f"cap * ({unit} div weight)")), "mix-weights"),
                   [F.col("ratio").asc(), F.col("g").asc()], "mix-ratios")
    summed = running(laid, ["cap", "weight"], "mix-sums")
    whole = laid.agg(F.sum("source_size"), F.sum("weight")).first()
    budget, weight_sum = share * (whole[0] or 0), whole[1] or 0
    level = (F.lit(budget) - F.col("cap_before")) / (F.lit(weight_sum) - F.col("weight_before"))
    judged = materialise(summed.withColumn("full", level * F.col("weight") >= F.col("cap")), "mix-full")
    left = judged.where("full").agg(F.sum("cap"), F.sum("weight")).first()
    still = weight_sum - (left[1] or 0)
    common = (budget - (left[0] or 0)) / still if still else 0.0
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.lit(float(common)) * F.col("weight"))
    return judged.select("g", "source_size", target.alias("target"))


def offset(g: Column, seed: str) -> Column:
    """A random number of ``UNIT`` bits that depends on seed and source only."""
    digits = F.substring(F.sha2(F.concat(F.lit(seed), g).cast("binary"), 256), 1, UNIT // 4)
    return F.conv(digits, 16, 10).cast("long")


def mix(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: int = 2, seed: str = "mix") -> DataFrame:
    """``sizes`` (g, id, size) with ``source_size``, ``target`` and
    ``copies``, how often the mix takes the document."""
    sizes = materialise(sizes.select("g", "id", "size"), "mix-sizes")
    per_source = materialise(sizes.groupBy("g").agg(F.sum("size").alias("source_size")), "mix-totals")
    wanted = materialise(targets(per_source, weights, share, most), "mix-targets")
    laid = lay_out(sizes, [F.col("g").asc(), F.col("size").asc(), F.col("id").asc_nulls_first()], "mix-order")
    begun = starts(laid, "g", "mix-starts").join(broadcast_if_small(wanted, 120), "g")
    unit = 1 << UNIT
    rate = F.when(F.col("source_size") > 0, F.least(F.round(F.col("target") / F.col("source_size") * unit), F.lit(float(most * unit))))
    begun = materialise(begun.withColumn("rate", F.coalesce(rate, F.lit(0)).cast("long")).withColumn("shift", offset(F.col("g"), seed)), "mix-rates")
    placed = place(laid, begun, "g")

    def boundaries(before: Column) -> Column:
        return F.shiftright(before * F.col("rate") + F.col("shift"), UNIT)

    copies = boundaries(F.col("pos") + 1) - boundaries(F.col("pos"))
    return placed.select("g", "id", "size", "source_size", "target", copies.alias("copies"))


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select(source_key(F.col("source")).alias("g"), F.col("doc_id").alias("id"), word_count(F.col("text")).alias("size"))


def mix_documents(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) of every document."""
    return mix(document_sizes(docs), **how).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def emit(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix itself: every document, whole, as often as it was taken.
    ``doc_id`` must name a row here."""
    often = mixed.where("copies > 0").select(F.col("doc_id").alias("__id"), F.col("copies").alias("__copies"))
    found = docs.join(often, F.col("doc_id") == F.col("__id"))
    return found.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), "__copies"))).select(*[F.col(f"`{c}`") for c in docs.columns])
