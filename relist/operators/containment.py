"""Which texts contain which patterns: Aho-Corasick over shards of patterns.

Distinct patterns are dealt by hash to shards of some ``SHARD_CHARS``
characters; texts travel in packs of some ``PACK_BYTES`` bytes that are made
batch by batch, without a shuffle.  Every pack meets every shard in an
equi-join on the shard number, and a task streams the texts of a pack past
the shard's automaton, which it builds once and keeps for the packs that
follow.  Spark's own size check decides whether the shards are broadcast or
both sides move; the automaton is the same, for one pattern or millions, of
one character or thousands, and neither side passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

SHARD_CHARS = 2_000_000
PACK_BYTES = 8 << 20


def _packs(rows: DataFrame, text: str, pack_bytes: int) -> DataFrame:
    """Rows in packs, one row a pack, as an array of structs."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            sizes = batch.column(text).cast(pa.large_binary())
            start = taken = 0
            cuts = [0]
            for i, n in enumerate(_lengths(sizes)):
                if i > start and taken + n > pack_bytes:
                    cuts.append(i)
                    start, taken = i, 0
                taken += n
            cuts.append(batch.num_rows)
            for a, b in zip(cuts, cuts[1:]):
                part = pa.StructArray.from_arrays(batch.slice(a, b - a).columns, names=batch.schema.names)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), part)], names=["rows"])

    return rows.mapInArrow(run, StructType([StructField("rows", ArrayType(rows.schema))]))


def _lengths(column) -> list[int]:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(column), 0).to_pylist()


def automaton(patterns: list[str]):
    import ahocorasick
    machine = ahocorasick.Automaton()
    for i, p in enumerate(patterns):
        machine.add_word(p, i)
    machine.make_automaton()
    return machine


def occurring(machine, text: str) -> set[int]:
    """The numbers of the patterns that the text contains."""
    return {i for _, i in machine.iter(text)}


def _scan(packs: DataFrame, rows: StructType, text: str, pattern: str) -> DataFrame:
    """(row of the pack, pattern) for every pattern that a text contains."""
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        built, machine = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                part, patterns = batch.column("rows")[i].values, batch.column("patterns")[i].values
                if built is None or not built.equals(patterns):
                    built, machine = patterns, automaton(patterns.to_pylist())
                at, found = [], []
                for k, t in enumerate(part.field(text).to_pylist()):
                    if t:
                        hits = occurring(machine, t)
                        at += [k] * len(hits)
                        found += hits
                left = part.take(pa.array(at, pa.int64()))
                yield pa.RecordBatch.from_arrays([*left.flatten(), patterns.take(pa.array(found, pa.int64()))], names=[*rows.names, pattern])

    return packs.mapInArrow(run, StructType([*rows.fields, StructField(pattern, StringType())]))


def contains_join(left: DataFrame, left_text: str, right: DataFrame, right_pattern: str, shard_chars: int = SHARD_CHARS,
                  pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Inner join of every left row whose ``left_text`` contains the right
    row's ``right_pattern`` (case-sensitive substring), as
    ``left.join(right, contains(left_text, right_pattern))`` would give it.

    Null and empty patterns match nothing, null texts contain nothing.  All
    columns of both sides are returned (their names must differ); rows that
    share a pattern each get its matches."""
    some = right.where(F.col(right_pattern).isNotNull() & (F.col(right_pattern) != ""))
    patterns = some.select(F.col(right_pattern).alias("_p")).distinct()
    shards = patterns.agg(F.coalesce(F.expr(f"cast(sum(length(_p)) div {shard_chars} + 1 as int)"), F.lit(1))).scalar()
    sharded = (patterns.withColumn("_shard", F.pmod(F.xxhash64("_p"), shards).cast("int"))
               .groupBy("_shard").agg(F.array_sort(F.collect_list("_p")).alias("patterns")))
    packs = _packs(left, left_text, pack_bytes).select("rows", F.explode(F.sequence(F.lit(0), shards - 1)).alias("_shard"))
    met = packs.join(sharded, "_shard").select("rows", "patterns")
    found = _scan(met, left.schema, left_text, "_found")
    if right.columns == [right_pattern]:
        # one column: the pattern is the whole row (repeated rows repeat it)
        often = some.groupBy(right_pattern).agg(F.count("*").alias("_n"))
        return (found.join(often, F.col("_found") == F.col(right_pattern))
                .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("long"), "_n"))).drop("_found", "_n"))
    return found.join(some, F.col("_found") == F.col(right_pattern)).drop("_found")
