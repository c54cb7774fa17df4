"""Mixing sources to target weights by Pfair scheduling.

A source with weight w owns block k (from 0) of its text for the slots from floor(k / w), its release, to ceil((k + 1) / w), its
deadline. Slots go to the released block with the earliest deadline; on one resource this is optimal, and each source stays within
one block of its share at every slot. Weights are exact fractions, and every block of the corpus has a slot of its own in the schedule,
so the deviation stays below one block at any size until a source runs out (in_mix). From then on the sources that are left go
on among themselves in the same way. The schedule is worked out on the driver; a corpus of more than MAX_BLOCKS blocks gets larger
blocks, so its size is bounded, and Spark places the documents in blocks.

Of more than MAX_SOURCES sources the largest stand in that schedule by themselves and the others in groups of about GROUP_SOURCES, with
the sums of their weights and blocks. The slots of a group are dealt to its sources by a schedule of their own, in a task, so every
source keeps its own weight and its own blocks, and the deviation of one in a group stays below two blocks. The driver holds no more
than the groups, however many sources there are.
"""

import heapq
import math
from fractions import Fraction

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import small_side, stored
from .common import table

BLOCK_CHARS, MAX_BLOCKS = 100_000, 500_000
#: Documents for each part that ranks its documents in one task; sources and groups of sources that the driver schedules; sources of a
#: group (more of them beyond MAX_SOURCES * GROUP_SOURCES / 2 sources).
PART_ROWS, MAX_SOURCES, GROUP_SOURCES = 4_000, 5_000, 1_000
#: Rows of a table by source or block that is broadcast.
SMALL = 500_000


def pfair_schedule(weights: dict[str, Fraction], blocks: dict[str, int]) -> tuple[list[tuple[str, int]], int]:
    """((source, block) of each slot, slots before the first source runs out). Every block has one slot. weights are positive; ties of
    deadlines go to the smaller name."""
    done = {s: 0 for s in blocks}
    left = {s for s, n in blocks.items() if n > 0}
    common = math.lcm(1, *(weights[s].denominator for s in left))
    whole = {s: int(weights[s] * common) for s in left}
    total = sum(whole.values())
    out: list[tuple[str, int]] = []
    end = None
    while left:  # a slot of every source that is left for each total / whole[s] slots
        first, base = {s: done[s] for s in left}, len(out)
        ready = [(-(-total // whole[s]), s) for s in left]
        heapq.heapify(ready)
        waiting: list[tuple[int, int, str]] = []
        over = None
        while over is None:
            slot = len(out) - base
            while waiting and waiting[0][0] <= slot:
                heapq.heappush(ready, heapq.heappop(waiting)[1:])
            _, s = heapq.heappop(ready)
            out.append((s, done[s]))
            done[s] += 1
            if done[s] == blocks[s]:
                over = s
            k = done[s] - first[s]
            heapq.heappush(waiting, (k * total // whole[s], -(-(k + 1) * total // whole[s]), s))
        left.remove(over)
        total -= whole[over]
        end = len(out) if end is None else end
    return out, end or 0


def _fractions(targets: dict[str, float]) -> dict[str, Fraction]:
    """Weights as fractions: short ones (0.1 as 1/10), unless their common denominator is long, which it soon is for many; then as the
    floats are."""
    short, common = {s: Fraction(w).limit_denominator(10**9) or Fraction(1, 10**9) for s, w in targets.items()}, 1
    for w in short.values():
        common = math.lcm(common, w.denominator)
        if common > 2**64:
            return {s: Fraction(w) for s, w in targets.items()}
    return short


def _deal(members: pd.DataFrame) -> pd.DataFrame:
    """The order of the blocks of one group: _at is the place among the group's blocks; _ran_out is true for the block that is the first
    to be a source's last."""
    members = members.sort_values("_source")
    order, end = pfair_schedule(_fractions(dict(zip(members._source, members._weight.tolist(), strict=True))), dict(zip(members._source, members._blocks.tolist(), strict=True)))
    names, ks = zip(*order, strict=True)
    at = range(len(order))
    return pd.DataFrame({"_unit": names, "block": ks, "_group": members._group.iloc[0], "_at": at, "_ran_out": [i == end - 1 for i in at]})


def _grouped(sizes: DataFrame, n: int, given: dict[str, float] | None, least: float, block_chars: int, exponent: float) -> tuple[DataFrame, DataFrame, int, int]:
    """For more sources than MAX_SOURCES: (_unit, _parts, _last), (_unit, block, slot), the slots before the first source runs out, and
    the characters of a block."""
    spark = sizes.sparkSession
    groups = max(1, min(-(-n // GROUP_SOURCES), MAX_SOURCES // 2))
    block_chars = max(block_chars, -(-sizes.agg(F.sum("_chars")).first()[0] // MAX_BLOCKS))
    weight = F.pow(F.greatest("_chars", F.lit(1)).cast("double"), F.lit(exponent))
    if given:
        sizes = sizes.join(spark.createDataFrame(list(given.items()), "_source string, _weight double"), "_source", "left")
        weight = F.coalesce("_weight", F.lit(least))
    sizes = stored(sizes.withColumn("_weight", weight).withColumn("_blocks", F.ceil(F.greatest("_chars", F.lit(1)) / block_chars).cast("long")))
    large = sizes.orderBy(F.desc("_chars"), "_source").limit(max(1, MAX_SOURCES - groups)).collect()
    alone = spark.createDataFrame([(r["_source"],) for r in large], "_source string")
    rest = sizes.join(F.broadcast(alone), "_source", "left_anti").withColumn("_group", F.pmod(F.xxhash64("_source"), F.lit(groups)).cast("long"))
    # Sorted, so that the sum of floats does not depend on the order in which rows come.
    total = F.aggregate(F.sort_array(F.collect_list("_weight")), F.lit(0.0), lambda a, x: a + x)
    sums = rest.groupBy("_group").agg(F.sum("_blocks").alias("_blocks"), total.alias("_weight")).collect()
    units = {(0, r["_source"]): r for r in large} | {(1, r["_group"]): r for r in sums}
    # The driver deals turns of some slots; of one, unless there are far more sources than blocks of the usual size.
    turn = -(-sum(r["_blocks"] for r in units.values()) // (2 * MAX_BLOCKS))
    turns, end = pfair_schedule(_fractions({u: r["_weight"] for u, r in units.items()}), {u: -(-r["_blocks"] // turn) for u, r in units.items()})
    own = [(u, k * turn + i, slot * turn + i) for slot, ((kind, u), k) in enumerate(turns) if not kind for i in range(turn)]
    own = spark.createDataFrame(pa.table({c: pa.array(x, t) for c, x, t in zip(("_unit", "block", "slot"), zip(*own), (pa.string(), pa.int64(), pa.int64()))}))
    dealt = [(u, k, slot) for slot, ((kind, u), k) in enumerate(turns) if kind]
    dealt = spark.createDataFrame(pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("_group", "_turn", "_slot"), zip(*dealt))}))
    # A number of partitions, as a group costs time and few bytes: Spark would put many into one task.
    order = rest.repartition(groups, "_group").groupBy("_group").applyInPandas(_deal, "_unit string, block long, _group long, _at long, _ran_out boolean")
    order = order.withColumn("_turn", F.floor(F.col("_at") / turn).cast("long")).join(F.broadcast(dealt), ["_group", "_turn"])
    order = stored(order.select("_unit", "block", (F.col("_slot") * turn + F.col("_at") % turn).alias("slot"), "_ran_out"))
    end = min(end * turn, order.where("_ran_out").agg(F.min("slot")).first()[0] + 1)
    dimension = sizes.select(F.col("_source").alias("_unit"), F.ceil(F.col("_rows") / PART_ROWS).cast("int").alias("_parts"), F.col("_blocks").alias("_last"))
    return small_side(dimension, SMALL), small_side(own.unionByName(order.drop("_ran_out")), SMALL), end, block_chars


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_chars: int = BLOCK_CHARS, exponent: float = 0.5, max_sources: int | None = None, keep: list[str] = ("doc_id", "source")) -> DataFrame:
    """Every row with its place in the interleaved order: the keep columns, block (of its source, from 0), slot (of its block), place
    (rank within the block) and in_mix (the slot lies before the first source has run out, so that targets hold).

    weights: target by source; by default characters of the source to the power of exponent. A source without a positive weight gets the
    smallest one given, so that no row is lost. Null sources count as the source ''. A block has block_chars characters (more, where the
    corpus has over MAX_BLOCKS of them), counted where a document starts; a longer document stands in the block where it starts, and the
    blocks after it that it also fills stay empty. Order within a source is by a hash of doc_id and text, then doc_id; repeated rows stand
    side by side. Ids and texts may be null. One row per input row; an empty table gives none.

    Every source has blocks of its own, however many there are. max_sources, if given: the smallest sources beyond so many share the
    blocks of one pool instead, whose weight is the sum of theirs."""
    spark = docs.sparkSession
    chars = F.coalesce(F.char_length("text"), F.lit(0)).cast("long")
    columns = [c for c in keep if not c.startswith("_")]
    named = F.coalesce("source", F.lit(""))
    sizes = stored(docs.select(named.alias("_source"), chars.alias("_chars")).groupBy("_source").agg(F.sum("_chars").alias("_chars"), F.count("*").alias("_rows")))
    given = {s: float(w) for s, w in (weights or {}).items() if w > 0}
    least = min(given.values(), default=1.0)
    most = max_sources or MAX_SOURCES
    large = sizes.orderBy(F.desc("_chars"), "_source").limit(most + 1).collect()
    unit = F.col("_source")
    if len(large) > most and max_sources is None:
        dimension, slots, end, block_chars = _grouped(sizes, sizes.count(), given if weights else None, least, block_chars, exponent)
    else:
        pooled = len(large) > most
        alone = {r["_source"]: r["_chars"] for r in large[: most - 1 if pooled else most]}
        rows = {r["_source"]: r["_rows"] for r in large if r["_source"] in alone}
        targets = {s: given.get(s, least) if weights else float(max(n, 1)) ** exponent for s, n in alone.items()}
        if pooled:  # the name of the pool is none of a source
            pool, own = "\x00pool", F.col("_source").isin(list(alone))
            rest = sizes.where(~own)
            if weights:
                extra = spark.createDataFrame(list(given.items()), "_source string, _weight double")
                rest = rest.join(extra, "_source", "left").withColumn("_weight", F.coalesce("_weight", F.lit(least)))
            else:
                rest = rest.withColumn("_weight", F.pow(F.greatest("_chars", F.lit(1)).cast("double"), F.lit(exponent)))
            alone[pool], rows[pool], targets[pool] = rest.agg(F.sum("_chars"), F.sum("_rows"), F.sum("_weight")).first()
            unit = F.when(own, F.col("_source")).otherwise(F.lit(pool))
        block_chars = max(block_chars, -(-sum(alone.values()) // MAX_BLOCKS))
        blocks = {s: -(-max(n, 1) // block_chars) for s, n in alone.items()}
        schedule, end = pfair_schedule(_fractions(targets), blocks)
        dimension = F.broadcast(spark.createDataFrame([(s, max(1, -(-n // PART_ROWS)), blocks[s]) for s, n in rows.items()], "_unit string, _parts int, _last long"))
        names, ks = zip(*schedule, strict=True) if schedule else ((), ())
        slots = F.broadcast(spark.createDataFrame(pa.table({"_unit": pa.array(names, pa.string()), "block": pa.array(ks, pa.int64()), "slot": pa.array(range(len(ks)), pa.int64())})))  # MAX_BLOCKS and a source each at most
    # A source is dealt to parts by the order hash; parts are ranges of it, so the order in the source is part by part.
    spread = F.pmod(F.shiftrightunsigned("_order", 33), F.lit(2**31)).cast("long")
    out = docs.select(*columns, named.alias("_source"), chars.alias("_chars"), F.xxhash64("doc_id", "text").alias("_order"), F.col("doc_id").alias("_id")).withColumn("_unit", unit)
    out = out.join(dimension, "_unit").withColumn("_part", F.floor(spread * F.col("_parts") / F.lit(2**31)).cast("int"))
    before = out.groupBy("_unit", "_part").agg(F.sum("_chars").alias("_sum"))
    ahead = Window.partitionBy("_unit").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = stored(before.withColumn("_before", F.coalesce(F.sum("_sum").over(ahead), F.lit(0))).drop("_sum"))
    inside = Window.partitionBy("_unit", "_part").orderBy(spread, "_order", "_id").rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("_inside", F.coalesce(F.sum("_chars").over(inside), F.lit(0))).join(before, ["_unit", "_part"])
    start = F.col("_before") + F.col("_inside")
    # A last document without characters would start the block after the source's last one.
    out = out.withColumn("_start", start).withColumn("block", F.least(F.floor(F.col("_start") / block_chars).cast("long"), F.col("_last") - 1))
    out = out.join(slots, ["_unit", "block"])
    place = (F.col("_start") - F.col("block") * block_chars).cast("long")
    return out.select(*columns, "block", "slot", place.alias("place"), (F.col("slot") < F.lit(end)).alias("in_mix"))


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))
