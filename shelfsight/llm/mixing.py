"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table
from shelfsight.session import broadcast_if_small, written

WORD = r"[^\x20\x09-\x0D]+"
MAX_EPOCHS = 2.0
SHARE = 1.5
WEIGHTS = (3, 1, 2)  # fixed values of the mix: weights in turn, by source
SEED = "mix-1"
CUTS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` 0, 1, 2 ... in order of ``source`` (nulls last), without one task seeing all.

    Rows are cut into ranges; a row's rank is the number of rows in earlier ranges plus its place in its own.
    Only the counts per range meet in one place.
    """
    placed = written(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).select("*", F.spark_partition_id().alias("_range")), "ranges"
    )
    before = placed.groupBy("_range").count().select(
        "_range", (F.sum("count").over(W.orderBy("_range")) - F.col("count")).alias("_before")
    )
    place = F.row_number().over(W.partitionBy("_range").orderBy(F.col("source").asc_nulls_last()))
    return placed.withColumn("_place", place).join(before, "_range").withColumn(
        "rank", F.col("_before") + F.col("_place") - 1
    ).drop("_range", "_place", "_before")


def water_fill(sources: DataFrame, budget: float, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """``sources`` (with ``source_size`` and ``weight``) with ``target`` added; targets sum to ``budget``.

    A source's target is its weight's share, but at most ``max_epochs`` times its size. The excess of clamped
    sources is shared out again by weight until no other source exceeds its cap. Each round is one aggregate
    of two numbers. If all caps together are below the budget, every source ends at its cap. Sources without
    a size or without a positive weight get 0.
    """
    cap, weight = F.lit(float(max_epochs)) * F.col("source_size"), F.greatest(F.col("weight").cast("double"), F.lit(0.0))
    level = 0.0
    while True:
        clamped = F.lit(level) * weight > cap
        caps, weights = sources.agg(
            F.coalesce(F.sum(F.when(clamped, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~clamped, weight)), F.lit(0.0))
        ).first()
        if not weights:
            break
        raised = (budget - caps) / weights
        if raised <= level:
            break
        level = raised
    share = F.lit(level) * weight
    return sources.withColumn("target", F.coalesce(F.when(share > cap, cap).otherwise(share), F.lit(0.0)))


def _key(seed: str) -> Column:
    """The seeded order of documents: the digest of the id."""
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def mixing_plan(
    sized: DataFrame, budget_share: float = SHARE, max_epochs: float = MAX_EPOCHS, weights: tuple[float, ...] = WEIGHTS
) -> DataFrame:
    """One row per source: ``(source, source_size, target, whole, last)`` from ``(source, size, key)``.

    A document of the source is taken ``whole`` times, and once more if its key is at most ``last``. Keys are
    cut into ``CUTS`` ranges whose sizes are added up; only documents in the one range that the fraction ends
    in are put in order.
    """
    cut = (F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * CUTS / F.lit(2**32)).cast("int")
    sized = sized.withColumn("cut", cut)
    cuts = written(sized.groupBy("source", "cut").agg(F.sum("size").alias("cut_size")), "cuts")
    turns = F.array(*[F.lit(float(w)) for w in weights])
    sources = ranked(cuts.groupBy("source").agg(F.sum("cut_size").alias("source_size")))
    sources = written(sources.withColumn("weight", F.get(turns, (F.col("rank") % len(weights)).cast("int"))), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    plan = written(
        water_fill(sources, budget_share * total, max_epochs).withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", "whole", "rest"),
        "targets",
    )
    upto = F.sum("cut_size").over(W.partitionBy("source").orderBy("cut"))  # at most CUTS rows a source
    edges = (
        _by_source(cuts.withColumn("before", upto - F.col("cut_size")), plan)
        .where("before <= rest and before + cut_size > rest").select("source", "cut", "before", "rest")
    )
    edges = written(edges, "edges")
    inside = _by_source(sized, edges.withColumnRenamed("cut", "edge")).where("cut = edge")
    inside = inside.groupBy("source", "key", "before", "rest").agg(F.sum("size").alias("size"))
    end = F.col("before") + F.sum("size").over(W.partitionBy("source").orderBy("key"))
    last = (
        inside.withColumn("end", end).where(F.col("end") - F.col("size") / 2 <= F.col("rest"))
        .groupBy("source").agg(F.max("key").alias("last"))
    )
    # Without a document of the edge range, the fraction holds the ranges before it.
    floor = F.lpad(F.lower(F.conv((F.col("cut").cast("double") * (2**32 // CUTS)).cast("long").cast("string"), 10, 16)), 8, "0")
    ends = _by_source(edges.select("source", floor.alias("floor")), last, "left").select("source", F.coalesce("last", "floor").alias("last"))
    return written(_by_source(plan.drop("rest"), ends, "left"), "mixing-plan")


def _by_source(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """A join on ``source`` in which null equals null; ``right`` has one row per source."""
    right = right.withColumnRenamed("source", "_source")
    return left.join(right, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _copies(size: Column) -> Column:
    return F.col("whole") + F.when((size > 0) & (F.col("key") <= F.col("last")), 1).otherwise(0)


def mix(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """One row per row of ``docs``: ``(doc_id, source, size, source_size, target, copies, taken)``.

    Sizes are words. Sources in order of code points (null last, a source of its own) get the weights in turn
    and share ``budget_share`` of all words (see :func:`water_fill`). A source is taken whole as often as its
    target allows; the fraction left over is drawn in the order of a seeded digest of ``doc_id``: a document
    is in if at least its first half lies within the fraction. So a source misses its target by half a
    document at most, and reruns agree. Sources meet their rows in a join on the source, with the side of one
    row per source broadcast if it is small.

    Null and empty texts have size 0 and are never drawn for a fraction. Rows that repeat an id in a source
    are drawn together, null ids count as an empty one. An empty table gives an empty result; other columns
    are not looked at.
    """
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")), "sizes")
    plan = broadcast_if_small(mixing_plan(sized, **how))
    return _by_source(sized, plan).withColumn("copies", _copies(F.col("size"))).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, seed: str = SEED, **how) -> DataFrame:
    """The rows of ``docs`` with all their columns, each as often as :func:`mix` takes it.

    Texts are read twice, once for the sizes and once for the result, and not shuffled unless there are more
    sources than fit a broadcast.
    """
    sized = written(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _key(seed).alias("key")), "sizes")
    plan = broadcast_if_small(mixing_plan(sized, **how).select(F.struct("source", "whole", "last").alias("_plan")))
    words = F.when(F.col("row.text").rlike(WORD), 1).otherwise(0)
    rows = docs.select(F.struct("*").alias("row"), _key(seed).alias("key"))
    joined = rows.join(plan, F.col("row.source").eqNullSafe(F.col("_plan.source")))
    joined = joined.select("row", "key", F.col("_plan.whole").alias("whole"), F.col("_plan.last").alias("last"))
    copies = joined.select("row", _copies(words).cast("int").alias("copies")).where("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")


@query("op2_source_mixing", r"""
    with sized as (
      select doc_id, source, coalesce(len(regexp_extract_all(text, '[^ 	-
]+')), 0)::bigint as size,
        md5('mix-1:' || coalesce(doc_id::varchar, '')) as key from documents),
    ranked as (
      select source, sum(size)::double as s,
        [3.0::double, 1.0, 2.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
      from sized group by source),
    filled as (
      select *, sum(s) over () * 1.5 as budget, 2 * s as cap, row_number() over (order by 2 * s / w, source nulls last) as place,
        coalesce(sum(2 * s) over (order by 2 * s / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as caps,
        sum(w) over (order by 2 * s / w, source nulls last rows between current row and unbounded following) as free from ranked),
    level as (select arg_min((budget - caps) / free, place) as level from filled where (budget - caps) / free * w <= cap),
    targets as (
      select source, s, case when level * w > cap then cap else level * w end as target from filled, level),
    parts as (
      select *, case when s > 0 then floor(target / s) else 0 end as whole from targets),
    placed as (
      select d.*, p.s, p.target, p.whole, p.target - p.whole * p.s as rest,
        sum(size) over (partition by d.source order by key) as upto, sum(size) over (partition by d.source, key) as unit
      from sized d join parts p on d.source is not distinct from p.source)
    select doc_id, size, s::bigint as source_size, target,
      (size * (whole + case when size > 0 and upto - unit / 2 <= rest then 1 else 0 end))::bigint as taken from placed""")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")
