"""How filters of documents overlap: what each order of applying them removes, and at which step."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.llm.registry import query, table
from shelfsight.session import written

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)
LEAST_WORDS = 100
SPLIT = 10_000  # copies of one text that one task may get
NEAR_HASHES = 100_000  # that many hashes of repeated texts are sent to all tasks, more are joined by a shuffle


def _bit(letter: str, fails: Column) -> Column:
    return F.when(fails, 1 << FILTERS.index(letter)).otherwise(0)


def own_failures(text: Column) -> Column:
    """A bit for each of the filters A to D that a text fails by itself."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    words = F.filter(F.split(spaced, " "), lambda w: w != "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        _bit("A", n < LEAST_WORDS)
        .bitwiseOR(_bit("B", 100 * F.size(F.array_distinct(words)) < 80 * n))
        .bitwiseOR(_bit("C", 100 * capitals > 10 * F.length(text)))
        .bitwiseOR(_bit("D", text.rlike("[#$%&*|]")))
    )


def later_copies(docs: DataFrame, split: int = SPLIT, near_hashes: int = NEAR_HASHES) -> DataFrame:
    """The rows of ``docs`` (``doc_id``, ``text`` and others) that have their text from a row with a smaller id.

    Hashes held by one id only are left out first, so that other texts never move. Then a left-semi join on hash, whole
    text and a smaller id decides. Its right side has one row per text, the smallest id, combined in each
    task first; hashes of more than ``split`` rows are dealt over as many places as that takes, with the right row in
    each. Null ids are neither smaller nor greater than any.
    """
    hashed = docs.withColumn("_hash", F.xxhash64("text"))
    often = hashed.where("doc_id IS NOT NULL").groupBy("_hash").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("doc_id").alias("_low"), F.max("doc_id").alias("_high")
    )
    often = written(often.where("_low < _high").select("_hash", F.ceil(F.col("_rows") / split).cast("int").alias("_places")), "copied-hashes")
    if often.limit(near_hashes + 1).count() <= near_hashes:
        often = F.broadcast(often)
    rows = hashed.where("doc_id IS NOT NULL").join(often, "_hash")
    place = F.pmod(F.xxhash64("doc_id"), F.col("_places")).cast("int")
    least = rows.groupBy("_hash", "text", "_places").agg(F.min("doc_id").alias("_least"))
    least = least.select(
        F.col("_hash").alias("_h"), F.col("text").alias("_t"), "_least", F.explode(F.sequence(F.lit(0), F.col("_places") - 1)).alias("_p")
    )
    left = rows.withColumn("_place", place)
    same = (F.col("_hash") == F.col("_h")) & (F.col("_place") == F.col("_p")) & (F.col("text") == F.col("_t"))
    return left.join(least, same & (F.col("_least") < F.col("doc_id")), "left_semi").drop("_places", "_place")


def orders(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """Every order of the filters, step by step: ``(order, step, the filter's place, bits of those before)``."""
    rows = []
    for order in permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            rows.append(("".join(order), step, filters.index(letter), before))
            before |= 1 << filters.index(letter)
    return rows


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per language (``part``), order of the five filters and step, with the counts described below.

    Filters: A fewer than 100 words; B less than 80% of the words different; C more than 10% of the code points
    A-Z; D holds one of ``#$%&*|``; E another row has the identical text under a smaller id. Each document fails a
    set of filters; the sets are counted per language, and all 120 orders follow from these counts:
    ``kept`` fails none up to this step, ``removed`` fails this step's filter and none before, ``redundant`` fails it
    and one before, ``unique_fails`` fails it alone, ``good_lost`` and ``toxic_lost`` are the removed ones labelled
    ``quality`` 1 and ``toxic`` 1, ``shapley`` is what the filter removes, summed over all orders.

    E comes from a left-semi join of the table with itself (:func:`later_copies`); its ids are added to those that
    fail A to D, and the bits of each document combined. A null text is an empty one, a null language an empty
    string. Documents are rows: those that repeat id, language and text are counted as often as they stand there, and
    none of them is a copy of the other. Null ids have no labels and are no copies. An id that is labelled more than
    once counts as good or toxic if any of its labels says so. Other columns are not looked at; an empty table gives
    an empty result.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    own = read.select("doc_id", "part", F.xxhash64("text").alias("_hash"), own_failures(F.col("text")).alias("bits"), F.lit(1).alias("n"))
    copies = later_copies(read).select("doc_id", "part", "_hash", F.lit(COPY).alias("bits"), F.lit(0).alias("n"))
    each = own.unionAll(copies).groupBy("doc_id", "part", "_hash").agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("bad")
    )
    marked = each.join(marks, F.col("doc_id") == F.col("_id"), "left")
    sets = marked.groupBy("part", "bits").agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"), F.sum(F.col("n") * F.coalesce("bad", F.lit(0))).alias("bad")
    )
    # Per language at most 32 sets; every step of every order picks those that count.
    found = sets.groupBy("part").agg(F.collect_list(F.struct("bits", "rows", "good", "bad")).alias("sets"))
    steps = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(1 << f).alias("bit"), F.lit(b).alias("before")) for o, s, f, b in orders()])
    each_step = found.withColumn("s", F.explode(steps)).select("part", "s.*", "sets")

    def total(value: str, picked) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda t, x: t + F.when(picked(x["bits"]), x[value]).otherwise(0))

    bit, before = F.col("bit"), F.col("before")
    fails = lambda bits: bits.bitwiseAND(bit) != 0
    gone = lambda bits: bits.bitwiseAND(before) != 0
    first = lambda bits: fails(bits) & ~gone(bits)
    # Of all orders, a filter comes first among the k that a document fails in one of k.
    share = F.aggregate(
        "sets", F.lit(0).cast("long"),
        lambda t, x: t + F.when(fails(x["bits"]), x["rows"] * (F.lit(120) / F.bit_count(x["bits"])).cast("long")).otherwise(0),
    )
    return each_step.select(
        "part", "filter_order", "step",
        total("rows", lambda b: ~fails(b) & ~gone(b)).alias("kept"), total("rows", first).alias("removed"),
        total("rows", lambda b: fails(b) & gone(b)).alias("redundant"), total("rows", lambda b: b == bit).alias("unique_fails"),
        total("good", first).alias("good_lost"), total("bad", first).alias("toxic_lost"), share.alias("shapley"),
    )


WORDS_SQL = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
ORACLE = f"""
    WITH texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    marks AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS bad FROM labels GROUP BY doc_id),
    failing AS (
      SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
        (len({WORDS_SQL}) < 100)::INT AS A, (100 * len(list_distinct({WORDS_SQL})) < 80 * len({WORDS_SQL}))::INT AS B,
        (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT AS C, regexp_matches(t, '[#$%&*|]')::INT AS D,
        coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INT AS E
      FROM texts d LEFT JOIN marks m ON d.doc_id = m.doc_id),
    sets AS (SELECT part, A + 2 * B + 4 * C + 8 * D + 16 * E AS bits, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM failing GROUP BY ALL),
    letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    orders AS (
      SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
      WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
    steps AS (
      SELECT filter_order, step::INT AS step, 1 << (instr('ABCDE', filter_order[step]) - 1) AS bit,
        coalesce(list_sum([1 << (instr('ABCDE', x) - 1) FOR x IN string_split(filter_order[:step - 1], '') IF x <> '']), 0)::INT AS before
      FROM orders, range(1, 6) AS r(step))
    SELECT part, filter_order, step,
      CAST(coalesce(sum(n) FILTER (WHERE bits & (bit | before) = 0), 0) AS BIGINT) AS kept,
      CAST(coalesce(sum(n) FILTER (WHERE bits & bit <> 0 AND bits & before = 0), 0) AS BIGINT) AS removed,
      CAST(coalesce(sum(n) FILTER (WHERE bits & bit <> 0 AND bits & before <> 0), 0) AS BIGINT) AS redundant,
      CAST(coalesce(sum(n) FILTER (WHERE bits = bit), 0) AS BIGINT) AS unique_fails,
      CAST(coalesce(sum(good) FILTER (WHERE bits & bit <> 0 AND bits & before = 0), 0) AS BIGINT) AS good_lost,
      CAST(coalesce(sum(bad) FILTER (WHERE bits & bit <> 0 AND bits & before = 0), 0) AS BIGINT) AS toxic_lost,
      CAST(sum(CAST(coalesce(sum(n) FILTER (WHERE bits & bit <> 0 AND bits & before = 0), 0) AS BIGINT)) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
    FROM sets, steps GROUP BY part, filter_order, step, bit"""


@query("op13_filter_audit", ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))
