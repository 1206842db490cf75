"""Mixing sources to target weights by entropy balancing.

Every document of a source gets a rate ``min(cap, exp(lambda * size / scale))``: of all rates
that reach the source's token target these stay closest to one (Kullback-Leibler, with the
cap as a bound).  ``lambda`` solves the convex dual.  Its Newton steps are aggregations over a
histogram (source, size, documents), which is exact because a rate depends on nothing else,
and all sources step together.  Sums are decimals, so their order does not matter and
reruns agree to the last document.

Rates are rounded to copies by a hash of the document id against a threshold per source that
brings the words taken as near to the target as a hash bin allows.

Defined cases: null or empty text has size 0 and takes 0 words; a null source is a source of
its own, last in order; rows repeated with one id are rounded alike; an empty table gives an
empty result; columns of any name pass through ``apply_mix`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.llm.common import WORD, materialize, packed, read_table, unpacked

WEIGHTS = (5, 2, 1)
CAP = 3
BINS = 8192
TOLERANCE = 1e-7
MAX_STEPS = 60


def numbered(key: str, text: str) -> Column:
    """A hash of each row: of its id or, without one, its text; beyond the first of a task also of more.

    Rows of one id are told apart by their text and by a number among the equal ones that their task
    has seen.  So a row whose id is its own rounds alike wherever it is.
    """

    @F.arrow_udf("long")
    def again(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        seen: dict[int, int] = {}
        for b in batches:
            out = []
            for h in b.to_pylist():
                seen[h] = n = seen.get(h, -1) + 1
                out.append(n)
            yield pa.array(out, pa.int64())

    own = F.when(F.col(key).isNull(), F.xxhash64(F.lit("mix"), F.col(text))).otherwise(F.xxhash64(F.lit("mix"), F.col(key)))
    count = again(own)
    return F.when(count == 0, own).otherwise(F.xxhash64(own, count, F.col(text), F.spark_partition_id()))


def token_size(text: str | Column = "text") -> Column:
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Position of each source in code point order, null last, from 0.

    Sources are ranged over partitions and numbered in each; only one count per partition
    meets in one task.
    """
    # Nulls sort last through a key of their own.
    ranged = sources.repartitionByRange(F.col("_source").isNull(), F.col("_source"))
    ranged = materialize(ranged.withColumn("_part", F.spark_partition_id()), "mix-sources")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(F.asc_nulls_last("_source")))
    return (
        ranged.withColumn("_place", place)
        .join(offsets, "_part")
        .select("_source", "_size", "_largest", "_least", "_mean",
                (F.col("_before") + F.col("_place") - 1).alias("_idx"))
    )


def _targets(sources: DataFrame, weights: Sequence[float], cap: float, share: float) -> DataFrame:
    """Weights' shares of all sizes, cut at ``cap`` times a source's size, excess reshared.

    The level t with sum(min(cap * size, weight * t)) = total is reached from below: each
    round fixes sources above their cap and divides what is left among the others.
    """
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = materialize(
        sources.withColumn("_weight", F.element_at(cycle, (F.col("_idx") % len(weights) + 1).cast("int")))
        .withColumn("_most", F.col("_size") * F.lit(float(cap))),
        "mix-weights",
    )
    total = (sources.agg(F.sum("_size")).first()[0] or 0) * share
    level, fixed = 0.0, -1
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_most")
        exact = F.when(above, F.col("_most")).cast("decimal(38,3)")
        n, held, free = sources.agg(
            F.count(F.when(above, 1)), F.coalesce(F.sum(exact), F.lit(0)), F.sum(F.when(~above, F.col("_weight").cast("decimal(38,6)")))
        ).first()
        if n == fixed or not free:
            break
        fixed, level = n, max(level, (total - float(held)) / float(free))
    return sources.withColumn("_target", F.least(F.col("_most"), F.col("_weight") * F.lit(level)))


def _rate(cap: float) -> Column:
    tilt = F.least(F.col("_lambda") * F.col("_z") / F.col("_scale"), F.lit(50.0))
    return F.when(F.col("_full"), F.lit(float(cap))).otherwise(
        F.least(F.lit(float(cap)), F.exp(tilt))
    )


def solve(
    docs: DataFrame,
    *,
    text: str = "text",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[float] = WEIGHTS,
    cap: float = CAP,
    share: float = 1.0,
) -> DataFrame:
    """One row per source: size, target, dual variable and rounding threshold."""
    sized = materialize(
        docs.select(
            numbered(key, text).alias("_key"), F.col(source).alias("_source"), token_size(text).alias("_z")
        ),
        "mix-sizes",
    )
    hist = sized.groupBy("_source", "_z").agg(F.count(F.lit(1)).alias("_docs"))
    sources = hist.groupBy("_source").agg(
        F.sum(F.col("_z") * F.col("_docs")).alias("_size"),
        F.max("_z").alias("_largest"),
        F.min(F.when(F.col("_z") > 0, F.col("_z"))).alias("_least"),
        (F.sum(F.col("_z").cast("decimal(20,0)") * F.col("_z") * F.col("_docs")).cast("double")).alias("_mean"),
    )
    state = _targets(_numbered(sources), weights, cap, share)
    ratio = F.try_divide("_target", "_size")
    state = state.select(
        "_source", "_idx", "_size", "_target",
        # Mean size of the document a word is in: the dual variable then has no unit.
        F.greatest(F.col("_mean") / F.greatest(F.col("_size"), F.lit(1)), F.lit(1.0)).alias("_scale"),
        (F.col("_size") * F.lit(float(cap)) <= F.col("_target") * F.lit(1 + 1e-12)).alias("_full"),
        "_least", ratio.alias("_ratio"),
    )
    reach = F.try_divide("_scale", "_least")
    state = state.select(
        "*",
        F.lit(0.0).alias("_lambda"),
        F.when(F.col("_ratio") < 1, F.log("_ratio") * reach).otherwise(F.lit(0.0)).alias("_lo"),
        F.when(F.col("_ratio") < 1, F.lit(0.0)).otherwise(F.log(F.lit(float(cap))) * reach).alias("_hi"),
        (F.col("_full") | (F.col("_size") == 0)).alias("_done"),
    )
    state = materialize(state, "mix-dual")
    hist = materialize(
        hist.where("_z > 0")
        .join(state.select(F.col("_source").alias("_at"), "_idx"), F.col("_source").eqNullSafe(F.col("_at")))
        .select("_idx", "_z", "_docs"),
        "mix-histogram",
    )
    for _ in range(MAX_STEPS):
        state, left = _newton(hist, state, cap)
        if not left:
            break
    else:
        raise ArithmeticError(f"{MAX_STEPS} Newton steps did not reach the targets")
    return _thresholds(sized, state, cap)


def _newton(hist: DataFrame, state: DataFrame, cap: float) -> tuple[DataFrame, int]:
    """One guarded Newton step of every source that has not converged."""
    exact = "decimal(38,6)"
    moving = state.where(~F.col("_done")).select("_idx", "_lambda", "_scale", "_full")
    words = F.col("_z") * F.col("_docs")
    sums = (
        hist.join(moving, "_idx")
        .withColumn("_r", _rate(cap))
        .groupBy("_idx")
        .agg(
            F.sum((words * F.col("_r")).cast(exact)).cast("double").alias("_f"),
            F.sum(F.when(F.col("_r") < cap, words * F.col("_r") * F.col("_z") / F.col("_scale")).cast(exact))
            .cast("double").alias("_slope"),
        )
    )
    gap = F.col("_f") - F.col("_target")
    lo = F.when(gap < 0, F.greatest("_lo", "_lambda")).otherwise(F.col("_lo"))
    hi = F.when(gap >= 0, F.least("_hi", "_lambda")).otherwise(F.col("_hi"))
    newton = F.col("_lambda") - F.try_divide(gap, F.col("_slope"))
    inside = (F.col("_slope") > 0) & (newton > F.col("_nlo")) & (newton < F.col("_nhi"))
    stepped = (
        state.join(sums, "_idx", "left")
        .withColumn("_nlo", F.when(F.col("_f").isNull(), F.col("_lo")).otherwise(lo))
        .withColumn("_nhi", F.when(F.col("_f").isNull(), F.col("_hi")).otherwise(hi))
        .withColumn(
            "_ndone",
            F.col("_done")
            | F.col("_f").isNull()
            | (F.abs(gap) <= F.lit(TOLERANCE) * F.col("_target"))
            | (F.col("_nhi") - F.col("_nlo") <= F.lit(1e-12) * F.greatest(F.abs("_nhi"), F.lit(1.0))),
        )
        .withColumn(
            "_next",
            F.when(F.col("_ndone"), F.col("_lambda"))
            .when(inside, newton)
            .otherwise((F.col("_nlo") + F.col("_nhi")) / 2),
        )
        .select(
            "_source", "_idx", "_size", "_target", "_scale", "_full", "_least", "_ratio",
            F.col("_next").alias("_lambda"), F.col("_nlo").alias("_lo"), F.col("_nhi").alias("_hi"),
            F.col("_ndone").alias("_done"),
        )
    )
    stepped = materialize(stepped, "mix-dual")
    return stepped, stepped.where(~F.col("_done")).limit(1).count()


def _place(cap: float) -> tuple[Column, Column]:
    """Copies a rate is sure of, and the bin of (uniform hash - what the rate has beyond)."""
    rate = _rate(cap)
    sure = F.least(F.floor(rate), F.lit(int(cap) - 1))
    uniform = F.shiftrightunsigned(F.col("_key"), 11) / F.lit(float(1 << 53))
    place = F.floor((uniform - (rate - sure) + 1) * F.lit(BINS)).cast("int")
    return sure.cast("long"), place


def _thresholds(sized: DataFrame, state: DataFrame, cap: float) -> DataFrame:
    """The hash bin up to which documents take one copy more, nearest to each target."""
    sure, place = _place(cap)
    at = F.col("s._source").eqNullSafe(F.col("d._source"))
    placed = sized.alias("d").join(state.alias("s"), at).select("_idx", "_z", "_target", sure.alias("_sure"), place.alias("_bin"))
    bins = placed.groupBy("_idx", "_target", "_bin").agg(
        F.sum("_z").alias("_words"), F.sum(F.col("_sure") * F.col("_z")).alias("_base")
    )
    upto = Window.partitionBy("_idx").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    miss = F.abs(F.col("_all") + F.col("_upto") - F.col("_target"))
    cuts = (
        bins.withColumn("_all", F.sum("_base").over(Window.partitionBy("_idx")))
        .withColumn("_upto", F.sum("_words").over(upto))
        .groupBy("_idx")
        .agg(
            F.min(F.struct(miss.alias("m"), F.col("_bin"))).alias("_best"),
            F.min(F.abs(F.col("_all") - F.col("_target"))).alias("_none"),
        )
        .select("_idx", F.when(F.col("_none") < F.col("_best.m"), F.lit(-1)).otherwise(F.col("_best._bin")).alias("_cut"))
    )
    return materialize(state.join(cuts, "_idx", "left"), "mix-solved")


def apply_mix(
    docs: DataFrame, state: DataFrame, *, text: str = "text", source: str = "source",
    key: str = "doc_id", cap: float = CAP,
) -> DataFrame:
    """Every row as ``_row`` with ``_z`` (size), ``_size``, ``_target``, ``_r`` and ``_copies``."""
    keyed = docs.select(
        packed(docs), numbered(key, text).alias("_key"), F.col(source).alias("_from"), token_size(text).alias("_z")
    )
    sure, place = _place(cap)
    joined = keyed.join(state, F.col("_from").eqNullSafe(F.col("_source")))
    return joined.select(
        "_row", "_z", "_size", "_target", _rate(cap).alias("_r"),
        (sure + F.when(place <= F.col("_cut"), 1).otherwise(0)).alias("_copies"),
    )


def mix(docs: DataFrame, **names) -> DataFrame:
    """The documents of the mix: each row as often as it has copies, same columns."""
    mixed = apply_mix(docs, solve(docs, **names), **{k: v for k, v in names.items() if k in ("text", "source", "key", "cap")})
    numbers = F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))
    copies = mixed.where("_copies > 0").withColumn("_copy", numbers)
    return copies.select(*unpacked(copies, docs.columns))


def op10_source_mixing(spark, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = apply_mix(docs, solve(docs))
    return mixed.select(
        F.col("_row.doc_id").alias("doc_id"),
        F.col("_z").alias("size"),
        F.col("_size").alias("source_size"),
        F.col("_target").cast("double").alias("target"),
        (F.col("_copies") * F.col("_z")).cast("long").alias("taken"),
        F.round("_r", 9).alias("rate"),
        F.col("_copies").alias("copies"),
    )
