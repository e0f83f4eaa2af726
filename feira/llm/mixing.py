"""Mixing sources to target weights by systematic sampling, in DataFrame operations only.

The size of a document is its number of words (runs of characters that are not ASCII white space). Sources in code
point order, null last, weigh ``WEIGHTS`` in turn and share all words by weight. A target stops at ``MOST_COPIES`` times
the words its source has; the excess is shared again by weight until no target is above.

Every document of a source is expected ``target / source words`` times. The prefix sum of these expectations over the
documents of a source, ordered by size and id, plus one random offset, crosses an integer boundary once per copy. Since
the expectation is constant within a source, the prefix sum is a rank times that number; and since documents are in
order of size, what one document has too much its neighbours have too little, so the words taken miss the target by no
more than about the longest document.

Ranks come from a range sort over (source, size, id), whose slices split a hot source like any other. Only slice sizes
(one per shuffle partition) and source totals are summed over all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import col, fresh, text_or_empty
from feira.session import materialize

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = "feira-mix"
_WORD = "[^\\x20\\x09-\\x0D]+"
_PLACE_BITS = (1 << 33) - 1


def words(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(_WORD)).cast("bigint")


def numbered(df: DataFrame, order: list[Column], number: str, name: str) -> DataFrame:
    """``df`` with a dense 1-based number in the order given; the sorted slices are written once."""
    slice_, place, before = fresh(df, "__slice"), fresh(df, "__place"), fresh(df, "__before")
    written = materialize(
        df.orderBy(*order).select(
            *[col(c) for c in df.columns],
            F.spark_partition_id().alias(slice_),
            F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE_BITS)).alias(place),
        ),
        name,
    )
    sizes = written.groupBy(slice_).agg(F.count(F.lit(1)).alias("n"))
    earlier = W.orderBy(slice_).rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(slice_, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(before))
    # At most one row per shuffle partition.
    joined = written.join(F.broadcast(offsets), slice_)
    return joined.select(*[col(c) for c in df.columns], (F.col(before) + F.col(place) + 1).alias(number))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, source_rows, rows_before, target) from rows of (source, size).

    Targets are filled in rounds. Each round is one aggregate over the table of sources; two numbers of it reach the
    driver. Limits are compared as whole numbers, so every engine takes the same side.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    turn = ((F.col("number") - 1) % len(weights)).cast("int")
    sources = materialize(
        numbered(totals, [F.col("source").asc_nulls_last()], "number", "sources-ranked").select(
            "number",
            "source",
            "source_size",
            "source_rows",
            F.element_at(F.array(*[F.lit(w).cast("bigint") for w in weights]), turn + 1).alias("weight"),
            (F.col("source_size") * most_copies).alias("most"),
        ),
        "sources",
    )
    first = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    everything = free = first[0] or 0
    weight = first[1] or 0
    while weight:
        capped = F.col("most") * F.lit(weight) <= F.col("weight") * F.lit(free)
        round_ = sources.agg(F.sum(F.when(capped, F.col("most"))), F.sum(F.when(~capped, F.col("weight")))).first()
        left, weight_left = everything - (round_[0] or 0), round_[1] or 0
        if (left, weight_left) == (free, weight):
            break
        free, weight = left, weight_left
    share = F.col("weight") * F.lit(free) / F.lit(weight or 1)
    capped = F.col("most") * F.lit(weight) <= F.col("weight") * F.lit(free)
    earlier = W.orderBy("number").rowsBetween(W.unboundedPreceding, -1)
    return materialize(
        sources.select(
            "source",
            "source_size",
            "source_rows",
            F.coalesce(F.sum("source_rows").over(earlier), F.lit(0)).alias("rows_before"),
            F.when(F.lit(not weight) | capped, F.col("most").cast("double")).otherwise(share).alias("target"),
        ),
        "targets",
    )


def offset(source: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on the seed and the source only."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(source, F.lit("")))), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(1 << 32)


def mixing_plan(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    keep: list[str] | None = None,
    seed: str = SEED,
) -> DataFrame:
    """One row per document: the columns ``keep`` (all by default), then size, source_size, target, copies, taken.

    Null text counts as no words, a null source is the last source, a null id the smallest id. Repeated rows are
    documents of their own. Input columns with the names of the new ones are left out.
    """
    new = ["size", "source_size", "target", "copies", "taken"]
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in new]
    work = df.select(
        F.struct(*[col(c) for c in kept]).alias("row"),
        col(id_col).alias("id"),
        col(source_col).cast("string").alias("source"),
        words(text_col).alias("size"),
        F.xxhash64(col(text_col)).alias("text_hash"),
        F.monotonically_increasing_id().alias("arrival"),
    )
    order = [F.col("source").asc_nulls_last(), *map(F.col, ("size", "id", "text_hash", "arrival"))]
    ranked = numbered(work, order, "number", "mix-ranked")
    # One row per source; Spark broadcasts it by its written size or shuffles.
    targets = source_targets(ranked.select("source", "size"))
    joined = ranked.alias("d").join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))
    )
    rank = F.col("number") - F.col("rows_before")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = F.floor(rank * expected + offset(F.col("source"), seed)) - F.floor(
        (rank - 1) * expected + offset(F.col("source"), seed)
    )
    return joined.select(
        *[F.col("row").getField(c).alias(c) for c in kept],
        "size",
        "source_size",
        "target",
        crossed.cast("bigint").alias("copies"),
        (crossed * F.col("size")).cast("bigint").alias("taken"),
    )


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mixed documents: each as often as its copies say, with the columns of ``df``."""
    work = df.select(
        F.struct(*[col(c) for c in df.columns]).alias("doc"),
        col(id_col).alias("id"),
        col(source_col).alias("source"),
        col(text_col).alias("text"),
    )
    planned = mixing_plan(work, "id", "source", "text", keep=["doc"])
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    repeated = planned.filter(F.col("copies") > 0).select("doc", copies.alias("copy"))
    return repeated.select(*[F.col("doc").getField(c).alias(c) for c in df.columns])
