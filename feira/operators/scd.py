"""Type-2 history of a dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feira.operators.keys import with_previous
from feira.session import materialize


def scd2_merge(history: DataFrame, updates: DataFrame, key: str, tracked: list[str], at: str) -> DataFrame:
    """Merge ``updates`` (key, tracked columns, ``at``) into a versioned dimension.

    ``history`` has the key, the tracked columns, ``valid_from``, ``valid_to`` and ``is_current``. Updates that repeat
    the known state add nothing; every real change closes the open version and opens a new one, and several changes
    of a key in one batch all become versions. The whole history of a key with a change is worked out anew, so an
    update dated before its open version falls into its place. Of updates of a key at the same instant one counts,
    the largest by the tracked columns; an update at the instant a version opened replaces that version.

    Keys without a change pass through. The rest are put in one global (key, time) order rather than in a window per
    key, so a key that owns a third of the updates is spread like any other range of rows.
    """
    now = history.filter("is_current").select(
        F.col(key).alias("__key"), F.struct(*tracked).alias("__now"), F.col("valid_from").alias("__since")
    )
    # What repeats the open version, at or after its start, can only matter between other changes of its key.
    compared = updates.select(key, *tracked, at).join(now, F.col(key).eqNullSafe(F.col("__key")), "left")
    repeats = F.col("__now").isNotNull() & F.struct(*tracked).eqNullSafe(F.col("__now")) & (F.col(at) >= F.col("__since"))
    marked = materialize(compared.select(key, *tracked, at, F.coalesce(repeats, F.lit(False)).alias("__same")), "scd-updates")
    changed = materialize(marked.filter("not __same").select(F.col(key).alias("__changed")).distinct(), "scd-changed")
    in_change = F.col(key).eqNullSafe(F.col("__changed"))
    untouched = history.join(changed, in_change, "left_anti")
    known = history.join(changed, in_change, "left_semi").select(
        key, *tracked, F.col("valid_from").alias(at), F.lit(0).alias("__source")
    )
    told = marked.join(changed, in_change, "left_semi").select(key, *tracked, at, F.lit(1).alias("__source"))
    state = F.struct(*tracked)
    # One state per key and instant, updates before history.
    states = (
        known.unionByName(told)
        .groupBy(key, at)
        .agg(F.max(F.struct(F.col("__source").alias("source"), state.alias("state"))).alias("__best"))
        .select(key, at, F.col("__best.state").alias("__state"))
        .withColumn("__keyed", F.struct(F.col(key).alias("key"), F.col("__state").alias("state")))
    )
    compared = with_previous(states, [key, at], "__keyed", "__previous", unique=True)
    changes = compared.filter(~F.col("__keyed").eqNullSafe(F.col("__previous"))).select(
        key, at, "__state", F.struct(F.col(key).alias("key"), F.col(at).alias("at")).alias("__opened")
    )
    followed = with_previous(changes, [F.col(key).desc(), F.col(at).desc()], "__opened", "__next", unique=True)
    same_key = F.col("__next.key").eqNullSafe(F.col(key)) & F.col("__next").isNotNull()
    opened = followed.select(
        key,
        *[F.col("__state").getField(c).alias(c) for c in tracked],
        F.col(at).alias("valid_from"),
        F.when(same_key, F.col("__next.at")).alias("valid_to"),
        (~F.coalesce(same_key, F.lit(False))).alias("is_current"),
    )
    return untouched.select(opened.columns).unionByName(opened)


def start_history(dim: DataFrame, key: str, tracked: list[str], valid_from: str) -> DataFrame:
    """First version of every dimension row."""
    return dim.select(
        key,
        *tracked,
        F.lit(valid_from).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
