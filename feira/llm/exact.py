"""Exact de-duplication with a split between heavy and light digests.

Texts are equal when they are identical after lower-casing A-Z (null counts as empty). Of equal texts the row with the
largest id stays; among rows that also share the id, one of them.

A Misra-Gries summary per task names the digests that may be frequent. Their exact counts and winners are verified by
one aggregate and then broadcast: at most ``1 / HEAVY_SHARE`` rows, whatever the input. Rows of a heavy digest are
decided where they are read and never shuffled; all other digests have fewer than ``HEAVY_SHARE`` of the rows each and
take an ordinary shuffle.
"""

from __future__ import annotations

import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import col, ship, text_or_empty
from feira.session import materialize

HEAVY_SHARE = 1 / 4096
COUNTERS = 8192


def normalised(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def digest(text_col: str) -> Column:
    """SHA-256 of the normalised text, as 32 bytes."""
    return F.unhex(F.sha2(normalised(text_or_empty(text_col)), 256))


def merge_counters(counters: dict, more: Iterable[tuple], limit: int) -> dict:
    """Misra-Gries: add ``more`` counts, then lower all counters by the one that ranks just below ``limit``.

    What is left undercounts a key by at most n / (limit + 1) after n rows, however the rows were grouped.
    """
    for key, n in more:
        counters[key] = counters.get(key, 0) + n
    if len(counters) > limit:
        cut = sorted(counters.values(), reverse=True)[limit]
        counters = {k: n - cut for k, n in counters.items() if n > cut}
    return counters


def _summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counters: dict = {}
    for batch in batches:
        found = pc.value_counts(batch.column("digest"))
        pairs = zip(found.field(0).to_pylist(), found.field(1).to_pylist(), strict=True)
        counters = merge_counters(counters, pairs, COUNTERS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(counters), pa.binary()), pa.array(list(counters.values()), pa.int64())], ["digest", "n"]
    )


def heavy_winners(keyed: DataFrame) -> DataFrame:
    """(digest, group_size, winner) of every digest with at least ``HEAVY_SHARE`` of the rows; bounded in size.

    ``keyed`` is a written table of (id, digest, row). The summaries' error is below n / (COUNTERS + 1), so a summed
    counter under HEAVY_SHARE * n less that error cannot belong to a heavy digest.
    """
    ship(keyed.sparkSession)
    rows = keyed.count()
    least = rows * (HEAVY_SHARE - 1 / (COUNTERS + 1))
    candidates = materialize(
        keyed.select("digest")
        .mapInArrow(_summaries, "digest binary, n bigint")
        .groupBy("digest")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .select("digest"),
        "heavy-candidates",
    )
    return materialize(
        keyed.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("winner"))
        .filter((F.col("group_size") > 1) & (F.col("group_size") >= rows * HEAVY_SHARE)),
        "heavy-winners",
    )


def duplicate_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    A null id is smaller than any other. Empty and null texts form one group. An empty table gives an empty result.
    """
    keyed = materialize(
        df.select(
            col(id_col).alias("id"), digest(text_col).alias("digest"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    heavy = heavy_winners(keyed)
    known = keyed.join(F.broadcast(heavy), "digest").select("id", "digest", "row", "group_size", "winner")
    group = W.partitionBy("digest")
    light = keyed.join(F.broadcast(heavy.select("digest")), "digest", "left_anti").select(
        "id",
        "digest",
        "row",
        F.count(F.lit(1)).over(group).alias("group_size"),
        F.max(F.struct("id", "row")).over(group).alias("winner"),
    )
    return known.unionByName(light).select(
        F.col("id").alias(id_col),
        F.col("winner.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Losers of heavy digests are dropped where they are read, by the broadcast winners; all other rows meet the rest of
    their group in one shuffle. Of rows that repeat both id and text one stays.
    """
    keyed = materialize(
        df.select(col(id_col).alias("id"), digest(text_col).alias("digest"), F.lit(0).alias("row")), "digests"
    )
    heavy = heavy_winners(keyed).select(F.col("digest").alias("heavy_digest"), F.col("winner.id").alias("winner_id"))
    packed = df.select(F.struct(*[col(c) for c in df.columns]).alias("doc"), col(id_col).alias("id"), digest(text_col).alias("digest"))
    met = packed.join(F.broadcast(heavy), F.col("digest") == F.col("heavy_digest"), "left")
    open_ = met.filter(F.col("heavy_digest").isNull() | F.col("id").eqNullSafe(F.col("winner_id")))
    best = F.row_number().over(W.partitionBy("digest").orderBy(F.col("id").desc_nulls_last()))
    kept = open_.select("doc", "id", "digest").withColumn("place", best).filter("place = 1")
    return kept.select(*[F.col("doc").getField(c).alias(c) for c in df.columns])
