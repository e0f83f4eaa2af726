"""SimHash near-duplicates: 64-bit fingerprints linked at ``RADIUS`` or fewer differing bits.

Fingerprints are taken from 3-word shingles and collapsed to distinct ones. Two that differ in at most ``RADIUS`` bits
agree on at least two of four 16-bit blocks, so each goes to the six buckets named by a pair of its blocks. A bucket
with more than ``CELL`` members is cut into chunks, and every pair of chunks is a cell of its own, so no task ever holds
more than two chunks of a bucket and no pair is lost.

Within a cell, comparison is bit-sliced: 64 members form a word, stored as 64 bit planes. One member is compared with
64 others at once by XOR with each plane, differing bits are counted by carry-save addition in two counter planes and
an overflow plane, and words whose lanes have all overflown are abandoned. Matches are united at once; a cell reports at
most one link per member.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import col, fresh, ship, text_or_empty
from feira.llm.components import components, roots
from feira.session import materialize

SHINGLE = 3
SEED = 42
RADIUS = 2
BLOCKS = 4
CELL = 2048
_AT_ONCE = 1 << 16
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint: the bits set in over half of the shingles' XXH64. No words: zero."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    where = zip(starts[:n].tolist(), ends[len(words) - n :].tolist(), strict=True)
    hashes = np.array([digest(joined[a:b], SEED) for a, b in where], "<u8")
    votes = np.zeros(64, np.int64)
    for part in range(0, n, 4096):
        bits = np.unpackbits(hashes[part : part + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int32)
    return int((2 * votes > n) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(values.view(np.int64), pa.int64())], ["id", "fp"]
        )


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) per row, fp as a signed 64-bit number."""
    ship(df.sparkSession)
    work = df.select(col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return work.mapInArrow(_fingerprints, f"id {work.schema['id'].dataType.simpleString()}, fp bigint")


def close_pairs(fps: np.ndarray, group: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i < j) of fingerprints of the same group within ``radius`` (0 to 2); ``group`` is sorted."""
    n = len(fps)
    if n < 2:
        return
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    sizes = np.diff(np.append(first, n))
    words = -(-sizes // 64)
    base = np.cumsum(words) - words
    of = np.repeat(np.arange(len(first)), sizes)
    place = np.arange(n) - first[of]
    word, lane = base[of] + place // 64, (place % 64).astype(np.uint64)
    word_start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    planes = [
        np.bitwise_or.reduceat(((fps >> np.uint64(j)) & np.uint64(1)) << lane, word_start) for j in range(64)
    ]
    lanes = np.diff(np.append(word_start, n)).astype(np.uint64)
    unused = np.where(lanes < 64, _ALL << (lanes % np.uint64(64)), np.uint64(0))
    # Every member meets the words of its group from its own on, some members at a time.
    last = (base + words)[of]
    meets = last - word
    upto = np.cumsum(meets)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + _AT_ONCE, "right")))
        m = meets[begin:end]
        member = np.repeat(np.arange(begin, end), m)
        other = np.repeat(word[begin:end], m) + (np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m))
        # In its own word a member meets the lanes behind it only.
        done = np.where(other == word[member], (np.uint64(2) << lane[member]) - np.uint64(1), np.uint64(0))
        over = unused[other] | done
        ones, twos = np.zeros_like(over), np.zeros_like(over)
        for j in range(64):
            differs = planes[j][other] ^ (np.uint64(0) - ((fps[member] >> np.uint64(j)) & np.uint64(1)))
            carry = ones & differs
            ones ^= differs
            over |= twos & carry
            twos ^= carry
            over |= twos & ones if radius == 2 else twos if radius == 1 else twos | ones
            if j % 4 == 3:
                alive = over != _ALL
                if not alive.all():
                    member, other, over, ones, twos = (x[alive] for x in (member, other, over, ones, twos))
                    if not len(member):
                        break
        if len(member):
            hits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, bit = np.nonzero(hits)
            yield member[row], word_start[other[row]] + bit
        begin = end


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows sorted by cell, one per member that is not the first of its component in the cell."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        fps = table.column("fp").to_numpy().view(np.uint64)
        cells = np.stack([table.column(c).to_numpy() for c in ("band", "key", "left", "right")])
        changed = np.append(True, (cells[:, 1:] != cells[:, :-1]).any(axis=0)) if len(fps) else np.zeros(0, bool)
        parent = np.arange(len(fps))
        for a, b in close_pairs(fps, np.cumsum(changed)):
            parent = roots(len(fps), a, b, parent)
        linked = np.flatnonzero(parent != np.arange(len(fps)))
        rep = table.column("rep").to_numpy()
        return pa.RecordBatch.from_arrays([pa.array(rep[linked]), pa.array(rep[parent[linked]])], ["a", "b"])

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows >= 100_000:
            table = pa.Table.from_batches(held)
            names = ("band", "key", "left", "right")
            last = [table.column(c)[rows - 1] for c in names]
            cut = rows
            # The last cell may go on in the next batch.
            tail = np.ones(rows, bool)
            for c, v in zip(names, last, strict=True):
                tail &= table.column(c).to_numpy() == v.as_py()
            cut = int(rows - tail.sum())
            yield solve(table.slice(0, cut))
            held, rows = table.slice(cut).to_batches(), rows - cut
    if held:
        yield solve(pa.Table.from_batches(held))


def _buckets(distinct: DataFrame, cell: int) -> DataFrame:
    """Rows (band, key, left, right, fp, rep): each fingerprint in its buckets' cells."""
    bits = 64 // BLOCKS
    block = [F.shiftrightunsigned(F.col("fp"), bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(BLOCKS)]
    keys = [
        F.struct(F.lit(n).alias("band"), (block[i] * (1 << bits) + block[j]).alias("key"))
        for n, (i, j) in enumerate(combinations(range(BLOCKS), BLOCKS - RADIUS))
    ]
    spread = distinct.select("fp", "rep", F.inline(F.array(*keys)))
    sizes = spread.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n"))
    shared = materialize(sizes.filter("n > 1"), "simhash-buckets")
    chunks = F.ceil(F.col("n") / cell).cast("int")
    own = F.pmod(F.xxhash64("fp", "band"), chunks).cast("int")
    each = F.transform(
        F.sequence(F.lit(0), chunks - 1),
        lambda i: F.struct(F.least(i, own).alias("left"), F.greatest(i, own).alias("right")),
    )
    return spread.join(shared, ["band", "key"]).select("band", "key", "fp", "rep", F.inline(each))


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id (the smallest id reachable).

    Null and blank texts have fingerprint zero and are linked like any other. Rows with a null id are left to the
    component of the others with their fingerprint; a component of null ids only has a null component_id. An empty
    table gives an empty result.
    """
    hashed = materialize(fingerprints(df, id_col, text_col), "simhash")
    # A component's name is its smallest id, so a fingerprint is represented by its smallest id.
    distinct = materialize(hashed.groupBy("fp").agg(F.min("id").alias("rep")), "simhash-distinct")
    links = materialize(
        _buckets(distinct.filter("rep is not null"), cell)
        .repartition("band", "key", "left", "right")
        .sortWithinPartitions("band", "key", "left", "right", "rep")
        .mapInArrow(_links, "a {0}, b {0}".format(df.schema[id_col].dataType.simpleString())),
        "simhash-links",
    )
    named = components(links, "simhash-components")
    labelled = materialize(
        distinct.join(named, distinct["rep"] == named["node"], "left").select(
            "fp", F.coalesce("component", "rep").alias("component_id")
        ),
        "simhash-labels",
    )
    return hashed.join(labelled, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, the one with the smallest id, with all its columns.

    What goes is decided on ids, so that texts stay where they are. Rows that repeat an id are told apart by their
    fingerprints: of those in the component that the id names one stays. Rows with a null id are of no component and
    stay. Null and blank texts are linked like any other; an empty table stays empty.
    """
    groups = materialize(near_groups(df, id_col, text_col), "simhash-groups")
    groups = groups.select(col(id_col).alias("of"), "fingerprint", "component_id").filter("of is not null")
    fate = materialize(
        groups.groupBy("of")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("of") != F.col("component_id")).alias("goes"))
        .filter("goes or n > 1"),
        "simhash-fate",
    )
    of = fresh(df, "__of")
    kept = df.join(fate.select(F.col("of").alias(of)), col(id_col) == F.col(of), "left_anti")
    repeated = fate.filter("n > 1").select("of")
    if repeated.isEmpty():
        return kept
    again = materialize(
        df.select(
            F.struct(*[col(c) for c in df.columns]).alias("doc"),
            col(id_col).alias("of"),
            col(text_col).alias("text"),
            F.monotonically_increasing_id().alias("number"),
        ).join(repeated, "of", "left_semi"),
        "simhash-again",
    )
    signed = fingerprints(again, "number", "text").select(
        F.col("id").alias("number"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    )
    own = groups.filter(F.col("of") == F.col("component_id")).select("of", "fingerprint").distinct()
    first = F.row_number().over(W.partitionBy("of").orderBy(F.xxhash64("text"), "number"))
    one = (
        again.join(signed, "number").join(own, ["of", "fingerprint"], "left_semi").withColumn("place", first).filter("place = 1")
    )
    return kept.unionByName(one.select(*[F.col("doc").getField(c).alias(c) for c in df.columns]))
