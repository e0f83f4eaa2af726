"""Fuzzy line de-duplication: MinHash over character shingles, banding, exact verification, union-find.

Lines are compared lower-cased and with single blanks; blank lines are left alone. Equal lines become one candidate
first. A line's signature has ``BANDS * ROWS`` MinHash values over its ``SHINGLE``-character shingles; two lines with a
Jaccard similarity of 0.8 share one of the 12 bands of 4 with a probability of 0.998 (0.9999 at 0.85). Lines that share
a band are verified on their shingle sets and united, and of each component one line stays.

Buckets are counted by an aggregate, never gathered: those of equal members, as the bands of near copies mostly are,
are verified once. A bucket of up to ``CELL`` lines is one cell. A larger one is first cut into chunks of that size, one
cell each; as the chunks differ from band to band, this unites groups of many near copies in time that is linear in
their size. Only large buckets that still hold several components then have their chunks compared with each other, and
there only lines of different components, so no pair is lost. A cell reports at most one link per line.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, combinations, count, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feira.llm.common import col, fresh, ship, small_batches, text_or_empty
from feira.llm.components import components, roots
from feira.llm.syncmers import _mers as run_hashes
from feira.session import materialize

SHINGLE = 10
BANDS, ROWS = 12, 4
SIMILARITY = 0.8
CELL = 256
#: Lines that a task remembers, so that it signs each of them once.
_SEEN = 200_000

_seeds = np.random.default_rng(97).integers(1, 2**32, (2, BANDS * ROWS), dtype=np.uint32)
_FACTORS, _ADDENDS = _seeds[0] | np.uint32(1), _seeds[1]


def normal(line: str) -> str:
    return " ".join(line.split()).lower()


#: White space besides blanks and line ends.
_ODD_SPACES = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]


def normal_lines(text: str) -> list[str]:
    """``normal`` of each line of a text; most lines have single blanks and nothing to join."""
    lines = text.lower().split("\n")
    if any(c in text for c in _ODD_SPACES):
        return [" ".join(line.split()) for line in lines]
    return [" ".join(line.split()) if "  " in line else line.strip(" ") for line in lines]


_SLICES = [slice(i, i + SHINGLE) for i in range(4096)]


def shingles(line: str) -> set[str]:
    n = max(1, len(line) - SHINGLE + 1)
    if n <= len(_SLICES):
        return set(map(line.__getitem__, _SLICES[:n]))
    return {line[i : i + SHINGLE] for i in range(n)}


def similarity(a: set[str], b: set[str]) -> float:
    common = len(a & b)
    return common / (len(a) + len(b) - common)


def _blocks(lines: list[str], most: int = 1 << 15) -> Iterator[slice]:
    """Consecutive lines of about ``most`` code points, so that the arrays over them stay in a core's cache."""
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)))
    start = done = 0
    while start < len(lines):
        stop = max(start + 1, int(np.searchsorted(ends, done + most, "right")))
        yield slice(start, stop)
        start, done = stop, int(ends[stop - 1])


def _shingled(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all lines, which places start a shingle, and each line's number of shingles, repeats included."""
    padded = [s.ljust(SHINGLE, "\0") for s in lines]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum(sizes)
    # Runs that reach into the next line are none of its shingles.
    inside = np.ones(len(codes), bool)
    for back in range(1, SHINGLE):
        inside[ends - back] = False
    return codes, inside[: len(codes) - SHINGLE + 1], sizes - SHINGLE + 1


def band_keys(lines: list[str]) -> np.ndarray:
    """One 64-bit key per line and band."""
    least = np.empty((len(lines), BANDS * ROWS), np.uint32)
    for block in _blocks(lines, 1 << 16):
        codes, inside, counts = _shingled(lines[block])
        hashes = run_hashes(codes, SHINGLE)[inside]
        starts = np.cumsum(counts) - counts
        mixed = np.empty_like(hashes)
        for i in range(BANDS * ROWS):
            np.multiply(hashes, _FACTORS[i], out=mixed)
            np.add(mixed, _ADDENDS[i], out=mixed)
            least[block, i] = np.minimum.reduceat(mixed, starts)
    keys = np.zeros((len(lines), BANDS), np.uint64)
    for row in range(ROWS):
        keys = (keys ^ least[:, row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys * np.uint64(2 * BANDS) + np.arange(BANDS, dtype=np.uint64)


def _digest(line: str) -> bytes:
    return hashlib.blake2b(line.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def occurrences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", number_col: str | None = None) -> DataFrame:
    """(id, number, line_no, h, bands, line) of every line that isn't blank.

    Bands and text are given where a task first meets a line; ``number`` is the row's own, if ``number_col`` names it.
    """
    number = col(number_col).cast("bigint") if number_col else F.lit(0).cast("bigint")
    work = df.select(col(id_col).alias("id"), number.alias("number"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for part in small_batches([batch], "text"):
                found = [normal_lines(text) for text in part.column("text").to_pylist()]
                counts = np.fromiter(map(len, found), np.int64, len(found))
                every = list(chain.from_iterable(found))
                filled = np.fromiter(map(bool, every), bool, len(every))
                if not filled.any():
                    continue
                owner = pa.array(np.repeat(np.arange(len(found), dtype=np.int32), counts)[filled])
                place_in_text = (np.arange(len(every)) - np.repeat(np.cumsum(counts) - counts, counts))[filled]
                every = list(filter(None, every))
                met = dict(zip(dict.fromkeys(every), count()))
                which = np.fromiter(map(met.__getitem__, every), np.int32, len(every))
                # Lines are numbered as they are met.
                first = np.append(True, which[1:] > np.maximum.accumulate(which)[:-1])
                digests = [_digest(line) for line in met]
                if len(seen) > _SEEN:
                    seen.clear()
                new = np.array([d not in seen for d in digests])
                seen.update(digests)
                lines = [line for line, n in zip(met, new.tolist(), strict=True) if n]
                at_new = np.cumsum(new, dtype=np.int32) - np.int32(1)
                signed = pa.array(at_new[which], mask=~(first & new[which]))
                keys = band_keys(lines).view(np.int64)
                ends = pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(owner),
                        part.column("number").take(owner),
                        pa.array(place_in_text, pa.int32()),
                        pa.array(digests, pa.binary()).take(pa.array(which)),
                        pa.ListArray.from_arrays(ends, pa.array(keys.ravel())).take(signed),
                        pa.array(lines, pa.string()).take(signed),
                    ],
                    ["id", "number", "line_no", "h", "bands", "line"],
                )

    kind = work.schema["id"].dataType.simpleString()
    shape = f"id {kind}, number bigint, line_no int, h binary, bands array<bigint>, line string"
    return work.mapInArrow(run, shape)


#: Bits of a shingle's hash; the others of a 64-bit number hold a line or pair, so that one plain sort orders both.
_HASH_BITS = np.uint64(44)
_BASE = 0xD6E8FEB86659FD93


def _runs(values: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``size`` values, by doubling."""
    power = lambda n: np.uint64(pow(_BASE, n, 1 << 64))
    now, out, done, width = values, None, 0, 1
    while True:
        if size & width:
            if out is None:
                out = now
            else:
                m = len(values) - done - width + 1
                out = out[:m] * power(width)
                out += now[done : done + m]
            done += width
        if done == size:
            return out
        m = len(values) - 2 * width + 1
        longer = now[:m] * power(width)
        longer += now[width : width + m]
        now, width = longer, 2 * width


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(line number, hash) of every distinct 44-bit shingle hash of each line, sorted."""
    owners, hashes, done = [], [], 0
    for block in _blocks(lines):
        codes, inside, counts = _shingled(lines[block])
        wide = codes.astype(np.uint64)
        # Spread first, so that sums of small code points do not meet by chance.
        wide = (wide ^ np.uint64(0x2545F4914F6CDD1D)) * np.uint64(0xFF51AFD7ED558CCD)
        wide ^= wide >> np.uint64(32)
        hashes.append(_runs(wide, SHINGLE)[inside])
        owners.append(np.repeat(np.arange(done, done + len(counts)), counts))
        done += len(counts)
    key = np.sort((np.concatenate(owners).astype(np.uint64) << _HASH_BITS) | (np.concatenate(hashes) >> (np.uint64(64) - _HASH_BITS)))
    key = key[np.append(True, key[1:] != key[:-1])]
    return (key >> _HASH_BITS).astype(np.int64), key & ((np.uint64(1) << _HASH_BITS) - np.uint64(1))


def _close(common: np.ndarray, a: np.ndarray, b: np.ndarray, least: float, same: Callable[[int], bool]) -> np.ndarray:
    """Whether pairs with ``common`` of ``a`` and ``b`` shingles reach the similarity; near the limit, where one chance
    collision of hashes would count, ``same`` decides on the shingles themselves."""
    found = common / (a + b - common) >= least
    for i in np.flatnonzero(np.abs(common - least * (a + b) / (1 + least)) <= 1):
        found[i] = same(int(i))
    return found


_PAIRS_UP_TO = 4
#: Cells of an incidence matrix, and shingles of the pairs that are compared at once.
_MATRIX = 1 << 20


def _cell_links(known: np.ndarray, lines: list[str], owner: np.ndarray, value: np.ndarray, size: np.ndarray, least: float) -> tuple:
    """Pairs (i, j) of one cell's lines that are similar enough, found by a product of their incidence matrix."""
    n = len(lines)
    distinct, place = np.unique(value, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    step = max(1, _MATRIX // n)
    for begin in range(0, len(distinct), step):
        here = (place >= begin) & (place < begin + step)
        held = np.zeros((n, min(step, len(distinct) - begin)), np.float32)
        held[owner[here], place[here] - begin] = 1
        common += held @ held.T
    i, j = np.nonzero(np.triu(common, 1))
    apart = (known[i] != known[j]) & (np.minimum(size[i], size[j]) >= least * np.maximum(size[i], size[j]))
    i, j = i[apart], j[apart]
    near = _close(
        common[i, j], size[i], size[j], least, lambda k: similarity(shingles(lines[i[k]]), shingles(lines[j[k]])) >= least
    )
    return i[near], j[near]


def _pair_links(
    first: np.ndarray, second: np.ndarray, lines: list[str], start: np.ndarray, value: np.ndarray, size: np.ndarray, least: float
) -> np.ndarray:
    """Which of many pairs of lines are similar enough, by counting equal neighbours in one sorted array."""
    sizes = np.stack([size[first], size[second]], axis=1).ravel()
    begins = np.stack([start[first], start[second]], axis=1).ravel()
    pair = np.repeat(np.arange(len(first)), size[first] + size[second])
    within = np.arange(len(pair)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    key = np.sort((pair.astype(np.uint64) << _HASH_BITS) | value[np.repeat(begins, sizes) + within])
    twice = key[1:][key[1:] == key[:-1]] >> _HASH_BITS
    common = np.bincount(twice.astype(np.int64), minlength=len(first))
    return _close(
        common,
        size[first],
        size[second],
        least,
        lambda k: similarity(shingles(lines[first[k]]), shingles(lines[second[k]])) >= least,
    )


def verified_links(cell: np.ndarray, known: np.ndarray, lines: list[str], least: float = SIMILARITY) -> np.ndarray:
    """For rows sorted by cell, the first row of each row's component within its cell.

    Two rows of a cell are linked if the Jaccard similarity of their shingle sets is ``least`` or more; rows of one
    ``known`` component are not compared, but united where another link needs them.
    """
    owner, value = shingle_hashes(lines)
    size = np.bincount(owner, minlength=len(lines))
    start = np.cumsum(size) - size
    bounds = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    sizes = np.diff(np.append(bounds, len(cell)))
    a, b = [], []
    for n in range(2, _PAIRS_UP_TO + 1):
        at = bounds[sizes == n]
        for i, j in combinations(range(n), 2):
            a.append(at + i)
            b.append(at + j)
    a, b = (np.concatenate(x).astype(np.int64) for x in (a, b))
    open_ = (known[a] != known[b]) & (np.minimum(size[a], size[b]) >= least * np.maximum(size[a], size[b]))
    a, b = a[open_], b[open_]
    if len(a):
        # In slices of pairs, so that the sorted arrays stay small.
        work = np.cumsum(size[a] + size[b])
        cuts = [0, *np.searchsorted(work, np.arange(_MATRIX, work[-1], _MATRIX)).tolist(), len(a)]
        near = [
            _pair_links(a[x:y], b[x:y], lines, start, value, size, least) for x, y in pairwise(cuts) if y > x
        ]
        near = np.concatenate(near)
        a, b = a[near], b[near]
    found = [(a, b)]
    for at, n in zip(bounds[sizes > _PAIRS_UP_TO], sizes[sizes > _PAIRS_UP_TO], strict=True):
        rows = slice(int(at), int(at + n))
        held = slice(int(start[at]), int(start[at + n - 1] + size[at + n - 1]))
        i, j = _cell_links(known[rows], lines[rows], owner[held] - at, value[held], size[rows], least)
        found.append((i + at, j + at))
    # Rows of one known component in one cell belong together.
    order = np.lexsort((known, cell))
    same = (cell[order[1:]] == cell[order[:-1]]) & (known[order[1:]] == known[order[:-1]])
    found.append((order[1:][same], order[:-1][same]))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return roots(len(lines), a, b)


def _verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of rows sorted by cell, one for each row that is not the first of its component in the cell."""
    for table in _cells(batches):
        keys = np.stack([table.column(k).to_numpy() for k in _CELL])
        cell = np.cumsum(np.append(True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)))
        node, known = table.column("node").to_numpy(), table.column("known").to_numpy()
        first = verified_links(cell, known, table.column("line").to_pylist())
        moved = np.flatnonzero(first != np.arange(len(first)))
        yield pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[first[moved]])], ["a", "b"])


_CELL = ("key", "left", "right")


def _cells(batches: Iterable[pa.RecordBatch], rows: int = 4_000, chars: int = 4_000_000) -> Iterator[pa.Table]:
    """Tables of some thousand rows or characters of the sorted input that end where a cell ends."""
    held: list[pa.RecordBatch] = []
    n = size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        for part in small_batches([batch], "line", chars):
            held.append(part)
            n += part.num_rows
            size += part.column("line").nbytes
            if n >= rows or size >= chars:
                table = pa.Table.from_batches(held)
                tail = np.ones(n, bool)
                for k in _CELL:
                    values = table.column(k).to_numpy()
                    tail &= values == values[-1]
                cut = n - int(tail.sum())
                if cut:
                    yield table.slice(0, cut)
                held, n = table.slice(cut).to_batches(), n - cut
                size = sum(x.column("line").nbytes for x in held) if n else 0
    if n:
        yield pa.Table.from_batches(held)


def _links(cells: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Verified links of cells (key, left, right, node, known)."""
    return materialize(
        cells.hint("merge").join(texts, "node")
        .repartition(*_CELL)
        .sortWithinPartitions(*_CELL, "node")
        .select(*_CELL, "node", "known", "line")
        .mapInArrow(_verify, "a bigint, b bigint"),
        name,
    )


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, mark) of an input sorted by key whose key stands in a neighbouring row with another mark, and the ends of
    the input, whose neighbours other tasks have. Of marks that share a key, each is there once at least. No more than a
    batch is held."""
    before: tuple[int, int] | None = None
    held: pa.RecordBatch | None = None
    first = True

    def flush(part: pa.RecordBatch, after: tuple[int, int] | None) -> pa.RecordBatch:
        nonlocal first
        key, mark = part.column("key").to_numpy(), part.column("mark").to_numpy()
        same = (key[1:] == key[:-1]) & (mark[1:] != mark[:-1])
        keep = np.append(False, same) | np.append(same, False)
        keep[0] |= first or (key[0] == before[0] and mark[0] != before[1])
        keep[-1] |= after is None or (key[-1] == after[0] and mark[-1] != after[1])
        first = False
        return part.filter(pa.array(keep))

    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            yield flush(held, (batch.column("key")[0].as_py(), batch.column("mark")[0].as_py()))
            before = held.column("key")[held.num_rows - 1].as_py(), held.column("mark")[held.num_rows - 1].as_py()
        held = batch
    if held is not None:
        yield flush(held, None)


def _members(found: DataFrame, distinct: DataFrame) -> DataFrame:
    """(key, node) of the lines that share a band's key with another line.

    The rows of all bands are dealt by ranges of key and mark, a 64-bit hash of the line, so that a hot key is split, and
    sorted by the key alone, a number that Spark sorts by its digits. All but a few rows have a key of their own, or share it
    with repeats of their line that other tasks signed, and end there. Of lines with one mark all are members.
    """
    mark = F.xxhash64("h").alias("mark")
    shared = materialize(
        found.filter("bands is not null")
        .select("bands", mark)
        .select(F.explode("bands").alias("key"), "mark")
        .repartitionByRange("key", "mark")
        .sortWithinPartitions("key")
        .mapInArrow(_shared, "key bigint, mark bigint"),
        "line-shared",
    )
    return materialize(
        shared.join(distinct.select(mark, "node").hint("merge"), "mark").groupBy("key", "node").agg(F.lit(1).alias("x")).select("key", "node"), "line-members"
    )


#: Links that a task unites at once.
_UNITED = 1 << 20


def _united(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the same components, from each node to the smallest that it is united with by links at hand."""
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        ends = np.concatenate([table.column("a").to_numpy(), table.column("b").to_numpy()])
        nodes, place = np.unique(ends, return_inverse=True)
        first = roots(len(nodes), place[: len(ends) // 2], place[len(ends) // 2 :])
        moved = np.flatnonzero(first != np.arange(len(nodes)))
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[first[moved]])], ["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= _UNITED:
            yield flush()
    if held:
        yield flush()


def _unite(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; what a task has of the links is united first, which spares rounds."""
    return components(links.mapInArrow(_united, "a bigint, b bigint"), "line-components")


def _class_links(members: DataFrame, texts: DataFrame, cell: int) -> DataFrame:
    """(node, component) of all lines that are linked with another."""
    # Buckets of the same lines, by count, ends and a sum over their members, are one bucket.
    buckets = (
        members.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("node").alias("low"),
            F.max("node").alias("high"),
            F.sum(F.xxhash64("node").bitwiseAND(F.lit((1 << 32) - 1))).alias("mark"),
        )
        .filter("n > 1")
        .groupBy("n", "low", "high", "mark")
        .agg(F.min("key").alias("key"))
    )
    chunks: Column = F.ceil(F.col("n") / cell).cast("int")
    placed = materialize(
        members.join(materialize(buckets.select("key", "n"), "line-buckets").hint("merge"), "key").select(
            "key", "node", chunks.alias("chunks"), F.pmod(F.xxhash64("node", "key"), chunks).cast("int").alias("chunk")
        ),
        "line-placed",
    )
    # Each line is there once on either side, so no key is hot.
    texts = materialize(texts.join(placed.select("node").distinct().hint("merge"), "node"), "line-texts", "zstd")
    own = placed.select("key", F.col("chunk").alias("left"), F.col("chunk").alias("right"), "node", F.col("node").alias("known"))
    links = _links(own, texts, "line-links")
    labels = _unite(links)
    large = placed.filter("chunks > 1")
    if large.isEmpty():
        return labels
    labels = materialize(labels, "line-labels")
    large = materialize(
        large.join(labels, "node", "left").select(
            "key", "node", "chunks", "chunk", F.coalesce("component", "node").alias("known")
        ),
        "line-large",
    )
    mixed = materialize(
        large.groupBy("key").agg(F.min("known").alias("low"), F.max("known").alias("high")).filter("low < high").select("key"),
        "line-mixed",
    )
    each = F.transform(
        F.sequence(F.lit(0), F.col("chunks") - 1),
        lambda i: F.struct(F.least(i, F.col("chunk")).alias("left"), F.greatest(i, F.col("chunk")).alias("right")),
    )
    pairs = large.join(mixed, "key").select("key", "node", "known", F.inline(each)).filter("left < right")
    more = _links(pairs, texts, "line-more-links")
    return _unite(labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))


def _classes(df: DataFrame, id_col: str, text_col: str, number_col: str | None, cell: int) -> DataFrame:
    ship(df.sparkSession)
    found = materialize(
        occurrences(df, id_col, text_col, number_col).withColumn("row", F.monotonically_increasing_id()),
        "line-occurrences",
        "zstd",
    )
    distinct = materialize(
        found.groupBy("h").agg(F.min("row").alias("node"), (F.count(F.lit(1)) > 1).alias("repeated")), "line-distinct"
    )
    # The first row of a line has its text. Tables that grow with the lines are merged at every size, so that what is
    # shuffled grows with them and not by leaps.
    texts = found.filter("line is not null").select(F.col("row").alias("node"), "line")
    nodes = materialize(found.select("id", "number", "line_no", "h", "row").join(distinct.hint("merge"), "h").drop("h"), "line-nodes")
    labels = materialize(_class_links(_members(found, distinct), texts, cell), "line-labels")
    classed = materialize(
        nodes.join(labels.hint("merge"), "node", "left")
        .withColumns(
            {"class_id": F.coalesce("component", "node"), "alone": F.col("component").isNull() & ~F.col("repeated")}
        )
        .drop("node", "component", "repeated"),
        "line-classed",
    )
    # A line that stands once and is linked with no other is its own class; only the others are grouped.
    keeper = F.struct("id", "line_no", "row")
    single = classed.filter("alone").select(
        *classed.columns, keeper.alias("keeper"), F.lit(1).cast("bigint").alias("class_size"), F.lit(True).alias("kept")
    )
    several = classed.filter("not alone")
    keepers = materialize(
        several.groupBy("class_id").agg(F.min(keeper).alias("keeper"), F.count(F.lit(1)).alias("class_size")), "line-keepers"
    )
    grouped = several.join(keepers.hint("merge"), "class_id").withColumn("kept", F.col("row") == F.col("keeper.row"))
    return single.unionByName(grouped).drop("alone")


def line_classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """One row per line that isn't blank: id, line_no (from 0), class_id, class_doc_id, class_line_no, class_size, kept.

    Lines of one class are connected by similarities of ``SIMILARITY`` or more. Its line with the smallest id and number
    stays, one of them if that repeats; null ids come first. Rows that repeat an id are rows of their own. Null and empty
    texts have no lines.
    """
    return _classes(df, id_col, text_col, None, cell).select(
        F.col("id").alias(id_col),
        "line_no",
        "class_id",
        F.col("keeper.id").alias("class_doc_id"),
        F.col("keeper.line_no").alias("class_line_no"),
        "class_size",
        "kept",
    )


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """``df`` with the lines that do not stay taken out of its texts.

    Lines are taken out of the very row they stand in, whatever ids repeat or are null: rows are written with a number of
    their own first. Blank lines stay. Texts without a line to take out, null ones included, are left as they are.
    """
    number, out = fresh(df, "__number"), "__out"
    rows = materialize(df.withColumn(number, F.monotonically_increasing_id()), "line-rows")
    out = fresh(rows, out)
    losers = _classes(rows, id_col, text_col, number, cell).filter("not kept")
    gone = materialize(
        losers.groupBy(F.col("number").alias(number)).agg(F.collect_set("line_no").alias(out)), "lines-gone"
    )
    joined = rows.join(gone, number, "left")
    lines = F.transform(
        F.split(col(text_col), "\n"), lambda line, i: F.when(~F.array_contains(col(out), i), line)
    )
    text = F.when(col(out).isNull(), col(text_col)).otherwise(F.concat_ws("\n", F.filter(lines, lambda x: x.isNotNull())))
    return joined.select(*[text.alias(c) if c.lower() == text_col.lower() else col(c) for c in df.columns])
