"""Fuzzy lines: verification of cells, large buckets and odd rows against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from feira.llm import lines


def classes(rows):
    """Sorted (id, line_no, class size, kept) by comparing all pairs of lines."""
    found = [(id_, no, place) for place, (id_, text) in enumerate(rows) for no in range(len((text or "").split("\n")))]
    text_of = {(place, no): lines.normal((rows[place][1] or "").split("\n")[no]) for _, no, place in found}
    found = [f for f in found if text_of[f[2], f[1]]]
    texts = sorted(set(text_of.values()) - {""})
    name = {t: t for t in texts}

    def root(t):
        while name[t] != t:
            t = name[t]
        return t

    sets = {t: lines.shingles(t) for t in texts}
    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            if lines.similarity(sets[a], sets[b]) >= 0.8:
                name[root(b)] = root(a)
    members = defaultdict(list)
    for id_, no, place in found:
        members[root(text_of[place, no])].append((id_ is not None, id_ or 0, no, place))
    out = []
    for group in members.values():
        keeper = min(group)
        out += [(m[1] if m[0] else None, m[2], len(group), m == keeper) for m in group]
    return out


def varied(rng, line, changes):
    line = list(line)
    for _ in range(changes):
        line[rng.randrange(len(line))] = rng.choice("abcdefgh")
    return "".join(line)


def corpus(seed=1):
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abcdefghij klmnop") for _ in range(rng.randint(15, 160))).strip() for _ in range(25)]
    rows = []
    for i in range(120):
        own = [varied(rng, rng.choice(bases), rng.randint(0, 2)) for _ in range(rng.randint(0, 4))]
        rows.append((i, "\n".join(own)))
    # A chain whose ends are far apart, in few buckets.
    line = "".join(rng.choice("abcdefghijklmnop") for _ in range(200))
    for i in range(40):
        line = varied(rng, line, 1)
        rows.append((1000 + i, line.upper() if i % 2 else f"  {line}\n\n{bases[0]}"))
    return rows


@pytest.mark.parametrize("cell", [3, 256])
def test_classes_equal_brute_force(spark, cell):
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = [(r.doc_id, r.line_no, r.class_size, r.kept) for r in lines.line_classes(df, cell=cell).collect()]
    assert sorted(found) == sorted(classes(rows))


def test_no_line_is_lost_where_ids_repeat_or_are_null(spark):
    rows = [
        (1, "alpha line that is only here"),
        (1, "alpha line that is only here"),
        (2, "first line of the pair\nsecond line of the pair, a longer one"),
        (2, "second line of the pair, a longer one\na third that stands nowhere else"),
        (None, "null ids have lines too\nand more than one"),
        (None, "null ids have lines too\nand others"),
        (3, None),
        (4, ""),
        (5, "\n\nalpha line that is only here\n"),
    ]
    shape = "doc_id bigint, text string, gone array<int>, `__number` int, `__out` string, h string, number int, line string"
    df = spark.createDataFrame([(*r, [1], 2, "c", "d", 3, "e") for r in rows], shape)
    kept = lines.dedup_lines(df)
    assert kept.columns == df.columns and kept.count() == len(rows)
    texts = defaultdict(list)
    for r in kept.collect():
        assert (r.gone, r["__number"], r["__out"], r.h, r.number, r.line) == ([1], 2, "c", "d", 3, "e")
        texts[r.doc_id].append(r.text)
    held = [x for found in texts.values() for t in found for x in (t or "").split("\n") if x]
    assert sorted(held) == sorted({x for _, t in rows for x in (t or "").split("\n") if x})
    assert texts[3] == [None] and texts[4] == [""] and texts[5] == ["\n\n"]
    assert sorted(texts[1]) == ["", "alpha line that is only here"]


@pytest.mark.parametrize("size", [2, 3, 4, 5, 30])
def test_cells_of_every_size(size):
    rng = random.Random(size)
    base = ["".join(rng.choice("abcdef ") for _ in range(60)) for _ in range(3)]
    cells, texts = [], []
    for cell in range(40):
        cells += [cell] * size
        texts += [lines.normal(varied(rng, rng.choice(base), rng.randint(0, 3))) or "x" for _ in range(size)]
    known = np.array([rng.randrange(6) for _ in cells]) + 10 * np.array(cells)
    first = lines.verified_links(np.array(cells), known, texts)
    for cell in range(40):
        rows = [i for i, c in enumerate(cells) if c == cell]
        name = {i: i for i in rows}

        def root(i, name=name):
            while name[i] != i:
                i = name[i]
            return i

        for x, i in enumerate(rows):
            for j in rows[x + 1 :]:
                close = lines.similarity(lines.shingles(texts[i]), lines.shingles(texts[j])) >= 0.8
                if close or known[i] == known[j]:
                    a, b = sorted((root(i), root(j)))
                    name[b] = a
        assert [first[i] for i in rows] == [root(i) for i in rows]


def test_matrices_of_long_lines_are_cut(monkeypatch):
    monkeypatch.setattr(lines, "_MATRIX", 5000)
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(3000))
    texts = [varied(rng, base, 5) for _ in range(8)] + ["".join(rng.choice("qrstuv") for _ in range(2900))]
    zero = np.zeros(9, np.int64)
    assert lines.verified_links(zero, np.arange(9), texts).tolist() == [0] * 8 + [8]
    # The same as pairs, in slices.
    cells = np.repeat(np.arange(4), 2)
    assert lines.verified_links(cells, np.arange(8), texts[:8]).tolist() == [0, 0, 2, 2, 4, 4, 6, 6]


def test_lines_of_a_text_are_those_of_each_line():
    rng = random.Random(8)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    for alphabet in (spaces + list("aΣσAİb’'.:\xad\n\n"), list("aΣbCİ\n  ")):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12)))
            assert lines.normal_lines(text) == [lines.normal(x) for x in text.split("\n")]


def test_lines_that_stand_alone_are_not_grouped(spark, monkeypatch):
    written = {}

    def kept(df, name, *rest):
        written[name] = materialize(df, name, *rest)
        return written[name]

    materialize = lines.materialize
    monkeypatch.setattr(lines, "materialize", kept)
    rng = random.Random(9)
    texts = ["".join(rng.choice("abcdefghijklmnop") for _ in range(60)) for _ in range(50)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(90, texts[0]), (91, varied(rng, texts[1], 1)), (None, texts[2])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [(r.doc_id, r.line_no, r.class_size, r.kept) for r in lines.line_classes(df).collect()]
    assert sorted(found, key=str) == sorted(classes(rows), key=str)
    # Of 53 lines, those of three classes of two, or of two where the changed line is no longer like its own.
    assert written["line-keepers"].count() == sum(n == 2 for _, _, n, _ in found) / 2 and written["line-classed"].count() == 53


def test_repeats_of_a_line_alone_share_no_band():
    rng = random.Random(10)
    pairs = [(key, rng.choice([key, key, key + 1000])) for key in range(200) for _ in range(rng.randint(1, 6))]
    batches = []
    for at in range(0, len(pairs), 7):
        key, mark = zip(*pairs[at : at + 7])
        batches.append(pa.RecordBatch.from_pydict({"key": pa.array(key, pa.int64()), "mark": pa.array(mark, pa.int64())}))
    marks = defaultdict(set)
    for key, mark in pairs:
        marks[key].add(mark)
    wanted = {(key, mark) for key, mark in pairs if len(marks[key]) > 1}
    found = {(r["key"], r["mark"]) for part in lines._shared(iter(batches)) for r in part.to_pylist()}
    assert wanted <= found <= wanted | {pairs[0], pairs[-1]} and len(wanted) > 20


def test_links_at_hand_are_united_to_stars(monkeypatch):
    monkeypatch.setattr(lines, "_UNITED", 60)
    rng = random.Random(11)
    links = [(a, a + 1) for a in range(100, 300) if a % 40] + [(7, 7)]
    rng.shuffle(links)
    batches = [
        pa.RecordBatch.from_pydict({c: pa.array([x[i] for x in links[at : at + 20]], pa.int64()) for i, c in enumerate("ab")})
        for at in range(0, len(links), 20)
    ]
    found = [(r["a"], r["b"]) for part in lines._united(iter(batches)) for r in part.to_pylist()]
    assert all(a > b for a, b in found) and len(found) <= len(links)
    ends = np.array(found).T
    assert (lines.roots(301, *ends) == lines.roots(301, *np.array(links).T)).all()
