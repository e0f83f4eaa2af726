"""Embedding near-duplicates, ranked search and hard negatives against brute force, with odd rows of every kind."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import negatives, ranked, vectors

NAN, INF = float("nan"), float("inf")


def groups_by_brute_force(rows, limit=0.9):
    """(n_links, component_id, kept) per row of (id, vector)."""
    good = [
        i
        for i, (_, v) in enumerate(rows)
        if v and all(x is not None and math.isfinite(x) for x in v) and any(x != 0 for x in v)
    ]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    n = [0] * len(rows)
    scaled = {i: np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in scaled.items()}
    for place, i in enumerate(good):
        for j in good[place + 1 :]:
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= limit:
                n[i], n[j] = n[i] + 1, n[j] + 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (id_, _) in enumerate(rows):
        known = least.get(root(i))
        least[root(i)] = id_ if known is None else known if id_ is None else min(known, id_)
    out = []
    for i, (id_, _) in enumerate(rows):
        name = least[root(i)]
        out.append((id_, n[i], name, id_ is not None and id_ == name))
    return sorted(out, key=str)


def near(rng, v, cosine):
    """A vector at exactly this cosine from ``v``."""
    other = rng.standard_normal(len(v))
    v = v / np.linalg.norm(v)
    other -= (other @ v) * v
    return cosine * v + math.sqrt(1 - cosine * cosine) * other / np.linalg.norm(other)


def test_links_of_a_hot_group_of_chains_and_of_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(1000 + i, rng.standard_normal(32).tolist()) for i in range(250)]
    hot = rng.standard_normal(32)
    rows += [(2000 + i, near(rng, hot, 0.99).tolist()) for i in range(200)]
    # Wider than a ball, so that only a part of it is linked with another part.
    wide = rng.standard_normal(32)
    rows += [(3000 + i, near(rng, wide, 0.93).tolist()) for i in range(80)]
    chain = rng.standard_normal(32)
    for i in range(30):
        chain = near(rng, chain, 0.905)
        rows.append((900 - i, (chain * 10.0 ** (i - 15)).tolist()))
    rows += [(5000 + i, near(rng, chain, 0.899).tolist()) for i in range(20)]
    rows += [(1, None), (2, []), (3, [0.0] * 32), (4, [NAN] * 32), (5, [INF] * 32), (6, [None] * 32)]
    rows += [(7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1e300] * 32), (10, [1e-300] * 32)]
    rows += [(2000, rows[250][1]), (None, rows[251][1]), (None, None)]
    shape = "vec_id bigint, embedding array<double>, row string, ball string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], shape)
    found = sorted((tuple(r) for r in vectors.link_groups(df).collect()), key=str)
    assert found == groups_by_brute_force(rows)
    kept = vectors.near_dedup(df)
    assert kept.columns == df.columns
    names = {r[0] for r in groups_by_brute_force(rows) if r[3]}
    assert {r.vec_id for r in kept.collect() if r.vec_id is not None} == names
    assert kept.filter("vec_id is null").count() == 2


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert vectors.link_groups(df).collect() == []
    alone = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in vectors.link_groups(alone).collect()] == [(1, 0, 1, True)]


def test_the_calibrated_recall_is_reached_at_the_limit():
    """Pairs at a cosine of exactly 0.9, with the very directions that tasks use."""
    rng = np.random.default_rng(8)
    plan = vectors.calibrate(2_000)
    assert plan.recall >= vectors.RECALL
    left = rng.standard_normal((1500, 24))
    left /= np.linalg.norm(left, axis=1)[:, None]
    right = np.array([near(rng, v, 0.9) for v in left])
    met = np.zeros(len(left), int)
    for block in range(-(-plan.directions // 4096)):
        wide = min(4096, plan.directions - block * 4096)
        a, b = (x @ vectors.directions(24, block, 4096)[:, :wide] for x in (left, right))
        both = (np.abs(a) > plan.threshold) & (np.abs(b) > plan.threshold) & (np.abs(a - b) <= vectors.WINDOW)
        met += both.sum(axis=1)
    assert (met >= plan.count).mean() >= 0.998
    expected = plan.directions * vectors.collision_chance(0.9, plan.threshold)
    assert abs(met.mean() - expected) < 0.03 * expected


def test_balls_hold_only_linked_points():
    rng = np.random.default_rng(2)
    points = np.array([near(rng, np.ones(16), c) for c in rng.uniform(0.9, 1, 300)])
    most = math.acos(0.9) / 2
    first, balls = vectors.gather(points, np.zeros(300), most)
    for i, (centre, radius) in balls.items():
        members = points[first == i]
        assert radius <= most and (members @ members.T).min() >= 0.9 - 1e-9
        assert np.arccos(np.clip(members @ centre, -1, 1)).max() <= radius + 1e-9


TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ranking(docs, items, top=10):
    def terms(text):
        return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))

    held = [(id_, terms(text)) for id_, text in docs]
    n_docs, total = sum(1 for _, w in held if w), sum(len(w) for _, w in held)
    df = Counter(t for _, w in held for t in set(w))
    out = []
    for item, text in items:
        scores = []
        for place, (id_, w) in enumerate(held):
            tf = Counter(w)
            score = 0
            for t in terms(text):
                if tf[t]:
                    m = 100 - 75 + (75 * len(w) * n_docs) // total
                    part = (1_000_000_000 * tf[t]) // (1000 * tf[t] + 8 * m)
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * part
            if score > 0:
                scores.append((-score, id_ is None, id_ or 0, place, id_))
        out += [(item, i + 1, s[4], -s[0]) for i, s in enumerate(sorted(scores)[:top])]
    return sorted(out, key=str)


def test_ranked_search_with_odd_rows(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "é", "straße", "7", "数据"]
    docs = [
        (i, " ".join(vocabulary[k] for k in np.minimum(rng.zipf(1.4, int(rng.integers(1, 60))) - 1, 64))) for i in range(400)
    ]
    docs += [(400, None), (401, ""), (402, "-- !!"), (403, "W1 w1,W1.É数据"), (None, docs[5][1]), (7, docs[7][1])]
    docs += [(500 + i, "tie tie") for i in range(15)] + [(600, "long " * 300_000 + "w1")]
    items = [(i, docs[17 * i][1].upper() if i % 2 else docs[17 * i][1]) for i in range(20)]
    items += [(20, None), (21, "unheard of words"), (22, "tie"), (3, "w2 w2 w2 数据 É"), (None, "straße 7")]
    left = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id bigint, text string, row string, terms string")
    right = spark.createDataFrame([(*d, "x") for d in items], "item_id int, text string, query string")
    expected = ranking(docs, items)
    assert sorted((tuple(r) for r in ranked.search(left, right).collect()), key=str) == expected
    # Several blocks of queries and several passes over the texts.
    small = ranked.search(left, right, block_terms=60, pass_terms=120)
    assert sorted((tuple(r) for r in small.collect()), key=str) == expected


def test_ranked_search_without_anything(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert ranked.search(docs, items).collect() == []
    some = spark.createDataFrame([(1, None), (2, "c")], "doc_id bigint, text string")
    assert ranked.search(some, items).collect() == []
    assert ranked.search(some, items.limit(0)).collect() == []


def test_blocks_are_skipped_and_nothing_is_lost():
    """A shard of alike documents: most blocks fail their bound, and the best are those of a full scan."""
    rng = np.random.default_rng(4)
    topics = rng.integers(0, 40, 3000)
    matrix = np.zeros((3000, 240), np.int32)
    for i, topic in enumerate(topics):
        own = topic * 6 + rng.integers(0, 6, 4)
        matrix[i, own] = rng.integers(1, 100, 4)
        matrix[i, 0] = rng.integers(1, 10)
    terms = np.array([0, 6, 7, 8, 9, 12])
    query = ranked.Query(1, terms, np.array([1, 50, 40, 60, 30, 5], np.int64))
    shard = ranked.Shard(np.arange(3000), np.arange(3000), matrix, [terms] * 240)
    best = ranked.Best(10)
    opened, skipped = shard.search(query, best)
    full = matrix[:, terms].astype(np.int64) @ query.weights
    order = np.lexsort((np.arange(3000), -full))[:10]
    assert best.row.tolist() == order.tolist() and best.score.tolist() == full[order].tolist()
    assert skipped > opened


@pytest.mark.parametrize("piece", [1, 7, 1 << 20])
def test_terms_do_not_depend_on_pieces(monkeypatch, piece):
    monkeypatch.setattr(ranked, "_PIECE", piece)
    text = "Ab  c-d, É数据;x9\t\n" * 50
    assert [w.decode() for part in ranked.words(text.encode()) for w in part] == ["ab", "c", "d", "É数据", "x9"] * 50


def mined(rows, is_anchor):
    good = [
        (id_, label, [math.floor(256 * x) for x in v])
        for id_, v, label in rows
        if id_ is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (id_, label, v) in enumerate(good):
        if not is_anchor(id_):
            continue
        scored = defaultdict(list)
        for b, (other, theirs, w) in enumerate(good):
            if a != b and len(v) == len(w):
                scored[theirs == label].append((-sum(x * y for x, y in zip(v, w, strict=True)), other))
        for p, positive in sorted(scored[True])[:5]:
            fits = sorted(s for s in scored[False] if 80 * -p <= 100 * -s[0] <= 100 * -p)[:5]
            out += [(id_, positive, i + 1, n, -p, -s) for i, (s, n) in enumerate(fits)]
    return sorted(out)


def test_hard_negatives_with_odd_rows(spark):
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((6, 12))
    rows = []
    for i in range(700):
        v = centres[i % 6] * rng.choice([0.2, 1.0, 5.0]) + 0.3 * rng.standard_normal(12)
        rows.append((i, v.tolist(), int(rng.integers(0, 4))))
    rows += [(i, rows[3][1], i % 2) for i in range(700, 740)]
    rows += [(800, [0.0] * 12, 1), (805, [0.0] * 12, 1), (810, [0.0] * 12, 2)]
    rows += [(900, None, 1), (901, [1.0] * 12, None), (902, [NAN] * 12, 1), (903, [None] * 12, 1), (904, [INF] * 12, 1)]
    rows += [(905, [], 1), (906, [1.0, 2.0], 1), (910, [1.0, 2.0], 1), (911, [1.0, 1.9], 2), (None, [1.0] * 12, 1)]
    rows += [(20, rows[20][1], rows[20][2]), (1000, [3e5] * 12, 1), (1001, [3e5] * 12, 1), (1002, [2.9e5] * 12, 0)]
    shape = "vec_id bigint, embedding array<double>, label int, whole string, anchor string"
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], shape)
    expected = mined(rows, lambda i: i % 10 == 0)
    assert sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % 10 == 0).collect()) == expected
    # Several blocks of anchors.
    some = negatives.mine(df, F.col("vec_id") % 10 == 0, anchors=16)
    assert sorted(tuple(r) for r in some.collect()) == expected


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert negatives.mine(df, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(100, [1.0], 1)], "vec_id bigint, embedding array<float>, label int")
    assert negatives.mine(alone, F.col("vec_id") % 100 == 0).collect() == []


def test_focus_ranges_lose_no_row_and_leave_some_out():
    rng = np.random.default_rng(9)
    whole = np.floor(256 * rng.standard_normal((3000, 16))).astype(np.int64)
    made = negatives.buckets(np.arange(3000), np.arange(3000), np.zeros(3000, np.int64), whole)
    assert sum(len(b.row) for b in made) == 3000
    left_out = 0
    for bucket in made:
        anchor = bucket.whole[0].astype(float)
        unit = anchor / np.linalg.norm(anchor)
        focus = np.argsort(-np.abs(unit))[: negatives.FOCUS]
        lengths = np.linalg.norm(bucket.whole.astype(float), axis=1)
        cosine = bucket.whole @ unit / lengths
        for needed in (-0.5, 0.0, 0.3, 0.8, 0.99):
            at = negatives.feasible(bucket, unit, focus, needed)
            assert set(np.flatnonzero(cosine >= needed)) <= set(at)
            left_out += len(bucket.row) - len(at)
    assert left_out > 3000
