"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from feira.llm import chat, exact, html, langid, lines, mixing, packing, pii, queries, simhash, syncmers
from feira.llm.components import components, roots
from feira.llm.tokens import WordTokenizer

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, size int, fp string, "
    "component string, `h` int, score string, `a.b` int, copies string, found int, html string, kept string, "
    "gone int, keep int, number int, line string, node int, place int"
)
LONG = "the long text of the house and the garden " * 20_000
ROWS = [
    (1, "the house of the rising sun is in the town", "en", "a"),
    (1, "the house of the rising sun is in the town", "en", "a"),
    (2, "THE house of the rising sun is in the town", "en", None),
    (3, None, None, "b"),
    (4, "", "en", "b"),
    (5, " \n\t \n", "de", ""),
    (6, LONG, "en", "a"),
    (None, "der mann und die frau sind in dem haus", "de", "c"),
    (None, None, "de", "c"),
    (7, "x", None, "c"),
    (8, "12 34 !!", "de", "a"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rest = [0, "dig", 7, "fp", "c", 1, "s", 2, "copies", 3, "<p>the page of the man and the woman in the house</p>", "k", 4, 5, 6, "l", 8, 9]
    return spark.createDataFrame([(*r, *rest) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def test_exact(odd, none):
    rows = exact.duplicate_groups(odd).collect()
    assert len(rows) == len(ROWS) and sum(r.kept for r in rows) == 7
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id in (1, 2)} == {(2, 3)}
    assert {(r.keep_id, r.group_size) for r in rows if r.doc_id in (3, 4)} == {(4, 3)}
    kept = exact.exact_dedup(odd)
    assert kept.columns == odd.columns
    assert Counter(r.doc_id for r in kept.collect()) == {2: 1, 4: 1, 5: 1, 6: 1, 7: 1, 8: 1, None: 1}
    assert exact.exact_dedup(none).count() == exact.duplicate_groups(none).count() == 0


def test_exact_groups_that_are_not_heavy(odd, monkeypatch):
    expected = Counter(r.doc_id for r in exact.exact_dedup(odd).collect())
    groups = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.duplicate_groups(odd).collect())
    monkeypatch.setattr(exact, "HEAVY_SHARE", 0.99)
    twice = odd.unionByName(odd)
    assert exact.heavy_winners(odd.selectExpr("doc_id id", "cast(text as binary) digest", "0 row")).count() == 0
    assert Counter(r.doc_id for r in exact.exact_dedup(odd).collect()) == expected
    assert Counter(r.doc_id for r in exact.exact_dedup(twice).collect()) == expected
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.duplicate_groups(odd).collect()) == groups


def test_exact_repeats_of_one_row(odd):
    same = odd.filter("doc_id = 1")
    assert exact.exact_dedup(same).count() == 1
    assert sorted(r.kept for r in exact.duplicate_groups(same).collect()) == [False, True]


def test_misra_gries_keeps_heavy_keys():
    stream = [i % 7 if i % 3 else "hot" for i in range(3000)]
    counters = {}
    for begin in range(0, 3000, 100):
        counters = exact.merge_counters(counters, Counter(stream[begin : begin + 100]).items(), 4)
    assert len(counters) <= 4 and 1000 - 3000 / 5 <= counters["hot"] <= 1000


def test_mixing(odd, none):
    rows = mixing.mixing_plan(odd).collect()
    assert len(rows) == len(ROWS)
    sizes = {None: 10, "a": 10 + 10 + 180_000 + 3, "b": 0, "": 0, "c": 10}
    assert {(r.source, r.source_size) for r in rows} == set(sizes.items())
    assert all(r.target <= 3 * r.source_size and r.taken <= 3 * r.size for r in rows)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and mixed.count() == sum(r.copies for r in rows)
    assert mixing.mix(none).count() == mixing.mixing_plan(none).count() == 0


def test_packing(odd, none):
    rows = packing.pack(odd, queries.TOKENIZER).collect()
    tokens = Counter(r.doc_id for r in rows if r.start == 0)
    assert tokens == Counter(r[0] for r in ROWS)
    assert sum(r.length for r in rows if r.doc_id in (3, 4, 5)) == 3
    assert packing.pack(none, queries.TOKENIZER).count() == 0
    with_ids = packing.pack(odd, queries.TOKENIZER, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length for r in with_ids)


def test_packing_merges_in_rounds(spark):
    many = spark.range(3000).selectExpr("id doc_id", "repeat('word ', cast(id % 90 as int)) text").repartition(40)
    rows = packing.pack(many, queries.TOKENIZER, window=256, most_open=2, least_cut=8).collect()
    assert sum(r.length for r in rows) == sum(i % 90 + 1 for i in range(3000))
    ends = {}
    for r in rows:
        ends[r.sequence_id] = max(ends.get(r.sequence_id, 0), r.offset + r.length)
    assert sum(0 if e & (e - 1) == 0 else 256 - e for e in ends.values()) < 0.04 * sum(r.length for r in rows)
    assert max(ends.values()) <= 256 and max(r.sequence_id >> 56 for r in rows) >= 1


def test_word_tokenizer_equals_the_library():
    encoder = WordTokenizer(queries.TOKENIZER, limit=50)
    texts = [
        "", "  ", "É É é x", "don't!'s ,'s it's", "a≮b   x y", "<|endoftext|> hi <|startoftext|>x", "A.B,C;d'e \x1c z",
        "ı İ ß ǅ 日本語 123 4a5", "á ≮", "x'", "'", "a'S I'LL we'Re", "a" * 9000 + " " + "b" * 5000, *[f"w{i} q{i}z" for i in range(99)],
    ]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(texts), strict=True):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_simhash(odd, none):
    rows = simhash.near_groups(odd).collect()
    assert len(rows) == len(ROWS)
    assert {r.component_id for r in rows if r.doc_id in (1, 2)} == {1}
    assert {(r.fingerprint, r.component_id) for r in rows if r.doc_id in (3, 4, 5)} == {("0" * 16, 3)}
    near = simhash.near_dedup(odd)
    assert near.columns == odd.columns
    assert Counter(r.doc_id for r in near.collect()) == {1: 1, 3: 1, 6: 1, 7: 1, 8: 1, None: 2}
    assert simhash.near_dedup(none).count() == simhash.near_groups(none).count() == 0


def test_near_copies_that_share_an_id(spark):
    a, b = "one two three four five six", "other words that nobody else has written"
    rows = [(1, a), (5, a), (5, b), (5, b), (7, b), (None, a), (9, None), (9, ""), (9, a)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id int, text string, `of` int, `__of` string")
    kept = simhash.near_dedup(df)
    assert kept.columns == df.columns
    found = Counter((r.doc_id, r.text or "") for r in kept.collect())
    assert found == {(1, a): 1, (5, b): 1, (None, a): 1, (9, ""): 1}


def test_bit_sliced_comparison():
    rng = np.random.default_rng(1)
    for size in (1, 12, 200):
        fps = np.repeat(rng.integers(0, 2**63, 5, dtype=np.uint64), size)
        for k in range(len(fps)):
            for bit in rng.integers(0, 64, rng.integers(0, 4)):
                fps[k] ^= np.uint64(1) << np.uint64(bit)
        group = np.sort(rng.integers(0, 2, len(fps)))
        found = [p for a, b in simhash.close_pairs(fps, group) for p in zip(a.tolist(), b.tolist(), strict=True)]
        n = range(len(fps))
        same = {(i, j) for i in n for j in range(i + 1, len(fps)) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= 2}
        assert set(found) == same and len(found) == len(same)


def test_hot_bucket_is_cut_into_cells(spark):
    """All fingerprints of one bucket: a small cell size must not lose a link."""
    words = [f"w{i}" for i in range(400)]
    texts = [(k, " ".join(w if j != k else "changed" for j, w in enumerate(words))) for k in range(60)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    whole = {r.doc_id: r.component_id for r in simhash.near_groups(df).collect()}
    assert {r.doc_id: r.component_id for r in simhash.near_groups(df, cell=4).collect()} == whole
    assert len(set(whole.values())) < 60


def test_components(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 200)]
    found = components(spark.createDataFrame([*path, *star, (7, 7), (201, 200)], "a bigint, b bigint")).collect()
    expected = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 200)} | {200: 200, 201: 200}
    assert {r.node: r.component for r in found} == expected and len(found) == len(expected)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert roots(5, np.array([4, 1]), np.array([3, 0])).tolist() == [0, 0, 2, 3, 3]


def test_fuzzy_lines(odd, none):
    rows = lines.line_classes(odd).collect()
    assert Counter(r.doc_id for r in rows) == {1: 2, 2: 1, 6: 1, None: 1, 7: 1, 8: 1}
    assert sum(r.kept for r in rows) == 5 and {r.class_size for r in rows if r.doc_id in (1, 2)} == {3}
    assert lines.dedup_lines(odd).columns == odd.columns and lines.dedup_lines(odd).count() == len(ROWS)
    assert lines.line_classes(none).count() == lines.dedup_lines(none).count() == 0


def test_fuzzy_lines_near_copies(spark):
    base = "a line of some length that is copied with a small change at one place or another of it, number {}"
    texts = [(i, f"{base.format(i % 10)}\nonly in {i} {'z' * i}") for i in range(30)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    rows = lines.line_classes(df, cell=4).collect()
    assert {(r.class_doc_id, r.class_size) for r in rows if r.line_no == 0} == {(0, 30)}
    kept = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    assert "a line" in kept[0] and not any("a line" in kept[i] for i in range(1, 30))


def test_language(odd, none, spark):
    model = langid.fit(odd)
    found = langid.predict(odd, model)
    rows = found.collect()
    assert len(rows) == len(ROWS) and [c for c in odd.columns if c != "score"] == found.columns[:-3]
    assert all(r.lang_pred == "und" and r.score == 0 and r.rejected for r in rows if r.text in (None, "", " \n\t \n", "12 34 !!"))
    assert langid.keep_known(odd).columns == odd.columns
    assert langid.keep_known(none).count() == 0 and langid.fit(none).predict("text") == ("und", 0.0)
    assert langid.keep_known(odd.withColumn("lang", odd.lang.substr(9, 1)).limit(3)).count() >= 0


def test_syncmers(odd, none, spark):
    rows = syncmers.edited_likeness(odd).collect()
    assert len(rows) == len(ROWS) and Counter(r.doc_id for r in rows) == Counter(r[0] for r in ROWS)
    assert {r.fingerprint for r in rows if r.doc_id in (3, 4)} == {""}
    assert len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert syncmers.edited_likeness(none).count() == 0
    one = syncmers.edited_likeness(odd.filter("doc_id = 6")).first()
    assert one.near_next == 1.0 and one.n_chars == len(LONG)
    stored = {r.doc_id: r.fingerprint for r in syncmers.anchor_rows(odd).collect() if r.doc_id is not None}
    assert stored == {r.doc_id: r.fingerprint for r in rows if r.doc_id is not None}
    named = odd.withColumn("doc_id", F.format_string("doc %03d", "doc_id")).filter("doc_id not like '%null%'")
    told = {r.doc_id: (r.edited_sha256, r.near_next) for r in syncmers.edited_likeness(named).collect()}
    plain = syncmers.edited_likeness(odd.filter("doc_id is not null")).collect()
    assert told == {f"doc {r.doc_id:03d}": (r.edited_sha256, r.near_next) for r in plain}
    base = "it was the best of times, it was the worst of times, it was the age of wisdom"
    at, hashes = syncmers.anchors(base)
    moved, moved_hashes = syncmers.anchors("prefix " + base)
    assert set(zip((at + 7).tolist(), hashes.tolist(), strict=True)) <= set(zip(moved.tolist(), moved_hashes.tolist(), strict=True))
    for n in range(60):
        assert (len(syncmers.anchors(base[:n])[1]) > 0) == (n > 0)


def test_main_text(odd, none):
    found = html.extract(odd)
    assert {r.text for r in found.collect()} == {"the page of the man and the woman in the house"}
    assert "html" not in found.columns and html.extract(none).count() == 0
    assert {r.text for r in html.extract(odd.drop("html").withColumnRenamed("text", "html")).collect()} >= {""}


def test_chat(spark):
    schema = "conv_id bigint, turn bigint, role string, text string, formatted string, n_turns int"
    turns = [(1, None, "user", None, "f", 1), (1, 2, "assistant", "hi", "f", 1), (1, 2, "assistant", "hi", "f", 1)]
    turns += [(None, 0, None, LONG, "f", 1), (2, 0, "tool", "", "f", 1)]
    df = spark.createDataFrame(turns, schema)
    rows = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(df)).collect()}
    assert {k: r.n_turns for k, r in rows.items()} == {1: 3, None: 1, 2: 1}
    assert rows[1].loss_chars == 4 and rows[2].loss_chars == 0
    assert chat.conversation_digests(chat.format_conversations(df.limit(0))).count() == 0


def test_pseudonyms(odd, none, spark):
    found = pii.pseudonymise_text(odd, b"k")
    assert sorted(found.columns) == sorted(odd.columns) and found.count() == len(ROWS)
    assert all(r.found == [] for r in found.collect()) and pii.pseudonymise_text(none, b"k").count() == 0
    key = b"key"
    values = {
        pii.card: "4417 7442 8035 1547", pii.ip: "97.51.17.173", pii.phone: "+1 (017) 555-7713", pii.ssn: "123-45-6789",
        pii.date: "2001-02-28", pii.email: "für.34@mail7.example.com", pii.iban: "DE89 3704 0044 0532 0130 00",
        pii.secret: "04dbebab91ab85687d33eeaaf9ac699e1188f962",
    }
    for change, value in values.items():
        other = change(key, value)
        assert other != value and len(other) == len(value) or change is pii.ip
        assert change(key, other, True) == value and change(b"other", value) != other
    for size in (1, 2, 3, 10, 97):
        moved = [pii.permute(key, "t", size, i) for i in range(size)]
        assert sorted(moved) == list(range(size)) and [pii.permute(key, "t", size, m, True) for m in moved] == list(range(size))
    text = "pay 4417744280351547, not 4417744280351548 or 1234; mail a.b@c.example.org on 2001-02-30 or 2001-02-28."
    new, spans = pii.pseudonymise(text, key)
    assert [k for k, _, _ in spans] == ["card", "email", "date"]
    assert all(pii.pseudonymise(new[a:b], key)[1] for _, a, b in spans)
    assert "4417744280351548 or 1234" in new and "2001-02-30" in new


def test_pseudonyms_between_other_numbers():
    """A card or account number is found, and changed as if alone, whatever numbers and codes stand beside it."""
    key = b"key"
    for value in ("4417744280351547", "4417 7442 8035 1547", "4417-7442-8035-1547", "3782 822463 10005"):
        expected = pii.card(key, value)
        for n in range(300):
            for text in (f"{value} {n}/27", f"{n} {value}", f"{n} {value} {n + 7}", f"{value}  {n}.50", f"{n}-{value}-{n}"):
                new, spans = pii.pseudonymise(text, key)
                assert new == text.replace(value, expected) and [k for k, _, _ in spans] == ["card"], text
    two = "4417744280351547 4417 7442 8035 1547 123"
    assert pii.pseudonymise(two, key)[0] == f"{pii.card(key, two[:16])} {pii.card(key, two[17:36])} 123"
    for value in ("BE68 5390 0754 7034", "BE68539007547034", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"):
        for text in (f"{value} EUR", f"{value} EUR 100", f"IBAN {value} BIC 12", f"A1 {value} 4417744280351547", f"AB12 {value}"):
            new, spans = pii.pseudonymise(text, key)
            assert pii.iban(key, value) in new and value not in new, text
            assert [k for k, _, _ in spans] == ["iban", "card"][: len(spans)] and len(spans) == 1 + ("4417" in text)
    # Neither a card whose check digit is wrong nor a date and a number beside each other become a card.
    kept = "4417744280351548 12 and 4417 7442 8035 1548/9"
    assert pii.pseudonymise(kept, key) == (kept, [])
    for day in range(1, 29):
        spans = pii.pseudonymise(f"2001-02-{day:02d} 123-45-6789", key)[1]
        assert [k for k, _, _ in spans] == ["date", "ssn"]
