"""The registered corpus queries against SQL or plain Python over the smallest tables, and the pipeline's stages."""

import hashlib
import math
import random
import time
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import xxhash
from conftest import SF

import corpus_pipeline
from feira.llm import chat, html, langid, lines, packing, queries, simhash, syncmers


def shown(value):
    if isinstance(value, float):
        return "NULL" if math.isnan(value) else repr(value)
    return "NULL" if value is None else str(value)


@pytest.fixture(scope="module")
def documents():
    connection = duckdb.connect()
    names = ["doc_id", "text", "lang", "source"]
    found = connection.execute(f"select {', '.join(names)} from '{SF}/documents.parquet' order by doc_id").fetchall()
    return [dict(zip(names, r, strict=True)) for r in found]


def near_classes(texts: dict) -> dict:
    """Component per id by comparing all pairs of fingerprints."""

    def slow(text):
        words = (text or "").encode().lower().split()
        parts = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
        return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))

    fps = {k: slow(t) for k, t in texts.items()}
    name = {k: k for k in fps}

    def root(k):
        while name[k] != k:
            k = name[k]
        return k

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if bin(fps[a] ^ fps[b]).count("1") <= 2:
                x, y = sorted((root(a), root(b)))
                name[y] = x
    return {k: (f"{fps[k]:016x}", root(k)) for k in ids}


def test_no_query_is_left_out():
    assert [int(n.split("_")[0][2:]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_against_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        engine.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    found = engine.execute(queries.SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    expected = sorted(tuple(shown(r[columns.index(c)]) for c in order) for r in found.fetchall())
    assert sorted(tuple(shown(r[c]) for c in order) for r in df.collect()) == expected


def test_syncmers(spark, documents):
    rows = {r.doc_id: r for r in queries.op1_syncmers(spark, SF).collect()}
    assert len(rows) == len(documents)
    for i, d in enumerate(documents):
        text, following = d["text"], documents[(i + 1) % len(documents)]["text"]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = rows[d["doc_id"]]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        sets = [set(syncmers.anchors(t)[1].tolist()) for t in (text, edited, following)]
        after = rows[documents[(i + 1) % len(documents)]["doc_id"]].fingerprint
        for found, other, told in ((row.near_edited, sets[1], row.edited_fingerprint), (row.near_next, sets[2], after)):
            exact = len(sets[0] & other) / len(sets[0] | other)
            assert abs(found - exact) < 1e-12 and found == syncmers.likeness(row.fingerprint, told)
    same = defaultdict(set)
    for d in documents:
        same[d["text"]].add(rows[d["doc_id"]].fingerprint)
    assert all(len(v) == 1 for v in same.values())


def test_syncmers_of_long_texts(spark, documents):
    """All anchors of a text are compared, however long it is."""
    rows = {r.doc_id: r for r in queries.op1_syncmers(spark, SF).collect()}
    for i, d in enumerate(documents):
        text, following = d["text"], documents[(i + 1) % len(documents)]["text"]
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        own, copy, after = (set(syncmers.anchors(t)[1].tolist()) for t in (text, edited, following))
        assert abs(rows[d["doc_id"]].near_edited - len(own & copy) / len(own | copy)) < 1e-12
        assert abs(rows[d["doc_id"]].near_next - len(own & after) / len(own | after)) < 1e-12
        at, hashes = syncmers.anchors(text)
        width = syncmers.K if len(text) >= syncmers.K else len(text)
        covered = {j for p, h in zip(at.tolist(), hashes.tolist(), strict=True) if h in after for j in range(p, p + width)}
        assert rows[d["doc_id"]].shared_next == len(covered)
    draw = random.Random(1)
    long = ["".join(draw.choices("abcdefghijklmnop ", k=128_000)) for _ in range(2)]
    passage = "".join(draw.choices("qrstuvwxyz ", k=300))
    one, two = (t[:n] + passage + t[n:] for t, n in zip(long, (90_000, 40_000), strict=True))
    changed = one.replace(one[70_000:70_008], "another", 1)
    df = spark.createDataFrame([(1, one), (2, two), (3, one), (4, changed)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in syncmers.edited_likeness(df).collect()}
    assert 0 < found[1].near_next < 0.01 and 280 <= found[1].longest_next <= 302 and found[1].shared_next < 400
    assert found[3].fingerprint == found[1].fingerprint != found[4].fingerprint
    assert 0.999 < found[3].near_next < 1 and len(one) - 60 < found[3].shared_next < len(one)
    starts, lengths, there = syncmers.shared_passages(one, syncmers.anchors(one), syncmers.anchors(two))
    start, length, place = max(zip(starts.tolist(), lengths.tolist(), there.tolist(), strict=True), key=lambda p: p[1])
    assert one[start : start + length] == two[place : place + length] and 0 <= start - 90_000 < 10
    short = syncmers.anchors("tiny")
    assert [x.tolist() for x in syncmers.shared_passages("tiny", short, short)] == [[0], [4], [0]]
    assert not len(syncmers.shared_passages("", syncmers.anchors(""), short)[0])


def test_main_text(spark):
    """The article element holds the main text of these pages."""
    import html as entities
    import re

    pages = dict(duckdb.connect().execute(f"select page_id, html from '{SF}/pages.parquet'").fetchall())
    rows = queries.op2_main_text(spark, SF).collect()
    assert {r.page_id for r in rows} == set(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)(?:</article>|$)", pages[r.page_id], re.DOTALL)
        plain = entities.unescape(re.sub("<[^>]*>", " ", article[1])) if article else ""
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)


def check_packing(rows, texts: list[tuple]):
    """Every id of every text in exactly one piece; gapless sequences."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    expected, found = Counter(), defaultdict(list)
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        expected[doc_id, len(ids)] += 1
        data = b"".join(i.to_bytes(4, "little") for i in ids)
        for r in (r for r in rows if r.doc_id == doc_id and r.doc_tokens == len(ids)):
            if zlib.crc32(data[4 * r.start : 4 * (r.start + r.length)]) == r.ids_crc32:
                found[doc_id, len(ids)].append((r.start, r.length))
    for key, n in expected.items():
        covered = Counter(t for start, length in set(found[key]) for t in range(start, start + length))
        assert len(covered) == key[1]
    assert sum(r.length for r in rows) == sum(n * k[1] for k, n in expected.items())
    windows = defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    padding = 0
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= packing.WINDOW
        padding += 0 if at & (at - 1) == 0 else packing.WINDOW - at
    return padding / sum(r.length for r in rows)


def test_packing(spark, documents):
    rows = queries.op3_packing(spark, SF).collect()
    assert check_packing(rows, [(d["doc_id"], d["text"]) for d in documents]) < 0.01


def test_chat(spark):
    told = duckdb.connect().execute(
        f"select conv_id, role, text from '{SF}/conversations.parquet' order by conv_id, turn"
    ).fetchall()
    told += [(-1, "user", "</s>[INST] ok [/INST]"), (-1, "assistant", "</s>[INST] ok [/INST]")]
    turns = defaultdict(list)
    for conv, role, text in told:
        turns[conv].append((role, text or ""))
    rows = queries.op4_chat(spark, SF).collect()
    assert {r.conv_id for r in rows} == set(turns) and len(rows) == len(turns)
    for r in rows:
        spoken = "".join(t for role, t in turns[r.conv_id] if role == "assistant")
        whole = "".join(f"{role}\n{t}\n" for role, t in turns[r.conv_id])
        assert r.n_turns == len(turns[r.conv_id])
        assert r.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len(spoken), hashlib.sha256(spoken.encode()).hexdigest())


def test_fuzzy_lines(spark, documents):
    rows = queries.op5_fuzzy_lines(spark, SF).collect()
    found = [(d["doc_id"], i, lines.normal(x)) for d in documents for i, x in enumerate(d["text"].split("\n"))]
    found = [f for f in found if f[2]]
    distinct = sorted({f[2] for f in found}, key=lambda s: len(lines.shingles(s)))
    sets, name = [lines.shingles(s) for s in distinct], list(range(len(distinct)))

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i + 1, len(sets)):
            if len(a) < 0.8 * len(sets[j]):
                break
            if lines.similarity(a, sets[j]) >= 0.8:
                name[root(i)] = root(j)
    place = {s: i for i, s in enumerate(distinct)}
    classes = defaultdict(list)
    for doc_id, i, s in found:
        classes[root(place[s])].append((doc_id, i))
    expected = {m: (min(c), len(c), m == min(c)) for c in classes.values() for m in c}
    assert {(r.doc_id, r.line_no): ((r.class_doc_id, r.class_line_no), r.class_size, r.kept) for r in rows} == expected
    assert len(rows) == len(expected)


def test_mixing_comes_near_its_targets(spark, documents):
    rows = queries.op6_mixing(spark, SF).collect()
    longest = max(r.size for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * longest
        assert all(r.taken <= 3 * r.size for r in own)
    assert rows == queries.op6_mixing(spark, SF).collect()


def test_simhash(spark, documents):
    expected = near_classes({d["doc_id"]: d["text"] for d in documents})
    rows = queries.op7_simhash(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == expected and len(rows) == len(expected)


def test_language(spark, documents):
    rows = {r.doc_id: r for r in queries.op8_language_id(spark, SF).collect()}
    langs = {d["doc_id"]: d["lang"] for d in documents}
    assert set(rows) == set(langs)
    held = [r for r in rows.values() if r.held_out]
    assert {r.doc_id for r in held} == {i for i in langs if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_pipeline(spark, documents):
    """Each stage against plain Python over what the stage before it kept."""
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "mixing", "packing"
    ]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    everything = {d["doc_id"]: d["text"] for d in documents}

    known = stages["language_id"](spark, docs, SF)
    model = langid.fit(docs.filter(~langid.held_out()))
    expected = {k for k, t in everything.items() if not model.judge(t)[2]}
    kept = [r.doc_id for r in known.collect()]
    assert set(kept) == expected and len(kept) == len(expected) >= 0.98 * len(everything) and known.columns == columns

    one = stages["exact_dedup"](spark, docs, SF)
    last = {t.encode().lower(): k for k, t in sorted(everything.items())}
    kept = [r.doc_id for r in one.collect()]
    assert sorted(kept) == sorted(last.values()) and one.columns == columns

    near = stages["simhash_near_dedup"](spark, docs, SF)
    kept = [r.doc_id for r in near.collect()]
    assert sorted(kept) == sorted({c for _, c in near_classes(everything).values()}) and near.columns == columns

    mixed = stages["mixing"](spark, docs, SF)
    copies = {r.doc_id: r.copies for r in queries.op6_mixing(spark, SF).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == {k: n for k, n in copies.items() if n}
    assert mixed.columns == columns

    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} <= expected and sum(r.length for r in rows) > 0


def test_html_rules():
    page = """<html><head><title>Name</title><script>var x = "<p>no</p>";</script></head><body>
    <header><a href="/">Home</a> the best of all sites in the world and more of it</header>
    <div class="cookie-notice">We use cookies to give you the best of the web and that is all there is to it.</div>
    <main><h1>Title &amp; more</h1><p>This is the article, and it is about the things that are in it for the reader.</p>
    <p>Short.<p>Another&nbsp;paragraph of the
       article that has the words of the language in it.
    <form><label>Your name and the name of a friend</label><input></form>
    <aside>Read also the other story that is on the front page of the site today</aside></main>
    <section class="comments"><p>I think that this is the best article that I have read in a long time.</p></section>
    <footer>All of the rights are reserved by the owner of the site</footer>"""
    assert html.main_text(page) == (
        "Title & more This is the article, and it is about the things that are in it for the reader. Short. "
        "Another paragraph of the article that has the words of the language in it."
    )
    plain = """<div><a href=1>one of the links</a><a href=2>two of the links</a></div><div><p>Here is the text of the page
    that has no article element but enough of the words that make it one.</p><p>Tiny.</p></div>
    <div><a href=3>three of the links</a></div>"""
    assert html.main_text(plain).startswith("Here is the text") and "links" not in html.main_text(plain)
    assert html.main_text("") == html.main_text(None) == html.main_text("<p></p>") == ""
    assert html.main_text("<article><p>a &lt;b&gt; <!-- x --> c &#233;</article") == "a <b> c é"


def test_html_without_a_stop_list():
    """Pages in other languages, of code and of tables; a list that fits also tells what is not the article."""
    menu = "<ul><li><a href=1>Etusivu</a></li><li><a href=2>Yhteystiedot</a></li></ul><div>Tilaa</div>"
    finnish = (
        "Talvella järven jää kantaa usein jo joulukuussa, mutta keväällä sille ei enää kannata lähteä kävelemään.",
        "Kalastajat odottavat silloin rannalla, kunnes viimeisetkin lautat ovat sulaneet ja veneet päästään laskemaan vesille.",
    )
    page = f"<body>{menu}<div class='text'><h2>Järvellä</h2><p>{finnish[0]}</p><p>Kevät.</p><p>{finnish[1]}</p></div></body>"
    assert html.main_text(page).endswith(f"Järvellä {finnish[0]} Kevät. {finnish[1]}") and "Etusivu" not in html.main_text(page)
    japanese = "冬になると湖は厚い氷に覆われ、漁師たちは岸辺で春を待ちながら網を直している。"
    assert html.main_text(f"<div><p>{japanese}</p></div>") == japanese
    code = "def area(width, height):\n    total = width * height\n    return round(total, 2) if total > 0 else None"
    assert html.main_text(f"<div><pre>{code}</pre></div>") == " ".join(code.split())
    rows = [[f"Station {i}", f"{i}.5 mm", f"{990 + i} hPa"] for i in range(12)]
    cells = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows)
    assert html.main_text(f"<a href=1>Home</a><table>{cells}</table>") == " ".join(c for r in rows for c in r)
    english = "<p>This is the text of the page and it is about the things that are in it for you and for all of us.</p>" * 3
    tags = "Photographs Reuters Getty Images Associated Press London Paris Berlin Madrid Rome Vienna Prague Warsaw"
    found = html.main_text(f"<div>{english}<pre>{code}</pre>{english}</div><div>{tags}</div>")
    assert "Photographs" not in found and "def area" in found and found.count("This is the text") == 6


def test_html_wrappers_with_telling_names():
    article = "This is the article, and it is about the things that are in it for the reader of the page."
    other = "I think that this is the best that I have read in a long time and I will be back for more."
    for name in ("content has-sidebar", "post with-comments", "no-ads layout", "page-with-sidebar", "sidebar-layout", "comments-open"):
        for kind in ("article", "main"):
            page = f"<div class='{name}'><{kind}><p>{article}</p><div class='comments'><p>{other}</p></div></{kind}>"
            page += f"<div class='sidebar'>{other}</div></div><footer>{other}</footer>"
            assert html.main_text(page) == article, (name, kind)
    for name in ("has-sidebar", "with_comments", "no-ads"):
        assert html.main_text(f"<div class='{name}'><p>{article}</p></div><div class='sidebar-with-ads'>{other}</div>") == article
    # What stands in the comments or beside the article stays out, be it an article element or not.
    comment = f"<div class='comments'><article class='comment-body'><p>{other * 3}</p></article></div>"
    assert html.main_text(f"<div><p>{article}</p></div>{comment}") == article
    related = f"<div class='related'><article><p>{other * 3}</p></article></div>"
    assert html.main_text(f"<article><p>{article}</p>{related}</article>{related}") == article
    assert html.main_text(f"<main><h1>Name</h1><div class='sidebar-layout'><article>{article}</article></div></main>") == f"Name {article}"
    assert html.main_text(f"<aside class='x'><article><p>{article}</p></article></aside>") == ""


def test_html_parts_of_the_article_with_telling_names():
    article = "This is the article, and it is about the things that are in it for the reader of the page."
    part = "It has to be said that the work of the others is not to be left out of this in any way."
    kept = ["section id='discussion'", "section id='related-work'", "section class='social-history'", "p id='copyright'"]
    kept += ["div id='search-for-meaning'", "div class='menu-prices'", "section id='notice'", "div class='has-comments'"]
    for opening in kept:
        page = f"<article><p>{article}</p><{opening}>{part}</{opening.split()[0]}></article>"
        assert html.main_text(page) == f"{article} {part}", opening
    gone = ["div class='ad'", "div class='google-ads'", "section id='comments'", "div class='related-posts'", "p class='notice'"]
    gone += ["div class='social share-buttons'", "div class='post-comments-list'", "div class='ad-300x250'", "form", "aside"]
    for opening in gone:
        page = f"<article><p>{article}</p><{opening}>{part}</{opening.split()[0]}></article>"
        assert html.main_text(page) == article, opening
    linked = "<p><a href='1'>The whole of this paragraph is a link to the work of the others</a></p>"
    sources = "<ol><li><a href='2'>Smith, A history of lakes</a></li><li><a href='3'>Jones, Ice</a></li></ol>"
    row = "<div><a href='4'>Facebook</a> <a href='5'>Mastodon</a> <a href='6'>Print</a></div>"
    assert html.main_text(f"<article><p>{article}</p>{linked}{sources}{row}</article>") == (
        f"{article} The whole of this paragraph is a link to the work of the others Smith, A history of lakes Jones, Ice"
    )


def test_html_of_any_shape_takes_linear_time():
    shapes = ["<p>it's <a b'>x ", "<div>a", "<a<b", "<a x='y>z' ", "<a x=\"y>z' ", "<!-- ", "<li></li><div>", "<td><div>", "&#1", "< "]
    shapes += ["<ul><li>", "</p>", "<a href=>", "<p class='a b' ", "=\"", "<script>", "<pre><p>x", "<a>b<dd>", "a= ", "&amp"]
    for shape in shapes:
        page = shape * (400_000 // len(shape))
        begin = time.process_time()
        html.main_text(page)
        assert time.process_time() - begin < 10, shape
    assert html.main_text("<article><p>a &#" + "1" * 5000 + "; b</p></article>") == "a \ufffd b"
    script = "<script>if (a<b) { x = \"<a t='\" + '<!--'; }</script>"
    assert html.main_text(f"<article>{script}<p title='a > b' lang=en>one</p> 1 < 2 <br/>two <b") == "one 1 < 2 two"


def test_template_language():
    render = chat.compile_template(
        "{% set a = 'x' ~ 1 %}{% for m in messages %}{% if m.role == 'u' and not false %}<{{ m.text | trim | upper }}>"
        "{% elif m.role in 'abc' %}{% generation %}{{ m.text }}{% endgeneration %}{% else %}?{% endif %}{% endfor %}"
        "{{ missing | default('none') }}{{ a }}{# gone #}"
    )
    text, spans = render([{"role": "u", "text": " hi "}, {"role": "b", "text": "yo"}, {"role": "z", "text": "-"}])
    assert text == "<HI>yo?nonex1" and [text[a:b] for a, b in spans] == ["yo"]
    folded = chat.fold(chat.parse("{% if 'a' == 'b' %}no{% else %}y{{ 'e' | upper }}{{ 's' }}{% endif %}"))
    assert folded == chat.Node("block", (chat.Node("literal", ("yEs",)),))
    for wrong in ("{% if x %}", "{{ x.y( }}", "{{ x | run }}", "{% for x %}{% endfor %}", "{% endif %}", "{{ }}", "{% call x %}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(wrong)
    assert chat.compile_template("{{ x.__class__ }}")([])[0] == ""


def test_escape_is_reversible():
    for text in ("", "\\", "\\l", "<s>", "[INST][/INST]", "\\[INST] <</s>> [ROLE]\\b", "[[SYS]]", "<s", "plain", "\n"):
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not any(c in escaped for c in chat.CONTROLS)
    turns = [("user", "a [/INST]\n"), ("tool", "[END]"), ("[ROLE]", ""), ("assistant", "</s>\n"), ("system", " ")]
    formatted, _ = chat.compile_template(chat.TEMPLATE)([{"role": r, "text": t} for r, t in turns])
    assert chat.read_turns(formatted) == turns
