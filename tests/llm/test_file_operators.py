"""Token files, packing, token counts, revisits, projections, wrappers and the pipeline."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from heatherd.llm import packing, projections, revisits, token_counts, token_files, wrappers
from heatherd.llm.catalogue import ORACLE, QUERIES
from heatherd.llm.tokens import Encoder, parted


def plain_ids(path, texts, end):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)  # as it is
    return [np.array(one.ids + [end], "<u4") for one in tokenizer.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("path, spaces", [(token_files.TOKENIZER, False), (packing.TOKENIZER, True)])
def test_encoder_equals_the_tokenizer(path, spaces, prose, monkeypatch):
    rng = random.Random(1)
    texts = ["", " ", "  ", "\n", " \n a", "a  b", "a\n\n b\n", "don't I'll 'tis  's\t\tx", "é éx", "\xa0x y", "a　b",
             "<|endoftext|> a <|endoftext|>", "a\x1cb c", "\r\n x \r\n", "1234 5 67", "日本語 テスト", "aͅ ́b", "x" * 900 + " y", prose(2_000)]
    texts += ["<|startoftext|>", "x<|endoftext|>y <|STARTOFTEXT|>", "a <|endoftext|>\n[SEP] [UNK]", "one\ntwo three.\nfour, five ", " lead", "\nlead\n", "a \nb", "nul\x00in text"]
    texts += ["".join(rng.choice(" \n\t'sabé1.́\xa0,<|>") for _ in range(rng.randint(1, 40))) for _ in range(2_000)]
    want = [ids[:-1].tobytes() for ids in plain_ids(path, texts, 0)]
    assert Encoder(path, spaces).encode(texts) == want
    monkeypatch.setattr("heatherd.llm.tokens.PART", 500)
    assert "".join(parted(texts[18])) == texts[18] and len(list(parted(texts[18]))) > 5
    assert Encoder(path, spaces).encode(texts) == want


@pytest.mark.parametrize("path, spaces", [(token_files.TOKENIZER, False), (packing.TOKENIZER, True)])
def test_words_of_letters_need_the_model_only(path, spaces, monkeypatch):
    words = ["plain", "Größe", "ÉÀÞ", "naïve", "x", "Über", "words"]
    texts = [" ".join(words[i:] + words[:i]) for i in range(len(words))]
    want = [ids[:-1].tobytes() for ids in plain_ids(path, texts, 0)]
    encoder = Encoder(path, spaces)
    encoder.known.clear()
    encoder.known.old.clear()
    monkeypatch.setattr("heatherd.llm.tokens.LIMIT", 3)  # pieces are forgotten and met again
    monkeypatch.setattr(type(encoder.known), "whole", None)
    assert encoder.encode(texts) == want and len(encoder.known) <= 3
    assert Encoder(path, spaces).known is encoder.known  # read once per worker process


# Token files


def test_token_files_round_trip(docs, corpus, spark, tmp_path):
    target = str(tmp_path / "ids")
    token_files.write_tokens(docs, target)
    rows = sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0))
    want = plain_ids(token_files.TOKENIZER, [r[1] or "" for r in rows], token_files.END)
    stored = token_files.read_tokens(spark, target)
    assert Counter((r.doc_id, tuple(r.ids)) for r in stored.collect()) == Counter((r[0], tuple(ids.tolist())) for r, ids in zip(rows, want))
    index = sorted(token_files.token_index(spark, target).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in index] == [r[0] for r in rows]
    assert [r.start for r in index] == np.cumsum([0, *(r.n_tokens for r in index)])[:-1].tolist()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in index) == Counter((r[0], len(i), zlib.crc32(i)) for r, i in zip(rows, want))
    one = stored.where(F.col("doc_id") == 4)
    assert "EqualTo(doc_id,4)" in one._jdf.queryExecution().toString() and one.count() == 1


def test_no_token_files(no_docs):
    assert token_files.tokenize_to_files(no_docs).count() == 0


# Packing


@pytest.mark.parametrize("group_rows", [2_000, 5])
def test_packing_places_every_id_once(docs, corpus, monkeypatch, group_rows):
    monkeypatch.setattr(packing, "GROUP_ROWS", group_rows)
    pieces = packing.pack(docs.where("doc_id <> 1 OR doc_id IS NULL").dropDuplicates(["doc_id"]).fillna({"doc_id": -1})).collect()
    texts = {-1: None} | {r[0]: r[1] for r in corpus if r[0] not in (1, None)}
    nulls = {r[1] for r in corpus if r[0] is None}
    ids = dict(zip(texts, plain_ids(packing.TOKENIZER, [t or "" for t in texts.values()], packing.END)))
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(texts) and None in nulls
    for doc, own in by_doc.items():
        if doc == -1:
            continue
        own.sort(key=lambda p: p.start)
        assert [p.start for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        assert sum(p.length for p in own) == len(ids[doc]) == own[0].doc_tokens
        assert all(zlib.crc32(ids[doc][p.start : p.start + p.length]) == p.ids_crc32 for p in own)
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist()
        total = sum(p.length for p in own)
        assert total <= packing.WINDOW and len({p.tier for p in own}) == 1
        padding += 0 if total & (total - 1) == 0 else packing.WINDOW - total
    assert padding < packing.WINDOW * (len(corpus) // group_rows + 1)
    steps = Counter()
    for own in by_sequence.values():
        steps[own[0].step_id] += own[0].tier
    assert max(steps.values()) <= packing.STEP_TOKENS


def test_packing_of_equal_rows_and_nothing(docs, corpus, no_docs):
    whole = packing.pack(docs).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    ids = plain_ids(packing.TOKENIZER, [r[1] or "" for r in corpus], 0)
    want = Counter()
    for r, one in zip(corpus, ids):
        want[r[0]] += len(one)
    assert {r.doc_id: r.n for r in whole} == dict(want)
    assert packing.pack(no_docs).count() == 0


# Token counts


def greedy(word, pieces):
    count = 0
    while word:
        end = next(n for n in range(len(word), 0, -1) if word[:n] in pieces)
        word, count = word[end:], count + 1
    return count


def test_longest_match_on_random_vocabularies():
    rng = random.Random(3)
    for _ in range(100):
        pieces = {bytes([c]) for c in range(256)} | {bytes(rng.choice(b"ab") for _ in range(rng.randint(2, 6))) for _ in range(8)}
        automaton = token_counts.LongestMatch(pieces)
        for _ in range(30):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 15)))
            assert automaton.count(word) == greedy(word, pieces)
    with pytest.raises(ValueError):
        token_counts.LongestMatch({b"a"})


def test_token_counts_match_greedy_cutting(docs, corpus, no_docs):
    pieces = token_counts.read_vocabulary(token_counts.VOCABULARY)
    got = token_counts.count_tokens(docs).select("doc_id", "text", "n_words", "n_tokens").collect()
    assert len(got) == len(corpus)
    for row in got:
        words = (row.text or "").encode().split()
        if len(words) < 500 and max(map(len, words), default=0) < 500:
            assert (row.n_words, row.n_tokens) == (len(words), sum(greedy(b" " + w, pieces) for w in words))
    assert token_counts.count_tokens(no_docs).count() == 0


# Revisits


def test_revisits_defined_cases(spark):
    tag = lambda value, **more: {"ETag": value, **more}
    rows = [
        (1, "response", "http://A.example/x?b=2&a=1", 100, 200, tag('"v1"', Expires="never", Server="s"), "one"),
        (2, "response", "https://a.example:443/x?a=1&b=2#top", 90_000, 200, tag('"v2"'), "two"),
        (3, "response", "http://a.example/x?a=1&b=2", 90_000, 200, tag('"v3"'), "three"),
        (4, "response", "http://a.example/x?a=1&b=2", 50, 404, tag('"v1"'), "gone"),
        (10, "revisit", "http://a.example/x?a=1&b=2", 200, 304, tag('W/"v1"', expires="soon", Server="other"), None),
        (11, "revisit", "http://a.example/x?a=1&b=2", 200, 304, tag('W/"v1"', expires="soon", Server="other"), None),
        (12, "revisit", "http://a.example/x?a=1&b=2", 90_000, 304, tag('"v1"'), None),  # the response of that time is not earlier
        (13, "revisit", "http://a.example/x?a=1&b=2", 900_000, 304, tag('"v3"'), None),
        (14, "revisit", "http://a.example/x?a=1&b=2", 900_000, 304, tag('"v1"'), None),
        (15, "revisit", "http://a.example/x?a=1&b=2", 900_000, 304, None, None),
        (16, "revisit", "http://a.example/x?a=1&b=2", 10, 304, tag('"v1"'), None),
        (17, "revisit", None, 900_000, 304, tag('"v1"'), None),
        (18, "revisit", "http://a.example/x?a=1&b=2", None, 304, tag('"v1"'), None),
        (None, "response", "http://a.example/x?a=1&b=2", 950, 200, tag('"v9"'), "no id"),
        (19, "revisit", "http://a.example/x?a=1&b=2", 1_000, 200, tag('"v1"'), None),
    ]
    schema = "record_id long, kind string, url string, at long, status int, headers map<string,string>, body string"
    records = spark.createDataFrame(rows, schema).withColumn("outcome", F.lit("clash"))
    got = {r.record_id: r for r in revisits.resolve_revisits(records).collect()}
    assert {k: (r.response_id, r.outcome, r.body) for k, r in got.items()} == {
        10: (1, "resolved", "one"), 11: (1, "resolved", "one"), 12: (1, "resolved", "one"), 13: (3, "resolved", "three"),
        14: (3, "changed", None), 15: (3, "unverified", None), 16: (None, "no_response", None), 17: (None, "no_response", None),
        18: (None, "no_response", None)}
    assert got[10].headers == {"etag": 'W/"v1"', "expires": "soon", "server": "s"} and got[14].headers is None
    same = revisits.resolve_revisits(records, slot_seconds=7).collect()
    assert Counter(map(str, same)) == Counter(map(str, got.values()))
    assert revisits.resolve_revisits(records.limit(0)).count() == 0


# Projections


def test_projections_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 24))
    rows, vec = [], 0
    for i, row in enumerate(base):
        for k in range(1 + i % 4):  # near copies at growing distance, scaled ones among them
            rows.append((vec, (row * (k + 1) + 0.35 * k * np.linalg.norm(row) / 24**0.5 * rng.standard_normal(24)).tolist()))
            vec += 1
    rows += [(vec + i, rows[3][1]) for i in range(30)] + [(2, rows[3][1])]
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24), (904, [1.0, None]), (905, [1.0, 2.0]), (906, [2.0, 4.0]),
           (907, [float("inf")] * 24), (908, [1e300] * 24), (909, [1e-300] * 24), (None, rows[0][1])]
    df = spark.createDataFrame([(v, e, "clash") for v, e in rows + odd], "vec_id long, embedding array<double>, links string")
    got = projections.near_vectors(df.repartition(3)).collect()
    assert len(got) == len(rows) + len(odd)
    at = np.array([e for _, e in rows + [odd[8], odd[9]]])
    at = at / np.abs(at).max(axis=1, keepdims=True)
    at /= np.linalg.norm(at, axis=1, keepdims=True)
    true = Counter()
    for (doc, _), links in zip(rows + [odd[8], odd[9]], (at @ at.T >= 0.9).sum(axis=1) - 1):
        true[doc] = max(true[doc], int(links))
    found = {r.vec_id: r.n_links for r in got}
    assert all(found[doc] <= true[doc] for doc in true if doc != 2)
    assert sum(found[doc] for doc in true) >= 0.9 * sum(true.values())
    assert {v: found[v] for v in (900, 901, 902, 903, 904, 907, None)} == dict.fromkeys((900, 901, 902, 903, 904, 907, None), 0)
    assert found[905] == found[906] == 1 and found[908] == found[909] == 1
    assert {r.vec_id: (r.component_id, r.kept) for r in got}[906] == (905, False)
    assert projections.near_vectors(df.limit(0)).count() == 0


def test_blocks_of_a_large_cell_agree(spark, monkeypatch):
    rng = np.random.default_rng(9)
    centre = rng.standard_normal(16)
    rows = [(i, (centre + 0.05 * rng.standard_normal(16)).tolist()) for i in range(90)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = sorted(map(tuple, projections.near_vectors(df).collect()))
    monkeypatch.setattr(projections, "BLOCK", 20)
    assert sorted(map(tuple, projections.near_vectors(df).collect())) == whole
    assert all(row[1:] == (89, 0, row[0] == 0) for row in whole)


def test_plan_grows_slowly():
    small, large = projections.plan(1_000), projections.plan(10**9)
    assert small.k < large.k < 30 and large.needed == small.needed
    assert projections.plan(0).k == 2


def test_only_pairs_in_windows_are_counted():
    rng = np.random.default_rng(5)
    for n, window in ((0, 1.0), (1, 1.0), (2, 0.0), (200, 0.1), (200, 50.0)):
        line = np.round(rng.normal(size=n), 3)
        if n == 2:
            line[1] = line[0]
        a, b = projections.window_pairs(line, window)
        want = [(i, j) for i in range(n) for j in range(i + 1, n) if max(line[i], line[j]) <= min(line[i], line[j]) + window]
        assert sorted(zip(a.tolist(), b.tolist())) == want


# Wrappers


def page(items, paragraphs, article="article", extra=""):
    menu = "".join(f"<li><a href='/{i}'>{i}</a>" for i in items)
    return (f"<!doctype html><html><head><title>t</title><style>p{{}}</style></head><body><header>Site</header><nav><ul>{menu}</ul></nav>"
            f"<div class='ad-slot'>buy</div><div class=hint>Read all about it here</div>{extra}<{article}>"
            + "".join(f"<p>{p}" for p in paragraphs) + f"</{article}><footer>&copy; all</footer></body></html>")


def test_wrapper_text(spark, prose):
    rows, want = [], {}
    for i in range(30):
        paragraphs = [prose(12 + i % 5) for _ in range(1 + i % 4)]
        article = "article" if i % 2 else "div"
        host = "with" if i % 2 else "without"
        rows.append((i, f"http://{host}.example/{i}", page(range(i % 6 + 1), paragraphs, article)))
        want[i] = "\n\n".join(paragraphs)
    odd = {
        100: (None, ""), 101: ("", ""), 102: ("x &amp;  y\n<br>z &lt", "x & y z <"), 103: ("<article><h1>T</h1><p>a<b>b</b>&nbsp;c<p>d<", "T\n\nab c\n\nd<"),
        104: ("<div>" * 3_000 + "deep" + "</div>" * 3_000, "deep"),
        105: ("<article>a<script>1<2</script>b<form>f</form><section class='user-comments'><p>no</section><ul><li>i<li>j</ul></article>", "ab\n\ni\n\nj"),
        106: ("<main><h2>H</h2><aside>no</aside><pre>a\n b</pre><table><tr><td>1<td>2</table></main><p>out", "H\n\na b\n\n1\n\n2"),
        107: ("<article><p>cut <a hre", "cut"),
    }
    rows += [(k, None if k == 101 else f"http://odd{k}.example/", html) for k, (html, _) in odd.items()]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).repartition(4)
    got = {r.page_id: r for r in wrappers.extract_text(df).collect()}
    assert {k: r.text for k, r in got.items()} == want | {k: text for k, (_, text) in odd.items()}
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrappers.extract_text(df.limit(0)).count() == 0
    twice = wrappers.extract_text(df.union(df))
    assert twice.count() == 2 * len(rows) and {r.page_id: r.text for r in twice.collect()}[1] == want[1]


def test_wrapper_inference_folds_groups_and_options():
    one, two = (wrappers.skeleton(wrappers.parse(f"<body><ul>{li}</ul>{p}</body>")) for li, p in (("<li>a<li>b", "<p>x"), ("<li>c", "")))
    body = wrappers.merge(one, two)[5][0]
    assert [(k[0], k[1]) for k in body[5]] == [("ul", 2), ("p", 1)]  # the paragraph is optional
    assert body[5][0][5][0][:3] == ["li", 2, 1]  # one repeated group


def read(html, *others):
    """The text of a page, read with the wrapper of it and the other pages of its host."""
    wrapper = wrappers.skeleton(wrappers.parse(html))
    for other in others:
        wrapper = wrappers.merge(wrapper, wrappers.skeleton(wrappers.parse(other)))
    return wrappers.Reader(wrapper).text(html)


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', "style='overflow: hidden'", "style=overflow:hidden", 'data-id="share"', "data-hidden=1", 'title=\'class="menu"\'',
    'data-x="a" data-role="navigation"', "data-aria-hidden=true", 'aria-hidden="false"', '"hidden"'])
def test_values_of_other_attributes_rule_nothing_out(attributes):
    assert read(f"<div {attributes}><article><p>x <span {attributes}>y</span></article></div>") == "x y"
    assert read("<article>see <a href='/hidden-gems'>gems</a> and <a href=\"/x?id=menu\">menus</a></article>") == "see gems and menus"


@pytest.mark.parametrize("attributes", ["hidden", "HIDDEN=''", 'aria-hidden = "true"', "data-x='>' hidden", "role=search", "a=b role='dialog'"])
def test_exact_attributes_rule_out(attributes):
    assert read(f"<article>x<div {attributes}>no</div></article>") == "x"


def test_self_closed_svg_ends_where_it_closes():
    assert read('<article>a<svg width="1"/>b<svg d="x>y" />c<svg><text>no</text></svg>d<svg/></article>') == "abcd"
    assert read("<article><title-card>a</title-card><svg-icon></svg-icon>b</article>") == "a\n\nb"


@pytest.mark.parametrize("part, text", [
    ("<div class='article-header'><h1>Title</h1><p>lead</div>", "Title\n\nlead"), ("<div class=entry-header><h1><a>Title</a></h1></div>", "Title"),
    ("<h2 id=related-work>Related</h2>", "Related"), ("<h2 id=search>Search</h2>", "Search"), ("<h2 id=comments-on-the-method>On</h2>", "On"),
    ("<section id='social-history'><p>long ago</section>", "long ago"), ("<p class=notice>mind this</p>", "mind this"),
    ("<div class=related><p>" + "work of others " * 9 + "<a>one</a> <a>two</a></div>", ("work of others " * 9 + "one two")),
    ("<div class=share>Share: <a>one</a> <a>two</a></div>", ""), ("<div id=search><label>find</label><input><input></div>", ""),
    ("<nav>no</nav><div class=comments><p>no</div>", "")])
def test_names_alone_rule_nothing_out_inside_an_article(part, text):
    assert read(f"<article><p>x</p>{part}</article>") == (f"x\n\n{text}" if text else "x")


def test_cards_are_not_main_text():
    assert read("<article class=related>card</article><article class='post share'>story</article><article class=comment-body>c</article>") == "story"
    assert read("<article>story<article class='comment even'>c</article></article>") == "story"
    assert read("<article class=teaser>only</article>") == "only"
    assert read("<h1 id=search-trees>T</h1><div class=post-header><h2>S</h2></div><div class=header>no</div>") == "T\n\nS"


@pytest.mark.parametrize("main, text", [
    ("<h1>Title</h1><p>lead</p><article><p>long story</article>", "Title\n\nlead\n\nlong story"),
    ("<h1>T</h1><p>the whole story</p><article class=teaser>card</article>", "T\n\nthe whole story"),
    ("<h1>T</h1><p>the whole long story</p><article><h3><a href=/x>other</a></h3><p>its lead</article>", "T\n\nthe whole long story"),
    ("<p>the story</p><section class=social-history><p>long ago</section><article><a>card</a></article>", "the story\n\nlong ago"),
    ("<header><h1>T</h1></header><div class=sidebar>no</div><article><p>a longer story</article><div class=share>no</div>", "T\n\na longer story"),
    ("<nav>no</nav><article><p>story</article><aside>no</aside>", "story"),
    ("<article><h2><a>one</a></h2><p>x</article><article><h2><a>two</a></h2><p>y</article>", "one\n\nx\n\ntwo\n\ny"),
    ("<article class=card>only</article>", "only"), ("<p>story<article>part</article>", "story\n\npart")])
def test_main_around_articles_keeps_its_text(main, text):
    assert read(f"<main>{main}</main><p>out") == text


def test_only_constant_text_goes_and_what_is_below_stays():
    pages = [f"<body><h1>Title {i}</h1><p class=byline>By <a>author {i}</a></p><div class=abstract>Abstract <p>short {i}</p></div><div class=hint>Read "
             f"<b>all</b></div><div class=text>{'long text ' * 40}{i}</div></body>" for i in range(5)]
    assert read(*pages).split("\n\n") == ["Title 0", "author 0", "short 0", "long text " * 40 + "0"]
    few = [f"<div class=box>{'much text ' * 50}{i}</div><div class=story></div>" for i in range(20)]
    assert read("<div class=box></div><div class=story>the story</div>", *few) == "the story"
    one = [f"<div class=a><p class=x>Menu</p></div><div class=b><p class=x>Menu</p><div class=c>{i} <i>Menu</i> text</div></div>" for i in range(5)]
    assert read(*one) == "0 Menu text"  # constants inside a sentence stay


def test_pages_that_agree_in_everything_are_read_whole():
    assert read(*["<div class=a>same</div><p>text"] * 6) == "same\n\ntext"


def test_articles_are_read_with_the_wrapper(spark, prose):
    def story(i, host):
        share = "Share this story with your friends" if host == "a" else f"Share {i} {prose(3)}"
        return (f"<body><article><h1>Story {i}</h1><p>{prose(20 + i)}</p><div class=x>Written by <i>{i}</i></div><p>{prose(9)} <b>Note</b> {i}</p>"
                f"<table><tr><th>Year<td>{i}</table><div class=ad>Buy {prose(3)}</div><p>{share}</p></article></body>")

    pages = {(host, i): story(i, host) for host, n in (("a", 12), ("b", 12), ("few", 3)) for i in range(n)}
    copy = story(0, "a")
    pages |= {("copies", i): copy for i in range(12)} | {("copies", 12): story(12, "a")}
    df = spark.createDataFrame([(f"http://{host}/{i}", html) for (host, i), html in pages.items()], "url string, html string")
    got = {r.url: r.text for r in wrappers.extract_text(df.select(F.lit(1).alias("page_id"), "url", "html").repartition(5)).collect()}
    for (host, i), html in pages.items():
        text = got[f"http://{host}/{i}"]
        host = "a" if html == pages["copies", 12] else host
        assert f"Story {0 if host == 'copies' else i}\n\n" in text and " Note " in text and "Year\n\n" in text, host
        assert ("Share" in text) == (host != "a") and ("Written by" in text) == (host in ("few", "copies")), host
        assert ("Buy" in text) == (host == "few"), host


# Queries and pipeline


def test_every_operator_has_its_query():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)


def test_pipeline_stages(spark, docs):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    stage = plain
    for name, run in corpus_pipeline.STAGES[:-1]:
        after = run(spark, stage, "")
        assert after.columns == plain.columns, name
        stage = spark.createDataFrame(after.collect(), plain.schema)
    pieces = corpus_pipeline.STAGES[-1][1](spark, stage, "")
    ids = plain_ids(packing.TOKENIZER, [r.text or "" for r in stage.collect()], 0)
    assert pieces.agg(F.sum("length")).first()[0] == sum(map(len, ids))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "repeated_passages", "source_mix", "packing"]
