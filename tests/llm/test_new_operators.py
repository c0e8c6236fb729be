"""Alignment, ranked search and HTML extraction against brute force and on odd inputs."""

import hashlib
import html
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import many_partitions
from llm_fixtures import DOC_SCHEMA, ODD_TEXTS, odd_docs, table  # noqa: F401
from svcvitals.llm import html_extract, ranked_search, token_alignment
from svcvitals.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


# --- alignment -----------------------------------------------------------------------------

def byte_of():
    """The byte-level alphabet, by the rule that made it."""
    own, n = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)], 0
    table = {chr(b): b for b in own}
    for b in range(256):
        if b not in own:
            table[chr(256 + n)] = b
            n += 1
    return table


def aligned_by_hand(texts):
    """(a ids, b ids, groups, links) of each text, by walking both sequences."""
    a_model, b_model, alphabet = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B), byte_of()
    a_model.encode_special_tokens = True
    out = []
    for t in texts:
        whole = (" " + (t or "")).encode()
        a = a_model.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_model.encode(t) if t else []
        spelled_a = [bytes(alphabet[c] for c in a_model.id_to_token(i)) for i in a]
        pieces = [b_model.id_to_piece(i) for i in b]
        spelled_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in pieces]
        if b"".join(spelled_a) != whole or b"".join(spelled_b) != whole:
            out.append(([], [], [], []))
            continue
        i = j = 0
        groups, links = [], []
        while i < len(a):
            x, y = [a[i]], [b[j]]
            n, m = len(spelled_a[i]), len(spelled_b[j])
            while n != m:
                if n < m:
                    i += 1
                    x.append(a[i])
                    n += len(spelled_a[i])
                else:
                    j += 1
                    y.append(b[j])
                    m += len(spelled_b[j])
            groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
            links.append((x[-1], y[-1]))
            i, j = i + 1, j + 1
        out.append((a, b, groups, links))
    return out


def check_alignment(rows, ids, texts):
    want, counts = aligned_by_hand(texts), Counter()
    for *_, links in want:
        counts.update(links)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    expected = Counter()
    for d, (a, b, groups, links) in zip(ids, want):
        expected[d, len(a), len(b), ";".join(groups), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links)] += 1
    assert Counter((r["doc_id"], r["n_a"], r["n_b"], r["groups"], r["n_best"], r["count_sum"]) for r in rows) == expected
    for r in rows:
        packed = [token_alignment.unpacked(r[c]) for c in ("a_ids", "b_ids", "a_sizes", "b_sizes")]
        assert [len(x) for x in packed] == [r["n_a"], r["n_b"], r["n_groups"], r["n_groups"]] and token_alignment.groups_text(*packed) == r["groups"]


ODD_ALIGNED = [*ODD_TEXTS, "▁ is a piece of its own", "<s> </s> <unk> <0x41> <|endoftext|>", "  two  spaces   three ", "\n\n\t x", "a" * 3000, "é" * 700, "日本語テキスト", "  ",
               "0123456789" * 40, "ﬁ ² ½ Å", "\x00", " ", "supercalifragilistic" * 20]


def test_alignment(table, spark):
    rng = random.Random(3)
    parts = ["the", " quick", "ﬁ", "é", "日本", "😀", "\n", "  ", "12345", "don't", "▁", "<s>", "Hello", "_", "http://x.y/z?q=1", "\t", "ß", "́"]
    texts = [*ODD_ALIGNED, *["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(150)]]
    ids = [None if k % 11 == 0 else k % 90 for k in range(len(texts))]
    docs = table([(i, t, "x", 1, "g") for i, t in zip(ids, texts)], "doc_id long, text string, block string, row int, groups string", files=3)
    with many_partitions(spark):
        check_alignment(token_alignment.align(docs, A, B, text=True).collect(), ids, texts)


def test_alignment_of_blocks(table, monkeypatch):
    """Pairs of many blocks are counted over all of them."""
    texts = [f"some words that come back, number {k % 7}" for k in range(60)]
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 300)
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    check_alignment(token_alignment.align(docs, A, B, text=True).collect(), range(60), texts)


def test_alignment_of_nothing(table):
    assert token_alignment.align(table([], "doc_id long, text string"), A, B).collect() == []


def test_pointer_jumping_on_long_chains():
    """Tokens that overlap in one chain from end to end, and tokens that all end together."""
    n = 5000
    a, b = np.arange(1, n + 1) * 2, np.append(np.arange(n) * 2 + 1, 2 * n)
    label = token_alignment.components(a, b)
    assert set(label.tolist()) == {n - 1}
    assert token_alignment.components(a, a).tolist() == [*range(n), *range(n)]
    rng = np.random.default_rng(1)
    for _ in range(50):
        total = int(rng.integers(1, 60))
        a, b = (np.append(np.flatnonzero(rng.random(total - 1) < p) + 1, total) for p in rng.random(2))
        common = np.intersect1d(a, b)
        label = token_alignment.components(a, b)
        want = [int(np.searchsorted(a, common[np.searchsorted(common, e)])) for e in [*a, *b]]
        assert label.tolist() == want


def test_op11_query(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    want = dict(zip((d["doc_id"] for d in docs), aligned_by_hand([d["text"] for d in docs])))
    got = QUERIES["op11_token_alignment"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        a, b, groups, links = want[r["doc_id"]]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"]) == (len(a), len(b), len(groups), len(links), digest)


# --- ranked search -------------------------------------------------------------------------

def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranked(docs, items, k=10):
    """(item number, rank, doc_id, score) by the contract, and all scores of each item."""
    bags = [Counter(terms_of(t)) for _, t in docs]
    big_n, big_l = sum(1 for b in bags if b), sum(map(lambda b: sum(b.values()), bags))
    df = Counter(w for b in bags for w in b)
    out = []
    for _, text in items:
        scored = []
        for (d, _), bag in zip(docs, bags):
            score = 0
            for w in set(terms_of(text)) & set(bag):
                weight = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[w] + 1)))
                score += weight * ((1000000000 * bag[w]) // (1000 * bag[w] + 8 * (10 + (90 * sum(bag.values()) * big_n) // big_l)))
            if score > 0:
                scored.append((-score, d is None, d))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out.append([(r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])])
    return out


@pytest.mark.parametrize("block_bytes,query_block", [(1 << 20, 512), (900, 3), (60, 1)])
def test_ranked_search(table, spark, monkeypatch, block_bytes, query_block):
    monkeypatch.setattr(ranked_search, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(ranked_search, "QUERY_BLOCK", query_block)
    rng = random.Random(block_bytes)
    common, rare = ["the", "of", "a", "Ab"], [f"r{k}" for k in range(200)] + ["É", "é", "x" * 400]
    word = lambda: rng.choice(common) if rng.random() < 0.6 else rng.choice(rare)
    docs = [(None if k % 13 == 0 else k % 250, rng.choice([" ", "-", "\n"]).join(word() for _ in range(rng.choice([0, 1, 3, 30, 200])))) for k in range(300)]
    docs += [(7, "the of"), (7, "the of"), (8, None), (9, ""), (10, "of the")]
    items = [(k % 5, " ".join(word() for _ in range(rng.randint(0, 12)))) for k in range(12)] + [(None, "the"), (50, None), (51, "nowhere"), (52, "!!"), (53, "THE the")]
    frame = ranked_search.rank_documents(table([(*d, "t", 1) for d in docs], "doc_id long, text string, term string, rank int", files=4),
                                         table([(*i, 0) for i in items], "item_id long, text string, item long"), k=6)
    with many_partitions(spark):
        got = Counter(tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect())
    assert got == Counter((i, *row) for (i, _), rows in zip(items, ranked(docs, items, 6)) for row in rows)


def test_search_skips_nothing_that_counts():
    rng = np.random.default_rng(5)
    for _ in range(60):
        n = int(rng.integers(1, 1500))
        lists = []
        for p in rng.choice([0.001, 0.02, 0.3, 0.9], 7):
            docs = np.flatnonzero(rng.random(n) < p)
            lists.append((docs, rng.integers(0, 40, len(docs)) * int(rng.integers(1, 9))))
        postings = ranked_search.Postings(np.concatenate([d for d, _ in lists]), np.concatenate([v for _, v in lists]), np.cumsum([len(d) for d, _ in lists]), n)
        full = np.zeros(n, np.int64)
        for docs, v in lists:
            full[docs] += v
        for least in (0, 50, 400):
            found, scores = ranked_search.search(postings, list(range(7)), least, 5)
            assert (full[found] == scores).all() and len(set(found.tolist())) == len(found)
            top = np.sort(full)[::-1][:5]
            bound = max(least, int(top[-1]) if len(top) == 5 else 1, 1)
            assert set(np.flatnonzero(full >= bound).tolist()) <= set(found.tolist())


def test_search_visits_few_ranges_when_bounds_allow(monkeypatch):
    n = 64 * 200
    docs = np.arange(n)
    impacts = np.ones(n, np.int64)
    impacts[100:110] = 1000
    postings = ranked_search.Postings(docs, impacts, np.array([n]), n)
    visited = []
    real = np.flatnonzero
    monkeypatch.setattr(ranked_search.np, "flatnonzero", lambda x: (visited.append(len(x)), real(x))[1])
    found, _ = ranked_search.search(postings, [0], 0, 10)
    assert sorted(found.tolist()) == list(range(100, 110)) and sum(v == ranked_search.RANGE for v in visited) < 5


def test_impacts_beyond_64_bits():
    one = lambda n, big_n, big_l: int(ranked_search.impacts(np.array([7]), np.array([3]), np.array([n]), big_n, big_l)[0])
    for n, big_n, big_l in ((5, 3, 40), (10 ** 8, 10 ** 10, 10 ** 13)):
        assert one(n, big_n, big_l) == 7 * (3_000_000_000 // (3000 + 8 * (10 + 90 * n * big_n // big_l)))


def test_ranked_search_on_odd_documents(table):
    rows = odd_docs()
    items = table([(1, "the same line"), (2, "repeat me")], "item_id long, text string")
    got = ranked_search.rank_documents(table(rows, DOC_SCHEMA), items).collect()
    want = ranked([(r[0], r[1]) for r in rows], [(1, "the same line"), (2, "repeat me")])
    assert Counter(map(tuple, got)) == Counter((i + 1, *row) for i, rows in enumerate(want) for row in rows)
    assert ranked_search.rank_documents(table([], DOC_SCHEMA), items).collect() == []
    assert ranked_search.rank_documents(table(rows, DOC_SCHEMA), items.limit(0)).collect() == []


# --- HTML extraction -----------------------------------------------------------------------

MODEL = html_extract.Model.of({})


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("   \n ", ""), ("<html><body></body></html>", ""), ("just words", "just words"),
    ("<nav><a href='/'>Home</a> <a href='/x'>All</a></nav>", ""),
    ("<p>One &amp; two&#33; &lt;b&gt; a&nbsp;b\n\n c</p><p>Three</p>", "One & two! <b> a b c Three"),
    ("<p>in<b>ner</b> <i>and</i> so<br>on<p>next <ul><li>first<li>second</ul> rest", "inner and so on next first second rest"),
    ("<style>p{x}</style><script>if (a < b) document.write('<p>no</p>')</script><p>words that are read here<!-- <p>not these</p> --> today</p>", "words that are read here today"),
    ("<article><header><h1>Title of it</h1></header><p>Body of the text is long enough.</p><form><p>Your mail <input></p></form><p>More of the body.</p>"
     "<div class='comments'><p>First comment by a reader.</p></div></article><p>Elsewhere</p>", "Title of it Body of the text is long enough. More of the body."),
    ("<header><p>Site name and slogan</p></header><div id=main><p>The text is here and is long.</p><aside><p>Aside</p></aside><p>It goes on for many more words than the aside has.</p></div>"
     "<section id='comment-list'><article class='comment'><p>I do not agree with this at all, sir.</p></article></section><footer>c</footer>", "The text is here and is long. It goes on for many more words than the aside has."),
    ("<div class='cookie-notice'><p>We use cookies, as all do.</p></div><div><p>Text that was written.</p></div><div class='sidebarRight'>Popular now</div>", "Text that was written."),
    ("<form action=x><div><p>The page lies in a form.</p><p>All of it.</p></div></form>", "The page lies in a form. All of it."),
    ("<nav><ul><li>a<li>b<article><p>The menu was left open, here is the text.</p></article>", "The menu was left open, here is the text."),
    ("<p>5 < 6 and 7 > 6, a<b", "5 < 6 and 7 > 6, a"), ("<p title='a > b'>quoted</p>", "quoted"), ("<p title=\"open>still words</p>", "still words"),
    ("<script>never closed <p>x</p>", ""), ("<!-- never closed <p>x</p>", ""), ("</p></div>words", "words"), ("<p>one</p\n><p>two", "one two"),
    ("<table><tr><td>cell one<td>cell two</table>", "cell one cell two"), ("<P CLASS=Ad>Buy now</P><P>Read this text</P>", "Read this text")])
def test_pages(page, text):
    assert MODEL.text(page) == text


def test_best_region():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randint(0, 9)
        scores, costs = [rng.choice([-3.0, -1.0, 0.0, 1.0, 4.0]) for _ in range(n)], [rng.choice([0.0, 0.5, 2.0]) for _ in range(n)]
        total = lambda a, b: sum(scores[a:b]) - sum(costs[a + 1:b])
        a, b = html_extract.best_region(scores, costs)
        most = max([total(i, j) for i in range(n) for j in range(i + 1, n + 1)], default=0.0)
        assert (a, b) == (0, 0) if most <= 0 else total(a, b) == most


def test_deep_and_hostile_pages():
    deep = "<div>" * 20000 + "<p>deep words here</p>" + "</div>" * 20000
    assert MODEL.text(deep) == "deep words here" or len(html_extract.blocks_of(deep)) == 1
    many = "<p>word word word</p>" * 30000
    assert MODEL.text(many).split() == ["word"] * 90000
    html_extract.blocks_of("<a title=\"" * 3000)
    html_extract.blocks_of("<" * 100000)


def article(page):
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.search("(?s)<article>(.*?)</article>", page)[1])).split())


def test_held_out_pages(spark, table):
    """Learned from half of the pages, the other half's articles are found, also where the
    pages' own marks are taken away."""
    pages = pq.read_table("/root/testdata/sf0.1/pages.parquet").to_pylist()
    known, other = [p for p in pages if p["page_id"] % 2], [p for p in pages if p["page_id"] % 2 == 0]
    schema = "page_id long, url string, html string, text string, n_chars string"
    model = html_extract.learn(table([(p["page_id"], p["url"], p["html"], "", "") for p in known], schema), use_marks=False)
    bare = table([(p["page_id"], p["url"], re.sub("</?article>", "", p["html"]), "", "") for p in other], schema)
    got = {r["page_id"]: r for r in html_extract.extract(bare, model).collect()}
    assert len(got) == len(other)
    right = sum(got[p["page_id"]]["text"] == article(p["html"]) for p in other)
    assert right >= 0.99 * len(other)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_op13_query(spark):
    pages = {p["page_id"]: p for p in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = QUERIES["op13_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r["url"], r["text"]) == (pages[r["page_id"]]["url"], article(pages[r["page_id"]]["html"])) and r["n_chars"] == len(r["text"])


def test_extraction_of_odd_rows(table):
    schema = "page_id long, url string, html string, text string, n_chars long, marked boolean"
    rows = [(None, None, None, "x", 1, None), (1, "u", "", None, None, True), (2, "u", "<p>a</p>", None, None, True), (2, "u", "<p>a</p>", None, None, True)]
    pages = table(rows, schema)
    got = html_extract.extract(pages, html_extract.learn(pages)).collect()
    assert Counter(map(tuple, got)) == Counter([(None, None, "", 0), (1, "u", "", 0), (2, "u", "a", 1), (2, "u", "a", 1)])
    empty = table([], schema)
    assert html_extract.extract(empty, html_extract.learn(empty)).collect() == []


def test_arrow_strings():
    data = np.frombuffer("one two é".encode(), np.uint8)
    got = ranked_search._strings(data, np.array([0, 8, 4]), np.array([3, 10, 7]))
    assert got.type == pa.string() and got.to_pylist() == ["one", "é", "two"]
