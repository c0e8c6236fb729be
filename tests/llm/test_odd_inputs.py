"""Every operator over nulls, empty and long texts, ties, repeats, empty tables and further columns."""

import pytest
from pyspark.sql import functions as F

from svcvitals.llm import (decontaminate, line_dedup, mixing, ngram_join, sharding, suffix_dedup, token_records,
                           topk_search, toxicity, url_filter)
from llm_fixtures import DOC_SCHEMA, odd_docs, table  # noqa: F401


@pytest.fixture(params=["odd", "empty"])
def docs(request, table):
    return table(odd_docs() + [(None,) * 11] if request.param == "odd" else [], DOC_SCHEMA)


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_tokens(docs, tmp_path):
    import public_tokenizers
    got = sorted(rows(token_records.read_tokens(token_records.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")))), key=lambda r: r["start"])
    assert len(got) == docs.count()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i))
    start = 0
    for r in got:
        assert r["start"] == start and len(r["ids"]) == 4 * r["n_tokens"] >= 4
        start += r["n_tokens"]


def test_suffix_dedup(docs):
    got = rows(suffix_dedup.remove_repeats(docs))
    assert len(got) == docs.count()
    for r in got:
        assert r["n_bytes"] == len(r["kept"]) + sum(s["last"] - s["first"] + 1 for s in r["spans"])
    by_id = {r["doc_id"]: r for r in got}
    if got:
        assert len(by_id[6]["kept"]) == 0  # 5000 equal bytes: every window starts again
        assert by_id[None]["n_bytes"] == 0


def test_toxicity(docs, table):
    labels = table([(1, 0, 1), (2, 1, None), (None, None, 1), (3, 0, 0), (8, 0, 1), (8, 0, 1)], "doc_id long, quality int, toxic int")
    lexicon = toxicity.learn(toxicity.training_rows(docs, labels))
    got = rows(toxicity.score_documents(docs, lexicon, keep=("source",)))
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)


def test_toxicity_without_labels(docs, table):
    lexicon = toxicity.learn(toxicity.training_rows(docs, table([], "doc_id long, toxic int")))
    assert all(r["predicted"] == 0 for r in rows(toxicity.score_documents(docs, lexicon)))


def test_join(docs):
    got = rows(ngram_join.join_documents(docs))
    assert len(got) == docs.count()
    for r in got:
        if r["doc_id"] == 9:
            assert r["component_id"] == r["class_id"] == 8 and r["n_shingles"] == 2
        if r["doc_id"] in (0, 1, 2):
            assert r["n_shingles"] == 0 and r["component_id"] == r["doc_id"]
        if r["doc_id"] is None:
            assert r["component_id"] is None


def test_mixing(docs):
    got = rows(mixing.mix(docs))
    assert len(got) == docs.count() and all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    emitted = mixing.emit(docs)
    assert emitted.columns == docs.columns and emitted.count() == sum(r["copies"] for r in got)


def test_decontamination(docs, table):
    benchmark = table([(1, "Repeat me, exactly"), (2, None), (3, "!!"), (None, "same line of")], "item_id long, text string")
    got = {r["doc_id"]: r for r in rows(decontaminate.find_benchmark(docs, benchmark))}
    if got:
        assert got[8]["items"] == ["1"] and got[8]["n_hit"] == 3 and got[8]["contaminated"]
        assert got[7]["items"] == [""] and got[7]["n_hit"] == 1200
        assert got[0]["n_words"] == 0 and not got[0]["contaminated"]
    none = rows(decontaminate.find_benchmark(docs, benchmark.limit(0), keep=("n",)))
    assert len(none) == docs.count() and all(r["n_hit"] == 0 and r["items"] == [] for r in none)


def test_sharding(docs):
    got = rows(sharding.assign_shards(docs, 3, rows_per_range=1))
    assert len(got) == docs.count()
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_lines(docs, spark):
    store = line_dedup.LineStore(spark, 4).insert(docs)
    got = rows(store.clean(docs))
    assert len(got) == docs.count()
    by_id = {r["doc_id"]: r for r in got}
    if got:
        assert by_id[9]["text"] == "" and by_id[9]["n_dropped"] == 1  # 8 keeps the line
        assert by_id[8]["n_dropped"] == 0 and by_id[7]["n_dropped"] == 0  # repeats within one document stay
        assert by_id[0]["n_lines"] == 1 and by_id[None]["n_lines"] == 1


def test_top_k(table):
    schema = "vec_id long, embedding array<float>, score long, rank int"
    nan = float("nan")
    vectors = table([(0, [1.0, 0.5], None, 1), (1, [1.0, 0.5], 2, 2), (1, [1.0, 0.5], 2, 2), (2, [0.25], None, None), (3, [], None, None), (4, None, 1, 1),
                     (5, [1.0, None], 1, 1), (6, [nan, 1.0], 1, 1), (None, [1.0], 1, 1), (7, [-0.0001, 3e38], 1, 1)], schema)
    got = rows(topk_search.top_k(vectors, F.col("vec_id") == 0, k=3))
    big = (1 << 63) - 1
    wrapped = lambda x: (x + (1 << 63)) % (1 << 64) - (1 << 63)
    want = sorted([(1, 1024 * 1024 + 512 * 512), (2, 1024 * 256), (3, 0), (7, wrapped(-1024 + 512 * big))], key=lambda p: (-p[1], p[0]))[:3]
    assert sorted((r["rank"], r["vec_id"], r["score"]) for r in got) == [(k + 1, v, s) for k, (v, s) in enumerate(want)]
    assert rows(topk_search.top_k(vectors.limit(0), F.col("vec_id") == 0)) == []


@pytest.mark.parametrize("judge", ["index", "join"])
def test_urls(table, spark, judge):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.NET/en/x?q#f", "http://example.net", "http://example.net/de/", "a://notexample.com/de/",
            "a://x.example.com/de/?a", "https://org/fr/", "https://a.org/fr", "ftp://é.net/é", "http://a.net#x/", "http://b.net?/", "s://t://net/", "\n://net/\n"]
    pages = table([(i, u, "h", "v") for i, u in enumerate(urls)] + [(4, urls[4], "h", "v"), (None, "x://net/", None, None)], "page_id long, url string, host string, verdict string")
    if judge == "index":
        got = rows(url_filter.judge(pages))
        assert rows(url_filter.judge(pages.limit(0))) == [] and all(r["verdict"] == "allow" for r in rows(url_filter.judge(pages, rules=())))
    else:
        got = rows(url_filter.judge_by_join(pages, spark.createDataFrame([(*r, n) for n, r in enumerate(url_filter.RULES)], "host string, path string, verdict string, nth long")))
    assert len(got) == len(urls) + 2
    seen = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert seen[0] == seen[1] == seen[2] == ("", "", None, "allow")
    assert seen[4] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert seen[5] == ("example.net", "", None, "allow") and seen[6] == ("example.net", "/de/", "net/", "block")
    assert seen[7][2] is None and seen[8][2:] == ("example.com/de/", "block") and seen[9][2:] == ("org/fr/", "allow") and seen[10][2] is None
    assert seen[11] == ("é.net", "/é", "net/", "block") and seen[12][:2] == ("a.net", "") and seen[14][:2] == ("t:", "//net/")
    assert seen[None][2:] == ("net/", "block")
