"""Identity rests on bytes: texts whose words defeat sums of powers modulo 2^64, and added tokens."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from llm_fixtures import table  # noqa: F401
from svcvitals.llm import bytecols, decontaminate, mixing, ngram_join, ranked_search, token_records, url_filter
from svcvitals.llm.bytecols import range_hashes, same_ranges, string_bytes
from svcvitals.llm.tokenizing import CachedTokenizer

PATH = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n):
    """Two words of n letters a, b that differ, yet have equal polynomial hashes modulo 2^64."""
    bits = [bin(k).count("1") & 1 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_thue_morse_words_do_meet_in_power_sums():
    data, offsets = string_bytes(pa.array(thue_morse(2048)))
    old = bytecols.window_hashes(data, offsets[:-1], offsets[1:])
    new = range_hashes(data, offsets[:-1], offsets[1:])
    assert old[0] == old[1] and new[0] != new[1]


def test_ranges():
    rng = random.Random(2)
    raw = ["".join(rng.choice("ab") for _ in range(rng.choice([0, 1, 3, 7, 8, 9, 16, 17, 255, 256, 257, 300]))) for _ in range(600)]
    raw += [x[:-1] + "\0" for x in raw if x] + [x + "\0" for x in raw]
    data, offsets = string_bytes(pa.array(raw))
    a, b = offsets[:-1], offsets[1:]
    for which in (0, 1):
        assert len(set(range_hashes(data, a, b, which).tolist())) == len(set(raw))
    other = np.array([rng.randrange(len(raw)) for _ in raw])
    assert same_ranges(data, a, b, data, a[other], b[other]).tolist() == [x == raw[o] for x, o in zip(raw, other)]


@pytest.mark.parametrize("size", [1024, 2048, 4096])
def test_tokens_as_the_library(table, size):
    x, y = thue_morse(size)
    texts = [x, y, f"{x} {y}", "hello <|endoftext|> world", "<|endoftext|>", "", None, "<|endoftext|" + ">" * 3 + "a<|endoftext|>b", "plain"]
    library = Tokenizer.from_file(PATH)
    want = {k: library.encode(t or "", add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}
    assert want[3] == [31373, 220, 50256, 995, 0]
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_records.read_tokens(token_records.write_tokens(docs, PATH)).collect()}
    assert got == want


def test_cache_survives_equal_hashes(monkeypatch):
    """Where every cut has one of four hashes, ids are still those of the library."""
    import svcvitals.llm.tokenizing as tk
    monkeypatch.setattr(tk, "range_hashes", lambda data, a, b: (b - a).astype(np.uint64) % np.uint64(4) + np.uint64(1))
    t, library = CachedTokenizer(PATH), Tokenizer.from_file(PATH)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["one", "two", "six", "seven", "eight", "<|endoftext|>"]) for _ in range(rng.randint(0, 9))) for _ in range(60)]
    ids, counts = t.encode(*string_bytes(pa.array(texts)))
    ends = np.cumsum(counts)
    assert [ids[e - n:e].tolist() for e, n in zip(ends, counts)] == [library.encode(x, add_special_tokens=False).ids for x in texts]


def test_join_and_decontamination(table):
    x, y = thue_morse(1024)
    tail = " ".join(f"w{k}" for k in range(8))
    docs = table([(0, x), (1, y), (2, x), (3, f"{x} {tail}"), (4, f"{y} {tail}")], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join_documents(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}
    benchmark = table([(7, x), (8, f"{y} w0 w1")], "item_id long, text string")
    found = {r["doc_id"]: (r["n_hit"], r["items"]) for r in decontaminate.find_benchmark(docs, benchmark).collect()}
    assert found == {0: (1, ["7"]), 1: (0, []), 2: (1, ["7"]), 3: (1, ["7"]), 4: (3, ["8"])}


def test_decontamination_confirms_bytes(monkeypatch):
    """Words with equal hashes are told apart by their bytes, in texts and in the tables."""
    monkeypatch.setattr(bytecols, "range_hashes", lambda data, a, b, which=0: (b - a).astype(np.uint64))
    rng = random.Random(7)
    vocabulary = ["aa", "bb", "cc", "ddd", "eee"]
    items = [(str(k), " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6)))) for k in range(8)]
    tables = decontaminate.build(items, window=3)
    texts = [" ".join(rng.choice(vocabulary) for _ in range(40)) for _ in range(8)]
    data, offsets = string_bytes(pa.array(texts))
    own = decontaminate.Words.of(data, offsets)
    ends = np.searchsorted(own.starts, offsets[1:])
    got = set()
    for index, first, owners in tables:
        for at, p in zip(*(z.tolist() for z in index.search(own, ends))):
            got |= {(at - index.length + 1, index.length, items[o][0]) for o in owners[first[p]:first[p + 1]].tolist()}
    want, base = set(), 0
    for t in texts:
        w = t.split()
        for name, item in items:
            v = item.split()
            n = min(3, len(v))
            for i in range(len(w) - n + 1):
                if any(w[i:i + n] == v[j:j + n] for j in range(len(v) - n + 1)):
                    want.add((base + i, n, name))
        base += len(w)
    assert got == want


def test_terms_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(bytecols, "range_hashes", lambda data, a, b, which=0: (b - a).astype(np.uint64))
    data, offsets = string_bytes(pa.array(["aa bb aa cc", "bb ddd"]))
    starts, ends, hashes = bytecols.words(data, offsets)
    first, number = ranked_search._grouped(data, starts, ends, hashes)
    spelled = [data[a:b].tobytes() for a, b in zip(starts, ends)]
    assert [spelled[first[n]] for n in number] == spelled and len(first) == 4


def test_mix_of_null_ids_meets_its_targets(table):
    """Sources whose rows share an id, or have none, come near their targets."""
    rows = [(None if s < 2 else 5, f"text number {k} of source {s} " + "word " * (k % 17), f"s{s}") for s in range(3) for k in range(1000)]
    got, taken, target = mixing.mix(table(rows, "doc_id long, text string, source string")).collect(), Counter(), {}
    for r in got:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[s] - target[s]) <= 0.02 * target[s] for s in target)


def test_the_last_of_equal_rules_holds_on_both_ways(table, spark, monkeypatch):
    rules = [("a.com", "/", "block"), ("b.com", "/x/", "allow"), ("a.com", "/", "allow"), ("b.com", "/x/", "block"), ("com", "/", "block")]
    pages = table([(0, "http://a.com/"), (1, "http://w.b.com/x/y"), (2, "http://c.com/"), (3, None)], "page_id long, url string")
    want = {0: ("a.com/", "allow"), 1: ("b.com/x/", "block"), 2: ("com/", "block"), 3: (None, "allow")}
    found = lambda df: {r["page_id"]: (r["rule"], r["verdict"]) for r in df.collect()}
    assert found(url_filter.judge(pages, rules)) == want
    frame = spark.createDataFrame([(*r, n) for n, r in enumerate(rules)], "host string, path string, verdict string, nth long")
    assert found(url_filter.judge(pages, frame.repartition(4))) == want
    monkeypatch.setattr(url_filter, "MAX_INDEX_BYTES", 10)
    assert found(url_filter.judge(pages, rules)) == want


def test_draws_differ_with_the_text(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(None, "a"), (None, "b"), (1, None), (1, "")], "doc_id long, text string")
    draws = [r[0] for r in df.select(mixing.draw(F.col("doc_id"), mixing.text_hash(F.col("text")), F.lit(3))).collect()]
    assert len(set(draws)) == 4 and all(0 <= d < 1 for d in draws) and zlib.crc32(b"") == 0
