"""The operators' parts against brute force on small random inputs."""

import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import many_partitions
from llm_fixtures import table  # noqa: F401

from svcvitals.llm import decontaminate, line_dedup, ngram_join, suffix_dedup, token_records, toxicity
from svcvitals.llm.bytecols import string_bytes, words
from svcvitals.llm.components import components
from svcvitals.llm.crc32c import crc32c, crc32c_rows, masked
from svcvitals.llm.signature_tree import SignatureTree, dual_traversal
from svcvitals.llm.tokenizing import CachedTokenizer


# --- token records -------------------------------------------------------------------------

def bitwise_crc32c(data: bytes) -> int:
    c = 0xFFFFFFFF
    for x in data:
        c ^= x
        for _ in range(8):
            c = (c >> 1) ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_crc32c():
    assert bitwise_crc32c(b"123456789") == 0xE3069283
    data = np.random.default_rng(1).integers(0, 256, 9000).astype(np.uint8)
    starts, ends = [0, 4, 13, 525, 1037, 1549], [4, 13, 525, 1037, 1549, 9000]
    assert crc32c(data, starts, ends).tolist() == [bitwise_crc32c(data[a:b].tobytes()) for a, b in zip(starts, ends)]
    assert crc32c_rows(data[:64].reshape(8, 8)).tolist() == [bitwise_crc32c(data[8 * k:8 * k + 8].tobytes()) for k in range(8)]
    assert masked(np.array([0], np.uint32))[0] == 0xA282EAD8


def test_tokenizer_cuts_change_nothing():
    import public_tokenizers
    from tokenizers import Tokenizer
    t, library = CachedTokenizer(public_tokenizers.path("byte_bpe_50k.json")), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    parts = list(" \n\t\r\x0b\x1c 　éñaZ9'ś—,.!_<|>") + ["'s", "'ll", "  ", "hello", " the", "́", "日本", "😀", "\u0085", "²", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(5000)]
    ids, counts = t.encode(*string_bytes(pa.array(texts)))
    ends = np.cumsum(counts)
    for k, e in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        assert ids[ends[k] - counts[k]:ends[k]].tolist() == e.ids, texts[k]


def test_records_in_any_order_and_corruption(tmp_path):
    uri = str(tmp_path / "a" / "x.rec")
    writer = token_records.RecordWriter(uri)
    writer.write([token_records.payload_head(k, 2, 3) + np.array([k or 0, 7, 0], "<u2").tobytes() for k in (5, None, 9)])
    writer.close()
    assert [(d, t.tolist()) for d, t in token_records.read_records(uri)] == [(5, [5, 7, 0]), (None, [0, 7, 0]), (9, [9, 7, 0])]
    assert [d for d, _ in token_records.read_records(uri, which=[2, 0])] == [9, 5]
    data = bytearray(open(uri, "rb").read())
    for at in (3, 40):
        broken = bytearray(data)
        broken[at] ^= 1
        open(uri, "wb").write(broken)
        with pytest.raises(ValueError):
            list(token_records.read_records(uri))


# --- suffix dedup --------------------------------------------------------------------------

def removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(([(m.start(), m.end() - 1) for m in re.finditer(b"\1+", bytes(gone))], bytes(x for x, y in zip(b, gone) if not y)))
    return out


@pytest.mark.parametrize("length,trigger,period,letters", [(20, 4, 5, "abc"), (20, 4, 5, "abcdefghij é"), (40, 6, 9, "ab"), (20, 4, 50, "abcdef")])
def test_suffix_dedup(table, length, trigger, period, letters):
    rng = random.Random(period)
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    texts = [None, "", "a" * 300, "a" * 100, "ab" * 200, None]
    for _ in range(150):
        t, kind = rng.choice(base), rng.random()
        if kind < 0.3:
            t = t[rng.randint(0, 60):] + rng.choice(base)[:rng.randint(0, 80)]
        elif kind < 0.6:
            for _ in range(rng.randint(1, 6)):
                i = rng.randrange(len(t) + 1)
                t = t[:i] + rng.choice(letters) + t[i + 1:]
        elif kind < 0.7:
            t += t
        texts.append(t)
    docs = table(list(enumerate(texts)), "doc_id long, text string", files=5)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, length=length, trigger=trigger, period=period).collect()}
    for k, (spans, kept) in enumerate(removed(texts, length)):
        assert ([(s["first"], s["last"]) for s in got[k]["spans"]], bytes(got[k]["kept"])) == (spans, kept), k


def test_corpus_order_is_exact():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    shape = suffix_dedup.Shape(40, 6, 9)
    parse = suffix_dedup.Parse(data, np.array([0, len(data)]), shape)
    own = parse.first
    starts, classes = suffix_dedup.corpus_order(data, parse.at[own], parse.least[own], parse.most[own], shape)
    by_class, by_text = {}, {}
    for s, c in zip(starts.tolist(), classes.tolist()):
        by_class.setdefault(c, set()).add(s)
        by_text.setdefault((data[s:s + 40].tobytes()), set()).add(s)
    assert sorted(map(sorted, by_class.values())) == sorted(map(sorted, by_text.values()))
    assert sorted([*starts.tolist(), *parse.plain().tolist()]) == list(range(len(data) - 39))


# --- n-gram join ---------------------------------------------------------------------------

def grams(text, n=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def classes_of(texts, percent=85, n=4):
    sets, up = [grams(t, n) for t in texts], list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(k) for k in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("tile", [2, 7, 512])
def test_ngram_join(table, tile):
    rng = random.Random(tile)
    vocabulary = [f"w{k}" for k in range(300)]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (1, 2, 3, 4, 5, 9, 20, 40, 60, 90, 130)]
    texts = [None, "", "  "]
    for _ in range(220):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(rng.choice([" ", "\n"]).join(w).upper() if rng.random() < 0.2 else " ".join(w))
    rng.shuffle(texts)
    docs = table(list(enumerate(texts)), "doc_id long, text string", files=4)
    want, sizes = classes_of(texts)
    got = {r["doc_id"]: r for r in ngram_join.join_documents(docs, tile=tile).collect()}
    assert [got[k]["component_id"] for k in range(len(texts))] == want
    assert [got[k]["n_shingles"] for k in range(len(texts))] == sizes


def test_chain_of_near_copies(table):
    """Each text is linked to its neighbours only; the chain is one component across chunks."""
    words_ = [f"v{k}" for k in range(200)]
    texts = [" ".join(words_[k:k + 60]) for k in range(0, 120, 2)]
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    want, _ = classes_of(texts)
    assert set(want) == {0} and len(grams(texts[0]) & grams(texts[-1])) == 0
    assert {r["component_id"] for r in ngram_join.join_documents(docs, tile=6).collect()} == {0}


def test_dual_traversal_loses_no_pair():
    rng = np.random.default_rng(2)
    pool = rng.integers(1, 1 << 63, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(pool[:60 * (1 + k % 5)], rng.integers(1, 50))) for k in range(90)]
    a, b = SignatureTree(sets[:40]), SignatureTree(sets[40:])

    def linked(x, y):
        both = len(np.intersect1d(x, y))
        return 100 * both >= 50 * (len(x) + len(y) - both)

    for t, u, pairs in ((a, a, {(i, j) for i in range(40) for j in range(i + 1, 40)}), (a, b, {(i, j) for i in range(40) for j in range(50)})):
        kept = {p for i, j in dual_traversal(t, u, 50) for p in zip(i.tolist(), j.tolist())}
        assert kept <= pairs and {p for p in pairs if linked(t.sets[p[0]], u.sets[p[1]])} <= kept


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)] + [(None, 3), (5, 5)]
    up = list(range(500))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in edges if a is not None and a != b for x in (a, b)}


def test_words_across_rows_and_chunks():
    texts = ["ab", "c d", "", "E\tF\x0bg", "x" * (3 << 20) + " y", "é"]
    data, offsets = string_bytes(pa.array(texts))
    starts, ends, h = words(data, offsets)
    assert [data[a:b].tobytes().decode() for a, b in zip(starts, ends)] == ["ab", "c", "d", "E", "F", "g", "x" * (3 << 20), "y", "é"]
    again = words(*string_bytes(pa.array(["e f", "ab"])))[2]
    assert h[[3, 4, 0]].tolist() == again.tolist()


# --- line dedup ----------------------------------------------------------------------------

def test_cuckoo_filter():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    f = line_dedup.CuckooFilter.sized(5000)
    assert f.insert(keys) and f.may_hold(keys).all()
    other = rng.integers(0, 1 << 63, (20000, 2)).astype(np.uint64)
    assert f.may_hold(other).mean() < 0.01
    f.delete(keys[:2500])
    assert line_dedup.CuckooFilter.load(f.dump()).may_hold(keys[2500:]).all() and f.may_hold(keys[:2500]).mean() < 0.01
    f.delete(keys[2500:])
    assert not f.table.any()


def cleaned(texts):
    key = lambda x: (lambda k: k if len(k) >= 10 else None)(x.strip(" \t\n\x0b\x0c\r"))
    holders = {}
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if k := key(line):
                holders.setdefault(k.encode().lower(), set()).add(d)
    return {d: "\n".join(x for x in (t or "").split("\n") if not (key(x) and d != min(holders[key(x).encode().lower()]))) for d, t in texts.items()}


def test_line_store_is_reversible(table, spark):
    rng = random.Random(8)
    lines = [f"line number {k} of the pool" for k in range(60)] + ["short", "", "  Line NUMBER 3 of the pool \t"]
    texts = {d: "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 9))) for d in range(80)}
    part = lambda ids: table([(d, texts[d]) for d in ids], "doc_id long, text string")
    answer = lambda store: {(bytes(r["key"]), r["keeper"], r["n_docs"]) for r in store.repeated().collect()}
    first, second = part(range(10, 50)), part([*range(0, 10), *range(50, 80)])
    store = line_dedup.LineStore(spark, 3).insert(first)
    before = answer(store)
    store.insert(second)
    whole = line_dedup.LineStore(spark, 3).insert(part(range(80)))
    assert answer(store) == answer(whole)
    everything = part(range(80))
    assert {r["doc_id"]: r["text"] for r in store.clean(everything).collect()} == cleaned(texts)
    assert answer(store.insert(second)) == answer(whole)  # inserting again changes nothing
    store.delete(second.select("doc_id"))
    assert answer(store) == before
    keys = {r["shard"]: r["n_keys"] for r in store.filters.collect()}
    assert {s: n for s, n in keys.items() if n} == Counter(r["shard"] for r in store.counts.collect())
    store.delete(first.select("doc_id"))
    assert store.counts.count() == 0 and all(not line_dedup.CuckooFilter.load(r["filter"]).table.any() for r in store.filters.collect())


def test_line_store_grows_by_what_changes(table, spark):
    lines = [f"line number {k} of the pool" for k in range(400)]
    first = table([(d, "\n".join(lines[d * 4:d * 4 + 6])) for d in range(90)], "doc_id long, text string")
    store = line_dedup.LineStore(spark, 50).insert(first)
    files = lambda df: {f: os.path.getmtime(f[7:]) for f in df.inputFiles()}
    at = {name: files(parts[0]) for name, parts in store.segments.items() if parts}
    # three keys, of which one is new; a document that comes again
    store.insert(table([(500, "\n".join([lines[0], lines[1], "a line of its own"])), (0, "\n".join(lines[:6]))], "doc_id long, text string"))
    last = {name: parts[-1] for name, parts in store.segments.items() if parts}
    keys = {line_dedup.line_key(x) for x in (lines[0], lines[1], "a line of its own")}
    assert {bytes(r["key"]): (r["n_docs"], r["keeper"]) for r in last["counts"].collect()} == {k: (1, 500) for k in keys}
    seen = {line_dedup.line_key(x) for x in [*lines[:6], "a line of its own"]}
    shards = {r["shard"] for r in store.counts.collect() if bytes(r["key"]) in seen}
    assert {r["shard"] for r in last["filters"].collect()} == shards and len(shards) <= 7
    # a deletion rewrites the shards of the document's lines only
    store.delete(table([(500,)], "doc_id long"))
    last = {name: parts[-1] for name, parts in store.segments.items()}
    shards = {r["shard"] for r in last["bases"].collect()}
    assert len(shards) <= 3 and all({r["shard"] for r in last[name].collect()} <= shards for name in ("refs", "counts", "filters"))
    # what the first insertion wrote is as it was
    assert all(files(store.segments[name][0]) == old for name, old in at.items())
    answer = lambda s: {(bytes(r["key"]), r["keeper"], r["n_docs"]) for r in s.counts.collect()}
    plain = answer(line_dedup.LineStore(spark, 50).insert(first))
    assert answer(store) == plain == answer(store.compact()) and all(len(p) < 2 for p in store.segments.values())


def test_line_store_outgrows_its_filters(table, spark):
    rows = lambda ids: table([(d, "\n".join(f"line {d} and {k} of many" for k in range(40))) for d in ids], "doc_id long, text string")
    store = line_dedup.LineStore(spark, 2).insert(rows(range(2))).insert(rows(range(1, 30)))
    found = {r["shard"]: (line_dedup.CuckooFilter.load(r["filter"]), r["n_keys"]) for r in store.filters.collect()}
    held = {}
    for r in store.counts.collect():
        held.setdefault(r["shard"], []).append(bytes(r["key"]))
    assert sum(map(len, held.values())) == 1200
    for shard, keys in held.items():
        index, n = found[shard]
        assert n == len(keys) and index.may_hold(line_dedup._halves(keys)).all()


# --- decontamination, toxicity ---------------------------------------------------------------

def test_wu_manber(table):
    rng = random.Random(6)
    vocabulary = ["a", "b", "c", "d1", "é"]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 9))) for _ in range(30)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 700))) for _ in range(30)] + ["A, b! C? d1 (é)"]
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower())
    patterns = {}
    for k, t in enumerate(items):
        w = split(t)
        for i in range(max(1, len(w) - 4)) if w else ():
            patterns.setdefault(tuple(w[i:i + 5]), set()).add(str(k))
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    benchmark = table(list(enumerate(items)), "item_id long, text string")
    for group_bytes in (1 << 20, 200):
        got = {r["doc_id"]: r for r in decontaminate.find_benchmark(docs, benchmark, window=5, group_bytes=group_bytes).collect()}
        for k, t in enumerate(texts):
            w, hit, names = split(t), set(), set()
            for n in {len(p) for p in patterns}:
                for i in range(len(w) - n + 1):
                    if tuple(w[i:i + n]) in patterns:
                        hit |= set(range(i, i + n))
                        names |= patterns[tuple(w[i:i + n])]
            r = got[k]
            assert (r["n_words"], r["n_hit"], r["items"]) == (len(w), len(hit), sorted(names))
            assert {x for s in r["spans"] for x in range(s["first"], s["last"] + 1)} == hit


def test_folding_and_exceptions():
    assert toxicity.fold("ID1OT 1d10t іdіоt pa​th3tic 2010 b@d") == ["idiot", "idiot", "idiot", "pathetic", "2010", "bad"]
    lexicon = toxicity.Lexicon({" scum ": 5.0, " lowei": 4.0}, frozenset({" pond scum "}), slope=2.0, intercept=-4.0)
    hits = lambda t: lexicon.hits(toxicity.fold(t))
    assert hits("pond scum") == [] and hits("you scum") == [(4, 5.0)] and hits("pond scum scum") == [(10, 5.0)]
    assert hits("loweischaft xlowei scumbag") == [(0, 4.0)]
    raw = [lexicon.raw(toxicity.fold(t), hits(t)) for t in ("", "fine words", "scum " + "fine " * 200, "scum scum", "scum")]
    assert raw[0] == raw[1] == 0 < raw[2] < raw[3] < raw[4]
    assert 0 < lexicon.probability(0) < lexicon.probability(raw[4]) < 1


def test_exceptions_are_learned(table):
    rows = [("you are scum indeed friend", 1)] * 30 + [("the pond scum is green", 0)] * 40 + [("plain words without harm", 0)] * 60
    rows = [(t + f" n{k}", y) for k, (t, y) in enumerate(rows)]
    lexicon = toxicity.learn(table(rows, "text string, toxic int"))
    assert all(" scum " != t for t in lexicon.terms) or " pond scum " in lexicon.exceptions
    score = lambda t: lexicon.probability(lexicon.raw(toxicity.fold(t), lexicon.hits(toxicity.fold(t))))
    assert score("you are scum indeed friend") >= 0.3 > score("the pond scum is green")


# --- pipeline ------------------------------------------------------------------------------

def test_pipeline_stages(spark, tmp_path):
    """Each stage's decisions, recomputed from its input by brute force at sf0.001."""
    import corpus_pipeline as P
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = {}
    for name, stage in P.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf).write.parquet(path)
        seen[name] = (docs, docs := spark.read.parquet(path))
    for name, (before, after) in seen.items():
        if name != "token_records":
            assert after.dtypes == before.dtypes
    texts = lambda df: {r["doc_id"]: r["text"] for r in df.collect()}
    before, after = seen["toxicity"]
    lexicon = toxicity.learn(toxicity.training_rows(before, spark.read.parquet(f"{sf}/labels.parquet")))
    low = lambda t: lexicon.probability(lexicon.raw(toxicity.fold(t), lexicon.hits(toxicity.fold(t)))) < 0.3
    assert texts(after) == {k: t for k, t in texts(before).items() if low(t)}
    before, after = map(texts, seen["ngram_jaccard_join"])
    ids = sorted(before)
    roots, _ = classes_of([before[k] for k in ids], percent=80, n=5)
    assert after == {k: before[k] for n, k in enumerate(ids) if roots[n] == n}
    before, after = map(texts, seen["benchmark_decontamination"])
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {tuple(w[i:i + 13]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect() for w in [split(r["text"])] for i in range(max(1, len(w) - 12)) if w}

    def contaminated(text):
        w, hit = split(text), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
        return bool(hit) and 20 * len(hit) >= len(w)

    assert after == {k: t for k, t in before.items() if not contaminated(t)}
    before, after = seen["source_mixing"]
    rows = {r["doc_id"]: r for r in before.collect()}
    copies = Counter(r["doc_id"] for r in after.collect())
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total, taken = Counter(), Counter()
    for k, r in rows.items():
        total[r["source"]] += size(r["text"])
        taken[r["source"]] += copies[k] * size(r["text"])
    assert set(copies) <= set(rows) and max(copies.values()) <= 2
    assert abs(sum(taken.values()) - 1.5 * sum(total.values())) <= 0.1 * 1.5 * sum(total.values()) and all(taken[s] <= 2 * total[s] for s in total)
    before, after = seen["token_records"]
    import public_tokenizers
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in before.collect())
    assert Counter((r["doc_id"], r["n_tokens"]) for r in after.collect()) == want


def test_pipeline_stages_on_odd_rows(spark, table, tmp_path):
    """Nulls in any column, repeats, clashing columns and an empty table pass through every stage."""
    import corpus_pipeline as P
    from llm_fixtures import DOC_SCHEMA, odd_docs
    table([(k, 0, int(k == 1)) for k in range(11)] + [(None, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table([(1, "repeat me exactly please now"), (None, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd_docs() + [(None,) * 11], []):
        docs = table(rows, DOC_SCHEMA)
        counts = []
        for name, stage in P.STAGES:
            path = str(tmp_path / f"{name}-{len(rows)}")
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            columns, docs = docs.columns, spark.read.parquet(path)
            counts.append(docs.count())
            assert name == "token_records" or docs.columns == columns
        assert (counts[-1] > 0) == bool(rows) and counts[0] >= counts[1] >= counts[2]


def test_pipeline_takes_near_copies_from_80_percent_of_five_words(spark, table):
    import corpus_pipeline as P
    base = [f"w{k}" for k in range(200)]
    near, far = list(base), list(base)
    near[50:65] = [f"x{k}" for k in range(15)]
    far[50:75] = [f"y{k}" for k in range(25)]
    texts = [" ".join(t) for t in (base, near, far)]
    share = lambda n, k: (lambda a, b: len(a & b) / len(a | b))(grams(texts[0], n), grams(texts[k], n))
    assert share(4, 1) < 0.85 and share(5, 1) >= 0.8 > share(5, 2)
    docs = table(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in P.drop_near_copies(spark, docs, "").collect()) == [0, 2]
    assert len({r["component_id"] for r in ngram_join.join_documents(docs).collect()}) == 3


def test_benchmark_groups_judge_each_row_for_itself(table):
    """Repeated ids, null ids and repeated rows give the same rows by one pass or by many."""
    rng = random.Random(9)
    items = [(k, " ".join(rng.choice("abcdef") for _ in range(9))) for k in range(20)] + [(3, "a b"), (3, "a b"), (None, "")]
    texts = [" ".join(rng.choice("abcdef") for _ in range(rng.randint(0, 300))) for _ in range(30)]
    docs = table([(None if k % 5 == 0 else k % 3, t, k % 2) for k, t in enumerate(texts)] + [(7, texts[1], 1)] * 3, "doc_id long, text string, row long")
    benchmark = table(items, "item_id long, text string")

    def found(**how):
        got = decontaminate.find_benchmark(docs, benchmark, window=5, keep=("text", "row"), **how).collect()
        return Counter(repr(sorted(r.asDict(recursive=True).items())) for r in got)

    assert sum(found().values()) == len(texts) + 3
    assert found(group_bytes=60) == found()


def test_wu_manber_tables_grow_with_the_windows():
    rng = np.random.default_rng(3)
    text = " ".join(map(str, rng.integers(0, 1 << 20, 40000)))
    (index, first, owners), = decontaminate.build([("1", text)])
    held = [x for x in [*vars(index).values(), first, owners] if isinstance(x, np.ndarray)]
    assert sum(x.nbytes for x in held) < 80 * 40000


def test_rows_repeated_over_blocks_send_their_windows(spark, table):
    """Rows of one id and text in several blocks beside documents that share a part of them."""
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rows = []
    for k in range(60):
        base = text(200)
        i = rng.randint(1, 60)
        rows += [(None if k % 3 == 0 else k, base)] * 3 + [(1000 + k, text(50) + base[i:i + rng.randint(60, 120)] + text(50))]
    docs = table(rows, "doc_id long, text string", files=8)
    with many_partitions(spark):
        got = Counter((r["doc_id"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs, length=40, trigger=6, period=9).collect())
    assert got == Counter((i, kept) for (i, _), (_, kept) in zip(rows, removed([t for _, t in rows], 40)))
