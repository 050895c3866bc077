"""Corpus operators against brute-force versions on small tables with nulls, empty and long texts, ties, repeated rows,
empty tables and extra columns whose names clash with working columns."""

import base64
import hashlib
import math
import os
import random
import zlib
from collections import Counter, defaultdict
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from cohortlens.llm import (bit_sliced, kneser_ney, packing, piece_transducer, quality_rules, sharding, suffix_dedup,
                            tensored_minhash, textkit, toxicity, warc)
from cohortlens.llm.components import connected, joined
from cohortlens.llm.shared import small_batches
from cohortlens.session import ensure_checkpoint_dir

public_tokenizers = pytest.importorskip("public_tokenizers")
WORDS = [f"w{i}" for i in range(400)]
#: Names that the operators use inside; an input may hold them as columns of its own.
CLASH = ["key", "n", "sig", "component", "rep", "spans", "shard", "cell", "size", "tokens", "bits", "clauses", "parts", "rank"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in CLASH)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def table(spark, rows):
    full = [(i, t, lang, src, len(t or ""), *[7] * len(CLASH)) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    out = [(0, None, "en", "a"), (1, "", None, None), (2, "  \n ", "en", "a"), (3, "one two", "en", "a"), (4, "ONE two", "de", "b")]
    shared = prose(rng, 60)
    for i in range(5, 60):
        text = prose(rng, rng.choice([3, 30, 120]))
        if i % 4 == 0:
            text = text + " " + shared + "\n" + prose(rng, 10)
        if i % 5 == 0 and i > 10:
            text = out[i - 5][1] or text
        if i % 7 == 0:
            words = (out[i - 1][1] or "x").split()
            words[len(words) // 2:len(words) // 2 + 1] = ["édité"]
            text = " ".join(words)
        out.append((i, text, rng.choice(["en", "de", None]), rng.choice(["a", "b"])))
    out.append((60, "aaaa " * 300, "en", "a"))
    out.append((61, "é" * 500, "fr", "b"))
    out.append((62, prose(rng, 4000), "en", "a"))
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return table(spark, rows).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


# 1

def test_sharding_balances_and_keeps_groups(spark, rows):
    rng = random.Random(1)
    many = rows + [(100 + i, prose(rng, rng.randint(1, 200)), "en", "a") for i in range(800)] + [(2000 + i, "copy of all", "en", "a") for i in range(20)]
    got = sharding.assign_shards(table(spark, many), shards=6, cell_rows=200).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, *_ in many)
    texts = {i: t or "" for i, t, *_ in many}
    load, slots, home = Counter(), defaultdict(list), defaultdict(set)
    for r in got:
        raw = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        home[raw].add(r["shard"])
    assert max(load.values()) < 1.03 * min(load.values()) and len(load) == 6
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in home.values())


def test_sharding_splits_only_a_group_beyond_a_share(spark):
    many = [(i, "x" * 100, "en", "a") for i in range(300)] + [(1000 + i, f"text {i} " * 5, "en", "a") for i in range(100)]
    got = sharding.assign_shards(table(spark, many), shards=4).collect()
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert max(load.values()) < 1.15 * min(load.values())


def test_sharding_balances_rows_and_tokens_of_hot_short_copies(spark):
    """A third of the rows are copies of one short text with few of the bytes: no shard gets them all."""
    rng = random.Random(8)
    many = [(i, prose(rng, rng.randint(50, 300)), "en", "a") for i in range(1000)] + [(5000 + i, "one short text", "en", "a") for i in range(500)]
    got = sharding.assign_shards(table(spark, many)).collect()
    words = {i: t.count(" ") + 1 for i, t, *_ in many}
    for measure in (lambda r: r["size"], lambda r: words[r["doc_id"]], lambda r: 1):
        load = Counter()
        for r in got:
            load[r["shard"]] += measure(r)
        mean = sum(load.values()) / 24
        assert len(load) == 24 and 0.9 * mean < min(load.values()) and max(load.values()) < 1.1 * mean


def test_sharding_empty(empty):
    assert sharding.assign_shards(empty).collect() == []


# 2

def test_loser_tree_merges():
    rng = random.Random(3)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.randint(0, 50) for _ in range(rng.randint(0, 20))) for _ in range(k)]
        assert list(warc.LoserTree(runs, lambda x: x)) == sorted(x for r in runs for x in r)


def test_url_key():
    assert warc.url_key("HTTPS://user@WWW.Example.com:443/a/B?x=1#top") == "com,example)/a/B?x=1"
    assert warc.url_key("example.com:8080") == "com,example:8080)/"
    assert warc.url_key("") == ")/"


def test_warc_round_trip(spark):
    pages = [(5, "http://b.org/x", "<p>é\r\n\r\nWARC/1.1\r\n\r\n</p>"), (3, "http://a.org/", "same"), (9, "http://a.org/", "same"), (4, None, None),
             (7, "http://a.org/2", ""), (8, "http://www.a.org/", "other " * 5000), (1, "http://c.org", "same")]
    frame = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, sha1 int").repartition(3)
    got = sorted(warc.archive_and_index(frame).collect(), key=lambda r: r["index_pos"])
    first = {}
    for i, _, h in sorted(pages):
        first.setdefault(h or "", i)
    assert [r["index_pos"] for r in got] == list(range(len(pages)))
    keys = [(r["url_key"], r["captured"], r["page_id"]) for r in got]
    assert keys == sorted(keys)
    by_page = {p: (u, (h or "").encode(), h or "") for p, u, h in pages}
    for r in got:
        _, raw, h = by_page[r["page_id"]]
        assert r["payload_bytes"] == len(raw)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        same = first[h] == r["page_id"]
        assert (r["record_type"], r["refers_to"]) == (("response", None) if same else ("revisit", first[h]))


def test_warc_pages_without_id_far_ids_and_odd_urls(spark):
    pages = [(None, "http://a.b/x\ty", "same"), (7, "http://a.b/x\ty", "same"), (9, "http://a.b/%09", "same"), (None, None, None),
             (10**15, "http://c.d/", "far"), (3 * 10**11, "http://c.d/", "far"), (5, "http://c.d/", "near")]
    got = warc.archive_and_index(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(got) == len(pages) and sorted(r["index_pos"] for r in got) == list(range(len(pages)))
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in got)
    assert kinds == Counter([(None, "response", None), (None, "response", None), (7, "response", None), (9, "revisit", 7),
                             (3 * 10**11, "response", None), (10**15, "revisit", 3 * 10**11), (5, "response", None)])
    assert {r["url"]: r["url_key"] for r in got if r["page_id"] in (7, 9)} == {"http://a.b/x\ty": "b,a)/x\ty", "http://a.b/%09": "b,a)/%09"}
    assert all(len(r["captured"]) == 20 for r in got)
    order = [(r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0) for r in sorted(got, key=lambda r: r["index_pos"])]
    assert order == sorted(order)


def test_warc_empty(spark):
    assert warc.archive_and_index(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


# 3

def test_pieces_equal_the_library(spark, rows, docs, empty):
    sentencepiece = pytest.importorskip("sentencepiece")
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    model = piece_transducer.PieceTransducer(path, cache=50)
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz   ..,'\"()0123456789AEéñ日😀\t\n_-=²"
    for text in ["".join(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(500)] + [" " * k for k in range(40)]:
        assert model.encode(text).tolist() == library.encode(text)
        assert model.decode(model.encode(text)) == text
    got = by_id(piece_transducer.encode_and_decode(docs, path))
    for i, t, *_ in rows:
        ids = np.array(library.encode(t or ""), "<u4")
        assert (got[i]["n_ids"], got[i]["ids_crc32"], got[i]["round_trip"]) == (len(ids), zlib.crc32(ids.tobytes()), True)
    assert piece_transducer.encode_and_decode(empty, path).collect() == []


# 4

def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    vectors = [(i, rng.normal(0, 0.3, 9).tolist()) for i in range(300)]
    vectors[7] = (7, None)
    vectors[8] = (8, [0.1, None] + [0.0] * 7)
    vectors[9] = (9, [float("nan")] * 9)
    vectors[10] = (10, [float("inf")] * 9)
    vectors[11] = (11, [0.5, -0.5])
    vectors[12] = (12, [])
    vectors[13] = vectors[14] = (13, vectors[20][1])  # a repeated row, equal to another vector
    without_id = [(None, vectors[20][1], 0, 0), (None, None, 0, 0)]
    frame = spark.createDataFrame([(*v, 0, 0) for v in vectors] + without_id, "vec_id long, embedding array<double>, q int, asked int")
    from pyspark.sql import functions as F
    got = bit_sliced.top_k(frame, F.col("vec_id") % 20 == 0, k=10, block_rows=40, batch_queries=4).collect()
    usable = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for qid, q in usable:
        if qid % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), i) for i, v in usable if i != qid)[:10]
            want += [(qid, r + 1, i, -s) for r, (s, i) in enumerate(scores)]
    assert sorted(map(tuple, got)) == sorted(want)
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert bit_sliced.top_k(none, F.col("vec_id") % 20 == 0).collect() == []


# 5

def removed(rows, length):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        mark = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            if raw[p:p + length] in seen:
                mark[p:p + length] = b"\1" * length
            seen.add(raw[p:p + length])
        left = bytes(b for b, m in zip(raw, mark, strict=True) if not m)
        runs = sum(1 for k, m in enumerate(mark) if m and (not k or not mark[k - 1]))
        out[i] = (len(raw), len(raw) - len(left), runs, hashlib.sha256(left).hexdigest(), left)
    return out


@pytest.mark.parametrize("chunk", [3, 20_000])
def test_repeats_equal_brute_force(monkeypatch, rows, docs, chunk):
    want = removed(rows, 100)
    assert sum(w[1] for w in want.values()) > 1000
    original = suffix_dedup.repeated_spans
    monkeypatch.setattr(suffix_dedup, "repeated_spans", lambda d, length: original(d, length, chunk=chunk))
    got = by_id(suffix_dedup.removal_digest(docs))
    assert {i: tuple(r)[1:] for i, r in got.items()} == {i: w[:4] for i, w in want.items()}
    kept = suffix_dedup.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in kept.collect()} == {
        i: None if t is None else want[i][4].decode(errors="ignore") for i, t, *_ in rows}


def test_repeats_of_one_row_given_twice(spark):
    rng = random.Random(4)
    text = prose(rng, 100)
    got = suffix_dedup.removal_digest(table(spark, [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "a")])).collect()
    assert sorted((r["doc_id"], r["n_removed"]) for r in got) == [(1, 0), (1, 0), (2, len(text))]


def test_rows_without_id_keep_their_texts(spark):
    text = prose(random.Random(3), 80)
    frame = spark.createDataFrame([(None, text), (None, text), (4, text), (6, text), (None, None)], "doc_id long, text string")
    got = Counter((r["doc_id"], r["n_removed"]) for r in suffix_dedup.removal_digest(frame).collect())
    assert got == Counter({(None, 0): 3, (4, 0): 1, (6, len(text)): 1})
    assert sorted(r["text"] or "" for r in suffix_dedup.remove_repeats(frame).collect()) == sorted([text, text, text, "", ""])


def test_long_texts_in_pieces(monkeypatch):
    rng = random.Random(6)
    text = prose(rng, 3000) * 2
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], names=["doc_id", "text"])
    monkeypatch.setattr(suffix_dedup, "_PIECE", 5000)
    out = pa.Table.from_batches(list(suffix_dedup._anchor_task(100)(iter([batch])))).to_pandas()
    keys = out[out.place >= 0]
    starts = sorted(s for p in keys.place for s in range(p >> 8, (p >> 8) + (p & 255)))
    spans = [s for p, e in zip(out.place[out.place < 0], out.block[out.place < 0], strict=True) for s in range(-p - 1, e - 99)]
    assert set(starts) | set(spans) == set(range(len(text) - 99))


def test_repeats_empty(empty):
    assert suffix_dedup.removal_digest(empty).collect() == []


# 6

def test_grammar_scores_clauses():
    scorer = toxicity.Scorer({"idiot": 3.0, "scum": 2.0})
    plain, targeted, negated, reported = (scorer.score(t)[0] for t in (
        "what an idiot", "you are an idiot", "this is not an idiot", "somebody said idiot"))
    assert (plain, targeted, negated, reported) == (3.0, 3.75, pytest.approx(1.2), pytest.approx(1.8))
    assert scorer.score("not here. an idiot there")[0] == 3.0  # a negation ends with its clause
    assert scorer.score("I will kill the process, idiots")[0] == toxicity.THREAT_WEIGHT + 3.0
    assert scorer.score("skill, antidiot")[0] == 0.0  # stems start a word
    assert scorer.score("")[0] == 0.0


def test_toxicity_learns_and_scores(spark, rows, empty):
    rng = random.Random(8)
    texts, labels = [], []
    for i in range(400):
        words = prose(rng, rng.randint(20, 120)).split()
        if i % 5 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["Bozo", "zork" + rng.choice("abc"), "zork"]))
        texts.append((i, " ".join(words), "en", "a"))
        labels.append((i, int(i % 5 == 0), 1))
    docs, marks = table(spark, texts + [(1000 + i, t, a, b) for i, t, a, b in rows]), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    model = toxicity.train(docs, marks.where(~toxicity.held_out("doc_id")))
    got = by_id(toxicity.score(docs, model))
    assert all(got[i]["predicted"] == t for i, t, _ in labels)
    assert not any(got[1000 + i]["predicted"] for i, *_ in rows)
    assert got[1000]["score"] == got[1001]["score"]  # null and empty
    assert toxicity.keep_clean(docs, model).columns == docs.columns
    doubted = marks.unionByName(marks.where("toxic = 1").selectExpr("doc_id", "0 AS toxic", "quality"))  # the higher label counts
    again = toxicity.train(docs, doubted.where(~toxicity.held_out("doc_id")))
    assert again[0] == model[0] and np.allclose(again[1], model[1])
    assert toxicity.train(empty, marks) is None
    assert toxicity.score(empty, None).collect() == []
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


# 7

def test_packing_holds_every_id_once(spark, rows, docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokens = Tokenizer.from_file(path)
    odd = [(900, "it's I'LL <|endoftext|> İx ½ 日本 \t a\x00b", "en", "a")]
    got = packing.pack(docs.unionByName(table(spark, odd)), path, size=256, open_windows=4, merge_tasks=2, with_ids=True).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        assert r["ids_crc32"] == zlib.crc32(bytes(r["ids"])) and r["length"] * 4 == len(r["ids"])
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t, *_ in rows + odd:
        want = tokens.encode(t or "", add_special_tokens=False).ids + [2]
        parts = sorted(pieces[i], key=lambda r: r["start"])
        assert np.frombuffer(b"".join(bytes(p["ids"]) for p in parts), "<u4").tolist() == want
        assert [p["start"] for p in parts] == list(np.cumsum([0] + [p["length"] for p in parts])[:-1])
        assert {p["doc_tokens"] for p in parts} == {len(want)}
    for w in windows.values():
        w.sort()
        assert [o for o, _ in w] == list(np.cumsum([0] + [n for _, n in w])[:-1]) and sum(n for _, n in w) <= 256
    total = sum(r["length"] for r in got)
    assert total > 0.93 * 256 * len(windows)
    assert packing.pack(empty, path).collect() == []


# 8

def linked(rows, width, percent):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t, *_ in rows:
        words = (t or "").translate(table).encode().split()
        sets[i] = {tuple(words[k:k + width]) for k in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} if words else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((find(x), find(y)))
                    root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("block", [2, 512])
def test_near_duplicates_equal_brute_force(spark, rows, block):
    rng = random.Random(12)
    more, base = [], prose(rng, 150).split()
    for k in range(60):  # a drifting family: neighbours are close, its ends are not
        base = list(base)
        for _ in range(3):
            base[rng.randrange(len(base))] = rng.choice(WORDS)
        more.append((200 + k, " ".join(base), "en", "a"))
    more += [(300 + k, more[0][1].upper(), "en", "a") for k in range(30)]
    both = rows + more
    got = by_id(tensored_minhash.near_duplicates(table(spark, both), block=block))
    want = linked(both, 5, 75)
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_pairs_with_unlucky_signatures_are_given_out():
    """A pair that shares one table only is a candidate, however little its signatures agree, if its sets can be similar."""
    rng = np.random.default_rng(4)
    x = np.sort(rng.integers(0, 1 << 63, 200, dtype=np.uint64))
    y = np.sort(np.concatenate([x[:172], rng.integers(0, 1 << 63, 28, dtype=np.uint64)]))  # 172 of 228: 0.754
    far = np.sort(np.concatenate([x[:100], rng.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    sig = np.arange(3 * 44, dtype=np.uint32).reshape(3, 44)
    for k in (0, 1, 22, 23):  # the first sub-key of both collections
        sig[:, k] = 7
    parity = [tensored_minhash.parity_bits(s).tobytes() for s in (x, y, far)]
    same = pa.array(np.zeros(3, np.int64))
    rows = pa.table({"key": same, "i": same, "j": same, "sub": same, "slot": same, "rep": [1, 2, 3], "component": [1, 2, 3],
                     "n": [200] * 3, "sig": [s.tobytes() for s in sig], "parity": parity})
    got = tensored_minhash._pairs(rows, ["key", "i", "j"], 24, 75, False)
    assert list(zip(got.column("a").to_pylist(), got.column("b").to_pylist(), strict=True)) == [(1, 2)]


def test_parities_never_rule_out_similar_sets():
    rng = np.random.default_rng(5)
    dropped = 0
    for _ in range(2000):
        n = int(rng.integers(1, 3000))
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[int(n * rng.uniform(0, 0.3)):], rng.integers(0, 1 << 63, int(n * rng.uniform(0, 0.2)), dtype=np.uint64)])
        both = len(np.intersect1d(x, y))
        similar = 100 * both >= 75 * (n + len(y) - both)
        may = tensored_minhash.can_link(tensored_minhash.parity_bits(x), tensored_minhash.parity_bits(y), n, len(y), 75)
        assert may or not similar
        dropped += not may
    assert dropped > 200


def test_near_duplicates_empty(empty):
    assert tensored_minhash.near_duplicates(empty).collect() == []


def test_components_of_a_path(spark):
    edges = [(i, i + 1) for i in range(1, 120)] + [(500, 400), (400, 450), (7, 7)]
    got = dict(connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 121)}, 400: 400, 450: 400, 500: 400}


def test_components_after_more_links(spark):
    """The components of all links, whether known ones are joined, a vertex is new, or a link is inside a component."""
    rng = random.Random(3)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(30)]
    more = [(rng.randrange(90), rng.randrange(90)) for _ in range(25)] + first[:2]
    few, many, both = (spark.createDataFrame(e, "a long, b long") for e in (first, more, first + more))
    assert sorted(joined(connected(few), many).collect()) == sorted(connected(both).collect())
    assert sorted(joined(connected(few.limit(0)), many).collect()) == sorted(connected(many).collect())


def left_on_disk(spark):
    """(folders of stored steps, shuffle files): what the session's queries have not deleted."""
    folders = [f for f in os.listdir(urlparse(ensure_checkpoint_dir(spark)).path) if f.startswith("step-")]
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return len(folders), sum(os.path.basename(b).startswith("shuffle_") for b in blocks)


def test_near_duplicates_leave_no_steps_behind(spark, rows):
    """Two folders stay for the result to read; all other steps and every shuffle are gone when it is returned."""
    docs = table(spark, rows)
    folders, files = left_on_disk(spark)
    out = tensored_minhash.near_duplicates(docs)
    after = left_on_disk(spark)
    assert after[0] <= folders + 2 and after[1] <= files
    assert out.count() == len(rows) == out.count()


def test_repeats_leave_no_shuffles_behind(spark, rows):
    docs = table(spark, rows)
    _, files = left_on_disk(spark)
    out = suffix_dedup.removal_digest(docs)
    assert left_on_disk(spark)[1] <= files
    assert out.count() == len(rows) == out.count()


# 9

def reference_model(counts):
    """Interpolated modified Kneser-Ney by its definition, over tuples of symbols."""
    order = kneser_ney.ORDER
    tables = {order: Counter(counts)}
    for o in range(order - 1, 0, -1):
        tables[o] = Counter(g[1:] for g in tables[o + 1])
    cuts = {o: kneser_ney.discounts(tuple(sum(1 for n in t.values() if n == i) for i in (1, 2, 3, 4))) for o, t in tables.items()}

    def p(gram):
        o = len(gram)
        if not o:
            return 2.0 ** -kneser_ney.BITS
        same = {g: n for g, n in tables[o].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total, cut = sum(same.values()), cuts[o]
        held = sum(min(cut[min(n, 3) - 1], n) for n in same.values())
        n = same.get(gram, 0)
        return (max(n - cut[min(n, 3) - 1], 0) if n else 0) / total + held / total * p(gram[1:])
    return p


def test_probabilities_follow_the_definition(spark):
    text = "the cat sat on the mat. the the cat ran, and a dog sat on a log"
    data, offs = textkit.text_buffer(pa.array([text]))
    grams = kneser_ney.grams(data, offs).tolist()
    split = lambda k: tuple((k >> (6 * (3 - i))) & 63 for i in range(4))
    counts = Counter(grams)
    unseen = [g ^ 5 for g in grams[:10]] + [123456]
    p = reference_model({split(k): n for k, n in counts.items()})
    got = kneser_ney.probabilities(spark.createDataFrame(list(counts.items()), "k int, n long"),
                                   spark.createDataFrame([(k,) for k in {*grams, *unseen}], "k int")).collect()
    assert len(got) == len({*grams, *unseen})
    for r in got:
        assert r["p"] == pytest.approx(p(split(r["k"])), rel=1e-9)
    # a distribution: over all 64 next symbols
    every = kneser_ney.probabilities(spark.createDataFrame(list(counts.items()), "k int, n long"),
                                     spark.createDataFrame([((grams[20] >> 6 << 6) + s,) for s in range(64)], "k int"))
    assert sum(r["p"] for r in every.collect()) == pytest.approx(1.0)


def test_classifier_keeps_trusted_prose(spark, empty):
    rng = random.Random(2)
    good = [(i, prose(rng, rng.randint(5, 80)), rng.choice(["en", None]), "a") for i in range(200)]
    junk = [(1000, "w1 " * 80, "en", "a"), (1001, "W1!! W2!! " * 30, "en", "a"), (1002, "w3&&& w4$$$ " * 30, None, "a")]
    none = [(2000, None, "en", "a"), (2001, "", "en", "a")]
    docs = table(spark, good + junk + none)
    trusted = spark.createDataFrame([(i,) for i in range(0, 200, 2)], "doc_id long")
    got = by_id(kneser_ney.classify(docs, trusted))
    assert all(got[i]["kept"] for i, *_ in good)
    assert not any(got[i]["kept"] for i, *_ in junk + none)
    assert got[2000]["perplexity"] is None and len(got) == len(good) + 5
    kept = kneser_ney.keep_good(docs, trusted)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, *_ in good)
    assert kneser_ney.classify(empty, trusted).collect() == []
    untrusted = by_id(kneser_ney.classify(docs, trusted.where("false")))
    assert all(r["kept"] == (r["n_symbols"] > 0) for r in untrusted.values())


def test_model_sees_every_byte_and_word_forms(spark):
    """Texts that classes of bytes cannot tell apart: digits, capitals, continuation bytes, and words spelt with others."""
    pairs = [("a 1 b", "a 7 b"), ("an Ant", "an Ent"), ("日本", "日杬"), ("da é", "da ñ"), ("x  x y", "x\tx y")]
    for a, b in pairs:
        ga, gb = (kneser_ney.byte_grams(*textkit.text_buffer(pa.array([t]))) for t in (a, b))
        assert len(ga) == len(a.encode()) and set(ga.tolist()) != set(gb.tolist())
    rng = random.Random(7)
    kanji, strange = ([chr(0x4E00 + 16 * i + d) for i in range(40)] for d in (0, 8))  # every byte falls into the same class

    def text(chars, n):
        return "".join(rng.choice(chars) for _ in range(n))
    docs = table(spark, [(i, text(kanji, 150), "zh", "a") for i in range(120)] + [(1000 + i, text(strange, 150), "zh", "a") for i in range(5)])
    got = by_id(kneser_ney.classify(docs, spark.createDataFrame([(i,) for i in range(0, 120, 2)], "doc_id long")))
    assert all(got[i]["kept"] for i in range(120)) and not any(got[1000 + i]["kept"] for i in range(5))


def test_scores_equal_the_definition_in_any_chunks(spark, rows, docs, monkeypatch):
    """Bits of every document by the definition, whatever the chunks and shards; no n-gram types are lost on the way.
    Trusted texts that are held out are not counted."""
    trusted = [i for i, *_ in rows if i % 3 == 0 and i < 40]
    held_out = {r["doc_id"] for r in docs.where(kneser_ney.held_out()).collect()}
    grams = {i: kneser_ney.byte_grams(*textkit.text_buffer(pa.array([t or ""]))).tolist() for i, t, *_ in rows}
    counts = Counter(g for i in trusted if i not in held_out for g in grams[i])
    types = sorted({g for gs in grams.values() for g in gs})
    model = dict(kneser_ney.probabilities(spark.createDataFrame(list(counts.items()), "k long, n long"),
                                          spark.createDataFrame([(g,) for g in types], "k long"), kneser_ney.BYTE_ORDER, kneser_ney.BYTE_BITS).collect())
    for held in (kneser_ney._HELD, 500):
        monkeypatch.setattr(kneser_ney, "_HELD", held)
        monkeypatch.setattr(kneser_ney, "CHUNK", 7)
        got = by_id(kneser_ney.classify(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long")))
        for i, gs in grams.items():
            want = 2 ** (-sum(math.log2(model[g]) for g in gs) / len(gs)) if gs else None
            assert got[i]["perplexity"] == (pytest.approx(want, rel=1e-5) if gs else None)


def test_limits_come_from_trusted_texts_that_were_not_counted(spark):
    rng = random.Random(9)
    docs = table(spark, [(i, prose(rng, 40), "en", "a") for i in range(300)])
    trusted = list(range(0, 300, 2))
    got = by_id(kneser_ney.classify(docs, spark.createDataFrame([(i,) for i in trusted], "doc_id long"), spread=0.0))
    held_out = {r["doc_id"] for r in docs.where(kneser_ney.held_out()).collect()}
    unseen = sorted(got[i]["perplexity"] for i in trusted if i in held_out)
    assert 0 < len(unseen) < 30  # fewer than min_trusted: the limit of all languages, whose 99 % quantile is the largest
    assert all(r["threshold"] == pytest.approx(unseen[-1]) for r in got.values())
    assert sum(got[i]["kept"] for i in range(1, 300, 2)) >= 130  # of 150 that were never trusted


# 10

def naive_counts(t):
    t = t or ""
    words = t.encode().split()
    chars = [w.decode() for w in words]
    lines = [x for x in t.split("\n") if x.encode().split()]
    windows = Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
    covered = {p for k in range(len(words) - 7) if windows[tuple(words[k:k + 8])] > 1 for p in range(k, k + 8)}
    return len(words), sum(map(len, chars)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_rules_count_and_adapt(spark, rows, empty):
    rng = random.Random(3)
    more = [(500 + i, prose(rng, 60), "en", "a") for i in range(150)]
    more += [(800, "bad& text# " * 3 + prose(rng, 40), "en", "a"), (801, "same line\n" * 30 + prose(rng, 300), "en", "a")]
    both = rows + more
    got = by_id(quality_rules.adaptive_rules(table(spark, both)))
    for i, t, *_ in both:
        n = naive_counts(t)
        assert tuple(got[i][c] for c in quality_rules.COUNTS) == n
        assert got[i]["base_failed"] == (n[0] < 20 or 100 * n[4] > 30 * n[0])
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert all(got[500 + i]["kept"] for i in range(150))
    assert not got[800]["kept"] and not got[800]["base_failed"]
    assert quality_rules.adaptive_rules(empty).collect() == []


def test_each_rule_rejects_alone(spark):
    """Each adaptive fence rejects a document that the base rules and the other fences pass, also where copies of junk hold
    more than a third of the source."""
    rng = random.Random(17)
    plain = [(i, prose(rng, 80), "en", "a") for i in range(150)]
    junk = "#### " * 5 + prose(rng, 60)
    window = prose(rng, 8)
    cases = {"symbols_permille": (900, " ".join(w + "&" * (k < 24) for k, w in enumerate(prose(rng, 80).split()))),
             "dup_lines_permille": (901, "\n".join(["same line here"] * 2 + ["other line now"] * 2 + [prose(rng, 40) for _ in range(3)])),
             "repeat_permille": (902, f"{window} {prose(rng, 26)} {window} {prose(rng, 28)}"),
             "word_len_tenths": (903, " ".join(w * 3 for w in prose(rng, 60).split()))}
    copies = [(1000 + i, junk, "en", "a") for i in range(120)]
    got = by_id(quality_rules.adaptive_rules(table(spark, plain + copies + [(i, t, "en", "a") for i, t in cases.values()])))
    assert all(got[i]["kept"] for i, *_ in plain)
    assert not any(got[i]["kept"] or got[i]["base_failed"] for i, *_ in copies)
    for metric, (i, _) in cases.items():
        assert not got[i]["base_failed"] and not got[i]["kept"]
        assert [m for m in quality_rules.SLACK if got[i][m] > got[i][f"max_{m}"]] == [metric]


def test_counts_of_very_long_spans():
    word = "x" * 3_000_000
    text = f"{word} {word} a"
    data, offs = textkit.text_buffer(pa.array([text]))
    s, e, _ = textkit.word_spans(data, offs)
    h = textkit.span_hashes(data, s, e)
    assert len(h) == 3 and h[0] == h[1] != h[2]


def direct_bytes(spark):
    """Bytes of direct buffers that this JVM holds; the driver's, which runs the tasks of a local session."""
    jvm = spark._jvm
    kind = jvm.java.lang.Class.forName("java.lang.management.BufferPoolMXBean")
    return sum(b.getMemoryUsed() for b in jvm.java.lang.management.ManagementFactory.getPlatformMXBeans(kind) if b.getName() == "direct")


def test_pipeline_reads_hold_no_column_chunk(spark, tmp_dir):
    """A read of texts must not keep direct buffers of the size of their column chunk."""
    path = f"{tmp_dir}/one-chunk.parquet"
    texts = [os.urandom(4000).hex() for _ in range(6000)]  # 48 MB in one column chunk
    pq.write_table(pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}), path,
                   compression="none", use_dictionary=False, row_group_size=len(texts))
    small_batches(spark)
    before = direct_bytes(spark)
    got = spark.read.parquet(path).mapInArrow(lambda it: it, "doc_id long, text string").selectExpr("sum(length(text)) AS n").first()["n"]
    assert got == 8000 * len(texts)
    assert direct_bytes(spark) - before < 16 << 20


def test_factor_chunks_stay_small_between_keys():
    """Many keys of few blocks are worked on in pieces far below the chunk that one key may fill; the spans are the same."""
    rng = random.Random(3)
    rows = []
    for key in range(300):
        text = rng.randbytes(130)
        rows += [(key, 2 * key, 0, text), (key, 2 * key + 1, 5, rng.randbytes(3) + text)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i:i + 50], strict=True), (*[pa.int64()] * 3, pa.binary()), strict=True)],
                                          names=["key", "doc", "lo", "block"]) for i in range(0, len(rows), 50)]

    def found(chunk):
        out = [b for b in suffix_dedup._factor_task(100, chunk)(iter(batches)) if b.num_rows]
        return out, sorted((r["doc"], r["lo"], r["hi"]) for b in out for r in b.to_pylist() if r["w1"] is None)

    parts, spans = found(500)
    assert max(b.num_rows for b in parts) <= 75 and len(parts) >= 4  # once: 250 keys at a time
    assert spans == found(10_000)[1] == [(2 * k + 1, 8, 138) for k in range(300)]


def test_ranks_of_places():
    doc, at = np.array([5, 2, 5, 2, 2, -1]), np.array([7, 9, 7, 9, 3, 50])
    assert suffix_dedup._ranks(doc, at).tolist() == [3, 2, 3, 2, 1, 0]
    assert suffix_dedup._ranks(doc[:0], at[:0]).tolist() == []
