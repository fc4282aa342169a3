"""Every operator against a plain version on small tables with NULLs, empty and long texts, ties and repeated rows."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import public_tokenizers
import pytest
import tiktoken
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewire.llm import (
    ann, bpe, chat, components, near_dup, packing, quality, sharding, suffix_dedup, token_counts, urls, wordpieces,
)
from tidewire.llm.queries import ORACLE, QUERIES
from tidewire.session import materialize

WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Names that the operators use themselves, as further columns of the input.
CLASHES = ["uid", "raw", "block", "part", "key", "lot", "shard", "slot", "root", "n", "spans", "size", "_uid", "_key"]


def prose(rng, words):
    return " ".join("".join(rng.choice("abcdeè") for _ in range(rng.randint(2, 6))) for _ in range(words))


def edge_texts():
    rng = random.Random(11)
    base = [prose(rng, n) for n in (1, 4, 5, 6, 30, 60, 60, 200, 900)]
    near = []
    for text in base[5:]:
        words = text.split()
        for _ in range(3):
            copy = list(words)
            for _ in range(max(1, len(words) // 60)):
                copy[rng.randrange(len(copy))] = "changed"
            near.append(" ".join(copy))
    odd = [
        None, "", " \n\t ", "x", "it's We'LL <|endoftext|> Σας İ \x1c é", "a" * 30_000, "ab" * 20_000 + " " + "#$" * 50,
        "line one two\nline one two\n\nline one two\n", base[7][:500] + " own end", "漢字" * 400, base[8], base[8],
    ]
    return base + near + odd


@pytest.fixture(scope="module")
def texts():
    return edge_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [(None, texts[8], None, None, None), (3, texts[3], "en", "s", 4), (3, texts[3], "en", "s", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHES:
        df = df.withColumn(name, F.lit("clash"))
    return materialize(df.repartition(3), "edge-docs")


@pytest.fixture(scope="module")
def pairs(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def nothing(docs):
    return materialize(docs.where("false"), "no-docs")


def counted(rows):
    return collections.Counter(map(tuple, rows))


# 1, 7: word pieces


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_pieces_are_the_librarys(library, texts):
    own = wordpieces.WordPieces(WORDS)
    tried = [t or "" for t in texts] + [f"a{chr(c)}b {chr(c)}. A{chr(c)}" for c in range(1, 0x3000)]
    for text in tried:
        ids = [i for unit in own.units(text) for p in own.pretokens(unit) for i in own.ids(p)]
        assert ids == ids_of(library, text), text[:50]


def test_token_counts(docs, pairs, nothing, library, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK_DOCS", 7)
    monkeypatch.setattr(token_counts, "SUM_ROWS", 50)
    expected = []
    for key, text in pairs:
        n = len(ids_of(library, text))
        expected.append((key, len((text or "").encode()), n, n > 2048))
    assert counted(token_counts.token_counts(docs, WORDS).collect()) == counted(expected)
    assert token_counts.token_counts(nothing, WORDS).count() == 0


def check_packing(found, pairs, library):
    sequences, pieces = collections.defaultdict(list), collections.defaultdict(list)
    for row in found:
        sequences[row.sequence_id].append((row.offset, row.length))
        pieces[row.doc_id].append((row.start, row.length, row.ids_crc32, row.doc_tokens))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 4096
    expected = collections.defaultdict(list)
    for key, text in pairs:
        ids = np.array([*ids_of(library, text), 2], "<u4")
        for start in range(0, len(ids), 4096):
            piece = ids[start : start + 4096]
            expected[key].append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    return len(sequences)


def test_packing(docs, pairs, nothing, library):
    check_packing(packing.pack_documents(docs, WORDS).collect(), pairs, library)
    assert packing.pack_documents(nothing, WORDS).count() == 0
    kept = packing.token_pieces(docs, WORDS, with_ids=True).where("doc_id = 4").collect()
    assert [i for row in kept for i in row.ids] == [*ids_of(library, pairs[[k for k, _ in pairs].index(4)][1]), 2]


def test_first_fit_is_the_plain_one():
    rng = random.Random(2)
    for _ in range(50):
        lengths = sorted((rng.randint(1, 100) for _ in range(rng.randint(0, 60))), reverse=True)
        rooms, expected = [], []
        for length in lengths:
            at = next((i for i, room in enumerate(rooms) if room >= length), len(rooms))
            if at == len(rooms):
                rooms.append(100)
            expected.append((at, 100 - rooms[at]))
            rooms[at] -= length
        assert packing.first_fit_decreasing(lengths, 100) == expected


def test_little_padding(spark):
    rng = random.Random(4)
    pieces = spark.createDataFrame([(i, rng.randint(1, 4000), rng.getrandbits(60)) for i in range(4000)], "doc_id long, length long, lot long")
    packed = packing.pack(materialize(pieces, "pieces"), group_pieces=1000).groupBy("sequence_id").agg(F.sum("length").alias("n"))
    used, count = packed.agg(F.sum("n"), F.count("*")).first()
    assert used / (4096 * count) > 0.98


# 2: chats


def test_chats_read_back(spark):
    said = [
        (1, 0, "user", "hi"), (1, 1, "assistant", "a <|end|> <|next|>"), (1, 2, "assistant", None), (1, 3, "assistant", ""),
        (1, 4, "user", "<|esc|> <|"), (2, 5, "assistant", "<|turn|>user<|text|>x"), (2, 5, "assistant", "<|turn|>user<|text|>x"),
        (3, None, None, "né\n|>"), (3, 0, "sys<|text|>", "|"), (None, 1, "user", "x" * 50_000), (4, 0, "user", "<"), (4, 1, "user", "|turn|>"),
    ]
    df = spark.createDataFrame(said, "conv_id long, turn long, role string, text string")
    for name in ("said", "turns", "segments", "formatted", "before", "role_", "loss"):
        df = df.withColumn(name, F.lit("clash"))
    out = {r.conv_id: r for r in chat.digests(chat.format_chats(df.repartition(4))).collect()}
    by = collections.defaultdict(list)
    for conv, turn, role, text in said:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    assert set(out) == set(by)
    for conv, turns in by.items():
        turns.sort()
        row = out[conv]
        lines = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        assert row.n_turns == len(turns)
        assert row.turns_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    formatted = chat.format_chats(df).where("conv_id = 1").first()
    assert formatted.formatted.count("<|turn|>") == 3 and formatted.formatted.count("<|next|>") == 2
    assert "".join(s.text for s in formatted.segments) == formatted.formatted
    assert chat.digests(chat.format_chats(df.where("false"))).count() == 0


# 3: byte BPE


@pytest.fixture(scope="module")
def reference_bpe():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe_is_the_librarys(reference_bpe):
    own = bpe.ByteBpe(RANKS, public_tokenizers.PATTERN)
    ids = lambda text: np.frombuffer(b"".join(own.encode(text, 50)), "<u4").tolist()
    rng = random.Random(3)
    tried = ["".join(rng.choice("aabbcc eeinst \n.!é漢") for _ in range(rng.randint(0, 80))) for _ in range(3000)]
    tried += ["a" * 5000, "etaoin" * 900, "".join(rng.choice("etaoinsr") for _ in range(20_000))]
    tried += [f"a{chr(c)}b {chr(c)}{chr(c)}1" for c in range(0x3000)]
    for text in tried:
        assert ids(text) == reference_bpe.encode_ordinary(text)
        assert own.decode(b"".join(own.encode(text))) == text.encode()


def test_byte_bpe_round_trip(docs, pairs, nothing, reference_bpe):
    expected = []
    for key, text in pairs:
        ids = np.array(reference_bpe.encode_ordinary(text or ""), "<u4")
        plain = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((key, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), plain))
    assert counted(bpe.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()) == counted(expected)
    assert bpe.round_trip(nothing, RANKS, public_tokenizers.PATTERN).count() == 0
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert counted((r.doc_id, bytes(r.text)) for r in back.collect()) == counted((k, (t or "").encode()) for k, t in pairs)


# 4: nearest neighbours


def plain_nearest(rows, every, keep):
    use = [(i, np.array(v)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (i, q) in enumerate(use):
        if i % every == 0:
            scored = [(-float(q @ v / math.sqrt(q @ q) / math.sqrt(v @ v)), j) for other, (j, v) in enumerate(use) if other != at and len(v) == len(q)]
            out[i] = sorted((round(s, 9), j) for s, j in scored)[:keep]
    return {i: found for i, found in out.items() if found}


def test_nearest(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 64)
    monkeypatch.setattr(ann, "QUERY_ROWS", 3)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    rows += [(400, rows[7][1]), (401, rows[7][1]), (402, None), (403, [0.0] * 8), (404, [float("nan")] * 8), (405, [1.0, None] + [1.0] * 6),
             (406, [float("inf")] * 8), (407, [1.0] * 5), (413, [0.0, 1.0, 2.0, 0.0, 1.0]), (420, [2.0] * 3), (414, [3.0, 1.0, 0.0, 0.0, 0.0]), (None, [1.0] * 8), (408, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("uid", F.lit(1)).withColumn("block", F.lit(2))
    found = ann.nearest(materialize(df, "vecs"), every=7).collect()
    got = collections.defaultdict(list)
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((round(-r.score, 9), r.vec_id))
    expected = plain_nearest(rows, 7, 5)
    assert set(got) == set(expected)
    # Blocks of 64 are reranked whole, so nothing is missed and ties are in order.
    assert got == expected
    assert [r["rank"] for r in found if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert ann.nearest(materialize(df.where("false"), "no-vecs")).count() == 0
    few = ann.nearest(materialize(df.where("vec_id IN (0, 1, 2)"), "few-vecs"), every=50).collect()
    assert [(r.query_id, r["rank"]) for r in sorted(few)] == [(0, 1), (0, 2)]


def test_nearest_recall(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    vectors = np.array([v for _, v in rows])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    hit = total = 0
    found = collections.defaultdict(set)
    for r in ann.nearest(df).collect():
        found[r.query_id].add(r.vec_id)
    for i, (key, _) in enumerate(rows):
        if key % 50 == 0:
            scores = unit @ unit[i]
            scores[i] = -2
            best = {rows[j][0] for j in np.argsort(-scores, kind="stable")[:5]}
            hit, total = hit + len(best & found[key]), total + 5
    assert hit / total >= 0.9


def test_nearest_is_exact_when_all_is_reranked(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 400)
    monkeypatch.setattr(ann, "RERANKED_LEAST", 2)
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(60, 12))
    rows = [(i, (centres[i % 60] + 0.3 * rng.normal(size=12)).tolist()) for i in range(1500)]
    df = materialize(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vecs")
    expected = plain_nearest(rows, 25, 5)

    def found(**options):
        got = collections.defaultdict(list)
        for r in sorted(ann.nearest(df, every=25, **options).collect(), key=lambda r: (r.query_id, r["rank"])):
            got[r.query_id].append((round(-r.score, 9), r.vec_id))
        return got

    assert found(reranked=1.0) == expected
    # What is found has the exact score, so a hit is a hit in both.
    hits = [sum(len(set(some[i]) & set(expected[i])) for i in expected) for some in (found(), found(reranked=0.001))]
    assert 0.9 * 5 * len(expected) <= hits[0] and hits[1] < 5 * len(expected)
    for wrong in (0, 1.5):
        with pytest.raises(ValueError):
            ann.nearest(df, reranked=wrong)


def test_pivots_of_many_tasks_fit_the_driver(spark):
    conf = spark._jsc.sc().conf()
    before = conf.get("spark.driver.maxResultSize", "1g")
    df = spark.range(0, 60_000, 1, 40)
    cells = [(F.xxhash64("id", F.lit(i)) % 1000 / 7).alias(str(i)) for i in range(8)]
    many = materialize(df.select(F.array(*cells).alias("vector")), "many").repartition(40)
    # A few vectors that fill the table, by number of copies.
    few = materialize(df.select(F.array(F.lit(1.0), (F.sqrt("id") / 20).cast("long").cast("double")).alias("vector")), "few")

    def plain(rows, most):
        found = rows.select("vector", F.xxhash64("vector").alias("h")).toArrow().to_pylist()
        return list(dict.fromkeys(tuple(r["vector"]) for r in sorted(found, key=lambda r: r["h"])[:most]))

    expected = [plain(many, 1024), plain(few, 1024), plain(few.limit(5), 1024)]
    try:
        conf.set("spark.driver.maxResultSize", "2m")
        pivots = ann.choose_pivots(many, 256)
        found = [[tuple(v) for v in ann._least_hashed(df, 1024)] for df in (many, few, few.limit(5))]
    finally:
        conf.set("spark.driver.maxResultSize", before)
    assert pivots.shape == (256, 8)
    assert found == expected and [len(x) for x in found][0] == 1024


def test_inverted_files():
    order = np.array([[2, 0], [1, 2], [2, 1]], np.int32)
    starts, rows, places = ann.inverted_files(order, 3)
    lists = [list(zip(rows[a:b].tolist(), places[a:b].tolist())) for a, b in zip(starts, starts[1:])]
    assert lists == [[(0, 1)], [(1, 0), (2, 1)], [(0, 0), (2, 0), (1, 1)]]


# 5: near duplicates


def shingles(text, n=5):
    words = (text or "").encode().split()
    if not words:
        return collections.Counter()
    return collections.Counter(zip(*[words[i:] for i in range(n)])) if len(words) >= n else collections.Counter([tuple(words)])


def plain_classes(texts, spread=0.2, least=0.8):
    """The class of each row by all pairs."""
    sets = [shingles(t) for t in texts]
    held = collections.Counter(h for s in sets for h in s)
    n = len(texts)
    idf = {h: 1 + spread * math.log((1 + n) / (1 + c)) / math.log(1 + n) for h, c in held.items()}
    weight = [sum(t * idf[h] for h, t in s.items()) for s in sets]
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            both = sum(min(t, sets[j][h]) * idf[h] for h, t in sets[i].items() if h in sets[j])
            if (not sets[i] and not sets[j]) or (sets[i] and both >= (least - 1e-9) * (weight[i] + weight[j] - both)):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def groups(keys):
    by = collections.defaultdict(list)
    for row, key in enumerate(keys):
        by[key].append(row)
    return sorted(by.values())


def test_near_duplicates(docs, nothing, monkeypatch):
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")).collect()
    found = {r.uid: r for r in near_dup.near_duplicates(docs).collect()}
    assert set(found) == {r.row for r in rows}
    same = plain_classes([r.text for r in rows])
    heads = {}
    for r, key in zip(rows, same):
        heads.setdefault(key, []).append((r.doc_id is None, r.doc_id or 0, r.row))
    for r, key in zip(rows, same):
        out = found[r.row]
        first = min(heads[key])
        assert (out.doc_id, out.class_id, out.class_size) == (r.doc_id, None if first[0] else first[1], len(heads[key]))
        assert out.kept == (first[2] == r.row)
    assert near_dup.near_duplicates(nothing).count() == 0
    kept = near_dup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == len(heads)


def test_near_copies_of_a_hot_text(spark, monkeypatch):
    """Copies that are near the original but not all near each other; the others are compared in blocks."""
    monkeypatch.setattr(near_dup, "COMPARED", 3_000)
    rng = random.Random(8)
    base = prose(rng, 150).split()
    texts = [" ".join(base)]
    for _ in range(120):
        copy = list(base)
        for _ in range(rng.randint(1, 7)):
            copy[rng.randrange(len(copy))] = f"w{rng.random()}"
        texts.append(" ".join(copy))
    texts += [prose(rng, 120) for _ in range(30)]
    df = materialize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2), "hot")
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(df).collect()}
    assert groups([found[i] for i in range(len(texts))]) == groups(plain_classes(texts))


def test_samples_follow_the_weights():
    """Collision rate of the consistent samples: the weighted Jaccard similarity."""
    rng = np.random.default_rng(1)
    keys = near_dup.mix(np.arange(1, 61, dtype=np.uint64) * np.uint64(977))
    a, b = rng.uniform(0.2, 3, 60), rng.uniform(0.2, 3, 60)
    a[:10], b[50:] = 1e-9, 1e-9
    expected = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    same = near_dup.signature(keys, a, 4000) == near_dup.signature(keys, b, 4000)
    assert abs(same.mean() - expected) < 0.03


def test_components(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(50)]
    df = spark.createDataFrame(edges, "u long, v long").repartition(4)
    root = {}
    for u, v in edges:
        root.setdefault(u, u), root.setdefault(v, v)
    for _ in range(200):
        for u, v in edges:
            root[u] = root[v] = min(root[u], root[v])
    linked = {n for u, v in edges if u != v for n in (u, v)}
    assert {r.node: r.root for r in components.components(df).collect()} == {n: root[n] for n in linked}
    assert components.components(df.where("false")).count() == 0


# 6: urls


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([i for i in map(tail.find, "?#") if i >= 0] or [len(tail)])]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fit:
        return host, path, max(fit)[1], max(fit)[2]
    own = {"login", "signup", "cart", "checkout", "cgi-bin", "wp-login.php"} & set(path.split("/")[1:])
    return host, path, None, "block" if own else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://ORG/", "http://org", "http://example.org/es/x?y=/en/1", "http://a.Example.org/en/1", "http://example.org/en/19/x",
    "http://notexample.org/es/", "http://com/fr/", "http://x.com/de/#f", "http://x.com/de", "http://É.com/de/", "a://b://c.org/", "http://x.net/login", "http://x.net/login\n",
    "http://x.net/a/cart/b", "http://x.net/cartoon", "http://x.org/login", "http://example.org?x", "http://example.org#/es/", "http://x.com/fr/login", "http://.org/", "http://org./",
    "http://x.net/" + "a/" * 3000 + "login", "http://user@x.com/de/", "http://x.com:80/de/", "http://EXAMPLE.ORG/ES/", "http://x\ny.com/de/z",
]


def test_urls(spark):
    pages = [(i, u) for i, u in enumerate(URLS)] + [(None, "http://x.com/de/"), (5, "http://ORG/"), (5, "http://ORG/")]
    df = spark.createDataFrame(pages, "page_id long, url string")
    for name in ("host", "path", "token", "rule_id", "best", "label", "n", "weight"):
        df = df.withColumn(name, F.lit("clash"))
    assert counted(urls.filter_urls(df).collect()) == counted((i, *plain_verdict(u)) for i, u in pages)
    assert urls.filter_urls(df.where("false")).count() == 0


def test_urls_without_host(spark):
    hostless = ["http:///login", "file:///cgi-bin/x", "x:///a/cart/b", "http:///cartoon", "://?login", "http:///", "http:///login#x"]
    pages = list(enumerate([*hostless, None, "", "no scheme/login", "http://", "http://x.net/login"]))
    df = spark.createDataFrame(pages, "page_id long, url string")
    found = urls.filter_urls(df)
    assert counted(found.collect()) == counted((i, *plain_verdict(u)) for i, u in pages)
    assert {r.page_id for r in found.collect() if r.verdict == "block"} == {0, 1, 2, 6, 11}


def test_urls_without_host_match_sql(spark):
    pages = [(i, u) for i, u in enumerate(["http:///login", "file:///cgi-bin/x", "x:///a/cart/b", "http:///x", "http://", None])]
    df = spark.createDataFrame(pages, "page_id long, url string")
    with duckdb.connect() as db:
        db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
        db.executemany("INSERT INTO pages VALUES (?, ?)", pages)
        assert counted(urls.filter_urls(df).collect()) == counted(db.execute(urls.URLS_SQL).fetchall())


def test_rules_stand_under_their_rarest_token(spark):
    tokens = spark.createDataFrame([("h:example",)] * 9 + [("h:org",)] * 5 + [("p:es",)] * 7, "token string")
    rules = urls._rule_table(spark, urls.SITE_RULES)
    index = {r.label: r.token for r in urls.rule_index(tokens, rules).collect()}
    assert index == {"org/": "h:org", "example.org/es/": "h:org", "example.org/en/1": "p:en", "com/fr/": "h:com", "com/de/": "h:com"}


# 8: shards


def check_shards(found, pairs, shards):
    slots, weight, where, rows = collections.defaultdict(list), collections.Counter(), collections.defaultdict(set), collections.Counter()
    for r in found:
        slots[r.shard].append(r.slot)
        weight[r.shard] += r["size"]
        rows[r.doc_id, r["size"], r.text_crc32] += 1
        assert (r.law, r.grown_shard) == ("bytes", None) and 0 <= r.shard < shards
        where[r.text_crc32, r["size"]].add(r.shard)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    raw = [(k, (t or "").encode()) for k, t in pairs]
    assert rows == collections.Counter((k, len(b) + 1, zlib.crc32(b)) for k, b in raw)
    assert all(len(s) == 1 for s in where.values())
    return [weight[s] for s in range(shards)]


def test_shards(docs, pairs, nothing, spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 2)
    check_shards(sharding.shard_documents(docs, 3).collect(), pairs, 3)
    assert sharding.shard_documents(nothing).count() == 0
    monkeypatch.setattr(sharding, "LOT_GROUPS", 100)
    rng = random.Random(9)
    many = [(i, "x" * rng.randint(0, 400) if i % 3 else "the same text") for i in range(3000)]
    df = materialize(spark.createDataFrame(many, "doc_id long, text string"), "many")
    sizes = check_shards(sharding.shard_documents(df, 16).collect(), many, 16)
    assert max(sizes) < 1.02 * min(sizes)


def test_best_fit_is_the_plain_one():
    rng = random.Random(10)
    for _ in range(100):
        sizes = sorted((rng.randint(1, 50) for _ in range(rng.randint(0, 80))), reverse=True)
        rooms, expected = [], []
        for size in sizes:
            fit = [(room, i) for i, room in enumerate(rooms) if room >= size]
            at = min(fit)[1] if fit else len(rooms)
            if not fit:
                rooms.append(60)
            rooms[at] -= size
            expected.append(at)
        assert sharding.best_fit_decreasing(sizes, [], 60) == (expected, rooms)


def test_fixed_capacity_shards(spark):
    rng = random.Random(12)
    rows = [(bytes([i % 256, i // 256]), rng.randint(1, 90)) for i in range(500)] + [(b"big", 400)]
    groups_ = materialize(spark.createDataFrame(rows, "key binary, weight long"), "weights")
    found = sharding.fill_shards(groups_, 100).join(groups_, "key").groupBy("bin").agg(F.sum("weight").alias("w")).collect()
    assert sum(r.w for r in found) == sum(w for _, w in rows)
    assert sorted(r.w for r in found)[-2:][0] <= 100 and max(r.w for r in found) == 400
    assert len(found) <= 1.1 * sum(w for _, w in rows[:-1]) / 100 + 2
    assert sharding.fair_rooms(100, [70, 10, 5], 4) == 10


# 9: quality


def plain_quality(text, whole=quality.Bands().whole):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    raw = text.encode()
    kept = not failed
    if kept:
        ratio = lambda b: len(b) / len(zstandard.ZstdCompressor(level=3).compress(b))
        band = lambda b: next((low, high) for n, low, high in whole if len(b) < n)
        inside = lambda b, limits: limits[0] <= ratio(b) <= limits[1]
        chunks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        bad = sum(len(c) for c in chunks if not inside(c, (1.6, 3.5) if len(c) == 4096 else band(c)))
        kept = inside(raw, band(raw)) and 100 * bad <= 20 * len(raw)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed, kept


def plain_bands(sf):
    """The bands for whole documents as the labels of a small table give them, by sorting."""
    read = lambda name: pq.read_table(f"{sf}/{name}.parquet").to_pylist()
    good = {r["doc_id"] for r in read("labels") if r["quality"] == 1}
    ratios = collections.defaultdict(list)
    for r in read("documents"):
        raw = (r["text"] or "").encode()
        if r["doc_id"] in good and not plain_quality(r["text"])[5]:
            ratios[len(raw).bit_length() - 1].append(len(raw) / len(zstandard.ZstdCompressor(level=3).compress(raw)))
    learned = {}
    for power, some in ratios.items():
        if len(some) >= 20:
            some.sort()
            low, high = (some[max(0, math.ceil(share * len(some)) - 1)] for share in (0.005, 0.995))
            learned[power] = (low * 0.95, high * 1.05)
    edges = sorted({n for n, _, _ in quality.Bands().whole} | {float(1 << p) for power in learned for p in (power, power + 1)})
    out = []
    for below in edges:
        least = (out[-1][0] if out else 0) or 1
        default = next((low, high) for n, low, high in quality.Bands().whole if least < n)
        out.append((below, *learned.get(int(least).bit_length() - 1, default)))
    return tuple(out)


def test_quality(spark, docs, pairs, nothing):
    found = quality.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert counted(found.collect()) == counted((k, *plain_quality(t)) for k, t in pairs)
    assert quality.judge(nothing).count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert counted((r.doc_id, r.text) for r in kept.collect()) == counted((k, t) for k, t in pairs if plain_quality(t)[-1])


def test_compression_bands(spark):
    rng = random.Random(13)
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(40)) for _ in range(900))
    good = prose(rng, 2000)
    lines = "\n".join(f"item {i} is sold in shop {i % 7} for the price of {i}" for i in range(800))
    df = spark.createDataFrame([(0, noise), (1, good), (2, lines), (3, good + " " + noise)], "doc_id long, text string")
    kept = {r.doc_id: (r.base_failed, r.kept) for r in quality.judge(df).collect()}
    assert (kept[0], kept[1], kept[3]) == ((False, False), (False, True), (False, False))
    assert not kept[2][1]


def test_bands_judge_every_chunk(spark):
    rng = random.Random(23)
    clean = prose(rng, 12_000).encode()

    def some(size):
        start = rng.randrange(len(clean) - 2 * size)
        return clean[start : start + size].decode("utf-8", "ignore")

    noise = " ".join(base64.b64encode(rng.randbytes(60)).decode() for _ in range(200))
    lines = "".join(f"item {i} is sold in shop {i % 7} for the price of {i}\n" for i in range(400))
    mixed = [
        some(4096) + noise[:4000], some(4096) + noise[:8191], some(4096) + lines[:4096], some(4096) + noise[:2000],
        some(3072) + noise[:3072], noise[:4096] + some(4000), some(2000) + noise[:4096] + some(2000), some(6000) + noise[:6000],
    ]
    whole = [some(n) for n in (400, 1000, 3000, 4096, 4100, 5000, 8191, 8192, 9000, 12000)] + [some(8192) + noise[:500]]
    df = spark.createDataFrame(list(enumerate(mixed + whole)), "doc_id long, text string")
    found = {r.doc_id: r for r in quality.judge(df).collect()}
    assert [i for i in range(len(mixed)) if found[i].kept or found[i].base_failed] == []
    assert [i for i in range(len(whole)) if not found[len(mixed) + i].kept] == []
    assert found[1].n_chunks == 3 and found[1].n_bad_chunks == 2


def test_bands_learned_from_good_documents(spark):
    rng = random.Random(31)
    good = [(i, prose(rng, 300)) for i in range(160)]
    dull = [(500 + i, " ".join(rng.choices([f"w{j}x" for j in range(120)], k=350))) for i in range(20)]
    none = [(900, None), (901, ""), (None, prose(rng, 300)), (902, "too few words")]
    df = spark.createDataFrame(good + dull + none, "doc_id long, text string").withColumn("quality", F.lit(0)).withColumn("id", F.lit(1))
    marks = [(i, 1) for i, _ in good[:150]] * 2 + [(i, 0) for i, _ in dull] + [(None, 1), (7777, 1), (5, None), (900, 1), (902, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    before, learned = quality.Bands(), quality.fit_bands(df, labels, fit=quality.Fit(enough=20))
    sizes = [len(t.encode()) for _, t in good]
    ends = [below for below, _, _ in learned.whole]
    assert ends == sorted(set(ends)) and ends[-1] == float("inf")
    old, new = quality.Meter(before), quality.Meter(learned)
    changed = {n for n in (100, 300, 1000, 1500, 3000, 5000, 10_000, 50_000, 10**6) if old.band(n) != new.band(n)}
    assert changed <= {n for n in (1000, 1500, 3000, 5000) if any(n.bit_length() == s.bit_length() for s in sizes)} and changed
    kept = {r.doc_id for r in quality.judge(df, bands=learned).where("kept").collect()}
    assert kept >= {i for i, _ in good} and not kept & {i for i, _ in dull}
    plainly = {r.doc_id for r in quality.judge(df).where("kept").collect()}
    assert plainly & {i for i, _ in dull}
    assert {r.doc_id for r in quality.keep_good(df, learned).collect()} == kept
    assert quality.fit_bands(df, labels.limit(0)) == quality.fit_bands(df.limit(0), labels) == before
    assert quality.keep_good(df.limit(0), learned).count() == 0
    one = quality.fit_bands(df, labels, fit=quality.Fit(most_labels=10, enough=11))
    assert one == before


def test_bands_learned_from_every_good_document(spark):
    """The band's ends are quantiles of all documents that are labelled good, however many there are."""
    n = 20_500
    texts = [" ".join(f"{i:05d}{j:02d}" for j in range(50)) + " a" * (i % 40) for i in range(n)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    fit = quality.Fit(tail=0.0, margin=0.0)
    learned, meter = quality.fit_bands(docs, labels, fit=fit), quality.Meter()
    of = {}
    for text in texts:
        words = text.encode().split()
        if 100 * quality.repeated_words(words) <= 50 * len(words):
            of.setdefault(len(text).bit_length(), []).append(meter.ratio(text.encode()))
    assert sum(map(len, of.values())) > 20_000
    for power, ratios in of.items():
        assert ((1 << power), min(ratios), max(ratios)) in learned.whole


def test_learned_bands_are_exact_quantiles(spark):
    """Whatever the number of documents, a band's ends are the ratios at the ranks of its quantiles."""
    n, rng = 70_000, random.Random(37)
    pool = prose(rng, 40_000)
    starts = [rng.randrange(len(pool) - 700) for _ in range(n)]
    texts = [" ".join(pool[start : start + 560 + rng.randrange(100)].split(" ")[1:]) for start in starts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    meter, of = quality.Meter(), {}
    for raw in map(str.encode, texts):
        of.setdefault(len(raw).bit_length() - 1, []).append(meter.ratio(raw))
    for tail in (0.0, 0.00005, 0.005, 0.25):
        learned = quality.fit_bands(docs, labels, fit=quality.Fit(tail=tail, margin=0.0)).whole
        for power, ratios in of.items():
            ends = [sorted(ratios)[max(1, math.ceil(share * len(ratios))) - 1] for share in (tail, 1 - tail)]
            assert (2 << power, *ends) in learned


def test_bands_of_the_query_decide(spark):
    """On a table with enough labels, good documents stay and some of the others go."""
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in QUERIES["op9_quality"](spark, sf).where("NOT base_failed").collect()}
    marked = [(found[r.doc_id].kept, r.quality) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.doc_id in found]
    assert all(kept for kept, good in marked if good)
    assert any(not kept for kept, good in marked if not good)


@pytest.mark.parametrize("text", ["", "a", "a b c a b c", "a a a a", "x y\n\nx y\n x y\nx y", "a\x1cb\u00a0c d\u2028e", "\r\n\r\n"])
def test_quality_counts(text):
    raw = text.encode()
    row = quality.Meter().row(raw)
    assert (row[0], row[1], row[2], row[3], row[4]) == plain_quality(text)[:5]


# 10: repeated passages


def plain_removal(texts, length):
    raws = [(t or "").encode() for t in texts]
    times = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if times[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest(), kept))
    return out


def passages_corpus(rng):
    base = ["".join(rng.choice("abcd") for _ in range(rng.randint(0, 200))) for _ in range(50)]
    texts = base + base[:6]
    for _ in range(70):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("abcdé")
        x, y = rng.choice(base), rng.choice(base)
        texts += ["".join(text), x[: rng.randint(0, 60)] + y[10:70]]
    return texts + ["a" * 100, "ab" * 60, "a" * 40, "", None, "abc" * 30 + "d" + "abc" * 20]


@pytest.mark.parametrize("length", [12, 25])
def test_removal(spark, monkeypatch, length):
    monkeypatch.setattr(suffix_dedup, "RANGE_SUFFIXES", 60)
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    texts = passages_corpus(random.Random(length))
    rows = [(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)] + [(None, None, None, None, None)]
    df = materialize(spark.createDataFrame(rows, "doc_id long, text string, uid string, sha string, spans string").repartition(3), "passages")
    expected = plain_removal(texts, length)
    found = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.removal_digests(df, length).collect()}
    assert {i: found[i] for i in range(len(texts))} == {i: e[:4] for i, e in enumerate(expected)}
    assert found[None][:3] == (0, 0, 0)
    cut = suffix_dedup.remove_repeated(df, length)
    assert cut.columns == df.columns
    kept = {r.doc_id: r.text for r in cut.collect()}
    assert {i: (kept[i] or "").encode() for i in range(len(texts))} == {i: e[4].decode("utf-8", "ignore").encode() for i, e in enumerate(expected)}


def test_removal_edges(spark, docs, pairs, nothing):
    found = counted(suffix_dedup.removal_digests(docs).collect())
    expected = plain_removal([t for _, t in pairs], 400)
    assert found == counted((k, *e[:4]) for (k, _), e in zip(pairs, expected))
    assert suffix_dedup.removal_digests(nothing).count() == 0 and suffix_dedup.remove_repeated(nothing).count() == 0


def plain_word_removal(texts, least, length=None):
    """Without the words of repeated sequences of ``least`` words and, if given, the repeated strings of ``length`` bytes."""
    raws = [(t or "").encode() for t in texts]
    found = [[(m.group(), m.start()) for m in re.finditer(rb"[^\x20\x09-\x0D]+", raw)] for raw in raws]
    windows = [[tuple(w for w, _ in ws[i : i + least]) for i in range(len(ws) - least + 1)] for ws in found]
    times = collections.Counter(w for ws in windows for w in ws)
    strings = collections.Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1)) if length else {}
    out = []
    for text, raw, ws, wins in zip(texts, raws, found, windows):
        gone = {j for i, w in enumerate(wins) if times[w] > 1 for j in range(i, i + least)}
        starts = [0, *(at for _, at in ws[1:]), len(raw)]
        lost = {at for i in gone for at in range(starts[i], starts[i + 1])}
        if length:
            lost |= {at for i in range(len(raw) - length + 1) if strings[raw[i : i + length]] > 1 for at in range(i, i + length)}
        out.append(bytes(x for at, x in enumerate(raw) if at not in lost).decode("utf-8", "ignore") if lost else text)
    return out


def test_pipeline_cuts_passages_of_51_words(spark, sf):
    import corpus_pipeline

    rng = random.Random(21)
    passage, other, tiny = prose(rng, 51), prose(rng, 50), " ".join(rng.choice("abcdefgh") for _ in range(51))
    assert 200 < len(passage.encode()) < 400 and len(tiny) == 101
    wide = "\u6f22" + "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(160))
    a, b, c, d = (prose(rng, 90) for _ in range(4))
    texts = [
        f"{a} {passage} {b}", f"{c} {passage} {d}",  # in two documents
        f"{prose(rng, 70)}\n{passage.replace(' ', chr(10))}",  # the same words in lines of their own
        f"{prose(rng, 60)} {other} x", f"{prose(rng, 60)} {other} y",  # 50 words stay
        f"{tiny} {prose(rng, 60)} {tiny} z", prose(rng, 50) + " " + passage[1:],
        prose(rng, 300), "", None,
    ]
    bytes_only = [f"p {wide} q", f"r {wide} s"]  # a word of over 400 bytes
    df = spark.createDataFrame([(i, t, "en", len(t or "")) for i, t in enumerate(texts + bytes_only)], "doc_id long, text string, lang string, n_chars long")
    df = materialize(df.repartition(3), "words")
    cut = corpus_pipeline.repeated_passages(spark, df, sf)
    assert cut.columns == df.columns
    kept = {r.doc_id: (r.text, r.n_chars) for r in cut.collect()}
    expected = plain_word_removal(texts, 51)
    assert expected[:2] == [f"{a} {b}", f"{c} {d}"] and expected[3:5] == texts[3:5]
    assert [kept[i] for i in range(len(texts))] == [(t, len(t or "")) for t in expected]
    assert all(len(kept[i][0]) <= 4 for i in (10, 11))


def test_removal_by_words(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RANGE_SUFFIXES", 60)
    monkeypatch.setattr(suffix_dedup, "SLICE", 64)
    rng = random.Random(22)
    base = [[rng.choice("ab") + rng.choice("cdé") for _ in range(rng.randint(0, 60))] for _ in range(40)]
    texts = [" ".join(t) for t in base] + [" \n" + "\t ".join(t) + "\n" for t in base[:5]]
    for _ in range(60):
        x, y = rng.choice(base), rng.choice(base)
        texts.append(" ".join(x[: rng.randint(0, 20)] + y[rng.randint(0, 10) : 30]))
    texts += ["a " * 40, "", None]
    df = materialize(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), "by-words")
    kept = {r.doc_id: r.text for r in suffix_dedup.remove_repeated(df, 100_000, words=7).collect()}
    assert [kept[i] for i in range(len(texts))] == plain_word_removal(texts, 7)


def test_digests_with_the_text_that_is_left(spark):
    rng = random.Random(31)
    passage = " ".join(f"w{rng.randrange(10**4):04d}" for _ in range(55))
    shared = " ".join(f"word{rng.randrange(10**4):04d}" for _ in range(80))
    own = [" ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) for _ in range(5)]
    texts = [f"{own[0]} {passage} end", f"start {passage} {own[1]}", f"{own[2]} {shared}", f"{shared} {own[3]}", own[4], "", None]
    assert len(passage) < 400 < len(shared)
    docs = materialize(
        spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)], "doc_id long, text string, uid string, spans string"),
        "docs",
    )
    found = {r.doc_id: r for r in suffix_dedup.removal_digests(docs, words=51).collect()}
    plain = {r.doc_id: tuple(r) for r in suffix_dedup.removal_digests(docs).collect()}
    assert {k: tuple(r)[:5] for k, r in found.items()} == plain
    left = plain_word_removal([t or "" for t in texts], 51, 400)
    assert {k: r.cleaned_text or "" for k, r in found.items()} == dict(enumerate(left))
    assert found[0].n_removed == 0 and passage not in found[0].cleaned_text and found[4].cleaned_text == own[4]
    assert suffix_dedup.removal_digests(docs.limit(0), words=51).collect() == []


def test_anchors_are_spread_over_the_parts(spark):
    rng = random.Random(15)
    texts = [(i, i, "".join(rng.choice("abcdefgh ") for _ in range(4_000)).encode()) for i in range(300)]
    rows = materialize(spark.createDataFrame(texts, "uid long, doc_id long, raw binary"), "spread")
    sent = suffix_dedup._send(rows, 400, 20).where("part >= 0").groupBy("part").agg(F.sum(F.octet_length("tags") / 8).alias("n"))
    anchors = {r.part: r.n for r in sent.collect()}
    assert sum(anchors.values()) > 5_000
    assert set(anchors) == set(range(20)) and max(anchors.values()) < 2 * sum(anchors.values()) / 20


def test_splitters_sort_few_whole_texts(spark, monkeypatch):
    asked, below = [], suffix_dedup.hashed_below
    monkeypatch.setattr(suffix_dedup, "hashed_below", lambda name, share: asked.append(share) or below(name, share))
    rng = random.Random(16)
    raws = ["".join(rng.choice("abcdefgh") for _ in range(90)).encode() for _ in range(3_000)]
    owner, _, hashes = suffix_dedup.Anchors(25).find(raws)
    own = [(hashes[owner == i] >> np.uint64(16)).astype("<u8").tobytes() for i in range(len(raws))]
    texts = materialize(spark.createDataFrame(list(zip(range(len(raws)), raws, own)), "uid long, raw binary, anchors binary"), "texts")
    splitters = suffix_dedup.splitters_of(texts, 25, 12)
    wanted = 12 * suffix_dedup.SAMPLED // 4
    assert wanted < texts.select(F.xxhash64("uid").alias("h")).where(below("h", asked[0])).count() < 8 * wanted
    # They are those of sorting all.
    monkeypatch.setattr(suffix_dedup, "hashed_below", lambda name, share: F.lit(True))
    assert len(splitters) == 11 and splitters == suffix_dedup.splitters_of(texts, 25, 12)


def test_merge_of_front_coded_runs():
    rng = random.Random(14)
    for _ in range(60):
        suffixes = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 12))) for _ in range(rng.randint(1, 15))) for _ in range(rng.randint(1, 9))]
        runs = []
        for run in suffixes:
            shared = suffix_dedup._common(run, 12)
            runs.append(suffix_dedup.Run(
                shared.astype("<u4").tobytes(), np.array([len(s) for s in run], "<u4").tobytes(),
                b"".join(s[n:] for s, n in zip(run, shared.tolist())),
            ))
        merged = [(suffixes[run][place], known) for run, place, known in suffix_dedup.merge_runs(runs)]
        assert [s for s, _ in merged] == sorted(s for run in suffixes for s in run)
        for (a, _), (b, known) in zip(merged, merged[1:]):
            assert known == next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


# Registered queries


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("conversations", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    ours = QUERIES[name](spark, sf)
    columns = sorted(ours.columns)
    theirs = con.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").to_arrow_table().to_pylist()
    assert counted(tuple(r[c] for c in columns) for r in ours.collect()) == counted(tuple(r[c] for c in columns) for r in theirs)


def test_queries_cover_whole_tables(spark, sf, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    removal = plain_removal([t for _, t in docs], 400)
    assert counted(tuple(r)[:5] for r in QUERIES["op10_suffix_dedup"](spark, sf).collect()) == counted((k, *e[:4]) for (k, _), e in zip(docs, removal))
    found = {r.doc_id: r.class_id for r in QUERIES["op5_near_dup"](spark, sf).collect()}
    assert groups([found[k] for k, _ in docs]) == groups(plain_classes([t for _, t in docs]))
    check_shards(QUERIES["op8_sharding"](spark, sf).collect(), docs, 16)
    check_packing(QUERIES["op7_packing"](spark, sf).collect(), docs, library)
    tokens = {r.doc_id: r.n_tokens for r in QUERIES["op1_token_counts"](spark, sf).collect()}
    assert tokens == {k: len(ids_of(library, t)) for k, t in docs}
    kept = {r.doc_id: r.kept for r in QUERIES["op9_quality"](spark, sf).collect()}
    assert kept == {k: plain_quality(t, plain_bands(sf))[-1] for k, t in docs}


def test_native_queries_run_no_python(spark, sf):
    for name in ("op2_chat", "op6_urls"):
        text = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Arrow" not in text and "Pandas" not in text
        assert "ExistingRDD" not in text and "LocalTableScan" not in text


def test_whole_pipeline(spark, sf, library):
    import corpus_pipeline

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bands = plain_bands(sf)
    good = [(k, t) for k, t in docs if plain_quality(t, bands)[-1]]
    classes = plain_classes([t for _, t in good])
    once = [row for row, key in zip(good, classes) if row[0] == min(k for (k, _), c in zip(good, classes) if c == key)]
    keys, once = zip(*once)
    check_packing(corpus_pipeline.run(spark, sf).collect(), list(zip(keys, plain_word_removal(once, 51, 400))), library)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated passages", "packing"]


def test_whole_pipeline_cuts_by_words_and_bytes(spark, sf, library):
    import corpus_pipeline

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    good = materialize(corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf), "good")
    once = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, good, sf).collect()}
    keys, texts = zip(*((k, t) for k, t in docs if k in once))
    check_packing(corpus_pipeline.run(spark, sf).collect(), list(zip(keys, plain_word_removal(texts, 51, 400))), library)
