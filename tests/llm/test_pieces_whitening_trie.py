"""Piece encoding, whitening and the prefix trie against their definitions, with nulls, empty tables, ties and repeats."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import prefix_trie, sentence_pieces, whitening
from tidemark.llm.registry import QUERIES

P = pytest.importorskip("public_tokenizers")
SMALL = "/root/testdata/sf0.001"
MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


# pieces


ALPHABET = st.one_of(st.sampled_from(list("  ▁abtheinx=\n")), st.characters(codec="utf-8"))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=60), max_size=4))
def test_any_text_as_the_library(texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert sentence_pieces.piece_model(MODEL).encode([t.encode() for t in texts]).to_pylist() == [library.encode(t) for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 31999), st.integers(0, 260), st.integers(130, 258)), max_size=8), min_size=1, max_size=4))
def test_any_ids_as_the_library(lists):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    edges = np.cumsum([0, *map(len, lists)])
    assert sentence_pieces.piece_model(MODEL).decode(np.array([i for x in lists for i in x], np.int32), edges) == library.decode(lists)


@pytest.mark.parametrize("text", ["x" * 5000, " " * 777 + "the", "ab" * 3000, "=" * 4001, "龘" * 500, "▁" * 9 + " a", "<s> <0x41> </s>", "\x00﻿a"])
def test_runs(library, text):
    assert sentence_pieces.piece_model(MODEL).encode([text.encode()]).to_pylist() == [library.encode(text)]


def test_a_pair_that_does_not_agree_is_given_up(library):
    model = sentence_pieces.piece_model(MODEL)
    rng = random.Random(3)
    words = ["▁" + "".join(rng.choice("etaoinsr") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    greedy = 0
    for w in words:
        longest, at, path = model.longest(w), 0, []
        while at < len(w):
            path.append(longest[at])
            at += len(model.names[path[-1]])
        own = model.tokens(w)
        greedy += own == path
        assert [model.names[t] for t in own] == model.merge(w)
    assert greedy < len(words)


def test_encoding_and_decoding_rows(spark, library):
    rows = [(1, None, 9), (None, "a b", 9), (2, "", 9), (2, "", 9), (3, "  Grüße\n", 9), (4, "word " * 4000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    both = sentence_pieces.decode(sentence_pieces.encode(docs, MODEL), MODEL).collect()
    assert sorted(((r.id, r.ids, r.decoded) for r in both), key=str) == sorted(((i, library.encode(t or ""), t or "") for i, t, _ in rows), key=str)
    assert sorted(map(tuple, sentence_pieces.encode(docs, MODEL, decoded=True).collect()), key=str) == sorted(map(tuple, both), key=str)
    assert sentence_pieces.encode(docs.limit(0), MODEL).collect() == []
    loose = spark.createDataFrame([(1, None), (2, [259, None, 300])], "id long, ids array<int>")
    assert [r.decoded for r in sentence_pieces.decode(loose, MODEL).orderBy("id").collect()] == ["", library.decode([259, 300])]


def test_query_of_pieces(spark, library):
    table = pq.read_table(f"{SMALL}/documents.parquet")
    want = set()
    for i, t in zip(table["doc_id"].to_pylist(), table["text"].to_pylist(), strict=True):
        ids = library.encode(t or "")
        want.add((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert {tuple(r) for r in QUERIES["op13_sentence_pieces"](spark, SMALL).collect()} == want


# whitening


def exact(x):
    n, d = x.shape
    rows = [[int(v) for v in r] for r in x]
    return whitening.Moments(n, [sum(r[i] for r in rows) for i in range(d)], [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)])


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 5), st.sampled_from([0, 1, 40, 2**20, 2**40, 2**60]), st.integers(0, 2**32))
def test_planes_count_products_exactly(n, dims, spread, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-spread, spread + 1, (n, dims))
    assert whitening.block_moments(x) == exact(x)


@given(st.integers(-(2**150), 2**150))
def test_limbs_hold_any_sum(value):
    assert sum(v << (whitening.LIMB * k) for k, v in enumerate(whitening.limbs(value))) == value


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.sampled_from([10, 2**29, 2**31, 2**54, 2**61]), st.integers(0, 2**32))
def test_deviations_are_exact(dims, spread, seed):
    z = np.random.default_rng(seed).integers(-spread, spread, (5, dims))
    assert whitening.deviations(z) == [sum(int(v) ** 2 for v in r) for r in z]


def test_whitened_rows_against_numpy(spark):
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(700, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    nan = float("nan")
    odd = [(1, None), (2, [1.0] * 5 + [nan]), (3, [1.0] * 5 + [float("inf")]), (4, [1.0] * 5 + [None]), (5, []), (6, [1.0, 2.0])]
    rows = [(None if k == 3 else 100 + k // 2, [float(c) for c in v]) for k, v in enumerate(vectors)]
    table = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, _vector int, n string").repartition(5)
    got = whitening.whiten(table.drop("n"), components=4).collect()
    x = np.floor(vectors.astype(float) * 64).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    values, basis = np.linalg.eigh(np.cov(x.T, bias=True))
    white = (x - sums / n) @ (basis[:, ::-1] / np.sqrt(values[::-1]))[:, :4]
    assert len(got) == 4 * n and {r.n for r in got} == {n}
    order = {}
    for r in got:
        order.setdefault((r.vec_id, int(r.deviation)), {}).setdefault(r.component, r.whitened)
    for k, (i, _) in enumerate(rows):
        deviation = sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[k], sums, strict=True))
        for c in range(4):
            assert math.isclose(abs(order[i, deviation][c + 1]), abs(white[k, c]), rel_tol=1e-9, abs_tol=1e-9)
    shares = {r.component: r.explained for r in got}
    assert np.allclose([shares[c + 1] for c in range(4)], values[::-1][:4] / values.sum(), rtol=1e-10)
    assert max(r.identity_error for r in got) < 1e-10


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(k, [3.0, 4.0]) for k in range(9)], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(k, [float(k), 7.0, 2.0 * k]) for k in range(9)], schema)).collect()
    assert {r.component for r in one} == {1} and len(one) == 9
    large = whitening.whiten(spark.createDataFrame([(k, [float(k) * 2.0**50, 1e60 if k == 8 else 0.0]) for k in range(9)], schema)).collect()
    assert len(large) == 8 and large[0].identity_error < 1e-9


def test_query_of_whitening(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, SMALL).toPandas()
    x = np.floor(np.stack(pq.read_table(f"{SMALL}/embeddings.parquet")["embedding"].to_pylist()).astype(float) * 64).astype(np.int64) + 1_000_000
    assert len(rows) == 32 * len(x) and rows.identity_error.max() < 1e-8
    n, sums = len(x), x.sum(0)
    assert sorted(rows[rows.component == 1].deviation) == sorted(sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x)


# prefix trie


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, hashlib.md5(f"{len(role or '')} {role or ''}{text or ''}".encode()).hexdigest(), (role or "", text or "")))
    own = {c: [t[-1] for t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    return out


def nodes_of(conversations):
    nodes = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not children[p]
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if conversations[c] == p)))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def made(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


SCHEMA = "conv_id long, turn long, role string, text string, conv int, chain string"


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_trie_of_random_conversations(spark, block):
    rng = random.Random(block)
    rows = [(c, t, rng.choice(["user", "assistant"][: 1 + (t > 2)]), rng.choice(["a", "b", "é"][: 1 + (t % 2)])) for c in range(120) for t in range(rng.randint(1, 12))]
    rows += [(None, 0, "user", "a"), (500, None, None, None), (500, 1, "user", None), (501, 0, "user", "b"), (501, 0, "user", "a"), (501, 0, "user", "a")]
    turns = prefix_trie.share_openings(prefix_trie.turn_digests(table(spark, rows)))
    assert made(prefix_trie.trie(prefix_trie.chains(turns), block)) == nodes_of(rebuilt(rows))


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_trie_of_equal_and_nested_conversations(spark, block):
    turns = [("user", str(k % 2)) for k in range(40)]
    conversations = {c: tuple(turns[: 40 if c % 3 else c % 40]) for c in range(90)}
    rows = [(c, t, *turn) for c, v in conversations.items() for t, turn in enumerate(v)]
    got = made(prefix_trie.trie(prefix_trie.chains(prefix_trie.turn_digests(table(spark, rows))), block))
    assert got == nodes_of({c: v for c, v in conversations.items() if v})


def test_trie_of_one_long_conversation_and_of_none(spark):
    rows = [(c, t, "user", "x") for c in (4, 7) for t in range(600 + c)]
    got = made(prefix_trie.trie(prefix_trie.chains(prefix_trie.turn_digests(table(spark, rows)))))
    assert got == nodes_of({c: (("user", "x"),) * (600 + c) for c in (4, 7)})
    assert made(prefix_trie.trie(prefix_trie.chains(prefix_trie.turn_digests(table(spark, []))))) == []


def test_text_ids_and_pieces_of_many_ids(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 2)
    rows = [(f"c{k:03}", 0, "user", "x") for k in range(30)] + [("b", 0, "user", "y"), ("b", 1, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string").repartition(3)
    got = made(prefix_trie.trie(prefix_trie.chains(prefix_trie.turn_digests(df)), 4))
    conversations = defaultdict(tuple)
    for c, _, *turn in rows:
        conversations[c] += (tuple(turn),)
    assert got == nodes_of(conversations)


def test_query_of_the_trie(spark):
    t = pq.read_table(f"{SMALL}/conversations.parquet").to_pylist()
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in t]
    assert made(QUERIES["op12_prefix_trie"](spark, SMALL)) == nodes_of(rebuilt(rows))


def test_words_stay_remembered_when_pairs_do_not(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "REMEMBERED", 10)
    sentencepiece = pytest.importorskip("sentencepiece")
    path = str(P.path("piece_bpe_32k.model"))
    library, pieces = sentencepiece.SentencePieceProcessor(model_file=path), sentence_pieces.PieceModel(path)
    texts = [" ".join(f"wort{i * 7919 % 1000}qx zz{i}ab" for i in range(200)), "a  b", "", "xqzxqz \u4e16 wort1"]
    assert pieces.encode([x.encode() for x in texts]).to_pylist() == [library.encode(x) for x in texts]
    assert len(pieces.words) == len({w for x in texts for w in sentence_pieces.split(x.encode())})
