"""Trie BPE, hard negatives and the Merkle manifest against the library and
brute force, on tables with nulls, ties, repeated rows and odd values."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

P = pytest.importorskip("public_tokenizers")


# 11 -----------------------------------------------------------------------------------------------
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def encoder():
    from tablewright.llm.trie_bpe import WordEncoder

    return WordEncoder(P.path("word_bpe_49k.json"))


def test_trie_encoding_equals_the_library(encoder):
    rng, lib = random.Random(4), library()
    signs = ["'", "s", "re", "ll", " ", "\n", "a", "b", "A", "é", "É", "1", "!", "...", "　", "漢", "😀", "\x1c", "́", "Σ", "ab", "the",
             "İ", "՘", "₏", "Ᲊ", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "\x85", "ing", "aa", "É"]
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 25))) for _ in range(3000)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(rng.choices("aein", k=rng.randint(1, 60))) for _ in range(500)] + ["!" * n for n in range(40)] + ["a" * n for n in range(60)]
    got = encoder.ids(texts[:2500]) + encoder.ids(texts[2500:])
    assert [x.tolist() for x in got] == [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)]


def test_long_words_cost_linear_time_and_long_texts_are_cut(encoder, monkeypatch):
    from tablewright.llm import trie_bpe

    lib, rng = library(), random.Random(9)
    text = "a" * 30_000 + " " + "".join(rng.choices("abcdefgh", k=30_000)) + " 漢字" * 3000
    assert encoder.ids([text])[0].tolist() == lib.encode(text, add_special_tokens=False).ids
    monkeypatch.setattr(trie_bpe, "pieces", lambda texts: __import__("tablewright.llm.pretokens", fromlist=["pieces"]).pieces(texts, 7))
    monkeypatch.setattr(trie_bpe, "KEPT", 3)
    text = "It's  <|endoftext|> we'll\tgo Été \r\n don't <|startoftext|>x"
    for _ in range(2):
        assert encoder.ids([text, ""])[0].tolist() == lib.encode(text, add_special_tokens=False).ids


def test_every_token_that_encodes_to_itself_is_found(encoder):
    words = sorted({w for w in (t[:-4] for t in library().get_vocab() if t.endswith("</w>")) if w.isascii() and w.isalpha()})[:4000]
    flat, many = encoder.merges.encode([w.encode() for w in words])
    assert many.tolist() == [1] * len(words) and len(flat) == len(words)


def test_prefixes_are_encoded_once(encoder):
    merges, seen = encoder.merges, []

    class Counting(dict):
        def get(self, key, default=None):
            seen.append(key)
            return dict.get(self, key, default)

    merges.step, kept = Counting(merges.step), merges.step
    try:
        stem = b"internationalisation"
        merges.encode(sorted(stem + bytes([c]) for c in b"abcdefgh"))
        shared = len(seen)
        seen.clear()
        merges.encode([stem + b"a"])
        assert shared < 2 * len(seen)                 # eight words, but one walk over their stem
    finally:
        merges.step = kept


def test_trie_encode_and_decode_tables(spark):
    from tablewright.llm.trie_bpe import decode, encode

    path, lib = P.path("word_bpe_49k.json"), library()
    texts = [None, "", "  \n", "Hello WORLD don't 123", "Ärger 漢字 😀", "<|endoftext|> x", "Hello WORLD don't 123"]
    df = spark.createDataFrame([(i if i != 4 else None, t, "e", 1.0) for i, t in enumerate(texts)], "doc_id long, text string, ids string, decoded double")
    got = decode(encode(df, path), path).collect()
    want = []
    for i, t in enumerate(texts):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append(repr((i if i != 4 else None, len(ids), ids, lib.decode(ids, skip_special_tokens=False))))
    assert sorted(repr((r.doc_id, r.n_tokens, r.ids, r.decoded)) for r in got) == sorted(want)
    assert encode(df.limit(0), path).count() == 0
    again = decode(df.select(F.lit(None).cast("array<int>").alias("ids"), "decoded", "doc_id"), path).collect()
    assert {r.decoded for r in again} == {None} and again[0].asDict().keys() == {"ids", "doc_id", "decoded"}


# 12 -----------------------------------------------------------------------------------------------
def mined(rows, positives=5, negatives=10):
    """Brute force over (id, label, vector) rows; anchors are the ids divisible by 10."""
    kept = set()
    for i, label, vector in rows:
        if None in (i, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = tuple(math.floor(256 * x) for x in vector)
        if sum(x * x for x in whole) < 2**60:
            kept.add((i, label, whole))
    out = []
    for a in kept:
        if a[0] % 10:
            continue
        others = sorted(((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1], b[2]) for b in kept if b[0] != a[0] and len(b[2]) == len(a[2])))
        for p in [b for b in others if b[2] == a[1]][:positives]:
            fits = [b for b in others if b[2] != a[1] and -30 * p[0] <= -100 * b[0] <= -90 * p[0]][:negatives]
            out += [(a[0], p[1], k + 1, b[1], -p[0], -b[0]) for k, b in enumerate(fits)]
    return sorted(out)


def embedding_rows(rng, n, dimension, labels, scale=1.0):
    centres = [[rng.gauss(0, 1) for _ in range(dimension)] for _ in range(4)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i, rng.randrange(labels), [scale * (x + rng.gauss(0, 0.6)) for x in c]))
    return out


@pytest.mark.parametrize("case", ["plain", "few", "ties", "wide"])
def test_hard_negatives_against_brute_force(spark, monkeypatch, case):
    from tablewright.llm import hard_negatives as H

    rng = random.Random(case)
    rows = {"plain": lambda: embedding_rows(rng, 900, 20, 3), "few": lambda: embedding_rows(rng, 30, 5, 9),
            "ties": lambda: [(i, i % 3, [float(rng.randrange(-1, 3)) / 64 for _ in range(3)]) for i in range(400)],
            "wide": lambda: embedding_rows(rng, 200, 9, 2, 3e5)}[case]()
    rows += [(5000, None, [1.0] * 20), (None, 1, [1.0] * 20), (5010, 1, None), (5020, 1, [1.0, None]), (5030, 1, [float("nan")] * 20),
             (5040, 1, [float("inf")] * 20), (5050, 1, []), (5051, 1, []), (5052, 2, []), (5060, 0, [0.0] * 20), (5070, 1, [1e200] * 20),
             rows[10], rows[10], (20, rows[20][1], rows[21][2]), (5080, 1, [0.5, 0.25])]
    monkeypatch.setattr(H, "PASS_ANCHORS", 40)
    df = spark.createDataFrame([(i, v, lab, "x") for i, lab, v in rows], "vec_id long, embedding array<double>, label int, rank string")
    got = H.hard_negatives(df.repartition(3), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == mined(rows)
    assert got or case == "few"


def test_hard_negatives_of_nothing(spark):
    from tablewright.llm.hard_negatives import hard_negatives

    df = spark.createDataFrame([(1, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives(df.limit(0), F.lit(True)).count() == 0
    assert hard_negatives(df, F.col("vec_id") > 1).count() == 0
    assert hard_negatives(df, F.lit(True)).count() == 0


def test_index_leaves_out_what_the_bound_covers_and_loses_nothing():
    from tablewright.llm.hard_negatives import Index, Side

    rng = np.random.default_rng(8)
    vectors = np.floor(rng.normal(0, 60, (500, 40)) * np.geomspace(8, 0.1, 40)).astype(np.int64)
    side = Side(vectors, np.arange(500), np.zeros(500, str), np.arange(500))
    index = Index(side)
    asked = side.take(np.arange(30))
    exact = asked.vectors @ vectors.T
    for share in (0.05, 0.3, 0.6, 0.9):
        least = np.floor(share * exact.max(axis=1))
        score, alive = index.scores(asked, least)
        reaches = exact >= least[:, None]
        assert (alive | ~reaches).all() and (score[alive] == exact[alive]).all()
    lists = (index.left * index.norms(asked.vectors[:, index.dims]).max(axis=0) >= least.min()).sum(axis=1)
    assert (lists < len(index.edges) - 1).any() and not alive.all()


# 13 -----------------------------------------------------------------------------------------------
def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree_of(nodes):
    proofs, own = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        up, up_own = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k:k + 8]
            for j, below in enumerate(own[k:k + 8]):
                for leaf in below:
                    proofs[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(H(*run))
            up_own.append([x for below in own[k:k + 8] for x in below])
        nodes, own = up, up_own
    return nodes[0], proofs


def manifest_of(rows):
    """Brute force over (doc_id, source, lang, n_chars, text) rows."""
    if not rows:
        return []
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    subroots, proofs = [], {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        subroot, proofs[k] = tree_of([leaf_of(r) for r in groups[k]])
        subroots.append(subroot)
    root, above = tree_of(subroots)
    out = []
    for g, k in enumerate(keys):
        for r, own in zip(groups[k], proofs[k]):
            node = leaf_of(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf_of((*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])))
            for left, right in own + above[g]:
                node = H(left, node, right)
            out.append((r[0], leaf_of(r), subroots[g], root, H(*[a + b for a, b in own + above[g]]), node, node == root))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 1100])
def test_manifest_against_brute_force(spark, n):
    from tablewright.llm.merkle import manifest, proof_digest

    rng = random.Random(n)
    langs = [None, "en", "en", "en", "en", "en", "é", "zz", "", "Z"]
    rows = [(rng.choice([i, rng.randrange(n), None]), rng.choice("ab"), rng.choice(langs), rng.choice([None, i % 3]), rng.choice([None, "", "Abc É"]))
            for i in range(n)]
    rows += rows[:3]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = manifest(df, tampered=third).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=repr) == manifest_of(rows)


def test_manifest_of_many_groups_and_of_one_large_group(spark):
    from tablewright.llm.merkle import manifest, proof_digest

    rows = [(i, "s", f"l{i % 520}" if i < 600 else "big", i, "T") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    got = manifest(df, tampered=third).select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "folded_root", "verified")
    assert sorted(map(tuple, got.collect()), key=repr) == manifest_of(rows)
