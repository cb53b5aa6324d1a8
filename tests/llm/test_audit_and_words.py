"""Filter audit, word BPE and centroid clustering against plain versions."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from odd_rows import DOCS, no_docs, odd_docs  # noqa: F401
from conftest import SF_SMALL
from marketmarts.llm import centroids, filter_audit, word_bpe

SPEC = word_bpe.read_spec(P.path("word_bpe_49k.json"))
LIB = Tokenizer.from_file(P.path("word_bpe_49k.json"))
BPE = word_bpe.WordBpe(SPEC)


# filter audit
def fails(rows):
    """Per row the letters of the filters it fails."""
    out = []
    for i, t, *_ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        copy = i is not None and any(j is not None and j < i and (u or "") == t for j, u, *_ in rows)
        out.append({f for f, bad in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search(r"[#$%&*|]", t), copy)) if bad})
    return out


def audit_by_hand(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    out = {}
    for part in {r[2] or "" for r in rows}:
        docs = [(r[0], f) for r, f in zip(rows, fails(rows)) if (r[2] or "") == part]
        shapley = Counter()
        for order in map("".join, permutations("ABCDE")):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(f in d[1] for d in docs) - len(gone),
                                          sum(d[1] == {f} for d in docs), sum(d[0] in good for d in gone),
                                          sum(d[0] in toxic for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def collected(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
            for r in df.collect()}


def test_audit_matches_filters_applied_one_after_another(spark, odd_docs, no_docs):
    rnd = random.Random(4)
    rows = [tuple(r) for r in odd_docs.collect()]
    long = [" ".join(f"w{rnd.randint(0, 400)}" for _ in range(n)) for n in (99, 100, 101, 150)]
    texts = long + [x.upper() for x in long] + [x + " #" for x in long] + [("A" + "b" * 9 + " ") * 120, "q " * 100, "A" * 10 + "b" * 90]
    rows += [(100 + i, rnd.choice(texts), rnd.choice(["en", "", None, "de"]), None, 0, None, None, None, None) for i in range(200)]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in [*range(0, 300, 2), 100, 100, None]]
    label_frame = spark.createDataFrame([(*x, "clash", 9) for x in labels], "doc_id long, quality int, toxic int, part string, n int")
    got = collected(filter_audit.audit(spark.createDataFrame(rows, DOCS), label_frame))
    assert got == audit_by_hand(rows, [x for x in labels if x[0] is not None])
    assert filter_audit.audit(no_docs, label_frame).count() == 0
    alone = collected(filter_audit.audit(spark.createDataFrame(rows, DOCS), label_frame.limit(0)))
    assert all(r[4] == r[5] == 0 for r in alone.values())


def test_contraction_selects_pass_fail_or_all():
    cells = np.arange(96).reshape(3, 2, 2, 2, 2, 2)
    chosen = np.array([[filter_audit.PASS, filter_audit.FAIL, filter_audit.ALL, filter_audit.ALL, filter_audit.PASS]])
    assert filter_audit.contract(cells, chosen)[:, 0].tolist() == cells[:, 0, 1, :, :, 0].sum(axis=(1, 2)).tolist()


def test_words_of_the_audit_are_split_at_ascii_space_only(spark):
    for text in ["a\x0bb\tc\x1cd\xa0e f  g\r\n", "\n", "a" * 300000, "é" * 9 + "A"]:
        row = filter_audit.text_bits(spark.createDataFrame([(text,)], "text string"), "text").first()
        want = fails([(1, text)])[0]
        assert row.bits == sum(1 << k for k, f in enumerate("ABCD") if f in want)


# word BPE
CHUNKS = ["hello", "World's", "ANTIdisestablishment", "é", "é", "̈x", "ÅΣ", "İI", "漢字", "😀👍🏽", "12345", "...!!", "<|endoftext|>", "<|startoftext|>",
          "<|endof", "</w>", "a</w>", "'ll", "'", "​", "\xa0", "\x85", " ", "\x00", "\x1c", "﻿", "ſt", "ǆ", "한국어", "नमस्ते", "ไทย", " ", "\n", "\t\x0b"]


def library(text):
    ids = LIB.encode(text, add_special_tokens=False).ids
    return ids, LIB.decode(ids, skip_special_tokens=False)


def ids_of(text):
    return np.frombuffer(b"".join(BPE.piece(p) for p in re.findall(r"[^ \t-\r]+", text)), "<i4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.lists(st.sampled_from(CHUNKS), max_size=12).map("".join), st.text(max_size=40)))
def test_words_match_the_library(text):
    if not any(0xD800 <= ord(c) < 0xE000 for c in text):
        assert ids_of(text) == library(text)[0]


def test_cuts_lie_only_where_no_token_spans():
    rnd = random.Random(2)
    words = ["".join(rnd.choice("etaoinshrdlu€ſÃĤģłĻ!.,") for _ in range(rnd.randint(1, 30))) for _ in range(500)]
    cuts = 0
    for w in {v for x in words for v, _ in BPE.split(BPE.normalize(x))}:
        parts = BPE.cut(w)
        assert "".join(parts) == w
        assert [i for k, p in enumerate(parts, 1) for i in BPE.merge(p, k == len(parts))] == BPE.merge(w, True)
        assert BPE._merge_long([*w[:-1], w[-1] + "</w>"]) == BPE.merge(w, True)
        cuts += len(parts) - 1
    assert cuts > 50


def test_encode_and_decode_whole_texts(spark, odd_docs, no_docs):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice(CHUNKS + [" "] * 10) for _ in range(rnd.randint(0, 80))) for _ in range(60)]
    texts += ["z" * 30000, "ab!?" * 20000, "\x1c" * 3000]
    rows = [(i, t, None, None, 0, "x", "y", None, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    for memory in (word_bpe.MEMORY_CHARS, 10):
        encoded = word_bpe.encode(df, SPEC, memory_chars=memory)
        assert {r.doc_id: r.ids for r in encoded.collect()} == {i: library(t)[0] for i, t in enumerate(texts)}
    plain = word_bpe.decode(encoded.selectExpr("doc_id", "ids", "'c' AS id", "0 AS decoded"), SPEC)
    assert {r.doc_id: r.decoded for r in plain.collect()} == {i: library(t)[1] for i, t in enumerate(texts)}
    got = sorted(map(str, word_bpe.decode(word_bpe.encode(odd_docs, SPEC), SPEC, digests=True).collect()))
    want = []
    for r in odd_docs.collect():
        ids, text = library(r.text or "")
        want.append(f"Row(doc_id={r.doc_id}, n_tokens={len(ids)}, ids_sha256='{hashlib.sha256(np.array(ids, '<u4').tobytes()).hexdigest()}', "
                    f"decoded_sha256='{hashlib.sha256(text.encode()).hexdigest()}')")
    assert got == sorted(want)
    assert word_bpe.decode(word_bpe.encode(no_docs, SPEC), SPEC, digests=True).count() == 0


def test_word_bpe_query_on_whole_documents(spark):
    from marketmarts.llm.queries import op12_word_bpe

    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op12_word_bpe(spark, SF_SMALL).collect():
        ids, text = library(texts.pop(r.doc_id))
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert not texts


def test_other_tokenizer_files_are_refused():
    with pytest.raises(ValueError):
        word_bpe.read_spec(P.path("byte_bpe_50k.json"))


# centroids
def cluster_by_hand(rows, clusters, rounds, scale, width, seed):
    kept = [(i, tuple(int(np.floor(scale * x)) for x in np.array(v, np.float32).astype(float))) for i, v in rows
            if v is not None and len(v) == width and None not in v and np.isfinite(v).all()]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:clusters]
    means = [list(v) for _, v in first]

    def nearest():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        at = nearest()
        for c in range(len(means)):
            mine = [v for (_, v), (_, k) in zip(kept, at) if k == c]
            if mine:
                means[c] = [sum(x) // len(mine) for x in zip(*mine)]
    at = nearest()
    inertia = Counter()
    for d, c in at:
        inertia[c] += d
    names = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means]
    return sorted((str(i), c, d, inertia[c], sum(inertia.values()), names[c]) for (i, _), (d, c) in zip(kept, at))


@pytest.mark.parametrize("block_rows", [8192, 5])
def test_clusters_match_plain_rounds(spark, block_rows):
    rnd = np.random.default_rng(5)
    rows = [(i, (rnd.normal(size=4) * rnd.choice([1, 30])).astype(np.float32).tolist()) for i in range(80)]
    rows += [(200 + i, [0.5, -0.25, 0.0, 1.0]) for i in range(30)] + rows[:3] + [(7, [1.0, 1.0, 1.0, 1.0]), (None, [0.0] * 4)]
    odd = [(300, None), (301, [1.0]), (302, [1.0, None, 1.0, 1.0]), (303, [float("nan")] * 4), (304, [float("inf")] * 4), (305, [])]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows + odd], "vec_id long, embedding array<float>, vec string, n int, cluster int")
    how = dict(clusters=5, rounds=4, scale=64, width=4, seed=3)
    got = sorted((str(r[0]), *r[1:]) for r in centroids.cluster(df, block_rows=block_rows, **how).collect())
    assert got == cluster_by_hand(rows + odd, **how)
    assert centroids.cluster(df.limit(0), **how).count() == 0
    few = df.filter("vec_id IN (201, 202, 301)")
    assert [(r.cluster, r.distance) for r in centroids.cluster(few, **how).collect()] == [(0, 0), (0, 0)]
    big = spark.createDataFrame([(1, [1e30, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="reaches"):
        centroids.cluster(big, **how).count()
