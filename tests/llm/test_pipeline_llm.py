"""Every stage of the corpus pipeline against plain Python, row by row; odd rows and an empty table."""

import bisect
import hashlib
import math
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from odd_rows import no_docs, odd_docs  # noqa: F401
from test_text_operators import CHECKS, base_spans, brute_components
from marketmarts.llm import bpe, mixing, pii, quality, simhash

STAGES = dict(corpus_pipeline.STAGES)
SF = "/root/testdata/sf0.01"
WORD = regex.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def docs(spark):
    """Whole documents, some of them twice, with nulls and with planted entities and terms."""
    d = spark.read.parquet(f"{SF}/documents.parquet")
    some = d.filter("doc_id < 260").collect()
    rows = [tuple(r) for r in some] + [tuple(r) for r in some[:3]]
    rows += [(9000 + i, t, "en", s, len(t or "")) for i, (t, s) in enumerate([
        (None, "null"), ("", None), ("Zorbak writes to zorbak@mail.com about plans and meetings. " * 8, "own"),
        (some[5].text + " extra", "own"), (some[5].text, None), ("short note, Quarrel at 10.0.0.1 and +1 (555) 123-4567 for all of us", "own")])]
    return spark.createDataFrame(rows, d.schema).repartition(3)


# plain versions of the stages
def plain_score(model, text):
    x = quality.features((text or "").encode())
    total = model.intercept
    for f, (edges, table) in enumerate(zip(model.edges, model.tables)):
        total += table[bisect.bisect_right(edges.tolist(), x[f])]
    for (i, j), table in zip(model.pairs, model.pair_tables):
        total += table[bisect.bisect_right(model.pair_edges[i].tolist(), x[i]), bisect.bisect_right(model.pair_edges[j].tolist(), x[j])]
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def plain_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    bits = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in bits) > len(bits))


def plain_dedup(rows):
    comp = brute_components([plain_fingerprint(r[1]) for r in rows], [r[0] for r in rows])
    return sorted({r for r, c in zip(rows, comp) if r[0] == c}, key=str)


def plain_pii(rows):
    kinds = ["email", "ip", "card", "phone"]
    texts = {(r[0], r[1] or "") for r in rows}
    entities, terms = {}, {}
    for key in texts:
        t = key[1]
        entities[key] = {(kinds[k], t[a:b] if k < 2 else regex.sub("[^0-9]", "", t[a:b])) for a, k, b, _ in base_spans(t)}
        terms[key] = [(m.group().lower(), m.start(), m.end()) for m in regex.finditer(pii.TERM, t)]
    n = len(texts)
    c_t = Counter(w for key in texts for w in {w for w, _, _ in terms[key]})
    c_e = Counter(e for key in texts for e in entities[key])
    c_et = Counter((e, w) for key in texts for e in entities[key] for w in {w for w, _, _ in terms[key]})
    rated = {(e, w): math.log(c * n / (c_e[e] * max(c_t[w], c))) / math.log(n / c_e[e]) for (e, w), c in c_et.items() if c_e[e] < n}
    out = []
    for r in rows:
        key = (r[0], r[1] or "")
        base = [(a, b, f"<{kinds[k].upper()}>") for a, k, b, _ in base_spans(key[1])]
        cuts = list(base)
        for w, a, b in terms[key]:
            d = max((rated.get((e, w), 0) for e in entities[key]), default=0)
            if d >= pii.GENERALISE_AT - 1e-12 and not any(x < b and y > a for x, y, _ in base):
                cuts.append((a, b, "" if d >= pii.REMOVE_AT else "<WORD>"))
        merged = []
        for a, b, put in sorted(cuts):
            if merged and merged[-1][1] > a:
                merged[-1] = (merged[-1][0], max(merged[-1][1], b), merged[-1][2])
            else:
                merged.append((a, b, put))
        text, at, pieces = r[1], 0, []
        if merged:
            for a, b, put in merged:
                pieces += [text[at:a], put]
                at = b
            text = "".join(pieces) + text[at:]
        out.append((r[0], text, r[2], r[3], None if text is None else len(text)))
    return sorted(out, key=str)


def plain_mix(spark, rows, schema):
    """Texts by the words' places in the shards' streams, word by word."""
    placed, _ = mixing.placed_rows(spark.createDataFrame(rows, schema))
    by_doc = {}
    for p in placed.collect():
        by_doc.setdefault((p.id, p.size), []).append(p)
    out = []
    for r in sorted(rows, key=lambda r: (r[3] is None, r[3] or "")):
        pieces = regex.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", r[1] or "")
        if not pieces:
            continue
        p = sorted(by_doc[r[0], len(pieces)], key=lambda p: (p.position, p.shard, p.begin)).pop(0)
        by_doc[r[0], len(pieces)].remove(p)
        whole, rest = divmod(p.quota, p.blocks)
        more = [w for w in range(p.begin, p.end)
                if ((w // p.width + 1) * rest + p.start) // p.blocks > (w // p.width * rest + p.start) // p.blocks]
        texts = [r[1]] * whole
        if more:
            texts.append(r[1] if len(more) == len(pieces) else "".join(pieces[w - p.begin] for w in more))
        out += [(r[0], t, r[2], r[3], len(t)) for t in texts]
    return sorted(out, key=str)


def plain_tokens(rows):
    ranks = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for r in rows:
        ids = enc.encode_ordinary(r[1] or "")
        out.append((r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256((r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_every_stage_equals_its_plain_version(spark, docs, tmp_path):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.train(docs, labels)
    before = rows_of(docs)
    scores = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    assert all(abs(scores[r[0]] - plain_score(model, r[1])) < 1e-9 for r in before)
    want = sorted((r for r in before if plain_score(model, r[1]) >= quality.KEEP_AT), key=str)
    stage = corpus_pipeline.stored(STAGES["quality"](spark, docs, SF), "t")
    assert rows_of(stage) == want and 20 < len(want) < len(before)

    want = plain_dedup(want)
    assert rows_of(simhash.simhash_components(docs).select("doc_id", "fingerprint").distinct()) == sorted(
        {(r[0], f"{plain_fingerprint(r[1]):016x}") for r in before}, key=str)
    stage = corpus_pipeline.stored(STAGES["dedup"](spark, stage, SF), "t")
    assert rows_of(stage) == want

    want = plain_pii(want)
    stage = corpus_pipeline.stored(STAGES["pii"](spark, stage, SF), "t")
    assert rows_of(stage) == want and any("<EMAIL>" in (r[1] or "") for r in want)

    want = plain_mix(spark, want, docs.schema)
    stage = corpus_pipeline.stored(STAGES["mix"](spark, stage, SF), "t")
    assert rows_of(stage) == want

    assert rows_of(STAGES["tokens"](spark, stage, SF)) == plain_tokens(want)
    # run() is the same chain over the whole table
    folder = tmp_path / "sf"
    folder.mkdir()
    docs.write.parquet(str(folder / "documents.parquet"))
    labels.write.parquet(str(folder / "labels.parquet"))
    assert rows_of(corpus_pipeline.run(spark, str(folder))) == plain_tokens(want)


def test_stages_take_odd_rows_and_an_empty_table(spark, odd_docs, no_docs, tmp_path):
    for k, table in enumerate((odd_docs, no_docs)):
        out = table
        for name, stage in corpus_pipeline.STAGES:
            out = corpus_pipeline.stored(stage(spark, out, SF_SMALL), f"odd{k}")
            if name != "tokens":
                assert out.columns == table.columns, name
        assert (out.count() == 0) == (k == 1)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_dedup_keeps_the_same_row_in_every_run(spark, odd_docs):
    rows = odd_docs.collect()
    twice = [tuple(r)[:3] + ("other",) + tuple(r)[4:] for r in rows] + [tuple(r) for r in rows]
    runs = {str(rows_of(simhash.keep_one(spark.createDataFrame(twice, odd_docs.schema).repartition(n)))) for n in (1, 3, 8)}
    assert len(runs) == 1


def plain_tree(g, h, rate, least, ridge):
    """Two levels of best splits, tried one by one."""
    def leaf(a, b):
        return -rate * sum(g[a:b]) / (sum(h[a:b]) + ridge)

    def best(a, b):
        gain = lambda x, y: sum(g[x:y]) ** 2 / (sum(h[x:y]) + ridge)
        tries = [(gain(a, c) + gain(c, b) - gain(a, b), -c) for c in range(a + 1, b) if sum(h[a:c]) >= least and sum(h[c:b]) >= least]
        top = max(tries, default=(0, 0))
        return -top[1] if top[0] > 1e-9 else 0

    cut = best(0, len(g))
    out = [0.0] * len(g)
    for lo, hi in ((0, cut), (cut, len(g))) if cut else ((0, len(g)),):
        inner = best(lo, hi) if cut else 0
        for a, b in ((lo, inner), (inner, hi)) if inner else ((lo, hi),):
            out[a:b] = [leaf(a, b)] * (b - a)
    return out


def test_boosting_equals_loops():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(300, 3))
    y = (x[:, 0] + 0.5 * x[:, 1] ** 2 > 0.3).astype(float)
    model = quality.fit(x, y, bins=8, rounds=3, pair_rounds=0, n_pairs=0)
    margin = np.full(len(y), math.log(y.mean() / (1 - y.mean())))
    tables = [np.zeros(len(e) + 1) for e in model.edges]
    for _ in range(3):
        for f, edges in enumerate(model.edges):
            g, h = [0.0] * len(tables[f]), [0.0] * len(tables[f])
            spot = [bisect.bisect_right(edges.tolist(), v) for v in x[:, f]]
            for k, s in enumerate(spot):
                p = 1 / (1 + math.exp(-margin[k]))
                g[s] += p - y[k]
                h[s] += max(p * (1 - p), 1e-6)
            step = np.array(plain_tree(g, h, 0.15, 2.0, 1.0))
            tables[f] += step
            margin = margin + step[spot]
    assert all(np.allclose(a, b) for a, b in zip(model.tables, tables))
