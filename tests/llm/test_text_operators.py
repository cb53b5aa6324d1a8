import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF_SMALL
from odd_rows import no_docs, odd_docs  # noqa: F401
from marketmarts.llm import bpe, chat, licenses, mixing, pii, quality, simhash, token_counts

RANKS = bpe.read_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ALPHABET = list("ab thE's'll're 12é😀漢\n\t\x85  ²_-=!") + ["the ", "<|endoftext|>", " \n", "   ", "<|endo", " '", "'ve"]


def texts(seed, n, longest=60):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, longest))) for _ in range(n)]


# simhash
def brute_components(fps, ids):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    out = {}
    for i in range(len(fps)):
        if ids[i] is not None:
            out[find(i)] = min(out.get(find(i), ids[i]), ids[i])
    return [out.get(find(i)) for i in range(len(fps))]


@pytest.mark.parametrize("bucket_rows", [20_000, 3])
def test_simhash_links_every_pair_within_three_bits(spark, bucket_rows):
    rnd = random.Random(1)
    fps = []
    for _ in range(40):
        f = rnd.getrandbits(64)
        fps += [f] + [f ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))) for _ in range(6)]
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    from marketmarts.llm.components import components

    got = {r.node: r.root for r in components(simhash.links(df, bucket_rows)).collect()}
    want = brute_components(fps, list(range(len(fps))))
    mine = [got.get(x, x) for x in signed]
    assert len({(a, b) for a, b in zip(mine, want)}) == len(set(mine)) == len(set(want))


def test_simhash_odd_rows(spark, odd_docs, no_docs):
    rows = simhash.simhash_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    zero = [r for r in rows if r.fingerprint == "0" * 16]
    assert len(zero) == 5 and {r.component_id for r in zero} == {0}
    assert simhash.simhash_components(no_docs).count() == 0
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id in (7, 8)").count() == 1


# tokens
def test_merge_matches_the_library():
    for t in texts(2, 800, 150):
        assert list(bpe.merge(t.encode(), RANKS)) == (ENC._encode_single_piece(t) if t else [])


def test_encode_and_decode(spark, odd_docs, no_docs):
    rows = [(i, t) for i, t in enumerate(texts(3, 300))] + [(900, None), (901, "ab" * 20000), (None, "hi"), (900, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.encode(df, RANKS, P.PATTERN, chunk_chars=500, memory_words=50)
    by = {(r.doc_id): r.ids for r in got.collect()}
    assert got.count() == len(rows) and all(by[i] == ENC.encode_ordinary(t or "") for i, t in rows)
    back = {r.doc_id: bytes(r.decoded).decode() for r in bpe.decode(got, bpe.token_table(spark, RANKS)).collect()}
    assert all(back[i] == (t or "") for i, t in rows)
    got = sorted(map(str, bpe.decoded(bpe.encode(odd_docs, RANKS, P.PATTERN), RANKS, digests=True).collect()))
    want = []
    for r in odd_docs.collect():
        ids = ENC.encode_ordinary(r.text or "")
        listed, text = ",".join(map(str, ids)).encode(), (r.text or "").encode()
        want.append(f"Row(doc_id={r.doc_id}, n_tokens={len(ids)}, ids_sha256='{hashlib.sha256(listed).hexdigest()}', "
                    f"decoded_sha256='{hashlib.sha256(text).hexdigest()}')")
    assert got == sorted(want)
    assert sorted(map(str, bpe.encode(odd_docs, RANKS, P.PATTERN, digests=True).collect())) == got
    assert bpe.encode(no_docs, RANKS, P.PATTERN, digests=True).count() == 0
    assert bpe.decoded(bpe.encode(no_docs, RANKS, P.PATTERN), RANKS, digests=True).count() == 0
    plain = bpe.decoded(spark.createDataFrame([(1, [1, 2]), (2, None)], "doc_id int, ids array<int>"), RANKS).collect()
    spell = {r: t for t, r in RANKS.items()}
    assert {r.doc_id: bytes(r.decoded) for r in plain} == {1: spell[1] + spell[2], 2: b""}


def test_every_prefix_count_is_exact(spark, odd_docs, no_docs):
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    spec = token_counts.read_tokenizer(P.path("byte_bpe_50k.json"))
    counter = token_counts.PrefixCounter(spec["merges"], P.PATTERN, spec["special"], memory_words=300)
    for t in texts(4, 80, 40):
        c = counter.prefix_counts(t)
        assert [len(lib.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)] == c.tolist()
        assert counter.count(t) == c[-1] and (token_counts.unpack_counts(token_counts.pack_counts(c)) == c).all()
    counted = token_counts.with_prefix_counts(odd_docs, spec, P.PATTERN)
    rows = token_counts.answers(counted, budget=5, at=4).collect()
    assert len(rows) == odd_docs.count() and all(r.fits_chars >= min(r.n_tokens, 1) for r in rows)
    assert token_counts.with_prefix_counts(no_docs, spec, P.PATTERN).count() == 0


# personal data
CHECKS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]


def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    return sorted((m.start(), k, m.end(), n) for k, (n, r, ok) in enumerate(CHECKS) for m in re.finditer(r, text) if ok(m.group()))


def test_base_spans_match_plain_regexes(spark, odd_docs, no_docs):
    rnd = random.Random(5)
    bits = list("aZ09.@+-% _(é😀") + [" ", "1", "2", ".", "@", "255.", "1.2.3.4", "4111 1111 1111 1111", "a@b.c", "+1 (555) 123-4567"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40)))) for i in range(600)]
    rows += [(9000, "1 " * 20000), (9001, "1.2 12 " * 5000), (9002, "x@y.zz " * 500), (9003, None)]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        want = ",".join(f"{n}:{s}:{e}" for s, _, e, n in base_spans(t or ""))
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[i].n_email == want.count("email") and set(want.split(",")) - {""} <= set(got[i].spans.split(","))
    assert pii.report(odd_docs).count() == odd_docs.count() and pii.report(no_docs).count() == 0
    clean = pii.sanitise(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    assert not [r for r in clean.collect() if base_spans(r.text or "")]


def test_terms_that_disclose_an_entity_are_found(spark):
    rows = [(i, f"please ask Zorbak about it zorbak@mail.com soon common words {i}") for i in range(3)]
    rows += [(10 + i, "please ask about it soon common words everywhere") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.report(df).collect()}
    assert got[0].spans.startswith("term:11:17,email:27:42") and got[0].n_term == 1 and got[10].spans == ""
    out = {r.doc_id: r.text for r in pii.sanitise(df).collect()}
    assert out[0] == "please ask  about it <EMAIL> soon common words 0" and out[10] == rows[3][1]


def test_a_term_in_one_document_is_rated(spark):
    rows = [(0, "please ask Zorbak about it zorbak@mail.com soon common words")]
    rows += [(10 + i, "please ask about it soon common words everywhere") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.spans for r in pii.report(df).collect() if r.n_term} == {0: "term:11:17,email:27:42"}
    assert {r.doc_id: r.text for r in pii.sanitise(df).collect()}[0] == "please ask  about it <EMAIL> soon common words"


def test_terms_count_and_go_in_whole_documents(spark):
    far = " common words" * 20
    # Zorbak: always with the entity, near it in 5 of 10 documents, and twice in each
    rows = [(i, f"Zorbak asks{'' if i < 5 else far} zorbak@mail.com{far} zorbak {i}") for i in range(10)]
    # a card between digits that are none, a text without white space, a word that grows in lower case
    rows += [(20, "4111 1111 1111 1111 no 22 Quarrel"), (21, "x@y.zz,(Fiddle)(İzmirli)"), (22, "u@v.ww İİ Grumbler")]
    rows += [(100 + i, "asks common words") for i in range(987)]
    got = {r.doc_id: r for r in pii.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows[:13]:
        want = [w for w in ("Zorbak", "zorbak", "Quarrel", "Fiddle", "İzmirli", "Grumbler") if w in t.replace("zorbak@", "")]
        spots = [(m.start(), m.end()) for w in want for m in re.finditer(rf"{w}(?!@)", t)]
        assert sorted(spots) == [tuple(map(int, s.split(":")[1:])) for s in got[i].spans.split(",") if s.startswith("term")], t
    assert not got[100].n_term


# licences, mixing, quality, chat
def test_a_repeated_row_is_one_document(spark):
    rows = [(0, "please ask Zorbak about it zorbak@mail.com soon common words")]
    rows += [(10 + i, "please ask about it soon common words everywhere") for i in range(30)]
    for times in (1, 4):
        df = spark.createDataFrame(rows * times + rows[:1] * 3 + [(None, "ask Quip x@y.zz")] * times, "doc_id long, text string")
        got = {(r.doc_id, r.spans) for r in pii.report(df).collect() if r.n_term}
        assert got == {(0, "term:11:17,email:27:42"), (None, "term:4:8,email:9:15")}
        assert pii.report(df).count() == df.count()


def test_licences_odd_rows(odd_docs, no_docs):
    rows = {r.doc_id: r for r in licenses.report(odd_docs).collect()}
    assert rows[9].labels == "mit" and rows[9].score == 1.0 and rows[0].labels == "" and rows[0].n_words == 0
    assert licenses.report(no_docs).count() == 0


def test_template_without_a_phrase_is_found(spark):
    text = "intro " * 7 + "Licensed under CC BY-NC 4.0. " + "tail " * 9
    df = spark.createDataFrame([(1, text), (2, "licensed cc 4 0"), (3, "under cc by sa 4 0 licensed")], "doc_id long, text string")
    rows = {r.doc_id: r for r in licenses.report(df).collect()}
    assert (rows[1].labels, rows[1].base_labels, rows[1].score) == ("cc-by-nc", "", 1.0)
    assert rows[2].labels == "" and rows[3].labels == "cc-by-sa"


def test_a_notice_is_found_at_every_offset(spark):
    rnd = random.Random(6)
    parts = "licensed under the terms of cc by nc sa 4 0 released mit x y".split()
    rows = [(i, "intro " * i + "Licensed under the terms of CC BY NC 4.0" + " tail" * 9) for i in range(14)]
    rows += [(100 + i, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40)))) for i in range(200)]
    got = {r.doc_id: r for r in licenses.report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all((got[i].labels, got[i].score) == ("cc-by-nc", 1.0) for i in range(14))
    for i, t in rows:
        w, best, labels = re.findall("[a-z0-9]+", t.lower()), 0.0, set()
        for label, template in licenses.TEMPLATES:
            kinds, wide = set(template.split()), len(template.split())
            share = max((len(kinds & set(w[b:b + 2 * wide])) / len(kinds) for b in range(len(w))), default=0)
            if share >= licenses.THRESHOLD:
                best, labels = max(best, share), labels | {label}
        assert (got[i].labels, got[i].score) == (",".join(sorted(labels)), best)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    cur = con.execute(licenses.oracle())
    cols = [d[0] for d in cur.description]
    assert sorted(cur.fetchall()) == sorted(tuple(got[i][c] for c in cols) for i, _ in rows)


def test_licence_words_are_those_of_the_contract(spark):
    texts = ["".join(chr(c) for c in range(0x250)), "İK ſx😀a-b\x80c", "A" * 200000, "\U00010348\U00010348"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", licenses.words_of(F.col("t")).alias("w")).collect():
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.t)
        assert r.w == re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def sainte_lague(votes, seats):
    """Seats one by one to the highest quotient; ties to the first party."""
    won = [0] * len(votes)
    for _ in range(seats if any(votes) else 0):
        best = max((v / (2 * s + 1), -i) for i, (v, s) in enumerate(zip(votes, won)) if v > 0)
        won[-best[1]] += 1
    return won


def test_apportionment_is_plain_sainte_lague(spark):
    rnd = random.Random(9)
    groups = [([rnd.choice([0, 1, 7, 50.5, 1000, 99999]) for _ in range(rnd.randint(1, 9))], rnd.choice([0, 1, 3, 10, 500])) for _ in range(60)]
    rows = [(g, i, float(v), n) for g, (votes, n) in enumerate(groups) for i, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g int, i int, v double, n bigint")
    got = {}
    for r in mixing.apportion(df, "n", "v", ["g"], ["i"], "won").collect():
        got.setdefault(r.g, {})[r.i] = r.won
    for g, (votes, n) in enumerate(groups):
        assert [got[g][i] for i in range(len(votes))] == sainte_lague(votes, n), (votes, n)


def test_mix_takes_each_block_by_its_quota_and_makes_no_table_of_blocks(spark):
    rnd = random.Random(3)
    docs = [(i, rnd.choice(["a", "a", "a", "b", "c", None]), " ".join(["w"] * rnd.choice([0, 1, 7, 40, 200]))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    how = dict(block_words=16, shard_words=700)
    placed, sources = mixing.placed_rows(df, **how)
    rows, seats = placed.collect(), {}
    for r in rows:
        if r.blocks:
            assert r.blocks == -(-r.words // r.width) and 0 <= r.start < r.blocks
            seats[r.position, r.shard] = (r.words, r.blocks, r.quota, r.start, r.width)
    # quotas: seats of the sources by target, of their shards by blocks
    info = {r.position: r for r in sources.collect()}
    order = sorted(info)
    total = round(sum(info[p].target for p in order) / 16)
    won = sainte_lague([info[p].target for p in order], total)
    for p, n in zip(order, won):
        shards = sorted(s for q, s in seats if q == p)
        blocks = [seats[p, s][1] for s in shards]
        assert [seats[p, s][2] for s in shards] == sainte_lague(blocks, min(n, 2 * sum(blocks)))
    # block by block: quota times in all, as the formulas say for every document
    want = {}
    for r in rows:
        if r.blocks:
            words, blocks, quota, start, width = seats[r.position, r.shard]
            times = [quota // blocks + (((k + 1) * (quota % blocks) + start) // blocks - (k * (quota % blocks) + start) // blocks) for k in range(blocks)]
            assert sum(times) == quota
            want[r.id] = sum(times[w // width] for w in range(r.begin, r.end))
    mixed = mixing.mix(df, **how)
    assert {r.doc_id: r.taken for r in mixed.collect()} == {i: want.get(i, 0) for i, *_ in docs}
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
    texts = {}
    for r in mixing.mixed_texts(df, **how).collect():
        texts[r.doc_id] = texts.get(r.doc_id, 0) + len(r.text.split())
    assert texts == {i: n for i, n in want.items() if n}


def test_mix_keeps_small_sources(spark):
    sizes = {"big0": 90_000, "big1": 60_000, "one": 1} | {f"s{n}": n for n in (20, 50, 60, 120, 150, 200, 3000)}
    docs = [(i, s, " ".join(["w"] * min(1000, n - at))) for s, n in sizes.items() for i, at in enumerate(range(0, n, 1000))]
    df = spark.createDataFrame([(k, *d[1:]) for k, d in enumerate(docs)], "doc_id long, source string, text string")
    source = {k: d[1] for k, d in enumerate(docs)}
    taken, target = dict.fromkeys(sizes, 0), {}
    for r in mixing.mix(df).collect():
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.05 * target[s] for s in sizes), (taken, target)
    assert {r.source for r in mixing.mixed_texts(df).select("source").distinct().collect()} == set(sizes)


def test_mix_meets_targets(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = mixing.mix(docs, block_words=64, shard_words=3000).collect()
    assert len(rows) == docs.count() and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert rows and sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(docs, block_words=64, shard_words=3000).collect()))
    source = {r.doc_id: r.source for r in docs.collect()}
    size, target, taken = {}, {}, {}
    for r in rows:
        s = source[r.doc_id]
        size[s], target[s], taken[s] = r.source_size, r.target, taken.get(s, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= max(0.1 * target[s], 200) for s in size)
    # water filling by hand
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(size))}
    left, open_, want = 1.5 * sum(size.values()), set(size), {}
    while True:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 2 * size[s]}
        if not full:
            break
        want |= {s: 2.0 * size[s] for s in full}
        left -= sum(2.0 * size[s] for s in full)
        open_ -= full
    want |= {s: weight[s] * level for s in open_}
    assert all(abs(want[s] - target[s]) < 1e-6 * want[s] for s in size)
    odd = mixing.mix(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(r.taken <= 2 * r.size for r in odd)
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_texts(odd_docs).columns == odd_docs.columns


def test_mixed_texts_hold_the_taken_words(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect() if r.taken}
    got = {}
    for r in mixing.mixed_texts(docs).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == taken


def test_quality_on_held_out_labels(spark, odd_docs, no_docs):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).join(labels, "doc_id").filter("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.93
    assert len(model.pairs) > 0 and quality.score(odd_docs, model).count() == odd_docs.count()
    assert quality.keep_good(odd_docs, model).columns == odd_docs.columns and quality.score(no_docs, model).count() == 0
    # an id that stands very often brings no more rows than the bound
    crowd = docs.join(labels.filter("doc_id % 3 = 1"), "doc_id", "left_semi").select("doc_id", "text")
    often = crowd.unionAll(crowd).unionAll(crowd)
    seen = []
    fit, quality.fit = quality.fit, lambda x, y, **how: seen.append(len(y)) or fit(x, y, **how)
    try:
        quality.train(often, labels, max_rows=50)
    finally:
        quality.fit = fit
    assert seen == [50]
    none = quality.train(docs, labels.limit(0))
    assert {r.score for r in quality.score(odd_docs, none).collect()} == {0.5}


def test_chat_examples_and_odd_rows(spark):
    rows = [(1, 0, "system", "be # nice\\"), (1, 1, "user", "a </turn> b"), (1, 2, "assistant", "### user\n"), (1, 3, "user", None),
            (1, 4, "assistant", "two"), (1, 4, "assistant", "two"), (2, None, None, "x"), (None, 1, "assistant", "n"), (3, 0, "we\nird", "\\n")]
    clash = "conv_id long, turn long, role string, text string, id string, piece string, example int, head string"
    df = spark.createDataFrame([(*r, "x", "y", 7, None) for r in rows], clash)
    made = chat.expand(chat.pieces(df))
    full = {(r.id, r.example): r for r in made.collect()}
    assert full[(1, 1)].text[full[(1, 1)].loss_start:full[(1, 1)].loss_end] == "\\#\\#\\# user\n"
    assert full[(1, 3)].text.startswith(full[(1, 1)].text) and (2, 1) not in full
    assert full[(2, None)].text == "### \nx</turn>\n" and full[(2, None)].loss_start is None
    back = {r.conv_id: r for r in chat.read_back(made).collect()}
    assert back[1].n_turns == 6 and back[2].loss_chars == 0 and back[None].loss_chars == 1
    for c in (1, 2, 3, None):
        whole = "".join(f"{r or ''}\n{t or ''}\n" for i, _, r, t in rows if i == c)
        assert back[c].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
    assert back[1].formatted_chars == sum(len(r.text) for (c, k), r in full.items() if c == 1 and k)
    assert chat.read_back(chat.expand(chat.pieces(df.limit(0)))).count() == 0
    # many turns, long texts, examples over several Arrow batches
    long = [(5, t, "assistant" if t % 2 else "user", "#</" * (3 * t) + "z" * (200000 if t == 7 else 1)) for t in range(60)]
    (got,) = chat.read_back(chat.expand(chat.pieces(spark.createDataFrame(long, "conv_id long, turn long, role string, text string")))).collect()
    assert got.n_turns == 60 and got.loss_sha256 == hashlib.sha256("".join(x for *_, r, x in long if r == "assistant").encode()).hexdigest()
    cut = chat.expand(chat.pieces(df)).filter("id = 1").orderBy(F.desc("example"))
    with pytest.raises(Exception, match="without the context"):
        chat.read_back(cut.coalesce(1)).collect()
