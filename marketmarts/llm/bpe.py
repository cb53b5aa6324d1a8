"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Cut: every text is split into pre-tokens once.  Documents are gathered into
   chunks of about ``chunk_chars`` characters; a chunk keeps its pre-tokens as
   positions into its own list of distinct words, and the words themselves in
   one packed list per word bucket (bucket = hash of the word).  Chunks are
   stored, so this step runs once.
2. Words: the lists are shuffled by bucket.  All lists of a bucket pass
   through one task, which encodes each distinct word once and answers every
   list with the ids of its words, in order.
3. Reassembly: answers meet their chunk by a shuffle on the chunk number, and
   each document's ids are read off by position.

What is shuffled are distinct words per chunk and packed positions, not one
row per token.  A hot word is one entry per chunk, a hot document source is
only more chunks, and a task holds one chunk plus the words of one bucket
(the word memory is cleared at ``memory_words`` entries; a cleared word is
merely encoded again).

Decoding joins the token-byte table, which has one entry per token of the
vocabulary and is broadcast.  ``Decoder`` meets it row by row: ids are positions
in the table, so the join is a gather, and a row's ids stay in order without a
shuffle.  ``decoded`` runs it over any table of ids, ``encode`` with ``digests``
in the task that has put a row's ids together (a second worker for it in the
same stage would need the memory of one more batch of ids on every core).
``decode`` is the same join with one row per id, for plans that need it as a
DataFrame join.

Nulls and ties: a null text counts as empty and has no ids; null ids and
repeated rows are carried as they stand; a text of any length is one document
of a chunk of its own; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type, stored

CHUNK_CHARS = 1 << 25
MEMORY_WORDS = 1_000_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank of a .tiktoken file."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged until none is left.

    Candidate pairs wait in a heap and neighbours in linked lists, so a word
    of n bytes takes n log n steps.
    """
    if word in ranks:
        return (ranks[word],)
    n = len(word)
    if n < 64:
        parts = [word[i:i + 1] for i in range(n)]
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                r = ranks.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, where = r, i
            if best is None:
                break
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        return tuple(ranks[p] for p in parts)
    end = list(range(1, n + 1))  # of the part that starts here; 0 once it is swallowed
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not end[i] or j < 0 or end[j] != stop:
            continue
        end[i], end[j] = stop, 0
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
            if (r := ranks.get(word[i:end[after[i]]])) is not None:
                heapq.heappush(heap, (r, i, end[after[i]]))
        if before[i] >= 0 and (r := ranks.get(word[before[i]:stop])) is not None:
            heapq.heappush(heap, (r, before[i], stop))
    out, i = [], 0
    while i >= 0:
        out.append(ranks[word[i:end[i]]])
        i = after[i]
    return tuple(out)


def _packed_numbers(x: np.ndarray) -> bytes:
    """Numbers as byte planes: the planes of small numbers compress to almost nothing."""
    planes = x.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.compress(np.ascontiguousarray(planes).tobytes(), 6)


def _unpacked_numbers(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _pack(items: list[bytes]) -> bytes:
    """Byte strings as one blob: packed lengths, then everything in a row."""
    sizes = _packed_numbers(np.fromiter(map(len, items), np.uint32, len(items)))
    return len(sizes).to_bytes(4, "little") + sizes + zstandard.compress(b"".join(items), 3)


def _unpack(blob: bytes) -> list[bytes]:
    n = int.from_bytes(blob[:4], "little")
    raw = zstandard.decompress(blob[4 + n:])
    stops = np.cumsum(_unpacked_numbers(blob[4:4 + n]), dtype=np.int64).tolist()
    return [raw[a:b] for a, b in zip([0, *stops], stops)]


_CHUNK = "chunk bigint, docs binary, lengths binary, positions binary, buckets binary, lists array<struct<bucket:int,words:binary>>"


def _cut(docs: DataFrame, pattern: str, buckets: int, chunk_chars: int) -> DataFrame:
    """One row per chunk of documents: their ids, pre-token positions and distinct words by bucket."""

    def chunk_row(number: int, ids: list[pa.Array], lengths: list[int], positions: list[np.ndarray],
                  seen: dict[str, int]) -> pa.RecordBatch:
        # positions are renumbered by frequency, so that most fit one byte plane
        pos = np.concatenate(positions) if positions else np.empty(0, np.uint32)
        order = np.argsort(-np.bincount(pos, minlength=len(seen)), kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        names = list(seen)
        words = [names[i].encode() for i in order]
        of = np.fromiter((int.from_bytes(hashlib.blake2b(w, digest_size=4).digest()) % buckets for w in words),
                         np.uint32, len(words))
        by = np.argsort(of, kind="stable")
        lists = []
        for part in np.split(by, np.flatnonzero(np.diff(of[by])) + 1) if len(by) else []:
            lists.append({"bucket": int(of[part[0]]), "words": _pack([words[i] for i in part])})
        sink = pa.BufferOutputStream()
        table = pa.table({"id": pa.chunked_array(ids)})
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return pa.RecordBatch.from_pylist([{
            "chunk": number, "docs": sink.getvalue().to_pybytes(),
            "lengths": _packed_numbers(np.array(lengths, np.uint32)), "positions": _packed_numbers(rank[pos]),
            "buckets": _packed_numbers(of), "lists": lists}],
            schema=pa.schema([("chunk", pa.int64()), ("docs", pa.binary()), ("lengths", pa.binary()),
                              ("positions", pa.binary()), ("buckets", pa.binary()),
                              ("lists", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary())])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        lengths: list[int] = []
        positions: list[np.ndarray] = []
        seen: dict[str, int] = {}
        chars = 0
        for b in batches:
            begin = 0
            for row, value in enumerate(b.column(1)):
                text = value.as_py() or ""
                pieces = find(text)
                for p in pieces:
                    if p not in seen:
                        seen[p] = len(seen)
                positions.append(np.fromiter(map(seen.__getitem__, pieces), np.uint32, len(pieces)))
                lengths.append(len(pieces))
                chars += len(text)
                if chars >= chunk_chars:
                    ids.append(b.column(0).slice(begin, row + 1 - begin))
                    yield chunk_row(number, ids, lengths, positions, seen)
                    number, begin, chars, ids, lengths, positions, seen = number + 1, row + 1, 0, [], [], [], {}
            if begin < b.num_rows:
                ids.append(b.column(0).slice(begin))
        if lengths:
            yield chunk_row(number, ids, lengths, positions, seen)

    return docs.mapInArrow(run, _CHUNK)


def _id_width(ranks: dict[bytes, int]) -> str:
    return "<u2" if max(ranks.values(), default=0) < 1 << 16 else "<u4"


def _encode_lists(ranks, memory_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ranks.value
        width = _id_width(table)
        known: dict[bytes, bytes] = {}
        for b in batches:
            answers = []
            for blob in b.column(2):
                out = []
                for w in _unpack(blob.as_py()):
                    ids = known.get(w)
                    if ids is None:
                        if len(known) >= memory_words:
                            known.clear()
                        ids = known[w] = np.array(merge(w, table), width).tobytes()
                    out.append(ids)
                answers.append(_pack(out))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(answers, pa.binary())],
                                             names=["chunk", "bucket", "ids"])

    return run


class Decoder:
    """The token-byte table, met by the ids of one row after another."""

    def __init__(self, ranks: dict[bytes, int]):
        self.spell = {r: token for token, r in ranks.items()}
        self.name = {r: b"%d" % r for r in self.spell}

    def text(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spell.__getitem__, ids))

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of ids, digest of the decimal ids joined by commas, digest of the decoded bytes."""
        listed = b",".join(map(self.name.__getitem__, ids))
        return len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(self.text(ids)).hexdigest()


_DIGESTS = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
_DIGEST_SHAPE = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = CHUNK_CHARS, memory_words: int = MEMORY_WORDS, digests: bool = False) -> DataFrame:
    """(id, ids array<int>) per row; with ``digests`` the ids are decoded again and give n_tokens, ids_sha256, decoded_sha256."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared = spark.sparkContext.broadcast(ranks)  # the vocabulary: some 50,000 entries
    id_type = field_type(docs, id_col)
    chunks = stored(_cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), pattern,
                         buckets, chunk_chars), "bpe-chunks")
    lists = chunks.select("chunk", F.explode("lists").alias("l")).select("chunk", "l.bucket", "l.words")
    answers = lists.repartition(buckets, "bucket").mapInArrow(_encode_lists(shared, memory_words),
                                                              "chunk bigint, bucket int, ids binary")

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        width = _id_width(shared.value)
        parts = {b: _unpack(x) for b, x in zip(right.column("bucket").to_pylist(), right.column("ids").to_pylist())}
        row = left.to_pylist()[0]
        of = _unpacked_numbers(row["buckets"])
        each = {b: iter(p) for b, p in parts.items()}
        word_ids = [next(each[b]) for b in of.tolist()]
        positions = _unpacked_numbers(row["positions"])
        ids = pa.ipc.open_stream(row["docs"]).read_all().column("id")
        decoder = Decoder(shared.value) if digests else None
        out, begin = [], 0
        for n in _unpacked_numbers(row["lengths"]).tolist():
            one = b"".join(map(word_ids.__getitem__, positions[begin:begin + n].tolist()))
            out.append(decoder.digests(np.frombuffer(one, width).tolist()) if digests else one)
            begin += n
        if digests:
            return pa.table({"id": ids, **{name: pa.array([x[k] for x in out], kind) for k, (name, kind) in enumerate(_DIGESTS)}})
        size = np.dtype(width).itemsize
        stops = np.cumsum([0, *(len(x) // size for x in out)], dtype=np.int32)
        flat = np.frombuffer(b"".join(out), width).astype(np.int32)
        return pa.table({"id": ids, "ids": pa.ListArray.from_arrays(pa.array(stops), pa.array(flat))})

    both = chunks.drop("lists").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        reassemble, f"id {id_type}, {_DIGEST_SHAPE if digests else 'ids array<int>'}")
    return both.withColumnRenamed("id", id_col)


def decoded(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids",
            digests: bool = False) -> DataFrame:
    """(id, decoded binary) per row of ``encoded``; with ``digests`` instead n_tokens, ids_sha256 and decoded_sha256.

    ids_sha256 is over the decimal ids joined by commas.  A null array has no
    ids; an id without an entry in the table fails the job.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)  # the vocabulary: some 50,000 entries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for b in batches:
            out = []
            for row in b.column(1):
                ids = row.values.to_numpy(zero_copy_only=False).tolist() if row.is_valid else []
                out.append(decoder.digests(ids) if digests else (decoder.text(ids),))
            columns = [pa.array([x[k] for x in out], kind) for k, (_, kind) in enumerate(fields)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["id", *(n for n, _ in fields)])

    fields = _DIGESTS if digests else [("decoded", pa.binary())]
    shape = _DIGEST_SHAPE if digests else "decoded binary"
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {field_type(rows, 'id')}, {shape}").withColumnRenamed("id", id_col)


def token_table(spark: SparkSession, ranks: dict[bytes, int]) -> DataFrame:
    """(token_id, token): one row per vocabulary entry."""
    return spark.createDataFrame(pa.table({"token_id": pa.array(list(ranks.values()), pa.int32()),
                                           "token": pa.array(list(ranks), pa.binary())}))


def decode(encoded: DataFrame, tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, decoded binary) per row of ``encoded``: the token-byte table is joined and its bytes put in order.

    ``tokens`` has one row per vocabulary entry and is broadcast.  Rows that
    share an id are told apart by their ids; equal rows come back as often as
    they stand.  Ids outside the table fail the job.
    """
    rows = encoded.select(F.col(id_col).alias("id"), F.coalesce(F.col(ids_col), F.array().cast("array<int>")).alias("ids"))
    rows = rows.withColumn("digest", F.sha2(F.array_join("ids", ","), 256))
    spread = (rows.groupBy("id", "digest").agg(F.first("ids").alias("ids"), F.count("*").alias("times"))
              .select("id", "digest", "times", F.posexplode_outer("ids").alias("at", "token_id")))
    missing = F.raise_error(F.concat(F.lit("no token "), F.col("token_id").cast("string"))).cast("string")
    named = spread.join(F.broadcast(tokens), "token_id", "left").withColumn("spelt", F.when(
        F.col("token_id").isNull(), "").when(F.col("token").isNotNull(), F.hex("token")).otherwise(missing))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "spelt"))), lambda x: x["spelt"]), "")
    out = named.groupBy("id", "digest", "times").agg(F.unhex(joined).alias("decoded"))
    return out.select(F.col("id").alias(id_col), "decoded",
                      F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times"))).alias("_n")).drop("_n")
