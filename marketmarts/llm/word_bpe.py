"""BPE encoding and decoding with forced boundaries.

A merge can only join neighbours that stand side by side inside some token.
Two adjacent bytes that are adjacent in no token of the vocabulary therefore
stay in different tokens whatever is merged around them: between them lies a
certain cut.  A word is cut there, its fragments are encoded independently,
each by the merge of lowest rank first, and the ids are concatenated.  A
fragment is encoded once per task and memory.

The tokenizer file's own normaliser and splitter (``tokenizers`` classes, no
model) give the words.  They run on pieces of text between ASCII white space,
which no word spans, each different piece once.  For pieces of printable ASCII
the file's splitting pattern is applied to the lower-cased piece, which is what
its normaliser and splitter come to there.

Texts are mapped where they lie; nothing is shuffled.  Every task gets the
vocabulary and its merges, whose size is that of the tokenizer file.

Decoding joins the tokens of the ids, as the library does for a tokenizer
without a decoder: token texts with one space between them.

Nulls and ties: a null text counts as empty and has no ids; null ids of rows
and repeated rows are carried as they stand; texts and words of any length are
taken whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketmarts.llm.common import field_type

MEMORY_CHARS = 1 << 24
BATCH_CHARS = 1 << 22


def read_spec(path: str) -> dict:
    """A tokenizer file's parts: vocabulary, merges, added tokens, end-of-word suffix, normaliser and splitter.

    Files whose options this module does not follow are refused.
    """
    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model = whole["model"]
    plain = {"dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False,
             "ignore_merges": False}
    odd = [k for k, v in plain.items() if model.get(k, v) not in (v, False)]
    odd += [t["content"] for t in whole["added_tokens"] if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]]
    if model["type"] != "BPE" or whole.get("decoder") or not model.get("end_of_word_suffix") or odd:
        raise ValueError(f"not a plain BPE with word ends: {odd}")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return {"vocab": model["vocab"], "merges": {m: r for r, m in enumerate(merges)}, "suffix": model["end_of_word_suffix"],
            "added": {t["content"]: t["id"] for t in whole["added_tokens"]},
            "plain_pattern": _plain_pattern(whole), "frame": json.dumps({**whole, "added_tokens": [], "post_processor": None, "truncation": None, "padding": None,
                                 "model": {**model, "vocab": {}, "merges": []}})}


def _plain_pattern(whole: dict) -> str | None:
    """The splitting pattern, if the normaliser does no more than NFC, white space to one space, and lower case."""
    norm, pre = whole["normalizer"] or {}, whole["pre_tokenizer"] or {}
    steps = [{k: v for k, v in n.items()} for n in norm.get("normalizers", [])]
    usual = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
    parts = pre.get("pretokenizers", [])
    if steps != usual or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
        return None
    split, level = parts
    if split["behavior"] != "Removed" or not split["invert"] or level["use_regex"] or level["add_prefix_space"]:
        return None
    return split["pattern"].get("Regex")


class WordBpe:
    """Encoder of words by certain cuts and merges; the same object serves all rows of a task.

    Ids are handed on as the bytes of 32-bit integers.
    """

    def __init__(self, spec: dict):
        self.vocab, self.merges, self.suffix = spec["vocab"], spec["merges"], spec["suffix"]
        frame = Tokenizer.from_str(spec["frame"])
        self.normalize, self.split = frame.normalizer.normalize_str, frame.pre_tokenizer.pre_tokenize_str
        self.added = spec["added"]
        self.added_in = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.plain = regex.compile(spec["plain_pattern"]).findall if spec["plain_pattern"] else None
        #: neighbours inside some token, and neighbours of which the second is the last byte of a word
        self.inside: set[str] = set()
        self.inside_end: set[str] = set()
        for token in self.vocab:
            self.inside.update(a + b for a, b in zip(token, token[1:]))
            if token.endswith(self.suffix):
                body = token[:-len(self.suffix)]
                self.inside.update(a + b for a, b in zip(body, body[1:-1]))
                self.inside_end.add(body[-2:])
        self.forget()

    def forget(self) -> None:
        #: ids of fragments within a word, of fragments that end one, and of words
        self.fragments: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        self.words: dict[str, bytes] = {}

    def cut(self, word: str) -> list[str]:
        """The word's bytes in fragments between certain cuts."""
        cuts = [i for i, (a, b) in enumerate(zip(word, word[1:-1]), 1) if a + b not in self.inside]
        if len(word) > 1 and word[-2:] not in self.inside_end:
            cuts.append(len(word) - 1)
        return [word[a:b] for a, b in zip([0, *cuts], [*cuts, len(word)])] if cuts else [word]

    def merge(self, fragment: str, ends: bool) -> list[int]:
        """Ids of a fragment: the pair of lowest rank is merged, leftmost first, until none is left.

        In long fragments pairs wait in a heap and neighbours in linked lists,
        so n symbols take n log n steps.
        """
        parts = list(fragment)
        if ends:
            parts[-1] += self.suffix
        if len(parts) > 64:
            return self._merge_long(parts)
        get, none = self.merges.get, len(self.merges)
        ranks = [get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), none)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), none)
        return [self.vocab[p] for p in parts]

    def _merge_long(self, symbols: list[str]) -> list[int]:
        part: list[str | None] = list(symbols)
        n, ranks = len(part), self.merges
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if part[i] != a or j < 0 or part[j] != b:
                continue
            part[i], part[j] = a + b, None
            after[i] = after[j]
            if (k := after[i]) >= 0:
                before[k] = i
                if (r := ranks.get((part[i], part[k]))) is not None:
                    heapq.heappush(heap, (r, i, part[i], part[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((part[h], part[i]))) is not None:
                heapq.heappush(heap, (r, h, part[h], part[i]))
        return [self.vocab[p] for p in part if p is not None]

    def word(self, word: str) -> bytes:
        known = self.words.get(word)
        if known is None:
            found = []
            parts = self.cut(word)
            for k, f in enumerate(parts, 1):
                ends = k == len(parts)
                ids = self.fragments[ends].get(f)
                if ids is None:
                    ids = self.fragments[ends][f] = array("i", self.merge(f, ends)).tobytes()
                found.append(ids)
            known = self.words[word] = b"".join(found)
        return known

    def piece(self, text: str) -> bytes:
        """Ids of a stretch of text: added tokens stand for themselves, all else is normalised, split and cut."""
        if not self.added_in or not (m := self.added_in.search(text)):
            return self._plainly(text)
        out, begin = [], 0
        for m in self.added_in.finditer(text):
            out += [self._plainly(text[begin:m.start()]), array("i", [self.added[m[0]]]).tobytes()]
            begin = m.end()
        return b"".join([*out, self._plainly(text[begin:])])

    def _plainly(self, text: str) -> bytes:
        if self.plain and text.isascii() and text.isprintable() and " " not in text:
            words = self.plain(text.lower())
        else:
            words = [w for w, _ in self.split(self.normalize(text))]
        return b"".join([self.words.get(w) or self.word(w) for w in words])


def encode(docs: DataFrame, spec: dict, id_col: str = "doc_id", text_col: str = "text",
           memory_chars: int = MEMORY_CHARS) -> DataFrame:
    """(id, ids array<int>) per row."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # the tokenizer file: some 49,000 tokens and merges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(shared.value)
        pieces = re.compile(r"[^ \t-\r]+").findall
        known: dict[str, bytes] = {}
        held = 0
        for b in batches:
            begin, chars, out = 0, 0, []
            for row, value in enumerate(b.column(1)):
                text = value.as_py() or ""
                found = pieces(text)
                fresh = [p for p in set(found) if p not in known]
                if held > memory_chars and fresh:
                    known.clear()
                    bpe.forget()
                    held, fresh = 0, list(set(found))
                for p in fresh:
                    known[p] = bpe.piece(p)
                    held += len(p)
                out.append(np.frombuffer(b"".join(map(known.__getitem__, found)), "<i4"))
                chars += len(text)
                if chars >= BATCH_CHARS or row + 1 == b.num_rows:
                    stops = np.cumsum([0, *map(len, out)], dtype=np.int32)
                    ids = pa.ListArray.from_arrays(pa.array(stops), pa.array(np.concatenate(out)))
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, row + 1 - begin), ids], names=["id", "ids"])
                    begin, chars, out = row + 1, 0, []

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {field_type(rows, 'id')}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, spec: dict, id_col: str = "doc_id", ids_col: str = "ids", digests: bool = False) -> DataFrame:
    """(id, decoded) per row of ``encoded``; with ``digests`` instead n_tokens, ids_sha256 and decoded_sha256.

    ids_sha256 is over the ids as little-endian unsigned 32-bit integers.
    A null array counts as empty; an id outside the vocabulary fails the job.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(
        {i: t for t, i in [*spec["vocab"].items(), *spec["added"].items()]})  # as large as the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = {i: t.encode() for i, t in shared.value.items()}
        for b in batches:
            out = []
            for ids in b.column(1):
                ids = np.array([], "<i4") if not ids.is_valid else ids.values.to_numpy(zero_copy_only=False).astype("<i4")
                text = b" ".join(map(names.__getitem__, ids.tolist()))
                out.append((len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())
                           if digests else (text.decode(),))
            columns = [pa.array(c) for c in zip(*out)] or [pa.array([], f.type) for f in fields]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["id", *(f.name for f in fields)])

    fields = ([pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
              if digests else [pa.field("decoded", pa.string())])
    shape = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "decoded string"
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"id {field_type(rows, 'id')}, {shape}").withColumnRenamed("id", id_col)
