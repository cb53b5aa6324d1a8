"""Exact token counts of every prefix of a text by dynamic programming.

A sequence of tokens is the encoding of its bytes if and only if every two
neighbours are (merging never reaches over a pair that stays apart).  So the
last token of a prefix is the one token t that ends there and is compatible
with the last token of the prefix before t, and

    count[i] = count[i - len(t)] + 1.

One pass over a pre-token gives the count of each of its prefixes.  Counts
of a text are put together from its pre-tokens and stored per character; the
number of tokens of any prefix, or the longest prefix within a budget, is
then read off without encoding anything again.

A prefix of a text is not always cut into the same pre-tokens as the text:
white space before a word, contractions and special strings are the cases
where the cut itself changes.  Their counts are corrected, so every stored
number is what the tokenizer would return for that prefix.

Nulls and ties: a null text counts as empty (0 tokens); null ids and repeated
rows are carried as they stand; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import json
import sys
from array import array
from collections.abc import Iterator
from types import SimpleNamespace
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketmarts.llm.common import field_type

MEMORY_WORDS = 800_000
TEXTS_AT_ONCE = 1024
_LAST_SPACE = regex.compile(r"\s{2,}(?=\S)")


def read_tokenizer(path: str) -> dict:
    """Vocabulary, merges and special strings of a byte-level BPE tokenizer file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    return {"merges": merges, "special": [t["content"] for t in spec["added_tokens"] if t["special"]]}


def _byte_names() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: printable ones are themselves, the rest follow from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Prefix counts of pre-tokens for one tokenizer; remembers words and pairs it has met."""

    def __init__(self, merges: list[tuple[str, str]], pattern: str, special: list[str], memory_words: int = MEMORY_WORDS):
        names = _byte_names()
        spell = lambda t: bytes(names[c] for c in t)
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)}
        for a, b in self.rank:
            joined = a + b
            if joined not in self.tokens and self._merge([joined[i:i + 1] for i in range(len(joined))]) == [joined]:
                self.tokens.add(joined)
        self.split = {a + b: (a, b, i) for (a, b), i in self.rank.items()}
        self.one_way = len(self.split) == len(self.rank)  # every token comes from one merge only
        self.longest = max(map(len, self.tokens))
        self.find = regex.compile(pattern).findall
        self.special = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if special else None
        self.memory_words = memory_words
        self.words: dict[str, tuple[int, bytes]] = {}
        self.pairs: dict[tuple[bytes, bytes], bool] = {}

    def _merge(self, parts: list[bytes]) -> list[bytes]:
        rank = self.rank
        while len(parts) > 1:
            best, where = None, -1
            for i in range(len(parts) - 1):
                r = rank.get((parts[i], parts[i + 1]))
                if r is not None and (best is None or r < best):
                    best, where = r, i
            if best is None:
                break
            parts = [*parts[:where], parts[where] + parts[where + 1], *parts[where + 2:]]
        return parts

    def _fits(self, left: bytes, right: bytes) -> bool:
        """Whether the two tokens stay apart when their bytes are encoded together."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= 4 * self.memory_words:
                self.pairs.clear()
            if self.one_way:
                known = not self._crossed(left, right)
            else:
                joined = left + right
                known = self._merge([joined[i:i + 1] for i in range(len(joined))]) == [left, right]
            self.pairs[key] = known
        return known

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int, int]]:
        """What stands at one edge of a token while it is merged: (part, rank it is formed at, rank it is consumed at)."""
        out, consumed = [], len(self.rank)
        while True:
            parts = self.split.get(token)
            formed = parts[2] if parts else -1
            out.append((token, formed, consumed))
            if not parts:
                return out
            token, consumed = parts[side], formed

    def _crossed(self, left: bytes, right: bytes) -> bool:
        """Whether a merge over the border comes due while both of its parts stand there (of equal ones the left goes first)."""
        rank = self.rank
        rights = self._edge(right, 0)
        for a, formed_a, until_a in self._edge(left, 1):
            for b, formed_b, until_b in rights:
                if formed_a < until_b and formed_b < until_a:
                    r = rank.get((a, b))
                    if r is not None and formed_a < r < until_a and formed_b < r <= until_b:
                        return True
        return False

    def extend(self, data: bytes, last: list[bytes], count: list[int]) -> None:
        """Fill ``last`` and ``count`` (both for prefixes 0..) up to the whole of ``data``."""
        tokens, fits, pairs, longest = self.tokens, self._fits, self.pairs, self.longest
        for end in range(len(count), len(data) + 1):
            for begin in range(end - longest if end > longest else 0, end):
                t = data[begin:end]
                if t in tokens:
                    if begin:
                        ok = pairs.get((last[begin], t))
                        if not (fits(last[begin], t) if ok is None else ok):
                            continue
                    last.append(t)
                    count.append(count[begin] + 1)
                    break

    def learn(self, words: list[str]) -> None:
        """Count all prefixes of new words; in sorted order a word starts from the prefix it shares with the one before."""
        if len(self.words) + len(words) > self.memory_words:
            self.words.clear()
        before = b""
        last: list[bytes] = [b""]
        count = [0]
        for word in sorted(words):
            data = word.encode("utf-8", "surrogatepass")
            most = min(len(data), len(before))
            same = 0
            while same < most and data[same] == before[same]:
                same += 1
            del last[same + 1:], count[same + 1:]
            self.extend(data, last, count)
            ends = count if len(data) == len(word) else [0, *(count[k] for k in accumulate(len(c.encode("utf-8", "surrogatepass")) for c in word))]
            self.words[word] = (count[-1], array("i", [y - x for x, y in zip(ends, ends[1:])]).tobytes())
            before = data

    def learn_all(self, texts: list[str]) -> None:
        """Learn the words of many texts at once: sorted together, they share most of their prefixes."""
        words = self.words
        new: set[str] = set()
        for text in texts:
            new.update([p for p in self.find(text) if p not in words])
        if new:
            self.learn(list(new))

    def steps(self, text: str) -> np.ndarray:
        """Change of the token count at each character of a text without special strings."""
        pieces = self.find(text)
        self._known(pieces)
        out = np.frombuffer(b"".join([self.words[p][1] for p in pieces]), np.intc).copy()
        for m in _LAST_SPACE.finditer(text):  # as a prefix the whole run is one pre-token
            self._set(out, m.start(), m.end() - 1, self.count_word(m.group()))
        if "'" in text:
            self._contractions(text, pieces, out)
        return out

    def _known(self, pieces: list[str]) -> None:
        words = self.words
        new = {p for p in pieces if p not in words}
        if new:
            room = len(words) + len(new) <= self.memory_words
            self.learn(list(new) if room else list(set(pieces)))

    def count_word(self, word: str) -> int:
        if word not in self.words:
            kept = dict(self.words) if len(self.words) >= self.memory_words else None
            self.learn([word])
            if kept is not None:
                n = self.words[word][0]
                self.words = kept
                return n
        return self.words[word][0]

    @staticmethod
    def _set(steps: np.ndarray, start: int, at: int, count: int) -> None:
        """Make the count gained from ``start`` through character ``at`` equal to ``count``; later ones stay."""
        off = count - int(steps[start:at + 1].sum())
        steps[at] += off
        if at + 1 < len(steps):
            steps[at + 1] -= off

    def _contractions(self, text: str, pieces: list[str], steps: np.ndarray) -> None:
        """'re, 've and 'll cut after two characters are an apostrophe and a letter apart."""
        place = 0
        for p in pieces:
            if p in ("'re", "'ve", "'ll"):
                self._set(steps, place, place + 1, self.count_word("'") + self.count_word(p[1]))
            place += len(p)

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count of every prefix: element i is that of the first i characters."""
        parts: list[np.ndarray] = []
        begin = 0
        for m in self.cut.finditer(text) if self.cut else ():
            segment = text[begin:m.start()]
            parts.append(self.steps(segment))
            parts.append(self._special_steps(segment, m.group()))
            begin = m.end()
        parts.append(self.steps(text[begin:]))
        return np.concatenate(([0], np.cumsum(np.concatenate(parts), dtype=np.int64))).astype(np.int32)

    def _special_steps(self, segment: str, special: str) -> np.ndarray:
        """A cut special string is ordinary text that may join the last pre-token before it."""
        pieces = self.find(segment)
        self._known(pieces)
        tail = pieces[-1] if pieces else ""
        base = self.words[tail][0] if tail else 0
        counts = [0]
        for k in range(1, len(special)):
            counts.append(sum(self.count_word(p) for p in self.find(tail + special[:k])) - base)
        return np.diff(np.array([*counts, 1], np.int32))

    def count(self, text: str) -> int:
        """Tokens of the whole text, from the same tables."""
        total, begin = 0, 0
        for m in self.cut.finditer(text) if self.cut else ():
            total += self._plain(text[begin:m.start()]) + 1
            begin = m.end()
        return total + self._plain(text[begin:])

    def _plain(self, text: str) -> int:
        pieces = self.find(text)
        self._known(pieces)
        words = self.words
        return sum([words[p][0] for p in pieces])


def pack_counts(counts: np.ndarray) -> bytes:
    """Prefix counts as steps of one byte, or of four where a step needs them; the first byte tells which."""
    steps = np.diff(counts)
    if not len(steps) or (steps.min() >= -128 and steps.max() <= 127):
        return b"\x01" + steps.astype("i1").tobytes()
    return b"\x04" + steps.astype("<i4").tobytes()


def unpack_counts(stored: bytes) -> np.ndarray:
    steps = np.frombuffer(stored, "i1" if stored[:1] == b"\x01" else "<i4", offset=1)
    return np.concatenate(([0], np.cumsum(steps, dtype=np.int64)))


def _workers_counter(key: tuple, make) -> PrefixCounter:
    """The Python worker's counter, kept from one task to the next."""
    held = sys.modules.setdefault("_prefix_counters", SimpleNamespace(by={}))
    if key not in held.by:
        held.by = {key: make()}
    return held.by[key]


def with_prefix_counts(docs: DataFrame, tokenizer: dict, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                       memory_words: int = MEMORY_WORDS) -> DataFrame:
    """(id, n_bytes, n_tokens, prefix_counts binary) per row; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)  # the vocabulary: some 50,000 merges
    key = (hash(json.dumps(tokenizer)), pattern, memory_words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _workers_counter(key, lambda: PrefixCounter(
            shared.value["merges"], pattern, shared.value["special"], memory_words))
        for b in batches:
            for begin in range(0, b.num_rows, TEXTS_AT_ONCE):
                part = [t.as_py() or "" for t in b.column(1).slice(begin, TEXTS_AT_ONCE)]
                counter.learn_all(part)
                rows = []
                for t in part:
                    c = counter.prefix_counts(t)
                    rows.append((len(t.encode("utf-8", "surrogatepass")), int(c[-1]), pack_counts(c)))
                yield pa.RecordBatch.from_arrays([
                    b.column(0).slice(begin, len(part)), pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.binary())],
                    names=["id", "n_bytes", "n_tokens", "prefix_counts"])

    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"id {field_type(docs, id_col)}, n_bytes bigint, n_tokens bigint, prefix_counts binary")
    return out.withColumnRenamed("id", id_col)


def answers(counted: DataFrame, budget: int, at: int | None = None, counts_col: str = "prefix_counts") -> DataFrame:
    """``counted`` with fits_chars (the longest prefix of at most ``budget`` tokens) and, if asked, tokens_at (of ``at`` characters)."""
    where = counted.columns.index(counts_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fits, tokens = [], []
            for x in b.column(where):
                c = unpack_counts(x.as_py() or b"\x01")
                fits.append(int(np.flatnonzero(c <= budget)[-1]))
                tokens.append(int(c[min(at, len(c) - 1)]) if at is not None else None)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fits, pa.int64()), pa.array(tokens, pa.int64())],
                                             names=[*b.schema.names, "fits_chars", "tokens_at"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    return counted.mapInArrow(run, schema + ", fits_chars bigint, tokens_at bigint")
