"""Byte-level BPE by monoid tree reduction.

Encodings of neighbouring pieces can be joined without starting afresh, so a text
is encoded as a tree: its halves are encoded, and the two results joined.

* In bytes: a sequence of tokens is the encoding of its bytes exactly if each two
  neighbours are the encoding of theirs. Two encodings are joined by encoding anew
  a window about the boundary, which grows to the side where its outer token and
  the neighbour outside are not yet such a pair. Then nothing outside can change.
* In text: the split pattern reads forwards, looks ahead by no more than LOOK
  characters and never back. What ends LOOK characters before the left half's end
  stays as it is. The window starts there and grows into the right half until a
  piece of it ends where a piece of the right half begins. From there on, both
  read the same text.

Decoding concatenates the bytes of the halves in the same way.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import struct
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from termloom.llm.common import add_columns, kept_by, strings

# Characters of a text that are encoded without being halved.
LEAF = 4096
# Bytes of a piece that are encoded without being halved.
LEAF_BYTES = 6
# Bytes up to which a window is merged by scanning it.
SCANNED = 64
# How far the pattern looks beyond the end of a match: a contraction has 3 characters.
LOOK = 4
# Distinct words, pairs and windows that a Python worker remembers of each.
REMEMBERED = 150_000


class Encoder:
    """Encode and decode with a table of ranks; the longest common byte strings have the lowest."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        # The tokens' bytes one after the other, for decoding.
        self.sizes = np.array([len(t) for t in self.bytes_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(self.bytes_of), np.uint8)
        self.never = len(ranks) + max(ranks.values())
        self.find = regex.compile(pattern).finditer
        self.pairs: dict[tuple[int, int], bool] = {}
        self.merged: dict[bytes, list[int]] = {}
        self.words: dict[str, bytes] = {}

    # Bytes of one piece.

    def merge(self, data: bytes) -> list[int]:
        """Join the neighbours of lowest rank, the first such, until none can be joined."""
        if len(data) > SCANNED:
            return self._merge_long(data)
        known = self.merged.get(data)
        if known is not None:
            return known
        get, never = self.ranks.get, self.never
        parts = [data[i : i + 1] for i in range(len(data))]
        costs = [get(data[i : i + 2], never) for i in range(len(data) - 1)]
        while costs:
            low = min(costs)
            if low == never:
                break
            i = costs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], never)
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], never)
        known = [get(p) for p in parts]
        if len(data) <= 16:
            _remember(self.merged, data, known)
        return known

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap, for windows in which all bytes shift."""
        get, n = self.ranks.get, len(data)
        parts: list[bytes | None] = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            k = after[i]
            if parts[i] is None or k >= n or get(parts[i] + parts[k]) != rank:
                continue
            parts[i] += parts[k]
            parts[k] = None
            after[i] = after[k]
            if after[k] < n:
                before[after[k]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] < n:
                    rank = get(parts[a] + parts[after[a]])
                    if rank is not None:
                        heapq.heappush(heap, (rank, a))
        return [get(p) for p in parts if p is not None]

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens encode their own bytes."""
        known = self.pairs.get((left, right))
        if known is None:
            known = self.merge(self.bytes_of[left] + self.bytes_of[right]) == [left, right]
            _remember(self.pairs, (left, right), known)
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = b"".join(map(self.bytes_of.__getitem__, left[-i:] + right[:j]))
            middle = self.merge(window)
            left_done = i == len(left) or self.stable(left[-i - 1], middle[0])
            right_done = j == len(right) or self.stable(middle[-1], right[j])
            if left_done and right_done:
                return left[: len(left) - i] + middle + right[j:]
            i = i if left_done else min(2 * i, len(left))
            j = j if right_done else min(2 * j, len(right))

    def encode_bytes(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.encode_bytes(data[:half]), self.encode_bytes(data[half:]))

    def encode_piece(self, piece: str) -> bytes:
        """Ids as little-endian 32-bit integers, as in all that follows."""
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = self.encode_bytes(data) if whole is None else [whole]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode_word(self, word: str) -> bytes:
        if word.isalpha() or word[0] == " " and word[1:].isalpha():
            ids = self.encode_piece(word)
        else:
            known = self.words
            ids = b"".join(
                known.get(m[0]) or self.encode_piece(m[0]) for m in self.find(word)
            )
        if len(word) <= 64:
            _remember(self.words, word, ids)
        return ids

    # Text: stretches of whole pieces as (end, ids), the end counted from the text's start.

    def split(self, text: str, offset: int = 0) -> tuple[list[int], list[bytes]]:
        """Ends and ids of a text's words.

        A blank before a character that is not blank always begins a piece, so
        words that were seen before are looked up whole.
        """
        words = words_of(text)
        ids = list(map(self.words.get, words))
        if None in ids:
            ids = [self.encode_word(w) if x is None else x for w, x in zip(words, ids)]
        return list(accumulate(map(len, words), initial=offset))[1:], ids

    def _tree(self, text: str, lo: int, hi: int) -> tuple[list[int], list[bytes]]:
        if hi - lo <= LEAF:
            return self.split(text[lo:hi], lo)
        half = (lo + hi) // 2
        return self._join_texts(text, lo, hi, self._tree(text, lo, half), self._tree(text, half, hi))

    def _join_texts(self, text, lo, hi, left, right):
        (ends, tokens), (right_ends, right_tokens) = left, right
        border = ends[-1] if ends else lo
        kept = len(ends)
        while kept and ends[kept - 1] > border - LOOK:
            kept -= 1
        start = ends[kept - 1] if kept else lo
        size = 1
        while True:
            last = size >= len(right_ends)
            stop = hi if last else right_ends[size - 1]
            found, own = self.split(text[start:stop], start)
            if last:
                return ends[:kept] + found, tokens[:kept] + own
            shared = set(right_ends[:size])
            for k, end in enumerate(found):
                if end in shared and end <= stop - LOOK:
                    at = right_ends.index(end) + 1
                    return (
                        ends[:kept] + found[: k + 1] + right_ends[at:],
                        tokens[:kept] + own[: k + 1] + right_tokens[at:],
                    )
            size *= 2

    def encode(self, text: str) -> bytes:
        if len(text) <= LEAF:
            return b"".join(self.split(text)[1])
        return b"".join(self._tree(text, 0, len(text))[1])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) > LEAF:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        size = self.sizes[ids]
        end = np.cumsum(size)
        places = np.repeat(self.starts[ids] - end + size, size)
        return self.flat[places + np.arange(len(places))].tobytes()


def _remember(memory: dict, key, value) -> None:
    if len(memory) >= REMEMBERED:
        memory.clear()
    memory[key] = value


_WORD = regex.compile(r" (?=\S)")
_DOUBLE = regex.compile(r" \s")


def words_of(text: str) -> list[str]:
    if not text:
        return []
    first, *rest = _WORD.split(text) if _DOUBLE.search(text) else text.split(" ")
    words = [" " + w for w in rest]
    return [first, *words] if first else words


def load_ranks(text: bytes) -> dict[bytes, int]:
    """Ranks in the usual text form: base64 of the bytes, a blank, the rank."""
    lines = (line.split() for line in text.splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


@functools.lru_cache(maxsize=2)
def worker_encoder(name: str, pattern: str) -> Encoder:
    with open(SparkFiles.get(name), "rb") as file:
        return Encoder(load_ranks(file.read()), pattern)


kept_by(__name__, worker_encoder.cache_clear)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` (tokens of ``text``) and ``decoded`` (the bytes they stand for).

    ``ranks_path`` is a rank file that the driver can read; Spark sends it to the
    executors. Each match of ``pattern`` is encoded by itself. A null text counts
    as an empty one, which has no ids. Rows stay as they are and where they are.
    """
    return _encoded(docs, ranks_path, pattern, [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.BinaryType()),
    ], lambda ids, data: (np.frombuffer(ids, "<u4").astype(np.int32), data))


def encode_ids(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded_sha256``, the digest of the bytes they stand for."""
    return _encoded(docs, ranks_path, pattern, [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded_sha256", T.StringType()),
    ], lambda ids, data: (np.frombuffer(ids, "<u4").astype(np.int32), hashlib.sha256(data).hexdigest()))


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``n_tokens, ids_sha256, decoded_sha256`` in place of ids and bytes."""
    return _encoded(docs, ranks_path, pattern, [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ], lambda ids, data: (
        len(ids) // 4,
        hashlib.sha256(ids).hexdigest(),
        hashlib.sha256(data).hexdigest(),
    ))


def _encoded(docs, ranks_path, pattern, added, give):
    docs.sparkSession.sparkContext.addFile(ranks_path)
    name = ranks_path.rsplit("/", 1)[-1]

    def start():
        encoder = worker_encoder(name, pattern)

        def compute(texts: pa.Array):
            rows = []
            for text in strings(texts):
                ids = encoder.encode(text)
                rows.append(give(ids, encoder.decode(np.frombuffer(ids, "<u4"))))
            return [list(c) for c in zip(*rows)] if rows else [[] for _ in added]

        return compute

    return add_columns(docs, ["text"], added, start)
