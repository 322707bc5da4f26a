"""Token ids in files: Simple-8b words with escapes, in blocks that decode by themselves.

A file is a Parquet table; each row is a segment of whole documents, in ascending
order of doc_id over segments and files:

    shard, segment     order of the segment
    doc_ids, counts    documents and their numbers of ids (int64)
    words              64-bit words: 4 bits name a selector, 60 bits hold ids
    escapes            ids too wide for a slot (uint32), in order
    offsets            for each block: its first word, id and escape (int64)

Arrays are little-endian. A slot with all bits set stands for the next escape. The
last word of a block may have empty slots. Any block can be read alone, and all
words of a segment that share a selector are unpacked together.
"""

from __future__ import annotations

import functools
import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from termloom.llm.bpe import words_of
from termloom.llm.common import kept_by, map_arrow, small_batches, strings

# Ids in a slot's bits; a word has 60 bits of them. The last is the widest.
SELECTORS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15)]
WIDEST = SELECTORS[-1][1]
BLOCK_IDS = 8192
# A segment is closed once it has so many ids; one document may be longer.
SEGMENT_IDS = 1 << 18
# Words whose ids a Python worker remembers, and as many that it met before them.
REMEMBERED = 600_000
# Texts that are cut into words at once: rows, and bytes.
_ROWS, _BYTES = 4_000, 8 << 20
# A blank before another space of any kind, or one that this engine and Python may take differently.
_APART = r" [\s\x0b\x1c-\x1f\x{85}\x{a0}\p{Z}]"

# Bits that a value takes; one with all bits set is not available in any width.
_BITS = np.array([int(v + 1).bit_length() for v in range(1 << WIDEST)], np.int8)
_BITS[-1] = WIDEST
_COUNTS = np.array([n for n, _ in SELECTORS], np.int64)
_SEGMENT = (
    "shard int, segment bigint, n_ids bigint, before bigint, doc_ids binary, counts binary, "
    "words binary, escapes binary, offsets binary"
)


def pack_block(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and escapes of some ids below 2**32."""
    n = len(ids)
    top = (1 << WIDEST) - 1
    escaped = ids >= top
    slots = np.where(escaped, top, ids).astype(np.uint64)
    # Zeros behind the end fill the last word's empty slots.
    need = np.zeros(n + 64, np.int8)
    need[:n] = _BITS[slots]
    widest = {1: need}
    for k in (1, 2, 4, 8, 16):
        widest[2 * k] = np.maximum(widest[k][:-k], widest[k][k:])
    choice = np.full(n, len(SELECTORS) - 1, np.int8)
    for k, (count, bits) in reversed(list(enumerate(SELECTORS[:-1]))):
        part = 1 << (count.bit_length() - 1)
        most = np.maximum(widest[part][:n], widest[part][count - part : count - part + n])
        choice[most <= bits] = k
    steps, at, starts = _COUNTS[choice].tolist(), 0, []
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    kinds = choice[starts]
    words = kinds.astype(np.uint64) << np.uint64(60)
    padded = np.append(slots, np.zeros(60, np.uint64))
    for k, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero(kinds == k)
        if len(own):
            # The slots of a block's last word beyond its end are zero.
            values = padded[starts[own, None] + np.arange(count)]
            shifts = np.arange(count, dtype=np.uint64) * np.uint64(bits)
            words[own] |= np.bitwise_or.reduce(values << shifts, axis=1)
    return words, ids[escaped].astype(np.uint32)


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Words, escapes and block offsets of a segment."""
    words, escapes, offsets = [], [], []
    n_words = n_escapes = 0
    for at in range(0, len(ids), BLOCK_IDS):
        offsets.append((n_words, at, n_escapes))
        w, e = pack_block(ids[at : at + BLOCK_IDS])
        words.append(w.astype("<u8").tobytes())
        escapes.append(e.astype("<u4").tobytes())
        n_words += len(w)
        n_escapes += len(e)
    return b"".join(words), b"".join(escapes), np.array(offsets, "<i8").tobytes()


def unpack(words: bytes, escapes: bytes, offsets: bytes, n_ids: int) -> np.ndarray:
    """The ids of a segment."""
    if not n_ids:
        return np.zeros(0, np.uint32)
    words, escapes = np.frombuffer(words, "<u8"), np.frombuffer(escapes, "<u4")
    blocks = np.frombuffer(offsets, "<i8").reshape(-1, 3)
    kinds = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNTS[kinds]
    ends = np.append(blocks[1:, 0], len(words)) - 1
    # How many ids a block's last word has follows from where the next block begins.
    sums = np.cumsum(counts)
    before = sums[ends] - counts[ends] - np.append(0, sums[ends[:-1]])
    counts[ends] = np.diff(np.append(blocks[:, 1], n_ids)) - before
    starts = np.cumsum(counts) - counts
    out = np.empty(n_ids + 60, np.uint32)
    for k, (count, bits) in enumerate(SELECTORS):
        own = np.flatnonzero(kinds == k)
        if len(own):
            mask = np.uint64((1 << bits) - 1)
            values = (words[own, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(bits))) & mask
            # An escape has all bits of the widest slot; other widths never have all bits set.
            places = starts[own, None] + np.arange(count)
            used = np.arange(count) < counts[own, None]
            out[places[used]] = values[used]
    out = out[:n_ids]
    marked = np.flatnonzero(out == (1 << WIDEST) - 1)
    out[marked] = escapes
    return out


class WordEncoder:
    """A tokenizer of the ``tokenizers`` library, asked once for each distinct word.

    Its pattern begins a piece at every blank before a character that is not
    blank, so a text's ids are those of its words, each with the blank before it.
    Unknown words are encoded together and cut apart by their numbers of bytes.

    With ``special``, tokens added to the vocabulary are found in texts, as the
    library does by itself; texts that hold one are encoded whole. Without, they
    are encoded like any other text.
    """

    def __init__(self, path: str, special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Words hold no added token, unless they are to be encoded as other text.
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder().values() if special else ()
        self.added = [token.content for token in added]
        vocabulary = self.tokenizer.get_vocab()
        # In the byte-level alphabet a character stands for a byte.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, number in vocabulary.items():
            self.sizes[number] = len(token)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _first(self, word: str) -> bytes:
        """Ids of a word without a blank before it; few words begin a text, so many begin several."""
        if not word:
            return b""
        ids = self.firsts.get(word)
        if ids is None:
            if len(self.firsts) >= REMEMBERED // 8:
                self.firsts.clear()
            ids = self.firsts[word] = self._ids(word).tobytes()
        return ids

    def _whole(self, text: str) -> bytes:
        self.tokenizer.encode_special_tokens = False
        ids = self._ids(text).tobytes()
        self.tokenizer.encode_special_tokens = True
        return ids

    def _learn(self, words: list[str]) -> list[bytes]:
        """Ids of words that stand behind a blank each, given without it."""
        joined = [w for w in words if 0 < len(w) < 64 and not w[0].isspace()]
        parts = [joined[k : k + 64] for k in range(0, len(joined), 64)]
        found = {}
        texts = [" " + " ".join(part) for part in parts]
        for part, done in zip(parts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(done.ids, "<u4")
            ends = np.cumsum(np.fromiter(map(len, map(str.encode, part)), np.int64, len(part)) + 1)
            cuts = 4 * np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 4
            data, cuts = ids.tobytes(), [0, *cuts.tolist()]
            found.update(zip(part, map(data.__getitem__, map(slice, cuts, cuts[1:]))))
        if len(self.known) + len(found) > REMEMBERED:
            # Words that are met again come back from the older half.
            self.older, self.known = self.known, {}
        self.known.update(found)
        if len(joined) < len(words):
            found.update((w, self._ids(" " + w).tobytes()) for w in words if w not in found)
        return list(map(found.__getitem__, words))

    def inner(self, words: list[str]) -> list[bytes]:
        """Ids of different words, each with a blank before it that is not in ``words``."""
        ids = list(map(self.known.get, words))
        missing = [k for k, own in enumerate(ids) if own is None]
        unknown = []
        for k in missing:
            own = self.older.get(words[k])
            if own is None:
                unknown.append(k)
            else:
                ids[k] = self.known[words[k]] = own
        if unknown:
            for k, own in zip(unknown, self._learn([words[k] for k in unknown])):
                ids[k] = own
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        whole = {k: self._whole(t) for k, t in enumerate(texts) if any(a in t for a in self.added)}
        split = [[] if k in whole else words_of(t) for k, t in enumerate(texts)]
        words = list(dict.fromkeys(chain.from_iterable(split)))
        behind = [w for w in words if w[0] == " "]
        ids_of = dict(zip(behind, self.inner([w[1:] for w in behind])))
        ids_of.update((w, self._ids(w).tobytes()) for w in words if w[0] != " ")
        get = ids_of.__getitem__
        return [whole[k] if k in whole else b"".join(map(get, own)) for k, own in enumerate(split)]

    def encode_array(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, ``end`` behind each text's, and their numbers.

        Texts are cut at blanks, and equal words found, outside of Python; it sees each
        distinct word of these texts once. Texts in which a blank is followed by
        another, and those that hold an added token, are encoded by themselves.
        """
        texts = texts.fill_null("")
        n = len(texts)
        alone = pc.match_substring_regex(texts, _APART)
        for token in self.added:
            alone = pc.or_(alone, pc.match_substring(texts, token))
        alone = np.flatnonzero(alone.to_numpy(zero_copy_only=False))
        if len(alone):
            apart = self.encode(texts.take(pa.array(alone)).to_pylist())
            keep = np.ones(n, bool)
            keep[alone] = False
            texts = pc.if_else(pa.array(keep), texts, "")
        else:
            apart = []
        pieces = pc.split_pattern(texts, " ")
        starts = pieces.offsets.to_numpy()
        coded = pieces.values.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        table = self.inner(words)
        # A text's first piece has no blank before it; then come texts of their own, and the end.
        firsts = pieces.values.take(pa.array(starts[:-1])).to_pylist()
        table += [self._first(f) for f in firsts]
        for k, ids in zip(alone.tolist(), apart):
            table[len(words) + k] = ids
        table.append(np.array([end], "<u4").tobytes())
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 4
        flat = np.frombuffer(b"".join(table), "<u4")
        places = coded.indices.to_numpy().astype(np.int64)
        places[starts[:-1]] = len(words) + np.arange(n)
        places = np.insert(places, starts[1:], len(table) - 1)
        counts = sizes[places]
        ends = np.cumsum(counts)
        at = np.repeat((np.cumsum(sizes) - sizes)[places] - ends + counts, counts)
        at += np.arange(len(at))
        # Each text's pieces are followed by its end.
        total = ends[starts[1:] + np.arange(n)] if n else ends
        return flat[at], np.diff(total, prepend=0)


@functools.lru_cache(maxsize=2)
def _worker_encoder(name: str) -> WordEncoder:
    return WordEncoder(SparkFiles.get(name), special=True)


kept_by(__name__, _worker_encoder.cache_clear)


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Encode ``docs(doc_id, text)`` and write the ids to ``path``, in order of doc_id.

    Added tokens of the tokenizer that a text holds are ids of their own, as the
    library has it. Every document ends with ``end_id``; a null text counts as an empty one. Rows
    without doc_id come first, rows of one doc_id in order of their texts.
    ``tokenizer_path`` is a file that the driver can read; Spark sends it on.
    """
    spark = docs.sparkSession
    spark.sparkContext.addFile(tokenizer_path)
    name = os.path.basename(tokenizer_path)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches):
        encoder = _worker_encoder(name)
        shard = TaskContext.get().partitionId()
        state = {"segment": 0, "before": 0}
        docs, counts, parts, size = [], [], [], 0

        def segments(last: bool):
            """Segments of whole documents out of what was read, the rest of it only if it is the ``last``."""
            nonlocal docs, counts, parts, size
            ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
            ends = np.cumsum(np.array(counts, np.int64))
            row = 0
            while row < len(docs):
                before = ends[row - 1] if row else 0
                to = int(np.searchsorted(ends, before + SEGMENT_IDS)) + 1
                if to > len(docs) and not last:
                    break
                to = min(to, len(docs))
                yield segment(docs[row:to], counts[row:to], ids[before : ends[to - 1]])
                row = to
            before = ends[row - 1] if row else 0
            docs, counts, parts, size = docs[row:], counts[row:], [ids[before:]], len(ids) - before

        def segment(docs, counts, ids):
            row = [
                shard, state["segment"], len(ids), state["before"], pack_ids(docs),
                np.array(counts, "<i8").tobytes(), *pack(ids),
            ]
            state["segment"] += 1
            state["before"] += len(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, _SEGMENT_TYPES)], names=_SEGMENT_NAMES
            )

        for batch in batches:
            for some in small_batches(batch, [1], _ROWS, _BYTES):
                ids, lengths = encoder.encode_array(some["text"], end_id)
                docs += some["doc_id"].to_pylist()
                counts += lengths.tolist()
                parts.append(ids)
                size += len(ids)
                if size >= SEGMENT_IDS:
                    yield from segments(last=False)
        yield from segments(last=True)

    map_arrow(ordered, run, _SEGMENT).write.option("compression", "uncompressed").parquet(path)


_NO_ID = np.iinfo(np.int64).min
_SEGMENT_NAMES = [c.split()[0] for c in _SEGMENT.split(", ")]
_SEGMENT_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.binary()] * 5


def pack_ids(docs: list) -> bytes:
    """Document ids; the smallest 64-bit number stands for none."""
    return np.array([_NO_ID if d is None else d for d in docs], "<i8").tobytes()


def read_ids(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` from the files of ``write_ids``.

    ``start`` counts the ids of all documents before it. With ``digest`` there is
    ``ids_crc32``, the CRC of the ids as little-endian 32-bit integers, in place of
    ``ids``.
    """
    segments = spark.read.parquet(path)
    # One row for each file: as many as there are shuffle partitions.
    totals = segments.groupBy("shard").agg(F.sum("n_ids").alias("total"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("shard", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    rows = segments.join(F.broadcast(bases), "shard").select(
        "n_ids", (F.col("base") + F.col("before")).alias("start"),
        "doc_ids", "counts", "words", "escapes", "offsets",
    )
    last = "ids_crc32 bigint" if digest else "ids array<bigint>"

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["words"], row["escapes"], row["offsets"], row["n_ids"]).astype("<u4")
                docs = np.frombuffer(row["doc_ids"], "<i8")
                counts = np.frombuffer(row["counts"], "<i8")
                ends = np.cumsum(counts)
                if digest:
                    data, cut = memoryview(ids.tobytes()), [0, *(4 * ends).tolist()]
                    result = pa.array([zlib.crc32(data[a:b]) for a, b in zip(cut, cut[1:])], pa.int64())
                else:
                    result = pa.ListArray.from_arrays(
                        pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))
                    )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, mask=docs == _NO_ID), pa.array(row["start"] + ends - counts), pa.array(counts), result],
                    names=["doc_id", "start", "n_tokens", last.split()[0]],
                )

    return map_arrow(rows, run, f"doc_id bigint, start bigint, n_tokens bigint, {last}")
