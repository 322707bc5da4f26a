"""Helpers that the operators share: added columns, saved tables, word hashes.

Operators take a DataFrame with any further columns and give it back with columns
added. An incoming column that has the name of an added one (in any case) is
replaced by it.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts are hashed in groups of rows of about so many bytes, which bounds a task's memory.
GROUP_BYTES = 4 << 20
# Rows that are computed and given back at once, and bytes of what is read of them; one row may have more.
ROWS = 1_000
BATCH_BYTES = 2 << 20
# Words are hashed in stretches of about so many bytes, which stay in a CPU's cache.
_STRETCH = 1 << 18


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="termloom-llm-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors share.

    A local session without that setting gets a temporary folder; anywhere else
    its absence is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(table: DataFrame) -> DataFrame:
    """``table`` written as Parquet to the shared folder and read from there."""
    path = shared_folder(table.sparkSession)
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


@functools.cache
def _packed_code() -> str:
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="termloom-code-"), "termloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(package)))
    return path


_shipped = set()

# What makes a Python worker forget what an operator keeps between tasks, by the operator's module.
_FORGET: dict[str, Callable[[], None]] = {}
_LAST: list[str] = []


def kept_by(module: str, forget: Callable[[], None]) -> None:
    """Say how to give back what ``module`` keeps in a Python worker; done when another one's task begins there."""
    _FORGET[module] = forget


def _begin(module: str) -> None:
    if _LAST != [module]:
        for owner, forget in _FORGET.items():
            if owner != module:
                forget()
        _LAST[:] = [module]


@functools.cache
def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library, which keeps its own counsel
        return lambda _: 0


def _give_back() -> None:
    """Return freed memory to the system; workers are used again for many tasks."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    _trim()(0)


def _tidy(function: Callable, module: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _begin(module)
        yield from function(batches)
        _give_back()

    return run


def map_arrow(table: DataFrame, function: Callable, schema) -> DataFrame:
    """``table.mapInArrow``, with this package's code sent to the executors.

    What other modules' functions keep in a Python worker is given up before
    ``function``'s tasks run there.
    """
    context = table.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_packed_code())
        _shipped.add(context.applicationId)
    return table.mapInArrow(_tidy(function, function.__module__), schema)


def column(name: str) -> Column:
    return F.col(f"`{name}`")


def without(docs: DataFrame, names) -> DataFrame:
    """``docs`` less the columns that have one of ``names``, in any case."""
    taken = {n.lower() for n in names}
    return docs.select(*(column(c) for c in docs.columns if c.lower() not in taken))


def add_columns(
    docs: DataFrame,
    inputs: list[str],
    added: list[T.StructField],
    start: Callable[[], Callable[..., list]],
) -> DataFrame:
    """``docs`` with columns computed batch by batch.

    ``start`` is called once in a task. Its result takes the Arrow arrays of
    ``inputs`` and gives one list or Arrow array for each of ``added``.
    """
    needed = {n.lower() for n in inputs}
    clash = [f.name for f in added if f.name.lower() in needed]
    if clash:
        raise ValueError(f"{clash} are both read and added")
    docs = without(docs, [f.name for f in added])
    places = [[c.lower() for c in docs.columns].index(n.lower()) for n in inputs]
    schema = T.StructType([*docs.schema.fields, *added])
    names = schema.names
    kinds = [arrow_type(f.dataType) for f in added]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for whole in batches:
            for batch in small_batches(whole, places):
                made = compute(*(batch.column(p) for p in places))
                arrays = [
                    x if isinstance(x, pa.Array) else pa.array(x, kind)
                    for x, kind in zip(made, kinds, strict=True)
                ]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=names)

    run.__module__ = start.__module__
    return map_arrow(docs, run, schema)


def small_batches(
    whole: pa.RecordBatch, places: list[int], rows: int = ROWS, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """``whole`` in order, cut to ``rows`` rows and ``most`` bytes in the columns at ``places``, or one row."""
    size = np.zeros(len(whole), np.int64)
    for place in places:
        array = whole.column(place)
        if pa.types.is_string(array.type) or pa.types.is_binary(array.type):
            size += pc.binary_length(array).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(size)
    at = 0
    while at < len(whole):
        before = ends[at - 1] if at else 0
        to = int(np.searchsorted(ends, before + most, side="right"))
        to = min(max(to, at + 1), at + rows, len(whole))
        yield whole.slice(at, to - at)
        at = to


def rows_where(docs: DataFrame, inputs: list[str], operator: Callable, condition: str) -> DataFrame:
    """The rows of ``docs`` for which ``operator``'s result holds; all columns as they were.

    Columns that ``operator`` does not read are set aside under other names meanwhile.
    """
    inside = {c: c if c in inputs else f"_own_{k}" for k, c in enumerate(docs.columns)}
    marked = operator(docs.select(*(column(c).alias(n) for c, n in inside.items())))
    return marked.where(condition).select(*(F.col(n).alias(c) for c, n in inside.items()))


def arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(arrow_type(kind.elementType))
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "double": pa.float64(),
        "string": pa.string(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }[kind.simpleString()]


def strings(array: pa.Array) -> list[str]:
    """Null is the empty text."""
    return [x or "" for x in array.to_pylist()]


def byte_groups(array: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and row offsets of stretches of rows of about GROUP_BYTES."""
    array = array.fill_null("")
    if not len(array):
        return
    _, ends, data = array.buffers()
    ends = np.frombuffer(ends, np.int32)[array.offset : array.offset + len(array) + 1]
    ends = ends.astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(array):
        to = int(np.searchsorted(ends, ends[row] + GROUP_BYTES, side="right")) - 1
        to = min(max(to, row + 1), len(array))
        yield row, data[ends[row] : ends[to]], ends[row : to + 1] - ends[row]
        row = to


# Word classes, as bytes of UTF-8: which ones belong to a word.
LETTERS_AND_DIGITS = np.array(
    [48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]
)
NOT_BLANK = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])

_ONE = np.uint64(1)
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lower(b: int) -> int:
    return b + 32 if 65 <= b <= 90 else b


# A fixed random value for each byte; A-Z have those of a-z.
_VALUES = mix(np.array([_lower(b) + 1 for b in range(256)], np.uint64) * np.uint64(_P))


@functools.lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, _P, np.uint64), np.full(size, _P_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def words(
    data: np.ndarray, ends: np.ndarray, kind: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of the words of some texts in lower case (A-Z), and their places.

    ``data`` are the texts' bytes, ``ends`` the rows' offsets in them, ``kind``
    the word class. Returns the hash, first byte and end byte of every word.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none
    inside = kind[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    before[cuts] = False
    after[cuts - 1] = False
    first = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hashes = np.empty(len(first), np.uint64)
    k = 0
    while k < len(first):
        to = int(np.searchsorted(first, first[k] + _STRETCH, side="left"))
        lo, hi = int(first[k]), int(end[to - 1])
        size = 1 << max(18, (hi - lo).bit_length())
        up, down = _powers(size)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_VALUES[data[lo:hi]] * up[: hi - lo], out=sums[1:])
        hashes[k:to] = (sums[end[k:to] - lo] - sums[first[k:to] - lo]) * down[first[k:to] - lo]
        k = to
    return mix(hashes), first, end


def combine(parts: list[np.ndarray]) -> np.ndarray:
    """One hash for each run of neighbouring words; ``parts`` are the runs' words."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(out * np.uint64(_P) + part)
    return out


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the runs of ``size`` words of one text.

    A text with fewer words is one run; a text without words has none.
    """
    n = len(hashes)
    size = min(size, n)
    if not n:
        return np.zeros(0, np.uint64)
    return combine([hashes[j : n - size + 1 + j] for j in range(size)])


def word_rows(array: pa.Array, kind: np.ndarray) -> Iterator[tuple[np.ndarray, bytes, np.ndarray, np.ndarray]]:
    """For each text: its words' hashes, its bytes, and the words' first and end bytes in them."""
    for _, data, ends in byte_groups(array):
        hashes, first, end = words(data, ends, kind)
        places = np.searchsorted(first, ends)
        for r in range(len(ends) - 1):
            a, b, at = places[r], places[r + 1], ends[r]
            yield hashes[a:b], data[at : ends[r + 1]], first[a:b] - at, end[a:b] - at
