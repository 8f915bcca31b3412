"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model has a word marker after another character, so no merge
crosses the place where a marker follows a character that is none.  A text is
therefore a sequence of *chunks*, each a run of markers and the characters up
to the next marker, and every chunk can be segmented on its own.

1. A task cuts its texts into blocks and every block into its distinct chunks.
   The chunks are dealt by hash into as many ranges as there are shuffle
   partitions; a block sends each range one compressed package: the chunks and
   the places where the block has them, as distances.  Texts go nowhere.
   Chunks with more than ``1 / SPREAD`` of a block's places are dealt by the
   block as well, so no range gets many places of one frequent chunk.
2. A range holds all packages with its chunks.  Its table of distinct chunks
   segments each once and gives the packages ids in place of chunks.  Beyond
   ``TABLE_BYTES`` the table starts anew, which costs time only.
3. Each block decodes its distinct chunks once and puts ids and decoded chunks
   back by place.

Two shuffles of packages, some 1.5 bytes a chunk and the distinct chunks of
each block; nothing else is written.  A block holds ``BLOCK_BYTES`` of text or a
single longer one, so no task holds more than its largest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.taskcontext import TaskContext
from sentencepiece import sentencepiece_model_pb2 as proto

from . import textcore

MARK = "▁"
BLOCK_BYTES = 8 << 20
SPREAD = 512
TABLE_BYTES = 64 << 20
SEGMENT_ROWS = 1 << 14  # chunks segmented at a time

_CHUNK = re.compile(" +[^ ]+")  # of a package: none ends in a space
_CROSSING = re.compile(f"[^{MARK}]{MARK}")


class Segmenter:
    """Pieces of single chunks; one processor without the marker that a text gets in front."""

    _last: tuple = (None, None)

    def __init__(self, model: bytes):
        spec = proto.ModelProto()
        spec.ParseFromString(model)
        spec.normalizer_spec.add_dummy_prefix = False
        self._bare = sentencepiece.SentencePieceProcessor(model_proto=spec.SerializeToString())
        self._whole = sentencepiece.SentencePieceProcessor(model_proto=model)

    @classmethod
    def of(cls, model: bytes) -> Segmenter:
        """The worker's segmenter of a model, loaded once."""
        if cls._last[0] != model:
            cls._last = (model, cls(model))
        return cls._last[1]

    def encode(self, chunks: list[str]) -> list[list[int]]:
        return self._bare.encode(chunks, num_threads=1)

    def surfaces(self, chunks: list[list[int]]) -> list[str]:
        """The decoded chunks, each with the space of its first marker."""
        return [" " + text for text in self._whole.decode(chunks)]


def check_model(model: bytes) -> tuple[int, int]:
    """Id of the end piece and number of pieces; raises where chunks of the model could not be segmented on their own."""
    spec = proto.ModelProto()
    spec.ParseFromString(model)
    norm, pieces = spec.normalizer_spec, [p.piece for p in spec.pieces]
    fits = (
        spec.trainer_spec.model_type == spec.trainer_spec.BPE
        and not norm.precompiled_charsmap
        and norm.add_dummy_prefix
        and norm.escape_whitespaces
        and not norm.remove_extra_whitespaces
        and not spec.trainer_spec.treat_whitespace_as_suffix
        and MARK in pieces
        and not any(_CROSSING.search(p) for p in pieces)
    )
    if not fits:
        raise ValueError("not a BPE model with plain marked words: its pieces may cross word markers")
    return sentencepiece.SentencePieceProcessor(model_proto=model).eos_id(), len(pieces)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Chunks of all texts in order, markers as spaces, and the number of chunks of each text.

    An empty text has no chunk.  Chunks tile the texts, so they are slices of one buffer.
    """
    plain = pc.replace_substring(texts, MARK, " ")
    space, none = (pa.scalar(c, pa.large_string()) for c in (" ", ""))
    plain = pc.if_else(pc.equal(plain, none), none, pc.binary_join_element_wise(space, plain, none))
    raw, offsets = textcore.text_buffers(plain)
    first, raw = int(offsets[0]), raw[offsets[0] : offsets[-1]]
    offsets = offsets - first
    blank = raw == 32
    head = blank.copy()
    head[1:] &= ~blank[:-1]
    head[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(head)
    bounds = np.append(starts, len(raw))
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(raw))])
    return chunks, np.diff(np.searchsorted(starts, offsets))


# ---- packages ------------------------------------------------------------------------------
def squeeze(values: np.ndarray, press) -> bytes:
    """Numbers from 0 to 2^52: their bit lengths compressed, and the bits below the first as they are."""
    lengths = np.frexp(values)[1].astype(np.uint8)
    frame = press(lengths.tobytes())
    parts = [np.uint32(len(frame)).tobytes(), frame]
    for n in range(2, int(lengths.max(initial=0)) + 1):
        rest = values[lengths == n]
        if len(rest):
            parts.append(np.packbits((rest[:, None] >> np.arange(n - 1) & 1).astype(np.uint8)).tobytes())
    return b"".join(parts)


def unsqueeze(data: bytes, expand) -> np.ndarray:
    at = 4 + int(np.frombuffer(data, np.uint32, 1)[0])
    lengths = np.frombuffer(expand(data[4:at]), np.uint8)
    values = (lengths > 0).astype(np.int64)
    for n in range(2, int(lengths.max(initial=0)) + 1):
        here = np.flatnonzero(lengths == n)
        if len(here):
            size = len(here) * (n - 1)
            bits = np.unpackbits(np.frombuffer(data, np.uint8, (size + 7) // 8, at), count=size).reshape(-1, n - 1)
            values[here] = (1 << n - 1) + bits.astype(np.int64) @ (1 << np.arange(n - 1))
            at += (size + 7) // 8
    return values


class _Zip:
    """Compressed texts, numbers and ids of packages."""

    def __init__(self, id_type: str = "<u2"):
        self._fast, self._good = zstandard.ZstdCompressor(level=1).compress, zstandard.ZstdCompressor(level=3).compress
        self._expand, self._id_type = zstandard.ZstdDecompressor().decompress, id_type

    def numbers(self, values: np.ndarray) -> bytes:
        return squeeze(values, self._fast)

    def read_numbers(self, data: bytes) -> np.ndarray:
        return unsqueeze(data, self._expand)

    def chunks(self, texts: list[str]) -> bytes:
        """Chunks one after the other; one of spaces alone is a space and so many markers, so each begins after another character."""
        return self._good("".join(t if t.strip(" ") else " " + MARK * len(t) for t in texts).encode())

    def read_chunks(self, data: bytes) -> list[str]:
        found = _CHUNK.findall(self._expand(data).decode())
        return [" " * (len(t) - 1) if t[1] == MARK else t for t in found]

    def ids(self, values: np.ndarray) -> bytes:
        return self._good(values.astype(self._id_type).tobytes())

    def read_ids(self, data: bytes) -> np.ndarray:
        return np.frombuffer(self._expand(data), self._id_type).astype(np.int64)


def _steps(place: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sorted places of each chunk as distances; a chunk's first place follows the first place of the chunk before."""
    step = np.diff(place, prepend=0)
    step[begin] = np.diff(place[begin], prepend=0)
    return step


def _places(step: np.ndarray, hits: np.ndarray) -> np.ndarray:
    begin = np.cumsum(hits) - hits
    rest = step.copy()
    rest[begin] = 0
    total = np.cumsum(rest)
    return total - np.repeat(total[begin], hits) + np.repeat(np.cumsum(step[begin]), hits)


# ---- 1: blocks -----------------------------------------------------------------------------
def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += int(n)
    if start < len(sizes):
        yield start, len(sizes)


#: A block's own row has its ids, and the number of chunks of each text as ``sizes``; a package has the others.
_PACKAGE = "range int, block long, chunks binary, hits binary, places binary"


def _packages(block: int, ids: pa.Array, texts: pa.Array, ranges: int, spread: int, z: _Zip) -> Iterator[dict]:
    chunks, counts = cut(texts)
    yield {"range": block % ranges, "ids": ids.to_pylist(), "sizes": z.numbers(counts)}
    coded = chunks.dictionary_encode()  # in the order of first places
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    raw, offsets = textcore.text_buffers(coded.dictionary)
    hits = np.bincount(codes, minlength=len(offsets) - 1)
    home = textcore.hash_spans(raw, offsets)
    home = (home + np.where(hits * spread > len(codes), np.uint64(block), np.uint64(0))) % np.uint64(ranges)
    place = np.argsort(home[codes] * np.uint64(len(hits)) + codes.astype(np.uint64), kind="stable")
    order = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[order], np.arange(ranges + 1))
    names, hits = coded.dictionary.take(pa.array(order)), hits[order]
    until = np.concatenate([[0], np.cumsum(hits)])
    for r in np.flatnonzero(np.diff(edges)):
        a, b = edges[r], edges[r + 1]
        yield {
            "range": int(r), "chunks": z.chunks(names.slice(a, b - a).to_pylist()), "hits": z.numbers(hits[a:b]),
            "places": z.numbers(_steps(place[until[a] : until[b]], until[a:b] - until[a]))}


def _cutter(ranges: int, most: int, spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, z = TaskContext.get().partitionId() << 32, _Zip()
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            schema = pa.schema([
                ("range", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("chunks", "hits", "places", "sizes")),
                ("ids", pa.list_(ids.type))])
            for a, b in _blocks(pc.binary_length(texts).to_numpy(), most):
                rows = _packages(block, ids.slice(a, b - a), texts.slice(a, b - a), ranges, spread, z)
                yield pa.RecordBatch.from_pylist([{"block": block, **row} for row in rows], schema=schema)
                block += 1

    return run


# ---- 2: the table of distinct chunks -------------------------------------------------------
def _segmenter(model: bytes, id_type: str, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, z, table, held = Segmenter.of(model), _Zip(id_type), {}, 0
        for batch in batches:
            counts, ids = [], []
            for chunks in batch.column("chunks").to_pylist():
                if chunks is None:
                    counts.append(None)
                    ids.append(None)
                    continue
                names = z.read_chunks(chunks)
                new = [c for c in names if c not in table]
                for a in range(0, len(new), SEGMENT_ROWS):
                    part = new[a : a + SEGMENT_ROWS]
                    table.update(zip(part, (np.array(i, dtype=np.int32) for i in pieces.encode(part))))
                held += sum(map(len, new)) + 200 * len(new)
                found = [table[c] for c in names]
                counts.append(z.numbers(np.fromiter(map(len, found), dtype=np.int64, count=len(found))))
                ids.append(z.ids(np.concatenate(found)))
                if held > most:
                    table, held = {}, 0
            columns = {c: batch.column(c) for c in ("block", "hits", "places", "sizes", "ids")}
            yield pa.RecordBatch.from_pydict({**columns, "widths": pa.array(counts, pa.binary()), "pieces": pa.array(ids, pa.binary())})

    return run


# ---- 3: ids and decoded chunks by place ----------------------------------------------------
def _assembler(model: bytes, id_type: str, end: int):
    def run(table: pa.Table) -> pa.Table:
        z, pieces = _Zip(id_type), Segmenter.of(model)
        own = table.filter(pc.is_valid(table.column("sizes")))
        ids, sizes = own.column("ids").combine_chunks().flatten(), z.read_numbers(own.column("sizes")[0].as_py())
        at = np.concatenate([[0], np.cumsum(sizes)])
        code, pool, width, kinds = np.zeros(int(at[-1]), dtype=np.int64), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        rows = table.filter(pc.is_valid(table.column("pieces"))).select(["hits", "places", "widths", "pieces"])
        for row in rows.to_pylist():
            hits = z.read_numbers(row["hits"])
            code[_places(z.read_numbers(row["places"]), hits)] = np.repeat(np.arange(kinds, kinds + len(hits)), hits)
            kinds += len(hits)
            width.append(z.read_numbers(row["widths"]))
            pool.append(z.read_ids(row["pieces"]))
        width, pool = np.concatenate(width), np.concatenate(pool)
        begin = np.concatenate([[0], np.cumsum(width)])
        length = width[code]
        until = np.concatenate([[0], np.cumsum(length)])
        bounds = until[at] + np.arange(len(at))  # every text gets an end id
        out = np.full(int(bounds[-1]), end, dtype=np.int32)
        flat = pool[np.repeat(begin[code] - until[:-1], length) + np.arange(until[-1])]
        out[np.arange(until[-1]) + np.repeat(np.arange(len(sizes)), np.diff(until[at]))] = flat
        listed = pool.tolist()
        spoken = np.array(pieces.surfaces([listed[a:b] for a, b in zip(begin[:-1], begin[1:])]) or [""], dtype=object)[code]
        decoded = ["".join(spoken[a:b].tolist())[1:] for a, b in zip(at[:-1], at[1:])]
        return pa.table({
            "id": ids,
            "ids": pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(out)).cast(pa.list_(pa.int32())),
            "decoded": pa.array(decoded, pa.string())})

    return run


def encode(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, ids array<int>, decoded string) for every row, as the library encodes and decodes its text.

    ``model`` is the content of a model file (its size is bounded by its
    vocabulary).  ``ids`` end with the end id and nothing is sampled.  A null
    text counts as empty: its only id is the end id, decoded to the empty text.
    Null and repeated ids keep their rows; an empty table gives an empty result;
    other columns are left out, whatever their names.
    """
    end, size = check_model(model)
    id_type = "<u2" if size <= 1 << 16 else "<u4"
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = given.schema["id"].dataType
    packages = given.mapInArrow(_cutter(ranges, BLOCK_BYTES, SPREAD), f"{_PACKAGE}, sizes binary, ids array<{kind.simpleString()}>")
    segmented = packages.repartitionById(ranges, "range").mapInArrow(
        _segmenter(model, id_type, TABLE_BYTES), f"block long, hits binary, places binary, sizes binary, ids array<{kind.simpleString()}>, widths binary, pieces binary")
    schema = T.StructType([
        T.StructField("id", kind), T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])
    out = segmented.groupBy("block").applyInArrow(_assembler(model, id_type, end), schema)
    return out.select(F.col("id").alias(id_col), "ids", "decoded")
