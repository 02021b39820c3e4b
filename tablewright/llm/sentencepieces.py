"""SentencePiece encoding and decoding over a table of distinct chunks.

The library writes a marker for every blank and one more in front of a text.  In a model none of whose
pieces has a marker behind another character, no merge crosses from a word to the next marker: a text's
ids are those of its chunks (markers and the word behind them), one after the other, and so is its decoded
text.  `splits_at_markers` checks that of a model; other models are refused.

The table: every slice of a scan sends its distinct chunks with their numbers of occurrences, Spark adds them
up, and the most frequent ones (at most `TABLE_CHUNKS`, chosen by their counts on a histogram of a few
hundred rows) are segmented once each, by the library, in Spark tasks.  That table has a bound, so it is
broadcast.  The second scan looks up the distinct chunks of each slice, segments those that the table lacks
once a slice (a chunk that occurs once or twice costs less to segment than to bring by a join) and puts the ids
back by position, for all texts of a slice at once.  The table decides work, never results.

Chunks are equal if two independent 64-bit hashes are; a slice in which only the first agrees segments such
chunks apart.  Null and empty texts have no ids and the empty decoded text.  The marker character in a text is a
blank to the library and here.  Texts of any length are encoded whole; a text without blanks is one chunk.
Repeated rows give repeated rows, an empty table an empty result; further columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ..session import materialize
from . import words as W
from .frames import arrow_stage

MARKER = "▁"
TABLE_CHUNKS = 300_000
LONGEST = 64  # bytes of a chunk that the table may hold
SLICE = 4 << 20
_loaded: dict[str, object] = {}


def processor(path: str):
    """The model of a file, loaded once per worker; an error if its pieces cross markers."""
    if path not in _loaded:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        if not splits_at_markers(model):
            raise ValueError(f"{path}: pieces cross from a word to a marker, or texts are rewritten")
        _loaded[path] = model
    return _loaded[path]


def splits_at_markers(model) -> bool:
    """No piece has a marker behind another character, and texts get exactly one marker in front."""
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    crossing = any(MARKER in p.lstrip(MARKER) for p in pieces)
    spaced = " a  b "
    kept = model.decode(model.encode(spaced)) == spaced
    return not crossing and kept and model.encode("a", out_type=str)[0].startswith(MARKER)


class Chunks(NamedTuple):
    """Byte ranges as the library takes them (without the marker that it adds); those of text i are
    first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def chunks(texts: W.Texts) -> Chunks:
    """Chunks begin with a text and at each blank behind another character."""
    blank = texts.data == 0x20
    cut = blank.copy()
    cut[1:] &= ~blank[:-1]
    opening = texts.bounds[:-1][np.diff(texts.bounds) > 0]
    cut[opening] = False
    begins = cut.copy()
    begins[opening] = True
    at = np.flatnonzero(begins)
    return Chunks(at + cut[at], np.append(at[1:], len(blank)), np.searchsorted(at, texts.bounds))


class Segments(NamedTuple):
    """Ids and decoded bytes (with their leading blank) of chunks, one behind the other."""

    ids: np.ndarray
    id_bounds: np.ndarray
    text: np.ndarray
    text_bounds: np.ndarray


def segment(model, raw: list[bytes]) -> tuple[list[list[int]], list[str]]:
    """Ids and decoded text of chunks; a chunk without bytes is the marker alone."""
    ids = model.encode(raw, num_threads=1) if raw else []
    marker = [model.piece_to_id(MARKER)]
    ids = [x or marker for x in ids]
    return ids, model.decode(ids, num_threads=1) if ids else []


def segments(ids: list, decoded: list[str]) -> Segments:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    flat = np.fromiter((i for x in ids for i in x), np.int32, int(lengths.sum()))
    raw = [b" " + d.encode() for d in decoded]
    text = np.frombuffer(b"".join(raw), np.uint8)
    return Segments(flat, W.running(lengths), text, W.running(np.fromiter(map(len, raw), np.int64, len(raw))))


class Table(NamedTuple):
    """Segments of chunks in the order of their first hash."""

    one: np.ndarray
    two: np.ndarray
    found: Segments


def counted(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct chunks of at most `LONGEST` bytes with their number of occurrences: `chunk binary, n`."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for _, _, t in W.slices(plain(batch.column(0)), SLICE):
            c = chunks(t)
            short = np.flatnonzero(c.end - c.start <= LONGEST)
            start, end = c.start[short], c.end[short]
            d = W.distinct(t.data, start, end)
            raw, bounds = W.take_ranges(t.data, start[d.place], (end - start)[d.place])
            chunk = pa.Array.from_buffers(
                pa.binary(), len(d.place), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(raw)]
            )
            yield {"chunk": chunk, "n": np.bincount(d.kind, minlength=len(d.place))}

    rows = arrow_stage(docs.select(F.col(f"`{text}`").cast("string").alias("t")), "chunk binary, n long", count)
    return rows.groupBy("chunk").agg(F.sum("n").alias("n"))


def plain(column: pa.Array) -> pa.Array:
    """Markers in a text are blanks."""
    return pc.replace_substring(column, MARKER, " ")


def frequent(counts: DataFrame, most: int | None = None) -> DataFrame:
    """The chunks that occur most often: whole levels of counts, as many as `most` chunks allow."""
    level = F.floor(4 * F.log2("n"))
    levels = counts.groupBy(level.alias("level")).count().collect()  # four per power of two
    left, least = TABLE_CHUNKS if most is None else most, None
    for row in sorted(levels, key=lambda r: -r["level"]):
        left -= row["count"]
        if left < 0:
            break
        least = row["level"]
    return counts.where(F.lit(False) if least is None else level >= least)


def chunk_table(docs: DataFrame, model: str, text: str = "text") -> Table:
    """The frequent chunks, each segmented once; at most `TABLE_CHUNKS`."""

    def encode(batch: pa.RecordBatch) -> Iterator[dict]:
        chunk = batch.column(0)
        ids, decoded = segment(processor(model), chunk.to_pylist())
        yield {"chunk": chunk, "ids": ids, "decoded": decoded}

    # a chunk that occurs once needs no table
    counts = materialize(counted(docs, text).where("n > 1"), "chunks")
    rows = arrow_stage(frequent(counts).select("chunk"), "chunk binary, ids array<int>, decoded string", encode).toArrow()
    raw = rows["chunk"].to_pylist()
    bounds = W.running(np.fromiter(map(len, raw), np.int64, len(raw)))
    one, two = W.two_hashes(np.frombuffer(b"".join(raw), np.uint8), bounds[:-1], bounds[1:])
    order = np.argsort(one)
    ids, decoded = rows["ids"].to_pylist(), rows["decoded"].to_pylist()
    return Table(one[order], two[order], segments([ids[i] for i in order], [decoded[i] for i in order]))


def chosen(s: Segments, at: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Ids and decoded bytes of some segments, with their bounds."""
    ids = W.take_ranges(s.ids, s.id_bounds[at], np.diff(s.id_bounds)[at])
    return ids, W.take_ranges(s.text, s.text_bounds[at], np.diff(s.text_bounds)[at])


def looked_up(model, table: Table, data: np.ndarray, c: Chunks, d: W.Distinct) -> Segments:
    """Segments of the kinds of a slice: from the table where it has them, else from the library."""
    at = np.searchsorted(table.one, d.one)
    at[at == len(table.one)] = 0
    known = np.zeros(len(d.one), bool) if not len(table.one) else (table.one[at] == d.one) & (table.two[at] == d.two)
    new = np.flatnonzero(~known)
    raw = data.tobytes()
    places = d.place[new]
    fresh = segments(*segment(model, [raw[a:b] for a, b in zip(c.start[places].tolist(), c.end[places].tolist(), strict=True)]))
    (ids, id_bounds), (text, text_bounds) = chosen(table.found, at[known])
    both = Segments(
        np.concatenate([ids, fresh.ids]), np.concatenate([id_bounds, fresh.id_bounds[1:] + id_bounds[-1]]),
        np.concatenate([text, fresh.text]), np.concatenate([text_bounds, fresh.text_bounds[1:] + text_bounds[-1]]),
    )
    order = np.empty(len(known), np.int64)
    order[known] = np.arange(known.sum())
    order[new] = known.sum() + np.arange(len(new))
    (ids, id_bounds), (text, text_bounds) = chosen(both, order)
    return Segments(ids, id_bounds, text, text_bounds)


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Whole texts as the library encodes them, and as it decodes those ids: `<key>, ids, decoded`."""
    processor(model)
    shared = docs.sparkSession.sparkContext.broadcast(chunk_table(docs, model, text))

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        sp, table = processor(model), shared.value
        keys, column = batch.columns
        for lo, hi, t in W.slices(plain(column), SLICE):
            c = chunks(t)
            d = W.distinct(t.data, c.start, c.end)
            s = looked_up(sp, table, t.data, c, d)
            (ids, id_bounds), (out, out_bounds) = chosen(s, d.kind)
            ids_of = pa.ListArray.from_arrays(pa.array(id_bounds[c.first].astype(np.int32)), pa.array(ids))
            # the first chunk of a text loses its leading blank
            filled = c.first[:-1] < c.first[1:]
            out_keep = np.ones(len(out), bool)
            out_keep[out_bounds[c.first[:-1][filled]]] = False
            bounds = W.running(out_keep)[out_bounds[c.first]]
            decoded = pa.Array.from_buffers(
                pa.large_string(), hi - lo, [None, pa.py_buffer(bounds), pa.py_buffer(out[out_keep])]
            )
            yield {key: keys.slice(lo, hi - lo), "ids": ids_of, "decoded": decoded}

    rows = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`").cast("string").alias("__text"))
    schema = StructType(
        [
            StructField(key, docs.schema[key].dataType),
            StructField("ids", ArrayType(IntegerType())),
            StructField("decoded", StringType()),
        ]
    )
    return arrow_stage(rows, schema, run)
