"""Best-fit packing of token sequences by exact-complement hashing.

Documents become token ids and one end id; only documents longer than a sequence are cut, into whole
sequences and a rest.  The packing is planned on the histogram of piece lengths, which has at most
`CAPACITY` entries whatever the input's size: take the longest length left, and fill its gap exactly
with one length, a sum of two or a sum of three that are available, as often as their counts allow;
where no exact sum exists, put in the longest length that fits and go on with the smaller gap.  Each
step uses up a length (or all of its partners), so the plan is a short list of patterns with numbers of
repeats, and it says for each length which of its pieces go where: piece number r of length n (by
document and piece) belongs to an interval of the plan, hence to a sequence and an offset.

Numbers within a length come from `dense_ids` (range partitions and their counts), so a length that
most documents share is no single task.  Tokenizing remembers words: the tokenizer drops white space
and never joins across it, so a text's ids are those of its words.  A slice of texts looks up each distinct
word once and takes the ids of all its words from there by position.  About `REMEMBERED` words are remembered per worker.

Where token ids are asked for, they are written once (`squeeze`), with a number for each piece; only narrow
rows are planned and numbered, and the ids meet their places in one join at the end.

Null texts are empty; an empty text is the end id alone.  Repeated rows are packed each.  An empty table
gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.keys import dense_ids
from ..session import materialize
from . import words as W
from .frames import arrow_stage

CAPACITY = 4096
END_ID = 1
REMEMBERED = 300_000
SLICE = 1 << 20  # bytes of text whose distinct words are looked up together
UNPACKED = 256  # pieces whose ids are unpacked at once
_LETTER, _MARK = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True
_MARK[list(b".,;:!?")] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


class WordIds:
    """Token ids of words as little-endian 32-bit bytes, looked up or encoded for many words at once."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.known: dict[bytes, bytes] = {}
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, units: list[bytes], plain: np.ndarray) -> list[bytes]:
        """Ids of distinct units; the first `REMEMBERED` units stay known."""
        known = self.known
        found = [known.get(u) for u in units]
        new = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(new, self.encoded([units[i] for i in new], plain[new]), strict=True):
            found[i] = x
            if len(known) < REMEMBERED:
                known[units[i]] = x
        return found

    def encoded(self, units: list[bytes], plain: np.ndarray) -> list[bytes]:
        """Plain units are single pieces to the tokenizer and go through it in one text, others one by one."""
        one, others = np.flatnonzero(plain).tolist(), np.flatnonzero(~plain).tolist()
        found = [b""] * len(units)
        ids = self._batch([b" ".join([units[i] for i in one])])[0]
        # each piece ends with a token that ends words
        cut = np.append(0, np.flatnonzero(self.ends[ids]) + 1)
        if len(cut) == len(one) + 1 and cut[-1] == len(ids):
            raw, cut = ids.tobytes(), (4 * cut).tolist()
            for i, a, b in zip(one, cut[:-1], cut[1:], strict=True):
                found[i] = raw[a:b]
        else:
            others = list(range(len(units)))
        for i, x in zip(others, self._batch([units[i] for i in others]), strict=True):
            found[i] = x.tobytes()
        return found

    def _batch(self, texts: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)
        return [np.array(f.ids, "<u4") for f in found]


class Units(NamedTuple):
    """Folded bytes and ranges of what is looked up; those of text i are first[i]:first[i + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    plain: np.ndarray


def units(texts: W.Texts) -> Units:
    """Words, a mark behind letters apart; plain ones are letters (a to z, and those of Latin-1) or a mark.

    The tokenizer lower-cases, so A to Z are folded first, unless the texts may hold its special tokens.
    """
    found, data = W.words(texts), texts.data
    if b"<|" not in data.tobytes():
        data = _FOLD[data]
    after = np.append(data[1:], np.uint8(0))
    wide = (data == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    letter = _LETTER[data] | wide
    letter[1:] |= wide[:-1]
    other = W.running(~letter)
    start, end = found.start, found.end
    cut = _MARK[data[end - 1]] & (end - start > 1) & (other[end - 1] == other[start])
    shift = W.running(cut)
    at = np.arange(len(start)) + shift[:-1]
    begin, stop = np.empty((2, len(start) + int(shift[-1])), np.int64)
    begin[at], stop[at] = start, end - cut
    marks = at[cut] + 1
    begin[marks], stop[marks] = end[cut] - 1, end[cut]
    plain = other[begin] == other[stop]
    plain[marks] = True
    return Units(data, begin, stop, found.first + shift[found.first], plain)


_loaded: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of a file, loaded once per worker."""
    if path not in _loaded:
        from tokenizers import Tokenizer

        _loaded[path] = WordIds(Tokenizer.from_file(path))
    return _loaded[path]


def squeeze(ids: bytes) -> bytes:
    """Little-endian 32-bit ids, all first bytes first, then all second ones and so on, compressed."""
    return pa.Codec("zstd").compress(np.frombuffer(ids, np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)


def unsqueeze(data: bytes, length: int) -> np.ndarray:
    raw = pa.Codec("zstd").decompress(data, 4 * length, asbytes=True)
    return np.frombuffer(raw, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel()


def pieces(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", keep_ids: bool = False,
           capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents: `doc_id, piece, start, length, ids_crc32`, and on request the squeezed `ids`
    (`pack` gives them as an array)."""
    end = np.array([end_id], "<u4").tobytes()

    def tokenize(batch: pa.RecordBatch) -> Iterator[dict]:
        known = word_ids(tokenizer)
        keys, column = batch.columns
        for lo, hi, t in W.slices(column, SLICE):
            # bytes are split at ASCII white space only: the tokenizer itself sees the rest
            found = units(t)
            kinds = W.distinct(found.data, found.start, found.end)
            raw, at = found.data.tobytes(), kinds.place
            cuts = zip(found.start[at].tolist(), found.end[at].tolist(), strict=True)
            parts = known.ids([raw[a:b] for a, b in cuts], found.plain[at])
            size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
            begin = W.running(size)[:-1][kinds.kind]
            every, bounds = W.take_ranges(np.frombuffer(b"".join(parts), "<u4"), begin, size[kinds.kind])
            cut = bounds[found.first].tolist()
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(hi - lo):
                whole = every[cut[i] : cut[i + 1]].tobytes() + end
                for n, at in enumerate(range(0, len(whole), 4 * capacity)):
                    part = whole[at : at + 4 * capacity]
                    row.append(i)
                    piece.append(n)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if keep_ids:
                        ids.append(squeeze(part))
            out = {"doc_id": keys.slice(lo, hi - lo).take(pa.array(row)), "piece": piece, "start": start, "length": length, "ids_crc32": crc}
            yield out | ({"ids": ids} if keep_ids else {})

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return arrow_stage(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), schema, tokenize)


def plan(counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths that share a sequence, with how many sequences follow each.

    `counts[n]` is the number of pieces of length n, up to the capacity.
    """
    left = counts.astype(np.int64).copy()
    capacity = len(left) - 1
    out: list[tuple[tuple[int, ...], int]] = []
    top = capacity
    while True:
        while top > 0 and left[top] == 0:
            top -= 1
        if top == 0:
            return out
        pattern = [top]
        left[top] -= 1  # one is in use while its partners are looked for
        while (gap := capacity - sum(pattern)) > 0:
            exact = complement(left, gap)
            if exact:
                for n in exact:
                    left[n] -= 1
                pattern += exact
                break
            fits = np.flatnonzero(left[1 : gap + 1])
            if not len(fits):
                break
            pattern.append(int(fits[-1]) + 1)
            left[pattern[-1]] -= 1
        lengths, uses = np.unique(pattern, return_counts=True)
        more = int((left[lengths] // uses).min())
        left[lengths] -= more * uses
        out.append((tuple(pattern), 1 + more))


def complement(left: np.ndarray, gap: int) -> list[int] | None:
    """One, two or three available lengths that add up to `gap`, the longest first."""
    if left[gap] > 0:
        return [gap]
    pair = _pair(left, gap, gap - 1)
    if pair:
        return pair
    for a in (np.flatnonzero(left[1:gap]) + 1)[::-1].tolist():
        if 3 * a < gap:
            return None
        left[a] -= 1
        rest = _pair(left, gap - a, min(a, gap - a - 1))
        left[a] += 1
        if rest:
            return [a, *rest]
    return None


def _pair(left: np.ndarray, total: int, longest: int) -> list[int] | None:
    if total < 2 or longest < 1:
        return None
    a = np.arange(min(longest, total - 1), (total - 1) // 2, -1)
    a = a[a >= total - a]
    b = total - a
    ok = np.where(a == b, left[a] > 1, (left[a] > 0) & (left[b] > 0))
    at = int(ok.argmax()) if len(ok) else 0
    return [int(a[at]), int(b[at])] if len(ok) and ok[at] else None


def places(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows (length, first number of that length, its sequence, offset), sorted.

    Piece number r of a length, with f the last first number not above r, lies in the sequence of f
    plus r - f; a pattern that uses a length twice gets a row per use.
    """
    rows, used, sequence = [], {}, 0
    for pattern, repeats in patterns:
        offset = 0
        for n in pattern:
            first = used.get(n, 0)
            rows.append((n, first, sequence, offset))
            used[n] = first + repeats
            offset += n
        sequence += repeats
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`parts` (with `doc_id, piece, start, length`, and perhaps `ids`) and the `sequence_id` and `offset` of each."""
    names = parts.columns
    carried = "ids" in names
    if carried:  # a number that the written rows keep
        parts = parts.withColumn("__row", F.monotonically_increasing_id())
    parts = materialize(parts, "pieces")
    histogram = parts.groupBy("length").count().collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, np.int64)
    for r in histogram:
        counts[r["length"]] = r["count"]
    where = places(plan(counts))
    before = np.concatenate([[0], np.cumsum(counts)])  # pieces of smaller lengths
    shared = parts.sparkSession.sparkContext.broadcast((where, before))  # a few rows per length
    order = ["length", "doc_id", "piece", "start"]
    if carried:
        numbered = dense_ids(parts.select(*order, "__row"), order, "number").select("number", "__row")
        numbered = parts.join(numbered, "__row").select("number", *[f"`{c}`" for c in names])
    else:
        numbered = dense_ids(parts, order, "number")

    def place(batch: pa.RecordBatch) -> Iterator[dict]:
        rows, first = shared.value
        columns = dict(zip(["number", *names], batch.columns, strict=True))
        length = columns["length"].to_numpy(zero_copy_only=False)
        number = columns["number"].to_numpy(zero_copy_only=False) - 1 - first[length]
        # one sortable value for (length, number): numbers stay below 2**48
        at = np.searchsorted((rows[:, 0] << 48) + rows[:, 1], (length << 48) + number, "right") - 1
        sequence, offset = rows[at, 2] + number - rows[at, 1], rows[at, 3]
        # ids grow when they are unpacked: a few rows at a time
        step = UNPACKED if carried else max(1, len(batch))
        for lo in range(0, len(batch), step):
            part = {c: columns[c].slice(lo, step) for c in names}
            if carried:
                found = [unsqueeze(x, n) for x, n in zip(part["ids"].to_pylist(), length[lo : lo + step].tolist(), strict=True)]
                cut = np.cumsum([0, *map(len, found)]).astype(np.int32)
                part["ids"] = pa.ListArray.from_arrays(pa.array(cut), pa.array(np.concatenate(found)))
            yield part | {"sequence_id": sequence[lo : lo + step], "offset": offset[lo : lo + step]}

    kinds = [(f.name, "array<int>" if carried and f.name == "ids" else f.dataType.simpleString()) for f in parts.schema.fields]
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in kinds if name in names)
    return arrow_stage(numbered, ddl + ", sequence_id long, offset long", place)
