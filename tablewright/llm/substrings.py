"""Removal of long repeated word sequences, by seed and extend.

A window is `LENGTH` consecutive words.  A window repeats if its word sequence also starts anywhere
else, in another document or the same; every word in a repeating window goes.

Seeds: of the runs of `SEED` words in a window the least hash is the window's anchor (the last one on a
tie), so the anchors of a text are its winnowed runs, equal windows have equal anchors, and the windows
of one anchor occurrence follow each other.  Together they cover a segment of the text.

Extension: occurrences of an anchor are brought together with the fingerprint of their segment.  Equal
segments match over their whole extent.  Where an anchor occurs in different segments, a match ends
inside one of them, and the exact places come from comparing the windows of those segments (one of each
kind).  So only the edges of repeats are compared window by window; maximal repeats are the unions.

No pairs are made.  A block of the scan sends one row per segment, whatever its number of occurrences
there, so passages, lines and copies that many documents share do not gather in one task; neighbours in
sorted order tell what repeats.  Fingerprints that decide have 128 bits.

Null and empty texts have no words.  Texts shorter than a window keep every word.  Rows are named by
128 bits of their id and text: an id may name several texts or be null, and repeated rows (same id and text) repeat
each other and lose all windows.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .frames import arrow_stage

LENGTH = 35
SEED = 8
BLOCK = 500_000  # rows of one block of a scan
_REACH = LENGTH - SEED + 1  # runs of SEED words in a window


def anchors(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the place of the anchor of each."""
    starts = W.window_starts(first, LENGTH)
    n = len(hashes)
    if not len(starts):
        return starts, starts
    at = np.arange(n - SEED + 1)
    runs = W.run_hash(W.run_sums(hashes), at, at + SEED)

    def lower(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(runs[b] <= runs[a], b, a)

    best, width = at, 1
    while 2 * width <= _REACH:  # least of 2, 4, 8, ... runs from each place
        best = lower(best[:-width], best[width:])
        width *= 2
    return starts, lower(best[starts], best[starts + _REACH - width])


def segments(t: W.Texts) -> tuple[W.Words, np.ndarray, dict[str, np.ndarray]]:
    """Words, their hashes, and the segments: text, first window (in words of the text), windows, anchor, s1, s2."""
    w = W.words(t)
    hashes = W.hash_ranges(t.data, w.start, w.end)
    starts, place = anchors(hashes, w.first)
    own = W.owners(w.first)[starts] if len(starts) else starts
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (place[1:] != place[:-1]) | (own[1:] != own[:-1])
    head = np.flatnonzero(fresh)
    count = np.diff(np.append(head, len(starts)))
    begin = starts[head]
    sums = W.run_sums(hashes), W.run_sums(hashes, 1)
    end = begin + count - 1 + LENGTH
    anchor = W.run_hash(sums[0], place[head], place[head] + SEED)
    return w, hashes, {
        "text": own[head], "at": begin - w.first[own[head]], "windows": count, "anchor": anchor,
        "s1": W.run_hash(sums[0], begin, end), "s2": W.run_hash(sums[1], begin, end),
    }


def _same(*columns: np.ndarray) -> np.ndarray:
    """Which sorted rows equal the row before."""
    out = np.zeros(len(columns[0]), bool)
    if len(out):
        out[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in columns])
    return out


def seeds(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per segment and block: `anchor, s1, s2, id, at, windows, many`; rows without an anchor
    are segments known to repeat already."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block: list[dict] = []
        size = 0
        for batch in batches:
            one, two, texts = batch.columns
            for lo, hi, t in W.slices(texts):
                _, _, s = segments(t)
                own = {k: v.to_numpy(zero_copy_only=False)[lo:hi][s["text"]] for k, v in (("id", one), ("id2", two))}
                block.append(s | own)
                size += len(s["at"])
                if size >= BLOCK:
                    yield flush(block)
                    block, size = [], 0
        if size:
            yield flush(block)

    def flush(block: list[dict]) -> dict:
        c = {k: np.concatenate([b[k] for b in block]) for k in ("anchor", "s1", "s2", "id", "id2", "at", "windows")}
        order = np.lexsort((c["at"], c["s2"], c["s1"], c["anchor"]))
        c = {k: v[order] for k, v in c.items()}
        again = _same(c["anchor"], c["s1"], c["s2"])
        many = again.copy()
        many[:-1] |= again[1:]
        # the first of equal segments goes on; all of several are settled
        anchor = pa.array(W.signed(c["anchor"]), mask=again)
        return {"anchor": anchor, "s1": W.signed(c["s1"]), "s2": W.signed(c["s2"]), "id": c["id"], "id2": c["id2"], "at": c["at"].astype(np.int32), "windows": c["windows"].astype(np.int32), "many": many}

    schema = "anchor long, s1 long, s2 long, id long, id2 long, at int, windows int, many boolean"
    return arrow_stage(_keyed(docs, key, text), schema, scan, whole=True)


def extended(rows: DataFrame) -> DataFrame:
    """Segments that repeat (`open` false) and segments whose windows must be compared (`open` true)."""
    spread = F.coalesce("anchor", F.xxhash64("id", "at"))
    rows = rows.withColumn("spread", spread).repartition("spread").sortWithinPartitions("anchor", "s1", "s2")
    names = ("anchor", "s1", "s2", "id", "id2", "at", "windows", "many")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None
        before = None  # anchor of the run before the held one
        for batch in batches:
            settled = batch.filter(batch.column("anchor").is_null())
            if len(settled):
                yield {k: settled.column(k) for k in ("id", "id2", "at", "windows")} | {"open": np.zeros(len(settled), bool)}
            batch = batch.filter(batch.column("anchor").is_valid())
            if not len(batch):
                continue
            c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if held is not None:
                c = {k: np.concatenate([held[k], c[k]]) for k in names}
            # the last run may go on in the next batch; it has a row per block of the scan at most
            last = np.flatnonzero(~_same(c["anchor"], c["s1"], c["s2"]))[-1]
            if last:
                yield judge({k: v[:last] for k, v in c.items()}, before, c["anchor"][last])
                before = c["anchor"][last - 1]
            held = {k: v[last:] for k, v in c.items()}
        if held is not None:
            yield judge(held, before, None)

    def judge(c: dict[str, np.ndarray], before, after) -> dict:
        again = _same(c["anchor"], c["s1"], c["s2"])
        head = np.flatnonzero(~again)
        size = np.diff(np.append(head, len(again)))
        anchor = c["anchor"][head]
        mixed = np.zeros(len(head), bool)  # the anchor has other segments too
        mixed[1:] = anchor[1:] == anchor[:-1]
        mixed[:-1] |= anchor[1:] == anchor[:-1]
        mixed[0] |= before is not None and before == anchor[0]
        mixed[-1] |= after is not None and after == anchor[-1]
        repeats = np.maximum.reduceat(c["many"], head) | (size > 1)
        done = np.repeat(repeats, size)
        pick = head[mixed]
        take = np.concatenate([np.flatnonzero(done), pick])
        opened = np.zeros(len(take), bool)
        opened[int(done.sum()) :] = True
        return {k: c[k][take] for k in ("id", "id2", "at", "windows")} | {"open": opened}

    return arrow_stage(rows, "id long, id2 long, at int, windows int, open boolean", scan, whole=True)


def windows_of(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """Fingerprints of the windows of the wanted segments, one row per window and block."""
    lists = wanted.groupBy("id", "id2").agg(F.collect_list(F.struct("at", "windows")).alias("spans"))  # of one text
    rows = _keyed(docs, key, text).join(lists, ["id", "id2"])
    rows = rows.select("id", "id2", "t", F.col("spans.at").alias("at"), F.col("spans.windows").alias("windows"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, size = [], 0
        for batch in batches:
            ids, twos = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, t in W.slices(batch.column(2)):
                w = W.words(t)
                hashes = W.hash_ranges(t.data, w.start, w.end)
                at, count = (batch.column(k).slice(lo, hi - lo) for k in (3, 4))
                own = np.repeat(np.arange(hi - lo), np.diff(at.offsets.to_numpy()))
                begin, n = at.flatten().to_numpy(), count.flatten().to_numpy()
                own = np.repeat(own, n)
                offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = np.repeat(begin, n) + offset
                real = w.first[own] + start
                block.append((W.run_hash(W.run_sums(hashes), real, real + LENGTH), W.run_hash(W.run_sums(hashes, 1), real, real + LENGTH), ids[lo:hi][own], twos[lo:hi][own], start))
                size += len(real)
                if size >= BLOCK:
                    yield flush(block)
                    block, size = [], 0
        if size:
            yield flush(block)

    def flush(block: list[tuple]) -> dict:
        w1, w2, ids, twos, start = (np.concatenate(x) for x in zip(*block, strict=True))
        order = np.lexsort((w2, w1))
        w1, w2, ids, twos, start = (x[order] for x in (w1, w2, ids, twos, start))
        again = _same(w1, w2)
        many = again.copy()
        many[:-1] |= again[1:]
        return {"w1": pa.array(W.signed(w1), mask=again), "w2": W.signed(w2), "id": ids, "id2": twos, "at": start.astype(np.int32), "many": many}

    return arrow_stage(rows, "w1 long, w2 long, id long, id2 long, at int, many boolean", scan, whole=True)


def repeating_windows(rows: DataFrame) -> DataFrame:
    """`id, id2, at, windows` of single windows that repeat."""
    rows = rows.withColumn("spread", F.coalesce("w1", F.xxhash64("id", "at"))).repartition("spread").sortWithinPartitions("w1", "w2")
    names = ("w1", "w2", "id", "id2", "at", "many")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None
        for batch in batches:
            settled = batch.filter(batch.column("w1").is_null())
            if len(settled):
                yield {k: settled.column(k) for k in ("id", "id2", "at")} | {"windows": np.ones(len(settled), np.int32)}
            batch = batch.filter(batch.column("w1").is_valid())
            if not len(batch):
                continue
            c = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            if held is not None:
                c = {k: np.concatenate([held[k], c[k]]) for k in names}
            last = np.flatnonzero(~_same(c["w1"], c["w2"]))[-1]
            if last:
                yield judge({k: v[:last] for k, v in c.items()})
            held = {k: v[last:] for k, v in c.items()}
        if held is not None:
            yield judge(held)

    def judge(c: dict[str, np.ndarray]) -> dict:
        again = _same(c["w1"], c["w2"])
        head = np.flatnonzero(~again)
        size = np.diff(np.append(head, len(again)))
        done = np.repeat(np.maximum.reduceat(c["many"], head) | (size > 1), size)
        return {k: c[k][done] for k in ("id", "id2", "at")} | {"windows": np.ones(int(done.sum()), np.int32)}

    return arrow_stage(rows, "id long, id2 long, at int, windows int", scan, whole=True)


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Rows named by 128 bits of their id and text, so that an id may name several texts, or be null."""
    one, two, whole = _names(key, text)
    return docs.select(one.alias("id"), two.alias("id2"), whole.alias("t"))


def _names(key: str, text: str) -> tuple[Column, Column, Column]:
    k, t = F.col(f"`{key}`"), F.col(f"`{text}`")
    parts = [k.isNull(), k, t.isNull(), t]
    return F.xxhash64(*parts), F.xxhash64(F.lit(SEED), *parts), t


def repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, id2, spans`: for every row name with repeating windows their ranges (`at`, `windows`)."""
    found = materialize(extended(seeds(docs, key, text)), "segments")
    single = materialize(repeating_windows(windows_of(docs, found.where("open"), key, text)), "windows")
    spans = found.where("not open").select("id", "id2", "at", "windows").unionByName(single)
    return spans.groupBy("id", "id2").agg(F.collect_list(F.struct("at", "windows")).alias("spans"))  # of one text


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, n_words, n_removed, kept` of every row; `kept` are the other words, joined by one space."""
    found = repeats(docs, key, text)
    one, two, whole = _names(key, text)
    rows = docs.select(F.col(f"`{key}`").alias("key"), one.alias("id"), two.alias("id2"), whole.alias("t")).join(found, ["id", "id2"], "left")
    rows = rows.select("key", "t", F.col("spans.at").alias("at"), F.col("spans.windows").alias("windows"))

    def strip(batch: pa.RecordBatch) -> Iterator[dict]:
        for lo, hi, t in W.slices(batch.column(1)):
            raw, bounds = t.data.tobytes(), t.bounds.tolist()
            at, count = (batch.column(k).slice(lo, hi - lo).to_pylist() for k in (2, 3))
            total, removed, kept = [], [], []
            for i in range(hi - lo):
                words = raw[bounds[i] : bounds[i + 1]].split()
                total.append(len(words))
                if at[i]:
                    change = np.zeros(len(words) + 1, np.int64)
                    begin = np.array(at[i])
                    np.add.at(change, begin, 1)
                    np.add.at(change, begin + np.array(count[i]) + LENGTH - 1, -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0)]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield {"id": batch.column(0).slice(lo, hi - lo), "n_words": total, "n_removed": removed, "kept": kept}

    return arrow_stage(rows, "id long, n_words long, n_removed long, kept string", strip)

