"""Language identification by cross-parsing.

For every language a suffix automaton of labelled text accepts exactly the substrings of that text.
Walking a document through it until it fails yields the longest match from that place, which is one
phrase; the next phrase begins there.  The fewer phrases a language needs, normalised by the length of
its labelled text (phrases * log2(size) / symbols, the cross-parsing entropy), the closer it is.

The automata are dense transition tables in which a failing step already leads on to the first state
of the next phrase, with the count of phrases it ends.  Documents are cut into segments of `SEGMENT` symbols
(a phrase ends at a cut), and all segments of a slice take a step at once, in all languages.

Every language has symbols for its own letters, at most `MAX_LETTERS`; further ones of its text are one symbol,
and letters it lacks another, which ends a phrase.  Where the tables of all languages would pass `MAX_CELLS`,
all are learned from fewer windows.

Labels are read from at most `WINDOWS` windows of `WINDOW_CHARS` characters per language, taken at
hashed places of hashed texts; this bound only sizes the models.  Every text is parsed whole.

Null texts and texts without a letter get `und` and score 0.  Equal entropies are settled by the
order of the language names.  Without any labelled text everything is `und`.  Repeated rows are
predicted alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .frames import TEACHING, arrow_stage
from .words import slices

WINDOWS, WINDOW_CHARS = 64, 256
SEGMENT = 1024
MAX_LETTERS = 254  # of one language
MAX_CELLS = 1 << 27  # of all tables, half a GB
EVIDENCE = 64  # symbols that count for the score; more would only push it to 1
_PHRASE = 29  # bits above hold the phrases that a step ends
_SPACE, _FOREIGN, _RARE = 0, 1, 2


class Models(NamedTuple):
    names: list[str]
    letters: str  # of all languages; symbols from 2 on
    local: np.ndarray  # [language, symbol] -> symbol in the table of the language
    table: np.ndarray  # [state + local symbol] -> next state, with the flag; a state is the cell where its row begins
    roots: np.ndarray
    bits: np.ndarray  # log2 of the labelled text's size, by language


def labelled_windows(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> dict[str, list[str]]:
    """Windows of labelled text by language, from rows that may teach; equal texts count once, blank ones not at all.

    At most `WINDOWS` rows of a language reach the driver, however often ids or texts repeat.
    """
    rows = docs.where(F.expr(TEACHING.format(id=f"`{key}`")) & F.col(f"`{lang}`").isNotNull())
    rows = rows.where(F.col(f"`{text}`").rlike(r"\S"))
    rows = rows.select(F.col(f"`{lang}`").alias("lang"), F.xxhash64(F.col(f"`{text}`"), F.lit(WINDOWS)).alias("h"), F.col(f"`{text}`").alias("t"))
    # narrow rows choose first, so no text is sorted; Spark limits each language before its shuffle
    first = rows.select("lang", "h").withColumn("n", F.dense_rank().over(Window.partitionBy("lang").orderBy("h")))
    cuts = first.where(F.col("n") <= WINDOWS).groupBy("lang").agg(F.max("h").alias("cut"))
    # one row per language, as many as there are models to send anyway
    chosen = rows.join(F.broadcast(cuts), "lang").where(F.col("h") <= F.col("cut"))
    room = F.greatest(F.length("t") - WINDOW_CHARS, F.lit(0)) + 1
    at = (F.pmod(F.xxhash64("t"), room) + 1).cast("int")
    found: dict[str, list[tuple[int, str]]] = {}
    parts = chosen.select("lang", "h", F.substr("t", at, F.lit(WINDOW_CHARS)).alias("w")).groupBy("lang", "h").agg(F.min("w").alias("w"))
    for r in parts.collect():
        if r["w"]:
            found.setdefault(r["lang"], []).append((r["h"], r["w"]))
    return {k: [w for _, w in sorted(v)[:WINDOWS]] for k, v in sorted(found.items())}


def automaton(symbols: list[int], size: int) -> np.ndarray:
    """Transitions of the suffix automaton, one row per state, -1 where there is none."""
    links, lengths, arrows = [-1], [0], [{}]
    last = 0
    for c in symbols:
        new = len(links)
        links.append(0)
        lengths.append(lengths[last] + 1)
        arrows.append({})
        p = last
        while p >= 0 and c not in arrows[p]:
            arrows[p][c] = new
            p = links[p]
        if p >= 0:
            q = arrows[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                twin = len(links)
                links.append(links[q])
                lengths.append(lengths[p] + 1)
                arrows.append(dict(arrows[q]))
                while p >= 0 and arrows[p].get(c) == q:
                    arrows[p][c] = twin
                    p = links[p]
                links[q] = links[new] = twin
        last = new
    table = np.full((len(links), size), -1, np.int64)
    for state, out in enumerate(arrows):
        table[state, list(out)] = list(out.values())
    return table


def alphabet(text: str) -> list[str]:
    """The commonest letters first."""
    counts = Counter(c for c in text if c.isalpha())
    return [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]


def joined(windows: dict[str, list[str]]) -> dict[str, str]:
    """Text to learn by language, from as many windows as `MAX_CELLS` has room for."""
    count = max(map(len, windows.values()), default=0)
    while True:
        texts = {name: " ".join(parts[:count]).lower() for name, parts in windows.items()}
        # an automaton has at most two states a symbol
        cells = sum(2 * len(t) * (min(len(set(t)), MAX_LETTERS) + 3) for t in texts.values())
        if cells <= MAX_CELLS:
            return texts
        if count == 1:
            raise ValueError(f"{len(texts)} languages need {cells} cells, more than {MAX_CELLS}")
        count //= 2


def train(windows: dict[str, list[str]]) -> Models:
    texts = joined(windows)
    own = {name: alphabet(t) for name, t in texts.items()}
    letters = "".join(sorted({c for found in own.values() for c in found}))
    place = {c: i + 2 for i, c in enumerate(letters)}
    codes = symbol_table(letters)
    local = np.full((len(texts), len(letters) + 2), _FOREIGN, np.int32)
    local[:, _SPACE] = _SPACE
    tables, roots, bits, base = [], [], [], 0
    for i, (name, t) in enumerate(texts.items()):
        for k, c in enumerate(own[name]):
            local[i, place[c]] = k + 3 if k < MAX_LETTERS else _RARE
        size = min(len(own[name]), MAX_LETTERS) + 3
        symbols = local[i, to_symbols(np.frombuffer(t.encode("utf-32-le"), np.uint32), codes)]
        arrows = automaton(symbols.tolist(), size)
        root = arrows[0]
        # a failing step ends a phrase and begins the next with its symbol; one that the language lacks
        # is a phrase of its own
        ended = np.where(root >= 0, 1, 2) - (np.arange(len(arrows)) == 0)[:, None]
        step = np.where(arrows >= 0, arrows, np.maximum(root, 0)) * size + base
        tables.append((step + np.where(arrows >= 0, 0, ended << _PHRASE)).astype(np.int32).ravel())
        roots.append(base)
        bits.append(np.log2(max(len(symbols), 2)))
        base += arrows.size
    table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
    return Models(list(texts), letters, local, table, np.array(roots, np.int32), np.array(bits))


def symbol_table(letters: str) -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1 for letters outside the models."""
    codes = np.array([_FOREIGN if chr(c).isalpha() else _SPACE for c in range(0x110000)], np.int32)
    for i, c in enumerate(letters):
        codes[ord(c)] = i + 2
        if len(c.upper()) == 1 and c.upper().lower() == c:
            codes[ord(c.upper())] = i + 2
    return codes


def to_symbols(points: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Symbols of a text; everything between two runs of letters is one space."""
    s = codes[points]
    keep = s != _SPACE
    keep[1:] |= s[:-1] != _SPACE
    return s[keep]


def parse(parts: list[np.ndarray], models: Models) -> np.ndarray:
    """Phrases that each text needs, by language: [texts, languages]."""
    sizes = [len(p) for p in parts]
    owner, begin, length = [], [], []
    for i, n in enumerate(sizes):
        for at in range(0, n, SEGMENT):
            owner.append(i)
            begin.append(at)
            length.append(min(SEGMENT, n - at))
    counts = np.zeros((len(parts), len(models.names)), np.int64)
    if not owner or not models.names:
        return counts
    order = np.argsort(-np.array(length), kind="stable")
    lanes = np.zeros((max(length), len(order)), np.int32)
    for lane, k in enumerate(order):
        lanes[: length[k], lane] = parts[owner[k]][begin[k] : begin[k] + length[k]]
    ordered = np.array(length)[order]
    active = np.searchsorted(-ordered, -np.arange(len(lanes)), "left")  # lanes longer than the step
    state = np.repeat(models.roots[:, None], len(order), 1)
    phrases = np.zeros(state.shape, np.int32)
    for i, a in enumerate(active):
        step = models.table.take(state[:, :a] + models.local.take(lanes[i, :a], 1))
        phrases[:, :a] += step >> _PHRASE
        state[:, :a] = step & ((1 << _PHRASE) - 1)
    phrases += state != models.roots[:, None]  # the end of a segment ends its last phrase
    np.add.at(counts, np.array(owner)[order], phrases.T)
    return counts


def identify(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Predicted language of every text with a score between 0 and 1, and its entropy in bits."""
    shared = docs.sparkSession.sparkContext.broadcast(models)  # at most MAX_CELLS
    cache: dict[str, np.ndarray] = {}

    def predict(batch: pa.RecordBatch) -> Iterator[dict]:
        m: Models = shared.value
        if "codes" not in cache:
            cache["codes"] = symbol_table(m.letters)
        codes = cache["codes"]
        keys, texts = batch.columns
        names = np.array([*m.names, "und"], object)
        for lo, hi, t in slices(texts):
            raw, bounds = t.data.tobytes(), t.bounds.tolist()
            parts = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                points = np.frombuffer(raw[a:b].decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
                parts.append(to_symbols(points, codes))
            phrases = parse(parts, m)
            n = np.array([len(p) for p in parts])
            known = np.array([bool((p != _SPACE).any()) for p in parts]) & bool(m.names)
            best = np.full(len(n), len(m.names))
            score, bits = np.zeros(len(n)), np.zeros(len(n))
            if known.any():
                h = phrases[known] * m.bits[None, :] / n[known, None]
                best[known] = h.argmin(1)
                bits[known] = h.min(1)
                evidence = np.minimum(n[known], EVIDENCE)[:, None]
                score[known] = 1 / np.exp2(np.maximum((h.min(1, keepdims=True) - h) * evidence, -60)).sum(1)
            yield {"doc_id": keys.slice(lo, hi - lo), "lang_pred": names[best], "score": score, "bits": bits}

    columns = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))
    return arrow_stage(columns, "doc_id long, lang_pred string, score double, bits double", predict)
