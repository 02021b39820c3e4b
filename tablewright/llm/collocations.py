"""Phrases whose words occur together more often than apart, per language.

Texts are cut into pieces at marks and line ends, pieces into words.  A candidate is a phrase of two to four
words with at least `LEAST` occurrences.  Each of its cuts in two parts gives a score,
floor(SCALE * a / (l + r)) from the occurrences of the whole and of both parts; the lowest counts.  Candidates that
occur mostly inside a longer one are dropped, and each language reports its best `TOP`.

The method: counts live in weighted acyclic automata.  A word is a 64-bit label (of its language and its
bytes); a path spells a phrase, and the weight of its last arc is the phrase's number of occurrences.

* Shards: each block of a scan numbers its labels in order, sorts its phrases and builds its automaton from them
  level by level: the arcs of one level, sorted by state and label, are the states of the next.  States
  without arcs need no room.
* Union: the first arc reads two words, and its label range (`part`, a hash of both) says where its subtree goes, so
  a very common first word is spread over all parts.  A part adds up the automata of all shards by building
  one from all their arcs; whenever enough of them have come they are condensed, so memory follows the distinct phrases of a
  part.  Arcs below `LEAST` fall with all that hangs on them.
* Parts of phrases: the weight of a first part stands on the phrase's own path.  The remaining parts of all
  candidates are sorted by part and composed with its automaton: state by state, the arcs with the same label.
  Single words are counted by a table of words.

Every part of a frequent phrase is frequent, so the scan for longer phrases skips pairs that hold a rare word, and
then rare pairs.  These two lists are broadcast only up to `FILTERED` entries; without them the same counts
come out with more work.  Labels name words: a label of two words (checked over all words of the table) makes
the run start anew with other labels.  Sums are whole numbers; the score is decimal arithmetic.

Null texts are empty, a null language is `und`.  Repeated rows count each.  Ids are not used, so they may repeat or be
null.  Further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import attach, fits_broadcast
from ..session import materialize
from . import words as W
from .frames import arrow_stage

LEAST, SCALE, TOP, LONGEST = 30, 2_000_000, 2000, 4
INSIDE = (100, 80)  # dropped if 100 * f(longer) >= 80 * a
SLICE = 1 << 19
BLOCK = 400_000  # words of one shard
CONDENSE = 500_000  # arcs of one part that wait for their union
FILTERED = 1 << 22
PART_WORDS = 1 << 21  # words of the corpus for one part of the automata
# rows hold whole subtrees, so batches on their way to Python are bounded by bytes; a batch never cuts a row
BATCHED = {"spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}
UNKNOWN = "und"

_MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
_MARK = np.zeros(256, bool)
_MARK[list(_MARKS)] = True
_IN_WORD = ~_MARK
_IN_WORD[[0x20, 0x09]] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def language_seed(lang: str, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, salt=bytes([salt])).digest(), "little")


class Tokens(NamedTuple):
    """Labels of consecutive words, whether a word and the next one stand in one piece, and their bytes."""

    label: np.ndarray
    linked: np.ndarray
    data: np.ndarray
    found: W.Words


def tokens(texts: W.Texts, seeds: np.ndarray, table: np.ndarray) -> Tokens:
    data = _FOLD[texts.data]
    found = W.words(texts, _IN_WORD)
    per_text = np.diff(found.first)
    label = W.mix(W.range_hash(W.byte_sums(data, table=table), found.start, found.end) ^ np.repeat(seeds, per_text))
    marks = np.cumsum(_MARK[texts.data], dtype=np.int32)
    linked = np.zeros(len(label), bool)
    linked[:-1] = marks[found.start[1:]] == marks[found.start[:-1]]
    last = found.first[1:][per_text > 0] - 1
    linked[last] = False
    return Tokens(label, linked, data, found)


def scan(batch: pa.RecordBatch, salt: int, size: int | None = None) -> Iterator[tuple[Tokens, list[str], np.ndarray]]:
    """Tokens of slices of (lang, text) rows, the languages of the batch, and the language of each text."""
    table = W.byte_table(salt)
    coded = batch.column(0).dictionary_encode()
    langs = coded.dictionary.to_pylist()
    lang_seeds = np.array([language_seed(x, salt) for x in langs], np.uint64)
    code = coded.indices.to_numpy(zero_copy_only=False)
    for lo, hi, t in W.slices(batch.column(1), size or SLICE):
        yield tokens(t, lang_seeds[code[lo:hi]], table), langs, code[lo:hi]


def word_counts(rows: DataFrame, salt: int) -> DataFrame:
    """`label, lang, word, n`; a language's own row has no word and counts all its words."""

    def count(batch: pa.RecordBatch) -> Iterator[dict]:
        for t, langs, code in scan(batch, salt, 4 * SLICE):
            per_text = np.diff(t.found.first)
            of_word = np.repeat(code, per_text)
            label, place, n = np.unique(t.label, return_index=True, return_counts=True)
            start, end = t.found.start[place], t.found.end[place]
            raw, bounds = W.take_ranges(t.data, start, end - start)
            word = pa.Array.from_buffers(pa.large_string(), len(label), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
            names = pa.array(langs, pa.string())
            yield {"label": W.signed(label), "lang": names.take(pa.array(of_word[place])), "word": word, "n": n}
            total = np.bincount(code, weights=per_text, minlength=len(langs)).astype(np.int64)
            seeds = np.array([language_seed(x, salt) for x in langs], np.uint64)
            yield {"label": W.signed(seeds), "lang": langs, "word": [None] * len(langs), "n": total}

    found = arrow_stage(rows, "label long, lang string, word string, n long", count)
    return found.groupBy("label", "lang", "word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------------------- automata


class Automaton(NamedTuple):
    """Arcs level by level.  The first level reads two labels; an arc of a later level leaves the state that
    its `parent`, an arc of the level before, leads to.  `number` counts label numbers into `labels`."""

    labels: np.ndarray
    first: tuple[np.ndarray, np.ndarray, np.ndarray]  # number, number, weight
    later: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # parent, number, weight


def part_of(one: np.ndarray, two: np.ndarray, parts: int) -> np.ndarray:
    """The label range of the first arc, by its two words."""
    return (pair_hash(one, two) % np.uint64(parts)).astype(np.int64)


def pair_hash(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return W.mix(W.mix(one) * _PAIR + two)


def summed(kind: np.ndarray, weight: np.ndarray | None, n: int) -> np.ndarray:
    if weight is None:
        return np.bincount(kind, minlength=n)
    out = np.zeros(n, np.int64)
    np.add.at(out, kind, weight)
    return out


def build(labels: np.ndarray, first: tuple, later: list[tuple], parts: int) -> tuple[Automaton, np.ndarray]:
    """The automaton of arcs in any order, equal ones added up, with the part of each first arc (in order).

    Numbers follow the order of `labels`; a weight of None counts 1 for each arc.
    """
    one, two, weight = first
    key, kind = np.unique(one << 32 | two, return_inverse=True)
    part = part_of(labels[key >> 32], labels[key & 0xFFFFFFFF], parts)
    order = np.argsort(part, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    state, key = place[kind], key[order]
    top = (key >> 32, key & 0xFFFFFFFF, summed(state, weight, len(key)))
    below = []
    for parent, number, weight in later:
        key, kind = np.unique(state[parent] << 32 | number, return_inverse=True)
        below.append((key >> 32, key & 0xFFFFFFFF, summed(kind, weight, len(key))))
        state = kind
    return Automaton(labels, top, below), part[order]


def shard(label: np.ndarray, linked: np.ndarray, words: np.ndarray | None, pairs: np.ndarray | None, depth: int, parts: int):
    """Automaton of all phrases of two to `depth` words of a block, of listed words and pairs if there are lists."""
    if words is None:
        labels, number = np.unique(label, return_inverse=True)
        ok = linked[:-1].copy()
    else:
        labels, number = words, np.searchsorted(words, label)
        number[number == len(words)] = 0
        listed = words[number] == label if len(words) else np.zeros(len(label), bool)
        ok = linked[:-1] & listed[:-1] & listed[1:]
    at = np.flatnonzero(ok)
    if pairs is not None:
        at = at[holds(pairs, pair_hash(label[at], label[at + 1]))]
        ok = np.zeros(len(ok), bool)
        ok[at] = True
    number = number.astype(np.int64)
    ok = np.append(ok, np.zeros(depth, bool))
    later, start = [], at
    for step in range(1, depth - 1):
        more = np.flatnonzero(ok[start + step])
        start = start[more]
        later.append((more, number[start + step + 1], None))
    return build(labels, (number[at], number[at + 1], None), later, parts)


def holds(listed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values a sorted list holds."""
    if not len(listed):
        return np.zeros(len(values), bool)
    at = np.searchsorted(listed, values)
    at[at == len(listed)] = 0
    return listed[at] == values


ARCS = "one array<long>, two array<long>, n2 array<long>"
LATER = ", p{0} array<int>, l{0} array<long>, n{0} array<long>"


def arcs_schema(depth: int) -> str:
    return "part int, " + ARCS + "".join(LATER.format(k) for k in range(3, depth + 1))


def rows_of(a: Automaton, part: np.ndarray) -> dict:
    """One row per part; parents are counted from the part's first arc."""
    listed, begin = np.unique(part, return_index=True)
    cut = np.append(begin, len(part))

    def lists(values: np.ndarray, kind=None) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(values, kind))

    signed = W.signed(a.labels)
    out = {"part": listed, "one": lists(signed[a.first[0]]), "two": lists(signed[a.first[1]]), "n2": lists(a.first[2])}
    for k, (parent, number, weight) in enumerate(a.later, 3):
        before, cut = cut, np.searchsorted(parent, cut)
        own = parent - np.repeat(before[:-1], np.diff(cut))
        out |= {f"p{k}": lists(own, pa.int32()), f"l{k}": lists(signed[number]), f"n{k}": lists(weight)}
    return out


def shards(rows: DataFrame, salt: int, words, pairs, depth: int, parts: int) -> DataFrame:
    """Automata of all blocks of a scan, one row per block and part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        have: list[Tokens] = []

        def flush() -> Iterator[dict]:
            if have:
                label, linked = (np.concatenate([t[i] for t in have]) for i in (0, 1))
                have.clear()
                lists = (None if b is None else b.value for b in (words, pairs))
                found, part = shard(label, linked, *lists, depth, parts)
                if len(part):
                    yield rows_of(found, part)

        for batch in batches:
            for t, _, _ in scan(batch, salt):
                have.append(t._replace(data=None, found=None))
                if sum(len(x.label) for x in have) >= BLOCK:
                    yield from flush()
        yield from flush()

    return arrow_stage(rows, arcs_schema(depth), run, whole=True)


def dealt_by_part(rows: DataFrame, parts: int) -> DataFrame:
    """One task for each part or two: rows hold whole subtrees, and a task should hold few of them at once."""
    return rows.repartition(parts, "part")


def union(automata: list[list[np.ndarray]], parts: int) -> Automaton:
    """Sum of automata given as columns (one, two, n2, p3, l3, n3, ...)."""
    levels = list(zip(*automata, strict=True))
    unsigned = [np.concatenate(v).view(np.uint64) if i in (0, 1) or i > 3 and i % 3 == 1 else None for i, v in enumerate(levels)]
    labels, number = np.unique(np.concatenate([v for v in unsigned if v is not None]), return_inverse=True)
    numbers = iter(np.split(number.astype(np.int64), np.cumsum([len(v) for v in unsigned if v is not None])[:-1]))
    first = (next(numbers), next(numbers), np.concatenate(levels[2]))
    later = []
    for i in range(3, len(levels), 3):
        above = 2 if i == 3 else i - 1  # the weights of the level before: one for each arc
        shift = W.running(np.array([len(v) for v in levels[above]]))[:-1]
        parent = np.concatenate([p.astype(np.int64) + s for p, s in zip(levels[i], shift, strict=True)])
        later.append((parent, next(numbers), np.concatenate(levels[i + 2])))
    return build(labels, first, later, parts)[0]


def pruned(a: Automaton, least: int) -> Automaton:
    """Without arcs below `least` and all that hangs on them."""
    keep = a.first[2] >= least
    first, later = tuple(v[keep] for v in a.first), []
    for parent, number, weight in a.later:
        place = np.cumsum(keep) - 1
        keep, above = keep[parent] & (weight >= least), place
        later.append((above[parent[keep]], number[keep], weight[keep]))
    return Automaton(a.labels, first, later)


def columns_of(a: Automaton) -> list[np.ndarray]:
    signed = W.signed(a.labels)
    out = [signed[a.first[0]], signed[a.first[1]], a.first[2]]
    for parent, number, weight in a.later:
        out += [parent, signed[number], weight]
    return out


def arrays(batch: pa.RecordBatch, row: int, names: list[str]) -> list[np.ndarray]:
    return [batch.column(c).slice(row, 1).flatten().to_numpy(zero_copy_only=False) for c in names]


def united(pieces: DataFrame, depth: int, parts: int) -> DataFrame:
    """One automaton per part, the sum of all shards, without rare phrases."""
    schema = arcs_schema(depth)
    names = [c.split()[0] for c in schema.split(", ")][1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, waiting, size = None, [], 0

        def result() -> Iterator[dict]:
            if waiting:
                a = pruned(union(waiting, parts), LEAST)
                if len(a.first[0]):
                    yield rows_of(a, np.full(len(a.first[0]), current))

        for batch in batches:
            for row, part in enumerate(batch.column("part").to_pylist()):
                if part != current:
                    yield from result()
                    current, waiting, size = part, [], 0
                waiting.append(arrays(batch, row, names))
                size += sum(len(v) for v in waiting[-1][::3])
                if size > CONDENSE and len(waiting) > 1:
                    waiting = [columns_of(union(waiting, parts))]
                    # wait for as much again as is left
                    size = CONDENSE - max(CONDENSE, sum(len(v) for v in waiting[0][::3]))
        yield from result()

    return arrow_stage(dealt_by_part(pieces, parts).sortWithinPartitions("part"), schema, run, whole=True)


# ---------------------------------------------------------------------------------------- parts of phrases


def spelled(columns: list[np.ndarray]) -> Iterator[tuple[list[np.ndarray], list[np.ndarray]]]:
    """Labels and weights along the paths of each level."""
    labels, weights = [columns[0], columns[1]], [columns[2]]
    yield labels, weights
    for i in range(3, len(columns), 3):
        parent = columns[i]
        labels = [v[parent] for v in labels] + [columns[i + 1]]
        weights = [v[parent] for v in weights] + [columns[i + 2]]
        yield labels, weights


WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]


def phrases(automata: DataFrame) -> DataFrame:
    """All phrases: `w1 ... w4` (null behind the last), `a`, the counts `h2, h3` of the first two and three words of longer
    ones, and for the remaining parts of at least two words their part numbers."""
    names = automata.columns[1:]

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        for row in range(len(batch)):
            for labels, weights in spelled(arrays(batch, row, names)):
                n, size = len(labels), len(labels[0])
                none = pa.nulls(size, pa.int64())
                out = {w: labels[i] if i < n else none for i, w in enumerate(WORDS)}
                yield out | {"a": weights[-1], "h2": weights[0] if n > 2 else none, "h3": weights[1] if n > 3 else none}

    return arrow_stage(automata, ", ".join(f"{w} long" for w in WORDS) + ", a long, h2 long, h3 long", run)


def composed(automata: DataFrame, asked: DataFrame, parts: int) -> DataFrame:
    """Counts of the phrases `r1, r2, r3` (r3 may be null) of `asked`, next to its other columns.

    Both sides meet by part, the automaton first; the phrases follow their arcs all at once.
    """
    names = automata.columns[1:]
    rest = ["r1", "r2", "r3"]
    given = asked.columns
    carried = [c for c in given if c not in rest]

    def dealt(batch: pa.RecordBatch) -> Iterator[dict]:
        columns = dict(zip(given, batch.columns, strict=True))
        one, two = (columns[c].to_numpy(zero_copy_only=False).view(np.uint64) for c in rest[:2])
        yield {"part": part_of(one, two, parts)} | columns

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in asked.schema.fields)
    dealt_rows = arrow_stage(asked, "part int, " + schema, dealt)
    both = automata.withColumn("kind", F.lit(0)).unionByName(dealt_rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        table = None
        for batch in batches:
            kind = batch.column("kind").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(kind[1:] != kind[:-1]) + 1).tolist(), len(kind)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if hi == lo:
                    continue
                if kind[lo] == 0:  # only the last one can be asked for
                    table = arrays(batch, hi - 1, names)
                    continue
                part = batch.slice(lo, hi - lo)
                yield {c: part.column(c) for c in carried} | {"r": compose(table, part)}

    kinds = ", ".join(f"{c} {asked.schema[c].dataType.simpleString()}" for c in carried)
    met = dealt_by_part(both, parts).sortWithinPartitions("part", "kind")
    return arrow_stage(met, kinds + ", r long", run, whole=True)


def compose(table: list[np.ndarray], asked: pa.RecordBatch) -> np.ndarray:
    """Weights of the paths that phrases of two or three words spell; every one of them is there."""
    one, two, three = (asked.column(c) for c in ("r1", "r2", "r3"))
    top = np.rec.fromarrays([table[0], table[1]])
    order = np.argsort(top, order=("f0", "f1"))
    wanted = np.rec.fromarrays([one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)])
    state = order[np.searchsorted(top[order], wanted)]
    weight = table[2][state]
    longer = np.flatnonzero(three.is_valid().to_numpy(zero_copy_only=False))
    if len(longer):
        arcs = np.rec.fromarrays([table[3].astype(np.int64), table[4]])
        order = np.argsort(arcs, order=("f0", "f1"))
        label = three.take(pa.array(longer)).to_numpy(zero_copy_only=False)
        at = order[np.searchsorted(arcs[order], np.rec.fromarrays([state[longer], label]))]
        weight = weight.copy()
        weight[longer] = table[5][at]
    return weight


# ---------------------------------------------------------------------------------------- the report


def listed(df: DataFrame, value: Column) -> np.ndarray | None:
    """The values as a sorted array, or None beyond `FILTERED` of them."""
    found = df.select(value.alias("v")).limit(FILTERED + 1).toArrow()["v"].to_numpy().view(np.uint64)
    return None if len(found) > FILTERED else np.sort(found)


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The best phrases of each language: `lang, rank, phrase, a, l, r, n, score`."""
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    for salt in range(256):
        counts = materialize(word_counts(rows, salt), "words", conf=BATCHED)
        if counts.groupBy("label").count().where("count > 1").isEmpty():
            break
    words = counts.where(F.col("word").isNotNull() & (F.col("n") >= LEAST))
    totals = counts.where("word is null").select(F.col("lang").alias("of"), F.col("n").alias("all"))
    size = counts.where("word is null").agg(F.sum("n")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // PART_WORDS)

    def shared(values):
        return None if values is None else spark.sparkContext.broadcast(values)

    frequent = shared(listed(words, F.col("label")))
    pairs = united(shards(rows, salt, frequent, None, 2, parts), 2, parts)
    hashed = arrow_stage(
        pairs, "h long",
        lambda b: iter([{"h": W.signed(pair_hash(*(b.column(i).flatten().to_numpy(zero_copy_only=False).view(np.uint64) for i in (1, 2))))}]),
    )
    common = shared(listed(materialize(hashed, "pairs", conf=BATCHED), F.col("h")))
    automata = materialize(united(shards(rows, salt, frequent, common, LONGEST, parts), LONGEST, parts), "automata", conf=BATCHED)
    return report(scored(materialize(phrases(automata), "phrases", conf=BATCHED), automata, words, parts), totals)


def scored(found: DataFrame, automata: DataFrame, words: DataFrame, parts: int) -> DataFrame:
    """Candidates with their words, the counts of the cut with the least score, and that score."""
    small = fits_broadcast(words)
    for i, w in enumerate(WORDS, 1):
        side = words.select(F.col("label").alias("label"), F.col("word").alias(f"word{i}"), F.col("n").alias(f"f{i}"), F.col("lang").alias(f"lang{i}"))
        found = attach(found, side, {w: "label"}, take=[f"word{i}", f"f{i}"] + ["lang1"] * (i == 1), small=small)
    found = materialize(found, "named")
    n = F.when(F.col("w3").isNull(), 2).when(F.col("w4").isNull(), 3).otherwise(4)
    # remaining parts of two or three words, with the cut before them
    cut2 = F.struct(F.lit(1).alias("k"), F.col("w2").alias("r1"), F.col("w3").alias("r2"), F.col("w4").alias("r3"))
    cut3 = F.struct(F.lit(2).alias("k"), F.col("w3").alias("r1"), F.col("w4").alias("r2"), F.lit(None).cast("long").alias("r3"))
    asked = found.where("w3 is not null").select(*WORDS, F.explode(F.when(n == 4, F.array(cut2, cut3)).otherwise(F.array(cut2))).alias("x"))
    answers = composed(automata, asked.select(*WORDS, "x.*"), parts)
    answered = answers.groupBy(*WORDS).agg(
        F.max(F.when(F.col("k") == 1, F.col("r"))).alias("r_1"), F.max(F.when(F.col("k") == 2, F.col("r"))).alias("r_2")
    )
    same = F.lit(True)
    other = answered.select(*[F.col(w).alias(f"_{w}") for w in WORDS], "r_1", "r_2")
    for w in WORDS:
        same = same & F.col(w).eqNullSafe(F.col(f"_{w}"))
    found = found.join(other, same, "left").drop(*[f"_{w}" for w in WORDS])

    def cut(k: int, left: Column, right: Column, present: Column) -> Column:
        whole = F.lit(SCALE).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
        both = left.cast("decimal(20,0)") + right.cast("decimal(20,0)")
        score = F.floor(F.call_function("div", whole, both)).cast("long")
        return F.when(present, F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r")))

    last = F.when(n == 2, F.col("f2")).when(n == 3, F.col("f3")).otherwise(F.col("f4"))
    cuts = F.array_compact(
        F.array(
            cut(1, F.col("f1"), F.when(n == 2, last).otherwise(F.col("r_1")), F.lit(True)),
            cut(2, F.col("h2"), F.when(n == 3, last).otherwise(F.col("r_2")), n > 2),
            cut(3, F.col("h3"), last, n > 3),
        )
    )
    phrase = F.concat_ws(" ", *[f"word{i}" for i in range(1, LONGEST + 1)])
    return found.withColumn("best", F.array_min(cuts)).select(
        F.array_compact(F.array(*WORDS)).alias("key"), F.col("lang1").alias("lang"), phrase.alias("phrase"), "a", "best.l", "best.r", "best.score"
    )


def report(found: DataFrame, totals: DataFrame) -> DataFrame:
    """Without phrases that live in longer ones, the best of each language, ranked."""
    found = materialize(found, "scored", conf=BATCHED)
    n = F.size("key")
    pieces = [
        F.when((n > size) & (n - size >= at - 1), F.slice("key", at, size)) for size in (2, 3) for at in range(1, LONGEST - size + 2)
    ]
    inside = found.where(n > 2).select(F.explode(F.array_compact(F.array(*pieces))).alias("inner"), "a")
    longest = inside.groupBy("inner").agg(F.max("a").alias("longer"))
    own = found.join(longest, found["key"] == longest["inner"], "left")
    high, low = (F.lit(x).cast("decimal(3,0)") for x in INSIDE)
    mostly = high * F.col("longer").cast("decimal(20,0)") >= low * F.col("a").cast("decimal(20,0)")
    own = own.where(F.col("longer").isNull() | ~mostly)
    # first within buckets of a language, then over what they leave, so that no language is one task
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    bucket = F.pmod(F.xxhash64("key"), F.lit(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    best = own.withColumn("bucket", bucket).withColumn("at", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order)))
    best = best.where(F.col("at") <= TOP).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    named = attach(best.where(F.col("rank") <= TOP), totals, {"lang": "of"}, take=["all"])
    return named.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("all").alias("n"), "score")
