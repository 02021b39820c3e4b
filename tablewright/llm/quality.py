"""Quality rules as a short-circuit cascade.

Every rule looks at whole texts and says which to reject; a document is kept if none does.  Verdicts
do not depend on the order of the rules, the work does: a rule that rejects many documents for little
time should run first, because later rules see only what is left.  `plan` therefore runs each rule on
a sample, takes time per byte and share rejected, and orders by rejection per cost.  The sample is
bounded (`SAMPLE_ROWS`) and decides nothing but the order.

Null, empty and blank texts have no words and are rejected as short.  Ties do not matter: each
document is judged alone, and repeated rows get the same verdict each.  An empty table gives an
empty result (rules in the order given).  Other columns pass through, whatever their names.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .frames import arrow_stage

SAMPLE_ROWS = 2000
MIN_WORDS = 20
WINDOW = 8
MAX_REPEATED_PERCENT = 30
MAX_SYMBOL_SHARE = 0.05
MAX_CAPITAL_SHARE = 0.40
MAX_STUTTER_SHARE = 0.30

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_FIRST_BYTE = np.ones(256, bool)  # of a code point
_FIRST_BYTE[0x80:0xC0] = False


def per_text(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(W.running(mask)[bounds])


def repeats(keys: np.ndarray) -> np.ndarray:
    """Which entries have an equal one."""
    order = np.argsort(keys)
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    out = np.empty(len(keys), bool)
    out[order] = same[1:] | same[:-1]
    return out


def repeated_words(w: W.Words, hashes: np.ndarray) -> np.ndarray:
    """Words per text inside runs of `WINDOW` words that the text has twice or more."""
    n = len(w.start)
    at = W.window_starts(w.first, WINDOW)
    if not len(at):
        return np.zeros(len(w.first) - 1, np.int64)
    own = W.owners(w.first)[at].astype(np.uint64)
    keys = W.run_hash(W.run_sums(hashes), at, at + WINDOW) + W.mix(own, 77)
    return per_text(W.covered(at[repeats(keys)], WINDOW, n), w.first)


def repeated_lines(t: W.Texts, w: W.Words) -> np.ndarray:
    """Lines per text that have a word and equal an earlier line of the text."""
    texts = len(t.bounds) - 1
    breaks = np.flatnonzero(t.data == 10)
    # a line begins at a text's start and after each break; both sorted, texts in order
    text_of_break = np.searchsorted(t.bounds, breaks, "right") - 1
    start = np.concatenate([t.bounds[:-1], breaks + 1])
    text = np.concatenate([np.arange(texts), text_of_break])
    order = np.lexsort((start, text))
    start, text = start[order], text[order]
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    last = np.append(text[1:] != text[:-1], True)
    end[last] = t.bounds[1:]
    with_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, text = start[with_word], end[with_word], text[with_word]
    keys = W.hash_ranges(t.data, start, end) + W.mix(text.astype(np.uint64), 78)
    _, kept = np.unique(keys, return_index=True)
    return np.bincount(text, minlength=texts) - np.bincount(text[kept], minlength=texts)


def measures(t: W.Texts) -> dict[str, np.ndarray]:
    """Base counts of every text: words, their code points, symbols, repeated lines and words."""
    w = W.words(t)
    hashes = W.hash_ranges(t.data, w.start, w.end)
    return {
        "n_words": np.diff(w.first),
        "word_chars": per_text(_FIRST_BYTE[t.data] & W.IN_WORD[t.data], t.bounds),
        "n_symbols": per_text(_SYMBOL[t.data], t.bounds),
        "n_dup_lines": repeated_lines(t, w),
        "n_repeat_words": repeated_words(w, hashes),
    }


def base_failed(m: dict[str, np.ndarray]) -> np.ndarray:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED_PERCENT * m["n_words"])


def short(t: W.Texts) -> np.ndarray:
    return np.diff(W.words(t).first) < MIN_WORDS


def repetitive(t: W.Texts) -> np.ndarray:
    w = W.words(t)
    repeated = repeated_words(w, W.hash_ranges(t.data, w.start, w.end))
    return 100 * repeated > MAX_REPEATED_PERCENT * np.diff(w.first)


def symbols(t: W.Texts) -> np.ndarray:
    return per_text(_SYMBOL[t.data], t.bounds) > MAX_SYMBOL_SHARE * np.diff(t.bounds)


def capitals(t: W.Texts) -> np.ndarray:
    return per_text(_CAPITAL[t.data], t.bounds) > MAX_CAPITAL_SHARE * np.diff(t.bounds)


def stutter(t: W.Texts) -> np.ndarray:
    """Too many words that equal the word before them."""
    w = W.words(t)
    h = W.hash_ranges(t.data, w.start, w.end)
    if not len(h):
        return np.zeros(len(w.first) - 1, bool)
    again = np.zeros(len(h), bool)
    again[1:] = h[1:] == h[:-1]
    again[w.first[:-1][np.diff(w.first) > 0]] = False
    return per_text(again, w.first) > MAX_STUTTER_SHARE * np.diff(w.first)


Rule = Callable[[W.Texts], np.ndarray]
RULES: dict[str, Rule] = {
    "short": short, "repetitive": repetitive, "symbols": symbols, "capitals": capitals, "stutter": stutter,
}
IN_BASE = ("short", "repetitive")


def passes(texts: pa.Array, order: Sequence[str]) -> np.ndarray:
    """The cascade: each rule sees the texts that all rules before it let through."""
    left = np.arange(len(texts))
    for name in order:
        if not len(left):
            break
        rest = texts if len(left) == len(texts) else texts.take(pa.array(left))
        rejected = [RULES[name](t) for _, _, t in W.slices(rest)]
        left = left[~np.concatenate(rejected)]
    out = np.zeros(len(texts), bool)
    out[left] = True
    return out


def plan(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of all rules, by rejection per cost on a sample of about `rows` texts.

    Rows are drawn where they are stored, with a chance of `rows` over their number: nothing is shuffled, and
    copies of one text are drawn one by one.
    """
    chance = min(1.0, rows / max(docs.count(), 1))
    sample = docs.select(F.col(f"`{text}`").alias("t")).sample(chance, seed=rows)

    def time_rules(batch: pa.RecordBatch) -> Iterator[dict]:
        for name, rule in RULES.items():
            spent, rejected = 0, 0
            for _, _, t in W.slices(batch.column(0)):
                began = time.process_time_ns()
                rejected += int(rule(t).sum())
                spent += time.process_time_ns() - began
            yield {"rule": [name], "ns": [spent], "rejected": [rejected]}

    timed = arrow_stage(sample, "rule string, ns long, rejected long", time_rules)
    worth = {
        r["rule"]: r["rejected"] / max(r["ns"], 1)
        for r in timed.groupBy("rule").agg(F.sum("ns").alias("ns"), F.sum("rejected").alias("rejected")).collect()
    }
    return sorted(RULES, key=lambda name: -worth.get(name, 0.0))


def keep_good(docs: DataFrame, text: str = "text", order: Sequence[str] | None = None) -> DataFrame:
    """The rows of `docs` that no rule rejects."""
    order = list(order or plan(docs, text))
    names = docs.columns
    at = names.index(text)

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        kept = batch.filter(pa.array(passes(batch.column(at), order)))
        yield dict(zip(names, kept.columns, strict=True))

    return arrow_stage(docs, docs.schema, judge)


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", order: Sequence[str] | None = None) -> DataFrame:
    """Base counts, base verdict and the verdict of the cascade for every row."""
    order = [name for name in (order or plan(docs, text)) if name not in IN_BASE]
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def judge(batch: pa.RecordBatch) -> Iterator[dict]:
        keys, texts = batch.columns
        for lo, hi, t in W.slices(texts):
            m = measures(t)
            failed = base_failed(m)
            kept = ~failed
            passed = np.flatnonzero(kept)
            # the base verdict is known, so the cascade goes on with what it let through
            kept[passed] = passes(texts.slice(lo, hi - lo).take(pa.array(passed)), order)
            yield {"doc_id": keys.slice(lo, hi - lo), **m, "base_failed": failed, "kept": kept}

    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_failed boolean, kept boolean"
    return arrow_stage(docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")), schema, judge)
