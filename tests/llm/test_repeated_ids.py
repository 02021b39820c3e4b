"""Ids that name several texts, or none: nothing may be lost or mixed up."""

import collections
import random
import re

import pytest

import corpus_pipeline
from tablewright.llm import substrings
from tablewright.session import ship

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `one` int, two string, turn int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def without_repeats(rows):
    """Kept words of each row, by looking at all windows of all rows."""
    n, seen = substrings.LENGTH, collections.Counter()
    split = [WORD.findall(t or "") for _, t in rows]
    for ws in split:
        seen.update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for (key, _), ws in zip(rows, split, strict=True):
        gone = {i + k for i in range(len(ws) - n + 1) if seen[tuple(ws[i : i + n])] > 1 for k in range(n)}
        out.append((key, len(ws), len(gone), " ".join(w for i, w in enumerate(ws) if i not in gone)))
    return collections.Counter(out)


def test_substrings_of_ids_with_several_texts(spark):
    rnd = random.Random(4)
    words = ["w%d" % i for i in range(300)]
    make = lambda k: " ".join(rnd.choice(words) for _ in range(k))
    passage = make(50)
    rows = [
        (1, "short text"), (1, make(30) + " " + passage + " " + make(30)), (1, make(200)), (1, make(200)), (1, None), (1, ""),
        (2, make(7) + " " + passage), (2, make(90)), (3, "same " * 3 + make(60)), (None, passage + " " + make(40)), (None, make(80)), (None, None),
        (4, make(45)), (5, make(3) + " " + make(35)),
    ]
    rows += [rows[8], rows[12], (None, rows[10][1]), (6, rows[2][1] + " more")]
    frame = spark.createDataFrame([(k, t, None, None, 0, 1, "x", 2) for k, t in rows], DOCS)
    got = collections.Counter((r["id"], r["n_words"], r["n_removed"], r["kept"]) for r in substrings.without_repeats(frame).collect())
    assert got == without_repeats(rows)


def mixed(spark, rows):
    frame = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 2) for r in rows], DOCS)
    return [tuple(r) for r in corpus_pipeline.mixed(spark, frame, "").collect()]


@pytest.mark.parametrize("turned", [False, True])
def test_mix_tells_null_from_absent(spark, turned):
    rows = [(1, None, "en words here", "a"), (1, "en words here", None, "a"), (1, "en words here", None, None), (1, "en", "words here", "a")]
    rows += [(2, "other words in this one", "en", "b")] * 3
    found = mixed(spark, rows[::-1] if turned else rows)
    assert {(r[0], r[1] and r[1].split()[0], r[2], r[3]) for r in found if r[1]} >= {(1, "en", None, "a"), (2, "other", "en", "b")}
    # what is served are beginnings of rows of that id, language and source
    for doc_id, text, lang, source, n_chars in found:
        assert any(r[0] == doc_id and r[2] == lang and r[3] == source and (r[1] or "").startswith(text or "") for r in rows)
        assert n_chars == len(text or "")


def test_mix_takes_what_the_queue_says(spark):
    """Words by row as the operator deals them, each text served whole but the last turn."""
    from tablewright.llm import mixing

    rnd = random.Random(9)
    rows = [(rnd.choice([1, 2, None]), " ".join(str(rnd.randint(0, 9)) for _ in range(rnd.randint(0, 40))) or None, rnd.choice(["en", None]), rnd.choice("abc")) for _ in range(60)]
    rows += rows[:9]
    frame = spark.createDataFrame([(*r, len(r[1] or ""), 1, "x", 2) for r in rows], DOCS)
    served = mixing.served(frame.select("doc_id", "source", mixing.word_count("text").alias("size"))).collect()
    per_source = collections.Counter()
    for r in served:
        per_source[r["source"]] += r["taken"]
    got = collections.Counter()
    for r in corpus_pipeline.mixed(spark, frame, "").collect():
        got[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert got == per_source


def test_what_reaches_the_driver_is_bounded(spark, monkeypatch):
    """One id that names very many rows: windows and training texts stay within their bounds."""
    from tablewright.llm import language, toxicity

    rows = spark.range(20_000).selectExpr("7L AS doc_id", "concat('some words ', id % 9000, ' and more') AS text", "'en' AS lang")
    blank = spark.range(500).selectExpr("7L AS doc_id", "' ' AS text", "'en' AS lang")
    few = spark.createDataFrame([(7, "ein anderer Text", "de")] * 300, "doc_id long, text string, lang string")
    windows = language.labelled_windows(rows.union(blank).union(few))
    assert len(windows["en"]) == language.WINDOWS and windows["de"] == ["ein anderer Text"]
    sizes, real = [], toxicity._feature_sets
    monkeypatch.setattr(toxicity, "_feature_sets", lambda df: sizes.append(len(found := real(df))) or found)
    labels = spark.createDataFrame([(7, 1), (7, 0)], "doc_id long, toxic int")
    toxicity.fit(rows, labels)
    assert sizes == [toxicity.MAX_POSITIVE, toxicity.MAX_UNLABELLED]
