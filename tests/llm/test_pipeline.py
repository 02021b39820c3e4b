"""The stages of the pipeline, and all of them in a row, against plain Python over a small table."""

import collections
import hashlib
import math
import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tablewright.session import ship

WORD = re.compile("[^\x20\x09-\x0d]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use for columns of their own
CLASHING = DOCS + ", `one` int, two string, turn int, size string, words int, k string, t string, component_id long, __h1 int, v double"
EXTRA = (1, "x", 2, "s", 3, "k", "t", 4, 5, 6.5)
PRIVATE = {"bob.k@example.com": "<EMAIL>", "10.0.77.3": "<IP>", "4111 1111 1111 1111": "<CARD>", "+49 (170) 123-4567": "<PHONE>"}


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def counted_rules(text):
    """Whether no rule rejects a text, each rule in its plainest form."""
    text = text or ""
    w = WORD.findall(text)
    if len(w) < 20:
        return False
    seen = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    again = {k for i in range(len(w) - 7) if seen[tuple(w[i : i + 8])] > 1 for k in range(i, i + 8)}
    size = len(text.encode())
    return not (
        100 * len(again) > 30 * len(w)
        or sum(text.count(c) for c in "#*$%&|<>") > 0.05 * size
        or sum("A" <= c <= "Z" for c in text) > 0.40 * size
        or sum(a == b for a, b in zip(w[1:], w, strict=False)) > 0.30 * len(w)
    )


def shingles(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def grouped(rows):
    """Indices of rows by group of linked texts."""
    sets, label = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    groups = collections.defaultdict(list)
    for i, x in enumerate(label):
        groups[x].append(i)
    return list(groups.values())


def least(rows):
    return [min((rows[i] for i in g), key=lambda r: (r[0] is None, r[0] or 0)) for g in grouped(rows)]


def hidden(row):
    text = row[1]
    for value, kind in PRIVATE.items():
        text = text and text.replace(value, kind)
    return (row[0], text, *row[2:4], len(text) if text is not None else row[4])


def dealt(rows):
    """What weighted queues hand out: budget 150 %, weights 5, 2, 1, at most two turns."""
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    order = sorted(s for s in sizes if s is not None) + [None] * (None in sizes)
    weights, full = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = {s: rest * weights[s] / sum(weights[x] for x in order if x not in full) for s in order if s not in full}
        over = {s for s in share if share[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    goal = {s: 2 * sizes[s] if s in full else share[s] for s in order}
    out = []
    for source in order:
        left = math.floor(goal[source])
        queue = [r for r in rows if r[3] == source]
        md5 = lambda k: (k is not None, k is not None and hashlib.md5(str(k).encode()).hexdigest())
        for r in sorted(queue, key=lambda r: md5(r[0])) * 2:
            words = WORD.findall(r[1] or "")
            given, left = min(left, len(words)), left - min(left, len(words))
            if given:
                text = r[1] if given == len(words) else " ".join(words[:given])
                out.append((*r[:1], text, *r[2:4], r[4] if given == len(words) else len(text)))
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(12)
    words = ["".join(rnd.choice("abcdefghijklmnopéß") for _ in range(rnd.randint(1, 8))) for _ in range(500)]
    make = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    texts = [None, "", " \t ", "short one", make(19), make(20), "% & ".join(make(40).split()), make(40).upper(), " ".join(w for w in make(12).split() for _ in range(6))]
    texts += [(make(9) + " ") * 6, make(30) + "\n" + make(6000), "y" * 30_000 + " " + make(25)]
    for value in PRIVATE:
        texts.append(make(20) + " " + value + " and " + make(9))
    texts.append(" then ".join([make(25), *PRIVATE, make(4)]))
    for n in (25, 60, 150):
        base = make(n)
        near = base.split()
        near[n // 2] = "changed"
        texts += [base, base.title(), base + " " + make(1), "\n".join(near), make(n)]
    texts += [make(rnd.randint(10, 90)) for _ in range(30)]
    keys = rnd.sample(range(1000), len(texts))
    keys[-1] = None
    return [(k, t, rnd.choice(["en", "de", None]), rnd.choices(["hot", "a", "é", None], (6, 2, 1, 1))[0], len(t or "")) for k, t in zip(keys, texts, strict=True)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], CLASHING)


def counts(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_quality_stage(spark, rows):
    out = corpus_pipeline.good(spark, frame(spark, rows * 2), "")
    assert ", ".join(f"{n} {t.replace('bigint', 'long')}" for n, t in out.dtypes) == DOCS
    assert counts(out) == collections.Counter([r for r in rows * 2 if counted_rules(r[1])])


def test_join_stage(spark, rows):
    out = corpus_pipeline.distinct(spark, frame(spark, rows), "")
    assert counts(out) == collections.Counter(least(rows))


def test_join_stage_with_repeated_rows_and_ids(spark, rows):
    several = [*rows, *rows[9:30], *[(5, r[1], *r[2:]) for r in rows[20:]], (None, None, None, None, None)]
    got = [tuple(r) for r in corpus_pipeline.distinct(spark, frame(spark, several), "").collect()]
    texts = [r for r in got if shingles(r[1])]
    assert set(got) <= set(several) and len(texts) == len(grouped([r for r in several if shingles(r[1])]))
    assert all(len(g) == 1 for g in grouped(texts))
    # what links with nothing stays: each id once, and each row without an id
    bare = [r for r in several if not shingles(r[1])]
    assert len(got) - len(texts) == len({r[0] for r in bare if r[0] is not None}) + sum(r[0] is None for r in bare)


def test_privacy_stage(spark, rows):
    out = corpus_pipeline.private(spark, frame(spark, rows * 2), "")
    assert counts(out) == collections.Counter([hidden(r) for r in rows] * 2)


def test_mix_stage(spark, rows):
    assert counts(corpus_pipeline.mixed(spark, frame(spark, rows), "")) == collections.Counter(dealt(rows))


def pieces(rows):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    out = []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        out += [(r[0], k, at, tuple(ids[at : at + 4096])) for k, at in enumerate(range(0, len(ids), 4096))]
    return collections.Counter(out)


def check_packed(found, rows):
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], tuple(r["ids"])) for r in found) == pieces(rows)
    sequences = collections.defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 4096


def test_pack_stage(spark, rows):
    check_packed(corpus_pipeline.packed(spark, frame(spark, rows + rows[20:25]), "").collect(), rows + rows[20:25])


def test_run(spark, rows, tmp_path):
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    kept = least([r for r in rows if counted_rules(r[1])])
    check_packed(corpus_pipeline.run(spark, str(tmp_path)).collect(), dealt([hidden(r) for r in kept]))


def test_empty_table(spark, rows, tmp_path):
    frame(spark, rows).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "jaccard_join", "pii", "mix_sources", "pack"]
