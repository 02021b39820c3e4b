"""Collocations, conversation repair and SentencePiece against brute force, and their special cases."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from tablewright.llm import collocations, dialogues, sentencepieces, words
from tablewright.llm.frames import arrow_stage
from tablewright.session import materialize, ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


# -- sentencepiece -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    return public_tokenizers.path("piece_bpe_32k.model")


EXTRA = "doc_id long, text string, ids int, decoded string, t int, `__text` int"


def special_texts():
    rnd, alphabet = random.Random(1), list("abc  ▁\n\té漢😀\x00.,19<s>  ́‍")
    out = [None, "", " ", "  ", "▁", "a", " a", "a ", "a  ", "  a  b  ", "<s> </s> <unk>", "\n\n", " \n ", "\x00", "x" * 50_000, "▁▁a▁", "漢字 漢字", "<0x0A>"]
    out += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(800)]
    return out + ["one two  one two"] * 40 + ["very " * 20_000 + "long"]


def encoded(spark, texts, model, ids=None):
    rows = [(i if ids is None else ids[i], t, 1, "x", 2, 3) for i, t in enumerate(texts)]
    return [(r["doc_id"], list(r["ids"]), r["decoded"]) for r in sentencepieces.encode(spark.createDataFrame(rows, EXTRA), model).collect()]


def test_pieces_are_the_librarys(spark, model):
    sp, texts = sentencepieces.processor(model), special_texts()
    want = [(i, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in enumerate(texts)]
    assert sorted(encoded(spark, texts, model)) == want


def test_pieces_do_not_depend_on_the_table(spark, model, monkeypatch):
    sp, texts = sentencepieces.processor(model), special_texts()[:200] + ["one two  one two"] * 9
    want = sorted((sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for t in texts)
    for most in (0, 3):
        monkeypatch.setattr(sentencepieces, "TABLE_CHUNKS", most)
        assert sorted(e[1:] for e in encoded(spark, texts, model, [i % 3 or None for i in range(len(texts))])) == want
    assert encoded(spark, [], model) == []


def test_frequent_chunks_are_bounded(spark):
    counts = spark.createDataFrame([(bytes([i]), n) for i, n in enumerate([2, 2, 3, 9, 9, 100, 5000])], "chunk binary, n long")
    assert [r["n"] for r in sentencepieces.frequent(counts, 3).collect()] == [100, 5000]  # the nines are a level of their own
    assert sentencepieces.frequent(counts, 4).count() == 4 and sentencepieces.frequent(counts, 0).count() == 0


def test_models_whose_pieces_cross_markers_are_refused():
    class Crossing:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "of▁the"

        def encode(self, text, out_type=int):
            return ["▁" + text] if out_type is str else [0]

        def decode(self, ids):
            return " a  b "

    assert not sentencepieces.splits_at_markers(Crossing())


def test_ranges_that_agree_in_one_hash_are_apart(monkeypatch):
    data = np.frombuffer(b"aabbaacc", np.uint8)
    start = np.arange(0, 8, 2)
    monkeypatch.setattr(words, "two_hashes", lambda d, s, e: (np.zeros(4, np.uint64), np.array([1, 2, 1, 3], np.uint64)))
    found = words.distinct(data, start, start + 2)
    kinds = [data[start[found.place[k]]] for k in found.kind]
    assert [chr(k) for k in kinds] == ["a", "b", "a", "c"]


# -- conversations -------------------------------------------------------------------------------

SPACE = "[\x20\x09-\x0d]"


def damaged(rows):
    """The damage in plain Python: `{conv: [(turn, role, text)]}` with the rows in order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(kept, key=order) for c, kept in out.items()}


def told(rows):
    """First faults, by the plain rules."""
    seen, out = set(), []
    for _, role, text in rows:
        last = re.sub(f"{SPACE}+$", "", text)[-1:]
        out.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else None)
        seen.add((role, text))
    return out


def all_repairs(rows, faults):
    """Every way of editing with at most two inserted rows in one place: (cost, audit, lines)."""
    inserts = [()] + [(a,) for a in "ua"] + [(a, b) for a in "ua" for b in "ua"]
    name = {"u": "user", "a": "assistant"}

    def choices(row, fault):
        yield 4, "D", None
        if fault not in ("blank", "duplicate"):
            extra = 3 * (fault == "truncated")
            if row[1][:1] in {"s", "u", "a"}:  # a role without such an initial cannot stay
                yield extra, "K", (row[1][:1], f"{row[1]}:{row[2]}")
            for c in "ua":
                yield 3 + extra, "R", (c, f"{name[c]}:{row[2]}")

    ways = [(0, "", "", ())]
    for step in range(len(rows) + 1):
        # inserted rows, then the row itself; places in the pattern that cannot be completed fall
        ways = [
            (cost + 3 * len(add), audit + "I" * len(add), roles + "".join(add), lines + tuple(name[a] + ":" for a in add))
            for cost, audit, roles, lines in ways for add in inserts
        ]
        ways = [w for w in ways if re.fullmatch("s?(ua)*u?", w[2])]
        if step < len(rows):
            ways = [
                (cost + price, audit + letter, roles + (made[0] if made else ""), lines + ((made[1],) if made else ()))
                for cost, audit, roles, lines in ways for price, letter, made in choices(rows[step], faults[step])
            ]
            ways = [w for w in ways if re.fullmatch("s?(ua)*u?", w[2])]
            ways = sorted(ways)
            best = min(w[0] for w in ways)
            ways = [w for w in ways if w[0] <= best + 14]
    return [w for w in ways if re.fullmatch("(s?(ua)+)?", w[2])]


def repaired(rows):
    faults = told(rows)
    cost, audit, _, lines = min(all_repairs(rows, faults), key=lambda w: (w[0], w[1]))
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    )


CONVERSATION = "conv_id long, turn long, role string, text string, fault int, copy string, moves int"


def conversations(seed, n):
    rnd = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rnd.randint(0, 5)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ugly"])
            text = rnd.choice(["a.", "b.", "Why?", "no end", "", " \t", None, "é漢!", f"{rnd.random()}."])
            rows.append((rnd.choice([conv, conv, conv, None]) if conv == 3 else conv, rnd.choice([turn, turn, turn * 3, None]), role, text))
    return rows


def by_conversation(df):
    return {r["conv_id"]: tuple(r)[1:] for r in df.collect()}


def test_repairs_are_the_cheapest_and_least(spark):
    rows = conversations(4, 150)
    rows = [r for r in rows if r[0] is not None] + [(None, 1, "user", "x."), (None, None, None, None)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], CONVERSATION)
    got = by_conversation(dialogues.repaired(dialogues.damaged(frame)))
    want = {c: repaired(kept) for c, kept in damaged(rows).items()}
    assert set(got) == {r[0] for r in rows}
    assert got == want


def audit_of(rows, block):
    """Cost and letters by the search alone, with blocks of a given size."""
    search = dialogues.Search(block)
    moves = [search.add(role, fault) for role, fault in reversed(rows)][::-1]
    repair = dialogues.Repair()
    for i, (role, fault) in enumerate(rows):
        repair.add(i, role, "x", fault, moves[i])
    out = repair.finish()
    return out["cost"], out["audit"], out["repaired_sha256"]


def test_blocks_decide_as_whole_conversations_do():
    rnd = random.Random(8)
    for n in (1, 2, 3, 17, 64, 250):
        for _ in range(12):
            rows = [(rnd.choice("usaaut"), rnd.choice([0, 0, 0, 1, 2, 3])) for _ in range(n)]
            whole = audit_of(rows, 10_000)
            assert all(audit_of(rows, block) == whole for block in (1, 2, 5, 16))


def test_long_conversations_stream(spark):
    rows = [(7, i, "user" if i % 2 == 0 else "assistant", f"t{i}.") for i in range(3000)] + [(8, None, "user", "same.")] * 50
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = by_conversation(dialogues.repaired(dialogues.damaged(frame)))
    kept = damaged(rows)
    assert [got[7][i] for i in range(5)] == [list(repaired_counts(kept[7]))[i] for i in range(5)]
    # the one row of the second that is no duplicate stays and gets an answer, unless its damage took it
    assert got[8][2] == max(0, len(kept[8]) - 1) and got[8] == (0, *repaired_counts(kept[8])[1:], *got[8][5:])
    one = dialogues.repaired(dialogues.damaged(frame.where("false")))
    assert one.count() == 0


def repaired_counts(rows):
    faults, turns = told(rows), [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs))


# -- collocations --------------------------------------------------------------------------------


def counted_phrases(rows):
    """Everything by plain counting: {lang: [(rank, phrase, a, l, r, n, score)]}."""
    f, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            ws = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                f.update((lang, *ws[i : i + k]) for i in range(len(ws) - k + 1))
    cands = {p: a for p, a in f.items() if len(p) > 2 and a >= collocations.LEAST}
    out = collections.defaultdict(list)
    for (lang, *ws), a in cands.items():
        longer = [
            b for (other, *vs), b in cands.items()
            if other == lang and len(vs) > len(ws) and any(vs[i : i + len(ws)] == ws for i in range(len(vs)))
        ]
        if any(100 * b >= 80 * a for b in longer):
            continue
        cuts = [(2_000_000 * a // (f[(lang, *ws[:k])] + f[(lang, *ws[k:])]), k) for k in range(1, len(ws))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(ws).encode(), f[(lang, *ws[:k])], f[(lang, *ws[k:])]))
    return {
        lang: [(i, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[: collocations.TOP], 1)]
        for lang, found in out.items()
    }


def phrase_rows(seed, n):
    rnd = random.Random(seed)
    words = ["de", "la", "Of", "the", "x1", "ÉTÉ", "été", "a-b", "漢字", "'s", "\x00", "z", "zz", "zzz"]
    fixed = ["of the x1", "De la ÉTÉ 漢字", "zz zzz zz zzz", "z z z z z z"]
    rows = [(None, None), ("en", ""), ("en", " \t. ,;"), ("xx", "rare words only"), ("und", "x1 of the")]
    for _ in range(n):
        parts = [rnd.choice(words) if rnd.random() < 0.7 else rnd.choice(fixed) for _ in range(rnd.randint(1, 30))]
        glue = [rnd.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!"]) for _ in parts]
        rows.append((rnd.choice(["en", "en", "fr", None]), "".join(p + g for p, g in zip(parts, glue, strict=True))))
    return rows + [("en", "of the x1 " * 4000)]


PHRASES = "lang string, text string, w1 int, part int, label string, a int, n string, doc_id long"


def collocated(spark, rows):
    frame = spark.createDataFrame([(*r, 1, 2, "x", 3, "y", None) for r in rows], PHRASES)
    out = collections.defaultdict(list)
    for r in collocations.collocations(frame).collect():
        out[r["lang"]].append((r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]))
    return {lang: sorted(found) for lang, found in out.items()}


@pytest.fixture(scope="module")
def phrases():
    rows = phrase_rows(2, 700)
    return rows, counted_phrases(rows)


def test_collocations_by_counting(spark, phrases):
    rows, want = phrases
    assert want and collocated(spark, rows) == want


@pytest.mark.parametrize(("name", "value"), [("FILTERED", 0), ("BLOCK", 50), ("CONDENSE", 10), ("PART_WORDS", 500)])
def test_collocations_however_they_are_dealt(spark, phrases, monkeypatch, name, value):
    rows, want = phrases
    monkeypatch.setattr(collocations, name, value)
    assert collocated(spark, rows) == want


def test_collocations_send_bounded_batches(spark, phrases, monkeypatch):
    """Rows with whole subtrees reach Python in batches bounded by bytes, and the session keeps its own settings."""
    (key, limit), = collocations.BATCHED.items()
    before = spark.conf.get(key, None)
    wide = spark.range(64, numPartitions=1).selectExpr("array_repeat(id, 131072) AS v")  # 1 MB a row
    stage = arrow_stage(wide, "n long, b long", lambda batch: iter([{"n": [len(batch)], "b": [batch.nbytes]}]))
    sizes = materialize(stage, "sizes", conf=collocations.BATCHED).collect()
    assert sum(r["n"] for r in sizes) == 64 and max(r["b"] for r in sizes) <= int(limit) + (2 << 20)
    seen, real = {}, collocations.materialize

    def watched(df, label, **given):
        seen[label] = given.get("conf")
        return real(df, label, **given)

    monkeypatch.setattr(collocations, "materialize", watched)
    rows, want = phrases
    assert collocated(spark, rows) == want
    assert all(seen[label] == collocations.BATCHED for label in ("words", "pairs", "automata", "phrases", "scored"))
    assert spark.conf.get(key, None) == before


def test_collocations_when_labels_collide(spark, phrases, monkeypatch):
    rows, want = phrases
    real = collocations.word_counts

    def colliding(given, salt):
        counts = real(given, salt)
        return counts.selectExpr("if(word in ('de', 'la'), 1, label) AS label", "lang", "word", "n") if salt == 0 else counts

    monkeypatch.setattr(collocations, "word_counts", colliding)
    assert collocated(spark, rows) == want


def test_collocations_of_little(spark):
    assert collocated(spark, []) == {}
    assert collocated(spark, [("en", "a b")] * 29 + [("en", "a. b")]) == {}
    assert collocated(spark, [("en", "a b")] * 30) == {"en": [(1, "a b", 30, 30, 30, 60, 1_000_000)]}


def test_union_and_build_agree():
    rnd = np.random.default_rng(5)
    for depth in (2, 3, 4):
        label, linked = rnd.integers(0, 6, 400).astype(np.uint64) * np.uint64(11), rnd.random(400) < 0.8
        linked[199] = linked[399] = False
        whole, part = collocations.shard(label, linked, None, None, depth, 7)
        assert (np.diff(part) >= 0).all()
        halves = [collocations.shard(label[s], linked[s], None, None, depth, 7)[0] for s in (slice(0, 200), slice(200, 400))]
        both = collocations.union([collocations.columns_of(h) for h in halves], 7)

        def spelled(a):
            return {tuple(x): w for ls, ws in collocations.spelled(collocations.columns_of(a)) for *x, w in zip(*ls, ws[-1], strict=True)}

        counts = collections.Counter()
        for i in range(400):
            for k in range(2, depth + 1):
                if i + k <= 400 and linked[i : i + k - 1].all():
                    counts[tuple(label[i : i + k].view(np.int64))] += 1
        assert spelled(whole) == spelled(both) == dict(counts)
        kept = {p: n for p, n in counts.items() if n >= 9}
        assert spelled(collocations.pruned(whole, 9)) == kept
