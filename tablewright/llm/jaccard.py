"""Similarity join of documents on word shingles: exact Jaccard links, and the groups they form.

The join is the product of the sparse incidence matrix (documents by shingles) with its transpose,
taken only where a product can matter:

1. Documents with equal shingle sets are one node (a 128-bit fingerprint), so copies cost nothing more.
2. Two sets with similarity t or more share one of their first n - ceil(t * n) + 1 shingles in any
   common order.  Frequent shingles go last in that order, so a passage in many documents generates no
   candidates.  Shingles are called frequent by the counts of those that repeat inside blocks of the
   scan, over all documents; the list is bounded (`FREQUENT`), and only the amount of work depends on
   it, never the result.
3. Nodes that share such a shingle and have compatible sizes (a factor of t) form candidate groups: they
   are chained over frequent shingles, of which a block of the scan sends one row per size class; over
   the others their overlap in the prefixes is accumulated, and pairs below their bound are discarded.
4. A candidate group is cut into blocks of bounded size; each pair of blocks is a task's work: a dense
   product of its shared columns, accumulating overlaps, skipping blocks whose sizes cannot reach t or
   which are connected already.  Only the edges of a spanning forest leave the task.

Every pair of the rows in step 4 is judged exactly; a linking pair is always in one candidate group.
Hashes of single shingles have 64 bits and are compared between a few documents, fingerprints 128.

Null, empty and blank texts have no shingles and link with nothing; texts of fewer words than a shingle
are one shingle.  Repeated rows (same id) are copies of each other.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .components import components
from .frames import arrow_stage, free_name

SHINGLE = 5
THRESHOLD = 80  # percent
FREQUENT, FREQUENT_FROM = 1 << 20, 2
PAIRED = 64  # nodes per shingle of which pairs are counted
COUNTED = 2_000_000  # shingles of one block of the scan
BLOCK_SHINGLES, BLOCK_NODES = 2_000_000, 4096
TILE = 1024
FILTER_BITS = 22
_CLASS = np.log(100 / THRESHOLD)


def shingle_sets(t: W.Texts, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; A-Z count as a-z."""
    w = W.words(t)
    sums = W.run_sums(W.hash_ranges(t.data, w.start, w.end, fold=True))
    at = W.window_starts(w.first, size)
    hashes = W.run_hash(sums, at, at + size)
    cut = np.searchsorted(at, w.first)
    out = []
    for i, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)):
        if a < b:
            out.append(np.unique(hashes[a:b]))
        else:
            out.append(W.run_hash(sums, w.first[i : i + 1], w.first[i + 1 : i + 2])[: int(w.first[i + 1] > w.first[i])])
    return out


def fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit values per set; 0 for empty sets."""
    cut = np.cumsum([0, *map(len, sets)])
    every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    pair = []
    for salt in (0x51ED270B, 0xA3EC647D):
        sums = np.zeros(len(every) + 1, np.uint64)
        np.cumsum(W.mix(every, salt), out=sums[1:])
        pair.append(sums[cut[1:]] - sums[cut[:-1]])
    return pair[0], pair[1]


def _keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"))


def profile(docs: DataFrame, key: str, text: str, marks: tuple[str, ...] = ()) -> DataFrame:
    """One scan, two kinds of rows: `id, n, f1, f2` of each document, and `token, uses` of shingles that
    several documents of a block of the scan have.  `marks` are long columns that documents keep."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, size, seen = [], 0, set()
        for batch in batches:
            keys, texts, *kept = batch.columns
            for lo, hi, t in W.slices(texts):
                sets = shingle_sets(t)
                f1, f2 = fingerprints(sets)
                none = pa.nulls(hi - lo, pa.int64())
                own = {c: v.slice(lo, hi - lo) for c, v in zip(marks, kept, strict=True)}
                yield {"id": keys.slice(lo, hi - lo), "n": [len(s) for s in sets], "f1": W.signed(f1), "f2": W.signed(f2), "token": none, "uses": none} | own
                for s, f in zip(sets, f1.tolist(), strict=True):
                    if f not in seen:  # copies do not make a shingle frequent
                        seen.add(f)
                        block.append(s)
                        size += len(s)
                if size >= COUNTED:
                    yield from frequent(block)
                    block, size, seen = [], 0, set()
        yield from frequent(block)

    def frequent(block: list[np.ndarray]) -> Iterator[dict]:
        if block:
            tokens, uses = np.unique(np.concatenate(block), return_counts=True)
            tokens, uses = tokens[uses > 1], uses[uses > 1]
            none = pa.nulls(len(tokens), pa.int64())
            yield {"id": none, "n": none, "f1": none, "f2": none, "token": W.signed(tokens), "uses": uses} | dict.fromkeys(marks, none)

    columns = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t"), *marks)
    schema = "id long, n long, f1 long, f2 long, token long, uses long" + "".join(f", `{c}` long" for c in marks)
    return arrow_stage(columns, schema, scan, whole=True)


def frequent_shingles(profiles: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, with their counts: at most `FREQUENT`."""
    counts = profiles.where("token is not null").groupBy("token").agg(F.sum("uses").alias("uses"))
    top = counts.where(F.col("uses") >= FREQUENT_FROM).orderBy(F.desc("uses")).limit(FREQUENT).toArrow()
    tokens = top["token"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top["uses"].to_numpy().astype(np.int64)[order]


def prefix_length(n: int, threshold: int = THRESHOLD) -> int:
    return n - -(-threshold * n // 100) + 1


def prefix(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles in the common order (by frequency, then hash), and which are frequent."""
    keep = prefix_length(len(tokens))
    names, uses = frequent
    if not len(names):
        return tokens[:keep], np.zeros(keep, bool)
    at = np.minimum(np.searchsorted(names, tokens), len(names) - 1)
    rank = np.where(names[at] == tokens, uses[at], 0)
    order = np.argsort(rank, kind="stable")[:keep]
    return tokens[order], rank[order] > 0


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def candidates(docs: DataFrame, key: str, text: str, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Edges `a, b` between first fingerprints that make up the candidate groups.

    Nodes that share a frequent shingle, or one that turns up in more than `PAIRED` nodes, are chained.
    For the other shingles the pairs are counted: a pair with c shared prefix shingles has an overlap of
    at most c plus what lies behind a prefix, and goes on only if that reaches its bound.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most FREQUENT pairs

    def chained(token: np.ndarray, size: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours in sorted rows that share a shingle, in the same or the next size class."""
        level = (np.log(size) / _CLASS).astype(np.int64)
        near = (token[1:] == token[:-1]) & (level[1:] - level[:-1] <= 1) & (node[1:] != node[:-1])
        return node[1:][near], node[:-1][near]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, size, seen = [], 0, set()
        for batch in batches:
            for _, _, t in W.slices(batch.column(1)):
                sets = shingle_sets(t)
                f1, _ = fingerprints(sets)
                for s, f in zip(sets, f1, strict=True):
                    if len(s) and int(f) not in seen:
                        seen.add(int(f))
                        first, hot = prefix(s, shared.value)
                        block.append((first, hot, len(s), f))
                        size += len(first)
                if size >= COUNTED:
                    yield from flush(block)
                    block, size, seen = [], 0, set()
        yield from flush(block)

    def flush(block: list) -> Iterator[dict]:
        if not block:
            return
        lengths = [len(b[0]) for b in block]
        token, hot = (np.concatenate([b[k] for b in block]) for k in (0, 1))
        size = np.repeat(np.array([b[2] for b in block], np.int32), lengths)
        node = np.repeat(np.array([b[3] for b in block], np.uint64), lengths)
        yield {"token": W.signed(token[~hot]), "size": size[~hot], "hot": np.zeros(int((~hot).sum()), bool), "a": W.signed(node[~hot]), "b": pa.nulls(int((~hot).sum()), pa.int64())}
        token, size, node = token[hot], size[hot], node[hot]
        order = np.lexsort((size, token))
        token, size, node = token[order], size[order], node[order]
        a, b = chained(token, size, node)
        none = pa.nulls(len(a), pa.int64())
        yield {"token": none, "size": none, "hot": np.ones(len(a), bool), "a": W.signed(a), "b": W.signed(b)}
        level = (np.log(size) / _CLASS).astype(np.int64)
        first = np.ones(len(token), bool)  # one row per shingle and size class stands for the block's
        first[1:] = (token[1:] != token[:-1]) | (level[1:] != level[:-1])
        yield {"token": W.signed(token[first]), "size": size[first], "hot": np.ones(int(first.sum()), bool), "a": W.signed(node[first]), "b": pa.nulls(int(first.sum()), pa.int64())}

    rows = arrow_stage(_keyed(docs, key, text), "token long, size int, hot boolean, a long, b long", scan, whole=True)
    # edges found in a block have no shingle: they are spread by their ends
    rows = rows.repartition(F.coalesce("token", F.xxhash64("a", "b"))).sortWithinPartitions("token", "size", "a")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held = None  # the last shingle's rows, or its last row once it is chained
        for batch in batches:
            edge = batch.filter(batch.column("b").is_valid())
            if len(edge):
                yield from edges(*_columns(edge, ("a", "b")))
            rest = batch.filter(batch.column("b").is_null())
            if not len(rest):
                continue
            c = _columns(rest, ("token", "size", "hot", "a"))
            if held is not None:
                c = [np.concatenate([x, y]) for x, y in zip(held, c, strict=True)]
            last = int(np.searchsorted(c[0], c[0][-1]))
            yield from judge(*(x[:last] for x in c))
            held = [x[last:] for x in c]
            if len(held[0]) > PAIRED:
                held[2][:] = True  # too many to pair, however many follow
                yield from judge(*held)
                held = [x[-1:] for x in held]
        if held is not None:
            yield from judge(*held)

    def judge(token: np.ndarray, size: np.ndarray, hot: np.ndarray, node: np.ndarray) -> Iterator[dict]:
        if not len(token):
            return
        head = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        count = np.diff(np.append(head, len(token)))
        chain = np.repeat((count > PAIRED) | np.maximum.reduceat(hot, head), count)
        if chain.any():
            yield from edges(*chained(token[chain], size[chain], node[chain]))
        pairs = []
        for step in range(1, int(count[count <= PAIRED].max(initial=1))):  # rows that are `step` apart
            near = (token[step:] == token[:-step]) & ~chain[step:] & (node[step:] != node[:-step])
            near &= 100 * size[:-step].astype(np.int64) >= THRESHOLD * size[step:].astype(np.int64)
            pairs.append(np.stack([node[step:][near], node[:-step][near], size[step:][near], size[:-step][near]], 1))
        if pairs and sum(map(len, pairs)):
            found = np.concatenate(pairs).astype(np.int64)
            swap = found[:, 0] > found[:, 1]
            found[swap] = found[swap][:, [1, 0, 3, 2]]
            found, uses = np.unique(found, axis=0, return_counts=True)
            yield {"a": found[:, 0], "b": found[:, 1], "na": found[:, 2], "nb": found[:, 3], "uses": uses}

    def edges(a: np.ndarray, b: np.ndarray) -> Iterator[dict]:
        if len(a):
            pairs = np.unique(np.stack([a, b], 1), axis=0)
            none = pa.nulls(len(pairs), pa.int64())
            yield {"a": pairs[:, 0], "b": pairs[:, 1], "na": none, "nb": none, "uses": none}

    found = arrow_stage(rows, "a long, b long, na long, nb long, uses long", merge, whole=True)
    found = found.groupBy("a", "b").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("uses").alias("uses"), F.max(F.isnull("uses")).alias("chained"))
    behind = F.ceil(F.greatest("na", "nb") * THRESHOLD / 100) - 1
    bound = F.ceil((F.col("na") + F.col("nb")) * THRESHOLD / (100 + THRESHOLD))
    return found.where(F.col("chained") | (F.col("uses") + behind >= bound)).select("a", "b")


def members(docs: DataFrame, key: str, text: str, groups: DataFrame) -> DataFrame:
    """Shingle sets of the nodes in candidate groups: `f1, f2, tokens`; other nodes may be among them."""
    slot = F.col("node").bitwiseAND((1 << FILTER_BITS) - 1)
    bits = np.zeros(1 << FILTER_BITS, bool)  # of fixed size: it only spares rows that the join would drop
    bits[groups.select(slot.cast("int").alias("s")).distinct().toArrow()["s"].to_numpy()] = True
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(bits))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        wanted = np.unpackbits(shared.value).astype(bool)
        seen = set()
        for batch in batches:
            for _, _, t in W.slices(batch.column(1)):
                sets = shingle_sets(t)
                f1, f2 = fingerprints(sets)
                hit = wanted[(f1 & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]
                take = [i for i in np.flatnonzero(hit).tolist() if len(sets[i]) and (f1[i], f2[i]) not in seen]
                take = list({(f1[i], f2[i]): i for i in take}.values())
                seen.update((f1[i], f2[i]) for i in take)
                if len(seen) > 200_000:
                    seen.clear()
                if take:
                    cut = np.cumsum([0, *(len(sets[i]) for i in take)]).astype(np.int32)
                    values = pa.array(W.signed(np.concatenate([sets[i] for i in take])))
                    yield {"f1": W.signed(f1[take]), "f2": W.signed(f2[take]), "tokens": pa.ListArray.from_arrays(pa.array(cut), values)}

    return arrow_stage(_keyed(docs, key, text), "f1 long, f2 long, tokens array<long>", scan, whole=True)


def forest(sets: list[np.ndarray], threshold: int = THRESHOLD) -> np.ndarray:
    """For each set the first set (by size) that it is connected to by links among these sets."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    if m == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([0, 0 if 100 * both >= threshold * (sizes.sum() - both) else 1])
    order = np.argsort(sizes, kind="stable")
    n = sizes[order]
    row = np.repeat(np.arange(m), n)
    _, column, uses = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True, return_counts=True)
    row, column = row[uses[column] > 1], column[uses[column] > 1]
    begin = np.searchsorted(row, np.arange(m + 1))
    label = np.arange(m)
    for r0 in range(0, m, TILE):
        r1 = min(m, r0 + TILE)
        most = int(np.searchsorted(n * threshold, 100 * n[r1 - 1], "right"))
        own = column[begin[r0] : begin[r1]]
        names = np.unique(own)
        for c0 in range(r0, most, TILE):
            c1 = min(most, c0 + TILE)
            if (label[r0:r1] == label[r0]).all() and (label[c0:c1] == label[r0]).all():
                continue
            overlap = np.zeros((r1 - r0, c1 - c0), np.float32)  # counts stay far below 2**24
            there = column[begin[c0] : begin[c1]]
            for v in range(0, len(names), 4 * TILE):
                part = names[v : v + 4 * TILE]
                overlap += _dense(row[begin[r0] : begin[r1]] - r0, own, r1 - r0, part) @ _dense(row[begin[c0] : begin[c1]] - c0, there, c1 - c0, part).T
            hit = 100 * overlap >= threshold * (n[r0:r1, None] + n[None, c0:c1] - overlap)
            for i in np.flatnonzero(hit.any(1)):
                near = np.unique(np.append(label[c0 + np.flatnonzero(hit[i])], label[r0 + i]))
                if len(near) > 1:
                    label[np.isin(label, near)] = near[0]
    out = np.empty(m, np.int64)
    out[order] = order[label]
    return out


def _dense(row: np.ndarray, column: np.ndarray, rows: int, names: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(names, column), len(names) - 1)
    ok = names[at] == column
    out = np.zeros((rows, len(names)), np.float32)
    out[row[ok], at[ok]] = 1
    return out


def block_links(rows: DataFrame) -> DataFrame:
    """Spanning edges of each block pair; rows of a pair (`grp, i, j, f1, f2, tokens`) come one after the other."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        key, held = None, {}
        out: list[tuple] = []
        for batch in batches:
            grp, i, j, f1, f2 = (batch.column(c).to_pylist() for c in ("grp", "i", "j", "f1", "f2"))
            tokens = batch.column("tokens")
            cut = tokens.offsets.to_numpy()
            values = tokens.values.to_numpy()
            for r in range(len(batch)):
                if (grp[r], i[r], j[r]) != key:
                    finish(key, held, out)
                    key, held = (grp[r], i[r], j[r]), {}
                held[f1[r], f2[r]] = values[cut[r] : cut[r + 1]].copy()
            if out:
                yield columns(out)
                out = []
        finish(key, held, out)
        if out:
            yield columns(out)

    def finish(key, held: dict, out: list) -> None:
        if len(held) > 1:
            names = list(held)
            label = forest(list(held.values()))
            out += [(key[0], names[k], names[at]) for k, at in enumerate(label.tolist()) if k != at]

    def columns(out: list) -> dict:
        return {
            "grp": [g for g, _, _ in out], "a1": [a[0] for _, a, _ in out], "a2": [a[1] for _, a, _ in out],
            "b1": [b[0] for _, _, b in out], "b2": [b[1] for _, _, b in out],
        }

    return arrow_stage(rows, "grp long, a1 long, a2 long, b1 long, b2 long", scan, whole=True)


def _placed(docs: DataFrame, key: str, text: str, marks: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """`id, n, f1, f2` and `marks` of every row, and the `root` of each pair of fingerprints with the least id
    (`least`) and the least row (`first`: id, nulls last, and marks) that has them."""
    profiles = materialize(profile(docs, key, text, marks), "profiles")
    rows = profiles.where("n is not null").select("id", "n", "f1", "f2", *marks)
    least = [F.min("id").alias("least"), F.max("n").alias("n")]
    if marks:
        least.append(F.min(F.struct(F.isnull("id").alias("no_id"), "id", *marks)).alias("first"))
    classes = rows.where("n > 0").groupBy("f1", "f2").agg(*least)
    classes = materialize(classes, "classes")
    edges = candidates(docs, key, text, frequent_shingles(profiles))
    groups = materialize(components(edges), "groups")  # node, root: first fingerprints
    size = classes.join(groups, classes["f1"] == groups["node"]).groupBy("root").agg(F.sum("n").alias("shingles"), F.count("*").alias("nodes"))
    blocks = F.greatest(F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.ceil(F.col("nodes") / BLOCK_NODES)).cast("int")
    groups = materialize(groups.join(size.select("root", blocks.alias("blocks")), "root"), "blocks")
    sets = members(docs, key, text, groups).join(groups, F.col("f1") == F.col("node"))
    own = F.pmod(F.xxhash64("f2"), F.col("blocks")).cast("int")
    sets = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sets = sets.select(F.col("root").alias("grp"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "f1", "f2", "tokens")
    sets = sets.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j")
    links = materialize(block_links(sets), "links")
    links = links.select("grp", F.struct(F.col("a1").alias("f1"), F.col("a2").alias("f2")).alias("a"), F.struct(F.col("b1").alias("f1"), F.col("b2").alias("f2")).alias("b"))
    # a group of one block is a forest of stars already; the others meet across their blocks
    several = groups.where("blocks > 1").select(F.col("root").alias("grp")).distinct()
    roots = links.join(several, "grp", "left_anti").select(F.col("a").alias("node"), F.col("b").alias("root"))
    if several.head(1):
        roots = roots.unionByName(components(links.join(several, "grp", "left_semi").select("a", "b")))
    node = F.struct("f1", "f2")
    placed = classes.withColumn("node", node).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    return rows, materialize(placed.select("f1", "f2", "root", "least", *["first"] * bool(marks)), "placed")


def similar_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`id, n, component` of every row: set size, and the least id reachable by links."""
    rows, placed = _placed(docs, key, text)
    component = placed.groupBy("root").agg(F.min("least").alias("component"))
    placed = placed.join(component, "root").select("f1", "f2", "component")
    found = rows.where("n > 0").join(placed, ["f1", "f2"]).select("id", "n", "component")
    return found.unionByName(rows.where("n = 0").select("id", "n", F.col("id").alias("component")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` of each group of linked texts: the least by id (nulls last), then fingerprints and
    a hash of the row.

    Groups are of texts, so an id that names several may stay several times, and rows without an id are
    kept like others.  Texts without a word link with nothing: each id keeps one, rows without an id all.
    """
    columns = docs.columns
    h1, h2 = marks = free_name(docs, "__h1"), free_name(docs, "__h2")
    # a hash skips nulls, so each column says whether it is null; maps have no hash
    hashed = [x for f in docs.schema.fields if "map<" not in (kind := f.dataType.simpleString()) and "variant" not in kind
              for x in (F.col(f"`{f.name}`"), F.isnull(f"`{f.name}`"))]
    marked = docs.withColumns({h1: F.xxhash64(*hashed), h2: F.xxhash64(F.lit(1), *hashed)})
    rows, placed = _placed(marked, key, text, marks)
    least = placed.groupBy("root").agg(F.min(F.struct("first.no_id", "first.id", "f1", "f2", f"first.{h1}", f"first.{h2}")).alias("r"))
    wordless = rows.where("n = 0 and id is not null").groupBy("id").agg(F.min(F.struct(h1, h2)).alias("r"))
    names = ["__id", "__k1", "__k2"]
    kept = least.select("r.id", f"r.{h1}", f"r.{h2}").toDF(*names).unionByName(wordless.select("id", f"r.{h1}", f"r.{h2}").toDF(*names))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__id")) & (F.col(h1) == F.col("__k1")) & (F.col(h2) == F.col("__k2"))
    one = marked.join(kept, same, "left_semi").dropDuplicates([key, h1, h2]).select(*[f"`{c}`" for c in columns])
    bare = docs.where(F.isnull(f"`{key}`") & ~F.coalesce(F.col(f"`{text}`"), F.lit("")).rlike(r"[^\x20\x09-\x0D]"))
    return one.unionByName(bare)
