"""Loads that happen whole or not at all, and the marks they leave."""

import os
import threading
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewright import ConformError
from tablewright.operators import quality
from tablewright.operators.key_rules import PRIMARY, Key, key_violations
from tablewright.sources import staged
from tablewright.sources.sinks import Target
from tablewright.sources.staged import forget, load_whole, next_id, reserve, save_marks

ITEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.IntegerType())])
TARGETS = [
    Target("a", ITEM, required=("id",)),
    Target("b", ITEM, source="b_sheet"),
    Target("c", T.StructType([T.StructField("code", T.StringType())]), load=False),
]


@pytest.fixture
def place(spark, tmp_path):
    tag = uuid.uuid4().hex[:10]
    areas = {"core": f"whole_{tag}"}
    yield str(tmp_path / "root"), areas
    spark.sql(f"DROP DATABASE IF EXISTS whole_{tag} CASCADE")


def frame(spark, *rows, columns="id long, v string"):
    return spark.createDataFrame(list(rows), columns)


def held(spark, areas, name):
    return sorted(tuple(r) for r in spark.table(f"{areas['core']}.{name}").collect())


def versions(root, areas, name):
    folder = os.path.join(root, areas["core"], name)
    return sorted(os.listdir(folder)) if os.path.isdir(folder) else []


def test_a_load_replaces_all_tables(spark, place):
    root, areas = place
    first = load_whole(spark, {"a": frame(spark, (1, "5"), (7, "x")), "b_sheet": frame(spark, (3, "1"))}, TARGETS, areas, root)
    assert held(spark, areas, "a") == [(1, 5), (7, None)] and held(spark, areas, "b") == [(3, 1)] and held(spark, areas, "c") == []
    assert first.rows_by_table == {"core.a": 2, "core.b": 1} and first.lost_values == {"core.a.v": 1}
    assert first.next_ids == {"core.a": 8, "core.b": 4} and any("do not fit" in w for w in first.warnings)
    second = load_whole(spark, {"a": frame(spark, (2, "6")), "core.b": frame(spark, (9, "9"))}, TARGETS, areas, root)
    assert held(spark, areas, "a") == [(2, 6)] and held(spark, areas, "b") == [(9, 9)]
    assert second.next_ids == {"core.a": 3, "core.b": 10} and second.warnings == ["no frame 'b_sheet' for table 'b'"]
    assert forget(spark, TARGETS, areas, root) == 3
    assert versions(root, areas, "a") == [second.version] and held(spark, areas, "a") == [(2, 6)]


@pytest.mark.parametrize("how", ["strict", "columns", "rules", "catalog"])
def test_a_failed_load_leaves_everything(spark, place, how, monkeypatch):
    root, areas = place
    good = {"a": frame(spark, (1, "5")), "b_sheet": frame(spark, (3, "1"))}
    done = load_whole(spark, good, TARGETS, areas, root)
    bad, options = {"a": frame(spark, (2, "6")), "b_sheet": frame(spark, (4, "2"), (4, "3"))}, {}
    if how == "strict":
        bad["b_sheet"], options = frame(spark, (4, "no number")), {"strict": True}
    elif how == "columns":
        bad["a"] = frame(spark, ("x",), columns="v string")
    elif how == "rules":
        options["validate"] = lambda tables: key_violations(tables["b"], "b", [Key(("id",), PRIMARY)])
    else:
        real, calls = staged._point, []

        def point(*args):
            calls.append(args)
            if len(calls) == 2:
                raise RuntimeError("catalog is gone")
            real(*args)

        monkeypatch.setattr(staged, "_point", point)
    with pytest.raises(Exception, match="no number|required|violations|catalog is gone"):
        load_whole(spark, bad, TARGETS, areas, root, **options)
    assert held(spark, areas, "a") == [(1, 5)] and held(spark, areas, "b") == [(3, 1)]
    for name in "abc":
        assert versions(root, areas, name) == [done.version]


def test_a_failed_first_load_leaves_no_tables(spark, place):
    root, areas = place
    with pytest.raises(ConformError):
        load_whole(spark, {"a": frame(spark, (1, "5")), "b_sheet": frame(spark, (3, "1"))}, TARGETS, areas, root, drop_extra=False,
                   validate=lambda tables: quality.unique(tables["a"].union(tables["a"]), "a", ["id"]))
    assert not spark.catalog.databaseExists(areas["core"]) or not spark.catalog.listTables(areas["core"])
    assert versions(root, areas, "a") == []


def test_tables_that_others_need(spark, place):
    root, areas = place
    with pytest.raises(ConformError, match="no frame"):
        load_whole(spark, {}, [Target("a", ITEM, must_load=True)], areas, root)


def test_open_readers_keep_their_version(spark, place):
    root, areas = place
    load_whole(spark, {"a": frame(spark, (1, "5")), "b_sheet": frame(spark, (3, "1"))}, TARGETS, areas, root)
    reader = spark.table(f"{areas['core']}.a").withColumn("w", F.col("v") + 1)
    reader.collect()
    load_whole(spark, {"a": frame(spark, (2, "6")), "b_sheet": frame(spark, (3, "1"))}, TARGETS, areas, root)
    assert len(reader.collect()) == 1


def test_id_blocks_never_overlap(spark, tmp_path):
    root = str(tmp_path)
    assert next_id(spark, root, "core.a") == 1
    save_marks(spark, root, {"core.a": 101, "core.b": 1})
    save_marks(spark, root, {"core.a": 50})  # marks only grow
    assert reserve(spark, root, "core.a", 10) == 101 and reserve(spark, root, "core.a", 5) == 111
    assert next_id(spark, root, "core.a") == 116 and reserve(spark, root, "core.b", 3) == 1
    blocks, lock = [], threading.Lock()

    def work(size):
        for _ in range(4):
            first = reserve(spark, root, "core.c", size)
            with lock:
                blocks.append((first, first + size))

    threads = [threading.Thread(target=work, args=(n,)) for n in (1, 7, 30)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    blocks.sort()
    assert len(blocks) == 12 and all(a[1] <= b[0] for a, b in zip(blocks, blocks[1:]))
    with pytest.raises(ValueError):
        reserve(spark, root, "core.a", 0)
