"""Operators against brute force on small frames, including the branches that only skew reaches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablewright import ConformError
from tablewright.operators import deletes, keys, lookup, parties, project, quality, remap, upsert
from tablewright.operators.joins import Limits, attach, hot_hashes
from tablewright.operators.lookup import Dimensions, Lookup

SKEWED = Limits(broadcast_bytes=-1, hot_share=0.1, hot_rows=10)
NOW = dt.datetime(2024, 1, 2, 3, 4, 5)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    data = [(i, None if i % 7 == 0 else 1 if i % 3 == 0 else i % 50) for i in range(300)]
    left = spark.createDataFrame(data, "id long, k int").repartition(3)
    right = spark.createDataFrame([(j, f"v{j}") for j in range(0, 50, 2)] + [(1, "hot"), (None, "none")], "rk long, v string")
    return data, left, right


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("limits", [Limits(), SKEWED, Limits(broadcast_bytes=-1)], ids=["broadcast", "hot", "shuffled"])
def test_attach_is_the_same_join_on_every_path(skewed, how, limits):
    data, left, right = skewed
    known = {j: f"v{j}" for j in range(0, 50, 2)} | {1: "hot"}
    semi = how in ("left_semi", "left_anti")
    got = rows(attach(left, right, {"k": "rk"}, how=how, take=["v"], limits=limits))
    expected = {
        "left": [(i, k, known.get(k)) for i, k in data],
        "inner": [(i, k, known[k]) for i, k in data if k in known],
        "left_semi": [(i, k) for i, k in data if k in known],
        "left_anti": [(i, k) for i, k in data if k not in known],
    }[how]
    assert got == sorted(expected, key=repr) and (semi or len(got[0]) == 3)


def test_hot_keys_are_found_and_salted(skewed):
    data, left, right = skewed
    h = F.xxhash64(F.col("k").cast("long"))
    assert len(hot_hashes(left, h, SKEWED)) == 2  # key 1 and NULL
    plan = attach(left, right, {"k": "rk"}, take=["v"], limits=SKEWED)._jdf.queryExecution().toString()
    assert "__salt" in plan and "__copy" in plan
    with pytest.raises(ValueError, match="both sides"):
        attach(left, right.withColumnRenamed("v", "id"), {"k": "rk"}, take=["id"])


def test_dense_ids_equal_the_sorted_order(spark):
    names = [f"n{random.Random(5).randint(0, 9)}-{i:04d}" for i in range(500)]
    shuffled = names[:]
    random.Random(1).shuffle(shuffled)
    df = spark.createDataFrame([(n,) for n in shuffled] + [(None,)], "name string").repartition(5)
    got = {r["name"]: r["id"] for r in keys.dense_ids(df, ["name"]).collect()}
    assert got == {n: i for i, n in enumerate([*sorted(names), None], 1)}
    more = keys.next_ids(spark.createDataFrame([(7,), (3,)], "id long"), df.dropna(), ["name"])
    assert sorted(r["id"] for r in more.collect()) == list(range(8, 508))
    empty = df.where("false")
    assert keys.dense_ids(empty, ["name"]).count() == 0
    assert keys.high_water_mark(empty) == 0 and keys.high_water_mark(empty.withColumn("id", F.lit(1))) == 0


def test_keep_first_and_repeats(spark):
    data = [(k, o, f"{k}{o}") for k in "ab" for o in (3, 1, 2)] + [(None, 1, "x"), (None, 2, "y")]
    df = spark.createDataFrame(data, "k string, o int, v string").repartition(4)
    assert rows(keys.keep_first(df, ["k"], ["o"])) == [("a", 1, "a1"), ("b", 1, "b1"), (None, 1, "x")]
    assert {r["v"] for r in keys.repeats(df, ["k"], ["o"]).collect()} == {"a2", "a3", "b2", "b3"}


def test_lookup_reports(spark, text_frame):
    dims = {"d": text_frame("id name", [("1", "Red"), ("2", "blue "), ("3", "RED"), ("4", None), (None, "gone")])}
    df = text_frame("id color", [("1", " BLUE"), ("2", "red"), ("3", "green"), ("4", None), ("5", " "), ("6", "gone")])
    ask = [Lookup("color", "d", "name"), Lookup("absent", "nowhere", "x")]
    sides = Dimensions(dims)
    keyed, applied = lookup.with_keys(df, ask, sides)
    assert len(applied) == 1
    assert lookup.to_ids(df, ask, dims).columns == ["id", "color_id"]
    assert {r["id"]: r["color_id"] for r in keyed.collect()} == {"1": "2", "2": None, "3": None, "4": None, "5": None, "6": None}
    report = lookup.lookup_report(keyed, applied).first()
    assert (report["matched"], report["unmatched"]) == (1, 3)
    found = {(r["rule"], r["key"]) for r in lookup.violations(keyed, applied, sides, "t").collect()}
    assert found == {("unmatched", "red"), ("unmatched", "green"), ("unmatched", "gone"), ("ambiguous", "red")}
    with pytest.raises(ConformError, match="not available"):
        lookup.to_ids(df, [Lookup("color", "zz", "name")], dims)
    with pytest.raises(ConformError, match="no column"):
        lookup.to_ids(df, [Lookup("color", "d", "zz")], dims)
    assert [lk.table for lk in lookup.lookups_for(["a", "b"], "t", ["x", "y"])] == ["t", "t"]
    with pytest.raises(ValueError, match="give one"):
        lookup.lookups_for(["a", "b", "c"], ["t", "u"], "x")


def test_lookups_run_on_a_stream(spark, text_frame, tmp_path):
    """Row-wise operators and lookups use no action on the table itself, so a stream may pass."""
    from tablewright.plans.spec import TablePlan, common_clean, conform

    folder = str(tmp_path / "in")
    text_frame("ID Color Fecha", [("1,0", " RED ", "05/03/2024"), ("x", "none", "foo")]).write.csv(folder, header=True)
    dims = {"d": text_frame("id name", [("7", "red")])}
    stream = spark.readStream.schema("ID string, Color string, Fecha string").option("header", True).csv(folder)
    plan = TablePlan(lookups=(Lookup("color", "d", "name"),), ints=("id", "color_id"), dates=("fecha",))
    out = conform(common_clean(stream), plan, dims)
    q = out.writeStream.format("memory").queryName("conformed").trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = rows(spark.table("conformed").select("id", "color_id", "fecha"))
    assert got == sorted([(1, 7, dt.datetime(2024, 3, 5)), (None, None, None)], key=repr)


PARTY_ROWS = {
    "clientes": [(1, "Ana  Paz", "r1", None), (2, "ana paz", "r2", "t2"), (3, None, "R9", None), (4, None, None, None), (10, "ANA PAZ", None, None)],
    "proveedores": [(1, " Ana Paz ", "r3", "t3"), (2, None, "r9 ", "t9"), (9, "zeta", None, None)],
    "vendedores": [], "trabajadores": [], "destinatarios": [(4, "", "", None)],
}


@pytest.fixture(scope="module")
def sources(spark):
    schema = "id long, nombre string, rut string, telefono string"
    return {n: spark.createDataFrame(r, schema).repartition(2) for n, r in PARTY_ROWS.items()}


def test_parties_by_hand(sources):
    out = parties.build_parties(sources)
    got = {r["id"]: r for r in out["terceros"].collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert [got[i]["nombre"] for i in sorted(got)] == [None, "", "Ana  Paz", "zeta", None]
    ana = got[3]
    keys = {r["party_id"]: r["id_old"] for r in out["terceros_id_old"].collect()}
    assert (ana["rut"], ana["telefono"], keys[3]) == ("r1", "t2", "clientes:1|clientes:10|clientes:2|proveedores:1")
    assert keys[5] == "clientes:3|proveedores:2" and got[5]["rut"] == "R9"
    assert {keys[1], keys[2]} == {"clientes:4", "destinatarios:4"}
    assert ana["is_active"] is True
    roles = {n: out[n].count() for n in parties.ROLES}
    assert roles == {
        "terceros_cliente": 3, "terceros_proveedor": 3, "terceros_vendedor": 0, "terceros_trabajador": 0, "terceros_destinatario": 1,
    }
    assert out["terceros_destinatario"].first()["is_active"] is True


def test_parties_do_not_depend_on_partitioning(sources):
    one = parties.build_parties({n: d.coalesce(1) for n, d in sources.items()}, with_id_old=False)
    many = parties.build_parties({n: d.orderBy(F.desc("id")).repartition(7) for n, d in sources.items()}, limits=SKEWED, with_id_old=False)
    for name in ("terceros", "terceros_crosswalk", "terceros_cliente", "terceros_proveedor"):
        assert rows(one[name]) == rows(many[name])


def test_source_keys_in_bounded_rows(spark):
    cross = spark.createDataFrame([("c", i, 1) for i in range(25)] + [("p", 3, 2)], "source string, source_id long, party_id long")
    strings = parties.source_key_strings(cross, keys_per_row=10, limits=SKEWED)
    parts = {(r["party_id"], r["part"]): (r["parts"], r["id_old"]) for r in strings.collect()}
    assert sorted(parts) == [(1, 0), (1, 1), (1, 2), (2, 0)] and parts[(2, 0)] == (1, "p:3")
    whole = "|".join(parts[(1, i)][1] for i in range(3))
    assert whole == "|".join(sorted(f"c:{i}" for i in range(25)))
    assert rows(parties.parse_source_keys(strings)) == rows(cross.select("source", "source_id", "party_id"))
    odd = spark.createDataFrame([(1, "c:1|c:x|:|d"), (2, None)], "party_id long, id_old string")
    assert rows(parties.parse_source_keys(odd)) == [("c", 1, 1)]
    with pytest.raises(ConformError, match="source:id"):
        parties.check_source_keys(spark.createDataFrame([("abc",)], "id_old string"))
    parties.check_source_keys(odd)


def test_ambiguous_source_ids_fail(spark, sources):
    twice = dict(sources)
    twice["clientes"] = spark.createDataFrame([(1, "a", None, None), (1, "b", None, None)], "id long, nombre string, rut string, telefono string")
    with pytest.raises(ConformError, match="several parties"):
        parties.build_parties(twice)


def test_remap(spark):
    cross = spark.createDataFrame([("clientes", 5, 50), ("vendedores", 5, 51)], "source string, source_id long, party_id long")
    df = spark.createDataFrame([("1", "5", 5), ("2", None, None), ("3", "6", 5)], "id string, cliente_id string, vendedor_id long")
    walks = parties.Crosswalks(cross)
    assert rows(remap.remap_table(df, walks)) == [("1", 50, 51), ("2", None, None), ("3", None, 51)]
    with pytest.raises(ConformError, match="cliente_id: 1 ids have no party"):
        remap.remap_table(df, walks, strict=True)
    with pytest.raises(ConformError, match="no party comes from 'proveedores'"):
        remap.remap_table(df.withColumn("proveedor_id", F.lit(None).cast("long")), walks, strict=True)
    assert rows(remap.unmapped_ids(df, cross)) == [("cliente_id", 6, 1)]
    actors = spark.createDataFrame([(1, 7, None), (2, None, "8"), (3, 7, "8"), (4, None, None)], "id long, trabajador_id long, cliente_id string")
    assert rows(remap.collapse_actors(actors)) == [(1, 7), (2, 8), (3, 7), (4, None)]
    assert [r["key"] for r in remap.actor_violations(actors, "egresos").collect()] == ["3"]
    with pytest.raises(ConformError, match="one_actor"):
        remap.collapse_actors(actors, strict=True)


def test_deletes_reach_grandchildren(spark):
    fk = deletes.ForeignKey
    tables = {
        "c": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id long, b_id long"),
        "b": spark.createDataFrame([(1, 100), (2, 101), (3, 100)], "id long, a_id long"),
        "a": spark.createDataFrame([(100,), (101,)], "id long"),
        "n": spark.createDataFrame([(7, 100), (8, 101)], "id long, a_id long"),
        "r": spark.createDataFrame([(70, 3), (71, 2)], "id long, b_id long"),
    }
    keys_ = [
        fk("c", "b_id", "b", on_delete=deletes.CASCADE), fk("b", "a_id", "a", on_delete=deletes.CASCADE),
        fk("n", "a_id", "a", on_delete=deletes.SET_NULL), fk("r", "b_id", "b", on_delete=deletes.RESTRICT),
    ]
    gone = spark.createDataFrame([(100,)], "id long")
    left, blocked = deletes.propagate(tables, keys_, {"a": gone})
    assert rows(left["a"]) == [(101,)] and rows(left["b"]) == [(2, 101)]
    assert rows(left["c"]) == [(11, 2), (12, None)] and rows(left["n"]) == [(7, None), (8, 101)]
    assert [(r["table"], r["column"], r["key"]) for r in blocked.collect()] == [("r", "b_id", "3")]
    cycle = {**tables, "a": tables["a"].withColumn("c_id", tables["a"]["id"] - 89)}  # 100 refers to 11, 101 to 12
    left, _ = deletes.propagate(cycle, [*keys_, fk("a", "c_id", "c", on_delete=deletes.CASCADE)], {"c": spark.createDataFrame([(12,)], "id long")})
    # 12 takes 101, that 2, that 11, that 100, and so on round the cycle
    assert rows(left["a"]) == rows(left["b"]) == rows(left["c"]) == [] and rows(left["n"]) == [(7, None), (8, None)]


def test_quality_rules(spark):
    df = spark.createDataFrame([(1, -1.0, "I"), (2, None, None), (2, 3.0, "X"), (None, 0.0, "D")], "id long, kg double, action string")
    found = quality.check(df, "t", {"kg_amount": ("kg", "kg >= 0"), "kg_real": ("kg", F.col("kg") > 0)}, "id")
    assert {(r["rule"], r["key"]) for r in found.collect()} == {("kg_amount", "1"), ("kg_real", "1"), ("kg_real", None)}
    assert [r["value"] for r in quality.domain(df, "t", "action", ["I", "U", "D"], "id").collect()] == ["X"]
    assert [(r["key"], r["value"]) for r in quality.unique(df, "t", ["id"]).collect()] == [("2", "2")]
    assert {(r["key"], r["message"]) for r in quality.primary_key(df, "t", ["id"]).collect()} == {
        ("2", "key occurs more than once"), (None, "key is null"),
    }
    parent = spark.createDataFrame([(1,)], "id long")
    bad = quality.foreign_key(df, "t", "id", parent, "p")
    assert [(r["key"], r["value"]) for r in bad.collect()] == [("2", "2")]
    with pytest.raises(ConformError, match="t.id foreign_key: 1"):
        quality.fail_on(bad)
    quality.fail_on(bad.where("false"))


def test_upsert_and_inserts(spark):
    schema = "id long, v string, updated_at timestamp"
    old = dt.datetime(2020, 1, 1)
    target = spark.createDataFrame([(1, "a", None), (2, "b", old), (3, "c", old), (4, None, None)], schema)
    updates = spark.createDataFrame([(2, "b"), (3, "z"), (4, None), (9, "new")], "id long, v string")
    got = rows(upsert.upsert(target, updates, ["id"], NOW))
    assert got == sorted([(1, "a", None), (2, "b", old), (3, "z", NOW), (4, None, None), (9, "new", None)], key=repr)
    batch = spark.createDataFrame([(1, "a"), (5, "x"), (5, "y"), (None, "n"), (None, "m")], "id long, v string")
    assert rows(upsert.insert_if_absent(target, batch, ["id"], ["v"])) == sorted([(5, "x"), (None, "n"), (None, "m")], key=repr)
    assert upsert.seed(target, spark.createDataFrame([(1, "q"), (8, "s")], "id long, v string")).count() == 5


def test_projections(spark, text_frame):
    df = text_frame(["a", "Unnamed: 0", "b", "c"], [("x", "u", " ", None), (None, "u", "", None)])
    assert project.drop_empty_columns(df).columns == ["a"]
    assert project.drop_empty_columns(df, unnamed=False, all_blank=False).columns == ["a", "Unnamed: 0", "b"]
    assert project.drop_empty_columns(df, all_null=False, all_blank=False).columns == ["a", "b", "c"]
    assert project.drop_empty_columns(text_frame("a b")).columns == []
    old = df.withColumn("created_at", F.lit("old"))
    assert project.audited(old, {"created_at": NOW}).first()["created_at"] == "old"
    assert project.audited(old, {"created_at": NOW}, overwrite=True).first()["created_at"] == NOW
    row = project.audited(df, {**dict.fromkeys(project.AUDIT_COLUMNS), "deleted_by_user_id": F.lit("3")}).first()
    assert row["deleted_by_user_id"] == 3 and row["updated_at"] is None and row["created_at"] is not None
    assert project.audited(df).columns == [*df.columns, *project.AUDIT_COLUMNS]
    assert project.audited(df, {"deleted_at": None}).first()["deleted_at"] is None
    with pytest.raises(ValueError, match="no audit columns"):
        project.audited(df, {"other": 1})
    assert {r["column"]: (r["non_null"], r["nulls"]) for r in project.profile(df).collect()}["a"] == (1, 1)
    assert project.dtypes_text(df).splitlines()[0] == "a: string"
    assert project.column_difference(df, ["a", "z"]) == (["z"], ["Unnamed: 0", "b", "c"])
    assert project.union_aligned([text_frame("a b", [("1", "2")]), text_frame("b c", [("3", "4")])]).count() == 2
    numbers = spark.createDataFrame([(float("nan"), 1)], "x double, y int")
    assert tuple(project.nan_to_null(numbers).first()) == (None, 1)


def test_last_names_count_for_people_only(spark):
    row = [(1, "Ana", "Paz")]
    tables = {s: spark.createDataFrame(row, "id long, nombre string, apellido string") for s in parties.SOURCES}
    keys = {r["source"]: r["dedupe_key"] for r in parties.stage_parties(tables).collect()}
    assert keys == {s: "name:ana paz" if s == "trabajadores" else "name:ana" for s in parties.SOURCES}


def test_golden_record_of_tied_rows(spark):
    rows_ = [(i, "x", f"r{i % 3}", 5) for i in (4, 2, 9, 2)]
    tables = {s: spark.createDataFrame(rows_ if s == "clientes" else [], "id long, nombre string, rut string, _ord long") for s in parties.SOURCES}
    got = [parties.golden_records(parties.stage_parties({**tables, "clientes": tables["clientes"].repartition(n)})).first() for n in (1, 3)]
    assert got[0]["rut"] == got[1]["rut"] == "r2"


def test_deletes_within_one_table(spark):
    t = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], "id long, up long")
    gone = spark.createDataFrame([(1,)], "id long")
    left, blocked = deletes.propagate({"t": t}, [deletes.ForeignKey("t", "up", "t", on_delete=deletes.CASCADE)], {"t": gone})
    assert rows(left["t"]) == [(5, None), (6, 5)] and blocked is None
    left, _ = deletes.propagate({"t": t}, [deletes.ForeignKey("t", "up", "t", on_delete=deletes.SET_NULL)], {"t": gone})
    assert (2, None) in rows(left["t"])
    _, blocked = deletes.propagate({"t": t}, [deletes.ForeignKey("t", "up", "t")], {"t": gone})
    assert [(r["column"], r["key"]) for r in blocked.collect()] == [("up", "1")]


def test_foreign_keys_of_one_child(spark):
    child = spark.createDataFrame([(1, "7", 1.0), (2, "x", 2.5), (None, None, None), (9, "7", 9.0)], "a long, b string, c double")
    parent = spark.createDataFrame([(1,), (2,), (7,)], "id long")
    found = quality.foreign_keys(child, "t", {"a": (parent, "p", "id"), "b": (parent, "p", "id"), "c": (parent, "p", "id")})
    assert sorted((r["column"], r["key"], r["value"]) for r in found.collect()) == [("a", "9", "1"), ("b", "x", "1"), ("c", "2.5", "1"), ("c", "9", "1")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 4  # the child once, a parent per key


def test_large_lookup_on_a_stream(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,color\n1,red\n2,\n3,blue\n")
    stream = spark.readStream.schema("id string, color string").option("header", True).csv(str(tmp_path))
    known = spark.createDataFrame([("red", 7)], "name string, code int")
    out = attach(stream, known, {"color": "name"}, take=["code"], small=False)
    q = out.writeStream.format("memory").queryName("large_lookup").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert rows(spark.table("large_lookup").select("id", "code")) == sorted([("1", 7), ("2", None), ("3", None)], key=repr)


def test_rows_without_a_key_are_spread(spark):
    left = spark.range(200).selectExpr("id", "CASE WHEN id < 20 THEN id END AS k")
    right = spark.range(5).selectExpr("id AS r", "id * 10 AS v")
    out = attach(left, right, {"k": "r"}, take=["v"], limits=Limits(broadcast_bytes=0))
    assert out.count() == 200 and out.where("v is not null").count() == 5
    assert "pmod" in out._jdf.queryExecution().optimizedPlan().toString()
