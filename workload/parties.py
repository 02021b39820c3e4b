"""Entity resolution over customers, suppliers, nations, parts and regions as five party sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.operators import parties, remap
from tablewright.operators.joins import attach
from tablewright.operators.keys import keep_first, repeats
from tablewright.operators.project import union_aligned
from tablewright.session import materialize

from .registry import STAMP, Tables, columns, query, select_list, shifted

# --- shared dirt ----------------------------------------------------------------------------------
# A third of all customers carry one name, in different spellings; others repeat less often; some
# have only a tax number, some nothing at all.
_EARLY, _LATE = "TIMESTAMP '2024-01-01 00:00:00'", "TIMESTAMP '2024-02-01 00:00:00'"
SOURCES = {
    "clientes": (
        "customer",
        {
            "id": "CASE WHEN c_custkey % 997 <> 5 THEN c_custkey END",
            # sheets are read from the last customer to the first: their order is not that of the ids
            "ordinal": "900000000 - c_custkey",
            "apellido": "'sin uso'",
            "nombre": """CASE WHEN c_custkey % 11 = 0 OR c_custkey % 13 = 0 THEN NULL
                WHEN c_custkey % 3 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN ' Casa  Central' ELSE 'CASA CENTRAL ' END
                ELSE 'Cliente ' || cast(c_custkey % 500 as string) END""",
            "rut": """CASE WHEN c_custkey % 13 = 0 THEN NULL
                WHEN c_custkey % 11 = 0 THEN 'r-' || cast(c_custkey % 50 as string)
                WHEN c_custkey % 2 = 0 THEN 'c-' || cast(c_custkey as string) END""",
            "alias": "CASE WHEN c_custkey % 4 = 3 THEN c_mktsegment END",
            "telefono": "CASE WHEN c_custkey % 5 = 4 THEN '+56 ' || cast(c_custkey as string) END",
            "direccion": "CASE WHEN c_custkey % 6 = 5 THEN 'calle ' || cast(c_nationkey as string) END",
            "is_active": "c_custkey % 7 = 0",
            "created_at": f"CASE WHEN c_custkey % 2 = 0 THEN {_EARLY} ELSE {_LATE} END",
            "tipo_id": "cast(c_nationkey as bigint)",
            "vendedor_id": "CASE WHEN c_custkey % 9 <> 0 THEN cast(c_custkey % 25 as bigint) END",
            "factura": "CASE WHEN c_custkey % 3 = 1 THEN true WHEN c_custkey % 3 = 2 THEN false END",
        },
    ),
    "proveedores": (
        "supplier",
        {
            "id": "s_suppkey",
            "ordinal": "s_suppkey",
            "nombre": "CASE WHEN s_suppkey % 4 = 0 THEN 'casa central' ELSE 'cliente ' || cast(s_suppkey % 600 as string) END",
            "rut": "'p-' || cast(s_suppkey as string)",
            "is_active": "CASE WHEN s_suppkey % 2 = 0 THEN NULL ELSE s_suppkey % 3 = 0 END",
            "created_at": _LATE,
            "updated_at": f"CASE WHEN s_suppkey % 3 = 0 THEN {_LATE} ELSE {_EARLY} END",
        },
    ),
    "vendedores": ("nation", {"id": "cast(n_nationkey as bigint)", "ordinal": "cast(n_nationkey as bigint)", "nombre": "n_name"}),
    "trabajadores": (
        "part",
        {
            "id": "p_partkey",
            "ordinal": "p_partkey",
            "nombre": "split_part(p_name, ' ', 1)",
            "apellido": "CASE WHEN p_partkey % 2 = 0 THEN split_part(p_name, ' ', 2) || ' ' END",
            "cargo": "p_type",
            "is_active": "p_size > 25",
        },
    ),
    "destinatarios": (
        "region",
        {
            "id": "cast(r_regionkey as bigint)",
            "ordinal": "cast(r_regionkey as bigint)",
            "nombre": "r_name",
            "cliente_id": "cast(r_regionkey * 3 as bigint)",
            "is_active": "CASE WHEN r_regionkey % 2 = 0 THEN false END",
        },
    ),
}


def source_tables(t: Tables) -> dict[str, DataFrame]:
    out = {}
    for source, (table, exprs) in SOURCES.items():
        out[source] = t(table).selectExpr(*columns(exprs)).withColumnRenamed("ordinal", "_ord")
    return out


def _duck_source(source: str, rank: int) -> str:
    table, exprs = SOURCES[source]
    name = "nombre"
    if source == "trabajadores":  # last names elsewhere say nothing
        name = "nullif(trim(coalesce(trim(nombre), '') || ' ' || coalesce(trim(apellido), '')), '')"

    def opt(c: str, default: str) -> str:
        return c if c in exprs else default

    return f"""SELECT '{source}' AS source, id AS source_id, {rank} * 1000000000000 + ordinal AS ord, {name} AS nombre,
        {opt('rut', 'CAST(NULL AS VARCHAR)')} AS rut, {opt('alias', 'CAST(NULL AS VARCHAR)')} AS alias,
        {opt('telefono', 'CAST(NULL AS VARCHAR)')} AS telefono, {opt('direccion', 'CAST(NULL AS VARCHAR)')} AS direccion,
        {opt('is_active', 'true')} AS is_active, {opt('created_at', 'CAST(NULL AS TIMESTAMP)')} AS created_at,
        {opt('updated_at', 'CAST(NULL AS TIMESTAMP)')} AS updated_at
        FROM (SELECT {select_list(exprs)} FROM {table})"""


_NORM = "nullif(trim(regexp_replace(lower({0}), '\\s+', ' ', 'g')), '')"
PARTY_CTES = f"""staged AS ({' UNION ALL '.join(_duck_source(s, i) for i, s in enumerate(SOURCES))}),
    keyed AS (SELECT *, coalesce('name:' || {_NORM.format('nombre')}, 'rut:' || {_NORM.format('rut')},
                                 'missing_name:' || source || ':' || source_id) AS dedupe_key FROM staged),
    golden AS (SELECT dedupe_key,
        arg_min(rut, ord) FILTER (rut IS NOT NULL) AS rut, arg_min(nombre, ord) FILTER (nombre IS NOT NULL) AS nombre,
        arg_min(alias, ord) FILTER (alias IS NOT NULL) AS alias,
        arg_min(telefono, ord) FILTER (telefono IS NOT NULL) AS telefono,
        arg_min(direccion, ord) FILTER (direccion IS NOT NULL) AS direccion,
        bool_or(is_active) AS is_active, min(created_at) AS created_at, max(updated_at) AS updated_at,
        count(source_id) AS source_rows FROM keyed GROUP BY dedupe_key),
    parties AS (SELECT row_number() OVER (ORDER BY dedupe_key NULLS LAST) AS id, * FROM golden),
    cross_walk AS (SELECT DISTINCT source, source_id, id AS party_id FROM keyed JOIN parties USING (dedupe_key)
                   WHERE source_id IS NOT NULL)"""


@query(
    "union_sources",
    f"""WITH {PARTY_CTES} SELECT source, source_id, nombre, rut, is_active, {shifted('created_at')} AS created_at,
        dedupe_key FROM keyed""",
)
def union_sources(t: Tables) -> DataFrame:
    staged = parties.stage_parties(source_tables(t))
    return staged.select(
        "source", "source_id", "nombre", "rut", "is_active", F.date_format("created_at", STAMP).alias("created_at"), "dedupe_key"
    )


@query(
    "party_golden",
    f"""WITH {PARTY_CTES} SELECT id, rut, nombre, alias, telefono, direccion, is_active,
        {shifted('created_at')} AS created_at, {shifted('updated_at')} AS updated_at, source_rows FROM parties""",
)
def party_golden(t: Tables) -> DataFrame:
    golden = parties.number_parties(parties.golden_records(parties.stage_parties(source_tables(t))))
    return golden.select(
        "id",
        *parties.ATTRIBUTES,
        "is_active",
        F.date_format("created_at", STAMP).alias("created_at"),
        F.date_format("updated_at", STAMP).alias("updated_at"),
        "source_rows",
    )


def _crosswalk(t: Tables) -> DataFrame:
    staged = parties.stage_parties(source_tables(t))
    numbered = parties.number_parties(parties.golden_records(staged))
    return parties.crosswalk(staged, numbered)


@query("party_crosswalk", f"WITH {PARTY_CTES} SELECT source, source_id, party_id FROM cross_walk")
def party_crosswalk(t: Tables) -> DataFrame:
    return parties.unique_crosswalk(_crosswalk(t))


_STRINGS_SQL = f"""{PARTY_CTES},
    placed AS (SELECT party_id, source || ':' || source_id AS key,
               row_number() OVER (PARTITION BY party_id ORDER BY source || ':' || source_id) - 1 AS place,
               count(*) OVER (PARTITION BY party_id) AS n FROM cross_walk),
    strings AS (SELECT party_id, place // 1000 AS part, CAST(ceil(n / 1000) AS BIGINT) AS parts,
                string_agg(key, '|' ORDER BY key) AS id_old FROM placed GROUP BY ALL)"""


@query("party_source_keys", f"WITH {_STRINGS_SQL} SELECT party_id, part, parts, id_old FROM strings")
def party_source_keys(t: Tables) -> DataFrame:
    return parties.source_key_strings(_crosswalk(t))


@query(
    "parse_source_keys",
    f"""WITH {_STRINGS_SQL}, tokens AS (SELECT party_id, unnest(string_split(id_old, '|')) AS token FROM strings)
        SELECT split_part(token, ':', 1) AS source, CAST(split_part(token, ':', 2) AS BIGINT) AS source_id, party_id
        FROM tokens""",
)
def parse_source_keys(t: Tables) -> DataFrame:
    strings = parties.source_key_strings(_crosswalk(t))
    return parties.parse_source_keys(strings)


_ROLES_SQL = f"""WITH {PARTY_CTES},
    customer_role AS (SELECT p.party_id AS tercero_id, c.tipo_id, v.party_id AS linked_id,
        coalesce(c.factura, false) AS flag, CAST(NULL AS VARCHAR) AS cargo, 'terceros_cliente' AS role
        FROM (SELECT {select_list(SOURCES['clientes'][1])} FROM customer) c
        JOIN cross_walk p ON p.source = 'clientes' AND p.source_id = c.id
        LEFT JOIN cross_walk v ON v.source = 'vendedores' AND v.source_id = c.vendedor_id
        QUALIFY row_number() OVER (PARTITION BY p.party_id ORDER BY c.ordinal) = 1),
    supplier_role AS (SELECT DISTINCT party_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN),
        CAST(NULL AS VARCHAR), 'terceros_proveedor' FROM cross_walk WHERE source = 'proveedores'),
    seller_role AS (SELECT DISTINCT party_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), false,
        CAST(NULL AS VARCHAR), 'terceros_vendedor' FROM cross_walk WHERE source = 'vendedores'),
    employee_role AS (SELECT p.party_id, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN), p_type,
        'terceros_trabajador' FROM part JOIN cross_walk p ON p.source = 'trabajadores' AND p.source_id = p_partkey
        QUALIFY row_number() OVER (PARTITION BY p.party_id ORDER BY p_partkey) = 1),
    recipient_role AS (SELECT p.party_id, CAST(NULL AS BIGINT), c.party_id, r_regionkey % 2 <> 0, CAST(NULL AS VARCHAR),
        'terceros_destinatario' FROM region JOIN cross_walk p ON p.source = 'destinatarios' AND p.source_id = r_regionkey
        LEFT JOIN cross_walk c ON c.source = 'clientes' AND c.source_id = r_regionkey * 3
        QUALIFY row_number() OVER (PARTITION BY p.party_id ORDER BY r_regionkey) = 1)
    SELECT * FROM customer_role UNION ALL SELECT * FROM supplier_role UNION ALL SELECT * FROM seller_role
    UNION ALL SELECT * FROM employee_role UNION ALL SELECT * FROM recipient_role"""


@query("party_roles", _ROLES_SQL)
def party_roles(t: Tables) -> DataFrame:
    tables = source_tables(t)
    # the region source flags its rows by parity, NULL counting as active
    crosswalks = parties.Crosswalks(materialize(parties.unique_crosswalk(_crosswalk(t)), "crosswalk"))
    shapes = {
        "terceros_cliente": ("tipo_id", "vendedor_id", "factura", None),
        "terceros_proveedor": (None, None, None, None),
        "terceros_vendedor": (None, None, "is_active", None),
        "terceros_trabajador": (None, None, None, "cargo"),
        "terceros_destinatario": (None, "cliente_id", "is_active", None),
    }
    kinds = ("long", "long", "boolean", "string")
    names = ("tipo_id", "linked_id", "flag", "cargo")
    if_no_column = {"vendedores": F.lit(False)}
    frames = []
    for name, role in parties.ROLES.items():
        source = tables[role.source]
        if role.source in if_no_column:
            source = source.withColumn("is_active", if_no_column[role.source])
        rows = parties.role_table(source, role, crosswalks)
        picked = [
            (F.col(c) if c else F.lit(None)).cast(k).alias(n) for c, k, n in zip(shapes[name], kinds, names)
        ]
        frames.append(rows.select("tercero_id", *picked, F.lit(name).alias("role")))
    return union_aligned(frames)


@query(
    "remap_orders",
    f"""WITH {PARTY_CTES} SELECT o_orderkey, party_id AS cliente_id, o_totalprice FROM orders
        LEFT JOIN cross_walk ON source = 'clientes' AND source_id = o_custkey""",
)
def remap_orders(t: Tables) -> DataFrame:
    cross = materialize(parties.unique_crosswalk(_crosswalk(t)), "crosswalk")
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("cliente_id"), "o_totalprice")
    return remap.remap_table(orders, parties.Crosswalks(cross))


@query(
    "remap_unmapped",
    f"""WITH {PARTY_CTES} SELECT 'cliente_id' AS "column", o_custkey AS old_id, count(*) AS rows FROM orders
        WHERE o_custkey NOT IN (SELECT source_id FROM cross_walk WHERE source = 'clientes') GROUP BY o_custkey""",
)
def remap_unmapped(t: Tables) -> DataFrame:
    orders = t("orders").select("o_orderkey", F.col("o_custkey").alias("cliente_id"))
    return remap.unmapped_ids(orders, parties.unique_crosswalk(_crosswalk(t)))


@query(
    "remap_ambiguity",
    """SELECT source, source_id, count(DISTINCT party_id) AS parties
       FROM (SELECT 'clientes' AS source, o_custkey AS source_id, ascii(o_orderstatus) AS party_id FROM orders)
       GROUP BY source, source_id HAVING count(DISTINCT party_id) > 1""",
)
def remap_ambiguity(t: Tables) -> DataFrame:
    """A crosswalk with clashes: every order claims its customer for the party of its status."""
    claims = t("orders").selectExpr("'clientes' AS source", "o_custkey AS source_id", "ascii(o_orderstatus) AS party_id")
    return parties.ambiguous_keys(claims)


@query(
    "party_duplicate_names",
    """SELECT nullif(trim(lower(p_name)), '') AS name, count(*) AS n, min(p_partkey) AS first_id, max(p_partkey) AS last_id
       FROM part GROUP BY 1 HAVING count(*) > 1 AND nullif(trim(lower(p_name)), '') IS NOT NULL""",
)
def party_duplicate_names(t: Tables) -> DataFrame:
    """Parts taken for parties that were never deduplicated."""
    return parties.duplicate_names(t("part").selectExpr("p_partkey AS id", "p_name || ' ' AS nombre"))


ACTORS = {
    "id": "event_id",
    "trabajador_id": "CASE WHEN event_id % 5 = 0 THEN user_id END",
    "vendedor_id": "CASE WHEN event_id % 5 = 1 THEN user_id END",
    "cliente_id": "CASE WHEN event_id % 5 = 2 OR event_id % 35 = 1 THEN user_id + 1000 END",
    "proveedor_id": "CASE WHEN event_id % 5 = 3 THEN user_id + 2000 END",
}


@query(
    "actor_collapse",
    f"""SELECT id, coalesce(trabajador_id, vendedor_id, cliente_id, proveedor_id) AS actor_id,
          (CASE WHEN trabajador_id IS NULL THEN 0 ELSE 1 END + CASE WHEN vendedor_id IS NULL THEN 0 ELSE 1 END
           + CASE WHEN cliente_id IS NULL THEN 0 ELSE 1 END + CASE WHEN proveedor_id IS NULL THEN 0 ELSE 1 END) > 1
          AS several FROM (SELECT {select_list(ACTORS)} FROM events)""",
)
def actor_collapse(t: Tables) -> DataFrame:
    rows = t("events").selectExpr(*columns(ACTORS))
    several = remap.more_than_one(remap.ACTOR_COLUMNS)
    return remap.collapse_actors(rows.withColumn("several", several)).select("id", "actor_id", "several")


@query(
    "keep_first",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
)
def keep_first_order(t: Tables) -> DataFrame:
    rows = t("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return keep_first(rows, ["o_custkey"], ["o_orderkey"])


@query(
    "seen_before",
    """SELECT event_id, user_id, event_type FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1""",
)
def seen_before(t: Tables) -> DataFrame:
    rows = t("events").select("event_id", "user_id", "event_type")
    return repeats(rows, ["user_id", "event_type"], ["event_id"])


@query(
    "dedupe_attach",
    f"""WITH {PARTY_CTES} SELECT source, source_id, id AS party_id FROM keyed JOIN parties USING (dedupe_key)""",
)
def dedupe_attach(t: Tables) -> DataFrame:
    """Every source row with its party, joined on a key that a third of the rows share."""
    staged = parties.stage_parties(source_tables(t))
    ids = parties.number_parties(parties.golden_records(staged)).select(F.col("id").alias("party_id"), "dedupe_key")
    rows = attach(staged, ids, {"dedupe_key": "dedupe_key"}, take=["party_id"], how="inner")
    return rows.select("source", "source_id", "party_id")
