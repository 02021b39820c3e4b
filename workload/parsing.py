"""Text cleaning and parsing.

The dirt is made by SQL expressions that both engines evaluate alike; the checking SQL then cleans
it in its own way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.functions import names, parse, text
from tablewright.operators.joins import attach
from tablewright.plans.spec import apply_steps

from .registry import STAMP, Tables, columns, query, select_list, shifted

# --- shared dirt ----------------------------------------------------------------------------------
DIRTY_NAME = {
    "c_custkey": "c_custkey",
    "name": """CASE c_custkey % 8 WHEN 0 THEN 'N/A' WHEN 1 THEN '  ' || c_name || chr(9)
        WHEN 2 THEN replace(c_name, '#', '  # ' || chr(10)) WHEN 3 THEN ' NA ' WHEN 4 THEN ''
        WHEN 5 THEN 'nUll' WHEN 6 THEN '   ' ELSE c_name END""",
    "segment": "CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '  ' ELSE c_mktsegment END",
}
WORDS = "('', 'nan', 'none', 'null', 'na', 'n/a')"


def duck_clean(c: str) -> str:
    guarded = f"CASE WHEN lower({c}) IN {WORDS} THEN NULL ELSE {c} END"
    return f"nullif(trim(regexp_replace({guarded}, '\\s+', ' ', 'g')), '')"


@query(
    "clean_text",
    f"""SELECT c_custkey, {duck_clean('name')} AS name, {duck_clean('segment')} AS segment
        FROM (SELECT {select_list(DIRTY_NAME)} FROM customer)""",
)
def clean_text(t: Tables) -> DataFrame:
    dirty = t("customer").selectExpr(*columns(DIRTY_NAME))
    return text.clean_all(text.null_words_all(dirty))


DIRTY_SOURCE = {
    "doc_id": "doc_id",
    "source": """CASE doc_id % 7 WHEN 0 THEN 's/i' WHEN 1 THEN ' -- ' WHEN 2 THEN 'Sin Info'
        WHEN 3 THEN 'N/A.' WHEN 4 THEN 'no_aplica' ELSE source END""",
    "lang": "CASE WHEN doc_id % 3 = 0 THEN '..' ELSE ' ' || lang END",
    "text": "CASE WHEN doc_id % 11 = 0 THEN 'NO APLICA' ELSE text END",
}
PLACEHOLDERS = """('', 'nan', 'none', 'null', 'na', 'n/a', '-', '--', '.', '..', '—', 's/i', 'sin info',
    'sin información', 'sin informacion', 'sin dato', 'no aplica', 'no_aplica', 'n/a.')"""


def duck_placeholder(c: str) -> str:
    return f"CASE WHEN lower(trim({c})) IN {PLACEHOLDERS} THEN NULL ELSE {c} END"


@query(
    "placeholders_ext",
    f"""SELECT doc_id, {duck_placeholder('source')} AS source, {duck_placeholder('lang')} AS lang,
               md5({duck_placeholder('text')}) AS text_md5
        FROM (SELECT {select_list(DIRTY_SOURCE)} FROM documents)""",
)
def placeholders_ext(t: Tables) -> DataFrame:
    dirty = t("documents").selectExpr(*columns(DIRTY_SOURCE))
    return text.placeholders_all(dirty).select("doc_id", "source", "lang", F.md5("text").alias("text_md5"))


FANCY_TEXT = "'“' || text || '”' || chr(160) || '—' || lang || '–' || '‘x’'"
PLAIN_TEXT = """'"' || nfc_normalize(text) || '"' || ' ' || '-' || lang || '-' || '''x'''"""


@query(
    "unicode_fold",
    # Only NFC exists here, so this holds as long as the texts have no compatibility characters.
    f"""SELECT doc_id, md5({PLAIN_TEXT}) AS folded_md5, length({PLAIN_TEXT}) AS n FROM documents""",
)
def unicode_fold(t: Tables) -> DataFrame:
    fancy = t("documents").selectExpr("doc_id", f"{FANCY_TEXT} AS text")
    folded = text.unicode_fold_all(fancy)
    return folded.select("doc_id", F.md5("text").alias("folded_md5"), F.length("text").cast("long").alias("n"))


# amount in cents, its thousands, the rest and the cents, all as integers
_CENTS = "cast(round(l_extendedprice * 100) as bigint)"
_THOUSANDS = f"cast(cast(floor({_CENTS} / 100000) as bigint) as string)"
_REST = f"lpad(cast(cast(floor({_CENTS} / 100) as bigint) % 1000 as string), 3, '0')"
_FRACTION = f"lpad(cast({_CENTS} % 100 as string), 2, '0')"
DIRTY_AMOUNT = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "raw": f"""CASE (l_orderkey + l_partkey) % 9
        WHEN 0 THEN {_THOUSANDS} || '.' || {_REST} || ',' || {_FRACTION}
        WHEN 1 THEN {_THOUSANDS} || {_REST} || '.' || {_FRACTION}
        WHEN 2 THEN cast(l_linenumber as string) || ',5 %'
        WHEN 3 THEN '$' || {_REST}
        WHEN 4 THEN ' ' || {_THOUSANDS} || ' ' || {_REST} || ',' || {_FRACTION} || ' '
        WHEN 5 THEN {_REST} || 'd'
        WHEN 6 THEN '-' || {_THOUSANDS} || '.' || {_REST} || '.' || {_REST}
        WHEN 7 THEN ''
        ELSE {_REST} END""",
}
DUCK_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def duck_float(c: str) -> str:
    """CTE-free parse of a number written with comma decimals."""
    digits = f"replace(regexp_replace({c}, '\\s+', '', 'g'), '%', '')"
    plain = f"""CASE WHEN contains({digits}, ',') OR length({digits}) - length(replace({digits}, '.', '')) > 1
        THEN replace(replace({digits}, '.', ''), ',', '.') ELSE {digits} END"""
    value = f"CASE WHEN regexp_matches({plain}, '{DUCK_NUMBER}') THEN TRY_CAST({plain} AS DOUBLE) END"
    return f"(({value}) / CASE WHEN contains({c}, '%') THEN 100.0 ELSE 1.0 END)"


@query(
    "parse_locale_float",
    f"""SELECT l_orderkey, l_linenumber, raw, {duck_float('raw')} AS value
        FROM (SELECT {select_list(DIRTY_AMOUNT)} FROM lineitem)""",
)
def parse_locale_float(t: Tables) -> DataFrame:
    dirty = t("lineitem").selectExpr(*columns(DIRTY_AMOUNT)).withColumn("value", F.col("raw"))
    return parse.parse_floats(dirty, ["value"])


DIRTY_QUANTITY = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "raw": """CASE (l_orderkey + l_partkey) % 11
        WHEN 8 THEN '1.234,' || repeat('0', 500) || '.0'
        WHEN 9 THEN '1,' || repeat('x', 450 + l_linenumber) || '.0'
        WHEN 10 THEN '1.' || chr(10) || lpad(cast(cast(l_quantity as bigint) as string), 3, '0') || chr(10) || ',00'
        WHEN 0 THEN cast(cast(l_quantity as bigint) as string) || ' kg'
        WHEN 1 THEN '(' || cast(cast(l_quantity as bigint) as string) || ')'
        WHEN 2 THEN '1.' || lpad(cast(cast(l_quantity as bigint) as string), 3, '0') || ',00'
        WHEN 3 THEN cast(cast(l_quantity as bigint) as string) || '.0'
        WHEN 4 THEN cast(cast(l_quantity as bigint) as string) || ',5'
        WHEN 5 THEN '-' || cast(cast(l_quantity as bigint) as string)
        WHEN 6 THEN '1.' || cast(cast(l_quantity as bigint) as string) || '.000'
        ELSE 'none' END""",
}


def duck_int_text(c: str) -> str:
    kept = f"regexp_replace({c}, '[^0-9,.\\-]', '', 'g')"
    return f"CASE WHEN contains({kept}, ',') THEN replace(replace({kept}, '.', ''), ',', '.') ELSE {kept} END"


def duck_int(c: str) -> str:
    value = duck_int_text(c)
    number = f"CASE WHEN regexp_matches({value}, '{DUCK_NUMBER}') THEN TRY_CAST({value} AS DOUBLE) END"
    return f"CASE WHEN ({number}) = floor({number}) THEN CAST(({number}) AS BIGINT) END"


@query(
    "parse_int",
    f"""SELECT l_orderkey, l_linenumber, raw, {duck_int('raw')} AS value,
               coalesce(({duck_int_text('raw')}) LIKE '%.5', false) AS fractional
        FROM (SELECT {select_list(DIRTY_QUANTITY)} FROM lineitem)""",
)
def parse_int(t: Tables) -> DataFrame:
    dirty = t("lineitem").selectExpr(*columns(DIRTY_QUANTITY)).withColumn("value", F.col("raw"))
    return parse.parse_ints(dirty, ["value", "absent"]).withColumn("fractional", parse.is_fractional(F.col("raw")))


DIRTY_FLAG = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "raw": """CASE l_returnflag WHEN 'A' THEN CASE l_linenumber % 3 WHEN 0 THEN ' Sí' WHEN 1 THEN 'SI' ELSE '1' END
        WHEN 'N' THEN CASE l_linenumber % 3 WHEN 0 THEN 'No ' WHEN 1 THEN 'f' ELSE '0' END
        ELSE CASE l_linenumber % 3 WHEN 0 THEN 'yes' WHEN 1 THEN '1.0' ELSE '' END END""",
}
DUCK_BOOL = """CASE WHEN lower(trim(raw)) IN ('true', '1', 'si', 'sí', 'y', 't') THEN true
    WHEN lower(trim(raw)) IN ('false', '0', 'no', 'n', 'f') THEN false END"""


@query(
    "parse_bool",
    f"""SELECT l_orderkey, l_linenumber, raw, {DUCK_BOOL} AS value, coalesce({DUCK_BOOL}, true) AS filled
        FROM (SELECT {select_list(DIRTY_FLAG)} FROM lineitem)""",
)
def parse_bool(t: Tables) -> DataFrame:
    dirty = t("lineitem").selectExpr(*columns(DIRTY_FLAG)).withColumn("value", F.col("raw"))
    parsed = parse.parse_bools(dirty, ["value"])
    return parsed.withColumn("filled", parse.bool_or_default(F.col("value"), True))


_D = "lpad(cast(day(o_orderdate) as string), 2, '0')"
_M = "lpad(cast(month(o_orderdate) as string), 2, '0')"
_Y = "cast(year(o_orderdate) as string)"
_MON = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(3 * month(o_orderdate) - 2 as int), 3)"
DIRTY_DATE = {
    "o_orderkey": "o_orderkey",
    "raw": f"""CASE (o_orderkey + o_custkey) % 16 WHEN 0 THEN {_Y} || '-' || {_M} || '-' || {_D}
        WHEN 1 THEN {_D} || '/' || {_M} || '/' || {_Y}
        WHEN 2 THEN cast(day(o_orderdate) as string) || '-' || cast(month(o_orderdate) as string) || '-' || {_Y}
        WHEN 3 THEN {_D} || '.' || {_M} || '.' || {_Y} || ' 10:20'
        WHEN 4 THEN {_Y} || '-' || {_M} || '-' || {_D} || 'T10:20:30'
        WHEN 5 THEN '31/' || {_M} || '/' || {_Y}
        WHEN 6 THEN ' ' || {_D} || '/' || {_M} || '/' || {_Y} || ' 1:02:03 '
        WHEN 7 THEN {_D} || '/' || {_M} || '/' || substr({_Y}, 3, 2)
        WHEN 8 THEN {_Y} || {_M} || {_D}
        WHEN 9 THEN {_D} || '-' || {_MON} || '-' || {_Y}
        WHEN 10 THEN {_Y} || '/' || {_M} || '/' || {_D}
        WHEN 11 THEN {_Y} || '-' || cast(month(o_orderdate) as string) || '-' || cast(day(o_orderdate) as string)
        WHEN 12 THEN {_Y} || '-' || {_M} || '-' || {_D} || 'T10:20:30+02:00'
        WHEN 13 THEN {_M} || '/' || '2' || cast(day(o_orderdate) % 9 as string) || '/' || {_Y}
        WHEN 14 THEN {_D} || ' Foo ' || {_Y}
        ELSE 'pending' END""",
}
DUCK_FORMATS = (
    "%Y-%m-%d", "%Y-%m-%dT%H:%M:%S", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y %H:%M", "%d/%m/%Y %H:%M:%S",
    "%d-%b-%Y", "%Y/%m/%d",
)


def duck_date(c: str) -> str:
    formats = ", ".join(f"try_strptime(trim({c}), '{f}')" for f in DUCK_FORMATS)
    short = f"CASE WHEN regexp_matches(trim({c}), '^[0-9]{{1,2}}/[0-9]+/[0-9]{{2}}$') THEN try_strptime(trim({c}), '%d/%m/%y')"
    compact = f"WHEN regexp_matches({c}, '^[0-9]{{8}}$') THEN try_strptime({c}, '%Y%m%d')"
    zoned = f"WHEN {c} LIKE '%+02:00' THEN try_strptime(left({c}, 19), '%Y-%m-%dT%H:%M:%S') - INTERVAL 2 HOUR"
    # the middle number is no month: the only reading is month first
    swapped = f"""WHEN regexp_matches(trim({c}), '^[0-9]{{2}}/(1[3-9]|[23][0-9])/[0-9]{{4}}$') AND substr(trim({c}), 1, 2) <= '12'
        THEN try_strptime(trim({c}), '%m/%d/%Y')"""
    return f"{short} {compact} {zoned} {swapped} ELSE coalesce({formats}) END"


@query(
    "parse_dates",
    f"""SELECT o_orderkey, raw, {shifted(duck_date('raw'))} AS value
        FROM (SELECT {select_list(DIRTY_DATE)} FROM orders)""",
)
def parse_dates(t: Tables) -> DataFrame:
    dirty = t("orders").selectExpr(*columns(DIRTY_DATE)).withColumn("value", F.col("raw"))
    return parse.parse_dates(dirty, ["value"]).withColumn("value", F.date_format("value", STAMP))


RAW_NAME = {
    "p_partkey": "p_partkey",
    "raw": """CASE p_partkey % 6 WHEN 0 THEN 'DETALLE ' || p_type WHEN 1 THEN 'CAT_' || p_name
        WHEN 2 THEN ' ' || p_brand || ' - (' || p_type || ')' WHEN 3 THEN 'CAT TIPOS CLIENTES'
        WHEN 4 THEN 'Activo' ELSE 'Column ' || cast(p_size as string) END""",
}
DUCK_SAFE = "trim(regexp_replace(lower(trim(raw)), '[^a-z0-9]+', '_', 'g'), '_')"


@query(
    "normalize_names",
    f"""SELECT p_partkey, raw,
          CASE WHEN safe LIKE 'detalle\\_%' ESCAPE '\\' THEN substr(safe, 9) || '_items'
               WHEN safe = 'cat_vehiculos' THEN 'vehiculos'
               WHEN safe = 'cat_tipos_egresos' THEN 'dim_tipos_egreso'
               WHEN safe = 'cat_tipos_clientes' THEN 'dim_tipos_cliente'
               WHEN safe LIKE 'cat\\_%' ESCAPE '\\' THEN 'dim_' || substr(safe, 5) ELSE safe END AS as_table,
          CASE WHEN safe = 'activo' THEN 'is_active' ELSE safe END AS as_column
        FROM (SELECT p_partkey, raw, {DUCK_SAFE} AS safe FROM (SELECT {select_list(RAW_NAME)} FROM part))""",
)
def normalize_names(t: Tables) -> DataFrame:
    raw = t("part").selectExpr(*columns(RAW_NAME))
    return raw.select(
        "p_partkey",
        "raw",
        names.table_name_column(F.col("raw")).alias("as_table"),
        names.column_name_column(F.col("raw")).alias("as_column"),
    )


@query(
    "match_keys",
    """SELECT c_custkey, nullif(lower(trim(label, ' ' || chr(9))), '') AS lookup_key,
              nullif(trim(regexp_replace(lower(label), '\\s+', ' ', 'g')), '') AS party_key,
              'clientes:' || c_custkey AS source_key,
              nullif(trim(coalesce(trim(first_name), '') || ' ' || coalesce(trim(last_name), '')), '') AS full_name,
              split_part('clientes:' || c_custkey, ':', 1) AS before, split_part('clientes:' || c_custkey, ':', 2) AS after
       FROM (SELECT c_custkey, '  ' || replace(c_name, '#', '   # ') || chr(9) AS label,
                    CASE WHEN c_custkey % 3 <> 0 THEN split_part(c_name, '#', 1) END AS first_name,
                    CASE WHEN c_custkey % 2 = 0 THEN split_part(c_name, '#', 2) || ' ' END AS last_name
             FROM customer)""",
)
def match_keys(t: Tables) -> DataFrame:
    labels = t("customer").selectExpr(
        "c_custkey",
        "'  ' || replace(c_name, '#', '   # ') || chr(9) AS label",
        "CASE WHEN c_custkey % 3 <> 0 THEN split_part(c_name, '#', 1) END AS first_name",
        "CASE WHEN c_custkey % 2 = 0 THEN split_part(c_name, '#', 2) || ' ' END AS last_name",
    )
    key = text.source_key("clientes", F.col("c_custkey"))
    before, after = text.split_once(key)
    return labels.select(
        "c_custkey",
        text.match_key(F.col("label")).alias("lookup_key"),
        text.match_key(F.col("label"), collapse=True).alias("party_key"),
        key.alias("source_key"),
        text.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        before.alias("before"),
        after.alias("after"),
    )


@query(
    "user_steps",
    """SELECT o_orderkey, o_custkey, o_totalprice * 2 AS doubled, c_nationkey
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F'""",
)
def user_steps(t: Tables) -> DataFrame:
    def with_context(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        return attach(df, tables["customer"], {"o_custkey": "c_custkey"}, take=["c_nationkey"])

    steps = [
        lambda df: df.where("o_orderstatus = 'F'"),
        lambda df: df.select("o_orderkey", "o_custkey", (F.col("o_totalprice") * 2).alias("doubled")),
        with_context,
    ]
    return apply_steps(t("orders"), steps, {"customer": t("customer")})
