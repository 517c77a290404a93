"""Inputs derived from the given tables by expressions both engines understand.

Each entry: base relation, select expressions, optional filter.  ``{TS}`` stands
for the engine's zone-less timestamp literal.  The Spark side applies them with
``selectExpr``; the SQL counterparts use the same text in a WITH clause, so only
the operator under test differs between the two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_K = "cast(regexp_extract(props, '([0-9]+)', 1) AS bigint)"

# Name lists for the derived person records.
_SURNAMES = "иванов,петров,сидоров,кузнецов,соловьёв,васильев,зайцев,павлов,семёнов,голубев,виноградов,богданов,воробьёв,фёдоров,михайлов,беляев,тарасов,белов,комаров,орлов"
_NAMES = "александр,дмитрий,максим,сергей,андрей,алексей,артём,илья,кирилл,михаил,никита,матвей,роман"
_FATHERS = "иванович,петрович,сергеевич,андреевич,алексеевич,михайлович,романович"

_RAW_SURNAME = f"split_part('{_SURNAMES}', ',', cast(k * 7 % 20 AS int) + 1)"
_PERSON = [
    "unique_id",
    # Every fourth copy lost a letter; every fifth row carries stray case and blanks.
    f"CASE WHEN unique_id % 3 = 2 AND unique_id % 4 = 1 THEN concat(substr({_RAW_SURNAME}, 1, 2), substr({_RAW_SURNAME}, 4)) "
    f"WHEN unique_id % 5 = 0 THEN concat('  ', upper({_RAW_SURNAME}), ' ') ELSE {_RAW_SURNAME} END AS surname",
    f"split_part('{_NAMES}', ',', cast(k * 5 % 13 AS int) + 1) AS name",
    f"CASE WHEN k % 9 = 4 THEN NULL ELSE split_part('{_FATHERS}', ',', cast(k % 7 AS int) + 1) END AS fathername",
    "CASE WHEN k % 31 = 3 THEN 'unknown' WHEN k % 37 = 5 THEN NULL "
    "ELSE concat(cast(1950 + k % 50 AS varchar(4)), '-0', cast(1 + k % 9 AS varchar(4)), '-1', cast(k % 10 AS varchar(4))) END AS birthdate",
    "CASE WHEN k % 2 = 0 THEN 'm' WHEN k % 11 = 3 THEN NULL ELSE 'f' END AS gender",
    "CASE WHEN k % 8 = 1 OR unique_id % 7 = 2 THEN '' WHEN k % 8 = 2 THEN NULL ELSE concat('45', cast(1000000 + k * 37 AS varchar(20))) END AS passport",
    "CASE WHEN k % 6 = 2 THEN NULL ELSE concat('77', cast(5000000 + k * 53 AS varchar(20))) END AS inn",
]

DERIVED: dict[str, tuple[str, list[str], str | None]] = {
    "actions": (
        "events",
        [
            "event_id",
            "user_id",
            "ts",
            "CASE event_type WHEN 'purchase' THEN 'order' WHEN 'signup' THEN 'to_cart' "
            "WHEN 'error' THEN 'favorite' ELSE event_type END AS action_type",
            # Some actions name a product that the table of products does not have.
            f"CASE WHEN {_K} % 13 = 6 THEN NULL WHEN {_K} % 17 = 5 THEN {_K} + 100000000 ELSE {_K} END AS product_id",
            f"CASE WHEN {_K} % 10 = 9 THEN NULL ELSE {_K} % 25 END AS widget_name_id",
        ],
        None,
    ),
    "products": (
        "part",
        [
            "p_partkey AS product_id",
            "CASE WHEN p_size % 11 = 3 THEN NULL WHEN p_size % 11 = 4 THEN 0.0 ELSE p_retailprice END AS price",
            "CASE WHEN p_size % 5 = 0 THEN NULL WHEN p_size % 5 = 1 THEN 0.0 "
            "WHEN p_size % 5 = 2 THEN p_retailprice * 1.125 ELSE p_retailprice * 0.75 END AS discount_price",
            "CASE WHEN p_size = 7 THEN NULL ELSE cast(p_size % 15 AS bigint) END AS category_id",
            "concat('cat_', cast(p_size % 15 AS varchar(8))) AS category_name",
            "CASE WHEN p_brand = 'Brand#1' THEN '' ELSE p_brand END AS brand",
            "p_type AS type",
        ],
        None,
    ),
    "searches": (
        "documents",
        [
            "doc_id AS search_id",
            "doc_id % 150 AS user_id",
            "{TS} '2024-01-01 00:00:00' + INTERVAL '1' SECOND * (doc_id * 7919 % 2592000) AS ts",
            "CASE WHEN doc_id % 41 = 7 THEN NULL ELSE text END AS search_query",
        ],
        None,
    ),
    "pageviews": (
        "events",
        [
            "event_id",
            "user_id * 31 + day(ts) AS sessionkey_id",
            "ts AS date_time",
            f"{_K} % 20 + 1 AS pageview_number",
            "CASE WHEN event_id % 29 = 3 THEN NULL ELSE value - 5.0 END AS pageview_duration_sec",
            f"{_K} % 15 AS page_type",
            f"CASE WHEN {_K} % 3 = 0 THEN {_K} END AS good_id",
            f"CASE WHEN {_K} % 3 = 0 AND event_id % 7 <> 2 THEN value * 10.0 END AS price",
            f"CASE WHEN {_K} % 3 = 0 AND event_id % 5 <> 1 THEN 1.0 END AS product_in_sale",
        ],
        None,
    ),
    "shop_orders": (
        "orders",
        [
            "o_orderkey AS order_id",
            "o_custkey % 150 * 31 + o_orderkey % 30 + 1 AS sessionkey_id",
            "{TS} '2024-01-01 00:00:00' + INTERVAL '1' SECOND * "
            "(o_orderkey % 30 * 86400 + o_custkey * 977 % 86400) AS create_time",
            "o_orderkey % 100 AS good_id",
            "cast(1500 + o_orderkey % 7 AS int) AS root_id",
            "cast(o_orderkey % 6 AS int) AS utm_medium",
            "CASE WHEN o_orderkey % 53 = 9 THEN NULL ELSE o_totalprice / 32.0 END AS price",
            "cast(o_orderkey % 12 AS int) AS goods_qty",
            "CASE WHEN o_orderkey % 19 = 4 THEN NULL ELSE o_orderkey % 50 / 10.0 END AS rating_value",
            "cast(o_orderkey % 30 AS int) AS rating_count",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS is_callcenter",
        ],
        None,
    ),
    # Every third customer repeats the identity of the one before under another id.
    "identities": (
        "customer",
        ["c_custkey AS unique_id", "CASE WHEN c_custkey % 3 = 2 THEN c_custkey - 1 ELSE c_custkey END AS k"],
        None,
    ),
    "persons": ("identities", _PERSON, None),
    "points": (
        "orders",
        [
            "o_orderkey AS point_id",
            "o_custkey % 50 + 1.0 AS f1",
            "o_totalprice AS f2",
            "o_orderkey % 11 / 100.0 AS f3",
            "o_custkey % 9 / 100.0 AS f4",
            "CASE WHEN (o_totalprice > 250000 AND o_custkey % 50 > 20) OR o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS y",
        ],
        None,
    ),
    # Binary outcome with a score: a noisy but informative one with many ties.
    "scores": (
        "orders",
        [
            "o_orderkey AS id",
            "CASE WHEN (o_orderkey * 31 + o_custkey * 17) % 100 < o_totalprice / 6000.0 THEN 1 ELSE 0 END AS y",
            "floor(o_totalprice / 2500.0) / 200.0 AS score",
        ],
        None,
    ),
}


def derive(tables, name: str) -> DataFrame:
    base, columns, keep = DERIVED[name]
    df: DataFrame = getattr(tables, base)
    if keep:
        df = df.where(keep)
    return df.selectExpr(*[c.replace("{TS}", "TIMESTAMP_NTZ") for c in columns])


def _select(name: str) -> str:
    base, columns, keep = DERIVED[name]
    source = f"({_select(base)}) AS {base}_rows" if base in DERIVED else base
    chosen = ", ".join(c.replace("{TS}", "TIMESTAMP") for c in columns)
    return f"SELECT {chosen} FROM {source}" + (f" WHERE {keep}" if keep else "")


def with_clause(names: list[str], sql: str) -> str:
    """Put the definitions of the derived inputs in front of ``sql``."""
    sql = sql.strip()
    if not names:
        return sql
    head = ",\n".join(f"{name} AS ({_select(name)})" for name in names)
    if sql[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {head},\n{sql[15:]}"
    if sql[:5].upper() == "WITH ":
        return f"WITH {head},\n{sql[5:]}"
    return f"WITH {head}\n{sql}"
