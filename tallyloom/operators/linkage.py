"""Probabilistic deduplication of person records.

Records that agree in all compared fields are folded into one profile first, so
a group of copies never multiplies into pairs.  Candidate pairs come from
equi-joins on blocking keys whose large blocks are cut over several tasks.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Mapping, Sequence
from itertools import combinations, count

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallyloom.functions.similarity import jaro_winkler, jaro_winkler_of
from tallyloom.functions.text import normalize_person_name
from tallyloom.operators.rows import birthdate_parse, dedup_on_keys, ensure_columns, person_fill
from tallyloom.session import cut_lineage, shared_folder, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no installed copy

FIELDS = ["surname", "name", "fathername", "birthdate", "passport", "inn", "gender"]
# Fields that must agree, per blocking rule, in order.
RULES = [
    ("passport",),
    ("inn",),
    ("surname", "name", "birthdate"),
    ("surname", "birthdate"),
    ("name", "fathername", "birthdate"),
    ("surname", "name", "fathername"),
]
# Blocking rules under which match rates are trained, in order.
TRAINING_RULES = [("surname", "name", "birthdate"), ("passport",), ("inn",), ("surname", "birthdate")]
NAME_FIELDS = ["surname", "name", "fathername"]
NAME_CUTS = [0.92, 0.88, 0.7]
# Most days between birth dates, per level from 3 down (a day, a month, a year).
DAYS = [1, 30, 365]
# Levels: exact is the highest number, 0 is "differs", -1 is "missing on a side".
LEVELS = {"surname": 5, "name": 5, "fathername": 5, "birthdate": 5, "passport": 2, "inn": 2, "gender": 2}
BLOCK_ROWS = 20_000


def clean_persons(df: DataFrame, order: str = "unique_id") -> DataFrame:
    """Fill, normalise, parse the birth date, keep one row per identity."""
    out = person_fill(df, ["surname", "name", "fathername", "passport", "inn", "gender"])
    out = out.withColumns({c: normalize_person_name(F.col(c)) for c in NAME_FIELDS})
    out = out.withColumn("birthdate", birthdate_parse(F.col("birthdate")))
    return dedup_on_keys(out, ["surname", "name", "fathername", "birthdate", "passport", "inn"], [order])


def blanks_to_null(df: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """A blank value is missing evidence: it neither blocks nor compares."""
    return df.withColumns({c: F.when(F.trim(F.col(c).cast("string")) != "", F.col(c).cast("string")) for c in fields})


def profiles(df: DataFrame, id_col: str = "unique_id") -> tuple[DataFrame, DataFrame]:
    """(one record per distinct profile, keyed by its smallest id; id -> profile id)."""
    records = blanks_to_null(df).select(id_col, *FIELDS)
    distinct = records.groupBy(*FIELDS).agg(F.min(id_col).alias("pid"), F.count(F.lit(1)).alias("copies"))
    same = F.lit(True)
    for f in FIELDS:
        same = same & F.col(f"r.{f}").eqNullSafe(F.col(f"p.{f}"))
    members = records.alias("r").join(distinct.alias("p"), same).select(F.col(f"r.{id_col}").alias(id_col), "p.pid")
    return distinct, members


def blocking_pairs(
    records: DataFrame, id_col: str = "unique_id", rules: Sequence[Sequence[str]] = RULES, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Pairs of records that agree on the fields of at least one rule, each pair once.

    A rule skips pairs an earlier rule already yields, so no distinct over the
    pairs is needed.  All rules share one join on (rule, key); blocks above
    ``block_rows`` are cut on the left and repeated on the right.  Columns come
    out as ``field_l`` and ``field_r``.
    """
    fields = [f for f in FIELDS if f in records.columns]
    keys = []
    for i, rule in enumerate(rules):
        present = F.lit(True)
        for f in rule:
            present = present & F.col(f).isNotNull()
        keys.append(F.when(present, F.struct(F.lit(i).alias("rule"), F.concat_ws("\u0001", *rule).alias("key"))))
    keyed = records.withColumn("b", F.explode(F.filter(F.array(*keys), lambda x: x.isNotNull())))
    keyed = keyed.select(id_col, *fields, "b.rule", "b.key")
    pairs = _meet(keyed, id_col, fields, block_rows)
    earlier = F.lit(False)
    for i, rule in enumerate(rules):
        agrees = F.lit(True)
        for f in rule:
            agrees = agrees & (F.col(f"{f}_l") == F.col(f"{f}_r"))
        earlier = earlier | ((F.col("rule") > i) & F.coalesce(agrees, F.lit(False)))
    return pairs.where(~earlier)


def _meet(keyed: DataFrame, id_col: str, fields: Sequence[str], block_rows: int) -> DataFrame:
    """Pairs of records with equal (rule, key), the smaller id on the left; large blocks are cut on the left and repeated on the right."""
    sizes = keyed.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))
    # Blocks above the limit: at most rows / limit of them, so the planner decides how to join them.
    large = sizes.where(F.col("n") > block_rows).select("rule", "key", F.ceil(F.col("n") / block_rows).cast("int").alias("parts"))
    keyed = keyed.join(large, ["rule", "key"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    left = keyed.select(
        "rule", "key", F.pmod(F.xxhash64(id_col), F.col("parts")).cast("int").alias("part"),
        F.col(id_col).alias("id_l"), *[F.col(f).alias(f"{f}_l") for f in fields],
    )
    right = keyed.select(
        "rule", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col(id_col).alias("id_r"), *[F.col(f).alias(f"{f}_r") for f in fields],
    )
    return left.join(right, ["rule", "key", "part"]).where("id_l < id_r").drop("key", "part")


def passing_rules(rules: Sequence[Sequence[str]], weights: Mapping[str, Sequence[float]], needed: float) -> list[tuple[str, ...]]:
    """Stricter rules that still yield every pair able to reach ``needed``.

    For a set of exactly agreeing fields the largest possible weight is the sum
    of their exact weights and the best other
    level of the rest.  The minimal sets that contain a rule and can reach the
    threshold replace the rule: all pairs of a common name are never formed when
    a common name alone cannot decide a match.
    """
    fields = list(weights)
    kept: list[tuple[str, ...]] = []
    for size in range(1, len(fields) + 1):
        for chosen in combinations(fields, size):
            if not any(set(r) <= set(chosen) for r in rules) or any(set(k) <= set(chosen) for k in kept):
                continue
            most = sum(max(weights[f][1:]) if f in chosen else max(0.0, *weights[f][:-1]) for f in fields)
            if most >= needed:
                kept.append(chosen)
    return kept


SLACK = 1e-9  # covers rounding in sums of weights


def promising_pairs(
    records: DataFrame, weights: Mapping[str, Sequence[float]], needed: float, shares: Mapping[str, DataFrame], u_exact: Mapping[str, float],
    id_col: str = "unique_id", block_rows: int = BLOCK_ROWS, among: Callable[[Sequence[str]], bool] | None = None,
) -> DataFrame:
    """The pairs that agree on a blocking rule and can reach ``needed``, each once, where rare values weigh more.

    A pair that agrees on exactly a set of fields weighs at most their exact weights,
    adjusted by the shares of its own values, plus the best other level of the rest.
    A record therefore enters only the smallest sets that its own values let reach
    ``needed``: a common name pairs with nothing that a rare one may decide, at any size of the table.
    Both records of a pair have the same values on the set, so they enter it together.
    With ``among`` only the sets of fields it holds for count.
    """
    place = {f: 1 << i for i, f in enumerate(FIELDS)}
    rest = {f: max(0.0, *weights[f][:-1]) for f in FIELDS}
    rated = records
    for f, table in shares.items():
        own = table.select(F.col("value").alias(f), F.log2(F.lit(u_exact[f]) / F.col("share")).alias(f"__more_{f}"))
        rated = rated.join(own, f, "left")
    chosen: list[tuple[int, Column]] = []
    sure: list[int] = []  # sets that reach the threshold whatever the values
    for size in range(1, len(FIELDS) + 1):
        for fields in combinations(FIELDS, size):
            mask = sum(place[f] for f in fields)
            if not any(set(r) <= set(fields) for r in RULES) or any(m & mask == m for m in sure) or (among and not among(fields)):
                continue
            bound = sum(weights[f][-1] if f in fields else rest[f] for f in FIELDS)
            adjusted = [f for f in fields if f in shares]
            if not adjusted and bound < needed - SLACK:
                continue
            if not adjusted:
                sure.append(mask)
            ok = F.lit(bound)
            for f in adjusted:
                ok = ok + F.coalesce(f"__more_{f}", F.lit(0.0))
            ok = ok >= needed - SLACK
            for f in fields:
                ok = ok & F.col(f).isNotNull()
            chosen.append((mask, F.when(ok, F.struct(F.lit(mask).alias("rule"), F.concat_ws("\u0001", *fields).alias("key")))))
    if not chosen:
        chosen = [(0, F.lit(None).cast("struct<rule:int,key:string>"))]
    able = rated.withColumn("__able", F.array_compact(F.array(*[c for _, c in chosen])))
    smallest = F.filter("__able", lambda x: ~F.exists("__able", lambda y: (y["rule"] != x["rule"]) & (y["rule"].bitwiseAND(x["rule"]) == y["rule"])))
    entered = able.withColumn("__sets", smallest).withColumn("b", F.explode("__sets"))
    keyed = entered.select(id_col, *FIELDS, F.col("__sets.rule").alias("sets"), "b.rule", "b.key")
    pairs = _meet(keyed, id_col, [*FIELDS, "sets"], block_rows)
    agree = F.lit(0)
    for f in FIELDS:
        agree = agree + F.when(F.col(f"{f}_l") == F.col(f"{f}_r"), place[f]).otherwise(0)
    pairs = pairs.withColumn("agree", agree)
    earlier = F.exists("sets_l", lambda m: (m < F.col("rule")) & (m.bitwiseAND(F.col("agree")) == m))
    return pairs.where(~earlier).drop("sets_l", "sets_r", "agree")


def weight_needed(threshold: float, prior: float) -> float:
    """Sum of field weights (log2) at which the match probability reaches ``threshold``."""
    return math.log2(threshold / (1 - threshold)) - math.log2(prior / (1 - prior))


# Fields nearly unique to a person: they agree or not, and their values would keep records from folding.
KEY_FIELDS = ["passport", "inn"]


def spanning_pairs(
    records: DataFrame, weights: Mapping[str, Sequence[float]], prior: float, threshold: float,
    shares: Mapping[str, DataFrame], u_exact: Mapping[str, float], id_col: str = "unique_id", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Candidate pairs enough for the clusters: those at ``threshold`` among them connect the same records as all candidates at it.

    Pairs that agree on a key field are all there.  Without that, a pair's score depends on the kinds of its records
    alone: equal values of the other fields, and the same key fields present (which then differ).  So kinds meet
    instead of records.  If two kinds reach the threshold, or one kind of several records with itself, each record
    is paired with the first of one kind it reaches, and the first records of the kinds with each other: work grows
    with the kinds of a block, links with the records.
    """
    needed = weight_needed(threshold, prior)
    records = records.where(F.col(id_col).isNotNull()).select(id_col, *FIELDS)
    if any(weights[f][1] < weights[f][0] for f in KEY_FIELDS):  # a pair may lose by agreeing: nothing folds
        return promising_pairs(records, weights, needed, shares, u_exact, id_col, block_rows)
    keyed = promising_pairs(records, weights, needed, shares, u_exact, id_col, block_rows, lambda fields: not set(KEY_FIELDS).isdisjoint(fields))

    others = [f for f in FIELDS if f not in KEY_FIELDS]
    has = [F.col(f).isNotNull().alias(f"has_{f}") for f in KEY_FIELDS]
    kinds = records.groupBy(*others, *has).agg(F.min(id_col).alias("first"), F.count(F.lit(1)).alias("n"))
    kinds = cut_lineage(kinds.withColumn("kind", F.monotonically_increasing_id()))
    # A key field of a kind, where present, differs from that of any other kind and of its own other records.
    own = lambda side: [F.when(F.col(f"has_{f}"), F.concat(F.lit(side), F.col("kind").cast("string"))).alias(f) for f in KEY_FIELDS]
    stand = kinds.select("kind", *others, *own("l"))
    met = promising_pairs(stand, weights, needed, shares, u_exact, "kind", block_rows, set(KEY_FIELDS).isdisjoint).drop("rule")
    twins = kinds.where("n > 1")
    twins = twins.select(*[F.col(f).alias(f"{f}_l") for f in others], *[c.alias(f"{f}_l") for f, c in zip(KEY_FIELDS, own("l"))],
                         *[F.col(f).alias(f"{f}_r") for f in others], *[c.alias(f"{f}_r") for f, c in zip(KEY_FIELDS, own("r"))],
                         F.col("kind").alias("id_l"), F.col("kind").alias("id_r"))
    blocked = F.lit(False)
    for rule in RULES:
        if set(KEY_FIELDS).isdisjoint(rule):
            ok = F.lit(True)
            for f in rule:
                ok = ok & F.col(f"{f}_l").isNotNull()
            blocked = blocked | ok
    met = met.unionByName(twins.where(blocked))
    # Most pairs end here, before names are compared letter by letter.
    most = F.lit(0.0)
    for f in FIELDS:
        a, b = F.col(f"{f}_l"), F.col(f"{f}_r")
        apart = weights[f][0] if f in KEY_FIELDS else max(weights[f][:-1])
        exact = weights[f][-1]
        if f in shares:
            exact += max(0.0, math.log2(u_exact[f] / (shares[f].agg(F.min("share")).first()[0] or u_exact[f])))
        most = most + F.when(a.isNull() | b.isNull(), 0.0).when(a == b, exact).otherwise(apart)
    met = met.where(most >= needed - SLACK)
    linked = score_pairs(compare_pairs(met), weights, prior, shares, u_exact).where(F.col("match_probability") >= threshold)
    first = kinds.select("kind", "first")
    linked = linked.select("id_l", "id_r").join(first.toDF("id_l", "first_l"), "id_l").join(first.toDF("id_r", "first_r"), "id_r")
    linked = stored(linked, f"{shared_folder(records.sparkSession, 'kinds')}/linked")

    ends = F.array(F.struct(F.col("id_l").alias("kind"), F.struct(F.col("id_r").alias("to"), F.col("first_r").alias("first")).alias("x")),
                   F.struct(F.col("id_r").alias("kind"), F.struct(F.col("id_l").alias("to"), F.col("first_l").alias("first")).alias("x")))
    partner = linked.select(F.inline(ends)).groupBy("kind").agg(F.min("x").alias("x")).select("kind", F.col("x.first").alias("to"))
    same = F.lit(True)
    for f in others:
        same = same & F.col(f"r.{f}").eqNullSafe(F.col(f"k.{f}"))
    for f in KEY_FIELDS:
        same = same & (F.col(f"r.{f}").isNotNull() == F.col(f"k.has_{f}"))
    reached = records.alias("r").join(kinds.where("n > 1").join(partner, "kind").alias("k"), same)
    links = reached.select(F.col(f"r.{id_col}").alias("a"), F.col("k.to").alias("b")).unionByName(linked.select(F.col("first_l").alias("a"), F.col("first_r").alias("b")))
    links = links.where("a <> b").select(F.least("a", "b").alias("id_l"), F.greatest("a", "b").alias("id_r")).distinct()
    for side in "lr":
        links = links.join(records.select(F.col(id_col).alias(f"id_{side}"), *[F.col(f).alias(f"{f}_{side}") for f in FIELDS]), f"id_{side}")
    return keyed.drop("rule").unionByName(links.select(*[c for c in keyed.columns if c != "rule"]))


def deciding_pairs(
    records: DataFrame, weights: Mapping[str, Sequence[float]], prior: float, threshold: float = 0.95, id_col: str = "unique_id"
) -> DataFrame:
    """Candidate pairs that decide the clusters at ``threshold`` (``spanning_pairs``), compared field by field."""
    if not passing_rules(RULES, weights, weight_needed(threshold, prior)):
        raise ValueError("no agreement of fields can reach the threshold")
    records = cut_lineage(records.select(id_col, *FIELDS))
    return compare_pairs(spanning_pairs(records, weights, prior, threshold, {}, {}, id_col))


def _name_level(field: str) -> Column:
    a, b = F.col(f"{field}_l"), F.col(f"{field}_r")
    # Equal names are settled without the string comparison.
    alike = jaro_winkler(F.when(a != b, a), b)
    level = F.when(alike >= NAME_CUTS[0], 3).when(alike >= NAME_CUTS[1], 2).when(alike >= NAME_CUTS[2], 1).otherwise(0)
    return F.when(a.isNull() | b.isNull(), -1).when(a == b, 4).otherwise(level)


def _date_level(field: str = "birthdate") -> Column:
    a, b = F.col(f"{field}_l"), F.col(f"{field}_r")
    x, y = F.try_to_date(a), F.try_to_date(b)
    days = F.abs(F.datediff(x, y))
    level = F.when(days <= 1, 3).when(days <= 30.4375, 2).when(days <= 365.25, 1).otherwise(0)
    return F.when(a.isNull() | b.isNull(), -1).when(a == b, 4).otherwise(level)


def _exact_level(field: str) -> Column:
    a, b = F.col(f"{field}_l"), F.col(f"{field}_r")
    return F.when(a.isNull() | b.isNull(), -1).when(a == b, 1).otherwise(0)


def gamma(field: str) -> Column:
    """Level of a field from its two sides."""
    return _name_level(field) if field in NAME_FIELDS else _date_level(field) if field == "birthdate" else _exact_level(field)


def compare_pairs(pairs: DataFrame) -> DataFrame:
    """Adds one ``gamma_<field>`` level per field."""
    return pairs.select("*", *[gamma(f).cast("int").alias(f"gamma_{f}") for f in FIELDS])


# --- training --------------------------------------------------------------------


def pairs_of(n: str) -> Column:
    """Pairs among n rows."""
    return F.col(n).cast("double") * (F.col(n) - 1) / 2


def close_dates(counts: DataFrame) -> DataFrame:
    """(level, n): pairs of rows with different days, by the level of the days between them, from (day, n).

    Days lie in blocks of a year; a block also sees the next one, so a range window inside it counts each pair once.
    """
    block = F.floor(F.col("day") / F.lit(DAYS[-1] + 1))
    seen = counts.select("day", "n", block.alias("block"), F.lit(True).alias("own")).unionByName(
        counts.select("day", "n", (block - 1).alias("block"), F.lit(False).alias("own"))
    )
    within = [F.sum("n").over(W.partitionBy("block").orderBy("day").rangeBetween(1, d)).alias(f"d{d}") for d in DAYS]
    near = seen.select("own", "n", *within).where("own")
    upto = [F.sum(F.col("n").cast("double") * F.coalesce(f"d{d}", F.lit(0))) for d in DAYS]
    total = near.agg(*[c.alias(f"d{d}") for d, c in zip(DAYS, upto)])
    levels = [F.struct(F.lit(3 - i).alias("level"), (F.col(f"d{d}") - (F.col(f"d{DAYS[i - 1]}") if i else F.lit(0.0))).alias("n")) for i, d in enumerate(DAYS)]
    return total.select(F.explode(F.array(*levels)).alias("x")).select("x.level", "x.n")


def letter_overlap(left: list[str], right: list[str]) -> np.ndarray:
    """Letters that each two texts share, repeats included: one product of tables that count in unary."""
    place: dict[tuple[str, int], int] = {}

    def coded(texts: list[str]) -> list[list[int]]:
        rows = []
        for text in texts:
            often: dict[str, int] = {}
            row = []
            for c in text:
                often[c] = often.get(c, 0) + 1
                row.append(place.setdefault((c, often[c]), len(place)))
            rows.append(row)
        return rows

    rows = coded(left), coded(right)
    tables = [np.zeros((len(r), len(place)), np.float32) for r in rows]
    for table, own in zip(tables, rows):
        for i, row in enumerate(own):
            table[i, row] = 1
    return tables[0] @ tables[1].T


def alike_names(values: DataFrame, most: int = 1000) -> DataFrame:
    """(field, level, n): pairs of rows with different, alike names by level, from (field, value, n).

    The different values are dealt into blocks of about ``most``; each two blocks of a field meet in one
    group, which returns a number per level, never pairs.  The letters two names share bound their
    similarity, so most pairs end at one product of tables.  Work grows with the square of the different names, whatever the rows.
    """
    sizes = values.groupBy("field").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("blocks"))
    own = values.join(F.broadcast(sizes), "field").withColumn("own", F.pmod(F.xxhash64("value"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = own.select("field", "value", "n", "own", other).select(
        "field", "value", "n", "own", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")
    )

    def meet(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        field, x, y = key
        a, b = rows[rows["own"] == x], rows[rows["own"] == y]
        left, right, n_left, n_right = a["value"].tolist(), b["value"].tolist(), a["n"].to_numpy(float), b["n"].to_numpy(float)
        sums = np.zeros(len(NAME_CUTS))
        if left and right:
            size = [np.fromiter(map(len, t), float, len(t)) for t in (left, right)]
            shared = letter_overlap(left, right)
            bound = (shared / size[0][:, None] + shared / size[1] + (shared > 0)) / 3
            i, j = np.nonzero(bound >= NAME_CUTS[-1] - 1e-5)
            if x == y:
                i, j = i[i < j], j[i < j]
            for k in range(0, len(i), 200_000):
                p, q = i[k : k + 200_000], j[k : k + 200_000]
                alike = jaro_winkler_of([left[v] for v in p], [right[v] for v in q])
                for level, (low, high) in enumerate(zip(NAME_CUTS[::-1], [*NAME_CUTS[-2::-1], 2.0])):
                    fits = (alike >= low) & (alike < high)
                    sums[level] += (n_left[p[fits]] * n_right[q[fits]]).sum()
        return pd.DataFrame({"field": field, "level": np.arange(1, len(sums) + 1, dtype=np.int32), "n": sums})

    return dealt.groupBy("field", "x", "y").applyInPandas(meet, "field string, level int, n double").groupBy("field", "level").agg(F.sum("n").alias("n"))


def estimate_u(records: DataFrame) -> DataFrame:
    """(field, level, share): agreement rates among all pairs of different records, both values present, from value frequencies.

    No pair of records is formed: equal values give n (n - 1) / 2 pairs, dates a range sum over days, names
    a product of frequencies for each two alike values.  The rest of all pairs differs.
    """
    long = records.select(*[F.col(f).cast("string").alias(f) for f in FIELDS]).unpivot([], FIELDS, "field", "value")
    counts = cut_lineage(long.where("value is not null").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n")))
    top = F.create_map(*[F.lit(x) for f in FIELDS for x in (f, LEVELS[f] - 1)])
    equal = counts.groupBy("field").agg(F.sum(pairs_of("n")).alias("n")).select("field", top[F.col("field")].alias("level"), "n")
    names = alike_names(counts.where(F.col("field").isin(NAME_FIELDS)))
    days = counts.where("field = 'birthdate'").select(F.unix_date(F.try_to_date("value")).alias("day"), "n").where("day is not null")
    # Several spellings of a day differ as texts, and no days lie between them.
    spelled = days.groupBy("day").agg(F.sum("n").alias("n"), F.sum(pairs_of("n")).alias("same"))
    dates = close_dates(spelled.select("day", "n")).select(F.lit("birthdate").alias("field"), "level", "n")
    apart = spelled.agg(F.sum(pairs_of("n") - F.col("same")).alias("n")).select(F.lit("birthdate").alias("field"), F.lit(3).alias("level"), "n")
    close = equal.unionByName(names).unionByName(dates).unionByName(apart).groupBy("field", "level").agg(F.sum("n").alias("n"))
    whole = counts.groupBy("field").agg(F.sum("n").alias("n")).select("field", pairs_of("n").alias("whole"))
    rest = close.groupBy("field").agg(F.sum("n").alias("n")).join(whole, "field").select("field", F.lit(0).alias("level"), (F.col("whole") - F.col("n")).alias("n"))
    return close.unionByName(rest).where("n > 0").join(whole, "field").select("field", "level", (F.col("n") / F.col("whole")).alias("share"))


def gamma_patterns(compared: DataFrame) -> DataFrame:
    """Number of pairs per combination of levels: a short table however many pairs there are."""
    return compared.groupBy(*[f"gamma_{f}" for f in FIELDS]).agg(F.count(F.lit(1)).alias("n"))


def folded_patterns(records: DataFrame, rule: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(gamma levels but those of the key fields, ``both``, ``equal``, n): pairs of records that agree on the rule, counted without forming them.

    Records of a block fold into kinds: equal values of all compared fields but the
    key fields, and the same key fields present.  For every set of key fields, the
    kinds with equal values there meet, and each two stand for n x n pairs of records.
    ``both`` and ``equal`` are bits of the key fields: present on both sides, and known
    to be equal; ``exact_patterns`` turns "known to be equal" into "equal, the others
    differ".  So the work grows with the kinds of a block, not with its records.
    """
    keys = [f for f in KEY_FIELDS if f not in rule]
    same = [f for f in FIELDS if f not in rule and f not in keys]
    present = F.lit(0)
    for i, f in enumerate(keys):
        present = present + F.when(F.col(f).isNotNull(), 1 << i).otherwise(0)
    sets = []
    for chosen in range(1 << len(keys)):
        own = [*rule, *[f for i, f in enumerate(keys) if chosen >> i & 1]]
        known = F.lit(True)
        for f in own:
            known = known & F.col(f).isNotNull()
        sets.append(F.when(known, F.struct(F.lit(chosen).alias("equal"), F.concat_ws("\u0001", *own).alias("key"))))
    kinds = records.select(*same, present.alias("has"), F.explode(F.array_compact(F.array(*sets))).alias("b"))
    kinds = kinds.groupBy("b.equal", "b.key", "has", *same).agg(F.count(F.lit(1)).cast("double").alias("n"))
    kinds = kinds.withColumn("kind", F.to_json(F.struct("has", *same)))
    sizes = kinds.groupBy("equal", "key").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("rows")).where("rows > 1")
    kinds = kinds.join(sizes.select("equal", "key", F.ceil(F.col("kinds") / block_rows).cast("int").alias("parts")), ["equal", "key"])
    left = kinds.select(
        "equal", "key", F.pmod(F.xxhash64("kind"), F.col("parts")).cast("int").alias("part"),
        *[F.col(c).alias(f"{c}_l") for c in ("kind", "has", "n", *same)],
    )
    right = kinds.select(
        "equal", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        *[F.col(c).alias(f"{c}_r") for c in ("kind", "has", "n", *same)],
    )
    met = left.join(right, ["equal", "key", "part"]).where("kind_l <= kind_r")
    pairs = F.when(F.col("kind_l") == F.col("kind_r"), pairs_of("n_l")).otherwise(F.col("n_l") * F.col("n_r"))
    met = met.withColumns({"both": F.col("has_l").bitwiseAND(F.col("has_r")), "pairs": pairs}).where("pairs > 0")
    levels = [gamma(f).cast("int").alias(f"gamma_{f}") for f in same]
    met = met.select("both", "equal", "pairs", *levels)
    return met.groupBy("both", "equal", *[f"gamma_{f}" for f in same]).agg(F.sum("pairs").alias("n"))


def exact_patterns(folded: Sequence[Mapping], rule: Sequence[str]) -> list[tuple[tuple[int, ...], int]]:
    """Pairs per combination of levels, by inclusion and exclusion over the sets of key fields known to be equal."""
    keys = [f for f in KEY_FIELDS if f not in rule]
    same = [f for f in FIELDS if f not in rule and f not in keys]
    at_least: dict[tuple, dict[int, float]] = {}
    for r in folded:
        at_least.setdefault((r["both"], *[r[f"gamma_{f}"] for f in same]), {})[r["equal"]] = r["n"]
    out = []
    for (both, *levels), counts in at_least.items():
        for equal in range(both + 1):
            if equal & ~both:
                continue
            more = [x for x in range(equal, both + 1) if x & equal == equal and not x & ~both]
            n = round(sum((-1) ** (x ^ equal).bit_count() * counts.get(x, 0) for x in more))
            if n:
                own = dict(zip(same, levels)) | {f: LEVELS[f] - 1 for f in rule}
                own |= {f: (1 if equal >> i & 1 else 0) if both >> i & 1 else -1 for i, f in enumerate(keys)}
                out.append((tuple(own[f] for f in FIELDS), n))
    return sorted(out)


def training_patterns(records: DataFrame, rules: Sequence[Sequence[str]] = TRAINING_RULES) -> list[list[tuple[tuple[int, ...], int]]]:
    """Per rule, the pairs that agree on it, counted by combination of levels; one short table reaches the driver."""
    tables = []
    for i, rule in enumerate(rules):
        t = folded_patterns(records, rule)
        missing = {f"gamma_{f}": F.lit(None).cast("int") for f in FIELDS if f"gamma_{f}" not in t.columns}
        tables.append(t.withColumns({"rule": F.lit(i), **missing}))
    whole = tables[0]
    for t in tables[1:]:
        whole = whole.unionByName(t)
    rows = whole.collect()
    return [exact_patterns([r for r in rows if r["rule"] == i], rule) for i, rule in enumerate(rules)]


FLOOR = 1e-6


def em_match_rates(
    patterns: Sequence[tuple[tuple[int, ...], int]], u: Mapping[str, Sequence[float]], fixed: Sequence[str] = (),
    prior: float = 0.2, rounds: int = 20, tolerance: float = 0.001,
) -> tuple[dict[str, list[float]], float, list[float]]:
    """EM over pattern counts: match rates per level, match share, log-likelihood per round.

    Fields of the training rule (``fixed``) carry no information and are skipped.
    """
    fields = [f for f in FIELDS if f not in fixed]
    place = {f: i for i, f in enumerate(FIELDS)}
    m = {f: [(1 + 2 * k) / LEVELS[f] ** 2 for k in range(LEVELS[f])] for f in fields}
    share, likelihoods = prior, []
    for _ in range(rounds):
        sums = {f: [0.0] * LEVELS[f] for f in fields}
        matched = total = loglik = 0.0
        for gammas, n in patterns:
            pm, pu = share, 1 - share
            for f in fields:
                g = gammas[place[f]]
                if g >= 0:
                    pm *= max(m[f][g], FLOOR)
                    pu *= max(u[f][g], FLOOR)
            p = pm / (pm + pu)
            loglik += n * math.log(pm + pu)
            matched += n * p
            total += n
            for f in fields:
                g = gammas[place[f]]
                if g >= 0:
                    sums[f][g] += n * p
        likelihoods.append(loglik)
        change = abs(matched / total - share) if total else 0.0
        share = matched / total if total else share
        for f in fields:
            whole = sum(sums[f])
            if whole > 0:
                new = [s / whole for s in sums[f]]
                change = max(change, max(abs(a - b) for a, b in zip(new, m[f])))
                m[f] = new
        if change < tolerance:
            break
    return m, share, likelihoods


def train_weights(records: DataFrame) -> dict[str, list[float]]:
    """log2(m / u) per field and level: u from all pairs, m as the mean over the training rules."""
    u: dict[str, list[float]] = {f: [FLOOR] * LEVELS[f] for f in FIELDS}
    for r in estimate_u(records).collect():  # fields x levels
        u[r["field"]][r["level"]] = max(r["share"], FLOOR)
    found: dict[str, list[list[float]]] = {f: [] for f in FIELDS}
    for rule, patterns in zip(TRAINING_RULES, training_patterns(records)):
        if patterns:
            m, _, _ = em_match_rates(patterns, u, fixed=rule)
            for f, rates in m.items():
                found[f].append(rates)
    weights = {}
    for f in FIELDS:
        means = [sum(c) / len(found[f]) for c in zip(*found[f])] if found[f] else u[f]
        weights[f] = [math.log2(max(a, FLOOR) / b) for a, b in zip(means, u[f])]
    return weights


# --- scoring and clustering ----------------------------------------------------------


def score_pairs(
    compared: DataFrame, weights: Mapping[str, Sequence[float]], prior: float = 1e-4,
    frequencies: Mapping[str, DataFrame] | None = None, u_exact: Mapping[str, float] | None = None,
) -> DataFrame:
    """Adds ``match_weight`` (log2) and ``match_probability``.

    ``frequencies`` gives per field a table (value, share): an exact agreement on
    a value rarer than the average ``u_exact`` weighs more, on a commoner one less.
    """
    total = F.lit(math.log2(prior / (1 - prior)))
    for f, ws in weights.items():
        part = F.lit(0.0)
        for level, w in enumerate(ws):
            part = F.when(F.col(f"gamma_{f}") == level, F.lit(float(w))).otherwise(part)
        total = total + part
    out = compared
    for f, table in (frequencies or {}).items():
        out = out.join(table.select(F.col("value").alias(f"{f}_l"), F.col("share").alias(f"__tf_{f}")), f"{f}_l", "left")
        exact = F.col(f"gamma_{f}") == LEVELS[f] - 1
        total = total + F.when(exact & F.col(f"__tf_{f}").isNotNull(), F.log2(F.lit(u_exact[f]) / F.col(f"__tf_{f}"))).otherwise(0.0)
    out = out.withColumn("match_weight", total).drop(*[f"__tf_{f}" for f in (frequencies or {})])
    odds = F.pow(F.lit(2.0), F.least("match_weight", F.lit(1000.0)))
    return out.withColumn("match_probability", odds / (1 + odds))


def value_shares(records: DataFrame, field: str) -> DataFrame:
    """(value, share) of a field; counts copies."""
    copies = F.sum("copies") if "copies" in records.columns else F.count(F.lit(1))
    counts = records.where(F.col(field).isNotNull()).groupBy(F.col(field).alias("value")).agg(copies.alias("n"))
    whole = counts.agg(F.sum("n")).first()[0] or 1
    return counts.select("value", (F.col("n") / F.lit(whole)).alias("share"))


def connected_components(edges: DataFrame, left: str = "id_l", right: str = "id_r") -> DataFrame:
    """(id, cluster_id) for every id on an edge; the cluster id is its smallest member.

    Alternating large-star and small-star steps (Kiveris et al. 2014).  A step
    needs only the smallest neighbour of each node, an aggregate combined before
    the shuffle; a hub's edges meet it in a join whose skew the engine splits.
    Each step is written below the shared folder and read again, so lost executors cost one step
    at most, and small files are read together: the few links of late rounds start few tasks.
    """
    a, b = F.col(left), F.col(right)
    folder = shared_folder(edges.sparkSession, "components")
    links = lambda df, name: stored(df, f"{folder}/{name}")

    def summary(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    current = links(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "links")
    state = summary(current)
    for step in count():
        ends = F.array(F.struct(F.col("hi").alias("u"), F.col("lo").alias("v")), F.struct(F.col("lo").alias("u"), F.col("hi").alias("v")))
        both = current.select(F.inline(ends))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = links(both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")), f"large{step}")
        small = large.join(large.groupBy("hi").agg(F.min("lo").alias("m")), "hi")
        # the least neighbour's own row gives the link of hi to it
        following = links(small.select(F.when(F.col("lo") != F.col("m"), F.col("lo")).otherwise(F.col("hi")).alias("hi"), F.col("m").alias("lo")).distinct(), f"small{step}")
        new_state = summary(following)
        if new_state == state:
            break
        current, state = following, new_state
    roots = current.select(F.col("lo").alias("id")).distinct()
    return current.select(F.col("hi").alias("id"), F.col("lo").alias("cluster_id")).unionByName(
        roots.join(current.select(F.col("hi").alias("id")), "id", "left_anti").select("id", F.col("id").alias("cluster_id"))
    )


def cluster_pairs(scored: DataFrame, threshold: float = 0.95) -> DataFrame:
    return connected_components(scored.where(F.col("match_probability") >= threshold).select("id_l", "id_r"))


def canonical_per_cluster(records: DataFrame, clusters: DataFrame, id_col: str = "unique_id") -> DataFrame:
    """One record per cluster, the smallest id: by number if over 90 % of the ids are numbers, else by text.

    Records outside every cluster stand for themselves.
    """
    member = clusters.select(F.col("id").cast("string").alias("__id"), F.col("cluster_id").cast("string").alias("__cluster"))
    merged = records.join(member, F.col(id_col).cast("string") == F.col("__id"), "left").drop("__id")
    merged = merged.withColumn("cluster_id", F.coalesce("__cluster", F.col(id_col).cast("string"))).drop("__cluster")
    number = F.col(id_col).cast("string").try_cast("bigint")
    numeric = records.agg(F.avg(number.isNotNull().cast("int"))).first()[0] or 0.0
    order = [number.asc_nulls_last(), F.col(id_col).cast("string")] if numeric > 0.9 else [F.col(id_col).cast("string")]
    place = F.row_number().over(W.partitionBy("cluster_id").orderBy(*order))
    return merged.withColumn("__rn", place).where("__rn = 1").drop("__rn")


def dedup_persons(
    df: DataFrame, weights: Mapping[str, Sequence[float]] | None = None, threshold: float = 0.95, prior: float = 1e-4,
    id_col: str = "unique_id", adjust: Sequence[str] = ("surname", "name"),
) -> tuple[DataFrame, DataFrame]:
    """(clusters(id, cluster_id), deduplicated records).

    Profiles are paired (as far as the clusters need), scored and clustered; copies then follow their profile
    when a record compared with itself reaches the threshold.
    """
    full = ensure_columns(df, FIELDS)
    distinct, members = profiles(full, id_col)
    distinct, members = cut_lineage(distinct), cut_lineage(members)
    people = distinct.withColumnRenamed("pid", id_col)
    if weights is None:
        weights = train_weights(people)
    shares = {f: value_shares(distinct, f) for f in adjust}
    u_exact = {f: shares[f].agg(F.sum(F.col("share") * F.col("share"))).first()[0] or 1.0 for f in adjust}
    compared = compare_pairs(spanning_pairs(people, weights, prior, threshold, shares, u_exact, id_col))
    scored = score_pairs(compared, weights, prior, shares, u_exact).select("id_l", "id_r", "match_probability")
    # A profile with copies, compared with itself.
    twins = distinct.where("copies > 1").select("pid", *[F.col(f).alias(f"{f}_l") for f in FIELDS], *[F.col(f).alias(f"{f}_r") for f in FIELDS])
    blocked = F.lit(False)
    for rule in RULES:
        ok = F.lit(True)
        for f in rule:
            ok = ok & F.col(f"{f}_l").isNotNull()
        blocked = blocked | ok
    sure = score_pairs(compare_pairs(twins.where(blocked)), weights, prior, shares, u_exact).where(F.col("match_probability") >= threshold)
    copies = members.join(sure.select("pid"), "pid").where(F.col("pid") != F.col(id_col)).select(
        F.col("pid").alias("id_l"), F.col(id_col).alias("id_r"), F.lit(1.0).alias("match_probability")
    )
    clusters = cluster_pairs(scored.unionByName(copies), threshold)
    return clusters, canonical_per_cluster(full, clusters, id_col)


# --- fingerprints -------------------------------------------------------------------------


def full_fingerprint(columns: Sequence[str] = ("surname", "name", "fathername", "gender", "birthdate", "passport", "inn")) -> Column:
    from tallyloom.functions.text import clean_fingerprint_text

    return F.concat_ws(" ", *[clean_fingerprint_text(F.col(c)) for c in columns])


def raw_fingerprint(columns: Sequence[str] = ("name", "surname", "fathername", "birthdate", "inn", "passport")) -> Column:
    return F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("<nan>")) for c in columns])


def match_by_vector(
    people: DataFrame, wanted: DataFrame, id_col: str = "unique_id", components: int = 16, limit: float = 0.6
) -> DataFrame:
    """Ids of people whose nearest wanted record lies within ``limit`` (squared L2), or whose documents match."""
    from tallyloom.operators.joins import exact_id_match
    from tallyloom.operators.neighbours import knn_exact
    from tallyloom.operators.rows import union_distinct_ids
    from tallyloom.operators.text_features import TextSvd, char_tfidf

    both = people.select(F.lit("p").alias("side"), id_col, full_fingerprint().alias("text")).unionByName(
        wanted.select(F.lit("w").alias("side"), id_col, full_fingerprint().alias("text"))
    ).withColumn("doc", F.concat("side", F.col(id_col).cast("string")))
    weights = char_tfidf(both, "doc", "text").persist()
    own = weights.where(F.col("doc").startswith("p"))
    svd = TextSvd(components).fit(own, "doc")
    vectors = svd.transform(weights, "doc")
    placed = cut_lineage(vectors.join(both.select("doc", "side", id_col), "doc"))
    weights.unpersist()
    base, asked = placed.where("side = 'p'").select(id_col, "svd"), placed.where("side = 'w'").select(id_col, "svd")
    near = knn_exact(base, asked, id_col, "svd", 1).where(F.col("distance") <= limit)
    by_id = exact_id_match(people, wanted).select(F.col(id_col).alias("i"))
    return union_distinct_ids(near.select(F.col("neighbour_id").alias("i")), by_id, "i")
