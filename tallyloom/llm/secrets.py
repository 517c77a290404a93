"""Secrets in texts, with weak candidates linked to their complements.

Three strong kinds are always reported: assignments, access identifiers, long
hexadecimal strings.  Weak candidates (a login name, a token that looks random,
an address of a service) mean nothing alone.  An interval join of the spans of a
text reports them where complementary parts lie within ``SCOPE`` code points:
a random token near an access identifier or a login, a login near a secret,
an address near both an identifier and a secret.  Weak spans that overlap a
strong one are left out.

Everything is DataFrame expressions.  Spans stay in arrays of their row, so a
text meets no shuffle.  One side of the join is sorted and cut into runs of about
the root of its size, each with the reach of its intervals; a span looks only into
the runs it can meet, so a text with n spans costs n times the root of n.  A null
text counts as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCOPE = 200
#: The strong patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: Weak candidates of our own.
LOGIN = r"""(?i:\b(?:user(?:name)?|login|client_?id|account(?:_?id)?))["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._+-]{3,}"""
RANDOM = r"(?<![A-Za-z0-9/+_=-])(?=[A-Za-z/+_=-]*[0-9])(?=[0-9a-z/+_=-]*[A-Z])(?=[0-9A-Z/+_=-]*[a-z])[A-Za-z0-9/+_=-]{16,}"
ADDRESS = r"""\b(?:https?|jdbc:[a-z0-9]+|s3a?|ftps?|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|amqps?)://[^\s"'<>]+"""
KINDS = ["assign", "access", "hex", "secret", "login", "endpoint"]
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"


def none() -> Column:
    return F.array().cast(SPAN)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once for the row, also where inner functions use it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def runs(items: Column) -> Column:
    """The array cut into stretches of about the root of its size; none for an empty array."""

    def cut(xs: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(xs))), F.lit(1)).cast("int")
        return bound(width, lambda w: F.transform(F.sequence(F.lit(1), F.size(xs), w), lambda i: F.slice(xs, i, w)))

    return bound(items, lambda xs: F.filter(F.when(F.size(xs) > 0, cut(xs)).otherwise(F.slice(F.array(xs), 1, 0)), lambda r: F.size(r) > 0))


def spans(text: Column, pattern: str, rank: int, value_group: int = 0, least: int = 0) -> Column:
    """Spans of the leftmost matches that do not overlap; those whose group is shorter than ``least`` are dropped.

    The text between matches comes from a split, the matches from an extraction; their lengths sum to the places,
    first over runs of matches, then inside each run.
    """
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("long"))
    whole = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda s: F.length(s).cast("long"))
    value = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)), lambda s: F.length(s).cast("long"))
    steps = bound(whole, lambda w: F.arrays_zip(F.slice(between, 1, F.size(w)).alias("gap"), w.alias("size"), value.alias("value")))
    zero = F.lit(0).cast("long")

    def place(state: Column, run: Column) -> Column:
        after = F.aggregate(run, state["at"], lambda at, x: at + x["gap"] + x["size"])
        return F.struct(after.alias("at"), F.concat(state["starts"], F.array(state["at"])).alias("starts"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["size"]
        own = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(x["value"] >= least, F.concat(state["found"], own)).otherwise(state["found"]).alias("found"))

    def inside(run: Column, start: Column) -> Column:
        return F.aggregate(run, F.struct(start.alias("at"), none().alias("found")), step, lambda s: s["found"])

    def placed(rs: Column) -> Column:
        first = F.struct(zero.alias("at"), F.array().cast("array<bigint>").alias("starts"))
        return F.flatten(F.zip_with(rs, F.aggregate(rs, first, place, lambda s: s["starts"]), inside))

    return F.when(F.rlike(text, F.lit(pattern)), bound(runs(steps), placed)).otherwise(none())


def sorted_runs(others: Column) -> Column:
    """Runs of intervals in order, with the least start and the largest end of each."""
    return F.transform(
        runs(F.sort_array(others)),
        lambda r: F.struct(F.element_at(r, 1)["start"].alias("lo"), F.array_max(F.transform(r, lambda o: o["end"])).alias("hi"), r.alias("items")),
    )


def near(span: Column, index: Column, scope: int) -> Column:
    """Whether an interval of the sorted runs begins or ends within ``scope`` of this one."""
    meets = lambda start, end: (start <= span["end"] + scope) & (span["start"] <= end + scope)
    return F.exists(index, lambda r: meets(r["lo"], r["hi"]) & F.exists(r["items"], lambda o: meets(o["start"], o["end"])))


def apart(span: Column, index: Column) -> Column:
    """Whether no interval of the sorted runs overlaps this one."""
    cross = lambda start, end: (start < span["end"]) & (span["start"] < end)
    return ~F.exists(index, lambda r: cross(r["lo"], r["hi"]) & F.exists(r["items"], lambda o: cross(o["start"], o["end"])))


def kept(found: str | Column, others: Column, test) -> Column:
    """The spans for which ``test(span, sorted runs of the others)`` holds; the runs are made once a row."""
    found = F.col(found) if isinstance(found, str) else found
    return F.when(F.size(found) > 0, bound(sorted_runs(others), lambda index: F.filter(found, lambda s: test(s, index)))).otherwise(none())


def with_secrets(df: DataFrame, text_col: str = "text", scope: int = SCOPE, name: str = "secrets") -> DataFrame:
    """Adds an array of spans (start, rank, end) in order; the rank counts ``KINDS``, the end is exclusive, places are code points."""
    keep = [F.col(f"`{c}`") for c in df.columns if c != name]
    text = F.col("__text")
    found = df.select(*keep, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__text"))
    found = found.select(
        "*", spans(text, ASSIGN, 0, 2, 6).alias("__assign"), F.when(F.contains(text, F.lit("AKIA")), spans(text, ACCESS, 1)).otherwise(none()).alias("__access"),
        spans(text, HEX, 2).alias("__hex"), spans(text, LOGIN, 4).alias("__login"),
    )
    found = found.withColumn("__strong", F.concat("__assign", "__access", "__hex"))
    found = found.withColumn("__login", kept("__login", F.col("__strong"), apart))
    found = found.withColumn("__who", F.concat("__access", "__login"))
    some = F.size("__who") > 0
    found = found.withColumn("__random", F.when(some, spans(text, RANDOM, 3)).otherwise(none()))
    found = found.withColumn("__address", F.when(some, spans(text, ADDRESS, 5)).otherwise(none())).drop("__text")

    def close(span: Column, index: Column) -> Column:
        return near(span, index, scope)

    found = found.withColumn("__random", kept("__random", F.concat("__strong", "__login", "__address"), apart))
    found = found.withColumn("__random", kept("__random", F.col("__who"), close))
    found = found.withColumn("__what", F.concat("__random", "__assign", "__hex"))
    found = found.withColumn("__address", kept("__address", F.col("__strong"), apart))
    found = found.withColumn("__address", kept("__address", F.col("__who"), close))
    found = found.withColumns({"__login": kept("__login", F.col("__what"), close), "__address": kept("__address", F.col("__what"), close)})
    return found.select(*keep, F.sort_array(F.concat("__strong", "__random", "__login", "__address")).alias(name))


def written(found: Column) -> Column:
    """kind:start:end of the spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch covered by spans replaced by a mark."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        before = F.substr(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        apart = s["start"] >= state["at"]
        out = F.when(apart, F.concat(state["out"], before, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    rest = lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(found) > 0, F.aggregate(found, start, step, rest)).otherwise(text)
