"""JSON terms, routing, similarity of texts, and the seeded shuffle."""

from difflib import SequenceMatcher

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyloom.functions.numeric import mixed, uniform
from tallyloom.functions.similarity import _shared
from tallyloom.functions.text import first_json_string
from tallyloom.sources.dictionaries import TERM_KEYS, bucket_of, json_terms


def test_first_json_string(spark):
    docs = {
        '{"name": 5, "x": "aa"}': "aa", '{"name": {"a": "no"}, "z": "zz", "b": "bb"}': "zz", '{"o": {"text": "nested"}, "t": "top"}': "top",
        '{"q": "\\u0438\\u044f"}': "ия", '{"x": "first", "word": " w "}': "w", '{"name": "  ", "n": null, "l": ["s"]}': None, "[1]": None, "broken {": None,
    }
    df = spark.createDataFrame([(d,) for d in docs], "doc string")
    got = {r[0]: r[1] for r in df.select("doc", first_json_string(F.col("doc"), TERM_KEYS)).collect()}
    assert got == docs


def test_routing_looks_below_the_root(spark, tmp_path):
    root = tmp_path / "surnames" / "lists"
    for name, term in (("midnames.jsonl", "Ким"), ("all_surnames.jsonl", "Ли"), ("names.jsonl", "Ян"), ("other.jsonl", "Петрович"), ("rest.jsonl", "Анна")):
        (root / "x").mkdir(parents=True, exist_ok=True)
        (root / "x" / name).write_text('{"value": "%s"}' % term, encoding="utf-8")
    terms = json_terms(spark, str(root / "x"), str(root))
    got = {r[0]: r[1] for r in terms.select("term", bucket_of(F.col("file"), F.col("term"))).collect()}
    assert sorted(got.values()) == ["name", "name", "patronymic", "patronymic", "surname"]


@settings(max_examples=200, deadline=None)
@given(st.text("abcd", max_size=12), st.text("abcd", max_size=12))
def test_shared_letters(a, b):
    assert _shared(a, b) == sum(m.size for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


def test_shuffle_is_no_lattice(spark):
    df = spark.range(5000)
    orders = {s: [r[0] for r in df.orderBy(mixed(F.col("id"), s), "id").collect()] for s in (42, 43)}
    strides = {b - a for a, b in zip(orders[42], orders[42][1:])}
    assert len(strides) > 2500
    moved = sum(a in (b, b + 1, b - 1) for a, b in zip(orders[42], orders[43]))
    assert moved < 20
    mean, spread = df.agg(F.avg(uniform(F.col("id"), 1)), F.stddev(uniform(F.col("id"), 1))).first()
    assert abs(mean - 0.5) < 0.02 and abs(spread - 0.2887) < 0.01
