"""Text normalisation as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings that stand for a missing value.
BLANK_WORDS = ["", "nan", "none", "null", "na", "n/a", "-", "_", "?"]
# Letters that make a word count as Cyrillic, and the letters a name may hold.
CYRILLIC = "А-Яа-яЁёІіЇїЄєҐґҚқЎўҲҳӘәӨөҮүҢңҺһІі"
_NAME_LETTERS = f"A-Za-z{CYRILLIC}"


def collapse(text: Column) -> Column:
    """Runs of any Unicode white space become one blank; ends trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def normalize_query(text: Column) -> Column:
    lowered = F.regexp_replace(F.lower(text), "ё", "е")
    return collapse(F.regexp_replace(lowered, r"(?U)[^a-zа-я0-9\s]+", " "))


def normalize_person_name(text: Column) -> Column:
    return F.regexp_replace(F.lower(collapse(text)), "ё", "е")


def normalize_name_surface(text: Column, replace_yo: bool = True) -> Column:
    """Keep letters, hyphens and single blanks; no blanks around hyphens."""
    out = collapse(F.regexp_replace(text, rf"[^{_NAME_LETTERS}\- ]+", " "))
    if replace_yo:
        out = F.translate(out, "Ёё", "Ее")
    for loose in (" - ", "- ", " -"):
        out = F.replace(out, F.lit(loose), F.lit("-"))
    return out


def is_blank(text: Column) -> Column:
    return text.isNull() | F.lower(collapse(text)).isin(*BLANK_WORDS)


def is_cyrillic(text: Column) -> Column:
    return ~is_blank(text) & text.rlike(f"[{CYRILLIC}]")


def _capital(part: Column) -> Column:
    return F.concat(F.upper(F.substring(part, 1, 1)), F.lower(F.substring(part, 2, 1_000_000)))


def title_case_name(text: Column) -> Column:
    """Capitalise every part between blanks and hyphens; blank becomes empty."""
    words = F.split(normalize_name_surface(text), " ")
    titled = F.transform(words, lambda w: F.array_join(F.transform(F.split(w, "-"), _capital), "-"))
    return F.when(is_blank(text), F.lit("")).otherwise(F.array_join(titled, " "))


def clean_fingerprint_text(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^а-яёa-z0-9]", "")


def keyword_flag(text: Column, keyword: str) -> Column:
    return F.coalesce(F.contains(text, F.lit(keyword)), F.lit(False)).cast("int")


def word_count(text: Column) -> Column:
    """Pieces between single blanks; the empty text has one."""
    return F.size(F.split(text, " "))


def first_json_string(doc: Column, keys: list[str]) -> Column:
    """First non-blank top-level string among ``keys``, else the first non-blank top-level string in document order.

    Numbers, objects and nested strings never count; escapes are decoded.
    """
    values = F.try_parse_json(doc).try_cast("map<string,variant>")
    names = F.json_object_keys(doc)

    def text(name: Column) -> Column:
        value = F.try_element_at(values, name)
        found = F.trim(value.try_cast("string"))
        return F.when((F.schema_of_variant(value) == "STRING") & (found != ""), found)

    named = [text(F.lit(k)) for k in keys]
    rest = F.filter(F.transform(names, text), lambda v: v.isNotNull())
    return F.coalesce(*named, F.get(rest, F.lit(0)))


def suffix_is(text: Column, suffixes: list[str]) -> Column:
    found = F.lit(False)
    for s in suffixes:
        found = found | F.endswith(text, F.lit(s))
    return found
