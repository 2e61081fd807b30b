"""Cleaning text, keys, names and identifiers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ILLEGAL = '[\\\\/:*?"<>|]'
CONTROL = "[\\x00-\\x1F]"
NULL_ALIASES = ("", "none", "null")


def strip(c: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(c, "(?U)^\\s+|\\s+$", "")


def is_na(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit("")))).isin("", "NA")


def is_gap(c: Column) -> Column:
    """Null, blank, NA or a <placeholder>."""
    return is_na(c) | strip(F.coalesce(c, F.lit(""))).rlike("^<.*>$")


def clean_text(c: Column) -> Column:
    """No-break spaces as spaces, runs of white space as one, none at the ends; null as empty."""
    return strip(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "\\u00A0", " "), "(?U)\\s+", " "))


def split_header(c: Column) -> Column:
    """struct(name, description): a header cell cut at its first quote, if a name stands before it."""
    text = clean_text(c)
    name = strip(F.regexp_extract(text, '^([^"“”]*)["“”]', 1))
    rest = F.regexp_extract(text, '^[^"“”]*["“”](.*)$', 1)
    described = F.nullif(strip(F.regexp_replace(strip(rest), '^["“”]+|["“”]+$', "")), F.lit(""))
    return F.when(name != "", F.struct(name.alias("name"), described.alias("description"))).otherwise(F.struct(text.alias("name"), F.lit(None).cast("string").alias("description")))


def key_transform(c: Column, how: str) -> Column:
    """A join key brought to the other side's form: decimal2, first_token, strip_prefix:P, lower, upper, strip or none."""
    if how == "decimal2":
        return F.format_string("%.2f", c.cast("double"))
    text = c.cast("string")
    if how == "first_token":
        return F.regexp_extract(text, "(?U)^\\s*(\\S*)", 1)
    if how.startswith("strip_prefix:"):
        prefix = how.split(":", 1)[1]
        return F.when(F.startswith(text, F.lit(prefix)), F.substring(text, len(prefix) + 1, (1 << 31) - 1)).otherwise(text) if prefix else text
    known = {"lower": F.lower, "upper": F.upper, "strip": strip, "": clean_text}
    if how not in known:
        raise ValueError(f"unknown transform {how!r}")
    return known[how](text)


def normalize_name(c: Column) -> Column:
    return F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "(?U)\\s+", "-")


def name_errors(c: Column, longest: int = 60) -> Column:
    """What forbids the name as one part of a path; an empty array if nothing does."""
    name = F.coalesce(c, F.lit(""))
    rules = [
        F.when(name.rlike(ILLEGAL), "illegal character"),
        F.when(name.rlike(CONTROL), "control character"),
        F.when(name.rlike("^[ .]|[ .]$"), "space or dot at an end"),
        F.when(F.char_length(name) > longest, "too long"),
    ]
    return F.when(name == "", F.array(F.lit("empty"))).otherwise(F.array_compact(F.array(*rules)))


def sanitize_name(c: Column, fallback: Column | None = None) -> Column:
    """The last part of a path without illegal and control characters, outer spaces and dots; else ``fallback``."""
    path = F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("\\"), F.lit("/")), "/+$", "")
    name = F.regexp_replace(F.regexp_replace(F.substring_index(path, "/", -1), ILLEGAL, ""), CONTROL, "")
    name = F.regexp_replace(strip(name), "^[.]+|[.]+$", "")
    return name if fallback is None else F.coalesce(F.nullif(name, F.lit("")), fallback)


#: Letters with accents of Latin-1 and Latin Extended-A, and what is left of each without them.
_accented = {chr(c): plain for c in range(0xC0, 0x180) if len(plain := unicodedata.normalize("NFKD", chr(c)).encode("ascii", "ignore").decode()) == 1}


@F.pandas_udf(T.StringType())
def _decomposed(names: pd.Series) -> pd.Series:
    """Compatibility decomposition without what is not ASCII; Spark has none."""
    return names.map(lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode(), na_action="ignore")


def slug(c: Column, any_script: bool = False) -> Column:
    """Letters and digits of ASCII in lower case, what lies between as one hyphen; accents go; 'unnamed' if nothing is left.

    Letters up to U+017F lose their accents by a table; other characters beyond ASCII are dropped, or with ``any_script``
    decomposed first, in Python.
    """
    text = F.coalesce(c, F.lit(""))
    plain = _decomposed(text) if any_script else F.regexp_replace(F.translate(text, "".join(_accented), "".join(_accented.values())), "[^\\x00-\\x7F]", "")
    return F.coalesce(F.nullif(F.btrim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", "-"), F.lit("-")), F.lit("")), F.lit("unnamed"))


def unc_path(host: str, share: str, path: Column) -> Column:
    tail = F.regexp_replace(F.regexp_replace(path, "^/+", ""), "/+$", "")
    return F.concat(F.lit(f"\\\\{host}\\{share}\\"), F.replace(tail, F.lit("/"), F.lit("\\")))


def strip_unit(c: Column, *units: str) -> Column:
    text = strip(c)
    return strip(F.regexp_replace(text, "(?:" + "|".join(f"\\Q{u}\\E" for u in units) + ")$", ""))


def short_code(c: Column) -> Column:
    """struct(code, organ) of codes such as m13, ID13B or 14; nulls where there is no number."""
    text, pattern = strip(F.coalesce(c, F.lit(""))), "^(?i:id|m)?0*([0-9]+)([A-Za-z]+)?$"
    organ = F.nullif(F.regexp_extract(text, pattern, 2), F.lit(""))
    return F.struct(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long").alias("code"), organ.alias("organ"))


def alias_from_name(c: Column, stem: str) -> Column:
    """What follows ``stem`` and a hyphen, in any case; else the last part after a hyphen; else the name."""
    text, pattern = strip(F.coalesce(c, F.lit(""))), f"^(?i:\\Q{stem}\\E)-(.+)$"
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1)).otherwise(F.substring_index(text, "-", -1))


def compose_id(code: Column, alias: Column, stem: str) -> Column:
    """code-stem-alias; null where the alias says nothing, so that no two animals share an id."""
    alias = strip(F.coalesce(alias, F.lit("")))
    return F.when(~F.lower(alias).isin(*NULL_ALIASES), F.concat_ws("-", code.cast("long").cast("string"), F.lit(stem), alias))


def parse_id(c: Column, stem: str) -> Column:
    """struct(alias, code) of a whole id, nulls for anything else."""
    text, pattern = strip(F.coalesce(c, F.lit(""))), f"^([0-9]+)-\\Q{stem}\\E-([0-9]+)$"
    return F.struct(F.nullif(F.regexp_extract(text, pattern, 2), F.lit("")).alias("alias"), F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("long").alias("code"))


def null_alias(c: Column, stem: str) -> Column:
    """The alias of an id of ours that says nothing ('', none, null in any case), else null; also where no code stands before the stem."""
    words, coded = "|".join(sorted(NULL_ALIASES, key=len, reverse=True)), f"[0-9]+-\\Q{stem}\\E-"
    pattern = f"(?isU)^(?:{coded}\\s*|(?!{coded}).*-\\Q{stem}\\E-)({words})$"
    text = strip(F.coalesce(c, F.lit("")))
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))


def mapped(c: Column, words: dict[str, str], otherwise: Column | str | None = None) -> Column:
    """``c`` by a vocabulary, ignoring case and outer space; unknown words stay unless ``otherwise`` is given."""
    key, found = F.lower(strip(F.coalesce(c, F.lit("")))), None
    for word, value in words.items():
        found = F.when(key == word, value) if found is None else found.when(key == word, value)
    return found.otherwise(c if otherwise is None else otherwise)


def first_marker(c: Column, markers: list[str]) -> Column:
    """The first of ``markers`` that the text holds, in their order."""
    return F.coalesce(*(F.when(F.contains(F.lower(c), F.lit(m.lower())), m) for m in markers))
