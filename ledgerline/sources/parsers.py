"""Parameter files and XML of unknown shape as VARIANT: small parsers of one text each, run in Arrow batches."""

from __future__ import annotations

import json
import re
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_size = re.compile(r"\(\s*[0-9]+(?:\s*,\s*[0-9]+)*\s*\)")
_number = re.compile(r"[-+]?(?:[0-9]+(?P<real>\.[0-9]*)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?")


def scalar(text: str):
    """An integer, a finite real or the text itself, without the signs around a string."""
    text = text.strip()
    if _number.fullmatch(text):
        value = float(text)
        return int(text) if re.fullmatch(r"[-+]?[0-9]+", text) else value if abs(value) < float("inf") else text
    return text[1:-1] if len(text) > 1 and text[0] == "<" and text[-1] == ">" else text


def pieces(value: str) -> list | None:
    """Strings and tuples of a value that consists of nothing else, else None.

    One pass over its characters. The state is what is open: strings may hold strings and any other sign, a tuple holds fields between
    commas, whose brackets belong to them.
    """
    found, opened, text, fields = [], [], [], []
    for c in value:
        within = opened[-1] if opened else ""
        if not within:
            if c in "<(":
                opened, text, fields = [c], [], []
            elif not c.isspace():
                return None
        elif c == "<" or (c == "(" and within == "("):
            opened.append(c)
            text.append(c)
        elif c == (">" if within == "<" else ")"):
            opened.pop()
            if opened:
                text.append(c)
            else:
                found.append("".join(text) if within == "<" else [scalar(x) for x in [*fields, "".join(text)]] if fields or text else [])
        elif c == "," and opened == ["("]:
            fields.append("".join(text))
            text = []
        else:
            text.append(c)
    return None if opened else found


def value_of(lines: list[str]):
    """A record's value: strings and tuples are themselves, one or a list of them; after a size, words are a list; else it is a scalar or a text."""
    sized = bool(lines) and _size.fullmatch(lines[0].strip()) is not None
    value = "\n".join(lines[sized:]).strip()
    found = pieces(value) if value[:1] in ("<", "(") else None
    if found is None:
        found = [scalar(x) for x in value.split()] if sized else [scalar(value) if " " not in value else value]
    return found[0] if len(found) == 1 else found or ""


def parameters(text: str) -> dict:
    """The records of a parameter file: ##KEY= or ##$KEY= begins one, which lasts to the next; lines of comment ($$) are left out; ##END ends the record before it. Of a key that is given again the last counts."""
    found, key, lines = {}, None, []
    for line in text.splitlines():
        if line.startswith("$$"):
            continue
        if line.startswith("##"):
            if key is not None:
                found[key] = value_of(lines)
            name, equals, rest = line[2:].partition("=")
            key, lines = (name.strip().removeprefix("$") if equals and not name.startswith("END") else None), [rest] * bool(rest.strip())
        elif line.strip():
            lines.append(line)
    if key is not None:
        found[key] = value_of(lines)
    return found


def document(text: str):
    """What the first element inside the root of an XML text holds: elements by name, several of one name as a list, text where
    there are no elements. {} for a text that is no XML. Elements are kept on a stack of our own, so depth is no matter."""
    first, stack, parser = {}, [], expat.ParserCreate()

    def start(name, _):
        stack.append((name, {}, []))

    def end(_):
        name, held, text = stack.pop()
        value = {k: v[0] if len(v) == 1 else v for k, v in held.items()} or "".join(text).strip()
        if stack:
            stack[-1][1].setdefault(name, []).append(value)
        if len(stack) == 1:
            first.setdefault("value", value)

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler = lambda data: stack[-1][2].append(data)
    try:
        parser.Parse(text, True)
    except expat.ExpatError:
        return {}
    return first.get("value", {})


def _as_variant(parse, text: Column) -> Column:
    @F.pandas_udf("string")
    def parsed(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: json.dumps(parse(x or ""), ensure_ascii=False))

    return F.try_parse_json(parsed(text))


def parameter_records(text: Column) -> Column:
    """``parameters`` of a text as VARIANT; null and blank texts have none."""
    return _as_variant(parameters, text)


def xml_document(text: Column) -> Column:
    """``document`` of a text as VARIANT."""
    return _as_variant(document, text)
