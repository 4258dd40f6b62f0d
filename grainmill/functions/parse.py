"""What built-ins can't parse: JSON out of prose, truncated arrays, word-level differences. Arrow-batched."""

from __future__ import annotations

import difflib
import html
import json
import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

_decoder = json.JSONDecoder(strict=False)


def find_json(text: str | None) -> str | None:
    """The longest value that starts at a brace or bracket; none that lies within a broken container."""
    best, at, broken = None, 0, False
    while text and (m := re.compile(r"[\[{]").search(text, at)):
        try:
            _, end = _decoder.raw_decode(text, m.start())
        except ValueError:
            broken, at = True, m.end()
            if best is None and _open_from(text, m.start()):
                return None  # all that follows is a part of it
            continue
        if best is None or end - m.start() > len(best):
            best = text[m.start() : end]
        at = end
    return best


def _open_from(text: str, start: int) -> bool:
    """Whether the container at start is still open at the text's end."""
    depth, quoted, escaped = 0, False, False
    for c in text[start:]:
        if quoted:
            quoted, escaped = (c != '"' or escaped), (c == "\\" and not escaped)
        elif c == '"':
            quoted = True
        elif c in "[{":
            depth += 1
        elif c in "]}":
            depth -= 1
            if depth <= 0:
                return False
    return True


def salvage(text: str | None) -> list[str]:
    """The complete objects of an array that was cut off."""
    out, at = [], (text or "").find("[") + 1
    while text and 0 < at < len(text):
        m = re.compile(r"[\s,]*").match(text, at)
        if m.end() >= len(text) or text[m.end()] != "{":
            break
        try:
            _, end = _decoder.raw_decode(text, m.end())
        except ValueError:
            break
        out.append(text[m.end() : end])
        at = end
    return out


@F.pandas_udf(T.StringType())
def extract_json(texts: pd.Series) -> pd.Series:
    return texts.map(find_json)


@F.pandas_udf(T.ArrayType(T.StringType()))
def salvaged(texts: pd.Series) -> pd.Series:
    return texts.map(salvage)


def json_object(x: Column) -> Column:
    """The extracted value if it is an object."""
    return F.when(F.startswith(extract_json(x), F.lit("{")), extract_json(x))


def scores(x: Column, names: tuple[str, ...] = ("alignment", "realism"), broken: int = 5) -> Column:
    """A struct of whole scores; a missing one is 0, an unreadable text gives `broken` for all."""
    got = F.try_parse_json(x).cast("string")
    one = lambda n: F.when(got.isNull(), broken).otherwise(F.coalesce(F.get_json_object(got, f"$.{n}").try_cast("int"), F.lit(0)))
    return F.struct(*[one(n).alias(n) for n in names])


@F.pandas_udf(T.StringType())
def word_diff(before: pd.Series, after: pd.Series) -> pd.Series:
    """HTML of the words that went and came."""

    def one(a: str | None, b: str | None) -> str:
        x, y = (re.findall(r"\S+|\n+", t or "") for t in (a, b))
        out = []
        for op, i, j, k, m in difflib.SequenceMatcher(None, x, y, autojunk=False).get_opcodes():
            if op == "equal":
                out.append(html.escape(" ".join(x[i:j])))
            else:
                out += [f"<del>{html.escape(' '.join(x[i:j]))}</del>"] * (j > i) + [f"<ins>{html.escape(' '.join(y[k:m]))}</ins>"] * (m > k)
        return " ".join(out)

    return pd.Series([one(a, b) for a, b in zip(before, after)])
