"""Tokens of a public vocabulary: how many a text has, and the part of it that the first so many make.

A vocabulary is a file: ranks (*.tiktoken), a tokenizer's JSON (*.json) or a sentencepiece model (*.model). Each worker loads
it once. Characters can't bound tokens across scripts, so inputs of a model with a limit are cut by tokens, and where a cut
falls is told in characters of the text: a character of which the limit would split the bytes goes.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

#: Fixed value: how byte-level rank files part a text before its merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CAPPED = "struct<text:string,n_tokens:long,kept_tokens:long>"


def _whole(text: str, at: np.ndarray) -> list[int]:
    """How many whole characters end up to each of these bytes."""
    inside = np.append((np.frombuffer(text.encode("utf-8"), np.uint8) & 0xC0) == 0x80, False)  # bytes within a character
    begun = np.append(0, np.cumsum(~inside[:-1]))
    return (begun[at] - inside[at]).tolist()


class Ranks:
    """A file of byte strings in base 64 with their ranks."""

    def __init__(self, path: str, pattern: str = PATTERN):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(None, map(bytes.strip, f)))}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def ends(self, text: str) -> list[int]:
        """Up to which character each token reaches whole ones."""
        sizes = [len(token) for token in self.encoding.decode_tokens_bytes(self.encoding.encode_ordinary(text))]
        return _whole(text, np.cumsum(sizes, dtype=np.int64))


class Json:
    """A tokenizer's JSON, without its special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)

    def ends(self, text: str) -> list[int]:
        reach, out, spans = 0, [], self.tokenizer.encode(text, add_special_tokens=False).offsets
        for i, (a, b) in enumerate(spans):
            split = i + 1 < len(spans) and spans[i + 1][0] < b  # the next token has bytes of the same character
            reach = max(reach, a if split else b)
            out.append(reach)
        return out


class Pieces:
    """A sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def ends(self, text: str) -> list[int]:
        ends = [piece.end for piece in self.model.encode(text, return_type="proto").pieces]
        return _whole(text, np.maximum.accumulate(np.array(ends, np.int64)))


@lru_cache(maxsize=8)
def vocabulary(path: str) -> Ranks | Json | Pieces:
    kinds = {".tiktoken": Ranks, ".json": Json, ".model": Pieces}
    for suffix, kind in kinds.items():
        if path.endswith(suffix):
            return kind(path)
    raise ValueError(f"{path}: a vocabulary ends in one of {', '.join(kinds)}")


def capped(text: Column | str, most: int, path: str) -> Column:
    """text (whole if it has no more than `most` tokens, else cut), n_tokens of the whole text, kept_tokens. Null is an empty text."""
    if most < 0:
        raise ValueError("a cap is 0 or more")

    @F.pandas_udf(CAPPED)
    def cap(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = vocabulary(path)
        for texts in batches:
            rows = []
            for t in texts:
                ends = known.ends(t)
                rows.append((t if len(ends) <= most else t[: ends[most - 1] if most else 0], len(ends), min(most, len(ends))))
            yield pd.DataFrame(rows, columns=["text", "n_tokens", "kept_tokens"])

    return cap(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))
