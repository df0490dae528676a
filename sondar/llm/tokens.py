"""Token counts by a public byte-level BPE vocabulary, read by every worker from a path that is a parameter."""

from __future__ import annotations

import base64
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Where the vocabulary lies on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: The published split pattern of byte-level BPE vocabularies of this kind (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space beyond this are cut out before the split pattern, which would take a stack frame a character.
LONG_RUN = 10_000
# workers get these functions themselves: this package need not be installed there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def encoding(path: str = VOCABULARY):
    """The encoder of a vocabulary of ``base64 rank`` lines."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(enc, text: str | None) -> list[int]:
    """The tokens of a text; none of NULL. Texts with very long runs of white space give the same tokens as any other way."""
    if not text:
        return []
    if len(text) < LONG_RUN or not re.search(r"\s{%d}" % LONG_RUN, text):
        return enc.encode_ordinary(text)
    out: list[int] = []
    at = 0
    for m in re.finditer(r"\s{%d,}" % LONG_RUN, text):
        out += enc.encode_ordinary(text[at : m.start()])
        # all of a run but its last sign is one piece, if anything follows
        end = m.end() if m.end() == len(text) else m.end() - 1
        out += enc._encode_single_piece(text[m.start() : end])  # noqa: SLF001
        at = end
    return out + enc.encode_ordinary(text[at:])


def token_count(text: Column, path: str = VOCABULARY) -> Column:
    """The number of tokens of a text column (0 for NULL), in Arrow batches; every task reads the vocabulary once."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoding(path)
        for s in batches:
            yield pd.Series([len(encode(enc, t)) for t in s], dtype="int64")

    return count(text)


def sized(df: DataFrame, key: str, text: str, others: list[str], path: str = VOCABULARY) -> DataFrame:
    """key, ``others`` and tokens: the texts themselves go no further than the scan's stage."""
    return df.select(F.col(key), *others, token_count(F.col(text), path).alias("tokens"))
