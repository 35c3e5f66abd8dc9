"""Token counts under a public tokenizer."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import functions as F

from tarnlake.functions.fixed import SPLIT_PATTERN

#: Where the vocabulary files lie; a parameter everywhere, never part of the repository.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def encoder(path: str = VOCABULARY):
    """The encoder of a rank file, loaded once per Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=SPLIT_PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens_udf(path: str = VOCABULARY):
    """Column function: number of tokens of a text; 0 for null and empty ones."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        e = encoder(path)
        return pd.Series([len(e.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return run
