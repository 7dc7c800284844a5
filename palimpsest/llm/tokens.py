"""Token counts by a public tokenizer, Arrow batch by Arrow batch."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vocabulary used where no path is given: the file of this name among the installed public tokenizers.
DEFAULT_VOCABULARY = "byte_bpe_50k.tiktoken"


@lru_cache(maxsize=4)
def _encoding(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(DEFAULT_VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """Tokens of the whole text under a tiktoken vocabulary file; null stays null, an empty text has none."""

    def count(texts: pd.Series) -> pd.Series:
        encode = _encoding(vocabulary).encode_ordinary
        return pd.Series([None if t is None else len(encode(t)) for t in texts], dtype="Int64")

    return F.pandas_udf(count, "long")(text)
