"""Text sizes in tokens of a public tokenizer, whose file is a parameter."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Environment variable and default place of the tokenizer's ranks.
TOKENIZER = os.environ.get("STEMFORGE_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.tiktoken")


@lru_cache(2)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(column: Column, path: str = TOKENIZER) -> Column:
    """Tokens of the whole text; null and empty texts have 0. Strings of special tokens count as ordinary text."""

    def count(s: pd.Series) -> pd.Series:
        encode = _encoding(path).encode_ordinary
        return s.map(lambda x: len(encode(x)) if x else 0).astype("int64")

    return F.pandas_udf(count, T.LongType())(column)
