"""Sizes of texts in tokens of a public tokenizer.

A tokenizer is a file of ranks, one token in base 64 and its rank a line, as published for byte-level BPE; its path is a
parameter and must be readable by every executor. How text is split before BPE is the pattern that comes with those files.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    try:
        from public_tokenizers import PATTERN
    except ImportError as e:
        raise RuntimeError("the module public_tokenizers, which holds the tokenizers' split pattern, must be on the Python path of the executors") from e
    if not os.path.exists(path):
        raise FileNotFoundError(f"no tokenizer at {path}: give the path of a rank file that every executor can read")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _counter(path: str):
    def run(batches):
        encode = _encoding(path).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column("text").to_pylist()]
            at = b.schema.names.index("text")
            yield b.set_column(at, "n_tokens", pa.array(n, pa.int64()))

    return run


def with_token_counts(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``df`` with the text column replaced by ``n_tokens``; null and empty texts have 0. ``tokenizer``: path of a rank file."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != text]
    rows = df.select(*rest, F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes if c != "text")
    return rows.mapInArrow(_counter(tokenizer), f"{kinds}, n_tokens long")
