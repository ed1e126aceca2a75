"""Sizes of texts in tokens of a public tokenizer, and cutting at token borders."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: How the tokenizer splits text before pairing bytes. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Longer texts are encoded in parts, so that no call holds much more than this. Parts end where the tokenizer's own split may end: the count is that of the whole.
PART = 1 << 16
#: A letter followed by a blank and a letter: PATTERN always splits between the letter and the blank.
_BORDER = re.compile(r"(?<=[^\W\d_]) (?=[^\W\d_])")


def _encoding(vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def tokenizer(path: str):
    with open(path, "rb") as f:
        return _encoding(f.read())


def _parts(text: str, part: int) -> Iterator[str]:
    at = 0
    while len(text) - at > part and (border := _BORDER.search(text, at + part)):
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


def count(encoding, text: str, part: int = PART) -> int:
    return sum(len(encoding.encode_ordinary(p)) for p in _parts(text, part))


def with_sizes(docs: DataFrame, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> DataFrame:
    """id, source, n_tokens of every document (id bigint, source, text); a null text has 0 tokens. The texts stay behind.

    A repeated id comes once, with its largest text; a null id doesn't come. The vocabulary (under 1 MB) is read on the driver and sent to the workers.
    """
    with open(path, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoding = _encoding(vocabulary.value)
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "source": b["source"], "n_tokens": [count(encoding, t) if t else 0 for t in b["text"]]})

    rows = docs.where("id is not null").select("id", "source", "text").mapInPandas(of, "id bigint, source string, n_tokens bigint")

    return rows.groupBy("id").agg(F.max_by("source", F.struct("n_tokens", "source")).alias("source"), F.max("n_tokens").alias("n_tokens"))
