"""Token counts under a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# fixed value: the pre-splitting pattern that belongs to the vocabulary
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict = {}


def _encoder(ranks: bytes):
    key = hash(ranks)
    if key not in _encoders:
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        _encoders[key] = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
    return _encoders[key]


def token_counts(df: DataFrame, keep: list[str], text: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns ``keep`` and ``n_tokens`` (long) of the whole text; 0 for null and empty texts.

    The vocabulary file is read once by the driver and sent to the workers: it has under 1 MB whatever the data."""
    ranks = df.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks.value).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(n, pa.int64())], names=[*keep, "n_tokens"])

    slim = df.select(*keep, F.col(text).alias("_text"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.schema.fields[:-1]), "n_tokens long"])
    return slim.mapInArrow(count, schema)
