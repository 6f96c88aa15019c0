"""Sizes in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], list[int]]:
    """Text → ids, by the kind of file; special tokens in a text are ordinary text."""
    if path.endswith(".tiktoken"):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: model.encode(text, num_threads=1)
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids


def token_counts(docs: DataFrame, keep: list[str], text: str, path: str = DEFAULT) -> DataFrame:
    """``keep`` and n_tokens; null and empty texts have 0 tokens."""
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            n = pa.array([len(encode(t)) if t else 0 for t in batch.column(len(keep)).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], n], names=[*keep, "n_tokens"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(work, f"{kinds}, n_tokens long")
