"""Numbers of tokens of texts, by a transducer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from chuvisco.llm.shared import slices, table, texts_of
from chuvisco.llm.transducer import STOP, Transducer, normal, symbols_of


@cache
def _compiled(path: str) -> Transducer:
    return Transducer(path)


def count_tokens(path: str, texts: list[str]) -> list[int]:
    """The number of tokens of each text. Strings of special tokens count one each and end what is before them."""
    machine = _compiled(path)
    special = re.compile("|".join(map(re.escape, machine.special))) if machine.special else None
    parts, extra = [], []
    for text in texts:
        pieces = special.split(text) if special and any(s in text for s in machine.special) else [text]
        extra.append(len(pieces) - 1)
        parts.append(b"\xff".join(normal(p).encode("utf-8", "replace") for p in pieces) + b"\xff")
    data = np.frombuffer(b"".join(parts), np.uint8)
    symbols = symbols_of(data)
    total = np.r_[0, np.cumsum(machine.counts(symbols), dtype=np.int64)]
    stops = np.flatnonzero(symbols == STOP) + 1
    ends = stops[np.cumsum([n + 1 for n in extra]) - 1]
    return (np.diff(np.r_[0, total[ends]]) + extra).tolist()


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Bytes and tokens of each whole text, and whether there are more than ``limit`` tokens; a row per row of ``docs``.

    Null texts are empty and have no tokens; null and repeated keys are rows like any other; other columns are not
    looked at. A task's memory holds a few megabytes of text (or one longer text) and tables of bounded size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = pc.fill_null(batch.column("text"), "")
            n = count_tokens(tokenizer, texts.to_pylist())
            sizes = pc.binary_length(texts)
            yield table(_COUNTS, doc_id=batch.column("doc_id"), n_bytes=sizes, n_tokens=n, over_limit=[x > limit for x in n])

    return texts_of(docs, key, text).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
