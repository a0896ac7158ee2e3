"""Token counts per section of a text, by character spans.

A text is encoded once and whole, so its tokens are those a model will see. Sections are spans of
characters; tokens and sections are both in order, so one merge joins them. A token that touches
several sections is counted for one of them by the chosen rule:

``start``    the section with its first character
``end``      the section with its last character
``overlap``  the section with most of its characters, the earlier one in a tie

Tokens without a character of their own (a leading space is not part of a span) go by their start.
Sections here are lines: a line owns its line feed. ``count_fields`` does the same for the fields
of a record, put together with a separator that belongs to the field before it.

Defined cases: a null or empty text has no section and gives no row; a section without a token is
a row with 0; repeated rows give repeated results; an empty table gives an empty result. Columns
other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerloom.llm.byte_bpe import encoder

RULES = ("start", "end", "overlap")
COUNTS = (
    "doc_id long, section int, start long, n_chars long, n_tokens long, n_crossing long"
)


def allocate(spans: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token, and whether the token touches several.

    ``starts``: first character of each section, ascending from 0; a section ends where the next
    begins.
    """
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.searchsorted(starts, np.maximum(spans[:, 1] - 1, spans[:, 0]), "right") - 1
    crossing = last > first
    if rule == "start":
        return first, crossing
    if rule == "end":
        return last, crossing
    owner = first.copy()
    for k in np.flatnonzero(crossing).tolist():
        a, b = spans[k]
        held = np.arange(first[k], last[k] + 1)
        ends = np.append(starts[held[1:]], b)
        owner[k] = held[np.argmax(np.minimum(ends, b) - np.maximum(starts[held], a))]
    return owner, crossing


def line_starts(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.flatnonzero(codes == 10) + 1
    return np.concatenate([[0], ends[ends < len(codes)]]).astype(np.int64)


def _rows(doc, text: str, spans: np.ndarray, starts: np.ndarray, rule: str) -> list[np.ndarray]:
    n = len(starts)
    owner, crossing = allocate(spans, starts, rule)
    tokens = np.bincount(owner, minlength=n)
    crossed = np.bincount(owner[crossing], minlength=n)
    return [np.arange(n), starts, np.diff(np.append(starts, len(text))), tokens, crossed]


def _counter(tokenizer: str, rule: str, sections):
    if rule not in RULES:
        raise ValueError(f"rule must be one of {', '.join(RULES)}")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer, spans=True)
        names = ["doc_id", "section", "start", "n_chars", "n_tokens", "n_crossing"]
        types = [pa.int32(), *[pa.int64()] * 4]
        for batch in batches:
            texts, starts = sections(batch)
            docs = batch.column("doc_id").cast(pa.int64())
            owners, parts = [], []
            for k, (text, at, spans) in enumerate(zip(texts, starts, code.run(pa.array(texts, pa.string())))):
                if text:
                    parts.append(_rows(k, text, spans, at, rule))
                    owners.append(np.full(len(at), k))
            if parts:
                columns = [pa.array(np.concatenate(c), t) for c, t in zip(zip(*parts), types)]
                yield pa.record_batch([docs.take(pa.array(np.concatenate(owners))), *columns], names=names)

    return count


def count_lines(
    docs: DataFrame,
    tokenizer: str,
    rule: str = "overlap",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per line of each text: ``start`` and ``n_chars`` in characters, ``n_tokens``, and
    ``n_crossing`` of them that touch another line too. No shuffle."""

    def sections(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        return texts, [line_starts(t) for t in texts]

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return picked.mapInArrow(_counter(tokenizer, rule, sections), COUNTS)


def count_fields(
    records: DataFrame,
    fields: Sequence[str],
    tokenizer: str,
    rule: str = "overlap",
    separator: str = "\n",
    id_col: str = "doc_id",
) -> DataFrame:
    """One row per field (``section`` is its number) of each record; a null field is empty."""

    def sections(batch):
        texts, starts = [], []
        for values in zip(*(batch.column(f"field{k}").to_pylist() for k in range(len(fields)))):
            parts = [(v or "") + separator for v in values[:-1]] + [values[-1] or ""]
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            texts.append("".join(parts))
            starts.append(np.cumsum(sizes) - sizes)
        return texts, starts

    picked = records.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *(F.col(f).cast("string").alias(f"field{k}") for k, f in enumerate(fields)),
    )
    return picked.mapInArrow(_counter(tokenizer, rule, sections), COUNTS)
