"""Token counts of a document's sections, from one encoding of the whole document."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = ("first", "last", "most")

SCHEMA = (
    "doc_id long, section int, start_byte long, end_byte long, n_tokens long, n_crossing long"
)
_ARROW = pa.schema([("doc_id", pa.int64()), ("section", pa.int32()), ("start_byte", pa.int64()),
                    ("end_byte", pa.int64()), ("n_tokens", pa.int64()), ("n_crossing", pa.int64())])


@lru_cache(maxsize=2)
def _encoder(rank_file: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoder, and the byte length of each token."""
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    encoding = tiktoken.Encoding(
        "given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding, lengths


def allocate(
    token_ends: np.ndarray, section_starts: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Join token spans with section spans: the section of each token, and whether it crosses.

    Both sides lie end to end from byte 0, so an interval join is two searches in the
    sorted section starts. A token that reaches into several sections belongs to that of
    its first byte ("first"), of its last byte ("last"), or to the one that holds
    most of its bytes ("most", the earliest of equals).
    """
    token_starts = np.append(0, token_ends)[:-1]
    low = np.searchsorted(section_starts, token_starts, side="right") - 1
    high = np.searchsorted(section_starts, token_ends - 1, side="right") - 1
    crossing = low != high
    owner = high if rule == "last" else low.copy()
    if rule == "most":
        for i in np.flatnonzero(crossing):
            cuts = np.concatenate(
                ([token_starts[i]], section_starts[low[i] + 1 : high[i] + 1], [token_ends[i]])
            )
            owner[i] = low[i] + int(np.argmax(np.diff(cuts)))
    return owner, crossing


def line_starts(text: bytes) -> np.ndarray:
    """First byte of each line; a line keeps its line feed."""
    feeds = np.flatnonzero(np.frombuffer(text[:-1], np.uint8) == 10)
    return np.concatenate(([0], feeds + 1))


_SENTENCE_END = re.compile(rb"[.!?]+[\"')\]]*[ \t\r\n]+|\n+")


def sentence_starts(text: bytes) -> np.ndarray:
    """First byte of each sentence; a sentence keeps the white space after it.

    Tokens begin with the space before a word, so the first token of most sentences crosses a border.
    """
    ends = [m.end() for m in _SENTENCE_END.finditer(text) if m.end() < len(text)]
    return np.array([0, *ends], np.int64)


def section_tokens(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    sections: Column | None = None,
    rule: str = "most",
    starts_of: Callable[[bytes], np.ndarray] = line_starts,
) -> DataFrame:
    """Count the tokens of each section: one row for each section of each document.

    `sections` gives the first bytes of a document's sections (ascending, the
    first is 0) as array<int>; a section ends where the next begins. Without it, `starts_of` cuts a
    text: into lines, or by `sentence_starts` into sentences. The whole text is encoded once; tokens carry every byte, so their
    running lengths are their offsets.
    The counts of a document's sections add up to its token count. A null or
    empty text, or null sections, has one section of the whole text. Rows are handled
    one by one, each whole: a text of many megabytes is one task's memory (many times its size).
    Other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")

    by_column = sections is not None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, lengths = _encoder(rank_file, pattern)
        for batch in batches:
            numbers, starts, ends, tokens, crossings, rows = [], [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for text, given in zip(texts, batch.column("sections"), strict=True):
                ids = np.array(encoding.encode_ordinary(text or ""), np.int64)
                token_ends = np.cumsum(lengths[ids])
                size = int(token_ends[-1]) if len(ids) else 0
                if not by_column:
                    first = starts_of((text or "").encode())
                else:
                    first = np.array(given.as_py() or [0], np.int64)
                owner, crossing = allocate(token_ends, first, rule)
                numbers.append(np.arange(len(first), dtype=np.int32))
                starts.append(first)
                ends.append(np.append(first[1:], size))
                tokens.append(np.bincount(owner, minlength=len(first)))
                crossings.append(np.bincount(owner[crossing], minlength=len(first)))
                rows.append(len(first))
            if not rows:
                continue
            doc_ids = batch.column("doc_id").take(pa.array(np.repeat(np.arange(len(rows)), rows)))
            columns = [np.concatenate(c) for c in (numbers, starts, ends, tokens, crossings)]
            yield pa.RecordBatch.from_arrays(
                [doc_ids.cast(pa.int64()), *(pa.array(c) for c in columns)], schema=_ARROW
            )

    given = F.lit(None).cast("array<int>") if sections is None else sections
    return docs.select("doc_id", "text", given.alias("sections")).mapInArrow(count, SCHEMA)
