"""SentencePiece encoding and decoding over a table of distinct marked words."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from ledgerlane.llm.common import give_back

MARK = "▁"

# What usual normalizers change: compatibility characters, wide letters, combining marks, runs of spaces.
PROBE = "a  ﬁ ½ Ａ ２ e\u0301 Å \u00a0x\u3000 ①"

# A worker's table is emptied when it holds this many chunks; each is then segmented again when met.
TABLE_CHUNKS = 100_000

# Texts that are Python strings at a time.
STRINGS = 500


class ChunkTable:
    """Segments each distinct chunk once and joins ids and surfaces back by position.

    A chunk is a run of space marks with the characters up to the next mark or line
    feed, or a run of line feeds with what follows. No piece of the vocabulary
    may reach from a character into a following mark, or hold a line feed beside
    another character, and the model's normalizer must leave texts as they are; the constructor checks
    all three, and then segmenting chunk by chunk equals segmenting the whole text.
    """

    def __init__(self, model_file: str, size: int = TABLE_CHUNKS):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.size = size
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces cross space marks: chunks cannot be segmented alone")
        if any("\n" in p for p in pieces):
            raise ValueError("pieces cross line feeds: chunks cannot be segmented alone")
        if self.model.decode(self.model.encode(PROBE, num_threads=1)) != PROBE:
            raise ValueError("the model's normalizer changes texts: chunks cannot be cut before it")
        # What a piece stands for, in bytes; without fixed pieces, decoding is joining these.
        self.surface = [self._bytes_of(i, p) for i, p in enumerate(pieces)]
        self.lengths = np.array([len(x) for x in self.surface], np.int64)
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|\n+[^{MARK}\n]*")
        self._empty()

    def _empty(self) -> None:
        self.counts: dict[str, int] = {}
        self.ids: dict[str, str] = {}
        self.surfaces: dict[str, str] = {}

    def _bytes_of(self, number: int, piece: str) -> bytes:
        if self.model.is_byte(number):
            return bytes([int(piece[1:-1], 16)])
        return b"" if self.model.is_control(number) else piece.replace(MARK, " ").encode()

    def _learn(self, chunks: list[str]) -> None:
        """Segment new chunks in one text, a line feed before each, and cut the ids there.

        A line feed is one piece of its own, so nothing joins across; the mark that the model
        sets before the text stands alone and is dropped.
        """
        ids = self.model.encode("\n" + "\n".join(chunks), num_threads=1)[1:]
        sizes = np.array([len(c.replace(MARK, " ").encode()) + 1 for c in chunks], np.int64)
        at = np.cumsum(self.lengths[np.array(ids, np.int64)])
        ends = np.searchsorted(at, np.cumsum(sizes)) + 1
        numbers = list(map(str, ids))
        shown = list(map(self.surface.__getitem__, ids))
        first = 0
        for chunk, end in zip(chunks, ends.tolist(), strict=True):
            first += 1
            self.counts[chunk] = end - first
            self.ids[chunk] = ",".join(numbers[first:end])
            self.surfaces[chunk] = b"".join(shown[first:end]).decode()
            first = end

    def chunks(self, text: str) -> list[str]:
        return self.cut.findall(MARK + text.replace(" ", MARK)) if text else []

    def convert(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text."""
        chunks = self.chunks(text)
        new = set(chunks).difference(self.counts)
        if new:
            if len(self.counts) + len(new) > self.size:
                self._empty()
                new = set(chunks)
            self._learn(list(new))
        decoded = "".join(map(self.surfaces.__getitem__, chunks))
        return (
            sum(map(self.counts.__getitem__, chunks)),
            ",".join(map(self.ids.__getitem__, chunks)),
            decoded[1:] if decoded.startswith(" ") else decoded,
        )


@lru_cache(maxsize=2)
def _table(model_file: str) -> ChunkTable:
    return ChunkTable(model_file)


def _converted(model_file: str, finish: Callable, schema: pa.Schema) -> Callable:
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for batch in batches:
            texts = batch.column("text")
            rows = [
                finish(*table.convert(t or ""))
                for first in range(0, len(texts), STRINGS) for t in texts.slice(first, STRINGS).to_pylist()
            ]
            found = zip(*rows, strict=True) if rows else [[]] * (len(schema) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(schema.field(0).type)]
                + [pa.array(list(c), f.type) for c, f in zip(found, list(schema)[1:], strict=True)],
                schema=schema,
            )
            # Else they would be held while the next batch is read.
            del batch, texts, rows, found
            give_back()

    return convert


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digests(count: int, ids: str, decoded: str) -> tuple[int, str, str]:
    return count, _sha256(ids), _sha256(decoded)


def _full(count: int, ids: str, decoded: str) -> tuple[int, list[int], str]:
    return count, [int(i) for i in ids.split(",")] if ids else [], decoded


def encode_decode(docs: DataFrame, model_file: str) -> DataFrame:
    """Ids and decoded text of each whole text: doc_id, n_tokens, ids, decoded.

    A null text counts as empty and has no ids. Each row is handled alone, so ties and
    repeated rows need no rule, and whole: a text of many megabytes is one task's memory (many times
    its size). Other columns are ignored.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    return docs.select("doc_id", "text").mapInArrow(
        _converted(model_file, _full, schema),
        "doc_id long, n_tokens long, ids array<int>, decoded string",
    )


def encode_decode_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """As encode_decode, with SHA-256 of the comma-joined ids and of the decoded text instead."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return docs.select("doc_id", "text").mapInArrow(
        _converted(model_file, _digests, schema),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
