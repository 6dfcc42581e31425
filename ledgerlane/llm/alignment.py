"""How two tokenizers cut the same texts: aligned groups, and counts of linked token pairs by external merging.

1. A task encodes the texts of a slice (chunk) with both tokenizers. Byte offsets where a token of A and
   one of B end cut them into groups; tokens whose bytes overlap are linked.
2. The chunk's pair-document records, in order of (A id, B id, document), are written as compressed
   columns. Of each pair, the number of the chunk's documents goes into a run: radix-partitioned by the
   A id, sorted, cut into blocks, compressed by zstd.
3. Spark sorts the blocks of a partition by their first pair (on disk where it must). A task takes them in
   that order and merges them through a heap: pairs below the first pair of the next block are complete.
   Order is by A id first, so an A id's highest count is known as soon as its pairs are counted, and what
   each pair contributes (its count, and whether that is the highest) streams back to the chunks.
4. A chunk sums the contributions of its records by document.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import byte_slices, shuffle_width, stored
from ledgerlane.llm.piece_chunks import MARK

# Texts that one chunk holds, in bytes about, and pairs that one block of a run holds, at most.
CHUNK_BYTES = 4 << 20
BLOCK_PAIRS = 4096
# Pairs that a merge gathers before it counts those that are complete.
HELD_PAIRS = 1 << 20


@dataclass(frozen=True)
class Vocabularies:
    """Files of a byte-level BPE (A: ranks and the pattern that parts words) and of a SentencePiece model (B)."""

    rank_file: str
    pattern: str
    model_file: str


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """values[s : s + n] of each start and size, one after the other."""
    before = np.cumsum(sizes) - sizes
    return values[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]


class Spelling:
    """The bytes of each id, laid end to end."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.raw = np.frombuffer(b"".join(tokens), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        return gathered(self.raw, self.starts[ids], self.sizes[ids])

    def wrong(self, ids: np.ndarray, counts: np.ndarray, raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which texts their ids, joined, do not spell; `raw` holds the texts' bytes, up to `ends`."""
        text = np.repeat(np.arange(len(counts)), counts)
        lengths = np.bincount(text, self.sizes[ids], minlength=len(counts)).astype(np.int64)
        starts = np.append(0, ends[:-1])
        wrong = lengths != ends - starts
        ids = ids[~wrong[text]]
        # Texts of the right length lie side by side on both sides.
        size = np.where(wrong, 0, lengths)
        differs = self.spelled(ids) != gathered(raw, starts, size)
        wrong[np.repeat(np.arange(len(counts)), size)[differs]] = True
        return wrong


@dataclass
class Encoder:
    """Both tokenizers, and the bytes of their ids."""

    words: tiktoken.Encoding
    pieces: sentencepiece.SentencePieceProcessor
    a: Spelling
    b: Spelling

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of space + text by both sides, and how many each text has; B puts the space before itself.

        A text has no ids unless it is not empty and the tokens of both sides, joined, give back these bytes.
        """
        none = np.zeros(0, np.int64)
        by_text = [self.words.encode_to_numpy(" " + t, disallowed_special=()) if t else none for t in texts]
        a = np.concatenate([none, *by_text]).astype(np.int64)
        a_counts = np.array([len(x) for x in by_text], np.int64)
        pieces = self.pieces.encode(texts, num_threads=1) if texts else []
        b_counts = np.array([len(x) for x in pieces], np.int64)
        b = np.fromiter(chain.from_iterable(pieces), np.int64, int(b_counts.sum()))
        spaced = [b" " + t.encode() if t else b"" for t in texts]
        raw, ends = np.frombuffer(b"".join(spaced), np.uint8), np.cumsum([len(t) for t in spaced], dtype=np.int64)
        wrong = self.a.wrong(a, a_counts, raw, ends) | self.b.wrong(b, b_counts, raw, ends)
        a, b = a[~np.repeat(wrong, a_counts)], b[~np.repeat(wrong, b_counts)]
        return a, np.where(wrong, 0, a_counts), b, np.where(wrong, 0, b_counts)


def piece_bytes(model: sentencepiece.SentencePieceProcessor, number: int) -> bytes:
    piece = model.id_to_piece(number)
    return bytes([int(piece[1:-1], 16)]) if model.is_byte(number) else piece.replace(MARK, " ").encode()


@lru_cache(maxsize=1)
def encoder(files: Vocabularies) -> Encoder:
    with open(files.rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        a_bytes[rank] = token
    words = tiktoken.Encoding("given", pat_str=files.pattern, mergeable_ranks=ranks, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_file=files.model_file)
    b_bytes = [piece_bytes(pieces, i) for i in range(pieces.get_piece_size())]
    return Encoder(words, pieces, Spelling(a_bytes), Spelling(b_bytes))


# --- Step 1: groups and links of a slice ---------------------------------------------------------


@dataclass
class Aligned:
    """Texts laid end to end: ids, byte offsets where their tokens end, and the text of each token."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_text: np.ndarray
    b_text: np.ndarray

    def common(self) -> tuple[np.ndarray, np.ndarray]:
        """Which tokens of A and of B end where one of the other side ends, too."""
        at = np.searchsorted(self.b_ends, self.a_ends)
        a_cuts = self.b_ends[np.minimum(at, len(self.b_ends) - 1)] == self.a_ends if len(self.b_ends) else at > 0
        b_cuts = np.zeros(len(self.b_ends), bool)
        b_cuts[at[a_cuts]] = True
        return a_cuts, b_cuts

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A id, B id and text of all pairs of tokens that overlap.

        Two tokens overlap in one stretch of bytes, so each stretch between neighbouring ends is one link.
        """
        _, shared = self.common()
        ends = np.sort(np.concatenate([self.a_ends, self.b_ends[~shared]]), kind="stable")
        a_at, b_at = np.searchsorted(self.a_ends, ends), np.searchsorted(self.b_ends, ends)
        return self.a[a_at], self.b[b_at], self.a_text[a_at]


def aligned(texts: list[str], files: Encoder) -> Aligned:
    a, a_counts, b, b_counts = files.encode(texts)
    of = np.arange(len(texts))
    return Aligned(a, b, np.cumsum(files.a.sizes[a]), np.cumsum(files.b.sizes[b]),
                   np.repeat(of, a_counts), np.repeat(of, b_counts))


def _digits(numbers: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all numbers in decimal, each followed by its mark (0: none), and the length of each."""
    width = len(str(int(numbers.max(initial=0))))
    cells = np.zeros((len(numbers), width + 1), np.uint8)
    rest = numbers
    for k in range(width - 1, -1, -1):
        # No leading zeros; the last digit always stands.
        cells[:, k] = np.where((rest > 0) | (k == width - 1), 48 + rest % 10, 0)
        rest = rest // 10
    cells[:, width] = marks
    shown = cells > 0
    return cells[shown], shown.sum(axis=1)


def group_texts(of: Aligned, n_texts: int) -> list[bytes]:
    """Of each text `a1,a2|b1;a3|b2,b3`: ids of both sides by group, in order."""
    if not len(of.a):
        return [b""] * n_texts
    a_cuts, b_cuts = of.common()
    # A token's group is the number of cuts before it; a group's ids of A stand before those of B.
    a_group, b_group = np.cumsum(a_cuts) - a_cuts, np.cumsum(b_cuts) - b_cuts
    a_place = np.arange(len(of.a)) + np.searchsorted(b_group, a_group, side="left")
    b_place = np.arange(len(of.b)) + np.searchsorted(a_group, b_group, side="right")
    ids, marks = np.zeros(len(of.a) + len(of.b), np.int64), np.full(len(of.a) + len(of.b), ord(","), np.uint8)
    ids[a_place], ids[b_place] = of.a, of.b
    marks[a_place[a_cuts]] = ord("|")
    marks[b_place[b_cuts]] = ord(";")
    text = np.zeros(len(ids), np.int64)
    text[a_place], text[b_place] = of.a_text, of.b_text
    marks[np.append(text[1:] != text[:-1], True)] = 0
    shown, sizes = _digits(ids, marks)
    ends = np.cumsum(np.bincount(text, sizes, minlength=n_texts).astype(np.int64))
    whole = shown.tobytes()
    return [whole[i:j] for i, j in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True)]


# --- Step 2: records and runs --------------------------------------------------------------------


def squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: the high bytes of small numbers vanish."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def restored(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel().astype(np.int64)


def steps(ordered: np.ndarray) -> np.ndarray:
    return np.diff(ordered, prepend=0)


@dataclass
class Records:
    """Pair-document records in order of (pair, document): each pair's records lie together."""

    pairs: np.ndarray  # distinct, ascending
    docs: np.ndarray  # of each pair: how many documents hold it
    doc: np.ndarray  # of each record: the document, ascending within a pair
    times: np.ndarray  # of each record: how many links


def records(a: np.ndarray, b: np.ndarray, text: np.ndarray, b_ids: int, n_texts: int) -> Records:
    found, times = np.unique((a * b_ids + b) * max(n_texts, 1) + text, return_counts=True)
    pair, doc = np.divmod(found, max(n_texts, 1))
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))[: len(pair)]
    return Records(pair[first], np.diff(np.append(first, len(pair))), doc, times)


def by_radix(pairs: np.ndarray, b_ids: int, radix: int) -> np.ndarray:
    """Places of the pairs in order of (partition, pair); pairs must ascend."""
    return np.argsort((pairs // b_ids) % radix, kind="stable")


_ENCODED = pa.schema([
    ("chunk", pa.int64()), ("part", pa.int32()), ("first", pa.int64()), ("block", pa.binary()), ("seen", pa.binary()),
    ("doc_ids", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())),
    ("n_b", pa.list_(pa.int64())), ("n_groups", pa.list_(pa.int64())), ("groups", pa.list_(pa.string())),
    ("pairs", pa.binary()), ("docs", pa.binary()), ("doc", pa.binary()), ("times", pa.binary()),
])
_ENCODED_SQL = (
    "chunk long, part int, first long, block binary, seen binary, doc_ids array<long>, n_a array<long>, "
    "n_b array<long>, n_groups array<long>, groups array<string>, pairs binary, docs binary, doc binary, times binary"
)
_OF_CHUNK = ["doc_ids", "n_a", "n_b", "n_groups", "groups", "pairs", "docs", "doc", "times"]


def _batch(schema: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema
    )


def _encoded(files: Vocabularies, radix: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each chunk one row with its documents and records, and one row for each block of its runs."""
    given = encoder(files)
    b_ids = len(given.b.sizes)
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        doc_ids = batch.column("doc_id").to_pylist()
        for first, end, raw, offsets in byte_slices(batch.column("text"), CHUNK_BYTES):
            body = raw.tobytes()
            texts = [body[i:j].decode() for i, j in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            n = end - first
            of = aligned(texts, given)
            a_cuts, _ = of.common()
            groups = group_texts(of, n)
            held = records(*of.links(), b_ids, n)
            whole = {
                "chunk": chunk, "doc_ids": doc_ids[first:end],
                "n_a": np.bincount(of.a_text, minlength=n).tolist(), "n_b": np.bincount(of.b_text, minlength=n).tolist(),
                "n_groups": np.bincount(of.a_text[a_cuts], minlength=n).tolist(),
                "groups": [hashlib.sha256(g).hexdigest() if g else "" for g in groups],
                "pairs": squeezed(steps(held.pairs)), "docs": squeezed(held.docs),
                # Documents restart within each pair, so their steps are taken modulo the number of texts.
                "doc": squeezed(steps(held.doc) % max(n, 1)), "times": squeezed(held.times),
            }
            yield _batch(_ENCODED, [whole])
            order = by_radix(held.pairs, b_ids, radix)
            part = (held.pairs[order] // b_ids) % radix
            cuts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))[: len(part)]
            blocks = []
            for i, j in zip(cuts.tolist(), np.append(cuts[1:], len(part)).tolist(), strict=True):
                for k in range(i, j, BLOCK_PAIRS):
                    at = order[k : min(k + BLOCK_PAIRS, j)]
                    pairs = held.pairs[at]
                    blocks.append({"chunk": chunk, "part": int(part[i]), "first": int(pairs[0]),
                                   "block": squeezed(steps(pairs)), "seen": squeezed(held.docs[at])})
            if blocks:
                yield _batch(_ENCODED, blocks)
            chunk += 1


# --- Step 3: merging runs ------------------------------------------------------------------------

_BACK = pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("first", pa.int64()), ("count", pa.binary()),
                   ("best", pa.binary())])
_BACK_SQL = "chunk long, part int, first long, count binary, best binary"


class Merge:
    """The runs of one partition, fed by ascending first pair; complete A ids are counted and sent back."""

    def __init__(self, part: int, b_ids: int):
        self.part, self.b_ids = part, b_ids
        self.heap: list[tuple[int, int, int, np.ndarray, np.ndarray]] = []
        self.held = self.fed = 0
        self.patience = HELD_PAIRS

    def feed(self, chunk: int, pairs: np.ndarray, docs: np.ndarray) -> Iterator[dict]:
        if self.held > self.patience:
            yield from self.counted(int(pairs[0]) // self.b_ids)
            # What stays belongs to few A ids; look again only after as much has come in addition.
            self.patience = self.held + HELD_PAIRS
        self.fed += 1
        heapq.heappush(self.heap, (int(pairs[0]), self.fed, chunk, pairs, docs))
        self.held += len(pairs)

    def counted(self, below: int | None) -> Iterator[dict]:
        """Count all pairs of A ids `below` one (None: all)."""
        limit = None if below is None else below * self.b_ids
        taken = []
        while self.heap and (limit is None or self.heap[0][0] < limit):
            _, number, chunk, pairs, docs = heapq.heappop(self.heap)
            cut = len(pairs) if limit is None else int(np.searchsorted(pairs, limit))
            taken.append((chunk, pairs[:cut], docs[:cut]))
            self.held -= cut
            if cut < len(pairs):
                heapq.heappush(self.heap, (int(pairs[cut]), number, chunk, pairs[cut:], docs[cut:]))
        if not taken:
            return
        chunks = np.repeat([c for c, _, _ in taken], [len(p) for _, p, _ in taken])
        pairs, docs = (np.concatenate(column) for column in list(zip(*taken, strict=True))[1:])
        distinct, which = np.unique(pairs, return_inverse=True)
        counts = np.bincount(which, docs).astype(np.int64)
        side = distinct // self.b_ids
        starts = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
        highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.append(starts, len(side))))
        best = counts == highest
        order = np.lexsort((pairs, chunks))
        chunks, pairs, which = chunks[order], pairs[order], which[order]
        starts = np.flatnonzero(np.append(True, chunks[1:] != chunks[:-1]))
        for i, j in zip(starts.tolist(), np.append(starts[1:], len(chunks)).tolist(), strict=True):
            yield {"chunk": int(chunks[i]), "part": self.part, "first": int(pairs[i]),
                   "count": squeezed(counts[which[i:j]]), "best": np.packbits(best[which[i:j]]).tobytes()}


def _merged(b_ids: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks arrive in order of (partition, first pair)."""
    merge: Merge | None = None
    for batch in batches:
        out: list[dict] = []
        columns = (batch.column(c).to_pylist() for c in ("part", "chunk", "block", "seen"))
        for part, chunk, block, seen in zip(*columns, strict=True):
            if merge is None or merge.part != part:
                if merge is not None:
                    out += merge.counted(None)
                merge = Merge(part, b_ids)
            out += merge.feed(chunk, np.cumsum(restored(block)), restored(seen))
            if len(out) > 64:
                yield _batch(_BACK, out)
                out = []
        if out:
            yield _batch(_BACK, out)
    if merge is not None and (out := list(merge.counted(None))):
        yield _batch(_BACK, out)


# --- Step 4: sums by document --------------------------------------------------------------------

COLUMNS = [("doc_id", "long"), ("n_a", "long"), ("n_b", "long"), ("n_groups", "long"), ("n_links", "long"),
           ("n_best", "long"), ("count_sum", "long"), ("groups_sha256", "string")]
_SUMMED = pa.schema([(n, pa.int64() if t == "long" else pa.string()) for n, t in COLUMNS])
_SUMMED_SQL = ", ".join(f"{n} {t}" for n, t in COLUMNS)


def _summed(b_ids: int, radix: int, chunks: pa.Table, back: pa.Table) -> pa.Table:
    """One chunk and the contributions to its pairs."""
    own = chunks.to_pylist()[0]
    n = len(own["doc_ids"])
    pairs = np.cumsum(restored(own["pairs"]))
    docs, times = restored(own["docs"]), restored(own["times"])
    doc = np.cumsum(restored(own["doc"])) % max(n, 1)
    back = back.sort_by([("part", "ascending"), ("first", "ascending")])
    blocks = [restored(c) for c in back.column("count").to_pylist()]
    bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(c)) for x, c in zip(
        back.column("best").to_pylist(), blocks, strict=True)]
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    if blocks:
        order = by_radix(pairs, b_ids, radix)
        count[order], best[order] = np.concatenate(blocks), np.concatenate(bits)
    count, best = np.repeat(count, docs), np.repeat(best, docs)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.zeros(n, np.int64)
        np.add.at(sums, doc, values)
        return sums

    found = {c: own[c] for c in ("n_a", "n_b", "n_groups")}
    found |= {"doc_id": own["doc_ids"], "groups_sha256": own["groups"], "n_links": total(times),
              "n_best": total(times * best), "count_sum": total(times * count)}
    return pa.Table.from_pydict({c: found[c] for c, _ in COLUMNS}, schema=_SUMMED)


def align(docs: DataFrame, files: Vocabularies) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A encodes space + text, B the text (its model puts the space before); special tokens' strings are
    plain text. Tokens of both sides that end at one byte cut the text into groups. Tokens whose byte
    ranges overlap are linked; the count of a pair of ids is the number of rows, of the whole table, that
    hold it linked. n_best counts links whose count is the highest that their A id has with any B id
    (ties included), count_sum sums the counts over the links. groups_sha256 is the digest of
    `a1,a2|b1;a3|b2,b3`. A text that is null, empty, or whose joined tokens differ from space + text on
    either side has no tokens: zeros, and ''.

    Each row is a document of its own, also where doc_ids or texts repeat or are null. A chunk holds
    whole texts, so a text of many megabytes is one task's memory (many times its size). A merging
    task holds the pairs of one A id over all chunks, each chunk's once, besides HELD_PAIRS. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    radix = max(64, width)
    b_ids = sentencepiece.SentencePieceProcessor(model_file=files.model_file).get_piece_size()
    encoded = stored(
        docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(partial(_encoded, files, radix), _ENCODED_SQL),
        "encoded",
    )
    runs = (
        encoded.filter("block IS NOT NULL").select("part", "first", "chunk", "block", "seen")
        .repartition(width, "part").sortWithinPartitions("part", "first", "chunk")
    )
    back = runs.mapInArrow(partial(_merged, b_ids), _BACK_SQL)
    chunks = encoded.filter("doc_ids IS NOT NULL").select("chunk", *_OF_CHUNK)
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(
        partial(_summed, b_ids, radix), _SUMMED_SQL
    )
