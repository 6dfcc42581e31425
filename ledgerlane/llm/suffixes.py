"""Byte strings that occur again: bounded common prefixes from a Burrows-Wheeler transform."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlane.llm.common import byte_slices, shuffle_width, stored, utf8
from ledgerlane.llm.hashing import (
    BYTE_CODES, INVERSE, bucket_bits, mixed, packed, powers, prefix_hashes, stretches, unpacked,
)

SPAN = 400
# Bytes of an anchor in the first search, and of one that names a group of strings.
FIRST_ANCHOR, GROUP_ANCHOR = 336, 32
# Bytes that one transform is built over, about; the strings of a group with more are counted by hash.
BLOCK_BYTES = 1 << 20
GROUP_BYTES = 3 << 20
# Strings that a batch holds.
STRING_ROWS = 50_000

_PLACE = np.uint64((1 << 31) - 1)


# --- Anchors ------------------------------------------------------------------------------------


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while 2 * size <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchored_runs(
    raw: np.ndarray, offsets: np.ndarray, anchor: int, span: int = SPAN
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of starts whose strings of `span` bytes have one anchor: first start, length, hash, text.

    The anchor of a string is the piece of `anchor` bytes in it whose hash is least (the first of
    equals). It hangs on the string alone, so equal strings have equal anchors at equal distances.
    """
    none = np.zeros(0, np.int64)
    if len(raw) < span:
        return none, none, none.astype(np.uint64), none
    prefix = prefix_hashes(BYTE_CODES[raw])
    m = len(raw) - anchor + 1
    hashes = mixed((prefix[anchor:] - prefix[:m]) * powers(m, INVERSE))
    marked = (hashes & ~_PLACE) | np.arange(m, dtype=np.uint64)
    places = (sliding_least(marked, span - anchor + 1) & _PLACE).astype(np.int64)
    sizes = np.diff(offsets)
    starts = np.arange(len(places))
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(places)]
    inside = starts + span <= offsets[1:][text]
    first = inside.copy()
    first[1:] &= ~inside[:-1] | (places[1:] != places[:-1]) | (text[1:] != text[:-1])
    begins = np.flatnonzero(first)
    stops = np.flatnonzero(first | ~inside)
    after = np.append(stops, len(places))[np.searchsorted(stops, begins, side="right")]
    return begins, after - begins, hashes[places[begins]], text[begins]


# --- Strings that may occur again ---------------------------------------------------------------

_DEALT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("tags", pa.binary()),
                    ("runs", pa.binary()),
                    ("ids", pa.binary()), ("texts", pa.binary()), ("starts", pa.binary()), ("lengths", pa.binary())])
_DEALT_SQL = ("bucket int, chunk long, hashes binary, tags binary, runs binary, ids binary, texts binary, starts binary, "
              "lengths binary")
_BACK = pa.schema([f for f in _DEALT if f.name not in ("bucket", "hashes", "tags")])
_BACK_SQL = "chunk long, runs binary, ids binary, texts binary, starts binary, lengths binary"
_RUNS = pa.schema([("id", pa.binary()), ("starts", pa.binary()), ("lengths", pa.binary())])
_RUNS_SQL = "id binary, starts binary, lengths binary"
_TABLE = ("ids", "texts", "starts", "lengths")


def _dealt(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of each text by hash range; a text that a slice holds again is left out."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        ids = np.array([x.as_py() for x in batch.column("id")], "S16")
        for first, end, raw, offsets in byte_slices(batch.column("text"), BLOCK_BYTES):
            begins, lengths, hashes, text = anchored_runs(raw, offsets, FIRST_ANCHOR)
            _, once = np.unique(ids[first:end], return_index=True)
            only = np.isin(text, once)
            begins, lengths, hashes, text = begins[only], lengths[only], hashes[only], text[only]
            if not len(begins):
                continue
            order = np.argsort(hashes)
            joined_ids = b"".join(x.ljust(16, b"\0") for x in ids[first:end].tolist())
            # A place in a text, so that copies of the text are not taken for other places.
            place = np.frombuffer(joined_ids, np.uint64)[::2][text] + (begins - offsets[text]).astype(np.uint64)
            tags = mixed(place)
            buckets = (hashes[order] >> np.uint64(64 - bits)).astype(np.int64)
            cuts = list(stretches(buckets))
            n = len(cuts)
            table = {
                "ids": joined_ids,
                "texts": text.astype(np.int32).tobytes(),
                "starts": (begins - offsets[text]).astype(np.int32).tobytes(),
                "lengths": lengths.astype(np.int32).tobytes(),
            }
            yield pa.RecordBatch.from_pydict({
                "bucket": [*(c[0] for c in cuts), chunk % (1 << bits)], "chunk": [chunk] * (n + 1),
                "hashes": [packed(hashes[order[a:b]]) for _, a, b in cuts] + [None],
                "tags": [tags[order[a:b]].tobytes() for _, a, b in cuts] + [None],
                "runs": [order[a:b].astype(np.int32).tobytes() for _, a, b in cuts] + [None],
            } | {c: [None] * n + [v] for c, v in table.items()}, schema=_DEALT)
            chunk += 1


def _repeated(bits: int, key: tuple, table: pa.Table) -> pa.Table:
    """Anchors that occur at two places or more, of one text or of different ones, go back to their chunk."""
    dealt = table.filter(pc.is_valid(table.column("hashes")))
    tables = table.filter(pc.is_null(table.column("hashes")))
    rows = {"chunk": tables.column("chunk").to_pylist(), "runs": [None] * len(tables)}
    rows |= {c: tables.column(c).to_pylist() for c in _TABLE}
    if len(dealt):
        parts = [unpacked(h.as_py(), key[0].as_py(), bits) for h in dealt.column("hashes")]
        chunk = np.repeat(dealt.column("chunk").to_numpy(), [len(p) for p in parts])
        hashes = np.concatenate(parts)
        runs = np.frombuffer(b"".join(dealt.column("runs").to_pylist()), np.int32)
        tags = np.frombuffer(b"".join(dealt.column("tags").to_pylist()), np.uint64)
        order = np.lexsort((tags, hashes))
        hashes, tags = hashes[order], tags[order]
        fresh = np.append(True, hashes[1:] != hashes[:-1])
        place = fresh | np.append(True, tags[1:] != tags[:-1])
        which = np.cumsum(fresh) - 1
        again = order[np.bincount(which, place)[which] > 1]
        again = again[np.argsort(chunk[again], kind="stable")]
        chunk, runs = chunk[again], runs[again]
        for name, a, b in stretches(chunk):
            rows["chunk"].append(name)
            rows["runs"].append(runs[a:b].tobytes())
            for c in _TABLE:
                rows[c].append(None)
    return pa.Table.from_pydict(rows, schema=_BACK)


def _by_text(table: pa.Table) -> pa.Table:
    """The runs of each text that may occur again, neighbours joined."""
    described = table.filter(pc.is_valid(table.column("ids")))
    ids = described.column("ids")[0].as_py()
    text, start, length = (
        np.frombuffer(described.column(c)[0].as_py(), np.int32) for c in ("texts", "starts", "lengths")
    )
    found = np.frombuffer(b"".join(x for x in table.column("runs").to_pylist() if x), np.int32)
    found = np.sort(found)
    text, start, length = text[found], start[found], length[found]
    rows = {"id": [], "starts": [], "lengths": []}
    for name, a, b in stretches(text):
        s, e = start[a:b], start[a:b] + length[a:b]
        fresh = np.append(True, s[1:] != e[:-1])
        begins = s[fresh]
        rows["id"].append(ids[16 * name : 16 * name + 16])
        rows["starts"].append(begins.tobytes())
        rows["lengths"].append((e[np.append(fresh[1:], True)] - begins).astype(np.int32).tobytes())
    return pa.Table.from_pydict(rows, schema=_RUNS)


# --- Groups of strings with one anchor ----------------------------------------------------------

_PARTS = pa.schema([("id", pa.binary()), ("starts", pa.binary()), ("n", pa.int32()), ("name", pa.binary()),
                    ("anchor", pa.int64()), ("bytes", pa.binary()), ("weight", pa.int64())])
_PARTS_SQL = "id binary, starts binary, n int, name binary, anchor long, bytes binary, weight long"
_STRINGS_SQL = "string binary, name binary, place int, weight long"


def _part_batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows as batches of about BLOCK_BYTES."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[5]) + 200
        if size > BLOCK_BYTES:
            yield _part_batch(held)
            held, size = [], 0
    if held:
        yield _part_batch(held)


def _part_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARTS, strict=True)], schema=_PARTS
    )


def _text_parts(text_id: bytes, text: bytes, starts: bytes, lengths: bytes) -> Iterator[tuple]:
    raw = np.frombuffer(text, np.uint8)
    begins, sizes, hashes, _ = anchored_runs(raw, np.array([0, len(raw)]), GROUP_ANCHOR)
    may = np.zeros(len(raw) + 1, np.int8)
    s = np.frombuffer(starts, np.int32)
    may[s] += 1
    may[s + np.frombuffer(lengths, np.int32)] -= 1
    owner = np.repeat(np.arange(len(begins)), sizes)
    at = np.flatnonzero(np.cumsum(may)[: len(owner)] > 0)
    if not len(at):
        return
    fresh = np.append(True, (np.diff(at) > 1) | (np.diff(owner[at]) > 0))
    first = at[fresh]
    n = np.diff(np.append(np.flatnonzero(fresh), len(at)))
    found: dict[bytes, tuple[int, int, list[int]]] = {}
    for a, k, h in zip(first.tolist(), n.tolist(), hashes[owner[first]].view(np.int64).tolist(), strict=True):
        found.setdefault(text[a : a + k + SPAN - 1], (k, h, []))[2].append(a)
    for part, (k, h, places) in found.items():
        name = hashlib.blake2b(part, digest_size=16).digest()
        yield text_id, np.array(places, np.int32).tobytes(), k, name, h, part, len(places)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a text's runs where the anchor that names the group changes; a part holds its strings' bytes."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            columns = (batch.column(c) for c in ("id", "starts", "lengths"))
            for text_id, s, k, text in zip(*columns, utf8(batch.column("text")), strict=True):
                yield from _text_parts(text_id.as_py(), text, s.as_py(), k.as_py())

    yield from _part_batches(rows())


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The strings of each distinct part by their hash: which strings are equal needs no bytes any more."""
    for batch in batches:
        columns = (batch.column(c) for c in ("name", "n", "bytes", "weight"))
        for name, n, part, weight in zip(*columns, strict=True):
            n, part = n.as_py(), part.as_py()
            for first in range(0, n, STRING_ROWS):
                places = range(first, min(first + STRING_ROWS, n))
                hashes = [hashlib.blake2b(part[k : k + SPAN], digest_size=16).digest() for k in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes, pa.binary()), pa.array([name.as_py()] * len(hashes), pa.binary()),
                     pa.array(places, pa.int32()), pa.array([weight.as_py()] * len(hashes), pa.int64())],
                    names=["string", "name", "place", "weight"],
                )


def _repeated_by_hash(parts: DataFrame) -> DataFrame:
    """(name, found) as `_searched` gives it, for groups of any size: a string is repeated if its hash is.

    A string that stands in a third of all parts is one row of counts; its places meet it in a join
    that adaptive execution can split.
    """
    strings = stored(
        parts.select("name", "n", "bytes", "weight").mapInArrow(_strings, _STRINGS_SQL), "strings"
    )
    twice = strings.groupBy("string").agg(F.sum("weight").alias("n")).filter("n > 1").select("string")
    return strings.join(twice, "string").groupBy("name").agg(F.sort_array(F.collect_list("place")).alias("places")).select(
        "name", F.unhex(F.array_join(F.transform("places", _little_endian), "")).alias("found"))


def _little_endian(number: Column) -> Column:
    """Four bytes of a number below 2**31, low byte first, in hexadecimal."""
    digits = F.lpad(F.hex(number), 8, "0")
    return F.concat(*[F.substring(digits, at, 2) for at in (7, 5, 3, 1)])


# --- The transform ------------------------------------------------------------------------------


def bounded_suffix_order(symbols: np.ndarray, ends: np.ndarray, owner: np.ndarray, span: int) -> np.ndarray:
    """Suffixes in order of their first `span` symbols at least, by doubling from seven packed symbols.

    Symbol 0 ends a part; no two suffixes are equal beyond the end of a part.
    """
    n, parts = len(symbols), len(ends)
    key = np.zeros(n, np.uint64)
    place = np.arange(n)
    for k in range(7):
        shifted = np.zeros(n, np.uint64)
        shifted[: max(n - k, 0)] = symbols[k:]
        shifted[place + k > ends[owner]] = 0
        key = (key << np.uint64(9)) | shifted
    length = 7
    order = np.argsort(key)
    while True:
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1]))
        if length >= span or rank[order[-1]] == n - 1:
            return order
        beyond = place + length
        past = beyond > ends[owner]
        second = np.where(past, owner, parts + rank[np.minimum(beyond, n - 1)])
        key = rank.astype(np.uint64) * np.uint64(n + parts + 1) + second.astype(np.uint64)
        order = np.argsort(key)
        length *= 2


def common_prefix_groups(bwt: np.ndarray, first: np.ndarray, span: int) -> np.ndarray:
    """Group of each suffix: suffixes with a common prefix of `span` bytes share one.

    `first` is the first symbol of each suffix in order. Breadth-first backward extension: borders
    between suffixes whose common prefix is l bytes long part an interval; for every symbol that
    stands before suffixes on both sides of a border, the border between those extended suffixes
    has l + 1. Borders are derived by increasing l and never beyond span - 1, so what
    is still together has `span` bytes in common. Of a parted interval all pieces but the largest are
    walked, so each suffix is walked a logarithmic number of times.
    """
    n = len(bwt)
    by_symbol = np.argsort(bwt, kind="stable")
    ends_part = int((bwt == 0).sum())
    step = np.empty(n, np.int32)  # where a suffix stands when its preceding symbol is put before it
    step[by_symbol] = np.arange(n)
    after, before = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    same[: max(ends_part - 1, 0)] = False
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]

    border = np.zeros(n, bool)
    # Ends of parts differ from one another; other suffixes part at their first symbol.
    new = np.flatnonzero(np.append(True, (first[1:] != first[:-1]) | (first[1:] == 0)))
    border[new] = True
    group = (np.cumsum(border) - 1).astype(np.int32)
    groups = int(group[-1]) + 1
    low = np.zeros(2 * n + 1, np.int32)
    high = np.zeros(2 * n + 1, np.int32)
    low[:groups] = new
    high[:groups] = np.append(new[1:], n)
    # At first every piece but the largest counts as parted from the whole.
    whole = np.zeros(groups, np.int64)
    pieces_low, pieces_high, pieces_group, parents = low[:groups].copy(), high[:groups].copy(), np.arange(groups), whole
    origin = np.arange(2 * n + 1, dtype=np.int32)
    for _ in range(1, span):
        # Walk every piece but the largest of each parted interval.
        sizes = pieces_high - pieces_low
        by_parent = np.lexsort((-sizes, parents))
        largest = by_parent[np.append(True, parents[by_parent][1:] != parents[by_parent][:-1])]
        walked = np.ones(len(sizes), bool)
        walked[largest] = False
        counts = sizes[walked]
        at = np.repeat(pieces_low[walked] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        origin[pieces_group] = parents + len(origin)
        later, earlier = after[at], before[at]
        mine = group[at]

        def parted(other: np.ndarray, mine: np.ndarray = mine) -> np.ndarray:
            there = group[np.maximum(other, 0)]
            return (other >= 0) & (there != mine) & (origin[there] == origin[mine])

        found = np.concatenate([step[later[parted(later)]], step[at[parted(earlier)]]])
        origin[pieces_group] = pieces_group
        found = np.unique(found[~border[found]])
        if not len(found):
            break
        border[found] = True
        # Part the intervals at the new borders; the largest piece keeps its group.
        old = group[found]
        heads = np.append(True, old[1:] != old[:-1])
        parents_now = old[heads]
        cuts_low = np.concatenate([low[parents_now], found])
        cuts_parent = np.concatenate([parents_now, old])
        order = np.argsort(cuts_low, kind="stable")
        cuts_low, cuts_parent = cuts_low[order], cuts_parent[order]
        last = np.append(cuts_parent[1:] != cuts_parent[:-1], True)
        cuts_high = np.append(cuts_low[1:], 0)
        cuts_high[last] = high[cuts_parent[last]]
        sizes = cuts_high - cuts_low
        by_parent = np.lexsort((-sizes, cuts_parent))
        largest = by_parent[np.append(True, cuts_parent[by_parent][1:] != cuts_parent[by_parent][:-1])]
        names = np.empty(len(sizes), np.int64)
        fresh = np.ones(len(sizes), bool)
        fresh[largest] = False
        names[largest] = cuts_parent[largest]
        names[fresh] = groups + np.arange(fresh.sum())
        groups += int(fresh.sum())
        low[names], high[names] = cuts_low, cuts_high
        counts = sizes[fresh]
        at = np.repeat(cuts_low[fresh] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        group[at] = np.repeat(names[fresh], counts)
        pieces_low, pieces_high, pieces_group, parents = cuts_low, cuts_high, names, cuts_parent
    return group


def repeated_starts(parts: list[bytes], starts: np.ndarray, weights: np.ndarray, span: int = SPAN) -> list[np.ndarray]:
    """For each distinct part, which of its first `starts` strings of `span` bytes occur again.

    A part stands for `weights` equal ones. Only the counted starts are compared.
    """
    lengths = np.array([len(p) for p in parts], np.int64)
    ends = np.cumsum(lengths + 1) - 1
    symbols = np.zeros(ends[-1] + 1, np.uint64)
    inside = np.ones(len(symbols), bool)
    inside[ends] = False
    symbols[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(parts)), lengths + 1)
    order = bounded_suffix_order(symbols, ends, owner, span)
    group = common_prefix_groups(symbols[order - 1].astype(np.int16), symbols[order].astype(np.int16), span)
    begins = ends - lengths
    counted = np.arange(len(symbols)) - begins[owner] < starts[owner]
    seen = np.bincount(group, np.where(counted[order], weights[owner[order]], 0))
    again = np.zeros(len(symbols), bool)
    again[order] = seen[group] > 1
    again &= counted
    return [np.flatnonzero(again[b : b + s]) for b, s in zip(begins, starts, strict=True)]


def _searched(table: pa.Table) -> pa.Table:
    names, parts = table.column("name").to_pylist(), table.column("bytes").to_pylist()
    found = repeated_starts(parts, table.column("n").to_numpy(), table.column("weight").to_numpy())
    some = [i for i, f in enumerate(found) if len(f)]
    return pa.Table.from_arrays(
        [pa.array([names[i] for i in some], pa.binary()),
         pa.array([found[i].astype(np.int32).tobytes() for i in some], pa.binary())],
        names=["name", "found"],
    )


_REMOVED_SQL = "id binary, n_removed long, n_spans long, kept_sha256 string, kept binary"


def _removed(keep_text: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: dict[str, list] = {c: [] for c in ("id", "n_removed", "n_spans", "kept_sha256", "kept")}
        columns = (batch.column(c).to_pylist() for c in ("id", "found"))
        for text_id, found, text in zip(*columns, utf8(batch.column("text")), strict=True):
            edges = np.zeros(len(text) + 1, np.int64)
            for f in found:
                within = np.frombuffer(f["found"], np.int32)
                at = (np.frombuffer(f["starts"], np.int32)[:, None] + within).ravel()
                np.add.at(edges, at, 1)
                np.add.at(edges, at + SPAN, -1)
            gone = np.cumsum(edges)[: len(text)] > 0
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            rows["id"].append(text_id)
            rows["n_removed"].append(int(gone.sum()))
            rows["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum()))
            rows["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            rows["kept"].append(kept if keep_text else None)
        types = (pa.binary(), pa.int64(), pa.int64(), pa.string(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows)
        )


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(text))


def remove_repeated(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (with keep_text also kept).

    Every byte is removed that a string of 400 bytes covers which also starts anywhere else, in this or
    another row; strings never cross rows and are judged on the input. A null text counts as
    empty. Rows with equal texts are repeats of one another: the text is searched once, and where it
    stands in two rows all of it goes (if it has 400 bytes). Other columns are ignored.

    Equal strings have equal anchors, so only strings whose anchor of 336 bytes occurs twice go
    on. They are grouped by a shorter anchor, and each group's distinct parts are searched by
    a Burrows-Wheeler transform that is bounded at 400 bytes. The strings of a group of over
    GROUP_BYTES are counted by a hash of 16 bytes each instead, which spreads them over all tasks. A very long
    text is handled whole in one task, in many times its size.
    """
    spark = docs.sparkSession
    width = shuffle_width(spark)
    bits = bucket_bits(width)
    text = F.coalesce(F.col("text"), F.lit(""))
    body = docs.select("doc_id", text.alias("text"), _text_id(text).alias("id"))

    dealt = body.select("id", "text").mapInArrow(partial(_dealt, bits), _DEALT_SQL)
    back = dealt.groupBy("bucket").applyInArrow(lambda key, t: _repeated(bits, key, t), _BACK_SQL)
    runs = back.groupBy("chunk").applyInArrow(lambda t: _by_text(t), _RUNS_SQL)
    # Chunks that hold one text found the same runs.
    runs = runs.groupBy("id").agg(F.first("starts").alias("starts"), F.first("lengths").alias("lengths"))

    copies = stored(
        body.groupBy("id").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")), "copies"
    )
    one = copies.join(runs, "id")
    texts = stored(
        body.alias("b").join(
            one.alias("o"), (F.col("b.id") == F.col("o.id")) & F.col("b.doc_id").eqNullSafe(F.col("o.doc_id"))
        ).select("b.id", "b.text", "o.starts", "o.lengths").dropDuplicates(["id"]),
        "texts",
    )

    cut = stored(texts.mapInArrow(_parts, _PARTS_SQL), "parts")
    distinct = stored(cut.groupBy("name").agg(
        F.first("anchor").alias("anchor"), F.first("n").alias("n"), F.first("bytes").alias("bytes"),
        F.sum("weight").alias("weight"),
    ), "distinct")
    sizes = stored(distinct.groupBy("anchor").agg(F.sum(F.octet_length("bytes")).alias("size")), "sizes")
    large = sizes.filter(F.col("size") > GROUP_BYTES).select("anchor")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    blocks = max(width, -(-total // BLOCK_BYTES))
    # A block's cost is time and not bytes, so adaptive execution must not merge them: their number is given.
    found = (
        distinct.join(large, "anchor", "left_anti").withColumn("block", F.pmod("anchor", F.lit(blocks)))
        .repartition(blocks, "block")
        .groupBy("block").applyInArrow(lambda t: _searched(t), "name binary, found binary")
    )
    if not large.isEmpty():
        found = found.unionByName(_repeated_by_hash(distinct.join(large, "anchor", "left_semi")))
    by_text = (
        cut.select("name", "id", "starts").join(found, "name")
        .groupBy("id").agg(F.collect_list(F.struct("starts", "found")).alias("found"))
    )
    removed = texts.select("id", "text").join(by_text, "id").select("id", "text", "found").mapInArrow(
        partial(_removed, keep_text), _REMOVED_SQL
    )

    n_bytes = F.octet_length("text").cast("long")
    own = body.select(
        "doc_id", "id", n_bytes.alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("own_sha256"),
        *([F.col("text").cast("binary").alias("own")] if keep_text else []),
    )
    whole = (F.coalesce("copies", F.lit(1)) > 1) & (F.col("n_bytes") >= SPAN)
    empty = F.sha2(F.lit("").cast("binary"), 256)
    repeated = copies.filter("copies > 1").select("id", "copies")
    return (
        own.join(removed, "id", "left").join(repeated, "id", "left")
        .select(
            "doc_id", "n_bytes",
            F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
            F.when(whole, 1).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
            F.when(whole, empty).otherwise(F.coalesce("kept_sha256", "own_sha256")).alias("kept_sha256"),
            *([F.when(whole, F.lit(b"")).otherwise(F.coalesce("kept", "own")).alias("kept")] if keep_text else []),
        )
    )
