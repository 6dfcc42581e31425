"""Documents linked by shingle sets of Jaccard similarity 0.8 or more: an exact set-relation join.

Sets travel as packed hashes, never as one row for each shingle:

1. A task hashes the shingles of its texts and deals them out by hash range (bucket).
2. A bucket counts in how many sets each shingle lies and returns those of two or more to the
   chunk of texts they came from. Others cannot be shared.
3. A chunk knows for each set its size, its shared shingles and, in the order (count, hash), its
   prefix: sets that are similar enough share a shingle of both prefixes. Sets whose prefix
   holds no shared shingle are done.
4. Sets with the same most frequent prefix shingle form blocks of bounded size. Index lists hold
   blocks, not sets; two blocks meet only where a list's sizes and positions still allow a link.
5. Inside a pair of blocks, a set's overlaps with all sets of the other block follow from those of
   the set before it: only the shingles in which the two differ are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import TEXT_WRITERS, byte_slices, give_back, held, in_few_files, shuffle_width, stored
from ledgerlane.llm.hashing import bucket_bits, mixed, packed, shingle_hashes, stretches, unpacked, word_hashes

WORDS = 5
BLOCK_SETS = 256
# Bytes of texts that a task hashes at once: some forty times as much is held meanwhile, and workers keep it.
SET_BYTES = 512 << 10

_DEALT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("sets", pa.binary()),
                    ("sizes", pa.binary()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                    ("names", pa.list_(pa.binary()))])
_DEALT_SQL = ("bucket int, chunk long, hashes binary, sets binary, sizes binary, ids binary, doc_ids array<long>, "
              "names array<binary>")
_SHARED = pa.schema([("chunk", pa.int64()), ("hashes", pa.binary()), ("sets", pa.binary()), ("counts", pa.binary()),
                     ("sizes", pa.binary()), ("ids", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
                     ("names", pa.list_(pa.binary()))])
_SHARED_SQL = ("chunk long, hashes binary, sets binary, counts binary, sizes binary, ids binary, doc_ids array<long>, "
               "names array<binary>")
_SETS = pa.schema([("doc_id", pa.int64()), ("name", pa.binary()), ("n", pa.int64()), ("id", pa.binary()), ("shared", pa.binary()),
                   ("prefix", pa.list_(pa.int64()))])
_SETS_SQL = "doc_id long, name binary, n long, id binary, shared binary, prefix array<long>"
_LINKED = pa.schema([("id", pa.binary()), ("to", pa.binary()), ("links", pa.int64())])


def _dealt(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Step 1. Equal sets of a slice are dealt out once."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        doc_ids, names = batch.column("doc_id").cast(pa.int64()), batch.column("name")
        for first, end, raw, offsets in byte_slices(batch.column("text"), SET_BYTES):
            hashes, text = shingle_hashes(*word_hashes(raw, offsets), WORDS)
            order = np.argsort(hashes, kind="stable")
            hashes, text = hashes[order], text[order]
            again = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
            if again.any():
                keep = np.append(True, ~again)
                hashes, text = hashes[keep], text[keep]
            sizes = np.bincount(text, minlength=end - first)
            ids = np.zeros((end - first, 2), np.uint64)
            by_text = np.argsort(text.astype(np.uint16), kind="stable")
            at = np.cumsum(sizes)
            for k in range(2):
                sums = np.append(np.uint64(0), np.cumsum(mixed(hashes[by_text], 20 + k)))
                ids[:, k] = mixed(sums[at] - sums[at - sizes], 30 + k)
            _, once = np.unique(ids, axis=0, return_index=True)
            only = np.zeros(end - first, bool)
            only[once] = True
            keep = only[text]
            hashes, text = hashes[keep], text[keep]

            # In a bucket shingles stand by set, so how many there are of each set says whose they are.
            buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(buckets * (end - first) + text)
            hashes, text, buckets = hashes[order], text[order], buckets[order]
            cuts = list(stretches(buckets))
            n = len(cuts)
            rows = {
                "bucket": [*(c[0] for c in cuts), chunk % (1 << bits)], "chunk": [chunk] * (n + 1),
                "hashes": [packed(hashes[a:b]) for _, a, b in cuts] + [None],
                "sets": [np.bincount(text[a:b], minlength=end - first).astype(np.uint32).tobytes() for _, a, b in cuts]
                + [None],
                "sizes": [None] * n + [np.where(only, sizes, -1 - sizes).astype(np.int64).tobytes()],
                "ids": [None] * n + [ids.tobytes()],
                "doc_ids": [None] * n + [doc_ids.slice(first, end - first).to_pylist()],
                "names": [None] * n + [names.slice(first, end - first).to_pylist()],
            }
            yield pa.RecordBatch.from_pydict(rows, schema=_DEALT)
            chunk += 1
        give_back()


def _counted(bits: int, key: tuple, table: pa.Table) -> pa.Table:
    """Step 2."""
    bucket = key[0].as_py()
    dealt = table.filter(pc.is_valid(table.column("hashes")))
    tables = table.filter(pc.is_null(table.column("hashes")))
    rows = {c: [None] * len(tables) for c in ("hashes", "sets", "counts")} | {
        c: tables.column(c).to_pylist() for c in ("chunk", "sizes", "ids", "doc_ids", "names")
    }
    if len(dealt):
        chunks = dealt.column("chunk").to_numpy()
        parts = [unpacked(h.as_py(), bucket, bits) for h in dealt.column("hashes")]
        hashes = np.concatenate(parts)
        chunk = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        held = [np.frombuffer(s.as_py(), np.uint32) for s in dealt.column("sets")]
        sets = np.concatenate([np.repeat(np.arange(len(h), dtype=np.uint16), h) for h in held])
        order = np.argsort(hashes)
        ordered = hashes[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        counts = np.diff(np.append(starts, len(ordered)))
        counts = np.repeat(counts, counts)
        order, counts = order[counts > 1], counts[counts > 1].astype(np.uint32)
        back = np.argsort(chunk[order], kind="stable")
        order, counts = order[back], counts[back]
        for name, a, b in stretches(chunk[order]):
            rows["chunk"].append(int(chunks[name]))
            rows["hashes"].append(hashes[order[a:b]].tobytes())
            rows["sets"].append(sets[order[a:b]].tobytes())
            rows["counts"].append(counts[a:b].tobytes())
            for c in ("sizes", "ids", "doc_ids", "names"):
                rows[c].append(None)
    return pa.Table.from_pydict(rows, schema=_SHARED)


def needed_overlap(n: int) -> int:
    """Least overlap of a set of n with any set it is linked with: 80 % of n."""
    return -(-4 * n // 5)


def _prefixed(table: pa.Table) -> pa.Table:
    """Step 3."""
    described = table.filter(pc.is_valid(table.column("ids")))
    sizes = np.frombuffer(described.column("sizes")[0].as_py(), np.int64)
    ids = described.column("ids")[0].as_py()
    n = np.where(sizes < 0, -1 - sizes, sizes)
    shared: list[bytes | None] = [None] * len(n)
    prefix: list[np.ndarray | None] = [None] * len(n)
    table = table.filter(pc.is_valid(table.column("hashes")))

    def joined(column: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)

    if len(table):
        hashes, sets, counts = joined("hashes", np.uint64), joined("sets", np.uint16), joined("counts", np.uint32)
        order = np.lexsort((hashes, counts, sets))
        hashes, sets = hashes[order], sets[order]
        for name, a, b in stretches(sets):
            size = int(n[name])
            rest = size - needed_overlap(size) + 1 - (size - (b - a))
            if rest > 0:
                own = hashes[a:b]
                prefix[name] = own[:rest].view(np.int64)
                shared[name] = np.sort(own).tobytes()
    return pa.Table.from_pydict({
        "doc_id": described.column("doc_ids")[0].as_py(), "name": described.column("names")[0].as_py(), "n": n,
        "id": [ids[16 * i : 16 * i + 16] for i in range(len(n))], "shared": shared, "prefix": prefix,
    }, schema=_SETS)


def overlaps(sets: list[np.ndarray], others: list[np.ndarray]) -> Iterator[np.ndarray]:
    """For each set its overlaps with all others, derived from those of the set before it.

    An index list names the others that hold an element. From one set to the next only the lists of
    lost elements are taken off and those of new ones added; where the two share too little to gain,
    the next set starts anew.
    """
    elements, index = np.unique(np.concatenate(others), return_inverse=True)
    holder = np.repeat(np.arange(len(others)), [len(o) for o in others])
    order = np.argsort(index, kind="stable")
    holder, ends = holder[order], np.cumsum(np.bincount(index, minlength=len(elements)))
    starts = np.append(0, ends[:-1])

    def held(found: np.ndarray) -> np.ndarray:
        """How many of the found elements each other set holds."""
        counts = ends[found] - starts[found]
        at = np.repeat(starts[found] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(holder[at], minlength=len(others))

    before, answer = np.zeros(0, np.int64), np.zeros(len(others), np.int64)
    for own in sets:
        at = np.minimum(np.searchsorted(elements, own), len(elements) - 1)
        now = at[elements[at] == own]
        lost = np.setdiff1d(before, now, assume_unique=True)
        new = np.setdiff1d(now, before, assume_unique=True)
        if len(lost) + len(new) < len(now):
            answer = answer - held(lost) + held(new)
        else:
            answer = held(now)
        before = now
        yield answer


def _compare(table: pa.Table) -> pa.Table:
    """Step 5: for each set its number of links in a pair of blocks, and one linked set (a local root)."""
    ids_out, to_out, links_out = [], [], []
    pair = np.array(table.column("pair").to_pylist())
    second = table.column("second").to_numpy()
    n_all, size_all = table.column("n").to_numpy(), table.column("size").to_numpy()
    id_all, shared_all = table.column("id").to_pylist(), table.column("shared").to_pylist()
    order = np.lexsort((np.array(id_all), n_all, second, pair))
    starts = np.flatnonzero(np.append(True, pair[order][1:] != pair[order][:-1]))
    for a, b in zip(starts, np.append(starts[1:], len(order)), strict=True):
        rows = order[a:b]
        left = rows[~second[rows]]
        right = rows[second[rows]] if second[rows].any() else left
        same = right is left
        if not len(left) or (same and len(left) < 2):
            continue
        place = {int(r): i for i, r in enumerate(rows)}
        root = list(range(len(rows)))
        links = np.zeros(len(rows), np.int64)
        at_right = np.array([place[int(r)] for r in right])
        sizes, n_right = size_all[right], n_all[right]
        sets = [np.frombuffer(shared_all[r], np.uint64) for r in left]
        others = sets if same else [np.frombuffer(shared_all[r], np.uint64) for r in right]

        def top(i: int, root: list[int] = root) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for k, (r, overlap) in enumerate(zip(left, overlaps(sets, others), strict=True)):
            # 100 * overlap >= 80 * union
            linked = 9 * overlap >= 4 * (n_all[r] + n_right)
            if same:
                linked[k] = False
            if linked.any():
                own = place[int(r)]
                links[own] += sizes[linked].sum()
                if not same:
                    links[at_right[linked]] += size_all[r]
                for j in at_right[linked].tolist():
                    x, y = top(own), top(j)
                    if x != y:
                        root[max(x, y)] = min(x, y)
        for i in np.flatnonzero(links):
            ids_out.append(id_all[rows[i]])
            to_out.append(id_all[rows[top(int(i))]])
            links_out.append(int(links[i]))
    return pa.Table.from_pydict({"id": ids_out, "to": to_out, "links": links_out}, schema=_LINKED)


def row_name() -> Column:
    """128 bits that tell rows of other doc_id or text apart, hashed in place (texts are not copied)."""
    halves = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(7), "doc_id", "text")
    return F.unhex(F.concat(*[F.lpad(F.hex(half), 16, "0") for half in halves]))


def shingle_sets(docs: DataFrame, name: Column | None = None) -> DataFrame:
    """Steps 1 to 3: doc_id, name (if one is given), n (set size), id (of the set), shared and prefix shingles where a link is possible."""
    bits = bucket_bits(shuffle_width(docs.sparkSession))
    name = (F.lit(None).cast("binary") if name is None else name).alias("name")
    dealt = docs.select(F.col("doc_id").cast("long"), "text", name).mapInArrow(partial(_dealt, bits), _DEALT_SQL)
    counted = dealt.groupBy("bucket").applyInArrow(
        lambda key, table: _counted(bits, key, table), _SHARED_SQL
    )
    return stored(in_few_files(counted.groupBy("chunk").applyInArrow(lambda table: _prefixed(table), _SETS_SQL)), "sets")


def candidate_pairs(sets: DataFrame, block_sets: int = BLOCK_SETS) -> tuple[DataFrame, DataFrame]:
    """Step 4: the block of each set (id, block), and the pairs of blocks that may hold links."""
    homes = sets.select("id", "n", "prefix", (F.octet_length("shared") / 8).cast("long").alias("m"),
                        F.element_at("prefix", -1).alias("home"))
    crowd = homes.groupBy("home").agg(F.count(F.lit(1)).alias("crowd"))
    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("crowd") / block_sets)).cast("int")
    blocked = stored(
        in_few_files(homes.join(crowd, "home").withColumn("block", F.struct("home", part.alias("part"))).drop("crowd", "home")),
        "blocks",
    )
    lists = (
        blocked.select("block", "n", "m", F.posexplode("prefix").alias("place", "shingle"))
        # What can still be common from this place on.
        .withColumn("left", F.col("m") - F.col("place"))
        .groupBy("shingle", "block")
        .agg(F.min("n").alias("least"), F.max("n").alias("most"), F.max("left").alias("left"))
    )
    one, two = lists.alias("one"), lists.alias("two")

    def reach(a: str, b: str):
        return (F.col(f"{a}.left") * 9 >= 4 * (F.col(f"{a}.least") + F.col(f"{b}.least"))) & (
            F.col(f"{a}.most") * 5 >= 4 * F.col(f"{b}.least")
        )

    across = one.join(
        two,
        (F.col("one.shingle") == F.col("two.shingle")) & (F.col("one.block") < F.col("two.block"))
        & reach("one", "two") & reach("two", "one"),
    ).select(F.col("one.block").alias("a"), F.col("two.block").alias("b")).distinct()
    return blocked.select("id", "block"), across


def links(classes: DataFrame) -> DataFrame:
    """Steps 4 and 5 over sets (id, n, size, shared, prefix): id, to, links."""
    blocked, across = candidate_pairs(classes)
    pairs = across.select(F.xxhash64("a", "b").alias("pair"), "a", "b")
    sides = pairs.select("pair", F.col("a").alias("block"), F.lit(False).alias("second")).unionByName(
        pairs.select("pair", F.col("b").alias("block"), F.lit(True).alias("second"))
    )
    members = sides.join(blocked, "block").select("pair", "second", "id").unionByName(
        blocked.select(F.xxhash64("block").alias("pair"), F.lit(False).alias("second"), "id")
    )
    work = members.join(classes.select("id", "n", "size", "shared"), "id")
    groups = 4 * shuffle_width(classes.sparkSession)
    return (
        work.withColumn("task", F.pmod("pair", F.lit(groups)))
        .groupBy("task").applyInArrow(lambda table: _compare(table), "id binary, to binary, links long")
    )


def components(edges: DataFrame) -> DataFrame:
    """(id, root) of every vertex of undirected edges (id, to): least label and pointer jumping."""
    both = stored(
        in_few_files(
            edges.select("id", "to").unionByName(edges.select(F.col("to").alias("id"), F.col("id").alias("to")))
            .filter("id != to").distinct()
        ),
        "edges",
    )
    labels = stored(in_few_files(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("root"))), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("to"), F.col("root").alias("theirs")), "to")
        least = near.groupBy("id").agg(F.min("theirs").alias("theirs"))
        nearer = labels.join(least, "id").select("id", F.least("root", "theirs").alias("next"), "root")
        jumped = nearer.join(
            labels.select(F.col("id").alias("next"), F.col("root").alias("beyond")), "next", "left"
        ).select("id", "root", F.least("next", F.coalesce("beyond", "next")).alias("next"))
        new = stored(in_few_files(jumped), "labels")
        if new.filter("root != next").isEmpty():
            return labels
        labels = new.select("id", F.col("next").alias("root"))


def set_links(sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal sets, the links between them, and the component (root) of each linked class.

    `first` is the row that comes first in its class: of least doc_id (null last), then of least name.
    """
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "name")
    classes = stored(
        in_few_files(sets.filter("n > 0").groupBy("id", "n").agg(
            F.min("doc_id").alias("least"), F.min(rank).alias("first"), F.count(F.lit(1)).alias("size"),
            F.first("shared", ignorenulls=True).alias("shared"), F.first("prefix", ignorenulls=True).alias("prefix"),
        )),
        "classes",
    )
    # Each pair of blocks counts links of its own. Summed up they are few rows, which fill few files instead
    # of one for each task: of every file that Hadoop makes in a local folder, it starts several processes.
    found = links(classes.filter("prefix IS NOT NULL"))
    linked = stored(in_few_files(found.groupBy("id", "to").agg(F.sum("links").alias("links"))), "links")
    return classes, linked, components(linked)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links.

    Words are runs of other than ASCII white space with A-Z lowered; a set holds the distinct runs
    of five words, of a shorter text the whole. Two documents link when 100 * intersection >= 80 * union.
    component_id is the smallest doc_id reachable by links, n_links the number of documents
    linked directly. Documents of equal sets are one class: they are counted, never paired. Null
    and blank texts have no set and link with nothing. Each row gets a row; rows
    of one doc_id are documents of their own that share a name. A component whose rows all lack a doc_id has
    none. Other columns are ignored; doc_id must be a whole number.
    """
    sets = shingle_sets(docs)
    classes, linked, roots = set_links(sets)
    least = (
        classes.select("id", "least").join(roots, "id")
        .groupBy("root").agg(F.min("least").alias("component_id"))
    )
    found = (
        classes.select("id", "least", "size")
        .join(linked.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
        .join(roots.join(least, "root").select("id", "component_id"), "id", "left")
        .select("id", F.coalesce("component_id", "least").alias("component_id"),
                (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    )
    return sets.select("doc_id", "n", "id").join(found, "id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


# A character that belongs to a word.
_WORD = r"[^\t\n\x0B\f\r ]"


def first_of_each(docs: DataFrame) -> DataFrame:
    """Rows of docs (all columns) of which one of each component stays, whatever doc_ids its rows have.

    The row of least doc_id stays (null last), of several texts of that doc_id the one of least
    `row_name`, of rows equal in both any one. Rows without words have no set, link with nothing and all stay.
    """
    classes, _, roots = set_links(shingle_sets(docs, row_name()))
    chosen = (
        classes.select("id", "first").join(roots, "id", "left")
        .groupBy(F.coalesce("root", "id")).agg(F.min("first").alias("first"))
        .select(F.col("first.name").alias("name"))
    )
    copies = Window.partitionBy("name").orderBy(F.lit(1))
    kept = (
        held(docs, name=row_name()).join(chosen, "name", "left_semi")
        .withColumn("copy", F.row_number().over(copies)).filter("copy = 1")
    )
    # Nearly all texts show a word in their first characters, so few are searched whole.
    wordless = docs.filter(
        F.when(F.col("text").isNull(), True).when(F.substring("text", 1, 32).rlike(_WORD), False)
        .otherwise(~F.col("text").rlike(_WORD))
    )
    return in_few_files(kept.select("row.*").unionByName(wordless), TEXT_WRITERS)
