"""Hard negatives, main text and token alignment against plain versions, on rows with the awkward cases."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from functools import lru_cache
from html import unescape

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlane.llm import alignment, hard_negatives, main_text
from ledgerlane.llm.common import ship_package
from ledgerlane.llm.queries import QUERIES
from tests.compare import given_tables, sorted_rows
from tests.llm.test_operators import TEXTS, same

RNG = np.random.default_rng(17)


# --- Hard negatives ------------------------------------------------------------------------------


def mined(rows, is_anchor, low=80):
    """Plain loops over all pairs."""
    width = max(len(v) for _, _, v in rows)
    whole = {(i, y, tuple([math.floor(256 * x) for x in v] + [0] * (width - len(v)))) for i, y, v in rows}
    out = []
    for i, y, v in whole:
        if not is_anchor(i):
            continue
        near = sorted((-sum(map(int.__mul__, v, w)), j, z) for j, z, w in whole if (j, z, w) != (i, y, v))
        for p, j, _ in [n for n in near if n[2] == y][:5]:
            fit = [n for n in near if n[2] != y and low * -p <= 100 * -n[0] <= 100 * -p][:5]
            out += [(i, j, r, n, -p, -q) for r, (q, n, _) in enumerate(fit, 1)]
    return out


def vectors_of(spark, rows):
    return spark.createDataFrame(
        [(i, v, y, "x", 0) for i, y, v in rows],
        "vec_id long, embedding array<double>, label int, anchor string, part int")


@pytest.mark.parametrize("tile_rows", [16_384, 40])
def test_negatives_equal_all_pairs(spark, monkeypatch, tile_rows):
    ship_package(spark)
    for name, value in (("TILE_ROWS", tile_rows), ("LEAF_ROWS", 8), ("ANCHOR_ROWS", 7)):
        monkeypatch.setattr(hard_negatives, name, value)
    monkeypatch.setattr(hard_negatives.grow, "__defaults__", (8, 3))
    monkeypatch.setattr(hard_negatives.packed_order, "__defaults__", (8,))
    centres = RNG.normal(size=(6, 5))
    rows = [(i, int(RNG.integers(0, 4)), (centres[i % 6] + RNG.normal(size=5) / 6).round(1).tolist()) for i in range(400)]
    rows += [(1000 + i, i % 3, rows[10][2]) for i in range(90)]  # copies
    rows += [(10, rows[10][1], rows[10][2]), (10, rows[10][1], rows[11][2]), (10, 3 - rows[10][1], rows[10][2])]
    rows += [(20, 1, [0.0] * 5), (30, 2, [1.0, -2.0]), (40, 9, rows[3][2]), (50, 1, [])]
    odd = [(60, None, rows[0][2]), (70, 1, None), (80, 1, [None, 1.0, 1.0, 1.0, 1.0]), (None, 1, rows[0][2]),
           (90, 1, [float("nan"), 1.0, 1.0, 1.0, 1.0]), (90, 1, [float("-inf"), 1.0, 1.0, 1.0, 1.0])]
    df = vectors_of(spark, rows + odd).repartition(5)
    found = hard_negatives.mine(df, F.col("vec_id") % 10 == 0)
    wanted = mined(rows, lambda i: i % 10 == 0)
    assert len(wanted) > 300
    same(found.collect(), wanted)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0


def test_scores_beyond_exact_doubles_stop(spark):
    with pytest.raises(ValueError, match="2\\*\\*53"):
        hard_negatives.mine(vectors_of(spark, [(0, 1, [1e9, 1.0])]), F.lit(True))


def test_boxes_close_where_nothing_can_be_found():
    """Clustered rows: the queue opens few leaves, and none outside the window."""
    x = np.concatenate([RNG.normal(c, 0.5, size=(500, 3)) for c in (0, 40, 80, 120)])
    x = x[hard_negatives.packed_order(x, 25)]
    tree = hard_negatives.grow(x, 25, 4)
    least, most = tree.bounds(np.array([[1.0, 1.0, 1.0]]))
    products = x.sum(axis=1)
    for box in range(tree.leaves):
        inside = products[tree.first[box] : tree.after[box]]
        assert least[0, box] - 1e-9 <= inside.min() and inside.max() <= most[0, box] + 1e-9
    search = hard_negatives.Search(tree, np.ones(3), least[0], most[0])
    ids = [[i] for i in range(len(x))]
    found = search.best(5, np.ones(len(x), bool), ids, None, 100.0, 130.0)
    order = [i for i in np.argsort(-products, kind="stable") if 100 <= products[i] <= 130][:5]
    assert [i for _, i in found] == order
    assert len(search.scores) < tree.leaves / 3


def test_negatives_equal_their_sql(spark):
    from ledgerlane.llm.oracle import ORACLE_SQL

    sf_dir = "/root/testdata/sf0.01"
    twin = given_tables(sf_dir).execute(ORACLE_SQL["op11_str_negatives"]).df()
    assert len(twin) > 50
    assert sorted_rows(QUERIES["op11_str_negatives"](spark, sf_dir).toPandas()) == sorted_rows(twin)


# --- Main text -----------------------------------------------------------------------------------

BODY = ("<p>The first paragraph, with commas, has some length so that it counts.</p>"
        "<p>The second&nbsp;one\n is &lt;shorter&gt; &amp; fine.</p>")
TEXT = "The first paragraph, with commas, has some length so that it counts.\nThe second one is <shorter> & fine."
CASES = [
    (BODY, TEXT), ("", ""), ("<p></p> \n", ""), ("just words", "just words"), ("<!-- x --><script>a<b</script>", ""),
    (f"<html><body><nav><a href=x>Menu</a></nav><article><h1>Title</h1>{BODY}</article><footer>Foot</footer>",
     "Title\n" + TEXT),
    # Containers known by their words alone.
    (f"<div class='site-header'>Site</div><div id=main><div class='content'><h2>Title</h2>{BODY}</div>"
     "<div class='sideBar'><p>Buy, buy, buy.</p></div><div id='comments'><article><p>Nice, very nice.</p></article></div>"
     "</div><div class=footer>Foot</div>", "Title\n" + TEXT),
    # The container's siblings: a heading and a part of the article, a list of links.
    (f"<div><h1>Title</h1><div>{BODY}</div><div>{BODY}</div><ul><li><a href=a>one</a><li><a href=b>two, three</a></ul></div>",
     f"Title\n{TEXT}\n{TEXT}"),
    # End tags left out, stray end tags, upper case, br, tables and lists.
    ("<ARTICLE><P>One<B>bold<BR>line<P>two</div></span><UL><LI>a<LI>b</UL><TABLE><TR><TD>c<TD>d</TABLE>tail",
     "Onebold line\ntwo\na\nb\nc\nd\ntail"),
    ("<article><p>one <script>var a='</p>'</script>line<style>p{}</style> here</p></article>", "one line here"),
    (f"<main><form><input value=x><p>Subscribe now, please.</p></form>{BODY}<aside>Note</aside></main>", TEXT),
    (f"<div style='display:none'>Hidden</div><div role=navigation>Go</div><article>{BODY}"
     "<div class=ad>Advert, advert.</div><section class='comment-list'>Reader</section></article>", TEXT),
    (f"<article><header><h1>Title</h1></header>{BODY}</article><header>Page</header>", "Title\n" + TEXT),
    ("<p title=\"it's > here\">kept, yes</p><a href='x>broken</a>", "kept, yes\nbroken"),
    ("<article><h1>Only a title</h1></article>", "Only a title"),
    ("&#65;&#x42;&eacute;&notareference; &copy", "ABé¬areference; ©"),
]


@pytest.mark.parametrize("html, text", CASES)
def test_main_text_of_hand_made_pages(html, text):
    assert main_text.main_text(html) == text


def test_deep_pages_need_no_recursion():
    assert main_text.main_text("<div><b>" * 30_000 + "deep") == "deep"


def test_all_rows_are_extracted(spark):
    ship_package(spark)
    rows = [(i, None if i == 3 else f"u{i}", h, "t", 1) for i, (h, _) in enumerate(CASES)]
    rows += [(0, "u0", BODY, "t", 1), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    wanted = [(i, u, main_text.main_text(h or ""), len(main_text.main_text(h or ""))) for i, u, h, _, _ in rows]
    same(main_text.extract(df).collect(), wanted)
    assert main_text.extract(df.limit(0)).count() == 0


def test_given_pages_yield_their_articles(spark):
    """The given pages' articles are marked, so a plain cut at the marks tells what to expect."""
    sf_dir = "/root/testdata/sf0.01"
    found = {r["page_id"]: r for r in QUERIES["op12_tree_text"](spark, sf_dir).collect()}
    pages = given_tables(sf_dir).execute("SELECT page_id, url, html FROM pages").fetchall()
    assert len(found) == len(pages)
    for page_id, url, html in pages:
        article = re.search(r"<article>(.*?)</article>", html, re.S)[1].replace("<br>", " ")
        cut = [" ".join(unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        text = "\n".join(x for x in cut if x)
        assert (found[page_id]["url"], found[page_id]["text"], found[page_id]["n_chars"]) == (url, text, len(text))


# --- Token alignment -----------------------------------------------------------------------------

FILES = alignment.Vocabularies(
    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"))


@lru_cache(maxsize=1)
def other_libraries():
    words = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=FILES.model_file)
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in keep} | {
        chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in keep)}
    names = {i: t for t, i in words.get_vocab().items()}
    return words, pieces, table, names


def other_ids(text):
    """Ids and token bytes by the two libraries that the contract names."""
    words, pieces, table, names = other_libraries()
    a = words.encode(" " + text, add_special_tokens=False).ids
    b = pieces.encode(text)
    return ([(i, bytes(table[c] for c in names[i])) for i in a],
            [(i, bytes([int(pieces.id_to_piece(i)[3:-1], 16)]) if pieces.is_byte(i)
              else pieces.id_to_piece(i).replace("▁", " ").encode()) for i in b])


def aligned_plainly(rows):
    parts = []
    for name, text in rows:
        a, b = other_ids(text) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            a, b = [], []

        def spans(tokens):
            at = np.cumsum([0] + [len(x) for _, x in tokens]).tolist()
            return [(i, s, e) for (i, _), s, e in zip(tokens, at, at[1:])]

        a, b = spans(a), spans(b)
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [([i for i, _, e in a if lo < e <= hi], [i for i, _, e in b if lo < e <= hi])
                  for lo, hi in zip([0, *ends], ends)]
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            k = first
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        parts.append((name, a, b, groups, links))
    counts = Counter(p for *_, links in parts for p in set(links))
    highest = {}
    for (a, _), n in counts.items():
        highest[a] = max(highest.get(a, 0), n)
    out = []
    for name, a, b, groups, links in parts:
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((name, len(a), len(b), len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(shown.encode()).hexdigest() if a else ""))
    return out


ODD = ["<|endoftext|> is text <s> </s> <0x41> <unk>", "a ▁ mark", "▁", " ", "  two", "nul \x00 \x7f", "é́ 日本語 ¿😀👩‍👩‍👧", "ﬁ ½ Å",
       "x" * 3000, "\r\n\r\n\t\t", " nb　sp", "don't DON'T I'll we've", "1234567890 3.14", "ſt İı ǅ"]


@pytest.mark.parametrize("small", [False, True])
def test_alignment_equals_plain_spans(spark, monkeypatch, small):
    ship_package(spark)
    texts = [t[:20_000] if t else t for t in TEXTS] + ODD + ["the cat sat on the mat"] * 9
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "One two"), (None, None)]
    df = spark.createDataFrame([(i, t, 7, "c", 1) for i, t in rows],
                               "doc_id long, text string, n_a int, chunk string, part int").repartition(4)
    wanted = aligned_plainly(rows)
    assert sum(w[1] == 0 for w in wanted) > 3
    if small:
        # Many chunks, blocks of few pairs and merges that count early.
        real = alignment._encoded

        def cut_small(*args):
            alignment.CHUNK_BYTES, alignment.BLOCK_PAIRS, alignment.HELD_PAIRS = 300, 3, 5
            return real(*args)

        real_merge = alignment.Merge

        class Eager(real_merge):
            def __init__(self, *args):
                super().__init__(*args)
                self.patience = 5

        monkeypatch.setattr(alignment, "_encoded", cut_small)
        monkeypatch.setattr(alignment, "Merge", Eager)
    same(alignment.align(df, FILES).collect(), wanted)
    assert alignment.align(df.limit(0), FILES).count() == 0


def test_merge_counts_early_and_late_alike():
    """Runs fed block by block give the counts of all pairs at once, whenever the merge looks."""
    b_ids = 100
    runs = [np.unique(RNG.integers(0, 4000, 300)) for _ in range(12)]
    counts = Counter(p for r in runs for p in r.tolist())
    highest = {}
    for p, n in counts.items():
        highest[p // b_ids] = max(highest.get(p // b_ids, 0), n)
    for patience in (0, 50, 10**9):
        merge = alignment.Merge(0, b_ids)
        merge.patience = patience
        blocks = sorted(((r[k : k + 20], c) for c, r in enumerate(runs) for k in range(0, len(r), 20)),
                        key=lambda x: (x[0][0], x[1]))
        found = []
        for pairs, chunk in blocks:
            found += merge.feed(chunk, pairs, np.ones(len(pairs), np.int64))
            if patience < 10**9:
                merge.patience = patience
        found += merge.counted(None)
        for chunk, run in enumerate(runs):
            own = sorted((f for f in found if f["chunk"] == chunk), key=lambda f: f["first"])
            got = np.concatenate([alignment.restored(f["count"]) for f in own])
            bits = np.concatenate([np.unpackbits(np.frombuffer(f["best"], np.uint8),
                                                 count=len(alignment.restored(f["count"]))) for f in own])
            assert got.tolist() == [counts[p] for p in run.tolist()]
            assert bits.tolist() == [int(counts[p] == highest[p // b_ids]) for p in run.tolist()]


def test_alignment_query_on_whole_tables(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = given_tables(sf_dir).execute("SELECT doc_id, text FROM documents").fetchall()
    same(QUERIES["op13_token_alignment"](spark, sf_dir).collect(), aligned_plainly(rows))
