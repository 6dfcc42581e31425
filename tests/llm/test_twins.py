"""Plain twins of the operators that SQL cannot express, and of the whole pipeline."""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlane.llm import pseudonyms, quality, token_spans, toxicity
from ledgerlane.llm.common import ship_package
from tests.llm.test_operators import TEXTS, same, words

RNG = np.random.default_rng(23)


# --- op2: the allocation rule where sections cut tokens -------------------------------------------


def owner_of(start, end, sections, rule):
    """The section of a token by counting its bytes in each."""
    held = [0] * len(sections)
    for byte in range(start, end):
        held[max(k for k, s in enumerate(sections) if s <= byte)] += 1
    inside = [k for k, n in enumerate(held) if n]
    return {"first": inside[0], "last": inside[-1], "most": held.index(max(held))}[rule], len(inside) > 1


@pytest.mark.parametrize("rule", token_spans.RULES)
def test_sections_that_cut_tokens(spark, rule):
    given = (public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    encoding, lengths = token_spans._encoder(*given)
    texts = [t[:600] if t else t for t in TEXTS] + ["One. Two! Three?\n\nFour... \"Five.\" Six", ". . .", "End. "]
    rows = [(i, t, [0, *sorted({int(k) for k in RNG.integers(1, max(2, len((t or "").encode())), 9)
                                if k < len((t or "").encode())})]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, cuts array<int>")
    for by_column in (True, False):
        options = {"sections": F.col("cuts")} if by_column else {"starts_of": token_spans.sentence_starts}
        found = token_spans.section_tokens(df, *given, rule=rule, **options)
        wanted, crossed = [], 0
        for i, text, cuts in rows:
            body = (text or "").encode()
            cuts = cuts if by_column else token_spans.sentence_starts(body).tolist()
            counts, crossing, at = [0] * len(cuts), [0] * len(cuts), 0
            for token in encoding.encode_ordinary(text or ""):
                k, over = owner_of(at, at + int(lengths[token]), cuts, rule)
                counts[k] += 1
                crossing[k] += over
                at += int(lengths[token])
            crossed += sum(crossing)
            wanted += [(i, k, s, e, counts[k], crossing[k]) for k, (s, e) in enumerate(zip(cuts, [*cuts[1:], len(body)]))]
        assert crossed > 5
        same(found.collect(), wanted)


def test_sentences_end_where_white_space_follows():
    text = b"One. Two! Three?\n\nFour 3.5 e.g.x end.  "
    starts = token_spans.sentence_starts(text)
    parts = [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])]
    assert parts == [b"One. ", b"Two! ", b"Three?\n\n", b"Four 3.5 e.g.x end.  "]


# --- op4: flattened traversal against a walk from node to node ------------------------------------


def test_flattened_trees_equal_a_plain_walk(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.fit_on(docs, labels)
    assert len(forest.roots) == 100 and len(forest.feature) > 300

    def walk(node, row):
        while forest.left[node] != node:
            node = forest.right[node] if row[forest.feature[node]] > forest.threshold[node] else forest.left[node]
        return forest.value[node]

    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality.score_quality(docs, forest).collect():
        row = quality.statistics((texts[r["doc_id"]] or "").encode())
        total = forest.base + sum(walk(root, row) for root in forest.roots)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-total)), abs=1e-12)
        assert r["predicted"] == int(r["score"] >= 0.3)


# --- op7: a plain Feistel network and its inverse -------------------------------------------------


def shift(key, tag, number, fixed, place, radix):
    seed = hashlib.sha256(f"{key}|{tag}|{number}|{','.join(map(str, fixed))}".encode()).hexdigest()
    first = xxhash.xxh64(seed.encode(), seed=42).intdigest()
    value = xxhash.xxh64(struct.pack("<i", place), seed=first).intdigest()
    value -= (value >> 63) << 64
    return value % radix


def feistel(symbols, radices, tag, key, back=False):
    state = list(symbols)
    rounds = range(pseudonyms.ROUNDS)
    for number in reversed(rounds) if back else rounds:
        fixed = [v for i, v in enumerate(state) if i % 2 != number % 2]
        for i in range(number % 2, len(state), 2):
            by = shift(key, tag, number, fixed, i, radices[i])
            state[i] = (state[i] + (-by if back else by)) % radices[i]
    return state


def plain_pseudonym(value, tag, key, back=False):
    radices = [10 if c.isdigit() else 26 if c.isalpha() else 1 for c in value]
    low = [ord("0") if c.isdigit() else ord("a") if c.islower() else ord("A") if c.isupper() else 0 for c in value]
    symbols = [ord(c) - a if r > 1 else 0 for c, a, r in zip(value, low, radices)]
    moved = feistel(symbols, radices, tag, key, back)
    return "".join(chr(v + a) if r > 1 else c for c, v, a, r in zip(value, moved, low, radices))


def test_pseudonyms_equal_a_plain_network_and_its_inverse(spark):
    letters = "0123456789abcxyzABCXYZ-. "
    values = ["".join(RNG.choice(list(letters), int(RNG.integers(1, 20)))) for _ in range(60)] + ["123-45-6789", "1", "a"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.select("v", pseudonyms.permuted_characters(F.col("v"), "t", "key").alias("p")).collect()
    for r in found:
        assert r["p"] == plain_pseudonym(r["v"], "t", "key")
        assert plain_pseudonym(r["p"], "t", "key", back=True) == r["v"]
    octets = [[int(x) for x in RNG.integers(0, 256, 4)] for _ in range(40)]
    df = spark.createDataFrame([(".".join(map(str, o)),) for o in octets], "v string")
    moved = df.select("v", pseudonyms.address_pseudonym(F.col("v"), "key").alias("p")).collect()
    for r in moved:
        new = [int(x) for x in r["p"].split(".")]
        old = [int(x) for x in r["v"].split(".")]
        assert new == feistel(old, [256] * 4, "address", "key")
        assert feistel(new, [256] * 4, "address", "key", back=True) == old


# --- op8: a plain reader of clauses ----------------------------------------------------------------


def read_plainly(symbols):
    """Patterns of a clause, each attack judged by looking around it."""
    t = toxicity
    found = []
    for i, kind in enumerate(symbols):
        if kind not in (t.INSULT, t.THREAT):
            continue
        before = symbols[:i]
        after = symbols[i + 1 : i + 1 + t.TARGET_REACH]
        # A later attack of the same kind takes the target that follows it.
        near = after[: after.index(kind)] if kind in after else after
        marks = t.TARGETED * (t.TARGET in before or t.TARGET in near)
        marks |= t.NEGATED * (t.NEGATION in before[-t.NEGATION_REACH :])
        said = [k for k, s in enumerate(before) if s == t.REPORT]
        marks |= t.REPORTED * bool(said and t.OTHER not in before[said[-1] :])
        found.append(marks + t.PATTERNS * (kind == t.THREAT))
    return sorted(found)


def test_composed_grammar_equals_a_plain_reader():
    for _ in range(4000):
        symbols = RNG.integers(0, toxicity.END, int(RNG.integers(0, 14))).tolist()
        assert sorted(toxicity.matched(symbols)) == read_plainly(symbols)


def test_order_and_scope_decide():
    weights, bias = toxicity.prior()
    grammar = toxicity.Grammar(toxicity.fixed_symbols(), frozenset(), weights, bias)
    t, n, r, threat = toxicity.TARGETED, toxicity.NEGATED, toxicity.REPORTED, toxicity.PATTERNS
    for text, patterns in [
        ("he said hello you idiot", [t]), ("he said you are an idiot", [t | r]), ("you idiot, not that I care", [t]),
        ("you are not an idiot", [t | n]), ("idiot, not you", [t]), ("an idiot", [0]), ("we will kill you", [threat | t]),
        ("he told them to kill you", [threat | t | r]), ("not one of all the many people is an idiot", [0]),
        ("Nobody came. What an idiot.", [0]), ("idiot idiot you", [0, t]), ("calm words", []),
    ]:
        features = grammar.features(text.encode())
        assert np.flatnonzero(features[:-1]).tolist() == sorted(set(patterns)), text


# --- The pipeline, row by row ----------------------------------------------------------------------


def plain_windows(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    return [tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))] if w else []


def plain_set(text):
    w = (text or "").lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[k : k + 5]) for k in range(len(w) - 4)))


def test_pipeline_equals_plain_loops(spark, tmp_path):
    ship_package(spark)
    base, other = words(80), " ".join(f"v{i}" for i in range(40))
    item = " ".join(f"b{i}" for i in range(14))
    texts = [
        base, base + " tail", base.replace("alpha", "beta", 1), words(60), "You are an idiot. You idiot, I will kill you.",
        "He said that it is not an idiot.", f"see {item} there", f"see {' '.join(item.split()[:9])} there", "number 123-45-6789 it is",
        "again 123-45-6789.", None, "", " \n", other, other, other + " x y", "short one", "Short  one", "tokens ▁ and 😀 end",
    ]
    rows = [(i, t, "en", f"s{i}", 1) for i, t in enumerate(texts)] + [(None, base, "en", "n", 1), (13, other, "en", "r", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()

    weights, bias = toxicity.prior()
    grammar = toxicity.Grammar(toxicity.fixed_symbols(), frozenset(), weights, bias)
    kept = [(i, t) for i, t, *_ in rows if grammar.score(grammar.table(pa.array([t], pa.string())))[0] < 0.5]
    assert len(kept) == len(rows) - 1
    sets, group = [plain_set(t) for _, t in kept], list(range(len(kept)))
    for a in range(len(kept)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                group = [group[b] if g == group[a] else g for g in group]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0))
    first = {}
    for k in order:
        first.setdefault(group[k] if sets[k] else ("none", k), k)
    # Of several texts of the least doc_id any may stay; here these are equal.
    kept = [kept[k] for k in sorted(first.values())]
    bad = set(plain_windows(item))
    kept = [(i, t) for i, t in kept if not bad.intersection(
        w[k : k + 10] for w in [tuple(x for x in re.findall(r"[a-z0-9\x80-\U0010ffff]+", (t or "").lower()))]
        for k in range(max(1, len(w) - 9)))]
    key = corpus_pipeline.DEMO_KEY
    kept = [(i, t and re.sub(r"\d{3}-\d{2}-\d{4}", lambda m: plain_pseudonym(m[0], "social", key), t)) for i, t in kept]
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    wanted = []
    for i, t in kept:
        ids = model.encode(t or "")
        wanted.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                       hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert {8, 9} <= {i for i, _ in kept} and 6 not in {i for i, _ in kept} and 7 in {i for i, _ in kept}
    same(found, wanted)


# --- One group of many megabytes under one head ----------------------------------------------------


def test_a_group_of_many_megabytes_is_counted_by_hash(spark, monkeypatch):
    """Texts of one letter and a number: all strings share their anchors, and few are equal."""
    from ledgerlane.llm import suffixes

    ship_package(spark)
    monkeypatch.setattr(suffixes, "GROUP_BYTES", 20_000)
    unit = "z" * 396
    texts = [unit + f"{i:06}" + "z" * (i % 7) + unit for i in range(120)] + ["z" * 5000, "y" * 399, "z" * 400 + "q" * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = {}
    for t in texts:
        for k in range(len(t) - 399):
            counts[t[k : k + 400]] = counts.get(t[k : k + 400], 0) + 1
    found = {r["doc_id"]: r for r in suffixes.remove_repeated(df).collect()}
    for i, t in enumerate(texts):
        gone = np.zeros(len(t), bool)
        for k in range(len(t) - 399):
            if counts[t[k : k + 400]] > 1:
                gone[k : k + 400] = True
        kept = "".join(c for c, g in zip(t, gone, strict=True) if not g)
        assert (found[i]["n_removed"], found[i]["kept_sha256"]) == (int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest())
    assert found[120]["n_removed"] == 5000
