"""Stages of the pipeline on rows whose doc_id is missing or repeated."""

from __future__ import annotations

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string"


def kept(stage, spark, rows, sf_dir=""):
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).repartition(3)
    out = stage(spark, docs, sf_dir)
    assert out.columns == docs.columns
    return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)


def test_only_contaminated_texts_go(spark, tmp_path):
    item = " ".join(f"b{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [(None, "a clean text"), (None, None), (7, "another clean text"), (8, ""), (8, "a clean text")]
    hit = [(None, f"so {item} it is"), (7, item), (9, f"so {item} it is")]
    assert kept(corpus_pipeline.drop_contaminated, spark, clean + hit, str(tmp_path)) == sorted(clean, key=str)


def test_one_row_of_each_group_stays(spark):
    base = [f"w{i}" for i in range(60)]
    text, near, nearer = " ".join(base), " ".join([*base, "end"]), " ".join([*base, "last"])
    other = " ".join(f"v{i}" for i in range(30))
    rows = [
        # Copies with and without a doc_id, and two near copies under the least doc_id.
        (3, text), (3, text), (3, near), (None, text), (None, nearer), (None, nearer),
        # doc_id 9 roots a component and has a near copy of document 3.
        (9, other), (9, nearer),
        # A component without any doc_id.
        (None, "four words stand here"), (None, "Four words\n stand here"), (None, "four words stand here"),
        # No words: nothing is a copy.
        (None, None), (None, None), (5, ""), (5, ""), (None, " \n\t\r"), (None, "\u00a0"), (6, "\u00a0"),
    ]
    out = kept(corpus_pipeline.drop_near_duplicates, spark, rows)
    group = [r for r in out if r[1] in (text, near, nearer)]
    assert len(group) == 1 and group[0][0] == 3
    assert [r for r in out if r[1] == other] == [(9, other)]
    assert len([r for r in out if (r[1] or "").lower().startswith("four")]) == 1
    assert [r for r in out if r[1] == "\u00a0"] == [(6, "\u00a0")]
    assert sorted(str(r) for r in out if not (r[1] or "").strip(" \n\t\r")) == sorted(
        str(r) for r in [(None, None), (None, None), (5, ""), (5, ""), (None, " \n\t\r")])
    assert len(out) == 9


CLASHING = ["score", "predicted", "held_out", "n_values", "hit", "_name", "_copy", "_found", "row", "name", "copy", "done",
            "label", "words", "places", "id", "a.b"]


def test_columns_of_any_name_stay(spark, tmp_path):
    """Each stage keeps what a row brings under names that stages use themselves."""
    item = " ".join(f"b{i}" for i in range(12))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    texts = ["you are an idiot, you idiot, kill you", "calm words stand here", "calm words stand here", f"so {item}",
             "mail ann@example.com now", None, ""]
    docs = spark.createDataFrame(
        [(i, t, *[f"{c}{i}" for c in CLASHING]) for i, t in enumerate(texts)],
        "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING))
    wanted = {0: {1, 2, 3, 4, 5, 6}, 1: {0, 1, 3, 4, 5, 6}, 2: {0, 1, 2, 4, 5, 6}, 3: set(range(7))}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        rows = {r["doc_id"]: r for r in out.collect()}
        assert set(rows) == wanted[k]
        for i, r in rows.items():
            assert [r[c] for c in CLASHING] == [f"{c}{i}" for c in CLASHING]
            assert r["text"] == texts[i] or (k == 3 and i == 4 and len(r["text"]) == len(texts[4]))
    assert corpus_pipeline.STAGES[4][1](spark, docs, str(tmp_path)).count() == 7
