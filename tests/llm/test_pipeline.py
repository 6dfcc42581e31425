"""The pipeline against its stages' plain meanings on the smallest tables."""

from __future__ import annotations

import re

import corpus_pipeline
import public_tokenizers
import pyarrow as pa
from ledgerlane.llm import common, jaccard, piece_chunks


def test_stages_filter_and_rewrite(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = {r["doc_id"]: r["text"] for r in docs.collect()}
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), f"test-{name}")
        by_stage[name] = docs
    kept = {r["doc_id"]: r["text"] for r in by_stage["toxicity"].collect()}
    assert all(counts[i] == t for i, t in kept.items())
    insult = re.compile(r"\b(idiot|moron|scum)\b")
    assert not [i for i, t in kept.items() if len(insult.findall(t)) > 1]
    assert len(counts) - len(kept) < 0.2 * len(counts)
    groups = jaccard.near_duplicates(by_stage["toxicity"]).select("component_id").distinct().count()
    assert by_stage["near_duplicates"].count() == groups
    assert by_stage["personal_data"].count() == by_stage["decontamination"].count() == docs.count()
    assert by_stage["personal_data"].columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_many_partitions_are_written_to_few_files(spark, tmp_path):
    """Each file that is written in a local folder costs a process: no more than a few for each core."""
    cores = spark.sparkContext.defaultParallelism
    n = 40 * cores
    # Each text has a near copy, so that every table of the step has rows in every partition.
    rows = [(2 * i + k, " ".join(f"w{i}x{j}" for j in range(40 + k)), "en") for i in range(n) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6 * cores)
    spark.createDataFrame([(r[0], 0) for r in rows], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    held = {"spark.sql.shuffle.partitions": str(6 * cores), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before, first = {name: spark.conf.get(name) for name in held}, common.written()
    try:
        for name, value in held.items():
            spark.conf.set(name, value)
        for name, stage in corpus_pipeline.STAGES[:2]:
            docs = corpus_pipeline.stored(stage(spark, docs, str(tmp_path)), f"test-{name}")
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert docs.count() == n
    for folder in common._WRITTEN[first:]:
        most = common.TEXT_WRITERS if "/test-" in folder else common.WRITERS
        assert len(spark.read.parquet(folder).inputFiles()) <= most * cores, folder


def test_workers_give_memory_back_after_each_batch(monkeypatch):
    given = []
    monkeypatch.setattr(piece_chunks, "give_back", lambda: given.append("tokens"))
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(1200)), "text": [None, "", "two words"] * 400})
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    convert = piece_chunks._converted(public_tokenizers.path("piece_bpe_32k.model"), piece_chunks._digests, schema)
    found = list(convert(iter([batch, batch])))
    assert given == ["tokens"] * 2
    assert found[0].equals(found[1]) and found[0].column("doc_id").to_pylist() == list(range(1200))
    assert found[0].column("n_tokens").to_pylist()[:2] == [0, 0] and found[0].column("n_tokens")[2].as_py() > 0


def test_memory_that_was_freed_goes_back():
    """Small objects beside one that stays are not given back by freeing alone."""

    def resident() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"\nPss_Anon:\s+(\d+)", f.read())[1]) << 10

    held = [bytes(4000) for _ in range(20_000)]
    last = bytes(4000)
    before = resident()
    del held
    common.give_back()
    assert before - resident() > 40 << 20
    assert len(last) == 4000
