"""The registered queries over given tables: SQL, contracts, held-out quality, and the pipeline."""

import random
import zlib
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import compare, duck
from test_operators_llm import brute_components, brute_contained, brute_fingerprint
from tiltwatch.llm import oracle, queries

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_same_as_sql(spark, name):
    compare(queries.all_queries()[name](spark, SMALL), duck(SMALL), oracle.all_sql()[name])


def test_all_are_registered():
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert "pipeline" in names and set(oracle.all_sql()) <= set(entry.oracle_sql())


def test_language_quality(spark):
    docs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, MIDDLE).collect()
    assert {r["doc_id"]: r["held_out"] for r in rows} == {d: zlib.crc32(str(d).encode()) % 4 == 2 for d in docs}
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]] for r in held) >= 0.98 * len(held)


def test_toxicity_quality(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    held = [r for r in queries.op10_toxicity(spark, MIDDLE).collect() if r["held_out"] and r["doc_id"] in labels]
    toxic = [r["predicted"] for r in held if labels[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not labels[r["doc_id"]]]
    # Some forty labels of each language are all there is to learn from at this size.
    assert sum(toxic) >= 0.5 * len(toxic) and sum(clean) <= 0.05 * len(clean)


def _odd_documents(spark):
    rng = random.Random(3)
    sounds = {"de": "abekl", "en": "iomnr"}
    make = lambda lang, n: " ".join("".join(rng.choices(sounds[lang], k=5)) for _ in range(n))
    rows = [(i, make(lang, 40), lang, "a", 0) for i in range(120) for lang in [("de", "en")[i % 2]]]
    rows += [(200, make("de", 40), None, None, None), (201, make("en", 40), "de", "b", 0)]
    both = "zq"  # letters of neither language
    rows += [(202, both, "en", "a", 0), (203, both, None, "a", 0), (204, None, "de", "a", 0), (205, "", "de", None, 0)]
    rows += [(None, make("de", 50), "de", "a", 0), (None, "1 2 3", "de", "a", 0), (7, make("en", 30), "en", "a", 0)]
    rows += [rows[0]] * 3
    return spark.createDataFrame(
        [(*r, "x", True) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, _lang string, _ambiguous boolean"
    )


def test_language_stage_decides(spark, monkeypatch):
    docs = _odd_documents(spark)
    kept = corpus_pipeline.language(spark, docs, SMALL).collect()
    langs = {r["doc_id"]: r["lang"] for r in kept}
    assert langs[200] == "de" and langs[201] == "en"  # a missing and a refuted label
    assert langs[202] == "en" and 203 not in langs  # in neither for sure, with and without a label
    assert not {204, 205} & set(langs) and sum(r["doc_id"] is None for r in kept) == 1
    assert sum(r["doc_id"] == 0 for r in kept) == 4 and sum(r["doc_id"] == 7 for r in kept) == 2
    monkeypatch.setattr(corpus_pipeline, "WANTED", ("en",))
    assert {r["lang"] for r in corpus_pipeline.language(spark, docs, SMALL).collect()} == {"en"}


@pytest.mark.parametrize("rows", ["odd", "none"])
def test_stages_over_odd_rows(spark, rows):
    docs = _odd_documents(spark)
    docs = docs if rows == "odd" else docs.limit(0)
    counts = {name: stage(spark, docs, SMALL).count() for name, stage in corpus_pipeline.STAGES}
    if rows == "none":
        assert set(counts.values()) == {0}
        return
    texts = docs.select("text", "doc_id").collect()
    assert counts["decontamination"] == counts["sharding"] == len(texts)
    assert 0 < counts["simhash_dedup"] < len(texts) and counts["mixing"] > 0


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = docs
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, kept, SMALL).write.parquet(out)
        kept = spark.read.parquet(out)
        if name != "sharding":
            assert kept.columns == docs.columns
        rows[name] = kept.collect()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    first = {d for d, t in texts.items() if any(c.isalpha() for c in t)}
    assert {r["doc_id"] for r in rows["language_id"]} == first
    said = {r["doc_id"]: r["lang_pred"] for r in queries.op7_language_id(spark, SMALL).collect()}
    assert {r["doc_id"]: r["lang"] for r in rows["language_id"]} == {d: said[d] for d in first}
    fps = {d: brute_fingerprint(texts[d]) for d in first}
    ids = sorted(first)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 2]
    roots = brute_components(links)
    second = {d for d in first if roots.get(d, d) == d}
    assert {r["doc_id"] for r in rows["simhash_dedup"]} == second
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    third = second - {d for d, *_ in brute_contained([(d, texts[d]) for d in second], items)}
    assert {r["doc_id"] for r in rows["decontamination"]} == third and third < second < set(texts)
    mixed = Counter()
    for r in rows["mixing"]:
        assert r["text"] == texts[r["doc_id"]] or texts[r["doc_id"]].startswith(r["text"])
        assert r["n_chars"] == len(r["text"])
        mixed["words"] += len(r["text"].split())
    words = sum(len(texts[d].split()) for d in third)
    assert abs(mixed["words"] - 1.5 * words) < 0.01 * words
    held = Counter()
    for r in rows["sharding"]:
        held[r["shard"]] += len(r["text"].encode())
    assert all(held[r["shard"]] == r["shard_bytes"] for r in rows["sharding"])
    assert max(held.values()) <= queries.SHARD_BYTES
    whole = [tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert Counter(whole) == Counter(tuple(r) for r in rows["sharding"])
