import re

import public_tokenizers
import tiktoken

import corpus_pipeline as cp
from linkloom.llm import bpe, neardup, pii
from linkloom.llm.common import word_hashes

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(-1, "123 456", "en", "s", 7), (-2, None, "en", "s", None), (-3, "", None, None, 0)], source.schema)
    docs = source.unionByName(extra)
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: r.text for r in docs.collect()}
    out = {}
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        if name != "encoding":
            assert docs.columns == source.columns and docs.dtypes == source.dtypes
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out[name] = {r[0]: r.asDict() for r in docs.collect()}

    first = out["language_id"]
    assert set(before) - set(first) == {-1, -2, -3} and all(first[d]["text"] == before[d] for d in first)

    sets = {d: frozenset(neardup.shingle_set(r["text"], 5).tolist()) for d, r in first.items()}
    root = {}
    for a in sorted(sets):
        if a not in root:
            root[a], front = a, [a]
            while front:
                x = front.pop()
                for y in sets:
                    if y not in root and sets[x] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]):
                        root[y] = a
                        front.append(y)
    assert set(out["near_duplicates"]) == {d for d in root if root[d] == d}

    held = {d for d, r in out["near_duplicates"].items() if any(x in r["text"] for x in items)}
    gone = set(out["near_duplicates"]) - set(out["decontamination"])
    assert held and held <= gone
    words = [set(word_hashes(x).tolist()) for x in items]
    assert all(any(len(w & set(word_hashes(before[d]).tolist())) >= 0.8 * len(w) for w in words) for d in gone)

    for d, r in out["personal_data"].items():
        text = out["decontamination"][d]["text"]
        base = pii.base_spans(text)
        assert r["n_chars"] == len(r["text"])
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r["text"])
        assert bool(base) <= (r["text"] != text)

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d, r in out["encoding"].items():
        ids = known.encode_ordinary(out["personal_data"][d]["text"])
        assert r["n_tokens"] == len(ids) and bytes(r["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_clashing_columns_and_nulls(spark):
    """Stages keep extra columns whatever their names, rows without id, and equal rows as they should."""
    source = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    extra = spark.createDataFrame([(None, source.first().text, "en", "s", 5), (10**9, "x " * 60_000 + "the and of that with", "en", None, None), (10**9 + 1, None, None, None, None)], source.schema)
    names = ["predicted", "PREDICTED_SCORE", "_score", "times", "mark", "id", "fp", "may", "a.b", "c0", "bit"]
    docs = source.unionByName(extra)
    docs = docs.select("*", *(docs["doc_id"].alias(f"x{i}") for i in range(len(names)))).toDF(*docs.columns, *names)
    for name, stage in cp.STAGES[:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert docs.columns == [*source.columns, *names]
        rows = docs.collect()
        assert all(r["a.b"] == r.doc_id == r["_score"] == r.bit for r in rows), name
        if name == "language_id":
            assert None in {r.doc_id for r in rows} and 10**9 + 1 not in {r.doc_id for r in rows}
    assert docs.count() > 10


def test_run_keeps_only_its_result(spark):
    import os

    out = cp.run(spark, SF)
    assert out.count() > 0 and out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    top = os.path.dirname(out.inputFiles()[0].removeprefix("file:"))
    assert os.listdir(os.path.dirname(top)) == [os.path.basename(top)]
