from __future__ import annotations

import corpus_pipeline
from tests.llm.test_packing import check
from tests.llm.test_simhash import brute_components, brute_print
from wordbase.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        steps[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    all_docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    lettered = {i: t for i, t in all_docs.items() if any(c.isalpha() for c in t or "")}
    assert steps["language_id"] == lettered
    last = {t: i for i, t in sorted(lettered.items())}
    assert steps["exact_dedup"] == {i: t for t, i in last.items()}
    prints = {i: brute_print(t) for i, t in steps["exact_dedup"].items()}
    roots = brute_components(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    smallest = {}
    for i in sorted(prints):
        smallest.setdefault(roots[prints[i]], i)
    assert set(steps["simhash_near_dedup"]) == set(smallest.values())
    bench = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaked = {i for i, t in steps["simhash_near_dedup"].items() if any(b in t for b in bench)}
    assert leaked and set(steps["decontamination"]) == set(steps["simhash_near_dedup"]) - leaked
    out = corpus_pipeline.run(spark, SF).collect()
    assert check([(i, t) for i, t in steps["decontamination"].items()], out) < 0.1


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
