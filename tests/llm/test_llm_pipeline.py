"""The document pipeline and the registered queries on small tables."""

import hashlib
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from cases import prose, table  # noqa: E402
from test_llm_exact_mix import plain_targets  # noqa: E402
from test_llm_packing import encoded, layout  # noqa: E402
from test_llm_quality import junk, plain_statistics  # noqa: E402
from test_llm_simhash import plain_fingerprint, plain_groups  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
import corpus_pipeline  # noqa: E402

NAMES = ["quality_rules", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]


@pytest.fixture(scope="module")
def small_sf(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("small")
    texts, labels = junk(prose(21, 240, words=120))
    texts += ["tiny", None, ""]
    table(spark, texts).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(
        f"{folder}/labels.parquet"
    )
    return str(folder), texts


def plain_survivors(texts):
    """Ids after quality rules, exact and near dedup."""

    def good(i):
        n, _, _, _, repeated = plain_statistics(texts[i])
        return n >= 50 and 100 * repeated <= 50 * n and i % 3 > 0

    ids, seen, first = [i for i in range(len(texts)) if good(i)], set(), []
    for i in ids:
        digest = re.sub("[\x20\x09-\x0d]+", " ", texts[i])
        if digest not in seen:
            seen.add(digest)
            first.append(i)
    roots = plain_groups([plain_fingerprint(texts[i]) for i in first])
    return [i for k, i in enumerate(first) if roots[k] == k]


def plain_mix(texts, sources, ids):
    """How often weighted fair queueing takes every document."""
    size = {i: len(texts[i].split()) for i in ids}
    totals = {}
    for i in ids:
        totals[sources[i]] = totals.get(sources[i], 0) + size[i]
    targets = plain_targets(totals)
    rank = sorted(totals, key=lambda s: (s is None, s or ""))
    places = []
    for s in rank:
        own = sorted((hashlib.md5(f"42|{i}".encode()).hexdigest(), i) for i in ids if sources[i] == s)
        for epoch in range(2):
            sent = epoch * totals[s]
            for key, i in own:
                sent += size[i]
                places.append((sent / targets[s], rank.index(s), epoch, key, i))
    copies, used = dict.fromkeys(ids, 0), 0
    for *_, i in sorted(places):
        used += size[i]
        if used > 1.5 * sum(totals.values()):
            break
        copies[i] += 1
    return copies


def test_pipeline_equals_a_plain_version(spark, small_sf):
    folder, texts = small_sf
    sources = {i: f"src{i % 3}" if i % 7 else None for i in range(len(texts))}
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        kept[name] = sorted(r.doc_id for r in docs.select("doc_id").collect())
    survivors = plain_survivors(texts)
    assert kept["near_dedup"] == survivors
    assert len(kept["quality_rules"]) > len(kept["exact_dedup"]) > len(survivors) > 20
    copies = plain_mix(texts, sources, survivors)
    assert kept["source_mixing"] == sorted(i for i, n in copies.items() for _ in range(n))
    rows = corpus_pipeline.run(spark, folder).collect()
    layout(rows, 4096)
    tokens = dict(zip(survivors, encoded([texts[i] for i in survivors])))
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {i: n * len(tokens[i]) for i, n in copies.items() if n}


def test_pipeline_on_an_empty_table(spark, tmp_path):
    table(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert {"op3_exact_dedup", "op4_source_mixing", "op10_url_filter", "op11_phrase_collocations"} <= set(entry.oracle_sql())
