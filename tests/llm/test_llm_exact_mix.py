import hashlib
import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from threadlens.llm.exact_dedup import drop_exact_duplicates, exact_groups  # noqa: E402
from threadlens.llm.mixing import mix, mix_decisions  # noqa: E402


def digest(text):
    return hashlib.sha256(re.sub("[\x20\x09-\x0d]+", " ", text or "").encode()).hexdigest()


def test_exact_groups_equal_brute_force(spark):
    texts = prose(4, 80)
    texts += [texts[3].replace(" ", " \n "), texts[3] + " ", None, ""]
    # a filter of very few bits lets everything through and changes nothing
    for bits in (1 << 28, 8):
        rows = exact_groups(table(spark, texts, extra=True), max_bits=bits).collect()
        groups = {}
        for i, t in enumerate(texts):
            groups.setdefault(digest(t), []).append(i)
        want = {
            i: (g[0], len(g), i == g[0], d) for d, g in groups.items() for i in g
        }
        assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows} == want
        kept = drop_exact_duplicates(table(spark, texts, extra=True), max_bits=bits)
        assert sorted(r.doc_id for r in kept.collect()) == sorted(g[0] for g in groups.values())
        assert kept.columns == table(spark, texts, extra=True).columns


def test_exact_odd_rows(spark):
    ids, texts = odd_rows()
    docs = table(spark, texts, ids, extra=True)
    rows = exact_groups(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    # null and empty text are one group; blanks alone are another text
    assert {(r.doc_id, r.kept) for r in rows if r.text_sha256 == digest("")} == {
        (1, True), (2, False), (None, False)
    }
    assert sorted(r.kept for r in rows if r.doc_id == 6) == [False, True]
    assert drop_exact_duplicates(docs).count() == len({digest(t) for t in texts})
    assert exact_groups(table(spark, [])).count() == drop_exact_duplicates(table(spark, [])).count() == 0


def plain_targets(sizes):
    """Targets by raising a common level until the budget is spent."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(sizes.values()), set()
    while True:
        rest = budget - sum(2 * sizes[s] for s in full)
        share = {s: rest * weights[s] / sum(weights[x] for x in sizes if x not in full) for s in sizes if s not in full}
        over = {s for s, t in share.items() if t > 2 * sizes[s]}
        if not over:
            return {s: float(2 * sizes[s]) for s in full} | share
        full |= over


def test_mix_meets_targets(spark):
    texts = prose(6, 300)
    docs = table(spark, texts, extra=True).withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))
    )
    rows = mix_decisions(docs).collect()
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len(texts[r.doc_id].split())
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
    want = plain_targets(sizes)
    largest = max(r.size for r in rows)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        assert 0 <= r.copies <= 2
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 2 * largest
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    again = mix_decisions(docs.repartition(7)).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in rows}
    mixed = mix(docs)
    assert mixed.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts == {r.doc_id: r.copies for r in rows if r.copies}


def test_mix_odd_rows(spark):
    ids, texts = odd_rows()
    docs = table(spark, texts, ids, extra=True)
    rows = mix_decisions(docs).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(map(str, ids))
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mix(docs).columns == docs.columns
    empty = table(spark, [])
    assert mix_decisions(empty).count() == 0 and mix(empty).count() == 0
    wordless = table(spark, [None, "", " "])
    assert {r.copies for r in mix_decisions(wordless).collect()} == {0}
