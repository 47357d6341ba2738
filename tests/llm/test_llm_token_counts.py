"""Prefix counts against the library that encodes every prefix anew."""

import random
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

sys.path.insert(0, str(Path(__file__).parent))
from cases import odd_rows, prose, table  # noqa: E402

from threadlens.llm.queries import QUERIES  # noqa: E402
from threadlens.llm.token_counts import (  # noqa: E402
    MARK_CHARS,
    PrefixCounter,
    longest_prefixes,
    prefix_counts,
    token_counts,
    tokens_at,
)

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
COUNTER = PrefixCounter(Path(PATH).read_bytes())


def counts(changes):
    return np.cumsum([0, *np.frombuffer(changes, np.int8)]).tolist()


def library_counts(text):
    return [len(x) for x in LIBRARY.encode([text[:i] for i in range(len(text) + 1)])]


@settings(deadline=None, max_examples=150)
@given(st.text(alphabet=st.sampled_from("abcde theing  \n\t.,'-()=019é数字🙂▁<s>ﬁ"), max_size=60))
def test_every_prefix_of_odd_texts(text):
    assert counts(next(COUNTER.changes([text]))) == library_counts(text)


def test_every_prefix_of_neighbouring_tokens():
    rng = random.Random(2)
    pieces = [p.replace("▁", " ") for p in COUNTER.score]
    texts = ["".join(rng.choices(pieces, k=4)) for _ in range(300)]
    for text, changes in zip(texts, COUNTER.changes(texts)):
        assert counts(changes) == library_counts(text)


def test_index_answers_without_encoding(spark):
    texts = prose(31, 20) + ["", None, " ", "\n", "x" * 5_000, "<s> is </s> plain <0x0A>", "a  b" * 900]
    index = prefix_counts(table(spark, texts, extra=True)).cache()
    want = [library_counts(t or "") for t in texts]
    for r in index.collect():
        assert (r.n_chars, r.n_tokens) == (len(texts[r.doc_id] or ""), want[r.doc_id][-1])
        assert r.marks == want[r.doc_id][MARK_CHARS::MARK_CHARS]
    for share in (0.0, 0.31, 0.77, 1.0):
        asked = tokens_at(index.selectExpr("*", f"CAST(n_chars * {share} AS INT) AS at"), "at")
        for r in asked.collect():
            assert r.tokens == want[r.doc_id][r.at]
    out = tokens_at(index.selectExpr("*", "n_chars + 1 AS at"), "at").select("tokens").distinct()
    assert [r.tokens for r in out.collect()] == [None]
    for r in longest_prefixes(index, [0, 7, 100, 10**9, -1]).collect():
        fitting = [i for i, n in enumerate(want[r.doc_id]) if n <= r.budget]
        assert r.kept_chars == (fitting[-1] if fitting else -1)
        assert r.kept_tokens == (want[r.doc_id][fitting[-1]] if fitting else None)


def test_odd_rows(spark):
    ids, texts = odd_rows()
    rows = token_counts(table(spark, texts, ids, extra=True), max_tokens=20).collect()
    want = [(i, len((t or "").encode()), len(LIBRARY.encode(t or ""))) for i, t in zip(ids, texts)]
    assert sorted(map(str, ((r.doc_id, r.n_bytes, r.n_tokens) for r in rows))) == sorted(map(str, want))
    assert all(r.over_limit == (r.n_tokens > 20) for r in rows)
    assert token_counts(table(spark, [])).count() == 0


def test_query_equals_the_library_on_whole_documents(spark, sf):
    rows = QUERIES["op13_token_counts"](spark, sf).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_bytes, r.n_tokens) == (len(docs[r.doc_id].encode()), len(LIBRARY.encode(docs[r.doc_id])))
        assert r.over_limit == (r.n_tokens > 4096)
