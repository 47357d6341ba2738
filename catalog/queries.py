"""Every operator as a query over the benchmark tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import adapter as ad
from threadlens import params as PR
from threadlens.functions import prompts
from threadlens.functions import text as tx
from threadlens.operators import annotations as an
from threadlens.operators import classify as cl
from threadlens.operators import conversations as cv
from threadlens.operators import decisions as de
from threadlens.operators import evaluation as ev
from threadlens.operators import features as ft
from threadlens.operators import graph as gr
from threadlens.operators import judging as ju
from threadlens.operators import keywords as kw
from threadlens.operators import language as lg
from threadlens.operators import minibatch as mb
from threadlens.operators import profile as pr
from threadlens.operators import quality as qu
from threadlens.operators import retrieval as rt
from threadlens.operators import signals as sg
from threadlens.operators import themes as th
from threadlens.operators.ordering import find_hot_groups
from threadlens.plans.preprocess import clean_and_filter, preprocess
from threadlens.plans import explore as explore_plan
from threadlens.plans import results, scoring
from threadlens.sources import bucketed, readers, writers
from threadlens.sources.tables import checkpoint_folder, materialize, materialize_by

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
P = ad.PARAMS


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def cleaned(spark, sf):
    return qu.clean_messages(ad.messages(spark, sf), P)


def hot(spark, sf):
    """Oversized conversations, from the id column of the source alone."""
    ids = ad.conversation_ids(spark, sf)
    return find_hot_groups(ids, "conversation_id", P.hot_group_rows)


def processed(spark, sf, big=None):
    return clean_and_filter(ad.messages(spark, sf), P, big or hot(spark, sf))


def written_messages(spark, sf, big):
    """The processed messages by conversation, written, with the columns that those are made of."""
    columns = ["conversation_id", "tweet_id", "created_at", "role", "author_id", "text"]
    return materialize_by(processed(spark, sf, big).select(*columns), "conversation_id", "messages")


def ordered(spark, sf, operator, *args):
    """Apply an operator that orders conversations to the processed messages."""
    big = hot(spark, sf)
    return operator(processed(spark, sf, big), P, big, *args)


def epoch(col: str):
    return F.unix_seconds(col).alias(col)


# -- sources -----------------------------------------------------------------


@query
def scan_messages(spark, sf):
    """Round trip through the raw CSV layout, with weekday-style dates."""
    utc = F.to_utc_timestamp("created_at", F.current_timezone())
    date = F.concat(
        F.lit("Mon "), F.date_format(utc, "MMM dd HH:mm:ss"), F.lit(" +0000 "), F.date_format(utc, "yyyy")
    )
    raw = ad.tweets(spark, sf).withColumn("created_at", date)
    path = f"{checkpoint_folder(spark).rstrip('/')}/threadlens/raw-{uuid.uuid4().hex}.csv"
    writers.write_table(raw, path, "csv")
    return readers.scan_messages(spark, path).select(
        "tweet_id", "author_id", "inbound", epoch("created_at"),
        F.coalesce("text", F.lit("")).alias("text"), "response_tweet_id", "in_response_to_tweet_id",
    )


def new_folder(spark, name: str) -> str:
    return f"{checkpoint_folder(spark).rstrip('/')}/threadlens/{name}-{uuid.uuid4().hex}"


@query
def annotation_log(spark, sf):
    """Annotations appended in three batches, one of them twice, read back in order."""
    path, rows = new_folder(spark, "progress"), ad.annotations(spark, sf)
    for batch in (0, 1, 2, 1):
        writers.append_annotations(rows.filter(F.col("row_id") % 3 == batch), path, f"batch-{batch}")
    back = readers.scan_annotations(spark, path)
    texts = {c: F.coalesce(F.col(c), F.lit("")) for c in back.columns if c != "row_id"}
    counted = back.withColumns(texts).agg(F.min("row_id").alias("first_row"), (F.max("row_id") + 1).alias("after_last"))
    return back.select(*[e.alias(c) for c, e in texts.items()]).crossJoin(F.broadcast(counted))


@query
def audit_log(spark, sf):
    """Audit rows of two runs, the first of which is written again after a failure."""
    path, rows = new_folder(spark, "audit"), de.audit_rows(de.decide(decision_inputs(spark, sf), P))
    half = lambda h: rows.filter(F.length("message_id") % 2 == h)
    for run, part in (("run-0", half(0).limit(3)), ("run-1", half(1)), ("run-0", half(0))):
        writers.append_audit(part, path, run)
    back = readers.scan_log(spark, path, [*rows.columns, "logged_at"])
    return back.withColumn("logged", F.col("logged_at").isNotNull()).drop("logged_at")


@query
def golden_file(spark, sf):
    """The golden labels as the file has them."""
    folder = new_folder(spark, "golden")
    results.export_golden(ad.annotations(spark, sf), folder)
    back = readers.scan_annotations(spark, f"{folder}/golden")
    return back.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in back.columns if c != "row_id"], "row_id")


@query
def overview_file(spark, sf):
    """Two tables of the overview as the files have them."""
    folder, messages = new_folder(spark, "overview"), materialize(processed(spark, sf), "messages")
    results.export_overview(messages, P, folder)
    tables = [cv.overview_counts(messages), cv.turn_structure(messages)]
    names = ["overview_counts", "turn_structure"]
    first, second = (readers.scan_json(spark, f"{folder}/{n}", t.schema) for n, t in zip(names, tables))
    return first.crossJoin(second.select(*[c for c in second.columns if c not in first.columns]))


@query
def comparison_file(spark, sf):
    """The comparison of the systems as the evaluation's file has it."""
    folder = new_folder(spark, "evaluation")
    found = ad.predictions(spark, sf).withColumn("agent_reply", F.col("customer_text"))
    results.export_evaluation(found, None, P, folder)
    return readers.scan_json(spark, f"{folder}/evaluation/comparison", ev.system_comparison(found).schema)


INBOUND = f"CASE {ad.N} % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'maybe' END"


@query
def normalize_inbound(spark, sf):
    rows = ad.read(spark, sf, "conversations").select(F.expr(ad.N).alias("n"), F.expr(INBOUND).alias("raw"))
    return rows.select("n", readers.normalize_inbound(F.col("raw")).alias("inbound"))


@query
def scan_message_json(spark, sf):
    """All three request layouts, one document per message."""
    m = ad.messages(spark, sf)
    obj = F.struct("text")
    doc = (
        F.when(F.expr("n % 3 = 0"), F.to_json(F.array("text")))
        .when(F.expr("n % 3 = 1"), F.to_json(F.array(obj)))
        .otherwise(F.to_json(F.struct(F.array("text").alias("messages"))))
    )
    return readers.parse_message_json(m.select("tweet_id", doc.alias("value"))).select(
        "tweet_id", F.col("position").cast("bigint").alias("position"), "text"
    )


@query
def annotated_ids(spark, sf):
    return an.annotated_ids(ad.annotations(spark, sf))


@query
def training_table(spark, sf):
    golden = an.golden_records(ad.annotations(spark, sf))
    return readers.training_table(
        spark, golden, ordered(spark, sf, cv.conversation_table), P.min_training_records
    )


@query
def evaluation_table(spark, sf):
    """Golden labels with the texts of their conversations."""
    golden = an.golden_records(ad.annotations(spark, sf))
    return readers.evaluation_table(spark, golden, ordered(spark, sf, cv.conversation_table))


@query
def evidence_table(spark, sf):
    """Openings and first brand replies, from transcripts and from messages."""
    big = hot(spark, sf)
    final = materialize(processed(spark, sf, big), "messages")
    index = readers.evidence_table(spark, cv.conversation_table(final, P, big), final, P)
    return index.unionByName(readers.evidence_table(spark, None, final, P))


@query
def profile_raw(spark, sf):
    return pr.profile_raw(ad.tweets(spark, sf))


@query
def null_report(spark, sf):
    return pr.null_report(ad.tweets(spark, sf))


# -- reply graph -------------------------------------------------------------


@query
def brand_messages(spark, sf):
    return gr.brand_messages(ad.tweets(spark, sf), P).select("tweet_id", "author_id")


@query
def top_brands(spark, sf):
    return gr.top_brands(ad.tweets(spark, sf))


@query
def with_role(spark, sf):
    return gr.with_role(ad.tweets(spark, sf), P).select("tweet_id", "role")


@query
def reply_edges(spark, sf):
    return gr.reply_edges(ad.tweets(spark, sf))


@query
def brand_seed(spark, sf):
    return gr.brand_seed(ad.event_tweets(spark, sf), P)


@query
def brand_conversations(spark, sf):
    return gr.filter_brand(ad.tweets(spark, sf), P).select("tweet_id", "author_id")


@query
def brand_conversations_events(spark, sf):
    return gr.filter_brand(ad.event_tweets(spark, sf), P).select("tweet_id", "author_id")


@query
def brand_filter_report(spark, sf):
    return gr.brand_filter_report(ad.event_tweets(spark, sf), P)


@query
def thread_roots(spark, sf):
    return gr.thread_roots(gr.filter_brand(ad.event_tweets(spark, sf), P))


THREAD_COLUMNS = ["conversation_id", "tweet_id", "role", "depth"]


@query
def build_threads(spark, sf):
    t = gr.build_threads(ad.tweets(spark, sf), P)
    return t.select(*THREAD_COLUMNS).withColumn("depth", F.col("depth").cast("bigint"))


@query
def build_threads_events(spark, sf):
    t = gr.build_threads(ad.event_tweets(spark, sf), P)
    return t.select(*THREAD_COLUMNS).withColumn("depth", F.col("depth").cast("bigint"))


@query
def thread_depth_report(spark, sf):
    """Messages that threads of limited depth leave out."""
    return gr.thread_depth_report(ad.event_tweets(spark, sf), P)


@query
def message_sequence(spark, sf):
    return gr.message_sequence(ad.messages(spark, sf), P, hot(spark, sf)).select("conversation_id", "tweet_id", "seq")


@query
def thread_stats(spark, sf):
    return gr.thread_stats(gr.build_threads(ad.event_tweets(spark, sf), P))


@query
def thread_length_histogram(spark, sf):
    return gr.thread_length_histogram(ad.messages(spark, sf))


# -- cleaning and quality ----------------------------------------------------


@query
def clean_text(spark, sf):
    return cleaned(spark, sf).select("tweet_id", "text", "text_original")


@query
def clean_documents(spark, sf):
    docs = ad.read(spark, sf, "documents")
    return docs.select("doc_id", tx.clean_text(F.col("text"), P).alias("text"))


@query
def cleaning_report(spark, sf):
    return qu.cleaning_report(cleaned(spark, sf))


@query
def cleaning_samples(spark, sf):
    return qu.cleaning_samples(cleaned(spark, sf))


@query
def quality_filtered(spark, sf):
    return processed(spark, sf).select("conversation_id", "tweet_id", "author_id", "role", "text")


@query
def quality_removals(spark, sf):
    return qu.quality_removals(cleaned(spark, sf), P)


@query
def preprocessing_summary(spark, sf):
    c = cleaned(spark, sf)
    return cv.preprocessing_summary(
        qu.quality_filter(c, P, hot(spark, sf)), ad.messages(spark, sf), qu.quality_removals(c, P)
    )


# -- whole runs from raw messages ---------------------------------------------


RUN_COLUMNS = ["conversation_id", "tweet_id", "role", "text"]


@query
def preprocess_messages(spark, sf):
    return preprocess(ad.tweets(spark, sf), P).messages.select(*RUN_COLUMNS)


@query
def preprocess_messages_events(spark, sf):
    return preprocess(ad.event_tweets(spark, sf), P).messages.select(*RUN_COLUMNS)


@query
def preprocess_conversations(spark, sf):
    return preprocess(ad.tweets(spark, sf), P).conversations


@query
def preprocess_summary(spark, sf):
    return preprocess(ad.tweets(spark, sf), P).summary


# -- conversations -----------------------------------------------------------


@query
def overview_counts(spark, sf):
    return cv.overview_counts(processed(spark, sf))


@query
def thread_length_stats(spark, sf):
    return cv.thread_length_stats(processed(spark, sf))


@query
def notable_conversations(spark, sf):
    return cv.notable_conversations(processed(spark, sf))


@query
def role_balance(spark, sf):
    return cv.role_balance(processed(spark, sf))


@query
def text_length_stats(spark, sf):
    return cv.text_length_stats(processed(spark, sf))


@query
def temporal_span(spark, sf):
    return cv.temporal_span(processed(spark, sf))


@query
def length_distribution(spark, sf):
    return cv.length_distribution(processed(spark, sf))


@query
def length_percentiles(spark, sf):
    return cv.length_percentiles(processed(spark, sf))


@query
def participation(spark, sf):
    return cv.participation(processed(spark, sf))


@query
def turn_structure(spark, sf):
    return cv.turn_structure(processed(spark, sf))


@query
def length_buckets(spark, sf):
    return cv.length_buckets(processed(spark, sf))


@query
def brand_responsiveness(spark, sf):
    return cv.brand_responsiveness(processed(spark, sf))


@query
def role_switches(spark, sf):
    return ordered(spark, sf, cv.role_switches)


@query
def bucketed_role_switches(spark, sf):
    """Role switches read from a table bucketed by conversation, without a shuffle."""
    name, big = f"processed_{uuid.uuid4().hex}", hot(spark, sf)
    table = bucketed.write_processed_buckets(processed(spark, sf, big), name, 8, big)
    return cv.role_switches(table, P, big)


@query
def response_depth(spark, sf):
    return cv.response_depth(ordered(spark, sf, cv.role_switches))


@query
def depth_distribution(spark, sf):
    return cv.depth_distribution(ordered(spark, sf, cv.role_switches))


@query
def last_speaker(spark, sf):
    return cv.last_speaker(processed(spark, sf))


@query
def opening_messages(spark, sf):
    return cv.opening_messages(processed(spark, sf))


@query
def evidence_pairs(spark, sf):
    return cv.evidence_pairs(processed(spark, sf))


@query
def conversation_table(spark, sf):
    return ordered(spark, sf, cv.conversation_table)


# -- language ----------------------------------------------------------------


@query
def top_keywords(spark, sf):
    return lg.top_keywords(processed(spark, sf), P.top_keywords)


@query
def top_bigrams(spark, sf):
    return lg.top_phrases(processed(spark, sf), 2, P.top_phrases)


@query
def top_trigrams(spark, sf):
    return lg.top_phrases(processed(spark, sf), 3, P.top_phrases)


@query
def message_types(spark, sf):
    return lg.message_types(processed(spark, sf))


@query
def emotional_punctuation(spark, sf):
    return lg.emotional_punctuation(processed(spark, sf))


@query
def emoji_usage(spark, sf):
    return lg.emoji_usage(processed(spark, sf))


@query
def top_emojis(spark, sf):
    return lg.top_emojis(processed(spark, sf), P.top_emojis)


@query
def keyword_themes(spark, sf):
    return lg.keyword_themes(cv.opening_messages(processed(spark, sf)))


@query
def document_keywords(spark, sf):
    return lg.fallback_top_words(ad.read(spark, sf, "documents").select("text"), P.fallback_top_words)


# -- signals -----------------------------------------------------------------


def signals(spark, sf):
    """Written once: the reports below read it several times."""
    return materialize(ordered(spark, sf, sg.conversation_signals), "signals")


@query
def conversation_signals(spark, sf):
    return ordered(spark, sf, sg.conversation_signals)


@query
def keyword_signals(spark, sf):
    return sg.keyword_signals(signals(spark, sf), P)


def keyword_rows(spark):
    return kw.keyword_table(spark, P.signal_keywords)


@query
def keyword_signals_table(spark, sf):
    """The same report, the keywords being rows of a table."""
    flags = lambda m, p, big: kw.keyword_flags(m, keyword_rows(spark), list(p.signal_keywords), big)
    return sg.keyword_signals(materialize(ordered(spark, sf, flags), "flags"), P)


@query
def conversation_keywords(spark, sf):
    """Every keyword that a conversation's customer used."""
    find = lambda m, p, big: kw.conversation_keywords(m, keyword_rows(spark), big)
    return ordered(spark, sf, find)


@query
def document_part_names(spark, sf):
    """Documents that contain a word of a part's name: the keywords are the part table."""
    words = F.explode(F.split("p_name", " ")).alias("keyword")
    names = ad.read(spark, sf, "part").select(F.lit("part").alias("category"), words).distinct()
    hits = kw.keyword_hits(documents(spark, sf), names, "doc_id")
    return hits.groupBy("keyword").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_id"))


@query
def repeated_followups(spark, sf):
    return sg.repeated_followups(signals(spark, sf))


@query
def unresolved(spark, sf):
    return sg.unresolved(signals(spark, sf))


@query
def any_escalation(spark, sf):
    return sg.any_escalation(signals(spark, sf), P)


@query
def escalation_signal_table(spark, sf):
    return sg.escalation_signal_table(signals(spark, sf), P)


@query
def chart_series(spark, sf):
    final = materialize(processed(spark, sf), "messages")
    return explore_plan.chart_series(explore_plan.explore(final, P))


# -- features, retrieval, classification -------------------------------------


def documents(spark, sf):
    return ad.read(spark, sf, "documents").select("doc_id", "text")


@query
def doc_terms(spark, sf):
    return ft.doc_terms(documents(spark, sf))


@query
def tfidf_vocabulary(spark, sf):
    docs = documents(spark, sf)
    n = ft.term_partitions(docs)
    vocab = ft.fit(ft.doc_terms(docs, partitions=n), docs.count(), P.retrieval_features, partitions=n)
    return vocab.table.withColumn("idf", F.round("idf", 6))


@query
def tfidf_weights(spark, sf):
    docs = documents(spark, sf)
    n = ft.term_partitions(docs)
    counts = ft.written_terms(docs, "terms", n)
    vocab = ft.fit(counts, docs.count(), P.classifier_features, min_df=3, max_df=0.8, sublinear=True, partitions=n)
    return ft.weights(counts, vocab).withColumn("weight", F.round("weight", 6))


def benchmark_queries(spark, sf):
    return ad.read(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


@query
def retrieve_topk(spark, sf):
    top = rt.text_topk(
        benchmark_queries(spark, sf), documents(spark, sf), P.top_k, P.retrieval_features
    )
    return top.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def opening_topk(spark, sf):
    """Brand lines as queries against the evidence pairs of all conversations."""
    pairs = materialize(
        cv.evidence_pairs(processed(spark, sf)).withColumnRenamed("conversation_id", "doc_id"), "pairs"
    )
    queries = pairs.select(F.col("doc_id").alias("query_id"), F.col("brand_reply").alias("text"))
    corpus = pairs.select("doc_id", F.col("customer_text").alias("text"))
    top = rt.text_topk(queries, corpus, P.top_k, P.retrieval_features)
    return rt.evidence_list(top, pairs), pairs


@query
def evidence_list(spark, sf):
    found, _ = opening_topk(spark, sf)
    line = lambda e: F.concat_ws(
        "|", e["rank"].cast("string"), e["conversation_id"], F.format_string("%.4f", e["similarity_score"]),
        e["customer_text"], e["brand_reply"],
    )
    return found.select("query_id", F.array_join(F.transform("evidence", line), "\n").alias("evidence"))


@query
def dense_topk(spark, sf):
    vectors = ad.read(spark, sf, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    top = rt.dense_topk(
        vectors.withColumnRenamed("vec_id", "query_id"), vectors.withColumnRenamed("vec_id", "doc_id"), P.top_k, P.block_rows
    )
    return top.select("query_id", "doc_id", F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@query
def baseline_nearest(spark, sf):
    docs = ad.read(spark, sf, "documents")
    corpus = docs.select("doc_id", "text", F.col("lang").alias("label"), F.col("text").alias("reply"))
    out = rt.nearest_baseline(benchmark_queries(spark, sf), corpus, P)
    return out.withColumn("confidence", F.round("confidence", 6))


@query
def baseline_majority(spark, sf):
    docs = ad.read(spark, sf, "documents")
    top = rt.majority_label(docs, "lang")
    return rt.constant_baseline(docs.select(F.col("doc_id").alias("query_id")), P, top)


def language_training(spark, sf):
    return ad.read(spark, sf, "documents").select("doc_id", "text", F.col("lang").alias("label"))


@query
def train_classifier(spark, sf):
    """Training accuracy per language of a classifier fitted on all documents."""
    rows = language_training(spark, sf)
    model = cl.train(rows, P)
    out = cl.classify(rows.select("doc_id", "text"), model).join(rows.select("doc_id", "label"), "doc_id")
    return ev.per_class_metrics(out, "label", "predicted_intent")


@query
def classify_messages(spark, sf):
    """Benchmark items scored by the language classifier."""
    model = cl.train(language_training(spark, sf), P)
    items = benchmark_queries(spark, sf).withColumnRenamed("query_id", "doc_id")
    return cl.classify(items, model).select(
        "doc_id", "predicted_intent", F.round("confidence", 4).alias("confidence"), F.size("candidates").alias("n_candidates"),
    )


@query
def train_certificate(spark, sf):
    """Whether the classifier fitted on all documents is near the optimum, and its size."""
    rows = language_training(spark, sf)
    checked = cl.certificate(rows, cl.train(rows, P), P, GRADIENT_BOUND)
    return checked.select("n_docs", "n_terms", "n_classes", "optimal")


#: The mean loss of a model whose gradient is shorter changes by less than rounding.
GRADIENT_BOUND = 1e-3
#: Twice the weight of a term for the class number i; any rule that SQL has as well.
RULE_WEIGHT = "(ascii(term) * 31 + length(term) * 7 + i * 13) % 41 - 20"
RULE_INTERCEPT = 0.01


def rule_model(docs, labels) -> cl.IntentModel:
    """A classifier whose weights follow from terms and classes; its vocabulary is fitted."""
    n = ft.term_partitions(docs)
    counts = ft.doc_terms(docs, ngram_max=P.ngram_max, partitions=n)
    vocab = ft.fit(counts, docs.count(), P.classifier_features, sublinear=True, partitions=n)
    names = sorted(labels)
    listed = F.posexplode(F.array(*[F.lit(x) for x in names])).alias("i", "label")
    weights = vocab.table.select("term", listed).withColumn("weight", F.expr(RULE_WEIGHT) / F.lit(2.0))
    return cl.linear_model(vocab, weights, {c: RULE_INTERCEPT * i for i, c in enumerate(names)}, P.ngram_max)


@query
def classify_fixed(spark, sf):
    """Benchmark items scored by a language classifier of given weights."""
    model = rule_model(documents(spark, sf), ["de", "en", "es", "fr"])
    items = benchmark_queries(spark, sf).withColumnRenamed("query_id", "doc_id")
    best = F.transform("candidates", lambda c: F.concat_ws(":", c["intent"], F.format_string("%.4f", c["prob"])))
    return cl.classify(items, model).select(
        "doc_id", "predicted_intent", F.round("confidence", 6).alias("confidence"), F.array_join(best, " ").alias("candidates")
    )


@query
def theme_clusters(spark, sf):
    return _themes(spark, sf).clusters


@query
def theme_terms(spark, sf):
    return _themes(spark, sf).terms


@query
def theme_examples(spark, sf):
    return _themes(spark, sf).examples


def openings(spark, sf):
    return cv.opening_messages(processed(spark, sf)).select(F.col("conversation_id").alias("doc_id"), "text")


def _themes(spark, sf):
    return th.discover_themes(openings(spark, sf), P)


#: Clusters of the queries with given centres: the last digit of a conversation's number.
GIVEN_CLUSTER = "CAST(substr(doc_id, 6) AS INT) % 4"


def given_themes(spark, sf):
    """Themes around the mean rows of given groups of conversations."""
    docs = materialize(openings(spark, sf), "openings")
    rows, vocab = th.theme_features(docs, P)
    labels = docs.select("doc_id", F.expr(GIVEN_CLUSTER).alias("cluster"))
    return th.describe_themes(docs, rows, vocab, mb.label_means(rows, labels, 4), P)


@query
def theme_clusters_given(spark, sf):
    return given_themes(spark, sf).clusters


@query
def theme_terms_given(spark, sf):
    return given_themes(spark, sf).terms


@query
def theme_examples_given(spark, sf):
    return given_themes(spark, sf).examples


# -- decisions, replies, judging ---------------------------------------------

INTENT_OF_N = ad.ANNOTATION_INTENT
CONFIDENCE_OF_N = f"CAST(({ad.N} * 37) % 100 AS DOUBLE) / 100"


def decision_inputs(spark, sf):
    return (
        ad.messages(spark, sf)
        .withColumn("predicted_intent", F.expr(INTENT_OF_N))
        .withColumn("confidence", F.expr(CONFIDENCE_OF_N))
        .withColumnRenamed("tweet_id", "doc_id")
    )


@query
def escalation_decisions(spark, sf):
    return de.decide(decision_inputs(spark, sf), P).select(
        "doc_id", "escalation_decision", "escalation_confidence", "escalation_reason"
    )


@query
def audit_rows(spark, sf):
    return de.audit_rows(de.decide(decision_inputs(spark, sf), P))


def pairs_with_evidence(spark, sf):
    """Evidence pairs with an evidence array of zero to two items each."""
    number = F.expr("CAST(substr(conversation_id, 6) AS BIGINT)")
    pairs = cv.evidence_pairs(processed(spark, sf)).withColumn("k", number)
    item = lambda score: F.struct(
        F.lit(1).alias("rank"), "conversation_id", "customer_text", "brand_reply",
        score.alias("similarity_score"), score.alias("score"),
    )
    first, second = F.expr("CAST((k * 7) % 100 AS DOUBLE) / 100"), F.expr("CAST((k * 3) % 50 AS DOUBLE) / 100")
    items = F.array(item(first), item(second))
    return pairs.withColumn("evidence", F.when(F.expr("k % 5 = 0"), F.slice(items, 1, 0)).otherwise(items)).withColumn(
        "predicted_intent", F.expr("CASE k % 4 WHEN 0 THEN 'order_status' WHEN 1 THEN 'billing_issue' WHEN 2 THEN 'product_issue' ELSE 'unknown' END")
    )


@query
def select_reply(spark, sf):
    return pairs_with_evidence(spark, sf).select(
        "conversation_id", de.select_reply(F.col("predicted_intent"), F.col("evidence"), P).alias("reply")
    )


@query
def build_prompt(spark, sf):
    prompt = prompts.reply_prompt(
        F.col("customer_text"), F.col("predicted_intent"), F.col("evidence"), P.brand, P.brand_handle
    )
    return pairs_with_evidence(spark, sf).select("conversation_id", prompt.alias("prompt"))


@query
def build_judge_prompt(spark, sf):
    prompt = prompts.judge_prompt(
        F.col("customer_text"), F.col("predicted_intent"), F.col("evidence"),
        F.when(F.expr("k % 3 = 0"), F.lit("")).otherwise(F.col("brand_reply")), F.col("brand_reply"), P.brand_handle,
    )
    return pairs_with_evidence(spark, sf).select("conversation_id", prompt.alias("prompt"))


@query
def extract_brand_reply(spark, sf):
    table = ordered(spark, sf, cv.conversation_table)
    number = F.expr("CAST(substr(conversation_id, 6) AS BIGINT) % 10")
    transcript = F.when(number == 0, F.lit(None)).when(number == 1, F.lit("")).otherwise(F.col("full_conversation"))
    return cv.first_brand_replies(table.withColumn("full_conversation", transcript), P)


def fitted_scorer(spark, sf):
    big = hot(spark, sf)
    final = written_messages(spark, sf, big)
    golden = an.golden_with_text(
        an.golden_records(ad.annotations(spark, sf)), cv.conversation_table(final, P, big)
    )
    training = golden.select(F.col("conversation_id").alias("doc_id"), "text", F.col("primary_intent").alias("label"))
    evidence = cv.evidence_pairs(final).withColumnRenamed("conversation_id", "doc_id")
    return scoring.fit_scorer(training, evidence, P)


def scored_messages(spark, sf):
    incoming = ad.messages(spark, sf).filter("role = 'customer'").select(F.col("tweet_id").alias("doc_id"), "text")
    return scoring.score_messages(incoming, fitted_scorer(spark, sf))


@query
def score_messages(spark, sf):
    return scored_messages(spark, sf).select(
        "doc_id", "predicted_intent", F.round("confidence", 4).alias("confidence"),
        F.size("evidence").alias("n_evidence"), "escalation_decision", "escalation_reason", "generated_reply",
    )


@query
def inference_json(spark, sf):
    return de.scoring_record(scored_messages(spark, sf))


def evidence_of(messages):
    return scoring.written_evidence(cv.evidence_pairs(messages).withColumnRenamed("conversation_id", "doc_id"))


def fixed_scorer(evidence):
    """Scoring by given intent weights; evidence and vocabulary are the written evidence pairs."""
    model = rule_model(evidence.select("doc_id", F.col("customer_text").alias("text")), PR.INTENTS)
    return scoring.scorer_of(model, evidence, P, written=True)


def fixed_scores(spark, sf):
    incoming = ad.messages(spark, sf).filter("role = 'customer'").select(F.col("tweet_id").alias("doc_id"), "text")
    return scoring.score_messages(incoming, fixed_scorer(evidence_of(processed(spark, sf))))


@query
def score_fixed(spark, sf):
    """All customer messages scored by given weights: intent, evidence, decision and reply."""
    return fixed_scores(spark, sf).select(
        "doc_id", "predicted_intent", F.round("confidence", 4).alias("confidence"),
        F.when(F.col("evidence").isNull(), 0).otherwise(F.size("evidence")).alias("n_evidence"),
        "escalation_decision", "escalation_reason", "generated_reply",
    )


@query
def inference_json_fixed(spark, sf):
    """The nested result records of the same scoring, read back from their JSON text."""
    records = de.scoring_record(fixed_scores(spark, sf))
    fields = (
        "customer_message string, predicted_intent string, confidence double, "
        "top_3_candidates array<struct<intent:string,prob:double>>, "
        "retrieved_examples array<struct<conversation_id:string,customer_text:string,brand_reply:string,similarity_score:double>>, "
        "generated_reply string, escalation_decision string, escalation_reason string"
    )
    candidates = lambda c: F.concat_ws(":", c["intent"], F.format_string("%.4f", c["prob"]))
    examples = lambda e: F.concat_ws(
        "|", e["conversation_id"], e["customer_text"], e["brand_reply"], F.format_string("%.4f", e["similarity_score"])
    )
    read = records.withColumn("r", F.from_json("record", fields))
    return read.select(
        "doc_id", F.array_join(F.json_object_keys("record"), ",").alias("names"),
        "r.customer_message", "r.predicted_intent", "r.confidence",
        F.array_join(F.transform("r.top_3_candidates", candidates), " ").alias("candidates"),
        F.array_join(F.transform("r.retrieved_examples", examples), "\n").alias("examples"),
        "r.generated_reply", "r.escalation_decision", "r.escalation_reason",
    )


@query
def judge_heuristic(spark, sf):
    judged = ju.judge_replies(ad.messages(spark, sf), P, "text")
    return judged.select("tweet_id", *ad.DIMENSIONS, "overall_score")


@query
def judge_summary(spark, sf):
    return ju.judge_summary(ju.judge_replies(processed(spark, sf), P, "text"))


@query
def dimension_ranking(spark, sf):
    return ju.dimension_ranking(ju.judge_replies(processed(spark, sf), P, "text"))


RAW_SCORES = {
    d: f"CASE (doc_id + {i}) % 9 WHEN 0 THEN '0' WHEN 1 THEN '6' WHEN 2 THEN 'four' WHEN 3 THEN NULL ELSE CAST((doc_id + {i}) % 5 + 1 AS STRING) END"
    for i, d in enumerate(ad.DIMENSIONS)
}


@query
def validate_scores(spark, sf):
    rows = ad.read(spark, sf, "documents").select("doc_id", *[F.expr(e).alias(d) for d, e in RAW_SCORES.items()])
    return ju.validate_scores(rows).select("doc_id", F.array_join("errors", "; ").alias("errors"))


JUDGE_JSON = """
CASE doc_id % 6
  WHEN 0 THEN concat('{"groundedness": ', CAST(doc_id % 5 + 1 AS STRING), ', "correctness": 3, "empathy": 5, "actionability": 2, "brand_tone": 4, "overall_score": 3.5, "reasoning": "ok"}')
  WHEN 1 THEN concat('```json\n{"groundedness": ', CAST(doc_id % 5 + 1 AS STRING), ', "empathy": 1}\n```')
  WHEN 2 THEN '{}'
  WHEN 3 THEN 'not json'
  WHEN 4 THEN '{"brand_tone": 2, "reasoning": "short", "strengths": ["a"]}'
  ELSE concat('  {"correctness": ', CAST(doc_id % 4 + 1 AS STRING), ', "overall_score": 2.25}  ')
END"""


@query
def parse_judge_json(spark, sf):
    rows = ad.read(spark, sf, "documents").select("doc_id", F.expr(JUDGE_JSON).alias("raw"))
    return ju.parse_judge_json(rows).select("doc_id", "parsed", *ad.DIMENSIONS, "overall_score", "reasoning")


# -- labels and annotations --------------------------------------------------


@query
def normalize_intent(spark, sf):
    a = ad.annotations(spark, sf)
    return a.select("row_id", tx.normalize_intent(F.col("primary_intent")).alias("intent"))


@query
def normalize_confidence(spark, sf):
    a = ad.annotations(spark, sf)
    return a.select("row_id", tx.normalize_confidence(F.col("confidence")).alias("confidence"))


@query
def normalize_reason(spark, sf):
    a = ad.annotations(spark, sf)
    return a.select("row_id", tx.normalize_reason(F.col("escalation_reason")).alias("reason"))


@query
def truncate_text(spark, sf):
    docs = ad.read(spark, sf, "documents")
    return docs.select(
        "doc_id",
        tx.truncate_text(F.col("text"), 120).alias("short"),
        tx.grouped_number(F.col("n_chars")).alias("n_chars_text"),
    )


@query
def annotation_errors(spark, sf):
    return an.annotation_errors(ad.annotations(spark, sf))


@query
def duplicate_annotations(spark, sf):
    return an.duplicate_annotations(ad.annotations(spark, sf))


@query
def annotation_validation(spark, sf):
    return an.annotation_validation(ad.annotations(spark, sf), P)


@query
def intent_distribution(spark, sf):
    return an.label_distribution(ad.annotations(spark, sf))


@query
def golden_export(spark, sf):
    return an.golden_export(ad.annotations(spark, sf))


@query
def annotation_queue(spark, sf):
    conversations = ad.messages(spark, sf).groupBy("conversation_id").agg(F.count("*").alias("messages"))
    return an.annotation_queue(conversations, ad.annotations(spark, sf))


@query
def golden_with_text(spark, sf):
    table = ordered(spark, sf, cv.conversation_table)
    golden = an.golden_records(ad.annotations(spark, sf))
    return an.golden_with_text(golden, table).select("conversation_id", "primary_intent", "text")


# -- evaluation --------------------------------------------------------------


@query
def intent_metrics(spark, sf):
    return ev.intent_metrics(ad.predictions(spark, sf), "true_intent", "agent_intent")


@query
def per_class_metrics(spark, sf):
    out = ev.per_class_metrics(ad.predictions(spark, sf), "true_intent", "agent_intent")
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


@query
def confusion_matrix(spark, sf):
    return ev.confusion_matrix(ad.predictions(spark, sf), "true_intent", "agent_intent")


@query
def escalation_metrics(spark, sf):
    return ev.escalation_metrics(ad.predictions(spark, sf), "true_escalation", "agent_escalation")


@query
def system_comparison(spark, sf):
    return ev.system_comparison(ad.predictions(spark, sf))


def golden_inputs(spark, sf):
    """Golden conversations with their replies, the neighbour corpus, the written evidence pairs."""
    big = hot(spark, sf)
    final = written_messages(spark, sf, big)
    table = cv.conversation_table(final, P, big)
    golden = an.golden_with_text(an.golden_records(ad.annotations(spark, sf)), table)
    golden = materialize(
        golden.select("conversation_id", F.col("text").alias("customer_text"), "primary_intent", "escalation"), "golden"
    )
    pairs = evidence_of(final)
    replies = pairs.select(F.col("doc_id").alias("conversation_id"), "brand_reply")
    labelled = golden.join(replies, "conversation_id", "left").na.fill("", ["brand_reply"])
    corpus = labelled.select(
        F.col("conversation_id").alias("doc_id"), F.col("customer_text").alias("text"),
        F.col("primary_intent").alias("label"), F.col("brand_reply").alias("reply"),
    )
    return labelled, corpus, pairs


@query
def predictions(spark, sf):
    """Three systems on the golden conversations, neighbour corpus: the evidence pairs."""
    from threadlens.plans.evaluate import predict_all

    labelled, corpus, evidence = golden_inputs(spark, sf)
    scorer = scoring.scorer_of(cl.train(corpus.select("doc_id", "text", "label"), P), evidence, P, written=True)
    return predict_all(labelled, corpus, scorer, P)


@query
def predictions_fixed(spark, sf):
    """Three systems on the golden conversations; the full system has given weights."""
    from threadlens.plans.evaluate import predict_all

    labelled, corpus, evidence = golden_inputs(spark, sf)
    found = predict_all(labelled, corpus, fixed_scorer(evidence), P)
    return found.withColumns({c: F.round(c, 6) for c in ("b2_confidence", "agent_confidence")})


def rated(spark, sf):
    return ev.paired_scores(ad.human_scores(spark, sf), ad.judge_scores(spark, sf))


@query
def agreement_by_dimension(spark, sf):
    return ev.agreement_by_dimension(rated(spark, sf))


@query
def cohen_kappa(spark, sf):
    return ev.cohen_kappa(rated(spark, sf))


@query
def agreement_overall(spark, sf):
    return ev.agreement_overall(rated(spark, sf))


@query
def agreement_matrix(spark, sf):
    return ev.agreement_matrix(rated(spark, sf))


@query
def score_histogram(spark, sf):
    return ev.score_histogram(rated(spark, sf))


@query
def failure_cases(spark, sf):
    return ev.failure_cases(ad.predictions(spark, sf))
