"""Reference SQL (DuckDB) of the registered queries.

Written against the benchmark tables only, with its own text rules: DuckDB's
regular expressions know no look-around, so words are found by splitting.
"""

from __future__ import annotations

from catalog import adapter as ad
from catalog.queries import CONFIDENCE_OF_N, INBOUND, INTENT_OF_N, JUDGE_JSON, RAW_SCORES
from threadlens import params as PR
from threadlens.functions import prompts
from threadlens.functions.text import SPACE_CHARS
from threadlens.operators.judging import DEFAULT_REASONING

BRAND = ad.BRAND
P = ad.PARAMS


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def contains_any(text: str, needles) -> str:
    return "(" + " OR ".join(f"contains({text}, {q(n)})" for n in needles) + ")"


WORD = r"[\p{L}\p{N}_]"
WS = r"[\t-\r\x1c-\x20\x85\p{Z}]"
NWS = r"[^\t-\r\x1c-\x20\x85\p{Z}]"


def strip(x: str) -> str:
    return f"trim({x}, {q(SPACE_CHARS)})"


def blank(x: str) -> str:
    return f"({strip(f'coalesce({x}, {q('')})')} = '')"


def clean(x: str) -> str:
    out = f"coalesce({x}, '')"
    for pattern, replacement in [
        (rf"(?i)https?://{NWS}+|www\.{NWS}+", ""),
        (rf"(?i)^RT{WS}+@{WORD}+:?{WS}*", ""),
        (rf"^(?:@{WORD}+{WS}*)+", ""),
        (r"[\n\r]+", " "),
        (rf"{WS}{{2,}}", " "),
    ]:
        out = f"regexp_replace({out}, {q(pattern)}, {q(replacement)}, 'g')"
    return f"CASE WHEN {blank(x)} THEN '' ELSE {strip(out)} END"


def words(x: str, stop=PR.STOP_WORDS) -> str:
    runs = f"regexp_extract_all(lower({x}), {q(WORD + '+')})"
    return f"list_filter({runs}, lambda w: regexp_full_match(w, '[a-z]{{2,}}') AND w NOT IN {in_list(stop)})"


def ngrams(w: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{w}[i + {k}]" for k in range(n))
    return f"list_transform(range(1, len({w}) - {n} + 2), lambda i: {parts})"


def pct(a: str, b: str, digits: int = 1) -> str:
    return f"coalesce(round({a} * 100.0::DOUBLE / nullif({b}, 0), {digits}), 0.0::DOUBLE)"


CLEANED = f"""{ad.MESSAGES_SQL},
cleaned AS MATERIALIZED (
  SELECT * EXCLUDE (text), text AS text_original, {clean('text')} AS text FROM messages
)"""

PROCESSED = f"""{CLEANED},
flagged AS MATERIALIZED (
  SELECT *, CASE WHEN {blank('text')} THEN 'empty_text'
                 WHEN {contains_any('lower(text)', PR.SYSTEM_PHRASES)} THEN 'system_messages'
                 WHEN length(text) < 3 THEN 'too_short' END AS reason
  FROM cleaned
),
uniq AS MATERIALIZED (
  SELECT * FROM flagged WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY author_id, text
                             ORDER BY conversation_id, created_at, tweet_id) = 1
),
processed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, tweet_id) AS seq
  FROM (SELECT * FROM uniq QUALIFY count(*) OVER (PARTITION BY conversation_id) >= 2)
),
sizes AS MATERIALIZED (
  SELECT conversation_id, count(*) AS n, count(*) FILTER (role = 'customer') AS c,
         count(*) FILTER (role = 'brand') AS b
  FROM processed GROUP BY 1
)"""

CUSTOMER = f"{PROCESSED}, cust AS (SELECT text FROM processed WHERE role = 'customer')"

SWITCHES_CTE = """
switches AS (
  SELECT conversation_id, count(*) AS total_messages,
         count(*) FILTER (role <> prev) AS role_switches,
         (count(*) FILTER (role <> prev) + 1) // 2 AS depth
  FROM (SELECT *, lag(role) OVER (PARTITION BY conversation_id ORDER BY seq) AS prev FROM processed)
  GROUP BY 1
)"""
SWITCHES = f"{PROCESSED},{SWITCHES_CTE}"

OPENINGS = f"""{PROCESSED},
openings AS (
  SELECT conversation_id, text FROM processed WHERE role = 'customer'
  QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY seq) = 1
)"""

PAIRS = f"""{PROCESSED},
pairs AS MATERIALIZED (
  SELECT conversation_id, c.text AS customer_text, b.text AS brand_reply
  FROM (SELECT conversation_id, text FROM processed WHERE role = 'customer'
        QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY seq) = 1) c
  JOIN (SELECT conversation_id, text FROM processed WHERE role = 'brand'
        QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY seq) = 1) b
  USING (conversation_id)
)"""

CONVERSATIONS = f"""{PROCESSED},
conv AS MATERIALIZED (
  SELECT conversation_id,
         coalesce(first(text ORDER BY seq) FILTER (role = 'customer'), '') AS opening_message,
         string_agg(CASE WHEN role = 'customer' THEN '[CUSTOMER] ' ELSE '[BRAND] ' END || text, chr(10) ORDER BY seq)
           AS full_conversation,
         count(*) AS num_messages,
         count(*) FILTER (role = 'customer') AS num_customer_messages,
         count(*) FILTER (role = 'brand') AS num_brand_replies,
         coalesce(first(author_id ORDER BY seq) FILTER (role = 'customer'), '') AS customer_id
  FROM processed GROUP BY 1
)"""

_hit = ", ".join(
    f"{contains_any('joined', ws)} AS {c}" for c, ws in PR.SIGNAL_KEYWORDS.items()
)
SIGNALS = f"""{PROCESSED},
joined_texts AS (
  SELECT conversation_id, string_agg(lower(text), ' ' ORDER BY seq) AS joined
  FROM processed WHERE role = 'customer' GROUP BY 1
),
kw AS (SELECT conversation_id, {_hit} FROM joined_texts),
sig AS MATERIALIZED (
  SELECT s.conversation_id, s.c >= 3 AS repeated_followups, l.role = 'customer' AS unresolved,
         {', '.join(f'coalesce(kw.{c}, false) AS {c}' for c in PR.SIGNAL_KEYWORDS)}
  FROM sizes s
  JOIN (SELECT conversation_id, role FROM processed
        QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY seq DESC) = 1) l USING (conversation_id)
  LEFT JOIN kw USING (conversation_id)
)"""


def graph(table: str, order: str) -> str:
    """Seed, reachable set within ten rounds, threads of a tweet table."""
    return f"""
parents AS MATERIALIZED (SELECT tweet_id, trim(in_response_to_tweet_id) AS parent_id FROM {table}
            WHERE in_response_to_tweet_id IS NOT NULL),
listed AS MATERIALIZED (SELECT tweet_id, {strip('x')} AS response_id
           FROM (SELECT tweet_id, unnest(string_split(response_tweet_id, ',')) AS x FROM {table})
           WHERE {strip('x')} <> ''),
brand AS MATERIALIZED (SELECT * FROM {table} WHERE lower(author_id) = lower('{BRAND}')),
seed AS MATERIALIZED (
  SELECT tweet_id FROM brand
  UNION SELECT t.tweet_id FROM {table} t WHERE t.tweet_id IN (SELECT parent_id FROM parents SEMI JOIN brand USING (tweet_id))
  UNION SELECT tweet_id FROM parents WHERE parent_id IN (SELECT tweet_id FROM brand)
),
steps AS MATERIALIZED (
  SELECT tweet_id AS src, parent_id AS dst FROM parents
  UNION SELECT parent_id, tweet_id FROM parents
  UNION SELECT tweet_id, response_id FROM listed
),"""


def _levels(table: str) -> str:
    """Breadth-first rounds spelled out one by one, so distances are shortest."""
    out = ["r0 AS MATERIALIZED (SELECT tweet_id, 0 AS hop FROM seed)"]
    for i in range(1, 11):
        out.append(
            f"""r{i} AS MATERIALIZED (SELECT * FROM r{i - 1} UNION ALL
  SELECT DISTINCT dst, {i} FROM steps JOIN r{i - 1} ON src = tweet_id
  WHERE hop = {i - 1} AND dst IN (SELECT tweet_id FROM {table})
    AND dst NOT IN (SELECT tweet_id FROM r{i - 1}))"""
        )
    return ",\n".join(out)


def threads(table: str, order: str) -> str:
    return f"""
numbered AS MATERIALIZED (
  SELECT tweet_id, printf('conv_%06d', row_number() OVER (ORDER BY {order}, tweet_id) - 1) AS conversation_id
  FROM {table} WHERE in_response_to_tweet_id IS NULL
     OR trim(in_response_to_tweet_id) NOT IN (SELECT tweet_id FROM {table})
),
tree AS (
  SELECT tweet_id, conversation_id, 0::BIGINT AS depth FROM numbered
  UNION ALL
  SELECT t.tweet_id, tree.conversation_id, depth + 1
  FROM tree JOIN {table} t ON trim(t.in_response_to_tweet_id) = tree.tweet_id WHERE depth < 20
),
threaded AS MATERIALIZED (
  SELECT tree.*, CASE WHEN lower(author_id) = lower('{BRAND}') THEN 'brand' ELSE 'customer' END AS role
  FROM tree JOIN {table} USING (tweet_id)
)"""


def end_to_end(source: str, table: str, order: str) -> str:
    """Brand filter, threads, cleaning and quality filter of a raw tweet table."""
    tail = PROCESSED[len(ad.MESSAGES_SQL) + 1 :].replace("FROM messages", "FROM threaded_messages")
    return f"""{source}, {graph(table, order).rstrip(',')}, {_levels(table)},
selected AS MATERIALIZED (SELECT * FROM {table} WHERE tweet_id IN (SELECT tweet_id FROM r10)),
{threads('selected', order)},
threaded_messages AS MATERIALIZED (
  SELECT t.conversation_id, tweet_id, t.role, author_id, {order} AS created_at, coalesce(text, '') AS text
  FROM threaded t JOIN selected s USING (tweet_id)
),
{tail}"""


TERMS = f"""
toks AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(lower(text), {q(WORD + '{2,}')}) AS w FROM documents
),
terms AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(list_concat(w, {ngrams('w', 2)})) AS term FROM toks)
  GROUP BY ALL
)"""


def vocabulary(name: str, terms: str, docs: str, cap: int, condition: str = "true") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT term, count(*) AS df, sum(tf)::BIGINT AS tf,
         ln((1.0::DOUBLE + (SELECT count(*) FROM {docs})) / (1.0::DOUBLE + count(*))) + 1.0::DOUBLE AS idf
  FROM {terms} GROUP BY term HAVING {condition}
  ORDER BY tf DESC, term LIMIT {cap}
)"""


def unit(name: str, terms: str, vocab: str, tf: str = "t.tf::DOUBLE") -> str:
    return f"""
{name} AS MATERIALIZED (
  SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight
  FROM (SELECT t.doc_id, t.term, {tf} * v.idf AS raw FROM {terms} t JOIN {vocab} v USING (term))
)"""


def sparse_topk(queries: str, docs: str, cap: int, k: int) -> str:
    """Scores of all pairs by plain joins; zero scores fill up."""
    return f"""
ctoks AS (SELECT doc_id, regexp_extract_all(lower(text), {q(WORD + '{2,}')}) AS w FROM {docs}),
cterms AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(list_concat(w, {ngrams('w', 2)})) AS term FROM ctoks) GROUP BY ALL),
qtoks AS (SELECT query_id AS doc_id, regexp_extract_all(lower(text), {q(WORD + '{2,}')}) AS w
          FROM {queries} WHERE NOT {blank('text')}),
qterms AS MATERIALIZED (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(list_concat(w, {ngrams('w', 2)})) AS term FROM qtoks) GROUP BY ALL),
{vocabulary('vocab', 'cterms', docs, cap)},
{unit('cw', 'cterms', 'vocab')},
{unit('qw', 'qterms', 'vocab')},
sims AS MATERIALIZED (
  SELECT a.doc_id AS query_id, b.doc_id, round(sum(a.weight * b.weight), 9) AS score
  FROM qw a JOIN cw b USING (term) GROUP BY ALL),
top AS MATERIALIZED (
  SELECT t.query_id, d.doc_id, coalesce(score, 0.0::DOUBLE) AS score,
         row_number() OVER (PARTITION BY t.query_id ORDER BY coalesce(score, 0.0::DOUBLE) DESC, d.doc_id) AS rank
  FROM (SELECT doc_id AS query_id FROM qtoks) t CROSS JOIN (SELECT doc_id FROM {docs}) d
  LEFT JOIN sims s ON s.query_id = t.query_id AND s.doc_id = d.doc_id
  QUALIFY rank <= {k})"""


def rule_classes(terms: str, docs: str, asked: str, messages: str, labels) -> str:
    """Classes of messages (doc_id, text) by a linear model of rule-made weights.

    kbest has (doc_id, text, intent, conf, cands, names, probs).
    """
    listed = ", ".join(f"({i}, {q(c)})" for i, c in enumerate(sorted(labels)))
    return f"""
{vocabulary('kvocab', terms, docs, P.classifier_features)},
{unit('kw', asked, 'kvocab', '(1.0::DOUBLE + ln(t.tf))')},
klabels AS (SELECT * FROM (VALUES {listed}) t(i, label)),
kscores AS (
  SELECT m.doc_id, l.label, 0.01::DOUBLE * l.i + coalesce(sum(
    k.weight * ((ascii(k.term) * 31 + length(k.term) * 7 + l.i * 13) % 41 - 20) / 2.0::DOUBLE), 0.0::DOUBLE) AS s
  FROM {messages} m CROSS JOIN klabels l LEFT JOIN kw k ON k.doc_id = m.doc_id GROUP BY m.doc_id, l.i, l.label),
kexp AS (SELECT *, exp(s - max(s) OVER (PARTITION BY doc_id)) AS e FROM kscores),
kprobs AS (
  SELECT doc_id, label, e / sum(e) OVER (PARTITION BY doc_id) AS p,
         row_number() OVER (PARTITION BY doc_id ORDER BY e DESC, label) AS place FROM kexp),
kbest AS MATERIALIZED (
  SELECT m.doc_id, m.text, CASE WHEN {blank('m.text')} THEN 'general_inquiry' ELSE t.names[1] END AS intent,
         CASE WHEN {blank('m.text')} THEN 1.0::DOUBLE ELSE t.probs[1] END AS conf,
         CASE WHEN {blank('m.text')} THEN ['general_inquiry'] ELSE t.names END AS names,
         CASE WHEN {blank('m.text')} THEN [1.0::DOUBLE] ELSE t.probs END AS probs
  FROM {messages} m JOIN (
    SELECT doc_id, list(label ORDER BY place) AS names, list(p ORDER BY place) AS probs
    FROM kprobs WHERE place <= 3 GROUP BY doc_id) t USING (doc_id))"""


def rule_scores(asked: str) -> str:
    """Messages qs (query_id, text) scored by rule-made weights: kdone has every part of the result."""
    template = "CASE s.intent " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PR.REPLY_TEMPLATES.items())
    template += f" ELSE {q(PR.REPLY_TEMPLATES['general_inquiry'])} END"
    return f"""
qs AS MATERIALIZED ({asked}),
ds AS (SELECT conversation_id AS doc_id, customer_text AS text FROM pairs),
{sparse_topk('qs', 'ds', P.retrieval_features, 3)},
ms AS (SELECT query_id AS doc_id, text FROM qs),
{rule_classes('cterms', 'ds', 'qterms', 'ms', PR.INTENTS)},
kevidence AS (
  SELECT query_id AS doc_id, count(*) AS n_evidence, max(CASE WHEN rank = 1 THEN score END) AS best_score,
         max(CASE WHEN rank = 1 THEN brand_reply END) AS best_reply,
         list({{'conversation_id': conversation_id, 'customer_text': customer_text, 'brand_reply': brand_reply,
                'similarity_score': round(score, 4)}} ORDER BY rank) AS examples
  FROM top JOIN pairs ON pairs.conversation_id = top.doc_id GROUP BY 1),
kdone AS MATERIALIZED (
  SELECT s.*, coalesce(n_evidence, 0) AS n_evidence, examples, {escalation_case('s.text', 's.intent', 's.conf')},
         CASE WHEN best_score >= 0.75 AND best_reply <> '' THEN best_reply ELSE {template} END AS reply
  FROM kbest s LEFT JOIN kevidence USING (doc_id))"""


def escalation_case(msg: str, intent: str, conf: str) -> str:
    branches = [
        (f"{conf} < 0.65", 0.90, f"printf('Low intent classification confidence (%.2f < threshold %.2f)', {conf}, 0.65::DOUBLE)"),
        (f"{intent} IN {in_list(PR.SENSITIVE_INTENTS)}", 0.95, f"'Intent ''' || {intent} || ''' involves sensitive operations and requires human verification'"),
    ]
    for category, kws in PR.TRIGGER_KEYWORDS.items():
        title = " ".join(w.capitalize() for w in category.split("_"))
        for kw in kws:
            branches.append((f"contains(lower({msg}), {q(kw)})", 0.95, q(f"Detected {title} escalation keyword: '{kw}'")))
    for term in PR.HIGH_RISK_TERMS:
        branches.append((f"contains(lower({msg}), {q(term)})", 0.98, q(f"Detected high-risk legal/fraud term: '{term}'")))
    reason = " ".join(f"WHEN {c} THEN {r}" for c, _, r in branches)
    score = " ".join(f"WHEN {c} THEN {s}::DOUBLE" for c, s, _ in branches)
    auto = f"'High confidence intent ''' || {intent} || ''' eligible for automated response'"
    any_rule = " OR ".join(f"({c})" for c, _, _ in branches)
    return (
        f"CASE WHEN {any_rule} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS escalation_decision, "
        f"CASE {score} ELSE round({conf}, 2) END AS escalation_confidence, "
        f"CASE {reason} ELSE {auto} END AS escalation_reason"
    )


DECISIONS = f"""{ad.MESSAGES_SQL},
decisions AS (
  SELECT tweet_id AS doc_id, intent, conf, text, {escalation_case('text', 'intent', 'conf')}
  FROM (SELECT *, {INTENT_OF_N} AS intent, {CONFIDENCE_OF_N} AS conf FROM messages)
)"""

EVIDENCE = f"""{PAIRS},
ev AS (
  SELECT *, CAST(substr(conversation_id, 6) AS BIGINT) AS k,
         CASE CAST(substr(conversation_id, 6) AS BIGINT) % 4 WHEN 0 THEN 'order_status'
              WHEN 1 THEN 'billing_issue' WHEN 2 THEN 'product_issue' ELSE 'unknown' END AS intent,
         CAST((CAST(substr(conversation_id, 6) AS BIGINT) * 7) % 100 AS DOUBLE) / 100 AS s1,
         CAST((CAST(substr(conversation_id, 6) AS BIGINT) * 3) % 50 AS DOUBLE) / 100 AS s2
  FROM pairs
)"""

_low = "lower(text)"
HEURISTIC = f"""
SELECT *, round((groundedness + correctness + empathy + actionability + brand_tone) / 5.0::DOUBLE, 2) AS overall_score
FROM (SELECT tweet_id,
  CASE WHEN {contains_any(_low, PR.GROUNDED_WORDS)} THEN 5 ELSE 4 END AS groundedness,
  CASE WHEN length(text) > 10 THEN 5 ELSE 4 END AS correctness,
  CASE WHEN {contains_any(_low, PR.EMPATHY_STRONG)} THEN 5 WHEN {contains_any(_low, PR.EMPATHY_POLITE)} THEN 4 ELSE 3 END AS empathy,
  CASE WHEN {contains_any(_low, PR.ACTION_STRONG)} THEN 5 WHEN {contains_any(_low, PR.ACTION_WEAK)} THEN 4 ELSE 3 END AS actionability,
  CASE WHEN length(text) <= 280 THEN 5 ELSE 4 END AS brand_tone
"""

ESC_TRUE = "coalesce(upper(trim(CAST({} AS VARCHAR))) IN ('TRUE','YES','1','ESCALATE','HUMAN REQUIRED'), false)"


def intent_metrics(by: str, source: str, true: str, pred: str) -> str:
    """Per-class table ``pc`` and its averages, optionally per group."""
    g = f"{by}, " if by else ""
    join = f"USING ({by}, label)" if by else "USING (label)"
    return f"""
pc AS MATERIALIZED (
  SELECT *, coalesce(hits / nullif(predicted, 0), 0.0::DOUBLE) AS precision,
         coalesce(hits / nullif(support, 0), 0.0::DOUBLE) AS recall,
         coalesce(2.0::DOUBLE * hits / nullif(predicted + support, 0), 0.0::DOUBLE) AS f1
  FROM (SELECT {g}label, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted, coalesce(hits, 0) AS hits
        FROM (SELECT {g}{true} AS label, count(*) AS support, count(*) FILTER ({true} = {pred}) AS hits FROM {source} GROUP BY ALL)
        FULL JOIN (SELECT {g}{pred} AS label, count(*) AS predicted FROM {source} GROUP BY ALL) {join})
)"""


METRIC_COLUMNS = """
  round(sum(hits) / sum(support), 4) AS accuracy,
  round(avg(precision), 4) AS precision_macro, round(sum(precision * support) / sum(support), 4) AS precision_weighted,
  round(avg(recall), 4) AS recall_macro, round(sum(recall * support) / sum(support), 4) AS recall_weighted,
  round(avg(f1), 4) AS f1_macro, round(sum(f1 * support) / sum(support), 4) AS f1_weighted,
  sum(support)::BIGINT AS total_samples, count(*) AS classes"""


def escalation_columns(t: str, p: str) -> str:
    def rate(a, b):
        return f"round(coalesce(({a})::DOUBLE / nullif({b}, 0), 0.0::DOUBLE), 4)"

    return (
        "SELECT *, " + rate("tp + tn", "tn + fp + fn + tp") + " AS accuracy, " + rate("tp", "tp + fp") + " AS precision, "
        + rate("tp", "tp + fn") + " AS recall, " + rate("2 * tp", "2 * tp + fp + fn") + " AS f1, "
        + rate("fp", "fp + tn") + " AS false_positive_rate, " + rate("fn", "fn + tp") + " AS false_negative_rate FROM (SELECT {by}"
        f"count(*) FILTER (NOT {t} AND NOT {p}) AS tn, count(*) FILTER (NOT {t} AND {p}) AS fp, "
        f"count(*) FILTER ({t} AND NOT {p}) AS fn, count(*) FILTER ({t} AND {p}) AS tp FROM {{source}} {{group}})"
    )


RATED = f"{ad.HUMAN_SQL}, {ad.JUDGE_SQL}, rated AS MATERIALIZED (SELECT * FROM human JOIN judge USING (conversation_id))"
RATED_LONG = RATED + ", dims AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT '{d}' AS dimension, human_{d} AS h, {d} AS j FROM rated" for d in ad.DIMENSIONS
) + ")"

ANNOTATED = ad.ANNOTATIONS_SQL
_intents = "[" + ", ".join(f"'{v}'" for v in PR.INTENTS) + "]"
_levels_text = "[" + ", ".join(f"'{v}'" for v in PR.CONFIDENCE_LEVELS) + "]"
_reasons = "[" + ", ".join(f"'{v}'" for v in PR.ESCALATION_REASONS if v != "none") + "]"
_esc = ESC_TRUE.format("escalation")
RECORD_ERRORS = f"""{ANNOTATED},
errs AS MATERIALIZED (
  SELECT *, list_filter([
    CASE WHEN {blank('conversation_id')} THEN 'conversation_id is empty' END,
    CASE WHEN {blank('primary_intent')} THEN 'primary_intent is empty'
         WHEN primary_intent NOT IN {in_list(PR.INTENTS)} THEN 'Invalid intent ''' || primary_intent || {q("'. Valid: " + _intents)} END,
    CASE WHEN confidence IS NULL OR confidence NOT IN {in_list(PR.CONFIDENCE_LEVELS)}
         THEN 'Invalid confidence ''' || coalesce(confidence, '') || {q("'. Valid: " + _levels_text)} END,
    CASE WHEN {_esc} AND ({blank('escalation_reason')} OR escalation_reason = 'none') THEN 'escalation_reason is required when escalation is True'
         WHEN {_esc} AND escalation_reason NOT IN {in_list(PR.ESCALATION_REASONS)}
         THEN 'Invalid escalation_reason ''' || escalation_reason || {q("'. Valid: " + _reasons)} END
  ], lambda e: e IS NOT NULL) AS errors
  FROM annotations
)"""
GOLDEN = f"""{ANNOTATED},
golden AS MATERIALIZED (
  SELECT * FROM (SELECT * FROM annotations
                 QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY annotated_at DESC, row_id DESC) = 1)
  WHERE primary_intent IN {in_list(PR.INTENTS)} AND NOT {blank('conversation_id')}
)"""

SUMMARY_TAIL = f"""
removed AS (
  SELECT (SELECT count(*) FROM flagged WHERE reason = 'empty_text') AS removed_empty_text,
         (SELECT count(*) FROM flagged WHERE reason = 'system_messages') AS removed_system_messages,
         (SELECT count(*) FROM flagged WHERE reason = 'too_short') AS removed_too_short,
         (SELECT count(*) FROM flagged WHERE reason IS NULL) - (SELECT count(*) FROM uniq) AS removed_duplicates,
         (SELECT count(*) FROM uniq) - (SELECT count(*) FROM processed) AS removed_short_conversations,
         (SELECT count(DISTINCT conversation_id) FROM uniq) - (SELECT count(*) FROM sizes) AS removed_short_conversations_threads
)"""


def build() -> dict[str, str]:
    o: dict[str, str] = {}

    def w(name: str, ctes: str, select: str, recursive: bool = False) -> None:
        o[name] = f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"

    # sources
    w("scan_messages", ad.TWEETS_SQL,
      "SELECT tweet_id, author_id, inbound, created_at, text, response_tweet_id, in_response_to_tweet_id FROM tweets")
    o["normalize_inbound"] = (
        f"SELECT {ad.N} AS n, CASE {INBOUND} WHEN 'True' THEN true WHEN 'False' THEN false END AS inbound FROM conversations")
    w("scan_message_json", ad.MESSAGES_SQL, "SELECT tweet_id, 0::BIGINT AS position, text FROM messages")
    w("annotated_ids", ANNOTATED, "SELECT DISTINCT conversation_id FROM annotations WHERE conversation_id IS NOT NULL")
    w("training_table", f"{CONVERSATIONS}, {GOLDEN}",
      "SELECT conversation_id, opening_message AS text, primary_intent, 'conversations' AS source FROM golden JOIN conv USING (conversation_id)")
    w("evaluation_table", f"{CONVERSATIONS}, {GOLDEN}",
      "SELECT conversation_id, opening_message AS customer_text, primary_intent, escalation, 'conversations' AS source FROM golden JOIN conv USING (conversation_id)")
    brand_lines = (f"list_filter(list_transform(string_split(full_conversation, chr(10)), lambda x: {strip('x')}), "
                   f"lambda x: starts_with(x, '[BRAND]') OR contains(x, '{BRAND}'))[1]")
    w("evidence_table", f"{CONVERSATIONS}, {PAIRS[len(PROCESSED) + 1:]}, lined AS (SELECT conversation_id, opening_message, {brand_lines} AS hit FROM conv)",
      f"SELECT conversation_id, opening_message AS customer_text, CASE WHEN hit IS NULL THEN {q(PR.REPLY_WHEN_NO_BRAND_LINE)} "
      f"WHEN starts_with(hit, '[BRAND]') THEN {strip(f'replace(hit, {q('[BRAND]')}, {q('')})')} ELSE hit END AS brand_reply, 'index' AS source FROM lined "
      "UNION ALL SELECT conversation_id, customer_text, brand_reply, 'messages' FROM pairs")
    raw_cols = ["tweet_id", "author_id", "inbound", "created_at", "text", "response_tweet_id", "in_response_to_tweet_id"]
    w("profile_raw", ad.TWEETS_SQL,
      "SELECT count(*) AS total_rows, 7::BIGINT AS total_columns, count(*) FILTER (inbound) AS inbound_rows, "
      "count(*) FILTER (NOT inbound) AS outbound_rows, count(DISTINCT author_id) AS unique_authors, "
      + ", ".join(f"count(*) FILTER ({c} IS NULL) AS null_{c}" for c in raw_cols) + " FROM tweets")
    w("null_report", ad.TWEETS_SQL,
      " UNION ALL ".join(
          f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls, "
          f"{pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct FROM tweets" for c in raw_cols))

    # graph
    tw, evt = ad.TWEETS_SQL, ad.EVENT_TWEETS_SQL
    w("brand_messages", tw, f"SELECT tweet_id, author_id FROM tweets WHERE lower(author_id) = lower('{BRAND}')")
    w("top_brands", tw,
      "SELECT author_id, count(*) AS messages FROM tweets WHERE NOT inbound GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
    w("with_role", tw, f"SELECT tweet_id, CASE WHEN lower(author_id) = lower('{BRAND}') THEN 'brand' ELSE 'customer' END AS role FROM tweets")
    g_t, g_e = graph("tweets", "created_at").rstrip(","), graph("event_tweets", "created_us").rstrip(",")
    w("reply_edges", f"{tw}, {g_t}", "SELECT tweet_id, response_id FROM listed")
    w("brand_seed", f"{evt}, {g_e}", "SELECT tweet_id FROM seed")
    w("brand_conversations", f"{tw}, {g_t}, {_levels('tweets')}", "SELECT tweet_id, author_id FROM tweets WHERE tweet_id IN (SELECT tweet_id FROM r10)")
    ev_levels = f"{evt}, {g_e}, {_levels('event_tweets')}"
    w("brand_conversations_events", ev_levels,
      "SELECT tweet_id, author_id FROM event_tweets WHERE tweet_id IN (SELECT tweet_id FROM r10)")
    kept = "tweet_id IN (SELECT tweet_id FROM r10)"
    isb = f"lower(author_id) = lower('{BRAND}')"
    w("brand_filter_report", ev_levels,
      f"SELECT count(*) AS original_rows, count(*) FILTER ({kept}) AS filtered_rows, count(*) FILTER (NOT {kept}) AS removed_rows, "
      f"round(count(*) FILTER ({kept}) * 100.0::DOUBLE / count(*), 1) AS retention_pct, "
      f"count(*) FILTER ({kept} AND {isb}) AS brand_messages, count(*) FILTER ({kept} AND NOT {isb}) AS customer_messages, "
      "(SELECT max(hop) + 1 FROM r10)::BIGINT AS rounds, (SELECT max(hop) < 10 FROM r10) AS converged FROM event_tweets")
    w("thread_roots", f"{ev_levels}, filtered AS (SELECT * FROM event_tweets WHERE {kept})",
      "SELECT tweet_id FROM filtered WHERE in_response_to_tweet_id IS NULL OR in_response_to_tweet_id NOT IN (SELECT tweet_id FROM filtered)")
    cols = "conversation_id, tweet_id, role, depth"
    w("build_threads", f"{tw}, {threads('tweets', 'created_at')}", f"SELECT {cols} FROM threaded", True)
    w("build_threads_events", f"{evt}, {threads('event_tweets', 'created_us')}", f"SELECT {cols} FROM threaded", True)
    w("thread_depth_report", f"{evt}, {threads('event_tweets', 'created_us')}",
      "SELECT count(*) AS messages, (SELECT count(*) FROM tree) AS placed, count(*) - (SELECT count(*) FROM tree) AS dropped FROM event_tweets", True)
    w("message_sequence", ad.MESSAGES_SQL,
      "SELECT conversation_id, tweet_id, row_number() OVER (PARTITION BY conversation_id ORDER BY created_at, tweet_id) AS seq FROM messages")
    w("thread_stats", f"{evt}, {threads('event_tweets', 'created_us')}, "
      "ts AS (SELECT conversation_id, count(*) AS n, count(*) FILTER (role = 'customer') AS c, count(*) FILTER (role = 'brand') AS b FROM threaded GROUP BY 1)",
      "SELECT count(*) AS conversations, sum(n)::BIGINT AS messages, round(avg(n), 1) AS mean_length, max(n) AS max_length, min(n) AS min_length, "
      "quantile_cont(n, 0.5) AS median_length, round(avg(b), 1) AS mean_brand_messages, round(avg(c), 1) AS mean_customer_messages FROM ts", True)
    classes = [(1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 4, "4"), (5, 9, "5-9"), (10, 19, "10-19"), (20, 10**9, "20+")]
    w("thread_length_histogram", f"{ad.MESSAGES_SQL}, s AS (SELECT count(*) AS n FROM messages GROUP BY conversation_id)",
      " UNION ALL ".join(f"SELECT {i}::BIGINT AS position, '{name}' AS length, count(*) FILTER (n BETWEEN {a} AND {b}) AS conversations FROM s"
                         for i, (a, b, name) in enumerate(classes)))

    # cleaning and quality
    w("clean_text", CLEANED, "SELECT tweet_id, text, text_original FROM cleaned")
    o["clean_documents"] = f"SELECT doc_id, {clean('text')} AS text FROM documents"
    w("cleaning_samples", CLEANED,
      "SELECT tweet_id, text_original, text FROM cleaned WHERE text <> text_original "
      "ORDER BY md5(concat(tweet_id, '|42')), tweet_id LIMIT 3")
    w("cleaning_report", CLEANED,
      f"SELECT count(*) AS messages, count(*) FILTER (text <> text_original) AS modified, "
      f"{pct('count(*) FILTER (text <> text_original)', 'count(*)')} AS modified_pct FROM cleaned")
    w("quality_filtered", PROCESSED, "SELECT conversation_id, tweet_id, author_id, role, text FROM processed")
    stages = ["empty_text", "system_messages", "too_short", "duplicates", "short_conversations", "short_conversations_threads"]
    w("quality_removals", f"{PROCESSED}, {SUMMARY_TAIL}",
      " UNION ALL ".join(f"SELECT '{s}' AS stage, {i}::BIGINT AS position, removed_{s} AS removed FROM removed" for i, s in enumerate(stages)))
    from_tweets = end_to_end(ad.TWEETS_SQL, "tweets", "created_at")
    run_columns = "SELECT conversation_id, tweet_id, role, text FROM processed"
    w("preprocess_messages", from_tweets, run_columns, True)
    w("preprocess_messages_events", end_to_end(ad.EVENT_TWEETS_SQL, "event_tweets", "created_us"), run_columns, True)
    w("preprocess_conversations", f"{from_tweets},{CONVERSATIONS[len(PROCESSED) + 1 :]}", "SELECT *, 0::BIGINT AS part FROM conv", True)

    def summary(raw: str) -> str:
        return (
            f"SELECT (SELECT count(*) FROM {raw}) AS raw_total_rows, sum(n)::BIGINT AS final_total_messages, count(*) AS final_total_conversations, "
            "round(avg(n), 2) AS mean_length, round(quantile_cont(n, 0.5), 2) AS median_length, max(n) AS max_length, min(n) AS min_length, "
            "round(stddev_samp(n), 2) AS std_length, sum(c)::BIGINT AS customer_messages, sum(b)::BIGINT AS brand_messages, "
            + ", ".join(f"(SELECT removed_{s} FROM removed) AS removed_{s}" for s in stages)
            + f", {pct('sum(n)', f'(SELECT count(*) FROM {raw})', 2)} AS retention_rate FROM sizes"
        )

    w("preprocessing_summary", f"{PROCESSED}, {SUMMARY_TAIL}", summary("messages"))
    w("preprocess_summary", f"{from_tweets}, {SUMMARY_TAIL}", summary("tweets"), True)

    # conversations
    w("overview_counts", PROCESSED,
      "SELECT count(DISTINCT conversation_id) AS total_conversations, count(*) AS total_messages, count(*) FILTER (role = 'customer') AS customer_messages, "
      "count(*) FILTER (role = 'brand') AS brand_replies, count(DISTINCT author_id) FILTER (role = 'customer') AS unique_customers FROM processed")
    w("thread_length_stats", PROCESSED,
      "SELECT round(avg(n), 2) AS mean, round(quantile_cont(n, 0.5), 2) AS median, round(stddev_samp(n), 2) AS std, min(n) AS min, max(n) AS max, "
      "round(quantile_cont(n, 0.25), 2) AS q25, round(quantile_cont(n, 0.75), 2) AS q75 FROM sizes")
    w("notable_conversations", PROCESSED,
      "SELECT (SELECT conversation_id FROM sizes ORDER BY n DESC, conversation_id LIMIT 1) AS longest_id, max(n) AS longest_length, "
      "(SELECT conversation_id FROM sizes ORDER BY n, conversation_id LIMIT 1) AS shortest_id, min(n) AS shortest_length FROM sizes")
    w("role_balance", PROCESSED,
      "SELECT round(avg(c), 2) AS avg_customer_msgs_per_thread, round(avg(b), 2) AS avg_brand_replies_per_thread, "
      "round(sum(c)::DOUBLE / sum(b)::DOUBLE, 2) AS customer_to_brand_ratio FROM sizes")
    tl = "round(avg(length(text)), 2) AS mean, round(quantile_cont(length(text), 0.5), 2) AS median, max(length(text))::BIGINT AS max, min(length(text))::BIGINT AS min"
    w("text_length_stats", PROCESSED,
      f"SELECT 'all' AS scope, {tl} FROM processed UNION ALL SELECT role, {tl} FROM processed GROUP BY role")
    w("temporal_span", PROCESSED,
      "SELECT min(created_at) AS earliest, max(created_at) AS latest, (max(created_at) - min(created_at)) // 86400 AS span_days FROM processed")
    w("length_distribution", PROCESSED, "SELECT n, count(*) AS conversations FROM sizes GROUP BY 1")
    w("length_percentiles", PROCESSED,
      "SELECT " + ", ".join(f"round(quantile_cont(n, {p / 100}), 1) AS p{p}" for p in (10, 25, 50, 75, 90, 95)) + " FROM sizes")
    w("participation", PROCESSED,
      " UNION ALL ".join(f"SELECT '{r}' AS role, round(avg({c}), 2) AS mean, round(quantile_cont({c}, 0.5), 2) AS median, max({c}) AS max, "
                         f"count(*) FILTER ({c} = 0) AS conversations_with_zero FROM sizes" for r, c in (("customer", "c"), ("brand", "b"))))
    w("turn_structure", PROCESSED,
      "SELECT count(*) FILTER (n = 2) AS single_turn_count, count(*) FILTER (n > 2) AS multi_turn_count, count(*) AS total, "
      f"{pct('count(*) FILTER (n = 2)', 'count(*)')} AS single_turn_pct, {pct('count(*) FILTER (n > 2)', 'count(*)')} AS multi_turn_pct FROM sizes")
    buckets = [(2, 2, "2 messages"), (3, 4, "3-4 messages"), (5, 6, "5-6 messages"), (7, 10, "7-10 messages"), (11, 10**9, "11+ messages")]
    w("length_buckets", PROCESSED,
      " UNION ALL ".join(f"SELECT {i}::BIGINT AS position, '{name}' AS bucket, count(*) FILTER (n BETWEEN {a} AND {b}) AS conversations, "
                         f"{pct(f'count(*) FILTER (n BETWEEN {a} AND {b})', 'count(*)')} AS pct FROM sizes" for i, (a, b, name) in enumerate(buckets)))
    w("brand_responsiveness", PROCESSED,
      f"SELECT count(*) FILTER (b = 0) AS conversations_without_brand_reply, {pct('count(*) FILTER (b > 0)', 'count(*)')} AS brand_reply_rate FROM sizes")
    w("role_switches", SWITCHES, "SELECT * FROM switches")
    o["bucketed_role_switches"] = o["role_switches"]
    w("response_depth", SWITCHES,
      "SELECT round(avg(role_switches), 2) AS mean_switches, round(quantile_cont(role_switches, 0.5), 2) AS median_switches, "
      "max(role_switches) AS max_switches, round(avg(depth), 2) AS mean_depth FROM switches")
    w("depth_distribution", SWITCHES, "SELECT depth, count(*) AS conversations FROM switches GROUP BY 1 ORDER BY 1 LIMIT 15")
    w("last_speaker", PROCESSED,
      "SELECT conversation_id, role AS last_role FROM processed QUALIFY row_number() OVER (PARTITION BY conversation_id ORDER BY seq DESC) = 1")
    w("opening_messages", OPENINGS, f"SELECT conversation_id, text FROM openings WHERE length({strip('text')}) > 10")
    w("evidence_pairs", PAIRS, "SELECT conversation_id, customer_text, brand_reply FROM pairs")
    w("conversation_table", CONVERSATIONS, "SELECT *, 0::BIGINT AS part FROM conv")

    # language
    def top(items: str, name: str, n: int) -> str:
        return f"SELECT {name}, count(*) AS count FROM (SELECT unnest({items}) AS {name} FROM cust) GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT {n}"

    w("top_keywords", CUSTOMER, top(words("text"), "word", 30))
    for n, name in ((2, "top_bigrams"), (3, "top_trigrams")):
        w(name, f"{CUSTOMER}, wl AS (SELECT {words('text')} AS w FROM cust)", top(ngrams("w", n), "phrase", 20).replace("FROM cust", "FROM wl"))
    comp = f"count(*) FILTER ({contains_any('lower(text)', PR.COMPLAINT_WORDS)})"
    qu, ex = "count(*) FILTER (contains(text, '?'))", "count(*) FILTER (contains(text, '!'))"
    w("message_types", CUSTOMER,
      f"SELECT {qu} AS questions, {comp} AS complaints, {ex} AS exclamation_msgs, {pct(qu, 'count(*)')} AS questions_pct, "
      f"{pct(comp, 'count(*)')} AS complaints_pct, {pct(ex, 'count(*)')} AS exclamation_pct FROM cust")
    w("emotional_punctuation", CUSTOMER,
      "SELECT count(*) FILTER (regexp_matches(text, '!{2,}')) AS multiple_exclamations, count(*) FILTER (regexp_matches(text, '[?]{2,}')) AS multiple_questions, "
      "count(*) FILTER (length(text) > 10 AND len(regexp_extract_all(text, '\\p{Lu}')) / length(text) > 0.5) AS mostly_caps FROM cust")
    emoji = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in PR.EMOJI_RANGES) + "]"
    em = f"regexp_extract_all(text, '{emoji}')"
    w("emoji_usage", CUSTOMER,
      f"SELECT count(*) FILTER (len({em}) > 0) AS messages_with_emoji, {pct(f'count(*) FILTER (len({em}) > 0)', 'count(*)')} AS emoji_pct, "
      f"(SELECT count(DISTINCT e) FROM (SELECT unnest({em}) AS e FROM cust)) AS total_unique_emojis FROM cust")
    w("top_emojis", CUSTOMER, top(em, "emoji", 10))
    themes = " UNION ALL ".join(f"SELECT {q(' '.join(x.capitalize() for x in t.split('_')))} AS theme_label, unnest([{', '.join(q(x) for x in ws)}]) AS word" for t, ws in PR.KEYWORD_THEMES.items())
    w("keyword_themes", f"{OPENINGS}, lex AS ({themes}), wc AS (SELECT word, count(*) AS n FROM (SELECT unnest({words('text')}) AS word "
      f"FROM openings WHERE length({strip('text')}) > 10) GROUP BY 1)",
      "SELECT theme_label, coalesce(sum(n), 0)::BIGINT AS total_mentions FROM lex LEFT JOIN wc USING (word) GROUP BY 1")
    o["document_keywords"] = top(words("text"), "word", 50).replace("FROM cust", "FROM documents")

    # signals
    cats = list(PR.SIGNAL_KEYWORDS)
    w("conversation_signals", SIGNALS, "SELECT * FROM sig")
    w("keyword_signals", SIGNALS,
      " UNION ALL ".join(f"SELECT '{c}' AS category, count(*) FILTER ({c}) AS count, {pct(f'count(*) FILTER ({c})', 'count(*)')} AS pct, "
                         f"(SELECT coalesce(string_agg(conversation_id, ',' ORDER BY conversation_id), '') FROM (SELECT conversation_id FROM sig WHERE {c} ORDER BY 1 LIMIT 5)) "
                         f"AS sample_conversations FROM sig" for c in cats))
    o["keyword_signals_table"] = o["keyword_signals"]
    listed = ", ".join(f"({q(c)}, {q(k)})" for c, ks in PR.SIGNAL_KEYWORDS.items() for k in ks)
    w("conversation_keywords", f"""{PROCESSED}, kws AS (SELECT DISTINCT * FROM (VALUES {listed}) t(category, keyword)),
joined_texts AS (SELECT conversation_id, string_agg(lower(text), ' ' ORDER BY seq) AS joined FROM processed WHERE role = 'customer' GROUP BY 1)""",
      "SELECT conversation_id, category, keyword FROM joined_texts JOIN kws ON contains(joined, keyword)")
    o["document_part_names"] = (
        "SELECT keyword, count(*) AS documents, min(doc_id) AS first_id FROM documents JOIN "
        "(SELECT DISTINCT lower(unnest(string_split(p_name, ' '))) AS keyword FROM part) ON contains(lower(text), keyword) GROUP BY 1")
    for f in ("repeated_followups", "unresolved"):
        w(f, SIGNALS, f"SELECT count(*) FILTER ({f}) AS count, {pct(f'count(*) FILTER ({f})', 'count(*)')} AS pct FROM sig")
    anyhit = " OR ".join(["repeated_followups", "unresolved", *cats])
    w("any_escalation", SIGNALS,
      f"SELECT count(*) FILTER ({anyhit}) AS conversations_with_any_signal, {pct(f'count(*) FILTER ({anyhit})', 'count(*)')} AS pct FROM sig")
    w("escalation_signal_table", SIGNALS,
      " UNION ALL ".join(f"SELECT '{f}' AS signal, count(*) FILTER ({f}) AS conversations, {pct(f'count(*) FILTER ({f})', 'count(*)')} AS pct FROM sig"
                         for f in [*cats, "repeated_followups", "unresolved"]))

    def series(chart, label, count, pct_expr, tail):
        return f"SELECT '{chart}' AS chart, {label} AS label, {count} AS count, {pct_expr} AS pct {tail}"

    null = "NULL::DOUBLE"
    charts = [
        f"SELECT * FROM ({series('conversation_length', 'CAST(n AS VARCHAR)', 'count(*)', null, 'FROM sizes GROUP BY n ORDER BY n LIMIT 20')})",
        *[series("messages_per_thread", q(name), f"count(*) FILTER (n BETWEEN {a} AND {b})", pct(f"count(*) FILTER (n BETWEEN {a} AND {b})", "count(*)"), "FROM sizes")
          for a, b, name in buckets],
        series("customer_vs_brand", "'Customer'", "sum(c)::BIGINT", null, "FROM sizes"),
        series("customer_vs_brand", "'Brand'", "sum(b)::BIGINT", null, "FROM sizes"),
        f"SELECT 'top_keywords', word, count, {null} FROM ({top(words('text'), 'word', 20)})",
        series("turn_split", "'Single-turn'", "count(*) FILTER (n = 2)", pct("count(*) FILTER (n = 2)", "count(*)"), "FROM sizes"),
        series("turn_split", "'Multi-turn'", "count(*) FILTER (n > 2)", pct("count(*) FILTER (n > 2)", "count(*)"), "FROM sizes"),
        f"SELECT * FROM ({series('response_depth', 'CAST(depth AS VARCHAR)', 'count(*)', null, 'FROM switches GROUP BY depth ORDER BY depth LIMIT 12')})",
        *[series("message_types", q(name), c, pct(c, "count(*)"), "FROM cust") for name, c in (("Questions", qu), ("Complaints", comp), ("Exclamations", ex))],
        *[series("escalation_signals", q(f), f"count(*) FILTER ({f})", pct(f"count(*) FILTER ({f})", "count(*)"), "FROM sig") for f in [*cats, "repeated_followups", "unresolved"]],
    ]
    w("chart_series", f"{SIGNALS}, cust AS (SELECT text FROM processed WHERE role = 'customer'), {SWITCHES_CTE}", " UNION ALL ".join(charts))

    # features and retrieval
    w("doc_terms", TERMS, "SELECT doc_id, term, tf FROM terms")
    w("tfidf_vocabulary", f"{TERMS}, {vocabulary('vocab', 'terms', 'documents', P.retrieval_features)}",
      "SELECT term, df, tf, round(idf, 6) AS idf FROM vocab")
    w("tfidf_weights",
      f"{TERMS}, {vocabulary('vocab', 'terms', 'documents', P.classifier_features, 'count(*) >= 3 AND count(*) <= 0.8 * (SELECT count(*) FROM documents)')}, "
      f"{unit('weights', 'terms', 'vocab', '(1.0::DOUBLE + ln(t.tf))')}",
      "SELECT doc_id, term, round(weight, 6) AS weight FROM weights")
    bench_q = "qs AS (SELECT item_id AS query_id, text FROM benchmark)"
    w("retrieve_topk", f"{bench_q}, {sparse_topk('qs', 'documents', P.retrieval_features, 3)}",
      "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM top")
    w("evidence_list", f"{PAIRS}, qs AS (SELECT conversation_id AS query_id, brand_reply AS text FROM pairs), "
      f"ds AS (SELECT conversation_id AS doc_id, customer_text AS text FROM pairs), {sparse_topk('qs', 'ds', P.retrieval_features, 3)}",
      "SELECT query_id, string_agg(concat_ws('|', CAST(rank AS VARCHAR), doc_id, printf('%.4f', round(score, 4)), customer_text, brand_reply), chr(10) ORDER BY rank) AS evidence "
      "FROM top JOIN pairs ON doc_id = conversation_id GROUP BY 1")
    w("dense_topk", "v AS MATERIALIZED (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)",
      "SELECT query_id, doc_id, round(score, 6) AS score, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank "
      "FROM (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_cosine_similarity(a.e, b.e), 9) AS score FROM v a CROSS JOIN v b)) WHERE rank <= 3")
    mgrams = f"unnest(list_concat(w, {ngrams('w', 2)}))"
    o["train_certificate"] = (
        f"WITH {TERMS} SELECT (SELECT count(*) FROM documents) AS n_docs, "
        f"(SELECT least(count(DISTINCT term), {P.classifier_features}) FROM terms) AS n_terms, "
        "(SELECT count(DISTINCT lang) FROM documents) AS n_classes, true AS optimal")
    stop_toks = f"""{OPENINGS}, od AS MATERIALIZED (
  SELECT conversation_id AS doc_id, text, CAST(substr(conversation_id, 6) AS BIGINT) % 4 AS given FROM openings),
otoks AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), {q(WORD + '{2,}')}), lambda x: x NOT IN {in_list(PR.STOP_WORDS)}) AS w FROM od),
oterms AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {mgrams} AS term FROM otoks) GROUP BY ALL),
{vocabulary('ovocab', 'oterms', 'od', 5000, 'count(*) >= 3 AND count(*) <= 0.8 * (SELECT count(*) FROM od)')},
{unit('ow', 'oterms', 'ovocab', '(1.0::DOUBLE + ln(t.tf))')},
groups AS (SELECT given AS cluster, count(*) AS members FROM od GROUP BY 1),
means AS MATERIALIZED (
  SELECT cluster, term, sum(weight) / any_value(members) AS c
  FROM ow JOIN od USING (doc_id) JOIN groups ON cluster = given GROUP BY cluster, term),
squares AS (SELECT cluster, coalesce(sum(c * c), 0.0::DOUBLE) AS n FROM range(0, 4) t(cluster) LEFT JOIN means USING (cluster) GROUP BY 1),
dots AS MATERIALIZED (SELECT doc_id, cluster, sum(weight * c) AS dot FROM ow JOIN means USING (term) GROUP BY ALL),
lengths AS (SELECT od.doc_id, coalesce(sum(weight * weight), 0.0::DOUBLE) AS square FROM od LEFT JOIN ow USING (doc_id) GROUP BY 1),
oplaced AS MATERIALIZED (
  SELECT l.doc_id, s.cluster, round(greatest(square - 2 * coalesce(dot, 0.0::DOUBLE) + n, 0.0::DOUBLE), 12) AS distance
  FROM lengths l CROSS JOIN squares s LEFT JOIN dots d ON d.doc_id = l.doc_id AND d.cluster = s.cluster
  QUALIFY row_number() OVER (PARTITION BY l.doc_id ORDER BY distance, s.cluster) = 1),
osizes AS (SELECT cluster, count(*) AS size, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM od), 1) AS frequency_pct
  FROM oplaced GROUP BY 1 HAVING count(*) >= 5),
owords AS MATERIALIZED (
  SELECT cluster, row_number() OVER (PARTITION BY cluster ORDER BY round(c, 9) DESC, term) AS rank, term AS word, round(c, 4) AS weight
  FROM means WHERE round(c, 9) > 0 AND cluster IN (SELECT cluster FROM osizes) QUALIFY rank <= 10)"""
    w("theme_clusters_given", stop_toks,
      "SELECT CAST(s.cluster AS INTEGER) AS cluster, size, frequency_pct, theme_label FROM osizes s LEFT JOIN "
      "(SELECT cluster, string_agg(word, ' / ' ORDER BY rank) AS theme_label FROM owords WHERE rank <= 3 GROUP BY 1) USING (cluster)")
    w("theme_terms_given", stop_toks, "SELECT CAST(cluster AS INTEGER) AS cluster, CAST(rank AS INTEGER) AS rank, word, weight FROM owords")
    w("theme_examples_given", stop_toks,
      "SELECT CAST(cluster AS INTEGER) AS cluster, CAST(rank AS INTEGER) AS rank, doc_id, substr(text, 1, 200) AS text FROM ("
      "SELECT p.cluster, row_number() OVER (PARTITION BY p.cluster ORDER BY distance, p.doc_id) AS rank, p.doc_id, text FROM oplaced p JOIN od USING (doc_id) "
      "WHERE p.cluster IN (SELECT cluster FROM osizes)) WHERE rank <= 5")
    w("classify_fixed", f"""{TERMS}, ms AS (SELECT item_id AS doc_id, text FROM benchmark),
mtoks AS (SELECT doc_id, regexp_extract_all(lower(text), {q(WORD + '{2,}')}) AS w FROM ms),
mterms AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {mgrams} AS term FROM mtoks) GROUP BY ALL),
{rule_classes('terms', 'documents', 'mterms', 'ms', ['de', 'en', 'es', 'fr'])}""",
      "SELECT doc_id, intent AS predicted_intent, round(conf, 6) AS confidence, "
      "array_to_string(list_transform(range(1, len(names) + 1), lambda i: names[i] || ':' || printf('%.4f', probs[i])), ' ') AS candidates FROM kbest")
    incoming = f"SELECT tweet_id AS query_id, {strip('text')} AS text FROM messages WHERE role = 'customer'"
    w("score_fixed", f"{PAIRS}, {rule_scores(incoming)}",
      "SELECT doc_id, intent AS predicted_intent, round(conf, 4) AS confidence, CAST(n_evidence AS INTEGER) AS n_evidence, "
      "escalation_decision, escalation_reason, reply AS generated_reply FROM kdone")
    w("inference_json_fixed", f"{PAIRS}, {rule_scores(incoming)}",
      "SELECT doc_id, 'customer_message,predicted_intent,confidence,top_3_candidates,retrieved_examples,generated_reply,"
      "escalation_decision,escalation_reason' AS names, text AS customer_message, intent AS predicted_intent, round(conf, 4) AS confidence, "
      "array_to_string(list_transform(range(1, len(names) + 1), lambda i: names[i] || ':' || printf('%.4f', round(probs[i], 4))), ' ') AS candidates, "
      "coalesce(array_to_string(list_transform(examples, lambda e: concat_ws('|', e.conversation_id, e.customer_text, e.brand_reply, "
      "printf('%.4f', e.similarity_score))), chr(10)), '') AS examples, reply AS generated_reply, escalation_decision, escalation_reason FROM kdone")
    gold = """gold AS MATERIALIZED (
  SELECT g.conversation_id, c.opening_message AS customer_text, g.primary_intent, g.escalation, coalesce(p.brand_reply, '') AS brand_reply
  FROM golden g JOIN conv c USING (conversation_id) LEFT JOIN pairs p USING (conversation_id))"""
    asked_low = f"lower({strip('customer_text')})"
    nearest = f"""b2 AS MATERIALIZED (WITH qs2 AS (
  SELECT conversation_id AS query_id, CASE WHEN {asked_low} = '' THEN '-' ELSE {asked_low} END AS text, {asked_low} AS low FROM gold),
ds2 AS (SELECT conversation_id AS doc_id, customer_text AS text FROM gold),
{sparse_topk('qs2', 'ds2', P.classifier_features, 1)}
SELECT query_id AS conversation_id, primary_intent AS b2_intent, round(greatest(score, 0.4::DOUBLE), 6) AS b2_confidence,
  CASE WHEN {contains_any('low', PR.NEAREST_BASELINE_WORDS)} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS b2_escalation,
  substr(brand_reply, 1, 280) AS b2_reply
FROM top JOIN qs2 USING (query_id) JOIN gold ON gold.conversation_id = top.doc_id)"""
    asked = f"SELECT conversation_id AS query_id, {strip('customer_text')} AS text FROM gold"
    w("predictions_fixed", f"{CONVERSATIONS}, {PAIRS[len(PROCESSED) + 1:]}, {GOLDEN}, {gold}, {nearest}, {rule_scores(asked)}",
      "SELECT conversation_id, customer_text, primary_intent AS true_intent, escalation AS true_escalation, brand_reply AS reference_reply, "
      "'order_status' AS b1_intent, 0.35::DOUBLE AS b1_confidence, 'AUTO_HANDLE' AS b1_escalation, 'Thank you for reaching out to @AcmeSupport. "
      "Please send us a Direct Message with your order details so we can assist you.' AS b1_reply, b2_intent, b2_confidence, b2_escalation, b2_reply, "
      "k.intent AS agent_intent, round(k.conf, 6) AS agent_confidence, k.escalation_decision AS agent_escalation, k.reply AS agent_reply "
      "FROM gold JOIN b2 USING (conversation_id) JOIN kdone k ON k.doc_id = gold.conversation_id")
    w("baseline_nearest", f"qs AS (SELECT item_id AS query_id, lower({strip('text')}) AS text FROM benchmark), "
      f"{sparse_topk('qs', 'documents', P.classifier_features, 1)}",
      f"SELECT query_id, lang AS predicted_intent, round(greatest(score, 0.4::DOUBLE), 6) AS confidence, "
      f"CASE WHEN {contains_any('qs.text', PR.NEAREST_BASELINE_WORDS)} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END AS escalation_decision, "
      "substr(documents.text, 1, 280) AS generated_reply FROM top JOIN qs USING (query_id) JOIN documents USING (doc_id)")
    o["baseline_majority"] = (
        "SELECT doc_id AS query_id, (SELECT lang FROM documents GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS predicted_intent, "
        "0.35::DOUBLE AS confidence, 'AUTO_HANDLE' AS escalation_decision, 'Thank you for reaching out to @AcmeSupport. "
        "Please send us a Direct Message with your order details so we can assist you.' AS generated_reply FROM documents")

    # decisions
    w("escalation_decisions", DECISIONS, "SELECT doc_id, escalation_decision, escalation_confidence, escalation_reason FROM decisions")
    st = strip("text")
    w("audit_rows", DECISIONS,
      f"SELECT doc_id AS message_id, intent, round(conf, 2) AS conf, escalation_decision AS esc, "
      f"replace(CASE WHEN length({st}) > 40 THEN substr({st}, 1, 40) || '...' ELSE {st} END, '\"', '''') AS msg FROM decisions")
    template = "CASE intent " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PR.REPLY_TEMPLATES.items()) + f" ELSE {q(PR.REPLY_TEMPLATES['general_inquiry'])} END"
    o["audit_log"] = f"SELECT *, 'run-' || (length(message_id) % 2) AS batch, true AS logged FROM ({o['audit_rows']})"
    w("select_reply", EVIDENCE,
      f"SELECT conversation_id, CASE WHEN k % 5 <> 0 AND s1 >= 0.75 AND brand_reply <> '' THEN brand_reply ELSE {template} END AS reply FROM ev")

    def item(i, s):
        return f"printf('Example {i} (Similarity: %.2f):', {s}) || chr(10) || '  Customer: \"' || customer_text || '\"' || chr(10) || '  Brand Reply: \"' || brand_reply || '\"'"

    o["build_prompt"] = f"""WITH {EVIDENCE}
SELECT conversation_id, 'Brand: @AcmeSupport (AcmeSupport)' || chr(10) || 'Predicted Intent: ' || intent || chr(10) || chr(10)
  || 'Incoming Customer Message:' || chr(10) || '"' || customer_text || '"' || chr(10) || chr(10)
  || 'Retrieved Historical Resolution Evidence:' || chr(10)
  || CASE WHEN k % 5 = 0 THEN 'No specific historical resolution evidence retrieved.'
          ELSE {item(1, 's1')} || chr(10) || {item(2, 's2')} END
  || chr(10) || chr(10) || 'Draft a helpful, concise, and empathetic support reply to the customer:' AS prompt
FROM ev"""

    def jitem(i):
        return f"'- Ex {i}: Customer: \"' || customer_text || '\" | Brand: \"' || brand_reply || '\"'"

    o["build_judge_prompt"] = f"""WITH {EVIDENCE}
SELECT conversation_id, {q(prompts.rubric_text(P.brand_handle))} || chr(10) || chr(10)
  || 'Context & Data to Evaluate:' || chr(10) || chr(10) || 'Customer Message:' || chr(10) || '"' || customer_text || '"' || chr(10) || chr(10)
  || 'Predicted Intent: ' || intent || chr(10) || chr(10) || 'Retrieved Historical Evidence:' || chr(10)
  || CASE WHEN k % 5 = 0 THEN 'No explicit historical evidence retrieved.' ELSE {jitem(1)} || chr(10) || {jitem(2)} END
  || chr(10) || chr(10) || 'Reference Brand Reply (Ground Truth):' || chr(10)
  || '"' || CASE WHEN k % 3 = 0 OR brand_reply = '' THEN 'N/A' ELSE brand_reply END || '"' || chr(10) || chr(10)
  || 'AI-Generated Reply (Target under Evaluation):' || chr(10) || '"' || brand_reply || '"' || chr(10) || chr(10)
  || 'Evaluate the AI-Generated Reply against the criteria and output valid JSON:' AS prompt
FROM ev"""
    line_hit = f"list_filter(list_transform(string_split(t, chr(10)), lambda x: {strip('x')}), lambda x: starts_with(x, '[BRAND]') OR contains(x, '{BRAND}'))[1]"
    w("extract_brand_reply", f"""{CONVERSATIONS},
tr AS (SELECT conversation_id, CASE CAST(substr(conversation_id, 6) AS BIGINT) % 10 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE full_conversation END AS t FROM conv),
hits AS (SELECT conversation_id, t, {line_hit} AS hit FROM tr)""",
      f"SELECT conversation_id, CASE WHEN t IS NULL OR t = '' THEN {q(PR.REPLY_WHEN_NO_TRANSCRIPT)} WHEN hit IS NULL THEN {q(PR.REPLY_WHEN_NO_BRAND_LINE)} "
      f"WHEN starts_with(hit, '[BRAND]') THEN {strip(f'replace(hit, {q('[BRAND]')}, {q('')})')} ELSE hit END AS reply FROM hits")
    w("judge_heuristic", ad.MESSAGES_SQL, f"{HEURISTIC} FROM messages)")
    judged = f"{PROCESSED}, judged AS ({HEURISTIC} FROM processed))"
    w("judge_summary", judged,
      "SELECT count(*) AS total_replies_judged, round(sum(groundedness + correctness + empathy + actionability + brand_tone) / (5.0::DOUBLE * count(*)), 2) AS average_overall_score, "
      + ", ".join(f"round(avg({d}), 2) AS average_{d}" for d in ad.DIMENSIONS) + " FROM judged")
    w("dimension_ranking", judged,
      " UNION ALL ".join(f"SELECT {i}::BIGINT AS position, '{PR.DIMENSION_LABELS[d]}' AS dimension, round(avg({d}), 2) AS mean FROM judged" for i, d in enumerate(ad.DIMENSIONS)))
    checks = ", ".join(
        f"CASE WHEN {d} IS NULL THEN 'Missing required dimension score: ''{d}''' "
        f"WHEN try_cast({d} AS INTEGER) IS NULL THEN 'Score for ''{d}'' must be an integer (got ' || {d} || ')' "
        f"WHEN try_cast({d} AS INTEGER) NOT BETWEEN 1 AND 5 THEN 'Score for ''{d}'' must be between 1 and 5 (got ' || {d} || ')' END" for d in ad.DIMENSIONS)
    o["validate_scores"] = (
        f"SELECT doc_id, concat_ws('; ', {checks}) AS errors FROM (SELECT doc_id, "
        + ", ".join(f"{e} AS {d}" for d, e in RAW_SCORES.items()) + " FROM documents)")
    field = lambda d: f"coalesce(try_cast(json_extract_string(body, '$.{d}') AS INTEGER), 4)"
    o["parse_judge_json"] = f"""
SELECT doc_id, ok AS parsed, {', '.join(ad.DIMENSIONS)},
  coalesce(overall, (groundedness + correctness + empathy + actionability + brand_tone) / 5.0::DOUBLE) AS overall_score, reasoning
FROM (SELECT doc_id, ok, {', '.join(f'{field(d)} AS {d}' for d in ad.DIMENSIONS)},
        try_cast(json_extract_string(body, '$.overall_score') AS DOUBLE) AS overall,
        coalesce(json_extract_string(body, '$.reasoning'), {q(DEFAULT_REASONING)}) AS reasoning
      FROM (SELECT doc_id, json_valid(b) AS ok, CASE WHEN json_valid(b) THEN b ELSE '{{}}' END AS body
            FROM (SELECT doc_id, {strip("replace(replace(raw, '```json', ''), '```', '')")} AS b
                  FROM (SELECT doc_id, {JUDGE_JSON} AS raw FROM documents))))"""

    # labels and annotations
    key = lambda c: f"replace(replace(lower({strip(c)}), ' ', '_'), '-', '_')"
    w("normalize_intent", ANNOTATED, f"SELECT row_id, CASE WHEN {key('primary_intent')} IN {in_list(PR.INTENTS)} THEN {key('primary_intent')} END AS intent FROM annotations")
    c = f"lower({strip('confidence')})"
    w("normalize_confidence", ANNOTATED,
      f"SELECT row_id, CASE WHEN {c} IN ('high', 'h') THEN 'high' WHEN {c} IN ('medium', 'm', 'med') THEN 'medium' WHEN {c} IN ('low', 'l') THEN 'low' END AS confidence FROM annotations")
    r = key("escalation_reason")
    w("normalize_reason", ANNOTATED,
      f"SELECT row_id, CASE WHEN {r} IN ('', 'n/a', 'na') THEN 'none' WHEN {r} IN {in_list(PR.ESCALATION_REASONS)} THEN {r} END AS reason FROM annotations")
    o["truncate_text"] = (
        "SELECT doc_id, CASE WHEN length(text) <= 120 THEN text ELSE substr(text, 1, 117) || '...' END AS short, "
        "format('{:,}', n_chars) AS n_chars_text FROM documents")
    w("annotation_errors", RECORD_ERRORS, "SELECT row_id, unnest(errors) AS error FROM errs")
    w("duplicate_annotations", ANNOTATED,
      "SELECT conversation_id, count(*) AS records, min(row_id) AS first_row FROM annotations GROUP BY 1 HAVING count(*) > 1")
    w("annotation_validation", f"""{RECORD_ERRORS}, t AS (
  SELECT count(*) AS total_records, count(*) FILTER (len(errors) = 0) AS valid_records, count(*) FILTER (len(errors) > 0) AS invalid_records,
         sum(len(errors))::BIGINT AS record_errors, count(*) FILTER ({blank('conversation_id')}) AS e, count(*) FILTER (confidence = 'low') AS l,
         (SELECT count(*) FROM (SELECT conversation_id FROM annotations GROUP BY 1 HAVING count(*) > 1)) AS duplicate_ids FROM errs)""",
      "SELECT record_errors = 0 AND duplicate_ids = 0 AS is_valid, total_records, valid_records, invalid_records, record_errors, duplicate_ids, "
      "concat_ws('; ', CASE WHEN e > 0 THEN e || ' records have empty conversation_id' END, "
      "CASE WHEN l > 0 THEN l || ' records have low confidence — consider review' END, "
      "CASE WHEN valid_records < 150 THEN 'Only ' || valid_records || ' valid records. Target is 150-250 for the golden dataset.' END) AS warnings, "
      "NULL::VARCHAR AS error, (SELECT coalesce(string_agg(x, ', ' ORDER BY x), '') FROM (SELECT primary_intent || '=' || count(*) AS x "
      "FROM annotations WHERE primary_intent IS NOT NULL GROUP BY primary_intent)) AS intents FROM t")
    w("intent_distribution", ANNOTATED,
      f"SELECT primary_intent, count(*) AS count, {pct('count(*)', '(SELECT count(*) FROM annotations)')} AS pct FROM annotations WHERE primary_intent IS NOT NULL GROUP BY 1")
    w("golden_export", GOLDEN,
      "SELECT conversation_id, primary_intent, escalation, escalation_reason, confidence, annotator_notes, annotated_at FROM golden ORDER BY 1")
    w("annotation_queue", f"{ad.MESSAGES_SQL}, {ANNOTATED}",
      "SELECT conversation_id, count(*) AS messages FROM messages WHERE conversation_id NOT IN (SELECT conversation_id FROM annotations WHERE conversation_id IS NOT NULL) GROUP BY 1")
    kept = "conversation_id, primary_intent, escalation, escalation_reason, confidence, annotator_notes, annotated_at".split(", ")
    as_text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in kept)
    w("annotation_log", ANNOTATED, f"SELECT {as_text}, 0::BIGINT AS first_row, (SELECT count(*) FROM annotations) AS after_last FROM annotations")
    w("golden_file", GOLDEN, f"SELECT {as_text}, row_number() OVER (ORDER BY conversation_id) - 1 AS row_id FROM golden")
    w("golden_with_text", f"{CONVERSATIONS}, {GOLDEN}",
      "SELECT conversation_id, primary_intent, opening_message AS text FROM golden JOIN conv USING (conversation_id)")

    # evaluation
    pred = ad.PREDICTIONS_SQL
    im = intent_metrics("", "predictions", "true_intent", "agent_intent")
    w("intent_metrics", f"{pred}, {im}", f"SELECT {METRIC_COLUMNS} FROM pc")
    w("per_class_metrics", f"{pred}, {im}",
      "SELECT label, support, predicted, hits, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM pc")
    w("confusion_matrix", f"{pred}, labs AS (SELECT true_intent AS l FROM predictions UNION SELECT agent_intent FROM predictions)",
      "SELECT a.l AS true_label, b.l AS pred_label, (SELECT count(*) FROM predictions WHERE true_intent = a.l AND agent_intent = b.l) AS count FROM labs a, labs b")
    t = ESC_TRUE.format("true_escalation")
    w("escalation_metrics", pred, escalation_columns(t, ESC_TRUE.format("agent_escalation")).format(by="", source="predictions", group=""))
    systems = [("baseline_1_trivial", "b1"), ("baseline_2_simple", "b2"), ("ai_agent_final", "agent")]
    long = "lp AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT '{n}' AS system, true_intent, true_escalation, {p}_intent AS pi, {p}_escalation AS pe FROM predictions" for n, p in systems) + ")"
    esc = escalation_columns(t, ESC_TRUE.format("pe")).format(by="system, ", source="lp", group="GROUP BY system")
    w("system_comparison", f"{pred}, {long}, {intent_metrics('system', 'lp', 'true_intent', 'pi')}, im AS (SELECT system, {METRIC_COLUMNS} FROM pc GROUP BY system), em AS ({esc})",
      "SELECT system, im.accuracy AS intent_accuracy, f1_macro AS intent_f1_macro, em.accuracy AS escalation_accuracy, f1 AS escalation_f1, "
      "false_positive_rate, false_negative_rate FROM im JOIN em USING (system)")
    w("agreement_by_dimension", RATED_LONG,
      "SELECT dimension, round(avg(h), 2) AS human_mean, round(avg(j), 2) AS judge_mean, round(count(*) FILTER (h = j) * 100.0::DOUBLE / count(*), 2) AS exact_match_pct, "
      "round(count(*) FILTER (abs(h - j) <= 1) * 100.0::DOUBLE / count(*), 2) AS within_1_pct, round(avg(abs(j - h)), 4) AS mae, round(avg(j - h), 4) AS mean_score_difference "
      "FROM dims GROUP BY 1")
    w("cohen_kappa", f"""{RATED_LONG},
labs AS (SELECT dimension, l, dense_rank() OVER (PARTITION BY dimension ORDER BY l) AS r FROM (SELECT dimension, h AS l FROM dims UNION SELECT dimension, j FROM dims)),
rk AS MATERIALIZED (SELECT d.dimension, a.r AS h, b.r AS j FROM dims d JOIN labs a ON a.dimension = d.dimension AND a.l = d.h JOIN labs b ON b.dimension = d.dimension AND b.l = d.j),
obs AS (SELECT dimension, count(*) AS n, sum(CASE WHEN h <> j THEN 1 ELSE 0 END)::DOUBLE AS o1, sum((h - j) * (h - j))::DOUBLE AS o2 FROM rk GROUP BY 1),
mh AS (SELECT dimension, h, count(*) AS n FROM rk GROUP BY ALL), mj AS (SELECT dimension, j, count(*) AS n FROM rk GROUP BY ALL),
ex AS (SELECT dimension, sum(CASE WHEN h <> j THEN mh.n * mj.n ELSE 0 END)::DOUBLE AS e1, sum((h - j) * (h - j) * mh.n * mj.n)::DOUBLE AS e2 FROM mh JOIN mj USING (dimension) GROUP BY 1)""",
      "SELECT dimension, coalesce(round(1 - o1 * n / nullif(e1, 0), 4), 'nan'::DOUBLE) AS cohen_kappa_unweighted, coalesce(round(1 - o2 * n / nullif(e2, 0), 4), 'nan'::DOUBLE) AS cohen_kappa_quadratic FROM obs JOIN ex USING (dimension)")
    w("agreement_overall", RATED,
      "SELECT count(*) AS sample_count, round(avg(human_overall), 2) AS human_overall_mean, round(avg(overall_score), 2) AS judge_overall_mean, "
      "round(avg(abs(round(overall_score - human_overall, 9))), 4) AS overall_mae, round(avg(round(overall_score - human_overall, 9)), 4) AS overall_mean_difference, "
      "round(count(*) FILTER (round_even(human_overall, 0) = round_even(overall_score, 0)) * 100.0::DOUBLE / count(*), 2) AS overall_exact_match_pct, "
      "round(count(*) FILTER (abs(round(overall_score - human_overall, 9)) <= 1) * 100.0::DOUBLE / count(*), 2) AS overall_within_1_pct FROM rated")
    w("agreement_matrix", RATED,
      "SELECT h.x AS human, j.x AS judge, (SELECT count(*) FROM rated WHERE round_even(human_overall, 0) = h.x AND round_even(overall_score, 0) = j.x) AS count "
      "FROM range(1, 6) h(x), range(1, 6) j(x)")
    hist = "(SELECT count(*) FROM rated WHERE {c} >= 1 + b * 0.5::DOUBLE AND ({c} < 1.5 + b * 0.5::DOUBLE OR (b = 7 AND {c} = 5)))"
    w("score_histogram", RATED,
      " UNION ALL ".join(f"SELECT '{n}' AS rater, b AS bin, 1 + b * 0.5::DOUBLE AS low, {hist.format(c=col)} AS count FROM range(0, 8) t(b)"
                         for n, col in (("human", "human_overall"), ("judge", "overall_score"))))
    o["comparison_file"] = o["system_comparison"]
    o["overview_file"] = f"SELECT * FROM ({o['overview_counts']}) a CROSS JOIN (SELECT * FROM ({o['turn_structure']})) b"
    pe, te = ESC_TRUE.format("agent_escalation"), t
    w("failure_cases", f"""{pred},
e AS (SELECT 0 AS kind, * FROM predictions WHERE {te} <> {pe} ORDER BY conversation_id LIMIT 2),
i AS (SELECT 1 AS kind, * FROM predictions WHERE true_intent <> agent_intent ORDER BY conversation_id LIMIT 4)""",
      f"""SELECT category, conversation_id, customer_text, predicted_output, expected_output FROM (
SELECT kind, 'Escalation Policy Misclassification' AS category, conversation_id, customer_text, 'Intent: `' || agent_intent || '`, Escalation: `' || agent_escalation || '`' AS predicted_output,
       'Intent: `' || true_intent || '`, Escalation: `' || CASE WHEN {te} THEN 'ESCALATE' ELSE 'AUTO_HANDLE' END || '`' AS expected_output FROM e
UNION ALL SELECT kind, 'Intent Taxonomy Overlap / Disambiguation', conversation_id, customer_text, 'Intent: `' || agent_intent || '`', 'Intent: `' || true_intent || '`' FROM i
ORDER BY kind, conversation_id LIMIT 4)""")
    return o
