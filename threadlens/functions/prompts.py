"""Prompt texts assembled from columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Prompt layouts and the scoring rubric.
# ---------------------------------------------------------------------------

REPLY_PROMPT = """Brand: %s (%s)
Predicted Intent: %s

Incoming Customer Message:
"%s"

Retrieved Historical Resolution Evidence:
%s

Draft a helpful, concise, and empathetic support reply to the customer:"""

REPLY_EVIDENCE = 'Example %d (Similarity: %.2f):\n  Customer: "%s"\n  Brand Reply: "%s"'

NO_REPLY_EVIDENCE = "No specific historical resolution evidence retrieved."

JUDGE_PROMPT = """%s

Context & Data to Evaluate:

Customer Message:
"%s"

Predicted Intent: %s

Retrieved Historical Evidence:
%s

Reference Brand Reply (Ground Truth):
"%s"

AI-Generated Reply (Target under Evaluation):
"%s"

Evaluate the AI-Generated Reply against the criteria and output valid JSON:"""

JUDGE_EVIDENCE = '- Ex %d: Customer: "%s" | Brand: "%s"'

NO_JUDGE_EVIDENCE = "No explicit historical evidence retrieved."

RUBRIC_TITLE = "Rubric Scoring Criteria (Scale 1 to 5):"

RUBRIC = [
    (
        "Groundedness",
        "Assesses whether the response relies strictly on retrieved historical evidence without hallucinating unverified policies.",
        [
            ("Severe Hallucination", "Contains fabricated policies or promises unsupported by evidence."),
            ("Minor Hallucination", "Mostly grounded but includes speculative or unverified policy claims."),
            ("Partially Grounded", "Supported by general support principles but lacks explicit evidence backing."),
            ("Well Grounded", "Accurately reflects retrieved historical resolution patterns."),
            ("Fully Grounded", "Strictly anchored in retrieved evidence with zero speculative statements."),
        ],
    ),
    (
        "Correctness",
        "Evaluates whether the response correctly addresses the customer's specific intent and core problem.",
        [
            ("Incorrect", "Completely misunderstands the intent or gives wrong instructions."),
            ("Mostly Incorrect", "Addresses a secondary topic while missing the core customer problem."),
            ("Partially Correct", "Addresses the intent generally but misses specific details."),
            ("Correct", "Accurately addresses the customer's intent and provides proper guidance."),
            ("Perfectly Correct", "Flawlessly identifies and resolves the customer's specific query."),
        ],
    ),
    (
        "Empathy",
        "Measures politeness, tone, and appropriate expression of concern for customer frustration.",
        [
            ("Rude / Hostile", "Dismissive, aggressive, or completely mechanical and cold."),
            ("Cold / Robotic", "Lacks greeting or basic courtesy phrases; feels transactional."),
            ("Neutral", "Standard polite greeting without explicit empathy for frustration."),
            ("Empathetic", "Expresses clear apology/understanding for customer inconvenience."),
            ("Highly Empathetic", "Exemplary warm, supportive, and reassuring customer support tone."),
        ],
    ),
    (
        "Actionability",
        "Checks if the response provides clear, unambiguous next steps (e.g. requesting DM with order details).",
        [
            ("Unactionable", "Provides no next steps or leaves customer stranded."),
            ("Vague", "Tells customer to get help without specifying how or where."),
            ("Basic Action", "Provides general guidance (e.g., 'check website')."),
            ("Clear Action", "Directs customer to send a DM with specific needed details (order ID, email)."),
            ("Highly Actionable", "Provides immediate, step-by-step resolution instructions."),
        ],
    ),
    (
        "Brand Tone Consistency",
        "Assesses alignment with official {handle} social media voice and character limit constraints.",
        [
            ("Off-Brand", "Unprofessional language, inappropriate formatting, or overly verbose."),
            ("Inconsistent", "Deviates from social support conventions; includes markdown formatting."),
            ("Acceptable", "Meets basic brand tone expectations."),
            ("On-Brand", "Matches {handle} Twitter support voice well; concise and professional."),
            ("Flawless Brand Tone", "Indistinguishable from official {handle} social support responses."),
        ],
    ),
]

# ---------------------------------------------------------------------------


def rubric_text(handle: str) -> str:
    """The scoring rubric as prompt text, for one brand handle."""
    blocks = [RUBRIC_TITLE]
    for name, description, levels in RUBRIC:
        blocks.append(f"\n[{name}] - {description}")
        blocks.extend(f"  Score {i}: {label} — {text}" for i, (label, text) in enumerate(levels, 1))
    return "\n".join(blocks).replace("{handle}", handle)


def _lines(evidence: Column, line, when_empty: str) -> Column:
    rendered = F.array_join(F.transform(evidence, line), "\n")
    return F.when(F.coalesce(F.size(evidence), F.lit(0)) > 0, rendered).otherwise(F.lit(when_empty))


def reply_prompt(
    message: Column, intent: Column, evidence: Column, brand: str, handle: str
) -> Column:
    """Prompt for drafting a reply from a message and its evidence array."""
    lines = _lines(
        evidence,
        lambda e, i: F.format_string(
            REPLY_EVIDENCE, i + 1, e["score"], e["customer_text"], e["brand_reply"]
        ),
        NO_REPLY_EVIDENCE,
    )
    return F.format_string(REPLY_PROMPT, F.lit(handle), F.lit(brand), intent, message, lines)


def judge_prompt(
    message: Column, intent: Column, evidence: Column, reference: Column, reply: Column, handle: str
) -> Column:
    """Prompt for scoring a reply against the rubric."""
    lines = _lines(
        evidence,
        lambda e, i: F.format_string(JUDGE_EVIDENCE, i + 1, e["customer_text"], e["brand_reply"]),
        NO_JUDGE_EVIDENCE,
    )
    known = F.when(F.coalesce(reference, F.lit("")) == "", F.lit("N/A")).otherwise(reference)
    return F.format_string(
        JUDGE_PROMPT, F.lit(rubric_text(handle)), message, intent, lines, known, reply
    )
