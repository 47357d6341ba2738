"""Built-in starter tables, used when a run has no data of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# Starter rows (text, intent), evaluation rows (text, intent,
# escalation) and evidence rows (id, customer text, brand reply).
# ---------------------------------------------------------------------------

TRAINING_ROWS = [
    ("Where is my package? Order #12345 hasn't arrived yet.", "order_status"),
    ("Can you give me tracking details for my order?", "order_status"),
    ("My delivery is expected today, what time will it arrive?", "order_status"),
    ("Check status of my order placed yesterday", "order_status"),
    ("Is my order still processing or shipped?", "order_status"),
    ("I want to cancel my order #9988", "order_modification"),
    ("Can I change the delivery address on my order?", "order_modification"),
    ("Please update the shipping address for order #4412", "order_modification"),
    ("I need to remove an item from my order", "order_modification"),
    ("Cancel order immediately please", "order_modification"),
    ("My package arrived but item is missing", "order_missing_wrong"),
    ("You sent me the wrong size shirt", "order_missing_wrong"),
    ("The box was delivered but only half of my order was inside", "order_missing_wrong"),
    ("Received blue shoes instead of red", "order_missing_wrong"),
    ("Item missing from multi-item shipment", "order_missing_wrong"),
    ("I want a full refund for this purchase", "refund_request"),
    ("How do I return a product and get my money back?", "refund_request"),
    ("Where is my refund? It's been 5 business days", "refund_request"),
    ("Please issue a refund to my credit card", "refund_request"),
    ("Requesting return label for order refund", "refund_request"),
    ("I was charged twice for order #5551", "billing_issue"),
    ("Why is my credit card bill higher than the checkout price?", "billing_issue"),
    ("Unauthorized charge on my account", "billing_issue"),
    ("Double payment billed for single order", "billing_issue"),
    ("Payment declined but money was deducted from bank", "billing_issue"),
    ("Driver left package in wrong apartment building", "delivery_problem"),
    ("Package marked delivered but not on my porch", "delivery_problem"),
    ("Package was severely damaged in transit", "delivery_problem"),
    ("Delivery failed and carrier left no notice", "delivery_problem"),
    ("Box crushed during delivery", "delivery_problem"),
    ("Do you offer express 1-day shipping?", "shipping_inquiry"),
    ("What are the international shipping rates to Canada?", "shipping_inquiry"),
    ("Is free shipping included with Prime?", "shipping_inquiry"),
    ("How much does standard shipping cost?", "shipping_inquiry"),
    ("Shipping timeframe for standard delivery", "shipping_inquiry"),
    ("I cannot log into my account, password reset link expired", "account_access"),
    ("My account has been locked due to security alert", "account_access"),
    ("Forgot password and 2FA code not working", "account_access"),
    ("Account hacked and unauthorized login detected", "account_access"),
    ("Unable to access my Amazon account", "account_access"),
    ("How do I cancel my Prime membership subscription?", "account_management"),
    ("I need to update my email address on my profile", "account_management"),
    ("Change primary phone number in account settings", "account_management"),
    ("How do I share Prime benefits with family?", "account_management"),
    ("Update notification preferences", "account_management"),
    ("The blender stopped working after two days", "product_issue"),
    ("Item arrived broken with cracked screen", "product_issue"),
    ("Defective electronics won't turn on", "product_issue"),
    ("Poor quality material, fell apart immediately", "product_issue"),
    ("Product is defective and not as described", "product_issue"),
    ("Amazon shopping app crashes every time I open cart", "technical_support"),
    ("Kindle device screen is frozen", "technical_support"),
    ("Website error when trying to checkout", "technical_support"),
    ("Alexa smart speaker not responding to voice", "technical_support"),
    ("Video stream keeps buffering on app", "technical_support"),
    ("What is your 30 day return policy for electronics?", "general_inquiry"),
    ("Thank you so much for the quick help!", "general_inquiry"),
    ("Great customer service support team", "general_inquiry"),
    ("How does gift card balance transfer work?", "general_inquiry"),
    ("General feedback regarding customer support", "general_inquiry"),
]

EVALUATION_ROWS = [
    ("Where is my order #1001? Tracking says in transit.", "order_status", False),
    ("Can you give me an update on my package delivery?", "order_status", False),
    ("When will my order arrive? Expected date passed.", "order_status", False),
    ("Please cancel my order #2002 before it ships.", "order_modification", False),
    ("I need to change my shipping address on order #2003.", "order_modification", False),
    ("Remove item 2 from my order #2004", "order_modification", False),
    ("My order arrived but one item is missing from the box.", "order_missing_wrong", False),
    ("You sent me the wrong color shoes in order #3001.", "order_missing_wrong", False),
    ("Package arrived empty, no contents inside.", "order_missing_wrong", True),
    ("I want a full refund for my return on order #4001.", "refund_request", True),
    ("Where is my refund for returned item #4002?", "refund_request", True),
    ("Requesting return label for refund", "refund_request", False),
    ("I was charged twice on my credit card for order #5001.", "billing_issue", True),
    ("Unauthorized charge of $49.99 on my account.", "billing_issue", True),
    ("Double billing deduction on my bank statement", "billing_issue", True),
    ("Package marked delivered but not on my porch.", "delivery_problem", True),
    ("Driver left package in wrong building rain.", "delivery_problem", True),
    ("Box was crushed and stolen from porch", "delivery_problem", True),
    ("Do you offer express 1-day shipping to NY?", "shipping_inquiry", False),
    ("What are the international shipping options?", "shipping_inquiry", False),
    ("Cannot log into my account password reset link expired.", "account_access", True),
    ("Account locked due to suspicious activity alert.", "account_access", True),
    ("Account hacked someone ordered without my permission", "account_access", True),
    ("How do I cancel my Prime membership subscription?", "account_management", False),
    ("Update my profile email and phone number", "account_management", False),
    ("The blender stopped working after two uses.", "product_issue", True),
    ("Item arrived with broken cracked glass screen.", "product_issue", True),
    ("Amazon app keeps crashing when opening cart.", "technical_support", False),
    ("Kindle device screen is completely frozen.", "technical_support", False),
    ("What is your 30 day return policy?", "general_inquiry", False),
]

EVALUATION_REPLY = "Please DM us your order ID so we can assist you."

EVIDENCE_ROWS = [
    (
        "conv_hist_001",
        "Where is my order? Order #10293 has not arrived yet.",
        "Please DM us your order number and full name so we can trace your shipment details.",
    ),
    (
        "conv_hist_002",
        "I want to cancel order #4092 immediately.",
        "We can assist with cancellations if the item has not shipped yet. Please DM us your order details.",
    ),
    (
        "conv_hist_003",
        "My package was damaged upon delivery, box was crushed.",
        "We apologize for the damaged package. Please DM us your order ID so we can send a replacement.",
    ),
    (
        "conv_hist_004",
        "I was charged twice for my order on my credit card.",
        "We apologize for the billing error. Please reach out via DM with your order number and transaction details so we can investigate and process a refund.",
    ),
    (
        "conv_hist_005",
        "I can't log into my account, password reset isn't working.",
        "For security reasons regarding account access, please visit our online account recovery help center.",
    ),
]

# ---------------------------------------------------------------------------


def training_rows(spark: SparkSession) -> DataFrame:
    rows = [(f"seed_{i:03d}", *row) for i, row in enumerate(TRAINING_ROWS)]
    return spark.createDataFrame(rows, "conversation_id string, text string, primary_intent string")


def evaluation_rows(spark: SparkSession) -> DataFrame:
    rows = [(f"eval_{i:03d}", *row, EVALUATION_REPLY) for i, row in enumerate(EVALUATION_ROWS)]
    schema = (
        "conversation_id string, customer_text string, primary_intent string, "
        "escalation boolean, brand_reply string"
    )
    return spark.createDataFrame(rows, schema)


def evidence_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        EVIDENCE_ROWS, "conversation_id string, customer_text string, brand_reply string"
    )
