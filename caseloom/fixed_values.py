"""Fixed values.

Everything in this module is a value that has to be exactly what it is for the
results to be right: vocabularies, label spellings, keyword weights, marker
words, patterns and sentence templates. Nothing here is logic, and nothing here
touches Spark.
"""

from __future__ import annotations

# --- Fixed values: closed vocabularies ----------------------------------------

CATEGORIES = (
    "Billing",
    "Delivery",
    "Product Defect",
    "Service Quality",
    "Technical Issue",
    "Account Access",
    "Refund",
    "Warranty",
    "General Enquiry",
    "Other",
)
CASE_STATUSES = (
    "Resolved",
    "In Progress",
    "Pending Customer",
    "Escalated",
    "Open",
    "Closed",
)
PRIORITIES = ("Low", "Medium", "High", "Critical")
SENTIMENTS = ("Positive", "Neutral", "Negative", "Very Negative")

# --- Fixed values: ingestion --------------------------------------------------

SUPPORTED_EXTENSIONS = (".docx", ".md", ".pdf", ".txt")
IGNORED_NAME_PREFIXES = (".", "~$")
EMPTY_DOCUMENT_SUFFIX = (
    " contains no extractable text (a scanned or image-only file would need OCR)"
)

# --- Fixed values: text that stands for "no value" ----------------------------

NULL_PLACEHOLDERS = (
    "",
    "-",
    "--",
    "n/a",
    "na",
    "none",
    "null",
    "nil",
    "unknown",
    "not provided",
    "not available",
    "not specified",
    "not mentioned",
    "not applicable",
    "no email provided",
    "no phone provided",
)
# Whole-value pattern of a form answer that says "nothing here"; {ws} is the
# whitespace class of the regex dialect in use.
NOTHING_HERE_PATTERN = (
    r"(?i)^\(?[{ws}]*(none|none\.|none recorded|none provided|not provided|n/?a|nil|-+)"
    r"[{ws}]*\)?\.?$"
)

# --- Fixed values: form labels ------------------------------------------------

SECTION_LABELS = {
    "description": (
        "complaint description",
        "enquiry description",
        "issue description",
        "description",
    ),
    "issue_details": ("issue details", "details"),
    "resolution": ("resolution provided", "resolution", "action taken"),
    "escalation": ("escalation", "escalation information"),
    "supporting": ("supporting information", "supporting documents", "attachments"),
}
FIELD_LABELS = {
    "name": ("customer name", "name", "raised by", "customer"),
    "email": ("email", "email address", "e-mail"),
    "phone": ("phone", "phone number", "contact number", "mobile"),
    "product": ("product / service", "product/service", "product", "service", "item"),
    "reference": ("reference", "ref", "case id", "ticket"),
}

# --- Fixed values: category keywords (category, keyword, weight) --------------

CATEGORY_KEYWORDS = (
    ("Billing", "billed twice", 3),
    ("Billing", "duplicate charge", 3),
    ("Billing", "duplicate debit", 3),
    ("Billing", "overcharge", 3),
    ("Billing", "billing", 2),
    ("Billing", "invoice", 1),
    ("Billing", "charged", 1),
    ("Billing", "charges", 1),
    ("Billing", "payment", 1),
    ("Billing", "auto-payment", 2),
    ("Delivery", "delivery", 3),
    ("Delivery", "delivered", 2),
    ("Delivery", "dispatch", 2),
    ("Delivery", "courier", 3),
    ("Delivery", "shipment", 3),
    ("Delivery", "consignment", 3),
    ("Delivery", "tracking", 2),
    ("Delivery", "parcel", 2),
    ("Delivery", "sorting hub", 2),
    ("Product Defect", "manufacturing defect", 3),
    ("Product Defect", "defect", 3),
    ("Product Defect", "stopped working", 3),
    ("Product Defect", "burning smell", 3),
    ("Product Defect", "faulty", 3),
    ("Product Defect", "malfunction", 3),
    ("Product Defect", "broken", 2),
    ("Product Defect", "damaged", 2),
    ("Product Defect", "not working", 2),
    ("Product Defect", "failed", 1),
    ("Warranty", "under warranty", 2),
    ("Warranty", "warranty", 1),
    ("Warranty", "guarantee", 1),
    ("Refund", "refund", 3),
    ("Refund", "money back", 3),
    ("Refund", "reimburse", 3),
    ("Refund", "chargeback", 3),
    ("Refund", "cancelled my", 2),
    ("Refund", "cooling off", 2),
    ("Account Access", "cannot log in", 3),
    ("Account Access", "log in", 2),
    ("Account Access", "login", 3),
    ("Account Access", "sign in", 2),
    ("Account Access", "password", 3),
    ("Account Access", "access denied", 3),
    ("Account Access", "account locked", 3),
    ("Account Access", "otp", 2),
    ("Account Access", "locked", 1),
    ("Technical Issue", "crash", 3),
    ("Technical Issue", "crashed", 3),
    ("Technical Issue", "blank screen", 3),
    ("Technical Issue", "regression", 2),
    ("Technical Issue", "bug", 2),
    ("Technical Issue", "error", 2),
    ("Technical Issue", "app", 1),
    ("Technical Issue", "reinstall", 2),
    ("Technical Issue", "timeout", 2),
    ("Technical Issue", "server", 1),
    ("Technical Issue", "connectivity", 2),
    ("Service Quality", "dismissive", 3),
    ("Service Quality", "rude", 3),
    ("Service Quality", "unprofessional", 3),
    ("Service Quality", "communication was", 2),
    ("Service Quality", "call centre", 2),
    ("Service Quality", "staff", 2),
    ("Service Quality", "outside the agreed slot", 3),
    ("Service Quality", "without calling", 2),
    ("Service Quality", "waiting", 1),
)

# --- Fixed values: marker words of the decision tables ------------------------

ENQUIRY_MARKERS = (
    "not a complaint",
    "enquiry description",
    "customer enquiry",
    "clarification before",
    "pre-sales",
)
ESCALATION_DENIED = (
    "not required",
    "not requested",
    "not yet escalated",
    "not escalated",
    "none",
    "no escalation",
    "now closed",
    "handled by",
    "resolved at first line",
)
ESCALATION_ASKED = (
    "escalat",
    "supervisor",
    "manager",
    "consumer forum",
    "consumer court",
    "legal",
    "callback",
    "call back",
)
ESCALATION_IN_DESCRIPTION = (
    "escalated immediately",
    "want this escalated",
    "raise this to a manager",
    "third time",
    "no response",
    "unacceptable",
    "consumer forum",
)
WORK_PENDING = (
    "being processed",
    "under review",
    "in progress",
    "investigating",
    "has been asked",
    "awaiting",
    "scheduled for",
    "prioritise",
    "prioritize",
)
CASE_CLOSED = ("now closed", "case is closed")
WORK_DONE = (
    "refund",
    "replaced",
    "resolved",
    "closed",
    "completed",
    "settled",
    "credited",
    "apolog",
    "confirmed",
    "credit of",
    "goodwill",
)
EVIDENCE_WORDS = (
    "attach",
    "enclosed",
    "screenshot",
    "invoice",
    "receipt",
    "photo",
    "log file",
    "recording",
    "statement",
    "report",
    "evidence",
    "copy",
)
EVIDENCE_IN_DESCRIPTION = ("attach", "enclosed")
STRONGLY_NEGATIVE = (
    "extremely frustrated",
    "completely unacceptable",
    "worst",
    "furious",
)
NEGATIVE = (
    "frustrat",
    "disappoint",
    "angry",
    "unacceptable",
    "worst",
    "terrible",
    "furious",
    "very poor",
    "dismissive",
    "costing me money",
)
POSITIVE = (
    "thank",
    "appreciate",
    "happy",
    "satisfied",
    "pleased",
    "not a complaint",
)

# --- Fixed values: issue text and notes ---------------------------------------

ISSUE_MIN_CHARS = 25
PROSE_MIN_CHARS = 40
PROSE_LABEL_WINDOW = 20
NO_ISSUE_TEXT = "No issue description could be identified."

NOTE_ORIGIN = "Generated by the offline rule-based provider."
NOTE_MISSING = ("Document does not state: ", ".")
NOTE_FIELD_NAMES = (("name", "customer name"), ("email", "email"), ("phone", "phone number"))
NOTE_NO_RESOLUTION = "No resolution recorded yet."

# --- Fixed values: customer email ---------------------------------------------
# Templates in this module are tuples of text and {column} slots in order.

DEFAULT_CUSTOMER = "Customer"
EMAIL_SUBJECT = ("Your ", "{category_lower}", " case — ", "{status}")
EMAIL_GREETING = ("Dear ", "{display_name}", ",")
EMAIL_OPENING_COMPLAINT = (
    "Thank you for contacting us about ",
    "{topic}",
    ". I am sorry for the inconvenience this has caused, and I appreciate you "
    "taking the time to bring it to our attention.",
)
EMAIL_OPENING_ENQUIRY = (
    "Thank you for getting in touch about ",
    "{topic}",
    ". I am happy to clarify this for you.",
)
EMAIL_RESTATEMENT = ("So that we are clear on what you reported: “", "{issue}", "”")
EMAIL_DONE_SO_FAR = ("Here is what has been done so far. ", "{resolution}")
EMAIL_STILL_OPEN = (
    "Your case is currently open with our support team and no resolution has been "
    "recorded yet. We are working on it and will update you as soon as there is progress."
)
EMAIL_ESCALATED = (
    "Given the circumstances, your case has been escalated to a senior support "
    "specialist, who will follow up with you directly."
)
EMAIL_STATUS = (
    "The current status of your case is: ",
    "{status}",
    ". If anything above is not correct, or you have further questions, please reply "
    "to this email and we will pick it up straight away.",
)
EMAIL_CLOSING = "Kind regards,"
EMAIL_SENDER = "Customer Support Team"

# --- Fixed values: case summary -----------------------------------------------

SUMMARY_DEFAULT_SUBJECT = "the reported item"
SUMMARY_OVERVIEW = (
    "{category}", " ", "{kind}", " raised by ", "{display_name}", " regarding ", "{subject}", ".",
)
SUMMARY_NO_ACTION = "No action recorded."
SUMMARY_STATUS = (
    "{status}", ". Priority ", "{priority}", "; customer sentiment ", "{sentiment_lower}", ".",
)
NEXT_ACTION_ESCALATED = (
    "Assign to a senior specialist and make contact with the customer within 24 hours."
)
NEXT_ACTION_DONE = "Confirm the customer is satisfied, then close the case."
NEXT_ACTION_NO_RESOLUTION = (
    "Investigate the reported issue and send the customer an initial response with an "
    "expected timeline."
)
NEXT_ACTION_CHASE = (
    "Chase the owning team for completion and update the customer on progress."
)
SUMMARY_TITLES = (
    ("case_overview", "Case Overview"),
    ("key_issue", "Key Issue"),
    ("action_taken", "Action Taken"),
    ("current_status", "Current Status"),
    ("recommended_next_action", "Recommended Next Action"),
)

# --- Fixed values: user prompts of the three tasks ----------------------------

PROMPT_EXTRACTION = (
    "Extract the structured case record from the customer complaint document below.\n\n"
    "Source file: ",
    "{source_file}",
    "\n\n<document>\n",
    "{text}",
    "\n</document>",
)
PROMPT_EMAIL = (
    "Write the customer response email for the case below.\n\nSource file: ",
    "{source_file}",
    "\n\nThe validated case record (this is your source of truth):\n<extracted_data>\n",
    "{extracted_json}",
    "\n</extracted_data>\n\nThe original document, for tone and additional detail only:\n"
    "<document>\n",
    "{text}",
    "\n</document>",
)
PROMPT_SUMMARY = (
    "Write the internal management case summary for the case below.\n\nSource file: ",
    "{source_file}",
    "\n\nThe validated case record (this is your source of truth):\n<extracted_data>\n",
    "{extracted_json}",
    "\n</extracted_data>\n\nThe original document, for additional detail only:\n<document>\n",
    "{text}",
    "\n</document>",
)

# --- Fixed values: usage estimate of the rule provider ------------------------

CHARS_PER_TOKEN = 4
COMPLETION_TOKENS_PER_CALL = 200

# --- Fixed values: report -----------------------------------------------------

REPORT_COLUMNS = (
    "case_id",
    "source_file",
    "file_type",
    "processing_status",
    "customer_name",
    "email",
    "phone_number",
    "product_or_service",
    "complaint_category",
    "is_complaint",
    "escalation_required",
    "supporting_document_available",
    "overall_case_status",
    "priority",
    "customer_sentiment",
    "resolution_provided",
    "issue_description",
    "recommended_next_action",
    "email_generated",
    "summary_generated",
    "processing_seconds",
    "errors",
)
