"""Constants of the comment-sentiment domain."""

# ---------------------------------------------------------------- fixed values
# Everything in this block is a value the results depend on. Change it and the
# numbers change.
SEED = 42
LABELS = ["Positive", "Negative", "Neutral"]  # order breaks ties

SHORT_CHARS = 10
SHORT_WORDS = 3
IMBALANCE_RATIO = 3.0

TEXT_ALIASES = ["comment", "text", "comment_text", "body", "content"]
LABEL_ALIASES = ["label", "sentiment", "sentiment_label", "class"]
UNLABELLED_ALIASES = ["comment", "commenttext", "comment_text", "text", "body", "content"]
JSON_TEXT_PATHS = [
    "attributes.comment",
    "attributes.commentText",
    "comment",
    "commentText",
    "comment_text",
    "text",
    "body",
    "content",
]
DATE_COLUMNS = [
    "date",
    "posted_date",
    "postedDate",
    "received_date",
    "receivedDate",
    "comment_date",
    "submission_date",
    "created_at",
    "attributes.postedDate",
]

SAVE_EVERY = 5
MAX_RETRIES = 3
OVERLAP_HOURS = 6

TRAIN_SHARE, VALIDATION_SHARE, TEST_SHARE = 0.70, 0.15, 0.15
FALLBACK_TEST_SHARE = 0.20
MIN_ROWS_THREE_WAY = 150
MIN_CLASS_THREE_WAY = 10
MIN_ROWS_TO_TRAIN = 30

MIN_DF, MAX_DF, MAX_FEATURES = 2, 0.95, 20_000
NGRAM_MAX = 2
GRID = {"ngram_max": [1, 2], "min_df": [1, 2], "max_df": [0.9, 0.95], "C": [0.5, 1.0, 5.0]}
MODEL_TITLES = {
    "tfidf_logreg_tuned": "TF-IDF + Logistic Regression (tuned)",
    "tfidf_logreg": "TF-IDF + Logistic Regression",
    "tfidf_linear_svm": "TF-IDF + Linear SVM",
    "tfidf_multinomial_nb": "TF-IDF + Multinomial Naive Bayes",
}

HISTORY_MESSAGES = 6
TOP_WORDS = 40
MIN_WORD_DOCS = 3
SAMPLE_TEXTS, SAMPLE_CHARS = 5, 200
REVIEW_ROWS = 50

EMPTY_MARKERS = ["nan", "none", "null", "n/a", "na"]
MEANINGLESS_CHARS = ".-_=+*#~^`'\"|\\/,;:!?()[]{}<>"
ATTACHMENT_KEYWORDS = ["attached", "attachment", "pdf", "letter", "docx", "submit", "behalf of"]
PLACEHOLDER_MAX_WORDS = 15
PLACEHOLDER_PATTERN = r"^(please\s+)?(see|find)\s+attach(ed|ment)\b.{0,60}$"
BR_TAG_PATTERN = r"<br\s*/?>"
TAG_PATTERN = r"<[^>]+>"
THINK_PATTERN = r"<think>.*?</think>"

# Strings a CSV reader of the pandas family turns into missing values.
CSV_NULLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# English stop words (the usual word-cloud list) and the domain's own additions.
STOP_WORDS = """
a about above after again against all also am an and any are aren't as at be because been before
being below between both but by can can't cannot com could couldn't did didn't do does doesn't
doing don't down during each else ever few for from further get had hadn't has hasn't have haven't
having he he'd he'll he's hence her here here's hers herself him himself his how how's however http
i i'd i'll i'm i've if in into is isn't it it's its itself just k let's like me more most mustn't my
myself no nor not of off on once only or other otherwise ought our ours ourselves out over own r
same shall shan't she she'd she'll she's should shouldn't since so some such than that that's the
their theirs them themselves then there there's therefore these they they'd they'll they're they've
this those through to too under until up very was wasn't we we'd we'll we're we've were weren't what
what's when when's where where's which while who who's whom why why's with won't would wouldn't www
you you'd you'll you're you've your yours yourself yourselves
""".split()
DOMAIN_STOP_WORDS = """
ftc commission comment comments rule regulation proposed regulations federal trade will would also
please one us government com https http
""".split()

PROMPT_TEMPLATE = (
    "REGULATORY CONTEXT:\n%s\n\n"
    "USER QUESTION:\n%s\n\n"
    "Answer using ONLY the context above where possible; if it's insufficient, say so explicitly."
)
CHAT_ROLES = {"user": "user", "assistant": "model"}

INSIGHT_MOST_COMMON = (
    "Of the %s analyzed comments, %s is the most frequently observed sentiment (%s%%)."
)
INSIGHT_SHARE = "%s sentiment was observed in %s%% of analyzed comments."
INSIGHT_CAVEAT = (
    "These are descriptive patterns observed in the analyzed comments only, "
    "not causal findings about public opinion at large."
)
INSIGHT_NOTHING = "No valid predictions available to summarize."
# ------------------------------------------------------------ end fixed values

ALL_STOP_WORDS = sorted(set(STOP_WORDS) | set(DOMAIN_STOP_WORDS))

# The characters Python's str.strip() and \s treat as white space.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)
# Control characters other than tab, line feed and carriage return.
CONTROL_CHARS = "".join(chr(c) for c in range(32) if c not in (9, 10, 13)) + "\x7f"
INVISIBLE_CHARS = "\ufeff\u200b"
