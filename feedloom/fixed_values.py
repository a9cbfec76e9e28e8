"""Fixed values.

Everything here must equal the behaviour being matched, so it is written out
plainly: word lists, labels, defaults, limits, messages and request texts.
"""

# Sentiment labels and the two keyword lexicons.
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"
LABELS = (POSITIVE, NEGATIVE, NEUTRAL)

POSITIVE_KEYWORDS = (
    "growth", "gain", "gains", "record", "surge", "boost",
    "profit", "profits", "positive", "success", "successful",
    "win", "wins", "improve", "improves", "improved",
    "recovery", "strong", "rise", "rises", "rising",
)
NEGATIVE_KEYWORDS = (
    "crash", "drop", "drops", "fall", "falls", "falling",
    "loss", "losses", "negative", "fail", "fails", "failed",
    "war", "crisis", "risk", "risks", "fear", "fears",
    "decline", "declines", "recession", "inflation", "cut", "cuts",
)

# Source configuration.
DEFAULT_SOURCE_TYPE = "generic-json"
DEFAULT_METHOD = "GET"
UNKNOWN_SOURCE = "Unknown"
API_KEY_PARAM = "apiKey"
NO_SOURCES_MESSAGE = "No enabled generic-json sources are configured"

# Per-source error messages (printf form; %1$s is the source name).
BAD_METHOD_MESSAGE = "Unsupported HTTP method for source %1$s: %2$s. Only GET is supported for now."
NO_MAPPING_MESSAGE = "Missing responseMapping for source %1$s"
NO_ARTICLES_PATH_MESSAGE = "Missing responseMapping.articlesPath for source %1$s"
BAD_JSON_MESSAGE = "Could not parse JSON response for source %1$s"
NOT_AN_ARRAY_MESSAGE = "Configured articlesPath for source %1$s did not resolve to a JSON array: %2$s"
FETCH_FAILED_MESSAGE = "HTTP fetch failed for source %1$s: %2$s"

# Fetch retries.
RETRYABLE_STATUS_CODES = (429, 500, 502, 503, 504)
# Error kinds that another attempt may cure: client, I/O, timeout and interrupt errors.
RETRYABLE_KINDS = (
    "HttpClientException",
    "ReadTimeoutException",
    "IOException",
    "ConnectException",
    "EOFException",
    "SocketException",
    "SocketTimeoutException",
    "UnknownHostException",
    "TimeoutException",
    "InterruptedException",
)
DEFAULT_MAX_RETRIES = 3

# Text and vector defaults.
EMPTY_ARTICLE_TEXT = "untitled news article"
DEFAULT_MAX_TEXT_CHARS = 3000
DEFAULT_DIMENSION = 384
SENTIMENT_MODEL = "gpt-4.1-mini"
EMBEDDING_MODEL = "text-embedding-3-small"

# Model request and reply texts.
SENTIMENT_SYSTEM_TEXT = "Classify news sentiment as positive, negative, or neutral. Return only JSON."
SENTIMENT_USER_TEXT = 'Return exactly this JSON shape: {"sentiment":"positive|negative|neutral"}\n\n'

# Own wording: what is wrong with an embedding reply.
EMBEDDING_STATUS_MESSAGE = "Embedding request failed with status %1$s: %2$s"
EMBEDDING_MISSING_MESSAGE = "Embedding reply is missing"
EMBEDDING_JSON_MESSAGE = "Could not read embedding reply"
EMBEDDING_EMPTY_MESSAGE = "Embedding reply did not contain any embedding data"
EMBEDDING_NUMBER_MESSAGE = "Embedding reply contained a non-numeric vector value"
EMBEDDING_DIM_MESSAGE = "Embedding dimension is %1$s but %2$s is expected"

# Search arguments.
DEFAULT_SIZE, MIN_SIZE, MAX_SIZE = 5, 1, 20
BAD_QUERY_MESSAGE = "Query parameter 'q' is required"
BAD_SIZE_MESSAGE = "Query parameter 'size' must be between 1 and 20"
BAD_MIN_SCORE_MESSAGE = "Query parameter 'minScore' must be greater than or equal to 0"

# Messages of the search page, which checks its own inputs.
PAGE_QUERY_MESSAGE = "Query is required."
PAGE_SIZE_MESSAGE = "Size must be a whole number between 1 and 20."
PAGE_MIN_SCORE_MESSAGE = "Min score must be empty or between 0 and 1."

# Texts shown for missing result fields.
NO_TITLE_TEXT = "Untitled article"
NO_SOURCE_TEXT = "Unknown source"
NO_TIMESTAMP_TEXT = "No timestamp"
NO_SCORE_TEXT = "Score n/a"

# Status words of run metrics and of run summaries.
METRICS_SUCCESS, METRICS_FAILED = "SUCCESS", "FAILED"
SUMMARY_OK, SUMMARY_FAILED, SUMMARY_PARTIAL = "ok", "failed", "partial"
