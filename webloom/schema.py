"""Names, limits and outcomes shared by all steps."""

# Limits of the index contract.
MAX_RECORD_BYTES = 1024 * 1024
MIN_MAIN_TEXT_BYTES = 5
MIN_PARAGRAPH_CHARS = 50
TITLE_CHARS = 90
META_CHARS = 400
ANCHOR_CHARS = 400
HEADING_LEVELS = 3
TRUNCATE_WORD_SHARE = 0.6
PLAIN_ENCODING = "plain"
RESPONSE_TYPE = "response"
UNKNOWN_LANG = "unknown"
ALWAYS_KEPT_LANG = "en"

# Header names, matched without regard to case.
WARC_TYPE = "warc-type"
WARC_RECORD_ID = "warc-record-id"
WARC_TREC_ID = "warc-trec-id"
WARC_TARGET_URI = "warc-target-uri"
HTTP_CONTENT_TYPE = "content-type"
HTTP_DATE = "date"

# Outcome of one input record; the first rule that applies wins.
TOO_LARGE = "TOO_LARGE"
JSON_PARSE_ERROR = "JSON_PARSE_ERROR"
BINARY = "BINARY"
NO_RESPONSE_RECORD = "NO_RESPONSE_RECORD"
NO_ID = "NO_ID"
TOO_SMALL = "TOO_SMALL"
RECORD = "RECORD"

# Counter names of the job report, with the outcome each one counts.
STATUS_COUNTERS = {
    "SKIPPED_RECORDS_TOO_LARGE": TOO_LARGE,
    "SKIPPED_RECORDS_JSON_PARSE_ERROR": JSON_PARSE_ERROR,
    "SKIPPED_RECORDS_BINARY": BINARY,
    "SKIPPED_RECORDS_NO_RESPONSE_RECORD": NO_RESPONSE_RECORD,
    "SKIPPED_RECORDS_NO_ID": NO_ID,
    "SKIPPED_RECORDS_TOO_SMALL": TOO_SMALL,
    "RECORDS": RECORD,
}
TOTAL_RECORDS = "TOTAL_RECORDS"
HTML_PARSE_ERRORS = "SKIPPED_RECORDS_HTML_PARSE_ERROR"
LANGDETECT_FAILED = "LANGDETECT_FAILED"
GENERATED_DOCS = "GENERATED_DOCS"
NO_CONTENT = "NO_CONTENT"

# Columns of one extracted page, before the side inputs are joined.
PAGE_COLUMNS = [
    "id",
    "uuid",
    "warc_trec_id",
    "warc_record_id",
    "warc_target_uri",
    "warc_target_hostname",
    "warc_target_path",
    "warc_target_query_string",
    "content_type",
    "date",
    "lang",
    "body_length",
    "body",
    "full_body",
    "headings",
    "title",
    "meta_desc",
    "meta_keywords",
]

RECORDS_DDL = "key STRING, value STRING"
LINES_DDL = "value STRING"
SPAM_DDL = "id STRING, spam_rank BIGINT"
PAGE_RANK_DDL = "id STRING, page_rank FLOAT"
