"""Schemas of the files that go in and out."""

PAGES = "page_id BIGINT, url STRING, html STRING"
CAPTURED = "page_id BIGINT, url STRING, content BINARY, content_type STRING"
OCCURRENCES = (
    "email STRING, local_part STRING, domain STRING, source_url STRING, source_type STRING, "
    "page_title STRING, context_snippet STRING, http_status STRING, found_at TIMESTAMP, "
    "parse_method STRING, notes STRING"
)
CLEAN_CONTACTS = (
    "email STRING, domain STRING, first_seen TIMESTAMP, sources STRING, verified STRING, "
    "status STRING, notes STRING, part BIGINT"
)
MESSAGES = (
    "message_id STRING, from_email STRING, subject STRING, body STRING, received_date TIMESTAMP"
)
OPENS = "tracking_id STRING, ts TIMESTAMP"
UNSUBSCRIBES = "token STRING, ts TIMESTAMP"
SEND_LOG = (
    "email STRING, sent_date TIMESTAMP, status STRING, tracking_id STRING, batch_number BIGINT"
)
MASTER = (
    "email STRING, name STRING, university STRING, sent_date TIMESTAMP, opened STRING, "
    "opened_date TIMESTAMP, opened_count BIGINT, replied STRING, reply_date TIMESTAMP, "
    "classification STRING, status STRING, demo_scheduled STRING, demo_date TIMESTAMP, "
    "customer STRING, tracking_id STRING, customer_date TIMESTAMP"
)
CRAWL_RULES = "base_domain STRING, crawl_delay DOUBLE"
ROUTED_COLUMNS = (
    "email", "name", "university", "subject", "body", "received_date", "classification",
)
