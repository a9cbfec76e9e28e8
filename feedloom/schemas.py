"""Schemas of the tables that flow between operators."""

from pyspark.sql import types as T

STRING, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
INSTANT, BOOLEAN, DOUBLE = T.TimestampType(), T.BooleanType(), T.DoubleType()
TEXT_MAP = T.MapType(STRING, STRING)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


RESPONSE_MAPPING = _struct(
    articles_path=STRING, title=STRING, content=STRING, url=STRING, source=STRING, timestamp=STRING
)

SOURCE_CONFIG = _struct(
    name=STRING,
    enabled=BOOLEAN,
    type=STRING,
    url=STRING,
    method=STRING,
    headers=TEXT_MAP,
    params=TEXT_MAP,
    schedule=STRING,
    response_mapping=RESPONSE_MAPPING,
)

# One row per response body. A source that answers in pages has several bodies.
RAW_RESPONSE = _struct(
    run_id=STRING, source=STRING, source_ord=INT, response_no=INT, body=STRING, fetched_at=INSTANT
)

# Field names of the typed provider's payload are the provider's own.
TYPED_PAYLOAD = _struct(
    status=STRING,
    totalResults=INT,
    articles=T.ArrayType(
        _struct(
            source=_struct(id=STRING, name=STRING),
            author=STRING,
            title=STRING,
            description=STRING,
            url=STRING,
            urlToImage=STRING,
            publishedAt=STRING,
            content=STRING,
        )
    ),
)

ARTICLE = _struct(
    external_id=STRING,
    title=STRING,
    content=STRING,
    source=STRING,
    author=STRING,
    url=STRING,
    published_at=INSTANT,
)

INDEX_DOCUMENT = _struct(
    doc_id=STRING,
    title=STRING,
    content=STRING,
    source=STRING,
    url=STRING,
    timestamp=INSTANT,
    sentiment=STRING,
    embedding=T.ArrayType(DOUBLE),
)

# A stored document also keeps when, and by which run, it was written.
STORED_DOCUMENT = T.StructType(
    [*INDEX_DOCUMENT.fields, T.StructField("written_at", INSTANT), T.StructField("written_run", STRING)]
)

RUN_METRICS = _struct(
    run_at=INSTANT,
    source=STRING,
    status=STRING,
    upstream_status=STRING,
    total_results=LONG,
    fetched_count=LONG,
    normalized_count=LONG,
    discarded_count=LONG,
    failed_requests=LONG,
    embedded_count=LONG,
    indexed_count=LONG,
    created_count=LONG,
    updated_count=LONG,
    positive_count=LONG,
    negative_count=LONG,
    neutral_count=LONG,
    error_message=STRING,
    batch_id=STRING,
)

MODEL_RESPONSE = _struct(doc_id=STRING, status=INT, body=STRING)

ATTEMPT_LOG = _struct(
    run_id=STRING, source=STRING, attempt=INT, status=INT, error_kind=STRING, message=STRING
)

SEARCH_REQUEST = _struct(request_id=STRING, q=STRING, size=INT, min_score=DOUBLE)
