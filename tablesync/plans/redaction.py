"""Registered queries: credentials masked in whole text columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.redact import redact_text
from tablesync.plans.base import load, register


def _masked_sql(text: str) -> str:
    """The oracle's chain of the same five rules, in RE2 spelling: fixed values, as in :data:`PATTERNS`."""
    rules = [
        (r"(\bAuthorization:)\s+(?:Bearer|Basic)\s+\S+", r"\1 ***"),
        (r'("(?:access_token|client_secret|token)"\s*:\s*")(?:[^"\\]|\\.)*"', r'\1***"'),
        (r'(\b(?:access_token|refresh_token|client_secret|token)\b)=(?:"[^"]*"|[^\s;,&]+)', r"\1=***"),
        (
            r"""https://([^/\s]*(?:\.amazonaws\.com|\.blob\.core\.windows\.net|storage\.googleapis\.com))/[^\s"'']*""",
            r"https://\1/<redacted>",
        ),
        (r"""https://([^/\s]+)/[^\s"'']*?[?&](?:X-Amz-Signature|sig|X-Goog-Signature)=[^\s"'']*""", r"https://\1/<redacted>"),
    ]
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'gi')"
    return text


_LOG_SQL = """CASE event_type
    WHEN 'click' THEN 'GET authorization: Bearer key-' || event_id || ' user ' || user_id
    WHEN 'view' THEN '{"access_token": "a.' || event_id || '\\"x", "token_type": "Bearer"}'
    WHEN 'error' THEN 'POST client_secret=s' || event_id || ';scope=x&TOKEN="' || user_id || ' y" done'
    WHEN 'signup' THEN 'GET https://b.s3.amazonaws.com/a/' || event_id || '?X-Amz-Signature=de&X-Amz-Expires=900 failed'
    ELSE 'GET https://cdn' || user_id || '.example.org/f/' || event_id || '?v=1&sig=abc%3D ok https://app.example.org/api/' || event_id
    END"""


@register(f"SELECT event_id, {_masked_sql(_LOG_SQL)} AS line FROM events")
def redact_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event, of a shape that goes with its type."""
    kind, event, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    line = (
        F.when(kind == "click", F.concat(F.lit("GET authorization: Bearer key-"), event, F.lit(" user "), user))
        .when(kind == "view", F.concat(F.lit('{"access_token": "a.'), event, F.lit('\\"x", "token_type": "Bearer"}')))
        .when(kind == "error", F.concat(F.lit("POST client_secret=s"), event, F.lit(';scope=x&TOKEN="'), user, F.lit(' y" done')))
        .when(
            kind == "signup",
            F.concat(F.lit("GET https://b.s3.amazonaws.com/a/"), event, F.lit("?X-Amz-Signature=de&X-Amz-Expires=900 failed")),
        )
        .otherwise(
            F.concat(
                F.lit("GET https://cdn"), user, F.lit(".example.org/f/"), event,
                F.lit("?v=1&sig=abc%3D ok https://app.example.org/api/"), event,
            )
        )
    )
    return redact_text(load(spark, sf_dir, "events").select("event_id", line.alias("line")), "line")


@register(f"SELECT page_id, {_masked_sql('html')} AS html FROM pages")
def redact_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact_text(load(spark, sf_dir, "pages").select("page_id", "html"), "html")


_HEAD = "Authorization: Bearer t0 {\"token\": \"u1\"} client_secret=v2; https://a.blob.core.windows.net/w3 https://x.test/y?sig=z4 "


@register(
    f"SELECT 'page' AS kind, page_id AS id, {_masked_sql("'" + _HEAD + "' || html")} AS text FROM pages "
    f"UNION ALL SELECT 'document', doc_id, {_masked_sql("text || ' " + _HEAD + "'")} FROM documents"
)
def redact_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credentials of every shape put before each page and after each document."""
    head = F.lit(_HEAD)
    pages = load(spark, sf_dir, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), F.concat(head, "html").alias("text"))
    docs = load(spark, sf_dir, "documents").select(
        F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.concat("text", F.lit(" "), head).alias("text")
    )
    return redact_text(pages.union(docs), "text")


# Registered secrets of the example: they contain each other, and one is too short to count.
SECRETS = ("er", "eau", "eaux", "token", "theresan", "there", "ment", "mentre")


def _registered_sql(text: str) -> str:
    for secret in sorted((s for s in SECRETS if len(s) >= 3), key=len, reverse=True):
        text = f"replace({text}, '{secret}', '***')"
    return _masked_sql(text)


@register(f"SELECT doc_id, {_registered_sql('text')} AS text FROM documents")
def redact_registered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", SECRETS)


# Many registered secrets: a few syllables of the example's languages put together; some start or hold others.
_PARTS = ("an", "er", "th", "ion", "sch", "eau", "de", "ment", "ció", "lich", "ou", "in", "es", "ar", "ver", "qu")
MANY_SECRETS = tuple(a + b for a in _PARTS for b in _PARTS) + tuple(a + b + a for a in _PARTS[:8] for b in _PARTS[8:])


def _many_sql(text: str) -> str:
    for secret in sorted({s for s in MANY_SECRETS if len(s) >= 3}, key=lambda s: (-len(s), s)):
        text = f"replace({text}, '{secret}', '***')"
    return _masked_sql(text)


@register(f"SELECT doc_id, {_many_sql('text')} AS text FROM documents")
def redact_many_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hundred registered secrets, looked up by one pattern."""
    return redact_text(load(spark, sf_dir, "documents").select("doc_id", "text"), "text", MANY_SECRETS)
