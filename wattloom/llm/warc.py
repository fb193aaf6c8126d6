"""WARC derivatives: each response yields a plain-text conversion and a metadata record.

All record fields are SQL expressions over the page row. Record identifiers are derived from
the page, the kind and the content, so a rerun after a lost executor gives the same ones.
The conversion refers to the response, and so does the metadata record, which also keeps the
response's headers and digest and names the conversion. `write_records` lays each record out
as WARC/1.1 bytes.

Defined results: null url or html is the empty string (an empty page has an empty
conversion); a null page_id gives identifiers of its own from the content; rows that repeat
give records that repeat. Further columns of the input are headers of the response: the
metadata record has a line for each that is not null, and for each entry of a map, in the order
of the columns, with line breaks in a value written as one space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Markup to text: (pattern, replacement), in order. Patterns mean the same in Java and RE2.
STEPS = [
    (r"(?is)<!--.*?-->", " "),
    (r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "),
    (r"(?is)</?(p|br|div|h1|h2|h3|li|ul|ol|tr|table|article|section|title|body|head)[^>]*>", "\n"),
    (r"(?is)<[^>]*>", ""),
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", "\""), ("&#39;", "'"),
    ("&amp;", "&"),
    (r"[ \t\r]+", " "),
    (r" ?\n[ \n]*", "\n"),
]


def plain_text(html):
    """The text of a page, its blocks on lines of their own."""
    for pattern, text in STEPS:
        html = F.regexp_replace(html, F.lit(pattern), F.lit(text))
    return F.btrim(html, F.lit(" \n"))


def _digest(text):
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def _record_id(kind: str, digest):
    h = F.sha2(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("")),
                           F.col("_url"), F.lit(kind), digest).cast("binary"), 256)
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _headers(pages: DataFrame) -> list:
    """One text for each further column: its lines `source-<name>: <value>`, or empty."""
    def line(name, value):
        return F.concat(F.lit("source-"), name, F.lit(": "),
                        F.regexp_replace(value.cast("string"), r"\s*[\r\n]+\s*", " "), F.lit("\n"))
    out = []
    for field in pages.schema:
        if field.name in ("page_id", "url", "html"):
            continue
        column = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, T.MapType):
            lines = F.transform(F.map_entries(column), lambda e: F.coalesce(
                line(e["key"].cast("string"), e["value"]), F.lit("")))
            text = F.array_join(lines, "")
        else:
            text = line(F.lit(field.name), column)
        out.append(F.coalesce(text, F.lit("")))
    return out


def derive(pages: DataFrame) -> DataFrame:
    """page_id, record_type, record_id, refers_to, target_uri, content_type, payload_digest,
    content_length (bytes) and content, for the response, conversion and metadata records."""
    base = pages.select(F.col("page_id"), F.coalesce("url", F.lit("")).alias("_url"),
                        F.coalesce("html", F.lit("")).alias("_html"),
                        F.concat(*_headers(pages), F.lit("")).alias("_headers"))
    base = base.withColumn("_text", plain_text(F.col("_html")))
    base = base.withColumns({"_html_digest": _digest(F.col("_html")),
                             "_text_digest": _digest(F.col("_text"))})
    base = base.withColumns({"_rid": _record_id("response", F.col("_html_digest")),
                             "_cid": _record_id("conversion", F.col("_text_digest"))})
    facts = F.concat(
        F.lit("source-type: text/html\nsource-digest: "), F.col("_html_digest"),
        F.lit("\nsource-length: "), F.octet_length("_html").cast("string"),
        F.lit("\nconversion: "), F.col("_cid"), F.lit("\n"),
        F.col("_headers"))
    base = base.withColumn("_facts", facts)
    base = base.withColumn("_facts_digest", _digest(F.col("_facts")))
    base = base.withColumn("_mid", _record_id("metadata", F.col("_facts_digest")))

    def record(kind, rid, refers, mime, digest, content):
        return F.struct(F.lit(kind).alias("record_type"), F.col(rid).alias("record_id"),
                        refers.alias("refers_to"), F.lit(mime).alias("content_type"),
                        F.col(digest).alias("payload_digest"),
                        F.octet_length(content).cast("long").alias("content_length"),
                        F.col(content).alias("content"))
    records = F.array(
        record("response", "_rid", F.lit(None).cast("string"), "text/html", "_html_digest", "_html"),
        record("conversion", "_cid", F.col("_rid"), "text/plain", "_text_digest", "_text"),
        record("metadata", "_mid", F.col("_rid"), "application/warc-fields", "_facts_digest",
               "_facts"))
    return base.select("page_id", F.col("_url").alias("target_uri"),
                       F.inline(records))


def write_records(records: DataFrame, path: str, date: str) -> None:
    """WARC/1.1 bytes of each record in a Parquet folder: page_id, record_id, warc."""
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), F.col("record_id"), F.lit(f"\r\nWARC-Date: {date}"),
        F.lit("\r\nWARC-Target-URI: "), F.col("target_uri"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Refers-To: "), F.col("refers_to")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: "), F.col("payload_digest"),
        F.lit("\r\nContent-Type: "), F.col("content_type"),
        F.lit("\r\nContent-Length: "), F.col("content_length").cast("string"),
        F.lit("\r\n\r\n"))
    records.select("page_id", "record_id", F.concat(head, F.col("content"), F.lit("\r\n\r\n"))
                   .cast("binary").alias("warc")).write.mode("overwrite").parquet(path)
