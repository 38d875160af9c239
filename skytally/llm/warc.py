"""WARC records as rows: reading, writing, and metadata and plain-text records derived from responses."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_CRLF = "\r\n"
#: Columns of a record: its header fields, and the block.
RECORD = ["record_id", "type", "target_uri", "date", "content_type", "refers_to", "concurrent_to", "payload_digest", "block_digest", "block"]
_FIELDS = {
    "type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type",
    "refers_to": "WARC-Refers-To", "concurrent_to": "WARC-Concurrent-To", "payload_digest": "WARC-Payload-Digest", "block_digest": "WARC-Block-Digest",
}


def uuid_urn(*parts: Column) -> Column:
    """Record id that depends on the parts alone, so a stage that runs again gives the same ids."""
    x = F.md5(F.concat_ws("\n", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))
    cut = [F.substring(x, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text, 256))


def responses(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """One response record for each row of ``pages`` (page_id, url, html); null html is an empty payload."""
    html = F.coalesce("html", F.lit(""))
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "), F.octet_length(html).cast("string"), F.lit(_CRLF * 2))
    block = F.concat(head, html)
    return pages.select(
        uuid_urn(F.lit("response"), F.col("page_id"), F.col("url")).alias("record_id"), F.lit("response").alias("type"), F.col("url").alias("target_uri"),
        F.lit(date).alias("date"), F.lit("application/http; msgtype=response").alias("content_type"), F.lit(None).cast("string").alias("refers_to"),
        F.lit(None).cast("string").alias("concurrent_to"), digest(html).alias("payload_digest"), digest(block).alias("block_digest"), block.alias("block"),
    )


def _unescaped(text: Column) -> Column:
    """Character references decoded: all of HTML's names that end in ``;``, decimal and hexadecimal ones."""
    names = F.create_map(*(F.lit(x) for name, value in html5.items() if name.endswith(";") for x in (name[:-1], value)))
    code = lambda n: F.when(((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000)), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
    decimal, hexadecimal, name = (r"^#([0-9]{1,7});", r"^#[xX]([0-9a-fA-F]{1,6});", r"^([A-Za-z][A-Za-z0-9]{1,31});")

    def part(p: Column, i: Column) -> Column:
        rest = F.substring_index(p, ";", 1)
        rest = F.substr(p, F.length(rest) + 2)
        of = lambda pattern: F.regexp_extract(p, pattern, 1)
        char = F.coalesce(
            F.when(of(name) != "", F.element_at(names, of(name))),
            F.when(of(decimal) != "", code(of(decimal).cast("long"))),
            F.when(of(hexadecimal) != "", code(F.conv(of(hexadecimal), 16, 10).cast("long"))),
        )
        return F.when(i == 0, p).otherwise(F.coalesce(F.concat(char, rest), F.concat(F.lit("&"), p)))

    return F.when(F.contains(text, F.lit("&")), F.array_join(F.transform(F.split(text, "&"), part), "")).otherwise(text)


#: Comments and elements without text of their own, to their end or the page's; one pass over the page.
_HIDDEN = r"(?is)<(?:!--.*?(?:-->|\z)|" + "|".join(rf"{tag}\b[^<>]*>.*?(?:</{tag}\s*+>|\z)" for tag in ("script", "style", "template", "noscript")) + ")"


def plain_text(html: Column) -> Column:
    """Text of a page: comments, scripts, styles and tags taken out, blocks on lines of their own.

    A tag ends before the next ``<``; what is never closed stays as text. So the time follows the page's length, however broken it is.
    """
    t = F.regexp_replace(html, _HIDDEN, "")
    t = F.regexp_replace(t, r"[ \t\r\n\f]+", " ")
    t = F.regexp_replace(t, r"(?i)</?(address|article|aside|blockquote|body|br|dd|div|dl|dt|footer|form|h[1-6]|head|header|hr|html|li|main|nav|ol|p|pre|section|table|td|th|title|tr|ul)\b[^<>]*>", "\n")
    t = F.regexp_replace(t, r"</?[A-Za-z!?][^<>]*>", "")
    t = _unescaped(t)
    # Spaces are looked at from the character before them, so a long run of them is read once.
    t = F.regexp_replace(t, r"(\A|[^ ]) *\n[ \n]*", "$1\n")
    return F.btrim(t, F.lit(" \n"))


def derive(records: DataFrame) -> DataFrame:
    """Two records for each response: its metadata and its plain text, linked with it and with each other.

    ``records``: columns ``RECORD``. Other types give nothing. Both refer to the response (``refers_to``) and keep
    its URI and date; the text is concurrent to the metadata. The metadata block holds the response's status line,
    each header of the source with its name, both digests of the source, and the id and digest of the text. The
    text's payload_digest is that of its block. The payload starts behind the first empty line, with CRLF or bare line feeds; a block
    that does not start with ``HTTP/`` is payload alone. Null block: an empty payload without headers. Very long and broken pages are read whole. Ids follow from the
    response's id, so equal records give equal ones; an empty table gives an empty result. Columns of ``RECORD``
    alone are read.
    """
    block = F.coalesce("block", F.lit(""))
    empty = F.lit("")
    wide, narrow = F.instr(block, _CRLF * 2), F.instr(block, "\n\n")
    narrow = F.when(narrow > 0, narrow)
    at = F.least(F.when(wide > 0, wide), narrow)
    gap = F.when(at == narrow, 2).otherwise(4)
    is_http = F.startswith(block, F.lit("HTTP/"))
    head = F.when(is_http, F.when(at.isNull(), block).otherwise(F.substr(block, F.lit(1), at - 1))).otherwise(empty)
    body = F.when(is_http, F.when(at.isNull(), empty).otherwise(F.substr(block, at + gap))).otherwise(block)
    r = records.where("type = 'response'").select(*(c for c in RECORD if c != "block"), head.alias("head"), body.alias("body"))
    r = r.withColumn("text", plain_text(F.col("body"))).withColumns({
        "meta_id": uuid_urn(F.lit("metadata"), F.col("record_id")), "text_id": uuid_urn(F.lit("conversion"), F.col("record_id")), "text_digest": digest(F.col("text")),
    })
    lines = F.filter(F.split("head", r"\r?\n"), lambda x: x != "")
    status, fields = F.coalesce(F.get(lines, F.lit(0)), F.lit("")), F.slice(lines, 2, F.greatest(F.size(lines), F.lit(1)))
    meta = F.concat_ws(
        "",
        *(F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit("")), F.lit(_CRLF)) for k, v in (
            ("source-status", status), ("source-payload-digest", F.col("payload_digest")), ("source-block-digest", F.col("block_digest")),
            ("conversion-id", F.col("text_id")), ("conversion-digest", F.col("text_digest")), ("conversion-length", F.octet_length("text").cast("string")),
        )),
        F.array_join(F.transform(F.when(F.size(lines) > 0, fields).otherwise(lines), lambda x: F.concat(F.lit("source-header-"), x, F.lit(_CRLF))), ""),
    )
    none = F.lit(None).cast("string")
    record = lambda *v: F.struct(*(x.alias(c) for c, x in zip(RECORD, v)))
    r = r.withColumn("meta", meta)
    both = F.array(
        record(F.col("meta_id"), F.lit("metadata"), F.col("target_uri"), F.col("date"), F.lit("application/warc-fields"), F.col("record_id"), none, none, digest(F.col("meta")), F.col("meta")),
        record(F.col("text_id"), F.lit("conversion"), F.col("target_uri"), F.col("date"), F.lit("text/plain; charset=utf-8"), F.col("record_id"), F.col("meta_id"), F.col("text_digest"), F.col("text_digest"), F.col("text")),
    )
    return r.select(F.inline(both))


def serialized(records: DataFrame) -> DataFrame:
    """value: each record as it stands in a file, without the last line break."""
    header = [F.concat(F.lit(f"{name}: "), F.regexp_replace(c, r"[\r\n]+", " "), F.lit(_CRLF)) for c, name in _FIELDS.items()]
    block = F.coalesce("block", F.lit(""))
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(_CRLF * 2))
    return records.select(F.concat_ws("", F.lit(f"WARC/1.1{_CRLF}"), *header, length, block, F.lit(_CRLF)).alias("value"))


def write(records: DataFrame, path: str, **options: str) -> None:
    """Write records as WARC files, one for each partition; options as for text files (``compression="gzip"``)."""
    serialized(records).write.options(**options).option("lineSep", _CRLF).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Records (columns ``RECORD``) of WARC files with text blocks; large files are split at record borders.

    A block that holds the line ``WARC/1.1`` itself would be cut there; such records are told by their length and
    raise an error.
    """
    raw = spark.read.option("lineSep", f"WARC/1.1{_CRLF}").text(path).where("value != ''")
    at = F.instr("value", _CRLF * 2)
    rows = raw.select(F.substr("value", F.lit(1), at + 1).alias("head"), F.substr("value", at + 4).alias("rest"))
    field = lambda name: F.nullif(F.regexp_extract("head", rf"(?im)^{name}: *([^\r\n]*)", 1), F.lit(""))
    rows = rows.select(*(field(name).alias(c) for c, name in _FIELDS.items()), field("Content-Length").cast("long").alias("length"), F.expr("left(rest, length(rest) - 4)").alias("block"))
    fits = F.octet_length("block") == F.col("length")
    return rows.where(F.when(fits, True).otherwise(F.raise_error(F.concat(F.lit("cut record "), "record_id")).isNull())).select(*RECORD)
