"""Content-addressed bodies, and reports as JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_verified_body(rows: DataFrame, encoded: str, digest: str, out: str = "body") -> DataFrame:
    """``rows`` with the decoded text of a base64 body whose SHA-256 is its address.

    The hash is computed again from the bytes; a body that is absent or does
    not match its address stops the job rather than passing on as evidence.
    """
    data = F.unbase64(encoded)
    same = F.sha2(data, 256) == F.lower(F.trim(digest))
    checked = F.when(F.coalesce(same, F.lit(False)), F.decode(data, "UTF-8")).otherwise(F.raise_error(F.concat(F.lit("body does not match its address "), F.coalesce(F.col(digest), F.lit("(none)")))))
    return rows.withColumn(out, checked)


def mismatched_bodies(rows: DataFrame, encoded: str, digest: str) -> DataFrame:
    """Rows whose body is absent or does not match its address, for an audit that must not stop."""
    same = F.sha2(F.unbase64(encoded), 256) == F.lower(F.trim(digest))
    return rows.where(~F.coalesce(same, F.lit(False)))


def _hex(text: str) -> str:
    return text.encode().hex().upper()


def content_verdict(data: str, kind: str, declared_length: str, etag: str) -> Column:
    """What an arrived document is worth: ``valid``, or the first fault of its length, its strong MD5 tag, its emptiness and its structure.

    ``kind`` is the expected one (pdf or zip; any other is ``unknown_kind``).  A
    PDF needs its header within the first kilobyte and its end mark within the
    last.  A declared length that is no number, and a tag that is no MD5,
    declare nothing.  No data at all is an empty body.
    """
    body = F.coalesce(data, F.lit(b""))
    n, declared = F.octet_length(body), F.trim(declared_length).try_cast("long")
    tag = F.lower(F.regexp_extract(F.coalesce(etag, F.lit("")), r'^"([0-9a-fA-F]{32})"$', 1))
    # In hex a mark must begin at an even place.
    holds = lambda part, mark: F.hex(part).rlike(f"^(?:..)*?{_hex(mark)}")
    head, tail = F.substring(body, 1, 1024 + 4), F.substring(body, F.greatest(F.lit(1), n - 1023), F.lit(1024))
    return (
        F.when(n < declared, "truncated").when(n > declared, "length_mismatch")
        .when((tag != "") & (tag != F.md5(body)), "etag_mismatch").when(n == 0, "empty_body")
        .when(F.col(kind) == "pdf", F.when(~holds(head, "%PDF-"), "not_pdf").when(~holds(tail, "%%EOF"), "truncated_or_malformed").otherwise("valid"))
        .when(F.col(kind) == "zip", F.when(F.hex(F.substring(body, 1, 4)) == "504B0304", "valid").otherwise("not_expected_type"))
        .otherwise("unknown_kind")
    )


def write_report(rows: DataFrame, path: str) -> None:
    """A report as JSON lines, null fields written, so that absent and null stay apart for readers."""
    rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
