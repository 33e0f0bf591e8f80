"""Column expressions over file paths, bytes and text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from treeloom import dims


def loc(content: Column) -> Column:
    """Number of newline-separated pieces; an empty text has one."""
    return F.size(F.split(content, "\n", -1)).cast("bigint")


def default_loc(content: Column) -> Column:
    """`loc`, but 0 for null or empty text."""
    return F.when(F.coalesce(content, F.lit("")) == "", F.lit(0).cast("bigint")).otherwise(loc(content))


def byte_size(content: Column) -> Column:
    return F.octet_length(content).cast("bigint")


def has_nul(data: Column) -> Column:
    """A NUL byte anywhere; unreadable bytes count as having none."""
    return F.coalesce(F.contains(data, F.lit(b"\x00")), F.lit(False))


def decoded(data: Column) -> Column:
    """Bytes as text with `\\n` line ends, null where they are not UTF-8."""
    text = data.cast("string")
    return F.when(F.is_valid_utf8(text), F.regexp_replace(text, "\r\n?", "\n"))


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def extension(path: Column) -> Column:
    """The last dot and what follows in the file name; a leading dot starts no extension."""
    return F.regexp_extract(path, r"[^/](\.[^./]+)$", 1)


def module_path(path: Column, root: str | None = None) -> Column:
    """Parent folder relative to `root`; `.` for the root itself."""
    if root is not None:
        prefix = root.rstrip("/") + "/"
        path = F.when(F.startswith(path, F.lit(prefix)), F.substr(path, F.lit(len(prefix) + 1))).otherwise(path)
    parent = F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    return F.when(parent == "", F.lit(".")).otherwise(parent)


def signature_type(data: Column) -> Column:
    """MIME type by the first bytes, null if none is known."""
    head = F.hex(F.substring(data, 1, 16))
    chosen = F.lit(None).cast("string")
    for prefix, mime in reversed(dims.SIGNATURES):
        chosen = F.when(F.startswith(head, F.lit(prefix)), F.lit(mime)).otherwise(chosen)
    return chosen


def text_type(content: Column, ext: Column) -> Column:
    """MIME type of readable text: by extension, else by how it begins."""
    by_ext = F.lit(None).cast("string")
    for known, mime in dims.TEXT_TYPE_OF.items():
        by_ext = F.when(ext == known, F.lit(mime)).otherwise(by_ext)
    by_content = (
        F.when(F.rlike(content, F.lit(r"(?i)\A\s*+<(!doctype\s+html|html[\s>])")), F.lit("text/html"))
        .when(F.rlike(content, F.lit(r"\A\s*+<\?xml")), F.lit("application/xml"))
        .otherwise(F.lit("text/plain"))
    )
    return (
        F.when(content == "", F.lit("inode/x-empty"))
        .when(F.contains(content, F.lit("\0")), F.lit("application/octet-stream"))
        .when(content.isNotNull(), F.coalesce(by_ext, by_content))
    )


def file_type(data: Column, ext: Column) -> Column:
    """MIME type: by signature, else that of readable text, else unknown bytes."""
    text = data.cast("string")
    return F.when(data.isNotNull(), F.coalesce(
        signature_type(data),
        F.when(F.is_valid_utf8(text), text_type(text, ext)),
        F.lit("application/octet-stream"),
    ))


def is_text(mime: Column, ext: Column, data: Column) -> Column:
    """Text by MIME type, by extension, or by being UTF-8 without NUL bytes and without the first
    bytes of a binary format."""
    readable = F.is_valid_utf8(data.cast("string")) & ~has_nul(data) & signature_type(data).isNull()
    return (
        F.coalesce(mime.isin(dims.TEXT_TYPES), F.lit(False))
        | F.coalesce(ext.isin(dims.TEXT_EXTENSIONS), F.lit(False))
        | F.coalesce(readable, F.lit(False))
    )


def content_language(content: Column) -> Column:
    """Language by how the text begins, null if they tell nothing."""
    return (
        F.when(F.rlike(content, F.lit(r"^#![^\n]*\bpython")), F.lit("python"))
        .when(F.rlike(content, F.lit(r"^#![^\n]*\b(node|deno)\b")), F.lit("javascript"))
        .when(F.rlike(content, F.lit(r"(?i)\A\s*+<(!doctype\s+html|html[\s>])")), F.lit("html"))
        .when(F.rlike(content, F.lit(r"\A\s*+<\?xml")), F.lit("xml"))
    )


def language(ext_language: Column, content: Column) -> Column:
    return F.lower(F.coalesce(ext_language, content_language(content), F.lit("unknown")))
