"""Format detection from a name and the first bytes of the content."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats by file extension.
EXTENSIONS = {
    "docx": "docx", "dotx": "docx", "docm": "docx", "dotm": "docx", "pptx": "pptx", "potx": "pptx", "ppsx": "pptx", "pptm": "pptx", "xlsx": "xlsx", "xlsm": "xlsx",
    "pdf": "pdf", "md": "md", "html": "html", "htm": "html", "xhtml": "html", "xml": "xml", "nxml": "xml", "jpg": "image", "jpeg": "image", "png": "image", "tif": "image",
    "tiff": "image", "bmp": "image", "webp": "image", "adoc": "asciidoc", "asciidoc": "asciidoc", "asc": "asciidoc", "csv": "csv", "txt": "text", "json": "json", "wav": "audio", "mp3": "audio",
}


def extension(name: Column) -> Column:
    path = F.regexp_replace(name, r"[?#].*$", "")
    return F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))


def detect(name: Column, head: Column) -> Column:
    """The format: by signature, then by extension, then by how the text begins."""
    known = F.create_map(*[F.lit(x) for kv in EXTENSIONS.items() for x in kv])
    start = F.lower(F.ltrim(F.substring(head, 1, 1024)))
    by_start = (
        F.when(start.startswith("%pdf-"), "pdf")
        .when(start.rlike(r"^(<!doctype\s+html|<html)"), "html")
        .when(start.startswith("<?xml") & start.contains("<html"), "html")
        .when(start.startswith("patn\n") | start.startswith("patn\r\n"), "uspto")
        .when(start.rlike(r"<!doctype\s+article"), "jats")
        .when(start.rlike(r"<!doctype\s+(us-patent|patent)"), "uspto")
        .when(start.startswith("<?xml"), "xml")
        .when(start.startswith("{"), "json")
    )
    return F.coalesce(by_start, known[extension(name)], F.lit("text"))
