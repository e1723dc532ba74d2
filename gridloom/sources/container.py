"""Task-side helpers: what kind of container is this, and which parts does it hold.

Only the standard library is used. Spark decides which task sees which file.
"""

from __future__ import annotations

import gzip
import io
import posixpath
import re
import xml.etree.ElementTree as ET
import zipfile
import zlib

# Leading bytes of the container formats.
OLE2_MAGIC = bytes.fromhex("d0cf11e0a1b11ae1")
GZIP_MAGIC = bytes.fromhex("1f8b")

STATUS_FIELDS = ("status", "error", "workbook", "rels", "styles", "strings_part", "base")


class ContainerError(Exception):
    def __init__(self, status: str, message: str):
        super().__init__(message)
        self.status = status


def unwrap(content: bytes) -> bytes:
    """The bytes themselves, or what they hold if they are one gzip stream."""
    if content[:2] != GZIP_MAGIC:
        return content
    try:
        return gzip.decompress(content)
    except (OSError, EOFError, zlib.error) as e:
        raise ContainerError("corrupt", f"not a whole gzip stream: {e}") from None


def as_text(xml: bytes) -> str:
    """XML bytes → text without its declaration."""
    if xml[:2] in (b"\xff\xfe", b"\xfe\xff"):
        text = xml.decode("utf-16")
    else:
        text = xml.decode("utf-8-sig")
    return re.sub(r"^\s*<\?xml[^>]*\?>", "", text)


def open_zip(content: bytes, path: str) -> zipfile.ZipFile:
    content = unwrap(content)
    if not content:
        raise ContainerError("corrupt", "file is empty")
    if content[:8] == OLE2_MAGIC:
        if "EncryptedPackage".encode("utf-16-le") in content:
            raise ContainerError("encrypted", "workbook is encrypted")
        if path.lower().endswith(".xls") or "Workbook".encode("utf-16-le") in content:
            raise ContainerError("unsupported_format", "legacy binary workbooks are not supported")
        raise ContainerError("encrypted", "workbook is encrypted")
    try:
        z = zipfile.ZipFile(io.BytesIO(content))
    except (zipfile.BadZipFile, ValueError, OSError, EOFError) as e:
        raise ContainerError("corrupt", f"not a readable zip container: {e}") from None
    if any(i.flag_bits & 1 for i in z.infolist()):
        raise ContainerError("encrypted", "zip entries are encrypted")
    return z


def _related(z: zipfile.ZipFile, part: str) -> list[tuple[str, str]]:
    """(last word of the relationship type, target part) for each relationship of a part."""
    folder, name = posixpath.split(part)
    rels = posixpath.join(folder, "_rels", name + ".rels")
    if rels not in z.namelist():
        return []
    found = []
    for node in ET.fromstring(z.read(rels)):
        target = node.get("Target", "")
        if node.get("TargetMode") == "External" or not target:
            continue
        target = posixpath.normpath(posixpath.join("/", folder, target)).lstrip("/")
        found.append((node.get("Type", "").rsplit("/", 1)[-1], target))
    return found


def directory(content: bytes, path: str) -> tuple:
    """The small parts of a workbook as text, or why it can't be opened (see STATUS_FIELDS)."""
    try:
        z = open_zip(content, path)
        main = next((t for kind, t in _related(z, "") if kind == "officeDocument"), "xl/workbook.xml")
        if main.endswith(".bin"):
            raise ContainerError("unsupported_format", "binary workbook parts are not supported")
        if main not in z.namelist():
            raise ContainerError("unsupported_format", "container holds no workbook")
        links = dict(reversed(_related(z, main)))
        folder, name = posixpath.split(main)
        rels = posixpath.join(folder, "_rels", name + ".rels")

        def text(part):
            return as_text(z.read(part)) if part in z.namelist() else None

        return (
            "ok", None, text(main), text(rels), text(links.get("styles")),
            links.get("sharedStrings"), folder + "/" if folder else "",
        )
    except ContainerError as e:
        return (e.status, str(e)) + (None,) * 5
    except (zipfile.BadZipFile, zlib.error, ET.ParseError, UnicodeDecodeError, NotImplementedError,
            RuntimeError, EOFError, OSError, KeyError) as e:
        return ("corrupt", f"{type(e).__name__}: {e}") + (None,) * 5
