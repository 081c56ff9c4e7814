"""Inspecting and opening source files: a ZIP with exactly one text member, or a plain text."""

from __future__ import annotations

import codecs
import hashlib
import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from pathlib import PurePosixPath
from typing import IO

from pyarrow import fs

BLOCK, SAMPLE = 1 << 20, 1 << 16
ENCODINGS = ("utf-8", "cp1252")


class SourceError(ValueError):
    """A source that cannot be used as it is."""


@dataclass(frozen=True)
class Inspection:
    path: str
    sha256: str
    size: int
    member: str | None
    sample: bytes

    def header(self) -> list[str]:
        line = self.sample.replace(b"\r\n", b"\n").replace(b"\r", b"\n").split(b"\n", 1)[0]
        return decoded(line).split("|")


def decoded(block: bytes) -> str:
    for encoding in ENCODINGS:
        try:
            return block.decode(encoding)
        except UnicodeDecodeError:
            continue
    raise SourceError("neither UTF-8 nor CP1252")


@contextmanager
def raw(path: str) -> Iterator[IO[bytes]]:
    """The file's bytes, on any file system that pyarrow knows; a bare path is local."""
    where, name = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    with where.open_input_file(name) as stream:
        yield stream


def text_member(archive: zipfile.ZipFile) -> str:
    """The only member that is a text; members outside the archive's own folder are an error."""
    names = [i.filename for i in archive.infolist() if not i.is_dir()]
    for name in names:
        if name.startswith(("/", "\\")) or ".." in PurePosixPath(name.replace("\\", "/")).parts or ":" in name:
            raise SourceError(f"unsafe member {name}")
    if len(names) != 1 or not names[0].lower().endswith(".txt"):
        raise SourceError(f"expected one text member, found {len(names)} members")
    return names[0]


@contextmanager
def content(path: str) -> Iterator[tuple[IO[bytes], str | None]]:
    """The text's bytes and, for a ZIP, the member's name."""
    with raw(path) as stream:
        if path.lower().endswith(".zip"):
            with zipfile.ZipFile(stream) as archive:
                member = text_member(archive)
                with archive.open(member) as text:
                    yield text, member
        else:
            yield stream, None


def inspect(path: str) -> Inspection:
    """Checksum, size, integrity and a sample; a damaged archive is an error."""
    digest, size = hashlib.sha256(), 0
    with raw(path) as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
            size += len(block)
    try:
        with content(path) as (text, member):
            sample = text.read(SAMPLE)
            while text.read(BLOCK):  # reading to the end verifies a member's CRC
                pass
    except zipfile.BadZipFile as error:
        raise SourceError(f"{path}: {error}") from error
    return Inspection(path, digest.hexdigest(), size, member, sample)


def encoding_of(path: str) -> str:
    """UTF-8 if the whole text is, else CP1252 if it is; NUL characters are an error."""
    able = {e: codecs.getincrementaldecoder(e)() for e in ENCODINGS}
    with content(path) as (text, _):
        while True:
            block = text.read(BLOCK)
            if b"\x00" in block:
                raise SourceError(f"{path}: NUL characters")
            for name in list(able):
                try:
                    able[name].decode(block, final=not block)
                except UnicodeDecodeError:
                    del able[name]
            if not able:
                raise SourceError(f"{path}: neither UTF-8 nor CP1252")
            if not block:
                return next(iter(able))


def lines(path: str, encoding: str | None = None) -> Iterator[str]:
    """The text's lines; CR, LF and CRLF all end one."""
    with content(path) as (text, _):
        yield from (x.removesuffix("\n") for x in io.TextIOWrapper(io.BufferedReader(text) if not isinstance(text, io.BufferedIOBase) else text, encoding or encoding_of(path), errors="strict", newline=None))


def newline_count(path: str) -> int:
    with content(path) as (text, _):
        return sum(block.count(b"\n") for block in iter(lambda: text.read(BLOCK), b""))
