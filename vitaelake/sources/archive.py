"""Zip archives of documents as DataFrames of entries and texts.

Spark cannot split an archive, and one may be larger than a binary column allows, so its
content never becomes a row. An archive of at most a task's fair share is read by one task,
front to back. For a larger one, a task streams the directory of entries; the entries are
spread over tasks, and each task seeks to its own entries only.
"""

import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY_SCHEMA = (
    "path STRING, entry STRING, offset BIGINT, packed_size BIGINT, size BIGINT, "
    "method INT, flags INT, crc BIGINT"
)
DOCUMENT_SCHEMA = "path STRING, entry STRING, xml STRING, error STRING"

# Fixed values of the zip format.
_END_SIZE, _END_SIGNATURE = 22, b"PK\x05\x06"
_END64_LOCATOR_SIZE, _END64_LOCATOR_SIGNATURE = 20, b"PK\x06\x07"
_DIRECTORY_HEADER, _DIRECTORY_SIGNATURE = struct.Struct("<4s6H3I5H2I"), b"PK\x01\x02"
_LOCAL_HEADER_SIZE, _LOCAL_SIGNATURE = 30, b"PK\x03\x04"
_STORED, _DEFLATED = 0, 8
_ENCRYPTED, _UTF8_NAME = 0x1, 0x800
_MAX32 = 0xFFFFFFFF

_ENTRIES_PER_BATCH = 10_000
_BYTES_PER_BATCH = 8 << 20
_LOCALITY_BLOCK = 8 << 20
_BYTES_PER_TASK = 512 << 20
_LISTING_TASKS = 2000


def archive_files(spark: SparkSession, location: str, pattern: str = "*.zip") -> DataFrame:
    """Paths and lengths of the archives; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return files.option("pathGlobFilter", pattern).load(location).select("path", "length")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path or URI, and the path within it."""
    scheme, separator, rest = path.partition(":")
    if not separator or scheme == "file":
        return fs.LocalFileSystem(), "/" + (rest if separator else path).lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", path))


def _open(path: str):
    """Random-access handle on a file."""
    filesystem, name = file_system(path)
    return filesystem.open_input_file(name)


def _directory_span(handle) -> tuple[int, int, int]:
    """Start and size of the entry directory, and the shift to add to stored offsets."""
    length = handle.size()
    tail_start = max(0, length - (_END_SIZE + 0xFFFF + _END64_LOCATOR_SIZE))
    handle.seek(tail_start)
    tail = handle.read(length - tail_start)
    end = tail.rfind(_END_SIGNATURE)
    if end < 0:
        raise ValueError("not a zip archive: no end record")
    size, offset = struct.unpack_from("<2I", tail, end + 12)
    end_at = tail_start + end
    locator = end - _END64_LOCATOR_SIZE
    if locator >= 0 and tail[locator : locator + 4] == _END64_LOCATOR_SIGNATURE:
        (end_at,) = struct.unpack_from("<Q", tail, locator + 8)
        handle.seek(end_at)
        size, offset = struct.unpack_from("<2Q", handle.read(56), 40)
    return end_at - size, size, end_at - size - offset


def _wide_values(extra: bytes, values: list[int]) -> list[int]:
    """Replace 32-bit overflow marks by the 64-bit values of the extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, length = struct.unpack_from("<2H", extra, at)
        if kind == 1:
            wide = iter(struct.unpack_from(f"<{length // 8}Q", extra, at + 4))
            return [next(wide) if value == _MAX32 else value for value in values]
        at += 4 + length
    return values


def directory_entries(handle) -> Iterator[tuple]:
    """Entries of one archive, streamed: memory does not grow with their number."""
    start, size, shift = _directory_span(handle)
    handle.seek(start)
    left, buffer, at = size, b"", 0
    fixed = _DIRECTORY_HEADER.size
    while left or at < len(buffer):
        if len(buffer) - at < fixed + 3 * 0xFFFF and left:
            chunk = handle.read(min(left, 1 << 20))
            if not chunk:
                raise ValueError("archive directory is cut short")
            left -= len(chunk)
            buffer, at = buffer[at:] + chunk, 0
            continue
        header = _DIRECTORY_HEADER.unpack_from(buffer, at)
        if header[0] != _DIRECTORY_SIGNATURE:
            raise ValueError("archive directory is damaged")
        flags, method, crc = header[3], header[4], header[7]
        packed, unpacked, name_len, extra_len, note_len = header[8:13]
        offset = header[16]
        name_at = at + fixed
        name = buffer[name_at : name_at + name_len]
        extra = buffer[name_at + name_len : name_at + name_len + extra_len]
        if _MAX32 in (packed, unpacked, offset):
            unpacked, packed, offset = _wide_values(extra, [unpacked, packed, offset])
        text = name.decode("utf-8" if flags & _UTF8_NAME else "cp437", "replace")
        yield text, offset + shift, packed, unpacked, method, flags, crc
        at = name_at + name_len + extra_len + note_len


def list_entries(archives: DataFrame) -> DataFrame:
    """One row per archive entry, with what a task needs to read it directly."""

    # Few writers: the shuffle that spreads the entries has very many readers.
    return archives.select("path").coalesce(_LISTING_TASKS).mapInArrow(_list, ENTRY_SCHEMA)


def _list(batches):
    names = [part.split()[0] for part in ENTRY_SCHEMA.split(", ")]
    for batch in batches:
        for path in batch.column("path").to_pylist():
            rows = []
            with _open(path) as handle:
                for entry in directory_entries(handle):
                    rows.append((path, *entry))
                    if len(rows) == _ENTRIES_PER_BATCH:
                        yield _entry_batch(rows, names)
                        rows = []
            if rows:
                yield _entry_batch(rows, names)


def _entry_batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = {"method": pa.int32(), "flags": pa.int32()}
    columns = []
    for name, values in zip(names, zip(*rows)):
        kind = pa.string() if isinstance(values[0], str) else types.get(name, pa.int64())
        columns.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(columns, names)


XML_SUFFIX = ".xml"


def select_xml(entries: DataFrame) -> DataFrame:
    """Entries whose name ends in ``.xml``, in exactly that case."""
    return entries.where(F.col("entry").endswith(XML_SUFFIX))


def decode_document(raw: bytes) -> str:
    """Document bytes as text, by byte-order mark or the charset its declaration names."""
    if raw[:2] in (b"\xff\xfe", b"\xfe\xff"):
        return raw.decode("utf-16")
    declared = re.match(rb"""\s*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._:-]+)["']""", raw)
    charset = declared.group(1).decode("ascii") if declared else "utf-8"
    return raw.decode("utf-8-sig" if charset.lower() in ("utf-8", "utf8") else charset)


def _entry_bytes(handle, entry: dict) -> bytes:
    if entry["flags"] & _ENCRYPTED:
        raise ValueError("entry is encrypted")
    handle.seek(entry["offset"])
    header = handle.read(_LOCAL_HEADER_SIZE)
    if header[:4] != _LOCAL_SIGNATURE:
        raise ValueError("entry header is damaged")
    name_len, extra_len = struct.unpack_from("<2H", header, 26)
    handle.seek(entry["offset"] + _LOCAL_HEADER_SIZE + name_len + extra_len)
    packed = handle.read(entry["packed_size"])
    if entry["method"] == _STORED:
        raw = packed
    elif entry["method"] == _DEFLATED:
        raw = zlib.decompress(packed, -zlib.MAX_WBITS)
    else:
        raise ValueError(f"unknown compression method {entry['method']}")
    if zlib.crc32(raw) != entry["crc"]:
        raise ValueError("entry checksum differs")
    return raw


def _read_document(handle, entry: dict) -> tuple[str | None, str | None]:
    """Text of an entry, or why it cannot be read."""
    try:
        return decode_document(_entry_bytes(handle, entry)), None
    except (ValueError, LookupError, zlib.error, struct.error) as problem:
        return None, f"{type(problem).__name__}: {problem}"


def _document_batches(documents: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Documents in batches bounded by bytes."""
    names = ["path", "entry", "xml", "error"]

    def batch(rows):
        columns = [pa.array(values, pa.string()) for values in zip(*rows)]
        return pa.RecordBatch.from_arrays(columns, names)

    rows, held = [], 0
    for document in documents:
        rows.append(document)
        held += len(document[2] or "")
        if held >= _BYTES_PER_BATCH or len(rows) == _ENTRIES_PER_BATCH:
            yield batch(rows)
            rows, held = [], 0
    if rows:
        yield batch(rows)


def _read_listed(batches):
    """Documents of listed entries, keeping the current archive open."""

    def documents():
        open_path, handle = None, None
        try:
            for batch in batches:
                for entry in batch.to_pylist():
                    if entry["path"] != open_path:
                        if handle is not None:
                            handle.close()
                        handle, open_path = _open(entry["path"]), entry["path"]
                    yield entry["path"], entry["entry"], *_read_document(handle, entry)
        finally:
            if handle is not None:
                handle.close()

    return _document_batches(documents())


def _read_whole(batches):
    """Documents of whole archives, in the order of their directories."""
    names = [part.split()[0] for part in ENTRY_SCHEMA.split(", ")]

    def documents():
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with _open(path) as directory, _open(path) as handle:
                    for values in directory_entries(directory):
                        entry = dict(zip(names, (path, *values)))
                        if entry["entry"].endswith(XML_SUFFIX):
                            yield path, entry["entry"], *_read_document(handle, entry)

    return _document_batches(documents())


def read_entries(entries: DataFrame, partitions: int) -> DataFrame:
    """Entry texts: ``path``, ``entry``, ``xml`` and, where a document is unreadable, ``error``.

    Neighbouring entries of an archive stay together, so reads are near-sequential, while one
    huge archive still spreads over all tasks. The count is explicit: rows are tiny here, and
    sizing partitions by shuffled bytes would put all reading into one task.
    """
    block = F.floor(F.col("offset") / _LOCALITY_BLOCK)
    spread = entries.repartition(partitions, "path", block)
    return spread.sortWithinPartitions("path", "offset").mapInArrow(_read_listed, DOCUMENT_SCHEMA)


def read_archives(
    spark: SparkSession,
    location: str,
    pattern: str = "*.zip",
    bytes_per_task: int = _BYTES_PER_TASK,
) -> DataFrame:
    """All XML documents of the archives at a location.

    Sizes come from the file listing alone. Archives within a task's fair share are read
    without a shuffle; only larger ones are split.
    """
    archives = archive_files(spark, location, pattern)
    tasks = spark.sparkContext.defaultParallelism
    total = archives.agg(F.sum("length")).first()[0] or 0
    share = min(bytes_per_task, total // tasks)
    large = archives.where(F.col("length") > share)
    to_split = large.agg(F.sum("length")).first()[0] or 0
    whole = archives.where(F.col("length") <= share).select("path")
    documents = whole.mapInArrow(_read_whole, DOCUMENT_SCHEMA)
    if to_split == 0:
        return documents
    partitions = max(tasks, -(-to_split // bytes_per_task))
    return documents.unionByName(read_entries(select_xml(list_entries(large)), partitions))
