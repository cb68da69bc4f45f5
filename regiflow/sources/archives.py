"""ZIP archives of registry text (SRC2), read and written on any file system.

Reading: the bytes of an archive come as a stream (``byte_stream``); its first member is
inflated block by block and cut into records, which go on as raw lines.  The lines are
parsed by the JVM (``lines.parse_lines``), like text files.  A record may be of any
length, a record with a wrong field count is quarantined by itself, and whatever makes an
archive unreadable (no archive, damaged or encrypted member, wrong checksum) becomes one row
with the reason in ``_corrupt_record`` and an empty ``member``, so the others go on.  An
archive without members, or whose member is empty, yields nothing.

Archives are not splittable: one task inflates one archive (the registry ships numbered
parts), but the lines can be spread before they are parsed (``spread_archive_rows``).

Writing (``write_archives``): one archive per ``source_file``, its rows deflated in a task
and written by Spark's text writer, so to any file system.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiflow.schema import LAYOUTS
from regiflow.sources.byte_stream import SEPARATOR, byte_rows, name_of, per_file
from regiflow.sources.csv import CORRUPT
from regiflow.sources.lines import parse_lines

UNREADABLE = "not a readable archive"
ZIP_GLOB = "*.[zZ][iI][pP]"
BLOCK_BYTES = 1 << 20
LINES = "source_file string, member string, line string, error string"

# Fixed values of the ZIP format: signatures, sizes of fixed parts, flag bits, methods
LOCAL, CENTRAL, END, DESCRIPTOR = b"PK\x03\x04", b"PK\x01\x02", b"PK\x05\x06", b"PK\x07\x08"
LOCAL_BYTES, CENTRAL_BYTES, END_BYTES = 30, 46, 22
ENCRYPTED, SIZES_FOLLOW, UTF8_NAMES = 0x1, 0x8, 0x800
STORED, DEFLATED = 0, 8


class BadArchive(Exception):
    pass


class FirstMember:
    """The first member of an archive whose bytes are fed in order; ``feed`` yields its plain bytes."""

    def __init__(self):
        self.name, self.head, self.done, self.empty = "", b"", False, False
        self.method = self.flags = self.crc = self.left = None
        self.inflate, self.sum, self.tail = None, 0, b""

    def feed(self, data: bytes):
        if self.done or not data:
            return
        if self.method is None:
            self.head += data
            data = self._header()
            if self.method is None:
                return
        if self.method == DEFLATED:
            while data and not self.inflate.eof:
                plain = self.inflate.decompress(data, BLOCK_BYTES)
                data = self.inflate.unconsumed_tail
                self.sum = zlib.crc32(plain, self.sum)
                yield plain
            if self.inflate.eof:
                self._after((self.inflate.unused_data if not self.tail else b"") + data)
        else:
            plain, data = data[:self.left], data[self.left:]
            self.left -= len(plain)
            self.sum = zlib.crc32(plain, self.sum)
            yield plain
            if not self.left:
                self._after(data)

    def _header(self) -> bytes:
        h = self.head
        if len(h) < 4:
            return b""
        if h[:4] == END:
            self.done = self.empty = True
            return b""
        if h[:4] != LOCAL:
            raise BadArchive("not a zip archive")
        if len(h) < LOCAL_BYTES:
            return b""
        _, flags, method, _, _, crc, packed, _, n, extra = struct.unpack("<HHHHHIIIHH", h[4:LOCAL_BYTES])
        if len(h) < LOCAL_BYTES + n + extra:
            return b""
        self.name = h[LOCAL_BYTES:LOCAL_BYTES + n].decode("utf-8" if flags & UTF8_NAMES else "cp437", "replace")
        if flags & ENCRYPTED:
            raise BadArchive("its first member is encrypted")
        if method not in (STORED, DEFLATED) or method == STORED and flags & SIZES_FOLLOW and packed == 0:
            raise BadArchive(f"compression method {method} of its first member is not supported")
        self.method, self.flags, self.crc, self.left = method, flags, crc, packed
        self.inflate = zlib.decompressobj(-15) if method == DEFLATED else None
        self.head = b""
        rest = h[LOCAL_BYTES + n + extra:]
        if method == STORED and not packed:
            self._after(rest)
            return b""
        return rest

    def _after(self, data: bytes) -> None:
        """The checksum is in the header, or in a descriptor behind the member."""
        if self.flags & SIZES_FOLLOW:
            self.tail += data
            if len(self.tail) < 8:
                return
            at = 4 if self.tail[:4] == DESCRIPTOR else 0
            self.crc = struct.unpack("<I", self.tail[at:at + 4])[0]
        self.done = True
        if self.sum != self.crc:
            raise BadArchive("its first member's checksum is wrong")

    def close(self) -> None:
        if not self.done:
            raise BadArchive("not a zip archive" if self.method is None else "its first member ends too early")


BLANK = " \t\n\r\x0b\x0c"


class Records:
    """Cuts bytes into lists of lines, whatever their length; with ``multi_line`` a quoted line break does not end one."""

    def __init__(self, multi_line: bool = False):
        self.multi_line, self.parts, self.open = multi_line, [], []

    def feed(self, plain: bytes) -> list[str]:
        cut = plain.rfind(b"\n")
        if cut < 0:
            self.parts.append(plain)
            return []
        whole, self.parts = b"".join([*self.parts, plain[:cut]]), [plain[cut + 1:]]
        return self._lines(whole)

    def _lines(self, whole: bytes) -> list[str]:
        lines = whole.decode("latin-1").split("\n")
        if self.multi_line:
            lines = list(self._joined(lines))
        return [x.removesuffix("\r") for x in lines if x.strip(BLANK)]

    def _joined(self, lines: list[str]):
        for line in lines:
            self.open.append(line)
            if sum(x.count('"') for x in self.open) % 2 == 0:
                yield "\n".join(self.open)
                self.open = []

    def close(self) -> list[str]:
        rest, self.parts = b"".join(self.parts), []
        lines = self._lines(rest) if rest else []
        return [*lines, "\n".join(self.open)] if self.open else lines


class _Lines:
    """One archive as runs of rows (source_file, member, lines, error)."""

    def __init__(self, path: str, multi_line: bool):
        self.name, self.zip, self.records, self.failed = name_of(path), FirstMember(), Records(multi_line), False

    def _rows(self, lines: list[str]):
        if lines:
            yield (self.name, self.zip.name, lines, None), sum(map(len, lines)) + 64 * len(lines)

    def _error(self, e: Exception):
        self.failed = True
        why = f"{e}: {self.name}" if str(e) == "not a zip archive" else f"{UNREADABLE}: {self.name}: {e}"
        return (self.name, "", [None], why), len(why)

    def feed(self, data: bytes):
        if self.failed or self.zip.done:
            return
        try:
            for plain in self.zip.feed(data):
                yield from self._rows(self.records.feed(plain))
        except (BadArchive, zlib.error) as e:
            yield self._error(e)

    def close(self):
        if self.failed:
            return
        try:
            self.zip.close()
        except BadArchive as e:
            yield self._error(e)
            return
        yield from self._rows(self.records.close())


def _lines_batch(runs: list) -> pa.RecordBatch:
    n = [len(r[2]) for r in runs]
    own = lambda i: pa.array([r[i] for r in runs], pa.string()).take(pa.array(np.repeat(np.arange(len(runs)), n)))
    lines = pa.array(list(chain.from_iterable(r[2] for r in runs)), pa.string())
    return pa.RecordBatch.from_arrays([own(0), own(1), lines, own(3)], ["source_file", "member", "line", "error"])


def archive_lines(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    """(source_file, member, line, error) of the archives' first members, in one task an archive."""
    return byte_rows(spark, paths, None if isinstance(paths, list) else ZIP_GLOB).mapInArrow(
        lambda batches: per_file(batches, lambda p: _Lines(p, multi_line), _lines_batch), LINES)


def parsed(lines: DataFrame, entity: str) -> DataFrame:
    """Archive lines as entity columns, ``_corrupt_record``, ``source_file`` and ``member``; errors as corrupt records."""
    out = parse_lines(lines, entity, keep=("source_file", "member", "error"))
    return out.withColumn(CORRUPT, F.coalesce("error", CORRUPT)).select(*LAYOUTS[entity], CORRUPT, "source_file", "member")


def read_zip(spark: SparkSession, paths: str | list[str], entity: str, multi_line: bool = False, cores: int | None = None) -> DataFrame:
    """Archives (globs, folders or files) as raw entity text; ``cores``: lines are spread over so many before parsing."""
    if entity not in LAYOUTS:
        raise ValueError(f"unknown entity {entity!r}")
    lines = archive_lines(spark, paths, multi_line)
    if cores:
        lines = spread_archive_rows(lines, len(paths) if isinstance(paths, list) else 1, cores)
    return parsed(lines, entity)


def spread_archive_rows(df: DataFrame, archives: int, cores: int | None = None) -> DataFrame:
    """Redistribute archive rows over the cluster's cores.

    An archive is one input partition, so parsing, the regex cleaning and the Parquet
    write after the read would run with as many tasks as archives (ten parts
    of an entity -> ten tasks on a thousand executors).  Rows are hashed into
    ``cores // archives`` buckets per archive and shuffled on
    ``(source_file, bucket)``: every core gets work, and each write task still
    holds rows of about one archive, so a ``source_file`` partition folder gets
    about as many files as buckets.  The bucket is a hash of the row's text,
    so a recomputed task sends every row to the same place.
    """
    cores = cores or df.sparkSession.sparkContext.defaultParallelism
    per_archive = max(1, cores // max(1, archives))
    if archives * per_archive <= 1:
        return df
    bucket = F.pmod(F.xxhash64(*df.columns), F.lit(per_archive))
    return df.repartition(archives * per_archive, F.col("source_file"), bucket)


# ---------------------------------------------------------------- inventory

class _Directory:
    """Number and first name of an archive's members, from the directory at its end."""

    KEEP = 1 << 20

    def __init__(self, path: str):
        self.name, self.tail = name_of(path), b""

    def feed(self, data: bytes):
        self.tail = (self.tail + data)[-self.KEEP:]
        return iter(())

    def close(self):
        at = self.tail.rfind(END)
        if at < 0 or len(self.tail) - at < END_BYTES:
            yield (self.name, None, None, "corrupt"), 0
            return
        n, size = struct.unpack("<HI", self.tail[at + 10:at + 16])
        begin, first = at - size, None
        if n and begin >= 0 and self.tail[begin:begin + 4] == CENTRAL:
            k, = struct.unpack("<H", self.tail[begin + 28:begin + 30])
            first = self.tail[begin + CENTRAL_BYTES:begin + CENTRAL_BYTES + k].decode("utf-8", "replace")
        damaged = n and begin >= 0 and first is None
        yield (self.name, None if damaged else n, first, "corrupt" if damaged else "empty" if not n else "multiple_members" if n > 1 else "ok"), 0


def archive_inventory(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Archive health per file: members, first member, empty / corrupt flags (DQ6); a task keeps the last megabyte of a file."""
    def to_batch(rows):
        kinds = (pa.string(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["file_name", "members", "first_member", "status"])

    rows = byte_rows(spark, path, None if isinstance(path, list) else ZIP_GLOB)
    return rows.mapInArrow(lambda b: per_file(b, _Directory, to_batch), "file_name string, members long, first_member string, status string")


# ---------------------------------------------------------------- writing

class _Zip:
    """The bytes of an archive with one deflated member, fed in pieces.

    Its comment is the separator that the text writer puts behind the last row.
    """

    def __init__(self, member: str):
        self.member, self.deflate = member.encode(), zlib.compressobj(6, zlib.DEFLATED, -15)
        self.sum = self.plain = self.packed = 0

    def start(self) -> bytes:
        return LOCAL + struct.pack("<HHHHHIIIHH", 20, SIZES_FOLLOW | UTF8_NAMES, DEFLATED, 0, 0x21, 0, 0, 0, len(self.member), 0) + self.member

    def feed(self, plain: bytes) -> bytes:
        self.sum, self.plain = zlib.crc32(plain, self.sum), self.plain + len(plain)
        out = self.deflate.compress(plain)
        self.packed += len(out)
        return out

    def end(self) -> bytes:
        last = self.deflate.flush()
        self.packed += len(last)
        if max(self.plain, self.packed) >= 0xFFFFFFFF:
            raise ValueError("a member of 4 GB and more: write more parts")
        begin = LOCAL_BYTES + len(self.member)
        sizes = struct.pack("<III", self.sum, self.packed, self.plain)
        central = CENTRAL + struct.pack("<HHHHHH", 20, 20, SIZES_FOLLOW | UTF8_NAMES, DEFLATED, 0, 0x21) + sizes + struct.pack(
            "<HHHHHII", len(self.member), 0, 0, 0, 0, 0, 0) + self.member
        return last + DESCRIPTOR + sizes + central + END + struct.pack("<HHHHIIH", 0, 0, 1, 1, len(central), begin + self.packed + 16, len(SEPARATOR))


class _Cut:
    """Rows between separators out of bytes that come in pieces; each byte is looked at once."""

    def __init__(self):
        self.held: list[bytes] = []

    def feed(self, data: bytes) -> list[bytes]:
        if not data:
            return []
        out = []
        if self.held and self.held[-1].endswith(SEPARATOR[:1].encode()) and data.startswith(SEPARATOR[1:].encode()):
            out.append(b"".join(self.held)[:-1])             # a separator across two pieces
            self.held, data = [], data[1:]
        first, *rest = data.split(SEPARATOR.encode())
        self.held.append(first)
        for part in rest:
            out.append(b"".join(self.held))
            self.held = [part]
        self.held = [x for x in self.held if x]
        return out

    def close(self) -> bytes:
        return b"".join(self.held)


def _packed(batches):
    """Sorted (source_file, line) rows -> rows of archive bytes between separators."""
    name, archive, rows, pos = None, None, None, 0
    out: list[tuple[str, int, bytes]] = []

    def put(data: bytes, last: bool = False):
        nonlocal pos
        for row in [*rows.feed(data), *([rows.close()] if last else [])]:
            out.append((name, pos, row))
            pos += 1

    def batch():
        rows, out[:] = list(out), []
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                           pa.array([r[2] for r in rows], pa.binary())], ["source_file", "pos", "bytes"])

    for b in batches:
        at = 0
        # a batch's lines of one archive are deflated together
        for file, run in groupby(b.column("source_file").to_pylist()):
            n = sum(1 for _ in run)
            if archive is None or file != name:
                if archive is not None:
                    put(archive.end(), True)
                name, archive, rows, pos = file, _Zip(file.rsplit(".", 1)[0] + ".CSV"), _Cut(), 0
                put(archive.start())
            put(archive.feed(("\n".join(b.column("line").slice(at, n).to_pylist()) + "\n").encode("latin-1", "replace")))
            at += n
        if out:
            yield batch()
    if archive is not None:
        put(archive.end(), True)
        yield batch()


def write_archives(lines: DataFrame, folder: str) -> None:
    """(source_file, line) as ZIP archives ``folder/source_file=<name>/part-*``, readable by any ZIP program.

    A part is one task's work.  Characters beyond ISO-8859-1 become ``?``.
    """
    dealt = lines.select("source_file", "line").repartition("source_file").sortWithinPartitions("source_file", "line")
    rows = dealt.mapInArrow(_packed, "source_file string, pos long, bytes binary").sortWithinPartitions("source_file", "pos")
    (rows.select("source_file", F.col("bytes").cast("string").alias("value")).write.mode("overwrite")
     .option("lineSep", SEPARATOR).partitionBy("source_file").text(folder))
