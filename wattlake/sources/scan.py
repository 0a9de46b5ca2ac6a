"""Plan of a bronze scan: which drops are read together, and how.

A drop's separator and width stand in its own header line only. The planner reads the first bytes of each file through
the file system (like a listing: nothing of a file's body comes to the driver), groups the files by (encoding,
separator, width) and gives each group one text scan. A text scan is split at line ends, so a file of any size is
read by as many tasks as it has blocks; UTF-16 is split at the two bytes of its line end and decoded inside the plan.
"""

from __future__ import annotations

import codecs
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.writers import hadoop_path

HEAD_BYTES = 1 << 16
READERS = 16            # files whose headers are read side by side

# --- fixed values -----------------------------------------------------------
# separators a drop may use, in the order that decides ties
SEPARATORS = ["\t", ";", ","]
BYTE_ORDER_MARKS = [(codecs.BOM_UTF8, "UTF-8"), (codecs.BOM_UTF16_LE, "UTF-16LE"), (codecs.BOM_UTF16_BE, "UTF-16BE")]
# ---------------------------------------------------------------------------
LINE_END = {"UTF-16LE": "\n\u0000", "UTF-16BE": "\u0000\n"}       # as bytes; other encodings have ASCII line ends


@dataclass
class Group:
    """Files that one scan reads: ``headers`` are their header lines."""

    encoding: str
    sep: str
    width: int
    paths: list[str] = field(default_factory=list)
    headers: set[str] = field(default_factory=set)


def list_files(spark: SparkSession, path, glob: str = "*.csv*") -> list[str]:
    """Paths below ``path`` (a folder, file, glob or list of them), from the listing alone: contents are not read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return [r[0] for r in rows.select("path").collect()]


def read_header(spark: SparkSession, path: str, encoding: str) -> tuple[str, str] | None:
    """(encoding, first line that is not blank) of a file; None for a file without one. Malformed text is an error."""
    p, fs = hadoop_path(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    stream = codec.createInputStream(stream) if codec is not None else stream
    try:
        data = bytes(stream.readNBytes(HEAD_BYTES))
        mark, found = next(((m, e) for m, e in BYTE_ORDER_MARKS if data.startswith(m)), (b"", encoding))
        found = "UTF-16BE" if found.upper() == "UTF-16" else found            # the byte order without a mark
        reader, text, data = codecs.getincrementaldecoder(found)(), "", data[len(mark):]
        while True:
            text += reader.decode(data, final=not data)
            lines = re.split("\r\n|\n|\r", text)
            line = next((x for x in (lines[:-1] if data else lines) if x.strip()), None)
            if line is not None or not data:
                return (found, line) if line is not None else None
            data = bytes(stream.readNBytes(HEAD_BYTES))
    finally:
        stream.close()


def split_line(line: str, sep: str) -> list[str]:
    return re.findall(_quoted(sep), sep + line) if '"' in line else line.split(sep)


def plan(spark: SparkSession, paths: list[str], encoding: str, sep: str | None = None, by_header: bool = False) -> list[Group]:
    """Groups of files that can be read together; empty files are in none. ``by_header``: a group has one header."""
    groups: dict = defaultdict(list)
    with ThreadPoolExecutor(READERS) as pool:
        heads = pool.map(lambda p: read_header(spark, p, encoding), paths)
        for path, head in zip(paths, heads, strict=True):
            if head is not None:
                seps = [sep] if sep else SEPARATORS
                own = max(seps, key=lambda s: head[1].count(s))             # the first of the most frequent
                groups[head[0], own, len(split_line(head[1], own)), head[1] if by_header else ""].append((path, head[1]))
    return [Group(*key[:3], [p for p, _ in files], {h for _, h in files}) for key, files in sorted(groups.items())]


def _quoted(sep: str) -> str:
    """A cell behind its separator: quoted text, or all up to the next separator."""
    return rf'{re.escape(sep)}("(?:[^"]|"")*"|[^{re.escape(sep)}]*)'


def cells(line: Column, sep: str) -> Column:
    """Cells of a line; quotes around a cell go, a separator inside quotes stays."""
    unquote = lambda c: F.when(c.rlike('^".*"$'), F.replace(c.substr(F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))).otherwise(c)
    quoted = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(_quoted(sep)), F.lit(1))
    return F.when(line.contains('"'), F.transform(quoted, unquote)).otherwise(F.split(line, re.escape(sep)))


def lines(spark: SparkSession, group: Group, quotes: bool = True) -> DataFrame:
    """(file_path, _line, _cells) of a group's data lines: without blank lines and header lines.

    ``quotes=False`` leaves quotes in the cells, as any other character.

    A line that repeats a header is no reading, wherever it stands. Text that the encoding does not have is an error.
    """
    reader = spark.read.option("recursiveFileLookup", True)
    if group.encoding in LINE_END:
        reader = reader.option("lineSep", LINE_END[group.encoding])
    df = reader.text(group.paths).select(F.col("_metadata.file_path").alias("file_path"), "value")
    value = F.col("value")
    text = F.validate_utf8(value) if group.encoding.upper() == "UTF-8" else F.decode(value.cast("binary"), group.encoding)
    text = F.regexp_replace(text, "^\ufeff", "")
    if group.encoding in LINE_END:
        df = df.select("file_path", F.explode(F.split(text, "\r\n|\n|\r")).alias("_line"))
    else:
        df = df.select("file_path", text.alias("_line"))
    df = df.where((F.trim("_line") != "") & ~F.col("_line").isin(*sorted(group.headers)))
    return df.withColumn("_cells", cells(F.col("_line"), group.sep) if quotes else F.split("_line", re.escape(group.sep)))
