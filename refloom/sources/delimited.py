"""Delimited and line-oriented text.

All readers work on file splits. ``gz`` files are one split each: read many files, or convert once.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.operators.scans import LINE_LIMIT, by_size, scan
from refloom.operators.setops import union_tagged
from refloom.schemas import text_schema
from refloom.sources.archives import located
from refloom.sources.documents import decode_fallback
from refloom.sources.quoted import read_quoted


def read_positional(
    spark: SparkSession, folders: dict[str, str], key: str, schemas: dict[str, Sequence[str]],
    tag: str | None = None, encoding: str = "UTF-8",
) -> DataFrame:
    """Header-less quoted CSV with the layout of a file key, from one folder per status.

    Files are ``<key>.txt`` or ``<key>_xx.txt``. Short rows are padded with NULL, long rows cut, blank
    rows skipped. With ``tag`` the status of the folder is added. Quoted fields may hold line breaks; files are read by their splits all the
    same. A file that is not valid UTF-8 is Latin-1.
    """
    layout = text_schema(list(schemas[key]))
    parts = {status: read_quoted(spark, f"{path}/{key}{{,_*}}.txt", layout, encoding=encoding) for status, path in folders.items()}
    tagged = union_tagged(parts, tag or "_status")
    return tagged if tag else tagged.drop("_status")


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines as ``value``, each one UTF-8 when valid and Latin-1 otherwise."""
    return spark.read.text(path).select(decode_fallback(F.col("value").cast("binary")).alias("value"))


def read_lines(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """Lines with their place: (file, block, seq, line).

    ``block`` is the offset of the file split and ``seq`` rises inside it, so (block, seq) is the
    order of lines in a file, and a block is never larger than one input split.
    """
    reader = spark.read if glob is None else spark.read.option("pathGlobFilter", glob)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        decode_fallback(F.col("value").cast("binary")).alias("line"),
    )


def split_line(line: str | Column, sep: str) -> Column:
    """Fields of a plainly separated line (quotes stay literal), trimmed."""
    return F.transform(F.split(line, f"\\Q{sep}\\E"), lambda x: F.trim(x))


def fields(parts: str, names: Sequence[str], pad: str | None = "") -> list[Column]:
    """Named columns out of a field array; missing ones padded, surplus ones dropped."""
    missing = F.lit(pad).cast("string")
    return [F.coalesce(F.get(parts, F.lit(i)), missing).alias(n) for i, n in enumerate(names)]


#: Bytes of a file that are looked at first for its first line.
HEAD_BYTES = 1 << 16


def file_heads(spark: SparkSession, path: str | list[str]) -> list[tuple[str, str]]:
    """(file, first line that is not blank) of every file, in file order; only the beginning of each file is read. Blank files are left out.

    They name the columns, so they are known before any row is read.
    """
    files = spark.read.format("binaryFile").load(path).select("path")

    def first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_first_line(name) for name in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.binary())], names=["path", "head"])

    try:
        heads = files.mapInArrow(first_lines, "path string, head binary").select("path", decode_fallback("head").alias("head"))
        rows = heads.filter("head is not null").collect()
    except PySparkException as error:
        if "Unrecognized filesystem" not in str(error):
            raise
        # A store that only Spark opens: the first line in the order of its splits.
        lines = read_lines(spark, path).filter(F.trim("line") != "")
        rows = lines.groupBy(F.col("file").alias("path")).agg(F.min_by("line", F.struct("block", "seq")).alias("head")).collect()
    return sorted((r["path"], r["head"]) for r in rows)


def _first_line(path: str) -> bytes | None:
    system, at = located(path)
    with system.open_input_stream(at) as stream:
        held, size = b"", HEAD_BYTES
        while True:
            more = stream.read(size)
            held, size = held + more, 2 * size
            lines = held.splitlines()
            # The last piece may go on, unless nothing follows.
            for line in lines[: len(lines) if not more else -1]:
                if line.strip():
                    return line
            if not more:
                return None


def body_lines(spark: SparkSession, files: list[str], header: bool) -> DataFrame:
    """Lines that are not blank as ``line``, each file without its first one where that is a header: Spark drops it as it reads the first split.

    Lines are taken whole: separator and quotes are characters that no byte stands for.
    """
    reader = spark.read.schema("value string").options(header=header, sep="\u0100", quote="\u0101", escape="\u0102", encoding="ISO-8859-1", mode="PERMISSIVE")
    return reader.csv(files).select(decode_fallback(F.encode("value", "ISO-8859-1")).alias("line"))


def by_header(parts: str, cells: Column, names: Sequence[str], pad: str | None = "") -> list[Column]:
    """Named columns out of a field array, each at the place that the header cells give it; missing ones padded."""
    missing = F.lit(pad).cast("string")
    place = {n: F.array_position(cells, F.lit(n)) for n in names}
    return [F.when(at > 0, F.coalesce(F.get(parts, (at - 1).cast("int")), missing)).otherwise(missing).alias(n) for n, at in place.items()]


def _by_layout(heads: list[tuple[str, str]]) -> dict[str, list[str]]:
    """Files by their first line, in file order."""
    groups: dict[str, list[str]] = {}
    for file, head in heads:
        groups.setdefault(head, []).append(file)
    return groups


def read_delimited(
    spark: SparkSession, path: str | list[str], sep: str, pad: str | None = "", names: Sequence[str] | None = None
) -> DataFrame:
    """Plainly separated text with a header: fields trimmed, short rows padded, long rows cut, blank rows skipped.

    Every file is read by its own first line, whatever the order of its columns; only that line is dropped. Columns are those of
    all headers, or ``names``. Files of one header are read together, once, by the places it gives its columns.
    """
    groups = _by_layout(file_heads(spark, path))
    cells = {head: [h.strip() for h in head.split(sep)] for head in groups}
    known = list(names or dict.fromkeys(h for head in cells.values() for h in head))
    missing = F.lit(pad).cast("string")
    tables = []
    for head, files in groups.items():
        at = {name: cells[head].index(name) for name in known if name in cells[head]}
        rows = body_lines(spark, files, header=True).select(split_line("line", sep).alias("p"))
        tables.append(rows.select(*[(F.coalesce(F.get("p", F.lit(at[n])), missing) if n in at else missing).alias(n) for n in known]))
    return reduce(DataFrame.unionByName, tables) if tables else spark.createDataFrame([], text_schema(known))


def fold_fields(parts: str, width: int, sep: str = "|") -> Column:
    """Field array of at most ``width`` items, surplus items joined into the last one."""
    tail = F.array_join(F.slice(parts, width, F.greatest(F.size(parts), F.lit(width))), sep)
    return F.when(F.size(parts) > width, F.concat(F.slice(parts, 1, width - 1), F.array(tail))).otherwise(F.col(parts))


def read_folded(
    spark: SparkSession, path: str | list[str], names: Sequence[str], sep: str = "\t", fold: str = "|",
    synonyms: str = "synonyms",
) -> DataFrame:
    """Tab separated concepts without a header; surplus fields go to the last column, first synonym is the name."""
    lines = text_lines(spark, path).filter("value <> ''")
    rows = lines.select(F.split("value", f"\\Q{sep}\\E").alias("p"))
    rows = rows.select(F.transform(fold_fields("p", len(names), fold), lambda x: F.trim(x)).alias("p"))
    return rows.select(*fields("p", names)).withColumn("preferred_name", first_part(synonyms, fold))


def first_part(packed: str | Column, sep: str = "|") -> Column:
    """First non-empty part of a packed list, ``''`` if none."""
    parts = F.filter(split_line(packed, sep), lambda x: x != "")
    return F.coalesce(F.get(parts, F.lit(0)), F.lit(""))


def read_mapping(spark: SparkSession, path: str | list[str], sep: str, names: Sequence[str]) -> DataFrame:
    """Two-column map: blank and ``#`` lines skipped, empty parts dropped, rows with fewer parts left out."""
    lines = text_lines(spark, path).filter((F.trim("value") != "") & ~F.trim("value").startswith("#"))
    parts = F.filter(split_line("value", sep), lambda x: x != "")
    rows = lines.select(parts.alias("p")).filter(F.size("p") >= len(names))
    return rows.select(*fields("p", names))


# Bulk identifier files by a word in the file name, and the columns they get.
BULK_COLUMNS = {"SMILES": "SMILES", "Parent": "Parent_CID", "InChI-Key": "InChIKey"}


def read_bulk_mapping(spark: SparkSession, path: str) -> DataFrame:
    """``id <tab> value`` lines; the value column is named after the file. Lines with one field are dropped."""
    name = next((c for word, c in BULK_COLUMNS.items() if word in path.rsplit("/", 1)[-1]), "Value")
    parts = split_line("value", "\t")
    return text_lines(spark, path).select(parts.alias("p")).filter(F.size("p") >= 2).select(*fields("p", ["CID", name]))


# Words that mark a first cell as a header.
HEADER_WORDS = ("code", "name", "id", "concept", "preferred")


def read_maybe_header(spark: SparkSession, path: str | list[str], sep: str = "\t") -> DataFrame:
    """Text tables that may lack a header; as wide as the widest row.

    A first cell with a header word makes a header, in each file by itself. Else columns are ``column_i``, with
    ``ncit_code`` and ``preferred_name`` for the first two; files with and without header are read by place. The width takes one pass over the
    text, as any inferred layout does.
    """
    groups: dict[bool, list[str]] = {}
    titles: list[list[str]] = []
    for file, head in file_heads(spark, path):
        cells = [h.strip() for h in head.split(sep)]
        titled = any(w in cells[0].lower() for w in HEADER_WORDS)
        titles += [cells] if titled else []
        groups.setdefault(titled, []).append(file)
    rows = [body_lines(spark, files, header=titled).select(F.split("line", f"\\Q{sep}\\E").alias("p")) for titled, files in groups.items()]
    if not rows:
        return spark.createDataFrame([], text_schema(["column_1"]))
    rows = reduce(DataFrame.unionByName, rows)
    width = max(rows.select(F.max(F.size("p"))).head()[0] or 0, *map(len, titles), 1)
    names = [h or f"col_{i + 1}" for i, h in enumerate(titles[0])] if titles else [f"column_{i + 1}" for i in range(width)]
    if not titles and width >= 2:
        names[:2] = ["ncit_code", "preferred_name"]
    names += [f"column_{i + 1}" for i in range(len(names), width)]
    return rows.select(F.transform("p", lambda x: F.trim(x)).alias("p")).select(*fields("p", names))


def read_sections(spark: SparkSession, path: str | list[str], is_header: Column) -> DataFrame:
    """Lines of files that hold several tables: (file, section, block, seq, line, is_header).

    A section starts at each header line and is numbered from 1; lines before the first header and
    lines with only commas are dropped.
    """
    return number_sections(read_lines(spark, path), is_header)


def number_sections(lines: DataFrame, is_header: Column, line_limit: int = LINE_LIMIT) -> DataFrame:
    """The same for lines that already carry their place."""
    lines = lines.withColumn("is_header", is_header)

    def number(rows: DataFrame, blocks: bool) -> DataFrame:
        return scan(rows, ["file"], "block", ["seq"], sums={"section": F.col("is_header").cast("long")}, blocks=blocks)

    numbered = by_size(lines, ["file"], number, line_limit)
    return numbered.filter((F.col("section") > 0) & (F.trim(F.regexp_replace("line", ",", "")) != ""))


def section_table(sections: DataFrame, number: int) -> DataFrame:
    """One section of every file as a table. Each file's own header line names its columns; quoted commas are kept.

    Where all files have one header, nothing is looked up by file.
    """
    rows = sections.filter(F.col("section") == number)
    heads = rows.filter("is_header").groupBy("file").agg(F.min_by("line", F.struct("block", "seq")).alias("header"))
    different = [r["header"] for r in heads.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()]
    titles = [next(csv.reader([h])) for h in different]
    width = 1 + max((h.count(",") for h in different), default=0)
    ddl = ", ".join(f"c{i} string" for i in range(width))
    names = list(dict.fromkeys(x for t in titles for x in t if x))

    def cells(line: str) -> Column:
        return F.transform(F.array(F.from_csv(line, ddl)), lambda r: F.array(*[r[f"c{i}"] for i in range(width)]))[0]

    body = rows.filter("not is_header")
    if len(titles) == 1:
        return body.select(cells("line").alias("p")).select(*[F.get("p", F.lit(titles[0].index(n))).alias(n) for n in names])
    body = body.join(heads, "file")
    return body.select(cells("line").alias("p"), cells("header").alias("h")).select(*by_header("p", F.col("h"), names, None))
