"""Line-oriented trial pages to records.

A record starts at a ``Summary`` line. Labelled lines give fields, other lines continue the field
before them, and section lines prefix the labels that follow. Files may be of any size: along the
lines of an ordinary one state runs in one window, in larger ones in a window per block, from block
to block by one row each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.functions.text import strip_space
from refloom.operators.aggregate import ordered_list
from refloom.operators.scans import LINE_LIMIT
from refloom.operators.skew import GROUP_LIMIT, hot_groups, join_keys, split_hot
from refloom.session import materialize

# The line formats of the source.
RECORD_START = "Summary"
RECORD_ID = "EudraCT Number"
SKIPPED_LINE = r"^(=.*|PAGE \d+)$"
HEADING = r"^[A-P]\.\s+"
SPONSOR = r"(?i)^Sponsor\s+(\d+)$"
PRODUCT = r"(?i)^D\.IMP:\s*(\d+)$"
PLACEBO = r"(?i)^D\.8\s+Placebo:\s*(\d+)$"
LABELLED = r"^([A-Z0-9a-z_#'.\-\s()/&\t]+):\s*(.*)$"
NUMBERED_FIELD = (
    r"(?i)^[A-P]\.(\d+|imp|placebo)?(\.\d+)*(\s+and\s+[A-P]\.(\d+|imp|placebo)?(\.\d+)*)*(\s+|$)"
)
SUMMARY_FIELDS = (
    "eudract number", "sponsor's protocol code number", "national competent authority",
    "clinical trial type", "trial status",
    "date on which this record was first entered in the eudract database", "link",
)
SUMMARY_FIELD = f"(?i)^({'|'.join(SUMMARY_FIELDS)})"
FIRST_COLUMNS = ("EudraCT Number", "Link", "National Competent Authority", "Trial Status")


def _is_standard(name: Column) -> Column:
    # A lettered number has a dot as its second character; most other names are told by that, without the expression.
    return ((F.substring(name, 2, 1) == ".") & name.rlike(NUMBERED_FIELD)) | name.rlike(SUMMARY_FIELD)


def is_standard_field(label: Column) -> Column:
    """A label that names a field of the form: a known summary field or a lettered number.

    Text before the first ``" - "`` is a section name and not looked at.
    """
    # Nothing is replaced in a label without it.
    return F.when(F.contains(label, F.lit(" - ")), _is_standard(F.regexp_replace(label, r"^.*? - ", ""))).otherwise(_is_standard(label))


def _section_event(line: Column) -> Column:
    """Name of the section a line opens, ``''`` if it closes one, NULL if neither."""
    event = F.when(line == RECORD_START, F.lit(""))
    # Every pattern stands behind a plain look at the first characters, which it needs as well.
    lettered = F.substring(line, 2, 1) == "."
    event = event.when(lettered & line.rlike(HEADING), F.lit(""))
    for fits, pattern, name in ((_is_sponsor(line), SPONSOR, "Sponsor "), (lettered & line.rlike(PRODUCT), PRODUCT, "IMP "), (lettered & line.rlike(PLACEBO), PLACEBO, "Placebo ")):
        event = event.when(fits, F.concat(F.lit(name), F.regexp_extract(line, pattern, 1)))
    return event


def _stripped(line: Column) -> Column:
    # Lines that begin and end with a visible ASCII character, which are most of them, have nothing to strip.
    ends = F.ascii(line).between(33, 126) & F.ascii(F.substring(line, -1, 1)).between(33, 126)
    return F.when(ends, line).otherwise(strip_space(line))


def _is_sponsor(line: Column) -> Column:
    return F.substring(line, 1, 1).isin("S", "s") & line.rlike(SPONSOR)


def _is_silent(line: Column) -> Column:
    """Lines that are part of no field."""
    return (line == RECORD_START) | _is_sponsor(line)


def _marked(text: DataFrame) -> DataFrame:
    """What a line tells by itself: the section it opens or closes, the name before its colon (``''`` without one) and whether that names a field, outside and inside a section."""
    line, name = F.col("line"), F.col("_name")
    named = F.when(F.contains(line, F.lit(":")), F.trim(F.regexp_extract(line, LABELLED, 1)))
    text = text.withColumns({"_event": _section_event(line), "_name": F.coalesce(named, F.lit(""))})
    text = text.withColumn("_plain", (name != "") & is_standard_field(name))
    inside = F.when(F.contains(name, F.lit(" - ")), _is_standard(name)).otherwise(F.col("_plain"))
    return text.withColumn("_inside", inside)


def _value(line: Column, head: Column) -> Column:
    return F.when(head, F.trim(F.regexp_extract(line, LABELLED, 2))).otherwise(line)


def _titled(section: Column, name: Column) -> Column:
    return F.when((section != "") & (name != ""), F.concat(section, F.lit(" - "), name)).otherwise(name)


def lines_to_fields(lines: DataFrame, limit: int = GROUP_LIMIT, line_limit: int = LINE_LIMIT) -> DataFrame:
    """(file, block, seq, line) to (file, record, label, part, value).

    A ``Summary`` line ends a record only when the record number was seen since the last one; lines
    before that run on into the next record, and a last record without a number is dropped. A
    section never reaches past a ``Summary`` line. For a repeated label the last value counts.
    """
    def text(rows: DataFrame) -> DataFrame:
        rows = rows.select("file", "block", "seq", _stripped(F.col("line")).alias("line"))
        heading = (F.col("line").startswith("=") | F.col("line").startswith("PAGE ")) & F.col("line").rlike(SKIPPED_LINE)
        return rows.filter((F.col("line") != "") & ~heading)

    # Lines that are skipped count for the size of a file, so that they need not be looked at to find it.
    hot = hot_groups(lines, ["file"], line_limit)
    if hot is None:
        return _within_files(text(lines), limit)
    cold, warm = split_hot(lines, ["file"], hot)
    return _within_files(text(cold), limit).unionByName(_across_blocks(text(warm), limit))


def _within_files(text: DataFrame, limit: int) -> DataFrame:
    """Fields of files of ordinary size. The lines move once, by file, and are sorted there once for all running values."""
    line, name, section = F.col("line"), F.col("_name"), F.col("_section")
    # Files are told apart by a number first when sorted; their names often begin alike.
    text = _marked(text.repartition("file").withColumn("_hash", F.xxhash64("file")))
    here = Window.partitionBy("_hash", "file").orderBy("block", "seq")
    upto, prior = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    text = text.withColumn("_section", F.coalesce(F.last("_event", ignorenulls=True).over(upto), F.lit("")))
    place = ["_hash", "file", "block", "seq", "line"]
    label = F.when(F.when(section != "", F.col("_inside")).otherwise(F.col("_plain")), _titled(section, name))
    text = text.select(*place, label.alias("label"))
    mark = F.when(line == RECORD_START, F.lit(False)).when(F.col("label") == RECORD_ID, F.lit(True))
    text = text.withColumns({
        "field": F.sum(F.col("label").isNotNull().cast("long")).over(upto), "_numbered": F.last(mark, ignorenulls=True).over(prior),
    })
    closes = (line == RECORD_START) & F.coalesce("_numbered", F.lit(False))
    text = text.withColumn("record", F.sum(closes.cast("long")).over(upto)).filter(~_is_silent(line))
    entry = F.struct("block", "seq", "label", _value(line, F.col("label").isNotNull()).alias("value"))
    keys = ["_hash", "file", "record"]
    rows = text.groupBy(*keys, "field").agg(F.sort_array(F.collect_list(entry)).alias("_lines"))
    rows = rows.select(*keys, "field", F.col("_lines")[0]["label"].alias("label"), F.transform("_lines", lambda x: x["value"]).alias("_lines"))
    found = _last_fields(rows.filter("label is not null"), [*keys, "label"])
    found = found.withColumn("_numbered", F.max(F.col("label") == RECORD_ID).over(Window.partitionBy(*keys))).filter("_numbered")
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_lines") - 1) / limit).cast("int")),
        lambda i: F.array_join(F.slice("_lines", i * limit + 1, limit), " "),
    )
    found = found.select("file", "record", "label", F.posexplode(parts).alias("part", "value"))
    return found.select("file", "record", "label", F.col("part").cast("long"), "value")


def _across_blocks(text: DataFrame, limit: int) -> DataFrame:
    """The same for oversized files, whose records and fields may be of any size.

    The lines move once, by block. What a block ends with is carried to the later ones by one row per block, which
    also finds the lines where they are; then what each block has of a field moves once, by label.
    """
    # A structure is equal to another one with the same NULLs in it, so blocks without a name are joined as well.
    text = text.select(F.struct("file", "block").alias("_at"), "seq", "line").repartition("_at")
    rows = _states(text.withColumn("_hash", F.xxhash64("_at")))
    carried = _carried(rows.filter("_end"))
    rows = rows.join(carried.hint("shuffle_hash"), "_at")
    before = {n: F.col(f"_in.{n}") for n in ("section", "lines", "numbered", "records")}
    record = before["records"] + F.col("_records") + _closes(before).cast("long")
    rows = rows.withColumn("record", record).filter(F.col("record") < F.col("_in.kept"))
    rows = _with_field(rows, before).withColumn("_field", F.coalesce("_field", "_in.field"))
    # Of a label that comes again in the block only the last field can count.
    found = _last_fields(_pieces(rows, before, limit), ["_hash", "_at", "record", "label"])
    keys = ["file", "record", "label", "part"]
    found = found.select("_at.file", "_at.block", "record", "label", "part", "field", "value").repartition(*keys)
    texts = F.sort_array(F.collect_list(F.struct("block", "value")))
    found = found.groupBy(*keys, "field").agg(F.array_join(F.transform(texts, lambda x: x["value"]), " ").alias("value"))
    # Further parts of a field are few. They count if their field does, which its first part tells.
    found = materialize(_last_fields(found, keys), "fields")
    first, more = found.filter("part = 0"), found.filter("part > 0")
    if more.isEmpty():
        return first.select(*keys, "value")
    more = join_keys(more, first.select("file", "record", "label", "field"), ["file", "record", "label", "field"], "left_semi")
    return first.unionByName(more).select(*keys, "value")


def _states(text: DataFrame) -> DataFrame:
    """Running state of every line among the lines of its block.

    Whether a section is open at the first line is not known here. It tells labels from other lines up to the first
    line that opens or closes one, so what depends on it is made for both cases: 0 for no section, 1 for any.
    """
    line, name, here = F.col("line"), F.col("_name"), Window.partitionBy("_hash", "_at").orderBy("seq")
    upto, prior = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    text = _marked(text).withColumns({"_start": line == RECORD_START, "_silent": _is_silent(line)})
    text = text.withColumns({
        "_starts": F.sum(F.col("_start").cast("long")).over(upto), "_section": F.last("_event", ignorenulls=True).over(upto),
        "_lines": F.sum((~F.col("_silent")).cast("long")).over(upto),
    })

    def opened(guess: int) -> Column:
        return F.coalesce(F.col("_section") != "", F.lit(bool(guess)))

    first = F.col("_starts") == 0
    mark = F.when(F.col("_start"), F.lit(False)).when(~opened(0) & (name == RECORD_ID), F.lit(True))
    numbered = {f"_numbered{g}": F.max(first & ~opened(g) & (name == RECORD_ID)).over(upto) for g in (0, 1)}
    text = text.withColumns({
        "_before": F.last(mark, ignorenulls=True).over(prior), "_mark": F.last(mark, ignorenulls=True).over(upto), **numbered,
        **{f"_label{g}": F.when(opened(g), F.col("_inside")).otherwise(F.col("_plain")) for g in (0, 1)},
    })
    # Whether the first Summary line ends a record is not known here either; see _closes.
    closes = F.col("_start") & (F.col("_starts") > 1) & F.col("_before")
    head = F.struct(F.col("_section").alias("section"), F.col("_name").alias("name"), F.col("_lines").alias("lines"))
    later = F.when(~first & (F.col("_label0") | closes), head)
    heads = {f"_head{g}": F.last(F.when(first & F.col(f"_label{g}"), head), ignorenulls=True).over(upto) for g in (0, 1)}
    return text.withColumns({
        "_records": F.sum(closes.cast("long")).over(upto), "_later": F.last(later, ignorenulls=True).over(upto), **heads,
        "_end": F.lead(F.lit(True)).over(here).isNull(),
    })


def _guessed(name: str, before: dict[str, Column]) -> Column:
    return F.when(F.coalesce(before["section"], F.lit("")) != "", F.col(f"{name}1")).otherwise(F.col(f"{name}0"))


def _closes(before: dict[str, Column]) -> Column:
    """Whether the first Summary line of the block, once it has been read, ended a record."""
    return (F.col("_starts") > 0) & (_guessed("_numbered", before) | before["numbered"])


def _with_field(rows: DataFrame, before: dict[str, Column]) -> DataFrame:
    """Add the field a line belongs to: its label, ``''`` where the record has none yet, and the line of the file it begins at. NULL if it began in an earlier block."""
    none = F.struct(F.lit(None).cast("string").alias("section"), F.lit("").alias("name"), F.col("_lines").alias("lines"))
    head = F.coalesce("_later", F.when(_closes(before), none).otherwise(_guessed("_head", before)))
    label = _titled(F.coalesce("_h.section", before["section"], F.lit("")), F.col("_h.name"))
    field = F.struct(label.alias("label"), (before["lines"] + F.col("_h.lines")).alias("line"))
    return rows.withColumn("_h", head).withColumn("_field", F.when(F.col("_h").isNotNull(), field))


def _pieces(rows: DataFrame, before: dict[str, Column], limit: int) -> DataFrame:
    """Texts of the fields of each block, a part per ``limit`` lines of the field."""
    rows = rows.filter(~F.col("_silent") & (F.col("_field.label") != ""))
    rows = rows.withColumn("_nth", before["lines"] + F.col("_lines") - F.col("_field.line"))
    rows = rows.select(
        "_hash", "_at", "record", F.col("_field.label").alias("label"), F.floor(F.col("_nth") / limit).cast("long").alias("part"),
        F.col("_field.line").alias("field"), F.struct("seq", _value(F.col("line"), F.col("_nth") == 0).alias("value")).alias("_line"),
    )
    texts = F.transform(F.sort_array(F.collect_list("_line")), lambda x: x["value"])
    return rows.groupBy("_hash", "_at", "record", "label", "part", "field").agg(F.array_join(texts, " ").alias("value"))


def _last_fields(found: DataFrame, keys: list[str]) -> DataFrame:
    """Of fields with equal keys the one that begins last."""
    found = found.withColumn("_last", F.max("field").over(Window.partitionBy(*keys)))
    return found.filter(F.col("field") == F.col("_last")).drop("_last")


def _carried(ends: DataFrame) -> DataFrame:
    """What the blocks of a file begin with, out of the last line of each: (_at, _in)."""
    blocks = Window.partitionBy("_at.file").orderBy("_at.block")
    earlier = blocks.rowsBetween(Window.unboundedPreceding, -1)
    whole = blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.withColumns({
        "section": F.last("_section", ignorenulls=True).over(earlier),
        "lines": F.coalesce(F.sum("_lines").over(earlier), F.lit(0)),
    })
    before = {n: F.col(n) for n in ("section", "lines", "numbered")}
    mark = F.when(F.col("_starts") > 0, F.col("_mark")).when(_guessed("_numbered", before), F.lit(True))
    ends = ends.withColumn("_mark", mark)
    ends = ends.withColumns({
        "numbered": F.coalesce(F.last("_mark", ignorenulls=True).over(earlier), F.lit(False)),
        "_last": F.coalesce(F.last("_mark", ignorenulls=True).over(whole), F.lit(False)),
    })
    ends = _with_field(ends.withColumn("_closed", F.col("_records") + _closes(before).cast("long")), before)
    ends = ends.withColumns({
        "records": F.coalesce(F.sum("_closed").over(earlier), F.lit(0)), "field": F.last("_field", ignorenulls=True).over(earlier),
        "kept": F.sum("_closed").over(whole) + F.col("_last").cast("long"),
    })
    return ends.select("_at", F.struct("section", "lines", "numbered", "records", "field", "kept").alias("_in"))


def fields_to_records(fields: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """One row per record with a label to value map; a record with more than ``limit`` fields has several parts."""
    rows = fields.withColumnRenamed("part", "value_part")
    entry = F.struct(
        F.when(F.col("value_part") == 0, F.col("label"))
        .otherwise(F.concat("label", F.lit(" #"), F.col("value_part").cast("string")))
        .alias("key"),
        F.col("value"),
    )
    lists = ordered_list(rows, ["file", "record"], entry, ["label", "value_part"], "entries", limit)
    return lists.select("file", "record", "part", F.map_from_entries("entries").alias("fields"))
