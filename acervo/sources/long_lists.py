"""Plain JSON files that hold one long list, each read by many tasks.

A file is cut at every closing brace, wherever it stands, which Spark's text reader does in parallel. Whether a brace
ends a record depends on everything before it: on the quotes (inside a string it is a letter) and on the depth. Each piece is summed up for
both cases, starting inside a string or outside; the sums of a split, and then of all splits, are composed by running totals: one row
for each split. With its true start known, every piece tells whether a record ends with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acervo.session import materialise

#: Start of an object whose list of items comes before any inner object ends.
ENVELOPE = r'(?s)^\x{feff}?\s*\{(?:[^"{}\[\]]|"(?:[^"\\]|\\.)*"(?!\s*:\s*\[))*"items"\s*:\s*\['
LIST = r"(?s)^\x{feff}?\s*\["


def _letters(text: Column, letters: str) -> Column:
    """How many of ``letters`` the text has."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def _depth(text: Column) -> Column:
    return _letters(text, "{[") - _letters(text, "}]")


def _falls(brackets: Column) -> Column:
    """Whether a run of opening and closing brackets ever closes more than it opened."""
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("least"))

    def step(s: Column, letter: Column) -> Column:
        now = s["now"] + F.when(letter == "]", -1).otherwise(1)
        return F.struct(now.alias("now"), F.least(s["least"], now).alias("least"))

    return F.coalesce(F.aggregate(F.filter(F.split(brackets, ""), lambda b: b != ""), start, step, lambda s: s["least"] < 0), F.lit(False))


def pieces_of(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, split, at, text`` and what a piece does: ``quotes``, and the change of depth if it starts outside or inside a string."""
    read = spark.read.option("lineSep", "}").text(path)
    rows = read.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("split"), F.col("_metadata.file_size").alias("file_size"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
    )
    # escaped characters say nothing; between quotes, texts outside and inside a string take turns
    turns = F.split(F.regexp_replace("text", r"(?s)\\.", ""), '"', -1)
    outside = F.array_join(F.filter(turns, lambda _, i: i % 2 == 0), "")
    inside = F.array_join(F.filter(turns, lambda _, i: i % 2 == 1), "")
    rows = rows.withColumns({"quotes": F.size(turns) - 1, "bytes": F.octet_length("text") + 1})
    # of the piece that opens a list, what comes after; a list may end in it
    after = F.split(F.regexp_replace(F.regexp_replace("text", ENVELOPE, ""), r"(?s)\\.", ""), '"', -1)
    brackets = F.regexp_replace(F.array_join(F.filter(after, lambda _, i: i % 2 == 0), ""), r"(?s)[^\[\]{]", "")
    return rows.withColumns({"from_outside": _depth(outside), "from_inside": _depth(inside), "brackets": brackets})


def placed(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``is_in`` (the piece ends inside a string), ``depth`` after it, and ``record``: the number of records that end before it."""
    key = ["file_path", "split"]
    upto = W.partitionBy(*key).orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    before = W.partitionBy(*key).orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    # if the split starts outside a string; otherwise everything is the other way round
    turned = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    pieces = pieces.withColumns({"turned": turned, "quotes_upto": F.sum("quotes").over(upto)})
    brace = F.when(F.col("ended"), 1).otherwise(0)

    def change(inside: bool) -> Column:
        starts_in = F.col("turned") if not inside else ~F.col("turned")
        ends_in = (F.col("quotes_upto") % 2 == 1) if not inside else (F.col("quotes_upto") % 2 == 0)
        return F.when(starts_in, F.col("from_inside")).otherwise(F.col("from_outside")) - F.when(ends_in, 0).otherwise(brace)

    pieces = pieces.withColumns({"step_out": change(False), "step_in": change(True)})
    pieces = materialise(pieces.withColumns({"deep_out": F.sum("step_out").over(upto), "deep_in": F.sum("step_in").over(upto)}), "list-pieces")
    splits = pieces.groupBy(*key).agg(F.sum("quotes").alias("quotes"), F.sum("step_out").alias("step_out"), F.sum("step_in").alias("step_in"))
    earlier = W.partitionBy("file_path").orderBy("split").rowsBetween(W.unboundedPreceding, -1)  # a row for each split
    splits = splits.withColumn("begins_in", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2 == 1)
    step = F.when(F.col("begins_in"), F.col("step_in")).otherwise(F.col("step_out"))
    splits = splits.withColumn("begins_at", F.coalesce(F.sum(step).over(earlier), F.lit(0))).select(*key, "begins_in", "begins_at")
    known = pieces.join(splits, key).withColumns(
        {
            "is_in": F.col("begins_in") != (F.col("quotes_upto") % 2 == 1),
            "depth": F.col("begins_at") + F.when(F.col("begins_in"), F.col("deep_in")).otherwise(F.col("deep_out")),
        }
    )
    starts_in = F.col("begins_in") != F.col("turned")
    start = F.col("depth") - F.when(F.col("begins_in"), F.col("step_in")).otherwise(F.col("step_out"))
    opens = (F.col("level") == 2) & (start == 0) & F.col("text").rlike(ENVELOPE)
    known = known.withColumn("leaves", ~starts_in & ((start == F.col("level")) | opens) & _falls(F.col("brackets")))
    known = materialise(known.select(*key, "at", "text", "level", "ended", "last", "is_in", "depth", "leaves"), "list-depths")
    # the rest of a file, from the piece that the list ends in, is no record of it
    place = F.struct("split", "at")
    ends = known.where("leaves").groupBy("file_path").agg(F.min(place).alias("list_end"))
    known = known.join(ends, "file_path", "left")
    inner = F.col("list_end").isNull() | (place < F.col("list_end"))
    known = known.withColumn("closes", F.when(inner & ~F.col("is_in") & F.col("ended") & (F.col("depth") == F.col("level")), 1).otherwise(0))
    known = materialise(known.drop("list_end", "leaves").withColumn("closed", F.coalesce(F.sum("closes").over(before), F.lit(0))), "list-places")
    counts = known.groupBy(*key).agg(F.sum("closes").alias("closes"))
    counts = counts.select(*key, F.coalesce(F.sum("closes").over(earlier), F.lit(0)).alias("offset"))
    return known.join(counts, key).withColumn("record", F.col("closed") + F.col("offset"))


def read_long_lists(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(elements as ``raw`` VARIANT with file and position, files and records that are no JSON), as ``read_wrapped`` reads them.

    For plain files with a list at the top, or an object whose ``items`` list comes before any inner object; files of another shape come back as
    rejects ``other_shape``, for the reader that takes one task a file. A file whose quotes or brackets do not match is a reject as a whole.
    """
    pieces = materialise(pieces_of(spark, path), "list-cuts")
    first = F.struct("split", "at")
    # whether the file ends with a brace; the reader passes by a byte order mark, of three bytes
    missing = F.max("file_size") - F.sum("bytes")
    files = pieces.groupBy("file_path").agg(F.min_by("text", first).alias("head"), F.max(first).alias("end"), missing.isin(0, 3).alias("whole"))
    level = F.when(F.col("head").rlike(LIST), 1).when(F.col("head").rlike(ENVELOPE), 2)
    files = materialise(files.select("file_path", level.alias("level"), "end", "whole"), "list-files")
    shaped = files.where("level is not null")
    last = first == F.col("end")
    told = pieces.join(shaped, "file_path").withColumns({"last": last, "ended": ~last | F.col("whole")}).drop("end", "whole", "file_size", "bytes")
    known = materialise(placed(told), "list-known")
    broken = known.where("last").where(F.col("is_in") | (F.col("depth") != 0)).select("file_path")

    text = F.when(F.col("ended"), F.concat("text", F.lit("}"))).otherwise(F.col("text"))
    sound = known.join(broken, "file_path", "left_anti").withColumn("text", text)
    # a record is as long as its element; pieces of one come together from all splits it runs over
    parts = F.array_sort(F.collect_list(F.struct("split", "at", "text")))
    records = sound.groupBy("file_path", "record").agg(F.any_value("level").alias("level"), F.bool_or("last").alias("open"), parts.alias("parts"))
    body = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    opened = F.when(F.col("level") == 1, F.regexp_replace(body, LIST, "")).otherwise(F.regexp_replace(body, ENVELOPE, ""))
    body = F.when(F.col("record") == 0, opened).otherwise(F.regexp_replace(body, r"^\s*,", ""))
    bodies = records.select("file_path", "record", "level", "open", body.alias("body"))
    # the last one has the end of the list, and of the object around it
    whole = F.when(~F.col("open"), F.concat(F.lit("["), "body", F.lit("]"))).when(F.col("level") == 1, F.concat(F.lit("["), "body")).otherwise(F.concat(F.lit('{"items": ['), "body"))
    bodies = bodies.select("file_path", "record", "level", "open", whole.alias("body"))
    parsed = F.try_parse_json("body")
    read = bodies.withColumn("list", F.when(F.col("open") & (F.col("level") == 2), F.try_variant_get(parsed, "$.items", "variant")).otherwise(parsed))
    good = read.where("list is not null").select("file_path", "record", "list")
    elements = good.lateralJoin(spark.tvf.variant_explode(F.col("list").outer())).select("file_path", "record", F.col("pos").alias("within"), F.col("value").alias("raw"))
    bad = read.where("list is null").select("file_path", F.lit("bad_record").alias("reason"))
    odd = files.where("level is null").select("file_path", F.lit("other_shape").alias("reason"))
    return elements, bad.unionByName(odd).unionByName(broken.select("file_path", F.lit("bad_json").alias("reason")))
