"""Records of one large JSON document, read by many tasks.

A document ``{"data": [{...}, {...}], ...}`` may have no line break at all. It is read in pieces
that end with ``}``, which Spark can split anywhere. What a piece means depends on what stands before
it: whether it begins in a text, and how many objects and arrays are open. Each piece is read both
ways, each block of a file is reduced to what it does to either, and a running total over the
blocks gives every block its beginning. Then the pieces that end an object outside of all
others but the document are known, and only pieces of one such object meet.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleswright.scale import attach, settled

AT = ["file", "start"]


def _parts(text: Column) -> Column:
    """A text cut at its quotes; the marks of escaped characters are blotted out."""
    return F.split(F.regexp_replace(text, r"(?s)\\.", "__"), '"')


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``file, start, text``, in the order of each block, which one task reads."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.concat("value", F.lit("}")).alias("text"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """The stretches of a batch that are of one block: its file and start, from and to."""
    files, starts, n = batch.column("file"), batch.column("start").to_numpy(), batch.num_rows
    others = pc.not_equal(files.slice(1), files.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((starts[1:] != starts[:-1]) | others) + 1
    for i, j in itertools.pairwise([0, *cuts.tolist(), n]):
        yield (files[i].as_py(), int(starts[i])), i, j


OPEN = [f"{n}{q}" for n in ("objects", "arrays") for q in (0, 1)]
WALKED = ["file", "start", "flips", "end0", *OPEN, *(f"d_{n}" for n in OPEN)]


def _schema(names: list[str]) -> str:
    return ", ".join(f"{n} {'string' if n in ('file', 'text') else 'long'}" for n in names)


MARKS, SIGNS = np.zeros(256, bool), {n: np.zeros(256, np.int32) for n in ("objects", "arrays")}
MARKS[list(b'"\\{}[]')] = True
for _name, _marks in (("objects", b"{}"), ("arrays", b"[]")):
    SIGNS[_name][list(_marks)] = 1, -1


def _opened(text: pa.Array) -> dict[str, np.ndarray]:
    """What a text opens if it begins outside (0) or inside (1) of quotes, and whether it ends otherwise."""
    n = len(text)
    ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + n + 1]
    data = np.frombuffer(text.buffers()[2], np.uint8)[: ends[-1]]
    at = np.flatnonzero(MARKS[data[ends[0] :]]) + ends[0]
    # The mark after an odd number of backslashes is escaped. Texts end with a brace, so these end before.
    slashes = at[data[at] == ord("\\")]
    begins = np.flatnonzero(np.r_[True, np.diff(slashes) != 1][: len(slashes)])
    long = np.diff(np.r_[begins, len(slashes)])
    escaped = (slashes[begins] + long)[long % 2 == 1]
    bare = data[at] != ord("\\")
    place = np.searchsorted(at, escaped)
    known = place < len(at)
    place, escaped = place[known], escaped[known]
    bare[place[at[place] == escaped]] = False
    at = at[bare]
    mark, bounds = data[at], np.searchsorted(at, ends)
    quote = mark == ord('"')

    def by_piece(values: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(values, dtype=np.int64)]
        return sums[bounds[1:]] - sums[bounds[:-1]]

    before = np.cumsum(quote, dtype=np.int64) - quote
    begun = np.r_[before, before[-1:] + quote[-1:], 0][bounds[:-1]]
    outside = (before - np.repeat(begun, np.diff(bounds))) & 1 == 0
    found = {"flips": by_piece(quote) % 2}
    for name, signs in SIGNS.items():
        opened = signs[mark]
        total, found[f"{name}0"] = by_piece(opened), by_piece(opened * outside)
        found[f"{name}1"] = total - found[f"{name}0"]
    return found


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add how each piece ends if its block begins outside (0) or inside (1) of quotes.

    ``end0`` is 1 where the piece ends inside, if the block begins outside; ``objects0`` and so
    on are what is open after the piece beside what is open where the block begins, and
    ``d_objects0`` and so on what the piece itself does to that.
    """
    held, sums = None, {}
    for batch in batches:
        if not batch.num_rows:
            continue
        opened = _opened(batch.column("text"))
        out = {n: np.empty(batch.num_rows, "int64") for n in ("end0", *OPEN, *(f"d_{n}" for n in OPEN))}
        for key, i, j in _runs(batch):
            if key != held:
                held, sums = key, dict.fromkeys(("end0", *OPEN), 0)
            flips = opened["flips"][i:j]
            end0 = (sums["end0"] + np.cumsum(flips)) % 2
            out["end0"][i:j] = end0
            began = (end0 + flips) % 2
            for name in ("objects", "arrays"):
                for q in (0, 1):
                    one = np.where(began == q, opened[f"{name}0"][i:j], opened[f"{name}1"][i:j])
                    out[f"d_{name}{q}"][i:j] = one
                    out[f"{name}{q}"][i:j] = sums[f"{name}{q}"] + np.cumsum(one)
            sums = {n: int(out[n][j - 1]) for n in sums}
        made = {n: batch.column(n) for n in batch.schema.names}
        made |= {"flips": opened["flips"]} | out
        yield pa.RecordBatch.from_pydict(made)


def _facts_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _walk(batches):
        yield batch.select(WALKED)


def _of(name: str, side: str = "") -> Column:
    """What holds for the way the block begins."""
    return F.when(F.col("inside") == 0, F.col(f"{side}{name}0")).otherwise(F.col(f"{side}{name}1"))


def _block_facts(walked: DataFrame) -> DataFrame:
    """How each block begins: in a text or not, with what open, after how many units."""
    done = {n: F.sum(f"d_{n}").alias(n) for n in OPEN}
    ends = walked.groupBy(*AT, "objects0", "objects1", "end0").agg(
        F.count(F.lit(1)).alias("n"), F.sum("flips").alias("flips"), *[c.alias(f"d_{n}") for n, c in done.items()]
    )
    blocks = settled(
        ends.groupBy(*AT).agg(
            F.struct((F.sum("flips") % 2).alias("end0"), *done.values()).alias("last"),
            F.collect_list(F.struct("objects0", "objects1", "end0", "n")).alias("ends"),
        )
    )
    file = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    begun = blocks.withColumn("inside", F.coalesce(F.sum("last.end0").over(file), F.lit(0)) % 2)
    begun = begun.withColumns(
        {n: F.coalesce(F.sum(_of(n, "last.")).over(file), F.lit(0)) for n in ("objects", "arrays")}
    )

    def closes(e: Column) -> Column:
        open_now = F.col("objects") + F.when(F.col("inside") == 0, e["objects0"]).otherwise(e["objects1"])
        return (e["end0"] == F.col("inside")) & (open_now <= 1)

    closed = F.aggregate(F.filter("ends", closes), F.lit(0).cast("long"), lambda a, e: a + e["n"])
    # One row per block of a file, so this one window is short.
    order = Window.orderBy(*AT).rowsBetween(Window.unboundedPreceding, -1)
    return begun.select(*AT, "inside", "objects", "arrays", F.coalesce(F.sum(closed).over(order), F.lit(0)).alias("units"))


def _unite(facts: dict[tuple[str, int], tuple[int, ...]], whole: bool | None = None) -> Callable:
    """The pieces of a unit that stand in one block, as one text.

    A unit is ``whole`` (1, else 0) if it has no others: it is not the first of its block, and it
    ends there. Only whole units come back, or only the others, where that is asked for.
    """
    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, unit, first, parts, last = None, 0, True, [], None
        inside = objects = arrays = 0
        for batch in _walk(batches):
            rows: list[tuple] = []
            texts = batch.column("text").to_pylist()
            n = {c: batch.column(c).to_numpy() for c in ("end0", *OPEN)}
            for key, i, j in _runs(batch):
                if key != held:
                    if parts and not whole:
                        rows.append((*held, unit, "".join(parts), *last, 0))
                    held, first, parts = key, True, []
                    inside, objects, arrays, unit = facts[key]
                objects_now, arrays_now = n[f"objects{inside}"] + objects, n[f"arrays{inside}"] + arrays
                closes = (n["end0"][i:j] == inside) & (objects_now[i:j] <= 1)
                for end in (np.flatnonzero(closes) + i).tolist():
                    if first != whole:
                        text = "".join([*parts, *texts[i : end + 1]])
                        rows.append((*key, unit, text, objects_now[end], arrays_now[end], int(not first)))
                    unit, first, parts, i = unit + 1, False, [], end + 1
                if i < j:
                    parts += texts[i:j]
                    last = (objects_now[j - 1], arrays_now[j - 1])
            yield _united(rows)
        if parts and not whole:
            yield _united([(*held, unit, "".join(parts), *last, 0)])

    return united


UNITED = {"file": pa.string(), "start": pa.int64(), "pos": pa.int64(), "text": pa.string(),
          "objects_now": pa.int64(), "arrays_now": pa.int64(), "whole": pa.int64()}


def _united(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(UNITED)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, UNITED.values(), strict=True)], names=list(UNITED))


def read_envelope(spark: SparkSession, path: str, schema: str, array: str = "data") -> DataFrame:
    """The objects of one top-level array of JSON documents, in order: ``pos`` and the fields.

    ``pos`` rises in file order and, over files, in the order of their paths; it does not depend on how
    Spark cuts or packs the files. The elements of the array must be objects. Other members
    of the document are passed over, whatever they hold.
    """
    # Blocks are walked where they are read. There are few of them, one for each task that reads, so
    # what is known of them is sent to the tasks.
    pieces = _pieces(spark, path)
    blocks = _block_facts(pieces.mapInArrow(_facts_only, _schema(WALKED)))
    facts = {(r["file"], r["start"]): (r["inside"], r["objects"], r["arrays"], r["units"]) for r in blocks.collect()}

    united = settled(pieces.mapInArrow(_unite(facts), _schema(list(UNITED))))
    # A unit ends with an object that stands in nothing but the document and its arrays. Only
    # units that go on over the end of a block meet their other pieces.
    ends = F.struct("objects_now", "arrays_now")
    at_ends = united.filter("whole = 0").groupBy("file", "pos").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("start", "text")))["text"], "").alias("text"),
        F.max_by(ends, "start").alias("end"),
    )
    units = (
        united.filter("whole = 1").select("file", "pos", "text", ends.alias("end")).unionByName(at_ends)
        .filter("end.objects_now = 1 AND end.arrays_now = 1")
    )
    # The object begins at the first brace outside of texts; the document's own
    # has nothing before it, while a later element of an array stands after a comma, which is
    # seen without cutting its text.
    parts, plain, text = F.col("parts"), F.col("plain"), F.col("text")
    opens = F.filter(
        F.sequence(F.lit(0), F.size(parts) - 1),
        lambda i: (i % 2 == 0) & F.get(parts, i).contains("{") & ~((i == 0) & F.get(parts, i).rlike(r"^[\s\uFEFF]*\{\s*$")),
    )
    at = F.get(opens, F.lit(0))
    skipped = F.aggregate(F.slice(parts, F.lit(1), at), F.lit(0), lambda n, p: n + F.length(p) + 1)
    found = units.withColumn("plain", text.rlike(r"^\s*,\s*\{"))
    found = found.withColumn("parts", F.when(~plain, _parts(text))).withColumn("at", F.when(~plain, at))
    head = F.get(parts, F.col("at"))
    begins = F.when(plain, F.instr("text", "{")).otherwise(skipped + F.instr(head, "{"))
    named = found.select(
        "file",
        "pos",
        F.when(head.rlike(r"^\s*:\s*\[\s*\{"), F.get(parts, F.col("at") - 1)).alias("name"),
        text.substr(begins, F.length("text")).alias("record"),
    )
    # The few arrays of a document, by where they begin.
    arrays = named.filter("name IS NOT NULL").groupBy("file").agg(
        F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("arrays")
    )
    own = F.try_element_at(F.filter("arrays", lambda a: a["pos"] <= F.col("pos")), F.lit(-1))["name"]
    return (
        attach(named, arrays, ["file"])
        .filter(own == array)
        .select("pos", F.from_json("record", schema).alias("r"))
        .select("pos", "r.*")
    )
