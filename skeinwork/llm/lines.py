"""Removal of repeated line chunks, in DataFrame functions only.

A text's lines are cut into chunks where the content says so: every line has a 32-bit hash, a rolling hash covers two
neighbouring lines, and a chunk ends after a line whose rolling hash is divisible by ``MEAN_LINES``.  Boundaries depend
on two lines only, so they shift along with inserted or removed lines.  A chunk of two or more lines that stands in more
than one document, or again in the same one, is repeated; the document with the smallest doc_id keeps its first one.

Chunks are grouped by their hash and their whole text, so that chunks count as repeated only when their bytes are equal.
The groups, and which document keeps each, are found with partial sums before the shuffle; removal then joins the small
rows (hash, doc_id, lines) with the repeated hashes.  Should two different texts share a hash, that hash is set apart and
joined by whole texts.

Defined results: a null text stays null; an empty text is one empty line; rows with the same doc_id and text are one
document and keep what it keeps; rows that share a doc_id but not the text are documents of their own, in the order of a
hash of the text; rows with null doc_id take part in nothing and stay as they are; single lines are never removed; an
empty table gives an empty result; other columns are kept by dedup().  A chunk that very many documents hold is dealt to
many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skeinwork.llm.common import Scratch, crowded_keys, join_spread

MEAN_LINES = 3
_MODULUS = 2147483647


def line_chunks(text: Column, mean_lines: int = MEAN_LINES) -> Column:
    """array<struct<first, n, text>> of the chunks of a text; first counts lines from 0."""
    lines = F.split(text, "\n", -1)
    hashes = F.transform(lines, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("long"))
    rolling = lambda h, i: (F.get(h, i - 1) * 1000003 + F.get(h, i)) % _MODULUS % mean_lines == 0
    # one-element arrays hold what is used more than once, so that it is computed once
    ends = F.flatten(F.transform(F.array(hashes), lambda h: F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: (i == F.size(h) - 1) | ((i > 0) & rolling(h, i)))))
    cut = F.struct(lines.alias("lines"), ends.alias("ends"))

    def chunks(c: Column) -> Column:
        def one(end: Column, k: Column) -> Column:
            first = F.coalesce(F.get(c["ends"], k - 1) + 1, F.lit(0))
            return F.struct(first.alias("first"), (end - first + 1).alias("n"), F.array_join(F.slice(c["lines"], first + 1, end - first + 1), "\n").alias("text"))

        return F.transform(c["ends"], one)

    return F.flatten(F.transform(F.array(cut), chunks))


def _copy() -> Column:
    """Tells rows that share a doc_id but not the text apart; rows that share both are one document."""
    return F.xxhash64("text").bitwiseAND((1 << 62) - 1)


def repeated_chunks(docs: DataFrame, mean_lines: int = MEAN_LINES, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, copy and runs (array<struct<first, n>>): the line runs that each document loses."""
    scratch = scratch or Scratch(docs.sparkSession, "lines")
    rows = docs.filter(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), _copy().alias("copy"), F.explode(F.filter(line_chunks(F.col("text"), mean_lines), lambda c: c["n"] > 1)).alias("c"))
    # one number that orders documents by doc_id and then copy, which partial sums can hold
    order = F.col("doc_id").cast("decimal(19,0)") * F.lit(1 << 62).cast("decimal(19,0)") + F.col("copy")
    rows = rows.select("doc_id", "copy", order.alias("doc"), "c.first", "c.n", "c.text", F.xxhash64("c.text").alias("key"))
    groups = rows.groupBy("key", "text").agg(F.count("*").alias("times"), F.min("doc").alias("keeper"))
    groups = scratch.keep(groups.groupBy("key").agg(F.count("*").alias("texts"), F.sum("times").alias("times"), F.min("keeper").alias("keeper"), F.count_if(F.col("times") > 1).alias("known")).filter(F.col("known") > 0).drop("known"))
    small = scratch.keep(rows.groupBy("key", "doc_id", "copy", "doc").agg(F.min("first").alias("kept"), F.collect_list(F.struct("first", "n")).alias("runs")))
    crowded = crowded_keys(groups, "key", "times")
    gone = (F.col("doc") != F.col("keeper")) | (F.col("run.first") != F.col("kept"))
    hit = join_spread(small, groups.filter("texts = 1 and times > 1").select("key", "keeper"), "key", crowded)
    lost = hit.select("doc_id", "copy", "doc", F.explode("runs").alias("run"), "kept", "keeper").filter(gone).select("doc_id", "copy", "run")
    if not groups.filter("texts > 1").isEmpty():
        shared = groups.filter("texts > 1").select("key")
        both = rows.join(shared, "key", "left_semi")
        again = both.groupBy("key", "text").agg(F.count("*").alias("times"), F.min("doc").alias("keeper")).filter("times > 1")
        first = both.groupBy("key", "text", "doc_id", "copy", "doc").agg(F.min("first").alias("kept"), F.collect_list(F.struct("first", "n")).alias("runs"))
        more = first.join(again, ["key", "text"]).select("doc_id", "copy", "doc", F.explode("runs").alias("run"), "kept", "keeper")
        lost = lost.unionAll(more.filter(gone).select("doc_id", "copy", "run"))
    return lost.distinct().groupBy("doc_id", "copy").agg(F.array_sort(F.collect_list("run")).alias("runs"))


def _cut(docs: DataFrame, mean_lines: int) -> DataFrame:
    """The documents with the runs that they lose in __runs and the text that stays in __kept."""
    runs = repeated_chunks(docs.select("doc_id", "text"), mean_lines)
    out = docs.withColumn("__doc", F.col("doc_id").cast("long")).withColumn("__copy", F.when(F.col("text").isNotNull(), _copy()))
    out = out.join(runs.select(F.col("doc_id").alias("__doc"), F.col("copy").alias("__copy"), F.col("runs").alias("__runs")), ["__doc", "__copy"], "left").drop("__doc", "__copy")
    # the lines between the runs, slice by slice
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<string>>").alias("out"))

    def cut(lines: Column) -> Column:
        def step(s: Column, run: Column) -> Column:
            return F.struct((run["first"] + run["n"]).alias("at"), F.array_append(s["out"], F.slice(lines, s["at"] + 1, run["first"] - s["at"])).alias("out"))

        rest = lambda s: F.array_join(F.flatten(F.array_append(s["out"], F.slice(lines, s["at"] + 1, F.size(lines)))), "\n")
        return F.aggregate(F.col("__runs"), state, step, rest)

    kept = F.element_at(F.transform(F.array(F.split("text", "\n", -1)), cut), 1)
    return out.withColumn("__kept", F.when(F.col("__runs").isNull(), F.col("text")).otherwise(kept))


def dedup(docs: DataFrame, mean_lines: int = MEAN_LINES) -> DataFrame:
    """The documents, all columns, without their repeated chunks; n_chars follows the text where it is there."""
    out = _cut(docs, mean_lines)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__runs").isNull(), F.col("n_chars")).otherwise(F.length("__kept").cast(docs.schema["n_chars"].dataType)))
    return out.select(*(F.col("__kept").alias("text") if c == "text" else F.col(c) for c in docs.columns))


def dedup_report(docs: DataFrame, mean_lines: int = MEAN_LINES) -> DataFrame:
    """doc_id, n_lines, removed_lines, removed_runs (array<struct<first, n>>) and the text that stays."""
    out = _cut(docs.select("doc_id", "text"), mean_lines)
    removed = F.coalesce(F.aggregate("__runs", F.lit(0), lambda s, r: s + r["n"]), F.lit(0))
    n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
    return out.select("doc_id", n.cast("long").alias("n_lines"), removed.cast("long").alias("removed_lines"), F.col("__runs").alias("removed_runs"), F.col("__kept").alias("text"))
