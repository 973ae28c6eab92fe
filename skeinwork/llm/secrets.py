"""Secret scans by fixed patterns and by two character Markov models, in DataFrame functions only.

Three kinds of base spans are found by patterns, leftmost and without overlaps in each kind.  A fourth kind, ``markov``,
adds runs of at least ``SHORTEST`` token characters, the base spans cut out of them, that are likelier under a first-order
model of random strings than under one of ordinary identifiers: the log-likelihood ratio, summed over the run, is at least
``LEAST_TOTAL``, and ``LEAST_MEAN`` per character.  Both models are counts of character pairs in labelled samples: random
strings made by hashing numbers together with the whole values of base spans (one of more than ``LONG`` characters weighs
as much as one of ``LONG``), and the other words of the same sample of documents, at most ``sample_docs`` of them, those with the smallest hashes of doc_id.  The counts that reach the driver
are at most two tables of 128 x 128.

Positions of matches come from splitting a text by the same pattern: a match begins where the pieces and matches before
it end.  Positions are code points; ends are exclusive.

Defined results: a null text is an empty one and has no spans; spans of an empty list give the SHA-256 of an empty
string; repeated rows are scanned each; an empty table gives an empty result; other columns are kept by redact() and
ignored by scan().
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinwork.llm.common import text_of

# The base kinds with their patterns, in the order of listing.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{14,}"  # AKIA[A-Z0-9]+ of 18 or more characters
HEX = "[0-9a-f]{16,}"  # [0-9a-f]+ of 16 or more characters
KINDS = ["assign", "access", "hex", "markov"]

# Parts of ordinary identifiers, for the labelled sample of them.
PARTS = """get set is has from to by on parent node element id index value name list item user file path local lib bin src test main data config site packages python json
http request response handler client server manager factory service model view controller parse build create update delete read write load save cache buffer stream string number
query table column row key count total size start end first last next previous default version release temp backup log error message event queue worker thread process task job
state status result input output format type class object function method module import export public private static final abstract internal common utils helper base core""".split()

MADE, PART = 2000, 64
SHORTEST, LEAST_TOTAL, LEAST_MEAN, SAMPLE_DOCS = 16, 25.0, 0.8, 2000
LONG = 64
RUN = f"[A-Za-z0-9+/_=.-]{{{SHORTEST},}}"
_SPAN = "array<struct<start:int,kind:int,end:int>>"


def running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """The folds of all beginnings of an array<int>, part by part, so that no long list is copied for each value."""

    def fold(own: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(own, state, lambda s, v: F.struct(step(s["at"], v).alias("at"), F.array_append(s["out"], step(s["at"], v)).alias("out")), lambda s: s["out"])

    def whole(v: Column) -> Column:
        last = F.greatest(F.floor((F.size(v) - 1) / PART).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda c: F.slice(v, c * PART + 1, F.lit(PART)))

    def joined(parts: Column) -> Column:
        totals = fold(F.transform(parts, lambda p: F.aggregate(p, F.lit(0), step)), F.lit(0))
        return F.flatten(F.flatten(F.transform(F.array(totals), lambda t: F.transform(parts, lambda p, i: fold(p, F.coalesce(F.get(t, i - 1), F.lit(0)))))))

    # one-element arrays hold what is used more than once, so that it is computed once
    return F.flatten(F.transform(F.transform(F.array(values), whole), joined))


def _found(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """The matches that keep() accepts, as spans."""
    parts, matches = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    paired = F.arrays_zip(F.slice(parts, 1, F.size(matches)).alias("before"), matches.alias("match"))

    def spans(both: Column) -> Column:
        ends = running(F.transform(both, lambda b: F.length(b["before"]) + F.length(b["match"])), lambda x, y: x + y)
        placed = F.flatten(F.transform(F.array(ends), lambda e: F.transform(both, lambda b, i: F.struct((F.get(e, i) - F.length(b["match"])).alias("start"), F.get(e, i).alias("end"), b["match"].alias("match")))))
        return F.transform(F.filter(placed, lambda p: keep(p["match"])), lambda p: F.struct(p["start"].alias("start"), F.lit(kind).alias("kind"), p["end"].alias("end")))

    return F.when(text.rlike(pattern), F.flatten(F.transform(F.array(paired), spans))).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """The base spans of a text, by start and then kind."""
    always = lambda m: F.lit(True)
    found = [_found(text, ASSIGN, 0, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 12), _found(text, ACCESS, 1, always), _found(text, HEX, 2, always)]
    return F.array_sort(F.concat(*found))


def _pairs(words: DataFrame) -> DataFrame:
    """Counts of character pairs (two codes below 128) of the words by label.

    The pairs of a random string of more than ``LONG`` characters weigh as much together as those of one of ``LONG``.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("word") - 1))
    rows = words.filter(F.length("word") > 1).select("label", "word", at.alias("i"))
    code = lambda i: F.ascii(F.substring("word", i, F.lit(1)))
    weight = F.when((F.col("label") == 1) & (F.length("word") > LONG), F.lit(LONG - 1.0) / (F.length("word") - 1)).otherwise(1.0)
    return rows.groupBy("label", code(F.col("i")).alias("a"), code(F.col("i") + 1).alias("b")).agg(F.sum(weight.cast("decimal(12,9)")).cast("double").alias("count"))  # sums of decimals do not depend on their order


def identifiers(spark: SparkSession, rows: int = MADE) -> DataFrame:
    """Ordinary identifiers (label 0): camel, snake and kebab case, constants, paths, dates, versions and numbers."""
    vocabulary = F.array(*map(F.lit, PARTS))
    pick = lambda k: F.get(vocabulary, F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(PARTS))).cast("int"))
    number = lambda k, least, most: (F.pmod(F.xxhash64("id", F.lit(k + 50)), F.lit(most - least + 1)) + least).cast("string")
    two = lambda k, most: F.lpad(number(k, 0, most), 2, "0")
    w, title = [pick(k) for k in range(6)], lambda c: F.initcap(c)
    date = F.concat_ws("-", number(0, 1990, 2035), two(1, 12), two(2, 31))
    shapes = [
        F.concat(w[0], title(w[1]), title(w[2]), title(w[3])), F.concat(title(w[0]), title(w[1]), title(w[2]), title(w[4])), F.concat_ws("_", w[0], w[1], w[2], F.concat(F.lit("v"), number(3, 1, 12))), F.concat_ws("_", w[3], w[4], w[5]),
        F.upper(F.concat_ws("_", w[0], w[2], w[4])), F.concat_ws("-", w[1], w[3], w[5], number(4, 1, 99)), F.concat(F.lit("/"), w[0], F.lit("/"), w[1], number(5, 1, 3), F.lit("."), number(6, 0, 20), F.lit("/"), w[2], F.lit("-"), w[3], F.lit("/"), w[4], F.lit("."), w[5]),
        F.concat(date, F.lit("T"), two(7, 23), F.lit("-"), two(8, 59), F.lit("-"), two(9, 59), F.lit("Z."), w[0]), F.concat(w[0], F.lit("-"), w[1], F.lit("-"), number(10, 0, 30), F.lit("."), number(11, 0, 30), F.lit("."), number(12, 0, 200), F.lit(".tar.gz")),
        F.concat(number(13, 1_000_000_000, 1_999_999_999), F.lit("."), number(14, 100_000, 999_999)), F.concat(title(w[2]), title(w[5]), number(15, 1, 9999)), F.concat_ws(".", w[0], w[1], w[2], title(w[3])),
    ]
    return spark.range(rows).select(F.lit(0).alias("label"), F.explode(F.array(*shapes)).alias("word"))


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> list[float]:
    """The log-likelihood ratio of each pair of character codes, at 128 * first + second."""
    spark = docs.sparkSession
    ids = docs.filter(F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id")).limit(sample_docs)
    sample = docs.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select(text_of().alias("text"))  # at most sample_docs ids
    made = spark.range(2000).select(F.lit(1).alias("label"), F.explode(F.array(F.md5(F.col("id").cast("string")), F.translate(F.base64(F.unhex(F.sha2(F.col("id").cast("string"), 256))), "=", ""))).alias("word"))
    value = F.concat(F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(HEX), F.lit(0)))
    values = sample.select(F.lit(1).alias("label"), F.explode(F.filter(value, lambda v: F.length(v) >= 12)).alias("word"))
    others = F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    plain = sample.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(others, F.lit("[A-Za-z0-9+/_=.-]{2,}"), F.lit(0))).alias("word")).filter(F.col("word").rlike("^[A-Za-z_.-]+$"))
    counts = {(r.label, r.a, r.b): r["count"] for r in _pairs(made.unionAll(values).unionAll(plain).unionAll(identifiers(spark))).collect() if r.a < 128 and r.b < 128}
    return _log_ratios(counts)


def _log_ratios(counts: dict[tuple[int, int, int], float]) -> list[float]:
    """The log-likelihood ratios from counts by label and pair of codes.

    Pairs that are rare in a sample are judged by how often its classes of characters follow each other, and by how
    common the second character is in its class.
    """
    sizes, weight = (26, 26, 10, 6), 50.0
    kind = lambda c: 0 if 97 <= c <= 122 else 1 if 65 <= c <= 90 else 2 if 48 <= c <= 57 else 3
    first, second, classes, from_class, to_class = (defaultdict(float) for _ in range(5))
    for (label, a, b), n in counts.items():
        for table, key in ((first, a), (second, b), (classes, (kind(a), kind(b))), (from_class, kind(a)), (to_class, kind(b))):
            table[label, key] += n

    def likely(k: int, a: int, b: int) -> float:
        alone = (classes[k, (kind(a), kind(b))] + 1) / (from_class[k, kind(a)] + 4) * (second[k, b] + 0.5) / (to_class[k, kind(b)] + 0.5 * sizes[kind(b)])
        return math.log((counts.get((k, a, b), 0) + weight * alone) / (first[k, a] + weight))

    return [round(likely(1, a, b) - likely(0, a, b), 4) for a in range(128) for b in range(128)]


def _ratio(table: list[float], word: Column) -> Column:
    """The log-likelihood ratio of a word."""
    ratios = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")
    code = lambda i: F.ascii(F.substring(word, i, F.lit(1)))
    return F.aggregate(F.sequence(F.lit(1), F.length(word) - 1), F.lit(0.0), lambda s, i: s + F.get(ratios, code(i) * 128 + code(i + 1)))


def replaced(text: Column, spans: Column, cover: Callable[[Column, Column], Column]) -> Column:
    """The text with cover(span, end of all spans before) in place of what each span covers beyond those before."""

    def own(s: Column) -> Column:
        def whole(ends: Column) -> Column:
            def one(span: Column, i: Column) -> Column:
                at = F.coalesce(F.get(ends, i - 1), F.lit(0))
                return F.concat(F.substring(text, at + 1, F.greatest(span["start"] - at, F.lit(0))), cover(span, at))

            last = F.element_at(ends, -1)
            return F.concat(F.array_join(F.transform(s, one), ""), F.substring(text, last + 1, F.length(text)))

        return F.element_at(F.transform(F.array(running(F.transform(s, lambda x: x["end"]), lambda x, y: F.greatest(x, y))), whole), 1)

    return F.when(F.size(spans) > 0, F.element_at(F.transform(F.array(spans), own), 1)).otherwise(text)


def without_spans(text: Column, base: Column) -> Column:
    """The text with blanks in place of its base spans, so that all other places stay."""
    return replaced(text, base, lambda span, at: F.repeat(F.lit(" "), F.greatest(span["end"] - F.greatest(at, span["start"]), F.lit(0))))


def markov_spans(rest: Column, table: list[float]) -> Column:
    """Runs of token characters, in a text without its base spans, that the models take for random."""

    def random(word: Column) -> Column:
        ratio = _ratio(table, word)
        return (ratio >= LEAST_TOTAL) & (ratio >= LEAST_MEAN * F.length(word))

    return _found(rest, RUN, 3, random)


def with_spans(docs: DataFrame, table: list[float]) -> DataFrame:
    """Adds the columns __base, __rest and __spans (all spans, sorted) to documents."""
    text = text_of()
    out = docs.withColumn("__base", base_spans(text)).withColumn("__rest", without_spans(text, F.col("__base")))
    return out.withColumn("__spans", F.array_sort(F.concat("__base", markov_spans(F.col("__rest"), table))))


def listed(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def scan(docs: DataFrame, table: list[float] | None = None) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans of every document."""
    found = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), table or train(docs))
    count = lambda k: F.size(F.filter("__spans", lambda s: s["kind"] == k)).cast("long")
    return found.select("doc_id", *(count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)), F.sha2(listed(F.col("__base")), 256).alias("base_sha256"), listed(F.col("__spans")).alias("spans"))


def redact(docs: DataFrame, table: list[float] | None = None, mark: str = "[secret]") -> DataFrame:
    """The documents with every span, or run of overlapping spans, replaced by a mark; n_chars follows where it is there."""
    found = with_spans(docs, table or train(docs))
    out = found.withColumn("text", replaced(F.col("text"), F.col("__spans"), lambda span, at: F.when(span["start"] >= at, mark).otherwise("")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
