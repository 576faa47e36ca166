"""Quality rules over whole texts, DataFrame expressions only.

Base rules look at one document: too few words, or too many words inside
8-word windows that the text repeats. The cross-document rule hashes each
normalised line, counts the distinct documents (distinct texts, so exact copies
count once) that hold it on a host, and removes lines above the limit: a line of
up to ``line_words`` words may stand in ``percent`` of the host's distinct texts,
a longer one in as many times fewer as it is longer, since long lines repeat by
chance less often. Up to ``min_docs`` texts are always allowed. The limit is a
share, so it acts alike on hosts and tables of all sizes. The document with the
smallest doc_id that holds a line keeps it, so that frequent text never vanishes
altogether. A document left with less than ``min_left`` of its words is depleted
and rejected.

Plan: one scan computes the base columns and the line hashes of each document
and is checkpointed without the texts. The counts are a two-step aggregate
(a hot line is combined before the shuffle); only lines above the limit join
back, on (host, line) and a salt of the document, so that a line of a third of
all documents is dealt over ``SALTS`` tasks. The texts of a host are counted in
the same way and meet its lines over salts, too. A host has at most
100 / ``percent`` x its mean words a document lines above the limit.

Defined results: a null or empty text has no words and fails; a null host is
the host ''; lines without a word are ignored; a line that differs in digits only
is as long as its shortest form; repeated (doc_id, text) rows get equal results; a
very long text or line is one row like any other, hashed whole; an empty table gives
an empty result; input columns named like an output give way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segstream.llm.common import cut_lineage

WINDOW = 8
SALTS = 16
SPACE = r"[\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def line_hash(line: Column) -> Column:
    """Case, white space and digits do not tell lines apart; digits do where a
    line has no letters."""
    lettered = F.trim(F.regexp_replace(F.lower(line), r"[\x20\x09-\x0D0-9]+", " "))
    return F.xxhash64(F.when(line.rlike(r"\p{L}"), lettered).otherwise(F.trim(F.regexp_replace(line, SPACE, " "))))


def has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), has_word)


def with_repeats(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words`` from the column ``words``.

    The windows of a text are sorted by (hash, place); equal neighbours are
    repeats. Their places, sorted again, each cover up to WINDOW words or as far
    as the next place. Texts without a repeat stop at the size comparison. An
    array that a lambda reads is also named outside it: a column named only
    once would be inlined into the lambda and computed again for each element.
    """
    windows = "CASE WHEN size(hashes) > {w} THEN transform(sequence(1, size(hashes) - {w} + 1), i -> xxhash64(slice(hashes, i, {w}))) ELSE array() END"
    twice = "filter(s, (x, k) -> (k > 0 AND s[k - 1].g = x.g) OR (k < size(s) - 1 AND s[k + 1].g = x.g))"
    step = "(a, i) -> named_struct('last', i, 'n', a.n + least({w}, i - a.last))"
    return (
        df.withColumn("hashes", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn("grams", F.expr(windows.format(w=WINDOW)))
        .withColumn("s", F.expr("CASE WHEN size(array_distinct(grams)) < size(grams) THEN array_sort(transform(grams, (g, i) -> named_struct('g', g, 'i', i))) END"))
        .withColumn("places", F.expr(f"array_sort(transform({twice}, x -> x.i))"))
        .withColumn("n_repeat_words", F.expr(f"coalesce(aggregate(places, named_struct('last', {-WINDOW}, 'n', 0), {step.format(w=WINDOW)}, a -> a.n), 0)").cast("long"))
        .drop("hashes", "grams", "s", "places")
    )


def measure(docs: DataFrame) -> DataFrame:
    """Base columns and, for each distinct normalised line, its hash and words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.transform(F.col("lines"), lambda x: F.struct(line_hash(x).alias("h"), F.size(word_list(x)).alias("n")))
    return (
        with_repeats(docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("host"), text.alias("body")).withColumn("words", word_list(F.col("body"))))
        .withColumn("lines", worded_lines(F.col("body")))
        .select(
            "doc_id",
            "host",
            F.xxhash64("body").alias("text_hash"),
            F.size("words").cast("long").alias("n_words"),
            F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
            F.length(F.regexp_replace("body", r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            "n_repeat_words",
            lines.alias("lines"),
        )
    )


def salts() -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))


def salt_of(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(SALTS)).cast("int")


def frequent_lines(measured: DataFrame, percent: int, line_words: int, min_docs: int) -> DataFrame:
    """(host, h, keeper): lines that too many distinct texts of a host hold, and
    the smallest doc_id that does."""
    texts = measured.groupBy("host").agg(F.count_distinct("text_hash").alias("texts")).select("host", "texts", salts().alias("salt"))
    held = measured.select("host", "doc_id", "text_hash", F.explode(F.array_distinct("lines")).alias("line"))
    often = (
        held.select("host", "doc_id", "text_hash", "line.h", "line.n")
        .groupBy("host", "h")
        .agg(F.count_distinct("text_hash").alias("docs"), F.min("doc_id").alias("keeper"), F.min("n").alias("n"))
        .where(F.col("docs") > min_docs)
        .withColumn("salt", salt_of("h"))
    )
    above = 100 * F.col("docs") * F.greatest(F.col("n"), F.lit(line_words)) > percent * line_words * F.col("texts")
    return often.join(texts, ["host", "salt"]).where(above).select("host", "h", "keeper")


def lines_to_remove(measured: DataFrame, percent: int, line_words: int, min_docs: int) -> DataFrame:
    """(doc_id, text_hash, removed words, line hashes) of documents that lose lines."""
    held = measured.select("doc_id", "text_hash", "host", salt_of("doc_id", "text_hash").alias("salt"), F.explode("lines").alias("line"))
    frequent = frequent_lines(measured, percent, line_words, min_docs).withColumn("salt", salts())
    return (
        held.select("doc_id", "text_hash", "host", "salt", "line.h", "line.n")
        .join(frequent, ["host", "h", "salt"])
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash", "host")
        .agg(F.sum("n").alias("n_removed"), F.collect_set("h").alias("removed"))
        # a repeated row counts its lines again; one row for each key stays
        .withColumnRenamed("doc_id", "r_id").withColumnRenamed("text_hash", "r_hash").withColumnRenamed("host", "r_host")
    )


def judged(docs: DataFrame, percent: int = 1, line_words: int = 10, min_docs: int = 3, min_left: float = 0.5) -> DataFrame:
    """The verdict of each row of ``docs``: base columns, words removed, kept."""
    measured = cut_lineage(measure(docs))
    lost = lines_to_remove(measured.dropDuplicates(["doc_id", "text_hash", "host"]), percent, line_words, min_docs)
    left = F.col("n_words") - F.coalesce(F.col("n_removed"), F.lit(0))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (
        measured.drop("lines")
        .join(lost, F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("text_hash") == F.col("r_hash")) & (F.col("host") == F.col("r_host")), "left")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (left >= min_left * F.col("n_words")))
        .drop("r_id", "r_hash", "r_host")
    )


def filter_documents(docs: DataFrame, percent: int = 1, line_words: int = 10, min_docs: int = 3, min_left: float = 0.5) -> DataFrame:
    """The kept rows of ``docs`` with their frequent lines removed; same columns.
    A numeric ``n_chars`` column is measured again."""
    verdicts = judged(docs, percent, line_words, min_docs, min_left).where("kept").select("doc_id", "text_hash", "host", "removed").dropDuplicates(["doc_id", "text_hash", "host"])
    v = verdicts.toDF("__llm_id", "__llm_hash", "__llm_host", "__llm_removed")
    body, host = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("source"), F.lit(""))
    same = F.col("doc_id").eqNullSafe(F.col("__llm_id")) & (F.xxhash64(body) == F.col("__llm_hash")) & (host == F.col("__llm_host"))
    stay = F.filter(F.split("text", "\n"), lambda x: ~has_word(x) | ~F.array_contains("__llm_removed", line_hash(x)))
    text = F.when(F.col("__llm_removed").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n"))
    out = docs.join(v, same).withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__llm_removed").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return out.select(*docs.columns)
