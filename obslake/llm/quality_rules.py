"""Line-first cleaning with Spark SQL functions only: rules per line, failing lines go, then a rule on what is left.

A line fails when it is

* unpunctuated: five words or more and no word that ends in sentence punctuation,
* navigation: at least two separators, and one for every three words or more,
* marked up: a run of the same mark on at least a third of its words,
* boilerplate: thirty words at most, with a phrase of notices that sites repeat.

The document is rejected when the lines that stay hold under ``min_left`` percent of its words, or when the base
rules fail: fewer than ``min_words`` words, or more than ``max_repeat`` percent of them in repeated three-word
windows. The windows are found by sorting (hash, place) within the row, so a text of any length costs
n log n and nothing is exploded or shuffled.

Null and empty texts have no words, fail the base and are not kept. Repeated rows are judged one by one.
Columns other than ``doc_id`` and ``text`` are ignored by ``judge`` and kept by ``keep``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from obslake.llm.common import WORD, ascii_lower

SYMBOLS = r"[#*$%&|<>]"
SENTENCE_END = r"[.,;:!?…]['\")\]]*(?:[\x20\x09-\x0D]|\z)"
SEPARATORS = r"[|»›]"
MARK_RUNS = r"!!+|\*\*+|##+|\$\$+|%%+|&&+"
BOILERPLATE = (r"all rights reserved|licensed under|privacy policy|terms of (?:use|service)|cookie|enable javascript"
               r"|sign in|log in|subscribe|click here|skip to content|lorem ipsum")


def _count(col: Column, pattern: str) -> Column:
    return F.regexp_count(col, F.lit(pattern))


def _fails(line: Column) -> Column:
    """``line``: struct of text and its number of words."""
    text, words = line["text"], line["words"]
    marks, bars = _count(text, MARK_RUNS), _count(text, SEPARATORS)
    return (((words >= 5) & ~text.rlike(SENTENCE_END))
            | ((bars >= 2) & (bars * 3 >= words))
            | ((marks >= 1) & (marks * 3 >= words))
            | ((words <= 30) & ascii_lower(text).rlike(BOILERPLATE)))


def judge(docs: DataFrame, min_words: int = 50, max_repeat: int = 50, min_left: int = 50,
          carried: tuple[Column, ...] = ()) -> DataFrame:
    """Per row of ``docs``: the base figures, ``n_words_left`` and the verdict ``kept``, beside ``carried`` columns."""
    names = [f"carried_{i}" for i in range(len(carried))]
    text = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                    *[c.alias(n) for c, n in zip(carried, names, strict=True)])
    d = d.withColumn("w", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    d = d.withColumn("n_words", F.size("w").cast("long"))
    lines = F.filter(
        F.transform(F.split("text", "\n"), lambda x: F.struct(x.alias("text"), _count(x, WORD).alias("words"))),
        lambda x: x["words"] > 0)
    d = d.withColumn("lines", lines)
    places = F.when(F.col("n_words") >= 3, F.sequence(F.lit(0), F.col("n_words").cast("int") - 3))
    d = d.withColumn("windows", F.sort_array(F.transform(places, lambda i: F.struct(
        F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")))))
    same = lambda x, i: F.coalesce(F.get("windows", i)["h"] == x["h"], F.lit(False))
    found = F.filter("windows", lambda x, i: same(x, i - 1) | same(x, i + 1))
    d = d.withColumn("twice", F.sort_array(F.transform(found, lambda x: x["i"])))
    covered = F.transform("twice", lambda p, i: F.least(F.lit(3), F.coalesce(F.get("twice", i + 1) - p, F.lit(3))))
    total = lambda xs: F.coalesce(F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0).cast("long"))
    d = d.select(
        *names, "doc_id", "n_words",
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct(F.transform("lines", lambda x: x["text"])))).cast("long").alias("n_dup_lines"),
        total(covered).alias("n_repeat_words"),
        total(F.transform("lines", lambda x: F.when(_fails(x), 0).otherwise(x["words"]))).alias("n_words_left"))
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat)
    return d.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("n_words_left") * 100 >= F.col("n_words") * min_left))


def clean(docs: DataFrame) -> DataFrame:
    """``docs`` with failing lines taken out of ``text``; lines without a word stay as they are."""
    counted = F.transform(F.split(F.coalesce(F.col("text"), F.lit("")), "\n"),
                          lambda x: F.struct(x.alias("text"), _count(x, WORD).alias("words")))
    left = F.filter(counted, lambda x: (x["words"] == 0) | ~_fails(x))
    return docs.withColumn("text", F.array_join(F.transform(left, lambda x: x["text"]), "\n"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, unchanged, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    # a filter on a plain column would be pushed below the projections, and evaluate them anew for every array element
    judged = judge(docs, carried=(row,)).select("carried_0", F.explode(F.array("kept")).alias("kept"))
    return judged.where("kept").select("carried_0.*")
