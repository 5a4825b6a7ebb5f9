"""Spelling variants by permuterm rotations.

A word is ended by a mark and all rotations of the result are sorted. Rotations are made so that the edited character comes last: then
two words that differ by a replacement there have rotations with the same prefix, all but the last character, and a word that lacks
the character has a whole rotation equal to that prefix. Rows are dealt and sorted by this prefix, and a scan of each range emits what each
word of it learns: how many neighbours it has there and which of them is the most frequent.

Words of a range differ in one character, which they all have, so a range has no more words than the alphabet has characters, and one
more. No pairs are made: a word's best neighbour in a range is the range's first word, or its second if it is the first itself.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tracewarden.plans.skew import split_join
from tracewarden.session import cut_lineage, written_table

#: The mark; no word holds it.
END = "\x00"
#: Letters of a word: those of ASCII and the code points from U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def document_words(docs: DataFrame, shortest: int = 7, every: int | None = None) -> DataFrame:
    """``word, n``: the words of all whole texts with ``shortest`` characters or more, with their occurrences.

    A word is a longest run of ``LETTERS`` with A-Z lowered; null and empty texts have none, and repeated rows count each time. With
    ``every``, misspellings are made: where it divides h, the crc32 of ``<doc_id>:<word>`` (a null id as nothing), the character at
    h modulo the length is left out, and the length counts afterwards.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(
        F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("run"))
    # One row per document and run first: the rest is made once for all repeats.
    word = F.translate("run", _UPPER, _LOWER)
    if every is None:
        return runs.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    lowered = runs.select("doc_id", word.alias("word")).withColumn(
        "h", F.crc32(F.concat("doc_id", F.lit(":"), "word").cast("binary")))
    gone = F.col("h") % F.length("word")
    made = F.when(F.col("h") % every == 0, F.concat(
        F.substring("word", F.lit(1), gone.cast("int")), F.expr(f"substring(word, cast(h % length(word) as int) + 2)"))).otherwise(F.col("word"))
    return lowered.select(made.alias("word")).filter(F.length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """``range, edited, word, n, first``: the rotations of each marked word, cut before the edited character that comes last; and
    whole ones, for a character that the word lacks (``edited`` null). ``first``: no equal character stands right before
    the edited one. Of equal characters in a row only the first counts as left out, so that words find each other once."""
    at = words.withColumn("i", F.explode(F.sequence(F.lit(0), F.length("word"))))
    head, tail = F.expr("substring(word, 1, i)"), F.expr("substring(word, i + 1)")
    whole = at.select(F.concat(tail, F.lit(END), head).alias("range"), F.lit(None).cast("string").alias("edited"), "word", "n",
                      F.lit(False).alias("first"))
    cut = at.filter(F.col("i") < F.length("word")).select(
        F.concat(F.expr("substring(word, i + 2)"), F.lit(END), head).alias("range"),
        F.expr("substring(word, i + 1, 1)").alias("edited"), "word", "n",
        F.expr("i = 0 or substring(word, i, 1) != substring(word, i + 1, 1)").alias("first"))
    return whole.unionByName(cut)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, n, n_near, best``: how many of ``words`` (``word, n``, each once) are one edit away, and of these the most frequent, the
    smallest of equal ones, as a struct ``(less, word)`` with ``less`` the negative of its n. Null where there are none."""
    order = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    scan = W.partitionBy("range")
    other = F.col("edited").isNotNull()
    ranked = scan.orderBy(F.col("edited").isNull(), F.desc("n"), "word")
    all_rows = ranked.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # The rows with the character, best first, then the word without it.
    rows = rotations(words).withColumns({
        "place": F.row_number().over(ranked),
        "others": F.count("edited").over(all_rows),
        "top": F.first(F.when(other, order)).over(all_rows),
        "second": F.nth_value(F.when(other, order), 2).over(all_rows),
        "base": F.last(F.when(~other, order)).over(all_rows),
        "firsts": F.count_if("first").over(all_rows),
        "top_first": F.first(F.when(F.col("first"), order), ignorenulls=True).over(all_rows),
    })
    replaced = F.when(F.col("place") == 1, F.col("second")).otherwise(F.col("top"))
    lacking = F.when(F.col("first"), F.col("base"))
    found = rows.select(
        "word", "n",
        F.when(other, F.col("others") - 1 + F.when(lacking.isNotNull(), 1).otherwise(0)).otherwise(F.col("firsts")).alias("n_near"),
        F.when(other, F.least(replaced, lacking)).otherwise(F.col("top_first")).alias("best"))
    return found.groupBy("word", "n").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, form, root`` of ``word, form``: the last word that following the forms leads to. A form has a form of its own or
    none, and forms never lead back. Each round halves what is left to follow."""
    linked = cut_lineage(forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    for _ in count():
        total = linked.count()
        onward = linked.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = split_join(linked, onward, ["root"], ["word"], how="left", total=total)
        if step.filter(F.col("next").isNotNull()).isEmpty():
            break
        linked = cut_lineage(step.select("word", F.coalesce("next", "root").alias("root")))
    return forms.join(linked, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"))


def variants(words: DataFrame, fewest: int = 2, ratio: int = 10) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``words`` (``word, n``) that occur ``fewest`` times.

    Words are near if one replaced, added or left out character makes one of the other. A word's form is its most frequent near word (of
    equal ones the smallest by code point), if that occurs ``ratio`` times as often; ``root`` follows the forms to the end and is the
    word itself where there is none. Null and empty words and extra columns are left out; repeated words add up; an empty
    table gives no rows. A word may have any length and any characters but U+0000; it makes twice as many rows as it has
    characters.
    """
    known = words.filter(F.length("word") > 0).groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)
    known = written_table(known, "spelling-words")
    near = written_table(neighbours(known).withColumn(
        "form", F.when(-F.col("best.less") >= ratio * F.col("n"), F.col("best.word"))), "spelling-near")
    found = roots(near.select("word", "form"))
    return near.join(found.select("word", "root"), "word").select(
        "word", "form", "root", "n", "n_near", F.when(F.col("form").isNotNull(), -F.col("best.less")).alias("form_n"))
