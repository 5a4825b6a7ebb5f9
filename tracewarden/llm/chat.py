"""Chat formatting in windows of a token budget, with DataFrame functions only.

A turn is written ``<turn>role\\ntext</turn>\\n``. Inside a role or text ``\\`` becomes ``\\b``, ``<`` becomes ``\\l`` and, in a role, a line end becomes ``\\n``: no
control string can occur there, and the escapes are undone one after the other.

Prefix sums of the turns' tokens choose turn-aligned spans: a window ends before the turn that would exceed its budget. Each window repeats the system turn (a
first turn of that role) and as many of the turns just before it as fit in ``history`` tokens. Repeated turns come first and are never under the loss mask,
so each assistant text is a target exactly once. A turn that alone exceeds the budget gets a window of its own, uncut.

A conversation is one record: its turns meet in one row, as its format needs. Conversations are dealt by a hash of their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUDGET, HISTORY = 512, 128
OPEN, CLOSE = "<turn>", "</turn>\n"
SYSTEM, ASSISTANT = "system", "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    # Every backslash is followed by its letter, so "\l" is never part of an escaped backslash.
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def word_tokens(text: Column) -> Column:
    """The default token count: runs of letters and digits, and single other marks."""
    return F.regexp_count(text, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"))


def _conversations(turns: DataFrame, tokens) -> DataFrame:
    """``conv_id, t``: all turns of a conversation in order, rendered, with prefix sums of their tokens."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text")).select(
        "conv_id", F.struct(
            "turn", F.col("role"), F.col("text").alias("raw"), head.alias("head"), escaped(F.col("text")).alias("body"),
            tokens(F.concat("role", F.lit(" "), "text")).cast("bigint").alias("tokens")).alias("x"))
    grouped = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    sums = F.aggregate("x", F.array(F.lit(0).cast("bigint")), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x["tokens"])))
    return grouped.select("conv_id", sums.alias("sums"), F.transform("x", lambda x, i: F.struct(
        i.alias("i"), x["role"].alias("role"), x["head"].alias("head"), x["body"].alias("body"))).alias("t"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens=word_tokens) -> DataFrame:
    """``conv_id, window, text, n_turns, n_repeated, n_tokens, loss`` for ``turns(conv_id, turn, role, text)``.

    ``loss`` lists the spans ``[start, end)`` of characters of ``text`` that are targets; the first ``n_repeated`` of the window's
    turns are repeated. Turns of one number come in the order of role and text; null roles and texts are empty; rows without an id
    form one conversation; repeated rows are turns of their own. An empty table gives no rows. Other columns are not read.
    """
    assert 0 <= history < budget
    conv = _conversations(turns, tokens)
    n = F.size("t")
    has_system = F.when(F.element_at("t", 1)["role"] == SYSTEM, 1).otherwise(0)
    conv = conv.withColumn("sys", has_system).withColumn(
        "sys_tokens", F.when(F.col("sys") == 1, F.element_at("sums", 2)).otherwise(F.lit(0).cast("bigint")))

    # Starts of the windows after the first, which begins at turn 0; ``base`` is the prefix sum at the last start.
    def next_start(a, x):
        room = F.lit(budget) - F.col("sys_tokens") - F.when(F.size(a["starts"]) > 1, F.lit(history)).otherwise(0)
        end, before = F.get(F.col("sums"), x["i"] + 1), F.get(F.col("sums"), x["i"])
        opens = (end - a["base"] > room) & (x["i"] > F.element_at(a["starts"], -1)) & (x["i"] > F.col("sys"))
        return F.when(opens, F.struct(F.concat(a["starts"], F.array(x["i"])).alias("starts"), before.alias("base"))).otherwise(a)

    first = F.struct(F.array(F.lit(0)).alias("starts"), F.col("sys_tokens").alias("base"))
    conv = conv.withColumn("starts", F.aggregate("t", first, next_start)["starts"])
    one = conv.select("*", n.alias("n"), F.posexplode("starts").alias("window", "start")).withColumn(
        "end", F.coalesce(F.get(F.col("starts"), F.col("window") + 1), F.col("n")))
    later = F.col("window") > 0
    recent = lambda x: later & (x["i"] >= F.col("sys")) & (x["i"] < F.col("start")) & (
        F.get(F.col("sums"), F.col("start")) - F.get(F.col("sums"), x["i"]) <= history)
    again = lambda x: (later & (x["i"] < F.col("sys"))) | recent(x)
    one = one.withColumn("again", F.filter("t", again)).withColumn("new", F.slice("t", F.col("start") + 1, F.col("end") - F.col("start")))
    render = lambda parts: F.array_join(F.transform(parts, lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    one = one.withColumn("prefix", render(F.col("again")))
    spans = F.aggregate(
        "new", F.struct(F.length("prefix").alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda a, x: F.struct(
            (a["at"] + F.length(x["head"]) + F.length(x["body"]) + len(CLOSE)).alias("at"),
            F.when(x["role"] == ASSISTANT, F.concat(a["spans"], F.array(F.struct(
                (a["at"] + F.length(x["head"])).alias("start"),
                (a["at"] + F.length(x["head"]) + F.length(x["body"])).alias("end"))))).otherwise(a["spans"]).alias("spans")))
    # Prefix sums of the repeated turns: the system turn, and the stretch from the first recent one.
    oldest = F.array_min(F.transform(F.filter("again", recent), lambda x: x["i"]))
    repeated = F.when(later, F.col("sys_tokens")).otherwise(0) + F.coalesce(
        F.get(F.col("sums"), F.col("start")) - F.get(F.col("sums"), oldest), F.lit(0))
    total = F.get(F.col("sums"), F.col("end")) - F.get(F.col("sums"), F.col("start")) + repeated
    return one.select(
        "conv_id", "window", F.concat("prefix", render(F.col("new"))).alias("text"), (F.size("again") + F.size("new")).alias("n_turns"),
        F.size("again").alias("n_repeated"), total.alias("n_tokens"), spans["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns`` (role and text, each once, in order), ``targets`` (texts under the loss mask), ``formatted_chars``, from windows alone."""
    blocks = F.slice(F.split("text", "</turn>\n", -1), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    parsed = F.transform(blocks, lambda b: F.struct(
        unescaped(F.replace(F.substring_index(b, "\n", 1).substr(F.lit(len(OPEN) + 1), F.length(b)), F.lit("\\n"), F.lit("\n"))).alias("role"),
        unescaped(b.substr(F.instr(b, "\n") + 1, F.length(b))).alias("text")))
    targets = F.transform("loss", lambda s: unescaped(F.col("text").substr(s["start"] + 1, s["end"] - s["start"])))
    per_window = formatted.select("conv_id", F.struct(
        "window", parsed.alias("turns"), targets.alias("targets"), F.length("text").cast("bigint").alias("chars")).alias("w"))
    ordered = per_window.groupBy("conv_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    return ordered.select(
        "conv_id", F.flatten("w.turns").alias("turns"), F.flatten("w.targets").alias("targets"),
        F.aggregate("w.chars", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("formatted_chars"))
