r"""Conversations as training windows with a loss mask.

Template: `### <role>: <text></turn>\n` for each turn. In texts and roles `\`, `#` and `<` are written `\\`, `\h` and
`\l` (in roles also `:` as `\c`), so no control string can occur inside, and unescaping gives the original back.

Windows: prefix sums of turn tokens cut a conversation into spans of whole turns, a new span at each multiple of
`stride`. A window is the conversation's leading system turn, the turns of at most `history` tokens before the span, and
the span. Only assistant turns of the span itself are under the loss mask; what is repeated is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfwise.llm.workspace import written

HEAD, SEP, END = "### ", ": ", "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("#"), F.lit("\\h")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse of escape(), and of the `\\c` in roles. Splitting at double backslashes from the left keeps each code whole."""
    def plain(x: Column) -> Column:
        for code, char in (("\\h", "#"), ("\\l", "<"), ("\\c", ":")):
            x = F.replace(x, F.lit(code), F.lit(char))
        return x

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def format_windows(turns: DataFrame, stride: int = 512, history: int = 128, turn_tokens: int = 4, chunk: int = 1024) -> DataFrame:
    """Rows conv_id, window, formatted, n_repeated, loss_spans (code point ranges of formatted) from conv_id, turn, role, text.

    A turn's tokens are its words of non-white characters plus turn_tokens for the template. Turns are ordered by turn,
    role and text; null texts and roles are empty, null conv_id is a conversation of its own, null turns come first, rows
    that are repeated are turns of their own. Every turn is new in exactly one window; a turn longer than stride is a span
    of its own or ends one. An empty table gives no windows. Other columns are ignored. Prefix sums are taken in two steps,
    within runs of `chunk` turn numbers and over the runs, so that a conversation with a large part of all rows is spread
    over many tasks; texts are shuffled twice: to these runs, and to windows. history must not exceed stride.
    """
    if history > stride:
        raise ValueError("history must not exceed stride")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    conv = ["no_id", "id"]  # conv_id without nulls, so that joins and windows share a partitioning
    rows = turns.select(
        "conv_id", F.col("conv_id").isNull().alias("no_id"), F.coalesce("conv_id", F.lit(0).cast(turns.schema["conv_id"].dataType)).alias("id"), "turn",
        role.alias("role"), text.alias("text"), F.coalesce(F.expr(f"turn div {chunk}"), F.lit(-(1 << 62))).alias("chunk"),
    )
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(r"\S+")).cast("long") + F.lit(turn_tokens))
    runs = rows.groupBy(*conv, "chunk").agg(F.sum("tokens").alias("run"), F.count(F.lit(1)).alias("n"))
    whole, earlier = Window.partitionBy(*conv), Window.partitionBy(*conv).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *conv, "chunk", F.coalesce(F.sum("run").over(earlier), F.lit(0)).alias("run"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"),
        F.sum("run").over(whole).alias("total"),
    )
    order = ["turn", "role", "text"]
    within = Window.partitionBy(*conv, "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        rows.join(runs, [*conv, "chunk"])
        .withColumns({"before": F.coalesce(F.sum("tokens").over(within), F.lit(0)) + F.col("run"), "i": F.count(F.lit(1)).over(within) + F.col("n")})
        .withColumns({"span": F.expr(f"before div {stride}"), "lead": (F.col("i") == 0) & (F.col("role") == "system")})
    )
    # The leading system turn goes to every later span, any other turn to the next one if that can be near enough.
    last, near = F.expr(f"(total - 1) div {stride}"), (F.col("span") + 1) * stride - F.col("before") <= history
    windows = F.when(F.col("lead"), F.sequence("span", F.greatest("span", last))).when(near, F.array(F.col("span"), F.col("span") + 1)).otherwise(F.array("span"))
    parts = rows.select("conv_id", *conv, "role", "text", "before", "i", "span", "lead", F.explode(windows).alias("window"))
    parts = parts.withColumn("new", F.col("window") == F.col("span")).drop("span")
    ordered = Window.partitionBy(*conv, "window").orderBy("i")
    start = F.min(F.when(F.col("new"), F.col("before"))).over(ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.withColumn("start", start).where(f"start is not null and (new or lead or start - before <= {history})")
    head = F.concat(F.lit(HEAD), F.replace(escape(F.col("role")), F.lit(":"), F.lit("\\c")), F.lit(SEP))
    body = escape(F.col("text"))
    parts = parts.select(
        "conv_id", *conv, "window", "i", "new", F.concat(head, body, F.lit(END)).alias("part"),
        F.length(head).cast("long").alias("from"), F.length(body).cast("long").alias("n"), (F.col("new") & (F.col("role") == "assistant")).alias("target"),
    )
    so_far = F.sum(F.length("part")).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("from", F.col("from") + F.coalesce(so_far, F.lit(0)))
    span = F.when(F.col("target"), F.struct(F.col("from").alias("start"), (F.col("from") + F.col("n")).alias("end")))
    listed = F.array_sort(F.collect_list(F.struct("i", "part", "new", span.alias("loss"))))
    return parts.groupBy(*conv, "window").agg(F.min("conv_id").alias("conv_id"), listed.alias("x")).select(
        "conv_id", "window",
        F.array_join(F.col("x.part"), "").alias("formatted"),
        F.size(F.filter("x", lambda p: ~p["new"])).alias("n_repeated"),
        F.filter(F.col("x.loss"), lambda s: s.isNotNull()).alias("loss_spans"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """conv_id, window, turns (array of role, text) that are new in the window, loss (texts under the mask), n_chars."""
    cut = F.split("formatted", END, -1)  # of no meaning as a pattern, so it stands for itself
    new = F.slice(cut, F.col("n_repeated") + 1, F.size(cut) - 1 - F.col("n_repeated"))

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, SEP, 1)
        text = F.substr(piece, F.length(role) + F.lit(len(SEP) + 1))
        return F.struct(unescape(F.substr(role, F.lit(len(HEAD) + 1))).alias("role"), unescape(text).alias("text"))

    def masked(span: Column) -> Column:
        return unescape(F.substr(F.col("formatted"), (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    return windows.select(
        "conv_id", "window", F.transform(new, turn).alias("turns"), F.transform("loss_spans", masked).alias("loss"),
        F.length("formatted").cast("long").alias("n_chars"),
    )


def write_and_read(turns: DataFrame, **options: int) -> DataFrame:
    """format_windows() written to the shared folder and read again."""
    return written(format_windows(turns, **options), "chat-windows")
