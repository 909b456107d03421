"""Conversations as training windows of a token budget, with marks, escapes and a loss mask.

Windows hold whole turns. Where they begin follows from prefix sums of the turns' tokens: a window
takes turns as long as they fit in the budget. A later window starts with the conversation's system
turn and with the last turns of the window before, at most ``history`` of them and only as far as
they leave room for the next turn. Such repeated turns stand in ``n_repeated`` and are never under
the loss mask, so each text of an assistant is a target once.

A turn is written ``<s>[INST]role[/INST]text</s>``. Where a role or text has one of these marks, a
backslash is put behind its first character, and one more where it already looks like that, which
``unescape`` takes back exactly.

Only built-in functions run. A conversation of more than ``block`` tokens is cut into blocks by
prefix sums that are computed over range parts, so a single conversation may hold any share of the
rows; a window never crosses a block. A group holds at most ``block`` tokens and one turn.

Edge cases: null roles and texts count as empty ones. Null turn numbers come first; rows of one
number are put in order by role and text. Rows with null conversation id form one conversation. An
empty turn still has its marks. A turn that is longer than the budget gets a window of its own,
with ``oversized`` true, and is never cut. A system turn longer than the budget is retained all the
same. Only a system turn that comes first is retained; others are turns like any. Repeated rows are
turns of their own. An empty table gives an empty result. Further columns are not read.
"""

from pyspark.sql import Window, functions as F

from ..operators.joins import fits, hinted
from ..operators.ordered import running
from .text import whole

ASSISTANT, SYSTEM = "assistant", "system"
#: Tokens that the marks of a turn count for.
MARKS = 4
_MARK = r"(/?s>|/?INST\])"
_TURN = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"


def escape(text):
    return F.regexp_replace(text, r"([<\[])(\\*)" + _MARK, r"$1\\$2$3")


def unescape(text):
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _MARK, "$1$2$3")


def words(text):
    """A turn's tokens as words; pass another column expression for a real tokenizer's counts."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++"))


def _turns(conversations, conv_id, turn, role, text, tokens):
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        whole(F.col(role)).alias("role"),
        whole(F.col(text)).alias("text"),
    )
    return rows.withColumn("tokens", (tokens(F.col("text")) + MARKS).cast("long"))


def _blocks(rows, block, budget):
    """Turns of long conversations in blocks by prefix sums; the end of a block also goes on as
    ``old`` rows into the next, and the system turn goes into all."""
    order = ["turn", "role", "text"]
    placed = running(rows, ["conv_id"], order, {"start": ("sum", F.col("tokens"), True)})
    placed = placed.withColumn("start", F.coalesce("start", F.lit(0)))
    number = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + budget) / block)  # history is shorter than the budget
    copies = F.explode(
        F.when(last > number, F.array(F.struct(number.alias("block"), F.lit(False).alias("old")),
                                      F.struct(last.alias("block"), F.lit(True).alias("old"))))
        .otherwise(F.array(F.struct(number.alias("block"), F.lit(False).alias("old"))))
    )
    dealt = placed.select("*", copies.alias("__c")).select("*", "__c.block", "__c.old").drop("__c")
    systems = placed.filter((F.col("start") == 0) & (F.col("role") == SYSTEM)).select(
        F.col("conv_id").alias("__conv"), F.struct("role", "text", "tokens").alias("first")
    )
    heads = dealt.filter("block > 0 AND NOT old").groupBy("conv_id", "block").agg(F.lit(1).alias("__one"))
    kept = heads.join(systems, F.col("conv_id").eqNullSafe(F.col("__conv"))).select(
        "conv_id", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), "first.role",
        "first.text", "first.tokens", F.lit(-1).cast("long").alias("start"), "block", F.lit(True).alias("old"),
    )
    return dealt.unionByName(kept)


def _with_history(items, system, history, budget):
    """Each turn with the repeated turns that a window starting at it would begin with."""

    def lead(x, i):
        kept, used = F.lit(0), F.lit(0).cast("long")
        for k in range(1, history + 1):
            from_start = x["start"] - F.get(items, i - k)["start"]
            there = (i >= k) & ~F.get(items, i - k)["system"]
            here = there & (system + from_start + x["tokens"] <= budget)
            kept, used = F.when(here, k).otherwise(kept), F.when(here, from_start).otherwise(used)
        return F.struct(
            i.alias("i"), x["role"].alias("role"), x["text"].alias("text"), x["tokens"].alias("tokens"),
            x["old"].alias("old"), kept.alias("history"), used.alias("used"),
        )

    return F.transform(items, lead)


def _starts(turns, system, budget):
    """Numbers of the turns at which windows begin."""
    nothing = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("used"))

    def step(state, x):
        full = (F.size(state["starts"]) == 0) | (state["used"] + x["tokens"] > budget)
        lead = F.when(x["i"] == 0, 0).otherwise(system + x["used"])
        begun = F.struct(
            F.concat(state["starts"], F.array(x["i"])).alias("starts"),
            (lead + x["tokens"]).alias("used"),
        )
        longer = F.struct(state["starts"].alias("starts"), (state["used"] + x["tokens"]).alias("used"))
        return F.when(x["old"], state).otherwise(F.when(full, begun).otherwise(longer))

    return F.aggregate(turns, nothing, step, lambda state: state["starts"])


def _written(turns, repeated):
    """A window's text and the places of its targets, from its turns."""
    nothing = F.struct(
        F.lit(1).alias("at"), F.lit(0).alias("i"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")
    )

    def step(state, x):
        begin = state["at"] + F.length(x["head"])
        length = F.length(x["body"])
        target = (x["role"] == ASSISTANT) & (state["i"] >= repeated) & (length > 0)
        span = F.array(F.struct(begin.alias("start"), length.alias("length")))
        return F.struct(
            (begin + length + len("</s>")).alias("at"),
            (state["i"] + 1).alias("i"),
            F.when(target, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    text = F.array_join(F.transform(turns, lambda x: F.concat(x["head"], x["body"], F.lit("</s>"))), "")
    return text, F.aggregate(turns, nothing, step, lambda state: state["spans"])


def windows(conversations, conv_id="conv_id", turn="turn", role="role", text="text", tokens=words,
            budget=1_024, history=2, block=65_536):
    """One row a window: ``conv_id``, ``block`` and ``window`` (their order), ``text``, ``spans``
    (targets as start, from 1, and length in code points), ``n_turns``, ``n_repeated``, ``tokens``
    and ``oversized``."""
    if block < budget:
        raise ValueError("a block holds a window at least")
    rows = _turns(conversations, conv_id, turn, role, text, tokens)
    totals = rows.groupBy("conv_id").agg(F.sum("tokens").alias("total")).filter(F.col("total") > block)
    long_ids = totals.select(F.col("conv_id").alias("__conv"))
    n_long = fits(long_ids)
    same = F.col("conv_id").eqNullSafe(F.col("__conv"))
    short = rows if n_long == 0 else rows.join(hinted(long_ids, n_long), same, "left_anti")
    unset = {"start": F.lit(0).cast("long"), "block": F.lit(0).cast("long"), "old": F.lit(False)}
    result = _windows(short.withColumns(unset), ["conv_id"], budget, history)
    if n_long != 0:
        cut = _blocks(rows.join(hinted(long_ids, n_long), same, "left_semi"), block, budget)
        result = result.unionByName(_windows(cut, ["conv_id", "block"], budget, history))
    return result


def _windows(rows, group, budget, history):
    in_order = Window.partitionBy(*group).orderBy("start", "turn", "role", "text")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumns(
        {
            "__i": F.row_number().over(in_order),
            "__start": F.coalesce(F.sum("tokens").over(before), F.lit(0)),
        }
    )
    first = (F.col("__i") == 1) & (F.col("role") == SYSTEM) & ((F.col("block") == 0) | (F.col("start") < 0))
    item = F.struct(
        F.col("__i").alias("i"), F.col("__start").alias("start"), "role", "text", "tokens", "old",
        first.alias("system"),
    )
    lists = placed.groupBy(*group).agg(
        F.sort_array(F.collect_list(item)).alias("items"), F.first("block").alias("__block")
    )
    head = F.get("items", F.lit(0))
    system = F.when(head["system"], head["tokens"]).otherwise(0)
    told = lists.withColumn("__system", system).withColumn(
        "items", _with_history(F.col("items"), F.col("__system"), history, budget)
    )
    begun = told.withColumn("__starts", _starts(F.col("items"), F.col("__system"), budget))

    def content(b, w):
        x = F.get("items", b)
        retained = (b > 0) & (F.col("__system") > 0)
        end = F.coalesce(F.get("__starts", w + 1), F.size("items"))
        lead = F.slice("items", 1, F.when(retained, 1).otherwise(0))
        turns = F.concat(lead, F.slice("items", b - x["history"] + 1, x["history"] + end - b))
        return F.struct(
            w.alias("window"),
            (x["history"] + F.when(retained, 1).otherwise(0)).alias("n_repeated"),
            F.transform(
                turns,
                lambda t: F.struct(
                    t["role"].alias("role"), t["tokens"].alias("tokens"),
                    F.concat(F.lit("<s>[INST]"), escape(t["role"]), F.lit("[/INST]")).alias("head"),
                    escape(t["text"]).alias("body"),
                ),
            ).alias("turns"),
        )

    cut = begun.select("conv_id", F.col("__block").alias("block"), F.inline(F.transform("__starts", content)))
    text, spans = _written(F.col("turns"), F.col("n_repeated"))
    tokens = F.aggregate(F.col("turns"), F.lit(0).cast("long"), lambda total, t: total + t["tokens"])
    return cut.select(
        "conv_id", "block", "window", text.alias("text"), spans.alias("spans"),
        F.size("turns").alias("n_turns"), "n_repeated", tokens.alias("tokens"),
        (tokens > budget).alias("oversized"),
    )


def read_turns(text, n_repeated=None):
    """Role and text of a window's turns, as they were, without the first ``n_repeated``."""
    roles, texts = (F.regexp_extract_all(text, F.lit(_TURN), i) for i in (1, 2))
    pairs = F.arrays_zip(roles.alias("role"), texts.alias("text"))
    if n_repeated is not None:
        pairs = F.slice(pairs, n_repeated + 1, F.greatest(F.size(pairs), F.lit(1)))
    return F.transform(
        pairs,
        lambda t: F.struct(unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")),
    )


def read_targets(text, spans):
    """The texts under a window's loss mask, as they were."""
    return F.transform(spans, lambda s: unescape(F.substr(text, s["start"], s["length"])))
