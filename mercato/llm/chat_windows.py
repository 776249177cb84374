"""Chat formatting in budgeted windows.

Template. A turn is ``<|im_start|>ROLE`` newline TEXT ``<|im_end|>`` newline.
Inside texts and roles every ``<`` with any number of backslashes and a ``|``
behind it gets one more backslash, so no text can hold a control string, and
taking one backslash off gives the text back. A newline in a role is written
as backslash n (its backslashes are doubled).

Windows. Turns are put in order by (turn, role, text). The first turn, if its
role is "system", heads every window of its conversation. A turn's tokens are
those of the whole formatted turn, marks, role and escapes included. They are
summed up in prefix sums, and the sums are cut at the multiples of the body's
budget (what the system turn and the usual history leave): turns that lie
between two multiples share a window, one that crosses a multiple has a window
of its own. In front of its own turns a window repeats the last turns of the
window before it, up to ``history`` tokens and only as far as its budget goes.

So a window holds whole turns and at most ``budget`` tokens, but for one case:
a single turn that exceeds the budget together with its system turn is kept
whole, behind the system turn and without history. A system turn of ``budget``
or more tokens is such a turn itself: it has the first window for its own and
is not repeated, as no window could hold it and another turn.

Mask. The loss covers the texts of assistant turns, each once: repeated
system and history turns are masked out.

The prefix sums are built without gathering a conversation: rows are range
partitioned and written, summed within a partition, and offset by the sums of
the conversation's earlier partitions. Windows are bounded by the budget, and
the window before is found by a join on its end. So one conversation may hold
any share of the rows.

Null texts and roles are empty; a null turn sorts first, a null conv_id is a
conversation of its own. Repeated rows are turns of their own. Other columns
are ignored, whatever their names. An empty table gives no windows.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mercato.llm.common import batch, keep, tune

BUDGET = 2048        # tokens of a window
HISTORY = 256        # tokens of repeated turns at most
START, END = "<|im_start|>", "<|im_end|>"

_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_ESCAPED = re.compile(r"<(\\*)\\\|")
_CONTROL = re.compile(r"<(\\*)\|")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


def formatted_turn(role: str, text: str) -> str:
    """One turn as the template writes it."""
    role = role.replace("\\", "\\\\").replace("\n", "\\n")
    return START + _CONTROL.sub(r"<\1\\|", role) + "\n" + _CONTROL.sub(r"<\1\\|", text) + END + "\n"


def count_tokens(turns: DataFrame, path: str) -> DataFrame:
    """``turns`` with a column tokens: the tokens of the formatted turn. The
    newline between turns is a token border, so a window's tokens are the sum."""
    schema = "conv_id long, turn long, role string, text string, tokens long"

    def run(batches) -> Iterator:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokenizer = Tokenizer.from_file(path)
        for b in batches:
            columns = [c.to_pylist() for c in b.columns]
            found = tokenizer.encode_batch_fast([formatted_turn(r, t) for r, t in zip(columns[2], columns[3])], add_special_tokens=False)
            yield batch(schema, [*columns, [len(e.ids) for e in found]])

    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


def windows(conversations: DataFrame, path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each window: conv_id, at (its place in the conversation),
    n_system and n_history (turns repeated in front), formatted, loss (an array
    of [start, end) code points of ``formatted`` under the loss mask)."""
    tune(conversations.sparkSession)
    order = ["conv_id", "turn", "role", "text"]
    turns = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    turns = count_tokens(turns.repartitionByRange(*order).sortWithinPartitions(*order), path)
    turns = keep(turns.withColumn("part", F.spark_partition_id()), "turns")

    # The system turn: first of its conversation in (turn, role, text).
    by_conv = F.col("conv_id").eqNullSafe(F.col("c"))
    first = turns.groupBy("conv_id").agg(F.min(F.struct(F.coalesce("turn", F.lit(-(1 << 62))).alias("turn"), "role", "text", "tokens")).alias("f"))
    system = keep(first.where((F.col("f.role") == "system") & (F.col("f.tokens") < budget)).select(F.col("conv_id").alias("c"), F.col("f.turn").alias("s_turn"), F.col("f.text").alias("s_text"), F.col("f.tokens").alias("s_tokens")), "system")
    inside = Window.partitionBy("part", "conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("sum", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).withColumn("row", F.count(F.lit(1)).over(inside))
    # A conversation's rows before a partition: a row for each partition it reaches.
    sums = turns.groupBy(F.col("conv_id").alias("c"), F.col("part").alias("p")).agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("c", "p", F.coalesce(F.sum("t").over(earlier), F.lit(0)).alias("t"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n"))
    turns = turns.join(sums, by_conv & (F.col("part") == F.col("p"))).withColumn("sum", F.col("sum") + F.col("t")).withColumn("row", F.col("row") + F.col("n")).drop("c", "p", "t", "n")
    turns = turns.join(system, by_conv, "left").drop("c")
    headed = F.col("s_tokens").isNotNull()
    turns = turns.where(~(headed & (F.col("row") == 0)) | ~headed)
    turns = turns.withColumn("begin", F.col("sum") - F.coalesce("s_tokens", F.lit(0)))
    # What the system turn leaves, less the history's usual share.
    turns = turns.withColumn("room", F.lit(budget) - F.coalesce("s_tokens", F.lit(0)))
    body = F.col("room") - F.least(F.lit(history), F.floor(F.col("room") / 4))
    low = F.floor(F.col("begin") / body)
    turns = turns.withColumn("cell", low).withColumn("crosses", F.floor((F.col("begin") + F.col("tokens") - 1) / body) > low)
    one = F.struct("begin", "tokens", "role", "text")
    made = turns.groupBy("conv_id", "cell", "crosses").agg(
        F.sort_array(F.collect_list(one)).alias("turns"), F.min("begin").alias("at"), F.max(F.col("begin") + F.col("tokens")).alias("stop"),
        F.first("s_text").alias("s_text"), F.first("room").alias("room"))
    made = keep(made.drop("cell", "crosses"), "windows")
    # What the next window may repeat, and what its own turns leave room for.
    tail = F.filter("turns", lambda t: F.col("stop") - t["begin"] <= history)
    before = made.select(F.col("conv_id").alias("c"), F.col("stop").alias("b"), tail.alias("history"))
    made = made.join(before, by_conv & (F.col("at") == F.col("b")), "left").drop("c", "b")
    spare = F.col("room") - (F.col("stop") - F.col("at"))
    history_ = F.coalesce(F.filter("history", lambda t: F.col("at") - t["begin"] <= spare), F.expr("slice(turns, 1, 0)"))
    # A conversation of a system turn alone has one window of no other turns.
    alone = system.join(made.select("conv_id").distinct(), by_conv, "left_anti")
    alone = alone.select(F.col("c").alias("conv_id"), F.lit(0).cast("long").alias("at"), F.col("s_text"), F.lit(True).alias("only"))
    made = made.withColumn("history", history_).withColumn("only", F.lit(False)).unionByName(alone, allowMissingColumns=True)

    def turn(t: Column) -> Column:
        return F.concat(F.lit(START), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END + "\n"))

    def many(c: str) -> Column:
        return F.coalesce(F.array_join(F.transform(c, turn), ""), F.lit(""))

    head = F.when(F.col("s_text").isNull(), F.lit("")).otherwise(F.concat(F.lit(START + "system\n"), escaped(F.col("s_text")), F.lit(END + "\n")))
    made = made.withColumn("head", head).withColumn("repeated", many("history"))
    skip = F.length("head") + F.length("repeated")
    state = F.struct(F.col("skip").alias("pos"), F.expr("cast(array() as array<array<int>>)").alias("spans"))

    def span(s: Column, t: Column) -> Column:
        begin = s["pos"] + len(START) + F.length(escaped_role(t["role"])) + 1
        end = begin + F.length(escaped(t["text"]))
        return F.struct((end + len(END) + 1).alias("pos"),
                        F.when(t["role"] == "assistant", F.concat(s["spans"], F.array(F.array(begin, end)))).otherwise(s["spans"]).alias("spans"))

    made = made.withColumn("skip", skip).withColumn("loss", F.coalesce(F.aggregate("turns", state, span, lambda s: s["spans"]), F.expr("cast(array() as array<array<int>>)")))
    new_head = (F.col("at") == 0) & F.col("s_text").isNotNull()
    return made.select("conv_id", "at", (F.col("s_text").isNotNull() & ~new_head).cast("int").alias("n_system"),
                       F.coalesce(F.size("history"), F.lit(0)).alias("n_history"), F.concat("head", "repeated", many("turns")).alias("formatted"), "loss")


def read_window(formatted: str, n_system: int, n_history: int) -> list[tuple[str, str]]:
    """(role, text) of the turns that a window has not repeated."""
    return [(unescape_role(r), unescape(t)) for r, t in _TURN.findall(formatted)][n_system + n_history:]


def _digests(batches):
    """Conversations stream by in order; one window and two hash states are held."""
    out = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    conv, n, turns, chars, loss, size = None, None, sha256(), 0, sha256(), 0
    for b in batches:
        rows = []
        for c, formatted, n_system, n_history, spans in zip(*(b.column(k).to_pylist() for k in ("conv_id", "formatted", "n_system", "n_history", "loss"))):
            if n is None or c != conv:
                if n is not None:
                    rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                conv, n, turns, chars, loss, size = c, 0, sha256(), 0, sha256(), 0
            for role, text in read_window(formatted, n_system, n_history):
                turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
                n += 1
            for s, e in spans:
                text = unescape(formatted[s:e])
                loss.update(text.encode("utf-8", "replace"))
                chars += len(text)
            size += len(formatted)
        yield batch(out, list(zip(*rows)) if rows else [[]] * 6)
    if n is not None:
        yield batch(out, [[x] for x in (conv, n, turns.hexdigest(), chars, loss.hexdigest(), size)])


def digests(made: DataFrame) -> DataFrame:
    """What the windows hold, read back, per conversation. A digest over a
    conversation is one pass over it in order: it streams through one task."""
    rows = made.select("conv_id", "at", "n_system", "n_history", "formatted", "loss")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "at")
    return rows.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
