"""Conversations as training texts: windows of whole turns within a token budget, with a loss mask.

Prefix sums of the turns' tokens place each turn of a conversation; a cell is
as many tokens as a window has room for new turns. The turns that start in a
cell are one window, or two where the last one reaches beyond the cell and
does not fit. So windows are found cell by cell, however long a conversation is.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellscope.llm.common import fresh, in_order, written
from cellscope.llm.token_counts import _tokenizer

# The template. A window's start, each role's marks before and after its text.
START = "<s>"
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
OTHER = ("[ROLE]", "[/ROLE] ", "</s>")
#: What is left of every control string after its first sign or two; one backslash more stands there in a text.
_CONTROL = r"/?(?:s>|SYS>|INST\]|ROLE\])"
_ESCAPED = re.compile(rf"([<\[])\\(\\*{_CONTROL})")
_TURN = re.compile(r"<<SYS>>\n(?P<system>.*?)\n<</SYS>>\n\n|\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?)</s>"
                   r"|\[ROLE\](?P<role>.*?)\[/ROLE\] (?P<other>.*?)</s>", re.DOTALL)

#: Texts that the tokenizer encodes at once (it holds much more than ids for each token).
AT_ONCE = 100
Counter = Callable[[list[str]], list[int]]
WINDOW = "first_turn long, new_turns long, repeated_turns long, has_system boolean, text string, loss array<struct<start:long,stop:long>>, n_tokens long, over_budget boolean"


def escaped(text: Column) -> Column:
    """``text`` without control strings; nulls are empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"([<\[])(\\*{_CONTROL})", r"$1\\$2")


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def bpe_counter(path: str) -> Callable[[], Counter]:
    """Counts tokens of texts by a file of the tokenizers library; its special strings are ordinary text."""
    def make() -> Counter:
        tokenizer = _tokenizer(path)
        return lambda texts: [len(e.ids) for i in range(0, len(texts), AT_ONCE)
                              for e in tokenizer.encode_batch(texts[i:i + AT_ONCE], add_special_tokens=False)]
    return make


def _turns(rows: DataFrame, counter: Callable[[], Counter], names: tuple[str, str, str, str]) -> DataFrame:
    """(key, conv, turn, role, piece, head, body, tokens, n): each turn as the template writes it.

    ``head``: code points before its text; ``body``: of its text; ``n``: unique.
    """
    @F.pandas_udf("long")
    def tokens(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = counter()
        for texts in parts:
            yield pd.Series([max(1, n) for n in count(texts.tolist())], dtype="int64")

    conv, turn, role, text = (F.col(f"`{c}`") for c in names)
    name, body = F.coalesce(role, F.lit("")), escaped(text)
    before, after = F.concat(F.lit(OTHER[0]), escaped(role), F.lit(OTHER[1])), F.lit(OTHER[2])
    for known, (opened, closed) in MARKS.items():
        before, after = F.when(name == known, F.lit(opened)).otherwise(before), F.when(name == known, F.lit(closed)).otherwise(after)
    told = rows.select(F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-")).alias("key"), conv.alias("conv"), turn.alias("turn"),
                       name.alias("role"), F.concat(before, body, after).alias("piece"), F.char_length(before).cast("long").alias("head"),
                       F.char_length(body).cast("long").alias("body"), F.monotonically_increasing_id().alias("n"))
    return written(told.withColumn("tokens", tokens("piece")), "chat-turns")


def _placed(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """(n, key, cell, kind, pos, at, room, cost): the cells that each turn goes to.

    ``kind`` 1: a turn that starts in the cell; 0: one that a window of the
    cell may repeat; 2: the conversation's system turn. ``at``: tokens of the
    earlier turns, without that system turn; ``cost``: tokens of every window
    before its turns.
    """
    narrow = turns.select("key", "turn", "role", F.xxhash64("piece").alias("h"), "n", "tokens")
    rows = in_order(narrow, ["key", "turn", "role", "h", "n"], "chat-order")
    inside = Window.partitionBy("part", "key").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part", "key").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"), F.sum("tokens").alias("sum"),
                                            F.min_by(F.struct("role", "tokens"), "at").alias("lead"))
    whole, by_part = Window.partitionBy("key"), Window.partitionBy("key").orderBy("part")
    earlier = by_part.rowsBetween(Window.unboundedPreceding, -1)
    lead = F.first("lead").over(by_part)
    system = (lead["role"] == "system") & (F.sum("rows").over(whole) > 1)
    parts = parts.select("part", "key", "first", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
                         F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"), F.sum("sum").over(whole).alias("all"),
                         system.alias("system"), F.when(system, lead["tokens"]).otherwise(0).alias("spent"))
    counted = rows.withColumn("before", F.coalesce(F.sum("tokens").over(inside), F.lit(0))).withColumnRenamed("at", "row").join(parts, ["part", "key"])
    counted = counted.select("n", "key", "system", "tokens", (F.col("row") - F.col("first") + F.col("rows_before")).alias("pos"),
                             (F.col("sum_before") + F.col("before") - F.col("spent")).alias("at"), (F.col("all") - F.col("spent")).alias("all"),
                             (F.col("spent") + 1).alias("cost"))
    counted = counted.withColumn("room", F.greatest(budget - history - F.col("cost"), F.lit(budget // 4).cast("long")))
    counted = counted.withColumn("cell", F.expr("at div room")).withColumn("last", F.expr("(all - 1) div room"))

    def to(cell: Column, kind: int) -> Column:
        return F.struct(cell.alias("cell"), F.lit(kind).alias("kind"))
    again = (F.col("cell") < F.col("last")) & ((F.col("cell") + 1) * F.col("room") - F.col("at") <= history)
    cells = (F.when(F.col("system") & (F.col("pos") == 0), F.transform(F.sequence(F.lit(0).cast("long"), F.col("last")), lambda c: to(c, 2)))
             .when(again, F.array(to(F.col("cell"), 1), to(F.col("cell") + 1, 0))).otherwise(F.array(to(F.col("cell"), 1))))
    placed = counted.select("n", "key", "pos", "at", "room", "cost", F.inline(cells))
    # A turn longer than a cell leaves cells in which none starts: nothing is repeated there.
    return written(placed, "chat-cells")


def _windows_of(cell: int, room: int, cost: int, rows: list[dict], budget: int, history: int) -> Iterator[tuple]:
    """The windows of one cell as WINDOW tells them; ``rows``: its turns, those to repeat and the system turn."""
    system = next((r for r in rows if r["kind"] == 2), None)
    turns = sorted((r for r in rows if r["kind"] != 2), key=lambda r: r["pos"])
    own = [r for r in turns if r["kind"] == 1]
    cut = len(own)
    if own and own[-1]["at"] + own[-1]["tokens"] > (cell + 1) * room and sum(r["tokens"] for r in own) > room:
        cut -= 1
    for new in (own[:cut], own[cut:]):
        if not new:
            continue
        spent = cost + sum(r["tokens"] for r in new)
        reach = min(history, budget - spent)
        repeated = [r for r in turns if r["pos"] < new[0]["pos"] and new[0]["at"] - r["at"] <= reach]
        text, loss, size = [START], [], len(START)
        for r in ([system] if system else []) + repeated + new:
            if r["role"] == "assistant" and r["pos"] >= new[0]["pos"]:
                loss.append({"start": size + r["head"], "stop": size + r["head"] + r["body"]})
            text.append(r["piece"])
            size += len(r["piece"])
        spent += sum(r["tokens"] for r in repeated)
        yield new[0]["pos"], len(new), len(repeated), system is not None, "".join(text), loss, spent, spent > budget


def windows(rows: DataFrame, counter: Callable[[], Counter], budget: int = 1024, history: int = 256, conv_col: str = "conv_id",
            turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Training texts of the conversations in ``rows`` (a row is a turn): ``conv_col`` and the columns of WINDOW.

    A conversation's turns stand in order of ``turn_col`` (nulls first), rows
    of one turn number by role, then by a hash of their texts. The template
    marks each turn; control strings inside texts and role names get one more
    backslash, which ``read_back`` takes away. Null texts and roles are empty;
    null conversation ids are one conversation. Other columns are not read.
    An empty table gives no windows.

    A window starts with the conversation's system turn, if its first turn is
    one and others follow; then come repeated turns, at most ``history``
    tokens, then the new ones. Each other turn is new in one window.
    Windows hold at most ``budget`` tokens (the sum of their turns' and one for
    the start), but for ``over_budget`` ones: a turn that is longer alone, or a
    system turn that leaves new ones less than a quarter of the budget. Turns
    are never cut. ``loss``: the spans (code points) of the assistant texts
    among the new turns, without marks; repeated ones have none.
    ``first_turn``: number of the first new turn, from 0.

    Scale: a turn's text is shuffled twice, to its number and to its cell. A
    cell holds few turns, as each has a token at least, however many its
    conversation has; the prefix sums go by ranges of rows.
    """
    if not 0 <= history <= budget // 4:
        raise ValueError("history is at most a quarter of the budget")
    turns = _turns(rows, counter, (conv_col, turn_col, role_col, text_col))
    met = _placed(turns, budget, history).join(turns.drop("key", "turn"), "n")
    cells = met.groupBy("key", "cell").agg(
        F.first("conv").alias("conv"), F.first("room").alias("room"), F.first("cost").alias("cost"),
        F.collect_list(F.struct("kind", "pos", "at", "tokens", "role", "head", "body", "piece")).alias("rows")).where("exists(rows, r -> r.kind = 1)")
    kind = cells.schema["conv"].dataType
    schema = f"conv {kind.simpleString()}, {WINDOW}"
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = None
        for batch in batches:
            types = types or [batch.schema.field("conv").type, pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string(),
                              pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])), pa.int64(), pa.bool_()]
            out = []
            for conv, cell, room, cost, group in zip(*(batch.column(c) for c in ("conv", "cell", "room", "cost", "rows"))):
                out += [(conv.as_py(), *w) for w in _windows_of(cell.as_py(), room.as_py(), cost.as_py(), group.as_py(), budget, history)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)
    return cells.select("conv", "cell", "room", "cost", "rows").mapInArrow(run, schema).withColumnRenamed("conv", conv_col)


def parsed(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a window's text."""
    out, at = [], len(START)
    if not text.startswith(START):
        raise ValueError("not a window")
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        if m["role"] is not None:
            out.append((unescaped(m["role"]), unescaped(m["other"])))
        else:
            out.append((m.lastgroup, unescaped(m[m.lastgroup])))
    return out


def read_back(found: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What the windows' texts and masks say: (conv_col, first_turn, turns, targets, n_chars), a row a window.

    ``turns``: (role, text) of the turns that are new in the window (with the
    system turn in the first one); ``targets``: the unescaped texts under the
    mask; ``n_chars``: code points of the window.
    """
    kind = found.schema[conv_col].dataType.simpleString()
    name = fresh(found, "conv")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            turns, targets, chars = [], [], []
            for first, new, repeated, system, text, loss in zip(*(batch.column(c).to_pylist() for c in (
                    "first_turn", "new_turns", "repeated_turns", "has_system", "text", "loss"))):
                all_turns = parsed(text)
                if len(all_turns) != new + repeated + system:
                    raise ValueError("a window's turns and its numbers do not agree")
                kept = all_turns[:1] if system and first == 1 else []
                turns.append([{"role": r, "text": t} for r, t in kept + all_turns[len(all_turns) - new:]])
                targets.append([unescaped(text[x["start"]:x["stop"]]) for x in loss])
                chars.append(len(text))
            yield pa.RecordBatch.from_arrays([batch.column(name), batch.column("first_turn"), pa.array(turns, pair), pa.array(targets, pa.list_(pa.string())),
                                              pa.array(chars, pa.int64())], [name, "first_turn", "turns", "targets", "n_chars"])
    schema = f"{name} {kind}, first_turn long, turns array<struct<role:string,text:string>>, targets array<string>, n_chars long"
    return found.withColumnRenamed(conv_col, name).mapInArrow(run, schema).withColumnRenamed(name, conv_col)


def digests(read: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """A row for each conversation: ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``.

    A digest of a whole conversation is a chain over its turns: its windows go
    through one task in order, one window at a time; nothing of a conversation
    is held but the two running hashes.
    """
    from hashlib import sha256
    kind = read.schema[conv_col].dataType.simpleString()
    keyed = read.select(F.col(conv_col).alias("conv"), F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("-")).alias("key"),
                        "first_turn", "turns", "targets", "n_chars")
    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = conv = None
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            done = []
            for name, at, turns, targets, chars in zip(*(batch.column(c) for c in ("conv", "key", "turns", "targets", "n_chars"))):
                if at.as_py() != key:
                    if key is not None:
                        done.append((conv, n, whole.hexdigest(), lost, loss.hexdigest(), size))
                    key, conv, n, lost, size, whole, loss = at.as_py(), name.as_py(), 0, 0, 0, sha256(), sha256()
                for t in turns:
                    whole.update(f"{t['role']}\n{t['text']}\n".encode())
                n += len(turns)
                for t in targets.as_py():
                    loss.update(t.encode())
                    lost += len(t)
                size += chars.as_py()
            conv_type = batch.schema.field("conv").type
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*done), [conv_type, *types])], names)
        if key is not None:
            last = (conv, n, whole.hexdigest(), lost, loss.hexdigest(), size)
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(last, [conv_type, *types])], names)
    names = [x.split()[0] for x in schema.split(", ")]
    return keyed.repartition("key").sortWithinPartitions("key", "first_turn").mapInArrow(run, schema).withColumnRenamed("conv", conv_col)
