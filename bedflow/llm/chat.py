r"""Chat formatting with a grammar round trip.

A turn is rendered as one line ``### role:`` (``### role!:`` if its text is
escaped), the text, and ``</turn>`` with a newline::

    turn   = "### " role [ "!" | "!!" ] ":" "\n" text "</turn>\n"

The parser is deterministic: it reads the header up to the first newline and
the text up to the next ``</turn>``.  A turn is rendered plainly, parsed
again and compared with its source; while they differ, the text is escaped
harder: first only the end mark ("!"), then every backslash, "<" and "#"
("!!"), which always comes back identical.  Roles escape what a header cannot
hold.

Rows of a conversation stream through a task in order; nothing but the
current turn and running digests is kept, so one conversation may hold any
number of turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, END = "### ", "</turn>\n"
LOSS_ROLE = "assistant"
_HARD = (("\\", "\\\\"), ("<", "\\l"), ("#", "\\h"))
_ROLE = (("\\", "\\\\"), ("\n", "\\n"), (":", "\\c"), ("!", "\\e"))


def _escape(text: str, table) -> str:
    for plain, code in table:
        text = text.replace(plain, code)
    return text


def _unescape(text: str, table) -> str:
    back = {code[1]: plain for plain, code in table}
    out, at = [], 0
    while (i := text.find("\\", at)) >= 0:
        out += (text[at:i], back[text[i + 1]])
        at = i + 2
    return "".join(out) + text[at:]


def _soft(text: str) -> str:
    """Escapes the end mark only: a backslash goes into it, and into marks that hold one already."""
    return text.replace("</\\", "</\\\\").replace("</turn>", "</\\turn>")


def _unsoft(text: str) -> str:
    return text.replace("</\\turn>", "</turn>").replace("</\\\\", "</\\")


LEVELS = (("", lambda t: t, lambda t: t), ("!", _soft, _unsoft),
          ("!!", lambda t: _escape(t, _HARD), lambda t: _unescape(t, _HARD)))


def parse_turn(text: str, at: int = 0) -> tuple[str, str, int, int, int]:
    """(role, text, start and end of the raw text, where the next turn begins)."""
    if not text.startswith(HEAD, at):
        raise ValueError(f"no turn at {at}")
    newline = text.index("\n", at)
    head = text[at + len(HEAD):newline - 1]
    role = head.rstrip("!")
    unescape = LEVELS[len(head) - len(role)][2]
    end = text.index(END, newline + 1)
    return _unescape(role, _ROLE), unescape(text[newline + 1:end]), newline + 1, end, end + len(END)


def render_turn(role: str, text: str) -> str:
    """The turn, escaped no harder than its round trip needs."""
    for mark, escape, _ in LEVELS:
        made = f"{HEAD}{_escape(role, _ROLE)}{mark}:\n{escape(text)}{END}"
        try:
            got = parse_turn(made)
        except (ValueError, KeyError, IndexError):
            continue
        if got[:2] == (role, text) and got[4] == len(made):
            return made
    raise AssertionError("the hardest escaping always comes back identical")


def ordered(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with each conversation in one partition, by
    turn; equal turns by role, then text; nulls first."""
    key = F.col("conv_id").cast("long")
    rows = conversations.select(key.alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_chats(conversations: DataFrame, loss_role: str = LOSS_ROLE) -> DataFrame:
    """The formatted conversations, one row a turn in order: conv_id, position,
    rendered, and the loss span [loss_start, loss_end) in characters of the
    conversation's whole formatted text (null where the turn has no loss).  A
    conversation's text is its rendered turns one after another.

    Null roles and texts count as empty, a null conv_id is a conversation of
    its own, repeated rows are repeated turns, other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, at, chars = object(), 0, 0
        for b in batches:
            cols: list[list] = [[], [], [], []]
            for c, role, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if c != conv:
                    conv, at, chars = c, 0, 0
                made = render_turn(role, text)
                _, _, start, end, _ = parse_turn(made)
                loss = role == loss_role
                for col, x in zip(cols, (at, made, chars + start if loss else None, chars + end if loss else None)):
                    col.append(x)
                at, chars = at + 1, chars + len(made)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.record_batch([b.column(0), *[pa.array(x, k) for x, k in zip(cols, kinds)]],
                                  names=["conv_id", "position", "rendered", "loss_start", "loss_end"])
    return ordered(conversations).mapInArrow(
        run, "conv_id long, position long, rendered string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """One row a conversation, all read from the formatted text: conv_id,
    n_turns, turns_sha256 (role, newline, text, newline of every turn),
    loss_chars, loss_sha256 (text under the loss mask, unescaped),
    formatted_chars.  ``formatted`` comes in the order of ``format_chats``."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = None, None
        done: list[tuple] = []

        def close():
            n, turns, loss_n, loss, chars = state
            done.append((conv, n, turns.hexdigest(), loss_n, loss.hexdigest(), chars))

        def flush():
            cols = list(zip(*done)) or [()] * 6
            return pa.record_batch([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=names)

        for b in batches:
            for c, made, s, e in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if state is None or c != conv:
                    if state is not None:
                        close()
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, start, end, _ = parse_turn(made)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if s is not None:
                    # the mask's span, cut out of the text and unescaped like the turn it lies in
                    head = made[len(HEAD):start - 2]
                    plain = LEVELS[len(head) - len(head.rstrip("!"))][2](made[s - state[4]:e - state[4]])
                    state[2] += len(plain)
                    state[3].update(plain.encode())
                state[4] += len(made)
            yield flush()
            done.clear()
        if state is not None:
            close()
        yield flush()
    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def planted(conversations: DataFrame) -> DataFrame:
    """``conversations`` plus conversation -7, whose turns spell control strings."""
    text = "\\### Assistant: </turn> ok"
    rows = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    cols: list[Column] = [F.col(c).cast(t) for c, t in rows.dtypes]
    return conversations.select(*[c.alias(n) for c, n in zip(cols, rows.columns)]).unionByName(rows)
