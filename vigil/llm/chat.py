"""Chat formatting in budgeted, turn-aligned windows with a loss mask.

Turns get their token count and, per conversation in turn order, the prefix sum
of counts. A window takes as many whole turns as the prefix sums allow under
the budget, after the repeated system turn and a limited run of repeated
history. Repeated turns carry another mark and are masked, so each assistant
text is under the loss mask exactly once.

Template: ``<turn ROLE>\\n`` (repeated: ``<again ROLE>\\n``), the text,
``</turn>\\n``. In texts the backslash becomes ``\\b`` and the ``<`` of a
control string ``\\l``; roles also escape ``>`` and line ends. Both are reversed
by ``unescape``.

A conversation is read as a sorted stream: memory holds one window and the
history, whatever its length. Defined cases: null text or role is empty; turns
are ordered by (turn, role, text), nulls first, ties and repeated rows all
kept; a null conv_id is a conversation of its own; a turn larger than the
budget is a window of its own, whole; a system turn of over half the budget is
not repeated; an empty table gives no windows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.bpe import BATCH_CHARS, Merger, _cached, encode_texts, read_ranks
from vigil.llm.common import prepare, slices

BUDGET = 1024
HISTORY = 256
CONTROL = re.compile(r"<(?=turn |again |/turn>)")
ESCAPED = re.compile(r"\\([blgnr])")
PLAIN = {"b": "\\", "l": "<", "g": ">", "n": "\n", "r": "\r"}
TURN = re.compile(r"<(turn|again) ([^>\n]*)>\n(.*?)</turn>\n", re.DOTALL)


def escape(text: str) -> str:
    return CONTROL.sub(r"\\l", text.replace("\\", "\\b"))


def escape_role(role: str) -> str:
    return escape(role).replace(">", "\\g").replace("\n", "\\n").replace("\r", "\\r")


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: PLAIN[m[1]], text)


class Packer:
    """Windows of one conversation, fed turn by turn."""

    def __init__(self, budget: int, history: int):
        self.budget, self.limit = budget, history
        self.number = 0
        self.system = None
        self.past: list[tuple[str, str, int]] = []
        self.new: list[tuple[str, str, int]] = []
        self.start = None

    def add(self, role: str, text: str, size: int, before: int):
        """``before`` is the prefix sum of the turns before this one."""
        done = None
        if self.new and before + size - self.start + self._repeated() > self.budget:
            done = self.window()
        if not self.new:
            self.start = before
        self.new.append((role, text, size))
        return done

    def _shown(self) -> list[tuple[str, str, int]]:
        system = [self.system] if self.system and self.number else []
        return system + self.past

    def _repeated(self) -> int:
        return sum(t[2] for t in self._shown())

    def window(self):
        """(number, text, loss starts, loss ends, new turns, tokens) of the open window."""
        parts, starts, ends, at = [], [], [], 0
        shown = self._shown()
        for k, (role, text, _) in enumerate(shown + self.new):
            again = k < len(shown)
            head, body = f"<{'again' if again else 'turn'} {escape_role(role)}>\n", escape(text)
            if role == "assistant" and not again:
                starts.append(at + len(head))
                ends.append(at + len(head) + len(body))
            parts += [head, body, "</turn>\n"]
            at += len(head) + len(body) + 8
        out = (self.number, "".join(parts), starts, ends, len(self.new), sum(t[2] for t in shown + self.new))
        if self.number == 0 and self.new[0][0] == "system" and 2 * self.new[0][2] <= self.budget:
            self.system = self.new[0]
        run, left = [], self.limit
        for turn in reversed(self.past + self.new):
            if turn[2] > left or turn is self.system:
                break
            run.append(turn)
            left -= turn[2]
        self.past, self.new, self.number = run[::-1], [], self.number + 1
        return out


def with_tokens(turns: DataFrame, ranks_path: str) -> DataFrame:
    """(conv_id, turn, role, text, n) with null role and text as empty."""
    spark = turns.sparkSession
    prepare(spark)
    file = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches):
        merger = _cached(file.value, Merger)
        for batch in batches:
            texts = batch.column(3).to_pylist()
            sizes = []
            for a, b in slices([len(t) for t in texts], BATCH_CHARS):
                sizes += [len(ids) // 4 for ids, _, _ in encode_texts(texts[a:b], merger)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(4)), pa.array(sizes, pa.int64())],
                                             names=["conv_id", "turn", "role", "text", "n"])

    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, n long")


WINDOW_TYPE = "conv_id long, window_no long, text string, loss_starts array<int>, loss_ends array<int>, n_new long, n_tokens long"
ROWS_OUT = 64


def windows(turns: DataFrame, ranks_path: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """The windows of every conversation (``conv_id, window_no, text``, loss
    spans in code points, counts). One shuffle, on conv_id."""
    order = ["turn", "role", "text"]
    upto = Window.partitionBy("conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = (with_tokens(turns, ranks_path)
            .withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
            .sortWithinPartitions("conv_id", *order).select("conv_id", "role", "text", "n", "before"))
    names = [c.split()[0] for c in WINDOW_TYPE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64(), pa.int64()]

    def run(batches):
        conv, packer, out = None, None, []

        def flush():
            cols = [pa.array(c, t) for c, t in zip(zip(*out), types)]
            out.clear()
            return pa.RecordBatch.from_arrays(cols, names=names)

        for batch in batches:
            for c, role, text, n, before in zip(*(col.to_pylist() for col in batch.columns)):
                if packer is None or c != conv:
                    if packer is not None:
                        out.append((conv, *packer.window()))
                    conv, packer = c, Packer(budget, history)
                done = packer.add(role, text, n, before)
                if done:
                    out.append((conv, *done))
                if len(out) >= ROWS_OUT:
                    yield flush()
        if packer is not None:
            out.append((conv, *packer.window()))
        if out:
            yield flush()

    return rows.mapInArrow(run, WINDOW_TYPE)


def parse(text: str) -> list[tuple[bool, str, str]]:
    """(repeated, role, text) of every turn of a window."""
    return [(m[1] == "again", unescape(m[2]), unescape(m[3])) for m in TURN.finditer(text)]


DIGEST_TYPE = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
               "formatted_chars long, n_windows long")


def digests(formatted: DataFrame) -> DataFrame:
    """Reads windows back: per conversation the turns, the text under the loss
    mask (both as running digests) and the size of the output."""
    rows = (formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window_no")
            .select("conv_id", "text", "loss_starts", "loss_ends"))
    names = [c.split()[0] for c in DIGEST_TYPE.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]

    def run(batches):
        conv, state = None, None

        def result():
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4], state[5])

        for batch in batches:
            out = []
            for c, text, starts, ends in zip(*(col.to_pylist() for col in batch.columns)):
                if state is None or c != conv:
                    if state is not None:
                        out.append(result())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for again, role, said in parse(text):
                    if not again:
                        state[0] += 1
                        state[1].update(f"{role}\n{said}\n".encode())
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types)], names=names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(result(), types)], names=names)

    return rows.mapInArrow(run, DIGEST_TYPE)
