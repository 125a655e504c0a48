"""Chat formatting by incremental black-box rendering.

A template is any function from turns to text. Successive prefixes of a conversation are
rendered and consecutive outputs compared: what a prefix adds is the span of its last turn, and an
output that does not begin with the one before it shows a template that rewrites history. Every prefix
of every conversation is rendered. A template that can go on from the prefix that it rendered last
(``Resumed``) makes that cheap without the operator's help. A template may also offer its step, which
renders one turn after another, for ``locate_by_steps``.
"""

import hashlib
import re
from collections.abc import Callable
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed control strings of common chat templates; none may occur inside a text.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = re.compile("|".join(re.escape(c[0]) + "(?=" + re.escape(c[1:]) + ")" for c in CONTROLS))
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<\|im_start\|>((?:[^\\\n]|\\.)*+)\n(.*?)<\|im_end\|>\n", re.S)
#: Two private-use characters stand for a text to find where the template puts it.
_PROBES = ("\ue000", "\ue001")


def escape(text):
    """Backslashes doubled, and one put behind the first character of every control string."""
    return _CONTROL.sub(lambda m: m.group() + "\\", text.replace("\\", "\\\\"))


def unescape(text):
    return _ESCAPED.sub(r"\1", text)


class Template(NamedTuple):
    """``render`` makes the text of a list of (role, text); ``step`` that of one turn more.

    ``step`` takes a state (None at first) and a turn, and returns its text and the next state.
    """

    render: Callable
    step: Callable | None = None


def _chatml_turn(state, turn):
    role, text = turn
    head = escape(role).replace("\n", "\\\n")
    return f"<|im_start|>{head}\n{escape(text)}<|im_end|>\n", state


class Resumed:
    """A template made of a step: turns are rendered behind ``opening``.

    It remembers the turns of its last call, and renders only those that differ from there on. What it
    returns depends on the turns alone.
    """

    def __init__(self, step, opening=""):
        self.step, self.opening = step, opening
        self._turns, self._states, self._ends, self._output = [], [None], [len(opening)], opening

    def __reduce__(self):
        return Resumed, (self.step, self.opening)

    def __call__(self, turns):
        # One turn after those of the last call, or another last turn: other calls begin anew.
        for n in (len(self._turns), len(self._turns) - 1):
            if 0 <= n <= len(turns) and turns[:n] == self._turns[:n]:
                break
        else:
            n = 0
        del self._turns[n:], self._states[n + 1:], self._ends[n + 1:]
        pieces = [self._output[:self._ends[n]]]
        for turn in turns[n:]:
            piece, state = self.step(self._states[-1], turn)
            pieces.append(piece)
            self._turns.append(turn)
            self._states.append(state)
            self._ends.append(self._ends[-1] + len(piece))
        self._output = "".join(pieces)
        return self._output


def chatml(turns):
    return "".join(_chatml_turn(None, turn)[0] for turn in turns)


def read_chatml(output):
    """The turns in a ``chatml`` output."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(output)]


def _inst_turn(state, turn):
    role, text = turn
    return (f"{escape(text)}</s>" if role == "assistant" else f"[INST] {escape(text)} [/INST]"), state


def inst(turns):
    """Instructions in brackets, answers closed by an end mark."""
    return "<s>" + "".join(_inst_turn(None, turn)[0] for turn in turns)


TEMPLATES = {
    "chatml": Template(Resumed(_chatml_turn), _chatml_turn), "inst": Template(Resumed(_inst_turn, "<s>"), _inst_turn)}


def _common(a, b):
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def locate(render, turns):
    """(output, spans, rewrites) of a conversation.

    spans: (start, end, text start, text end) per turn in the output of its prefix; the text's
    place is what changes between two renderings with different stand-ins for the text.
    rewrites: numbers (from 0) of turns whose rendering changed what stood before.
    """
    output, spans, rewrites = render([]), [], []
    for i in range(len(turns)):
        before = turns[:i]
        now = render(turns[:i + 1])
        start = len(output)
        if not now.startswith(output):
            rewrites.append(i)
            start = _common(output, now)
        one, two = (render([*before, (turns[i][0], p)]) for p in _PROBES)
        # What both share with the prefix before needs no search.
        known = len(output) if one.startswith(output) and two.startswith(output) else 0
        head = known + _common(one[known:], two[known:])
        tail = _common(one[head:][::-1], two[head:][::-1])
        spans.append((start, len(now), head, max(head, len(now) - tail)))
        output = now
    return output, spans, rewrites


def locate_by_steps(template, turns):
    """The same as ``locate`` in time linear in the turns, or None if the steps are not to be trusted.

    The joined steps must equal the black box's output for the whole conversation, and for its first
    half, quarter and so on.
    """
    pieces, ends, spans, state = [template.render([])], [], [], None
    at = len(pieces[0])
    for role, text in turns:
        one, two = (template.step(state, (role, p))[0] for p in _PROBES)
        piece, state = template.step(state, (role, text))
        head = _common(one, two)
        tail = _common(one[head:][::-1], two[head:][::-1])
        pieces.append(piece)
        spans.append((at, at + len(piece), at + head, at + max(head, len(piece) - tail)))
        at += len(piece)
        ends.append(at)
    output, n = "".join(pieces), len(turns)
    while n:
        if template.render(turns[:n]) != output[:ends[n - 1]]:
            return None
        n //= 2
    return output, spans, []


SPANS = T.ArrayType(T.StructType(
    [T.StructField("role", T.StringType())]
    + [T.StructField(n, T.LongType()) for n in ("start", "end", "text_start", "text_end")]
    + [T.StructField("loss", T.BooleanType())]))
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("formatted", T.StringType()),
    T.StructField("spans", SPANS), T.StructField("rewrites", T.ArrayType(T.IntegerType()))])


def format_conversations(conversations, template="chatml"):
    """conv_id, formatted, spans and rewrites: one row per conversation.

    ``template`` is a name in ``TEMPLATES``, a ``Template``, or a function from (role, text) pairs to text. Rows are
    ordered by turn, then role and text (NULL first), so ties and repeated rows have one order.
    NULL role and text are empty; rows without conv_id form one conversation; other columns play
    no part. The span of an assistant's text has loss set. Every prefix is rendered by the template and
    compared with the one before; a step that the template offers plays no part here. Characters compared
    grow with the square of a conversation's length; rows of one conversation meet in one row.
    """
    template = TEMPLATES[template] if isinstance(template, str) else template
    if not isinstance(template, Template):
        template = Template(template)
    rows = conversations.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    types = pa.list_(pa.struct(
        [("role", pa.string())] + [(n, pa.int64()) for n in ("start", "end", "text_start", "text_end")]
        + [("loss", pa.bool_())]))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                outputs, spans, rewrites = [], [], []
                for turns in part.column("turns").to_pylist():
                    turns = [(t["role"], t["text"]) for t in turns]
                    output, places, changed = locate(template.render, turns)
                    outputs.append(output)
                    spans.append([(r, *p, r == "assistant") for (r, _), p in zip(turns, places)])
                    rewrites.append(changed)
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array(outputs, pa.string()), pa.array(spans, types),
                     pa.array(rewrites, pa.list_(pa.int32()))],
                    names=["conv_id", "formatted", "spans", "rewrites"])

    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turns").mapInArrow(run, FORMATTED)


def read_back(formatted):
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars from chatml outputs."""
    def run(batches):
        for batch in batches:
            rows = []
            for row in batch.select(["formatted", "spans"]).to_pylist():
                output, turns, loss = row["formatted"], hashlib.sha256(), hashlib.sha256()
                found = read_chatml(output)
                for role, text in found:
                    turns.update(f"{role}\n{text}\n".encode())
                chars = 0
                for s in row["spans"]:
                    if s["loss"]:
                        text = unescape(output[s["text_start"]:s["text_end"]])
                        chars += len(text)
                        loss.update(text.encode())
                rows.append((len(found), turns.hexdigest(), chars, loss.hexdigest(), len(output)))
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")
