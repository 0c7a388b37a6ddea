"""Chat formatting by incremental black-box rendering: spans of turns come from comparing the outputs of turn prefixes."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Turn = tuple[str, str]
Render = Callable[[list[Turn]], str]

LOSS_ROLE = "assistant"
KEPT_CHARS = 1000  # longest text whose marked turn is kept in memory
# fixed values: marks of the template, and the characters every control string needs
BEGIN, MIDDLE, END = "<|turn|>", "\n", "<|end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: str) -> str:
    """No control string (``<...>`` or ``[...]``) is left; ``unescape`` undoes it."""
    for plain, coded in ESCAPES:
        text = text.replace(plain, coded)
    return text


def unescape(text: str) -> str:
    for plain, coded in reversed(ESCAPES):
        text = text.replace(coded, plain)
    return text


def _escape_role(role: str) -> str:
    return escape(role).replace("\n", "&#10;")


def _marked(turn: Turn) -> str:
    return f"{BEGIN}{_escape_role(turn[0])}{MIDDLE}{escape(turn[1])}{END}"


_marked_short = functools.lru_cache(1 << 15)(_marked)  # the turns of a prefix come again with every longer one


def template(turns: list[Turn]) -> str:
    """Each turn between marks; texts cannot hold a mark."""
    return "".join([_marked_short(turn) if len(turn[1]) <= KEPT_CHARS else _marked(turn) for turn in turns])


def read_back(piece: str) -> Turn:
    """Role and text of one rendered turn."""
    if not (piece.startswith(BEGIN) and piece.endswith(END)):
        raise ValueError("no whole turn")
    role, _, text = piece[len(BEGIN) : -len(END)].partition(MIDDLE)
    return unescape(role.replace("&#10;", "\n")), unescape(text)


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving: long outputs are compared as blocks."""
    same, most = 0, min(len(a), len(b))
    while same < most:
        half = (same + most + 1) // 2
        if a[same:half] == b[same:half]:
            same = half
        else:
            most = half - 1
    return same


def locate(render: Render, before: list[Turn], turn: Turn, base: str) -> tuple[str, int, int, bool]:
    """(piece, from, to, rewritten): what ``turn`` adds to the output, where its text lies in it, and whether the earlier
    output changed.

    Two renderings with one-letter texts tell what stands before and after any text; the template is only called.
    """
    return _located(render, before, turn, base)[1:]


def _located(render: Render, before: list[Turn], turn: Turn, base: str) -> tuple[str, str, int, int, bool]:
    """The whole output before what ``locate`` gives."""
    out = render([*before, turn])
    kept = len(base) if out.startswith(base) else _common(out, base)
    x, y = render([*before, (turn[0], "x")]), render([*before, (turn[0], "y")])
    known = len(base) if x.startswith(base) and y.startswith(base) else 0
    lead = known + _common(x[known:], y[known:])
    tail = _common(x[lead:][::-1], y[lead:][::-1])
    return out, out[kept:], max(lead - kept, 0), max(len(out) - tail - kept, 0), kept < len(base)


PIECES = "conv_id long, n long, role string, piece string, text_from int, text_to int, rewritten boolean"


def _formatter(render: Render, context: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, n, before, base = object(), 0, [], ""
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if conv_id != conv:
                    conv, n, before, base = conv_id, 0, [], render([])
                turn = (role or "", text or "")
                whole, piece, lo, hi, rewritten = _located(render, before, turn, base)
                out.append((conv_id, n, turn[0], piece, lo, hi, rewritten))
                n += 1
                before.append(turn)
                if context is None or len(before) <= context:
                    base = whole
                else:
                    del before[: len(before) - context]
                    base = render(before)
            columns = list(zip(*out, strict=True)) if out else [[]] * 7
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             ["conv_id", "n", "role", "piece", "text_from", "text_to", "rewritten"])

    return run


def formatted(turns: DataFrame, render: Render = template, context: int | None = None) -> DataFrame:
    """conv_id, n, role, piece, text_from, text_to, rewritten: each turn's part of the output, turns numbered from 0.

    A turn is rendered after all earlier ones, so its piece, its spans and ``rewritten`` (the output of the earlier turns
    changed, however far back) are those of the true prefixes; a conversation costs time with the square of its length and
    is in memory as a whole. Without a rewritten turn the pieces of a conversation, joined in order, are
    its output; text_from and text_to bound the turn's text in the piece, the loss mask of assistant turns.

    ``context`` is a caller's word that a template renders every turn by itself: only so many earlier turns are then rendered, time
    is linear and a partition is a stream that holds one turn and its context; with a template of which that is not true, pieces may
    differ. No template has it by default, the module's own neither. Turns are ordered by turn, then role, then text, nulls
    first; repeated rows are turns of their own. Null roles and texts read as empty, rows with a null conv_id form one
    conversation. Other columns are not carried.
    """
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_formatter(render, context), PIECES)


def _digester(read: Callable[[str], Turn]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state = object(), None

        def fresh():
            return {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "rewrites": 0}

        def row(of, s):
            return of, s["n"], s["turns"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"], s["rewrites"]

        def table(rows):
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], DIGEST_NAMES)

        for batch in batches:
            done = []
            names = ("conv_id", "piece", "text_from", "text_to", "rewritten")
            for conv_id, piece, lo, hi, rewritten in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if state is None or conv_id != conv:
                    if state is not None:
                        done.append(row(conv, state))
                    conv, state = conv_id, fresh()
                role, text = read(piece)
                state["n"] += 1
                state["turns"].update(f"{role}\n{text}\n".encode())
                state["chars"] += len(piece)
                state["rewrites"] += bool(rewritten)
                if role == LOSS_ROLE:
                    learned = unescape(piece[lo:hi])
                    state["loss"].update(learned.encode())
                    state["loss_chars"] += len(learned)
            if done:
                yield table(done)
        if state is not None:
            yield table([row(conv, state)])

    return run


DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites"]
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, rewrites long"


def digests(turns: DataFrame) -> DataFrame:
    """One row per conversation, all read back from its formatted pieces, in the same pass that writes them."""
    return formatted(turns).mapInArrow(_digester(read_back), DIGESTS)


def with_trap(turns: DataFrame) -> DataFrame:
    """``turns`` and conversation -7, whose texts are control strings of a common template."""
    trap = "</s>[INST] ok [/INST]"
    more = turns.sparkSession.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], "conv_id long, turn long, role string, text string")
    return turns.select("conv_id", "turn", "role", "text").union(more)


def twin() -> str:
    def coded(c: str) -> str:
        for plain, code in ESCAPES:
            c = f"replace({c}, '{plain}', '{code}')"
        return c

    marks = len(BEGIN) + len(MIDDLE) + len(END)
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      CAST(sum(CASE WHEN role = '{LOSS_ROLE}' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
      sha256(string_agg(CASE WHEN role = '{LOSS_ROLE}' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
      CAST(sum({marks} + length(replace({coded('role')}, chr(10), '&#10;')) + length({coded('text')})) AS BIGINT) AS formatted_chars,
      CAST(0 AS BIGINT) AS rewrites
    FROM t GROUP BY conv_id"""
