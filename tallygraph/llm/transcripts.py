"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

A transcript is a run of segments in the order of their turn numbers; a segment is one or
more lines.  Six hidden states say who speaks and whether a line opens a turn or goes on
with it.  Lines show a speaker marker or none, whether they begin a segment, and how long
the segment is; Viterbi finds the most likely states, so a missing or misleading marker is
settled by its surroundings.  Lengths by role are fitted from labelled conversations.

A conversation of any length is cut into chunks of ``CHUNK`` turn numbers.  Each chunk
gives the best score from every state before it to every state at its end; those small
tables are chained per conversation, one row per chunk, and each chunk is then decoded
between the states found at its two ends.  The result is the Viterbi path of the whole.

Rendering is a piece per segment and turn, so no turn is ever gathered: a piece opens a turn
(closing the one before) or goes on; the last piece of a conversation closes its turn.
Pieces in the order of (turn, part) make up the canonical text.

A null or empty text is one empty line.  Rows without a turn number come first, in the order
of a hash of their text; equal turn numbers are ordered by text.  Rows without a conversation
id form one conversation.  Repeated rows are segments like any other, very long texts have as
many lines as they have, an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.llm.common import parts_for, utf8_size

CHUNK = 1024
GROUP_BYTES = 8 << 20

# Roles, and the names that markers give them.
ROLES = ("system", "user", "assistant")
NAMES = {"system": 0, "user": 1, "human": 1, "question": 1, "q": 1, "assistant": 2, "bot": 2, "ai": 2, "answer": 2, "a": 2}
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"

_NAME = "(" + "|".join(sorted(NAMES, key=len, reverse=True)) + ")"
_MARKER = re.compile(rf"\s{{0,3}}(?:#{{1,4}} *{_NAME}\b:?|\[{_NAME}\]:?|<\|?{_NAME}\|?>:?|\*\*{_NAME}\*\*:?|{_NAME} ?:)[ \t]*", re.I)

# states: role * 2 + (0 opens a turn, 1 goes on)
STATES = 2 * len(ROLES)


class Model(NamedTuple):
    """Log probabilities; lengths are normal in log(1 + characters of the segment)."""

    start: tuple[float, ...] = (0.3, 0.65, 0.05)
    follows: tuple[tuple[float, ...], ...] = ((0.02, 0.93, 0.05), (0.03, 0.07, 0.90), (0.02, 0.93, 0.05))
    stays: float = 0.7              # that a turn goes on with the next line
    marked: float = 0.8             # that the line that opens a turn shows its marker
    mistaken: float = 0.01          # that a line shows a marker that is not its own
    begins: float = 0.9               # that the line that opens a turn begins a segment
    again: float = 0.02             # that a line that goes on begins one
    mean: tuple[float, ...] = (5.0, 5.0, 6.5)
    spread: tuple[float, ...] = (1.0, 1.0, 1.0)


def fit(conversations: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> Model:
    """Lengths by role from conversations whose ``crc32(id) mod 4`` is not 2."""
    size = F.log1p(F.char_length(F.coalesce(conversations[text], F.lit(""))))
    rows = (conversations.filter(F.crc32(conversations[conv].cast("string").cast("binary")) % 4 != 2)
            .groupBy(conversations[role].alias("role")).agg(F.avg(size).alias("m"), F.stddev_pop(size).alias("s"))
            .filter(F.col("role").isin(*ROLES)).collect())       # three rows at most
    found = {r["role"]: (r["m"], max(r["s"], 0.3)) for r in rows}
    base = Model()
    return base._replace(mean=tuple(found.get(r, (base.mean[i], 0))[0] for i, r in enumerate(ROLES)),
                         spread=tuple(found.get(r, (0, base.spread[i]))[1] for i, r in enumerate(ROLES)))


def _transitions(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of the first state, and from state to state."""
    first = np.full(STATES, -np.inf)
    step = np.full((STATES, STATES), -np.inf)
    for r in range(len(ROLES)):
        first[2 * r] = math.log(model.start[r])
        for opened in (0, 1):
            step[2 * r + opened, 2 * r + 1] = math.log(model.stays)
            for to in range(len(ROLES)):
                step[2 * r + opened, 2 * to] = math.log((1 - model.stays) * model.follows[r][to])
    return first, step


def read_lines(texts: list[str | None]) -> tuple[list[str], list[int], list[int], list[int], list[int]]:
    """Lines of segments: text, segment, role its marker names or -1, characters of the marker, segment's length."""
    lines, segment, named, cut, size = [], [], [], [], []
    for i, text in enumerate(texts):
        for line in (text or "").split("\n"):
            found = _MARKER.match(line)
            lines.append(line)
            segment.append(i)
            named.append(NAMES[next(g for g in found.groups() if g).lower()] if found else -1)
            cut.append(found.end() if found else 0)
            size.append(len(text or ""))
    return lines, segment, named, cut, size


def emissions(model: Model, segment: list[int], named: list[int], size: list[int]) -> np.ndarray:
    """Log likelihood of each line in each state."""
    named, length = np.array(named), np.log1p(np.array(size, float))
    begins = np.diff(np.array(segment), prepend=-1) != 0
    out = np.zeros((len(named), STATES))
    for r in range(len(ROLES)):
        own = np.log(np.where(named == r, model.marked, np.where(named < 0, 1 - model.marked - 2 * model.mistaken, model.mistaken)))
        out[:, 2 * r] = own + np.log(np.where(begins, model.begins, 1 - model.begins))
        out[:, 2 * r + 1] = np.log(np.where(named < 0, 1 - 3 * model.mistaken, model.mistaken)) \
            + np.log(np.where(begins, model.again, 1 - model.again))
        fits = -0.5 * ((length - model.mean[r]) / model.spread[r]) ** 2 - math.log(model.spread[r])
        out[:, 2 * r] += np.where(begins, fits, 0.0)
        out[:, 2 * r + 1] += np.where(begins, fits, 0.0)
    return out


def ends(emitted: np.ndarray, step: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best score from each state before the lines, or none (last row), to each state of the last line (column)."""
    best = np.vstack([step, first]) + emitted[0]
    for e in emitted[1:]:
        best = (best[:, :, None] + step[None]).max(axis=1) + e
    return best


def path(emitted: np.ndarray, step: np.ndarray, enter: np.ndarray, last: int | None = None) -> np.ndarray:
    """Best states of the lines; ``enter`` scores the first one, ``last`` fixes the last one."""
    best, back = enter + emitted[0], np.zeros((len(emitted), STATES), np.int8)
    for i in range(1, len(emitted)):
        every = best[:, None] + step
        back[i] = every.argmax(axis=0)
        best = every.max(axis=0) + emitted[i]
    states = np.zeros(len(emitted), np.int8)
    states[-1] = best.argmax() if last is None else last
    for i in range(len(emitted) - 1, 0, -1):
        states[i - 1] = back[i, states[i]]
    return states


def _clean(text: str) -> str:
    """Content in which the canonical marks cannot be mistaken for marks."""
    return text.replace("<|im_", "< |im_")


def _chunks(rows: pa.Table):
    """(conversation, chunk, first row, end) of rows sorted by conversation, chunk and turn."""
    conv, chunk = rows.column("conv").to_pylist(), rows.column("chunk").to_pylist()
    begin = 0
    for i in range(1, len(conv) + 1):
        if i == len(conv) or (conv[i], chunk[i]) != (conv[begin], chunk[begin]):
            yield conv[begin], chunk[begin], begin, i
            begin = i


ORDER = [(c, "ascending") for c in ("conv", "chunk", "turn", "text")]
PIECES = "conv_id bigint, turn bigint, part int, role string, opens boolean, rendered string"


def rendered(segments: DataFrame, model: Model = Model(), conv: str = "conv_id", turn: str = "turn",
             text: str = "text") -> DataFrame:
    """``conv_id, turn, part, role, opens, rendered``: the canonical pieces of every segment."""
    first, step = _transitions(model)
    rows = segments.select(segments[conv].cast("bigint").alias("conv"), segments[turn].cast("bigint").alias("turn"),
                           segments[text].alias("text"))
    rows = rows.withColumn("chunk", _chunk(F.col("turn"), F.col("text")))
    groups = parts_for(rows.agg(F.sum(utf8_size(F.col("text")) + 32)).first()[0], GROUP_BYTES)
    dealt = (rows.withColumn("grp", F.pmod(F.xxhash64("conv", "chunk"), F.lit(groups)))
             .repartition(groups, "grp"))

    def tables(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by(ORDER)
        texts, out = rows.column("text").to_pylist(), []
        for name, chunk, a, b in _chunks(rows):
            _, segment, named, _, size = read_lines(texts[a:b])
            out.append((name, chunk, ends(emissions(model, segment, named, size), step, first).ravel().tolist()))
        return pa.table({"conv": pa.array([x for x, _, _ in out], pa.int64()), "chunk": pa.array([x for _, x, _ in out], pa.int64()),
                         "score": pa.array([x for _, _, x in out], pa.list_(pa.float64()))})

    def chain(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("conv", "ascending"), ("chunk", "ascending")])
        convs = rows.column("conv").to_pylist()
        out = {"enter": [], "leave": [], "final": []}
        scores = [np.array(x).reshape(STATES + 1, STATES) for x in rows.column("score").to_pylist()]
        begin = 0
        for i in range(1, len(convs) + 1):
            if i < len(convs) and convs[i] == convs[begin]:
                continue
            best, back = scores[begin][STATES], []
            for table in scores[begin + 1:i]:
                every = best[:, None] + table[:STATES]
                back.append(every.argmax(axis=0))
                best = every.max(axis=0)
            states = [int(best.argmax())]
            for b in reversed(back):
                states.append(int(b[states[-1]]))
            states.reverse()
            out["enter"] += [-1, *states[:-1]]
            out["leave"] += states
            out["final"] += [False] * (len(states) - 1) + [True]
            begin = i
        return pa.table({"conv": pa.array(convs, pa.int64()), "chunk": rows.column("chunk"),
                         "enter": pa.array(out["enter"], pa.int32()), "leave": pa.array(out["leave"], pa.int32()),
                         "final": pa.array(out["final"], pa.bool_())})

    def decode(rows: pa.Table, bounds: pa.Table) -> pa.Table:
        rows = rows.sort_by(ORDER)
        at = {(c, k): x for c, k, *x in zip(*(bounds.column(n).to_pylist() for n in ("conv", "chunk", "enter", "leave", "final")))}
        texts, turns = rows.column("text").to_pylist(), rows.column("turn").to_pylist()
        out = []
        for name, chunk, a, b in _chunks(rows):
            enter, leave, final = at[name, chunk]
            lines, segment, named, cut, size = read_lines(texts[a:b])
            states = path(emissions(model, segment, named, size), step, first if enter < 0 else step[enter], leave)
            out += _pieces(name, turns[a:b], lines, segment, named, cut, states, enter < 0, final)
        names = [c.split()[0] for c in PIECES.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.string())
        return pa.table([pa.array([x[i] for x in out], k) for i, k in enumerate(kinds)], names=names)

    scores = dealt.groupBy("grp").applyInArrow(tables, "conv bigint, chunk bigint, score array<double>")
    bounds = (scores.withColumn("own", F.pmod(F.xxhash64("conv"), F.lit(groups))).groupBy("own")
              .applyInArrow(chain, "conv bigint, chunk bigint, enter int, leave int, final boolean"))
    bounds = bounds.withColumn("grp", F.pmod(F.xxhash64("conv", "chunk"), F.lit(groups)))
    return dealt.groupBy("grp").cogroup(bounds.groupBy("grp")).applyInArrow(decode, PIECES)


def _pieces(conv: int | None, turns: list[int | None], lines: list[str], segment: list[int], named: list[int],
            cut: list[int], states: np.ndarray, opening: bool, closing: bool) -> list[tuple]:
    """Rendered pieces of a chunk's segments, one for each turn a segment has lines of."""
    out, begin = [], 0
    for i in range(1, len(lines) + 1):
        if i < len(lines) and segment[i] == segment[begin] and states[i] % 2:
            continue
        role, opens = int(states[begin]) // 2, states[begin] % 2 == 0
        own = opens and named[begin] == role
        content = _clean("\n".join([lines[begin][cut[begin] if own else 0:], *lines[begin + 1:i]]))
        if opens:
            before = "" if opening and begin == 0 else CLOSE + "\n"
            if own and not content.split("\n", 1)[0] and "\n" in content:
                content = content.split("\n", 1)[1]     # the marker had a line of its own
            content = f"{before}{OPEN}{ROLES[role]}\n{content}"
        content += "\n" + (CLOSE + "\n" if closing and i == len(lines) else "")
        part = out[-1][2] + 1 if begin and segment[begin] == segment[begin - 1] else 0
        out.append((conv, turns[segment[begin]], part, ROLES[role], opens, content))
        begin = i
    return out


def _chunk(turn: Column, text: Column) -> Column:
    """Chunks in order; rows without a turn number come first, spread over chunks by their text."""
    return F.coalesce(F.floor(turn / CHUNK), F.lit(-(1 << 62)) + F.pmod(F.xxhash64(text), F.lit(4096))).cast("bigint")
