"""Chat formatting: roles of transcript lines by a hidden Markov model.

A state is a role together with whether the line begins a turn. A line shows a speaker
marker (of which kind, or none) and features: its length, a question mark at its end, an
empty line. Start, transition and emission probabilities are counted on a bounded
sample of labelled turns. Viterbi finds the best path of roles, markers are taken
off, and turns are rendered in one canonical form.

Long conversations are decoded in parts, exactly: a part first becomes a matrix of best
scores between the state before it and the state at its end. Products in max-plus
algebra are associative, so neighbouring matrices are multiplied by groups of ``fan`` parts,
in rounds, until no conversation has more than ``fan`` left; on the way back each round
gives the states at the borders of the round before. Then every part is decoded between
its borders. So no task holds a conversation, or a row for each of its parts; a task holds
one part, whose size is the caller's to bound. For the matrices only the numbers of what
a line shows are shuffled; texts are, once, for the decoding.

Cases: a null line is empty; a null conversation is one of its own; lines of equal order
go by what they show, then by their text, repeated ones stay; ties between paths go to the first role in
alphabetical order; an empty table gives no rows; roles never seen in training are not
predicted; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stage import Tables, below_hash

# Words that mark a speaker, by the kind of marker they are.
SPEAKERS = {
    "asks": ("user", "human", "question", "q", "prompter", "me", "customer", "instruction", "input"),
    "answers": ("assistant", "ai", "bot", "answer", "a", "gpt", "model", "agent", "response", "output"),
    "sets": ("system", "context", "sys", "setup"),
}
_KIND = {word: kind for kind, names in SPEAKERS.items() for word in names}
_MARKER = re.compile(
    r"^\s*(?:<\|(?:im_start\|>)?\s*(\w+)(?:\|>)?|\[(\w+)\]|#{1,4}\s*(\w+)\s*:?|\**(\w{1,14})\**\s*:\**)"
    r"(?:\s+|$)",
)
KINDS = ("none", "other", *SPEAKERS)
_LENGTHS = (1, 40, 120, 300)  # characters
END, TURN = "<|end|>\n", "<|{role}|>\n{text}\n"


def split_marker(line: str) -> tuple[str, str]:
    """The kind of marker that a line begins with, and the rest of the line."""
    found = _MARKER.match(line)
    if not found:
        return "none", line
    word = next(g for g in found.groups() if g).lower()
    kind = _KIND.get(word)
    return (kind, line[found.end() :]) if kind else ("other", line)


def observe(line: str | None) -> tuple[int, int, int]:
    """Numbers of a line's marker, length and ending."""
    kind, rest = split_marker(line or "")
    rest = rest.strip()
    return KINDS.index(kind), bisect_right(_LENGTHS, len(rest)), int(rest.endswith("?"))


_SIZES = (len(KINDS), len(_LENGTHS) + 1, 2)


def shown(lines: Sequence[str | None]) -> np.ndarray:
    """What each line shows, as one number."""
    seen = np.array([observe(line) for line in lines], np.int64).reshape(-1, len(_SIZES))
    return np.ravel_multi_index(tuple(seen.T), _SIZES)


@dataclass(frozen=True)
class Hmm:
    roles: tuple[str, ...]
    start: np.ndarray
    move: np.ndarray
    show: tuple[np.ndarray, ...]  # per feature: states x values

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        """Per line, by the numbers of ``shown``, the score of each state."""
        values = np.unravel_index(np.asarray(seen, np.int64), _SIZES)
        return sum(show[:, v].T for show, v in zip(self.show, values, strict=True))

    def span(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best scores from each state before the lines to each state at their end, and
        those of each state at their end if a conversation begins with them."""
        best, head = self.move + scores[0], self.start + scores[0]
        for score in scores[1:]:
            step = self.move + score
            best, head = times(best, step), after(head, step)
        return best, head

    def decode(self, scores: np.ndarray, before: int | None, at_end: int | None) -> list[int]:
        """The best path between two known states (None: the start, or any end)."""
        first = (self.start if before is None else self.move[before]) + scores[0]
        return best_path([self.move + score for score in scores[1:]], first, at_end)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The max-plus product of two matrices."""
    return (a[:, :, None] + b[None]).max(axis=1)


def after(value: np.ndarray, step: np.ndarray) -> np.ndarray:
    return (value[:, None] + step).max(axis=0)


def best_path(steps: Sequence[np.ndarray], first: np.ndarray, at_end: int | None = None) -> list[int]:
    """The best states from ``first``, which scores the first of them, over all ``steps``."""
    value, back = first, []
    for step in steps:
        ways = value[:, None] + step
        back.append(ways.argmax(axis=0))
        value = ways.max(axis=0)
    path = [int(value.argmax()) if at_end is None else at_end]
    for from_ in reversed(back):
        path.append(int(from_[path[-1]]))
    return path[::-1]


def train(
    lines: DataFrame, *, conv: str = "conv_id", order: str = "line_no", line: str = "line",
    role: str = "role", first: str = "first", max_lines: int = 50_000, smoothing: float = 0.5,
) -> Hmm:
    """Count on at most ``max_lines`` lines, conversations in the order of a hash of their keys.

    ``first`` tells whether a line begins a turn. Lines are counted first, and only conversations
    below a hash that some more than ``max_lines`` are expected to lie under are sorted.
    """
    labelled = lines.where(F.col(role).isNotNull() & F.col(conv).isNotNull())
    drawn = below_hash(F.xxhash64(F.col(conv), F.lit(5)), max_lines, labelled.count())
    sample = (
        labelled.where(drawn)
        .select(F.col(conv).alias("conv"), F.col(order).alias("at"), F.col(line).alias("line"),
                F.col(role).alias("role"), F.col(first).alias("first"))
        .orderBy(F.xxhash64("conv", F.lit(5)), "conv", "at", "line")
        .limit(max_lines)
        .toPandas()
    )
    roles = tuple(sorted(sample["role"].unique()))
    n = 2 * len(roles)  # state 2 r begins a turn of role r, 2 r + 1 goes on
    start, move = np.full(n, 0.01), np.full((n, n), 0.01)
    show = [np.full((n, size), smoothing) for size in _SIZES]
    before, conv_before = None, object()
    number = {r: i for i, r in enumerate(roles)}
    for c, text, r, begins in zip(
        sample["conv"], sample["line"], sample["role"], sample["first"], strict=True
    ):
        state = 2 * number[r] + (not begins)
        if c != conv_before:
            start[state] += 1
        else:
            move[before, state] += 1
        for values, seen in zip(show, observe(text), strict=True):
            values[state, seen] += 1
        before, conv_before = state, c
    with np.errstate(divide="ignore"):
        goes_on = np.arange(n) % 2 == 1
        start[goes_on] = 0
        # a turn goes on in its own role only
        move[:, goes_on] *= np.arange(n)[:, None] // 2 == np.arange(n)[None, goes_on] // 2
        return Hmm(
            roles,
            np.log(start / max(start.sum(), 1e-300)),
            np.log(move / np.maximum(move.sum(axis=1, keepdims=True), 1e-300)),
            tuple(np.log(v / v.sum(axis=1, keepdims=True)) for v in show),
        )


def _shown(line: Column) -> Column:
    @F.pandas_udf("int")
    def each(lines: pd.Series) -> pd.Series:
        return pd.Series(shown(lines), dtype="int32")

    return each(line)


def render(
    lines: DataFrame, model: Hmm, *, part: Column, conv: str = "conv_id", order: str = "line_no",
    line: str = "line", fan: int = 256,
) -> DataFrame:
    """Per conversation and part ``conv, part, n_turns, roles, chat``.

    ``part`` numbers the parts of a conversation in the order of its lines. The ``chat`` of
    its parts, one after the other, is the canonical rendering; ``roles`` are those of
    the turns that begin in the part. ``fan`` is the number of parts that a task multiplies.
    """
    spark = lines.sparkSession
    kind = lines.schema[conv].dataType.simpleString()
    own = lines.select(
        F.col(conv).alias("conv"), part.cast("long").alias("part"), F.col(order).alias("at"),
        F.coalesce(F.col(line), F.lit("")).alias("line"),
    ).withColumn("seen", _shown(F.col("line")))
    if not model.roles:
        return spark.createDataFrame([], f"`{conv}` {kind}, part long, n_turns long, roles string, chat string")
    sent = spark.sparkContext.broadcast(model)
    by = ["conv", "part"]

    n = 2 * len(model.roles)

    def one_row(group: pd.DataFrame, number: str, total: np.ndarray, head: np.ndarray) -> pd.DataFrame:
        out = group[["conv", number]].head(1).set_axis(by, axis=1)
        return out.assign(span=[total.ravel().tolist()], head=[head.tolist()])

    def matrices(group: pd.DataFrame) -> list[np.ndarray]:
        return [np.array(s).reshape(n, n) for s in group["span"]]

    def span(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["at", "seen"], kind="stable")
        hmm: Hmm = sent.value
        return one_row(group, "part", *hmm.span(hmm.emissions(group["seen"].to_numpy())))

    def multiply(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")
        total, *rest = matrices(group)
        head = np.array(group["head"].iat[0])
        for step in rest:
            total, head = times(total, step), after(head, step)
        return one_row(group, "up", total, head)

    def bordered(group: pd.DataFrame, before: int, at_end: int | None, last: bool) -> pd.DataFrame:
        group = group.sort_values("part")
        first, *rest = matrices(group)
        ends = best_path(rest, np.array(group["head"].iat[0]) if before < 0 else first[before], at_end)
        return group[by].assign(
            before=[before, *ends[:-1]], at_end=ends, last=[False] * (len(ends) - 1) + [last]
        )

    def border(group: pd.DataFrame) -> pd.DataFrame:
        return bordered(group, -1, None, True)

    def within(group: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        return bordered(group, int(outer["before"].iat[0]), int(outer["at_end"].iat[0]), bool(outer["last"].iat[0]))

    def decode(lines_of: pd.DataFrame, borders: pd.DataFrame) -> pd.DataFrame:
        if not len(lines_of):
            return pd.DataFrame(columns=["conv", "part", "n_turns", "roles", "chat"])
        lines_of = lines_of.sort_values(["at", "seen", "line"], kind="stable")
        hmm: Hmm = sent.value
        texts = lines_of["line"].tolist()
        before = int(borders["before"].iat[0])
        scores = hmm.emissions(lines_of["seen"].to_numpy())
        path = hmm.decode(scores, None if before < 0 else before, int(borders["at_end"].iat[0]))
        roles, pieces = [], []
        for i, (text, state) in enumerate(zip(texts, path, strict=True)):
            if state % 2 == 0:
                role = hmm.roles[state // 2]
                if before >= 0 or i:
                    pieces.append(END)
                roles.append(role)
                pieces.append(TURN.format(role=role, text=split_marker(text)[1].strip()))
            else:
                pieces.append(text.strip() + "\n")
        if borders["last"].iat[0]:
            pieces.append(END)
        out = lines_of[by].head(1).copy()
        out["n_turns"], out["roles"], out["chat"] = len(roles), ",".join(roles), "".join(pieces)
        return out

    types = f"conv {kind}, part long"
    rows, ends = f"{types}, span array<double>, head array<double>", f"{types}, before int, at_end int, last boolean"
    up = F.floor(F.col("part") / fan)
    tables = Tables(spark)
    seen = own.select("conv", "part", "at", "seen")
    rounds = [tables.write(seen.groupBy(*by).applyInPandas(span, rows), "spans")]
    while (rounds[-1].groupBy("conv").count().agg(F.max("count")).head()[0] or 0) > fan:
        wider = rounds[-1].withColumn("up", up).groupBy("conv", "up").applyInPandas(multiply, rows)
        rounds.append(tables.write(wider, "spans"))
    borders = tables.write(rounds[-1].groupBy("conv").applyInPandas(border, ends), "borders")
    for members in reversed(rounds[:-1]):
        outer = borders.withColumnRenamed("part", "up").groupBy("conv", "up")
        inner = members.withColumn("up", up).groupBy("conv", "up").cogroup(outer).applyInPandas(within, ends)
        inner = tables.write(inner, "borders")
        tables.drop(borders)
        borders = inner
    tables.drop(*rounds)
    return (
        own.groupBy(*by)
        .cogroup(borders.groupBy(*by))
        .applyInPandas(decode, f"{types}, n_turns long, roles string, chat string")
        .withColumnRenamed("conv", conv)
    )


# Ways in which transcripts mark their speakers, for trials.
STYLES = (
    {"user": "User: ", "assistant": "Assistant: ", "system": "System: "},
    {"user": "Q: ", "assistant": "A: ", "system": "Context: "},
    {"user": "### Instruction: ", "assistant": "### Response: ", "system": "### System: "},
    {"user": "<|user|> ", "assistant": "<|assistant|> ", "system": "<|system|> "},
    {"user": "**Human**: ", "assistant": "**AI**: ", "system": "[system] "},
)


def transcripts(
    turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", unmarked: int = 5,
) -> DataFrame:
    """Turns as lines of raw transcripts: ``conv, line_no, line, role, first``.

    Every conversation has one style of markers, by a hash of its key; one turn in
    ``unmarked`` has no marker.
    """
    style = F.crc32(F.coalesce(F.col(conv).cast("string"), F.lit(""))) % len(STYLES)
    bare = F.crc32(F.concat_ws("/", F.col(conv).cast("string"), F.col(turn).cast("string"))) % unmarked == 0
    marker = F.lit("")
    for i, marks in enumerate(STYLES):
        for name, mark in marks.items():
            marker = F.when((style == i) & (F.col(role) == name) & ~bare, mark).otherwise(marker)
    place = F.coalesce(F.col(turn), F.lit(0)).cast("long")
    return turns.select(
        F.col(conv).alias("conv_id"), place.alias("turn"), F.col(role).alias("role"), marker.alias("marker"),
        F.posexplode(F.split(F.coalesce(F.col(text), F.lit("")), "\n")).alias("i", "piece"),
    ).select(
        "conv_id",
        "turn",
        (F.col("turn") * F.lit(1 << 24) + F.col("i")).alias("line_no"),
        F.when(F.col("i") == 0, F.concat("marker", "piece")).otherwise(F.col("piece")).alias("line"),
        "role",
        (F.col("i") == 0).alias("first"),
    )
