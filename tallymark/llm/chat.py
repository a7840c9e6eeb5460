"""Chat formatting: the cheapest repair of a conversation's roles, and its rendering.

A legal conversation has an optional system message, then user and assistant in turn, and ends with the assistant.
Every turn either joins the message before it or opens a new one, under its own or another role, with empty messages
inserted where the order needs them. Dynamic programming over the role of the open message finds the least cost.

What a stretch of turns can do is a small matrix of least costs by first and last state, and such matrices chain. So a
long conversation is cut into stretches: their matrices are made apart, a second programme over the stretches picks
the state between each two, and every stretch is then repaired on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import Lists, flat_map

STATES = ("", "system", "user", "assistant")
#: States that may follow each state directly; the last one may end a conversation.
NEXT = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
END = 3
FAR = 1 << 60
#: Turns of a stretch.
STRETCH = 512


@dataclass(frozen=True)
class Rules:
    """Costs, other names of roles, and how messages are written."""

    merge: int = 2
    relabel: int = 4
    insert: int = 3
    aliases: dict[str, str] = field(default_factory=lambda: {"human": "user", "bot": "assistant", "gpt": "assistant", "model": "assistant"})
    header: str = "<|{role}|>\n"
    footer: str = "<|end|>\n"
    joint: str = "\n"
    mark: str = "<|"

    def safe(self, body: str) -> str:
        """A text in which no mark begins: one more backslash stands inside whatever looks like the start of one, so that
        taking one away gives the text back."""
        return re.sub(re.escape(self.mark[0]) + r"(\\*)" + re.escape(self.mark[1:]), lambda m: self.mark[0] + m[1] + "\\" + self.mark[1:], body)

    def plain(self, body: str) -> str:
        """The text that ``safe`` made safe."""
        return re.sub(re.escape(self.mark[0]) + r"(\\*)\\" + re.escape(self.mark[1:]), lambda m: self.mark[0] + m[1] + self.mark[1:], body)

    def role(self, name: str | None) -> int:
        """State of a role; 0 if it is none of the known ones, so that it must be relabelled."""
        plain = (name or "").strip().lower()
        plain = self.aliases.get(plain, plain)
        return STATES.index(plain) if plain in STATES[1:] else 0

    @cached_property
    def between(self) -> dict[tuple[int, int], tuple[int, ...]]:
        """Fewest messages to insert between two states so that the second may be opened."""
        found: dict[tuple[int, int], tuple[int, ...]] = {}
        for q in NEXT:
            paths = [(q, ())]
            for at, path in paths:
                for to in NEXT[at]:
                    if (q, to) not in found:
                        found[q, to] = path
                        paths.append((to, (*path, to)))
        return found

    @cached_property
    def moves(self) -> dict[int, list[tuple[int, int, int, str]]]:
        """By a turn's role: (from, to, cost, action), cheapest and plainest first."""
        made = {}
        for role in range(len(STATES)):
            all_ = []
            for q in range(len(STATES)):
                for to in (1, 2, 3):
                    other = 0 if to == role else self.relabel
                    if (q, to) in self.between:
                        n = len(self.between[q, to])
                        name = "insert" if n else "relabel" if other else "keep"
                        all_.append((q, to, other + n * self.insert, name))
                    if q == to:
                        all_.append((q, to, other + self.merge, "merge"))
            order = ("keep", "merge", "relabel", "insert")
            made[role] = sorted(all_, key=lambda m: (m[2], order.index(m[3]), m[0], m[1]))
        return made

    def ending(self, state: int) -> int:
        return 0 if state == END else self.insert * (1 + len(self.between[state, END])) if state else FAR


def costs(roles: list[int], rules: Rules, entry: int) -> tuple[list[int], list[list[tuple[int, str]]]]:
    """Least cost of ending in each state, and for each turn and state where it came from and by what action."""
    now, back = [FAR] * len(STATES), []
    now[entry] = 0
    for role in roles:
        best, via = [FAR] * len(STATES), [(0, "")] * len(STATES)
        for q, to, cost, action in rules.moves[role]:
            if now[q] + cost < best[to]:
                best[to], via[to] = now[q] + cost, (q, action)
        now = best
        back.append(via)
    return now, back


def path(roles: list[int], rules: Rules, entry: int, last: int | None) -> tuple[list[tuple[int, int, str]], int]:
    """(state before, state after, action) of every turn, ending in ``last`` or in the cheapest way to end."""
    now, back = costs(roles, rules, entry)
    if last is None:
        last = min(range(len(STATES)), key=lambda s: (now[s] + rules.ending(s), s))
    made, state = [], last
    for via in reversed(back):
        before, action = via[state]
        made.append((before, state, action))
        state = before
    return made[::-1], last


def stretches(rows: DataFrame, rules: Rules) -> DataFrame:
    """conv, chunk, sub, entry, last, ends of every stretch of the conversations that have more than one."""
    keys = ["conv", "chunk", "sub"]
    spread = rows.groupBy("conv").agg(F.min(F.struct("chunk", "sub")).alias("a"), F.max(F.struct("chunk", "sub")).alias("b"))
    long = spread.where("a <> b").select(F.col("conv").alias("__conv"))
    some = rows.join(long, rows["conv"].eqNullSafe(long["__conv"]), "left_semi").select(*keys, "turn", "tie", "role")
    ordered = some.repartition(*keys).sortWithinPartitions(*keys, "turn", "tie")

    def matrices(batches: Iterator[Lists]) -> Iterator[Lists]:
        for key, group in _groups(batches, keys):
            roles = [rules.role(_text(x)) for x in group["role"]]
            flat = [x for q in range(len(STATES)) for x in costs(roles, rules, q)[0]]
            yield {k: [v] for k, v in zip(keys, key, strict=True)} | {"least": [flat]}

    def choose(batches: Iterator[Lists]) -> Iterator[Lists]:
        for _, group in _groups(batches, ["conv"]):
            now, back, n = [0, FAR, FAR, FAR], [], len(STATES)
            for flat in group["least"]:
                via = [min(range(n), key=lambda q, s=s: (now[q] + flat[q * n + s], q)) for s in range(n)]
                now = [min(FAR, now[via[s]] + flat[via[s] * n + s]) for s in range(n)]
                back.append(via)
            state = min(range(n), key=lambda s: (now[s] + rules.ending(s), s))
            entry, last = [], []
            for via in reversed(back):
                last.append(state)
                state = via[state]
                entry.append(state)
            ends = [False] * (len(back) - 1) + [True]
            yield {k: group[k] for k in keys} | {"entry": entry[::-1], "last": last[::-1], "ends": ends}

    made = flat_map(ordered, matrices, "conv long, chunk long, sub long, least array<long>")
    return flat_map(made.repartition("conv").sortWithinPartitions(*keys), choose, "conv long, chunk long, sub long, entry int, last int, ends boolean")


def repair(
    conversations: DataFrame, rules: Rules = Rules(), stretch: int = STRETCH, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn, in order of conversation, chunk, sub and row: new_role, action, cost and rendered segment.

    A conversation's segments, one after the other, are its rendering: a segment closes the message before, writes the
    inserted empty ones, opens its own message unless it is merged, and after the last turn closes the conversation. The
    costs of a conversation's turns add up to the least possible. Texts cannot forge a message: what looks like the start
    of a mark in them is escaped (``Rules.safe``). Columns: the conversation, chunk, sub, row, turn, role,
    new_role, action (keep, merge, relabel, insert), cost, segment.

    Turns are ordered by number, equal ones by a hash of role and text, null ones last. A null or unknown role must be
    relabelled; a null text is empty; a null conversation is one conversation; repeated rows are turns of their own.
    An empty table gives an empty one; only the four named columns are read. A task holds one stretch of turns.
    """
    rows = conversations.select(
        F.col(f"`{conv}`").cast("long").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"), F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{role}`", f"`{text}`").alias("tie"),
    )
    last = F.lit((1 << 63) - 1)
    rows = rows.withColumn("chunk", F.coalesce(F.expr(f"turn div {stretch}"), last))
    rows = rows.withColumn("sub", F.when(F.col("turn").isNull(), F.shiftright("tie", 48)).otherwise(F.lit(0)).cast("long"))
    keys = ["conv", "chunk", "sub"]
    plan = stretches(rows.drop("text"), rules).select(*[F.col(k).alias(f"__{k}") for k in keys], "entry", "last", "ends")
    same = [rows[k].eqNullSafe(plan[f"__{k}"]) for k in keys]
    known = rows.join(plan, same, "left").drop(*[f"__{k}" for k in keys])
    ordered = known.repartition(*keys).sortWithinPartitions(*keys, "turn", "tie")

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        for key, group in _groups(batches, keys):
            yield {k: [v] * len(group["turn"]) for k, v in zip((conv, *keys[1:]), key, strict=True)} | _repaired(group, rules, turn, role)

    schema = f"`{conv}` long, chunk long, sub long, row long, `{turn}` long, `{role}` string, new_role string, action string, cost long, segment string"
    return flat_map(ordered, run, schema)


def _repaired(group: Lists, rules: Rules, turn: str, role: str) -> Lists:
    names = [_text(x) for x in group["role"]]
    roles = [rules.role(x) for x in names]
    whole = group["entry"][0] is None
    steps, state = path(roles, rules, 0 if whole else group["entry"][0], None if whole else group["last"][0])
    empty = lambda s: rules.header.format(role=STATES[s]) + rules.footer
    cost, segments = [], []
    for r, (before, after, action), body in zip(roles, steps, group["text"], strict=True):
        own = 0 if r == after else rules.relabel
        if action == "merge":
            cost.append(own + rules.merge)
            segments.append(rules.joint + rules.safe(_text(body) or ""))
            continue
        inserted = rules.between[before, after]
        cost.append(own + rules.insert * len(inserted))
        close = rules.footer if before else ""
        segments.append(close + "".join(map(empty, inserted)) + rules.header.format(role=STATES[after]) + rules.safe(_text(body) or ""))
    if whole or group["ends"][0]:
        cost[-1] += rules.ending(state)
        after = () if state == END else (*rules.between[state, END], END)
        segments[-1] += rules.footer + "".join(map(empty, after))
    return {
        "row": list(range(len(steps))), turn: group["turn"], role: names, "new_role": [STATES[s[1]] for s in steps],
        "action": [s[2] for s in steps], "cost": cost, "segment": segments,
    }


def rendered(turns: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row per conversation of ``repair``'s result: its cost and whole text, for conversations that fit a row."""
    parts = F.array_sort(F.collect_list(F.struct("chunk", "sub", "row", "segment")))
    return turns.groupBy(conv).agg(F.sum("cost").alias("cost"), F.array_join(F.transform(parts, lambda x: x["segment"]), "").alias("text"))


def _text(raw: bytes | None) -> str | None:
    return None if raw is None else raw.decode("utf-8", "replace")


def _groups(batches: Iterator[Lists], keys: list[str]) -> Iterator[tuple[tuple, Lists]]:
    """Runs of rows with equal keys, across batches."""
    held: Lists = {}
    key = None
    for cols in batches:
        all_keys = list(zip(*(cols[k] for k in keys), strict=True))
        at = 0
        for i in range(1, len(all_keys) + 1):
            if i < len(all_keys) and all_keys[i] == all_keys[at]:
                continue
            part = {k: v[at:i] for k, v in cols.items()}
            if held and key == all_keys[at]:
                for k, v in part.items():
                    held[k] = held[k] + v
            else:
                if held:
                    yield key, held
                held, key = part, all_keys[at]
            at = i
    if held:
        yield key, held
