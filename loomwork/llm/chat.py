"""Chat formatting: records of many layouts to canonical turns, then to one marked text with a loss mask.

A record's layout is told by its schema fingerprint, a hash of its nested field paths. The first record with a new
fingerprint is held against the declared mappings; from then on the fingerprint alone selects the mapping.

The template marks each turn as ``<s>role[INST]text[/INST]</s>``. Control strings inside roles and texts get a
backslash after their first character (one more, if there are some already), so that no text can
close a turn, and every text can be read back exactly. The loss mask covers the texts of assistants.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free

Turn = tuple[str, str]


@dataclass(frozen=True)
class Mapping:
    """One layout. needs: paths that tell it, as ``a.b`` and ``a[].b``. turns: either (list path, role field, text
    field, order field or None), or steps of (role, field) for flat records, fields that are empty being left
    out. join: fields that are put together by a blank line under the first one's role."""

    name: str
    needs: frozenset[str]
    rows: tuple[str, str, str, str | None] | None = None
    steps: tuple[tuple[str, str], ...] = ()
    join: tuple[str, str] | None = None
    rename: bool = False


#: Layouts in order of choice, and role names.
MAPPINGS = (
    Mapping("turn_rows", frozenset({"turns[].turn", "turns[].role", "turns[].text"}), rows=("turns", "role", "text", "turn")),
    Mapping("messages", frozenset({"messages[].role", "messages[].content"}), rows=("messages", "role", "content", None)),
    Mapping("from_value", frozenset({"conversations[].from", "conversations[].value"}), rows=("conversations", "from", "value", None), rename=True),
    Mapping("instruction", frozenset({"instruction", "output"}), steps=(("system", "system"), ("user", "instruction"), ("assistant", "output")), join=("instruction", "input")),
    Mapping("prompt_completion", frozenset({"prompt", "completion"}), steps=(("system", "system"), ("user", "prompt"), ("assistant", "completion"))),
    Mapping("prompt_response", frozenset({"prompt", "response"}), steps=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("question_answer", frozenset({"question", "answer"}), steps=(("system", "system"), ("user", "question"), ("assistant", "answer"))),
)
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")

_RAW = re.compile(r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])")
_TURN = re.compile(r"<s>(.*?)\[INST\](.*?)\[/INST\]</s>", re.S)


def escape(text: str) -> str:
    return _RAW.sub(lambda m: f"{m[1] or m[4]}\\{m[2] or m[5] or ''}{m[3] or m[6]}", text)


def unescape(text: str) -> str:
    return _RAW.sub(lambda m: f"{m[1] or m[4]}{(m[2] or m[5] or '')[1:]}{m[3] or m[6]}", text)


def field_paths(value: object) -> set[str]:
    """Nested paths of the leaves; a null or empty leaf counts as present. Depth doesn't matter."""
    out: set[str] = set()
    todo = [(value, "")]
    while todo:
        value, at = todo.pop()
        if isinstance(value, dict) and value:
            todo += [(v, f"{at}.{k}" if at else str(k)) for k, v in value.items()]
        elif isinstance(value, list) and value:
            todo += [(v, f"{at}[]") for v in value]
        else:
            out.add(at)
    return out


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode("utf-8", "replace")).hexdigest()[:16]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False, sort_keys=True)


def _place(value: object) -> tuple:
    """Order of turn numbers, whatever they are: none, numbers by size, then all else as text."""
    if value is None:
        return (0, 0, "")
    if isinstance(value, (int, float)):
        return (1, value, "")
    try:
        return (1, float(value), "") if isinstance(value, str) else (2, 0, _text(value))
    except ValueError:
        return (2, 0, value)


def _turns(record: dict, mapping: Mapping) -> list[Turn]:
    if mapping.rows:
        name, role, text, order = mapping.rows
        rows = [r for r in record.get(name) or () if isinstance(r, dict)]
        if order:
            rows = sorted(rows, key=lambda r: (_place(r.get(order)), _text(r.get(role)), _text(r.get(text))))
        names = ROLES if mapping.rename else {}
        return [(names.get(_text(r.get(role)), _text(r.get(role))), _text(r.get(text))) for r in rows]
    out = []
    for role, name in mapping.steps:
        value = _text(record.get(name))
        if mapping.join and name == mapping.join[0] and _text(record.get(mapping.join[1])):
            value = f"{value}\n\n{_text(record.get(mapping.join[1]))}"
        if value:
            out.append((role, value))
    return out


@dataclass
class Layouts:
    """Selects mappings; remembers the choice of each fingerprint."""

    mappings: tuple[Mapping, ...] = MAPPINGS
    chosen: dict[str, Mapping | None] = field(default_factory=dict)

    def turns(self, record: object) -> tuple[str, str | None, list[Turn] | None]:
        """Fingerprint, name of the layout, turns; no layout and no turns for what no mapping covers."""
        paths = field_paths(record) if isinstance(record, dict) else set()
        mark = fingerprint(paths)
        if mark not in self.chosen:
            if len(self.chosen) >= 100_000:  # records without any scheme
                self.chosen.clear()
            self.chosen[mark] = next((m for m in self.mappings if m.needs <= paths), None)
        mapping = self.chosen[mark]
        return (mark, mapping.name, _turns(record, mapping)) if mapping else (mark, None, None)


def render(turns: list[Turn]) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and the loss mask as [start, stop) ranges of it."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"<s>{escape(role)}[INST]", escape(text)
        if role == "assistant" and body:
            mask.append((at + len(head), at + len(head) + len(body)))
        part = f"{head}{body}[/INST]</s>"
        parts.append(part)
        at += len(part)
    return "".join(parts), mask


def read_back(formatted: str) -> list[Turn]:
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


CHAT = "fingerprint string, layout string, formatted string, mask array<struct<start:int,stop:int>>"


def _parsed(text: str | None) -> object:
    try:
        value = json.loads(text) if text is not None else None
        if text is not None and "\\ud" in text.lower():  # halves of characters can't leave this process
            value = json.loads(json.dumps(value, ensure_ascii=False).encode("utf-8", "replace"))
        return value
    except (ValueError, RecursionError):  # no JSON, or nested beyond what can be read
        return None


def chat_format(records: DataFrame, *, record: str = "record", mappings: tuple[Mapping, ...] = MAPPINGS, out: str = "chat") -> DataFrame:
    """records with a column ``out``: struct of fingerprint, layout, formatted text and loss mask (code points).

    record: JSON of one conversation, in any declared layout; further fields don't matter. A null, a text that isn't
    a JSON object (or is nested some hundreds deep) and an undeclared layout get a null layout and a null text, so that they can
    be found. Turn numbers may be numbers in one row and text in another. Null texts and roles are empty. All rows and columns stay.
    """

    @F.pandas_udf(CHAT)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        layouts = Layouts(mappings)
        for batch in batches:
            rows = []
            for text in batch:
                try:
                    mark, name, turns = layouts.turns(_parsed(text))
                except RecursionError:
                    mark, name, turns = fingerprint(set()), None, None
                formatted, mask = render(turns) if turns is not None else (None, [])
                rows.append((mark, name, formatted, [{"start": s, "stop": e} for s, e in mask]))
            yield pd.DataFrame(rows, columns=["fingerprint", "layout", "formatted", "mask"])

    return records.withColumn(free(out, records.columns), run.asNondeterministic()(F.col(record)))  # so that it runs once for all its fields


def chat_read(chats: DataFrame, *, chat: str = "chat", turn_digest: Callable[[list[Turn]], str] | None = None, out: str = "read") -> DataFrame:
    """chats with what is read back from the formatted texts alone: struct of n_turns, turns (role, text) and the text
    under the loss mask. Null texts give null."""

    @F.pandas_udf("n_turns long, turns array<struct<role:string,text:string>>, loss string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for formatted, masks in batches:
            rows = []
            for text, mask in zip(formatted, masks, strict=True):
                if text is None:
                    rows.append((None, None, None))
                    continue
                turns = read_back(text)
                loss = "".join(unescape(text[m["start"] : m["stop"]]) for m in mask)
                rows.append((len(turns), [{"role": r, "text": t} for r, t in turns], loss))
            yield pd.DataFrame(rows, columns=["n_turns", "turns", "loss"])

    return chats.withColumn(free(out, chats.columns), run.asNondeterministic()(F.col(f"{chat}.formatted"), F.col(f"{chat}.mask")))


def from_turn_rows(rows: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) to one JSON record per conversation: columns conv_id, record. Turns with equal
    numbers are ordered by role and text; null conv_ids form one conversation. A conversation is one output
    text, so its turns meet in one task; nothing else does.

    Records are written in the layout that their turns fit: a question with its answer as prompt and response, with a system's
    text before them as prompt and completion, strict turns of user and assistant as messages, all else as numbered turns.
    """
    turn = F.struct(F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    packed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    roles, texts = F.col("turns.role"), F.col("turns.text")
    full = ~F.exists(texts, lambda t: t == "")

    def record(**fields: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})

    def are(*names: str) -> Column:
        return (roles == F.array(*map(F.lit, names))) & full

    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    strict = (F.size("turns") > 0) & F.forall(F.arrays_zip(roles.alias("role"), F.sequence(F.lit(0), F.size("turns") - 1).alias("k")), lambda x: x["role"] == F.when(x["k"] % 2 == 0, "user").otherwise("assistant"))
    made = (
        F.when(are("user", "assistant"), record(prompt=F.get(texts, F.lit(0)), response=F.get(texts, F.lit(1))))
        .when(are("system", "user", "assistant"), record(system=F.get(texts, F.lit(0)), prompt=F.get(texts, F.lit(1)), completion=F.get(texts, F.lit(2))))
        .when(strict, record(messages=messages))
        .otherwise(record(turns=F.col("turns")))
    )
    return packed.select("conv_id", made.alias("record"))
