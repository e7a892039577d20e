"""Chat formatting by schema fingerprints.

Records come as JSON in any of several layouts. A record's fingerprint is a hash of those of its nested field paths
that some layout needs, whatever other fields it has; it selects a declarative mapping from the layout to canonical
turns (role, text). Turns are rendered into one string
by a template, in which control strings inside texts are escaped so that the turns can be read back, and the
stretches under the loss mask (the assistant's texts) are marked.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tripmill.llm.common import importable, whole_text

# ---- layouts


@dataclass(frozen=True)
class Each:
    """One turn for each element of a list. With ``parts``, a text may also be a list of parts, whose texts are joined."""

    items: str
    role: str
    text: str
    parts: str | None = None

    def needed(self) -> list[set[str]]:
        """The sets of paths of records that have these turns."""
        whole, role, text = f"{self.items}[]", f"{self.items}[].{self.role}", f"{self.items}[].{self.text}"
        if self.parts is None:
            return [{whole}, {whole, role, text}]
        part = f"{text}[].{self.parts}"
        # Lists of parts only, with or without a text in one, or beside plain texts.
        return [{whole, role, f"{text}[]", *more} for more in ((), (part,), (text,), (part, text))]

    def named(self) -> set[str]:
        # A list of texts instead of objects is another layout, so the path of such a text counts, too.
        return set().union(*self.needed(), {f"{self.items}[]."})


@dataclass(frozen=True)
class One:
    """One turn of a given role; optional fields follow the first, a blank line between."""

    role: str
    field: str
    more: tuple[str, ...] = ()
    optional: bool = False

    def needed(self) -> list[set[str]]:
        return [set() if self.optional else {self.field}]

    def named(self) -> set[str]:
        return self.needed()[0]


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Each | One, ...]


LAYOUTS = (
    Layout("turns", (Each("turns", "role", "text"),)),
    Layout("messages", (Each("messages", "role", "content"),)),
    Layout("message_parts", (Each("messages", "role", "content", "text"),)),
    Layout("conversations", (Each("conversations", "from", "value"),)),
    Layout("prompt_completion", (One("system", "system", optional=True), One("user", "prompt"), One("assistant", "completion"))),
    Layout("prompt_response", (One("system", "system", optional=True), One("user", "prompt"), One("assistant", "response"))),
    Layout("instruction", (One("system", "system", optional=True), One("user", "instruction", ("input",)), One("assistant", "output"))),
    Layout("question_answer", (One("user", "question", ("context",)), One("assistant", "answer"))),
)
# Names that layouts have for the canonical roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def field_paths(value: Any, at: str = "") -> set[str]:
    """The paths of a record's fields, null or not. A list has the path ``a[]``; its elements' fields are ``a[].b``, and
    elements that have no fields are ``a[].``."""
    if isinstance(value, dict):
        found = set()
        for name, inner in value.items():
            found |= field_paths(inner, at + name if not at or at.endswith(".") else f"{at}.{name}")
        return found
    if isinstance(value, list):
        return set().union({at + "[]"}, *(field_paths(inner, at + "[].") for inner in value))
    return {at}


def fingerprint(paths: set[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def named_paths(layouts: tuple[Layout, ...]) -> set[str]:
    """The paths that count: those that some layout needs."""
    return set().union(*(turn.named() for layout in layouts for turn in layout.turns))


def known_fingerprints(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    """Each layout by the fingerprints it can have. Of layouts that need the same, the first is taken."""
    known: dict[str, Layout] = {}
    for layout in layouts:
        for needed in product(*(turn.needed() for turn in layout.turns)):
            known.setdefault(fingerprint(set().union(*needed)), layout)
    return known


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def to_turns(record: dict[str, Any], layout: Layout) -> list[tuple[str, str]]:
    """The canonical turns of a record in a layout. A missing or null text is empty."""
    turns = []
    for turn in layout.turns:
        if isinstance(turn, One):
            given = [record.get(name) for name in (turn.field, *turn.more)]
            if turn.optional and given[0] is None:
                continue
            turns.append((turn.role, "\n\n".join([_text(given[0]), *(_text(x) for x in given[1:] if x is not None)])))
            continue
        for item in record.get(turn.items) or []:
            text = item.get(turn.text)
            if turn.parts and isinstance(text, list):
                text = "".join(_text(part.get(turn.parts) if isinstance(part, dict) else part) for part in text)
            role = _text(item.get(turn.role))
            turns.append((ROLES.get(role, role), _text(text)))
    return turns


# ---- template

_OPEN, _CLOSE = "###", "</turn>"
_LABELS = {"user": "User", "assistant": "Assistant", "system": "System", "tool": "Tool"}
_ROLE_OF = {label: role for role, label in _LABELS.items()}
# Backslashes count only before a control string or the end of a text; there they are doubled, and one more is
# set before the control string. Everything else is as it was.
_CONTROL = re.compile(r"(?<!\\)(\\*+)(###|</turn>|\Z)")
_ENDS = re.compile(r"(?<!\\)(\\*+)</turn>\n")
_HEAD = re.compile(r"### (=(?:[^\\:]|\\.)*|[A-Z][a-z]*): ", re.DOTALL)


def escape(text: str) -> str:
    if _OPEN not in text and _CLOSE not in text and not text.endswith("\\"):
        return text
    return _CONTROL.sub(lambda m: m[1] * 2 + ("\\" + m[2] if m[2] else ""), text)


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return _CONTROL.sub(lambda m: m[1][: len(m[1]) // 2] + m[2], text)


def _label(role: str) -> str:
    return _LABELS.get(role) or "=" + role.replace("\\", "\\\\").replace(":", "\\:")


def _role(label: str) -> str:
    return re.sub(r"\\(.)", r"\1", label[1:], flags=re.DOTALL) if label.startswith("=") else _ROLE_OF[label]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted string, and the stretches (first code point, code points) under the loss mask."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body, tail = f"{_OPEN} {_label(role)}: ", escape(text), f"{_CLOSE}\n"
        if role == "assistant":
            spans.append((at + len(head), len(body)))
        out += (head, body, tail)
        at += len(head) + len(body) + len(tail)
    return "".join(out), spans


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted string."""
    turns, at = [], 0
    for end in _ENDS.finditer(formatted):
        if len(end[1]) % 2 or end.start() < at:
            continue
        head = _HEAD.match(formatted, at)
        if head is None:
            raise ValueError(f"no turn begins at {at}")
        stop = end.end() - len(_CLOSE) - 1
        if head.end() > stop:
            # The control string is part of a role's name.
            continue
        turns.append((_role(head[1]), unescape(formatted[head.end() : stop])))
        at = end.end()
    if at != len(formatted):
        raise ValueError(f"text after the last turn, at {at}")
    return turns


# ---- on Spark


def _mapped(df: DataFrame, schema: T.StructType, convert: Callable[[dict[str, list]], dict[str, list]]) -> DataFrame:
    importable(df.sparkSession)
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = convert(batch.to_pydict())
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def rows_to_records(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One record of layout ``turns`` for each conversation given as one row for each turn: its id and ``record``.

    Turns go by number, a NULL number first; turns of one number go by role and text, and all are kept. NULL
    roles and texts are empty. A NULL id is a conversation of its own. A conversation becomes one row, so its
    turns must fit in one; other columns are ignored.
    """
    turn = F.struct(F.col(turn_col).alias("n"), whole_text(role_col).alias("role"), whole_text(text_col).alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(turn)), lambda t: F.struct(t["role"], t["text"]))
    return rows.groupBy(F.col(id_col).alias(id_col)).agg(F.to_json(F.struct(turns.alias("turns"))).alias("record"))


def format_records(
    records: DataFrame, id_col: str, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """One row per record: its id, ``layout``, ``fingerprint``, ``formatted`` and ``loss_spans`` (code points).

    A record is JSON text. One that is NULL, empty, no JSON object, or in no known layout is returned with NULL
    ``layout``, ``formatted`` and ``loss_spans`` and, if it is an object, its fingerprint; so is one that has the fields
    of two layouts. Fields that no layout needs do not matter. A field that is null is there and empty, a turn's text
    that is missing is empty; a record with an empty list of turns is formatted to empty text. Repeated records and NULL
    ids are records like any other; other columns are ignored.
    """
    known, named = known_fingerprints(layouts), named_paths(layouts)
    rows = records.select(F.col(id_col).alias("row_id"), F.col(record_col).alias("row_record"))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            T.StructField("layout", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("formatted", T.StringType()),
            T.StructField("loss_spans", T.ArrayType(span)),
        ]
    )

    def one(text: str | None) -> tuple:
        try:
            record = json.loads(text) if text else None
        except ValueError:
            record = None
        if not isinstance(record, dict):
            return None, None, None, None
        print_ = fingerprint(field_paths(record) & named)
        layout = known.get(print_)
        if layout is None:
            return None, print_, None, None
        formatted, spans = render(to_turns(record, layout))
        return layout.name, print_, formatted, [{"start": start, "length": length} for start, length in spans]

    def convert(batch: dict[str, list]) -> dict[str, list]:
        made = [one(text) for text in batch["row_record"]]
        names = ("layout", "fingerprint", "formatted", "loss_spans")
        return {id_col: batch["row_id"], **{name: [row[i] for row in made] for i, name in enumerate(names)}}

    return _mapped(rows, schema, convert)


def read_formatted(formatted: DataFrame, id_col: str) -> DataFrame:
    """What is read back from formatted records: turns, text under the loss mask, as numbers and digests.

    Rows without ``formatted`` have NULL in every column but the id.
    """
    rows = formatted.select(F.col(id_col).alias("row_id"), "formatted", "loss_spans")
    names = ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    schema = T.StructType(
        [
            T.StructField(id_col, rows.schema["row_id"].dataType),
            *(T.StructField(name, T.StringType() if name.endswith("sha256") else T.LongType()) for name in names),
        ]
    )

    def one(text: str | None, spans: list[dict[str, int]] | None) -> tuple:
        if text is None:
            return (None,) * len(names)
        turns = read_back(text)
        spelled = "".join(f"{role}\n{said}\n" for role, said in turns)
        loss = "".join(unescape(text[s["start"] : s["start"] + s["length"]]) for s in spans or [])
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return len(turns), digest(spelled), len(loss), digest(loss), len(text)

    def convert(batch: dict[str, list]) -> dict[str, list]:
        made = [one(*row) for row in zip(batch["formatted"], batch["loss_spans"])]
        return {id_col: batch["row_id"], **{name: [row[i] for row in made] for i, name in enumerate(names)}}

    return _mapped(rows, schema, convert)
