"""A merge-type (BPE) vocabulary compiled into a deterministic automaton over prefixes.

In a merge-type encoding every prefix of a text has exactly one last token: of the tokens that are a suffix of
the prefix, the one that is compatible with the last token of what is before it. Two tokens are compatible if
the encoding of their joined text is those two tokens. So reading one more character needs, of all the text
read so far, only the longest suffix that starts some token, and the last tokens at the places where its own
suffixes of that kind begin. That is a state. States and transitions are compiled when first met and kept, up to
a bound; past it the compiled part starts anew, which changes no result.

A transition is annotated with the number of tokens by which the encoding grows. It may be negative: one long
token can replace several short ones.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import pyarrow as pa

SPACE = "▁"
# A unit is a run of spaces and what follows up to the next space: no token goes on after its text into a space.
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
# Marks a unit that begins with a line feed. No text has this character.
LINE = "\ud800\n"
# Bounds of what one Python worker keeps.
MAX_STATES = 120_000
MAX_TRANSITIONS = 300_000
MAX_PAIRS = 250_000
MAX_UNITS = 400_000
# Longer units are not kept.
LONG_UNIT = 48

START = 0


Move = tuple[int, tuple[tuple[int, int], ...], tuple[int, ...]]


def _fields(message: bytes) -> dict[int, int | bytes]:
    """The last value of each field of a protocol buffer message."""
    out: dict[int, int | bytes] = {}
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            out[key >> 3] = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            out[key >> 3] = message[at : at + size]
            at += size
    return out


def _refuse_other_kinds(model: bytes) -> None:
    """Raise unless the model is of type BPE, has no normalisation rules, a dummy prefix, and keeps white space."""
    parts = _fields(model)
    trainer, rules = _fields(parts.get(2, b"")), _fields(parts.get(3, b""))
    # Fields that are left out have the library's defaults.
    if trainer.get(3, 1) != 2:
        raise ValueError("the model is not of type BPE")
    if trainer.get(24, 0):
        raise ValueError("the model has white space as a suffix")
    if rules.get(2, b""):
        raise ValueError("the model has normalisation rules")
    if not rules.get(3, 1) or rules.get(4, 1) or not rules.get(5, 1):
        raise ValueError("the model has no dummy prefix, or does not keep or escape white space")


class MergeAutomaton:
    """The automaton of a sentencepiece model of type BPE without normalisation rules."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        _refuse_other_kinds(model)
        processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = processor.get_piece_size()
        plain = [
            i
            for i in range(size)
            if not (processor.is_unknown(i) or processor.is_control(i) or processor.is_byte(i) or processor.is_unused(i))
        ]
        self.piece = {i: processor.id_to_piece(i) for i in range(size)}
        self.pieces = pa.array([self.piece[i] for i in range(size)], pa.string())
        self.lengths = [len(self.piece[i]) for i in range(size)]
        self.ids = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: processor.get_score(i) for i in plain}
        self.byte_ids = {int(self.piece[i][1:-1], 16): i for i in range(size) if processor.is_byte(i)}
        self.bytes_of = {i: byte for byte, i in self.byte_ids.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("the model needs byte fallback")
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("the model has tokens that go over a word's end")
        if any("\n" in piece for piece in self.ids):
            raise ValueError("the model has tokens with a line feed")
        names = {piece[:k] for piece in self.ids for k in range(len(piece) + 1)}
        self._names = sorted(names)
        self._nodes = {name: node for node, name in enumerate(self._names)}
        self._goes_on = {name[:-1] for name in names if name}
        self._pairs: dict[int, bool] = {}
        self._moves: dict[tuple[int, str], Move | None] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the node of the longest suffix that starts a token; the last token (-1: none); and for each
        # suffix of that kind, from the longest, the token before it and the tokens up to there, relative to now.
        begin = (self._nodes[""], -1)
        self._states = [begin]
        # The last token of what was read, -1 if it ends in bytes.
        self.lasts = [-1]
        self._numbers = {begin: START}
        self.steps: list[dict[str, tuple[int, int]]] = [{}]
        self._moves.clear()
        self._transitions = 0

    # ---- the vocabulary

    def _meets(self, before: str, text: str) -> bool:
        """Whether the encoding of both together is those two tokens. It merges the best pair, the leftmost of
        equals, until none is left; a merge over the border says no."""
        parts = [*before, *text]
        border = len(before)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = score.get(parts[i] + parts[i + 1])
                if found is not None and (best is None or found > best):
                    best, at = found, i
            if best is None:
                break
            if at == border - 1:
                return False
            if at < border:
                border -= 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return len(parts) == (2 if before else 1)

    def _move(self, node: int, char: str) -> Move | None:
        """The next node; the places (among the node's suffixes; -1: ``char`` itself) at which tokens may end now,
        with the token, longest first; and the places of the next node's suffixes. None if no token has the
        character. Suffixes that no longer token goes on from are dropped."""
        if char not in self._nodes:
            return None
        name = self._names[node]
        before = {length: place for place, length in enumerate(self._open_lengths(name))}
        text = name + char
        # Every place that begins a token now is open before, or is the character's own.
        lengths = [*(length + 1 for length in before), 1]
        ends = tuple((before.get(length - 1, -1), self.ids[text[-length:]]) for length in lengths if text[-length:] in self.ids)
        opened = [length for length in lengths if text[-length:] in self._goes_on]
        following = text[-opened[0] :] if opened else ""
        return self._nodes[following], ends, tuple(before.get(length - 1, -1) for length in opened)

    def _open_lengths(self, name: str) -> list[int]:
        return [len(name) - k for k in range(len(name)) if name[k:] in self._goes_on]

    # ---- states

    def compile_step(self, state: int, char: str) -> tuple[int, int]:
        """The transition of ``state`` by ``char``: the next state, and the tokens by which the encoding grows."""
        here = self._states[state]
        at = (here[0], char)
        move = self._moves.get(at, ())
        if move == ():
            move = self._moves[at] = self._move(*at)
        if move is None:
            # An unknown character is spelled in bytes, and nothing merges with it.
            step = (START, len(char.encode()))
        else:
            pairs, ends, grows = self._pairs, -1, 0
            following, tokens, opened = move
            for place, token in tokens:
                before = here[1] if place < 0 else here[2 + 2 * place]
                key = (before + 1) << 24 | token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = self._meets("" if before < 0 else self.piece[before], self.piece[token])
                if fits:
                    ends, grows = token, 1 if place < 0 else here[3 + 2 * place] + 1
                    break
            if ends < 0:
                raise ValueError(f"no token ends after {self._names[here[0]] + char!r}")
            flat = [following, ends]
            for place in opened:
                if place < 0:
                    flat += (here[1], -grows)
                else:
                    flat += (here[2 + 2 * place], here[3 + 2 * place] - grows)
            after = tuple(flat)
            number = self._numbers.get(after)
            if number is None:
                number = self._numbers[after] = len(self._states)
                self._states.append(after)
                self.lasts.append(ends)
                self.steps.append({})
            step = (number, grows)
        self.steps[state][char] = step
        self._transitions += 1
        return step

    def make_room(self) -> None:
        """Drop what is compiled if it is at its bound. No state number may be held over this call."""
        if len(self._states) > MAX_STATES or self._transitions > MAX_TRANSITIONS:
            self._reset()
        if len(self._pairs) > MAX_PAIRS:
            self._pairs.clear()


def units(text: str) -> list[str]:
    """The units of a text, each without its first space, which stands for the text's or word's start.

    A line feed is no part of a token, so one that follows text begins a unit of its own kind; it is marked.
    """
    found: list[str] = []
    first, *lines = text.replace(" ", SPACE).split("\n")
    _spaced(first, found)
    for line in lines:
        head, space, rest = line.partition(SPACE)
        found.append(LINE + head)
        if space:
            _spaced(rest, found)
    return found


def _spaced(line: str, found: list[str]) -> None:
    parts = line.split(SPACE)
    found += [unit[1:] for unit in _UNIT.findall(SPACE + line)] if "" in parts else parts


def spelled(unit: str) -> str:
    """The characters of a unit as they are read."""
    return unit[1:] if unit.startswith(LINE) else SPACE + unit


@lru_cache(maxsize=4)
def automaton(model: bytes) -> MergeAutomaton:
    """One automaton for each model and Python worker."""
    return MergeAutomaton(model)


@contextmanager
def no_cycle_search() -> Iterator[None]:
    """The many small objects kept here form no cycles; searching them for some takes half of the time."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()
