"""Strings that follow a pattern, and the regular expression that checks them."""

from __future__ import annotations

import re
from dataclasses import dataclass

from .draws import MASK32, hash63, literal, permuted

# What a pattern symbol stands for, as (characters, may be empty).
# "?" is one of the letters given with the pattern; any other symbol is itself.
SYMBOLS = {
    "#": ("0123456789", False),
    "%": ("123456789", False),
    "!": ("0123456789", True),
    "@": ("123456789", True),
}
# The largest number one draw can encode.
ROOM = 1 << 62
# Slots that unique strings have room for, however many are asked for.
SLOTS = 1 << 52


@dataclass(frozen=True)
class Position:
    """One pattern symbol: its characters, or a literal when it has a single choice."""

    characters: str
    optional: bool = False
    literal: bool = False

    @property
    def choices(self) -> int:
        return len(self.characters) + self.optional

    def text(self, pick: str) -> str:
        # One past the last character is the empty string.
        return f"substring({literal(self.characters)}, CAST({pick} + 1 AS INT), 1)"


def positions(pattern: str, letters: str) -> list[Position]:
    out = []
    for symbol in pattern:
        if symbol == "?":
            out.append(Position("".join(dict.fromkeys(letters))))
        elif symbol in SYMBOLS:
            out.append(Position(*SYMBOLS[symbol]))
        else:
            out.append(Position(symbol, literal=True))
    return out


def capacity(parts: list[Position]) -> int:
    """Number of strings that are different for certain."""
    size = 1
    for p in parts:
        size *= 1 if p.optional else p.choices
    return size


def pattern_regex(pattern: str, letters: str) -> str:
    """Regular expression that exactly the strings of the pattern match.

    What follows must be the end, not a last line break before it.
    """
    out = []
    for p in positions(pattern, letters):
        if p.literal:
            out.append(re.escape(p.characters))
        else:
            chars = "".join("\\" + c if not c.isalnum() else c for c in p.characters)
            out.append(f"[{chars}]" + ("?" if p.optional else ""))
    return "^(?:" + "".join(out) + r")(?![\s\S])"


@dataclass(frozen=True)
class Spelling:
    """A string column in two steps: numbers first, then characters read off them.

    The numbers belong in a projection of their own, so that each is computed
    once however many characters use it.
    """

    numbers: dict[str, str]
    text: str

    def renamed(self, prefix: str) -> Spelling:
        """The same with a prefix before the names of the numbers."""
        numbers, text = {}, self.text
        for name, number in self.numbers.items():
            new = f"`{prefix}{name[1:]}"
            numbers[new], text = number, text.replace(name, new)
        return Spelling(numbers, text)


def _letters_of(number: str, parts: list[Position]) -> list[str]:
    """Characters of a number written in the mixed radix of the positions."""
    out, radix = [], 1
    for p in parts:
        out.append(p.text(f"{number} div {radix} % {p.choices}"))
        radix *= p.choices
    return out


def _groups(parts: list[Position]) -> list[list[Position]]:
    """Runs of positions that one 62-bit number can encode."""
    groups: list[list[Position]] = [[]]
    size = 1
    for p in parts:
        if size * p.choices > ROOM:
            groups.append([])
            size = 1
        groups[-1].append(p)
        size *= p.choices
    return groups


def _assemble(parts: list[Position], spelled: dict[int, str]) -> str:
    pieces = [spelled.get(i, literal(p.characters)) for i, p in enumerate(parts)]
    return f"concat({', '.join(pieces)})"


def _drawn(
    name: str, index: str, parts: list[Position], chosen: list[int], stream_no: int
) -> tuple[dict[str, str], dict[int, str]]:
    numbers, spelled = {}, {}
    at = iter(chosen)
    for g, group in enumerate(_groups([parts[i] for i in chosen])):
        if not group:
            continue
        number = f"`__{name}_{g}`"
        numbers[number] = hash63(index, (stream_no + 2 * g) & MASK32)
        for text in _letters_of(number, group):
            spelled[next(at)] = text
    return numbers, spelled


def drawn_string(
    name: str, index: str, pattern: str, letters: str, stream_no: int
) -> Spelling:
    """String drawn at random for each index."""
    parts = positions(pattern, letters)
    free = [i for i, p in enumerate(parts) if not p.literal]
    numbers, spelled = _drawn(name, index, parts, free, stream_no)
    return Spelling(numbers, _assemble(parts, spelled))


def unique_room(pattern: str, letters: str) -> int:
    """Number of different strings :func:`unique_string` can give."""
    return min(capacity(positions(pattern, letters)), ROOM)


def unique_string(
    name: str, slot: str, slots: int, pattern: str, letters: str, stream_no: int
) -> Spelling:
    """String that differs for every slot below ``slots``.

    The slot is written into the last positions of the pattern that have room
    for it; the positions before them are drawn.
    """
    parts = positions(pattern, letters)
    if any(p.optional for p in parts):
        raise ValueError("a pattern with optional digits cannot give unique strings")
    free = [i for i, p in enumerate(parts) if not p.literal]
    if slots > SLOTS:
        raise ValueError(f"{slots} unique strings; there is room for {SLOTS}")
    tail: list[int] = []
    room = 1
    while free and room < SLOTS and room * parts[free[-1]].choices <= ROOM:
        tail.append(free.pop())
        room *= parts[tail[-1]].choices
    if room < slots:
        raise ValueError(f"pattern {pattern!r} has {room} strings, {slots} are needed")
    numbers, spelled = _drawn(name, slot, parts, free, stream_no)
    number = f"`__{name}_u`"
    numbers[number] = permuted(slot, room, stream_no)
    for i, text in zip(tail, _letters_of(number, [parts[i] for i in tail])):
        spelled[i] = text
    return Spelling(numbers, _assemble(parts, spelled))
