"""Patterns that cannot end a run (RUL3, RUL4).

Java matches regular expressions by backtracking and, for repeated groups, by recursion: ``(a|b)*c`` overflows the stack on
a value of some 10,000 characters, ``(a+)+b`` takes time exponential in it, ``a*b`` on a run of n letters a takes
n * n steps.  Either would end or hang a run over all load sets because of one value.  ``check_pattern`` parses a
pattern and accepts it only when its shape bounds the work by a small multiple of the value's length:

* no repeated group (an optional one, ``(..)?``, may be), so no recursion over the value and no nested repeats;
* a repeat without a bound (``*`` or ``+`` after one character or class) is either the last thing matched, or the pattern
  begins with ``^`` and nothing that may follow the repeat shares a character with it: then there is one way to match and nothing
  to try again;
* repeats with a bound, optional parts and alternatives multiply to at most ``MOST_WAYS`` ways per starting point;
* groups are plain or ``(?:..)``: no look-around, flags or back-references; classes hold characters and ranges only.

``check_like`` does the same for LIKE, which Java runs as a regular expression where ``%`` is ``.*``: at most one ``%`` may
have something after it.  Patterns are literals without escapes (``rules.check_rule``).
"""

from __future__ import annotations

from dataclasses import dataclass

MOST_WAYS = 1_000           # alternatives to try per starting point
MOST_LENGTH = 500           # of a pattern
MOST_REPEATS = 1_000        # upper bound of a bounded repeat
TOP = 0x10FFFF
LINE_ENDS = ((0x0A, 0x0A), (0x0D, 0x0D), (0x85, 0x85), (0x2028, 0x2029))

Ranges = tuple[tuple[int, int], ...]


class PatternRefused(ValueError):
    """The pattern could take unbounded time or stack on some value."""


def _sorted(ranges) -> Ranges:
    return tuple(sorted(ranges))


def _complement(ranges: Ranges) -> Ranges:
    out, at = [], 0
    for a, b in _sorted(ranges):
        if at < a:
            out.append((at, a - 1))
        at = max(at, b + 1)
    return (*out, (at, TOP)) if at <= TOP else tuple(out)


def _overlap(a: Ranges, b: Ranges) -> bool:
    return any(x <= d and c <= y for x, y in a for c, d in b)


@dataclass
class Part:
    """What the checks need of a piece of a pattern."""

    first: Ranges = ()          # characters it can begin with
    empty: bool = True          # it can match nothing
    ways: int = 1               # ways to match at one place, unbounded repeats counted as one
    open_ends: tuple[Ranges, ...] = ()  # the unbounded repeats that can be its end
    inner: bool = False         # an unbounded repeat has something after it
    clash: bool = False         # .. that shares a character with it


def _then(a: Part, b: Part) -> Part:
    """``a`` followed by ``b``."""
    follows = bool(b.first) or not b.empty
    clash = a.clash or b.clash or any(_overlap(r, b.first) for r in a.open_ends)
    return Part(
        first=a.first + b.first if a.empty else a.first,
        empty=a.empty and b.empty,
        ways=a.ways * b.ways,
        open_ends=b.open_ends + (a.open_ends if b.empty else ()),
        inner=a.inner or b.inner or (follows and bool(a.open_ends)),
        clash=clash,
    )


def _either(parts: list[Part]) -> Part:
    return Part(
        first=tuple(r for p in parts for r in p.first),
        empty=any(p.empty for p in parts),
        ways=sum(p.ways for p in parts),
        open_ends=tuple(r for p in parts for r in p.open_ends),
        inner=any(p.inner for p in parts),
        clash=any(p.clash for p in parts),
    )


class _Parser:
    def __init__(self, text: str):
        self.text, self.at = text, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        c = self.peek()
        self.at += 1
        return c

    def alternatives(self, depth: int) -> Part:
        branches = [self.sequence(depth)]
        while self.peek() == "|":
            self.take()
            branches.append(self.sequence(depth))
        return branches[0] if len(branches) == 1 else _either(branches)

    def sequence(self, depth: int) -> Part:
        out = Part()
        while self.peek() not in ("", "|", ")"):
            out = _then(out, self.item(depth))
        return out

    def item(self, depth: int) -> Part:
        c = self.take()
        if c in "*+?{":
            raise PatternRefused(f"nothing to repeat at {self.at - 1}")
        if c == "$":
            # zero-width, but a repeat before it has something after it
            if self.peek() in ("*", "+", "?", "{"):
                raise PatternRefused("an anchor cannot be repeated")
            return Part(empty=False)
        if c == "^":
            raise PatternRefused("^ is only allowed as the first character")
        if c == "(":
            return self.group(depth)
        chars = self.char_class() if c == "[" else _complement(LINE_ENDS) if c == "." else ((ord(c), ord(c)),)
        return self.repeated(chars)

    def group(self, depth: int) -> Part:
        if depth > 20:
            raise PatternRefused("groups are nested too deep")
        if self.peek() == "?":
            if self.text[self.at : self.at + 2] != "?:":
                raise PatternRefused("only plain groups and (?:..) are allowed")
            self.at += 2
        inside = self.alternatives(depth + 1)
        if self.take() != ")":
            raise PatternRefused("unbalanced parentheses")
        if self.peek() in ("*", "+", "{"):
            raise PatternRefused("a group cannot be repeated")
        if self.peek() == "?":
            self.take()
            if self.peek() in ("?", "+"):
                self.take()
            return _either([inside, Part()])
        return inside

    def char_class(self) -> Ranges:
        negated = self.peek() == "^"
        if negated:
            self.take()
        ranges, begin = [], self.at
        while (c := self.take()) != "]" or self.at - 1 == begin:
            if c == "":
                raise PatternRefused("unbalanced brackets")
            if c in "[&]":
                raise PatternRefused("a class may hold only characters and ranges")
            low = high = ord(c)
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] not in ("]", ""):
                self.take()
                top = self.take()
                if top in "[&" or ord(top) < low:
                    raise PatternRefused("a class may hold only characters and ranges")
                high = ord(top)
            ranges.append((low, high))
        return _complement(_sorted(ranges)) if negated else _sorted(ranges)

    def repeated(self, chars: Ranges) -> Part:
        c = self.peek()
        if c == "*" or c == "+":
            self.take()
            if self.peek() in ("?", "+"):
                self.take()
            return Part(chars, c == "*", 1, (chars,))
        if c == "?":
            self.take()
            if self.peek() in ("?", "+"):
                self.take()
            return Part(chars, True, 2)
        if c == "{":
            least, most = self.bounds()
            if self.peek() in ("?", "+"):
                self.take()
            return Part(chars, least == 0, most - least + 1)
        return Part(chars, False, 1)

    def bounds(self) -> tuple[int, int]:
        end = self.text.find("}", self.at)
        low, _, high = self.text[self.at + 1 : end].partition(",") if end > 0 else ("", "", "")
        if not low.isdigit() or not low.isascii() or ("," in self.text[self.at : end] and not (high.isdigit() and high.isascii())):
            raise PatternRefused("a counted repeat needs a lower and an upper bound")
        least, most = int(low), int(high or low)
        if not least <= most <= MOST_REPEATS:
            raise PatternRefused(f"a counted repeat may have at most {MOST_REPEATS} turns")
        self.at = end + 1
        return least, most


def check_pattern(text: str) -> None:
    """Refuse a regular expression whose work on a value is not bounded by its shape."""
    if len(text) > MOST_LENGTH:
        raise PatternRefused(f"a pattern may have at most {MOST_LENGTH} characters")
    anchored = text.startswith("^")
    parser = _Parser(text[1:] if anchored else text)
    part = parser.alternatives(0)
    if parser.at < len(parser.text):
        raise PatternRefused("unbalanced parentheses")
    if anchored and _branches(parser.text) > 1:
        anchored = False        # ^a|b*c: only the first alternative is anchored
    if part.ways > MOST_WAYS:
        raise PatternRefused("too many alternatives to try")
    if part.inner and not anchored:
        raise PatternRefused("after an unbounded repeat nothing may follow, unless the pattern begins with ^")
    if part.clash:
        raise PatternRefused("what follows an unbounded repeat must not share a character with it")


def _branches(text: str) -> int:
    """Alternatives at the top of a pattern that has been parsed."""
    depth, inside, n = 0, False, 1
    for i, c in enumerate(text):
        if inside:
            inside = c != "]" or text[i - 1] == "[" or text[i - 2 : i] == "[^"
        elif c == "[":
            inside = True
        elif c in "()":
            depth += 1 if c == "(" else -1
        elif c == "|" and depth == 0:
            n += 1
    return n


def check_like(text: str) -> None:
    """Refuse a LIKE pattern in which more than one ``%`` has something after it."""
    if text.rstrip("%").count("%") > 1 or "%%" in text:
        raise PatternRefused("at most one % of a pattern may have something after it")
