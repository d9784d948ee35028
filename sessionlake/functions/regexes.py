"""Linear-time regular expressions (as RE2 writes them) in the dialect of the JVM.

Policies are written for an engine without look-around and back references, with
POSIX classes and its own rules for replacements.  All that is valid there is
translated; what is not valid there is an error here too.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Names of POSIX classes, as they stand inside brackets.
_POSIX = {
    "alnum": r"\p{Alnum}", "alpha": r"\p{Alpha}", "ascii": r"\p{ASCII}", "blank": r"\p{Blank}", "cntrl": r"\p{Cntrl}", "digit": r"\p{Digit}",
    "graph": r"\p{Graph}", "lower": r"\p{Lower}", "print": r"\p{Print}", "punct": r"\p{Punct}", "space": r"\p{Space}", "upper": r"\p{Upper}",
    "word": r"\w", "xdigit": r"\p{XDigit}",
}
_PLAIN = set("dDwWaftnrv")
_MOST = 1000


@dataclass(frozen=True)
class Rule:
    """A pattern of the JVM, with the number of each named group."""

    pattern: str
    groups: int = 0
    names: dict[str, int] = field(default_factory=dict)


class _Reader:
    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.groups, self.names = 0, {}

    def fail(self, why: str):
        raise ValueError(f"no valid pattern, {why} at {self.at}: {self.text!r}")

    def peek(self, n: int = 1) -> str:
        return self.text[self.at : self.at + n]

    def take(self, n: int = 1) -> str:
        out = self.peek(n)
        if len(out) < n:
            self.fail("it ends too early")
        self.at += n
        return out

    def upto(self, end: str) -> str:
        stop = self.text.find(end, self.at)
        if stop < 0:
            self.fail(f"{end!r} is missing")
        out, self.at = self.text[self.at : stop], stop + len(end)
        return out

    # --- pieces ---------------------------------------------------------------------------

    def escape(self, in_class: bool) -> str:
        """What follows a backslash."""
        c = self.take()
        if c == "p" or c == "P":
            name = self.upto("}") if self.peek() == "{" and self.take() else self.take()
            turned = name.startswith("^")
            name = name.removeprefix("^")
            sign = "P" if (c == "P") != turned else "p"
            return rf"\{sign}{{{name if len(name) <= 2 else 'Is' + name}}}" if name != "Any" else (r"[^\x{0}-\x{10FFFF}]" if sign == "P" else r"[\x{0}-\x{10FFFF}]")
        if c == "x":
            code = self.upto("}") if self.peek() == "{" and self.take() else self.take(2)
            if not code or set(code.lower()) - set("0123456789abcdef"):
                self.fail("bad number")
            return rf"\x{{{code}}}"
        if c in "01234567":
            if c != "0" and self.peek() not in set("01234567"):
                self.fail("there are no back references")
            digits = c
            while len(digits) < 3 and self.peek() and self.peek() in "01234567":
                digits += self.take()
            return rf"\x{{{int(digits, 8):x}}}"
        if c == "s":
            return r"\t\n\f\r\x20" if in_class else r"[\t\n\f\r\x20]"
        if c == "S":
            return r"[^\t\n\f\r\x20]"
        if c == "v":
            return r"\x0B"
        if c in _PLAIN:
            return "\\" + c
        if not in_class and c in "AbBz":
            return "\\" + c
        if c.isascii() and not c.isalnum():
            return "\\" + c
        self.fail(f"unknown escape {c!r}")

    def bracket(self) -> str:
        """A class, behind its opening bracket."""
        out = ["["]
        if self.peek() == "^":
            out.append(self.take())
        first = True
        while first or self.peek() != "]":
            if self.peek(2) == "[:":
                self.take(2)
                name = self.upto(":]")
                cls = _POSIX.get(name.removeprefix("^"))
                if cls is None:
                    self.fail(f"unknown class {name!r}")
                out.append(cls if name[0] != "^" else (cls.upper() if cls == r"\w" else cls.replace(r"\p", r"\P")))
            else:
                c = self.take()
                out.append(self.escape(True) if c == "\\" else "\\" + c if c in "[]&^#" else c)
            first = False
        self.take()
        return "".join(out) + "]"

    def repeat(self) -> str:
        """A counted repetition behind its brace, or '' where the brace is a plain one."""
        end = self.text.find("}", self.at)
        low, comma, high = self.text[self.at : end].partition(",") if end >= 0 else ("", "", "")
        if not low.isdigit() or not low.isascii() or (high and not (high.isdigit() and high.isascii())):
            return ""
        if int(low) > _MOST or (high and (int(high) > _MOST or int(high) < int(low))):
            self.fail("bad number of repetitions")
        self.at = end + 1
        return "{" + low + comma + high + "}"

    def group(self, lines: bool, lazy: bool) -> tuple[str, bool, bool]:
        """An opening group, and what line ends and plain repetitions mean behind it."""
        if self.peek() != "?":
            self.groups += 1
            return "(", lines, lazy
        self.take()
        if self.peek(2) == "P<" or (self.peek() == "<" and self.peek(2) not in ("<=", "<!")):
            self.upto("<")
            name = self.upto(">")
            if not name or not all(c == "_" or (c.isascii() and c.isalnum()) for c in name) or name in self.names:
                self.fail(f"bad name {name!r}")
            self.groups += 1
            self.names[name] = self.groups
            return "(", lines, lazy
        flags = ""
        while self.peek() and self.peek() not in ":)":
            flags += self.take()
        on, minus, off = flags.partition("-")
        if set(on + off) - set("imsU") or (minus and not off):
            self.fail(f"bad flags {flags!r}")
        now = lambda flag, old: True if flag in on else False if flag in off else old
        # Line ends and repetitions are rewritten here, so their flags are not passed on.
        plain = lambda x: x.replace("m", "").replace("U", "").replace("i", "iu")
        inner = plain(on) + ("-" + plain(off) if plain(off) else "")
        opened = "(?" + inner + ":" if self.take() == ":" else "(?" + inner + ")" if inner else ""
        return opened, now("m", lines), now("U", lazy)


def translate(pattern: str) -> Rule:
    """The pattern for the JVM; raises ``ValueError`` where the linear-time engine would refuse it."""
    r = _Reader(pattern)
    out: list[str] = ["(?d)"]
    stack: list[tuple[bool, bool]] = []
    lines = lazy = False
    can_repeat = False  # whether something stands here that can be repeated
    while r.peek():
        c = r.take()
        if c == "(":
            before = r.at
            opened, *now = r.group(lines, lazy)
            if not (r.text[before : before + 1] == "?" and r.text[r.at - 1] == ")"):
                stack.append((lines, lazy))
            lines, lazy = now
            out.append(opened)
            can_repeat = False
        elif c == ")":
            if not stack:
                r.fail("a group is closed that was not opened")
            lines, lazy = stack.pop()
            out.append(c)
            can_repeat = True
        elif c == "[":
            out.append(r.bracket())
            can_repeat = True
        elif c in "*+?" or c == "{":
            count = c if c != "{" else r.repeat()
            if not count:
                out.append(r"\{")
                can_repeat = True
                continue
            if not can_repeat:
                r.fail("nothing to repeat")
            turned = r.peek() == "?" and bool(r.take())
            out.append(count + ("?" if turned != lazy else ""))
            can_repeat = False
        elif c == "\\" and r.peek() == "Q":
            r.take()
            stop = r.text.find(r"\E", r.at)
            plain = r.text[r.at : stop] if stop >= 0 else r.text[r.at :]
            r.at = stop + 2 if stop >= 0 else len(r.text)
            out.append("".join("\\" + x if x.isascii() and not x.isalnum() else x for x in plain))
            can_repeat = bool(plain) or can_repeat
        elif c == "\\":
            out.append(r.escape(False))
            can_repeat = True
        elif c == "$":
            out.append(r"(?=\n|\z)" if lines else r"\z")
            can_repeat = True
        elif c == "^":
            out.append(r"(?<=\n|\A)" if lines else r"\A")
            can_repeat = True
        else:
            out.append("\\" + c if c in "}]#" else c)
            can_repeat = c != "|"
    if stack:
        r.fail("a group is not closed")
    return Rule("".join(out), r.groups, r.names)


def replacement(text: str, rule: Rule) -> str:
    """The replacement for the JVM: ``$name`` takes as many word characters as it can, unknown groups are empty."""
    out, at = [], 0
    while at < len(text):
        c = text[at]
        at += 1
        if c != "$":
            out.append("\\" + c if c in "\\$" or (c.isdigit() and out and out[-1].startswith("$")) else c)
            continue
        if text[at : at + 1] == "$":
            out.append("\\$")
            at += 1
            continue
        braced = text[at : at + 1] == "{"
        stop = start = at + braced
        while stop < len(text) and (text[stop] == "_" or text[stop].isalnum()):
            stop += 1
        name = text[start:stop]
        if not name or (braced and text[stop : stop + 1] != "}"):
            out.append("\\$")
            continue
        at = stop + braced
        number = int(name) if name.isascii() and name.isdigit() else rule.names.get(name, -1)
        if 0 <= number <= rule.groups:
            out.append(f"${number}")
    return "".join(out)
