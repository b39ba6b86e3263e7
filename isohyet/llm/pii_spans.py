"""Personal data by pattern: emails, IPv4 addresses, card numbers and phone numbers, in linear time."""

from __future__ import annotations

import re

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A match can only begin where a run of digits begins, so no other place is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")


def digits_of(text: str) -> str:
    return _DIGITS.sub("", text)


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards: the run of local characters before it, and the domain behind it."""
    out, at, end = [], text.find("@"), 0
    while at >= 0:
        low = at
        while low > end and text[low - 1] in _LOCAL:
            low -= 1
        found = _DOMAIN.match(text, at + 1) if low < at else None
        # Characters before this @ can't belong to a later address: it is no local character.
        end = found.end() if found else at + 1
        if found:
            out.append((low, end))
        at = text.find("@", end)
    return out


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _CARD.finditer(text):
        if 16 <= len(m.group()) <= 37 and 16 <= len(digits := digits_of(m.group())) <= 19 and passes_luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by kind as listed, then start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *s) for s in ips(text)]
    out += [("card", *s) for s in cards(text)]
    return out + [("phone", *s) for s in phones(text)] if "+" in text else out


def entity(kind: str, text: str) -> str:
    """What a span stands for, however it is written."""
    return f"{kind}:{digits_of(text) if kind in ('card', 'phone') else text.lower()}"
