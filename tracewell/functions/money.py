"""Printed amounts: number, sign, unit and currency of a text.

Plain Python functions, applied per Arrow batch.  Labels, headings and
currency names repeat, so each distinct one is read once per task (bounded
memory); only the amounts themselves are read row by row.
"""

from __future__ import annotations

import functools
import re
from decimal import ROUND_HALF_UP, Decimal

# Unit words (English, Sinhala, Tamil) and ten-thousandths of one currency unit that one of them is.
UNIT_WORDS = (
    (r"'?000'?s?|thousands?|k|දහස්?|දහසේ|ஆயிரம்|ஆயிரங்கள்", 10**7),
    (r"lakhs?|lacs?|ලක්ෂ(?:ය|යක්)?|(?:இ)?லட்சம்", 10**9),
    (r"millions?|mn\.?|mio\.?|mil\.?|m|මිලියන(?:ය)?|மில்லியன்", 10**10),
    (r"crores?|cr\.?|කෝටි(?:ය)?|கோடி", 10**11),
    (r"billions?|bn\.?|b|බිලියන(?:ය)?|பில்லியன்", 10**13),
    (r"cents?|ශත(?:ය)?|சதம்", 10**2),
)

# Currency words and their ISO codes.
CURRENCY_WORDS = (
    (r"us\s?\$|usd|us\s+dollars?|u\.s\.\s*dollars?|\$", "USD"),
    (r"eur|euros?|€", "EUR"),
    (r"gbp|pounds?\s+sterling|£", "GBP"),
    (r"lkr|slr|sri\s+lankan?\s+rupees?|rupees?|rs\.?|රුපියල්|රු\.?|ரூபாய்?|ரூ\.?", "LKR"),
)

# Blanks, minus signs and apostrophes that print alike.
ALIKE = str.maketrans({0xA0: " ", 0x202F: " ", 0x2009: " ", 0x2007: " ", 0x2212: "-", 0x2013: "-", 0x2014: "-", 0x2019: "'"})

UNIT_ONE = 10**4
# Distinct texts a task remembers.
MEMORY = 100_000

_MARKS = r"̀-ͯ஀-௿඀-෿"
_LEFT, _RIGHT = rf"(?<![^\W\d_])(?<![{_MARKS}])", rf"(?![^\W_]|[{_MARKS}])"
_UNIT = "|".join(p for p, _ in UNIT_WORDS)
_WORD_UNIT = _UNIT.removeprefix("'?000'?s?|")
_MONEY = "|".join(p for p, _ in CURRENCY_WORDS)
_NUMBER = r"\d(?:[\d.,' ]*\d)?"


@functools.cache
def _amount_pattern() -> re.Pattern:
    return re.compile(rf"(?P<c1>{_MONEY})?\s*(?P<u1>{_WORD_UNIT})?\s*(?P<minus>-?)\s*(?P<n>{_NUMBER})\s*(?P<u2>{_UNIT})?\s*(?P<c2>{_MONEY})?\s*(?P<u3>{_UNIT})?")


@functools.cache
def _searches() -> tuple[list, list]:
    # In running text a digit may stand before 000 only as part of a number.
    units = [(re.compile(_LEFT + (r"(?<![\d.,])" if i == 0 else "") + f"(?:{p})" + _RIGHT), v) for i, (p, v) in enumerate(UNIT_WORDS)]
    return units, [(re.compile(_LEFT + f"(?:{p})" + _RIGHT), v) for p, v in CURRENCY_WORDS]


@functools.cache
def _wholes() -> tuple[list, list]:
    return [(re.compile(p), v) for p, v in UNIT_WORDS], [(re.compile(p), v) for p, v in CURRENCY_WORDS]


def plain_text(text: str) -> str:
    """Lower case, one kind of blank and of minus, no outer blanks."""
    return " ".join(text.lower().translate(ALIKE).split())


@functools.lru_cache(MEMORY)
def stated(text: str | None) -> tuple[int | None, str | None]:
    """(ten-thousandths of a currency unit, ISO code) that a label or heading states; a bare currency means single units."""
    if not text:
        return None, None
    s = plain_text(text)
    units, currencies = _searches()
    unit = next((v for p, v in units if p.search(s)), None)
    code = next((v for p, v in currencies if p.search(s)), None)
    return (UNIT_ONE if unit is None and code else unit), code


@functools.lru_cache(MEMORY)
def stated_by_headings(text: str | None) -> tuple[int | None, str | None]:
    """The same of an evidence text; headings divided by `` | `` that differ in it mean unknown."""
    found = [stated(h) for h in (text or "").split(" | ")]
    units, codes = {u for u, _ in found} - {None}, {c for _, c in found} - {None}
    return (units.pop() if len(units) == 1 else None), (codes.pop() if len(codes) == 1 else None)


def plain_number(digits: str, decimals: int | None) -> Decimal | None:
    """A number in any separator style.

    Where both separators occur the last is the decimal one; a separator that
    repeats, or a comma before exactly three digits, groups; a lone point is a
    decimal point unless ``decimals`` is 0 and three digits follow.
    """
    d = digits.replace(" ", "").replace("'", "")
    dot, comma = d.rfind("."), d.rfind(",")
    if dot >= 0 and comma >= 0:
        d = d.replace(",", "") if dot > comma else d.replace(".", "").replace(",", ".")
    elif comma >= 0:
        d = d.replace(",", "") if d.count(",") > 1 or len(d) - comma == 4 else d.replace(",", ".")
    elif d.count(".") > 1 or (dot >= 0 and decimals == 0 and len(d) - dot == 4):
        d = d.replace(".", "")
    return Decimal(d) if d.count(".") <= 1 else None


@functools.lru_cache(MEMORY)
def _whole(word: str, kind: int):
    return next((v for p, v in _wholes()[kind] if p.fullmatch(word)), None)


def printed_amount(text: str | None, decimals: int | None = None) -> tuple[Decimal | None, int | None, str | None]:
    """(signed number, unit, currency) of a printed amount.

    All None for nil marks, words, note references, percentages and anything
    else that is not one number with at most a currency and a unit.
    Parentheses and a leading or trailing minus are negative.
    """
    if not text:
        return None, None, None
    s = plain_text(text)
    negative = False
    if s[:1] == "(" and s[-1:] == ")":
        s, negative = s[1:-1].strip(), True
    if s[:1] == "-":
        s, negative = s[1:].lstrip(), True
    elif s[-1:] == "-":
        s, negative = s[:-1].rstrip(), True
    if s.isdecimal() and s.isascii():
        number, unit, code = Decimal(s), None, None
    else:
        m = _amount_pattern().fullmatch(s)
        if not m:
            return None, None, None
        number = plain_number(m["n"], decimals)
        unit = next((_whole(m[g], 0) for g in ("u2", "u3", "u1") if m[g]), None)
        code = next((_whole(m[g], 1) for g in ("c1", "c2") if m[g]), None)
        negative = negative or m["minus"] == "-"
    if number is None:
        return None, None, None
    return (-number if negative else number), unit, code


def in_units_e4(number: Decimal | None, unit_e4: int | None) -> int | None:
    """Ten-thousandths of a currency unit, half up; None beyond 64 bits."""
    if number is None or unit_e4 is None:
        return None
    amount = int((number * unit_e4).to_integral_value(ROUND_HALF_UP))
    return amount if -(1 << 63) <= amount < 1 << 63 else None
