"""Personal data: format-preserving pseudonyms by a keyed Feistel network.

A value that is found and validated is read as a number in mixed radix, one digit for each
character that carries data, and that number is permuted among all values of the same
format. Marks between the characters stay. Equal values thus have equal pseudonyms in all
documents, different values have different ones, and who holds the key can undo them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.words import slices

ROUNDS = 10

DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HEX = "0123456789abcdef"
# A number of a North American area or exchange does not begin with 0 or 1.
AREA = "23456789"

# Names of the months; three letters are the short ones.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September",
          "October", "November", "December")

FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of the numbers below any size, of its own for each ``format``."""

    key: bytes
    rounds: int = ROUNDS

    def _noise(self, name: str, turn: int, value: int) -> int:
        data = f"{name}\0{turn}\0{value}".encode()
        return int.from_bytes(hashlib.blake2b(data, key=self.key, digest_size=32).digest(), "big")

    def _turns(self, name: str, value: int, left: int, right: int, back: bool) -> int:
        """All rounds on ``value`` below left * right: each half is moved by noise of the other."""
        high, low = divmod(value, right)
        sign = -1 if back else 1
        for turn in (reversed(range(self.rounds)) if back else range(self.rounds)):
            if turn % 2:
                low = (low + sign * self._noise(name, turn, high)) % right
            else:
                high = (high + sign * self._noise(name, turn, low)) % left
        return high * right + low

    def permuted(self, value: int, size: int, name: str, back: bool = False) -> int:
        """Where the permutation of the numbers below ``size`` takes ``value``."""
        if size < 2:
            return value
        left = 1
        while left * left < size:
            left += max(1, (size // max(left, 1) - left) // 2)
        right = -(-size // left)
        name = f"{name}/{size}"
        # Numbers that fall behind ``size`` are permuted again until one falls below it.
        value = self._turns(name, value, left, right, back)
        while value >= size:
            value = self._turns(name, value, left, right, back)
        return value

    def characters(self, text: str, alphabets: Sequence[str], name: str,
                   back: bool = False) -> str:
        """``text`` permuted among the texts with a character of each alphabet in turn."""
        value, size = 0, 1
        for char, alphabet in zip(text, alphabets):
            value = value * len(alphabet) + alphabet.index(char)
            size *= len(alphabet)
        value = self.permuted(value, size, f"{name}/{'/'.join(alphabets)}", back)
        out = []
        for alphabet in reversed(alphabets):
            value, digit = divmod(value, len(alphabet))
            out.append(alphabet[digit])
        return "".join(reversed(out))


def _alphabet(char: str) -> str:
    return next((a for a in (DIGITS, LOWER, UPPER) if char in a), "")


def _data(text: str, back: bool, feistel: Feistel, name: str,
          alphabet: Callable[[str], str] = _alphabet) -> str:
    """``text`` with its letters and digits permuted; all other characters stay."""
    at = [k for k, char in enumerate(text) if alphabet(char)]
    new = feistel.characters("".join(text[k] for k in at), [alphabet(text[k]) for k in at],
                             name, back)
    out = list(text)
    for k, char in zip(at, new):
        out[k] = char
    return "".join(out)


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` with it a valid card number."""
    total = 0
    for k, digit in enumerate(reversed(digits)):
        doubled = int(digit) * (2 if k % 2 == 0 else 1)
        total += doubled - 9 if doubled > 9 else doubled
    return str(-total % 10)


def _put(pattern: str, digits: str) -> str:
    """The digits of ``pattern`` replaced in turn by ``digits``."""
    new = iter(digits)
    return "".join(next(new) if char in DIGITS else char for char in pattern)


def _email(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    local, _, host = found.group().rpartition("@")
    if not any(map(_alphabet, local)):
        return None
    # The name is tied to its host: the same name at two hosts has two pseudonyms.
    return f"{_data(local, back, feistel, f'email/{host.lower()}')}@{host}"


def _card(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    digits = re.sub("[ -]", "", found.group())
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[0] + feistel.characters(digits[1:-1], [DIGITS] * (len(digits) - 2), "card", back)
    return _put(found.group(), body + luhn_digit(body))


def _phone(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    country, number = found["country"] or "", found.group()[len(found["country"] or ""):]
    digits = re.sub(r"\D", "", number)
    alphabets = [AREA if k in (0, 3) and len(digits) == 10 and digits[k] in AREA else DIGITS
                 for k in range(len(digits))]
    return country + _put(number, feistel.characters(digits, alphabets, "phone", back))


def _social(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    area, group, serial = found.group().split("-")
    valid = area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"
    if not valid:
        return None
    # 898 areas, 99 groups and 9999 serial numbers are valid.
    place = int(area) - 1 - (area > "666")
    value = (place * 99 + int(group) - 1) * 9999 + int(serial) - 1
    value, serial_place = divmod(feistel.permuted(value, 898 * 99 * 9999, "social", back), 9999)
    place, group_place = divmod(value, 99)
    return f"{place + 1 + (place >= 665):03}-{group_place + 1:02}-{serial_place + 1:04}"


def _address(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    parts = found.group().split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, feistel.permuted(value, 1 << 32, "address", back).to_bytes(4, "big")))


def _alike(text: str, other: str, value: int) -> bool:
    """Whether ``value`` is written with as many digits as ``text``, beside ``other``."""
    if len(text) == 1:
        return value <= 9
    return len(other) == 2 or (value >= 10) == (int(text) >= 10)


def _date(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    first, mark, second, last = found["a"], found["mark"], found["b"], found["c"]
    year_first = len(first) == 4
    if year_first == (len(last) == 4):
        return None
    if year_first:
        orders = [(first, second, last)]
    else:  # day first, or month first where only that is a date
        orders = [(last, second, first), (last, first, second)]
    for form, order in enumerate(orders):
        try:
            day = date(*map(int, order)).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # 12 days of a month can be read both ways, so dates keep to their kind.
        unclear = not year_first and int(first) <= 12 and int(second) <= 12
        new = day
        while True:
            new = FIRST_DAY + feistel.permuted(
                new - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, f"date/{form}", back)
            value = date.fromordinal(new)
            one, two = (second, last) if year_first else (first, second)
            both = (value.day, value.month) if form == 0 and not year_first else (
                value.month, value.day)
            if (year_first or (value.day <= 12) == unclear) and _alike(one, two, both[0]) and _alike(
                    two, one, both[1]):
                break
        year, parts = f"{value.year:04}", [f"{v:0{len(t)}}" for v, t in zip(both, (one, two))]
        return mark.join([year, *parts] if year_first else [*parts, year])
    return None


def _ordinal(day: int) -> str:
    return "th" if 11 <= day <= 13 else {1: "st", 2: "nd", 3: "rd"}.get(day % 10, "th")


def _named_date(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    name, at, suffix = found["month"], found["day"], found["suffix"]
    case = next((c for c in (str.title, str.upper, str.lower) if c(name) == name), None)
    # May is a whole name; so short names stay among the other months.
    whole = name.title() in MONTHS
    months = [m if whole else m[:3] for m in MONTHS]
    try:
        day = date(int(found["year"]), months.index(name.title()) + 1, int(at)).toordinal()
    except ValueError:
        return None
    if case is None or not FIRST_DAY <= day <= LAST_DAY or suffix not in (None, _ordinal(int(at))):
        return None
    new = day
    while True:
        new = FIRST_DAY + feistel.permuted(
            new - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date/named", back)
        value = date.fromordinal(new)
        if _alike(at, "", value.day) and (whole or value.month != 5):
            break
    out, done = [], 0
    for group, text in sorted((
            ("month", case(months[value.month - 1])), ("day", f"{value.day:0{len(at)}}"),
            ("suffix", suffix and _ordinal(value.day)), ("year", f"{value.year:04}")),
            key=lambda part: found.start(part[0])):
        if found[group] is not None:
            out += (found.group()[done:found.start(group) - found.start()], text)
            done = found.end(group) - found.start()
    return "".join(out)


def _account(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    compact = found.group().replace(" ", "")
    body = compact[4:]
    if _remainder(body + compact[:4]) != 1:
        return None
    body = feistel.characters(body, [_alphabet(c) for c in body], "account", back)
    check = 98 - _remainder(body + compact[:2] + "00")
    new = iter(f"{compact[:2]}{check:02}{body}")
    return "".join(" " if char == " " else next(new) for char in found.group())


def _remainder(text: str) -> int:
    return int("".join(str(int(char, 36)) for char in text)) % 97


def _access_key(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    key = found.group()
    return key[:4] + feistel.characters(key[4:], [UPPER + DIGITS] * (len(key) - 4), "access", back)


def _secret(found: re.Match, feistel: Feistel, back: bool) -> str | None:
    value = found["value"]
    if all(char in HEX for char in value):
        new = feistel.characters(value, [HEX] * len(value), "hex", back)
    elif any(map(_alphabet, value)):
        new = _data(value, back, feistel, "secret")
    else:
        return None
    before = found.start("value") - found.start()
    return found.group()[:before] + new + found.group()[before + len(value):]


@dataclass(frozen=True)
class Kind:
    """A kind of data: where it may stand, and its pseudonym (None: not valid, so it stays).

    A text without any of ``signs`` is not searched.
    """

    name: str
    pattern: re.Pattern
    pseudonym: Callable[[re.Match, Feistel, bool], str | None]
    signs: tuple[str, ...] = ()


# The first character comes before the look at what precedes it, so that a search can leap
# from one such character to the next.
_FIRST, _AFTER = r"[0-9](?<![\w.+-].)", r"(?![\w-]|\.\w)"
# A month's name after its first letter.
_NAME = "|".join(f"(?i:{m[1:]}|{m[1:3]})" for m in MONTHS)
_CARD = (r"(?:[0-9]{12,18}|[0-9]{3}(?:[ -][0-9]{4}){2,3}(?:[ -][0-9]{1,4})?"
         r"|[0-9]{3}[ -][0-9]{6}[ -][0-9]{5})")

KINDS = (
    Kind("email", re.compile(
        r"(?<![\w.%+-])[\w.%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
        _email, ("@",)),
    Kind("access_key", re.compile(r"A(?<!\w.)(?:KIA|SIA)[A-Z0-9]{16}\b"), _access_key,
         ("AKIA", "ASIA")),
    Kind("secret", re.compile(
        r"(?i:password|passwd|pwd|secret|token|api[_-]?key)['\"]?[ \t]*[:=][ \t]*['\"]?"
        r"(?P<value>[^\s'\",;]{6,})"), _secret, ("=", ":")),
    Kind("hex_secret", re.compile(r"[\"'](?P<value>[0-9a-f]{32,64})(?=[\"'])"), _secret, ('"', "'")),
    Kind("account", re.compile(
        r"[A-Z](?<!\w.)[A-Z][0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"), _account),
    Kind("address", re.compile(_FIRST + r"[0-9]{0,2}(?:\.[0-9]{1,3}){3}" + _AFTER), _address),
    Kind("date", re.compile(
        r"(?P<a>" + _FIRST + r"(?:[0-9]{3}|[0-9]?))(?P<mark>[-/.])(?P<b>[0-9]{1,2})(?P=mark)"
        r"(?P<c>[0-9]{4}|[0-9]{1,2})" + _AFTER), _date),
    Kind("date", re.compile(
        rf"(?P<month>[JFMASONDjfmasond](?<!\w.)(?:{_NAME}))\.? (?P<day>[0-9]{{1,2}})"
        r"(?P<suffix>st|nd|rd|th)?,? (?P<year>[0-9]{4})" + _AFTER), _named_date),
    Kind("date", re.compile(
        rf"(?P<day>{_FIRST}[0-9]?)(?P<suffix>st|nd|rd|th)?(?: of)?[ -]"
        rf"(?P<month>[JFMASONDjfmasond](?:{_NAME}))(?:\.,?|,)?[ -](?P<year>[0-9]{{4}})" + _AFTER),
        _named_date),
    Kind("social", re.compile(_FIRST + r"[0-9]{2}-[0-9]{2}-[0-9]{4}" + _AFTER), _social),
    Kind("card", re.compile(_FIRST + _CARD + _AFTER), _card),
    Kind("phone", re.compile(
        r"(?P<country>\+(?<![\w.+(-].)[0-9]{1,3}[ .-]?)"
        r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}" + _AFTER), _phone),
    Kind("phone", re.compile(
        r"(?P<country>)[(0-9](?<![\w.+(-].)(?:(?<=\()[0-9]{3}\) ?|(?<=[0-9])[0-9]{2}[ .-])"
        r"[0-9]{3}[ .-][0-9]{4}" + _AFTER), _phone),
    Kind("phone", re.compile(
        r"(?P<country>\+(?<![\w.+(-].)[0-9]{1,3}[ .-]?)(?:\(?[0-9]{1,4}\)?[ .-]?){2,4}[0-9]"
        + _AFTER), _phone),
)

_DIGIT = re.compile("[0-9]")


class Pseudonymizer:
    """Replaces the personal data in texts."""

    def __init__(self, key: bytes, back: bool = False) -> None:
        self.feistel, self.back = Feistel(key), back

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(first, end, kind, pseudonym) of all data in ``text``, in order, without overlaps.

        Where two kinds claim the same characters, the kind named first in KINDS has them.
        """
        digits = bool(_DIGIT.search(text))
        taken: list[tuple[int, int, str, str]] = []
        for kind in KINDS:
            if kind.signs and not any(sign in text for sign in kind.signs):
                continue
            if not kind.signs and not digits:
                continue
            # Both are in order, so one pass merges them.
            merged, at = [], 0
            for found in kind.pattern.finditer(text):
                first, end = found.span()
                while at < len(taken) and taken[at][1] <= first:
                    merged.append(taken[at])
                    at += 1
                if at < len(taken) and taken[at][0] < end:
                    continue
                new = kind.pseudonym(found, self.feistel, self.back)
                if new is not None:
                    merged.append((first, end, kind.name, new))
            taken = merged + taken[at:]
        return taken

    def __call__(self, text: str) -> tuple[str, dict[str, int]]:
        """``text`` with pseudonyms, and how many of each kind."""
        counts: dict[str, int] = {}
        out, done = [], 0
        for first, end, name, new in self.spans(text):
            out += (text[done:first], new)
            done = end
            counts[name] = counts.get(name, 0) + 1
        return ("".join(out) + text[done:] if out else text), counts


NAMES = tuple(dict.fromkeys(kind.name for kind in KINDS))

SCHEMA = "doc_id long, text string, n_found long, kinds map<string,long>"


def pseudonyms(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """(doc_id, text, n_found, kinds): each row's text with its personal data permuted.

    ``kinds`` counts what was found by its kind. With ``back`` the permutation is undone: what
    it returns for its own result is the text before. Null texts stay null, and texts
    without such data stay as they are, to the byte. Nothing is shuffled or gathered; each row
    gives one row, repeated rows alike; a null doc_id stays null; columns other than doc_id and
    text are not read; an empty table gives no rows.
    """

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = Pseudonymizer(key, back)
        for batch in batches:
            for rows, _ in slices(batch, "text"):
                new = [("", {}) if text is None else replace(text)
                       for text in rows.column("text").to_pylist()]
                texts = pa.array([n[0] for n in new], pa.string(),
                                 mask=rows.column("text").is_null().to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([
                    rows.column("doc_id").cast(pa.int64()), texts,
                    pa.array([sum(n[1].values()) for n in new], pa.int64()),
                    pa.array([list(n[1].items()) for n in new], pa.map_(pa.string(), pa.int64()))],
                    names=["doc_id", "text", "n_found", "kinds"])

    return docs.select("doc_id", "text").mapInArrow(replaced, SCHEMA)


def with_pseudonyms(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` with the texts of :func:`pseudonyms` and all other columns as they are."""

    def replaced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replace = Pseudonymizer(key)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            for rows, _ in slices(batch, "text"):
                texts = pa.array([text if text is None else replace(text)[0]
                                  for text in rows.column("text").to_pylist()], pa.string())
                yield rows.set_column(at, rows.schema.field("text").with_type(pa.string()), texts)

    return docs.mapInArrow(replaced, docs.schema)
