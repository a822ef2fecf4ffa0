"""Personal data found from anchors, whose surroundings small parsers expand.

One automaton runs over a text and reports anchors: at-signs, a plus before a
digit, digits around a dot, neighbouring digits, schemes, and cues that announce an
identifier. A parser for the anchor's kind walks from there to the boundaries and
validates what it has found. Every parser reads on from where the last span of its
kind ended, so that a text is read a few times at most, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from functools import cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: In the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "address", "account")
BASE = KINDS[:4]
PLACEHOLDER = {kind: f"<{kind.upper()}>" for kind in KINDS}

_DIGITS = "0123456789"
_SCHEMES = ("http://", "https://", "ftp://", "mailto:")
#: Cues of numbers and of secrets; matched in any case.
_NUMBERS = (
    "account", "acct", "iban", "passport", "ssn", "routing", "customer id", "user id",
)
_SECRETS = ("password", "passwd", "token", "api_key", "api-key", "api key", "apikey", "secret")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_URL = re.compile(r"[^\s<>\"']*+")
_USER = re.compile(r"[^\s/@<>\"']+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
_CUE = re.compile(r"(?i:customer id|user id|api[ -]key)|[A-Za-z]+(?:_[A-Za-z]+)*+")
_LINK = re.compile(
    r"([ _-]?(?:number|no|nr|id|key)\b\.?)?[ ]?([:=#])?[ ]?[\"']?", re.IGNORECASE
)
# Groups that follow a space are short, and in capitals or with a digit.
_VALUE = re.compile(
    r"[A-Za-z0-9](?:[A-Za-z0-9_-]|[ ](?=[0-9A-Z]{2,4}\b|[A-Za-z]{0,3}[0-9][0-9A-Za-z]{0,3}\b))*+"
)
_IBAN = re.compile(r"[A-Z][ _-]?[A-Z][ _-]?[0-9][ _-]?[0-9]")
_SECRET = re.compile(r"[^\s\"'<>]++")
_LOWER = {i: i + 32 for i in range(65, 91)}
_ACCESS_KEY = re.compile(r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])")


@cache
def anchors() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    keys = {"@": "email", "akia": "key"}
    keys |= {f"+{d}": "phone" for d in _DIGITS}
    keys |= {f"{a}.{b}": "ip" for a in _DIGITS for b in _DIGITS}
    keys |= {f"{a}{s}{b}": "card" for a in _DIGITS for s in ("", " ", "-") for b in _DIGITS}
    keys |= {s: "address" for s in _SCHEMES}
    keys |= {c: "account" for c in _NUMBERS} | {c: "secret" for c in _SECRETS}
    for key, kind in keys.items():
        found.add_word(key, (kind, len(key)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def iban(value: str) -> bool:
    """Whether the value's shape is an IBAN's and its check digits hold."""
    if not re.fullmatch(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}", value):
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def _email(text, at, after):
    start = at
    while start > after and text[start - 1] in _LOCAL:
        start -= 1
    host = _DOMAIN.match(text, at + 1) if start < at else None
    return (start, host.end(), True) if host else None


def _ip(text, at, after):
    while at > after and text[at - 1] in _DIGITS:
        at -= 1
    m = _IP.match(text, at)
    return m and (at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")))


def _card(text, at, after):
    m = _CARD.match(text, at)
    if not m:
        return None
    if len(m[0]) > 37:  # more than 19 digits, however they are set apart
        return at, m.end(), False
    digits = m[0].replace(" ", "").replace("-", "")
    return at, m.end(), 14 <= len(digits) <= 19 and luhn(digits)


def _phone(text, at, after):
    m = _PHONE.match(text, at)
    return m and (at, m.end(), 10 <= sum(c in _DIGITS for c in m[0]) <= 15)


def _address(text, at, after):
    """A mailto: address, or an address that names its user."""
    colon = text.index(":", at)
    if text[at:colon].lower() == "mailto":
        m = _USER.match(text, colon + 1)
        return m and (at, m.end(), True)
    whole = _URL.match(text, colon + 3)
    end = len(text[: whole.end()].rstrip(".,;:!?)]}")) if whole.end() > colon + 3 else colon + 3
    return at, end, bool(_USER.match(text, colon + 3, end))


class _Runs:
    """The last run of value characters that was read, so that none is read twice.

    A run's digits are known by their last places: so many of them follow a place.
    """

    def __init__(self, pattern: re.Pattern):
        self.pattern, self.start, self.end = pattern, 0, 0
        self.digits: list[int] = []
        self.letter = -1

    def at(self, text: str, start: int) -> bool:
        """Whether a run holds the place; then this is the run that is known."""
        if self.start <= start < self.end:
            return True
        m = self.pattern.match(text, start)
        if not m:
            return False
        self.start, self.end, self.digits, self.letter = start, m.end(), [], -1
        for i in range(m.end() - 1, start - 1, -1):
            if text[i] in _DIGITS and len(self.digits) < 6:
                self.digits.append(i)
            elif self.letter < 0 and text[i].isalpha():
                self.letter = i
            if len(self.digits) == 6 and self.letter >= 0:
                break
        return True

    def has_digits(self, start: int, n: int) -> bool:
        return len(self.digits) >= n and self.digits[n - 1] >= start


def _iban_end(text: str, start: int, end: int) -> int | None:
    """Where an IBAN ends whose groups begin at the start; short words may follow it."""
    if not _IBAN.match(text, start):
        return None
    value = text[start : min(end, start + 70)]  # 34 characters and what sets them apart
    cuts = [i for i, c in enumerate(value) if c == " "] + [len(value)] * (start + len(value) == end)
    for cut in reversed(cuts):
        if iban(re.sub(r"[ _-]", "", value[:cut])):
            return start + len(value[:cut].rstrip(" _-"))
    return None


def _account(text, at, runs):
    """What follows a cue: an IBAN; after a sign or "number" a value with four digits; or
    a value that begins with a digit and has six.

    Where nothing valid follows, reading goes on behind the cue, since the words after
    it may hold the next one. A value is as long as it is.
    """
    if at and text[at - 1].isalnum():
        return None
    cue = _CUE.match(text, at).end()
    link = _LINK.match(text, cue)
    start = link.end()
    if not runs.at(text, start):
        return at, cue, False
    end = runs.end
    while text[end - 1] in " _-":
        end -= 1
    announced = link[1] is not None or link[2] is not None
    if not (announced and end - start >= 4 and runs.has_digits(start, 4)) and not (
        text[start] in _DIGITS and runs.has_digits(start, 6)
    ):
        end = _iban_end(text, start, end)
    return (at, cue, False) if end is None else (start, end, True)


def _secret(text, at, runs):
    """What follows a secret's cue and a sign: six characters or more without white space,
    a letter and a digit among them; or after a sign or "id" four digits or more."""
    if at and text[at - 1].isalnum():
        return None
    cue = _CUE.match(text, at).end()
    link = _LINK.match(text, cue)
    start = link.end()
    if (link[1] is None and link[2] is None) or not runs.at(text, start):
        return at, cue, False
    end = runs.end
    while text[end - 1] in ".,;:!?)]}":
        end -= 1
        if end == start:
            return at, cue, False
    mixed = link[2] is not None and end - start >= 6 and runs.has_digits(start, 1) and runs.letter >= start
    return (start, end, True) if mixed or runs.has_digits(start, 4) else (at, cue, False)


def _key(text, at, after):
    m = _ACCESS_KEY.match(text, at)
    return m and (at, m.end(), not (at and text[at - 1].isalnum()))


_PARSERS = {
    "email": _email, "ip": _ip, "card": _card, "phone": _phone,
    "address": _address, "account": _account, "secret": _secret, "key": _key,
}


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind; code points, the end exclusive."""
    if not text:
        return []
    after = dict.fromkeys(_PARSERS, 0)
    runs = {"account": _Runs(_VALUE), "secret": _Runs(_SECRET)}
    found = []
    for last, (kind, length) in anchors().iter(text.translate(_LOWER)):
        at = last - length + 1
        if at < after[kind]:
            continue
        # A kind's next match begins where its last one ended, valid or not; behind a
        # cue without a valid value.
        if hit := _PARSERS[kind](text, at, runs.get(kind, after[kind])):
            start, end, valid = hit
            after[kind] = end
            if valid:
                found.append(("account" if kind in ("key", "secret") else kind, start, end))
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping ones by the first's."""
    out, at = [], 0
    for kind, start, end in found:
        if start >= at:
            out += [text[at:start], PLACEHOLDER[kind]]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _digest(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        found = spans(text)
        base = [s for s in found if s[0] in BASE]
        rows.append(
            [sum(s[0] == kind for s in base) for kind in BASE]
            + [hashlib.sha256(joined(base).encode()).hexdigest(), joined(found)]
        )
    names = [f"n_{k}" for k in BASE] + ["base_sha256", "spans"]
    return pd.DataFrame(rows, columns=names).astype({f"n_{k}": "int64" for k in BASE})


def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: t and redacted(t, spans(t)))


def found_in(documents: DataFrame, text: str = "text") -> DataFrame:
    """Adds struct column `pii`: counts of the base kinds, their digest, all spans.

    Null or empty text: nothing found. The columns of the input stay; one that is
    named pii is replaced.
    """
    schema = ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string"
    return documents.withColumn("pii", F.pandas_udf(_digest, schema)(text))


def without(documents: DataFrame, text: str = "text") -> DataFrame:
    """The documents with personal data replaced by placeholders; null stays null."""
    return documents.withColumn(text, F.pandas_udf(_redacted, "string")(text))


def op3_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return found_in(documents).select("doc_id", "pii.*")


