"""Personal data: patterns propose spans, checksums confirm them, context words score them.

Base kinds (email, ip, card, phone) are decided by their pattern and validator alone and
always stay. The method adds kinds that need more evidence: ``iban`` (country code and
mod-97), and ``ssn`` and ``local_phone``, whose patterns are weak and which count only
where a context word stands nearby. Every span carries a score: 0.5 for the pattern, +0.3
for a passed checksum, +0.2 for a context word within CONTEXT characters before it or
CONTEXT after; added kinds below THRESHOLD are dropped.

An account number may be followed by capitals or digits that its pattern takes in too. Every
end at a word border is checked: the one at the country's length if it passes, otherwise
the longest that does; the search goes on behind it, or behind a start that has none.

Every pattern is scanned in linear time: no start inside a run that was already tried, so
long runs of digits or letters cost no more than other text.

Offsets are code points, ends exclusive. Defined results: a null text is empty and has no
spans; repeated rows each get the same spans; null ids stay null; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemoi.llm.common import ship, table

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn", "local_phone")
CONTEXT = 40
THRESHOLD = 0.7

CONTEXT_WORDS = {
    "email": ("email", "e-mail", "mail", "contact", "correo", "courriel"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "telefon", "teléfono", "téléphone"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social security", "taxpayer"),
    "local_phone": ("phone", "tel", "call", "mobile", "telefon", "teléfono", "téléphone"),
}
_CONTEXT = {k: re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, v)) + r")(?!\w)", re.I)
            for k, v in CONTEXT_WORDS.items()}

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
# lengths by country; other countries and lengths are decided by the checksum alone
IBAN_LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.()-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 7064 check of an account number without spaces."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping e-mail addresses: for each ``@domain`` the longest local part before it."""
    end = 0
    for m in _AT.finditer(text):
        at = start = m.start()
        while start > end and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        if start < at:
            end = m.end()
            yield start, end


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping account numbers that pass mod-97, ended at a word border."""
    at = 0
    while m := _IBAN.search(text, at):
        ends = [len(m[0])] + [i for i in range(len(m[0]) - 1, 0, -1) if m[0][i] == " "]
        passed = {}
        for end in ends:
            number = m[0][:end].replace(" ", "")
            if 15 <= len(number) <= 34 and mod97(number):
                passed[len(number)] = end
        if passed:
            at = m.start() + passed.get(IBAN_LENGTHS.get(m[0][:2]), max(passed.values()))
            yield m.start(), at
        else:
            at = m.start() + 4


def _ssn_ok(s: str) -> bool:
    a, b, c = s.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def _context(kind: str, text: str, start: int, end: int) -> bool:
    near = text[max(0, start - CONTEXT):start] + "\n" + text[end:end + CONTEXT]
    return _CONTEXT[kind].search(near) is not None


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) of every span, by start and then kind."""
    if not text:
        return []
    found: list[tuple[str, int, int, bool]] = []   # kind, start, end, checksum passed
    if "@" in text:
        found += [("email", a, b, False) for a, b in _emails(text)]
    if re.search("[0-9]", text):
        if "." in text:
            found += [("ip", *m.span(), False) for m in _IP.finditer(text)
                      if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split("."))]
        for m in _CARD.finditer(text):
            # too long a run is no card; 14 digits take 14 to 27 characters
            if 14 <= m.end() - m.start() <= 37 and 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
                found.append(("card", *m.span(), True))
        if "+" in text:
            found += [("phone", *m.span(), False) for m in _PHONE.finditer(text)
                      if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
        found += [("iban", a, b, True) for a, b in _ibans(text)]
        found += [("ssn", *m.span(), False) for m in _SSN.finditer(text) if _ssn_ok(m[0])]
        found += [("local_phone", *m.span(), False) for m in _LOCAL_PHONE.finditer(text)]
    base = [(a, b) for k, a, b, _ in found if k in BASE_KINDS]
    out = []
    for kind, a, b, checked in found:
        score = 0.5 + 0.3 * checked + 0.2 * _context(kind, text, a, b)
        if kind in BASE_KINDS:
            out.append((kind, a, b, score))
        # an added span says something new: it overlaps no base span
        elif score >= THRESHOLD and not any(x < b and a < y for x, y in base):
            out.append((kind, a, b, score))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def redacted(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets (overlaps: the first wins)."""
    if text is None:
        return None
    out, end = [], 0
    for kind, a, b, _ in find(text):
        if a >= end:
            out += [text[end:a], f"[{kind}]"]
            end = b
    return "".join(out) + text[end:]


SPAN = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``spans`` (array of kind, start, end, score), one row per document."""
    ship(docs.sparkSession)

    @F.pandas_udf(SPAN)
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in find(t)] for t in texts])

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All columns of ``docs``, spans in the text replaced by their kind."""
    ship(docs.sparkSession)

    @F.pandas_udf("string")
    def hidden(texts: pd.Series) -> pd.Series:
        return pd.Series([redacted(t) for t in texts], dtype=object)

    return docs.withColumn(text_col, hidden(F.col(text_col)))


def op1_pii(spark, sf_dir):
    found = spans(table(spark, sf_dir, "documents"))
    joined = lambda s: F.array_join(F.transform(s, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    of = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", *[of(k).alias(f"n_{k}") for k in BASE_KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
