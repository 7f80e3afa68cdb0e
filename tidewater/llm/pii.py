r"""Personal data in texts: patterns propose spans, checksums confirm, context adjusts.

Base spans, leftmost and non-overlapping for each kind:

* email, ip (parts at most 255), card (12 to 19 digits that pass Luhn), phone (a plus sign
  and 9 to 15 digits);

added by the method, each with a score that must reach ``threshold``:

* iban: mod-97 must leave 1; two letters, two digits, 11 to 30 more, as many as the country
  prescribes or, if it is not known, up to the end of a group; a card may lie inside;
* phone without a plus sign: 9 to 15 digits with separators that don't begin with a date, only
  near a word that names a telephone; ssn: three, two and four digits, only near a word that
  names it.

Of the whole words within 40 characters that speak for or against a kind the nearest one
counts, the one before on a tie: it adds 0.4 or takes 0.4 away.  Added spans don't overlap
each other, nor base ones, but for cards inside accounts.

Searches are linear in the text: each candidate run is looked at once, however long.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

# The base patterns
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]

IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
IBAN_HEAD = re.compile(r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2})")
# The lengths that countries prescribe
IBAN_LENGTH = {
    c[:2]: int(c[2:]) for c in (
        "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 "
        "FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 "
        "LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 "
        "SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
    ).split()
}
BARE_PHONE = re.compile(r"(?<![\w+.-])\(?[0-9]{2,5}\)?(?:[ ./-][0-9]{2,5}){1,5}(?![\w-])")
SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
# Words near a candidate that speak for a kind
CONTEXT = {
    "phone": re.compile(r"\b(?:phone|telephone|mobile|tel|fax|telefon|handy|rufnummer|teléfono|móvil|téléphone|portable)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|konto|cuenta|compte)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social security)\b", re.I),
}
# Words near a candidate that speak against it
AGAINST = {
    "phone": re.compile(r"\b(?:order|invoice|date|meeting|serial|tracking|version|bestellung|rechnung|datum|pedido|factura|fecha|commande|facture)\b", re.I),
    "iban": re.compile(r"\b(?:serial|tracking|checksum|sku)\b", re.I),
    "ssn": re.compile(r"\b(?:order|invoice|serial|tracking|sku)\b", re.I),
}
NEAR, LONGEST_WORD = 40, 20
DAY = re.compile(r"\(?(?:[12][0-9]{3}([-./ ])[0-9]{2}\1[0-9]{2}|[0-9]{2}([-./ ])[0-9]{2}\2[12][0-9]{3})(?![0-9])")

SPANS = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("end", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
)


class Span(NamedTuple):
    start: int
    order: int
    end: int
    score: float

    @property
    def kind(self) -> str:
        return KINDS[self.order]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(account: str) -> bool:
    moved = account[4:] + account[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _accounts(text: str) -> Iterator[tuple[int, int]]:
    """Spans that mod-97 confirms; after each head at most 34 letters and digits are looked at."""
    done = 0
    for head in IBAN_HEAD.finditer(text):
        if head.start() < done or not (m := IBAN.match(text, head.start())):
            continue
        start, long = m.start(), m[0]
        # where a group ends, the longest first
        ends = [i for i in range(len(long), 14, -1) if i == len(long) or long[i] == " "]
        prescribed = IBAN_LENGTH.get(long[:2])
        if prescribed:
            ends = [i for i in ends if len(long[:i].replace(" ", "")) == prescribed] + ends[:1]
        for i in ends:
            if len(account := long[:i].replace(" ", "")) >= 15 and mod97(account):
                done = start + i
                yield start, done
                break


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign the local part to its left and the domain to its right."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    found = [Span(a, 0, b, 1.0) for a, b in _emails(text)]
    if not any(c in text for c in "0123456789"):
        return sorted(found)
    for m in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append(Span(m.start(), 1, m.end(), 1.0))
    for m in CARD.finditer(text):
        # a longer run can't be a card, so its digits need not be counted
        if m.end() - m.start() <= 40 and 12 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(Span(m.start(), 2, m.end(), 1.0))
    for m in PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15:
            found.append(Span(m.start(), 3, m.end(), 1.0))
    return sorted(found)


def _nearest(words: re.Pattern, text: str, start: int, end: int) -> tuple[float, int]:
    """How far the nearest of the words is from a span, and on which side of it; words that
    begin or end outside of the window are seen whole."""
    best: tuple[float, int] = (float("inf"), 0)
    low, high = max(0, start - NEAR), end + NEAR
    for m in words.finditer(text, low, high + LONGEST_WORD):
        if m.start() >= high:
            break
        best = min(best, (start - m.end(), 0) if m.end() <= start else (max(0, m.start() - end), 1))
    return best


def added_spans(text: str, base: list[Span], threshold: float) -> list[Span]:
    """Candidates beyond the base patterns that checksum and context carry to the threshold."""
    out: list[Span] = []

    def taken(spans: list[Span]) -> tuple[list[int], list[int]]:
        ends: list[int] = []
        for s in spans:  # a span may lie inside an earlier one of another kind
            ends.append(max(s.end, ends[-1]) if ends else s.end)
        return [s.start for s in spans], ends

    def consider(kind: str, start: int, end: int, score: float, starts: list[int], ends: list[int]) -> None:
        speaks = _nearest(CONTEXT[kind], text, start, end), _nearest(AGAINST[kind], text, start, end)
        if speaks[0] != speaks[1]:
            score += 0.4 if speaks[0] < speaks[1] else -0.4
        i = bisect_right(starts, end - 1)
        if score >= threshold and (i == 0 or ends[i - 1] <= start):
            out.append(Span(start, KINDS.index(kind), end, min(1.0, score)))

    # digits of an account may happen to make a card; the account covers them
    but_cards = taken([s for s in base if s.kind != "card"])
    for start, end in _accounts(text):
        consider("iban", start, end, 0.8, *but_cards)
    known = taken(sorted(base + out))
    for m in SSN.finditer(text):
        consider("ssn", m.start(), m.end(), 0.4, *known)
    known = taken(sorted(base + out))
    for m in BARE_PHONE.finditer(text):
        if 9 <= len(_digits(m[0])) <= 15 and not DAY.match(m[0]):
            consider("phone", m.start(), m.end(), 0.4, *known)
    return out


def find(text: str | None, threshold: float = 0.7) -> list[Span]:
    """All spans, by start and kind; code points, end exclusive."""
    if not text:
        return []
    base = base_spans(text)
    if not any(c in text for c in "0123456789"):
        return base
    return sorted(base + added_spans(text, base, threshold))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str | None, spans: list[Span]) -> str | None:
    """Each span replaced by its kind; overlapping ones by that of the first."""
    if not spans:
        return text
    out, at = [], 0
    for s in spans:
        if s.start >= at:
            out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


def find_pii(docs: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """``doc_id, spans (array), base_spans (array), redacted`` for every row (doc_id, text).

    A null text has no spans and stays null; an empty one stays empty.  Rows are
    independent, repeated ones give equal results, a null id is kept.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("spans", SPANS),
            T.StructField("base_spans", SPANS),
            T.StructField("redacted", T.StringType()),
        ]
    )

    def row(s: Span) -> dict:
        return {"kind": s.kind, "start": s.start, "end": s.end, "score": s.score}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans = [find(t, threshold) for t in batch["text"]]
            base = [base_spans(t) if t else [] for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "spans": [[row(s) for s in found] for found in spans],
                    "base_spans": [[row(s) for s in found] for found in base],
                    "redacted": [redact(t, s) for t, s in zip(batch["text"], spans)],
                }
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, schema)


def redact_text(docs: DataFrame, *, threshold: float = 0.7) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all other columns untouched."""
    @F.pandas_udf("string")
    def redacted(texts: pd.Series) -> pd.Series:
        return pd.Series([redact(t, find(t, threshold)) for t in texts], dtype=object)

    return docs.withColumn("text", redacted("text"))


def _joined(spans: str) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of what ``find_pii`` returns."""
    def number(kind: str) -> Column:
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(number, BASE),
        F.sha2(_joined("base_spans").cast("binary"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
