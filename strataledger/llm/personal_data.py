"""Personal data by candidate generation and gradient boosting.

Generators with high recall propose spans of four kinds, which may overlap: everything that looks like an e-mail
address (also with spelled-out signs), an internet address, a card number or a phone number. Of a run of digit groups
every part of at most ``MOST_GROUPS`` groups that has as many digits as a card or phone is proposed, so
numbers beside each other are found too. All searches take time in proportion to the text. Boosted trees judge
each candidate by its format and its context; each kind has a threshold, calibrated to a stated precision on examples the trees
have not seen. Accepted candidates are added to the spans of four strict rules, which always stay; of
overlapping additions the more probable one is taken, and none overlaps a strict span.

There are no labelled spans to learn from. The training examples are made: values and look-alikes (dates, versions, prices, order
numbers, keys) in many formats are set into runs of words from a bounded sample of the documents
(about ``CARRIERS`` whole texts), so the contexts are those of the corpus.

Offsets count code points. Defined results: null is empty text; texts without digits, signs or spelled-out signs have no spans.
Every row gets a result, repeated rows repeatedly. An empty table gives no rows; the trees then learn
from the examples alone.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataledger.llm.boosted_trees import Trees, threshold_for, train
from strataledger.llm.common import blocks, record_batch

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.98
CARRIERS = 200
EXAMPLES = 6000
# Digit groups of one number as people write it.
MOST_GROUPS = 8
# Candidates that are described at once, and judged candidates that a task remembers by their surroundings.
JUDGED = 4096
REMEMBERED = 100_000

# The strict rules' patterns, by kind.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
# The same matches without looking at a character again and again: an address can only begin where a run of
# digits does, and the part of a mail address before its @ is all that stands there.
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ADDRESS_SIGNS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-@")

# Candidate generators.
SOFT_AT = r"\s?(?:@|\[at\]|\(at\)|\{at\}|<at>)\s?|\s+at\s+"
SOFT_DOT = r"\s?(?:\.|\[dot\]|\(dot\)|\{dot\}|<dot>)\s?|\s+dot\s+"
SPELLED = re.compile(
    rf"(?<![A-Za-z0-9_%+-])[A-Za-z0-9_%+-]{{1,64}}(?:(?:{SOFT_DOT})[A-Za-z0-9_%+-]{{1,64}}){{0,4}}"
    rf"(?:{SOFT_AT})[A-Za-z0-9-]{{1,64}}(?:(?:{SOFT_DOT})[A-Za-z0-9-]{{1,64}}){{1,6}}",
    re.I,
)
SPELLED_HINT = re.compile(r"[\[({<]at[\])}>]|[\[({<]dot[\])}>]|\sdot\s|\s@|@\s|\sat\s+[a-z0-9-]{1,64}\.[a-z0-9]", re.I)
DIGIT = re.compile(r"[0-9]")
RUN = re.compile(r"[+(]{0,2}[0-9](?:[ ().\-/]{0,2}[0-9])+")
PLAIN = re.compile(r"[0-9]+")
PHONE_DIGITS = range(7, 16)
CARD_DIGITS = range(12, 21)
LOOSE_IP = re.compile(r"[0-9]{1,3}(?:\s?(?:\.|\[\.\]|\(\.\))\s?[0-9]{1,3}){3}")

# Words before a value that tell its kind, as the features see them.
HINTS = {
    "email": ("mail", "email", "e-mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "login", "from", "address"),
    "card": ("card", "visa", "credit", "payment", "mastercard", "amex", "account"),
    "phone": ("tel", "phone", "call", "mobile", "fax", "cell", "whatsapp"),
    "other": ("order", "id", "no", "version", "isbn", "token", "key", "date", "page", "sku", "ref", "invoice", "price", "license", "v"),
}

# Words before " at " that are no mailbox.
COMMON_BEFORE_AT = frozenset(
    "look looked looking available found hosted us me it is are be was meet met live lives sold here him her them more information"
    " documentation online directly visit stay work works posted based site website page sign up start read also and or code data".split()
)
# Sizes of the digit groups that phone numbers are written in.
PHONE_GROUPS = ([3, 3, 4], [1, 3, 3, 4], [2, 3, 3, 4], [3, 3, 3, 4], [4, 3, 3, 4], [4, 7], [1, 3, 7], [2, 3, 7])
TAIL_DIGITS = re.compile(r"([0-9]+)([ ().\-/]{1,2})$")
HEAD_DIGITS = re.compile(r"([ ().\-/]{1,2})([0-9]+)")
SIGNS = re.compile(r"[ ().\-/]{1,2}(?=[0-9])")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for place, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if place % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def address_runs(text: str):
    """Longest runs of address characters that hold an @; every strict address lies in one."""
    at, done = text.find("@"), 0
    while at >= 0:
        start, stop = at, at
        while start > done and text[start - 1] in ADDRESS_SIGNS:
            start -= 1
        while stop < len(text) and text[stop] in ADDRESS_SIGNS:
            stop += 1
        yield start, stop
        done = stop
        at = text.find("@", stop)


def addresses(text: str, start: int, stop: int):
    """Mail addresses in a run of address characters, leftmost first."""
    at = text.find("@", start, stop)
    while at >= 0:
        found = DOMAIN.match(text, at + 1, stop) if at > start else None
        if found:
            yield start, found.end()
        start = found.end() if found else at + 1
        at = text.find("@", start, stop)


def strict_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four rules, by kind and start."""
    spans = [("email", *span) for start, stop in address_runs(text) for span in addresses(text, start, stop)]
    if not DIGIT.search(text):
        return spans
    for m in DOTTED.finditer(text):
        parts = [part.lstrip("0") for part in m.group().split(".")]
        if all(len(part) <= 3 and int(part or 0) <= 255 for part in parts):
            spans.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", *m.span()))
    if "+" in text:
        spans += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m.group())) <= 15]
    return spans


def parts_of_run(text: str, start: int, end: int):
    """(kind, start, end) of every part of a run that group bounds delimit and whose digits fit a kind."""
    groups = [m.span() for m in PLAIN.finditer(text, start, end)]
    for first, (begin, _) in enumerate(groups):
        signed = begin
        while signed > start and begin - signed < 2 and text[signed - 1] in "+(":
            signed -= 1
        size = 0
        for own_begin, own_end in groups[first : first + MOST_GROUPS]:
            size += own_end - own_begin
            if size >= CARD_DIGITS.stop:
                break
            for kind, sizes in (("phone", PHONE_DIGITS), ("card", CARD_DIGITS)):
                if size in sizes:
                    yield kind, signed, own_end
                    if text[signed] == "(" and text.find(")", signed, own_end) < 0:  # the sign belongs to the text around
                        yield kind, begin, own_end


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Everything that might be a value, kinds and spans overlapping."""
    found = set()
    if SPELLED_HINT.search(text):
        found.update(("email", *m.span()) for m in SPELLED.finditer(text))
    if DIGIT.search(text):
        found.update(("ip", *m.span()) for m in LOOSE_IP.finditer(text))
        for m in RUN.finditer(text):
            found.update(parts_of_run(text, *m.span()))
        found.update(("card", *m.span()) for m in PLAIN.finditer(text) if 12 <= m.end() - m.start() <= 20)
    return sorted(found)


def sign_class(sign: str) -> int:
    if not sign:
        return 0
    if sign.isspace():
        return 1
    if sign.isdigit():
        return 5
    if sign.isalpha():
        return 6
    return {".": 2, ",": 2, ":": 3, "=": 3, "#": 3, "-": 4, "/": 4, "_": 4, '"': 7, "'": 7, "(": 8, ")": 8}.get(sign, 9)


def described(text: str, kind: str, start: int, end: int) -> list[float]:
    """Features of a candidate: its format, then its context."""
    value = text[start:end]
    digits = digits_of(value)
    groups = [len(g) for g in PLAIN.findall(value)] or [0]
    numbers = [int(g) for g in PLAIN.findall(value)[:4] if len(g) < 10] or [0]
    before = re.findall(r"[A-Za-z-]+", text[max(0, start - 30) : start].lower())[-2:]
    hinted = [float(any(w in words for w in before)) for words in HINTS.values()]
    lowered = value.lower()
    # What a run of digits goes on with on either side, and whether the sign there is one of the value's own.
    earlier = TAIL_DIGITS.search(text[max(0, start - 24) : start])
    later = HEAD_DIGITS.match(text[end : end + 24])
    signs = set(SIGNS.findall(value))
    name = re.match(r"[A-Za-z]*", value)
    return [
        float(KINDS.index(kind)),
        len(value),
        len(digits),
        len(groups),
        max(groups),
        min(groups),
        groups[0],
        groups[-1],
        float(len(digits) > 1 and luhn(digits)),
        float(digits[:1] in ("3", "4", "5", "6") and digits[:1] != ""),
        float(max(numbers)),
        float(numbers[0]),
        len(set(digits)),
        float(value.startswith("+")),
        float(value.startswith("00")),
        float("(" in value),
        value.count("."),
        value.count("-"),
        value.count(" "),
        value.count("/"),
        float("@" in value),
        float("at" in re.split(r"[^a-z]+", lowered)),
        float("dot" in re.split(r"[^a-z]+", lowered)),
        float(bool(re.search(r"[\[({<](at|dot|\.)[\])}>]", lowered))),
        float(1900 <= numbers[0] <= 2100 or 1900 <= numbers[-1] <= 2100),
        sign_class(text[start - 1 : start]),
        sign_class(text[end : end + 1]),
        float(text[end : end + 2].strip()[:1].isdigit()),
        float(text[max(0, start - 2) : start].strip()[-1:].isdigit()),
        float(len(earlier.group(1)) if earlier else 0),
        float(len(later.group(2)) if later else 0),
        float(bool(earlier) and earlier.group(2) in signs),
        float(bool(later) and later.group(1) in signs),
        len(signs),
        float(groups[1] if len(groups) > 1 else 0),
        float(groups[2] if len(groups) > 2 else 0),
        float(groups[-2] if len(groups) > 1 else 0),
        float(len(set(groups[:-1])) == 1),
        float(groups in PHONE_GROUPS),
        float(set(groups[:-1]) == {4} and groups[-1] in (1, 2, 3, 4)),
        float(name.group().lower() in COMMON_BEFORE_AT),
        *hinted,
    ]


# Training examples


def rendered_digits(rng: random.Random, size: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(size))


def card_number(rng: random.Random, valid: bool) -> str:
    size = rng.choice((13, 14, 15, 16, 16, 16, 16, 19))
    body = (rng.choice("3456") if rng.random() < 0.5 else rng.choice("0123456789")) + rendered_digits(rng, size - 2)
    if rng.random() < 0.15:  # few different digits, as in round numbers
        body = body[:2] + rng.choice("0123456789") * (size - 3)
    last = next(d for d in "0123456789" if luhn(body + d))
    return body + (last if valid else rng.choice([d for d in "0123456789" if d != last]))


def positive(rng: random.Random, kind: str) -> str:
    """A value of this kind in one of many formats."""
    if kind == "email":
        name = rng.choice("abcdefgh") + "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8)))
        name += rng.choice(("", "", str(rng.randint(1, 99)), "." + rng.choice(("smith", "li", "ops"))))
        host = "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) + rng.choice(("", str(rng.randint(1, 9))))
        end = rng.choice(("com", "org", "net", "de", "fr", "io"))
        sign, dot = rng.choice(((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), ("[at]", "."), (" @ ", "."), ("{at}", "{dot}"), (" @ ", " . "), (" (at) ", "."), (" at ", ".")))
        return f"{name.replace('.', dot)}{sign}{host}{dot}{end}"
    if kind == "ip":
        dot = rng.choice((".", "[.]", "(.)", " . ", "[.]"))
        return dot.join(str(rng.randint(1, 255)) for _ in range(4))
    if kind == "card":
        number = card_number(rng, rng.random() < 0.6)
        sign = rng.choice(("", "", " ", "-", "."))
        return sign.join(number[i : i + 4] for i in range(0, len(number), 4)) if sign else number
    country = str(rng.randint(1, 99))
    a, b, c = rendered_digits(rng, 3), rendered_digits(rng, 3), rendered_digits(rng, 4)
    return rng.choice(
        (f"({a}) {b}-{c}", f"+{country} ({a}) {b}-{c}", f"{a}-{b}-{c}", f"00{country} {a} {b} {c}", f"+{country}.{a}.{b}.{c}")
        + (f"0{a}/{b}{c}", f"+{country} {a} {b}{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", f"+{country}-{a}-{b}-{c}")
    )


def negative(rng: random.Random) -> str:
    """A look-alike that is no personal data."""
    d = lambda n: rendered_digits(rng, n)
    year, month, day = rng.randint(1950, 2035), rng.randint(1, 12), rng.randint(1, 28)
    return rng.choice(
        (
            f"{year}-{month:02d}-{day:02d}", f"{day:02d}.{month:02d}.{year}", f"{month}/{day}/{year}", f"{year}-{year + 3}",
            f"{year}{month:02d}{day:02d}{d(6)}", f"version {rng.randint(1, 20)}.{d(1)}.{d(2)}.{d(1)}", f"v{d(1)}.{d(1)}.{d(1)}.{d(1)}",
            f"{rng.randint(256, 999)}.{rng.randint(256, 999)}.{d(3)}.{d(3)}", f"order {d(8)}", f"id {d(12)}", f"ref {d(9)}",
            f"order {d(16)}", f"id={d(16)}", f"invoice no {d(14)}", f"isbn 978-{d(1)}-{d(4)}-{d(4)}-{d(1)}", f"isbn 978{d(10)}",
            f"{d(1)}.{d(9)}", f"{d(2)}.{d(14)}", f"{rng.randint(1, 999)} {d(3)} {d(3)}", f"{d(1)},{d(3)},{d(3)}.{d(2)}", f"{d(7)}",
            f"a{d(12)}f", f'"{d(9)}e{d(8)}c{d(9)}"', f"token = \"{d(3)}ab{d(13)}\"", f"page {d(3)}-{d(4)}", f"{d(20)}", f"{d(8)}",
            f"{d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)} {d(1)}", f"sku {d(5)}-{d(5)}-{d(3)}", f"{d(3)}/{d(4)}/{d(3)}",
            f"{d(2)} {d(3)} {d(1)} {d(4)} {d(2)} {d(1)}", f"{d(4)} {d(2)} {d(3)} {d(4)} {d(1)} {d(3)}", f"{d(2)}.{d(1)} {d(2)}.{d(1)} {d(3)}.{d(1)} {d(1)}.{d(2)}",
            f"{year}-{month:02d}-{day:02d} {d(2)} {d(3)} {d(4)}", f"{rng.choice(sorted(COMMON_BEFORE_AT))} at www.{rng.choice(('ab', 'news', 'tool'))}.com",
            f"{rng.choice(sorted(COMMON_BEFORE_AT))} at {rng.choice(('example', 'site', 'shop', 'docs.lab'))}.{rng.choice(('com', 'org', 'net', 'io'))}",
            "look at this dot com boom", "we met at noon. Then", "at home (dot) net worth", f"stay at hotel. {d(2)} rooms",
        )
    )


def neighbour(rng: random.Random) -> tuple[str | None, str]:
    """Kind and text of what stands beside a value: another value, or a number that is none."""
    if rng.random() < 0.5:
        kind = rng.choice(("card", "phone"))
        return kind, positive(rng, kind)
    year, month, day = rng.randint(1950, 2035), rng.randint(1, 12), rng.randint(1, 28)
    size = rng.randint(1, 5)
    other = (f"{year}-{month:02d}-{day:02d}", f"{month:02d}/{year % 100:02d}", f"{day:02d}.{month:02d}.{year}", str(year), rendered_digits(rng, size), rendered_digits(rng, size))
    return None, rng.choice(other)


def examples(carriers: list[list[str]], size: int = EXAMPLES, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the candidates in made texts; a candidate is right if it is exactly a value set in.

    Half of the cards and phones have a neighbour before them, after them, or both.
    """
    rng = random.Random(seed)
    rows, labels = [], []
    for number in range(size):
        kind = KINDS[number // 2 % 4] if number % 2 else None
        words = rng.choice(carriers) if carriers else ["word"] * 20
        at = rng.randrange(max(1, len(words) - 12))
        left, right = " ".join(words[at : at + 6]), " ".join(words[at + 6 : at + 12])
        items = [(kind, positive(rng, kind) if kind else negative(rng))]
        if kind and rng.random() < 0.25:
            left += " " + rng.choice(HINTS[kind]) + rng.choice(("", ":", " is"))
        if kind in ("card", "phone") and rng.random() < 0.5:
            sides = rng.choice(("before", "after", "both"))
            items = [neighbour(rng)] * (sides != "after") + items + [neighbour(rng)] * (sides != "before")
        text, right_spans = left, set()
        start = len(left) + 1
        for own, value in items:
            text += " " + value
            if own:
                right_spans.add((own, len(text) - len(value), len(text)))
        end = len(text)
        text += f"{rng.choice((' ', ' ', ' ', '. ', ', ', chr(10)))}{right}"
        strict = set(strict_spans(text))
        for span in candidates(text):
            if span not in strict and start <= span[1] and span[2] <= end:
                rows.append(described(text, *span))
                labels.append(float(span in right_spans))
    return np.array(rows, np.float64), np.array(labels, np.float64)


def surroundings(text: str, kind: str, start: int, end: int) -> tuple[str, str, str, str]:
    """All that ``described`` looks at."""
    return kind, text[max(0, start - 30) : start], text[start:end], text[end : end + 24]


@dataclass
class Finder:
    trees: Trees
    thresholds: dict[str, float]
    judged: dict = field(default_factory=dict, repr=False)

    def probabilities(self, text: str, spans: list[tuple[str, int, int]]) -> list[float]:
        """Of each candidate, in blocks; equal candidates in equal surroundings are judged once."""
        found: list[float] = []
        for at in range(0, len(spans), JUDGED):
            part = spans[at : at + JUDGED]
            keys = [surroundings(text, *span) for span in part]
            new = {key: span for key, span in zip(keys, part) if key not in self.judged}
            if len(self.judged) + len(new) > REMEMBERED:
                self.judged.clear()
                new = dict(zip(keys, part))
            if new:
                rows = np.array([described(text, *span) for span in new.values()], np.float64)
                self.judged.update(zip(new, self.trees.probability(rows).tolist()))
            found += [self.judged[key] for key in keys]
        return found

    def spans(self, text: str) -> list[tuple[str, int, int, bool, float]]:
        """(kind, start, end, strict, probability), by kind as listed, then start."""
        strict = strict_spans(text)
        chosen = [(*span, True, 1.0) for span in strict]
        listed = set(strict)
        extra = [span for span in candidates(text) if span not in listed]
        if extra:
            taken = bytearray(len(text))
            for _, start, end in strict:
                taken[start:end] = b"\1" * (end - start)
            likely = self.probabilities(text, extra)
            # Of equally probable spans the longer one goes first, so that no part of a value is left.
            order = sorted(range(len(extra)), key=lambda i: (-likely[i], extra[i][1] - extra[i][2], i))
            for i in order:
                kind, start, end = extra[i]
                if likely[i] >= self.thresholds[kind] and taken.find(1, start, end) < 0:
                    chosen.append((kind, start, end, False, likely[i]))
                    taken[start:end] = b"\1" * (end - start)
        return sorted(chosen, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))


def fit_examples(carriers: list[list[str]]) -> Finder:
    """Train on two thirds of the examples, calibrate the thresholds on the rest."""
    rows, labels = examples(carriers)
    rest = np.arange(len(labels)) % 3 == 0
    trees = train(rows[~rest], labels[~rest])
    likely = trees.probability(rows[rest])
    thresholds = {}
    for number, kind in enumerate(KINDS):
        own = rows[rest][:, 0] == number
        thresholds[kind] = max(0.5, threshold_for(likely[own], labels[rest][own], PRECISION))
    return Finder(trees, thresholds)


def fit(docs: DataFrame) -> Finder:
    """Trees for this corpus; at most 2 * CARRIERS texts come to the driver.

    A hash of the id picks about CARRIERS rows where they are read, so no task sends more than its share.
    """
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, CARRIERS / max(1, docs.count())))
    rows = docs.where(picked).select("text").limit(2 * CARRIERS).collect()
    runs = sorted([w for w in (r["text"] or "").split() if w.isalpha()] for r in rows)
    return fit_examples([run for run in runs if run])


SPANS = "array<struct<kind:string,start:bigint,end:bigint,strict:boolean,probability:double>>"
SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("strict", pa.bool_()), ("probability", pa.float64())])
)


def find(docs: DataFrame, finder: Finder) -> DataFrame:
    """Columns doc_id and spans for every row."""

    def run(batches):
        for batch in blocks(batches):
            found = [
                [dict(zip(("kind", "start", "end", "strict", "probability"), span)) for span in finder.spans(text or "")]
                for text in batch.column("text").to_pylist()
            ]
            schema = pa.schema([("doc_id", batch.column("doc_id").type), ("spans", SPAN_TYPE)])
            yield record_batch(schema, [batch.column("doc_id"), found])

    doc_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_type}, spans {SPANS}")


def redacted_text(text: str, spans) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans go together."""
    parts, at = [], 0
    for kind, start, end, *_ in sorted(spans, key=lambda span: (span[1], -span[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, finder: Finder) -> DataFrame:
    """All rows and columns, with ``text`` redacted; a null text stays null."""

    def run(batches):
        for batch in blocks(batches):
            texts = [None if t is None else redacted_text(t, finder.spans(t)) for t in batch.column("text").to_pylist()]
            place = batch.schema.get_field_index("text")
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, batch.schema.field(place).type))

    return docs.mapInArrow(run, docs.schema)
