"""Personal data by weak supervision.

*Base spans* are the leftmost non-overlapping matches of four fixed patterns
(email, IP address, card number, phone number), less those that fail their
check.  They are always kept.

*Candidates* are base spans and looser forms: digit runs of card length, phone
numbers without a country code or with other numbers right behind, full IPv6 addresses, addresses written with
"at" and "dot".  Each candidate gets a vote (for, against, none) of five labelers: the strict
pattern, the checksum or format, a gazetteer of public facts (issuer ranges, calling codes and
the numbering plan of North America, mail domains, special-purpose networks), cue words in the context, and the borders of
the span.

*Reliabilities*: all candidates of the corpus are counted by kind, votes and
shape -- a table with at most ``4 * 3**5 * 3`` rows, whatever the input -- and
expectation-maximisation estimates from these counts how often each labeler is
right about true and about false spans.  *Classifier*: a logistic regression on
votes and shape is trained towards the posterior probabilities, weighted by the
counts, per kind.  A candidate is added if its probability reaches
``threshold`` and it overlaps no base span.

Null and empty texts have no spans.  Offsets count code points.  Texts of any length are searched whole,
in time linear in them but for sorting; of overlapping candidates of a kind the first stays, and
none that overlaps a base span.  Repeated rows give a row each and count as often; an empty
table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from ipaddress import ip_address
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from actlens.llm.batches import slices
from actlens.sources.scratch import materialize

#: The kinds, in the order of results.
KINDS = ("email", "ip", "card", "phone")

# A match of the number patterns lies within such a run: it starts with a
# digit or plus sign and has no other characters.
_REGION = re.compile(r"[0-9+][\x20().0-9+-]+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NOT_DIGIT = re.compile(r"[^0-9]")

_LOOSE_PHONE = re.compile(
    r"(?<![0-9+])(?:\+[0-9]{1,3}[\x20.-]?\(?)?[0-9]{3}(?:\)\x20?|[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")
_SPELLED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:[\[({]\x20?at\x20?[\])}]|\x20at\x20)\x20?"
    r"[A-Za-z0-9-]{1,63}(?:(?:\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[A-Za-z0-9-]{2,24})+", re.I)

#: Cue words for and against each kind.
CUES = {
    "email": ("email e-mail mail contact write inbox correo courriel", "example regex pattern"),
    "ip": ("ip address server host ping login client gateway", "version release section chapter"),
    "card": ("card credit visa mastercard amex payment debit tarjeta carte karte", "isbn order tracking token serial invoice"),
    "phone": ("phone tel call mobile fax cell telefon teléfono téléphone", "isbn order version serial invoice"),
}
_CUES = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CUES.items()}
_WORD = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def _octets(span: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in span.split("."))


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping email addresses.  All starts in the run of
    name characters before an ``@`` match or fail together, so it is enough
    to look at each ``@`` and take the longest run."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            out.append((start, done))
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def base_spans(text: str, loose: list | None = None) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of the fixed patterns, in order.  Looser
    candidates from the same runs are appended to ``loose``."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    for region in _REGION.finditer(text):
        run, at = region.group(), region.start()
        if len(run) < 7:
            continue
        if run.count(".") > 2:
            out += [(1, at + m.start(), at + m.end()) for m in _IP.finditer(run) if _octets(m.group())]
        for m in _CARD.finditer(run):
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19:
                if luhn(digits):
                    out.append((2, at + m.start(), at + m.end()))
                elif loose is not None:
                    loose.append((2, at + m.start(), at + m.end()))
        if "+" in run:
            out += [(3, at + m.start(), at + m.end()) for m in _PHONE.finditer(run)
                    if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
        if loose is not None and len(run) > 11:
            loose += [(3, at + m.start(), at + m.end()) for m in _LOOSE_PHONE.finditer(run)]
    out.sort()
    return out


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and looser candidates that overlap none of them."""
    loose: list[tuple[int, int, int]] = []
    base = base_spans(text, loose)
    low = text.lower() if len(text.lower()) == len(text) else text
    if " dot " in low or "dot]" in low or "dot)" in low or "dot}" in low:
        loose += [(0, m.start(), m.end()) for m in _SPELLED.finditer(text)]
    if text.count(":") > 6:
        loose += [(1, m.start(), m.end()) for m in _IPV6.finditer(text)]
    if not loose:
        return base, []
    # Base spans that begin before a candidate's end overlap it if the furthest of their ends is behind its start.
    taken = sorted((a, b) for _, a, b in base)
    starts, furthest = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    free, last = [], {}
    for kind, a, b in sorted(set(loose)):
        i = bisect_left(starts, b)
        if (i == 0 or furthest[i - 1] <= a) and last.get(kind, 0) <= a:
            free.append((kind, a, b))
            last[kind] = b
    return base, free


#: Calling codes of one and two digits, and the first two digits of those of three.
_CALLING = ("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
            "81 82 84 86 90 91 92 93 94 95 98").split()
_CALLING_AREAS = "21 22 23 24 25 26 29 35 37 38 42 50 59 67 68 69 80 85 87 88 96 97 99".split()
#: First and last prefix of card issuers' ranges.
_ISSUERS = ((4, 4), (51, 55), (2221, 2720), (34, 34), (37, 37), (6011, 6011), (644, 649), (65, 65), (3528, 3589), (300, 305),
            (36, 36), (38, 39), (62, 62), (50, 50), (56, 58), (63, 63), (67, 67))
#: Generic mail domains; those of countries have two letters.
_DOMAINS = ("com org net edu gov mil int info biz name pro aero coop museum jobs mobi travel tel cat asia post app dev "
            "online site shop store cloud email tech blog xyz").split()


def known_caller(span: str, digits: str) -> bool:
    """Whether a number begins as one can be: with a calling code after a plus sign, else as
    in the North American plan, where neither area nor exchange begin with 0 or 1."""
    if span[0] == "+" and not digits.startswith("1"):
        return digits.startswith(tuple(_CALLING)) or digits[:2] in _CALLING_AREAS
    national = digits[1:] if span[0] == "+" else digits
    return len(national) >= 10 and national[-10] not in "01" and national[-7] not in "01"


def known_issuer(digits: str) -> bool:
    return any(a <= int(digits[:len(str(a))]) <= b for a, b in _ISSUERS)


def known_network(span: str) -> bool:
    """Whether an address is reachable everywhere, by the registries of special-purpose networks."""
    try:
        return ip_address(span).is_global
    except ValueError:
        return False


def known_domain(span: str) -> bool:
    last = re.split(r"[^A-Za-z0-9]+", span.rstrip("])} "))[-1].lower()
    return last in _DOMAINS or (len(last) == 2 and last.isalpha())


def votes(text: str, kind: int, a: int, b: int, strict: bool) -> tuple[int, ...]:
    """Votes (0 none, 1 for, 2 against) of the five labelers, and the shape
    (0 plain, 1 with separators, 2 long)."""
    span, name = text[a:b], KINDS[kind]
    digits = _NOT_DIGIT.sub("", span)
    regex_vote = 1 if strict else 0
    if name == "card":
        check = 1 if luhn(digits) else 2
        known = 1 if known_issuer(digits) else 2
    elif name == "phone":
        check = 1 if 9 <= len(digits) <= 15 else 2
        known = 1 if known_caller(span, digits) else 2
    elif name == "ip":
        check = 1 if ":" in span or _octets(span) else 2
        known = 0 if known_network(span) else 2
    else:
        check = 1 if re.search(r"[A-Za-z]{2,}\Z", span) else 2
        known = 1 if known_domain(span) else 0
    near = {w.lower() for w in _WORD.findall(text[max(0, a - 60):a])[-5:] + _WORD.findall(text[b:b + 40])[:3]}
    plus, minus = _CUES[name]
    context = 1 if near & plus else 2 if near & minus else 0
    before, after = text[a - 1:a], text[b:b + 1]
    border = 2 if before.isalnum() or after.isalnum() or before in ("_", "=") and before else 1
    shape = 2 if len(span) > 24 else 1 if re.search(r"[\x20()-]", span) else 0
    return regex_vote, check, known, context, border, shape


def _code(kind: int, vote: tuple[int, ...]) -> int:
    code = kind
    for v in vote:
        code = 3 * code + v
    return code


def _decode(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for _ in range(6):
        out.append(codes % 3)
        codes = codes // 3
    return codes, np.array(out[::-1]).T


def find(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``loose`` (arrays of kind, start, end) and
    ``codes`` (kind, votes and shape of the base spans, then the loose ones)
    of every row of ``docs`` (``doc_id, text``)."""
    span = "array<struct<k:int,a:int,b:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("k", pa.int32()), ("a", pa.int32()), ("b", pa.int32())]))
        entry = lambda spans: [{"k": k, "a": a, "b": b} for k, a, b in spans]
        for batch in slices(batches, "text"):
            base, loose, codes = [], [], []
            for text in batch.column(1).to_pylist():
                x, y = candidates(text) if text else ([], [])
                base.append(entry(x))
                loose.append(entry(y))
                codes.append([_code(k, votes(text, k, a, b, True)) for k, a, b in x]
                             + [_code(k, votes(text, k, a, b, False)) for k, a, b in y])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(base, kind), pa.array(loose, kind), pa.array(codes, pa.list_(pa.int32()))],
                ["doc_id", "base", "loose", "codes"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, f"doc_id long, base {span}, loose {span}, codes array<int>")


def reliabilities(vote: np.ndarray, count: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (0 none, 1 for, 2 against)
    with their counts: the probability that a pattern is a true span, and per
    class, labeler and vote the vote's probability.  Starts from the
    majority vote."""
    p = np.clip(0.5 + 0.15 * ((vote == 1).sum(1) - (vote == 2).sum(1)), 0.05, 0.95)
    onehot = vote[:, :, None] == np.arange(3)
    rate = np.zeros((2, vote.shape[1], 3))
    for _ in range(rounds):
        for c, weight in ((1, p * count), (0, (1 - p) * count)):
            seen = np.einsum("i,ijv->jv", weight, onehot)
            rate[c] = (seen + 0.5) / (seen.sum(1, keepdims=True) + 1.5)
        prior = ((p * count).sum() + 1) / (count.sum() + 2)
        # "none" says nothing about the class
        score = np.log(prior / (1 - prior)) + np.where(
            onehot[:, :, 1:], (np.log(rate[1]) - np.log(rate[0]))[None, :, 1:], 0.0).sum((1, 2))
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    return p, rate


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1.0) -> np.ndarray:
    """Weighted logistic regression towards soft labels, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (weight * (p - y)) + l2 * w)
    return w


def train(codes: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The classifier's probability for each code, from the codes' counts."""
    kinds, columns = _decode(codes)
    out = np.zeros(len(codes))
    for kind in np.unique(kinds):
        mine = kinds == kind
        vote, n = columns[mine][:, :5], count[mine].astype(float)
        truth, _ = reliabilities(vote, n)
        x = np.concatenate([np.ones((len(vote), 1)), (columns[mine] == 1), (columns[mine] == 2)], axis=1).astype(float)
        out[mine] = 1 / (1 + np.exp(-np.clip(x @ _logistic(x, truth, n), -30, 30)))
    return out


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(names, s["k"] + 1), s["a"].cast("string"), s["b"].cast("string"))), ",")


def detect(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, the numbers of base spans
    ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` of the base spans as
    ``kind:start:end`` joined by commas, and ``spans``, the same text for base
    and added spans."""
    found = materialize(find(docs), "pii-spans")
    # One row per combination of kind, votes and shape: bounded by their number.
    seen = found.select(F.explode("codes").alias("code")).groupBy("code").count().orderBy("code").toPandas()
    accepted = []
    if len(seen):
        probability = train(seen["code"].to_numpy(), seen["count"].to_numpy())
        accepted = seen["code"][probability >= threshold].tolist()
    good = F.array(*[F.lit(int(c)) for c in accepted]) if accepted else F.array().cast("array<int>")
    added = F.filter("loose", lambda s, i: F.array_contains(good, F.element_at("codes", F.size("base") + i + 1)))
    kinds = F.transform("base", lambda s: s["k"])
    n = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select("doc_id", *n, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
                        _joined(F.concat("base", added)).alias("spans"))
