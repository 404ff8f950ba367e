"""Personal data by weak supervision: e-mail addresses, IP addresses, card and phone numbers.

Base spans follow fixed patterns and checks. Beside them stand candidates: looser forms
of the same four kinds (addresses spelled with "at" and "dot", numbers without their
plus, card-like and address-like digits that fail a check). Labelers vote yes, no or
nothing on every candidate and base span: the strict pattern, its check, a gazetteer, the
words before it, and its layout. Expectation-maximisation over the votes of all
documents estimates how reliable each labeler is and how likely each pattern of votes is
personal data; a logistic classifier over votes and size is then trained on these
chances. Candidates with a chance of ``CUT`` or more are added where they touch no base
span; base spans always stay.

Votes and size take at most 1,215 values for a kind, and only their counts leave the
tasks, so the driver's work does not grow with the data.

NULL and empty texts have no spans. Positions are code points, ends exclusive. Very long
texts take time in proportion to their length: every pattern is tried only inside runs
of the characters it can use. Of added spans that overlap the likeliest stays, then the
leftmost. Rows are independent: repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.texts import emit_from_text, map_text

KINDS = ("email", "ip", "card", "phone")
#: Least chance of an added span.
CUT = 0.95
LABELERS, SIZES = 5, 5
#: Weight of votes never seen in the training of the classifier.
RARE = 0.2

RUN = re.compile(r"[0-9+][0-9 ().+-]*")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\s?(?:\[at\]|\(at\)|\{at\}| at )\s?[A-Za-z0-9-]{1,63}"
                     r"(?:\s?(?:\[dot\]|\(dot\)|\{dot\}| dot |\.)\s?[A-Za-z0-9-]{1,63}){1,4}", re.IGNORECASE)
SPELLED_HINTS = ("[at]", "(at)", "{at}", " dot ", "[dot]", "(dot)", "{dot}")
LOOSE_PHONE = re.compile(r"(?<![0-9])\(?[0-9]{2,4}\)?(?:[ .-]{1,2}\(?[0-9]{2,4}\)?){1,4}(?![0-9])")

ENDINGS = frozenset("com org net edu gov io info biz co uk de fr es eu us ca au ch at nl it".split())
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6(?:011|5)|35|30[0-5]|36|38")
CALLING = re.compile(r"\+?(?:1|20|27|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])")
HINTS = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write|address|correo|courriel|kontakt)\b", re.IGNORECASE),
    "ip": re.compile(r"\b(?:ip|host|server|address|gateway|ping|client)\b", re.IGNORECASE),
    "card": re.compile(r"\b(?:card|visa|mastercard|amex|credit|debit|karte|carte|tarjeta)\b", re.IGNORECASE),
    "phone": re.compile(r"\b(?:phone|tel|telefon|teléfono|téléphone|call|mobile|fax|cell|whatsapp)\b", re.IGNORECASE),
}
AGAINST = re.compile(r"\b(?:version|licen[cs]e|isbn|issn|page|chapter|section|figure|fig|order|invoice|v)\b\.?\s*$", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if k % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    found, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            last = domain.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", max(at + 1, last))
    return found


def right_octets(text: str) -> bool:
    return all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in text.split("."))


def cover(taken: bytearray, start: int, end: int) -> None:
    taken[start:end] = b"\x01" * (end - start)


def numbers(text: str) -> tuple[dict[str, list[tuple[int, int]]], list[tuple[str, int, int]]]:
    """Base spans of the three kinds of numbers, and candidates that fail them."""
    base, more = {"ip": [], "card": [], "phone": []}, []
    for run in RUN.finditer(text):
        part, at = run.group(), run.start()
        if len(part) < 7:
            continue
        taken = bytearray(len(part))          # 1 where a base span lies
        if part.count(".") >= 3:
            for m in IP.finditer(part):
                if right_octets(m.group()):
                    base["ip"].append((at + m.start(), at + m.end()))
                    cover(taken, *m.span())
                else:
                    more.append(("ip", at + m.start(), at + m.end()))
        if len(part) >= 12:
            for m in CARD.finditer(part):
                digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() <= 64 else ""
                if 13 <= len(digits) <= 19 and luhn(digits):
                    base["card"].append((at + m.start(), at + m.end()))
                    cover(taken, *m.span())
                elif 12 <= len(digits) <= 19:
                    more.append(("card", at + m.start(), at + m.end()))
        if "+" in part:
            for m in PHONE.finditer(part):
                digits = sum(c.isdigit() for c in m.group())
                if 9 <= digits <= 15:
                    base["phone"].append((at + m.start(), at + m.end()))
                    cover(taken, *m.span())
        for m in LOOSE_PHONE.finditer(part):
            digits = sum(c.isdigit() for c in m.group())
            if 7 <= digits <= 15 and taken.find(1, *m.span()) < 0:
                more.append(("phone", at + m.start(), at + m.end()))
    return base, more


def base_spans(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """The base spans of each kind, in the order of the text."""
    text = text or ""
    return {"email": emails(text), **numbers(text)[0]}


def vote(kind: str, text: str, start: int, end: int, base: bool) -> int:
    """The votes on a span and its size, as one number."""
    span, before, after = text[start:end], text[max(0, start - 40) : start], text[end : end + 1]
    digits = re.sub("[^0-9]", "", span)
    strict = int(base)
    if kind == "email":
        last = re.split(r"[^A-Za-z0-9-]+", span)[-1].lower()
        check = 1 if 2 <= len(last) <= 24 and last.isalpha() else -1
        listed = 1 if last in ENDINGS else -1 if not base else 0
        layout = 1 if base or re.search(r"[\[({]", span) else 0 if " dot " in span.lower() else -1
    elif kind == "ip":
        check = 1 if right_octets(span) else -1
        listed = -1 if span.split(".")[0].strip("0") == "" else 1 if check > 0 else 0
        layout = -1 if after[:1].isalnum() or before[-1:].isalpha() else 1
    elif kind == "card":
        check = 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
        listed = 1 if ISSUERS.match(digits) else -1
        layout = -1 if after[:1].isalpha() or before[-1:].isalpha() else 1 if re.fullmatch(r"[0-9]{4}([ -]?[0-9]{4}){2,3}[0-9]{0,3}", span) else 0
    else:
        check = 1 if 9 <= len(digits) <= 15 else -1
        listed = 1 if span[0] == "+" and CALLING.match(span) else 0
        layout = 1 if re.fullmatch(r"\+?[0-9]{0,3}[ .-]?\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", span) else 0 if base else -1
    context = -1 if AGAINST.search(before) else 1 if HINTS[kind].search(before) else 0
    code = 0
    for v in (strict, check, listed, context, layout):
        code = code * 3 + v + 1
    return code * SIZES + min(len(span) // 8, SIZES - 1)


def candidates(text: str | None) -> tuple[dict[str, list], list[tuple[str, int, int, int, bool]]]:
    """(base spans, all spans voted on: kind, start, end, votes, whether base)."""
    text = text or ""
    base, more = numbers(text)
    base = {"email": emails(text), **base}
    if any(hint in text for hint in SPELLED_HINTS) or any(hint in text.lower() for hint in SPELLED_HINTS[:3]):
        more += [("email", m.start(), m.end()) for m in SPELLED.finditer(text) if "dot" in m.group().lower() or re.search(r"[\[({]at", m.group(), re.IGNORECASE)]
    voted = [(kind, a, b, vote(kind, text, a, b, True), True) for kind in KINDS for a, b in base[kind]]
    return base, voted + [(kind, a, b, vote(kind, text, a, b, False), False) for kind, a, b in more]


def _votes(code: np.ndarray) -> np.ndarray:
    """Votes (0 no, 1 nothing, 2 yes) of each code, by labeler."""
    code = code // SIZES
    return np.stack([code // 3 ** (LABELERS - 1 - k) % 3 for k in range(LABELERS)], axis=1)


def reliabilities(codes: np.ndarray, counts: np.ndarray, rounds: int = 60) -> tuple[float, np.ndarray]:
    """(share of personal data, how often each labeler says no or yes given the truth) by expectation-maximisation."""
    votes = _votes(codes)
    table = np.tile(np.array([[0.8, 0.2], [0.2, 0.8]]), (LABELERS, 1, 1))   # labeler, truth, no or yes
    prior = 0.5
    for _ in range(rounds):
        chance = chances(codes, prior, table)
        weight = np.stack([counts * (1 - chance), counts * chance])
        prior = float(np.clip((weight[1].sum() + 1) / (counts.sum() + 2), 0.05, 0.95))
        for k in range(LABELERS):
            for truth in (0, 1):
                seen = np.bincount(votes[:, k], weight[truth], 3)[[0, 2]] + np.array([[4.0, 1.0], [1.0, 4.0]])[truth]
                table[k, truth] = seen / seen.sum()
    return prior, table


def chances(codes: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    """The chance that a span is personal data, given the votes on it; who says nothing does not count."""
    votes = _votes(codes)
    odds = np.full(len(codes), np.log(prior) - np.log(1 - prior))
    for k in range(LABELERS):
        said = votes[:, k] != 1
        odds[said] += np.log(table[k, 1, votes[said, k] // 2]) - np.log(table[k, 0, votes[said, k] // 2])
    return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def _design(codes: np.ndarray) -> np.ndarray:
    votes = _votes(codes)
    size = np.eye(SIZES)[codes % SIZES]
    return np.concatenate([np.ones((len(codes), 1)), *[np.eye(3)[votes[:, k]][:, [0, 2]] for k in range(LABELERS)], size[:, 1:]], axis=1)


@dataclass
class Classifier:
    """Weights of each kind, and how reliable its labelers were found."""

    weights: dict[str, np.ndarray] = field(default_factory=dict)
    tables: dict[str, np.ndarray] = field(default_factory=dict)
    known: dict[tuple[str, int], float] = field(default_factory=dict)   # chances asked for before

    def chance(self, kind: str, codes: np.ndarray) -> np.ndarray:
        if kind not in self.weights:
            return np.zeros(len(codes))
        return 1 / (1 + np.exp(-np.clip(_design(codes) @ self.weights[kind], -50, 50)))

    def spans(self, text: str | None) -> tuple[dict[str, list], list[tuple[str, int, int]]]:
        """(base spans, all spans by kind and start)."""
        base, voted = candidates(text)
        out = [(kind, a, b) for kind in KINDS for a, b in base[kind]]
        more = []
        for kind, a, b, code, fixed in voted:
            if not fixed:
                chance = self.known.get((kind, code))
                if chance is None:
                    chance = self.known[kind, code] = float(self.chance(kind, np.array([code]))[0])
                if chance >= CUT:
                    more.append((chance, a, b, kind))
        if more:
            taken = bytearray(len(text or ""))
            for _, a, b in out:
                cover(taken, a, b)
            for _, a, b, kind in sorted(more, key=lambda m: (-m[0], m[1])):
                if taken.find(1, a, b) < 0:
                    out.append((kind, a, b))
                    cover(taken, a, b)
        return base, sorted(out, key=lambda s: (KINDS.index(s[0]), s[1]))


def vote_counts(docs: DataFrame, text: str = "text") -> list:
    """(kind, code, n) over all documents: at most 1,215 rows for a kind."""

    def make():
        total: dict[tuple[str, int], int] = {}

        def work(texts):
            for value in texts.to_pylist():
                for kind, _, _, code, _ in candidates(value)[1]:
                    total[kind, code] = total.get((kind, code), 0) + 1
            return None

        def finish():
            yield {"kind": [k for k, _ in total], "code": [c for _, c in total], "n": list(total.values())}

        work.finish = finish
        return work

    return emit_from_text(docs, make, "kind string, code int, n long", [], text).groupBy("kind", "code").agg(F.sum("n").alias("n")).collect()


def learn(docs: DataFrame, text: str = "text", steps: int = 400) -> Classifier:
    out = Classifier()
    rows = vote_counts(docs, text)
    for kind in KINDS:
        mine = sorted((r.code, r.n) for r in rows if r.kind == kind)
        if not mine:
            continue
        codes, counts = (np.array(x) for x in zip(*mine))
        prior, out.tables[kind] = reliabilities(codes, counts.astype(float))
        # Votes never seen are a small part of what the classifier learns from, at the chance the labelers give them.
        every = np.arange(SIZES * 3**LABELERS)
        share = np.full(len(every), RARE / len(every))
        share[codes] += (1 - RARE) * counts / counts.sum()
        x, chance = _design(every), chances(every, prior, out.tables[kind])
        weights = np.zeros(x.shape[1])
        for _ in range(steps):
            guess = 1 / (1 + np.exp(-x @ weights))
            slope = x.T @ (share * (guess - chance)) + 1e-3 * weights
            bend = (x * (share * guess * (1 - guess))[:, None]).T @ x + 1e-3 * np.eye(len(weights))
            weights -= np.linalg.solve(bend, slope) * 0.5
        out.weights[kind] = weights
    return out


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def digest(docs: DataFrame, classifier: Classifier, keep: list[str] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the number of base spans of each kind, their digest, and all spans as text."""

    def make():
        def work(texts):
            made = [classifier.spans(value) for value in texts.to_pylist()]
            counts = [[len(base[kind]) for base, _ in made] for kind in KINDS]
            fixed = [sha256(listed([(kind, a, b) for kind in KINDS for a, b in base[kind]]).encode()).hexdigest() for base, _ in made]
            return [*counts, fixed, [listed(spans) for _, spans in made]]

        return work

    fields = ", ".join(f"n_{kind} long" for kind in KINDS) + ", base_sha256 string, spans string"
    return map_text(docs, make, fields, keep, text)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, or overlap of spans, replaced by its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """``docs`` with all spans masked in their texts; other columns stay as they are."""

    def make():
        def work(texts):
            values = texts.to_pylist()
            return [pa.array([None if value is None else masked(value, classifier.spans(value)[1]) for value in values], pa.string())]

        return work

    return map_text(docs, make, f"`{text}` string", None, text).select(*[f"`{c}`" for c in docs.columns])
