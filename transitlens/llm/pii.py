"""Personal data: strict patterns, and candidate spans judged by boosted trees.

Four strict patterns (email, ip, card, phone) are found leftmost and without
overlap; a match that fails its check is dropped and not retried. Around them
generators propose overlapping candidates that the strict pass cannot see:
parts of a dropped match, numbers written with other separators, addresses
with spelled-out signs. Boosted trees judge a candidate by its format and its
surroundings; they learn from a bounded sample of texts. Positives are strict
spans and the same or made-up values written in the generators' other formats;
negatives are failed checks, look-alikes (dates, amounts, ids, prose) and wrong
cuts of a planted value; what is neither is left out. Every fifth text is kept
aside: it calibrates the trees, and each kind's threshold is the lowest that
reaches the wanted precision there. Accepted candidates that overlap no strict span and no
better candidate are added; strict spans always stay.

Edge cases: a null text has no spans; repeated rows are judged alike; equal
probabilities prefer the earlier, then the longer, span; an empty table fits
no model and gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from transitlens.llm import boosting
from transitlens.llm.common import fresh, text_or_empty, without

# The strict patterns, in the order in which kinds are listed.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = tuple(PATTERNS)
#: how the patterns are searched in time linear in the text: names of emails are found from their "@", ips start a run of digits
_STRICT = {k: re.compile(p) for k, p in PATTERNS.items()} | {
    "ip": re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")}
_NAME = "".join(chr(c) for c in range(128) if re.match(r"[A-Za-z0-9._%+-]", chr(c)))
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_HINT = re.compile("[0-9@]|[(\\[]at[)\\]]")

# Generators: broader than the strict patterns, and overlapping.
_NUMBER = re.compile(r"(?<![0-9])\+?(?:\([0-9]{1,5}\)|[0-9]+)(?:[ ./() -]{1,2}[0-9]+)*")
_QUAD = re.compile(r"[0-9]{1,3}(?:[.]|\[\.\]|\(\.\))[0-9]{1,3}(?:[.]|\[\.\]|\(\.\))[0-9]{1,3}(?:[.]|\[\.\]|\(\.\))[0-9]{1,3}")
_SPELLED_AT = re.compile(r" ?(?:@|[(\[]at[)\]]) ?")
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?: ?(?:\.|[(\[]dot[)\]]) ?[A-Za-z0-9-]++)++")
#: parts of a run of numbers are proposed up to this many digits, from every group on
MAX_DIGITS = 19
SAMPLE_TEXTS = 4000
SAMPLE_SPANS = 20000
PRECISION = 0.99
#: values, and as many look-alikes, planted into each sampled text
PLANTED = 16

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, s: str) -> bool:
    """Whether a strict match passes its check."""
    if kind == "email":
        return True
    if kind == "ip":
        parts = [x.lstrip("0") or "0" for x in s.split(".")]
        return all(len(x) <= 3 and int(x) <= 255 for x in parts)
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d) if kind == "card" else 10 <= len(d) <= 15


def _addresses(text: str, at: re.Pattern, domain: re.Pattern) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping spans of name, ``at`` and ``domain``.

    No name holds an ``at``, so every span is found from its ``at``: the name
    runs back to the last character that can't be in it, the previous ``at``, or
    the end of the previous span. Each character is looked at a few times at most.
    """
    out, start, m = [], 0, at.search(text)
    while m:
        end, found = m.end(), domain.match(text, m.end())
        if found and m.start() > start:
            head = text[start:m.start()]
            name = len(head.rstrip(_NAME))
            if name < len(head):
                out.append((start + name, found.end()))
                end = found.end()
        start, m = end, at.search(text, end)
    return out


_AT = re.compile("@")


def strict_spans(text: str) -> list[Span]:
    """Base spans by start, then kind as listed."""
    found = []
    has_digit = any(c in text for c in "0123456789")
    for rank, (kind, pattern) in enumerate(_STRICT.items()):
        if "@" not in text if kind == "email" else not has_digit or kind == "phone" and "+" not in text:
            continue
        if kind == "email":
            found += [(a, rank, b) for a, b in _addresses(text, _AT, _DOMAIN)]
            continue
        found += [(m.start(), rank, m.end()) for m in pattern.finditer(text) if valid(kind, m.group())]
    return [(a, b, KINDS[r]) for a, r, b in sorted(found)]


def candidates(text: str) -> list[Span]:
    """Proposed spans of all kinds; they overlap each other and the strict ones."""
    found = set()
    for m in _NUMBER.finditer(text):
        if len(m.group()) < 9:
            continue
        groups = [(g.start(), g.end()) for g in re.finditer("[0-9]+", m.group())]
        for i in range(len(groups)):
            n = 0
            for j in range(i, len(groups)):
                n += groups[j][1] - groups[j][0]
                if n > MAX_DIGITS:
                    break
                a, b = m.start() + groups[i][0], m.start() + groups[j][1]
                if 13 <= n:
                    found.add((a, b, "card"))
                if 9 <= n <= 16:
                    a -= text[a - 1:a] == "("
                    found.add((a - (text[a - 1:a] == "+"), b, "phone"))
    found |= {(m.start(), m.end(), "ip") for m in _QUAD.finditer(text)
              if all(int(p) <= 255 for p in re.findall("[0-9]+", m.group()))}
    if "@" in text or "at" in text:
        found |= {(a, b, "email") for a, b in _addresses(text, _SPELLED_AT, _SPELLED_DOMAIN)}
    return sorted(found)


# Words that often stand before personal data.
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "write", "from", "to"),
    "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "account", "iban"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "telefon", "telephone"),
}
SECRET_CUES = ("token", "key", "secret", "sha", "hash", "version", "id", "isbn", "date")


def _kind_of(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isdigit() else 3 if c.isalpha() else 4 if c in "\"'=" else 5


def features(text: str, span: Span) -> list[int]:
    """Format of the span and its surroundings, as small whole numbers."""
    a, b, kind = span
    s = text[a:b]
    d = _digits(s)
    groups = re.findall("[0-9]+", s)
    before = re.findall(r"[^\W\d_]+(?:-[^\W\d_]+)?", text[max(0, a - 24):a].lower())
    last = before[-1] if before else ""
    top = boosting.BINS - 1
    quad = kind == "ip" and len(groups) == 4
    return [
        KINDS.index(kind), min(len(s), top), min(len(d), top), min(len(groups), top),
        min(max(map(len, groups), default=0), top), min(min(map(len, groups), default=0), top),
        int(bool(d) and luhn(d)), int(s.startswith("+")), min(s.count(" "), top), min(s.count("-"), top),
        min(s.count("."), top), int("(" in s or "[" in s), int("@" in s),
        int(quad and all(int(g) <= 255 for g in groups)) if kind == "ip" else 2,
        min(len(s.rpartition(".")[2]), top) if kind == "email" else 0,
        _kind_of(text[a - 1:a] if a else ""), _kind_of(text[b:b + 1]),
        _kind_of(text[a - 2:a - 1] if a > 1 else ""), _kind_of(text[b + 1:b + 2]),
        int(last in CUES[kind]), int(last in SECRET_CUES),
        int(d[:1] in "3456") if d else 0, int(len(set(d)) <= 3),
        min(len(groups[0]), top) if groups else 0, min(len(groups[-1]), top) if groups else 0,
        int(any(len(g) == 4 and g[:2] in ("19", "20") for g in groups[:3])),
        min(s.count("dot)") + s.count("dot]"), top), int(". " in s), min(len(re.split("[^A-Za-z0-9-]+", s.rstrip(")]"))[-1]), top),
        int(kind == "card" and len(groups) == 4 and {len(g) for g in groups} == {4} and luhn(d)),
    ]


def _cut(digits: str, sizes: tuple[int, ...], sep: str) -> str:
    """Digits in groups of ``sizes``, the rest in the last one."""
    out, at = [], 0
    for n in sizes:
        out.append(digits[at:at + n])
        at += n
    return sep.join([*out, digits[at:]] if digits[at:] else out)


def _with_check(digits: str) -> str:
    return next(digits + c for c in "0123456789" if luhn(digits + c))


def rewritten(kind: str, value: str, r: int) -> tuple[str, str]:
    """(text before, value): a strict value in a format that only the generators see, chosen by ``r``."""
    d, r, own = _digits(value), r // 8, r % 8
    if kind == "email":
        name, _, host = value.partition("@")
        at = (" (at) ", " [at] ", "(at)", "[at]", " @ ", " (at) ", " [at] ", "[at]")[own]
        dot = (" (dot) ", " [dot] ", "(dot)", "[dot]", ".", ".", ".", " [dot] ")[own]
        return "", name + at + host.replace(".", dot)
    if kind == "ip":
        return "", value.replace(".", ("[.]", "(.)")[own % 2])
    if kind == "card":
        sizes = (4, 6) if len(d) == 15 else (4, 4, 4)
        if own < 2:  # within a longer run of numbers, as in a table
            row = f"20{10 + r % 15} 0{1 + r % 9} {10 + r % 19} {10 + r % 14} {10 + r % 50} {10 + r % 49} "
            return row[:(20, 11)[own]], _cut(d, sizes, " -"[r % 2])
        return "", _cut(d, sizes, (".", "/", " - "[:2], "  ", ". ", ".")[own - 2])
    d = d[-10:]
    return "", (f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"({d[:3]}) {d[3:6]} {d[6:]}",
                f"({d[:3]}) {d[3:6]}.{d[6:]}", f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]} {d[3:6]} {d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}")[own]


def made_up(kind: str, r: int) -> str:
    """A strict value for texts that have none of the kind."""
    d = f"{r * 2654435761 % 10 ** 15:015}"
    if kind == "email":
        names, hosts = ("joe", "anna.li", "j_smith", "mk77", "info", "sales", "p.novak"), ("example", "mail", "post-box", "acme", "uni")
        return f"{names[r % 7]}@{hosts[r // 7 % 5]}.{('com', 'org', 'net', 'de', 'co.uk')[r // 35 % 5]}"
    if kind == "ip":
        return ".".join(str(int(d[i:i + 3]) % (10, 100, 256)[int(d[12 + i // 9]) % 3]) for i in (0, 3, 6, 9))
    return _with_check("3456"[r % 4] + d[:14]) if kind == "card" else "+1" + str(2 + r % 8) + d[:9]


def look_alike(kind: str, r: int) -> str:
    """Text that the generators of a kind propose, or nearly, and that is none."""
    d, own = f"{r * 2654435761 % 10 ** 18:018}", r // 8 % 8
    if kind == "email":
        a, b, c = (("meet", "look", "back", "again", "stay")[r % 5], ("noon", "home", "school", "night", "work")[r // 5 % 5],
                   ("Then", "We", "Bring", "It", "They")[r // 25 % 5])
        return f"{a} {('(at)', '[at]', '@')[r % 3]} {b}. {c}"
    if kind == "ip":
        return ("[.]", "(.)")[r % 2].join(str(int(d[i:i + 1 + r % 2])) for i in (2, 4, 6, 8, 10))
    if kind == "card":
        bad = d[:15] + str((int(_with_check(d[:15])[-1]) + 1 + r % 9) % 10)
        return _cut(bad, (4, 4, 4), (".", " ", "-", "/")[own % 4])
    y, mo, da, h, mi = f"{1950 + r % 90}", f"{1 + r % 12:02}", f"{1 + r % 28:02}", f"{r % 24:02}", f"{r % 60:02}"
    return (f"{y}-{mo}-{da} {h}", f"{y} {mo} {da} {h} {mi}", f"{da}.{mo}.{y} {h}.{mi}", d[:9 + r % 6], f"{d[:2]}.{d[2:4]} {d[4:6]}.{d[6:8]} {d[8:10]}.{d[10:12]}",
            f"{d[:3]}-{d[3:6]} {d[6:9]}-{d[9:12]}", f"978-3-{d[:2]}-{d[2:8]}-{d[8]}", f"{1 + r % 9} {d[:3]} {d[3:6]} {d[6:9]}")[own]


def _no_phone(s: str) -> bool:
    groups = re.findall("[0-9]+", s)
    return len(groups) == 1 or len(groups) > 6 or any(len(g) == 4 and g[:2] in ("19", "20") for g in groups[:3])


def labelled(text: str) -> list[list[int]]:
    """Features and label of candidates of one text, and of values and look-alikes planted into it."""
    strict = strict_spans(text)
    own, covered = set(strict), _merged([(a, b) for a, b, _ in strict])
    starts = [a for a, _ in covered]
    out = []
    for c in candidates(text):
        a, b, kind = c
        if c in own:
            out.append([*features(text, c), 1])
        elif not _overlaps(starts, covered, a, b) and (kind == "card" and not luhn(_digits(text[a:b])) or
                                                        kind == "phone" and _no_phone(text[a:b])):
            out.append([*features(text, c), 0])
    gaps = [m.start() for m in re.finditer(r"(?<=[^\W\d_]) (?=[^\W\d_])", text)] or [len(text)]
    base = hashlib.md5(text.encode()).digest()

    def drawn(n: int) -> int:
        return int.from_bytes(hashlib.md5(base + bytes([n])).digest()[:6], "big")

    def around(n: int) -> tuple[str, str]:
        at = gaps[drawn(n) % len(gaps)]
        return text[max(0, at - 60):at] + " ", text[at:at + 60]

    values = [(k, text[max(0, a - 60):a], text[a:b], text[b:b + 60]) for a, b, k in strict[:4]]
    for n in range(PLANTED):
        before, after = around(n)
        values.append((KINDS[n % 4], before, made_up(KINDS[n % 4], drawn(n + 64)), after))
    for n, (kind, before, value, after) in enumerate(values):
        lead, value = rewritten(kind, value, drawn(n + 128))
        before, after = before + lead, ("", "", ".", ",")[drawn(n + 160) % 4] + after
        planted = before + value + after
        wanted = (len(before), len(before) + len(value), kind)
        found = [c for c in candidates(planted) if c[0] < wanted[1] and c[1] > wanted[0]]
        if wanted in found and wanted not in strict_spans(planted):
            out += [[*features(planted, c), int(c == wanted)] for c in found]
    for n in range(PLANTED):
        before, after = around(n + 32)
        wrong = look_alike(KINDS[n % 4], drawn(n + 192))
        planted = before + wrong + after
        taken = set(strict_spans(planted))
        out += [[*features(planted, c), 0] for c in candidates(planted)
                if c[0] < len(before) + len(wrong) and c[1] > len(before) and c not in taken]
    return out


def _sampled(docs: DataFrame, text: str, n_texts: int) -> DataFrame:
    """``n_texts`` distinct texts with any hint, the smallest by hash."""
    body = text_or_empty(text)
    hinted = docs.select(body.alias("_text"), F.xxhash64(body).alias("_h")).where(F.col("_text").rlike("[0-9@]"))
    bounds = hinted.select("_h").distinct().orderBy("_h").limit(n_texts).agg(F.max("_h").alias("top")).first()
    if bounds["top"] is None:
        return hinted.limit(0)
    return hinted.where(F.col("_h") <= bounds["top"]).groupBy("_h").agg(F.min("_text").alias("_text"))


def train(docs: DataFrame, text: str = "text", n_texts: int = SAMPLE_TEXTS, n_spans: int = SAMPLE_SPANS,
          precision: float = PRECISION) -> dict:
    """Trees and one threshold a kind, from at most ``n_texts`` texts and ``n_spans`` labelled spans."""

    @F.arrow_udf("array<binary>")  # a byte for each feature: all are below boosting.BINS
    def rows(texts: pa.Array) -> pa.Array:
        out = []
        for v in texts:
            out.append([bytes(r) for r in labelled(v.as_py())])
        return pa.array(out, pa.list_(pa.binary()))

    found = (_sampled(docs, text, n_texts).select("_h", F.posexplode_outer(rows("_text")).alias("_p", "row"))
             .where(F.col("row").isNotNull()).orderBy(F.xxhash64("_h", "_p"), "_h", "_p").limit(n_spans))
    got = found.select("row", (F.pmod("_h", F.lit(5)) == 4).alias("aside")).collect()
    data = np.frombuffer(b"".join(r["row"] for r in got), np.uint8).astype(np.int64).reshape(-1, len(features("", (0, 0, "ip"))) + 1)
    x, y, aside = data[:, :-1], data[:, -1], np.array([r["aside"] for r in got], bool)
    model = boosting.fit(x, y, aside=aside)
    of = [x[:, 0] == k for k in range(len(KINDS))]
    model["thresholds"] = [boosting.threshold_for(model, x[k], y[k], precision, aside[k]) for k in of]
    return model


def _overlaps(starts: list[int], spans: list[tuple[int, int]], a: int, b: int) -> bool:
    i = bisect_right(starts, a)
    return (i > 0 and spans[i - 1][1] > a) or (i < len(spans) and spans[i][0] < b)


def all_spans(text: str, model: dict) -> tuple[list[Span], list[Span]]:
    """(strict spans, all spans) of a text, both by start, then kind as listed."""
    if not _HINT.search(text):
        return [], []
    strict = strict_spans(text)
    proposed = candidates(text)
    if not proposed:
        return strict, strict
    x = np.array([features(text, c) for c in proposed], np.int64)
    p = boosting.probability(model, x)
    wanted = p >= np.array(model["thresholds"])[x[:, 0]]
    taken = _merged([(a, b) for a, b, _ in strict])
    starts = [a for a, _ in taken]
    added: list[Span] = []
    order = sorted(np.flatnonzero(wanted), key=lambda i: (-p[i], proposed[i][0], proposed[i][0] - proposed[i][1]))
    for i in order:
        a, b, kind = proposed[i]
        if not _overlaps(starts, taken, a, b):
            at = bisect_right(starts, a)
            starts.insert(at, a)
            taken.insert(at, (a, b))
            added.append((a, b, kind))
    more = added
    while more:  # an added span splits a dropped match: what is left of it is tried again
        gaps = zip([0, *(b for _, b in taken)], [*(a for a, _ in taken), len(text)])
        more = [(at + a, at + b, kind) for at, end in list(gaps) for a, b, kind in strict_spans(text[at:end])]
        added += more
        taken = _merged([*taken, *((a, b) for a, b, _ in more)])
    return strict, sorted([*strict, *added], key=lambda s: (s[0], KINDS.index(s[2])))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def listed(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every span (overlapping ones together) replaced by its first kind in angle brackets."""
    out, at = [], 0
    for a, b in _merged([(a, b) for a, b, _ in spans]):
        kind = min((s for s in spans if s[0] >= a and s[1] <= b), key=lambda s: (s[0], KINDS.index(s[2])))[2]
        out += [text[at:a], f"<{kind}>"]
        at = b
    return "".join([*out, text[at:]])


RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_spans long, redacted string")


def find_pii(docs: DataFrame, model: dict, text: str = "text", redact: bool = False) -> DataFrame:
    """``docs`` with strict counts and digest, all spans and, if asked for, the redacted text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(RESULT)
    def judge(texts: pa.Array) -> pa.Array:
        rows = []
        for v in texts:
            t = v.as_py() or ""
            strict, spans = all_spans(t, sent.value)
            kinds = [k for _, _, k in strict]
            rows.append({f"n_{k}": kinds.count(k) for k in KINDS} | {
                "base_sha256": hashlib.sha256(listed(strict).encode()).hexdigest(), "spans": listed(spans),
                "n_spans": len(spans), "redacted": redacted(t, spans) if redact and spans else None})
        kinds_of = [*[(f"n_{k}", pa.int64()) for k in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()),
                    ("n_spans", pa.int64()), ("redacted", pa.string())]
        return pa.array(rows, pa.struct(kinds_of))

    added = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "n_spans"] + ["redacted"] * redact
    own = without(docs.columns, added)
    p = fresh("_p", own)
    # Marked nondeterministic so that a filter on the result is not pushed below it, which would run it twice.
    out = docs.select(*own, judge.asNondeterministic()(F.col(text)).alias(p))
    kept = [F.col(p)[c].alias(c) for c in added if c != "redacted"]
    if redact:
        kept.append(F.coalesce(F.col(p)["redacted"], F.col(text)).alias("redacted"))
    return out.select(*own, *kept)
