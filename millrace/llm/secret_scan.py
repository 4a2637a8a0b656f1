"""Secrets in texts: fixed patterns, and strings that a battery of tests finds random."""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, map_rows, whole_text

# The base patterns and the least lengths of what they must find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED = 12
KINDS = ("assign", "access", "hex", "random")

# The alphabets a string may be encoded in, the narrowest that holds it is taken.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
HEX_UPPER, HEX_MIXED = DIGITS + "ABCDEF", DIGITS + "abcdefABCDEF"
ALPHABETS = [HEX_UPPER, HEX_MIXED, LOWER, UPPER, UPPER + "234567", DIGITS + LOWER, DIGITS + UPPER,
             UPPER + LOWER + DIGITS + "+/", UPPER + LOWER + DIGITS + "-_"]
# Letters of European prose, percent.
LETTER_SHARE = dict(zip(LOWER, (8.2, 1.5, 2.8, 4.3, 12.7, 2.2, 2.0, 6.1, 7.0, 0.15, 0.77, 4.0, 2.4,
                                6.7, 7.5, 1.9, 0.1, 6.0, 6.3, 9.1, 2.8, 0.98, 2.4, 0.15, 2.0, 0.07)))
#: How prose-like a letter is: log of its share over the share in random strings, rare letters at half a percent at least.
LETTER_SIGN = {c: math.log(max(x, 0.5) * 26 / 100) for c, x in LETTER_SHARE.items()}
SIGN_MEAN = sum(LETTER_SHARE[c] * x for c, x in LETTER_SIGN.items()) / sum(LETTER_SHARE.values())
SIGN_VAR = sum(LETTER_SHARE[c] * (x - SIGN_MEAN) ** 2 for c, x in LETTER_SIGN.items()) / sum(LETTER_SHARE.values())
SIGN_EXCESS = 1.5  # letters of words depend on each other, and languages differ
HEX_LETTERS = sum(LETTER_SHARE[c] for c in "abcdef") / sum(LETTER_SHARE.values())
#: Changes between letters and digits, per pair of neighbours, in names that are made of words and numbers.
CHANGE_SHARE = 0.1

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Share of random strings among those dropped as regular, and of words and names among those found.
FALSE_REGULAR = 1e-3
FALSE_DISCOVERIES = 1e-2

FOUND = ("doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
         "spans string, n_random bigint")

Span = tuple[int, int, int]  # start, place in KINDS, end


def normal_tail(z: float) -> float:
    """P(Z > z)."""
    return math.erfc(z / math.sqrt(2)) / 2


def chi2_tail(x: float, df: float) -> float:
    """P(chi-squared > x), by the cube-root approximation."""
    spread = 2 / (9 * df)
    return normal_tail(((max(x, 0.0) / df) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))


def inferred_alphabet(text: str) -> str | None:
    """The first alphabet that holds the string. Letters of one case with signs between them (paths, names with
    hyphens) have none, nor have digits alone (from 16 on they are base spans)."""
    body = set(text.rstrip("="))
    classes = sum(any(c in body for c in kind) for kind in (LOWER, UPPER, DIGITS))
    if body <= set(DIGITS):
        return None
    found = next((a for a in ALPHABETS if body <= set(a)), None)
    return found if classes > 1 or found in (HEX_UPPER, HEX_MIXED, LOWER, UPPER) else None


def battery(text: str, alphabet: str) -> float:
    """p that a uniformly random string over the alphabet is as irregular: alphabet uniformity (chi-squared), runs
    above and below the alphabet's middle, and serial correlation at lag 1, combined by Fisher's method. Hexadecimal
    of both cases may be random over 16 values or over 22 characters; the better of the two counts."""
    body = text.rstrip("=")
    if alphabet == HEX_MIXED:
        return max(uniform_p(body, HEX_MIXED), uniform_p(body.upper(), HEX_UPPER))
    return uniform_p(body, alphabet)


def uniform_p(body: str, alphabet: str) -> float:
    x = np.array([alphabet.index(c) for c in body], np.float64)
    n, size = len(x), len(alphabet)
    counts = np.bincount(x.astype(int), minlength=size)
    chi2 = float(((counts - n / size) ** 2).sum() * size / n)
    p_uniform = chi2_tail(chi2, size - 1)
    high = x >= size / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n0 and n1:
        mean = 2 * n0 * n1 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        runs = 1 + int((high[1:] != high[:-1]).sum())
        p_runs = 2 * normal_tail(abs(runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        p_runs = 2.0 ** (1 - n)
    spread = x - x.mean()
    power = float((spread ** 2).sum())
    lag = float((spread[1:] * spread[:-1]).sum()) / power if power else 1.0
    p_serial = 2 * normal_tail(abs(lag) * math.sqrt(n))
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (p_uniform, p_runs, p_serial))
    half = fisher / 2  # six degrees of freedom
    return math.exp(-half) * (1 + half + half * half / 2)


def p_prose(text: str, alphabet: str) -> float:
    """Fisher's combination of two p within the alphabet: that words have letters of so few signs of prose (of
    hexadecimal: that all their letters are A to F), and that letters and digits change so often."""
    body = text.rstrip("=")
    letters = [c for c in body.lower() if c in LETTER_SIGN]
    if alphabet in (HEX_UPPER, HEX_MIXED):
        p_letters = HEX_LETTERS ** len(letters)
    elif letters:
        z = (sum(map(LETTER_SIGN.__getitem__, letters)) - len(letters) * SIGN_MEAN) / math.sqrt(
            SIGN_EXCESS * len(letters) * SIGN_VAR)
        p_letters = normal_tail(-z)
    else:
        p_letters = 1.0
    kinds = [c in DIGITS for c in body if c.isalnum()]
    pairs, changes = len(kinds) - 1, sum(a != b for a, b in zip(kinds, kinds[1:]))
    p_changes = min(1.0, sum(math.comb(pairs, k) * CHANGE_SHARE ** k * (1 - CHANGE_SHARE) ** (pairs - k)
                             for k in range(changes, min(pairs, changes + 60) + 1)))
    half = -math.log(max(p_letters, 1e-300)) - math.log(max(p_changes, 1e-300))
    return math.exp(-half) * (1 + half)


def rejected(ps: list[float], weights: list[float], share: float) -> list[bool]:
    """Hypotheses rejected at a bounded share of false rejections: Benjamini-Hochberg over p divided by weight,
    the weights scaled to a mean of one."""
    mean = sum(weights) / len(weights) if weights else 1.0
    weighted = [p * mean / w for p, w in zip(ps, weights)]
    bound = max((p for i, p in enumerate(sorted(weighted), 1) if p <= share * i / len(ps)), default=-1.0)
    return [p <= bound for p in weighted]


def random_spans(text: str, taken: list[Span]) -> list[Span]:
    """Strings that are neither words nor regular, each told at a bounded share of errors among those of the
    text; long strings, which the tests tell best, weigh more by their length. Strings that base spans cover for
    half or more are left out."""
    tested, near, at = [], [], 0
    for match in CANDIDATE.finditer(text):
        while at < len(taken) and taken[at][0] < match.end():
            near.append(taken[at])
            at += 1
        near = [span for span in near if span[2] > match.start()]
        alphabet = inferred_alphabet(match[0])
        covered = max((min(e, match.end()) - max(s, match.start()) for s, _, e in near), default=0)
        if alphabet and 2 * covered < len(match[0]):
            tested.append((match, alphabet))
    found = rejected([p_prose(m[0], a) for m, a in tested], [len(m[0]) for m, _ in tested], FALSE_DISCOVERIES)
    tested = [t for t, is_found in zip(tested, found) if is_found]
    regular = rejected([battery(m[0], a) for m, a in tested], [len(m[0]) for m, _ in tested], FALSE_REGULAR)
    return [(m.start(), 3, m.end()) for (m, _), is_regular in zip(tested, regular) if not is_regular]


def base_spans(text: str) -> list[Span]:
    spans = [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    if "=" in text or ":" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
                  if len(m[2]) >= LEAST_ASSIGNED]
    return sorted(spans)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, base and random spans), each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base))


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts per kind, digest of the base spans, all spans (code points, end
    exclusive). Null texts count as empty; every row keeps its row; nothing is shuffled."""
    def start():
        def step(batch):
            if batch is None:
                return
            out = {name.split()[0]: [] for name in FOUND.split(", ")}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                base, spans = all_spans(text.as_py())
                kinds = [kind for _, kind, _ in spans]
                row = (doc_id, kinds.count(0), kinds.count(1), kinds.count(2),
                       hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans),
                       kinds.count(3))
                for column, value in zip(out.values(), row):
                    column.append(value)
            yield out
        return step
    return map_rows(docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")),
                    FOUND, start)


def redacted_text(text: str, mask: str) -> str:
    out, at = [], 0
    for start, _, end in all_spans(text)[1]:
        if end > at:
            if start >= at:
                out += [text[at:start], mask]
            at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The rows with every span of ``scan`` replaced by ``mask`` (overlapping spans by one) and
    n_chars set to the length that results; rows without a span keep their text and n_chars."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts):
        return texts.map(lambda x: None if x is None else redacted_text(x, mask))

    # Columns by place: no name of the caller's clashes with one in here.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    done = plain.withColumn("masked", masked(text))
    changed = F.col(text) != F.col("masked")
    new = {"text": F.col("masked"), "n_chars": F.length("masked")}
    return done.select(*[
        F.when(changed, new[c]).otherwise(F.col(f"c{i}")).alias(c) if c in new else F.col(f"c{i}").alias(c)
        for i, c in enumerate(docs.columns)])
